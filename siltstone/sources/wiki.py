"""Wiki pages that are already a table: paths of titles, and HTML as Markdown."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions.html import with_markdown
from siltstone.functions.paths import content_hash
from siltstone.runtime import checkpointed
from siltstone.schema import RAW_DOCUMENT, conform

#: Rounds of doubling at most; a path has fewer than 2 to this power of pages.
ROUNDS = 40


def breadcrumbs(pages: DataFrame) -> DataFrame:
    """(id, breadcrumb) of pages (id, title, parent_id): titles from the outermost known ancestor to the page, " / " between.
    Paths end at a missing ancestor and before an ancestor would come twice, however deep the tree is.

    By doubling: each page knows the titles of its nearest 2 to the k ancestors after k rounds, a round is one join of
    a page's path with that of the page where it ends, and the rounds grow with the logarithm of the depth. Each round is kept under
    spark.checkpoint.dir. Null ids stay alone; a repeated id must have one parent.
    """
    base = pages.select(F.col("id").cast("string").alias("id"), F.col("title").cast("string").alias("title"), F.col("parent_id").cast("string").alias("parent_id"))

    # ids: the page and the ancestors known so far, outermost first; next: the one that follows
    paths = checkpointed(base.select("id", F.array("id").alias("ids"), F.array("title").alias("titles"), F.col("parent_id").alias("next")))
    for _ in range(ROUNDS):
        up = paths.filter("id is not null").dropDuplicates(["id"]).select(F.col("id").alias("next"), F.col("ids").alias("up_ids"), F.col("titles").alias("up_titles"), F.col("next").alias("up_next"))
        joined = paths.join(up, "next", "left")
        known = F.col("up_ids").isNotNull()
        # the path ends before an ancestor that is there already: among the page's own, or the nearest new one, which its own path may hold twice
        mine = F.slice("ids", F.lit(1), F.size("ids") - 1)
        twice = lambda i: F.array_contains(mine, F.element_at("up_ids", i)) | ((i < F.size("up_ids")) & (F.element_at("up_ids", i) == F.element_at("up_ids", -1)))
        again = F.coalesce(F.array_max(F.filter(F.sequence(F.lit(1), F.size("up_ids")), twice)), F.lit(0))
        fresh = lambda c: F.slice(c, F.col("again") + 1, F.size("up_ids") - F.col("again"))
        looped = F.col("again") > 0
        paths = checkpointed(
            joined.withColumn("again", again).select(
                "id", F.when(known, F.concat(fresh("up_ids"), "ids")).otherwise(F.col("ids")).alias("ids"), F.when(known, F.concat(fresh("up_titles"), "titles")).otherwise(F.col("titles")).alias("titles"),
                F.when(known & ~looped, F.col("up_next")).alias("next"),
            )
        )
        if paths.filter("next is not null").isEmpty():
            break
    return paths.select("id", F.array_join("titles", " / ").alias("breadcrumb"))


def raw_documents(pages: DataFrame, space: str, site: str = "", labels: DataFrame | None = None) -> DataFrame:
    """Raw documents of current pages (id, title, status, parent_id, created_at, html, webui) and labels (page_id, name)."""
    held = pages.filter(F.coalesce("status", F.lit("current")) == "current")
    named = held.withColumn("id", F.col("id").cast("string")).join(breadcrumbs(held), "id")
    if labels is not None:
        grouped = labels.groupBy(F.col("page_id").cast("string").alias("id")).agg(F.sort_array(F.collect_list("name")).alias("labels"))
        named = named.join(grouped, "id", "left")
    docs = with_markdown(named, F.coalesce("html", F.lit("")), "content").withColumns(
        {
            "source_type": F.lit("confluence"), "source_id": F.concat(F.lit(f"confluence:{space}:"), "id"), "repo": F.lit(space), "provider": F.lit("confluence"), "file_path": F.col("breadcrumb"),
            "url": F.concat(F.lit(site), "webui"), "last_modified": F.to_timestamp("created_at"), "content_hash": content_hash(F.col("content")),
        }
    )
    return conform(docs, RAW_DOCUMENT)
