"""Documentation pages: one chunk a heading's own text, long ones in overlapping windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltstone.functions.paths import chunk_id, joined_parts
from siltstone.schema import CHUNK, conform

#: Limits of a section in characters, and what a heading is.
LEAST, MOST, OVERLAP = 40, 6000, 500
HEADING = r"(?U)^(#{1,6})\s+(.+?)\s*$"


def trimmed(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)\A\s+|\s+\z", "")


def windows(body: Column) -> Column:
    """The body alone if it has at most MOST characters, else windows of MOST that overlap by OVERLAP."""
    more = F.ceil((F.length(body) - MOST) / F.lit(float(MOST - OVERLAP))).cast("int")
    starts = F.sequence(F.lit(0), F.greatest(more, F.lit(0)))
    return F.transform(starts, lambda i: F.substring(body, i * (MOST - OVERLAP) + 1, F.lit(MOST)))


def marked_lines(pages: DataFrame) -> DataFrame:
    """(source_id, pos, line, level, section, path): each line with the heading level it has (0: none), the number of headings up
    to it, and, on a heading, the headings above and itself."""
    lines = pages.select("source_id", F.posexplode(F.split("content", "\n")).alias("pos", "line"))
    upto = W.partitionBy("source_id").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    before = W.partitionBy("source_id").orderBy("pos").rowsBetween(W.unboundedPreceding, -1)
    fence = trimmed(F.col("line")).startswith("```")
    lines = lines.withColumn("fence", fence.cast("int")).withColumn("open", F.coalesce(F.sum("fence").over(before), F.lit(0)) % 2)
    heads = (F.col("fence") == 0) & (F.col("open") == 0)
    lines = lines.withColumn("level", F.when(heads, F.length(F.regexp_extract("line", HEADING, 1))).otherwise(0)).withColumn("heading", F.regexp_extract("line", HEADING, 2))
    last = lambda level: F.last(F.when(F.col("level") == level, F.struct("pos", "heading")), ignorenulls=True).over(upto)
    lines = lines.select("*", F.sum((F.col("level") > 0).cast("int")).over(upto).alias("section"), *(last(k).alias(f"h{k}") for k in range(1, 7)))
    at = lambda k: F.coalesce(F.col(f"h{k}.pos"), F.lit(-1))
    # a heading is open while nothing of a higher rank came after it
    still = [at(k) > (F.greatest(*(at(j) for j in range(1, k)), F.lit(-1)) if k > 1 else F.lit(-1)) for k in range(1, 7)]
    path = F.filter(F.array(*(F.when(still[k - 1] & (F.col("level") >= k), F.col(f"h{k}.heading")) for k in range(1, 7))), lambda x: x.isNotNull())
    return lines.select("source_id", "pos", "line", "level", "section", F.when(F.col("level") > 0, path).alias("path"))


def sections(pages: DataFrame) -> DataFrame:
    """(source_id, section, level, heading_path, start_line, end_line, body), section 0 being what stands before the first heading."""
    text = F.collect_list(F.when(F.col("level") == 0, F.struct("pos", "line")))
    grouped = marked_lines(pages).groupBy("source_id", "section").agg(
        F.max("level").alias("level"), F.max("path").alias("heading_path"), (F.min("pos") + 1).alias("start_line"), (F.max("pos") + 1).alias("end_line"), F.array_sort(text).alias("lines")
    )
    body = trimmed(F.array_join(F.transform("lines", lambda x: x["line"]), "\n"))
    return grouped.select("source_id", "section", "level", F.coalesce("heading_path", F.array().cast("array<string>")).alias("heading_path"), "start_line", "end_line", body.alias("body"))


def chunk_pages(pages: DataFrame, whole: bool = True) -> DataFrame:
    """Chunks of Markdown pages (source_id unique, content, file_path the title, labels, repo, url, last_modified, content_hash).

    Sections of fewer than LEAST characters give no chunk, though they remain in the paths of those below.
    A page without headings is one chunk whatever its length, or, unless whole, an intro like what stands before a first heading. Pages
    with null content give none.
    Lines are shuffled once, by page.
    """
    pages = pages.filter(F.col("content").isNotNull() & F.col("source_id").isNotNull())
    for name, kind in (("repo", "string"), ("url", "string"), ("last_modified", "timestamp"), ("content_hash", "string"), ("labels", "array<string>"), ("file_path", "string")):
        if name not in pages.columns:
            pages = pages.withColumn(name, F.lit(None).cast(kind))
    found = sections(pages).withColumn("headed", F.max("level").over(W.partitionBy("source_id")) > 0 if whole else F.lit(True))
    kept = found.filter(~F.col("headed") | (F.length("body") >= LEAST))
    named = F.when(~F.col("headed"), "(page)").when(F.col("level") == 0, "(intro)").otherwise(F.element_at(F.when(F.size("heading_path") > 0, F.col("heading_path")), -1))
    parts = kept.withColumn("name", named).withColumn("parts", F.when(F.col("headed"), windows(F.col("body"))).otherwise(F.array("body")))
    parts = parts.select("*", F.posexplode("parts").alias("part", "text"))
    symbol = F.when(F.size("parts") > 1, F.concat(F.col("name"), F.lit(" (part "), (F.col("part") + 1).cast("string"), F.lit(")"))).otherwise(F.col("name"))
    parts = parts.select("source_id", symbol.alias("symbol_name"), "heading_path", "start_line", "end_line", F.col("text").alias("display_content"))
    about = pages.select("source_id", "repo", "url", "last_modified", "content_hash", F.coalesce("labels", F.array().cast("array<string>")).alias("labels"), F.coalesce("file_path", F.lit("(untitled)")).alias("file_path"))
    joined = parts.join(about, "source_id")
    content = joined_parts(
        F.concat(F.lit("Page: "), F.col("file_path")),
        F.when(F.size("heading_path") > 0, F.concat(F.lit("Section: "), F.array_join("heading_path", " > "))),
        F.when(F.size("labels") > 0, F.concat(F.lit("Labels: "), F.array_join("labels", ", "))), F.col("display_content"),
    )
    out = joined.withColumns({"content": content, "source_type": F.lit("confluence"), "symbol_type": F.lit("section"), "chunk_id": chunk_id(F.col("source_id"), F.col("symbol_name"), F.col("start_line"))})
    return conform(out, CHUNK)
