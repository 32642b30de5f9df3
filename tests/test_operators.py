"""Operators on small inputs of our own: documentation pages, graph, search, store."""

import random
import re

import pytest
from pyspark.sql import functions as F

from siltstone.functions import paths
from siltstone.operators import graph, search, store
from siltstone.operators.doc_chunks import chunk_pages, sections

PAGE = "Some words before any heading that are long enough.\n\n# Setup\n\n## Roll back\n\nHow one goes back to the last good release.\n\n## Long\n\n" + "x" * 13_000 + "\n\n# Ask\n\nWhere to ask, and what to say when asking there.\n"


def pages(spark, *texts):
    rows = [(f"p{i}", t, f"Title {i}", ["b", "a"] if i == 0 else None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "source_id string, content string, file_path string, labels array<string>")


def test_page_by_headings(spark):
    got = {r.symbol_name: r for r in chunk_pages(pages(spark, PAGE)).collect()}
    assert set(got) == {"(intro)", "Roll back", "Long (part 1)", "Long (part 2)", "Long (part 3)", "Ask"}
    assert got["Roll back"].heading_path == ["Setup", "Roll back"] and got["Long (part 3)"].heading_path == ["Setup", "Long"] and got["Ask"].heading_path == ["Ask"] and got["(intro)"].heading_path == []
    assert [len(got[f"Long (part {i})"].display_content) for i in (1, 2, 3)] == [6000, 6000, 2000]
    assert got["Roll back"].content.startswith("Page: Title 0\n\nSection: Setup > Roll back\n\nLabels: b, a\n\nHow one")
    assert (got["Roll back"].start_line, got["Roll back"].end_line) == (5, 8) and got["(intro)"].start_line == 1
    assert {r.source_type for r in got.values()} == {"confluence"} and {r.symbol_type for r in got.values()} == {"section"}


def test_page_cases(spark):
    fence = "# A\n```\n# no heading here at all, it is code\n```\nenough text to be a section of its own.\r\n"
    found = chunk_pages(pages(spark, fence, "  plain text \n", "# A\nshort\n# B\n", None, "")).collect()
    by = {}
    for r in found:
        by.setdefault(r.source_id, []).append(r)
    assert [r.symbol_name for r in by["p0"]] == ["A"] and by["p0"][0].display_content.startswith("```\n# no heading") and by["p0"][0].display_content.endswith("own.")
    assert [(r.symbol_name, r.display_content, r.end_line) for r in by["p1"]] == [("(page)", "plain text", 2)]
    assert "p2" not in by and "p3" not in by and by["p4"][0].display_content == ""
    assert chunk_pages(pages(spark, "x").filter("false")).count() == 0


def test_heading_paths_like_a_stack(spark):
    rng = random.Random(5)
    texts = ["\n".join(rng.choice(["text", "#" * rng.randint(1, 6) + f" h{j}", "```" if rng.random() < 0.1 else "-"]) for j in range(40)) for _ in range(60)]
    want = {}
    for i, t in enumerate(texts):
        stack, inside, n = [], False, 0
        want[f"p{i}", 0] = []
        for line in t.split("\n"):
            if line.startswith("```"):
                inside = not inside
            elif line.startswith("#") and not inside:
                level = len(line.split(" ")[0])
                stack = [s for s in stack if s[0] < level] + [(level, line.split(" ")[1])]
                n += 1
                want[f"p{i}", n] = [s[1] for s in stack]
    got = {(r.source_id, r.section): list(r.heading_path) for r in sections(pages(spark, *texts)).collect()}
    assert {k: v for k, v in want.items() if k in got} == got and all(k in got or k[1] == 0 for k in want)


SYMBOLS = "repo string, file_path string, symbol_name string, imports array<string>, calls array<string>, extends_symbols array<string>, implements_symbols array<string>"


def symbols(spark):
    return spark.createDataFrame(
        [
            ("r", "a.ts", "Shop.buy", ["lib"], ["find", "find", "buy"], [], None), ("r", "b.ts", "Stock.find", [], ["check"], [], []), ("r", "c.ts", "Base", [], [], [], []),
            ("r", "d.ts", "Sub", [], [], ["Base", "Base"], []), ("r", "e.ts", "One.check", [], ["check"], [], []), ("r", "f.ts", "Two.check", [], [], [], []), ("r", "f.ts", "Two.check", [], [], [], []),
            ("s", "a.ts", "find", [], ["Base"], [], []), ("r", "g.ts", None, [], ["Base"], [], []), ("r", "h.ts", "", [], ["Base"], [], []), ("r", None, "Kid", [], [], ["Shop.Base"], ["Base"]),
        ],
        SYMBOLS,
    )


def test_graph(spark):
    edges = {(r.from_symbol, r.relationship, r.to_symbol) for r in graph.resolve_edges(symbols(spark)).collect()}
    assert edges == {
        ("r:a.ts:Shop.buy", "calls", "r:b.ts:Stock.find"), ("r:d.ts:Sub", "extends", "r:c.ts:Base"), ("r:e.ts:One.check", "calls", "r:f.ts:Two.check"), ("r::Kid", "implements", "r:c.ts:Base"),
    }
    assert {(r.fq, r.name, r.candidates) for r in graph.ambiguous_references(symbols(spark)).collect()} == {("r:b.ts:Stock.find", "check", 2)}


@pytest.mark.parametrize("names, task", [(10**6, 10**6), (0, 2)])
def test_graph_by_broadcast_and_by_join(spark, monkeypatch, names, task):
    monkeypatch.setattr(graph, "BROADCAST", names)
    monkeypatch.setattr(graph, "TASK", task)
    test_graph(spark)
    same = graph.resolve_edges(symbols(spark).union(symbols(spark)))  # records of one full name that say the same
    assert sorted(map(repr, same.collect())) == sorted(map(repr, graph.resolve_edges(symbols(spark)).collect()))
    assert {(r.to_symbol, r.to_path, r.to_name) for r in same.collect()} >= {("r:c.ts:Base", "c.ts", "Base"), ("r:b.ts:Stock.find", "b.ts", "Stock.find")}


def shuffles(df):
    return len(re.findall(r"\bExchange ", df._jdf.queryExecution().executedPlan().toString()))


def test_references_are_shuffled_once_and_edges_stay_where_they_are(spark):
    edges = graph.resolve_edges(symbols(spark))
    assert shuffles(edges) == 1 and shuffles(graph.ambiguous_references(symbols(spark))) == 1
    replaced = store.replaced_edges(edges, edges.filter("relationship = 'calls'"), symbols(spark).select("repo"))
    assert "SortMergeJoin" not in replaced._jdf.queryExecution().executedPlan().toString()
    assert {r.relationship for r in replaced.collect()} == {"calls"}


def test_symbol_context(spark):
    chunks = symbols(spark).select("*", F.lit("u").alias("url"), F.lit(1).alias("start_line"), F.lit("c").alias("chunk_id"), F.rpad(F.lit("z"), 500, "z").alias("display_content"))
    edges = graph.resolve_edges(symbols(spark))
    got = graph.symbol_context(edges, chunks, "r", "Base").collect()
    assert {(r.bucket, r.symbol_name) for r in got} == {("extendedBy", "Sub"), ("implementedBy", "Kid")}
    assert all(r.display_content == "z" * 400 + "\n..." for r in got)
    assert graph.symbol_context(edges, chunks, "r", "find").count() == 0 and graph.symbol_context(edges, chunks, "r", "Stock.find", exact=True).count() == 1


def test_fusion(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "id string, rank int")
    b = spark.createDataFrame([("z", 1), ("y", 2)], "id string, rank int")
    got = {r.id: (r.score, r.first_list, r.first_rank) for r in search.fuse([a, b]).collect()}
    assert got["y"] == (pytest.approx(2 / 62), 0, 2) and got["x"] == (pytest.approx(1 / 61), 0, 1) and got["z"] == (pytest.approx(1 / 61), 1, 1)


def test_search(spark):
    rows = [(f"c{i}", "r" if i % 2 else "s", "code", "alpha beta" if i < 6 else "gamma", [1.0, i / 10.0] if i != 3 else None) for i in range(20)]
    chunks = spark.createDataFrame(rows, "chunk_id string, repo string, source_type string, display_content string, embedding array<float>")
    for c in ("source_id", "file_path", "symbol_name", "symbol_type", "url"):
        chunks = chunks.withColumn(c, F.lit(None).cast("string"))
    got = search.search(chunks, "Alpha the BETA", [1.0, 0.0], limit=4, repo="r").collect()
    assert [r.chunk_id for r in got] == ["c1", "c5", "c3", "c7"] and [r.place for r in got] == [1, 2, 3, 4]
    assert search.lexical_topk(chunks, "the of").count() == 0 and search.dense_topk(chunks, [1.0, 0.0], 100).count() == 19
    assert "zz" not in {r.id for r in search.dense_topk(chunks.filter("false"), [1.0, 0.0]).collect()}


def chunk_rows(spark, *rows):
    return spark.createDataFrame([(*r, 1, 1, "t") for r in rows], "chunk_id string, source_id string, content_hash string, display_content string, url string, start_line int, end_line int, content string")


def test_store(spark):
    old = store.merge_chunks(chunk_rows(spark).filter("false"), chunk_rows(spark, ("a1", "a", "h1", "x", "u1"), ("a2", "a", "h1", "y", "u1"), ("b1", "b", "h2", "z", "u1")), F.lit("2024-01-01").cast("timestamp")).cache()
    assert old.count() == 3
    docs = spark.createDataFrame([("a", "h9"), ("b", "h2"), ("c", "h3")], "source_id string, content_hash string")
    assert {r.source_id for r in store.changed_files(docs, old).collect()} == {"a", "c"}
    new = chunk_rows(spark, ("a1", "a", "h9", "x2", "u2"), ("c1", "c", "h3", "w", "u2"))
    merged = store.merge_chunks(old, new, F.lit("2025-01-01").cast("timestamp")).cache()
    got = {r.chunk_id: r for r in merged.collect()}
    assert (got["a1"].display_content, got["a1"].url, got["a1"].created_at.year, got["a1"].updated_at.year) == ("x2", "u1", 2024, 2025)
    assert got["b1"].updated_at.year == 2024 and got["c1"].url == "u2" and got["a1"].imports == [] and got["a1"].exported is False
    assert {r.chunk_id for r in store.prune_stale(merged, docs.filter("source_id <> 'b'"), new).collect()} == {"a1", "b1", "c1"}
    again = store.merge_chunks(merged, new, F.lit("2025-01-01").cast("timestamp"))
    assert sorted(again.collect(), key=str) == sorted(merged.collect(), key=str)
    assert {r.chunk_id for r in store.merge_chunks(old, new, refresh_url=True).filter("url = 'u2'").collect()} == {"a1", "c1"}
    assert {r.chunk_id for r in store.prune_missing_sources(merged, docs.filter("source_id = 'a'")).collect()} == {"a1", "a2"}


def test_snapshots(spark, tmp_path):
    table = store.Snapshots(spark, str(tmp_path / "t"))
    assert table.read().count() == 0
    one = store.merge_chunks(table.read(), chunk_rows(spark, ("a1", "a", "h", "x", "u")))
    table.write(one)
    table.write(store.merge_chunks(table.read(), chunk_rows(spark, ("b1", "b", "h", "x", "u"))))
    assert {r.chunk_id for r in table.read().collect()} == {"a1", "b1"}
    old = table.read()
    begun = tmp_path / "t" / f"snapshot-{9:012d}-{'0' * 32}"  # a writer that ended half-way
    begun.mkdir()
    (begun / "part-0.parquet").write_bytes(b"half")
    assert {r.chunk_id for r in table.read().collect()} == {"a1", "b1"}
    table.write(store.merge_chunks(table.read(), chunk_rows(spark, ("c1", "c", "h", "x", "u"))))
    assert table.read().count() == 3 and old.count() == 2 and len(table.complete()) == 3  # who began with the old one still has it
    table.tidy(1)
    assert table.read().count() == 3 and len(table.complete()) == 1
    with pytest.raises(Exception, match="boom"):
        table.write(table.read().withColumn("chunk_id", F.raise_error(F.lit("boom")).cast("string")))
    assert table.read().count() == 3


def test_columns_of_callers_stay(spark):
    old = store.merge_chunks(chunk_rows(spark).filter("false"), chunk_rows(spark, ("a1", "a", "h1", "x", "u1")))
    named = chunk_rows(spark, ("a1", "a", "h", "x", "u"), ("a1", "a", "h", "y", "u")).withColumn("nth", F.lit(7))
    assert [r.nth for r in store.latest(named).collect()] == [7]
    held = old.withColumn("touched", F.lit(1)).withColumn("stays", F.lit(2))
    (row,) = store.prune_stale(held, held.filter("false"), held).collect()
    assert (row.touched, row.stays) == (1, 2)


def test_search_layout_finds_the_same(spark, tmp_path):
    from siltstone.operators import index

    rng = random.Random(4)
    words = ["alpha", "beta", "gamma", "delta", "the", "of"]
    rows = [(f"c{i:03}", " ".join(rng.choice(words) for _ in range(rng.randint(0, 30))), [rng.gauss(i % 5, 0.3) for _ in range(6)] if i % 7 else None) for i in range(300)]
    chunks = spark.createDataFrame(rows, "chunk_id string, display_content string, embedding array<float>")
    at = str(tmp_path / "i")
    index.write(chunks, at)
    held, stats = spark.read.parquet(f"{at}/postings"), spark.read.parquet(f"{at}/statistics")
    plain = lambda df, score: [(r.id, round(r[score], 9), r["rank"]) for r in df.orderBy("rank").collect()]
    for q in ("alpha of beta", "gamma", "the", "alpha nowhere", ""):
        assert plain(index.lexical_topk(held, stats, q), "score") == plain(search.lexical_topk(chunks, q), "score")
    centres = index.centres(chunks, 8)
    celled = index.celled(chunks, centres).cache()
    radius = index.radii(celled, centres)
    for _ in range(5):
        v = [rng.gauss(2, 2) for _ in range(6)]
        assert plain(index.dense_topk(celled, centres, radius, v, 10), "distance") == plain(search.dense_topk(chunks, v, 10), "distance")
    plan = index.lexical_topk(held, stats, "gamma")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan


def test_edges_are_replaced_by_repository(spark, tmp_path):
    at = str(tmp_path / "e")
    edges = graph.resolve_edges(symbols(spark))
    repos = lambda *names: spark.createDataFrame([(n,) for n in names], "repo string")
    count = lambda: {r["repo"]: r["count"] for r in store.edges_of(spark, at).groupBy("repo").count().collect()}
    assert count() == {}
    store.write_edges(edges, at, repos("r", "s"))
    store.write_edges(edges.limit(1).withColumn("repo", F.lit("q")), at, repos("q"))
    assert count() == {"r": 4, "q": 1}
    store.write_edges(edges.filter("false"), at, repos("r"))  # it resolves to no edge any more
    assert count() == {"q": 1}
    store.write_edges(edges, at, repos("none"))  # edges of others than the rebuilt ones are not taken
    assert count() == {"q": 1}


def test_paths(spark):
    names = ["src/a.ts", "a.test.ts", "x/test_a.py", "x/a_test.py", "rebuild/a.ts", "a.d.ts", "lib.min.js", "noext", "FooTest.java", "A.TS", "a.py/b"]
    df = spark.createDataFrame([(n,) for n in names], "p string")
    assert [r.p for r in df.filter(paths.is_ingestible(F.col("p"))).collect()] == ["src/a.ts", "a.d.ts", "FooTest.java"]
    fq = spark.createDataFrame([("o/r:a/b.ts:GET /x/:id",), ("r:f:n",)], "fq string")
    assert [tuple(r) for r in fq.select(paths.fq_path(F.col("fq")), paths.fq_name(F.col("fq"))).collect()] == [("a/b.ts:GET /x/", "id"), ("f", "n")]
