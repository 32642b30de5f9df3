"""Targets, providers behind a scripted client, wiki tables, HTML, embedding, tools, and a sync from end to end."""

import base64
import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from siltstone.functions.html import to_markdown, with_markdown
from siltstone.operators import embed
from siltstone.operators.code_chunks import chunk_code
from siltstone.operators.store import Snapshots, edges_of
from siltstone.plans import ingest, tools
from siltstone.sources import connectors
from siltstone.sources.repository import read_checkout, register
from siltstone.sources.targets import Target, auth_header, parse_target
from siltstone.sources.wiki import breadcrumbs, raw_documents
from siltstone.streaming import sync


def test_targets():
    assert parse_target("o/r/more", "dev") == Target("github", "o/r", "dev")
    assert parse_target("gitlab:g/s/p") == Target("gitlab", "g/s/p")
    assert parse_target("bitbucket:w/r/x", "m") == Target("bitbucket", "w/r", "m")
    assert parse_target("confluence:KEY", "x") == Target("confluence", "KEY") and parse_target("confluence:KEY").label == "confluence:KEY"
    with pytest.raises(ValueError):
        parse_target("")
    assert auth_header("t", "e")["Authorization"] == "Basic " + base64.b64encode(b"e:t").decode()
    assert auth_header("t") == {"Authorization": "Bearer t"} and auth_header(None, "e") == {} and auth_header("t", basic_only=True) == {}


def client(answers):
    def get(url, headers):
        status, body = answers[url]
        return status, body if isinstance(body, bytes) else json.dumps(body).encode()

    return get


def test_github():
    api = "https://api.github.com/repos/o/r"
    tree = {"truncated": True, "tree": [{"type": "blob", "path": "a.py"}, {"type": "tree", "path": "d.py"}, {"type": "blob", "path": "x.md"}]}
    c = connectors.connect(parse_target("o/r"), client=client({api: (200, {"default_branch": "trunk"}), f"{api}/git/trees/trunk?recursive=1": (200, tree), f"{api}/contents/a.py?ref=trunk": (200, {"type": "file", "content": base64.b64encode(b"x = 1").decode()}), f"{api}/contents/d?ref=trunk": (200, [])}))
    assert c.list() == ["a.py"] and c.fetch("d") is None
    row = c.fetch("a.py")
    assert (row["source_id"], row["content"], row["language"], row["url"]) == ("github:o/r:a.py", "x = 1", "python", "https://github.com/o/r/blob/trunk/a.py")


def test_bitbucket():
    api = "https://api.bitbucket.org/2.0/repositories/w/r"
    first = f"{api}/src/main/?max_depth=25&pagelen=100"
    answers = {api: (200, {}), first: (200, {"values": [{"type": "commit_file", "path": "a.java"}], "next": "n2"}), "n2": (555, b""), f"{api}/src/main/a.java": (404, b"")}
    c = connectors.connect(parse_target("bitbucket:w/r"), client=client(answers))
    assert c.list() == ["a.java"] and c.fetch("a.java") is None
    answers[first] = (500, b"")
    with pytest.raises(OSError):
        c.list()


def test_gitlab():
    api = "https://gitlab.com/api/v4/projects/g%2Fp"
    c = connectors.connect(parse_target("gitlab:g/p", "v1"), client=client({f"{api}/repository/tree?ref=v1&recursive=true&per_page=100&page=1": (200, [{"type": "blob", "path": "s/a.ts"}]), f"{api}/repository/files/s%2Fa.ts/raw?ref=v1": (200, b"let a = 1")}))
    assert c.list() == ["s/a.ts"] and c.fetch("s/a.ts")["url"] == "https://gitlab.com/g/p/-/blob/v1/s/a.ts"


def test_confluence():
    api = "https://x.net/wiki/api/v2"
    page = {"id": "2", "title": "Kid", "body": {"view": {"value": "<h2>Hi</h2><p>there</p>"}}, "_links": {"webui": "/p/2"}, "version": {"createdAt": "2024-05-01T00:00:00Z"}}
    answers = {
        f"{api}/spaces?keys=K": (200, {"results": [{"id": "9", "key": "K"}]}), f"{api}/spaces/9/pages?status=current&limit=100": (200, {"results": [{"id": "1", "title": "Top", "parentId": None}], "_links": {"next": "/wiki/n"}}),
        "https://x.net/wiki/n": (200, {"results": [{"id": "2", "title": "Kid", "parentId": "1"}]}), f"{api}/pages/2?body-format=view": (200, page), f"{api}/pages/2/labels": (403, b""), f"{api}/pages/3?body-format=view": (404, b""),
    }
    c = connectors.connect(parse_target("confluence:K"), client=client(answers), base="https://x.net/wiki")
    assert c.list() == ["1", "2"] and c.fetch("3") is None
    row = c.fetch("2")
    assert (row["content"], row["file_path"], row["labels"], row["url"], row["repo"]) == ("## Hi\n\nthere", "Top / Kid", [], "https://x.net/wiki/p/2", "K")
    assert connectors.changed_ingestible(["a.ts", "b.md"]) == ["a.ts"]


def test_breadcrumbs_end_at_missing_and_cycles(spark):
    pages = spark.createDataFrame([("1", "A", None), ("2", "B", "1"), ("3", "C", "2"), ("4", "D", "9"), ("5", "E", "6"), ("6", "F", "5")], "id string, title string, parent_id string")
    assert {r.id: r.breadcrumb for r in breadcrumbs(pages).collect()} == {"1": "A", "2": "A / B", "3": "A / B / C", "4": "D", "5": "E / F / E", "6": "F / E / F"}


def test_breadcrumbs_of_any_depth(spark):
    """Against walking up, with cycles that pages hang on."""
    parent = {i: i - 1 for i in range(1, 201)} | {300: 303, 301: 300, 302: 301, 303: 302, 304: 301, 305: 304, 306: 306, 307: 306, 400: 999}
    pages = spark.createDataFrame([(str(i), f"t{i}", None if p is None else str(p)) for i, p in ({0: None} | parent).items()], "id string, title string, parent_id string")
    want = {}
    for i in {0: None} | parent:
        path, seen, at = [i], set(), parent.get(i)
        while at is not None and at not in seen and (at in parent or at == 0):
            seen.add(at)
            path.append(at)
            at = parent.get(at)
        want[str(i)] = " / ".join(f"t{x}" for x in reversed(path))
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    assert {r.id: r.breadcrumb for r in breadcrumbs(pages).collect()} == want and want["200"].count("/") == 200
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before


def test_wiki_table(spark):
    pages = spark.createDataFrame([("1", "A", "current", None, "2024-01-02T03:04:05Z", "<p>x</p>", "/1"), ("2", "B", "archived", "1", None, None, None)], "id string, title string, status string, parent_id string, created_at string, html string, webui string")
    labels = spark.createDataFrame([("1", "z"), ("1", "y")], "page_id string, name string")
    (row,) = raw_documents(pages, "K", "https://x", labels).collect()
    assert (row.source_id, row.content, row.labels, row.url, row.last_modified.year) == ("confluence:K:1", "x", ["y", "z"], "https://x/1", 2024)


def test_html():
    assert to_markdown("<h1>A &amp; b</h1><p>x <b>y</b><br>z</p><ul><li>one</li><li><a href='/u'>two</a></li></ul><pre>q\n  r</pre><style>no</style>") == "# A & b\n\nx **y**  \nz\n\n*   one\n*   [two](/u)\n\n```\nq\n  r\n```"
    assert to_markdown("") == "" and to_markdown("plain") == "plain"


class Scripted:
    """Refuses texts with a marker; is rate-limited as often as told."""

    def __init__(self, limited=0):
        self.limited, self.calls = limited, []

    def __call__(self, texts, task=embed.PASSAGE):
        self.calls.append(len(texts))
        if self.limited:
            self.limited -= 1
            raise embed.RateLimited()
        if any("BAD" in t for t in texts):
            raise OSError("refused")
        return [[1.0, 0.0] if "a" in t else [0.0, 1.0] for t in texts]


def test_embedding_falls_back():
    slept = []
    assert embed.embed_texts(Scripted(2), ["a", "b"], sleep=slept.append) == [[1.0, 0.0], [0.0, 1.0]] and len(slept) == 2 and 1 <= slept[0] < 1.5 and 2 <= slept[1] < 2.5
    text = "a" * 300 + "\n" + "b" * 100 + "BAD" + "b" * 97
    one, two, three = embed.embed_texts(Scripted(), [text, "BAD", "b"])
    assert two is None and three == [0.0, 1.0] and one[0] > 0.8
    with pytest.raises(embed.RateLimited):
        embed.patiently(lambda: Scripted(9)(["a"]), slept.append)
    assert embed.split_at("ab\ncd") == 2 and embed.split_at("abcd") == 2 and embed.mean_of([1.0, 0.0], [-1.0, 0.0], 1, 1) == [0.0, 0.0]
    assert Scripted().calls == [] and len(embed.embed_texts(Scripted(), ["b"] * 300)) == 300


def test_http_embedder():
    def post(url, headers, body):
        sent = json.loads(body)
        if sent["input"] == ["slow"]:
            return 429, b"later"
        return 200, json.dumps({"data": [{"index": i, "embedding": [float(i)]} for i in reversed(range(len(sent["input"])))]}).encode()

    e = embed.HttpEmbedder("u", "k", "m", post=post)
    assert e(["x", "y"]) == [[0.0], [1.0]]
    with pytest.raises(embed.RateLimited):
        e(["slow"])


def files(spark, tmp_path, **texts):
    for name, text in texts.items():
        (tmp_path / "repo").mkdir(exist_ok=True)
        (tmp_path / "repo" / f"{name}.py").write_text(text)
    return read_checkout(spark, f"file://{tmp_path}/repo", "o/r")


def test_sync_from_end_to_end(spark, tmp_path):
    table, edges, embedder = Snapshots(spark, f"file://{tmp_path}/chunks"), f"file://{tmp_path}/edges", embed.HashEmbedder(16)
    docs = files(spark, tmp_path, one="def load(x):\n    return save(x)\n\ndef gone():\n    pass\n", two="def save(x):\n    return x\n")
    assert ingest.run(docs, table, edges, embedder) == {"indexed": 2, "skipped": 0, "failed": 0}
    assert {r.symbol_name for r in table.read().collect()} == {"load", "gone", "save"}
    assert ingest.run(docs, table, edges, embedder) == {"indexed": 0, "skipped": 2, "failed": 0}
    docs = files(spark, tmp_path, one="def load(x):\n    return save(x) + 1\n")
    assert ingest.run(docs, table, edges, embedder) == {"indexed": 1, "skipped": 1, "failed": 0}
    stored = table.read()
    assert {r.symbol_name for r in stored.collect()} == {"load", "save"}
    found = tools.search_code(stored, embedder, "load save", "o/r", 5)
    assert found.startswith("1. [score 0.0") and "one.py :: load (function)\nhttps://github.com/o/r/blob/main/one.py#L1-L2\n```\ndef load(x):" in found
    assert tools.search_code(stored, embedder, "load", limit=99).startswith("search_code failed: limit")
    assert tools.search_code(stored, embedder, "x", repo="none") == "No matching code found."
    told = tools.get_symbol_context(edges_of(spark, edges), stored, "load", "o/r")
    assert told.startswith('Symbol graph for "load" in o/r (matched: o/r:one.py:load)\n\nCalls:\n- two.py :: save\n') and told.endswith("```")
    assert tools.get_symbol_context(edges_of(spark, edges), stored, "nope", "o/r") == 'No symbol matching "nope" found in the symbol graph for o/r.'


def test_failed_source_loses_its_chunks(spark, tmp_path):
    table, edges = Snapshots(spark, f"file://{tmp_path}/chunks"), f"file://{tmp_path}/edges"
    ingest.run(files(spark, tmp_path, one="def a():\n    pass\n"), table, edges, embed.HashEmbedder(4))
    def refuse(texts, task=embed.PASSAGE):
        raise OSError("refused")

    assert ingest.run(files(spark, tmp_path, one="def b():\n    pass\n"), table, edges, refuse) == {"indexed": 0, "skipped": 0, "failed": 1}
    assert table.read().count() == 0


def test_files_that_cannot_be_fetched(spark, tmp_path):
    """A failed fetch is counted as failed, no content as skipped; what is stored of them stays."""
    from pyspark.sql import functions as F

    from siltstone.sources.repository import FETCHED, Reader

    table, edges, embedder = Snapshots(spark, f"file://{tmp_path}/chunks"), f"file://{tmp_path}/edges", embed.HashEmbedder(4)
    docs = files(spark, tmp_path, one="def a():\n    return b()\n", two="def b():\n    pass\n", three="def c():\n    pass\n")
    assert ingest.run(docs, table, edges, embedder)["indexed"] == 3 and edges_of(spark, edges).count() == 1
    path = F.col("file_path")
    lost = docs.withColumn("fetch_error", F.when(path == "one.py", "OSError: 500")).withColumn("content", F.when(path == "three.py", F.lit("def d():\n    pass\n"))).withColumn("content_hash", F.sha2("content", 256))
    assert ingest.run(lost, table, edges, embedder) == {"indexed": 1, "skipped": 1, "failed": 1}
    assert {r.symbol_name for r in table.read().collect()} == {"a", "b", "d"}

    class Failing(Reader):
        def _connector(self, ref=None):
            def fetch(path):
                if path == "bad.py":
                    raise OSError("500")
                return None if path == "none.py" else {"source_id": path, "content": "x", "last_modified": "2024-05-01T00:00:00Z"}

            from types import SimpleNamespace

            return SimpleNamespace(list=lambda: ["bad.py", "none.py", "ok.py"], ref="main", fetch=fetch, provider="github", target=parse_target("o/r"))

    reader = Failing({"target": "o/r"})
    rows = [dict(zip(FETCHED.names, r, strict=True)) for part in reader.partitions() for r in reader.read(part)]
    assert {r["source_id"]: (r["content"], r["fetch_error"]) for r in rows} == {"github:o/r:bad.py": (None, "OSError: 500"), "github:o/r:none.py": (None, None), "ok.py": ("x", None)}


def test_a_lost_repository_keeps_no_edge(spark, tmp_path):
    table, edges, embedder = Snapshots(spark, f"file://{tmp_path}/chunks"), f"file://{tmp_path}/edges", embed.HashEmbedder(4)
    ingest.run(files(spark, tmp_path, one="def a():\n    return b()\n", two="def b():\n    pass\n"), table, edges, embedder)
    assert edges_of(spark, edges).count() == 1
    ingest.run(files(spark, tmp_path, one="def a():\n    return 1\n"), table, edges, embedder)
    assert edges_of(spark, edges).count() == 0


def test_stream(spark, tmp_path):
    from siltstone.schema import RAW_DOCUMENT

    table = Snapshots(spark, f"file://{tmp_path}/chunks")
    files(spark, tmp_path, one="def a():\n    pass\n").write.parquet(f"{tmp_path}/in/1")
    stream = spark.readStream.schema(RAW_DOCUMENT).parquet(f"{tmp_path}/in/*")
    for _ in range(2):
        sync.start(stream, table, f"{tmp_path}/edges", embed.HashEmbedder(4), f"{tmp_path}/cp", once=True).awaitTermination(120)
    assert [r.symbol_name for r in table.read().collect()] == ["a"]


def test_data_source_is_registered(spark):
    register(spark)
    with pytest.raises(Exception, match="target"):
        spark.read.format("siltstone_repository").load().count()


@pytest.mark.parametrize("operator", ["markdown", "embedded", "code"])
def test_workers_get_few_bytes_at_once(spark, operator):
    @F.pandas_udf("long")
    def together(x: pd.Series) -> pd.Series:
        return pd.Series([len(x)] * len(x))

    for key in ("maxRecordsPerBatch", "maxBytesPerBatch"):
        spark.conf.unset(f"spark.sql.execution.arrow.{key}")
    long = spark.range(0, 200, 1, 1).select(F.col("id").cast("string").alias("source_id"), F.repeat(F.lit("word "), 20_000).alias("content"), F.lit("f.py").alias("file_path"), F.lit("python").alias("language"))
    made = {"markdown": lambda: with_markdown(long, F.col("content")), "embedded": lambda: embed.embedded(long, embed.HashEmbedder(4)), "code": lambda: chunk_code(long)}[operator]()
    assert made.select(F.max(together("content"))).first()[0] <= 40  # of 100 KB each
    short = spark.range(0, 5_000, 1, 1).select(F.col("id").cast("string").alias("content"))
    assert short.select(F.max(together("content"))).first()[0] <= 1_000
