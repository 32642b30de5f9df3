"""Scanners and code chunks on the sample files, which hold the cases of each language, and on files of special shapes."""

import time

from pyspark.sql import functions as F

from siltstone.operators.code import java, python, typescript
from siltstone.operators.code_chunks import chunk_code, found_array, line_starts, scanned
from siltstone.samples import BARE, BROKEN, JAVA, PYTHON, SCRIPT


def by_name(found):
    return {s.name: s for s in found.symbols}


def lines(source, s):
    return source.count("\n", 0, s.start) + 1, source.count("\n", 0, s.end) + 1


def test_typescript():
    found = typescript.scan(SCRIPT)
    s = by_name(found)
    assert found.imports == ["Ledger", "clock", "defaults", "pick", "choose"]
    assert list(s) == ["Amount", "Entry", "useTotals", "Line", "round", "saveEntry", "DELETE /entries/:id"]
    assert [x.kind for x in s.values()] == ["type", "interface", "function", "component", "function", "endpoint", "endpoint"]
    assert s["Entry"].exported and not s["Amount"].exported and s["Line"].exported and not s["useTotals"].exported
    assert s["useTotals"].markers == ["react-hook"] and s["useTotals"].calls == ["choose", "now", "total"]
    assert s["Line"].markers == ["react-component"] and s["Line"].comment == "// one line of the book" and s["Line"].calls == ["useTotals", "mark", "format"]
    assert s["saveEntry"].route == "PUT /entries" and s["saveEntry"].markers == ["express-route"] and s["saveEntry"].calls == ["valid", "put"]
    assert s["DELETE /entries/:id"].calls == ["delete", "then", "drop", "sendStatus"] and not s["DELETE /entries/:id"].exported
    assert lines(SCRIPT, s["useTotals"]) == (17, 20) and lines(SCRIPT, s["Line"]) == (23, 26)


def test_typescript_shapes():
    found = by_name(typescript.scan("class Till<T> extends Box<T> implements Holds, Shuts<T> {\n  put(x: T): void { this.keep(x); }\n}\nconst a = (x) => x, B = () => <p>{go()}</p>;\nvar old = function () {};\nfunction* many() {}\n"))
    assert list(found) == ["Till", "a", "B"] and found["Till"].extends == ["Box"] and found["Till"].implements == ["Holds", "Shuts"] and found["Till"].calls == ["keep"]
    assert found["B"].kind == "component" and found["B"].calls == ["go"]


def test_java():
    found = java.scan(JAVA)
    s = by_name(found)
    assert found.package == "org.ledger" and found.imports == ["Clock", "add"]
    assert list(s) == ["Ledger.Ledger", "Ledger.sum", "Ledger.log", "Entries.byId", "Side", "Pair.both"]
    assert s["Ledger.sum"].kind == "endpoint" and s["Ledger.sum"].markers == ["spring-controller", "spring-endpoint"] and s["Ledger.sum"].comment == "/** All of it. */"
    assert s["Ledger.sum"].calls == ["reduce", "map", "stream", "weigh", "add"] and s["Ledger.sum"].exported
    assert not s["Ledger.log"].exported and s["Ledger.log"].calls == ["println", "trim"]
    assert s["Ledger.Ledger"].extends == ["Shelf"] and s["Ledger.Ledger"].implements == ["Countable", "Iterable"] and s["Ledger.Ledger"].calls == ["check"]
    assert s["Side"].kind == "class" and s["Pair.both"].kind == "method" and s["Entries.byId"].signature.startswith("@Repository")


def test_python():
    found = python.scan(PYTHON)
    s = by_name(found)
    assert found.imports == ["clock", "sums", "APIRouter", "route", "models"]
    assert list(s) == ["entry", "total", "change", "_round", "Entry", "EntryView.get", "EntryView._key"]
    assert s["entry"].route == "GET /entries/{id}" and s["entry"].markers == ["fastapi-endpoint"] and s["entry"].notes == '"""One entry."""'
    assert s["entry"].calls == ["first", "find", "weigh"] and lines(PYTHON, s["entry"]) == (10, 13)
    assert s["total"].markers == ["bottle-endpoint"] and s["total"].route == "POST /sum" and s["change"].route == "PUT/PATCH" and s["change"].markers == ["django-endpoint"]
    assert not s["_round"].exported and s["_round"].calls == ["floor", "inner"]
    assert s["Entry"].extends == ["Model"] and s["Entry"].markers == ["django-model"] and s["Entry"].kind == "class" and s["Entry"].calls == ["field", "max"]
    assert s["EntryView.get"].signature == "class EntryView(APIView, Countable):" and s["EntryView.get"].markers == ["django-view"] and not s["EntryView._key"].exported and s["EntryView._key"].indent == 4


def test_python_shapes():
    found = by_name(python.scan('from . import base\nsite = Flask(__name__)\n\n@site.route("/p", methods=["post", "put"])\n@log\ndef p():\n    "one" "two"\n    return f"{name(1)}"\n\nclass A(B, metaclass=M):\n    x = 1\n'))
    assert found["p"].route == "POST/PUT /p" and found["p"].notes == "" and found["p"].calls == ["name"] and found["A"].extends == ["B", "metaclass=M"]


def test_invalid_python_falls_back():
    assert [s.name for s in python.scan(BROKEN).symbols] == ["ok", "Half"]


def test_scanner_failure_is_a_message(monkeypatch):
    from siltstone.operators import code_chunks

    monkeypatch.setitem(code_chunks.SCANNERS, "java", lambda _: 1 / 0)
    found, error = scanned("class A {}", "java", "A.java")
    assert found.symbols == [] and "ZeroDivisionError" in error
    (row,) = found_array(["class A {}"], ["java"], ["A.java"]).to_pylist()
    assert row["error"] == error and [s["body"] for s in row["symbols"]] == ["class A {}"]


def test_lines_are_found_in_linear_time():
    assert line_starts("a\n\nb") == [0, 2, 3]

    def seconds(n):
        source = "".join(f"def f{i}(x):\n    return g{i}(x)\n\n\n" for i in range(n))
        began = time.perf_counter()
        (row,) = found_array([source], ["python"], ["a.py"]).to_pylist()
        assert len(row["symbols"]) == n and row["symbols"][-1]["start_line"] == 4 * n - 3
        return time.perf_counter() - began

    seconds(100)
    assert seconds(8000) < 16 * seconds(1000)


def test_chunks(spark):
    rows = [
        ("github:o/r:a.py", PYTHON, "o/r", "a.py", "python", "https://github.com/o/r/blob/main/a.py", "h1"),
        ("github:o/r:b.ts", BARE, "o/r", "b.ts", "typescript", "u", "h2"),
        ("github:o/r:c.java", None, "o/r", "c.java", "java", None, "h3"),
    ]
    docs = spark.createDataFrame(rows, "source_id string, content string, repo string, file_path string, language string, url string, content_hash string")
    chunks = chunk_code(docs)
    got = chunks.collect()
    assert len({r.chunk_id for r in got}) == len(got) == 8 and all(len(r.chunk_id) == 24 and r.error is None for r in got)
    key = next(r for r in got if r.symbol_name == "EntryView._key")
    assert key.display_content.startswith("    def _key") and key.url.endswith(f"#L{key.start_line}-L{key.end_line}")
    assert key.content.startswith("File: a.py\n\nImports:\nimport clock") and "\n\nClass: class EntryView(APIView, Countable):" in key.content
    entry = next(r for r in got if r.symbol_name == "entry")
    assert "\n\nRoute: GET /entries/{id}\n\n" in entry.content and '\n\n"""One entry."""\n\n@api.get' in entry.content
    whole = next(r for r in got if r.symbol_name is None)
    assert (whole.symbol_type, whole.start_line, whole.end_line, whole.url, whole.exported) == ("other", 1, 2, "u", False)
    assert whole.content == f"File: b.ts\n\n{BARE}" and whole.display_content == BARE
    plan = chunks._jdf.queryExecution().optimizedPlan().toString()
    generate = next(x for x in plan.splitlines() if "Generate explode" in x)
    assert "content#" not in generate.split("Generate", 1)[1]


def test_runs_of_bare_calls_need_no_tree():
    run = "".join(f"    c{i}()\n" for i in range(6))
    source = f"def f():\n{run}    return last(first())\n\ndef g():\n    \"\"\"\n{run}    \"\"\"\n    x = \\\n{run}    if x:\n{run.replace('    ', '        ')}{run}"
    runs = python.Runs(source)
    assert runs.short.count("\n") == source.count("\n") and len(runs.short) < len(source) - 60 and runs.lines
    found = {s.name: s for s in python.scan(source).symbols}
    six = [f"c{i}" for i in range(6)]
    assert found["f"].calls == [*six, "last", "first"] and lines(source, found["f"]) == (1, 8)
    assert found["g"].calls[:6] == six and found["g"].calls.count("c3") == 3 and len(found["g"].calls) == 18  # those of the string are no calls
    assert python.scan("def f():\n    a()\n    not()\n    b()\n    c()\n").symbols[0].calls == ["a", "b", "c"]


def test_bare_calls_are_read_fast():
    source = "".join(f"def f{i}():\n" + "    call()\n" * 2_000 + "    return 1\n" for i in range(50))
    began = time.process_time()
    tree = __import__("ast").parse(source)
    parsed = time.process_time() - began
    del tree
    began = time.process_time()
    found = python.scan(source)
    assert sum(len(s.calls) for s in found.symbols) == 100_000 and time.process_time() - began < parsed


def test_each_file_is_scanned_once(spark):
    docs = spark.createDataFrame([("a", "def f(): pass", "f.py", "python"), ("b", None, "g.py", "python")], "source_id string, content string, file_path string, language string")
    got = chunk_code(docs.withColumn("content", F.concat("content", F.lit("\n")))).filter("symbol_name is not null")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("found(") == 1 and plan.count("ArrowEvalPython") == 1
    assert [(r.source_id, r.symbol_name) for r in got.collect()] == [("a", "f")]
