"""Substring deduplication against brute force: windows as tuples of words."""

import hashlib
import random
import re
import time

import pytest

from siltstone.llm import substring


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_removed(docs, window):
    first = {}
    for i, t in docs:
        w = words_of(t)
        for p in range(len(w) - window + 1 if i is not None else 0):
            k = tuple(w[p : p + window])
            first[k] = min(first.get(k, i), i)
    out = []
    for i, t in docs:
        w = words_of(t)
        gone = [False] * len(w)
        for p in range(len(w) - window + 1 if i is not None else 0):
            if first[tuple(w[p : p + window])] < i:
                gone[p : p + window] = [True] * window
        out.append((i, len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone, strict=True) if not g).encode()).hexdigest()))
    return sorted(out, key=repr)


def removed(df, **options):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring.deduplicate_digests(df, **options).collect()), key=repr)


def stands_where_it_says(docs, rows):
    """Every span's words are those of its reference from the place it names, and the reference is smaller."""
    by_id = {}
    for i, t in docs:
        by_id.setdefault(i, []).append(words_of(t))
    return all(
        s.ref < r.doc_id and any(own[s.start : s.start + s.words] == ref[s.ref_start : s.ref_start + s.words] for own in by_id[r.doc_id] for ref in by_id[s.ref]) for r in rows for s in r.spans
    )


@pytest.mark.parametrize("most_bloom", [1 << 10, 1 << 29])  # many parts of anchors, or one
@pytest.mark.parametrize("window", [3, 8])
def test_windows(make, window, most_bloom):
    rng = random.Random(window)
    base = [rng.choice("abcd") for _ in range(400)]
    docs = [(99, None), (98, ""), (-5, "a b " * 40), (97, "\t".join(["a", "b"] * 40))]
    for i in range(90):
        a, n = rng.randint(0, 300), rng.randint(0, 40)
        words = base[a : a + n]
        for _ in range(rng.randint(0, 2) if words else 0):
            words[rng.randrange(len(words))] = rng.choice("abcdxyz")
        docs.append((rng.choice([None, i, i, i, i // 2]), rng.choice([" ", "  ", "\n"]).join(words)))
    df = make(*docs).repartition(5)
    assert removed(df, window=window, most_bloom=most_bloom) == brute_removed(docs, window)
    single = list({i: (i, t) for i, t in docs if i is not None}.values())  # a reference is named by its id alone
    assert stands_where_it_says(single, substring.deduplicate(make(*single).repartition(5), window=window, most_bloom=most_bloom).collect())


def test_factors_have_one_place_in_one_block(make):
    got = {r.doc_id: r for r in substring.deduplicate(make((1, "a b c x b c d"), (2, "a b c d")), window=3).collect()}
    assert [tuple(s) for s in got[2].spans] == [(0, 3, 1, 0), (1, 3, 1, 4)] and got[2].n_removed == 4 and got[1].spans == []


def test_parse_extends_along_one_block():
    # windows 0-3 in block 1 from 10, window 4 in block 1 from elsewhere, 5-6 in block 2, 9 in block 2 at the same offset
    hits = [(0, 2, 1, 10), (2, 2, 1, 12), (4, 1, 1, 30), (5, 2, 2, 7), (9, 1, 2, 11)]
    assert substring.parse(hits[::-1], 5) == [(0, 8, 1, 10), (4, 5, 1, 30), (5, 6, 2, 7), (9, 5, 2, 11)]


def thue_morse(n, a, b):
    return "".join(a if bin(i).count("1") % 2 == 0 else b for i in range(n))


def test_words_that_polynomial_hashes_confuse(make):
    x, y = thue_morse(2048, "a", "b"), thue_morse(2048, "b", "a")
    rest = [f"w{i}" for i in range(60)]
    docs = [(1, " ".join([*rest[:30], x, *rest[30:]])), (2, " ".join([*rest[:30], y, *rest[30:]])), (3, " ".join([*rest[:30], y, *rest[30:]]))]
    got = removed(make(*docs))
    assert got == brute_removed(docs, 50) and [g[2] for g in got] == [0, 0, 61]


def test_many_rows_of_one_id(make):
    def seconds(n):
        rng = random.Random(n)
        docs = [(5, " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(100))) for _ in range(n)] + [(6, "x " * 60)] * 2 + [(4, "x " * 60)]
        df = make(*docs).cache()
        df.count()
        began = time.perf_counter()
        got = substring.deduplicate_digests(df).collect()
        assert len(got) == n + 3 and all(r.n_removed == (60 if r.doc_id == 6 else 0) for r in got)
        return time.perf_counter() - began

    seconds(10)
    assert seconds(1000) < 6 * max(seconds(250), 1.0)


def test_spans_and_texts(make, tiny):
    a, b, c = ([f"{k}{i}" for i in range(60)] for k in "abc")
    docs = make((1, " ".join(a)), (2, " ".join(b)), (3, "x  y\n" + " ".join(a[:55] + b[3:] + c)), (4, " ".join(c)))
    got = {r.doc_id: r for r in substring.deduplicate(docs, carry=("rank", "n_chars")).collect()}
    assert [tuple(s) for s in got[3].spans] == [(2, 55, 1, 0), (57, 57, 2, 3)] and got[3].kept == "x y " + " ".join(c) and got[3].rank == "x"
    assert got[4].n_removed == 60 and got[4].kept == "" and [tuple(s) for s in got[4].spans] == [(0, 60, 3, 114)] and got[1].kept == " ".join(a)
    rows = substring.deduplicate(tiny).collect()
    assert len(rows) == 13 and {r.doc_id: r.n_removed for r in rows}[8] == 120_000 and {r.doc_id: r.kept for r in rows}[2] is None
    assert substring.deduplicate(tiny.filter("false")).count() == 0


def test_texts_without_repeats_are_not_shuffled(make, spark):
    rng = random.Random(8)
    words = lambda n: " ".join(f"{rng.getrandbits(48):012x}" for _ in range(n))
    docs = [(i, words(300)) for i in range(500)]
    docs += [(1000 + i, f"{words(20)} {docs[i][1]}") for i in range(10)]
    df = make(*docs).repartition(4).cache()
    df.count()
    shuffled = lambda: sum(e.totalShuffleWrite() for e in list_of(spark.sparkContext._jsc.sc().statusStore().executorList(True)))
    list_of = lambda seq: [seq.apply(i) for i in range(seq.size())]
    least = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        before = shuffled()
        assert removed(df) == brute_removed(docs, 50)
        assert 0 < shuffled() - before < sum(len(t) for _, t in docs) / 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", least)
        df.unpersist()
