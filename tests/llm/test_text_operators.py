"""Operators that treat each document by itself, against the libraries or plain Python."""

import hashlib
import random
import weakref
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from siltstone.llm import chunk_reuse, classifier, language_id, packing, token_counts
from siltstone.llm.entries import tokenizer_path
from siltstone.llm.shared import by_bytes, cleared, kept, mixed, run_hashes, word_hashes
from siltstone.llm.tokenizing import PieceEncoder, encoder

BYTE, WORD = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("word_bpe_49k.json")
ODD = ["", " ", "\n\n  a  b \t c  d", "<|endoftext|>a <|endoftext|> b<|startoftext|>c", "it's we'RE ½ ² x́ é İstanbul ΣΑΣ 日本語 テスト　全角", "!!\x1c\x1d a\x1c b", "a b   c", "😀 👍🏽 don't \r\n\r\n x ", "  lead", "trail  ", "q" * 9000, "ab cd " * 3000, "\x85 x\x85"]


def sample(n=150, size=60, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice("ab \n\t'sé½日 !<|>Eendoftext") for _ in range(rng.randint(1, size))) for _ in range(n)]


def library(path, texts):
    t = Tokenizer.from_file(path)
    return [np.array(x.ids, "<u4").tobytes() for x in t.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_pieces_encode_as_the_library(path):
    texts = [*ODD, *sample(), *sample(5, 6000, 2)]
    assert PieceEncoder(path).ids(texts) == library(path, texts)
    small = PieceEncoder(path, entries=3)  # a cache that turns over all the time
    assert [small.ids([t])[0] for t in texts] == library(path, texts)
    assert max(map(len, [*small.matches, *small.first, *small.spaced]), default=0) <= 64  # long parts are not kept


@pytest.mark.parametrize("path", [BYTE, WORD, tokenizer_path("piece_bpe_32k.model")])
@pytest.mark.parametrize("batch", [50, 1 << 20])
def test_batches_count_as_the_library(path, batch):
    texts = [*ODD, *sample(), *sample(5, 6000, 2)]
    if path.endswith(".model"):
        import sentencepiece

        want = list(map(len, sentencepiece.SentencePieceProcessor(model_file=path).encode(texts)))
    else:
        want = [len(x) // 4 for x in library(path, texts)]
    counter = token_counts.BatchCounter(path, batch, entries=40)
    assert counter.counts(texts) == want == counter.counts(texts)
    assert counter.batches > 100 if batch == 50 else counter.batches < 5


def test_sentencepiece_whole():
    import sentencepiece

    path = tokenizer_path("piece_bpe_32k.model")
    want = sentencepiece.SentencePieceProcessor(model_file=path).encode(ODD, num_threads=1)
    assert PieceEncoder(path).ids(ODD) == [np.array(x, "<u4").tobytes() for x in want]


def test_chunks_are_repaired_exactly():
    rng = random.Random(3)
    shared = "".join(rng.choice("abc def. éx\n") for _ in range(4000))
    texts = [*ODD, *sample(5, 9000, 4), "x" + shared, shared + "y", "zz " + shared[100:]]
    enc = chunk_reuse.ChunkEncoder(BYTE)
    ids, n = enc.ids(texts)
    assert ids == library(BYTE, texts) and [enc.decode(x) for x in ids] == [t.encode() for t in texts] and max(k for k, _ in n) > 3
    assert n[-3][1] < n[-3][0] and n[-2][1] >= 2 and enc.grown == 0  # the second text has chunks of the first
    again, known = enc.ids(texts)
    assert again == ids and all(a == b for (a, b), t in zip(known, texts, strict=True) if t)  # all chunks are known now
    a, b = ([c for c in np.split(np.frombuffer(t.encode(), np.uint8), chunk_reuse.cuts(t.encode())[:-1])] for t in texts[-3:-1])
    assert len({x.tobytes() for x in a} & {x.tobytes() for x in b}) >= 2  # content decides where chunks end
    assert enc.decode(np.array([255 - 67], "<u4").tobytes()) != b""


def test_windows_grow_until_they_agree(monkeypatch):
    """Seams that are none make windows and chunks disagree; growing over the chunks still gives the library's ids."""
    monkeypatch.setattr(chunk_reuse, "SEAM", chunk_reuse.re.compile(rb"(?<=[!-~])[a-z \t-\r]"))
    rng = random.Random(3)
    texts = ["".join(rng.choice("abc defgh. \n") for _ in range(5000)) for _ in range(20)]
    enc = chunk_reuse.ChunkEncoder(BYTE)
    ids, n = enc.ids(texts)
    assert ids == library(BYTE, texts) and max(k for k, _ in n) > 3


def test_reuse_over_documents(spark):
    got = chunk_reuse.encode_decode_digests(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").coalesce(1), BYTE).collect()
    assert 0.02 < sum(r.n_reused for r in got) / sum(r.n_chunks for r in got) < 0.9


def test_token_counts(tiny):
    got = token_counts.token_counts(tiny, BYTE, limit=20).collect()
    rows = {(r.doc_id, r.text) for r in tiny.collect()}
    t = Tokenizer.from_file(BYTE)
    want = {k: (len((x or "").encode()), len(t.encode(x or "", add_special_tokens=False).ids)) for k, x in rows}
    assert len(got) == 13 and all((r.n_bytes, r.n_tokens) == want[r.doc_id] and r.over_limit == (r.n_tokens > 20) for r in got)
    assert token_counts.token_counts(tiny.filter("false"), BYTE).count() == 0


def test_encode_decode(tiny):
    got = chunk_reuse.encode_decode_digests(tiny, BYTE).collect()
    texts = {r.doc_id: r.text or "" for r in tiny.collect()}
    ids = dict(zip(texts, library(BYTE, list(texts.values())), strict=True))
    assert len(got) == 13
    for r in got:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids[r.doc_id]) // 4, hashlib.sha256(ids[r.doc_id]).hexdigest(), hashlib.sha256(texts[r.doc_id].encode()).hexdigest())
    assert {r.doc_id: bytes(r.ids) for r in chunk_reuse.encode_decode(tiny, BYTE).collect()} == ids


def test_closest_sum_is_the_best():
    rng = random.Random(9)
    for _ in range(200):
        counts = {rng.randint(1, 30): rng.randint(1, 3) for _ in range(rng.randint(1, 6))}
        room = rng.randint(0, 60)
        sums = {0}
        for size, n in counts.items():
            sums = {s + size * k for s in sums for k in range(n + 1)}
        found = packing.closest(sorted(counts, reverse=True), counts, room)
        assert sum(a * n for a, n in found) == max(s for s in sums if s <= room) and all(n <= counts[a] for a, n in found)


@pytest.mark.parametrize("capacity", [1, 7, 64, 4096])
def test_packing(tiny, capacity):
    if capacity < 64:
        tiny = tiny.filter("length(text) < 100 or text is null")
    got = packing.pack(tiny, WORD, capacity=capacity).collect()
    docs = tiny.select("doc_id", "text").collect()
    ids = Counter()
    encoded = {r.doc_id: library(WORD, [r.text or ""])[0] + (2).to_bytes(4, "little") for r in docs}
    for r in docs:
        ids[r.doc_id] += len(encoded[r.doc_id]) // 4
    assert Counter({k: sum(r.length for r in got if r.doc_id == k) for k in ids}) == ids
    for r in got:
        assert zlib.crc32(encoded[r.doc_id][4 * r.start : 4 * (r.start + r.length)]) == r.ids_crc32 and r.doc_tokens == len(encoded[r.doc_id]) // 4
    seqs = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == seqs.get(r.sequence_id, 0)
        seqs[r.sequence_id] = r.offset + r.length
    assert all(n <= capacity and n & (n - 1) == 0 or n == capacity for n in seqs.values())
    assert packing.pack(tiny.filter("false"), WORD).count() == 0


def test_workers_drop_encoders():
    """An encoder and its caches go as soon as something else is kept, or nothing; one of few entries finds the same."""
    texts = [*ODD, *sample()]
    first = encoder(WORD, 5)
    assert first.ids(texts) == first.ids(texts) == library(WORD, texts)
    gone = weakref.ref(first)
    assert encoder(WORD, 5) is first
    del first
    second = encoder(BYTE, 5)
    assert gone() is None and second.ids(texts) == library(BYTE, texts)
    gone = weakref.ref(second)
    del second
    assert kept(("other",), lambda: 7) == 7 and gone() is None
    cleared()


def prose(rng, n, words):
    return " ".join(rng.choice(words) for _ in range(n)) + "."


def test_classifier(make, tiny):
    rng = random.Random(6)
    good = [prose(rng, 60, ["river", "stone", "light", "cloud", "walks", "softly"]) for _ in range(300)]
    bad = [" ".join(w.upper() + "!!" for w in prose(rng, 60, ["buy", "now", "cheap", "click"]).split()) for _ in range(100)]
    docs = make(*enumerate(good + bad), (1000, None), (1001, ""))
    spark = docs.sparkSession
    labels = spark.createDataFrame([(i, int(i < 300)) for i in range(400)] + [(5, None), (None, 1), (9999, 0)], "doc_id long, quality int")
    rows = classifier.held_out_quality(docs, labels).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == 402 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id < 400]
    assert 100 < len(held) < 170 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert sum(r.predicted == int(r.doc_id < 300) for r in held) / len(held) > 0.97 and got[1000].score == got[1001].score
    again = {r.doc_id: r.score for r in classifier.held_out_quality(docs.repartition(7), labels.repartition(3)).collect()}
    assert max(abs(again[k] - got[k].score) for k in again) < 1e-6  # whatever order tasks end in
    none = classifier.held_out_quality(tiny, labels.filter("false")).collect()
    assert len(none) == 13 and {r.score for r in none} == {0.5}
    one = classifier.held_out_quality(docs, labels.filter("quality = 1")).collect()
    assert {r.score for r in one} == {1.0}
    assert classifier.held_out_quality(docs.filter("false"), labels).count() == 0
    model = classifier.train(docs, labels)
    every, kept = docs.unionByName(tiny), classifier.good(docs.unionByName(tiny), model)
    want = Counter(r.doc_id for r in classifier.score(every, model).filter("predicted = 1").collect())
    assert Counter(r.doc_id for r in kept.collect()) == want and 0 < sum(want.values()) < every.count() and kept.columns == every.columns
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan


def test_held_out_quality_of_the_tables(spark):
    """Ranking and accuracy on the fold that the network did not learn from, and how far scores are from frequencies."""
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = [r for r in classifier.held_out_quality(spark.read.parquet(f"{sf}/documents.parquet"), labels).filter("held_out").join(labels, "doc_id").collect()]
    bad, good = ([r.score for r in rows if r.quality == q] for q in (0, 1))
    assert sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad)) > 0.97
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.95


def test_held_out_languages_of_the_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language_id.held_out_languages(docs).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id").filter("lang is not null and lang_pred <> 'und'").collect()
    assert len(rows) > 100 and sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.98


def test_profiles_by_counting(make):
    docs = [(1, "ab ab", "x"), (2, "Ba, 7 ab", "x"), (3, "zz", "y"), (4, None, "y"), (5, "q", None)]
    want = {}
    for _, t, lang in docs:
        if t and lang:
            line = " " + " ".join(w for w in "".join(c if c.isalpha() else " " for c in t.lower()).split()) + " "
            grams = [c for c in line if c != " "] + [line[i : i + 2] for i in range(len(line) - 1)] + [line[i : i + 3] for i in range(len(line) - 2)]
            want.setdefault(lang, Counter()).update(grams)
    key = lambda g: sum(ord(c) << (21 * (len(g) - 1 - i)) for i, c in enumerate(g))
    got = language_id.profiles(make(*docs), most=9)
    assert {k: v.tolist() for k, v in got} == {k: [key(g) for g in sorted(c, key=lambda g: (-c[g], key(g)))[:9]] for k, c in want.items()}


def test_pooled_vectors_by_hand():
    """Context sums, pooling and temperature against loops."""
    texts = ["Ab ab, cd!! 12", None, "", "cd ab"]
    words, shape, at = classifier.tokens(texts)
    assert np.diff(at).tolist() == [6, 0, 0, 2] and words[0] == words[1] and shape[0] == 1 and shape[3] == 0
    rows, text = classifier.buckets(words), np.repeat(np.arange(4), np.diff(at))
    sums = np.zeros(classifier.BUCKETS * classifier.DIMS)
    classifier.add_contexts(sums, rows, words, text)
    want = np.zeros((classifier.BUCKETS, classifier.DIMS))
    for i in range(len(words)):
        for step in (1, 2):
            for j, salt in ((i + step, step), (i - step, 64 + step)):
                if 0 <= j < len(words) and text[i] == text[j]:
                    h = int(classifier.mixed(words[j : j + 1] + np.uint64(salt))[0])
                    for shift in (0, 16):
                        want[rows[i], (h >> shift) % classifier.DIMS] += 1 if h >> (shift + 15) & 1 else -1
    assert (sums.reshape(want.shape) == want).all()
    rng = np.random.default_rng(1)
    v, w = rng.normal(size=(classifier.BUCKETS, classifier.DIMS)).astype(np.float32), rng.uniform(0.1, 1, classifier.BUCKETS).astype(np.float32)
    x = classifier.pooled(texts, v, w)
    own = range(at[0], at[1])
    assert np.allclose(x[0, : classifier.DIMS], sum(v[rows[i]] for i in own) / sum(w[rows[i]] for i in own), atol=1e-4)
    assert np.allclose(x[0, classifier.DIMS :], sum(v[shape[i]] for i in own) / 6, atol=1e-4) and not x[1].any() and not x[2].any()


def test_temperature_calibrates():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, 4))
    y = (rng.uniform(size=4000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(int)
    held = np.arange(4000) % 5 == 0
    net = classifier.Network().fit(x, y, held)
    p = net(x[held])
    loss = lambda t: np.logaddexp(0, np.where(y[held] == 1, -1, 1) * net.logit(x[held]) / t).mean()
    assert loss(net.temperature) <= min(map(loss, np.linspace(0.3, 6, 40))) + 1e-4
    bins = np.minimum((p * 5).astype(int), 4)
    assert sum(abs(p[bins == b].mean() - y[held][bins == b].mean()) * (bins == b).mean() for b in range(5) if (bins == b).any()) < 0.06


def test_languages(make, tiny):
    rng = random.Random(8)
    words = {"en": ["the", "house", "with", "thing", "water"], "de": ["der", "schnee", "nicht", "größe", "haus"], "fr": ["être", "maison", "avec", "où", "chien"]}
    docs = [(i, prose(rng, 40, words[k]), k) for i, k in enumerate(["en", "de", "fr"] * 40)]
    docs += [(500, None, "en"), (501, "12 345 !?", "en"), (502, "THE HOUSE WITH WATER", None), (503, "", None)]
    got = {r.doc_id: r for r in language_id.held_out_languages(make(*docs)).collect()}
    assert all(got[i].lang_pred == k for i, _, k in docs[:120]) and got[502].lang_pred == "en"
    assert [(got[i].lang_pred, got[i].score) for i in (500, 501, 503)] == [("und", 0.0)] * 3
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got.values())
    assert language_id.held_out_languages(tiny).count() == 13 and language_id.held_out_languages(tiny.filter("false")).count() == 0
    assert {r.lang_pred for r in language_id.predict(tiny, []).collect()} == {"und"}


def test_ranks_and_distance_by_hand():
    keys = language_id.grams("ab, ab!")
    ranked = language_id.ranked(keys, 10)
    a, b, blank = ord("a"), ord("b"), 32
    assert Counter(keys.tolist()) == Counter([a, b, a, b, blank << 21 | a, a << 21 | b, b << 21 | blank, blank << 21 | a, a << 21 | b, b << 21 | blank] + [(blank << 21 | a) << 21 | b] * 2 + [(a << 21 | b) << 21 | blank] * 2 + [(b << 21 | blank) << 21 | a])
    assert ranked[-1] == (b << 21 | blank) << 21 | a
    c = language_id.Classifier([("x", ranked[::-1].copy()), ("y", ranked)])
    assert c("ab, ab!") == ("y", 1.0) and language_id.Classifier([("x", ranked[::-1].copy())])("ab, ab!")[1] == pytest.approx(1 - sum(abs(i - (len(ranked) - 1 - i)) for i in range(len(ranked))) / len(ranked) ** 2)


def test_helpers():
    assert list(by_bytes(["a" * 5, None, "b" * 9, "c"], 6)) == [(0, 2), (2, 3), (3, 4)] and list(by_bytes([])) == []
    raw = np.frombuffer(b"abcabc", np.uint8)
    h = word_hashes(raw, np.array([0, 3, 1, 0]), np.array([3, 6, 4, 0]))
    assert h[0] == h[1] != h[2] and len(set(h.tolist())) == 3
    long = np.frombuffer(b"x" * 100 + b"y" + b"x" * 100 + b"z", np.uint8)
    assert len(set(word_hashes(long, np.array([0, 101, 0, 0, 0]), np.array([101, 202, 100, 63, 9])).tolist())) == 5
    assert list(by_bytes(["é" * 5, "a"], 10)) == [(0, 1), (1, 2)]  # bytes, not characters
    words = mixed(np.arange(40, dtype=np.uint64))
    twice = np.concatenate([words, words])
    for width in (1, 2, 3, 5, 8, 25, 40):
        runs = run_hashes(twice, width)
        assert len(runs) == 80 - width + 1 and runs[0] == runs[40 if width <= 40 else 0] and len(set(runs.tolist())) == 40
    assert len(run_hashes(words, 41)) == 0
