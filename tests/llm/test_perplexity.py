"""Quality rules against plain Python: counts, Kneser-Ney by dictionaries, bands, verdicts."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from siltstone.llm import perplexity
from siltstone.llm.perplexity import BITS, EDGE, LOW, ORDER


def thue_morse(n, a, b):
    return "".join(a if bin(i).count("1") % 2 == 0 else b for i in range(n))


def plain(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    times, inside = Counter(zip(w, w[1:], w[2:])), set()
    for k in range(len(w) - 2):
        inside |= {k, k + 1, k + 2} if times[w[k], w[k + 1], w[k + 2]] > 1 else set()
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in perplexity.MARKS for c in t), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(inside)}


def test_counts_as_plain_python():
    rng = random.Random(2)
    texts = ["".join(rng.choice(["a", "b", "cc", "#", "é", " ", " ", "\n", "\t", "$%"]) for _ in range(rng.randint(0, 120))) for _ in range(300)] + [None, "", "a b c a b c", "x\nx\n \nx"]
    x, y = thue_morse(2048, "a", "b"), thue_morse(2048, "b", "a")
    texts += [f"{x}\n{y}\n{x} p q\n{y} p q", "q" * 70 + "a\n" + "q" * 70 + "b"]
    got = perplexity.plain_counts(texts)
    for i, t in enumerate(texts):
        assert {k: int(v[i]) for k, v in got.items()} == plain(t or "")
    assert got["n_dup_lines"][-2:].tolist() == [0, 0] and got["n_repeat_words"][-2] == 0


def test_symbols():
    line, at = perplexity.symbols(["Ab, c!! \n12", None, "日本 語"])
    one = line[at[0] : at[1]].tolist()
    assert one[:3] == [EDGE] * 3 and one[3:5] == [97, 98] and one[6] == 99 and one[8:] == [48, 48] and one[5] >= perplexity.FIRST_CLASS <= one[7] != one[5]
    assert line[at[1] : at[2]].tolist() == [EDGE] * 3 and line[at[2] : at[3]].tolist() == [EDGE] * 3 + [ord("日"), ord("本"), 32, ord("語")]
    marks = lambda t: perplexity.symbols([t])[0][4:-1].tolist()
    assert marks("a&&& b") == marks("a & b") != marks("a %% b") and marks("a \n b") == [10] and marks("a  b") == [32]


def kneser_ney(sequences, alphabet, least):
    """Interpolated modified Kneser-Ney with plain dictionaries: a function of an n-gram as a tuple."""
    tables = {ORDER: Counter(s[i - ORDER + 1 : i + 1] for s in sequences for i in range(ORDER - 1, len(s)))}
    for k in range(ORDER - 1, 0, -1):
        tables[k] = Counter(g[1:] for g in tables[k + 1])
    cut = {k: (0, *perplexity.discounts(Counter(t.values()))) for k, t in tables.items()}

    def p(gram):
        if not gram:
            return 1 / alphabet
        t, d, low = tables[len(gram)], cut[len(gram)], least if len(gram) == ORDER else 1
        same = [c for g, c in t.items() if g[:-1] == gram[:-1]]
        if not same:
            return p(gram[1:])
        c = t.get(gram, 0)
        own = c - d[min(c, 3)] if c >= low else 0
        return own / sum(same) + (1 - sum(x - d[min(x, 3)] for x in same if x >= low) / sum(same)) * p(gram[1:])

    return p


def pack(gram):
    return np.array([gram[0] << BITS | gram[1]]), np.array([gram[2] << BITS | gram[3]])


@pytest.mark.parametrize("entries", [1 << 23, 25])
def test_model_is_kneser_ney(make, entries):
    texts = ["abra Cadabra", "abc, abd. ab", "ad ab #1 abra", "", None, "zz"]
    model = [b.value for b in perplexity.train(make(*enumerate(texts)), most_entries=entries)]
    assert (len(model) == 1) == (entries > 100)
    line, at = perplexity.symbols(texts)
    sequences = [tuple(line[a:b].tolist()) for a, b in zip(at, at[1:], strict=False) if b - a > ORDER - 1]
    alphabet = len({x for s in sequences for x in s} - {EDGE}) + 1
    p = kneser_ney(sequences, alphabet, perplexity.LEAST_COUNT)
    log = lambda hi, lo: sum(s.log_prob(hi, lo) for s in model)
    hi, lo, _ = perplexity.grams([*texts, "abra xyz % dab"])
    for a, b in zip(hi.tolist(), lo.tolist(), strict=True):
        gram = (a >> BITS, a & LOW, b >> BITS, b & LOW)
        assert log(np.array([a]), np.array([b]))[0] == pytest.approx(np.log(p(gram)), abs=1e-4)
    symbols = sorted({x for s in sequences for x in s} - {EDGE})
    for context in ((EDGE, EDGE, EDGE), (97, 98, 114), (120, 121, 122)):
        known = sum(np.exp(log(*pack((*context, x)))[0]) for x in symbols)
        assert known + np.exp(log(*pack((*context, 0x999)))[0]) == pytest.approx(1, abs=1e-4)  # and all that is unknown
    assert all((np.diff(keys) > 0).all() for s in model for keys, _ in (s.grams, s.weights))


def prose(rng, n, words):
    return " ".join(rng.choice(words) for _ in range(n)) + "."


def vocabulary(rng, parts, n=80):
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(n)]


LATIN, GERMAN, CYRILLIC = ["the", "ing", "ou", "wa", "ter"], ["sch", "ung", "ä", "ge", "über"], ["при", "вет", "ный", "ост", "ка"]


def test_bands_reject_on_both_sides(make, tiny):
    rng = random.Random(4)
    words = {"en": vocabulary(rng, LATIN), "de": vocabulary(rng, GERMAN), "ru": vocabulary(rng, CYRILLIC)}
    docs = [(1000 * k + i, prose(rng, 200, words[lang]), lang) for k, lang in enumerate(words) for i in range(60)]
    docs += [(100 + i, prose(rng, 200, words["en"]).replace(" ", ("### ", "&&& ")[i % 2]), "en") for i in range(6)]
    docs += [(200, "".join(rng.choice("xqzjkw#% ") for _ in range(900)), "en"), (2200, "".join(rng.choice("щъыэюж# ") for _ in range(900)), "ru"), (220, " ".join(str(k * k) for k in range(90)), "en")]  # numbers are neither here nor there
    docs += [(201, prose(rng, 10, words["en"]), "en"), (202, "go on " * 100, "en"), (203, None, "en"), (204, "", None)]
    got = {r.doc_id: r for r in perplexity.quality_rules(make(*docs), most_repeated=101).collect()}
    clean = [1000 * k + i for k in range(3) for i in range(60)]
    assert all(got[i].kept for i in clean) and len(got) == len(docs)
    above = [*range(100, 106), 200, 2200]
    assert all(not got[i].base_failed and got[i].perplexity > got[i].upper and not got[i].kept for i in above)
    assert not got[202].base_failed and not got[202].kept and got[202].perplexity < got[202].lower
    assert got[201].base_failed and got[203].base_failed and got[203].n_words == 0 and not got[204].kept and got[204].perplexity == 1
    for r in got.values():  # the verdict is the rule and the band
        assert r.kept == (not r.base_failed and r.lower is not None and r.lower * (1 - 1e-9) <= r.perplexity <= r.upper * (1 + 1e-9))
    rows = perplexity.quality_rules(tiny).collect()
    assert len(rows) == 13 and {r.kept for r in rows} <= {True, False} and perplexity.quality_rules(tiny.filter("false")).count() == 0
    assert perplexity.quality_rules(make((1, "go on " * 100))).first().base_failed


def test_perplexity_of_whole_texts(make):
    """The perplexity is that of the model over all symbols, and shards give the same."""
    rng = random.Random(3)
    words = vocabulary(rng, LATIN)
    docs = make(*((i, prose(rng, 60 + i, words)) for i in range(20)), (50, prose(rng, 30_000, words)))
    got = {r.doc_id: r.perplexity for r in perplexity.quality_rules(docs).collect()}
    model = perplexity.train(docs)[0].value
    for r in docs.collect():
        n, total = perplexity.log_sums([r.text], model)
        assert got[r.doc_id] == pytest.approx(np.exp(-total[0] / n[0]))
    many = {r.doc_id: r.perplexity for r in perplexity.quality_rules(docs, most_entries=200).collect()}
    assert many == {k: pytest.approx(v) for k, v in got.items()}


def test_passing_decides_by_row(make):
    rng = random.Random(1)
    words = vocabulary(rng, LATIN)
    good = [prose(rng, 120, words) for _ in range(40)]
    docs = make(*((i, t) for i, t in enumerate(good)), (None, good[0]), (None, "short junk"), (7, good[1]), (7, "junk"), (9, None))
    got = perplexity.passing(docs)
    assert got.columns == docs.columns and got.schema == docs.schema
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in got.collect()) == sorted((i is None, i or 0, t) for i, t in [*enumerate(good), (None, good[0]), (7, good[1])])
    assert perplexity.passing(docs.filter("false")).count() == 0
    named = docs.withColumnRenamed("rank", "siltstone_scores").withColumnRenamed("pos", "siltstone_band")
    assert perplexity.passing(named).columns == named.columns


def banded(spark, values):
    """Which of (log-probability, text) lie within the band of one language."""
    df = spark.createDataFrame([(i, "en", k, float(x)) for i, (x, k) in enumerate(values)], "i long, lang string, text_key long, x double")
    band = perplexity.bands(df, perplexity.DEVIATIONS, perplexity.LEAST_HALF).first()
    return [abs(x - band.middle) <= band.half for x, _ in values]


def test_bands_are_sent_to_the_rows(make, spark):
    """Whole rows are not shuffled to the few bands."""
    rng = random.Random(2)
    df = make(*((i, " ".join(f"{rng.getrandbits(24):06x}" for _ in range(60)), "de" if i % 2 else "en") for i in range(400)))
    least = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
    try:
        kept = perplexity.passing(df)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and kept.count() > 300
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", least)


@pytest.mark.parametrize("share", [0.0, 0.1, 0.24, 0.26, 0.33, 0.4, 0.45])
def test_junk_does_not_widen_the_band(spark, share):
    rng = random.Random(5)
    junk = int(1000 * share)
    kept = banded(spark, [(rng.gauss(-4.0 if i < junk else -3.0, 0.02), i) for i in range(1000)])
    assert not any(kept[:junk]) and all(kept[junk:])


def test_copies_do_not_narrow_the_band(spark):
    rng = random.Random(6)
    assert all(banded(spark, [(-3.0, 0)] * 800 + [(rng.gauss(-3.0, 0.1), i) for i in range(1, 201)]))


def test_a_hot_junk_source_is_rejected(make):
    rng = random.Random(4)
    words = vocabulary(rng, LATIN)
    docs = [(i, prose(rng, 200, words)) for i in range(60)] + [(100 + i, prose(rng, 200, words).replace(" ", ("### ", "&&& ")[i % 2])) for i in range(30)]
    got = {r.doc_id: r.kept for r in perplexity.quality_rules(make(*docs)).collect()}
    assert all(got[i] for i in range(60)) and not any(got[100 + i] for i in range(30))


def test_labelled_documents(spark):
    """Rejects low quality and keeps good documents of the tables. Units and thresholds were chosen on labels of sf0.1, made by the same generator."""
    sf = "/root/testdata/sf0.01"
    got = perplexity.quality_rules(spark.read.parquet(f"{sf}/documents.parquet")).filter("not base_failed").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    low, good = ([r.kept for r in got if r.quality == q] for q in (0, 1))
    assert sum(low) <= 0.15 * len(low) and sum(good) >= 0.99 * len(good)
