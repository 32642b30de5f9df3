"""Terms of a text and lexical ranks."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: English words that carry no search term.
STOPWORDS = (
    "a about above after again against all am an and any are as at be because been before being below between both but by can did do does doing don down during each few for from "
    "further had has have having he her here hers herself him himself his how i if in into is it its itself just me more most my myself no nor not now of off on once only or other "
    "our ours ourselves out over own s same she should so some such t than that the their theirs them themselves then there these they this those through to too under until up very "
    "was we were what when where which while who whom why will with you your yours yourself yourselves"
).split()
K1, B = 1.2, 0.75


def terms(text: Column, stopwords: bool = True) -> Column:
    """Lower-case runs of a-z and 0-9, in order; null text has none."""
    found = F.split(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+")
    drop = ["", *STOPWORDS] if stopwords else [""]
    return F.filter(found, lambda t: ~t.isin(*drop))


def query_terms(query: str, stopwords: bool = True) -> list[str]:
    """The distinct terms of a query, as terms() finds them."""
    return list(dict.fromkeys(t for t in re.split("[^a-z0-9]+", query.lower()) if t and not (stopwords and t in STOPWORDS)))


def matches_all(found: Column, wanted: list[str]) -> Column:
    """Whether every wanted term is there; false for no wanted term."""
    if not wanted:
        return F.lit(False)
    out = F.lit(True)
    for t in wanted:
        out = out & F.array_contains(found, t)
    return out


def frequency(found: Column, term: str) -> Column:
    return F.size(F.filter(found, lambda t: t == term)).cast("double")


def bm25(found: Column, wanted: list[str], documents: int, mean_length: float, having: dict[str, int]) -> Column:
    """Okapi BM25 of the wanted terms, given how many documents there are and have each."""
    import math

    out = F.lit(0.0)
    norm = F.lit(K1) * (F.lit(1 - B) + F.lit(B) * F.size(found) / F.lit(max(mean_length, 1e-9)))
    for t in wanted:
        n = having.get(t, 0)
        tf = frequency(found, t)
        out = out + F.lit(math.log(1 + (documents - n + 0.5) / (n + 0.5))) * tf * F.lit(K1 + 1) / (tf + norm)
    return out
