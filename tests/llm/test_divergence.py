import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tickflow.llm import divergence, queries

_TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
_CASE = {c: c + 32 for c in range(65, 91)}


def by_hand(rows, least=10, top=10):
    """Every group against every kept term and every other group, in Python integers."""
    counts, totals, holders, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        groups.add((lang, source))
        found = [w.translate(_CASE) for w in _TERM.findall(text)]
        counts[lang, source].update(found)
        totals[lang].update(found)
        holders[lang].update(set(found))
    out = []
    for lang, source in groups:
        kept = [t for t, n in holders[lang].items() if n >= least]
        size = lambda c: sum(c[t] for t in kept)
        p = lambda c, t: 1 + 10**9 * (c[t] + 2) // (size(c) + 2 * len(kept))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        own = counts[lang, source]
        pairs = [(sum(f(p(own, t), p(counts[lang, s], t)) for t in kept), s) for g, s in groups if g == lang and s != source]
        terms = [(f(p(own, t), p(totals[lang], t)), t) for t in kept if own[t] and p(own, t) > p(totals[lang], t)]
        for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
            order = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
            out += [(lang, source, part, item, value, rank) for rank, (value, item) in enumerate(order, 1)]
    return sorted(out)


def corpus(chance, documents, words, langs, sources):
    vocabulary = ["".join(chance.choices("abcdeéÉß中XYZ", k=chance.randint(1, 4))) for _ in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    for _ in range(documents):
        source = chance.choice(sources)
        bias = [w * (1 + 3 * (hash_of(v, source) % 5 == 0)) for v, w in zip(vocabulary, weights)]
        yield " 1,\n".join(chance.choices(vocabulary, bias, k=chance.randrange(40))), chance.choice(langs), source


def hash_of(*parts):
    return sum(ord(c) * 31**i for i, c in enumerate("|".join(map(str, parts))))


@pytest.mark.parametrize("options", [{}, {"tile_terms": 7, "tile_sources": 2, "held": 20, "fan_in": 2}])
def test_rows_against_plain_sums(spark, options):
    chance = random.Random(4)
    rows = list(corpus(chance, 400, 120, ["en", "fr", None], ["a", "b", "c", "é", None, "Z"]))
    rows += [(None, "en", "a"), ("", "xx", "lonely"), ("one two", "xx", "other"), ("same text", "en", "a"), ("same text", "en", "a")]
    docs = spark.createDataFrame([(*r, "t", 1, "p") for r in rows], "text string, lang string, source string, term string, n long, part string")
    out = divergence.divergence(docs.repartition(5), top=3, **options)
    assert sorted(map(tuple, out.collect())) == by_hand(rows, top=3)
    assert divergence.divergence(docs.limit(0)).count() == 0


def test_ties_rank_by_utf8(spark):
    """Terms of equal counts, and sources of equal texts."""
    rows = [(" ".join(["zz", "é", "中", "a", "b", "c"]), "en", s) for s in ("x", "y", "Z", "é") for _ in range(3)] + [("other words here", "en", "w")] * 10
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    assert sorted(map(tuple, divergence.divergence(docs, top=2).collect())) == by_hand(rows, top=2)


@pytest.mark.parametrize("k", [1, 3, 10])
def test_skyband_against_all_pairs(k):
    chance = np.random.default_rng(k)
    for size, spread in ((0, 5), (1, 5), (300, 4), (300, 1000), (2500, 30)):
        n = chance.integers(1, spread + 1, size)
        total = n + chance.integers(0, spread + 1, size)
        rows = np.arange(size)
        by = ((n[None, :] >= n[:, None]) & (total[None, :] <= total[:, None]) & (rows[None, :] < rows[:, None])).sum(axis=1)
        assert divergence.skyband(n, total, k).tolist() == np.flatnonzero(by < k).tolist()


def test_counts_beyond_what_a_long_holds_times_a_billion(spark):
    share = spark.sql("select cast(1 + (cast(1000000000 as decimal(38,0)) * (9000000000000 + 2)) div greatest(10000000000000 + 2 * 5, 1) as bigint) as p")
    assert share.first()["p"] == 1 + 10**9 * (9 * 10**12 + 2) // (10**13 + 10)


def test_query_has_sql():
    assert {"op11_divergence", "op13_fill_middle"} <= set(queries.ORACLES)
