import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendguard.llm import divergence
from tests.llm.helpers import DOCS

S = divergence.SCALE


def plain(rows, least=3, top=200):
    """The whole contract in plain loops."""
    counts, within = defaultdict(Counter), defaultdict(Counter)
    sources = defaultdict(set)
    for text, lang, source in rows:
        text, lang, source = (x or "" for x in (text, lang, source))
        words = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", "".join(c.lower() if c.isascii() else c for c in text))
        counts[lang, source].update(words)
        within[lang].update(set(words))
        sources[lang].add(source)
    out = set()
    for lang, names in sources.items():
        kept = [t for t, k in within[lang].items() if k >= least]
        total = {s: sum(counts[lang, s][t] for t in kept) for s in names}
        whole = Counter()
        for s in names:
            whole.update({t: counts[lang, s][t] for t in kept})

        def p(c, n):
            return 1 + S * (c + 1) // (n + len(kept))

        for s in names:
            pairs = []
            for other in names - {s}:
                of = [(p(counts[lang, s][t], total[s]), p(counts[lang, other][t], total[other])) for t in kept]
                pairs.append((-sum((a - b) ** 2 // b for a, b in of), other.encode(), other))
            terms = []
            for t in kept:
                a, b = p(counts[lang, s][t], total[s]), p(whole[t], sum(total.values()))
                if counts[lang, s][t] > 0 and a > b:
                    terms.append((-((a - b) ** 2 // b), t.encode(), t))
            out |= {(lang, s, "pair", x[2], -x[0], i + 1) for i, x in enumerate(sorted(pairs))}
            out |= {(lang, s, "term", x[2], -x[0], i + 1) for i, x in enumerate(sorted(terms)[:top])}
    return out


def table(spark, rows):
    df = spark.createDataFrame([(None, t, lang, s, 0) for t, lang, s in rows], DOCS)
    return df.withColumns({c: F.lit(1) for c in ("term", "row", "col", "p", "value", "rank", "n", "docs")})


def got(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def corpus(seed=3):
    rng = random.Random(seed)
    words = [f"{a}{b}é" for a in "abcdefgh" for b in "klmnop"] + ["Ünder", "ABC", "abc", "ß", "日本", "ÉCOLE"]
    rows = []
    for lang in ("en", "de", None):
        for s in range(9):
            own = rng.sample(words, 12)
            for _ in range(6):
                text = " ".join(rng.choices(own + words[:4], k=rng.randint(0, 60)))
                rows.append((text, lang, f"src{s}" if s else None))
    rows += [(None, "en", "empty"), ("", "en", "empty"), ("12 34 [\\] `", "en", "bare"), ("rare once", "en", "rare")]
    rows += [("one two", "xx", "a"), (None, "xx", "b"), ("three", "xx", "c"), (None, "yy", "only")]
    rows += [rows[0]] * 40 + [("abc " * 50_000 + "ABC", "en", "src1")] + [("tie eit", "de", f"t{i}") for i in range(4)]
    return rows


@pytest.mark.parametrize(("side", "width"), [(divergence.SIDE, divergence.STRIPE), (4, 16)])
def test_whole_operator(spark, side, width):
    """With few rows a tile, tiles of different rows meet as well."""
    rows = corpus()
    assert got(divergence.audit(table(spark, rows), side=side, width=width)) == plain(rows)


def test_ranks_of_terms_are_cut_and_tables_beyond_the_bound_are_shuffled(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BOUND", 0)
    rows = corpus(4)
    counts = [divergence.term_counts(table(spark, rows), held) for held in (10, 10**6)]
    assert counts[0].drop("docs").exceptAll(counts[1].drop("docs")).isEmpty()
    few, many = (c.groupBy("lang", "term").agg(F.sum("n"), F.sum("docs")) for c in counts)
    assert few.count() == many.count() and few.subtract(many).isEmpty()
    assert got(divergence.audit(table(spark, rows), least_docs=1, top_terms=5)) == plain(rows, 1, 5)


def test_empty_table(spark):
    assert divergence.audit(table(spark, [("a", "b", "c")]).limit(0)).count() == 0
    assert got(divergence.audit(table(spark, [(None, None, None)]))) == set()


def test_walking_two_trees():
    rng = np.random.default_rng(1)
    for density in (0, 0.01, 0.3, 1):
        a, b = rng.random((2, 64, 64)) < density
        cells = sorted(zip(*map(list, divergence.shared_leaves(a, b)), strict=True))
        assert cells == [(g, h, t) for g in range(64) for h in range(64) for t in np.flatnonzero(a[g] & b[h])]


def test_prices_of_large_counts(spark):
    n, total, v = 9 * 10**17, 9 * 10**18, 10**17
    row = spark.range(1).select(divergence.price(F.lit(n), F.lit(total), F.lit(v)).alias("p")).first()
    assert row.p == 1 + S * (n + 1) // (total + v)
