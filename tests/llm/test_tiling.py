import random

import numpy as np

from spendguard.llm import tiling, words
from tests.llm.helpers import docs


def plain(item, text, least=5):
    """Greedy string tiling by comparing all places."""
    free_p, free_t, tiles = [True] * len(item), [True] * len(text), []
    while True:
        best = None
        for a in range(len(item)):
            for b in range(len(text)):
                n = 0
                while a + n < len(item) and b + n < len(text) and item[a + n] == text[b + n] and free_p[a + n] and free_t[b + n]:
                    n += 1
                if n >= least and (best is None or n > best[0]):
                    best = (n, a, b)
        if best is None:
            return tiles
        n, a, b = best
        free_p[a : a + n] = free_t[b : b + n] = [False] * n
        tiles.append((a, b, n))


def test_tiles_against_plain_code():
    rng = random.Random(6)
    for _ in range(300):
        pool = [f"w{i}" for i in range(rng.choice((2, 4, 30)))]
        item = rng.choices(pool, k=rng.randint(0, 50))
        text = rng.choices(pool, k=rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            a = rng.randint(0, max(0, len(item) - 6))
            at = rng.randint(0, len(text))
            text[at:at] = item[a : a + rng.randint(3, 40)]
        assert sorted(tiling.tile(item, [text])) == sorted(plain(item, text))


def test_reordered_passages_are_caught_and_clean_documents_left(spark):
    rng = random.Random(7)
    w = [f"word{i}" for i in range(4000)]
    items = [(i, " ".join(rng.choices(w, k=40))) for i in range(20)] + [(90, "too short an item"), (91, None)]
    items.append((92, items[0][1]))  # an equal item
    text = dict(items)
    noise = " ".join(rng.choices(w, k=400))
    turned = " ".join(text[3].split()[20:] + text[3].split()[:20])
    rows = [
        (1, noise + " " + text[0].upper().replace(" ", ", ") + " " + noise), (2, noise + " " + turned), (3, noise),
        (4, " ".join(text[5].split()[:12]) + " " + noise), (5, None), (6, ""), (None, text[7]), (7, "too short an item"), (10, "short an item too"),
        (8, text[8]), (8, text[8]), (9, (noise + " ") * 300 + text[9]),
    ]
    table = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS words", "2 AS item", "3 AS doc_id")
    df = docs(spark, rows)
    got = sorted(((r.doc_id or 0), r.item_id, r.n_tiles, r.coverage) for r in tiling.leaks(df, table).collect())
    assert got == [(0, 7, 1, 1.0), (1, 0, 1, 1.0), (1, 92, 1, 1.0), (2, 3, 2, 1.0), (7, 90, 1, 1.0), (8, 8, 1, 1.0), (8, 8, 1, 1.0), (9, 9, 1, 1.0)]
    kept = tiling.drop_leaks(df, table)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6, 10]
    assert tiling.leaks(df.limit(0), table).count() == 0
    assert tiling.leaks(df, table.limit(0)).count() == 0


def test_short_items_and_pairs_against_plain_code(spark):
    rng = random.Random(11)
    for pool_size in (3, 12):
        pool = [f"w{i}" for i in range(pool_size)]
        items = [(i, " ".join(rng.choices(pool, k=rng.randint(0, 12)))) for i in range(25)]
        rows = [(i, " ".join(rng.choices(pool + ["a", "b"], k=rng.randint(0, 30)))) for i in range(60)]
        rows += [(100 + i, t) for i, t in items]
        table = spark.createDataFrame(items, "item_id long, text string").repartition(2)
        got = {(r.doc_id, r.item_id): r.covered_words for r in tiling.leaks(docs(spark, rows).repartition(3), table).collect()}
        expected = {}
        for d, text in rows:
            for i, item in items:
                w = item.split()
                under = sum(n for _, _, n in plain(w, text.split(), min(5, len(w)))) if w else 0
                if w and under / len(w) >= 0.5:
                    expected[d, i] = under
        assert got == expected
        assert {len(dict(items)[i].split()) for _, i in got} >= {1, 2, 3, 4}


def test_pairs_that_cannot_reach_the_coverage_do_not_meet(spark):
    w = [f"v{i}" for i in range(40)]
    grams = tiling.item_grams(tiling.item_words(spark.createDataFrame([(1, " ".join(w))], "item_id long, text string")))
    rows = [(1, " ".join(w[:7])), (2, " ".join(w[:21])), (3, " ".join(w[10:30])), (4, " ".join(w[:5] + ["x"] + w[20:25]))]
    runs = tiling.shared_runs(docs(spark, rows), tiling.gram_map(grams), [5])
    number = {r.row: r["_id"] for r in runs.collect()}
    assert sorted(number.values()) == [1, 2, 3, 4]
    assert sorted(number[r.row] for r in tiling.meeting(runs, grams, 0.5).collect()) == [2, 3]


def test_large_benchmark_is_joined_by_shuffling(spark, monkeypatch):
    rows = [(i, " ".join(f"a{i}b{j}" for j in range(12))) for i in range(30)]
    table = spark.createDataFrame(rows, "item_id long, text string")
    expected = sorted(map(tuple, tiling.leaks(docs(spark, rows), table).collect()))
    monkeypatch.setattr(tiling, "SMALL", -1)
    large = tiling._joined.__defaults__
    tiling._joined.__defaults__ = (-1,)
    try:
        assert sorted(map(tuple, tiling.leaks(docs(spark, rows), table).collect())) == expected
    finally:
        tiling._joined.__defaults__ = large
    assert len(expected) == 30


def test_words_of_long_texts_are_whole(monkeypatch):
    rng = random.Random(3)
    texts = ["", None, "É1, b\tc", "a" * 300] + [" ".join(f"w{rng.randint(0, 99)}" for _ in range(rng.randint(0, 300))) for _ in range(20)]

    def read():
        out = {}
        for doc, start, end, hash_, data in words.documents(texts):
            for d, a, b, h in zip(doc.tolist(), start.tolist(), end.tolist(), hash_.tolist(), strict=True):
                out.setdefault(d, []).append((data[a:b].decode(), h))
        return out

    whole = read()
    monkeypatch.setattr(words, "CHUNK", 50)
    assert read() == whole
    assert [w for w, _ in whole[2]] == ["é1", "b", "c"]
    assert len({h for v in whole.values() for _, h in v}) == len({w for v in whole.values() for w, _ in v})
    assert np.all(words.mixed(np.arange(3, dtype=np.uint64)) >= 0)
