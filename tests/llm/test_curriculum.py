import hashlib
import random
import re
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from spendguard.llm import curriculum
from tests.llm.helpers import CLASHES, DOCS


def size(text):
    return len(re.findall("[^\x20\x09-\x0d]+", text or ""))


def plain_targets(sizes):
    """Sharing by weight and sharing the excess again, as the contract says it."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, target, free = sum(sizes.values()), {}, set(names)
    while True:
        left = total - sum(target.values())
        share = {s: Fraction(left * weight[s], sum(weight[f] for f in free)) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            return target | share
        target |= {s: 3 * sizes[s] for s in over}
        free -= over


def demand(knots, t):
    """Area under the line through knots from 0 to t, as a share of the whole, by small steps."""
    def line(x):
        at = min(int(x * (len(knots) - 1)), len(knots) - 2)
        rest = x * (len(knots) - 1) - at
        return knots[at] + (knots[at + 1] - knots[at]) * rest

    steps = 2000
    whole = sum(line((i + 0.5) / steps) for i in range(steps)) / steps
    return sum(line((i + 0.5) / steps * t) for i in range(steps)) / steps * t / whole


def plain(rows):
    """(id, source, text) -> the copies that the mix takes of each such row, as a multiset."""
    of = defaultdict(list)
    for i, text, source in rows:
        of[source].append((hashlib.md5(f"{'' if i is None else i}:{text or ''}".encode()).hexdigest(), i, text))
    sizes = {s: sum(size(t) for _, _, t in docs) for s, docs in of.items()}
    targets = plain_targets(sizes)
    out = []
    for source, docs in of.items():
        before, end = 0, int(targets[source])
        for _, i, text in sorted(docs, key=lambda d: d[0]):
            copies = []
            for k in range(3):
                at = k * sizes[source] + before
                if at < end:
                    copies.append((k, at / targets[source], min(size(text), end - at)))
            before += size(text)
            out.append((i, source, text, targets[source], copies))
    return out


def corpus():
    rng = random.Random(12)
    rows = []
    for i in range(400):
        source = rng.choice(["hot", "hot", "hot", "a", "b", "tiny", "ÿ", None])
        if source == "tiny" and rng.random() < 0.9:
            source = "hot"
        rows.append((i, " \t\n".join(f"w{rng.randrange(99)}" for _ in range(rng.randint(0, 40))), source))
    rows += [(7, None, "a"), (None, "no id", "a"), (None, None, None), (1000, " \x1c x", "b"), (1001, "", "empty")]
    rows += [(2000, "again and again", "hot")] * 130 + [(1002, "long " * 60_000, "b")]
    return rows


def table(spark, rows):
    df = spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], DOCS)
    names = {*CLASHES, "position", "copy", "key", "size", "source_size", "target", "weight", "m"}
    return df.withColumns({c: F.lit("x") for c in names})


@pytest.mark.parametrize("slice_rows", [curriculum.SLICE, 7])
def test_places_are_those_of_plain_loops(spark, monkeypatch, slice_rows):
    monkeypatch.setattr(curriculum, "COPIES", 50)
    rows = corpus()
    expected = plain(rows)
    placed = curriculum.positions(table(spark, rows), slice_rows=slice_rows).collect()
    got = sorted((r.doc_id is None, r.doc_id or 0, r.source or "~", r.size, r.target, [(c.copy, c.words) for c in r.copies]) for r in placed)
    assert got == sorted((i is None, i or 0, s or "~", size(t), float(g), [(k, w) for k, _, w in c]) for i, s, t, g, c in expected)
    weight = {s: i % 3 + 1 for i, s in enumerate(sorted({r[2] for r in rows}, key=lambda s: (s is None, s or "")))}
    share = {(i, s, k, w): x for i, s, _, _, copies in expected for k, x, w in copies if i not in (7, 2000, None)}
    for r in placed:
        for c in r.copies:
            if r.doc_id not in (7, 2000, None):
                x = share[r.doc_id, r.source, c.copy, c.words]
                assert abs(demand(curriculum.KNOTS[weight[r.source]], c.position) - x) < 2e-3


def test_sources_come_near_their_targets_and_order_is_kept(spark):
    rows = corpus()
    out = curriculum.by_first_position(curriculum.positions(table(spark, rows))).collect()
    assert len(out) == len(rows)
    assert all(0 <= r.taken <= 3 * r.size for r in out)
    begun = [r.first_position for r in out if r.first_position is not None]
    assert begun == sorted(begun) and 0 <= begun[0] and begun[-1] < 1
    assert sum(r.taken for r in out) >= sum(r.size for r in out) - len({r[2] for r in rows})
    again = curriculum.by_first_position(curriculum.positions(table(spark, rows[::-1]).repartition(7)))
    assert sorted(map(str, again.collect())) == sorted(map(str, out))


def test_training_order_has_texts(spark):
    rows = corpus()
    out = curriculum.training_order(table(spark, rows)).collect()
    texts = {(i, s): t for i, t, s in rows if i not in (7, None)}
    assert [r.position for r in out] == sorted(r.position for r in out)
    assert all(texts[r.doc_id, r.source] == r.text for r in out if r.doc_id not in (7, None))
    assert all(r.words <= size(r.text) for r in out)
    taken = defaultdict(int)
    for r in out:
        taken[r.source] += r.words
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += size(t)
    assert {s: taken[s] for s in sizes} == {s: int(g) for s, g in plain_targets(sizes).items()}


def test_targets(spark):
    rng = random.Random(3)
    for _ in range(6):
        sizes = {f"s{i:02}": rng.choice([0, 1, 5, 40, 1000, 10**6]) for i in range(rng.randint(1, 12))}
        df = spark.createDataFrame([(s, 1, n) for s, n in sizes.items()], "source string, n long, source_size long")
        got = {r.source: r.target for r in curriculum.targets(df).collect()}
        assert got == pytest.approx({s: float(t) for s, t in plain_targets(sizes).items()}, rel=1e-12)


def test_empty_tables(spark):
    empty = table(spark, [(1, "a", "b")]).limit(0)
    assert curriculum.by_first_position(curriculum.positions(empty)).count() == 0
    assert curriculum.training_order(empty).count() == 0
    blank = curriculum.by_first_position(curriculum.positions(table(spark, [(1, None, "b"), (2, "", None)]))).collect()
    assert [(r.size, r.target, r.taken) for r in blank] == [(0, 0.0, 0)] * 2
