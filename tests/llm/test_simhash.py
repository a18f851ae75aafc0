import random

import xxhash

from spendguard.llm import components, simhash
from tests.llm.helpers import docs


def plain(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), 42) for i in range(max(1, len(words) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, distance=2):
    """Smallest id of each id's component, by comparing all pairs."""
    ids = sorted(prints)
    near = {i: [j for j in ids if (prints[i] ^ prints[j]).bit_count() <= distance] for i in ids}
    least = {}
    for i in ids:
        todo = [i]
        while todo:
            j = todo.pop()
            if j not in least:
                least[j] = i
                todo += near[j]
    return least


def test_documents(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 40)))) for i in range(60)]
    rows += [(100 + i, rows[i % 7][1].upper().replace(" ", "\t\n ")) for i in range(40)]
    rows += [(200, None), (201, ""), (202, " \x0b\x0c"), (203, "É é"), (204, "é É"), (205, "one"), (206, "ONE "), (207, "a b")]
    rows += [(208, "a\x1cb"), (209, "a\u00a0b"), (210, " ".join(words * 60))]
    got = {r.doc_id: r for r in simhash.near_duplicates(docs(spark, rows)).collect()}
    prints = {i: plain(t) for i, t in rows}
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {i: r.component_id for i, r in got.items()} == groups(prints)


def test_stretches_of_a_long_text(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(500))
    whole = simhash.fingerprint(text, 3)
    monkeypatch.setattr(simhash, "STRETCH", 7)
    assert simhash.fingerprint(text, 3) == whole
    assert whole & ((1 << 64) - 1) == plain(text)


def _prints(spark, values):
    signed = [(i, v - (1 << 64) if v >> 63 else v) for i, v in enumerate(values)]
    return spark.createDataFrame(signed, "doc_id long, fp long")


def test_links_of_close_and_crowded_fingerprints(spark):
    rng = random.Random(9)
    values = []
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(30):  # around a base, up to 4 bits away: some linked over others, some not at all
            flips = rng.sample(range(64), rng.randint(0, 4))
            values.append(base ^ sum(1 << b for b in flips))
    values += [rng.getrandbits(64) for _ in range(40)] + [0, 0, 1, 3, 7, 15, (1 << 64) - 1]
    for distance in (0, 1, 2):
        expected = groups(dict(enumerate(values)), distance)
        for crowd in (64, 3):  # all keys by pairs, nearly all keys over midpoints
            prints = _prints(spark, values)
            links = simhash.close_pairs(prints.select("fp").distinct(), distance, crowd)
            found = components.components(links)
            of = {r.node: r.component for r in found.collect()}
            by_fp = {r.doc_id: of.get(r.fp, r.fp) for r in prints.collect()}
            least = {}
            for i in sorted(by_fp):
                least.setdefault(by_fp[i], i)
            assert {i: least[c] for i, c in by_fp.items()} == expected, (distance, crowd)


def test_components_of_paths_stars_and_nothing(spark):
    path = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 100)]
    links = spark.createDataFrame([*path, *star, (5, 5), (1, 0)], "u long, v long")
    got = {r.node: r.component for r in components.components(links).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(100)}}
    assert components.components(links.limit(0)).count() == 0


def test_empty_table(spark):
    assert simhash.near_duplicates(docs(spark, [(1, "a")]).limit(0)).count() == 0


def test_one_row_of_each_component_stays(spark):
    rng = random.Random(6)
    base = [f"word{i}" for i in range(400)]
    rows = [(50 + i, " ".join(base[:200] + [f"x{i}"] if i % 3 else base[:200])) for i in range(30)]
    rows += [(i, " ".join(rng.choices(base, k=60))) for i in range(20)]
    rows += [(10, rows[40][1])] * 5 + [(None, rows[3][1]), (None, "alone without an id"), (None, "alone without an id")]
    rows += [(300, None), (299, ""), (None, " ")] + [(77, "a row that stands here often")] * 60
    df = docs(spark, rows)
    kept = simhash.first_of_each(df)
    assert kept.columns == df.columns
    got = sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in kept.collect())
    expected = []
    prints = {i: plain(t) for i, (_, t) in enumerate(rows)}
    members = {}
    for i, least in groups(prints).items():
        members.setdefault(least, []).append(rows[i])
    for of in members.values():
        first = min((i is None, i or 0) for i, _ in of)
        expected.append((*first, {t for i, t in of if (i is None, i or 0) == first}))
    assert len(got) == len(expected)
    assert all(g[:2] == e[:2] and g[2] in e[2] for g, e in zip(got, sorted(expected, key=lambda e: (e[0], e[1], max(e[2]))), strict=True))
    assert simhash.first_of_each(df.limit(0)).count() == 0
    few = simhash.first_of_each(docs(spark, [(1, "a b c"), (2, "d e f")]))
    assert sorted(r.doc_id for r in few.collect()) == [1, 2]
