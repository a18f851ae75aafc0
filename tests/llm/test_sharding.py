import random
import zlib

from spendguard.llm import sharding
from tests.llm.helpers import docs


def test_all_rows_in_near_equal_shards(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, "é" * rng.randint(0, 400)) for i in range(900)] + [(None, "x" * i) for i in range(300)] + [(5000, None), (5001, None)]
    rows += [(5002, "tie"), (5002, "tie"), (6000, "y" * 9000)]
    got = sharding.shard_by_bytes(docs(spark, rows), 8, folder=str(tmp_path)).collect()
    expected = sorted((i or -1, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted((r.doc_id or -1, r["size"], r.text_crc32) for r in got) == expected
    assert {(r.law, r.grown_shard) for r in got} == {("bytes", None)}
    load = [sum(r["size"] for r in got if r.shard == k) for k in range(8)]
    assert max(load) - min(load) <= 9000 and sum(load) == sum(e[1] for e in expected)
    for k in range(8):
        places = sorted(r.slot for r in got if r.shard == k)
        assert places == list(range(len(places)))
    assert len({(r.vslot, r.shard) for r in got}) == len({r.vslot for r in got})
    first, second = (sharding.load_map(spark, str(tmp_path), v).collect() for v in (1, 2))
    assert len(first) == len(second) == sharding.SLOTS
    assert {r.vslot: r.shard for r in first} == {s: s % 8 for s in range(sharding.SLOTS)}


def test_a_row_that_is_half_of_the_table_is_spread_evenly(spark, tmp_path):
    rows = [(i, "z" * (i % 50)) for i in range(1000)] + [(7, "again and again")] * 1500 + [(None, None)] * 1500
    table = docs(spark, rows).repartition(5)
    assert sorted(r.copy for r in sharding.measured(table, copies=100).where("doc_id IS NULL").collect()) == list(range(1500))
    got = sharding.shard_by_bytes(table, 8, folder=str(tmp_path)).collect()
    assert sorted((r.doc_id or -1, r["size"]) for r in got) == sorted((i or -1, len(t or "") + 1) for i, t in rows)
    load = [sum(r["size"] for r in got if r.shard == k) for k in range(8)]
    assert max(load) - min(load) <= 50
    for k in range(8):
        assert sorted(r.slot for r in got if r.shard == k) == list(range(sum(r.shard == k for r in got)))
    again = sharding.shard_by_bytes(docs(spark, rows[::-1]).repartition(3), 8, folder=str(tmp_path / "again")).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_growth_takes_rows_only_into_the_new_shard():
    rng = random.Random(4)
    load = [rng.randint(0, 1000) for _ in range(500)]
    owner = sharding.rebalanced(sharding.first_map(500, 7), load, 7)
    more = sharding.grown(owner, load, 7)
    assert all(b in (a, 7) for a, b in zip(owner, more, strict=True))
    totals = [sum(x for x, o in zip(load, more, strict=True) if o == k) for k in range(8)]
    assert max(totals) - min(totals) <= 1000
    assert sharding.rebalanced([0, 0], [5, 0], 2) == [0, 0]


def test_empty_table(spark):
    assert sharding.shard_by_bytes(docs(spark, [(1, "a")]).limit(0), 8).count() == 0
