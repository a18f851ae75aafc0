"""Rows picked by key filters, and first blocking messages without moving texts."""

import random

import pytest
from pyspark.sql import functions as F

from spendguard.operators import governance as G
from spendguard.operators import keyfilter
from spendguard.plans import inputs as I

SF = "/root/testdata/sf0.001"


def split(spark, n, share, seed):
    """Keys with a part of two types, some of them members."""
    rng = random.Random(seed)
    rows = [(i, f"k{i % 7}", rng.random() < share) for i in range(n)]
    df = spark.createDataFrame(rows, "a long, b string, member boolean")
    return rows, df.where("member").drop("member"), df.where("NOT member").drop("member"), df


@pytest.mark.parametrize(("n", "share"), [(30_000, 0.3), (30_000, 0.01), (50, 1), (50, 0), (1, 1)])
def test_members_are_told_from_all_others(spark, n, share):
    rows, members, others, df = split(spark, n, share, n)
    found = keyfilter.key_filter(members, others)
    assert found.exact
    got = df.where(found.test(F.col("a"), F.col("b")))
    assert sorted((r.a, r.member) for r in got.collect()) == [(a, True) for a, _, m in rows if m]


def test_small_filters_make_deep_cascades(spark, monkeypatch):
    """With two bits a key most keys pass every level, so that the answer depends on all of them."""
    monkeypatch.setattr(keyfilter, "BITS", 2)
    monkeypatch.setattr(keyfilter, "CHUNK", keyfilter.CHUNK)
    rows, members, others, df = split(spark, 60_000, 0.4, 3)
    found = keyfilter.key_filter(members, others, rounds=60)
    if found.exact:
        assert len(found.cascade) > 2
        got = df.where(found.test(F.col("a"), F.col("b")))
        assert {r.a for r in got.collect()} == {a for a, _, m in rows if m}
    else:  # it did not settle: members at least all pass
        got = df.where(found.test(F.col("a"), F.col("b")))
        assert {r.a for r in got.collect()} >= {a for a, _, m in rows if m}


def test_too_many_members_give_a_filter_that_lets_all_of_them_through(spark, monkeypatch):
    monkeypatch.setattr(keyfilter, "MAX_BITS", keyfilter.CHUNK)
    rows, members, others, df = split(spark, 8_000, 0.5, 5)
    found = keyfilter.key_filter(members, others)
    assert not found.exact
    got = df.where(found.test(F.col("a"), F.col("b"))).collect()
    assert {r.a for r in got} >= {a for a, _, m in rows if m} and len(got) < 8_000


def texts(spark):
    bad, good = "Card: 5500000000000004 for a patient", "nothing here"
    rows = [(r, m, bad if (r * 7 + m * 3) % 4 == 0 else good) for r in range(40) for m in range(8)]
    rows += [(None, 0, bad), (3, None, bad), (1, 0, bad), (100, 5, bad), (100, 5, bad), (100, 6, bad), (101, 1, None)]
    return spark.createDataFrame(rows, "request_id long, msg_index long, text string")


@pytest.mark.parametrize("bits", [keyfilter.MAX_BITS, 0])
def test_first_blocking_message(spark, monkeypatch, bits):
    """Exact by the filter alone, and by joining what a filter lets through that is too small."""
    if bits == 0:
        monkeypatch.setattr(keyfilter, "MAX_BITS", keyfilter.CHUNK)
        monkeypatch.setattr(keyfilter, "BITS", keyfilter.CHUNK)
    messages = texts(spark)
    every = G.blocked_messages(messages).collect()
    first = {}
    for r in every:
        if r.request_id is not None and r.msg_index is not None:
            first[r.request_id] = min(first.get(r.request_id, r.msg_index), r.msg_index)
    expected = [r for r in every if first.get(r.request_id) == r.msg_index and r.msg_index is not None]
    assert sorted(map(str, G.first_blocking_message(messages).collect())) == sorted(map(str, expected))
    assert len(expected) > 30
    assert G.first_blocking_message(messages.limit(0)).count() == 0


def test_no_text_is_exchanged(spark, monkeypatch):
    """Whatever the optimiser broadcasts, the plan has no exchange or join above the texts."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = G.first_blocking_message(I.messages(spark, SF))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan and "Join" not in plan and "text" in plan
