"""Scopes and sessions of any size: no join key, block or group has to hold a large one."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from spendguard.operators import budgets as B
from spendguard.operators import ordered as O
from spendguard.plans import inputs as I
from spendguard.runtime import shared_path
from spendguard.streaming import jobs as J


@pytest.fixture(scope="module")
def calls(spark):
    """300 calls of one organisation after the only start of a window, and some without names."""
    start = datetime(2024, 1, 1)
    rows = [
        (i, "org-1" if i % 50 else None, start + timedelta(minutes=i - 20), "purchase" if i % 3 else None,
         "staging", "8" if i % 2 else None, 1.0 + i % 4, 0.5)
        for i in range(300)
    ]
    ddl = """call_id long, org_id string, timestamp timestamp, feature string, environment string,
    customer_id string, cost_usd double, estimated_cost_usd double"""
    return spark.createDataFrame(rows, ddl).localCheckpoint()


def test_calls_meet_levels_by_pieces_of_their_scope(spark, calls, monkeypatch):
    plain = sorted(map(str, B.budget_check(calls, I.policies(spark)).collect()))
    monkeypatch.setattr(B, "BLOCK", 16)
    largest, frame = [], type(calls)
    real = frame.join

    def join(left, right, on=None, how=None):
        if isinstance(on, list) and "_bound" in on:
            largest.append(left.groupBy(*on).count().agg(F.max("count")).first()[0])
        return real(left, right, on, how)

    monkeypatch.setattr(frame, "join", join)
    cut = sorted(map(str, B.budget_check(calls, I.policies(spark)).collect()))
    assert largest and max(largest) <= 16
    assert cut == plain and any("allowed=False" in row for row in plain)


def test_large_scopes_are_swept_once_and_idle_ones_not_at_all(spark, calls, monkeypatch):
    policies = I.policies(spark).where("id IN ('pol_002', 'pol_005')")
    jobs = lambda n: [
        sorted(map(str, B.first_crossing(policies, calls, max_group_rows=n).collect())),
        sorted(map(str, B.budget_check(calls, policies, max_group_rows=n).collect())),
    ]
    plain = jobs(10**6)
    blocked, real = [], O._over_blocks

    def over(rows, *args):
        blocked.append(rows.where("_is_call").select(*B.SCOPE).distinct().count())
        return real(rows, *args)

    monkeypatch.setattr(O, "_over_blocks", over)
    cut = jobs(40)
    # Once a job, with the two scopes that have policies.
    assert blocked == [2, 2]
    assert cut == plain and all(plain)


def test_ledger_stream_keeps_ids_and_missing_places(spark):
    """Few columns go through Python, and whole numbers stay whole beside missing ones."""
    ddl = """session_id string, call_id long, timestamp timestamp, model string, input_tokens long,
    output_tokens long, cache_creation_tokens long, cache_read_tokens long"""
    at, big = datetime(2024, 1, 1), 2**60 + 1
    rows = [("a", None, at, "gpt-4", 10, 0, None, None), ("a", big, at, "gpt-4", 20, 0, None, None),
            ("a", 7, None, "gpt-4", 40, 0, None, None), (None, None, at, "gpt-4", 1, 0, None, None)]
    source = shared_path(spark, "odd-calls")
    spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(source)
    limits = spark.createDataFrame([("a", None, 2)], "session_id string, max_spend_usd double, max_iterations long")
    path = shared_path(spark, "odd")
    stream = spark.readStream.schema(ddl).parquet(source)
    J.stream_session_ledger(stream, I.pricing, lambda _: limits, path, shared_path(spark, "odd-checkpoint"), None).awaitTermination()
    out = {(r.session_id, r.call_id, r.timestamp): (r.call_sequence, r.cumulative_input_tokens, r.allowed, r.status)
           for r in spark.read.parquet(path).collect()}
    assert out == {
        ("a", big, at): (1, 20, True, "active"),
        ("a", None, at): (2, 30, True, "active"),
        ("a", 7, None): (2, 30, False, "terminated"),
        (None, None, at): (None, None, True, None),
    }
    assert len(J._packed(spark.createDataFrame([], J.PRICED)).columns) == 3
