"""Ordered work: known cases, plain loops, and hot groups cut into blocks."""

import pickle
import random
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from spendguard.operators import budgets as B
from spendguard.operators import ordered
from spendguard.operators import rate as R
from spendguard.operators import sessions as S
from spendguard.operators.ordered import group_sizes, running, time_blocks
from spendguard.plans import inputs as I

SMALL = 150  # forces groups to be cut into blocks


@pytest.fixture(scope="module")
def calls(spark):
    """3,000 calls; one key has about a third, and many calls share a timestamp."""
    rng = random.Random(7)
    rows, now = [], 0.0
    for i in range(3000):
        # Busy and quiet spells, so that buckets run dry and fill up again.
        now += rng.choice([0, 0, 0.2, 0.7] if (i // 250) % 2 else [0.5, 1.0, 3.0])
        key = "hot" if i % 3 == 0 else f"k{rng.randrange(40)}"
        cost = rng.choice([0.0, 0.01, 0.02, 0.07])
        rows.append((i, key, now, cost, rng.choice([0.0, 0.05, 0.2, 0.5]), rng.randrange(100)))
    ddl = "call_id long, session_id string, at double, cost_usd double, " \
          "estimated_cost_usd double, input_tokens long"
    df = spark.createDataFrame(rows, ddl)
    at = F.timestamp_micros(F.round(F.col("at") * 1000000).cast("long"))
    return df.withColumn("timestamp", at).drop("at").repartition(6).cache()


@pytest.fixture
def blocks(spark):
    """Let range partitioning really cut: many small partitions, none merged."""
    settings_ = {
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "24",
    }
    old = {name: spark.conf.get(name) for name in settings_}
    for name, value in settings_.items():
        spark.conf.set(name, value)
    yield
    for name, value in old.items():
        spark.conf.set(name, value)


def bucket(arrivals, rate, burst):
    """Plain token bucket over (seconds, ...) in order."""
    level, last, out = Fraction(burst), None, []
    for now in arrivals:
        if last is not None:
            level = min(Fraction(burst), level + (now - last) * Fraction(str(rate)))
        last = now
        out.append((level, level >= 1))
        level -= 1 if level >= 1 else 0
    return out


def arrivals_df(spark, seconds):
    df = spark.createDataFrame(
        [(i, "k", int(Fraction(str(s)) * 10**6)) for i, s in enumerate(seconds)],
        "call_id long, key string, us long",
    )
    return df.withColumn("timestamp", F.timestamp_micros("us")).drop("us")


@pytest.mark.parametrize(
    "rate, burst, seconds, allowed, tokens, retry",
    [
        (10, 5, [0] * 5, [True] * 5, [5, 4, 3, 2, 1], [None] * 5),
        (10, 2, [0] * 3, [True, True, False], [2, 1, 0], [None, None, 1]),
        (100, 1, [0, 0, 0.05], [True, False, True], [1, 0, 1], [None, 1, None]),
        (1, 1, [0, 0], [True, False], [1, 0], [None, 1]),
        (1, 2, [0, 0, 0, 0.5, 1.2, 9.0], [True, True, False, False, True, True],
         [2, 1, 0, 0.5, 1.2, 2], [None, None, 1, 1, None, None]),
        ("1/3600", 1, [0, 1800], [True, False], [1, 0.5], [None, 1800]),
    ],
)
def test_known_rates(spark, rate, burst, seconds, allowed, tokens, retry):
    rows = R.rate_audit(arrivals_df(spark, seconds), ["key"], rate, burst).orderBy("call_id")
    rows = rows.collect()
    assert [r.allowed for r in rows] == allowed
    assert [r.tokens_before for r in rows] == pytest.approx(tokens)
    assert [r.retry_after_s for r in rows] == retry


def test_known_queue(spark):
    df = arrivals_df(spark, [0, 0, 0, 0.5, 1.2, 9.0])
    rows = R.queue_delay(df, ["key"], 1, 2).orderBy("call_id").collect()
    assert [r.wait_s for r in rows] == pytest.approx([0, 0, 1, 1.5, 1.8, 0])


@settings(max_examples=300, deadline=None)
@given(
    st.integers(1, 5),
    st.lists(st.integers(0, 700), min_size=1, max_size=60),
    st.lists(st.integers(0, 500), min_size=1, max_size=8),
)
def test_level_map_equals_walking(burst, gaps, arriving):
    token, full = 100, burst * 100
    levels = R.LevelMap(full, token)
    for i, gap in enumerate(gaps):
        levels.call(min(full, gap) if i else 0)
    for start in arriving:
        level = min(full, start)
        first = level
        for i, gap in enumerate(gaps):
            level = min(full, level + gap) if i else level
            level -= token if level >= token else 0
        assert R.LevelMap.apply(levels.pieces(), first) == level


@settings(max_examples=200, deadline=None)
@given(
    st.integers(1, 6),
    st.lists(
        st.tuples(st.integers(1, 300), st.sampled_from([0, 1, 7, 30, 95, 100, 130])),
        min_size=1, max_size=6,
    ),
    st.lists(st.integers(0, 600), min_size=1, max_size=8),
)
def test_bulk_calls_equal_walking(burst, spells, arriving):
    token, full = 100, burst * 100
    gaps = [(gap * (i % 3) + i % 5) % 140 for n, gap in spells for i in range(n)]
    gaps = np.minimum(np.array(gaps, dtype=np.int64), full)
    gaps[0] = 0
    levels = R.LevelMap(full, token)
    levels.calls(gaps)
    for start in arriving:
        level = first = min(full, start)
        for i, gap in enumerate(gaps.tolist()):
            level = min(full, level + gap) if i else level
            level -= token if level >= token else 0
        assert R.LevelMap.apply(levels.pieces(), first) == level


def test_overload_is_done_in_bulk():
    levels = R.LevelMap(50_000_000, 1_000_000)
    refills = np.full(300_000, 5_000, dtype=np.int64)
    refills[0] = 0
    calls = []
    levels.call = lambda refill, call=levels.call: (calls.append(1), call(refill))
    levels.calls(refills)
    assert len(calls) < 500
    for start in (0, 999_999, 1_000_000, 49_999_999, 50_000_000):
        level = start
        for refill in refills.tolist():
            level = min(50_000_000, level + refill)
            level -= 1_000_000 if level >= 1_000_000 else 0
        assert R.LevelMap.apply(levels.pieces(), start) == level


def test_level_map_follows_a_settled_bucket_as_a_number():
    levels = R.LevelMap(500, 100)
    levels.call(0)
    levels.call(500)
    assert levels.level == 400
    assert [np.asarray(p).tolist() for p in levels.pieces()] == [[0], [400], [False]]


@pytest.mark.parametrize("rate, burst", [("0.3", 3), (1, 10), (5, 1), ("0.05", 20)])
def test_hot_key_rate_equals_plain_loop(spark, calls, blocks, rate, burst):
    by_key = {}
    for r in calls.orderBy("timestamp", "call_id").collect():
        by_key.setdefault(r.session_id, []).append(r)
    expected = {}
    for rows in by_key.values():
        seconds = [Fraction(round(r.timestamp.timestamp() * 10**6), 10**6) for r in rows]
        for r, (level, ok) in zip(rows, bucket(seconds, rate, burst)):
            expected[r.call_id] = (float(level), ok)
    for limit in (SMALL, 10**6):
        audit = R.rate_audit(calls, ["session_id"], rate, burst, max_group_rows=limit)
        assert audit.columns == calls.columns + ["tokens_before", "allowed", "retry_after_s"]
        got = {r.call_id: (r.tokens_before, r.allowed) for r in audit.collect()}
        assert got.keys() == expected.keys()
        for call, (level, ok) in expected.items():
            assert got[call][1] == ok
            assert got[call][0] == pytest.approx(level, abs=1e-9)


def test_hot_key_queue_equals_plain(spark, calls, blocks):
    plain, cut = [
        {r.call_id: r.wait_s for r in R.queue_delay(
            calls, ["session_id"], "0.4", 3, max_group_rows=n).collect()}
        for n in (10**6, SMALL)
    ]
    assert plain == cut and len(plain) == 3000 and max(plain.values()) > 0
    finish, expected = {}, {}
    for r in calls.orderBy("timestamp", "call_id").collect():
        served = finish.setdefault(r.session_id, [])
        now = Fraction(round(r.timestamp.timestamp() * 10**6), 10**6)
        # A queue that hands out tokens in order: bucket time runs ahead of the clock.
        ahead = max(served[-1], now) if served else now
        done = ahead + Fraction(10, 4)
        served.append(done)
        expected[r.call_id] = float(max(0, done - now - 3 * Fraction(10, 4)))
    assert plain == pytest.approx(expected)


def test_running_sums_with_null_keys_and_terms(spark, blocks):
    rows = [(i, None if i % 3 == 0 else "a", None if i % 5 == 0 else i) for i in range(300)]
    df = spark.createDataFrame(rows, "n long, k string, v long")
    for limit in (SMALL, 10**6):
        out = running(
            df, ["k"], ["n"], {"total": F.col("v"), "count": F.lit(1)},
            {"most": lambda col: col("count") * 2 - F.col("n")}, max_group_rows=limit,
        ).collect()
        assert len(out) == 300
        totals, most = {}, {}
        for r in sorted(out, key=lambda r: r.n):
            t = totals.setdefault(r.k, [None, 0])
            t[0] = t[0] if r.v is None else (t[0] or 0) + r.v
            t[1] += 1
            most[r.k] = max(most.get(r.k, -10**9), t[1] * 2 - r.n)
            assert [r["total"], r["count"], r.most] == [*t, most[r.k]]


def limits_df(spark, rows):
    return spark.createDataFrame(
        rows, "session_id string, max_spend_usd double, max_iterations long"
    )


def replay_loop(rows, max_spend, max_calls):
    spent, count, out = Decimal(0), 0, []
    for r in rows:
        cost, estimate = Decimal(str(r.cost_usd)), Decimal(str(r.estimated_cost_usd))
        if max_spend is not None and spent + estimate > Decimal(str(max_spend)):
            out.append((r.call_id, False, "budget_exceeded"))
        elif max_calls is not None and count + 1 > max_calls:
            out.append((r.call_id, False, "iteration_limit_exceeded"))
        else:
            out.append((r.call_id, True, None))
            spent, count = spent + cost, count + 1
    return out


@pytest.mark.parametrize(
    "max_spend, max_calls",
    [(0.5, 15), (2.0, None), (None, 300), (20.0, 700), (None, None), (0.0, None)],
)
def test_hot_session_replay_equals_plain_loop(spark, calls, blocks, max_spend, max_calls):
    sessions = {}
    for r in calls.orderBy("timestamp", "call_id").collect():
        sessions.setdefault(r.session_id, []).append(r)
    limits = limits_df(spark, [(s, max_spend, max_calls) for s in sessions])
    expected = sorted(
        row for rows in sessions.values() for row in replay_loop(rows, max_spend, max_calls)
    )
    for limit in (SMALL, 10**6):
        out = S.session_replay(calls, limits, max_group_rows=limit).collect()
        assert sorted((r.call_id, r.allowed, r.reason) for r in out) == expected


def test_session_cases(spark):
    def decide(costs, max_spend, max_calls):
        ddl = "call_id long, session_id string, cost_usd double, estimated_cost_usd double"
        df = spark.createDataFrame([(i, "s", c, e) for i, (c, e) in enumerate(costs)], ddl)
        df = df.withColumn("timestamp", F.timestamp_micros("call_id"))
        limits = limits_df(spark, [("s", max_spend, max_calls)])
        replayed = S.session_replay(df, limits)
        rows = replayed.orderBy("call_id").collect()
        return [(r.allowed, r.reason) for r in rows], replayed

    same = (0.5, 0.5)
    assert decide([same, same], 1.0, None)[0] == [(True, None)] * 2
    refused = (False, "budget_exceeded")
    assert decide([(0.75, 0.1), (0.1, 0.5), (0.1, 0.25)], 1.0, None)[0] == [
        (True, None), refused, (True, None)
    ]
    many = decide([same] * 3, None, 2)
    assert many[0][2] == (False, "iteration_limit_exceeded")
    assert decide([same] * 2, 0.5, 1)[0][1] == refused
    closes = spark.createDataFrame([("s", "completed")], "session_id string, close_reason string")
    open_, closed = [S.session_summary(many[1], c).first() for c in (None, closes)]
    assert (open_.status, open_.termination_reason) == ("terminated", "iteration_limit_exceeded")
    assert (closed.status, closed.termination_reason) == ("completed", "completed")
    assert (open_.final_spend_usd, open_.final_iteration_count) == (1, 2)
    left = S.session_remaining(S.session_summary(many[1]), limits_df(spark, [("s", 0.4, None)]))
    row = left.first()
    assert (row.remaining_budget_usd, row.remaining_iterations) == (0, None)


def test_ineligible_calls_stay_undecided_and_do_not_count(spark, calls):
    limits = limits_df(spark, [("hot", None, 5)])
    out = S.session_replay(calls.where("session_id = 'hot'"), limits, F.col("call_id") % 2 == 0)
    rows = out.orderBy("timestamp", "call_id").collect()
    assert all((r.allowed is None) == (r.call_id % 2 == 1) for r in rows)
    assert [r.call_id for r in rows if r.allowed] == [0, 6, 12, 18, 24]


def test_blocks_of_time_and_frozen_blocks(spark, calls):
    sizes = group_sizes(calls, ["session_id"], "timestamp")
    assert sizes.total == 3000 and sizes.largest == 1000
    args = calls, calls, ["session_id"], "timestamp"
    assert time_blocks(*args, SMALL).select("_block").distinct().count() > 10
    # A burst at one instant cannot be cut by time.
    same = calls.withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))
    assert time_blocks(same, same, ["session_id"], "timestamp", SMALL) is None
    plain, cut = [
        sorted(map(tuple, S.session_ledger(same, max_group_rows=n).collect()))
        for n in (10**6, SMALL)
    ]
    assert plain == cut


def test_hot_groups_of_different_density_have_their_own_blocks(spark):
    """2,000 rows within half a second, and 2,000 over a year, and the same without a key."""
    second, year = 250, 365 * 24 * 3600 * 500
    rows = [(k, i, i * step) for k, step in (("fast", second), ("slow", year), (None, year)) for i in range(2000)]
    df = spark.createDataFrame(rows, "session_id string, call_id long, at long").select(
        "session_id", "call_id", F.timestamp_micros("at").alias("timestamp"), F.lit(0.5).alias("cost_usd"),
        F.lit(1).cast("long").alias("input_tokens"),
    )
    blocked = time_blocks(df, df, ["session_id"], "timestamp", 100)
    counts = {r.session_id: r.n for r in blocked.groupBy("session_id").agg(F.countDistinct("_block").alias("n")).collect()}
    assert all(20 <= n <= 82 for n in counts.values()) and len(counts) == 3
    plain, cut = [
        sorted(map(str, running(df, ["session_id"], ["timestamp", "call_id"], {"n": F.lit(1)}, max_group_rows=n).collect()))
        for n in (10**6, 100)
    ]
    assert plain == cut


def test_hot_session_ledger_and_refusal_equal_plain(spark, calls, blocks):
    limits = limits_df(spark, [(f"k{i}", 0.5, 15) for i in range(40)] + [("hot", 5.0, 900)])
    for job in (
        lambda n: S.session_ledger(calls, max_group_rows=n),
        lambda n: S.session_first_refusal(calls, limits, max_group_rows=n),
    ):
        plain, cut = [sorted(map(tuple, job(n).collect())) for n in (10**6, SMALL)]
        assert plain == cut and plain


def test_hot_budget_jobs_equal_plain(spark, calls, blocks):
    full = calls.withColumns(
        {
            "org_id": F.lit("org-1"),
            "feature": F.when(F.col("call_id") % 3 == 0, "purchase").otherwise("view"),
            "environment": F.lit("staging"),
            "customer_id": F.lit("8"),
            "timestamp": F.col("timestamp") + F.make_interval(years=F.lit(54)),
        }
    )
    policies = I.policies(spark).withColumn("budget_amount_usd", F.col("budget_amount_usd") / 8)
    for job in (
        lambda n: B.first_crossing(policies, full, max_group_rows=n),
        lambda n: B.budget_check(full, policies, max_group_rows=n),
    ):
        plain, cut = [sorted(map(str, job(n).collect())) for n in (10**6, SMALL)]
        assert plain == cut and plain


def test_calls_without_a_session_pass_by(spark):
    ddl = "call_id long, session_id string, timestamp timestamp, cost_usd double, estimated_cost_usd double, input_tokens long"
    at = F.lit("2024-01-01").cast("timestamp")
    rows = [(i, None if i % 2 else "s", None, 5e6, 5e6, 1) for i in range(10)]
    df = spark.createDataFrame(rows, ddl).withColumn("timestamp", at)
    limits = limits_df(spark, [("s", 2e7, None), ("idle", 1.0, 3), (None, 0.0, 0)])
    ledger = {r.call_id: r for r in S.session_ledger(df).collect()}
    assert ledger[8].call_sequence == 5 and ledger[8].cumulative_cost_usd == 25_000_000
    assert ledger[1].call_sequence is None and ledger[1].call_type == "llm" and len(ledger) == 10
    replayed = S.session_replay(df, limits)
    for limit in (10**6, 2):
        out = {r.call_id: r for r in S.session_replay(df, limits, max_group_rows=limit).collect()}
        # Five million dollars a call: more than 64 bits of 1e-12 dollars hold.
        assert [out[i].allowed for i in (0, 2, 4, 6, 8)] == [True] * 4 + [False]
        assert all(out[i].allowed and out[i].iterations_before is None for i in (1, 3, 5))
    first = S.session_first_refusal(df, limits).collect()
    assert [(r.session_id, r.call_id) for r in first] == [("s", 8)]
    closes = spark.createDataFrame([("gone", "completed")], "session_id string, close_reason string")
    opened = limits.where("session_id IS NOT NULL")
    summary = S.session_summary(replayed, closes, opened)
    rows = {r.session_id: (r.final_iteration_count, float(r.final_spend_usd), r.status) for r in summary.collect()}
    assert rows == {"s": (4, 2e7, "terminated"), "idle": (0, 0.0, "active"), "gone": (0, 0.0, "completed")}
    left = {r.session_id: r.remaining_iterations for r in S.session_remaining(S.session_summary(replayed), opened).collect()}
    assert left == {"s": None, "idle": 3}


@pytest.mark.parametrize("rate", [1 / 3, 10 / 60, 0.1, 2 / 7, 1e-9, 123.456, 10, "1/3600", Decimal("0.7")])
def test_any_positive_rate(rate):
    made = R.Bucket.of(rate, 50)
    assert abs(made.refill * 10**6 / made.token - float(Fraction(rate))) <= 1e-12 * float(Fraction(rate))
    assert made.full == 50 * made.token


@pytest.mark.parametrize("rate, burst", [(0, 1), (-1, 1), (1, 0), ("1/12345678901234567", 50)])
def test_rates_that_cannot_be_kept_are_refused_at_once(rate, burst):
    with pytest.raises(ValueError):
        R.Bucket.of(rate, burst)


def test_float_rate_in_a_job(spark):
    rows = [(i, "k", i * 100_000) for i in range(20)]
    df = spark.createDataFrame(rows, "call_id long, key string, at long").withColumn("timestamp", F.timestamp_micros("at"))
    exact, floating = [
        sorted((r.call_id, r.allowed, r.retry_after_s) for r in R.rate_audit(df, ["key"], rate, 2).collect())
        for rate in ("1/3", 1 / 3)
    ]
    assert exact == floating and {a for _, a, _ in exact} == {True, False}


def test_rate_walk_in_bulk_equals_one_by_one():
    rng = random.Random(1)
    for _ in range(300):
        made = R.Bucket.of(rng.choice([1, 0.5, "1/3", 10, 3, 0.01]), rng.choice([1, 2, 5, 50, "1/2", "3/2"]))
        at, times, mode = 0, [], rng.random()
        for _ in range(rng.choice([10, 65, 1000])):
            mode = rng.random() if rng.random() < 0.02 else mode
            busy, even, idle = [0, 1000, 100_000], [300_000, 10**6, 2 * 10**6], [10**7, 10**8]
            at += rng.choice(busy if mode < 0.4 else even if mode < 0.8 else idle)
            times.append(at - (10**6 if rng.random() < 0.03 else 0))  # some come late
        times, level = np.array(times, np.int64), rng.randint(0, made.full)
        ends, levels = [], []
        for step in ("run", "_plain"):
            walk = R.Walk(made, times)
            ends.append(getattr(walk, step)(0, len(times), level, int(times[0]) - 5))
            levels.append((walk.before.tolist(), walk.after.tolist()))
        assert ends[0] == ends[1] and levels[0] == levels[1]


def test_session_walk_in_bulk_equals_one_by_one():
    import pyarrow as pa

    rng = random.Random(3)
    for _ in range(300):
        unit, n = rng.choice([10**18, 10**9, 10**9]), rng.choice([1, 50, 65, 1500])
        limit, most = rng.choice([None, 0, 5, 300, 10**6]), rng.choice([None, 0, 3, 200, 10**6])
        limit, share = None if limit is None else limit * unit, rng.choice([1, 1, 0.5, 0])
        usd, part = (S.NO_LIMIT, 0) if limit is None else divmod(limit, S.DOLLAR)
        columns = {
            "_cost": [rng.choice([0, 1, 2, 7]) * unit for _ in range(n)],
            "_estimate": [rng.choice([0, 1, 3, 8]) * unit for _ in range(n)],
            "_tokens": [rng.randint(0, 9) for _ in range(n)],
            "_max_usd": [usd] * n,
            "_max_part": [part] * n,
            "_max_calls": [S.NO_LIMIT if most is None else most] * n,
        }
        rows = {k: pa.array(v, pa.int64()) for k, v in columns.items()}
        batch = pa.RecordBatch.from_pydict(rows | {"_eligible": [rng.random() < share for _ in range(n)]})
        state = (rng.choice([0, 3 * unit]), rng.randint(0, 3), 5, False)
        bulk, plain = S.Walk(batch), S.Walk(batch)
        assert bulk.run(0, n, state) == plain._plain(0, n, state, limit, most)
        for name in ("verdict", "before", "calls_before", "refused"):
            assert (getattr(bulk, name) == getattr(plain, name)).all(), name
        assert all((bulk.after[k] == plain.after[k]).all() for k in bulk.after)


def jobs_of(spark, name, work):
    """How many Spark jobs ``work`` starts, and what it gives."""
    sc = spark.sparkContext
    sc.setJobGroup(name, name)
    try:
        result = work()
        return len(sc.statusTracker().getJobIdsForGroup(name)), result
    finally:
        sc._jsc.clearJobGroup()


@pytest.mark.parametrize(("max_spend", "max_calls"), [(60.0, None), (900.0, 15_000), (None, 700), (1e9, None)])
def test_a_session_of_many_different_estimates_needs_no_serial_job(spark, blocks, max_spend, max_calls):
    """50,000 estimates, all of them different, in some 24 blocks: decided at once and never replayed one by one."""
    rng = random.Random(11)
    rows = [(i, "s", i // 3, rng.choice([0.0, 0.001, 0.02]), round((i * 7919 % 50_000) * 1e-4 + 0.0001, 4)) for i in range(50_000)]
    ddl = "call_id long, session_id string, at long, cost_usd double, estimated_cost_usd double"
    df = spark.createDataFrame(rows, ddl).withColumn("timestamp", F.timestamp_seconds("at")).drop("at").repartition(4)
    df = df.cache()
    limits = limits_df(spark, [("s", max_spend, max_calls)])
    done = {}
    for size in (1000, 10**6):
        name = f"replay-{size}-{max_spend}-{max_calls}"
        work = lambda: S.session_replay(df, limits, max_group_rows=size).collect()  # noqa: E731, B023
        jobs, out = jobs_of(spark, name, work)
        done[size] = sorted((r.call_id, r.allowed, r.reason) for r in out)
        assert jobs <= 40
    assert done[1000] == done[10**6] == sorted(replay_loop(sorted(df.collect(), key=lambda r: r.call_id), max_spend, max_calls))


def test_rate_of_one_key_over_a_thousand_blocks(spark):
    """Followed as a tree of three levels, equal to the loop."""
    rng = random.Random(3)
    now, rows = 0, []
    for i in range(6000):
        now += rng.choice([0, 1, 300_000, 900_000] if (i // 400) % 2 else [700_000, 2_000_000])
        rows.append((i, "k", now))
    df = spark.createDataFrame(rows, "call_id long, key string, us long").withColumn("timestamp", F.timestamp_micros("us")).drop("us")
    old = {n: spark.conf.get(n) for n in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "1000")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frozen = ordered.freeze(df.withColumn("_us", F.unix_micros("timestamp")), ["key"], ["_us", "call_id"], 1000)
        assert frozen.select("_block").distinct().count() > 900
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        rule = R.bucket_fold(R.Bucket.of("0.9", 5))
        starts = {r["_block"]: pickle.loads(r["_start"]) for r in ordered._block_starts(frozen, ["key"], rule, fan=8).collect()}
        first = {r["_block"]: r.us for r in frozen.groupBy("_block").agg(F.min("_us").alias("us")).collect()}
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)
    bucket_ = R.Bucket.of("0.9", 5)
    level, last, expected, place = bucket_.full, rows[0][2], {}, 0
    order = sorted(first)
    ends = [first[b] for b in order[1:]] + [now + 1]
    sizes = {r["_block"]: r["count"] for r in frozen.groupBy("_block").count().collect()}
    for block, _ in zip(order, ends):
        if block != order[0]:
            expected[block] = (level, last)
        for _, _, us in rows[place : place + sizes[block]]:
            level, last = min(bucket_.full, level + (us - last) * bucket_.refill), us
            level -= bucket_.token if level >= bucket_.token else 0
        place += sizes[block]
    assert starts == expected


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 5), st.lists(st.integers(0, 700), min_size=2, max_size=40), st.data())
def test_composed_maps_equal_walking(burst, gaps, data):
    bucket_ = R.Bucket(1, 100, burst * 100)
    cut = data.draw(st.integers(1, len(gaps) - 1))
    times = np.cumsum(gaps)
    rule = R.bucket_fold(bucket_)

    def part(us):
        return next(iter(rule.summarise([pa.RecordBatch.from_pydict({"_us": us})])))

    both = rule.compose(part(times[:cut]), part(times[cut:]))
    for level in (0, 1, 99, 100, 101, bucket_.full // 2, bucket_.full):
        state = level, int(times[0])
        assert rule.advance(state, both) == rule.advance(rule.advance(state, part(times[:cut])), part(times[cut:]))
