"""Streams fed file by file give what the batch job gives on the whole."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from spendguard.operators import cost as K
from spendguard.operators import rate as R
from spendguard.operators import sessions as S
from spendguard.plans import inputs as I
from spendguard.runtime import checkpointed, children, shared_path
from spendguard.sources import sinks, tables
from spendguard.streaming import jobs as J
from spendguard.streaming.runs import Runs

SF = "/root/testdata/sf0.001"
PARTS = 4


@pytest.fixture(scope="module")
def log(spark):
    """The usage log as files that arrive in time order."""
    path = shared_path(spark, "log")
    calls = sinks.usage_rows(I.usage_calls(spark, SF)).drop("date")
    size = calls.count() // PARTS + 1
    for part in range(PARTS):
        calls.where(F.floor(F.col("call_id") / size) == part).coalesce(1).write.mode(
            "append"
        ).parquet(path)
    return path


def stream(spark, log):
    return tables.stream_usage(spark, log, max_files_per_trigger=1)


def paths(spark, name):
    return shared_path(spark, name), shared_path(spark, f"{name}-checkpoint")


def source(spark, name, batches, schema):
    """A stream of one micro-batch for each list of rows."""
    path = shared_path(spark, name)
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_session_ledger(spark, log):
    path, checkpoint = paths(spark, "ledger")
    limits = checkpointed(I.session_limits(spark, SF))
    query = J.stream_session_ledger(
        stream(spark, log), I.pricing, lambda _: limits, path, checkpoint, None
    )
    query.awaitTermination()
    out = spark.read.parquet(path)
    assert out.select("arrival").distinct().count() == PARTS
    calls = K.with_cost_and_estimate(tables.read_usage(spark, log), I.pricing(spark))
    batch = S.session_replay(calls, limits)
    streamed = out.select("call_id", "allowed", "reason")
    same = batch.select("call_id", "allowed", "reason")
    assert sorted(map(str, streamed.collect())) == sorted(map(str, same.collect()))
    last = out.where("session_id IS NOT NULL").groupBy("session_id").agg(
        F.max("call_sequence").alias("n"), F.max("cumulative_cost_usd").alias("spend")
    )
    both = {r.session_id: r for r in last.collect()}
    final = S.session_summary(batch).collect()
    for r in final:
        assert both[r.session_id].n == r.final_iteration_count
        assert both[r.session_id].spend == pytest.approx(float(r.final_spend_usd))
    assert sorted(map(str, S.session_summary(out).collect())) == sorted(map(str, final))


CALL = "session_id string, call_id long, timestamp timestamp, model string, input_tokens long, output_tokens long, cache_creation_tokens long, cache_read_tokens long"


def test_sessions_are_never_forgotten(spark):
    """A session over its limit stays refused, however long other traffic goes on."""

    def call(session, number, day, tokens):
        return (session, number, datetime(2024, 1, day), "gpt-4", tokens, 0, None, None)

    batches = [[call("a", 1, 1, 10_000)], [call("b", 2, 20, 1)], [call("b", 3, 25, 1), call("a", 4, 25, 1), call(None, 5, 25, 10**6)]]
    limits = spark.createDataFrame([("a", 0.1, None)], "session_id string, max_spend_usd double, max_iterations long")
    path, checkpoint = paths(spark, "long-lived")
    J.stream_session_ledger(
        source(spark, "sessions", batches, CALL), I.pricing, lambda _: limits, path, checkpoint, None
    ).awaitTermination()
    out = {r.call_id: r for r in spark.read.parquet(path).collect()}
    # The same while both streams go on running.
    live, place = paths(spark, "live")
    running = J.stream_session_ledger(
        source(spark, "live-sessions", batches, CALL), I.pricing, lambda _: limits, live, place, "0 seconds"
    )
    running.processAllAvailable()
    running.stop()
    assert sorted(map(str, spark.read.parquet(live).drop("batch").collect())) == sorted(
        map(str, spark.read.parquet(path).drop("batch").collect())
    )
    # The first call's estimate fits; its cost takes the session beyond its limit.
    assert out[1].allowed and out[2].allowed and out[3].allowed
    assert not out[4].allowed and out[5].allowed and out[5].cumulative_cost_usd is None


def test_rate_audit(spark, log):
    path, checkpoint = paths(spark, "rate")
    J.stream_rate_audit(
        stream(spark, log), "feature", path, checkpoint, "0.0001", 4, None
    ).awaitTermination()
    columns = ["call_id", "tokens_before", "allowed", "retry_after_s"]
    streamed = spark.read.parquet(path).select(columns).collect()
    batch = R.rate_audit(tables.read_usage(spark, log), ["feature"], "0.0001", 4)
    assert sorted(map(str, streamed)) == sorted(map(str, batch.select(columns).collect()))
    assert {r.allowed for r in streamed} == {True, False}


def test_other_keys_do_not_fill_a_bucket(spark):
    """Rate 1, burst 1: A at 0 s and B at 600 s, then A at 0.1 s, and the same without a key."""
    start = datetime(2024, 1, 1)
    rows = [[("A", 1, start), ("B", 2, start + timedelta(seconds=600)), (None, 4, start)],
            [("A", 3, start + timedelta(seconds=0.1)), (None, 5, start)]]
    calls = source(spark, "clocks", rows, "feature string, call_id long, timestamp timestamp")
    path, checkpoint = paths(spark, "clocks-out")
    J.stream_rate_audit(calls, "feature", path, checkpoint, 1, 1, None).awaitTermination()
    allowed = {r.call_id: r.allowed for r in spark.read.parquet(path).collect()}
    assert allowed == {1: True, 2: True, 3: False, 4: True, 5: False}


def test_spend_counts_late_calls(spark, log):
    late = spark.read.schema(tables.USAGE).parquet(log).where("call_id < 5").withColumn(
        "timestamp", F.lit("2001-01-01").cast("timestamp")
    )
    twice = shared_path(spark, "late")
    for rows in (tables.read_usage(spark, log), late):
        rows.coalesce(1).write.mode("append").parquet(twice)
    path, checkpoint = paths(spark, "spend")
    J.stream_spend(
        stream(spark, twice), I.pricing, ["feature"], path, checkpoint, "1 day", None
    ).awaitTermination()
    rows = J.read_spend(spark, path, {"feature": "string"})
    assert rows.agg(F.sum("calls")).first()[0] == tables.read_usage(spark, twice).count()
    assert rows.where("window_start < '2002-01-01'").agg(F.sum("calls")).first()[0] == late.count()


def test_usage_is_stored_once_per_call_however_late(spark):
    place, (path, checkpoint) = shared_path(spark, "twice"), paths(spark, "once")
    rows = sinks.usage_rows(I.usage_calls(spark, SF)).drop("date")
    late = rows.limit(3).withColumns(
        {"call_id": F.col("call_id") + 10**9, "timestamp": F.lit("2001-01-01").cast("timestamp")}
    )
    unnamed = rows.limit(2).withColumn("call_id", F.lit(None).cast("long"))
    for part in (rows, rows, late, late, unnamed):
        part.coalesce(1).write.mode("append").parquet(place)
    for _ in range(2):  # a second run finds nothing new
        J.write_usage_stream(stream(spark, place), path, checkpoint, None).awaitTermination()
    stored = tables.read_usage(spark, path)
    assert stored.count() == rows.count() + 3 + 2
    assert stored.select("call_id").distinct().count() == rows.count() + 3 + 1


@pytest.mark.parametrize("empty", [(0,), (3,), (7,), (0, 1, 6, 7), range(8)])
def test_micro_batches_without_rows(spark, empty):
    """Eight micro-batches, some empty; the index and the sums are merged every two of them."""
    day = datetime(2024, 1, 1)
    rows = [[(10 * i + j, day + timedelta(days=j % 2, hours=i)) for j in range(5)] for i in range(8)]
    rows = [[(1, day + timedelta(days=1))] if i and i % 3 == 0 else r for i, r in enumerate(rows)]  # and one that comes again
    rows = [[] if i in empty else r for i, r in enumerate(rows)]
    schema = "call_id long, timestamp timestamp"
    calls = source(spark, "gaps", rows, schema).withColumns(
        {"model": F.lit("gpt-4"), "feature": F.lit("f")}
        | {c: F.lit(1).cast("long") for c in ("input_tokens", "output_tokens", "cache_creation_tokens", "cache_read_tokens")}
    )
    path, checkpoint = paths(spark, "gaps-out")
    J.write_usage_stream(calls, path, checkpoint, None, fan=2).awaitTermination()
    stored = [r.call_id for r in tables.read_usage(spark, path).collect()]
    assert sorted(stored) == sorted({c for r in rows for c, _ in r})
    path, checkpoint = paths(spark, "gaps-spend")
    J.stream_spend(calls, I.pricing, ["feature"], path, checkpoint, None, None, fan=2).awaitTermination()
    spend = J.read_spend(spark, path, {"feature": "string"}, fan=2).collect()
    assert sum(r.calls for r in spend) == sum(map(len, rows))


def test_repeats_over_many_micro_batches(spark):
    """Every call comes again, up to twelve micro-batches later, in its own one and with no id."""
    day = datetime(2024, 1, 1)
    rows = []
    for i in range(13):
        fresh = [(100 * i + j, day + timedelta(days=j)) for j in range(4)]
        again = [(100 * k + k % 4, day + timedelta(days=k % 4)) for k in range(i)]
        rows.append(fresh + fresh[:2] + again + [(None, day)])
    calls = source(spark, "again", rows, "call_id long, timestamp timestamp")
    path, checkpoint = paths(spark, "again-out")
    J.write_usage_stream(calls, path, checkpoint, None, fan=3).awaitTermination()
    stored = [r.call_id for r in tables.read_usage(spark, path).collect()]
    assert stored.count(None) == 13
    named = [c for c in stored if c is not None]
    assert sorted(named) == [100 * i + j for i in range(13) for j in range(4)]
    # 13 micro-batches are 1 run of nine, 1 of three and 1 of one; what the last merge read is still there.
    index = J._key_index(spark, checkpoint, 3)
    assert index.live(13) == [(0, 12), (1, 3), (2, 0)]
    assert index.stored().count() == 52


def test_runs_stay_few(spark):
    """A thousand runs leave a handful of folders, each row in one of them, and can be repeated."""
    schema = tables.USAGE.__class__.fromDDL("k string, n long")
    runs = Runs(spark, shared_path(spark, "runs"), schema, lambda r: r.groupBy("k").agg(F.sum("n").alias("n")), fan=4)
    covered = [run for number in (0, 1, 7, 64, 1000) for run in [runs.live(number)]]
    assert [sum(4**level for level, _ in live) for live in covered] == [0, 1, 7, 64, 1000]
    assert max(len(runs.live(n)) for n in range(1001)) <= 3 * 5
    assert runs.stored().count() == 0
    for number in range(21):
        rows = spark.createDataFrame([("a", 1), ("b", number)], schema)
        for _ in range(2 if number in (3, 15, 20) else 1):  # a micro-batch that failed late comes again
            before = {r.k: r.n for r in runs.merge(runs.before(number)).collect()}
            assert before == ({"a": number, "b": sum(range(number))} if number else {})
            runs.add(number, rows)
    assert {r.k: r.n for r in runs.merge(runs.stored()).collect()} == {"a": 21, "b": 210}
    assert sum(len(children(spark, f"{runs.root}/{level}")) for level in children(spark, runs.root)) <= 10


def test_stream_scan_and_signals_match_batch(spark):
    from spendguard.operators import governance as G

    messages = I.messages(spark, SF)
    arriving = I.messages_from_conversations(I.conversation_stream(spark, SF))
    streamed = J.drain(J.stream_scan(arriving), "gate").collect()
    assert sorted(map(str, streamed)) == sorted(map(str, G.privacy_gate(messages).collect()))
    path, checkpoint = paths(spark, "signals")
    place = F.lit("o"), F.lit("e"), F.lit("2024-01-31").cast("timestamp")
    J.stream_signals(arriving, *place, path, checkpoint, None).awaitTermination()
    batch = G.governance_signals(G.first_violations(messages), *place)
    columns = ["request_id", "violation_type", "violation_subtype", "detected_at"]
    got = J.read_signals(spark, path).select(columns).collect()
    assert sorted(map(str, got)) == sorted(map(str, batch.select(columns).collect()))


def test_budget_state_and_alerts_while_calls_come(spark):
    """Thresholds crossed in different micro-batches, at once and never; state merged every two of them."""
    from spendguard.schemas import POLICIES

    def call(number, org, tokens):
        return (number, org, datetime(2024, 1, 1), "gpt-4", tokens, 0, None, None)

    # A thousand input tokens cost 0.03 dollars.
    batches = [[call(1, "o", 10_000), call(2, "p", 10)], [], [call(3, "o", 10_000)], [call(4, "o", 50_000), call(5, None, 9)]]
    ddl = "call_id long, org_id string, timestamp timestamp, model string, input_tokens long, output_tokens long, cache_creation_tokens long, cache_read_tokens long"
    rows = [("a", "o", 1.0, 0.0, True), ("b", "o", 100.0, 0.0, True), ("c", "o", 1.0, 0.0, False), ("d", "q", 0.1, 0.0, True), ("e", "o", 1.0, 0.65, True)]
    policies = spark.createDataFrame(
        [(i, org, amount, spent, active, [50, 80, 90], 100 * spent / amount) for i, org, amount, spent, active in rows],
        "id string, org_id string, budget_amount_usd double, current_spend_usd double, is_active boolean, alert_thresholds array<int>, spend_percentage double",
    )
    policies = tables.load_policies(policies)
    assert policies.columns == POLICIES.fieldNames()
    path, checkpoint = paths(spark, "budget")
    J.stream_budget(source(spark, "budget-calls", batches, ddl), I.pricing, lambda _: policies, path, checkpoint, None, fan=2).awaitTermination()
    alerts = spark.read.parquet(f"{path}/alerts")
    assert sorted((r.batch, r.id, r.threshold) for r in alerts.collect()) == [
        (0, "e", 80), (0, "e", 90), (2, "a", 50), (3, "a", 80), (3, "a", 90)
    ]
    state = {r.id: r.current_spend_usd for r in J.read_budget(spark, path, policies, fan=2).collect()}
    assert state == pytest.approx({"a": 2.1, "b": 2.1, "c": 2.1, "d": 0.0, "e": 2.75})


def test_discrepancies_as_calls_are_stored(spark, log):
    def answers(costed):
        return costed.where("call_id % 3 <> 0").select("call_id", (F.col("cost_usd") * (1 + F.col("call_id") % 4 / 100)).alias("server_cost_usd"))

    path, checkpoint = paths(spark, "off")
    J.stream_cost_discrepancies(stream(spark, log), I.pricing, answers, path, checkpoint, interval=None).awaitTermination()
    costed = K.with_cost(tables.read_usage(spark, log), I.pricing(spark))
    batch = K.cost_discrepancies(costed, answers(costed))
    assert sorted(r.call_id for r in spark.read.parquet(path).collect()) == sorted(r.call_id for r in batch.collect())
    assert batch.count() > 0
