"""The jobs as streams.

Jobs with state per key keep it in the engine's state store and see rows in arrival order: within
one micro-batch they are ordered by (timestamp, call_id), and later micro-batches are taken as
later. No stream drops a row for being late: stores take what comes, sums are added up, and state is
kept for every key.
"""

from collections.abc import Iterator
from typing import Callable

import numpy as np
import pandas as pd
import pyspark.sql.types as T
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.budgets import apply_spend, spend_percentage
from ..operators.cost import cost_discrepancies, money, with_cost, with_cost_and_estimate
from ..operators.governance import governance_signals, message_violations, privacy_gate
from ..operators.rate import DEFAULT_BURST, DEFAULT_RATE, Bucket
from ..operators.rate import Walk as RateWalk
from ..operators.sessions import (
    BUDGET, DOLLAR, INPUTS, ITERATIONS, NEW, OVER_BUDGET, OVER_CALLS, PASSED, STATE, UNDECIDED, limit_inputs,
)
from ..operators.sessions import Walk as SessionWalk
from ..runtime import checkpointed, exists, make_folder, shared_path
from ..schemas import TOTAL, USAGE
from ..sources.sinks import signal_rows, usage_rows
from .runs import FAN, Runs

#: Reads a table as it is now: called in every micro-batch, so that prices and limits refresh.
Reader = Callable[[SparkSession], DataFrame]


def _start(stream: DataFrame, process, checkpoint: str, interval: str | None) -> StreamingQuery:
    """Run ``process(batch, number)``; ``interval=None`` drains what is there and stops."""
    writer = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    if interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def stream_cost(
    calls: DataFrame, prices: Reader, path: str, checkpoint: str, interval: str | None = "5 seconds"
) -> StreamingQuery:
    """Store the cost of each call, at the prices that hold when its micro-batch runs."""

    def process(batch: DataFrame, number: int):
        costed = with_cost(batch, prices(batch.sparkSession))
        costed.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return _start(calls, process, checkpoint, interval)


def stream_cost_discrepancies(
    calls: DataFrame,
    prices: Reader,
    server_costs: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    tolerance: float = 0.01,
    interval: str | None = "5 seconds",
) -> StreamingQuery:
    """Compare costs as calls are stored: of each micro-batch, the calls whose server cost is off.

    ``server_costs`` gets the micro-batch with its ``cost_usd`` and gives the answers to it,
    (call_id, server_cost_usd); a call without an answer is not compared.
    """

    def process(batch: DataFrame, number: int):
        costed = checkpointed(with_cost(batch, prices(batch.sparkSession)))
        found = cost_discrepancies(costed, server_costs(costed), tolerance)
        found.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return _start(calls, process, checkpoint, interval)


def _total_spend(rows: DataFrame, keys: list[str]) -> DataFrame:
    total = F.sum("spend_usd").cast(TOTAL).alias("spend_usd")
    return rows.groupBy("window_start", *keys).agg(total, F.sum("calls").alias("calls"))


def _spend_runs(spark: SparkSession, path: str, kinds: list[T.StructField], fan: int) -> Runs:
    keys = [k.name for k in kinds]
    fields = [T.StructField("window_start", T.TimestampType()), *kinds]
    schema = T.StructType([*fields, T.StructField("spend_usd", TOTAL), T.StructField("calls", T.LongType())])
    return Runs(spark, path, schema, lambda rows: _total_spend(rows, keys), fan=fan)


def stream_spend(
    calls: DataFrame,
    prices: Reader,
    keys: list[str],
    path: str,
    checkpoint: str,
    window: str | None = "1 day",
    interval: str | None = "5 seconds",
    fan: int = FAN,
) -> StreamingQuery:
    """Spend and calls per key and tumbling window, however late a call comes.

    Each micro-batch stores its own sums as a run; runs are added up into larger ones as they
    become many, and ``read_spend`` adds up the rest. Windows start on the epoch's Monday for weeks,
    as calendars do; ``window=None`` groups by calendar month.
    """
    kinds = [T.StructField(k, calls.schema[k].dataType) for k in keys]

    def process(batch: DataFrame, number: int):
        costed = with_cost(batch, prices(batch.sparkSession))
        if window is None:
            grouped = costed.groupBy(F.date_trunc("month", "timestamp").alias("window_start"), *keys)
        else:
            offset = "4 days" if window.split()[1].startswith("week") or window == "7 days" else "0 days"
            start = F.window("timestamp", window, window, offset)["start"]
            grouped = costed.groupBy(start.alias("window_start"), *keys)
        sums = grouped.agg(F.sum(money("cost_usd")).cast(TOTAL).alias("spend_usd"), F.count(F.lit(1)).alias("calls"))
        _spend_runs(batch.sparkSession, path, kinds, fan).add(number, sums)

    return _start(calls, process, checkpoint, interval)


def read_spend(spark: SparkSession, path: str, keys: dict[str, str], fan: int = FAN) -> DataFrame:
    """What ``stream_spend`` has stored so far; ``keys`` has the names and types of its keys."""
    kinds = T.StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in keys.items())).fields
    return _total_spend(_spend_runs(spark, path, kinds, fan).stored(), [*keys])


def _budget_runs(spark: SparkSession, path: str, fan: int) -> Runs:
    schema = T.StructType([T.StructField("org_id", T.StringType()), T.StructField("cost_usd", TOTAL)])
    total = F.sum("cost_usd").cast(TOTAL).alias("cost_usd")
    return Runs(spark, f"{path}/spend", schema, lambda rows: rows.groupBy("org_id").agg(total), fan=fan)


def stream_budget(
    calls: DataFrame,
    prices: Reader,
    policies: Reader,
    path: str,
    checkpoint: str,
    interval: str | None = "5 seconds",
    fan: int = FAN,
) -> StreamingQuery:
    """Keep the spend that budgets are measured by while calls come, and raise alerts.

    A call adds to all policies of its organisation, as in ``apply_spend``. A micro-batch stores its
    sums, one row an organisation, and the thresholds that active policies cross with it; policies
    are read anew every time. ``read_budget`` gives the policies' state, ``read_alerts`` the alerts.
    """

    def process(batch: DataFrame, number: int):
        spark = batch.sparkSession
        runs, cost = _budget_runs(spark, path, fan), F.sum(money("cost_usd")).cast(TOTAL).alias("cost_usd")
        sums = checkpointed(with_cost(batch, prices(spark)).groupBy("org_id").agg(cost))
        here = policies(spark).where("is_active").join(sums.select("org_id"), "org_id", "left_semi")
        earlier = apply_spend(here, runs.before(number))
        before = spend_percentage(F.col("current_spend_usd"), F.col("budget_amount_usd"), F.col("spend_percentage"))
        now = apply_spend(earlier.withColumn("_before", before), sums)
        over = F.filter("alert_thresholds", lambda t: (t <= F.col("spend_percentage")) & (t > F.col("_before")))
        alerts = now.select("id", "org_id", F.explode(over).alias("threshold"), "current_spend_usd", "spend_percentage")
        alerts.write.mode("overwrite").parquet(f"{path}/alerts/batch={number}")
        runs.add(number, sums)

    return _start(calls, process, checkpoint, interval)


def read_budget(spark: SparkSession, path: str, policies: DataFrame, fan: int = FAN) -> DataFrame:
    """Policies with the spend that ``stream_budget`` has stored so far."""
    return apply_spend(policies, _budget_runs(spark, path, fan).stored())


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """The thresholds that policies have crossed so far, each as it was then."""
    return spark.read.parquet(f"{path}/alerts").drop("batch")


def stream_scan(messages: DataFrame) -> DataFrame:
    """The privacy gate on a stream of messages; stateless."""
    return privacy_gate(messages)


def stream_signals(
    messages: DataFrame,
    organization_id: Column,
    environment: Column,
    detected_at: Column,
    path: str,
    checkpoint: str,
    interval: str | None = "5 seconds",
) -> StreamingQuery:
    """Store the signals of blocked messages as they come, with their place and without text.

    Messages of one request may come in any micro-batch; ``read_signals`` keeps those of the first
    blocked message of each request.
    """

    def process(batch: DataFrame, number: int):
        blocked = message_violations(batch)
        keys = ("request_id", "msg_index")
        signals = governance_signals(blocked, organization_id, environment, detected_at, keys)
        rows = signal_rows(signals, keys)
        rows.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return _start(messages, process, checkpoint, interval)


def read_signals(spark: SparkSession, path: str) -> DataFrame:
    """The signals that ``stream_signals`` has stored so far, of each request's first blocked message."""
    stored = spark.read.parquet(path).drop("batch")
    first = stored.groupBy("request_id").agg(F.min("msg_index").alias("msg_index"))
    return stored.join(first, ["request_id", "msg_index"], "left_semi")


def _stateful(stream: DataFrame, path: str, checkpoint: str, interval: str | None, by=()) -> StreamingQuery:
    """Start a stream with state of the engine; a repeated micro-batch overwrites its folder."""

    def store(batch: DataFrame, number: int):
        batch.write.mode("overwrite").partitionBy(*by).parquet(f"{path}/batch={number}")

    return _start(stream, store, checkpoint, interval)


class Chain:
    """Streams that hand rows on to the next one: waited for and stopped together."""

    def __init__(self, *queries: StreamingQuery):
        self.queries = queries

    def awaitTermination(self, timeout: int | None = None):
        for query in self.queries:
            query.awaitTermination(*([] if timeout is None else [timeout]))

    def processAllAvailable(self):
        for query in self.queries:
            query.processAllAvailable()

    def stop(self):
        for query in self.queries:
            query.stop()


PRICED = """session_id string, call_id long, timestamp timestamp, cost_usd double, _arrival long, _cost long,
_estimate long, _tokens long, _max_usd long, _max_part long, _max_calls long, _eligible boolean"""
LEDGER = """session_id string, call_id long, timestamp timestamp, call_sequence long, cumulative_input_tokens long,
cumulative_cost_usd double, cost_usd double, allowed boolean, reason string, status string, arrival long"""
LEDGER_STATE = "usd long, part long, calls long, tokens long, refused boolean"
#: The engine hands Python one group at a time and converts each column of a group by itself, which
#: costs more than to decide a session's few calls. So a call's whole numbers go in one array and
#: come back in one. ``_nulls`` has 1 for a missing time and 2 for a missing call_id; both sort last.
PLACE = ["_arrival", "_us", "call_id", "_nulls"]
PACKED, DECIDED = [*PLACE, *INPUTS], [*PLACE, *STATE, "_verdict"]
DECIDED_ROW = "session_id string, cost_usd double, _decided array<bigint>"
MISSING = 2**63 - 1


def _packed(priced: DataFrame) -> DataFrame:
    nulls = F.isnull("timestamp").cast("long") + F.isnull("call_id").cast("long") * 2
    rows = priced.withColumns({"_us": F.unix_micros("timestamp"), "_nulls": nulls})
    numbers = [F.coalesce(F.col(c).cast("long"), F.lit(MISSING)) for c in PACKED]
    return rows.select("session_id", "cost_usd", F.array(*numbers).alias("_call"))


def _decide(key, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """One session's new calls as ``DECIDED``, from its state in the store."""
    frames = list(frames)
    calls = np.stack([call for frame in frames for call in frame["_call"].to_numpy()])
    costs = np.concatenate([frame["cost_usd"].to_numpy() for frame in frames])
    arrivals, times, ids = calls[:, :3].T
    order = np.lexsort((ids, times, arrivals))
    calls, costs, arrivals = calls[order], costs[order], arrivals[order]
    walk = SessionWalk(dict(zip(INPUTS, calls[:, len(PLACE) :].T)))
    usd, part, *rest = state.get if state.exists else (*divmod(NEW[0], DOLLAR), *NEW[1:])
    # The limits of a micro-batch hold for its calls: a stretch of rows for each arrival.
    cuts = [0, *(np.flatnonzero(np.diff(arrivals)) + 1).tolist(), len(calls)]
    now = usd * DOLLAR + part, *rest
    for at, end in zip(cuts, cuts[1:]):
        now = walk.run(at, end, now)
    state.update((*divmod(now[0], DOLLAR), now[1], now[2], bool(now[3])))
    totals = [*(walk.after[c] for c in STATE[:4]), walk.refused, walk.verdict]
    done = np.column_stack([calls[:, : len(PLACE)], *totals])
    yield pd.DataFrame({"session_id": key[0], "cost_usd": costs, "_decided": list(done)})


def _ledger_rows(decided: DataFrame) -> DataFrame:
    """``LEDGER`` rows out of ``DECIDED``."""
    at = {name: F.get("_decided", F.lit(i)) for i, name in enumerate(DECIDED)}
    verdict, spend = at["_verdict"], at["_usd"].cast("double") + at["_part"].cast("double") / F.lit(float(DOLLAR))
    return decided.select(
        "session_id",
        F.when(at["_nulls"] < 2, at["call_id"]).alias("call_id"),
        F.when(at["_nulls"] % 2 == 0, F.timestamp_micros(at["_us"])).alias("timestamp"),
        at["_calls"].alias("call_sequence"),
        at["_sum_tokens"].alias("cumulative_input_tokens"),
        spend.alias("cumulative_cost_usd"),
        "cost_usd",
        F.when(verdict != UNDECIDED, verdict == PASSED).alias("allowed"),
        F.when(verdict == OVER_BUDGET, BUDGET).when(verdict == OVER_CALLS, ITERATIONS).alias("reason"),
        F.when(at["_refused"] == 1, "terminated").otherwise("active").alias("status"),
        at["_arrival"].alias("arrival"),
    )


def _loose_rows(priced: DataFrame) -> DataFrame:
    """``LEDGER`` rows of the calls without a session: no totals, and allowed."""
    told = {"allowed": F.lit(True), "arrival": F.col("_arrival")}
    named = {c: F.col(c) for c in ("session_id", "call_id", "timestamp", "cost_usd")} | told
    fields = T.StructType.fromDDL(LEDGER).fields
    rows = priced.where("session_id IS NULL")
    return rows.select(*[named.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])


def stream_session_ledger(
    calls: DataFrame,
    prices: Reader,
    limits: Reader,
    path: str,
    checkpoint: str,
    interval: str | None = "5 seconds",
) -> Chain:
    """Session ledger over a stream, each session with its own limits.

    Two streams: the first prices each micro-batch of calls and adds the sessions' limits, both
    read anew every time (``limits`` has session_id, max_spend_usd and max_iterations); the second
    decides the calls from the sessions' totals in the engine's state store. Calls are decided in
    the order in which the first stream got them, whichever micro-batch of the second they meet.
    A refused call adds nothing, so its row shows the totals before it. Calls without a session
    have no totals and are allowed. ``session_summary`` of the stored rows and the close events
    gives the sessions' final states.
    """
    spark, staged = calls.sparkSession, f"{checkpoint}/priced"
    make_folder(spark, staged)

    def price(batch: DataFrame, number: int):
        if exists(batch.sparkSession, f"{staged}/batch={number}/_SUCCESS"):
            return  # handed on already; the second stream may have read it
        priced = with_cost_and_estimate(batch, prices(batch.sparkSession))
        own = limits(batch.sparkSession).select("session_id", "max_spend_usd", "max_iterations")
        told = priced.join(own, "session_id", "left").withColumn("_arrival", F.lit(number).cast("long"))
        told = told.withColumns(limit_inputs(told, F.col("max_spend_usd"), F.col("max_iterations")))
        names = T.StructType.fromDDL(PRICED).fieldNames()
        told.select(*names).write.mode("overwrite").parquet(f"{staged}/batch={number}")

    first = _start(calls, price, f"{checkpoint}/pricing", interval)
    if interval is None:
        first.awaitTermination()
    priced = spark.readStream.schema(PRICED).parquet(f"{staged}/*")
    by_session = _packed(priced.where("session_id IS NOT NULL")).groupBy("session_id")
    decided = by_session.applyInPandasWithState(_decide, DECIDED_ROW, LEDGER_STATE, "append", "NoTimeout")
    ledger = _ledger_rows(decided).unionByName(_loose_rows(priced))
    return Chain(first, _stateful(ledger, path, f"{checkpoint}/ledger", interval, ["arrival"]))


AUDIT = "key string, call_id long, timestamp timestamp, tokens_before double, allowed boolean, retry_after_s long"


def stream_rate_audit(
    calls: DataFrame,
    key: str,
    path: str,
    checkpoint: str,
    rate=DEFAULT_RATE,
    burst=DEFAULT_BURST,
    interval: str | None = "5 seconds",
) -> StreamingQuery:
    """Token-bucket audit over a stream; the engine keeps the level and the last call time of each
    key.

    A call that comes after later ones earns no refill and does not move the key's clock back. The
    calls of a key in one micro-batch are decided together, in bulk, so the size of a micro-batch
    bounds what a hot key asks of a task.
    """
    bucket = Bucket.of(rate, burst)

    def audit(_, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames)).sort_values(["_us", "call_id"], kind="stable")
        times = rows["_us"].to_numpy()
        walk = RateWalk(bucket, times)
        level, last = state.get if state.exists else (bucket.full, int(times[0]))
        state.update(walk.run(0, len(times), level, last))
        done = walk.output()
        yield rows[["key", "call_id", "timestamp"]].assign(
            tokens_before=done["tokens_before"], allowed=done["allowed"], retry_after_s=done["retry_after_s"].to_pandas().array
        )

    timed = calls.select(F.col(key).cast("string").alias("key"), "call_id", "timestamp", F.unix_micros("timestamp").alias("_us"))
    audited = timed.groupBy("key").applyInPandasWithState(audit, AUDIT, "level long, last long", "append", "NoTimeout")
    return _stateful(audited, path, checkpoint, interval)


KEY_BUCKETS = 64


def _key_index(spark: SparkSession, checkpoint: str, fan: int) -> Runs:
    """The call_ids stored so far, by day, sorted by hash bucket within a file."""
    kinds = {f.name: f.dataType for f in USAGE.fields}
    schema = T.StructType(
        [T.StructField("bucket", T.IntegerType()), T.StructField("call_id", kinds["call_id"]), T.StructField("date", T.DateType())]
    )
    return Runs(spark, f"{checkpoint}/stored-calls", schema, lambda rows: rows, ["date"], ["bucket", "call_id"], fan)


def write_usage_stream(
    calls: DataFrame, path: str, checkpoint: str, interval: str | None = "5 seconds", fan: int = FAN
) -> StreamingQuery:
    """Store usage rows per micro-batch, once per call_id, however late; returns the running query.

    A call that comes again, with the same time, is found in an index of the stored call_ids, of
    which a micro-batch reads the days that it touches, as far as the range of its own buckets goes.
    The index is merged as it grows, so what a micro-batch opens does not grow with their number;
    stored usage itself is never read again. Calls without a call_id cannot be told apart and are
    all stored. A repeated micro-batch overwrites its own folder and does not look into it. Each
    day's rows of a micro-batch are gathered into few files. A micro-batch may be empty.
    """

    def store(batch: DataFrame, number: int):
        index = _key_index(batch.sparkSession, checkpoint, fan)
        bucket = F.pmod(F.xxhash64("call_id"), F.lit(KEY_BUCKETS)).cast("int").alias("bucket")
        rows = checkpointed(usage_rows(batch).select("*", bucket))
        named = rows.where("call_id IS NOT NULL").dropDuplicates(["call_id", "date"])
        # One row a day: the days of one micro-batch and their buckets.
        range_of = F.min("bucket").alias("low"), F.max("bucket").alias("high")
        days = rows.where("call_id IS NOT NULL").groupBy("date").agg(*range_of).collect()
        kept = F.lit(False)
        for day in days:
            kept = kept | (F.col("date").eqNullSafe(F.lit(day.date)) & F.col("bucket").between(day.low, day.high))
        seen = index.before(number).where(kept).select("bucket", "call_id", F.col("date").alias("_date"))
        same = [named["bucket"] == seen["bucket"], named["call_id"] == seen["call_id"], named["date"].eqNullSafe(seen["_date"])]
        fresh = checkpointed(named.join(seen, same, "left_anti")) if days else named
        every = fresh.unionByName(rows.where("call_id IS NULL")).drop("bucket")
        writer = every.hint("rebalance", "date").write.mode("overwrite").partitionBy("date")
        writer.parquet(f"{path}/batch={number}")
        index.add(number, fresh)

    return _start(calls, store, checkpoint, interval)


def drain(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over the data that is there now, into files, and read them back."""
    spark = stream.sparkSession
    path, checkpoint = shared_path(spark, name), shared_path(spark, f"{name}-checkpoint")
    writer = stream.writeStream.option("checkpointLocation", checkpoint)
    query = writer.format("parquet").option("path", path).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)
