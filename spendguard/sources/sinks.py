"""Writers for usage, signals and session rows. All append to partitioned files."""

from pyspark.sql import DataFrame, functions as F, types as T

from ..operators.usage import nullify_zero_cache
from ..schemas import SESSION_CALLS, SESSION_CLOSURES, SIGNALS, USAGE
from .tables import _typed


def _append(df: DataFrame, path: str, format: str, by: list[str]):
    # Rebalancing gathers each folder's rows into few files and still splits a hot folder.
    df.hint("rebalance", *by).write.format(format).mode("append").partitionBy(*by).save(path)


def usage_rows(calls: DataFrame) -> DataFrame:
    """Rows as stored: declared columns, zero cache counters as NULL, and the call's date."""
    typed = nullify_zero_cache(_typed(calls, USAGE))
    return typed.withColumn("date", F.to_date("timestamp"))


def write_usage(calls: DataFrame, path: str, format: str = "parquet"):
    _append(usage_rows(calls), path, format, ["date"])


def signal_rows(signals: DataFrame, keys=()) -> DataFrame:
    """Signal columns and ``keys`` only, so no text can slip through; a missing count is 1."""
    known = [T.StructField(k, signals.schema[k].dataType) for k in keys]
    typed = _typed(signals, T.StructType([*known, *SIGNALS.fields]))
    return typed.withColumn("violation_count", F.coalesce("violation_count", F.lit(1)))


def write_signals(signals: DataFrame, path: str, format: str = "parquet"):
    _append(signal_rows(signals), path, format, ["violation_type"])


def session_call_rows(ledger: DataFrame, detected: DataFrame) -> DataFrame:
    """Ledger rows with ``pii_detected`` from (call_id, detected); a call without text is clean,
    one without a session has no row."""
    marked = ledger.where("session_id IS NOT NULL").withColumn("created_at", F.col("timestamp")).join(
        detected.select("call_id", F.col("detected").alias("pii_detected")), "call_id", "left"
    )
    marked = marked.withColumn("pii_detected", F.coalesce("pii_detected", F.lit(False)))
    return _typed(marked, SESSION_CALLS)


def write_session_calls(ledger: DataFrame, detected: DataFrame, path: str, format="parquet"):
    rows = session_call_rows(ledger, detected).withColumn("date", F.to_date("created_at"))
    _append(rows, path, format, ["date"])


def session_closure_rows(summary: DataFrame) -> DataFrame:
    return _typed(summary.where("status <> 'active'"), SESSION_CLOSURES)


def write_session_closures(summary: DataFrame, path: str, format: str = "parquet"):
    _append(session_closure_rows(summary), path, format, ["status"])
