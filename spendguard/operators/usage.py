"""Normalised usage rows and validation of usage, price and policy tables."""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.spans import kept_if
from ..functions.usage import SUPPORTED, nullify_zero, usage_record
from ..schemas import BUDGET_ACTIONS, BUDGET_PERIODS, BUDGET_SCOPES, PROVIDERS


def normalise_usage(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split raw responses (``payload`` JSON, optional ``provider``) into (usage, rejects).

    A row without a provider gets the one its payload looks like. Rows whose provider has no
    extractor are kept in ``rejects``.
    """
    others = [c for c in raw.columns if c not in ("payload", "provider")]
    given = F.col("provider") if "provider" in raw.columns else F.lit(None).cast("string")
    record = usage_record(given, F.col("payload"))

    def supported(r):
        return F.coalesce(r["provider"].isin(*SUPPORTED), F.lit(False))

    good = raw.select(*others, kept_if(record, supported)).select(
        *others,
        "provider",
        "usage.input_tokens",
        "usage.output_tokens",
        nullify_zero(F.col("usage.cache_creation_tokens")).alias("cache_creation_tokens"),
        nullify_zero(F.col("usage.cache_read_tokens")).alias("cache_read_tokens"),
    )
    bad = raw.select(*others, "payload", kept_if(record, lambda r: ~supported(r))).select(
        *others, "payload", "provider", F.lit("unsupported provider").alias("reason")
    )
    return good, bad


def nullify_zero_cache(df: DataFrame) -> DataFrame:
    names = ["cache_creation_tokens", "cache_read_tokens"]
    return df.withColumns({n: nullify_zero(F.col(n)) for n in names})


def check(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Split into (valid, rejects); a reject lists every failed rule in ``errors``.

    A rule that evaluates to NULL counts as failed.
    """
    failed = [
        F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()
    ]
    errors = F.struct(F.array_compact(F.array(*failed)).alias("errors"))
    return (
        df.select(*df.columns, kept_if(errors, lambda e: F.size(e["errors"]) == 0)).drop("errors"),
        df.select(*df.columns, kept_if(errors, lambda e: F.size(e["errors"]) > 0)),
    )


def _text(name: str) -> Column:
    return F.length(F.col(name)) > 0


def _count(name: str, optional: bool = False) -> Column:
    number = F.expr(f"try_cast({name} AS DOUBLE)")
    rule = (number >= 0) & (number == F.floor(number))
    return F.col(name).isNull() | rule if optional else rule


def _rate(name: str, optional: bool = False) -> Column:
    rule = F.col(name) >= 0
    return F.col(name).isNull() | rule if optional else rule


# An ISO date-time in UTC, as the log writers send it.
ISO_UTC = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?Z$"


def usage_rules(df: DataFrame) -> dict[str, Column]:
    if dict(df.dtypes)["timestamp"] == "string":
        when = F.col("timestamp").rlike(ISO_UTC) & F.expr(
            "try_cast(timestamp AS TIMESTAMP) IS NOT NULL"
        )
    else:
        when = F.col("timestamp").isNotNull()
    latency = F.expr("try_cast(latency_ms AS DOUBLE)")
    return {
        "api_key": _text("api_key"),
        "timestamp": when,
        "provider": F.col("provider").isin(PROVIDERS),
        "model": _text("model"),
        "input_tokens": _count("input_tokens"),
        "output_tokens": _count("output_tokens"),
        "cache_creation_tokens": _count("cache_creation_tokens", optional=True),
        "cache_read_tokens": _count("cache_read_tokens", optional=True),
        "latency_ms": F.col("latency_ms").isNull() | (latency == F.floor(latency)),
    }


def validate_usage(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return check(df, usage_rules(df))


def validate_pricing(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    rules = {
        "provider": F.col("provider").isNotNull(),
        "model": F.col("model").isNotNull(),
        "input_cost_per_1k": _rate("input_cost_per_1k"),
        "output_cost_per_1k": _rate("output_cost_per_1k"),
        "cache_creation_cost_per_1k": _rate("cache_creation_cost_per_1k", optional=True),
        "cache_read_cost_per_1k": _rate("cache_read_cost_per_1k", optional=True),
    }
    return check(df, rules)


def validate_policies(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Required columns present, words from the allowed lists, whole-number days and thresholds."""
    required = ["id", "name", "budget_amount_usd", "current_spend_usd", "spend_percentage",
                "period_start", "is_active", "created_at", "updated_at"]
    whole = F.forall("alert_thresholds", lambda t: t == F.floor(t))
    rules = {name: F.col(name).isNotNull() for name in required}
    rules |= {
        "scope": F.col("scope").isin(BUDGET_SCOPES),
        "period": F.col("period").isin(BUDGET_PERIODS),
        "action": F.col("action").isin(BUDGET_ACTIONS),
        "custom_period_days": _whole("custom_period_days"),
        "alert_thresholds": F.col("alert_thresholds").isNull() | whole,
    }
    return check(df, rules)


def _whole(name: str) -> Column:
    return F.col(name).isNull() | (F.col(name) == F.floor(F.col(name)))
