"""What calls cost: price joins, estimates, discrepancies and reports."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..schemas import MONEY

ESTIMATE_TOKENS = 500  # fixed value: input and output tokens of a pre-flight estimate
RATES = [
    "input_cost_per_1k",
    "output_cost_per_1k",
    "cache_creation_cost_per_1k",
    "cache_read_cost_per_1k",
]


def money(amount) -> Column:
    """Exact decimal of a dollar amount, so that sums do not depend on their order."""
    return (F.col(amount) if isinstance(amount, str) else amount).cast(MONEY)


def _cost(input_tokens, output_tokens, creation, read) -> Column:
    """Dollars at the joined rates. A missing cache rate falls back to the input rate."""

    def part(tokens, rate):
        return F.coalesce(tokens, F.lit(0)) / F.lit(1000.0) * rate

    base = F.col("input_cost_per_1k")
    total = (
        part(input_tokens, base)
        + part(output_tokens, F.col("output_cost_per_1k"))
        + part(creation, F.coalesce("cache_creation_cost_per_1k", base))
        + part(read, F.coalesce("cache_read_cost_per_1k", base))
    )
    return F.coalesce(total, F.lit(0.0))


def call_cost() -> Column:
    return _cost(*[F.col(c) for c in ("input_tokens", "output_tokens",
                                      "cache_creation_tokens", "cache_read_tokens")])


def estimated_cost() -> Column:
    tokens = F.lit(ESTIMATE_TOKENS)
    return _cost(tokens, tokens, F.lit(0), F.lit(0))


def with_rates(calls: DataFrame, pricing: DataFrame) -> DataFrame:
    """Attach the model's rates; the price table has one row per model.

    No forced broadcast: the optimiser broadcasts a price table it knows to be small and
    otherwise shuffles, where skewed models are split at run time.
    """
    return calls.join(pricing.select("model", *RATES), "model", "left")


def with_cost(calls: DataFrame, pricing: DataFrame) -> DataFrame:
    """Add ``cost_usd``; a model without a price costs 0. Prices are keyed by model alone."""
    return with_rates(calls, pricing).withColumn("cost_usd", call_cost()).drop(*RATES)


def with_estimate(calls: DataFrame, pricing: DataFrame) -> DataFrame:
    """Add ``estimated_cost_usd``, the fixed-size estimate made before a call."""
    out = with_rates(calls, pricing).withColumn("estimated_cost_usd", estimated_cost())
    return out.drop(*RATES)


def with_cost_and_estimate(calls: DataFrame, pricing: DataFrame) -> DataFrame:
    """Both dollar columns from one price join."""
    priced = with_rates(calls, pricing)
    added = {"cost_usd": call_cost(), "estimated_cost_usd": estimated_cost()}
    return priced.withColumns(added).drop(*RATES)


def cost_discrepancies(calls: DataFrame, server_costs: DataFrame, tolerance=0.01) -> DataFrame:
    """Calls whose server cost differs from the positive local ``cost_usd`` by over 1%."""
    both = calls.join(server_costs.where("server_cost_usd IS NOT NULL"), "call_id")
    gap = F.abs(F.col("server_cost_usd") - F.col("cost_usd")) / F.col("cost_usd")
    return (
        both.where("cost_usd > 0")
        .withColumn("difference", gap)
        .where(F.col("difference") > tolerance)
        .withColumn("difference_pct", F.col("difference") * 100)
        .drop("difference")
    )


def price_intervals(history: DataFrame, tie: str | None = None) -> DataFrame:
    """Turn dated prices into [effective_from, effective_to) rows, one shuffle of prices only.

    Of several prices of a model with one date the one with the largest ``tie`` counts, without
    ``tie`` (or among equal ones) that of the largest rates. A price equal to the one before it
    is merged with it.
    """
    rates = F.struct(*RATES)
    latest = F.max(F.struct(*([F.col(tie).alias("_tie")] if tie else []), *RATES))
    one = history.groupBy("model", "effective_from").agg(latest.alias("_row"))
    one = one.select("model", "effective_from", *[F.col(f"_row.{r}") for r in RATES])
    order = Window.partitionBy("model").orderBy("effective_from")
    before = one.withColumns({"_first": F.row_number().over(order) == 1, "_same": F.lag(rates).over(order).eqNullSafe(rates)})
    changed = before.where("_first OR NOT _same").drop("_first", "_same")
    return changed.withColumn("effective_to", F.lead("effective_from").over(order))


def daily_prices(intervals: DataFrame, days: DataFrame) -> DataFrame:
    """The intervals that touch each (model, _day) of ``days``.

    For a day these are the interval that is in force when it starts and those that start in it:
    both come from one ordered pass over a model's days and intervals, of which there are far
    fewer than calls.
    """
    price = F.struct("effective_from", "effective_to", *RATES)
    starts = intervals.select(
        "model", F.to_date("effective_from").alias("_day"), F.col("effective_from").alias("_at"), price.alias("_price")
    )
    begins = days.select("model", "_day", F.col("_day").cast("timestamp").alias("_at"))
    # At a day's first moment, a price that starts then comes before the day that asks for it.
    order = Window.partitionBy("model").orderBy("_at", F.col("_price").isNull())
    both = starts.unionByName(begins, allowMissingColumns=True)
    held = both.withColumn("_held", F.last("_price", ignorenulls=True).over(order))
    # A price that starts at the first moment of a day would come twice, as held and as starting.
    found = held.where("_held IS NOT NULL").select("model", "_day", F.col("_held").alias("_price")).distinct()
    return found.select(F.col("model").alias("_model"), F.col("_day").alias("_on"), "_price.*")


def with_cost_asof(calls: DataFrame, history: DataFrame, tie: str | None = None) -> DataFrame:
    """Add ``cost_usd`` at the price in force at call time; 0 before a model's first price.

    Calls are joined on model and day, so each is compared with the prices of its day only,
    however long the history is. The intervals of a model do not overlap, so the join adds no
    rows; a small history is broadcast by the optimiser, in a large one a hot model is spread
    over its days.
    """
    dated = calls.withColumn("_day", F.to_date("timestamp"))
    days = dated.select("model", "_day").distinct()
    spans = daily_prices(price_intervals(history, tie), days)
    in_force = (
        (F.col("model") == F.col("_model"))
        & (F.col("_day") == F.col("_on"))
        & (F.col("timestamp") >= F.col("effective_from"))
        & (F.col("effective_to").isNull() | (F.col("timestamp") < F.col("effective_to")))
    )
    out = dated.join(spans, in_force, "left").withColumn("cost_usd", call_cost())
    return out.drop("_day", "_model", "_on", "effective_from", "effective_to", *RATES)


def usage_report(calls: DataFrame, dims: list[str], subtotals: bool = False) -> DataFrame:
    """Spend, tokens and calls by any of provider, model, feature, customer; optional roll-up."""
    grouped = calls.rollup(*dims) if subtotals else calls.groupBy(*dims)
    return grouped.agg(
        F.sum(money("cost_usd")).alias("spend_usd"),
        F.sum("input_tokens").alias("input_tokens"),
        F.sum("output_tokens").alias("output_tokens"),
        F.sum(F.coalesce("cache_creation_tokens", F.lit(0))).alias("cache_creation_tokens"),
        F.sum(F.coalesce("cache_read_tokens", F.lit(0))).alias("cache_read_tokens"),
        F.count(F.lit(1)).alias("calls"),
    )


def latency_report(calls: DataFrame, dims=("provider", "model"), exact: bool = False) -> DataFrame:
    """Count, mean, maximum and 95th percentile of ``latency_ms``.

    The sketch (``percentile_approx``) merges in bounded memory. ``exact`` counts each latency
    value first, so it shuffles one row per group and distinct millisecond, not per call.
    """
    dims = list(dims)
    if not exact:
        return calls.groupBy(*dims).agg(
            F.count("latency_ms").alias("calls"),
            F.avg("latency_ms").alias("avg_latency_ms"),
            F.max("latency_ms").alias("max_latency_ms"),
            F.percentile_approx("latency_ms", 0.95, 10000).alias("p95_latency_ms"),
        )
    counted = calls.where("latency_ms IS NOT NULL").groupBy(*dims, "latency_ms").count()
    return counted.groupBy(*dims).agg(
        F.sum("count").alias("calls"),
        (F.sum(F.col("latency_ms") * F.col("count")) / F.sum("count")).alias("avg_latency_ms"),
        F.max("latency_ms").alias("max_latency_ms"),
        F.percentile("latency_ms", F.lit(0.95), F.col("count")).alias("p95_latency_ms"),
    )
