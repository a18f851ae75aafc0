"""Budget policies against calls that carry ``cost_usd``.

The rules for scopes, windows, admission and risk are stated here, in one place:

* A policy counts calls of its own ``org_id``: all of them (scope organization), or those whose
  feature, environment or customer_id (scope custom) equals ``scope_identifier``.
* Its window is [period_start, period_start + one period).
* A call exceeds a policy when the spend of the policy's earlier calls plus the call's estimate
  is above the amount. An exceeded block policy refuses the call.
* An active policy is at risk from its lowest alert threshold on, or from 100% without one.
"""

import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..runtime import checkpointed
from ..schemas import TOTAL
from .cost import money
from .ordered import MAX_GROUP_ROWS, large_groups, running

ORDER = ["timestamp", "call_id"]
STRICTNESS = ["alert", "throttle", "block"]
OVER_LIMIT = "Budget limit exceeded"  # fixed value
DEFAULT_REASON = "Budget exceeded"  # fixed value


def spend_percentage(spend: Column, amount: Column, previous: Column) -> Column:
    """Share of the amount in percent; the previous value when the amount is not positive."""
    spend = spend.cast("double")
    return F.when(amount > 0, F.try_divide(spend, amount) * 100).otherwise(previous)


def apply_spend(policies: DataFrame, calls: DataFrame) -> DataFrame:
    """Add the organisation's call costs to each of its policies, whatever their scope."""
    spent = calls.groupBy("org_id").agg(F.sum(money("cost_usd")).cast("double").alias("_spent"))
    spend = F.col("current_spend_usd") + F.coalesce("_spent", F.lit(0.0))
    percentage = spend_percentage(
        spend, F.col("budget_amount_usd"), F.col("spend_percentage")
    )
    return (
        policies.join(spent, "org_id", "left")
        .withColumn(
            "spend_percentage",
            F.when(F.col("_spent").isNull(), F.col("spend_percentage")).otherwise(percentage),
        )
        .withColumn("current_spend_usd", spend)
        .drop("_spent")
    )


def apply_spend_to_status(status: DataFrame, calls: DataFrame) -> DataFrame:
    """The same update for the organisation's total."""
    spent = calls.groupBy("org_id").agg(F.sum(money("cost_usd")).cast("double").alias("_spent"))
    total = F.col("total_spend_usd") + F.coalesce("_spent", F.lit(0.0))
    return status.join(spent, "org_id", "left").withColumn("total_spend_usd", total).drop("_spent")


def policy_window(policies: DataFrame) -> DataFrame:
    """Add ``period_end``, the first instant after the policy's window."""
    months = F.when(F.col("period") == "monthly", 1).otherwise(0)
    days = (
        F.when(F.col("period") == "daily", 1)
        .when(F.col("period") == "weekly", 7)
        .when(F.col("period") == "custom", F.col("custom_period_days"))
        .otherwise(0)
    )
    end = F.col("period_start") + F.make_interval(months=months, days=days)
    return policies.withColumn("period_end", end)


def _active(policies: DataFrame) -> DataFrame:
    return policy_window(policies).where("is_active").select(
        F.col("id").alias("policy_id"),
        F.col("org_id").alias("_org"),
        F.col("scope").alias("_scope"),
        F.when(F.col("scope") == "organization", "")
        .otherwise(F.col("scope_identifier"))
        .alias("_name"),
        "period_start",
        "period_end",
        "budget_amount_usd",
        "action",
        "throttle_percentage",
        "alert_thresholds",
    )


SCOPE = ["org_id", "_call_scope", "_call_name"]


def _offered(calls: DataFrame, columns: list[str]) -> DataFrame:
    """One row per call and scope that it belongs to, keyed by ``SCOPE``."""
    names = {
        "organization": F.lit(""),
        "feature": F.col("feature"),
        "environment": F.col("environment"),
        "custom": F.col("customer_id"),
    }
    scopes = F.array(
        *[
            F.struct(F.lit(scope).alias("_call_scope"), name.alias("_call_name"))
            for scope, name in names.items()
        ]
    )
    return calls.select("org_id", *columns, F.inline(scopes))


def _matches() -> Column:
    return (
        (F.col("org_id") == F.col("_org"))
        & (F.col("_call_scope") == F.col("_scope"))
        & (F.col("_call_name") == F.col("_name"))
    )


def _inside() -> Column:
    return _matches() & (
        (F.col("timestamp") >= F.col("period_start")) & (F.col("timestamp") < F.col("period_end"))
    )


def policy_calls(policies: DataFrame, calls: DataFrame, columns: list[str]) -> DataFrame:
    """One row per active policy and call inside its scope and window, with the call ``columns``.

    Each call offers one key per scope, so a single equi-join finds its policies in one pass.
    """
    pairs = _offered(calls, columns).join(_active(policies), _inside())
    return pairs.drop("_org", "_scope", "_name", *SCOPE[1:], "period_start", "period_end")


def policy_spend(policies: DataFrame, calls: DataFrame) -> DataFrame:
    """Active policies with the spend inside scope and window; 0 where there is none."""
    spent = (
        policy_calls(policies, calls, ["timestamp", "cost_usd"])
        .groupBy("policy_id")
        .agg(F.sum(money("cost_usd")).alias("_spent"))
    )
    spend = F.coalesce("_spent", F.lit(0).cast(TOTAL))
    return (
        policies.where("is_active")
        .join(spent.withColumnRenamed("policy_id", "id"), "id", "left")
        .withColumn("current_spend_usd", spend)
        .withColumn(
            "spend_percentage",
            spend_percentage(
                F.col("current_spend_usd"), F.col("budget_amount_usd"), F.col("spend_percentage")
            ),
        )
        .drop("_spent")
    )


def alert_crossings(policies: DataFrame) -> DataFrame:
    """One row per policy and alert threshold that its ``spend_percentage`` has reached."""
    return policies.withColumn("threshold", F.explode("alert_thresholds")).where(
        F.col("spend_percentage") >= F.col("threshold")
    )


def _swept(policies: DataFrame, calls: DataFrame, columns: list[str], max_group_rows: int):
    """One ordered pass over the calls of each scope and the starts and ends of its windows.

    Returns the active policies with ``_base``, the spend of their scope before their window, and
    one row per call and scope that it has after a bound (at most four a call, however many policies
    there are) with ``_total``, the scope's spend up to the call, ``_n``, the number of its row, and
    ``_bound``, the last start or end of a window before it. A policy's spend is ``_total`` less
    ``_base``. Calls are read once, in narrow rows, and shuffled once for each scope: small scopes
    without policies are swept as well and leave no row.
    """
    active = _active(policies).where("period_start < period_end AND _name IS NOT NULL")
    active = active.withColumnsRenamed({"_org": SCOPE[0], "_scope": SCOPE[1], "_name": SCOPE[2]})
    active = active.dropna(subset=SCOPE)
    bounds = active.select(*SCOPE, F.explode(F.array("period_start", "period_end")).alias("timestamp"))
    bounds = bounds.distinct().withColumn("_is_call", F.lit(False))
    columns = ["call_id", "timestamp", "cost_usd", *columns]
    # So few calls cannot make a large scope; counting them reads no column. Otherwise the calls
    # are kept, as scopes are sized before they are swept.
    fits = calls.count() <= max_group_rows
    if not fits:
        names = ["org_id", "feature", "environment", "customer_id"]
        calls, bounds = checkpointed(calls.select(*names, *columns)), checkpointed(bounds)
    rows = _offered(calls, columns).dropna(subset=SCOPE).withColumn("_is_call", F.lit(True))
    # A window has its first instant and not its last, so bounds come before calls of their time.
    both = rows.unionByName(bounds, allowMissingColumns=True)
    large = None
    if not fits:
        large = large_groups(both, SCOPE, "timestamp", max_group_rows)
        # At most one row for each ``max_group_rows`` rows: large scopes without policies go first.
        idle = checkpointed(large.select(*SCOPE).join(bounds, SCOPE, "left_anti"))
        large = large.join(idle, SCOPE, "left_anti")
        both = both.join(F.broadcast(idle), SCOPE, "left_anti")
    at_bound = F.when(~F.col("_is_call"), F.col("timestamp"))
    run = running(
        both, SCOPE, ["timestamp", "_is_call", "call_id"],
        {"_total": money("cost_usd"), "_n": F.lit(1)}, {"_bound": lambda _: at_bound},
        max_group_rows, fits=fits, large=large,
    )
    total = F.coalesce("_total", F.lit(0)).cast(TOTAL)
    run = checkpointed(run.where("_bound IS NOT NULL").withColumn("_total", total))
    starts = run.where("NOT _is_call").select(
        *SCOPE, F.col("timestamp").alias("period_start"), F.col("_total").alias("_base")
    )
    return active.join(starts, [*SCOPE, "period_start"]), run.where("_is_call")


BLOCK = 1 << 16  # rows of a scope that are opened together
UNIT = 12  # decimals of an amount


def _level(threshold: Column, amount: Column) -> Column:
    """The least spend whose percentage of ``amount``, computed in floating point, is ``threshold``
    or more. It lies within rounding errors of the exact share, where it is found by halving."""
    share = (threshold * amount / 100).cast(TOTAL)
    reach = F.abs(share.cast("double")) * 1e-14 * 10**UNIT
    unit = F.lit(f"1e-{UNIT}").cast(f"decimal(13,{UNIT})")

    def reached(units: Column) -> Column:
        return (share + units * unit).cast("double") / amount * 100 >= threshold

    def halve(range_, _):
        middle = F.floor((range_["low"] + range_["high"]) / 2).cast("long")
        hit = reached(middle)
        return F.struct(
            F.when(hit, range_["low"]).otherwise(middle + 1).alias("low"),
            F.when(hit, middle).otherwise(range_["high"]).alias("high"),
        )

    wide = F.ceil(reach).cast("long") + 2
    first = F.struct((-wide).alias("low"), wide.alias("high"))
    halvings = F.ceil(F.log2(wide.cast("double"))).cast("int") + 2
    found = F.aggregate(F.sequence(F.lit(1), halvings), first, halve)
    return (share + found["high"] * unit).cast(TOTAL)


def first_crossing(
    policies: DataFrame,
    calls: DataFrame,
    max_group_rows: int = MAX_GROUP_ROWS,
    block: int = BLOCK,
) -> DataFrame:
    """The call at which a policy's running spend reaches each alert threshold.

    Spend never falls, so a threshold is a place in the sequence of the scope's running totals: the
    first call at or beyond it, in the window. It is searched in two levels: among the last totals
    of blocks of calls, then in the one block that has it; no other block is opened. Searching is
    sorting places in among totals, so rows are those of calls plus those of thresholds. A
    threshold of zero or less is crossed by the first call.
    """
    dated, run = _swept(policies, calls, [], max_group_rows)
    places = dated.where("budget_amount_usd > 0").select(
        *SCOPE, "policy_id", "_base", "period_start", "period_end", "budget_amount_usd",
        F.explode(F.col("alert_thresholds").cast("array<double>")).alias("_share"),
    ).where("_share IS NOT NULL AND NOT isnan(_share)")
    least = F.col("_base") + _level(F.col("_share"), F.col("budget_amount_usd"))
    places = places.select(
        *SCOPE, F.struct("policy_id", F.col("_share").alias("threshold"), "_base", "period_end",
                         "budget_amount_usd").alias("_place"),
        F.greatest(least, F.col("_base")).cast(TOTAL).alias("_total"), F.col("period_start").alias("timestamp"),
    )

    def next_of(rows, keys, found, order):
        """For each place the first of ``rows`` at or after it, as a struct in ``found``."""
        both = rows.unionByName(places_of(rows), allowMissingColumns=True)
        back = Window.partitionBy(*keys).orderBy(
            F.desc("_total"), F.desc("timestamp"), F.isnotnull("_place"), *[F.desc(c) for c in order]
        ).rowsBetween(Window.unboundedPreceding, 0)
        return both.withColumn(found, F.last(found, ignorenulls=True).over(back)).where("_place IS NOT NULL")

    blocked = run.withColumn("_block", F.floor((F.col("_n") - 1) / block))
    ends = blocked.groupBy(*SCOPE, "_block").agg(
        F.max("_total").alias("_total"), F.max("timestamp").alias("timestamp")
    )
    ends = ends.withColumn("_in", F.col("_block"))
    places_of = lambda _: places
    located = next_of(ends, SCOPE, "_in", ["_block"]).where("_in IS NOT NULL")
    located = checkpointed(located.select(*SCOPE, F.col("_in").alias("_block"), "_place", "_total", "timestamp"))
    opened = blocked.join(located.select(*SCOPE, "_block").distinct(), [*SCOPE, "_block"], "left_semi")
    call = F.struct("timestamp", "call_id", "_total").alias("_call")
    opened = opened.select(*SCOPE, "_block", "_total", "timestamp", "call_id", call)
    places_of = lambda _: located
    crossed = next_of(opened, [*SCOPE, "_block"], "_call", ["call_id"])
    crossed = crossed.where(F.col("_call.timestamp") < F.col("_place.period_end"))
    spend = (F.col("_call._total") - F.col("_place._base")).cast(TOTAL)
    share = spend.cast("double") / F.col("_place.budget_amount_usd") * 100
    row = F.struct(
        F.col("_call.timestamp").alias("timestamp"), F.col("_call.call_id").alias("call_id"),
        spend.alias("running_spend_usd"), share.alias("percentage"),
    )
    kind = policies.schema["alert_thresholds"].dataType.elementType
    # Thresholds that a policy lists twice are one.
    return (
        crossed.groupBy(F.col("_place.policy_id").alias("policy_id"), F.col("_place.threshold").cast(kind).alias("threshold"))
        .agg(F.min(row).alias("_row"))
        .select("policy_id", "threshold", "_row.*")
    )


OPEN_DDL = """org_id string, _call_scope string, _call_name string, _bound timestamp, _alert decimal(36,12),
_throttle decimal(36,12), _block decimal(36,12), _steps array<struct<level:decimal(36,12),percentage:double>>"""


def _open_levels(policies: list[tuple]) -> Iterator[tuple]:
    """For each stretch between the bounds of a scope's windows: the lowest total at which an open
    policy of each action is exceeded, and throttle percentages as steps that rise with the total.

    ``policies`` are (start, end, level, action, percentage), ordered by start. The lowest levels
    come from heaps whose closed policies are dropped when they come up.
    """
    heaps: dict[str, list] = {action: [] for action in STRICTNESS}
    throttled: list[tuple] = []
    begun = 0
    for bound in sorted({p[0] for p in policies} | {p[1] for p in policies}):
        while begun < len(policies) and policies[begun][0] <= bound:
            _, end, level, action, percentage = policies[begun]
            begun += 1
            if action in heaps:
                heapq.heappush(heaps[action], (level, end))
            if action == "throttle" and percentage == percentage and percentage is not None:
                throttled.append((level, end, percentage))
        lowest = []
        for heap in heaps.values():
            while heap and heap[0][1] <= bound:
                heapq.heappop(heap)
            lowest.append(heap[0][0] if heap else None)
        throttled = [t for t in throttled if t[1] > bound]
        steps: list[dict] = []
        for level, _, percentage in sorted(throttled):
            if not steps or percentage > steps[-1]["percentage"]:
                steps.append({"level": level, "percentage": percentage})
        if any(level is not None for level in lowest):
            yield (bound, *lowest, steps)


def _open(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Policies sorted by scope and start, to rows of ``OPEN_DDL``; a scope may go over batches."""
    scope, held, out = None, [], []

    def close():
        out.extend((*scope, *row) for row in _open_levels(held))

    names = [*SCOPE, "_bound", "_alert", "_throttle", "_block", "_steps"]
    for batch in batches:
        columns = [*SCOPE, "period_start", "period_end", "_level", "action", "throttle_percentage"]
        for *key, start, end, level, action, percentage in zip(*[batch[c] for c in columns], strict=True):
            if key != scope:
                if held:
                    close()
                scope, held = key, []
            held.append((start, end, level, action, percentage))
        if len(out) > 10_000:
            yield pd.DataFrame(out, columns=names)
            out.clear()
    if held:
        close()
    if out:
        yield pd.DataFrame(out, columns=names)


def budget_check(
    calls: DataFrame,
    policies: DataFrame,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add allowed, action, throttle_percentage and reason to each call.

    Calls carry ``cost_usd`` and ``estimated_cost_usd``. A call exceeds a policy if the scope's
    total before the call plus the estimate is above the policy's level: its amount plus the total
    before its window. So all policies that are open between two bounds of windows come down to the
    lowest level of each action, and a call meets one row of its scope, however many policies
    overlap. A bound may have most of the log after it, so calls meet that row by pieces of their
    scope. Only exceeded rows are grouped back to calls.
    """
    dated, run = _swept(policies, calls, ["estimated_cost_usd"], max_group_rows)
    level = (money("budget_amount_usd") + F.col("_base")).cast(TOTAL).alias("_level")
    ordered = dated.select(*SCOPE, "period_start", "period_end", level, "action", "throttle_percentage")
    ordered = ordered.repartition(*SCOPE).sortWithinPartitions(*SCOPE, "period_start")
    opened = ordered.mapInPandas(_open, OPEN_DDL)
    run = run.withColumn("_piece", F.floor((F.col("_n") - 1) / BLOCK))
    pieces = run.select(*SCOPE, "_bound", "_piece").distinct()
    # One row a piece and bound, all of them different: looked up by hash, so that calls are not sorted.
    opened = opened.join(pieces, [*SCOPE, "_bound"]).hint("shuffle_hash")
    met = run.join(opened, [*SCOPE, "_bound", "_piece"]).withColumn(
        "_offer", F.col("_total") - money("cost_usd") + money("estimated_cost_usd")
    )
    over = {a: F.coalesce(F.col("_offer") > F.col(f"_{a}"), F.lit(False)) for a in STRICTNESS}
    rank = F.when(over["block"], 3).when(over["throttle"], 2).when(over["alert"], 1)
    passed = F.filter("_steps", lambda step: step["level"] < F.col("_offer"))
    verdicts = (
        met.select("call_id", rank.alias("_rank"), F.try_element_at(F.transform(passed, lambda s: s["percentage"]), F.lit(-1)).alias("_share"))
        .where("_rank IS NOT NULL")
        .groupBy("call_id")
        .agg(F.max("_rank").alias("_rank"), F.max("_share").alias("throttle_percentage"))
    )
    action = F.get(F.array(*[F.lit(a) for a in STRICTNESS]), F.col("_rank").cast("int") - 1)
    return (
        calls.join(verdicts, "call_id", "left")
        .withColumn("action", action)
        .withColumn("allowed", ~F.coalesce(F.col("action") == "block", F.lit(False)))
        .withColumn("reason", F.when(F.col("_rank").isNotNull(), F.lit(OVER_LIMIT)))
        .drop("_rank")
    )


def budget_blocked(checked: DataFrame) -> DataFrame:
    """Refused calls: not allowed and the action is block, with a default reason."""
    refused = F.coalesce(~F.col("allowed") & (F.col("action") == "block"), F.lit(False))
    return checked.where(refused).withColumn(
        "reason", F.coalesce("reason", F.lit(DEFAULT_REASON))
    )


def status_policies(spent: DataFrame) -> DataFrame:
    """The policy list of a budget status: ``policy_spend`` rows with ``at_risk``.

    Rows keyed by organisation rather than one list per organisation, which would have to be
    gathered in a single task.
    """
    limit = F.coalesce(F.array_min("alert_thresholds"), F.lit(100))
    return spent.withColumn("at_risk", F.col("spend_percentage") >= limit)


def budget_status(spent: DataFrame) -> DataFrame:
    """Total budget, total spend and number of policies at risk per organisation."""
    return status_policies(spent).groupBy("org_id").agg(
        F.sum(money("budget_amount_usd")).alias("total_budget_usd"),
        F.sum("current_spend_usd").alias("total_spend_usd"),
        F.count(F.when(F.col("at_risk"), True)).alias("policies_at_risk"),
    )


# The answers assumed when a remote verdict is missing.
FAIL_OPEN = {
    "budget_check": {
        "allowed": True,
        "action": None,
        "throttle_percentage": None,
        "reason": "fail-open: API unavailable",
    },
    "budget_status": {"total_budget_usd": 0, "total_spend_usd": 0, "policies_at_risk": 0},
    "scan": {"is_allowed": True, "action": None, "redacted_text": None},
    "session": {"server_session_id": "fail-open", "status": "active"},
}


def fail_open_defaults(
    left: DataFrame, verdicts: DataFrame, on: str, kind: str, fail_open: bool = True
) -> DataFrame:
    """Join external verdicts; a missing one gets the defaults, or marks the row as ``error``.

    Values inside a verdict that is there are kept, NULL included.
    """
    joined = left.join(verdicts.withColumn("_found", F.lit(True)), on, "left")
    missing = F.col("_found").isNull()
    if not fail_open:
        return joined.withColumn("error", missing).drop("_found")
    filled = {
        name: F.when(missing, F.lit(default)).otherwise(F.col(name))
        for name, default in FAIL_OPEN[kind].items()
        if default is not None
    }
    if kind == "scan" and "violations" in verdicts.columns:
        empty = F.array().cast(verdicts.schema["violations"].dataType)
        filled["violations"] = F.when(missing, empty).otherwise(F.col("violations"))
    return joined.withColumns(filled).drop("_found")
