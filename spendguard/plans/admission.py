"""The whole path of a governed call as one plan."""

from pyspark.sql import DataFrame, functions as F

from ..operators.budgets import budget_check
from ..operators.cost import with_cost_and_estimate
from ..operators.governance import blocked_requests, judged_requests
from ..operators.ordered import MAX_GROUP_ROWS
from ..operators.rate import DEFAULT_BURST, DEFAULT_RATE, queue_delay
from ..operators.sessions import session_replay
from ..runtime import checkpointed

EXECUTED = "executed"


def admission_report(
    calls: DataFrame,
    messages: DataFrame,
    policies: DataFrame,
    limits: DataFrame,
    pricing: DataFrame,
    rate=DEFAULT_RATE,
    burst=DEFAULT_BURST,
    max_group_rows: int = MAX_GROUP_ROWS,
    verdicts: DataFrame | None = None,
    fail_open: bool = True,
) -> DataFrame:
    """One row per call: queue wait, outcome and the cost it added.

    Stages in order: rate queue per organisation, content gate per request, budget, session. The
    outcome names the first stage that stops the call. A call uses its rate token whatever comes
    later; only executed calls add cost. The budget stage counts the spend of all earlier calls
    that passed the content gate.

    Content is judged by the classification alone if ``verdicts`` is None. In standard mode, with
    a table of external verdicts, messages that the scan hits follow theirs; a missing verdict
    allows the message, or, not failing open, gives all calls of its request the outcome
    ``content_error``.
    """
    columns = ["call_id", "timestamp", "org_id", "session_id", "request_id", "feature",
               "environment", "customer_id", "cost_usd", "estimated_cost_usd"]
    priced = with_cost_and_estimate(calls, pricing).select(*columns)
    # One id per stopped request; the text never leaves the gate's projection.
    if verdicts is None:
        stopped = blocked_requests(messages).withColumn("content", F.lit("content_blocked"))
    else:
        stopped = judged_requests(messages, verdicts, fail_open)
    # Calls are read, priced and tagged once; all later stages start from these narrow rows.
    tagged = checkpointed(priced.join(stopped, "request_id", "left"))

    queued = queue_delay(tagged, ["org_id"], rate, burst, max_group_rows=max_group_rows)
    passed = tagged.where("content IS NULL").drop("request_id", "session_id", "content")
    checked = budget_check(passed, policies, max_group_rows)
    budget_blocked = ~F.col("allowed") & (F.col("action") == "block")
    checked = checked.select("call_id", budget_blocked.alias("budget_blocked"))
    # Only refusals travel back; most calls have none.
    refused = checked.where(F.coalesce("budget_blocked", F.lit(False)))
    judged = queued.join(refused, "call_id", "left").withColumn(
        "budget_blocked", F.coalesce("budget_blocked", F.lit(False))
    )
    replayed = session_replay(
        judged,
        limits,
        eligible=F.col("content").isNull() & ~F.col("budget_blocked"),
        max_group_rows=max_group_rows,
        counted=tagged,
    )
    outcome = (
        F.when(F.col("content").isNotNull(), F.col("content"))
        .when(F.col("budget_blocked"), "budget_blocked")
        .when(~F.col("allowed"), F.concat(F.lit("session_"), "reason"))
        .otherwise(EXECUTED)
    )
    spent = F.when(F.col("outcome") == EXECUTED, F.col("cost_usd")).otherwise(F.lit(0.0))
    return replayed.withColumn("outcome", outcome).select(
        "call_id", "session_id", "wait_s", "outcome", spent.alias("cost_usd")
    )
