"""The whole path: stage order on a small log, and hot groups cut into blocks."""

from pyspark.sql import functions as F

from spendguard.plans import inputs as I
from spendguard.plans.admission import admission_report

SF = "/root/testdata/sf0.001"


def test_first_failing_stage_names_the_outcome(spark):
    ddl = """call_id long, session_id string, request_id long, model string, feature string,
    input_tokens long, second long"""
    rows = [
        (1, "s", 1, "gpt-4", "purchase", 100_000, 0),  # costs 3
        (2, "s", 2, "gpt-4", "purchase", 100_000, 0),  # personal data in its request
        (3, "s", 1, "gpt-4", "purchase", 100_000, 0),  # 3 + 0.045 is over the budget of 3
        (4, "s", 1, "gpt-4", "view", 100_000, 0),  # 3 + 0.045 is over the session's 3
        (5, "s", 1, "unknown-model-xyz", "view", 100_000, 0),  # free, so it still fits
        (6, "t", 1, "gpt-4", "view", 100_000, 1),  # the other session's only call
        (7, "t", 1, "gpt-4", "view", 100_000, 1),
    ]
    calls = spark.createDataFrame(rows, ddl).withColumns(
        {
            "timestamp": F.timestamp_seconds(F.lit(1704067200) + F.col("second")),
            "org_id": F.lit("org-1"),
            "environment": F.lit("production"),
            "customer_id": F.lit("1"),
            "output_tokens": F.lit(0),
            "cache_creation_tokens": F.lit(None).cast("long"),
            "cache_read_tokens": F.lit(None).cast("long"),
        }
    )
    messages = spark.createDataFrame(
        [(1, 0, "fine"), (2, 0, "fine"), (2, 1, "SSN 123-45-6789")],
        "request_id long, msg_index long, text string",
    )
    policies = I.policies(spark).where("id = 'pol_002'").withColumn(
        "budget_amount_usd", F.lit(3.0)
    )
    limits = spark.createDataFrame(
        [("s", 3.0, None), ("t", None, 1)],
        "session_id string, max_spend_usd double, max_iterations long",
    )
    report = admission_report(calls, messages, policies, limits, I.pricing(spark), 1, 2)
    out = {r.call_id: (r.outcome, r.wait_s, r.cost_usd) for r in report.collect()}
    assert out == {
        1: ("executed", 0.0, 3.0),
        2: ("content_blocked", 0.0, 0.0),
        3: ("budget_blocked", 1.0, 0.0),
        4: ("session_budget_exceeded", 2.0, 0.0),
        5: ("executed", 3.0, 0.0),
        6: ("executed", 3.0, 3.0),
        7: ("session_iteration_limit_exceeded", 4.0, 0.0),
    }


def test_hot_groups_change_nothing(spark):
    plain, cut = [
        sorted(
            map(
                tuple,
                admission_report(
                    I.usage_calls(spark, SF), I.messages(spark, SF), I.policies(spark),
                    I.session_limits(spark, SF), I.pricing(spark), "0.0007", 3, limit,
                ).collect(),
            )
        )
        for limit in (10**6, 50)
    ]
    assert plain == cut and len(plain) == 1000


def test_standard_mode_follows_verdicts(spark):
    from spendguard.operators.governance import judged_requests

    hit = "SSN 123-45-6789"
    messages = spark.createDataFrame(
        [(1, 0, "fine"), (1, 1, hit), (1, 2, hit), (2, 0, hit), (3, 0, "fine"), (4, 0, hit), (4, 1, hit)],
        "request_id long, msg_index long, text string",
    )
    verdicts = spark.createDataFrame(
        [(1, 0, False), (1, 2, False), (2, 0, True), (3, 0, False), (4, 0, None), (4, 1, False)],
        "request_id long, msg_index long, is_allowed boolean",
    )
    stopped = {r.request_id: r.content for r in judged_requests(messages, verdicts).collect()}
    assert stopped == {1: "content_blocked", 4: "content_blocked"}  # clean messages need no verdict
    strict = {r.request_id: r.content for r in judged_requests(messages, verdicts, False).collect()}
    assert strict == {1: "content_error", 4: "content_blocked"}


def test_a_session_without_an_answer_is_open(spark):
    from spendguard.operators.budgets import fail_open_defaults

    left = spark.createDataFrame([("a",), ("b",)], "session_id string")
    answers = spark.createDataFrame([("a", "s-1", "terminated")], "session_id string, server_session_id string, status string")
    rows = fail_open_defaults(left, answers, "session_id", "session").collect()
    assert sorted(map(tuple, rows)) == [("a", "s-1", "terminated"), ("b", "fail-open", "active")]
