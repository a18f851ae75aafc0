"""Every operator as a query over the driver's tables: name -> function(spark, sf_dir)."""

from pyspark.sql import DataFrame, functions as F

from ..functions import content as C
from ..functions import patterns as P
from ..functions.spans import luhn_valid, match_spans
from ..functions.usage import parse_response, usage_anthropic, usage_google, usage_openai
from ..operators import budgets as B
from ..operators import cost as K
from ..operators import governance as G
from ..operators import rate as R
from ..operators import sessions as S
from ..operators import usage as U
from ..runtime import checkpointed, shared_path
from ..sources import sinks, tables
from ..streaming import jobs as J
from . import inputs as I
from .admission import admission_report as admission

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def _costed(spark, sf):
    return K.with_cost_and_estimate(I.usage_calls(spark, sf), I.pricing(spark))


def _dollars(*names):
    """Decimals leave as doubles, which every reader understands."""
    return {n: F.col(n).cast("double") for n in names}


# Usage ---------------------------------------------------------------------------------------


def _number(column):
    return F.coalesce(F.col(column).cast("string"), F.lit("null"))


def _payload(provider):
    """Response JSON in a provider's own shape; every seventh call has an empty response."""
    fields = {c: _number(c) for c in ("input_tokens", "output_tokens",
                                      "cache_creation_tokens", "cache_read_tokens")}
    text = {
        "openai": '{"usage":{"prompt_tokens":%1$s,"completion_tokens":%2$s,'
        '"prompt_tokens_details":{"cached_tokens":%4$s}},"model":"m"}',
        "anthropic": '{"usage":{"input_tokens":%1$s,"output_tokens":%2$s,'
        '"cache_creation_input_tokens":%3$s,"cache_read_input_tokens":%4$s}}',
        "google": '{"response":{"usageMetadata":{"promptTokenCount":%1$s,'
        '"candidatesTokenCount":%2$s,"cachedContentTokenCount":%4$s}}}',
    }[provider]
    filled = F.format_string(text, *fields.values())
    return F.when(F.col("call_id") % 7 == 0, F.lit("{}")).otherwise(filled)


def _extracted(spark, sf, provider, extract):
    calls = I.usage_calls(spark, sf).select("call_id", _payload(provider).alias("payload"))
    parsed = calls.withColumn("p", parse_response(F.col("payload")))
    return parsed.select("call_id", extract(F.col("p")).alias("u")).select("call_id", "u.*")


QUERIES["usage_openai"] = lambda spark, sf: _extracted(spark, sf, "openai", usage_openai)
QUERIES["usage_anthropic"] = lambda spark, sf: _extracted(spark, sf, "anthropic", usage_anthropic)
QUERIES["usage_google"] = lambda spark, sf: _extracted(spark, sf, "google", usage_google)


def _raw(spark, sf):
    kind = F.col("call_id") % 4
    payload = (
        F.when(kind == 0, _payload("openai"))
        .when(kind == 1, _payload("anthropic"))
        .when(kind == 2, _payload("google"))
        .otherwise(F.lit('{"text":"none"}'))
    )
    return I.usage_calls(spark, sf).select("call_id", payload.alias("payload"))


@query
def usage_normalised(spark, sf):
    return U.normalise_usage(_raw(spark, sf))[0]


@query
def usage_unsupported(spark, sf):
    return U.normalise_usage(_raw(spark, sf))[1].select("call_id", "payload", "reason")


@query
def usage_detected_provider(spark, sf):
    good, bad = U.normalise_usage(_raw(spark, sf))
    both = good.select("provider").unionByName(bad.select("provider"))
    return both.groupBy("provider").agg(F.count(F.lit(1)).alias("calls"))


def _log_rows(spark, sf):
    """Calls as log text, some of them broken."""
    n = F.col("call_id")
    return I.usage_calls(spark, sf).select(
        "call_id",
        F.when(n % 11 == 0, "").otherwise(F.col("api_key")).alias("api_key"),
        F.when(n % 13 == 0, F.date_format("timestamp", "yyyy/MM/dd"))
        .otherwise(F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .alias("timestamp"),
        F.when(n % 17 == 0, "acme").otherwise(F.col("provider")).alias("provider"),
        F.when(n % 19 == 0, "").otherwise(F.col("model")).alias("model"),
        F.when(n % 23 == 0, -1.0)
        .when(n % 31 == 0, 1.5)
        .otherwise(F.col("input_tokens").cast("double"))
        .alias("input_tokens"),
        "output_tokens",
        "cache_creation_tokens",
        F.when(n % 37 == 0, -1).otherwise(F.col("cache_read_tokens")).alias("cache_read_tokens"),
        F.when(n % 29 == 0, 1.5).otherwise(F.col("latency_ms").cast("double")).alias("latency_ms"),
    )


@query
def usage_rejects(spark, sf):
    rejects = U.validate_usage(_log_rows(spark, sf))[1]
    return rejects.select("call_id", F.array_join("errors", ",").alias("errors"))


@query
def usage_valid(spark, sf):
    valid = U.validate_usage(_log_rows(spark, sf))[0]
    return valid.groupBy("provider", "model").agg(F.count(F.lit(1)).alias("calls"))


@query
def usage_zero_cache(spark, sf):
    calls = U.nullify_zero_cache(I.usage_calls(spark, sf))
    return calls.select("call_id", "cache_creation_tokens", "cache_read_tokens")


def _requests(spark, sf):
    """A request body per conversation row: string content, then a block array."""
    rows = I.table(spark, sf, "conversations")
    provider = F.get(F.array(F.lit("openai"), F.lit("anthropic"), F.lit("google")),
                     (F.col("turn") % 3).cast("int"))
    quoted = F.expr("to_json(named_struct('t', text))")
    literal = F.regexp_extract(quoted, r'(?s)^\{"t":(.*)\}\z', 1)
    role = F.concat(F.lit('"'), F.col("role"), F.lit('"'))
    body = F.concat(
        F.lit('{"messages":[{"role":'), role, F.lit(',"content":'), literal,
        F.lit('},{"role":'), role, F.lit(',"content":[{"type":"text","text":'), literal,
        F.lit('},{"type":"image"},{"text":'), role, F.lit('}]},{"role":'), role,
        F.lit(',"content":[]}]}'),
    )
    return rows.select(
        (F.col("conv_id") * 8 + F.col("turn")).alias("request_id"),
        provider.alias("provider"),
        F.when(provider == "google", literal).otherwise(body).alias("body"),
    )


@query
def message_text(spark, sf):
    return tables.load_messages(_requests(spark, sf))


# Sources and sinks ---------------------------------------------------------------------------


@query
def read_usage(spark, sf):
    path = shared_path(spark, "usage")
    sinks.write_usage(I.usage_calls(spark, sf), path)
    return tables.read_usage(spark, path).select(
        "call_id", "model", "feature", "session_id", "input_tokens", "output_tokens",
        "cache_creation_tokens", "cache_read_tokens",
    )


@query
def load_pricing(spark, sf):
    return tables.load_pricing(I.price_feed(spark, sf), "position", I.pricing(spark))


@query
def pricing_rejects(spark, sf):
    rejects = U.validate_pricing(I.price_feed(spark, sf))[1]
    return rejects.select("position", "model", F.array_join("errors", ",").alias("errors"))


def _customer_policies(spark, sf):
    return U.validate_policies(tables.load_policies(I.policy_feed(spark, sf)))[0]


@query
def load_policies(spark, sf):
    loaded = tables.load_policies(I.policy_feed(spark, sf))
    return loaded.select(
        "id", "org_id", "name", "scope", "scope_identifier", "budget_amount_usd", "period",
        "custom_period_days", "action", "throttle_percentage",
        F.array_join(F.transform("alert_thresholds", lambda t: t.cast("string")), ",")
        .alias("alert_thresholds"), "current_spend_usd", "is_active",
    )


@query
def policy_rejects(spark, sf):
    rejects = U.validate_policies(tables.load_policies(I.policy_feed(spark, sf)))[1]
    return rejects.select("id", F.array_join("errors", ",").alias("errors"))


@query
def load_sessions(spark, sf):
    key = F.col("c_custkey")
    rows = I.table(spark, sf, "customer").select(
        key.alias("user_id"),
        F.when(key % 10 != 0, F.concat(F.lit("s-"), key.cast("string"))).alias("session_id"),
        F.col("c_mktsegment").alias("feature"),
        F.when(key % 3 == 0, 5.0).alias("max_spend_usd"),
        F.when(key % 4 == 0, 10).alias("max_iterations"),
    )
    # Every seventh row stands there twice, and once more in another part of the table.
    twice = rows.where("user_id % 7 = 0")
    again = rows.unionByName(twice).unionByName(twice.repartition(3))
    return tables.load_sessions(again).drop("server_session_id")


@query
def write_signals(spark, sf):
    path = shared_path(spark, "signals")
    sinks.write_signals(_signals(spark, sf).withColumn("violation_count", F.lit(None)), path)
    stored = spark.read.parquet(path)
    return stored.groupBy("violation_type", "violation_subtype", "severity", "source").agg(
        F.sum("violation_count").alias("violations")
    )


@query
def write_session_calls(spark, sf):
    path = shared_path(spark, "session-calls")
    calls = _costed(spark, sf)
    scanned = G.scan_text(I.documents(spark, sf))
    detected = scanned.select(F.col("doc_id").alias("call_id"), "detected")
    sinks.write_session_calls(S.session_ledger(calls), detected, path)
    return spark.read.parquet(path).select(
        "session_id", "call_id", "call_sequence", "call_type", "cumulative_input_tokens",
        "pii_detected",
    )


@query
def write_session_closures(spark, sf):
    path = shared_path(spark, "session-closures")
    sinks.write_session_closures(_summary(spark, sf), path)
    stored = spark.read.parquet(path)
    return stored.withColumns(_dollars("final_spend_usd"))


# Cost ----------------------------------------------------------------------------------------


@query
def usage_cost(spark, sf):
    out = K.with_cost(I.usage_calls(spark, sf), I.pricing(spark))
    return out.select("call_id", "model", "cost_usd")


@query
def cost_estimate(spark, sf):
    out = K.with_estimate(I.usage_calls(spark, sf), I.pricing(spark))
    return out.select("call_id", "model", "estimated_cost_usd")


@query
def spend_by_model(spark, sf):
    report = K.usage_report(_costed(spark, sf), ["provider", "model"])
    return report.withColumns(_dollars("spend_usd"))


@query
def spend_by_customer(spark, sf):
    report = K.usage_report(_costed(spark, sf), ["customer_id", "feature"])
    return report.withColumns(_dollars("spend_usd"))


@query
def spend_rollup(spark, sf):
    report = K.usage_report(_costed(spark, sf), ["feature", "model"], subtotals=True)
    return report.withColumns(_dollars("spend_usd"))


@query
def cost_discrepancy(spark, sf):
    calls = K.with_cost(I.usage_calls(spark, sf), I.pricing(spark))
    factor = F.when(F.col("call_id") % 10 == 0, 1.02).otherwise(1.005)
    server = calls.select("call_id", (F.col("cost_usd") * factor).alias("server_cost_usd"))
    out = K.cost_discrepancies(calls, server)
    return out.select("call_id", "model", "cost_usd", "server_cost_usd", "difference_pct")


@query
def cost_asof(spark, sf):
    out = K.with_cost_asof(I.usage_calls(spark, sf), I.price_history(spark))
    return out.select("call_id", "model", "cost_usd")


@query
def latency_report(spark, sf):
    return K.latency_report(I.usage_calls(spark, sf), exact=True)


@query
def latency_report_sketch(spark, sf):
    return K.latency_report(I.usage_calls(spark, sf))


# Budgets -------------------------------------------------------------------------------------


@query
def apply_spend(spark, sf):
    calls = _costed(spark, sf)
    feed = tables.load_policies(I.policy_feed(spark, sf)).withColumn(
        "org_id", F.when(F.col("org_id") == "org-2", "org-1").otherwise(F.col("org_id"))
    )
    updated = B.apply_spend(feed, calls)
    return updated.select("id", "org_id", F.col("current_spend_usd").alias("spend"),
                          F.col("spend_percentage").alias("percentage"))


@query
def apply_spend_total(spark, sf):
    feed = tables.load_policies(I.policy_feed(spark, sf))
    status = feed.groupBy("org_id").agg(
        F.sum("budget_amount_usd").alias("total_budget_usd"),
        F.sum(K.money("current_spend_usd")).cast("double").alias("total_spend_usd"),
    )
    return B.apply_spend_to_status(status, _costed(spark, sf))


@query
def policy_window(spark, sf):
    return B.policy_window(_customer_policies(spark, sf)).select(
        "id", "period", F.unix_seconds("period_start").alias("start_s"),
        F.unix_seconds("period_end").alias("end_s"),
    )


def _all_policies(spark, sf):
    """The sample policies and one small policy per customer of the same organisation."""
    feed = _customer_policies(spark, sf).withColumn("org_id", F.lit("org-1"))
    return tables.load_policies(I.policies(spark)).unionByName(feed)


@query
def policy_spend(spark, sf):
    spent = B.policy_spend(_all_policies(spark, sf), _costed(spark, sf))
    return spent.select("id", F.col("current_spend_usd").cast("double").alias("spend_usd"),
                        F.col("spend_percentage").alias("percentage"))


@query
def alert_crossings(spark, sf):
    spent = B.policy_spend(_all_policies(spark, sf), _costed(spark, sf))
    return B.alert_crossings(spent).select("id", "threshold")


@query
def first_crossing(spark, sf):
    crossed = B.first_crossing(_all_policies(spark, sf), _costed(spark, sf))
    return crossed.select(
        "policy_id", "threshold", "call_id",
        F.col("running_spend_usd").cast("double").alias("running_spend_usd"),
        "percentage",
    )


def _checked(spark, sf):
    return B.budget_check(_costed(spark, sf), _all_policies(spark, sf))


@query
def budget_check(spark, sf):
    return _checked(spark, sf).select(
        "call_id", "allowed", "action", "throttle_percentage", "reason"
    )


@query
def budget_blocked(spark, sf):
    return B.budget_blocked(_checked(spark, sf)).select("call_id", "reason")


@query
def budget_status(spark, sf):
    status = B.budget_status(B.policy_spend(_all_policies(spark, sf), _costed(spark, sf)))
    return status.withColumns(_dollars("total_budget_usd", "total_spend_usd"))


@query
def budget_status_policies(spark, sf):
    spent = B.policy_spend(_all_policies(spark, sf), _costed(spark, sf))
    listed = B.status_policies(spent).withColumns(_dollars("current_spend_usd"))
    return listed.select("org_id", "id", "scope", "current_spend_usd", "spend_percentage",
                         "at_risk")


@query
def fail_open(spark, sf):
    calls = I.usage_calls(spark, sf).select("call_id")
    verdicts = _checked(spark, sf).where("call_id % 5 <> 0").select(
        "call_id", "allowed", "action", "throttle_percentage", "reason"
    )
    return B.fail_open_defaults(calls, verdicts, "call_id", "budget_check")


@query
def fail_closed(spark, sf):
    calls = I.usage_calls(spark, sf).select("call_id")
    verdicts = _checked(spark, sf).where("call_id % 5 <> 0").select("call_id", "allowed")
    return B.fail_open_defaults(calls, verdicts, "call_id", "budget_check", fail_open=False)


# Sessions ------------------------------------------------------------------------------------


@query
def session_ledger(spark, sf):
    ledger = S.session_ledger(_costed(spark, sf))
    return ledger.select(
        "session_id", "call_id", "call_sequence", "cumulative_input_tokens", "cost_usd",
        F.col("cumulative_cost_usd").cast("double").alias("cumulative_cost_usd"),
    )


@query
def session_first_refusal(spark, sf):
    refusal = S.session_first_refusal(_costed(spark, sf), I.session_limits(spark, sf))
    return refusal.withColumns(_dollars("spend_before_usd")).drop("timestamp")


def _replayed(spark, sf):
    # Only the columns the walk needs cross into Python.
    calls = _costed(spark, sf).select(
        "session_id", "call_id", "timestamp", "cost_usd", "estimated_cost_usd"
    )
    return S.session_replay(calls, I.session_limits(spark, sf))


@query
def session_replay(spark, sf):
    return _replayed(spark, sf).select(
        "session_id", "call_id", "allowed", "reason", "spend_before_usd", "iterations_before"
    )


def _closes(spark, sf):
    """Close events: a third of the customers complete, a third are cancelled, the rest stay."""
    sessions = I.session_limits(spark, sf).select("session_id")
    turn = F.split_part("session_id", F.lit("-"), F.lit(1)).cast("long") % 3
    reason = F.when(turn == 0, "completed").when(turn == 1, "cancelled")
    return sessions.select("session_id", reason.alias("close_reason"))


def _summary(spark, sf):
    closes = _closes(spark, sf).where("close_reason IS NOT NULL")
    return S.session_summary(_replayed(spark, sf), closes, I.idle_sessions(spark, sf))


@query
def session_summary(spark, sf):
    return _summary(spark, sf).withColumns(_dollars("final_spend_usd"))


@query
def session_remaining(spark, sf):
    left = S.session_remaining(_summary(spark, sf), I.session_limits(spark, sf))
    return left.select("session_id", "remaining_budget_usd", "remaining_iterations").withColumns(
        _dollars("remaining_budget_usd")
    )


# Content -------------------------------------------------------------------------------------


def _detector(name):
    def run(spark, sf):
        docs = I.documents(spark, sf)
        spans = F.transform(
            C.detect(F.col("text"), name),
            lambda s: F.struct(s["value"].alias("value"), s["start"].alias("start"),
                               s["end"].alias("end")),
        )
        return docs.select("doc_id", F.inline(spans))

    return run


for _name, _ in P.PII:
    QUERIES[f"detect_{_name}"] = _detector(_name)


def _violation_kind(column, name):
    def run(spark, sf):
        rows = G.violations(I.documents(spark, sf), ["doc_id"], column(F.col("text")))
        return rows.where(F.col("type") == name)

    return run


for _name, _, _ in P.SECRETS:
    QUERIES[f"secret_{_name}"] = _violation_kind(C.secret_violations, _name)
for _name in ("credit_card", "iban"):
    QUERIES[f"financial_{_name}"] = _violation_kind(C.financial_violations, _name)


@query
def luhn_check(spark, sf):
    key = F.col("o_orderkey")
    digits = F.concat(F.lit("4"), F.lpad((key * 104729).cast("string"), 15, "0"))
    dashed = F.concat_ws("-", *[digits.substr(i, 4) for i in (1, 5, 9, 13)])
    number = F.when(key % 3 == 0, dashed).when(key % 7 == 0, digits.substr(1, 12)).otherwise(digits)
    rows = I.table(spark, sf, "orders").select("o_orderkey", number.alias("number"))
    return rows.withColumn("valid", luhn_valid(F.col("number")))


@query
def match_spans_html(spark, sf):
    """Spans of any pattern: here the tags of web pages."""
    found = match_spans(F.col("html"), "tag", "<[a-z]+[^<>]*>")
    rows = I.pages(spark, sf).select("page_id", F.inline(found))
    return rows.groupBy("page_id").agg(
        F.count(F.lit(1)).alias("tags"), F.sum("start").alias("starts"), F.sum("end").alias("ends"),
        F.max("value").alias("last_value"),
    )


@query
def pii_entities(spark, sf):
    return G.entities(I.documents(spark, sf), ["doc_id"])


@query
def pii_entities_pages(spark, sf):
    return G.entities(I.pages(spark, sf), ["page_id"], "html")


@query
def pii_redacted(spark, sf):
    out = G.scan_text(I.documents(spark, sf))
    return out.select("doc_id", "detected", "redacted_text")


@query
def pii_summary(spark, sf):
    return G.pii_summary(I.documents(spark, sf))


def _violation_query(column):
    def run(spark, sf):
        return G.violations(I.documents(spark, sf), ["doc_id"], column(F.col("text")))

    return run


QUERIES["pii_violations"] = _violation_query(C.pii_violations)
QUERIES["phi_violations"] = _violation_query(C.phi_violations)
QUERIES["secret_violations"] = _violation_query(C.secret_violations)
QUERIES["financial_violations"] = _violation_query(C.financial_violations)
QUERIES["full_scan"] = _violation_query(lambda text: C.full_scan(text)["violations"])
QUERIES["full_scan_secrets_only"] = _violation_query(
    lambda text: C.full_scan(text, ("secrets",))["violations"]
)


@query
def full_scan_categories(spark, sf):
    out = G.classify_text(I.documents(spark, sf))
    return out.select("doc_id", "detected", F.array_join("categories", ",").alias("categories"))


# Governance ----------------------------------------------------------------------------------


@query
def privacy_gate(spark, sf):
    out = G.privacy_gate(I.messages(spark, sf))
    return out.select("request_id", "msg_index", "blocked",
                      F.size("violations").alias("violations"), "redacted_text")


def _verdicts(spark, sf):
    """Remote verdicts: most messages have one, every third of those refuses."""
    number = F.col("conv_id") * 8 + F.col("turn")
    rows = I.table(spark, sf, "conversations").where(number % 5 != 0)
    refuses = number % 3 == 0
    return rows.select(
        F.col("conv_id").alias("request_id"),
        F.col("turn").alias("msg_index"),
        (~refuses).alias("is_allowed"),
        F.when(refuses, "block").alias("action"),
        F.when(refuses & (number % 2 == 0), "(withheld)").alias("redacted_text"),
    )


@query
def policy_gate(spark, sf):
    out = G.policy_gate(I.messages(spark, sf), _verdicts(spark, sf))
    return out.select("request_id", "msg_index", "detected", "is_allowed", "action", "blocked",
                      "redacted_text")


def _blocked(spark, sf):
    return G.first_blocking_message(I.messages(spark, sf))


@query
def first_blocking_message(spark, sf):
    return _blocked(spark, sf).select(
        "request_id", "msg_index", F.size("violations").alias("violations"), "redacted_text"
    )


def _signals(spark, sf):
    environment = F.when(F.col("request_id") % 2 == 0, "production").otherwise("staging")
    at = F.lit("2024-01-31").cast("timestamp")
    return G.governance_signals(G.first_violations(I.messages(spark, sf)), F.lit("org-1"), environment, at)


@query
def governance_signals(spark, sf):
    return _signals(spark, sf).drop("detected_at", "user_id", "feature")


@query
def signal_rollup(spark, sf):
    return G.signal_rollup(_signals(spark, sf))


# Rates ---------------------------------------------------------------------------------------

AUDIT_RATE, AUDIT_BURST = "0.0005", 5
QUEUE_RATE, QUEUE_BURST = "0.0007", 3


@query
def rate_audit(spark, sf):
    calls = I.usage_calls(spark, sf).select("call_id", "timestamp", "feature")
    audit = R.rate_audit(calls, ["feature"], AUDIT_RATE, AUDIT_BURST)
    return audit.select("call_id", "feature", "tokens_before", "allowed", "retry_after_s")


@query
def rate_audit_per_minute(spark, sf):
    """Ten calls a minute as a float: a sixth of a call per second."""
    calls = I.usage_calls(spark, sf).select("call_id", "timestamp", "org_id")
    audit = R.rate_audit(calls, ["org_id"], 10 / 60, 1)
    return audit.select("call_id", "tokens_before", "allowed", "retry_after_s")


@query
def queue_delay(spark, sf):
    calls = I.usage_calls(spark, sf).select("call_id", "timestamp", "feature")
    waits = R.queue_delay(calls, ["feature"], QUEUE_RATE, QUEUE_BURST)
    return waits.select("call_id", "feature", "wait_s")


# Streams -------------------------------------------------------------------------------------


@query
def write_usage_stream(spark, sf):
    path, checkpoint = shared_path(spark, "usage"), shared_path(spark, "usage-checkpoint")
    calls = I.usage_from_events(I.repeated_event_stream(spark, sf), I.requests(spark, sf))
    J.write_usage_stream(calls, path, checkpoint, None).awaitTermination()
    return tables.read_usage(spark, path).select(
        "call_id", "model", "feature", "session_id", "input_tokens", "output_tokens",
        "cache_creation_tokens", "cache_read_tokens",
    )


@query
def stream_usage(spark, sf):
    path = shared_path(spark, "usage")
    sinks.usage_rows(I.usage_calls(spark, sf)).drop("date").write.parquet(path)
    rows = J.drain(tables.stream_usage(spark, path), "usage-copy")
    return rows.groupBy("model").agg(
        F.count(F.lit(1)).alias("calls"), F.sum("input_tokens").alias("input_tokens")
    )


def _fixed_prices(spark):
    return I.pricing(spark)


def _changing_prices(spark):
    """Reader of a price table that is replaced while the stream runs: after two micro-batches."""
    runs = []

    def read(session):
        runs.append(None)
        table = I.pricing(session)
        rates = [c for c in table.columns if c.endswith("per_1k")]
        return table if len(runs) <= 2 else table.withColumns({c: F.col(c) * 2 for c in rates})

    return read


@query
def stream_cost(spark, sf):
    path, checkpoint = shared_path(spark, "cost"), shared_path(spark, "cost-checkpoint")
    prices = _changing_prices(spark)
    J.stream_cost(I.call_stream(spark, sf), prices, path, checkpoint, None).awaitTermination()
    return spark.read.parquet(path).select("call_id", "model", "cost_usd")


@query
def stream_cost_discrepancy(spark, sf):
    path, checkpoint = shared_path(spark, "gaps"), shared_path(spark, "gaps-checkpoint")
    factor = F.when(F.col("call_id") % 10 == 0, 1.02).otherwise(1.005)

    def answers(costed):
        return costed.select("call_id", (F.col("cost_usd") * factor).alias("server_cost_usd"))

    J.stream_cost_discrepancies(
        I.call_stream(spark, sf), _fixed_prices, answers, path, checkpoint, interval=None
    ).awaitTermination()
    out = spark.read.parquet(path)
    return out.select("call_id", "model", "cost_usd", "server_cost_usd", "difference_pct")


def _budget_stream(spark, sf):
    """Policies of which a seventh more belong to the organisation that calls, and where their state is."""
    feed = tables.load_policies(I.policy_feed(spark, sf)).withColumn(
        "org_id", F.when(F.col("org_id") == "org-2", "org-1").otherwise(F.col("org_id"))
    )
    path, checkpoint = shared_path(spark, "budget"), shared_path(spark, "budget-checkpoint")
    J.stream_budget(
        I.call_stream(spark, sf), _fixed_prices, lambda _: feed, path, checkpoint, None
    ).awaitTermination()
    return feed, path


@query
def stream_budget_state(spark, sf):
    feed, path = _budget_stream(spark, sf)
    return J.read_budget(spark, path, feed).select(
        "id", "org_id", F.col("current_spend_usd").alias("spend"), F.col("spend_percentage").alias("percentage")
    )


@query
def stream_budget_alerts(spark, sf):
    _, path = _budget_stream(spark, sf)
    return J.read_alerts(spark, path).select("id", "threshold")


def _stream_spend(spark, sf, window):
    path, checkpoint = shared_path(spark, "spend"), shared_path(spark, "spend-checkpoint")
    J.stream_spend(
        I.call_stream(spark, sf), _fixed_prices, ["feature"], path, checkpoint, window, None
    ).awaitTermination()
    spend = J.read_spend(spark, path, {"feature": "string"})
    return spend.select("feature", F.unix_seconds("window_start").alias("start_s"),
                        F.col("spend_usd").cast("double").alias("spend_usd"), "calls")


@query
def stream_spend(spark, sf):
    return _stream_spend(spark, sf, "1 day")


@query
def stream_spend_weekly(spark, sf):
    return _stream_spend(spark, sf, "7 days")


@query
def stream_spend_monthly(spark, sf):
    return _stream_spend(spark, sf, None)


@query
def stream_session_ledger(spark, sf):
    path, checkpoint = shared_path(spark, "ledger"), shared_path(spark, "ledger-checkpoint")
    limits = checkpointed(I.own_limits(spark, sf))
    J.stream_session_ledger(
        I.call_stream(spark, sf), _fixed_prices, lambda _: limits, path, checkpoint, None
    ).awaitTermination()
    return spark.read.parquet(path).drop("timestamp", "batch", "arrival", "cost_usd")


@query
def stream_scan(spark, sf):
    messages = I.messages_from_conversations(I.conversation_stream(spark, sf))
    gated = J.stream_scan(messages).select(
        "request_id", "msg_index", "blocked", F.size("violations").alias("violations"),
        "redacted_text",
    )
    return J.drain(gated, "gate")


@query
def stream_signals(spark, sf):
    path, checkpoint = shared_path(spark, "signals"), shared_path(spark, "signals-checkpoint")
    messages = I.messages_from_conversations(I.conversation_stream(spark, sf))
    environment = F.when(F.col("request_id") % 2 == 0, "production").otherwise("staging")
    at = F.lit("2024-01-31").cast("timestamp")
    J.stream_signals(
        messages, F.lit("org-1"), environment, at, path, checkpoint, None
    ).awaitTermination()
    return J.read_signals(spark, path).drop("detected_at", "user_id", "feature", "msg_index")


@query
def stream_rate_audit(spark, sf):
    path, checkpoint = shared_path(spark, "rate"), shared_path(spark, "rate-checkpoint")
    J.stream_rate_audit(
        I.call_stream(spark, sf), "feature", path, checkpoint, AUDIT_RATE, AUDIT_BURST, None
    ).awaitTermination()
    audit = spark.read.parquet(path).withColumnRenamed("key", "feature")
    return audit.drop("timestamp", "batch")


# The whole path ------------------------------------------------------------------------------


def _admission(spark, sf, **mode) -> DataFrame:
    """With half the sample budgets, so that every stage stops some calls."""
    policies = I.policies(spark).withColumn("budget_amount_usd", F.col("budget_amount_usd") / 2)
    # The log as it is stored, so that the path runs on what the writer kept.
    path = shared_path(spark, "usage")
    sinks.write_usage(I.usage_calls(spark, sf), path)
    return admission(
        tables.read_usage(spark, path), I.messages(spark, sf), policies,
        I.session_limits(spark, sf), I.pricing(spark), QUEUE_RATE, QUEUE_BURST, **mode,
    )


@query
def admission_report(spark, sf) -> DataFrame:
    return _admission(spark, sf)


@query
def admission_report_standard(spark, sf) -> DataFrame:
    return _admission(spark, sf, verdicts=_verdicts(spark, sf))


@query
def admission_report_strict(spark, sf) -> DataFrame:
    return _admission(spark, sf, verdicts=_verdicts(spark, sf), fail_open=False)
