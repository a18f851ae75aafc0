"""DuckDB SQL that computes each query's answer in another way.

Pieces are common table expressions; ``_with`` puts a piece after everything it needs.
"""

from ..functions import patterns as P
from ..schemas import BUDGET_PERIODS, BUDGET_SCOPES, PROVIDERS
from . import inputs as I
from .queries import AUDIT_BURST, AUDIT_RATE, QUEUE_BURST, QUEUE_RATE

CHECKS: dict[str, str] = {}
PIECES: dict[str, tuple[list[str], str]] = {}
_WAITING: dict[str, tuple[list[str], str]] = {}


def _piece(name, sql, needs=()):
    PIECES[name] = (list(needs), sql)


def _with(needs, sql):
    order = []

    def visit(name):
        if name not in order:
            for needed in PIECES[name][0]:
                visit(needed)
            order.append(name)

    for name in needs:
        visit(name)
    parts = []
    for name in order:
        body = PIECES[name][1]
        # A recursive piece brings its column list along.
        parts.append(f"{name} {body}" if body.startswith("(") else f"{name} AS ({body})")
    return f"WITH RECURSIVE {', '.join(parts)} {sql}"


def check(name, needs, sql):
    """Register a query's SQL; it is put together once all pieces are there."""
    _WAITING[name] = (needs, sql)


def _text(value):
    return "'" + value.replace("'", "''") + "'"


def _list(values):
    return "[" + ", ".join(_text(v) for v in values) + "]"


def _in(values):
    return "(" + ", ".join(_text(v) for v in values) + ")"


MONEY = "DECIMAL(38,12)"

# Inputs --------------------------------------------------------------------------------------

_piece(
    "usage_calls",
    f"""SELECT event_id AS call_id, 'key-1' AS api_key, ts,
    {_list(p for _, p in I.MODELS)}[event_id % 6 + 1] AS provider,
    {_list(m for m, _ in I.MODELS)}[event_id % 6 + 1] AS model,
    event_type AS feature, CAST(user_id AS VARCHAR) AS customer_id,
    CAST(floor(value * 100) AS BIGINT) AS input_tokens, k * 10 AS output_tokens,
    CASE WHEN event_id % 4 = 0 THEN k END AS cache_creation_tokens,
    CASE WHEN event_id % 3 = 0 THEN k END AS cache_read_tokens,
    k + 50 AS latency_ms, 'org-1' AS org_id,
    CASE WHEN event_id % 2 = 0 THEN 'production' ELSE 'staging' END AS environment,
    CASE WHEN event_id % 9 <> 4
      THEN user_id || '-' || strftime(date_trunc('week', ts), '%Y%m%d') END AS session_id,
    event_id % (SELECT coalesce(max(conv_id) + 1, 1) FROM conversations) AS request_id
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)""",
)
# Spark marks double literals with a D. In DuckDB a plain literal is a decimal, so cast.
_piece(
    "pricing",
    f"""SELECT provider, model, CAST(ri AS DOUBLE) AS ri, CAST(ro AS DOUBLE) AS ro,
    CAST(rcc AS DOUBLE) AS rcc, CAST(rcr AS DOUBLE) AS rcr
    FROM (VALUES {I.PRICING_ROWS.replace('D,', ',').replace('D)', ')')})
    AS p(provider, model, ri, ro, rcc, rcr)""",
)
_COST = """coalesce(coalesce(input_tokens, 0) / 1000 * ri + coalesce(output_tokens, 0) / 1000 * ro
    + coalesce(cache_creation_tokens, 0) / 1000 * coalesce(rcc, ri)
    + coalesce(cache_read_tokens, 0) / 1000 * coalesce(rcr, ri), 0.0)"""
_piece(
    "costed",
    f"""SELECT c.*, {_COST} AS cost_usd,
    coalesce(0.5::DOUBLE * ri + 0.5::DOUBLE * ro, 0.0) AS estimated_cost_usd
    FROM usage_calls c LEFT JOIN pricing USING (model)""",
    ["usage_calls", "pricing"],
)
_piece(
    "price_feed",
    f"""SELECT p_partkey AS "position", {_list(PROVIDERS)}[p_partkey % 6 + 1] AS provider,
    'model-' || (p_partkey % 300) AS model,
    CASE WHEN p_partkey % 50 = 0 THEN -(p_retailprice / 100000) ELSE p_retailprice / 100000 END
      AS input_cost_per_1k,
    p_retailprice / 100000 * 3 AS output_cost_per_1k,
    CASE WHEN p_partkey % 3 = 0 THEN p_retailprice / 100000 * 2 END AS cache_creation_cost_per_1k,
    CASE WHEN p_partkey % 70 = 0 THEN -(p_retailprice / 100000)
      WHEN p_partkey % 5 = 0 THEN 0.0 END::DOUBLE AS cache_read_cost_per_1k
    FROM part""",
)
_piece(
    "policy_feed",
    """SELECT 'cust-' || c_custkey AS id, 'org-' || (c_custkey % 7) AS org_id, c_name AS name,
    CASE WHEN c_custkey % 97 = 0 THEN 'team' ELSE 'custom' END AS scope,
    CAST(c_custkey AS VARCHAR) AS scope_identifier,
    CAST(c_custkey % 5 AS DOUBLE) AS budget_amount_usd,
    CASE WHEN c_custkey % 89 = 0 THEN 'yearly'
      ELSE ['daily', 'weekly', 'monthly', 'custom'][c_custkey % 4 + 1] END AS period,
    CASE WHEN c_custkey % 4 = 3 THEN CAST(c_custkey % 10 + 1 AS INTEGER) END AS custom_period_days,
    ['alert', 'throttle', 'block'][c_custkey % 3 + 1] AS action,
    CASE WHEN c_custkey % 3 = 1 THEN 50.0::DOUBLE END AS throttle_percentage,
    CASE WHEN c_custkey % 6 <> 0 THEN [50, 80, 90] END AS alert_thresholds,
    abs(c_acctbal / 1000) AS current_spend_usd, 0.0::DOUBLE AS spend_percentage,
    TIMESTAMP '2024-01-01' + to_days(CAST(c_custkey % 31 AS INTEGER)) AS period_start,
    c_custkey % 11 <> 0 AS is_active FROM customer""",
)
_END = """period_start + CASE period WHEN 'daily' THEN to_days(1) WHEN 'weekly' THEN to_days(7)
    WHEN 'monthly' THEN to_months(1) ELSE to_days(custom_period_days) END"""
_piece(
    "customer_policies",
    f"""SELECT * FROM policy_feed WHERE scope IN {_in(BUDGET_SCOPES)}
    AND period IN {_in(BUDGET_PERIODS)}""",
    ["policy_feed"],
)
_piece(
    "policies",
    f"""SELECT id, 'org-1' AS org_id, name, scope, scope_identifier,
    CAST(amount AS DOUBLE) AS budget_amount_usd, period, CAST(days AS INTEGER) AS custom_period_days,
    action, CAST(throttle AS DOUBLE) AS throttle_percentage, [50, 80, 90] AS alert_thresholds,
    123.45::DOUBLE AS current_spend_usd, 24.69::DOUBLE AS spend_percentage,
    TIMESTAMP '2024-01-01' AS period_start, active AS is_active
    FROM (VALUES {I.POLICY_ROWS.replace('0D', '0')}) AS p(id, name, scope, scope_identifier, amount,
    period, days, action, throttle, active)""",
)
_piece(
    "all_policies",
    """SELECT * FROM policies UNION ALL BY NAME
    SELECT * REPLACE ('org-1' AS org_id) FROM customer_policies""",
    ["policies", "customer_policies"],
)
_SUFFIX = "coalesce(" + _list(I.SUFFIXES) + "[{n} % 17 + 1], '')"
_piece(
    "docs", f"SELECT doc_id AS id, text || {_SUFFIX.format(n='doc_id')} AS text FROM documents"
)
_piece(
    "messages",
    f"""SELECT conv_id * 8 + turn AS id, conv_id AS request_id, turn AS msg_index,
    text || {_SUFFIX.format(n='(conv_id * 8 + turn)')} AS text FROM conversations""",
)

# Usage ---------------------------------------------------------------------------------------

_EMPTY = "call_id % 7 = 0"


def _counts(provider):
    cached = "coalesce(cache_read_tokens, 0)"
    if provider == "anthropic":
        parts = ("input_tokens", "coalesce(cache_creation_tokens, 0)")
    else:
        parts = (f"greatest(0, input_tokens - {cached})", "0")
    values = {
        "input_tokens": parts[0],
        "output_tokens": "output_tokens",
        "cache_creation_tokens": parts[1],
        "cache_read_tokens": cached,
    }
    return {n: f"CAST(CASE WHEN {_EMPTY} THEN 0 ELSE {v} END AS BIGINT)" for n, v in values.items()}


for _provider in ("openai", "anthropic", "google"):
    check(
        f"usage_{_provider}",
        ["usage_calls"],
        "SELECT call_id, "
        + ", ".join(f"{v} AS {n}" for n, v in _counts(_provider).items())
        + " FROM usage_calls",
    )

_NORMAL = " UNION ALL ".join(
    f"SELECT call_id, '{p}' AS provider, {c['input_tokens']} AS input_tokens, "
    f"{c['output_tokens']} AS output_tokens, "
    f"nullif({c['cache_creation_tokens']}, 0) AS cache_creation_tokens, "
    f"nullif({c['cache_read_tokens']}, 0) AS cache_read_tokens "
    f"FROM usage_calls WHERE call_id % 4 = {i} AND NOT {_EMPTY}"
    for i, p in enumerate(("openai", "anthropic", "google"))
    for c in [_counts(p)]
)
check("usage_normalised", ["usage_calls"], _NORMAL)
check(
    "usage_unsupported",
    ["usage_calls"],
    f"""SELECT call_id, CASE WHEN call_id % 4 = 3 THEN '{{"text":"none"}}' ELSE '{{}}' END AS payload,
    'unsupported provider' AS reason FROM usage_calls WHERE call_id % 4 = 3 OR {_EMPTY}""",
)
check(
    "usage_detected_provider",
    ["usage_calls"],
    f"""SELECT CASE WHEN {_EMPTY} THEN NULL
    ELSE ['openai', 'anthropic', 'google', NULL][call_id % 4 + 1] END AS provider,
    count(*) AS calls FROM usage_calls GROUP BY 1""",
)

_RULES = {
    "api_key": "call_id % 11 = 0",
    "timestamp": "call_id % 13 = 0",
    "provider": "call_id % 17 = 0",
    "model": "call_id % 19 = 0",
    "input_tokens": "call_id % 23 = 0 OR call_id % 31 = 0",
    "cache_read_tokens": "call_id % 37 = 0",
    "latency_ms": "call_id % 29 = 0",
}
_ERRORS = "concat_ws(',', " + ", ".join(
    f"CASE WHEN {rule} THEN '{name}' END" for name, rule in _RULES.items()
) + ")"
check(
    "usage_rejects",
    ["usage_calls"],
    f"SELECT * FROM (SELECT call_id, {_ERRORS} AS errors FROM usage_calls) WHERE errors <> ''",
)
check(
    "usage_valid",
    ["usage_calls"],
    f"""SELECT provider, model, count(*) AS calls FROM usage_calls WHERE {_ERRORS} = ''
    GROUP BY ALL""",
)
check(
    "usage_zero_cache",
    ["usage_calls"],
    """SELECT call_id, nullif(cache_creation_tokens, 0) AS cache_creation_tokens,
    nullif(cache_read_tokens, 0) AS cache_read_tokens FROM usage_calls""",
)
CHECKS["message_text"] = """
WITH m AS (SELECT conv_id * 8 + turn AS request_id, turn % 3 AS kind, role, text FROM conversations)
SELECT request_id, CAST(0 AS INTEGER) AS msg_index, 'openai' AS provider, role, text
  FROM m WHERE kind = 0
UNION ALL SELECT request_id, 0, 'anthropic', role, text FROM m WHERE kind = 1 AND text <> ''
UNION ALL SELECT request_id, 1, 'anthropic', role, text || '  ' || role FROM m WHERE kind = 1
UNION ALL SELECT request_id, 0, 'google', 'user', text FROM m WHERE kind = 2"""

# Sources and sinks ---------------------------------------------------------------------------

_STORED = """SELECT call_id, model, feature, session_id, input_tokens, output_tokens,
    nullif(cache_creation_tokens, 0) AS cache_creation_tokens,
    nullif(cache_read_tokens, 0) AS cache_read_tokens FROM usage_calls"""
check("read_usage", ["usage_calls"], _STORED)
check("write_usage_stream", ["usage_calls"], _STORED)
check(
    "stream_usage",
    ["usage_calls"],
    """SELECT model, count(*) AS calls, CAST(sum(input_tokens) AS BIGINT) AS input_tokens
    FROM usage_calls GROUP BY 1""",
)
check(
    "load_pricing",
    ["price_feed"],
    """SELECT * EXCLUDE ("position") FROM price_feed
    QUALIFY row_number() OVER (PARTITION BY model ORDER BY "position" DESC) = 1""",
)
check(
    "pricing_rejects",
    ["price_feed"],
    """SELECT * FROM (SELECT "position", model, concat_ws(',',
    CASE WHEN input_cost_per_1k < 0 THEN 'input_cost_per_1k' END,
    CASE WHEN cache_read_cost_per_1k < 0 THEN 'cache_read_cost_per_1k' END) AS errors
    FROM price_feed) WHERE errors <> ''""",
)
check(
    "load_policies",
    ["policy_feed"],
    """SELECT * EXCLUDE (spend_percentage, period_start)
    REPLACE (array_to_string(alert_thresholds, ',') AS alert_thresholds) FROM policy_feed""",
)
check(
    "policy_rejects",
    ["policy_feed"],
    f"""SELECT * FROM (SELECT id, concat_ws(',',
    CASE WHEN scope NOT IN {_in(BUDGET_SCOPES)} THEN 'scope' END,
    CASE WHEN period NOT IN {_in(BUDGET_PERIODS)} THEN 'period' END) AS errors FROM policy_feed)
    WHERE errors <> ''""",
)
# Rows without an id have one made of their values and of a number that tells equal rows apart.
CHECKS["load_sessions"] = """
WITH sessions AS (
  SELECT c_custkey AS k, CASE WHEN c_custkey % 10 <> 0 THEN 's-' || c_custkey END AS session_id,
  c_mktsegment AS feature, CAST(c_custkey AS VARCHAR) AS user_id,
  CASE WHEN c_custkey % 3 = 0 THEN 5.0::DOUBLE END AS max_spend_usd,
  CASE WHEN c_custkey % 4 = 0 THEN 10::BIGINT END AS max_iterations, 'active' AS status,
  unnest(range(1, CASE WHEN c_custkey % 7 = 0 THEN 4 ELSE 2 END)) AS n FROM customer
), hashed AS (
  SELECT *, md5(concat_ws(chr(31), '-', coalesce('=' || feature, '-'), '=' || user_id,
    coalesce('=' || max_spend_usd, '-'), coalesce('=' || max_iterations, '-'), '=' || status, n)) AS h FROM sessions
)
SELECT coalesce(session_id, concat_ws('-', substr(h, 1, 8), substr(h, 9, 4), '3' || substr(h, 14, 3),
  substr('89ab', ('0x' || substr(h, 17, 1))::INTEGER % 4 + 1, 1) || substr(h, 18, 3), substr(h, 21, 12))) AS session_id,
feature, user_id, max_spend_usd, max_iterations, status FROM hashed"""

# Cost ----------------------------------------------------------------------------------------

check("usage_cost", ["costed"], "SELECT call_id, model, cost_usd FROM costed")
check(
    "stream_cost",
    ["costed"],
    f"""SELECT call_id, model, CASE WHEN call_id % {I.PARTS} < 2 THEN cost_usd ELSE cost_usd * 2 END
    AS cost_usd FROM costed""",
)
check("cost_estimate", ["costed"], "SELECT call_id, model, estimated_cost_usd FROM costed")
_REPORT = f"""CAST(sum(CAST(cost_usd AS {MONEY})) AS DOUBLE) AS spend_usd,
    CAST(sum(input_tokens) AS BIGINT) AS input_tokens,
    CAST(sum(output_tokens) AS BIGINT) AS output_tokens,
    CAST(sum(coalesce(cache_creation_tokens, 0)) AS BIGINT) AS cache_creation_tokens,
    CAST(sum(coalesce(cache_read_tokens, 0)) AS BIGINT) AS cache_read_tokens, count(*) AS calls"""
for _name, _dims, _by in (
    ("spend_by_model", "provider, model", "provider, model"),
    ("spend_by_customer", "customer_id, feature", "customer_id, feature"),
    ("spend_rollup", "feature, model", "ROLLUP (feature, model)"),
):
    check(_name, ["costed"], f"SELECT {_dims}, {_REPORT} FROM costed GROUP BY {_by}")
check(
    "cost_discrepancy",
    ["costed"],
    """SELECT call_id, model, cost_usd, server_cost_usd,
    abs(server_cost_usd - cost_usd) / cost_usd * 100 AS difference_pct
    FROM (SELECT *, cost_usd * CASE WHEN call_id % 10 = 0 THEN 1.02::DOUBLE ELSE 1.005::DOUBLE END
      AS server_cost_usd FROM costed)
    WHERE cost_usd > 0 AND abs(server_cost_usd - cost_usd) / cost_usd > 0.01""",
)
_piece(
    "price_history",
    """SELECT model, TIMESTAMP '2024-01-01' AS effective_from, ri, ro, rcc, rcr FROM pricing
    UNION ALL SELECT model, TIMESTAMP '2024-01-15', ri * 2, ro * 2, rcc * 2, rcr * 2 FROM pricing""",
    ["pricing"],
)
check(
    "cost_asof",
    ["usage_calls", "price_history"],
    f"""SELECT call_id, c.model, {_COST} AS cost_usd FROM usage_calls c
    ASOF LEFT JOIN price_history h ON c.model = h.model AND c.ts >= h.effective_from""",
)
_LATENCY = """SELECT provider, model, count(*) AS calls,
    sum(latency_ms)::DOUBLE / count(*) AS avg_latency_ms, max(latency_ms) AS max_latency_ms,
    {p95} AS p95_latency_ms FROM usage_calls GROUP BY ALL"""
check("latency_report", ["usage_calls"], _LATENCY.format(p95="quantile_cont(latency_ms, 0.95)"))
check(
    "latency_report_sketch",
    ["usage_calls"],
    _LATENCY.format(p95="quantile_disc(latency_ms, 0.95)"),
)

# Budgets -------------------------------------------------------------------------------------

_piece(
    "org_spend",
    f"""SELECT org_id, CAST(sum(CAST(cost_usd AS {MONEY})) AS DOUBLE) AS spent
    FROM costed GROUP BY 1""",
    ["costed"],
)
check(
    "apply_spend",
    ["policy_feed", "org_spend"],
    """SELECT id, org_id, current_spend_usd + coalesce(spent, 0) AS spend,
    CASE WHEN spent IS NOT NULL AND budget_amount_usd > 0
      THEN (current_spend_usd + spent) / budget_amount_usd * 100 ELSE spend_percentage END
      AS percentage
    FROM (SELECT * REPLACE (CASE org_id WHEN 'org-2' THEN 'org-1' ELSE org_id END AS org_id)
      FROM policy_feed) LEFT JOIN org_spend USING (org_id)""",
)
check(
    "stream_budget_alerts",
    ["policy_feed", "org_spend"],
    """SELECT id, threshold FROM (SELECT *, unnest(alert_thresholds) AS threshold,
        current_spend_usd / budget_amount_usd * 100 AS before,
        (current_spend_usd + spent) / budget_amount_usd * 100 AS after
      FROM (SELECT * REPLACE (CASE org_id WHEN 'org-2' THEN 'org-1' ELSE org_id END AS org_id)
        FROM policy_feed) JOIN org_spend USING (org_id) WHERE is_active AND budget_amount_usd > 0)
    WHERE before < threshold AND after >= threshold""",
)
check(
    "apply_spend_total",
    ["policy_feed", "org_spend"],
    f"""SELECT org_id, sum(budget_amount_usd) AS total_budget_usd,
    CAST(sum(CAST(current_spend_usd AS {MONEY})) AS DOUBLE) + coalesce(any_value(spent), 0)
      AS total_spend_usd
    FROM policy_feed LEFT JOIN org_spend USING (org_id) GROUP BY org_id""",
)
check(
    "policy_window",
    ["customer_policies"],
    f"""SELECT id, period, CAST(epoch(period_start) AS BIGINT) AS start_s,
    CAST(epoch({_END}) AS BIGINT) AS end_s FROM customer_policies""",
)
def _matched(policies):
    scoped = f"""c.org_id = p.org_id AND c.ts >= p.period_start AND c.ts < p.period_end
    AND (p.scope = 'organization' OR p.scope_identifier = CASE p.scope WHEN 'feature' THEN c.feature
      WHEN 'environment' THEN c.environment WHEN 'custom' THEN c.customer_id END)"""
    return f"""SELECT p.id AS policy_id, p.budget_amount_usd, p.action, p.throttle_percentage,
    p.alert_thresholds, c.call_id, c.ts, c.cost_usd, c.estimated_cost_usd,
    sum(CAST(c.cost_usd AS {MONEY})) OVER (PARTITION BY p.id ORDER BY c.ts, c.call_id
      ROWS UNBOUNDED PRECEDING) AS running
    FROM {{calls}} c JOIN (SELECT *, {_END} AS period_end FROM {policies} WHERE is_active) p
    ON {scoped}"""


_piece("matched", _matched("all_policies").format(calls="costed"), ["costed", "all_policies"])
_piece(
    "spent",
    f"""SELECT p.*, coalesce(m.spend, 0) AS spend,
    CASE WHEN budget_amount_usd > 0 THEN CAST(coalesce(m.spend, 0) AS DOUBLE)
      / budget_amount_usd * 100 ELSE spend_percentage END AS percentage
    FROM all_policies p LEFT JOIN (SELECT policy_id, sum(CAST(cost_usd AS {MONEY})) AS spend
      FROM matched GROUP BY 1) m ON p.id = m.policy_id WHERE p.is_active""",
    ["matched"],
)
check(
    "policy_spend",
    ["spent"],
    "SELECT id, CAST(spend AS DOUBLE) AS spend_usd, percentage FROM spent",
)
check(
    "alert_crossings",
    ["spent"],
    """SELECT id, threshold FROM (SELECT id, percentage, unnest(alert_thresholds) AS threshold
    FROM spent) WHERE percentage >= threshold""",
)
check(
    "first_crossing",
    ["matched"],
    """SELECT policy_id, threshold, call_id, CAST(running AS DOUBLE) AS running_spend_usd,
    percentage
    FROM (SELECT *, unnest(alert_thresholds) AS threshold,
        CAST(running AS DOUBLE) / budget_amount_usd * 100 AS percentage
      FROM matched WHERE budget_amount_usd > 0)
    WHERE percentage >= threshold
    QUALIFY row_number() OVER (PARTITION BY policy_id, threshold ORDER BY ts, call_id) = 1""",
)


def _verdicts(matched):
    return f"""SELECT call_id,
    max(CASE action WHEN 'alert' THEN 1 WHEN 'throttle' THEN 2 ELSE 3 END) AS strictest,
    max(CASE WHEN action = 'throttle' THEN throttle_percentage END) AS throttle_percentage
    FROM {matched} WHERE running - CAST(cost_usd AS {MONEY}) + CAST(estimated_cost_usd AS {MONEY})
      > CAST(budget_amount_usd AS {MONEY}) GROUP BY 1"""


_piece("verdicts", _verdicts("matched"), ["matched"])
_piece(
    "checked",
    """SELECT call_id, coalesce(strictest, 0) < 3 AS allowed,
    ['alert', 'throttle', 'block'][strictest] AS action, throttle_percentage,
    CASE WHEN strictest IS NOT NULL THEN 'Budget limit exceeded' END AS reason
    FROM usage_calls LEFT JOIN verdicts USING (call_id)""",
    ["usage_calls", "verdicts"],
)
check("budget_check", ["checked"], "SELECT * FROM checked")
check(
    "budget_blocked",
    ["checked"],
    "SELECT call_id, reason FROM checked WHERE NOT allowed AND action = 'block'",
)
_AT_RISK = "percentage >= coalesce(list_min(alert_thresholds), 100)"
check(
    "budget_status",
    ["spent"],
    f"""SELECT org_id, CAST(sum(CAST(budget_amount_usd AS {MONEY})) AS DOUBLE) AS total_budget_usd,
    CAST(sum(spend) AS DOUBLE) AS total_spend_usd,
    count(*) FILTER ({_AT_RISK}) AS policies_at_risk FROM spent GROUP BY 1""",
)
check(
    "budget_status_policies",
    ["spent"],
    f"""SELECT org_id, id, scope, CAST(spend AS DOUBLE) AS current_spend_usd,
    percentage AS spend_percentage, {_AT_RISK} AS at_risk FROM spent""",
)
check(
    "fail_open",
    ["checked"],
    """SELECT call_id, CASE WHEN call_id % 5 = 0 THEN true ELSE allowed END AS allowed,
    CASE WHEN call_id % 5 <> 0 THEN action END AS action,
    CASE WHEN call_id % 5 <> 0 THEN throttle_percentage END AS throttle_percentage,
    CASE WHEN call_id % 5 = 0 THEN 'fail-open: API unavailable' ELSE reason END AS reason
    FROM checked""",
)
check(
    "fail_closed",
    ["checked"],
    """SELECT call_id, CASE WHEN call_id % 5 <> 0 THEN allowed END AS allowed,
    call_id % 5 = 0 AS error FROM checked""",
)

# Sessions ------------------------------------------------------------------------------------

_LEDGER = f"""sum(CAST(cost_usd AS {MONEY})) OVER w AS spent, row_number() OVER w AS n,
    sum(input_tokens) OVER w AS tokens"""
_WINDOW = "WINDOW w AS (PARTITION BY session_id ORDER BY ts, call_id ROWS UNBOUNDED PRECEDING)"
_piece(
    "ledger",
    f"SELECT *, {_LEDGER} FROM costed WHERE session_id IS NOT NULL {_WINDOW}",
    ["costed"],
)
_piece("loose", "SELECT * FROM costed WHERE session_id IS NULL", ["costed"])
check(
    "session_ledger",
    ["ledger", "loose"],
    """SELECT session_id, call_id, n AS call_sequence,
    CAST(tokens AS BIGINT) AS cumulative_input_tokens, cost_usd,
    CAST(spent AS DOUBLE) AS cumulative_cost_usd FROM ledger
    UNION ALL SELECT NULL, call_id, NULL, NULL, cost_usd, NULL FROM loose""",
)
_piece("marked_docs", "SELECT DISTINCT id FROM kept", ["kept"])
check(
    "write_session_calls",
    ["ledger", "marked_docs"],
    """SELECT session_id, call_id, n AS call_sequence, 'llm' AS call_type,
    CAST(tokens AS BIGINT) AS cumulative_input_tokens, d.id IS NOT NULL AS pii_detected
    FROM ledger LEFT JOIN marked_docs d ON d.id = call_id""",
)
_OVER = f"""spent - CAST(cost_usd AS {MONEY}) + CAST(estimated_cost_usd AS {MONEY})
    > {I.SESSION_SPEND}"""
check(
    "session_first_refusal",
    ["ledger"],
    f"""SELECT session_id, call_id,
    CASE WHEN {_OVER} THEN 'budget_exceeded' ELSE 'iteration_limit_exceeded' END AS reason,
    CAST(spent - CAST(cost_usd AS {MONEY}) AS DOUBLE) AS spend_before_usd,
    n - 1 AS iterations_before
    FROM ledger WHERE {_OVER} OR n > {I.SESSION_CALLS}
    QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY ts, call_id) = 1""",
)


def _replay(source):
    """Walk every session one call at a time; (spend, calls) before each call."""
    decide = f"""CASE WHEN NOT eligible THEN 'skipped'
      WHEN spend_before + estimate > max_spend THEN 'budget_exceeded'
      WHEN calls_before + 1 > max_calls THEN 'iteration_limit_exceeded' ELSE 'ok' END"""
    return f"""(session_id, call_id, n, cost, spend_before, calls_before, verdict) AS (
    SELECT session_id, call_id, n, cost, spend_before, calls_before, {decide}
    FROM (SELECT *, CAST(0 AS {MONEY}) AS spend_before, CAST(0 AS BIGINT) AS calls_before
      FROM {source} WHERE n = 1)
    UNION ALL
    SELECT session_id, call_id, n, cost, spend_before, calls_before, {decide}
    FROM (SELECT s.*,
        CAST(r.spend_before + CASE WHEN r.verdict = 'ok' THEN r.cost ELSE 0 END AS {MONEY})
          AS spend_before,
        r.calls_before + CASE WHEN r.verdict = 'ok' THEN 1 ELSE 0 END AS calls_before
      FROM replay r JOIN {source} s ON s.session_id = r.session_id AND s.n = r.n + 1))"""


_LIMITS = f"CAST({I.SESSION_SPEND} AS {MONEY}) AS max_spend, {I.SESSION_CALLS} AS max_calls"
_piece(
    "steps",
    f"""SELECT session_id, call_id, n, CAST(cost_usd AS {MONEY}) AS cost,
    CAST(estimated_cost_usd AS {MONEY}) AS estimate, true AS eligible, {_LIMITS} FROM ledger""",
    ["ledger"],
)
_piece("replay", _replay("steps"), ["steps"])
check(
    "session_replay",
    ["replay", "loose"],
    """SELECT session_id, call_id, verdict = 'ok' AS allowed,
    CASE WHEN verdict <> 'ok' THEN verdict END AS reason,
    CAST(spend_before AS DOUBLE) AS spend_before_usd, calls_before AS iterations_before
    FROM replay UNION ALL SELECT NULL, call_id, true, NULL, NULL, NULL FROM loose""",
)
_piece(
    "summary",
    f"""SELECT session_id, CAST(coalesce(sum(cost) FILTER (verdict = 'ok'), 0) AS {MONEY}) AS spend,
    count(*) FILTER (verdict = 'ok') AS calls,
    arg_max(verdict, n) FILTER (verdict <> 'ok') AS refusal,
    CASE CAST(split_part(session_id, '-', 1) AS BIGINT) % 3 WHEN 0 THEN 'completed'
      WHEN 1 THEN 'cancelled' END AS closed
    FROM (SELECT session_id, cost, verdict, n FROM replay
      UNION ALL SELECT DISTINCT user_id || '-idle', CAST(0 AS DECIMAL(38,12)), NULL, NULL FROM events)
    GROUP BY 1""",
    ["replay"],
)
_SUMMARY = """SELECT session_id, CAST(spend AS DOUBLE) AS final_spend_usd,
    calls AS final_iteration_count,
    CASE WHEN closed = 'completed' THEN 'completed'
      WHEN coalesce(closed, refusal) IS NOT NULL THEN 'terminated' ELSE 'active' END AS status,
    coalesce(closed, refusal) AS termination_reason FROM summary"""
check("session_summary", ["summary"], _SUMMARY)
check(
    "write_session_closures", ["summary"], f"SELECT * FROM ({_SUMMARY}) WHERE status <> 'active'"
)
check(
    "session_remaining",
    ["summary"],
    f"""SELECT session_id, greatest(0.0::DOUBLE, CAST({I.SESSION_SPEND} - spend AS DOUBLE))
      AS remaining_budget_usd, greatest(0, {I.SESSION_CALLS} - calls) AS remaining_iterations
    FROM summary""",
)
# Streams take rows in parts, dealt by id; within a part in order of time.
_piece(
    "stream_ledger",
    f"""SELECT *, row_number() OVER (PARTITION BY session_id
      ORDER BY call_id % {I.PARTS}, ts, call_id) AS n,
    CAST(split_part(session_id, '-', 1) AS BIGINT) % 3 AS turn
    FROM costed WHERE session_id IS NOT NULL""",
    ["costed"],
)
_piece(
    "stream_steps",
    f"""SELECT session_id, call_id, n, CAST(cost_usd AS {MONEY}) AS cost,
    CAST(estimated_cost_usd AS {MONEY}) AS estimate, true AS eligible,
    CAST(CASE turn WHEN 0 THEN {I.SESSION_SPEND} WHEN 1 THEN {I.SESSION_SPEND / 2} END AS {MONEY})
      AS max_spend, CASE turn WHEN 0 THEN {I.SESSION_CALLS} WHEN 1 THEN 3 END AS max_calls
    FROM stream_ledger""",
    ["stream_ledger"],
)
_piece(
    "stream_replay",
    _replay("stream_steps").replace("FROM replay r", "FROM stream_replay r"),
    ["stream_steps"],
)
check(
    "stream_session_ledger",
    ["stream_replay", "stream_ledger", "loose"],
    """SELECT session_id, call_id,
    CAST(calls_before + CASE WHEN verdict = 'ok' THEN 1 ELSE 0 END AS BIGINT) AS call_sequence,
    CAST(coalesce(sum(input_tokens) FILTER (verdict = 'ok') OVER w, 0) AS BIGINT)
      AS cumulative_input_tokens,
    floor(total) + CAST((total - floor(total)) * 1000000000000 AS DOUBLE) / 1e12::DOUBLE
      AS cumulative_cost_usd,
    verdict = 'ok' AS allowed, CASE WHEN verdict <> 'ok' THEN verdict END AS reason,
    CASE WHEN count(*) FILTER (verdict <> 'ok') OVER w > 0 THEN 'terminated' ELSE 'active' END
      AS status
    FROM (SELECT *, spend_before + CASE WHEN verdict = 'ok' THEN cost ELSE 0 END AS total
      FROM stream_replay) r JOIN (SELECT call_id, input_tokens FROM stream_ledger) USING (call_id)
    WINDOW w AS (PARTITION BY session_id ORDER BY n ROWS UNBOUNDED PRECEDING)
    UNION ALL SELECT NULL, call_id, NULL, NULL, NULL, true, NULL, NULL FROM loose""",
)

# Content -------------------------------------------------------------------------------------


def _luhn(value):
    """Thirteen to nineteen digits whose doubled checksum ends in zero."""
    digits = f"regexp_replace({value}, '[{P.SPACES}-]', '', 'g')"
    return f"""(length({digits}) BETWEEN 13 AND 19 AND regexp_full_match({digits}, '[0-9]*') AND
    list_sum(list_transform(range(1, length({digits}) + 1), lambda i:
      CASE WHEN i % 2 = 1 THEN CAST({digits}[-i] AS INTEGER)
        WHEN CAST({digits}[-i] AS INTEGER) > 4 THEN CAST({digits}[-i] AS INTEGER) * 2 - 9
        ELSE CAST({digits}[-i] AS INTEGER) * 2 END)) % 10 = 0)"""


def _spans(table, pattern, luhn=False):
    """(id, value, start, end) of every match, from the texts between matches."""
    p = _text(pattern)
    where = f"WHERE {_luhn('value')}" if luhn else ""
    return f"""SELECT * FROM (SELECT id, m[i] AS value,
      CAST(list_sum(list_transform(g[1:i], lambda x: length(x)))
        + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS INTEGER) AS s,
      CAST(list_sum(list_transform(g[1:i], lambda x: length(x)))
        + list_sum(list_transform(m[1:i], lambda x: length(x))) AS INTEGER) AS e
    FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (
      SELECT id, regexp_extract_all(text, {p}) AS m, regexp_split_to_array(text, {p}) AS g
      FROM {table} WHERE regexp_matches(text, {p})))) {where}"""


def _content(table, prefix=""):
    """Pieces for one text table: candidates, kept entities, redaction, violations."""
    candidates = " UNION ALL ".join(
        f"SELECT id, {rank} AS rank, '{name}' AS type, value, s, e FROM "
        f"({_spans(table, pattern, name.startswith('credit_card_'))})"
        for rank, (name, pattern) in enumerate(P.PII_RE2)
    )
    _piece(
        f"{prefix}candidates",
        f"""SELECT *, row_number() OVER (PARTITION BY id ORDER BY s, rank) AS n
        FROM ({candidates})""",
        [table],
    )
    # A slot is one kept entity; a longer one on the same start takes the slot over.
    _piece(
        f"{prefix}walk",
        f"""(id, n, slot, s, e, type, value) AS (
        SELECT id, n, CAST(1 AS BIGINT), s, e, type, value FROM {prefix}candidates WHERE n = 1
        UNION ALL
        SELECT c.id, c.n, w.slot + CASE WHEN c.s >= w.e THEN 1 ELSE 0 END,
          CASE WHEN c.s >= w.e OR (c.s = w.s AND c.e > w.e) THEN c.s ELSE w.s END,
          CASE WHEN c.s >= w.e OR (c.s = w.s AND c.e > w.e) THEN c.e ELSE w.e END,
          CASE WHEN c.s >= w.e OR (c.s = w.s AND c.e > w.e) THEN c.type ELSE w.type END,
          CASE WHEN c.s >= w.e OR (c.s = w.s AND c.e > w.e) THEN c.value ELSE w.value END
        FROM {prefix}walk w JOIN {prefix}candidates c ON c.id = w.id AND c.n = w.n + 1)""",
        [f"{prefix}candidates"],
    )
    _piece(
        f"{prefix}kept",
        f"""SELECT id, slot, s, e, type, value FROM {prefix}walk
        QUALIFY row_number() OVER (PARTITION BY id, slot ORDER BY n DESC) = 1""",
        [f"{prefix}walk"],
    )
    _piece(
        f"{prefix}redacted",
        f"""SELECT t.id, k.body IS NOT NULL AS detected,
        CASE WHEN k.body IS NULL THEN text ELSE body || substring(text, last + 1) END AS redacted
        FROM {table} t LEFT JOIN (SELECT id, max(e) AS last,
            string_agg(substring(text, before + 1, s - before) || '[' || upper(type) || ']', ''
              ORDER BY s) AS body
          FROM (SELECT k.*, t.text, lag(e, 1, 0) OVER (PARTITION BY id ORDER BY s) AS before
            FROM {prefix}kept k JOIN {table} t USING (id)) GROUP BY id) k USING (id)""",
        [f"{prefix}kept", table],
    )
    kinds = dict(P.PII_RE2)
    pii = [
        ("ssn", kinds["ssn"], False),
        ("email", kinds["email"], False),
        ("credit_card", P.CARD_RE2, True),
        ("phone", kinds["phone_us"], False),
    ]
    _piece(
        f"{prefix}pii",
        " UNION ALL ".join(
            f"""SELECT id, 'pii' AS category, '{name}' AS type, '{P.PII_SEVERITY[name]}' AS severity,
            s, e FROM ({_spans(table, pattern, luhn)})"""
            for name, pattern, luhn in pii
        ),
        [table],
    )
    _piece(
        f"{prefix}phi",
        f"""SELECT id, 'phi' AS category, 'phi_' || type AS type, 'critical' AS severity, s, e
        FROM {prefix}pii JOIN {table} USING (id)
        WHERE regexp_matches(lower(text), '{P.MEDICAL_RE}')""",
        [f"{prefix}pii", table],
    )
    _piece(
        f"{prefix}secrets",
        " UNION ALL ".join(
            f"""SELECT id, 'secrets' AS category, '{name}' AS type, '{severity}' AS severity, s, e
            FROM ({_spans(table, pattern)})"""
            for name, pattern, severity in P.SECRETS_RE2
        ),
        [table],
    )
    _piece(
        f"{prefix}financial",
        f"""SELECT id, 'financial' AS category, 'credit_card' AS type, 'critical' AS severity, s, e
        FROM ({_spans(table, P.CARD_RE2, True)}) UNION ALL
        SELECT id, 'financial', 'iban', 'high', s, e FROM ({_spans(table, P.IBAN_RE2)})""",
        [table],
    )
    parts = [f"{prefix}{c}" for c in ("pii", "phi", "secrets", "financial")]
    _piece(
        f"{prefix}found", " UNION ALL ".join(f"SELECT * FROM {p}" for p in parts), parts
    )


_content("docs")
_content("messages", "msg_")
_piece("html", "SELECT page_id AS id, html AS text FROM pages")
_content("html", "html_")

for _name, _pattern in P.PII_RE2:
    check(
        f"detect_{_name}",
        ["docs"],
        f"""SELECT id AS doc_id, value, s AS start, e AS "end"
        FROM ({_spans('docs', _pattern, _name.startswith('credit_card_'))})""",
    )
_VIOLATION = 'SELECT id AS doc_id, category, type, severity, s AS start, e AS "end" FROM {0}'
for _name, _, _ in P.SECRETS_RE2:
    check(f"secret_{_name}", ["secrets"], _VIOLATION.format("secrets") + f" WHERE type = '{_name}'")
for _name in ("credit_card", "iban"):
    check(
        f"financial_{_name}",
        ["financial"],
        _VIOLATION.format("financial") + f" WHERE type = '{_name}'",
    )
for _name, _source in (
    ("pii_violations", "pii"),
    ("phi_violations", "phi"),
    ("secret_violations", "secrets"),
    ("financial_violations", "financial"),
    ("full_scan", "found"),
    ("full_scan_secrets_only", "secrets"),
):
    check(_name, [_source], _VIOLATION.format(_source))
check(
    "full_scan_categories",
    ["found", "docs"],
    """SELECT d.id AS doc_id, c.categories IS NOT NULL AS detected,
    coalesce(c.categories, '') AS categories FROM docs d LEFT JOIN (
      SELECT id, string_agg(category, ',' ORDER BY list_position(
        ['pii', 'phi', 'secrets', 'financial'], category)) AS categories
      FROM (SELECT DISTINCT id, category FROM found) GROUP BY id) c USING (id)""",
)
CHECKS["luhn_check"] = f"""
SELECT o_orderkey, number, {_luhn('number')} AS valid FROM (
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0
  THEN d[1:4] || '-' || d[5:8] || '-' || d[9:12] || '-' || d[13:16]
  WHEN o_orderkey % 7 = 0 THEN d[1:12] ELSE d END AS number
FROM (SELECT o_orderkey, '4' || lpad(CAST(o_orderkey * 104729 AS VARCHAR), 15, '0') AS d
  FROM orders))"""
check(
    "match_spans_html",
    ["html"],
    f"""SELECT id AS page_id, count(*) AS tags, CAST(sum(s) AS BIGINT) AS starts,
    CAST(sum(e) AS BIGINT) AS ends, max(value) AS last_value
    FROM ({_spans('html', '<[a-z]+[^<>]*>')}) GROUP BY 1""",
)
check("pii_entities", ["kept"],
      'SELECT id AS doc_id, type, value, s AS start, e AS "end" FROM kept')
check("pii_entities_pages", ["html_kept"],
      'SELECT id AS page_id, type, value, s AS start, e AS "end" FROM html_kept')
check("pii_redacted", ["redacted"],
      "SELECT id AS doc_id, detected, redacted AS redacted_text FROM redacted")
check(
    "pii_summary",
    ["kept"],
    """SELECT type, count(*) AS entities, count(DISTINCT id) AS documents FROM kept GROUP BY 1""",
)

# Governance ----------------------------------------------------------------------------------

_piece(
    "gated",
    """SELECT m.id, request_id, msg_index, r.detected, r.redacted,
    CASE WHEN r.detected THEN coalesce(v.n, 0) ELSE 0 END AS violations
    FROM messages m JOIN msg_redacted r USING (id)
    LEFT JOIN (SELECT id, count(*) AS n FROM msg_found GROUP BY 1) v USING (id)""",
    ["messages", "msg_redacted", "msg_found"],
)
_GATE = """SELECT request_id, msg_index, violations > 0 AS blocked,
    CAST(violations AS INTEGER) AS violations,
    CASE WHEN violations > 0 THEN redacted END AS redacted_text FROM gated"""
check("privacy_gate", ["gated"], _GATE)
check("stream_scan", ["gated"], _GATE)
check(
    "policy_gate",
    ["gated"],
    """SELECT request_id, msg_index, detected, NOT detected OR id % 5 = 0 OR id % 3 <> 0 AS is_allowed,
    CASE WHEN detected AND id % 5 <> 0 AND id % 3 = 0 THEN 'block' END AS action,
    detected AND id % 5 <> 0 AND id % 3 = 0 AS blocked,
    CASE WHEN detected AND id % 5 <> 0 AND id % 3 = 0
      THEN CASE WHEN id % 2 = 0 THEN '(withheld)' ELSE redacted END END AS redacted_text
    FROM gated""",
)
_piece(
    "first_blocked",
    """SELECT * FROM gated WHERE violations > 0
    QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY msg_index) = 1""",
    ["gated"],
)
check(
    "first_blocking_message",
    ["first_blocked"],
    """SELECT request_id, msg_index, CAST(violations AS INTEGER) AS violations,
    redacted AS redacted_text FROM first_blocked""",
)
_piece(
    "signals",
    """SELECT request_id, 'org-1' AS organization_id, category AS violation_type,
    type AS violation_subtype, severity,
    CASE WHEN request_id % 2 = 0 THEN 'production' ELSE 'staging' END AS environment,
    'block' AS action_taken, false AS was_allowed, 'metadata_only' AS source,
    CAST(1 AS BIGINT) AS violation_count
    FROM first_blocked JOIN msg_found USING (id)""",
    ["first_blocked", "msg_found"],
)
for _name in ("governance_signals", "stream_signals"):
    check(_name, ["signals"], "SELECT * FROM signals")
check(
    "signal_rollup",
    ["signals"],
    """SELECT violation_type, violation_subtype, severity, environment, count(*) AS violations
    FROM signals GROUP BY ALL""",
)
check(
    "write_signals",
    ["signals"],
    """SELECT violation_type, violation_subtype, severity, source, count(*) AS violations
    FROM signals GROUP BY ALL""",
)

# Rates ---------------------------------------------------------------------------------------

# Levels in whole units: 10,000 units per token-microsecond part, as the rates have 4 decimals.
_UNIT = 10**10
_AUDIT_FILL = int(float(AUDIT_RATE) * 10**4)
_AUDIT_FULL = AUDIT_BURST * _UNIT
_piece(
    "arrivals",
    """SELECT call_id, feature, CAST(epoch_us(ts) AS HUGEINT) AS us,
    row_number() OVER (PARTITION BY feature ORDER BY ts, call_id) AS n FROM usage_calls""",
    ["usage_calls"],
)
_piece(
    "audit",
    f"""(feature, call_id, n, us, level) AS (
    SELECT feature, call_id, n, us, CAST({_AUDIT_FULL} AS HUGEINT) FROM arrivals WHERE n = 1
    UNION ALL
    SELECT a.feature, a.call_id, a.n, a.us,
      least(CAST({_AUDIT_FULL} AS HUGEINT), CASE WHEN p.level >= {_UNIT} THEN p.level - {_UNIT}
        ELSE p.level END + (a.us - p.us) * {_AUDIT_FILL})
    FROM audit p JOIN arrivals a ON a.feature = p.feature AND a.n = p.n + 1)""",
    ["arrivals"],
)
_AUDIT = f"""call_id, feature, CAST(level AS DOUBLE) / {_UNIT} AS tokens_before,
    level >= {_UNIT} AS allowed"""
_piece(
    "stream_arrivals",
    f"""SELECT call_id, feature, CAST(epoch_us(ts) AS HUGEINT) AS us,
    row_number() OVER (PARTITION BY feature ORDER BY call_id % {I.PARTS}, ts, call_id) AS n
    FROM usage_calls""",
    ["usage_calls"],
)
_piece(  # a call that comes late earns nothing and does not move the clock back
    "stream_audit",
    f"""(feature, call_id, n, us, level) AS (
    SELECT feature, call_id, n, us, CAST({_AUDIT_FULL} AS HUGEINT) FROM stream_arrivals WHERE n = 1
    UNION ALL
    SELECT a.feature, a.call_id, a.n, greatest(a.us, p.us),
      least(CAST({_AUDIT_FULL} AS HUGEINT), CASE WHEN p.level >= {_UNIT} THEN p.level - {_UNIT}
        ELSE p.level END + greatest(0, a.us - p.us) * {_AUDIT_FILL})
    FROM stream_audit p JOIN stream_arrivals a ON a.feature = p.feature AND a.n = p.n + 1)""",
    ["stream_arrivals"],
)
for _name, _source in (("rate_audit", "audit"), ("stream_rate_audit", "stream_audit")):
    check(
        _name,
        [_source],
        f"""SELECT {_AUDIT}, CASE WHEN level < {_UNIT} THEN
          CAST(({_UNIT} - level + {_AUDIT_FILL * 10**6 - 1}) // {_AUDIT_FILL * 10**6} AS BIGINT) END
          AS retry_after_s FROM {_source}""",
    )
# Ten a minute, burst 1: a token is 6,000,000 units, one of which comes each microsecond.
_piece(
    "minute_arrivals",
    """SELECT call_id, CAST(epoch_us(ts) AS HUGEINT) AS us,
    row_number() OVER (ORDER BY ts, call_id) AS n FROM usage_calls""",
    ["usage_calls"],
)
_piece(
    "minute_audit",
    """(call_id, n, us, level) AS (
    SELECT call_id, n, us, CAST(6000000 AS HUGEINT) FROM minute_arrivals WHERE n = 1
    UNION ALL
    SELECT a.call_id, a.n, a.us, least(CAST(6000000 AS HUGEINT),
      CASE WHEN p.level >= 6000000 THEN p.level - 6000000 ELSE p.level END + (a.us - p.us))
    FROM minute_audit p JOIN minute_arrivals a ON a.n = p.n + 1)""",
    ["minute_arrivals"],
)
check(
    "rate_audit_per_minute",
    ["minute_audit"],
    """SELECT call_id, CAST(level AS DOUBLE) / 6000000 AS tokens_before, level >= 6000000 AS allowed,
    CASE WHEN level < 6000000 THEN CAST((6000000 - level + 999999) // 1000000 AS BIGINT) END
      AS retry_after_s FROM minute_audit""",
)
_QUEUE_FILL = int(float(QUEUE_RATE) * 10**4 + 0.5)


def _wait(key):
    due = f"CAST(epoch_us(ts) AS HUGEINT) * {_QUEUE_FILL}"
    return f"""SELECT *, CAST(greatest(0, n * {_UNIT} + max(due - (n - 1) * {_UNIT}) OVER (
      PARTITION BY {key} ORDER BY n ROWS UNBOUNDED PRECEDING) - due - {QUEUE_BURST * _UNIT})
      AS DOUBLE) / {_QUEUE_FILL * 10**6} AS wait_s
    FROM (SELECT *, {due} AS due, row_number() OVER (PARTITION BY {key} ORDER BY ts, call_id) AS n
      FROM usage_calls)"""


check(
    "queue_delay",
    ["usage_calls"],
    f"SELECT call_id, feature, wait_s FROM ({_wait('feature')})",
)

# Streams -------------------------------------------------------------------------------------

for _name, _unit in (
    ("stream_spend", "day"),
    ("stream_spend_weekly", "week"),
    ("stream_spend_monthly", "month"),
):
    check(
        _name,
        ["costed"],
        f"""SELECT feature, CAST(epoch(date_trunc('{_unit}', ts)) AS BIGINT) AS start_s,
        CAST(sum(CAST(cost_usd AS {MONEY})) AS DOUBLE) AS spend_usd, count(*) AS calls
        FROM costed GROUP BY ALL""",
    )

# The whole path ------------------------------------------------------------------------------

_piece(
    "half_policies",
    "SELECT * REPLACE (budget_amount_usd / 2 AS budget_amount_usd) FROM policies",
    ["policies"],
)
_STOPPED = {
    "admission_report": "SELECT request_id, 'content_blocked' AS content FROM first_blocked",
    # Standard mode: hits follow their verdict, which every fifth message lacks.
    "admission_report_standard": """SELECT DISTINCT request_id, 'content_blocked' AS content
      FROM gated WHERE detected AND id % 5 <> 0 AND id % 3 = 0""",
    "admission_report_strict": """SELECT request_id, CASE WHEN id % 5 = 0 THEN 'content_error'
      ELSE 'content_blocked' END AS content FROM gated WHERE detected AND (id % 5 = 0 OR id % 3 = 0)
      QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY msg_index) = 1""",
}
_piece("waits", _wait("org_id"), ["usage_calls"])
for _name, _stops in _STOPPED.items():
    _tag = _name.replace("admission_report", "path")
    _piece(f"{_tag}_stopped", _stops, ["gated", "first_blocked"])
    _piece(
        f"{_tag}_open",
        f"SELECT * FROM costed WHERE request_id NOT IN (SELECT request_id FROM {_tag}_stopped)",
        ["costed", f"{_tag}_stopped"],
    )
    _piece(
        f"{_tag}_matched",
        _matched("half_policies").format(calls=f"{_tag}_open"),
        ["half_policies", f"{_tag}_open"],
    )
    _piece(
        f"{_tag}_refused",
        f"SELECT call_id FROM ({_verdicts(f'{_tag}_matched')}) WHERE strictest = 3",
        [f"{_tag}_matched"],
    )
    _piece(
        f"{_tag}_steps",
        f"""SELECT c.session_id, c.call_id, l.n, CAST(cost_usd AS {MONEY}) AS cost,
        CAST(estimated_cost_usd AS {MONEY}) AS estimate,
        content IS NULL AND r.call_id IS NULL AS eligible, {_LIMITS},
        content, r.call_id IS NOT NULL AS budget_blocked, c.cost_usd
        FROM costed c LEFT JOIN (SELECT call_id, n FROM ledger) l USING (call_id)
        LEFT JOIN {_tag}_stopped s ON s.request_id = c.request_id
        LEFT JOIN {_tag}_refused r USING (call_id)""",
        ["costed", "ledger", f"{_tag}_stopped", f"{_tag}_refused"],
    )
    _piece(
        f"{_tag}_replay",
        _replay(f"{_tag}_steps").replace("FROM replay r", f"FROM {_tag}_replay r"),
        [f"{_tag}_steps"],
    )
    check(
        _name,
        [f"{_tag}_replay", "waits"],
        f"""SELECT call_id, s.session_id, wait_s,
        CASE WHEN content IS NOT NULL THEN content WHEN budget_blocked THEN 'budget_blocked'
          WHEN coalesce(verdict, 'ok') = 'ok' THEN 'executed' ELSE 'session_' || verdict END
          AS outcome,
        CASE WHEN eligible AND coalesce(verdict, 'ok') = 'ok' THEN cost_usd ELSE 0.0::DOUBLE END
          AS cost_usd
        FROM {_tag}_steps s LEFT JOIN (SELECT call_id, verdict FROM {_tag}_replay) r USING (call_id)
        JOIN (SELECT call_id, wait_s FROM waits) USING (call_id)""",
    )

for _name, (_needs, _sql) in _WAITING.items():
    CHECKS[_name] = _with(_needs, _sql)
# Streams that end in what the batch job gives.
CHECKS["stream_budget_state"] = CHECKS["apply_spend"]
CHECKS["stream_cost_discrepancy"] = CHECKS["cost_discrepancy"]
