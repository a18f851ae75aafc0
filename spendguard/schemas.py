"""Column names and types of the tables the jobs read and write."""

from pyspark.sql import types as T

# Dollars of one row, and sums of them. The widths leave Spark room to add and subtract without
# giving up decimals: at the full 38 digits it would round the last one away.
MONEY = T.DecimalType(26, 12)
TOTAL = T.DecimalType(36, 12)

# The allowed words of the enumerated columns.
PROVIDERS = ["openai", "anthropic", "google", "aws_bedrock", "cohere", "mistral"]
BUDGET_ACTIONS = ["alert", "throttle", "block"]
BUDGET_SCOPES = ["organization", "feature", "environment", "custom"]
BUDGET_PERIODS = ["daily", "weekly", "monthly", "custom"]

USAGE = T.StructType(
    [
        T.StructField("call_id", T.LongType()),
        T.StructField("api_key", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("provider", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("feature", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("input_tokens", T.LongType()),
        T.StructField("output_tokens", T.LongType()),
        T.StructField("cache_creation_tokens", T.LongType()),
        T.StructField("cache_read_tokens", T.LongType()),
        T.StructField("latency_ms", T.LongType()),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
        T.StructField("org_id", T.StringType()),
        T.StructField("environment", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("request_id", T.LongType()),
    ]
)

PRICING = T.StructType(
    [
        T.StructField("provider", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("input_cost_per_1k", T.DoubleType()),
        T.StructField("output_cost_per_1k", T.DoubleType()),
        T.StructField("cache_creation_cost_per_1k", T.DoubleType()),
        T.StructField("cache_read_cost_per_1k", T.DoubleType()),
    ]
)

POLICIES = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("org_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("scope", T.StringType()),
        T.StructField("scope_identifier", T.StringType()),
        T.StructField("budget_amount_usd", T.DoubleType()),
        T.StructField("period", T.StringType()),
        T.StructField("custom_period_days", T.IntegerType()),
        T.StructField("action", T.StringType()),
        T.StructField("throttle_percentage", T.DoubleType()),
        T.StructField("alert_thresholds", T.ArrayType(T.IntegerType())),
        T.StructField("current_spend_usd", T.DoubleType()),
        T.StructField("spend_percentage", T.DoubleType()),
        T.StructField("period_start", T.TimestampType()),
        T.StructField("is_active", T.BooleanType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

SESSIONS = T.StructType(
    [
        T.StructField("session_id", T.StringType()),
        T.StructField("server_session_id", T.StringType()),
        T.StructField("feature", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("max_spend_usd", T.DoubleType()),
        T.StructField("max_iterations", T.LongType()),
        T.StructField("status", T.StringType()),
    ]
)

SIGNALS = T.StructType(
    [
        T.StructField("organization_id", T.StringType()),
        T.StructField("violation_type", T.StringType()),
        T.StructField("violation_subtype", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("feature", T.StringType()),
        T.StructField("environment", T.StringType()),
        T.StructField("action_taken", T.StringType()),
        T.StructField("was_allowed", T.BooleanType()),
        T.StructField("detected_at", T.TimestampType()),
        T.StructField("source", T.StringType()),
        T.StructField("violation_count", T.LongType()),
    ]
)

SESSION_CALLS = T.StructType(
    [
        T.StructField("session_id", T.StringType()),
        T.StructField("call_id", T.LongType()),
        T.StructField("call_sequence", T.LongType()),
        T.StructField("call_type", T.StringType()),
        T.StructField("tool_name", T.StringType()),
        T.StructField("input_tokens", T.LongType()),
        T.StructField("output_tokens", T.LongType()),
        T.StructField("cumulative_input_tokens", T.LongType()),
        T.StructField("cost_usd", T.DoubleType()),
        T.StructField("cumulative_cost_usd", TOTAL),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("pii_detected", T.BooleanType()),
    ]
)

SESSION_CLOSURES = T.StructType(
    [
        T.StructField("session_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("termination_reason", T.StringType()),
        T.StructField("final_spend_usd", TOTAL),
        T.StructField("final_iteration_count", T.LongType()),
    ]
)
