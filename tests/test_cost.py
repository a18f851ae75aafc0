from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from spendguard.operators import cost as K
from spendguard.operators import usage as U
from spendguard.functions.usage import parse_response, usage_anthropic, usage_google, usage_openai
from spendguard.plans import inputs as I
from spendguard.sources import tables

CALLS_DDL = """call_id long, model string, input_tokens long, output_tokens long,
cache_creation_tokens long, cache_read_tokens long"""


@pytest.mark.parametrize(
    "model, counts, cost",
    [
        ("gpt-4o", (150, 50, None, None), 0.0015),
        ("unknown-model-xyz", (1000, 1000, None, None), 0),
        ("gpt-4", (1000, 1000, None, None), 0.09),
        ("claude-sonnet-4", (1000, 1000, None, None), 0.018),
        ("gemini-1.5-flash", (10000, 5000, None, None), 0.00225),
        ("gpt-4o", (0, 0, None, None), 0),
        ("gpt-4o", (0, 0, 1000, 1000), 0.01),
        ("ours-cache-priced", (0, 0, 1000, 1000), 0.0025),
    ],
)
def test_cost(spark, model, counts, cost):
    calls = spark.createDataFrame([(1, model, *counts)], CALLS_DDL)
    row = K.with_cost(calls, I.pricing(spark)).first()
    assert row.cost_usd == pytest.approx(cost, abs=1e-15)


@pytest.mark.parametrize(
    "extract, payload, counts",
    [
        (usage_openai, '{"usage":{"prompt_tokens":150,"completion_tokens":75,"total_tokens":225}}',
         (150, 75, 0, 0)),
        (usage_openai, "{}", (0, 0, 0, 0)),
        (usage_openai, '{"usage":{"prompt_tokens":150,"completion_tokens":75,'
         '"prompt_tokens_details":{"cached_tokens":40}}}', (110, 75, 0, 40)),
        (usage_openai, '{"usage":{"prompt_tokens":10,"prompt_tokens_details":'
         '{"cached_tokens":40}}}', (0, 0, 0, 40)),
        (usage_anthropic, '{"usage":{"input_tokens":100,"output_tokens":20,'
         '"cache_creation_input_tokens":5,"cache_read_input_tokens":7}}', (100, 20, 5, 7)),
        (usage_google, '{"response":{"usageMetadata":{"promptTokenCount":100,'
         '"candidatesTokenCount":9,"cachedContentTokenCount":30}}}', (70, 9, 0, 30)),
        (usage_google, "not json", (0, 0, 0, 0)),
    ],
)
def test_extract_usage(spark, extract, payload, counts):
    df = spark.createDataFrame([(payload,)], "p string")
    assert tuple(df.select(extract(parse_response(F.col("p"))).alias("u")).first().u) == counts


def test_explicit_provider_wins_and_others_are_rejected(spark):
    rows = [
        (1, "anthropic", '{"usage":{"prompt_tokens":5,"input_tokens":3}}'),
        (2, None, '{"usage":{"prompt_tokens":5,"input_tokens":3}}'),
        (3, "cohere", '{"usage":{"prompt_tokens":5}}'),
        (4, None, "{}"),
    ]
    raw = spark.createDataFrame(rows, "call_id long, provider string, payload string")
    good, bad = U.normalise_usage(raw)
    counts = {r.call_id: (r.provider, r.input_tokens) for r in good.collect()}
    assert counts == {1: ("anthropic", 3), 2: ("openai", 5)}
    assert {r.call_id for r in bad.collect()} == {3, 4}


def test_price_feed_last_row_wins_and_empty_feed_keeps_prices(spark):
    ddl = "position long, provider string, model string, input_cost_per_1k double, " \
          "output_cost_per_1k double"
    feed = spark.createDataFrame([(1, "a", "m", 1.0, 1.0), (2, "b", "m", 2.0, 2.0)], ddl)
    kept = tables.load_pricing(feed, "position").collect()
    assert [(r.provider, r.input_cost_per_1k, r.cache_read_cost_per_1k) for r in kept] == [
        ("b", 2.0, None)
    ]
    current = I.pricing(spark)
    assert tables.load_pricing(feed.limit(0), "position", current).count() == current.count()


def test_discrepancy_needs_a_known_price_and_more_than_one_percent(spark):
    ddl = "call_id long, model string, cost_usd double"
    calls = spark.createDataFrame([(1, "m", 1.0), (2, "m", 1.0), (3, "m", 0.0), (4, "m", 1.0)], ddl)
    server = spark.createDataFrame(
        [(1, 1.02), (2, 1.009), (3, 5.0), (4, None)], "call_id long, server_cost_usd double"
    )
    out = K.cost_discrepancies(calls, server).collect()
    assert [(r.call_id, round(r.difference_pct, 6)) for r in out] == [(1, 2.0)]


def test_price_in_force(spark):
    calls = spark.createDataFrame(
        [(1, "gpt-4", 1000, 0, None, None), (2, "gpt-4", 1000, 0, None, None),
         (3, "gpt-4", 1000, 0, None, None), (4, "nope", 1000, 0, None, None)], CALLS_DDL
    )
    days = F.get(F.array(*[F.lit(d) for d in ("2023-12-31", "2024-01-01", "2024-01-15",
                                              "2024-01-20")]), F.col("call_id").cast("int") - 1)
    calls = calls.withColumn("timestamp", days.cast("timestamp"))
    out = K.with_cost_asof(calls, I.price_history(spark)).collect()
    assert {r.call_id: r.cost_usd for r in out} == {1: 0.0, 2: 0.03, 3: 0.06, 4: 0.0}


def test_messages(spark):
    bodies = [
        (1, "openai", '{"messages":[{"content":"hi"},{"content":[{"text":"a"}]},{"content":""}]}'),
        (2, "anthropic", '{"messages":[{"content":[{"text":"a"},{"type":"image"},{"text":"b"}]},'
         '{"content":""},{"content":"x"}]}'),
        (3, "google", '"prompt"'),
        (4, "google", '["not text"]'),
        (5, "openai", "broken"),
    ]
    df = spark.createDataFrame(bodies, "request_id long, provider string, body string")
    out = {(r.request_id, r.msg_index): r.text for r in tables.load_messages(df).collect()}
    assert out == {(1, 0): "hi", (1, 2): "", (2, 0): "a  b", (2, 2): "x", (3, 0): "prompt"}


def test_asof_takes_the_price_of_the_moment(spark):
    """Many versions a day, a tie, a gap before the first, an open end, and an unchanged one."""
    rates = "output_cost_per_1k double, cache_creation_cost_per_1k double, cache_read_cost_per_1k double"
    start = datetime(2024, 1, 1)
    history = [("m", start + timedelta(minutes=7 * i), float(i // 2), 0.0, None, None, i) for i in range(400)]
    history += [("m", start + timedelta(days=1), 900.0, 0.0, None, None, 1000), ("tied", start, 5.0, 0.0, None, None, 2), ("tied", start, 7.0, 0.0, None, None, 1)]
    prices = spark.createDataFrame(history, f"model string, effective_from timestamp, input_cost_per_1k double, {rates}, version long")
    at = [start + timedelta(minutes=m) for m in (-1, 0, 1, 7, 8, 14, 1439, 1440, 1441, 2800, 99999)]
    calls = [(i, m, t) for i, (m, t) in enumerate((m, t) for m in ("m", "tied", "none") for t in at)]
    table = spark.createDataFrame(calls, "call_id long, model string, timestamp timestamp").selectExpr(
        "*", "1000L AS input_tokens", "0L AS output_tokens", "NULL AS cache_creation_tokens", "NULL AS cache_read_tokens"
    )
    got = {r.call_id: r.cost_usd for r in K.with_cost_asof(table, prices, "version").collect()}
    for i, model, t in calls:
        known = [h for h in history if h[0] == model and h[1] <= t]
        assert got[i] == (max(known, key=lambda h: (h[1], h[6]))[2] if known else 0.0), (model, t)
    merged = K.price_intervals(prices, "version").where("model = 'm'").count()
    assert merged == 200 + 1  # one in two versions changes nothing
