"""Readers and loaders that give the jobs typed tables."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.usage import message_text
from ..schemas import POLICIES, PRICING, SESSIONS, USAGE


def read_usage(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """The call log under its declared schema; no inference pass over the files."""
    return spark.read.schema(USAGE).format(format).load(path)


def stream_usage(
    spark: SparkSession, path: str, format: str = "parquet", max_files_per_trigger: int = 100
) -> DataFrame:
    """The call log as a stream; each micro-batch reads a bounded number of files."""
    reader = spark.readStream.schema(USAGE).format(format)
    return reader.option("maxFilesPerTrigger", max_files_per_trigger).load(path)


def _typed(df: DataFrame, schema, *keep: str) -> DataFrame:
    """The schema's columns in order, cast, absent ones as NULL; then the columns to ``keep``."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ],
        *keep,
    )


def load_pricing(
    feed: DataFrame, position: str, current: DataFrame | None = None
) -> DataFrame:
    """One row per model, the last in ``position`` order; an empty feed keeps ``current``."""
    if current is not None and feed.isEmpty():
        return current
    # max_by combines before the shuffle, so repeated models do not pile up in one task.
    rates = F.struct(*[c for c in PRICING.fieldNames() if c != "model"])
    rows = _typed(feed, PRICING, position)
    last = rows.groupBy("model").agg(F.max_by(rates, position).alias("_last"))
    return last.select("model", "_last.*").select(*PRICING.fieldNames())


def load_policies(df: DataFrame) -> DataFrame:
    return _typed(df, POLICIES)


#: Equal rows that one task writes out.
COPIES = 10_000


def _name_based_id(columns: list[str], number) -> Column:
    """An id in the form of a UUID (version 3) out of a row's values and a number."""
    values = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in columns]
    h = F.md5(F.concat_ws("\x1f", *values, number.cast("string")).cast("binary"))
    variant = F.substring(F.lit("89ab"), 1, 4)
    variant = F.substr(variant, (F.conv(F.substr(h, F.lit(17), F.lit(1)), 16, 10).cast("int") % 4 + 1), F.lit(1))
    parts = [F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("3"), F.substring(h, 14, 3)),
             F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12)]
    return F.concat_ws("-", *parts)


def load_sessions(df: DataFrame) -> DataFrame:
    """Session limits; a row without a session id gets one, a new session is active.

    That id follows from the row's values, and from a count where rows are equal, so every load of
    the same rows gives the same ids, however they are partitioned or ordered. Equal rows are
    counted before they are shuffled and then written out by many tasks.
    """
    typed = _typed(df, SESSIONS).withColumn("status", F.coalesce("status", F.lit("active")))
    named = typed.where("session_id IS NOT NULL")
    rest = [c for c in typed.columns if c != "session_id"]
    equal = typed.where("session_id IS NULL").groupBy(*rest).agg(F.count(F.lit(1)).alias("_n"))
    starts = F.sequence(F.lit(1).cast("long"), F.col("_n"), F.lit(COPIES).cast("long"))
    stretches = equal.withColumn("_from", F.explode(starts)).repartition(*rest, "_from")
    last = F.least(F.col("_from") + COPIES - 1, F.col("_n"))
    each = stretches.withColumn("_k", F.explode(F.sequence("_from", last)))
    new = each.withColumn("session_id", _name_based_id(rest, F.col("_k"))).select(*typed.columns)
    return named.unionByName(new)


REQUEST_DDL = "messages array<struct<role: string, content: variant>>"


def load_messages(requests: DataFrame) -> DataFrame:
    """One row per message with text, out of request bodies.

    ``requests`` has request_id, provider and body: for openai and anthropic the JSON body with
    its message list, for google the prompt as a JSON string. Messages without text are left out.
    """
    single = F.array(
        F.struct(
            F.lit("user").alias("role"), F.try_parse_json(F.col("body")).alias("content")
        )
    )
    listed = F.from_json("body", REQUEST_DDL)["messages"]
    messages = F.when(F.col("provider") == "google", single).otherwise(listed)
    rows = requests.select(
        "request_id", "provider", F.posexplode(messages).alias("msg_index", "_message")
    )
    return rows.select(
        "request_id",
        "msg_index",
        "provider",
        F.col("_message.role").alias("role"),
        message_text(F.col("provider"), F.col("_message.content")).alias("text"),
    ).where("text IS NOT NULL")
