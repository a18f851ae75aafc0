"""Content gates over messages, and the governance signals they raise.

Messages are rows (request_id, msg_index, text). All gates are narrow projections.
"""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import content as C
from ..functions.content import CATEGORIES, full_scan, gate, scan
from ..functions.spans import bind, kept_if
from ..runtime import checkpointed
from .budgets import fail_open_defaults
from .keyfilter import key_filter


def scan_text(df: DataFrame, text: str = "text") -> DataFrame:
    """Add detected, entities and redacted_text."""
    return df.withColumn("_scan", scan(F.col(text))).select(*df.columns, "_scan.*")


def classify_text(df: DataFrame, text: str = "text", categories=CATEGORIES) -> DataFrame:
    """Add detected, violations and categories."""
    found = full_scan(F.col(text), categories)
    return df.withColumn("_found", found).select(*df.columns, "_found.*")


def entities(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """One row per entity. The explode drops clean texts, so no filter repeats the scan."""
    return df.select(*keys, F.inline(C.entities(F.col(text))))


def violations(df: DataFrame, keys: list[str], found: Column) -> DataFrame:
    """One row per violation; ``found`` is any of the violation columns."""
    return df.select(*keys, F.inline(found))


def pii_summary(df: DataFrame, text: str = "text") -> DataFrame:
    """Documents and entities per type, one input row per document.

    Each row yields its counts per type, which add up before the shuffle.
    """

    def counts(types):
        return F.transform(
            F.array_distinct(types),
            lambda kind: F.struct(
                kind.alias("type"), F.size(F.filter(types, lambda t: t == kind)).alias("n")
            ),
        )

    types = F.transform(C.entities(F.col(text)), lambda e: e["type"])
    return (
        df.select(F.inline(bind(types, counts)))
        .groupBy("type")
        .agg(F.sum("n").alias("entities"), F.count(F.lit(1)).alias("documents"))
    )


def privacy_gate(messages: DataFrame) -> DataFrame:
    """Metadata-only mode: block when the scan and the full classification both hit.

    Adds blocked, violations and, for blocked messages, redacted_text. A secret or account number
    alone passes, since only personal-data patterns trigger the classification.
    """
    judged = messages.withColumn("_gate", gate(F.col("text")))
    return judged.select(*messages.columns, "_gate.*")


def blocked_messages(messages: DataFrame, keys=("request_id", "msg_index")) -> DataFrame:
    """Only the messages the privacy gate blocks, with their violations and redacted text."""
    passed = kept_if(gate(F.col("text")), lambda g: g["blocked"])
    return messages.select(*keys, passed).drop("blocked")


def blocked_requests(messages: DataFrame) -> DataFrame:
    """The ids of requests with at least one blocked message."""
    text = F.col("text")
    hit = F.when(C.detected(text), F.size(full_scan(text)["violations"]) > 0).otherwise(F.lit(False))
    flag = F.struct(hit.alias("hit"))
    return messages.select("request_id", kept_if(flag, lambda f: f["hit"])).select(
        "request_id"
    ).distinct()


def judged_requests(messages: DataFrame, verdicts: DataFrame, fail_open: bool = True) -> DataFrame:
    """Requests that standard mode stops, with ``content``: ``content_blocked`` or ``content_error``.

    Messages are judged in order and the first one that stops its request says why. Only the keys
    of hits are joined with the verdicts' keys.
    """
    keys = ["request_id", "msg_index"]
    hit = F.struct(C.detected(F.col("text")).alias("hit"))
    hits = messages.select(*keys, kept_if(hit, lambda f: f["hit"])).drop("hit")
    judged = hits.join(verdicts.select(*keys, "is_allowed", F.lit(True).alias("_found")), keys, "left")
    refused = F.col("_found") & ~F.coalesce("is_allowed", F.lit(True))
    why = F.when(refused, "content_blocked")
    if not fail_open:
        why = why.when(F.col("_found").isNull(), "content_error")
    first = F.min(F.struct("msg_index", "content")).alias("_first")
    stopped = judged.withColumn("content", why).where("content IS NOT NULL")
    return stopped.groupBy("request_id").agg(first).select("request_id", "_first.content")


def policy_gate(
    messages: DataFrame, verdicts: DataFrame, keys=("request_id", "msg_index"), fail_open=True
) -> DataFrame:
    """Standard mode: messages the scan hits follow an external verdict.

    ``verdicts`` has the keys, is_allowed, action, violations and redacted_text. A missing
    verdict allows the message when failing open and marks it as ``error`` otherwise. Only hits
    are joined; clean messages, most of them, stay where they are and have no verdict.
    """
    text, columns = F.col("text"), messages.columns
    none = {f.name: F.lit(None).cast(f.dataType) for f in verdicts.schema if f.name not in keys}
    # The clean branch needs no spans or redaction; the other does that work for hits.
    hit = F.struct(C.detected(text).alias("detected"))
    clean = messages.select(*columns, kept_if(hit, lambda s: ~s["detected"]))
    found = kept_if(scan(text), lambda s: s["detected"])
    hits = messages.select(*columns, found).drop("entities")
    renamed = verdicts.withColumnRenamed("redacted_text", "_verdict_text")
    judged = fail_open_defaults(hits, renamed, list(keys), "scan", fail_open)
    blocked = ~F.coalesce(F.col("is_allowed"), F.lit(True))
    redacted = F.coalesce("_verdict_text", F.col("redacted_text"))
    judged = judged.withColumns({"blocked": blocked, "redacted_text": F.when(blocked, redacted)})
    allowed = {"is_allowed": F.lit(True)} if fail_open else {"error": F.lit(False)}
    added = none | allowed | {"blocked": F.lit(False), "redacted_text": F.lit(None).cast("string")}
    return judged.drop("_verdict_text").unionByName(clean.withColumns(added))


def message_violations(messages: DataFrame, keys=("request_id", "msg_index")) -> DataFrame:
    """The messages the privacy gate blocks, with their violations and without any text."""
    passed = kept_if(gate(F.col("text"), redacted=False), lambda g: g["blocked"])
    return messages.select(*keys, passed).drop("blocked")


def first_violations(messages: DataFrame) -> DataFrame:
    """Of each request the first blocked message, with its violations and without any text.

    The minimum combines before the shuffle, so a request of any length stays cheap.
    """
    found = message_violations(messages)
    first = found.groupBy("request_id").agg(F.min("msg_index").alias("msg_index"))
    return found.join(first, ["request_id", "msg_index"], "left_semi")


def first_blocking_message(messages: DataFrame) -> DataFrame:
    """The first blocked message of each request; later ones are never redacted.

    Which message it is follows from keys alone. They come back to the texts as a filter of a few
    bits a request, which picks the rows where they are scanned: no text is shuffled or joined.
    Only if the requests are too many for an exact filter (16 million), redacted texts that it lets
    through are joined with the keys. Messages without a key belong to no request.
    """
    names = ["request_id", "msg_index"]
    hit = F.struct(gate(F.col("text"), redacted=False)["blocked"].alias("hit"))
    keys = messages.select(*names, kept_if(hit, lambda f: f["hit"])).drop("hit").na.drop()
    keys = checkpointed(keys.distinct())
    first = keys.groupBy("request_id").agg(F.min("msg_index").alias("_first"))
    first = checkpointed(keys.join(first, "request_id").select(*names, (F.col("msg_index") == F.col("_first")).alias("_won")))
    winners = first.where("_won").drop("_won")
    picked = key_filter(winners, first.where("NOT _won").drop("_won"))
    known = F.col("request_id").isNotNull() & F.col("msg_index").isNotNull()
    blocked = blocked_messages(messages.where(known & picked.test(*[F.col(n) for n in names])))
    return blocked if picked.exact else blocked.join(winners, names, "left_semi")


def governance_signals(
    blocked: DataFrame, organization_id: Column, environment: Column, detected_at: Column,
    keys=("request_id",),
) -> DataFrame:
    """One signal per violation of a blocked message. Carries no text."""
    found = blocked.select(
        *keys,
        organization_id.alias("organization_id"),
        environment.alias("environment"),
        detected_at.alias("detected_at"),
        F.inline("violations"),
    )
    return found.select(
        *keys,
        "organization_id",
        F.col("category").alias("violation_type"),
        F.col("type").alias("violation_subtype"),
        "severity",
        F.lit(None).cast("string").alias("user_id"),
        F.lit(None).cast("string").alias("feature"),
        "environment",
        F.lit("block").alias("action_taken"),
        F.lit(False).alias("was_allowed"),
        "detected_at",
        F.lit("metadata_only").alias("source"),
        F.lit(1).cast("long").alias("violation_count"),
    )


def signal_rollup(signals: DataFrame) -> DataFrame:
    """Violations per category, subtype, severity and environment."""
    dims = ["violation_type", "violation_subtype", "severity", "environment"]
    return signals.groupBy(*dims).agg(F.sum("violation_count").alias("violations"))
