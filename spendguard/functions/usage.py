"""Token counts and message texts out of provider payloads, as columns over JSON text."""

from pyspark.sql import Column, functions as F

from .spans import bind

# One schema for the three response shapes, so each payload is parsed once.
RESPONSE_DDL = """
usage struct<
  prompt_tokens: bigint, completion_tokens: bigint,
  prompt_tokens_details: struct<cached_tokens: bigint>,
  input_tokens: bigint, output_tokens: bigint,
  cache_creation_input_tokens: bigint, cache_read_input_tokens: bigint>,
response struct<usageMetadata: struct<
  promptTokenCount: bigint, candidatesTokenCount: bigint, cachedContentTokenCount: bigint>>
"""

COUNTERS = ["input_tokens", "output_tokens", "cache_creation_tokens", "cache_read_tokens"]


def parse_response(payload: Column) -> Column:
    return F.from_json(payload, RESPONSE_DDL)


def _zero(count: Column) -> Column:
    return F.coalesce(count, F.lit(0).cast("long"))


def _usage(total, output, creation, read) -> Column:
    return F.struct(
        total.alias("input_tokens"),
        output.alias("output_tokens"),
        creation.alias("cache_creation_tokens"),
        read.alias("cache_read_tokens"),
    )


def _none_read() -> Column:
    return F.lit(0).cast("long")


def usage_openai(parsed: Column) -> Column:
    """Cached prompt tokens are taken out of the input count, which stops at zero."""
    usage = parsed["usage"]
    cached = _zero(usage["prompt_tokens_details"]["cached_tokens"])
    fresh = F.greatest(_none_read(), _zero(usage["prompt_tokens"]) - cached)
    return _usage(fresh, _zero(usage["completion_tokens"]), _none_read(), cached)


def usage_anthropic(parsed: Column) -> Column:
    """Counters as reported: the input count does not include cached tokens."""
    usage = parsed["usage"]
    return _usage(
        _zero(usage["input_tokens"]),
        _zero(usage["output_tokens"]),
        _zero(usage["cache_creation_input_tokens"]),
        _zero(usage["cache_read_input_tokens"]),
    )


def usage_google(parsed: Column) -> Column:
    """Cached content is taken out of the prompt count, which stops at zero."""
    usage = parsed["response"]["usageMetadata"]
    cached = _zero(usage["cachedContentTokenCount"])
    fresh = F.greatest(_none_read(), _zero(usage["promptTokenCount"]) - cached)
    return _usage(fresh, _zero(usage["candidatesTokenCount"]), _none_read(), cached)


def detect_provider(parsed: Column) -> Column:
    """First payload shape that fits, else NULL."""
    return (
        F.when(parsed["usage"]["prompt_tokens"].isNotNull(), F.lit("openai"))
        .when(parsed["usage"]["input_tokens"].isNotNull(), F.lit("anthropic"))
        .when(parsed["response"]["usageMetadata"].isNotNull(), F.lit("google"))
    )


def extract_usage(provider: Column, parsed: Column) -> Column:
    """Usage struct by provider name; NULL for a provider without an extractor."""
    return (
        F.when(provider == "openai", usage_openai(parsed))
        .when(provider == "anthropic", usage_anthropic(parsed))
        .when(provider == "google", usage_google(parsed))
    )


SUPPORTED = ("openai", "anthropic", "google")


def usage_record(provider: Column, payload: Column) -> Column:
    """struct(provider, usage): the named or else detected provider; the payload is parsed once."""

    def named(parsed):
        return bind(
            F.coalesce(provider, detect_provider(parsed)),
            lambda name: F.struct(
                name.alias("provider"), extract_usage(name, parsed).alias("usage")
            ),
        )

    return bind(parse_response(payload), named)


def nullify_zero(count: Column) -> Column:
    """A zero cache counter is stored as missing."""
    return F.nullif(count, F.lit(0))


def message_text(provider: Column, content: Column) -> Column:
    """Text to scan out of one message's VARIANT content; NULL when there is none.

    String content counts for all providers. Block arrays count for anthropic only: the blocks'
    texts, missing ones empty, joined by one space.
    """
    kind = F.schema_of_variant(content)
    plain = F.try_variant_get(content, "$", "string")
    blocks = F.try_variant_get(content, "$", "array<variant>")
    joined = F.array_join(
        F.transform(
            blocks, lambda b: F.coalesce(F.try_variant_get(b, "$.text", "string"), F.lit(""))
        ),
        " ",
    )
    text = F.when(kind == "STRING", plain).when(
        (provider == "anthropic") & kind.startswith("ARRAY"), joined
    )
    return F.when((provider == "anthropic") & (text == ""), F.lit(None)).otherwise(text)
