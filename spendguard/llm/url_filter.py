"""URL filter: host and path rules, and a list of canonical URLs behind a blocked Bloom filter.

The list is turned into a Bloom filter of 256-bit blocks: a URL picks one block by its hash and one bit in each of the
block's four words. The filter is a table of at most ``max_blocks`` rows, a bound that does not depend on the data, so
it is broadcast; with more listed URLs than it has room for it lets more through and answers stay right. Pages that it
lets through go to an exact hash join with the list, which removes the false positives. A URL that a third of all
pages share is dealt over ``SALTS`` tasks there, and adaptive execution may split those further.

Defined cases: a URL that is null or lacks ``://`` has an empty host and path, fits no rule and is not listed.
Repeated pages give repeated rows. Of rules of equal length the one with the longer host wins. Extra columns of the
inputs are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendguard.llm.common import ascii_lower, salted, with_salt
from spendguard.runtime import checkpointed

SALTS = 8
BITS_PER_URL = 16
MAX_BLOCKS = 1 << 18

#: Query parameters that do not change what a URL shows.
TRACKING = "^(utm_[^=]*|ref)(=|$)"


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, url.substr(at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z in lower case."""
    return F.coalesce(ascii_lower(F.regexp_extract(_rest(url), "^([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """One spelling of a URL: no scheme, ``www.``, closing slashes, fragment or tracking parameters; the other
    parameters sorted. Null where there is no host."""
    host = F.regexp_replace(host_of(url), r"^www\.", "")
    query = F.coalesce(F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1), F.lit(""))
    kept = F.array_sort(F.filter(F.split(query, "&", -1), lambda p: (p != "") & ~p.rlike(TRACKING)))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(host != "", F.concat(host, F.regexp_replace(path_of(url), "/+$", ""), tail))


def _longest(rules: list[tuple[str, str, str]], host: Column, path: Column, part: int) -> Column:
    """``part`` of the longest rule that fits, or null."""

    def add(rest: Column, rule: tuple[str, str, str]) -> Column:
        of, start, _ = rule
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(start)
        return F.when(fits, F.lit((of + start, rule[2])[part])).otherwise(rest)

    shortest_first = sorted(rules, key=lambda r: (len(r[0] + r[1]), len(r[0])))
    return reduce(add, shortest_first, F.lit(None).cast("string"))


def _block(key: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(key), blocks)


def _masks(key: Column) -> list[Column]:
    """One bit in each of four words, from a second hash."""
    second = F.xxhash64(F.lit("bits"), key)
    pick = [F.shiftrightunsigned(second, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(4)]
    return [F.call_function("shiftleft", F.lit(1).cast("long"), p) for p in pick]


def bloom(listed: DataFrame, key: str, max_blocks: int = MAX_BLOCKS) -> tuple[DataFrame, int]:
    """The filter as rows ``(_block, _w0.._w3)``, and its number of blocks."""
    wanted = listed.count() * BITS_PER_URL // 256
    blocks = 16
    while blocks < min(wanted, max_blocks):
        blocks *= 2
    words = [F.bit_or(m).alias(f"_w{i}") for i, m in enumerate(_masks(F.col(key)))]
    return listed.groupBy(_block(F.col(key), F.lit(blocks)).alias("_block")).agg(*words), blocks


def is_listed(urls: DataFrame, key: str, listed: DataFrame, row: str, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """``urls`` with ``listed``: whether ``key`` is among the rows of ``listed`` (one column of the same name).

    ``row`` tells rows of one URL apart, to deal a hot URL over several tasks.
    """
    urls, listed = checkpointed(urls), checkpointed(listed.select(key).where(F.col(key).isNotNull()).distinct())
    words, blocks = bloom(listed, key, max_blocks)
    hit = reduce(lambda a, b: a & b, [F.col(f"_w{i}").bitwiseAND(m) == m for i, m in enumerate(_masks(F.col(key)))])
    probed = (
        urls.withColumn("_block", _block(F.col(key), F.lit(blocks)))
        .join(F.broadcast(words), "_block", "left")
        .withColumn("_maybe", F.col(key).isNotNull() & F.coalesce(hit, F.lit(False)))
        .drop("_block", *[f"_w{i}" for i in range(4)])
    )
    names = urls.columns
    passed = with_salt(probed.where("_maybe").select(*names), F.col(row), SALTS)
    exact = salted(listed, SALTS).withColumn("_found", F.lit(True))
    judged = passed.join(exact, [key, "_salt"], "left").select(
        *names, F.coalesce("_found", F.lit(False)).alias("listed")
    )
    return judged.unionByName(probed.where(~F.col("_maybe")).select(*names, F.lit(False).alias("listed")))


def judge_urls(
    pages: DataFrame,
    rules: list[tuple[str, str, str]],
    listed: DataFrame,
    row: str = "page_id",
    url: str = "url",
    max_blocks: int = MAX_BLOCKS,
) -> DataFrame:
    """Host, path, rule and verdict of every page.

    ``rules``: (host, start of the path, ``allow`` or ``block``); a rule holds for its host and all subdomains and the
    longest one decides. Without a rule, a page whose canonical URL is in ``listed`` (column ``canonical``) is blocked
    and any other is allowed.
    """
    parsed = pages.select(
        F.col(row),
        host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"),
        canonical(F.col(url)).alias("canonical"),
    )
    known = is_listed(parsed, "canonical", listed.select("canonical"), row, max_blocks)
    host, path = F.col("host"), F.col("path")
    by_list = F.when(F.col("listed"), "block").otherwise("allow")
    return known.select(
        row,
        "host",
        "path",
        _longest(rules, host, path, 0).alias("rule"),
        F.coalesce(_longest(rules, host, path, 1), by_list).alias("verdict"),
        "canonical",
        "listed",
    )
