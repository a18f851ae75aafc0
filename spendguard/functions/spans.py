"""Text spans as columns: where a pattern matches, which matches survive, and redaction."""

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from .patterns import SPACES

SPAN_DDL = (
    "array<struct<start:int,rank:int,end:int,type:string,value:string,byte_start:int,byte_end:int>>"
)


def bind(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` as a variable."""
    return F.element_at(F.transform(F.array(value), body), 1)


def kept_if(record: Column, test) -> Column:
    """Generator of the record's fields for rows that pass ``test``; other rows go.

    Unlike a filter on a computed column, which the optimiser pushes below the projection and so
    computes twice, this evaluates the record once.
    """
    return F.inline(F.filter(F.array(record), test))


def luhn_valid(text: Column) -> Column:
    """13 to 19 digits, blanks and dashes aside, that pass the checksum."""
    digits = F.regexp_replace(text, f"[{SPACES}-]", "")
    checked = F.length(digits).between(13, 19) & F.call_function("luhn_check", digits)
    return F.coalesce(checked, F.lit(False))


def no_spans() -> Column:
    return F.array().cast(SPAN_DDL)


@dataclass(frozen=True)
class Detector:
    """A named pattern; ``gate`` names a cheap test that holds whenever the pattern can match."""

    name: str
    pattern: str
    luhn: bool = False
    gate: str = ""


def spans_by_detector(text: Column, detectors: list[Detector], gates: dict[str, Column]) -> Column:
    """One array of spans per detector: code point and byte offsets, 0-based and half-open.

    Matches come from one pass per pattern. Only where there are any, the text is split as well
    and the lengths of the pieces between matches give the offsets.
    """

    def entry(rank, detector):
        hits = F.regexp_extract_all(text, F.lit(detector.pattern), F.lit(0))
        if detector.gate:
            hits = F.when(gates[detector.gate], hits)
        return F.struct(
            F.lit(rank).alias("rank"),
            F.lit(detector.name).alias("type"),
            F.lit(detector.pattern).alias("pattern"),
            F.lit(detector.luhn).alias("luhn"),
            hits.alias("hits"),
        )

    def place(found):
        pieces = F.split(text, found["pattern"], -1)
        placed = bind(pieces, lambda gaps: _offsets(found, gaps))
        return F.when(F.size(found["hits"]) > 0, placed).otherwise(no_spans())

    return F.transform(F.array(*[entry(i, d) for i, d in enumerate(detectors)]), place)


# An aggregate copies what it has gathered at every step. So spans are gathered in short blocks,
# and across blocks only little is.
BLOCK, CHUNK = 64, 1024


def _offsets(found: Column, gaps: Column) -> Column:
    """Spans of ``found`` out of the pieces between its hits, in time linear in their number."""

    def step(acc, i):
        gap, hit = F.get(gaps, i), F.get(found["hits"], i)
        start = acc["pos"] + F.length(gap)
        byte_start = acc["byte"] + F.octet_length(gap)
        end = start + F.length(hit)
        byte_end = byte_start + F.octet_length(hit)
        span = F.struct(
            start.alias("start"),
            found["rank"].alias("rank"),
            end.alias("end"),
            found["type"].alias("type"),
            hit.alias("value"),
            byte_start.alias("byte_start"),
            byte_end.alias("byte_end"),
        )
        out = F.concat(acc["out"], F.array(span))
        keep = ~found["luhn"] | luhn_valid(hit)
        return F.struct(
            end.alias("pos"),
            byte_end.alias("byte"),
            F.when(keep, out).otherwise(acc["out"]).alias("out"),
        )

    def block(number):
        """Spans of one block, counted from its own start, and its length."""
        first = number * BLOCK
        last = F.least(first + BLOCK, F.size(found["hits"])) - 1
        zero = F.struct(F.lit(0).alias("pos"), F.lit(0).alias("byte"), no_spans().alias("out"))
        return F.aggregate(F.sequence(first, last), zero, step)

    def moved(blocks):
        def lead(acc, b):
            here = F.struct(acc["pos"].alias("pos"), acc["byte"].alias("byte"))
            return F.struct(
                (acc["pos"] + b["pos"]).alias("pos"),
                (acc["byte"] + b["byte"]).alias("byte"),
                F.concat(acc["out"], F.array(here)).alias("out"),
            )

        none = F.array().cast("array<struct<pos:int,byte:int>>")
        zero = F.struct(F.lit(0).alias("pos"), F.lit(0).alias("byte"), none.alias("out"))
        starts = F.aggregate(blocks, zero, lead, lambda acc: acc["out"])

        def shift(starts):
            def each(b, i):
                at = F.get(starts, i)
                return F.transform(
                    b["out"],
                    lambda s: F.struct(
                        (s["start"] + at["pos"]).alias("start"),
                        s["rank"].alias("rank"),
                        (s["end"] + at["pos"]).alias("end"),
                        s["type"].alias("type"),
                        s["value"].alias("value"),
                        (s["byte_start"] + at["byte"]).alias("byte_start"),
                        (s["byte_end"] + at["byte"]).alias("byte_end"),
                    ),
                )

            return F.flatten(F.transform(blocks, each)).cast(SPAN_DDL)

        return bind(starts, shift)

    last = F.floor((F.size(found["hits"]) - 1) / F.lit(BLOCK)).cast("int")
    return bind(F.transform(F.sequence(F.lit(0), last), block), moved)


def match_spans(text: Column, name: str, pattern: str, luhn: bool = False) -> Column:
    """Every match of one pattern."""
    return F.element_at(spans_by_detector(text, [Detector(name, pattern, luhn)], {}), 1)


def remove_overlaps(spans: Column) -> Column:
    """Keep spans in start order; on a shared start the longer one wins, other overlaps go.

    One walk in order marks which stay, as a string of marks that is put together from chunks.
    """
    # With the longest of a start in front, what is kept never has to be taken back.
    keyed = F.array_sort(
        F.transform(
            spans,
            lambda s: F.struct(
                s["start"].alias("a"), (-s["end"]).alias("z"), s["rank"].alias("r"), s.alias("s")
            ),
        )
    )

    def walk(items):
        def step(acc, item):
            free = item["a"] >= acc["end"]
            return F.struct(
                F.when(free, -item["z"]).otherwise(acc["end"]).alias("end"),
                F.concat(acc["marks"], F.when(free, F.lit("1")).otherwise(F.lit("0"))).alias("marks"),
            )

        def chunk(acc, number):
            part = F.slice(items, number * CHUNK + 1, F.lit(CHUNK))
            zero = F.struct(acc["end"].alias("end"), F.lit("").alias("marks"))

            def joined(done):
                return F.struct(
                    done["end"].alias("end"), F.concat(acc["marks"], done["marks"]).alias("marks")
                )

            return F.aggregate(part, zero, step, joined)

        last = F.floor((F.size(items) - 1) / F.lit(CHUNK)).cast("int")
        zero = F.struct(F.lit(0).alias("end"), F.lit("").alias("marks"))
        marks = F.aggregate(
            F.sequence(F.lit(0), last), zero, chunk, lambda acc: F.encode(acc["marks"], "UTF-8")
        )

        def kept(raw):
            stays = F.filter(items, lambda _, i: F.substring(raw, i + 1, F.lit(1)) == F.lit(b"1"))
            return F.transform(stays, lambda item: item["s"])

        return bind(marks, kept)

    return F.when(F.size(spans) > 1, bind(keyed, walk)).otherwise(spans)


def redact_spans(text: Column, spans: Column) -> Column:
    """Replace each span by its upper-case type in brackets.

    Pieces are cut by byte offset, which is a plain copy, so the work is linear in the text.
    """

    def cut(raw):
        def piece(span, i):
            previous = F.coalesce(F.get(spans, i - 1)["byte_end"], F.lit(0))
            before = F.substring(raw, previous + 1, span["byte_start"] - previous)
            return F.concat(before.cast("string"), F.lit("["), F.upper(span["type"]), F.lit("]"))

        last = F.get(spans, F.size(spans) - 1)["byte_end"]
        rest = F.substring(raw, last + 1, F.octet_length(raw) - last).cast("string")
        return F.concat(F.array_join(F.transform(spans, piece), ""), rest)

    return F.when(F.size(spans) > 0, bind(F.encode(text, "UTF-8"), cut)).otherwise(text)
