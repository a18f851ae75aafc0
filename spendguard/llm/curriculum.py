"""Mixing sources to target weights as a curriculum whose weights change while training goes on.

*Targets.* Sources share all words by weight; a target stops at ``MAX_REPEATS`` times its source's words and the excess
is shared again. A round lifts the level (words a unit of weight) from two sums over the sources, as exact fractions,
until no further source is above its bound; sources stay a table, the driver sees two numbers a round.

*Schedule.* A source's weight over training time 0 to 1 goes straight from knot to knot, at equal steps. The integral
of that line, scaled to the source's target, is the source's cumulative demand in words.

*Positions.* The documents of a source stand in the order of a hash and are taken again and again until the target is
reached: copy ``k`` of a document that has ``c`` words of its source before it begins at word ``k * source_size + c``
of the demand. Inverting the integral there gives its position. The last copy is cut where the target ends, so a
source's taken words are its target, rounded down, and no document is taken more than ``MAX_REPEATS`` times.

*Order.* Copies are range-sorted by position (``training_order``), documents by the position of their first copy.

Running sums do not gather a source: it is cut into slices of its hash range, as many as its size asks for, which are
summed, led by the sum before them, and summed up within. Equal rows are one row with a number until the end, so rows
that repeat cannot make a slice hot. All results are functions of the rows alone, whatever their order and files.

Defined cases: a null text has no words; a null source is a source and the last one, a null id is an id; rows that are
equal in id, source and text are taken one after the other; documents without words take no words, and have a position
if their place comes before the end of the demand; an empty table gives no rows; other columns are not read; ties of
the hash go by id. Long texts are counted whole. Counts of words are assumed to stay below 2 to the 53.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendguard.llm.common import salted, with_salt
from spendguard.runtime import checkpointed

MAX_REPEATS = 3
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of a source in a slice, about.
SLICE = 2_000
#: Equal rows that one task writes out.
COPIES = 10_000
SALTS = 16
#: A table of sources of more rows than this is joined by shuffling.
BOUND = 100_000

WEIGHTS = (1, 2, 3)
#: By weight, the shape of its schedule: light sources fade out, heavy ones fade in, the others swell in between.
KNOTS = {1: (1.5, 1.0, 0.5), 2: (1.0, 1.5, 1.0), 3: (0.5, 1.0, 1.5)}


def order_key(docs: DataFrame) -> Column:
    """32 hexadecimal digits from id and text, which say where a document stands within its source."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("doc_id", "text")]
    return F.md5(F.concat_ws(":", *parts).cast("binary"))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0))


def _classes(docs: DataFrame) -> DataFrame:
    """Rows equal in id, source and text once, with their number ``m``."""
    read = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        order_key(docs).alias("key"),
        word_count(F.col("text")).alias("size"),
    )
    return read.groupBy("doc_id", "source", "key", "size").agg(F.count("*").alias("m"))


def numbered(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """``df`` with the rank of each row in ``order``, from 0. The driver sees one number a partition."""
    held = checkpointed(df.repartitionByRange(*order).sortWithinPartitions(*order)).withColumn("_at", F.spark_partition_id())
    held = held.withColumn("_row", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    sizes = sorted(held.groupBy("_at").count().collect())
    before, offsets = 0, {}
    for at, n in sizes:
        offsets[at], before = before, before + n
    lead = F.element_at(F.create_map(*[F.lit(x) for pair in offsets.items() for x in pair]), F.col("_at")) if offsets else F.lit(0)
    return held.withColumn(name, lead.cast("long") + F.col("_row")).drop("_at", "_row")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``(source, n, source_size, weight, target)`` of the sources ``(source, n, source_size)``; weights go to the
    sources in code-point order, again and again."""
    ranked = numbered(sizes, "_rank", F.isnull("source"), F.col("source"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    given = checkpointed(ranked.withColumn("weight", weight.cast("long")).drop("_rank"))
    most = F.col("source_size") * max_repeats

    def above(level: Fraction) -> Column:
        share = F.col("weight").cast("decimal(10,0)") * F.lit(level.numerator).cast("decimal(28,0)")
        return share >= most.cast("decimal(20,0)") * F.lit(level.denominator).cast("decimal(18,0)")

    total = given.agg(F.sum("source_size")).first()[0] or 0
    level, full = Fraction(0), -1
    while True:
        held = given.agg(
            F.coalesce(F.sum(F.when(above(level), most)), F.lit(0)), F.coalesce(F.sum(F.when(~above(level), F.col("weight"))), F.lit(0)),
            F.count_if(above(level)),
        ).first()
        if held[1] == 0 or held[2] == full:
            break
        full, level = held[2], Fraction(int(total - held[0]), int(held[1]))
    share = (F.col("weight") * F.lit(level.numerator)).cast("double") / F.lit(level.denominator).cast("double")
    return given.withColumn("target", F.when(above(level), most.cast("double")).otherwise(share))


def _areas(knots: Column) -> Column:
    """Running areas under the line through ``knots`` at equal steps of one, from 0 on."""
    steps = F.transform(F.sequence(F.lit(1), F.size(knots) - 1), lambda i: (F.get(knots, i - 1) + F.get(knots, i)) / 2)
    return F.transform(
        F.sequence(F.lit(0), F.size(knots) - 1),
        lambda i: F.aggregate(F.slice(steps, F.lit(1), i), F.lit(0.0), lambda a, x: a + x),
    )


def invert(share: Column, knots: Column, areas: Column) -> Column:
    """The time, 0 to 1, at which the integral of the line through ``knots`` has reached ``share`` of its end."""
    sought = share * F.element_at(areas, -1)
    step = F.greatest(F.lit(0), F.least(F.size(F.filter(areas, lambda a: a <= sought)) - 1, F.size(knots) - 2))
    begin, end, rest = F.get(knots, step), F.get(knots, step + 1), sought - F.get(areas, step)
    # rest = begin * x + (end - begin) / 2 * x * x, solved without a difference of like numbers.
    root = F.sqrt(begin * begin + (end - begin) * 2.0 * rest)
    x = F.when(rest <= 0, F.lit(0.0)).otherwise(rest * 2.0 / (begin + root))
    return (step + x) / (F.size(knots) - 1)


def _schedule(weight: Column, knots: dict[int, tuple[float, ...]]) -> Column:
    cases = [(w, F.array(*[F.lit(float(k)) for k in line])) for w, line in knots.items()]
    chosen = F.when(weight == cases[0][0], cases[0][1])
    for w, line in cases[1:]:
        chosen = chosen.when(weight == w, line)
    return chosen.otherwise(F.array(F.lit(1.0), F.lit(1.0)))


def _placed(classes: DataFrame, weights, knots, max_repeats, slice_rows) -> DataFrame:
    """Classes with ``before``, the words of their source that stand before them, and the source's columns, among them
    its schedule and the integral of that."""
    sizes = classes.groupBy("source").agg(F.count("*").alias("n"), F.sum(F.col("size") * F.col("m")).alias("source_size"))
    line = _schedule(F.col("weight"), knots)
    mixed = targets(sizes, weights, max_repeats).withColumns({"knots": line, "areas": _areas(line)})
    mixed = checkpointed(mixed)
    # A null source joins like any other under a name of two parts.
    name = [F.isnull("source").alias("_none"), F.coalesce("source", F.lit("")).alias("_name")]
    slices = F.ceil(F.col("n") / slice_rows)
    meta = mixed.select(*name, slices.alias("_slices"), "source_size", "target", "knots", "areas")
    few = mixed.count() <= BOUND
    meta = F.broadcast(meta) if few else salted(meta, SALTS)
    rows = classes.select("*", *name)
    rows = rows if few else with_salt(rows, F.col("key"), SALTS)
    rows = rows.join(meta, ["_none", "_name"] if few else ["_none", "_name", "_salt"])
    place = F.conv(F.substring("key", 1, 12), 16, 10).cast("long") / float(1 << 48)
    rows = checkpointed(rows.withColumn("_slice", F.floor(place * F.col("_slices")).cast("long")))
    by = ["_none", "_name", "_slice"]
    words = F.col("size") * F.col("m")
    sums = rows.groupBy(*by).agg(F.sum(words).alias("_sum"))
    # One row for each SLICE rows of a source.
    lead = Window.partitionBy("_none", "_name").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*by, F.coalesce(F.sum("_sum").over(lead), F.lit(0)).alias("_lead"))
    within = Window.partitionBy(*by).orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_before", F.coalesce(F.sum(words).over(within), F.lit(0)))
    rows = rows.join(sums, by).withColumn("before", F.col("_lead") + F.col("_before"))
    return rows.drop("_salt", "_slice", "_slices", "_lead", "_before", "_none", "_name")


def positions(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    knots: dict[int, tuple[float, ...]] | None = None,
    max_repeats: int = MAX_REPEATS,
    slice_rows: int = SLICE,
) -> DataFrame:
    """A row for each document: ``doc_id, source, key, size, source_size, target, copies``; ``copies`` are the times it
    is taken, each ``(copy, position, words)``, in their order. ``knots`` gives a schedule for each weight."""
    knots = KNOTS if knots is None else knots
    placed = _placed(checkpointed(_classes(docs)), weights, knots, max_repeats, slice_rows)
    # Equal rows stand one after the other; first in stretches, so that many of them are written out by many tasks.
    stretch = F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1, F.lit(COPIES).cast("long")))
    cut = placed.withColumn("_from", stretch)
    if not placed.where(F.col("m") > COPIES).isEmpty():
        cut = cut.repartition("key", "_from")
    each = F.explode(F.sequence(F.col("_from"), F.least(F.col("_from") + COPIES, F.col("m")) - 1))
    rows = cut.withColumn("_j", each)
    start = F.col("before") + F.col("_j") * F.col("size")
    end = F.floor("target").cast("long")

    def copy(k: Column) -> Column:
        at = start + k * F.col("source_size")
        share = at.cast("double") / F.col("target")
        return F.struct(
            k.alias("copy"),
            F.when(at < end, invert(share, F.col("knots"), F.col("areas"))).alias("position"),
            F.least(F.col("size"), end - at).alias("words"),
        )

    every = F.transform(F.sequence(F.lit(0).cast("long"), F.lit(max_repeats - 1).cast("long")), copy)
    taken = F.filter(every, lambda c: c["position"].isNotNull())
    return rows.select("doc_id", "source", "key", "size", "source_size", "target", taken.alias("copies"))


def by_first_position(placed: DataFrame) -> DataFrame:
    """One row for each document with ``taken``, ``n_copies`` and ``first_position``, range-sorted by the latter; those
    that the mix does not take come first."""
    taken = F.aggregate("copies", F.lit(0).cast("long"), lambda a, c: a + c["words"])
    rows = placed.select(
        "doc_id", "size", "source_size", "target", taken.alias("taken"), F.size("copies").alias("n_copies"),
        F.get("copies", F.lit(0))["position"].alias("first_position"), "key",
    )
    order = ["first_position", "key", "doc_id"]
    # Ranges are found by sampling, which would compute all positions a second time.
    return checkpointed(rows).repartitionByRange(*order).sortWithinPartitions(*order).drop("key")


def training_order(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, a row for each copy, range-sorted by position: ``position, doc_id, source, copy, words, text``.

    ``words`` says how many of its words to take: all of them, but for the last copy of a source. Texts meet their
    places by id, source and key; rows that are equal in these have the same text, so one of them is sent.
    """
    same = ["_id", "_source", "key"]

    def keyed(df: DataFrame) -> list[Column]:
        return [
            F.concat(F.lit("="), F.col(c).cast("string")) if c in df.columns else F.lit("") for c in ("doc_id", "source")
        ]

    copies = positions(docs, **options).select("*", F.inline("copies"))
    places = copies.select(*[F.coalesce(k, F.lit("")).alias(n) for k, n in zip(keyed(copies), same, strict=False)], "key",
                           "position", "doc_id", "source", "copy", "words")
    texts = docs.select(*[F.coalesce(k, F.lit("")).alias(n) for k, n in zip(keyed(docs), same, strict=False)],
                        order_key(docs).alias("key"), F.col("text").cast("string").alias("text"))
    texts = texts.groupBy(*same).agg(F.max("text").alias("text"))
    order = ["position", "key", "doc_id", "copy"]
    mixed = checkpointed(places).join(texts, same).repartitionByRange(*order).sortWithinPartitions(*order)
    return mixed.select("position", "doc_id", "source", "copy", "words", "text")
