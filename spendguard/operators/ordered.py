"""Running totals and sequential folds over time-ordered groups of any size.

A group that fits one task goes through one hash shuffle and a plain window. When a group holds
more rows than ``max_group_rows`` it is cut into blocks along the order, a block's own totals are
computed side by side, and each is shifted by the totals of the blocks before it. Blocks are
stretches of time where that cuts finely enough, which needs no more than one shuffle of the rows.
Otherwise, and for folds, rows are range-partitioned by (keys, order), which splits any group, and
frozen with a checkpoint so that every later step sees the same cut. The exact same values come
out either way.
"""

import itertools
import pickle
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_
from typing import Any, Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..runtime import checkpointed

MAX_GROUP_ROWS = 2_000_000
MAX_BLOCKS = 50_000  # more blocks than this only make them smaller, not more parallel


@dataclass(frozen=True)
class Sizes:
    """Total rows and rows of the largest group."""

    total: int
    largest: int


def _groups(df: DataFrame, keys: list[str], at: str) -> DataFrame:
    """Rows and time range of each group; counts combine before the shuffle."""
    timed = dict(df.dtypes).get(at) == "timestamp"
    clock = F.unix_micros(at) if timed else F.lit(None).cast("long")
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"), (F.max(clock) - F.min(clock)).alias("_range")
    )


def group_sizes(df: DataFrame, keys: list[str], at: str) -> Sizes:
    """Sizes in one pass; one row comes back."""
    row = _groups(df, keys, at).agg(F.sum("_rows"), F.max("_rows")).first()
    return Sizes(row[0] or 0, row[1] or 0)


def large_groups(df: DataFrame, keys: list[str], at: str, limit: int) -> DataFrame:
    """The groups of more than ``limit`` rows, with their rows and time range."""
    return checkpointed(_groups(df, keys, at).where(F.col("_rows") > limit))


def time_blocks(df, counted, keys, at, limit, large=None) -> DataFrame | None:
    """``df`` with ``_block`` = the stretch of time, if no group has too much in one stretch.

    Every group above the limit has stretches of its own length, a quarter of the limit long on
    average, so it has at most four blocks for each ``limit`` rows; other groups are one block,
    NULL. There are at most total / limit such groups (``large``); their few rows are broadcast.
    """
    width = F.floor(F.col("_range") * (limit / 4) / F.col("_rows")).cast("long")
    large = _groups(counted, keys, at).where(F.col("_rows") > limit) if large is None else large
    names = {key: f"_hot_{i}" for i, key in enumerate(keys)}
    hot = checkpointed(
        large.select(*[F.col(k).alias(n) for k, n in names.items()],
                     F.greatest(width, F.lit(1)).alias("_width"))
    )

    def cut(rows, how):
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()])
        stretch = F.coalesce(F.floor(F.unix_micros(at) / F.col("_width")), F.lit(0))
        block = F.when(F.col("_width").isNotNull(), stretch).alias("_block")
        return rows.join(F.broadcast(hot), same, how).select(*[F.col(c) for c in rows.columns], block)

    stretches = cut(counted.select(*keys, at), "inner").groupBy(*keys, "_block").count()
    if (stretches.agg(F.max("count")).first()[0] or 0) > limit:
        return None
    return cut(df, "left")


def freeze(df: DataFrame, keys: list[str], order: list[str], parts: int) -> DataFrame:
    """Rows cut into contiguous blocks of the (keys, order) sequence, with ``_block`` numbers."""
    cut = df.repartitionByRange(parts, *keys, *order).sortWithinPartitions(*keys, *order)
    return checkpointed(cut.withColumn("_block", F.spark_partition_id()))


def _parts(df: DataFrame, sizes: Sizes, limit: int) -> int:
    """Blocks of about ``limit`` rows, never fewer than the session's shuffle partitions."""
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(usual, min(MAX_BLOCKS, -(-sizes.total // limit)))


def _frame(keys, order):
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def running(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    sums: dict[str, Column] | None = None,
    maxima: dict[str, Callable[[Callable[[str], Column]], Column]] | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
    counted: DataFrame | None = None,
    fits: bool = False,
    large: DataFrame | None = None,
) -> DataFrame:
    """Add running values per group, the current row included.

    ``sums`` maps a new column to the expression to add up. ``maxima`` maps a new column to an
    expression whose running maximum is wanted; it is built from a lookup of the ``sums``
    columns already there. NULL terms count as nothing. ``counted`` may name a cheaper frame whose
    groups are at least as large, to size the groups without running ``df`` twice; ``fits`` says that
    no group can be too large and ``large`` has the ``large_groups`` that are there, so that nothing
    is sized.
    """
    sums, maxima = sums or {}, maxima or {}
    counted = df if counted is None else counted
    sizes = None
    if not fits and large is None:
        sizes = group_sizes(counted, keys, order[0])
        fits = sizes.largest <= max_group_rows
    if fits or (large is not None and large.isEmpty()):
        frame = _frame(keys, order)
        out = df.withColumns({name: F.sum(term).over(frame) for name, term in sums.items()})
        return out.withColumns(
            {name: F.max(term(F.col)).over(frame) for name, term in maxima.items()}
        )

    blocked = None
    if dict(counted.dtypes).get(order[0]) == "timestamp":
        blocked = time_blocks(df, counted, keys, order[0], max_group_rows, large)
    if blocked is None:
        sizes = sizes or group_sizes(counted, keys, order[0])
        blocked = freeze(df, keys, order, _parts(df, sizes, max_group_rows))
    # A maximum that looks no sum up is taken along with the sums.
    asked = {name: [] for name in maxima}
    terms = {n: term(lambda c, n=n: asked[n].append(c) or F.col(c)) for n, term in maxima.items()}
    first = {n: (F.sum, term) for n, term in sums.items()}
    first |= {n: (F.max, term) for n, term in terms.items() if not asked[n]}
    then = {n: (F.max, term) for n, term in terms.items() if asked[n]}
    out = _over_blocks(blocked, keys, order, first) if first else blocked
    out = _over_blocks(out, keys, order, then) if then else out
    return out.drop("_block")


def _over_blocks(blocked, keys, order, terms) -> DataFrame:
    """Running totals inside each block, led by a row with the total of the group's earlier blocks;
    ``terms`` has the kind of total and the expression of each.

    The leading rows make a join unnecessary: rows are shuffled once, by (keys, block). A group of
    one block, NULL, needs none.
    """
    totals = {name: total for name, (total, _) in terms.items()}
    terms = {name: term for name, (_, term) in terms.items()}
    probe = blocked.agg(*[totals[name](term).alias(name) for name, term in terms.items()])
    kinds = {field.name: field.dataType for field in probe.schema.fields}
    work = {name: f"_term_{name}" for name in terms}
    blocked = blocked.withColumns({work[n]: term.cast(kinds[n]) for n, term in terms.items()})
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    leading = (
        blocked.where("_block IS NOT NULL")
        .groupBy(*keys, "_block")
        .agg(*[totals[n](c).alias(c) for n, c in work.items()])
        .withColumns({c: totals[n](c).over(earlier).cast(kinds[n]) for n, c in work.items()})
        .where(reduce(or_, [F.col(c).isNotNull() for c in work.values()]))
        .withColumn("_is_row", F.lit(False))
    )
    both = blocked.withColumn("_is_row", F.lit(True)).unionByName(
        leading, allowMissingColumns=True
    )
    frame = _frame([*keys, "_block"], ["_is_row", *order])
    out = both.withColumns({n: totals[n](c).over(frame).cast(kinds[n]) for n, c in work.items()})
    return out.where("_is_row").drop("_is_row", *work.values())


@dataclass
class Fold:
    """A sequential rule over the ordered rows of each group.

    ``replay(rows, fresh, state)`` walks an Arrow batch in order and returns (output lists, last
    state). ``fresh`` marks the first row of each group; the rows before the first mark go on
    from ``state``. To cross blocks of a hot group, ``summarise(batches)`` reduces one block of a
    single group to one or more parts without knowing the state before it, and
    ``advance(state, part)`` gives the state after a part. ``compose(part, next)`` makes one part
    out of two; where a rule has it, a block has one part, and blocks are followed as a tree.
    """

    replay: Callable[[pa.RecordBatch, list[bool], Any], tuple[dict[str, list], Any]]
    summarise: Callable[[Iterator[pa.RecordBatch]], Iterator[Any]]
    advance: Callable[[Any, Any], Any]
    compose: Callable[[Any, Any], Any] | None = None


ARROW_TYPES = {
    T.BooleanType(): pa.bool_(),
    T.LongType(): pa.int64(),
    T.DoubleType(): pa.float64(),
    T.StringType(): pa.string(),
}


def fold(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    rule: Fold,
    output: T.StructType,
    max_group_rows: int = MAX_GROUP_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Apply ``rule`` to each group in order and append its ``output`` columns to every row.

    Rows stream through in Arrow batches; a task holds one batch and one state. ``counted`` is
    as in ``running``.
    """
    columns = df.columns
    schema = T.StructType([*df.schema.fields, *output.fields])
    types = {f.name: ARROW_TYPES[f.dataType] for f in output.fields}
    counted = df if counted is None else counted
    sizes = group_sizes(counted, keys, order[0])
    if sizes.largest <= max_group_rows:
        # The window asks for whole groups in order. An explicit repartition would not do: after
        # a join on the same keys it is dropped, and run-time join changes then scatter groups.
        number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        ordered = df.withColumn("_n", number)
    else:
        ordered = freeze(df, keys, order, _parts(df, sizes, max_group_rows))
        # At most MAX_BLOCKS rows; the join leaves every block as it is.
        ordered = ordered.join(F.broadcast(_block_starts(ordered, keys, rule)), "_block", "left")

    def walk(batches):
        for batch, added, _ in _replayed(batches, keys, rule):
            arrays = [batch.column(c) for c in columns]
            arrays += [_array(added[name], kind) for name, kind in types.items()]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.fieldNames())

    return ordered.mapInArrow(walk, schema)


def _array(values, kind: pa.DataType) -> pa.Array:
    return values if isinstance(values, pa.Array) else pa.array(values, type=kind)


def _changes(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """True where a row's keys differ from the row before; NULL keys are equal."""
    changed = np.zeros(batch.num_rows, dtype=bool)
    for key in keys:
        after, before = batch.column(key)[1:], batch.column(key)[:-1]
        differ = pc.fill_null(pc.not_equal(after, before), False).to_numpy(zero_copy_only=False)
        nulls = pc.xor(after.is_null(), before.is_null()).to_numpy(zero_copy_only=False)
        changed[1:] |= differ | nulls
    return changed


def _replayed(batches, keys, rule):
    """Replay sorted batches; where they have ``_start``, the first one's is the state to go on from."""
    state, last = None, None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        fresh = _changes(batch, keys)
        head = tuple(batch.column(key)[0].as_py() for key in keys)
        if last is None:
            start = batch.column("_start")[0].as_py() if "_start" in batch.schema.names else None
            fresh[0] = start is None
            state = None if start is None else pickle.loads(start)
        else:
            fresh[0] = head != last
        added, state = rule.replay(batch, fresh.tolist(), state)
        last = tuple(batch.column(key)[-1].as_py() for key in keys)
        yield batch, added, state


FAN = 32  # blocks that one task follows at a time


def _block_starts(frozen: DataFrame, keys: list[str], rule: Fold, fan: int = FAN) -> DataFrame:
    """``(_block, _start)``: the state at the head of every block that continues the group of the
    block before it.

    Blocks are summarised in parallel. The chain of summaries of one group is followed as a tree:
    ``fan`` neighbours at a time are composed level by level, then states go down the levels. A rule
    whose summaries do not compose has its chain followed in order, without any job in between.
    Keys, summaries and states stay in tables; the driver sees a count.
    """
    links = _links(frozen, keys)
    items = checkpointed(_items(frozen, keys, rule, links))
    after = _in_order(items, rule) if rule.compose is None else _as_tree(items, rule, fan)
    nexts = links.select("_chain", "_pos", F.col("_next").alias("_block"))
    return checkpointed(after.join(nexts, ["_chain", "_pos"]).select("_block", F.col("state").alias("_start")))


def _links(frozen: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each block whose last group goes on in the next one: ``_next``, whether it is
    ``_inner``, a part of a single group with neither its start nor its end, and its place in the
    chain of such blocks. One small row a block is put in order, at most ``MAX_BLOCKS``."""
    edge = F.struct(*keys)
    edges = frozen.groupBy("_block").agg(F.min(edge).alias("head"), F.max(edge).alias("tail"))
    order = Window.orderBy("_block")
    goes_on = F.coalesce(F.col("tail").eqNullSafe(F.lead("head").over(order)) & F.lead("_block").over(order).isNotNull(), F.lit(False))
    came_on = F.coalesce(F.col("head").eqNullSafe(F.lag("tail").over(order)) & F.lag("_block").over(order).isNotNull(), F.lit(False))
    known = edges.select(
        "_block", F.lead("_block").over(order).alias("_next"), goes_on.alias("_goes_on"),
        (came_on & F.col("head").eqNullSafe(F.col("tail"))).alias("_inner"),
    )
    first = F.max(F.when(~F.col("_inner"), F.col("_block"))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    chained = known.where("_goes_on").withColumn("_chain", first)
    place = F.row_number().over(Window.partitionBy("_chain").orderBy("_block")) - 1
    return checkpointed(chained.select("_block", "_next", "_inner", "_chain", place.alias("_pos")))


def _items(frozen: DataFrame, keys: list[str], rule: Fold, links: DataFrame) -> DataFrame:
    """``(_chain, _pos, _part, result)``: summaries of the inner blocks; for the first block of a
    chain, where the group begins, the state at its end."""

    def run(batches):
        batches = (batch for batch in batches if batch.num_rows)
        first = next(batches, None)
        if first is None:
            return
        chain, pos, inner = (first.column(c)[0].as_py() for c in ("_chain", "_pos", "_inner"))
        batches = itertools.chain([first], batches)
        if inner:
            results = rule.summarise(batches)
        else:
            state = None
            for _, _, state in _replayed(batches, keys, rule):
                pass
            results = [state]
        for part, result in enumerate(results):
            row = {"_chain": [chain], "_pos": [pos], "_part": [part], "result": [pickle.dumps(result)]}
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row.values(), kinds)], [*row])

    told = frozen.join(F.broadcast(links.drop("_next")), "_block")
    return told.mapInArrow(run, "_chain int, _pos int, _part int, result binary")


STATES = "_chain int, _pos int, state binary"


def _in_order(items: DataFrame, rule: Fold) -> DataFrame:
    """``STATES`` after each block; a chain passes through one task, part by part."""

    def walk(batches):
        chain, pos, state = None, None, None
        for batch in batches:
            out = []
            for at, place, result in zip(batch["_chain"].tolist(), batch["_pos"].tolist(), batch["result"]):
                if chain is not None and (at, place) != (chain, pos):
                    out.append((chain, pos, pickle.dumps(state)))
                result = pickle.loads(result)
                state = result if at != chain else rule.advance(state, result)
                chain, pos = at, place
            yield pd.DataFrame(out, columns=["_chain", "_pos", "state"])
        if chain is not None:
            yield pd.DataFrame([(chain, pos, pickle.dumps(state))], columns=["_chain", "_pos", "state"])

    dealt = items.repartition("_chain").sortWithinPartitions("_chain", "_pos", "_part")
    return dealt.select("_chain", "_pos", "result").mapInPandas(walk, STATES)


def _as_tree(items: DataFrame, rule: Fold, fan: int) -> DataFrame:
    """``STATES`` after each block, in rounds as many as the logarithm of the longest chain."""

    def together(rows: pd.DataFrame) -> pd.DataFrame:
        """The rows of one group as one; the first of a chain is a state, all others are summaries."""
        rows = rows.sort_values("_pos")
        chain, first = int(rows["_chain"].iloc[0]), int(rows["_pos"].iloc[0])
        results = map(pickle.loads, rows["result"])
        result = next(results)
        for summary in results:
            result = (rule.advance if first == 0 else rule.compose)(result, summary)
        return pd.DataFrame([(chain, first // fan, pickle.dumps(result))], columns=["_chain", "_pos", "result"])

    def apart(rows: pd.DataFrame) -> pd.DataFrame:
        """The state after each row of a group, from the state before it."""
        rows = rows.sort_values("_pos")
        begin, states = rows["start"].iloc[0], []
        state = None if begin is None else pickle.loads(begin)
        for result in map(pickle.loads, rows["result"]):
            state = result if state is None else rule.advance(state, result)
            states.append(pickle.dumps(state))
        return pd.DataFrame({"_chain": rows["_chain"], "_pos": rows["_pos"], "state": states})

    group = F.floor(F.col("_pos") / fan).cast("int")
    levels = [items.select("_chain", "_pos", "result")]
    while not levels[-1].where(F.col("_pos") >= fan).isEmpty():
        up = levels[-1].groupBy("_chain", group.alias("_group"))
        levels.append(checkpointed(up.applyInPandas(together, "_chain int, _pos int, result binary")))
    starts = levels[-1].sparkSession.createDataFrame([], "_chain int, _group int, start binary")
    for level in reversed(levels):
        begun = level.withColumn("_group", group).join(starts, ["_chain", "_group"], "left")
        after = checkpointed(begun.groupBy("_chain", "_group").applyInPandas(apart, STATES))
        starts = after.select("_chain", (F.col("_pos") + 1).alias("_group"), F.col("state").alias("start"))
    return after
