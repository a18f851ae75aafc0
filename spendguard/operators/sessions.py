"""Session ledgers, limits and replays.

``calls`` carry ``cost_usd`` and, where a limit is tested, ``estimated_cost_usd``. Money is
compared exactly, in whole 1e-12 dollars.

A call without a session (NULL ``session_id``) has no ledger and no limit: its ledger columns are
NULL, it is allowed, and no summary counts it. Such calls, often most of a log, are never
shuffled by session.
"""

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..schemas import TOTAL
from .cost import money
from .ordered import MAX_GROUP_ROWS, Fold, fold, running

ORDER = ["timestamp", "call_id"]
BUDGET, ITERATIONS = "budget_exceeded", "iteration_limit_exceeded"  # fixed values


def session_ledger(calls: DataFrame, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Number each call of its session and add the running input tokens and cost."""
    ledger = running(
        calls.where("session_id IS NOT NULL"),
        ["session_id"],
        ORDER,
        {
            "call_sequence": F.lit(1),
            "cumulative_input_tokens": F.col("input_tokens"),
            "cumulative_cost_usd": money("cost_usd"),
        },
        max_group_rows=max_group_rows,
    )
    loose = calls.where("session_id IS NULL")
    ledger = ledger.unionByName(loose, allowMissingColumns=True)
    return ledger.withColumn("call_type", F.lit("llm"))


def session_remaining(totals: DataFrame, limits: DataFrame) -> DataFrame:
    """Budget and iterations left, never below zero; NULL where the session has no limit.

    Sessions that have limits but no calls yet have all of it left.
    """
    both = totals.join(limits.select("session_id", "max_spend_usd", "max_iterations"),
                       "session_id", "full_outer")
    both = both.withColumns(
        {
            "final_spend_usd": F.coalesce("final_spend_usd", F.lit(0).cast(TOTAL)),
            "final_iteration_count": F.coalesce("final_iteration_count", F.lit(0).cast("long")),
        }
    )
    spend = money("max_spend_usd") - F.col("final_spend_usd")
    calls = F.col("max_iterations") - F.col("final_iteration_count")
    zero = F.lit(0)
    return both.withColumns(
        {
            "remaining_budget_usd": F.when(
                F.col("max_spend_usd").isNotNull(), F.greatest(zero.cast(TOTAL), spend)
            ),
            "remaining_iterations": F.when(
                F.col("max_iterations").isNotNull(), F.greatest(zero.cast("long"), calls)
            ),
        }
    )


def _with_limits(calls: DataFrame, limits: DataFrame) -> DataFrame:
    limits = limits.select("session_id", "max_spend_usd", "max_iterations")
    return calls.join(limits, "session_id", "left")


def session_first_refusal(
    calls: DataFrame, limits: DataFrame, max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """First call of each session that fails the pre-check, and why.

    Nothing is refused before it, so plain running sums give the spend before each call.
    """
    run = running(
        _with_limits(calls.where("session_id IS NOT NULL"), limits),
        ["session_id"],
        ORDER,
        {"_spent": money("cost_usd"), "_calls": F.lit(1)},
        max_group_rows=max_group_rows,
    )
    before = F.col("_spent") - money("cost_usd")
    over = F.coalesce(
        before + money("estimated_cost_usd") > money("max_spend_usd"), F.lit(False)
    )
    many = F.coalesce(F.col("_calls") > F.col("max_iterations"), F.lit(False))
    refused = run.where(over | many).select(
        "session_id",
        F.struct(
            "timestamp",
            "call_id",
            F.when(over, F.lit(BUDGET)).otherwise(F.lit(ITERATIONS)).alias("reason"),
            before.alias("spend_before_usd"),
            (F.col("_calls") - 1).alias("iterations_before"),
        ).alias("_row"),
    )
    return refused.groupBy("session_id").agg(F.min("_row").alias("_row")).select(
        "session_id", "_row.*"
    )


NO_LIMIT = -(2**63)
SKIPPED = "skipped"
STRETCH = 256  # calls of a block that are decided together
DOLLAR = 10**12


def _pico(amount) -> Column:
    """Dollars as a whole number of 1e-12 dollars."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    return (amount.cast("decimal(24,12)") * F.lit(Decimal(DOLLAR))).cast("long")


STATE = ["_usd", "_part", "_calls", "_sum_tokens", "_refused"]
SHORT = 64  # runs of calls up to this length are walked one by one
PASSED, OVER_BUDGET, OVER_CALLS, UNDECIDED = range(4)
REASONS = np.array([None, BUDGET, ITERATIONS, None], dtype=object)
WIDE = 2**62
NEW = 0, 0, 0, False  # spend, calls, input tokens, any refusal
INPUTS = ["_cost", "_estimate", "_tokens", "_max_usd", "_max_part", "_max_calls", "_eligible"]


class Walk:
    """Verdicts and totals of one batch, written into arrays; a session is walked from its state
    (spend, calls, input tokens, any refusal).

    Spend is a plain whole number of any size; it leaves as dollars and 1e-12 dollars, as 64 bits
    of the latter alone end at nine million dollars.
    """

    def __init__(self, rows: pa.RecordBatch | dict[str, np.ndarray]):
        if isinstance(rows, pa.RecordBatch):
            rows = {n: rows.column(n).to_numpy(zero_copy_only=False) for n in INPUTS}
        self.cost, self.estimate, self.size, self.usd, self.part, self.most = (rows[n] for n in INPUTS[:-1])
        self.eligible = rows[INPUTS[-1]].astype(bool)
        n = len(self.cost)
        self.verdict = np.empty(n, np.int8)
        self.before = np.empty(n)
        self.calls_before = np.empty(n, np.int64)
        self.after = {c: np.empty(n, np.int64) for c in STATE[:4]}
        self.refused = np.empty(n, bool)

    def run(self, at: int, end: int, state):
        usd, part, most = (int(x[at]) for x in (self.usd, self.part, self.most))
        limit = None if usd == NO_LIMIT else usd * DOLLAR + part
        most = None if most == NO_LIMIT else most
        size = SHORT
        while at < end:
            stop = min(at + size, end)
            done = 0
            if end - at > SHORT:
                done, state = self._passing(at, stop, state, limit, most)
                at += done
                if at < stop:
                    held, state = self._refusing(at, min(at + size, end), state, limit, most)
                    at, done = at + held, done + held
                size = min(2 * size, 65536)
            if done < SHORT and at < end:  # verdicts that change often are quicker one by one
                stop, size = min(at + SHORT, end), SHORT
                at, state = stop, self._plain(at, stop, state, limit, most)
        return state

    def _passing(self, at, stop, state, limit, most):
        """Calls up to the first one that is refused: (how many, state after them)."""
        spent, calls, tokens, refused = state
        own = self.eligible[at:stop]
        cost = np.where(own, self.cost[at:stop], 0)
        estimate = self.estimate[at:stop]
        if cost.sum(dtype=float) >= WIDE or int(estimate.max()) >= WIDE:
            return 0, state
        total, number = np.cumsum(cost), np.cumsum(own)
        bad = np.zeros(len(own), bool)
        if limit is not None:
            room = max(-WIDE, min(WIDE, limit - spent))
            bad |= total - cost > room - estimate
        if most is not None:
            bad |= calls + number > most
        bad = np.flatnonzero(bad & own)
        n = int(bad[0]) if len(bad) else len(own)
        if not n:
            return 0, state
        size = tokens + np.cumsum(np.where(own, self.size[at:stop], 0))[:n]
        verdict = np.where(own[:n], PASSED, UNDECIDED)
        totals = total[:n] - cost[:n], total[:n]
        self._write(at, verdict, spent, *totals, calls + number[:n] - own[:n], calls + number[:n], size, refused)
        return n, (spent + int(total[n - 1]), calls + int(number[n - 1]), int(size[-1]), refused)

    def _refusing(self, at, stop, state, limit, most):
        """Calls from a refused one up to the next that passes; they change no total."""
        spent, calls, tokens, refused = state
        own, estimate = self.eligible[at:stop], self.estimate[at:stop]
        room = WIDE * 2 - 1 if limit is None else max(-WIDE, min(WIDE * 2 - 1, limit - spent))
        dear = estimate > room
        fits = own & ~dear & (most is None or calls + 1 <= most)
        n = int(np.argmax(fits)) if fits.any() else len(own)
        if not n:  # not refused: its amounts are too large for sums of 64 bits
            return 0, state
        verdict = np.where(own[:n], np.where(dear[:n], OVER_BUDGET, OVER_CALLS), UNDECIDED)
        same = np.zeros(n, np.int64)
        flags = refused | np.logical_or.accumulate(own[:n])
        self._write(at, verdict, spent, same, same, same + calls, same + calls, same + tokens, flags)
        return n, (spent, calls, tokens, bool(flags[-1]))

    def _plain(self, at, end, state, limit, most):
        spent, calls, tokens, refused = state
        start, verdicts, befores, afters, numbers, sizes, refusals = spent, [], [], [], [calls], [], []
        rows = zip(*(x[at:end].tolist() for x in (self.cost, self.estimate, self.size, self.eligible)))
        for cost, estimate, size, eligible in rows:
            befores.append(spent - start)
            if not eligible:
                verdicts.append(UNDECIDED)
            elif limit is not None and spent + estimate > limit:
                verdicts.append(OVER_BUDGET)
                refused = True
            elif most is not None and calls + 1 > most:
                verdicts.append(OVER_CALLS)
                refused = True
            else:
                verdicts.append(PASSED)
                spent, calls, tokens = spent + cost, calls + 1, tokens + size
            afters.append(spent - start)
            numbers.append(calls)
            sizes.append(tokens)
            refusals.append(refused)
        self._write(at, verdicts, start, befores, afters, numbers[:-1], numbers[1:], sizes, refusals)
        return spent, calls, tokens, refused

    def output(self) -> dict:
        undecided = self.verdict == UNDECIDED
        return {
            **self.after,
            "_refused": self.refused,
            "spend_before_usd": self.before,
            "iterations_before": self.calls_before,
            "allowed": pa.array(self.verdict == PASSED, mask=undecided),
            "reason": REASONS[self.verdict],
        }

    def _write(self, at, verdict, spent, before, after, calls_before, calls, tokens, refused):
        part = slice(at, at + len(verdict))
        self.verdict[part], self.refused[part] = verdict, refused
        self.calls_before[part] = calls_before
        self.after["_calls"][part], self.after["_sum_tokens"][part] = calls, tokens
        if spent + int(after[-1]) < 2**53:  # whole numbers that doubles hold exactly
            self.before[part] = (spent + np.asarray(before)) / DOLLAR
            self.after["_usd"][part], self.after["_part"][part] = np.divmod(spent + np.asarray(after), DOLLAR)
        else:
            self.before[part] = [(spent + int(x)) / DOLLAR for x in before]
            self.after["_usd"][part], self.after["_part"][part] = zip(*(divmod(spent + int(x), DOLLAR) for x in after))


def _limit_fold() -> Fold:
    """State: (spend, calls, input tokens, any refusal). A refused call adds nothing, so cheaper
    calls may pass later."""

    def replay(rows, fresh, state):
        walk = Walk(rows)
        state = state or NEW
        cuts = [0, *(i for i, new in enumerate(fresh) if new and i), rows.num_rows]
        for at, end in zip(cuts, cuts[1:]):
            state = walk.run(at, end, NEW if fresh[at] else state)
        return walk.output(), state

    def summarise(batches):
        """Stretches of calls with what decides most of them at once: the highest spend before a
        call plus its estimate, if all pass, and the lowest estimate."""
        for rows in batches:
            own = rows.column("_eligible").to_numpy(zero_copy_only=False).astype(bool)
            arrays = [rows.column(c).to_numpy(zero_copy_only=False)[own] for c in ("_cost", "_estimate", "_tokens")]
            usd, part, most = (rows.column(c)[0].as_py() for c in ("_max_usd", "_max_part", "_max_calls"))
            limits = None if usd == NO_LIMIT else usd * DOLLAR + part, None if most == NO_LIMIT else most
            for at in range(0, len(arrays[0]), STRETCH):
                cost, estimate, size = (a[at : at + STRETCH] for a in arrays)
                wide = cost.sum(dtype=float) + float(estimate.max()) >= WIDE
                cost = cost.astype(object) if wide else cost
                peak = int((np.cumsum(cost) - cost + estimate).max())
                yield limits, peak, int(estimate.min()), cost, estimate, size

    def advance(state, part):
        (spent, calls, tokens, refused), (limits, peak, least, cost, estimate, size) = state, part
        limit, most = limits
        if (limit is None or spent + peak <= limit) and (most is None or calls + len(cost) <= most):
            return spent + int(cost.sum()), calls + len(cost), tokens + int(size.sum()), refused
        if (limit is not None and spent + least > limit) or (most is not None and calls >= most):
            return spent, calls, tokens, True
        for one, expected, n in zip(cost.tolist(), estimate.tolist(), size.tolist()):
            if (limit is not None and spent + expected > limit) or (most is not None and calls >= most):
                refused = True
            else:
                spent, calls, tokens = spent + one, calls + 1, tokens + n
        return spent, calls, tokens, refused

    return Fold(replay, summarise, advance)


REPLAY_OUTPUT = T.StructType(
    [
        T.StructField("allowed", T.BooleanType()),
        T.StructField("reason", T.StringType()),
        T.StructField("spend_before_usd", T.DoubleType()),
        T.StructField("iterations_before", T.LongType()),
        T.StructField("_usd", T.LongType()),
        T.StructField("_part", T.LongType()),
        T.StructField("_calls", T.LongType()),
        T.StructField("_sum_tokens", T.LongType()),
        T.StructField("_refused", T.BooleanType()),
    ]
)


def limit_inputs(
    calls: DataFrame, max_spend: Column, max_calls: Column, eligible: Column | None = None
) -> dict[str, Column]:
    """What ``Walk`` reads of each call."""
    limit = max_spend.cast("decimal(32,12)")
    whole = F.floor(limit).cast("long")
    return {
        "_cost": _pico("cost_usd"),
        "_estimate": _pico("estimated_cost_usd"),
        "_tokens": F.coalesce("input_tokens", F.lit(0)) if "input_tokens" in calls.columns
        else F.lit(0),
        "_max_usd": F.coalesce(whole, F.lit(NO_LIMIT)),
        "_max_part": F.coalesce(_pico(limit - F.floor(limit)), F.lit(0)),
        "_max_calls": F.coalesce(max_calls.cast("long"), F.lit(NO_LIMIT)),
        "_eligible": F.lit(True) if eligible is None else F.coalesce(eligible, F.lit(False)),
    }


def replay_limits(
    calls: DataFrame,
    max_spend: Column,
    max_calls: Column,
    eligible: Column | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """The replay with its end state per row; see ``session_replay``."""
    inputs = limit_inputs(calls, max_spend, max_calls, eligible)
    work = calls.where("session_id IS NOT NULL").withColumns(inputs)
    counted = (calls if counted is None else counted).where("session_id IS NOT NULL")
    out = fold(work, ["session_id"], ORDER, _limit_fold(), REPLAY_OUTPUT, max_group_rows, counted)
    loose = calls.where("session_id IS NULL").withColumn(
        "allowed", F.when(inputs["_eligible"], F.lit(True))
    )
    return out.drop(*inputs).unionByName(loose, allowMissingColumns=True)


def session_replay(
    calls: DataFrame,
    limits: DataFrame,
    eligible: Column | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Decide every call against its session's limits; refused calls add nothing.

    Spend is tested before iterations, and reaching the spend limit exactly is allowed. Calls
    that are not ``eligible`` stay in the output undecided and do not count. Needs costs of zero
    or more. ``counted`` may name a cheaper frame with the same sessions, to size them.
    """
    return replay_limits(
        _with_limits(calls, limits),
        F.col("max_spend_usd"),
        F.col("max_iterations"),
        eligible,
        max_group_rows,
        calls if counted is None else counted,
    ).drop(*STATE)


def session_summary(
    replayed: DataFrame, closes: DataFrame | None = None, opened: DataFrame | None = None
) -> DataFrame:
    """Final state per session from replayed calls and optional close events.

    A refusal leaves the session terminated with the last refusal's reason; closing with
    'completed' overwrites that, any other close reason terminates. Sessions that were opened
    (``opened`` has their session_id) or closed without a call have zero totals.
    """
    rows = replayed.where("session_id IS NOT NULL").select(
        "session_id", "timestamp", "call_id", "cost_usd", "allowed", "reason"
    )
    for known in (closes, opened):
        if known is not None:
            rows = rows.unionByName(known.select("session_id").distinct(), allowMissingColumns=True)
    passed = F.col("allowed")
    last = F.when(~passed, F.struct("timestamp", "call_id", "reason"))
    totals = rows.groupBy("session_id").agg(
        F.coalesce(
            F.sum(F.when(passed, money("cost_usd"))), F.lit(0).cast(TOTAL)
        ).alias("final_spend_usd"),
        F.count(F.when(passed, True)).alias("final_iteration_count"),
        F.max(last)["reason"].alias("_refusal"),
    )
    if closes is None:
        totals = totals.withColumn("close_reason", F.lit(None).cast("string"))
    else:
        totals = totals.join(closes.select("session_id", "close_reason"), "session_id", "left")
    reason = F.coalesce("close_reason", "_refusal")
    status = (
        F.when(F.col("close_reason") == "completed", "completed")
        .when(reason.isNotNull(), "terminated")
        .otherwise("active")
    )
    return totals.withColumns({"status": status, "termination_reason": reason}).drop(
        "_refusal", "close_reason"
    )
