"""Token-bucket audit of call rates.

Token levels are whole numbers of a unit small enough that both the refill per microsecond and
one token are exact, so decisions do not depend on rounding or on how the work was split.
"""

from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .ordered import MAX_GROUP_ROWS, Fold, fold, running

DEFAULT_RATE, DEFAULT_BURST = 10, 50  # fixed values: calls per second, bucket size


@dataclass(frozen=True)
class Bucket:
    """Rate and burst in units: refill per microsecond, one token, full bucket."""

    refill: int
    token: int
    full: int

    @classmethod
    def of(cls, rate, burst) -> "Bucket":
        """``rate`` per second and ``burst``, both above 0; numbers or exact text like "1/3600".

        Text, whole numbers, fractions and decimals are taken as they are. A float is taken as
        the simplest fraction within its own precision, so 10/60 and 1/3 mean what they say.
        Whatever would need levels beyond 62 bits is an error here, not in the middle of a job.
        """
        r, b = _exact(rate), _exact(burst)
        if r <= 0 or b <= 0:
            raise ValueError("rate and burst must be above 0")
        scale = r.denominator * b.denominator
        bucket = cls(r.numerator * b.denominator, 10**6 * scale, int(10**6 * scale * b))
        if max(bucket.full, bucket.token, bucket.refill * 10**6) >= 2**62:
            raise ValueError(f"rate {rate} with burst {burst} needs a finer unit than 62 bits hold")
        return bucket


def _exact(number) -> Fraction:
    if not isinstance(number, float):
        return Fraction(str(number))
    for digits in range(1, 16):
        near = Fraction(number).limit_denominator(10**digits)
        if abs(near - Fraction(number)) <= abs(Fraction(number)) * Fraction(1, 2**52):
            return near
    return Fraction(str(number))


SHORT = 64  # runs of calls up to this length are walked one by one


class Walk:
    """Levels before and after each call of one key, written into slices of the batch's arrays."""

    def __init__(self, bucket: Bucket, times: np.ndarray):
        self.bucket, self.times = bucket, times
        self.before = np.empty(len(times), np.int64)
        self.after = np.empty(len(times), np.int64)

    def run(self, at: int, end: int, level: int, last: int) -> tuple[int, int]:
        """Calls ``at`` to ``end`` from a level at a time; in bulk wherever that can be done.

        A row out of order earns no refill and does not move the clock back.
        """
        if end - at <= SHORT:
            return self._plain(at, end, level, last)
        full, refill, token = self.bucket.full, self.bucket.refill, self.bucket.token
        clock = np.maximum.accumulate(np.maximum(self.times[at:end], last))
        gaps = np.diff(clock, prepend=last)
        earned = np.minimum(np.minimum(gaps, full // refill + 1) * refill, full)
        base, size = at, SHORT
        while at < end:
            stop = min(at + size, end)
            part = earned[at - base : stop - base]
            done = self._never_short(at, stop, level, part)
            if done < min(SHORT, len(part)):
                done = max(done, self._never_full(at, stop, level, part))
            if done:
                at += done
                level, size = int(self.after[at - 1]), min(2 * size, 65536)
            if done < min(SHORT, len(part)):
                rest = min(at + SHORT, end)
                since = int(clock[at - base - 1]) if at > base else last
                level, _ = self._plain(at, rest, level, since)
                at, size = rest, SHORT
        return level, int(clock[-1])

    def output(self) -> dict:
        token, refill = self.bucket.token, self.bucket.refill
        allowed = self.before >= token
        wait = -((self.before - token) // (refill * 10**6))
        return {
            "tokens_before": self.before / token,
            "allowed": allowed,
            "retry_after_s": pa.array(wait, mask=allowed),
            "_after": self.after,
        }

    def _plain(self, at, end, level, last):
        full, refill, token = self.bucket.full, self.bucket.refill, self.bucket.token
        before, after = [], []
        for now in self.times[at:end].tolist():
            level = min(full, level + max(0, now - last) * refill)
            last = max(last, now)
            before.append(level)
            if level >= token:
                level -= token
            after.append(level)
        self.before[at:end], self.after[at:end] = before, after
        return level, last

    def _never_short(self, at, stop, level, earned) -> int:
        """How many calls from ``at`` on can be done at once, as each of them finds a token.

        Then only a full bucket loses refill, and the level is what it would be without that less
        the most that it would ever have been above full.
        """
        full, token, n = self.bucket.full, self.bucket.token, stop - at
        if full >= 2**62 // (n + 1):
            return 0
        free = np.cumsum(earned) - token * np.arange(n)
        before = free + np.minimum(np.minimum.accumulate(full - free), level)
        short = np.flatnonzero(before < token)
        good = int(short[0]) if len(short) else n
        self.before[at : at + good] = before[:good]
        self.after[at : at + good] = before[:good] - token
        return good

    def _never_full(self, at, stop, level, earned) -> int:
        """How many calls from ``at`` on can be done at once, as the bucket stays below full.

        Then the tokens taken so far are at most the calls so far and at most the whole tokens
        there have been, so the total taken is a running minimum of the latter.
        """
        full, token, n = self.bucket.full, self.bucket.token, stop - at
        if full >= 2**62 // (n + 1):
            return 0
        number = np.arange(1, n + 1)
        supply = level + np.cumsum(earned)
        taken = number + np.minimum(0, np.minimum.accumulate(supply // token - number))
        before = supply - token * np.append(0, taken[:-1])
        over = np.flatnonzero(before > full)
        good = int(over[0]) if len(over) else n
        self.before[at : at + good] = before[:good]
        self.after[at : at + good] = (supply - token * taken)[:good]
        return good


def bucket_fold(bucket: Bucket) -> Fold:
    refill, token, full = bucket.refill, bucket.token, bucket.full

    def replay(rows, fresh, state):
        times = rows.column("_us").to_numpy()
        walk = Walk(bucket, times)
        cuts = [0, *(i for i, new in enumerate(fresh) if new and i), len(times)]
        level, last = state or (full, 0)
        for at, end in zip(cuts, cuts[1:]):
            if fresh[at]:
                level, last = full, int(times[at])
            level, last = walk.run(at, end, level, last)
        return walk.output(), (level, last)

    def summarise(batches):
        first = last = None
        levels = LevelMap(full, token)
        for rows in batches:
            times = rows.column("_us").to_numpy()
            first = int(times[0]) if first is None else first
            gaps = np.diff(times, prepend=times[0] if last is None else last)
            levels.calls(np.minimum(np.minimum(gaps, full // refill + 1) * refill, full))
            last = int(times[-1])
        yield first, last, levels.pieces()

    def advance(state, summary):
        (level, before), (first, last, pieces) = state, summary
        arriving = min(full, level + (first - before) * refill)
        return LevelMap.apply(pieces, arriving), last

    def compose(summary, then):
        (first, before, pieces), (after, last, others) = summary, then
        levels = LevelMap(full, token, pieces)
        levels.refill(min(min(after - before, full // refill + 1) * refill, full))
        levels.then(others)
        return first, last, levels.pieces()

    return Fold(replay, summarise, advance, compose)


class LevelMap:
    """Level after a run of calls as a function of the level on arrival at its first call.

    Kept as pieces over the arrival level: on each the result is either constant or arrival
    level plus a shift. A full bucket merges levels and soon leaves one constant piece, which is
    then followed as a plain number.
    """

    def __init__(self, full: int, token: int, pieces=None):
        self.full, self.token = full, token
        self.start = np.array([0], dtype=np.int64)  # first arrival level of each piece
        self.value = np.array([0], dtype=np.int64)  # result there
        self.slope = np.array([True])  # grows with the arrival level?
        if pieces is not None:
            self.start, self.value, self.slope = pieces
        self.level = None  # the one result left, if so
        self._settle()

    def calls(self, refills: np.ndarray):
        """A run of calls, each after its refill; in bulk wherever the bucket stays below full."""
        at, size = 0, 64
        while at < len(refills):
            part = refills[at : at + size]
            at += len(part)
            if self.level is None and self._bulk(part):
                size = min(2 * size, 65536)
                continue
            size = 64 if self.level is None else 65536
            for refill in part.tolist():
                self.call(refill)

    def _bulk(self, refills: np.ndarray) -> bool:
        """All calls at once if no level can get near full; False leaves everything as it was.

        Below full, the tokens taken so far are at most the calls so far and at most the whole
        tokens there have been, so the total taken is a running minimum of the latter. Over the
        levels it depends on the whole tokens of a level and on one threshold of its fraction.
        """
        token, n = self.token, len(refills)
        if self.full >= 2**62 // (n + 1):
            return False
        number = np.arange(1, n + 1)
        supply = np.cumsum(refills)
        top = int((self.value + np.where(self.slope, self._sizes() - 1, 0)).max())
        whole = np.minimum.accumulate((top + supply) // token - number)
        taken = number + np.minimum(0, whole)
        before = top + supply - token * np.append(0, taken[:-1])
        if (before > self.full - token).any():
            return False
        spare = supply // token - number
        least = int(spare.min())
        threshold = token - int((supply % token)[spare == least].min())
        for base in range(0, top + 1, token):
            self._split(base)
            self._split(base + threshold)
        short = self.value // token + least + (self.value % token >= threshold)
        self.value = self.value + int(supply[-1]) - token * (n + np.minimum(0, short))
        self._merge()
        return True

    def call(self, refill: int):
        if self.level is not None:
            level = min(self.full, self.level + refill)
            self.level = level - self.token if level >= self.token else level
            return
        self.refill(refill)
        self._split(self.token)
        self.value = np.where(self.value >= self.token, self.value - self.token, self.value)
        self._merge()
        self._settle()

    def refill(self, refill: int):
        """Time passes; a full bucket stays full."""
        if self.level is not None:
            self.level = min(self.full, self.level + refill)
            self.value = np.array([self.level], dtype=np.int64)
            return
        self.value = self.value + refill
        self._split(self.full)
        capped = self.value >= self.full
        self.value = np.where(capped, self.full, self.value)
        self.slope = self.slope & ~capped

    def then(self, pieces):
        """The results go through another map: cut where it has its cuts, then each piece is in one
        piece of it."""
        start, value, slope = pieces
        for cut in start.tolist():
            self._split(cut)
        at = np.searchsorted(start, self.value, side="right") - 1
        self.value = value[at] + np.where(slope[at], self.value - start[at], 0)
        self.slope = self.slope & slope[at]
        self._merge()
        self._settle()

    def _settle(self):
        self.level = int(self.value[0]) if len(self.start) == 1 and not self.slope[0] else None

    def _sizes(self):
        return np.diff(np.append(self.start, self.full + 1))

    def _split(self, at: int):
        """Cut growing pieces where their result reaches ``at``."""
        inside = self.slope & (self.value < at) & (self.value + self._sizes() > at)
        (where,) = np.nonzero(inside)
        if len(where):
            starts = self.start[where] + (at - self.value[where])
            self.start = np.insert(self.start, where + 1, starts)
            self.value = np.insert(self.value, where + 1, at)
            self.slope = np.insert(self.slope, where + 1, True)

    def _merge(self):
        reach = self.value + np.where(self.slope, self._sizes(), 0)
        same = (self.slope[1:] == self.slope[:-1]) & (self.value[1:] == reach[:-1])
        if same.any():
            keep = np.append(True, ~same)
            self.start, self.value, self.slope = (
                self.start[keep], self.value[keep], self.slope[keep]
            )

    def pieces(self):
        if self.level is not None:
            return np.array([0]), np.array([self.level], dtype=np.int64), np.array([False])
        return self.start, self.value, self.slope

    @staticmethod
    def apply(pieces, arriving: int) -> int:
        start, value, slope = pieces
        i = int(np.searchsorted(start, arriving, side="right")) - 1
        return int(value[i]) + (arriving - int(start[i]) if slope[i] else 0)


RATE_OUTPUT = T.StructType(
    [
        T.StructField("tokens_before", T.DoubleType()),
        T.StructField("allowed", T.BooleanType()),
        T.StructField("retry_after_s", T.LongType()),
        T.StructField("_after", T.LongType()),
    ]
)


def rate_audit(
    calls: DataFrame,
    keys: list[str],
    rate=DEFAULT_RATE,
    burst=DEFAULT_BURST,
    order=("timestamp", "call_id"),
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Decide each call against its key's bucket; refused calls take no token.

    Adds the level before the call, the decision, and whole seconds to wait after a refusal.
    """
    timed = calls.withColumn("_us", F.unix_micros(order[0]))
    rule = bucket_fold(Bucket.of(rate, burst))
    order = ["_us", *order[1:]]
    return fold(timed, keys, order, rule, RATE_OUTPUT, max_group_rows).drop("_us", "_after")


def queue_delay(
    calls: DataFrame,
    keys: list[str],
    rate=DEFAULT_RATE,
    burst=DEFAULT_BURST,
    order=("timestamp", "call_id"),
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Seconds each call waits when every call queues for a token in arrival order.

    The n-th call of a key is served no sooner than (n - j + 1) token times after any earlier
    arrival j, so the finish time is a running maximum; a full bucket is worth ``burst`` times.
    """
    bucket = Bucket.of(rate, burst)
    # 64 bits hold the unit times of a trillion calls at plain rates; odd rates take decimals.
    plain = bucket.refill <= 1000 and bucket.token <= 4 * 10**6
    kind = "long" if plain else "decimal(38,0)"
    token, full, refill = (
        F.lit(n if plain else Decimal(n)) for n in (bucket.token, bucket.full, bucket.refill)
    )
    timed = calls.withColumn(
        "_at", (F.unix_micros(order[0]).cast("long" if plain else "decimal(20,0)") * refill)
    )

    def lead(column):
        return (F.col("_at") - (column("_n") - 1) * token).cast(kind)

    timed = running(
        timed, keys, list(order), {"_n": F.lit(1)}, {"_lead": lead}, max_group_rows
    )
    wait = F.col("_n") * token + F.col("_lead") - F.col("_at") - full
    seconds = F.greatest(wait, F.lit(0)).cast("double") / F.lit(float(bucket.refill * 10**6))
    return timed.withColumn("wait_s", seconds).drop("_at", "_n", "_lead")
