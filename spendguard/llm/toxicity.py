"""Toxicity by a linear classifier that is regularised with counterfactuals.

A document's features are the distinct words it holds and the distinct beginnings of words (``PREFIXES`` bytes), by
hash. The classifier is a logistic regression on the ``FEATURES`` features that differ most between the classes. It is
fitted on at most ``SAMPLE`` labelled documents, a documented bound, chosen by a hash of their id, so that neither the
work nor what reaches the driver grows with the corpus. Scoring reads every whole text.

Counterfactuals: in each sampled text, every identity term is swapped for its counterpart (women and men, ...). With
the original x and the swapped x', training adds ``SWAP`` times the mean square of w.x - w.x', so that a mention of a
group does not carry weight by itself. Texts without such terms add nothing.

Defined cases: a null or empty text is scored by its prior; labels that are null or whose document is missing are left
out; of several labels of one id the largest counts; without labels of both classes every score is the share of toxic
ones (0 without any). Repeated rows give repeated rows; an empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from spendguard.llm import words
from spendguard.runtime import checkpointed

SAMPLE = 16_000
FEATURES = 4096
BITS = 22
PREFIXES = (5, 6, 7, 8, 10)
SWAP = 1.0
RIDGE = 2e-4
STEPS = 300

#: Identity terms and their counterparts, in the languages of the corpus.
IDENTITY = [
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("girl", "boy"), ("female", "male"), ("she", "he"),
    ("gay", "straight"), ("lesbian", "heterosexual"), ("transgender", "cisgender"), ("black", "white"),
    ("muslim", "christian"), ("muslims", "christians"), ("jewish", "catholic"), ("jews", "catholics"),
    ("immigrant", "native"), ("immigrants", "natives"), ("african", "european"), ("old", "young"),
    ("disabled", "healthy"), ("femmes", "hommes"), ("femme", "homme"), ("noir", "blanc"), ("musulman", "chrétien"),
    ("frauen", "männer"), ("frau", "mann"), ("muslime", "christen"), ("schwarze", "weiße"), ("mujeres", "hombres"),
    ("mujer", "hombre"), ("negro", "blanco"), ("musulmanes", "cristianos"),
]
_OTHER = {a: b for x, y in IDENTITY for a, b in ((x, y), (y, x))}
_TERMS = re.compile(r"\b(?:" + "|".join(sorted(_OTHER, key=len, reverse=True)) + r")\b")


def swapped(text: str) -> str:
    """The text in lower case with every identity term replaced by its counterpart."""
    return _TERMS.sub(lambda m: _OTHER[m.group()], text.lower())


def features(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(doc, feature)`` of every word and word beginning, chunk by chunk, repeats included."""
    mask = np.uint64((1 << BITS) - 1)
    for doc, start, end, total, _ in words.chunks(texts):
        yield doc, (words.hashes(total, start, end) & mask).astype(np.int64)
        for k in PREFIXES:
            at = end - start > k
            salt = np.uint64(k << 40)
            h = words.mixed(words.hashes(total, start[at], start[at] + k) ^ salt)
            yield doc[at], (h & mask).astype(np.int64)


def feature_sets(texts: list[str], only: np.ndarray | None = None) -> list[np.ndarray]:
    """The distinct features of each text; of those marked in ``only``, if given."""
    found = []
    for doc, feature in features(texts):
        if only is not None:
            hit = only[feature]
            doc, feature = doc[hit], feature[hit]
        found.append(np.unique((doc << BITS) | feature))
    both = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    cuts = np.searchsorted(both, np.arange(1, len(texts)) << BITS)
    return [part & ((1 << BITS) - 1) for part in np.split(both, cuts)] if len(texts) else []


@dataclass(frozen=True)
class Model:
    """``weight[i]`` belongs to feature ``feature[i]``."""

    feature: np.ndarray
    weight: np.ndarray
    bias: float

    def scores(self, texts: list[str]) -> np.ndarray:
        table = np.zeros(1 << BITS, np.float32)
        table[self.feature] = self.weight
        sets = feature_sets(texts, table != 0)
        z = self.bias + np.array([table[s].sum(dtype=np.float64) for s in sets])
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def in_fold(id_: Column) -> Column:
    """Whether a row is held out: the crc32 of its id as text is a multiple of 5."""
    return F.coalesce(F.crc32(id_.cast("string")) % 5 == 0, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame, size: int) -> DataFrame:
    """``(doc_id, y, text)`` of at most ``size`` labelled documents that are not held out; of rows that share an id the
    one whose text has the least hash, so that the bound is one of rows and no id outweighs the others."""
    known = labels.where("doc_id is not null and toxic is not null").where(~in_fold(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("y"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)
    # At most ``size`` rows of two numbers are broadcast.
    found = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id", "y").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))


def _train(x: list[np.ndarray], y: np.ndarray, swaps: list[tuple[int, np.ndarray]], n: int) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam on the whole sample. ``swaps``: a row's number and its swapped features."""

    def rows(sets):
        return np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.concatenate([*sets, np.zeros(0, int)]).astype(int)

    r, c = rows(x)
    sr, sc = rows([s for _, s in swaps])
    of = np.array([i for i, _ in swaps], int)
    w, b = np.zeros(n), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    m, v = np.zeros(n + 1), np.zeros(n + 1)
    for step in range(1, STEPS + 1):
        z = np.bincount(r, w[c], len(x))
        miss = 1 / (1 + np.exp(-np.clip(z + b, -30, 30))) - y
        g = np.bincount(c, miss[r], n) / len(x) + RIDGE * w
        if swaps:
            change = np.zeros(len(x))
            change[of] = z[of] - np.bincount(sr, w[sc], len(swaps))
            g += 2 * SWAP / len(swaps) * (np.bincount(c, change[r], n) - np.bincount(sc, change[of][sr], n))
        g = np.append(g, miss.mean())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def fit(docs: DataFrame, labels: DataFrame, size: int = SAMPLE, n_features: int = FEATURES) -> Model:
    """A model of the labels that are not held out."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t.lower() for t in batch.text]
            other = [swapped(t) if _TERMS.search(t) else None for t in texts]
            sets = feature_sets(texts)
            swaps = feature_sets([t or "" for t in other])
            yield pd.DataFrame(
                {
                    "doc_id": batch.doc_id,
                    "y": batch.y,
                    "x": [s.tolist() for s in sets],
                    "swap": [s.tolist() if t is not None else None for s, t in zip(swaps, other, strict=True)],
                }
            )

    schema = "doc_id long, y int, x array<int>, swap array<int>"
    sample = checkpointed(_sample(docs, labels, size).mapInPandas(read, schema))
    sizes = {r.y: r.n for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    if not n0 or not n1:
        share = n1 / max(1, n0 + n1)
        return Model(np.zeros(0, np.int64), np.zeros(0), float(np.log((share + 1e-12) / (1 - share + 1e-12))))
    each = sample.select("y", F.explode("x").alias("feature")).groupBy("feature")
    counted = each.agg(F.sum("y").alias("k1"), F.sum(1 - F.col("y")).alias("k0")).where("k1 + k0 >= 3")
    share = (F.col("k1") + F.col("k0")) / F.lit(n0 + n1)
    differs = F.abs(F.col("k1") / n1 - F.col("k0") / n0) / F.sqrt(share * (1 - share) + 1e-9)
    best = counted.orderBy(differs.desc(), "feature").limit(n_features).select("feature").collect()
    chosen = np.sort(np.array([r.feature for r in best], np.int64))
    return _fit_on(sample, chosen)


def _fit_on(sample: DataFrame, chosen: np.ndarray) -> Model:
    """Fit on the chosen features; at most ``SAMPLE`` short lists reach the driver."""

    def only(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name in ("x", "swap"):
                batch[name] = [
                    None if s is None else np.searchsorted(chosen, np.intersect1d(s, chosen)).tolist() for s in batch[name]
                ]
            yield batch

    rows = sample.mapInPandas(only, sample.schema).orderBy("doc_id").collect()
    x = [np.array(r.x, int) for r in rows]
    swaps = [(i, np.array(r.swap, int)) for i, r in enumerate(rows) if r.swap is not None]
    weight, bias = _train(x, np.array([r.y for r in rows], float), swaps, len(chosen))
    return Model(chosen, weight.astype(np.float32), bias)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """All rows and columns of ``docs``, with ``score`` (0 to 1) from the whole ``text``."""

    @pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(model.scores([t or "" for t in texts]))

    return docs.withColumn("score", of(F.col("text")))


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every document."""
    model = fit(docs, labels)
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", in_fold(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def reject_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier does not call toxic, with their columns."""
    model = fit(docs, labels)

    @pandas_udf("boolean")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(model.scores([t or "" for t in texts]) < 0.5)

    return docs.where(clean(F.col("text")))
