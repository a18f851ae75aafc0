import random
import zlib

import numpy as np
import pytest

from spendguard.llm import toxicity
from tests.llm.helpers import docs


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(12)
    calm = [f"word{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(900):
        words = rng.choices(calm, k=rng.randint(5, 60))
        toxic = rng.random() < 0.2
        if toxic:
            words += rng.choices(["idiotic", "scum", "vermin"], k=2)
        # A group is named in most toxic texts and in few others: the labels' bias.
        if rng.random() < (0.8 if toxic else 0.1):
            words.append(rng.choice(["muslims", "muslims", "muslims", "christians"]))
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def fitted(spark, corpus, swap):
    rows, labels = corpus
    old, toxicity.SWAP = toxicity.SWAP, swap
    try:
        table = spark.createDataFrame(labels, "doc_id long, toxic int").selectExpr("*", "'x' AS text", "1 AS y")
        return toxicity.fit(docs(spark, rows), table)
    finally:
        toxicity.SWAP = old


def test_held_out_documents(spark, corpus):
    rows, labels = corpus
    table = spark.createDataFrame([*labels, (5, None), (None, 1), (99999, 1)], "doc_id long, toxic int")
    extra = [(None, "scum"), (2000, None), (2001, ""), (2001, "")]
    got = toxicity.judge(docs(spark, [*rows, *extra]), table).collect()
    assert len(got) == len(rows) + len(extra)
    toxic = dict(labels)
    held = [r for r in got if r.held_out and r.doc_id in toxic]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    assert np.mean([r.predicted == toxic[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)


def test_counterfactuals_take_the_weight_off_identity_terms(spark, corpus):
    gap = []
    for swap in (0.0, 50.0):
        model = fitted(spark, corpus, swap)
        a, b = model.scores(["word1 word2 muslims word3", "word1 word2 christians word3"])
        gap.append(abs(np.log(a / (1 - a)) - np.log(b / (1 - b))))
    assert gap[0] > 0.3 and gap[1] < 0.3 * gap[0]


def test_scores_do_not_see_other_columns_or_chunks(spark, corpus, monkeypatch):
    model = fitted(spark, corpus, 1.0)
    texts = [t for _, t in corpus[0][:50]] + ["", "scum " * 5000]
    whole = model.scores(texts)
    monkeypatch.setattr(toxicity.words, "CHUNK", 64)
    assert np.allclose(model.scores(texts), whole)


def test_rejection_and_missing_labels(spark, corpus):
    rows, labels = corpus
    df = docs(spark, rows)
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    kept = toxicity.reject_toxic(df, table)
    assert kept.columns == df.columns
    left = {r.doc_id for r in kept.select("doc_id").collect()}
    assert np.mean([(i in left) != bool(y) for i, y in labels]) > 0.95
    for none in (table.limit(0), table.where("toxic = 0")):
        assert toxicity.reject_toxic(df, none).count() == len(rows)
    assert toxicity.judge(df.limit(0), table).count() == 0
    assert [len(x) for x in toxicity.feature_sets([])] == []


def test_an_id_on_many_rows_counts_once(spark, corpus):
    """One labelled id on a third of all rows, and in several texts: the sample is as without it."""
    rows, labels = corpus
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    hot = next(i for i, _ in labels if zlib.crc32(str(i).encode()) % 5)
    more = [(hot, rows[hot][1])] * 300 + [(hot, f"another text {k % 7}") for k in range(150)] + [(hot, None)] * 20
    sample = toxicity._sample(docs(spark, [*rows, *more]), table, 16_000).collect()
    assert len(sample) == len({r.doc_id for r in sample}) == sum(zlib.crc32(str(i).encode()) % 5 > 0 for i, _ in labels)
    few = toxicity._sample(docs(spark, [*rows, *more]), table, 50).collect()
    assert len(few) <= 50
