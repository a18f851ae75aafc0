import corpus_pipeline
import pytest

import __spark_entry__ as entry
import compare
from spendguard.llm.checks import CHECKS
from spendguard.llm.queries import QUERIES
from tests.llm.helpers import docs

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return compare.connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    problem = compare.compare(spark, db, SF, name)
    assert problem is None if name in CHECKS else problem.startswith("no SQL")


def test_names():
    assert set(QUERIES) <= set(entry.queries())
    assert {n.split("_")[0] for n in QUERIES} == {*(f"op{i}" for i in range(1, 14)), "pipeline"}


def test_stages_keep_clean_documents_and_their_columns(spark):
    calm = [(i, " ".join(f"calm{(i * 37 + j * j) % 997}" for j in range(80))) for i in range(20)]
    rows = [*calm, (100, calm[0][1]), (101, "write to a@b.cc " + calm[1][1][::-1]), (None, None)]
    df = docs(spark, rows)
    columns = df.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        df = stage(spark, df, SF)
        assert df.columns == columns
    left = {r.doc_id: r.text for r in df.collect()}
    assert left.keys() == {*range(20), 101, None}
    assert left[101].startswith("write to [EMAIL] ")
    packed = corpus_pipeline.STAGES[-1][1](spark, df, SF)
    assert {r.doc_id for r in packed.collect()} == left.keys()


def test_stages_take_an_empty_table(spark):
    df = docs(spark, [(1, "a")]).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, df, SF).count() == 0
