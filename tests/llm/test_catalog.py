"""The registered operator queries against their SQL, and the pipeline."""

import pytest

import corpus_pipeline
from linkloom.llm import catalog
from linkloom.llm.common import table


def shown(rows, names):
    order = [names.index(n) for n in sorted(names)]
    return sorted(tuple(str(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_matches_sql(spark, duck, folder, name):
    result = catalog.QUERIES[name](spark, folder)
    answer = duck.execute(catalog.ORACLES[name])
    names = [c[0] for c in answer.description]
    assert sorted(names) == sorted(result.columns)
    assert shown(result.collect(), result.columns) == shown(answer.fetchall(), names)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_one_row_for_each(spark, folder, name):
    source = {"op1": "pages", "op12": "conversations"}.get(name.split("_")[0], "documents")
    n = catalog.QUERIES[name](spark, folder).count()
    rows = table(spark, folder, source)
    whole = rows.select("conv_id").distinct().count() if source == "conversations" else rows.count()
    assert n >= whole if name.startswith("op7_") else n == whole


def test_pipeline(spark, folder):
    docs = table(spark, folder, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == columns, name
        kept = out.select("doc_id").distinct().count()
        assert 0 < kept <= docs.count()
        docs = spark.createDataFrame(out.collect(), out.schema)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).select("doc_id").distinct().count() == docs.count()


def test_pipeline_stages_take_odd_rows(spark, folder):
    rows = [(1, None, None, None, None), (1, "", "en", "s", 0), (None, "some words " * 30, "en", "s", 330),
            (2, " ".join(f"w{k}" for k in range(80)), "en", "s", 1), (2, " ".join(f"w{k}" for k in range(80)), "en", "s", 1)]
    odd = spark.createDataFrame(rows, table(spark, folder, "documents").select("doc_id", "text", "lang", "source", "n_chars").schema)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, odd, folder).collect()
        stage(spark, odd.filter("false"), folder).collect()
