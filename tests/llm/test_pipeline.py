import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import __spark_entry__ as entry
from sluice.llm import queries


def test_stages_pass_on_the_columns_of_documents(spark):
    base = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{base}/documents.parquet")
    first = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, base)
        assert kept.schema.simpleString() == first.schema.simpleString(), name
        ids = {r.doc_id for r in kept.select("doc_id").collect()}
        assert ids <= {r.doc_id for r in docs.select("doc_id").collect()} and ids
        docs = spark.createDataFrame(kept.collect(), kept.schema)
    pieces = corpus_pipeline.run(spark, base)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == ids


def test_registered():
    names = set(entry.queries())
    assert set(queries.QUERIES) <= names and set(queries.ORACLE) <= set(queries.QUERIES)
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names
    assert "daily_summary" in names


def test_rows_without_id_and_of_one_id_have_their_own_decisions(spark, make, prose):
    import corpus_pipeline as cp
    from sluice.llm.decontaminate import drop_contaminated
    from sluice.llm.quality import keep_good

    item, base, other = prose(1, 40), prose(2, 300), prose(3, 300)
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(None, base + " " + item), (None, other), (7, item), (7, other), (None, None)]
    kept = [(r.doc_id, r.text) for r in drop_contaminated(spark, make(rows), bench).collect()]
    assert sorted(kept, key=repr) == sorted([(None, other), (7, other), (None, None)], key=repr)

    rows = [(None, base), (None, base), (5, base), (5, other), (6, other), (None, prose(4, 200)), (8, prose(4, 200).upper())]
    kept = [(r.doc_id, r.text) for r in cp.near_copies(spark, make(rows), "").collect()]
    assert sorted(kept) == sorted([(5, base), (5, other), (8, prose(4, 200).upper())])
    kept = [(r.doc_id, r.text) for r in cp.near_copies(spark, make([(None, base), (None, base), (None, other)]), "").collect()]
    assert sorted(kept, key=repr) == sorted([(None, base), (None, other)], key=repr)

    trusted = [(i, " ".join(prose(9, 400).split()[i : i + 200])) for i in range(150)]
    bad = " ".join(f"q{i}z" for i in range(200))
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in trusted], "doc_id long, quality int, toxic int")
    docs = make(trusted + [(None, bad), (None, trusted[3][1]), (500, bad), (500, trusted[3][1])])
    kept = [(r.doc_id, r.text) for r in keep_good(spark, docs, labels).collect() if r.doc_id is None or r.doc_id == 500]
    assert sorted(kept, key=repr) == sorted([(None, trusted[3][1]), (500, trusted[3][1])], key=repr)


CLASHING = ("gone_id", "gone_key", "gone_lang", "one_id", "one_key", "own_id", "own_key", "own_lang", "row", "text_key", "needed", "fp")


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_let_columns_have_any_name(spark, name, tmp_path):
    base = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{base}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)[name]
    extra = docs.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHING)])
    kept = stage(spark, extra, base)
    assert kept.columns == extra.columns
    ids = sorted(r.doc_id for r in kept.select("doc_id").collect())
    assert ids == sorted(r.doc_id for r in stage(spark, docs, base).select("doc_id").collect())


def test_packing_lets_columns_have_any_name(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(20)
    extra = docs.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHING)])
    assert corpus_pipeline.packing(spark, extra, "").count() == corpus_pipeline.packing(spark, docs, "").count()
