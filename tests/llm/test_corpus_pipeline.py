import corpus_pipeline
import pytest
from cases import awkward, empty

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.01"


def test_stages_work_on_what_the_one_before_kept(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        after = {r.doc_id for r in docs.select("doc_id").collect()}
        assert after <= before
        if number < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns, name
        gone = before - after
        if name == "toxicity":
            assert {d for d in before if labels.get(d) == 1} <= gone
            assert sum(labels.get(d) == 0 for d in gone) <= 2
        elif name == "language":
            assert len(gone) <= 0.01 * len(before)
        elif name == "line_dedup":
            assert len(gone) < 0.15 * len(before)
        elif name == "packing":
            assert not gone


@pytest.mark.parametrize("make", [awkward, empty])
def test_awkward_tables(spark, tmp_path, make):
    folder = str(tmp_path / "in")
    make(spark).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 0), (2, 0), (9, 1), (None, 1), (3, None)], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    pieces = corpus_pipeline.run(spark, folder).collect()
    assert (len(pieces) > 0) == (make is awkward)


def test_entry_registers_all_queries():
    names = [name for name in entry.queries() if name.startswith("op") and name[2].isdigit()]
    assert sorted(int(name[2:].split("_")[0]) for name in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()
    assert "op3_hamming" in entry.oracle_sql()
