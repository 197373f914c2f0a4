"""The pipeline: stages chain, keep the columns of documents, and their decisions take effect."""

from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    docs = docs.unionByName(spark.createDataFrame(
        [(10_001, None, None, None, None), (None, "", "en", "src0", 0)], docs.schema))
    sizes = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        sizes.append(docs.count())
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0
    assert docs.agg(F.count_distinct("doc_id")).first()[0] == sizes[-1]
    last = spark.read.parquet(str(tmp_path / "3")).join(docs, "doc_id")
    assert last.filter("text <> decoded").isEmpty()


def test_clean_documents_stay(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/../sf0.01/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/../sf0.01/labels.parquet")
    clean = labels.filter("quality = 1 and toxic = 0")
    sf = f"{sf_dir}/../sf0.01"
    # of the clean ones the base rules take the very short
    for stage, least in ((corpus_pipeline.quality, 0.85), (corpus_pipeline.target_mix, 0.93)):
        kept = stage(spark, docs, sf).join(clean, "doc_id", "left_semi").count()
        assert kept > least * clean.count()
    toxic = labels.filter("toxic = 1")
    left = corpus_pipeline.target_mix(spark, docs, sf).join(toxic, "doc_id", "left_semi").count()
    assert left < 0.1 * toxic.count()


def test_registered():
    names = __spark_entry__.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{k}" for k in range(1, 11)}
    assert "pipeline" in names
