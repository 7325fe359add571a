import corpus_pipeline as cp
import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def sf_dir(spark, docs, doc_rows, tmp_path_factory):
    out = tmp_path_factory.mktemp("sf")
    item = " ".join(f"q{i}" for i in range(30))
    rows = [(r[0], r[1], r[2], r[3], r[4]) for r in doc_rows] + [(900 + i, " ".join(f"d{i}_{j}" for j in range(60)) + " " + item, "en", "src1", 5) for i in range(5)]
    rows += [(950 + i, " ".join(f"e{i}_{j}" for j in range(80)), "en", f"src{i % 3}", 5) for i in range(30)]
    spark.createDataFrame(rows, docs.schema).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    spark.createDataFrame([(950 + i, 1, 0) for i in range(30)] + [(r[0], 1, 0) for r in doc_rows], "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    return f"file://{out}"


def test_stages(spark, sf_dir, docs):
    pytest.importorskip("public_tokenizers")
    frame, seen = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in cp.STAGES:
        frame = stage(spark, frame, sf_dir)
        frame = cp.common.staged(frame)
        seen.append((name, frame))
        if name != "tokens":
            assert frame.columns == docs.columns
    by = dict(seen)
    assert by["quality"].where(F.size(F.split("text", r"\s+")) < 50).count() == 0
    assert by["near_dedup"].groupBy(F.md5("text")).count().where("count > 1").count() == 0
    assert by["decontaminate"].where("doc_id between 900 and 904").count() == 0
    assert by["decontaminate"].where("doc_id between 950 and 979").count() == 30
    assert by["tokens"].count() == by["mix"].count()
    assert cp.run(spark, sf_dir).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_clashing_names(spark, sf_dir, docs):
    names = ["_k", "_i", "_d", "_h", "_w", "_b", "_row", "row", "label", "root", "text_key", "kept"]
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("*", *[f"'x' as {n}" for n in names])
    for name, stage in cp.STAGES[:-1]:
        frame = cp.common.staged(stage(spark, frame, sf_dir))
        assert frame.columns == [*docs.columns, *names], name
    assert frame.count()


def test_staged_folders_can_be_dropped(spark):
    from geolist.llm import common

    kept = common.staged(spark.range(3))
    path = common._MADE[-1]
    common.staged(spark.range(4))
    assert common.drop_staged(spark, keep=[path]) > 0
    assert kept.count() == 3 and common._MADE == [path]


def test_empty(spark, tmp_path, docs):
    spark.createDataFrame([], docs.schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    pytest.importorskip("public_tokenizers")
    assert cp.run(spark, f"file://{tmp_path}").count() == 0
