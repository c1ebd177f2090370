"""Runs become readable as a whole, also when a job dies between two tables."""

import pytest
from pyspark.sql import functions as F

from callcorpus.sources import manifest as M


def two(spark, n):
    df = spark.range(n).select(F.concat(F.lit("t"), "id").alias("text"))
    return {"train": df, "val": df.limit(1)}


def texts(spark, out, table, run=None):
    return M.read_run(spark, out, table, "text string", run).count()


def test_a_killed_run_leaves_the_previous_one(spark, tmp_path):
    out = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        texts(spark, out, "train")
    assert M.write_run(two(spark, 5), out, "r1")
    broken = {**two(spark, 9), "val": spark.range(1).select(F.raise_error(F.lit("killed")).cast("string").alias("text"))}
    with pytest.raises(Exception, match="killed"):
        M.write_run(broken, out, "r2")
    assert (texts(spark, out, "train"), texts(spark, out, "val")) == (5, 1)
    assert {r.run_id for r in M.runs(spark, out).collect()} == {"r1"}
    assert M.write_run(two(spark, 9), out, "r2")  # the same run again
    assert (texts(spark, out, "train"), texts(spark, out, "train", "r1")) == (9, 5)


def test_a_run_is_written_once(spark, tmp_path):
    out = str(tmp_path)
    assert M.write_run(two(spark, 3), out, "batch=7")
    assert not M.write_run(two(spark, 8), out, "batch=7")
    assert texts(spark, out, "train") == 3


def test_streams_commit_a_run_per_batch(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    two(spark, 6)["train"].write.parquet(src)

    def sink(df, batch):
        M.write_run({"details": df, "counts": df.groupBy().count()}, out, f"batch={batch}")
        M.write_run({"details": df, "counts": df.groupBy().count()}, out, f"batch={batch}")  # a replay

    q = spark.readStream.schema("text string").parquet(src).writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert M.read_run(spark, out, "counts", "count long").collect()[0][0] == 6
    assert M.runs(spark, out).count() == 2


def test_a_prepared_corpus_is_one_run(spark, tmp_path):
    from callcorpus.plans import jobs

    raw = spark.createDataFrame(
        [(i, f"q{i}", "[]", '[{"name": "f", "arguments": {"k": %d}}]' % i) for i in range(40)], "id long, query string, tools string, answers string"
    )
    jobs.prepare_corpus(spark, raw, "org/xlam-calls", output_dir=str(tmp_path), run_id="r1")
    assert (texts(spark, str(tmp_path), "train"), texts(spark, str(tmp_path), "val")) == (38, 2)
