"""Readers: driver tables, JSONL case files, training splits, catalogs, registries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions import jsonx as J
from ..functions.text import py_strip


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin a scan across the cores only when it has fewer splits than cores.

    A cluster reading large inputs gets thousands of splits and skips this; a
    small single-row-group file (one split) would otherwise run its row-local,
    CPU-heavy expressions in one task.
    """
    try:
        target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()
    except Exception:  # sessions without RDD access (e.g. Spark Connect): leave the scan as is
        return df
    if splits < target:
        return df.repartition(target)
    return df


def read_table(spark: SparkSession, path: str, spread_small: bool = True, task_rows: int | None = None) -> DataFrame:
    """Parquet table scan (column pruning and filters push into the scan). ``task_rows``: rows
    of one task at most (about), for work that costs much more per row than the scan; they are
    counted from the files' footers, so that tasks grow in number and not in length."""
    df = spark.read.parquet(path)
    if task_rows:
        return spread(df, max(spark.sparkContext.defaultParallelism, -(-df.count() // task_rows)))
    return spread(df) if spread_small else df


def read_dataset(spark: SparkSession, path: str, fmt: str = "parquet", split: str | None = None, split_col: str = "split",
                 split_layout: str = "column") -> DataFrame:
    """S1 scan part of ``load_and_format_dataset``: a named dataset and split.

    ``split_layout="subdir"`` reads ``path/<split>``; ``"column"`` filters ``split_col``
    (pruned at the scan when it is a partition column). Hub download is not built:
    the data is read from storage.
    """
    if split is not None and split_layout == "subdir":
        return spark.read.format(fmt).load(f"{path.rstrip('/')}/{split}")
    df = spark.read.format(fmt).load(path)
    if split is not None and split_col in df.columns:
        df = df.filter(F.col(split_col) == split)
    return df


def read_eval_cases(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """S2 ``load_eval_dataset``: JSONL, one object per line; ``example_id`` is the line's
    0-based position over all files, in path order.

    ``expected_output`` stays JSON text (argument keys differ per row). In FAILFAST
    mode a blank or invalid line raises, as in the reference; ``mode="PERMISSIVE"``
    returns such lines with ``bad_line`` set instead.
    """
    # a line's place is its file, the block of the file that holds it, and its order in that
    # block. One task reads a block from its start, so the order is the line's number less that
    # of the block's first line; only one count per block is added up
    placed = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_order"), "value",
    )
    blocks = placed.groupBy("_file", "_block").agg(F.min("_order").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    lines = placed.join(blocks.withColumn("_before", before), ["_file", "_block"]).withColumn("example_id", F.col("_before") + F.col("_order") - F.col("_first"))
    # each line is loaded after ``strip()``; it must hold one JSON object
    line = py_strip(F.col("value"))
    ok = J.json_loads_ok(line) & line.startswith("{")
    out = lines.select(
        "example_id",
        F.get_json_object(line, "$.command").alias("command"),
        J.py_dumps_at(line, "$.expected_output").alias("expected"),
        (~F.coalesce(ok, F.lit(False))).alias("bad_line"),
        F.col("value").alias("line"),
    )
    if mode == "FAILFAST":
        bad = out.filter("bad_line").select("line").limit(1).collect()
        if bad:
            raise ValueError(f"invalid JSON line in {path}: {bad[0]['line'][:100]!r}")
        return out.drop("bad_line", "line")
    return out


def read_training_splits(spark: SparkSession, data_path: str, train_glob: str = "*_train.jsonl", val_glob: str = "*_val.jsonl") -> DataFrame:
    """S3 ``load_training_data``: train/validation file globs unioned with a ``split`` column."""
    def part(glob: str, name: str) -> DataFrame:
        return spark.read.schema("text string").json(f"{data_path}/{glob}").withColumn("split", F.lit(name))

    return part(train_glob, "train").unionByName(part(val_glob, "validation"))


def read_training_files(spark: SparkSession, train_file: str, val_file: str) -> DataFrame:
    """S4 device variant: fixed file names."""
    tr = spark.read.schema("text string").json(train_file).withColumn("split", F.lit("train"))
    va = spark.read.schema("text string").json(val_file).withColumn("split", F.lit("validation"))
    return tr.unionByName(va)


def read_tool_catalog(spark: SparkSession, path: str) -> DataFrame:
    """A multi-line JSON catalog document -> ``(device, version, description, tools_json)``.

    The whole file is one JSON document (a config, not data), read with
    ``wholetext``; tool order and property order stay in the JSON text.
    """
    doc = spark.read.text(path, wholetext=True)
    return doc.select(
        F.coalesce(F.get_json_object("value", "$.device"), F.lit("device")).alias("device"),
        F.get_json_object("value", "$.version").alias("version"),
        F.get_json_object("value", "$.description").alias("description"),
        F.get_json_object("value", "$.tools").alias("tools_json"),
    )


def read_models_config(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Model registry rows ``(ord, name, model_id, description, enabled)`` and the
    one-row ``default_settings``."""
    doc = spark.read.option("multiLine", "true").json(path)
    models = doc.select(F.posexplode("models").alias("ord", "m")).select(
        F.col("ord").cast("long").alias("ord"),
        F.col("m.name").alias("name"),
        F.col("m.model_id").alias("model_id"),
        F.col("m.description").alias("description"),
        F.col("m.enabled").alias("enabled"),
    )
    return models, doc.select("default_settings.*")


def read_teacher_replies(spark: SparkSession, path: str) -> DataFrame:
    """U1 input: teacher replies ``(batch_id, content)`` from JSONL files -- one file per
    call or many calls per file; a multi-file scan is the batch concatenation."""
    return spark.read.schema("batch_id long, content string").json(path)
