"""Sinks: split JSONL corpora, per-model results, summaries (K1-K5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import clean_model_name


def write_splits(df: DataFrame, output_dir: str, dataset_name: str, split_col: str = "split", fmt: str = "json") -> str:
    """K1/K2: one folder of part files per split, ``{output_dir}/{clean}_{split}.jsonl/``.

    ``readers.read_training_splits(spark, output_dir)`` reads them back. Rows keep only
    ``text``; ``fmt`` picks another format, which then also names the folders. Each task
    writes its own part; no split is gathered. Returns ``{output_dir}/{clean}``.
    """
    clean = dataset_name.replace("/", "_").replace("-", "_")
    path = f"{output_dir.rstrip('/')}/{clean}"
    suffix = "jsonl" if fmt == "json" else fmt
    for row in df.select(split_col).distinct().collect():  # a row per split
        part = df.filter(F.col(split_col).eqNullSafe(F.lit(row[0]))).select("text")
        part.write.mode("overwrite").format(fmt).save(f"{path}_{row[0]}.{suffix}")
    return path


def run_dir(output_dir: str, table: str, run_ts: str) -> str:
    """Where one run writes a table: ``{output_dir}/{table}/run=<stamp>``. Other runs' folders
    are never touched, and reading ``{output_dir}/{table}`` gives all runs."""
    stamp = "".join(c if c.isalnum() else "_" for c in run_ts) or "none"
    return f"{output_dir.rstrip('/')}/{table}/run={stamp}"


def write_model_results(details: DataFrame, board: DataFrame, output_dir: str, run_ts: str) -> str:
    """K3: per-model results of one run, partitioned by the cleaned model name.

    ``details`` (one row per case) and the counters go to two tables instead of one
    JSON document per model holding every detail in memory. Writing a run again
    replaces that run only.
    """
    safe = clean_model_name("model_name")
    details.withColumn("model_safe", safe).withColumn("run_ts", F.lit(run_ts)).write.mode("overwrite").partitionBy("model_safe").json(run_dir(output_dir, "details", run_ts))
    board.withColumn("model_safe", safe).withColumn("timestamp", F.lit(run_ts)).write.mode("overwrite").partitionBy("model_safe").json(run_dir(output_dir, "results", run_ts))
    return output_dir.rstrip("/")


def write_summary(summary_doc: DataFrame, output_dir: str, run_ts: str = "") -> str:
    """K4: the one-row cross-model summary document of one run."""
    path = run_dir(output_dir, "summary", run_ts)
    summary_doc.coalesce(1).write.mode("overwrite").json(path)
    return path
