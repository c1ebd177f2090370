"""Run manifests: tables of one run become readable together (K1-K4)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

SCHEMA = "run_id string, table string, path string, format string, at timestamp"


def _folder(output_dir: str) -> str:
    return f"{output_dir.rstrip('/')}/_runs"


def runs(spark: SparkSession, output_dir: str) -> DataFrame:
    """(run_id, table, path, format, at) of every committed run; empty before the first."""
    try:
        found = spark.read.schema(SCHEMA).json(_folder(output_dir))
        found.isEmpty()
        return found
    except Exception as e:  # the folder is made by the first commit
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], SCHEMA)


def write_run(tables: dict[str, DataFrame], output_dir: str, run_id: str, fmt: str = "json") -> bool:
    """Write all tables of a run, then commit them with one manifest.

    Each attempt writes to a folder of its own, so a job that is killed between two tables
    leaves rows that no manifest names and every earlier run stays readable. The manifest is
    one file of one write: readers see all of the run's tables or none. A run id that is
    committed already is not written again (``foreachBatch`` passes the batch's id); returns
    whether this call committed it. Of two attempts that commit at once the first counts.
    """
    spark = next(iter(tables.values())).sparkSession
    if not runs(spark, output_dir).filter(F.col("run_id") == run_id).isEmpty():
        return False
    attempt = f"{output_dir.rstrip('/')}/_data/{uuid.uuid4().hex}"
    for name, df in tables.items():
        df.write.format(fmt).save(f"{attempt}/{name}")
    rows = [(run_id, name, f"{attempt}/{name}", fmt) for name in tables]
    made = spark.createDataFrame(rows, "run_id string, table string, path string, format string")
    made.coalesce(1).withColumn("at", F.current_timestamp()).write.mode("append").json(_folder(output_dir))
    return True


def read_run(spark: SparkSession, output_dir: str, table: str, schema: str, run_id: str | None = None) -> DataFrame:
    """A table of a committed run (the latest one by default)."""
    of = runs(spark, output_dir).filter(F.col("table") == table)
    if run_id is not None:
        of = of.filter(F.col("run_id") == run_id)
    # the latest run; of one run the first attempt. One row reaches the driver
    latest = of.orderBy(F.col("at").desc()).limit(1) if run_id is None else of.limit(1)
    named = latest.select("run_id").first()
    if named is None:
        raise FileNotFoundError(f"no committed run of {table!r} in {output_dir}")
    first = runs(spark, output_dir).filter((F.col("run_id") == named[0]) & (F.col("table") == table)).orderBy("at", "path").first()
    return spark.read.schema(schema).format(first["format"]).load(first["path"])
