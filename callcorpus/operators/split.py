"""Exact-size splits, head and sample.

Cuts of an order at a position (splits, first N rows, pages) are made by counting key ranges,
see ``selection``. ``global_row_index`` numbers whole rows:

1. range-partition on the order key and sort within partitions (a balanced shuffle,
   because range boundaries are sampled from the data -- a hot key value is split
   between partitions only by its tie-breaker, so callers pass a unique one);
2. write the sorted frame to the reliable checkpoint directory, so every later pass
   sees the same partitions even if executors are lost and stages are recomputed;
3. count rows per partition (one small row per partition), turn the counts into
   prefix offsets and broadcast them (bounded by the partition count);
4. global index = partition offset + position inside the partition.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..session import ensure_checkpoint_dir
from .selection import Cut, Key

_PID = "_cc_pid"
_LOCAL = "_cc_local"


def _cols(cols: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _num_partitions(df: DataFrame) -> int:
    spark = df.sparkSession
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def indexed_with_total(
    df: DataFrame, order_by: Sequence[Column | str], index_col: str = "row_index", num_partitions: int | None = None
) -> tuple[DataFrame, int]:
    """``df`` plus a 0-based global position in ``order_by`` order, and the row count."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    order = _cols(order_by)
    n_parts = num_partitions or _num_partitions(df)
    ordered = df.repartitionByRange(n_parts, *order).sortWithinPartitions(*order)
    frozen = ordered.checkpoint(eager=True)
    located = frozen.select(
        "*",
        F.spark_partition_id().alias(_PID),
        (F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)).alias(_LOCAL),
    )
    counts = sorted((r[0], r[1]) for r in located.groupBy(_PID).count().collect())
    offsets, running = [], 0
    for pid, cnt in counts:
        offsets.append((pid, running))
        running += cnt
    if not offsets:
        return df.withColumn(index_col, F.lit(None).cast("long")).limit(0), 0
    offs = spark.createDataFrame(offsets, f"{_PID} int, _cc_off long")
    out = (
        located.join(F.broadcast(offs), _PID)
        .withColumn(index_col, F.col("_cc_off") + F.col(_LOCAL))
        .drop(_PID, _LOCAL, "_cc_off")
    )
    return out, running


def global_row_index(df: DataFrame, order_by: Sequence[Column | str], index_col: str = "row_index") -> DataFrame:
    return indexed_with_total(df, order_by, index_col)[0]


def hash_split(
    df: DataFrame, id_col: str, test_fraction: float = 0.05, seed: int = 42, split_col: str = "split",
    names: tuple[str, str] = ("train", "val"),
) -> DataFrame:
    """Reproducible shuffled split with an exact validation size ``ceil(n * f)``.

    Order is ``md5(seed ':' id)`` then id; the first ``ceil(n*f)`` rows are validation.
    Row membership matches any engine that uses the same hash order, not the
    reference library's permutation.
    """
    key = F.upper(F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string"))))
    val = Cut(df, [Key(key, raw=True), id_col], lambda n: math.ceil(n * test_fraction))
    return val.marked(split_col, names[1], names[0])


def ordered_split(
    df: DataFrame, order_cols: Sequence[Key | Column | str], train_fraction: float = 0.95, split_col: str = "split",
    names: tuple[str, str] = ("train", "val"),
) -> DataFrame:
    """The first ``int(n * f)`` rows in ``order_cols`` order train, the rest val."""
    return Cut(df, order_cols, lambda n: int(n * train_fraction)).marked(split_col, names[0], names[1])


def head(df: DataFrame, order_cols: Sequence[Key | Column | str], n: int | None) -> DataFrame:
    """L1 first-N rows (``max_samples``), any N, not sorted: 0 or None means no limit."""
    return Cut(df, order_cols, int(n)).inside() if n else df


def sample_rows(df: DataFrame, order_cols: Sequence[Column | str], k: int = 1) -> DataFrame:
    """L2 printed samples: the first ``k`` rows; empty input gives an empty frame."""
    return df.orderBy(*_cols(order_cols)).limit(k)


def split_counts(df: DataFrame, split_col: str = "split") -> DataFrame:
    """Rows per split."""
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n"))
