"""Helpers shared by the operators of this subpackage.

* ``store`` cuts lineage: it writes a table below the cluster's shared folder
  (``spark.checkpoint.dir``) and reads it back, so a lost executor costs a re-read.
* ``text_chunks`` walks an Arrow batch in pieces of bounded size; ``word_spans`` and
  ``span_hashes`` find and hash words for a whole piece at once with numpy.
"""

from __future__ import annotations

import uuid
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import ensure_checkpoint_dir

#: Bytes of text that a Python worker handles at once (a longer text is a piece of its own).
CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_MULT = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2**64


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a private one only where none is set (tests)."""
    return ensure_checkpoint_dir(spark)


def store(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back (cuts lineage, gives real sizes)."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/llm-{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ------------------------------------------------------------------ numpy over Arrow text


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (all bits of the input reach all bits of the output)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


_BYTE_CODE = mix64((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _GOLD)


class Chunk:
    """A few consecutive texts of one batch: ``data`` holds their UTF-8 bytes, text ``i``
    is ``data[offs[i]:offs[i + 1]]``, and it is row ``first + i`` of the batch."""

    def __init__(self, first: int, data: np.ndarray, offs: np.ndarray):
        self.first, self.data, self.offs = first, data, offs

    @property
    def n(self) -> int:
        return len(self.offs) - 1

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.offs[i] : self.offs[i + 1]].tobytes()


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES, most: int = 4096) -> Iterator[Chunk]:
    """Pieces of about ``limit`` bytes and at most ``most`` texts of a string or binary
    column; together they are the whole column. Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if not n:
        return
    _, offsets, values = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(values, dtype=np.uint8) if values is not None else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, side="right")) - 1)
        to = min(to, at + most)
        yield Chunk(at, data[offs[at] : offs[to]], offs[at : to + 1] - offs[at])
        at = to


def word_spans(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte spans of the words ``[^\\x20\\x09-\\x0D]+`` of each text.

    Returns (starts, ends, first): the words of text ``i`` are ``first[i]:first[i + 1]``.
    """
    if not len(data):
        z = np.zeros(0, dtype=np.int64)
        return z, z, np.zeros(len(offs), dtype=np.int64)
    space = _SPACE[data]
    before = np.empty(len(data), dtype=bool)
    before[0] = True
    before[1:] = space[:-1]
    before[offs[:-1][offs[:-1] < len(data)]] = True
    after = np.empty(len(data), dtype=bool)
    after[-1] = True
    after[:-1] = space[1:]
    after[offs[1:][offs[1:] > 0] - 1] = True
    word = ~space
    starts = np.flatnonzero(word & before)
    ends = np.flatnonzero(word & after) + 1
    return starts, ends, np.searchsorted(starts, offs)


_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        _powers[:] = []
        for base in (_MULT, pow(_MULT, -1, 1 << 64)):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            np.multiply.accumulate(p, out=p)
            _powers.append(p)
    return _powers[0], _powers[1]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """``sums`` of a polynomial byte hash modulo 2**64, for ``span_hashes``."""
    up, _ = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_CODE[data] * up[: len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans (equal bytes give equal hashes wherever they stand)."""
    _, down = _power_tables(len(sums))
    return mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _GOLD)


def window_hashes(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``k`` consecutive words inside each text.

    Returns (hashes, first): the windows of text ``i`` are ``first[i]:first[i + 1]``.
    """
    counts = np.diff(first)
    n_win = np.maximum(counts - (k - 1), 0)
    out_first = np.zeros(len(first), dtype=np.int64)
    np.cumsum(n_win, out=out_first[1:])
    total = int(out_first[-1])
    if not total:
        return np.zeros(0, dtype=np.uint64), out_first
    at = np.arange(total, dtype=np.int64) + np.repeat(first[:-1] - out_first[:-1], n_win)
    acc = np.zeros(total, dtype=np.uint64)
    for j in range(k):
        acc = acc * np.uint64(_MULT) + hashes[at + j]
    return mix64(acc), out_first


def per_text(counts_at: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of an array of numbers over each text's slice ``first[i]:first[i + 1]``."""
    total = np.zeros(len(counts_at) + 1, dtype=np.int64)
    np.cumsum(counts_at, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def packed(df: DataFrame) -> Column:
    """All columns as one struct, so that names added beside it never clash; ``row.*``
    gives them back."""
    return F.struct(*[df[c] for c in df.columns]).alias("row")


def texts_only(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator reads, under the names doc_id and text (other columns,
    whatever their names, never enter)."""
    return df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
