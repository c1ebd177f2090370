"""Sharding into a fixed number of files of near equal bytes by sampled splitters (operator 12).

1. Rows are ordered by (MD5 of the text, id): equal texts stand together, and a group of
   copies that is larger than a shard is cut like everything else. Only (id, size, checksum,
   key) is kept; texts do not travel.
2. Splitters: a row is drawn with a chance in proportion to its size (seeded by its key, so
   reruns agree) and weighs what it stands for. ``splitters`` quantiles of the drawn sizes
   cut the keys into ranges. Their number is a parameter, not a function of the data.
3. The ranges' true bytes are counted. An overfull range (over twice its share) is subdivided:
   its rows are drawn again among themselves, until none is overfull (but for one large row
   in it). Rows of one text and id that overfill a range are told apart by a row number.
4. A range's bytes before it and the running bytes inside it give every row's place in the
   whole order; the shard is the one in which the middle of the row's bytes lies. Only ranges
   are ordered, never the table.

Law ``bytes``: a shard differs from total / n_shards by less than one row's size at each end.
Defined results: a null text has no bytes, a row's size is its text's bytes plus 8, so empty
texts are spread as well. Null ids come first among copies. Rows equal in id and text are
interchangeable: the same shards and slots are dealt among them on every run. An empty table
gives no rows. Other columns, whatever their names, do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from . import common as C

N_SHARDS = 24
#: Bytes that a row takes besides its text.
ROW_BYTES = 8
#: Ranges that one round of splitters makes, and rows drawn per range.
SPLITTERS = 24 * 16
DRAWS = 64
#: Parts of an overfull range.
SUBDIVIDE = 16
#: A range is subdivided above this multiple of its share.
OVERFULL = 2.0

KEY = ("th", "id_text", "tie")


def _chance(seed: int) -> Column:
    """A number in [0, 1) that depends on the seed and the row's key only."""
    return (F.xxhash64(F.lit(seed), *KEY).bitwiseAND(F.lit((1 << 53) - 1))).cast("double") / float(1 << 53)


def measure(docs: DataFrame, tie: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, th, id_text, tie) per row: the narrow rows that are ordered.
    The ids' order is that of their texts (every type has one), null first."""
    text = F.col(text_col).cast("string")
    raw = F.coalesce(text, F.lit("")).cast("binary")
    return docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(raw) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.md5(raw).alias("th"),
        F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit("")).alias("id_text"),
        tie.alias("tie"),
    )


def _draw(rows: DataFrame, totals: DataFrame, draws: int, seed: int) -> DataFrame:
    """Rows drawn in proportion to their size, with the bytes that each stands for. Every
    range of ``totals`` (range, bytes) gets about ``draws`` of them."""
    near = rows.join(F.broadcast(totals), "range")
    step = F.col("bytes") / F.lit(float(draws))
    return near.filter(_chance(seed) * step < F.col("size")).select("range", *KEY, F.greatest(step, F.col("size").cast("double")).alias("stands"))


def _quantiles(drawn: DataFrame, parts: int) -> DataFrame:
    """(range, cuts): per range the keys that end its first ``parts - 1`` quantiles."""
    order = W.partitionBy("range").orderBy(*KEY)
    upto = F.sum("stands").over(order.rowsBetween(W.unboundedPreceding, 0))
    share = F.sum("stands").over(W.partitionBy("range")) / F.lit(float(parts))
    part = F.floor((upto - F.col("stands") / 2) / share)
    placed = drawn.select("range", *KEY, part.alias("part"))
    first = placed.groupBy("range", "part").agg(F.min(F.struct(*KEY)).alias("cut"))
    return first.groupBy("range").agg(F.array_sort(F.collect_list("cut")).alias("cuts"))


def _below(cuts: Column, key: Column) -> Column:
    """Number of cuts at or below the key (a binary search over the sorted cuts)."""
    lo_hi = F.struct(F.lit(0).alias("lo"), F.size(cuts).alias("hi"))

    def halve(s, _):
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        up = (s["lo"] < s["hi"]) & (F.get(cuts, mid) <= key)
        return F.struct(F.when(up, mid + 1).otherwise(s["lo"]).alias("lo"), F.when(up | (s["lo"] >= s["hi"]), s["hi"]).otherwise(mid).alias("hi"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(20)), lo_hi, halve, lambda s: s["lo"])


def _divide(rows: DataFrame, totals: DataFrame, parts: int, draws: int, seed: int) -> DataFrame:
    """``rows`` with every range cut into about ``parts`` ranges by splitters sampled in it."""
    cuts = _quantiles(_draw(rows, totals, draws * parts, seed), parts)
    cut = rows.join(F.broadcast(cuts), "range", "left")
    at = F.when(F.col("cuts").isNull(), F.lit(0)).otherwise(_below(F.col("cuts"), F.struct(*KEY)))
    return cut.withColumn("range", F.concat("range", F.lpad(at.cast("string"), 6, "0"), F.lit("."))).drop("cuts")


def ranges(rows: DataFrame, splitters: int = SPLITTERS, draws: int = DRAWS, seed: int = 12) -> tuple[DataFrame, DataFrame]:
    """(rows with their ``range``, (range, bytes, largest, rows) per range). Ranges are texts
    whose order is that of their keys; apart from its largest row none is over ``OVERFULL`` shares."""
    full = rows.withColumn("range", F.lit(""))
    todo = _count(full).select("range", "bytes")
    whole = todo.first()  # the one range of all rows; none of an empty table
    share = whole["bytes"] / splitters if whole else 0.0
    done, parts = None, splitters
    while True:
        cut = C.store(_divide(full, todo, parts, draws, seed), "shard-ranges")
        # ranges with over OVERFULL shares: at most splitters / OVERFULL of them
        todo = C.store(_count(cut).filter(F.col("bytes") - F.col("largest") > OVERFULL * share).select("range", "bytes"), "shard-overfull")
        within = cut.join(F.broadcast(todo.select("range")), "range", "left_anti")
        done = within if done is None else done.unionByName(within)
        if todo.isEmpty():
            return done, _count(done)
        full = cut.join(F.broadcast(todo.select("range")), "range", "left_semi")
        seed, parts = seed + 1, SUBDIVIDE


def _count(rows: DataFrame) -> DataFrame:
    return rows.groupBy("range").agg(F.sum("size").alias("bytes"), F.max("size").alias("largest"), F.count(F.lit(1)).alias("rows"))


def placed(rows: DataFrame, n_shards: int = N_SHARDS, splitters: int = SPLITTERS, draws: int = DRAWS, seed: int = 12) -> DataFrame:
    """(doc_id, size, text_crc32, tie, shard, slot) per row of ``measure``."""
    cut, sizes = ranges(rows, splitters, draws, seed)
    # one row per range: splitters and their subdivisions, a number that the data do not set
    order = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    everything = W.orderBy("range").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    offsets = C.store(
        sizes.select(
            "range",
            F.coalesce(F.sum("bytes").over(order), F.lit(0)).alias("bytes_before"),
            F.coalesce(F.sum("rows").over(order), F.lit(0)).alias("rows_before"),
            F.sum("bytes").over(everything).alias("total"),
        ),
        "shard-offsets",
    )
    inside = W.partitionBy("range").orderBy(*KEY)
    run = cut.select("doc_id", "size", "text_crc32", "tie", "range", F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, 0)).alias("upto"), F.row_number().over(inside).alias("nth"))
    run = run.join(F.broadcast(offsets), "range")
    # the shard of the middle of the row's bytes, in whole numbers
    shard = F.expr(f"least(({n_shards} * (2 * (bytes_before + upto) - size)) div (2 * total), {n_shards - 1})").cast("int")
    out = C.store(run.select("doc_id", "size", "text_crc32", "tie", shard.alias("shard"), (F.col("rows_before") + F.col("nth")).alias("nth")), "shard-placed")
    starts = out.groupBy("shard").agg(F.min("nth").alias("start"))  # at most n_shards rows
    return out.join(F.broadcast(starts), "shard").select("doc_id", "size", "text_crc32", "tie", "shard", (F.col("nth") - F.col("start")).cast("long").alias("slot"))


def place(docs: DataFrame, n_shards: int = N_SHARDS, id_col: str = "doc_id", text_col: str = "text", seed: int = 12) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) per row of ``docs``; slots count from 0 in each
    shard, in key order."""
    return placed(C.store(measure(docs, F.monotonically_increasing_id(), id_col, text_col), "shard-rows"), n_shards, seed=seed).drop("tie")


def write_shards(docs: DataFrame, path: str, n_shards: int = N_SHARDS, id_col: str = "doc_id", text_col: str = "text", seed: int = 12) -> DataFrame:
    """Write ``docs`` as folders ``shard=0`` to ``shard=n_shards - 1`` of Parquet files in slot
    order and return (shard, rows, bytes). The rows are kept once in the shared folder, so that
    their numbers hold while the shards are laid out."""
    kept = C.store(docs.select(C.packed(docs), F.monotonically_increasing_id().alias("nid")), "shard-input")
    flat = kept.select(F.col("row").getField(id_col).alias("i"), F.col("row").getField(text_col).alias("t"), "nid")
    at = C.store(placed(C.store(measure(flat, F.col("nid"), "i", "t"), "shard-rows"), n_shards, seed=seed), "shard-places")
    out = kept.join(at.select("tie", "shard", "slot"), F.col("nid") == F.col("tie")).select("row", "shard", "slot")
    names = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in ("shard", "slot")]
    out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").select(*names, "slot", "shard").write.mode("errorifexists").partitionBy("shard").parquet(path)
    return at.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"))
