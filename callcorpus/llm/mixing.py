"""Mixing sources to target weights by capped water-filling (operator 2).

1. One pass measures each document's size in words; only (id, source, size, key) is kept.
2. Sources, in code point order with null last, get the weights in turn. Water-filling
   runs on the table of sources: every round clamps the sources whose cap (``max_epochs``
   times their size) lies below their proportional share and shares the rest again, until
   no share is above its cap. A round is one aggregate; only its sums reach the driver.
3. A source's target over its size gives whole repetitions for all of its documents and
   one more for a seeded part of them: the documents whose key is at most the source's cut.
   The cut is where the running size, in key order, comes nearest to the rest. It is found
   from sums over 65,536 key ranges and then inside one of those ranges, so a source with
   a third of all rows is pre-aggregated and never ordered as a whole.

Defined results: null or empty text has size 0 and is taken 0 words. Documents without a
source form one source (null), last in order. Rows equal in id, text and source are ties:
they share a key and are taken alike. An empty table, or one without words, gives targets
of 0. Keys depend on seed, id and text alone, so reruns agree.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..operators.split import indexed_with_total
from . import common as C

KEY_BITS = 60
RANGE_BITS = 16


def _count_words(batches):
    for batch in batches:
        sizes = [C.word_spans(c.data, c.offs)[2] for c in C.text_chunks(batch.column(3))]
        flat = [int(x) for first in sizes for x in first[1:] - first[:-1]]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(flat, pa.int64())], ["doc_id", "source", "key", "size"])


def sampling_key(seed: int, id_col: Column, text_col: Column) -> Column:
    """60 bits that depend on seed, id and text only."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), id_col.cast("string"), F.md5(text_col.cast("binary"))).cast("binary"))
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long")


def sizes(docs: DataFrame, seed: int, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    src = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        sampling_key(seed, F.col(id_col), F.col(text_col).cast("string")).alias("key"),
        F.col(text_col).cast("string").alias("text"),
    )
    return src.mapInArrow(_count_words, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, source string, key long, size long")


def source_table(measured: DataFrame, weights: tuple[float, ...]) -> DataFrame:
    """(source, size, weight): the weights in turn over the sources in code point order, null last."""
    per_source = measured.groupBy("source").agg(F.sum("size").alias("size"))
    ranked, _ = indexed_with_total(per_source, [F.col("source").asc_nulls_last()], "_rank")
    at = F.col("_rank") % F.lit(len(weights)) + 1
    return ranked.select("source", "size", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), at.cast("int")).alias("weight"))


def water_fill(sources: DataFrame, share: float, max_epochs: float) -> DataFrame:
    """``sources`` (source, size, weight) plus ``target``: proportional to weight, at most
    ``max_epochs * size``, summing to ``share`` of all sizes where the caps allow it."""
    total = (sources.agg(F.sum("size")).first()[0] or 0) * share
    cap = F.col("size") * F.lit(float(max_epochs))
    level, clamped = 0.0, -1
    while True:
        over = cap <= F.lit(level) * F.col("weight") if clamped >= 0 else F.lit(False)
        row = sources.agg(F.count(F.when(over, 1)), F.sum(F.when(over, cap)), F.sum(F.when(~over, F.col("weight")))).first()
        if row[0] == clamped:
            break
        clamped = row[0]
        if not row[2]:  # every source is at its cap
            level = float("inf")
            break
        level = (total - (row[1] or 0.0)) / row[2]
    if level == float("inf"):
        return sources.withColumn("target", cap)
    return sources.withColumn("target", F.least(cap, F.lit(level) * F.col("weight")))


def _cuts(measured: DataFrame, plan: DataFrame) -> DataFrame:
    """Per source with a rest to fill: the largest key that still gets one more repetition."""
    shift = KEY_BITS - RANGE_BITS
    need = plan.filter("rest > 0").select(F.col("source").alias("s"), "rest")
    sums = measured.groupBy("source", F.shiftright("key", shift).alias("rng")).agg(F.sum("size").alias("size"))
    order = W.partitionBy("source").orderBy("rng").rowsBetween(W.unboundedPreceding, 0)
    edge = (
        sums.withColumn("upto", F.sum("size").over(order))
        .join(need, F.col("source").eqNullSafe(F.col("s")))
        .filter((F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col("size") < F.col("rest")))
        .select("s", "rest", "rng", (F.col("upto") - F.col("size")).alias("before"))
    )
    inside = measured.join(edge, F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("key", shift) == F.col("rng")))
    keys = inside.groupBy("s", "rest", "rng", "before", "key").agg(F.sum("size").alias("size"))
    by_key = W.partitionBy("s").orderBy("key").rowsBetween(W.unboundedPreceding, 0)
    upto = keys.withColumn("upto", F.col("before") + F.sum("size").over(by_key))
    none = edge.select("s", (F.shiftleft("rng", shift) - 1).alias("key"), (F.col("rest") - F.col("before")).alias("miss"))
    tries = upto.select("s", "key", F.abs(F.col("upto") - F.col("rest")).alias("miss")).unionByName(none)
    return tries.groupBy("s").agg(F.min_by("key", F.struct("miss", "key")).alias("cut"))


def mixture(
    docs: DataFrame,
    weights: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    max_epochs: float = 2.0,
    seed: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Per document: doc_id, source, key, size, source_size, target and ``copies``, the
    number of times the mix holds it."""
    measured = C.store(sizes(docs, seed, id_col, text_col, source_col), "sizes")
    plan = water_fill(source_table(measured, weights), share, max_epochs)
    ratio = F.col("target") / F.col("size")
    whole = F.when(F.col("size") > 0, F.least(F.floor(ratio), F.lit(int(max_epochs)))).otherwise(F.lit(0)).cast("long")
    plan = plan.withColumn("whole", whole)
    plan = C.store(plan.withColumn("rest", F.when(F.col("whole") < F.lit(float(max_epochs)), F.col("target") - F.col("whole") * F.col("size")).otherwise(F.lit(0.0))), "plan")
    side = plan.join(_cuts(measured, plan), F.col("source").eqNullSafe(F.col("s")), "left").select(
        F.col("source").alias("s"), F.col("size").alias("source_size"), "target", "whole", F.coalesce("cut", F.lit(-1)).alias("cut")
    )
    side = C.store(side, "cuts")  # its size is then known: few sources are broadcast, many are joined
    return measured.join(side, F.col("source").eqNullSafe(F.col("s"))).select(
        "doc_id", "source", "key", "size", "source_size", "target",
        (F.col("whole") + F.when(F.col("key") <= F.col("cut"), 1).otherwise(0)).alias("copies"),
    )


def mix_documents(docs: DataFrame, seed: int = 20, **options) -> DataFrame:
    """The documents of the mix, all columns, plus ``copies`` (documents taken 0 times are
    left out; ``explode(sequence(1, copies))`` writes the repetitions out). A column of
    that name in ``docs`` is replaced."""
    plan = mixture(docs, seed=seed, **options)
    taken = plan.filter("copies > 0").groupBy("source", "key").agg(F.max("copies").alias("copies"))
    keyed = docs.select(C.packed(docs), sampling_key(seed, docs["doc_id"], docs["text"].cast("string")).alias("at"))
    both = keyed.join(taken, (F.col("at") == F.col("key")) & F.col("row").getField("source").cast("string").eqNullSafe(F.col("source")))
    return both.select(*[F.col("row").getField(c).alias(c) for c in docs.columns if c != "copies"], "copies")
