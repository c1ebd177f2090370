"""Table queries the tool catalog declares (R2-R8): paged filters, transcripts,
vector top-k, paged similarity search, action-item state.

Column names are arguments: the driver tables have no memories or action items, so
callers map their own columns. Dates arrive as ISO-8601 strings with an offset and
are compared as timestamps.
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StringType, TimestampNTZType, TimestampType

from ..functions.text import broadcast_if_small, let
from .selection import Key, desc, page

# Limits declared by the catalog (default, maximum).
CONVERSATION_LIMIT = (20, 5000)
MEMORY_LIMIT = (50, 5000)
ACTION_ITEM_LIMIT = (50, 500)
VECTOR_LIMIT = (5, 20)
SEARCH_PER_PAGE = (10, 100)
TRANSCRIPT_MAX_SEGMENTS = 1000
DEFAULT_STATUSES = "processing,completed"


def _ts(value: str | None) -> Column | None:
    """ISO-8601 text (offset allowed) -> a TIMESTAMP_NTZ literal in UTC.

    Bounds are driver-side parameters: they are normalised here (offset applied, then
    made naive) and cast from text, so the session time zone never shifts them.
    Naive columns are read as UTC wall-clock times.
    """
    if value is None:
        return None
    from datetime import datetime, timezone

    t = datetime.fromisoformat(value.replace("Z", "+00:00"))
    if t.tzinfo is not None:
        t = t.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")


def _instant(df: DataFrame, col: str) -> Column:
    """A date column as a naive UTC time: ISO text (with or without offset) and TIMESTAMP
    are instants, TIMESTAMP_NTZ is read as UTC (and stays pushable into the scan)."""
    kind, c = df.schema[col].dataType, F.col(col)
    if isinstance(kind, TimestampNTZType):
        return c
    if isinstance(kind, TimestampType):
        return F.convert_timezone(F.current_timezone(), F.lit("UTC"), c.cast("timestamp_ntz"))
    if isinstance(kind, StringType):
        zoned = F.when(c.rlike(r"([Zz]|[+-][0-9]{2}:?[0-9]{2})$") & (F.length(c) > 10), c).otherwise(F.concat(c, F.when(F.length(c) == 10, "T00:00:00Z").otherwise("Z")))
        return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.try_to_timestamp(zoned).cast("timestamp_ntz"))
    return c.cast("timestamp_ntz")


def _limit(limit: int | None, default_max: tuple[int, int]) -> int:
    """The default, or the request; one outside 0..maximum is an error, never cut short."""
    default, maximum = default_max
    n = default if limit is None else int(limit)
    if not 0 <= n <= maximum:
        raise ValueError(f"limit {n} is outside 0..{maximum}")
    return n


def date_range(df: DataFrame, col: str, start: str | None, end: str | None) -> DataFrame:
    """``start <= col <= end`` for the given bounds (pushed into the scan)."""
    c, bounds = _instant(df, col), []
    if start is not None:
        bounds.append(lambda x: x >= _ts(start))
    if end is not None:
        bounds.append(lambda x: x <= _ts(end))
    if len(bounds) == 2 and isinstance(df.schema[col].dataType, StringType):  # read each text once
        return df.filter(let(c, lambda x: bounds[0](x) & bounds[1](x)))
    for bound in bounds:
        df = df.filter(bound(c))
    return df


def paged_query(df: DataFrame, order_by: Sequence[Key | Column | str], limit: int, offset: int = 0) -> DataFrame:
    """Offset/limit page in a total order (ties broken by the caller's id column)."""
    return page(df, order_by, offset, limit)


def conversations_query(
    df: DataFrame, created_col: str, status_col: str, id_col: str, discarded_col: str | None = None,
    start_date: str | None = None, end_date: str | None = None, statuses: str | None = DEFAULT_STATUSES,
    include_discarded: bool = False, limit: int | None = None, offset: int = 0,
) -> DataFrame:
    """R2 ``get_conversations``: date range, comma-separated statuses, discarded flag,
    newest first, limit (default 20, max 5000) and offset."""
    out = df
    if statuses:
        wanted = [s.strip() for s in statuses.split(",") if s.strip()]
        out = out.filter(F.col(status_col).isin(wanted))
    if discarded_col is not None and not include_discarded:
        out = out.filter(~F.coalesce(F.col(discarded_col), F.lit(False)))
    out = date_range(out, created_col, start_date, end_date)  # last: dates as text are dear
    return paged_query(out, [desc(_instant(out, created_col)), id_col], _limit(limit, CONVERSATION_LIMIT), offset)


def memories_query(
    df: DataFrame, created_col: str, id_col: str, start_date: str | None = None, end_date: str | None = None,
    limit: int | None = None, offset: int = 0,
) -> DataFrame:
    """R6 ``get_memories``: R2 without status, default 50 (max 5000)."""
    out = date_range(df, created_col, start_date, end_date)
    return paged_query(out, [desc(_instant(out, created_col)), id_col], _limit(limit, MEMORY_LIMIT), offset)


def action_items_query(
    df: DataFrame, id_col: str, created_col: str, due_col: str, completed_col: str, conversation_col: str,
    completed: bool | None = None, conversation_id: str | None = None, start_date: str | None = None,
    end_date: str | None = None, due_start_date: str | None = None, due_end_date: str | None = None,
    limit: int | None = None, offset: int = 0,
) -> DataFrame:
    """R7 ``get_action_items``: tri-state ``completed`` (None = all), conversation,
    created and due ranges, default 50 (max 500), offset."""
    out = date_range(df, created_col, start_date, end_date)
    out = date_range(out, due_col, due_start_date, due_end_date)
    if completed is not None:
        out = out.filter(F.col(completed_col) == F.lit(bool(completed)))
    if conversation_id is not None:
        out = out.filter(F.col(conversation_col) == F.lit(conversation_id))
    return paged_query(out, [desc(_instant(out, created_col)), id_col], _limit(limit, ACTION_ITEM_LIMIT), offset)


def transcripts(
    segments: DataFrame, conv_col: str, order_col: str, speaker_col: str, text_col: str,
    max_segments: int = 0, include_timestamps: bool = False,
) -> DataFrame:
    """The first N segments of each conversation as one transcript text.

    ``0`` = every conversation with an empty transcript, ``-1`` = all segments, else N (at
    most 1000; more is an error). The top-N filter
    plans as a partial WindowGroupLimit before the shuffle: each map task forwards at
    most N rows per conversation, so a conversation holding a third of the rows is cut
    down map-side. With ``-1`` the transcript is the whole conversation by definition.
    """
    if max_segments == 0:
        return segments.select(F.col(conv_col)).distinct().select(conv_col, F.lit(0).cast("long").alias("n_segments"), F.lit("").alias("transcript"))
    rows = segments
    if max_segments > 0:
        n = _limit(max_segments, (0, TRANSCRIPT_MAX_SEGMENTS))
        ensure_group_limit(segments.sparkSession, n)
        w = Window.partitionBy(conv_col).orderBy(order_col)
        rows = rows.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")
    prefix = F.concat(F.lit("["), F.col(order_col).cast("string"), F.lit("] ")) if include_timestamps else F.lit("")
    line = F.concat(prefix, F.col(speaker_col), F.lit(": "), F.col(text_col))
    agg = rows.groupBy(conv_col).agg(
        F.count(F.lit(1)).alias("n_segments"),
        F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("o"), line.alias("l")))).alias("_s"),
    )
    return agg.select(conv_col, "n_segments", F.array_join(F.transform("_s", lambda x: x["l"]), "\n").alias("transcript"))


# ---------------------------------------------------------------------------
# Vector search
# ---------------------------------------------------------------------------

def ensure_group_limit(spark, k: int) -> None:
    """Keep the map-side top-k for ``k`` ranks per group.

    Spark plans a partial ``WindowGroupLimit`` before the shuffle only for limits up
    to ``spark.sql.optimizer.windowGroupLimitThreshold`` (1000 by default); above it a
    group's rows would all reach one task. The threshold is raised (never lowered) so
    deep pages keep the map-side cut -- it only enables that optimization.
    """
    key = "spark.sql.optimizer.windowGroupLimitThreshold"
    current = int(spark.conf.get(key, "1000"))
    if k > current:
        spark.conf.set(key, str(k))


#: Bytes of one block of vectors, and the queries of one product.
BLOCK_BYTES = 1 << 21
QUERY_BLOCK = 256
#: Bytes of all queries up to which they are broadcast; the parts of the corpus if they are not.
BROADCAST_BYTES = 1 << 20
CORPUS_PARTS = 16


def _block_rows(dim: int) -> int:
    return max(BLOCK_BYTES // (8 * dim), 1)


def _packed(batches):
    """Blocks of a batch's vectors: (dim, ids, vectors), a row per dimension. Rows without a
    vector, or whose vector has a null or no direction, have no cosine and are left out."""
    for batch in batches:
        column = batch.column(1)
        sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
        whole = np.array([v is not None and all(x is not None for x in v) for v in column.to_pylist()]) if column.flatten().null_count else np.ones(len(column), dtype=bool)
        sizes = np.where(whole & ~np.isnan(sizes.astype(float)), sizes, 0).astype(np.int64)
        for dim in np.unique(sizes[sizes > 0]).tolist():
            every = np.flatnonzero(sizes == dim)
            for rows in np.split(every, range(_block_rows(dim), len(every), _block_rows(dim))):
                flat = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                block = flat.reshape(len(rows), dim)
                sound = (block != 0).any(axis=1) & np.isfinite(block).all(axis=1)
                if sound.any():
                    ids = batch.column(0).take(pa.array(rows[sound]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([dim], pa.int32()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), pa.array([block[sound].tobytes()], pa.binary())],
                        ["dim", "ids", "vectors"],
                    )


def _scored(k: int):
    """The best ``k`` rows of a block for each query of a block of queries, by matrix products
    of ``QUERY_BLOCK`` queries; what may be among them is scored again, so that equal vectors
    score alike."""

    def best(ids: list, rank: np.ndarray, rows: np.ndarray, norms: np.ndarray, query: np.ndarray, rough: np.ndarray):
        near = np.arange(len(ids))
        if len(ids) > k:
            near = np.flatnonzero(rough >= np.partition(rough, -k)[-k] - 1e-9)
        score = (rows[near] * query).sum(axis=1) / (norms[near] * np.sqrt((query * query).sum()))
        return [(near[i], float(score[i])) for i in np.lexsort((rank[near], -score))[:k]]

    def run(batches):
        for batch in batches:
            kinds = batch.schema.field(3).type.value_type, batch.schema.field(1).type.value_type
            for n in range(batch.num_rows):  # one pair of blocks at a time
                dim, ids, vectors, asked, wanted = (c[n] for c in batch.columns)
                dim, ids, asked = dim.as_py(), ids.as_py(), asked.as_py()
                rows = np.frombuffer(vectors.as_buffer()).reshape(-1, dim)
                every = np.frombuffer(wanted.as_buffer()).reshape(-1, dim)
                norms = np.sqrt((rows * rows).sum(axis=1))
                rank = np.empty(len(ids), dtype=np.int64)
                rank[sorted(range(len(ids)), key=lambda i: ids[i])] = np.arange(len(ids))
                unit = (rows / norms[:, None]).T
                for at in range(0, len(asked), QUERY_BLOCK):
                    queries = every[at : at + QUERY_BLOCK]
                    rough = (queries / np.sqrt((queries * queries).sum(axis=1))[:, None]) @ unit
                    found = [(q, ids[i], s) for j, q in enumerate(asked[at : at + QUERY_BLOCK]) for i, s in best(ids, rank, rows, norms, queries[j], rough[j])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([f[0] for f in found], kinds[0]), pa.array([f[1] for f in found], kinds[1]), pa.array([f[2] for f in found], pa.float64())],
                        ["query_id", "id", "score"],
                    )

    return run


def vector_topk(corpus: DataFrame, queries: DataFrame, id_col: str, vec_col: str, k: int, rank_from: int = 1) -> DataFrame:
    """Per query, the corpus rows ranked ``rank_from .. k`` by cosine similarity
    (ties by id). Output ``(query_id, rank, <id>, score)``.

    ``queries`` is a relation: its first column is the query's id, its second the vector. Both
    sides are packed into blocks of about ``BLOCK_BYTES``. Few queries are broadcast to the
    corpus blocks. Many never reach the driver: the corpus is dealt into ``CORPUS_PARTS`` parts,
    and each block of queries meets each part in a sort-merge join, whose cells are what a task
    holds. Matrix products of a pair of blocks leave ``k`` rows per query; the partial lists are
    merged by rank, after a partial limit in each task. Rows without an id, and vectors that are
    null or zero, have no place in the ranks; a query meets rows of its own dimension only.
    """
    if k < 1:
        raise ValueError(f"k must be at least 1, not {k}")
    qid, qvec = queries.columns[:2]
    id_kind, q_kind = corpus.schema[id_col].dataType.simpleString(), queries.schema[qid].dataType.simpleString()
    asked = queries.select(F.col(qid).alias("query_id"), F.col(qvec).cast("array<double>").alias("v")).filter(F.size("v") > 0)
    sizes = asked.groupBy(F.size("v").alias("d")).count().collect()  # a row per dimension
    few = sum(8 * d * n for d, n in sizes) <= BROADCAST_BYTES
    parts = 1 if few else CORPUS_PARTS
    blocks = F.coalesce(*[F.when(F.col("dim") == d, F.lit(-(-n // _block_rows(d)))) for d, n in sizes], F.lit(0))
    dealt = asked.withColumn("dim", F.size("v")).withColumn("block", F.pmod(F.xxhash64("query_id"), F.greatest(blocks, F.lit(1))).cast("int"))
    asked = dealt.groupBy("dim", "block").agg(F.collect_list(F.struct("query_id", "v")).alias("q"))
    pack = f"dim int, block int, ids array<{q_kind}>, vectors binary"
    qblocks = asked.select("dim", "block", F.col("q.query_id").alias("ids"), F.col("q.v").alias("v")).mapInArrow(_packed_queries, pack)
    cblocks = corpus.select(id_col, F.col(vec_col).cast("array<double>")).filter(F.col(id_col).isNotNull()).mapInArrow(_packed, f"dim int, ids array<{id_kind}>, vectors binary")
    cells = F.explode(F.when(blocks > 0, F.sequence(F.lit(0), blocks - 1)).otherwise(F.array().cast("array<int>")))
    spread = cblocks.withColumn("part", F.pmod(F.xxhash64("ids"), F.lit(parts)).cast("int")).withColumn("block", cells)
    q = qblocks.select(F.col("dim").alias("qd"), F.col("block").alias("qb"), F.col("ids").alias("asked"), F.col("vectors").alias("wanted"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("qp"))
    q = F.broadcast(q) if few else q.hint("merge")
    pairs = spread.join(q, (F.col("dim") == F.col("qd")) & (F.col("block") == F.col("qb")) & (F.col("part") == F.col("qp"))).select("dim", "ids", "vectors", "asked", "wanted")
    best = pairs.mapInArrow(_scored(k), f"query_id {q_kind}, id {id_kind}, score double")
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("id"))
    ranked = best.withColumn("rank", F.row_number().over(w).cast("long")).filter(F.col("rank") <= k)
    if rank_from > 1:
        ranked = ranked.filter(F.col("rank") >= rank_from)
    return ranked.select("query_id", F.col("id").alias(id_col), "score", "rank")


def _packed_queries(batches):
    for batch in batches:
        for dim, block, ids, vectors in zip(*(c.to_pylist() for c in batch.columns)):
            sound = [(i, v) for i, v in zip(ids, vectors) if i is not None and None not in v and any(v) and np.isfinite(v).all()]
            if sound:
                rows = np.array([v for _, v in sound], dtype=np.float64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([dim], pa.int32()), pa.array([block], pa.int32()), pa.array([[i for i, _ in sound]], batch.schema.field(2).type), pa.array([rows.tobytes()], pa.binary())],
                    ["dim", "block", "ids", "vectors"],
                )


def vector_search(corpus: DataFrame, queries: DataFrame, id_col: str, vec_col: str, limit: int | None = None,
                  where: Column | None = None) -> DataFrame:
    """R4 ``vector_search``: top ``limit`` per query (default 5, 1 to 20).
    ``where`` (date range, discarded flag, ...) filters the corpus first and pushes
    into the scan."""
    corpus = corpus if where is None else corpus.filter(where)
    return vector_topk(corpus, queries, id_col, vec_col, _limit(limit, VECTOR_LIMIT))


def paged_search(corpus: DataFrame, queries: DataFrame, id_col: str, vec_col: str, page: int | None = 1, per_page: int | None = None,
                 where: Column | None = None) -> DataFrame:
    """R5 ``search``: page ``page`` (from 1) of ``per_page`` results (default 10, 1 to 100)."""
    corpus = corpus if where is None else corpus.filter(where)
    n, p = _limit(per_page, SEARCH_PER_PAGE), 1 if page is None else int(page)
    if p < 1 or n < 1:
        raise ValueError(f"page {p} and per_page {n} start at 1")
    return vector_topk(corpus, queries, id_col, vec_col, p * n, rank_from=(p - 1) * n + 1)


def label_centroids(corpus: DataFrame, label_col: str, vec_col: str) -> DataFrame:
    """Mean vector per label: posexplode + partial/final average per (label, dim)."""
    flat = corpus.select(label_col, F.posexplode(vec_col).alias("pos", "x"))
    per_dim = flat.groupBy(label_col, "pos").agg(F.avg(F.col("x").cast("double")).alias("m"))
    return per_dim.groupBy(label_col).agg(F.array_sort(F.collect_list(F.struct("pos", "m"))).alias("_c")).select(
        label_col, F.transform("_c", lambda x: x["m"]).alias("centroid")
    )


# ---------------------------------------------------------------------------
# Latest non-null state per entity
# ---------------------------------------------------------------------------

def upsert_state(updates: DataFrame, key_col: str, order_cols: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Fold create/update events into the current state: per field, the latest
    non-null value wins (order = ``order_cols``, e.g. timestamp then event id).

    ``max_by`` is a declarative aggregate with partial/final phases, so a hot entity
    is pre-aggregated map-side; the same aggregate runs as a streaming
    ``update``-mode query (see ``streaming``).
    """
    order = F.struct(*[F.col(c) for c in order_cols])
    aggs = [F.max_by(F.col(f), F.when(F.col(f).isNotNull(), order)).alias(f) for f in fields]
    return updates.groupBy(key_col).agg(F.count(F.lit(1)).alias("n_updates"), *aggs)


def conversations_with_transcripts(
    page_df: DataFrame, conv_id_col: str, segments: DataFrame, seg_conv_col: str, order_col: str, speaker_col: str,
    text_col: str, include_transcript: bool = True, max_transcript_segments: int = 0, include_timestamps: bool = False,
) -> DataFrame:
    """R2 + R3: a page of conversations (``conversations_query`` output) with their
    transcripts. Segments are gathered only for the page's ids: the page holds at
    most 5000 rows (the declared maximum), so its id list is broadcast -- after a
    count confirms it -- into a left-semi join before any gather."""
    if not include_transcript or max_transcript_segments == 0:
        return page_df.withColumn("transcript", F.lit(None).cast("string"))
    ids = page_df.select(F.col(conv_id_col).alias(seg_conv_col)).distinct()
    wanted = segments.join(broadcast_if_small(ids, 10_000), seg_conv_col, "left_semi")
    tr = transcripts(wanted, seg_conv_col, order_col, speaker_col, text_col, max_transcript_segments, include_timestamps)
    tr = tr.select(F.col(seg_conv_col).alias("_cc_conv"), "transcript")
    return page_df.join(tr, page_df[conv_id_col] == tr["_cc_conv"], "left").drop("_cc_conv")
