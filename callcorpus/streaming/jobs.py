"""Structured Streaming forms of the row-local formatters and of the aggregates.

F2-F4, J1-J9, C1 and R1 are row-local: the same column expressions run on a
streaming DataFrame (R1 as a stream-static join with the catalog). C2 (the scoreboard) is a
stateful aggregation, N2 a watermarked left join of two streams, and R8 (action-item state)
keeps one value and order key per field. T1/T2/L1 need a total count or order and stay
batch-only.

Every query writes through a checkpoint location (exactly-once file sinks,
recoverable after executor loss).
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from ..operators import formatters as FM, scoring, validate as VL
from ..operators.selection import order_key


def read_stream(spark: SparkSession, path: str, schema: str, fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def format_stream(raw: DataFrame, formatter: Callable[[DataFrame], DataFrame] = FM.xlam_format, id_col: str = "id") -> DataFrame:
    """Streaming corpus formatting: text rows (append) -- the rejects are the
    complement (``reject_reason IS NOT NULL``) and can be written by a second query."""
    return FM.drop_failed(formatter(raw)).select(id_col, "text")


def validate_stream(calls: DataFrame, params: DataFrame, id_col: str = "call_id", call_col: str = "call_json",
                    tools: DataFrame | None = None, device_col: str | None = None) -> DataFrame:
    """R1 over a stream of calls (append): a stream-static left join with the tool
    signatures (the planner broadcasts a small static side), then row-local checks -- no
    state."""
    return VL.validate_calls(calls, params, id_col, call_col, tools=tools, device_col=device_col)


def scoreboard_stream(scored_input: DataFrame) -> DataFrame:
    """Running per-model counters over a stream of ``(model_name, example_id,
    raw_output, expected)`` rows (complete or update output mode)."""
    return scoring.scoreboard(scoring.score_rows(scored_input), with_pct=False)


def upsert_state_stream(updates: DataFrame, key_col: str, order_cols: list, fields: list[str], idle: str | None = None, time_col: str | None = None) -> DataFrame:
    """R8 as a stream (update mode): each trigger gives the current state of the keys that it
    changed, like ``tables.upsert_state`` of all updates so far.

    The state of a key is its update count and, per field, the value and the order key it
    came with, so that late and shuffled updates fold to the same state in any order. With
    ``idle`` (such as ``"2 hours"``) and ``time_col`` (which gets that watermark) a key is
    forgotten when the watermark passes its last update by ``idle``; a later update of it
    starts anew. The session must use the RocksDB state store.
    """
    spark = updates.sparkSession
    if "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass", ""):
        raise RuntimeError("set spark.sql.streaming.stateStore.providerClass to the RocksDB provider for stateful streams")
    # only texts pass the state: the order key compares as the order does, values are JSON
    texts = [F.to_json(F.struct(F.col(f).alias("v")), {"ignoreNullFields": "true"}) for f in fields]
    rows = updates.withWatermark(time_col, idle) if idle else updates
    rows = rows.select(
        F.col(key_col).alias("key"), order_key(updates, order_cols).alias("at"), *([F.col(time_col).alias("time")] if idle else []),
        *[F.when(F.col(f).isNotNull(), t).alias(f"f{i}") for i, (f, t) in enumerate(zip(fields, texts))],
    )
    kind = updates.schema[key_col].dataType.simpleString()
    slots = ", ".join(f"o{i} string, v{i} string" for i in range(len(fields)))
    out = f"key {kind}, n long, " + ", ".join(f"v{i} string" for i in range(len(fields)))
    idle_ms = spark.range(1).select(F.expr(f"cast(unix_millis(timestamp'1970-01-01 00:00:00Z' + interval {idle}) as long)")).first()[0] if idle else 0
    state = rows.groupBy("key").transformWithState(
        FoldUpdates(len(fields), f"n long, {slots}", idle_ms), out, "update", "EventTime" if idle else "None",
    )
    types = {f: updates.schema[f].dataType.simpleString() for f in fields}
    return state.select(
        F.col("key").alias(key_col), F.col("n").alias("n_updates"),
        *[F.from_json(f"v{i}", f"v {types[f]}")["v"].alias(f) for i, f in enumerate(fields)],
    )


class FoldUpdates(StatefulProcessor):
    """Latest value per field by order key; see ``upsert_state_stream``."""

    def __init__(self, n: int, schema: str, idle_ms: int):
        self.n, self.schema, self.idle_ms = n, schema, idle_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("kept", self.schema)

    def handleInputRows(self, key, rows, timerValues):
        old = self.kept.get() if self.kept.exists() else None
        count = old[0] if old else 0
        best = [(old[1 + 2 * i], old[2 + 2 * i]) if old else (None, None) for i in range(self.n)]
        last = None
        for row in rows:
            count += 1
            for i in range(self.n):
                value = row[f"f{i}"]
                if value is not None and (best[i][0] is None or row["at"] >= best[i][0]):
                    best[i] = (row["at"], value)
            if self.idle_ms:
                time = int(row["time"].timestamp() * 1000)
                last = time if last is None else max(last, time)
        self.kept.update((count, *[x for pair in best for x in pair]))
        if self.idle_ms:
            ends = [int(t) for t in self.handle.listTimers()]
            to = max([*ends, last + self.idle_ms])
            for t in ends:
                if t < to:
                    self.handle.deleteTimer(t)
            if to not in ends:
                self.handle.registerTimer(to)
        yield Row(key=key[0], n=count, **{f"v{i}": best[i][1] for i in range(self.n)})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.kept.clear()
        return iter(())

    def close(self) -> None:
        pass


def score_stream(cases: DataFrame, predictions: DataFrame, time_col: str = "ts", within: str = "1 hour") -> DataFrame:
    """N2 + C1 as a stream (append): cases of a run ``(model_name, example_id, expected, ts)``
    left-joined with their predictions ``(model_name, example_id, raw_output, ts)`` and scored.

    A prediction that is delivered again within ``within`` is dropped; one may arrive up to
    ``within`` before or after its case. A case whose prediction has not come when the
    watermark passes is given out as missing (invalid JSON). State of both sides is dropped
    behind the watermark. ``scoring.scoreboard`` of the written rows is C2.
    """
    keys = ["model_name", "example_id"]
    once = predictions.withWatermark(time_col, within).dropDuplicatesWithinWatermark(keys)
    told = once.select(*[F.col(k).alias(f"_p_{k}") for k in keys], "raw_output", F.col(time_col).alias("_p_time"))
    asked = cases.withWatermark(time_col, within)
    near = F.expr(f"_p_time >= {time_col} - interval {within} AND _p_time <= {time_col} + interval {within}")
    both = asked.join(told, (asked["model_name"] == told["_p_model_name"]) & (asked["example_id"] == told["_p_example_id"]) & near, "leftOuter")
    return scoring.score_rows(both.drop(*[f"_p_{k}" for k in keys], "_p_time"))


def start(df: DataFrame, checkpoint: str, output_mode: str = "append", sink: str = "parquet", path: str | None = None,
          query_name: str | None = None, available_now: bool = True,
          foreach_batch: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Start a query with a checkpoint; ``available_now`` processes what exists and stops."""
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format(sink)
        if path:
            w = w.option("path", path)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()
