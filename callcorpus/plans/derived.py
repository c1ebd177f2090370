"""Inputs the reference's jobs consume, derived by Spark from the driver tables.

The reference reads model predictions, raw call rows, chat transcripts and teacher
replies that are not shipped. These functions build the same shapes from the given
tables so that every query's work grows with the data. Each derivation is a
deterministic projection (no randomness), so the DuckDB oracle can rebuild it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources.readers import read_table

# The model names the scoring queries evaluate (a registry, not data).
MODEL_NAMES = ["model_0", "model_1", "model_2", "model_3"]
# Number of planted output kinds in derived predictions.
N_PRED_KINDS = 12


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


#: Rows of one task where every row is read or written as JSON several times.
TASK_ROWS = 20_000


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/events.parquet", task_rows=TASK_ROWS)


def _k(props: Column) -> Column:
    return F.get_json_object(props, "$.k")


# ---------------------------------------------------------------------------
# scoring inputs
# ---------------------------------------------------------------------------

def eval_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Golden cases: one per event; expected = {"function": event_type, "arguments": props}."""
    ev = _events(spark, sf_dir)
    return ev.select(
        F.col("event_id").alias("example_id"),
        F.concat(F.lit("record a "), F.col("event_type"), F.lit(" event")).alias("command"),
        F.concat(F.lit('{"function": "'), F.col("event_type"), F.lit('", "arguments": '), F.col("props"), F.lit("}")).alias("expected"),
    )


def raw_output_for(kind: Column, et: Column, props: Column) -> Column:
    """Model output text of planted kind ``kind`` (see the oracle for the verdicts)."""
    k = _k(props)
    expected = F.concat(F.lit('{"function": "'), et, F.lit('", "arguments": '), props, F.lit("}"))
    return (
        F.when(kind == 0, expected)
        .when(kind == 1, F.concat(F.lit("Sure! "), expected, F.lit(' Hope this helps {"x": 1}')))
        .when(kind == 2, F.concat(F.lit('{"function": "'), et, F.lit('_v2", "arguments": '), props, F.lit("}")))
        .when(kind == 3, F.concat(F.lit('{"function": "'), et, F.lit('", "arguments": {"k": "'), k, F.lit('"}}')))
        .when(kind == 4, F.concat(F.lit('{"function": "'), et, F.lit('", "arguments": '), props))
        .when(kind == 5, F.lit("{}"))
        .when(kind == 6, F.lit("I cannot help with that."))
        .when(kind == 7, F.concat(F.lit('{"arguments": {"k": '), k, F.lit('.0}, "function": "'), et, F.lit('"}')))
        .when(kind == 8, F.concat(F.lit('{"function": "'), et, F.lit('"}')))
        .when(kind == 9, F.concat(F.lit("{'function': '"), et, F.lit("', 'arguments': {'k': "), k, F.lit("}}")))
        .when(kind == 10, F.concat(F.lit('{"function": "'), et, F.lit('", "arguments": {"k": '), k, F.lit(', "note": "a } \\" {"}}')))
        .otherwise(F.concat(F.lit("```json\n"), expected, F.lit("\n```")))
    )


# Planted arguments (prediction, golden) that JSON parsers often refuse or round; K stands for the
# event's number. The oracle lists which pairs Python calls equal.
PYTHON_JSON_ARGUMENTS = [
    ('{"k": -1, "k": K}', '{"k": K}'),
    ('{"k": K, "k": -1}', '{"k": K}'),
    ('{"k": [{"a": {"b": 0}, "a": [K, true]}]}', '{"k": [{"a": [K.0, 1]}]}'),
    ('{"\\u006b": K}', '{"k": "x", "k": Ke0}'),
    ('{"k": NaN, "n": K}', '{"n": K, "k": NaN}'),
    ("NaN", "NaN"),
    ('{"k": K, "x": 1e400}', '{"k": K, "x": Infinity}'),
    ('{"k": K, "x": -Infinity}', '{"k": K, "x": Infinity}'),
    ('{"k": K, "x": 1e16}', '{"k": K, "x": 10000000000000000}'),
    ('{"k": K, "x": 1e16}', '{"k": K, "x": 10000000000000001}'),
    ('{"k": K, "x": 10000000000000001.0}', '{"k": K, "x": 10000000000000000}'),
    ('{"k": K, "x": 1e23}', '{"k": K, "x": 99999999999999991611392}'),
    ('{"k": K, "x": 1e23}', '{"k": K, "x": 100000000000000000000000}'),
    ('{"k": K1234567890123456789012345678901234567890}', '{"k": K1234567890123456789012345678901234567890}'),
    ('{"k": K1234567890123456789012345678901234567890}', '{"k": K1234567890123456789012345678901234567891}'),
    ('{"k": K, "k": }', '{"k": K}'),
]


def python_json_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One prediction and golden call per event; kind = event_id % 16 plants the arguments."""
    ev = _events(spark, sf_dir)
    kind = (F.col("event_id") % len(PYTHON_JSON_ARGUMENTS)).cast("int")

    def call(side: int) -> Column:
        args = F.element_at(F.array(*[F.lit(pair[side]) for pair in PYTHON_JSON_ARGUMENTS]), kind + 1)
        args = F.replace(args, F.lit("K"), F.concat(F.lit("1"), F.col("event_id").cast("string")))
        return F.concat(F.lit('{"function": "'), F.col("event_type"), F.lit('", "arguments": '), args, F.lit("}"))

    return ev.select(F.col("event_id").alias("example_id"), F.concat(F.lit("Call: "), call(0)).alias("raw_output"), call(1).alias("expected"))


def model_runs(spark: SparkSession, sf_dir: str, failed: str | None = None) -> DataFrame:
    """The run table of the models that events name, one of them perhaps failed."""
    from ..operators import scoring

    names = table(spark, sf_dir, "events").select(F.concat(F.lit("model_"), (F.col("user_id") % len(MODEL_NAMES)).cast("string")).alias("model_name")).distinct()
    return scoring.run_table(names, names.select("model_name", F.when(F.col("model_name") == failed, "failed").otherwise("ok").alias("status")) if failed else None)


def eval_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of every model for every case: kind = (event_id + model) % 12."""
    ev = _events(spark, sf_dir)
    m = F.explode(F.array(*[F.lit(i) for i in range(len(MODEL_NAMES))])).alias("_m")
    per_model = ev.select("event_id", "event_type", "props", m)
    kind = (F.col("event_id") + F.col("_m")) % N_PRED_KINDS
    return per_model.select(
        F.concat(F.lit("model_"), F.col("_m").cast("string")).alias("model_name"),
        F.col("event_id").alias("example_id"),
        raw_output_for(kind, F.col("event_type"), F.col("props")).alias("raw_output"),
    )


# ---------------------------------------------------------------------------
# raw call rows ("xlam") from events
# ---------------------------------------------------------------------------

# Number of planted row kinds in derived raw call rows.
N_XLAM_KINDS = 13


def xlam_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw call rows ``(id, query, tools, answers)``; kind = event_id % 13 plants the
    formatter's edge cases (see the oracle for the expected text or reject)."""
    ev = _events(spark, sf_dir)
    et, props, k = F.col("event_type"), F.col("props"), _k(F.col("props"))
    kind = F.col("event_id") % N_XLAM_KINDS
    desc = F.concat(F.lit("Record one "), et, F.lit(" event"))
    tool_head = F.concat(F.lit('[{"name": "'), et, F.lit('", "description": "'), desc, F.lit('", "parameters": '))
    tools_good = F.concat(
        tool_head,
        F.lit('{"type": "object", "properties": {"k": {"type": "integer", "description": "payload key"}, '
              '"value": {"type": "number"}}, "required": ["k"]}}]'),
    )
    tools = (
        F.when(kind == 5, F.lit("not json"))
        .when(kind == 6, F.concat(tool_head, F.lit('{"type": "object", "properties": {"k": "integer"}}}]')))
        .when(kind == 7, F.lit("[]"))
        .when(kind == 8, F.concat(tool_head, F.lit('{"k": {"type": "integer"}}}]')))
        .when(kind == 9, F.concat(tool_head, F.lit('{"properties": {"k": {"description": "payload key"}}}}]')))
        .otherwise(tools_good)
    )
    answers = (
        F.when(kind == 1, F.lit("bad"))
        .when(kind == 2, F.lit("[]"))
        .when(kind == 3, F.lit("{}"))
        .when(kind == 10, F.concat(F.lit('{"function": "'), et, F.lit('", "parameters": '), props, F.lit("}")))
        .when(kind == 11, F.concat(F.lit('["'), et, F.lit('"]')))
        .when(kind == 12, F.concat(F.lit('[{"name": "'), et, F.lit('", "arguments": {"k": '), k,
                                   F.lit(', "note": "café ☕"}}, {"name": "other", "arguments": {}}]')))
        .otherwise(F.concat(F.lit('[{"name": "'), et, F.lit('", "arguments": '), props, F.lit("}]")))
    )
    query = F.when(kind == 4, F.lit("")).otherwise(
        F.concat(F.lit("Log a "), et, F.lit(" event for user "), F.col("user_id").cast("string"))
    )
    return ev.select(F.col("event_id").alias("id"), query.alias("query"), tools.alias("tools"), answers.alias("answers"))


# ---------------------------------------------------------------------------
# conversations as message arrays ("hermes") and transcripts ("glaive")
# ---------------------------------------------------------------------------

def hermes_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(conv_id, conversations: array<struct<from, value>>)`` with the dataset's role
    names (``human``/``gpt``). One row per conversation is the formatter's input
    shape; the gather is a hash aggregate on conv_id."""
    conv = table(spark, sf_dir, "conversations")
    frm = F.when(F.col("role") == "user", F.lit("human")).when(F.col("role") == "assistant", F.lit("gpt")).otherwise(F.col("role"))
    msgs = conv.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct(F.col("turn"), frm.alias("from"), F.col("text").alias("value")))).alias("_m")
    )
    return msgs.select("conv_id", F.transform("_m", lambda m: F.struct(m["from"].alias("from"), m["value"].alias("value"))).alias("conversations"))


def glaive_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(conv_id, system, chat)``: the first system turn becomes ``system`` (NULL when
    none); other turns become ``USER:``/``ASSISTANT:`` lines, ending ``<|endoftext|>``."""
    conv = table(spark, sf_dir, "conversations")
    is_sys = F.col("role") == "system"
    marker = F.when(F.col("role") == "user", F.lit("USER: ")).otherwise(F.lit("ASSISTANT: "))
    agg = conv.groupBy("conv_id").agg(
        F.min_by(F.when(is_sys, F.col("text")), F.when(is_sys, F.col("turn"))).alias("system"),
        F.array_sort(F.collect_list(F.when(~is_sys, F.struct("turn", F.concat(marker, F.col("text")).alias("line"))))).alias("_l"),
    )
    chat = F.concat(F.array_join(F.transform("_l", lambda x: x["line"]), "\n"), F.lit("\n<|endoftext|>"))
    return agg.select("conv_id", "system", chat.alias("chat"))


# ---------------------------------------------------------------------------
# teacher replies from events; a tool catalog from event types
# ---------------------------------------------------------------------------

# Items per teacher batch.
PER_BATCH = 10


def event_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tool catalog ``(ord, tool_json)``: one tool per event type, ordered by name."""
    ev = table(spark, sf_dir, "events")
    et = F.col("event_type")
    tool = F.concat(
        F.lit('{"name": "'), et, F.lit('", "description": "Record one '), et,
        F.lit(' event", "parameters": {"type": "object", "properties": {"k": {"type": "integer", '
              '"description": "payload key", "maximum": 100}, "value": {"type": "number"}}, "required": ["k"]}}'),
    )
    # the distinct event types are the catalog: a handful of rows after a partial
    # aggregate; tools are ordered by name (``ord``) and the renderer checks the size
    types = ev.select(et).distinct()
    return types.select(et.alias("ord"), tool.alias("tool_json"), et.alias("name"))


def teacher_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(batch_id, content)``: batches of 10 events (event_id div 10, so a batch can
    never hold more than 10 rows), wrapped by batch_id % 5 in the reply shapes a
    teacher produces; batch_id % 11 == 10 is truncated (invalid JSON); items of
    event_id % 7 == 3 lack ``tool``."""
    ev = table(spark, sf_dir, "events")
    et = F.col("event_type")
    q = F.concat(F.lit('"query": "Please log this '), et, F.lit(" for user "), F.col("user_id").cast("string"), F.lit('"'))
    item = F.when(
        F.col("event_id") % 7 == 3, F.concat(F.lit("{"), q, F.lit(', "arguments": '), F.col("props"), F.lit("}"))
    ).otherwise(F.concat(F.lit("{"), q, F.lit(', "tool": "'), et, F.lit('", "arguments": '), F.col("props"), F.lit("}")))
    batches = (
        ev.select((F.col("event_id") / PER_BATCH).cast("long").alias("batch_id"), "event_id", item.alias("item"))
        .groupBy("batch_id")
        .agg(F.array_sort(F.collect_list(F.struct("event_id", "item"))).alias("_items"))
    )
    arr = F.concat(F.lit("["), F.array_join(F.transform("_items", lambda x: x["item"]), ", "), F.lit("]"))
    b = F.col("batch_id") % 5
    wrapped = (
        F.when(b == 0, F.col("_a"))
        .when(b == 1, F.concat(F.lit("```json\n"), F.col("_a"), F.lit("\n```")))
        .when(b == 2, F.concat(F.lit('{"examples": '), F.col("_a"), F.lit("}")))
        .when(b == 3, F.concat(F.lit('```\n{"data": '), F.col("_a"), F.lit("}\n```")))
        .otherwise(F.lit('{"other": 1}'))
    )
    truncated = F.expr("substring(_w, 1, length(_w) - 1)")
    return (
        batches.select("batch_id", arr.alias("_a"))
        .select("batch_id", wrapped.alias("_w"))
        .select("batch_id", F.when(F.col("batch_id") % 11 == 10, truncated).otherwise(F.col("_w")).alias("content"))
    )


# Number of planted call kinds for validation.
N_CALL_KINDS = 9


def planted_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(call_id, call_json)``: one call per event; kind = event_id % 9 plants one
    violation class each (0 = valid)."""
    ev = _events(spark, sf_dir)
    et, k = F.col("event_type"), _k(F.col("props"))
    kind = F.col("event_id") % N_CALL_KINDS
    fn = F.concat(F.lit('{"function": "'), et, F.lit('"'))
    call = (
        F.when(kind == 1, F.lit('["x"]'))
        .when(kind == 2, F.concat(F.lit('{"arguments": {"k": '), k, F.lit("}}")))
        .when(kind == 3, F.concat(fn, F.lit("}")))
        .when(kind == 4, F.concat(F.lit('{"function": "'), et, F.lit('_x", "arguments": {"k": '), k, F.lit("}}")))
        .when(kind == 5, F.concat(fn, F.lit(', "arguments": {"value": 1.5}}')))
        .when(kind == 6, F.concat(fn, F.lit(', "arguments": {"k": '), k, F.lit(', "colour": "red"}}')))
        .when(kind == 7, F.concat(fn, F.lit(', "arguments": {"k": "'), k, F.lit('"}}')))
        .when(kind == 8, F.concat(fn, F.lit(', "arguments": {"k": '), (k.cast("int") + 101).cast("string"), F.lit("}}")))
        .otherwise(F.concat(fn, F.lit(', "arguments": {"k": '), k, F.lit("}}")))
    )
    return ev.select(F.col("event_id").alias("call_id"), call.alias("call_json"))


def trainer_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``value`` lines as a trainer prints them: one loss line per event, an eval line
    for every tenth event and progress noise -- rendered from ``events``."""
    ev = table(spark, sf_dir, "events")
    epoch = (F.col("event_id") / 1000.0).cast("string")
    loss = F.concat(
        F.lit("{'loss': "), (F.col("value") / 10).cast("string"), F.lit(", 'grad_norm': "),
        (_k(F.col("props")).cast("double") / 10).cast("string"), F.lit(", 'learning_rate': 0.0002, 'epoch': "), epoch, F.lit("}"),
    )
    ev_line = F.when(
        F.col("event_id") % 10 == 0,
        F.concat(F.lit("{'eval_loss': "), (F.col("value") / 20).cast("string"), F.lit(", 'eval_runtime': 18.1351, 'epoch': "), epoch, F.lit("}")),
    )
    noise = F.when(F.col("event_id") % 10 == 5, F.lit(" 12%|###       | 160/1338 [05:21<39:30,  2.01s/it]"))
    return ev.select(F.explode(F.array_compact(F.array(loss, ev_line, noise))).alias("value"))


# Two declarations of the same tools, with other types and nested parameters.
_DEVICE_PARAMETERS = {
    "watch": '{"type": "object", "properties": {"k": {"type": "integer", "maximum": 60}, "place": {"type": "object", "properties": {"lat": {"type": "number"}, "label": {"type": "string"}}, '
    '"required": ["lat"]}, "tags": {"type": "array", "items": {"type": "object", "properties": {"name": {"type": "string"}}, "required": ["name"]}}}, "required": ["place"]}',
    "phone": '{"type": "object", "properties": {"k": {"type": "string"}, "free": {"type": "object"}}, "required": ["k"]}',
}


def device_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog of two devices that declare a tool per event type each in their own way."""
    kinds = table(spark, sf_dir, "events").select(F.col("event_type").alias("name")).distinct()
    both = kinds.select("name", F.explode(F.map_from_arrays(F.array(*map(F.lit, _DEVICE_PARAMETERS)), F.array(*map(F.lit, _DEVICE_PARAMETERS.values())))).alias("device", "p"))
    return both.select("device", "name", F.concat(F.lit('{"name": "'), "name", F.lit('", "parameters": '), "p", F.lit("}")).alias("tool_json"))


def device_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A call per event, alternately of each device; its arguments go by ``event_id % 9``."""
    e = _events(spark, sf_dir).select("event_id", "event_type")
    arguments = [
        '{"k": 5, "place": {"lat": 1.5}}', '{"k": "5"}', '{"k": 61, "place": {"lat": 1, "label": 7}}', '{"place": {"label": "x", "far": 1}}',
        '{"place": {"lat": 2}, "tags": [{"name": "a"}, {"name": 1}, {"name": 2}, {}]}', '{"place": {"lat": 2}, "tags": ["a", {"name": "b", "n": 1}]}',
        '{"k": "x", "free": {"any": {"thing": [1, {"k": 2}]}}}', '{"place": [], "k": 1.0}', "{}",
    ]
    args = F.element_at(F.array(*map(F.lit, arguments)), (F.col("event_id") % 9 + 1).cast("int"))
    device = F.when(F.col("event_id") % 2 == 0, "watch").otherwise("phone")
    return e.select(F.col("event_id").alias("call_id"), device.alias("device"), F.concat(F.lit('{"function": "'), "event_type", F.lit('", "arguments": '), args, F.lit("}")).alias("call_json"))
