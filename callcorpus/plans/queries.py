"""Driver-facing queries: one callable per operator group, each with a DuckDB oracle.

Every query reads the driver tables (``sf_dir``) in full; derived inputs are built
by Spark from them (``plans.derived``). Output columns are aliased identically in
the Spark query and in its oracle SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import jsonx as JX, segments as SG
from ..functions.text import PY_WHITESPACE, keep_where
from ..operators import catalog as CT, formatters as FM, runlogs as RLG, scoring, selection as SEL, split as SP
from ..operators import tables as TB, teacher as TC, validate as VL
from . import derived as D

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


# ---------------------------------------------------------------------------
# scoring: J2 J9 N1 N2 C1 C2 C3 C5 W1 P6 P7
# ---------------------------------------------------------------------------

def scored_details(spark: SparkSession, sf_dir: str, numbered: bool = False) -> DataFrame:
    cases = D.eval_cases(spark, sf_dir)
    if numbered:
        cases = scoring.number_cases(cases)
    preds = D.eval_predictions(spark, sf_dir)
    return scoring.score_rows(scoring.pair_predictions(cases, preds, D.model_runs(spark, sf_dir)))


# Oracle building blocks: the same planted kinds, with their verdicts by rule.
_ORACLE_PRED = """
WITH m AS (SELECT * FROM (VALUES (0), (1), (2), (3)) t(m)),
p AS (
  SELECT 'model_' || CAST(m AS VARCHAR) AS model_name, event_id AS example_id, event_type AS et, props,
         json_extract_string(props, '$.k') AS kval, (event_id + m) % 12 AS kind
  FROM events, m),
v AS (
  SELECT *, kind NOT IN (4, 6, 9) AS valid_json,
         kind IN (0, 1, 3, 7, 8, 10, 11) AS function_match,
         kind IN (0, 1, 2, 7, 11) AS args_match,
         kind IN (0, 1, 7, 11) AS exact_match,
         CASE kind
           WHEN 0 THEN '{"function": "' || et || '", "arguments": ' || props || '}'
           WHEN 1 THEN 'Sure! {"function": "' || et || '", "arguments": ' || props || '} Hope this helps {"x": 1}'
           WHEN 2 THEN '{"function": "' || et || '_v2", "arguments": ' || props || '}'
           WHEN 3 THEN '{"function": "' || et || '", "arguments": {"k": "' || kval || '"}}'
           WHEN 4 THEN '{"function": "' || et || '", "arguments": ' || props
           WHEN 5 THEN '{}'
           WHEN 6 THEN 'I cannot help with that.'
           WHEN 7 THEN '{"arguments": {"k": ' || kval || '.0}, "function": "' || et || '"}'
           WHEN 8 THEN '{"function": "' || et || '"}'
           WHEN 9 THEN '{''function'': ''' || et || ''', ''arguments'': {''k'': ' || kval || '}}'
           WHEN 10 THEN '{"function": "' || et || '", "arguments": {"k": ' || kval || ', "note": "a } \\" {"}}'
           ELSE '```json' || chr(10) || '{"function": "' || et || '", "arguments": ' || props || '}' || chr(10) || '```'
         END AS raw_output
  FROM p)
"""


@register(
    "eval_scoreboard",
    _ORACLE_PRED
    + """
, agg AS (
  SELECT model_name, COUNT(*)::BIGINT AS total,
         COUNT(*) FILTER (WHERE valid_json)::BIGINT AS valid_json,
         COUNT(*) FILTER (WHERE function_match)::BIGINT AS function_match,
         COUNT(*) FILTER (WHERE args_match)::BIGINT AS args_match,
         COUNT(*) FILTER (WHERE exact_match)::BIGINT AS exact_match
  FROM v GROUP BY model_name)
SELECT *, printf('%.1f', valid_json::DOUBLE / total * 100) AS valid_json_pct,
       printf('%.1f', function_match::DOUBLE / total * 100) AS function_match_pct,
       printf('%.1f', args_match::DOUBLE / total * 100) AS args_match_pct,
       printf('%.1f', exact_match::DOUBLE / total * 100) AS exact_match_pct
FROM agg
""",
)
def eval_scoreboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.run_scoreboard(D.eval_cases(spark, sf_dir), D.eval_predictions(spark, sf_dir), D.model_runs(spark, sf_dir))


@register(
    "eval_failures",
    _ORACLE_PRED
    + """
SELECT model_name, example_id, valid_json, function_match, args_match, substr(raw_output, 1, 100) AS raw_preview
FROM v WHERE NOT exact_match
""",
)
def eval_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scoring.failures(scored_details(spark, sf_dir))
    return rows.select("model_name", "example_id", "valid_json", "function_match", "args_match", "raw_preview")


@register(
    "eval_numbering",
    """
SELECT 'model_' || CAST(m AS VARCHAR) AS model_name, event_id AS example_id,
       row_number() OVER (PARTITION BY m ORDER BY event_id)::BIGINT AS position,
       COUNT(*) OVER (PARTITION BY m)::BIGINT AS total
FROM events, (VALUES (0), (1), (2), (3)) t(m)
""",
)
def eval_numbering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_details(spark, sf_dir, numbered=True).select("model_name", "example_id", "position", "total")


# ---------------------------------------------------------------------------
# formatting: F1 F2 F3 F4 F9 P1-P4 J1 J6 J7
# ---------------------------------------------------------------------------


_NL = "chr(10)"
_WS_LIT = "'" + PY_WHITESPACE.replace("'", "''") + "'"

_ORACLE_XLAM = f"""
WITH x AS (
  SELECT event_id AS id, event_type AS et, props, json_extract_string(props, '$.k') AS kval,
         CAST(user_id AS VARCHAR) AS uid, event_id % 13 AS kind FROM events),
y AS (
  SELECT id, kind,
    CASE WHEN kind = 1 THEN 'answers_unparseable' WHEN kind IN (2, 3) THEN 'no_call'
         WHEN kind = 6 THEN 'tools_malformed' WHEN kind = 4 THEN 'no_query'
         WHEN kind = 11 THEN 'call_not_object' END AS reject_reason,
    CASE WHEN kind IN (5, 7) THEN ''
         ELSE {_NL} || {_NL} || 'Available functions:' || {_NL} || '- ' || et ||
              CASE WHEN kind = 8 THEN '()' WHEN kind = 9 THEN '(k?: string)' ELSE '(k: integer, value?: number)' END
              || {_NL} || '  Record one ' || et || ' event' || {_NL} END AS tools_text,
    CASE WHEN kind = 12 THEN '{{"function": "' || et || '", "arguments": {{"k": ' || kval || ', "note": "caf\\u00e9 \\u2615"}}}}'
         ELSE '{{"function": "' || et || '", "arguments": ' || props || '}}' END AS assistant,
    'Log a ' || et || ' event for user ' || uid AS query
  FROM x)
"""

_TEXT_EXPR = (
    f"'<|im_start|>system' || {_NL} || 'You are a helpful assistant with access to functions. Use them when appropriate.'"
    f" || tools_text || {_NL} || {_NL} || 'Output format: {{\"function\": \"function_name\", \"arguments\": {{...}}}}'"
    f" || '<|im_end|>' || {_NL} || '<|im_start|>user' || {_NL} || query || '<|im_end|>' || {_NL}"
    f" || '<|im_start|>assistant' || {_NL} || assistant || '<|im_end|>'"
)


@register("xlam_text", _ORACLE_XLAM + f"SELECT id, {_TEXT_EXPR} AS text FROM y WHERE reject_reason IS NULL")
def xlam_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    formatted = FM.xlam_format(D.xlam_rows(spark, sf_dir))
    return FM.drop_failed(formatted).select("id", "text")


@register("xlam_rejects", _ORACLE_XLAM + "SELECT id, reject_reason FROM y WHERE reject_reason IS NOT NULL")
def xlam_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FM.rejects(FM.xlam_format(D.xlam_rows(spark, sf_dir))).select("id", "reject_reason")


@register(
    "xlam_reject_counts",
    _ORACLE_XLAM + "SELECT reject_reason, COUNT(*)::BIGINT AS n FROM y WHERE reject_reason IS NOT NULL GROUP BY 1",
)
def xlam_reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FM.reject_counts(FM.xlam_format(D.xlam_rows(spark, sf_dir)))


_ORACLE_HERMES = f"""
WITH h AS (
  SELECT conv_id,
         string_agg('<|im_start|>' || coalesce(role, 'user') || {_NL} || coalesce(text, '') || '<|im_end|>', {_NL} ORDER BY turn) AS text
  FROM conversations GROUP BY conv_id)
"""


@register("hermes_text", _ORACLE_HERMES + "SELECT conv_id, text FROM h")
def hermes_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FM.hermes_format(D.hermes_rows(spark, sf_dir)).select("conv_id", "text")


_ORACLE_GLAIVE = f"""
WITH c AS (
  SELECT conv_id,
         coalesce(arg_min(text, turn) FILTER (WHERE role = 'system'), 'You are a helpful assistant.') AS system,
         coalesce(string_agg(CASE WHEN role = 'user' THEN 'USER: ' ELSE 'ASSISTANT: ' END || text, {_NL} ORDER BY turn)
                  FILTER (WHERE role <> 'system'), '') || {_NL} || '<|endoftext|>' AS chat
  FROM conversations GROUP BY conv_id),
s AS (SELECT conv_id, system, string_split(trim(replace(chat, '<|endoftext|>', ''), {_WS_LIT}), {_NL}) AS lines FROM c),
l AS (SELECT conv_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM s),
m AS (
  SELECT conv_id, i,
         CASE WHEN starts_with(line, 'USER:') THEN 'user' WHEN starts_with(line, 'ASSISTANT:') THEN 'assistant' END AS role,
         CASE WHEN starts_with(line, 'USER:') THEN trim(substr(line, 6), {_WS_LIT})
              WHEN starts_with(line, 'ASSISTANT:') THEN trim(substr(line, 11), {_WS_LIT})
              ELSE trim(line, {_WS_LIT}) END AS content
  FROM l),
b AS (
  SELECT *, SUM(CASE WHEN role IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY i) AS blk
  FROM m WHERE role IS NOT NULL OR content <> ''),
blocks AS (
  SELECT conv_id, blk, '<|im_start|>' || max(role) || {_NL} || string_agg(content, {_NL} ORDER BY i) || '<|im_end|>' AS block
  FROM b WHERE blk > 0 GROUP BY conv_id, blk),
g AS (
  SELECT s.conv_id, '<|im_start|>system' || {_NL} || s.system || '<|im_end|>' || {_NL}
         || coalesce((SELECT string_agg(block, {_NL} ORDER BY blk) FROM blocks WHERE blocks.conv_id = s.conv_id), '') AS text
  FROM s)
"""


@register("glaive_text", _ORACLE_GLAIVE + "SELECT conv_id, text FROM g")
def glaive_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FM.glaive_format(D.glaive_rows(spark, sf_dir)).select("conv_id", "text")


@register(
    "segments",
    _ORACLE_HERMES
    + f"""
SELECT conv_id,
  trim(CASE WHEN contains(text, '<|im_start|>assistant' || {_NL})
            THEN split_part(string_split(text, '<|im_start|>assistant' || {_NL})[-1], '<|im_end|>', 1)
            ELSE text END, {_WS_LIT}) AS last_assistant,
  CASE WHEN contains(text, '<|im_start|>user' || {_NL})
       THEN split_part(string_split(text, '<|im_start|>user' || {_NL})[2], '<|im_end|>', 1) END AS first_user
FROM h
""",
)
def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = FM.hermes_format(D.hermes_rows(spark, sf_dir))
    return texts.select(
        "conv_id",
        SG.last_assistant_segment("text").alias("last_assistant"),
        SG.first_user_segment("text").alias("first_user"),
    )


# ---------------------------------------------------------------------------
# splits: T1 T2 L1 C6 (documents)
# ---------------------------------------------------------------------------


_ORACLE_HASH_SPLIT = """
WITH r AS (
  SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id) AS rn,
         COUNT(*) OVER () AS n
  FROM documents)
SELECT doc_id, CASE WHEN rn <= ceil(n * 0.05) THEN 'val' ELSE 'train' END AS split FROM r
"""


@register("hash_split", _ORACLE_HASH_SPLIT)
def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = D.table(spark, sf_dir, "documents").select("doc_id")
    return SP.hash_split(docs, "doc_id", 0.05, 42).select("doc_id", "split")


@register(
    "split_counts",
    f"SELECT split, COUNT(*)::BIGINT AS n FROM ({_ORACLE_HASH_SPLIT}) GROUP BY split",
)
def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SP.split_counts(hash_split(spark, sf_dir))


@register(
    "ordered_split",
    """
SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY doc_id) <= floor(COUNT(*) OVER () * 0.95) THEN 'train' ELSE 'val' END AS split
FROM documents
""",
)
def ordered_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = D.table(spark, sf_dir, "documents").select("doc_id")
    return SP.ordered_split(docs, ["doc_id"], 0.95).select("doc_id", "split")


@register("head_n", "SELECT doc_id, n_chars, lang FROM documents ORDER BY doc_id LIMIT 100")
def head_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    # L1 max_samples=100: the limit is the operator itself (first-N sampling)
    docs = D.table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang")
    return SP.head(docs, ["doc_id"], 100)


# ---------------------------------------------------------------------------
# teacher replies: J3 J4 J5 F5 F1b C8 U1
# ---------------------------------------------------------------------------


_ORACLE_TEACHER = f"""
WITH cat AS (
  SELECT string_agg('- ' || et || '(k: integer, value?: number)' || {_NL} || '  Record one ' || et || ' event' || {_NL}, '' ORDER BY et) AS tt
  FROM (SELECT DISTINCT event_type AS et FROM events)),
e AS (
  SELECT event_id // 10 AS batch_id, (row_number() OVER (PARTITION BY event_id // 10 ORDER BY event_id) - 1)::BIGINT AS item_pos,
         event_id, event_type AS et, props, CAST(user_id AS VARCHAR) AS uid
  FROM events),
ok AS (
  SELECT e.*, cat.tt FROM e, cat
  WHERE batch_id % 5 <> 4 AND batch_id % 11 <> 10 AND event_id % 7 <> 3)
"""


def _event_tools_text(spark: SparkSession, sf_dir: str) -> str:
    return CT.catalog_text(D.event_tools(spark, sf_dir).select("ord", "tool_json"), strict=True)


@register(
    "teacher_unpack",
    _ORACLE_TEACHER
    + f"""
SELECT batch_id, item_pos,
  '<|im_start|>system' || {_NL} || 'You are a helpful assistant with access to functions. Use them when appropriate.'
  || {_NL} || {_NL} || 'Available functions:' || {_NL} || tt || {_NL} || {_NL}
  || 'Output format: {{"function": "function_name", "arguments": {{...}}}}' || '<|im_end|>' || {_NL}
  || '<|im_start|>user' || {_NL} || 'Please log this ' || et || ' for user ' || uid || '<|im_end|>' || {_NL}
  || '<|im_start|>assistant' || {_NL} || '{{"function": "' || et || '", "arguments": ' || props || '}}' || '<|im_end|>' AS text
FROM ok
""",
)
def teacher_unpack(spark: SparkSession, sf_dir: str) -> DataFrame:
    tools_text = _event_tools_text(spark, sf_dir)
    items = TC.unpack(D.teacher_replies(spark, sf_dir), tools_text)
    return keep_where(items, F.col("item_ok")).select("batch_id", "item_pos", "text")


@register(
    "teacher_yield",
    _ORACLE_TEACHER
    + """
, b AS (SELECT DISTINCT batch_id FROM e)
SELECT b.batch_id,
  CASE WHEN b.batch_id % 11 = 10 THEN 'invalid_json' WHEN b.batch_id % 5 = 4 THEN 'unexpected_format' ELSE 'ok' END AS status,
  10::BIGINT AS requested,
  (SELECT COUNT(*) FROM ok WHERE ok.batch_id = b.batch_id)::BIGINT AS obtained
FROM b
""",
)
def teacher_yield(spark: SparkSession, sf_dir: str) -> DataFrame:
    tools_text = _event_tools_text(spark, sf_dir)
    return TC.batch_yield(D.teacher_replies(spark, sf_dir), tools_text, D.PER_BATCH)


# ---------------------------------------------------------------------------
# validation: R1 (with the S5 catalog normalisation)
# ---------------------------------------------------------------------------


@register(
    "validate_calls",
    """
WITH c AS (SELECT event_id AS call_id, event_id % 9 AS kind FROM events)
SELECT call_id, 'not_object' AS violation, NULL::VARCHAR AS param FROM c WHERE kind = 1
UNION ALL SELECT call_id, 'missing_function', NULL FROM c WHERE kind = 2
UNION ALL SELECT call_id, 'missing_arguments', NULL FROM c WHERE kind = 3
UNION ALL SELECT call_id, 'missing_required', 'k' FROM c WHERE kind IN (3, 5)
UNION ALL SELECT call_id, 'unknown_function', NULL FROM c WHERE kind = 4
UNION ALL SELECT call_id, 'unknown_param', 'colour' FROM c WHERE kind = 6
UNION ALL SELECT call_id, 'wrong_type', 'k' FROM c WHERE kind = 7
UNION ALL SELECT call_id, 'over_maximum', 'k' FROM c WHERE kind = 8
""",
)
def validate_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    tools = D.event_tools(spark, sf_dir).select(F.lit("events").alias("device"), "ord", "name", F.lit(None).cast("string").alias("description"), "tool_json")
    params = CT.catalog_params(tools)
    return VL.validate_calls(D.planted_calls(spark, sf_dir), params, tools=tools).select("call_id", "violation", "param")


@register(
    "validate_devices",
    """
WITH f(device, kind, violation, param) AS (VALUES
  ('watch', 1, 'wrong_type', 'k'), ('watch', 1, 'missing_required', 'place'),
  ('watch', 2, 'over_maximum', 'k'), ('watch', 2, 'wrong_type', 'place.label'),
  ('watch', 3, 'unknown_param', 'place.far'), ('watch', 3, 'missing_required', 'place.lat'),
  ('watch', 4, 'wrong_type', 'tags[].name'), ('watch', 4, 'missing_required', 'tags[].name'),
  ('watch', 5, 'wrong_type', 'tags[]'), ('watch', 5, 'unknown_param', 'tags[].n'),
  ('watch', 6, 'wrong_type', 'k'), ('watch', 6, 'unknown_param', 'free'), ('watch', 6, 'missing_required', 'place'),
  ('watch', 7, 'wrong_type', 'place'), ('watch', 8, 'missing_required', 'place'),
  ('phone', 0, 'wrong_type', 'k'), ('phone', 0, 'unknown_param', 'place'),
  ('phone', 2, 'wrong_type', 'k'), ('phone', 2, 'unknown_param', 'place'),
  ('phone', 3, 'unknown_param', 'place'), ('phone', 3, 'missing_required', 'k'),
  ('phone', 4, 'unknown_param', 'place'), ('phone', 4, 'unknown_param', 'tags'), ('phone', 4, 'missing_required', 'k'),
  ('phone', 5, 'unknown_param', 'place'), ('phone', 5, 'unknown_param', 'tags'), ('phone', 5, 'missing_required', 'k'),
  ('phone', 7, 'unknown_param', 'place'), ('phone', 7, 'wrong_type', 'k'), ('phone', 8, 'missing_required', 'k'))
SELECT event_id AS call_id, violation, param FROM events
JOIN f ON f.device = CASE WHEN event_id % 2 = 0 THEN 'watch' ELSE 'phone' END AND f.kind = event_id % 9
""",
)
def validate_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    tools = D.device_tools(spark, sf_dir)
    return VL.validate_calls(D.device_calls(spark, sf_dir), CT.catalog_paths(tools), tools=tools, device_col="device")


# ---------------------------------------------------------------------------
# table tools: R2 R3 R4 R5 R6 R7 R8 R11
# ---------------------------------------------------------------------------


_RE2_WS = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in PY_WHITESPACE) + "]"


@register(
    "paged_filter",
    """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
WHERE o_orderstatus IN ('O', 'F')
  AND o_orderdate >= TIMESTAMP '1996-01-01 00:00:00' AND o_orderdate <= TIMESTAMP '1998-12-31 23:59:59'
ORDER BY o_orderdate DESC, o_orderkey LIMIT 20 OFFSET 40
""",
)
def paged_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = D.table(spark, sf_dir, "orders")
    out = TB.conversations_query(
        orders, created_col="o_orderdate", status_col="o_orderstatus", id_col="o_orderkey",
        start_date="1996-01-01T00:00:00+00:00", end_date="1998-12-31T23:59:59+00:00", statuses="O,F", limit=20, offset=40,
    )
    return out.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@register(
    "paged_filter_deep",
    """
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('O', 'F')
ORDER BY o_orderdate DESC, o_orderkey LIMIT 50 OFFSET 5000
""",
)
def paged_filter_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = D.table(spark, sf_dir, "orders").filter(F.col("o_orderstatus").isin("O", "F"))
    out = SEL.page(orders, [SEL.desc("o_orderdate"), "o_orderkey"], 5000, 50)
    return out.select("o_orderkey", "o_orderstatus")


_TEXT_KEYS = """
  SELECT l_orderkey, l_linenumber, l_linestatus || '/' || l_returnflag || CAST(l_orderkey % 1000 AS VARCHAR) AS label,
         CASE WHEN l_linenumber = 3 THEN NULL ELSE l_extendedprice * (1 - 2 * (l_orderkey % 2)) END AS price, copy
  FROM lineitem, (SELECT unnest([0, 1, 2, 3, 4]) AS copy)
"""


def _text_keyed(spark: SparkSession, sf_dir: str):
    """Every lineitem row five times: over 200,000 rows from sf0.01 on."""
    return D.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.concat("l_linestatus", F.lit("/"), "l_returnflag", (F.col("l_orderkey") % 1000).cast("string")).alias("label"),
        F.when(F.col("l_linenumber") != 3, F.col("l_extendedprice") * (1 - 2 * (F.col("l_orderkey") % 2))).alias("price"),
        F.explode(F.array(*[F.lit(k) for k in range(5)])).alias("copy"),
    )


@register(
    "text_page_deep",
    f"""
SELECT l_orderkey, l_linenumber, copy, label FROM ({_TEXT_KEYS})
ORDER BY label DESC, price ASC NULLS FIRST, l_orderkey, l_linenumber, copy LIMIT 500 OFFSET 200000
""",
)
def text_page_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _text_keyed(spark, sf_dir)
    out = SEL.page(rows, [SEL.desc("label"), "price", "l_orderkey", "l_linenumber", "copy"], 200_000, 500)
    return out.select("l_orderkey", "l_linenumber", "copy", "label")


@register(
    "text_split",
    f"""
SELECT label, split, COUNT(*)::BIGINT AS n FROM (
  SELECT label, CASE WHEN row_number() OVER (ORDER BY price DESC NULLS LAST, label, l_orderkey, l_linenumber, copy) <= floor(COUNT(*) OVER () * 0.95) THEN 'train' ELSE 'val' END AS split
  FROM ({_TEXT_KEYS}))
GROUP BY label, split
""",
)
def text_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _text_keyed(spark, sf_dir)
    out = SP.ordered_split(rows, [SEL.desc("price"), "label", "l_orderkey", "l_linenumber", "copy"], 0.95)
    return out.groupBy("label", "split").agg(F.count(F.lit(1)).alias("n"))


@register(
    "memories",
    """
SELECT event_id, user_id FROM events
WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts <= TIMESTAMP '2024-01-20 00:00:00'
ORDER BY ts DESC, event_id LIMIT 50 OFFSET 100
""",
)
def memories(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = D.table(spark, sf_dir, "events")
    out = TB.memories_query(ev, "ts", "event_id", "2024-01-10T00:00:00+00:00", "2024-01-20T00:00:00+00:00", limit=50, offset=100)
    return out.select("event_id", "user_id")


@register(
    "action_items",
    """
WITH a AS (
  SELECT o_orderkey, o_custkey, o_orderdate AS created_at, o_orderstatus = 'F' AS completed,
         o_orderdate + to_days(CAST(substr(o_orderpriority, 1, 1) AS INTEGER) * 7) AS due_at
  FROM orders)
SELECT o_orderkey, o_custkey FROM a
WHERE NOT completed AND created_at >= TIMESTAMP '1996-01-01 00:00:00' AND created_at <= TIMESTAMP '1997-12-31 00:00:00'
  AND due_at <= TIMESTAMP '1997-06-30 00:00:00'
ORDER BY created_at DESC, o_orderkey LIMIT 50 OFFSET 10
""",
)
def action_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = D.table(spark, sf_dir, "orders")
    items = orders.select(
        "o_orderkey", "o_custkey",
        F.col("o_orderdate").alias("created_at"),
        (F.col("o_orderstatus") == "F").alias("completed"),
        F.col("o_custkey").cast("string").alias("conversation_id"),
        (F.col("o_orderdate") + F.make_dt_interval(days=F.substring("o_orderpriority", 1, 1).cast("int") * 7)).alias("due_at"),
    )
    out = TB.action_items_query(
        items, "o_orderkey", "created_at", "due_at", "completed", "conversation_id", completed=False,
        start_date="1996-01-01T00:00:00+00:00", end_date="1997-12-31T00:00:00+00:00", due_end_date="1997-06-30T00:00:00+00:00",
        limit=50, offset=10,
    )
    return out.select("o_orderkey", "o_custkey")


@register(
    "transcripts",
    f"""
SELECT conv_id, COUNT(*)::BIGINT AS n_segments,
       string_agg('[' || CAST(turn AS VARCHAR) || '] ' || role || ': ' || text, {_NL} ORDER BY turn) AS transcript
FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM conversations)
WHERE rn <= 2 GROUP BY conv_id
""",
)
def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = D.table(spark, sf_dir, "conversations")
    return TB.transcripts(conv, "conv_id", "turn", "role", "text", max_segments=2, include_timestamps=True)


_ORACLE_VEC = """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
u AS (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM e),
d AS (SELECT label, i, avg(x) AS m FROM u GROUP BY label, i),
c AS (SELECT label AS query_id, list(m ORDER BY i) AS q FROM d GROUP BY label),
s AS (SELECT query_id, vec_id,
             list_dot_product(q, v) / (sqrt(list_dot_product(q, q)) * sqrt(list_dot_product(v, v))) AS score
      FROM c, e),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
"""


def _centroid_queries(spark: SparkSession, sf_dir: str):
    emb = D.table(spark, sf_dir, "embeddings")
    cents = TB.label_centroids(emb, "label", "embedding")
    return emb, cents.select("label", "centroid")


@register(
    "vector_topk",
    _ORACLE_VEC + "SELECT query_id::BIGINT AS query_id, rank::BIGINT AS rank, vec_id, round(score, 6) AS score FROM r WHERE rank <= 5",
)
def vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb, qs = _centroid_queries(spark, sf_dir)
    out = TB.vector_search(emb, qs, "vec_id", "embedding")  # default limit 5
    return out.select(F.col("query_id").cast("long").alias("query_id"), "rank", "vec_id", F.round("score", 6).alias("score"))


@register(
    "paged_search",
    _ORACLE_VEC
    + "SELECT query_id::BIGINT AS query_id, rank::BIGINT AS rank, vec_id, round(score, 6) AS score FROM r WHERE rank BETWEEN 11 AND 20",
)
def paged_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Page 2 of 10 results per page -> ranks 11..20
    emb, qs = _centroid_queries(spark, sf_dir)
    out = TB.paged_search(emb, qs, "vec_id", "embedding", page=2)  # default 10 per page
    return out.select(F.col("query_id").cast("long").alias("query_id"), "rank", "vec_id", F.round("score", 6).alias("score"))


@register(
    "vector_neighbours",
    """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
s AS (
  SELECT q.vec_id AS query_id, e.vec_id, list_dot_product(q.v, e.v) / (sqrt(list_dot_product(q.v, q.v)) * sqrt(list_dot_product(e.v, e.v))) AS score
  FROM e q, e),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::BIGINT AS rank, round(score, 6) AS score FROM r WHERE rank <= 5
""",
)
def vector_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    # every vector is a query: the query side is a table like any other
    emb = D.table(spark, sf_dir, "embeddings")
    out = TB.vector_search(emb, emb.select("vec_id", "embedding"), "vec_id", "embedding")
    return out.select("query_id", "rank", F.round("score", 6).alias("score"))


@register(
    "upsert_state",
    """
WITH u AS (
  SELECT user_id, ts, event_id,
         CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_type || ' #' || CAST(event_id AS VARCHAR) END AS description,
         CASE WHEN event_id % 4 = 0 THEN NULL ELSE value > 50 END AS completed,
         CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS due_k
  FROM events)
SELECT user_id, COUNT(*)::BIGINT AS n_updates,
       arg_max(description, (ts, event_id)) FILTER (WHERE description IS NOT NULL) AS description,
       arg_max(completed, (ts, event_id)) FILTER (WHERE completed IS NOT NULL) AS completed,
       arg_max(due_k, (ts, event_id)) FILTER (WHERE due_k IS NOT NULL) AS due_k
FROM u GROUP BY user_id
""",
)
def upsert_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = D.table(spark, sf_dir, "events")
    updates = ev.select(
        "user_id", "ts", "event_id",
        F.when(F.col("event_id") % 3 == 0, F.lit(None)).otherwise(F.concat("event_type", F.lit(" #"), F.col("event_id").cast("string"))).alias("description"),
        F.when(F.col("event_id") % 4 == 0, F.lit(None)).otherwise(F.col("value") > 50).alias("completed"),
        F.when(F.col("event_id") % 5 == 0, F.lit(None)).otherwise(F.get_json_object("props", "$.k").cast("long")).alias("due_k"),
    )
    return TB.upsert_state(updates, "user_id", ["ts", "event_id"], ["description", "completed", "due_k"])


@register(
    "length_budget",
    f"""
WITH t AS (
  SELECT CASE WHEN trim(text, {_WS_LIT}) = '' THEN 0
              ELSE len(regexp_split_to_array(trim(text, {_WS_LIT}), '{_RE2_WS}+')) END AS tokens
  FROM documents)
SELECT (least(tokens // 512, 8) * 512)::BIGINT AS bucket, COUNT(*)::BIGINT AS n_docs,
       COUNT(*) FILTER (WHERE tokens > 2048)::BIGINT AS n_over_budget
FROM t GROUP BY 1
""",
)
def length_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators import runlogs as RL

    docs = D.table(spark, sf_dir, "documents")
    return RL.length_histogram(docs, "text", bucket_width=512, n_buckets=8, budget=2048)


_ORACLE_TOKENS = f"""
WITH t AS (
  SELECT CASE WHEN trim(text, {_WS_LIT}) = '' THEN 0
              ELSE len(regexp_split_to_array(trim(text, {_WS_LIT}), '{_RE2_WS}+')) END AS tokens
  FROM documents)
"""


@register("length_flags", _ORACLE_TOKENS.replace("SELECT ", "SELECT doc_id, ", 1) + "SELECT doc_id, tokens AS n_tokens, tokens > 2048 AS over_budget FROM t")
def length_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = RLG.length_flags(D.table(spark, sf_dir, "documents"), "text")
    return flagged.select("doc_id", F.col("n_tokens").cast("long").alias("n_tokens"), "over_budget")


@register(
    "length_sketches",
    _ORACLE_TOKENS
    + """
SELECT p, COUNT(tokens)::BIGINT AS n_texts, COUNT(*) FILTER (WHERE tokens > 2048)::BIGINT AS n_over_budget, MAX(tokens)::BIGINT AS max_tokens, TRUE AS within
FROM t, (SELECT unnest([0.1, 0.5, 0.9, 0.99]::DOUBLE[]) AS p) GROUP BY p
""",
)
def length_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    # sketches per source and language, merged; then the true ranks of the merged percentiles
    docs = D.table(spark, sf_dir, "documents")
    merged = RLG.merged_lengths(RLG.length_sketches(docs, "text", ["source", "lang"]), percentages=(0.1, 0.5, 0.9, 0.99))
    asked = merged.select("n_texts", "n_over_budget", "max_tokens", F.explode("percentiles").alias("q")).select("*", "q.p", "q.tokens")
    lengths = docs.select(RLG.token_count("text").alias("n")).groupBy("n").agg(F.count(F.lit(1)).alias("c"))
    quantiles = merged.select("percentiles").scalar()
    ranked = lengths.withColumn("q", F.explode(quantiles)).groupBy("q.p").agg(
        F.sum(F.when(F.col("n") < F.col("q.tokens"), F.col("c")).otherwise(0)).alias("less"), F.sum(F.when(F.col("n") <= F.col("q.tokens"), F.col("c")).otherwise(0)).alias("upto")
    )
    # a quantile keeps the bound 99 times in 100; three times the bound is not missed
    slack = F.col("n_texts") * 3 * RLG.rank_error()
    within = (F.col("less") - slack <= F.col("p") * F.col("n_texts")) & (F.col("upto") + slack >= F.col("p") * F.col("n_texts"))
    return asked.join(ranked, "p").select("p", "n_texts", "n_over_budget", "max_tokens", within.alias("within"))


# ---------------------------------------------------------------------------
# run artefacts: R9 R10
# ---------------------------------------------------------------------------


@register(
    "run_metrics",
    """
SELECT 'loss' AS kind, event_id / 1000.0 AS epoch, value / 10 AS loss,
       CAST(json_extract_string(props, '$.k') AS DOUBLE) / 10 AS grad_norm, NULL::DOUBLE AS eval_loss FROM events
UNION ALL
SELECT 'eval', event_id / 1000.0, NULL, NULL, value / 20 FROM events WHERE event_id % 10 = 0
""",
)
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = RLG.parse_metric_lines(D.trainer_log_lines(spark, sf_dir))
    return m.select("kind", "epoch", "loss", "grad_norm", "eval_loss")


@register(
    "run_best_eval",
    """
SELECT min(value / 20) AS best_eval_loss, arg_min(event_id / 1000.0, (value / 20, event_id / 1000.0)) AS best_epoch
FROM events WHERE event_id % 10 = 0
""",
)
def run_best_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RLG.best_eval(RLG.parse_metric_lines(D.trainer_log_lines(spark, sf_dir)))


# Cases per rendered report page (bounds every report text).
REPORT_PAGE = 1000


@register(
    "eval_report",
    _ORACLE_PRED
    + f"""
, n AS (
  SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY example_id) AS position,
         COUNT(*) OVER (PARTITION BY model_name) AS total FROM v)
SELECT model_name, position::BIGINT AS position, total::BIGINT AS total, false AS passed,
       'record a ' || et || ' event' AS command,
       '{{"function": "' || et || '", "arguments": ' || props || '}}' AS expected,
       CASE kind
         WHEN 2 THEN '{{"function": "' || et || '_v2", "arguments": ' || props || '}}'
         WHEN 3 THEN '{{"function": "' || et || '", "arguments": {{"k": "' || kval || '"}}}}'
         WHEN 5 THEN '{{}}'
         WHEN 8 THEN '{{"function": "' || et || '"}}'
         WHEN 10 THEN '{{"function": "' || et || '", "arguments": {{"k": ' || kval || ', "note": "a }} \\" {{"}}}}'
         ELSE 'null' END AS predicted,
       substr(raw_output, 1, 100) AS raw_preview
FROM n WHERE NOT exact_match
""",
)
def eval_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    details = scored_details(spark, sf_dir, numbered=True)
    numbered = details.withColumn("predicted_json", F.coalesce(JX.py_dumps_at("predicted", "$"), F.lit("null")))
    blocks = RLG.render_report_lines(numbered)
    # one report text per (model, page of 1000 cases): bounded texts, parsed in parallel
    pages = blocks.groupBy("model_name", (F.col("position") / REPORT_PAGE).cast("long").alias("page")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "block"))), lambda x: x["block"]), "\n").alias("value")
    )
    parsed = RLG.parse_eval_report(pages)
    return parsed.select("model_name", "position", "total", "passed", "command", "expected", "predicted", "raw_preview")


# ---------------------------------------------------------------------------
# prompts, summaries, file names, chat responses: F6 F7 F1c C4 K3 K5 J8
# ---------------------------------------------------------------------------


# The device name placed into catalog prompts, and the run time stamps.
EVENTS_DEVICE = "Events Backend"
RUN_TS_COMPACT = "20260101_000000"


@register(
    "eval_summary",
    _ORACLE_PRED
    + """
SELECT model_name, COUNT(*) FILTER (WHERE exact_match)::BIGINT AS exact_match, COUNT(*)::BIGINT AS total,
       printf('%.1f', (COUNT(*) FILTER (WHERE exact_match))::DOUBLE / COUNT(*) * 100) || '%' AS accuracy
FROM v GROUP BY model_name
""",
)
def eval_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.summary(scoring.scoreboard(scored_details(spark, sf_dir), with_pct=False))


@register(
    "result_files",
    f"""
SELECT s_nationkey || '/' || s_name || ' v-' || CAST(s_suppkey % 3 AS VARCHAR) AS model_name,
       replace(replace(s_nationkey || '/' || s_name || ' v-' || CAST(s_suppkey % 3 AS VARCHAR), '/', '_'), ' ', '_') || '_{RUN_TS_COMPACT}.json' AS file_name
FROM supplier
""",
)
def result_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    # K5 on names with '/', ' ' and '-', built from table values
    s = D.table(spark, sf_dir, "supplier")
    name = F.concat(F.col("s_nationkey").cast("string"), F.lit("/"), F.col("s_name"), F.lit(" v-"), (F.col("s_suppkey") % 3).cast("string"))
    return scoring.result_file_names(s.select(name.alias("model_name")), RUN_TS_COMPACT)


@register(
    "model_selection",
    """
WITH r AS (
  SELECT s_suppkey AS ord, s_name AS name, 'org/' || lower(s_name) AS model_id, s_nationkey::VARCHAR AS description,
         CASE s_suppkey % 4 WHEN 0 THEN NULL WHEN 1 THEN false ELSE true END AS enabled
  FROM supplier)
SELECT 'enabled' AS how, ord, name, model_id, description, enabled FROM r WHERE coalesce(enabled, true)
UNION ALL SELECT 'by_id', ord, name, model_id, description, enabled FROM r WHERE model_id = 'org/supplier#000000001'
UNION ALL SELECT 'by_name', ord, name, model_id, description, enabled FROM r WHERE name = 'Supplier#000000003'
UNION ALL SELECT 'literal', 1000000000, 'org/none', 'org/none', 'model given by its id', true
""",
)
def model_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    # P5: enabled models, by id (ignores enabled), by name, and an id that the registry lacks
    s = D.table(spark, sf_dir, "supplier")
    kind = F.col("s_suppkey") % 4
    registry = s.select(
        F.col("s_suppkey").alias("ord"), F.col("s_name").alias("name"), F.concat(F.lit("org/"), F.lower("s_name")).alias("model_id"),
        F.col("s_nationkey").cast("string").alias("description"), F.when(kind == 1, False).when(kind != 0, True).alias("enabled"),
    )
    wanted = {"enabled": None, "by_id": "org/supplier#000000001", "by_name": "Supplier#000000003", "literal": "org/none"}
    parts = [scoring.select_models(registry, given).select(F.lit(how).alias("how"), "ord", "name", "model_id", "description", "enabled") for how, given in wanted.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@register(
    "eval_failed_models",
    _ORACLE_PRED
    + """
SELECT model_name, COUNT(*)::BIGINT AS total, COUNT(*) FILTER (WHERE exact_match AND NOT gone)::BIGINT AS exact_match,
       COUNT(*) FILTER (WHERE valid_json AND NOT gone)::BIGINT AS valid_json, COUNT(*) FILTER (WHERE gone)::BIGINT AS missing
FROM (SELECT *, example_id % 7 = 3 AND model_name <> 'model_0' AS gone FROM v WHERE model_name <> 'model_2') GROUP BY model_name
""",
)
def eval_failed_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A model whose run failed is left out of pairing, scoring and the board; the other
    # models lack the predictions of every seventh case
    runs = D.model_runs(spark, sf_dir, failed="model_2")
    told = D.eval_predictions(spark, sf_dir).filter("example_id % 7 != 3 OR model_name = 'model_0'")
    board = scoring.run_scoreboard(D.eval_cases(spark, sf_dir), told, runs, with_pct=False)
    details = scoring.score_rows(scoring.pair_predictions(D.eval_cases(spark, sf_dir), told, runs))
    listed = details.groupBy("model_name").agg(F.count_if(F.col("raw_output").isNull()).alias("missing"))
    return board.join(listed, "model_name").select("model_name", "total", "exact_match", "valid_json", "missing")


@register(
    "eval_python_json",
    """
SELECT event_id AS example_id, event_id % 16 <> 15 AS valid_json, event_id % 16 <> 15 AS function_match,
       event_id % 16 IN (0, 2, 3, 4, 6, 8, 10, 11, 13) AS args_match, event_id % 16 IN (0, 2, 3, 4, 6, 8, 10, 11, 13) AS exact_match
FROM events
""",
)
def eval_python_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    # C1 + J2 on repeated keys, NaN, Infinity and numbers of any length
    rows = scoring.score_rows(D.python_json_calls(spark, sf_dir))
    return rows.select("example_id", "valid_json", "function_match", "args_match", "exact_match")


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@register(
    "plain_prompts",
    f"""
SELECT event_id AS example_id,
  {_sql_text(FM.PLAIN_PROMPT_HEAD.format(tools=CT.EARBUD_FUNCTIONS_TEXT))} || 'record a ' || event_type || ' event' || {_sql_text(FM.PLAIN_PROMPT_TAIL)} AS prompt
FROM events
""",
)
def plain_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # F6, branch without a catalog
    return D.eval_cases(spark, sf_dir).select("example_id", FM.eval_prompt("command").alias("prompt"))


@register(
    "chat_messages",
    f"""
SELECT event_id AS example_id, 'system' AS role_0, {_sql_text(FM.DEFAULT_SYSTEM)} AS content_0, 'user' AS role_1,
       'record a ' || event_type || ' event' AS content_1
FROM events
""",
)
def chat_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    # F7a without a catalog, one column per message field
    m = D.eval_cases(spark, sf_dir).select("example_id", FM.chat_messages("command", FM.chat_system_prompt(None)).alias("m"))
    fields = [F.col("m")[i][f].alias(f"{f}_{i}") for i in (0, 1) for f in ("role", "content")]
    return m.select("example_id", *fields)


@register(
    "conversations_iso_dates",
    """
SELECT o_orderkey, status, created FROM (
  SELECT o_orderkey, o_orderdate, CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'processing' ELSE 'failed' END AS status,
         strftime(o_orderdate + to_hours([0, 2, -5][1 + o_orderkey % 3]), '%Y-%m-%dT%H:%M:%S') || ['Z', '+02:00', '-05:00'][1 + o_orderkey % 3] AS created
  FROM orders)
WHERE o_orderdate >= TIMESTAMP '1996-03-01' AND o_orderdate <= TIMESTAMP '1996-12-31' AND status IN ('processing', 'completed') AND o_orderkey % 7 <> 0
ORDER BY o_orderdate DESC, o_orderkey LIMIT 500
""",
)
def conversations_iso_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    # R2 on ISO text with varied offsets: default statuses, discarded rows, bounds with offsets
    o = D.table(spark, sf_dir, "orders")
    at = F.col("o_orderkey") % 3
    hours = F.when(at == 0, 0).when(at == 1, 2).otherwise(-5)
    wall = F.date_format(F.col("o_orderdate") + F.make_dt_interval(hours=hours), "yyyy-MM-dd'T'HH:mm:ss")
    rows = o.select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "processing").otherwise("failed").alias("status"),
        F.concat(wall, F.when(at == 0, "Z").when(at == 1, "+02:00").otherwise("-05:00")).alias("created"), (F.col("o_orderkey") % 7 == 0).alias("discarded"),
    )
    out = TB.conversations_query(rows, "created", "status", "o_orderkey", "discarded", start_date="1996-03-01T02:00:00+02:00", end_date="1996-12-31T00:00:00Z", limit=500)
    return out.select("o_orderkey", "status", "created")


@register(
    "action_items_filtered",
    """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_orderstatus = 'F' AND o_custkey % 10 = 3 AND o_orderdate + INTERVAL 30 DAY >= TIMESTAMP '1995-06-01'
ORDER BY o_orderdate DESC, o_orderkey LIMIT 100
""",
)
def action_items_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Completed (null for some rows), one conversation, due from
    o = D.table(spark, sf_dir, "orders")
    status = F.col("o_orderstatus")
    rows = o.select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").alias("created"), (F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")).alias("due"),
        F.when(status == "F", True).when(status == "O", False).alias("completed"), F.concat(F.lit("c"), (F.col("o_custkey") % 10).cast("string")).alias("conversation"),
    )
    out = TB.action_items_query(rows, "o_orderkey", "created", "due", "completed", "conversation", completed=True, conversation_id="c3", due_start_date="1995-06-01", limit=100)
    return out.select("o_orderkey", "o_custkey")


@register(
    "transcripts_all",
    f"""
SELECT conv_id, COUNT(*)::BIGINT AS n_segments, string_agg(role || ': ' || text, {_NL} ORDER BY turn) AS transcript
FROM conversations GROUP BY conv_id
""",
)
def transcripts_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    # R3 with -1: the whole conversation is the output row
    return TB.transcripts(D.table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text", max_segments=-1)


@register("sample_rows", "SELECT doc_id, lang, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 5")
def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    # L2: the printed sample; the limit is the feature
    docs = D.table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return SP.sample_rows(docs, [F.col("n_chars").desc(), F.col("doc_id")], 5)


_ORACLE_SINGLE_CAT = f"""
cat AS (
  SELECT string_agg('- ' || et || '(k: integer, value?: number)' || {_NL} || '  Record one ' || et || ' event', {_NL} ORDER BY et) AS tt
  FROM (SELECT DISTINCT event_type AS et FROM events))
"""


@register(
    "eval_prompts",
    "WITH "
    + _ORACLE_SINGLE_CAT
    + f"""
SELECT event_id AS example_id,
  'You are a function-calling assistant for {EVENTS_DEVICE}.' || {_NL} || {_NL} || 'Available functions:' || {_NL} || tt || {_NL} || {_NL}
  || 'Convert the following command into a function call using ONLY the functions listed above.' || {_NL} || {_NL}
  || 'Command: "record a ' || event_type || ' event"' || {_NL} || {_NL}
  || 'Output ONLY valid JSON in this exact format:' || {_NL}
  || '{{"function": "function_name", "arguments": {{"param": "value"}}}}' || {_NL} || {_NL} || 'JSON:' AS prompt
FROM events, cat
""",
)
def eval_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # F6 catalog branch: the catalog is rendered once (F1c lines joined by newlines)
    single = CT.catalog_text(D.event_tools(spark, sf_dir).select("ord", "tool_json"), strict=True, single=True)
    cases = D.eval_cases(spark, sf_dir)
    return cases.select("example_id", FM.eval_prompt("command", single, EVENTS_DEVICE).alias("prompt"))


@register(
    "generation_prompts",
    f"""
WITH cat AS (
  SELECT string_agg('- ' || et || '(k: integer, value?: number)' || {_NL} || '  Record one ' || et || ' event' || {_NL}, '' ORDER BY et) AS tt
  FROM (SELECT DISTINCT event_type AS et FROM events))
SELECT event_id AS example_id,
  '<|im_start|>system' || {_NL} || 'You are a helpful assistant with access to functions. Use them when appropriate.'
  || {_NL} || {_NL} || 'Available functions:' || {_NL} || tt || {_NL} || {_NL}
  || 'Output format: {{"function": "function_name", "arguments": {{...}}}}' || '<|im_end|>' || {_NL}
  || '<|im_start|>user' || {_NL} || 'record a ' || event_type || ' event' || '<|im_end|>' || {_NL}
  || '<|im_start|>assistant' || {_NL} AS prompt
FROM events, cat
""",
)
def generation_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # F7b with the strict catalog text (F1b), rendered once
    tools_text = _event_tools_text(spark, sf_dir)
    cases = D.eval_cases(spark, sf_dir)
    return cases.select("example_id", FM.generation_prompt("command", F.lit(tools_text)).alias("prompt"))


@register(
    "chat_responses",
    _ORACLE_PRED
    + """
SELECT model_name, example_id,
       CASE WHEN example_id % 17 = 0 THEN 'error' ELSE 'ok' END AS status,
       CASE WHEN example_id % 17 = 0 THEN 'upstream timeout' ELSE raw_output END AS content
FROM v
""",
)
def chat_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    # J8 over response bodies rendered from the predictions (every 17th is an error body)
    preds = D.eval_predictions(spark, sf_dir)
    ok_body = F.to_json(
        F.struct(F.array(F.struct(F.struct(F.lit("assistant").alias("role"), F.col("raw_output").alias("content")).alias("message"))).alias("choices"))
    )
    err_body = F.lit('{"error": "upstream timeout"}')
    bodies = preds.select("model_name", "example_id", F.when(F.col("example_id") % 17 == 0, err_body).otherwise(ok_body).alias("body"))
    unpacked = bodies.select("model_name", "example_id", SG.chat_response_content("body").alias("r"))
    return unpacked.select("model_name", "example_id", F.col("r.status").alias("status"), F.col("r.content").alias("content"))
