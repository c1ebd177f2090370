"""Row -> training text formatters.

Each formatter is a ``DataFrame -> DataFrame`` transform that adds ``text`` (NULL for a
rejected row) and ``reject_reason``. All are native column expressions, but that the call and the
tool list of a raw call row (F2) are read by Python's ``json`` over Arrow batches: as expressions
that cost about ten times as much. ``drop_failed`` (P2)
and ``keep_text`` (P1) finish the corpus; ``rejects`` (F9) accounts for every row
that was dropped, counted from the source rather than after the map.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from ..functions.text import col_of, keep_where, let, preview, py_strip
from .catalog import EARBUD_FUNCTIONS_TEXT, OUTPUT_FORMAT, SYSTEM_PREFIX, TOOLS_HEADER

# Chat-template markers.
IM_START = "<|im_start|>"
IM_END = "<|im_end|>"
END_OF_TEXT = "<|endoftext|>"
# Default system text of the transcript formatter.
DEFAULT_SYSTEM = "You are a helpful assistant."
# Evaluation prompt templates (F6), catalog branch then plain branch,
# and the chat client's system text with a catalog.
CATALOG_PROMPT_HEAD = (
    "You are a function-calling assistant for {device}.\n\nAvailable functions:\n{tools}\n\n"
    "Convert the following command into a function call using ONLY the functions listed above.\n\nCommand: \""
)
CATALOG_PROMPT_TAIL = (
    '"\n\nOutput ONLY valid JSON in this exact format:\n{"function": "function_name", "arguments": {"param": "value"}}\n\nJSON:'
)
PLAIN_PROMPT_HEAD = "Convert the following voice command into a JSON function call.\n\nAvailable functions:\n{tools}\n\nCommand: \""
PLAIN_PROMPT_TAIL = '"\n\nOutput only valid JSON in this format:\n{"function": "function_name", "arguments": {"param": "value"}}\n\nJSON:'
CHAT_SYSTEM_WITH_TOOLS = '{prefix}\n\nAvailable functions:\n{tools}\n\nOutput format: {{"function": "function_name", "arguments": {{...}}}}'
# Reject reasons, in the order the reference would hit them.
REJECT_REASONS = ("answers_unparseable", "no_call", "tools_malformed", "no_query", "call_not_object")


def chat_text(system_msg: Column, user_msg: Column, assistant_msg: Column) -> Column:
    """Three chat blocks, no trailing newline (F2/F5 layout)."""
    return F.concat(
        F.lit(f"{IM_START}system\n"), system_msg, F.lit(f"{IM_END}\n{IM_START}user\n"), user_msg,
        F.lit(f"{IM_END}\n{IM_START}assistant\n"), assistant_msg, F.lit(IM_END),
    )


def system_message(tools_text: Column) -> Column:
    return F.concat(F.lit(SYSTEM_PREFIX), tools_text, F.lit(OUTPUT_FORMAT))


def call_json(function_json: Column, arguments_json: Column) -> Column:
    """``json.dumps({"function": f, "arguments": a})`` from already-dumped parts."""
    return F.concat(F.lit('{"function": '), function_json, F.lit(', "arguments": '), arguments_json, F.lit("}"))


def training_text(query: Column, function_json: Column, arguments_json: Column, tools_text: Column) -> Column:
    """F5 ``format_training_example``: the tool name is not checked against the catalog."""
    return chat_text(system_message(tools_text), query, call_json(function_json, arguments_json))


# ---------------------------------------------------------------------------
# one raw call row, read as Python does
# ---------------------------------------------------------------------------

def _unique(pairs: list) -> dict:
    fields = dict(pairs)
    if len(fields) < len(pairs):
        raise ValueError("repeated key")
    return fields


def _refused(literal: str):
    raise ValueError(literal)


# Repeated keys and NaN/Infinity are invalid here, as for the VARIANT parser (README, deviations).
_DECODER = json.JSONDecoder(object_pairs_hook=_unique, parse_constant=_refused)


def _read(text: str | None):
    """The JSON value and whether the text could be read."""
    try:
        return (None, False) if text is None else (_DECODER.decode(text), True)
    except (ValueError, RecursionError):
        return None, False


def _shown(value) -> str:
    return json.dumps(value, ensure_ascii=False, sort_keys=True) if isinstance(value, (dict, list)) else str(value)


def _tool_line(tool, flat: bool) -> str | None:
    """F1 of one tool; None where the reference raises."""
    params = tool.get("parameters", {}) if isinstance(tool, dict) else None
    if not isinstance(params, dict):
        return None
    props, required = params.get("properties", params if flat else {}), params.get("required", [])
    if not isinstance(props, dict) or not all(isinstance(info, dict) for info in props.values()):
        return None
    if props and not isinstance(required, (list, str, dict)):
        return None
    shown = ", ".join(f"{k}{'' if k in required else '?'}: {_shown(info.get('type', 'string'))}" for k, info in props.items())
    return f"- {_shown(tool.get('name', ''))}({shown})\n  {_shown(tool.get('description', ''))}\n"


def _call_row(answers: str | None, tools: str | None, flat: bool) -> tuple:
    """(fault, tools text, function, arguments): the first of the reject reasons before
    ``no_query``; JSON texts of the call, None if it is not an object."""
    value, ok = _read(answers)
    if answers is not None and not ok:
        return "answers_unparseable", None, None, None
    call = (value or [None])[0] if isinstance(value, list) else value
    if not call:
        return "no_call", None, None, None
    listed, lines = _read(tools)[0], []
    if listed:
        lines = [_tool_line(t, flat) for t in listed] if isinstance(listed, list) else [None]
        if None in lines:
            return "tools_malformed", None, None, None
    text = (TOOLS_HEADER + "".join(lines)).encode("utf-8", "replace") if listed else b""
    if not isinstance(call, dict):
        return None, text, None, None
    fn = call["name"] if "name" in call else call.get("function", "")
    args = call["arguments"] if "arguments" in call else call.get("parameters", {})
    return None, text, json.dumps(fn), json.dumps(args)


def _read_calls(answers: Column, tools: Column, flat: bool) -> Column:
    names = ["fault", "tools_text", "function", "arguments"]

    def rows(answers: pa.Array, tools: pa.Array) -> pa.Array:
        found = [_call_row(a, t, flat) for a, t in zip(answers.to_pylist(), tools.to_pylist())]
        return pa.StructArray.from_arrays([pa.array([r[i] for r in found], pa.string()) for i in range(len(names))], names)

    return F.arrow_udf(rows, ", ".join(f"{n} string" for n in names))(F.make_valid_utf8(answers), F.make_valid_utf8(tools))


def _as_json_text(df: DataFrame, name: str | None) -> Column:
    if name is None:
        return F.lit(None).cast("string")
    c = F.col(name)
    return c if isinstance(df.schema[name].dataType, StringType) else F.to_json(c)


# ---------------------------------------------------------------------------
# raw call rows ("xlam")
# ---------------------------------------------------------------------------

def xlam_format(df: DataFrame, flat_params: bool = False) -> DataFrame:
    """F2 ``xlam_formatter`` with P3 key fallbacks and P4 first-call pick.

    Adds ``text`` and ``reject_reason``. Column fallbacks (``answers``->``answer``,
    ``query``->``instruction``) are decided from the schema at plan time.
    ``flat_params=True`` renders tools whose ``parameters`` maps names straight to
    parameter objects (the reference renders them with no parameters).

    ``tools``/``answers`` are best kept as JSON text: a struct or array column is
    serialised with ``to_json``, so object key order then follows the column's schema
    (Spark's JSON schema inference sorts keys), not the source text.
    """
    cols = set(df.columns)
    answers_name = "answers" if "answers" in cols else ("answer" if "answer" in cols else None)
    query_name = "query" if "query" in cols else ("instruction" if "instruction" in cols else None)
    tools_name = "tools" if "tools" in cols else None

    a = _as_json_text(df, answers_name)
    tools = _as_json_text(df, tools_name)
    query = F.col(query_name) if query_name else F.lit("")

    staged = df.select("*", _read_calls(a, tools, flat_params).alias("_cc_r"), query.cast("string").alias("_cc_q"))
    reason = (
        F.when(F.col("_cc_r.fault").isNotNull(), F.col("_cc_r.fault"))
        .when(F.col("_cc_q").isNull() | (F.col("_cc_q") == ""), F.lit("no_query"))
        .when(F.col("_cc_r.function").isNull(), F.lit("call_not_object"))
    )
    text = training_text(F.col("_cc_q"), F.col("_cc_r.function"), F.col("_cc_r.arguments"), F.col("_cc_r.tools_text"))
    # reject_reason is its own projection: filters on it stay cheap (see drop_failed)
    out = staged.select("*", reason.alias("reject_reason"))
    out = out.select("*", F.when(F.col("reject_reason").isNull(), text).alias("text"))
    return out.drop(*[c for c in out.columns if c.startswith("_cc_")])


# ---------------------------------------------------------------------------
# transcript rows ("glaive")
# ---------------------------------------------------------------------------

def glaive_text(system: Column | str, chat: Column | str) -> Column:
    """F3 ``glaive_formatter`` as one expression.

    Lines are classified once; blocks start at ``USER:``/``ASSISTANT:`` lines
    (unindented, case-sensitive); blank lines drop; text before the first marker
    drops. Block boundaries come from marker positions, so the work is linear in
    the number of lines (no quadratic fold).
    """
    lines = F.split(py_strip(F.replace(F.coalesce(col_of(chat), F.lit("")), F.lit(END_OF_TEXT), F.lit(""))), "\n")

    def classify(l):
        is_user = l.startswith("USER:")
        is_asst = l.startswith("ASSISTANT:")
        content = F.when(is_user, py_strip(F.substring(l, 6, 1 << 30))).when(
            is_asst, py_strip(F.substring(l, 11, 1 << 30))
        ).otherwise(py_strip(l))
        role = F.when(is_user, F.lit("user")).when(is_asst, F.lit("assistant"))
        return F.struct(role.alias("role"), content.alias("content"))

    def assemble(kept):
        n = F.size(kept)
        marks = F.when(n > 0, F.filter(F.sequence(F.lit(1), n), lambda i: F.element_at(kept, i)["role"].isNotNull())).otherwise(
            F.array().cast("array<int>")
        )

        def blocks(positions):
            def block(p, j):
                end = F.coalesce(F.try_element_at(positions, j + 2), n + 1)
                seg = F.slice(kept, p, end - p)
                return F.concat(
                    F.lit(IM_START), F.element_at(kept, p)["role"], F.lit("\n"),
                    F.array_join(F.transform(seg, lambda s: s["content"]), "\n"), F.lit(IM_END),
                )

            return F.array_join(F.transform(positions, block), "\n")

        return let(marks, blocks)

    kept = F.filter(F.transform(lines, classify), lambda x: x["role"].isNotNull() | (x["content"] != ""))
    return F.concat(
        F.lit(f"{IM_START}system\n"), F.coalesce(col_of(system), F.lit(DEFAULT_SYSTEM)), F.lit(f"{IM_END}\n"),
        let(kept, assemble),
    )


def glaive_format(df: DataFrame) -> DataFrame:
    system = F.col("system") if "system" in df.columns else F.lit(None).cast("string")
    chat = F.col("chat") if "chat" in df.columns else F.lit("")
    return df.select("*", glaive_text(system, chat).alias("text"), F.lit(None).cast("string").alias("reject_reason"))


# ---------------------------------------------------------------------------
# conversation rows ("hermes")
# ---------------------------------------------------------------------------

def hermes_text(conversations: Column | str) -> Column:
    """F4 ``hermes_formatter``: ``human``->``user``, ``gpt``->``assistant``; missing
    ``from`` -> ``user``; missing ``value`` -> ``""``; whole text stripped."""
    def block(m):
        role = F.coalesce(m["from"], F.lit("user"))
        role = F.when(role == "human", F.lit("user")).when(role == "gpt", F.lit("assistant")).otherwise(role)
        return F.concat(F.lit(IM_START), role, F.lit("\n"), F.coalesce(m["value"], F.lit("")), F.lit(f"{IM_END}\n"))

    return py_strip(F.array_join(F.transform(F.coalesce(col_of(conversations), F.array()), block), ""))


def hermes_format(df: DataFrame) -> DataFrame:
    return df.select("*", hermes_text("conversations").alias("text"), F.lit(None).cast("string").alias("reject_reason"))


# ---------------------------------------------------------------------------
# prompts
# ---------------------------------------------------------------------------

def eval_prompt(command: Column | str, tools_single_text: str | None = None, device: str | None = None) -> Column:
    """F6 ``create_prompt``: catalog branch (device name + single-tool lines) or the
    fixed earbud text. The catalog is rendered once (``catalog.catalog_text``); the
    command is placed raw between quotes."""
    if tools_single_text is not None:
        head, tail = CATALOG_PROMPT_HEAD.format(device=device or "device", tools=tools_single_text), CATALOG_PROMPT_TAIL
    else:
        head, tail = PLAIN_PROMPT_HEAD.format(tools=EARBUD_FUNCTIONS_TEXT), PLAIN_PROMPT_TAIL
    return F.concat(F.lit(head), col_of(command), F.lit(tail))


def chat_system_prompt(tools_single_text: str | None) -> str:
    """F7a system text of the chat client (driver-side constant per catalog)."""
    if tools_single_text is None:
        return DEFAULT_SYSTEM
    return CHAT_SYSTEM_WITH_TOOLS.format(prefix=SYSTEM_PREFIX, tools=tools_single_text)


def chat_messages(user: Column | str, system_text: str) -> Column:
    """``[{role: system, content}, {role: user, content}]``."""
    return F.array(
        F.struct(F.lit("system").alias("role"), F.lit(system_text).alias("content")),
        F.struct(F.lit("user").alias("role"), col_of(user).alias("content")),
    )


def generation_prompt(user: Column | str, tools_text: Column) -> Column:
    """Three-block prefix ending ``assistant\\n``."""
    return F.concat(
        F.lit(f"{IM_START}system\n"), system_message(tools_text), F.lit(f"{IM_END}\n{IM_START}user\n"),
        col_of(user), F.lit(f"{IM_END}\n{IM_START}assistant\n"),
    )


# ---------------------------------------------------------------------------
# F8 registry, P1/P2 finishing, F9 accounting
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class Formatter:
    name: str
    fn: Callable[[DataFrame], DataFrame]
    enabled: bool


# The reference enables only the call-row formatter; the transcript and conversation
# formatters exist but are off by default ("not pure function calling").
REGISTRY: dict[str, Formatter] = {
    "xlam": Formatter("xlam", xlam_format, True),
    "glaive": Formatter("glaive", glaive_format, False),
    "hermes": Formatter("hermes", hermes_format, False),
}


def get_formatter(dataset_name: str, include_disabled: bool = False) -> Callable[[DataFrame], DataFrame]:
    """F8: first registry key contained in the lower-cased name, else ValueError."""
    wanted = dataset_name.casefold()
    known = {key: entry.fn for key, entry in REGISTRY.items() if include_disabled or entry.enabled}
    match = next(filter(wanted.__contains__, known), None)
    if match is None:
        raise ValueError(f"{dataset_name!r} names none of the registered formatters: {', '.join(known)}")
    return known[match]


def drop_failed(formatted: DataFrame) -> DataFrame:
    """Keep rows whose text is not NULL (an empty string survives).

    Every formatter here yields a non-NULL text exactly when ``reject_reason`` is
    NULL, so the reason is tested, through ``keep_where`` (a filter would be pushed
    below the formatting projection and evaluate it twice).
    """
    return keep_where(formatted, F.col("reject_reason").isNull())


def keep_text(formatted: DataFrame) -> DataFrame:
    """The text column only."""
    return formatted.select("text")


def rejects(formatted: DataFrame, id_col: str = "id", preview_col: str | None = None) -> DataFrame:
    """one row per dropped row with its reason and a preview."""
    prev = preview(preview_col, 200) if preview_col else F.lit(None).cast("string")
    return keep_where(formatted, F.col("reject_reason").isNotNull()).select(id_col, "reject_reason", prev.alias("preview"))


def reject_sample(formatted: DataFrame, id_col: str = "id", k: int = 3, preview_col: str | None = None) -> DataFrame:
    """the first ``k`` rejected rows (by id) with their reasons -- the reference
    prints the first three errors; the limit is the feature."""
    return rejects(formatted, id_col, preview_col).orderBy(id_col).limit(k)


def reject_counts(formatted: DataFrame) -> DataFrame:
    """``before - after`` broken down by reason (counted from the source)."""
    return keep_where(formatted, F.col("reject_reason").isNotNull()).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


def python_row_formatter(df: DataFrame, fn: Callable[[dict], dict | None], id_col: str = "id", columns: list[str] | None = None) -> DataFrame:
    """X1 for user Python formatters: ``fn(row_dict) -> {"text": ...} | None`` run over
    Arrow batches with ``mapInArrow`` (the reference's ``dataset.map(fn)``).

    This is the opt-in slow path for formatters that cannot be written as column
    expressions; the built-in formatters above never use it. A raising row counts
    as a failed conversion (``reject_reason = "formatter_error"``).
    """
    cols = columns or df.columns
    out_schema = f"{id_col} {df.schema[id_col].dataType.simpleString()}, text string, reject_reason string"

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts, reasons = [], []
            for rec in batch.select(cols).to_pylist():  # Python values: NULL is None, integers stay integers
                try:
                    res = fn(rec)
                    text = None if res is None else res.get("text")
                    why = None if text is not None else "formatter_none"
                    text = text if text is None or isinstance(text, str) else str(text)
                except Exception:
                    text, why = None, "formatter_error"
                texts.append(text)
                reasons.append(why)
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(id_col)), pa.array(texts, pa.string()), pa.array(reasons, pa.string())],
                [id_col, "text", "reject_reason"],
            )

    return df.select(*dict.fromkeys([id_col, *cols])).mapInArrow(run, out_schema)
