"""Teacher-reply unpacking: fences, envelopes, items -> training text.

Input: replies ``(batch_id, content)`` -- one raw text per teacher call. Every step is
row-local; the only shuffle is the per-batch yield count (C8), a partial/final
aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import jsonx as J
from ..functions.segments import strip_fences
from ..functions.text import keep_where
from .catalog import py_str
from .formatters import training_text

# Envelope keys tried in order when a reply is an object.
ENVELOPE_KEYS = ("examples", "data", "queries", "results")
# Keys every item must have.
ITEM_KEYS = ("query", "tool", "arguments")


def unwrap(replies: DataFrame) -> DataFrame:
    """J3 + J4: ``(batch_id, status, items_json)`` per reply.

    status: ``ok``; ``invalid_json`` (the whole batch is skipped); ``unexpected_format``
    (an object without a list envelope: no rows, a warning in the reference).
    """
    c = strip_fences(F.col("content"))
    staged = replies.select("batch_id", c.alias("_c"))
    staged = staged.select("batch_id", "_c", J.parsed(F.col("_c")).alias("_cc_v"))  # parsed once, used below
    v = F.col("_cc_v")
    kind = F.schema_of_variant(v)
    envelope = F.lit(None).cast("string")
    for key in reversed(ENVELOPE_KEYS):
        is_list = F.coalesce(F.schema_of_variant(F.try_variant_get(v, f"$.{key}", "variant")).startswith("ARRAY"), F.lit(False))
        envelope = F.when(is_list, F.get_json_object("_c", f"$.{key}")).otherwise(envelope)
    items = F.when(kind.startswith("ARRAY"), F.col("_c")).when(kind.startswith("OBJECT"), envelope)
    status = F.when(v.isNull(), F.lit("invalid_json")).when(items.isNull(), F.lit("unexpected_format")).otherwise(F.lit("ok"))
    return staged.select("batch_id", status.alias("status"), F.when(status == "ok", items).alias("items_json"))


def _item_ok(item: Column) -> Column:
    keys = F.json_object_keys(item)
    return F.coalesce(F.size(F.array_intersect(keys, F.array(*[F.lit(k) for k in ITEM_KEYS]))) == len(ITEM_KEYS), F.lit(False))


def unpack(replies: DataFrame, tools_text: str) -> DataFrame:
    """J5 + F5: one row per item ``(batch_id, item_pos, text, item_ok)``.

    An item lacking ``query``/``tool``/``arguments`` (or not an object) is skipped with
    a warning in the reference: here ``item_ok`` is false and ``text`` NULL. The
    rendered catalog is one driver-side string (rendered and size-checked once).
    """
    unwrapped = keep_where(unwrap(replies), F.col("status") == "ok")
    items = unwrapped.select("batch_id", F.posexplode(F.from_json("items_json", "array<string>")).alias("item_pos", "item"))
    # each item is parsed once (VARIANT) and reused by every field below
    items = items.select("*", F.try_parse_json("item").alias("_cc_v"))
    ok = _item_ok(F.col("item"))
    v = F.col("_cc_v")
    query = py_str(F.try_variant_get(v, "$.query", "variant"))
    text = training_text(query, J.py_dumps_at("item", "$.tool", v), J.py_dumps_at("item", "$.arguments", v), F.lit(tools_text))
    return items.select(
        "batch_id",
        F.col("item_pos").cast("long").alias("item_pos"),
        F.when(ok, text).alias("text"),
        ok.alias("item_ok"),
    )


def batch_yield(replies: DataFrame, tools_text: str, per_batch: int) -> DataFrame:
    """Requested vs obtained per batch (every batch listed, skipped ones with 0)."""
    items = F.coalesce(F.from_json("items_json", "array<string>"), F.array().cast("array<string>"))
    valid = F.filter(items, _item_ok)  # counted inside the reply's row: no join, no shuffle
    return unwrap(replies).select("batch_id", "status", F.lit(per_batch).cast("long").alias("requested"), F.size(valid).cast("long").alias("obtained"))
