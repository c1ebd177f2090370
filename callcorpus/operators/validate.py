"""Batch call validation against a tool catalog.

Violations: ``not_object``, ``missing_function``, ``missing_arguments``,
``unknown_function``, ``missing_required``, ``unknown_param``, ``wrong_type``,
``over_maximum``. A call without ``arguments`` is checked as ``{}`` (the scorer's
default), so its required parameters are also reported missing.

Plan: one pass over the calls. Catalog and call are both flattened to paths. Each call is
left-joined on device and function name with the tool's signature row (declared paths and
required properties); every check is then a row-local expression and the violations are
exploded. A signature side of up to 100,000 tools (counted) is broadcast, so the calls stay in
their tasks; a larger catalog takes a shuffle join, where AQE
splits the partition of a function that holds a third of all calls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import jsonx as J
from ..functions.text import broadcast_if_small, let
from .catalog import path_name, shown_path

# JSON-schema type name -> accepted VARIANT kinds.
_TYPE_OK = {
    "string": lambda k: k == "STRING",
    "integer": lambda k: k.isin("BIGINT", "INT", "SMALLINT", "TINYINT") | k.rlike(r"^DECIMAL\(\d+,0\)$"),
    "number": lambda k: k.isin("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT") | k.startswith("DECIMAL"),
    "boolean": lambda k: k == "BOOLEAN",
    "object": lambda k: k.startswith("OBJECT"),
    "array": lambda k: k.startswith("ARRAY"),
    "null": lambda k: k == "VOID",
}


def _paths(params: DataFrame) -> DataFrame:
    """``catalog.catalog_paths`` rows, also from the flat ``catalog.catalog_params``."""
    given = params if "device" in params.columns else params.withColumn("device", F.lit(None).cast("string"))
    if "path" not in given.columns:
        given = given.select("device", "tool", path_name(F.col("param")).alias("path"), F.lit("").alias("parent"), F.lit(1).alias("depth"), "type", "maximum", "required")
    return given


def tool_signatures(params: DataFrame, tools: DataFrame | None = None, by_device: bool = True) -> DataFrame:
    """One row per device and tool: ``(device, fn, pmap, req)`` with ``pmap`` a map of path to
    ``struct<type, maximum>`` and ``req`` a map of every path that declares properties (``""``
    is the arguments) to its required ones.

    ``tools`` (``device`` and ``name``) lists every tool, including ones without
    parameters -- those have no parameter rows, so without the list they would look
    unknown. The per-tool gather is bounded by the tool's parameter count. With
    ``by_device=False`` calls name no device, so a tool may have one declaration only.
    """
    paths = _paths(params)
    spec = F.struct(F.col("type").alias("type"), F.col("maximum").cast("long").alias("maximum"))
    one = paths.groupBy("device", "tool", "path").agg(F.min_by(spec, F.col("type")).alias("s"), F.first("parent").alias("parent"), F.coalesce(F.max("required"), F.lit(False)).alias("r"))
    maps = one.groupBy("device", F.col("tool").alias("fn")).agg(F.map_from_entries(F.collect_list(F.struct("path", "s"))).alias("pmap"))
    kids = one.filter(~F.col("path").endswith("[]")).groupBy("device", F.col("tool").alias("fn"), "parent").agg(F.array_sort(F.collect_list(F.when(F.col("r"), F.col("path")))).alias("q"))
    reqs = kids.groupBy("device", "fn").agg(F.map_from_entries(F.collect_list(F.struct("parent", "q"))).alias("req"))
    known = one.select("device", F.col("tool").alias("fn")).distinct()
    if tools is not None:
        dev = F.col("device") if "device" in tools.columns else F.lit(None).cast("string")
        known = known.unionByName(tools.select(dev.alias("device"), F.col("name").alias("fn"))).distinct()
    out = known
    for part in (maps, reqs):
        p = part.withColumnsRenamed({"device": "_d", "fn": "_f"})
        out = out.join(p, out["device"].eqNullSafe(p["_d"]) & (out["fn"] == p["_f"]), "left").drop("_d", "_f")
    pmap = F.coalesce("pmap", F.create_map().cast("map<string,struct<type:string,maximum:bigint>>"))
    req = F.coalesce("req", F.create_map().cast("map<string,array<string>>"))
    out = out.select("device", "fn", pmap.alias("pmap"), req.alias("req"))
    if not by_device:
        twice = out.groupBy("fn").count().filter("count > 1").select("fn").limit(1).collect()
        if twice:
            raise ValueError(f"tool {twice[0][0]!r} is declared by several devices: name the calls' device column")
    return out


def validate_calls(calls: DataFrame, params: DataFrame, id_col: str = "call_id", call_col: str = "call_json",
                   tools: DataFrame | None = None, device_col: str | None = None) -> DataFrame:
    """``(id, violation, param)`` rows; a valid call yields none.

    ``params``: ``catalog.catalog_paths`` (nested declarations too) or the flat
    ``catalog.catalog_params``; ``tools`` (``catalog.catalog_tools`` output) lists every
    tool -- pass it so tools without parameters are known. ``device_col`` names the calls'
    device: a call is judged by that device's declaration only. One pass: each call is
    left-joined with its tool's signature row; the call's arguments are flattened to paths,
    as deep as the catalog declares, and every check is a row-local expression over them.
    ``param`` of a nested value is its path (``place.lat``, ``tags[].name``); a violation
    that several items of an array share is one row.
    """
    # counted, then broadcast: few tools would else draw all calls into few tasks
    sigs = broadcast_if_small(tool_signatures(params, tools, device_col is not None))
    depth = _paths(params).agg(F.max("depth")).first()[0] or 1
    # what is read several times is a column of its own, computed once
    base = calls.select(
        F.col(id_col).alias("_id"),
        (F.col(device_col).cast("string") if device_col else F.lit(None).cast("string")).alias("_dev"),
        J.parsed(F.col(call_col)).alias("_v"),
        F.json_object_keys(F.col(call_col)).alias("_keys"),
    )
    base = base.select(
        "_id",
        "_dev",
        (F.col("_v").isNotNull() & F.col("_keys").isNotNull()).alias("is_obj"),
        F.coalesce(F.array_contains("_keys", "function"), F.lit(False)).alias("has_fn"),
        F.coalesce(F.array_contains("_keys", "arguments"), F.lit(False)).alias("has_args"),
        F.try_variant_get("_v", "$.function", "string").alias("_fn"),
        F.try_variant_get("_v", "$.arguments", "variant").alias("_args"),
    )
    base = _flattened(base, "_args", depth)
    same = F.col("_fn") == F.col("fn")
    if device_col:
        same = same & F.col("_dev").eqNullSafe(F.col("device"))
    j = base.join(sigs, same, "left")
    known = F.col("is_obj") & F.col("has_fn") & F.col("pmap").isNotNull()

    def call_issue(name, cond):
        return F.when(cond, F.struct(F.lit(name).alias("violation"), F.lit(None).cast("string").alias("param")))

    def value_issue(x):
        kind = F.when(x["has"].isNotNull(), F.lit("OBJECT")).otherwise(F.schema_of_variant(x["value"]))

        def judged(spec):
            return (
                F.when(spec.isNull() & ~x["item"] & F.element_at(F.col("req"), x["parent"]).isNotNull(), F.lit("unknown_param"))
                .when(spec.isNull() & ~x["item"] & (x["parent"] == ""), F.lit("unknown_param"))
                .when(spec.isNull(), F.lit(None))
                .when(~let(kind, lambda k: _type_ok_expr(spec["type"], k)), F.lit("wrong_type"))
                .when(spec["maximum"].isNotNull() & (F.try_variant_get(x["value"], "$", "double") > spec["maximum"]), F.lit("over_maximum"))
            )

        name = let(F.element_at(F.col("pmap"), x["path"]), judged)
        return let(name, lambda n: F.when(n.isNotNull(), F.struct(n.alias("violation"), shown_path(x["path"]).alias("param"))))

    def missing(x):  # required properties that an object (or the arguments) lacks
        lacks = F.array_except(F.coalesce(F.element_at(F.col("req"), x["path"]), F.array().cast("array<string>")), x["has"])
        return F.transform(lacks, lambda p: F.struct(F.lit("missing_required").alias("violation"), shown_path(p).alias("param")))

    none = F.array().cast("array<struct<violation:string,param:string>>")
    objects = F.filter("vals", lambda x: x["has"].isNotNull())
    bare = F.when(~F.exists("vals", lambda x: x["path"] == ""), missing(F.struct(F.lit("").alias("path"), F.array().cast("array<string>").alias("has")))).otherwise(none)
    issues = F.concat(
        F.array_compact(F.array(
            call_issue("not_object", ~F.col("is_obj")),
            call_issue("missing_function", F.col("is_obj") & ~F.col("has_fn")),
            call_issue("missing_arguments", F.col("is_obj") & ~F.col("has_args")),
            call_issue("unknown_function", F.col("is_obj") & F.col("has_fn") & F.col("pmap").isNull()),
        )),
        F.when(known, F.array_compact(F.transform(F.filter("vals", lambda x: x["path"] != ""), value_issue))).otherwise(none),
        F.when(known, F.concat(bare, F.flatten(F.transform(objects, missing)))).otherwise(none),
    )
    out = j.select(F.col("_id").alias(id_col), F.explode(F.array_distinct(issues)).alias("_v"))
    return out.select(id_col, F.col("_v.violation").alias("violation"), F.col("_v.param").alias("param"))


_VALUE = "struct<path:string,parent:string,item:boolean,value:variant,has:array<string>>"


def _flattened(df: DataFrame, args: str, depth: int) -> DataFrame:
    """``df`` with ``vals`` in place of the column ``args``: the values of an arguments object
    down to ``depth`` levels: path, path of what holds it, whether it is an array's item, the
    value, and for objects (only) the paths of their properties. The first entry (path ``""``)
    is the arguments object itself. A level is made once, from the one above it."""
    none = F.array().cast(f"array<{_VALUE}>")

    def joined(path, key):
        return F.concat(path, F.when(path == "", "").otherwise("."), path_name(key))

    def entry(path, parent, item, value):
        has = F.transform(F.map_keys(value.try_cast("map<string,variant>")), lambda k: joined(path, k))
        return F.struct(path.alias("path"), parent.alias("parent"), item.alias("item"), value.alias("value"), has.alias("has"))

    def below(x):
        props = F.transform(F.map_entries(x["value"].try_cast("map<string,variant>")), lambda e: entry(joined(x["path"], e["key"]), x["path"], F.lit(False), e["value"]))
        items = F.transform(x["value"].try_cast("array<variant>"), lambda e: entry(F.concat(x["path"], F.lit("[]")), x["path"], F.lit(True), e))
        return F.when(x["has"].isNotNull(), props).otherwise(F.coalesce(items, none))

    levels = [f"_level{i}" for i in range(depth + 1)]
    first = F.array(entry(F.lit(""), F.lit(None).cast("string"), F.lit(False), F.col(args)))
    out = df.withColumn(levels[0], F.filter(first, lambda x: x["has"].isNotNull()))
    for above, level in zip(levels, levels[1:]):
        out = out.withColumn(level, F.flatten(F.transform(above, below)))
    return out.withColumn("vals", F.concat(*levels)).drop(args, *levels)


def _type_ok_expr(expected, kind):
    """True when the VARIANT kind satisfies the declared type (unknown types pass)."""
    cond = F.lit(True)
    for name, test in reversed(list(_TYPE_OK.items())):
        cond = F.when(expected == name, F.coalesce(test(kind), F.lit(False))).otherwise(cond)
    return cond
