"""Tool catalogs rendered into prompt text (F1, F1b, F1c) and the catalog tables.

A tool list arrives as JSON text. Each tool is navigated through its VARIANT value
(types, defaults, ``required``), while parameter order comes from the source text
(``json_object_keys`` keeps it; VARIANT sorts keys).

``render_tools`` returns a struct ``(text, malformed)``:

* lenient (F1, the corpus formatter): unparseable or falsy list -> ``""``;
* strict (F1b, synthetic examples): ``name``, ``description``, ``parameters`` must
  exist; the header is written even for zero tools;
* single (F1c, evaluation prompts): lines without the trailing newline, joined by
  ``"\\n"`` and without the header -- the caller places it.

``malformed`` marks lists the reference formatter raises on (a tool or parameter
that is not an object, ``parameters``/``properties`` of the wrong type, an
unusable ``required``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import jsonx as J
from ..functions.text import col_of, let

# Text the reference writes around the tool list.
TOOLS_HEADER = "\n\nAvailable functions:\n"
SYSTEM_PREFIX = "You are a helpful assistant with access to functions. Use them when appropriate."
OUTPUT_FORMAT = '\n\nOutput format: {"function": "function_name", "arguments": {...}}'

# The 10 default earbud functions of the evaluation prompt (S7), in order.
EARBUD_FUNCTIONS_TEXT = (
    "- set_volume(level: int) - Set volume from 0-100\n"
    '- set_anc_mode(mode: str) - Set ANC mode: "off", "low", "medium", "high"\n'
    "- play_music() - Start playing music\n"
    "- pause_music() - Pause music\n"
    '- skip_track(direction: str) - Skip track: "forward" or "backward"\n'
    "- answer_call() - Answer incoming call\n"
    "- end_call() - End current call\n"
    '- set_eq_preset(preset: str) - Set EQ: "bass_boost", "treble_boost", "vocal", "flat", "custom"\n'
    "- set_transparency_mode(enabled: bool) - Enable/disable transparency mode\n"
    "- check_battery() - Check battery level"
)
# The single demo tool of the interactive test.
DEMO_TOOLS_JSON = (
    '[{"name": "send_email", "description": "Send an email to a recipient", "parameters": '
    '{"properties": {"to": {"type": "string"}, "subject": {"type": "string"}, "body": {"type": "string"}}, '
    '"required": ["to", "subject", "body"]}}]'
)


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def py_str(v: Column, kind: Column | None = None) -> Column:
    """Python ``str()`` of a JSON value held as VARIANT (NULL when absent)."""
    k = _kind(v) if kind is None else kind
    return (
        F.when(k == "STRING", F.variant_get(v, "$", "string"))
        .when(v.isNull(), F.lit(None).cast("string"))
        .when(k == "BOOLEAN", F.when(F.variant_get(v, "$", "boolean"), F.lit("True")).otherwise(F.lit("False")))
        .when(k == "VOID", F.lit("None"))
        .when(k.startswith("OBJECT") | k.startswith("ARRAY"), J.python_spacing(F.to_json(v)))
        .otherwise(F.variant_get(v, "$", "string"))
    )


def _tool_fields(v: Column, t: Column, flat: bool) -> Column:
    """Stage 1: every per-tool value computed once (lambdas get no common-subexpression
    elimination, so the second stage reads these fields instead of recomputing)."""
    params = F.try_variant_get(v, "$.parameters", "variant")
    props = F.try_variant_get(v, "$.parameters.properties", "variant")
    req = F.try_variant_get(v, "$.parameters.required", "variant")
    pk = _kind(params)
    keys_path = "$.parameters.properties"
    if flat:
        # opt-in: a ``parameters`` map without ``properties`` lists the parameters itself
        use_flat = props.isNull() & F.coalesce(pk.startswith("OBJECT"), F.lit(False))
        props = F.when(use_flat, params).otherwise(props)
        keys = F.when(use_flat, F.json_object_keys(F.get_json_object(t, "$.parameters"))).otherwise(
            F.json_object_keys(F.get_json_object(t, keys_path))
        )
    else:
        keys = F.json_object_keys(F.get_json_object(t, keys_path))
    name = F.try_variant_get(v, "$.name", "variant")
    desc = F.try_variant_get(v, "$.description", "variant")
    return F.struct(
        _kind(v).alias("vk"),
        name.isNotNull().alias("has_name"),
        desc.isNotNull().alias("has_desc"),
        py_str(name).alias("name"),
        py_str(desc).alias("desc"),
        params.isNull().alias("no_params"),
        pk.alias("pk"),
        props.isNull().alias("no_props"),
        _kind(props).alias("ppk"),
        F.coalesce(keys, F.array().cast("array<string>")).alias("keys"),
        props.try_cast("map<string,variant>").alias("pmap"),
        req.isNull().alias("no_req"),
        _kind(req).alias("rk"),
        req.try_cast("array<variant>").alias("rarr"),
        F.when(_kind(req) == "STRING", F.variant_get(req, "$", "string")).alias("rstr"),
        req.try_cast("map<string,variant>").alias("rmap"),
    )


def _tool_line(f: Column, strict: bool, single: bool) -> Column:
    """Stage 2: struct(line, ok) from the stage-1 fields of one tool."""
    rk = f["rk"]

    def is_required(k: Column) -> Column:
        in_arr = F.exists(f["rarr"], lambda x: F.try_variant_get(x, "$", "string") == k)
        return (
            F.when(f["no_req"], F.lit(False))
            .when(rk.startswith("ARRAY"), in_arr)
            .when(rk == "STRING", F.instr(f["rstr"], k) > 0)
            .when(rk.startswith("OBJECT"), F.map_contains_key(f["rmap"], k))
            .otherwise(F.lit(False))
        )

    def param(k: Column) -> Column:
        info = F.element_at(f["pmap"], k)
        ik = _kind(info)
        typ = F.coalesce(py_str(F.try_variant_get(info, "$.type", "variant")), F.lit("string"))
        text = F.concat(k, F.when(is_required(k), F.lit("")).otherwise(F.lit("?")), F.lit(": "), typ)
        return F.struct(text.alias("text"), F.coalesce(ik.startswith("OBJECT"), F.lit(False)).alias("ok"))

    ps = F.transform(f["keys"], param)
    is_obj = F.coalesce(f["vk"].startswith("OBJECT"), F.lit(False))
    params_ok = f["no_params"] | F.coalesce(f["pk"].startswith("OBJECT"), F.lit(False))
    props_ok = f["no_props"] | F.coalesce(f["ppk"].startswith("OBJECT"), F.lit(False))
    req_ok = (F.size(f["keys"]) == 0) | f["no_req"] | rk.startswith("ARRAY") | (rk == "STRING") | rk.startswith("OBJECT")
    ok = is_obj & params_ok & props_ok & F.forall(ps, lambda p: p["ok"]) & F.coalesce(req_ok, F.lit(False))
    if strict:
        ok = ok & f["has_name"] & f["has_desc"] & ~f["no_params"]
    if single:
        ok = ok & ~f["no_props"]
    line = F.concat(
        F.lit("- "),
        F.coalesce(f["name"], F.lit("")),
        F.lit("("),
        F.array_join(F.transform(ps, lambda p: p["text"]), ", "),
        F.lit(")\n  "),
        F.coalesce(f["desc"], F.lit("")),
        F.lit("" if single else "\n"),
    )
    return F.struct(line.alias("line"), ok.alias("ok"))


def render_tools(tools: Column | str, strict: bool = False, single: bool = False, flat: bool = False) -> Column:
    """F1 / F1b / F1c over a JSON text column holding the tool list."""
    t = col_of(tools)
    header = "" if single else TOOLS_HEADER

    def from_variant(tv):  # tv: VARIANT when json.loads would succeed
        valid = tv.isNotNull()
        kind = _kind(tv)
        elems_v = F.when(kind.startswith("ARRAY"), tv.cast("array<variant>"))
        elems_t = F.from_json(t, "array<string>")
        fields = F.transform(elems_v, lambda v, i: _tool_fields(v, F.element_at(elems_t, i + 1), flat))
        lines = F.transform(fields, lambda f: _tool_line(f, strict, single))

        def finish(lines):
            body = F.array_join(F.transform(lines, lambda x: x["line"]), "\n" if single else "")
            all_ok = F.forall(lines, lambda x: x["ok"])
            if strict or single:
                # strict callers hold a parsed list; anything else raises
                text = F.concat(F.lit(header), F.coalesce(body, F.lit("")))
                malformed = ~F.coalesce(valid & kind.startswith("ARRAY") & all_ok, F.lit(False))
                return F.struct(text.alias("text"), malformed.alias("malformed"))
            falsy = F.to_json(tv).isin("{}", "[]", '""', "0", "0.0", "false", "null")
            unparsed_or_empty = ~valid | falsy
            text = F.when(unparsed_or_empty, F.lit("")).otherwise(F.concat(F.lit(header), body))
            malformed = F.when(unparsed_or_empty, F.lit(False)).otherwise(
                ~F.coalesce(kind.startswith("ARRAY") & all_ok, F.lit(False))
            )
            return F.struct(text.alias("text"), malformed.alias("malformed"))

        return let(lines, finish)

    return let(J.parsed(t), from_variant)


# ---------------------------------------------------------------------------
# catalog tables
# ---------------------------------------------------------------------------

def catalog_tools(catalog_doc: DataFrame) -> DataFrame:
    """Normalise catalog documents ``(device, version, description, tools_json)`` into
    one row per tool ``(device, ord, name, description, tool_json)`` -- tool order kept."""
    return catalog_doc.select(
        "device",
        F.posexplode(F.from_json("tools_json", "array<string>")).alias("ord", "tool_json"),
    ).select(
        "device",
        "ord",
        F.get_json_object("tool_json", "$.name").alias("name"),
        F.get_json_object("tool_json", "$.description").alias("description"),
        "tool_json",
    )


def catalog_params(tools: DataFrame) -> DataFrame:
    """One row per declared parameter: ``(device, tool, ord, param, type, description,
    default_json, maximum, required)``; parameter order is the source order.

    Values come from a VARIANT map lookup (safe for any parameter name); the default
    is dumped from the source text (key order kept) unless the name holds a quote,
    which a JSON path cannot address -- then from the VARIANT value.
    """
    props = F.try_variant_get(F.try_parse_json("tool_json"), "$.parameters.properties", "variant")
    keyed = tools.select(
        "device",
        F.col("name").alias("tool"),
        F.posexplode(F.json_object_keys(F.get_json_object("tool_json", "$.parameters.properties"))).alias("ord", "param"),
        "tool_json",
        props.try_cast("map<string,variant>").alias("_cc_pmap"),
    )
    info = F.element_at(F.col("_cc_pmap"), F.col("param"))
    path = F.concat(F.lit("$.parameters.properties['"), F.col("param"), F.lit("']"))
    info_text = F.call_function("get_json_object", F.col("tool_json"), path)
    default_json = F.when(
        F.instr(F.col("param"), "'") == 0, J.py_dumps_at(info_text, "$.default")
    ).otherwise(F.to_json(F.try_variant_get(info, "$.default", "variant")))
    req = F.from_json(F.get_json_object("tool_json", "$.parameters.required"), "array<string>")
    return keyed.select(
        "device",
        "tool",
        "ord",
        "param",
        F.coalesce(F.try_variant_get(info, "$.type", "string"), F.lit("string")).alias("type"),
        F.try_variant_get(info, "$.description", "string").alias("description"),
        default_json.alias("default_json"),
        F.try_variant_get(info, "$.maximum", "bigint").alias("maximum"),
        F.coalesce(F.array_contains(req, F.col("param")), F.lit(False)).alias("required"),
    )


def catalog_text(tools: DataFrame, strict: bool = True, single: bool = False, max_bytes: int = 1 << 20, max_tools: int = 10_000) -> str:
    """Render a catalog table ``(ord, tool_json)`` once, as a driver-side string.

    The rendered catalog is placed into every example or prompt, so it must be
    small; the size is checked rather than assumed. Aggregation happens in Spark
    (one row out), and only the final text reaches the driver.
    """
    # the tool table is read twice (bound check, then render): keep it in memory in
    # between so a derived catalog is computed once (a cache, recomputable from lineage)
    tools = tools.select("ord", "tool_json").cache()
    try:
        return _render_catalog(tools, strict, single, max_bytes, max_tools)
    finally:
        tools.unpersist()


def _render_catalog(tools: DataFrame, strict: bool, single: bool, max_bytes: int, max_tools: int) -> str:
    n_tools = tools.count()
    if n_tools > max_tools:
        raise ValueError(f"catalog has {n_tools} tools; over the {max_tools} tool bound")
    lines = tools.select(
        "ord",
        render_tools(F.concat(F.lit("["), F.col("tool_json"), F.lit("]")), strict=strict, single=True).alias("r"),
    )
    row = lines.agg(
        F.sum(F.length(F.col("r.text"))).alias("nbytes"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", F.col("r.text").alias("t")))), lambda x: x["t"]), "\n").alias("body"),
        F.max(F.col("r.malformed").cast("int")).alias("bad"),
    ).first()
    if row is None or not row["body"]:  # no tools: strict text is the header alone
        return "" if single else TOOLS_HEADER
    if row["nbytes"] is not None and row["nbytes"] > max_bytes:
        raise ValueError(f"catalog renders to {row['nbytes']} bytes; over the {max_bytes} byte bound")
    if row["bad"]:
        raise ValueError("catalog has a malformed tool")
    if single:
        return row["body"]
    # every full-form line ends with a newline: join + one trailing newline
    return TOOLS_HEADER + row["body"] + "\n"


def path_name(name: Column) -> Column:
    """A property name inside a path, where ``.`` and ``[]`` have a meaning."""
    return F.replace(F.replace(F.replace(name, F.lit("~"), F.lit("~0")), F.lit("."), F.lit("~1")), F.lit("[]"), F.lit("~2"))


def shown_path(path: Column) -> Column:
    return F.replace(F.replace(F.replace(path, F.lit("~2"), F.lit("[]")), F.lit("~1"), F.lit(".")), F.lit("~0"), F.lit("~"))


def catalog_paths(tools: DataFrame) -> DataFrame:
    """One row per declared value of a tool, nested ones included: ``(device, tool, path,
    parent, depth, type, maximum, required)``. A property of an object is ``parent.name``, the
    items of an array are ``parent[]``. One step per level of the deepest declaration."""
    level = tools.select("device", F.col("name").alias("tool"), F.lit("").alias("path"), F.get_json_object("tool_json", "$.parameters").alias("schema"))
    out, depth = None, 0
    while True:
        depth += 1
        v = F.try_parse_json("schema")
        named = F.coalesce(F.try_variant_get(v, "$.properties", "variant").try_cast("map<string,variant>"), F.create_map().cast("map<string,variant>"))
        required = F.from_json(F.get_json_object("schema", "$.required"), "array<string>")
        items = F.get_json_object("schema", "$.items")
        props = F.transform(
            F.map_entries(named),
            lambda e: F.struct(
                F.concat("path", F.when(F.col("path") == "", "").otherwise("."), path_name(e["key"])).alias("path"),
                F.to_json(e["value"]).alias("schema"), F.coalesce(F.array_contains(required, e["key"]), F.lit(False)).alias("required"),
            ),
        )
        item = F.when(items.startswith("{") & (F.col("path") != ""), F.array(F.struct(F.concat("path", F.lit("[]")).alias("path"), items.alias("schema"), F.lit(False).alias("required"))))
        below = level.select("device", "tool", F.col("path").alias("parent"), F.explode(F.concat(props, F.coalesce(item, F.array().cast("array<struct<path:string,schema:string,required:boolean>>")))).alias("c"))
        below = below.select("device", "tool", "parent", "c.path", "c.schema", "c.required")
        s = F.try_parse_json("schema")
        rows = below.select(
            "device", "tool", "path", "parent", F.lit(depth).alias("depth"),
            F.coalesce(F.try_variant_get(s, "$.type", "string"), F.lit("string")).alias("type"), F.try_variant_get(s, "$.maximum", "bigint").alias("maximum"), "required",
        )
        out = rows if out is None else out.unionByName(rows)
        level = below.select("device", "tool", "path", "schema").filter(F.col("schema").rlike('"(properties|items)"'))
        if level.isEmpty():
            return out
