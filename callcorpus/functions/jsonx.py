"""JSON text with Python ``json`` semantics, built from Spark column expressions.

Spark reads JSON with Jackson (``get_json_object``, ``json_object_keys``) and with the
VARIANT parser (``try_parse_json``). Neither matches Python's ``json`` module exactly,
so this module closes the gaps with native expressions:

* ``json_loads_ok``      -- would ``json.loads(text)`` succeed (no trailing data)?
* ``parsed``             -- the VARIANT of a text exactly when ``json.loads`` succeeds.
* ``first_object``       -- J2: the first ``{...}`` found by a brace scan, if it parses.
* ``first_object_value`` -- J2 as one strict parse from the first ``{`` (same rows).
* ``py_dumps_at``        -- J1: ``json.dumps(value)`` text of the value at a JSON path,
                            key order kept, Python spacing, ``ensure_ascii`` escapes and
                            Python float repr.
* ``canonical_at``       -- comparison text: keys sorted, ``1.0`` == ``1`` (C1).
* ``object_fields``      -- fields of an object as comparison text, for what the VARIANT parser
                            refuses or rounds: duplicate keys, ``NaN``/``Infinity``, long numbers.
* ``equality_form``      -- comparison text in which values that Python calls equal are the same.

Where a whole document is read as VARIANT (``parsed``, ``json_loads_ok``), duplicate keys and
``NaN``/``Infinity`` count as invalid; ``operators.scoring`` falls back to ``object_fields``.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import JSON_WHITESPACE, col_of, let

# One token of JSON-ish text: a (possibly unterminated) string, a backslash escape,
# a bracket, or a run of anything else. DOTALL so an escaped newline stays an escape.
_TOKEN_RE = r'(?s)"(?:[^"\\]|\\.)*+"?|\\.?|[{}\[\]]|[^"{}\[\]\\]++'


def _scan_end(text: Column, opens: tuple[str, ...], closes: tuple[str, ...]) -> Column:
    """1-based end offset of the bracket group opened by the first character of ``text``.

    Strings are atomic, a backslash outside a string skips one character (as the
    reference brace scan does). NULL when the group never closes.
    """
    toks = F.regexp_extract_all(text, F.lit(_TOKEN_RE), 0)
    init = F.struct(F.lit(0).alias("d"), F.lit(0).alias("p"), F.lit(-1).alias("e"))

    def step(acc, t):
        is_open = t.isin(*opens)
        is_close = t.isin(*closes)
        d = acc["d"] + F.when(is_open, 1).when(is_close, -1).otherwise(0)
        p = acc["p"] + F.length(t)
        e = F.when(acc["e"] >= 0, acc["e"]).when(is_close & (acc["d"] == 1), p).otherwise(F.lit(-1))
        return F.struct(d.alias("d"), p.alias("p"), e.alias("e"))

    return F.aggregate(toks, init, step, lambda acc: F.when(acc["e"] >= 0, acc["e"]))


def json_loads_ok(c: Column | str) -> Column:
    """True when ``json.loads(c)`` would succeed; NULL input gives NULL.

    ``try_parse_json`` stops after the first value and ignores what follows. The text
    is therefore parsed twice, once as the only element of an array and once as the
    value of an object field. Trailing text survives the array wrapper only when it
    starts with ``,`` (more elements) or ``]``, and the object wrapper only when it
    starts with ``,`` + a key + ``:`` or ``}``. A key followed by ``:`` is invalid in an
    array, so no trailing text passes both -- an exact check with two native parses
    and no scan.
    """
    def check(x):
        as_elem = F.try_parse_json(F.concat(F.lit("["), x, F.lit("]")))
        as_field = F.try_parse_json(F.concat(F.lit('{"v":'), x, F.lit("}")))
        return F.when(x.isNull(), F.lit(None).cast("boolean")).otherwise(as_elem.isNotNull() & as_field.isNotNull())

    return let(col_of(c), check)


def parsed(c: Column | str) -> Column:
    """VARIANT of ``c`` when ``json.loads(c)`` succeeds, else NULL (one parse reused)."""
    def parse(x):
        as_elem = F.try_parse_json(F.concat(F.lit("["), x, F.lit("]")))
        as_field = F.try_parse_json(F.concat(F.lit('{"v":'), x, F.lit("}")))
        return F.when(as_elem.isNotNull(), F.try_variant_get(as_field, "$.v", "variant"))

    return let(col_of(c), parse)


def json_text(c: Column | str) -> Column:
    """``c`` when it is a complete JSON document (``json.loads`` succeeds), else NULL."""
    return let(col_of(c), lambda x: F.when(json_loads_ok(x), x))


def first_object(c: Column | str) -> Column:
    """J2 ``parse_json_output``: text of the first ``{...}`` object in free text.

    Only the first ``{`` is tried; the brace scan treats strings atomically; the cut
    text must parse. Returns the original substring (NULL when there is none).
    """
    def cut(sub):
        return let(
            _scan_end(sub, ("{",), ("}",)),
            lambda end: let(F.substring(sub, 1, end), lambda obj: F.when(end.isNotNull() & F.try_parse_json(obj).isNotNull(), obj)),
        )

    return let(col_of(c), lambda out: F.when(F.instr(out, "{") > 0, cut(F.substring(out, F.instr(out, "{"), 1 << 30))))


def first_object_value(c: Column | str) -> Column:
    """J2 as a parsed value: struct(text, value) of the first ``{...}`` object, or NULL.

    For valid JSON the reference brace scan ends exactly where the first JSON value
    ends (strings are atomic in both, and escapes outside strings are invalid), and
    ``try_parse_json`` reads that first value strictly while ignoring what follows.
    One native parse of the text from the first ``{`` therefore decides the same
    rows as scan + ``json.loads`` -- no token scan. ``text`` is the object re-written
    compactly in source key order (``get_json_object``).
    """
    def from_sub(sub):
        return let(
            F.try_parse_json(sub),
            lambda v: F.when(v.isNotNull(), F.struct(F.get_json_object(sub, "$").alias("text"), v.alias("value"))),
        )

    return let(col_of(c), lambda out: F.when(F.instr(out, "{") > 0, from_sub(F.substring(out, F.instr(out, "{"), 1 << 30))))


# ---------------------------------------------------------------------------
# Json.dumps text
# ---------------------------------------------------------------------------

# Split compact JSON into (string | sci-number | any single char) tokens.
_NUM_TOKEN_RE = r'(?s)"(?:[^"\\]|\\.)*+"|-?[0-9]+(?:\.[0-9]+)?E-?[0-9]+|.'
_SCI_RE = r"^-?([0-9]+)(?:\.([0-9]+))?E(-?[0-9]+)$"
# Split JSON into (\uXXXX escape | other escape | run of plain characters).
_ESC_TOKEN_RE = r"(?s)\\u[0-9A-Fa-f]{4}|\\.|[^\\]+"


def python_spacing(c: Column | str) -> Column:
    """Compact JSON -> Python ``json.dumps`` separators (``', '`` and ``': '``).

    Strings are skipped as atoms, so separators inside them are untouched.
    """
    return F.regexp_replace(col_of(c), r'\G((?:"(?:[^"\\]|\\.)*+"|[^",:])*+)([,:])', "$1$2 ")


def _py_float(tok: Column) -> Column:
    """Java ``Double.toString`` scientific form -> Python ``repr(float)``."""
    neg = tok.startswith("-")
    ip = F.regexp_extract(tok, _SCI_RE, 1)
    fp = F.regexp_extract(tok, _SCI_RE, 2)
    e = F.regexp_extract(tok, _SCI_RE, 3).cast("int") + F.length(ip) - 1
    raw_digits = F.regexp_replace(F.concat(ip, fp), "^0+", "")
    digits = F.regexp_replace(raw_digits, "0+$", "")
    digits = F.when(digits == "", F.lit("0")).otherwise(digits)
    int_part = F.substring(F.rpad(digits, e + 1, "0"), 1, e + 1)
    frac = F.substring(digits, e + 2, 1 << 30)
    fixed_pos = F.concat(int_part, F.lit("."), F.when(frac == "", F.lit("0")).otherwise(frac))
    fixed_neg = F.concat(F.lit("0."), F.repeat(F.lit("0"), -e - 1), digits)
    rest = F.substring(digits, 2, 1 << 30)
    sci = F.concat(
        F.substring(digits, 1, 1),
        F.when(rest == "", F.lit("")).otherwise(F.concat(F.lit("."), rest)),
        F.lit("e"),
        F.when(e < 0, F.lit("-")).otherwise(F.lit("+")),
        F.lpad(F.abs(e).cast("string"), 2, "0"),
    )
    body = F.when((e >= 0) & (e < 16), fixed_pos).when((e < 0) & (e >= -4), fixed_neg).otherwise(sci)
    return F.concat(F.when(neg, F.lit("-")).otherwise(F.lit("")), body)


def python_floats(c: Column | str) -> Column:
    """Rewrite Jackson's scientific float text (``1.0E-5``) the way Python prints it."""
    def fix(x):
        toks = F.regexp_extract_all(x, F.lit(_NUM_TOKEN_RE), 0)
        fixed = F.array_join(F.transform(toks, lambda t: F.when(t.rlike(_SCI_RE), _py_float(t)).otherwise(t)), "")
        # Only numbers outside strings carry an 'E' next to a digit; cheap pre-check.
        return F.when(x.rlike(r"[0-9]E-?[0-9]"), fixed).otherwise(x)

    return let(col_of(c), fix)


def _escape_char(ch: Column) -> Column:
    cp = F.ascii(ch)
    v = cp - 0x10000
    hi = F.lit(0xD800) + F.shiftright(v, 10)
    lo = F.lit(0xDC00) + v.bitwiseAND(F.lit(0x3FF))
    bmp = F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(cp)), 4, "0"))
    astral = F.concat(F.lit("\\u"), F.lower(F.hex(hi)), F.lit("\\u"), F.lower(F.hex(lo)))
    return F.when((cp >= 32) & (cp <= 126), ch).when(cp <= 0xFFFF, bmp).otherwise(astral)


def ascii_escape(c: Column | str) -> Column:
    """``ensure_ascii=True``: escape non-printable-ASCII as lower-case ``\\uxxxx``.

    Jackson leaves BMP characters raw and writes upper-case hex for the escapes it
    makes (control characters, astral pairs); Python writes lower-case hex for both.
    """
    def run(x):
        toks = F.regexp_extract_all(x, F.lit(_ESC_TOKEN_RE), 0)
        escaped = F.array_join(F.transform(toks, fix), "")
        return F.when(x.rlike(r"[^\x20-\x7E]|\\u"), escaped).otherwise(x)

    def fix(t):
        plain = F.array_join(F.transform(F.split(t, ""), _escape_char), "")
        return (
            F.when(t.startswith("\\u"), F.lower(t))
            .when(t.startswith("\\"), t)
            .when(t.rlike(r"[^\x20-\x7E]"), plain)
            .otherwise(t)
        )

    return let(col_of(c), run)


def _variant_at(j: Column, path: str) -> Column:
    return F.try_variant_get(F.try_parse_json(j), path, "variant")


def py_dumps_at(c: Column | str, path: str = "$", parsed_doc: Column | None = None) -> Column:
    """``json.dumps(value)`` for the value at ``path`` of JSON text ``c``.

    Object key order is the source order (Jackson keeps it). String scalars are
    re-quoted from the VARIANT value because ``get_json_object`` unquotes them.
    NULL when the path is absent. ``parsed_doc`` is ``c`` already parsed to VARIANT
    (pass it when several paths of one document are dumped, to parse it once).
    """
    j = col_of(c)

    def from_variant(v):
        return let(
            F.schema_of_variant(v),
            lambda kind: F.when(kind == "STRING", F.to_json(v))
            .when(kind == "VOID", F.lit("null"))
            .otherwise(F.get_json_object(j, path)),
        )

    v = _variant_at(j, path) if parsed_doc is None else F.try_variant_get(parsed_doc, path, "variant")
    return ascii_escape(python_floats(python_spacing(let(v, from_variant))))


def canonical_at(c: Column | str, path: str = "$") -> Column:
    """Comparison text of the value at ``path``: sorted keys, numbers normalised.

    ``'null'`` for a JSON null, NULL when absent or unparseable.
    """
    return F.to_json(_variant_at(col_of(c), path))


# ---------------------------------------------------------------------------
# Python's json.loads and == beyond what VARIANT holds
# ---------------------------------------------------------------------------

# Tokens of JSON text; whatever is none (a lone quote, other characters) stays one that no parser accepts.
_JSON_TOKEN_RE = r'(?s)"(?:[^"\\]|\\.)*+"|[{}\[\],:]|[^ \t\n\r{}\[\],:"]+|"'
# Tokens of comparison text.
_FORM_TOKEN_RE = r'(?s)"(?:[^"\\]|\\.)*+"|-?[0-9][0-9.eE+-]*|true|false|null|NaN|-?Infinity|[{}\[\],:]'
# The literals beyond JSON that Python's json reads.
_CONSTANTS = ("NaN", "Infinity", "-Infinity")
#: Digits in a row from which VARIANT may have rounded a number or forgotten that it is a float, and exponents beyond doubles.
LONG_NUMBER_RE = r"[0-9.]{16,}|[0-9][eE][+-]?[0-9]{3}"
_LIMB = 10**9


def _div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b))


def _whole_digits(d: Column) -> Column:
    """All decimal digits of a double of at least 2**63: a 61-bit integer times a power of two,
    multiplied out in limbs of nine digits."""

    def times(limbs, factor):
        def step(acc, limb):
            return let(limb * factor + acc["carry"], lambda x: F.struct(F.array_append(acc["out"], x % _LIMB).alias("out"), _div(x, _LIMB).alias("carry")))

        zero = F.struct(F.array().cast("array<bigint>").alias("out"), F.lit(0).cast("bigint").alias("carry"))
        return F.aggregate(limbs, zero, step, lambda acc: F.when(acc["carry"] > 0, F.array_append(acc["out"], acc["carry"])).otherwise(acc["out"]))

    def scaled(k):
        m = (d / F.pow(F.lit(2.0), k)).cast("bigint")
        limbs = let(m, lambda x: F.array(x % _LIMB, _div(x, _LIMB) % _LIMB, _div(x, _LIMB * _LIMB)))
        factors = F.concat(F.array_repeat(F.lit(1 << 29).cast("bigint"), _div(k, 29).cast("int")), F.array(F.pow(F.lit(2.0), k % 29).cast("bigint")))
        return F.regexp_replace(F.array_join(F.transform(F.reverse(F.aggregate(factors, limbs, times)), lambda x: F.lpad(x.cast("string"), 9, "0")), ""), "^0+", "")

    return let((F.floor(F.log2(d)) - 60).cast("int"), scaled)


def number_form(tok: Column) -> Column:
    """A JSON number in the form that is the same for numbers Python calls equal: integers exact
    at any length, floats as the integer they equal or else as the double's text."""

    def from_double(d):
        size = F.abs(d)
        return (
            F.when(size == float("inf"), F.when(d > 0, "Infinity").otherwise("-Infinity"))
            .when(size >= 2.0**63, F.concat(F.when(d < 0, "-").otherwise(""), _whole_digits(size)))
            .when(d.cast("bigint").cast("double") == d, d.cast("bigint").cast("string"))
            .otherwise(d.cast("string"))
        )

    return F.when(tok.isin(*_CONSTANTS), tok).when(tok == "-0", "0").when(tok.rlike("^-?[0-9]+$"), tok).otherwise(let(tok.try_cast("double"), from_double))


def equality_form(canonical: Column) -> Column:
    """Comparison text with every number and boolean in its ``number_form``: ``1``, ``1.0``,
    ``1e0`` and ``true`` are the same, and so are ``1e16`` and ``10000000000000000``."""
    def form(t):
        return F.when(t == "true", "1").when(t == "false", "0").when(t.rlike("^[-0-9NI]"), number_form(t)).otherwise(t)

    return F.array_join(F.transform(F.regexp_extract_all(canonical, F.lit(_FORM_TOKEN_RE), 0), form), "")


def _is_key(toks: Column, t: Column, i: Column) -> Column:
    return t.startswith('"') & F.coalesce(F.try_element_at(toks, i + 2) == ":", F.lit(False))


def _loads(toks: Column) -> Column:
    """Would ``json.loads`` read these tokens: a strict parse with every key made unlike all
    others and 0 for the literals beyond JSON."""

    def neutral(t, i):
        return F.when(_is_key(toks, t, i), F.concat(F.substring(t, F.lit(1), F.length(t) - 1), F.lit("#"), i.cast("string"), F.lit('"'))).when(t.isin(*_CONSTANTS), "0").otherwise(t)

    return F.try_parse_json(F.array_join(F.transform(toks, neutral), " ")).isNotNull()


def _fold(toks: Column) -> Column:
    """Fields of the object that the (valid) tokens spell, in source order:
    array<struct<o, at, key, v>> with comparison texts ``v``. One pass with a stack of the open
    containers; a closed object keeps the last field of each key, in VARIANT's key order."""
    item = "struct<o:string,at:int,key:string,v:string>"

    def event(t, i):
        quoted = t.startswith('"')
        kind = F.when(t == "{", "object").when(t == "[", "array").when(t.isin("}", "]"), "close").when(t.isin(",", ":"), "skip").when(_is_key(toks, t, i), "key").otherwise("value")

        def read(v):
            order = F.when(quoted, F.hex(F.encode(F.try_variant_get(v, "$", "string"), "UTF-16BE")))
            return F.struct(kind.alias("kind"), F.when(quoted, F.to_json(v)).when(kind == "value", t).alias("text"), order.alias("o"))

        return let(F.try_parse_json(F.when(quoted, t)), read)

    def closed(frame):
        def last(fields):
            kept = F.filter(fields, lambda x, i: ~F.coalesce(F.try_element_at(fields, i + 2)["o"] == x["o"], F.lit(False)))
            return F.concat(F.lit("{"), F.array_join(F.transform(kept, lambda x: F.concat(x["key"], F.lit(":"), x["v"])), ","), F.lit("}"))

        values = F.concat(F.lit("["), F.array_join(F.transform(frame["items"], lambda x: x["v"]), ","), F.lit("]"))
        return F.when(frame["object"], let(F.sort_array(frame["items"]), last)).otherwise(values)

    def frame(o, key, is_object, items):
        return F.struct(o.alias("o"), key.alias("key"), is_object.alias("object"), items.alias("items"))

    nothing, empty = F.lit(None).cast("string"), F.array().cast(f"array<{item}>")

    def step(stack, e):
        """A key or a value changes the innermost open container; the outermost stays open."""
        kind, depth = e["kind"], F.size(stack)
        value = F.when(kind == "value", e["text"]).when((kind == "close") & (depth > 1), closed(F.element_at(stack, -1)))
        left = depth - F.when((kind == "close") & (depth > 1), 1).otherwise(0)

        def change(now):
            top, v, is_key = now["top"], now["v"], kind == "key"
            new = F.struct(top["o"].alias("o"), F.size(top["items"]).alias("at"), top["key"].alias("key"), v.alias("v"))
            items = F.when(v.isNull(), top["items"]).otherwise(F.array_append(top["items"], new))
            changed = frame(F.when(is_key, e["o"]).otherwise(top["o"]), F.when(is_key, e["text"]).otherwise(top["key"]), top["object"], items)
            return F.concat(F.slice(stack, F.lit(1), now["left"] - 1), F.array(changed))

        changed = let(F.struct(F.element_at(stack, left).alias("top"), value.alias("v"), left.alias("left")), change)
        return F.when(kind.isin("object", "array"), F.array_append(stack, frame(nothing, nothing, kind == "object", empty))).otherwise(changed)

    events = F.filter(F.transform(toks, event), lambda e: e["kind"] != "skip")
    start = F.array().cast(f"array<struct<o:string,key:string,object:boolean,items:array<{item}>>>")
    return F.aggregate(events, start, step, lambda stack: F.element_at(stack, 1)["items"])


def object_fields(c: Column | str, *names: str, whole: bool = False) -> Column:
    """The first ``{...}`` of free text as Python reads it: struct(text, empty, one comparison
    text per name), NULL when there is none or ``json.loads`` fails. The last of equal keys
    counts, ``NaN``/``Infinity`` are values, numbers stay as written (``equality_form`` unites
    them). ``whole``: the object must be the entire text."""

    def fields(toks):
        def pick(items):
            def last(name):
                return F.try_element_at(F.filter(items, lambda x: x["key"] == f'"{name}"'), F.lit(-1))["v"].alias(name)

            return F.struct(F.array_join(toks, "").alias("text"), (F.size(items) == 0).alias("empty"), *map(last, names))

        return F.when(_loads(toks), let(_fold(toks), pick))

    def cut(sub):
        def found(end):
            fits = end.isNotNull() & ((end == F.length(sub)) if whole else F.lit(True))
            return F.when(fits, let(F.regexp_extract_all(F.substring(sub, F.lit(1), end), F.lit(_JSON_TOKEN_RE), 0), fields))

        return let(_scan_end(sub, ("{",), ("}",)), found)

    def start(text):
        body = F.trim(text, F.lit(JSON_WHITESPACE)) if whole else F.substring(text, F.instr(text, "{"), F.lit(1 << 30))
        return F.when(F.substring(text, F.lit(1), F.lit(1)) == "{" if whole else F.instr(text, "{") > 0, let(body, cut))

    return let(F.trim(col_of(c), F.lit(JSON_WHITESPACE)) if whole else col_of(c), start)
