"""Text helpers with Python string semantics, as Spark column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters Python's str.isspace() accepts (str.strip() / str.split()
# remove them). Derived by rule rather than listed, so it always matches the running Python.
PY_WHITESPACE = "".join(ch for ch in map(chr, range(0x110000)) if ch.isspace())
# The whitespace JSON (and Python's json module) skips between tokens.
JSON_WHITESPACE = " \t\n\r"

# Java-regex character class for PY_WHITESPACE (``\uXXXX`` escapes, all BMP).
PY_WS_CLASS = "[" + "".join(f"\\u{ord(c):04x}" for c in PY_WHITESPACE) + "]"


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: Column | str) -> Column:
    """``str.strip()``: remove every Unicode whitespace character from both ends.

    Spark's one-argument ``trim`` removes only ASCII spaces.
    """
    return F.trim(col_of(c), F.lit(PY_WHITESPACE))


def py_word_count(c: Column | str) -> Column:
    """``len(str.split())`` (NULL stays NULL)."""
    s = py_strip(c)
    return F.when(s.isNull(), F.lit(None).cast("int")).when(s == "", F.lit(0)).otherwise(
        F.size(F.split(s, PY_WS_CLASS + "+"))
    )


def preview(c: Column | str, n: int) -> Column:
    """``text[:n]`` -- the truncated previews of the logs."""
    return F.substring(col_of(c), 1, n)


def clean_dataset_name(c: Column | str) -> Column:
    """File-name cleaner for datasets: ``'/'`` and ``'-'`` become ``'_'`` (K5)."""
    return F.translate(col_of(c), "/-", "__")


def clean_model_name(c: Column | str) -> Column:
    """File-name cleaner for models: ``'/'`` and ``' '`` become ``'_'`` (K5)."""
    return F.translate(col_of(c), "/ ", "__")


def let(expr: Column, fn) -> Column:
    """Evaluate ``expr`` once and pass it to ``fn`` as a lambda variable.

    Column helpers that test a value and then transform it would otherwise copy the
    value's whole expression tree into every reference; nested helpers multiply the
    copies (and the work) instead of reusing one result.
    """
    return F.element_at(F.transform(F.array(expr), fn), 1)


def keep_where(df, cond: Column):
    """Keep rows where ``cond`` is true, as a generate step instead of a filter.

    Catalyst pushes a filter below every deterministic projection by inlining the
    aliased expressions it reads; a filter on a derived column (a verdict, a reject
    reason) would then evaluate the whole derivation twice -- once in the filter and
    once in the projection. An explode of a zero-or-one element array drops the same
    rows and is not pushed through anything.
    """
    keep = F.explode(F.array_repeat(F.lit(True), F.when(cond, F.lit(1)).otherwise(F.lit(0)))).alias("_cc_keep")
    return df.select("*", keep).drop("_cc_keep")


def broadcast_if_small(df, max_rows: int = 100_000):
    """``broadcast(df)`` when a count proves it at most ``max_rows`` rows, else ``df``
    unchanged (the planner then picks a shuffle join)."""
    return F.broadcast(df) if df.count() <= max_rows else df
