"""Evaluation scoring: extract, compare, aggregate per model.

Tables
------
cases        (example_id, command, expected)          expected = JSON text of the golden call
models       (model_name, ...)                         registry rows (P5)
predictions  (model_name, example_id, raw_output)      one generated text per model and case
details      one row per (model_name, example_id) with the four verdicts (C5)
scoreboard   one row per model: total and four counters, plus percentages (C2, C3)
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import jsonx as J
from ..functions.text import clean_model_name, col_of, keep_where, preview


# ---------------------------------------------------------------------------
# J2 + J9 + C1: read, normalise and compare as Python does
# ---------------------------------------------------------------------------

def _integer(text: str):
    """An integer; one longer than ``int`` reads is its text, which equals no other number."""
    return int(text) if len(text) <= 4_000 else ("integer", text)


_DECODER, _LONG_DECODER = json.JSONDecoder(), json.JSONDecoder(parse_int=_integer)
_MISSING = object()


def _read(text: str | None, whole: bool):
    """The JSON value of a text (``whole``), or the first ``{...}`` in it: where that is valid
    JSON, the reference's brace scan ends where its first value ends."""
    at = -1 if text is None else 0 if whole else text.find("{")
    if at < 0:
        return _MISSING
    for decoder in (_DECODER, _LONG_DECODER):
        try:
            return decoder.decode(text) if whole else decoder.raw_decode(text, at)[0]
        except (json.JSONDecodeError, RecursionError):
            return _MISSING
        except ValueError:  # an integer of more digits than ``int`` reads
            continue


def _normalised(call):
    """No call and ``{}`` have neither field; a missing key takes its default."""
    if call is _MISSING or call == {}:
        return None, None
    return (call.get("function", ""), call.get("arguments", {})) if isinstance(call, dict) else ("", {})


def _equal(a, b) -> bool:
    try:
        return a == b
    except RecursionError:
        return False


def _verdict_rows(raw: pa.Array, expected: pa.Array) -> pa.Array:
    rows = []
    for r, e in zip(raw.to_pylist(), expected.to_pylist()):
        call = _read(r, False)
        (fn, args), (fn_e, args_e) = _normalised(call), _normalised(_read(e, True))
        rows.append((call is not _MISSING, _equal(fn, fn_e), _equal(args, args_e)))
    columns = zip(*rows) if rows else ((), (), ())
    return pa.StructArray.from_arrays([pa.array(c, pa.bool_()) for c in columns], ["valid_json", "function_match", "args_match"])


def verdicts(raw: Column, expected: Column) -> Column:
    """J2 + J9 + C1 of an output and a golden call (JSON text): struct(valid_json,
    function_match, args_match), by Python's ``json`` and ``==`` over Arrow batches."""
    kind = T.StructType([T.StructField(f, T.BooleanType()) for f in ("valid_json", "function_match", "args_match")])
    return F.arrow_udf(_verdict_rows, kind)(raw.cast("string"), expected.cast("string"))


def score_rows(df: DataFrame, raw_col: str = "raw_output", expected_col: str = "expected") -> DataFrame:
    """Row-local J2 + C1: add ``predicted`` and the four verdict columns (C5 details).

    ``predicted`` is the text of the call that was read, made by column expressions (nothing is
    computed where it is not selected): mostly one VARIANT parse; texts that it refuses
    (perhaps for duplicate keys or ``NaN``) or may round (long numbers) are read by
    ``jsonx.object_fields``.
    """
    raw = F.col(raw_col)
    # J2 as one parse of the text from the first '{' (see jsonx.first_object_value)
    first = J.first_object_value(raw)
    staged = df.select("*", first.alias("_cc_first"), verdicts(raw, F.col(expected_col)).alias("_cc_v"))
    doubtful = (F.col("_cc_first").isNull() & raw.rlike(r'^[^{]*\{[ \t\n\r]*"')) | raw.rlike(J.LONG_NUMBER_RE)
    exactly = F.when(doubtful, J.object_fields(raw, "function", "arguments"))["text"]
    fm, am = F.col("_cc_v.function_match"), F.col("_cc_v.args_match")
    out = staged.select(
        "*",
        F.coalesce(exactly, F.col("_cc_first.text")).alias("predicted"),
        (fm & am).alias("exact_match"),
        fm.alias("function_match"),
        am.alias("args_match"),
        F.col("_cc_v.valid_json").alias("valid_json"),
    )
    return out.drop("_cc_first", "_cc_v")


# ---------------------------------------------------------------------------
# N1 + N2 + C9: pair models, cases and predictions
# ---------------------------------------------------------------------------

def run_table(models: DataFrame, status: DataFrame | None = None) -> DataFrame:
    """``(model_name, status)`` of the models that were run. ``models`` is the registry's
    selection (P5: ``name``) or has ``model_name``; ``status`` ``(model_name, status)`` tells
    which runs failed. A model without a status ran through."""
    name = "model_name" if "model_name" in models.columns else "name"
    runs = models.select(F.col(name).alias("model_name")).distinct()
    if status is None:
        return runs.withColumn("status", F.lit("ok"))
    told = status.groupBy("model_name").agg(F.max(F.col("status") == "failed").alias("_failed"))
    return runs.join(told, "model_name", "left").select("model_name", F.when(F.col("_failed"), "failed").otherwise("ok").alias("status"))


def _told(predictions: DataFrame, runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    ran = runs.filter(F.col("status") == "ok").select("model_name").distinct()
    return ran, predictions.select("model_name", "example_id", "raw_output").join(ran, "model_name", "left_semi")


def pair_predictions(cases: DataFrame, predictions: DataFrame, runs: DataFrame) -> DataFrame:
    """N1 + N2 + C9: every (model, case) pair of the runs that did not fail, with its
    prediction or a null ``raw_output`` (scored as invalid JSON).

    Predictions join the cases once, on the case's id; no case is multiplied by the models
    before a shuffle. Which models lack predictions follows from a count of the ids, and only
    for those are the missing pairs derived, by an anti-join. Case ids are unique, and so are
    predictions per model and case.
    """
    ran, told = _told(predictions, runs)
    present = told.join(cases, "example_id")
    keys = told.select("model_name", "example_id").join(cases.select("example_id"), "example_id", "left_semi")
    have = keys.groupBy("model_name").agg(F.count(F.lit(1)).alias("n"))
    all_cases = cases.agg(F.count(F.lit(1)).alias("cases")).scalar()
    counted = ran.join(have, "model_name", "left").withColumn("cases", all_cases)
    # the models (of a registry) that lack a prediction
    short = counted.filter(F.coalesce("n", F.lit(0)) < F.col("cases")).agg(F.collect_list("model_name").alias("models")).scalar()
    grid = cases.withColumn("models", short).withColumn("model_name", F.explode("models")).drop("models")
    missing = grid.join(keys, ["model_name", "example_id"], "left_anti").withColumn("raw_output", F.lit(None).cast("string"))
    return present.unionByName(missing)


def run_scoreboard(cases: DataFrame, predictions: DataFrame, runs: DataFrame, with_pct: bool = True) -> DataFrame:
    """``scoreboard(score_rows(pair_predictions(...)))`` by complement: a missing prediction has
    the same verdict whatever the model, so the missing pairs are never made. A model's counter
    is that of all cases without predictions plus what its predictions change."""
    ran, told = _told(predictions, runs)
    marks = ("function_match", "args_match", "exact_match")
    # without a prediction both sides compare as None: a match where the golden call has none
    cases = cases.withColumn("_none", verdicts(F.lit(None).cast("string"), F.col("expected")))
    fn, args = F.col("_none.function_match"), F.col("_none.args_match")
    none = dict(zip(marks, (fn, args, fn & args)))
    scored = score_rows(told.join(cases.select("example_id", "expected", *[c.cast("int").alias(f"_no_{m}") for m, c in none.items()]), "example_id"))
    change = scored.groupBy("model_name").agg(F.count_if("valid_json").alias("valid_json"), *[F.sum(F.col(m).cast("int") - F.col(f"_no_{m}")).alias(f"_d_{m}") for m in marks])
    base = cases.agg(F.struct(F.count(F.lit(1)).alias("total"), *[F.count_if(c).alias(m) for m, c in none.items()]).alias("b")).scalar()
    both = ran.join(change, "model_name", "left").withColumn("_b", base)
    zero = F.lit(0).cast("long")
    board = both.filter("_b.total > 0").select(
        "model_name", F.col("_b.total").alias("total"), F.coalesce("valid_json", zero).alias("valid_json"),
        *[(F.col(f"_b.{m}") + F.coalesce(f"_d_{m}", zero)).alias(m) for m in marks],
    )
    return _with_pct(board) if with_pct else board


# ---------------------------------------------------------------------------
# C2 + C3 + C4: aggregate
# ---------------------------------------------------------------------------

def pct(k: Column | str, total: Column | str) -> Column:
    """``f"{k/total*100:.1f}"``; NULL for an empty total (the reference raises).

    Python rounds the exact binary value with ties to even (6.25 -> ``6.2``).
    ``format_number`` (Java ``DecimalFormat``, HALF_EVEN on the exact value) agrees;
    ``format_string('%.1f')`` would not (it rounds the shortest decimal form half-up:
    6.25 -> 6.3, 0.15 -> 0.2). Checked against Python on every k/n for n <= 2000.
    Grouping commas (values >= 1000) are removed.
    """
    x = col_of(k).cast("double") / col_of(total).cast("double") * 100
    return F.when(col_of(total) != 0, F.regexp_replace(F.format_number(x, 1), ",", ""))


def scoreboard(details: DataFrame, with_pct: bool = True) -> DataFrame:
    """C2 (+C3): per-model totals. Partial/final hash aggregate -> one shuffle of
    one row per (map task, model), so a model that owns most rows is pre-aggregated
    map-side and never funnels its rows through one task."""
    agg = details.groupBy("model_name").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("valid_json")).alias("valid_json"),
        F.count_if(F.col("function_match")).alias("function_match"),
        F.count_if(F.col("args_match")).alias("args_match"),
        F.count_if(F.col("exact_match")).alias("exact_match"),
    )
    return _with_pct(agg) if with_pct else agg


def _with_pct(board: DataFrame) -> DataFrame:
    return board.select(
        "*",
        *[pct(c, "total").alias(f"{c}_pct") for c in ("valid_json", "function_match", "args_match", "exact_match")],
    )


def summary(board: DataFrame) -> DataFrame:
    """C4: the cross-model summary rows (model_name, exact_match, total, accuracy)."""
    return board.select(
        "model_name",
        "exact_match",
        "total",
        F.concat(pct("exact_match", "total"), F.lit("%")).alias("accuracy"),
    )


def summary_document(board: DataFrame, dataset: str, run_ts: str) -> DataFrame:
    """K4 payload as one row: ``{timestamp, total_models, dataset, summary[]}``.

    One row per model is gathered into the summary array -- the model count, not the
    data size, bounds it.
    """
    rows = summary(board)
    return rows.agg(
        F.lit(run_ts).alias("timestamp"),
        F.count(F.lit(1)).cast("int").alias("total_models"),
        F.lit(dataset).alias("dataset"),
        F.sort_array(F.collect_list(F.struct("model_name", "exact_match", "total", "accuracy"))).alias("summary"),
    )


# ---------------------------------------------------------------------------
# W1 + P6 + P7: numbering and failure listing
# ---------------------------------------------------------------------------

def number_cases(cases: DataFrame, order_by: str = "example_id") -> DataFrame:
    """W1 as the reference prints it: ``[i/total]`` is the case's 1-based position in
    the dataset and the dataset size, the same for every model. Only the (unique) ids are
    counted and ranked, range by range; the cases join their numbers."""
    from .selection import positions

    numbers = positions(cases.select(F.col(order_by).alias("_cc_id")), ["_cc_id"], "_cc_pos", "total")
    out = cases.drop("total", "position").join(numbers, F.col(order_by).eqNullSafe(F.col("_cc_id")))
    return out.withColumn("position", F.col("_cc_pos") + 1).drop("_cc_id", "_cc_pos")


def failures(details: DataFrame, verbose: bool = False) -> DataFrame:
    """P6 + P7: rows the report prints (all when verbose, else the non-exact ones),
    with the 100-character raw preview."""
    rows = details if verbose else keep_where(details, ~F.col("exact_match"))
    return rows.withColumn("raw_preview", preview("raw_output", 100))


# ---------------------------------------------------------------------------
# P5: model selection
# ---------------------------------------------------------------------------

def select_models(models: DataFrame, identifier: str | None = None) -> DataFrame:
    """P5 ``get_model_from_config``.

    No identifier: enabled models (missing ``enabled`` counts as true).
    Identifier: the first model (registry order ``ord``) whose name or model_id
    equals it, ignoring ``enabled``; when none does, a literal row built from it.
    """
    if identifier is None:
        return models.filter(F.coalesce(F.col("enabled"), F.lit(True)))
    hit = models.filter((F.col("name") == identifier) | (F.col("model_id") == identifier))
    first = hit.orderBy("ord").limit(1)
    spark = models.sparkSession
    literal = spark.createDataFrame(
        [(10**9, identifier, identifier, "model given by its id", True)],
        "ord long, name string, model_id string, description string, enabled boolean",
    )
    fallback = literal.join(hit.select(F.lit(1).alias("_hit")).limit(1), how="left_anti")
    cols = ["ord", "name", "model_id", "description", "enabled"]
    return first.select(*cols).unionByName(fallback.select(*cols))


def result_file_names(board: DataFrame, run_ts_compact: str) -> DataFrame:
    """K3/K5: ``{safe_name}_{yyyyMMdd_HHmmss}.json`` per model."""
    return board.select(
        "model_name",
        F.concat(clean_model_name("model_name"), F.lit("_" + run_ts_compact + ".json")).alias("file_name"),
    )
