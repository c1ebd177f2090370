"""End-to-end batch jobs for the reference's three entry points, as Spark jobs.

* ``prepare_corpus``   -- load, first-N, format, drop failures, split, write (S1 L1 F8 F2-F4 P1 P2 F9 T1 K1)
* ``evaluate``         -- registry, cases, predictions, scoring, reports (S2 S6 P5 N1 N2 J2 C1-C9 K3 K4)
* ``unpack_teacher``   -- teacher replies -> examples -> ordered split (J3-J5 F5 C8 U1 T2 K2)

Training, generation and teacher calls are not built: predictions and teacher
replies are input tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import keep_where
from ..operators import formatters as FM, scoring, split as SP, teacher as TC
from ..sources import manifest, sinks


def resolve_setting(arg, defaults: dict, key: str, literal):
    """Argument, else config default, else literal -- with Python ``or`` semantics
    (``0`` and ``""`` count as unset). Driver-side; no Spark operator."""
    return arg or defaults.get(key) or literal


@dataclass
class PreparedCorpus:
    corpus: DataFrame        # (text, split)
    rejects: DataFrame       # (id, reject_reason, preview)
    counts: DataFrame        # (split, n)
    reject_counts: DataFrame  # (reject_reason, n)
    path: str | None


def prepare_corpus(
    spark: SparkSession, raw: DataFrame, dataset_name: str, id_col: str = "id", formatter_name: str | None = None,
    max_samples: int | None = None, val_split: float = 0.05, seed: int = 42, output_dir: str | None = None,
    include_disabled: bool = False, run_id: str | None = None,
) -> PreparedCorpus:
    """Corpus preparation: the formatter is chosen at plan time (F8), the limit is
    applied before formatting (L1, ordered by ``id_col``), failures are counted
    from the source (F9), the split is exact-size and reproducible (T1). With ``run_id`` both
    splits are written as one run (``sources.manifest``), else as two folders."""
    fmt = FM.get_formatter(formatter_name or dataset_name, include_disabled=include_disabled)
    rows = SP.head(raw, [id_col], max_samples)
    formatted = fmt(rows)
    if output_dir:  # formatted once; the split, the counts and the rejects read it back
        done = f"{output_dir.rstrip('/')}/_formatted/{dataset_name.replace('/', '_')}"
        formatted.select(id_col, "text", "reject_reason").write.mode("overwrite").parquet(done)
        formatted = spark.read.parquet(done)
    kept = FM.drop_failed(formatted).select(id_col, "text")
    split = SP.hash_split(kept, id_col, val_split, seed, names=("train", "val"))
    corpus = split.select("text", "split")
    path = None
    if output_dir and run_id:
        manifest.write_run({n: corpus.filter(F.col("split") == n).select("text") for n in ("train", "val")}, output_dir, run_id)
        path = output_dir
    elif output_dir:
        path = sinks.write_splits(corpus, output_dir, dataset_name.split("/")[-1])
    return PreparedCorpus(corpus, FM.rejects(formatted, id_col, None), SP.split_counts(corpus), FM.reject_counts(formatted), path)


@dataclass
class Evaluation:
    details: DataFrame
    board: DataFrame
    summary: DataFrame


def evaluate(
    cases: DataFrame, predictions: DataFrame, models: DataFrame | list[str], failed: DataFrame | list[str] | None = None,
    dataset: str = "", run_ts: str = "", output_dir: str | None = None,
) -> Evaluation:
    """Evaluation after generation: pair, score, aggregate, report. ``models`` is the registry's
    selection (P5) or a list of names, ``failed`` a status table (C9) or a list of names."""
    spark = cases.sparkSession
    if not isinstance(models, DataFrame):
        models = spark.createDataFrame([(m,) for m in models], "model_name string")
    if failed is not None and not isinstance(failed, DataFrame):
        failed = spark.createDataFrame([(m, "failed") for m in failed], "model_name string, status string")
    runs = scoring.run_table(models, failed)
    details = scoring.score_rows(scoring.pair_predictions(cases, predictions, runs))
    if output_dir:  # scored once; the three outputs read it back
        scored = sinks.run_dir(output_dir, "scored", run_ts)
        details.write.mode("overwrite").parquet(scored)
        details = details.sparkSession.read.parquet(scored)
    board = scoring.scoreboard(details)
    doc = scoring.summary_document(board, dataset, run_ts)
    if output_dir:
        sinks.write_model_results(details, board, output_dir, run_ts)
        # K4: the summary is written unless exactly one model succeeded (0 included)
        n_ok = runs.filter("status = 'ok'").count()
        if n_ok != 1:
            sinks.write_summary(doc, output_dir, run_ts)
    return Evaluation(details, board, doc)


def unpack_teacher(replies: DataFrame, tools_text: str, per_batch: int = 10, train_fraction: float = 0.95,
                   output_dir: str | None = None, dataset_name: str = "synthetic") -> tuple[DataFrame, DataFrame]:
    """Synthetic examples after the teacher calls: unpack, concatenate in batch
    order (U1), ordered 95/5 split (T2), write (K2). Returns (examples, yield)."""
    items = TC.unpack(replies, tools_text)
    examples = keep_where(items, F.col("item_ok")).select("batch_id", "item_pos", "text")
    split = SP.ordered_split(examples, ["batch_id", "item_pos"], train_fraction)
    if output_dir:
        sinks.write_splits(split, output_dir, dataset_name)
    return split, TC.batch_yield(replies, tools_text, per_batch)
