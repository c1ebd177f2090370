"""End-to-end jobs and streaming forms."""

import tempfile

from pyspark.sql import functions as F

from callcorpus.plans import derived as D, jobs
from callcorpus.streaming import jobs as SJ
from paths import SF_SMALL


def test_prepare_corpus_end_to_end(spark):
    raw = D.xlam_rows(spark, SF_SMALL)
    out_dir = tempfile.mkdtemp(prefix="cc-corpus-")
    res = jobs.prepare_corpus(spark, raw, "org/xlam-style-calls", output_dir=out_dir)
    n_src = raw.count()
    n_rej = res.rejects.count()
    counts = {r.split: r.n for r in res.counts.collect()}
    assert counts["train"] + counts["val"] + n_rej == n_src  # every row accounted for
    from callcorpus.sources import readers

    back = readers.read_training_splits(spark, out_dir)
    assert back.count() == counts["train"] + counts["val"]
    assert set(back.columns) == {"text", "split"}


def test_prepare_corpus_max_samples(spark):
    raw = D.xlam_rows(spark, SF_SMALL)
    res = jobs.prepare_corpus(spark, raw, "xlam", max_samples=100)
    assert sum(r.n for r in res.counts.collect()) + res.rejects.count() == 100


def test_streaming_scoreboard_matches_batch(spark):
    cases = D.eval_cases(spark, SF_SMALL)
    preds = D.eval_predictions(spark, SF_SMALL)
    rows = preds.join(cases, "example_id").select("model_name", "example_id", "raw_output", "expected")
    src = tempfile.mkdtemp(prefix="cc-stream-src-")
    rows.repartition(4).write.mode("overwrite").parquet(src)
    stream = SJ.read_stream(spark, src, "model_name string, example_id long, raw_output string, expected string", max_files_per_trigger=1)
    q = SJ.start(SJ.scoreboard_stream(stream), tempfile.mkdtemp(prefix="cc-ckpt-"), output_mode="complete", sink="memory", query_name="board")
    q.awaitTermination()
    got = {r.model_name: (r.total, r.exact_match) for r in spark.sql("SELECT * FROM board").collect()}
    from callcorpus.operators import scoring

    want = {r.model_name: (r.total, r.exact_match) for r in scoring.scoreboard(scoring.score_rows(rows), with_pct=False).collect()}
    assert got == want


def test_streaming_upsert_matches_batch(spark):
    ev = D.table(spark, SF_SMALL, "events").select("user_id", "ts", "event_id", F.col("event_type").alias("description"))
    src = tempfile.mkdtemp(prefix="cc-upd-")
    ev.repartition(3).write.mode("overwrite").parquet(src)
    stream = SJ.read_stream(spark, src, "user_id long, ts timestamp_ntz, event_id long, description string", max_files_per_trigger=1)
    provider = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        state = SJ.upsert_state_stream(stream, "user_id", ["ts", "event_id"], ["description"])
        seen = []
        SJ.start(state, tempfile.mkdtemp(prefix="cc-ckpt-"), "update", foreach_batch=lambda df, n: seen.extend(df.collect())).awaitTermination()
    finally:
        spark.conf.unset(provider)
    got = {r.user_id: r.description for r in sorted(seen, key=lambda r: r.n_updates)}
    from callcorpus.operators import tables as TB

    want = {r.user_id: r.description for r in TB.upsert_state(ev, "user_id", ["ts", "event_id"], ["description"]).collect()}
    assert got == want


def test_format_stream_append(spark):
    raw = D.xlam_rows(spark, SF_SMALL)
    src = tempfile.mkdtemp(prefix="cc-raw-")
    raw.write.mode("overwrite").parquet(src)
    out = tempfile.mkdtemp(prefix="cc-out-")
    stream = SJ.read_stream(spark, src, "id long, query string, tools string, answers string")
    q = SJ.start(SJ.format_stream(stream), tempfile.mkdtemp(prefix="cc-ckpt-"), sink="parquet", path=out)
    q.awaitTermination()
    from callcorpus.operators import formatters as FM

    assert spark.read.parquet(out).count() == FM.drop_failed(FM.xlam_format(raw)).count()


def test_validate_stream_matches_batch(spark):
    from callcorpus.operators import catalog, validate

    calls = D.planted_calls(spark, SF_SMALL)
    tools = D.event_tools(spark, SF_SMALL).select(F.lit("events").alias("device"), "ord", "name", F.lit(None).cast("string").alias("description"), "tool_json")
    params = catalog.catalog_params(tools)
    src = tempfile.mkdtemp(prefix="cc-calls-")
    calls.repartition(3).write.mode("overwrite").parquet(src)
    stream = SJ.read_stream(spark, src, "call_id long, call_json string", max_files_per_trigger=1)
    q = SJ.start(SJ.validate_stream(stream, params), tempfile.mkdtemp(prefix="cc-ckpt-"), sink="memory", query_name="violations")
    q.awaitTermination()
    got = sorted((r.call_id, r.violation, r.param) for r in spark.sql("SELECT * FROM violations").collect())
    want = sorted((r.call_id, r.violation, r.param) for r in validate.validate_calls(calls, params).collect())
    assert got == want and len(got) > 0
