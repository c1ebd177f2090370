"""Skewed inputs: a hot model, a hot conversation, a hot entity. Results stay exact and
the plans keep their map-side reduction (partial aggregate / partial window limit)."""

from pyspark.sql import functions as F

from callcorpus.operators import scoring, tables as TB


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_model_scoreboard(spark):
    n = 20000
    preds = spark.range(n).select(
        F.when(F.col("id") % 10 == 0, F.lit("cold")).otherwise(F.lit("hot")).alias("model_name"),
        F.col("id").alias("example_id"),
        F.when(F.col("id") % 3 == 0, F.lit("nope")).otherwise(F.lit('{"function": "f", "arguments": {}}')).alias("raw_output"),
        F.lit('{"function": "f", "arguments": {}}').alias("expected"),
    )
    board = scoring.scoreboard(scoring.score_rows(preds), with_pct=False)
    assert "partial_count" in _plan(board)
    got = {r.model_name: (r.total, r.exact_match) for r in board.collect()}
    hot_ids = [i for i in range(n) if i % 10 != 0]
    assert got["hot"] == (len(hot_ids), sum(1 for i in hot_ids if i % 3 != 0))


def test_hot_conversation_transcript_cut_map_side(spark):
    segs = spark.range(30000).select(
        F.when(F.col("id") < 20000, F.lit(0)).otherwise(F.col("id") % 50 + 1).alias("conv_id"),
        F.col("id").alias("turn"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text"),
    )
    out = TB.transcripts(segs, "conv_id", "turn", "role", "text", max_segments=3)
    assert "WindowGroupLimit" in _plan(out) and "Partial" in _plan(out)
    row = out.filter("conv_id = 0").first()
    assert row.n_segments == 3 and row.transcript == "user: 0\nuser: 1\nuser: 2"


def test_hot_entity_state(spark):
    upd = spark.range(50000).select(
        F.when(F.col("id") % 100 == 0, F.col("id")).otherwise(F.lit(7)).alias("item_id"),
        F.col("id").alias("ts"), F.col("id").alias("event_id"),
        F.when(F.col("id") % 2 == 0, F.col("id").cast("string")).alias("description"),
    )
    state = TB.upsert_state(upd, "item_id", ["ts", "event_id"], ["description"])
    assert "partial_max_by" in _plan(state)
    hot = state.filter("item_id = 7").first()
    assert hot.description == "49998" and hot.n_updates == 50000 - 500 + (1 if 7 % 100 == 0 else 0)


def test_deep_page_keeps_map_side_limit(spark):
    corpus = spark.range(5000).select(F.col("id").alias("vec_id"), F.array(F.col("id").cast("float"), F.lit(1.0)).alias("embedding"))
    q = spark.createDataFrame([(0, [1.0, 0.0])], "q long, v array<double>")
    shallow = _plan(TB.paged_search(corpus, q, "vec_id", "embedding", page=5, per_page=100))
    assert "WindowGroupLimit" in shallow and "Partial" in shallow
    out = TB.paged_search(corpus, q, "vec_id", "embedding", page=20, per_page=100)  # ranks 1901..2000
    assert sorted(r.rank for r in out.collect()) == list(range(1901, 2001))
