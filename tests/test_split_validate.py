"""T1/T2 sizes, paging, segments, R1 golden case 13."""

import math

import pytest
from pyspark.sql import functions as F

from callcorpus.functions import segments as SG
from callcorpus.operators import catalog, split as SP, validate as VL


def _counts(df):
    return {r.split: r.n for r in SP.split_counts(df).collect()}


def test_hash_split_exact_sizes(spark):
    for n, want in [(1, 1), (20, 1), (21, 2), (59981, 3000)]:
        df = spark.range(n).withColumnRenamed("id", "doc_id")
        c = _counts(SP.hash_split(df, "doc_id", 0.05, 42))
        assert c.get("val", 0) == want == math.ceil(n * 0.05)
        assert c.get("train", 0) == n - want


def test_ordered_split(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    out = SP.ordered_split(df, ["k"], 0.95)
    assert _counts(out) == {"train": 950, "val": 50}
    assert out.filter("split = 'val'").agg(F.min("k")).first()[0] == 950


def test_segments(spark):
    t = "<|im_start|>user\nq1<|im_end|>\n<|im_start|>assistant\na1<|im_end|>\n<|im_start|>assistant\n a2 <|im_end|>"
    df = spark.createDataFrame([(t,), ("plain",)], "t string")
    rows = df.select(SG.last_assistant_segment("t").alias("a"), SG.first_user_segment("t").alias("u")).collect()
    assert (rows[0].a, rows[0].u) == ("a2", "q1")
    assert (rows[1].a, rows[1].u) == ("plain", None)


def test_strip_fences(spark):
    df = spark.createDataFrame([("```json\n[1]\n```",), ("```\n{}\n```",), (" [2] ",)], "c string")
    assert [r.x for r in df.select(SG.strip_fences("c").alias("x")).collect()] == ["[1]", "{}", "[2]"]


def test_golden_case_13_missing_required(spark):
    # the update tool of the wearable catalog requires action_item_id; golden case 13 omits it
    tool = (
        '{"name": "update_action_item_tool", "description": "Update an action item", "parameters": {"type": "object", '
        '"properties": {"action_item_id": {"type": "string"}, "completed": {"type": "boolean"}, '
        '"description": {"type": "string"}, "due_at": {"type": "string"}}, "required": ["action_item_id"]}}'
    )
    tools = spark.createDataFrame([("device", 0, "update_action_item_tool", "", tool)], "device string, ord int, name string, description string, tool_json string")
    params = catalog.catalog_params(tools)
    calls = spark.createDataFrame([(13, '{"function": "update_action_item_tool", "arguments": {"completed": true}}')], "call_id long, call_json string")
    out = [(r.violation, r.param) for r in VL.validate_calls(calls, params).collect()]
    assert out == [("missing_required", "action_item_id")]


def test_pluggable_tokenizer(spark):
    from callcorpus.operators import runlogs

    df = spark.createDataFrame([("a b c",), ("",), (None,)], "t string")
    ws = [r.n for r in df.select(runlogs.token_count("t").alias("n")).collect()]
    chars = [r.n for r in df.select(runlogs.token_count("t", lambda xs: [len(x) for x in xs]).alias("n")).collect()]
    assert ws == [3, 0, None] and chars == [5, 0, None]


def test_conversations_with_transcripts(spark):
    from callcorpus.operators import tables as TB

    convs = spark.createDataFrame(
        [(1, "2024-01-02 00:00:00", "completed"), (2, "2024-01-03 00:00:00", "processing"), (3, "2024-01-04 00:00:00", "failed")],
        "id long, created string, status string",
    ).withColumn("created", F.col("created").cast("timestamp_ntz"))
    segs = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (1, 2, "user", "x"), (2, 0, "user", "a")],
                                 "conv_id long, turn long, role string, text string")
    page = TB.conversations_query(convs, "created", "status", "id")  # default statuses drop conv 3
    out = {r.id: r.transcript for r in TB.conversations_with_transcripts(page, "id", segs, "conv_id", "turn", "role", "text",
                                                                        max_transcript_segments=2).collect()}
    assert out == {1: "user: hi\nassistant: yo", 2: "user: a"}
    none = TB.conversations_with_transcripts(page, "id", segs, "conv_id", "turn", "role", "text", include_transcript=False)
    assert {r.transcript for r in none.collect()} == {None}


def test_hash_split_reproducible_across_partitionings(spark):
    df = spark.range(5000).withColumnRenamed("id", "doc_id")
    a = {r.doc_id for r in SP.hash_split(df, "doc_id").filter("split = 'val'").collect()}
    b = {r.doc_id for r in SP.hash_split(df.repartition(7), "doc_id").filter("split = 'val'").collect()}
    c = {r.doc_id for r in SP.hash_split(df, "doc_id", seed=7).filter("split = 'val'").collect()}
    assert a == b and len(a) == 250 and a != c and len(c) == 250


def test_vector_search_where_and_limits(spark):
    from callcorpus.operators import tables as TB

    corpus = spark.createDataFrame([(i, [float(i % 5), 1.0], i % 2 == 0) for i in range(60)], "vec_id long, embedding array<float>, discarded boolean")
    q = spark.createDataFrame([(0, [1.0, 1.0])], "q long, v array<double>")
    top = TB.vector_search(corpus, q, "vec_id", "embedding", limit=20, where=~F.col("discarded"))
    rows = top.collect()
    assert len(rows) == 20 and all(r.vec_id % 2 == 1 for r in rows)
    with pytest.raises(ValueError):  # above the declared maximum: an error, not a shorter answer
        TB.vector_search(corpus, q, "vec_id", "embedding", limit=50)
    assert TB.vector_topk(corpus, q.limit(0), "vec_id", "embedding", 3).count() == 0
    for bad in (lambda: TB.vector_search(corpus, q, "vec_id", "embedding", limit=0), lambda: TB.paged_search(corpus, q, "vec_id", "embedding", page=0)):
        with pytest.raises(ValueError):
            bad()
    zero = corpus.unionByName(spark.createDataFrame([(99, [0.0, 0.0], False)], corpus.schema))
    assert 99 not in {r.vec_id for r in TB.vector_search(zero, q, "vec_id", "embedding", limit=20).collect()}
    page = TB.paged_search(corpus, q, "vec_id", "embedding", page=2, per_page=10)
    assert sorted(r.rank for r in page.collect()) == list(range(11, 21))


def test_stored_length_sketches_merge_within_the_bound(spark, tmp_path):
    from callcorpus.operators import runlogs

    df = spark.range(30_000).select(
        (F.col("id") % 3).cast("string").alias("dataset"), F.when(F.col("id") % 10 == 0, "val").otherwise("train").alias("split"),
        F.repeat(F.lit("w "), (F.col("id") * 7919 % 3000).cast("int")).alias("text"),
    )
    for part in ("0", "1", "2"):  # each dataset's sketches are appended when it arrives
        runlogs.length_sketches(df.filter(F.col("dataset") == part), "text", ["dataset", "split"]).write.mode("append").parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    whole = runlogs.merged_lengths(stored).first()
    assert (whole.n_texts, whole.max_tokens, whole.n_over_budget) == (30_000, 2999, df.filter(runlogs.token_count("text") > 2048).count())
    assert all(abs(q.tokens / 3000 - q.p) <= 3 * runlogs.rank_error() + 1e-3 for q in whole.percentiles)
    by = {r.split: r.n_texts for r in runlogs.merged_lengths(stored, ["split"]).collect()}
    assert by == {"train": 27_000, "val": 3_000}
    nothing = runlogs.merged_lengths(runlogs.length_sketches(df.limit(0), "text", ["split"])).first()
    assert nothing.percentiles is None
    assert runlogs.merged_lengths(runlogs.length_sketches(df.select("split", F.lit(None).cast("string").alias("text")), "text", ["split"])).first().n_texts == 0


def test_length_flags_and_percentiles(spark):
    from callcorpus.operators import runlogs

    df = spark.createDataFrame([(" ".join(["w"] * n),) for n in (1, 10, 100, 3000)], "text string")
    flags = sorted((r.n_tokens, r.over_budget) for r in runlogs.length_flags(df, "text").collect())
    assert flags == [(1, False), (10, False), (100, False), (3000, True)]
    p = runlogs.length_percentiles(df, "text", (0.5, 1.0)).first()
    assert p.max_tokens == 3000 and p.percentiles[1] == 3000 and p.percentiles[0] in (10, 100)


def test_splits_are_exact_with_ties_and_nulls(spark):
    rows = [(i % 5, i) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, x long")
    n = {r.split: r["count"] for r in SP.hash_split(df, "id", 0.05).groupBy("split").count().collect()}
    assert n == {"train": 950, "val": 50}
    tied = spark.createDataFrame([(None if i < 100 else 7, i) for i in range(1000)], "k long, x long")
    n = {r.split: r["count"] for r in SP.ordered_split(tied, ["k"], 0.5).groupBy("split").count().collect()}
    assert n == {"train": 500, "val": 500}
    named = spark.createDataFrame([(f"s{i % 3}", i) for i in range(90)], "k string, x long")
    n = {r.split: r["count"] for r in SP.ordered_split(named, ["k"], 0.4).groupBy("split").count().collect()}
    assert n == {"train": 36, "val": 54}


def test_two_devices_are_judged_apart(spark):
    rows = [("d1", "f", "a", "integer", 5, True), ("d2", "f", "a", "string", None, False), ("d2", "g", "b", "string", None, False)]
    params = spark.createDataFrame(rows, "device string, tool string, param string, type string, maximum long, required boolean")
    call = '{"function": "%s", "arguments": {%s}}'
    calls = [("d1", call % ("f", '"a": 9')), ("d2", call % ("f", '"a": 9')), ("d2", call % ("f", '"a": "9"')), ("d1", call % ("g", "")), ("d2", call % ("g", "")), (None, call % ("f", "")), ("d3", call % ("f", ""))]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(calls)], "call_id long, on string, call_json string")
    got = sorted(tuple(r) for r in VL.validate_calls(df, params, device_col="on").collect())
    assert got == [(0, "over_maximum", "a"), (1, "wrong_type", "a"), (3, "unknown_function", None), (5, "unknown_function", None), (6, "unknown_function", None)]
    with pytest.raises(ValueError):  # two declarations, and the calls name no device
        VL.validate_calls(df, params)


def test_nested_parameters(spark):
    tool = (
        '{"name": "t", "parameters": {"properties": {"a.b": {"type": "integer"}, "o": {"type": "object", "properties": {"x[]": {"type": "string"}, "deep": {"type": "object", '
        '"properties": {"n": {"type": "integer", "maximum": 3}}, "required": ["n"]}}, "required": ["deep"]}, "l": {"type": "array", "items": {"type": "array", "items": {"type": "boolean"}}}}}}'
    )
    tools = spark.createDataFrame([("d", "t", tool)], "device string, name string, tool_json string")
    paths = catalog.catalog_paths(tools)
    assert {(r.path, r.parent, r.depth, r.type, r.required) for r in paths.collect()} == {
        ("a~1b", "", 1, "integer", False), ("o", "", 1, "object", False), ("l", "", 1, "array", False), ("o.x~2", "o", 2, "string", False), ("o.deep", "o", 2, "object", True),
        ("l[]", "l", 2, "array", False), ("o.deep.n", "o.deep", 3, "integer", True), ("l[][]", "l[]", 3, "boolean", False),
    }
    args = ['{"a.b": "x"}', '{"o": {}}', '{"o": {"x[]": 1, "deep": {}}}', '{"o": {"deep": {"n": 4, "m": 1}}, "a": {"b": 1}}', '{"l": [[true], [1, 2], 3]}', '{"o": {"deep": {"n": 1}}, "l": []}', "[1]", '{"o": null}']
    df = spark.createDataFrame([(i, '{"function": "t", "arguments": %s}' % a) for i, a in enumerate(args)], "call_id long, call_json string")
    got = sorted(tuple(r) for r in VL.validate_calls(df, paths, tools=tools).collect())
    assert got == [
        (0, "wrong_type", "a.b"), (1, "missing_required", "o.deep"), (2, "missing_required", "o.deep.n"), (2, "wrong_type", "o.x[]"),
        (3, "over_maximum", "o.deep.n"), (3, "unknown_param", "a"), (3, "unknown_param", "o.deep.m"), (4, "wrong_type", "l[]"), (4, "wrong_type", "l[][]"), (7, "wrong_type", "o"),
    ]


def test_dates_as_text_and_in_any_session_zone(spark):
    from callcorpus.operators import tables as TB

    rows = [(1, "2024-05-01T00:30:00+02:00"), (2, "2024-05-01T23:30:00-02:00"), (3, "2024-05-01T12:00:00Z"), (4, "2024-05-01"), (5, "bad")]
    text = spark.createDataFrame(rows, "id long, created string")
    ids = lambda df: sorted(r.id for r in TB.memories_query(df, "created", "id", "2024-05-01", "2024-05-01T23:59:59").collect())
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert ids(text) == [3, 4]
            instants = text.filter("id < 4").select("id", F.to_timestamp("created").alias("created"))
            assert ids(instants) == [3]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_user_formatter_sees_python_values(spark):
    from callcorpus.operators import formatters as FM

    df = spark.createDataFrame([(1, None, "a"), (2, 5, "b"), (3, 6, "c")], "id long, n long, t string")

    def fn(row):
        if row["id"] == 3:
            return "not a dict"
        return {"text": f"{row['n']!r} {row['t']}"}

    got = {r.id: (r.text, r.reject_reason) for r in FM.python_row_formatter(df, fn).collect()}
    assert got == {1: ("None a", None), 2: ("5 b", None), 3: (None, "formatter_error")}


def test_calls_of_few_tools_stay_in_their_tasks(spark):
    tool = '{"name": "f", "parameters": {"properties": {"at": {"type": "object", "properties": {"lat": {"type": "number"}}, "required": ["lat"]}}}}'
    tools = spark.createDataFrame([("watch", "f", tool)], "device string, name string, tool_json string")
    calls = spark.createDataFrame([(i, "watch", '{"function": "f", "arguments": {"at": {"n": [%d, {}]}}}' % i) for i in range(40)], "call_id long, device string, call_json string").repartition(4)
    out = VL.validate_calls(calls, catalog.catalog_paths(tools), tools=tools, device_col="device")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "hashpartitioning(" in line and "_fn#" in line], plan
    got = sorted(tuple(r) for r in out.collect())
    assert got == sorted(x for i in range(40) for x in [(i, "missing_required", "at.lat"), (i, "unknown_param", "at.n")])
