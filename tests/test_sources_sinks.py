"""Readers (S2-S6), sinks (K2-K4) and J8 over hand-written files."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from callcorpus.functions import segments as SG
from callcorpus.operators import catalog
from callcorpus.plans import jobs
from callcorpus.sources import readers


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def test_read_eval_cases(spark):
    d = tempfile.mkdtemp()
    lines = [
        {"command": "dim the lamp", "expected_output": {"function": "dim", "arguments": {}}},
        {"command": "heat to 19", "expected_output": {"function": "heat", "arguments": {"level": 19}}},
    ]
    p = _write(os.path.join(d, "cases.jsonl"), "\n".join(json.dumps(x) for x in lines) + "\n")
    rows = readers.read_eval_cases(spark, p).orderBy("example_id").collect()
    assert [r.command for r in rows] == ["dim the lamp", "heat to 19"]
    assert [json.loads(r.expected) for r in rows] == [x["expected_output"] for x in lines]
    bad = _write(os.path.join(d, "bad.jsonl"), json.dumps(lines[0]) + "\nnot json\n")
    import pytest

    with pytest.raises(ValueError):
        readers.read_eval_cases(spark, bad)
    assert readers.read_eval_cases(spark, bad, mode="PERMISSIVE").filter("bad_line").count() == 1


def test_read_training_splits(spark):
    d = tempfile.mkdtemp()
    _write(os.path.join(d, "a_train.jsonl"), '{"text": "t1"}\n{"text": "t2"}\n')
    _write(os.path.join(d, "b_train.jsonl"), '{"text": "t3"}\n')
    _write(os.path.join(d, "a_val.jsonl"), '{"text": "v1"}\n')
    counts = {r.split: r["count"] for r in readers.read_training_splits(spark, d).groupBy("split").count().collect()}
    assert counts == {"train": 3, "validation": 1}
    both = readers.read_training_files(spark, os.path.join(d, "a_train.jsonl"), os.path.join(d, "a_val.jsonl"))
    assert both.count() == 3


def test_read_tool_catalog_and_params(spark):
    d = tempfile.mkdtemp()
    doc = {
        "device": "Test Device",
        "version": "1.0",
        "description": "x",
        "tools": [
            {"name": "get_items", "description": "List items", "parameters": {"type": "object", "properties": {
                "limit": {"type": "integer", "description": "n", "default": 20, "maximum": 500},
                "completed": {"type": "boolean", "description": "state"}}, "required": []}},
            {"name": "make_item", "description": "Create", "parameters": {"type": "object", "properties": {
                "description": {"type": "string", "description": "d"}}, "required": ["description"]}},
        ],
    }
    p = _write(os.path.join(d, "catalog.json"), json.dumps(doc, indent=2))
    cat = readers.read_tool_catalog(spark, p)
    tools = catalog.catalog_tools(cat)
    assert [r.name for r in tools.orderBy("ord").collect()] == ["get_items", "make_item"]
    params = {(r.tool, r.param): (r.type, r.default_json, r.maximum, r.required, r.ord) for r in catalog.catalog_params(tools).collect()}
    assert params[("get_items", "limit")] == ("integer", "20", 500, False, 0)
    assert params[("get_items", "completed")] == ("boolean", None, None, False, 1)
    assert params[("make_item", "description")] == ("string", None, None, True, 0)
    single = catalog.catalog_text(tools.select("ord", "tool_json"), strict=True, single=True)
    assert single == "- get_items(limit?: integer, completed?: boolean)\n  List items\n- make_item(description: string)\n  Create"
    full = catalog.catalog_text(tools.select("ord", "tool_json"), strict=True)
    assert full == catalog.TOOLS_HEADER + single + "\n"


def test_read_models_config(spark):
    d = tempfile.mkdtemp()
    cfg = {"models": [{"name": "A", "model_id": "org/a", "description": "", "enabled": True},
                      {"name": "B", "model_id": "org/b", "description": "", "enabled": False}],
           "default_settings": {"device": "auto", "max_new_tokens": 100, "temperature": 0.1, "do_sample": False}}
    p = _write(os.path.join(d, "models.json"), json.dumps(cfg, indent=2))
    models, settings = readers.read_models_config(spark, p)
    assert [(r.ord, r.name, r.enabled) for r in models.orderBy("ord").collect()] == [(0, "A", True), (1, "B", False)]
    assert settings.first().max_new_tokens == 100


def test_evaluate_job_writes_reports(spark):
    cases = spark.createDataFrame([(0, "c0", '{"function": "f", "arguments": {}}'), (1, "c1", '{"function": "g", "arguments": {"x": 1}}')],
                                  "example_id long, command string, expected string")
    preds = spark.createDataFrame([("org/m a", 0, '{"function": "f", "arguments": {}}'), ("org/m a", 1, "nope"),
                                   ("b", 0, "{}"), ("b", 1, '{"function": "g", "arguments": {"x": 1.0}}')],
                                  "model_name string, example_id long, raw_output string")
    out = tempfile.mkdtemp()
    ev = jobs.evaluate(cases, preds, ["org/m a", "b"], dataset="d.jsonl", run_ts="2026-01-01T00:00:00", output_dir=out)
    board = {r.model_name: (r.total, r.exact_match) for r in ev.board.collect()}
    assert board == {"org/m a": (2, 1), "b": (2, 1)}
    assert {"model_safe=b", "model_safe=org_m_a"} <= set(os.listdir(os.path.join(out, "results", "run=2026_01_01T00_00_00")))
    doc = spark.read.json(os.path.join(out, "summary")).first()
    assert doc.total_models == 2 and {s.accuracy for s in doc.summary} == {"50.0%"}


def test_unpack_teacher_job(spark):
    replies = spark.createDataFrame(
        [(0, '```json\n[{"query": "q0", "tool": "t", "arguments": {"a": 1}}, {"query": "q1", "arguments": {}}]\n```'),
         (1, '{"data": [{"query": "q2", "tool": "t", "arguments": {}}]}'), (2, "{broken")],
        "batch_id long, content string",
    )
    examples, yld = jobs.unpack_teacher(replies, catalog.TOOLS_HEADER, per_batch=2)
    assert examples.count() == 2
    assert {r.batch_id: (r.status, r.obtained) for r in yld.collect()} == {0: ("ok", 1), 1: ("ok", 1), 2: ("invalid_json", 0)}
    first = examples.orderBy("batch_id").first().text
    assert first.endswith('<|im_start|>assistant\n{"function": "t", "arguments": {"a": 1}}<|im_end|>')


def test_chat_response_unpack(spark):
    bodies = ['{"choices": [{"message": {"content": "{\\"function\\": \\"f\\"}"}}]}', '{"error": "timeout"}', '{"x": 1}']
    df = spark.createDataFrame([(b,) for b in bodies], "b string")
    rows = [(r.s.status, r.s.content) for r in df.select(SG.chat_response_content("b").alias("s")).collect()]
    assert rows == [("ok", '{"function": "f"}'), ("error", "timeout"), ("unexpected", None)]


def test_teacher_replies_reader_and_reject_sample(spark):
    from callcorpus.operators import formatters as FM

    d = tempfile.mkdtemp()
    _write(os.path.join(d, "b0.jsonl"), json.dumps({"batch_id": 0, "content": "[]"}) + "\n")
    _write(os.path.join(d, "b1.jsonl"), json.dumps({"batch_id": 1, "content": "```json\n[]\n```"}) + "\n")
    assert sorted(r.batch_id for r in readers.read_teacher_replies(spark, d).collect()) == [0, 1]
    rows = spark.createDataFrame([(i, "q", "[]", "bad") for i in range(5)], "id long, query string, tools string, answers string")
    sample = FM.reject_sample(FM.xlam_format(rows)).collect()
    assert [(r.id, r.reject_reason) for r in sample] == [(0, "answers_unparseable"), (1, "answers_unparseable"), (2, "answers_unparseable")]


def test_validate_extracted_calls(spark):
    cases = spark.createDataFrame([(0, "c", '{"function": "make_item", "arguments": {"description": "x"}}')], "example_id long, command string, expected string")
    preds = spark.createDataFrame([("m", 0, 'Sure {"function": "make_item", "arguments": {"due": 1}} done')], "model_name string, example_id long, raw_output string")
    ev = jobs.evaluate(cases, preds, ["m"])
    tool = '{"name": "make_item", "description": "Create", "parameters": {"type": "object", "properties": {"description": {"type": "string"}}, "required": ["description"]}}'
    tools = spark.createDataFrame([("d", 0, "make_item", "Create", tool)], "device string, ord int, name string, description string, tool_json string")
    calls = ev.details.select(ev.details.example_id.alias("call_id"), ev.details.predicted.alias("call_json"))
    from callcorpus.operators import validate

    got = sorted((r.violation, r.param) for r in validate.validate_calls(calls, catalog.catalog_params(tools)).collect())
    assert got == [("missing_required", "description"), ("unknown_param", "due")]


def test_summary_only_when_not_exactly_one_model(spark):
    cases = spark.createDataFrame([(0, "c", '{"function": "f", "arguments": {}}')], "example_id long, command string, expected string")
    preds = spark.createDataFrame([("a", 0, '{"function": "f", "arguments": {}}')], "model_name string, example_id long, raw_output string")
    one = tempfile.mkdtemp()
    jobs.evaluate(cases, preds, ["a", "b"], failed=["b"], output_dir=one)
    assert not os.path.exists(os.path.join(one, "summary"))
    two = tempfile.mkdtemp()
    jobs.evaluate(cases, preds, ["a", "b"], output_dir=two)
    assert os.path.exists(os.path.join(two, "summary"))


def test_read_dataset_splits(spark):
    d = tempfile.mkdtemp()
    df = spark.createDataFrame([(1, "train"), (2, "train"), (3, "test")], "id long, split string")
    df.write.mode("overwrite").partitionBy("split").parquet(os.path.join(d, "by_col"))
    df.filter("split = 'test'").drop("split").write.mode("overwrite").parquet(os.path.join(d, "by_dir", "test"))
    assert readers.read_dataset(spark, os.path.join(d, "by_col"), split="train").count() == 2
    assert readers.read_dataset(spark, os.path.join(d, "by_dir"), split="test", split_layout="subdir").count() == 1


def test_write_splits_round_trip(spark):
    from callcorpus.sources import sinks

    df = spark.createDataFrame([("a", "train"), ("b", "val"), ("c", "train")], "text string, split string")
    d = tempfile.mkdtemp()
    assert sinks.write_splits(df, d, "org/name-x").endswith("org_name_x")
    back = readers.read_training_splits(spark, d)
    assert sorted((r.text, r.split) for r in back.collect()) == [("a", "train"), ("b", "validation"), ("c", "train")]
    pp = sinks.write_splits(df, d + "/pq", "org/name-x", fmt="parquet")
    assert sorted(r.text for r in spark.read.parquet(pp + "_train.parquet").collect()) == ["a", "c"]


def test_runs_keep_each_other(spark):
    from callcorpus.sources import sinks

    d = tempfile.mkdtemp()
    for ts, model in (("2031-01-01T00:00:00", "org/m 1"), ("2031-01-02T00:00:00", "m2")):
        rows = spark.createDataFrame([(model, 1)], "model_name string, n int")
        sinks.write_model_results(rows, rows, d, ts)
        sinks.write_summary(rows, d, ts)
    assert {r.model_name for r in spark.read.json(f"{d}/details").collect()} == {"org/m 1", "m2"}
    assert spark.read.json(f"{d}/summary").count() == 2


def test_case_positions_do_not_depend_on_the_splits(spark):
    d = tempfile.mkdtemp()
    n = 0
    for name, count in (("a.jsonl", 1), ("b.jsonl", 300), ("c.jsonl", 7)):
        _write(os.path.join(d, name), "".join(json.dumps({"command": f"c{n + i}", "expected_output": {}}) + "\n" for i in range(count)))
        n += count
    for size in ("128m", "4k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            got = {r.example_id: r.command for r in readers.read_eval_cases(spark, d).collect()}
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert got == {i: f"c{i}" for i in range(n)}


def test_catalog_params_odd_names(spark):
    tool = ('{"name": "t", "description": "d", "parameters": {"properties": {"it\'s": {"type": "integer", "default": 3, "maximum": 9}, '
            '"a.b": {"type": "string"}}, "required": ["a.b"]}}')
    tools = spark.createDataFrame([("d", 0, "t", "d", tool)], "device string, ord int, name string, description string, tool_json string")
    got = {r.param: (r.type, r.default_json, r.maximum, r.required, r.ord) for r in catalog.catalog_params(tools).collect()}
    assert got == {"it's": ("integer", "3", 9, False, 0), "a.b": ("string", None, None, True, 1)}


def test_run_log_metrics_from_text_file(spark):
    from callcorpus.operators import runlogs

    d = tempfile.mkdtemp()
    lines = [
        "Reading rows: 100%|#####| 70/70",
        "{'loss': 0.75, 'grad_norm': 0.5, 'learning_rate': 0.001, 'epoch': 0.1}",
        "{'eval_loss': 0.7, 'eval_runtime': 3.5, 'eval_samples_per_second': 10.0, 'eval_steps_per_second': 2.0, 'epoch': 0.5}",
        "{'loss': 0.25, 'grad_norm': 0.125, 'learning_rate': 2.5e-05, 'epoch': 1.9}",
        "{'eval_loss': 0.375, 'eval_runtime': 3.25, 'eval_samples_per_second': 11.0, 'eval_steps_per_second': 2.5, 'epoch': 2.0}",
        "{'train_runtime': 99.5, 'train_samples_per_second': 8.0, 'train_steps_per_second': 1.0, 'train_loss': 0.5, 'epoch': 2.0}",
    ]
    p = _write(os.path.join(d, "run.log"), "\n".join(lines) + "\n")
    m = runlogs.parse_metric_lines(spark.read.text(p))
    kinds = sorted(r.kind for r in m.collect())
    assert kinds == ["eval", "eval", "loss", "loss", "train_summary"]
    best = runlogs.best_eval(m).first()
    assert (best.best_eval_loss, best.best_epoch) == (0.375, 2.0)
    assert m.filter("kind = 'loss'").agg(F.min("learning_rate")).first()[0] == 2.5e-05


def test_eval_report_from_text_file(spark):
    from callcorpus.operators import runlogs

    d = tempfile.mkdtemp()
    report = (
        "Evaluating m1 on 3 examples...\n"
        "✓ [1/3] dim the lamp\n"
        "✗ [2/3] open the door\n"
        '  Expected:  {"function": "open_door", "arguments": {}}\n'
        '  Predicted: {"function": "open_door", "arguments": {"width": 10}}\n'
        '  Raw:       {"function": "open_door", "arguments": {"width": 10}} And then...\n'
        "\n"
        "✓ [3/3] close it\n"
    )
    p = _write(os.path.join(d, "report.txt"), report)
    rows = runlogs.parse_eval_report(spark.read.text(p, wholetext=True)).orderBy("position").collect()
    assert [(r.position, r.total, r.passed) for r in rows] == [(1, 3, True), (2, 3, False), (3, 3, True)]
    assert rows[1].predicted == '{"function": "open_door", "arguments": {"width": 10}}'
    assert rows[1].raw_preview == '{"function": "open_door", "arguments": {"width": 10}} And then'
    assert rows[0].expected is None


def test_read_eval_cases_strips_lines(spark):
    d = tempfile.mkdtemp()
    p = _write(os.path.join(d, "c.jsonl"), '\u3000 {"command": "a", "expected_output": {"function": "f", "arguments": {}}}  \n')
    rows = readers.read_eval_cases(spark, p).collect()
    assert [r.command for r in rows] == ["a"]


def test_tasks_grow_in_number_with_the_rows(spark, tmp_path):
    from callcorpus.sources.readers import read_table

    spark.range(5000).coalesce(1).write.parquet(str(tmp_path / "t"))
    table = read_table(spark, str(tmp_path / "t"), task_rows=100)
    assert table.rdd.getNumPartitions() == 50 and table.count() == 5000
