"""Byte-exact sample, reject reasons, transcript rules."""

from pyspark.sql import functions as F

from callcorpus.operators import catalog, formatters as FM

# The logged formatted sample, rebuilt from a reconstructed input row.
SAMPLE_QUERY = "Where can I find live giveaways for beta access and games?"
SAMPLE_TOOLS = (
    '[{"name": "live_giveaways_by_type", "description": "Retrieve live giveaways from the GamerPower API based on the '
    'specified type.", "parameters": {"type": {"description": "The type of giveaways to retrieve (e.g., game, loot, '
    'beta).", "type": "str", "default": "game"}}}]'
)
SAMPLE_ANSWERS = (
    '[{"name": "live_giveaways_by_type", "arguments": {"type": "beta"}}, '
    '{"name": "live_giveaways_by_type", "arguments": {"type": "game"}}]'
)
SAMPLE_TEXT = (
    "<|im_start|>system\nYou are a helpful assistant with access to functions. Use them when appropriate.\n\n"
    "Available functions:\n- live_giveaways_by_type()\n  Retrieve live giveaways from the GamerPower API based on the "
    'specified type.\n\n\nOutput format: {"function": "function_name", "arguments": {...}}<|im_end|>\n'
    "<|im_start|>user\nWhere can I find live giveaways for beta access and games?<|im_end|>\n"
    '<|im_start|>assistant\n{"function": "live_giveaways_by_type", "arguments": {"type": "beta"}}<|im_end|>'
)


def _xlam(spark, rows):
    df = spark.createDataFrame(rows, "id long, query string, tools string, answers string")
    return {r.id: (r.text, r.reject_reason) for r in FM.xlam_format(df).collect()}


def test_sample_byte_for_byte(spark):
    out = _xlam(spark, [(1, SAMPLE_QUERY, SAMPLE_TOOLS, SAMPLE_ANSWERS)])
    assert out[1] == (SAMPLE_TEXT, None)


def test_flat_params_opt_in(spark):
    df = spark.createDataFrame([(1, SAMPLE_QUERY, SAMPLE_TOOLS, SAMPLE_ANSWERS)], "id long, query string, tools string, answers string")
    text = FM.xlam_format(df, flat_params=True).first().text
    assert "- live_giveaways_by_type(type?: str)\n" in text


def test_reject_reasons(spark):
    ok_tools = '[{"name": "f", "description": "d", "parameters": {"properties": {"p": {"type": "string"}}, "required": ["p"]}}]'
    call = '[{"name": "f", "arguments": {"p": "x"}}]'
    rows = [
        (1, "q", ok_tools, "[]"),
        (2, "q", ok_tools, "{}"),
        (3, "q", ok_tools, "bad"),
        (4, "q", ok_tools, ""),
        (5, "q", '[{"name": "f", "description": "d", "parameters": {"properties": {"p": "string"}}}]', call),
        (6, "", ok_tools, call),
        (7, "q", ok_tools, '["f"]'),
        (8, "q", "[]", call),
        (9, "q", "not json", call),
    ]
    out = _xlam(spark, rows)
    assert [out[i][1] for i in range(1, 10)] == [
        "no_call", "no_call", "answers_unparseable", "answers_unparseable", "tools_malformed", "no_query",
        "call_not_object", None, None,
    ]
    # empty or unparseable tools render as no tool text at all
    assert "Available functions" not in out[8][0] and "Available functions" not in out[9][0]


def test_key_fallbacks(spark):
    df = spark.createDataFrame([(1, "hi", None, '{"function": "g", "parameters": {"x": 1}}')], "id long, instruction string, tools string, answer string")
    row = FM.xlam_format(df).first()
    assert row.text.endswith('{"function": "g", "arguments": {"x": 1}}<|im_end|>')


def test_render_tools_strict_header_with_zero_tools(spark):
    df = spark.createDataFrame([("[]",)], "t string")
    lenient = df.select(catalog.render_tools("t")["text"].alias("x")).first().x
    strict = df.select(catalog.render_tools("t", strict=True)["text"].alias("x")).first().x
    assert lenient == "" and strict == catalog.TOOLS_HEADER


def test_glaive_rules(spark):
    chat = "preamble line\nUSER: hello\n continued \n\n USER: indented\nASSISTANT: hi there\nmore\n<|endoftext|>"
    df = spark.createDataFrame([(None, chat), ("sys", "")], "system string, chat string")
    got = [r.text for r in df.select(FM.glaive_text("system", "chat").alias("text")).collect()]
    assert got[0] == (
        "<|im_start|>system\nYou are a helpful assistant.<|im_end|>\n"
        "<|im_start|>user\nhello\ncontinued\nUSER: indented<|im_end|>\n<|im_start|>assistant\nhi there\nmore<|im_end|>"
    )
    assert got[1] == "<|im_start|>system\nsys<|im_end|>\n"


def test_hermes_rules(spark):
    df = spark.createDataFrame(
        [([{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}, {"from": "tool", "value": None}],), ([],)],
        "conversations array<struct<from:string,value:string>>",
    )
    got = [r.text for r in df.select(FM.hermes_text("conversations").alias("text")).collect()]
    assert got == ["<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb<|im_end|>\n<|im_start|>tool\n<|im_end|>", ""]
    assert FM.drop_failed(df.select(FM.hermes_text("conversations").alias("text"), F.lit(None).cast("string").alias("reject_reason"))).count() == 2


def test_registry():
    import pytest

    assert FM.get_formatter("org/xlam-style-calls") is FM.xlam_format
    with pytest.raises(ValueError):
        FM.get_formatter("glaive-function-calling-v2")
    assert FM.get_formatter("glaive-function-calling-v2", include_disabled=True) is FM.glaive_format


def test_python_row_formatter_x1(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "boom")], "id long, q string")

    def fmt(row):
        if row["q"] == "boom":
            raise ValueError("bad row")
        return {"text": f"<{row['q']}>"} if row["q"] else None

    out = {r.id: (r.text, r.reject_reason) for r in FM.python_row_formatter(df, fmt).collect()}
    assert out == {1: ("<a>", None), 2: (None, "formatter_none"), 3: (None, "formatter_error")}


def test_prompts(spark):
    df = spark.createDataFrame([("hang up",)], "c string")
    plain = df.select(FM.eval_prompt("c").alias("p")).first().p
    assert plain.startswith("Convert the following voice command into a JSON function call.")
    assert '\nCommand: "hang up"\n' in plain and plain.endswith("JSON:") and "- check_battery() - Check battery level\n" in plain
    cat = df.select(FM.eval_prompt("c", "- f(x: string)\n  d", "Test Device Backend").alias("p")).first().p
    assert cat.startswith("You are a function-calling assistant for Test Device Backend.\n\nAvailable functions:\n- f(x: string)\n  d\n\n")
    gen = df.select(FM.generation_prompt("c", F.lit("")).alias("p")).first().p
    assert gen.endswith("<|im_start|>user\nhang up<|im_end|>\n<|im_start|>assistant\n")
    assert FM.chat_system_prompt(None) == "You are a helpful assistant."
    assert FM.chat_system_prompt("- f()\n  d") == (
        "You are a helpful assistant with access to functions. Use them when appropriate.\n\nAvailable functions:\n"
        '- f()\n  d\n\nOutput format: {"function": "function_name", "arguments": {...}}'
    )


def test_settings_merge():
    from callcorpus.plans.jobs import resolve_setting

    assert resolve_setting(None, {"max_new_tokens": 100}, "max_new_tokens", 50) == 100
    assert resolve_setting(0, {}, "max_new_tokens", 100) == 100
    assert resolve_setting("cpu", {"device": "auto"}, "device", "auto") == "cpu"


def test_catalog_text_zero_tools(spark):
    empty = spark.createDataFrame([], "ord int, tool_json string")
    assert catalog.catalog_text(empty) == catalog.TOOLS_HEADER
    assert catalog.catalog_text(empty, single=True) == ""


def test_calls_are_read_once_in_python_batches(spark):
    df = spark.createDataFrame([(1, SAMPLE_QUERY, SAMPLE_TOOLS, SAMPLE_ANSWERS)], "id long, query string, tools string, answers string")
    formatted = FM.xlam_format(df)
    for out in (FM.drop_failed(formatted).select("id", "text"), FM.rejects(formatted), FM.reject_counts(formatted)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1 and "parse_json" not in plan, plan


def test_awkward_tools_and_answers(spark):
    call = '[{"name": "f", "arguments": {"p": "x"}}]'

    def tool(parameters):
        return '[{"name": "f", "description": null, "parameters": ' + parameters + "}]"

    cases = [
        (tool('{"properties": {"b": {"type": ["string", null]}, "a": {}}, "required": "ab"}'), call, "- f(b: [\"string\", null], a: string)\n  None\n"),
        (tool('{"properties": {"a": {"type": 1.50}}, "required": {"a": 0}}'), call, "- f(a: 1.5)\n  None\n"),
        (tool('{"properties": {}, "required": 7}'), call, "- f()\n  None\n"),
        (tool('{"properties": {"a": {}}, "required": 7}'), call, "tools_malformed"),
        (tool('{"properties": null}'), call, "tools_malformed"),
        (tool("null"), call, "tools_malformed"),
        ('{"name": "f"}', call, "tools_malformed"),
        ('[{"name": "f", "name": "g"}]', call, None),
        ('[{"name": NaN}]', call, None),
        (None, call, None),
        ("[]", '[{"name": "f", "name": "g"}]', "answers_unparseable"),
        ("[]", '{"name": "f", "arguments": Infinity}', "answers_unparseable"),
        ("[]", "[[]]", "no_call"),
        ("[]", "-0.0", "no_call"),
        ("[]", None, "no_call"),
        ("[]", '"f"', "call_not_object"),
        ('[{"name": "\\ud800", "description": ""}]', call, "- ?()\n  \n"),
    ]
    out = _xlam(spark, [(i, "q", tools, answers) for i, (tools, answers, _) in enumerate(cases)])
    for i, (tools, answers, want) in enumerate(cases):
        text, why = out[i]
        if want is None:
            assert why is None and "Available functions" not in text, (tools, text, why)
        elif want.startswith("- "):
            assert why is None and f"Available functions:\n{want}\n\nOutput" in text, (tools, text, why)
        else:
            assert (text, why) == (None, want), (tools, answers, text, why)
