"""J1 / J2 / strict validity against Python's json module (FIXTURES section 3)."""

import json
import random

from callcorpus.functions import jsonx as J


def _one(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r.o for r in df.select("i", fn("s").alias("o")).orderBy("i").collect()]


def test_first_object_fixture_rows(spark):
    rows = ["no braces", '{"a":1', 'x {"f":{"g":"}"}} {"h":1}', 'pre {bad} {"ok":1}', "{'a':1}", '{"a": "x\\"}y"} tail']
    got = _one(spark, J.first_object, rows)
    assert got == [None, None, '{"f":{"g":"}"}}', None, None, '{"a": "x\\"}y"}']


def test_first_object_duplicate_keys_documented_deviation(spark):
    # Python keeps the last value; the native path rejects duplicate keys.
    assert _one(spark, J.first_object, ['{"a":1,"a":2}']) == [None]


def _spelled(rng, depth=0):
    """JSON text with repeated keys, literals beyond JSON, and numbers spelled in several ways."""
    kind = rng.randrange(7 if depth < 3 else 5)
    if kind == 0:
        return rng.choice(["0", "-0", "1", "1.0", "1e0", "10E-1", "true", "false", "0.0", "null", "0.1", "0.10", "1e-1", "5e-324"])
    if kind == 1:
        return rng.choice(["1e16", "10000000000000000", "1e22", "10000000000000000000000", "1e23", "99999999999999991611392", "9223372036854775807",
                           "9223372036854775808", "9223372036854775807.0", "-9223372036854775808", "1e300", str(int(1e300)), "1.7976931348623157e308"])
    if kind == 2:
        return rng.choice(["NaN", "Infinity", "-Infinity", "1e999", "-1e999"])
    if kind == 3:
        return json.dumps(rng.choice(["", "a", "é", "q\"", "{", "NaN", "😀", "\n"]), ensure_ascii=rng.random() < 0.5)
    if kind == 4:
        return str(rng.randrange(-3, 3))
    if kind == 5:
        return "[" + ", ".join(_spelled(rng, depth + 1) for _ in range(rng.randrange(3))) + "]"
    keys = rng.choices(['"a"', '"\\u0061"', '"a!"', '"b"', '"😀"', '"\\uffee"', '""'], k=rng.randrange(4))
    return "{" + " , ".join(f"{k}:{_spelled(rng, depth + 1)}" for k in keys) + "}"


def test_object_fields_are_equal_when_python_says_so(spark):
    rng = random.Random(11)
    pairs = [(_spelled(rng, 2), _spelled(rng, 2)) for _ in range(1500)] + [(t, t) for t in (_spelled(rng) for _ in range(150))]
    df = spark.createDataFrame([(i, f'x {{"v": {a}}} }}', f' {{"v": {b}}}\n') for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    got = df.select("i", J.equality_form(J.object_fields("a", "v")["v"]).alias("x"), J.equality_form(J.object_fields("b", "v", whole=True)["v"]).alias("y")).orderBy("i").collect()
    equal = 0
    for (a, b), r in zip(pairs, got):
        want = [json.loads(a)] == [json.loads(b)]  # within a container NaN is the same as itself
        equal += want
        assert (r.x is not None and r.x == r.y) == want, (a, b, r)
    assert 150 < equal < 1000


def test_object_fields_reject_what_python_rejects(spark):
    broken = ['{"a": 1, "a": }', '{"a": NaN, }', "{NaN: 1}", '{"a": nan, "a": 1}', '{"a": 01, "a": 1}', '{"a" "a": 1}', '{"a": 1 "a": 1}', '{"a": "\n", "a": 1}', '{"a": +1}', "{'a': 1}", '{"a": [}', "{", "", "NaN"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(broken)], "i int, s string")
    assert [s for s, r in zip(broken, df.select("i", J.object_fields("s", "a").alias("o")).orderBy("i").collect()) if r.o is not None] == []


def _py_loads_ok(s):
    try:
        json.loads(s)
        return True
    except Exception:
        return False


def test_loads_ok_matches_python(spark):
    cases = ['{"a":1}', '{"a":1} x', "[1,2]]", " [1] ", "", "5 x", '"s"', "12", "{'a':1}", '{"a":01}',
             '{"a":1}, {"b":2}', '{"a":1}} x', '{"a":1}] ["x"', "true", "nul", '{"a":"x\ny"}', "[]", "{}"]
    got = _one(spark, J.json_loads_ok, cases)
    assert got == [_py_loads_ok(c) for c in cases]


def _random_value(rng, depth=0):
    kind = rng.randrange(8 if depth < 3 else 5)
    if kind == 0:
        return rng.randrange(-10**6, 10**6)
    if kind == 1:
        return rng.choice([0.5, -2.25, 1.1, 1e-7, 12345678.9, 1e16, 3.0, 100.0, 0.0001])
    if kind == 2:
        return rng.choice(["a", "é", "x,y:z", 'q"uote', "tab\t", "😀", "back\\slash", "", "/"])
    if kind == 3:
        return rng.choice([True, False])
    if kind == 4:
        return None
    if kind == 5:
        return [_random_value(rng, depth + 1) for _ in range(rng.randrange(4))]
    keys = rng.sample(["z", "a", "m", "k", "b c", "é"], rng.randrange(4))
    return {k: _random_value(rng, depth + 1) for k in keys}


def test_py_dumps_matches_python_randomized(spark):
    rng = random.Random(7)
    docs = [{"arguments": _random_value(rng, 1)} for _ in range(300)]
    texts = [json.dumps(d, separators=(",", ":"), ensure_ascii=False) for d in docs]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    got = [r.o for r in df.select("i", J.py_dumps_at("s", "$.arguments").alias("o")).orderBy("i").collect()]
    want = [json.dumps(d["arguments"]) for d in docs]
    assert got == want


def test_canonical_ignores_key_order_and_int_float(spark):
    df = spark.createDataFrame([('{"b":1,"a":2}', '{"a":2,"b":1.0}'), ('{"level":"50"}', '{"level":50}')], "x string, y string")
    rows = df.select((J.canonical_at("x") == J.canonical_at("y")).alias("eq")).collect()
    assert [r.eq for r in rows] == [True, False]


def test_first_object_value_agrees_with_scan(spark):
    rows = ["no braces", '{"a":1', 'x {"f":{"g":"}"}} {"h":1}', 'pre {bad} {"ok":1}', "{'a':1}", '{"a": "x\\"}y"} tail',
            'a {"a":1}} b', '{"a":[1,{"b":"}"}]}x', '{"a":01}', "{}", '{"a":"\\u00e9"} {']
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, s string")
    got = df.select("i", J.first_object("s").alias("scan"), J.first_object_value("s").alias("fast")).orderBy("i").collect()
    for r in got:
        assert (r.scan is None) == (r.fast is None), rows[r.i]
        if r.scan is not None:
            assert json.loads(r.scan) == json.loads(r.fast.text)
