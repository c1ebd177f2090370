"""Counted-range selection: key order, k-th rows, exact cuts, pages, positions."""

import datetime as dt
import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from callcorpus.operators import selection as SEL, split as SP

SPANS = {
    "long": [None, -(2**63), -5, -1, 0, 1, 7, 2**31, 2**63 - 1],
    "int": [None, -(2**31), -1, 0, 3, 2**31 - 1],
    "boolean": [None, False, True],
    "string": [None, "", "\x00", "a", "a\x00", "aa", "ab", "b", "é", "日本", "\U0001f600", "A" * 50, "A" * 50 + "!"],
    "binary": [None, b"", b"\x00", b"\x00\x01", b"\xff", b"a"],
    "double": [None, float("-inf"), -1e300, -2.5, -1e-300, -0.0, 0.0, 5e-324, 1e-300, 0.1, 0.1 + 1e-16, 1.0, 123456789.125, 1e22, float("inf"), float("nan")],
    "float": [None, -1.5, 0.0, 0.25, 3.4e38],
    "decimal(38,6)": [None, Decimal("-99999999999999999999.000001"), Decimal("-0.000001"), Decimal(0), Decimal("0.5"), Decimal("12"), Decimal("99999999999999999999999999999999.999999")],
    "date": [None, dt.date(1, 1, 1), dt.date(1969, 12, 31), dt.date(1970, 1, 1), dt.date(9999, 12, 31)],
    "timestamp": [None, dt.datetime(1960, 1, 1), dt.datetime(2024, 3, 31, 2, 30, 0, 1), dt.datetime(2024, 3, 31, 2, 30, 0, 2)],
    "timestamp_ntz": [None, dt.datetime(1900, 1, 1), dt.datetime(2024, 3, 31, 2, 30), dt.datetime(2024, 10, 27, 2, 30)],
}


@pytest.mark.parametrize("kind", sorted(SPANS))
def test_order_key_orders_like_spark(spark, kind):
    values = SPANS[kind]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    for way in (SEL.Key("v"), SEL.desc("v"), SEL.Key("v", True, nulls_first=True)):
        first = (not way.desc) if way.nulls_first is None else way.nulls_first
        order = {(0, 0): F.col("v").asc_nulls_last(), (0, 1): F.col("v").asc_nulls_first(), (1, 0): F.col("v").desc_nulls_last(), (1, 1): F.col("v").desc_nulls_first()}[way.desc, first]
        want = [r.v for r in df.orderBy(order, "i").collect()]
        got = [r.v for r in df.orderBy(SEL.order_key(df, [way]), "i").collect()]
        assert list(map(repr, got)) == list(map(repr, want)), way


def table(spark, n, seed=1):
    rng = random.Random(seed)
    texts = ["https://example.org/a/very/long/common/path/" + c for c in ("x", "xy", "y", "é", "")]
    return spark.createDataFrame(
        [(i, rng.choice([None, *texts]), rng.choice([None, -1.5, 0.0, 2.0, float("nan")]), dt.datetime(2024, 1, 1) + dt.timedelta(hours=rng.randrange(50))) for i in range(n)],
        "id long, name string, price double, at timestamp_ntz",
    )


ORDERS = [["id"], [SEL.desc("id")], ["name", SEL.desc("id")], [SEL.desc("name"), "price", "id"], [SEL.desc("at"), "name", "id"], ["price", SEL.desc("at"), "id"]]


def sorted_ids(df, order):
    return [r.id for r in df.orderBy(*[F.col(k) if isinstance(k, str) else F.col(k.col).desc() for k in order]).collect()]


@pytest.mark.parametrize("order", ORDERS[3:], ids=str)
def test_pages_at_any_depth(spark, order, monkeypatch):
    monkeypatch.setattr(SEL, "SMALL", 100)  # several counting passes
    df = table(spark, 2000).repartition(5).cache()
    want = sorted_ids(df, order)
    for offset, limit in [(0, 7), (1234, 10), (1990, 500)]:
        assert [r.id for r in SEL.page(df, order, offset, limit).collect()] == want[offset : offset + limit]


def test_pages_partition_ties(spark, monkeypatch):
    """Pages over a key that many rows share, and over rows equal in every column."""
    monkeypatch.setattr(SEL, "SMALL", 3)
    df = spark.createDataFrame([(i % 3, i % 4) for i in range(40)] + [(1, 99)] * 20, "k int, v int").cache()
    pages = [[tuple(r) for r in SEL.page(df, ["k"], at, 11).collect()] for at in range(0, 66, 11)]
    assert [len(p) for p in pages] == [11] * 5 + [5]
    assert Counter(r for p in pages for r in p) == Counter(tuple(r) for r in df.collect())
    assert [r[0] for p in pages for r in p] == sorted(r[0] for p in pages for r in p)


def test_splits_are_exact_with_ties_nulls_and_nan(spark):
    rows = [(None, "a")] * 300 + [(1.0, "a")] * 500 + [(float("nan"), "b")] * 90 + [(2.0, None)] * 110
    df = spark.createDataFrame(rows, "x double, y string")
    for keys in (["x"], [SEL.desc("y"), "x"]):
        out = SP.ordered_split(df, keys, 0.5)
        got = {(r.x if r.x == r.x else "nan", r.y, r.split): r.n for r in out.groupBy("x", "y", "split").agg(F.count(F.lit(1)).alias("n")).collect()}
        assert sum(n for (_, _, s), n in got.items() if s == "train") == 500
        assert out.count() == 1000
    assert SP.ordered_split(df, ["x"], 0.5).filter("split = 'train' AND x IS NULL").count() == 300


def test_split_of_equal_rows(spark):
    df = spark.createDataFrame([(7, "same")] * 25_003, "k int, v string")
    out = SP.ordered_split(df, ["k"], 0.95)
    assert {r.split: r.n for r in SP.split_counts(out).collect()} == {"train": int(25_003 * 0.95), "val": 25_003 - int(25_003 * 0.95)}
    assert SP.hash_split(df, "k").filter("split = 'val'").count() == 1251


def test_head(spark):
    df = table(spark, 500)
    assert {r.id for r in SP.head(df, [SEL.desc("name"), "id"], 77).collect()} == set(sorted_ids(df, [SEL.desc("name"), "id"])[:77])
    assert SP.head(df, ["id"], 0).count() == SP.head(df, ["id"], None).count() == SP.head(df, ["id"], 9999).count() == 500
    assert SP.head(df.limit(0), ["id"], 5).count() == 0


def test_positions(spark, monkeypatch):
    monkeypatch.setattr(SEL, "RANGE_ROWS", 200)
    df = table(spark, 1500).cache()
    for order in ORDERS[2:4]:
        got = sorted((r.p, r.id, r.n) for r in SEL.positions(df, order, "p", "n").collect())
        assert got == [(i, x, 1500) for i, x in enumerate(sorted_ids(df, order))]
    assert SEL.positions(df.limit(0), ["id"], "p", "n").count() == 0
    assert [r.p for r in SEL.positions(spark.createDataFrame([(3,)] * 300, "id long"), ["id"], "p").orderBy("p").collect()] == list(range(300))


def test_scans_are_narrowed(spark, tmp_path):
    table(spark, 3000).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = SEL.page(df, [SEL.desc("at"), "id"], 2000, 20)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "GreaterThanOrEqual(at" in plan and "LessThanOrEqual(at" in plan
    assert "RDDScan" not in plan and "ExistingRDD" not in plan


def test_descending_column_is_refused(spark):
    with pytest.raises(TypeError):
        SEL.page(table(spark, 5), [F.col("id").desc()], 0, 1)


def test_texts_are_made_for_a_span_only(spark, monkeypatch):
    """Many values, nulls and NaN: the span of each k-th row is small and its place exact."""
    monkeypatch.setattr(SEL, "SMALL", 50)
    monkeypatch.setattr(SEL, "VALUES", 20)
    rng = random.Random(3)
    df = spark.createDataFrame([(rng.choice([None, float("nan"), *[float(rng.randrange(2000))] * 5]), i) for i in range(3000)], "x double, id long").repartition(4).cache()
    for order in (["x", "id"], [SEL.desc("x"), SEL.desc("id")]):
        rows = [r.id for r in df.orderBy(*[F.col(k) if isinstance(k, str) else F.col(k.col).desc() for k in order]).collect()]
        spans = SEL.located(df, order, [5, 1500, 2990])
        for s in spans:
            (k, found), = s.found.items()
            inside = df.filter(s.inside).count()
            assert inside < 100 and df.filter(s.before).count() <= found.below < k <= found.below + found.ties
            assert rows[k - 1] in [r.id for r in df.filter(s.inside).collect()]
        assert len(spans) == 3
