"""Top-k of a query table by block products, against a plain comparison."""

import math
import random

from callcorpus.operators import tables as TB


def cosine(a, b):
    return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a)) / math.sqrt(sum(x * x for x in b))


def brute(corpus, queries, k):
    out = {}
    for q, v in queries:
        if v is None or not any(v):
            continue
        ranked = sorted(((-round(cosine(v, w), 9), i) for i, w in corpus if i is not None and w is not None and None not in w and any(w) and len(w) == len(v)))
        out |= {(q, r): i for r, (_, i) in enumerate(ranked[:k], 1)}
    return out


def result(df):
    return {(r.query_id, r["rank"]): r.id for r in df.withColumnRenamed("i", "id").collect()}


def vectors(rng, n, dim):
    return [(f"v{k:04d}", [float(rng.randint(-2, 2)) for _ in range(dim)]) for k in range(n)]


def test_many_queries_agree_with_a_plain_comparison(spark, monkeypatch):
    rng = random.Random(1)
    corpus = vectors(rng, 400, 3) + [("z", [0.0, 0.0, 0.0]), ("n", None), ("m", [1.0, None, 1.0]), (None, [1.0, 1.0, 1.0]), ("d", [1.0, 2.0]), ("e", [])]
    queries = vectors(rng, 300, 3) + [("two", [2.0, 1.0]), ("one", [1.0]), ("none", None), ("zero", [0.0, 0.0, 0.0])]
    c = spark.createDataFrame(corpus, "i string, v array<double>").repartition(3)
    q = spark.createDataFrame(queries, "q string, v array<double>").repartition(2)
    monkeypatch.setattr(TB, "QUERY_BLOCK", 64)  # several blocks of queries
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        assert result(TB.vector_topk(c, q, "i", "v", 7)) == brute(corpus, queries, 7)
        page = result(TB.paged_search(c, q, "i", "v", page=3, per_page=4))
        assert page == {key: i for key, i in brute(corpus, queries, 12).items() if key[1] > 8}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_a_large_query_table_is_not_broadcast(spark, monkeypatch):
    rng = random.Random(2)
    corpus, queries = vectors(rng, 500, 4) + [("d", [1.0, 2.0])], vectors(rng, 400, 4) + [("two", [2.0, 1.0])]
    c = spark.createDataFrame(corpus, "i string, v array<double>").repartition(3)
    q = spark.createDataFrame(queries, "q string, v array<double>")
    monkeypatch.setattr(TB, "BROADCAST_BYTES", 1000)
    monkeypatch.setattr(TB, "BLOCK_BYTES", 3200)  # several blocks on both sides
    found = TB.vector_topk(c, q, "i", "v", 6)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert result(found) == brute(corpus, queries, 6)


def test_equal_vectors_are_ranked_by_id(spark):
    corpus = [(k, [0.1, 0.7, -0.3]) for k in range(500)]
    c = spark.createDataFrame(corpus, "i long, v array<float>").repartition(4)
    q = spark.createDataFrame([(1, [0.3, 0.3, 0.1])], "q long, v array<double>")
    assert [r.i for r in TB.vector_topk(c, q, "i", "v", 20).orderBy("rank").collect()] == list(range(20))


def test_the_corpus_is_scanned_once_and_limited_before_the_exchange(spark, tmp_path):
    spark.createDataFrame([(k, [1.0, float(k)]) for k in range(50)], "i long, v array<double>").write.parquet(str(tmp_path / "c"))
    c = spark.read.parquet(str(tmp_path / "c"))
    q = spark.createDataFrame([(k, [float(k), 1.0]) for k in range(600)], "q long, v array<double>")
    plan = TB.vector_topk(c, q, "i", "v", 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "WindowGroupLimit" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_empty_tables(spark):
    none = spark.createDataFrame([], "i long, v array<double>")
    some = spark.createDataFrame([(1, [1.0])], "i long, v array<double>")
    assert TB.vector_topk(none, some, "i", "v", 5).count() == TB.vector_topk(some, none, "i", "v", 5).count() == 0
