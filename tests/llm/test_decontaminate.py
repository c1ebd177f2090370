import random
import re

from pyspark.sql import types as T

from callcorpus.llm import decontaminate as D
from llm_edges import awkward, documents, words

_AZ = {c: c + 32 for c in range(65, 91)}
BENCH = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("key", T.StringType()), T.StructField("words", T.StringType())])


def words_in(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(_AZ))


def brute(docs, items):
    out = []
    for i, t, *_ in docs:
        w = words_in(t)
        hit, listed = set(), set()
        for item, text in items:
            x = words_in(text)
            n = min(13, len(x))
            wins = {tuple(x[p : p + n]) for p in range(len(x) - n + 1)} if x else set()
            for p in range(len(w) - n + 1):
                if tuple(w[p : p + n]) in wins:
                    hit |= set(range(p, p + n))
                    if item is not None:
                        listed.add(str(item))
        out.append((str(i), len(w), len(hit), sorted(listed), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out)


def check(spark, docs, items):
    bench = spark.createDataFrame([(i, t, "x", "y") for i, t in items], BENCH)
    got = D.find(documents(spark, docs), bench).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, list(r.items), r.contaminated) for r in got) == brute(docs, items)


def test_planted_spans(spark):
    rng = random.Random(2)
    items = [(i, words(rng, rng.choice([13, 14, 20, 60])).replace("w1", "É1")) for i in range(12)]
    items += [(10, items[0][1]), (100, "Alpha beta"), (101, "solo"), (102, words(rng, 9)), (103, ""), (104, None), (None, words(rng, 15)), (105, "the " * 30)]
    docs = awkward()
    for i in range(40):
        parts = []
        for _ in range(rng.randint(1, 3)):
            x = (rng.choice(items)[1] or "").split()
            a = rng.randint(0, max(0, len(x) - 12))
            parts += [words(rng, rng.randint(0, 40)), ", ".join(x[a : a + rng.choice([11, 12, 13, 14, 40])]).upper()]
        docs.append((200 + i, " - ".join(parts), "en", "a"))
    check(spark, docs, items)


def test_empty_tables(spark):
    check(spark, awkward(), [])
    check(spark, [], [(1, "a b c")])


def test_drop(spark):
    rng = random.Random(4)
    passage = words(rng, 20)
    docs = documents(spark, [(1, passage, "en", "a"), (2, words(rng, 300, 10**6) + " " + passage, "en", "a"), (3, words(rng, 500, 10**6) + " " + passage, "en", "a"), (4, "clean", "en", "a"), (5, None, "en", "a")])
    left = D.drop_contaminated(docs, spark.createDataFrame([(1, passage, "x", "y")], BENCH))
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [3, 4, 5]


def test_main_path_is_native(spark):
    plan = D.document_fingerprints(documents(spark, awkward()), [5, 13])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
