import random
import zlib
from collections import Counter, defaultdict

from callcorpus.llm import sharding as S
from llm_edges import awkward, documents, words


def check(spark, rows, shards=24):
    got = S.place(documents(spark, rows), shards).collect()
    size = {i: len((t or "").encode()) + 8 for i, (_, t, *_) in enumerate(rows)}
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((d, size[i], zlib.crc32((t or "").encode())) for i, (d, t, *_) in enumerate(rows))
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert set(slots) <= set(range(shards))
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    held = Counter()
    for r in got:
        held[r.shard] += r.size
    share, largest = sum(size.values()) / shards, max(size.values())
    assert all(abs(held[k] - share) <= largest for k in range(shards))
    return got


def test_bytes_are_near_equal(spark):
    rng = random.Random(1)
    rows = [(i, words(rng, rng.randint(0, 60)), "en", "a") for i in range(1500)]
    got = check(spark, rows)
    assert {r.shard for r in got} == set(range(24))


def test_awkward_rows(spark):
    check(spark, awkward())


def test_a_group_of_copies_with_a_third_of_all_rows(spark):
    rng = random.Random(2)
    rows = [(i, "the same text in very many places", "en", "a") for i in range(700)] + [(9, "twice the same row", "en", "a")] * 700
    rows += [(1000 + i, words(rng, 8), "en", "a") for i in range(900)]
    got = check(spark, rows)
    # copies stand together: they lie in consecutive shards
    of = sorted({r.shard for r in got if r.text_crc32 == zlib.crc32(b"the same text in very many places")})
    assert of == list(range(of[0], of[-1] + 1))


def test_one_huge_row_among_small_ones(spark):
    rng = random.Random(3)
    check(spark, [(0, "x " * 600_000, "en", "a"), *((i, words(rng, 5), "en", "a") for i in range(1, 800))])


def test_overfull_ranges_are_subdivided(spark):
    """Few splitters and hardly a draw leave overfull ranges; the places are the same."""
    rng = random.Random(4)
    rows = [(i, words(rng, rng.randint(1, 30)), "en", "a") for i in range(1200)]
    docs = documents(spark, rows)
    measured = S.C.store(S.measure(docs, S.F.monotonically_increasing_id()), "t")
    few = {(r.doc_id, r.shard, r.slot) for r in S.placed(measured, splitters=96, draws=1, seed=5).collect()}
    assert few == {(r.doc_id, r.shard, r.slot) for r in S.place(docs).collect()}
    cut, sizes = S.ranges(measured, splitters=96, draws=1, seed=5)
    share = sum(r.bytes for r in sizes.collect()) / 96
    assert all(r.bytes - r.largest <= S.OVERFULL * share for r in sizes.collect())
    assert any(r.range.count(".") > 1 for r in sizes.collect())


def test_reruns_agree(spark):
    rng = random.Random(5)
    rows = [(i % 90, words(rng, 3, 5), "en", "a") for i in range(400)]
    a = Counter((r.doc_id, r.size, r.shard, r.slot) for r in S.place(documents(spark, rows)).collect())
    rng.shuffle(rows)
    assert a == Counter((r.doc_id, r.size, r.shard, r.slot) for r in S.place(documents(spark, rows).repartition(7)).collect())


def test_written_shards(spark, tmp_path):
    rows = awkward() + [(100 + i, f"text {i}", "en", "a") for i in range(50)]
    docs = documents(spark, rows)
    at = S.write_shards(docs, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert Counter(map(str, back.select(*docs.columns).collect())) == Counter(map(str, docs.collect()))
    counts = {r.shard: r.rows for r in at.collect()}
    assert Counter(r.shard for r in back.collect()) == counts


def test_empty_table(spark):
    assert S.place(documents(spark, [])).count() == 0
