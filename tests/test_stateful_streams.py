"""R8 and N2 + C2 as streams against their batch forms."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from callcorpus.operators import scoring, tables as TB
from callcorpus.streaming import jobs as SJ

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@pytest.fixture()
def rocks(spark):
    spark.conf.set(PROVIDER, ROCKS)
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield spark
    spark.conf.unset(PROVIDER)
    spark.conf.set("spark.sql.shuffle.partitions", "8")


UPDATES = "id long, ts timestamp_ntz, seq long, note string, done boolean, due long"


def updates(rng, n, keys):
    at = dt.datetime(2024, 1, 1)
    return [
        (rng.randrange(keys), at + dt.timedelta(minutes=rng.randrange(100)), k, rng.choice([None, f"note {k}", "é"]), rng.choice([None, True, False]), rng.choice([None, 2**53 + k]))
        for k in range(n)
    ]


def write(spark, rows, schema, path, parts):
    """One file per batch, in the order given."""
    for k in range(parts):
        spark.createDataFrame(rows[k::parts], schema).coalesce(1).write.mode("append").json(path)


def latest(got):
    """The last state given out per key."""
    return {k: max(v) for k, v in got.items()}


def test_updates_in_any_order_fold_like_the_batch_and_survive_a_restart(rocks, tmp_path):
    rng = random.Random(1)
    rows = updates(rng, 160, 6)
    rng.shuffle(rows)
    src = str(tmp_path / "in")
    out = str(tmp_path / "out")
    for half in (rows[:80], rows[80:]):  # the second start goes on from the checkpoint
        write(rocks, half, UPDATES, src, 2)
        stream = SJ.read_stream(rocks, src, UPDATES, "json", max_files_per_trigger=1)
        state = SJ.upsert_state_stream(stream, "id", ["ts", "seq"], ["note", "done", "due"])
        SJ.start(state, str(tmp_path / "ckpt"), "update", foreach_batch=lambda df, n: df.withColumn("batch", F.lit(n)).write.mode("append").parquet(out)).awaitTermination(120)
    got = {}
    for r in rocks.read.parquet(out).collect():
        got[r.id] = max(got.get(r.id, (0,)), (r.n_updates, r.note, r.done, r.due), key=lambda x: x[0])
    batch = TB.upsert_state(rocks.createDataFrame(rows, UPDATES), "id", ["ts", "seq"], ["note", "done", "due"])
    assert got == {r.id: (r.n_updates, r.note, r.done, r.due) for r in batch.collect()}


def test_idle_keys_are_forgotten(rocks, tmp_path):
    src, day = str(tmp_path / "in"), dt.datetime(2024, 1, 1)
    schema = "id long, ts timestamp, note string"
    seen = []
    for k, rows in enumerate([[(1, day, "a"), (2, day, "b")], [(2, day + dt.timedelta(hours=9), "c")], [(2, day + dt.timedelta(hours=10), None)], [(1, day + dt.timedelta(hours=10), None)]]):
        rocks.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        stream = SJ.read_stream(rocks, src, schema)
        state = SJ.upsert_state_stream(stream, "id", ["ts"], ["note"], idle="1 hour", time_col="ts")
        SJ.start(state, str(tmp_path / "ckpt"), "update", foreach_batch=lambda df, n: seen.extend((k, *r) for r in df.collect())).awaitTermination(120)
    assert (3, 1, 1, None) in seen  # forgotten: its count starts again and its note is gone
    assert (2, 2, 3, "c") in seen or (2, 2, 2, "c") in seen


def test_another_state_store_is_refused(spark):
    with pytest.raises(RuntimeError):
        SJ.upsert_state_stream(spark.createDataFrame([], UPDATES), "id", ["ts"], ["note"])


def test_cases_and_predictions_as_streams(rocks, tmp_path):
    """Repeats, delays and gaps: the written rows score like the batch join."""
    rng = random.Random(2)
    at = dt.datetime(2024, 1, 1)
    call = '{{"function": "f", "arguments": {{"k": {}}}}}'
    cases = [(m, i, call.format(i), at + dt.timedelta(seconds=i)) for m in ("a", "b") for i in range(40)]
    told = []
    for m, i, _, t in cases:
        if i % 5 == 4:
            continue  # never arrives
        raw = call.format(i) if i % 3 else "so " + call.format(i + 1) if i % 2 else "none"
        told += [(m, i, raw, t + dt.timedelta(seconds=rng.randrange(600)))] * (1 + (i % 4 == 0))
    rng.shuffle(told)
    case_schema, told_schema = "model_name string, example_id long, expected string, ts timestamp", "model_name string, example_id long, raw_output string, ts timestamp"
    end = at + dt.timedelta(days=1)  # one more of each moves the watermark past all others
    write(rocks, cases, case_schema, str(tmp_path / "cases"), 2)
    write(rocks, told, told_schema, str(tmp_path / "told"), 3)
    out = str(tmp_path / "out")

    def run():
        c = SJ.read_stream(rocks, str(tmp_path / "cases"), case_schema, "json", 1)
        p = SJ.read_stream(rocks, str(tmp_path / "told"), told_schema, "json", 1)
        SJ.start(SJ.score_stream(c, p), str(tmp_path / "ckpt"), path=out).awaitTermination(180)

    run()
    write(rocks, [("end", 0, call.format(0), end)], case_schema, str(tmp_path / "cases"), 1)
    write(rocks, [("end", 0, "", end)], told_schema, str(tmp_path / "told"), 1)
    run()  # goes on from the checkpoint
    got = rocks.read.parquet(out).filter("model_name != 'end'")
    assert got.count() == len(cases)
    batch = scoring.score_rows(
        rocks.createDataFrame(cases, case_schema).join(rocks.createDataFrame(told, told_schema).drop("ts").distinct(), ["model_name", "example_id"], "left")
    )
    board = [sorted(tuple(r) for r in scoring.scoreboard(x).collect()) for x in (got, batch)]
    assert board[0] == board[1] and sum(r[1] for r in board[0]) == 80
