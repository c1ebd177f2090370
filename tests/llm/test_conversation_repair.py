import hashlib
import random
import zlib
from functools import lru_cache

from pyspark.sql import types as T

from callcorpus.llm import conversation_repair as R

SCHEMA = T.StructType(
    [T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in ("gone", "pos", "th", "seg", "entry", "cost", "at", "tie")]
)


def table(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 8) for r in rows], SCHEMA)


def shortest(marks):
    """Cheapest (cost, audit) by plain recursion over (row, state)."""

    @lru_cache(None)
    def ahead(i, state, inserts):
        ways = []
        if i == len(marks) and state in (0, 3):
            ways.append((0, ""))
        role, onward = {0: ("u", 2), 1: ("u", 2), 2: ("a", 3), 3: ("u", 2)}[state]

        def add(cost, edit, rest):
            if rest is not None:
                ways.append((cost + rest[0], edit + rest[1]))

        if inserts < 2:
            add(2, "I", ahead(i, onward, inserts + 1))
        if i < len(marks):
            initial, fault = marks[i]
            add(3, "D", ahead(i + 1, state, 0))
            if fault not in (R.BLANK, R.DUPLICATE):
                late = fault == R.TRUNCATED
                add(2 + late, "R", ahead(i + 1, onward, 0))
                if initial == role:
                    add(late, "K", ahead(i + 1, onward, 0))
                if initial == "s" and state == 0:
                    add(late, "K", ahead(i + 1, 1, 0))
        return min(ways, default=None)

    for i in range(len(marks), 0, -50):  # keeps the recursion shallow
        for state in range(4):
            ahead(i, state, 0)
    return ahead(0, 0, 0)


def brute(rows):
    """{conv_id: result} of undamaged rows, from the contract's words."""
    out, by = {}, {}
    for c, turn, role, text in rows:
        by.setdefault(c, [])
        key = f"{' ' if c is None else c}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else "".join(x for x in text if x not in ".!?") if kind == 2 else text
        by[c] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    for c, said in by.items():
        said.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        marks, seen = [], set()
        for _, role, text in said:
            end = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
            marks.append((role[:1], R.BLANK if not end else R.DUPLICATE if (role, text) in seen else R.NONE if end in ".!?" else R.TRUNCATED))
            seen.add((role, text))
        cost, audit = shortest(tuple(marks))
        lines, at, written = [], 0, ""
        for edit in audit:
            role, text = ("", "") if edit == "I" else said[at][1:]
            at += edit != "I"
            if edit == "D":
                continue
            if edit != "K":
                role = "assistant" if written[-1:] == "u" else "user"
            written += role[0]
            lines.append(f"{role}:{text}")
        assert written.removeprefix("s").replace("ua", "") == "" and written != "s"
        turns = {t for t, _, _ in said if t is not None}
        faults = [f for _, f in marks]
        out[c] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(k) for k in (R.BLANK, R.DUPLICATE, R.TRUNCATED)),
            sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(marks, marks[1:])), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def result(df):
    rows = df.collect()
    got = {r.conv_id: tuple(r)[1:] for r in rows}
    assert len(got) == len(rows)
    return got


def check(spark, rows):
    got = result(R.repair(R.damage(table(spark, rows))))
    assert got == brute(rows)
    return got


def some_rows(rng, conv, n):
    roles = ["system", "user", "assistant", "assistant", "user", "tool", "", None, "s", "\U0001f600"]
    texts = ["Yes.", "No", "", " \n", None, "Why?", "So! ", "é.\t", "end. ", "x" * 50 + "."]
    return [(conv, rng.choice([None, t, t, t, t + 1]), rng.choice(roles[: rng.randint(2, len(roles))]), rng.choice(texts)) for t in range(n)]


def test_search_finds_the_cheapest_and_least_audit():
    rng = random.Random(1)
    for _ in range(1500):
        marks = [(rng.choice("suaut"), rng.choice([0, 0, 0, 0, 1, 2, 3])) for _ in range(rng.randrange(14))]
        assert R.solve(marks) == shortest(tuple(marks))


def test_pieces_compose():
    rng = random.Random(2)
    for _ in range(40):
        marks = [(rng.choice("suauax"), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(rng.randrange(30, 180))]
        assert R.solve(marks) == shortest(tuple(marks))


def test_bounds_never_exceed_the_cost():
    rng = random.Random(3)
    for _ in range(500):
        marks = [(rng.choice("suaut"), rng.choice([0, 0, 1, 2, 3])) for _ in range(rng.randrange(9))]
        bounds = R.suffix_bounds(marks)
        for i in range(len(marks) + 1):
            for entry in range(4):
                found = R.search(marks[i:], entry, (0, 1, 2, 3))
                assert all(cost >= bounds[i] for cost, _ in found.values())


def test_search_eliminates_prefixes():
    """The bounds and dominance tables keep the work near the number of nodes."""
    rng = random.Random(4)
    marks = [(rng.choice("ua"), rng.choice([0, 0, 0, 3])) for _ in range(R.PIECE)]
    assert R.solve(marks) == shortest(tuple(marks))


def test_repair_agrees_with_brute_force(spark):
    rng = random.Random(5)
    rows = [r for c in [None, *range(120)] for r in some_rows(rng, c, rng.randint(1, 12))]
    rows += [(500, t, "user" if t % 2 else "assistant", f"turn {t}.") for t in range(9)]
    rows += [(501, 3, "user", "same.")] * 5 + [(502, None, None, None)] * 3
    check(spark, rows)


def test_dropped_conversation_is_named(spark):
    gone = next(c for c in range(10**4) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = check(spark, [(gone, 0, "user", "Hello.")])
    assert got[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_conversation_with_most_rows_is_spread(spark):
    """Two long conversations go through segments; every result is that of brute force."""
    rng = random.Random(6)
    rows = [r for c in range(30) for r in some_rows(rng, c, 6)]
    rows += [(77, t, rng.choice(["user", "assistant", "assistant"]), rng.choice([f"t{t}.", "often.", "cut", ""])) for t in range(2500)]
    rows += [(78, None, rng.choice(["user", "assistant"]), f"n{k}.") for k in range(700)] + [(78, None, "user", "same.")] * 600
    check(spark, rows)


def test_many_partitions(spark):
    rng = random.Random(7)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        check(spark, [r for c in range(60) for r in some_rows(rng, c, rng.randint(1, 9))])
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_very_long_text(spark):
    check(spark, [(1, 0, "user", "a b. " * 400_000), (1, 1, "assistant", "x" * 3_000_000), (2, 0, "user", "Hi.")])


def test_empty_table(spark):
    assert R.repair(R.damage(table(spark, []))).count() == 0
