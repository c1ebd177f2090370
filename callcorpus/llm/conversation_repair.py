"""Conversation structure repair by depth-first branch-and-bound (operator 11).

A conversation is repaired when its role initials read ``(s?(ua)+)?``. Edits, in the order of
the rows: Keep (0), Rerole to user or assistant (2), Delete (3; required for blank and
repeated rows), Insert an empty user or assistant row anywhere (2); a truncated row that is
not deleted adds 1. What is written so far is one of four states: nothing, after the system
row, after a user row, after an assistant row. Of each state only one role can follow (or, at
the start, the system row), so the edits' initials (the audit) say which roles are written.

``search`` is the branch-and-bound: an explicit stack of prefixes, deepest first; a bound
from below for every suffix (what each row costs whatever happens, and 2 for each pair of
disjoint neighbours that cannot stand together); the incumbent per final state as (cost,
audit); and per node (row, state) the best prefix so far, which eliminates every worse one.
The search ends when the stack is empty: all else is proved worse. Two audits of one node and
cost never begin with one another (the longer one would have more inserts), so the ASCII-least
prefix stays least whatever follows it, and searches over pieces of ``PIECE`` rows compose.

Spark side: rows are ordered by range partitions of (conversation, turn, role, MD5 of the
text, row number), so that a conversation with a third of all rows, or a third of all rows
being alike, is spread over tasks. A conversation that lies inside one partition and has at
most ``WHOLE_ROWS`` rows is solved where it stands. The others (those cut by a partition's
edge, and long ones) go on as rows: repeated rows are found by an aggregate, segments of
``SEGMENT`` rows are solved from every state that they can start in, a pass over the
segments' costs picks the states, and each segment is repaired on its own. Only the digest
of a long conversation's text is taken in one task, as a stream, because SHA-256 is a chain.

Defined results: nulls (any column) are read as one space. Rows of one turn are ordered by
role and MD5 of the text; rows equal in all of these are interchangeable. A row of a role
other than s..., u..., a... is reroled or deleted. Conversations without rows after the damage
have zeros, an empty audit and the digest of an empty text. An empty table gives no rows.
Other columns, whatever their names, do not matter.
"""

from __future__ import annotations

import hashlib
import os

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from . import common as C

PIECE = 32
SEGMENT = 1024
WHOLE_ROWS = 1024
WHOLE_CHARS = 1 << 23

SPACES = " \t\n\x0b\x0c\r"
START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = {START: ("u", USER), SYSTEM: ("u", USER), USER: ("a", ASSISTANT), ASSISTANT: ("u", USER)}
_LEGAL = {"su", "ua", "au"}
KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)


# ------------------------------------------------------------------ the search


def suffix_bounds(rows: list[tuple[str, int]]) -> list[int]:
    """Per suffix of (initial, fault) rows a cost that no repair of it can go below."""
    out = [0] * (len(rows) + 1)
    ahead = None  # initial of the next row that need not go, while it is free for a pair
    for i in range(len(rows) - 1, -1, -1):
        initial, fault = rows[i]
        if fault in (BLANK, DUPLICATE):
            out[i] = out[i + 1] + DELETE
            continue
        rest = 1 if fault == TRUNCATED else 0
        if initial not in ("s", "u", "a"):
            out[i] = out[i + 1] + min(REROLE + rest, DELETE)
            ahead = None
        elif ahead is not None and initial + ahead not in _LEGAL:
            out[i] = out[i + 1] + rest + 2  # one of the two goes, changes, or a row comes between
            ahead = None
        else:
            out[i] = out[i + 1] + rest
            ahead = initial
    return out


def search(rows: list[tuple[str, int]], entry: int, goals: tuple[int, ...]) -> dict[int, tuple[int, str]]:
    """Cheapest (cost, audit) from ``entry`` over all rows to each state of ``goals`` that
    can be reached; ties go to the ASCII-least audit."""
    n, bounds = len(rows), suffix_bounds(rows)
    best: dict[tuple[int, int], tuple[int, str]] = {(0, entry): (0, "")}
    found: dict[int, tuple[int, str]] = {}
    stack = [(0, "", 0, entry)]
    fresh = entry == START and any(a == "s" and f not in (BLANK, DUPLICATE) for a, f in rows)
    goals = tuple(g for g in goals if g in (USER, ASSISTANT, entry) or (g == SYSTEM and fresh))

    def hopeless(cost: int, audit: str, i: int) -> bool:
        least = cost + bounds[i]
        for goal in goals:
            if goal not in found:
                return False
            top, full = found[goal]
            if least < top or (least == top and audit < full[: len(audit) + 1]):
                return False
        return True

    while stack:
        cost, audit, i, state = stack.pop()
        if best[i, state] != (cost, audit) or hopeless(cost, audit, i):
            continue
        if i == n and state in goals and (state not in found or (cost, audit) < found[state]):
            found[state] = (cost, audit)
        role, onward = _NEXT[state]
        ways = [(cost + INSERT, audit + "I", i, onward)]
        if i < n:
            initial, fault = rows[i]
            ways.append((cost + DELETE, audit + "D", i + 1, state))
            if fault not in (BLANK, DUPLICATE):
                rest = cost + (1 if fault == TRUNCATED else 0)
                ways.append((rest + REROLE, audit + "R", i + 1, onward))
                if initial == role:
                    ways.append((rest, audit + "K", i + 1, onward))
                elif initial == "s" and state == START:
                    ways.append((rest, audit + "K", i + 1, SYSTEM))
        ways.sort(key=lambda w: (w[0] + bounds[w[2]], w[1]), reverse=True)  # the most promising is popped first
        for way in ways:
            node, label = (way[2], way[3]), (way[0], way[1])
            if node not in best or label < best[node]:
                if not hopeless(*way[:3]):
                    best[node] = label
                    stack.append(way)
    return found


def compose(rows: list[tuple[str, int]], entry: int, goals: tuple[int, ...] = (START, SYSTEM, USER, ASSISTANT)) -> dict[int, tuple[int, str]]:
    """``search`` over any number of rows, piece by piece."""
    every = (START, SYSTEM, USER, ASSISTANT)
    if len(rows) <= PIECE:
        return search(rows, entry, goals)
    labels = {entry: (0, "")}
    for at in range(0, len(rows), PIECE):
        piece = rows[at : at + PIECE]
        wanted = goals if at + PIECE >= len(rows) else every
        labels = _step(labels, {e: search(piece, e, wanted) for e in labels})
    return labels


def _step(labels: dict[int, tuple[int, str]], onward: dict[int, dict[int, tuple[int, str]]]) -> dict[int, tuple[int, str]]:
    out: dict[int, tuple[int, str]] = {}
    for e, (cost, audit) in labels.items():
        for x, (more, tail) in onward[e].items():
            if x not in out or (cost + more, audit + tail) < out[x]:
                out[x] = (cost + more, audit + tail)
    return out


def solve(rows: list[tuple[str, int]]) -> tuple[int, str]:
    """Cheapest (cost, audit) of a whole conversation."""
    return min(compose(rows, START, (START, ASSISTANT)).values())


def repaired(audit: str, rows: list[tuple[str, str]], state: int = START) -> tuple[list[tuple[str, str, str]], int]:
    """(edit, role, text) of the rows that an audit leaves, and the final state."""
    out, at = [], 0
    for edit in audit:
        if edit == "D":
            at += 1
            continue
        role, onward = _NEXT[state]
        name = "user" if role == "u" else "assistant"
        if edit == "I":
            out.append((edit, name, ""))
        else:
            given, text = rows[at]
            at += 1
            if edit == "K" and state == START and given.startswith("s"):
                onward = SYSTEM
            out.append((edit, given if edit == "K" else name, text))
        state = onward
    return out, state


# ------------------------------------------------------------------ rows


def damage(convs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, gone) with faults planted by crc32 of ``conv_id:turn``
    modulo 20: dropped (``gone``; the row stays to name its conversation), emptied, without
    sentence ends, repeated, or said by the user."""
    def plain(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(plain(conv_col), F.lit(":"), plain(turn_col)).cast("binary")) % 20
    rows = convs.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), plain(role_col).alias("role"), plain(text_col).alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") < 2, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    out = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("kind") == 0).alias("gone"), F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    return out.drop("copy")


def fault_of(text: str, again: bool) -> int:
    end = text.rstrip(SPACES)[-1:]
    if not end:
        return BLANK
    return DUPLICATE if again else NONE if end in ".!?" else TRUNCATED


def _digest(rows: list[tuple[str, str, str]]) -> str:
    return hashlib.sha256("\n".join(f"{r}:{t}" for _, r, t in rows).encode()).hexdigest()


def _gaps(turns: set) -> int:
    return max(turns) - min(turns) + 1 - len(turns) if turns else 0


_RESULT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _whole(rows: list[tuple]) -> tuple:
    """The result of one conversation from its (turn, role, text) rows."""
    seen, marks = set(), []
    for _, role, text in rows:
        same = (role, text)
        marks.append((role[:1], fault_of(text, same in seen)))
        seen.add(same)
    count = [0] * 4
    for _, f in marks:
        count[f] += 1
    illegal = sum(a[0] + b[0] not in _LEGAL for a, b in zip(marks, marks[1:]))
    cost, audit = solve(marks)
    kept, _ = repaired(audit, [(r, t) for _, r, t in rows])
    return _gaps({t for t, _, _ in rows if t is not None}), count[BLANK], count[DUPLICATE], count[TRUNCATED], illegal, cost, audit, _digest(kept)


def _first_pass(batches):
    """One row per conversation that lies inside the partition; the rows of the others."""
    part = TaskContext.get().partitionId() << 40
    conv, held, chars, at, spilling = None, [], 0, 0, True  # the first run may have begun before
    done, left, kind = [], [], None
    started = False

    def rest(c, rows):
        nonlocal at
        for r in rows:
            left.append((c, *r, part + at))
            at += 1

    for batch in batches:
        kind = batch.schema.field(0).type
        for c, turn, role, text, gone in zip(*(batch.column(k).to_pylist() for k in range(5))):
            if not started or c != conv:
                if started and spilling:
                    rest(conv, held)
                elif started:
                    done.append((conv, _whole([r[:3] for r in held if not r[3]])))
                conv, held, chars, spilling = c, [], 0, not started
                started = True
            held.append((turn, role, text, gone))
            chars += len(text)
            spilling = spilling or len(held) > WHOLE_ROWS or chars > WHOLE_CHARS
            if spilling and (len(held) >= 256 or chars > WHOLE_CHARS):
                rest(conv, held)
                held, chars = [], 0
            if len(left) >= 256 or len(done) >= 4096:
                yield _first_batch(kind, done, left)
                done, left = [], []
    if started:
        rest(conv, held)  # the last run may go on
        yield _first_batch(kind, done, left)


def _first_batch(kind, done, left) -> pa.RecordBatch:
    n, m = len(done), len(left)
    cols = [pa.array([c for c, _ in done] + [r[0] for r in left], kind)]
    types = [pa.int64()] * 6 + [pa.string()] * 2
    for k, t in enumerate(types):
        cols.append(pa.array([d[k] for _, d in done] + [None] * m, t))
    for k, t in enumerate([pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.int64()], 1):
        cols.append(pa.array([None] * n + [r[k] for r in left], t))
    return pa.RecordBatch.from_arrays(cols, ["conv_id", *_RESULT, "turn", "role", "text", "gone", "pos"])


# ------------------------------------------------------------------ conversations in segments


def _segments(batches):
    """(conv_id, seg, entry, exit, cost, audit, first, last, inside) of the sorted rows of each
    segment: what every way through it costs, its first and last initial, and its number of
    illegal neighbours."""
    for (conv, seg), rows, kind in _runs(batches, 2):
        marks = [(r[2], r[3]) for r in rows]
        inside = sum(a[0] + b[0] not in _LEGAL for a, b in zip(marks, marks[1:]))
        ways = [(e, x, *label) for e in range(4) for x, label in compose(marks, e).items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([conv] * len(ways), kind), pa.array([seg] * len(ways), pa.int64()), *(pa.array([w[k] for w in ways], t) for k, t in enumerate([pa.int32(), pa.int32(), pa.int64(), pa.string()])),
             pa.array([marks[0][0]] * len(ways)), pa.array([marks[-1][0]] * len(ways)), pa.array([inside] * len(ways), pa.int64())],
            ["conv_id", "seg", "entry", "exit", "cost", "audit", "first", "last", "inside"],
        )


def _runs(batches, width: int):
    """Runs of rows that agree in their first ``width`` columns, over batches."""
    key, rows, kind = None, [], None
    for batch in batches:
        kind = batch.schema.field(0).type
        for r in zip(*(c.to_pylist() for c in batch.columns)):
            if rows and r[:width] != key:
                yield key, rows, kind
                rows = []
            key = r[:width]
            rows.append(r)
    if rows:
        yield key, rows, kind


def _choose(batches):
    """(conv_id, seg, entry, exit, cost, illegal) per segment of the cheapest way through
    each conversation, from the segments' ways in order. Of the audits only what the states'
    best ones do not share is kept; of the past one byte per segment and state."""
    for conv, parts, kind in _ways_of(batches):
        labels, back, segs, illegal, before = {START: (0, "")}, [], [], 0, None
        for seg, ways, first, last, inside in parts:
            new, came = {}, bytearray(4)
            for e, x, cost, audit in ways:
                if e in labels:
                    label = (labels[e][0] + cost, labels[e][1] + audit)
                    if x not in new or label < new[x]:
                        new[x], came[x] = label, e
            shared = len(os.path.commonprefix([a for _, a in new.values()]))
            labels = {x: (c, a[shared:]) for x, (c, a) in new.items()}
            segs.append(seg)
            back.append(bytes(came))
            illegal += inside + (before is not None and before + first not in _LEGAL)
            before = last
        exit_, (cost, _) = min(((x, label) for x, label in labels.items() if x in (START, ASSISTANT)), key=lambda w: w[1])
        path = []
        for came in reversed(back):
            path.append((came[exit_], exit_))
            exit_ = came[exit_]
        path.reverse()
        for s in range(0, len(segs), 4096):
            n = len(segs[s : s + 4096])
            zero = [0] * n
            yield pa.RecordBatch.from_arrays(
                [pa.array([conv] * n, kind), pa.array(segs[s : s + n], pa.int64()), pa.array([p[0] for p in path[s : s + n]], pa.int32()), pa.array([p[1] for p in path[s : s + n]], pa.int32()),
                 pa.array([cost if s == 0 else 0, *zero[1:]], pa.int64()), pa.array([illegal if s == 0 else 0, *zero[1:]], pa.int64())],
                ["conv_id", "seg", "entry", "exit", "cost", "illegal"],
            )


def _ways_of(batches):
    """(conv_id, iterator of (seg, ways, first, last, inside)) over sorted ways, as a stream."""
    def flat():
        for (conv, seg), rows, kind in _runs(batches, 2):
            yield conv, (seg, [r[2:6] for r in rows], rows[0][6], rows[0][7], rows[0][8]), kind

    todo = flat()
    held = next(todo, None)
    while held is not None:
        conv, kind = held[0], held[2]

        def parts():
            nonlocal held
            while held is not None and held[0] == conv:
                yield held[1]
                held = next(todo, None)

        yield conv, parts(), kind


def _mend(batches):
    """(conv_id, seg, audit, text): each segment repaired, its rows joined by newlines."""
    for (conv, seg), rows, kind in _runs(batches, 2):
        entry, audit = rows[0][5], rows[0][6]
        kept, _ = repaired(audit, [(r[3], r[4]) for r in rows], entry)
        text = "\n".join(f"{r}:{t}" for _, r, t in kept) if kept else None
        yield pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array([seg], pa.int64()), pa.array([audit]), pa.array([text], pa.string())], ["conv_id", "seg", "audit", "text"])


def _hash(batches):
    """(conv_id, audit, repaired_sha256) of sorted segments; one segment is held at a time."""
    conv, kind, hasher, audit, some, open_ = None, None, None, [], False, False

    def result():
        return pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array(["".join(audit)]), pa.array([hasher.hexdigest()])], ["conv_id", "audit", "repaired_sha256"])

    for batch in batches:
        kind = batch.schema.field(0).type
        for c, a, t in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            if not open_ or c != conv:
                if open_:
                    yield result()
                conv, hasher, audit, some, open_ = c, hashlib.sha256(), [], False, True
            audit.append(a)
            if t is not None:
                hasher.update(("\n" + t if some else t).encode())
                some = True
    if open_:
        yield result()


def _long(rows: DataFrame, kind: str) -> DataFrame:
    """Results of the conversations that are left as rows (conv_id, turn, role, text, gone, pos)."""
    rows = rows.withColumn("th", F.sha2(F.col("text").cast("binary"), 256))
    live = rows.filter("NOT gone")
    first = live.groupBy("conv_id", "role", "th").agg(F.min("pos").alias("at")).select("at")
    spaces = r"\x20\x09-\x0D"
    blank = ~F.col("text").rlike(f"[^{spaces}]")
    cut = F.col("text").rlike(f"[^{spaces}.!?][{spaces}]*\\z")
    fault = F.when(blank, BLANK).when(F.col("at").isNull(), DUPLICATE).when(cut, TRUNCATED).otherwise(NONE)
    # segments of consecutive rows of a conversation in a partition; positions are unique, so no key is hot
    marked = live.join(first, F.col("pos") == F.col("at"), "left").select(
        "conv_id", F.expr(f"pos div {SEGMENT}").alias("seg"), "pos", "turn", "role", "text", F.substring("role", 1, 1).alias("initial"), fault.cast("int").alias("fault"), "th"
    )
    marked = C.store(marked, "repair-marked")
    per_seg = marked.select("conv_id", "seg", "initial", "fault", "pos").repartition("conv_id", "seg").sortWithinPartitions("conv_id", "seg", "pos")
    ways = C.store(per_seg.select("conv_id", "seg", "initial", "fault").mapInArrow(_segments, f"conv_id {kind}, seg long, entry int, exit int, cost long, audit string, first string, last string, inside long"), "repair-ways")
    in_order = ways.repartition("conv_id").sortWithinPartitions("conv_id", "seg")
    chosen = C.store(in_order.mapInArrow(_choose, f"conv_id {kind}, seg long, entry int, exit int, cost long, illegal long"), "repair-chosen")
    on = [chosen["conv_id"].eqNullSafe(ways["conv_id"]), *[chosen[c] == ways[c] for c in ("seg", "entry", "exit")]]
    pieces = chosen.join(ways, on).select(chosen["conv_id"].alias("c"), chosen["seg"].alias("s"), chosen["entry"].alias("entry"), "audit")
    given = marked.join(pieces, marked["conv_id"].eqNullSafe(pieces["c"]) & (marked["seg"] == pieces["s"]))
    given = given.select("conv_id", "seg", "pos", "role", "text", "entry", "audit").repartition("conv_id", "seg").sortWithinPartitions("conv_id", "seg", "pos")
    mended = given.mapInArrow(_mend, f"conv_id {kind}, seg long, audit string, text string")
    digest = mended.repartition("conv_id").sortWithinPartitions("conv_id", "seg").mapInArrow(_hash, f"conv_id {kind}, audit string, repaired_sha256 string")
    inner = chosen.groupBy("conv_id").agg(F.sum("cost").alias("cost"), F.sum("illegal").alias("illegal"))
    turns = marked.groupBy("conv_id", "turn").agg(*[F.count_if(F.col("fault") == k).alias(f"f{k}") for k in (BLANK, DUPLICATE, TRUNCATED)])
    counts = turns.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"),
        F.sum(f"f{BLANK}").alias("blank"), F.sum(f"f{DUPLICATE}").alias("duplicate"), F.sum(f"f{TRUNCATED}").alias("truncated"),
    )
    out = rows.select("conv_id").distinct()
    for part in (counts, inner, digest):
        part = part.withColumnRenamed("conv_id", "_c")
        out = out.join(part, out["conv_id"].eqNullSafe(part["_c"]), "left").drop("_c")
    zero = F.lit(0).cast("long")
    return out.select(
        "conv_id", *[F.coalesce(c, zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


def repair(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) per
    conversation of ``rows`` (conv_id, turn, role, text, gone; ``damage`` makes them)."""
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "th", "tie"]
    keyed = rows.select("conv_id", "turn", "role", "text", "gone", F.md5(F.col("text").cast("binary")).alias("th"), F.monotonically_increasing_id().alias("tie"))
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "gone")
    kind = rows.schema["conv_id"].dataType.simpleString()
    result = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    first = C.store(ordered.mapInArrow(_first_pass, f"conv_id {kind}, {result}, turn long, role string, text string, gone boolean, pos long"), "repair-first")
    done = first.filter("pos IS NULL").select("conv_id", *_RESULT)
    return done.unionByName(_long(first.filter("pos IS NOT NULL").select("conv_id", "turn", "role", "text", "gone", "pos"), kind))
