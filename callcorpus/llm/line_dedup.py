"""Line dedup by pairwise alignment (operator 4).

1. Texts are keyed by MD5. Copies of one text are collapsed: the document with the smallest
   id is its first, every other one is a later copy.
2. Each distinct text becomes its list of line digests (128 bits of BLAKE2, so lines are equal
   where their digests are) and line lengths (in words). Its keys are its lines and its least runs: from each line on, and up to each line, the fewest
   lines that reach ``min_block_words`` words. Every line of a common block of that size is
   in a least run of the block. A key's owner is the earliest text that holds it. Every text
   is paired with the owners of its keys: at most one pair per key, so a line that a third of
   all texts share gives each of them one pair and never all pairs among them.
3. A pair is aligned by patience diff over its least runs: runs that are unique on both
   sides, their longest increasing sequence, and the same again between them; where nothing
   is unique (a block that a side holds twice) the longer side is halved until it is. Aligned
   runs are deleted from the later text, and what is left of it is aligned with the whole
   owner again (blocks in another order) until the two share no run. Blank lines between
   deleted lines go too.

The earliest holder of a line never loses it, so no line disappears from the corpus.

Defined results: null text has no lines and stays null; an empty text stays empty. A later
copy loses the whole text (if it has ``min_block_words`` words). Rows that repeat both id
and text are one document and are treated alike. A null id counts as the latest. Lines are
compared whole, without their newline. An empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from hashlib import blake2b
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import common as C

MIN_BLOCK_WORDS = 10


def matches(a: list, b: list) -> list[tuple[int, int]]:
    """Patience diff: increasing pairs (i, j) with ``a[i] == b[j]``. If the lists share
    anything, there is a pair."""
    found: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, i_end, j, j_end = todo.pop()
        while i < i_end and j < j_end and a[i] == b[j]:
            found.append((i, j))
            i, j = i + 1, j + 1
        while i < i_end and j < j_end and a[i_end - 1] == b[j_end - 1]:
            i_end, j_end = i_end - 1, j_end - 1
            found.append((i_end, j_end))
        once = _once(a, i, i_end)
        pairs = [(once[line], at) for line, at in sorted(_once(b, j, j_end).items(), key=lambda x: x[1]) if line in once]
        anchors = _increasing(pairs)
        if anchors:
            found += anchors
            for (x, y), (x_end, y_end) in zip([(i - 1, j - 1), *anchors], [*anchors, (i_end, j_end)]):
                if x + 1 < x_end and y + 1 < y_end:
                    todo.append((x + 1, x_end, y + 1, y_end))
        elif not set(a[i:i_end]).isdisjoint(b[j:j_end]):
            todo += _halves(a, b, i, i_end, j, j_end)
    return sorted(found)


def _halves(a: list, b: list, i: int, i_end: int, j: int, j_end: int) -> list[tuple[int, int, int, int]]:
    """A stretch with common entries, none of them unique on both sides: the side that repeats
    more is halved. Both halves are paired with that part of the other side which keeps the
    pairs increasing, cut at the first entry that the first half shares with it."""
    if i_end - i >= j_end - j:
        mid = (i + i_end) // 2
        first, rest = set(a[i:mid]), set(a[mid:i_end])
        cut = next((y for y in range(j, j_end) if b[y] in first), j - 1) + 1
        later = any(b[y] in rest for y in range(cut, j_end))
        return [(i, mid, j, cut), (mid, i_end, cut, j_end)] if cut > j and later else [(i, mid, j, j_end)] if cut > j else [(mid, i_end, j, j_end)]
    return [(x, x_end, y, y_end) for y, y_end, x, x_end in _halves(b, a, j, j_end, i, i_end)]


def _once(lines: list, start: int, end: int) -> dict:
    """Positions of the lines that occur once in ``lines[start:end]``."""
    at: dict = {}
    for k in range(start, end):
        at[lines[k]] = -1 if lines[k] in at else k
    return {line: k for line, k in at.items() if k >= 0}


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of the pairs (ordered by j) that also increases in i."""
    tops: list[int] = []
    last: list[int] = []
    before: list[int] = []
    for n, (i, _) in enumerate(pairs):
        pile = bisect_left(tops, i)
        before.append(last[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(i)
            last.append(n)
        else:
            tops[pile], last[pile] = i, n
    run, n = [], last[-1] if last else -1
    while n >= 0:
        run.append(pairs[n])
        n = before[n]
    return run[::-1]


def least_runs(words: list[int], min_block_words: int) -> set[tuple[int, int]]:
    """(start, end) of the fewest lines from, and up to, each line with words that have
    ``min_block_words`` words."""
    total = [0, *accumulate(words)]
    out = set()
    for k, n in enumerate(words):
        if n:
            end = bisect_left(total, total[k] + min_block_words)
            if end < len(total):
                out.add((k, end))
            start = bisect_right(total, total[k + 1] - min_block_words) - 1
            if start >= 0:
                out.add((start, k + 1))
    return out


def common_lines(owner: list, later: list, words: list[int], min_block_words: int) -> list[int]:
    """Lines of ``later`` inside common blocks of at least ``min_block_words`` words, found by
    aligning what is left of it with ``owner`` until they share no least run."""
    size = dict(zip(later, words))
    known = [size.get(line, min_block_words) for line in owner]  # a line that ``later`` lacks ends a run
    held = [tuple(owner[i:end]) for i, end in sorted(least_runs(known, min_block_words))]
    left = sorted(least_runs(words, min_block_words))
    done: set[int] = set()
    while left:
        aligned = {j for _, j in matches(held, [tuple(later[j:end]) for j, end in left])}
        if not aligned:
            break
        for j in aligned:
            done.update(range(*left[j]))
        left = [run for j, run in enumerate(left) if j not in aligned]
    out = sorted(done)
    for j, k in zip(out, out[1:]):  # blank lines between deleted ones
        if k > j + 1 and not any(words[j + 1 : k]):
            done.update(range(j + 1, k))
    return sorted(done)


def _lines(min_block_words: int):
    """key, first (id), hashes and words of each line, and the keys: hashes of the lines with
    words and of the least runs."""

    def run(batches):
        for batch in batches:
            for chunk in C.text_chunks(batch.column(2)):
                yield _line_rows(batch, chunk, min_block_words)

    return run


def _line_rows(batch, chunk, min_block_words: int) -> pa.RecordBatch:
    data, offs = chunk.data, chunk.offs
    starts, _, _ = C.word_spans(data, offs)
    breaks = np.flatnonzero(data == 0x0A)
    # a text's lines start at its start and after each newline, and end before the next newline or its end
    begin = np.sort(np.concatenate([offs[:-1], breaks + 1]), kind="stable")
    finish = np.sort(np.concatenate([offs[1:], breaks]), kind="stable")
    doc_first = np.zeros(chunk.n + 1, dtype=np.int64)
    np.cumsum(np.searchsorted(breaks, offs[1:]) - np.searchsorted(breaks, offs[:-1]) + 1, out=doc_first[1:])
    raw = data.tobytes()
    digests = np.frombuffer(b"".join([blake2b(raw[s:e], digest_size=16).digest() for s, e in zip(begin.tolist(), finish.tolist())]), dtype=np.int64).reshape(-1, 2)
    hashes = digests[:, 0].copy()
    words = np.searchsorted(starts, finish) - np.searchsorted(starts, begin)
    total = np.zeros(len(words) + 1, dtype=np.int64)
    np.cumsum(words, out=total[1:])
    text = np.repeat(np.arange(chunk.n), np.diff(doc_first))
    worded = np.flatnonzero(words)
    start = np.concatenate([worded, np.searchsorted(total, total[worded + 1] - min_block_words, "right") - 1])
    end = np.concatenate([np.searchsorted(total, total[worded] + min_block_words), worded + 1])
    of = np.concatenate([text[worded], text[worded]])
    inside = (start >= doc_first[of]) & (end <= doc_first[of + 1])
    start, end, of = start[inside], end[inside], of[inside]
    # a run's key is a digest of its lines' digests (runs that collide only make a pair more)
    flat = digests.tobytes()
    runs = b"".join([blake2b(flat[16 * s : 16 * e], digest_size=8).digest() for s, e in zip(start.tolist(), end.tolist())])
    keys = np.concatenate([hashes[worded], np.frombuffer(runs, dtype=np.int64)])
    of = np.concatenate([text[worded], of])
    order = np.lexsort((keys, of))
    keys, of = keys[order], of[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = (keys[1:] != keys[:-1]) | (of[1:] != of[:-1])
    keys, of = keys[new], of[new]
    key_first = np.searchsorted(of, np.arange(chunk.n + 1)).astype(np.int32)
    offsets = pa.array(doc_first.astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [
            batch.column(0).slice(chunk.first, chunk.n),
            batch.column(1).slice(chunk.first, chunk.n),
            pa.ListArray.from_arrays(offsets, pa.array(hashes)),
            pa.ListArray.from_arrays(offsets, pa.array(digests[:, 1].copy())),
            pa.ListArray.from_arrays(offsets, pa.array(words.astype(np.int32))),
            pa.ListArray.from_arrays(pa.array(key_first), pa.array(keys)),
        ],
        ["key", "id", "hashes", "checks", "words", "keys"],
    )


def _align(min_block_words: int):
    def run(batches):
        for batch in batches:
            nid, *columns = batch.columns
            rows = zip(*(c.to_pylist() for c in columns))
            drop = [common_lines(list(zip(a, a2)), list(zip(b, b2)), w, min_block_words) for a, a2, b, b2, w in rows]
            yield pa.RecordBatch.from_arrays([nid, pa.array(drop, pa.list_(pa.int32()))], ["nid", "drop"])

    return run


def text_key(col: Column) -> Column:
    return F.md5(col.cast("string").cast("binary"))


def removals(docs: DataFrame, min_block_words: int = MIN_BLOCK_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per distinct text: key, first (the id that keeps it), n_lines, n_words, drop (line
    numbers that its first document loses, sorted)."""
    text = F.col(text_col).cast("string")
    src = docs.filter(F.col(text_col).isNotNull()).select(text_key(text).alias("key"), F.col(id_col).alias("id"), text.alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    rows = src.mapInArrow(_lines(min_block_words), f"key string, id {kind}, hashes array<long>, checks array<long>, words array<int>, keys array<long>")
    one = rows.groupBy("key").agg(F.min("id").alias("first"), F.first("hashes").alias("hashes"), F.first("checks").alias("checks"), F.first("words").alias("words"), F.first("keys").alias("keys"))
    texts = C.store(one.select(F.monotonically_increasing_id().alias("nid"), "*"), "texts")
    order = F.struct(F.col("first").isNull().alias("late"), F.col("first").alias("id"), F.col("nid").alias("nid"))
    held = texts.select("nid", order.alias("at"), F.explode("keys").alias("held"))
    owners = held.groupBy("held").agg(F.min("at").alias("owner"), F.count(F.lit(1)).alias("texts")).filter("texts > 1").select("held", F.col("owner.nid").alias("owner"))
    pairs = held.select("held", "nid").join(owners, "held").filter("nid != owner").select("nid", "owner").distinct()
    a = texts.select(F.col("nid").alias("owner"), F.col("hashes").alias("a"), F.col("checks").alias("a2"))
    b = texts.select("nid", F.col("hashes").alias("b"), F.col("checks").alias("b2"), "words")
    both = pairs.join(b, "nid").join(a, "owner").select("nid", "a", "a2", "b", "b2", "words")
    gone = both.mapInArrow(_align(min_block_words), "nid long, drop array<int>")
    per_text = gone.select("nid", F.explode("drop").alias("line")).distinct().groupBy("nid").agg(F.sort_array(F.collect_list("line")).alias("drop"))
    out = texts.join(C.store(per_text, "drops"), "nid", "left")
    return out.select("key", "first", F.size("hashes").alias("n_lines"), F.aggregate("words", F.lit(0), lambda s, x: s + x).alias("n_words"), F.coalesce("drop", F.array().cast("array<int>")).alias("drop"))


def dedup_lines(docs: DataFrame, min_block_words: int = MIN_BLOCK_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the same columns, ``text_col`` without the deleted lines, and
    ``n_lines`` and ``n_removed`` in a struct column ``line_dedup`` (one of that name in
    ``docs`` is replaced)."""
    found = C.store(removals(docs, min_block_words, id_col, text_col), "removals")
    keyed = docs.select(C.packed(docs), text_key(docs[text_col]).alias("at"))
    both = keyed.join(found, F.col("at") == F.col("key"), "left")
    given = F.col("row").getField(text_col).cast("string")
    copy = ~F.col("row").getField(id_col).eqNullSafe(F.col("first")) & (F.col("n_words") >= min_block_words)
    kept = F.filter(F.split(given, "\n", -1), lambda x, i: ~F.array_contains("drop", i))
    text = F.when(copy, F.lit("")).when(F.size("drop") > 0, F.array_join(kept, "\n")).otherwise(given)
    removed = F.when(copy, F.col("n_lines")).otherwise(F.coalesce(F.size("drop"), F.lit(0)))
    info = F.struct(F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"), F.coalesce(removed, F.lit(0)).cast("long").alias("n_removed"))
    back = [text.alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns if c != "line_dedup"]
    return both.select(*back, info.alias("line_dedup"))


def drop_repeated(docs: DataFrame, min_block_words: int = MIN_BLOCK_WORDS) -> DataFrame:
    """``docs`` (all columns; ``n_chars`` follows the text) without the deleted lines;
    documents that lose their last line go."""
    done = dedup_lines(docs, min_block_words)
    left = done.filter((F.col("line_dedup.n_removed") == 0) | F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
    return left.select(*[F.when(F.col("line_dedup.n_removed") > 0, F.length("text").cast(docs.schema[c].dataType)).otherwise(F.col(c)).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])
