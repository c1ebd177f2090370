"""Spelling variant grouping by blocked Gram matrices of letter counts (operator 13).

1. ``vocabulary`` counts the words of all texts (one aggregate, pre-aggregated in each task).
2. A word becomes the vector of its letter counts. An inserted or deleted letter moves it by a
   squared distance of 1, a replaced one by 2, so near words are at most 2 apart and their
   lengths differ by at most 1. Letters are dealt to six groups; a word's block is its
   number of letters in each group (their sum is its length). One edit changes one of these
   numbers by one, or two of them by one each way: every near pair lies in one block or in
   two adjacent ones. Each pair of blocks belongs to one of the two, to which the words of
   the other are copied (22 copies a word), so no pair is seen twice.
3. Per block one NumPy product of the letter-count matrices (a Gram matrix) gives all dot
   products and with the norms the squared distances. Pairs at 1, or at 2 with equal lengths,
   are verified letter by letter. A block of over ``TILE`` words is cut into tiles: a task
   holds one tile, and the block's and its neighbours' words stream past it.
4. A word's form is its most frequent near word, if that is ``ratio`` times as frequent; roots
   are found by following forms, two steps at a time (counts grow by ``ratio`` with each
   step, so a chain is at most 27 long).

Defined results: a null or empty text has no words; a null id is written as an empty text in
the damage key. Rows that repeat are counted each. Words at or over 256 letters of a group are
in the block of 255, which keeps them complete: their distance is exact. Ties of counts go to
the word that is first in code point order. An empty table gives no rows. Other columns,
whatever their names, do not matter.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import common as C

#: Letters of a word, after lower-casing A-Z.
LETTERS = "a-zÀ-ÿ"
MIN_LETTERS = 6
MIN_COUNT = 5
RATIO = 5
GROUPS = 6
TILE = 8192
#: Words compared with a tile at once, and the largest product in numbers.
STEP = 4096
PRODUCT = 1 << 22
#: Words above this length are verified one pair at a time.
LONG_WORD = 64

_FULL = 255
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_az(col: Column) -> Column:
    return F.translate(col, _UPPER, _LOWER)


def damaged(docs: DataFrame, every: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word) per run of letters of ``MIN_LETTERS`` or more after losing, in one of ``every``
    pairs of document and run (by crc32), the letter that the checksum points at. A run of
    exactly ``MIN_LETTERS`` that loses one is too short and is left out."""
    run = F.explode(F.regexp_extract_all(lower_az(F.col(text_col).cast("string")), F.lit(f"([{LETTERS}]{{{MIN_LETTERS},}})"), F.lit(1)))
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), run.alias("run"))
    hashed = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"), F.length("run").alias("n"))
    at = (F.col("h") % F.col("n")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.col("n")))
    return hashed.select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word")).filter(F.length("word") >= MIN_LETTERS)


def vocabulary(words: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words that occur ``min_count`` times or more."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


# ------------------------------------------------------------------ blocks


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all words in a row, the word of each, and the lengths."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    return flat, np.repeat(np.arange(len(words)), lengths), lengths


def blocks(words: list[str]) -> np.ndarray:
    """Number of letters per group of each word (at most 255), one row a word."""
    flat, of, _ = _codes(words)
    counts = np.bincount(of * GROUPS + flat % GROUPS, minlength=len(words) * GROUPS)
    return np.minimum(counts.reshape(len(words), GROUPS), _FULL)


def _shifts() -> Iterator[np.ndarray]:
    """What takes a word's block to the blocks that own its pairs: itself, the blocks one
    letter shorter, and those with a letter of one group moved to a later group."""
    yield np.zeros(GROUPS, dtype=np.int64)
    for g in range(GROUPS):
        one = np.zeros(GROUPS, dtype=np.int64)
        one[g] = -1
        yield one
        for h in range(g + 1, GROUPS):
            two = one.copy()
            two[h] = 1
            yield two


_WEIGHTS = 1 << (8 * np.arange(GROUPS, dtype=np.int64))


def _homes(batches):
    """(owner): each word's own block."""
    for batch in batches:
        words = batch.column(0).to_pylist()
        if words:
            yield pa.RecordBatch.from_arrays([pa.array(blocks(words) @ _WEIGHTS)], ["owner"])


def _copies(batches):
    """(owner, home, word, n): the word for each block that owns pairs of its block."""
    for batch in batches:
        words = batch.column(0).to_pylist()
        if not words:
            continue
        at = blocks(words)
        owners, rows, home = [], [], []
        for k, shift in enumerate(_shifts()):
            to = at + shift
            ok = np.flatnonzero(((to >= 0) & (to <= _FULL)).all(axis=1))
            owners.append(to[ok] @ _WEIGHTS)
            rows.append(ok)
            home.append(np.full(len(ok), k == 0))
        rows = np.concatenate(rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(owners)), pa.array(np.concatenate(home)), batch.column(0).take(pa.array(rows)), batch.column(1).take(pa.array(rows))],
            ["owner", "home", "word", "n"],
        )


# ------------------------------------------------------------------ Gram matrices


def _vectors(words: list[str], letters: dict[int, int]) -> np.ndarray:
    """Letter counts, one row a word, over ``letters`` (code point to column) and a last
    column that no letter of ``letters`` has."""
    flat, of, _ = _codes(words)
    values, where = np.unique(flat, return_inverse=True)
    columns = np.array([letters.get(int(v), len(letters)) for v in values], dtype=np.int64)
    width = len(letters) + 1
    return np.bincount(of * width + columns[where], minlength=len(words) * width).reshape(len(words), width)


def _one_edit(a: str, b: str) -> bool:
    """Exactly one letter inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def _verified(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``_one_edit`` for two arrays of words, side by side."""
    width = max(a.dtype.itemsize, b.dtype.itemsize) // 4
    if not len(a):
        return np.zeros(0, dtype=bool)
    if width > LONG_WORD:
        return np.fromiter((_one_edit(x, y) for x, y in zip(a.tolist(), b.tolist())), bool, len(a))
    la, lb = np.char.str_len(a), np.char.str_len(b)
    swap = la > lb
    short, full = np.where(swap, b, a).astype(f"U{width + 1}"), np.where(swap, a, b).astype(f"U{width + 1}")
    x, y = (w.view(np.uint32).reshape(len(w), width + 1) for w in (short, full))
    ls, lf = np.minimum(la, lb), np.maximum(la, lb)
    same = x == y
    first = np.argmin(same, axis=1)  # the padding agrees, so words that are equal give 0
    cols = np.arange(width + 1)
    after = cols > first[:, None]
    replaced = (ls == lf) & ~same.all(axis=1) & (same | ~after).all(axis=1)
    # a letter more at ``first``: what follows there is what stands at ``first`` in the shorter word
    shifted = np.concatenate([y[:, 1:], np.zeros((len(y), 1), dtype=y.dtype)], axis=1)
    inserted = (lf == ls + 1) & ((x == shifted) | (cols < first[:, None])).all(axis=1)
    return replaced | inserted


class _Tile:
    """Words of one tile of a block, against which others are compared."""

    def __init__(self, words: list[str], counts: list[int]):
        self.words, self.n = np.array(words), np.array(counts, dtype=np.int64)
        self.lengths = np.char.str_len(self.words)
        self.letters = {int(v): k for k, v in enumerate(np.unique(_codes(words)[0]))}
        # float32 is exact for whole numbers below 2**24
        self.kind = np.float32 if int(self.lengths.max()) < 2000 else np.float64
        vectors = _vectors(words, self.letters)
        self.norms = (vectors * vectors).sum(axis=1)
        self.vectors = vectors[:, :-1].astype(self.kind)

    def pairs(self, words: list[str], counts: list[int], itself: bool, ordered: bool):
        """Verified pairs (a, n_a, b, n_b) of a word of the tile and one of ``words``.
        ``itself``: ``words`` are the tile's; ``ordered``: only where the tile's word is smaller."""
        others, n = np.array(words), np.array(counts, dtype=np.int64)
        vectors = _vectors(words, self.letters)
        # a letter that the tile lacks adds to the distance by its own count; more than two never pair
        flat, of, lengths = _codes(words)
        norms = (vectors[:, :-1] ** 2).sum(axis=1)
        foreign = vectors[:, -1]
        use = np.flatnonzero(foreign <= 2)
        if not len(use):
            return
        b = vectors[use, :-1].astype(self.kind)
        step = max(1, PRODUCT // len(use))
        for start in range(0, len(self.words), step):
            a = self.vectors[start : start + step]
            apart = self.norms[start : start + step, None] + (norms[use] + foreign[use])[None, :] - 2 * (a @ b.T)
            if itself:
                apart[np.arange(len(a))[:, None] + start >= use[None, :]] = 9
            i, j = np.nonzero((apart > 0.5) & (apart < 2.5))
            i, j = i + start, use[j]
            fit = np.abs(self.lengths[i] - lengths[j]) <= 1
            i, j = i[fit], j[fit]
            if ordered:
                less = self.words[i] < others[j]
                i, j = i[less], j[less]
            good = _verified(self.words[i], others[j])
            i, j = i[good], j[good]
            if len(i):
                yield self.words[i], self.n[i], others[j], n[j]


def _groups(batches):
    """Runs of equal (owner, tile, kind) of the sorted rows as (key, kind, words, counts),
    at most ``STEP`` words of kind 1 and 2 at once; the tile itself (kind 0) whole."""
    key, words, counts = None, [], []
    for batch in batches:
        owner, tile, kind = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        if not len(owner):
            continue
        word, n = batch.column(3).to_pylist(), batch.column(4).to_pylist()
        new = np.flatnonzero((owner[1:] != owner[:-1]) | (tile[1:] != tile[:-1]) | (kind[1:] != kind[:-1])) + 1
        edges = [0, *new.tolist(), len(owner)]
        for s, e in zip(edges, edges[1:]):
            this = (int(owner[s]), int(tile[s]), int(kind[s]))
            if this != key and words:
                yield key, words, counts
                words, counts = [], []
            key = this
            words += word[s:e]
            counts += n[s:e]
            while key[2] and len(words) > STEP:
                yield key, words[:STEP], counts[:STEP]
                words, counts = words[STEP:], counts[STEP:]
    if words:
        yield key, words, counts


def _near(batches):
    out, tile, at = [], None, None
    for (owner, number, kind), words, counts in _groups(batches):
        if kind == 0:
            tile, at = _Tile(words, counts), (owner, number)
        elif (owner, number) != at:
            continue  # a block that no word is in
        out += tile.pairs(words, counts, kind == 0, kind == 1)
        if sum(len(x[0]) for x in out) >= 1 << 16:
            yield _pairs_batch(out)
            out = []
    if out:
        yield _pairs_batch(out)


def _pairs_batch(found) -> pa.RecordBatch:
    cols = [np.concatenate([x[k] for x in found]) for k in range(4)]
    return pa.RecordBatch.from_arrays([pa.array(cols[0].tolist(), pa.string()), pa.array(cols[1]), pa.array(cols[2].tolist(), pa.string()), pa.array(cols[3])], ["a", "n_a", "b", "n_b"])


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b): every pair of near words of ``words`` (word, n; stored) once."""
    copies = words.select("word", "n").mapInArrow(_copies, "owner long, home boolean, word string, n long")
    # blocks of more than a tile: at most (words / TILE) rows
    heavy = C.store(words.select("word").mapInArrow(_homes, "owner long").groupBy("owner").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > TILE).select("owner", F.ceil(F.col("size") / TILE).cast("int").alias("tiles")), "spell-heavy")
    tiled = copies.join(heavy, "owner", "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    own = F.when(F.col("home"), F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int"))
    to = tiled.withColumn("own", own).select("owner", "word", "n", "home", "own", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"))
    kind = F.when(F.col("own") == F.col("tile"), 0).when(F.col("home"), 1).otherwise(2)
    dealt = to.select("owner", "tile", kind.alias("kind"), "word", "n").repartition("owner", "tile").sortWithinPartitions("owner", "tile", "kind")
    return dealt.mapInArrow(_near, "a string, n_a long, b string, n_b long")


# ------------------------------------------------------------------ forms and roots


def group_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for a table of distinct words (word, n)."""
    words = C.store(words.select("word", "n"), "spell-words")
    pairs = C.store(near_pairs(words), "spell-pairs")
    ways = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("other_n")).unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("n_a").alias("other_n")))
    best = ways.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("other"))).alias("best"))
    known = words.join(best, "word", "left")
    good = -F.col("best.less") >= F.lit(ratio) * F.col("n")
    formed = C.store(
        known.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(good, F.col("best.other")).alias("form"), F.when(good, -F.col("best.less")).alias("form_n")),
        "spell-forms",
    )
    steps = formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:  # each round doubles the way that is followed
        onward = steps.select(F.col("word").alias("via"), F.col("root").alias("next"))
        moved = C.store(steps.join(onward, steps["root"] == onward["via"], "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spell-roots")
        steps = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            break
    return formed.join(steps, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
