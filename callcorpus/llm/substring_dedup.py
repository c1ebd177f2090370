"""Removal of repeated substrings with suffix arrays (operator 1).

A byte goes if a string of ``length`` bytes that covers it also starts anywhere else, in the
same text or another one, judged on the input.

A suffix array over a whole corpus would be one object, so the work is divided by content,
in a way that keeps all occurrences of a string together:

1. Every window of ``length`` bytes is owned by its anchor: the smallest hash of ``_GRAM``
   consecutive bytes inside it. The owner depends on the window's bytes only, so equal
   windows have equal anchors at equal offsets. The windows of one anchor are a run of
   starts, and the bytes that they span are the anchor's context.
2. Anchors are counted by hash. One that occurs once owns no repeated window. Occurrences
   with equal contexts collapse: if all contexts of an anchor are equal, all its windows
   repeat. What is left are anchors with different contexts (where a repeat starts or ends).
3. Their runs are cut at fixed distances from the anchor into bands of ``_BAND`` starts. All
   windows of a band share its core; bands with the same core are gathered, equal contexts
   collapsed again, and every group becomes strings ``left core right``, the core being one
   symbol. Their suffix array (``suffix_groups``) puts equal windows next to each other: a
   window repeats if it agrees with a neighbour on the band's ``_BAND`` symbols.
   A group of more than ``_GROUP`` contexts is divided before, by the exact bytes that each
   narrower band of its windows shares, and at last by whole windows, which need counting
   only; so a passage that a third of all texts share is never sorted in one task.
4. Starts of repeated windows become spans of removed bytes.

Copies of a text are one text with a count; all windows of a text with copies repeat.
Equality of contexts is equality of two independent 64-bit hashes.

Defined results: null counts as empty; texts shorter than ``length`` lose nothing;
repeated rows are copies of each other. Empty tables give no rows. Texts of any
length are handled in pieces.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import common as C
from .suffix_groups import suffix_array

LENGTH = 200
_GRAM = 40
_BAND = 32
_GROUP = 512
_PIECE = 1 << 20
_LOW = np.uint64((1 << 22) - 1)


def _owners(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner (position of its anchor) of each window start, hash of each gram, byte sums."""
    sums = C.prefix_sums(data)
    grams = len(data) - _GRAM + 1
    at = np.arange(grams, dtype=np.int64)
    hashes = C.span_hashes(sums, at, at + _GRAM)
    width = length - _GRAM + 1
    value = (hashes & ~_LOW) | at.astype(np.uint64)  # of equal hashes the first
    blocks = -(-grams // width)
    full = np.full(blocks * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    full[:grams] = value
    rows = full.reshape(blocks, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = len(data) - length + 1
    return (np.minimum(back[:starts], ahead[width - 1 : width - 1 + starts]) & _LOW).astype(np.int64), hashes, sums


def runs(data: np.ndarray, length: int):
    """Per anchor of one text, in order: anchor position, first start, number of starts,
    anchor hash, context hash. Long texts are taken in overlapping pieces (an anchor whose
    run crosses a piece's end is then reported in two parts)."""
    out = [[], [], [], [], []]
    total = len(data) - length + 1
    for base in range(0, max(total, 0), _PIECE):
        piece = data[base : min(base + _PIECE + length - 1, len(data))]
        owner, hashes, sums = _owners(piece, length)
        new = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        n = np.diff(np.append(new, len(owner)))
        anchor = owner[new]
        context = C.span_hashes(sums, new, new + n + length - 1)
        place = C.mix64((anchor - new).astype(np.uint64) * C._GOLD + n.astype(np.uint64))  # the windows' offsets belong to the context
        for col, x in zip(out, (anchor + base, new + base, n, hashes[anchor], C.mix64(context ^ place))):
            col.append(x)
    return [np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in out]


def _anchor_rows(length: int):
    def run(batches):
        for batch in batches:
            for chunk in C.text_chunks(batch.column(1)):
                cols, counts = [[], [], [], []], []
                for i in range(chunk.n):
                    data = chunk.data[chunk.offs[i] : chunk.offs[i + 1]]
                    _, first, n, anchor, context = runs(data, length)
                    counts.append(len(first))
                    for col, x in zip(cols, (first, n, anchor.view(np.int64), context.view(np.int64))):
                        col.append(x)
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                kinds = (np.int32, np.int32, np.int64, np.int64)
                lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(c).astype(k))) for c, k in zip(cols, kinds)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(chunk.first, chunk.n), *lists], ["key", "first", "n", "anchor", "context"])

    return run


def _band_rows(length: int):
    """Bands of the runs that start at ``wanted``. A window of a band starts ``d`` bytes
    before the core (0 <= d < _BAND): it is the last ``d`` bytes of ``left``, the core, and
    the first ``_BAND - 1 - d`` bytes of ``right``."""

    def run(batches):
        core_size = length - _BAND + 1
        for batch in batches:
            out = [[], [], [], [], [], [], []]
            for key, single, text, starts in zip(*(c.to_pylist() for c in batch.columns)):
                raw = text.encode("utf-8")
                anchor, first, n, _, _ = runs(np.frombuffer(raw, dtype=np.uint8), length)
                for r in np.flatnonzero(np.isin(first, np.array(starts, dtype=np.int64))):
                    a, lo, hi = int(anchor[r]), int(first[r]), int(first[r] + n[r] - 1)
                    for band in range((a - hi) // _BAND, (a - lo) // _BAND + 1):
                        core = a - band * _BAND
                        p, q = max(lo, core - _BAND + 1), min(hi, core)
                        digest = hashlib.blake2b(raw[core : core + core_size], digest_size=16).digest()
                        for col, x in zip(out, (key, single, digest, p, q - p + 1, raw[p:core], raw[core + core_size : q + length])):
                            col.append(x)
            kinds = (pa.string(), pa.bool_(), pa.binary(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["key", "single", "core", "first", "n", "left", "right"])

    return run


_BAND_SCHEMA = "key string, single boolean, core binary, first long, n int, left binary, right binary"


def repeated_windows(groups: list[list[tuple[bytes, bytes, int]]], band: int) -> list[list[list[int]]]:
    """For each context (left, right, n) of each group: the starts 0..n-1 whose window some
    other context of the group holds too, by one suffix array over the groups' strings
    ``left core right``. The contexts of a group differ."""
    text: list[int] = []
    owned: dict[int, tuple[int, int, int]] = {}
    for g, group in enumerate(groups):
        for r, (left, right, n) in enumerate(group):
            for s in range(n):
                owned[len(text) + s] = (g, r, s)
            text += [b + 1 for b in left]
            text.append(257 + g)
            text += [b + 1 for b in right]
            text.append(0)
    found: list[list[list[int]]] = [[[] for _ in group] for group in groups]
    order = suffix_array(text)
    equal = False
    for at, i in enumerate(order):
        before, equal = equal, False
        if i not in owned:
            continue
        if at + 1 < len(order) and order[at + 1] in owned:
            j = order[at + 1]
            equal = text[i : i + band] == text[j : j + band]
        if before or equal:
            g, r, s = owned[i]
            found[g][r].append(s)
    return found


def _sort_groups(band: int):
    """Members of each group -> (key, a, b): runs of starts of repeated windows."""

    def run(batches):
        for batch in batches:
            out: list[list] = [[], [], []]
            rows: list[list] = []

            def flush():
                groups = [[(m["left"], m["right"], m["n"]) for m in members] for members in rows]
                for members, starts in zip(rows, repeated_windows(groups, band)):
                    for m, found in zip(members, starts):
                        if m["single"] and found:
                            cut = np.array(sorted(found)) + m["first"]
                            breaks = np.flatnonzero(np.diff(cut) > 1)
                            a, b = cut[np.append(0, breaks + 1)], cut[np.append(breaks, len(cut) - 1)]
                            out[0].extend([m["key"]] * len(a))
                            out[1].extend(a.tolist())
                            out[2].extend(b.tolist())
                rows.clear()

            size = 0
            for members in batch.column(0).to_pylist():
                rows.append(members)
                size += sum(len(m["left"]) + len(m["right"]) + 2 for m in members)
                if size > 20_000:
                    flush()
                    size = 0
            flush()
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64())], ["key", "a", "b"])

    return run


def _narrower(bands: DataFrame, band: int, to: int) -> DataFrame:
    """The same windows in bands of ``to`` starts; the bytes that all windows of a narrower
    band share go over from ``left`` and ``right`` to its core."""
    each = bands.select("*", F.explode(F.sequence(F.lit(0), F.lit(band - to), F.lit(to))).alias("d0"))  # distances d0 .. d0 + to - 1
    each = each.withColumn("size", F.length("left"))
    each = each.withColumn("far", F.least(F.col("size"), F.col("d0") + (to - 1))).withColumn("near", F.greatest(F.col("size") - F.col("n") + 1, F.col("d0"))).filter("far >= near")
    return each.selectExpr(
        "key", "single",
        f"unhex(md5(concat(core, encode(string(d0), 'utf-8'), substring(left, size - d0 + 1, d0), substring(right, 1, {band - to} - d0)))) AS core",
        "first + (size - far) AS first", "far - near + 1 AS n",
        "substring(left, size - far + 1, far - d0) AS left",
        f"substring(right, {band - to} - d0 + 1, {to - 1} - (near - d0)) AS right",
    )


def _resolve(bands: DataFrame, band: int) -> DataFrame:
    """(key, a, b): runs of starts of repeated windows in the texts without copies."""
    counted = bands.groupBy("core", "left", "right").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("key", "first", "n", "single")).alias("m"))
    one = C.store(counted.select("core", "left", "right", "c", "m.key", "m.first", "m.n", ((F.col("c") == 1) & F.col("m.single")).alias("single")), "contexts")
    many = one.filter("c > 1").select("core", "left", "right")
    found = bands.filter("single").join(many, ["core", "left", "right"], "left_semi").select("key", F.col("first").alias("a"), (F.col("first") + F.col("n") - 1).alias("b"))
    if band == 1:
        return found
    sizes = C.store(one.groupBy("core").agg(F.count(F.lit(1)).alias("contexts")).filter("contexts > 1"), "groups")
    member = one.join(sizes, "core")
    member_cols = ["key", "single", "core", "first", "n", "left", "right"]
    small = member.filter(F.col("contexts") <= _GROUP).groupBy("core").agg(F.collect_list(F.struct(*[c for c in member_cols if c != "core"])).alias("members"))  # at most _GROUP
    found = found.unionByName(small.select("members").mapInArrow(_sort_groups(band), "key string, a long, b long"))
    large = member.filter(F.col("contexts") > _GROUP).select(*member_cols)
    if large.isEmpty():
        return found
    to = 4 if band > 4 else 1
    return found.unionByName(_resolve(C.store(_narrower(large, band, to), "bands"), to))


def text_key(col: Column) -> Column:
    return F.md5(F.coalesce(col.cast("string"), F.lit("")).cast("binary"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, text_col: str = "text") -> DataFrame:
    """Per distinct text with repeated windows: key, copied (the text occurs twice or more),
    spans (runs a..b of starts of repeated windows; empty for copied texts)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    src = docs.select(text_key(F.col(text_col)).alias("key"), text.alias("text"))
    made = src.mapInArrow(_anchor_rows(length), "key string, first array<int>, n array<int>, anchor array<long>, context array<long>")
    table = C.store(made.select(F.monotonically_increasing_id().alias("rid"), "*"), "anchors")
    keys = C.store(table.groupBy("key").agg(F.count(F.lit(1)).alias("copies"), F.min("rid").alias("rid")), "keys")
    each = table.select("rid", F.explode(F.arrays_zip("first", "n", "anchor", "context")).alias("w")).select("rid", "w.*")
    # stored, so that a frequent anchor's rows may be split in the join
    shared = each.groupBy("anchor").agg(F.count(F.lit(1)).alias("c"), (F.min("context") == F.max("context")).alias("same")).filter("c > 1").select("anchor", "same")
    shared = C.store(shared, "shared")
    flagged = each.select("anchor", "rid", "first", "n").join(shared, "anchor").select("rid", "first", "n", "same")
    placed = C.store(flagged.join(keys, "rid").select("key", (F.col("copies") == 1).alias("single"), "first", "n", "same"), "placed")
    inside = placed.filter("same AND single").select("key", F.col("first").cast("long").alias("a"), (F.col("first") + F.col("n") - 1).cast("long").alias("b"))
    edges = placed.filter("NOT same").groupBy("key").agg(F.first("single").alias("single"), F.collect_list("first").alias("starts"))  # at most a text's anchors
    texts = src.join(edges, "key").groupBy("key").agg(F.first("single").alias("single"), F.first("text").alias("text"), F.first("starts").alias("starts"))
    bands = C.store(texts.mapInArrow(_band_rows(length), _BAND_SCHEMA), "bands")
    runs_of = inside.unionByName(_resolve(bands, _BAND))
    spans = runs_of.groupBy("key").agg(F.collect_list(F.struct("a", "b")).alias("spans"))  # at most a text's runs
    copied = keys.filter("copies > 1").select("key", F.lit(True).alias("copied"), F.array().cast("array<struct<a:bigint,b:bigint>>").alias("spans"))
    return spans.select("key", F.lit(False).alias("copied"), "spans").unionByName(copied)


def _cut(length: int):
    def run(batches):
        for batch in batches:
            cols: list[list] = [[], [], [], []]
            for text, copied, spans in zip(*(c.to_pylist() for c in batch.columns[1:])):
                raw = text.encode("utf-8")
                if copied:
                    spans = [{"a": 0, "b": len(raw) - length}] if len(raw) >= length else []
                kept, at, gone, pieces = [], 0, 0, 0
                end = -1  # of the removed run that is open
                for s in sorted(spans or [], key=lambda x: x["a"]):
                    a, b = s["a"], s["b"] + length
                    if a > end:
                        kept.append(raw[at:a])
                        pieces += 1
                        gone += b - a
                        end = at = b
                    elif b > end:
                        gone += b - end
                        end = at = b
                kept.append(raw[at:])
                for col, x in zip(cols, (len(raw), gone, pieces, b"".join(kept))):
                    col.append(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and
    ``kept`` (the remaining bytes; a cut may fall inside a character)."""
    marks = C.store(repeated_spans(docs, length, text_col), "marks").withColumnRenamed("key", "_k")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("key"), text.alias("text"))
    both = rows.join(marks, F.col("key") == F.col("_k"), "left").select("doc_id", "text", F.coalesce("copied", F.lit(False)).alias("copied"), "spans")
    return both.mapInArrow(_cut(length), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept binary")
