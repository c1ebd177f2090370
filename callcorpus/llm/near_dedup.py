"""Near-duplicate documents by BagMinHash (operator 6).

Similarity: weighted Jaccard of the multisets of five-word shingles (sum of the smaller
counts over sum of the larger ones), 0.8 or more.

* Signature: for each shingle, Poisson processes over discretised weights. The weight axis
  is cut into (0, 1], (1, 2], (2, 4], (4, 8], ...; each cut has its own process of rate
  ``registers * length``, seeded by shingle and cut. A point carries a register and a unit of
  weight; it counts if the shingle's count reaches that unit. A register keeps its smallest
  point, so two registers agree with the probability of the weighted Jaccard similarity,
  without bias. Points come in ascending order and stop at a bound that all registers have
  reached; texts whose registers are not all filled go on with a higher bound.
* Copies of one text are one node. Nodes whose signatures agree in a band of 4 registers
  share a bucket. Each bucket has a head: the node that shares most bands over all of its
  buckets (the centre of a family of variants). Every node is compared with the heads of its
  buckets, never with all members.
* Nodes that miss a head are queries, by signature, against all members of that bucket, in
  tiles. A pair is taken up in the first band that it shares. Inside a tile the pairs are
  verified from the closest down; only a pair whose ends are already linked (by the heads or
  by verified pairs of the tile) is left out, so no class is lost, and a tile gives a tree
  of links, never all pairs of a family.
* A pair is verified on the full multisets (a signature estimate below 0.66, four
  standard errors under 0.8, is not verified). Classes are the connected components of the
  verified pairs.

With 32 bands a pair of similarity 0.8 shares no band with probability 5e-8.

Defined results: a text of one to four words is one shingle. Null text and text without
words is a class of its own row (class_id is its own doc_id). Equal texts are always in one
class. ``class_id`` is the smallest doc_id of the class. Repeated rows are judged alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import common as C
from .components import components

WORDS = 5
REGISTERS = 128
ROWS = 4
BANDS = REGISTERS // ROWS
THRESHOLD = 0.8
_DOUBT = 0.66
#: Nodes on a side of the tiles in which a bucket's members are compared.
TILE = 1024
_U = np.uint64


def shingle_counts(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle hash, count) of a chunk, ordered by text and hash."""
    starts, ends, first = C.word_spans(data, offs)
    hashes = C.span_hashes(C.prefix_sums(data), starts, ends)
    win, wfirst = C.window_hashes(hashes, first, WORDS)
    text = np.repeat(np.arange(len(offs) - 1), np.diff(wfirst))
    few = np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < WORDS))
    if len(few):
        whole = [C.window_hashes(hashes[first[i] : first[i + 1]], np.array([0, first[i + 1] - first[i]]), int(first[i + 1] - first[i]))[0][0] for i in few]
        win, text = np.concatenate([win, np.array(whole, dtype=np.uint64)]), np.concatenate([text, few])
    order = np.lexsort((win, text))
    win, text = win[order], text[order]
    new = np.ones(len(win), dtype=bool)
    new[1:] = (win[1:] != win[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    return text[at], win[at], np.diff(np.append(at, len(win)))


def signatures(text: np.ndarray, shingle: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
    """uint32 (n, REGISTERS); rows of texts without shingles stay 0."""
    best = np.full(n * REGISTERS, np.inf)
    weight = np.bincount(text, weights=count, minlength=n)
    todo, reach = np.flatnonzero(weight > 0), 8.0
    while len(todo):
        mine = np.zeros(n, dtype=bool)
        mine[todo] = True
        use = mine[text]
        _points(text[use], shingle[use], count[use], reach / np.maximum(weight, 1), best)
        todo = todo[np.isinf(best.reshape(n, REGISTERS)[todo]).any(axis=1)]
        reach *= 2
    best[np.isinf(best)] = 0
    return (C.mix64(best.view(np.uint64)) >> _U(32)).astype(np.uint32).reshape(n, REGISTERS)


def _times_gold(n: int) -> np.ndarray:
    return np.array([n], dtype=np.uint64) * C._GOLD


def _points(text: np.ndarray, shingle: np.ndarray, count: np.ndarray, bound: np.ndarray, best: np.ndarray) -> None:
    """Lower ``best`` by all points below each text's bound."""
    cut, low, length = 0, 0, 1  # the weights (low, low + length]
    while len(text):
        seed = C.mix64(shingle ^ C.mix64(_times_gold(cut + 1)))
        t, s, w, lim = text, seed, count, bound[text]
        x = np.zeros(len(t))
        step = 0
        while len(t):
            step += 1
            u = C.mix64(s + _times_gold(step))
            x = x - np.log(((u >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53) / (REGISTERS * length)
            keep = x < lim
            t, s, w, lim, x, u = t[keep], s[keep], w[keep], lim[keep], x[keep], u[keep]
            r = C.mix64(u ^ C._MIX1)
            if length > 1:
                unit = low + 1 + (((r >> _U(32)) * _U(length)) >> _U(32)).astype(np.int64)
                ok = unit <= w
                np.minimum.at(best, t[ok] * REGISTERS + (r[ok] & _U(REGISTERS - 1)).astype(np.int64), x[ok])
            else:
                np.minimum.at(best, t * REGISTERS + (r & _U(REGISTERS - 1)).astype(np.int64), x)
        low, length, cut = (low + length, max(1, low + length), cut + 1)
        more = count > low
        text, shingle, count = text[more], shingle[more], count[more]


def bands(sig: np.ndarray) -> np.ndarray:
    """int64 (n, BANDS): a key per band of ROWS registers."""
    acc = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * C._GOLD, (len(sig), BANDS)).copy()
    parts = sig.reshape(len(sig), BANDS, ROWS).astype(np.uint64)
    for j in range(ROWS):
        acc = C.mix64(acc ^ (parts[:, :, j] + _times_gold(j + 1)))
    return acc.view(np.int64)


def _sign(batches):
    for batch in batches:
        for chunk in C.text_chunks(batch.column(2)):
            text, shingle, count = shingle_counts(chunk.data, chunk.offs)
            sig = signatures(text, shingle, count, chunk.n)
            some = np.bincount(text, minlength=chunk.n) > 0
            keys = bands(sig)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(chunk.first, chunk.n),
                    batch.column(1).slice(chunk.first, chunk.n),
                    pa.array([x.tobytes() if ok else None for x, ok in zip(sig, some)], pa.binary()),
                    pa.array([list(k) if ok else None for k, ok in zip(keys, some)], pa.list_(pa.int64())),
                ],
                ["key", "id", "sig", "bands"],
            )


def _multisets(batches):
    """nid, shingles: little-endian uint64 hashes in order, then uint32 counts."""
    for batch in batches:
        for chunk in C.text_chunks(batch.column(1)):
            text, shingle, count = shingle_counts(chunk.data, chunk.offs)
            at = np.searchsorted(text, np.arange(chunk.n + 1))
            rows = [shingle[a:b].tobytes() + count[a:b].astype(np.uint32).tobytes() for a, b in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(chunk.first, chunk.n), pa.array(rows, pa.binary())], ["nid", "bag"])


def similarity(a: bytes, b: bytes) -> float:
    """Weighted Jaccard of two bags of ``_multisets``."""
    n, m = len(a) // 12, len(b) // 12
    x, y = np.frombuffer(a, np.uint64, n), np.frombuffer(b, np.uint64, m)
    cx, cy = np.frombuffer(a, np.uint32, n, 8 * n).astype(np.int64), np.frombuffer(b, np.uint32, m, 8 * m).astype(np.int64)
    at = np.searchsorted(y, x)
    hit = at < m
    hit[hit] = y[at[hit]] == x[hit]
    same = int(np.minimum(cx[hit], cy[at[hit]]).sum())
    whole = int(cx.sum() + cy.sum()) - same
    return same / whole if whole else 0.0


def _estimate(batches):
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint32).reshape(-1, REGISTERS) for i in (2, 3))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array((a == b).mean(axis=1))], ["lo", "hi", "estimate"])


def _verify(batches):
    for batch in batches:
        sims = [similarity(a, b) for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sims, pa.float64())], ["lo", "hi", "similarity"])


def text_key(col: Column) -> Column:
    return F.md5(col.cast("string").cast("binary"))


def nodes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per distinct text: nid, key, id (smallest), sig, bands (null without words)."""
    text = F.col(text_col).cast("string")
    src = docs.filter(F.col(text_col).isNotNull()).select(text_key(text).alias("key"), F.col(id_col).alias("id"), text.alias("text"))
    signed = src.mapInArrow(_sign, f"key string, id {src.schema['id'].dataType.simpleString()}, sig binary, bands array<long>")
    one = signed.groupBy("key").agg(F.min("id").alias("id"), F.first("sig").alias("sig"), F.first("bands").alias("bands"))
    return C.store(one.select(F.monotonically_increasing_id().alias("nid"), "*"), "nodes")


def links(node: DataFrame, docs: DataFrame, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """Verified pairs (lo, hi, similarity) of nodes."""
    rows = node.filter("bands IS NOT NULL").select("nid", F.explode("bands").alias("band"))
    shared = C.store(rows.groupBy("band").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "buckets")
    members = C.store(rows.join(shared, "band").select("band", "nid", "size"), "members")
    popular = C.store(members.groupBy("nid").agg(F.sum("size").alias("popular")), "popular")
    # what the comparisons need, for the nodes that share a bucket only
    sigs = C.store(node.select("nid", "key", "sig").join(popular, "nid"), "sigs")
    text = F.col(text_col).cast("string")
    wanted = docs.select(text_key(text).alias("key"), text.alias("text")).join(sigs.select("key", "nid"), "key")
    bags = C.store(wanted.groupBy("nid").agg(F.first("text").alias("text")).mapInArrow(_multisets, "nid long, bag binary"), "bags")

    head = members.join(popular, "nid").groupBy("band").agg(F.max(F.struct("popular", "nid")).alias("h")).select("band", F.col("h.nid").alias("head"))
    tries = C.store(members.join(head, "band").filter("nid != head").select("band", "nid", "size", "head"), "tries")
    pairs = tries.select(F.least("nid", "head").alias("lo"), F.greatest("nid", "head").alias("hi")).distinct()
    judged = C.store(_judge(C.store(pairs, "pairs"), sigs, bags), "judged")
    ok = judged.filter(F.col("similarity") >= threshold).select(F.col("lo").alias("l"), F.col("hi").alias("h"))
    missed = tries.join(ok, (F.least("nid", "head") == F.col("l")) & (F.greatest("nid", "head") == F.col("h")), "left_anti")
    linked = C.store(components(ok, "l", "h"), "linked")
    placed = members.join(linked, F.col("nid") == F.col("node"), "left").select("band", "nid", F.coalesce("root", "nid").alias("root"))
    late = _within(C.store(missed.select("band", "nid"), "missed"), C.store(placed, "placed"), sigs, bags, threshold)
    return judged.filter(F.col("similarity") >= threshold).unionByName(late)


def _within(missed: DataFrame, members: DataFrame, sigs: DataFrame, bags: DataFrame, threshold: float) -> DataFrame:
    """Verified pairs (lo, hi, similarity) of a node that missed a head and another member
    of that bucket with another root. The missed nodes are queries against all members of their
    bucket, in tiles of about TILE by TILE nodes, one row per tile; multisets are joined
    only to the nodes of a tile whose signatures do not rule out every pair."""
    flagged = members.join(missed.withColumn("missed", F.lit(True)), ["band", "nid"], "left")
    size = flagged.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.count("missed").alias("f"), F.min("root").alias("r"), F.max("root").alias("s")).filter("f > 0 AND r != s")
    size = C.store(size.select("band", F.ceil(F.col("f") / TILE).cast("int").alias("across"), F.ceil(F.col("n") / TILE).cast("int").alias("down")), "tiles")
    at = C.store(flagged.join(size, "band").withColumn("missed", F.coalesce("missed", F.lit(False))), "blocks")
    spot = F.xxhash64("nid")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    queries = at.filter("missed").select("band", "nid", "root", "missed", F.lit(True).alias("query"), F.pmod(spot, "across").cast("int").alias("x"), each("down").alias("y"))
    others = at.select("band", "nid", "root", "missed", F.lit(False).alias("query"), each("across").alias("x"), F.pmod(spot, "down").cast("int").alias("y"))
    rows = queries.unionByName(others).join(sigs.select("nid", "sig"), "nid")
    fields = ["nid", "root", "missed", "query", "sig"]
    tile = lambda df, names: df.groupBy("band", "x", "y").agg(F.collect_list(F.struct(*names)).alias("m")).select("band", "x", "y", *[f"m.{c}" for c in names])
    wanted = C.store(tile(rows, fields).mapInArrow(_compare, "band long, x int, y int, nid long, root long, missed boolean, query boolean, sig binary"), "wanted")
    return C.store(tile(wanted.join(bags, "nid"), [*fields, "bag"]).mapInArrow(_link(threshold), "lo long, hi long, similarity double"), "late").groupBy("lo", "hi").agg(F.max("similarity").alias("similarity"))


class _Tile:
    """Queries and members of a tile."""

    def __init__(self, nid, root, missed, query, sig):
        self.ids, self.missed, self.query = np.array(nid), np.array(missed), np.array(query)
        self.group = np.unique(root, return_inverse=True)[1]
        self.sigs = np.frombuffer(b"".join(sig), np.uint32).reshape(-1, REGISTERS)
        self.members = np.flatnonzero(~self.query)

    def near(self, q: int, band: int, keys: np.ndarray) -> np.ndarray:
        """Members, from the closest down, that query ``q`` has to be verified against here:
        of another group, not ruled out, in the first band that both share; of two queries
        the one of the smaller id asks."""
        m = self.members
        m = m[(self.group[m] != self.group[q]) & (~self.missed[m] | (self.ids[m] > self.ids[q]))]
        estimate = (self.sigs[m] == self.sigs[q]).mean(axis=1)
        ok = estimate >= _DOUBT
        m, estimate = m[ok], estimate[ok]
        same = keys[m] == keys[q]
        first = keys[q][same.argmax(axis=1)] == band
        m, estimate = m[first], estimate[first]
        return m[np.lexsort((self.ids[m], -estimate))]


def _compare(batches):
    """The nodes of each tile that have a pair to verify."""
    for batch in batches:
        at: list[tuple[int, int, int]] = []
        out: list[list] = [[], [], [], [], []]
        for band, x, y, *node in zip(*(c.to_pylist() for c in batch.columns)):
            t = _Tile(*node)
            keys, use = bands(t.sigs), np.zeros(len(t.ids), dtype=bool)
            for q in np.flatnonzero(t.query):
                near = t.near(q, band, keys)
                use[near] = True
                use[q] |= len(near) > 0
            for i in np.flatnonzero(use):
                at.append((band, x, y))
                for column, values in zip(out, node):
                    column.append(values[i])
        place = [pa.array([a[i] for a in at], kind) for i, kind in enumerate((pa.int64(), pa.int32(), pa.int32()))]
        found = [pa.array(v, kind) for v, kind in zip(out, (pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary()))]
        yield pa.RecordBatch.from_arrays([*place, *found], ["band", "x", "y", "nid", "root", "missed", "query", "sig"])


def _link(threshold: float):
    def run(batches):
        for batch in batches:
            found: list[tuple[int, int, float]] = []
            for band, _, _, *node, bag in zip(*(c.to_pylist() for c in batch.columns)):
                t = _Tile(*node)
                keys = bands(t.sigs)
                for q in np.flatnonzero(t.query):
                    near = t.near(q, band, keys)
                    while len(near):
                        m, near = near[0], near[1:]
                        sim = similarity(bag[q], bag[m])
                        if sim >= threshold:
                            found.append((int(min(t.ids[q], t.ids[m])), int(max(t.ids[q], t.ids[m])), sim))
                            t.group[t.group == t.group[m]] = t.group[q]
                            near = near[t.group[near] != t.group[q]]
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.float64()))], ["lo", "hi", "similarity"])

    return run


def _judge(pairs: DataFrame, sigs: DataFrame, bags: DataFrame) -> DataFrame:
    """(lo, hi, similarity): exact where the signatures leave a doubt, else the estimate."""
    s = sigs.select("nid", "sig")
    both = pairs.join(s.toDF("lo", "a"), "lo").join(s.toDF("hi", "b"), "hi").select("lo", "hi", "a", "b")
    rough = C.store(both.mapInArrow(_estimate, "lo long, hi long, estimate double"), "rough")
    close = rough.filter(F.col("estimate") >= _DOUBT).select("lo", "hi")
    exact = close.join(bags.toDF("lo", "a"), "lo").join(bags.toDF("hi", "b"), "hi").select("lo", "hi", "a", "b").mapInArrow(_verify, "lo long, hi long, similarity double")
    return exact.unionByName(rough.filter(F.col("estimate") < _DOUBT).select("lo", "hi", F.col("estimate").alias("similarity")))


def classes(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per distinct text: key, class_id (smallest doc_id of its class), class_key (the
    class), first_key (the text of the class's smallest doc_id), n_links."""
    node = nodes(docs, id_col, text_col)
    pairs = C.store(links(node, docs, threshold, text_col), "links")
    member = C.store(components(pairs, "lo", "hi"), "classes")
    ends = pairs.select(F.col("lo").alias("n")).unionByName(pairs.select(F.col("hi").alias("n")))
    degree = ends.groupBy("n").agg(F.count(F.lit(1)).alias("n_links"))
    placed = node.select("nid", "key", "id").join(member, F.col("nid") == F.col("node"), "left").join(degree, F.col("nid") == F.col("n"), "left")
    placed = C.store(placed.select("key", "id", F.coalesce("root", "nid").alias("class_key"), F.coalesce("n_links", F.lit(0)).alias("n_links")), "placed")
    least = placed.groupBy("class_key").agg(F.min(F.struct(F.col("id").isNull().alias("late"), "id", "key")).alias("m"))
    return placed.join(least, "class_key").select("key", F.col("m.id").alias("class_id"), "class_key", F.col("m.key").alias("first_key"), "n_links")


def assign(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, class_id, n_links (verified pairs of its text)."""
    found = C.store(classes(docs, threshold, id_col, text_col), "found")
    text = F.col(text_col).cast("string")
    wordless = ~F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.when(~wordless, text_key(text)).alias("key"))
    out = rows.join(found, "key", "left")
    return out.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def keep_first(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs``, all columns: one row of each class, that of the smallest doc_id. Rows
    without words are in no class and all stay."""
    found = C.store(classes(docs, threshold), "found")
    keep = found.filter("key = first_key").select("key", "class_id")
    text = docs["text"].cast("string")
    wordless = ~F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    rows = docs.filter(~wordless).select(C.packed(docs), text_key(text).alias("at"))
    stay = rows.join(keep, (F.col("at") == F.col("key")) & F.col("row").getField("doc_id").eqNullSafe(F.col("class_id")), "left_semi")
    return stay.dropDuplicates(["at"]).select("row.*").union(docs.filter(wordless))
