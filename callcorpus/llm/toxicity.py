"""Toxicity from the nearest labelled examples (operator 10).

* Examples: a bounded sample of labelled documents (about ``examples[label]`` of each
  label, by a hash of the id, one per distinct text). This is the only bounded part.
* Terms: all words of the examples and their 4-character stems. Their document frequencies
  count every document of the table. Chi-square on the sample's documents is a soft weight:
  a term that says nothing about the label keeps a twentieth of its weight.
* Every document becomes a sparse weighted TF-IDF vector; its norm covers all its words. A word
  that no example holds meets no example, and weighs in the norm what an unmarked word of
  one document weighs.
* Its neighbours are the ``k`` examples of the highest cosine, found exactly through an inverted
  index: the lists of most terms are summed, those of middle length for many documents by one
  matrix product; the longest lists are bounded by block maxima and by norms, and are looked
  up only for the examples whose bound reaches the k-th best of those scored first.
* Score: votes weighted by similarity and by the documents that an example stands for
  (its label's count over its label's sample), shrunk towards the prior; the prior is the
  share of toxic ones among sample documents without a term that marks a label (chi-square
  and lift), weighted alike.

Defined results: null or empty text has no term and gets the prior. A doc_id with several
labels counts as toxic if any is 1. Repeated rows are scored alike. Without labelled rows
every score is 0. Evidence lists the neighbours as (doc_id, similarity, label).
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from . import common as C
from .langid import held_out, sample_unit

STEM = 4
BLOCK = 64
#: Terms with the longest lists: bounded first, looked up only where the bound allows it.
COMMON = 256
#: Terms with the next longest lists: summed for BATCH documents by one matrix product.
MIDDLE = 1024
BATCH = 512
#: An example and its weight in a list; eight bytes are taken at once.
ENTRY = np.dtype([("row", np.int32), ("weight", np.float32)])
#: More than single precision can lose in a sum of COMMON + MIDDLE products of vectors of length 1.
SLACK = 2e-4
#: Examples scored before the bounds are tested.
FIRST = 32
#: What a term keeps of its weight if it says nothing about the label.
LEAST_WEIGHT = 0.05
#: Bytes of text that are encoded at once (a longer text alone).
ENCODED_BYTES = 2 << 20
_WORD = re.compile(r"[^\W\d_]+")
#: Bytes of lower-case UTF-8: every ASCII character but a letter becomes a space.
_SPACED = bytes(b if b >= 128 or chr(b).islower() else 32 for b in range(256))


def words_of(text: str) -> list[str]:
    """Runs of letters in lower case."""
    text = text.lower()
    words = text.encode("utf-8", "surrogatepass").translate(_SPACED).decode("utf-8", "surrogatepass").split()
    return words if text.isascii() else [w for x in words for w in ((x,) if x.isascii() else _WORD.findall(x))]


def pieces_of(texts: list[str | None]) -> tuple[np.ndarray, pa.DictionaryArray]:
    """The texts in lower case, cut at every ASCII character but a letter: the pieces of text
    ``i`` are ``first[i]:first[i + 1]``. Some are empty; one that is not ASCII may hold several
    words or none."""
    lower = [(t or "").lower().encode("utf-8", "replace") for t in texts]
    ends = np.cumsum([0, *map(len, lower)], dtype=np.int64)
    spaced = pa.LargeStringArray.from_buffers(len(lower), pa.py_buffer(ends), pa.py_buffer(b"".join(lower).translate(_SPACED)))
    split = pc.ascii_split_whitespace(spaced)
    return split.offsets.to_numpy(), split.flatten().dictionary_encode()


def spans(first: np.ndarray, rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places ``first[r]:first[r + 1]`` of every row, and the row's value at each."""
    size = first[rows + 1] - first[rows]
    return np.arange(size.sum()) + np.repeat(first[rows] - np.cumsum(size) + size, size), np.repeat(values, size)


def term_counts(text: str) -> Counter:
    """Words (lower case) and ``stem*`` of the longer ones, with their counts."""
    words = Counter(words_of(text))
    stems: Counter = Counter()
    for w, n in words.items():
        if len(w) > STEM:
            stems[w[:STEM] + "*"] += n
    words.update(stems)
    return words


def _explode_terms(batches):
    for batch in batches:
        for slot, toxic, text in zip(*(c.to_pylist() for c in batch.columns)):
            terms = list(term_counts(text or ""))
            yield pa.RecordBatch.from_arrays([pa.array([slot] * len(terms), pa.int64()), pa.array([toxic] * len(terms), pa.int32()), pa.array(terms, pa.string())], ["slot", "toxic", "term"])


class Vocabulary:
    """Numbers of the examples' terms, and for each word the number of its stem (or -1)."""

    def __init__(self, terms: list[str]):
        self.at = {t: i for i, t in enumerate(terms)}
        self.stem = np.array([self.at.get(t[:STEM] + "*", -1) if len(t) > STEM and not t.endswith("*") else -1 for t in terms] + [-1], dtype=np.int64)

    def __len__(self) -> int:
        return len(self.at)

    def _numbers(self, terms) -> np.ndarray:
        return np.fromiter(map(self.at.get, terms, repeat(-1)), np.int64, len(terms))

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray, float]:
        """(terms, counts) of the text's known terms in ascending order, and the sum of
        ``(1 + log count)**2`` over its other terms: the same as by ``term_counts``."""
        _, terms, counts, others = self.encode_all([text])
        return terms, counts, float(others[0])

    def encode_all(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``encode`` of many texts: (first, terms, counts, others), where text ``i`` has
        ``terms[first[i]:first[i + 1]]``, their counts and ``others[i]``."""
        ends, pieces = pieces_of(texts)
        words = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        piece, text = pieces.indices.to_numpy(), np.repeat(np.arange(len(texts)), np.diff(ends))
        plain = np.fromiter(map(str.isalpha, words), bool, len(words))
        odd, inner = np.flatnonzero(~plain).tolist(), np.zeros(len(words), dtype=np.int64)
        for i in odd:  # pieces of several words or none
            words += (found := _WORD.findall(words[i]))
            inner[i] = len(found)
        use = plain[piece]
        at, again = spans(np.append(0, np.cumsum(inner)) + len(inner), piece[~use], text[~use])
        word, text = np.append(piece[use], at), np.append(text[use], again)

        number, strange = self._numbers(words), {}  # terms that no example holds get the numbers after the others
        stem = self.stem[number]
        for i in np.flatnonzero(number < 0).tolist():
            number[i] = len(self) + strange.setdefault(words[i], len(strange))
            if len(words[i]) > STEM:
                t = words[i][:STEM] + "*"
                known = self.at.get(t)
                stem[i] = len(self) + strange.setdefault(t, len(strange)) if known is None else known
        many = len(self) + len(strange) + 1
        text = text * many
        keys, stem = text + number[word], stem[word]
        keys, counts = np.unique(np.append(keys, (text + stem)[stem >= 0]), return_counts=True)
        text, term = np.divmod(keys, many)
        known = term < len(self)
        others = np.bincount(text[~known], weights=(1 + np.log(counts[~known])) ** 2, minlength=len(texts))
        return np.searchsorted(text[known], np.arange(len(texts) + 1)), term[known], counts[known], others


@dataclass
class Index:
    """Inverted index of the examples' vectors.

    The ``COMMON`` terms with the longest lists are kept by example, with the largest weight
    per term and block of BLOCK examples. The ``MIDDLE`` next lists are rows of a matrix, summed
    for many documents by one product; the lists of all others are kept by term. A search sums
    these and looks the common terms up only for the examples whose bound can reach the k-th
    best. Products are in single precision, so the best, and every example within ``SLACK`` of
    them, are summed again from their whole vectors."""

    idf: np.ndarray  # weight of each term
    ids: list
    labels: np.ndarray
    other: float = 0.0  # weight of a term that no example holds
    place: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int32))  # by term: number among the common, then the middle ones, or -1
    term_first: np.ndarray = field(default_factory=lambda: np.zeros(1, dtype=np.int64))  # by term without a place: examples, weights
    entries: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=ENTRY))
    middle: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), dtype=np.float32))  # by middle term and example
    common: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), dtype=np.float32))  # by example and common term
    row_norm: np.ndarray = field(default_factory=lambda: np.zeros(0))  # by example: length of its common part
    block_max: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))  # by common term and block
    full_first: np.ndarray = field(default_factory=lambda: np.zeros(1, dtype=np.int64))  # by example: all terms, weights
    full_terms: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int32))
    full_weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    prior: float = 0.0
    stands_for: tuple[float, float] = (1.0, 1.0)
    rows: tuple = ()  # the examples' terms and counts, one after the other, and each example's number of terms

    def vector(self, terms: np.ndarray, counts: np.ndarray, others: float = 0.0) -> np.ndarray:
        """Weights over the norm of the whole text; ``others`` as from ``Vocabulary.encode``."""
        w = (1 + np.log(counts)) * self.idf[terms]
        return w / np.sqrt(w @ w + self.other**2 * others)

    @staticmethod
    def build(idf, ids, labels, rows, prior=0.0, stands_for=(1.0, 1.0), other=0.0) -> "Index":
        """``rows`` holds (terms, counts) of every example."""
        flat = [np.concatenate([np.asarray(r[i], dtype=np.int32) for r in rows] or [np.zeros(0, dtype=np.int32)]) for i in (0, 1)]
        ix = Index(idf, ids, np.asarray(labels, dtype=np.float64), other, prior=prior, stands_for=stands_for, rows=(*flat, np.array([len(t) for t, _ in rows], dtype=np.int64)))
        ix._invert()
        return ix

    def __getstate__(self) -> dict:
        """Only what the lists are made from is sent to the tasks."""
        return {f: getattr(self, f) for f in ("idf", "ids", "labels", "other", "prior", "stands_for", "rows")}

    def __setstate__(self, state: dict) -> None:
        self.__init__(**state)
        self._invert()

    def _invert(self) -> None:
        ix, idf, ids = self, self.idf, self.ids
        ix.place = np.full(len(idf), -1, dtype=np.int32)
        if not len(ids):
            return
        terms, counts, sizes = ix.rows
        at = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)
        weights = (1 + np.log(counts)) * idf[terms]
        weights /= np.sqrt(np.bincount(at, weights=weights**2, minlength=len(ids)))[at]
        ix.full_first, ix.full_terms, ix.full_weights = np.searchsorted(at, np.arange(len(ids) + 1)), terms, weights
        longest = np.argsort(-np.bincount(terms, minlength=len(idf)), kind="stable")[: COMMON + MIDDLE]
        ix.place[longest] = np.arange(len(longest))
        place = ix.place[terms]
        order = np.flatnonzero(place < 0)
        order = order[np.argsort(terms[order], kind="stable")]
        ix.entries = np.empty(len(order), dtype=ENTRY)
        ix.entries["row"], ix.entries["weight"] = at[order], weights[order]
        ix.term_first = np.searchsorted(terms[order], np.arange(len(idf) + 1))
        del order  # before the matrices are made
        top = (place >= 0) & (place < COMMON)
        ix.common = np.zeros((len(ids), min(COMMON, len(longest))), dtype=np.float32)
        ix.common[at[top], place[top]] = weights[top]
        ix.row_norm = np.sqrt(np.bincount(at[top], weights=weights[top] ** 2, minlength=len(ids)))
        ix.block_max = np.zeros((ix.common.shape[1], -(-len(ids) // BLOCK)))
        np.maximum.at(ix.block_max, (place[top], at[top] // BLOCK), weights[top])
        ix.middle = np.zeros((len(longest) - len(ix.block_max), len(ids)), dtype=np.float32)
        ix.middle[place[place >= COMMON] - COMMON, at[place >= COMMON]] = weights[place >= COMMON]

    def nearest(self, terms: np.ndarray, counts: np.ndarray, k: int, others: float = 0.0) -> list[tuple[float, int]]:
        """The ``k`` best (similarity, example) with similarity above 0, ties by example: exact."""
        return self.search([(terms, counts, others)], k)[0][0]

    def search(self, queries: list[tuple[np.ndarray, np.ndarray, float]], k: int) -> list[tuple[list[tuple[float, int]], int]]:
        """For each (terms, counts, others): the nearest as from ``nearest``, and the number of
        examples whose common terms were looked up."""
        if not len(self.ids):
            return [([], 0)] * len(queries)
        common = len(self.block_max)
        dense, across = np.zeros((len(queries), common)), np.zeros((len(queries), len(self.middle)), dtype=np.float32)
        vectors, short = [], []
        for i, (terms, counts, others) in enumerate(queries):
            q = self.vector(terms, counts, others) if len(terms) else np.zeros(0)
            place = self.place[terms]
            top, listed = (place >= 0) & (place < common), place < 0
            dense[i, place[top]] = q[top]
            across[i, place[place >= common] - common] = q[place >= common]
            vectors.append(q)
            short.append((terms[listed], q[listed]))
        middle, by_block = across @ self.middle, dense @ self.block_max
        norms = np.sqrt((dense * dense).sum(axis=1))
        dense = dense.astype(np.float32)
        whole = np.zeros(len(self.idf))
        found = []
        for i, (terms, _, _) in enumerate(queries):
            if not len(terms):
                found.append(([], 0))
                continue
            at, each = spans(self.term_first, *short[i])
            listed = self.entries.take(at)
            sims = np.bincount(listed["row"], weights=listed["weight"] * each, minlength=len(self.ids)) + middle[i]
            bounds = np.repeat(by_block[i], BLOCK)[: len(sims)]
            np.minimum(bounds, self.row_norm * norms[i], out=bounds)
            bounds += sims
            rows = np.argpartition(bounds, max(0, len(bounds) - FIRST))[-FIRST:]
            near = sims[rows] + self.common.take(rows, axis=0) @ dense[i]
            floor = np.partition(near, len(near) - k)[len(near) - k] if len(near) >= k else 0.0
            bounds[rows] = -1.0
            rest = np.flatnonzero((bounds > 0) & (bounds >= floor - SLACK))
            if len(rest):
                rows, near = np.concatenate([rows, rest]), np.concatenate([near, sims[rest] + self.common.take(rest, axis=0) @ dense[i]])
            looked = len(rows)
            if looked > k:
                rows = rows[near >= np.partition(near, looked - k)[looked - k] - SLACK]
            whole[terms] = vectors[i]
            found.append((self._best(rows, self._similarities(whole, rows), k), looked))
            whole[terms] = 0.0
        return found

    def _similarities(self, query: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The examples' exact similarities to the vector ``query``."""
        parts = [slice(*x) for x in zip(self.full_first[rows].tolist(), self.full_first[rows + 1].tolist())]
        return np.array([query.take(self.full_terms[x]) @ self.full_weights[x] for x in parts])

    @staticmethod
    def _best(rows: np.ndarray, sims: np.ndarray, k: int) -> list[tuple[float, int]]:
        sims = np.round(sims, 9)
        if len(sims) > k:
            use = sims >= np.partition(sims, len(sims) - k)[len(sims) - k]
            rows, sims = rows[use], sims[use]
        order = np.lexsort((rows, -sims))[:k]
        return [x for x in zip(sims[order].tolist(), rows[order].tolist()) if x[0] > 0]

    def score(self, near: list[tuple[float, int]]) -> float:
        """Weighted share of toxic neighbours, shrunk towards the prior by two votes: ten far
        neighbours alone never make a document toxic."""
        if not near:
            return self.prior
        y = self.labels[[p for _, p in near]]
        heavy = self.stands_for[0] / max(self.stands_for[1], 1e-9)
        w = np.array([s for s, _ in near]) * np.where(y > 0, 1.0, heavy)
        return float((w @ y + 2 * self.prior) / (w.sum() + 2))


def labelled_sample(docs: DataFrame, labels: DataFrame, examples: dict[int, int], usable: Column | None) -> tuple[DataFrame, dict[int, int]]:
    """(slot, doc_id, toxic, text) of about ``examples[label]`` documents of each label, one
    per distinct text, and the labels' counts; ``usable`` is a condition on the doc_id."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    if usable is not None:
        known = known.filter(usable)
    known = known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per label
    rate = F.lit(0.0)
    for label, n in sizes.items():
        rate = F.when(F.col("toxic") == label, min(1.0, examples.get(label, 0) / n)).otherwise(rate)
    picked = C.store(known.filter(sample_unit(F.col("doc_id"), "toxic") < rate), "labelled")
    texts = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text")).join(picked, "doc_id")
    distinct = texts.groupBy(F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("key")).agg(F.max("toxic").alias("toxic"), F.min("doc_id").alias("doc_id"), F.first("text").alias("text"))
    return C.store(distinct.select(F.monotonically_increasing_id().alias("slot"), "doc_id", "toxic", "text"), "examples"), sizes


def marked_terms(sample: DataFrame, least_documents: int, least_chi2: float, least_lift: float) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Every term of the sample with its weight in LEAST_WEIGHT..1, by how much its presence
    depends on the label (chi-square with one degree of freedom, and lift), and whether it
    marks a label (reaches the three limits)."""
    totals = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    pos, neg = max(1, totals.get(1, 0)), max(1, totals.get(0, 0))
    terms = sample.select("slot", "toxic", "text").mapInArrow(_explode_terms, "slot long, toxic int, term string")
    by = terms.groupBy("term").agg(F.sum("toxic").cast("double").alias("a"), F.count(F.lit(1)).cast("double").alias("df"))
    rows = by.orderBy("term").toArrow()  # the terms of the bounded sample
    a, df = rows.column("a").to_numpy(), rows.column("df").to_numpy()
    b, n = df - a, float(pos + neg)
    cross = a * (neg - b) - b * (pos - a)
    chi2 = n * cross * cross / np.maximum(df * (n - df) * pos * neg, 1e-9)
    lift = np.abs(np.log((np.maximum(a, 0.5) / pos) / (np.maximum(b, 0.5) / neg)))
    if not totals.get(1) or not totals.get(0):
        chi2 = np.zeros(len(df))
    weight = LEAST_WEIGHT + (1 - LEAST_WEIGHT) * chi2 / (chi2 + least_chi2) * np.minimum(1, lift / np.log(least_lift))
    marks = (df >= least_documents) & (chi2 >= least_chi2) & (lift >= np.log(least_lift))
    return rows.column("term").to_pylist(), weight, marks


def encoded(docs: DataFrame, vocabulary) -> DataFrame:
    """(doc_id, terms, counts, others) of every document by the broadcast vocabulary, stored:
    the texts are read and tokenised once."""

    def run(batches):
        voc = vocabulary.value
        for batch in batches:
            for chunk in C.text_chunks(batch.column(1), ENCODED_BYTES):
                part = batch.slice(chunk.first, chunk.n)
                first, terms, counts, others = voc.encode_all(part.column(1).to_pylist())
                lists = (pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(x, pa.int32())) for x in (terms, counts))
                yield pa.RecordBatch.from_arrays([part.column(0), *lists, pa.array(others, pa.float64())], ["doc_id", "terms", "counts", "others"])

    src = C.texts_only(docs, "doc_id", "text")
    return C.store(src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, terms array<int>, counts array<int>, others double"), "encoded")


def document_frequencies(found: DataFrame, size: int) -> DataFrame:
    """(t, n): documents that hold term ``t`` of a vocabulary of ``size``; all documents at -1."""

    def run(batches):
        seen, n = np.zeros(size, dtype=np.int64), 0
        for batch in batches:
            n += batch.num_rows
            seen += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        hit = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(hit, -1), pa.int64()), pa.array(np.append(seen[hit], n), pa.int64())], ["t", "n"])

    return found.select("terms").mapInArrow(run, "t long, n long").groupBy("t").agg(F.sum("n").alias("n"))


def score(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column | None = None,
    k: int = 10,
    examples: dict[int, int] | None = None,
    least_documents: int = 4,
    least_chi2: float = 20.0,
    least_lift: float = 3.0,
) -> DataFrame:
    """doc_id, score in 0..1, ``evidence`` (the neighbours used) and ``looked_up`` (the share of
    the examples that the bounds left open) for every document."""
    spark = docs.sparkSession
    sample, known = labelled_sample(docs, labels, examples or {0: 6000, 1: 3000}, usable)
    terms, weights, marks = marked_terms(sample, least_documents, least_chi2, least_lift)
    vocabulary = Vocabulary(terms)
    found = encoded(docs, spark.sparkContext.broadcast(vocabulary))
    counted = document_frequencies(found, len(vocabulary)).toArrow()  # a row per vocabulary entry
    t, n = counted.column("t").to_numpy(), counted.column("n").to_numpy()
    n_docs = int(n[t < 0].sum())
    rarest = np.log((1.0 + n_docs) / 2) + 0.05  # a word that no example holds counts as one document's
    idf = np.full(len(vocabulary), rarest)
    idf[t[t >= 0]] = np.log((1.0 + n_docs) / (1.0 + n[t >= 0])) + 0.05
    weights = weights * idf
    rows = []
    for r in sample.orderBy("doc_id").toLocalIterator():  # the bounded sample
        rows.append((r["doc_id"], r["toxic"], *vocabulary.encode(r["text"])[:2]))
    drawn = Counter(r[1] for r in rows)
    stands_for = tuple(known.get(y, 0) / max(1, drawn[y]) for y in (0, 1))
    empty = Counter(r[1] for r in rows if not marks[r[2]].any())
    prior = empty[1] * stands_for[1] / max(1e-9, empty[0] * stands_for[0] + empty[1] * stands_for[1])
    # examples with the same heaviest term stand together, so that block maxima are tight
    full = sorted((r for r in rows if len(r[2])), key=lambda r: (r[2][np.argmax(weights[r[2]])], r[0]))
    index = Index.build(weights, [r[0] for r in full], [r[1] for r in full], [r[2:] for r in full], prior, stands_for, LEAST_WEIGHT * rarest)
    shared = spark.sparkContext.broadcast(index)  # bounded: examples * terms of each

    def run(batches):
        ix = shared.value
        for batch in batches:
            queries = [(t.values.to_numpy(), c.values.to_numpy(), o) for t, c, o in zip(batch.column(1), batch.column(2), batch.column(3).to_pylist())]
            results = [x for at in range(0, len(queries), BATCH) for x in ix.search(queries[at : at + BATCH], k)]
            near, looked = [x for x, _ in results], [n for _, n in results]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([ix.score(x) for x in near], pa.float64()),
                    pa.array([[f"{ix.ids[p]}:{s:.4f}:{int(ix.labels[p])}" for s, p in x] for x in near], pa.list_(pa.string())),
                    pa.array([n / max(1, len(ix.ids)) for n in looked], pa.float64()),
                ],
                ["doc_id", "score", "evidence", "looked_up"],
            )

    return found.mapInArrow(run, f"doc_id {found.schema['doc_id'].dataType.simpleString()}, score double, evidence array<string>, looked_up double")


def score_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``score`` with labels learned only outside the held-out fifth of the ids."""
    found = score(docs, labels, ~held_out(F.col("doc_id"), 5, 0), **options)
    return found.withColumn("held_out", held_out(F.col("doc_id"), 5, 0)).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
