"""Language identification by nearest centroid (operator 5).

* Features: hashed 2- and 3-byte grams of the text with ASCII letters lowered and every
  other ASCII byte turned into one space; weight ``log(1 + count) * idf``, normalised.
* ``idf`` counts every learnable document of the table (one distributed pass).
* Centroids: spherical k-means over a sample of at most about ``sample_per_lang``
  documents per language (Bernoulli by a hash of the id, rate from exact counts); several
  centroids per language. This sample is the only bounded part.
* Prediction: cosine to all centroids; the best one's language wins. A text is rejected
  when its cosine distance exceeds the radius learned for that language and its length
  class (by the number of distinct grams).

Defined results: null text, text without a letter, or no learnable row at all gives
``und`` with score 0, rejected. Repeated rows are judged alike. Whole texts are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import common as C

DIMS = 4096
UNDETERMINED = "und"
#: Upper ends of the length classes, in distinct grams.
LENGTHS = np.array([16, 32, 64, 128, 256, 512])
#: The share of a class's sample whose distances its radius covers.
QUANTILE = 0.995

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:0x80] = 0x20
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)


def gram_counts(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """float32 (texts x DIMS): counts of hashed 2- and 3-grams; grams never cross texts."""
    n = len(offs) - 1
    if not len(data):
        return np.zeros((n, DIMS), dtype=np.float32)
    low = _FOLD[data]
    second = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] < 0x9F)) + 1
    low[second] |= 0x20  # upper-case Latin-1 letters
    b = low.astype(np.uint32)
    doc = np.repeat(np.arange(n, dtype=np.uint32), np.diff(offs))
    out = np.zeros(n * DIMS, dtype=np.int64)
    for k in (2, 3):
        m = len(b) - k + 1
        if m < 1:
            continue
        code = b[:m].copy()
        blank = b[:m] == 0x20
        for j in range(1, k):
            code = code * np.uint32(257) + b[j : j + m]
            blank &= b[j : j + m] == 0x20
        slot = (code * np.uint32(2654435761)) >> np.uint32(32 - 12)
        use = (doc[:m] == doc[k - 1 :]) & ~blank
        out += np.bincount((doc[:m].astype(np.int64) * DIMS + slot)[use], minlength=n * DIMS)
    return out.reshape(n, DIMS).astype(np.float32)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 0, norm, 1)


@dataclass
class Model:
    langs: list[str]
    centroids: np.ndarray  # (languages * k, DIMS), normalised
    owner: np.ndarray  # language of each centroid
    radius: np.ndarray  # (languages, length classes): the largest accepted cosine distance
    idf: np.ndarray


def _document_frequency(batches):
    """One row per partition: documents and, per feature, the documents that hold it."""
    n, df = 0, np.zeros(DIMS, dtype=np.int64)
    for batch in batches:
        for chunk in C.text_chunks(batch.column(0), 1 << 20, 256):
            n += chunk.n
            df += (gram_counts(chunk.data, chunk.offs) > 0).sum(axis=0)
    yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([df.tolist()], pa.list_(pa.int64()))], ["n", "df"])


def _sample_vectors(batches):
    for batch in batches:
        for chunk in C.text_chunks(batch.column(1), 1 << 20, 256):
            rows = gram_counts(chunk.data, chunk.offs)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(chunk.first, chunk.n), pa.array([r.tobytes() for r in rows], pa.binary())], ["lang", "counts"])


def _spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """At most ``k`` centroids; starts from spread-out rows, so no random state."""
    picks = [0]
    best = x @ x[0]
    for _ in range(min(k, len(x)) - 1):
        picks.append(int(np.argmin(best)))
        best = np.maximum(best, x @ x[picks[-1]])
    c = x[picks]
    for _ in range(rounds):
        near = np.argmax(x @ c.T, axis=1)
        sums = np.stack([x[near == j].sum(axis=0) if (near == j).any() else c[j] for j in range(len(c))])
        c = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return c.astype(np.float32)


def length_class(counts: np.ndarray) -> np.ndarray:
    return np.searchsorted(LENGTHS, (counts > 0).sum(axis=1))


def _radii(distance: np.ndarray, size: np.ndarray, least: int = 20) -> np.ndarray:
    """Per length class the QUANTILE of the distances; a class of fewer than ``least`` rows
    takes in its neighbours, the shorter first (they lie further out), until it has them or
    all rows are in. A shorter class never has the smaller radius."""
    out = np.zeros(len(LENGTHS) + 1)
    for c in range(len(out)):
        low = high = c
        while ((size >= low) & (size <= high)).sum() < least and (low > 0 or high < len(LENGTHS)):
            low, high = (low - 1, high) if low > 0 else (low, high + 1)
        out[c] = np.quantile(distance[(size >= low) & (size <= high)], QUANTILE, method="higher")
    return np.maximum.accumulate(out[::-1])[::-1]


def fit(train: DataFrame, sample_key: Column, k: int = 4, sample_per_lang: int = 500, slack: float = 1.25) -> Model | None:
    """Learn from ``train`` (text, lang); ``sample_key`` is a column in [0, 1).

    The radius of a language and length class is ``slack`` times a high quantile of its
    sample's distances to the nearest own centroid, so a few outliers do not widen it and
    short texts, which lie far out, have their own.
    """
    train = train.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["n"] for r in train.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per language
    if not counts:
        return None
    sums = train.select("text").mapInArrow(_document_frequency, "n long, df array<long>")
    slot = sums.select("n", F.posexplode("df").alias("slot", "df")).groupBy("slot").agg(F.sum("df").alias("df"), F.sum("n").alias("n"))
    idf, total = np.zeros(DIMS, dtype=np.float32), 0
    for r in slot.collect():  # DIMS rows
        total = r["n"]
        idf[r["slot"]] = np.log((1 + total) / (1 + r["df"])) + 0.05
    rate = F.create_map(*[x for lang, n in counts.items() for x in (F.lit(lang), F.lit(min(1.0, sample_per_lang / n)))])
    sample = train.filter(sample_key < F.element_at(rate, F.col("lang"))).select("lang", "text").mapInArrow(_sample_vectors, "lang string, counts binary")
    by_lang: dict[str, list[np.ndarray]] = {}
    for r in sample.toLocalIterator():
        by_lang.setdefault(r["lang"], []).append(np.frombuffer(r["counts"], dtype=np.float32))
    langs = sorted(by_lang)
    centroids, owner, radius = [], [], []
    for i, lang in enumerate(langs):
        rows = np.stack(by_lang[lang])
        x = weighted(rows, idf)
        some = np.linalg.norm(x, axis=1) > 0
        x, size = x[some], length_class(rows[some])
        if not len(x):
            radius.append(np.ones(len(LENGTHS) + 1))
            continue
        c = _spherical_kmeans(x, k)
        centroids.append(c)
        owner += [i] * len(c)
        radius.append(np.minimum(1.0, _radii(1 - (x @ c.T).max(axis=1), size) * slack))
    if not centroids:
        return None
    return Model(langs, np.concatenate(centroids), np.array(owner), np.array(radius), idf)


def judge(m: Model, texts: pa.Array, known: np.ndarray):
    """Arrays over the texts: index of the nearest language, score, distance, rejected."""
    parts = []
    for chunk in C.text_chunks(texts, 1 << 20, 256):
        counts = gram_counts(chunk.data, chunk.offs)
        sim = weighted(counts, m.idf) @ m.centroids.T
        per = np.stack([sim[:, m.owner == i].max(axis=1) if (m.owner == i).any() else np.zeros(len(sim)) for i in range(len(m.langs))], axis=1)
        best = per.argmax(axis=1)
        top = np.clip(per[np.arange(len(per)), best], 0, 1).astype(np.float64)
        odds = np.exp(20 * (per - per.max(axis=1, keepdims=True)))
        parts.append((best, (1 / odds.sum(axis=1)).astype(np.float64), 1 - top, m.radius[best, length_class(counts)]))
    if not parts:
        return np.zeros(0, dtype=int), np.zeros(0), np.zeros(0), np.zeros(0, dtype=bool)
    best, score, distance, radius = (np.concatenate(x) for x in zip(*parts))
    return best, np.where(known, score, 0.0), np.where(known, distance, 1.0), ~known | (distance > radius)


def has_letter(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string").rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, nearest (language, or null), score, distance, rejected.

    ``nearest`` is null where the text is null or has no letter; ``score`` is the share of
    the best language's similarity among the languages, sharpened, in 0..1.
    """
    src = docs.select(F.col(id_col).alias("doc_id"), has_letter(text_col).alias("known"), F.col(text_col).cast("string").alias("text"))
    if model is None:
        return src.select("doc_id", F.lit(None).cast("string").alias("nearest"), F.lit(0.0).alias("score"), F.lit(1.0).alias("distance"), F.lit(True).alias("rejected"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded: languages * k * DIMS floats

    def run(batches):
        m = shared.value
        for batch in batches:
            known = np.asarray(batch.column(1).to_pylist(), dtype=bool)
            best, score, distance, rejected = judge(m, batch.column(2), known)
            nearest = pa.array([m.langs[b] if x else None for b, x in zip(best, known)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), nearest, pa.array(score), pa.array(distance), pa.array(rejected)], ["doc_id", "nearest", "score", "distance", "rejected"])

    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, nearest string, score double, distance double, rejected boolean")


def held_out(id_col: Column, parts: int, at: int) -> Column:
    """crc32 of the id as text modulo ``parts`` equals ``at`` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % parts == at


def sample_unit(id_col: Column, salt: str) -> Column:
    """A reproducible number in [0, 1) from the id."""
    return F.pmod(F.xxhash64(F.lit(salt), id_col.cast("string")), F.lit(1 << 40)) / float(1 << 40)


def identify(docs: DataFrame, k: int = 4, sample_per_lang: int = 500) -> DataFrame:
    """Fit on the rows of ``docs`` (doc_id, text, lang) outside the held-out quarter and
    predict all rows: doc_id, held_out, nearest, score, distance, rejected, lang_found."""
    out = held_out(F.col("doc_id"), 4, 2)
    train = docs.filter(~out).select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    model = fit(train, sample_unit(F.col("doc_id"), "lang"), k, sample_per_lang)
    found = predict(docs, model)
    return found.withColumn("held_out", held_out(F.col("doc_id"), 4, 2)).withColumn("lang_found", F.when(F.col("rejected"), F.lit(UNDETERMINED)).otherwise(F.col("nearest")))


def keep_identified(docs: DataFrame, k: int = 4, sample_per_lang: int = 500) -> DataFrame:
    """The rows of ``docs`` (all columns) whose language is not rejected; learns from all
    rows with a ``lang``. Without any such row nothing can be judged and all rows stay."""
    train = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    model = fit(train, sample_unit(F.col("doc_id"), "lang"), k, sample_per_lang)
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)
    src = docs.select(C.packed(docs), docs["text"].cast("string").alias("text"), has_letter("text").alias("known"))

    def run(batches):
        for batch in batches:
            known = np.asarray(batch.column(2).to_pylist(), dtype=bool)
            rejected = judge(shared.value, batch.column(1), known)[3]
            yield pa.RecordBatch.from_struct_array(batch.column(0).filter(pa.array(~rejected)))

    return src.mapInArrow(run, docs.schema)
