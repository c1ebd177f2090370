"""Benchmark decontamination by winnowing (operator 7). DataFrame functions only.

* Words: runs of digits, ASCII letters and non-ASCII characters; A-Z lower-cased.
* Fingerprints: hashes of ``k`` consecutive words; of every ``w`` consecutive hashes the
  smallest is kept. With ``k + w - 1 = 13`` any shared span of 13 words holds a whole
  winnowing window, so both sides keep the same fingerprint of it: no such span is missed.
  An item shorter than 13 words is one window; for each such length that the benchmark has
  (at most 12) the documents keep all hashes of that many words.
* Join: the documents' fingerprint table is joined with the benchmark's to find the texts
  that share any. Only those are read again.
* Extension: in them every hash of a kept benchmark fingerprint gives a diagonal (text,
  item, offset). Along a diagonal the words themselves are compared, so hash collisions
  cannot add a hit, and all matching windows are marked.

Texts are keyed by MD5, so copies are examined once however many there are, and an item
copied into a third of all documents costs one row per distinct text.

Defined results: null text has no words and no hits; a null or wordless benchmark text has
no window. Items with equal texts all count. An item without an id marks words but is not
listed. Repeated rows are judged alike. Empty tables give no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from . import common as C

SPAN = 13
_K = 7  # words of a fingerprint for spans of 13; the winnowing window is 13 - 7 + 1 hashes

#: What stands between words (A-Z counts as a word character: it is lower-cased).
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def raw_words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text.cast("string"), F.lit("")), _BETWEEN, -1), "")


def exact_words(words: Column) -> Column:
    return F.transform(words, lambda w: F.translate(w, _UPPER, _LOWER))


def _starts(arr: Column, width: int) -> Column:
    """0-based starts of the windows of ``width`` elements (empty if there is none)."""
    n = F.size(arr) - F.lit(width)
    return F.when(n >= 0, F.sequence(F.lit(0), n)).otherwise(F.array().cast("array<int>"))


def _gram_hashes(hashes: Column, k: int, salt: int) -> Column:
    return F.transform(_starts(hashes, k), lambda i: F.xxhash64(F.lit(salt), *[F.get(hashes, i + j) for j in range(k)]))


def _window_minima(grams: Column, w: int) -> Column:
    if w == 1:
        return grams
    return F.transform(_starts(grams, w), lambda i: F.least(*[F.get(grams, i + j) for j in range(w)]))


def _shape(span: int) -> tuple[int, int]:
    """(k, w) for windows of ``span`` words."""
    return (_K, SPAN - _K + 1) if span == SPAN else (span, 1)


def _word_hashes(df: DataFrame) -> DataFrame:
    """Adds ``hashes``: one per element of ``words``. ``lower`` may join more words than the
    lower-casing of A-Z does; the extension compares exact words."""
    return df.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(F.lower(w))))


def text_key(text: Column) -> Column:
    return F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item (row key), item_id, words (exact), span (window length), hashes."""
    rows = benchmark.select(F.col(id_col).cast("string").alias("item_id"), raw_words(F.col(text_col)).alias("words"))
    rows = _word_hashes(rows.filter(F.size("words") > 0))
    return rows.select(F.monotonically_increasing_id().alias("item"), "item_id", exact_words(F.col("words")).alias("words"), F.least(F.size("words"), F.lit(SPAN)).alias("span"), "hashes")


def benchmark_fingerprints(items: DataFrame, spans: list[int]) -> DataFrame:
    """(fp, item, at): kept fingerprints of the items and the word where each starts."""
    parts = []
    for span in spans:
        k, w = _shape(span)
        grams = items.filter(F.col("span") == span).select("item", _gram_hashes(F.col("hashes"), k, span).alias("grams"))
        kept = grams.withColumn("kept", _window_minima(F.col("grams"), w))
        each = kept.select("item", "kept", F.posexplode("grams").alias("at", "fp"))
        parts.append(each.filter(F.array_contains("kept", F.col("fp"))).select("fp", "item", "at"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def document_fingerprints(docs: DataFrame, spans: list[int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The fingerprint table: doc_id, key (of the text), n_words, fps (distinct)."""
    text = F.col(text_col).cast("string")
    rows = _word_hashes(docs.select(F.col(id_col).alias("doc_id"), text_key(text).alias("key"), raw_words(text).alias("words")))
    rows = rows.select("doc_id", "key", F.size("words").cast("long").alias("n_words"), "hashes")
    rows = rows.withColumns({f"g{s}": _gram_hashes(F.col("hashes"), _shape(s)[0], s) for s in spans})
    kept = [_window_minima(F.col(f"g{s}"), _shape(s)[1]) for s in spans]
    return rows.select("doc_id", "key", "n_words", F.array_distinct(F.concat(*kept)).alias("fps"))


def _extend(texts: DataFrame, items: DataFrame, prints: DataFrame, spans: list[int]) -> DataFrame:
    """(key, item_id, item, pos): every word of a text inside an occurrence of a window.

    ``texts``: key and raw words of the texts that share a fingerprint."""
    hashed = _word_hashes(texts)
    grams = F.concat(*[F.transform(_gram_hashes(F.col("hashes"), _shape(s)[0], s), lambda h, i: F.struct(i.alias("pos"), h.alias("fp"))) for s in spans])
    hits = hashed.select("key", F.explode(grams).alias("g")).select("key", "g.pos", "g.fp").join(prints, "fp")
    lines = hits.select("key", "item", (F.col("pos") - F.col("at")).alias("shift")).distinct()
    doc_side = texts.select("key", exact_words(F.col("words")).alias("dw"))
    item_side = items.select("item", "item_id", F.col("words").alias("iw"), "span")
    both = lines.join(item_side, "item").join(doc_side, "key")
    place = F.col("shift") + F.col("i")
    same = F.transform("iw", lambda w, i: F.coalesce((F.col("shift") + i >= 0) & (F.get("dw", F.greatest(F.col("shift") + i, F.lit(0))) == w), F.lit(False)))
    eq = both.select("key", "item", "item_id", "shift", "span", same.alias("eq"))
    whole = F.filter(F.sequence(F.lit(0), F.size("eq") - F.col("span")), lambda i: F.forall(F.slice("eq", i + 1, F.col("span")), lambda x: x))
    found = eq.withColumn("starts", whole).filter(F.size("starts") > 0)
    covered = F.array_distinct(F.flatten(F.transform("starts", lambda i: F.sequence(i, i + F.col("span") - 1))))
    return found.select("key", "item", "item_id", "shift", F.explode(covered).alias("i")).select("key", "item", "item_id", place.alias("pos"))


def find(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, key, n_words, n_hit, items (sorted ids), contaminated.

    ``contaminated``: some word is hit, and at least one in twenty."""
    items = C.store(benchmark_windows(benchmark), "items")
    spans = sorted(r["span"] for r in items.select("span").distinct().collect())  # at most 13 numbers
    if not spans:
        text = F.col(text_col).cast("string")
        bare = docs.select(F.col(id_col).alias("doc_id"), text_key(text).alias("key"), F.size(raw_words(text)).cast("long").alias("n_words"))
        return bare.select("*", F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("items"), F.lit(False).alias("contaminated"))
    prints = C.store(benchmark_fingerprints(items, spans), "prints")
    table = C.store(document_fingerprints(docs, spans, id_col, text_col), "fingerprints")
    sharing = table.select("key", F.explode("fps").alias("fp")).join(prints.select("fp").distinct(), "fp", "left_semi").select("key").distinct()
    sharing = C.store(sharing, "sharing")
    text = F.col(text_col).cast("string")
    keyed = docs.select(text_key(text).alias("key"), text.alias("text")).join(sharing, "key", "left_semi")
    texts = C.store(keyed.groupBy("key").agg(F.first("text").alias("text")).select("key", raw_words(F.col("text")).alias("words")), "texts")
    words = C.store(_extend(texts, items, prints, spans), "hits")
    per_text = words.select("key", "pos").distinct().groupBy("key").agg(F.count(F.lit(1)).alias("n_hit"))
    listed = words.select("key", "item_id").distinct().groupBy("key").agg(F.sort_array(F.collect_set("item_id")).alias("items"))  # at most the benchmark's items
    result = C.store(per_text.join(listed, "key"), "judged")
    out = table.select("doc_id", "key", "n_words").join(result, "key", "left")
    hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select(
        "doc_id", "key", "n_words", hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((hit > 0) & (20 * hit >= F.col("n_words"))).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that are not contaminated."""
    bad = C.store(find(docs, benchmark).filter("contaminated").select(F.col("key").alias("_bad")).distinct(), "contaminated")
    return docs.join(bad, text_key(docs["text"]) == bad["_bad"], "left_anti")
