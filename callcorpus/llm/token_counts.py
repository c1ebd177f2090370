"""Token counts of sections, attributed through offsets (operator 9).

A whole text is encoded once (byte-level BPE). Its tokens cover the text's bytes without
gaps, so token offsets are running sums of token lengths. The sections (sentences: one ends
with a newline, or with ``.``, ``!`` or ``?`` and the space after it) are byte intervals of
the same text; both interval lists are sorted, so the interval join is a merge by binary
search within the text's row. A token that crosses a section's end (this vocabulary joins a
space to the next word, so most ends have one) is allocated by an explicit rule:

* ``first``: to the section of its first byte; ``last``: of its last byte;
* ``majority``: to the section with most of its bytes, the first of equals;
* ``split``: to each section in proportion to its bytes (fractional counts).

Under every rule the sections' counts add up to the text's token count.

Defined results: null or empty text has one empty section with 0 tokens. Special tokens'
strings are ordinary text. Repeated rows are counted alike. The tokenizer file (lines of
base64 token and rank) is a path that every executor can read.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import common as C

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the public split pattern of this vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RULES = ("first", "last", "majority", "split")

_loaded: dict[tuple[str, str], tuple] = {}


def load(path: str, pattern: str = PATTERN):
    """(encoder, length in bytes of each token), once per worker."""
    if (path, pattern) not in _loaded:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}
        lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, i in ranks.items():
            lengths[i] = len(token)
        _loaded[path, pattern] = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), lengths
    return _loaded[path, pattern]


def attribute(ends: np.ndarray, cuts: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens per section and tokens that cross a section's end, charged to that section.

    ``ends``: end byte of each token; ``cuts``: end byte of each section (the last is the
    text's end). Sections are not empty, but for the only section of an empty text.
    """
    n = len(cuts)
    if not len(ends):
        return np.zeros(n), np.zeros(n, dtype=np.int64)
    starts = np.concatenate([[0], ends[:-1]])
    first = np.searchsorted(cuts, starts, side="right")
    last = np.searchsorted(cuts, ends - 1, side="right")
    cross = last > first
    crossing = np.bincount(first[cross], minlength=n)
    if rule == "last":
        return np.bincount(last, minlength=n).astype(float), crossing
    counts = np.bincount(first if rule == "first" else first[~cross], minlength=n).astype(float)
    if rule == "first":
        return counts, crossing
    froms = np.concatenate([[0], cuts[:-1]])
    for s, e, a, b in zip(starts[cross], ends[cross], first[cross], last[cross]):
        parts = np.minimum(e, cuts[a : b + 1]) - np.maximum(s, froms[a : b + 1])
        if rule == "majority":
            counts[a + int(np.argmax(parts))] += 1
        else:
            counts[a : b + 1] += parts / (e - s)
    return counts, crossing


def section_ends(data: np.ndarray) -> np.ndarray:
    """End byte of each section of a text (UTF-8 bytes); the last is the text's end."""
    stop = data == 0x0A
    if len(data) > 1:
        mark = (data[:-1] == 0x2E) | (data[:-1] == 0x21) | (data[:-1] == 0x3F)
        stop[1:] |= mark & (data[1:] == 0x20)
    cuts = np.flatnonzero(stop) + 1
    return cuts if len(cuts) and cuts[-1] == len(data) else np.append(cuts, len(data))


def section_tokens(docs: DataFrame, tokenizer: str = TOKENIZER, pattern: str = PATTERN, rule: str = "majority", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per section: doc_id, section (from 0), char_start, char_end, n_tokens
    (a whole number except under ``split``), n_crossing, doc_tokens."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    src = C.texts_only(docs, id_col, text_col)

    def run(batches):
        enc, lengths = load(tokenizer, pattern)
        for batch in batches:
            for chunk in C.text_chunks(batch.column(1)):
                take, cols = [], [[], [], [], [], [], []]  # per column, an array per text
                for i in range(chunk.n):
                    raw = chunk.bytes_of(i)
                    data = chunk.data[chunk.offs[i] : chunk.offs[i + 1]]
                    tokens = np.asarray(enc.encode_ordinary(raw.decode("utf-8")), dtype=np.int64)
                    cuts = section_ends(data)
                    chars = np.cumsum((data & 0xC0) != 0x80)
                    stops = chars[cuts - 1] if len(data) else np.zeros(1, dtype=np.int64)
                    counts, crossing = attribute(np.cumsum(lengths[tokens]), cuts, rule)
                    take.append(np.full(len(cuts), chunk.first + i))
                    for col, values in zip(cols, (np.arange(len(cuts)), np.concatenate([[0], stops[:-1]]), stops, counts, crossing, np.full(len(cuts), len(tokens)))):
                        col.append(values)
                whole = [np.concatenate(c).astype(np.float64 if j == 3 else np.int64) for j, c in enumerate(cols)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(np.concatenate(take))), *map(pa.array, whole)],
                    ["doc_id", "section", "char_start", "char_end", "n_tokens", "n_crossing", "doc_tokens"],
                )

    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, section long, char_start long, char_end long, n_tokens double, n_crossing long, doc_tokens long")


def document_tokens(docs: DataFrame, **options) -> DataFrame:
    """Tokens of each document: the sum over its sections, without a shuffle."""
    sections = section_tokens(docs, **options)
    return sections.filter("section = 0").select("doc_id", F.col("doc_tokens").alias("n_tokens"))
