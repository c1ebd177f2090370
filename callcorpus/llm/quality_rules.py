"""Quality rules as a bitmask ledger (operator 3).

Every rule is evaluated once per document. The ledger keeps the measurements and one
``fail_bits`` integer (bit r set: rule r failed). Policies are versioned bit masks over
the ledger: a document passes a policy when ``fail_bits & mask = 0``. Policies and
ablations therefore never read a text again; an ablation is one aggregate over the
(at most 2**rules) distinct bit patterns.

Defined results: null text has no words (all measures 0; it fails ``few_words``). Repeated
rows are judged alike, each gets its own row; a null doc_id stays null. An empty table
gives an empty ledger. Texts of any length are measured whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import common as C

MEASURES = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long, n_letters long"
WINDOW = 5

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_LETTER = np.zeros(256, dtype=bool)
#: ASCII letters, and every code point from U+00C0 on by its lead byte (0xC3 and above).
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC3, 0x100)]] = True


def _repeat_words(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Words of each text inside a 5-word window that the text holds twice or more."""
    win, wfirst = C.window_hashes(hashes, first, WINDOW)
    n = len(first) - 1
    if not len(win):
        return np.zeros(n, dtype=np.int64)
    doc = np.repeat(np.arange(n), np.diff(wfirst))
    order = np.lexsort((win, doc))
    same = (win[order][1:] == win[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    twice = np.zeros(len(win), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = np.flatnonzero(twice) + (first[:-1] - wfirst[:-1])[doc[twice]]  # word index of the window's start
    edge = np.zeros(len(hashes) + 1, dtype=np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + WINDOW, -1)
    return C.per_text((np.cumsum(edge)[:-1] > 0).astype(np.int64), first)


def _line_counts(text: bytes) -> tuple[int, int]:
    """(lines with a word, those equal to an earlier line)."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines), len(lines) - len(set(lines))


def _measure(batches):
    for batch in batches:
        for chunk in C.text_chunks(batch.column(1)):
            starts, ends, first = C.word_spans(chunk.data, chunk.offs)
            hashes = C.span_hashes(C.prefix_sums(chunk.data), starts, ends)
            data, offs = chunk.data, chunk.offs
            lines = [_line_counts(chunk.bytes_of(i)) for i in range(chunk.n)]
            point = ((data & 0xC0) != 0x80) & ~C._SPACE[data]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(chunk.first, chunk.n),
                    pa.array(np.diff(first)),
                    pa.array(C.per_text(point, offs)),
                    pa.array(C.per_text(_SYMBOL[data], offs)),
                    pa.array([x for x, _ in lines], pa.int64()),
                    pa.array([x for _, x in lines], pa.int64()),
                    pa.array(_repeat_words(hashes, first)),
                    pa.array(C.per_text(_LETTER[data], offs)),
                ],
                ["doc_id", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letters"],
            )


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of measurements per document."""
    src = C.texts_only(docs, id_col, text_col)
    return src.mapInArrow(_measure, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, {MEASURES}")


@dataclass(frozen=True)
class Rule:
    """``failed`` is a boolean expression over the measurements; ``bit`` never changes."""

    bit: int
    name: str
    failed: str


#: All rules. A retired rule keeps its bit; a new one takes the next.
RULES = (
    Rule(0, "few_words", "n_words < 10"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 20 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > n_words"),
    Rule(3, "duplicate_lines", "n_lines > 0 AND 10 * n_dup_lines > 3 * n_lines"),
    Rule(4, "word_length", "n_words > 0 AND (word_chars < 3 * n_words OR word_chars > 12 * n_words)"),
    Rule(5, "few_letters", "n_words > 0 AND 2 * n_letters < word_chars"),
)


def mask_of(*names: str) -> int:
    bits = {r.name: r.bit for r in RULES}
    return sum(1 << bits[n] for n in names)


#: Versioned policies: version -> mask of the rules that remove a document.
POLICIES = {
    "base": mask_of("few_words", "repeated_words"),
    "v1": mask_of("few_words", "repeated_words", "symbols", "word_length"),
    "v2": mask_of("few_words", "repeated_words", "symbols", "duplicate_lines", "word_length", "few_letters"),
}


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """Measurements plus ``fail_bits``; every rule is evaluated here and nowhere else."""
    bits = F.lit(0).cast("long")
    for r in rules:
        bits = bits.bitwiseOR(F.when(F.expr(r.failed), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long"))
    return measure(docs, id_col, text_col).withColumn("fail_bits", bits)


def passes(mask: int, bits: Column | str = "fail_bits") -> Column:
    bits = F.col(bits) if isinstance(bits, str) else bits
    return bits.bitwiseAND(F.lit(mask).cast("long")) == 0


def apply_policies(led: DataFrame, policies: dict[str, int] = POLICIES) -> DataFrame:
    """One boolean column ``keep_<version>`` per policy."""
    return led.withColumns({f"keep_{v}": passes(m) for v, m in policies.items()})


def ablation(led: DataFrame, mask: int, rules=RULES) -> DataFrame:
    """Per rule of the policy: documents that fail it, that fail only it (a policy without
    the rule would keep them), and documents the whole policy keeps.

    The ledger is first counted by bit pattern (at most 2**len(rules) rows); the rest is
    bitwise arithmetic over those counts.
    """
    patterns = led.groupBy(led["fail_bits"].bitwiseAND(F.lit(mask).cast("long")).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    active = [r for r in rules if mask >> r.bit & 1]
    rows = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("flag")) for r in active]))
    each = patterns.select("bits", "n", rows.alias("r")).select("bits", "n", "r.rule", "r.flag")
    hit = F.col("bits").bitwiseAND(F.col("flag")) != 0
    return each.groupBy("rule").agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("flag"), F.col("n")).otherwise(0)).alias("n_failed_only_this"),
        F.sum(F.when(F.col("bits") == 0, F.col("n")).otherwise(0)).alias("n_kept_by_all"),
    )


def sole_rule(mask: int, bits: Column | str = "fail_bits", rules=RULES) -> Column:
    """The rule that alone removes a document under the policy, or null."""
    bits = (F.col(bits) if isinstance(bits, str) else bits).bitwiseAND(F.lit(mask).cast("long"))
    return F.coalesce(*[F.when(bits == 1 << r.bit, F.lit(r.name)) for r in rules])
