import os

import numpy as np
import pytest

from callcorpus.llm import token_counts as K
from llm_edges import awkward, documents

pytestmark = pytest.mark.skipif(not os.path.exists(K.TOKENIZER), reason="tokenizer file not present")


def brute(text, rule):
    """Byte by byte: the section of each byte, then each token's bytes."""
    enc, lengths = K.load(K.TOKENIZER)
    raw = (text or "").encode()
    section, of = 0, []
    for k, b in enumerate(raw):
        of.append(section)
        if b == 10 or (b == 32 and k and raw[k - 1] in b".!?"):
            section += 1
    n = (of[-1] if of else 0) + 1
    counts, cross, at = np.zeros(n), np.zeros(n, dtype=int), 0
    for t in enc.encode_ordinary(raw.decode()):
        own = of[at : at + lengths[t]]
        at += lengths[t]
        cross[own[0]] += own[0] != own[-1]
        if rule == "split":
            for s in own:
                counts[s] += 1 / len(own)
        else:
            counts[{"first": own[0], "last": own[-1], "majority": max(sorted(set(own)), key=own.count)}[rule]] += 1
    assert at == len(raw)
    chars = [sum(1 for k, s in enumerate(of) if s <= j and raw[k] & 0xC0 != 0x80) for j in range(n)]
    return list(zip(counts, cross, [0, *chars[:-1]], chars))


@pytest.mark.parametrize("rule", K.RULES)
def test_against_bytes(spark, rule):
    rows = [r for r in awkward() if len(r[1] or "") < 5000]
    rows += [(70, "One. Two! Three?\n\n\nFour.  Five . <|endoftext|> é. ü", "en", "a"), (71, "日本. 語\n" * 5, "en", "a"), (72, "a" * 3000, "en", "a")]
    got = {}
    for r in K.section_tokens(documents(spark, rows), rule=rule).collect():
        got.setdefault(r.doc_id, []).append((r.section, r.n_tokens, r.n_crossing, r.char_start, r.char_end, r.doc_tokens))
    want = {}
    for i, t, *_ in rows:
        b = brute(t, rule)
        total = sum(c for c, *_ in b)
        want.setdefault(i, []).extend((s, pytest.approx(c), x, lo, hi, pytest.approx(total)) for s, (c, x, lo, hi) in enumerate(b))
    for i in want:
        assert sorted(got[i]) == sorted(want[i], key=lambda x: x[0]), i


def test_unknown_rule(spark):
    with pytest.raises(ValueError):
        K.section_tokens(documents(spark, []), rule="none")


def test_document_totals(spark):
    rows = awkward()
    enc, _ = K.load(K.TOKENIZER)
    got = sorted((str(r.doc_id), r.n_tokens) for r in K.document_tokens(documents(spark, rows)).collect())
    assert got == sorted((str(i), len(enc.encode_ordinary(t or ""))) for i, t, *_ in rows)


def test_empty_table(spark):
    assert K.section_tokens(documents(spark, [])).count() == 0
