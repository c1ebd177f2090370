import hashlib
import random
from collections import Counter

import pytest

from callcorpus.llm import substring_dedup as S
from callcorpus.llm.suffix_groups import suffix_array
from llm_edges import awkward, documents


def brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(r, gone) if not g)
        out.append((len(r), sum(gone), sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone)), kept))
    return out


@pytest.mark.parametrize("alphabet", [1, 2, 3, 26])
def test_suffix_array_is_exact(alphabet):
    rng = random.Random(alphabet)
    for _ in range(200):
        s = [rng.randint(1, alphabet) for _ in range(rng.randint(0, 60))]
        assert suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def check(spark, rows, length=200):
    got = sorted((r.doc_id is None, r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in S.remove_repeats(documents(spark, rows), length).collect())
    want = sorted((i is None, i, *b) for (i, *_), b in zip(rows, brute([r[1] for r in rows], length)))
    assert got == want


def test_awkward_rows(spark):
    check(spark, awkward())


def planted(seed, passages=4, texts=40):
    rng = random.Random(seed)
    letters = "abcdefgh "
    pool = ["".join(rng.choice(letters) for _ in range(rng.choice([199, 200, 201, 260, 700]))) for _ in range(passages)]
    pool += ["z" * 450, "xy" * 230]
    rows = []
    for i in range(texts):
        parts = []
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(pool)
            a = rng.randint(0, max(0, len(p) - 150))
            parts.append("".join(rng.choice(letters) for _ in range(rng.randint(0, 300))))
            parts.append(p[a : rng.randint(min(len(p), a + 150), len(p))])
        rows.append((i, "ü".join(parts), "en", "a"))
    return rows


def test_planted_passages(spark):
    check(spark, planted(3))


def test_large_groups_are_divided(spark, monkeypatch):
    monkeypatch.setattr(S, "_GROUP", 2)
    check(spark, planted(5, passages=1, texts=30))


def test_empty_table(spark):
    assert S.remove_repeats(documents(spark, [])).count() == 0


def test_pieces_agree(monkeypatch):
    import numpy as np

    rng = random.Random(9)
    data = np.frombuffer(bytes(rng.choice(b"abcd") for _ in range(5000)), dtype=np.uint8)
    whole = S.runs(data, 200)
    monkeypatch.setattr(S, "_PIECE", 700)
    parts = S.runs(data, 200)
    assert sum(whole[2]) == sum(parts[2]) == 4801
    assert set(whole[0]) == set(parts[0])


def test_hash_of_kept_bytes_is_plain_sha256():
    assert hashlib.sha256(brute(["abc"], 200)[0][3]).hexdigest() == hashlib.sha256(b"abc").hexdigest()
