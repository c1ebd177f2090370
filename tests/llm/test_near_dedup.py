import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from callcorpus.llm import near_dedup as N
from llm_edges import awkward, documents, words


def bag(text):
    w = (text or "").encode().split()
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def brute(rows):
    """class ids by exact comparison of all pairs of texts."""
    texts = sorted({t for _, t, *_ in rows if bag(t)})
    bags = [bag(t) for t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            both = sum((bags[i] & bags[j]).values())
            if 10 * both >= 8 * (sum(bags[i].values()) + sum(bags[j].values()) - both):
                parent[root(i)] = root(j)
    least = defaultdict(list)
    at = {t: root(i) for i, t in enumerate(texts)}
    for i, t, *_ in rows:
        if t in at:
            least[at[t]].append(i)
    return sorted(((i, min((x for x in least[at[t]] if x is not None), default=None)) if t in at else (i, i) for i, t, *_ in rows), key=str)


def variants(rng, base, n, edits):
    out = []
    for _ in range(n):
        w = base.split()
        for _ in range(edits):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def family_rows(seed):
    rng = random.Random(seed)
    texts = []
    for f in range(6):
        base = words(rng, 150, 5000)
        texts += [base, *variants(rng, base, 6, 2), *variants(rng, base, 3, 12)]
    texts += [words(rng, 80, 5000) for _ in range(30)]
    texts += ["the same word " * 40, "the same word " * 41, "the same word " * 90]
    rng.shuffle(texts)
    return [(i, t, "en", "a") for i, t in enumerate(texts)]


def classes_of(spark, rows):
    return sorted(((r.doc_id, r.class_id) for r in N.assign(documents(spark, rows)).collect()), key=str)


def test_awkward_rows(spark):
    rows = awkward()
    assert classes_of(spark, rows) == brute(rows)


def test_families(spark):
    rows = family_rows(2)
    assert classes_of(spark, rows) == brute(rows)


def test_large_buckets_are_compared_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(N, "TILE", 3)
    rows = family_rows(4)
    assert classes_of(spark, rows) == brute(rows)


def test_estimates_are_unbiased():
    rng = np.random.default_rng(1)
    errors = []
    for t in range(60):
        universe = rng.integers(1, 2**62, 120).astype(np.uint64)
        a, b = rng.integers(0, 9, 120), rng.integers(0, 9, 120)
        rows = [(universe[c > 0], c[c > 0]) for c in (a, b)]
        text = np.repeat([0, 1], [len(rows[0][0]), len(rows[1][0])])
        sig = N.signatures(text, np.concatenate([rows[0][0], rows[1][0]]), np.concatenate([rows[0][1], rows[1][1]]), 2)
        errors.append((sig[0] == sig[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(errors)) < 0.02
    assert np.std(errors) < 0.07


def test_similarity_of_bags():
    a, b = np.array([3, 5, 9], dtype=np.uint64), np.array([5, 9, 11], dtype=np.uint64)
    ca, cb = np.array([1, 4, 2], dtype=np.uint32), np.array([2, 2, 1], dtype=np.uint32)
    assert N.similarity(a.tobytes() + ca.tobytes(), b.tobytes() + cb.tobytes()) == pytest.approx(4 / 8)


def test_keep_first(spark):
    rows = awkward()
    kept = N.keep_first(documents(spark, rows))
    assert kept.columns == documents(spark, []).columns
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    base = {i for i, c in brute(rows)} - {None}
    assert sorted(x for x in ids if x is not None) == sorted({c for _, c in brute(rows)} - {None}) and set(ids) <= base | {None}


def test_empty_table(spark):
    assert N.assign(documents(spark, [])).count() == 0


def crowded_rows():
    """78 pairs of similarity 0.82 and no other of 0.8, but many that look closer by
    signature: each text edits five spots, of which any two texts share one at most and
    partners share one edit."""
    texts = []
    for b in range(13):
        for a in range(12):
            w = [f"b{i}" for i in range(400)]
            for i in range(5):
                w[4 + 5 * (13 * i + (a * i + b) % 13)] = f"t{a if i else a // 2}b{b}i{i}"
            texts.append(" ".join(w))
    return [(i, t, "en", "a") for i, t in enumerate(texts)]


@pytest.mark.parametrize("tile", [30, 1024])
def test_partners_behind_texts_that_look_closer(spark, monkeypatch, tile):
    monkeypatch.setattr(N, "TILE", tile)
    rows = crowded_rows()
    assert classes_of(spark, rows) == brute(rows) == sorted(((i, i - i % 2) for i, *_ in rows), key=str)
