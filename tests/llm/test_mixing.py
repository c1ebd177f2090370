import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from callcorpus.llm import mixing as M
from llm_edges import awkward, documents


def fill(sizes, weights, share, epochs):
    """Water-filling by bisection on the level: another method than the operator's."""
    total = share * sum(sizes)
    low, high = 0.0, max([s * epochs for s in sizes], default=0) + total + 1
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(s * epochs, mid * w) for s, w in zip(sizes, weights)) < total else (low, mid)
    return [min(s * epochs, high * w) for s, w in zip(sizes, weights)]


def key_of(i, text, seed=20):
    parts = [str(seed)] + ([str(i)] if i is not None else []) + ([hashlib.md5(text.encode()).hexdigest()] if text is not None else [])
    return int(hashlib.md5("|".join(parts).encode()).hexdigest()[:15], 16)


def check(spark, rows):
    got = M.mixture(documents(spark, rows)).collect()
    size = lambda t: len((t or "").encode().split())
    by = defaultdict(list)
    for i, t, _, s in rows:
        by[s].append((key_of(i, t), size(t)))
    names = sorted((s for s in by if s is not None), key=lambda s: s.encode()) + ([None] if None in by else [])
    sizes = [sum(n for _, n in by[s]) for s in names]
    targets = dict(zip(names, fill(sizes, [(3, 1, 2)[k % 3] for k in range(len(names))], 1.5, 2)))
    assert len(got) == len(rows)
    taken = defaultdict(int)
    for r in got:
        assert r.target == pytest.approx(targets[r.source], rel=1e-6, abs=1e-6)
        assert 0 <= r.copies <= 2 and r.source_size == sum(n for _, n in by[r.source])
        taken[r.source] += r.size * r.copies
    for s in names:  # no cut between two keys comes nearer
        whole = int(min(targets[s] / max(1, sum(n for _, n in by[s])) + 1e-9, 2))
        rest, run, near = targets[s] - whole * sum(n for _, n in by[s]), 0, None
        tries = [0]
        for k in sorted({k for k, _ in by[s]}):
            run += sum(n for x, n in by[s] if x == k)
            tries.append(run)
        near = min(abs(t - rest) for t in tries)
        assert abs(taken[s] - targets[s]) <= near + 1e-6, s
    assert sorted(map(str, got)) == sorted(map(str, M.mixture(documents(spark, rows)).collect()))


def test_awkward_rows(spark):
    check(spark, awkward())


def test_many_sources(spark):
    check(spark, [(i, "w " * (1 + i * i % 97), "en", f"s{i % 11 if i % 3 else 0}") for i in range(400)])


def test_documents_of_the_mix(spark):
    rows = [(i, "w " * (5 + i % 9), "en", f"s{i % 3}") for i in range(60)]
    docs = documents(spark, rows)
    out = M.mix_documents(docs)
    assert out.columns == [c for c in docs.columns if c != "copies"] + ["copies"]
    plan = {r.doc_id: r.copies for r in M.mixture(docs).collect()}
    assert {r.doc_id: r.copies for r in out.collect()} == {i: c for i, c in plan.items() if c}


def test_empty_table(spark):
    assert M.mixture(documents(spark, [])).count() == 0
    assert M.mixture(documents(spark, [(1, "", "en", "a"), (2, None, "en", None)])).agg(F.sum("copies")).first()[0] == 0
