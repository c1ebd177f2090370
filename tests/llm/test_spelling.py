import random
import re
import zlib
from collections import Counter

import numpy as np

from callcorpus.llm import spelling as S
from llm_edges import awkward, documents


def one_edit(a, b):
    """From the contract's words: all strings one edit away."""
    letters = sorted(set(a + b))
    out = {a[:i] + a[i + 1 :] for i in range(len(a))}
    out |= {a[:i] + x + a[i + 1 :] for i in range(len(a)) for x in letters}
    out |= {a[:i] + x + a[i:] for i in range(len(a) + 1) for x in letters}
    return a != b and b in out


def count_words(rows, every):
    found = Counter()
    for doc, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                found[run] += 1
    return {w: n for w, n in found.items() if n >= 5}


def brute(n):
    near = {w: [x for x in n if abs(len(x) - len(w)) < 2 and one_edit(w, x)] for w in n}
    form = {w: min(near[w], key=lambda x: (-n[x], x)) for w in n if near[w]}
    form = {w: f for w, f in form.items() if n[f] >= 5 * n[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return {w: (form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n}


def result(df):
    rows = df.collect()
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(got) == len(rows)
    return got


def edits(rng, word, alphabet):
    i = rng.randrange(len(word))
    return rng.choice([word[:i] + word[i + 1 :], word[:i] + rng.choice(alphabet) + word[i + 1 :], word[:i] + rng.choice(alphabet) + word[i:]])


def crowd(rng, n, alphabet="abcdé"):
    """Words with many near ones, counts over several powers of the ratio."""
    seeds = ["".join(rng.choice(alphabet) for _ in range(rng.randint(6, 9))) for _ in range(n)]
    for _ in range(n):
        seeds.append(edits(rng, rng.choice(seeds), alphabet))
    return {w: rng.choice([5, 6, 25, 25, 130, 700, 4000]) for w in seeds if len(w) >= 6}


def test_the_edit_check():
    rng = random.Random(1)
    a, b = [], []
    for _ in range(4000):
        w = "".join(rng.choice("abc") for _ in range(rng.randint(1, 9)))
        a.append(w)
        b.append(rng.choice([edits(rng, w, "abc"), edits(rng, edits(rng, w, "abc") or "a", "abc"), w[::-1], w]) or "c")
    want = [one_edit(x, y) for x, y in zip(a, b)]
    assert [S._one_edit(x, y) for x, y in zip(a, b)] == want
    assert S._verified(np.array(a), np.array(b)).tolist() == want
    assert 500 < sum(want) < 3500


def test_every_near_pair_shares_one_owner():
    rng = random.Random(2)
    for _ in range(2000):
        w = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(rng.randint(1, 12)))
        x = edits(rng, w, "abcdefghijklmnopqrstuvwxyzé")
        if not x or x == w:
            continue
        a, b = S.blocks([w, x])
        owners = [{tuple(at + s) for s in S._shifts()} for at in (a, b)]
        homes = [tuple(a), tuple(b)]
        assert (homes[0] == homes[1]) + (homes[0] != homes[1]) * ((homes[0] in owners[1]) + (homes[1] in owners[0])) == 1


def test_groups_agree_with_brute_force(spark):
    n = crowd(random.Random(3), 400)
    assert result(S.group_variants(spark.createDataFrame(list(n.items()), "word string, n long"))) == brute(n)


def test_tiles_and_steps(spark, monkeypatch):
    """Blocks of many tiles, and groups longer than a step, give the same pairs once. (The
    workers read the module's values, so only the parts that run here are made small.)"""
    n = crowd(random.Random(4), 300, "abé")
    words = list(n)
    monkeypatch.setattr(S, "PRODUCT", 50)
    tile = S._Tile(words, [n[w] for w in words])
    pairs = [(str(a), str(b)) for x in tile.pairs(words, [n[w] for w in words], True, False) for a, b in zip(x[0], x[2])]
    assert len(pairs) == len({frozenset(p) for p in pairs})
    assert {frozenset(p) for p in pairs} == {frozenset((a, b)) for a in words for b in words if abs(len(a) - len(b)) < 2 and one_edit(a, b)}
    monkeypatch.setattr(S, "TILE", 40)
    assert result(S.group_variants(spark.createDataFrame(list(n.items()), "word string, n long"))) == brute(n)


def test_long_words(spark):
    base = "abc" * 2000
    n = {base: 50, base + "d": 5, "x" + base: 400, "q" * 700: 5, "q" * 701: 60, "q" * 702: 5, "abcabca": 9}
    got = result(S.group_variants(spark.createDataFrame(list(n.items()), "word string, n long")))
    assert got["q" * 700][:2] == ("q" * 701,) * 2 and got["q" * 702][0] == "q" * 701
    assert got[base][:2] == ("x" + base,) * 2 and got[base][3] == 2
    assert got[base + "d"][:2] == (base, "x" + base)
    assert got["abcabca"][3] == 0


def test_texts_to_groups(spark):
    rng = random.Random(5)
    vocabulary = ["theatre", "theater", "Colour", "COLOUR", "colours", "Éclairs", "éclairs", "straße", "naïveté", "abcdef", "abcdefg", "ab"]
    rows = awkward() + [(i if i % 9 else None, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 40))) + ", 3x×÷y-", "en", "a") for i in range(100, 260)]
    for every in (199, 7):
        n = count_words(rows, every)
        assert result(S.vocabulary(S.damaged(documents(spark, rows), every)).selectExpr("word AS word", "n AS form", "NULL AS root", "n", "0 AS n_near", "0 AS form_n")).keys() == n.keys()
        assert result(S.group_variants(S.vocabulary(S.damaged(documents(spark, rows), every)))) == brute(n)


def test_empty_table(spark):
    assert S.group_variants(S.vocabulary(S.damaged(documents(spark, []), 199))).count() == 0
    assert S.group_variants(S.vocabulary(S.damaged(documents(spark, [(1, None, "en", "a"), (2, "", "en", "a")]), 199))).count() == 0
