import random

from callcorpus.llm import line_dedup as L
from llm_edges import awkward, documents, words


def words_of(line):
    return len(line.encode().split())


def shared(owner, later):
    """Lines of ``later`` from the first to the last line with words of every common run of 10
    words, and the blank lines between such lines; by comparing every place with every place."""
    gone = set()
    for j in range(len(later)):
        for i in range(len(owner)):
            k = 0
            while j + k < len(later) and i + k < len(owner) and later[j + k] == owner[i + k]:
                k += 1
            worded = [x for x in range(j, j + k) if words_of(later[x])]
            if sum(words_of(later[x]) for x in worded) >= 10:
                gone.update(range(worded[0], worded[-1] + 1))
    out = sorted(gone)
    for x, y in zip(out, out[1:]):
        if not any(map(words_of, later[x + 1 : y])):
            gone.update(range(x + 1, y))
    return gone


def runs_of(lines):
    """Every run of consecutive lines that has 10 words and no fewer lines would do."""
    out = set()
    for j in range(len(lines)):
        for k in range(j + 1, len(lines) + 1):
            run = lines[j:k]
            if words_of(run[0]) and words_of(run[-1]) and sum(map(words_of, run)) >= 10 and (sum(map(words_of, run[:-1])) < 10 or sum(map(words_of, run[1:])) < 10):
                out.add(tuple(run))
    return out


def brute(rows):
    """Pairs each text with the earliest holders of its lines and of its shortest runs of 10
    words, in order of the ids."""
    texts, owner, out = {}, {}, {}
    order = sorted({(i is None, i or 0, t) for i, t, *_ in rows if t is not None})
    for late, i, t in order:
        texts.setdefault(t, (late, i))
    done = {}
    for late, i, t in order:
        if texts[t] != (late, i) or t in done:
            continue
        lines = t.split("\n")
        drop = set()
        keys = {x for x in lines if words_of(x)} | runs_of(lines)
        for o in {owner[x] for x in keys if x in owner}:
            drop |= shared(o.split("\n"), lines)
        for x in keys:
            owner.setdefault(x, t)
        done[t] = "\n".join(x for k, x in enumerate(lines) if k not in drop)
    for i, t, *_ in rows:
        if t is None:
            out.setdefault(i, []).append(None)
        elif texts[t] != (i is None, i or 0) and sum(map(words_of, t.split("\n"))) >= 10:
            out.setdefault(i, []).append("")
        else:
            out.setdefault(i, []).append(done[t] if texts[t] == (i is None, i or 0) else t)
    return {i: sorted(x, key=str) for i, x in out.items()}


def check(spark, rows):
    got = {}
    done = L.dedup_lines(documents(spark, rows))
    for r in done.collect():
        got.setdefault(r.doc_id, []).append(r.text)
    assert {i: sorted(x, key=str) for i, x in got.items()} == brute(rows)
    return done


def test_awkward_rows(spark):
    done = check(spark, awkward())
    assert [c for c in done.columns if c != "line_dedup"] == documents(spark, []).columns


def test_shared_blocks(spark):
    rng = random.Random(3)
    pool = [words(rng, rng.randint(1, 14)) for _ in range(25)] + [""]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randint(0, 3)):
            a = rng.randrange(len(pool))
            lines += pool[a : a + rng.randint(1, 6)] if rng.random() < 0.6 else [words(rng, 12, 10**6) for _ in range(rng.randint(1, 4))]
        rows.append((i, "\n".join(lines), "en", "a"))
    check(spark, rows)


def left_by(spark, texts):
    done = L.dedup_lines(documents(spark, [(i, t, "en", "a") for i, t in enumerate(texts)]))
    return [r.text for r in done.orderBy("doc_id").collect()]


def test_block_whose_lines_have_other_owners(spark):
    a, b = "one two three four five six", "seven eight nine ten eleven"
    texts = [f"{a}\nfirst text", f"{b}\nsecond text", f"third text\n{a}\n{b}", f"{a}\n{b}\nfourth text"]
    assert left_by(spark, texts) == [*texts[:3], "fourth text"]


def test_repeated_and_moved_blocks(spark):
    p, q = "p1 p2 p3 p4 p5 p6\np7 p8 p9 p10 p11", "q1 q2 q3 q4 q5 q6 q7 q8 q9 q10 q11"
    texts = [f"x\n{p}\ny\n{q}", f"u\n{p}\nv\n{p}\nw", f"r\n{q}\ns\n{p}\nt"]
    assert left_by(spark, texts) == [texts[0], "u\nv\nw", "r\ns\nt"]


def test_no_common_block_is_left(spark):
    """Lines with words of the first copies against a comparison with every earlier text."""
    rng = random.Random(3)
    pool = [words(rng, rng.randint(1, 14)) for _ in range(25)]
    texts = []
    for _ in range(60):
        a = rng.randrange(len(pool))
        texts.append("\n".join([*pool[a : a + rng.randint(1, 6)], *rng.sample(pool, 3), *pool[a : a + 3]]))
    want = []
    for n, t in enumerate(texts):
        lines, gone = t.split("\n"), set()
        for e in (x.split("\n") for x in texts[:n]):
            for j in range(len(lines)):
                for i in range(len(e)):
                    k = 0
                    while j + k < len(lines) and i + k < len(e) and lines[j + k] == e[i + k]:
                        k += 1
                    if sum(map(words_of, lines[j : j + k])) >= 10:
                        gone.update(range(j, j + k))
        want.append("" if t in texts[:n] else "\n".join(x for j, x in enumerate(lines) if j not in gone))
    assert left_by(spark, texts) == want


def test_matches_are_increasing_and_equal():
    rng = random.Random(5)
    for n in range(900):
        size, kinds = rng.choice([(15, 12), (40, 3), (60, 6)])
        a = [rng.randrange(kinds) for _ in range(rng.randrange(size))]
        b = [rng.randrange(kinds) for _ in range(rng.randrange(size))]
        found = L.matches(a, b)
        assert all(a[i] == b[j] for i, j in found)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(found, found[1:]))
        assert bool(found) == bool(set(a) & set(b))
    assert L.matches([1, 2, 3, 4], [9, 2, 3, 8]) == [(1, 1), (2, 2)]
    assert len(L.matches(list(range(50)), list(range(50)))) == 50


def test_common_lines_by_repeated_alignment():
    rng = random.Random(6)
    for _ in range(400):
        pool = [words(rng, rng.randint(1, 7)) for _ in range(6)] + ["", words(rng, 12)]
        owner, later = ([rng.choice(pool) for _ in range(rng.randint(1, 14))] for _ in range(2))
        assert set(L.common_lines(owner, later, [words_of(x) for x in later], 10)) == shared(owner, later)


def test_the_alignment_decides(monkeypatch):
    lines = [f"line {k} of a block that has well over ten words in it" for k in range(4)]
    assert L.common_lines(lines, lines, [12] * 4, 10) == [0, 1, 2, 3]
    monkeypatch.setattr(L, "matches", lambda a, b: [])
    assert L.common_lines(lines, lines, [12] * 4, 10) == []


def test_lines_that_differ_little_are_kept_apart(spark):
    """Structured lines of over 1,024 bytes: every swap of two words at distances that are
    powers of two gives another line, and all of them stay."""
    base = [f"a{k % 2}" for k in range(512)]
    texts = [" ".join(base)]
    for step in (1, 8, 64, 256):
        for at in (0, 1, 2, 3):
            other = list(base)
            other[at], other[at + step] = ("a1", "a0") if at % 2 else ("a0", "a1")
            texts.append(" ".join(other) + "\nnext")
            # the Thue-Morse word and its complement
    morse = ["ab"[bin(k).count("1") & 1] for k in range(1024)]
    texts += [" ".join(morse), " ".join("ba"["ab".index(c)] for c in morse)]
    texts = list(dict.fromkeys(texts))
    lines = {t.split("\n")[0] for t in texts}
    got = left_by(spark, texts)
    assert {x for t in got for x in t.split("\n")} >= lines


def test_every_line_survives_somewhere(spark):
    rows = awkward()
    left = {x for r in L.drop_repeated(documents(spark, rows)).collect() for x in (r.text or "").split("\n")}
    assert {x for _, t, *_ in rows for x in (t or "").split("\n") if words_of(x)} <= left


def test_empty_table(spark):
    assert L.dedup_lines(documents(spark, [])).count() == 0
