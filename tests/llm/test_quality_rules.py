from collections import Counter

from pyspark.sql import functions as F

from callcorpus.llm import quality_rules as Q
from llm_edges import awkward, documents


def brute(text):
    t = text or ""
    w = t.encode().split()
    win = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    seen = Counter(win)
    hit = {i + j for i, x in enumerate(win) if seen[x] > 1 for j in range(5)}
    lines = [x for x in t.split("\n") if x.encode().split()]
    return (len(w), sum(len(x.decode()) for x in w), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit))


def test_measures(spark):
    rows = awkward() + [(50, "a b c d e a b c d e", "en", "a"), (51, "x\n x\nx\n\nx", "en", "a"), (52, "# * $ % & | < > " * 3, "en", "a"), (53, "a a a a a a", "en", "a"), (54, "\u00a0 \x0b\x0c é", "en", "a")]
    got = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in Q.measure(documents(spark, rows)).collect())
    assert got == sorted((str(i), *brute(t)) for i, t, *_ in rows)


def test_policies_and_ablation_agree_with_the_rules(spark):
    rows = [(i, t, "en", "a") for i, t in enumerate(["w " * 5, "w " * 30, "some plain words that stand here once and never come again at all", "# " * 40 + "one two three four five six", None, "ab " * 4])]
    led = Q.ledger(documents(spark, rows)).cache()
    for name, mask in Q.POLICIES.items():
        kept = {r.doc_id for r in Q.apply_policies(led, {name: mask}).filter(f"keep_{name}").collect()}
        bits = {r.doc_id: r.fail_bits for r in led.collect()}
        assert kept == {i for i, b in bits.items() if not b & mask}
        rows_of = {r.rule: r for r in Q.ablation(led, mask).collect()}
        for rule in Q.RULES:
            if mask >> rule.bit & 1:
                r = rows_of[rule.name]
                assert r.n_failed == sum(b >> rule.bit & 1 for b in bits.values())
                assert r.n_failed_only_this == sum(b & mask == 1 << rule.bit for b in bits.values())
                assert r.n_kept_by_all == len(kept)
        sole = {r[0]: r[1] for r in led.select("doc_id", Q.sole_rule(mask)).collect()}
        names = {1 << r.bit: r.name for r in Q.RULES}
        assert sole == {i: names.get(b & mask) for i, b in bits.items()}


def test_clean_text_is_kept(spark):
    text = " ".join(f"word{i} stands" for i in range(30)) + ".\nA second line of it."
    led = Q.ledger(documents(spark, [(1, text, "en", "a")]))
    assert Q.apply_policies(led).select("keep_v2").first()[0]


def test_empty_table(spark):
    led = Q.ledger(documents(spark, []))
    assert led.count() == 0 and Q.ablation(led, Q.POLICIES["v1"]).agg(F.sum("n_failed")).first()[0] is None
