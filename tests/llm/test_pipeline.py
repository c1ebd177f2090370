"""The pipeline's stages, one by one, on rows whose fate is known."""

import os
import random

import pytest

import corpus_pipeline as P
from callcorpus.llm import queries as Q
from llm_edges import awkward, documents, words

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op2_mixing": ["doc_id", "size", "source_size", "target", "taken"],
    "op3_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op4_line_dedup": ["doc_id"],
    "op5_langid": ["doc_id", "held_out", "lang_pred", "score"],
    "op6_near_dedup": ["doc_id", "class_id"],
    "op7_decontaminate": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op8_url_filter": ["page_id", "host", "path", "rule", "verdict"],
    "op9_token_counts": ["doc_id"],
    "op10_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op11_repair": ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"],
    "op12_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op13_spelling": ["word", "n", "form", "form_n", "n_near", "root"],
}
#: Tables other than documents that a query has its rows from, and their ids.
ROWS_OF = {"op8_url_filter": ("pages", "page_id"), "op11_repair": ("conversations", "conv_id")}


def test_stages(spark, tmp_path):
    rng = random.Random(1)
    near = words(rng, 200, 10**6).split()
    other = [*near[:100], "changed", *near[101:]]
    passage = words(rng, 30, 10**6)
    block = "\n".join(words(rng, 12, 10**6) for _ in range(3))
    rows = [(i, words(rng, 60, 10**6), "en", f"s{i % 3}") for i in range(20)]
    rows += [(30, " ".join(near), "en", "s0"), (31, " ".join(other), "en", "s0"), (32, " ".join(near), "en", "s0")]
    rows += [(40, passage, "en", "s1"), (50, "own words of fifty\n" + block, "en", "s1"), (51, block + "\nown words of fiftyone", "en", "s1"), (60, "12345 !!", "en", "s2")]
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, ids = documents(spark, rows), {}
    assert [n for n, _ in P.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontaminate", "mix"]
    for name, stage in P.STAGES:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        if name != "mix":
            assert out.columns == docs.columns
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        ids[name] = {r.doc_id: r.text for r in docs.collect()}
    assert set(ids["language_id"]) == {i for i, *_ in rows} - {60}
    assert 32 not in ids["line_dedup"] and ids["line_dedup"][51] == "own words of fiftyone"
    assert set(ids["line_dedup"]) - set(ids["near_dedup"]) == {31}
    assert set(ids["near_dedup"]) - set(ids["decontaminate"]) == {40}
    assert set(ids["mix"]) <= set(ids["decontaminate"])


def test_stages_on_awkward_rows(spark, tmp_path):
    """Null, empty and very long texts, null ids, ties and repeated rows, clashing columns, and
    an empty table pass all stages; a null text is rejected by the first."""
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for rows in (awkward(), []):
        docs, sizes = documents(spark, rows), []
        for name, stage in P.STAGES:
            path = f"{tmp_path}/{name}-{len(rows)}"
            stage(spark, docs, str(tmp_path)).write.parquet(path)
            docs = spark.read.parquet(path)
            sizes.append(docs.count())
            assert set(documents(spark, []).columns) <= set(docs.columns) | {"copies"}
        assert sizes == sorted(sizes, reverse=True) and (sizes[0] > 0) == bool(rows)
        assert not docs.filter("text IS NULL").count()


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_registered_query(spark, name):
    out = Q.QUERIES[name](spark, SF)
    assert set(COLUMNS[name]) <= set(out.columns)
    if name == "op13_spelling":  # a row per word
        assert 0 < out.count() == out.select("word").distinct().count()
        return
    table, key = ROWS_OF.get(name, ("documents", "doc_id"))
    rows = spark.read.parquet(f"{SF}/{table}.parquet")
    assert out.select(key).distinct().count() == rows.select(key).distinct().count()
