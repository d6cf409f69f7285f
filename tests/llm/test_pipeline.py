from hashlib import sha256

import corpus_pipeline
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

from censusloom.llm import bpe
from tests.llm import test_partenum, test_substring, test_winnow


def test_stages_match_brute_force(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("shard", F.lit("clash"))
    before = {r.doc_id: r for r in docs.collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / str(k)))
        after = spark.read.parquet(str(tmp_path / str(k)))
        rows = {r.doc_id: r for r in after.collect()}
        texts = [(d, r.text) for d, r in sorted(before.items())]
        if k < 4:
            assert after.columns == docs.columns
        if k in (0, 1, 3):
            assert all(rows[d] == before[d] for d in rows)
        if k == 0:
            labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
            bad = {r.doc_id for r in labels if not r.quality or r.toxic}
            good = {r.doc_id for r in labels} - bad
            assert len(good & set(rows)) > 0.9 * len(good) and len(bad & set(rows)) < 0.5 * len(bad)
        elif k == 1:
            assert set(rows) == {d for d, _, c in test_partenum.brute(texts) if d == c}
        elif k == 2:
            for d, _, gone, _, kept in test_substring.brute(texts):
                want = kept if gone else before[d].text
                assert (rows[d].text, rows[d].n_chars, rows[d].source) == (want, len(want), before[d].source)
            assert set(rows) == set(before)
        elif k == 3:
            assert set(rows) == {r[0] for r in test_winnow.brute(texts, items) if not r[4]}
        else:
            library = tiktoken.Encoding(
                "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={}
            )
            assert set(rows) == set(before)
            for d, text in texts:
                assert rows[d].ids == library.encode_ordinary(text)
                assert rows[d].decoded_sha256 == sha256(text.encode()).hexdigest()
        docs, before = after, rows


def test_run_is_the_stages_in_order(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    want = sorted(tuple(r) for r in docs.select("doc_id", "ids_sha256").collect())
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, sf_dir).select("doc_id", "ids_sha256").collect()) == want


def test_clashing_repeated_and_empty(spark, sf_dir):
    base = "doc_id long, text string, lang string, source string, n_chars long, row string, bin long, weight string, _extra int"
    rows = [(1, "a b c d e f g", "en", "s", 13, "x", 1, "y", 2), (1, "a b c d e f g", "en", "s", 13, "x", 1, "y", 2), (2, None, None, None, None, None, None, None, None)]
    rows += [(None, "a b c d e f g", None, "s", 13, None, 1, "y", 2), (3, "", "en", "s", 0, "x", 1, "y", 2), (4, "z " * 30000, "en", "s", 60000, "x", 1, "y", 2)]
    docs = spark.createDataFrame(rows, base)
    for some in (docs, docs.where("false")):
        at = some
        for _, stage in corpus_pipeline.STAGES[:-1]:
            at = stage(spark, at, sf_dir)
            assert at.columns == docs.columns
        ids = [r.doc_id for r in corpus_pipeline.STAGES[-1][1](spark, at, sf_dir).collect()]
        assert sorted(ids, key=str) == ([] if some is not docs else sorted([1, 2, 3, 4, None], key=str))


def test_clean_rows_of_a_shared_key_stay(spark, tmp_path):
    item = " ".join(f"i{k}" for k in range(13))
    spark.createDataFrame([(7, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    shared = [(None, item), (None, "clean one"), (None, "clean two"), (None, None), (1, item), (1, "clean three"), (2, "x " + item)]
    docs = spark.createDataFrame(shared, "doc_id long, text string")
    left = [tuple(r) for r in corpus_pipeline.benchmark_decontamination(spark, docs, str(tmp_path)).collect()]
    assert sorted(left, key=str) == sorted([r for r in shared if item not in (r[1] or "")], key=str)


def test_different_texts_of_a_key_are_no_near_duplicates(spark, sf_dir):
    a, b, c = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    rows = [(3, a), (3, b), (3, b), (3, b + " more"), (1, a), (4, c), (4, "short"), (5, c + " more"), (None, c), (None, c), (6, ""), (6, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = [tuple(r) for r in corpus_pipeline.near_duplicates(spark, docs, sf_dir).collect()]
    assert sorted(left, key=str) == sorted([(3, b), (1, a), (4, c), (4, "short"), (None, c), (None, c), (6, ""), (6, None)], key=str)
