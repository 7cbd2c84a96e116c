"""Language identification: held-out accuracy, codes, bounded learning sample."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from conftest import SF_SMALL
from netscope.llm import language_id as L


def test_held_out_accuracy(spark):
    rows = L.query(spark, SF_SMALL).join(spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(
        "doc_id", "lang", "text"), "doc_id").collect()
    assert len(rows) == 200
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)


def test_edge_cases(make_docs, edge_rows):
    docs = make_docs(edge_rows).withColumn("lang", F.when(F.col("doc_id") % 3 == 0, "aa").when(
        F.col("doc_id") % 3 == 1, "bb"))
    model = L.fit(L.sample(docs, F.lit(True), "doc_id", "text", "lang", 100))
    rows = L.identify(docs, model).collect()
    assert len(rows) == len(edge_rows)
    texts = {i: t for i, t in edge_rows}
    for r in rows:
        assert r["lang_pred"] in ("aa", "bb", "und")
        if r["doc_id"] is not None:
            has = any(ch.isalpha() for ch in texts[r["doc_id"]] or "")
            assert (r["lang_pred"] == "und") == (not has) and (r["score"] > 0) == has
    assert L.identify(make_docs([]), model).count() == 0


def test_nothing_to_learn_from(make_docs, edge_rows):
    docs = make_docs(edge_rows).withColumn("lang", F.lit(None).cast("string"))
    model = L.fit(L.sample(docs, F.lit(True), "doc_id", "text", "lang", 100))
    assert {(r["lang_pred"], r["score"]) for r in L.identify(docs, model).collect()} == {("und", 0.0)}


def test_rare_languages_are_learned(make_docs):
    """The sample is shared out by language: 3 rows among 3,000 are learned, the bound holds."""
    words = {"aa": "the cat and the dog ran home", "bb": "el gato y el perro van a casa", "zz": "қызыл үй және ақ ит"}
    rows = [(i, words["zz" if i % 1000 == 7 else "bb" if i % 10 == 3 else "aa"]) for i in range(3000)]
    lang = F.when(F.col("doc_id") % 1000 == 7, "zz").when(F.col("doc_id") % 10 == 3, "bb").otherwise("aa")
    docs = make_docs(rows).withColumn("lang", lang)
    sampled = L.sample(docs, F.lit(True), "doc_id", "text", "lang", 400)
    counts = {r["lang"]: r["count"] for r in sampled.groupBy("lang").count().collect()}
    assert counts["zz"] == 3 and 130 < counts["aa"] < 270 and 130 < counts["bb"] < 270
    model = L.fit(sampled)
    assert model.languages == ["aa", "bb", "zz"]
    got = {r["doc_id"]: r["lang_pred"] for r in L.identify(docs, model).collect()}
    assert all(words[got[i]] == t for i, t in rows)


def test_codewords_correct_errors():
    for n in (1, 2, 3, 4, 7, 8, 20):
        codes = L.codewords(n)
        assert codes.shape[0] == n
        far = [(codes[i] != codes[j]).sum() for i in range(n) for j in range(i)]
        assert not far or min(far) >= (1 if n < 4 else 4)


def test_ngrams_do_not_cross_texts():
    both, offsets, has = L.ngrams(["Ab c!", None, "123", "ab  C"])
    one = L.ngrams(["ab c"])[0]
    assert np.array_equal(both[offsets[0]:offsets[1]], one) and np.array_equal(both[offsets[3]:offsets[4]], one)
    assert has.tolist() == [True, False, False, True]
