"""The pipeline's stages on the smallest tables and on edge rows, against brute force."""

import os

import corpus_pipeline as C
import public_tokenizers
from conftest import SF_SMALL
from netscope.llm import packing, quality_rules

from . import test_minhash_links as near
from . import test_packing as pack
from . import test_quality_rules as rules
from . import test_recompression as sub


def _rejected(text):
    n, chars, symbols, lines, dup, repeated = rules.brute(text)
    return (n < 50 or 100 * repeated > 50 * n or 10 * symbols > n or 10 * dup > 3 * lines
            or chars < 2 * n or chars > 15 * n)


def test_stages_on_the_smallest_tables(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, before = docs.columns, [(r["doc_id"], r["text"]) for r in docs.collect()]
    last = [n for n, _ in C.STAGES][-1]
    for name, stage in C.STAGES:
        stage(spark, docs, SF_SMALL).write.parquet(os.path.join(tmp_path, name))
        docs = spark.read.parquet(os.path.join(tmp_path, name))
        rows = docs.collect()
        if name != last:
            assert docs.columns == columns
        after = [(r["doc_id"], r["text"]) for r in rows] if name != last else None
        if name == "quality_rules":
            assert sorted(after) == sorted((i, t) for i, t in before if not _rejected(t))
        elif name == "quality_classifier":
            assert set(after) <= set(before) and len(after) >= 0.7 * len(before)
        elif name == "near_dedup":
            want = near.brute(before, k=5)
            assert sorted(after) == sorted((i, t) for i, t in before if want[i][1] == i)
        elif name == "substring_dedup":
            want = sub.brute(before)
            got = {i: (t or "").encode().split() for i, t in after}
            assert got == {i: w[2] for i, w in want.items() if w[2] or not w[1]}
            assert all(r["n_chars"] == len(r["text"]) for r in rows)
        else:
            pack.check(before, rows)
        before = after
    assert C.run(spark, SF_SMALL).count() == len(rows)


def test_stages_on_edge_rows(spark, make_docs, edge_rows):
    docs = make_docs(edge_rows)
    for name, stage in C.STAGES:
        out = stage(spark, docs, SF_SMALL)
        rows = out.collect()
        if name != "packing":
            assert out.columns == docs.columns
        if name == "near_dedup":
            assert sorted(r["doc_id"] for r in rows if r["doc_id"] is not None and r["doc_id"] in (1, 2)) == [1]
        assert stage(spark, make_docs([]), SF_SMALL).count() == 0
    assert packing.TIERS[0] == 2048 and public_tokenizers.path(packing.VOCABULARY)
    assert set(quality_rules.RULES) >= set(quality_rules.BASE_RULES)


def test_near_dedup_takes_five_words(spark, make_docs):
    """Spread changes that leave 0.8 of the four-word shingles but fewer of the five-word ones are no copy."""
    base = [f"w{i}" for i in range(200)]

    def changed(places):
        return " ".join(f"x{i}" if i in places else w for i, w in enumerate(base))

    rows = [(1, " ".join(base)), (2, changed((20, 60, 100, 140, 180))), (3, changed((10, 50, 90, 130)))]
    alike = lambda a, b, k: len(near.sets(a, k) & near.sets(b, k)) / len(near.sets(a, k) | near.sets(b, k))
    assert alike(rows[0][1], rows[1][1], 4) >= 0.8 > alike(rows[0][1], rows[1][1], 5)
    assert alike(rows[0][1], rows[2][1], 5) >= 0.8 > alike(rows[1][1], rows[2][1], 4)
    out = dict(C.STAGES)["near_dedup"](spark, make_docs(rows), SF_SMALL)
    assert sorted(r["doc_id"] for r in out.collect()) == [1, 2]
