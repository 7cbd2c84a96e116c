"""Training-data pipeline over ``documents``: rules, classifier, near-dedup, substring dedup, packing.

Every stage takes what its predecessor kept, whole, and all but the last return the columns of
``documents``.  Stages are joined by Parquet tables in the shared folder, so a lost executor or a failed
stage repeats one stage's work at most.

Documents with a null ``doc_id`` pass the dedup stages untouched; repeated rows (same ``doc_id`` and
text) become one in the near-dedup stage, where rows with one ``doc_id`` and other texts are told apart; null texts are rejected by the first stage; empty tables give
empty results; further columns pass through.  No part of the result can be told in SQL (the packing is by
a tokenizer), so ``ORACLE_SQL`` is None and the tests compare the stages with brute force.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netscope.llm import minhash_links, packing, quality_rules, recompression, site_quality
from netscope.llm.common import table
from netscope.session import apply_runtime_conf, unique_subdir

ORACLE_SQL = None


def _whole(docs: DataFrame) -> DataFrame:
    """The documents as one column, so that no column of theirs clashes with a computed one."""
    return docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col("text"))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.apply_rules(_whole(docs)).filter("rejected_by is null").select("row.*")


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are probably neither of low quality nor toxic."""
    judged = site_quality.classify(docs, table(spark, sf_dir, "labels"))
    return judged.filter(site_quality.accepted(judged)).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest ``doc_id``, of each group of near copies (5-word shingles, similarity 0.8)."""
    known = docs.filter("doc_id is not null")
    if not known.groupBy("doc_id").count().filter("count > 1").isEmpty():
        docs = known.dropDuplicates(["doc_id", "text"]).unionByName(docs.filter("doc_id is null"))
    # a row is its key and its text: other texts of the same key stay
    copies = minhash_links.classes(docs, words=5).filter("not kept").select(
        F.col("doc_id").alias("_of"), F.col("same").alias("_same")).distinct()
    same = (F.col("doc_id") == F.col("_of")) & (F.xxhash64("text") == F.col("_same"))
    return docs.join(copies, same, "left_anti").select(*docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that also start earlier; those with nothing left go."""
    done = recompression.dedup(docs).filter("n_removed = 0 or n_removed < n_words")
    changed = F.col("n_removed") > 0
    new = {"text": F.col("kept"), "n_chars": F.when(changed, F.length("kept")).otherwise(F.col("row.n_chars"))
           if "n_chars" in docs.columns else None}
    return done.select(*[(new[c] if c in new else F.col(f"row.`{c}`")).cast(docs.schema[c].dataType).alias(c)
                         for c in docs.columns])


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences."""
    import public_tokenizers
    return packing.pack(docs, public_tokenizers.path(packing.VOCABULARY))


def _stage(function):
    """The stage under the session settings that all queries run with."""
    @functools.wraps(function)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return function(apply_runtime_conf(spark), docs, sf_dir)
    return stage


STAGES = [(name, _stage(f)) for name, f in (
    ("quality_rules", rules), ("quality_classifier", classifier), ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup), ("packing", sequences))]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each read from its predecessor's table."""
    at = unique_subdir(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{at}/{name}")
        docs = spark.read.parquet(f"{at}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
