"""Language identification with error-correcting output codes.

Every learned language gets a codeword; one binary classifier per bit tells the languages with a one
there from those with a zero (naive Bayes over hashed character n-grams, every language counting
alike).  A text's bits are decoded to the codeword of least loss, each bit's loss weighted by how well
its classifier did on training texts set aside; a small lead over the runner-up is flagged.

Learning reads a bounded sample: at most ``max_docs`` texts of the learning part, chosen by a hash of
the key (a documented parameter).  Only the n-gram counts of the sample reach the driver (languages x
``2 ** HASH_BITS`` numbers at most).  Prediction runs over all whole texts, row by row.

Null texts and texts without a letter are ``und`` with score 0; with no language to learn from, every
text is.  Rows with a null key are predicted and not learned from; empty tables give empty results.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netscope.llm.common import table, text_groups
from netscope.session import cut_lineage

NAME = "op4_language_id"
HASH_BITS = 16
MAX_DOCS = 20_000
AMBIGUOUS = 0.9


@functools.cache
def _letters() -> np.ndarray:
    return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)])


def ngrams(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed 2- and 3-grams of all texts one after another, where each text's grams start (one more
    place: the end), and whether a text has a letter.

    Texts are in lower case, all but letters are white space, white space is single.
    """
    joined = "".join([f"\0 {(t or '').lower()} " for t in texts])
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len((t or "").lower()) + 3 for t in texts], np.int64)
    mark = np.zeros(len(points), bool)
    mark[np.cumsum(sizes) - sizes] = True
    letter = _letters()[points]
    points = np.where(letter, points, np.uint32(32))
    points[mark] = 0
    keep = np.ones(len(points), bool)
    keep[1:] = (points[1:] != 32) | (points[:-1] != 32)
    points, mark = points[keep], mark[keep]
    starts = np.flatnonzero(mark)
    a, b = points[:-1], points[1:]
    two = (a * np.uint32(0x9E3779B1)) ^ (b * np.uint32(0x85EBCA77))
    three = two[:-1] * np.uint32(0xC2B2AE3D) + points[2:] * np.uint32(0x27D4EB2F)
    grams = np.empty(2 * len(points), np.uint32)   # a place for each start of a 2- and a 3-gram
    grams[0:2 * len(two):2] = two * np.uint32(0x165667B1)
    grams[1:2 * len(three):2] = three
    valid = np.zeros(2 * len(points), bool)
    inside = ~mark
    valid[0:2 * len(two):2] = inside[:-1] & inside[1:]
    valid[1:2 * len(three):2] = inside[:-2] & inside[1:-1] & inside[2:]
    before = np.concatenate([[0], np.cumsum(valid)])
    offsets = before[2 * np.append(starts, len(points))]
    has = np.add.reduceat((points > 32).astype(np.int64), starts) > 0 if len(starts) else np.zeros(0, bool)
    return (grams[valid] >> np.uint32(32 - HASH_BITS)).astype(np.int32), offsets, has


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """A +1/-1 codeword for each of ``n`` languages: all distinct splits up to seven languages, random
    distinct splits beyond."""
    if n == 0:
        return np.zeros((0, 0), np.int8)
    if n <= 7:
        columns = [[1 if (v >> i) & 1 else -1 for i in range(n)] for v in range(1, 2 ** max(n - 1, 0))]
    else:
        rng, want, seen = np.random.default_rng(seed), 15 * int(np.ceil(np.log2(n))), set()
        while len(seen) < want:
            c = rng.choice([-1, 1], n)
            if abs(c.sum()) < n:
                seen.add(tuple((c * c[0]).tolist()))
        columns = sorted(seen)
    return np.array(columns, np.int8).reshape(-1, n).T


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray      # languages x bits
    weights: np.ndarray    # bits x n-grams
    bit_weight: np.ndarray

    def margins(self, grams: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Texts x bits: mean log ratio of a text's n-grams, scaled up with the square root of their number."""
        n = np.diff(offsets)
        out = np.zeros((len(n), len(self.weights)))
        full = n > 0
        for b, w in enumerate(self.weights):
            if full.any():
                out[full, b] = np.add.reduceat(w[grams], offsets[:-1][full], dtype=np.float64)
        return out / np.sqrt(np.maximum(n, 1))[:, None]

    def losses(self, margins: np.ndarray) -> np.ndarray:
        """Texts x languages: weighted logistic loss of each codeword."""
        out = np.zeros((len(margins), len(self.languages)))
        for k, code in enumerate(self.codes):
            out[:, k] = (np.logaddexp(0, -margins * code) * self.bit_weight).sum(1)
        return out

    def predict(self, texts: Sequence[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and ambiguity of each text."""
        grams, offsets, has = ngrams(texts)
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        loss = self.losses(self.margins(grams, offsets))
        p = np.exp(loss.min(1, keepdims=True) - loss)
        p /= p.sum(1, keepdims=True)
        best = loss.argmin(1)
        score = np.where(has, p[np.arange(len(p)), best], 0.0)
        names = [self.languages[i] if h else "und" for i, h in zip(best.tolist(), has.tolist())]
        return names, score, score < AMBIGUOUS


def crc_part(key: Column, parts: int) -> Column:
    return F.crc32(key.cast("string")) % parts


def sample(docs: DataFrame, keep: Column, key: str, text: str, lang: str, max_docs: int) -> DataFrame:
    """About ``max_docs`` learning rows by a hash of the key, materialised; ``fold`` is 0 to 4.

    Every language gets the same number of rows; what a rare one doesn't use goes to the others, so that none is
    lost however rare it is."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang")).filter(
        keep & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}   # the model has a row for each
    level, left = 0.0, float(max_docs)
    for done, n in enumerate(sorted(counts.values())):
        level = left / (len(counts) - done)
        if n > level:
            break
        level, left = float(n), left - n
    hashed = F.shiftright(F.xxhash64(F.col("key"), F.lit(31)), 1)
    bounds = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, level / n) * 2.0 ** 62)])
    kept = rows.filter(F.abs(hashed) <= F.try_element_at(bounds, F.col("lang"))) if counts else rows
    rare = [lang for lang, n in counts.items() if n < 10]   # too few to spare any for the weights of bits
    fold = F.when(F.col("lang").isin(rare), F.lit(1)).otherwise(F.pmod(hashed, F.lit(5)))
    return cut_lineage(kept.withColumn("fold", fold))


def fit(rows: DataFrame) -> Model:
    """Model from the rows of ``sample``: counts from folds 1 to 4, bit weights from fold 0."""
    dim = 1 << HASH_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(1).to_pylist()
            for lang in sorted(set(names)):
                mine = [t for t, x in zip(batch.column(0).to_pylist(), names) if x == lang]
                total = np.zeros(dim, np.int64)
                for a, b in text_groups(mine):
                    total += np.bincount(ngrams(mine[a:b])[0], minlength=dim)
                at = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(total[at])],
                    names=["lang", "gram", "n"])

    counted = rows.filter("fold > 0").select("text", "lang").mapInArrow(
        count, "lang string, gram int, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(counted["lang"].unique())
    freq = np.zeros((len(languages), dim))
    for k, lang in enumerate(languages):
        mine = counted[counted["lang"] == lang]
        freq[k, mine["gram"].to_numpy()] = mine["n"].to_numpy()
    freq = (freq + 0.1) / (freq.sum(1, keepdims=True) + 0.1 * dim)
    codes = codewords(len(languages))
    weights = np.array([np.log(freq[c > 0].mean(0)) - np.log(freq[c < 0].mean(0)) for c in codes.T],
                       np.float32).reshape(-1, dim)
    model = Model(languages, codes, weights, np.ones(len(weights)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = {x: k for k, x in enumerate(languages)}
        for batch in batches:
            rows_ = [(t, index[x]) for t, x in zip(*(c.to_pylist() for c in batch.columns)) if x in index]
            for a, b in text_groups([t for t, _ in rows_]):
                grams, offsets, _ = ngrams([t for t, _ in rows_[a:b]])
                wrong = model.margins(grams, offsets) * codes[[k for _, k in rows_[a:b]]] <= 0
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(len(weights), dtype=np.int32)), pa.array(wrong.sum(0).astype(np.int64)),
                    pa.array(np.full(len(weights), b - a, np.int64))], names=["bit", "wrong", "n"])

    if len(weights):
        for bit, wrong, n in rows.filter("fold = 0").select("text", "lang").mapInArrow(
                score, "bit int, wrong bigint, n bigint").groupBy("bit").agg(
                    F.sum("wrong"), F.sum("n")).collect():
            rate = (wrong + 0.5) / (n + 1.0)
            model.bit_weight[bit] = max(0.0, np.log((1 - rate) / rate))
        model.bit_weight /= max(model.bit_weight.max(), 1e-9)
    return model


def identify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``lang_pred``, ``score`` and ``ambiguous`` of every row."""
    kind = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in text_groups(texts):
                names, score, unsure = shared.value.predict(texts[a:b])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(names), pa.array(score), pa.array(unsure)],
                    names=["key", "lang_pred", "score", "ambiguous"])

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        run, f"key {kind}, lang_pred string, score double, ambiguous boolean").withColumnRenamed("key", key)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from two thirds of the documents (a bounded sample of them), predicts all."""
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(crc_part(F.col("doc_id"), 3) == 1, F.lit(False))
    learn = crc_part(F.col("key"), 3) != 1
    model = fit(sample(docs, learn, "doc_id", "text", "lang", MAX_DOCS))
    return identify(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score", "ambiguous")
