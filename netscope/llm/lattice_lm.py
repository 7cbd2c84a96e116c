"""Language-model scoring by marginal subword-lattice likelihood.

A word's probability sums over all its segmentations into pieces of an existing subword vocabulary:
a log-space forward recursion over the lattice, weighted by the vocabulary's own scores and run for all
distinct words in batches.  A training word is one more edge of its lattice, with its discounted corpus
count (absolute discounting: the edge and the pieces share the probability mass).  A text is its words
and one end.

Distribution: word counts are partial aggregates.  Words that make up at least 1/``HEAVY`` of all
tokens are at most ``HEAVY`` many, whatever the corpus; their scores are broadcast.  All other words
travel in compressed messages to the part of the word table that holds them (parts are bounded in
distinct words, and dealt out to copies bounded in messages), and come back as sums per document.

Characters outside the vocabulary fall back to its byte pieces.  Null and blank texts hold just the
end.  Without training texts every token's base probability is 1 and the score rests on the pieces
alone.  Rows with a null key are not learned from; repeated rows are scored one by one; an empty
table gives an empty result.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netscope.llm.common import lower_words, table, text_groups
from netscope.session import cut_lineage

NAME = "op5_lattice_lm"
VOCABULARY = "piece_bpe_32k.model"
HEAVY = 100_000
PART_WORDS, PART_MESSAGES = 150_000, 2_000_000
CELLS = 200_000
START = "▁"


class Pieces:
    """The vocabulary's pieces in a hash table that whole arrays of substrings are looked up in."""

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        self.bytes = {int(model.id_to_piece(i)[1:-1], 16): i for i in ids if model.is_byte(i)}
        usable = [i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        usable = [i for i in usable if START not in model.id_to_piece(i)[1:]]
        self.size = len(ids)
        rank = np.array([-model.get_score(i) for i in ids])
        self.prior = np.full(self.size, -np.inf)
        known = usable + list(self.bytes.values())
        self.prior[known] = -np.log(rank[known] - rank[known].min() + 20.0)
        self.prior -= np.logaddexp.reduce(self.prior)
        text = [model.id_to_piece(i) for i in usable]
        self.longest = max(map(len, text))
        keys = np.array([self._hash(t) for t in text], np.uint64)
        self.tables = []
        ids_left, left, bits = np.array(usable, np.int32), keys, 20
        while len(left):  # what shares a slot goes to the next, smaller table
            slot = (left * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)
            _, first = np.unique(slot, return_index=True)
            at, key = np.full(1 << bits, -1, np.int32), np.zeros(1 << bits, np.uint64)
            at[slot[first]], key[slot[first]] = ids_left[first], left[first]
            self.tables.append((bits, key, at))
            rest = np.setdiff1d(np.arange(len(left)), first)
            ids_left, left = ids_left[rest], left[rest]
            bits = 16

    @staticmethod
    def _hash(text: str) -> int:
        h = 0
        for ch in text:
            h = ((h * 0x100000001B3 + ord(ch)) ^ 0x5851F42D4C957F2D) % 2 ** 64
        return h

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Piece id of each substring hash, -1 if it is none."""
        out = np.full(hashes.shape, -1, np.int32)
        for bits, key, at in self.tables:
            slot = (hashes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)
            out = np.where(key[slot] == hashes, np.maximum(at[slot], out), out)
        return out


@functools.cache
def pieces(path: str) -> Pieces:
    return Pieces(path)


class Lattice:
    """All segmentations of words of similar length: ``ids[l - 1][:, i]`` is the piece at i of length l."""

    def __init__(self, words: list[str], vocabulary: Pieces, logp: np.ndarray):
        self.logp = np.append(logp, -np.inf)  # index -1: no piece
        self.len = np.array([len(w) for w in words])
        width = int(self.len.max())
        flat = np.frombuffer("".join(w.ljust(width, "\0") for w in words).encode("utf-32-le", "surrogatepass"),
                             np.uint32).reshape(len(words), width)
        self.points, self.ids = flat, []
        with np.errstate(over="ignore"):
            h = np.zeros(flat.shape, np.uint64)
            for n in range(1, min(width, vocabulary.longest) + 1):
                h = (h[:, :width - n + 1] * np.uint64(0x100000001B3) + flat[:, n - 1:]) ^ np.uint64(0x5851F42D4C957F2D)
                self.ids.append(np.where(flat[:, n - 1:] > 0, vocabulary.lookup(h), -1))
        # characters that no piece covers are spelled in bytes
        self.spelled = np.full(flat.shape, -np.inf)
        odd = (self.ids[0] < 0) & ((flat > 0) | (np.arange(width) < self.len[:, None]))
        self.odd = odd
        for c in np.unique(flat[odd]).tolist():
            cost = sum(logp[vocabulary.bytes[b]] for b in chr(c).encode("utf-8", "surrogatepass"))
            self.spelled[odd & (flat == c)] = cost
        self.width = width

    def _edge(self, n: int, i: int) -> np.ndarray:
        own = self.logp[self.ids[n - 1][:, i]]
        return np.logaddexp(own, self.spelled[:, i]) if n == 1 else own

    def forward(self) -> np.ndarray:
        """Log weights of all ways to reach each position (position x word)."""
        alpha = np.full((self.width + 1, len(self.len)), -np.inf)
        alpha[0] = 0.0
        for j in range(1, self.width + 1):
            ways = np.stack([alpha[j - n] + self._edge(n, j - n) for n in range(1, min(j, len(self.ids)) + 1)])
            alpha[j] = _logsum(ways)
        self.alpha = alpha
        self.total = alpha[self.len, np.arange(len(self.len))]
        return self.total

    def expected(self, counts: np.ndarray, vocabulary: Pieces) -> np.ndarray:
        """Expected uses of each piece, words weighted by ``counts``."""
        self.forward()
        beta = np.full(self.alpha.shape, -np.inf)
        out = np.zeros(vocabulary.size + 1)
        for i in range(self.width, -1, -1):
            if i < self.width:
                ways = np.stack([self._edge(n, i) + beta[i + n]
                                 for n in range(1, min(self.width - i, len(self.ids)) + 1)])
                beta[i] = _logsum(ways)
            beta[i, self.len == i] = 0.0
        for n in range(1, len(self.ids) + 1):
            for i in range(self.width - n + 1):
                use = np.exp(self.alpha[i] + self._edge(n, i) + beta[i + n] - self.total) * counts
                if n == 1 and self.odd[:, i].any():
                    for c, u in zip(self.points[self.odd[:, i], i].tolist(), use[self.odd[:, i]].tolist()):
                        for b in chr(c).encode("utf-8", "surrogatepass"):
                            out[vocabulary.bytes[b]] += u
                    use = np.where(self.odd[:, i], 0.0, use)
                out += np.bincount(self.ids[n - 1][:, i] % (vocabulary.size + 1), use, vocabulary.size + 1)
        return out[:-1]


def _logsum(ways: np.ndarray) -> np.ndarray:
    top = ways.max(0)
    safe = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return np.log(np.exp(ways - safe).sum(0)) + safe


def lattices(words: list[bytes], vocabulary: Pieces, logp: np.ndarray) -> Iterator[tuple[np.ndarray, Lattice]]:
    """Lattices of words of similar length, with the places of their words."""
    texts = [START + w.decode("utf-8", "replace") for w in words]
    size = np.array([len(t) for t in texts])
    order = np.argsort(size, kind="stable")
    at = 0
    while at < len(order):
        n = size[order[at]]
        end = at + max(1, min(int(np.searchsorted(size[order], n + max(1, n // 8), "right")) - at, CELLS // int(n)))
        yield order[at:end], Lattice([texts[i] for i in order[at:end]], vocabulary, logp)
        at = end


def log_marginals(words: list[bytes], path: str, logp: np.ndarray) -> np.ndarray:
    """Natural log of each word's marginal weight."""
    out = np.empty(len(words))
    for at, lattice in lattices(words, pieces(path), logp):
        out[at] = lattice.forward()
    return out


def word_counts(docs: DataFrame, train: Column, key: str, text: str) -> DataFrame:
    """``word, c, a``: a word's count in training texts and in all texts; each batch sends a word once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, learn = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi in text_groups(texts, 6_000_000):
                c, a = Counter(), Counter()
                for t, x in zip(texts[lo:hi], learn[lo:hi]):
                    (c if x else a).update(lower_words(t))
                words = list(c.keys() | a.keys())
                first = [c[w] for w in words]
                for i in range(0, len(words), 50_000):
                    part = words[i:i + 50_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(part, pa.binary()), pa.array(first[i:i + 50_000], pa.int64()),
                         pa.array([x + a[w] for w, x in zip(part, first[i:i + 50_000])], pa.int64())],
                        names=["word", "c", "a"])

    rows = docs.select(F.col(text).alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    return rows.mapInArrow(run, "word binary, c bigint, a bigint").groupBy("word").agg(
        F.sum("c").alias("c"), F.sum("a").alias("a"))


class Totals:
    """Corpus totals behind the base and the model."""

    def __init__(self, counts: DataFrame, train_docs: int):
        row = counts.agg(F.sum("c"), F.count_if(F.col("c") > 0), F.count_if(F.col("c") == 1),
                         F.count_if(F.col("c") == 2),
                         F.sum("a"), F.count("*")).first()
        words, self.v_words, ones, twos, all_words, self.distinct = (int(x or 0) for x in row)
        self.n_words, self.n_docs, self.all_words = words, train_docs, all_words
        self.n = words + train_docs
        self.v = self.v_words + (train_docs > 0)
        self.discount = ones / (ones + 2 * twos) if ones else 0.5
        self.end = (train_docs + 0.5) / (self.n + 1.0)

    def base(self, c):
        return np.log10((c + 0.1) / (self.n + 0.1 * (self.v + 1)))

    def word(self, c: np.ndarray, log_marginal: np.ndarray) -> np.ndarray:
        """log10 probability of a word from its count and its lattice."""
        n = max(self.n_words, 1)
        spare = self.discount * self.v_words / n if self.n_words else 1.0
        with np.errstate(divide="ignore"):
            edge = np.log(np.maximum(c - self.discount, 0.0) / n)
        return (np.logaddexp(edge, math.log(spare) + log_marginal) + math.log1p(-self.end)) / math.log(10)


def word_scores(counts: DataFrame, totals: Totals, path: str, logp: np.ndarray, parts: int = 1) -> DataFrame:
    """``word, known, base, score, part`` of every row of ``counts``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, c = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(c > 0), pa.array(totals.base(c)),
                 pa.array(totals.word(c.astype(float), log_marginals(words, path, logp))),
                 pa.array([part_of(w, parts) for w in words], pa.int32())],
                names=["word", "known", "base", "score", "part"])
    return counts.select("word", "c").mapInArrow(
        run, "word binary, known boolean, base double, score double, part int")


def part_of(word: bytes, parts: int) -> int:
    """Part of the word table that holds the word."""
    return xxhash.xxh3_64_intdigest(word) % parts


MESSAGE = ("key {kind}, row bigint, n bigint, known bigint, base double, score double, "
           "part int, copy int, block bigint, rows array<bigint>, words binary")


def _split(docs: DataFrame, key: str, text: str, heavy: dict, parts: int, copies: int, kind: str) -> DataFrame:
    """Per text the sums over its frequent words; per batch and part a message with its other words."""
    shared = docs.sparkSession.sparkContext.broadcast(heavy)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_, pack = shared.value, zstandard.ZstdCompressor(level=1)
        get = table_.get
        row = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33
        schema = None
        for batch in batches:
            if schema is None:
                schema = pa.schema([("key", batch.schema.field(0).type), ("row", pa.int64()), ("n", pa.int64()),
                                    ("known", pa.int64()), ("base", pa.float64()), ("score", pa.float64()),
                                    ("part", pa.int32()), ("copy", pa.int32()), ("block", pa.int64()), ("rows", pa.list_(pa.int64())),
                                    ("words", pa.binary())])
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi in text_groups(texts, 4_000_000):
                out, block = [], row
                sent = [([], []) for _ in range(parts)]
                for k, t in zip(keys[lo:hi], texts[lo:hi]):
                    words = lower_words(t)
                    found = [get(w) for w in words]
                    hits = [x for x in found if x is not None]
                    known = sum([x[0] for x in hits])
                    out.append((k, row, len(words) + 1, known, math.fsum([x[1] for x in hits]),
                                math.fsum([x[2] for x in hits]), None, None, None, None, None))
                    if len(hits) < len(words):
                        mine = {}
                        for w, x in zip(words, found):
                            if x is None:
                                mine.setdefault(part_of(w, parts), []).append(w)
                        for p, ws in mine.items():
                            sent[p][0].append(row)
                            sent[p][1].append(b" ".join(ws))
                    row += 1
                for p, (rows, lines) in enumerate(sent):
                    if rows:
                        copy = (row + p) % copies
                        out.append((None, None, None, None, None, None, p, copy, block, rows, pack.compress(b"\n".join(lines))))
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x)) for x in out], schema=schema)

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        run, MESSAGE.format(kind=kind))


ANSWER = "block bigint, rows array<bigint>, known array<bigint>, base array<double>, score array<double>"


def _answer(messages: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
    """One part of the word table answers its messages, each with sums per text."""
    value = dict(zip(words["word"], zip(words["known"].astype(int), words["base"], words["score"])))
    unpack, out = zstandard.ZstdDecompressor(), []
    for block, rows, data in zip(messages["block"], messages["rows"], messages["words"]):
        sums = []
        for line in unpack.decompress(data).split(b"\n"):
            known, base, score = zip(*[value[w] for w in line.split(b" ")])
            sums.append((sum(known), math.fsum(base), math.fsum(score)))
        out.append((block, list(rows), *map(list, zip(*sums))))
    return pd.DataFrame(out, columns=["block", "rows", "known", "base", "score"])


def _block_sums(answers: pd.DataFrame) -> pd.DataFrame:
    """Sums per text over the answers to one batch's messages."""
    flat = pd.DataFrame({c: np.concatenate(answers[c].to_numpy()) for c in ("rows", "known", "base", "score")})
    return flat.groupby("rows", as_index=False).sum().rename(columns={"rows": "row"})


def score_texts(docs: DataFrame, train: Column, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_tokens, n_known, train_tokens, base_score, score`` of every row."""
    kind = docs.schema[key].dataType.simpleString()
    counts = cut_lineage(word_counts(docs, train, key, text))
    totals = Totals(counts, docs.filter(train).count())
    logp = pieces(path).prior
    least = max(1, -(-totals.all_words // HEAVY))
    top = word_scores(counts.filter(F.col("a") >= least), totals, path, logp).toPandas()  # at most HEAVY rows
    heavy = dict(zip(top["word"].map(bytes), zip(top["known"].astype(int).tolist(), top["base"].tolist(),
                                                 top["score"].tolist())))
    parts = max(1, -(-(totals.distinct - len(heavy)) // PART_WORDS))
    copies = max(1, -(-totals.all_words // (parts * PART_MESSAGES)))
    sent = cut_lineage(_split(docs, key, text, heavy, parts, copies, kind))

    rest = word_scores(counts.filter(F.col("a") < least), totals, path, logp, parts)
    if copies > 1:
        rest = cut_lineage(rest).withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    else:
        rest = rest.withColumn("copy", F.lit(0))
    answers = sent.filter("row is null").select("part", "copy", "block", "rows", "words").groupBy("part", "copy").cogroup(
        rest.groupBy("part", "copy")).applyInPandas(_answer, ANSWER)
    # a row per message, so that the rows do not multiply with the parts; then a row per text
    answers = answers.groupBy("block").applyInPandas(_block_sums, "row bigint, known bigint, base double, score double")
    sums = sent.filter("row is not null").select("key", "row", "n", "known", "base", "score").unionByName(
        answers.select(F.lit(None).cast(kind).alias("key"), "row", F.lit(0).cast("bigint").alias("n"), "known",
                       "base", "score"))
    end_base, end = float(totals.base(np.array(totals.n_docs))), math.log10(totals.end)
    return sums.groupBy("row").agg(F.max("key").alias(key), F.sum("n").alias("n_tokens"),
                                   F.sum("known").alias("known"), F.sum("base").alias("base"),
                                   F.sum("score").alias("s")).select(
        key, "n_tokens", (F.col("known") + int(totals.n_docs > 0)).alias("n_known"),
        F.lit(totals.n).cast("long").alias("train_tokens"), (F.col("base") + end_base).alias("base_score"),
        (F.col("s") + end).alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from nine tenths of the documents, scores all of them."""
    import public_tokenizers
    held = F.crc32(F.col("doc_id").cast("string")) % 10 == 0
    out = score_texts(table(spark, sf_dir, "documents"), ~held, public_tokenizers.path(VOCABULARY))
    return out.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "n_tokens", "n_known",
                      "train_tokens", "base_score", "score")
