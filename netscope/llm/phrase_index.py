"""Phrase collocations from FM-indexes over word ids, one per shard of the corpus.

1. Each task turns its texts into shards of at most some ``SHARD_TOKENS`` word ids, with 0 between pieces.  Spark
   sums the words' counts and gives every shard back those of its words that are frequent in the corpus; no other
   word can stand in a candidate, so all others become breaks.
2. Each shard extends its words to the right and sends its word pairs with their counts; Spark sums them and
   gives every shard back those of its pairs that are frequent in the corpus.
3. Each shard keeps the stretches whose neighbouring words are all frequent pairs and counts its phrases of three
   words in buckets by their hash; Spark sums the buckets.  Each shard then sends its phrases of three words that lie
   in a full bucket; Spark sums them and gives every shard back its frequent ones.  (Pairs that only just become
   frequent in a larger corpus bring many phrases of three words that don't: most of them stay in their shard.)
4. Each shard keeps the stretches whose three neighbouring words are all frequent, builds a bidirectional index
   (depth-limited suffix order and last-to-first mapping of the text and of its reverse) and enumerates all
   phrases up to ``MAX_WORDS`` words, extending intervals on either side in turn.  Spark sums the counts.

A phrase that is frequent has only frequent parts, so nothing that counts is ever left out, and the counts are
exact.  A hot word or pair costs one row per shard, however often it stands there.  The rest is joins and aggregates over the frequent phrases,
of which there are at most (phrases of the corpus) / ``min_count``: cuts, the drop of phrases that a longer one
accounts for (it is enough to look at those one word longer, because counts fall with length) and the ranks.

Null and empty texts have no words; null languages count as ``und``; repeated rows count as often as they stand;
a piece without end is one piece however long; ties are broken as ``mine`` states; an empty table gives an empty
result; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, GroupedData, SparkSession, Window
from pyspark.sql import functions as F

from netscope.llm.common import table
from netscope.session import cut_lineage, unique_subdir

NAME = "op11_phrase_index"
MAX_WORDS, MIN_COUNT, TOP = 5, 100, 2000
UNKNOWN = "und"
SHARD_TOKENS = 1 << 22
SEGMENT_BYTES = 1 << 22
BLOCK_ROWS = 1 << 20
# rows of one Arrow batch on its way from a shard to Spark, which holds a batch outside its heap
SENT_ROWS = 100_000
# phrases of three words are counted in buckets first, some 2 to 4 words of the corpus for each until they are MOST_BUCKETS
MOST_BUCKETS, CHUNKS = 1 << 28, 1 << 10
# a word's number in the corpus: that of its first shard (task and place in it), then its id there
SHARD_BITS, ID_BITS = 12, 26

# Capital letters become small ones, these characters end a piece, a tab separates words like a blank.
_FROM = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + b"\t" + b".,;:!?\x0b\x0c\r"
_TO = b"abcdefghijklmnopqrstuvwxyz" + b" " + b"\n" * 9
_TABLE = bytes.maketrans(_FROM, _TO)


def segments(text: str | None, size: int = SEGMENT_BYTES) -> Iterator[list[bytes]]:
    """Words of ``text`` with ``b"\\n"`` between pieces (and empty items), some ``size`` bytes at a time."""
    body, at = (text or "").encode().translate(_TABLE), 0
    while at < len(body):
        end = body.find(b"\n", at + size)
        end = len(body) if end < 0 else end
        yield body[at:end].replace(b"\n", b" \n ").split(b" ")
        at = end + 1


class _Ids(dict):
    """Numbers for the words of one language, from a counter that all languages of a shard share."""

    def __init__(self, counter: list[int]):
        super().__init__({b"": -1, b"\n": 0})
        self.counter = counter

    def __missing__(self, word: bytes) -> int:
        self.counter[0] += 1
        self[word] = self.counter[0]
        return self.counter[0]


def pack(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(1).compress(a.tobytes())


def unpack(b: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), kind)


def single_breaks(ids: np.ndarray) -> np.ndarray:
    """``ids`` with each run of zeros made one, none at the start, one at the end."""
    ids = np.append(ids, ids.dtype.type(0))
    keep = ids != 0
    keep[1:] |= ids[:-1] != 0
    return ids[keep]


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``shard, body`` (word ids) and rows ``shard, lang, word, id, n`` (words of the shard)."""
    names = ["shard", "body", "lang", "word", "id", "n"]
    number = TaskContext.get().partitionId() << SHARD_BITS
    words: dict[str, _Ids] = {}
    counter, parts, size = [0], [], 0

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal number, size
        if counter[0] >> ID_BITS or number >> SHARD_BITS != TaskContext.get().partitionId():
            raise ValueError("too many words for a shard or shards for a task: split the input finer")
        ids = single_breaks(np.concatenate(parts))
        n = np.bincount(ids, minlength=counter[0] + 1)
        null = lambda kind, k=1: pa.nulls(k, kind)
        yield pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([pack(ids)], pa.binary()), null(pa.string()), null(pa.string()),
             null(pa.int32()), null(pa.int64())], names=names)
        for lang, own in words.items():
            w = [(k, i) for k, i in own.items() if i > 0]
            for at in range(0, len(w), 20_000):
                text, i = zip(*w[at:at + 20_000])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(i), number)), null(pa.binary(), len(i)), pa.array([lang] * len(i)),
                     pa.array(text, pa.binary()).cast(pa.string()), pa.array(i, pa.int32()), pa.array(n[list(i)])], names=names)
        number += 1
        size = counter[0] = 0
        words.clear(), parts.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            lang = lang.as_py()
            for tokens in segments(text.as_py()):
                if lang not in words:
                    words[lang] = _Ids(counter)
                ids = np.fromiter(map(words[lang].__getitem__, tokens), np.int32, len(tokens))
                parts.append(np.append(ids[ids >= 0], np.int32(0)))
                size += len(parts[-1])
                if size >= SHARD_TOKENS:
                    yield from flush()
    if size:
        yield from flush()


class Half:
    """One direction of the index over a cyclic text: rows in the order of their first ``depth`` symbols."""

    def __init__(self, text: np.ndarray, depth: int):
        # numbers of 4 bytes but for the keys, and no array kept longer than needed: this is a task's largest state
        rank, covered = np.ascontiguousarray(text, np.int32), 1
        order = np.argsort(rank, kind="stable")
        while covered < depth:
            del order
            key = rank.astype(np.int64)
            key <<= 32
            key |= np.roll(rank, -covered)
            del rank
            order = np.argsort(key, kind="stable")
            key = key[order]
            new = np.zeros(len(key), bool)
            np.not_equal(key[1:], key[:-1], out=new[1:])
            del key
            rank = np.empty(len(new), np.int32)
            rank[order] = np.cumsum(new, dtype=np.int32)
            covered *= 2
        del rank
        #: symbol before each row's suffix, and the row of the suffix that starts with it
        order -= 1
        self.before = text[order]
        del order
        by_symbol = np.argsort(self.before, kind="stable")
        self.to = np.empty(len(text), np.int32)
        self.to[by_symbol] = np.arange(len(text), dtype=np.int32)


class Index:
    """Bidirectional FM-index: a phrase is an interval of rows in the text's order and one in its reverse's."""

    def __init__(self, text: np.ndarray, depth: int):
        self.text, self.depth = text, depth

    @cached_property
    def forward(self) -> Half:
        return Half(self.text, self.depth)

    @cached_property
    def backward(self) -> Half:
        return Half(self.text[::-1], self.depth)

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``words, lo, lo_reversed, n`` of all phrases of one word."""
        n = np.bincount(self.text)
        start = np.cumsum(n) - n
        symbol = np.flatnonzero(n[1:]) + 1
        return symbol[:, None], start[symbol], start[symbol], n[symbol]

    def extend(self, phrases: tuple, right: bool) -> tuple:
        """The phrases that are one word longer on the given side, some ``BLOCK_ROWS`` rows of the index at a time."""
        n = phrases[3]
        block = (np.cumsum(n) - n) // BLOCK_ROWS
        cuts = np.flatnonzero(np.diff(block)) + 1
        parts = [self._extend(tuple(x[lo:hi] for x in phrases), right)
                 for lo, hi in zip([0, *cuts], [*cuts, len(n)])]
        return tuple(np.concatenate(x) for x in zip(*parts))

    def _extend(self, phrases: tuple, right: bool) -> tuple:
        """To the right, the rows of the reversed phrase show the words that follow; words in their order cut the
        phrase's own interval into those of the longer ones.  To the left it is the other way round."""
        words, lo, lo_reversed, n = phrases
        half, here, there = (self.backward, lo_reversed, lo) if right else (self.forward, lo, lo_reversed)
        first = np.cumsum(n) - n
        node = np.repeat(np.arange(len(n)), n)
        rows = np.repeat(here - first, n) + np.arange(len(node))
        symbol = half.before[rows]
        key = (node << 32) | symbol
        order = np.argsort(key, kind="stable")
        key = key[order]
        at = np.flatnonzero(np.diff(key, prepend=-1))
        count = np.diff(at, append=len(key))
        real = symbol[order[at]] > 0
        at, count = at[real], count[real]
        parent, begin = node[order[at]], order[at]
        new = symbol[begin][:, None]
        inner = half.to[rows[begin]].astype(np.int64)
        outer = there[parent] + at - first[parent]
        words = np.hstack([words[parent], new] if right else [new, words[parent]])
        return (words, outer, inner, count) if right else (words, inner, outer, count)


def phrases(text: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``words, n`` of all phrases of 1, 2, ... ``longest`` words in ``text`` (0: break)."""
    if not text.any():
        return
    index = Index(text, longest - 1)
    found = index.words()
    yield found[0], found[3]
    for length in range(2, longest + 1):
        found = index.extend(found, right=length != 4)
        yield found[0], found[3]


def recode(body: bytes, ids: np.ndarray, wids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A shard's text over its frequent words, numbered from 1 in the order of their corpus numbers; those."""
    text = unpack(body, np.int32)
    order = np.argsort(wids)
    code = np.zeros(int(text.max(initial=0)) + 1, np.int32)
    code[ids[order]] = np.arange(1, len(order) + 1)
    return single_breaks(code[text]), wids[order]


def _sent(rows: pa.Table) -> pa.Table:
    """The same rows, ``SENT_ROWS`` to a batch."""
    return pa.Table.from_batches(rows.to_batches(max_chunksize=SENT_ROWS), rows.schema)


def _pairs(texts: pa.Table, words: pa.Table) -> pa.Table:
    """``shard, w1, w2, n``: the pairs of frequent words in a shard."""
    cols = [np.zeros(0, np.int64)] * 4
    if len(texts) and len(words):
        text, names = recode(texts["body"][0].as_py(), words["a"].to_numpy(), words["b"].to_numpy())
        for pair, n in phrases(text, 2):
            if pair.shape[1] == 2:
                cols = [np.full(len(n), texts["shard"][0].as_py()), names[pair[:, 0] - 1], names[pair[:, 1] - 1], n]
    return _sent(pa.table([pa.array(c, pa.int64()) for c in cols], names=["shard", "w1", "w2", "n"]))


def stretches(text: np.ndarray, *parts: np.ndarray) -> np.ndarray:
    """``text`` without what lies in no two neighbouring given phrases; breaks where no such two go on.

    ``parts`` are the first, second, ... words of the given phrases."""
    width = int(text.max(initial=0)) + 1
    here, given, ok = text.astype(np.int64), parts[0].astype(np.int64), np.ones(len(text), bool)
    for part, words in zip([*parts[1:], None], [text[i:] for i in range(1, len(parts) + 1)]):
        # phrases so far by number, so that one and the next word fit into 64 bits
        names, given = np.unique(given, return_inverse=True)
        found = np.minimum(np.searchsorted(names, here), len(names) - 1)
        ok &= names[found] == here                    # the phrase that starts here
        if part is not None:
            here, given, ok = found[:-1] * width + words, given * width + part, ok[:-1]
    two = ok[:-1] & ok[1:]
    keep, on = np.zeros(len(text), bool), np.zeros(len(text), bool)
    for k in range(len(parts) + 1):
        keep[k:k + len(two)] |= two
        if k < len(parts):
            on[k:k + len(two)] |= two                 # the next word belongs to it
    out = np.zeros((len(text), 2), text.dtype)       # each word, and the break that may follow
    out[:, 0] = text
    out[:, 1] = np.where(on, -1, 0)
    return single_breaks(out[keep].ravel()[out[keep].ravel() >= 0])


def _longer(texts: pa.Table, given: pa.Table, lengths: range) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``words, n`` (corpus numbers) of a shard's phrases of these lengths in the stretches of its given phrases.

    ``given`` holds the shard's frequent words (id, number) and phrases (numbers), told apart by ``phrase``.
    """
    known = given.filter(given["phrase"])
    if not len(texts) or not len(known):
        return
    words = given.filter(pa.compute.invert(given["phrase"]))
    text, names = recode(texts["body"][0].as_py(), words["a"].to_numpy(), words["b"].to_numpy())
    parts = [np.searchsorted(names, known[c].to_numpy()) + 1 for c in ("a", "b", "c")[:lengths[0] - 1]]
    for found, n in phrases(stretches(text, *parts), lengths[-1]):
        if found.shape[1] in lengths:
            yield names[found - 1], n


def _bucket(found: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each phrase of three words, by its corpus numbers."""
    h = np.zeros(len(found), np.uint64)
    for word in found.T.astype(np.uint64):
        h = (h ^ word) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h % np.uint64(buckets)).astype(np.int64)


def _bucket_counts(texts: pa.Table, given: pa.Table, buckets: int, min_count: int) -> pa.Table:
    """``chunk, at, n``: how often a shard's phrases of three words fall into each bucket, none above ``min_count``."""
    chunk, at, counts = [], [], []
    for found, n in _longer(texts, given, range(3, 4)):
        bucket, group = np.unique(_bucket(found, buckets), return_inverse=True)
        total = np.minimum(np.bincount(group, n), min_count).astype(np.int32)
        part = bucket // (buckets // CHUNKS)
        cuts = np.flatnonzero(np.diff(part, prepend=-1))
        chunk = part[cuts]
        inside = (bucket % (buckets // CHUNKS)).astype(np.int32)
        at = [pack(x) for x in np.split(inside, cuts[1:])] if len(cuts) else []
        counts = [pack(x) for x in np.split(total, cuts[1:])] if len(cuts) else []
    return pa.table([pa.array(chunk, pa.int32()), pa.array(at, pa.binary()), pa.array(counts, pa.binary())],
                    names=["chunk", "at", "n"])


def full_buckets(counts: DataFrame, buckets: int, min_count: int) -> np.ndarray:
    """The buckets with ``min_count`` in all shards together, as bits (``MOST_BUCKETS / 8`` bytes at most)."""
    size = buckets // CHUNKS

    def add(chunk: pa.Table) -> pa.Table:
        total = np.zeros(size, np.int64)
        for at, n in zip(chunk["at"], chunk["n"]):
            total[unpack(at.as_py(), np.int32)] += unpack(n.as_py(), np.int32)
        return pa.table([chunk["chunk"].slice(0, 1), pa.array([pack(np.packbits(total >= min_count))], pa.binary())],
                        names=["chunk", "bits"])

    out = np.zeros((CHUNKS, size // 8), np.uint8)
    for chunk, bits in counts.groupBy("chunk").applyInArrow(add, "chunk int, bits binary").toPandas().itertuples(index=False):
        out[chunk] = unpack(bits, np.uint8)
    return out.ravel()


def _threes(texts: pa.Table, given: pa.Table, full: np.ndarray | None = None) -> pa.Table:
    """``shard, w1, w2, w3, n`` of a shard's phrases of three words whose pairs are both frequent.

    With ``full``, those in a full bucket only: all others are infrequent."""
    cols = [np.zeros(0, np.int64)] * 5
    for found, n in _longer(texts, given, range(3, 4)):
        if full is not None:
            at = _bucket(found, 8 * len(full))
            keep = (full[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0
            found, n = found[keep], n[keep]
        cols = [np.full(len(n), texts["shard"][0].as_py()), *found.T, n]
    return _sent(pa.table([pa.array(c, pa.int64()) for c in cols], names=["shard", "w1", "w2", "w3", "n"]))


def _long(texts: pa.Table, given: pa.Table) -> pa.Table:
    """``w1 ... w5, n`` of a shard's phrases of four words and more whose phrases of three are all frequent."""
    cols = [[] for _ in range(MAX_WORDS + 1)]
    for found, n in _longer(texts, given, range(4, MAX_WORDS + 1)):
        k = found.shape[1]
        for i, c in enumerate(cols[:-1]):
            c.append(pa.array(found[:, i]) if i < k else pa.nulls(len(n), pa.int64()))
        cols[-1].append(pa.array(n.astype(np.int64)))
    return _sent(pa.table([pa.chunked_array(c, pa.int64()).combine_chunks() for c in cols],
                          names=[f"w{i + 1}" for i in range(MAX_WORDS)] + ["n"]))


def frequent(docs: DataFrame, text: str = "text", lang: str = "lang",
             min_count: int = MIN_COUNT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``lang, n`` (words of a language); ``wid, lang, word, f``; and ``p, f``: frequent phrases, as arrays of wid.

    All three are read from tables in the shared folder.
    """
    spark = docs.sparkSession
    at = unique_subdir(spark, "phrases")

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{at}/{name}")
        return spark.read.parquet(f"{at}/{name}")

    own = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text"))
    shards = written(own.filter("text is not null").mapInArrow(
        _shards, "shard bigint, body binary, lang string, word string, id int, n bigint"), "shards")
    texts = shards.filter("body is not null").select("shard", "body")
    local = shards.filter("word is not null").select("shard", "lang", "word", "id", "n")
    totals = written(local.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    # a shard sends a word or a pair once, so a window holds at most one row per shard
    same = Window.partitionBy("lang", "word")
    place = F.shiftleft("shard", ID_BITS).bitwiseOR(F.col("id").cast("long"))
    held = written(local.select("shard", "id", "lang", "word", place.alias("place"), F.sum("n").over(same).alias("f"),
                                F.min(place).over(same).alias("wid")).filter(F.col("f") >= min_count), "held")
    words = held.filter("place = wid").select("wid", "lang", "word", "f")
    ids = held.select(F.col("shard").alias("of"), F.col("id").cast("long").alias("a"), F.col("wid").alias("b"))
    pairs = texts.groupBy("shard").cogroup(ids.groupBy("of")).applyInArrow(_pairs, "shard bigint, w1 bigint, w2 bigint, n bigint")
    w = [f"w{i + 1}" for i in range(MAX_WORDS)]

    def often(rows: DataFrame, k: int) -> DataFrame:
        return written(rows.select("shard", *w[:k], F.sum("n").over(Window.partitionBy(*w[:k])).alias("f")).filter(
            F.col("f") >= min_count), f"good{k}")

    def shown(good: DataFrame, k: int) -> GroupedData:
        own = good.select(F.col("shard").alias("of"), *[F.col(c).alias(x) for c, x in zip(w[:k], "abc")])
        return ids.withColumn("phrase", F.lit(False)).unionByName(own.withColumn("phrase", F.lit(True)), True).groupBy("of")

    good = often(pairs, 2)
    tokens = totals.agg(F.sum("n")).first()[0] or 0
    buckets = min(MOST_BUCKETS, max(8 * CHUNKS, 1 << max(0, int(tokens // 4)).bit_length()))
    limit = max(1, min(min_count, 1 << 30))
    full = full_buckets(texts.groupBy("shard").cogroup(shown(good, 2)).applyInArrow(
        lambda texts, given: _bucket_counts(texts, given, buckets, limit), "chunk int, at binary, n binary"), buckets, limit)
    threes = often(texts.groupBy("shard").cogroup(shown(good, 2)).applyInArrow(
        lambda texts, given: _threes(texts, given, full), "shard bigint, w1 bigint, w2 bigint, w3 bigint, n bigint"), 3)
    longer = texts.groupBy("shard").cogroup(shown(threes, 3)).applyInArrow(
        _long, ", ".join(f"{c} bigint" for c in w) + ", n bigint").groupBy(*w).agg(F.sum("n").alias("f")).filter(
            F.col("f") >= min_count)
    found = words.select(F.array("wid").alias("p"), "f").unionByName(
        good.groupBy("w1", "w2").agg(F.first("f").alias("f")).select(F.array("w1", "w2").alias("p"), "f")).unionByName(
        threes.groupBy("w1", "w2", "w3").agg(F.first("f").alias("f")).select(F.array("w1", "w2", "w3").alias("p"), "f")).unionByName(
        longer.select(F.array_compact(F.array(*w)).alias("p"), "f"))
    return totals, words, written(found, "found")


def _score(a: Column, n: Column, l: Column, r: Column) -> Column:  # noqa: E741
    """floor(1000 a n / (l r)), exact as long as a n has at most 34 digits: the products are decimals of 38."""
    wide = lambda c: c.cast("decimal(19,0)")
    above = (wide(a) * wide(n)).cast("decimal(34,0)") * F.lit(1000).cast("decimal(4,0)")
    return F.call_function("div", above, wide(l) * wide(r)).cast("long")


def mine(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT,
         top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``top`` phrases.

    By score, then count, both falling, then phrase.  A phrase's score is that of its lowest cut, the first one
    on ties.  Phrases inside a longer one of the same count are left out.
    """
    totals, words, found = frequent(docs, text, lang, min_count)
    size = F.size("p")
    inner = lambda a, b: F.slice("p", F.lit(a), size - b)
    longer = found.filter(size > 2).select(F.explode(F.array(inner(1, 1), inner(2, 1))).alias("p"), F.col("f").alias("more"))
    covered = longer.groupBy("p").agg(F.max("more").alias("more"))
    kept = found.filter(size > 1).join(covered, "p", "left").filter("more is null or more < f").select(
        "p", F.col("f").alias("a"))
    kept = kept.join(words.select("wid", "lang"), F.get("p", F.lit(0)) == F.col("wid")).join(totals, "lang").select(
        "p", "lang", "a", "n")
    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1))).select(
        "*", F.slice("p", F.lit(1), F.col("k")).alias("left"), F.slice("p", F.col("k") + 1, size - F.col("k")).alias("right"))
    part = lambda side, name: found.select(F.col("p").alias(side), F.col("f").alias(name))
    cuts = cuts.join(part("left", "l"), "left").join(part("right", "r"), "right")
    cut = F.min(F.struct(_score(F.col("a"), F.col("n"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r"))
    scored = cuts.groupBy("p", "lang", "a", "n").agg(cut.alias("cut"))
    # at most MAX_WORDS rows a phrase
    spelt = scored.select("*", F.posexplode("p").alias("i", "wid")).join(words.select("wid", "word"), "wid").groupBy(
        "p", "lang", "a", "n", "cut").agg(F.array_sort(F.collect_list(F.struct("i", "word"))).alias("w"))
    rows = cut_lineage(spelt.select("lang", F.array_join(F.col("w.word"), " ").alias("phrase"), "a", "cut.l", "cut.r", "n",
                                    "cut.score"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # first within slices of a language, so that no task sorts all of one
    slices = max(1, rows.count() // 50_000)
    first = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(slices))).orderBy(*order)
    rows = rows.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return rows.filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of every language of the documents."""
    return mine(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
f AS (SELECT lang, w[i:i + m - 1] AS p, count(*)::BIGINT AS f
      FROM starts, (SELECT unnest([1, 2, 3, 4, 5]) AS m) WHERE i + m - 1 <= len(w) GROUP BY lang, w[i:i + m - 1]),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
cand AS (SELECT lang, p, f AS a FROM f WHERE len(p) > 1 AND f >= 100),
inside AS (SELECT lang, p[i:i + m - 1] AS p, max(a) AS more
           FROM (SELECT lang, p, a, unnest(range(1, len(p))) AS i FROM cand), (SELECT unnest([2, 3, 4]) AS m)
           WHERE m < len(p) AND i + m - 1 <= len(p) GROUP BY lang, p[i:i + m - 1]),
kept AS (SELECT c.lang, c.p, c.a FROM cand c LEFT JOIN inside USING (lang, p)
         WHERE more IS NULL OR 100 * more < 100 * c.a),
cut AS (SELECT lang, p, a, unnest(range(1, len(p))) AS k FROM kept),
scored AS (SELECT cut.lang, cut.p, a, k, x.f AS l, y.f AS r, n,
                  ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
           FROM cut JOIN f x ON x.lang = cut.lang AND x.p = cut.p[1:k]
                    JOIN f y ON y.lang = cut.lang AND y.p = cut.p[k + 1:len(cut.p)]
                    JOIN total t ON t.lang = cut.lang),
low AS (SELECT *, array_to_string(p, ' ') AS phrase FROM scored
        QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank,
                  phrase, a, l, r, n, score FROM low)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""
