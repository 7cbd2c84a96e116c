"""Substring dedup by recompression.

Words are the first symbols.  Each round names runs (first round) and pairs: every symbol falls to a
left or right side by a hash of its name, and a left symbol followed by a right one becomes one symbol,
whose name is a hash of the two.  Names depend on nothing else, so equal substrings get equal symbols in
their interior wherever they stand, without a dictionary.  With each symbol goes its context, the words
that decide that it is formed; any window of words that holds the context holds the symbol.

1. Spark counts the symbols of all documents (``MIN_SPAN`` words or more, context within a window).
2. A window is a candidate unless it holds a symbol that occurs once in the corpus.  The repeated symbols
   go to the tasks as a Bloom filter of at most ``FILTER_BITS`` bits; what it lets through by mistake,
   or once it is full, costs time and changes nothing.
3. Candidate windows meet by a 96-bit hash of their words; all but the first are repeats.  Within a task
   all but the task's first are known to be repeats at once, so a passage that a third of all documents
   share sends one row per task, not one per document.

Order is by key, then by place; windows are judged on the input.  A repeated row (same key and text) is
the same document and loses nothing to its copy; rows with one key and different texts are documents of their
own, in the order of their texts' hashes.  Rows with a null key lose nothing; null and blank texts
have no words; texts shorter than a window lose nothing; an empty table gives an empty result; other
columns pass through.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netscope.llm.common import hash_words, split_words, table, text_groups, words_column
from netscope.session import cut_lineage

NAME = "op1_recompression"
WINDOW = 20
ROUNDS, MIN_SPAN = 7, 4
FILTER_BITS = 1 << 28
SEGMENT_BITS = 1 << 20
GROUP_CHARS = 6_000_000

U = np.uint64
_WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(32))
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(29)
    return x


def symbols(words: np.ndarray, doc: np.ndarray, rounds: int = ROUNDS) -> Iterator[tuple]:
    """``name, first, last, span`` of the symbols formed in each round: the context's first word, the word
    after its last, and the number of words that the symbol covers.

    ``words`` are word hashes of documents one after another, ``doc`` their documents' numbers.
    """
    n = len(words)
    if not n:
        return
    new = np.ones(n, bool)
    new[1:] = (words[1:] != words[:-1]) | (doc[1:] != doc[:-1])
    start = np.flatnonzero(new).astype(np.int32)
    end = np.append(start[1:], np.int32(n)).astype(np.int32)
    name, d = words[start], doc[start]
    run = end - start
    name = np.where(run > 1, mix(name * U(0x9E3779B97F4A7C15) + run.astype(U)), name)
    first, last = start - 1, end + 1   # a run is one only if its neighbours differ
    far = np.int32(10 * WINDOW)
    for k in range(rounds):
        salt = U((0xA24BAED4963EE407 * (k + 1)) & (2 ** 64 - 1))
        left = (mix(name + salt) >> U(40)) & U(1) == 0
        beside = d[:-1] == d[1:]                      # the next symbol is of the same document
        pair = left[:-1] & ~left[1:] & beside
        a = np.flatnonzero(pair)
        # what stays as it is does so because of the neighbour that it could have joined
        stays = np.ones(len(name), bool)
        stays[a], stays[a + 1] = False, False
        nf, nl = first.copy(), last.copy()
        right_of = np.flatnonzero(stays[:-1] & left[:-1] & beside)
        nf[right_of] = np.minimum(first[right_of], first[right_of + 1])
        nl[right_of] = np.maximum(last[right_of], last[right_of + 1])
        left_of = np.flatnonzero(stays[1:] & ~left[1:] & beside) + 1
        nf[left_of] = np.minimum(first[left_of], first[left_of - 1])
        nl[left_of] = np.maximum(last[left_of], last[left_of - 1])
        ends = np.append(~beside, True)               # no neighbour: other occurrences may have one
        begins = np.insert(~beside, 0, True)
        nl[stays & left & ends] += far
        nf[stays & ~left & begins] -= far
        made = mix(name[a] * U(0x9E3779B97F4A7C15) + ((name[a + 1] << U(23)) | (name[a + 1] >> U(41))) * U(
            0xC2B2AE3D27D4EB4F) + U(k))
        nf[a], nl[a] = np.minimum(first[a], first[a + 1]), np.maximum(last[a], last[a + 1])
        name = name.copy()
        name[a] = made
        end = end.copy()
        end[a] = end[a + 1]
        yield made, nf[a], nl[a], end[a] - start[a]
        keep = np.ones(len(name), bool)
        keep[a + 1] = False
        name, first, last, start, end, d = (x[keep] for x in (name, nf, nl, start, end, d))


def anchors(words: np.ndarray, doc: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``name, first, last`` of the symbols that are counted."""
    found = []
    for name, first, last, span in symbols(words, doc):
        m = (span >= MIN_SPAN) & (last - first <= window)
        found.append((name[m], first[m], last[m]))
    if not found:
        return np.zeros(0, U), np.zeros(0, np.int32), np.zeros(0, np.int32)
    return tuple(np.concatenate(x) for x in zip(*found))


def _texts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts one after another, and each word's text."""
    words = [split_words(t) for t in texts]
    doc = np.repeat(np.arange(len(words), dtype=np.int32), [len(w) for w in words])
    return hash_words([w for ws in words for w in ws]), doc


def repeated_symbols(docs: DataFrame, text: str, window: int) -> DataFrame:
    """``name`` of the symbols that occur twice or more in the corpus."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for lo, hi in text_groups(texts, GROUP_CHARS):
                name, n = np.unique(anchors(*_texts(texts[lo:hi]), window)[0], return_counts=True)
                for at in range(0, len(name), 100_000):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(name[at:at + 100_000].view(np.int64)),
                         pa.array(np.minimum(n[at:at + 100_000], 2).astype(np.int8))], names=["name", "n"])

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "name bigint, n tinyint").groupBy("name").agg(
        F.sum("n").alias("n")).filter("n > 1").select("name")


def _bits(name: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two places of each name in one segment of the filter."""
    h = mix(name * U(0xFF51AFD7ED558CCD))
    segment = (h >> U(40)) % U(max(bits // SEGMENT_BITS, 1)) * U(SEGMENT_BITS)
    return segment + (h & U(SEGMENT_BITS - 1)), segment + ((h >> U(20)) & U(SEGMENT_BITS - 1))


def bloom(names: DataFrame) -> np.ndarray:
    """Bloom filter of ``names``: 8 to 16 bits for each until it reaches ``FILTER_BITS``."""
    names = cut_lineage(names)
    n = names.count()
    bits = int(min(FILTER_BITS, max(SEGMENT_BITS, 1 << max(0, math.ceil(math.log2(max(n, 1) * 8))))))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        part = np.zeros(SEGMENT_BITS // 8, np.uint8)
        name = pdf["name"].to_numpy().view(U)
        for at in _bits(name, bits):
            at = at & U(SEGMENT_BITS - 1)
            np.bitwise_or.at(part, (at >> U(3)).astype(np.int64), (U(1) << (at & U(7))).astype(np.uint8))
        return pd.DataFrame({"segment": [pdf["segment"].iat[0]], "data": [part.tobytes()]})

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _bits(batch.column(0).to_numpy().view(U), bits)[0] // U(SEGMENT_BITS)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(at.astype(np.int32))], names=["name", "segment"])

    out = np.zeros(bits // 8, np.uint8)
    rows = names.mapInArrow(place, "name bigint, segment int").groupBy("segment").applyInPandas(
        build, "segment int, data binary").toPandas()  # FILTER_BITS / 8 bytes at most
    for segment, data in zip(rows["segment"], rows["data"]):
        out[segment * SEGMENT_BITS // 8:(segment + 1) * SEGMENT_BITS // 8] = np.frombuffer(data, np.uint8)
    return out


def candidates(words: np.ndarray, doc: np.ndarray, repeated: np.ndarray, window: int) -> np.ndarray:
    """Starts of the windows that hold no symbol known to occur once."""
    n = len(words)
    if n < window:
        return np.zeros(0, np.int64)
    name, first, last = anchors(words, doc, window)
    p, q = _bits(name, len(repeated) * 8)
    hit = lambda at: (repeated[at >> U(3)] >> (at & U(7)).astype(np.uint8)) & 1
    once = (hit(p) & hit(q)) == 0
    lo, hi = np.maximum(last[once] - window, 0), first[once]
    ok = hi >= lo
    change = np.bincount(lo[ok], minlength=n + 2) - np.bincount(hi[ok] + 1, minlength=n + 2)
    starts = n - window + 1
    return np.flatnonzero((np.cumsum(change)[:starts] == 0) & (doc[:starts] == doc[window - 1:]))


def window_hashes(words: np.ndarray, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit and a 32-bit hash of each window."""
    rng = np.random.default_rng(41).integers(1, 2 ** 63, (2, window), dtype=U) * U(2) + U(1)
    one, two = np.zeros(len(starts), U), np.zeros(len(starts), U)
    mixed = mix(words)
    for k in range(window):
        w = mixed[starts + k]
        one += w * rng[0, k]
        two += (w ^ (w >> U(31))) * rng[1, k]
    return mix(one), (mix(two) >> U(32)).astype(np.uint32)


def row_hash(docs: DataFrame, key: str, text: str) -> Column:
    """Tells rows of one key apart by their text; the same for all where no key is repeated, so that it weighs nothing."""
    again = docs.filter(F.col(key).isNotNull()).groupBy(key).count().filter("count > 1")
    return F.lit(0).cast("bigint") if again.isEmpty() else F.xxhash64(text)


def repeats(docs: DataFrame, key: str, text: str, window: int, repeated: np.ndarray, same: Column) -> DataFrame:
    """``key, same, a, b``: word ranges covered by windows that also start earlier.

    Documents go by key, rows of one key by ``same``.  A window travels as its 64-bit hash ``x`` and as ``z``, its
    32-bit hash above its place: numbers side by side, so that rows of one document differ in one stretch of bytes."""
    kind = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(repeated)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each task's first window of a kind, to meet the others (``b`` null); repeats found here as ranges."""
        for batch in batches:
            keys, texts = batch.column(0), batch.column(2).to_pylist()
            for lo, hi in text_groups(texts, GROUP_CHARS):
                own = keys.slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo)
                by_key = np.array(pa.compute.rank(own[0], tiebreaker="dense")).astype(np.int64)
                rank = np.unique(np.stack([by_key, own[1].to_numpy()]), axis=1, return_inverse=True)[1].ravel()
                words, doc = _texts(texts[lo:hi])
                starts = candidates(words, doc, shared.value, window)
                if not len(starts):
                    continue
                begins = np.searchsorted(doc, np.arange(hi - lo))
                place = starts - begins[doc[starts]]
                h1, h2 = window_hashes(words, starts, window)
                order = np.lexsort((place, rank[doc[starts]], h2, h1))
                s, p, x, y = starts[order], place[order], h1[order], h2[order]
                head = np.ones(len(s), bool)
                head[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
                lead = np.flatnonzero(head)[np.cumsum(head) - 1]
                r = rank[doc[s]]
                same = (r == r[lead]) & (p == p[lead])      # the first window itself, or its row repeated
                out_doc, out_p = doc[s[head]], p[head]
                yield _batch(own, out_doc, x[head].view(np.int64), y[head].view(np.int32), out_p, None)
                again = np.sort(s[~same])
                if len(again):
                    cut = np.ones(len(again), bool)
                    cut[1:] = (again[1:] != again[:-1] + 1) | (doc[again[1:]] != doc[again[:-1]])
                    a = again[cut]
                    b = again[np.append(np.flatnonzero(cut)[1:] - 1, len(again) - 1)] + window
                    at = doc[a]
                    yield _batch(own, at, mix(a.astype(U)).view(np.int64), np.zeros(len(a), np.int32),
                                 a - begins[at], b - begins[at])

    def flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by hash, key and place: the first of a hash stays, the others are repeats."""
        names = ["key", "same", "a", "b"]
        before = None   # the last group's hash, and its first window
        for batch in batches:
            done = batch.filter(pa.compute.is_valid(batch.column(4)))
            if len(done):
                yield pa.RecordBatch.from_arrays([done.column(2), done.column(3), done.column(1).cast(pa.int32()),
                                                  done.column(4)], names=names)
            rows = batch.filter(pa.compute.is_null(batch.column(4)))
            if not len(rows):
                continue
            x, z, t = (rows.column(i).to_numpy() for i in (0, 1, 3))
            y, p = z >> 32, (z & 0xFFFFFFFF).astype(np.int32)
            keys = rows.column(2)
            head = np.ones(len(x), bool)
            head[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
            if before is not None and before[:2] == (int(x[0]), int(y[0])):
                head[0] = False
            lead = np.flatnonzero(head)
            at = np.cumsum(head) - 1
            first_p = np.where(at >= 0, p[lead[np.maximum(at, 0)]] if len(lead) else 0, before[3] if before else 0)
            firsts = keys.take(pa.array(lead[np.maximum(at, 0)])) if len(lead) else keys
            first_t = np.where(at >= 0, t[lead[np.maximum(at, 0)]] if len(lead) else 0, before[4] if before else 0)
            same = pa.compute.equal(keys, firsts).to_numpy(zero_copy_only=False)
            if (at < 0).any():
                n = int((at < 0).sum())
                same[:n] = [k == before[2] for k in keys.slice(0, n).to_pylist()]
            same &= t == first_t
            again = ~(same & (p == first_p))
            again[lead] = False
            if len(lead):
                before = (int(x[-1]), int(y[-1]), keys[int(lead[-1])].as_py(), int(p[lead[-1]]), int(t[lead[-1]]))
            if again.any():
                q = p[again]
                yield pa.RecordBatch.from_arrays(
                    [keys.filter(pa.array(again)), pa.array(t[again]), pa.array(q), pa.array((q + window).astype(np.int32))],
                    names=names)

    rows = docs.filter(F.col(key).isNotNull()).select(F.col(key).alias("key"), same.alias("same"), F.col(text).alias("text"))
    met = rows.mapInArrow(find, f"x bigint, z bigint, key {kind}, same bigint, b int")
    return met.repartition("x").sortWithinPartitions("x", F.shiftright("z", 32), "key", "same", "z").mapInArrow(
        flag, f"key {kind}, same bigint, a int, b int")


def _batch(keys: tuple[pa.Array, pa.Array], doc: np.ndarray, x: np.ndarray, y: np.ndarray, a: np.ndarray,
           b: np.ndarray | None) -> pa.RecordBatch:
    end = pa.nulls(len(a), pa.int32()) if b is None else pa.array(b.astype(np.int32))
    z = y.astype(np.int64) << 32 | a.astype(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(x), pa.array(z), *(k.take(pa.array(doc)) for k in keys), end], names=["x", "z", "key", "same", "b"])


def remove_words(text: str | None, ranges: list[tuple[int, int]]) -> tuple[str | None, int, int]:
    """The text without the words in ``ranges`` (and the white space before each), its words, those removed."""
    if not ranges:
        return text, len(split_words(text)), 0
    spans = [m.span() for m in _WORDS.finditer(text)]
    change = np.zeros(len(spans) + 1, np.int64)
    a, b = np.array(ranges).T
    np.add.at(change, a, 1)
    np.add.at(change, np.minimum(b, len(spans)), -1)
    gone = np.cumsum(change)[:-1] > 0
    out, at = [], 0
    for (_, end), drop in zip(spans, gone.tolist()):
        if not drop:
            out.append(text[at:end])
        at = end
    out.append(text[at:])
    return "".join(out), len(spans), int(gone.sum())


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``row`` (the document as it came), ``kept`` (its text without repeats), ``n_words``, ``n_removed``."""
    repeated = bloom(repeated_symbols(docs.filter(F.col(key).isNotNull()), text, window))
    same = row_hash(docs, key, text)
    found = repeats(docs, key, text, window, repeated, same).groupBy("key", "same").agg(
        F.collect_list("a").alias("a"), F.collect_list("b").alias("b"))
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(key).alias("key"),
                       same.alias("same")).join(found, ["key", "same"], "left").select("row", "a", "b")  # the text moves once, inside the row

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [remove_words(t.as_py(), list(zip(a.as_py(), b.as_py())) if a.is_valid else [])
                    for t, a, b in zip(batch.column(0).field(text), batch.column(1), batch.column(2))]
            kept, n, removed = zip(*done) if done else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(kept, pa.string()), pa.array(n, pa.int64()), pa.array(removed, pa.int64())],
                names=["row", "kept", "n_words", "n_removed"])

    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(cut, f"row {kind}, kept string, n_words bigint, n_removed bigint")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document once 20-word repeats are removed."""
    done = dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select(F.col("row.doc_id").alias("doc_id"), "n_words", "n_removed",
                       F.sha2(F.array_join(words_column(F.col("kept")), " "), 256).alias("kept_sha256"))
