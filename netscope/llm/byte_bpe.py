"""Byte-level BPE encoding and decoding with regex-free, vectorised pre-tokenisation.

Pre-tokenisation follows ``public_tokenizers.PATTERN``.  Every code point gets a class from one array
lookup; two look-ahead facts (is white space followed by something else, does an apostrophe open a
contraction) refine the classes.  What remains is a finite automaton over classes, and its steps are
functions on states: composing them is associative, so all states of a text are found by a blocked
scan over the automaton's (small) transition monoid instead of a loop over characters.  Changes of
state then mark the slices, each distinct slice is merged once per worker (cache), and the ids' byte
offsets give the text back.

The vocabulary is read from a path parameter by the executors.  Rows are independent, so a lost
executor only repeats its own rows.  Null texts encode to no ids; empty tables give empty results.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netscope.llm.common import Recent, lists, table, text_groups

NAME = "op8_byte_bpe"
VOCABULARY = "byte_bpe_multi_50k.tiktoken"

# The contractions of the pattern.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")

# Classes of code points after look-ahead.
LETTER, NUMBER, OTHER, SHORT, LONG, WHITE, SPACE_LAST, WHITE_LAST, START = range(9)
# States: what the last token so far is made of.
FRESH, IN_L, IN_N, IN_O, IN_W, AFTER_SPACE, CLOSED, NEED_1, NEED_2 = range(9)


def _step(state: int, cls: int) -> tuple[int, bool]:
    """Next state, and whether a token starts at this code point."""
    if cls == START:
        return FRESH, True
    if cls == LETTER:
        if state == NEED_2:
            return NEED_1, False
        if state == NEED_1:
            return CLOSED, False
        return IN_L, state not in (IN_L, AFTER_SPACE)
    if cls == NUMBER:
        return IN_N, state not in (IN_N, AFTER_SPACE)
    if cls == WHITE:
        return IN_W, state != IN_W
    if cls == SPACE_LAST:
        return AFTER_SPACE, True
    if cls == WHITE_LAST:
        return CLOSED, True
    if state in (IN_O, AFTER_SPACE) or cls == OTHER:
        return IN_O, state not in (IN_O, AFTER_SPACE)
    return (NEED_1 if cls == SHORT else NEED_2), True


def _members(engine_class: str) -> np.ndarray:
    """Code points of one class of the pattern, as tiktoken's own engine has it (Python's tables may be of
    another Unicode version): an encoding whose pattern is the class keeps just these characters."""
    one = tiktoken.Encoding(engine_class, pat_str=engine_class, special_tokens={},
                            mergeable_ranks={bytes([i]): i for i in range(256)})
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    return np.frombuffer(bytes(one.encode_ordinary(every)).decode().encode("utf-32-le"), "<u4")


@functools.cache
def _classes() -> np.ndarray:
    """Class of every code point, without look-ahead (apostrophes count as OTHER); once per worker."""
    out = np.full(0x110000, OTHER, np.uint8)
    for cls, engine_class in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (WHITE, r"\s")):
        out[_members(engine_class)] = cls
    return out


@functools.cache
def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The functions on states that classes generate: ids of the classes' own, composition table,
    each function's value at FRESH, and the table of token starts by (state, class)."""
    n_states, n_classes = 9, 9
    own = [tuple(_step(s, c)[0] for s in range(n_states)) for c in range(n_classes)]
    found = {f: i for i, f in enumerate(dict.fromkeys(own))}
    todo = list(found)
    while todo:
        f = todo.pop()
        for g in own:
            h = tuple(g[x] for x in f)
            if h not in found:
                found[h] = len(found)
                todo.append(h)
    every = list(found)
    compose = np.array([[found[tuple(g[x] for x in f)] for g in every] for f in every], np.uint16)
    starts = np.array([[_step(s, c)[1] for c in range(n_classes)] for s in range(n_states)])
    return (np.array([found[f] for f in own], np.uint16), compose,
            np.array([f[FRESH] for f in every], np.uint8), starts)


def _scan(ids: np.ndarray, block: int = 64) -> np.ndarray:
    """Inclusive scan of function composition: blocks side by side, then their totals, then both joined."""
    _, compose, _, _ = _monoid()
    m, n = compose.shape[0], len(ids)
    if n <= block:
        out = ids.copy()
        for i in range(1, n):
            out[i] = compose[out[i - 1], ids[i]]
        return out
    flat = compose.ravel()
    rows = -(-n // block)
    grid = np.zeros(rows * block, np.uint16)
    grid[:n] = ids
    grid = np.ascontiguousarray(grid.reshape(rows, block).T).astype(np.int32)
    for i in range(1, block):
        grid[i] = flat[grid[i - 1] * m + grid[i]]
    before = _scan(grid[-1].astype(np.uint16), block)[:-1].astype(np.int32) * m
    grid[:, 1:] = flat[before[None, :] + grid[:, 1:]]
    return np.ascontiguousarray(grid.T).astype(np.uint16).ravel()[:n]


def _classify(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Classes with look-ahead; ``first`` are the places (sorted) where a new text's separator stands."""
    cls = _classes()[points]
    cls[first] = START
    white = cls == WHITE
    last = white.copy()
    last[:-1] &= ~white[1:] & (cls[1:] != START)
    last[-1:] = False
    cls[last] = np.where(points[last] == 32, SPACE_LAST, WHITE_LAST)
    at = np.flatnonzero((points == 39) & (cls == OTHER))
    for text in CONTRACTIONS:
        fits = at[at + len(text) <= len(points)]
        for k, ch in enumerate(text[1:], 1):
            fits = fits[(points[fits + k] == ord(ch)) & (cls[fits + k] != START)]
        cls[fits] = SHORT if len(text) == 2 else LONG
    return cls


def pretokens(texts: Sequence[str]) -> tuple[str, np.ndarray, np.ndarray]:
    """All texts behind one separator each, the places where tokens start (separators included), and
    the separators' places."""
    joined = "\0" + "\0".join(texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    first = np.cumsum([0, *[len(t) + 1 for t in texts[:-1]]]).astype(np.int64)
    cls = _classify(points, first)
    own, _, at_fresh, starts = _monoid()
    states = at_fresh[_scan(own[cls])]
    before = np.empty_like(states)
    before[0], before[1:] = FRESH, states[:-1]
    return joined, np.flatnonzero(starts.ravel()[before.astype(np.int16) * 9 + cls]), first


@functools.cache
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@functools.cache
def _vocabulary(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The tokens' bytes one after another, each token's place there, and its length."""
    by_id = {i: t for t, i in ranks(path).items()}
    tokens = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
    size = np.array([len(t) for t in tokens], np.int64)
    return np.frombuffer(b"".join(tokens), np.uint8), np.concatenate([[0], np.cumsum(size)[:-1]]), size


def merge(piece: bytes, rank: dict[bytes, int]) -> list[int]:
    """Ids of one slice: again and again the adjacent pair of lowest rank (the first of equals) is joined.

    A heap holds the pairs by rank and place, with links between neighbours, so that long slices stay
    near linear.
    """
    if (known := rank.get(piece)) is not None:
        return [known]
    import heapq
    n = len(piece)
    end = list(range(1, n + 1))          # where the part that starts here ends; 0 once it was joined
    prev = list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank.get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = end[i]
        if not j or j >= n or end[j] != stop:
            continue                      # one of the two has changed since
        end[i], end[j] = stop, 0
        if stop < n:
            prev[stop] = i
            if (r := rank.get(piece[i:end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (p := prev[i]) >= 0 and (r := rank.get(piece[p:stop])) is not None:
            heapq.heappush(heap, (r, p, stop))
    out, i = [], 0
    while i < n:
        out.append(rank[piece[i:end[i]]])
        i = end[i]
    return out


@functools.cache
def _cache(path: str) -> Recent:
    """Slice -> its ids as little-endian bytes, merged on first sight."""
    rank = ranks(path)
    return Recent(lambda piece: np.array(merge(piece.encode(), rank), "<u4").tobytes())


def encode_batch(texts: Sequence[str | None], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after another, and where each text's ids start (one more place: the end)."""
    texts = [t or "" for t in texts]
    joined, starts, first = pretokens(texts)
    at = starts.tolist()
    at.append(len(joined))
    cache = _cache(path)
    pieces = [cache[joined[a:b]] for a, b in zip(at, at[1:])]
    # a separator is a token of its own: its ids are dropped, its place tells where the text starts
    marks = np.searchsorted(starts, first)
    for i in marks.tolist():
        pieces[i] = b""
    ids = np.frombuffer(b"".join(pieces), "<u4")
    sizes = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces))) // 4
    return ids, np.append(sizes[marks], len(ids))


def decode_batch(ids: np.ndarray, offsets: np.ndarray, path: str) -> tuple[bytes, np.ndarray]:
    """Bytes of all texts one after another, and where each text's bytes start."""
    data, place, size = _vocabulary(path)
    n = size[ids]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    take = np.repeat(place[ids] - (ends - n), n) + np.arange(total)
    return data[take].tobytes(), np.concatenate([[0], ends])[offsets]


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``ids`` (token ids) and ``byte_starts`` (each token's place in the UTF-8 text)."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in text_groups(texts):
                ids, offsets = encode_batch(texts[a:b], path)
                size = _vocabulary(path)[2][ids]
                places = np.cumsum(size) - size
                bounds = np.append(places, size.sum())[offsets]
                places = places - np.repeat(bounds[:-1], np.diff(offsets))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), lists(ids.astype(np.int32), offsets), lists(places, offsets)],
                    names=["key", "ids", "byte_starts"])

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        run, f"key {kind}, ids array<int>, byte_starts array<bigint>").withColumnRenamed("key", key)


def decode(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key`` and ``data``, the decoded bytes."""
    kind = encoded.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            flat, n = column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().fill_null(0).to_numpy()
            data, bounds = decode_batch(flat, np.concatenate([[0], np.cumsum(n)]), path)
            out = [data[a:b] for a, b in zip(bounds.tolist(), bounds[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["key", "data"])

    return encoded.select(F.col(key).alias("key"), F.col(ids).alias("ids")).mapInArrow(
        run, f"key {kind}, data binary").withColumnRenamed("key", key)


def digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per text: number of ids, and hashes of the ids and of the bytes decoded from them."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in text_groups(texts):
                ids, offsets = encode_batch(texts[a:b], path)
                data, bounds = decode_batch(ids, offsets, path)
                raw, view = memoryview(ids.tobytes()), memoryview(data)
                spans = list(zip(offsets.tolist(), offsets[1:].tolist()))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), pa.array(np.diff(offsets)),
                    pa.array([hashlib.sha256(raw[4 * i:4 * j]).hexdigest() for i, j in spans]),
                    pa.array([hashlib.sha256(view[i:j]).hexdigest()
                              for i, j in zip(bounds.tolist(), bounds[1:].tolist())])],
                    names=["key", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        run, f"key {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string").withColumnRenamed("key", key)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every document, decode its ids, and return the digests of both."""
    import public_tokenizers
    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
