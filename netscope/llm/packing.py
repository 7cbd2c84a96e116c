"""Hierarchical multi-length packing of documents into training sequences.

Documents are tokenized and cut into whole long windows plus one remainder, which is routed to the
shortest context tier that holds it.  Each tier packs its own remainders; gaps of longer windows are
filled from shorter tiers, largest fitting remainder first, and the last bit of a gap by cutting one
remainder.  Full windows of a tier are dealt to step groups of equal token count whose attention cost
(sum of squared piece lengths) is balanced.  What is still open at the end of a partition is cut into
powers of two, so that no sequence needs padding.

Packing works along each input partition in blocks, without a shuffle: memory is bounded by a block
and the few open remainders, the result is gapless per partition, and a lost executor repeats whole
partitions.  ``sequence_id`` and ``step_id`` carry the partition number in their upper bits.

Null and empty texts hold just the end token; a repeated row is packed again; empty tables give no
sequences.
"""

from __future__ import annotations

import bisect
import functools
import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netscope.llm.common import Recent, table

NAME = "op3_packing"
VOCABULARY = "word_bpe_49k.json"
TIERS = (2048, 1024, 512, 256)
END_ID = 1
BLOCK_TOKENS = 2_000_000
STEP_TOKENS = 16_384

SCHEMA = ("start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
          "offset bigint, tier int, step_id bigint")


def _byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1 bytes
    stand for themselves, the others are numbered from 256."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class _Chunks:
    """White-space separated chunk -> its ids as little-endian bytes.

    The tokenizer never joins across white space, and keeps letters apart from the punctuation behind
    them, so a chunk like ``Word,`` is looked up as ``word`` and ``,``.  A word of plain letters is one
    pre-token, which goes straight to the tokenizer's BPE model.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        self.ids = Recent(self._chunk)

    def _chunk(self, chunk: bytes) -> bytes:
        if chunk.isalpha():     # letters of ASCII, the most of what is met: no look at each one
            if not chunk.islower():
                return self.ids[chunk.lower()]
            return array("I", [t.id for t in self.model.tokenize(chunk.decode())]).tobytes()
        text = chunk.decode()
        core = text.rstrip(".,")
        if core and (core.isascii() or max(core) < "ɐ") and core.isalpha():
            low = core.lower()
            if low.isalpha():
                if low != text:
                    return self.ids[low.encode()] + (self.ids[text[len(core):].encode()] if len(core) < len(text) else b"")
                word = low if low.isascii() else "".join([self.letters[b] for b in chunk])
                return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


@functools.cache
def _chunks(path: str) -> _Chunks:
    return _Chunks(path)


def token_ids(text: str | None, path: str) -> bytes:
    """The text's ids and the end token, as little-endian unsigned 32-bit numbers."""
    end = END_ID.to_bytes(4, "little")
    if not text:
        return end
    ids = _chunks(path).ids
    return b"".join([ids[c] for c in text.encode().split()]) + end


Piece = tuple[int, int, int]  # document, start, length


class Remainders:
    """Open remainders of one tier, sorted by length."""

    def __init__(self):
        self.keys: list[tuple[int, int, int]] = []  # length, document, start

    def __len__(self) -> int:
        return len(self.keys)

    def add(self, piece: Piece) -> None:
        bisect.insort(self.keys, (piece[2], piece[0], piece[1]))

    def take(self, at: int) -> Piece:
        length, doc, start = self.keys.pop(at)
        return doc, start, length

    def largest(self, most: int) -> Piece | None:
        """The longest remainder of at most ``most`` tokens."""
        at = bisect.bisect_right(self.keys, (most, 1 << 62, 0)) - 1
        return self.take(at) if at >= 0 else None


class Packer:
    """Windows out of documents, tier by tier."""

    def __init__(self, tiers: tuple[int, ...] = TIERS):
        self.tiers = tuple(sorted(tiers, reverse=True))
        self.open = {t: Remainders() for t in self.tiers}

    def _route(self, piece: Piece) -> None:
        self.open[min(t for t in self.tiers if t >= piece[2])].add(piece)

    def add(self, doc: int, tokens: int) -> Iterator[tuple[int, list[Piece]]]:
        """Routes a document; yields the long windows that it fills alone."""
        top, start = self.tiers[0], 0
        while tokens - start >= top:
            yield top, [(doc, start, top)]
            start += top
        if start < tokens:
            self._route((doc, start, tokens - start))

    def _fill(self, tier: int, first: Piece) -> list[Piece]:
        """One window that starts with ``first``, filled from this and the shorter tiers."""
        window, gap = [first], tier - first[2]
        below = [t for t in self.tiers if t <= tier]
        while gap:
            best = None
            for t in below:  # whole remainders, the longest that fits
                if (best := self.open[t].largest(gap)) is not None:
                    break
            if best is None:
                donor = next((self.open[t] for t in reversed(below) if len(self.open[t])), None)
                if donor is None:
                    break
                doc, start, length = donor.take(0)  # cut the shortest that is too long
                best = (doc, start, gap)
                self._route((doc, start + gap, length - gap))
            window.append(best)
            gap -= best[2]
        return window

    def windows(self) -> Iterator[tuple[int, list[Piece]]]:
        """Packs what is open, long tiers first; at most one unfilled window's pieces stay open."""
        for tier in self.tiers:
            mine = self.open[tier]
            while len(mine):
                window = self._fill(tier, mine.take(len(mine) - 1))
                if sum(p[2] for p in window) < tier:
                    for p in window:
                        self._route(p)
                    break
                yield tier, window

    def close(self) -> Iterator[tuple[int, list[Piece]]]:
        """Cuts the rest into windows whose lengths are powers of two."""
        yield from self.windows()
        rest = [p for t in self.tiers for p in (self.open[t].take(0) for _ in range(len(self.open[t])))]
        total = sum(p[2] for p in rest)
        while total:
            size = min(1 << (total.bit_length() - 1), self.tiers[0])
            window, need = [], size
            while need:
                doc, start, length = rest.pop()
                if length > need:
                    rest.append((doc, start + need, length - need))
                    length = need
                window.append((doc, start, length))
                need -= length
            total -= size
            yield size, window


def step_groups(windows: list[tuple[int, list[Piece]]], step_tokens: int = STEP_TOKENS) -> list[int]:
    """Group number of each window: groups hold one tier and equal tokens, and the windows, sorted by
    attention cost, are dealt to a tier's groups back and forth."""
    out, base = [0] * len(windows), 0
    for tier in sorted({t for t, _ in windows}, reverse=True):
        mine = [i for i, (t, _) in enumerate(windows) if t == tier]
        mine.sort(key=lambda i: (-sum(p[2] ** 2 for p in windows[i][1]), i))
        n = -(-len(mine) * tier // step_tokens)
        for k, i in enumerate(mine):
            turn, at = divmod(k, n)
            out[i] = base + (n - 1 - at if turn % 2 else at)
        base += n
    return out


def pack(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text",
         tiers: tuple[int, ...] = TIERS, block_tokens: int = BLOCK_TOKENS,
         step_tokens: int = STEP_TOKENS) -> DataFrame:
    """One row per piece: where it stands in its document and in which sequence it lies."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        base = (context.partitionId() if context else 0) << 40
        packer, keys, ids, left = Packer(tiers), {}, {}, {}
        numbers = {"doc": 0, "sequence": 0, "step": 0}

        def rows(windows: list[tuple[int, list[Piece]]]) -> pa.RecordBatch:
            cols: list[list] = [[] for _ in range(9)]
            groups = step_groups(windows, step_tokens)
            for (tier, window), group in zip(windows, groups):
                offset = 0
                for doc, start, length in window:
                    data = ids[doc]
                    for c, v in zip(cols, (keys[doc], start, length,
                                           zlib.crc32(memoryview(data)[4 * start:4 * (start + length)]),
                                           len(data) // 4, base + numbers["sequence"], offset, tier,
                                           base + numbers["step"] + group)):
                        c.append(v)
                    offset += length
                    left[doc] -= length
                    if not left[doc]:
                        del left[doc], ids[doc], keys[doc]
                numbers["sequence"] += 1
            numbers["step"] += max(groups, default=-1) + 1
            types = [key_type, *[pa.int64()] * 6, pa.int32(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

        names = ["key", *[c.split()[0] for c in SCHEMA.split(", ")]]
        key_type, done, tokens = None, [], 0
        for batch in batches:
            key_type = batch.schema.field(0).type
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                doc = numbers["doc"]
                numbers["doc"] += 1
                data = token_ids(t, path)
                keys[doc], ids[doc], left[doc] = k, data, len(data) // 4
                done.extend(packer.add(doc, left[doc]))
                tokens += left[doc]
                if tokens >= block_tokens:
                    done.extend(packer.windows())
                    yield rows(done)
                    done, tokens = [], 0
        done.extend(packer.close())
        if done:
            yield rows(done)

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        run, f"key {kind}, {SCHEMA}").withColumnRenamed("key", key)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in sequences of at most 2048 tokens."""
    import public_tokenizers
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
