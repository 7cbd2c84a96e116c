"""Small helpers shared by the operators: reading a table, Arrow batches, words and their hashes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: the white space that separates words (``[^\x20\x09-\x0D]+`` is a word).
WHITE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body) -> Column:
    """``body(x)`` with ``x`` bound to ``value``, so that it is evaluated once however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_column(text: Column) -> Column:
    """Array of the words of ``text``; null and blank texts have none."""
    body = F.btrim(text, F.lit(WHITE))
    return F.when(F.length(body) > 0, F.split(body, "[\\x20\\x09-\\x0D]+")).otherwise(
        F.array().cast("array<string>"))


def split_words(text: str | None) -> list[bytes]:
    """The words of ``text`` as UTF-8; ``bytes.split`` knows exactly the six separators above."""
    return text.encode().split() if text else []


def lower_words(text: str | None) -> list[bytes]:
    """Like ``split_words``, with A-Z (and nothing else) in lower case."""
    return text.encode().lower().split() if text else []


def hash_words(words: Sequence[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def text_groups(texts: Sequence[str | None], chars: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of ``texts`` of about ``chars`` characters (one long text may exceed it alone)."""
    at = total = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if total and total + n > chars:
            yield at, i
            at, total = i, 0
        total += n
    if at < len(texts):
        yield at, len(texts)


def lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Arrow lists that take ``values[offsets[i]:offsets[i + 1]]``."""
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))


class Recent(dict):
    """``compute(key)``, remembered for the keys seen last: between ``size`` and twice as many."""

    def __init__(self, compute, size: int = 150_000, longest: int = 64):
        super().__init__()
        self.compute, self.size, self.longest, self.before = compute, size, longest, {}

    def __missing__(self, key):
        out = self.before.get(key)
        if out is None:
            out = self.compute(key)
            if len(key) > self.longest:
                return out
        if len(self) >= self.size:
            self.before = dict(self)
            self.clear()
        self[key] = out
        return out
