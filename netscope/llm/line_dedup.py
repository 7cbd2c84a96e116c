"""Line dedup: lines that several documents hold stay in one of them only.

1. Lines are exploded with their positions; a line's key is the line without white space at both ends and
   with A-Z in lower case, told by a 128-bit hash.  Keys under ``MIN_CHARS`` code points never leave a task.
2. Spark counts the distinct documents of each key and finds the largest; no group is collected, so a line
   that a third of all documents hold costs one row per document and nothing more.
3. Keys at or over the threshold meet their lines again, which gives the positions to drop per document, and
   the other lines are joined by position.

A document is a ``doc_id``: rows that share one count once and lose the same keys, whatever their texts.
Rows with a null key neither count nor lose lines.  A null or empty text is one empty line.  An empty table
gives an empty result; other columns pass through untouched as one struct, so none clashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netscope.llm.common import WHITE, table
from netscope.session import cut_lineage, unique_subdir

NAME = "op13_line_dedup"
MIN_CHARS, MIN_DOCS = 20, 3

_WHITE = WHITE.encode()
_BATCH = 50_000


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """The key of a line (UTF-8, A-Z already in lower case); None if it is too short to count."""
    key = line.strip(_WHITE)
    if len(key) < min_chars or (not key.isascii() and len(key.decode()) < min_chars):
        return None
    return key


def keyed_lines(docs: DataFrame, key: str, text: str, min_chars: int) -> DataFrame:
    """``doc, same, pos, h1, h2``: the lines that may be dropped, by document and position."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, pos, digest = [], [], bytearray()

            def flush(batch=batch):
                halves = pa.Array.from_buffers(pa.int64(), 2 * len(at), [None, pa.py_buffer(bytes(digest))])
                rows = pa.array(at, pa.int32())
                out = [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(pos, pa.int32()),
                       halves.take(pa.array(range(0, 2 * len(at), 2), pa.int64())),
                       halves.take(pa.array(range(1, 2 * len(at), 2), pa.int64()))]
                at.clear(), pos.clear(), digest.clear()
                return pa.RecordBatch.from_arrays(out, names=["doc", "same", "pos", "h1", "h2"])

            for i, t in enumerate(batch.column(2)):
                for p, line in enumerate(t.as_py().encode().lower().split(b"\n")):
                    k = line_key(line, min_chars)
                    if k is not None:
                        at.append(i)
                        pos.append(p)
                        digest += xxhash.xxh3_128_digest(k)
                if len(at) >= _BATCH:
                    yield flush()
            if at:
                yield flush()

    usable = docs.filter(F.col(key).isNotNull() & F.col(text).isNotNull())
    return usable.select(F.col(key).alias("doc"), F.xxhash64(text).alias("same"), F.col(text).alias("text")).mapInArrow(
        run, f"doc {kind}, same bigint, pos int, h1 bigint, h2 bigint")


def _reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``n_lines, n_dropped, kept`` to ``row, text, gone`` and leaves out the last two."""
    for batch in batches:
        lines, dropped, kept = [], [], []
        for t, g in zip(batch.column(1), batch.column(2)):
            own = (t.as_py() or "").split("\n")
            gone = set(g.as_py() or ())
            lines.append(len(own))
            dropped.append(len(gone))
            kept.append("\n".join([x for i, x in enumerate(own) if i not in gone]) if gone else t.as_py() or "")
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.string())],
            names=["row", "n_lines", "n_dropped", "kept"])


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
          min_docs: int = MIN_DOCS) -> DataFrame:
    """``row`` (the input's other columns), ``n_lines``, ``n_dropped`` and ``kept``, the text without the dropped lines."""
    spark = docs.sparkSession
    at = unique_subdir(spark, "lines")
    keyed_lines(docs, key, text, min_chars).write.parquet(at)
    lines = spark.read.parquet(at)
    common = cut_lineage(lines.groupBy("h1", "h2").agg(F.countDistinct("doc").alias("n"), F.max("doc").alias("last")).filter(
        F.col("n") >= min_docs).select("h1", "h2", "last"))
    gone = lines.join(common, ["h1", "h2"]).filter("doc < last").groupBy("doc", "same").agg(
        F.collect_set("pos").alias("gone"))
    whole = docs.select(F.struct(*[F.col(c) for c in docs.columns if c != text]).alias("row"), F.col(text).alias("text"),
                        F.col(key).alias("doc"), F.xxhash64(text).alias("same"))
    met = whole.join(gone, ["doc", "same"], "left").select("row", "text", "gone")
    row = met.schema["row"].dataType.simpleString()
    return met.mapInArrow(_reassemble, f"row {row}, n_lines bigint, n_dropped bigint, kept string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of at least 20 characters that three documents hold stay in the last of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup(docs).select("row.doc_id", "n_lines", "n_dropped",
                              F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents),
l AS (SELECT r, doc_id, generate_subscripts(x, 1) AS p, unnest(x) AS line FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS last_id FROM k WHERE length(key) >= 20
      GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT r, k.doc_id, p, line, coalesce(k.doc_id < last_id, FALSE) AS gone FROM k LEFT JOIN c USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY r, doc_id
"""
