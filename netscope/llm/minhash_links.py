"""MinHash near-dedup by an inverted join over signature coordinates.

A document's set holds its distinct word shingles (64-bit hashes); equal sets collapse to one class.
Each class posts under its (coordinate, value) pairs.  A pair of classes is a candidate if at least
``matches`` coordinates collide, and links if its full sets reach the similarity threshold.

Instead of merging all posting lists, the join follows the T-occurrence rule: of a class's postings,
ordered by list length, the ``matches - 1`` longest are skipped, since a pair with enough collisions
must also meet in one of the others.  Postings of one member vanish, and classes with too few
postings left (nearly all of a clean corpus) drop out before any set is looked at.  Classes in which
too many shingles occur nowhere else cannot reach the threshold and drop out too.

Only connected components are wanted, so a large family of near copies needs no all-pairs list.
First every class is compared with the most central class of each of its lists (a star per list).
What still lies in different components is then compared block against block: blocks have a bounded
number of classes, pairs inside one component are skipped, and only links leave the tasks.

With 32 coordinates and 14 matches a pair at the threshold of 0.8 is missed with probability 1.2e-6.

Null texts and texts without words have an empty set and link with nothing; rows with a null key
link with nothing and have a null component (``kept`` true); rows that repeat a key and text are one
document; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netscope.llm.common import hash_words, lists, lower_words, table
from netscope.llm.components import components
from netscope.session import cut_lineage

NAME = "op10_minhash_links"
COORDINATES, MATCHES = 32, 14
BLOCK = 512


def shingle_set(text: str | None, words: int = 4) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``words`` words; fewer words count as one run."""
    h = hash_words(lower_words(text))
    if not len(h):
        return h
    with np.errstate(over="ignore"):
        n = max(len(h) - words + 1, 1)
        out = np.full(n, min(len(h), words), np.uint64)
        for k in range(min(words, len(h))):
            out = (out ^ h[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
    return np.unique(out)


def _signature_multipliers(n: int) -> np.ndarray:
    return np.random.default_rng(20).integers(1, 2 ** 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(shingles: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """Least upper half of ``shingle * multiplier`` for each multiplier."""
    out = np.empty(len(multipliers), np.int32)
    with np.errstate(over="ignore"):
        mixed = shingles ^ (shingles >> np.uint64(32))
        for k, m in enumerate(multipliers):
            out[k] = int((mixed * m).min() >> np.uint64(32)) - 2 ** 31
    return out


def signatures(docs: DataFrame, key: str, text: str, words: int, coordinates: int) -> DataFrame:
    """``key, same, n, set_id, sig`` of every row (``same``: its text's hash; ``set_id`` and ``sig`` null for empty sets)."""
    kind = docs.schema[key].dataType.simpleString()
    mult = _signature_multipliers(coordinates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ids, sigs = [], [], []
            for t in batch.column(2):
                s = shingle_set(t.as_py(), words)
                sizes.append(len(s))
                ids.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                sigs.append(signature(s, mult).tolist() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()),
                 pa.array(sigs, pa.list_(pa.int32()))], names=["key", "same", "n", "set_id", "sig"])

    return docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("same"), F.col(text).alias("text")).mapInArrow(
        run, f"key {kind}, same bigint, n bigint, set_id binary, sig array<int>")


def full_sets(docs: DataFrame, wanted: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """``key, shingles`` of the classes in ``wanted`` (``key`` the class; ``of, set_id`` a row that holds its set)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), words) for t in batch.column(2)]
            # a document's key may also stand on rows with another text
            own = np.array([xxhash.xxh3_128_digest(s.tobytes()) == d.as_py() for s, d in zip(sets, batch.column(1))], bool)
            sets = [s.astype(np.int64) for s, m in zip(sets, own) if m]
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
            values = np.concatenate(sets) if sets else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(own)), lists(values, offsets)],
                                             names=["key", "shingles"])

    rows = docs.select(F.col(key).alias("of"), F.col(text).alias("text")).join(
        wanted.select("key", "of", "set_id"), "of").select("key", "set_id", "text")
    return rows.mapInArrow(run, "key bigint, shingles array<bigint>").dropDuplicates(["key"])


def _common_tokens(reps: DataFrame, matches: int) -> DataFrame:
    """``key, tokens`` of the classes with at least ``matches`` postings shared with another class;
    ``tokens`` are ``(length of the list, coordinate, value)``, shortest list first."""
    tokens = reps.select("key", F.posexplode("sig").alias("j", "v"))
    lengths = tokens.groupBy("j", "v").agg(F.count("*").alias("f")).filter("f > 1")
    return tokens.join(lengths, ["j", "v"]).groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("f", "j", "v"))).alias("tokens")).filter(
            F.size("tokens") >= matches)


def _prune(sets: DataFrame, percent: int) -> DataFrame:
    """Keys whose shingles shared with any other of these sets could still reach the threshold."""
    alone = sets.select("key", F.explode("shingles").alias("s")).groupBy("s").agg(
        F.count("*").alias("c"), F.min("key").alias("key")).filter("c = 1")
    unique = alone.groupBy("key").agg(F.count("*").alias("u"))
    return sets.join(unique, "key", "left").filter(
        100 * (F.size("shingles") - F.coalesce("u", F.lit(0))) >= percent * F.size("shingles")).drop("u")


def _same(a: F.Column, b: F.Column) -> F.Column:
    """Number of coordinates in which two signatures agree."""
    return F.size(F.filter(F.arrays_zip(a.alias("x"), b.alias("y")), lambda p: p["x"] == p["y"]))


def star_links(live: DataFrame, postings: DataFrame, percent: int, matches: int) -> DataFrame:
    """Links between the classes and the most central class of each of their posting lists."""
    hubs = postings.groupBy("j", "v").agg(F.max(F.struct("central", "key")).alias("hub"))
    pairs = postings.join(hubs, ["j", "v"]).select("key", F.col("hub.key").alias("hub")).filter(
        "key != hub").distinct()
    mine = live.select("key", "sig", "shingles")
    theirs = live.select(F.col("key").alias("hub"), F.col("sig").alias("hub_sig"),
                         F.col("shingles").alias("hub_shingles"))
    n, m = F.size("shingles"), F.size("hub_shingles")
    near = pairs.join(mine, "key").join(theirs, "hub").filter(
        (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (_same(F.col("sig"), F.col("hub_sig")) >= matches))
    common = near.withColumn("i", F.size(F.array_intersect("shingles", "hub_shingles")))
    return common.filter(100 * F.col("i") >= percent * (n + m - F.col("i"))).select(
        F.col("key").alias("a"), F.col("hub").alias("b"))


def block_links(one: pd.DataFrame, two: pd.DataFrame, same_block: bool, percent: int,
                matches: int) -> list[tuple]:
    """Links between classes of different components of two blocks.

    ``matches`` collisions make a candidate; its full sets decide.  Components joined here are not
    compared again.
    """
    left_sig, right_sig = np.stack(one["sig"].to_numpy()), np.stack(two["sig"].to_numpy())
    comp = {}
    def find(x):
        while comp.get(x, x) != x:
            x = comp[x]
        return x
    left_comp, right_comp = one["comp"].tolist(), two["comp"].tolist()
    left_n, right_n = one["shingles"].map(len).to_numpy(), two["shingles"].map(len).to_numpy()
    universe, local = np.unique(np.concatenate([*one["shingles"], *two["shingles"]]), return_inverse=True)
    cut = int(left_n.sum())
    left_at = np.concatenate([[0], np.cumsum(left_n)])
    right_at = np.concatenate([[0], np.cumsum(right_n)])
    left_ids, right_ids = local[:cut], local[cut:]
    mark = np.zeros(len(universe), bool)
    keys, other_keys, out = one["key"].tolist(), two["key"].tolist(), []
    for i in range(len(one)):
        lo, hi = np.minimum(right_n, left_n[i]), np.maximum(right_n, left_n[i])
        near = np.flatnonzero((100 * lo >= percent * hi) & ((right_sig == left_sig[i]).sum(1) >= matches))
        near = [k for k in near.tolist() if (not same_block or k > i) and find(right_comp[k]) != find(left_comp[i])]
        if not near:
            continue
        mine = left_ids[left_at[i]:left_at[i + 1]]
        mark[mine] = True
        for k in near:
            if find(right_comp[k]) == find(left_comp[i]):
                continue
            n = int(mark[right_ids[right_at[k]:right_at[k + 1]]].sum())
            if 100 * n >= percent * (left_n[i] + right_n[k] - n):
                out.append((keys[i], other_keys[k]))
                comp[find(right_comp[k])] = find(left_comp[i])
        mark[mine] = False
    return out


def cross_links(live: DataFrame, postings: DataFrame, roots: DataFrame, percent: int, matches: int) -> DataFrame:
    """Links between classes that share a posting list but not yet a component.

    Classes are dealt to blocks of about ``BLOCK`` by the hub they share; two blocks meet if a list
    with several components has members of both.
    """
    kind = live.schema["key"].dataType.simpleString()
    state = postings.join(roots.select(F.col("node").alias("key"), F.col("root")), "key", "left").withColumn(
        "comp", F.coalesce("root", "key")).drop("root")
    open_lists = state.groupBy("j", "v").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.max(F.struct("central", "key")).alias("hub")).filter(
            "lo != hi").select("j", "v", "hub")
    still = cut_lineage(state.join(open_lists, ["j", "v"]))
    family = still.groupBy("key", "comp").agg(F.max("hub").alias("hub"))
    sizes = family.groupBy("hub").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    place = cut_lineage(family.join(sizes, "hub").select(
        "key", "comp", F.xxhash64("hub", F.pmod(F.xxhash64("key"), F.col("parts"))).alias("block")))
    met = still.select("j", "v", "key").join(place.select("key", "block"), "key").select("j", "v", "block").distinct()
    combos = met.alias("p").join(met.alias("q"), ["j", "v"]).filter("p.block <= q.block").select(
        F.col("p.block").alias("x"), F.col("q.block").alias("y")).distinct()
    # two blocks that lie in one and the same component have nothing to compare
    span = place.groupBy("block").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    combos = combos.join(span.select(F.col("block").alias("x"), F.col("lo").alias("x_lo"), F.col("hi").alias("x_hi")),
                         "x").join(span.select(F.col("block").alias("y"), F.col("lo").alias("y_lo"),
                                               F.col("hi").alias("y_hi")), "y").filter(
        "least(x_lo, y_lo) != greatest(x_hi, y_hi)").select("x", "y")
    combos = cut_lineage(combos)
    sides = combos.select("x", "y", F.explode(F.when(F.col("x") == F.col("y"), F.array(F.lit(0))).otherwise(
        F.array(F.lit(0), F.lit(1)))).alias("side")).withColumn(
            "block", F.when(F.col("side") == 0, F.col("x")).otherwise(F.col("y")))
    rows = sides.join(place, "block").join(live.select("key", "sig", "shingles"), "key")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["side", "key"])
        one = pdf[pdf["side"] == 0].reset_index(drop=True)
        same = bool((pdf["x"] == pdf["y"]).all())
        two = one if same else pdf[pdf["side"] == 1].reset_index(drop=True)
        found = block_links(one, two, same, percent, matches) if len(one) and len(two) else []
        return pd.DataFrame({"a": [p[0] for p in found], "b": [p[1] for p in found]})

    return rows.groupBy("x", "y").applyInPandas(compare, f"a {kind}, b {kind}")


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 4, percent: int = 80,
            coordinates: int = COORDINATES, matches: int = MATCHES) -> DataFrame:
    """``key, n_shingles, component_id, kept, same`` of every row of ``docs`` (``same``: its text's hash)."""
    sigs = cut_lineage(signatures(docs, key, text, words, coordinates))
    # a class of equal sets is a node of its own: its smallest key may hold other texts too
    sets = cut_lineage(sigs.filter("set_id is not null and key is not null").groupBy("set_id").agg(
        F.min(F.struct("key", "sig")).alias("rep")).select("set_id", F.col("rep.key").alias("of"), "rep.sig"))
    sets = cut_lineage(sets.withColumn("key", F.monotonically_increasing_id()))
    maybe = _common_tokens(sets.select("key", "sig"), matches)
    maybe = cut_lineage(maybe.select("key").join(sets, "key"))
    live = cut_lineage(_prune(full_sets(docs, maybe, key, text, words), percent).join(maybe.select("key", "sig"), "key"))
    tokens = _common_tokens(live.select("key", "sig"), matches)
    central = F.aggregate("tokens", F.lit(0.0), lambda acc, t: acc + F.log(t["f"].cast("double")))
    postings = cut_lineage(tokens.select(
        "key", central.alias("central"),
        F.explode(F.slice("tokens", F.lit(1), F.size("tokens") - (matches - 1))).alias("t")).select(
            "key", "central", "t.j", "t.v"))
    links = cut_lineage(star_links(live, postings, percent, matches))
    roots = components(links)
    more = cut_lineage(cross_links(live, postings, roots, percent, matches))
    # the stars of the first components connect what their links connected
    roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))
    label = sets.select("set_id", "key", "of").join(roots, F.col("key") == F.col("node"), "left").select(
        "set_id", "of", F.coalesce("root", "key").alias("group"))
    smallest = label.groupBy("group").agg(F.min("of").alias("component"))
    label = label.join(smallest, "group").select("set_id", "component")
    out = sigs.select("key", "same", "n", "set_id").join(cut_lineage(label), "set_id", "left")
    component = F.when(F.col("key").isNotNull(), F.coalesce("component", "key"))
    return out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("key") == component, F.lit(True)).alias("kept"), "same")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of near copies over all documents: 4-word shingles, similarity 0.8."""
    return classes(table(spark, sf_dir, "documents")).drop("same")
