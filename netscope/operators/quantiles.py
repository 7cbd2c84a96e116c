"""Exact quantiles with bounded memory per group.

Spark's exact ``percentile`` merges one value histogram per group in a single
task; for a group holding a third of a very large table that histogram does
not fit.  This operator gets the same exact, linearly interpolated result
(numpy's default, DuckDB's ``quantile_cont``):

0. the rows of each distinct value are counted; groups of at most ``MAX_EXACT`` distinct values -- their histogram
   is bounded by that constant -- use Spark's exact ``percentile`` over the counts; for larger ones:
1. a mergeable sketch (``percentile_approx``, rank error <= n / accuracy) gives
   per group and probability a value bracket ``[lo, hi]`` around the target rank;
2. one scan counts the rows below ``lo`` exactly (algebraic, partially
   aggregated) and counts the distinct values inside the bracket;
3. while a bracket holds more than ``WINDOW`` distinct values, it is cut at 512
   of them, the rows of each part are counted, and the parts that hold the
   target ranks stay;
4. the value at the target rank is read off the sorted bracket.

Everything is DataFrame operations; the state that meets in one task is at most
``WINDOW`` values per (group, probability).

Columns of a whole table (no group keys) take the wide way, ``wide_quantiles``: every scan
handles all columns and probabilities in one aggregate row, at any size alike.  Nothing
is exploded, shuffled or materialised; brackets are numbers on the driver, two for each
column and probability.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from netscope.session import cut_lineage

MAX_EXACT, ACCURACY = 1_000_000, 100_000
WINDOW, PARTS = 20_000, 512


def exact_quantiles(df: DataFrame, keys: Sequence[str], col: str, probs: Sequence[float],
                    names: Sequence[str] | None = None, accuracy: int | None = None,
                    max_exact: int | None = None) -> DataFrame:
    """One row per group: ``keys..., _n, <name_i>`` with the exact interpolated quantile
    ``probs[i]`` of ``col`` (NULL for groups without values).

    Groups of at most ``max_exact`` distinct values use Spark's exact ``percentile`` over their
    counted values (the histogram is bounded by that constant); larger groups -- at most
    rows / max_exact of them -- use the narrowed bracket described above."""
    keys = list(keys)
    accuracy, max_exact = accuracy or ACCURACY, max_exact or MAX_EXACT
    if not keys:
        return exact_quantiles_long(df, [col], probs, names).drop("column")
    if max_exact < accuracy:
        raise ValueError("max_exact must be >= accuracy (the bracket needs n > accuracy)")
    probs = [float(q) for q in probs]
    names = list(names) if names else [f"q{i}" for i in range(len(probs))]
    m = len(probs)
    rows = df.select(*keys, F.col(col).cast("double").alias("_x"))
    # counted where they are read: repeated values cost one row a task from here on
    counted = cut_lineage(rows.groupBy(*keys, "_x").agg(F.count("_x").alias("_c")))
    sizes = counted.groupBy(*keys).agg(F.sum("_c").alias("_n"), F.count("_x").alias("_kinds"))
    cnt = sizes.drop("_kinds")
    small = counted.join(sizes.where(F.col("_kinds") <= max_exact).select(*keys), keys, "left_semi")
    found = small.groupBy(*keys).agg(F.percentile("_x", F.array(*[F.lit(p) for p in probs]), F.col("_c")).alias("_q")).select(
        *keys, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])
    large = sizes.where(F.col("_kinds") > max_exact).drop("_kinds")
    if not large.isEmpty():
        # read by several branches: materialised once in the shared checkpoint folder
        found = found.unionByName(_bracket_quantiles(cut_lineage(rows).join(large, keys), keys, probs, names, accuracy))
    return cnt.join(found, keys, "left")


def for_join(groups: DataFrame, most: int = 100_000) -> DataFrame:
    """Figures of groups, computed once; up to ``most`` rows of them are broadcast to the rows that they join, so
    that few large groups don't meet in few tasks."""
    groups = cut_lineage(groups)
    return F.broadcast(groups) if groups.count() <= most else groups


def _bracket_quantiles(j: DataFrame, keys: list[str], probs: list[float], names: list[str],
                       accuracy: int) -> DataFrame:
    """Exact quantiles for groups with more than ``accuracy`` values; ``j`` holds
    ``keys, _x, _n`` (``_n`` = non-null count of the row's group)."""
    m = len(probs)
    delta = 3.0 / accuracy
    bounds = [max(0.0, q - delta) for q in probs] + [min(1.0, q + delta) for q in probs]
    # the bracket has a rank margin (>= 2 n / accuracy) larger than the sketch's rank
    # error, so it holds the floor and ceil target ranks
    sk = j.groupBy(*keys, "_n").agg(F.percentile_approx("_x", bounds, accuracy).alias("_b"))
    jj = j.where(F.col("_x").isNotNull()).drop("_n").join(sk, keys)  # one sketch row per big group
    below = jj.groupBy(*keys).agg(*[F.sum(F.when(F.col("_x") < F.col("_b")[i], 1).otherwise(0)).cast("bigint")
                                    .alias(f"_below{i}") for i in range(m)])
    inside = F.filter(F.sequence(F.lit(0), F.lit(m - 1)),
                      lambda i: (F.col("_x") >= F.col("_b")[i]) & (F.col("_x") <= F.col("_b")[i + m]))
    counted = cut_lineage(jj.select(*keys, "_x", F.explode(inside).alias("_qi")).groupBy(*keys, "_qi", "_x").agg(
        F.count(F.lit(1)).alias("_c")))
    # per (group, probability): rows below the bracket, and the position wanted among all rows
    qi = F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    state = below.join(sk.select(*keys, "_n"), keys).withColumn("_qi", qi)
    q = F.element_at(F.array(*[F.lit(p) for p in probs]), F.col("_qi") + 1)
    state = cut_lineage(state.select(
        *keys, "_qi", (q * (F.col("_n") - 1)).alias("_pos"),
        F.element_at(F.array(*[F.col(f"_below{i}") for i in range(m)]), F.col("_qi") + 1).alias("_below")))
    while (counted.groupBy(*keys, "_qi").count().agg(F.max("count")).first()[0] or 0) > WINDOW:
        counted, state = _narrow(counted, state, keys)
    t = counted.groupBy(*keys, "_qi").agg(F.sort_array(F.collect_list(F.struct("_x", "_c"))).alias("_w")).join(
        state, [*keys, "_qi"])
    pos = F.col("_pos")
    r_lo = F.floor(pos) - F.col("_below")
    r_hi = F.ceil(pos) - F.col("_below")
    # walk the sorted bracket once: values at relative ranks r_lo and r_hi
    init = F.struct(F.lit(0).cast("bigint").alias("acc"), F.lit(None).cast("double").alias("vlo"),
                    F.lit(None).cast("double").alias("vhi"))

    def step(s, e):
        nxt = s["acc"] + e["_c"]
        return F.struct(nxt.alias("acc"),
                        F.when(s["vlo"].isNull() & (nxt > r_lo), e["_x"]).otherwise(s["vlo"]).alias("vlo"),
                        F.when(s["vhi"].isNull() & (nxt > r_hi), e["_x"]).otherwise(s["vhi"]).alias("vhi"))

    walked = t.select(*keys, "_qi", pos.alias("_pos"), F.aggregate("_w", init, step).alias("_s"),
                      r_lo.alias("_rlo"))
    vlo, vhi = F.col("_s.vlo"), F.col("_s.vhi")
    p, fl, ce = F.col("_pos"), F.floor(F.col("_pos")), F.ceil(F.col("_pos"))
    # same interpolation arithmetic as Spark's exact percentile
    val = F.when((ce == fl) | (vlo == vhi), vlo).otherwise((ce - p) * vlo + (p - fl) * vhi)
    # a bracket that does not contain the target ranks would break the sketch's
    # guarantee: surface it as an error instead of a wrong number
    ok = (F.col("_rlo") >= 0) & vhi.isNotNull()
    val = F.when(ok, val).otherwise(F.raise_error(F.lit("quantile bracket missed the target rank")))
    vals = walked.select(*keys, "_qi", val.alias("_v"))
    wide = vals.groupBy(*keys).pivot("_qi", list(range(m))).agg(F.first("_v"))
    return wide.select(*keys, *[F.col(f"`{i}`").cast("double").alias(n) for i, n in enumerate(names)])


def _narrow(counted: DataFrame, state: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Cuts each bracket at ``PARTS`` of its distinct values and keeps the parts with the target ranks."""
    by = [*keys, "_qi"]
    edges = counted.groupBy(*by).agg(F.percentile_approx("_x", [i / PARTS for i in range(1, PARTS)], 10_000).alias("_e"))
    part = F.size(F.filter("_e", lambda e: e < F.col("_x")))
    placed = counted.join(edges, by).select(*by, "_x", "_c", part.alias("_part"))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # PARTS rows at most
    sums = placed.groupBy(*by, "_part").agg(F.sum("_c").alias("_s")).withColumn(
        "_from", F.coalesce(F.sum("_s").over(before), F.lit(0)))
    kept = sums.join(state, by).filter(
        (F.col("_from") <= F.ceil("_pos") - F.col("_below"))
        & (F.col("_from") + F.col("_s") > F.floor("_pos") - F.col("_below")))
    kept = cut_lineage(kept.select(*by, "_part", "_from", "_pos", "_below"))
    smaller = cut_lineage(placed.join(kept.select(*by, "_part"), [*by, "_part"]).select(*by, "_x", "_c"))
    return smaller, cut_lineage(kept.groupBy(*by).agg(
        F.first("_pos").alias("_pos"), (F.first("_below") + F.min("_from")).alias("_below")))


def wide_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], accuracy: int | None = None,
                   window: int | None = None) -> dict[str, tuple[int, list[float | None]]]:
    """``{column: (values, [quantile per probability])}``, exact and linearly interpolated.

    1. One scan counts the values of all columns, about how many are distinct, and finds their range: the first
       bracket of every rank that is looked for.
    2. While a bracket has more than ``window`` distinct values, a scan sketches its inside around the rank
       (rank error inside / accuracy) and another counts the rows below the narrower bracket, at its two ends and
       between them.  A rank that falls on an end is found; else the ends go, so each turn leaves less.
    3. One scan reads the other ranks off their brackets (``percentile_disc``, whose state is the distinct values
       inside).
    """
    accuracy, window, cols = accuracy or ACCURACY, window or WINDOW, list(cols)
    x = {c: f"CAST(`{c}` AS DOUBLE)" for c in cols}
    lit = lambda v: f"{v!r}D" if math.isfinite(v) else f"double('{v}')"

    def scan(exprs: dict[str, str]) -> dict:
        return df.selectExpr(*[f"{e} AS `{n}`" for n, e in exprs.items()]).first().asDict() if exprs else {}

    first = scan({f"{w}{i}": f"{f}({x[c]})" for i, c in enumerate(cols) for w, f in (
        ("n", "count"), ("kinds", "approx_count_distinct"), ("lo", "min"), ("hi", "max"))})
    n = {c: first[f"n{i}"] for i, c in enumerate(cols)}
    wanted = {c: [(f(p), p) for p in (float(p) * (n[c] - 1) for p in probs) for f in (math.floor, math.ceil)] for c in cols if n[c]}
    # by column and rank: rows below the bracket, rows and distinct values inside, the condition of being inside
    open_ = {(c, r): (0, n[c], first[f"kinds{cols.index(c)}"], f"{x[c]} IS NOT NULL") for c, ranks in wanted.items() for r, _ in ranks}
    value, ready = {}, {}
    while open_:
        bounds = {}
        for (c, r), (below, m, kinds, inside) in open_.items():
            k = r - below
            if not 0 <= k < m:
                raise ValueError("quantile bracket missed the rank")
            if kinds <= window:
                ready[c, r] = (k, m, inside)
            else:
                delta = 3.0 / accuracy + 2.0 / m
                bounds[c, r] = (inside, max(0.0, k / m - delta), min(1.0, (k + 1) / m + delta))
        keys = list(bounds)
        sketch = scan({f"b{i}": f"percentile_approx(CASE WHEN {bounds[k][0]} THEN {x[k[0]]} END, array({bounds[k][1]!r}D, "
                                f"{bounds[k][2]!r}D), {accuracy})" for i, k in enumerate(keys)})
        between = {k: f"{x[k[0]]} > {lit(sketch[f'b{i}'][0])} AND {x[k[0]]} < {lit(sketch[f'b{i}'][1])}" for i, k in enumerate(keys)}
        counts = scan({f"{w}{i}": e for i, k in enumerate(keys) for v, (lo, hi) in ((x[k[0]], sketch[f"b{i}"]),) for w, e in (
            ("below", f"count_if({v} < {lit(lo)})"), ("low", f"count_if({v} = {lit(lo)})"), ("in", f"count_if({between[k]})"),
            ("kinds", f"approx_count_distinct(CASE WHEN {between[k]} THEN {v} END)"))})
        open_ = {}
        for i, (c, r) in enumerate(keys):
            below, low, m = (counts[f"{w}{i}"] for w in ("below", "low", "in"))
            if below <= r < below + low:
                value[c, r] = sketch[f"b{i}"][0]
            elif r >= below + low + m:
                value[c, r] = sketch[f"b{i}"][1]
            else:
                open_[c, r] = (below + low, m, counts[f"kinds{i}"], between[c, r])
    keys = list(ready)
    found = scan({f"v{i}": f"percentile_disc({(ready[k][0] + 0.5) / ready[k][1]!r}D) WITHIN GROUP (ORDER BY CASE WHEN "
                           f"{ready[k][2]} THEN {x[k[0]]} END)" for i, k in enumerate(keys)})
    value.update({k: found[f"v{i}"] for i, k in enumerate(keys)})
    out = {c: (n[c], [None] * len(probs)) for c in cols}
    for c, ranks in wanted.items():
        for j in range(len(probs)):
            (fl, pos), (ce, _) = ranks[2 * j:2 * j + 2]
            lo, hi = value[c, fl], value[c, ce]
            # same interpolation arithmetic as Spark's exact percentile
            out[c][1][j] = lo if ce == fl or lo == hi else (ce - pos) * lo + (pos - fl) * hi
    return out


def exact_quantiles_long(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                         names: Sequence[str] | None = None) -> DataFrame:
    """Several columns of a whole table at once.  Rows: ``column, _n, <names>``, one per column."""
    names = list(names) if names else [f"q{i}" for i in range(len(probs))]
    found = wide_quantiles(df, list(cols), probs)
    schema = "column string, _n bigint, " + ", ".join(f"`{n}` double" for n in names)
    return df.sparkSession.createDataFrame([(c, k, *q) for c, (k, q) in found.items()], schema)


def quantile_columns(df: DataFrame, keys: Sequence[str], col: str, probs: Sequence[float],
                     names: Sequence[str], method: str = "bounded", accuracy: int | None = None) -> DataFrame:
    """Per group quantiles by method: ``bounded`` (exact, bounded memory, default),
    ``spark`` (exact single-pass ``percentile``: one group histogram per task) or
    ``approx`` (sketch only).  Rows: ``keys..., <names>``."""
    keys = list(keys)
    if method == "bounded":
        return exact_quantiles(df, keys, col, probs, names, accuracy).drop("_n")
    x = F.col(col)
    q = (F.percentile_approx(x, list(probs), accuracy or ACCURACY) if method == "approx"
         else F.percentile(x, F.array(*[F.lit(float(p)) for p in probs])))
    g = df.groupBy(*keys).agg(q.alias("_q")) if keys else df.agg(q.alias("_q"))
    return g.select(*keys, *[F.col("_q")[i].cast("double").alias(n) for i, n in enumerate(names)])
