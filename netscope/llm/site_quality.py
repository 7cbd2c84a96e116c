"""Document quality with hierarchical empirical Bayes over sites.

Two targets are learned from labelled documents: low quality and toxic.  A document's own evidence is
a ridge logistic regression over the features (words, shape of the text) whose association with the
target is beyond chance, calibrated on labelled documents set aside.  Learning reads at most ``MAX_LABELLED``
labelled documents, chosen by a hash of the key and without repeated texts (documented parameter); their
keys are few enough to be broadcast, so no text is shuffled for it.

Site evidence comes from all documents: the calibrated probabilities are averaged per path and per
host in grouped aggregations (partial sums, so a host with a third of the rows is no problem).  The
spread between sites, beyond what their sizes explain, gives the strength of the priors: a path's rate
is shrunk towards its host's, a host's towards the global rate, sparse ones most.  A document's
posterior adds its path's log odds to its own evidence; its own probability is taken out of the path's, the
host's and the global sums first, so it counts once.

The host is the source's part before the first slash (without scheme), the path its next segment, or
the language where a source has none.  Null sources and languages are sites of their own; null and
blank texts have only shape features.  Without labels nothing is rejected.  Labels with nulls are left
out; a document labelled twice counts once.  Repeated rows are judged alike; other columns pass
through; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netscope.llm.common import WHITE, table
from netscope.session import cut_lineage

NAME = "op2_site_quality"
MAX_LABELLED = 20_000
MAX_FEATURES = 4_000
REJECT = 0.5
TARGETS = ("low", "toxic")
BROADCAST_SITES, SALTS = 100_000, 16
SYMBOLS = "#*$%&|<>"
_WORD = re.compile(r"[^\W\d_]+")


def features(text: str | None) -> set[str]:
    """Lower-case words, and bins of the text's shape (names with a ``~`` can't be words)."""
    text = text or ""
    out = set(_WORD.findall(text.lower()))
    words = text.split()
    n = max(len(words), 1)
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    symbols = sum(map(text.count, SYMBOLS)) / n
    again = sum([a == b for a, b in zip(words, words[1:])]) / n
    letters = max(sum(map(str.isalpha, text)), 1)
    out.add(f"~upper{min(8, math.ceil(sum(map(str.isupper, text)) * 16 / letters))}")
    out.add(f"~bangs{min(8, math.ceil((text.count('!') + text.count('?')) * 16 / n))}")
    out.add(f"~letters{int(8 * min(letters / max(len(text), 1), 1))}")
    out.add(f"~symbols{min(8, math.ceil(symbols * 16))}")
    out.add(f"~again{min(8, math.ceil(again * 16))}")
    out.add(f"~lines{min(4, math.ceil((len(lines) - len(set(lines))) * 8 / max(len(lines), 1)))}")
    out.add(f"~distinct{min(8, int(len(set(words)) * 16 / n))}")
    out.add(f"~size{min(6, len(words).bit_length())}")
    return out


@dataclass
class Evidence:
    """Weight per feature, and the calibration ``slope * sum + intercept`` to log odds."""

    weights: dict[str, float] = field(default_factory=dict)
    slope: float = 1.0
    intercept: float = 0.0

    def raw(self, found: set[str]) -> float:
        w = self.weights
        return math.fsum([w[f] for f in found & w.keys()])


@dataclass
class Model:
    evidence: dict[str, Evidence]
    rates: dict[str, float]

    def log_odds(self, text: str | None) -> list[float]:
        """Calibrated log odds of each target, the global rate included."""
        found = features(text)
        return [e.slope * e.raw(found) + e.intercept for e in self.evidence.values()]


def _platt(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a one-feature logistic regression, slightly ridged."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = p * (1 - p) + 1e-9
        g = np.array([((p - y) * x).sum() + 0.1 * (a - 1), (p - y).sum() + 0.01 * b])
        h = np.array([[(w * x * x).sum() + 0.1, (w * x).sum()], [(w * x).sum(), w.sum() + 0.01]])
        step = np.linalg.solve(h, g)
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(max(a, 0.05)), float(b)


def _ridge(rows: np.ndarray, cols: np.ndarray, y: np.ndarray, n: int, ridge: float = 0.3) -> np.ndarray:
    """Weights of a logistic regression on binary features, given as the places of the ones.

    Full-batch gradient steps with per-weight step sizes; the intercept is left to the calibration.
    """
    w, b, size, rate = np.zeros(n), math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)), np.full(n, 1e-8), 0.3
    for _ in range(300):
        z = b + np.bincount(rows, w[cols], len(y))
        r = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        g = np.bincount(cols, r[rows], n) + ridge * w
        size += g * g
        w -= rate * g / np.sqrt(size)
        b -= r.sum() / max(len(y) * 0.25, 1) * 0.5
    return w


def _matrix(learn: DataFrame, names: list[str], target: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the ones of the bounded sample's features, and the target."""
    place = {f: i for i, f in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(place[f] for f in features(t) & place.keys()) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32())), batch.column(1)], names=["x", "y"])

    got = learn.select("text", target).mapInArrow(run, "x array<int>, y boolean").toPandas()
    sizes = got["x"].map(len).to_numpy()
    cols = np.concatenate([*got["x"], np.zeros(0)]).astype(np.int64)
    return np.repeat(np.arange(len(got)), sizes), cols, got["y"].to_numpy(float)


def labelled(docs: DataFrame, labels: DataFrame, key: str, text: str, max_rows: int) -> DataFrame:
    """``text, low, toxic, fold`` of a bounded sample of labelled documents, without repeated texts."""
    known = labels.select(F.col(key).alias("key"), (F.col("quality") == 0).alias("low"),
                          (F.col("toxic") == 1).alias("toxic")).dropna().dropDuplicates(["key"])
    total = known.count()
    hashed = F.shiftright(F.xxhash64("key", F.lit(11)), 1)
    bound = min(1.0, max_rows / max(total, 1)) * 2.0 ** 62
    picked = known.filter(F.abs(hashed) <= bound).withColumn("fold", F.pmod(hashed, F.lit(5)))
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(
        F.broadcast(picked), "key")  # about max_rows rows at most
    return cut_lineage(rows.dropDuplicates(["text"]).select("text", "low", "toxic", "fold"))


def fit(sample: DataFrame) -> Model:
    """Feature weights from folds 1 to 4, calibration from fold 0."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, hits = Counter(), {t: Counter() for t in TARGETS}
        for batch in batches:
            for t, *marks in zip(*(c.to_pylist() for c in batch.columns)):
                found = features(t)
                n.update(found)
                for name, mark in zip(TARGETS, marks):
                    if mark:
                        hits[name].update(found)
        names = list(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([n[f] for f in names], pa.int64()),
             *[pa.array([hits[t][f] for f in names], pa.int64()) for t in TARGETS]], names=["f", "n", *TARGETS])

    learn = sample.filter("fold > 0")
    sizes = learn.agg(F.count("*"), *[F.count_if(F.col(t)) for t in TARGETS]).first()
    counted = learn.select("text", *TARGETS).mapInArrow(
        count, "f string, n bigint, low bigint, toxic bigint").groupBy("f").agg(
            *[F.sum(c).alias(c) for c in ("n", *TARGETS)]).filter("n >= 3")
    kinds = counted.count()
    total = int(sizes[0])
    model = Model({}, {})
    for t, hits in zip(TARGETS, sizes[1:]):
        hits = int(hits)
        model.rates[t] = (hits + 0.5) / (total + 1.0)
        model.evidence[t] = Evidence(intercept=0.0)
        if not hits or hits == total:
            continue
        rate, n1, n = hits / total, F.col(t).cast("double"), F.col("n").cast("double")

        def part(x: Column, expected: Column) -> Column:
            return F.when(x > 0, x * F.log(x / expected)).otherwise(0.0)
        out1, out0 = F.lit(float(hits)) - n1, F.lit(float(total - hits)) - (n - n1)
        rest = F.lit(float(total)) - n
        g = 2 * (part(n1, n * rate) + part(n - n1, n * (1 - rate)) + part(out1, rest * rate) + part(out0, rest * (1 - rate)))
        chance = 2 * math.log(max(kinds, 2))  # what the largest of so many statistics reaches by chance
        names = [r[0] for r in counted.select("f", g.alias("g")).filter(F.col("g") > chance).orderBy(
            F.desc("g"), "f").limit(MAX_FEATURES).collect()]
        x = _matrix(learn, names, t)
        model.evidence[t].weights = dict(zip(names, _ridge(*x, len(names)).tolist()))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], *[pa.array([e.raw(f) for f in found], pa.float64()) for e in model.evidence.values()]],
                names=[*TARGETS, *[f"x_{t}" for t in TARGETS]])

    held = sample.filter("fold = 0").select("text", *TARGETS).mapInArrow(
        score, "low boolean, toxic boolean, x_low double, x_toxic double").toPandas()  # a fifth of the sample
    for t in TARGETS:
        e, prior = model.evidence[t], math.log(model.rates[t] / (1 - model.rates[t]))
        y = held[t].to_numpy(float) if len(held) else np.zeros(0)
        if len(y) and 0 < y.sum() < len(y):
            e.slope, e.intercept = _platt(held[f"x_{t}"].to_numpy(float), y)
        else:
            e.intercept = min(prior, 0.0) if total else -1.0
    return model


def site(source: Column, lang: Column) -> tuple[Column, Column]:
    """Host and path of a document."""
    plain = F.regexp_replace(F.lower(F.coalesce(source, F.lit(""))), r"^[a-z][a-z0-9+.-]*://", "")
    host = F.substring_index(plain, "/", 1)
    segment = F.regexp_extract(plain, r"^[^/]*/([^/?#]*)", 1)
    return host, F.when(segment != "", segment).otherwise(F.coalesce(lang, F.lit("")))


def _strength(sites: DataFrame, hits: str, n: str, mean: Column) -> float:
    """Prior strength (in documents) from the spread of rates between sites: method of moments."""
    rate = F.col(hits) / F.col(n)
    row = sites.filter(F.col(n) >= 2).agg(
        F.sum(F.col(n) * (rate - mean) ** 2), F.sum(mean * (1 - mean)), F.sum(n), F.sum(F.col(n) * mean * (1 - mean))).first()
    if not row[2]:
        return 100.0
    spread, noise, mid = float(row[0]) / float(row[2]), float(row[1]) / float(row[2]), float(row[3]) / float(row[2])
    between = max(spread - noise, 1e-6)
    return float(min(max(mid / between - 1, 5.0), 1000.0))


def posteriors(scored: DataFrame, rates: dict[str, float]) -> DataFrame:
    """``host, path`` and, per target, the shrunk rates ``top_<t>``, ``host_<t>`` and ``path_<t>``, with what
    ``without_own`` needs: documents ``n`` and ``hn``, probability sums ``s_<t>``, ``h_<t>`` and ``a_<t>``
    (of path, host and all ``an`` documents), prior strengths ``kp_<t>`` and ``kh_<t>``.

    ``scored`` has host, path and the probability ``p_<t>`` of every document.
    """
    paths = cut_lineage(scored.groupBy("host", "path").agg(
        F.count("*").alias("n"), *[F.sum(f"p_{t}").alias(f"s_{t}") for t in TARGETS]))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), *[F.sum(f"s_{t}").alias(f"h_{t}") for t in TARGETS])
    total = hosts.agg(F.sum("hn"), *[F.sum(f"h_{t}") for t in TARGETS]).first()
    hosts = hosts.withColumn("an", F.lit(float(total[0] or 0)))
    for i, t in enumerate(TARGETS):
        top = (float(total[i + 1] or 0) + rates[t]) / (float(total[0] or 0) + 1)
        k = _strength(hosts, f"h_{t}", "hn", F.lit(top))
        hosts = hosts.withColumns({f"host_{t}": (F.col(f"h_{t}") + k * top) / (F.col("hn") + k), f"top_{t}": F.lit(top),
                                   f"kh_{t}": F.lit(k), f"a_{t}": F.lit(float(total[i + 1] or 0))})
    out = cut_lineage(paths.join(hosts, "host"))
    for t in TARGETS:
        k = _strength(out, f"s_{t}", "n", F.col(f"host_{t}"))
        out = out.withColumns({f"path_{t}": (F.col(f"s_{t}") + k * F.col(f"host_{t}")) / (F.col("n") + k), f"kp_{t}": F.lit(k)})
    return cut_lineage(out)


def without_own(t: str, p: Column, rate: float) -> tuple[Column, Column]:
    """Global and path rate as the other documents give them; ``p`` is the document's own probability."""
    at = lambda x: F.col(f"{x}_{t}")
    top = (F.greatest(at("a") - p, F.lit(0.0)) + rate) / F.col("an")
    host = (F.greatest(at("h") - p, F.lit(0.0)) + at("kh") * top) / (F.col("hn") - 1 + at("kh"))
    return top, (F.greatest(at("s") - p, F.lit(0.0)) + at("kp") * host) / (F.col("n") - 1 + at("kp"))


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
             lang: str = "lang", max_labelled: int = MAX_LABELLED, keep: list[str] | None = None) -> DataFrame:
    """``row`` (the document as it came), the site's ``host_<t>`` and ``path_<t>`` and the document's
    ``p_<t>`` for both targets.

    ``keep`` names the columns of ``row`` where not all are wanted: evidence is then computed once and written
    beside them.  Whole rows (None) have theirs computed twice, which is less than writing every text once more.
    """
    model = fit(labelled(docs, labels, key, text, max_labelled))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    host, path = site(F.col(source), F.col(lang))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("row"), F.col(text).alias("text"),
                       host.alias("host"), path.alias("path"))

    def odds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.array([shared.value.log_odds(t) for t in batch.column(0).to_pylist()]).reshape(-1, len(TARGETS))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *[pa.array(x) for x in np.clip(own, -30, 30).T]],
                                             names=[*batch.schema.names[1:], *[f"o_{t}" for t in TARGETS]])

    told = "host string, path string, " + ", ".join(f"o_{t} double" for t in TARGETS)
    scored = rows.select("text", "row", "host", "path").mapInArrow(odds, f"row {rows.schema['row'].dataType.simpleString()}, {told}")
    if keep:
        scored = small = cut_lineage(scored)
    else:
        small = rows.select("text", "host", "path").mapInArrow(odds, told)
    p = {t: 1 / (1 + F.exp(-F.col(f"o_{t}"))) for t in TARGETS}
    sites = posteriors(small.select("host", "path", *[p[t].alias(f"p_{t}") for t in TARGETS]), model.rates)
    if sites.count() <= BROADCAST_SITES:
        joined = scored.join(F.broadcast(sites), ["host", "path"])  # bounded by the check
    else:
        # more sites: by shuffle, a hot site's documents dealt over SALTS tasks
        salt = F.pmod(F.xxhash64(*[f"o_{t}" for t in TARGETS]), F.lit(SALTS)).cast("int")
        each = sites.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = scored.withColumn("salt", salt).join(each, ["host", "path", "salt"])
    kept = [f"{x}_{t}" for t in TARGETS for x in ("host", "path")]

    def posterior(t: str) -> Column:
        logit = lambda x: F.log(x / (1 - x))
        top, rest = (F.greatest(F.least(x, F.lit(1 - 1e-6)), F.lit(1e-6)) for x in without_own(t, p[t], model.rates[t]))
        return (1 / (1 + F.exp(-(F.col(f"o_{t}") + logit(rest) - logit(top))))).alias(f"p_{t}")

    return joined.select("row", *kept, *[posterior(t) for t in TARGETS])


def accepted(judged: DataFrame) -> Column:
    """Whether a classified document stays."""
    return (F.col("p_low") <= REJECT) & (F.col("p_toxic") <= REJECT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities and verdict of every document."""
    judged = classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), keep=["doc_id"])
    return judged.select(F.col("row.doc_id").alias("doc_id"), (1 - F.col("p_low")).alias("p_quality"), "p_toxic",
                         (1 - F.col("host_low")).alias("host_quality"), (1 - F.col("path_low")).alias("path_quality"),
                         F.col("host_toxic"), F.col("path_toxic"), accepted(judged).alias("kept"))
