"""Classifier: planted toxic words and junk, shrinkage, edge cases."""

import math
import random
from collections import defaultdict

from pyspark.sql import functions as F

from conftest import SF_MID
from netscope.llm import site_quality as Q


def test_labelled_documents(spark):
    """Toxic and poor documents are mostly caught, clean ones stay (a tenth of the rows of the check data)."""
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    rows = Q.query(spark, SF_MID).join(labels, "doc_id").collect()
    clean = [r for r in rows if r["quality"] == 1 and r["toxic"] == 0]
    assert sum(r["kept"] for r in clean) >= 0.98 * len(clean)
    poor = [r for r in rows if r["quality"] == 0]
    assert sum(not r["kept"] for r in poor) >= 0.95 * len(poor)
    toxic = [r for r in rows if r["toxic"] == 1]
    assert sum(not r["kept"] for r in toxic) >= 0.75 * len(toxic)


def test_edge_cases(spark, make_docs, edge_rows):
    docs = make_docs(edge_rows)
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (6, 0, 0), (9, None, 1), (None, 1, 0), (11, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    judged = Q.classify(docs, labels)
    rows = judged.select("row.*", F.col("p_low").alias("p1"), F.col("p_toxic").alias("p2")).collect()
    assert len(rows) == len(edge_rows) and judged.schema["row"].dataType.names == docs.columns
    assert all(0 <= r["p1"] <= 1 and 0 <= r["p2"] <= 1 for r in rows)
    none = Q.classify(docs, labels.limit(0))
    assert none.filter(Q.accepted(none)).count() == len(edge_rows)
    assert Q.classify(make_docs([]), labels).count() == 0


def test_sparse_sites_shrink_to_their_host(spark):
    """A path with one document stays near its host's rate; one with many goes its own way."""
    rng = random.Random(3)
    rows = [(f"h{h}", "p", 0.9 if rng.random() < (0.8 if h < 3 else 0.05) else 0.1, 0.1) for h in range(12) for _ in range(200)]
    rows += [("h0", "rare", 0.1, 0.1), ("new", "x", 0.9, 0.1)]
    scored = spark.createDataFrame(rows, "host string, path string, p_low double, p_toxic double")
    got = {(r["host"], r["path"]): r for r in Q.posteriors(scored, {"low": 0.3, "toxic": 0.1}).collect()}
    assert got["h0", "p"]["path_low"] > 0.6 > 0.3 > got["h5", "p"]["path_low"]
    assert abs(got["h0", "rare"]["path_low"] - got["h0", "rare"]["host_low"]) < 0.15
    top = got["new", "x"]["top_low"]
    assert abs(got["new", "x"]["path_low"] - top) < abs(0.9 - top)


def test_site_of_urls_and_plain_sources(spark):
    rows = [("https://A.org/news/1?x", "en"), ("a.org/", "fr"), ("src1", "de"), (None, None)]
    host, path = Q.site(F.col("s"), F.col("l"))
    got = [tuple(r) for r in spark.createDataFrame(rows, "s string, l string").select(host, path).collect()]
    assert got == [("a.org", "news"), ("a.org", "fr"), ("src1", "de"), ("", "")]


def brute(docs, odds, rates):
    """Posteriors of (host, path) rows, each document's own probability left out of its site."""
    def strength(sites, mean):
        seen = [(s, n, m) for (s, n), m in zip(sites, mean) if n >= 2]
        total = sum(n for _, n, _ in seen)
        if not total:
            return 100.0
        spread = sum(n * (s / n - m) ** 2 for s, n, m in seen) / total
        noise, mid = sum(m * (1 - m) for *_, m in seen) / total, sum(n * m * (1 - m) for _, n, m in seen) / total
        return min(max(mid / max(spread - noise, 1e-6) - 1, 5.0), 1000.0)

    p = [1 / (1 + math.exp(-o)) for o in odds]
    hosts, paths = defaultdict(lambda: [0.0, 0]), defaultdict(lambda: [0.0, 0])
    for (h, q), x in zip(docs, p):
        for site in (hosts[h], paths[h, q]):
            site[0] += x
            site[1] += 1
    top = (sum(p) + rates) / (len(p) + 1)
    kh = strength(hosts.values(), [top] * len(hosts))
    rate = {h: (s + kh * top) / (n + kh) for h, (s, n) in hosts.items()}
    kp = strength(paths.values(), [rate[h] for h, _ in paths])
    out = []
    for (h, q), x, o in zip(docs, p, odds):
        all_ = (sum(p) - x + rates) / len(p)
        host = (hosts[h][0] - x + kh * all_) / (hosts[h][1] - 1 + kh)
        own = (paths[h, q][0] - x + kp * host) / (paths[h, q][1] - 1 + kp)
        a, b = (min(max(v, 1e-6), 1 - 1e-6) for v in (own, all_))
        out.append(1 / (1 + math.exp(-(o + math.log(a / (1 - a)) - math.log(b / (1 - b))))))
    return out


def test_equals_brute_force(spark, monkeypatch):
    """Both targets of the smallest tables, by broadcast and by the salted join, with whole and with few columns."""
    docs, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.filter("doc_id < 1500").cache()
    model = Q.fit(Q.labelled(docs, labels, "doc_id", "text", Q.MAX_LABELLED))
    rows = docs.select("doc_id", "text", *[c.alias(n) for c, n in zip(Q.site(F.col("source"), F.col("lang")), ("h", "q"))]).collect()
    odds = [[min(max(o, -30), 30) for o in model.log_odds(r["text"])] for r in rows]
    want = {t: brute([(r["h"], r["q"]) for r in rows], [o[i] for o in odds], model.rates[t]) for i, t in enumerate(Q.TARGETS)}
    for sites, keep in ((Q.BROADCAST_SITES, None), (0, ["doc_id"])):
        monkeypatch.setattr(Q, "BROADCAST_SITES", sites)
        got = {r["doc_id"]: r for r in Q.classify(docs, labels, keep=keep).select("row.doc_id", "p_low", "p_toxic").collect()}
        assert len(got) == len(rows)
        for t in Q.TARGETS:
            assert all(abs(got[r["doc_id"]][f"p_{t}"] - x) < 1e-7 for r, x in zip(rows, want[t]))


def test_a_lone_document_counts_once(spark, make_docs):
    """The only document of the only site: its posterior is its own evidence."""
    docs = make_docs([(1, "buy now buy now !!!")])
    labels = spark.createDataFrame([(9, 1, 0)], "doc_id long, quality int, toxic int")
    row = Q.classify(docs, labels).first()
    model = Q.fit(Q.labelled(docs, labels, "doc_id", "text", 10))
    for p, o in zip((row["p_low"], row["p_toxic"]), model.log_odds("buy now buy now !!!")):
        assert abs(p - 1 / (1 + math.exp(-o))) < 1e-9
