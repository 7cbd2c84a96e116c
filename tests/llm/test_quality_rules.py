"""Rules: measures against plain Python, order, laziness, native plan (the SQL oracle runs with the others)."""

import re

from pyspark.sql import functions as F

from netscope.llm import quality_rules as Q


def brute(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    covered = {i + j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(3)} if len(grams) < 3000 else None
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines),
            len(lines) - len(set(lines)), None if covered is None else len(covered))


def test_measures_equal_brute_force(make_docs, edge_rows):
    rows = [*edge_rows, (30, "a b c a b c a b c"), (31, "x x x x"), (32, "l1 a\nl1 a\n\n \nl1 a # <b>"), (33, "p q r p q")]
    got = make_docs(rows).select("doc_id", "text", Q.measures(F.col("text")).alias("m")).collect()
    assert len(got) == len(rows)
    for r in got:
        want = brute(r["text"])
        assert tuple(r["m"])[:5] == want[:5]
        if want[5] is not None:
            assert r["m"]["n_repeat_words"] == want[5]


def test_order_is_by_rejection_per_cost_and_never_changes_the_verdict(make_docs, edge_rows):
    docs = make_docs(edge_rows * 3)
    ranked = Q.order_rules(Q.sample_rows(docs))
    worth = [x["rejected"] / x["seconds"] for x in ranked]
    assert worth == sorted(worth, reverse=True) and {x["rule"] for x in ranked} == set(Q.RULES)
    names = list(Q.RULES)
    one = Q.apply_rules(docs, order=names).select("doc_id", "text", F.col("rejected_by").isNull().alias("k")).collect()
    two = Q.apply_rules(docs, order=names[::-1]).select("doc_id", "text", F.col("rejected_by").isNull().alias("k")).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "", r[2])
    assert sorted(one, key=key) == sorted(two, key=key)


def test_plan_is_native_and_rows_pass_through(make_docs, edge_rows):
    docs = make_docs(edge_rows)
    out = Q.apply_rules(docs, order=list(Q.RULES))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)
    assert out.columns == [*docs.columns, "rejected_by"] and out.count() == len(edge_rows)
    nulls = out.filter("text is null").select("rejected_by").collect()
    assert all(r[0] == "too_few_words" for r in nulls)


def test_known_measures_give_the_same_verdict(make_docs, edge_rows):
    docs = make_docs([*edge_rows, (40, "# " * 60), (41, "one line here\n" * 30), (42, "a b c d " * 20), (43, "word " * 9)])
    names = list(Q.RULES)[::-1]
    m = docs.withColumn("m", Q.measures(F.col("text"), {k: Q.MEASURES[k] for k in Q.BASE_MEASURES}))
    known = Q.apply_rules(m, order=names, known={k: F.col(f"m.{k}") for k in Q.BASE_MEASURES})
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "", r[2] or "")
    cols = ["doc_id", "text", "rejected_by"]
    assert sorted(known.select(cols).collect(), key=key) == sorted(Q.apply_rules(docs, order=names).select(cols).collect(), key=key)
    assert not re.search("Python|Pandas|Arrow|Exchange", known._jdf.queryExecution().executedPlan().toString())


def test_empty_table(make_docs):
    assert Q.apply_rules(make_docs([])).count() == 0
