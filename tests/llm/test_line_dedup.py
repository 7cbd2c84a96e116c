"""Line dedup against brute force; repeated keys, edge cases, plan (the SQL oracle runs with the others)."""

import collections
import random

from netscope.llm import line_dedup as L

WHITE = " \t\n\x0b\x0c\r"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_chars=20, min_docs=3):
    """(doc_id, lines, dropped, kept) of each (doc_id, text)."""
    key = lambda x: x.strip(WHITE).translate(UPPER)
    holders = collections.defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            if i is not None and len(key(x)) >= min_chars:
                holders[key(x)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stays = [x for x in lines if i is None or len(key(x)) < min_chars or len(holders[key(x)]) < min_docs
                 or max(holders[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(stays), "\n".join(stays)))
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))


def result(docs, **more):
    return order([(r["row"]["doc_id"], r["n_lines"], r["n_dropped"], r["kept"]) for r in L.dedup(docs, **more).collect()])


def test_edge_rows(make_docs, edge_rows):
    assert result(make_docs(edge_rows)) == order(brute(edge_rows))
    assert L.dedup(make_docs([])).count() == 0


def test_lines(make_docs):
    a, b = "The same Line of twenty-four", "ünïcödé line öf 20!!"
    assert len(b) == 20
    rows = [(1, a), (2, f" {a.upper()}\t\nown line one"), (3, f"first\n{a}\x0b\r\nlast\n{a}\n"), (4, "x\n\n\n y "),
            (5, b), (6, b), (7, b.replace("ü", "Ü")), (8, b + "\n" + b[:-1]), (9, b[:-1]), (10, b[:-1]), (11, b[:-1]),
            (12, "twice in one document, twice\n" * 5), (13, "twice in one document, twice"), (None, a), (None, a)]
    want = brute(rows)
    assert dict((r[0], r[2]) for r in want)[1] == 1 and dict((r[0], r[3]) for r in want)[1] == ""
    assert dict((r[0], r[2]) for r in want)[3] == 0 and dict((r[0], r[2]) for r in want)[5] == 1
    assert result(make_docs(rows)) == order(want)


def test_repeated_keys_with_other_texts(make_docs):
    a = "a line that several of them hold"
    rows = [(1, a), (1, a), (1, a + "\nmore"), (1, None), (2, "x\n" + a), (2, a + "\nx"), (3, "short"), (3, a)]
    assert result(make_docs(rows)) == order(brute(rows))
    two = rows[:6]  # five rows, two documents: under the threshold
    assert result(make_docs(two)) == order(brute(two)) and all(r[2] == 0 for r in brute(two))


def test_random_lines_and_thresholds(make_docs):
    rng = random.Random(1)
    pool = ["".join(rng.choice("abAB é") for _ in range(rng.randint(0, 9))) for _ in range(40)]
    rows = [(rng.randint(0, 60), "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 12)))) for _ in range(150)]
    for chars, docs in ((1, 2), (4, 5), (0, 1)):
        assert result(make_docs(rows), min_chars=chars, min_docs=docs) == order(brute(rows, chars, docs))


def test_common_line_is_never_gathered(make_docs):
    """The line of all documents is counted by partial aggregates and joined by a table of one row per key."""
    line = "a notice that stands at the foot of all"
    rows = [(i, f"text number {i}\n{line}") for i in range(300)]
    got = result(make_docs(rows))
    assert sum(r[2] for r in got) == 299 and got[-1][2] == 0
    plan = L.dedup(make_docs(rows))._jdf.queryExecution().toString()
    assert "Window" not in plan and "CartesianProduct" not in plan and "collect_list" not in plan
