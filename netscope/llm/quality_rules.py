"""Quality rules as a short-circuit cascade, in DataFrame functions only.

A rule is a condition over measures of a text that rejects it.  Each rule's cost (seconds per sampled
row above an empty rule) and its rejections are measured on a sample; the rules then run in the order
of rejections per cost inside one ``CASE``, so that a rule is evaluated only for rows which the rules
before it let pass.  The order changes the time and ``rejected_by``, never which rows are rejected.

Null and blank texts have no words and are rejected by ``too_few_words``; an empty table gives an
empty result; repeated rows are judged alike; other columns of the input stay as they are (a column
named like the added one is replaced).
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netscope.llm.common import let, table, words_column
from netscope.session import cut_lineage

NAME = "op6_quality_rules"
SAMPLE_ROWS = 2_000

# Fixed values of the base measures and of the two base rules.
SYMBOLS = "[#*$%&|<>]"
MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50


def _word_chars(text: Column, words: Column) -> Column:
    return F.length(F.array_join(words, "")).cast("long")


def _symbols(text: Column, words: Column) -> Column:
    return F.coalesce(F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, "")), F.lit(0)).cast("long")


def _lines(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))


def _dup_lines(text: Column, words: Column) -> Column:
    return let(_lines(text), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def _repeat_words(text: Column, words: Column) -> Column:
    """Words inside 3-word windows found twice or more.

    Each window becomes one long: the upper bits of its hash with its position in the lower bits.
    After one sort of those longs equal windows are neighbours, which are then compared word by word,
    so no other pair of windows is ever looked at.
    """
    def in_words(w: Column) -> Column:
        n = F.size(w)
        mask = F.pow(F.lit(2.0), F.length(F.bin(n.cast("long")))).cast("long") - F.lit(1)

        def with_mask(low: Column) -> Column:
            keys = F.transform(F.slice(w, F.lit(1), F.greatest(n - 2, F.lit(0))), lambda x, i: F.xxhash64(
                x, F.get(w, i + 1), F.get(w, i + 2)).bitwiseAND(F.bitwise_not(low)).bitwiseOR(i.cast("long")))

            def same(a: Column, b: Column) -> Column:
                p, q = a.bitwiseAND(low).cast("int"), b.bitwiseAND(low).cast("int")
                equal = (F.get(w, p) == F.get(w, q)) & (F.get(w, p + 1) == F.get(w, q + 1)) & (
                    F.get(w, p + 2) == F.get(w, q + 2))
                return F.coalesce((a.bitwiseXOR(b).bitwiseAND(F.bitwise_not(low)) == 0) & equal, F.lit(False))

            def covered(s: Column) -> Column:
                found = F.filter(s, lambda x, i: same(x, F.get(s, i - 1)) | same(x, F.get(s, i + 1)))
                at = F.sort_array(F.transform(found, lambda x: x.bitwiseAND(low)))
                start = F.struct(F.lit(-3).cast("long").alias("last"), F.lit(0).cast("long").alias("n"))
                return F.aggregate(at, start, lambda acc, p: F.struct(
                    p.alias("last"), (acc["n"] + F.least(F.lit(3).cast("long"), p - acc["last"])).alias("n")),
                    lambda acc: acc["n"])
            return let(F.sort_array(keys), covered)
        return let(mask, with_mask)
    return in_words(words)


#: Measures of a text, from the text and its words.
MEASURES: dict[str, Callable[[Column, Column], Column]] = {
    "n_words": lambda text, words: F.size(words).cast("long"),
    "word_chars": _word_chars,
    "n_symbols": _symbols,
    "n_lines": lambda text, words: F.size(_lines(text)).cast("long"),
    "n_dup_lines": _dup_lines,
    "n_repeat_words": _repeat_words,
}

#: Measures that the query returns for every document.
BASE_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

Rule = Callable[[Callable[[str], Column]], Column]

#: Conditions that reject, over a function that gives a measure by its name.
BASE_RULES: dict[str, Rule] = {
    "too_few_words": lambda m: m("n_words") < MIN_WORDS,
    "repeated_words": lambda m: 100 * m("n_repeat_words") > MAX_REPEATED_PERCENT * m("n_words"),
}
RULES: dict[str, Rule] = BASE_RULES | {
    "symbol_heavy": lambda m: 10 * m("n_symbols") > m("n_words"),
    "repeated_lines": lambda m: 10 * m("n_dup_lines") > 3 * m("n_lines"),
    "odd_word_length": lambda m: (m("word_chars") < 2 * m("n_words")) | (m("word_chars") > 15 * m("n_words")),
}


def measures(text: Column, names: Mapping[str, Callable] = MEASURES) -> Column:
    """All measures of ``text`` as one struct; the words are split once."""
    return let(words_column(text), lambda w: F.struct(*[f(text, w).alias(k) for k, f in names.items()]))


def lazy(text: Column, rule: Rule) -> Column:
    """The rule over ``text``, computing only the measures that it asks for."""
    return let(words_column(text), lambda w: rule(lambda k: MEASURES[k](text, w)))


def sample_rows(docs: DataFrame, text: str = "text", rows: int = SAMPLE_ROWS, seed: int = 17) -> DataFrame:
    """About ``rows`` texts, chosen by a hash of the text, materialised once."""
    total = docs.count()
    bound = min(1.0, rows / max(total, 1)) * 2.0 ** 63
    keep = F.abs(F.shiftright(F.xxhash64(F.col(text), F.lit(seed)), 1)) * 2.0 <= bound
    return cut_lineage(docs.select(F.col(text).alias("text")).filter(keep))


def order_rules(sample: DataFrame, rules: Mapping[str, Rule] = RULES) -> list[dict]:
    """Each rule's rejections and seconds on ``sample``, in the order in which to run them."""
    def run(cond: Column) -> tuple[float, int]:
        began = time.perf_counter()
        n = sample.agg(F.count_if(cond)).first()[0]
        return time.perf_counter() - began, int(n)

    run(F.length("text") < 0)  # compiles the plan's common part
    empty = run(F.length("text") < 0)[0]
    found = []
    for name, rule in rules.items():
        seconds, rejected = run(F.coalesce(lazy(F.col("text"), rule), F.lit(False)))
        found.append({"rule": name, "rejected": rejected, "seconds": max(seconds - empty, 1e-4)})
    return sorted(found, key=lambda x: (-x["rejected"] / x["seconds"], x["rule"]))


def verdict(rules: Mapping[str, Rule], order: list[str], measure: Callable[[str], Column]) -> Column:
    """Name of the first rule, in this order, that rejects; null if none does."""
    out = F.lit(None).cast("string")
    for name in reversed(order):
        out = F.when(rules[name](measure), F.lit(name)).otherwise(out)
    return out


def apply_rules(docs: DataFrame, text: str = "text", rules: Mapping[str, Rule] = RULES,
                order: list[str] | None = None, known: Mapping[str, Column] | None = None) -> DataFrame:
    """``docs`` with ``rejected_by``, the rule that rejects a row (null: kept).

    The cascade is lazy: a measure is computed only for the rows that reach a rule which needs it.  ``known``
    measures are columns of ``docs`` and aren't computed again.
    """
    order = order or [x["rule"] for x in order_rules(sample_rows(docs, text), rules)]
    column = F.col(text)
    if known:
        return docs.withColumn("rejected_by", verdict(rules, order, lambda k: known[k] if k in known else (
            MEASURES[k](column, words_column(column)))))
    return docs.withColumn("rejected_by", let(words_column(column), lambda w: verdict(
        rules, order, lambda k: MEASURES[k](column, w))))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures of every document, and the cascade's verdict; what no base measure gives is computed lazily."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    order = [x["rule"] for x in order_rules(sample_rows(docs))]
    m = docs.select("doc_id", "text", measures(F.col("text"), {k: MEASURES[k] for k in BASE_MEASURES}).alias("m"))
    known = {k: F.col(f"m.{k}") for k in BASE_MEASURES}
    judged = apply_rules(m, order=order, known=known)
    failed = F.lit(False)
    for rule in BASE_RULES.values():
        failed = failed | rule(known.__getitem__)
    return judged.select("doc_id", *[c.alias(k) for k, c in known.items()], failed.alias("base_failed"),
                         F.col("rejected_by").isNull().alias("kept"))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
g AS (SELECT r, i, {'a': w[i], 'b': w[i + 1], 'c': w[i + 2]} AS k
      FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
dup AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS n FROM g) WHERE n > 1),
rep AS (SELECT r, count(*) AS n FROM (SELECT DISTINCT r, i + j AS p FROM dup, (SELECT unnest([0, 1, 2]) AS j)) GROUP BY r),
m AS (SELECT doc_id, len(w)::BIGINT AS n_words,
             coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             len(lines)::BIGINT AS n_lines,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
             coalesce(rep.n, 0)::BIGINT AS n_repeat_words
      FROM d LEFT JOIN rep USING (r)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 3 * n_lines
            OR word_chars < 2 * n_words OR word_chars > 15 * n_words) AS kept
FROM f
"""
