"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Each rule is a boolean column over one document's measures. On a sample the
cascade times every rule and counts what it rejects, and then evaluates the
rules in the order of rejections per second: a document that one rule rejects
never reaches the ones behind it.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesmith.llm.staging import written

#: The characters between words, as a Java pattern.
SEPARATORS = "[\\x20\\x09-\\x0D]+"
#: Rows whose cost and selectivity set the order of the rules; the verdict doesn't depend on it.
SAMPLE_ROWS = 2000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is computed once however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SEPARATORS), lambda w: w != "")


def word_chars(text: Column) -> Column:
    """Code points in words."""
    out = F.coalesce(text, F.lit(""))
    for c in (" ", "\t", "\n", "\x0b", "\x0c", "\r"):
        out = F.replace(out, F.lit(c), F.lit(""))
    return F.length(out).cast("long")


def _only(text: Column, others: str) -> Column:
    """Code points left when the runs that ``others`` matches are gone."""
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), others, "")).cast("long")


def n_symbols(text: Column) -> Column:
    return _only(text, "[^#*$%&|<>]+")


def n_lines(text: Column) -> Column:
    t = F.coalesce(text, F.lit(""))
    return (F.length(t) - F.length(F.replace(t, F.lit("\n"), F.lit(""))) + 1).cast("long")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


_POSITION_BITS = 24


def n_repeat_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more, the first included.

    Windows are hashed to 64 bits. A text without equal hashes is done. Else
    the hashes' upper bits, packed with the positions, are sorted so that equal
    windows are neighbours; a text where two different hashes share their upper
    bits, or with 2**24 words, sorts (hash, position) pairs instead. Sorted
    positions of repeated windows cover min(3, gap to the next) words each.
    """
    low = (1 << _POSITION_BITS) - 1

    def windows(w: Column) -> Column:
        return F.transform(F.slice(w, 1, F.size(w) - 2),
                           lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))

    def covered(p: Column) -> Column:
        steps = F.zip_with(p, F.slice(p, 2, F.size(p)), lambda x, y: F.coalesce(F.least(F.lit(3), y - x), F.lit(3)))
        return F.when(F.size(p) == 0, F.lit(0).cast("long")).otherwise(
            F.aggregate(steps, F.lit(0).cast("long"), lambda acc, x: acc + x))

    def pairs(h: Column) -> Column:
        def repeated(s: Column) -> Column:
            hits = F.filter(s, lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False))
                            | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)))
            return F.sort_array(F.transform(hits, lambda x: x["i"]))

        s = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return let(let(s, repeated), covered)

    def packed(h: Column) -> Column:
        def upper(x: Column) -> Column:
            return F.shiftright(x, _POSITION_BITS)

        def position(x: Column) -> Column:
            return x.bitwiseAND(F.lit(low)).cast("int")

        def candidates(s: Column) -> Column:
            return F.filter(s, lambda x, k: F.coalesce(upper(F.get(s, k - 1)) == upper(x), F.lit(False))
                            | F.coalesce(upper(F.get(s, k + 1)) == upper(x), F.lit(False)))

        def count(c: Column) -> Column:
            clash = F.exists(F.zip_with(c, F.slice(c, 2, F.size(c)), lambda x, y: F.coalesce(
                (upper(x) == upper(y)) & (F.get(h, position(x)) != F.get(h, position(y))), F.lit(False))), lambda x: x)
            return F.when(clash, pairs(h)).otherwise(let(F.sort_array(F.transform(c, position)), covered))

        s = F.sort_array(F.transform(h, lambda x, i: x.bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("long"))))
        return F.when(F.size(h) > low, pairs(h)).otherwise(let(let(s, candidates), count))

    def over(w: Column) -> Column:
        return F.when(F.size(w) < 4, F.lit(0).cast("long")).otherwise(let(windows(w), lambda h: F.when(
            F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(packed(h))))

    return let(words, over)


#: What rules may ask for, as expressions over a text and its words.
MEASURES = {
    "n_words": lambda text, words: F.size(words).cast("long"),
    "n_repeat_words": lambda text, words: n_repeat_words(words),
    "word_chars": lambda text, words: word_chars(text),
    "n_symbols": lambda text, words: n_symbols(text),
    "n_lines": lambda text, words: n_lines(text),
    "n_dup_lines": lambda text, words: n_dup_lines(text),
    "n_letters": lambda text, words: _only(text, "\\P{L}+"),
    "n_upper": lambda text, words: _only(text, "[^A-Z]+"),
}


@dataclass(frozen=True)
class Rule:
    """``rejects`` gets a function from a measure's name to its column."""

    name: str
    rejects: Callable[[Callable[[str], Column]], Column]


#: The production rules. The first two are the contract's base rules.
RULES = (
    Rule("few_words", lambda m: m("n_words") < 50),
    Rule("repeated_windows", lambda m: 100 * m("n_repeat_words") > 50 * m("n_words")),
    Rule("symbols", lambda m: 10 * m("n_symbols") > 3 * m("n_words")),
    Rule("duplicate_lines", lambda m: 2 * m("n_dup_lines") > m("n_lines")),
    Rule("short_words", lambda m: m("word_chars") < 2 * m("n_words")),
    Rule("long_words", lambda m: m("word_chars") > 20 * m("n_words")),
    Rule("few_letters", lambda m: 2 * m("n_letters") < m("word_chars")),
    Rule("shouting", lambda m: 10 * m("n_upper") > 6 * m("word_chars")),
)
BASE_RULES = ("few_words", "repeated_windows")


def _rejects(rule: Rule, text: Column, words: Column) -> Column:
    return rule.rejects(lambda name: MEASURES[name](text, words))


def rule_order(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES,
               sample_rows: int = SAMPLE_ROWS, seed: int = 11) -> list[tuple[Rule, float, float]]:
    """(rule, seconds on the sample, share rejected), cheapest rejection first; ties in the rules' own order.

    The sample is a seeded Bernoulli sample of about ``sample_rows`` rows,
    written once and read by one timed job a rule. An empty table keeps the
    order the rules came in.
    """
    n = docs.count()
    if not n:
        return [(r, 0.0, 0.0) for r in rules]
    text = docs.select(F.col(text_col).alias("t"))
    sample = written(text.sample(min(1.0, sample_rows / n), seed), "cascade-sample")
    sample.agg(F.max(F.length("t"))).collect()
    read = []
    for rule in rules:
        verdict = let(words_of(F.col("t")), partial(_rejects, rule, F.col("t")))
        began = time.perf_counter()
        row = sample.agg(F.count("*").alias("n"), F.count_if(verdict).alias("r")).first()
        read.append((rule, time.perf_counter() - began, row["r"] / max(1, row["n"])))
    return sorted(read, key=lambda x: -x[2] / max(x[1], 1e-6))


def first_rejection(ranked: list[Rule], measure: Callable[[str], Column]) -> Column:
    """The first rule that rejects, as one CASE: a branch is only evaluated for rows that no branch before it took."""
    out = F.lit(None).cast("string")
    for rule in reversed(ranked):
        out = F.when(F.coalesce(rule.rejects(measure), F.lit(False)), F.lit(rule.name)).otherwise(out)
    return out


def cascade(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES,
            order: list[Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> Column:
    """The first rule, in cascade order, that rejects the document; null where none does.

    Measures are expressions inside the branches, so a row only pays for the
    rules that it reaches. Null texts count as empty. The rule's name depends
    on the measured order; whether there is one doesn't.
    """
    ranked = order if order is not None else [r for r, _, _ in rule_order(docs, text_col, rules, sample_rows)]
    text = F.col(text_col)
    return let(words_of(text), lambda w: first_rejection(ranked, lambda name: MEASURES[name](text, w)))


def quality_report(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                   rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per input row: the contract's measures, ``base_failed`` and ``kept``.

    The measures that the report shows are computed for every row; the rules
    on them and the further measures run as a cascade behind the base rules.

    Null text: no words, so every count is 0 and ``base_failed`` is true. Null
    or repeated ids: every row is reported as it is. Empty table: no rows.
    Very long texts are read whole; a row's memory follows its own text. Only
    the two named columns are read, so other columns' names don't matter.
    """
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    ranked = [r for r, _, _ in rule_order(d, "text", rules, sample_rows) if r.name not in BASE_RULES]
    text = F.col("text")
    shown = ["word_chars", "n_symbols", "n_dup_lines"]
    m = d.select("doc_id", "text", let(words_of(text), lambda w: F.struct(
        MEASURES["n_words"](text, w).alias("n_words"), n_repeat_words(w).alias("n_repeat_words"))).alias("w"),
        *[MEASURES[name](text, None).alias(name) for name in shown])
    known = {name: F.col(name) for name in shown} | {name: F.col(f"w.{name}") for name in ("n_words", "n_repeat_words")}
    # the other measures need no words
    rest = first_rejection(ranked, lambda name: known[name] if name in known else MEASURES[name](text, None))
    failed = (known["n_words"] < 50) | (100 * known["n_repeat_words"] > 50 * known["n_words"])
    return m.select("doc_id", known["n_words"].alias("n_words"), *shown,
                    known["n_repeat_words"].alias("n_repeat_words"), failed.alias("base_failed"),
                    F.when(failed, F.lit(False)).otherwise(rest.isNull()).alias("kept"))


#: The same rows in DuckDB SQL.
REPORT_SQL = """
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws,
         string_split(coalesce(text, ''), chr(10)) AS all_lines,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents),
c AS (
  SELECT doc_id, text, ws, len(ws) AS n_words,
         length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         len(all_lines) AS n_lines,
         length(regexp_replace(text, '[^A-Z]+', '', 'g')) AS n_upper,
         length(regexp_replace(text, '\\P{L}+', '', 'g')) AS n_letters,
         row_number() OVER () AS rid
  FROM w),
p AS (SELECT rid, unnest(range(1, n_words - 1)) AS i, ws FROM c WHERE n_words >= 3),
g AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS win FROM p),
r AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS n FROM g),
h AS (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM r WHERE n >= 2),
v AS (SELECT rid, sum(least(3, coalesce(nxt - i, 3))) AS n FROM h GROUP BY rid),
m AS (SELECT c.*, coalesce(v.n, 0) AS n_repeat_words FROM c LEFT JOIN v USING (rid)),
f AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed
       AND NOT 10 * n_symbols > 3 * n_words AND NOT 2 * n_dup_lines > n_lines
       AND NOT (word_chars < 2 * n_words OR word_chars > 20 * n_words)
       AND NOT 2 * n_letters < word_chars AND NOT 10 * n_upper > 6 * word_chars AS kept
FROM f
"""
