"""Quality rules as a short-circuit cascade (column expressions only).

A rule is a condition under which a text is rejected. The verdict, *kept*, is that no rule rejects; it does not depend
on the order of the rules. The cost does: each rule's time and rejection rate are measured on a bounded sample of the rows that pass the
base rule, drawn by hash from the whole table, and the rules are chained by rejections per second of cost, most first. The chain is nested conditionals, so a rule is
evaluated only for texts that every rule before it has passed.

Words are ``[^\\x20\\x09-\\x0D]+``. Null and empty texts have no words: every count is 0 and they are rejected by the base
rule. Repeated rows are judged alike, doc_id may be null, extra columns are ignored. An empty table has an empty result
(the rules keep their given order then).
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 1000
_WHITE = " \t\n\x0b\f\r"


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once (a lambda variable instead of a repeated expression)."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(_WHITE))
    return let(trimmed, lambda t: F.when(t == "", F.array().cast("array<string>"))
               .otherwise(F.split(t, r"[ \t-\r]+")))


def repeated_words(words: Column, k: int = 5) -> Column:
    """Words inside ``k``-word windows that occur twice or more in the text, first occurrences included.

    Windows are compared by a 64-bit hash. Only texts with an equal pair go on: their windows are sorted by hash, those
    with an equal neighbour are put in text order again, and the words they cover are summed up.
    """
    def covered(at: Column) -> Column:      # sorted first words of the repeated windows
        gaps = F.transform(F.sequence(F.lit(1), F.size(at) - 1),
                           lambda i: F.least(F.lit(k), F.get(at, i) - F.get(at, i - 1)))
        return k + F.when(F.size(at) > 1, F.aggregate(gaps, F.lit(0), lambda s, g: s + g)).otherwise(0)

    def repeats(pairs: Column) -> Column:   # (hash, place) sorted
        same = F.filter(pairs, lambda p, i: (F.get(pairs, i - 1)["h"] == p["h"]) | (F.get(pairs, i + 1)["h"] == p["h"]))
        return let(F.sort_array(F.transform(same, lambda p: p["i"])), covered)

    def of(w: Column) -> Column:
        # the hash of a window from those of its words
        hashes = F.transform(w, lambda x: F.xxhash64(x))
        windows = let(hashes, lambda h: F.transform(
            F.sequence(F.lit(0), F.size(h) - k),
            lambda i: F.xxhash64(*(F.get(h, i + j) for j in range(k)))))
        return let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            let(F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), repeats)))

    return let(words, lambda w: F.when(F.size(w) <= k, F.lit(0)).otherwise(of(w)))


def base_counts(text: Column) -> Column:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words as a struct of longs."""
    def of(w: Column, t: Column) -> Column:
        lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(_WHITE)) != "")
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            repeated_words(w).cast("long").alias("n_repeat_words"))
    whole = F.coalesce(text, F.lit(""))
    return let(words_of(text), lambda w: of(w, whole))


@dataclass(frozen=True)
class RejectRule:
    """``rejects`` builds the condition from the text and the base counts; null counts as not rejected."""

    name: str
    rejects: callable


def _ratio(count: Column, of: Column, limit: float) -> Column:
    return count * 1000 > of * int(limit * 1000)


#: The production rules, all on whole texts. Limits leave clean prose of any language alone.
RULES = [
    RejectRule("word_length", lambda t, c: (c["word_chars"] < 2 * c["n_words"]) | (c["word_chars"] > 15 * c["n_words"])),
    RejectRule("symbols", lambda t, c: _ratio(c["n_symbols"], c["n_words"], 0.3)),
    RejectRule("repeated_lines", lambda t, c: _ratio(c["n_dup_lines"], F.size(F.split(t, "\n")), 0.3)),
    RejectRule("exclamations", lambda t, c: _ratio(
        F.length(t) - F.length(F.replace(t, F.lit("!"), F.lit(""))), c["n_words"], 0.5)),
    RejectRule("capitals", lambda t, c: _ratio(
        F.length(F.regexp_replace(t, "[^A-Z]+", "")), c["word_chars"], 0.6)),
    RejectRule("no_letters", lambda t, c: _ratio(
        F.length(F.regexp_replace(t, r"\p{L}+", "")), F.length(t), 0.6)),
]


def measure(sample: DataFrame, rules: list[RejectRule], text: str = "text", counts: str = "counts") -> list[dict]:
    """Seconds and rejection rate of each rule on a (cached) sample, less the time of a pass that evaluates none."""
    def timed(rejects: Column) -> tuple[float, int, int]:
        began = time.perf_counter()
        row = sample.select(rejects.alias("r")).agg(F.count(F.when(F.col("r"), 1)), F.count("*")).first()
        return time.perf_counter() - began, row[0], row[1]

    none, _, _ = timed(F.col(counts).isNull())
    found = []
    for rule in rules:
        seconds, rejected, rows = timed(F.coalesce(rule.rejects(F.col(text), F.col(counts)), F.lit(False)))
        found.append({"rule": rule, "seconds": max(seconds - none, 1e-3), "rejection": rejected / max(rows, 1)})
    return found


def ordered(measured: list[dict]) -> list[RejectRule]:
    """Rules by rejections per second of cost, most first; ties by name."""
    return [m["rule"] for m in sorted(measured, key=lambda m: (-m["rejection"] / m["seconds"], m["rule"].name))]


def cascade(rules: list[RejectRule], text: Column, counts: Column) -> Column:
    """The name of the first rule that rejects, or null: later rules are not evaluated."""
    verdict = F.lit(None).cast("string")
    for rule in reversed(rules):
        verdict = F.when(F.coalesce(rule.rejects(text, counts), F.lit(False)), F.lit(rule.name)).otherwise(verdict)
    return verdict


def spread_sample(texts: DataFrame, rows: int) -> DataFrame:
    """The ``rows`` rows of the smallest hashes, wherever they lie in the table (all, if there are fewer)."""
    share = min(1.0, 2 * rows / max(texts.count(), 1))
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    return texts.withColumn("place", place).filter(F.col("place") <= int(share * (1 << 30))).orderBy("place").limit(rows).drop("place")


def quality_verdicts(documents: DataFrame, rules: list[RejectRule] | None = None,
                     sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, the base counts, base_failed and kept of each row of ``documents``."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    judged = texts.withColumn("counts", base_counts(F.col("text")))
    failed = (F.col("counts.n_words") < 10) | (100 * F.col("counts.n_repeat_words") > 20 * F.col("counts.n_words"))
    sample = spread_sample(texts, 2 * sample_rows).withColumn("counts", base_counts(F.col("text"))).filter(~failed)
    sample = sample.limit(sample_rows).cache()
    try:
        chain = ordered(measure(sample, RULES if rules is None else rules))
    finally:
        sample.unpersist()
    return (judged.withColumn("base_failed", failed)
            .withColumn("kept", F.when(F.col("base_failed"), False)
                        .otherwise(cascade(chain, F.col("text"), F.col("counts")).isNull()))
            .select("doc_id", "counts.*", "base_failed", "kept"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
t AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, string_split(text, chr(10)) AS l FROM d),
g AS (SELECT r, unnest(range(1, len(w) - 3)) AS i, w FROM t WHERE len(w) >= 5),
x AS (SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2], w[i + 3], w[i + 4]) AS c FROM g),
n AS (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nx FROM x WHERE c > 1),
p AS (SELECT r, sum(least(5, coalesce(nx - i, 5))) AS covered FROM n GROUP BY r),
b AS (SELECT t.r, doc_id, text, l, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
             len(list_filter(l, lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')))
               - len(list_distinct(list_filter(l, lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')))) AS n_dup_lines,
             coalesce(p.covered, 0) AS n_repeat_words
      FROM t LEFT JOIN p ON t.r = p.r),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM b)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR n_symbols * 1000 > n_words * 300
            OR n_dup_lines * 1000 > len(l) * 300
            OR (length(text) - length(replace(text, '!', ''))) * 1000 > n_words * 500
            OR length(regexp_replace(text, '[^A-Z]+', '', 'g')) * 1000 > word_chars * 600
            OR length(regexp_replace(text, '\p{L}+', '', 'g')) * 1000 > length(text) * 600) AS kept
FROM f"""
