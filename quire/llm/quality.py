"""Quality rules: a table of thresholds compiled into one projection of built-in functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import SPACES, words

SYMBOLS = "#*$%&|<>"

#: Frequent short words of English, French, German and Spanish.
STOP_WORDS = {
    "en": "the of and to in is that for it was on are with as be by at this have from or had not but which",
    "fr": "le la les de des du un une et est en que qui dans pour par sur pas au aux ce avec",
    "de": "der die das und ist in zu den von mit sich des auf für nicht ein eine als auch dem an er es",
    "es": "el la los las de del que y en un una por con para se es no al lo su como más",
}

#: name, metric, smallest and largest value that a document may have (None: no limit). Length, symbol, stop-word and
#: line ratios; wide enough that ordinary prose of any of the languages stays.
RULES: list[tuple[str, str, float | None, float | None]] = [
    ("mean_word_length", "mean_word", 2.0, 15.0),
    ("longest_word", "longest_word", None, 1000.0),
    ("symbols_per_word", "symbol_ratio", None, 0.1),
    ("duplicate_lines", "dup_line_ratio", None, 0.5),
    ("stop_words", "stop_ratio", 0.02, None),
    ("upper_case_words", "upper_ratio", None, 0.6),
]


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once for ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(ws: Column, width: int = 3) -> Column:
    """How many words lie in windows of ``width`` words that occur twice or more in the text.

    Windows are first compared by a 64-bit hash: texts whose window hashes are all distinct end there. For the others the
    hashes are sorted with their places; those next to an equal hash, few as a rule, are then sorted by their words, and the
    places next to equal words are covered.
    """
    def windows(w: Column) -> Column:
        last = F.size(w) - width
        return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)]))).otherwise(F.array().cast("array<bigint>"))

    def twice(s: Column, by: str) -> Column:
        return F.filter(s, lambda x, i: (F.get(s, i - 1)[by] == x[by]) | (F.get(s, i + 1)[by] == x[by]))

    def covered(w: Column, h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        alike = _let(placed, lambda s: twice(s, "h"))
        worded = F.sort_array(F.transform(alike, lambda x: F.struct(F.array_join(F.slice(w, x["i"] + 1, width), " ").alias("g"), x["i"].alias("i"))))

        def places(s: Column) -> Column:
            return F.size(F.array_distinct(F.flatten(F.transform(twice(s, "g"), lambda x: F.array(*[x["i"] + k for k in range(width)])))))

        return _let(worded, places)

    return _let(windows(ws), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(ws, h))).cast("long")


def metrics(text: Column) -> dict[str, Column]:
    """Columns that need the text itself, in two layers: ``_words`` first, then what is made from it."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.translate(x, SPACES, "") != "")
    return {
        "word_chars": F.length(F.translate(t, SPACES, "")).cast("long"),
        "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
    }


def word_metrics(ws: Column) -> dict[str, Column]:
    stop = sorted({x for v in STOP_WORDS.values() for x in v.split()})
    return {
        "n_words": F.size(ws).cast("long"),
        "n_repeat_words": repeated_words(ws),
        "longest_word": F.coalesce(F.array_max(F.transform(ws, lambda x: F.length(x))), F.lit(0)).cast("long"),
        "n_stop_words": F.size(F.filter(ws, lambda x: F.lower(x).isin(stop))).cast("long"),
        "n_upper_words": F.size(F.filter(ws, lambda x: (F.upper(x) == x) & (F.lower(x) != x))).cast("long"),
    }


def ratios() -> dict[str, Column]:
    per = lambda x, n: F.when(F.col(n) > 0, F.col(x) / F.col(n)).otherwise(F.lit(0.0))
    return {
        "mean_word": per("word_chars", "n_words"), "symbol_ratio": per("n_symbols", "n_words"), "dup_line_ratio": per("n_dup_lines", "n_lines"),
        "stop_ratio": per("n_stop_words", "n_words"), "upper_ratio": per("n_upper_words", "n_words"), "longest_word": F.col("longest_word").cast("double"),
    }


def verdict(rules: list[tuple[str, str, float | None, float | None]] = RULES) -> tuple[Column, Column]:
    """Whether every rule holds, and the names of those that don't."""
    value = ratios()
    fails = {}
    for name, metric, low, high in rules:
        bad = F.lit(False)
        bad = bad if low is None else bad | (value[metric] < low)
        fails[name] = bad if high is None else bad | (value[metric] > high)
    names = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in fails.items()])) if fails else F.array().cast("array<string>")
    return reduce(lambda a, b: a & ~b, fails.values(), F.lit(True)), names


def score(docs: DataFrame, text: str = "text", key: str = "doc_id", rules: list[tuple[str, str, float | None, float | None]] = RULES, least_words: int = 50) -> DataFrame:
    """One row per document: ``key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, failed_rules``.

    A null or empty text has no words, and so fails the base (under ``least_words`` words, or more than half of them in
    repeated windows). Repeated rows are judged one by one; other columns are left out, whatever their names; an empty
    table gives an empty one. One narrow stage: no shuffle and no user function.
    """
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("body"))
    rows = rows.select("key", "body", words(F.col("body")).alias("ws"))
    rows = rows.select("key", *[c.alias(k) for k, c in metrics(F.col("body")).items()], *[c.alias(k) for k, c in word_metrics(F.col("ws")).items()])
    base = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    good, names = verdict(rules)
    return rows.select(F.col("key").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), (~base & good).alias("kept"), names.alias("failed_rules"))


def keep(docs: DataFrame, text: str = "text", rules: list[tuple[str, str, float | None, float | None]] = RULES, least_words: int = 50) -> DataFrame:
    """The rows of ``docs`` that the base and the rules keep, with all their columns, whatever their names.

    A null, empty or blank text has no words and fails the base; equal rows are judged one by one; an empty table gives an
    empty one. One narrow stage: no shuffle and no user function.
    """
    names = docs.columns
    body = docs.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("row"), F.col(f"`{text}`").alias("body"))
    body = body.select("row", "body", words(F.col("body")).alias("ws"))
    # a column that isn't deterministic keeps the filter above the counts; pushed below, it would repeat them for every rule
    held = F.spark_partition_id().alias("held")
    body = body.select("row", *[c.alias(k) for k, c in metrics(F.col("body")).items()], *[c.alias(k) for k, c in word_metrics(F.col("ws")).items()], held)
    base = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return body.where(~base & verdict(rules)[0] & (F.col("held") >= 0)).select("row.*")


_STOP = ", ".join("'" + x + "'" for x in sorted({x for v in STOP_WORDS.values() for x in v.split()}))
#: The counts and the verdict in SQL.
ORACLE = rf"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
l AS (SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
    CASE WHEN len(ws) >= 3 THEN list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) ELSE [] END AS win FROM w),
e AS (SELECT doc_id, unnest(win) AS g, unnest(range(1, len(win) + 1)) AS i FROM l WHERE len(win) > 0),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM e) WHERE n > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM dup, (VALUES (0), (1), (2)) v(k) GROUP BY doc_id),
m AS (SELECT l.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(ls) AS BIGINT) AS n_lines,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
    coalesce(list_max(list_transform(ws, lambda x: length(x))), 0) AS longest, len(list_filter(ws, lambda x: lower(x) IN ({_STOP}))) AS n_stop,
    len(list_filter(ws, lambda x: upper(x) = x AND lower(x) <> x)) AS n_upper
  FROM l LEFT JOIN cov USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars / n_words BETWEEN 2.0 AND 15.0 AND longest <= 1000 AND n_symbols / n_words <= 0.1
  AND (n_lines = 0 OR n_dup_lines / n_lines <= 0.5) AND n_stop / n_words >= 0.02 AND n_upper / n_words <= 0.6 AS kept FROM b
"""
