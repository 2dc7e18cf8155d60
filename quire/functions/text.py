"""Text: normalisation, edit distances, similarities, natural order, tagging."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


@F.pandas_udf(StringType())
def _decompose(s: pd.Series) -> pd.Series:
    """Compatibility decomposition without combining marks; Spark has no built-in for it."""
    return s.map(lambda t: None if t is None else "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)))


def fold(text: Column) -> Column:
    """Accents removed; texts of ASCII alone don't leave the JVM's expression but for the call that skips them."""
    return F.when(text.rlike(r"^[\x00-\x7F]*$"), text).otherwise(_decompose(text))


def normalise(text: Column, leaders: bool = False) -> Column:
    """Lower case, accents off, anything but letters, digits and _ to one space; ``leaders``: runs of dots and dashes first."""
    t = F.trim(F.lower(text))
    t = F.regexp_replace(t, r"[.\-_·•]{2,}", " ") if leaders else t
    return F.trim(F.regexp_replace(fold(t), r"[^\p{L}\p{N}_]+", " "))


def clean(text: Column, placeholders: tuple[str, ...]) -> Column:
    """Trimmed; null where empty or a placeholder, whatever its case."""
    t = F.trim(text)
    return F.when((t == "") | F.lower(t).isin(*placeholders), None).otherwise(t)


def chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def substring_distance(source: Column, target: Column) -> Column:
    """Least edit distance of ``target`` to any substring of ``source``: the usual table with a free start and end."""
    t = chars(target)
    first = F.sequence(F.lit(0), F.length(target))

    def row(old: Column, c: Column) -> Column:
        def cell(new: Column, j: Column) -> Column:
            cost = F.when(F.get(t, j - 1) == c, 0).otherwise(1)
            return F.concat(new, F.array(F.least(F.get(old, j) + 1, F.get(new, j - 1) + 1, F.get(old, j - 1) + cost)))

        return F.aggregate(F.sequence(F.lit(1), F.length(target)), F.array(F.lit(0)), cell)

    start = F.struct(first.alias("row"), F.length(target).alias("best"))
    step = lambda a, c: F.element_at(F.transform(F.array(row(a["row"], c)), lambda r: F.struct(r.alias("row"), F.least(a["best"], F.element_at(r, -1)).alias("best"))), 1)
    return F.when(F.length(target) == 0, 0).otherwise(F.aggregate(chars(source), start, step)["best"])


def similarity(detected: Column, record: Column) -> Column:
    """1 - distance / length of ``record``: within ``detected`` if the record is shorter, else between both; 0 if one is empty."""
    d = F.when(F.length(record) < F.length(detected), substring_distance(detected, record)).otherwise(F.levenshtein(detected, record))
    return F.when((F.coalesce(F.length(detected), F.lit(0)) == 0) | (F.coalesce(F.length(record), F.lit(0)) == 0), F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), 1 - d / F.length(record)))


def best_similarity(detected: Column, records: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(F.filter(records, lambda r: F.coalesce(F.length(r), F.lit(0)) > 0), lambda r: similarity(detected, r))), F.lit(0.0))


def relative_match(original: Column, transcription: Column, tolerance: float) -> tuple[Column, Column]:
    """Whether two texts match within a relative tolerance, and how close they are; (false, 0) if one is empty."""
    empty = (F.coalesce(F.length(original), F.lit(0)) == 0) | (F.coalesce(F.length(transcription), F.lit(0)) == 0)
    close = (F.length(original) - F.levenshtein(original, transcription)) / F.length(transcription)
    return F.when(empty, False).otherwise(close.between(1 - tolerance, 1 + tolerance)), F.when(empty, 0.0).otherwise(close)


def natural_key(text: Column) -> Column:
    """A string that sorts as the text does if runs of digits, of any length, count as numbers and case doesn't: their
    length comes before them."""
    runs = F.regexp_extract_all(F.lower(text), F.lit(r"[0-9]+|[^0-9]+"), F.lit(0))
    number = lambda r: F.regexp_replace(r, "^0+(?=.)", "")
    return F.array_join(F.transform(runs, lambda r: F.when(r.rlike("^[0-9]"), F.concat(F.lpad(F.length(number(r)).cast("string"), 10, "0"), number(r))).otherwise(r)), "")


def features(text: Column) -> dict[str, Column]:
    """Counts of letters, capitals, digits, white space and the rest."""
    n = lambda p: F.length(F.regexp_replace(text, p, ""))
    return {"n_alpha": n(r"[^\p{L}]"), "n_upper": n(r"[^\p{Lu}]"), "n_digit": n("[^0-9]"), "n_space": n(r"[^ \t\n\r]"), "n_other": n(r"[\p{L}0-9 \t\n\r]"), "n_all": F.length(text)}


def fuzzy_tag(word: Column, keys: dict[str, str], most: int = 2) -> Column:
    """The tag of the nearest key within ``most`` edits, first in order on ties; null if none is near."""
    near = F.array(*[F.struct(F.levenshtein(word, F.lit(k)).alias("d"), F.lit(i).alias("i"), F.lit(t).alias("tag")) for i, (k, t) in enumerate(keys.items())])
    best = F.array_min(near)
    return F.when(best["d"] <= most, best["tag"])


def camel_parts(key: Column) -> Column:
    """The words of a camelCase, snake_case or kebab-case name, in lower case."""
    return F.filter(F.split(F.lower(F.regexp_replace(F.regexp_replace(key, "([a-z0-9])([A-Z])", "$1_$2"), "[^A-Za-z0-9]+", "_")), "_"), lambda x: x != "")


def is_secret(key: Column, words: tuple[str, ...] = ("password", "secret", "token", "credential", "credentials"), pairs: tuple[tuple[str, str], ...] = (("api", "key"), ("access", "key"), ("private", "key"))) -> Column:
    """Whether a configuration key names something that logs must not show."""
    p = camel_parts(key)
    out = F.arrays_overlap(p, F.array(*map(F.lit, words)))
    for a, b in pairs:
        out = out | F.array_contains(F.transform(p, lambda x, i: F.concat_ws(" ", x, F.get(p, i + 1))), f"{a} {b}")
    return out


def stem(path: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"(\.[^./]*)$", 1))


def last_parts(path: Column, n: int = 3) -> Column:
    """The last ``n`` components; null if there are fewer."""
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    return F.when(F.size(parts) >= n, F.array_join(F.slice(parts, -n, n), "/"))


def uuid_of(pid: Column) -> Column:
    return F.lower(F.regexp_extract(pid, r"(?i)^(?:uuid:)?([0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12})$", 1))


#: Czech month names, nominative and genitive, January first.
MONTHS = (("leden", "ledna"), ("únor", "února"), ("březen", "března"), ("duben", "dubna"), ("květen", "května"), ("červen", "června"), ("červenec", "července"), ("srpen", "srpna"), ("září",), ("říjen", "října"), ("listopad", "listopadu"), ("prosinec", "prosince"))

#: Days between issues by the words for it; of several that a text holds the first counts.
FREQUENCIES = {
    "annual": 365, "biennial": 730, "bimonthly": 60, "biweekly": 14, "daily": 1, "monthly": 30, "quarterly": 90, "semimonthly": 15, "semiweekly": 3, "three times a month": 10, "triennial": 1095, "unknown": 0, "weekly": 7,
    "denně": 1, "3x týdně": 2, "třikrát týdně": 2, "dvakrát týdně": 3, "2x týdně": 3, "týdeník": 7, "týdenník": 7, "týdně": 7, "1x týdně": 7, "jednou týdně": 7, "3x měsíčně": 10, "1x za 2 týdny": 14, "2x měsíčně": 15, "dvakrát měsíčně": 15,
    "jednou měsíčně": 30, "1x měsíčně": 30, "měsíčně": 30, "6x ročně": 61, "5x ročně": 73, "4x ročně": 91, "3x ročně": 122, "2x ročně": 183, "1x ročně": 365, "ročně": 365, "ročenka": 365, "nepravidelně": 0, "nepradivelná": 0, "neznámá": 0, "neurčitá": 0,
    "týždně": 7, "1x týždenne": 7, "2x týždenne": 3, "3x týždenne": 2, "mesačne": 30, "1x mesačne": 30, "2x mesačne": 15, "3x mesačne": 10, "4x mesačne": 7,
}


def czech_date(text: Column) -> Column:
    """Dates as dd.mm.yyyy: months by number, single digits with a zero, no spaces."""
    out = F.lower(text)
    for i, names in enumerate(MONTHS, 1):
        out = F.regexp_replace(out, rf"(?U)\b(?:{'|'.join(names)})\b", f"{i:02}.")
    return F.replace(F.regexp_replace(out, r"(?U)\b(\d)\b", "0$1"), F.lit(" "), F.lit(""))


def holds_date(line: Column, date: Column) -> Column:
    """Whether a line names the date, with or without its year."""
    t = czech_date(line)
    return (F.trim(line) != "") & (t.contains(date) | t.contains(F.regexp_replace(date, r"\b\d{3,4}\b", "")))


def frequency_days(text: Column) -> Column:
    """Days between issues: of the text itself, else of the first known words in it, else 0."""
    t = F.replace(F.lower(text), F.lit(";"), F.lit(""))
    exact = F.create_map(*[F.lit(x) for kv in FREQUENCIES.items() for x in kv])[t]
    return F.when(text.isNotNull(), F.coalesce(exact, *[F.when(t.contains(k), F.lit(d)) for k, d in FREQUENCIES.items()], F.lit(0)))


def same_text(a: Column, b: Column) -> Column:
    """Equal once normalised; nothing equals nothing alone."""
    return normalise(a).eqNullSafe(normalise(b))


def joined_label(*parts: Column, separator: str = " | ") -> Column:
    """Parts that say something, trimmed; null if none does."""
    said = F.concat_ws(separator, *[F.when(F.trim(p) != "", F.trim(p)) for p in parts])
    return F.when(said != "", said)


def joined_tokens(tokens: Column) -> Column:
    """Named entities, array of struct(word, tag), of word pieces struct(word, tag): B- starts one, but a piece with ## and a tag
    that ends in T goes on with the last one's word; I- adds a word to the last; special tokens and other tags go."""
    def step(a: Column, t: Column) -> Column:
        word, last = F.replace(t["word"], F.lit("##"), F.lit("")), F.get(a, F.size(a) - 1)
        fresh = F.concat(a, F.array(F.struct(word.alias("word"), F.right(t["tag"], F.lit(1)).alias("tag"))))
        longer = lambda glue: F.concat(F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0))), F.array(F.struct(F.concat(last["word"], F.lit(glue), word).alias("word"), last["tag"].alias("tag"))))
        begins, goes_on = t["tag"].startswith("B-"), t["tag"].startswith("I-")
        return F.when(begins & t["word"].startswith("##") & t["tag"].endswith("T") & (F.size(a) > 0), longer("")).when(goes_on & (F.size(a) > 0), longer(" ")).when(begins | goes_on, fresh).otherwise(a)

    return F.aggregate(F.filter(tokens, lambda t: ~t["word"].isin("[CLS]", "[SEP]")), F.array().cast("array<struct<word:string,tag:string>>"), step)
