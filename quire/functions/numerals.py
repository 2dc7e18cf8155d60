"""Roman numerals and printed page numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Digits of other scripts and Roman number signs.
WIDE, ARABIC, PERSIAN = ("".join(chr(b + i) for i in range(10)) for b in (0xFF10, 0x0660, 0x06F0))
SIGNS = ["I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX", "X", "XI", "XII", "L", "C", "D", "M"]
VALUES = {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100, "D": 500, "M": 1000}


def roman_pattern(thousands: int) -> str:
    return f"M{{0,{thousands}}}(?:CM|CD|D?C{{0,3}})(?:XC|XL|L?X{{0,3}})(?:IX|IV|V?I{{0,3}})"


def plain(text: Column) -> Column:
    """Digits of other scripts as ASCII, Roman number signs as letters."""
    out = F.translate(text, WIDE + ARABIC + PERSIAN, "0123456789" * 3)
    for base in (0x2160, 0x2170):
        for i, s in enumerate(SIGNS):
            out = F.regexp_replace(out, chr(base + i), s if base == 0x2160 else s.lower())
    return out


def to_roman(n: Column) -> Column:
    """Roman numeral of 1 to 3999."""
    digit = lambda one, five, ten, d: F.element_at(F.array(*map(F.lit, ["", one, one * 2, one * 3, one + five, five, five + one, five + one * 2, five + one * 3, one + ten])), (d + 1).cast("int"))
    place = lambda p: F.floor(n / p) % 10
    return F.when(n.between(1, 3999), F.concat(F.repeat(F.lit("M"), F.floor(n / 1000).cast("int")), digit("C", "D", "M", place(100)), digit("X", "L", "C", place(10)), digit("I", "V", "X", place(1))))


def from_roman(text: Column, thousands: int = 3) -> Column:
    """Value of a well-formed Roman numeral, else null: from the right, a letter counts less than its neighbour negatively."""
    up = F.upper(text)
    value = F.create_map(*[F.lit(x) for kv in VALUES.items() for x in kv])
    start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("last"))
    step = lambda a, c: F.struct((a["sum"] + F.when(value[c] < a["last"], -value[c]).otherwise(value[c])).alias("sum"), F.greatest(a["last"], value[c]).alias("last"))
    letters = F.filter(F.split(F.reverse(up), ""), lambda c: c != "")
    return F.when((up != "") & up.rlike(f"^{roman_pattern(thousands)}$"), F.aggregate(letters, start, step)["sum"])


def printed_number(text: Column) -> Column:
    """A decorated page number as struct(norm, value, system): one Arabic number, whose groups of digits only white space
    may part, else exactly one word that is a Roman numeral; null otherwise. A number beyond 64 bits has no value."""
    t = plain(text)
    groups = F.regexp_extract_all(t, F.lit("[0-9]+"), F.lit(0))
    one = t.rlike(r"^[^0-9]*[0-9]+(?:\s+[0-9]+)*[^0-9]*$")
    digits = F.array_join(groups, "")
    words = F.regexp_extract_all(t, F.lit(r"\p{L}+"), F.lit(0))
    roman = F.filter(words, lambda w: from_roman(w).isNotNull())
    arabic = F.struct(digits.alias("norm"), digits.try_cast("bigint").alias("value"), F.lit("arabic").alias("system"))
    numeral = F.struct(F.get(roman, 0).alias("norm"), from_roman(F.get(roman, 0)).cast("bigint").alias("value"), F.lit("roman").alias("system"))
    return F.when(F.size(groups) > 0, F.when(one, arabic)).when(F.size(roman) == 1, numeral)


_TOKEN = r"(?<![A-Za-z0-9])(?:[0-9]+|[MDCLXVImdclxvi]+)(?![A-Za-z0-9])"


def page_reference(text: Column) -> Column:
    """A reference in a table of contents as struct(kind, items, text): single, range or list; null if it is none.

    Any invalid or zero number, a sign before the first one, or another separator rejects the whole. A range that falls
    is its first number; one of mixed numeral systems is none.
    """
    t = F.regexp_replace(plain(text), r"[‐-―−]", "-")
    found = F.regexp_extract_all(t, F.lit(_TOKEN), F.lit(0))
    items = F.transform(found, lambda x: F.when(x.rlike("^[0-9]"), F.struct(F.regexp_replace(x, "^0+(?=.)", "").alias("text"), x.try_cast("bigint").alias("value"), F.lit("arabic").alias("system"))).otherwise(F.struct(x.alias("text"), from_roman(x, 4).cast("bigint").alias("value"), F.lit("roman").alias("system"))))
    shape = F.regexp_replace(F.regexp_replace(t, _TOKEN, "#"), r"\s+", "")
    good = (F.size(items) > 0) & F.forall(items, lambda i: F.coalesce(i["value"] > 0, F.lit(False))) & ~shape.rlike("[0-9]") & ~shape.rlike("[-+]#") | shape.rlike(r"^[^#+-]*#-#[^#+-]*$") & F.forall(items, lambda i: F.coalesce(i["value"] > 0, F.lit(False)))
    a, b = F.get(items, 0), F.get(items, 1)
    out = lambda kind, its, sep: F.struct(F.lit(kind).alias("kind"), its.alias("items"), F.array_join(F.transform(its, lambda i: i["text"]), sep).alias("text"))
    ranged = F.when(a["system"] != b["system"], None).when(a["value"] <= b["value"], out("range", items, "-")).otherwise(out("single", F.slice(items, 1, 1), ""))
    return F.when(~good, None).when(shape.rlike(r"^[^#]*#[^#]*$"), out("single", items, "")).when(shape.rlike(r"^[^#]*#-#[^#]*$"), ranged).when(shape.rlike(r"^[^#]*#(?:,#)+[^#]*$"), out("list", items, ","))
