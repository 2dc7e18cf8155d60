"""Text, numerals and boxes against the fixed cases of the blueprint's fixtures."""

import pytest
from pyspark.sql import functions as F

from quire.functions import geometry, numerals, text


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column.alias("r")).first().r


def many(spark, values, column):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, v string").select("i", column.alias("r")).orderBy("i").collect()
    return [r.r for r in rows]


def test_printed_numbers(spark):
    good = {"12": "12", "  0012  ": "0012", "- 12 -": "12", "— 12 —": "12", "[12].": "12", "• str. 12 •": "12", "1 2 3": "123", "１２３": "123", "١٢٣": "123", "XIV": "XIV", "— xiv —": "xiv", "str. IV.": "IV", "[Ⅻ]": "XII"}
    bad = ["", "---", "page", "12-13", "1 of 10", "1/10", "IIII", "IC", "I / X"]
    got = many(spark, [*good, *bad], numerals.printed_number(F.col("v")))
    assert [g.norm for g in got[: len(good)]] == list(good.values())
    assert got[len(good) :] == [None] * len(bad)
    assert got[10].value == 14 and got[10].system == "roman"


def test_page_references(spark):
    cases = {"XIV": ("single", "XIV"), "str. 004": ("single", "4"), "１２３": ("single", "123"), "str. 23–24": ("range", "23-24"), "xii—xiv": ("range", "xii-xiv"), "23, 27, 31": ("list", "23,27,31"), "XII, 14": ("list", "XII,14"), "45-": ("single", "45"), "45–": ("single", "45"), "24-23": ("single", "24"), "XIV-XII": ("single", "XIV")}
    bad = ["XII-14", "not a page", "-45", "–45", "—45", "−45", "+45", "str. -45", "0", "3. 45", "12/45", "12 45", "23-24-25"]
    got = many(spark, [*cases, *bad], numerals.page_reference(F.col("v")))
    assert [(g.kind, g.text) if g else None for g in got[: len(cases)]] == list(cases.values())
    assert got[len(cases) :] == [None] * len(bad)


@pytest.mark.parametrize(("a", "b", "low", "high"), [("Kytice z povesti narodnich, vydal Storch, Praha 1853", "Kytice", 1, 1), ("Almanach ceskych basniku", "Kytice", 0, 0.6), ("Kytice z povesti narodnich", "Kytice z pověstí národních", 1, 1), ("Ky", "Kytice z pověstí národních", 0, 0.2), ("Kytice", "Kytice z pověstí národních", 0, 0.3), ("Praha 1853 Storch", "1853", 1, 1), ("ÚVOD", "1. Úvod", 0.66, 0.67)])
def test_similarity(spark, a, b, low, high):
    df = spark.createDataFrame([(a, b)], "a string, b string").select(text.normalise(F.col("a")).alias("a"), text.normalise(F.col("b")).alias("b"))
    assert low <= df.select(text.similarity(F.col("a"), F.col("b")).alias("r")).first().r <= high


def test_text_helpers(spark):
    names = ["p10.jpg", "p9.jpg", "P1.jpg"]
    assert sorted(names, key=dict(zip(names, many(spark, names, text.natural_key(F.col("v"))), strict=True)).get) == ["P1.jpg", "p9.jpg", "p10.jpg"]
    assert many(spark, ["apiKey", "user_password", "monkey", "private-key-path"], text.is_secret(F.col("v"))) == [True, True, False, True]
    assert many(spark, ["a/b/c/d.jpg", "c/d.jpg"], text.last_parts(F.col("v"))) == ["b/c/d.jpg", None]
    assert one(spark, "900", numerals.to_roman(F.col("v").cast("int"))) == "CM"


def test_boxes(spark):
    box = lambda *v: {k: F.lit(float(x)) for k, x in zip("xywh", v, strict=True)}
    r = spark.range(1).select(geometry.iou(box(0, 0, 2, 2), box(1, 0, 2, 2)).alias("i"), geometry.contained(*[F.lit(float(x)) for x in (751, 10, 50, 20, 800, 1000)]).alias("c"), geometry.contained(F.lit(None).cast("double"), *[F.lit(1.0)] * 5).alias("n")).first()
    assert abs(r.i - 1 / 3) < 1e-9 and r.c is False and r.n is False
