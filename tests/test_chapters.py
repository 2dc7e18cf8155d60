"""Boxes of a table of contents against a plain walk over them, and fixed cases of the text functions."""

import random

import pytest
from pyspark.sql import functions as F

from quire.functions import text
from quire.operators import chapters, sequences

COLUMNS = "page long, id long, x double, y double, w double, h double, confidence double"


def boxes(seed, n=120):
    r = random.Random(seed)
    return [(i % 8, i, float(r.randint(0, 40)), float(r.randint(0, 40)), float(r.randint(1, 25)), float(r.randint(4, 14)), r.choice([None, 0.5, r.random()])) for i in range(n)]


def walk(titles, others, rank):
    """Titles from top to bottom, each taking what ranks first among what is left."""
    out = []
    for page in range(8):
        free = sorted((o for o in others if o[0] == page), key=lambda o: (o[3], o[2], o[1]))
        for t in sorted((t for t in titles if t[0] == page), key=lambda t: (t[3], t[2], t[1])):
            ranked = [(rank(t, o), i) for i, o in enumerate(free) if rank(t, o) is not None]
            if ranked:
                out.append((page, t[1], free.pop(min(ranked)[1])[1]))
    return sorted(out)


def surest(o):
    return -(-1.0 if o[6] is None else o[6])


@pytest.mark.parametrize("side", ["left", "right"])
def test_numbers_of_titles(spark, side):
    def rank(t, o):
        ok = t[3] <= o[3] + o[5] / 2 <= t[3] + t[5]
        a, b = o[2] + o[4] / 2, t[2] + t[4] / 2
        if not ok or not (a < b if side == "left" else a > b):
            return None
        gap = t[2] - o[2] - o[4] if side == "left" else o[2] - t[2] - t[4]
        return gap < 0, abs(gap), surest(o), -o[4] * o[5], -o[4]

    t, o = boxes(1), boxes(2)
    got = chapters.numbers_of_titles(spark.createDataFrame(t, COLUMNS), spark.createDataFrame(o, COLUMNS), ["page"], side)
    assert sorted(map(tuple, got.collect())) == walk(t, o, rank) != []


def test_subtitles_of_titles(spark):
    def rank(t, o):
        gap, common = o[3] - t[3] - t[5], max(0.0, min(t[2] + t[4], o[2] + o[4]) - max(t[2], o[2])) / min(t[4], o[4])
        if o[3] < t[3] or gap < -0.25 * min(t[5], o[5]) or gap > 1.5 * max(t[5], o[5]) or common < 0.25:
            return None
        return abs(gap), surest(o), -common, -o[4] * o[5], -o[4]

    t, o = boxes(3), boxes(4)
    got = chapters.subtitles_of_titles(spark.createDataFrame(t, COLUMNS), spark.createDataFrame(o, COLUMNS), ["page"])
    assert sorted(map(tuple, got.collect())) == walk(t, o, rank) != []


def test_texts(spark):
    def many(column, *values):
        rows = spark.createDataFrame(list(enumerate(values)), "i int, v string").select("i", column.alias("r")).orderBy("i").collect()
        return [r.r for r in rows]

    assert many(text.czech_date(F.col("v")), "V Praze 3. Května 1901", "12. září", None) == ["vpraze03.05.1901", "12.09.", None]
    assert many(text.holds_date(F.col("v"), F.lit("03.05.1901")), "dne 3. května", "4. května 1901", " ") == [True, False, False]
    assert many(text.frequency_days(F.col("v")), "Týdně;", "prý 3x ročně", "občas", None) == [7, 122, 0, None]
    assert many(text.joined_label(F.col("v"), F.lit(" b ")), "a", " ", None) == ["a | b", "b", "b"]


def test_infants(spark):
    def rows(n, parents, front=(), back=()):
        return [(0, i, i in parents, i in front, i in back) for i in range(n)]

    def got(*args, **named):
        df = spark.createDataFrame(rows(*args, **named), "batch int, at int, parent boolean, front boolean, back boolean")
        out = sequences.bind_infants(df, ["batch"], "at", F.col("parent"), F.lit(True), F.col("front"), F.col("back"))
        return [r.parent for r in out.orderBy("at").collect()]

    assert got(5, {0, 4}) == [0, 0, 0, 0, 4]
    assert got(5, {0, 4}, front={2}) == [0, 0, 4, 4, 4]
    assert got(5, {0, 4}, back={2}) == [0, 0, 0, 4, 4]
    assert got(6, {0, 4, 5}, front={3}, back={2}) == [0, 0, 0, 4, 4, 5]
    assert got(3, {1, 2}, front={0}) == [1, 1, 2]
    assert got(3, set(), front={0}) == []
