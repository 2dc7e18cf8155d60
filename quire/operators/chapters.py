"""Tables of contents: which boxes belong together on a page, and which pages their entries lead to.

Boxes are dicts of the columns x, y, w, h. Boxes of one page meet by an equi-join on the page's keys; a page holds few.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import geometry
from quire.operators import assignment
from quire.operators.rank import arg_max

SIDES = "xywh"


def _box(prefix: str) -> dict[str, Column]:
    return {c: F.col(f"{prefix}{c}") for c in SIDES}


def _named(df: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    return df.select(*keys, *[F.col(c).alias(f"{prefix}{c}") for c in df.columns if c not in keys])


def in_search_area(position: Column, total: Column, fraction: float = 0.25) -> Column:
    """Whether a page, counted from 0, is among the first or last ``fraction`` of all."""
    return (position < total * fraction) | (total - position - 1 < total * fraction)


def beside(number: dict[str, Column], title: dict[str, Column], side: str) -> Column:
    """A number's centre lies in the title's band, strictly on the left or right of the title's centre."""
    middle, centre, other = number["y"] + number["h"] / 2, number["x"] + number["w"] / 2, title["x"] + title["w"] / 2
    return middle.between(title["y"], title["y"] + title["h"]) & (centre < other if side == "left" else centre > other)


def subtitle_gap(title: dict[str, Column], sub: dict[str, Column]) -> Column:
    return sub["y"] - (title["y"] + title["h"])


def subtitle_share(title: dict[str, Column], sub: dict[str, Column]) -> Column:
    """Common width as a share of the narrower box; null if that has none."""
    least = F.least(title["w"], sub["w"])
    return F.when(least > 0, geometry.overlap(title["x"], title["x"] + title["w"], sub["x"], sub["x"] + sub["w"]) / least)


def subtitle_fits(title: dict[str, Column], sub: dict[str, Column], overlap: float = 0.25, gap: float = 1.5, share: float = 0.25) -> Column:
    """A subtitle starts no higher than its title, overlaps it little, follows closely and shares some of its width."""
    between = subtitle_gap(title, sub)
    near = (between >= -overlap * F.least(title["h"], sub["h"])) & (between <= gap * F.greatest(title["h"], sub["h"]))
    return F.coalesce((sub["y"] >= title["y"]) & near & (subtitle_share(title, sub) >= share), F.lit(False))


def _paired(titles: DataFrame, others: DataFrame, keys: list[str], fits: Column, order: list[Column]) -> DataFrame:
    """``title_id, id``: titles in reading order take their best free box. Both have id, x, y, w, h, confidence."""
    read = lambda df: df.withColumn("at", F.row_number().over(Window.partitionBy(*keys).orderBy("y", "x", "id")))
    t, o = _named(read(titles), keys, "t_"), _named(read(others), keys, "o_")
    both = t.join(o, keys).where(fits).select(*keys, "t_at", "o_at", *[c.alias(f"k{i}") for i, c in enumerate(order)])
    took = assignment.greedy(both, keys, "t_at", "o_at", [f"k{i}" for i in range(len(order))])
    return took.join(t.select(*keys, "t_at", F.col("t_id").alias("title_id")), [*keys, "t_at"]).join(o.select(*keys, "o_at", F.col("o_id").alias("id")), [*keys, "o_at"]).select(*keys, "title_id", "id")


def _surer() -> list[Column]:
    return [-F.coalesce(F.col("o_confidence"), F.lit(-1.0))]


def _larger() -> list[Column]:
    return [-F.abs(F.col("o_w") * F.col("o_h")), -F.abs(F.col("o_w"))]


def numbers_of_titles(titles: DataFrame, numbers: DataFrame, keys: list[str], side: str) -> DataFrame:
    """Each number goes to one title at most: numbers wholly outside first, then by distance to the title's edge, confidence,
    area and width."""
    t, o = _box("t_"), _box("o_")
    away = t["x"] - (o["x"] + o["w"]) if side == "left" else o["x"] - (t["x"] + t["w"])
    return _paired(titles, numbers, keys, beside(o, t, side), [F.when(away >= 0, 0).otherwise(1), F.abs(away), *_surer(), *_larger()])


def subtitles_of_titles(titles: DataFrame, subtitles: DataFrame, keys: list[str]) -> DataFrame:
    t, o = _box("t_"), _box("o_")
    return _paired(titles, subtitles, keys, subtitle_fits(t, o), [F.abs(subtitle_gap(t, o)), *_surer(), -subtitle_share(t, o), *_larger()])


def nearest_titles(numbers: DataFrame, titles: DataFrame, keys: list[str]) -> DataFrame:
    """``id, title_id``: of each number the nearest title on its left; a title may have several numbers."""
    t, o = _box("t_"), _box("o_")
    both = _named(titles, keys, "t_").join(_named(numbers, keys, "o_"), keys).where(beside(o, t, "right"))
    away = F.greatest(F.lit(0.0), o["x"] - (t["x"] + t["w"]))
    best = arg_max(both, [*keys, "o_id"], [away, -F.coalesce(F.col("t_confidence"), F.lit(-1.0)), "t_y", "t_x", "t_id"])
    return best.select(*keys, F.col("o_id").alias("id"), F.col("t_id").alias("title_id"))


def expected_position(value: Column, system: Column, before: Column, after: Column) -> Column:
    """Where an entry should start: its number and the offset of the anchors around it, struct(position, value, system), that
    have its numeral system; null if there is none or they differ."""
    offset = lambda a: F.when(a["system"] == system, a["position"] - a["value"])
    one, two = offset(before), offset(after)
    return F.when(F.coalesce(one == two, F.lit(True)), value + F.coalesce(one, two))


def number_fits(value: Column, system: Column, before: Column, after: Column) -> Column:
    """A page's printed number doesn't contradict the anchors around it; a page without one never does."""
    low, high = (a["system"] == system for a in (before, after))
    return ~F.coalesce(low & (value < before["value"]), F.lit(False)) & ~F.coalesce(high & (value > after["value"]), F.lit(False))


def range_ends(entries: DataFrame, pages: DataFrame, keys: list[str], offset: int = 2) -> DataFrame:
    """``entries`` (entry, system, first, last, start, stop) with ``end``, the position at which a range of numbers ends.

    A page that bears the last number and lies from ``start`` to ``stop`` (null: no bound), the nearest to where it should
    be; without one the nearest page that is at most ``offset`` from there; ties go to the earlier. ``pages`` have
    position, value, system. Both are equi-joins: the second meets the few positions allowed.
    """
    e = entries.withColumn("ideal", F.col("last") + F.col("start") - F.col("first"))
    inside = (F.col("position") >= F.col("start")) & F.coalesce(F.col("position") <= F.col("stop"), F.lit(True))
    exact = e.join(pages.withColumnRenamed("value", "last").select(*keys, "system", "last", "position"), [*keys, "system", "last"]).select(*keys, "entry", "position", "ideal", "start", "stop", F.lit(0).alias("kind"))
    near = e.withColumn("position", F.explode(F.sequence(F.col("ideal") - offset, F.col("ideal") + offset))).join(pages.select(*keys, "position").distinct(), [*keys, "position"]).select(*keys, "entry", "position", "ideal", "start", "stop", F.lit(1).alias("kind"))
    best = arg_max(exact.unionByName(near).where(inside), [*keys, "entry"], ["kind", F.abs(F.col("position") - F.col("ideal")), "position"])
    return entries.join(best.select(*keys, "entry", F.col("position").alias("end")), [*keys, "entry"], "left")


def ordered_mode(mode: str, score: Column, least: float = 0.9) -> Column:
    """Whether an order is enforced: as told, or where the score is unknown or high enough."""
    if mode in ("yes", "no"):
        return F.lit(mode == "yes")
    return score.isNull() | (score >= least)


def inserted_after(elements: DataFrame, new: DataFrame, batch: str) -> DataFrame:
    """``batch, id, position``: new elements (container, entry, id) right after their container, in entry order. New elements
    whose container is missing are left out; see relations.missing_in."""
    old = elements.select(batch, "id", F.col("position").alias("p"), F.lit(0).alias("late"), F.lit(0).cast("long").alias("entry"))
    at = elements.select(batch, F.col("id").alias("container"), F.col("position").alias("p"))
    added = new.join(at, [batch, "container"]).select(batch, "id", "p", F.lit(1).alias("late"), F.col("entry").cast("long").alias("entry"))
    w = Window.partitionBy(batch).orderBy("p", "late", "entry", "id")
    return old.unionByName(added).select(batch, "id", (F.row_number().over(w) - 1).alias("position"))
