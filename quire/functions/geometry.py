"""Boxes: struct-free column expressions on x, y, width, height with the origin at the top left."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(*cols: Column) -> Column:
    out = F.lit(True)
    for c in cols:
        out = out & c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    return out


def contained(x: Column, y: Column, w: Column, h: Column, page_w: Column, page_h: Column) -> Column:
    """A finite box of positive size that lies inside the page."""
    return F.coalesce(finite(x, y, w, h, page_w, page_h) & (w > 0) & (h > 0) & (x >= 0) & (y >= 0) & (x + w <= page_w) & (y + h <= page_h), F.lit(False))


def edge_distance(centre: Column, length: Column) -> Column:
    """Distance to the nearer end, as a share of the length."""
    return F.least(centre / length, 1 - centre / length)


def overlap(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    return F.greatest(F.least(a1, b1) - F.greatest(a0, b0), F.lit(0))


def intersection(a: dict[str, Column], b: dict[str, Column]) -> Column:
    return overlap(a["x"], a["x"] + a["w"], b["x"], b["x"] + b["w"]) * overlap(a["y"], a["y"] + a["h"], b["y"], b["y"] + b["h"])


def iou(a: dict[str, Column], b: dict[str, Column]) -> Column:
    both = intersection(a, b)
    return both / (a["w"] * a["h"] + b["w"] * b["h"] - both)


def coverage(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """The greater share of either box that the other covers."""
    both = intersection(a, b)
    return F.greatest(both / (a["w"] * a["h"]), both / (b["w"] * b["h"]))


def clamp(value: Column, low: Column, high: Column) -> Column:
    return F.least(F.greatest(value, low), high)


def percent(value: Column, whole: Column) -> Column:
    return value / whole * 100


def fit_size(w: Column, h: Column, most: int) -> tuple[Column, Column]:
    """Width and height scaled to a longest side of ``most``, cut to whole pixels."""
    scale = F.lit(float(most)) / F.greatest(w, h)
    return (w * scale).cast("int"), (h * scale).cast("int")


def union(a: dict[str, Column], b: dict[str, Column]) -> dict[str, Column]:
    """The least box around two."""
    x, y = F.least(a["x"], b["x"]), F.least(a["y"], b["y"])
    return {"x": x, "y": y, "w": F.greatest(a["x"] + a["w"], b["x"] + b["w"]) - x, "h": F.greatest(a["y"] + a["h"], b["y"] + b["h"]) - y}


def sizes_differ(w: Column, h: Column, other_w: Column, other_h: Column) -> Column:
    """Whether two known sizes differ; false where one is unknown."""
    return F.coalesce((w != other_w) | (h != other_h), F.lit(False))


def inside_paddings(top: Column, right: Column, bottom: Column, left: Column, w: Column, h: Column, below: int = 10) -> dict[str, Column]:
    """The box that paddings leave of a page, longer by ``below`` at its foot."""
    return {"x": left, "y": top, "w": w - right - left, "h": h - bottom + below - top}


def split_column(x0: Column, x1: Column, ratio: float = 0.5, padding: float = 10) -> tuple[Column, Column]:
    """Where two boxes in one place part, x0 and x1 being their outer edges: the first's new end, the second's new start."""
    border = x0 + (x1 - x0) * ratio
    return border - padding * (1 - ratio), border + padding * ratio


def note_point(anchor_end: Column, anchor_y: Column, w: Column, h: Column, size: int = 18, margin: int = 2) -> tuple[Column, Column]:
    """Where a note stands: after its anchor, inside the page by a margin."""
    return F.least(F.greatest(anchor_end + margin, F.lit(margin)), w - size - margin), F.least(F.greatest(anchor_y, F.lit(margin)), h - size - margin)


def corner_slot(slot: Column, w: Column, size: int = 18, margin: int = 2) -> Column:
    """The left edge of the note in a slot, counted from 0, of the upper left corner."""
    return F.least(margin + slot * (size + margin), w - size - margin)
