"""Operators on ordered rows: islands, forward fill, as-of joins, neighbours, density windows, chunks, intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.operators.assignment import per_group


def _w(keys, order):
    return Window.partitionBy(*keys).orderBy(*order)


def islands(df: DataFrame, keys: list[str], order: list, position: Column, gap: int = 1, name: str = "island") -> DataFrame:
    """Numbers runs of rows whose ``position`` is at most ``gap`` after the one before."""
    w = _w(keys, order)
    new = F.coalesce((position - F.lag(position).over(w) > gap).cast("int"), F.lit(0))
    return df.withColumn("_new", new).withColumn(name, F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def suffix_from_first(df: DataFrame, keys: list[str], position: str, flag: Column) -> DataFrame:
    """Each group from its first flagged row on; groups without a flag stay whole."""
    first = F.min(F.when(flag, F.col(position))).over(Window.partitionBy(*keys))
    return df.withColumn("_first", first).where(F.col("_first").isNull() | (F.col(position) >= F.col("_first"))).drop("_first")


def forward_fill(df: DataFrame, keys: list[str], order: list, value: Column, name: str, default=None) -> DataFrame:
    filled = F.last(value, ignorenulls=True).over(_w(keys, order).rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn(name, filled if default is None else F.coalesce(filled, F.lit(default)))


def positional_parent(df: DataFrame, keys: list[str], order: list, anchor: Column, name: str) -> DataFrame:
    """The last anchor at or before the row; rows before the first one go to it."""
    w = _w(keys, order)
    before = F.last(anchor, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    after = F.first(anchor, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    return df.withColumn(name, F.coalesce(before, after))


def surrounding(df: DataFrame, keys: list[str], order: list, anchor: Column) -> DataFrame:
    """The nearest anchor strictly before and strictly after every row."""
    w = _w(keys, order)
    return df.withColumn("anchor_before", F.last(anchor, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))).withColumn("anchor_after", F.first(anchor, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing)))


def infants_of(rows: list[tuple]) -> list[tuple]:
    """(position, parent's position) of the infants among rows (position, parent, infant, front, back) of a batch in order.

    The first parent is current from the start, each further one from its own row on. A front cover, before its row's infant,
    and a back cover, after it, move on to the next parent however far ahead it is, but only once the current parent's own
    row is behind: of a back cover and the front cover after it one moves.
    """
    parents = [r[0] for r in rows if r[1]]
    out, now = [], 0
    for at, _, infant, front, back in rows if parents else []:
        if now + 1 < len(parents) and parents[now + 1] == at:
            now += 1
        if front and now + 1 < len(parents) and parents[now] < at:
            now += 1
        if infant:
            out.append((at, parents[now]))
        if back and now + 1 < len(parents) and parents[now] < at:
            now += 1
    return out


def bind_infants(df: DataFrame, keys: list[str], position: str, is_parent: Column, is_infant: Column, front: Column, back: Column) -> DataFrame:
    """Keys, ``position`` of each infant row and ``parent``, the position of its parent: infants_of() for every batch, in one
    walk over its rows. A batch without parents gives none; null flags are false."""
    flag = lambda c: F.coalesce(c, F.lit(False))
    rows = df.select(*keys, F.col(position).cast("long").alias(position), flag(is_parent).alias("_p"), flag(is_infant).alias("_i"), flag(front).alias("_f"), flag(back).alias("_b"))
    types = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)
    return per_group(rows, keys, [position, "_p", "_i", "_f", "_b"], [position], f"{types}, {position} long, parent long", infants_of)


def neighbours(df: DataFrame, keys: list[str], order: list, value: str) -> DataFrame:
    """Previous and next value, how many rows come before and after, and the relative position (0 for a single row)."""
    w, whole = _w(keys, order), Window.partitionBy(*keys)
    n, total = F.row_number().over(w), F.count(F.lit(1)).over(whole)
    out = df.select("*", F.lag(value).over(w).alias("previous"), F.lead(value).over(w).alias("next"), (n - 1).alias("n_before"), (total - n).alias("n_after"))
    return out.withColumn("relative", F.when(F.col("n_before") + F.col("n_after") > 0, F.col("n_before") / (F.col("n_before") + F.col("n_after"))).otherwise(F.lit(0.0)))


def density(df: DataFrame, keys: list[str], position: str, height: int, name: str = "in_window") -> DataFrame:
    """How many rows lie at most ``height`` after each row's position."""
    return df.withColumn(name, F.count(F.lit(1)).over(Window.partitionBy(*keys).orderBy(position).rangeBetween(0, height)))


def covered(df: DataFrame, keys: list[str], position: str, height: int, qualifies: Column) -> DataFrame:
    """Whether a row lies in the window of a qualifying start at or before it."""
    last = F.max(F.when(qualifies, F.col(position))).over(Window.partitionBy(*keys).orderBy(position).rangeBetween(-height, 0))
    return df.withColumn("covered", last.isNotNull())


def even_chunks(df: DataFrame, keys: list[str], order: list, k: int) -> DataFrame:
    """``k`` chunks in order, the first ones longer by a row, and the row's number in its chunk."""
    out = df.withColumn("chunk", F.ntile(k).over(_w(keys, order)))
    return out.withColumn("in_chunk", F.row_number().over(_w([*keys, "chunk"], order)))


def interval_end(df: DataFrame, keys: list[str], order: str, depth: str, start: str, last: str) -> DataFrame:
    """The end of each entry of a pre-order listing: one before the start of the next entry as deep or less deep, not before
    its own start; ``last`` where none follows. A group's entries are looked at as one sorted array."""
    rows = F.sort_array(F.collect_list(F.struct(order, depth, start, last)))

    def end(all_: Column, e: Column, i: Column) -> Column:
        later = F.filter(F.slice(all_, i + 2, F.size(all_)), lambda x: (x[depth] <= e[depth]) & x[start].isNotNull())
        return F.when(F.size(later) > 0, F.greatest(e[start], F.get(later, 0)[start] - 1)).otherwise(e[last])

    g = df.groupBy(*keys).agg(rows.alias("rows"))
    g = g.select(*keys, F.explode(F.transform("rows", lambda e, i: F.struct(e[order].alias(order), e[depth].alias(depth), e[start].alias(start), end(F.col("rows"), e, i).alias("end")))).alias("e"))
    return g.select(*keys, "e.*")


def leader_clusters(values: Column, tolerance: float, least: int = 3) -> Column:
    """One-dimensional clusters: sorted values join while they are within ``tolerance`` of the cluster's least. Array of
    struct(low, n, values) of the clusters with at least ``least``."""
    start = F.array().cast("array<struct<low:double,n:int,values:array<double>>>")

    def step(a: Column, v: Column) -> Column:
        last = F.get(a, F.size(a) - 1)
        joined = F.struct(last["low"].alias("low"), (last["n"] + 1).alias("n"), F.concat(last["values"], F.array(v)).alias("values"))
        fresh = F.struct(v.alias("low"), F.lit(1).alias("n"), F.array(v).alias("values"))
        return F.when((F.size(a) > 0) & (v - last["low"] <= tolerance), F.concat(F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0))), F.array(joined))).otherwise(F.concat(a, F.array(fresh)))

    return F.filter(F.aggregate(F.sort_array(F.transform(values, lambda v: v.cast("double"))), start, step), lambda c: c["n"] >= least)


def leading_run(df: DataFrame, keys: list[str], order: list, normal: Column, run: int = 5) -> DataFrame:
    """The rows before the first ``run`` normal rows in succession."""
    w = _w(keys, order)
    ends = F.sum(normal.cast("int")).over(w.rowsBetween(0, run - 1))
    numbered = df.withColumn("_n", F.row_number().over(w)).withColumn("_ends", ends)
    stop = F.min(F.when(F.col("_ends") == run, F.col("_n"))).over(Window.partitionBy(*keys))
    return numbered.withColumn("_stop", stop).where(F.col("_stop").isNull() | (F.col("_n") < F.col("_stop"))).drop("_n", "_ends", "_stop")


def monotonicity(values: Column) -> Column:
    """Length of the longest non-decreasing subsequence of an array: patience tails."""
    def step(tails: Column, v: Column) -> Column:
        at = F.size(F.filter(tails, lambda t: t <= v))
        return F.concat(F.slice(tails, 1, at), F.array(v), F.slice(tails, at + 2, F.greatest(F.size(tails) - at - 1, F.lit(0))))

    return F.size(F.aggregate(values, F.array().cast("array<int>"), step))


def touching(df: DataFrame, keys: list[str], left: str, right: str) -> DataFrame:
    """Unions of intervals that overlap or touch."""
    w = _w(keys, [left, right])
    top = F.max(right).over(w.rowsBetween(Window.unboundedPreceding, -1))
    d = df.withColumn("_new", F.coalesce((F.col(left) > top).cast("int"), F.lit(1)))
    d = d.withColumn("_id", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return d.groupBy(*keys, "_id").agg(F.min(left).alias(left), F.max(right).alias(right), F.count(F.lit(1)).alias("n")).drop("_id")


def neighbour_values(df: DataFrame, keys: list[str], order: list, value: str, k: int) -> DataFrame:
    """``around``: the values of the ``k`` rows before and after, 0 where there is none."""
    w = _w(keys, order)
    return df.withColumn("around", F.array(*[F.coalesce(F.lag(value, -i).over(w), F.lit(0).cast(df.schema[value].dataType)) for i in range(-k, k + 1) if i]))


def running_position(df: DataFrame, keys: list[str], order: list, padding: Column, name: str = "place") -> DataFrame:
    """The number, from 0, of each row that isn't padding; null for padding."""
    n = F.sum((~padding).cast("int")).over(_w(keys, order).rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn(name, F.when(~padding, n - 1))
