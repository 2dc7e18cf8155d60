"""Joins, set operations and aggregates with the semantics that page metadata needs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.operators.rank import arg_max


def pairing(left: DataFrame, right: DataFrame, on: str, left_mark: str = "in_left", right_mark: str = "in_right") -> DataFrame:
    """Full outer join of two key sets with flags for what is missing on either side."""
    a = left.select(on).distinct().withColumn(left_mark, F.lit(True))
    b = right.select(on).distinct().withColumn(right_mark, F.lit(True))
    return a.join(b, on, "full_outer").na.fill(False, [left_mark, right_mark])


def missing_in(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return left.join(right, list(on), "left_anti")


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def upsert(old: DataFrame, new: DataFrame, key: str, value: str, confidence: str | None = None) -> DataFrame:
    """``old`` with ``value`` replaced by that of ``new``: always, or only if the new ``confidence`` is strictly higher."""
    n = new.select(F.col(key), F.col(value).alias("_v"), *([F.col(confidence).alias("_c")] if confidence else []))
    better = F.col("_v").isNotNull() & (F.lit(True) if confidence is None else F.col(confidence).isNull() | (F.col("_c") > F.col(confidence)))
    out = old.join(n, key, "left").withColumn("_b", F.coalesce(better, F.lit(False))).withColumn(value, F.when(F.col("_b"), F.col("_v")).otherwise(F.col(value)))
    if confidence:
        out = out.withColumn(confidence, F.when(F.col("_b"), F.col("_c")).otherwise(F.col(confidence)))
    return out.drop("_v", "_c", "_b")


def collected(df: DataFrame, keys: Sequence[str], order: str, value: str, name: str = "items") -> DataFrame:
    """Values of each group in order."""
    return df.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct(order, value))), lambda x: x[value]).alias(name))


def routed(df: DataFrame, routes: dict[str, tuple[str, str]], kind: str) -> DataFrame:
    """Each row with the target and rule that its kind has in ``routes``; kinds without one go."""
    m = F.create_map(*[F.lit(x) if not isinstance(x, tuple) else F.struct(F.lit(x[0]).alias("target"), F.lit(x[1]).alias("rule")) for kv in routes.items() for x in kv])
    return df.withColumn("_r", m[F.col(kind)]).where(F.col("_r").isNotNull()).withColumns({"target": F.col("_r.target"), "rule": F.col("_r.rule")}).drop("_r")


def cardinality(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """For each key on both sides how many rows either has, and which of the four cases that is."""
    a = left.groupBy(key).agg(F.count(F.lit(1)).alias("n_left"))
    b = right.groupBy(key).agg(F.count(F.lit(1)).alias("n_right"))
    one = lambda c: F.col(c) == 1
    return a.join(b, key).withColumn("branch", F.when(one("n_left") & one("n_right"), "1:1").when(one("n_left"), "1:n").when(one("n_right"), "n:1").otherwise("n:m"))


def containing_all(df: DataFrame, group: str, member: str, needed: Sequence, size: int | None = None) -> DataFrame:
    """Relational division: groups that hold every needed member and, if given, exactly ``size`` members in all."""
    g = df.groupBy(group).agg(F.sum(F.col(member).isin(list(needed)).cast("int")).alias("_hit"), F.count(F.lit(1)).alias("n"), F.collect_set(F.when(F.col(member).isin(list(needed)), F.col(member))).alias("_s"))
    out = g.where(F.size("_s") == len(set(needed)))
    return (out if size is None else out.where(F.col("n") == size)).select(group, "n")


def latest(df: DataFrame, key: str, by: str) -> DataFrame:
    return arg_max(df, [key], [F.desc(by)])


def replace_rows(df: DataFrame, drop: DataFrame, on: Sequence[str]) -> DataFrame:
    """A delete: the rows that survive, to be written in place of the table."""
    return df.join(drop.select(*on).distinct(), list(on), "left_anti")


def collect_garbage(evidence: DataFrame, owners: DataFrame, on: Sequence[str]) -> DataFrame:
    """Evidence that an owner still refers to."""
    return evidence.join(owners.select(*on).distinct(), list(on), "left_semi")


def merged_lists(old: Column, new: Column) -> Column:
    return F.array_union(F.coalesce(old, F.array()), F.coalesce(new, F.array()))


def unpacked(df: DataFrame, columns: Sequence[str], name: str = "id") -> DataFrame:
    """Distinct values of several columns; nulls go."""
    return df.select(F.explode(F.array(*columns)).alias(name)).where(F.col(name).isNotNull()).distinct()


def suppress(df: DataFrame, keys: Sequence[str], ident: str, label: str, confidence: str, overlaps) -> DataFrame:
    """Drops boxes that a surer box of another label in the same group covers; ``overlaps(a, b)`` gives the condition on
    columns with the suffixes _a and _b. Chains: a box goes if any surer one covers it, whether or not that one stays."""
    a, b = (df.select([F.col(c).alias(c if c in keys else f"{c}_{s}") for c in df.columns]) for s in "ab")
    surer = (F.col(f"{confidence}_b") > F.col(f"{confidence}_a")) | (F.col(f"{confidence}_b") == F.col(f"{confidence}_a")) & (F.col(f"{ident}_b") < F.col(f"{ident}_a"))
    gone = a.join(b, list(keys)).where((F.col(f"{label}_a") != F.col(f"{label}_b")) & surer & overlaps("a", "b")).select(*keys, F.col(f"{ident}_a").alias(ident)).distinct()
    return df.join(gone, [*keys, ident], "left_anti")


def minmax(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns scaled to 0..1 by their range; constant ones stay. The one row of ranges is joined, so no window over all."""
    bounds = df.agg(*[f(c).alias(f"_{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))])
    out = df.crossJoin(F.broadcast(bounds))
    for c in columns:
        lo, hi = F.col(f"_lo_{c}"), F.col(f"_hi_{c}")
        out = out.withColumn(c, F.when(hi > lo, (F.col(c) - lo) / (hi - lo)).otherwise(F.col(c)))
    return out.drop(*[f"_{n}_{c}" for c in columns for n in ("lo", "hi")])


def per_class(df: DataFrame, truth: str, predicted: str, labels: DataFrame, label: str = "label") -> DataFrame:
    """Precision, recall, F1 and support of every label of the domain, 0 where there is nothing to divide by."""
    n = df.groupBy(F.col(truth).alias("_t"), F.col(predicted).alias("_p")).count()
    t = n.groupBy(F.col("_t").alias(label)).agg(F.sum("count").alias("support"), F.sum(F.when(F.col("_t") == F.col("_p"), F.col("count")).otherwise(0)).alias("tp"))
    p = n.groupBy(F.col("_p").alias(label)).agg(F.sum("count").alias("n_predicted"))
    out = labels.select(label).join(t, label, "left").join(p, label, "left").na.fill(0)
    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    out = out.withColumn("precision", ratio("tp", "n_predicted")).withColumn("recall", ratio("tp", "support"))
    both = F.col("precision") + F.col("recall")
    return out.withColumn("f1", F.when(both > 0, 2 * F.col("precision") * F.col("recall") / both).otherwise(F.lit(0.0))).select(label, "precision", "recall", "f1", "support")


def error_rate(df: DataFrame, truth: str, read: str, keys: Sequence[str]) -> DataFrame:
    """Edits over characters, and how many reads are right."""
    return df.groupBy(*keys).agg((F.sum(F.levenshtein(truth, read)) / F.sum(F.length(truth))).alias("cer"), F.sum((F.col(truth) == F.col(read)).cast("long")).alias("n_right"), F.count(F.lit(1)).alias("n"))


def interval_join(points: DataFrame, spans: DataFrame, keys: Sequence[str], at: str, low: str, high: str, cell: int) -> DataFrame:
    """Points inside spans (both ends included). Spans are laid out in cells of ``cell`` units, so the join is on equal keys."""
    s = spans.withColumn("_cell", F.explode(F.sequence(F.floor(F.col(low) / cell), F.floor(F.col(high) / cell))))
    p = points.withColumn("_cell", F.floor(F.col(at) / cell))
    return p.join(s, [*keys, "_cell"]).where(F.col(at).between(F.col(low), F.col(high))).drop("_cell")


def power_targets(counts: DataFrame, label: str, n: str, alpha: float, cap: int = 2) -> DataFrame:
    """Sampling targets min(n, max(1, round(n^alpha))), the largest class at most ``cap`` times the second's target."""
    t = counts.withColumn("target", F.least(F.col(n), F.greatest(F.lit(1), F.bround(F.pow(F.col(n), F.lit(alpha))).cast("long"))))
    w = Window.orderBy(F.desc(n), label)
    t = t.withColumn("_r", F.row_number().over(w)).withColumn("_next", F.lead("target").over(w))
    return t.withColumn("target", F.when(F.col("_r") == 1, F.least("target", F.coalesce(cap * F.col("_next"), F.col("target")))).otherwise(F.col("target"))).drop("_r", "_next")


def sampled(df: DataFrame, targets: DataFrame, label: str, ident: str, seed: str = "s") -> DataFrame:
    """Per label as many rows as its target, in the order of a seeded hash: the same rows on every run."""
    w = Window.partitionBy(label).orderBy(F.md5(F.concat_ws(":", F.lit(seed), F.col(ident).cast("string"))), ident)
    return df.withColumn("_n", F.row_number().over(w)).join(F.broadcast(targets.select(label, "target")), label).where(F.col("_n") <= F.col("target")).drop("_n", "target")


def document_split(rows: DataFrame, doc: str, label: str, most: int, seed: str = "s") -> DataFrame:
    """``part`` test or train: only documents of a single row may be tested, per label at most half of its rows or ``most``."""
    single = F.count(F.lit(1)).over(Window.partitionBy(doc)) == 1
    d = rows.withColumn("_single", single).withColumn("_quota", F.least(F.floor(F.count(F.lit(1)).over(Window.partitionBy(label)) / 2), F.lit(most)))
    w = Window.partitionBy(label, "_single").orderBy(F.md5(F.concat_ws(":", F.lit(seed), F.col(doc).cast("string"))), doc)
    return d.withColumn("_n", F.row_number().over(w)).withColumn("part", F.when(F.col("_single") & (F.col("_n") <= F.col("_quota")), "test").otherwise("train")).drop("_single", "_quota", "_n")


def multilabel(df: DataFrame, probabilities: str, labels: str, thresholds: Sequence[float]) -> DataFrame:
    """``threshold, class`` (from 0) with tp, tn, fp, fn, precision, recall, f1, accuracy; 0 where there is nothing to divide by."""
    each = df.select(F.posexplode(F.arrays_zip(F.col(probabilities).alias("p"), F.col(labels).alias("l"))).alias("class", "v")).withColumn("threshold", F.explode(F.array(*[F.lit(float(t)) for t in thresholds])))
    said, true = F.col("v.p") >= F.col("threshold"), F.col("v.l") == 1
    g = each.groupBy("threshold", "class").agg(F.count_if(said & true).alias("tp"), F.count_if(~said & ~true).alias("tn"), F.count_if(said & ~true).alias("fp"), F.count_if(~said & true).alias("fn"))
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    g = g.withColumns({"precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn), "accuracy": ratio(tp + tn, tp + tn + fp + fn)})
    return g.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def macro(metrics: DataFrame, n_classes: int) -> DataFrame:
    """Means of multilabel() over all classes but the last, which is padding."""
    return metrics.where(F.col("class") < n_classes - 1).groupBy("threshold").agg(*[F.avg(c).alias(c) for c in ("precision", "recall", "f1", "accuracy")])


def whole_positions(df: DataFrame, column: str, most: int = 1000) -> DataFrame:
    """Positions as whole numbers from 0 to ``most`` - 1 or the greatest position, whichever is less; halves to the even."""
    top = df.agg(F.max(column).alias("_top"))
    return df.crossJoin(F.broadcast(top)).withColumn(column, F.bround(F.col(column) / F.col("_top") * F.least(F.col("_top"), F.lit(most - 1))).cast("long")).drop("_top")


def notes(df: DataFrame, keys: Sequence[str], order: str, field: str, text: str, confidence: str) -> DataFrame:
    """``note``: a line "field: text (0.00)" for each piece of evidence, in order, repeated ones once."""
    line = F.format_string("%s: %s (%.2f)", F.col(field), F.col(text), F.col(confidence))
    said = F.transform(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("line")))), lambda x: x["line"])
    return df.groupBy(*keys).agg(F.array_join(F.array_distinct(said), "\n").alias("note"))


def years_within(first: Column, last: Column, from_year: int | None, to_year: int | None) -> Column:
    """Known years inside the bounds, both included; without bounds any known years."""
    out = first.isNotNull() & last.isNotNull()
    out = out if from_year is None else out & (first >= from_year)
    return F.coalesce(out if to_year is None else out & (last <= to_year), F.lit(False))


def matched_counts(df: DataFrame, label: str, matched: Column) -> DataFrame:
    """``label, matched, total``."""
    return df.groupBy(label).agg(F.count_if(matched).alias("matched"), F.count(F.lit(1)).alias("total"))
