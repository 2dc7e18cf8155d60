"""Mixing sources to target weights by Pareto order sampling, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import bounded, n_words, stable

#: Uniform numbers come from so many hexadecimal digits of an MD5: exact in a double.
DIGITS = 13


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """``source, source_size, docs, target``: each source's share of all words by weight, at most ``most`` times its size.

    Sources weigh ``weights`` in turn, by code point with null last. What a capped source leaves is shared again by
    weight, which ends at the one level L for which the sum of least(cap, L * weight) is the whole. The windows here
    have one row for each source, not for each document; an empty table gives none.
    """
    src = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    src = src.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn % len(weights) + 1).cast("int")))
    every = Window.partitionBy()
    src = src.withColumn("cap", most * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(by_ratio), F.lit(0))
    weight_left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(by_ratio), F.lit(0))
    src = src.withColumn("left", left).withColumn("weight_left", weight_left)
    src = src.withColumn("holds", F.col("left") * F.col("weight") <= F.col("cap") * F.col("weight_left"))
    first = F.min(F.when(F.col("holds"), F.struct(F.col("cap") / F.col("weight"), "left", "weight_left"))).over(every)
    src = src.withColumn("level", first)
    even = F.col("level.left") * F.col("weight") / F.col("level.weight_left")
    return src.select("source", "source_size", "docs", F.when(F.col("level").isNull(), F.col("cap").cast("double")).otherwise(F.least(F.col("cap").cast("double"), even)).alias("target"))


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", seed: str = "mix", most: int = 3, bucket_docs: int = 1024, row: str | None = None) -> DataFrame:
    """How many words, repeats counted, the mix takes of each document: ``key, size, source_size, target, copies, taken``.

    With r the target over the source's size, every document gets floor(r) whole copies for certain. The words that
    are still missing come from a Pareto order sample: u is a uniform number from a hash of the key, p the fractional
    part of r, and documents are taken whole in the order of u/(1-u) / (p/(1-p)) until the missing words are reached;
    the last one is taken if that ends nearer to them. One closing exchange for each source, of the document whose
    size is nearest to what is still wrong, brings its words close to the target. Inclusion probabilities differ
    between sources; the sample's size in words is fixed.

    Null texts have size 0; a null source is a source; rows of one key are separate documents with the same u, in the
    order of a hash of their text, and alike rows in any order; where the key is null u comes from that hash. Other columns
    are left out, but for ``row``, a column that tells rows apart; an empty table gives an empty one. Reruns agree.
    Order sums use buckets of u of bounded size, so that no source, however large, is sorted in one task.
    """
    own = [F.col(row).alias("of")] if row else []
    sizes = stable(docs.select(F.col(key).alias("key"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"), F.xxhash64(text).alias("tie"), *own), "sizes")
    src = stable(targets(sizes, most=most), "targets")
    n_sources = src.count()
    src = src.withColumn("ratio", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
    src = src.withColumn("whole", F.least(F.floor("ratio"), F.lit(most)).cast("long")).withColumn("missing", F.col("target") - F.col("whole") * F.col("source_size"))
    src = src.withColumn("p", F.col("ratio") - F.col("whole")).withColumn("buckets", F.ceil(F.col("docs") / bucket_docs))
    src = src.withColumnRenamed("source", "its")
    u = (F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("key").cast("string"), F.col("tie").cast("string")))), 1, DIGITS), 16, 10).cast("double") + 0.5) / float(16**DIGITS)
    d = sizes.withColumn("u", u).join(bounded(src, n_sources, 200), F.col("source").eqNullSafe(F.col("its"))).drop("its")
    odds = (F.col("u") / (1 - F.col("u"))) * (1 - F.col("p")) / F.col("p")
    d = d.withColumn("rank", F.when(F.col("p") > 0, odds).otherwise(F.col("u"))).withColumn("bucket", F.floor(F.col("u") * F.col("buckets")))
    in_bucket = Window.partitionBy("source", "bucket").orderBy("rank", "key", "size", "tie")
    d = d.withColumn("row", F.row_number().over(in_bucket)).withColumn("sum", F.sum("size").over(in_bucket.rowsBetween(Window.unboundedPreceding, 0)))
    sums = d.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    sums = sums.withColumn("before", F.sum("words").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("words"))
    sums = sums.select(F.col("source").alias("its"), F.col("bucket").alias("nth"), "before")
    d = d.join(sums, F.col("source").eqNullSafe(F.col("its")) & (F.col("bucket") == F.col("nth"))).drop("its", "nth")
    end = F.col("before") + F.col("sum")
    d = d.withColumn("extra", (F.col("whole") < most) & (end - F.col("missing") < F.col("missing") - (end - F.col("size"))))
    d = stable(d.select("key", "source", "size", "source_size", "target", "whole", "missing", "rank", "bucket", "row", "extra", *(["of"] if row else [])), "drawn")

    wrong = d.groupBy("source").agg(F.sum(F.when(F.col("extra"), F.col("size")).otherwise(0)).alias("drawn"), F.first("missing").alias("missing"))
    wrong = wrong.select(F.col("source").alias("its"), (F.col("missing") - F.col("drawn")).alias("gap"))
    signed = F.when(F.col("extra"), -F.col("size")).otherwise(F.col("size"))
    swap = d.where(F.col("whole") < most).join(bounded(wrong, n_sources, 100), F.col("source").eqNullSafe(F.col("its")))
    swap = swap.withColumn("after", F.abs(F.col("gap") - signed)).where(F.col("after") < F.abs(F.col("gap")))
    swap = swap.groupBy("source").agg(F.min(F.struct("after", "rank", "key", "bucket", "row")).alias("s"))
    swap = swap.select(F.col("source").alias("its"), F.col("s.bucket").alias("b"), F.col("s.row").alias("r"))
    d = d.join(bounded(swap, n_sources, 100), F.col("source").eqNullSafe(F.col("its")), "left")
    taken = F.col("extra") != F.coalesce((F.col("b") == F.col("bucket")) & (F.col("r") == F.col("row")), F.lit(False))
    copies = F.col("whole") + taken.cast("long")
    return d.select(*([F.col("of").alias(row)] if row else []), F.col("key").alias(key), "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


#: The same result in SQL, without buckets.
ORACLE = rf"""
WITH sizes AS (SELECT doc_id AS key, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, [1, 2, 3][(row_number() OVER (ORDER BY source COLLATE C NULLS LAST) - 1) % 3 + 1] AS weight FROM sizes GROUP BY source),
run AS (SELECT *, 3 * source_size AS cap,
    sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER w, 0) AS left_, sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS weight_left
  FROM src WINDOW w AS (ORDER BY 3 * source_size / CAST(weight AS DOUBLE), source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lev AS (SELECT left_ AS l, weight_left AS wl FROM run WHERE left_ * weight <= cap * weight_left ORDER BY cap / CAST(weight AS DOUBLE), left_, weight_left LIMIT 1),
tgt AS (SELECT source, source_size, coalesce(least(CAST(cap AS DOUBLE), (SELECT CAST(l AS DOUBLE) FROM lev) * weight / (SELECT CAST(wl AS DOUBLE) FROM lev)), cap) AS target FROM run),
part AS (SELECT *, CAST(least(floor(CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END), 3) AS BIGINT) AS whole FROM tgt),
d AS (SELECT s.key, s.size, p.*, target - whole * source_size AS missing, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END - whole AS p,
    (CAST(('0x' || substr(md5('mix:' || s.key), 1, {DIGITS})) AS BIGINT)::DOUBLE + 0.5) / {16**DIGITS}.0 AS u
  FROM sizes s JOIN part p ON s.source IS NOT DISTINCT FROM p.source),
o AS (SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) * (1 - p) / p ELSE u END AS rank FROM d),
c AS (SELECT *, CAST(sum(size) OVER (PARTITION BY source ORDER BY rank, key, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS end_ FROM o),
x AS (SELECT *, whole < 3 AND end_ - missing < missing - (end_ - size) AS extra FROM c),
g AS (SELECT *, any_value(missing) OVER (PARTITION BY source) - sum(CASE WHEN extra THEN size ELSE 0 END) OVER (PARTITION BY source) AS gap FROM x),
s AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY CASE WHEN whole < 3 THEN abs(gap - CASE WHEN extra THEN -size ELSE size END) END NULLS LAST, rank, key) AS nth,
    abs(gap - CASE WHEN extra THEN -size ELSE size END) AS after FROM g)
SELECT key AS doc_id, size, source_size, target, whole + CAST(extra <> (nth = 1 AND whole < 3 AND after < abs(gap)) AS BIGINT) AS copies,
  (whole + CAST(extra <> (nth = 1 AND whole < 3 AND after < abs(gap)) AS BIGINT)) * size AS taken FROM s
"""
