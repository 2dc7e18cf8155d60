"""The library's operators applied to the supplied tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quire.functions import geometry, numerals, text
from quire.operators import assignment, binding, rank, relations, sequences, trees
from quire.plans.catalogue import query
from quire.sources import catalogue as sources
from quire.streaming import worker


def read(spark, sf_dir, name, *columns):
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


@query("best_candidate_per_group", """
SELECT l_orderkey, l_linenumber, l_partkey, score FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, round(0.65 * (1 - l_linenumber / 7.0) + 0.35 * (1 - l_discount), 9) AS score,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY round(0.65 * (1 - l_linenumber / 7.0) + 0.35 * (1 - l_discount), 9) DESC, l_linenumber, l_partkey, l_suppkey, l_quantity) AS rn
  FROM lineitem) WHERE rn = 1""")
def best_candidate_per_group(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount")
    score = F.round(0.65 * (1 - F.col("l_linenumber") / 7.0) + 0.35 * (1 - F.col("l_discount")), 9)
    best = rank.arg_max(li.withColumn("score", score), ["l_orderkey"], [F.desc("score"), "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"])
    return best.select("l_orderkey", "l_linenumber", "l_partkey", "score")


LINES = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount")


@query("edge_band_filter", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM (SELECT *, l_linenumber / CAST(max(l_linenumber) OVER (PARTITION BY l_orderkey) AS DOUBLE) AS p FROM lineitem)
WHERE least(p, 1 - p) <= 0.15""")
def edge_band_filter(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem", *LINES)
    most = F.max("l_linenumber").over(Window.partitionBy("l_orderkey"))
    return li.withColumn("d", geometry.edge_distance(F.col("l_linenumber"), most)).where("d <= 0.15").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


@query("containment_filter", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_linenumber * 100 + l_quantity * 4 <= 800 AND l_discount * 1000 + 20 <= 100""")
def containment_filter(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem", *LINES)
    ok = geometry.contained(F.col("l_linenumber") * 100.0, F.col("l_discount") * 1000, F.col("l_quantity") * 4, F.lit(20.0), F.lit(800.0), F.lit(100.0))
    return li.where(ok).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("usable_rows", "SELECT doc_id, lang, source FROM documents WHERE text IS NOT NULL AND trim(text) <> '' AND n_chars > 100 AND lang IN ('en', 'de')")
def usable_rows(spark, sf_dir):
    return binding.usable(_regions(spark, sf_dir)).select("doc_id", "lang", "source")


def _regions(spark, sf_dir):
    """Documents as regions; those of other languages or too few characters have no words."""
    matched = (F.col("n_chars") > 100) & F.col("lang").isin("en", "de")
    return read(spark, sf_dir, "documents").select("doc_id", "lang", "source", F.col("text").alias("alto_text"), matched.alias("matched"), *[F.lit(1.0).alias(c) for c in ("x", "y", "width", "height", "confidence")])


@query("rejected_rows", "SELECT doc_id, lang, source FROM documents WHERE NOT coalesce(text IS NOT NULL AND trim(text) <> '' AND n_chars > 100 AND lang IN ('en', 'de'), false)")
def rejected_rows(spark, sf_dir):
    return _regions(spark, sf_dir).where(~binding.is_usable()).select("doc_id", "lang", "source")


ROUTES = {"click": ("volume", "max"), "view": ("issue", "append"), "purchase": ("volume", "append"), "error": ("both", "max")}


@query("label_dimension_join", """
SELECT target, rule, count(*) AS n FROM events JOIN (VALUES ('click', 'volume', 'max'), ('view', 'issue', 'append'), ('purchase', 'volume', 'append'), ('error', 'both', 'max')) r(event_type, target, rule) USING (event_type) GROUP BY ALL""")
def label_dimension_join(spark, sf_dir):
    return relations.routed(read(spark, sf_dir, "events", "event_type"), ROUTES, "event_type").groupBy("target", "rule").agg(F.count(F.lit(1)).alias("n"))


@query("hierarchy_flag", """
SELECT user_id, CASE WHEN bool_or(event_type = 'purchase') THEN 'periodical' WHEN bool_or(event_type IN ('error', 'signup')) THEN 'multipart' ELSE 'monograph' END AS hierarchy FROM events GROUP BY user_id""")
def hierarchy_flag(spark, sf_dir):
    kind = F.col("event_type")
    label = F.when(kind == "purchase", "PeriodicalVolumePartNumber").when(kind.isin("error", "signup"), "PartNumber").otherwise("Title")
    regions = read(spark, sf_dir, "events").select(F.col("user_id").alias("page_key"), label.alias("label"), F.lit(True).alias("matched"), F.lit("x").alias("alto_text"), *[F.lit(1.0).alias(c) for c in ("x", "y", "width", "height", "confidence")])
    return binding.hierarchy(regions).select(F.col("page_key").alias("user_id"), "hierarchy")


@query("collect_in_order", "SELECT conv_id, string_agg(text, ' | ' ORDER BY turn, text) AS dialogue FROM conversations GROUP BY conv_id")
def collect_in_order(spark, sf_dir):
    c = relations.collected(read(spark, sf_dir, "conversations", "conv_id", "turn", "text"), ["conv_id"], "turn", "text")
    return c.select("conv_id", F.array_join("items", " | ").alias("dialogue"))


@query("neighbours", """
SELECT conv_id, turn, lag(turn) OVER w AS previous, lead(turn) OVER w AS next, CAST(row_number() OVER w - 1 AS INTEGER) AS n_before, count(*) OVER (PARTITION BY conv_id) - row_number() OVER w AS n_after,
 coalesce((row_number() OVER w - 1) / nullif(count(*) OVER (PARTITION BY conv_id) - 1, 0), 0.0) AS relative FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def neighbours(spark, sf_dir):
    return sequences.neighbours(read(spark, sf_dir, "conversations", "conv_id", "turn"), ["conv_id"], ["turn"], "turn")


@query("islands_gap", """
SELECT user_id, CAST(island AS BIGINT) AS island, min(event_id) AS first_id, max(event_id) AS last_id, count(*) AS n FROM (
 SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS island FROM (
  SELECT user_id, event_id, CASE WHEN event_id - lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) > 40 THEN 1 ELSE 0 END AS new FROM events)) GROUP BY user_id, island""")
def islands_gap(spark, sf_dir):
    e = sequences.islands(read(spark, sf_dir, "events", "user_id", "event_id"), ["user_id"], ["event_id"], F.col("event_id"), 40)
    return e.groupBy("user_id", "island").agg(F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"), F.count(F.lit(1)).alias("n"))


@query("islands_suffix", """
SELECT user_id, event_id FROM (SELECT *, min(CASE WHEN event_type = 'purchase' THEN event_id END) OVER (PARTITION BY user_id) AS f FROM events) WHERE f IS NULL OR event_id >= f""")
def islands_suffix(spark, sf_dir):
    return sequences.suffix_from_first(read(spark, sf_dir, "events", "user_id", "event_id", "event_type"), ["user_id"], "event_id", F.col("event_type") == "purchase").select("user_id", "event_id")


@query("best_island", """
WITH i AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS island FROM (
  SELECT *, CASE WHEN event_id - lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) > 40 THEN 1 ELSE 0 END AS new FROM events)),
g AS (SELECT user_id, island, bool_or(event_type = 'purchase') AS kw, sum(CAST(event_type = 'click' AS INTEGER)) AS score, count(*) AS n, min(event_id) AS start FROM i GROUP BY user_id, island)
SELECT user_id, CAST(island AS BIGINT) AS island, n, start FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY kw DESC, score DESC, n, start) AS rn FROM g) WHERE rn = 1""")
def best_island(spark, sf_dir):
    e = sequences.islands(read(spark, sf_dir, "events", "user_id", "event_id", "event_type"), ["user_id"], ["event_id"], F.col("event_id"), 40)
    g = e.groupBy("user_id", "island").agg(F.bool_or(F.col("event_type") == "purchase").alias("kw"), F.sum((F.col("event_type") == "click").cast("int")).alias("score"), F.count(F.lit(1)).alias("n"), F.min("event_id").alias("start"))
    return rank.arg_max(g, ["user_id"], [F.desc("kw"), F.desc("score"), "n", "start"]).select("user_id", "island", "n", "start")


@query("forward_fill", """
SELECT user_id, event_id, coalesce(last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING), 1.0) AS level FROM events""")
def forward_fill(spark, sf_dir):
    e = read(spark, sf_dir, "events", "user_id", "event_id", "event_type", "value")
    return sequences.forward_fill(e, ["user_id"], ["event_id"], F.when(F.col("event_type") == "purchase", F.col("value")), "level", 1.0).select("user_id", "event_id", "level")


@query("asof_parent", """
SELECT user_id, event_id, coalesce(last_value(a IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING), first_value(a IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS parent
FROM (SELECT *, CASE WHEN event_type = 'purchase' THEN event_id END AS a FROM events)""")
def asof_parent(spark, sf_dir):
    e = read(spark, sf_dir, "events", "user_id", "event_id", "event_type")
    return sequences.positional_parent(e, ["user_id"], ["event_id"], F.when(F.col("event_type") == "purchase", F.col("event_id")), "parent").select("user_id", "event_id", "parent")


@query("surrounding_anchor", """
SELECT user_id, event_id, last_value(a IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS anchor_before,
 first_value(a IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS anchor_after
FROM (SELECT *, CASE WHEN event_type = 'purchase' THEN event_id END AS a FROM events)""")
def surrounding_anchor(spark, sf_dir):
    e = read(spark, sf_dir, "events", "user_id", "event_id", "event_type")
    return sequences.surrounding(e, ["user_id"], ["event_id"], F.when(F.col("event_type") == "purchase", F.col("event_id"))).select("user_id", "event_id", "anchor_before", "anchor_after")


@query("range_window_density", "SELECT user_id, event_id, count(*) OVER (PARTITION BY user_id ORDER BY event_id RANGE BETWEEN CURRENT ROW AND 100 FOLLOWING) AS in_window FROM events")
def range_window_density(spark, sf_dir):
    return sequences.density(read(spark, sf_dir, "events", "user_id", "event_id"), ["user_id"], "event_id", 100)


@query("covered_rows", """
SELECT user_id, event_id, max(CASE WHEN n >= 4 THEN event_id END) OVER (PARTITION BY user_id ORDER BY event_id RANGE BETWEEN 100 PRECEDING AND CURRENT ROW) IS NOT NULL AS covered
FROM (SELECT user_id, event_id, count(*) OVER (PARTITION BY user_id ORDER BY event_id RANGE BETWEEN CURRENT ROW AND 100 FOLLOWING) AS n FROM events)""")
def covered_rows(spark, sf_dir):
    d = sequences.density(read(spark, sf_dir, "events", "user_id", "event_id"), ["user_id"], "event_id", 100)
    return sequences.covered(d, ["user_id"], "event_id", 100, F.col("in_window") >= 4).drop("in_window")


@query("median_envelope", """
SELECT l_partkey, median(l_quantity) AS mid, min(l_quantity) AS low, max(l_quantity) AS high, round(least(0.02 * 1000, greatest(0.5 * median(l_quantity), 0.005 * 1000)), 6) AS tolerance FROM lineitem GROUP BY l_partkey""")
def median_envelope(spark, sf_dir):
    g = read(spark, sf_dir, "lineitem", "l_partkey", "l_quantity").groupBy("l_partkey").agg(F.median("l_quantity").alias("mid"), F.min("l_quantity").alias("low"), F.max("l_quantity").alias("high"))
    return g.withColumn("tolerance", F.round(geometry.clamp(0.5 * F.col("mid"), F.lit(5.0), F.lit(20.0)), 6))


@query("even_chunks", """
SELECT o_custkey, o_orderkey, chunk, CAST(row_number() OVER (PARTITION BY o_custkey, chunk ORDER BY o_orderkey) AS INTEGER) AS in_chunk FROM (SELECT o_custkey, o_orderkey, CAST(ntile(3) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS INTEGER) AS chunk FROM orders)""")
def even_chunks(spark, sf_dir):
    return sequences.even_chunks(read(spark, sf_dir, "orders", "o_custkey", "o_orderkey"), ["o_custkey"], ["o_orderkey"], 3)


@query("interval_end", """
WITH o AS (SELECT o_custkey, o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS depth, o_orderkey // 2 AS start FROM orders)
SELECT o_custkey, o_orderkey, depth, start, coalesce((SELECT CASE WHEN count(*) > 0 THEN greatest(o.start, arg_min(n.start, n.o_orderkey) - 1) END FROM o n WHERE n.o_custkey = o.o_custkey AND n.o_orderkey > o.o_orderkey AND n.depth <= o.depth), 99999999) AS "end" FROM o""")
def interval_end(spark, sf_dir):
    o = read(spark, sf_dir, "orders", "o_custkey", "o_orderkey", "o_orderpriority")
    o = o.select("o_custkey", "o_orderkey", F.substring("o_orderpriority", 1, 1).cast("int").alias("depth"), F.floor(F.col("o_orderkey") / 2).alias("start"), F.lit(99999999).cast("long").alias("last"))
    return sequences.interval_end(o, ["o_custkey"], "o_orderkey", "depth", "start", "last")


@query("nested_fallback_choice", """
SELECT p_brand, p_partkey FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY CASE WHEN p_size >= 45 THEN 0 ELSE 1 END, CASE WHEN p_size >= 45 THEN -p_size ELSE 0 END, p_retailprice DESC, p_partkey) AS rn FROM part) WHERE rn = 1""")
def nested_fallback_choice(spark, sf_dir):
    strong = F.col("p_size") >= 45
    return rank.arg_max(read(spark, sf_dir, "part"), ["p_brand"], [F.when(strong, 0).otherwise(1), F.when(strong, -F.col("p_size")).otherwise(0), F.desc("p_retailprice"), "p_partkey"]).select("p_brand", "p_partkey")


@query("upsert_higher_confidence", """
SELECT c_custkey, CASE WHEN s_acctbal > c_acctbal THEN s_name ELSE c_name END AS name, CASE WHEN s_acctbal > c_acctbal THEN s_acctbal ELSE c_acctbal END AS conf FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey""")
def upsert_higher_confidence(spark, sf_dir):
    old = read(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("name"), F.col("c_acctbal").alias("conf"))
    new = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("conf"))
    return relations.upsert(old, new, "c_custkey", "name", "conf")


@query("upsert_always", "SELECT c_custkey, coalesce(s_name, c_name) AS name FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey")
def upsert_always(spark, sf_dir):
    old = read(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("name"))
    return relations.upsert(old, read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("name")), "c_custkey", "name")


@query("group_rank_by_evidence", """
WITH g AS (SELECT source, lang, count(*) AS n_detections, CAST(sum(CAST(n_chars > 2000 AS INTEGER)) AS BIGINT) AS n_matched, bool_or(n_chars > 6000) AS titled FROM documents GROUP BY source, lang)
SELECT source, lang, n_detections, n_matched FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY titled DESC, n_matched DESC, n_detections DESC, lang) AS rn FROM g) WHERE rn = 1""")
def group_rank_by_evidence(spark, sf_dir):
    d = read(spark, sf_dir, "documents", "source", "lang", "n_chars")
    g = d.groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n_detections"), F.sum((F.col("n_chars") > 2000).cast("int")).alias("n_matched"), F.bool_or(F.col("n_chars") > 6000).alias("titled"))
    return rank.arg_max(g, ["source"], [F.desc("titled"), F.desc("n_matched"), F.desc("n_detections"), "lang"]).drop("titled")


@query("evidence_gc", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def evidence_gc(spark, sf_dir):
    owners = read(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return relations.collect_garbage(read(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), owners, ["l_orderkey"])


@query("number_join_cardinality", """
SELECT k, n_left, n_right, CASE WHEN n_left = 1 AND n_right = 1 THEN '1:1' WHEN n_left = 1 THEN '1:n' WHEN n_right = 1 THEN 'n:1' ELSE 'n:m' END AS branch FROM
 (SELECT o_custkey AS k, count(*) AS n_left FROM orders GROUP BY 1) JOIN (SELECT l_partkey AS k, count(*) AS n_right FROM lineitem GROUP BY 1) USING (k)""")
def number_join_cardinality(spark, sf_dir):
    left = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"))
    return relations.cardinality(left, read(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("k")), "k")


@query("fuzzy_title_join", """
WITH a AS (SELECT DISTINCT p_name AS a FROM part), b AS (SELECT DISTINCT split_part(p_name, ' ', 2) || ' ' || split_part(p_name, ' ', 1) AS b FROM part)
SELECT a, b, levenshtein(a, b) AS d FROM a, b WHERE abs(length(a) - length(b)) <= 4 AND levenshtein(a, b) <= 4""")
def fuzzy_title_join(spark, sf_dir):
    a = read(spark, sf_dir, "part").select(F.col("p_name").alias("a")).distinct()
    w = F.split("a", " ")
    b = a.select(F.concat_ws(" ", F.get(w, 1), F.get(w, 0)).alias("b")).distinct()
    near = a.withColumn("len", F.explode(F.sequence(F.length("a") - 4, F.length("a") + 4))).join(b.withColumn("len", F.length("b")), "len")
    return near.select("a", "b", F.levenshtein("a", "b").alias("d")).where("d <= 4")


@query("text_normalise", """
SELECT doc_id, trim(regexp_replace(strip_accents(lower(trim(text))), '[^\\p{L}\\p{N}_]+', ' ', 'g')) AS norm, CAST(length(regexp_replace(text, '[^\\p{Lu}]', '', 'g')) AS INTEGER) AS n_upper, CAST(length(regexp_replace(text, '[^0-9]', '', 'g')) AS INTEGER) AS n_digit FROM documents""")
def text_normalise(spark, sf_dir):
    f = text.features(F.col("text"))
    return read(spark, sf_dir, "documents").select("doc_id", text.normalise(F.col("text")).alias("norm"), f["n_upper"].alias("n_upper"), f["n_digit"].alias("n_digit"))


@query("roman_numerals", "SELECT CAST(n AS INTEGER) AS n, CAST(n AS INTEGER) AS back FROM (SELECT DISTINCT o_orderkey % 3999 + 1 AS n FROM orders)")
def roman_numerals(spark, sf_dir):
    n = read(spark, sf_dir, "orders").select((F.col("o_orderkey") % 3999 + 1).cast("int").alias("n")).distinct()
    return n.select("n", numerals.from_roman(numerals.to_roman(F.col("n"))).alias("back"))


@query("natural_sort", "SELECT c_custkey, CAST(row_number() OVER (ORDER BY CAST(regexp_extract(c_name, '[0-9]+') AS BIGINT), c_custkey) AS INTEGER) AS place FROM customer")
def natural_sort(spark, sf_dir):
    c = read(spark, sf_dir, "customer", "c_custkey", "c_name")
    return c.select("c_custkey", F.row_number().over(Window.orderBy(text.natural_key(F.col("c_name")), "c_custkey")).alias("place"))


@query("top_k_then_max", """
SELECT l_orderkey, max(l_extendedprice) AS tallest FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY abs(l_quantity - 25), l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem) WHERE rn <= 4 GROUP BY l_orderkey""")
def top_k_then_max(spark, sf_dir):
    best = rank.arg_max(read(spark, sf_dir, "lineitem", *LINES), ["l_orderkey"], [F.abs(F.col("l_quantity") - 25), "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], k=4)
    return best.groupBy("l_orderkey").agg(F.max("l_extendedprice").alias("tallest"))


@query("orphans", "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def orphans(spark, sf_dir):
    return relations.missing_in(read(spark, sf_dir, "customer", "c_custkey", "c_name"), read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query("allow_deny", "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY') AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def allow_deny(spark, sf_dir):
    c = read(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    o = read(spark, sf_dir, "orders", "o_orderkey", "o_custkey").join(c.where("c_mktsegment = 'MACHINERY'").select("o_custkey"), "o_custkey", "left_semi")
    return relations.replace_rows(o, c.where("c_acctbal < 0"), ["o_custkey"]).select("o_orderkey")


@query("full_outer_pairing", """
SELECT coalesce(a.k, b.k) AS k, a.k IS NOT NULL AS in_left, b.k IS NOT NULL AS in_right FROM (SELECT DISTINCT c_custkey AS k FROM customer) a FULL JOIN (SELECT DISTINCT o_custkey + 100 AS k FROM orders) b ON a.k = b.k""")
def full_outer_pairing(spark, sf_dir):
    return relations.pairing(read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), read(spark, sf_dir, "orders").select((F.col("o_custkey") + 100).alias("k")), "k")


@query("interval_join", """
SELECT e.event_id, l.lo FROM events e JOIN (SELECT user_id, min(event_id) AS lo, min(event_id) + 500 AS hi FROM events GROUP BY user_id) l ON e.user_id = l.user_id AND e.event_id BETWEEN l.lo AND l.hi""")
def interval_join(spark, sf_dir):
    e = read(spark, sf_dir, "events", "event_id", "user_id")
    spans = e.groupBy("user_id").agg(F.min("event_id").alias("lo")).withColumn("hi", F.col("lo") + 500)
    return relations.interval_join(e, spans, ["user_id"], "event_id", "lo", "hi", 250).select("event_id", "lo")


_BOX = {"x": "l_linenumber * 10.0", "y": "l_discount * 100", "w": "l_quantity", "h": "10.0"}


@query("iou_join", """
WITH b AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linenumber * 10.0 AS x, l_discount * 100 AS y, l_quantity AS w, 10.0 AS h FROM lineitem),
p AS (SELECT a.l_orderkey, a.l_partkey AS pa, b.l_partkey AS pb, greatest(least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x), 0) * greatest(least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y), 0) AS i, a.w * a.h + b.w * b.h AS s
 FROM b a JOIN b ON a.l_orderkey = b.l_orderkey AND a.l_returnflag = 'A' AND b.l_returnflag = 'R')
SELECT l_orderkey, pa, pb, round(i / (s - i), 6) AS iou FROM p WHERE i / (s - i) > 0.2""")
def iou_join(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag", *[F.expr(v).cast("double").alias(k) for k, v in _BOX.items()])
    side = lambda flag, s: li.where(F.col("l_returnflag") == flag).select("l_orderkey", F.col("l_partkey").alias(f"p{s}"), *[F.col(c).alias(f"{c}_{s}") for c in "xywh"])
    box = lambda s: {c: F.col(f"{c}_{s}") for c in "xywh"}
    j = side("A", "a").join(side("R", "b"), "l_orderkey").withColumn("iou", geometry.iou(box("a"), box("b")))
    return j.where("iou > 0.2").select("l_orderkey", "pa", "pb", F.round("iou", 6).alias("iou"))


@query("suppress_duplicates", """
WITH b AS (SELECT event_id, user_id, event_type AS label, value AS conf, event_id % 50 * 4.0 AS x FROM events)
SELECT event_id, user_id FROM b a WHERE NOT EXISTS (SELECT 1 FROM b s WHERE s.user_id = a.user_id AND s.label <> a.label AND (s.conf > a.conf OR s.conf = a.conf AND s.event_id < a.event_id) AND abs(s.x - a.x) <= 4.0)""")
def suppress_duplicates(spark, sf_dir):
    b = read(spark, sf_dir, "events").select("event_id", "user_id", F.col("event_type").alias("label"), F.col("value").alias("conf"), (F.col("event_id") % 50 * 4.0).alias("x"))
    return relations.suppress(b, ["user_id"], "event_id", "label", "conf", lambda p, q: F.abs(F.col(f"x_{p}") - F.col(f"x_{q}")) <= 4.0).select("event_id", "user_id")


@query("relational_division", """
SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT CASE WHEN l_returnflag IN ('A', 'R') THEN l_returnflag END) = 2 AND count(*) = 3""")
def relational_division(spark, sf_dir):
    return relations.containing_all(read(spark, sf_dir, "lineitem", "l_orderkey", "l_returnflag"), "l_orderkey", "l_returnflag", ["A", "R"], 3)


@query("latest_annotation_counts", """
SELECT event_type, count(*) AS n FROM events JOIN (SELECT user_id, max(event_id) AS event_id FROM events GROUP BY user_id) USING (user_id, event_id) GROUP BY event_type""")
def latest_annotation_counts(spark, sf_dir):
    return relations.latest(read(spark, sf_dir, "events", "user_id", "event_id", "event_type"), "user_id", "event_id").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("annotated_vs_total", """
SELECT c_mktsegment, count(*) AS total, count(o_orderkey) AS annotated FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'P') ON o_custkey = c_custkey GROUP BY c_mktsegment""")
def annotated_vs_total(spark, sf_dir):
    o = read(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return read(spark, sf_dir, "customer", "c_custkey", "c_mktsegment").join(o, "c_custkey", "left").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("total"), F.count("o_orderkey").alias("annotated"))


_TARGETS = """t AS (SELECT *, least(n, greatest(1, CAST(round_even(pow(n, 0.6), 0) AS BIGINT))) AS target0, row_number() OVER (ORDER BY n DESC, {0}) AS r FROM c),
u AS (SELECT {0}, n, CASE WHEN r = 1 THEN least(target0, coalesce(2 * lead(target0) OVER (ORDER BY n DESC, {0}), target0)) ELSE target0 END AS target FROM t)"""


@query("power_law_targets", f"WITH c AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1), {_TARGETS.format('event_type')} SELECT event_type, n, target FROM u")
def power_law_targets(spark, sf_dir):
    return relations.power_targets(read(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n")), "event_type", "n", 0.6)


@query("test_quota", "SELECT lang, least(count(*) // 2, 100) AS quota FROM documents GROUP BY lang")
def test_quota(spark, sf_dir):
    return read(spark, sf_dir, "documents", "lang").groupBy("lang").agg(F.least(F.floor(F.count(F.lit(1)) / 2), F.lit(100)).alias("quota"))


@query("stratified_sample", f"""
WITH c AS (SELECT lang, count(*) AS n FROM documents GROUP BY 1), {_TARGETS.format('lang')}
SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('s:' || doc_id), doc_id) AS rn FROM documents) JOIN u USING (lang) WHERE rn <= target""")
def stratified_sample(spark, sf_dir):
    d = read(spark, sf_dir, "documents", "doc_id", "lang")
    return relations.sampled(d, relations.power_targets(d.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "lang", "n", 0.6), "lang", "doc_id")


@query("class_caps", "SELECT doc_id, source, lang FROM (SELECT *, row_number() OVER (PARTITION BY source, lang ORDER BY md5('s:' || doc_id), doc_id) AS rn FROM documents) WHERE rn <= 3")
def class_caps(spark, sf_dir):
    return rank.arg_max(read(spark, sf_dir, "documents", "doc_id", "source", "lang"), ["source", "lang"], [F.md5(F.concat_ws(":", F.lit("s"), F.col("doc_id").cast("string"))), "doc_id"], k=3)


@query("doc_level_split", """
WITH r AS (SELECT o_orderkey, o_custkey % 700 AS doc, o_orderpriority AS label FROM orders),
q AS (SELECT *, count(*) OVER (PARTITION BY doc) = 1 AS single, least(count(*) OVER (PARTITION BY label) // 2, 100) AS quota FROM r),
n AS (SELECT *, row_number() OVER (PARTITION BY label, single ORDER BY md5('s:' || doc), doc) AS rn FROM q)
SELECT label, CASE WHEN single AND rn <= quota THEN 'test' ELSE 'train' END AS part, count(*) AS n FROM n GROUP BY ALL""")
def doc_level_split(spark, sf_dir):
    r = read(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 700).alias("doc"), F.col("o_orderpriority").alias("label"))
    return relations.document_split(r, "doc", "label", 100).groupBy("label", "part").agg(F.count(F.lit(1)).alias("n"))


@query("confusion_metrics", """
WITH d AS (VALUES (0), (1), (2)), l AS (SELECT quality AS t, 1 - toxic AS p FROM labels),
c AS (SELECT d.col0 AS label, (SELECT count(*) FROM l WHERE t = col0 AND p = col0) AS tp, (SELECT count(*) FROM l WHERE t = col0) AS support, (SELECT count(*) FROM l WHERE p = col0) AS np FROM d),
m AS (SELECT *, coalesce(tp / nullif(np, 0), 0) AS precision, coalesce(tp / nullif(support, 0), 0) AS recall FROM c)
SELECT label, round(precision, 9) AS precision, round(recall, 9) AS recall, round(coalesce(2 * precision * recall / nullif(precision + recall, 0), 0), 9) AS f1, support FROM m""")
def confusion_metrics(spark, sf_dir):
    l = read(spark, sf_dir, "labels").select(F.col("quality").alias("t"), (1 - F.col("toxic")).alias("p"))  # noqa: E741
    out = relations.per_class(l, "t", "p", spark.createDataFrame([(0,), (1,), (2,)], "label int"))
    return out.select("label", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("char_error_rate", """
SELECT p_brand, round(sum(levenshtein(p_name, replace(p_name, 'r', 'n'))) / sum(length(p_name)), 9) AS cer, sum(CAST(p_name = replace(p_name, 'r', 'n') AS BIGINT))::BIGINT AS n_right, count(*) AS n FROM part GROUP BY p_brand""")
def char_error_rate(spark, sf_dir):
    p = read(spark, sf_dir, "part", "p_brand", "p_name").withColumn("read", F.replace("p_name", F.lit("r"), F.lit("n")))
    return relations.error_rate(p, "p_name", "read", ["p_brand"]).withColumn("cer", F.round("cer", 9))


@query("minmax_normalise", """
SELECT l_orderkey, l_linenumber, round((l_quantity - (SELECT min(l_quantity) FROM lineitem)) / (SELECT max(l_quantity) - min(l_quantity) FROM lineitem), 9) AS l_quantity FROM lineitem""")
def minmax_normalise(spark, sf_dir):
    return relations.minmax(read(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_quantity"), ["l_quantity"]).withColumn("l_quantity", F.round("l_quantity", 9))


@query("monotonicity_score")
def monotonicity_score(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.substring("o_orderpriority", 1, 1).cast("int").alias("v"))
    g = relations.collected(o, ["o_custkey"], "o_orderkey", "v")
    return g.select("o_custkey", (sequences.monotonicity(F.col("items")) / F.size("items")).alias("score"))


def _tree(spark, sf_dir):
    """Region, nation and customer as one adjacency list."""
    r = read(spark, sf_dir, "region").select(F.concat(F.lit("r"), "r_regionkey").alias("id"), F.lit(None).cast("string").alias("parent"), F.lit("volume").alias("type"), F.col("r_regionkey").cast("long").alias("position"))
    n = read(spark, sf_dir, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("id"), F.concat(F.lit("r"), "n_regionkey").alias("parent"), F.when(F.col("n_nationkey") % 2 == 0, "issue").otherwise("volume").alias("type"), F.col("n_nationkey").cast("long").alias("position"))
    c = read(spark, sf_dir, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("id"), F.concat(F.lit("n"), "c_nationkey").alias("parent"), F.lit("page").alias("type"), F.col("c_custkey").alias("position"))
    return r.unionByName(n).unionByName(c)


_TREE = """t AS (SELECT 'r' || r_regionkey AS id, NULL AS parent, 'volume' AS type, CAST(r_regionkey AS BIGINT) AS position FROM region UNION ALL
 SELECT 'n' || n_nationkey, 'r' || n_regionkey, CASE WHEN n_nationkey % 2 = 0 THEN 'issue' ELSE 'volume' END, n_nationkey FROM nation UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, 'page', c_custkey FROM customer),
a(node, ancestor, depth) AS (SELECT id, parent, 1 FROM t WHERE parent IS NOT NULL UNION ALL SELECT a.node, t.parent, a.depth + 1 FROM a JOIN t ON t.id = a.ancestor WHERE t.parent IS NOT NULL)"""


@query("ancestors", f"WITH RECURSIVE {_TREE} SELECT node, ancestor, CAST(depth AS INTEGER) AS depth FROM a")
def ancestors(spark, sf_dir):
    return trees.ancestors(_tree(spark, sf_dir))


@query("lowest_groups", f"WITH RECURSIVE {_TREE} SELECT id FROM t WHERE type = 'issue' OR type = 'volume' AND id NOT IN (SELECT ancestor FROM a JOIN t s ON s.id = a.node WHERE s.type = 'issue')")
def lowest_groups(spark, sf_dir):
    return trees.lowest_groups(_tree(spark, sf_dir))


@query("outline", f"""WITH RECURSIVE {_TREE} SELECT id, CAST((SELECT count(*) FROM a JOIN t s ON s.id = a.ancestor WHERE a.node = t.id AND s.type <> 'issue') AS BIGINT) AS level,
 coalesce((SELECT string_agg(s.position, '/' ORDER BY a.depth DESC) || '/' FROM a JOIN t s ON s.id = a.ancestor WHERE a.node = t.id), '') || t.position AS path FROM t WHERE type <> 'issue'""")
def outline(spark, sf_dir):
    return trees.outline(_tree(spark, sf_dir), F.col("type") != "issue").select("id", F.col("level").cast("long").alias("level"), F.array_join(F.transform("path", lambda x: x.cast("string")), "/").alias("path"))


@query("prune_and_splice", f"WITH RECURSIVE {_TREE} SELECT id, (SELECT arg_min(a.ancestor, a.depth) FROM a JOIN t s ON s.id = a.ancestor WHERE a.node = t.id AND s.type <> 'issue') AS parent FROM t WHERE type <> 'issue'")
def prune_and_splice(spark, sf_dir):
    return trees.spliced(_tree(spark, sf_dir), F.col("type") != "issue")


@query("levels_to_parents", """
WITH o AS (SELECT o_custkey, o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS level FROM orders)
SELECT o_custkey, o_orderkey, level, (SELECT max(p.o_orderkey) FROM o p WHERE p.o_custkey = o.o_custkey AND p.o_orderkey < o.o_orderkey AND p.level < o.level) AS parent FROM o""")
def levels_to_parents(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.substring("o_orderpriority", 1, 1).cast("long").alias("level"))
    return trees.levels_to_parents(o, ["o_custkey"], "o_orderkey", "level")


@query("unpack_distinct", "SELECT DISTINCT id FROM (SELECT unnest([l_partkey, l_suppkey, CASE WHEN l_linenumber = 1 THEN l_orderkey END]) AS id FROM lineitem) WHERE id IS NOT NULL")
def unpack_distinct(spark, sf_dir):
    return relations.unpacked(read(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", F.when(F.col("l_linenumber") == 1, F.col("l_orderkey")).alias("o")), ["l_partkey", "l_suppkey", "o"])


@query("ledger_union", "SELECT o_custkey AS id FROM orders UNION SELECT c_custkey FROM customer")
def ledger_union(spark, sf_dir):
    return read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id")).union(read(spark, sf_dir, "customer").select("c_custkey")).distinct()


@query("json_props", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) IS NULL OR CAST(json_extract_string(props, '$.k') AS INTEGER) = 13)")
def json_props(spark, sf_dir):
    e = read(spark, sf_dir, "events", "event_id", "user_id", "props").withColumn("k", F.from_json("props", "k INT")["k"])
    good = e.groupBy("user_id").agg(F.bool_and(F.coalesce(F.col("k") != 13, F.lit(False))).alias("g")).where("g")
    return e.join(good, "user_id", "left_semi").select("event_id", "k")


@query("xml_record_parse", "SELECT n_nationkey, n_name AS title, 'Publisher ' || n_nationkey AS publisher, 'Praha' AS place, '19' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS date, 'Jan Novák' AS author, CAST(1900 + n_nationkey AS INTEGER) AS first_year FROM nation")
def xml_record_parse(spark, sf_dir):
    n = read(spark, sf_dir, "nation")
    date = F.concat(F.lit("19"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
    xml = F.concat(F.lit('<mods:modsCollection xmlns:mods="http://www.loc.gov/mods/v3"><mods:mods><mods:titleInfo><mods:title>--</mods:title></mods:titleInfo><mods:titleInfo usage="primary"><mods:title> '), F.col("n_name"), F.lit('</mods:title></mods:titleInfo><mods:name><mods:namePart>Jan</mods:namePart><mods:namePart type="date">1850</mods:namePart><mods:namePart>Novák</mods:namePart><mods:role><mods:roleTerm>aut</mods:roleTerm></mods:role></mods:name><mods:originInfo><mods:publisher>Publisher '), F.col("n_nationkey"), F.lit('</mods:publisher><mods:place><mods:placeTerm type="code">xr</mods:placeTerm><mods:placeTerm type="text">Praha</mods:placeTerm></mods:place><mods:dateIssued>'), date, F.lit('</mods:dateIssued></mods:originInfo><mods:originInfo eventType="manufacture"><mods:publisher>X</mods:publisher></mods:originInfo><mods:relatedItem type="series"><mods:titleInfo><mods:title>S</mods:title></mods:titleInfo></mods:relatedItem></mods:mods></mods:modsCollection>'))
    m = n.select("n_nationkey", sources.mods_struct(xml).alias("m"))
    o = F.get(sources.origins(F.col("m"), False), 0)
    return m.select("n_nationkey", F.get(sources.titles(F.col("m")), 0)["title"].alias("title"), o["publisher"].alias("publisher"), o["place"].alias("place"), o["date"].alias("date"), F.get(sources.names(F.col("m"), ("aut",)), 0).alias("author"), sources.year_range(o["date"])["first"].alias("first_year"))


@query("html_title", "SELECT page_id, regexp_extract(html, '<title>([^<]*)', 1) AS title, lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)) AS host FROM pages")
def html_title(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)", 1).alias("title"), F.lower(F.regexp_extract("url", "^[a-z]+://([^/?#:]+)", 1)).alias("host"))


@query("id_tree_explode", "SELECT 'd' || o_custkey AS doc, CAST(o_orderkey AS VARCHAR) AS page FROM orders")
def id_tree_explode(spark, sf_dir):
    o = read(spark, sf_dir, "orders", "o_custkey", "o_orderkey")
    line = F.concat(F.lit('{"d'), "o_custkey", F.lit('": ["'), F.array_join(F.transform(F.sort_array(F.collect_list("o_orderkey")), lambda x: x.cast("string")), '","'), F.lit('"]}'))
    return sources.id_tree(o.groupBy("o_custkey").agg(line.alias("line")), "line").select("doc", "page")


@query("dictionary_tag", "SELECT event_id, CASE event_type WHEN 'click' THEN 'C' WHEN 'view' THEN 'V' WHEN 'error' THEN 'E' WHEN 'purchase' THEN 'P' END AS tag FROM events")
def dictionary_tag(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", text.fuzzy_tag(F.concat(F.col("event_type"), F.lit("s")), {"click": "C", "view": "V", "error": "E", "purchase": "P"}).alias("tag"))


@query("percent_and_resize", "SELECT p_partkey, round(p_size / 60.0 * 100, 6) AS pct, CAST(trunc(p_retailprice * (504.0 / greatest(p_retailprice, p_size * 20.0))) AS INTEGER) AS w, CAST(trunc(p_size * 20.0 * (504.0 / greatest(p_retailprice, p_size * 20.0))) AS INTEGER) AS h FROM part")
def percent_and_resize(spark, sf_dir):
    w, h = geometry.fit_size(F.col("p_retailprice"), F.col("p_size") * 20.0, 504)
    return read(spark, sf_dir, "part").select("p_partkey", F.round(geometry.percent(F.col("p_size"), F.lit(60.0)), 6).alias("pct"), w.alias("w"), h.alias("h"))


@query("first_last_index", "SELECT conv_id, min(turn) AS first_turn, max(turn) AS last_turn, arg_min(role, turn) AS first_role FROM conversations GROUP BY conv_id")
def first_last_index(spark, sf_dir):
    return read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.min("turn").alias("first_turn"), F.max("turn").alias("last_turn"), F.min_by("role", "turn").alias("first_role"))


@query("leading_run", """
WITH n AS (SELECT user_id, event_id, event_type <> 'purchase' AS ok, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events),
e AS (SELECT *, sum(CAST(ok AS INTEGER)) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS s FROM n),
f AS (SELECT *, min(CASE WHEN s = 5 THEN rn END) OVER (PARTITION BY user_id) AS stop FROM e) SELECT user_id, event_id FROM f WHERE stop IS NULL OR rn < stop""")
def leading_run(spark, sf_dir):
    e = read(spark, sf_dir, "events", "user_id", "event_id", "event_type")
    return sequences.leading_run(e, ["user_id"], ["event_id"], F.col("event_type") != "purchase").select("user_id", "event_id")


@query("touching_boxes", """
WITH s AS (SELECT user_id, event_id AS l, event_id + 30 AS r FROM events), g AS (SELECT *, CASE WHEN l > max(r) OVER (PARTITION BY user_id ORDER BY l, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS new FROM s),
i AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY l, r ROWS UNBOUNDED PRECEDING) AS id FROM g) SELECT user_id, min(l) AS l, max(r) AS r, count(*) AS n FROM i GROUP BY user_id, id""")
def touching_boxes(spark, sf_dir):
    return sequences.touching(read(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("l"), (F.col("event_id") + 30).alias("r")), ["user_id"], "l", "r")


@query("tumbling_windows", "SELECT event_type, epoch(time_bucket(INTERVAL '6 hours', ts))::BIGINT AS at, count(*) AS n FROM events GROUP BY ALL")
def tumbling_windows(spark, sf_dir):
    e = read(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return worker.tumbling(e, "ts", ["event_type"], "6 hours").select("event_type", F.unix_seconds("window_start").alias("at"), "n")


@query("greedy_match")
def greedy_match(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem", *LINES)
    c = li.alias("a").join(li.alias("b"), F.expr("a.l_orderkey = b.l_orderkey AND a.l_linenumber < b.l_linenumber")).select(F.col("a.l_orderkey").alias("k"), F.col("a.l_linenumber").alias("left"), F.col("b.l_linenumber").alias("right"), F.abs(F.col("a.l_quantity") - F.col("b.l_quantity")).alias("d"))
    return assignment.greedy(c, ["k"], "left", "right", ["d"])


@query("bag_consolidation")
def bag_consolidation(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.when(F.col("o_orderkey") % 5 > 0, F.col("o_orderstatus")).alias("num"), (F.col("o_totalprice") / 5e5).alias("nc"), F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderpriority")).alias("date"), F.lit(0.5).alias("dc"))
    return assignment.bags(o, "o_custkey", "o_orderkey", "num", "nc", "date", "dc")


@query("title_chain")
def title_chain(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.substring("o_orderpriority", 1, 1).cast("int").alias("pos"), F.round(F.col("o_totalprice") / 1000).cast("long").alias("s"))
    return assignment.chains(o, ["o_custkey"], "o_orderkey", "pos", ["s"])


@query("global_resolution")
def global_resolution(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_partkey") % 20).cast("int").alias("pos"), F.when(F.col("l_suppkey") % 2 == 0, (F.col("l_partkey") % 50).cast("int")).alias("rank"), F.lit(1).alias("one"), F.col("l_quantity").cast("long").alias("q"))
    return assignment.resolved(li, ["l_orderkey"], "l_linenumber", "pos", "rank", ["one", "q"])


@query("page_number_parse")
def page_number_parse(spark, sf_dir):
    return read(spark, sf_dir, "benchmark").select("item_id", numerals.printed_number(F.concat(F.lit("str. "), F.col("item_id"), F.lit(" •"))).alias("n")).select("item_id", "n.*")


@query("bind_infants")
def bind_infants(spark, sf_dir):
    e = read(spark, sf_dir, "events", "user_id", "event_id", "event_type")
    return sequences.bind_infants(e, ["user_id"], "event_id", F.col("event_type") == "purchase", F.col("event_type") == "click", F.col("event_type") == "error", F.col("event_type") == "view")
