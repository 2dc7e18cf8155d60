"""Operators on tables of contents, boxes, labels and metrics applied to the supplied tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quire.functions import geometry, text
from quire.operators import chapters, relations, sequences
from quire.operators.rank import arg_max
from quire.plans.catalogue import query
from quire.plans.demos import read


def _boxes(spark, sf_dir, flag):
    """Line items of one flag as boxes of their order's page."""
    li = read(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == flag)
    ident = F.col("l_linenumber") * 1000000 + F.col("l_partkey")
    return li.groupBy("l_orderkey", ident.cast("long").alias("id")).agg((F.min("l_linenumber") * 10.0).alias("x"), (F.min("l_discount") * 100).alias("y"), F.min("l_quantity").alias("w"), F.lit(10.0).alias("h"), F.min("l_tax").alias("confidence"))


def _box_sql(flag):
    return f"SELECT l_orderkey, CAST(l_linenumber * 1000000 + l_partkey AS BIGINT) AS id, min(l_linenumber) * 10.0 AS x, min(l_discount) * 100 AS y, min(l_quantity) AS w, 10.0 AS h, min(l_tax) AS confidence FROM lineitem WHERE l_returnflag = '{flag}' GROUP BY 1, l_linenumber * 1000000 + l_partkey"


@query("search_area", "SELECT conv_id, turn FROM (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS p, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations) WHERE p < n * 0.25 OR n - p - 1 < n * 0.25")
def search_area(spark, sf_dir):
    w = Window.partitionBy("conv_id")
    c = read(spark, sf_dir, "conversations", "conv_id", "turn").select("*", (F.row_number().over(w.orderBy("turn")) - 1).alias("p"), F.count(F.lit(1)).over(w).alias("n"))
    return c.where(chapters.in_search_area(F.col("p"), F.col("n"))).select("conv_id", "turn")


@query("nearest_titles", f"""
WITH t AS ({_box_sql('A')}), n AS ({_box_sql('R')})
SELECT l_orderkey, id, title_id FROM (SELECT n.l_orderkey, n.id, t.id AS title_id, row_number() OVER (PARTITION BY n.l_orderkey, n.id ORDER BY greatest(0.0, n.x - (t.x + t.w)), t.confidence DESC, t.y, t.x, t.id) AS rn
 FROM n JOIN t ON n.l_orderkey = t.l_orderkey AND n.y + 5 BETWEEN t.y AND t.y + 10 AND n.x + n.w / 2 > t.x + t.w / 2) WHERE rn = 1""")
def nearest_titles(spark, sf_dir):
    return chapters.nearest_titles(_boxes(spark, sf_dir, "R"), _boxes(spark, sf_dir, "A"), ["l_orderkey"])


@query("numbers_of_titles")
def numbers_of_titles(spark, sf_dir):
    return chapters.numbers_of_titles(_boxes(spark, sf_dir, "A"), _boxes(spark, sf_dir, "R"), ["l_orderkey"], "right")


@query("subtitles_of_titles")
def subtitles_of_titles(spark, sf_dir):
    return chapters.subtitles_of_titles(_boxes(spark, sf_dir, "A"), _boxes(spark, sf_dir, "R"), ["l_orderkey"])


@query("subtitle_gates", f"""
WITH t AS ({_box_sql('A')}), s AS ({_box_sql('R')})
SELECT l_orderkey, t.id AS title_id, s.id AS id FROM t JOIN s USING (l_orderkey)
WHERE s.y >= t.y AND s.y - t.y - 10 BETWEEN -2.5 AND 15 AND least(t.w, s.w) > 0 AND greatest(0, least(t.x + t.w, s.x + s.w) - greatest(t.x, s.x)) / least(t.w, s.w) >= 0.25""")
def subtitle_gates(spark, sf_dir):
    side = lambda flag, p: _boxes(spark, sf_dir, flag).select("l_orderkey", *[F.col(c).alias(f"{p}{c}") for c in ("id", *"xywh")])
    box = lambda p: {c: F.col(f"{p}{c}") for c in "xywh"}
    return side("A", "t_").join(side("R", "s_"), "l_orderkey").where(chapters.subtitle_fits(box("t_"), box("s_"))).select("l_orderkey", F.col("t_id").alias("title_id"), F.col("s_id").alias("id"))


@query("expected_positions", """
WITH o AS (SELECT o_orderkey, o_custkey, o_orderstatus AS s, o_orderkey % 50 AS v, o_orderkey // 4 AS p FROM orders),
a AS (SELECT *, lag(p) OVER w AS bp, lag(v) OVER w AS bv, lag(s) OVER w AS bs, lead(p) OVER w AS ap, lead(v) OVER w AS av, lead(s) OVER w AS "as" FROM o WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)),
f AS (SELECT *, CASE WHEN bs = s THEN bp - bv END AS x, CASE WHEN "as" = s THEN ap - av END AS y FROM a)
SELECT o_orderkey, CASE WHEN coalesce(x = y, true) THEN v + coalesce(x, y) END AS expected, NOT (coalesce(bs = s AND v < bv, false) OR coalesce("as" = s AND v > av, false)) AS fits FROM f""")
def expected_positions(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.struct(F.floor(F.col("o_orderkey") / 4).alias("position"), (F.col("o_orderkey") % 50).alias("value"), F.col("o_orderstatus").alias("system")).alias("a"))
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    around = F.lag("a").over(w), F.lead("a").over(w)
    o = o.select("o_orderkey", "a", around[0].alias("before"), around[1].alias("after"))
    args = F.col("a.value"), F.col("a.system"), F.col("before"), F.col("after")
    return o.select("o_orderkey", chapters.expected_position(*args).alias("expected"), chapters.number_fits(*args).alias("fits"))


@query("range_ends", """
WITH g AS (SELECT DISTINCT l_orderkey, l_linenumber AS position, l_partkey % 10 AS value, l_returnflag AS system FROM lineitem),
e AS (SELECT o_orderkey AS l_orderkey, o_orderkey AS entry, CASE WHEN o_orderkey % 2 = 0 THEN 'A' ELSE 'N' END AS system, 3 AS first, 3 + o_orderkey % 4 AS last, 1 AS start, CASE WHEN o_orderkey % 3 = 0 THEN 5 END AS stop FROM orders),
c AS (SELECT l_orderkey, entry, position, 0 AS kind, abs(position - (last + start - first)) AS d FROM e JOIN g USING (l_orderkey, system) WHERE value = last AND position >= start AND coalesce(position <= stop, true)
 UNION ALL SELECT l_orderkey, entry, position, 1, abs(position - (last + start - first)) FROM e JOIN g USING (l_orderkey) WHERE abs(position - (last + start - first)) <= 2 AND position >= start AND coalesce(position <= stop, true))
SELECT entry, (SELECT arg_min(c.position, c.kind * 1000000 + c.d * 1000 + c.position) FROM c WHERE c.l_orderkey = e.l_orderkey) AS "end" FROM e""")
def range_ends(spark, sf_dir):
    pages = read(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("long").alias("position"), (F.col("l_partkey") % 10).alias("value"), F.col("l_returnflag").alias("system")).distinct()
    k = F.col("o_orderkey")
    long = lambda x: x.cast("long")
    entries = read(spark, sf_dir, "orders").select(k.alias("l_orderkey"), k.alias("entry"), F.when(k % 2 == 0, "A").otherwise("N").alias("system"), long(F.lit(3)).alias("first"), (3 + k % 4).alias("last"), long(F.lit(1)).alias("start"), F.when(k % 3 == 0, long(F.lit(5))).alias("stop"))
    return chapters.range_ends(entries, pages, ["l_orderkey"]).select("entry", "end")


@query("ordered_mode", "SELECT o_orderkey, (o_orderkey % 11 = 0 OR o_totalprice / 500000 >= 0.9) AS auto, true AS yes, false AS no FROM orders")
def ordered_mode(spark, sf_dir):
    score = F.when(F.col("o_orderkey") % 11 != 0, F.col("o_totalprice") / 500000)
    return read(spark, sf_dir, "orders").select("o_orderkey", *[chapters.ordered_mode(m, score).alias(m) for m in ("auto", "yes", "no")])


@query("inserted_after", """
SELECT r_regionkey % 2 AS batch, id, CAST(row_number() OVER (PARTITION BY r_regionkey % 2 ORDER BY r_regionkey, late, k) - 1 AS INTEGER) AS position FROM
 (SELECT r_regionkey, 'r' || r_regionkey AS id, 0 AS late, 0 AS k FROM region UNION ALL SELECT n_regionkey, 'n' || n_nationkey, 1, n_nationkey FROM nation)""")
def inserted_after(spark, sf_dir):
    r = read(spark, sf_dir, "region").select((F.col("r_regionkey") % 2).alias("batch"), F.concat(F.lit("r"), "r_regionkey").alias("id"), F.col("r_regionkey").alias("position"))
    n = read(spark, sf_dir, "nation").select((F.col("n_regionkey") % 2).alias("batch"), F.concat(F.lit("r"), "n_regionkey").alias("container"), F.col("n_nationkey").alias("entry"), F.concat(F.lit("n"), "n_nationkey").alias("id"))
    return chapters.inserted_after(r, n, "batch")


@query("multilabel_metrics", """
WITH v AS (SELECT doc_id % 10 / 10.0 AS p0, doc_id % 7 / 8.0 AS p1, quality AS l0, toxic AS l1 FROM labels),
e AS (SELECT 0 AS class, p0 AS p, l0 AS l FROM v UNION ALL SELECT 1, p1, l1 FROM v UNION ALL SELECT 2, 0, 0 FROM v),
g AS (SELECT threshold, class, count(*) FILTER (p >= threshold AND l = 1) AS tp, count(*) FILTER (p < threshold AND l <> 1) AS tn, count(*) FILTER (p >= threshold AND l <> 1) AS fp, count(*) FILTER (p < threshold AND l = 1) AS fn FROM e, (VALUES (0.25), (0.5)) t(threshold) GROUP BY ALL),
m AS (SELECT threshold, class, coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall, (tp + tn) / (tp + tn + fp + fn) AS accuracy FROM g WHERE class < 2)
SELECT CAST(threshold AS DOUBLE) AS threshold, round(avg(precision), 9) AS precision, round(avg(recall), 9) AS recall, round(avg(coalesce(2 * precision * recall / nullif(precision + recall, 0), 0)), 9) AS f1, round(avg(accuracy), 9) AS accuracy FROM m GROUP BY 1""")
def multilabel_metrics(spark, sf_dir):
    v = read(spark, sf_dir, "labels").select(F.array(F.col("doc_id") % 10 / 10.0, F.col("doc_id") % 7 / 8.0, F.lit(0.0)).alias("p"), F.array("quality", "toxic", F.lit(0)).alias("l"))
    m = relations.macro(relations.multilabel(v, "p", "l", [0.25, 0.5]), 3)
    return m.select("threshold", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1", "accuracy")])


@query("whole_positions", "SELECT l_orderkey, l_partkey, l_suppkey, CAST(round_even(l_extendedprice / (SELECT max(l_extendedprice) FROM lineitem) * least((SELECT max(l_extendedprice) FROM lineitem), 999), 0) AS BIGINT) AS l_extendedprice FROM lineitem")
def whole_positions(spark, sf_dir):
    return relations.whole_positions(read(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice"), "l_extendedprice")


@query("evidence_notes", """
SELECT conv_id, string_agg(line, chr(10) ORDER BY t) AS note FROM (SELECT conv_id, printf('%s: %s (%.2f)', role, role, turn % 4 / 4.0) AS line, min(turn) AS t FROM conversations WHERE turn IS NOT NULL AND role IS NOT NULL GROUP BY ALL) GROUP BY conv_id""")
def evidence_notes(spark, sf_dir):
    c = read(spark, sf_dir, "conversations").where("turn IS NOT NULL AND role IS NOT NULL").withColumn("c", F.col("turn") % 4 / 4.0)
    return relations.notes(c, ["conv_id"], "turn", "role", "role", "c")


@query("czech_dates", "SELECT o_orderkey, strftime(o_orderdate, '%d.%m.%Y') AS date, true AS held FROM orders")
def czech_dates(spark, sf_dir):
    day = F.col("o_orderdate")
    said = F.concat_ws(" ", F.concat(F.dayofmonth(day), F.lit(".")), F.element_at(F.array(*[F.lit(m[-1]) for m in text.MONTHS]), F.month(day)), F.year(day))
    return read(spark, sf_dir, "orders").select("o_orderkey", text.czech_date(said).alias("date"), text.holds_date(F.concat(F.lit("V Praze "), said), F.date_format(day, "dd.MM.yyyy")).alias("held"))


@query("frequency_days", "SELECT event_id, CASE event_type WHEN 'click' THEN 7 WHEN 'view' THEN 15 WHEN 'purchase' THEN 60 ELSE 0 END AS days FROM events")
def frequency_days(spark, sf_dir):
    words = F.when(F.col("event_type") == "click", "Týdeník;").when(F.col("event_type") == "view", "vychází 2x měsíčně").when(F.col("event_type") == "purchase", "Bimonthly, or so").otherwise("kdykoli")
    return read(spark, sf_dir, "events").select("event_id", text.frequency_days(words).alias("days"))


@query("joined_tokens", "SELECT p_partkey, split_part(p_name, ' ', 1) || split_part(p_name, ' ', 2) || ' ' || p_brand AS entity FROM part")
def joined_tokens(spark, sf_dir):
    w = F.split("p_name", " ")
    piece = lambda word, tag: F.struct(word.alias("word"), F.lit(tag).alias("tag"))
    tokens = F.array(piece(F.lit("[CLS]"), "B-T"), piece(F.get(w, 0), "B-T"), piece(F.concat(F.lit("##"), F.get(w, 1)), "B-T"), piece(F.col("p_brand"), "I-T"), piece(F.lit("x"), "O"))
    return read(spark, sf_dir, "part").select("p_partkey", F.get(text.joined_tokens(tokens), 0)["word"].alias("entity"))


@query("joined_labels", "SELECT p_partkey, nullif(concat_ws(' | ', CASE WHEN p_size % 2 = 0 THEN CAST(p_size AS VARCHAR) END, CASE WHEN p_size % 3 = 0 THEN p_brand END), '') AS label, p_size % 2 = 1 AS same FROM part")
def joined_labels(spark, sf_dir):
    even = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit(" "), F.col("p_size").cast("string")))
    label = text.joined_label(even, F.when(F.col("p_size") % 3 == 0, F.col("p_brand")).otherwise(" "))
    return read(spark, sf_dir, "part").select("p_partkey", label.alias("label"), text.same_text(F.upper("p_name"), F.when(F.col("p_size") % 2 == 1, F.concat(F.col("p_name"), F.lit(".")))).alias("same"))


@query("page_boxes", """
SELECT p_partkey, least(p_size, 20.0) AS ux, greatest(p_size + 30.0, 20.0 + p_size * 2) - least(p_size, 20.0) AS uw, p_size <> 20 AS differs, 90.0 - p_size AS ph, round(p_size + (100 - p_size) / 3.0 - 20 / 3.0, 6) AS cut,
 least(greatest(p_size + 2, 2), 30) AS nx, least(2 + p_size % 4 * 20, 30) AS slot FROM part""")
def page_boxes(spark, sf_dir):
    s, f = F.col("p_size"), lambda x: F.lit(float(x))
    u = geometry.union({"x": s.cast("double"), "y": f(0), "w": f(30), "h": f(5)}, {"x": f(20), "y": f(1), "w": s * 2.0, "h": f(5)})
    p = geometry.inside_paddings(f(0), f(0), s.cast("double"), f(0), f(50), f(80))
    return read(spark, sf_dir, "part").select("p_partkey", u["x"].alias("ux"), u["w"].alias("uw"), geometry.sizes_differ(s, s, F.lit(20), F.lit(20)).alias("differs"), p["h"].alias("ph"), F.round(geometry.split_column(s, F.lit(100), 1 / 3)[0], 6).alias("cut"), geometry.note_point(s, s, F.lit(50), F.lit(50))[0].alias("nx"), geometry.corner_slot(s % 4, F.lit(50)).alias("slot"))


@query("year_filter", "SELECT o_orderkey FROM orders WHERE year(o_orderdate) >= 1994 AND year(o_orderdate) + o_orderkey % 3 <= 1996 AND o_orderkey % 5 > 0")
def year_filter(spark, sf_dir):
    y = F.when(F.col("o_orderkey") % 5 > 0, F.year("o_orderdate"))
    return read(spark, sf_dir, "orders").where(relations.years_within(y, y + F.col("o_orderkey") % 3, 1994, 1996)).select("o_orderkey")


@query("neighbour_values", """
SELECT user_id, event_id, coalesce(lag(event_id, 2) OVER w, 0) || ',' || coalesce(lag(event_id) OVER w, 0) || ',' || coalesce(lead(event_id) OVER w, 0) || ',' || coalesce(lead(event_id, 2) OVER w, 0) AS around,
 CAST(CASE WHEN event_type <> 'error' THEN count(*) FILTER (event_type <> 'error') OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) - 1 END AS BIGINT) AS place FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)""")
def neighbour_values(spark, sf_dir):
    e = sequences.neighbour_values(read(spark, sf_dir, "events", "user_id", "event_id", "event_type"), ["user_id"], ["event_id"], "event_id", 2)
    e = sequences.running_position(e, ["user_id"], ["event_id"], F.col("event_type") == "error")
    return e.select("user_id", "event_id", F.array_join(F.transform("around", lambda x: x.cast("string")), ",").alias("around"), "place")


@query("matched_counts", "SELECT lang, count(*) FILTER (quality = 1) AS matched, count(*) AS total FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang")
def matched_counts(spark, sf_dir):
    d = read(spark, sf_dir, "documents", "doc_id", "lang").join(read(spark, sf_dir, "labels", "doc_id", "quality"), "doc_id", "left")
    return relations.matched_counts(d, "lang", F.coalesce(F.col("quality") == 1, F.lit(False)))


@query("surest_title", "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders WHERE o_orderstatus IN ('F', 'O')) WHERE rn = 1")
def surest_title(spark, sf_dir):
    o = read(spark, sf_dir, "orders").where(F.col("o_orderstatus").isin("F", "O"))
    return arg_max(o, ["o_custkey"], [F.desc("o_totalprice"), "o_orderkey"]).select("o_custkey", "o_orderkey")
