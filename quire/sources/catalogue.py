"""Catalogue records, word boxes and id trees from XML, JSON and text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.text import clean

#: Entries that stand for nothing.
PLACEHOLDERS = (
    "neuveden", "neuvedeno", "neznámý", "nezjištěn", "nezjištěno", "bez nakladatele", "nezname_cislo",
    "s. n.", "s. n.]", "[s. n.]", "[s. n.", "s. l.", "s. l.]", "[s. l.]", "[s. l.",
)
_TEXT = "STRUCT<_VALUE: STRING, _type: STRING>"
RECORD = f"""STRUCT<titleInfo: ARRAY<STRUCT<_usage: STRING, title: STRING, subTitle: STRING, partNumber: STRING, partName: STRING>>,
 name: ARRAY<STRUCT<_usage: STRING, namePart: ARRAY<{_TEXT}>, role: STRUCT<roleTerm: ARRAY<{_TEXT}>>>>,
 originInfo: ARRAY<STRUCT<_eventType: STRING, publisher: STRING, dateIssued: ARRAY<STRING>, place: ARRAY<STRUCT<placeTerm: ARRAY<{_TEXT}>>>>>,
 relatedItem: ARRAY<STRUCT<_type: STRING, titleInfo: ARRAY<STRUCT<title: STRING, partNumber: STRING>>>>, part: ARRAY<STRUCT<_type: STRING>>, _corrupt_record: STRING>"""


def mods_struct(xml: Column) -> Column:
    """A record as a struct, from a bare ``mods`` root or a collection's first; ``_corrupt_record`` where unreadable."""
    opts = {"ignoreNamespace": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record", "valueTag": "_VALUE", "attributePrefix": "_"}
    bare = F.from_xml(xml, RECORD, opts)
    inner = F.from_xml(xml, f"STRUCT<mods: ARRAY<{RECORD.replace(', _corrupt_record: STRING', '')}>, _corrupt_record: STRING>", opts)
    return F.when(xml.rlike(r"<(?:\w+:)?modsCollection\b"), F.get(inner["mods"], 0)).otherwise(F.struct(*[bare[c].alias(c) for c in ("titleInfo", "name", "originInfo", "relatedItem", "part")]))


def titles(m: Column) -> Column:
    """Title rows, primary ones first, cleaned, without empty or repeated ones."""
    c = lambda x: clean(x, PLACEHOLDERS)
    row = lambda t: F.struct(c(t["title"]).alias("title"), c(t["subTitle"]).alias("subtitle"), c(t["partNumber"]).alias("part_number"), c(t["partName"]).alias("part_name"))
    primary = lambda t: F.coalesce(t["_usage"] == "primary", F.lit(False))
    t = F.concat(F.filter(m["titleInfo"], primary), F.filter(m["titleInfo"], lambda x: ~primary(x)))
    return F.filter(F.array_distinct(F.transform(t, row)), lambda r: F.coalesce(r["title"], r["subtitle"], r["part_number"], r["part_name"]).isNotNull())


def names(m: Column, roles: tuple[str, ...]) -> Column:
    """Names in one of the roles: their parts, but for dates, joined by a space."""
    said = lambda n: F.transform(F.coalesce(n["role"]["roleTerm"], F.array()), lambda r: F.lower(F.trim(r["_VALUE"])))
    full = lambda n: F.array_join(F.transform(F.filter(n["namePart"], lambda p: F.coalesce(p["_type"] != "date", F.lit(True))), lambda p: F.trim(p["_VALUE"])), " ")
    return F.array_distinct(F.filter(F.transform(F.filter(m["name"], lambda n: F.arrays_overlap(said(n), F.array(*map(F.lit, roles)))), full), lambda x: x != ""))


def origins(m: Column, manufacture: bool) -> Column:
    """Publisher, place and date of publication, or of manufacture."""
    c = lambda x: clean(x, PLACEHOLDERS)
    made = lambda o: F.coalesce(o["_eventType"] == "manufacture", F.lit(False))
    place = lambda o: F.get(F.filter(F.flatten(F.transform(F.coalesce(o["place"], F.array()), lambda p: p["placeTerm"])), lambda t: (t["_type"] == "text") & (F.trim(t["_VALUE"]) != "")), 0)["_VALUE"]
    rows = F.transform(F.filter(m["originInfo"], lambda o: made(o) if manufacture else ~made(o)), lambda o: F.struct(c(o["publisher"]).alias("publisher"), c(place(o)).alias("place"), c(F.get(o["dateIssued"], 0)).alias("date")))
    return F.filter(F.array_distinct(rows), lambda r: F.coalesce(r["publisher"], r["place"], r["date"]).isNotNull())


def year_range(text: Column) -> Column:
    """struct(first, last) of "1901-[1903?]" or "1901"; null if a part is no whole number."""
    parts = F.transform(F.split(F.regexp_replace(text, r"[\[\]?]", ""), "-"), lambda x: F.trim(x).try_cast("int"))
    return F.when((F.size(parts) <= 2) & F.forall(parts, lambda x: x.isNotNull()), F.struct(F.get(parts, 0).alias("first"), F.get(parts, F.size(parts) - 1).alias("last")))


def package_objects(spark: SparkSession, df: DataFrame, column: str, key: str) -> DataFrame:
    """Objects of catalogue packages {"type", "objects": [{"id", "mods"}]}; a package with any bad id gives none."""
    schema = "type STRING, objects ARRAY<STRUCT<id: STRING, mods: STRING>>"
    o = df.select(key, F.from_json(column, schema, {"mode": "PERMISSIVE"}).alias("p")).select(key, "p.type", F.explode("p.objects").alias("o"))
    good = F.coalesce(F.col("o.id").rlike(r"(?i)^uuid:[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"), F.lit(False))
    every = o.withColumn("good", good).groupBy(key).agg(F.bool_and("good").alias("all_good")).where("all_good").select(key)
    return o.join(every, key, "left_semi").select(key, "type", F.col("o.id").alias("id"), F.col("o.mods").alias("mods"))


def id_tree(df: DataFrame, column: str) -> DataFrame:
    """``doc, year, number, position, page`` of lines {doc: [pages]} or {doc: {year: {number: [pages]}}}."""
    v = df.select(F.explode(F.from_json(column, "map<string,string>")).alias("doc", "tree"))
    flat = v.where("tree LIKE '[%'").select("doc", F.lit(None).cast("string").alias("year"), F.lit(None).cast("string").alias("number"), F.posexplode(F.from_json("tree", "array<string>")).alias("position", "page"))
    deep = v.where("tree LIKE '{%'").select("doc", F.explode(F.from_json("tree", "map<string,map<string,array<string>>>")).alias("year", "issues")).select("doc", "year", F.explode("issues").alias("number", "pages")).select("doc", "year", "number", F.posexplode("pages").alias("position", "page"))
    return flat.union(deep)


def xml_format(text: Column) -> Column:
    """ALTO, PAGE, UNKNOWN, or INVALID_XML if it isn't well formed, by the root element or its namespace."""
    broken = F.from_xml(text, "STRUCT<_corrupt_record: STRING>", {"columnNameOfCorruptRecord": "_corrupt_record"})["_corrupt_record"].isNotNull()
    root = F.regexp_extract(text, r"^(?:\s*<\?[^>]*\?>|\s*<!--.*?-->)*\s*<(?:\w+:)?(\w+)", 1)
    space = F.regexp_extract(text, r"xmlns(?::\w+)?=\"([^\"]*)\"", 1)
    return F.when(broken, "INVALID_XML").when((F.lower(root) == "alto") | F.lower(space).contains("alto"), "ALTO").when((root == "PcGts") | F.lower(space).contains("pagecontent"), "PAGE").otherwise("UNKNOWN")


def read_page_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("page_id STRING, page_type STRING").csv(path, sep=" ")


def read_page_csv(spark: SparkSession, path: str, classes: list[str]) -> DataFrame:
    """Rows of supported page types, spelled as in ``classes`` whatever their case."""
    df = spark.read.option("header", True).csv(path)
    lacking = {"page_type", "image_path"} - set(df.columns)
    if lacking:
        raise ValueError(f"columns are missing: {sorted(lacking)}")
    kinds = F.create_map(*[F.lit(x) for c in classes for x in (c.lower(), c)])
    return df.withColumn("page_type", kinds[F.lower("page_type")]).where(F.col("page_type").isNotNull())


def alto_words(text: Column) -> Column:
    """Words of an ALTO file with their line and box."""
    s = "STRUCT<Layout: STRUCT<Page: ARRAY<STRUCT<PrintSpace: STRUCT<TextBlock: ARRAY<STRUCT<_ID: STRING, TextLine: ARRAY<STRUCT<_ID: STRING, String: ARRAY<STRUCT<_CONTENT: STRING, _HPOS: DOUBLE, _VPOS: DOUBLE, _WIDTH: DOUBLE, _HEIGHT: DOUBLE>>>>>>>>>>>"
    x = F.from_xml(text, s, {"ignoreNamespace": "true"})
    blocks = F.flatten(F.transform(x["Layout"]["Page"], lambda p: p["PrintSpace"]["TextBlock"]))
    return F.flatten(F.flatten(F.transform(blocks, lambda b: F.transform(b["TextLine"], lambda ln: F.transform(ln["String"], lambda w: F.struct(b["_ID"].alias("block"), ln["_ID"].alias("line"), w["_CONTENT"].alias("word"), w["_HPOS"].alias("x"), w["_VPOS"].alias("y"), w["_WIDTH"].alias("w"), w["_HEIGHT"].alias("h")))))))
