"""Evidence bound to pages and volumes: printed page numbers, page types and bibliographic fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import geometry, numerals
from quire.operators.rank import arg_max

#: What each label of a title page is for: field, rule, and whether it says something of volume or issue.
FIELDS = {
    "Title": ("title", "max", "both"), "Subtitle": ("subTitle", "max", "both"), "PlaceTerm": ("placeTerm", "max", "both"), "Publisher": ("publisher", "append", "both"),
    "ManufacturePublisher": ("manufacturePublisher", "append", "both"), "ManufacturePlaceTerm": ("manufacturePlaceTerm", "append", "both"), "PartNumber": ("partNumber", "max", "volume"),
    "PartName": ("partName", "max", "volume"), "Edition": ("edition", "max", "volume"), "DateIssued": ("dateIssued", "max", "volume"), "SeriesName": ("seriesName", "append", "volume"),
    "SeriesNumber": ("seriesNumber", "append", "volume"), "Author": ("author", "append", "volume"), "Illustrator": ("illustrator", "append", "volume"), "Photographer": ("photographer", "append", "volume"),
    "Translator": ("translator", "append", "volume"), "Editor": ("editor", "append", "volume"), "Redaktor": ("redaktor", "append", "issue"),
    "PeriodicalVolumePartNumber": ("partNumber", "max", "volume"), "PeriodicalVolumeDateIssued": ("dateIssued", "max", "volume"),
    "PeriodicalIssuePartNumber": ("partNumber", "max", "issue"), "PeriodicalIssueDateIssued": ("dateIssued", "max", "issue"),
}


def is_usable() -> Column:
    """Whether a region has words, a box, a confidence and a text."""
    there = F.col("matched") & geometry.finite(F.col("x"), F.col("y"), F.col("width"), F.col("height"), F.col("confidence")) & (F.trim("alto_text") != "")
    return F.coalesce(there, F.lit(False))


def usable(regions: DataFrame) -> DataFrame:
    return regions.where(is_usable())


def page_numbers(regions: DataFrame, pages: DataFrame, label: str, band: float = 0.15, weight: float = 0.65, edge_only: bool = False) -> DataFrame:
    """One printed number for each page at most: ``page_key, region_id, norm, value, system, confidence, score``.

    ``pages`` has page_key, width, height. A page's only number inside it is taken as it is, unless ``edge_only``; of
    several, those whose centre lies within ``band`` of the upper or lower edge compete by edge and confidence; ties go
    to the surer, then the nearer to an edge, then the first region.
    """
    size = pages.select("page_key", F.col("width").alias("page_w"), F.col("height").alias("page_h"))
    r = usable(regions).where(F.col("label") == label).join(size, "page_key")
    r = r.withColumn("n", numerals.printed_number(F.col("alto_text"))).where(F.col("n").isNotNull())
    r = r.where(geometry.contained(*[F.col(c) for c in ("x", "y", "width", "height", "page_w", "page_h")]))
    r = r.withColumn("edge", geometry.edge_distance(F.col("y") + F.col("height") / 2, F.col("page_h"))).withColumn("rivals", F.count(F.lit(1)).over(Window.partitionBy("page_key")))
    r = r.where((F.col("edge") <= band) | (F.lit(not edge_only) & (F.col("rivals") == 1)))
    near = F.greatest(F.lit(0.0), 1 - F.col("edge") / band)
    r = r.withColumn("score", weight * near + (1 - weight) * F.col("confidence"))
    best = arg_max(r, ["page_key"], [F.desc("score"), F.desc("confidence"), "edge", "region_id"])
    return best.select("page_key", "region_id", "n.norm", "n.value", "n.system", "confidence", "score")


def page_types(probabilities: DataFrame, classes: list[str]) -> DataFrame:
    """The likeliest class of every page, probabilities rounded to three places first; the first class wins ties."""
    p = F.transform("probabilities", lambda x: F.bround(x, 3))
    return probabilities.select("page_key", F.element_at(F.array(*map(F.lit, classes)), F.array_position(p, F.array_max(p)).cast("int")).alias("page_type"), F.array_max(p).alias("confidence"))


def title_page_fields(regions: DataFrame) -> DataFrame:
    """``page_key, target, field, texts``: of each field the surest text (the first of equals), or all in region order."""
    m = F.create_map(*[x for k, v in FIELDS.items() for x in (F.lit(k), F.struct(F.lit(v[0]).alias("field"), F.lit(v[1]).alias("rule"), F.lit(v[2]).alias("to")))])
    r = usable(regions).withColumn("f", m[F.col("label")]).where(F.col("f").isNotNull())
    r = r.withColumn("target", F.explode(F.when(F.col("f.to") == "both", F.array(F.lit("volume"), F.lit("issue"))).otherwise(F.array(F.col("f.to")))))
    best = F.max_by(F.col("alto_text"), F.struct("confidence", -F.col("region_id")))
    every = F.transform(F.sort_array(F.collect_list(F.struct("region_id", "alto_text"))), lambda x: x["alto_text"])
    return r.groupBy("page_key", "target", F.col("f.field").alias("field")).agg(F.when(F.first("f.rule") == "max", F.array(best)).otherwise(every).alias("texts"))


def hierarchy(regions: DataFrame) -> DataFrame:
    """``page_key, hierarchy``: periodical if any label is a periodical volume's (an issue's alone doesn't make one), else
    multipart with a part, else monograph."""
    r = usable(regions).where(F.col("label").isin(*FIELDS))
    return r.groupBy("page_key").agg(F.when(F.bool_or(F.col("label").startswith("PeriodicalVolume")), "periodical").when(F.bool_or(F.col("label").isin("PartNumber", "PartName")), "multipart").otherwise("monograph").alias("hierarchy"))


def emitted(fields: DataFrame) -> DataFrame:
    """``page_key, volume, issue``: a volume where there is a title, an issue where its part number or date is there too."""
    g = fields.groupBy("page_key").agg(F.bool_or((F.col("target") == "volume") & (F.col("field") == "title")).alias("volume"), F.bool_or((F.col("target") == "issue") & F.col("field").isin("partNumber", "dateIssued")).alias("dated"))
    return g.select("page_key", "volume", (F.col("volume") & F.col("dated")).alias("issue"))
