"""A corpus from raw documents to packed training sequences: five stages, each one of the corpus operators.

Every stage takes (spark, docs, sf_dir) and works on all that the one before it kept; what it returns is written as
Parquet and read again. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import jaccard, mixing, packing, quality
from quire.llm.common import bounded, discard, stable, table
from quire.llm.queries import WINDOW, pseudonymised, tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base or a rule go.

    A null, empty or blank text has too few words and goes; equal rows are judged one by one; other columns stay, whatever
    their names; an empty table gives an empty one.
    """
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one of least doc_id: five words a shingle, a similarity of 0.8 or more.

    Repeated rows are one document. A null doc_id counts as the greatest; unlinked texts under one doc_id, or none, each
    stay. Texts without words are one for each doc_id, and each where that is null. An empty table gives an empty one.
    """
    return jaccard.distinct(docs, k=5, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data get pseudonyms; n_chars follows the text, and is null where that is.

    Null and empty texts stay; equal values get equal pseudonyms in every row; other columns stay; an empty table gives an
    empty one.
    """
    return pseudonymised(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it; those that it doesn't take go.

    Rows are mixed one by one, so that null and repeated doc_ids neither lose nor multiply rows; equal rows, known by two
    64-bit hashes of all columns, share what the mix takes of them. Null texts have no words and a null source is a source;
    an empty table gives an empty one. Texts are read where they are: written here are the numbers of copies alone.
    """
    names = [F.col(f"`{c}`") for c in docs.columns]
    free = "row" + "_" * max(map(len, docs.columns))  # a name that no column has
    named = docs.withColumn(free, F.struct(F.xxhash64(*names).alias("h1"), F.xxhash64(F.lit("second"), *names).alias("h2")))
    mixed = mixing.mix(named.select(free, "doc_id", "source", "text"), row=free)
    copies = stable(mixed.groupBy(free).agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows")).where("copies > 0"), "copies")
    n = copies.groupBy().agg(F.count(F.lit(1)).alias("once"), F.coalesce(F.sum((F.col("rows") > 1).cast("int")), F.lit(0)).alias("equal")).first()

    def taken(rows: DataFrame, which: str, most: int) -> DataFrame:
        some = copies.where(which).select(free, F.col("copies").alias(free + "_"))
        each = rows.join(bounded(some, most, 64), free)
        return each.select(*names, F.explode(F.sequence(F.lit(1), F.col(free + "_").cast("int"))).alias(free)).select(*names)

    out = taken(named, "rows = 1", n.once - n.equal)
    if n.equal:
        equal = named.join(bounded(copies.where("rows > 1").select(free), n.equal, 48), free, "left_semi").dropDuplicates([free])
        out = out.union(taken(equal, "rows > 1", n.equal))
    return out


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences.

    A null or empty text is its end marker alone; repeated rows are packed each; other columns go; an empty table gives an
    empty one.
    """
    return packing.pack(docs, tokenizer_path(), WINDOW)


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("mix_sources", mix_sources), ("pack_sequences", pack_sequences)]

#: SQL can express neither the pseudonyms nor the packing; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, stable(stage(spark, docs, sf_dir), name)
        discard(before)
    return docs
