"""Writers of the file formats that other tools read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_pairs(df: DataFrame, path: str) -> None:
    """Columns parted by spaces, null as None: neighbour files, page lists."""
    df.select([F.coalesce(F.col(c).cast("string"), F.lit("None")).alias(c) for c in df.columns]).write.mode("overwrite").csv(path, sep=" ")


def write_by_class(df: DataFrame, path: str, label: str) -> None:
    df.write.mode("append").partitionBy(label).json(path)


def batch_json(elements: DataFrame, key: str, order: str) -> DataFrame:
    """One JSON document for each batch, its elements in order."""
    fields = F.struct(*[c for c in elements.columns if c != key])
    return elements.groupBy(key).agg(F.to_json(F.struct(F.transform(F.sort_array(F.collect_list(F.struct(F.col(order).alias("_o"), fields.alias("e")))), lambda x: x["e"]).alias("elements"))).alias("json"))
