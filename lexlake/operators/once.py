"""Rows delivered more than once, and row numbers, for keys that may hold a large part of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Values of the order column that are numbered together.
SPAN = 1 << 16


def once(df: DataFrame, key: str, *latest: str) -> DataFrame:
    """One row for each key: the one with the greatest latest columns, nulls lowest.

    It is an aggregation, so the deliveries of a key are reduced before they are shuffled.
    """
    row = F.struct(*df.columns)
    best = F.max_by(row, F.struct(*latest)) if latest else F.any_value(row)
    return df.groupBy(F.col(key).alias("_key")).agg(best.alias("_row")).select("_row.*")


def numbered(df: DataFrame, keys: Sequence[str], order: str, name: str) -> DataFrame:
    """df with the number, from 1, of each row among those of its keys in order of a whole-number column.

    Rows are numbered within spans of the order column; the spans before are added from their sums.
    So a key with a third of all rows is numbered by many tasks. Rows that tie share an arbitrary
    but complete order.
    """
    rows = df.withColumn("_span", F.floor(F.col(order) / SPAN))
    n = rows.groupBy(*keys, "_span").agg(F.count("*").alias("_n"))
    before = n.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col("_span").alias("_s"), (F.sum("_n").over(Window.partitionBy(*keys).orderBy("_span")) - F.col("_n")).alias("_before"))
    met = rows["_span"].eqNullSafe(before["_s"])
    for i, k in enumerate(keys):
        met &= rows[k].eqNullSafe(before[f"_k{i}"])
    place = F.row_number().over(Window.partitionBy(*keys, "_span").orderBy(order))
    return rows.join(before, met).withColumn(name, F.col("_before") + place).drop("_span", "_s", "_before", *(f"_k{i}" for i in range(len(keys))))
