"""Traditional characters and their simplified forms, learnt from texts printed both ways."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HAN = r"^[\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}]$"
#: Ideographs that a map may hold; the scripts have fewer.
MOST = 100_000


def learnt(rows: DataFrame, traditional: str, simplified: str, least: int = 2) -> DataFrame:
    """(char, to, n): the form that stands most often at a character's place in the other text of the same length.

    A character counts if it is replaced more often than kept; ties go to the smaller form.
    """
    same = rows.select(F.col(traditional).alias("a"), F.col(simplified).alias("b")).where("a <> b and length(a) = length(b)")
    each = same.select(F.explode(F.arrays_zip(F.split("a", "").alias("p"), F.split("b", "").alias("q"))).alias("x")).select("x.p", "x.q").where(F.col("p").rlike(HAN) & F.col("q").rlike(HAN))
    votes = each.groupBy("p", "q").agg(F.count("*").alias("n"))
    best = votes.groupBy("p").agg(F.min(F.struct((-F.col("n")).alias("m"), "q")).alias("b"))
    return best.select(F.col("p").alias("char"), F.col("b.q").alias("to"), (-F.col("b.m")).alias("n")).where((F.col("char") != F.col("to")) & (F.col("n") >= least))


def mapping(table: DataFrame) -> tuple[str, str]:
    """The two strings of translate(); there are no more rows than ideographs."""
    rows = table.orderBy("char").limit(MOST).collect()
    return "".join(r.char for r in rows), "".join(r.to for r in rows)


def to_simplified(c: Column, both: tuple[str, str]) -> Column:
    return F.translate(c, *both) if both[0] else c
