"""Raw records split into entries and redirects, resources by content, listings, and exports."""

from __future__ import annotations

import re
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lexlake.functions.text import norm, norm_path

REDIRECT = "@@@LINK="


def split_records(records: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(entries, redirects, empties) of records (dict_id, ord, headword, body)."""
    body = F.trim(F.regexp_replace("body", r"^[\s\x00]+|[\s\x00]+$", ""))
    rows = records.withColumn("_b", body)
    empty, link = F.col("_b") == "", F.col("_b").startswith(REDIRECT)
    target = F.trim(F.substr("_b", F.lit(len(REDIRECT) + 1)))
    entries = rows.where(~empty & ~link).select("dict_id", "ord", "headword", norm("headword").alias("norm"), "body")
    redirects = rows.where(link).select("dict_id", "ord", "headword", norm("headword").alias("norm"), target.alias("target"), norm(target).alias("target_norm"))
    return entries, redirects, rows.where(empty).select("dict_id", "ord", "headword")


def checked(records: DataFrame, expected: DataFrame) -> DataFrame:
    """(dict_id, expected, found): dictionaries of which not as many records came as the inspection (dict_id, n) found."""
    got = records.groupBy("dict_id").agg(F.count("*").alias("found"))
    both = expected.select("dict_id", F.col("n").alias("expected")).join(got, "dict_id", "full_outer").na.fill(0, ["expected", "found"])
    return both.where("expected <> found")


def resources(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(paths, blobs) of files (dict_id, ord, path, data): the first file of a folded path, each content once."""
    rows = files.select("dict_id", "ord", "path", "data", norm_path("path").alias("norm"), F.sha2("data", 256).alias("hash"))
    first = rows.withColumn("_n", F.row_number().over(Window.partitionBy("dict_id", "norm").orderBy("ord"))).where("_n = 1")
    blobs = rows.groupBy("hash").agg(F.first("data").alias("data")).select("hash", F.length("data").cast("long").alias("size"), "data")
    return first.select("dict_id", "norm", "path", "hash"), blobs


LISTED = T.ArrayType(T.StructType([T.StructField("path", T.StringType()), T.StructField("folder", T.BooleanType()), T.StructField("size", T.LongType()), T.StructField("date", T.StringType())]))
_LINE = re.compile(r'<a href="([^"]*)">[^<]*</a>(.*)')
_TAIL = re.compile(r"\s+(\d\d-[A-Z][a-z]{2}-\d{4} \d\d:\d\d)\s+(-|\d+)\s*")


def listing(page: str, folder: str = "") -> list[dict]:
    """Files and folders of a directory page; anything that isn't an entry of a listing raises."""
    body = re.search(r"<pre>(.*)</pre>", page, re.S)
    if not body:
        raise ValueError("no complete listing")
    out, links = [], 0
    for line in body[1].split("\n"):
        m = _LINE.fullmatch(line.strip("\r"))
        if not m:
            if line.strip():
                raise ValueError(f"no entry: {line[:80]!r}")
            continue
        links += 1
        if m[1].startswith(("../", "?")):
            continue
        tail = _TAIL.fullmatch(m[2])
        if not tail:
            raise ValueError(f"{m[1]!r} has no date and size")
        out.append({"path": folder + unquote(m[1]), "folder": m[1].endswith("/"), "size": None if tail[2] == "-" else int(tail[2]), "date": tail[1]})
    if not links:
        raise ValueError("no links in the listing")
    return out


@F.pandas_udf(LISTED)
def read_listing(pages: pd.Series) -> pd.Series:
    return pages.map(listing)


def export_jsonl(pairs: DataFrame, path: str) -> None:
    pairs.write.mode("overwrite").option("compression", "gzip").json(path)


def tsv_rows(pairs: DataFrame) -> DataFrame:
    """(en, zh, kind) with tabs and line ends as spaces."""
    return pairs.select(*(F.regexp_replace(F.coalesce(c, F.lit("")), r"[\t\r\n]", " ").alias(c) for c in ("en", "zh", "kind")))


def export_tsv(pairs: DataFrame, path: str) -> None:
    tsv_rows(pairs).write.mode("overwrite").option("sep", "\t").option("header", True).option("quote", "").csv(path)


def _xml(c: str) -> Column:
    out = F.coalesce(F.col(c), F.lit(""))
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(char), F.lit(entity))
    return out


def tmx_unit() -> Column:
    """The translation unit of a row (id, en, zh, kind)."""
    return F.concat(
        F.lit('<tu tuid="'), F.col("id").cast("string"), F.lit('"><prop type="x-kind">'), _xml("kind"), F.lit('</prop><tuv xml:lang="en"><seg>'), _xml("en"),
        F.lit('</seg></tuv><tuv xml:lang="zh-CN"><seg>'), _xml("zh"), F.lit("</seg></tuv></tu>"),
    )


def export_tmx(pairs: DataFrame, path: str) -> None:
    """One document over the files of a folder, in order of their names: head, units by id, foot."""
    ends = [(0, None, '<?xml version="1.0" encoding="UTF-8"?>\n<tmx version="1.4">\n<header segtype="sentence" adminlang="en" srclang="en" datatype="plaintext"/>\n<body>'), (2, None, "</body>\n</tmx>")]
    head = pairs.sparkSession.createDataFrame(ends, "part int, id long, unit string")
    units = pairs.select(F.lit(1).alias("part"), F.col("id").cast("long").alias("id"), tmx_unit().alias("unit"))
    head.unionByName(units).orderBy("part", "id").select("unit").write.mode("overwrite").text(path)
