"""Files of folders as records of the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Endings of companions, and of archives with their parts.
ASSETS = r"\.(?:css|js|ttf|otf|woff2?)$"
ARCHIVE = r"(\.part\d+\.rar|\.7z\.\d{3}|\.\d{3}|\.zip|\.rar|\.7z|\.tar\.gz)$"


def records(files: DataFrame) -> DataFrame:
    """(folder, kind, main_name, main_size, size, n_files, has_resources) of files (folder, name, size).

    Each .mdx takes the .mdd, .css and .js files of its name; in a folder with one dictionary it takes
    all other style sheets, scripts and fonts too. The other .mdd files make packs by name, led by the
    unnumbered volume; archives make a record for each name and scheme of parts, led by the first
    part. Other files belong to no record. Null names, sizes and folders count as no files, a file
    listed twice as one. Files meet their dictionary by join, so a folder of any size is spread.
    """
    low = F.lower("name")
    f = files.select("folder", "name", "size").where("folder is not null and name is not null and size is not null").distinct().withColumn("low", low)
    mdx = f.where(F.col("low").endswith(".mdx")).select("folder", F.regexp_replace("low", r"\.mdx$", "").alias("stem"))
    rest = f.where(~F.col("low").endswith(".mdx"))
    # A name that ends in a number and .mdd may be a volume or a name of its own: both are looked up.
    whole = F.when(F.col("low").rlike(r"\.(?:mdd|css|js)$"), F.regexp_replace("low", r"\.(?:mdd|css|js)$", ""))
    bare = F.when(F.col("low").rlike(r"\.\d+\.mdd$"), F.regexp_replace("low", r"\.\d+\.mdd$", ""))
    tried = rest.select("folder", "name", "size", "low", F.posexplode(F.array_compact(F.array(whole, bare))).alias("try", "stem"))
    claimed = tried.join(mdx, ["folder", "stem"], "left_semi").groupBy("folder", "name", "size", "low").agg(F.min_by("stem", "try").alias("stem"))
    free = rest.join(claimed.select("folder", "name"), ["folder", "name"], "left_anti")
    alone = mdx.groupBy("folder").agg(F.count("*").alias("n"), F.min("stem").alias("stem")).where("n = 1")
    assets = free.where(F.col("low").rlike(ASSETS)).join(alone.select("folder", "stem"), "folder").select("folder", "name", "size", "low", "stem")
    own = f.where(F.col("low").endswith(".mdx")).withColumn("stem", F.regexp_replace("low", r"\.mdx$", ""))
    dictionaries = own.unionByName(claimed).unionByName(assets).withColumns({"kind": F.lit("mdx"), "rank": F.when(F.col("low").endswith(".mdx"), F.lit(0)).otherwise(F.lit(1)).cast("long")})
    number = F.coalesce(F.expr("try_cast(regexp_extract(low, '\\\\.(\\\\d+)\\\\.mdd$', 1) as long)") + 1, F.lit(0))
    packs = free.where(F.col("low").endswith(".mdd")).withColumns({"stem": F.regexp_replace("low", r"(?:\.\d+)?\.mdd$", ""), "kind": F.lit("mdd"), "rank": number.cast("long")})
    part = F.regexp_extract("low", ARCHIVE, 1)
    order = F.coalesce(F.expr("try_cast(regexp_extract(low, '(\\\\d+)(?:\\\\.rar)?$', 1) as long)"), F.lit(0))
    archives = free.where(part != "").withColumns({"stem": F.concat(F.regexp_replace("low", ARCHIVE, ""), F.lit("|"), F.regexp_replace(part, r"\d+", "0")), "kind": F.lit("archive"), "rank": order.cast("long")})
    every = dictionaries.unionByName(packs).unionByName(archives)
    main = F.min_by(F.struct("name", "size"), F.struct("rank", "name"))
    g = every.groupBy("folder", "kind", "stem").agg(main.alias("m"), F.sum("size").alias("size"), F.count("*").alias("n_files"), F.bool_or(F.col("low").endswith(".mdd")).alias("mdd"))
    return g.select("folder", "kind", F.col("m.name").alias("main_name"), F.col("m.size").alias("main_size"), "size", "n_files", (F.col("mdd") & (F.col("kind") != "archive")).alias("has_resources"))


def merged(found: DataFrame) -> DataFrame:
    """(kind, main_name, main_size, copies, bytes): equal records of several folders as one; the copy with resources and most bytes leads."""
    return found.groupBy("kind", F.lower("main_name").alias("main_name"), "main_size").agg(F.count("*").alias("copies"), F.max(F.struct("has_resources", "size"))["size"].alias("bytes"))


def shrunk(before: DataFrame, after: DataFrame, most: float = 0.2) -> DataFrame:
    """One row (was, now) if the new listing has lost more than this part of its records, else none."""
    n = before.agg(F.count("*").alias("was")).crossJoin(after.agg(F.count("*").alias("now")))  # one row each
    return n.where(F.col("now") < (1 - most) * F.col("was"))
