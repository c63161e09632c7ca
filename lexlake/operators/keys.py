"""Stable keys, running ids and ordered digests of dictionaries."""

from __future__ import annotations

import hashlib
import struct

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexlake.operators.once import numbered


def entry_keys(entries: DataFrame, dictionaries: DataFrame) -> DataFrame:
    """(entry_id, key): dictionary:occurrence:headword, occurrences counted in id order."""
    keyed = numbered(entries.select("id", "dict_id", "headword"), ["dict_id", "headword"], "id", "nth")
    names = dictionaries.select(F.col("id").alias("dict_id"), F.col("key").alias("dict_key"))
    return keyed.join(names, "dict_id").select(F.col("id").alias("entry_id"), F.concat_ws(":", "dict_key", "nth", "headword").alias("key"))


def sense_keys(senses: DataFrame, keys: DataFrame) -> DataFrame:
    """(sense_id, key): the entry's key and the sense's place in it."""
    return senses.join(keys, "entry_id").select(F.col("id").alias("sense_id"), F.concat_ws(":", "key", "ord").alias("key"))


def shard_offsets(rows: DataFrame, shard: str) -> DataFrame:
    """(shard, n, first_id): running ids of shards appended in order. The shards are summed first,
    so the one window runs over as many rows as there are shards."""
    n = rows.groupBy(shard).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy(shard).rowsBetween(Window.unboundedPreceding, -1))
    return n.select(shard, "n", (F.coalesce(before, F.lit(0)) + 1).alias("first_id"))


def ordered_digests(rows: DataFrame, group: str, order: list[str], fields: list[str], block: int = 4096, levels: int = 5) -> DataFrame:
    """(group, n, digest): SHA-256 over the length-prefixed fields of each group in order.

    The first order column is a whole number. Its values are digested in blocks, the digests of
    blocks again in blocks, and so on, so no task ever holds a group: the digests of a level are at
    most block for each block. Null fields count as empty.
    """
    text = F.concat(*(F.concat(F.lpad(F.length(F.coalesce(F.col(f).cast("string"), F.lit(""))).cast("string"), 10, "0"), F.coalesce(F.col(f).cast("string"), F.lit(""))) for f in fields))
    level = rows.select(group, F.floor(F.col(order[0]) / block).alias("part"), F.struct(*order).alias("o"), F.sha2(text, 256).alias("d"), F.lit(1).cast("long").alias("n"))
    for i in range(levels):
        one = F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o", "d"))), lambda r: r["d"]), ""), 256)
        level = level.groupBy(group, "part").agg(F.sum("n").alias("n"), one.alias("d"))
        if i < levels - 1:
            level = level.select(group, F.floor(F.col("part") / block).alias("part"), F.struct(F.col("part").alias("p")).alias("o"), "d", "n")
    return level.select(group, "n", F.col("d").alias("digest"))


def streamed_digest(fields: list[list[str]]) -> str:
    """The reference layout of a digest over few rows: two lengths as 64-bit numbers, then the bytes."""
    h = hashlib.sha256()
    for row in fields:
        raw = [x.encode() for x in row]
        h.update(struct.pack(f"<{len(raw)}Q", *map(len, raw)))
        for x in raw:
            h.update(x)
    return h.hexdigest()


def fold_popups(entries: DataFrame, senses: DataFrame, popups: DataFrame) -> DataFrame:
    """(main_id, ord, sense_id): the senses of the main entries with those of their popups appended.

    popups is (popup_id, main_id); a popup's senses follow the main entry's, popups in id order.
    """
    own = senses.join(entries.select(F.col("id").alias("entry_id")), "entry_id").select(F.col("entry_id").alias("main_id"), F.lit(-1).cast("long").alias("popup"), "ord", F.col("id").alias("sense_id"))
    own = own.join(popups.select(F.col("popup_id").alias("main_id")), "main_id", "left_anti")
    moved = senses.join(popups.withColumnRenamed("popup_id", "entry_id"), "entry_id").select("main_id", F.col("entry_id").alias("popup"), "ord", F.col("id").alias("sense_id"))
    place = F.row_number().over(Window.partitionBy("main_id").orderBy("popup", "ord", "sense_id")) - 1
    return own.unionByName(moved).select("main_id", place.alias("ord"), "sense_id")
