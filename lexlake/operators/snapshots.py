"""Problem 1: what changed between full snapshots of a table.

Keys are spread over blocks by their hash and numbered within the block in the order in which
they first appear. Where a store is given, the numbers and the number of blocks are kept there: a
later run finds every known key under its number and appends only the new ones, so the number of
a key never changes. Without a store the numbers live for one run. Each block keeps, for each snapshot, a compressed bitmap of the ordinals present and one vector of
field hashes aligned to the ordinals. Bitmap differences of consecutive snapshots give what was
added and removed; the vectors at the common ordinals give what changed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexlake.operators.bitmaps import Bitmap

#: Rows that a block should hold, over all snapshots, when the number of blocks is chosen.
BLOCK_ROWS = 50_000


def value_hash(c: Column) -> Column:
    """A hash in which null differs from every value."""
    return F.when(c.isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64(F.to_json(F.struct(c.alias("v")), {"ignoreNullFields": "false"})))


def any_order(locations: Column) -> Column:
    """locations with both levels of arrays sorted."""
    return F.array_sort(
        F.transform(locations, lambda x: F.struct(x["folder"].alias("folder"), F.array_sort(x["files"]).alias("files"), x["main_name"].alias("main_name"), x["main_size"].alias("main_size")))
    )


def listing_date(c: Column) -> Column:
    """The day as yyyy-MM-dd from either notation; anything else stays as it is."""
    day = F.try_to_timestamp(c, F.lit("yyyy-MM-dd"))
    printed = F.try_to_timestamp(c, F.lit("dd-MMM-yyyy HH:mm"))
    return F.coalesce(F.date_format(F.coalesce(day, printed), "yyyy-MM-dd"), c)


def latest(df: DataFrame, snapshot: str, key: str, loaded: str, fields: dict[str, Column]) -> DataFrame:
    """(snap, id, h0, h1, ...): for each snapshot and key the field hashes of the row loaded last.

    Rows loaded at the same time are told apart by their hashes, a missing time comes first.
    """
    hashes = [value_hash(c).alias(f"h{i}") for i, c in enumerate(fields.values())]
    rows = df.select(F.col(snapshot).cast("long").alias("snap"), F.col(key).alias("id"), F.struct(F.col(loaded).alias("at"), *hashes).alias("r")).where("snap is not null")
    return rows.groupBy("snap", "id").agg(F.max("r").alias("r")).select("snap", "id", *(F.col(f"r.h{i}") for i in range(len(fields))))


def ordinals(rows: DataFrame, blocks: int, known: DataFrame | None = None) -> DataFrame:
    """rows of (snap, id, ...) with block and ord: numbers of the ids, from 0 in each block.

    Ids in known (block, id, ord) keep their numbers, new ones go on after the greatest of their block.
    """
    placed = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    if known is not None:
        old = known.select(F.col("block").alias("b"), F.col("id").alias("i"), F.col("ord").alias("had"))
        placed = placed.join(old, (F.col("block") == F.col("b")) & F.col("id").eqNullSafe(F.col("i")), "left").drop("b", "i")
        top = known.groupBy("block").agg((F.max("ord") + 1).alias("next"))  # one row for each block
        placed = placed.join(F.broadcast(top), "block", "left")
    else:
        placed = placed.withColumns({"had": F.lit(None).cast("long"), "next": F.lit(0).cast("long")})
    first = placed.repartition("block").withColumn("since", F.min("snap").over(Window.partitionBy("block", "id")))
    new = F.dense_rank().over(Window.partitionBy("block", F.col("had").isNotNull()).orderBy("since", "id")) - 1 + F.coalesce("next", F.lit(0))
    return first.withColumn("ord", F.coalesce("had", new.cast("long"))).drop("since", "had", "next")


class Store:
    """Numbers of keys kept in a folder that all executors reach: (blocks, block, id, ord)."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        try:
            self.known: DataFrame | None = spark.read.parquet(folder)
            self.blocks: int | None = self.known.select("blocks").first()[0]
        except (AnalysisException, TypeError):  # no folder yet, or no key in it
            self.known = self.blocks = None

    def numbered(self, rows: DataFrame, blocks: int) -> DataFrame:
        """rows with block and ord; new keys are appended to the store first, in one committed write."""
        self.blocks = self.blocks or blocks
        found = ordinals(rows, self.blocks, self.known)
        new = found.select(F.lit(self.blocks).alias("blocks"), "block", "id", "ord").distinct()
        if self.known is not None:
            new = new.join(self.known.select("block", "ord"), ["block", "ord"], "left_anti")
        new.write.mode("append").parquet(self.folder)
        self.known = self.spark.read.parquet(self.folder)
        return ordinals(rows, self.blocks, self.known)


def changes(df: DataFrame, snapshot: str, key: str, loaded: str, fields: dict[str, Column], block_rows: int = BLOCK_ROWS, store: str | None = None) -> DataFrame:
    """(snapshot_no, id, change): added, removed or changed against the next lower snapshot present.

    Of several rows of a key in a snapshot the one loaded last counts. Fields differ as values;
    null differs from any value and equals null. Rows without a snapshot number are no part of
    any; a null key is a key like another. The first snapshot gives no rows; an empty table gives
    none. The list of snapshot numbers, one for each delivery, goes to the driver. store is a
    folder in which the numbers of the keys are kept from run to run.
    """
    counts = df.groupBy(F.col(snapshot).cast("long").alias("s")).count().collect()
    snaps = sorted(r["s"] for r in counts if r["s"] is not None)
    blocks = max(1, -(-sum(r["count"] for r in counts) // block_rows))
    rows = latest(df, snapshot, key, loaded, fields)
    rows = ordinals(rows, blocks) if store is None else Store(df.sparkSession, store).numbered(rows, blocks)
    names = [f"h{i}" for i in range(len(fields))]

    def compare(t: pa.Table) -> pa.Table:
        snap, at = t.column("snap").to_numpy(), t.column("ord").to_numpy()
        ids = t.column("id")
        size = int(at.max()) + 1
        place = np.zeros(size, np.int64)
        place[at] = np.arange(len(at))
        vectors = {}
        for s in snaps:
            own = np.flatnonzero(snap == s)
            v = np.zeros((len(names), size), np.int64)
            for i, n in enumerate(names):
                v[i, at[own]] = t.column(n).to_numpy()[own]
            vectors[s] = Bitmap.of(at[own]), v
        out: list[tuple[int, str, np.ndarray]] = []
        for before, s in zip(snaps, snaps[1:]):
            (old, a), (new, b) = vectors[before], vectors[s]
            common = new.and_(old).ordinals()
            out.append((s, "added", new.and_not(old).ordinals()))
            out.append((s, "removed", old.and_not(new).ordinals()))
            out.append((s, "changed", common[(a[:, common] != b[:, common]).any(axis=0)]))
        return pa.table(
            {
                "snapshot_no": np.concatenate([np.full(len(o), s, np.int64) for s, _, o in out] or [np.empty(0, np.int64)]),
                "id": ids.take(pa.array(place[np.concatenate([o for *_, o in out] or [np.empty(0, np.int64)]).astype(np.int64)])).combine_chunks(),
                "change": pa.array([c for _, c, o in out for _ in range(len(o))], pa.string()),
            }
        )

    kind = dict(df.dtypes)[key]
    return rows.groupBy("block").applyInArrow(compare, f"snapshot_no long, id {kind}, change string")


def record_changes(df: DataFrame, store: str | None = None) -> DataFrame:
    """The changes of catalog records in name, size, locations and date."""
    fields = {"name": F.col("name"), "size": F.col("size"), "locations": any_order(F.col("locations")), "date": listing_date(F.col("date"))}
    return changes(df, "snapshot_no", "id", "loaded_at", fields, store=store)
