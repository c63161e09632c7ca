"""Which sources are kept, in which reading order, and what has to be reviewed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Least share of English, scored pairs, alignment, and the spread of single scores.
ENGLISH_SHARE, LEAST_SCORED, LEAST_ALIGNMENT, SPREAD = 0.5, 5, 0.3, 0.5


def qualifies(alignment: Column, scored: Column) -> Column:
    """Enough scored pairs, and a mean that stays above the least one by its confidence."""
    return (scored >= LEAST_SCORED) & (alignment - SPREAD / F.sqrt(scored) >= LEAST_ALIGNMENT)


def choose(probes: DataFrame, overrides: DataFrame) -> DataFrame:
    """(id, keep, reading, extractor, reason) of probes (id, status, english, foreign, en_zh, n_en_zh, zh_en, n_zh_en).

    The better order is one that qualifies, then the one with the higher mean, then more pairs, then
    en-zh. overrides (id, extractor) keeps a readable source whatever its alignment. Missing means
    count as 0.
    """
    orders = [F.struct(qualifies(F.coalesce(F.col(c), F.lit(0.0)), F.coalesce(F.col(f"n_{c}"), F.lit(0))).alias("ok"), F.coalesce(F.col(c), F.lit(0.0)).alias("mean"), F.coalesce(F.col(f"n_{c}"), F.lit(0)).alias("n"), F.lit(first).alias("first")) for c, first in (("en_zh", 1), ("zh_en", 0))]
    rows = probes.join(overrides, "id", "left").withColumn("b", F.greatest(*orders))
    every = F.col("english") + F.col("foreign")
    reason = (
        F.when(F.col("status") != "ok", F.col("status"))
        .when((every > 0) & (F.col("english") < ENGLISH_SHARE * every), "mostly another language")
        .when(F.col("b.n") < LEAST_SCORED, "too few scored pairs")
        .when(~F.col("b.ok"), "not clearly translations")
        .otherwise("")
    )
    reading = F.when(F.col("b.first") == 1, "en-zh").otherwise("zh-en")
    forced = F.col("extractor").isNotNull() & (F.col("status") == "ok")
    return rows.select("id", (forced | (reason == "")).alias("keep"), reading.alias("reading"), F.when(forced, F.col("extractor")).otherwise("text").alias("extractor"), reason.alias("reason"))


def kept_twice(choices: DataFrame, files: DataFrame) -> DataFrame:
    """(file, n): files (id, file) that several kept sources read."""
    return choices.where("keep").join(files, "id").groupBy("file").agg(F.count("*").alias("n")).where("n > 1")


def verdict_changes(bad: Column, pending: Column, n: Column, least: float = 0.95) -> Column:
    """Whether reading the pending flags could change a source's verdict."""
    return (pending > 0) & (1 - bad / n >= least) & (1 - (bad + pending) / n < least)


def reused(verdicts: DataFrame, staged: DataFrame) -> DataFrame:
    """Verdicts (id, sha256, ...) whose staged file is still the same."""
    return verdicts.join(staged.select("id", "sha256"), ["id", "sha256"], "left_semi")


def with_labels(judged: DataFrame, labels: DataFrame) -> DataFrame:
    """judged (id, i, bad, pending) with reviewed labels (id, i, label) taking precedence."""
    rows = judged.join(labels, ["id", "i"], "left")
    return rows.select("id", "i", F.coalesce(F.col("label") == "bad", "bad").alias("bad"), (F.col("pending") & F.col("label").isNull()).alias("pending"))


def current_and_stale(previous: DataFrame, current: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of previous whose id is still listed, and the others."""
    return previous.join(current, "id", "left_semi"), previous.join(current, "id", "left_anti")


def resolved_picks(picks: DataFrame, records: DataFrame) -> DataFrame:
    """(pick, id): for each curated pick (pick, name, folder) the largest record (id, name, folder, size) of that name in
    that folder, null if there is none; ties go to the smaller id."""
    met = picks.join(records.withColumnRenamed("folder", "at"), "name", "left").where("folder is null or folder = '' or at is null or contains(at, folder)")
    best = met.where("id is not null").groupBy("pick").agg(F.min(F.struct((-F.col("size")).alias("s"), "id"))["id"].alias("id"))
    return picks.select("pick").distinct().join(best, "pick", "left")


def entry_id(text: Column) -> Column:
    """An entry's id in a path: ASCII digits that fit 64 bits, else null."""
    return F.when(text.rlike("^[0-9]{1,19}$"), text.try_cast("long"))
