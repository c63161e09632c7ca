"""Problem 5, by fusion: the likeliest value of each field where sources disagree and copy each other.

Sources that share false values more often than chance allows are taken to depend on each other (the
published copy-aware truth discovery over conflicting sources). Accuracies of the sources and the
dependence between each two of them are estimated in turns with the values' probabilities; a copied
vote counts for little. Values are brought together by group once; the rounds read them where they
lie and shuffle nothing but sums. Sources are dictionaries, so all that reaches the driver are numbers
for each source and each two sources that speak of the same.
"""

from __future__ import annotations

import warnings
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexlake.llm.fusion import FIELDS, has_value
from lexlake.session import cut_lineage

#: Values that a wrong source may choose from, share of copied values of a copier, prior of
#: dependence, accuracy of a source that nobody audited, bounds of accuracies.
WRONG, COPIED, PRIOR, UNKNOWN, BOUNDS = 10, 0.8, 0.1, 0.8, (0.05, 0.99)
#: Estimation ends when no accuracy moves by more than SETTLED, or after ROUNDS.
ROUNDS, SETTLED = 20, 0.005
#: The driver holds numbers for each source and each two sources that speak of the same; more sources are refused.
MAX_SOURCES = 5_000
#: A group with more records than this is spread over SALTS tasks.
HOT_RECORDS, SALTS = 100_000, 64
#: Patterns of sources whose weights or counts a task keeps.
KEPT = 200_000


def claims(pairs: DataFrame, index: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """(cluster, field, value, sources): each different value of a group's field with the numbers of the sources
    that give it, at most one number for each source; rows without a source have the number 0."""
    each = F.array(*(F.struct(F.lit(f).alias("field"), F.when(has_value(F.col(f)), F.trim(F.col(f))).alias("value")) for f in fields))
    rows = pairs.where("cluster is not null").join(index, "dictionary_id", "left").select("cluster", F.coalesce("source", F.lit(0)).alias("source"), F.explode(each).alias("x"))
    rows = rows.select("cluster", "source", "x.field", "x.value").where("value is not null")
    return rows.groupBy("cluster", "field", "value").agg(F.array_sort(F.collect_set("source")).alias("sources"))


@dataclass
class Sources:
    """What is known of the sources: accuracies, and for each two that speak of the same how often they do,
    how likely one copies the other. Two are numbered first * n + second, the smaller first."""

    accuracy: np.ndarray
    pairs: np.ndarray
    both: np.ndarray
    copying: np.ndarray

    def of(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """How likely one of each two copies the other; 0 for two that never speak of the same."""
        if not len(self.pairs):
            return np.zeros(len(first))
        key = np.minimum(first, second) * len(self.accuracy) + np.maximum(first, second)
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.copying[at], 0.0)


def dependence(same_false: np.ndarray, differ: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For two sources with accuracies a and b the probability that one copies the other.

    Only groups in which the two aren't both right tell: there independent sources seldom give the
    same false value, a copier gives it nearly always.
    """
    false = (1 - a) * (1 - b) / WRONG
    alone = false / (1 - a * b)
    copied = COPIED + (1 - COPIED) * alone
    ratio = same_false * (np.log(alone) - np.log(copied)) + differ * (np.log(1 - alone) - np.log(1 - copied))
    return 1 / (1 + (1 - PRIOR) / PRIOR * np.exp(np.clip(ratio, -50, 50)))


def vote(sources: np.ndarray, known: Sources) -> float:
    """The weight of a value that these sources give: the most accurate first, each less what it may have copied."""
    a = known.accuracy
    order = sources[np.argsort(-a[sources], kind="stable")]
    n = len(order)
    later, before = np.tril_indices(n, -1)
    free = np.ones(n)
    np.multiply.at(free, later, 1 - COPIED * known.of(order[later], order[before]))
    return float((np.log(WRONG * a[order] / (1 - a[order])) * free).sum())


def placed(values: DataFrame, pairs: DataFrame, hot_records: int) -> tuple[DataFrame, bool]:
    """(values with a salt, in partitions that hold each group whole and in order; whether any group is spread).

    The records of each group, counted with partial sums, bound its values. Groups with more than
    hot_records are at most rows / hot_records; they are spread by their values.
    """
    hot = [(r[0], True) for r in pairs.where("cluster is not null").groupBy("cluster").count().where(F.col("count") > hot_records).select("cluster").collect()]
    if hot:
        rows = values.join(F.broadcast(values.sparkSession.createDataFrame(hot, "cluster long, hot boolean")), "cluster", "left")
        values = rows.withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("value"), F.lit(SALTS)).cast("int")).otherwise(-1)).drop("hot")
    else:
        values = values.withColumn("salt", F.lit(-1))
    return cut_lineage(values.repartition("cluster", "field", "salt").sortWithinPartitions("cluster", "field", "salt")), bool(hot)


@dataclass
class Part:
    """Whole groups of values, one after the other: arrays over values, and where each group begins."""

    rows: pa.RecordBatch
    begin: np.ndarray
    owner: np.ndarray  # group of each value
    source: np.ndarray
    at: np.ndarray  # where the sources of each value begin
    size: np.ndarray

    def pattern(self, k: int) -> bytes:
        return self.source[self.at[k] : self.at[k] + self.size[k]].tobytes()


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[Part]:
    """The groups of a partition; a group that goes on in the next batch waits for it."""
    rest: pa.RecordBatch | None = None

    def part(rows: pa.RecordBatch, begin: np.ndarray) -> Part:
        lists = rows.column("sources")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        source = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
        owner = np.zeros(rows.num_rows, np.int64)
        owner[begin[1:]] = 1
        return Part(rows, begin, np.cumsum(owner), source, offsets[:-1] - offsets[0], np.diff(offsets))

    for batch in batches:
        rows = batch if rest is None else pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
        if not rows.num_rows:
            continue
        cluster, salt = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("cluster", "salt"))
        field = rows.column("field").dictionary_encode().indices.to_numpy()
        begin = np.flatnonzero(np.r_[True, (cluster[1:] != cluster[:-1]) | (field[1:] != field[:-1]) | (salt[1:] != salt[:-1])])
        rest = rows.slice(int(begin[-1]))
        if len(begin) > 1:
            yield part(rows.slice(0, int(begin[-1])), begin[:-1])
    if rest is not None:
        yield part(rest, np.zeros(1, np.int64))


class Weights:
    """The weights of values by the patterns of their sources."""

    def __init__(self, known: Sources):
        self.known, self.seen = known, {}
        self.alone = np.log(WRONG * known.accuracy / (1 - known.accuracy))

    def of(self, p: Part) -> np.ndarray:
        w = self.alone[p.source[np.minimum(p.at, max(0, len(p.source) - 1))]] if len(p.source) else np.zeros(len(p.size))
        for k in np.flatnonzero(p.size > 1):
            key = p.pattern(k)
            weight = self.seen.get(key)
            if weight is None:
                if len(self.seen) > KEPT:
                    self.seen.clear()
                weight = self.seen[key] = vote(np.frombuffer(key, np.int32).astype(np.int64), self.known)
            w[k] = weight
        return w


Totals = dict[tuple[int, str], tuple[float, float]]


def probabilities(p: Part, w: np.ndarray, totals: Totals) -> np.ndarray:
    """The probability of each value: its weight against those of the others of its group, and of the
    other values that a wrong source might have given, each without a vote. totals holds (greatest
    weight, sum relative to it) of the groups that are spread."""
    n = np.diff(np.append(p.begin, len(w)))
    top = np.maximum.reduceat(w, p.begin)
    total = np.add.reduceat(np.exp(w - top[p.owner]), p.begin) + np.maximum(WRONG + 1 - n, 0) * np.exp(-top)
    if totals:
        salt = p.rows.column("salt").to_numpy(zero_copy_only=False)
        for g in np.flatnonzero(salt[p.begin] >= 0):
            k = int(p.begin[g])
            top[g], total[g] = totals[p.rows.column("cluster")[k].as_py(), p.rows.column("field")[k].as_py()]
    return np.exp(w - top[p.owner]) / total[p.owner]


def spread_totals(values: DataFrame, known: Sources) -> Totals:
    """(greatest weight, sum relative to it) of each group that is spread; SALTS rows of each reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = Weights(known)
        for p in parts(batches):
            w = weights.of(p)
            top = np.maximum.reduceat(w, p.begin)
            e = np.add.reduceat(np.exp(w - top[p.owner]), p.begin)
            n = np.diff(np.append(p.begin, len(w)))
            at = pa.array(p.begin)
            yield pa.RecordBatch.from_arrays([p.rows.column("cluster").take(at), p.rows.column("field").take(at), pa.array(top), pa.array(e), pa.array(n)], names=["cluster", "field", "top", "e", "n"])

    found: dict[tuple[int, str], list] = {}
    for r in values.where("salt >= 0").mapInArrow(run, "cluster long, field string, top double, e double, n long").collect():
        found.setdefault((r.cluster, r.field), []).append(r)
    out = {}
    for key, own in found.items():
        top, n = max(r.top for r in own), sum(r.n for r in own)
        out[key] = top, float(sum(r.e * np.exp(r.top - top) for r in own) + max(WRONG + 1 - n, 0) * np.exp(-top))
    return out


def pair_counts(patterns: Counter, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(pairs, how often) of two sources in a counter of patterns."""
    keys, counts = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for pattern, times in patterns.items():
        s = np.frombuffer(pattern, np.int32).astype(np.int64)
        i, j = np.triu_indices(len(s), 1)
        keys.append(s[i] * n + s[j])
        counts.append(np.full(len(i), times))
    key, at = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(at, np.concatenate(counts), len(key)).astype(np.int64)


def _counted(values: DataFrame, n: int, teller) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """For each kind of pattern (pairs, how often), summed over all tasks; teller() gives each task a function that
    counts the patterns of a part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: dict[str, Counter] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for kind, c in counters.items():
                key, times = pair_counts(c, n)
                yield pa.RecordBatch.from_arrays([pa.array([kind] * len(key), pa.string()), pa.array(key), pa.array(times)], names=["kind", "pair", "n"])
            counters.clear()

        tally = teller()
        for p in parts(batches):
            tally(p, counters)
            if sum(map(len, counters.values())) > KEPT:
                yield from out()
        yield from out()

    rows = values.mapInArrow(run, "kind string, pair long, n long").groupBy("kind", "pair").agg(F.sum("n").alias("n")).orderBy("kind", "pair").toArrow()
    kinds, pair, times = (rows.column(c).to_numpy() for c in ("kind", "pair", "n"))
    return {k: (pair[kinds == k], times[kinds == k]) for k in set(kinds.tolist())}


def speakers(values: DataFrame, n: int, spread: bool) -> tuple[np.ndarray, np.ndarray]:
    """(pairs, how often) of two sources that speak of the same field of the same group."""

    def tally(p: Part, counters: dict[str, Counter]) -> None:
        own = np.unique(np.repeat(p.owner, p.size) * n + p.source)
        group, source = own // n, (own % n).astype(np.int32)
        cut = np.flatnonzero(np.r_[True, np.diff(group) > 0, True])
        c = counters.setdefault("both", Counter())
        for a, b in zip(cut[:-1][np.diff(cut) > 1], cut[1:][np.diff(cut) > 1]):
            c[source[a:b].tobytes()] += 1

    key, times = _counted(values.where("salt < 0"), n, lambda: tally).get("both", (np.empty(0, np.int64),) * 2)
    if spread:
        each = values.where("salt >= 0").select("cluster", "field", F.explode("sources").alias("s")).distinct()
        more = Counter(np.array(sorted(r.s), np.int32).tobytes() for r in each.groupBy("cluster", "field").agg(F.collect_set("s").alias("s")).collect())  # n numbers for each group that is spread
        key_, times_ = pair_counts(more, n)
        key, at = np.unique(np.concatenate([key, key_]), return_inverse=True)
        times = np.bincount(at, np.concatenate([times, times_]), len(key)).astype(np.int64)
    return key, times


def agreement(values: DataFrame, known: Sources, totals: Totals) -> tuple[np.ndarray, np.ndarray]:
    """For each two sources that speak of the same how often they give the same likely, and the same unlikely value."""

    def teller():
        weights = Weights(known)

        def tally(p: Part, counters: dict[str, Counter]) -> None:
            prob = probabilities(p, weights.of(p), totals)
            for k in np.flatnonzero(p.size > 1):
                counters.setdefault("true" if prob[k] >= 0.5 else "false", Counter())[p.pattern(k)] += 1

        return tally

    got = _counted(values, len(known.accuracy), teller)
    out = []
    for kind in ("true", "false"):
        key, times = got.get(kind, (np.empty(0, np.int64),) * 2)
        full = np.zeros(len(known.pairs))
        full[np.searchsorted(known.pairs, key)] = times
        out.append(full)
    return out[0], out[1]


def accuracies(values: DataFrame, known: Sources, totals: Totals) -> np.ndarray:
    """The mean probability of what each source says, with one more value of the usual accuracy; two numbers for each
    source reach the driver."""
    n = len(known.accuracy)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, sums = Weights(known), np.zeros((2, n))
        for p in parts(batches):
            prob = np.repeat(probabilities(p, weights.of(p), totals), p.size)
            sums[0] += np.bincount(p.source, prob, n)
            sums[1] += np.bincount(p.source, minlength=n)
        s = np.flatnonzero(sums[1])
        yield pa.RecordBatch.from_arrays([pa.array(s), pa.array(sums[0, s]), pa.array(sums[1, s])], names=["s", "p", "n"])

    sums = np.zeros((2, n))
    for r in values.mapInArrow(run, "s long, p double, n double").groupBy("s").agg(F.sum("p").alias("p"), F.sum("n").alias("n")).collect():
        sums[:, r.s] = r.p, r.n
    return np.clip(np.where(sums[1] > 0, (sums[0] + UNKNOWN) / (sums[1] + 1), known.accuracy), *BOUNDS)


def estimate(values: DataFrame, accuracy: np.ndarray, spread: bool, rounds: int = ROUNDS) -> tuple[Sources, float]:
    """(what is known of the sources, how far the last round still moved an accuracy)."""
    key, both = speakers(values, len(accuracy), spread)
    known = Sources(accuracy, key, both, np.zeros(len(key)))
    moved = 0.0
    first, second = key // len(accuracy), key % len(accuracy)
    for _ in range(rounds):
        # Dependence first: sources that copy each other would else pass for accurate.
        same_true, same_false = agreement(values, known, spread_totals(values, known) if spread else {})
        differ = np.maximum(both - same_true - same_false, 0)
        known = Sources(known.accuracy, key, both, dependence(same_false, differ, known.accuracy[first], known.accuracy[second]))
        now = accuracies(values, known, spread_totals(values, known) if spread else {})
        moved = float(np.abs(now - known.accuracy).max())
        known = Sources(now, key, both, known.copying)
        if moved <= SETTLED:
            break
    return known, moved


def fused(pairs: DataFrame, dictionaries: DataFrame, fields: tuple[str, ...] = FIELDS, rounds: int = ROUNDS, hot_records: int = HOT_RECORDS) -> DataFrame:
    """(cluster, field, value, posterior, sources): the likeliest value of each field of each group.

    Ties go to the smaller value. Fields without any value, null clusters and empty tables give no
    row; a row without a dictionary, or of one that isn't listed, counts for one unknown source.
    Precision of a dictionary, where audited, is its accuracy at the start. Warns if the accuracies
    haven't settled after rounds.
    """
    listed = dictionaries.groupBy("id").agg(F.max("precision").alias("precision")).where("id is not null").orderBy("id").limit(MAX_SOURCES + 1).collect()
    if len(listed) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    index = pairs.sparkSession.createDataFrame([(r.id, i + 1) for i, r in enumerate(listed)], "dictionary_id long, source int")
    accuracy = np.clip(np.array([UNKNOWN, *(UNKNOWN if r.precision is None else r.precision for r in listed)]), *BOUNDS)
    values, spread = placed(claims(pairs, index, fields), pairs, hot_records)
    known, moved = estimate(values, accuracy, spread, rounds)
    if moved > SETTLED:
        warnings.warn(f"accuracies of sources still moved by {moved:.4f} after {rounds} rounds", stacklevel=2)
    totals = spread_totals(values, known) if spread else {}

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = Weights(known)
        for p in parts(batches):
            prob = np.round(probabilities(p, weights.of(p), totals), 9)
            value = p.rows.column("value").to_numpy(zero_copy_only=False)
            near = np.flatnonzero(prob >= np.maximum.reduceat(prob, p.begin)[p.owner])
            first: dict[int, int] = {}
            for k in near.tolist():
                g = int(p.owner[k])
                if g not in first or value[k].encode() < value[first[g]].encode():
                    first[g] = k
            at = np.array([first[g] for g in range(len(p.begin))], np.int64)
            take = p.rows.take(pa.array(at))
            yield pa.RecordBatch.from_arrays(
                [take.column("cluster"), take.column("field"), take.column("salt"), take.column("value"), pa.array(prob[at]), pa.array(p.size[at].astype(np.int32))], names=["cluster", "field", "salt", "value", "p", "sources"]
            )

    out = values.mapInArrow(best, "cluster long, field string, salt int, value string, p double, sources int")
    names = ["cluster", "field", "value", F.round("p", 6).alias("posterior"), "sources"]
    if not spread:
        return out.select(*names)
    top = out.where("salt >= 0").groupBy("cluster", "field").agg(F.min(F.struct((-F.col("p")).alias("q"), "value", "p", "sources")).alias("b")).select("cluster", "field", "b.value", "b.p", "b.sources")
    return out.where("salt < 0").select("cluster", "field", "value", "p", "sources").unionByName(top).select(*names)
