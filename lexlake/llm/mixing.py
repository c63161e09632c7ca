"""Problem 8: records of several sources, mixed to target shares of the total size.

The targets are the leaves of a tree (domain, language, source, as far as the columns exist).
Weights go down the tree; where a leaf can't fill its share even with all its repeats, the
shortage goes to its siblings first, and only what they can't take goes up to the next ancestor.
A leaf's share is then drawn in epochs: whole epochs repeat each text, the last one takes the
texts with the smallest seeded hashes, as far as the tokens reach. The prefix over the hashes is
found from sums over hash ranges, so no task ever holds a whole source.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexlake.session import cut_lineage
from lexlake.llm.tokens import TOKENIZER, encoder, vocabulary

#: Ranges of the hash in which the sizes are summed; the exact prefix is found within one range.
RANGES = 4096
#: Leaves of the target tree, which the driver holds.
MAX_LEAVES = 10_000


@dataclass
class Leaf:
    path: tuple[str, ...]
    weight: float
    size: int = 0
    repeats: int = 1
    quota: float = 0.0

    @property
    def most(self) -> int:
        return self.size * self.repeats


@dataclass
class Plan:
    """The leaves with their quotas, the size asked for in all, and what no leaf could take of it."""

    leaves: list[Leaf]
    total: float
    unplaced: float


def budget(leaves: Sequence[Leaf], total: float, depth: int = 0) -> float:
    """Sets the quotas of leaves that share their path up to depth; returns what they couldn't take.

    Only leaves with weight count, for their room too. As no branch is given more than its room,
    what is left over at the top is what the whole tree can't take.
    """
    for leaf in leaves:
        leaf.quota = 0.0
    leaves = [x for x in leaves if x.weight > 0 and x.most > 0]
    if not leaves or total <= 0:
        return max(0.0, total)
    if depth >= len(leaves[0].path):
        (leaf,) = leaves
        leaf.quota = min(total, float(leaf.most))
        return total - leaf.quota
    children: dict[str, list[Leaf]] = {}
    for leaf in leaves:
        children.setdefault(leaf.path[depth], []).append(leaf)
    room = {k: float(sum(x.most for x in own)) for k, own in children.items()}
    weight = {k: sum(x.weight for x in own) for k, own in children.items()}
    given: dict[str, float] = {}
    left = float(total)
    open_ = sorted(children, key=lambda k: (room[k] / weight[k], k))
    while open_:  # the child that is full first, so that its shortage goes to the siblings that still have room
        part = left * weight[open_[0]] / sum(weight[k] for k in open_)
        if part < room[open_[0]]:
            whole = sum(weight[k] for k in open_)
            given.update({k: left * weight[k] / whole for k in open_})
            left = 0.0
            break
        k = open_.pop(0)
        given[k] = room[k]
        left = max(0.0, left - room[k])
    for k, own in children.items():
        left += budget(own, given[k], depth + 1)
    return left


def token_sizes(df: DataFrame, text: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """df with n_tokens in place of the text; null has no tokens."""
    data = vocabulary(tokenizer)
    keep = [c for c in df.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(data)
        for b in batches:
            n = [len(enc.encode_ordinary(t)) if t else 0 for t in b.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(n, pa.int64())], names=[*keep, "n_tokens"])

    types = dict(df.dtypes)
    return df.mapInArrow(run, ", ".join([*(f"`{c}` {types[c]}" for c in keep), "n_tokens long"]))


def texts(df: DataFrame, row_id: str, text: str, path: Sequence[str], tokenizer: str = TOKENIZER) -> DataFrame:
    """(row_id, leaf, n_tokens): one row for each different text; the smallest id stands for all.

    Null and empty texts have no size and are left out; a null in a path column is its own leaf "".
    The texts are counted where they are read, only their hashes and sizes are shuffled.
    """
    rows = df.select(F.col(row_id).alias("row_id"), F.struct(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in path)).alias("leaf"), F.sha2(text, 256).alias("t"), F.col(text).alias("text"))
    sized = token_sizes(rows.where("row_id is not null and text <> ''"), "text", tokenizer)
    return sized.groupBy("t").agg(F.min(F.struct("row_id", "leaf", "n_tokens")).alias("r")).select("r.*")


def plan(sized: DataFrame, targets: DataFrame, path: Sequence[str], share: str, repeats: str, total: int | None = None) -> Plan:
    """The plan for sized (leaf, n_tokens); without a total, as many tokens are asked for as the leaves with a share have."""
    rows = targets.select(*path, share, repeats).limit(MAX_LEAVES + 1).collect()
    if len(rows) > MAX_LEAVES:
        raise ValueError(f"more than {MAX_LEAVES} targets")
    leaves: dict[tuple[str, ...], Leaf] = {}
    for r in rows:
        key = tuple("" if v is None else str(v) for v in r[: len(path)])
        leaf = leaves.setdefault(key, Leaf(key, 0.0))
        leaf.weight += max(0.0, r[len(path)] or 0.0)
        leaf.repeats = max(1, r[len(path) + 1] or 1)
    wanted = [tuple(k) for k in leaves]
    sums = sized.groupBy("leaf").agg(F.sum("n_tokens").alias("n"))
    listed = sized.sparkSession.createDataFrame([(k,) for k in wanted] or [], "leaf struct<" + ", ".join(f"`{c}`: string" for c in path) + ">") if wanted else None
    for r in sums.join(F.broadcast(listed), "leaf", "left_semi").collect() if listed is not None else []:
        leaves[tuple(r["leaf"])].size = r["n"] or 0
    out = list(leaves.values())
    asked = float(sum(x.size for x in out if x.weight > 0) if total is None else total)
    return Plan(out, asked, budget(out, asked))


def _edges(sized: DataFrame, state: list[tuple], kind: str, ranges: int) -> dict[tuple[str, ...], tuple[int, int, int]]:
    """For each leaf of (leaf, lo, lo_id, room) the first text in order of hash that overfills room,
    of those after (lo, lo_id) that fit by themselves: (hash, id, tokens before it). None: all fit."""
    spark = sized.sparkSession
    s = F.broadcast(spark.createDataFrame(state, f"leaf {kind}, lo long, lo_id long, room long"))  # at most MAX_LEAVES rows
    rows = sized.join(s, "leaf").where("n_tokens <= room and (h > lo or (h = lo and row_id > lo_id))")
    rows = rows.withColumn("range", F.shiftright("h", 63 - (ranges - 1).bit_length()))
    sums = rows.groupBy("leaf", "range", "room").agg(F.sum("n_tokens").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("leaf").orderBy("range"))  # at most as many rows as ranges for each leaf
    over = sums.withColumn("upto", upto).where("upto > room and upto - n <= room").select("leaf", "range", (F.col("upto") - F.col("n")).alias("before"))
    edge = rows.join(F.broadcast(over), ["leaf", "range"])
    edge = edge.withColumn("upto", F.col("before") + F.sum("n_tokens").over(Window.partitionBy("leaf").orderBy("h", "row_id"))).where("upto > room")
    first = edge.groupBy("leaf").agg(F.min(F.struct("h", "row_id", (F.col("upto") - F.col("n_tokens")).alias("before"))).alias("e"))
    return {tuple(r["leaf"]): (r["e"]["h"], r["e"]["row_id"], r["e"]["before"]) for r in first.collect()}


def mixture(df: DataFrame, targets: DataFrame, row_id: str = "doc_id", text: str = "text", path: Sequence[str] = ("source",), share: str = "target_share", repeats: str = "max_repeats", total: int | None = None, seed: int = 42, tokenizer: str = TOKENIZER, ranges: int = RANGES) -> tuple[DataFrame, Plan]:
    """((row_id, leaf, n_tokens, copies), plan): the sample, and the plan it follows.

    Rows whose leaf isn't among the targets, or has no share, aren't drawn. A text that stands
    under two ids is one text. copies says how often a row is to be used, at most repeats. A text
    too long for what is left of its leaf's last epoch is passed over, until no text fits.
    """
    h = F.shiftrightunsigned(F.xxhash64("row_id", F.lit(seed)), 1)
    sized = cut_lineage(texts(df, row_id, text, path, tokenizer).withColumn("h", h))
    made = plan(sized, targets, path, share, repeats, total)
    leaves = made.leaves
    kind = "struct<" + ", ".join(f"`{c}`: string" for c in path) + ">"
    last = 2**63 - 1
    spans: dict[tuple[str, ...], list[tuple[int, int, int, int, int]]] = {x.path: [] for x in leaves}
    whole = {x.path: int(x.quota // x.size) if x.size else 0 for x in leaves}
    state = [(x.path, -1, 0, int(round(x.quota)) - whole[x.path] * x.size) for x in leaves if x.size]
    while state := [s for s in state if s[3] > 0]:  # each time a leaf has less room than the text that it passed over
        edges = _edges(sized, state, kind, ranges)
        after = []
        for path_, lo, lo_id, room in state:
            hi, hi_id, before = edges.get(path_, (last, last, 0))
            spans[path_].append((lo, lo_id, hi, hi_id, room))
            if path_ in edges:
                after.append((path_, hi, hi_id, room - before))
        state = after
    rows = [(p, whole[p], [dict(zip(("lo", "lo_id", "hi", "hi_id", "room"), s)) for s in spans[p]]) for p in spans]
    quotas = F.broadcast(df.sparkSession.createDataFrame(rows, f"leaf {kind}, whole int, spans array<struct<lo: long, lo_id: long, hi: long, hi_id: long, room: long>>"))  # at most MAX_LEAVES rows

    def inside(s: Column) -> Column:
        above = (F.col("h") > s["lo"]) | ((F.col("h") == s["lo"]) & (F.col("row_id") > s["lo_id"]))
        below = (F.col("h") < s["hi"]) | ((F.col("h") == s["hi"]) & (F.col("row_id") < s["hi_id"]))
        return above & below & (F.col("n_tokens") <= s["room"])

    got = sized.join(quotas, "leaf").withColumn("copies", F.col("whole") + F.exists("spans", inside).cast("int"))
    return got.where("copies > 0").select(F.col("row_id").alias(row_id), "leaf", "n_tokens", "copies"), made


def report(sample: DataFrame, made: Plan, path: Sequence[str] = ("source",)) -> DataFrame:
    """One row for each target: the shares wanted and drawn, the tokens and what is missing of the asked total."""
    spark = sample.sparkSession
    whole = sum(x.weight for x in made.leaves) or 1.0
    kind = "struct<" + ", ".join(f"`{c}`: string" for c in path) + ">"
    wanted = spark.createDataFrame(
        [(x.path, x.weight / whole, x.repeats, x.size, int(round(made.total * x.weight / whole)), int(round(x.quota))) for x in made.leaves],
        f"leaf {kind}, target_share double, max_repeats int, available_tokens long, wanted_tokens long, planned_tokens long",
    )
    got = sample.groupBy("leaf").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"), F.count("*").alias("texts"), F.max("copies").alias("most_copies"))
    out = wanted.join(got, "leaf", "left").na.fill(0, ["tokens", "texts", "most_copies"])
    all_tokens = F.sum("tokens").over(Window.partitionBy())  # at most MAX_LEAVES rows
    return out.withColumn("all_tokens", all_tokens).select(
        *(F.col(f"leaf.{c}").alias(c) for c in path), "target_share",
        F.when(F.col("all_tokens") > 0, F.col("tokens") / F.col("all_tokens")).otherwise(0.0).alias("actual_share"),
        "available_tokens", "wanted_tokens", "planned_tokens", "tokens", "texts", "max_repeats", "most_copies",
        F.greatest(F.col("wanted_tokens") - F.col("tokens"), F.lit(0)).alias("shortfall_tokens"),
    )
