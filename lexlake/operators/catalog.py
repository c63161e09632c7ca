"""The catalog of dictionary files: records from listings, copies, ids, continuity, facets, search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexlake.operators.search import containing
from pyspark.sql.window import Window

from lexlake.functions.text import strip_ext

# Patterns of names, tried in order; the first that fits gives the class.
CLASSES = (
    ("en-zh", r"英汉|汉英|英中|中英|双解|english-chinese|chinese-english"),
    ("en-other", r"英和|和英|français-anglais|english-spanish|german-english|italian-english|deutsch-englisch"),
    ("other", r"国語|汉语词典|diccionario de la lengua|dictionnaire du français|wörterbuch der deutschen|chinese-german"),
    ("en-en", r"英英|english|idioms|thesaurus"),
    ("other", r"[\x{3040}-\x{30ff}\x{4e00}-\x{9fff}]"),
)
# Tags by pattern; a record may have several.
TAGS = (
    ("bilingual", r"双解|english-chinese|chinese-english|英汉|汉英"),
    ("learner", r"learner|学习"),
    ("thesaurus", r"thesaurus|同义"),
    ("idioms", r"idiom|成语|习语"),
    ("wordbook", r"wordbook"),
)
SCORES = (("prefix", 40), ("boundary", 30), ("inside", 20), ("compact", 15), ("tag", 10), ("path", 3))
MAX_CHANGES = 60


def classify(name: Column) -> Column:
    """Language class of a name: the first pattern that it holds, else unknown."""
    out = F.lit("unknown")
    for label, pattern in reversed(CLASSES):
        out = F.when(F.lower(name).rlike(pattern), F.lit(label)).otherwise(out)
    return out


def tags(name: Column) -> Column:
    every = F.array(*(F.when(F.lower(name).rlike(pattern), F.lit(tag)) for tag, pattern in TAGS))
    return F.filter(every, lambda t: t.isNotNull())


def latest_listing(snapshots: DataFrame) -> DataFrame:
    """One row for each record of the last snapshot: the one loaded last."""
    last = snapshots.select(F.max("snapshot_no").alias("snapshot_no"))  # one row
    rows = snapshots.join(F.broadcast(last), "snapshot_no")
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy("id").orderBy(F.col("loaded_at").desc()))).where("_n = 1").drop("_n")


def settled_copies(records: DataFrame) -> DataFrame:
    """(id, folder, bytes, n_copies, has_mdd): the most complete copy of each record leads.

    A copy with .mdd files comes first, then the one with more bytes, then the first folder. The
    order is taken within the row's own array, so nothing is shuffled.
    """

    def rank(loc: Column) -> Column:
        mdd = F.exists(loc["files"], lambda f: F.lower(f["name"]).endswith(".mdd"))
        size = F.aggregate(loc["files"], F.lit(0).cast("long"), lambda s, f: s + f["size"])
        return F.struct((~mdd).alias("no_mdd"), (-size).alias("size"), loc["folder"].alias("folder"))

    best = F.array_min(F.transform("locations", rank))
    return records.select("id", best.alias("b"), F.size("locations").alias("n_copies")).select(
        "id", F.col("b.folder").alias("folder"), (-F.col("b.size")).alias("bytes"), "n_copies", (~F.col("b.no_mdd")).alias("has_mdd")
    )


def record_ids(records: DataFrame) -> DataFrame:
    """(id, record_id): an id made of kind, folded name, size of the main file and its suffix."""
    main = F.element_at(F.col("locations"), 1)
    suffix = F.lower(F.substr(main["main_name"], F.length(strip_ext(main["main_name"])) + 1))
    key = F.concat_ws("|", "kind", F.lower("name"), main["main_size"].cast("string"), F.when(~suffix.isin(".mdx", ".mdd"), suffix))
    return records.select("id", F.substring(F.sha1(key), 1, 12).alias("record_id"))


def continued(current: DataFrame, previous: DataFrame) -> DataFrame:
    """(id, previous_id): what each record continues: the record of its id, else those with one of its main files."""
    ids = previous.select(F.col("id").alias("previous_id")).distinct()
    same = current.select("id").join(ids, F.col("id") == F.col("previous_id"))
    rest = current.join(ids, F.col("id") == F.col("previous_id"), "left_anti")
    mine = rest.select("id", F.explode("locations").alias("l")).select("id", F.col("l.folder").alias("folder"), F.col("l.main_name").alias("name"), F.col("l.main_size").alias("size"))
    theirs = previous.select(F.col("id").alias("previous_id"), F.explode("locations").alias("l")).select("previous_id", F.col("l.folder").alias("folder"), F.explode("l.files").alias("f"))
    theirs = theirs.select("previous_id", "folder", F.col("f.name").alias("name"), F.col("f.size").alias("size"))
    return same.unionByName(mine.join(theirs, ["folder", "name", "size"]).select("id", "previous_id").distinct())


def first_seen(snapshots: DataFrame) -> DataFrame:
    """(id, first_seen): the day of the first snapshot with a record; null for those of the first of all."""
    seen = snapshots.groupBy("id").agg(F.min(F.struct("snapshot_no", "crawled")).alias("s"))
    first = snapshots.select(F.min("snapshot_no").alias("least"))  # one row
    return seen.crossJoin(F.broadcast(first)).select("id", F.when(F.col("s.snapshot_no") > F.col("least"), F.date_format("s.crawled", "yyyy-MM-dd")).alias("first_seen"))


def facet_counts(records: DataFrame, chosen: dict[str, str]) -> DataFrame:
    """(facet, value, n): values of each facet over the records that pass the choices in all other facets.

    records is (id, lang, kind, tags); a record counts once for each of its tags.
    """
    tests = {"lang": F.col("lang"), "kind": F.col("kind")}
    passes = {f: (c == chosen[f]) if f in chosen else F.lit(True) for f, c in tests.items()}
    passes["tag"] = F.array_contains("tags", chosen["tag"]) if "tag" in chosen else F.lit(True)

    def but(facet: str) -> Column:
        out = F.lit(True)
        for f, p in passes.items():
            if f != facet:
                out &= p
        return out

    # One pass over the records: each gives its values of the facets for which it passes the others.
    values = F.array_compact(
        F.concat(
            *(F.array(F.when(but(f), F.struct(F.lit(f).alias("facet"), F.coalesce(c, F.lit("")).alias("value")))) for f, c in tests.items()),
            F.when(but("tag"), F.transform("tags", lambda t: F.struct(F.lit("tag").alias("facet"), t.alias("value")))).otherwise(F.array().cast("array<struct<facet:string,value:string>>")),
        )
    )
    return records.select(F.explode(values).alias("v")).groupBy("v.facet", "v.value").agg(F.count("*").alias("n"))


def _bare(c: Column) -> Column:
    return F.regexp_replace(c, r"[^\p{L}\p{N}]+", "")


def search(records: DataFrame, queries: DataFrame) -> DataFrame:
    """(query_id, id, score): records in which every word of a query scores; a long name costs a little.

    records is (id, name, tags, paths), queries (query_id, query). A word scores only where a text of
    the record contains it, so the words meet the different texts through n-grams, and of each query
    only the records of its rarest word are scored.
    """
    terms = queries.select("query_id", F.posexplode(F.filter(F.split(F.lower("query"), r"\s+"), lambda t: t != "")).alias("at", "term"))
    name, term = F.lower("name"), F.col("term")
    texts = records.select("id", F.explode(F.array_distinct(F.array_compact(F.concat(F.array(name, _bare(name), F.lower("paths")), F.coalesce("tags", F.array()))))).alias("text"))
    parts = terms.select("term", F.explode(F.array_distinct(F.array(term, _bare(term)))).alias("part")).where("part <> ''").distinct()
    met = containing(texts.select(F.col("text").alias("term")), parts.select(F.col("part").alias("query"))).select(F.col("query").alias("part"), F.col("term").alias("text"))
    held = parts.join(met, "part").join(texts, "text").select("term", "id").distinct()
    df = held.groupBy("term").agg(F.count("*").alias("df"))
    rarest = terms.join(df, "term", "left").groupBy("query_id").agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "term"))["term"].alias("term"))
    near = rarest.join(held, "term").select("query_id", "id")
    points = dict(SCORES)
    score = (
        F.when(name.startswith(term), points["prefix"])
        .when(F.exists(F.split(name, r"[^\p{L}\p{N}]+"), lambda w: w.startswith(term)), points["boundary"])
        .when(name.contains(term), points["inside"])
        .when((_bare(term) != "") & _bare(name).contains(_bare(term)), points["compact"])
        .when(F.exists("tags", lambda t: t.contains(term)), points["tag"])
        .when(F.lower("paths").contains(term), points["path"])
        .otherwise(0)
    )
    hits = near.join(terms, "query_id").join(records, "id").select("query_id", "at", "id", "name", score.alias("s")).where("s > 0")
    g = hits.groupBy("query_id", "id").agg(F.count("*").alias("n"), F.sum("s").alias("s"), F.max(F.length("name")).alias("len"))
    wanted = terms.groupBy("query_id").agg(F.count("*").alias("n_terms"))
    return g.join(wanted, "query_id").where("n = n_terms").select("query_id", "id", F.round(F.col("s") - F.col("len") / 10000, 4).alias("score"))
