"""Queries over the catalog listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexlake.functions import text
from lexlake.operators import catalog, snapshots
from lexlake.session import table


def _latest(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.latest_listing(table(spark, sf, "record_snapshot"))


def catalog_copies(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.settled_copies(_latest(spark, sf))


def catalog_ids(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.record_ids(_latest(spark, sf))


def catalog_classes(spark: SparkSession, sf: str) -> DataFrame:
    """Class and tags of each name."""
    names = table(spark, sf, "record_snapshot").select("name").distinct()
    return names.select("name", catalog.classify(F.col("name")).alias("class"), F.array_join(catalog.tags(F.col("name")), ",").alias("tags"))


def catalog_dates(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "record_snapshot").select("date", snapshots.listing_date(F.col("date")).alias("day")).distinct()


def catalog_first_seen(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.first_seen(table(spark, sf, "record_snapshot"))


def catalog_continuity(spark: SparkSession, sf: str) -> DataFrame:
    """What each record of the last snapshot continues in the one before it."""
    s = table(spark, sf, "record_snapshot")
    numbers = s.select("snapshot_no").distinct().withColumn("r", F.row_number().over(Window.orderBy(F.desc("snapshot_no")))).where("r = 2")  # one row for each delivery
    before = s.join(F.broadcast(numbers.select("snapshot_no")), "snapshot_no")
    previous = before.withColumn("_n", F.row_number().over(Window.partitionBy("id").orderBy(F.col("loaded_at").desc()))).where("_n = 1")
    return catalog.continued(_latest(spark, sf), previous)


def change_log(spark: SparkSession, sf: str) -> DataFrame:
    """Records added and removed by snapshot, as two set differences."""
    s = table(spark, sf, "record_snapshot").select("snapshot_no", "id").distinct()
    numbers = s.select("snapshot_no").distinct()
    n = numbers.withColumn("after", F.lead("snapshot_no").over(Window.orderBy("snapshot_no"))).where("after is not null")  # one row for each delivery
    due = s.join(F.broadcast(n), "snapshot_no").select(F.col("after").alias("snapshot_no"), "id")
    later = s.join(F.broadcast(n.select(F.col("after").alias("snapshot_no"))), "snapshot_no")
    added = later.join(due, ["snapshot_no", "id"], "left_anti").groupBy("snapshot_no").agg(F.count("*").alias("n")).withColumn("change", F.lit("added"))
    removed = due.join(s, ["snapshot_no", "id"], "left_anti").groupBy("snapshot_no").agg(F.count("*").alias("n")).withColumn("change", F.lit("removed"))
    return added.unionByName(removed).select("snapshot_no", "change", "n")


def facet_counts(spark: SparkSession, sf: str) -> DataFrame:
    r = _latest(spark, sf).select("id", "lang", "kind", catalog.tags(F.col("name")).alias("tags"))
    return catalog.facet_counts(r, {"kind": "mdx"})


def catalog_search(spark: SparkSession, sf: str) -> DataFrame:
    """For the records whose id, a hexadecimal number, ends in 0 those that match the beginning and the last word of the name."""
    r = _latest(spark, sf).select("id", "name", catalog.tags(F.col("name")).alias("tags"), F.array_join(F.transform("locations", lambda x: x["folder"]), " ").alias("paths"))
    q = r.where("id like '%0'").select(F.col("id").alias("query_id"), F.concat_ws(" ", F.substring(F.lower("name"), 1, 5), F.substring_index(F.lower("name"), " ", -1)).alias("query"))
    return catalog.search(r, q)


def catalog_meta(spark: SparkSession, sf: str) -> DataFrame:
    """Records and bytes by language and kind, with all totals."""
    return _latest(spark, sf).groupingSets([("lang",), ("kind",), ()], "lang", "kind").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))


def file_names(spark: SparkSession, sf: str) -> DataFrame:
    """Stem, volume and readable size of every file of the last listing."""
    f = _latest(spark, sf).select(F.explode("locations").alias("l")).select(F.explode("l.files").alias("f")).select("f.name", "f.size").distinct()
    return f.select("name", "size", text.strip_ext(F.col("name")).alias("stem"), text.volume(F.col("name")).alias("volume"), text.human_size(F.col("size")).alias("shown"))


def resource_types(spark: SparkSession, sf: str) -> DataFrame:
    """The ten commonest file types with their bytes."""
    f = _latest(spark, sf).select(F.explode("locations").alias("l")).select(F.explode("l.files").alias("f"))
    ext = F.lower(F.regexp_extract("f.name", r"\.([A-Za-z0-9]+)$", 1))
    return f.groupBy(ext.alias("ext")).agg(F.count("*").alias("n"), F.sum("f.size").alias("bytes")).orderBy(F.desc("n"), "ext").limit(10)


QUERIES = {
    f.__name__: f
    for f in (catalog_copies, catalog_ids, catalog_classes, catalog_dates, catalog_first_seen, catalog_continuity, change_log, facet_counts, catalog_search, catalog_meta, file_names, resource_types)
}

_L = """r AS (SELECT * FROM record_snapshot WHERE snapshot_no = (SELECT max(snapshot_no) FROM record_snapshot)
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC) = 1)"""
_CLASS = "CASE " + " ".join(f"WHEN regexp_matches(lower(name), '{p.replace('x{3040}', 'x{3040}')}') THEN '{c}'" for c, p in catalog.CLASSES) + " ELSE 'unknown' END"
_TAGS = "list_filter([" + ", ".join(f"CASE WHEN regexp_matches(lower(name), '{p}') THEN '{t}' END" for t, p in catalog.TAGS) + "], lambda t: t IS NOT NULL)"
_STEM = "regexp_replace(name, '(?i)(?:\\.\\d+)?\\.(?:mdx|mdd|css|js|zip|rar|7z|tar|gz)$', '')"

SQL = {
    "catalog_copies": f"""WITH {_L}, c AS (SELECT id, len(locations) AS n_copies, unnest(locations) AS l FROM r),
        x AS (SELECT id, n_copies, l.folder AS folder, list_sum(list_transform(l.files, lambda f: f.size)) AS bytes, len(list_filter(l.files, lambda f: lower(f.name) LIKE '%.mdd')) > 0 AS has_mdd FROM c)
        SELECT id, folder, CAST(bytes AS BIGINT) AS bytes, CAST(n_copies AS INTEGER) AS n_copies, has_mdd FROM x QUALIFY row_number() OVER (PARTITION BY id ORDER BY NOT has_mdd, bytes DESC, folder) = 1""",
    "catalog_ids": f"""WITH {_L}, x AS (SELECT id, kind, lower(name) AS folded, locations[1].main_name AS name, locations[1].main_size AS size FROM r),
        y AS (SELECT *, lower(name[length({_STEM}) + 1:]) AS suffix FROM x)
        SELECT id, sha1(kind || '|' || folded || '|' || size || CASE WHEN suffix IN ('.mdx', '.mdd') THEN '' ELSE '|' || suffix END)[1:12] AS record_id FROM y""",
    "catalog_classes": f"WITH n AS (SELECT DISTINCT name FROM record_snapshot) SELECT name, {_CLASS} AS class, array_to_string({_TAGS}, ',') AS tags FROM n",
    "catalog_dates": "SELECT DISTINCT date, CASE WHEN regexp_matches(date, '^\\d{2}-') THEN strftime(strptime(date, '%d-%b-%Y %H:%M'), '%Y-%m-%d') ELSE date END AS day FROM record_snapshot",
    "catalog_first_seen": """SELECT id, CASE WHEN min(snapshot_no) > (SELECT min(snapshot_no) FROM record_snapshot) THEN strftime(arg_min(crawled, snapshot_no), '%Y-%m-%d') END AS first_seen FROM record_snapshot GROUP BY id""",
    "catalog_continuity": f"""WITH {_L}, b AS (SELECT * FROM record_snapshot WHERE snapshot_no = (SELECT max(snapshot_no) FROM record_snapshot WHERE snapshot_no < (SELECT max(snapshot_no) FROM record_snapshot))
            QUALIFY row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC) = 1),
        f AS (SELECT id, l.folder AS folder, unnest(l.files) AS f FROM (SELECT id, unnest(locations) AS l FROM b)),
        m AS (SELECT id, l.folder AS folder, l.main_name AS name, l.main_size AS size FROM (SELECT id, unnest(locations) AS l FROM r WHERE id NOT IN (SELECT id FROM b)))
        SELECT id, id AS previous_id FROM r WHERE id IN (SELECT id FROM b)
        UNION ALL SELECT DISTINCT m.id, f.id FROM m JOIN f ON f.folder = m.folder AND f.f.name = m.name AND f.f.size = m.size""",
    "change_log": """WITH s AS (SELECT DISTINCT snapshot_no, id FROM record_snapshot), n AS (SELECT snapshot_no, lead(snapshot_no) OVER (ORDER BY snapshot_no) AS after FROM (SELECT DISTINCT snapshot_no FROM s)),
        due AS (SELECT n.after AS snapshot_no, s.id FROM s JOIN n USING (snapshot_no) WHERE n.after IS NOT NULL)
        SELECT snapshot_no, 'added' AS change, count(*) AS n FROM (SELECT * FROM s WHERE snapshot_no > (SELECT min(snapshot_no) FROM s) EXCEPT SELECT * FROM due) GROUP BY 1
        UNION ALL SELECT snapshot_no, 'removed', count(*) FROM (SELECT * FROM due EXCEPT SELECT * FROM s) GROUP BY 1""",
    "facet_counts": f"""WITH {_L}, x AS (SELECT lang, kind, {_TAGS} AS tags FROM r)
        SELECT 'lang' AS facet, coalesce(lang, '') AS value, count(*) AS n FROM x WHERE kind = 'mdx' GROUP BY 2
        UNION ALL SELECT 'kind', coalesce(kind, ''), count(*) FROM x GROUP BY 2
        UNION ALL SELECT 'tag', t, count(*) FROM (SELECT unnest(tags) AS t FROM x WHERE kind = 'mdx') GROUP BY 2""",
    "catalog_search": f"""WITH {_L}, x AS (SELECT id, lower(name) AS name, {_TAGS} AS tags, lower(array_to_string(list_transform(locations, lambda l: l.folder), ' ')) AS paths FROM r),
        q AS (SELECT query_id, unnest(list_filter(regexp_split_to_array(name[1:5] || ' ' || regexp_extract(name, '[^ ]*$'), '\\s+'), lambda t: t <> '')) AS term FROM (SELECT id AS query_id, name FROM x WHERE id LIKE '%0')),
        w AS (SELECT query_id, count(*) AS wanted FROM q GROUP BY 1),
        s AS (SELECT query_id, id, name, CASE WHEN starts_with(name, term) THEN 40
                WHEN len(list_filter(regexp_split_to_array(name, '[^\\p{{L}}\\p{{N}}]+'), lambda v: starts_with(v, term))) > 0 THEN 30
                WHEN contains(name, term) THEN 20 WHEN regexp_matches(term, '[\\p{{L}}\\p{{N}}]') AND contains(regexp_replace(name, '[^\\p{{L}}\\p{{N}}]+', '', 'g'), regexp_replace(term, '[^\\p{{L}}\\p{{N}}]+', '', 'g')) THEN 15
                WHEN len(list_filter(tags, lambda t: contains(t, term))) > 0 THEN 10 WHEN contains(paths, term) THEN 3 ELSE 0 END AS s FROM x CROSS JOIN q)
        SELECT query_id, id, round(sum(s) - max(length(name)) / 10000, 4) AS score FROM s JOIN w USING (query_id) WHERE s > 0 GROUP BY query_id, id, wanted HAVING count(*) = wanted""",
    "catalog_meta": f"WITH {_L} SELECT lang, kind, count(*) AS n, CAST(sum(size) AS BIGINT) AS bytes FROM r GROUP BY GROUPING SETS ((lang), (kind), ())",
    "file_names": f"""WITH {_L}, f AS (SELECT DISTINCT f.name AS name, f.size AS size FROM (SELECT unnest(l.files) AS f FROM (SELECT unnest(locations) AS l FROM r)))
        SELECT name, size, {_STEM} AS stem,
               CASE WHEN regexp_matches(name, '(?i)\\.\\d+\\.mdd$') THEN CAST(regexp_extract(name, '(?i)\\.(\\d+)\\.mdd$', 1) AS INTEGER) WHEN regexp_matches(name, '(?i)\\.mdd$') THEN 0 END AS volume,
               CASE WHEN size >= 1073741824 THEN printf('%.2f GB', size / 1073741824.0) WHEN size >= 1048576 THEN printf('%.1f MB', size / 1048576.0) WHEN size >= 1024 THEN printf('%.0f KB', size / 1024.0) ELSE size || ' B' END AS shown FROM f""",
    "resource_types": f"""WITH {_L}, f AS (SELECT unnest(l.files) AS f FROM (SELECT unnest(locations) AS l FROM r))
        SELECT lower(regexp_extract(f.name, '\\.([A-Za-z0-9]+)$', 1)) AS ext, count(*) AS n, CAST(sum(f.size) AS BIGINT) AS bytes FROM f GROUP BY 1 ORDER BY n DESC, ext LIMIT 10""",
}
