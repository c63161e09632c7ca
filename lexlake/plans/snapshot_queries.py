"""The queries of problem 1."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexlake.operators.snapshots import record_changes
from lexlake.session import table


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return record_changes(table(spark, sf, "record_snapshot"))


QUERIES = {"p1_found": p1_found}

_SORTED = "list_sort(list_transform(locations, lambda l: {'a': l.folder, 'b': list_sort(l.files), 'c': l.main_name, 'd': l.main_size}))"
SQL = {
    "p1_found": f"""
        WITH s AS (
            SELECT snapshot_no, id, {{'n': name, 's': size, 'l': {_SORTED},
                   'd': CASE WHEN regexp_matches(date, '^\\d{{2}}-[A-Za-z]{{3}}-\\d{{4}} \\d\\d:\\d\\d$') THEN strftime(strptime(date, '%d-%b-%Y %H:%M'), '%Y-%m-%d') ELSE date END}} AS v
            FROM record_snapshot
            QUALIFY row_number() OVER (PARTITION BY snapshot_no, id ORDER BY loaded_at DESC) = 1
        ), n AS (
            SELECT snapshot_no, lag(snapshot_no) OVER (ORDER BY snapshot_no) AS before,
                   lead(snapshot_no) OVER (ORDER BY snapshot_no) AS after
            FROM (SELECT DISTINCT snapshot_no FROM record_snapshot)
        ), x AS (SELECT s.*, n.before, n.after FROM s JOIN n USING (snapshot_no))
        SELECT CAST(x.snapshot_no AS BIGINT) AS snapshot_no, x.id, CASE WHEN y.id IS NULL THEN 'added' ELSE 'changed' END AS change
        FROM x LEFT JOIN x y ON y.snapshot_no = x.before AND y.id = x.id
        WHERE x.before IS NOT NULL AND (y.id IS NULL OR x.v IS DISTINCT FROM y.v)
        UNION ALL
        SELECT CAST(x.after AS BIGINT), x.id, 'removed' FROM x LEFT JOIN x y ON y.snapshot_no = x.after AND y.id = x.id
        WHERE x.after IS NOT NULL AND y.id IS NULL"""
}
