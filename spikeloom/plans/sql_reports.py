"""Reports as parameterised SQL (A13): the text is fixed, every number and date is a named parameter.

Tables are given as frames and parameters as values; nothing is pasted into the text, so a date or
a label cannot change the query's meaning, and the plan is the one the DataFrame form has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from spikeloom.params import Timeline

PERIOD_REPORT = """
WITH daily AS (
  SELECT to_date(created_at) AS day, count(*) AS n FROM {users} WHERE created_at IS NOT NULL GROUP BY 1),
means AS (
  SELECT avg(n) FILTER (WHERE day < to_date(:peak_start)) AS pre,
         avg(n) FILTER (WHERE day >= to_date(:peak_start) AND day < to_date(:peak_end)) AS peak,
         avg(n) FILTER (WHERE day >= to_date(:peak_end)) AS post FROM daily),
sizes AS (
  SELECT CAST(max(n) FILTER (WHERE t = 'u') AS DOUBLE) AS u, CAST(max(n) FILTER (WHERE t = 'p') AS DOUBLE) AS p, CAST(max(n) FILTER (WHERE t = 'f') AS DOUBLE) AS f
  FROM (SELECT 'u' AS t, count(*) AS n FROM {users} UNION ALL SELECT 'p', count(*) FROM {posts} UNION ALL SELECT 'f', count(*) FROM {follows}))
SELECT metric, round(value, CAST(:places AS INT)) AS value FROM (
  SELECT stack(3, 'DAILY_REGISTRATIONS_PRE_VIRAL', pre, 'DAILY_REGISTRATIONS_VIRAL_PEAK', peak, 'DAILY_REGISTRATIONS_POST_VIRAL', post) AS (metric, value) FROM means
  UNION ALL SELECT stack(4, 'TOTAL_USERS', u, 'TOTAL_POSTS', p, 'TOTAL_FOLLOWS', f, 'POSTS_PER_USER_RATIO', try_divide(p, u)) AS (metric, value) FROM sizes)"""

SHARES = """
SELECT value, count(*) AS n_rows, round(100.0D * count(*) / sum(count(*)) OVER (), 2) AS percentage
FROM {rows} GROUP BY value HAVING count(*) >= :least"""


def period_report(users: DataFrame, posts: DataFrame, follows: DataFrame, tl: Timeline, places: int = 6) -> DataFrame:
    """K3 in SQL; equals `operators.growth.period_report`."""
    return users.sparkSession.sql(PERIOD_REPORT, args={"peak_start": str(tl.viral_start), "peak_end": str(tl.peak_end), "places": places},
                                  users=users, posts=posts, follows=follows)


def shares(df: DataFrame, col: str, least: int = 1) -> DataFrame:
    """K1 in SQL: value, n_rows, percentage of the values with at least ``least`` rows (of those values)."""
    return df.sparkSession.sql(SHARES, args={"least": least}, rows=df.withColumnRenamed(col, "value").select("value"))
