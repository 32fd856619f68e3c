"""Significance of the magnitude trend."""

from pyspark.sql import functions as F

from checks.queries import MAG_SQL, check, rounded
from checks.storm_view import storm
from tempestry.operators import trend

# Student's t has a finite series for whole degrees of freedom: in the angle whose tangent
# is t / sqrt(df), with one factor more per term.
_TAIL_SQL = """
, angles AS (SELECT series, rho, n, n - 2 AS df, asin(abs(rho)) AS angle, sqrt(1 - rho * rho) AS c FROM found),
terms AS (
  SELECT series, rho, n, df, angle, c, 0 AS k, 1e0 AS term, CASE WHEN df = 1 THEN 0e0 ELSE 1e0 END AS total FROM angles
  UNION ALL
  SELECT series, rho, n, df, angle, c, k + 1, t, total + t FROM (SELECT *, term * c * c
    * CASE WHEN df % 2 = 1 THEN (2e0 * k + 2) / (2e0 * k + 3) ELSE (2e0 * k + 1) / (2e0 * k + 2) END AS t FROM terms)
  WHERE 2 * (k + 1) <= df - CASE WHEN df % 2 = 1 THEN 3 ELSE 2 END),
sums AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY k DESC) AS last FROM terms)
SELECT series, round(rho, 6) AS rho, n, round(1 - CASE WHEN df % 2 = 1
  THEN 2 / pi() * (angle + sin(angle) * cos(angle) * total) ELSE sin(angle) * total END, 9) AS p_value
FROM sums WHERE last = 1"""


@check(
    f"""
, spread AS (SELECT YEAR * 10 + CAST(EVENT_ID % 5 AS INT) AS fine, * FROM storm WHERE {MAG_SQL}),
yearly AS (SELECT 'years' AS series, YEAR AS x, avg(MAGNITUDE) AS m FROM spread GROUP BY YEAR
  UNION ALL SELECT 'fifths', fine, avg(MAGNITUDE) FROM spread GROUP BY fine),
ranked AS (SELECT series,
  rank() OVER (PARTITION BY series ORDER BY x) + (count(*) OVER (PARTITION BY series, x) - 1) / 2.0 AS rx,
  rank() OVER (PARTITION BY series ORDER BY m) + (count(*) OVER (PARTITION BY series, m) - 1) / 2.0 AS rm FROM yearly),
found AS (SELECT series, corr(rx, rm) AS rho, count(*) AS n FROM ranked GROUP BY series)
{_TAIL_SQL}""",
    recursive=True,
)
def spearman_p(spark, sf_dir):
    """The trend of the years, and that of fifths of years, with its p-value."""
    events = storm(spark, sf_dir)
    fine = F.col("YEAR") * 10 + (F.col("EVENT_ID") % 5).cast("int")
    series = {"years": events, "fifths": events.withColumn("YEAR", fine)}
    tests = [trend.spearman_trend_test(df).withColumn("series", F.lit(k)) for k, df in series.items()]
    return rounded(tests[0].unionByName(tests[1]), rho=6, p_value=9)
