"""Permutation importance over several permutations."""

from pyspark.sql import functions as F

from checks.queries import FEATURE_SQL, check, rounded
from checks.storm_view import storm
from tempestry.operators import features, forest

_REPEATS = 5
_COLUMNS = ("MAGNITUDE", "EVENT_COUNT_PER_CZ")

_SCORES_SQL = f"""{FEATURE_SQL}
, placed AS (SELECT *, row_number() OVER (ORDER BY md5(CAST(EVENT_ID AS VARCHAR) || ':42'), EVENT_ID) - 1 AS p,
  count(*) OVER () AS n FROM features),
paired AS (SELECT a.EVENT_ID, a.has_harm, a.MAGNITUDE AS m, a.EVENT_COUNT_PER_CZ AS c, j,
  b.EVENT_ID AS donor, b.MAGNITUDE AS dm, b.EVENT_COUNT_PER_CZ AS dc
  FROM placed a CROSS JOIN range(1, {_REPEATS + 1}) r(j) JOIN placed b ON b.p = (a.p + j) % a.n)"""


@check(f"{_SCORES_SQL} SELECT EVENT_ID, CAST(j AS INT) AS repeat, donor FROM paired")
def repeated_donors(spark, sf_dir):
    built = features.build_features(storm(spark, sf_dir))
    paired = forest.with_donor_values(built, ("EVENT_ID",), repeats=_REPEATS)
    return paired.select(
        "EVENT_ID", F.posexplode("donor.EVENT_ID").alias("repeat", "donor")
    ).withColumn("repeat", F.col("repeat") + 1)


@check(
    f"""{_SCORES_SQL}
, scored AS (
  SELECT 'base' AS feature, 0 AS j, has_harm, m + c AS s FROM paired WHERE j = 1
  UNION ALL SELECT 'MAGNITUDE', j, has_harm, dm + c FROM paired
  UNION ALL SELECT 'EVENT_COUNT_PER_CZ', j, has_harm, m + dc FROM paired),
ranks AS (SELECT feature, j, has_harm, rank() OVER (PARTITION BY feature, j ORDER BY s)
  + (count(*) OVER (PARTITION BY feature, j, s) - 1) / 2.0 AS r FROM scored),
areas AS (SELECT feature, j, (sum(r) FILTER (WHERE has_harm = 1) - n1 * (n1 + 1) / 2.0) / (n1 * (n - n1)) AS auc FROM (
  SELECT *, CAST(sum(has_harm) OVER w AS DOUBLE) AS n1, CAST(count(*) OVER w AS DOUBLE) AS n FROM ranks
  WINDOW w AS (PARTITION BY feature, j)) GROUP BY feature, j, n1, n),
drops AS (SELECT a.feature, b.auc AS base_auc, b.auc - a.auc AS d FROM areas a JOIN areas b ON b.feature = 'base' AND a.feature <> 'base')
SELECT feature, round(any_value(base_auc), 6) AS base_auc, round(avg(d), 6) AS mean_drop, round(stddev_samp(d), 6) AS sd_drop,
  round(min(d), 6) AS least_drop, round(max(d), 6) AS most_drop FROM drops GROUP BY feature"""
)
def permutation_spread(spark, sf_dir):
    """The sum of two features as a fixed score, five permutations of each."""

    def score(df):
        return df.withColumn("score", F.col("MAGNITUDE") + F.col("EVENT_COUNT_PER_CZ"))

    built = features.build_features(storm(spark, sf_dir))
    found = forest.repeated_permutation_importance(score, built, _COLUMNS, _REPEATS)
    return rounded(found, base_auc=6, mean_drop=6, sd_drop=6, least_drop=6, most_drop=6)
