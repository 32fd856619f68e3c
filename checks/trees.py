"""A tree of depth three on categories and numbers, against greedy splits in SQL."""

from functools import lru_cache

from pyspark.sql import functions as F

from checks.queries import FEATURE_SQL, check, rounded
from checks.storm_view import storm
from tempestry.operators import features, forest, trees

_COLUMNS = ("EVENT_TYPE", "MAGNITUDE_TYPE", "MAGNITUDE", "EVENT_COUNT_PER_CZ")
_DEPTH = 3

# Few distinct numbers, so that every middle of two neighbours is a candidate. The label
# depends on a category and a number together, with noise, so that no leaf is pure.
_ROWS_SQL = f"""{FEATURE_SQL}
, tree_rows AS (SELECT EVENT_ID, split, EVENT_TYPE AS e, MAGNITUDE_TYPE AS m,
  floor(MAGNITUDE / 8) AS x, CAST(EVENT_COUNT_PER_CZ // 20 AS DOUBLE) AS c,
  CASE WHEN ((MAGNITUDE > 32) = (EVENT_TYPE IN ('Flood', 'Hail'))) <> (EVENT_ID % 5 = 0) THEN 1 ELSE 0 END AS y
  FROM assigned),
middles AS (
  SELECT 'MAGNITUDE' AS grp, (x + lead(x) OVER (ORDER BY x)) / 2 AS t FROM (SELECT DISTINCT x FROM tree_rows WHERE split = 'train')
  UNION ALL
  SELECT 'EVENT_COUNT_PER_CZ', (c + lead(c) OVER (ORDER BY c)) / 2 FROM (SELECT DISTINCT c FROM tree_rows WHERE split = 'train')),
splits AS (SELECT grp, t, NULL AS category FROM middles WHERE t IS NOT NULL
  UNION ALL SELECT DISTINCT 'EVENT_TYPE', NULL, e FROM tree_rows WHERE split = 'train'
  UNION ALL SELECT DISTINCT 'MAGNITUDE_TYPE', NULL, m FROM tree_rows WHERE split = 'train'),
sided AS (SELECT r.*, s.*, CASE grp WHEN 'MAGNITUDE' THEN x <= t WHEN 'EVENT_COUNT_PER_CZ' THEN c <= t
    WHEN 'EVENT_TYPE' THEN e <> category ELSE m <> category END AS goes_left FROM tree_rows r, splits s),
at_0 AS (SELECT EVENT_ID, split, y, 1 AS node FROM tree_rows)"""


def _gini(n, h):
    return f"(2e0 * ({h}) * (({n}) - ({h})) / (({n}) * ({n})))"


def _level_sql(i):
    """The best split of each node of level ``i`` and where its rows go."""
    return f"""
, sums_{i} AS (SELECT node, grp, t, category, CAST(count(*) AS DOUBLE) AS n, CAST(sum(s.y) AS DOUBLE) AS h,
    CAST(count(*) FILTER (WHERE goes_left) AS DOUBLE) AS n1, CAST(coalesce(sum(s.y) FILTER (WHERE goes_left), 0) AS DOUBLE) AS h1
  FROM sided s JOIN at_{i} USING (EVENT_ID) WHERE s.split = 'train' AND node >= {2**i} GROUP BY node, grp, t, category),
gains_{i} AS (SELECT *, {_gini('n', 'h')} - n1 / n * {_gini('n1', 'h1')} - (n - n1) / n * {_gini('n - n1', 'h - h1')} AS gain
  FROM sums_{i} WHERE n1 > 0 AND n1 < n),
best_{i} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY round(gain, 12) DESC, grp, t, category) AS k
  FROM gains_{i} WHERE gain > 1e-12) WHERE k = 1),
at_{i + 1} AS (SELECT a.EVENT_ID, a.split, a.y, CASE WHEN b.node IS NULL THEN a.node WHEN s.goes_left THEN 2 * a.node
    ELSE 2 * a.node + 1 END AS node
  FROM at_{i} a LEFT JOIN best_{i} b ON b.node = a.node LEFT JOIN sided s ON s.EVENT_ID = a.EVENT_ID AND s.grp = b.grp
    AND s.t IS NOT DISTINCT FROM b.t AND s.category IS NOT DISTINCT FROM b.category)"""


def _prune_sql(i):
    """Splits of level ``i`` that stay: two leaves of one answer are merged."""
    below = f"SELECT node FROM kept_{i + 1}" if i < _DEPTH - 1 else "SELECT NULL WHERE false"
    return f"""
, kept_{i} AS (SELECT b.* FROM best_{i} b JOIN counts l ON l.node = 2 * b.node JOIN counts r ON r.node = 2 * b.node + 1
  WHERE l.node IN ({below}) OR r.node IN ({below}) OR (2 * l.h > l.n) <> (2 * r.h > r.n))"""


_TREE_SQL = (
    _ROWS_SQL
    + "".join(_level_sql(i) for i in range(_DEPTH))
    + ", counts AS (SELECT node, any_value(n) AS n, any_value(h) AS h FROM ("
    + " UNION ALL ".join(
        f"SELECT node, CAST(count(*) AS DOUBLE) AS n, CAST(sum(y) AS DOUBLE) AS h FROM at_{i} WHERE split = 'train' GROUP BY node"
        for i in range(_DEPTH + 1)
    )
    + ") GROUP BY node)"
    + "".join(_prune_sql(i) for i in reversed(range(_DEPTH)))
    + ", kept AS ("
    + " UNION ALL ".join(f"SELECT node, grp, t, gain, {i} AS depth FROM kept_{i}" for i in range(_DEPTH))
    + "), tree AS (SELECT 1 AS node, 0 AS depth UNION ALL SELECT unnest([2 * node, 2 * node + 1]), depth + 1 FROM kept)"
)


def rows(spark, sf_dir):
    built = features.build_features(storm(spark, sf_dir))
    apart = (F.col("MAGNITUDE") > 32) == F.col("EVENT_TYPE").isin("Flood", "Hail")
    label = F.when(apart != (F.col("EVENT_ID") % 5 == 0), 1).otherwise(0)
    return built.withColumns(
        {
            "has_harm": label,
            "MAGNITUDE": F.floor(F.col("MAGNITUDE") / 8).cast("double"),
            "EVENT_COUNT_PER_CZ": F.floor(F.col("EVENT_COUNT_PER_CZ") / 20).cast("double"),
        }
    )


@lru_cache(maxsize=4)
def _fitted(application_id, spark, sf_dir):
    train, _, test = features.split3(rows(spark, sf_dir))
    model = forest.train_harm_model(
        train, trees=1, depth=_DEPTH, partitions=4, bootstrap=False, columns=_COLUMNS
    )
    return trees.tree_table(model, model.transform(test)), model.transform(test)


def fitted(spark, sf_dir):
    """The nodes of the tree, and the test rows with their feature vector."""
    return _fitted(spark.sparkContext.applicationId, spark, sf_dir)


@check(
    f"""{_TREE_SQL}
SELECT depth, k.grp AS feature_group, k.t AS threshold, n - h AS negatives, h AS positives, round(k.gain, 9) AS gain
FROM tree JOIN counts USING (node) LEFT JOIN (SELECT node, grp, t, gain FROM kept) k USING (node)"""
)
def tree_nodes(spark, sf_dir):
    nodes, _ = fitted(spark, sf_dir)
    columns = ("depth", "feature_group", "threshold", "negatives", "positives", "gain")
    return rounded(trees.with_depth(nodes).select(*columns), gain=9)


@check(
    f"""{_TREE_SQL}
, steps AS (SELECT EVENT_ID, unnest([{', '.join(f'a{i}.node' for i in range(_DEPTH + 1))}]) AS node
  FROM {' JOIN '.join(f'at_{i} a{i}' + (' USING (EVENT_ID)' if i else '') for i in range(_DEPTH + 1))} WHERE a0.split = 'test'),
leaves AS (SELECT EVENT_ID, max(node) AS node FROM steps WHERE node IN (SELECT node FROM tree) GROUP BY EVENT_ID)
SELECT EVENT_ID, round(h / n, 9) AS score FROM leaves JOIN counts USING (node)"""
)
def tree_scores(spark, sf_dir):
    nodes, scored = fitted(spark, sf_dir)
    return rounded(trees.node_scores(nodes, scored), score=9)


@check(
    f"""{_TREE_SQL}
, falls AS (SELECT grp, k.gain * n AS fall FROM kept k JOIN counts USING (node))
SELECT grp AS feature_group, round(sum(fall) / (SELECT sum(fall) FROM falls), 9) AS importance FROM falls GROUP BY grp"""
)
def tree_importance(spark, sf_dir):
    nodes, _ = fitted(spark, sf_dir)
    groups = forest.group_importance(trees.node_importance(nodes))
    return rounded(groups.select("feature_group", "importance"), importance=9)
