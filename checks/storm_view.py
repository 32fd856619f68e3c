"""Event table derived from the given tables: one event per order.

Written twice on purpose, as DataFrame steps for Spark and as SQL for the other
engine, so that the two sides of a check share no code.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Schemas of the given tables in use, so that opening one reads no file footer.
_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string,"
    " o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "pages": "page_id bigint, url string, html string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _harm_per_order(lineitem: DataFrame) -> DataFrame:
    """Four harm counts per order; summed per task before the shuffle."""
    quantity = F.col("l_quantity")
    rules = {
        "INJURIES_DIRECT": (F.col("l_returnflag") == "R") & (quantity >= 48),
        "INJURIES_INDIRECT": (F.col("l_returnflag") == "A") & (quantity >= 50),
        "DEATHS_DIRECT": (F.col("l_discount") >= 0.1) & (quantity >= 50),
        "DEATHS_INDIRECT": (F.col("l_tax") >= 0.08) & (quantity >= 50),
    }
    return lineitem.groupBy("l_orderkey").agg(
        *[F.count_if(rule).cast("int").alias(name) for name, rule in rules.items()]
    )


def storm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table. Orders of one customer may be most of all orders: the
    join sides are left to the planner, which broadcasts what it knows to be
    small and otherwise splits partitions a crowded key makes too large."""
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    thousands = F.floor(price / 1000).cast("string")
    types = F.create_map(
        *[
            F.lit(x)
            for pair in (
                ("1-URGENT", "Tornado"),
                ("2-HIGH", "Flood"),
                ("3-MEDIUM", "Flash Flood"),
                ("4-NOT SPECIFIED", "Hail"),
            )
            for x in pair
        ]
    )
    return (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(
            _harm_per_order(table(spark, sf_dir, "lineitem")),
            key == F.col("l_orderkey"),
            "left",
        )
        .select(
            key.alias("EVENT_ID"),
            F.nullif("n_name", F.lit("NATION_3")).alias("STATE"),
            F.when(key % 97 != 0, F.col("c_mktsegment")).alias("CZ_NAME"),
            F.year("o_orderdate").alias("YEAR"),
            F.when(
                key % 89 != 0, F.coalesce(types[F.col("o_orderpriority")], F.lit("Heat"))
            ).alias("EVENT_TYPE"),
            "INJURIES_DIRECT",
            "INJURIES_INDIRECT",
            "DEATHS_DIRECT",
            "DEATHS_INDIRECT",
            F.when(key % 11 == 0, None)
            .when(key % 13 == 0, "K")
            .when(price >= 400000, F.concat(F.lit("0."), thousands, F.lit("M")))
            .otherwise(F.concat(thousands, F.lit(".00K")))
            .alias("DAMAGE_PROPERTY"),
            F.when(key % 7 == 0, "0.00K")
            .when(key % 19 == 0, "M")
            .when(key % 5 == 0, None)
            .otherwise(F.concat((F.col("o_custkey") % 90).cast("string"), F.lit(".50K")))
            .alias("DAMAGE_CROPS"),
            F.when(F.col("o_orderstatus") == "P", None)
            .when(key % 10 == 0, 0.0)
            .otherwise(F.floor(price / 50) / 100)
            .alias("MAGNITUDE"),
            F.when(F.col("o_orderstatus") == "O", "EG")
            .when(F.col("o_orderstatus") == "F", "MG")
            .alias("MAGNITUDE_TYPE"),
            F.when(
                (F.col("o_orderpriority") == "1-URGENT") & (key % 17 != 0),
                F.concat(F.lit("EF"), (key % 6).cast("string")),
            ).alias("TOR_F_SCALE"),
        )
    )


STORM_SQL = """
harm_lines AS (
  SELECT l_orderkey,
    CAST(sum(CASE WHEN l_returnflag = 'R' AND l_quantity >= 48 THEN 1 ELSE 0 END) AS INT)
      AS INJURIES_DIRECT,
    CAST(sum(CASE WHEN l_returnflag = 'A' AND l_quantity >= 50 THEN 1 ELSE 0 END) AS INT)
      AS INJURIES_INDIRECT,
    CAST(sum(CASE WHEN l_discount >= 0.1 AND l_quantity >= 50 THEN 1 ELSE 0 END) AS INT)
      AS DEATHS_DIRECT,
    CAST(sum(CASE WHEN l_tax >= 0.08 AND l_quantity >= 50 THEN 1 ELSE 0 END) AS INT)
      AS DEATHS_INDIRECT
  FROM lineitem GROUP BY l_orderkey
),
storm AS MATERIALIZED (
  SELECT o_orderkey AS EVENT_ID,
    nullif(n_name, 'NATION_3') AS STATE,
    CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE c_mktsegment END AS CZ_NAME,
    CAST(year(o_orderdate) AS INT) AS YEAR,
    CASE WHEN o_orderkey % 89 = 0 THEN NULL
         WHEN o_orderpriority = '1-URGENT' THEN 'Tornado'
         WHEN o_orderpriority = '2-HIGH' THEN 'Flood'
         WHEN o_orderpriority = '3-MEDIUM' THEN 'Flash Flood'
         WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Hail'
         ELSE 'Heat' END AS EVENT_TYPE,
    INJURIES_DIRECT, INJURIES_INDIRECT, DEATHS_DIRECT, DEATHS_INDIRECT,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL
         WHEN o_orderkey % 13 = 0 THEN 'K'
         WHEN o_totalprice >= 400000 THEN
           concat('0.', CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS VARCHAR), 'M')
         ELSE concat(CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS VARCHAR), '.00K')
    END AS DAMAGE_PROPERTY,
    CASE WHEN o_orderkey % 7 = 0 THEN '0.00K'
         WHEN o_orderkey % 19 = 0 THEN 'M'
         WHEN o_orderkey % 5 = 0 THEN NULL
         ELSE concat(CAST(o_custkey % 90 AS VARCHAR), '.50K') END AS DAMAGE_CROPS,
    CASE WHEN o_orderstatus = 'P' THEN NULL
         WHEN o_orderkey % 10 = 0 THEN 0.0
         ELSE floor(o_totalprice / 50) / 100 END AS MAGNITUDE,
    CASE WHEN o_orderstatus = 'O' THEN 'EG'
         WHEN o_orderstatus = 'F' THEN 'MG' END AS MAGNITUDE_TYPE,
    CASE WHEN o_orderpriority = '1-URGENT' AND o_orderkey % 17 <> 0
         THEN concat('EF', CAST(o_orderkey % 6 AS VARCHAR)) END AS TOR_F_SCALE
  FROM orders
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN harm_lines ON o_orderkey = l_orderkey
)"""
