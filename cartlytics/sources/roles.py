"""Map the driver's test tables onto the six product-analytics roles.

Each role is one projection, written twice: as a DataFrame (used by the
queries) and as SQL text (used word for word by the DuckDB oracle as a CTE).
``tests/test_oracle.py`` runs both forms side by side.

Fixed values of the mapping (ours, not the reference's):
- signup_date = 1995-01-01 plus (customer key mod 730) days
- order status F, O, P become the funnel steps visit, signup, purchase
- event type 'view' becomes 'visit'
- experiment arm A for even customer keys, B for odd; exposure is the first
  order, conversion an order 1 to 29 days after it
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


SIGNUP_EPOCH = "1995-01-01"
SIGNUP_SPREAD_DAYS = 730
CONVERSION_MIN_DAYS = 1
CONVERSION_MAX_DAYS = 29


# Declared schemas of the driver's test tables (the columns the roles read).
# Reading with a schema skips Spark's footer-inference job; at scale it also
# avoids listing footers of many files just to learn known types.
TEST_TABLE_SCHEMAS: dict[str, str] = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TEST_TABLE_SCHEMAS:
        reader = reader.schema(TEST_TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class RoleTables:
    """Lazily projected role DataFrames over one ``sf`` directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._tables: dict[str, DataFrame] = {}

    def _t(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = read_table(self.spark, self.sf_dir, name)
        return self._tables[name]

    def customers(self) -> DataFrame:
        c = self._t("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
        # no hint: nation is tiny, so the planner's size estimate broadcasts it
        n = self._t("nation").select("n_nationkey", "n_name")
        return c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
            F.col("c_custkey").alias("customer_id"),
            F.date_add(F.lit(SIGNUP_EPOCH).cast("date"),
                       (F.col("c_custkey") % SIGNUP_SPREAD_DAYS).cast("int")).alias("signup_date"),
            F.col("n_name").alias("country"),
            F.lit(None).cast("string").alias("age_band"),
            F.lit(None).cast("string").alias("income_band"),
            F.col("c_mktsegment").alias("channel"),
        )

    def base_customers(self) -> DataFrame:
        """The customers without the country, which needs a join: enough to
        count them and check their keys."""
        return self._t("customer").select(F.col("c_custkey").alias("customer_id"))

    def products(self) -> DataFrame:
        return self._t("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.col("p_retailprice").cast("decimal(10,2)").alias("price_usd"),
        )

    def orders(self) -> DataFrame:
        return self._t("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("order_ts"),
            F.col("o_orderpriority").alias("source"),
            F.col("o_totalprice").cast("decimal(12,2)").alias("revenue_usd"),
        )

    def order_items(self) -> DataFrame:
        return self._t("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("int").alias("qty"),
            F.col("l_extendedprice").cast("decimal(10,2)").alias("unit_price_usd"),
        )

    def events(self) -> DataFrame:
        """Event set 1: the ``events`` table, 'view' read as 'visit'."""
        et = F.col("event_type")
        return self._t("events").select(
            F.col("event_id"),
            F.col("user_id").alias("customer_id"),
            F.col("ts").alias("event_ts"),
            F.when(et == "view", F.lit("visit")).otherwise(et).alias("event_type"),
        )

    def order_events(self) -> DataFrame:
        """Event set 2: order status as funnel step (F visit, O signup, P purchase)."""
        st = F.col("o_orderstatus")
        return self._t("orders").select(
            F.col("o_orderkey").alias("event_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("event_ts"),
            F.when(st == "F", "visit").when(st == "O", "signup")
             .when(st == "P", "purchase").alias("event_type"),
        )

    def marketing_experiments(self) -> DataFrame:
        """One participant per ordering customer.

        The orders are first reduced to one row per (customer, day), so a
        customer's group in the window below is bounded by the calendar, not
        by how many orders a hot customer places.
        """
        # earliest order per (customer, day): the exposure and the conversion
        # are minima over these, and a customer has at most one row per day
        days = (self._t("orders")
                .where(F.col("o_custkey").isNotNull() & F.col("o_orderdate").isNotNull())
                .groupBy(F.col("o_custkey").alias("user_id"), F.to_date("o_orderdate").alias("day"))
                .agg(F.min("o_orderdate").alias("ts")))
        per_user = Window.partitionBy("user_id")
        delay = F.datediff(F.to_date("ts"), F.to_date("exposed_ts"))
        with_first = days.withColumn("exposed_ts", F.min("ts").over(per_user))
        return (with_first
                .groupBy("user_id", "exposed_ts")
                .agg(F.min(F.when(delay.between(CONVERSION_MIN_DAYS, CONVERSION_MAX_DAYS),
                                  F.col("ts"))).alias("conversion_ts"))
                .select(
                    F.col("user_id").alias("exp_id"),
                    "user_id",
                    F.when(F.col("user_id") % 2 == 0, "A").otherwise("B").alias("group"),
                    "exposed_ts",
                    F.col("conversion_ts").isNotNull().alias("converted"),
                    "conversion_ts",
                ))

    def all(self) -> dict[str, DataFrame]:
        return {
            "customers": self.customers(),
            "products": self.products(),
            "orders": self.orders(),
            "order_items": self.order_items(),
            "events": self.events(),
            "marketing_experiments": self.marketing_experiments(),
        }


# The same projections as SQL, for the DuckDB oracle (and for spark.sql).
ROLE_SQL: dict[str, str] = {
    "r_customers": (
        "SELECT c.c_custkey AS customer_id, "
        f"CAST(DATE '{SIGNUP_EPOCH}' + CAST(c.c_custkey % {SIGNUP_SPREAD_DAYS} AS INTEGER) AS DATE) AS signup_date, "
        "n.n_name AS country, CAST(NULL AS VARCHAR) AS age_band, CAST(NULL AS VARCHAR) AS income_band, "
        "c.c_mktsegment AS channel "
        "FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey"
    ),
    "r_products": (
        "SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, "
        "CAST(p_retailprice AS DECIMAL(10,2)) AS price_usd FROM part"
    ),
    "r_orders": (
        "SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_ts, "
        "o_orderpriority AS source, CAST(o_totalprice AS DECIMAL(12,2)) AS revenue_usd FROM orders"
    ),
    "r_order_items": (
        "SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS qty, "
        "CAST(l_extendedprice AS DECIMAL(10,2)) AS unit_price_usd FROM lineitem"
    ),
    "r_events": (
        "SELECT event_id, user_id AS customer_id, ts AS event_ts, "
        "CASE WHEN event_type = 'view' THEN 'visit' ELSE event_type END AS event_type FROM events"
    ),
    "r_order_events": (
        "SELECT o_orderkey AS event_id, o_custkey AS customer_id, o_orderdate AS event_ts, "
        "CASE o_orderstatus WHEN 'F' THEN 'visit' WHEN 'O' THEN 'signup' WHEN 'P' THEN 'purchase' END "
        "AS event_type FROM orders"
    ),
    "r_experiments": (
        "SELECT f.user_id AS exp_id, f.user_id, "
        "CASE WHEN f.user_id % 2 = 0 THEN 'A' ELSE 'B' END AS \"group\", f.exposed_ts, "
        "MIN(o.o_orderdate) IS NOT NULL AS converted, MIN(o.o_orderdate) AS conversion_ts "
        "FROM (SELECT o_custkey AS user_id, MIN(o_orderdate) AS exposed_ts FROM orders "
        "      WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL GROUP BY 1) f "
        "LEFT JOIN orders o ON o.o_custkey = f.user_id "
        "AND date_diff('day', CAST(f.exposed_ts AS DATE), CAST(o.o_orderdate AS DATE)) "
        f"BETWEEN {CONVERSION_MIN_DAYS} AND {CONVERSION_MAX_DAYS} "
        "GROUP BY f.user_id, f.exposed_ts"
    ),
}


def with_roles(sql: str, *roles: str) -> str:
    """Prefix ``sql`` with the role CTEs it names."""
    ctes = ",\n".join(f"{name} AS ({ROLE_SQL[name]})" for name in roles)
    return f"WITH {ctes}\n{sql}"
