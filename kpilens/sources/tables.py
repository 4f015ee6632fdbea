"""Table scans (A1, A4) and the logical star schema over the driver's tables.

`load(spark, sf_dir)` reads every parquet table with an explicit schema. The
`Star` object exposes the logical tables the KPI rules talk about (orders,
order_items, products, users, distribution centres, events) as projections of
the stored TPC-H-style tables; every projection is lazy, so Catalyst prunes
columns and pushes filters into the parquet scans.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpilens.config import FIXTURE_TODAY

TS = T.TimestampNTZType()

SCHEMAS: dict[str, T.StructType] = {
    "region": T.StructType([T.StructField("r_regionkey", T.IntegerType()),
                            T.StructField("r_name", T.StringType())]),
    "nation": T.StructType([T.StructField("n_nationkey", T.IntegerType()),
                            T.StructField("n_name", T.StringType()),
                            T.StructField("n_regionkey", T.IntegerType())]),
    "customer": T.StructType([T.StructField("c_custkey", T.LongType()),
                              T.StructField("c_name", T.StringType()),
                              T.StructField("c_nationkey", T.IntegerType()),
                              T.StructField("c_acctbal", T.DoubleType()),
                              T.StructField("c_mktsegment", T.StringType())]),
    "supplier": T.StructType([T.StructField("s_suppkey", T.LongType()),
                              T.StructField("s_name", T.StringType()),
                              T.StructField("s_nationkey", T.IntegerType()),
                              T.StructField("s_acctbal", T.DoubleType())]),
    "part": T.StructType([T.StructField("p_partkey", T.LongType()),
                          T.StructField("p_name", T.StringType()),
                          T.StructField("p_brand", T.StringType()),
                          T.StructField("p_type", T.StringType()),
                          T.StructField("p_size", T.IntegerType()),
                          T.StructField("p_retailprice", T.DoubleType())]),
    "orders": T.StructType([T.StructField("o_orderkey", T.LongType()),
                            T.StructField("o_custkey", T.LongType()),
                            T.StructField("o_orderstatus", T.StringType()),
                            T.StructField("o_totalprice", T.DoubleType()),
                            T.StructField("o_orderdate", TS),
                            T.StructField("o_orderpriority", T.StringType())]),
    "lineitem": T.StructType([T.StructField("l_orderkey", T.LongType()),
                              T.StructField("l_partkey", T.LongType()),
                              T.StructField("l_suppkey", T.LongType()),
                              T.StructField("l_linenumber", T.IntegerType()),
                              T.StructField("l_quantity", T.DoubleType()),
                              T.StructField("l_extendedprice", T.DoubleType()),
                              T.StructField("l_discount", T.DoubleType()),
                              T.StructField("l_tax", T.DoubleType()),
                              T.StructField("l_returnflag", T.StringType()),
                              T.StructField("l_linestatus", T.StringType()),
                              T.StructField("l_shipdate", TS)]),
    "events": T.StructType([T.StructField("event_id", T.LongType()),
                            T.StructField("ts", TS),
                            T.StructField("user_id", T.LongType()),
                            T.StructField("event_type", T.StringType()),
                            T.StructField("value", T.DoubleType()),
                            T.StructField("props", T.StringType())]),
    "documents": T.StructType([T.StructField("doc_id", T.LongType()),
                               T.StructField("text", T.StringType()),
                               T.StructField("lang", T.StringType()),
                               T.StructField("source", T.StringType()),
                               T.StructField("n_chars", T.LongType())]),
    "embeddings": T.StructType([T.StructField("vec_id", T.LongType()),
                                T.StructField("embedding", T.ArrayType(T.FloatType())),
                                T.StructField("label", T.IntegerType())]),
    "pages": T.StructType([T.StructField("page_id", T.LongType()),
                           T.StructField("url", T.StringType()),
                           T.StructField("html", T.StringType())]),
    "benchmark": T.StructType([T.StructField("item_id", T.LongType()),
                               T.StructField("text", T.StringType())]),
    "labels": T.StructType([T.StructField("doc_id", T.LongType()),
                            T.StructField("quality", T.IntegerType()),
                            T.StructField("toxic", T.IntegerType())]),
    "conversations": T.StructType([T.StructField("conv_id", T.LongType()),
                                   T.StructField("turn", T.LongType()),
                                   T.StructField("role", T.StringType()),
                                   T.StructField("text", T.StringType())]),
}

TABLE_NAMES = tuple(SCHEMAS)
MONEY = T.DecimalType(18, 2)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A1: one table per parquet file, explicit schema (no inference, no listing surprises)."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load(spark: SparkSession, sf_dir: str, register: bool = False) -> dict[str, DataFrame]:
    tables = {n: read_table(spark, sf_dir, n) for n in TABLE_NAMES}
    if register:
        for n, df in tables.items():
            df.createOrReplaceTempView(n)
    return tables


def order_status(priority: Column, status: Column) -> Column:
    """Fixture mapping of the five order statuses (about 20 % each)."""
    return (F.when(priority == "5-LOW", "Cancelled")
             .when(priority == "4-NOT SPECIFIED", "Returned")
             .when(status == "F", "Complete")
             .when(status == "O", "Shipped")
             .otherwise("Processing"))


def ts_text(c: Column | str) -> Column:
    """A4: timestamps as UTC text at second precision (the reference's stored form)."""
    return F.date_format(c if isinstance(c, Column) else F.col(c), "yyyy-MM-dd HH:mm:ss")


def month_key(c: Column | str) -> Column:
    """R2 month key 'yyyy-MM'. Use `month_range` for filters: this form is not sargable."""
    return F.date_format(c if isinstance(c, Column) else F.col(c), "yyyy-MM")


@dataclass
class Star:
    """The logical retail star schema over one directory of tables."""

    spark: SparkSession
    sf_dir: str
    today: str = FIXTURE_TODAY

    @cached_property
    def raw(self) -> dict[str, DataFrame]:
        return load(self.spark, self.sf_dir)

    # -- logical tables -------------------------------------------------------------
    @property
    def orders(self) -> DataFrame:
        o = self.raw["orders"]
        return o.select(F.col("o_orderkey").alias("order_id"),
                        F.col("o_custkey").alias("user_id"),
                        order_status(F.col("o_orderpriority"), F.col("o_orderstatus")).alias("status"),
                        F.col("o_orderdate").alias("created_at"),
                        F.col("o_totalprice").alias("total_price"))

    @property
    def order_items(self) -> DataFrame:
        li = self.raw["lineitem"]
        return li.select(F.col("l_orderkey").alias("order_id"),
                         F.col("l_linenumber").alias("line_number"),
                         F.col("l_partkey").alias("product_id"),
                         F.col("l_suppkey").alias("supplier_id"),
                         F.col("l_extendedprice").cast(MONEY).alias("sale_price"),
                         F.col("l_quantity").alias("quantity"),
                         F.col("l_linestatus").alias("line_status"),
                         F.col("l_shipdate").alias("created_at"),
                         F.col("l_shipdate").alias("shipped_at"))

    @property
    def products(self) -> DataFrame:
        p = self.raw["part"]
        return p.select(F.col("p_partkey").alias("id"),
                        F.col("p_retailprice").cast(MONEY).alias("cost"),
                        F.col("p_type").alias("category"),
                        F.nullif(F.col("p_brand"), F.lit("Brand#13")).alias("brand"),
                        F.when(F.col("p_size") <= 25, "Small").otherwise("Large").alias("department"),
                        F.col("p_name").alias("name"),
                        F.col("p_retailprice").alias("retail_price"))

    @property
    def users(self) -> DataFrame:
        c, n = self.raw["customer"], self.raw["nation"]
        # nation has 25 rows by the TPC-H specification: a proven broadcast bound
        return (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "left")
                 .select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                         F.col("n_name").alias("country"),
                         F.col("c_mktsegment").alias("traffic_source"),
                         F.col("c_acctbal").alias("acctbal"),
                         F.lit(None).cast(TS).alias("created_at")))

    @property
    def distribution_centers(self) -> DataFrame:
        """A supplier stands for a distribution centre; its name is the supplier's nation."""
        s, n, r = self.raw["supplier"], self.raw["nation"], self.raw["region"]
        return (s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey, "left")
                 .join(F.broadcast(r), F.col("n_regionkey") == r.r_regionkey, "left")
                 .select(F.col("s_suppkey").alias("id"), F.col("n_name").alias("name"),
                         F.col("r_name").alias("region")))

    @property
    def events(self) -> DataFrame:
        return self.raw["events"]

    @property
    def conversations(self) -> DataFrame:
        return self.raw["conversations"]
