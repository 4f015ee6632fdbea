"""Freezing a snapshot of the source tables.

The cutoff filters are plain predicates and semi joins, so Catalyst pushes the
time bound into the parquet scan and plans IN-subqueries as (existence) joins.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpilens.functions.columns import before
from kpilens.sources.tables import Star, ts_text


# ---------------------------------------------------------------- A5
def scalar_columns(df: DataFrame) -> list[str]:
    """A5: ordered column list without the types a flat snapshot cannot hold (arrays,
    maps, structs, binary: the analogue of GEOGRAPHY)."""
    bad = (T.ArrayType, T.MapType, T.StructType, T.BinaryType)
    cols = [f.name for f in df.schema.fields if not isinstance(f.dataType, bad)]
    if not cols:
        raise ValueError("table has no exportable columns")
    return cols


def schema_columns(tables: dict[str, DataFrame]) -> DataFrame:
    """A5 as a table: (table_name, position, column_name, non_null) for every exportable
    column; the non-null counts come from one aggregate per table."""
    parts = []
    for name, df in tables.items():
        cols = scalar_columns(df)
        agg = df.agg(*[F.count(F.col(c)).alias(c) for c in cols])
        stack = F.inline(F.array(*[F.struct(F.lit(i + 1).alias("position"), F.lit(c).alias("column_name"),
                                            F.col(c).alias("non_null")) for i, c in enumerate(cols)]))
        parts.append(agg.select(F.lit(name).alias("table_name"), stack))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------- A6 / A7
MANIFEST = "table_name string, rows long, columns string, checksum decimal(38,0)"


def write_snapshot(df: DataFrame, path: str, key: str, partitions: int | None = None) -> tuple[int, int]:
    """Parquet in a fixed row order: range-partitioned on the key and sorted within
    partitions (a total order without funnelling every row through one task). Returns the rows
    and the checksum of what was written, observed in the same pass."""
    d = df.repartitionByRange(partitions, key) if partitions else df.repartitionByRange(key)
    seen = Observation()
    d = stored_form(d.sortWithinPartitions(key))                        # text only behind the exchange: it is wider
    d = d.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(row_hash(d)).alias("checksum"))
    d.write.mode("errorifexists").parquet(path)
    return seen.get["rows"], int(seen.get["checksum"] or 0)


def publish_snapshot(tables: dict[str, DataFrame], path: str) -> str:
    """Every table written once under a new folder, its manifest last. Timestamps are stored as text to the
    second (A4), types a flat file cannot hold are left out (A5). A snapshot without a manifest does not exist
    for `read_manifest`, so a job that dies half-way publishes nothing."""
    spark = next(iter(tables.values())).sparkSession
    rows = []
    for name, df in tables.items():
        cols = scalar_columns(df)
        n, checksum = write_snapshot(df.select(*cols), f"{path}/data/{name}", cols[0])
        rows.append((name, n, ",".join(cols), Decimal(checksum)))
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("errorifexists").json(f"{path}/manifest")     # a row a table
    return path


def stored_form(df: DataFrame) -> DataFrame:
    """The exportable columns, timestamps as text (A4, A5)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[(ts_text(c) if isinstance(types[c], (T.TimestampType, T.TimestampNTZType)) else F.col(c)).alias(c)
                       for c in scalar_columns(df)])


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).json(f"{path}/manifest")


def read_snapshot(spark: SparkSession, path: str, schemas: dict[str, T.StructType]) -> dict[str, DataFrame]:
    """The published tables by name, with the types of `schemas` (timestamps parsed back, to the second)."""
    out = {}
    for name, schema in schemas.items():
        like = spark.createDataFrame([], schema)
        stamps = [f.name for f in schema.fields if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))]
        df = spark.read.schema(stored_form(like).schema).parquet(f"{path}/data/{name}")
        out[name] = df.withColumns({c: F.col(c).cast(schema[c].dataType) for c in stamps})
    return out


def verify_snapshot(manifest: DataFrame, tables: dict[str, DataFrame] | DataFrame) -> DataFrame:
    """Each table of the manifest against what is there now (the tables, or their manifest): rows, columns and checksum; a
    table that is missing on either side is not ok."""
    found = tables if isinstance(tables, DataFrame) else table_manifest(tables)
    now = found.select("table_name", F.col("rows").alias("loaded_rows"), F.col("columns").alias("_columns"),
                                        F.coalesce("checksum", F.lit(0)).cast("decimal(38,0)").alias("loaded_checksum"))
    j = manifest.select("table_name", F.col("rows").alias("manifest_rows"), "columns", F.col("checksum").alias("manifest_checksum"))
    ok = ((F.col("manifest_rows") == F.col("loaded_rows")) & (F.col("columns") == F.col("_columns"))
          & (F.col("manifest_checksum") == F.col("loaded_checksum")))
    return j.join(now, "table_name", "full").select(
        "table_name", "manifest_rows", "loaded_rows", F.col("manifest_checksum").cast("long").alias("manifest_checksum"),
        F.col("loaded_checksum").cast("long").alias("loaded_checksum"), F.coalesce(ok, F.lit(False)).alias("ok"))


def cut_tables(star: Star, cutoff: str) -> dict[str, DataFrame]:
    """The source tables as the snapshot keeps them: orders before the cutoff (B1), their items (B2), the customers
    who own one (B3), the parts an item refers to (B4), all else whole."""
    return _references_kept(dict(star.raw, orders=star.raw["orders"].filter(before("o_orderdate", cutoff))))


def _references_kept(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables with the cut of `orders` carried on along the keys; whatever other columns they have."""
    t = dict(tables)
    t["lineitem"] = t["lineitem"].join(t["orders"].select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi") \
                                 .select(*t["lineitem"].columns)
    t["customer"] = t["customer"].join(t["orders"].select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi")
    t["part"] = t["part"].join(t["lineitem"].select(F.col("l_partkey").alias("p_partkey")).distinct(), "p_partkey", "left_semi")
    return t


CUT_KEYS = ("o_orderkey", "o_custkey", "l_orderkey", "l_partkey", "c_custkey", "p_partkey")


def cut_manifest(star: Star, cutoff: str) -> DataFrame:
    """`table_manifest` of `cut_tables`: every row is hashed where it is read, so keys and hashes, not rows, go through the joins."""
    whole = dict(star.raw, orders=star.raw["orders"].filter(before("o_orderdate", cutoff)))
    narrow = {name: df.select(*[c for c in CUT_KEYS if c in df.columns], row_hash(df).alias("_hash")) for name, df in whole.items()}
    return reduce(DataFrame.unionByName, [_manifest_row(name, df, F.col("_hash"), scalar_columns(whole[name]))
                                          for name, df in _references_kept(narrow).items()])


def canonical(c: str, dt: T.DataType) -> Column:
    """Text form of a value that another engine can reproduce exactly."""
    x = F.col(c)
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        return F.round(x * 100).cast("long").cast("string")
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(x, "yyyy-MM-dd HH:mm:ss")
    return x.cast("string")


def row_hash(df: DataFrame) -> Column:
    """The first 32 bits of md5 over a row's canonical text."""
    types = {f.name: f.dataType for f in df.schema.fields}
    text = F.concat_ws("|", *[canonical(c, types[c]) for c in scalar_columns(df)])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def table_manifest(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, column list and an order-free content checksum per table: the sum of the rows'
    hashes, so it is a plain aggregate with partial combine."""
    return reduce(DataFrame.unionByName, [_manifest_row(name, df, row_hash(df), scalar_columns(df)) for name, df in tables.items()])


def _manifest_row(name: str, df: DataFrame, row: Column, columns: list[str]) -> DataFrame:
    return (df.agg(F.count(F.lit(1)).alias("rows"), F.sum(row).alias("checksum"))
              .select(F.lit(name).alias("table_name"), "rows", F.lit(",".join(columns)).alias("columns"), "checksum"))


# ---------------------------------------------------------------- B1-B4
def snapshot_orders(star: Star, cutoff: str) -> DataFrame:
    """B1: orders created before the cutoff (pushed to the scan as o_orderdate < cutoff)."""
    return star.orders.filter(before("created_at", cutoff))


def snapshot_items(star: Star, cutoff: str) -> DataFrame:
    """B2: items whose order was kept; no time filter of their own."""
    return star.order_items.join(snapshot_orders(star, cutoff).select("order_id"), "order_id", "left_semi")


def snapshot_users(star: Star, cutoff: str) -> DataFrame:
    """Users created before the cutoff OR owning a kept order (an existence join)."""
    kept = snapshot_orders(star, cutoff).select(F.col("user_id").alias("_uid")).distinct()
    u = star.users
    return (u.join(kept, u.id == kept._uid, "left")
             .filter(before("created_at", cutoff) | F.col("_uid").isNotNull()).drop("_uid"))


def snapshot_products(star: Star, cutoff: str) -> DataFrame:
    """Products referenced by an item of a kept order (two-level IN: two semi joins).
    The fixtures have no inventory table; products stand in for it and carry no time."""
    used = snapshot_items(star, cutoff).select(F.col("product_id").alias("id")).distinct()
    return star.products.join(used, "id", "left_semi")


def users_with_time(star: Star, shift_days: int) -> DataFrame:
    """Users with the time they were first seen: their first event, `shift_days` days earlier (the events start long
    after the orders); NULL without events. One row per user, from a partial aggregate."""
    first = star.events.groupBy(F.col("user_id").alias("id")).agg(F.min("ts").alias("_first"))
    when = F.col("_first") - F.make_dt_interval(F.lit(shift_days))
    return star.users.drop("created_at").join(first, "id", "left").withColumn("created_at", when).drop("_first")


def products_with_time(star: Star) -> DataFrame:
    """Products with the time their first item was stamped (they stand for inventory); NULL if none was."""
    first = star.order_items.groupBy(F.col("product_id").alias("id")).agg(F.min("created_at").alias("created_at"))
    return star.products.join(first, "id", "left")


def created_or_referenced(entity: DataFrame, cutoff: str, refs: DataFrame, key: str = "id") -> DataFrame:
    """`created_at < cutoff OR key IN (refs)`. A row of either kind stays once, however often it is referenced; a NULL
    time or key fails its own branch only. Planned as an existence join; `refs` is its single column."""
    ref = refs.columns[0]
    held = refs.select(F.col(ref).alias("_ref"))
    found = held.where(F.col("_ref") == F.col(key).outer()).exists()
    return entity.where(before("created_at", cutoff) | found)


def opening_users(star: Star, cutoff: str, shift_days: int) -> DataFrame:
    """B3 with both branches: users first seen before the cutoff, or owning an order created before it."""
    return created_or_referenced(users_with_time(star, shift_days), cutoff, snapshot_orders(star, cutoff).select("user_id"))


def opening_inventory(star: Star, cutoff: str) -> DataFrame:
    """B4 with both branches: products first stamped before the cutoff, or referenced by an item of a kept order."""
    return created_or_referenced(products_with_time(star), cutoff, snapshot_items(star, cutoff).select("product_id"))


# ---------------------------------------------------------------- B5 / B6 / B8
def required_values(df: DataFrame, column: str, required: list[str], spark: SparkSession) -> DataFrame:
    """Is every required value present? One row per required value with its count."""
    req = spark.createDataFrame([(v,) for v in required], f"{column} string")
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return (req.join(counts, column, "left")
               .select(column, F.coalesce("n", F.lit(0)).alias("n"), F.col("n").isNotNull().alias("present")))


def value_histogram(df: DataFrame, column: str) -> DataFrame:
    """COUNT(*) GROUP BY column ORDER BY n DESC."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column)


def snapshot_checks(star: Star, sessions: DataFrame, cutoff: str) -> DataFrame:
    """Max order time, three orphan counts and the session purchase rate, one row."""
    o, oi = snapshot_orders(star, cutoff), snapshot_items(star, cutoff)
    p, u = star.products, star.users
    n_no_order = oi.join(o.select("order_id"), "order_id", "left_anti").agg(F.count(F.lit(1)).alias("v"))
    n_no_prod = (oi.join(p.select(F.col("id").alias("product_id")), "product_id", "left_anti")
                   .agg(F.count(F.lit(1)).alias("v")))
    n_no_user = (o.join(u.select(F.col("id").alias("user_id")), "user_id", "left_anti")
                  .agg(F.count(F.lit(1)).alias("v")))
    return (o.agg(F.date_format(F.max("created_at"), "yyyy-MM-dd HH:mm:ss").alias("max_order_created_at"))
             .crossJoin(n_no_order.select(F.col("v").alias("order_items_without_order")))
             .crossJoin(n_no_prod.select(F.col("v").alias("order_items_without_product")))
             .crossJoin(n_no_user.select(F.col("v").alias("orders_without_user")))
             .crossJoin(sessions.agg(F.avg(F.col("purchased").cast("int")).alias("session_purchase_rate"))))

