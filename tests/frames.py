"""Hand-made edge frames (FIXTURES.md section 4)."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal


FACT_SCHEMA = ("order_id long, user_id long, sale_price decimal(18,2), month string, "
               "order_created_at timestamp_ntz, order_status string, cost decimal(18,2), category string, "
               "brand string, department string, dist_center string, acq_source string, country string, "
               "customer_type string, profit decimal(18,2), lost boolean, net_sale_price decimal(18,2), "
               "item_created_at timestamp_ntz")


def fact_rows(spark, rows):
    """rows: (order_id, user_id, month 'yyyy-mm', status, price, brand) -> a fact DataFrame."""
    out = []
    for oid, uid, month, status, price, brand in rows:
        ts = datetime.fromisoformat(month + "-15 10:00:00")
        p = Decimal(str(price)).quantize(Decimal("0.01"))
        lost = status in ("Cancelled", "Returned")
        out.append((oid, uid, p, month, ts, status, Decimal("1.00"), "CAT", brand, "Small", "DC", "SRC", "XX",
                    "new", p - Decimal("1.00"), lost, Decimal("0.00") if lost else p, ts))
    return spark.createDataFrame(out, FACT_SCHEMA)


class FakeStar:
    """Duck-typed Star with given logical orders / order_items."""

    def __init__(self, spark, orders, items):
        self.spark = spark
        self.sf_dir, self.today, self.raw = "", "2001-08-01", {}
        self.orders = spark.createDataFrame(orders, "order_id long, user_id long, status string, "
                                                    "created_at timestamp_ntz, total_price double")
        self.order_items = spark.createDataFrame(items, "order_id long, line_number int, product_id long, "
                                                        "supplier_id long, sale_price decimal(18,2), quantity double, "
                                                        "line_status string, created_at timestamp_ntz, "
                                                        "shipped_at timestamp_ntz")


def col_list(df, c):
    return [r[c] for r in df.collect()]

