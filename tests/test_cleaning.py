import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from brightlake.operators import cleaning, quality
from brightlake.schemas import BRONZE_CUSTOMERS, BRONZE_ORDERS, BRONZE_PRODUCTS

AS_OF = "2026-01-15"


def order(oid, cust=1, prod=1, price=10.0, qty=1, disc=0.0, total=10.0, status="completed",
          created="2026-01-10T10:00:00+00:00"):
    return (oid, cust, prod, "p", "c", price, qty, disc, total, "FR", status, "card", created)


def orders_dirty(spark):
    rows = [
        order("a", total=20.0, created="2026-01-10T09:00:00+00:00"),   # first created: kept
        order("a", total=99.0, created="2026-01-10T11:00:00+00:00"),   # duplicate, later
        order(None),                                                    # null key
        order("b", cust=None),                                          # null customer
        order("c", total=0.0), order("d", total=-1.0), order("e", total=None),
        order("f", status=" Completed "),
        order("g", created="not a date"),
        order("h", disc=None), order("i", disc=1.2), order("j", qty=101),
    ]
    return spark.createDataFrame(rows, BRONZE_ORDERS)


def test_clean_orders_rules(spark):
    out = {r.order_id: r for r in cleaning.clean_orders(orders_dirty(spark), AS_OF).collect()}
    assert set(out) == {"a", "f", "g", "h", "i", "j"}
    assert out["a"].total_amount == 20.0                 # dedupe: first created wins
    assert out["f"].status == "completed"                # lower(trim())
    assert out["g"].created_at is None and out["g"].order_date is None   # bad timestamp -> NULL
    assert out["h"].revenue_net is None                  # NULL discount propagates
    assert out["a"].revenue_net == Decimal("20.00")
    assert out["a"].is_refunded is False
    assert out["a"]._ingested_at == dt.datetime(2026, 1, 15)


def test_clean_is_idempotent(spark):
    once = cleaning.clean_orders(orders_dirty(spark), AS_OF)
    again = cleaning.clean_orders(once.drop("revenue_net", "is_refunded", "order_date",
                                            "_ingested_at"), AS_OF)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, again.collect()))


def test_quality_on_raw_orders(spark):
    raw = orders_dirty(spark).withColumn("status", cleaning.norm_text("status"))
    res = {r.check_name: r for r in quality.run_rules(raw, "orders", "bronze",
                                                      quality.order_rules(), AS_OF).collect()}
    assert res["no_null_order_id"].rows_failed == 1
    assert res["positive_amount"].rows_failed == 2       # NULL amount is not a failure
    assert res["valid_quantity"].rows_failed == 1
    assert res["non_negative_discount"].rows_failed == 1
    assert all(r.rows_tested == 12 for r in res.values())
    assert res["no_null_order_id"].status == "fail"
    strict = quality.run_rules(raw, "orders", "bronze", quality.order_rules(), AS_OF,
                               null_fails=True)
    s = {r.check_name: r.rows_failed for r in strict.collect()}
    assert s["positive_amount"] == 3 and s["non_negative_discount"] == 2


def test_clean_customers_snapshots(spark):
    rows = [(1, "A", " Foo@X.com ", "FR", "VIP", "2025-01-15T00:00:00", "2026-01-01"),
            (1, "A", "new@x.com", "FR", "premium", "2025-01-15T00:00:00", "2026-01-02"),
            (2, "B", None, "FR", "standard", "2025-01-15T00:00:00", "2026-01-02"),
            (3, "C", "noat", "DE", None, "2025-06-15T00:00:00", "2026-01-02"),
            (4, "D", "d@x", "DE", "unknown", None, "2026-01-02")]
    schema = StructType(BRONZE_CUSTOMERS.fields + [StructField("_snapshot", StringType())])
    df = spark.createDataFrame(rows, schema) \
        .withColumn("_snapshot", F.to_date("_snapshot"))
    out = {r.customer_id: r for r in cleaning.clean_customers(df, AS_OF).collect()}
    assert set(out) == {1, 3, 4}
    assert out[1].email == "new@x.com" and out[1].segment == "premium"   # newest snapshot
    assert out[1].days_since_joined == 365
    res = {r.check_name: r.rows_failed for r in quality.run_rules(
        cleaning.clean_customers(df, AS_OF), "customers", "silver", quality.customer_rules(),
        AS_OF).collect()}
    assert res == {"no_null_customer_id": 0, "valid_email": 1, "valid_segment": 1}


def test_clean_products_tiers(spark):
    rows = [(1, "a", "x", 0.0, 1, 4.0, 1), (2, "b", "x", 49.99, 1, 5.1, 1),
            (3, "c", "x", 50.0, 1, None, 1), (4, "d", "x", 200.0, 1, 3.0, 1),
            (5, "e", "x", 500.0, 1, 3.0, 1), (6, None, "x", 10.0, 1, 3.0, 1)]
    df = spark.createDataFrame(rows, BRONZE_PRODUCTS)
    out = {r.product_id: r.price_tier for r in cleaning.clean_products(df, AS_OF).collect()}
    assert out == {2: "budget", 3: "mid", 4: "premium", 5: "luxury"}
    res = {r.check_name: r.rows_failed for r in quality.run_rules(
        cleaning.clean_products(df, AS_OF), "products", "silver", quality.product_rules(),
        AS_OF).collect()}
    assert res["valid_rating"] == 1


def test_fill_defaults_keeps_real_zero(spark):
    df = spark.createDataFrame([(1, 0), (2, None)], "id long, days_since_last int")
    out = dict(cleaning.fill_defaults(df, {"days_since_last": 999}).collect())
    assert out == {1: 0, 2: 999}
