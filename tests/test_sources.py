from __future__ import annotations

import os
from datetime import datetime
from decimal import Decimal

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from cartlytics.sources import tables as tbl
from cartlytics.sources.schemas import SCHEMAS

SAMPLES = os.path.join(os.path.dirname(__file__), "data")


def _write(tmp_path, name, text):
    p = tmp_path / f"{name}.csv"
    p.write_text(text)
    return str(p)


def test_csv_types_and_text_cases(spark, tmp_path):
    orders = _write(tmp_path, "orders",
                    "order_id,customer_id,order_ts,source,revenue_usd\n"
                    "1,7,2024-11-24,web,1052.1299999999999\n"
                    "2,8,2024-11-25 13:45:00,app,1172.7\n")
    rows = tbl.load_csv(spark, orders, "orders").orderBy("order_id").collect()
    assert rows[0]["order_ts"] == datetime(2024, 11, 24)
    assert rows[0]["revenue_usd"] == Decimal("1052.13")
    assert rows[1]["revenue_usd"] == Decimal("1172.70")
    exp = _write(tmp_path, "marketing_experiments",
                 "exp_id,user_id,group,exposed_ts,converted,conversion_ts\n"
                 "1,5,A,2024-02-01,False,\n"
                 "2,6,B,2024-02-02,True,2024-02-10\n")
    df = tbl.load_csv(spark, exp, "marketing_experiments")
    assert df.schema == SCHEMAS["marketing_experiments"] or [f.name for f in df.schema] == \
        [f.name for f in SCHEMAS["marketing_experiments"]]
    r = {x["exp_id"]: x for x in df.collect()}
    assert r[1]["converted"] is False and r[1]["conversion_ts"] is None
    assert r[2]["converted"] is True and r[2]["group"] == "B"


def test_csv_bad_value_fails(spark, tmp_path):
    bad = _write(tmp_path, "order_items", "order_id,product_id,qty,unit_price_usd\n1,2,three,9.99\n")
    with pytest.raises(Py4JJavaError, match="MALFORMED_RECORD_IN_PARSING"):
        tbl.load_csv(spark, bad, "order_items").collect()


def test_repeated_non_key_allowed(spark, tmp_path):
    items = _write(tmp_path, "order_items",
                   "order_id,product_id,qty,unit_price_usd\n1,2,1,9.99\n1,3,2,5\n")
    assert tbl.load_csv(spark, items, "order_items").count() == 2


def test_round_trip_csv_and_parquet(spark, shop, tmp_path):
    tables = dict(shop)
    tables["events"] = spark.createDataFrame([], SCHEMAS["events"])
    tables["marketing_experiments"] = spark.createDataFrame([], SCHEMAS["marketing_experiments"])
    for fmt in ("csv", "parquet"):
        out = str(tmp_path / fmt)
        tbl.write_tables(tables, out, fmt)
        if fmt == "csv":
            back = {t: tbl.load_csv(spark, f"{out}/{t}.csv", t) for t in tables}
        else:
            back = tbl.load_tables_parquet(spark, out)
        for t, df in tables.items():
            assert sorted(map(tuple, back[t].collect())) == sorted(map(tuple, df.collect())), (fmt, t)


def test_register_count_preview(spark, shop):
    names = tbl.register_tables(shop)
    assert {"customers", "orders", "order_items", "products"} <= set(names)
    assert spark.sql("SELECT COUNT(*) FROM orders").first()[0] == 5
    by_ordinal = spark.sql("SELECT source, COUNT(*) AS n FROM orders GROUP BY 1 ORDER BY 2 DESC, 1").collect()
    assert [tuple(r) for r in by_ordinal] == [("web", 2), ("app", 1), ("guild", 1), ("sales", 1)]
    counts = {r["table_name"]: r["n_rows"] for r in tbl.table_row_counts(shop).collect()}
    assert counts == {"customers": 4, "products": 3, "orders": 5, "order_items": 6}
    prev = tbl.table_preview(shop["orders"].repartition(3), "order_id", 2).collect()
    assert [r["order_id"] for r in prev] == [100, 101]
    assert set(tbl.preview_all(shop, 1)) == set(shop)


def test_header_in_another_order_fails(spark, tmp_path):
    bad = _write(tmp_path, "order_items", "product_id,order_id,qty,unit_price_usd\n1,2,3,9.99\n")
    with pytest.raises(Py4JJavaError, match="CSV header does not conform to the schema"):
        tbl.load_csv(spark, bad, "order_items").collect()


def test_missing_files_fail_unless_asked(spark, tmp_path):
    _write(tmp_path, "order_items", "order_id,product_id,qty,unit_price_usd\n1,2,3,9.99\n")
    with pytest.raises(PySparkException, match="PATH_NOT_FOUND"):
        tbl.load_tables_csv(spark, str(tmp_path))
    found, skipped = tbl.load_available_csv(spark, str(tmp_path))
    assert set(found) == {"order_items"} and set(skipped) == set(SCHEMAS) - {"order_items"}


def test_enforced_keys_abort_the_load(spark, tmp_path):
    for name in SCHEMAS:
        text = open(f"{SAMPLES}/{name}.csv").read()
        if name == "products":
            text += "1,Again,garden,5.00\n,No key,garden,5.00\n"
        _write(tmp_path, name, text)
    assert len(tbl.load_tables_csv(spark, str(tmp_path))) == 6
    with pytest.raises(ValueError, match="products.product_id: 1 null, 1 repeated"):
        tbl.load_tables_csv(spark, str(tmp_path), enforce=True)
