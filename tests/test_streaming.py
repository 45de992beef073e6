from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.errors import StreamingQueryException

from cartlytics.streaming.files import read_table_stream


def test_csv_stream_uses_declared_schema(spark, tmp_path):
    src = tmp_path / "orders"
    src.mkdir()
    (src / "part-1.csv").write_text("order_id,customer_id,order_ts,source,revenue_usd\n"
                                    "1,7,2024-11-24,web,1052.1299999999999\n")
    stream = read_table_stream(spark, str(src), "orders")
    assert stream.isStreaming
    q = (stream.writeStream.format("memory").queryName("orders_stream_test")
         .option("checkpointLocation", str(tmp_path / "ckpt")).start())
    try:
        q.processAllAvailable()
        (src / "part-2.csv").write_text("order_id,customer_id,order_ts,source,revenue_usd\n"
                                        "2,8,2024-11-25 10:00:00,app,5\n")
        q.processAllAvailable()
    finally:
        q.stop()
    rows = spark.sql("SELECT order_id, revenue_usd FROM orders_stream_test ORDER BY order_id").collect()
    assert [(r[0], r[1]) for r in rows] == [(1, Decimal("1052.13")), (2, Decimal("5.00"))]


def test_swapped_header_fails_the_stream(spark, tmp_path):
    src = tmp_path / "orders"
    src.mkdir()
    (src / "part-1.csv").write_text("customer_id,order_id,order_ts,source,revenue_usd\n7,1,2024-11-24,web,5\n")
    q = (read_table_stream(spark, str(src), "orders").writeStream.format("memory").queryName("swapped_header")
         .option("checkpointLocation", str(tmp_path / "ckpt")).start())
    try:
        with pytest.raises(StreamingQueryException):
            q.processAllAvailable()
    finally:
        q.stop()
