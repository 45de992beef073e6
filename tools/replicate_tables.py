"""Derive a k-fold larger copy of the test tables, for scaling measurements.

Usage: python tools/replicate_tables.py SRC_DIR DST_DIR K

Each copy shifts every key (orders, customers, events) by a per-copy offset,
so joins stay one-to-one and the copies are disjoint; ``part`` and
``nation`` (dimensions) are kept as they are.  Written as Parquet with
several files per table, so scans split.  Nothing here is registered as a
query; it only feeds ``bench.py`` through ``BENCH_SF_DIR``.
"""

from __future__ import annotations

import sys

from pyspark.sql import functions as F

sys.path.insert(0, ".")
from cartlytics.session import local_session  # noqa: E402

# table -> (key column, offset unit) columns shifted per copy
SHIFTS = {
    "customer": {"c_custkey": "cust"},
    "orders": {"o_orderkey": "order", "o_custkey": "cust"},
    "lineitem": {"l_orderkey": "order"},
    "events": {"event_id": "event", "user_id": "cust"},
}


def main() -> None:
    src, dst, k = sys.argv[1], sys.argv[2], int(sys.argv[3])
    spark = local_session()
    read = lambda t: spark.read.parquet(f"{src}/{t}.parquet")
    span = {
        "cust": read("customer").agg(F.max("c_custkey")).first()[0] + 1,
        "order": read("orders").agg(F.max("o_orderkey")).first()[0] + 1,
        "event": read("events").agg(F.max("event_id")).first()[0] + 1,
    }
    for table, shifts in SHIFTS.items():
        df = read(table)
        # a generator over k copies, not a join: each row is emitted k times
        rep = df.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
        for col, unit in shifts.items():
            rep = rep.withColumn(col, F.col(col) + F.col("_copy") * F.lit(span[unit]))
        (rep.drop("_copy").repartition(max(1, k // 2))
         .write.mode("overwrite").parquet(f"{dst}/{table}.parquet"))
    for table in ("part", "nation"):
        read(table).write.mode("overwrite").parquet(f"{dst}/{table}.parquet")
    spark.stop()


if __name__ == "__main__":
    main()
