"""Key checks at load: primary keys (unique, not null) and the documented
relationships.  The checks report violation counts; ``enforce_primary_keys``
raises.  A table that is not there is an error unless ``skip_missing`` is
given; its row then says so with NULL counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.schemas import FOREIGN_KEYS, PRIMARY_KEYS


def primary_key_violations(df: DataFrame, table: str, key: str) -> DataFrame:
    """table_name, key_column, n_rows, null_keys, duplicate_keys (key values
    seen more than once), duplicate_rows (rows beyond the first per key).

    One aggregation by key (partially combined before the shuffle), then a
    global aggregate over the per-key counts.
    """
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("c"))
    has_key = F.col(key).isNotNull()
    return per_key.agg(
        F.lit(table).alias("table_name"),
        F.lit(key).alias("key_column"),
        F.coalesce(F.sum("c"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.coalesce(F.sum(F.when(~has_key, F.col("c"))), F.lit(0)).cast("bigint").alias("null_keys"),
        F.count_if(has_key & (F.col("c") > 1)).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(has_key & (F.col("c") > 1), F.col("c") - 1)), F.lit(0))
        .cast("bigint").alias("duplicate_rows"),
    )


def _spark(tables: dict[str, DataFrame]):
    return next(iter(tables.values())).sparkSession


def _require(tables: dict[str, DataFrame], names, skip_missing: bool) -> None:
    missing = [n for n in names if n not in tables]
    if missing and not skip_missing or not tables:
        raise KeyError(f"tables not given: {', '.join(missing)}")


PK_SCHEMA = ("table_name string, key_column string, n_rows bigint, null_keys bigint, "
             "duplicate_keys bigint, duplicate_rows bigint")


def check_primary_keys(tables: dict[str, DataFrame], skip_missing: bool = False) -> DataFrame:
    """One row per table with a key; NULL counts for a table that was skipped."""
    _require(tables, PRIMARY_KEYS, skip_missing)
    parts = [primary_key_violations(tables[t], t, k) if t in tables else
             _spark(tables).createDataFrame([(t, k, None, None, None, None)], PK_SCHEMA)
             for t, k in PRIMARY_KEYS.items()]
    return reduce(DataFrame.unionByName, parts)


def enforce_primary_keys(tables: dict[str, DataFrame]) -> None:
    """Raise on a NULL or repeated key in any of the given tables."""
    bad = check_primary_keys(tables, skip_missing=True).where("null_keys > 0 or duplicate_keys > 0").collect()
    if bad:
        raise ValueError("primary key violated: " + "; ".join(
            f"{r['table_name']}.{r['key_column']}: {r['null_keys']} null, {r['duplicate_keys']} repeated" for r in bad))


def key_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per non-null key (partial aggregation folds hot keys map-side)."""
    return df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_rows"))


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str, unique_parent: bool = True) -> DataFrame:
    """Child rows whose non-null key has no parent row.

    A parent key that repeats (e.g. ``order_items.order_id``) is reduced to
    one row per key first, with the same per-key count a child check uses,
    so Spark can reuse one shuffle for both.
    """
    keys = (key_counts(parent, pk) if not unique_parent else parent).select(F.col(pk).alias(fk))
    return child.where(F.col(fk).isNotNull()).join(keys, fk, "left_anti")


def orphan_count(child: DataFrame, fk: str, parent: DataFrame, pk: str,
                 unique_parent: bool = True) -> DataFrame:
    """One row: the number of orphan child rows.

    Child rows are first counted per key (partial aggregation folds a hot
    key inside each map task), so the anti-join shuffles distinct keys, not
    rows, and no task receives a hot key's rows.
    """
    lost = orphans(key_counts(child, fk), fk, parent, pk, unique_parent)
    return lost.agg(F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint").alias("violations"))


EDGES = [*FOREIGN_KEYS, ("orders", "order_id", "order_items", "order_id")]


def check_foreign_keys(tables: dict[str, DataFrame], skip_missing: bool = False) -> DataFrame:
    """edge, violations: one row per documented relationship, plus
    ``orders.order_id -> order_items.order_id`` (every order has an item); NULL
    violations for an edge that was skipped."""
    _require(tables, {t for child, _, parent, _ in EDGES for t in (child, parent)}, skip_missing)
    parts = []
    for child, fk, parent, pk in EDGES:
        edge = f"{child}.{fk} -> {parent}.{pk}"
        if child in tables and parent in tables:
            unique = PRIMARY_KEYS.get(parent) == pk
            cnt = orphan_count(tables[child], fk, tables[parent], pk, unique)
            parts.append(cnt.select(F.lit(edge).alias("edge"), "violations"))
        else:
            parts.append(_spark(tables).createDataFrame([(edge, None)], "edge string, violations bigint"))
    return reduce(DataFrame.unionByName, parts)
