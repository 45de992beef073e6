"""Typed load and export of the six tables, catalog registration, previews
and row counts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sampling import referential_sample
from .schemas import PRIMARY_KEYS, SCHEMAS

TABLES = tuple(SCHEMAS)


def load_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """CSV with header and ',' under the declared schema; a bad value fails
    the read (FAILFAST), as a typed ``COPY`` does.

    Date-only text loads into TIMESTAMP columns, ``True``/``False`` into
    BOOLEAN, empty fields into NULL, and float noise in money columns is
    rounded to DECIMAL(10,2).
    """
    return (spark.read.schema(SCHEMAS[table])
            .option("header", True)
            .option("sep", ",")
            .option("mode", "FAILFAST")
            .option("enforceSchema", False)
            .csv(path))


def load_tables_csv(spark: SparkSession, directory: str, names: tuple[str, ...] = TABLES,
                    enforce: bool = False) -> dict[str, DataFrame]:
    """The tables in ``<directory>/<table>.csv``; an absent file is an error.
    With ``enforce`` a NULL or repeated primary key is one too."""
    out = {t: load_csv(spark, f"{directory.rstrip('/')}/{t}.csv", t) for t in names}
    if enforce:
        from ..operators.quality import enforce_primary_keys

        enforce_primary_keys(out)
    return out


def load_available_csv(spark: SparkSession, directory: str,
                       names: tuple[str, ...] = TABLES) -> tuple[dict[str, DataFrame], list[str]]:
    """The tables whose files are there, and the names of those that are not."""
    out, skipped = {}, []
    for t in names:
        try:
            out[t] = load_csv(spark, f"{directory.rstrip('/')}/{t}.csv", t)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            skipped.append(t)
    return out, skipped


def load_tables_parquet(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    out = {}
    for t in TABLES:
        df = spark.read.parquet(f"{directory.rstrip('/')}/{t}.parquet")
        out[t] = df.select([F.col(f.name).cast(f.dataType) for f in SCHEMAS[t].fields])
    return out


def write_tables(tables: dict[str, DataFrame], directory: str, fmt: str = "parquet",
                 mode: str = "overwrite") -> None:
    """Export every table (CSV with a header row, or Parquet)."""
    for name, df in tables.items():
        w = df.write.mode(mode)
        if fmt == "csv":
            w = w.option("header", True)
        w.format(fmt).save(f"{directory.rstrip('/')}/{name}.{fmt}")


def register_tables(tables: dict[str, DataFrame]) -> list[str]:
    """Temp views for ``spark.sql``; returns the names now in the catalog."""
    spark = None
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
        spark = df.sparkSession
    return sorted(t.name for t in spark.catalog.listTables()) if spark else []


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def table_preview(df: DataFrame, key: str | Sequence[str] | None = None, n: int = 5) -> DataFrame:
    """First ``n`` rows by key (a bounded top-k, repeatable across runs)."""
    keys = [key] if isinstance(key, str) else list(key or ())
    return df.orderBy(*keys).limit(n) if keys else df.limit(n)


def preview_all(tables: dict[str, DataFrame], n: int = 5) -> dict[str, DataFrame]:
    return {t: table_preview(df, PRIMARY_KEYS.get(t), n) for t, df in tables.items()}


def list_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n_columns, columns, primary_key) of the given tables, read from their schemas."""
    spark = next(iter(tables.values())).sparkSession
    rows = [(name, len(df.columns), ", ".join(df.columns), PRIMARY_KEYS.get(name)) for name, df in tables.items()]
    return spark.createDataFrame(rows, "table_name string, n_columns int, columns string, primary_key string")


def export_with_sample(tables: dict[str, DataFrame], directory: str, n: int = 500, seed: int = 42,
                       fmt: str = "csv", mode: str = "overwrite") -> dict[str, dict[str, DataFrame]]:
    """Write all tables to ``full`` and a referentially intact sample of ``n``
    customers to ``samples``, under ``directory``; returns both sets."""
    sample = referential_sample(tables, n, seed)
    for name, chosen in (("full", tables), ("samples", sample)):
        write_tables(chosen, f"{directory.rstrip('/')}/{name}", fmt, mode)
    return {"full": tables, "samples": sample}
