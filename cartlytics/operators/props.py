"""JSON columns: a schema merged from the data, typed columns, and key statistics.

The schema comes from one distributed aggregate that merges the types of all
documents; only its text reaches the driver.  Documents that are no JSON count
as missing; a value that does not fit its column's type is NULL.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_KEYS = 2_000
_NUMBER = "decimal(38,10)"


def _fields(inside: str) -> list[str]:
    """Parts of a schema's text between commas outside brackets and quotes."""
    parts, depth, quoted, start = [], 0, False, 0
    for i, c in enumerate(inside):
        if c == "`":
            quoted = not quoted
        elif not quoted:
            depth += (c in "<(") - (c in ">)")
            if c == "," and depth == 0:
                parts.append(inside[start:i])
                start = i + 1
    return [p.strip() for p in [*parts, inside[start:]] if p.strip()]


def json_schema(df: DataFrame, column: str, max_keys: int = MAX_KEYS) -> dict[str, str]:
    """{key: type} of the top-level keys of all objects in a JSON column.

    Keys of mixed kinds have the type ``VARIANT``; nested objects and arrays keep
    theirs.  A column without objects gives no keys; more than ``max_keys``
    different keys are an error (a map, then, not columns)."""
    merged = df.agg(F.schema_of_variant_agg(F.try_parse_json(column))).first()[0] or ""
    match = re.fullmatch(r"OBJECT<(.*)>", merged, re.DOTALL)
    fields = _fields(match[1]) if match else []
    if len(fields) > max_keys:
        raise ValueError(f"{len(fields)} keys in {column}, more than {max_keys}")
    out = {}
    for f in fields:
        name, kind = re.fullmatch(r"(`(?:[^`]|``)*`|[^:]+):\s*(.*)", f, re.DOTALL).groups()
        name = name[1:-1].replace("``", "`") if name.startswith("`") else name
        out[name] = kind.replace("OBJECT<", "STRUCT<")
    return out


def _path(key: str) -> str:
    quoted = key.replace("\\", "\\\\").replace('"', '\\"')
    return f'$["{quoted}"]'


def shredded(df: DataFrame, column: str, schema: Mapping[str, str], prefix: str = "") -> DataFrame:
    """``df`` with a typed column for every key of ``schema`` (its name behind
    ``prefix``) in place of the JSON column.  Names must not clash."""
    names = [prefix + k for k in schema]
    others = [c for c in df.columns if c != column]
    taken = {c.lower() for c in others}
    if len({n.lower() for n in names}) < len(names) or any(n.lower() in taken for n in names):
        raise ValueError("column names clash; give a prefix")
    parsed = F.try_parse_json(column)
    return df.select(*others, *[_typed(parsed, k, kind).alias(n) for (k, kind), n in zip(schema.items(), names, strict=True)])


def _typed(parsed: Column, key: str, kind: str) -> Column:
    return F.try_variant_get(parsed, _path(key), kind)


def key_statistics(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, key, rows, distinct_values, numbers, least, most, total) of the
    top-level keys of a JSON column read as a map; numbers are exact decimals.

    Key and value are the only things shuffled, and repeated values combine first."""
    pairs = df.select(*by, F.explode(F.from_json(column, "map<string,string>")).alias("key", "value"))
    values = pairs.groupBy(*by, "key", "value").agg(F.count(F.lit(1)).alias("rows"))
    number = F.col("value").try_cast(_NUMBER)
    return values.groupBy(*by, "key").agg(
        F.sum("rows").alias("rows"), F.count("value").alias("distinct_values"),
        F.coalesce(F.sum(F.when(number.isNotNull(), F.col("rows"))), F.lit(0)).alias("numbers"),
        F.min(number).alias("least"), F.max(number).alias("most"), F.sum((number * F.col("rows")).cast(_NUMBER)).alias("total"))
