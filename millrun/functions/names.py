"""Column-name mapping (rule rows read over JDBC arrive in snake_case)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_camel(name: str) -> str:
    """``sink_table`` -> ``sinkTable``; names without underscores stay."""
    head, *rest = name.split("_")
    return head + "".join(p[:1].upper() + p[1:] for p in rest if p)


def to_snake(name: str) -> str:
    """``sinkTable`` -> ``sink_table``."""
    out = []
    for ch in name:
        if ch.isupper():
            out.append("_" + ch.lower())
        else:
            out.append(ch)
    return "".join(out).lstrip("_")


def rename_columns(df: DataFrame, camel: bool = True) -> DataFrame:
    """One projection renaming every column (a no-op for the data)."""
    f = to_camel if camel else to_snake
    return df.select(*[F.col(c).alias(f(c)) for c in df.columns])
