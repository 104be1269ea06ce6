"""Registration of queries, and one rounding rule for both engines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Compared doubles are cut to so many parts of one: sums of doubles depend on their order beyond them.
SCALE = 1e9


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracles: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None, doubles: str = ""):
        """``doubles``: the columns that SQL must cut as ``settled`` does."""

        def put(f: Callable[[SparkSession, str], DataFrame]):
            self.queries[name] = lambda spark, sf_dir: settled(f(spark, sf_dir))
            if sql:
                self.oracles[name] = settled_sql(sql, doubles.split())
            return f

        return put


def settled(df: DataFrame) -> DataFrame:
    """Integers as long, doubles cut to SCALE."""
    out = []
    for c, kind in df.dtypes:
        x = F.col(f"`{c}`")
        if kind in ("int", "smallint", "tinyint"):
            x = x.cast("long")
        elif kind in ("double", "float"):
            x = F.floor(x.cast("double") * SCALE + 0.5).cast("double") / SCALE
        out.append(x.alias(c))
    return df.select(*out)


def settled_sql(sql: str, doubles: list[str]) -> str:
    if not doubles:
        return sql.strip()
    cut = ", ".join(f"floor(CAST({c} AS DOUBLE) * 1e9 + 0.5) / 1e9 AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({cut}) FROM ({sql.strip()})"
