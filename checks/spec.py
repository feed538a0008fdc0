"""A registered query: the Spark job, its oracle SQL and the compared columns."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from .tables import Tables

_SPARK = {"s": "string", "i": "bigint", "t": "date", "b": "boolean"}
_SQL = {"s": "VARCHAR", "i": "BIGINT", "t": "DATE", "b": "BOOLEAN"}
# rounding of compared figures: decimals kept, and a nudge that moves exact ties off the edge
DIGITS, NUDGE = 4, 1e-9


def parse(out: str) -> list[tuple[str, str]]:
    return [tuple(part.rsplit(":", 1)) for part in out.split()]


def present(df: DataFrame, out: str) -> DataFrame:
    """Columns of ``out`` in comparable types."""
    cols = []
    for name, kind in parse(out):
        c = F.col(name)
        c = F.round(c.cast("double") + NUDGE, DIGITS) if kind == "d" else c.cast(_SPARK[kind])
        cols.append(c.alias(name))
    return df.select(*cols)


def present_sql(sql: str, out: str) -> str:
    cols = []
    for name, kind in parse(out):
        if kind == "d":
            x = f"CAST({name} AS DOUBLE)"
            tiny = 0.5 * 10 ** -DIGITS
            cols.append(
                f"CASE WHEN ABS({x} + {NUDGE}) < {tiny} THEN 0.0::DOUBLE ELSE ROUND({x} + {NUDGE}, {DIGITS}) END AS {name}"
            )
        else:
            cols.append(f"CAST({name} AS {_SQL[kind]}) AS {name}")
    return f"SELECT {', '.join(cols)} FROM ({sql}) AS result_rows"


@dataclass(frozen=True)
class Query:
    job: Callable[[Tables], DataFrame]
    out: str
    sql: str | None = None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(self.job(Tables(spark, sf_dir)), self.out)

    def oracle(self) -> str | None:
        return present_sql(self.sql, self.out) if self.sql else None


REGISTRY: dict[str, Query] = {}


def register(name: str, out: str, sql: str | None = None):
    def add(job):
        REGISTRY[name] = Query(job, " ".join(out.split()), sql)
        return job

    return add
