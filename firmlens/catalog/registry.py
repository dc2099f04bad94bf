"""Named queries over a folder of tables, each with the text of the same query where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL_TEXTS: dict[str, str] = {}

DIGITS = 6

# Output forms: as it is, rounded double, day as text, whole number, plain double, text.
_SPARK_FORMS = {
    "": lambda c: F.col(c),
    "r": lambda c: F.round(F.col(c).cast("double"), DIGITS).alias(c),
    "d": lambda c: F.date_format(F.col(c), "yyyy-MM-dd").alias(c),
    "i": lambda c: F.col(c).cast("long").alias(c),
    "f": lambda c: F.col(c).cast("double").alias(c),
    "s": lambda c: F.col(c).cast("string").alias(c),
}
_SQL_FORMS = {
    "": '"{0}"',
    "r": 'round(CAST("{0}" AS DOUBLE), %d) AS "{0}"' % DIGITS,
    "d": 'strftime("{0}", \'%Y-%m-%d\') AS "{0}"',
    "i": 'CAST("{0}" AS BIGINT) AS "{0}"',
    "f": 'CAST("{0}" AS DOUBLE) AS "{0}"',
    "s": 'CAST("{0}" AS VARCHAR) AS "{0}"',
}


def query(name: str, columns: str, sql: str | None = None):
    """Registers a query. ``columns`` lists the output as ``name`` or ``name:form``."""
    forms = [(c.split(":") + [""])[:2] for c in columns.split()]

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(spark, folder).select(*[_SPARK_FORMS[form](c) for c, form in forms])

        run.__name__ = name
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            picked = ", ".join(_SQL_FORMS[form].format(c) for c, form in forms)
            SQL_TEXTS[name] = f"SELECT {picked} FROM (\n{sql.strip()}\n) AS result"
        return fn

    return register
