"""Column names of delivered datasets and exact-case column helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Names every delivered dataset carries.
TENANT = "idEmpresa"
TENANT_COPY = "idEmp"
REFRESHED_AT = "DataHoraAtualizacao"
YEAR = "Ano"
MONTH = "Mes"
PARTITION_KEYS = (TENANT, YEAR, MONTH)


def quoted(name: str) -> Column:
    """Reference a column by its literal name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def reject_case_clash(spark: SparkSession, names: Sequence[str]) -> None:
    """Names that differ only by case need a case-sensitive session.

    The setting is the caller's: switching it on here would change how the
    source queries resolve their own columns.
    """
    if spark.conf.get("spark.sql.caseSensitive") == "true":
        return
    first: dict[str, str] = {}
    for name in names:
        other = first.setdefault(name.lower(), name)
        if other != name:
            raise ValueError(f"columns {other} and {name} differ only by case; set spark.sql.caseSensitive=true")


def put_columns(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    """Set columns by exact name: replace in place, append what is missing.

    ``withColumns`` follows ``spark.sql.caseSensitive`` and would replace ``a``
    when asked for ``A``; column names of a dataset are always case-exact.
    """
    appended = [name for name in new if name not in df.columns]
    reject_case_clash(df.sparkSession, [*df.columns, *appended])
    kept = [new[n].alias(n) if n in new else quoted(n) for n in df.columns]
    return df.select(*kept, *[new[n].alias(n) for n in appended])
