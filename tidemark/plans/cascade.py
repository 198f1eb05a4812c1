"""Accounting: every unit is kept, or dropped for exactly one reason, the first that applies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_reason(tests: list[tuple[str, Column]]) -> Column:
    """The name of the first test that holds; null: kept. A test that is null does not hold."""
    return F.coalesce(*[F.when(test, F.lit(name)) for name, test in tests])


def reconcile(df: DataFrame, reason: str = "drop_reason", kept: str = "kept", units: DataFrame | None = None) -> DataFrame:
    """Units by outcome, with the number of all units beside each, counted in `units`, the rows before they were given reasons: if an operator on the way lost or doubled some, the parts don't add up to it."""
    by = df.groupBy(F.coalesce(F.col(reason), F.lit(kept)).alias("outcome")).agg(F.count("*").alias("n"))
    total = (df if units is None else units).agg(F.count("*").alias("considered"))  # one row
    return by.join(F.broadcast(total))


def require_reconciled(report: DataFrame) -> None:
    """Raises unless the outcomes add up to what was considered."""
    row = report.agg(F.sum("n").alias("n"), F.max("considered").alias("considered")).first()
    if row.n != row.considered:
        raise ValueError(f"{row.considered} units were considered, but {row.n} are accounted for")
