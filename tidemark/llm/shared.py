"""What the operators of this subpackage share: written intermediate tables and joins with a checked side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.storage import materialize  # noqa: F401

#: Rows up to which a narrow side (a few numbers or a short key a row) is broadcast; beyond, joins shuffle.
BROADCAST_ROWS = 200_000
#: Parts that a key's rows are dealt to where a narrow side is too large to broadcast.
SALTS = 32

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def checked_broadcast(side: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A hint to broadcast `side`, a narrow materialized table, if it has at most max_rows rows; else Spark shuffles it."""
    return F.broadcast(side) if side.limit(max_rows + 1).count() <= max_rows else side


def join_narrow(big: DataFrame, side: DataFrame, on: list[str], how: str = "inner", spread: Column | None = None, rows: int | None = None) -> DataFrame:
    """big joined (inner or left) with a narrow materialized side of few or many rows.

    Up to BROADCAST_ROWS rows (they are counted unless `rows` says how many there are) the side is broadcast. Beyond, both are dealt by key and salt: rows of
    big by a salt of `spread`, the side in a copy for each salt, so that a key which a third of big has goes to SALTS tasks.
    """
    if (side.limit(BROADCAST_ROWS + 1).count() if rows is None else rows) <= BROADCAST_ROWS:
        return big.join(F.broadcast(side), on, how)
    salt = F.pmod(F.xxhash64(F.lit("salt"), F.xxhash64(*on) if spread is None else spread), F.lit(SALTS)).cast("int")
    copies = side.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return big.withColumn("_salt", salt).join(copies, [*on, "_salt"], how).drop("_salt")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; every other character stays."""
    return F.translate(text, UPPER, LOWER)


def packed(df: DataFrame, **named: str) -> DataFrame:
    """df as one struct column `row`, so that no extra column can clash, beside the columns named: new name -> column of df."""
    return df.select(F.struct(*[df[c] for c in df.columns]).alias("row"), *[df[c].alias(n) for n, c in named.items()])


def fields(df: DataFrame, names: list[str], more: str) -> T.StructType:
    """The columns `names` of df as they are, then the fields of a DDL string: whatever the names and types are."""
    return T.StructType([df.schema[n] for n in names] + T.StructType.fromDDL(more).fields)
