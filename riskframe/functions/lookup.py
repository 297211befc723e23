"""Join a large frame to a table on shared keys, safe against hot keys on either side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StringType

BROADCAST_ROWS = 50_000
BROADCAST_BYTES = 16 << 20
HOT_SHARE = 0.002
SMALL_ROWS = 1_000_000
SALTS = 64


def lookup_join(
    df: DataFrame,
    table: DataFrame,
    keys: list[str],
    how: str = "left",
    spread_by: str | None = None,
    max_rows: int | None = None,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Attach ``table`` to ``df`` (inner or left join on ``keys``).

    Rows and bytes of the table are counted (up to one row beyond ``max_rows``, and without
    sending any to the driver).  Within both bounds it is broadcast; a larger table goes
    through ``spread_join``.  The table should be cheap to read, as it is read twice.
    """
    max_rows = BROADCAST_ROWS if max_rows is None else max_rows
    size = table.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(_row_bytes(table))).first()
    if size[0] <= max_rows and (size[1] or 0) <= max_bytes:
        return df.join(F.broadcast(table), keys, how)
    return spread_join(df, table, keys, how, spread_by)


def _row_bytes(table: DataFrame) -> Column:
    """About the bytes of a row: 16 for each column, and the content of texts and arrays."""
    total = F.lit(16 * len(table.columns)).cast("long")
    for field in table.schema:
        if isinstance(field.dataType, (StringType, BinaryType)):
            total = total + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif isinstance(field.dataType, ArrayType):
            total = total + 16 * F.greatest(F.size(field.name), F.lit(0))
    return total


def spread_join(
    df: DataFrame,
    table: DataFrame,
    keys: list[str],
    how: str = "left",
    spread_by: str | None = None,
    hot_share: float = HOT_SHARE,
    salts: int = SALTS,
) -> DataFrame:
    """Shuffle join in which hot keys are split over ``salts`` tasks.

    Keys with more than ``hot_share`` of the rows of a side are hot; a frequent-items
    sketch finds them in one pass.  The side where a key is hot is split, and only the other side's rows
    of that key are copied once per salt.  A left join splits its left side alone, as
    copies of left rows would not stay one row.  The sketch decides how the work is
    spread, never the result.  ``keys`` must have the same types on both sides.
    """
    left_hot = _hot_keys(df, keys, hot_share)
    right_hot = [h for h in _hot_keys(table, keys, hot_share) if h not in set(left_hot)] if how == "inner" else []
    if not left_hot and not right_hot:
        return df.join(table, keys, how)
    hashed = F.xxhash64(*keys)
    in_left, in_right = _among(hashed, left_hot), _among(hashed, right_hot)

    def salt(columns: list[str]) -> Column:
        return F.pmod(F.xxhash64(F.struct(*columns)), F.lit(salts)).cast("int")

    def salted(side: DataFrame, split: Column, copied: Column, columns: list[str]) -> DataFrame:
        places = (
            F.when(split, F.array(salt(columns)))
            .when(copied, F.sequence(F.lit(0), F.lit(salts - 1)))
            .otherwise(F.array(F.lit(0)))
        )
        return side.withColumn("_salt", F.explode(places))

    left = salted(df, in_left, in_right, [spread_by] if spread_by else df.columns)
    right = salted(table, in_right, in_left, table.columns)
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def _among(hashed: Column, values: list[int]) -> Column:
    return hashed.isin(values) if values else F.lit(False)


def _hot_keys(df: DataFrame, keys: list[str], hot_share: float) -> list[int]:
    """Hashes of at most 1 / hot_share keys; none if the frame is small anyway."""
    most = int(1 / hot_share)
    row = (
        df.select(F.xxhash64(*keys).alias("h"))
        .agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(h, {most}, {4 * most})").alias("top"))
        .first()
    )
    if row["n"] < SMALL_ROWS:
        return []
    return [item["item"] for item in row["top"] if item["count"] >= hot_share * row["n"]]
