"""Reading incident tables and writing reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators.prep import fit_time_format, time_reading
from riskframe.schema import ID, MISSING_TOKENS, REQUIRED, TIME


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Incident CSV with a header; every column arrives as text.

    No type inference: that would cost a second pass over all columns, and the cleaning step
    has to tolerate malformed values anyway.
    """
    df = spark.read.option("header", True).csv(path)
    return with_typed_id(
        df.select(*[F.when(~F.col(c).isin(MISSING_TOKENS), F.col(c)).alias(c) for c in df.columns])
    )


def with_typed_id(df: DataFrame) -> DataFrame:
    """A text id becomes a number if every id is one, so that 9 comes before 10; else it stays text.

    Takes one pass over the id column.
    """
    if dict(df.dtypes).get(ID) != "string":
        return df
    number = F.col(ID).try_cast("long")
    odd = df.where(F.col(ID).isNotNull() & number.isNull())
    return df.withColumn(ID, number) if odd.isEmpty() else df


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def with_time_column(df: DataFrame) -> DataFrame:
    """Use the first column whose name contains 'data' if the time column is missing.

    Text is read in the format that fits most of its values, which takes one pass over the column.
    """
    if TIME in df.columns:
        return df
    for name in df.columns:
        if "data" in name.lower():
            named = df.withColumn(TIME, F.col(name))
            return named.withColumn(TIME, time_reading(F.col(TIME), fit_time_format(named)))
    return df


def require_columns(df: DataFrame, columns: list[str] = REQUIRED) -> DataFrame:
    """Project to ``columns``; raise if any is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*columns)


def preview(df: DataFrame, key: str, rows: int = 5) -> DataFrame:
    """First rows by key, each with the shape of the whole frame."""
    shape = df.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    return (
        df.orderBy(key)
        .limit(rows)
        .withColumns({"n_rows": F.lit(shape).cast("long"), "n_columns": F.lit(len(df.columns)).cast("long")})
    )


def write_report(lines: DataFrame, path: str) -> None:
    """Write ordered report lines (``line_no``, ``text``) as one text file."""
    lines.orderBy("line_no").select("text").coalesce(1).write.mode("overwrite").text(path)
