"""Projection operators: casts, defaults, nested <-> flat, one row per list item."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def cast_columns(df: DataFrame, kinds: Mapping[str, str]) -> tuple[DataFrame, list[str]]:
    """Cast the named columns that exist; also return the names that do not."""
    present = {name: F.col(name).try_cast(kind) for name, kind in kinds.items() if name in df.columns}
    return df.withColumns(present), [name for name in kinds if name not in df.columns]


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of `schema`, by name, in its order and types; absent columns become NULL."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def one_row_per_item(df: DataFrame, columns: list[str], keep_empty: bool = False) -> DataFrame:
    """First normal form: each list column in turn becomes one row per item.

    Rows with an empty list disappear unless keep_empty is set.
    """
    explode = F.explode_outer if keep_empty else F.explode
    for name in columns:
        df = df.withColumn(name, explode(name))
    return df


def measure(value: Column, unit: Column) -> Column:
    return F.struct(value.cast("double").alias("value"), unit.cast("string").alias("unit"))


def flatten_earnings(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Nested earning records -> one flat column per leaf, then the columns of `keep`."""
    leaves = {
        "company_name": "company.name",
        "symbol": "company.symbol",
        "country": "country",
        "year": "year",
        "quarter": "quarter",
    }
    for name in ("eps", "revenue"):
        for side in ("actual", "forecast"):
            for leaf in ("value", "unit"):
                leaves[f"{name}_{side}_{leaf}"] = f"{name}.{side}.{leaf}"
    leaves |= {f"market_cap_{leaf}": f"market_cap.{leaf}" for leaf in ("value", "unit")}
    leaves |= {"call_date": "call_date", "timezone": "timezone"}
    return df.select(*[F.col(path).alias(name) for name, path in leaves.items()], *keep)


def nest_earnings(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Flat earning columns -> nested records; the inverse of flatten_earnings."""

    def pair(name: str) -> Column:
        return F.struct(
            *[
                measure(F.col(f"{name}_{side}_value"), F.col(f"{name}_{side}_unit")).alias(side)
                for side in ("actual", "forecast")
            ]
        )

    return df.select(
        F.struct(F.col("company_name").alias("name"), F.col("symbol")).alias("company"),
        "country",
        pair("eps").alias("eps"),
        pair("revenue").alias("revenue"),
        measure(F.col("market_cap_value"), F.col("market_cap_unit")).alias("market_cap"),
        F.col("year").cast("int").alias("year"),
        F.col("quarter").cast("int").alias("quarter"),
        F.col("call_date").cast("bigint").alias("call_date"),
        "timezone",
        *keep,
    )
