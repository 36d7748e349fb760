"""Reading a CSV star whose files have bad rows: good ones by type, bad ones with the reason.

Every column is read as text and cast by the schema. A row goes to the rejects, once for
each problem, if a value does not fit its column's type, if a column that must be filled is
empty, or if it has not as many fields as the header. All other rows are the tables. Both
come from the same rule, so every row of a file is in exactly one of them.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadstar import schema
from loadstar.star import Star

_RECORD = "_record"
WRONG_FIELDS = "wrong number of fields"
MISSING = "missing"


def _cast(field: T.StructField) -> Column:
    return F.col(field.name).try_cast(field.dataType)


def _reason(field: T.StructField) -> Column:
    """What is wrong with a value, NULL if nothing is."""
    value = F.col(field.name)
    reason = F.when(
        value.isNotNull() & _cast(field).isNull(), F.lit(f"not a {field.dataType.simpleString()}")
    )
    return reason if field.nullable else F.when(value.isNull(), F.lit(MISSING)).otherwise(reason)


def _raw(spark: SparkSession, path: str, layout: T.StructType) -> DataFrame:
    names = [*layout.fieldNames(), _RECORD]
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return (
        spark.read.schema(text)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _RECORD)
        .option("enforceSchema", False)
        .csv(path)
    )


def _good(layout: T.StructType) -> Column:
    return reduce(Column.__and__, [F.col(_RECORD).isNull(), *(_reason(f).isNull() for f in layout)])


def _problems(raw: DataFrame, name: str, layout: T.StructType) -> DataFrame:
    """``table_name, column_name, value, reason`` of every problem of the bad rows."""

    def problem(column: str, value: Column, reason: Column) -> Column:
        return F.struct(F.lit(column).alias("column_name"), value.alias("value"), reason.alias("reason"))

    fields = F.col(_RECORD).isNotNull()
    # the other columns of a row that is cut wrongly are not what they seem
    single = [F.when(~fields, _reason(f)) for f in layout]
    found = [problem("*", F.col(_RECORD), F.when(fields, F.lit(WRONG_FIELDS)))]
    found += [problem(f.name, F.col(f.name), r) for f, r in zip(layout, single, strict=True)]
    real = F.filter(F.array(*found), lambda p: p["reason"].isNotNull())
    bad = raw.where(~_good(layout))
    return bad.select(F.lit(name).alias("table_name"), F.inline(real))


@dataclass(frozen=True)
class SortedOut:
    """The star of the good rows, the problems of the others, and how many of each there are."""

    star: Star
    rejects: DataFrame
    totals: DataFrame


def read_csv_sorted(spark: SparkSession, path: str) -> SortedOut:
    """Six ``<table>.csv`` files (or folders) with a header, bad rows set aside."""
    tables, rejects, totals = {}, [], []
    for name, layout in schema.TABLES.items():
        raw = _raw(spark, f"{path}/{name}.csv", layout)
        good = _good(layout)
        tables[name] = raw.where(good).select(*[_cast(f).alias(f.name) for f in layout])
        rejects.append(_problems(raw, name, layout))
        totals.append(
            raw.agg(
                F.count(F.lit(1)).alias("rows_read"),
                F.count_if(good).alias("rows_kept"),
                F.count_if(~good).alias("rows_rejected"),
            ).select(F.lit(name).alias("table_name"), "*")
        )
    star = Star(
        fact=tables["fact_shipment"],
        carrier=tables["dim_carrier"],
        lane=tables["dim_lane"],
        shipper=tables["dim_shipper"],
        date=tables["dim_date"],
        service=tables["dim_service_type"],
    )
    return SortedOut(star, reduce(DataFrame.unionByName, rejects), reduce(DataFrame.unionByName, totals))
