"""Reading, writing and registering a star."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadstar import schema
from loadstar.star import Star


def _star(tables: dict[str, DataFrame]) -> Star:
    return Star(
        fact=tables["fact_shipment"],
        carrier=tables["dim_carrier"],
        lane=tables["dim_lane"],
        shipper=tables["dim_shipper"],
        date=tables["dim_date"],
        service=tables["dim_service_type"],
    )


def read_csv_star(spark: SparkSession, path: str, *, validate: bool = False) -> Star:
    """Six ``<table>.csv`` files (or folders) with a header, typed by the schema.

    Nothing is inferred: zip codes keep their leading zeros, money stays exact,
    and a row that does not fit the schema fails the read.
    """
    star = _star(
        {
            name: spark.read.schema(layout)
            .option("header", True)
            .option("mode", "FAILFAST")
            .option("enforceSchema", False)
            .csv(f"{path}/{name}.csv")
            for name, layout in schema.TABLES.items()
        }
    )
    return _checked(star) if validate else star


def read_star(spark: SparkSession, path: str, *, validate: bool = False) -> Star:
    """A star written by :func:`write_star`; no file is opened to learn its layout."""
    layouts = {
        **schema.TABLES,
        "fact_shipment": T.StructType(
            [*schema.FACT.fields, T.StructField("ship_month", T.IntegerType())]
        ),
    }
    star = _star(
        {
            name: spark.read.schema(layout).parquet(f"{path}/{name}")
            for name, layout in layouts.items()
        }
    )
    return _checked(star) if validate else star


def _checked(star: Star) -> Star:
    """Run the blocking data checks and refuse a star that fails one."""
    from loadstar.operators.quality import blocking_checks

    failed = [r["check_name"] for r in blocking_checks(star).where(~F.col("passed")).collect()]
    if failed:
        raise ValueError(f"star failed its checks: {', '.join(sorted(failed))}")
    return star


def write_star(star: Star, path: str) -> None:
    """Write the star as Parquet, dimensions first, the fact one folder per month.

    A fact that already carries ``ship_month`` is taken as laid out; any other is
    rebalanced, so that a heavy month is split over many tasks, light ones are
    merged and file sizes stay even under skew.
    """
    for name, table in star.tables().items():
        if name == "fact_shipment":
            continue
        table.write.mode("errorifexists").parquet(f"{path}/{name}")
    fact = star.fact
    if "ship_month" not in fact.columns:
        month = F.expr("CAST(shipment_date_key div 100 AS INT)")
        fact = fact.withColumn("ship_month", month).hint(
            "rebalance", F.col("ship_month")
        )
    fact.write.mode("errorifexists").partitionBy("ship_month").parquet(
        f"{path}/fact_shipment"
    )


def write_csv(table: DataFrame, path: str) -> None:
    """A folder of CSV parts with headers."""
    table.write.mode("errorifexists").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, layout: T.StructType) -> DataFrame:
    """A table written by ``write_csv``, with its column types.

    Quoted empty strings come back as such; they are read as a mark first, since
    Spark's reader takes both them and missing values for NULL.
    """
    mark = "\x01"
    table = spark.read.schema(layout).option("header", True).option("emptyValue", mark).csv(path)
    text = [f.name for f in layout if isinstance(f.dataType, T.StringType)]
    return table.withColumns({c: F.when(F.col(c) == mark, "").otherwise(F.col(c)) for c in text})


def register_views(star: Star) -> None:
    """Make the six tables and the six views visible to ``spark.sql``."""
    from loadstar.operators import views

    for name, table in {**star.tables(), **views.all_views(star)}.items():
        table.createOrReplaceTempView(name)


def row_counts(star: Star) -> DataFrame:
    """Rows per table, one row each."""
    counts = [
        table.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, table in star.tables().items()
    ]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result
