"""A warehouse that grows by whole ship days, with stored KPI parts per month.

Months are written once, under a version of their own, and never touched again. A
snapshot lists for every table which version of which month belongs to it; it becomes
visible when its rows are committed to the manifest, as the last step of a load. Until
then, and after a load that fails halfway, readers see the snapshot before. A load
replaces the days it brings: months with other rows for these days get a new version made
of their other days and the new rows, all other months keep theirs. Days that the
warehouse already holds row for row change nothing, so a load can be run again.

Beside the fact every month has the parts of the KPI tables (sums, counts, quantile and
distinct-count sketches) per day, carrier, lane, shipper and service. A load gathers them
for the months it wrote; KPI tables then merge the parts of all months and do not read the
fact at all.

While a month is written its rows are also counted for the blocking and informative
checks, by an observation of the same pass; the results are kept with the snapshot.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadstar import schema
from loadstar.functions.measures import gather, parts_of
from loadstar.star import Star

#: Grains at which parts are kept, and the KPIs they serve.
_BASIC = [
    "shipment_count",
    "otp_rate",
    "otd_rate",
    "avg_dwell",
    "defect_rate",
    "avg_utilization",
    "avg_cost",
    "cpm",
    "total_cost",
]
GRAINS: dict[tuple[str, ...], list[str]] = {
    ("shipment_date_key",): [*_BASIC, "active_carriers", "active_lanes", "active_shippers"],
    ("carrier_id", "dwell_minutes"): _BASIC,
    ("carrier_id",): [*_BASIC, "dwell_kll"],
    ("lane_id",): [*_BASIC, "dwell_kll"],
    ("shipper_id",): [*_BASIC, "cost_per_pallet", "accessorial_share"],
    ("service_type_id",): [*_BASIC, "util_kll"],
}

_MANIFEST = T.StructType(
    [
        T.StructField("snapshot", T.LongType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("ship_month", T.IntegerType()),
        T.StructField("version", T.StringType()),
    ]
)
_CHECKS = T.StructType(
    [
        T.StructField("snapshot", T.LongType()),
        T.StructField("check_name", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("passed", T.BooleanType()),
    ]
)
_FACT = "fact_shipment"


def _month() -> Column:
    return F.expr("CAST(shipment_date_key div 100 AS INT)")


def _day_marks(fact: DataFrame) -> DataFrame:
    """Rows of each day and a checksum that does not depend on their order."""
    columns = [F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in schema.FACT.fieldNames()]
    mark = F.xxhash64(*columns)
    return fact.groupBy("shipment_date_key").agg(
        F.count(F.lit(1)).alias("rows"),
        F.bit_xor(mark).alias("mark"),
        F.sum(F.pmod(mark, F.lit(1 << 31))).alias("sum"),
    )


def _observed() -> dict[str, Column]:
    """Row-level checks as aggregates that ride along with a write."""
    parts = F.col("linehaul_cost_usd") + F.col("fuel_surcharge_usd") + F.col("accessorial_cost_usd")
    required = [f.name for f in schema.FACT.fields if not f.nullable]
    return {
        "row_count": F.count(F.lit(1)),
        "cost_identity": F.count_if(parts != F.col("total_cost_usd")),
        "null_pickup": F.count_if(F.col("pickup_actual_ts").isNull()),
        "negative_dwell": F.count_if(F.col("dwell_minutes") < 0),
        **{f"not_null_{c}": F.count_if(F.col(c).isNull()) for c in required},
    }


_INFORMATIVE = {"row_count", "null_pickup", "negative_dwell"}


def _grain_name(grain: tuple[str, ...]) -> str:
    return "parts_" + "_".join(grain)


@dataclass(frozen=True)
class Warehouse:
    """The tables below ``path``; every method sees the newest committed snapshot."""

    spark: SparkSession
    path: str

    def _committed(self, name: str, layout: T.StructType) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(path):
            return self.spark.createDataFrame([], layout)
        return self.spark.read.schema(layout).parquet(f"{self.path}/{name}")

    def snapshot(self) -> int:
        """Number of the newest snapshot, 0 before the first load."""
        newest = self._committed("manifest", _MANIFEST).agg(F.max("snapshot")).first()[0]
        return newest or 0

    def manifest(self, snapshot: int | None = None) -> DataFrame:
        """``table_name, ship_month, version`` of a snapshot, by default the newest."""
        number = self.snapshot() if snapshot is None else snapshot
        return self._committed("manifest", _MANIFEST).where(F.col("snapshot") == number).drop("snapshot")

    def checks(self) -> DataFrame:
        """``snapshot, check_name, value, passed`` as observed by each load."""
        return self._committed("checks", _CHECKS)

    def _read(self, name: str, layout: T.StructType, versions: list) -> DataFrame:
        """The listed months of a table; only their folders are looked at."""
        base = f"{self.path}/{name}"
        layout = T.StructType([*layout.fields, T.StructField("version", T.StringType()), T.StructField("ship_month", T.IntegerType())])
        paths = [f"{base}/version={v.version}/ship_month={v.ship_month}" for v in versions]
        if not paths:
            return self.spark.createDataFrame([], layout).drop("version")
        return self.spark.read.option("basePath", base).schema(layout).parquet(*paths).drop("version")

    def star(self, snapshot: int | None = None) -> Star:
        """The star of a snapshot with its stored parts."""
        by_table: dict[str, list] = {}
        for row in self.manifest(snapshot).collect():
            by_table.setdefault(row.table_name, []).append(row)
        if not by_table:
            raise ValueError(f"nothing has been loaded into {self.path}")
        tables = {}
        for name, layout in schema.TABLES.items():
            if name != _FACT:
                version = by_table[name][0].version
                tables[name] = self.spark.read.schema(layout).parquet(f"{self.path}/{name}/version={version}")
        parts = {}
        for grain, kpis in GRAINS.items():
            empty = gather(self.spark.createDataFrame([], schema.FACT), grain, kpis)
            parts[grain] = self._read(_grain_name(grain), empty.schema, by_table.get(_grain_name(grain), []))
        return Star(
            fact=self._read(_FACT, schema.FACT, by_table.get(_FACT, [])),
            carrier=tables["dim_carrier"],
            lane=tables["dim_lane"],
            shipper=tables["dim_shipper"],
            date=tables["dim_date"],
            service=tables["dim_service_type"],
            parts=parts,
        )

    def load(self, fact: DataFrame, dimensions: Star | None = None) -> int:
        """Replace the ship days of ``fact``; returns the snapshot that now holds.

        ``dimensions`` replaces the five dimension tables; the first load needs it.
        """
        before = self.snapshot()
        if not before and dimensions is None:
            raise ValueError("the first load needs the dimensions")
        fact = fact.select(*schema.FACT.fieldNames())
        days = self._changed_days(fact, before)
        if not days and dimensions is None:
            return before
        number = before + 1
        version = f"{number:06d}-{uuid.uuid4().hex[:8]}"
        listed = {(r.table_name, r.ship_month): r.version for r in self.manifest(before).collect()}
        if dimensions is not None:
            for name, table in dimensions.tables().items():
                if name != _FACT:
                    table.select(*schema.TABLES[name].fieldNames()).write.parquet(f"{self.path}/{name}/version={version}")
                    listed[name, None] = version
        checks = []
        months = sorted({d // 100 for d in days})
        if days:
            checks = self._write_months(fact, days, months, before, version)
            listed |= {(name, m): version for name in (_FACT, *map(_grain_name, GRAINS)) for m in months}
        rows = [(number, name, month, v) for (name, month), v in listed.items()]
        if checks:
            found = self.spark.createDataFrame([(number, *c) for c in checks], _CHECKS)
            found.coalesce(1).write.mode("append").parquet(f"{self.path}/checks")
        # the commit: one file, so a reader sees all of the snapshot or nothing
        self.spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")
        return number

    def _changed_days(self, fact: DataFrame, snapshot: int) -> list[int]:
        """Days of ``fact`` whose rows differ from the warehouse's; one row a day is collected."""
        new = {r.shipment_date_key: r for r in _day_marks(fact).collect()}
        if None in new:
            raise ValueError("some shipments have no ship day")
        if not new or not snapshot:
            return sorted(new)
        old = self.star(snapshot).fact
        old = old.where(F.col("ship_month").isin(sorted({d // 100 for d in new})))
        kept = {r.shipment_date_key: r for r in _day_marks(old).collect()}
        return sorted(d for d in new if kept.get(d) != new[d])

    def _write_months(self, fact: DataFrame, days: list[int], months: list[int], snapshot: int, version: str) -> list[tuple]:
        """Write the months that ``days`` touch and their parts; returns the observed checks."""
        rows = fact.where(F.col("shipment_date_key").isin(days)).withColumn("ship_month", _month())
        if snapshot:
            old = self.star(snapshot).fact.where(F.col("ship_month").isin(months))
            rows = rows.unionByName(old.where(~F.col("shipment_date_key").isin(days)))
        seen = Observation()
        measures = _observed()
        counted = rows.observe(seen, *[m.alias(n) for n, m in measures.items()])
        laid_out = counted.hint("rebalance", F.col("ship_month"))
        laid_out.write.partitionBy("ship_month").parquet(f"{self.path}/{_FACT}/version={version}")
        written = self._read(_FACT, schema.FACT, [T.Row(ship_month=m, version=version) for m in months])
        for grain, kpis in GRAINS.items():
            parts = gather(written, [*grain, "ship_month"], parts_of(kpis))
            parts.write.partitionBy("ship_month").parquet(f"{self.path}/{_grain_name(grain)}/version={version}")
        values = seen.get
        return [(n, float(values[n]), n in _INFORMATIVE or values[n] == 0) for n in measures]


def refreshed(star: Star, late: int, path: str) -> Star:
    """The star as a warehouse holds it that was loaded without day ``late`` and got it later."""
    warehouse = Warehouse(star.fact.sparkSession, path)
    on_day = F.col("shipment_date_key") == late
    warehouse.load(star.fact.where(~on_day), replace(star, parts={}))
    warehouse.load(star.fact.where(on_day))
    return warehouse.star()
