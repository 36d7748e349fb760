"""The shipment star: one fact and five dimensions."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def date_key(day: date) -> int:
    """YYYYMMDD of ``day``; keys sort like the dates they stand for."""
    return day.year * 10000 + day.month * 100 + day.day


@dataclass(frozen=True)
class Star:
    """Six DataFrames. The fact may carry an extra ``ship_month`` partition column.

    ``parts`` holds KPI parts that were gathered from the whole fact before, by grain.
    """

    fact: DataFrame
    carrier: DataFrame
    lane: DataFrame
    shipper: DataFrame
    date: DataFrame
    service: DataFrame
    parts: Mapping[tuple[str, ...], DataFrame] = field(default_factory=dict)

    def tables(self) -> dict[str, DataFrame]:
        return {
            "dim_carrier": self.carrier,
            "dim_lane": self.lane,
            "dim_shipper": self.shipper,
            "dim_date": self.date,
            "dim_service_type": self.service,
            "fact_shipment": self.fact,
        }

    def resolve_as_of(self, as_of: date | None) -> date:
        """``as_of`` itself, or the last shipment day (one aggregated row)."""
        if as_of is not None:
            return as_of
        key = self.fact.agg(F.max("shipment_date_key")).first()[0]
        if key is None:
            raise ValueError("as_of is needed: the fact holds no shipments")
        return date(key // 10000, key // 100 % 100, key % 100)

    def between(self, first: date | None = None, before: date | None = None) -> DataFrame:
        """Fact rows with ``first <= ship date < before``.

        The bounds are literals on the integer date key, so they reach the
        Parquet scan; on a fact partitioned by month they also prune folders.
        """
        fact, partitioned = self.fact, "ship_month" in self.fact.columns
        if first is not None:
            fact = fact.where(F.col("shipment_date_key") >= date_key(first))
            if partitioned:
                fact = fact.where(F.col("ship_month") >= date_key(first) // 100)
        if before is not None:
            fact = fact.where(F.col("shipment_date_key") < date_key(before))
            if partitioned:
                fact = fact.where(F.col("ship_month") <= date_key(before) // 100)
        return fact

    def last_days(self, as_of: date, days: int) -> DataFrame:
        """Shipments of the ``days`` days up to ``as_of`` and of that day itself."""
        return self.between(as_of - timedelta(days=days), as_of + timedelta(days=1))

    def at(self, as_of: date | None) -> tuple[Star, date]:
        """The star as it stood at the end of ``as_of``, and that day.

        Nothing shipped later is seen, neither by periods nor by whole-history
        metrics. Without ``as_of`` the last ship day bounds nothing.
        """
        if as_of is None:
            return self, self.resolve_as_of(None)
        return replace(self, fact=self.between(before=as_of + timedelta(days=1)), parts={}), as_of


def shipped_since(day: date) -> Column:
    """Condition on the fact: shipped on or after ``day``."""
    return F.col("shipment_date_key") >= date_key(day)


def lane_label(separator: str = " -> ") -> Column:
    return F.concat(F.col("origin_city"), F.lit(separator), F.col("dest_fc_id"))
