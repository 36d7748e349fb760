"""Nothing later than ``as_of`` is seen, by periods or by whole-history metrics."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from loadstar.operators import views
from loadstar.plans.catalog import _PAST, QUERIES
from loadstar.star import date_key

PAST = [n for n in QUERIES if n.endswith("_past")]


def test_rows_end_with_the_day(stored):
    day = date(2024, 6, 30)
    for rows, days in ((views.anomaly_flags(stored, as_of=day), 14), (views.bi_extract(stored, as_of=day), 60)):
        first, last = rows.agg(F.min("date"), F.max("date")).first()
        assert day - timedelta(days=days) <= first and last <= day


@pytest.mark.parametrize("name", PAST)
def test_later_shipments_change_nothing(name, stored):
    """The answer is the one a star without the later shipments gives."""
    from dataclasses import replace

    cut = replace(stored, fact=stored.fact.where(F.col("shipment_date_key") <= date_key(_PAST)))
    assert QUERIES[name](stored).collect() == QUERIES[name](cut).collect()


def test_the_star_at_a_day(stored):
    star, day = stored.at(_PAST)
    assert day == _PAST
    assert star.fact.agg(F.max("shipment_date_key")).first()[0] <= date_key(_PAST)
    assert stored.at(None)[0] is stored
