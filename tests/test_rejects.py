"""Bad rows of CSV files are set aside with a reason, and nothing is lost."""

from datetime import date

from loadstar import schema
from loadstar.sources import rejects
from tests.small import make_star, shipment
from tests.test_sources import write_csv_star

DAY = date(2024, 1, 5)


def spoil(folder, name, change):
    """Rewrite the data lines of a table's CSV parts."""
    for part in (folder / f"{name}.csv").glob("part-*.csv"):
        head, *lines = part.read_text().splitlines()
        part.with_name("." + part.name + ".crc").unlink(missing_ok=True)
        part.write_text("\n".join([head, *change(lines, head.split(","))]) + "\n")


def put(line, names, column, value):
    cells = line.split(",")
    cells[names.index(column)] = value
    return ",".join(cells)


def test_bad_rows_by_column_and_reason(spark, tmp_path):
    star = make_star(spark, [shipment(i, DAY) for i in range(8)])
    star = type(star)(**{**star.__dict__, "fact": star.fact.coalesce(1)})
    write_csv_star(star, str(tmp_path))

    def change(lines, names):
        lines[0] = put(lines[0], names, "carrier_id", "n/a")
        lines[1] = put(lines[1], names, "total_cost_usd", "")
        lines[2] = put(put(lines[2], names, "dwell_minutes", "long"), names, "on_time_pickup", "perhaps")
        lines[3] = lines[3].rsplit(",", 2)[0]
        lines[4] += ",one,more"
        lines[5] = put(lines[5], names, "pickup_actual_ts", "")  # may be empty
        return lines

    spoil(tmp_path, "fact_shipment", change)
    found = rejects.read_csv_sorted(spark, str(tmp_path))
    problems = sorted((r.column_name, r.reason) for r in found.rejects.collect())
    assert problems == [
        ("*", "wrong number of fields"),
        ("*", "wrong number of fields"),
        ("carrier_id", "not a bigint"),
        ("dwell_minutes", "not a double"),
        ("on_time_pickup", "not a boolean"),
        ("total_cost_usd", "missing"),
    ]
    values = {r.column_name: r.value for r in found.rejects.collect()}
    assert values["carrier_id"] == "n/a" and values["*"].startswith("S")
    assert sorted(r.shipment_id for r in found.star.fact.collect()) == ["S5", "S6", "S7"]
    totals = {r.table_name: tuple(r)[1:] for r in found.totals.collect()}
    assert totals["fact_shipment"] == (8, 3, 5)
    assert all(read == kept + rejected for read, kept, rejected in totals.values())


def test_a_clean_star_has_no_rejects(spark, tmp_path):
    star = make_star(spark, [shipment(i, DAY, pickup_actual_ts=None) for i in range(3)])
    write_csv_star(star, str(tmp_path))
    found = rejects.read_csv_sorted(spark, str(tmp_path))
    assert found.rejects.count() == 0
    for name, table in found.star.tables().items():
        assert [f.dataType for f in table.schema] == [f.dataType for f in schema.TABLES[name]]
        assert sorted(map(str, table.collect())) == sorted(map(str, star.tables()[name].collect()))
