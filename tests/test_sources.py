"""Reading tables under their source names."""

import datetime as dt

from kerbside.sources.tables import read_table, write_table


def test_uncovered_list_from_text(spark, tmp_path):
    path = tmp_path / "list.csv"
    path.write_text("Date,AM/PM,Route Set,Bus\n2024-03-01,am, East  AM,B1\n2024-03-02,PM,West,\n")
    table = read_table(spark, "uncovered", str(path), "csv")
    assert table.columns == ["date", "ampm", "route_set", "bus"]
    assert table.orderBy("date").first().date == dt.date(2024, 3, 1)


def test_source_names_are_mapped_and_pruned(spark, tmp_path):
    path = str(tmp_path / "routes")
    source = spark.createDataFrame(
        [("0420", 3, "R", 12, "M", "unused")],
        "VisibleRouteID string, RouteSetID int, Name string, ActualLoad bigint, Days string, Other string",
    )
    write_table(source, path)
    routes = read_table(spark, "route", path)
    assert dict(routes.dtypes)["actual_load"] == "int"
    assert routes.first().rp_route == "0420"
    plan = routes._jdf.queryExecution().executedPlan().toString()
    assert "Other" not in plan.split("ReadSchema")[-1]


def test_json(spark, tmp_path):
    path = tmp_path / "zones.json"
    path.write_text('{"id": 1, "name": "Z", "category": "c", "type": "school", "more": 1}\n')
    assert tuple(read_table(spark, "zone", str(path), "json").first()) == (1, "Z", "c", "school")
