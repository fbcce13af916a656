import gzip

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from routepulse import schemas
from routepulse.sources import load_hex_tables, load_tables, read_pings, read_table, write_hex_tables

ROUTE = {
    "route_id": ["north-7", "north-8"],
    "vehicle_type": ["truck", "cargo_bike"],
    "driver_id": ["ada", "bo"],
    "depot": ["C", "B"],
    "algorithm": ["cluster_nn", "fifo"],
    "dispatch_window": ["evening", "midday"],
    "wait_min": [17.5, 0.25],
    "route_km": [8.75, 31.0],
    "dispatch_planned": ["2024-11-30 17:45:10", "2024-12-01 12:00:00"],
    "dispatch_actual": ["2024-11-30 18:02:40", "2024-12-01 12:00:15"],
}
STOP = {
    "route_id": ["north-8"],
    "planned_arrival": ["2024-12-01 12:20:00"],
    "actual_arrival": ["2024-12-01 12:17:30"],
    "delay_min": [-2.5],
}


def test_csv_tables_get_declared_types(spark, tmp_path):
    pd.DataFrame(ROUTE).to_csv(tmp_path / "routes.csv", index=False)
    pd.DataFrame(STOP).to_csv(tmp_path / "stops.csv", index=False)
    routes, stops = load_tables(spark, tmp_path)
    assert isinstance(routes.schema["dispatch_planned"].dataType, T.TimestampNTZType)
    assert isinstance(stops.schema["planned_arrival"].dataType, T.TimestampNTZType)
    got = {r["route_id"]: r for r in routes.collect()}
    assert got["north-7"]["dispatch_actual"] == pd.Timestamp("2024-11-30 18:02:40")
    assert got["north-8"]["route_km"] == 31.0
    assert [r["delay_min"] for r in stops.collect()] == [-2.5]


def test_missing_tables_are_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="routes, stops"):
        load_tables(spark, tmp_path)
    pd.DataFrame(ROUTE).to_csv(tmp_path / "routes.csv", index=False)
    with pytest.raises(FileNotFoundError, match=r"lacks the table\(s\) stops"):
        load_tables(spark, tmp_path)
    with pytest.raises(FileNotFoundError, match="no table pings"):
        read_pings(spark, tmp_path)
    with pytest.raises(FileNotFoundError, match="run_spatial_job"):
        load_hex_tables(spark, tmp_path)


def test_parquet_is_preferred_and_nanosecond_times_are_read(spark, tmp_path):
    pings = pd.DataFrame(
        {
            "route_id": ["r", "r"],
            "ts": pd.to_datetime(["2025-03-30 02:30:00.123456789", "1969-12-31 23:59:59.5"]),
            "lat": [52.5, float("nan")],
            "lon": [13.4, 13.4],
            "speed_kmh": [1.0, 2.0],
            "status": [0, 1],
            "extra": ["x", "y"],
        }
    )
    pings.to_parquet(tmp_path / "pings.parquet", index=False)
    (tmp_path / "pings.csv").write_text("not,used\n")
    loaded = read_pings(spark, tmp_path)
    assert loaded.columns == schemas.PINGS.names
    rows = sorted(loaded.collect(), key=lambda r: r["ts"])
    assert rows[1]["ts"] == pd.Timestamp("2025-03-30 02:30:00.123456")
    assert rows[0]["ts"] == pd.Timestamp("1969-12-31 23:59:59.5")
    assert rows[0]["lat"] is None


def test_csv_missing_texts_and_column_order(spark, tmp_path):
    (tmp_path / "pings.csv").write_text(
        "status,route_id,ts,lon,lat,speed_kmh\n1.0,r,2025-03-03 08:00:00,13.4,NA,\n,,,nan,52.5,3\n"
    )
    first, second = read_pings(spark, tmp_path).collect()
    assert (first["status"], first["lat"], first["speed_kmh"]) == (1, None, None)
    assert (second["status"], second["route_id"], second["ts"], second["lon"]) == (None,) * 4


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(
    "cell, column", [("soon", "ts"), ("x", "lat"), ("1.7", "status"), ("one", "status"), ("3e99", "status")]
)
def test_a_cell_that_cannot_be_read_fails_in_any_mode(spark, tmp_path, ansi, cell, column):
    good = {"route_id": "r", "ts": "2025-03-03 08:00:00", "lat": "1", "lon": "2", "speed_kmh": "3", "status": "1"}
    with gzip.open(tmp_path / "pings.csv.gz", "wt") as out:
        out.write(",".join(good) + "\n" + ",".join((good | {column: cell}).values()) + "\n")
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        with pytest.raises(PySparkException, match=column):
            read_pings(spark, tmp_path).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_quotes_and_line_breaks_in_cells(spark, tmp_path):
    frame = pd.DataFrame(ROUTE)
    frame["depot"] = ['a "quoted", depot', "two\nlines \\ slash"]
    frame.to_csv(tmp_path / "routes.csv", index=False)
    df = read_table(spark, tmp_path, "routes", schemas.ROUTES)
    assert sorted(r["depot"] for r in df.collect()) == sorted(frame["depot"])


def test_whole_numbers_are_no_times_and_settings_stay(spark, tmp_path):
    pings = pd.DataFrame({"route_id": ["r"], "ts": [1_741_000_000_000], "lat": [1.0], "lon": [2.0], "speed_kmh": [3.0], "status": [1]})
    pings.to_parquet(tmp_path / "pings.parquet", index=False)
    before = spark.conf.get("spark.sql.legacy.parquet.nanosAsLong", None)
    with pytest.raises(ValueError, match="ts: whole numbers"):
        read_pings(spark, tmp_path)
    other = tmp_path / "other"
    other.mkdir()
    pings.assign(ts=pd.to_datetime(["2025-03-03 08:00:00.000000001"])).to_parquet(other / "pings.parquet", index=False)
    assert read_pings(spark, other).first()["ts"] == pd.Timestamp("2025-03-03 08:00:00")
    assert spark.conf.get("spark.sql.legacy.parquet.nanosAsLong", None) == before


def test_columns_are_pruned(spark, tmp_path):
    pd.DataFrame(ROUTE).to_parquet(tmp_path / "routes.parquet", index=False)
    df = read_table(spark, tmp_path, "routes", schemas.ROUTES, ["route_id", "vehicle_type"])
    assert df.columns == ["route_id", "vehicle_type"]


def pairs(spark, n):
    hourly = spark.range(n).selectExpr("id AS hour", f"{n} AS written")
    return hourly, spark.range(n).selectExpr("id AS h3", f"{n} AS written")


def read_pair(spark, folder):
    return [sorted({r["written"] for r in t.collect()}) for t in load_hex_tables(spark, folder)]


def test_a_failed_write_leaves_the_old_pair(spark, tmp_path):
    for n in (3, 5):
        write_hex_tables(*pairs(spark, n), tmp_path)
        assert read_pair(spark, tmp_path) == [[n], [n]]
    hourly, summary = pairs(spark, 7)
    with pytest.raises(Exception, match="lost"):
        write_hex_tables(hourly, summary.withColumn("h3", F.raise_error(F.lit("lost"))), tmp_path)
    assert read_pair(spark, tmp_path) == [[5], [5]]
    write_hex_tables(*pairs(spark, 9), tmp_path)
    assert read_pair(spark, tmp_path) == [[9], [9]]
    for name in ("hex_hourly", "hex_summary"):  # the failed version is gone
        assert len(list((tmp_path / f"{name}.parquet").glob("version=*"))) == 2
    assert sorted(p.name for p in tmp_path.iterdir()) == ["hex_hourly.parquet", "hex_summary.parquet"]


def test_a_reader_keeps_its_pair_while_the_next_is_written(spark, tmp_path):
    write_hex_tables(*pairs(spark, 2), tmp_path)
    before = load_hex_tables(spark, tmp_path)
    write_hex_tables(*pairs(spark, 4), tmp_path)
    assert [t.count() for t in before] == [2, 2] and read_pair(spark, tmp_path) == [[4], [4]]


def test_tables_without_versions_are_read_and_replaced(spark, tmp_path):
    for table, name in zip(pairs(spark, 6), ("hex_hourly", "hex_summary"), strict=True):
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    assert read_pair(spark, tmp_path) == [[6], [6]]
    write_hex_tables(*pairs(spark, 8), tmp_path)
    assert read_pair(spark, tmp_path) == [[8], [8]]
    assert not list((tmp_path / "hex_summary.parquet").glob("part-*"))
