"""Delimited files cut in byte ranges, against pandas reading them whole."""

import random

import pandas as pd
import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from routepulse.sources import delimited
from routepulse.sources.delimited import read_delimited

CELLS = ["plain", "", 'a "quoted" word', "two\nlines", "a, comma", '"', '""', "\n", "\n\n\n", 'x"\n"y', "ä\n€ 🎉", "l" * 90, "crlf\r\ninside", " blanks ", "end\n"]


def rows(seed, n):
    rng = random.Random(seed)
    return pd.DataFrame({"id": [f"r{i}" for i in range(n)], "note": [rng.choice(CELLS) for _ in range(n)], "more, text": [rng.choice(CELLS) for _ in range(n)]})


@pytest.fixture(params=[37, 256, 5_000])
def ranges(spark, request):
    """Files are cut into ranges of so many bytes."""
    settings = {"spark.sql.files.maxPartitionBytes": str(request.param), "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield request.param
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def got(df):
    return sorted(tuple(c or "" for c in r) for r in df.collect())


def whole(*paths):
    frame = pd.concat([pd.read_csv(p, dtype=str, keep_default_na=False) for p in paths])
    return sorted(map(tuple, frame.itertuples(index=False)))


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_equals_pandas_whatever_the_ranges(spark, tmp_path, ranges, ending):
    path = tmp_path / "t.csv"
    rows(ranges, 120).to_csv(path, index=False, lineterminator=ending)
    df = read_delimited(spark, str(path))
    assert df.columns == ["id", "note", "more, text"]
    assert got(df) == whole(path)


@pytest.mark.parametrize("few", [True, False])
def test_folders_of_files_and_many_states(spark, tmp_path, ranges, few, monkeypatch):
    if not few:
        monkeypatch.setattr(delimited, "BROADCAST_RANGES", 0)
    folder = tmp_path / "t.csv"
    folder.mkdir()
    for i in range(3):
        rows(i, 30).to_csv(folder / f"part-{i}.csv", index=False)
    rows(9, 40).assign(note="no break", **{"more, text": "x"}).to_csv(folder / "part-9.csv", index=False)
    assert got(read_delimited(spark, str(folder))) == whole(*sorted(folder.glob("part-*")))


def test_cells_longer_than_many_ranges(spark, tmp_path, ranges):
    path = tmp_path / "t.csv"
    frame = pd.DataFrame({"id": ["a", "b", "c", "d"], "note": ["x\n" * 3_000, "short", 'q"\n' * 2_000, "\n" * 700]})
    frame.to_csv(path, index=False)
    assert got(read_delimited(spark, str(path))) == whole(path)


def test_heading_with_a_line_break_blank_lines_and_no_last_line_end(spark, tmp_path, ranges):
    path = tmp_path / "t.csv"
    path.write_text('\n\n"first\nname",b\n\n1,"x\ny"\n   \n2,z\n\n3,"last\ncell"')
    df = read_delimited(spark, str(path))
    assert df.columns == ["first\nname", "b"]
    if ranges > 100:  # the heading begins in the file's first range
        assert got(df) == [("1", "x\ny"), ("2", "z"), ("3", "last\ncell")]


def test_files_without_line_breaks_in_cells_are_read_by_spark_alone(spark, tmp_path, ranges):
    path = tmp_path / "t.csv"
    frame = pd.DataFrame({"a": [f"{i}" for i in range(200)], "b": ['q"uo""te', "x,y", "z", ""] * 50})
    frame.to_csv(path, index=False)
    df = read_delimited(spark, str(path))
    assert "MapInArrow" not in df._jdf.queryExecution().toString()
    assert got(df) == whole(path)
    assert df.rdd.getNumPartitions() > 1 or ranges > 1_000


@pytest.mark.parametrize("line", ['2,5" pipe', '2,"open', '2,"a"b', 'x"y"z,1', "1,2,3", "only"])
def test_stray_quotes_and_wrong_numbers_of_cells_are_errors(spark, tmp_path, ranges, line):
    path = tmp_path / "t.csv"
    path.write_text(f'a,b\n1,"x\ny"\n{line}\n3,"x\ny"\n' + "4,z\n" * 50)
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_delimited(spark, str(path)).collect()


def test_many_tasks_read_one_file(spark, tmp_path):
    path = tmp_path / "t.csv"
    with path.open("w", newline="") as out:
        out.write("id,note\n")
        for i in range(200_000):
            out.write(f'{i},"line {i}\n""quoted"" and more of it"\n' if i % 3 else f"{i},plain text without a break\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 19))
    try:
        df = read_delimited(spark, str(path))
        assert df.rdd.getNumPartitions() >= 16
        n, ids, breaks = df.agg(F.count("*"), F.count_distinct("id"), F.count_if(F.col("note").contains('\n"quoted" and'))).first()
        assert (n, ids, breaks) == (200_000, 200_000, sum(1 for i in range(200_000) if i % 3))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
