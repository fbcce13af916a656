"""Find, type and load the delivery tables; write the spatial aggregates, both in one step."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from routepulse import schemas
from routepulse.functions.columns import known
from routepulse.sources.delimited import OPTIONS, read_delimited

# Cell texts that mean "missing" in delimited files.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

NANOS_AS_LONG = "spark.sql.legacy.parquet.nanosAsLong"


def _path_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def _open_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Spark has no nanosecond timestamps: a file with such columns is read as integers.

    Only the schema needs the setting for it, which is put back; its integer columns are
    marked, and conform() turns those that are declared as times into zone-less ones.
    """
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PARQUET_TYPE_ILLEGAL":
            raise
    before = spark.conf.get(NANOS_AS_LONG, None)
    spark.conf.set(NANOS_AS_LONG, "true")
    try:
        schema = spark.read.parquet(path).schema
    finally:
        spark.conf.unset(NANOS_AS_LONG) if before is None else spark.conf.set(NANOS_AS_LONG, before)
    df = spark.read.schema(schema).parquet(path)
    return df.select(
        *[
            F.col(f.name).alias(f.name, metadata={"nanos": True})
            if isinstance(f.dataType, T.LongType)
            else F.col(f.name)
            for f in schema
        ]
    )


def _filled(df: DataFrame) -> DataFrame:
    return df.select(
        *[F.when(~F.col(n).isin(*MISSING_TEXTS), F.col(n)).alias(n) for n in df.columns]
    )


def _open_csv(spark: SparkSession, path: str) -> DataFrame:
    # The header line decides which column is which; all text until conform().
    return _filled(read_delimited(spark, path))


def _open_gzip(spark: SparkSession, path: str) -> DataFrame:
    # One gzip file is one byte range anyway.
    names = spark.read.options(header=True, **OPTIONS).csv(path).columns
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return _filled(spark.read.schema(text).options(header=True, **OPTIONS).csv(path))


def _strict(name: str, column: Column, read: Column, target: T.DataType) -> Column:
    """``read``, or an error where the cell is there but cannot be read; in any SQL mode."""
    wrong = F.concat(F.lit(f"{name}: not a {target.simpleString()}: "), column.cast("string"))
    failed = F.raise_error(wrong).cast(target)
    return F.when(column.isNull() | read.isNotNull(), read).otherwise(failed)


def _typed(column: Column, field: T.StructField, target: T.DataType) -> Column:
    source, name = field.dataType, field.name
    if source == target:
        return known(column) if isinstance(target, T.DoubleType) else column
    if isinstance(target, T.DoubleType):
        return known(_strict(name, column, column.try_cast("double"), target))
    if isinstance(target, T.TimestampNTZType) and isinstance(source, T.IntegralType):
        if not field.metadata.get("nanos"):
            raise ValueError(f"{name}: whole numbers of unknown unit where times are expected")
        micros = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
        return F.timestamp_add("MICROSECOND", F.floor(column / 1000).cast("long"), micros)
    if isinstance(target, T.IntegralType) and not isinstance(source, T.IntegralType):
        # "1.0" and 1.0 are whole, 1.7 is not; NaN is missing.
        number = column.try_cast("double")
        column = F.when(F.isnan(number), None).otherwise(column)
        whole = F.when(number == F.floor(number), number.try_cast(target))
        return _strict(name, column, whole, target)
    return _strict(name, column, column.try_cast(target), target)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast the known columns to their declared types and NaN to NULL.

    A value that cannot be cast fails the job. Unknown columns pass through.
    """
    declared = {f.name: f.dataType for f in schema.fields}
    return df.select(
        *[
            _typed(F.col(f.name), f, declared[f.name]).alias(f.name)
            if f.name in declared
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def read_table(
    spark: SparkSession,
    directory: str,
    name: str,
    schema: T.StructType,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Load ``name`` from a folder, preferring .parquet, then .csv, then .csv.gz."""
    directory = str(directory).rstrip("/")
    for suffix, reader in ((".parquet", _open_parquet), (".csv", _open_csv), (".csv.gz", _open_gzip)):
        try:
            df = reader(spark, f"{directory}/{name}{suffix}")
        except AnalysisException as error:
            if _path_missing(error):
                continue
            raise
        if columns is not None:
            df = df.select(*columns)
        df = conform(df, schema)
        if suffix == ".csv.gz":
            # One gzip file is one split: spread it before any work is done on it.
            df = df.repartition(spark.sparkContext.defaultParallelism)
        return df
    raise FileNotFoundError(f"{directory} holds no table {name} (.parquet, .csv or .csv.gz)")


def read_pings(spark: SparkSession, directory: str) -> DataFrame:
    return read_table(spark, directory, "pings", schemas.PINGS, schemas.PINGS.names)


def load_tables(spark: SparkSession, directory: str) -> tuple[DataFrame, DataFrame]:
    """(routes, stops); names whichever of the two is missing."""
    found: dict[str, DataFrame] = {}
    for name, schema in (("routes", schemas.ROUTES), ("stops", schemas.STOPS)):
        try:
            found[name] = read_table(spark, directory, name, schema)
        except FileNotFoundError:
            pass
    missing = [name for name in ("routes", "stops") if name not in found]
    if missing:
        raise FileNotFoundError(f"{directory} lacks the table(s) {', '.join(missing)}")
    return found["routes"], found["stops"]


# The file that names the version both tables are read in; it lies in the first one's folder.
CURRENT = "_current"
#: Versions that stay: the current one and, for those who still read it, the one before.
VERSIONS = 2


def _opened(spark: SparkSession, path: str):
    """(path, its file system, the file systems' settings)"""
    place, settings = spark._jvm.org.apache.hadoop.fs.Path(path), spark.sparkContext._jsc.hadoopConfiguration()
    return place, place.getFileSystem(settings), settings


def _switch(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in place of another by one rename."""
    place, files, settings = _opened(spark, path)
    beside, *_ = _opened(spark, f"{path}-{uuid.uuid4().hex}")
    out = files.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    kind = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE
    spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), settings).rename(beside, place, options)


def _current(spark: SparkSession, directory: str) -> str | None:
    place, files, _ = _opened(spark, f"{directory}/hex_hourly.parquet/{CURRENT}")
    if not files.exists(place):
        return None
    stream = files.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def _forget(spark: SparkSession, folder: str, keep: set[str]) -> None:
    """Remove a table's versions but those to keep, and the files of a table without versions."""
    place, files, _ = _opened(spark, folder)
    for entry in files.listStatus(place):
        name = entry.getPath().getName()
        if name.removeprefix("version=") not in keep and re.match(r"version=|part-|_SUCCESS$", name):
            files.delete(entry.getPath(), True)


def write_hex_tables(hourly: DataFrame, summary: DataFrame, directory: str) -> None:
    """Write both tables as a new version; readers see the old pair until both are there.

    A version is a folder in each table's folder. One small file names the current one, and
    replacing it (a single rename) switches both tables. A write that fails leaves its
    folders behind, which the next one removes. One job writes a directory at a time.
    """
    spark, directory = hourly.sparkSession, str(directory).rstrip("/")
    before, version = _current(spark, directory), uuid.uuid4().hex
    for name, table in (("hex_hourly", hourly), ("hex_summary", summary)):
        table.write.parquet(f"{directory}/{name}.parquet/version={version}")
    _switch(spark, f"{directory}/hex_hourly.parquet/{CURRENT}", version)
    keep = {version, before} if before and VERSIONS > 1 else {version}
    for name in ("hex_hourly", "hex_summary"):
        _forget(spark, f"{directory}/{name}.parquet", keep)


def load_hex_tables(spark: SparkSession, directory: str) -> tuple[DataFrame, DataFrame]:
    """(hex_hourly, hex_summary) of the current version, as written by the spatial job.

    Tables without versions, as earlier releases wrote them, are read as they are.
    """
    directory = str(directory).rstrip("/")
    version = _current(spark, directory)
    inside = f"/version={version}" if version else ""
    try:
        return (
            spark.read.parquet(f"{directory}/hex_hourly.parquet{inside}"),
            spark.read.parquet(f"{directory}/hex_summary.parquet{inside}"),
        )
    except AnalysisException as error:
        if _path_missing(error):
            raise FileNotFoundError(
                f"Spatial aggregates are missing in {directory}; run run_spatial_job first."
            ) from error
        raise
