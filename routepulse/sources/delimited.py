"""Comma-separated files read in byte ranges by many tasks, with line breaks in quoted cells.

Inside a file a line break ends a record exactly when an even number of quotes stands
before it (doubled quotes count twice). Each byte range first reports whether its number of
quotes is odd; the parities of the ranges before it tell whether a range begins inside a cell.
With that, every range cuts its own records; a record that goes on behind its range is put
together from its parts. Files without line breaks in cells take no second step at all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from routepulse.session import stage

#: Byte ranges whose state is broadcast; the states of more are joined by a shuffle.
BROADCAST_RANGES = 100_000
#: Quotes in a quoted cell are doubled, and a cell may hold line breaks.
OPTIONS = {"escape": '"', "multiLine": "true", "mode": "FAILFAST"}
# A record in which quotes stand only around cells, and doubled inside them.
WELL_QUOTED = r'^(?:"[^"]*+(?:""[^"]*+)*+"|[^",]*+)(?:,(?:"[^"]*+(?:""[^"]*+)*+"|[^",]*+))*+\z'

# Parts of the file: a whole record; the end of one that began in an earlier range; a
# range without an end or beginning of a record; the beginning of one that goes on.
WHOLE, END, MIDDLE, BEGINNING = range(4)
_PARTS = "path string, block long, kind int, heading boolean, value string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    place = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block")]
    return spark.read.text(path, lineSep="\n").select("value", *place, F.monotonically_increasing_id().alias("line"))


def _odd(line: Column) -> Column:
    """Whether a line has an odd number of quotes."""
    return (F.octet_length(line) - F.octet_length(F.translate(line, '"', ""))) % 2 == 1


def quote_states(lines: DataFrame) -> DataFrame:
    """Per file and byte range: ``inside``, whether it begins inside a cell, and ``broken``, whether it holds a part of a record only."""
    ranges = lines.groupBy("path", "block").agg(F.count_if(_odd(F.col("value"))).alias("odd"))
    ordered = Window.partitionBy("path").orderBy("block")
    before = F.coalesce(F.sum("odd").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = ranges.select("path", "block", "odd", (before % 2 == 1).alias("inside"))
    after = F.col("inside") != (F.col("odd") % 2 == 1)
    return ranges.select("path", "block", "odd", "inside", (F.col("inside") | after).alias("broken"))


def _cutter() -> Callable:
    """A function that cuts the lines of a task's ranges into records and parts.

    It travels to the workers, which need numpy and pyarrow but not this package.
    """

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, end, middle, beginning = range(4)
        schema = pa.schema([("path", pa.string()), ("block", pa.int64()), ("kind", pa.int32()), ("heading", pa.bool_()), ("value", pa.string())])
        now, held, opened, inside, heading, last = None, [], False, False, False, -1

        def piece(kind):
            return {"path": now[0], "block": now[1], "kind": kind, "heading": heading and kind != end, "value": "\n".join(held)}

        for batch in batches:
            lines = batch.column("value")
            number = batch.column("line").to_numpy()
            if len(number) and not (number[0] > last and (np.diff(number) > 0).all()):
                raise ValueError("the lines of a byte range came out of order")
            last = number[-1] if len(number) else last
            odd = pc.bit_wise_and(pc.count_substring(lines, '"'), 1).to_numpy(zero_copy_only=False).astype(bool)
            filled = pc.greater(pc.utf8_length(pc.utf8_trim_whitespace(lines)), 0).to_numpy(zero_copy_only=False)
            block, path = batch.column("block").to_numpy(), batch.column("path").dictionary_encode()
            file = path.indices.to_numpy()
            turn = np.flatnonzero((np.diff(block) != 0) | (np.diff(file) != 0)) + 1
            pieces, plain = [], np.zeros(len(lines), bool)
            for start, stop in zip([0, *turn], [*turn, len(lines)], strict=True) if len(lines) else ():
                place = path.dictionary[int(file[start])].as_py(), int(block[start])
                if place != now:
                    if held:
                        pieces.append(piece(beginning if opened else middle))
                    now, held, opened = place, [], False
                    inside = bool(batch.column("inside")[start].as_py())
                    heading = now[1] == 0 and not inside
                flips = odd[start:stop]
                before = (np.cumsum(flips) - flips) % 2 == 1
                alone = ~flips & (before == inside)  # lines that are records of their own
                plain[start:stop] = alone & filled[start:stop]
                inner = inside
                for i in (np.flatnonzero(~alone) + start).tolist():
                    if heading and plain[start:i].any():
                        heading = False
                        plain[start + int(plain[start:i].argmax())] = False
                    opened = opened or not inner
                    held.append(lines[i].as_py())
                    inner ^= bool(odd[i])
                    if not inner:
                        pieces.append(piece(whole if opened else end))
                        held, heading, opened = [], False, False
                inside ^= bool(flips.sum() % 2)
                if heading and not held and plain[start:stop].any():
                    heading = False
                    plain[start + int(plain[start:stop].argmax())] = False
            easy = lines.filter(pa.array(plain))
            n = len(easy)
            yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()), pa.array(np.full(n, whole, np.int32)), pa.array(np.zeros(n, bool)), easy], schema=schema)
            if pieces:
                yield pa.RecordBatch.from_pylist(pieces, schema=schema)
        if held:
            yield pa.RecordBatch.from_pylist([piece(beginning if opened else middle)], schema=schema)

    return cut


def _parts(lines: DataFrame, states: DataFrame, few: bool) -> DataFrame:
    """The records and parts of records that the ranges of ``lines`` hold."""
    states = states.select("path", "block", "inside")
    if few:
        dealt = lines.join(F.broadcast(states), ["path", "block"], "left")
    else:
        dealt = lines.join(states, ["path", "block"], "left").repartition("path", "block").sortWithinPartitions("line")
    # a range that the states don't know was dealt otherwise in between: an error, not a guess
    changed = F.raise_error(F.lit("the byte ranges changed while the file was read")).cast("boolean")
    return dealt.select("path", "block", "line", F.coalesce("inside", changed).alias("inside"), "value").mapInArrow(_cutter(), _PARTS)


def records(spark: SparkSession, path: str, states: DataFrame) -> DataFrame:
    """The records of the files below ``path`` (``value``), each file's first one left out as its heading."""
    lines, few = _lines(spark, path), states.count() <= BROADCAST_RANGES
    heading, kind = F.col("heading"), F.col("kind")
    found = _parts(lines, states, few).where((kind == WHOLE) & ~heading).select("value")
    broken = states.where("broken").select("path", "block")
    if broken.isEmpty():
        return found
    split = _parts(lines.join(F.broadcast(broken) if few else broken, ["path", "block"], "left_semi"), states, few).where(kind != WHOLE)
    # the parts of a record follow its beginning; a range has its end before its next beginning
    order = Window.partitionBy("path").orderBy("block", "kind")
    numbered = split.withColumn("record", F.count_if(kind == BEGINNING).over(order))
    parts = F.array_sort(F.collect_list(F.struct("block", "kind", "value")))
    joined = numbered.groupBy("path", "record").agg(parts.alias("parts"), F.bool_or("heading").alias("heading")).where(~heading)
    return found.unionByName(joined.select(F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("value")))


def read_delimited(spark: SparkSession, path: str) -> DataFrame:
    """All cells as text, named by the heading (of the first file; others have the same columns).

    Lines end with LF or CRLF. Quotes stand around whole cells and are doubled inside;
    where cells go beyond a line, anything else is an error, so that a stray quote never joins or parts records.
    Blank lines are no records. The files are read once now, for the states of their ranges.
    """
    names = spark.read.options(header=True, **OPTIONS).csv(path).columns
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    states = stage(quote_states(_lines(spark, path)), "quote-states")
    if states.where("odd > 0").isEmpty():  # no cell goes beyond its line
        return spark.read.schema(text).options(header=True, **OPTIONS | {"multiLine": "false"}).csv(path)
    value = F.col("value")
    found = records(spark, path, states).select(F.when(value.endswith("\r"), F.expr("left(value, length(value) - 1)")).otherwise(value).alias("value"))
    stray = value.contains('"') & ~value.rlike(WELL_QUOTED)
    refused = F.raise_error(F.concat(F.lit("a quote inside a cell that is not quoted: "), F.left(value, F.lit(200)))).cast("string")
    parsed = F.from_csv(F.when(stray, refused).otherwise(value), F.lit(text.toDDL()), OPTIONS)
    return found.select(parsed.alias("record")).select("record.*")
