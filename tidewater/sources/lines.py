"""Line sources and text parsers.

A topic of the reference is a Kafka topic here; tests and local runs use a
folder of text files, which behaves the same for batch and streaming reads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import trimmed
from ..schemas import CAR_INFO


def read_lines(spark: SparkSession, source: str, streaming: bool = False,
               kafka_servers: str | None = None, max_files_per_trigger: int | None = None,
               **options) -> DataFrame:
    """One ``value STRING`` row per message/line.

    ``source`` is a topic name when ``kafka_servers`` is given (read from the
    earliest offset; the consumer position lives in the query checkpoint), or
    a file/folder path otherwise.
    """
    reader = spark.readStream if streaming else spark.read
    if kafka_servers:
        r = (reader.format("kafka").option("kafka.bootstrap.servers", kafka_servers)
                   .option("subscribe", source).option("startingOffsets", "earliest"))
        for k, v in options.items():
            r = r.option(k, v)
        return r.load().select(F.col("value").cast("string").alias("value"),
                               F.col("offset").alias("seq"))
    r = reader.format("text")
    if streaming and max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(source)


def read_json_table(lines: DataFrame, schema: T.StructType, time_expr: Column | None = None,
                    delay: str | None = None, view: str | None = None,
                    value_col: str = "value", time_col: str = "rt") -> DataFrame:
    """A declared JSON table: parse, add the computed event-time column,
    declare the watermark ``rt - delay``, optionally register as a SQL view.

    Unparsable lines are skipped (every declared field null).
    """
    rec = F.from_json(F.col(value_col), schema)
    # parse once: test inside a one-element array, then inline (a filter on
    # the parsed fields would be pushed below the parser and copy it)
    present = lambda r: F.greatest(*[r[f.name].isNotNull() for f in schema.fields])
    parsed = lines.select(F.inline(F.filter(F.array(rec), present)))
    if time_expr is not None:
        parsed = parsed.withColumn(time_col, time_expr)
        if delay:
            parsed = parsed.withWatermark(time_col, delay)
    if view:
        parsed.createOrReplaceTempView(view)
    return parsed


def parse_car_lines(lines: DataFrame, value_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Tab separated ``area road monitor camera time car speed``; each field
    trimmed, speed as double (null when not numeric)."""
    parts = F.split(F.col(value_col), "\t")
    names = [f.name for f in CAR_INFO.fields]
    cols = [trimmed(F.get(parts, i)).alias(n) for i, n in enumerate(names[:-1])]
    speed = trimmed(F.get(parts, len(names) - 1)).try_cast("double").alias("speed")
    # inlined from a one-element array: a line is cut once, however often its fields are used further on
    return lines.select(*keep, F.inline(F.array(F.struct(*cols, speed))))


def parse_csv_lines(lines: DataFrame, schema: T.StructType, value_col: str = "value",
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """Comma separated fields in schema order; a missing or unreadable field is null."""
    parts = F.split(F.col(value_col), ",")
    cols = [F.get(parts, i).try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)]
    return lines.select(*keep, *cols)
