"""Travel-listing cleansing (P14-P17, U4, J10 wiring).

Geocoding by HTTP per row is replaced by a join to a gazetteer table
(``joins.geocode``); the "already geocoded" cache becomes key de-duplication
within a run and an anti join against the previous output across runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .joins import broadcast_if_small, geocode, has_coordinates
from .sequence import first_per_group

ADMIN = ("province", "adcode", "district", "town")
BUS_COMPANY_PREFIX = "公交公司："   # fixed value: prefix of the company text
BUS_STOP_SUFFIX = "公交站"          # fixed value: stop name suffix


def _blank_geo(df: DataFrame) -> DataFrame:
    for c in ADMIN:
        df = df.withColumn(c, F.lit(""))
    return df.withColumn("lon", F.lit(0.0)).withColumn("lat", F.lit(0.0))


def clean_bus(raw: DataFrame) -> DataFrame:
    """Company prefix stripped (null -> ''), brackets removed from the
    line name, price/bus_name renamed, address = city + stop name with the
    stop suffix; ``dedup_key`` = city_line_direction_stop."""
    company = F.when(F.col("company").isNull(), F.lit("")) \
               .otherwise(T.trimmed(F.replace(F.col("company"), F.lit(BUS_COMPANY_PREFIX), F.lit(""))))
    line = F.replace(F.replace(F.col("line_name"), F.lit("["), F.lit("")), F.lit("]"), F.lit(""))
    stop = T.trimmed(F.col("station_name"))
    stop = F.when(stop.contains(BUS_STOP_SUFFIX), stop).otherwise(F.concat(stop, F.lit(BUS_STOP_SUFFIX)))
    d = (raw.withColumn("company", company).withColumn("line_name", line)
            .withColumn("price_info", F.col("price")).withColumn("bus_line_name", F.col("bus_name"))
            .drop("price", "bus_name")
            .withColumn("_stop", stop)
            .withColumn("address", T.trimmed(F.concat(F.col("city"), F.col("_stop"))))
            .withColumn("dedup_key", F.concat_ws("_", "city", "line_name", "forward", "_stop"))
            .withColumn("geo_fallback", F.concat(F.col("city"), F.lit(T.CITY), F.col("_stop")))
            .drop("_stop"))
    return _blank_geo(d)


def clean_hotel(raw: DataFrame) -> DataFrame:
    """Price, score, comment count and analysed address;
    ``dedup_key`` = hotel_city_name_address."""
    name_with_city = F.when(F.col("hotel_name").contains(F.col("city")), F.col("hotel_name")) \
                      .otherwise(F.concat(F.col("city"), F.col("hotel_name")))
    d = (raw.withColumn("price", T.price("price"))
            .withColumn("score", T.hotel_score("score"))
            .withColumn("analysis_address", T.hotel_address("city", "address"))
            .withColumn("comment_count", T.hotel_comment_count("comment_count"))
            .withColumn("dedup_key", F.concat_ws("_", F.lit("hotel"), "city", "hotel_name", "address"))
            .withColumn("geo_fallback", name_with_city))
    return _blank_geo(d)


def clean_sight(raw: DataFrame) -> DataFrame:
    """Rank class from the name, name without the rank tag, review count
    and score, original rank text kept as ``rank_info``, punctuation-free
    address; ``dedup_key`` = sight_city_name_address."""
    d = (raw.withColumn("rank_info", F.col("rank_class"))
            .withColumn("rank_class", T.rank_class("name"))
            .withColumn("name", T.name_without_rank("name"))
            .withColumn("comment_count", T.review_count("comment_count"))
            .withColumn("comment_score", T.review_score("comment_score"))
            .withColumn("clean_address", T.strip_punctuation(T.sight_address("city", "address")))
            .withColumn("dedup_key", F.concat_ws("_", F.lit("sight"), "city", "name", "clean_address"))
            .withColumn("geo_fallback", F.concat(F.col("city"), F.lit(T.CITY), F.col("clean_address"))))
    return _blank_geo(d)


def dedup_listings(df: DataFrame, key: str = "dedup_key", order: Sequence[str] = ("id",)) -> DataFrame:
    """U4 within a run: the first row per key (by ``order``) survives.
    A ``min_by`` aggregate: duplicates are dropped map-side first."""
    return first_per_group(df, [key], list(order))


def new_listings(df: DataFrame, previous: DataFrame, key: str = "dedup_key") -> DataFrame:
    """U4 across runs: drop rows whose key an earlier run already produced."""
    prev = broadcast_if_small(previous.select(key).distinct())
    return df.join(prev, key, "left_anti")


def locate(df: DataFrame, gazetteer: DataFrame, key: str) -> DataFrame:
    """J10 + P14: gazetteer lookup by ``key`` with ``geo_fallback`` as second
    spelling; rows without a fix are dropped."""
    d = df.drop("lon", "lat", *ADMIN)
    return has_coordinates(geocode(d, gazetteer, key, "geo_fallback"))
