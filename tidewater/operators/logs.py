"""Behaviour-log cleaning and splitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import PAGE_LOG

CORRUPT = "_corrupt_record"


def split_dirty(lines: DataFrame, schema: T.StructType = PAGE_LOG, value_col: str = "value",
                keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Parse JSON text lines; return ``(good, dirty)``.

    good: the parsed record columns (plus ``keep`` passthrough columns; keep
    the line itself to pass on fields outside the schema);
    dirty: the raw line of every unparsable input, in column ``value``.
    PERMISSIVE parsing marks bad lines in ``_corrupt_record`` instead of
    failing, which works unchanged on a stream.  Each line is parsed once:
    the keep/drop test runs inside a one-element array that is then inlined,
    so the optimizer cannot copy the parser into a pushed-down filter.
    """
    with_corrupt = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    rec = F.from_json(F.col(value_col), with_corrupt,
                      {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    row = F.struct(*[F.col(k) for k in keep], F.col(value_col).alias("_line"), rec.alias("_rec"))
    bad = lambda r: r["_rec"].isNull() | r["_rec"][CORRUPT].isNotNull()
    good = (lines.select(F.inline(F.filter(F.array(row), lambda r: ~bad(r))))
                 .select(*keep, *[F.col(f"_rec.{f.name}") for f in schema.fields]))
    dirty = (lines.select(F.inline(F.filter(F.array(row), bad)))
                  .select(*[k for k in keep if k != "value"], F.col("_line").alias("value")))
    return good, dirty


def is_entry(last_page_id: Column | str = "page.last_page_id") -> Column:
    """A visit entry: no previous page (null or empty)."""
    c = F.col(last_page_id) if isinstance(last_page_id, str) else last_page_id
    return c.isNull() | (F.length(c) == 0)


def split_logs(df: DataFrame, start_col: str = "start") -> tuple[DataFrame, DataFrame]:
    """``(start_log, page_log)`` by a non-empty ``start`` field."""
    has_start = F.col(start_col).isNotNull() & (F.length(F.col(start_col)) > 0)
    return df.where(has_start), df.where(~has_start)


def with_flag(record: Column, old: Column, new: Column) -> Column:
    """The record's JSON text with the repaired new-visitor flag; all else as it came."""
    return F.when(old.eqNullSafe(new), record).otherwise(
        F.regexp_replace(record, r'("is_new"\s*:\s*")[^"]*"', F.concat(F.lit("$1"), new, F.lit('"'))))


def explode_displays(page_df: DataFrame, record: str | None = None) -> DataFrame:
    """One row per element of ``displays`` of a page record, with its page id.
    With ``record``, the column of the whole record's JSON text, also the
    element as it stands there (``display``), whatever fields it has."""
    if record is not None:
        whole = F.from_json(F.col(record), T.StructType.fromDDL("displays array<variant>"))["displays"]
        text = lambda v, f: F.try_variant_get(v, f"$.{f}", "string")
        return (page_df.select(F.col("page.page_id").alias("page_id"), F.explode(whole).alias("_d"))
                       .select(text(F.col("_d"), "item").alias("item"), text(F.col("_d"), "item_type").alias("item_type"),
                               "page_id", F.to_json("_d").alias("display")))
    return (page_df.select(F.col("page.page_id").alias("page_id"),
                           F.explode("displays").alias("_d"))
                   .select(F.col("_d.item").alias("item"), F.col("_d.item_type").alias("item_type"),
                           "page_id"))


def fix_is_new(df: DataFrame, key: str = "common.mid", flag: str = "common.is_new",
               order: str = "seq") -> DataFrame:
    """Repair the new-visitor flag: of the rows flagged '1' of a device only
    the first (by ``order``, the arrival sequence) keeps '1'.

    The first flagged row per device is an aggregate (map-side combined, so a
    hot device is pre-reduced per task); it is joined back on the device,
    which AQE may turn into a broadcast join at run time or split when skewed.
    """
    keyed = df.withColumn("_tw_key", F.col(key))
    firsts = (keyed.where(F.col(flag) == "1").groupBy("_tw_key")
                   .agg(F.min(order).alias("_tw_first")))
    joined = keyed.join(firsts, "_tw_key", "left")
    fixed = F.when((F.col(flag) == "1") & (F.col(order) != F.col("_tw_first")), F.lit("0")) \
             .otherwise(F.col(flag))
    top, _, leaf = flag.rpartition(".")
    if top:
        joined = joined.withColumn(top, F.col(top).withField(leaf, fixed))
    else:
        joined = joined.withColumn(leaf, fixed)
    return joined.drop("_tw_key", "_tw_first")
