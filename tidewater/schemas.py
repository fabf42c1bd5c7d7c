"""Fixed schemas of the domain records (FIXTURES.md §1), snake_case."""

from pyspark.sql import types as T

S = T.StringType()
L = T.LongType()
D = T.DoubleType()
DEC = T.DecimalType(18, 2)


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


COMMON = _struct(("mid", S), ("vc", S), ("ch", S), ("ar", S), ("is_new", S))
PAGE = _struct(("page_id", S), ("last_page_id", S), ("item", S), ("item_type", S),
               ("during_time", L))
DISPLAY = _struct(("item", S), ("item_type", S))

PAGE_LOG = _struct(("common", COMMON), ("page", PAGE), ("displays", T.ArrayType(DISPLAY)),
                   ("start", S), ("ts", L))

# the SQL table of the keyword job: common and page as string maps
PAGE_VIEW_MAPS = _struct(("common", T.MapType(S, S)), ("page", T.MapType(S, S)), ("ts", L))

CHANGE_ENVELOPE = _struct(("database", S), ("table_name", S), ("type", S),
                          ("before", T.MapType(S, S)), ("after", T.MapType(S, S)))

TABLE_PROCESS = _struct(("source_table", S), ("operate_type", S), ("sink_type", S),
                        ("sink_table", S), ("sink_columns", S), ("sink_pk", S),
                        ("sink_extend", S))

CAR_INFO = _struct(("area_id", S), ("road_id", S), ("monitor_id", S), ("camera_id", S),
                   ("action_time", S), ("car_id", S), ("speed", D))

SPEED_LIMIT = _struct(("area_id", S), ("road_id", S), ("monitor_id", S), ("speed_limit", D))

VIOLATION = _struct(("car_id", S), ("violation", S), ("create_time", S), ("description", S))
POLICE = _struct(("police_id", S), ("car_id", S), ("action_time", S), ("status", S))
