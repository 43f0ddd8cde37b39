"""Declared input schemas (nothing is inferred by Spark).

Field lists are fixed values: they must equal the inputs the jobs were written
for, so they are spelled out here in their natural order.
"""

from pyspark.sql import types as T

S, L, I, D, F, B = (
    T.StringType(),
    T.LongType(),
    T.IntegerType(),
    T.DoubleType(),
    T.FloatType(),
    T.BooleanType(),
)


def _struct(*fields, nullable=True):
    return T.StructType([T.StructField(name, kind, nullable) for name, kind in fields])


# --- fixed values: comment records, JSON lines (21 fields) ---
COMMENT = _struct(
    ("archived", B),
    ("author", S),
    ("author_flair_css_class", S),
    ("author_flair_text", S),
    ("body", S),
    ("controversiality", L),
    ("created_utc", S),
    ("distinguished", S),
    ("downs", L),
    ("edited", S),
    ("gilded", L),
    ("id", S),
    ("link_id", S),
    ("name", S),
    ("parent_id", S),
    ("retrieved_on", L),
    ("score", L),
    ("score_hidden", B),
    ("subreddit", S),
    ("subreddit_id", S),
    ("ups", L),
)

# --- fixed values: page counts, one blank between fields ---
# hour inside the line
PAGECOUNT_WITH_HOUR = _struct(
    ("hour", S), ("language", S), ("title", S), ("views", I), ("bytes", L)
)
# hour in the file name
PAGECOUNT = _struct(("language", S), ("title", S), ("views", L), ("page_size", L))

# --- fixed values: weather observations, headerless CSV ---
OBSERVATION = _struct(
    ("station", S),
    ("date", S),
    ("observation", S),
    ("value", I),
    ("mflag", S),
    ("qflag", S),
    ("sflag", S),
    ("obstime", S),
)

# --- fixed values: daily maxima with position, headerless CSV ---
TMAX = _struct(
    ("station", S),
    ("date", T.DateType()),
    ("latitude", F),
    ("longitude", F),
    ("elevation", F),
    ("tmax", F),
)

# --- fixed values: colour words, headerless CSV, all non-nullable ---
COLOUR = _struct(
    ("R", I), ("G", I), ("B", I), ("word", S), ("confidence", S), nullable=False
)

# --- fixed values: parsed web-access log rows ---
# bytes is a long: a single response can pass 2**31 on large archives.
ACCESS_LOG = _struct(
    ("host", S), ("id", S), ("datetime", T.TimestampNTZType()), ("path", S), ("bytes", L)
)
LOG_VISITS = _struct(("host", S), ("visits", I), ("bytes", L))

# edges of a directed graph
EDGES = _struct(("src", L), ("dst", L))

# stream of points, "x y" text
POINT_MESSAGE = _struct(("value", S))
