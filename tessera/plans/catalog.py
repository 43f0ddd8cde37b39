"""Registry of named queries and their independent DuckDB oracle SQL.

``QUERIES[name](spark, sf_dir)`` returns the Spark result; ``ORACLE_SQL[name]``
is SQL for DuckDB over views named after the driver's tables. Column names
and rounding agree on both sides. Jobs whose result depends on a trained
model have no oracle (their check is on rows only).
"""

from __future__ import annotations

from tessera.functions import colour as C
from tessera.plans import jobs
from tessera.sources.logs import ACCESS_LOG_PATTERN

QUERIES = {
    "word_count": jobs.word_count,
    "word_count_lines": jobs.word_count_lines,
    "group_average": jobs.group_average,
    "hourly_max": jobs.hourly_max,
    "hourly_top_one": jobs.hourly_top_one,
    "hourly_top_ties": jobs.hourly_top_ties,
    "etl_positive": jobs.etl_positive,
    "etl_negative": jobs.etl_negative,
    "etl_split": jobs.etl_labelled,
    "flagged_projection": jobs.flagged_projection,
    "weather_etl": jobs.weather_etl,
    "relative_score": jobs.relative_score,
    "relative_score_broadcast": jobs.relative_score_broadcast,
    "daily_range_max": jobs.daily_range_max,
    "daily_range_max_sql": jobs.daily_range_max_sql,
    "access_log_parse": jobs.access_log_parse,
    "log_correlation": jobs.log_correlation,
    "loaded_logs": jobs.loaded_logs,
    "loaded_logs_total_bytes": jobs.loaded_logs_total_bytes,
    "log_table_correlation": jobs.log_table_correlation,
    "shortest_hops": jobs.shortest_hops,
    "shortest_route": jobs.shortest_route,
    "routes_to_dearest": jobs.routes_to_dearest,
    "order_lines": jobs.order_lines,
    "orders_denormalized": jobs.orders_denormalized,
    "order_lines_denorm": jobs.order_lines_denorm,
    "order_lines_by_key": jobs.order_lines_by_key,
    "order_lines_denorm_by_key": jobs.order_lines_denorm_by_key,
    "order_lines_urgent": jobs.order_lines_urgent,
    "upsert_orders": jobs.upsert_orders,
    "store_merge_orders": jobs.store_merge_orders,
    "upsert_versions": jobs.upsert_versions,
    "global_sums": jobs.global_sums,
    "linear_fit": jobs.linear_fit,
    "stream_linear_fit": jobs.stream_linear_fit,
    "rgb_to_lab": jobs.rgb_to_lab_rows,
    "rgb_to_hsv": jobs.rgb_to_hsv_rows,
    "lab_roundtrip": jobs.lab_roundtrip,
    "yesterday_pairs": jobs.yesterday_pairs,
    "page_hour_key": jobs.page_hour_key,
}


# ---------------------------------------------------------------- SQL pieces

WORDS = r"""
SELECT lower(tok) AS word
FROM (SELECT unnest(regexp_split_to_array(text, '[!-/:-@\[-`{-~\s\x0B]+')) AS tok FROM documents)
WHERE tok <> ''
"""

PAGECOUNTS = """
pc AS (
  SELECT strftime(ts, '%Y%m%d-%H') AS hour, user_id AS title, count(*) AS views
  FROM events WHERE event_type <> 'error' GROUP BY 1, 2)
"""

OBSERVATIONS = """
daily AS (
  SELECT 'U' || CAST(user_id AS VARCHAR) AS station, strftime(ts, '%Y%m%d') AS date,
         max(value) AS hi, min(value) AS lo, count(*) AS n
  FROM events GROUP BY 1, 2),
obs AS (
  SELECT station, date, 'TMAX' AS observation, CAST(floor(hi * 10.0) AS INTEGER) AS value,
         CASE WHEN n < 2 THEN 'I' END AS qflag FROM daily
  UNION ALL
  SELECT station, date, 'TMIN', CAST(floor(lo * 10.0) AS INTEGER),
         CASE WHEN n < 2 THEN 'I' END FROM daily),
tmax AS (SELECT station, date, value / 10 AS tmax FROM obs WHERE qflag IS NULL AND observation = 'TMAX'),
tmin AS (SELECT station, date, value / 10 AS tmin FROM obs WHERE qflag IS NULL AND observation = 'TMIN'),
ranged AS (
  SELECT tmax.station, tmax.date, tmax.tmax - tmin.tmin AS rng
  FROM tmax JOIN tmin ON tmax.station = tmin.station AND tmax.date = tmin.date),
best AS (SELECT date, max(rng) AS max_rng FROM ranged GROUP BY date)
"""

_P = ACCESS_LOG_PATTERN.replace("'", "''")
LOGS = f"""
lines AS (
  SELECT printf('%s - - [%s -0800] "GET %s HTTP/1.0" %d %s',
                'u' || CAST(user_id AS VARCHAR) || '.example.net',
                strftime(ts, '%d/%b/%Y:%H:%M:%S'),
                '/' || event_type || '/' || CAST(event_id AS VARCHAR),
                CASE WHEN event_type = 'error' THEN 500 ELSE 200 END,
                CASE WHEN event_type = 'error' THEN '-'
                     ELSE CAST(CAST(floor(value * 100.0) AS BIGINT) AS VARCHAR) END) AS value
  FROM events),
logs AS (
  SELECT regexp_extract(value, '{_P}', 1) AS host,
         sha256(value) AS id,
         strptime(regexp_extract(value, '{_P}', 2), '%d/%b/%Y:%H:%M:%S') AS datetime,
         regexp_extract(value, '{_P}', 3) AS path,
         CAST(regexp_extract(value, '{_P}', 4) AS BIGINT) AS bytes
  FROM lines WHERE regexp_matches(value, '{_P}'))
"""

CORRELATION = """
per_host AS (SELECT host, CAST(count(*) AS DOUBLE) AS x, CAST(sum(bytes) AS DOUBLE) AS y FROM logs GROUP BY host),
s AS (SELECT CAST(count(*) AS DOUBLE) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x) AS sxx,
             sum(y * y) AS syy, sum(x * y) AS sxy FROM per_host),
r AS (SELECT *, (n * sxy - sx * sy) / (sqrt(n * sxx - sx * sx) * sqrt(n * syy - sy * sy)) AS r FROM s)
SELECT CAST(n AS BIGINT) AS n, CAST(sx AS BIGINT) AS sum_x, CAST(sy AS BIGINT) AS sum_y,
       round(r, 6) AS r, round(r * r, 6) AS r2
FROM r
"""

GRAPH = """
edges AS (
  SELECT DISTINCT o_custkey AS src, (o_orderkey * 7 + 3) % (SELECT count(*) FROM customer) AS dst
  FROM orders),
bfs(node, dist) AS (
  SELECT CAST(1 AS BIGINT), 0
  UNION
  SELECT e.dst, b.dist + 1 FROM bfs b JOIN edges e ON e.src = b.node WHERE b.dist < 6),
d AS (SELECT node, min(dist) AS dist FROM bfs GROUP BY node),
par AS (
  SELECT c.node, min(e.src) AS parent
  FROM d c JOIN edges e ON e.dst = c.node JOIN d p ON p.node = e.src AND p.dist = c.dist - 1
  GROUP BY c.node)
"""

ORDER_NAMES = """
names AS (
  SELECT l.l_orderkey AS ok, array_to_string(list_sort(list_distinct(list(p.p_name))), ', ') AS part_names
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY l.l_orderkey)
"""

ORDER_LINES = (
    "WITH "
    + ORDER_NAMES
    + """
SELECT o.o_orderkey, printf('Order #%d $%.2f: %s', o.o_orderkey, o.o_totalprice, n.part_names) AS line
FROM orders o JOIN names n ON o.o_orderkey = n.ok
"""
)

COLOURS = """
c AS (
  SELECT CAST(l_partkey % 256 AS INTEGER) AS R, CAST((l_suppkey * 5) % 256 AS INTEGER) AS G,
         CAST(l_orderkey % 256 AS INTEGER) AS B, l_returnflag AS word
  FROM lineitem)
"""


def _d(v: float) -> str:
    return f"CAST({float(v)!r} AS DOUBLE)"


def _lab_sql() -> str:
    """CIE LAB from its definition: relative XYZ as a matrix product over the 256 possible byte
    values' linear light, looked up in a table of byte values."""
    light = (f"CASE WHEN v / {_d(255)} <= {_d(C.SRGB_THRESHOLD)} THEN v / {_d(255 * C.SRGB_LINEAR_SLOPE)} "
             f"ELSE pow((v / {_d(255)} + {_d(C.SRGB_OFFSET)}) / {_d(C.SRGB_SCALE)}, {_d(C.SRGB_GAMMA)}) END")
    relative = [[_d(m / w) for m in row] for row, w in zip(C.XYZ_FROM_RGB, C.WHITE_D65)]
    matrix = "[" + ", ".join("[" + ", ".join(row) + "]" for row in relative) + "]"
    cube = f"CASE WHEN t <= {_d(C.LAB_EPSILON)} THEN {_d(C.LAB_KAPPA_SLOPE)} * t + {_d(C.LAB_OFFSET)} ELSE cbrt(t) END"
    return f"""
bytes AS (SELECT v, {light} AS light FROM range(256) AS byte_values(v)),
colour AS (
  SELECT c.R, c.G, c.B, [red.light, green.light, blue.light] AS light
  FROM (SELECT DISTINCT R, G, B FROM c) c
  JOIN bytes red ON red.v = c.R JOIN bytes green ON green.v = c.G JOIN bytes blue ON blue.v = c.B),
axes AS (
  SELECT R, G, B, axis, list_dot_product({matrix}[axis], light) AS t FROM colour, range(1, 4) AS axis_numbers(axis)),
cubes AS (
  SELECT R, G, B, max({cube}) FILTER (axis = 1) AS x, max({cube}) FILTER (axis = 2) AS y, max({cube}) FILTER (axis = 3) AS z
  FROM axes GROUP BY R, G, B),
lab AS (
  SELECT c.*, {_d(116)} * y - {_d(16)} AS labL, {_d(500)} * (x - y) AS labA, {_d(200)} * (y - z) AS labB
  FROM c JOIN cubes USING (R, G, B))
"""


def _hsv_sql() -> str:
    """Hue in degrees by the usual three-case definition, straight from the bytes."""
    return f"""
edges AS (SELECT *, greatest(R, G, B) AS hi, least(R, G, B) AS lo FROM c)
SELECT R, G, B, word,
       round(CASE WHEN hi = lo THEN {_d(0)}
                  WHEN hi = R THEN (CASE WHEN G < B THEN 360 ELSE 0 END + 60 * (G - B) / CAST(hi - lo AS DOUBLE)) / {_d(360)}
                  WHEN hi = G THEN (120 + 60 * (B - R) / CAST(hi - lo AS DOUBLE)) / {_d(360)}
                  ELSE (240 + 60 * (R - G) / CAST(hi - lo AS DOUBLE)) / {_d(360)} END, 6) AS H,
       round(CASE WHEN hi = 0 THEN {_d(0)} ELSE (hi - lo) / CAST(hi AS DOUBLE) END, 6) AS S,
       round(hi / {_d(255)}, 6) AS V
FROM edges
"""


def _roundtrip_sql() -> str:
    inv = "CASE WHEN {v} > {t} THEN pow({v}, {three}) ELSE ({v} - {o}) / {k} END".format(
        v="{v}", t=_d(C.LAB_INVERSE_THRESHOLD), three=_d(3.0), o=_d(C.LAB_OFFSET), k=_d(C.LAB_KAPPA_SLOPE)
    )
    gam = (
        "least(greatest(CASE WHEN {v} > {t} THEN {s} * pow({v}, {ig}) - {o} ELSE {v} * {k} END, {z}), {one})"
    ).format(
        v="{v}", t=_d(C.SRGB_INVERSE_THRESHOLD), s=_d(C.SRGB_SCALE), ig=_d(1.0 / C.SRGB_GAMMA),
        o=_d(C.SRGB_OFFSET), k=_d(C.SRGB_LINEAR_SLOPE), z=_d(0.0), one=_d(1.0),
    )
    wx, wy, wz = C.WHITE_D65
    lin = [
        f"xx * {_d(r[0])} + yy * {_d(r[1])} + zz * {_d(r[2])}" for r in C.RGB_FROM_XYZ
    ]
    return f"""
f AS (SELECT R, G, B, (labL + {_d(16.0)}) / {_d(116.0)} AS fy, labA, labB FROM lab),
f2 AS (SELECT R, G, B, fy, labA / {_d(500.0)} + fy AS fx, greatest(fy - labB / {_d(200.0)}, {_d(0.0)}) AS fz FROM f),
x AS (SELECT R, G, B, ({inv.format(v='fx')}) * {_d(wx)} AS xx, ({inv.format(v='fy')}) * {_d(wy)} AS yy,
             ({inv.format(v='fz')}) * {_d(wz)} AS zz FROM f2),
l AS (SELECT R, G, B, {lin[0]} AS lr, {lin[1]} AS lg, {lin[2]} AS lb FROM x)
SELECT R, G, B, round({gam.format(v='lr')} * {_d(255.0)}, 4) AS R2,
       round({gam.format(v='lg')} * {_d(255.0)}, 4) AS G2,
       round({gam.format(v='lb')} * {_d(255.0)}, 4) AS B2
FROM l
"""


_LINEFIT = """
SELECT CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n,
       round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 6) AS intercept
FROM lineitem
"""

_ETL = """
SELECT event_id, user_id, event_type, value - 50.0 AS score
FROM events WHERE contains(event_type, 'e') AND value - 50.0 {op} 0
"""

ORACLE_SQL = {
    "word_count": f"SELECT word, count(*) AS n FROM ({WORDS}) GROUP BY word",
    "word_count_lines": f"SELECT word || ' ' || CAST(count(*) AS VARCHAR) AS line FROM ({WORDS}) GROUP BY word",
    "group_average": """
SELECT event_type, count(value) AS n, round(sum(value), 2) AS total, round(avg(value), 6) AS mean
FROM events GROUP BY event_type
""",
    "hourly_max": f"WITH {PAGECOUNTS} SELECT hour, greatest(0, max(views)) AS max_views FROM pc GROUP BY hour",
    "hourly_top_one": f"""
WITH {PAGECOUNTS}
SELECT hour, views, title FROM (
  SELECT *, row_number() OVER (PARTITION BY hour ORDER BY views DESC, title DESC) AS rn FROM pc)
WHERE rn = 1
""",
    "hourly_top_ties": f"""
WITH {PAGECOUNTS}, m AS (SELECT hour, max(views) AS mv FROM pc GROUP BY hour)
SELECT pc.hour, pc.title, pc.views FROM pc JOIN m ON pc.hour = m.hour AND pc.views = m.mv
""",
    "etl_positive": _ETL.format(op=">"),
    "etl_negative": _ETL.format(op="<"),
    "etl_split": f"""
SELECT *, 'positive' AS part FROM ({_ETL.format(op='>')})
UNION ALL
SELECT *, 'negative' AS part FROM ({_ETL.format(op='<')})
""",
    "flagged_projection": """
SELECT p_partkey, p_brand, p_size / 10 AS size_tenths FROM part
WHERE p_name IS NOT NULL AND starts_with(p_brand, 'Brand#1') AND p_type = 'ECONOMY'
""",
    "weather_etl": f"""
WITH {OBSERVATIONS}
SELECT station, date, value / 10 AS tmax FROM obs
WHERE qflag IS NULL AND starts_with(station, 'U1') AND observation = 'TMAX'
""",
    "loaded_logs": f"WITH {LOGS} SELECT host, datetime, path, bytes, CAST(36 AS INTEGER) AS id_length FROM logs",
    "loaded_logs_total_bytes": f"WITH {LOGS} SELECT CAST(sum(bytes) AS BIGINT) AS total_bytes FROM logs",
    "relative_score": """
WITH m AS (SELECT event_type, avg(value) AS mean FROM events GROUP BY event_type HAVING avg(value) > 0)
SELECT e.event_id, e.user_id, e.event_type, round(e.value / m.mean, 6) AS relative_score
FROM events e JOIN m ON e.event_type = m.event_type
""",
    "daily_range_max": f"""
WITH {OBSERVATIONS}
SELECT r.date, r.station, printf('%.2f', r.rng) AS "range"
FROM ranged r JOIN best b ON r.date = b.date AND r.rng = b.max_rng
""",
    "daily_range_max_sql": f"""
WITH {OBSERVATIONS}
SELECT r.date, r.station, round(r.rng, 3) AS "range"
FROM ranged r JOIN best b ON r.date = b.date AND r.rng = b.max_rng
""",
    "access_log_parse": f"WITH {LOGS} SELECT host, id, datetime, path, bytes FROM logs",
    "log_correlation": f"WITH {LOGS}, {CORRELATION}",
    "shortest_hops": f"""
WITH RECURSIVE {GRAPH}
SELECT d.node, par.parent, CAST(d.dist AS INTEGER) AS dist FROM d LEFT JOIN par ON par.node = d.node
""",
    "shortest_route": f"""
WITH RECURSIVE {GRAPH},
tree(node, route) AS (
  SELECT CAST(1 AS BIGINT), CAST('1' AS VARCHAR)
  UNION ALL
  SELECT par.node, tree.route || ' ' || CAST(par.node AS VARCHAR) FROM par JOIN tree ON par.parent = tree.node)
SELECT t.node, CAST(d.dist AS INTEGER) AS dist, t.route FROM tree t JOIN d ON d.node = t.node
""",
    "order_lines": ORDER_LINES,
    "orders_denormalized": "WITH "
    + ORDER_NAMES
    + """
SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate, o.o_orderpriority,
       n.part_names
FROM orders o JOIN names n ON o.o_orderkey = n.ok
""",
    "order_lines_denorm": ORDER_LINES,
    "upsert_orders": """
WITH u AS (
  SELECT *, 0 AS seq FROM orders
  UNION ALL
  SELECT o_orderkey, o_custkey, 'F', o_totalprice + 100.0, o_orderdate, o_orderpriority, 1
  FROM orders WHERE o_orderstatus = 'O')
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY seq DESC) AS rn FROM u)
WHERE rn = 1
""",
    "upsert_versions": """
SELECT o_orderkey, version, price FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY version DESC, price DESC) AS place FROM (
    SELECT o_orderkey, 2 AS version, o_totalprice AS price FROM orders
    UNION ALL SELECT l_orderkey, CAST(l_linenumber AS INTEGER), l_extendedprice FROM lineitem))
WHERE place = 1
""",
    "global_sums": """
SELECT count(*) FILTER (WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL) AS n,
       round(sum(l_quantity), 2) AS sum_x, round(sum(l_extendedprice), 2) AS sum_y,
       round(sum(l_quantity * l_quantity), 2) AS sum_xx,
       round(sum(l_quantity * l_extendedprice), 2) AS sum_xy
FROM lineitem
""",
    "linear_fit": _LINEFIT,
    "stream_linear_fit": _LINEFIT,
    "rgb_to_lab": "WITH "
    + COLOURS
    + ","
    + _lab_sql()
    + "SELECT R, G, B, word, round(labL, 6) AS labL, round(labA, 6) AS labA, round(labB, 6) AS labB FROM lab",
    "rgb_to_hsv": "WITH " + COLOURS + "," + _hsv_sql(),
    "lab_roundtrip": "WITH " + COLOURS + "," + _lab_sql() + "," + _roundtrip_sql(),
    "yesterday_pairs": """
WITH daily AS (
  SELECT 'U' || CAST(user_id AS VARCHAR) AS station, CAST(ts AS DATE) AS date,
         CAST(max(value) / 10.0 AS FLOAT) AS tmax
  FROM events GROUP BY user_id, CAST(ts AS DATE))
SELECT t.station, t.date, CAST(dayofyear(t.date) AS INTEGER) AS dayofyear, t.tmax, y.tmax AS yesterday_tmax
FROM daily t JOIN daily y ON t.station = y.station AND y.date + 1 = t.date
""",
    "page_hour_key": """
SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS file_name,
       substr(regexp_extract(url, '([^/]*)$', 1), 12, 11) AS hour
FROM pages
""",
}
_ROUTES = f"""
{GRAPH},
tree(node, route) AS (
  SELECT CAST(1 AS BIGINT), CAST('1' AS VARCHAR)
  UNION ALL
  SELECT par.node, tree.route || ' ' || CAST(par.node AS VARCHAR) FROM par JOIN tree ON par.parent = tree.node),
wanted AS (
  SELECT o_custkey AS target FROM orders WHERE o_orderkey IN (SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5)
  UNION SELECT count(*) FROM customer),
answers AS (SELECT target, coalesce(route, 'NO PATH FOUND') AS route FROM wanted LEFT JOIN tree ON node = target)
"""
ORACLE_SQL["routes_to_dearest"] = f"WITH RECURSIVE {_ROUTES} SELECT target, route FROM answers"
_DEAREST = f"SELECT o_orderkey, line FROM ({ORDER_LINES}) WHERE o_orderkey IN (SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5)"
ORACLE_SQL["order_lines_by_key"] = ORACLE_SQL["order_lines_denorm_by_key"] = _DEAREST
ORACLE_SQL["order_lines_urgent"] = f"SELECT * FROM ({ORDER_LINES}) WHERE o_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')"
ORACLE_SQL["store_merge_orders"] = ORACLE_SQL["upsert_orders"]
ORACLE_SQL["relative_score_broadcast"] = ORACLE_SQL["relative_score"]
ORACLE_SQL["log_table_correlation"] = ORACLE_SQL["log_correlation"]


# ------------------------------------------------ model jobs (oracle)

_DAILY = """
daily AS (
  SELECT 'U' || CAST(user_id AS VARCHAR) AS station, CAST(ts AS DATE) AS date, CAST(max(value) / 10.0 AS FLOAT) AS tmax,
         CASE WHEN md5('123|U' || CAST(user_id AS VARCHAR)) < 'c' THEN 'train' ELSE 'validation' END AS split
  FROM events GROUP BY user_id, CAST(ts AS DATE))
"""

_PALETTE = "palette(word, r0, g0, b0) AS (VALUES " + ", ".join(f"('{w}', {r}, {g}, {b})" for w, (r, g, b) in C.COLOUR_RGB.items()) + ")"

# the nearest word per distinct colour, by ranking all eleven
_COLOUR_WORDS = f"""
{_PALETTE},
rgb AS (
  SELECT CAST(l_partkey % 256 AS INTEGER) AS R, CAST((l_suppkey * 5) % 256 AS INTEGER) AS G, CAST(l_orderkey % 256 AS INTEGER) AS B FROM lineitem),
named AS (
  SELECT R, G, B, word FROM (SELECT DISTINCT R, G, B FROM rgb), palette
  QUALIFY row_number() OVER (PARTITION BY R, G, B ORDER BY (R - r0) ** 2 + (G - g0) ** 2 + (B - b0) ** 2, word) = 1),
words AS (
  SELECT R, G, B, word, CASE WHEN md5(concat_ws('|', 123, R, G, B, word)) < 'c' THEN 'train' ELSE 'validation' END AS split
  FROM rgb JOIN named USING (R, G, B))
"""

_CENTROIDS = """
centroids AS (SELECT word AS label, avg(R) AS r0, avg(G) AS g0, avg(B) AS b0 FROM words WHERE split = 'train' GROUP BY word)
"""


def _lab_grid_sql(n: int = 256, lum: float = 70.0) -> str:
    """The slice's RGB straight from the definition of LAB: the inverse cube, the white point and the gamma curve."""
    cube = (f"CASE WHEN f > {_d(C.LAB_INVERSE_THRESHOLD)} THEN f * f * f ELSE (f - {_d(C.LAB_OFFSET)}) / {_d(C.LAB_KAPPA_SLOPE)} END")
    light = [" + ".join(f"{_d(m * w)} * t[{i + 1}]" for i, (m, w) in enumerate(zip(row, C.WHITE_D65))) for row in C.RGB_FROM_XYZ]
    gamma = (f"255 * least(greatest(CASE WHEN v > {_d(C.SRGB_INVERSE_THRESHOLD)} THEN {_d(C.SRGB_SCALE)} * pow(v, {_d(1 / C.SRGB_GAMMA)}) - {_d(C.SRGB_OFFSET)} "
             f"ELSE v * {_d(C.SRGB_LINEAR_SLOPE)} END, 0), 1)")
    return f"""
cells AS (
  SELECT b.range AS row_index, a.range AS col_index, -100 + a.range * {_d(200 / (n - 1))} AS labA, -100 + b.range * {_d(200 / (n - 1))} AS labB
  FROM range({n}) a, range({n}) b),
linear AS (
  SELECT *, list_transform([{_d((lum + 16) / 116)} + labA / 500, {_d((lum + 16) / 116)}, greatest({_d((lum + 16) / 116)} - labB / 200, 0)], lambda f: {cube}) AS t FROM cells),
grid AS (
  SELECT row_index, col_index, labA, labB, list_transform([{", ".join(light)}], lambda v: {gamma}) AS rgb FROM linear)
"""


ML_ORACLE_SQL = {
    "tmax_split": f"WITH {_DAILY} SELECT station, date, split FROM daily",
    "tmax_persistence": f"""
WITH {_DAILY},
pairs AS (
  SELECT split, CAST(tmax AS DOUBLE) AS y, CAST(before AS DOUBLE) AS p FROM (
    SELECT *, lag(tmax) OVER days AS before, lag(date) OVER days AS day_before FROM daily WINDOW days AS (PARTITION BY station ORDER BY date))
  WHERE day_before + 1 = date)
SELECT split, count(*) AS n, round(1 - sum((y - p) * (y - p)) / (count(*) * var_pop(y)), 6) AS r2, round(sqrt(sum((y - p) * (y - p)) / count(*)), 6) AS rmse
FROM pairs GROUP BY split
""",
    "tmax_tomorrow_inputs": f"""
WITH {_DAILY}
SELECT station, max(date) + 1 AS date, CAST(dayofyear(max(date) + 1) AS INTEGER) AS dayofyear, arg_max(tmax, date) AS yesterday_tmax, true AS predicted
FROM daily GROUP BY station
""",
    "colour_split": f"WITH {_COLOUR_WORDS} SELECT R, G, B, word, split FROM words",
    "colour_label_index": f"""
WITH {_COLOUR_WORDS}
SELECT CAST(row_number() OVER (ORDER BY word) - 1 AS INTEGER) AS label_index, word AS label, [r0, g0, b0] AS rgb
FROM palette WHERE word IN (SELECT word FROM words WHERE split = 'train')
""",
    "colour_centroid_accuracy": f"""
WITH {_COLOUR_WORDS}, {_CENTROIDS},
guessed AS (
  SELECT R, G, B, label FROM (SELECT DISTINCT R, G, B FROM words WHERE split = 'validation'), centroids
  QUALIFY row_number() OVER (PARTITION BY R, G, B ORDER BY (R - r0) * (R - r0) + (G - g0) * (G - g0) + (B - b0) * (B - b0), label) = 1)
SELECT word, count(*) AS n, count(*) FILTER (word = label) AS hits FROM words JOIN guessed USING (R, G, B) WHERE split = 'validation' GROUP BY word
""",
    "colour_grid_centroid": f"""
WITH {_COLOUR_WORDS}, {_CENTROIDS}, {_lab_grid_sql()},
guessed AS (
  SELECT row_index, col_index, labA, labB, rgb, label FROM grid, centroids
  QUALIFY row_number() OVER (PARTITION BY row_index, col_index ORDER BY (rgb[1] - r0) ** 2 + (rgb[2] - g0) ** 2 + (rgb[3] - b0) ** 2, label) = 1)
SELECT row_index, col_index, round(labA, 4) AS labA, round(labB, 4) AS labB, round(rgb[1], 4) AS R, round(rgb[2], 4) AS G, round(rgb[3], 4) AS B,
       label AS predicted_word, [p.r0, p.g0, p.b0] AS predicted_rgb
FROM guessed JOIN palette p ON p.word = label
""",
}


# ------------------------------------------------ file-level queries (oracle)

_COMMENTS = """
c AS (SELECT 'u' || CAST(user_id AS VARCHAR) AS author, CAST(floor(value) AS BIGINT) - 35 AS score,
             event_type AS subreddit FROM events)
"""

_PAGE_LINES = """
pl AS (
  SELECT strftime(ts, '%Y%m%d-%H') AS hour,
         CASE WHEN event_type = 'signup' THEN 'fr' ELSE 'en' END AS language,
         CASE WHEN event_type = 'error' THEN 'Special:Error_' || CAST(user_id AS VARCHAR)
              WHEN event_type = 'click' THEN 'Main_Page'
              ELSE event_type || '_' || CAST(user_id AS VARCHAR) END AS title,
         count(*) AS views
  FROM events GROUP BY 1, 2, 3),
f AS (SELECT * FROM pl WHERE language = 'en' AND title <> 'Main_Page' AND NOT starts_with(title, 'Special:'))
"""

FILE_ORACLE_SQL = {
    "file_word_count": ORACLE_SQL["word_count_lines"],
    "file_group_average": f"WITH {_COMMENTS} SELECT subreddit, round(avg(score), 6) AS average FROM c GROUP BY subreddit",
    "file_comment_split": f"""
WITH {_COMMENTS}
SELECT author, score, subreddit, CASE WHEN score > 0 THEN 'positive' ELSE 'negative' END AS part
FROM c WHERE contains(subreddit, 'e') AND score <> 0
""",
    "file_relative_score": f"""
WITH {_COMMENTS}, m AS (SELECT subreddit, avg(score) AS mean FROM c GROUP BY subreddit HAVING avg(score) > 0)
SELECT c.author, round(c.score / m.mean, 6) AS relative FROM c JOIN m ON c.subreddit = m.subreddit
""",
    "file_hourly_max_views": f"""
WITH {_PAGE_LINES}
SELECT hour || chr(9) || CAST(greatest(0, max(views)) AS VARCHAR) AS line FROM f GROUP BY hour
""",
    "file_hourly_top_page": f"""
WITH {_PAGE_LINES}
SELECT hour || chr(9) || '[' || CAST(views AS VARCHAR) || ', ''' || title || ''']' AS line
FROM (SELECT *, row_number() OVER (PARTITION BY hour ORDER BY views DESC, title DESC) AS rn FROM f)
WHERE rn = 1
""",
    "file_hourly_top_pages": f"""
WITH {_PAGE_LINES}, m AS (SELECT hour, max(views) AS mv FROM f GROUP BY hour)
SELECT f.hour, f.title, f.views FROM f JOIN m ON f.hour = m.hour AND f.views = m.mv
""",
    "file_weather_etl": ORACLE_SQL["weather_etl"],
    "file_temp_range": ORACLE_SQL["daily_range_max"],
    "file_temp_range_sql": ORACLE_SQL["daily_range_max_sql"],
    "file_correlate_logs": ORACLE_SQL["log_correlation"],
    "file_load_logs": ORACLE_SQL["loaded_logs"],
    "file_order_lines": f"SELECT line FROM ({ORDER_LINES})",
    "file_order_lines_denormalized": f"SELECT line FROM ({ORDER_LINES})",
    "file_stream_regression": _LINEFIT,
    "stream_store_totals": f"WITH {LOGS} SELECT host, count(*) AS n, CAST(sum(bytes) AS BIGINT) AS total FROM logs GROUP BY host",
    "file_shortest_routes": f"WITH RECURSIVE {_ROUTES} SELECT CAST(target AS VARCHAR) || ': ' || route AS line FROM answers",
    "file_shortest_path": f"""
WITH RECURSIVE {GRAPH}
SELECT printf('(%d, (%s, %d))', d.node, coalesce(CAST(par.parent AS VARCHAR), '-'), d.dist) AS line
FROM d LEFT JOIN par ON par.node = d.node
""",
}

FILE_ORACLE_SQL["file_hourly_top_pages_by_name"] = FILE_ORACLE_SQL["file_hourly_top_pages"]
FILE_ORACLE_SQL["file_comment_quarantine"] = f"""
WITH {_COMMENTS}
SELECT author, score, subreddit, CAST(NULL AS VARCHAR) AS broken_line, 'good' AS part FROM c WHERE subreddit <> 'error'
UNION ALL
SELECT NULL, NULL, NULL, left('{{{{"author":"u' || CAST(user_id AS VARCHAR) || '","id":"' || CAST(event_id AS VARCHAR) || '"', 20), 'broken'
FROM events WHERE event_type = 'error'
""".replace("{{", "{").replace("}}", "}")
FILE_ORACLE_SQL["file_broken_log_lines"] = f"WITH {LOGS} SELECT value AS broken_line FROM lines WHERE NOT regexp_matches(value, '{_P}')"
FILE_ORACLE_SQL["file_order_audit"] = "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{job}' AS job, count(*) AS n, CAST(0 AS BIGINT) AS inversions FROM ({sql})" for job, sql in (
        ("word_count", FILE_ORACLE_SQL["file_word_count"]), ("hourly_top_pages", FILE_ORACLE_SQL["file_hourly_top_pages"]),
        ("relative_score", FILE_ORACLE_SQL["file_relative_score"]), ("temp_range", FILE_ORACLE_SQL["file_temp_range"]))) + ")"
