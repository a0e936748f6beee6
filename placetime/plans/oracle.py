"""SQL building blocks for the DuckDB twins of the registered queries.

Only the raw test tables exist on the SQL side, so the adapter views are
spelled out as CTEs.  The keyed draw is the same function in both engines:
the first 8 hex digits of md5(seed|key) as an unsigned 32-bit integer,
divided by 2^32.
"""

from __future__ import annotations

from ..roles import DAY_ALIASES, DAY_NAMES, LAT_LOW, LAT_WIDTH, LON_LOW, LON_WIDTH


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def word(seed: str, *keys: str) -> str:
    parts = " || '|' || ".join([q(seed)] + [f"CAST({k} AS VARCHAR)" for k in keys])
    return f"('0x' || substr(md5({parts}), 1, 8))::BIGINT"


def u(seed: str, *keys: str) -> str:
    return f"({word(seed, *keys)} / 4294967296.0::DOUBLE)"


def kint(seed: str, n: int, *keys: str) -> str:
    return f"CAST(floor({u(seed, *keys)} * {int(n)}) AS INTEGER)"


def krange(seed: str, low: float, width: float, *keys: str) -> str:
    return f"({float(low)!r}::DOUBLE + {float(width)!r}::DOUBLE * {u(seed, *keys)})"


DAY_LIST = "[" + ", ".join(q(d) for d in DAY_NAMES) + "]"


def dayname(ts: str) -> str:
    return f"({DAY_LIST})[isodow({ts})]"


def keyed_day(seed: str, key: str) -> str:
    return f"({DAY_LIST})[{kint(seed, 7, key)} + 1]"


def normalize_day(c: str) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in DAY_ALIASES.items())
    return f"(CASE lower(trim({c})) {whens} END)"


def time_band(h: str) -> str:
    return (f"(CASE WHEN {h} >= 5 AND {h} < 12 THEN 'Morning' WHEN {h} >= 12 AND {h} < 17 THEN 'Afternoon' "
            f"WHEN {h} >= 17 AND {h} < 21 THEN 'Evening' ELSE 'Night' END)")


def intensity(h: str) -> str:
    return (f"(CASE WHEN {h} > -1 AND {h} <= 8 THEN 'Low' WHEN {h} > 8 AND {h} <= 16 THEN 'Medium' "
            f"WHEN {h} > 16 AND {h} <= 23 THEN 'High' END)")


def hsin(h: str) -> str:
    return f"sin(6.283185307179586::DOUBLE * {h} / 24.0::DOUBLE)"


def hcos(h: str) -> str:
    return f"cos(6.283185307179586::DOUBLE * {h} / 24.0::DOUBLE)"


def code(c: str, domain) -> str:
    whens = " ".join(f"WHEN {q(v)} THEN {float(i)!r}::DOUBLE" for i, v in enumerate(domain))
    return f"(CASE {c} {whens} END)"


def clip_hour(x: str) -> str:
    return f"CAST(trunc(least(greatest({x}, 0.0::DOUBLE), 23.0::DOUBLE)) AS INTEGER)"


def nearest(lat: str, lon: str, centers) -> str:
    """Index of the nearest center, lowest index on ties (struct order)."""
    items = []
    for i, (a, b) in enumerate(centers):
        d = f"({lat} - {float(a)!r}::DOUBLE) * ({lat} - {float(a)!r}::DOUBLE) + ({lon} - {float(b)!r}::DOUBLE) * ({lon} - {float(b)!r}::DOUBLE)"
        items.append(f"{{'d': {d}, 'id': {i}}}")
    return f"CAST(list_min([{', '.join(items)}]).id AS INTEGER)"


def lat_expr(key: str) -> str:
    return krange("lat", LAT_LOW, LAT_WIDTH, key)


def lon_expr(key: str) -> str:
    return krange("lon", LON_LOW, LON_WIDTH, key)


INCIDENTS = f"""incidents AS (
  SELECT event_id AS key, event_type AS category, CAST(hour(ts) AS INTEGER) AS hour,
         {dayname('ts')} AS day, {lat_expr('event_id')} AS lat, {lon_expr('event_id')} AS lon
  FROM events)"""

INCIDENTS_WIDE = f"""incidents_wide AS (
  SELECT event_id AS key, json_extract_string(props, '$.k') AS category, CAST(hour(ts) AS INTEGER) AS hour,
         {dayname('ts')} AS day, {lat_expr('event_id')} AS lat, {lon_expr('event_id')} AS lon
  FROM events)"""

_FORM = kint("dayform", 6, "event_id")
INCIDENTS_RAW = f"""incidents_raw AS (
  SELECT event_id AS key, event_type AS category, value / 4.0::DOUBLE - 2.0::DOUBLE AS hour_raw,
         CASE WHEN {u('latna', 'event_id')} >= 0.05::DOUBLE THEN {lat_expr('event_id')} END AS lat_raw,
         {lon_expr('event_id')} AS lon,
         CASE {_FORM} WHEN 0 THEN d WHEN 1 THEN lower(substr(d, 1, 3)) WHEN 2 THEN upper(d)
              WHEN 3 THEN ' ' || substr(d, 1, 4) || ' ' WHEN 5 THEN 'x' || lower(d) END AS day_raw
  FROM (SELECT *, {dayname('ts')} AS d FROM events))"""

INCIDENTS_PLACE = f"""incidents_place AS (
  SELECT o_orderkey AS key, o_orderpriority AS category, r_name AS region, n_name AS nation,
         {kint('hour', 24, 'o_orderkey')} AS hour, {lat_expr('o_orderkey')} AS lat, {lon_expr('o_orderkey')} AS lon
  FROM orders JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

PREDICTIONS = """predictions AS (
  SELECT doc_id AS key, CAST(quality AS VARCHAR) AS label, CAST(toxic AS VARCHAR) AS prediction FROM labels)"""

HOURS = "hours AS (SELECT CAST(range AS INTEGER) AS hour FROM range(24))"


def kmeans(seed: int = 42, restarts: int = 10, most: int = 6, tolerance: float = 1e-4, fixed: float = 1e-16, rounds: int = 300) -> str:
    """CTEs of the clustering of ``incidents``: seeding, the rounds of all restarts, the best one's further rounds.

    ``centers`` (cluster, lat, lon) and ``cost`` are its results; needs WITH RECURSIVE.
    """
    far = "((p.lat - c.lat) * (p.lat - c.lat) + (p.lon - c.lon) * (p.lon - c.lon))"

    def draw(step: int) -> str:
        return f"-ln(1.0::DOUBLE - ('0x' || substr(md5('km{seed}-{step}-' || (r // 4) || '|' || key), 8 * (r % 4) + 1, 8))::BIGINT / 4294967296.0::DOUBLE)"

    def settle(name: str, start: str, limit: str) -> str:
        return f"""{name} AS (
  SELECT 0 AS i, r, c, lat, lon, 1e300::DOUBLE AS move FROM {start}
  UNION ALL
  SELECT i, r, c, lat, lon, sum(m) OVER (PARTITION BY r) AS move FROM (
    SELECT c.i + 1 AS i, c.r, c.c, coalesce(n.lat, c.lat) AS lat, coalesce(n.lon, c.lon) AS lon,
           coalesce((n.lat - c.lat) * (n.lat - c.lat) + (n.lon - c.lon) * (n.lon - c.lon), 0) AS m
    FROM {name} c LEFT JOIN (
      SELECT r, c, avg(lat) AS lat, avg(lon) AS lon FROM (
        SELECT c.r, p.key, p.lat, p.lon, arg_min(c.c, {{'d': {far}, 'c': c.c}}) AS c FROM points p, {name} c WHERE c.move > {limit}
        GROUP BY c.r, p.key, p.lat, p.lon) GROUP BY r, c) n ON n.r = c.r AND n.c = c.c
    WHERE c.move > {limit} AND c.i < {rounds}))"""

    steps = ["points AS MATERIALIZED (SELECT key, lat, lon FROM incidents)",
             f"""seed0 AS MATERIALIZED (SELECT r, 0 AS c, p.lat AS lat, p.lon AS lon FROM (
  SELECT r, arg_min({{'lat': lat, 'lon': lon}}, {{'s': {draw(0)}, 'key': key}}) AS p FROM points, (SELECT range AS r FROM range({restarts})) GROUP BY r))"""]
    for j in range(1, most):
        steps.append(f"""seed{j} AS MATERIALIZED (SELECT * FROM seed{j - 1} UNION ALL SELECT r, {j}, p.lat, p.lon FROM (
  SELECT r, arg_min({{'lat': lat, 'lon': lon}}, {{'s': {draw(j)} / w, 'key': key}}) AS p
  FROM (SELECT c.r, p.key, p.lat, p.lon, min({far}) AS w FROM points p, seed{j - 1} c GROUP BY ALL) WHERE w > 0 GROUP BY r))""")
    steps.append(f"""seeds AS MATERIALIZED (
  SELECT * FROM seed{most - 1} WHERE c < (SELECT least(least({most}, greatest(2, count(*) // 250 + 2)), count(*)) FROM points))""")
    steps.append(settle("lloyd", "seeds", f"(SELECT {tolerance!r}::DOUBLE * (var_pop(lat) + var_pop(lon)) / 2 FROM points)"))
    steps.append("settled AS MATERIALIZED (SELECT r, c, lat, lon FROM lloyd QUALIFY i = max(i) OVER (PARTITION BY r))")
    steps.append(f"""best AS MATERIALIZED (SELECT * FROM settled WHERE r = (
  SELECT r FROM (SELECT c.r, p.key, min({far}) AS d FROM points p, settled c GROUP BY c.r, p.key) GROUP BY r ORDER BY sum(d), r LIMIT 1))""")
    steps.append(settle("polish", "best", f"{fixed!r}::DOUBLE"))
    steps.append("""centers AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY lat, lon) - 1 AS INTEGER) AS cluster, lat, lon
  FROM (SELECT * FROM polish QUALIFY i = max(i) OVER ()))""")
    steps.append(f"""near AS MATERIALIZED (SELECT p.key, arg_min(c.cluster, {{'d': {far}, 'c': c.cluster}}) AS cluster, min({far}) AS d
  FROM points p, centers c GROUP BY p.key)""")
    return ",\n".join(steps)


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
