"""The demonstration views as SQL common table expressions."""

B = r"""b AS (SELECT event_id, user_id AS uid, date_trunc('second', ts) AS ts, cast(regexp_extract(props, '(\d+)', 1) AS INTEGER) AS k, event_type FROM events)"""

BRONZE = (
    B
    + """, raw0 AS (SELECT event_id, cast(ts AS DATE) AS date,
  CASE WHEN event_id % 101 <> 0 THEN sha256(cast(uid AS VARCHAR)) END AS user_id,
  CASE WHEN event_id % 103 = 0 THEN NULL WHEN event_id % 89 = 0 THEN 'not a time' WHEN event_id % 107 = 0 THEN strftime(ts + INTERVAL 2 DAY, '%Y-%m-%d %H:%M:%S') ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS tss,
  CASE WHEN event_id % 79 = 0 THEN NULL WHEN event_id % 83 = 0 THEN 5 WHEN event_type = 'error' THEN 310 ELSE 214 END AS mcc,
  CASE WHEN event_id % 79 = 0 THEN NULL WHEN event_id % 73 = 0 THEN '1' ELSE '01' END AS mnc,
  CASE WHEN event_id % 79 = 0 THEN NULL WHEN event_id % 71 = 0 THEN 999999 WHEN event_type = 'signup' THEN 20801 END AS plmn,
  CASE WHEN event_id % 97 <> 0 THEN '2140100000' || lpad(cast(k AS VARCHAR), 4, '0') END AS cell_id,
  CASE WHEN event_id % 97 <> 0 THEN 40.0 + (k // 10) * 0.01::DOUBLE END AS latitude,
  CASE WHEN event_id % 97 <> 0 THEN -4.0 + (k % 10) * 0.01::DOUBLE END AS longitude FROM b),
raw AS (SELECT * FROM raw0 UNION ALL SELECT event_id + 1000000000, date, user_id, tss, mcc, mnc, plmn, cell_id, latitude, longitude FROM raw0 WHERE event_id % 61 = 0),
par AS (SELECT *, CASE WHEN tss = 'not a time' THEN NULL ELSE cast(tss AS TIMESTAMP) END AS t,
  CASE WHEN plmn IS NOT NULL AND substr(cast(plmn AS VARCHAR), 1, 3) <> '214' THEN 'outbound' WHEN mcc = 214 THEN 'domestic' ELSE 'inbound' END AS domain FROM raw),
fl AS (SELECT *,
  user_id IS NULL AS user_id_flag_1, tss IS NULL AS timestamp_flag_1, mcc IS NULL AS mcc_flag_1, mnc IS NULL AS mnc_flag_1,
  tss IS NOT NULL AND t IS NULL AS timestamp_flag_4,
  coalesce(NOT mcc BETWEEN 100 AND 999, false) AS mcc_flag_2, coalesce(NOT plmn BETWEEN 10000 AND 99999, false) AS plmn_flag_2,
  coalesce(length(mnc) NOT BETWEEN 2 AND 3, false) AS mnc_flag_2,
  coalesce(NOT t BETWEEN date AND date + INTERVAL 1 DAY, false) AS timestamp_flag_2,
  mcc IS NULL AND mnc IS NULL AND plmn IS NULL AS no_mno_info_flag_5,
  domain IN ('domestic', 'inbound') AND cell_id IS NULL AND latitude IS NULL AND longitude IS NULL AS no_location_flag_6,
  user_id IS NOT NULL AND row_number() OVER w > 1 AND lag(t) OVER w IS NOT DISTINCT FROM t AND lag(cell_id) OVER w IS NOT DISTINCT FROM cell_id
    AND lag(latitude) OVER w IS NOT DISTINCT FROM latitude AND lag(longitude) OVER w IS NOT DISTINCT FROM longitude AND lag(plmn) OVER w IS NOT DISTINCT FROM plmn AS duplicated_flag_7
  FROM par WINDOW w AS (PARTITION BY user_id ORDER BY t NULLS FIRST, cell_id NULLS FIRST, latitude NULLS FIRST, longitude NULLS FIRST, plmn NULLS FIRST, event_id)),
flagged AS (SELECT *, NOT (user_id_flag_1 OR timestamp_flag_1 OR mcc_flag_1 OR mnc_flag_1 OR timestamp_flag_4 OR mcc_flag_2 OR plmn_flag_2 OR mnc_flag_2 OR timestamp_flag_2 OR no_mno_info_flag_5 OR no_location_flag_6 OR duplicated_flag_7) AS to_preserve FROM fl)"""
)

EV = (
    B
    + """, ev AS (SELECT event_id, uid AS user_id, ts, cast(epoch(ts) AS BIGINT) AS t, cast(ts AS DATE) AS date, k, CASE WHEN event_type = 'error' THEN 310 ELSE 214 END AS mcc, CASE WHEN event_type = 'signup' THEN 20801 END AS plmn,
  CASE event_type WHEN 'signup' THEN 'outbound' WHEN 'error' THEN 'inbound' ELSE 'domestic' END AS domain, 'C' || lpad(cast(k AS VARCHAR), 2, '0') AS cell_id,
  CASE WHEN event_id % 2 = 0 THEN (k // 10) * 9.0::DOUBLE - 40.0 END AS latitude, CASE WHEN event_id % 2 = 0 THEN (k % 10) * 18.0::DOUBLE - 80.0 END AS longitude, cast(uid % 8 AS INTEGER) AS user_id_modulo FROM b),
net AS (SELECT 'C' || lpad(cast(k AS VARCHAR), 2, '0') AS cell_id, (k // 10) * 9.0::DOUBLE - 40.0 AS lat, (k % 10) * 18.0::DOUBLE - 80.0 AS lon, DATE '2024-01-01' + cast(k % 7 AS INTEGER) AS vs, CASE WHEN k % 3 <> 0 THEN TIMESTAMP '2024-01-25' END AS ve
  FROM range(100) r(k) WHERE k % 33 <> 5)"""
)


def haversine(a: str, b: str, c: str, d: str) -> str:
    x = f"power(sin(radians({c} - {a}) / 2), 2) + cos(radians({a})) * cos(radians({c})) * power(sin(radians({d} - {b}) / 2), 2)"
    return f"2 * 6371008.8 * asin(sqrt(CASE WHEN {x} > 1 THEN 1.0 ELSE {x} END))"


TILES = """tl AS (SELECT cast(k AS INTEGER) AS k, cast(((k // 10) << 16) + k % 10 AS INTEGER) AS grid_id, 4000000 + (k // 10) * 100 + 50.0::DOUBLE AS x, 3000000 + (k % 10) * 100 + 50.0::DOUBLE AS y FROM range(100) r(k))"""

FOOT = (
    TILES
    + """, cl AS (SELECT k, 'C' || lpad(cast(k AS VARCHAR), 2, '0') AS cell_id, x, y, cast(30 + k % 20 AS DOUBLE) AS z, 150 + k % 3 * 50 AS rng,
  CASE WHEN k % 2 = 0 THEN 'macrocell' WHEN k % 5 = 1 THEN 'microcell' ELSE 'other' END AS cell_type, CASE WHEN k % 7 <> 0 THEN cast(5 + k % 10 AS DOUBLE) END AS power0 FROM tl),
ci AS (SELECT *, coalesce(power0, CASE WHEN cell_type = 'macrocell' THEN 10.0 ELSE 5.0 END) AS power, CASE WHEN cell_type = 'microcell' THEN 6.0::DOUBLE ELSE 3.75::DOUBLE END AS ple FROM cl),
ft AS (SELECT c.cell_id, t.grid_id, sqrt(power(c.x - t.x, 2) + power(c.y - t.y, 2)) AS distance, 10 * log10(c.power) + 30 - c.ple * 10 * log10(sqrt(power(c.x - t.x, 2) + power(c.y - t.y, 2) + power(c.z, 2))) AS s
  FROM ci c JOIN tl t ON sqrt(power(c.x - t.x, 2) + power(c.y - t.y, 2)) <= c.rng),
sd AS (SELECT *, 1 / (1 + exp(-(s + 92.5) * 0.2)) AS sd FROM ft)"""
)

def _strewn(i: str, first: int) -> str:
    return "(" + " + ".join(f"((({i}) >> {2 * b + first}) & 1) * {1 << b}" for b in range(16)) + ")"


#: Tiles and cells from tables: a tile for each customer, a cell for each part.
GROUND = f"""tl AS (SELECT c_custkey AS k, cast(CASE WHEN e >= 32768 THEN (e << 16) + n - 4294967296 ELSE (e << 16) + n END AS INTEGER) AS grid_id, 4000000 + e * 100 + 50.0::DOUBLE AS x, 3000000 + n * 100 + 50.0::DOUBLE AS y, CASE WHEN c_custkey % 6 <> 0 THEN c_custkey * 7 % 20 ELSE 0 END AS z
  FROM (SELECT c_custkey, {_strewn('c_custkey', 0)} AS e, {_strewn('c_custkey', 1)} AS n FROM customer))"""
FOOT_GROUND = (
    GROUND
    + f""", cl AS (SELECT k, 'P' || lpad(cast(k AS VARCHAR), 9, '0') AS cell_id, 4000000 + {_strewn('i', 0)} * 100 + 50.0::DOUBLE AS x, 3000000 + {_strewn('i', 1)} * 100 + 50.0::DOUBLE AS y, cast(30 + k % 20 + CASE WHEN k % 5 <> 0 THEN k % 15 ELSE 0 END AS DOUBLE) AS z, 150 + k % 3 * 50 AS rng,
  CASE WHEN k % 2 = 0 THEN 'macrocell' WHEN k % 5 = 1 THEN 'microcell' ELSE 'other' END AS cell_type, CASE WHEN k % 7 <> 0 THEN cast(5 + k % 10 AS DOUBLE) END AS power0 FROM (SELECT p_partkey AS k, p_partkey * 3 // 4 AS i FROM part)),
ci AS (SELECT *, coalesce(power0, CASE WHEN cell_type = 'macrocell' THEN 10.0 ELSE 5.0 END) AS power, CASE WHEN cell_type = 'microcell' THEN 6.0::DOUBLE ELSE 3.75::DOUBLE END AS ple FROM cl),
ft AS (SELECT c.cell_id, t.grid_id, sqrt(power(c.x - t.x, 2) + power(c.y - t.y, 2)) AS distance, 10 * log10(c.power) + 30 - c.ple * 10 * log10(sqrt(power(c.x - t.x, 2) + power(c.y - t.y, 2) + power(c.z - t.z, 2))) AS s
  FROM ci c JOIN tl t ON t.x BETWEEN c.x - 300 AND c.x + 300 AND t.y BETWEEN c.y - 300 AND c.y + 300 AND sqrt(power(c.x - t.x, 2) + power(c.y - t.y, 2)) <= c.rng),
sd AS (SELECT *, 1 / (1 + exp(-(s + 92.5) * 0.2)) AS sd FROM ft)"""
)

_SHARE = """, cp AS (SELECT *, sd / sum(sd) OVER (PARTITION BY grid_id) AS p FROM sd), po AS (SELECT *, p / sum(p) OVER (PARTITION BY cell_id) AS post FROM cp)"""
CONN_GROUND = FOOT_GROUND + _SHARE
CONN = FOOT + """, cp AS (SELECT *, sd / sum(sd) OVER (PARTITION BY grid_id) AS p FROM sd), po AS (SELECT *, p / sum(p) OVER (PARTITION BY cell_id) AS post FROM cp)"""

ZONES = """zn AS (SELECT t.k, t.grid_id, r_name || '|' || n_name || '|' || cast(t.k AS VARCHAR) AS hid FROM tl t JOIN nation ON n_nationkey = t.k % 25 JOIN region ON r_regionkey = n_regionkey)"""
