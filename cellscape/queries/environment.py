"""Permanence scores, usual environment and internal migration."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ..codes import ID_GRID
from ..functions import grid
from ..operators import coverage, migration, permanence, quality, semantic_cleaning, usual_environment
from ..plans.iterate import cut
from ..plans.joins import dealt
from ..sources import demo
from .coverage import _footprint
from .lattice import LANDUSE_SQL, landuse_tiles
from .views import B, EV, FOOT, FOOT_GROUND, TILES, ZONES

P = permanence.DailyParams(gap=7200, same_cell_gap=14400, night_gap=36000, abroad_gap=7200, max_speed=0.02)


def _signals(spark, sf):
    return demo.events(spark, sf).select("user_id", F.unix_timestamp("timestamp").alias("t"), "cell_id", "plmn", (F.col("domain") == "outbound").alias("abroad"))


def _stays(spark, sf):
    cells = demo.cells(spark).select("cell_id", F.col("cell_x").alias("x"), F.col("cell_y").alias("y"))
    return permanence.stay_intervals(permanence.without_moves(permanence.enrich(dealt(_signals(spark, sf), "user_id"), cells, P), P), P)


def stays_by_run(spark, sf):
    """Two runs over half of the days each, which know their neighbours' events from the cache alone: the stays of one run over all."""
    events = demo.events(spark, sf)
    cache = cut(semantic_cleaning.event_cache(events.withColumn("error_flag", F.lit(0))))
    cells = demo.cells(spark).select("cell_id", F.col("cell_x").alias("x"), F.col("cell_y").alias("y"))
    out = None
    for since, until in ((demo.FIRST_DAY, "2024-01-15"), ("2024-01-16", demo.LAST_DAY)):
        rows = semantic_cleaning.with_cached(events, cache, since, until)
        signals = rows.select("user_id", F.unix_timestamp("timestamp").alias("t"), "cell_id", "plmn", (F.col("domain") == "outbound").alias("abroad"), "own")
        made = permanence.stay_intervals(permanence.without_moves(permanence.enrich(signals, cells, P), P).where("own"), P)
        out = made if out is None else out.unionByName(made)
    return out


def _durations(spark, sf):
    days = dealt(_signals(spark, sf), "user_id").select("user_id", F.floor(F.col("t") / 86400).alias("day")).distinct()
    return permanence.slot_durations(_stays(spark, sf), days, P)


def stay_intervals(spark, sf):
    return _stays(spark, sf)


def slot_durations(spark, sf):
    return _durations(spark, sf)


_STAY = f"""{EV}, {TILES}, sg AS (SELECT user_id, t, CASE WHEN plmn IS NOT NULL THEN '208' ELSE cell_id END AS cell_id, plmn IS NOT NULL AS abroad, t // 86400 AS day FROM ev),
pl AS (SELECT sg.*, x, y FROM sg LEFT JOIN (SELECT 'C' || lpad(cast(k AS VARCHAR), 2, '0') AS c, x, y FROM tl) q ON q.c = sg.cell_id),
lg AS (SELECT *, lag(t) OVER w AS bt0, lag(cell_id) OVER w AS bc0, lag(x) OVER w AS bx0, lag(y) OVER w AS by0, lead(t) OVER w AS at0, lead(cell_id) OVER w AS ac0, lead(x) OVER w AS ax0, lead(y) OVER w AS ay0 FROM pl WINDOW w AS (PARTITION BY user_id ORDER BY t, cell_id)),
nb AS (SELECT user_id, t, cell_id, abroad, day, x, y, CASE WHEN bt0 // 86400 >= day - 1 THEN bt0 END AS bt, CASE WHEN bt0 // 86400 >= day - 1 THEN bc0 END AS bc, CASE WHEN bt0 // 86400 >= day - 1 THEN bx0 END AS bx, CASE WHEN bt0 // 86400 >= day - 1 THEN by0 END AS by_,
  CASE WHEN at0 // 86400 <= day + 1 THEN at0 END AS a_t, CASE WHEN at0 // 86400 <= day + 1 THEN ac0 END AS ac, CASE WHEN at0 // 86400 <= day + 1 THEN ax0 END AS ax, CASE WHEN at0 // 86400 <= day + 1 THEN ay0 END AS ay FROM lg),
kp AS (SELECT * FROM nb WHERE NOT coalesce(greatest(coalesce(sqrt(power(x - bx, 2) + power(y - by_, 2)), 0) + coalesce(sqrt(power(ax - x, 2) + power(ay - y, 2)), 0), coalesce(sqrt(power(ax - bx, 2) + power(ay - by_, 2)), 0)) / (a_t - bt) > 0.02, false)),
si AS (SELECT user_id, cell_id, abroad,
  t - CASE WHEN t - bt <= CASE WHEN abroad THEN 7200 WHEN cell_id = bc AND bt % 86400 >= 82800 AND t % 86400 <= 32400 AND bt // 86400 + 1 = t // 86400 THEN 36000 WHEN cell_id = bc THEN 14400 ELSE 7200 END THEN (t - bt) // 2 WHEN abroad THEN 7200 ELSE 3600 END AS init,
  t + CASE WHEN a_t - t <= CASE WHEN abroad THEN 7200 WHEN cell_id = ac AND t % 86400 >= 82800 AND a_t % 86400 <= 32400 AND t // 86400 + 1 = a_t // 86400 THEN 36000 WHEN cell_id = ac THEN 14400 ELSE 7200 END THEN (a_t - t) // 2 WHEN abroad THEN 7200 ELSE 3600 END AS "end" FROM kp)"""
_SLOT = (
    _STAY
    + """, ct AS (SELECT user_id, slot, cell_id, abroad, sum(least("end", slot + 3600) - greatest(init, slot)) AS seconds FROM (SELECT *, unnest(range(init // 3600, ("end" - 1) // 3600 + 1)) * 3600 AS slot FROM si WHERE "end" > init) GROUP BY ALL),
us AS (SELECT DISTINCT user_id, day FROM sg), sl AS (SELECT user_id, day, day * 86400 + i * 3600 AS slot FROM us, range(24) r(i)),
du AS (SELECT s.user_id, s.day, s.slot, coalesce(cell_id, '-99') AS cell_id, coalesce(abroad, false) AS abroad, cast(coalesce(seconds, 3600) AS BIGINT) AS seconds FROM sl s LEFT JOIN ct ON ct.user_id = s.user_id AND ct.slot = s.slot)"""
)


def _wandering(spark, sf):
    """Signals that name cells of the network over ``ground``: each user has thirteen."""
    b = demo.base_events(spark, sf)
    cell = F.concat(F.lit("P"), F.lpad((F.col("uid") * 13 + F.col("k") % 13).cast("string"), 9, "0"))
    abroad = F.col("event_type") == "signup"
    return b.select(F.col("uid").alias("user_id"), F.unix_timestamp("ts").alias("t"), cell.alias("cell_id"), F.when(abroad, 20801).alias("plmn"), abroad.alias("abroad"))


def _day_hulls(spark, sf, signals):
    """(cell_id, day, hull) of the cells and days that signals name: footprints are wider on odd days."""
    fp, tiles = cut(_footprint(spark, sf)), demo.ground(spark, sf)
    named = signals.select("cell_id", F.floor(F.col("t") / 86400).alias("day")).distinct()
    out = None
    for odd, share in ((0, 95.0), (1, 80.0)):
        own = coverage.cell_hulls(coverage.prune_share_of_best(fp, coverage.Params(best_percent=share)), tiles)
        own = own.join(named.where(F.col("day") % 2 == odd).hint("merge"), "cell_id")
        out = own if out is None else out.unionByName(own)
    return out


def hull_stays(spark, sf):
    """Stay intervals where ways are between the cells' hulls of the day."""
    signals = _wandering(spark, sf)
    hulls = _day_hulls(spark, sf, signals).hint("merge")
    return permanence.stay_intervals(permanence.without_moves(permanence.enrich(signals, hulls, P), P), P)


#: Hulls' distances as in ``cell_distance``: the widest gap between the tiles of two cells, over all directions that can be widest.
_HULL_STAY = (
    f"{B}, "
    + FOOT_GROUND
    + """, sg AS (SELECT uid AS user_id, cast(epoch(ts) AS BIGINT) AS t, CASE WHEN event_type = 'signup' THEN '208' ELSE 'P' || lpad(cast(uid * 13 + k % 13 AS VARCHAR), 9, '0') END AS cell_id, event_type = 'signup' AS abroad, cast(epoch(ts) AS BIGINT) // 86400 AS day FROM b),
hp AS (SELECT cell_id || o AS h, list({x: x, y: y}) AS ps FROM (SELECT *, max(sd) OVER (PARTITION BY grid_id) AS best FROM sd) f JOIN tl USING (grid_id), (VALUES (0), (1)) v(o) WHERE sd * 100 >= best * CASE o WHEN 0 THEN 95.0 ELSE 80.0 END GROUP BY h),
pl AS (SELECT sg.*, h FROM sg LEFT JOIN hp ON h = cell_id || day % 2),
lg AS (SELECT *, lag(t) OVER w AS bt0, lag(cell_id) OVER w AS bc0, lag(h) OVER w AS bh0, lead(t) OVER w AS at0, lead(cell_id) OVER w AS ac0, lead(h) OVER w AS ah0 FROM pl WINDOW w AS (PARTITION BY user_id ORDER BY t, cell_id)),
nb AS (SELECT user_id, t, cell_id, abroad, day, h, CASE WHEN bt0 // 86400 >= day - 1 THEN bt0 END AS bt, CASE WHEN bt0 // 86400 >= day - 1 THEN bc0 END AS bc, CASE WHEN bt0 // 86400 >= day - 1 THEN bh0 END AS bh,
  CASE WHEN at0 // 86400 <= day + 1 THEN at0 END AS a_t, CASE WHEN at0 // 86400 <= day + 1 THEN ac0 END AS ac, CASE WHEN at0 // 86400 <= day + 1 THEN ah0 END AS ah FROM lg),
pr AS (SELECT p.a, p.b, x.ps AS pa, y.ps AS pb FROM (SELECT bh AS a, h AS b FROM nb UNION SELECT h, ah FROM nb UNION SELECT bh, ah FROM nb) p JOIN hp x ON x.h = p.a JOIN hp y ON y.h = p.b WHERE p.a <> p.b),
di AS (SELECT a, b, q.y - p.y AS dx, p.x - q.x AS dy FROM (SELECT a, b, pa, unnest(pa) AS p FROM pr), unnest(pa) r(q) UNION SELECT a, b, q.y - p.y, p.x - q.x FROM (SELECT a, b, pb, unnest(pb) AS p FROM pr), unnest(pb) r(q) UNION SELECT a, b, q.x - p.x, q.y - p.y FROM (SELECT a, b, pb, unnest(pa) AS p FROM pr), unnest(pb) r(q)),
hd AS (SELECT a, b, max(greatest(0, list_min(list_transform(pb, lambda p: p.x * dx + p.y * dy)) - list_max(list_transform(pa, lambda p: p.x * dx + p.y * dy)), list_min(list_transform(pa, lambda p: p.x * dx + p.y * dy)) - list_max(list_transform(pb, lambda p: p.x * dx + p.y * dy))) / sqrt(dx * dx + dy * dy)) AS d FROM di JOIN pr USING (a, b) WHERE dx <> 0 OR dy <> 0 GROUP BY a, b),
kp AS (SELECT nb.* FROM nb LEFT JOIN hd p ON p.a = bh AND p.b = h LEFT JOIN hd q ON q.a = h AND q.b = ah LEFT JOIN hd r ON r.a = bh AND r.b = ah WHERE NOT coalesce(greatest(coalesce(p.d, 0) + coalesce(q.d, 0), coalesce(r.d, 0)) / (a_t - bt) > 0.02, false)),
"""
    + _STAY[_STAY.index("si AS (") :]
)


def _groups(spark):
    fp = coverage.prune_share_of_best(coverage.dominance(coverage.tiles_in_range(coverage.impute_defaults(demo.cells(spark)), demo.lattice(spark).drop("k"), coverage.Params(bin_size=250.0))), coverage.Params(best_percent=97.0))
    return coverage.footprint_groups(fp)


def _dps(spark, sf, groups=None):
    return permanence.daily_scores(_durations(spark, sf), coverage.cell_groups(_groups(spark) if groups is None else groups), P)


def daily_ps(spark, sf):
    return _dps(spark, sf).withColumn("dps", F.array_join("dps", ","))


_DPS = (
    _SLOT
    + ", "
    + FOOT.removeprefix(TILES + ", ")
    + """, pb AS (SELECT * FROM (SELECT *, max(sd) OVER (PARTITION BY grid_id) AS best FROM sd) WHERE sd * 100 >= best * 97.0),
gs AS (SELECT grid_id, string_agg(cell_id, ',' ORDER BY cell_id) AS cells FROM pb GROUP BY grid_id), gr AS (SELECT md5(string_agg(cast(grid_id AS VARCHAR), ',' ORDER BY grid_id)) AS group_id, cells, list(grid_id) AS tiles FROM gs GROUP BY cells),
cg AS (SELECT DISTINCT unnest(string_split(cells, ',')) AS cell_id, group_id FROM gr), gt AS (SELECT group_id, unnest(tiles) AS grid_id FROM gr),
ka AS (SELECT *, sum(seconds) OVER (PARTITION BY user_id, slot) AS al FROM du), kc AS (SELECT user_id, slot, count(DISTINCT cell_id) AS nc FROM du GROUP BY user_id, slot), kd AS (SELECT ka.*, nc FROM ka JOIN kc USING (user_id, slot) WHERE al * 2 >= 3600),
lo AS (SELECT user_id, day, slot, group_id AS place, sum(seconds) AS s, max(nc) AS nc FROM kd JOIN cg USING (cell_id) WHERE cell_id <> '-99' AND NOT abroad GROUP BY ALL),
pc AS (SELECT user_id, day, slot, place, 'grid' AS id_type FROM lo WHERE nc = 1 OR s * 2 >= 3600 UNION ALL SELECT user_id, day, slot, cell_id, 'unknown' FROM kd WHERE cell_id = '-99' UNION ALL SELECT user_id, day, slot, cell_id, 'abroad' FROM kd WHERE abroad AND seconds * 2 >= 3600),
dp AS (SELECT user_id, day, slot, id_type, list_sort(list(DISTINCT place)) AS dps FROM pc GROUP BY ALL)"""
)
_INTERVALS = """, iv AS (SELECT user_id, slot, id_type, dps, 'all' AS time_interval, CASE WHEN slot % 86400 < 14400 THEN day - 1 ELSE day END AS ld FROM dp
  UNION ALL SELECT user_id, slot, id_type, dps, 'night_time', CASE WHEN slot % 86400 >= 64800 THEN day ELSE day - 1 END FROM dp WHERE slot % 86400 >= 64800 OR slot % 86400 + 3600 <= 28800
  UNION ALL SELECT user_id, slot, id_type, dps, 'working_hours', day FROM dp WHERE slot % 86400 >= 28800 AND slot % 86400 + 3600 <= 61200
  UNION ALL SELECT user_id, slot, id_type, dps, 'evening_time', day FROM dp WHERE slot % 86400 >= 57600 AND slot % 86400 + 3600 <= 79200),
dd AS (SELECT user_id, ld, time_interval, id_type, place, count(*) AS n FROM (SELECT *, unnest(dps) AS place FROM iv) GROUP BY ALL),
ob AS (SELECT user_id, ld, time_interval, count(DISTINCT slot) AS either, count(DISTINCT slot) FILTER (id_type = 'grid') AS here, count(DISTINCT slot) FILTER (id_type = 'abroad') AS away FROM iv WHERE id_type <> 'unknown' GROUP BY ALL),
ca AS (SELECT ld, strftime(DATE '1970-01-01' + cast(ld AS INTEGER), '%Y-%m') AS month, isodow(DATE '1970-01-01' + cast(ld AS INTEGER)) AS wd, DATE '1970-01-01' + cast(ld AS INTEGER) IN (DATE '2024-01-01', DATE '2024-01-06') AS off FROM (SELECT DISTINCT ld FROM iv)),
dt AS (SELECT ld, month, 'all' AS day_type, true AS hl, true AS ha FROM ca UNION ALL SELECT ld, month, 'workdays', wd <= 5 AND NOT off, wd <= 5 FROM ca UNION ALL SELECT ld, month, 'weekends', wd > 5, wd > 5 FROM ca UNION ALL SELECT ld, month, 'holidays', off, false FROM ca),
ea AS (SELECT user_id, month, day_type, time_interval, id_type, place, sum(n) AS mps, count(*) AS frequency FROM dd JOIN dt USING (ld) WHERE CASE WHEN id_type = 'abroad' THEN ha ELSE hl END GROUP BY ALL),
oe AS (SELECT user_id, month, day_type, time_interval, CASE WHEN hl AND ha THEN either WHEN hl THEN here WHEN ha THEN away ELSE 0 END AS n FROM ob JOIN dt USING (ld)),
mt AS (SELECT user_id, month, day_type, time_interval, id_type, cast(grid_id AS VARCHAR) AS location, sum(mps) AS mps, sum(frequency) AS frequency FROM ea JOIN gt ON gt.group_id = place WHERE id_type = 'grid' GROUP BY ALL
  UNION ALL SELECT user_id, month, day_type, time_interval, id_type, place, mps, frequency FROM ea WHERE id_type <> 'grid'
  UNION ALL SELECT user_id, month, day_type, time_interval, 'device_observation', '-1', sum(n), count(*) FROM oe WHERE n > 0 GROUP BY ALL)"""


def _scored(spark, sf):
    """The daily scores, the holidays and the groups' tiles; groups are written, so that their size is known."""
    groups = cut(_groups(spark))
    return cut(_dps(spark, sf, groups)), spark.sql("SELECT explode(array(date'2024-01-01', date'2024-01-06')) AS date"), cut(coverage.group_tiles(groups))


def _midterm(spark, sf, params=permanence.MidTermParams()):
    return permanence.midterm_scores(*_scored(spark, sf), params)


def midterm_ps(spark, sf):
    return _midterm(spark, sf).drop("regularity_mean", "regularity_std")


def midterm_totals(spark, sf):
    """Mid-term scores summed up by what they count: rows, slots and days."""
    return _midterm(spark, sf).groupBy("month", "day_type", "time_interval", "id_type").agg(F.count("*").alias("scores"), F.count_distinct("location").alias("places"), F.sum("mps").alias("mps"), F.sum("frequency").alias("frequency"))


def _longterm(spark, sf, params=permanence.MidTermParams()):
    seasons = spark.sql("SELECT * FROM VALUES ('all', '2023-12'), ('all', '2024-01'), ('winter', '2024-01') AS t(season, month)")
    return permanence.longterm_of_days(*_scored(spark, sf), seasons, params)


def longterm_ps(spark, sf):
    return _longterm(spark, sf).withColumns({"frequency_mean": F.round("frequency_mean", 6), "frequency_std": F.round("frequency_std", 6)})


_LPS = _DPS + _INTERVALS + """, lp AS (SELECT user_id, season, day_type, time_interval, id_type, location, sum(mps) AS lps, sum(frequency) AS total_frequency, avg(frequency) AS fm, stddev_samp(frequency) AS fs FROM mt JOIN (VALUES ('all', '2023-12'), ('all', '2024-01'), ('winter', '2024-01')) v(season, m) ON m = month GROUP BY ALL)"""


def _kept(spark, sf, scores=None):
    """Written once: labelling reads these scores several times."""
    return cut(usual_environment.discard_devices(scores if scores is not None else _longterm(spark, sf, usual_environment.periods_read(permanence.MidTermParams(), UE, HOME)), 20, 5))


def gap_cut(spark, sf):
    k = _kept(spark, sf)
    a, b = usual_environment.cut_at_gap(k, 20, True), usual_environment.cut_at_gap(k, 3, False)
    return a.withColumn("kind", F.lit("percent")).unionByName(b.withColumn("kind", F.lit("absolute")))


_CUT = _LPS + """, rare AS (SELECT user_id, season FROM lp WHERE id_type = 'device_observation' AND day_type = 'all' AND time_interval = 'all' AND (lps < 20 OR total_frequency < 5)),
ks AS (SELECT lp.* FROM lp ANTI JOIN rare USING (user_id, season)),
tg AS (SELECT *, coalesce(lag(lps) OVER w - lps, 0) AS dr, max(lps) OVER (PARTITION BY user_id, season) AS mx FROM ks WHERE id_type = 'grid' AND day_type = 'all' AND time_interval = 'all' WINDOW w AS (PARTITION BY user_id, season ORDER BY lps DESC, location)),
cu AS (SELECT *, sum(CASE WHEN dr > 0 AND dr >= mx * 0.2::DOUBLE THEN 1 ELSE 0 END) OVER w AS cp, sum(CASE WHEN dr >= 3 THEN 1 ELSE 0 END) OVER w AS c3, sum(CASE WHEN dr >= 1 THEN 1 ELSE 0 END) OVER w AS c1 FROM tg WINDOW w AS (PARTITION BY user_id, season ORDER BY lps DESC, location ROWS UNBOUNDED PRECEDING))"""


UE = (usual_environment.Rule("ue_1", "all", "all", "lps", 12), usual_environment.Rule("ue_2", "all", "night_time", "lps", 15), usual_environment.Rule("ue_3", "all", "all", "total_frequency", 25))
HOME = (usual_environment.Rule("h_1", "all", "all", "lps", 18), usual_environment.Rule("h_2", "all", "night_time", "lps", 12))


def _labels(spark, sf, scores=None):
    k = _kept(spark, sf, scores)
    first = cut(usual_environment.apply_rules(usual_environment.cut_at_gap(k, 20, True), k, UE, "ue", False))  # read as labels and as what homes lie in
    inside = usual_environment.cut_at_gap(k, 3, False).join(first.select("user_id", "season", "location").hint("merge"), ["user_id", "season", "location"])
    return first.unionByName(usual_environment.apply_rules(inside, k, HOME, "home", True))


def usual_environment_labels(spark, sf):
    return _labels(spark, sf)


def labels_at_100m(spark, sf):
    """Labels of tiles of 200 metres, dealt out to those of 100."""
    coarse = _labels(spark, sf).withColumn("location", grid.coarsen(F.col("location").cast("int"), 2).cast("string")).distinct()
    return usual_environment.at_base_tiles(coarse, 2)


_LABEL = _CUT + """, ow AS (SELECT user_id, season, location, max(CASE WHEN day_type = 'all' AND time_interval = 'all' THEN lps END) AS a, max(CASE WHEN day_type = 'all' AND time_interval = 'night_time' THEN lps END) AS n, max(CASE WHEN day_type = 'all' AND time_interval = 'all' THEN total_frequency END) AS f FROM ks WHERE id_type = 'grid' GROUP BY ALL),
td AS (SELECT user_id, season, max(CASE WHEN day_type = 'all' AND time_interval = 'all' THEN lps END) AS ta, max(CASE WHEN day_type = 'all' AND time_interval = 'night_time' THEN lps END) AS tn, max(CASE WHEN day_type = 'all' AND time_interval = 'all' THEN total_frequency END) AS tf FROM ks WHERE id_type = 'device_observation' GROUP BY ALL),
ue AS (SELECT * FROM (SELECT c.user_id, c.season, c.location, CASE WHEN coalesce(a, 0) >= ta * 0.12::DOUBLE THEN 'ue_1' WHEN coalesce(n, 0) >= tn * 0.15::DOUBLE THEN 'ue_2' WHEN coalesce(f, 0) >= tf * 0.25::DOUBLE THEN 'ue_3' END AS label_rule FROM cu c LEFT JOIN ow USING (user_id, season, location) LEFT JOIN td USING (user_id, season) WHERE cp = 0) WHERE label_rule IS NOT NULL),
ho AS (SELECT c.user_id, c.season, c.location, CASE WHEN coalesce(a, 0) >= ta * 0.18::DOUBLE THEN 'h_1' WHEN coalesce(n, 0) >= tn * 0.12::DOUBLE THEN 'h_2' END AS label_rule FROM cu c SEMI JOIN ue USING (user_id, season, location) LEFT JOIN ow USING (user_id, season, location) LEFT JOIN td USING (user_id, season) WHERE c3 = 0),
lb AS (SELECT user_id, season, location, 'ue' AS label, label_rule FROM ue UNION ALL SELECT user_id, season, location, 'home', label_rule FROM (SELECT *, min(label_rule) OVER (PARTITION BY user_id, season) AS best FROM ho WHERE label_rule IS NOT NULL) WHERE label_rule = best)"""


#: The cascades with a sixth of their percentages, as a device of the demonstration spreads over several tiles.
_CASCADES = [[replace(r, percent=r.percent / 6) for r in rules] for rules in (usual_environment.UE_RULES, usual_environment.HOME_RULES, usual_environment.WORK_RULES)]


def device_labels(spark, sf):
    """The three cascades, home and work inside the usual environment."""
    scores = _longterm(spark, sf, usual_environment.periods_read(permanence.MidTermParams(), *_CASCADES))
    return usual_environment.label_tiles(scores, 20, 5, cascades=_CASCADES)


def _cascade(name: str, source: str, rules, label: str, first_only: bool) -> str:
    """A cascade in SQL: each rule's share of the device's own metric, the first that holds, and of these the device's first."""
    metric = lambda r, table: f"(SELECT max({r.metric}) FROM ks k WHERE k.user_id = c.user_id AND k.season = c.season AND k.day_type = '{r.day_type}' AND k.time_interval = '{r.time_interval}' AND {table})"
    whens = " ".join(f"WHEN coalesce({metric(r, 'k.id_type = ' + chr(39) + 'grid' + chr(39) + ' AND k.location = c.location')}, 0) >= {metric(r, 'k.id_type = ' + chr(39) + 'device_observation' + chr(39))} * {r.percent / 100}::DOUBLE THEN {i}" for i, r in enumerate(rules))
    codes = ", ".join(f"'{r.code}'" for r in rules)
    best = f"SELECT *, min(rule) OVER (PARTITION BY user_id, season) AS best FROM {name}0 WHERE rule IS NOT NULL"
    return f", {name}0 AS (SELECT c.user_id, c.season, c.location, CASE {whens} END AS rule FROM {source}), {name} AS (SELECT user_id, season, location, '{label}' AS label, ([{codes}])[rule + 1] AS label_rule FROM ({best}) WHERE {'rule = best' if first_only else 'true'})"


_DEVICE_LABELS = (
    _CUT
    + _cascade("su", "cu c WHERE c.cp = 0", _CASCADES[0], "ue", False)
    + _cascade("sh", "cu c SEMI JOIN su USING (user_id, season, location) WHERE c.c1 = 0", _CASCADES[1], "home", True)
    + _cascade("sw", "cu c SEMI JOIN su USING (user_id, season, location) WHERE c.c1 = 0", _CASCADES[2], "work", True)
)


def months_and_dates(spark, sf):
    """Days that scores of two months need, with a margin of three, and whether there are events of them."""
    days = spark.range(1).select(F.inline(permanence.midterm_months("2024-01", "2024-02", 3))).select("month", F.explode(F.sequence("first", "last")).alias("date"))
    needed = [str(r["date"]) for r in days.select("date").distinct().collect()]
    missing = permanence.missing_dates(demo.events(spark, sf).select("date"), needed).withColumn("missing", F.lit(True))
    return days.join(missing, "date", "left").select("month", F.col("date").cast("string").alias("date"), F.coalesce("missing", F.lit(False)).alias("missing"))


MONTHS_SQL = f"""WITH {EV}, m AS (SELECT * FROM (VALUES ('2024-01', DATE '2023-12-29', DATE '2024-02-03'), ('2024-02', DATE '2024-01-29', DATE '2024-03-03')) v(month, a, b))
SELECT month, cast(d AS VARCHAR) AS date, d NOT IN (SELECT date FROM ev) AS missing FROM (SELECT month, cast(unnest(range(a, b + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS d FROM m)"""


def usual_environment_aggregation(spark, sf):
    w = usual_environment.tile_weights(demo.lattice(spark).where("k % 4 <> 1"))
    return usual_environment.aggregate_labels(_labels(spark, sf), w).withColumn("weighted_device_count", F.round("weighted_device_count", 6))


def usual_environment_landuse(spark, sf):
    """Devices spread over their tiles by the weights of land use."""
    w = usual_environment.tile_weights(landuse_tiles(spark, sf), {"residential": 1.0, "forest": 0.1, "open_area": 0.2})
    return usual_environment.aggregate_labels(_labels(spark, sf), w).withColumn("weighted_device_count", F.round("weighted_device_count", 6))


def usual_environment_metrics(spark, sf):
    scores = cut(_longterm(spark, sf, usual_environment.periods_read(permanence.MidTermParams(), UE, HOME)))
    m = usual_environment.quality_metrics(scores, _labels(spark, sf, scores), 20, 5)
    return m.withColumn("avg", F.round("avg", 6))


def unknown_share(spark, sf):
    return quality.unknown_share(_durations(spark, sf), 80.0).withColumn("percent", F.round("percent", 6))


UNKNOWN_SQL = f"WITH {_SLOT}, m AS (SELECT user_id, day, slot, arg_max(cell_id, struct_pack(s := seconds, c := cell_id)) AS c FROM du GROUP BY ALL), u AS (SELECT user_id, day, avg(CASE WHEN c = '-99' THEN 1 ELSE 0 END) * 100 AS share FROM m GROUP BY ALL) SELECT day, count(*) AS devices, count(*) FILTER (share >= 80) AS mostly_unknown, round(count(*) FILTER (share >= 80) * 100.0::DOUBLE / count(*), 6) AS percent FROM u GROUP BY day"


def _home(spark, sf, first: bool):
    """Home tiles of a period: every tile where a device was seen at least twice in it."""
    e = demo.events(spark, sf).where(F.dayofmonth("date") <= 15 if first else F.dayofmonth("date") > 15)
    k = F.substring("cell_id", 2, 2).cast("int")
    tiles = e.groupBy("user_id", grid.pack(F.floor(k / 10), k % 10).alias("grid_id")).agg(F.count("*").alias("n"))
    return tiles.where("n >= 2").select("user_id", "grid_id")


def migrating_users(spark, sf):
    return migration.migrating_users(_home(spark, sf, True), _home(spark, sf, False), 0.7).withColumn("overlap", F.round("overlap", 9))


_HOME = EV + ", " + TILES + ", " + ZONES + "".join(f", h{i} AS (SELECT user_id, (k // 10 << 16) + k % 10 AS grid_id FROM ev WHERE day(date) {op} 15 GROUP BY user_id, k HAVING count(*) >= 2)" for i, op in ((1, "<="), (2, ">"))) + """,
ov AS (SELECT coalesce(h1.user_id, h2.user_id) AS user_id, 2 * count(CASE WHEN h1.user_id IS NOT NULL AND h2.user_id IS NOT NULL THEN 1 END) / (count(h1.user_id) + count(h2.user_id)) AS overlap FROM h1 FULL JOIN h2 ON h1.user_id = h2.user_id AND h1.grid_id = h2.grid_id GROUP BY 1),
mu AS (SELECT * FROM ov WHERE overlap < 0.7)"""


def migration_od(spark, sf):
    a, b, z = _home(spark, sf, True), _home(spark, sf, False), demo.zones(spark, sf)
    m = migration.migration_matrix(migration.zone_weights(a, z, [1, 2]), migration.zone_weights(b, z, [1, 2]), migration.migrating_users(a, b, 0.7))
    return m.withColumn("migration", F.round("migration", 6))


def migration_metrics(spark, sf):
    a, b = _home(spark, sf, True), _home(spark, sf, False)
    return migration.quality_metrics(a, b, migration.migrating_users(a, b, 0.7))


_ZW = "".join(f", z{i} AS (SELECT user_id, l, split_part(hid, '|', l) AS zone, sum(1.0::DOUBLE / n) AS w FROM (SELECT h{i}.*, count(*) OVER (PARTITION BY user_id) AS n FROM h{i}) h JOIN zn USING (grid_id), (VALUES (1), (2)) q(l) GROUP BY ALL)" for i in (1, 2))
OD_SQL = f"WITH {_HOME}{_ZW} SELECT z1.l AS level, z1.zone AS previous_zone, z2.zone AS new_zone, round(sum(z1.w * z2.w), 6) AS migration FROM z1 JOIN z2 ON z1.user_id = z2.user_id AND z1.l = z2.l AND z1.zone <> z2.zone SEMI JOIN mu ON mu.user_id = z1.user_id GROUP BY ALL"
MM_SQL = f"WITH {_HOME}, ha AS (SELECT DISTINCT user_id FROM h1), hb AS (SELECT DISTINCT user_id FROM h2) SELECT (SELECT count(*) FROM ha) AS previous_home_users, (SELECT count(*) FROM hb) AS new_home_users, (SELECT count(*) FROM ha SEMI JOIN hb USING (user_id)) AS common_home_users, (SELECT count(*) FROM ha SEMI JOIN hb USING (user_id) SEMI JOIN mu USING (user_id)) AS migrating_users"

_B = lambda c: f"cast({c} AS BIGINT) AS {c}"
QUERIES = {
    "stay_intervals": (stay_intervals, f"WITH {_STAY} SELECT * FROM si"),
    "stays_by_run": (stays_by_run, f"WITH {_STAY} SELECT * FROM si"),
    "hull_stays": (hull_stays, f"WITH {_HULL_STAY} SELECT * FROM si"),
    "slot_durations": (slot_durations, f"WITH {_SLOT} SELECT * FROM du"),
    "daily_ps": (daily_ps, f"WITH {_DPS} SELECT user_id, day, slot, id_type, array_to_string(dps, ',') AS dps FROM dp"),
    "midterm_ps": (midterm_ps, f"WITH {_DPS}{_INTERVALS} SELECT user_id, month, day_type, time_interval, id_type, location, {_B('mps')}, {_B('frequency')} FROM mt"),
    "longterm_ps": (longterm_ps, f"WITH {_LPS} SELECT user_id, season, day_type, time_interval, id_type, location, {_B('lps')}, {_B('total_frequency')}, round(fm, 6) AS frequency_mean, round(fs, 6) AS frequency_std FROM lp"),
    "gap_cut": (gap_cut, f"WITH {_CUT} SELECT user_id, season, location, {_B('lps')}, 'percent' AS kind FROM cu WHERE cp = 0 UNION ALL SELECT user_id, season, location, {_B('lps')}, 'absolute' FROM cu WHERE c3 = 0"),
    "usual_environment_labels": (usual_environment_labels, f"WITH {_LABEL} SELECT * FROM lb"),
    "midterm_totals": (midterm_totals, f"WITH {_DPS}{_INTERVALS} SELECT month, day_type, time_interval, id_type, count(*) AS scores, count(DISTINCT location) AS places, {_B('sum(mps)').replace('AS sum(mps)', 'AS mps')}, {_B('sum(frequency)').replace('AS sum(frequency)', 'AS frequency')} FROM mt GROUP BY ALL"),
    "labels_at_100m": (labels_at_100m, f"WITH {_LABEL}, co AS (SELECT DISTINCT user_id, season, label, label_rule, cast(location AS INTEGER) - cast(location AS INTEGER) % 2 - (cast(location AS INTEGER) >> 16) % 2 * 65536 AS c FROM lb) SELECT user_id, season, cast(c + e * 65536 + n AS VARCHAR) AS location, label, label_rule FROM co, range(2) x(e), range(2) y(n)"),
    "device_labels": (device_labels, f"WITH {_DEVICE_LABELS} SELECT * FROM su UNION ALL SELECT * FROM sh UNION ALL SELECT * FROM sw"),
    "months_and_dates": (months_and_dates, MONTHS_SQL),
    "usual_environment_aggregation": (usual_environment_aggregation, f"WITH {_LABEL}, w AS (SELECT lb.*, CASE WHEN tl.k IS NULL THEN 0.001::DOUBLE ELSE 1.0 END AS w FROM lb LEFT JOIN tl ON cast(tl.grid_id AS VARCHAR) = location AND tl.k % 4 <> 1), s AS (SELECT *, w / sum(w) OVER (PARTITION BY user_id, season, label) AS s FROM w) SELECT season, label, location, round(sum(s), 6) AS weighted_device_count FROM s GROUP BY ALL"),
    "usual_environment_landuse": (usual_environment_landuse, f"WITH {_LABEL}, lu AS ({LANDUSE_SQL}), w AS (SELECT lb.*, CASE main WHEN 'residential' THEN 1.0::DOUBLE WHEN 'forest' THEN 0.1 WHEN 'open_area' THEN 0.2 ELSE 0 END AS w FROM lb LEFT JOIN lu ON cast(lu.grid_id AS VARCHAR) = location), s AS (SELECT *, sum(w) OVER (PARTITION BY user_id, season, label) AS t FROM w) SELECT season, label, location, round(sum(CASE WHEN t > 0 THEN w / t ELSE 0 END), 6) AS weighted_device_count FROM s GROUP BY ALL"),
    "usual_environment_metrics": (usual_environment_metrics, f"WITH {_LABEL}, o AS (SELECT CASE WHEN lps < 20 OR total_frequency < 5 THEN 'devices_discarded' ELSE 'devices_kept' END AS metric, cast(lps AS DOUBLE) AS v FROM lp WHERE id_type = 'device_observation' AND day_type = 'all' AND time_interval = 'all' UNION ALL SELECT label || '_' || label_rule, cast(count(*) AS DOUBLE) FROM lb GROUP BY user_id, season, label, label_rule) SELECT metric, count(*) AS count, min(v) AS min, max(v) AS max, round(avg(v), 6) AS avg FROM o GROUP BY metric"),
    "unknown_share": (unknown_share, UNKNOWN_SQL),
    "migrating_users": (migrating_users, f"WITH {_HOME} SELECT user_id, round(overlap, 9) AS overlap FROM mu"),
    "migration_od": (migration_od, OD_SQL),
    "migration_metrics": (migration_metrics, MM_SQL),
}
