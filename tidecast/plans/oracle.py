"""SQL twins of the catalogue queries, for DuckDB over the raw tables.

Written independently of the Spark plans: origins are enumerated and
range-joined (where Spark uses tile arithmetic), leave-fold-out means are
correlated subqueries (where Spark subtracts sums), lags are one join per
offset. Every float is rounded to 6 places like ``finalize``.
"""

from __future__ import annotations

import datetime as dt

from tidecast.operators.lags import DAY_LAGS, WEEK_LAGS
from tidecast.operators.trailing import DOW_FULL_WEEKS, DOW_WEEKS, TRAIL_DAYS, TRAIL_WEEKS_DAYS
from tidecast.sources.tables import HOLIDAY_MONTH_DAYS, HORIZON_DAYS, INI

D0 = f"DATE '{INI.isoformat()}'"
R = 6


def r(x: str) -> str:
    return f"ROUND(CAST({x} AS DOUBLE), {R})"


def ratio(num: str, den: str) -> str:
    """x/0 -> +-inf, 0/0 -> null, null -> null."""
    return (f"CASE WHEN ({num}) IS NULL OR ({den}) IS NULL THEN NULL "
            f"WHEN ({den}) = 0 AND ({num}) = 0 THEN NULL "
            f"WHEN ({den}) = 0 AND ({num}) > 0 THEN CAST('Infinity' AS DOUBLE) "
            f"WHEN ({den}) = 0 THEN CAST('-Infinity' AS DOUBLE) "
            f"ELSE ({num}) / ({den}) END")


_HOL = ", ".join(f"'{m}'" for m in HOLIDAY_MONTH_DAYS)

# name -> (dependencies, body)
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "visits": ((), """SELECT l_suppkey AS store_id, CAST(l_shipdate AS DATE) AS visit_date,
        CAST(SUM(l_quantity) AS BIGINT) AS visitors FROM lineitem GROUP BY 1, 2"""),
    "stores": ((), """SELECT s.s_suppkey AS store_id, n.n_name AS genre,
        replace(r.r_name, ' ', '-') || ' ' || n.n_name || ' S' || CAST(s.s_suppkey % 10 AS VARCHAR) AS area,
        CAST(s.s_acctbal AS DOUBLE) AS latitude, CAST(s.s_nationkey AS DOUBLE) AS longitude
        FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
        JOIN region r ON n.n_regionkey = r.r_regionkey"""),
    "store_dim": (("stores",), """SELECT store_id, genre, area, latitude, longitude,
        split_part(area, ' ', 1) AS area_l1, split_part(area, ' ', 2) AS area_l2,
        split_part(area, ' ', 3) AS area_l3,
        (SELECT MAX(latitude) FROM stores) - latitude AS d_lat,
        (SELECT MAX(longitude) FROM stores) - longitude AS d_long FROM stores"""),
    "cal_bounds": ((), """SELECT MIN(CAST(l_shipdate AS DATE)) AS lo, MAX(CAST(l_shipdate AS DATE)) AS hi
        FROM lineitem"""),
    "calendar": (("cal_bounds",), f"""SELECT CAST(t.d AS DATE) AS visit_date,
        CAST(CASE WHEN strftime(CAST(t.d AS DATE), '%m-%d') IN ({_HOL}) THEN 1 ELSE 0 END AS BIGINT)
          AS holiday_flg
        FROM cal_bounds b, unnest(generate_series(b.lo, b.hi, INTERVAL 1 DAY)) AS t(d)"""),
    "cal_pad": (("calendar", "cal_bounds"), """SELECT visit_date, CAST(holiday_flg AS BIGINT) AS holiday_flg,
        CAST(isodow(visit_date) - 1 AS BIGINT) AS dow, CAST(month(visit_date) AS BIGINT) AS month FROM (
          SELECT visit_date, holiday_flg FROM calendar
          UNION ALL SELECT lo - 2, 1 FROM cal_bounds UNION ALL SELECT lo - 1, 1 FROM cal_bounds
          UNION ALL SELECT hi + 1, 0 FROM cal_bounds UNION ALL SELECT hi + 2, 0 FROM cal_bounds)"""),
    "cal_full": (("cal_pad",), """SELECT c.visit_date, c.holiday_flg, c.dow, c.month,
        CAST(COALESCE(nx.holiday_flg, 0) AS BIGINT) AS holiday_next1d,
        CAST(COALESCE(pv.holiday_flg, 0) AS BIGINT) AS holiday_prev1d,
        CAST(CASE WHEN c.dow IN (5, 6) AND c.holiday_flg = 1 THEN 0 ELSE c.holiday_flg END AS BIGINT) AS holiday_rev,
        CAST((c.visit_date - (SELECT MIN(visit_date) FROM cal_pad)) + 1 AS DOUBLE)
          / (SELECT COUNT(*) FROM cal_pad) AS weight
        FROM cal_pad c LEFT JOIN cal_pad nx ON nx.visit_date = c.visit_date + 1
        LEFT JOIN cal_pad pv ON pv.visit_date = c.visit_date - 1"""),
    "hist": (("visits", "cal_full", "store_dim"), """SELECT v.store_id, v.visit_date,
        ln(1 + v.visitors) AS y, CAST(isodow(v.visit_date) - 1 AS BIGINT) AS dow,
        c.holiday_flg, c.holiday_next1d, c.holiday_prev1d, c.holiday_rev, c.weight, s.genre, s.area_l1, s.area_l2, s.area_l3
        FROM visits v LEFT JOIN cal_full c ON v.visit_date = c.visit_date
        LEFT JOIN store_dim s ON v.store_id = s.store_id"""),
    "bookings": ((), """SELECT l.l_suppkey AS store_id,
        l.l_shipdate + to_hours(CAST(3 * l.l_linenumber AS BIGINT)) AS visit_datetime,
        o.o_orderdate + to_hours(CAST(o.o_orderkey % 24 AS BIGINT)) AS reserve_datetime,
        CAST(l.l_quantity AS BIGINT) AS reserve_visitors
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE l.l_shipdate >= o.o_orderdate"""),
    "bk": (("bookings",), """SELECT store_id, CAST(visit_datetime AS DATE) AS visit_date,
        CAST(reserve_datetime AS DATE) AS reserve_date, CAST(hour(visit_datetime) AS BIGINT) AS visit_hour,
        CAST(isodow(CAST(visit_datetime AS DATE)) - 1 AS BIGINT) AS dow,
        date_diff('second', reserve_datetime, visit_datetime) / 3600.0 AS lead_hours,
        (((date_diff('second', reserve_datetime, visit_datetime) % 86400) + 86400) % 86400) / 3600.0
          AS lead_hours_mod24,
        reserve_visitors FROM bookings"""),
    "weather": ((), """SELECT replace(r.r_name, ' ', '-') AS prefecture, CAST(o.o_orderdate AS DATE) AS visit_date,
        CAST(COUNT(*) AS DOUBLE) AS rainfall, MAX(o.o_totalprice) / 1000.0 AS wind_max,
        MIN(o.o_orderpriority) AS weather_daytime
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
        GROUP BY 1, 2"""),
    "horizon_ids": (("stores",), f"""SELECT 'air_' || CAST(s.store_id AS VARCHAR) || '_'
          || strftime(CAST(t.d AS DATE), '%Y-%m-%d') AS id,
        s.store_id, CAST(t.d AS DATE) AS visit_date
        FROM stores s, unnest(generate_series({D0}, {D0} + {HORIZON_DAYS - 1}, INTERVAL 1 DAY)) AS t(d)"""),
    # Test grid as origin 1 with cutoff = reference date.
    "t39": (("horizon_ids", "cal_full", "store_dim"), f"""SELECT h.id, CAST(1 AS BIGINT) AS origin_id,
        h.store_id, h.visit_date, {D0} AS cutoff,
        CAST((h.visit_date - {D0}) + 1 AS BIGINT) AS horizon_day,
        CAST(CASE WHEN (h.visit_date - {D0}) + 1 <= 6 THEN 1 ELSE 2 END AS BIGINT) AS flag,
        CAST(isodow(h.visit_date) - 1 AS BIGINT) AS dow, c.holiday_flg, c.holiday_next1d, c.holiday_prev1d, c.holiday_rev,
        s.genre, s.area_l1, s.area_l2, s.area_l3
        FROM horizon_ids h LEFT JOIN cal_full c ON h.visit_date = c.visit_date
        LEFT JOIN store_dim s ON h.store_id = s.store_id"""),
    # Nine 39-day training origins, enumerated.
    "origins9": ((), f"""SELECT CAST(i AS BIGINT) AS origin_id, {D0} - CAST(39 * i AS INTEGER) AS begin_d,
        {D0} - CAST(39 * i AS INTEGER) + 38 AS end_d, {D0} - CAST(39 * i AS INTEGER) AS cutoff
        FROM range(1, 10) AS t(i)"""),
    "o9": (("visits", "origins9", "cal_full", "store_dim"), """SELECT o.origin_id, o.cutoff, o.begin_d,
        v.store_id, v.visit_date, v.visitors, ln(1 + v.visitors) AS y,
        CAST(isodow(v.visit_date) - 1 AS BIGINT) AS dow, s.genre, s.area_l3,
        CAST((v.visit_date - o.begin_d) + 1 AS BIGINT) AS horizon_day,
        CAST(CASE WHEN (v.visit_date - o.begin_d) + 1 <= 6 THEN 1 ELSE 2 END AS BIGINT) AS flag
        FROM visits v JOIN origins9 o ON v.visit_date BETWEEN o.begin_d AND o.end_d
        LEFT JOIN store_dim s ON v.store_id = s.store_id"""),
}


def with_views(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with the CTEs it needs (dependencies first)."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in VIEWS[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    # MATERIALIZED: views referenced many times (lag joins) are built once.
    ctes = [f"{n} AS MATERIALIZED ({VIEWS[n][1]})" for n in order]
    ctes += [f"{k} AS MATERIALIZED ({v})" for k, v in (extra or {}).items()]
    return "WITH " + ",\n".join(ctes) + "\n" + body


# ---- helpers for repeated shapes ------------------------------------------
def _stat_levels(levels, src="h", weighted=True):
    """CTEs l0, l1, ... with per-level statistics over ``src``."""
    out = {}
    for i, keys in enumerate(levels):
        k = ", ".join(keys)
        wm = "SUM(weight * y) / SUM(weight)" if weighted else "AVG(y)"
        out[f"l{i}"] = (f"SELECT {k}, {wm} AS wm, AVG(y) AS mn, MAX(y) AS mx, MIN(y) AS mi, "
                        f"MEDIAN(y) AS md, COUNT(y) AS cn FROM {src} GROUP BY {k}")
    return out


def _fallback_select(levels, t="t", prefix=""):
    joins, n = [], len(levels)
    for i, keys in enumerate(levels):
        cond = " AND ".join(f"l{i}.{c} = {t}.{c}" for c in keys)
        joins.append(f"LEFT JOIN l{i} ON {cond}")
    co = lambda f: "COALESCE(" + ", ".join(f(i) for i in range(n)) + ")"
    cols = [f"{r(co(lambda i: 'l0.wm' if i == 0 else f'l{i}.mn'))} AS {prefix}wmean",
            f"{r(co(lambda i: f'l{i}.mx'))} AS {prefix}ymax",
            f"{r(co(lambda i: f'l{i}.mi'))} AS {prefix}ymin",
            f"{r(co(lambda i: f'l{i}.md'))} AS {prefix}ymed",
            f"CAST({co(lambda i: f'l{i}.cn')} AS BIGINT) AS {prefix}ycnt"]
    return cols, " ".join(joins)


def _hist_stats(levels, extra_cols=()):
    ctes = {"h": f"SELECT * FROM hist WHERE visit_date < {D0}"}
    ctes.update(_stat_levels(levels))
    cols, joins = _fallback_select(levels)
    sel = ", ".join(["t.store_id", "t.visit_date", *[f"t.{c}" for c in extra_cols], *cols])
    return with_views(f"SELECT {sel} FROM t39 t {joins}", "t39", "hist", extra=ctes)


def _lag_sql(offsets: dict[str, int]):
    joins, cols = [], []
    for i, (name, d) in enumerate(offsets.items()):
        a = f"g{i}"
        joins.append(f"LEFT JOIN hist {a} ON {a}.store_id = t.store_id AND {a}.visit_date = t.visit_date - {d} "
                     f"AND {a}.visit_date < t.cutoff")
        cols.append(f"{r(f'{a}.y')} AS {name}")
    return cols, " ".join(joins)


def _lag_names(days=(), weeks=(), prefix="lag"):
    out = {f"{prefix}_{d}d": d for d in days}
    out.update({f"{prefix}_{w}w": 7 * w for w in weeks})
    return out


def _trailing_sql(days, keys=("store_id",), aggs=("mean", "max", "min", "std"), suffix=lambda d: f"{d}d",
                  scales=True, name=lambda a, s: f"{a}_{s}"):
    fn = {"mean": "AVG", "max": "MAX", "min": "MIN", "std": "STDDEV_SAMP"}
    inner = []
    for d in days:
        for a in aggs:
            inner.append(f"{fn[a]}(h.y) FILTER (WHERE h.visit_date >= o.cutoff - {d}) AS {name(a, suffix(d))}")
    k = ", ".join(f"h.{c}" for c in keys)
    src = (f"SELECT o.origin_id, {k}, {', '.join(inner)} FROM origins9 o JOIN hist h "
           f"ON h.visit_date < o.cutoff AND h.visit_date >= o.cutoff - {max(days)} GROUP BY o.origin_id, {k}")
    outer = ["origin_id", *keys]
    for d in days:
        s = suffix(d)
        outer += [r(name(a, s)) + f" AS {name(a, s)}" for a in aggs]
        if scales:
            outer.append(f"{r(ratio(f'mean_{s} - min_{s}', f'max_{s} - min_{s}'))} AS scale_maxmin_{s}")
            outer.append(f"{r(ratio(f'mean_{s}', f'std_{s}'))} AS scale_std_{s}")
    return src, outer


# ---- per-key SQL ------------------------------------------------------------
def _q() -> dict[str, str]:
    q: dict[str, str] = {}
    q["scan_visits"] = with_views("SELECT store_id, visit_date, visitors FROM visits", "visits")
    q["calendar_padded"] = with_views("SELECT visit_date, holiday_flg, dow, month FROM cal_pad", "cal_pad")
    q["calendar_neighbours"] = with_views(
        "SELECT visit_date, holiday_flg, holiday_next1d, holiday_prev1d FROM cal_full", "cal_full")
    q["calendar_holiday_rev"] = with_views("SELECT visit_date, holiday_flg, holiday_rev FROM cal_full", "cal_full")
    q["calendar_weight"] = with_views(f"SELECT visit_date, {r('weight')} AS weight FROM cal_full", "cal_full")
    q["log_target"] = with_views(
        f"SELECT store_id, visit_date, {r('ln(1 + visitors)')} AS y, {r('exp(ln(1 + visitors)) - 1')} AS back "
        "FROM visits", "visits")
    q["id_parse"] = with_views(
        "SELECT id, split_part(id, '_', 1) || '_' || split_part(id, '_', 2) AS store_key, "
        "CAST(split_part(id, '_', 3) AS DATE) AS visit_date FROM horizon_ids", "horizon_ids")
    q["booking_parse"] = with_views(
        f"SELECT store_id, visit_date, reserve_date, visit_hour, dow, {r('lead_hours')} AS lead_hours, "
        f"{r('lead_hours_mod24')} AS lead_hours_mod24 FROM bk", "bk")
    q["facts_enriched"] = with_views(
        f"SELECT v.store_id, v.visit_date, {r('ln(1 + v.visitors)')} AS y, c.dow, c.holiday_flg, s.genre, s.area_l1 "
        "FROM visits v LEFT JOIN cal_pad c ON v.visit_date = c.visit_date "
        "LEFT JOIN store_dim s ON v.store_id = s.store_id", "visits", "cal_pad", "store_dim")
    q["origin_targets"] = with_views("SELECT origin_id, store_id, visit_date, horizon_day, flag FROM o9", "o9")
    q["origin_history"] = with_views(
        "SELECT o.origin_id, v.store_id, CAST(COUNT(*) AS BIGINT) AS n_days, MIN(v.visit_date) AS first_date, "
        "MAX(v.visit_date) AS last_date FROM origins9 o JOIN visits v ON v.visit_date < o.cutoff GROUP BY 1, 2",
        "origins9", "visits")
    q["segment_filter"] = with_views(
        "SELECT flag, CAST(COUNT(*) AS BIGINT) AS n_rows, MIN(horizon_day) AS min_day, MAX(horizon_day) AS max_day "
        "FROM t39 GROUP BY flag", "t39")
    q["hist_stats_dow"] = _hist_stats([("store_id", "dow"), ("store_id",)])
    q["hist_stats_dowhol"] = _hist_stats([("store_id", "dow", "holiday_flg"), ("store_id", "dow"), ("store_id",)])
    q["hist_stats_dowhol_nb"] = _hist_stats(
        [("store_id", "dow", "holiday_next1d"), ("store_id", "dow"), ("store_id",)], extra_cols=("holiday_next1d",))

    # step 3
    q["store_dim"] = with_views(
        f"SELECT store_id, area_l1, area_l2, area_l3, {r('d_lat')} AS d_lat, {r('d_long')} AS d_long FROM store_dim",
        "store_dim")
    q["label_encode"] = with_views(
        "SELECT store_id, "
        + ", ".join(f"CAST(DENSE_RANK() OVER (ORDER BY {c}) - 1 AS BIGINT) AS {c}_lbl"
                    for c in ("genre", "area_l1", "area_l2", "area_l3"))
        + " FROM store_dim", "store_dim")
    dows = ", ".join(f"CAST(dow = {i} AS BIGINT) AS dow_{i}" for i in range(1, 7))
    months = ", ".join(f"CAST(month = {i} AS BIGINT) AS month_{i}" for i in range(2, 13))
    q["one_hot"] = with_views(f"SELECT visit_date, dow, month, {dows}, {months} FROM cal_pad", "cal_pad")
    q["one_hot_full"] = with_views(
        "SELECT visit_date, " + ", ".join(f"CAST(dow = {i} AS BIGINT) AS dow_{i}" for i in range(7))
        + " FROM cal_pad", "cal_pad")
    q["fold_assign"] = with_views(
        "SELECT store_id, visit_date, CAST(('0x' || substr(md5(CAST(store_id AS VARCHAR) || '_' || "
        "CAST(visit_date AS VARCHAR)), 1, 8)) AS BIGINT) % 5 AS fold FROM visits", "visits")
    q["bridge_join"] = with_views(
        "SELECT s.store_id, r.partner_id, c.c_mktsegment AS partner_genre FROM stores s "
        "LEFT JOIN (SELECT s_suppkey AS store_id, MIN(s_suppkey) AS partner_id FROM supplier "
        "WHERE s_suppkey % 3 = 0 GROUP BY 1) r ON s.store_id = r.store_id "
        "LEFT JOIN customer c ON c.c_custkey = r.partner_id", "stores")
    q["weather_join"] = with_views(
        f"SELECT v.store_id, v.visit_date, {r('w.rainfall')} AS rainfall, {r('w.wind_max')} AS wind_max "
        "FROM visits v LEFT JOIN store_dim s ON v.store_id = s.store_id "
        "LEFT JOIN weather w ON w.prefecture = s.area_l1 AND w.visit_date = v.visit_date",
        "visits", "store_dim", "weather")

    # step 4
    q["hist_stats_multi"] = with_views(
        f"SELECT o.origin_id, h.store_id, h.dow, {r('SUM(h.weight * h.y) / SUM(h.weight)')} AS wmean, "
        f"{r('MAX(h.y)')} AS ymax, {r('MIN(h.y)')} AS ymin, CAST(COUNT(h.y) AS BIGINT) AS ycnt "
        "FROM origins9 o JOIN hist h ON h.visit_date < o.cutoff GROUP BY 1, 2, 3", "origins9", "hist")
    for key, offs in (("lag_daily", _lag_names(days=DAY_LAGS)), ("lag_weekly", _lag_names(weeks=WEEK_LAGS))):
        cols, joins = _lag_sql(offs)
        q[key] = with_views(f"SELECT t.origin_id, t.store_id, t.visit_date, {', '.join(cols)} FROM o9 t {joins}",
                            "o9", "hist")
    res = _lag_names(weeks=WEEK_LAGS, prefix="lag_res")
    sub = ", ".join(
        f"(SELECT CAST(SUM(b.reserve_visitors) AS BIGINT) FROM bk b WHERE b.store_id = t.store_id "
        f"AND b.visit_date = t.visit_date - {d} AND b.reserve_date < t.cutoff) AS {n}" for n, d in res.items())
    q["lag_booking"] = with_views(f"SELECT t.origin_id, t.store_id, t.visit_date, {sub} FROM o9 t", "o9", "bk")
    for key, days in (("trailing_stats", TRAIL_DAYS), ("trailing_stats_weeks", TRAIL_WEEKS_DAYS)):
        src, outer = _trailing_sql(days)
        q[key] = with_views(f"SELECT {', '.join(outer)} FROM ({src})", "origins9", "hist")
    src, _ = _trailing_sql((28, 56, 84), aggs=("mean",), scales=False)
    q["trailing_diffs"] = with_views(
        f"SELECT origin_id, store_id, {r('mean_28d - mean_56d')} AS diff_28_56, "
        f"{r('mean_28d - mean_84d')} AS diff_28_84, {r('mean_56d - mean_84d')} AS diff_56_84 FROM ({src})",
        "origins9", "hist")
    src, outer = _trailing_sql([7 * w for w in DOW_WEEKS], keys=("store_id", "dow"), aggs=("mean",),
                               suffix=lambda d: f"{d // 7}w", scales=False, name=lambda a, s: f"{a}_dow_{s}")
    q["trailing_dow_mean"] = with_views(f"SELECT {', '.join(outer)} FROM ({src})", "origins9", "hist")
    src, outer = _trailing_sql([7 * w for w in DOW_FULL_WEEKS], keys=("store_id", "dow"),
                               suffix=lambda d: f"{d // 7}w", scales=False, name=lambda a, s: f"{a}_dow_{s}")
    q["trailing_dow_full"] = with_views(f"SELECT {', '.join(outer)} FROM ({src})", "origins9", "hist")
    known = f"SELECT * FROM bk WHERE reserve_date < {D0}"
    q["booking_stats"] = with_views(
        f"SELECT store_id, visit_date, CAST(SUM(reserve_visitors) AS BIGINT) AS res_ttl, "
        f"CAST(COUNT(reserve_visitors) AS BIGINT) AS res_cnt, {r('AVG(reserve_visitors)')} AS res_mean, "
        f"{r('STDDEV_SAMP(visit_hour)')} AS res_hr_std FROM kb GROUP BY 1, 2", "bk", extra={"kb": known})
    q["booking_stats_ext"] = with_views(
        f"SELECT store_id, visit_date, {r('STDDEV_SAMP(reserve_visitors)')} AS res_std, "
        f"{r('SUM(lead_hours)')} AS lead_sum, {r('AVG(lead_hours)')} AS lead_mean FROM kb GROUP BY 1, 2",
        "bk", extra={"kb": known})
    q["booking_dow"] = with_views(
        f"SELECT store_id, dow, {r('AVG(m)')} AS party_mean_dow, {r('AVG(c)')} AS cnt_mean_dow FROM "
        "(SELECT store_id, visit_date, dow, AVG(reserve_visitors) AS m, COUNT(reserve_visitors) AS c "
        "FROM kb GROUP BY 1, 2, 3) GROUP BY 1, 2", "bk", extra={"kb": known})

    for flag in ("prev1d", "rev"):
        q[f"hist_stats_dowhol_{flag[:4].rstrip('1')}"] = _hist_stats(
            [("store_id", "dow", f"holiday_{flag}"), ("store_id", "dow"), ("store_id",)], extra_cols=(f"holiday_{flag}",))
    days = [1, 2, 3, 4, 5, 6, 10, 15, 20, 25, 30, 35, 40, 45, 50]
    cols, joins = _lag_sql(_lag_names(days=days))
    q["lag_days_all"] = with_views(f"SELECT t.origin_id, t.store_id, t.visit_date, {', '.join(cols)} FROM o9 t {joins}", "o9", "hist")
    sub = ", ".join(
        f"(SELECT CAST(SUM(b.reserve_visitors) AS BIGINT) FROM bk b WHERE b.store_id = t.store_id "
        f"AND b.visit_date = t.visit_date - {d} AND b.reserve_date < t.cutoff) AS lag_res_{d}d" for d in days)
    q["lag_booking_days"] = with_views(f"SELECT t.origin_id, t.store_id, t.visit_date, {sub} FROM o9 t", "o9", "bk")
    src, outer = _trailing_sql((3, 7, 14, 21, 28, 35, 42, 49, 56, 63, 70, 77, 84))
    pairs = ((7, 14), (7, 28), (7, 56), (7, 84), (14, 28), (14, 56), (14, 84), (28, 56), (28, 84), (56, 84))
    outer += [f"{r(f'mean_{a}d - mean_{b}d')} AS diff_{a}_{b}" for a, b in pairs]
    q["trailing_all"] = with_views(f"SELECT {', '.join(outer)} FROM ({src})", "origins9", "hist")
    src, outer = _trailing_sql([7 * w for w in (2, 3, 4, 5, 6, 7, 8, 9, 10)], keys=("store_id", "dow"),
                               suffix=lambda d: f"{d // 7}w", scales=False, name=lambda a, s: f"{a}_dow_{s}")
    pairs = ((2, 4), (2, 6), (2, 8), (2, 10), (4, 6), (4, 8), (4, 10), (6, 8), (6, 10), (8, 10))
    outer += [f"{r(f'mean_dow_{a}w - mean_dow_{b}w')} AS diff_dow_{a}_{b}" for a, b in pairs]
    q["trailing_dow_all"] = with_views(f"SELECT {', '.join(outer)} FROM ({src})", "origins9", "hist")
    q["booking_dow_origins"] = with_views(
        f"SELECT origin_id, store_id, dow, {r('AVG(m)')} AS party_mean_dow, {r('AVG(c)')} AS cnt_mean_dow FROM "
        "(SELECT o.origin_id, b.store_id, b.visit_date, b.dow, AVG(b.reserve_visitors) AS m, COUNT(b.reserve_visitors) AS c "
        "FROM bk b JOIN origins9 o ON b.reserve_date < o.cutoff GROUP BY 1, 2, 3, 4) GROUP BY 1, 2, 3", "bk", "origins9")
    q["one_hot_open"] = (
        "SELECT o_orderkey, (SELECT COUNT(DISTINCT o_custkey) - 1 FROM orders)::BIGINT AS size, "
        "CASE WHEN code > 1 THEN code - 2 END::BIGINT AS place FROM "
        "(SELECT o_orderkey, DENSE_RANK() OVER (ORDER BY o_custkey) AS code FROM orders)")

    # step 5
    def te_hist(keysets):
        joins, cols = [], []
        for i, (name, keys) in enumerate(keysets.items()):
            k = ", ".join(keys)
            cond = " AND ".join(f"e{i}.{c} = t.{c}" for c in keys)
            joins.append(f"LEFT JOIN (SELECT {k}, AVG(y) AS m FROM h GROUP BY {k}) e{i} ON {cond}")
            cols.append(f"{r(f'e{i}.m')} AS {name}")
        return with_views(f"SELECT t.store_id, t.visit_date, {', '.join(cols)} FROM t39 t {' '.join(joins)}",
                          "t39", "hist", extra={"h": f"SELECT * FROM hist WHERE visit_date < {D0}"})

    from tidecast.operators.target_encoding import BASE_KEYSETS, MORE_KEYSETS
    q["target_encode_hist"] = te_hist(BASE_KEYSETS)
    q["target_encode_more"] = te_hist(MORE_KEYSETS)
    fold = ("CAST(('0x' || substr(md5(CAST(store_id AS VARCHAR) || '_' || CAST(visit_date AS VARCHAR)), 1, 8)) "
            "AS BIGINT) % 5")
    oof_cols = []
    for name, keys in BASE_KEYSETS.items():
        cond = " AND ".join(f"u.{c} = t.{c}" for c in keys)
        oof_cols.append(f"{r(f'(SELECT AVG(u.y) FROM tf u WHERE u.origin_id = t.origin_id AND {cond} AND u.fold <> t.fold)')} AS {name}")
    q["target_encode_oof"] = with_views(
        f"SELECT t.origin_id, t.store_id, t.visit_date, t.fold, {', '.join(oof_cols)} FROM tf t", "o9",
        extra={"tf": f"SELECT *, {fold} AS fold FROM o9"})

    # step 7
    lagd = _lag_names(days=DAY_LAGS)
    cols, joins = _lag_sql(lagd)
    lag_raw = ", ".join(f"g{i}.y AS {n}" for i, n in enumerate(lagd))
    ld_train = f"SELECT t.origin_id, t.store_id, t.visit_date, {lag_raw} FROM o9 t {joins}"
    ld_test = f"SELECT t.origin_id, t.store_id, t.visit_date, {lag_raw} FROM t39 t {joins}"
    na = " + ".join(f"CAST({n} IS NULL AS BIGINT)" for n in lagd)
    filled = ", ".join(f"COALESCE({n}, -1) AS {n}" for n in lagd)
    q["fill_and_count"] = with_views(
        f"SELECT origin_id, store_id, visit_date, {na} AS na_cnt, "
        + ", ".join(f"{r(f'COALESCE({n}, -1)')} AS {n}" for n in lagd) + " FROM ld",
        "o9", "hist", extra={"ld": ld_train})
    q["union_train_test"] = with_views(
        "SELECT CAST(0 AS BIGINT) AS is_test, CAST(COUNT(*) AS BIGINT) AS n_rows, "
        "CAST(SUM(visitors) AS BIGINT) AS n_label FROM o9 UNION ALL "
        "SELECT CAST(1 AS BIGINT), CAST(COUNT(*) AS BIGINT), CAST(0 AS BIGINT) FROM t39", "o9", "t39")
    meds = ", ".join(f"MEDIAN({n}) AS {n}" for n in lagd)
    imputed = ", ".join(f"{r(f'CASE WHEN u.{n} = -1 THEN m.{n} ELSE u.{n} END')} AS {n}" for n in lagd)
    q["impute_sentinel"] = with_views(
        f"SELECT u.is_test, u.origin_id, u.store_id, u.visit_date, {imputed} FROM u, (SELECT {meds} FROM u) m",
        "o9", "t39", "hist",
        extra={"u": f"SELECT CAST(0 AS BIGINT) AS is_test, origin_id, store_id, visit_date, {filled} FROM ({ld_train}) "
                    f"UNION ALL SELECT CAST(1 AS BIGINT), origin_id, store_id, visit_date, {filled} FROM ({ld_test})"})
    src, outer = _trailing_sql(TRAIL_DAYS)
    scale_cols = [f"scale_{k}_{d}d" for d in TRAIL_DAYS for k in ("maxmin", "std")]
    sc_src = (f"SELECT origin_id, store_id, " + ", ".join(f"COALESCE({c}, -1) AS {c}" for c in scale_cols)
              + f" FROM (SELECT {', '.join(outer)} FROM ({src}))")
    # outer already rounds; inf survives rounding.
    q["impute_inf_zero"] = with_views(
        "SELECT origin_id, store_id, " + ", ".join(f"{r(f'CASE WHEN isinf({c}) THEN 0 ELSE {c} END')} AS {c}"
                                                   for c in scale_cols) + " FROM sc",
        "origins9", "hist", extra={"sc": sc_src})
    # Medians over unrounded values: rebuild the scale columns without rounding.
    src_u, _ = _trailing_sql(TRAIL_DAYS)
    outer_u = ["origin_id", "store_id"]
    for d in TRAIL_DAYS:
        outer_u.append(f"COALESCE({ratio(f'mean_{d}d - min_{d}d', f'max_{d}d - min_{d}d')}, -1) AS scale_maxmin_{d}d")
        outer_u.append(f"COALESCE({ratio(f'mean_{d}d', f'std_{d}d')}, -1) AS scale_std_{d}d")
    sc_u = f"SELECT {', '.join(outer_u)} FROM ({src_u})"
    m1 = ", ".join(f"MEDIAN({c}) AS {c}" for c in scale_cols)
    s1 = ", ".join(f"CASE WHEN {c} = CAST('-Infinity' AS DOUBLE) THEN (SELECT {c} FROM m1) ELSE {c} END AS {c}"
                   for c in scale_cols)
    s2 = ", ".join(f"{r(f'CASE WHEN {c} = CAST(' + chr(39) + 'Infinity' + chr(39) + f' AS DOUBLE) THEN (SELECT {c} FROM m2) ELSE {c} END')} AS {c}"
                   for c in scale_cols)
    q["impute_inf_median"] = with_views(
        f"SELECT origin_id, store_id, {s2} FROM st1", "origins9", "hist",
        extra={"sc": sc_u, "m1": f"SELECT {m1} FROM sc", "st1": f"SELECT origin_id, store_id, {s1} FROM sc",
               "m2": f"SELECT {m1} FROM st1"})
    q["interactions"] = with_views(
        f"SELECT t.store_id, t.visit_date, {r('g.m + a.m')} AS genre_plus_area, "
        f"{r('w.wind_max * w.rainfall')} AS wind_x_rain FROM t39 t "
        "LEFT JOIN (SELECT genre, AVG(y) AS m FROM h GROUP BY genre) g ON g.genre = t.genre "
        "LEFT JOIN (SELECT area_l3, AVG(y) AS m FROM h GROUP BY area_l3) a ON a.area_l3 = t.area_l3 "
        "LEFT JOIN weather w ON w.prefecture = t.area_l1 AND w.visit_date = t.visit_date",
        "t39", "hist", "weather", extra={"h": f"SELECT * FROM hist WHERE visit_date < {D0}"})
    lag_sel = {n: f"{r(f'g{i}.y')} AS {n}" for i, n in enumerate(lagd)}
    q["feature_select"] = with_views(
        "SELECT t.origin_id, t.store_id, t.visit_date, "
        + ", ".join(f"CAST(c.dow = {i} AS BIGINT) AS dow_{i}" for i in range(1, 7)) + ", "
        + ", ".join(lag_sel[n] for n in ("lag_10d", "lag_20d", "lag_30d", "lag_1d", "lag_3d", "lag_5d"))
        + f" FROM o9 t LEFT JOIN cal_pad c ON c.visit_date = t.visit_date {joins}", "o9", "hist", "cal_pad")
    q.update(_q_step8())
    q["dataset_test"] = _dataset_sql("test")
    q["dataset_rolling"] = _dataset_sql("train_all")
    q["dataset_train1"] = _dataset_sql("train1")
    q["dataset_train2"] = _dataset_sql("train2")
    q["model_inputs"] = _model_inputs_sql()
    q["features_incremental"] = (f"SELECT origin_id, store_id, visit_date, visitors, lag_7w, mean_50d, dow_all_wmean "
                                 f"FROM ({q['dataset_rolling']}) WHERE origin_id <= 2")
    part = (f"CASE WHEN t.visit_date >= {D0} - CAST(33 * k.n AS INTEGER) AND t.visit_date < {D0} - CAST(33 * (k.n - 1) AS INTEGER) THEN 'valid' "
            f"WHEN t.visit_date < {D0} - CAST(33 * k.n AS INTEGER) AND t.visit_date >= {D0} - 365 THEN 'train' END")
    q["backtest_gbt_rows"] = with_views(
        "SELECT CAST(n AS BIGINT) AS n, COUNT(*) FILTER (part = 'train') AS n_train, COUNT(*) FILTER (part = 'valid') AS n_valid "
        f"FROM (SELECT k.n, {part} AS part FROM o9 t, range(1, 6) AS k(n)) WHERE part IS NOT NULL GROUP BY 1", "o9")
    fold4 = ("CAST(('0x' || substr(md5(CAST(store_id AS VARCHAR) || '_' || CAST(visit_date AS VARCHAR)), 1, 8)) AS BIGINT) % 4")
    q["stack_rows"] = with_views(
        f"SELECT 'train_all' AS set, flag, {fold4} AS fold, COUNT(*) AS n_rows, COUNT(*) AS n_finite FROM o9 GROUP BY ALL "
        "UNION ALL SELECT 'test', flag, CAST(-1 AS BIGINT), COUNT(*), COUNT(*) FROM t39 GROUP BY ALL", "o9", "t39")
    return q


# Training sets: days of a target window, number of windows, gap in days, segment flag.
_SETS = {"train_all": (39, 9, 0, 0), "train1": (6, 60, 0, 1), "train2": (33, 10, 6, 2)}
_STATS = ("wmean", "ymax", "ymin", "ymed", "ycnt")
_HIST = ("dow_all", "dowhol_all", "dowhol_next_all", "dowhol_prev_all", "dowhol_rev_all")
_TRAIL = (5, 10, 20, 30, 50, 100)
_DUMMY = ([f"dow_{k}" for k in range(1, 7)] + [f"month_{k}" for k in range(2, 13)]
          + [f"area_l3_lbl_{k}" for k in range(1, 10)] + [f"weather_lbl_{k}" for k in range(1, 5)])
_BASE = ["dow", "month", "holiday_flg", "holiday_next1d", "holiday_prev1d", "holiday_rev", "d_lat", "d_long",
         "genre_lbl", "area_l1_lbl", "area_l2_lbl", "area_l3_lbl"]
_FEATS = (_BASE + [f"{p}_{s}" for p in _HIST for s in _STATS]
          + ["genre_mean", "genre_dow_mean", "area_mean", "area_dow_mean", "res_ttl", "res_cnt", "res_mean", "res_hr_std",
             "party_mean_dow", "cnt_mean_dow", "lag_1d", "lag_3d", "lag_5d", "lag_10d", "lag_20d", "lag_30d"]
          + [f"lag_{w}w" for w in range(1, 21)] + [f"lag_res_{w}w" for w in range(1, 21)]
          + [f"{a}_{d}d" for d in _TRAIL for a in ("mean", "max", "min", "std", "scale_maxmin", "scale_std")]
          + ["mean_dow_2w", "mean_dow_4w", "mean_dow_8w", "rainfall", "wind_max", "weather_lbl"] + _DUMMY)


def _dataset_sql(set_name: str, exact: bool = False) -> str:
    """SQL twin of ``build_dataset`` for the test origin or the origins of a
    training set: every block as its own CTE, joined on the keys. ``exact``
    leaves the floats unrounded."""
    from tidecast.operators.target_encoding import BASE_KEYSETS
    ctes: dict[str, str] = {}
    test = set_name == "test"
    ctes["codes"] = "SELECT store_id, " + ", ".join(
        f"CAST(DENSE_RANK() OVER (ORDER BY {c}) - 1 AS BIGINT) AS {c}_lbl" for c in ("genre", "area_l1", "area_l2", "area_l3")) + " FROM store_dim"
    attrs = ("c.month, c.holiday_flg, c.holiday_next1d, c.holiday_prev1d, c.holiday_rev, s.genre, s.area_l1, s.area_l2, "
             "s.area_l3, s.d_lat, s.d_long, k.genre_lbl, k.area_l1_lbl, k.area_l2_lbl, k.area_l3_lbl")
    views = ["cal_full", "store_dim", "hist", "bk", "weather"]
    if test:
        ctes["orig"] = (f"SELECT CAST(1 AS BIGINT) AS origin_id, {D0} AS begin_d, {D0} + {HORIZON_DAYS - 1} AS end_d, "
                        f"{D0} AS cutoff")
        ctes["tg"] = ("SELECT t.origin_id, t.store_id, t.visit_date, t.cutoff, t.horizon_day, t.flag, "
                      f"t.dow, {attrs} FROM t39 t LEFT JOIN cal_full c ON c.visit_date = t.visit_date "
                      "LEFT JOIN store_dim s ON s.store_id = t.store_id LEFT JOIN codes k ON k.store_id = t.store_id")
        views.append("t39")
        label = []
    else:
        days, count, gap, flag = _SETS[set_name]
        ctes["orig"] = (f"SELECT CAST(i AS BIGINT) AS origin_id, {D0} - CAST({days} * i AS INTEGER) AS begin_d, "
                        f"{D0} - CAST({days} * i AS INTEGER) + {days - 1} AS end_d, "
                        f"{D0} - CAST({days} * i AS INTEGER) - {gap} AS cutoff FROM range(1, {count + 1}) AS t(i)")
        ctes["tg"] = (f"SELECT o.origin_id, t.store_id, t.visit_date, o.cutoff, "
                      f"CAST((t.visit_date - o.begin_d) + 1 + {gap} AS BIGINT) AS horizon_day, "
                      f"CAST({flag} AS BIGINT) AS flag, t.visitors, ln(1 + t.visitors) AS y, "
                      f"CAST(isodow(t.visit_date) - 1 AS BIGINT) AS dow, {attrs} "
                      "FROM visits t JOIN orig o ON t.visit_date BETWEEN o.begin_d AND o.end_d "
                      "LEFT JOIN cal_full c ON c.visit_date = t.visit_date "
                      "LEFT JOIN store_dim s ON s.store_id = t.store_id LEFT JOIN codes k ON k.store_id = t.store_id")
        views.append("visits")
        label = ["visitors", "y"]
    # history statistics per origin and level
    families = {"dow_all": [("store_id", "dow"), ("store_id",)]}
    for prefix, col in (("dowhol_all", "holiday_flg"), ("dowhol_next_all", "holiday_next1d"),
                        ("dowhol_prev_all", "holiday_prev1d"), ("dowhol_rev_all", "holiday_rev")):
        families[prefix] = [("store_id", "dow", col), ("store_id", "dow"), ("store_id",)]
    for tag, levels in families.items():
        for i, keys in enumerate(levels):
            k = ", ".join(f"h.{c}" for c in keys)
            ctes[f"{tag}{i}"] = (f"SELECT o.origin_id, {k}, SUM(h.weight * h.y) / SUM(h.weight) AS wm, AVG(h.y) AS mn, "
                                 "MAX(h.y) AS mx, MIN(h.y) AS mi, MEDIAN(h.y) AS md, COUNT(h.y) AS cn "
                                 f"FROM orig o JOIN hist h ON h.visit_date < o.cutoff GROUP BY o.origin_id, {k}")
    joins, sel = [], []

    def fallback(tag, levels, prefix):
        n = len(levels)
        for i, keys in enumerate(levels):
            cond = " AND ".join([f"{tag}{i}.origin_id = t.origin_id"] + [f"{tag}{i}.{c} = t.{c}" for c in keys])
            joins.append(f"LEFT JOIN {tag}{i} ON {cond}")
        co = lambda f: "COALESCE(" + ", ".join(f(i) for i in range(n)) + ")"
        sel.extend([f"{co(lambda i: f'{tag}0.wm' if i == 0 else f'{tag}{i}.mn')} AS {prefix}_wmean",
                    f"{co(lambda i: f'{tag}{i}.mx')} AS {prefix}_ymax",
                    f"{co(lambda i: f'{tag}{i}.mi')} AS {prefix}_ymin",
                    f"{co(lambda i: f'{tag}{i}.md')} AS {prefix}_ymed",
                    f"CAST({co(lambda i: f'{tag}{i}.cn')} AS BIGINT) AS {prefix}_ycnt"])

    for prefix, levels in families.items():
        fallback(prefix, levels, prefix)
    # target encodings
    if test:
        for i, (name, keys) in enumerate(BASE_KEYSETS.items()):
            k = ", ".join(keys)
            ctes[f"e{i}"] = f"SELECT {k}, AVG(y) AS m FROM hist WHERE visit_date < {D0} GROUP BY {k}"
            joins.append(f"LEFT JOIN e{i} ON " + " AND ".join(f"e{i}.{c} = t.{c}" for c in keys))
            sel.append(f"e{i}.m AS {name}")
    else:
        fold = ("CAST(('0x' || substr(md5(CAST(store_id AS VARCHAR) || '_' || CAST(visit_date AS VARCHAR)), 1, 8)) "
                "AS BIGINT) % 5")
        ctes["tf"] = f"SELECT *, {fold} AS fold FROM tg"
        for name, keys in BASE_KEYSETS.items():
            cond = " AND ".join(f"u.{c} = t.{c}" for c in keys)
            sel.append(f"(SELECT AVG(u.y) FROM tf u WHERE u.origin_id = t.origin_id AND {cond} "
                       f"AND u.fold <> {fold.replace('store_id', 't.store_id').replace('visit_date', 't.visit_date')}) "
                       f"AS {name}")
    # bookings
    ctes["bs"] = ("SELECT o.origin_id, b.store_id, b.visit_date, CAST(SUM(b.reserve_visitors) AS BIGINT) AS res_ttl, "
                  "CAST(COUNT(b.reserve_visitors) AS BIGINT) AS res_cnt, AVG(b.reserve_visitors) AS res_mean, "
                  "STDDEV_SAMP(b.visit_hour) AS res_hr_std FROM orig o JOIN bk b "
                  "ON b.visit_date BETWEEN o.begin_d AND o.end_d AND b.reserve_date < o.cutoff GROUP BY 1, 2, 3")
    joins.append("LEFT JOIN bs ON bs.origin_id = t.origin_id AND bs.store_id = t.store_id "
                 "AND bs.visit_date = t.visit_date")
    sel += ["bs.res_ttl", "bs.res_cnt", "bs.res_mean", "bs.res_hr_std"]
    ctes["bd"] = ("SELECT origin_id, store_id, dow, AVG(m) AS party_mean_dow, AVG(c) AS cnt_mean_dow FROM "
                  "(SELECT o.origin_id, b.store_id, b.visit_date, b.dow, AVG(b.reserve_visitors) AS m, "
                  "COUNT(b.reserve_visitors) AS c FROM orig o JOIN bk b ON b.reserve_date < o.cutoff "
                  "GROUP BY 1, 2, 3, 4) GROUP BY 1, 2, 3")
    joins.append("LEFT JOIN bd ON bd.origin_id = t.origin_id AND bd.store_id = t.store_id AND bd.dow = t.dow")
    sel += ["bd.party_mean_dow", "bd.cnt_mean_dow"]
    # lags
    offs = _lag_names(days=DAY_LAGS, weeks=WEEK_LAGS)
    for i, (name, d) in enumerate(offs.items()):
        joins.append(f"LEFT JOIN hist g{i} ON g{i}.store_id = t.store_id AND g{i}.visit_date = t.visit_date - {d} "
                     f"AND g{i}.visit_date < t.cutoff")
        sel.append(f"g{i}.y AS {name}")
    res = _lag_names(weeks=WEEK_LAGS, prefix="lag_res")
    ctes["lr"] = ("SELECT t.origin_id, t.store_id, t.visit_date, " + ", ".join(
        f"(SELECT CAST(SUM(b.reserve_visitors) AS BIGINT) FROM bk b WHERE b.store_id = t.store_id "
        f"AND b.visit_date = t.visit_date - {d} AND b.reserve_date < t.cutoff) AS {n}" for n, d in res.items())
        + " FROM tg t")
    joins.append("LEFT JOIN lr ON lr.origin_id = t.origin_id AND lr.store_id = t.store_id "
                 "AND lr.visit_date = t.visit_date")
    sel += [f"lr.{n}" for n in res]
    # trailing windows
    inner = []
    for d in TRAIL_DAYS:
        for a, fn in (("mean", "AVG"), ("max", "MAX"), ("min", "MIN"), ("std", "STDDEV_SAMP")):
            inner.append(f"{fn}(h.y) FILTER (WHERE h.visit_date >= o.cutoff - {d}) AS {a}_{d}d")
    ctes["tr"] = (f"SELECT o.origin_id, h.store_id, {', '.join(inner)} FROM orig o JOIN hist h "
                  f"ON h.visit_date < o.cutoff AND h.visit_date >= o.cutoff - {max(TRAIL_DAYS)} GROUP BY 1, 2")
    joins.append("LEFT JOIN tr ON tr.origin_id = t.origin_id AND tr.store_id = t.store_id")
    for d in TRAIL_DAYS:
        sel += [f"tr.{a}_{d}d" for a in ("mean", "max", "min", "std")]
        sel.append(f"{ratio(f'tr.mean_{d}d - tr.min_{d}d', f'tr.max_{d}d - tr.min_{d}d')} AS scale_maxmin_{d}d")
        sel.append(f"{ratio(f'tr.mean_{d}d', f'tr.std_{d}d')} AS scale_std_{d}d")
    inner = [f"AVG(h.y) FILTER (WHERE h.visit_date >= o.cutoff - {7 * w}) AS mean_dow_{w}w" for w in DOW_WEEKS]
    ctes["td"] = (f"SELECT o.origin_id, h.store_id, h.dow, {', '.join(inner)} FROM orig o JOIN hist h "
                  f"ON h.visit_date < o.cutoff AND h.visit_date >= o.cutoff - {7 * max(DOW_WEEKS)} GROUP BY 1, 2, 3")
    joins.append("LEFT JOIN td ON td.origin_id = t.origin_id AND td.store_id = t.store_id AND td.dow = t.dow")
    sel += [f"td.mean_dow_{w}w" for w in DOW_WEEKS]
    joins.append("LEFT JOIN weather w ON w.prefecture = t.area_l1 AND w.visit_date = t.visit_date")
    weather = ("CASE w.weather_daytime WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2 "
               "WHEN '4-NOT SPECIFIED' THEN 3 WHEN '5-LOW' THEN 4 END")
    sel += ["w.rainfall", "w.wind_max", f"CAST({weather} AS BIGINT) AS weather_lbl"]
    for name in _DUMMY:
        col, level = name.rsplit("_", 1)
        of = weather if col == "weather_lbl" else f"t.{col}"
        sel.append(f"CAST(COALESCE({of}, -1) = {level} AS BIGINT) AS {name}")
    feats = _FEATS
    base_feats = [c for c in _BASE if c != "dow"]
    ctes["wide"] = ("SELECT t.origin_id, t.store_id, t.visit_date, t.horizon_day, t.flag, "
                    + "".join(f"t.{c}, " for c in label)
                    + "t.genre, t.area_l1, t.area_l2, t.area_l3, t.dow, "
                    + ", ".join(f"t.{c}" for c in base_feats) + ", " + ", ".join(sel)
                    + " FROM tg t " + " ".join(joins))
    na = " + ".join(f"CAST({c} IS NULL AS BIGINT)" for c in feats)
    outs = ["origin_id", "store_id", "visit_date", "horizon_day", "flag"]
    out = (lambda x: x) if exact else r
    outs += [out("y") + " AS y" if c == "y" else c for c in label]
    outs += ["genre", "area_l1", "area_l2", "area_l3", f"'{set_name}' AS set", f"{na} AS na_cnt"]
    outs += [f"{out(f'COALESCE({c}, -1)')} AS {c}" if c not in _INT_FEATS else f"COALESCE({c}, -1) AS {c}"
             for c in feats]
    return with_views(f"SELECT {', '.join(outs)} FROM wide", *views, extra=ctes)


_INT_FEATS = {"dow", "month", "holiday_flg", "holiday_next1d", "holiday_prev1d", "holiday_rev", "genre_lbl", "area_l1_lbl",
              "area_l2_lbl", "area_l3_lbl", *[f"{p}_ycnt" for p in _HIST], "res_ttl", "res_cnt", "weather_lbl", *_DUMMY,
              *[f"lag_res_{w}w" for w in range(1, 21)]}


def _model_inputs_sql() -> str:
    """Train and test rows together: -1 to the median over both, then
    infinity to 0, for the columns that the first-stage models list."""
    trail = [f"{a}_{d}d" for d in _TRAIL for a in ("mean", "max", "min", "std", "scale_maxmin", "scale_std")]
    med = ([f"{p}_{s}" for p in _HIST for s in ("wmean", "ymax", "ymin", "ymed")]
           + ["genre_mean", "genre_dow_mean", "area_mean", "area_dow_mean"] + trail)
    cols = ", ".join(_FEATS)
    outs = []
    for c in _FEATS:
        e = f"CASE WHEN u.{c} = -1 THEN m.{c} ELSE u.{c} END" if c in med else f"u.{c}"
        if c.startswith("scale_"):
            e = f"CASE WHEN isinf({e}) THEN 0 ELSE {e} END"
        outs.append(f"{e} AS {c}" if c in _INT_FEATS else f"{r(e)} AS {c}")
    return (f"WITH u AS MATERIALIZED (SELECT CAST(0 AS BIGINT) AS is_test, store_id, visit_date, y, {cols} "
            f"FROM ({_dataset_sql('train_all', exact=True)}) UNION ALL "
            f"SELECT CAST(1 AS BIGINT), store_id, visit_date, CAST(NULL AS DOUBLE), {cols} "
            f"FROM ({_dataset_sql('test', exact=True)})), "
            f"m AS MATERIALIZED (SELECT {', '.join(f'MEDIAN({c}) AS {c}' for c in med)} FROM u) "
            f"SELECT u.is_test, u.store_id, u.visit_date, {r('u.y')} AS y, {', '.join(outs)} FROM u, m")


# ---- step 8: naive forecasters, ensemble, scores, submission ----------------
def _naive_test_ctes():
    return {
        "h": f"SELECT * FROM hist WHERE visit_date < {D0}",
        "nl0": "SELECT store_id, dow, SUM(weight * y) / SUM(weight) AS wm FROM h GROUP BY 1, 2",
        "nl1": "SELECT store_id, AVG(y) AS mn FROM h GROUP BY 1",
        "ntr": f"SELECT store_id, AVG(y) AS m FROM h WHERE visit_date >= {D0} - 50 GROUP BY 1",
        "np": """SELECT t.store_id, t.visit_date, t.flag, COALESCE(nl0.wm, nl1.mn) AS pred_1,
            COALESCE(g.y, nl0.wm, nl1.mn) AS pred_2, ntr.m AS pred_3
            FROM t39 t LEFT JOIN nl0 ON nl0.store_id = t.store_id AND nl0.dow = t.dow
            LEFT JOIN nl1 ON nl1.store_id = t.store_id
            LEFT JOIN hist g ON g.store_id = t.store_id AND g.visit_date = t.visit_date - 49
              AND g.visit_date < t.cutoff
            LEFT JOIN ntr ON ntr.store_id = t.store_id""",
        "npl": """SELECT 1 AS model_id, store_id, visit_date, flag, pred_1 AS pred FROM np
            UNION ALL SELECT 2, store_id, visit_date, flag, pred_2 FROM np
            UNION ALL SELECT 3, store_id, visit_date, flag, pred_3 FROM np""",
    }


def _blend_expr(weights: dict, prefix="np."):
    allp = " AND ".join(f"{prefix}pred_{m} IS NOT NULL" for m in weights)
    s = " + ".join(f"CAST({w!r} AS DOUBLE) * {prefix}pred_{m}" for m, w in weights.items())
    return f"CASE WHEN {allp} THEN {s} END"


def _q_step8() -> dict[str, str]:
    from tidecast.plans.catalog import BLEND_WEIGHTS, DATE_FACTORS, EQUAL_WEIGHTS, THIRD_LAYER_ALPHA
    q: dict[str, str] = {}
    nt = _naive_test_ctes()
    views = ("t39", "hist")
    q["backtest_split"] = with_views(
        "SELECT n, part, CAST(COUNT(*) AS BIGINT) AS n_rows, MIN(visit_date) AS min_date, "
        "MAX(visit_date) AS max_date FROM (SELECT CAST(k.n AS BIGINT) AS n, v.visit_date, "
        f"CASE WHEN v.visit_date >= {D0} - CAST(33 * k.n AS INTEGER) "
        f"AND v.visit_date < {D0} - CAST(33 * (k.n - 1) AS INTEGER) THEN 'valid' "
        f"WHEN v.visit_date < {D0} - CAST(33 * k.n AS INTEGER) AND v.visit_date >= {D0} - 365 THEN 'train' END "
        "AS part FROM visits v, range(1, 6) AS k(n)) WHERE part IS NOT NULL GROUP BY 1, 2", "visits")
    q["ens_gather"] = with_views(
        f"SELECT store_id, visit_date, {r('pred_1')} AS pred_1, {r('pred_2')} AS pred_2, {r('pred_3')} AS pred_3 "
        "FROM np", *views, extra=nt)
    q["ens_corr"] = with_views(
        " UNION ALL ".join(f"SELECT 'pred_{a}' AS a, 'pred_{b}' AS b, {r(f'CORR(pred_{a}, pred_{b})')} AS corr FROM np"
                           for a, b in ((1, 2), (1, 3), (2, 3))), *views, extra=nt)
    q["ens_blend"] = with_views(
        f"SELECT store_id, visit_date, {r(_blend_expr(BLEND_WEIGHTS))} AS pred_blend FROM np", *views, extra=nt)
    a = THIRD_LAYER_ALPHA
    q["ens_blend3"] = with_views(
        f"SELECT store_id, visit_date, {r(f'({_blend_expr(EQUAL_WEIGHTS)}) * {a} + ({_blend_expr(BLEND_WEIGHTS)}) * {1.0 - a!r}')} "
        "AS pred_3rd FROM np", *views, extra=nt)
    q["score_rmsle"] = with_views(
        f"SELECT CAST(p.model_id AS BIGINT) AS model_id, CAST(COUNT(p.pred) AS BIGINT) AS n, "
        "CAST(COUNT(*) FILTER (WHERE p.pred IS NULL) AS BIGINT) AS n_unscored, "
        f"{r('SQRT(AVG(POWER(g.y - p.pred, 2)))')} AS rmsle FROM npl p JOIN hist g "
        "ON g.store_id = p.store_id AND g.visit_date = p.visit_date GROUP BY 1",
        *views, extra=nt)
    o9n = {
        "nl0": "SELECT o.origin_id, h.store_id, h.dow, SUM(h.weight * h.y) / SUM(h.weight) AS wm "
               "FROM origins9 o JOIN hist h ON h.visit_date < o.cutoff GROUP BY 1, 2, 3",
        "nl1": "SELECT o.origin_id, h.store_id, AVG(h.y) AS mn FROM origins9 o JOIN hist h "
               "ON h.visit_date < o.cutoff GROUP BY 1, 2",
        "ntr": "SELECT o.origin_id, h.store_id, AVG(h.y) AS m FROM origins9 o JOIN hist h "
               "ON h.visit_date < o.cutoff AND h.visit_date >= o.cutoff - 50 GROUP BY 1, 2",
        "np": """SELECT t.origin_id, t.store_id, t.visit_date, t.flag, t.y, COALESCE(nl0.wm, nl1.mn) AS pred_1,
            COALESCE(g.y, nl0.wm, nl1.mn) AS pred_2, ntr.m AS pred_3
            FROM o9 t LEFT JOIN nl0 ON nl0.origin_id = t.origin_id AND nl0.store_id = t.store_id AND nl0.dow = t.dow
            LEFT JOIN nl1 ON nl1.origin_id = t.origin_id AND nl1.store_id = t.store_id
            LEFT JOIN hist g ON g.store_id = t.store_id AND g.visit_date = t.visit_date - 49
              AND g.visit_date < t.cutoff
            LEFT JOIN ntr ON ntr.origin_id = t.origin_id AND ntr.store_id = t.store_id""",
        "npl": """SELECT 1 AS model_id, flag, y, pred_1 AS pred FROM np
            UNION ALL SELECT 2, flag, y, pred_2 FROM np UNION ALL SELECT 3, flag, y, pred_3 FROM np""",
        "sc": """SELECT model_id, SQRT(AVG(POWER(y - pred, 2)) FILTER (WHERE flag = 1)) AS s1,
            SQRT(AVG(POWER(y - pred, 2)) FILTER (WHERE flag = 2)) AS s2,
            COUNT(*) FILTER (WHERE pred IS NULL OR y IS NULL) AS n_unscored FROM npl GROUP BY model_id""",
    }
    q["score_horizon"] = with_views(
        f"SELECT CAST(model_id AS BIGINT) AS model_id, {r('s1')} AS s1, {r('s2')} AS s2, "
        f"{r('(s1 * 6 + s2 * 33) / 39.0')} AS total, CAST(n_unscored AS BIGINT) AS n_unscored FROM sc", "o9", "origins9", "hist", extra=o9n)
    bt = {
        "p": f"""SELECT CAST(k.n AS BIGINT) AS n, h.store_id, h.dow, h.y,
            CASE WHEN h.visit_date >= {D0} - CAST(33 * k.n AS INTEGER)
              AND h.visit_date < {D0} - CAST(33 * (k.n - 1) AS INTEGER) THEN 'valid'
            WHEN h.visit_date < {D0} - CAST(33 * k.n AS INTEGER) AND h.visit_date >= {D0} - 365 THEN 'train'
            END AS part FROM hist h, range(1, 6) AS k(n)""",
        "fit": "SELECT n, store_id, dow, AVG(y) AS pred FROM p WHERE part = 'train' GROUP BY 1, 2, 3",
        "s": """SELECT v.n, SQRT(AVG(POWER(v.y - f.pred, 2))) AS rmsle, COUNT(*) FILTER (WHERE f.pred IS NULL) AS n_unscored
            FROM p v LEFT JOIN fit f ON f.n = v.n AND f.store_id = v.store_id AND f.dow = v.dow WHERE v.part = 'valid' GROUP BY v.n""",
    }
    q["backtest_scores"] = with_views(
        f"SELECT n, {r('rmsle')} AS rmsle, {r('(SELECT AVG(rmsle) FROM s)')} AS mean_rmsle, "
        "CAST(n_unscored AS BIGINT) AS n_unscored FROM s", "hist", extra=bt)
    subm = dict(nt)
    subm["sb"] = (f"SELECT i.id, i.visit_date, EXP({_blend_expr(BLEND_WEIGHTS)}) - 1 AS visitors FROM horizon_ids i "
                  "LEFT JOIN np ON np.store_id = i.store_id AND np.visit_date = i.visit_date")
    q["submission_build"] = with_views(f"SELECT id, {r('visitors')} AS visitors FROM sb", *views, "horizon_ids",
                                       extra=subm)
    fac = " UNION ALL ".join(f"SELECT {D0} + {k} AS visit_date, CAST({v!r} AS DOUBLE) AS factor"
                             for k, v in DATE_FACTORS.items())
    subm2 = dict(subm)
    subm2["fac"] = fac
    subm2["adj"] = ("SELECT sb.id, sb.visit_date, sb.visitors, sb.visitors * COALESCE(fac.factor, 1.0) AS visitors_adj "
                    "FROM sb LEFT JOIN fac ON fac.visit_date = sb.visit_date")
    q["submission_adjust"] = with_views(
        f"SELECT id, {r('visitors')} AS visitors_raw, {r('visitors_adj')} AS visitors_adj FROM adj",
        *views, "horizon_ids", extra=subm2)
    # The sixteen dates of the ensemble submission, as days after the first one.
    ens_fac = ((2, 1.10), (3, 1.00), (4, 1.10), (5, 1.00), (6, 1.00), (7, 1.30), (8, 1.40), (9, 1.10), (10, 1.10),
               (11, 1.05), (12, 1.05), (13, 1.00), (14, 1.10), (15, 0.95), (16, 0.95), (17, 1.00))
    subm4 = dict(nt)
    subm4["fac"] = " UNION ALL ".join(f"SELECT {D0} + {k} AS visit_date, CAST({v!r} AS DOUBLE) AS factor" for k, v in ens_fac)
    third = f"({_blend_expr(EQUAL_WEIGHTS)}) * {a} + ({_blend_expr(BLEND_WEIGHTS)}) * {1.0 - a!r}"
    subm4["sb"] = (f"SELECT i.id, i.visit_date, EXP({third}) - 1 AS visitors FROM horizon_ids i "
                   "LEFT JOIN np ON np.store_id = i.store_id AND np.visit_date = i.visit_date")
    q["submission_ensemble"] = with_views(
        f"SELECT sb.id, {r('sb.visitors')} AS visitors_raw, {r('sb.visitors * COALESCE(fac.factor, 1.0)')} AS visitors_adj "
        "FROM sb LEFT JOIN fac ON fac.visit_date = sb.visit_date", *views, "horizon_ids", extra=subm4)
    subm3 = dict(subm2)
    subm3["act"] = (f"SELECT visit_date + 364 AS visit_date, AVG(visitors) AS actual_last_year FROM visits "
                    f"WHERE visit_date + 364 BETWEEN {D0} AND {D0} + {HORIZON_DAYS - 1} GROUP BY 1")
    subm3["pr"] = "SELECT visit_date, AVG(visitors) AS pred, AVG(visitors_adj) AS pred_adj FROM adj GROUP BY 1"
    q["yoy_compare"] = with_views(
        f"SELECT a.visit_date, {r('a.actual_last_year')} AS actual_last_year, {r('p.pred')} AS pred, "
        f"{r('p.pred_adj')} AS pred_adj FROM act a LEFT JOIN pr p ON p.visit_date = a.visit_date",
        *views, "horizon_ids", "visits", extra=subm3)
    return q
