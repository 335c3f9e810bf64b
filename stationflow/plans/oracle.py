"""DuckDB oracle SQL, one statement per registered key.

The bindings of ``stationflow.sources.bindings`` are re-stated as CTEs; each
key's SQL is an independent formulation of the operator (written from the
operator's definition, not generated from the Spark plan).
"""

from __future__ import annotations

from stationflow.plans.sqlkit import CteRegistry, bigint, davg, dsum, initcap, rnd, sdiv, season, tier

R = CteRegistry()

# ------------------------------------------------------------------ bindings
R.add("b1_li", """
SELECT CAST(CASE WHEN year(l_shipdate + INTERVAL 288 MONTH) = 2019 AND (l_orderkey + l_linenumber) % 20 = 13 THEN 20
                 ELSE (l_orderkey + l_linenumber) % 20 END AS BIGINT) AS k,
       l_shipdate + INTERVAL 288 MONTH AS transit_timestamp,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
       l_returnflag, l_linestatus, l_quantity, l_linenumber, l_discount,
       year(l_shipdate + INTERVAL 288 MONTH) AS yr
FROM lineitem
""")

_B1_SELECT = """
SELECT transit_timestamp,
       {station_id} AS station_complex_id,
       CAST(k AS VARCHAR) || '-' || CAST(k + 1 AS VARCHAR) || ' ' || lower(r_name) || ' st (a,b)' AS station_complex,
       r_name AS borough,
       CAST(4050 + k AS DOUBLE) / 100.0::DOUBLE AS latitude,
       CAST(-7410 + (k % 5) * 2 AS DOUBLE) / 100.0::DOUBLE AS longitude,
       'SUBWAY' AS transit_mode,
       CASE WHEN l_linestatus = 'O' THEN 'OMNY' ELSE 'MetroCard' END AS payment_method,
       l_returnflag AS fare_class_category,
       {ridership} AS ridership,
       CAST(l_quantity AS DOUBLE) AS transfers
FROM b1_li LEFT JOIN region ON (k % 5) = r_regionkey
"""
_B1_RID = "CAST(CASE WHEN yr = 2019 THEN price * 100 ELSE price * (20 + 10 * k) END AS DOUBLE)"
R.add("raw_monthly", _B1_SELECT.format(station_id="CAST(k AS VARCHAR)", ridership=_B1_RID), ("b1_li",))
R.add(
    "raw_monthly_defects",
    _B1_SELECT.format(
        station_id="CASE WHEN l_discount = 0.1 THEN NULL ELSE CAST(k AS VARCHAR) END",
        ridership=f"CASE WHEN l_linenumber = 7 THEN NULL WHEN l_quantity = 1 THEN -({_B1_RID}) ELSE {_B1_RID} END",
    ),
    ("b1_li",),
)

_EV = """
SELECT ts AS transit_timestamp,
       {k} AS station_complex_id,
       {k} || ' station (q.r)' AS station_complex,
       r_name AS borough,
       CAST(4060 + rk AS DOUBLE) / 100.0::DOUBLE AS latitude,
       CAST(-7390 - rk AS DOUBLE) / 100.0::DOUBLE AS longitude,
       'subway' AS transit_mode,
       'omny' AS payment_method,
       {fare} AS fare_class_category,
       CAST(value AS DOUBLE) AS ridership,
       0.0::DOUBLE AS transfers
FROM (SELECT *, {rk} AS rk FROM events) e LEFT JOIN region ON rk = r_regionkey
"""
R.add("raw_coarse", _EV.format(
    k="event_type",
    fare="CAST(user_id % 3 AS VARCHAR)",
    rk="CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 "
       "WHEN 'signup' THEN 3 WHEN 'view' THEN 4 ELSE 0 END",
))
R.add("raw_fine", _EV.format(k="CAST(user_id % 20 AS VARCHAR)", fare="event_type", rk="CAST(user_id % 20 % 5 AS INTEGER)"))


def _stg(src: str) -> str:
    return f"""
SELECT CAST(transit_timestamp AS TIMESTAMP) AS transit_timestamp,
       CAST(transit_timestamp AS DATE) AS transit_date,
       CAST(hour(transit_timestamp) AS BIGINT) AS transit_hour,
       CAST(dayofweek(transit_timestamp) + 1 AS BIGINT) AS day_of_week,
       CAST(year(transit_timestamp) AS BIGINT) AS transit_year,
       CAST(month(transit_timestamp) AS BIGINT) AS transit_month,
       CAST(station_complex_id AS VARCHAR) AS station_complex_id,
       {initcap('station_complex')} AS station_name,
       {initcap('borough')} AS borough,
       CAST(latitude AS DOUBLE) AS latitude,
       CAST(longitude AS DOUBLE) AS longitude,
       lower(transit_mode) AS transit_mode,
       lower(payment_method) AS payment_method,
       lower(fare_class_category) AS fare_class,
       CAST(ridership AS DOUBLE) AS ridership,
       CAST(transfers AS DOUBLE) AS transfers
FROM {src}
WHERE transit_timestamp IS NOT NULL AND station_complex_id IS NOT NULL
  AND ridership IS NOT NULL AND CAST(ridership AS DOUBLE) >= 0
"""


R.add("stg_all", _stg("raw_monthly"), ("raw_monthly",))
R.add("stg_cur", "SELECT * FROM stg_all WHERE transit_year <> 2019", ("stg_all",))
R.add("stg_base", "SELECT * FROM stg_all WHERE transit_year = 2019", ("stg_all",))
R.add("stg_coarse", _stg("raw_coarse"), ("raw_coarse",))
R.add("stg_fine", _stg("raw_fine"), ("raw_fine",))

# ------------------------------------------------------------------ recovery
R.add("monthly", f"""
SELECT station_complex_id,
       max(station_name) AS station_name,
       max(borough) AS borough,
       {rnd(davg('latitude', 12, 6), 6)} AS latitude,
       {rnd(davg('longitude', 12, 6), 6)} AS longitude,
       transit_year AS ridership_year,
       transit_month AS ridership_month,
       make_date(CAST(transit_year AS INTEGER), CAST(transit_month AS INTEGER), 1) AS ridership_month_date,
       {dsum('ridership')} AS monthly_ridership
FROM stg_cur
GROUP BY station_complex_id, transit_year, transit_month
""", ("stg_cur",))

R.add("base_m", """
SELECT station_complex_id, transit_month AS ridership_month, sum(CAST(ridership AS DECIMAL(18,2))) AS base_m
FROM stg_base GROUP BY station_complex_id, transit_month
""", ("stg_base",))
R.add("base_a", "SELECT station_complex_id, sum(base_m) AS base_a FROM base_m GROUP BY station_complex_id", ("base_m",))

R.add("recovery_j", f"""
SELECT c.*,
       CAST(m.base_m AS DOUBLE) AS baseline_monthly_2019,
       CAST(a.base_a AS DOUBLE) AS baseline_annual_2019,
       {rnd(sdiv('c.monthly_ridership', 'm.base_m') + ' * 100', 2)} AS monthly_recovery_pct,
       lag(c.monthly_ridership) OVER (PARTITION BY c.station_complex_id ORDER BY c.ridership_month_date) AS prev_month_ridership
FROM monthly c
LEFT JOIN base_m m ON c.station_complex_id = m.station_complex_id AND c.ridership_month = m.ridership_month
LEFT JOIN base_a a ON c.station_complex_id = a.station_complex_id
""", ("monthly", "base_m", "base_a"))

R.add("recovery", f"""
SELECT *,
       {rnd(sdiv('monthly_ridership - prev_month_ridership', 'prev_month_ridership') + ' * 100', 2)} AS month_over_month_pct,
       CASE WHEN monthly_recovery_pct > 200 THEN 'suspect_merged'
            WHEN monthly_recovery_pct < 25 THEN 'suspect_split'
            WHEN baseline_monthly_2019 IS NULL THEN 'no_baseline'
            ELSE 'clean' END AS data_quality_flag,
       {season('ridership_month')} AS season,
       {tier('monthly_recovery_pct', ((90, 'Recovered'), (70, 'Recovering'), (50, 'Lagging')), 'Critical')} AS recovery_tier
FROM recovery_j
""", ("recovery_j",))

ORACLE: dict[str, str] = {}


def key(name: str, final: str, *needs: str) -> None:
    ORACLE[name] = R.query(final, *needs)


key("monthly_totals", "SELECT * FROM monthly", "monthly")
key("recovery_monthly", "SELECT * FROM recovery", "recovery")

# ------------------------------------------------------------------ more recovery
R.add("mom_row", f"""
SELECT station_complex_id, ridership_month_date, monthly_ridership,
       lag(monthly_ridership) OVER (PARTITION BY station_complex_id ORDER BY ridership_month_date) AS prev_month_ridership
FROM monthly
""", ("monthly",))
R.add("mom_strict", """
SELECT c.station_complex_id, c.ridership_month_date, c.monthly_ridership, p.monthly_ridership AS prev_month_ridership
FROM monthly c LEFT JOIN monthly p
  ON p.station_complex_id = c.station_complex_id AND p.ridership_month_date + INTERVAL 1 MONTH = c.ridership_month_date
""", ("monthly",))
_MOM = f"SELECT *, {rnd(sdiv('monthly_ridership - prev_month_ridership', 'prev_month_ridership') + ' * 100', 2)} AS month_over_month_pct FROM "
key("mom_change", _MOM + "mom_row", "mom_row")
key("mom_change_strict", _MOM + "mom_strict", "mom_strict")

_RTIER = ((90, "Recovered"), (70, "Recovering"), (50, "Lagging"))
R.add("borough_agg", f"""
SELECT borough, ridership_year AS transit_year,
       {dsum('monthly_ridership')} AS annual_ridership,
       {dsum('baseline_monthly_2019')} AS annual_baseline_2019
FROM recovery GROUP BY borough, ridership_year
""", ("recovery",))
R.add("borough_rows", f"""
SELECT 'borough' AS record_type, transit_year, borough, CAST(NULL AS VARCHAR) AS station_complex_id,
       borough || ' Total System' AS display_name, annual_ridership, annual_baseline_2019,
       {rnd(sdiv('annual_ridership', 'annual_baseline_2019') + ' * 100', 2)} AS recovery_pct,
       'system_inclusive' AS data_quality_flag
FROM borough_agg
""", ("borough_agg",))
key("recovery_borough", f"""
SELECT *, {tier('recovery_pct', _RTIER, 'Critical', 'N/A')} AS recovery_tier,
       {rnd("recovery_pct - " + sdiv("sum(CAST(recovery_pct AS DECIMAL(18,2))) OVER (PARTITION BY transit_year)", "count(recovery_pct) OVER (PARTITION BY transit_year)"), 2)} AS pct_vs_system_avg
FROM borough_rows
""", "borough_rows")

R.add("sc_station", f"""
SELECT 'station' AS record_type, ridership_year AS transit_year, max(borough) AS borough, station_complex_id,
       max(station_name) AS station_name,
       {rnd(davg('latitude', 12, 6), 6)} AS latitude,
       {rnd(davg('longitude', 12, 6), 6)} AS longitude,
       {dsum('monthly_ridership')} AS annual_ridership,
       {dsum('baseline_monthly_2019')} AS annual_baseline_2019,
       {rnd(sdiv(dsum('monthly_ridership'), dsum('baseline_monthly_2019')) + ' * 100', 2)} AS recovery_pct,
       CASE min(CASE data_quality_flag WHEN 'suspect_merged' THEN 0 WHEN 'suspect_split' THEN 1
                                       WHEN 'no_baseline' THEN 2 WHEN 'clean' THEN 3 ELSE 4 END)
            WHEN 0 THEN 'suspect_merged' WHEN 1 THEN 'suspect_split' WHEN 2 THEN 'no_baseline' WHEN 3 THEN 'clean' END
         AS data_quality_flag
FROM recovery GROUP BY station_complex_id, ridership_year
""", ("recovery",))
R.add("sc_station2", f"""
SELECT *,
  {rnd(sdiv("sum(CASE WHEN data_quality_flag = 'clean' THEN CAST(recovery_pct AS DECIMAL(18,2)) END) OVER (PARTITION BY borough, transit_year)",
            "count(CASE WHEN data_quality_flag = 'clean' THEN recovery_pct END) OVER (PARTITION BY borough, transit_year)"), 2)}
    AS borough_avg_recovery_pct
FROM sc_station
""", ("sc_station",))
R.add("sc_borough", f"""
SELECT 'borough' AS record_type, transit_year, borough, CAST(NULL AS VARCHAR) AS station_complex_id,
       'Borough Average' AS station_name,
       {rnd(davg('latitude', 12, 6), 6)} AS latitude,
       {rnd(davg('longitude', 12, 6), 6)} AS longitude,
       {dsum('annual_ridership')} AS annual_ridership,
       {dsum('annual_baseline_2019')} AS annual_baseline_2019,
       {rnd(sdiv(dsum('annual_ridership'), dsum('annual_baseline_2019')) + ' * 100', 2)} AS recovery_pct,
       'clean' AS data_quality_flag,
       max(borough_avg_recovery_pct) AS borough_avg_recovery_pct
FROM sc_station2 WHERE data_quality_flag = 'clean'
GROUP BY borough, transit_year
""", ("sc_station2",))
R.add("scorecard", f"""
SELECT *, {tier('recovery_pct', _RTIER, 'Critical', 'N/A')} AS recovery_tier,
       {rnd('recovery_pct - borough_avg_recovery_pct', 2)} AS pct_vs_borough_avg
FROM (SELECT * FROM sc_station2 UNION ALL BY NAME SELECT * FROM sc_borough)
""", ("sc_station2", "sc_borough"))
key("recovery_scorecard", "SELECT * FROM scorecard", "scorecard")

# crosswalk: baseline ids k -> k // 2, then the same recovery formulas.
R.add("cw_base_m", """
SELECT CAST(CAST(floor(CAST(station_complex_id AS BIGINT) / 2) AS BIGINT) AS VARCHAR) AS station_complex_id,
       transit_month AS ridership_month, sum(CAST(ridership AS DECIMAL(18,2))) AS base_m
FROM stg_base GROUP BY 1, 2
""", ("stg_base",))
R.add("cw_base_a", "SELECT station_complex_id, sum(base_m) AS base_a FROM cw_base_m GROUP BY 1", ("cw_base_m",))
R.add("cw_j", f"""
SELECT c.*, CAST(m.base_m AS DOUBLE) AS baseline_monthly_2019, CAST(a.base_a AS DOUBLE) AS baseline_annual_2019,
       {rnd(sdiv('c.monthly_ridership', 'm.base_m') + ' * 100', 2)} AS monthly_recovery_pct,
       lag(c.monthly_ridership) OVER (PARTITION BY c.station_complex_id ORDER BY c.ridership_month_date) AS prev_month_ridership
FROM monthly c
LEFT JOIN cw_base_m m ON c.station_complex_id = m.station_complex_id AND c.ridership_month = m.ridership_month
LEFT JOIN cw_base_a a ON c.station_complex_id = a.station_complex_id
""", ("monthly", "cw_base_m", "cw_base_a"))
key("crosswalk_recovery", f"""
SELECT *,
       {rnd(sdiv('monthly_ridership - prev_month_ridership', 'prev_month_ridership') + ' * 100', 2)} AS month_over_month_pct,
       CASE WHEN monthly_recovery_pct > 200 THEN 'suspect_merged' WHEN monthly_recovery_pct < 25 THEN 'suspect_split'
            WHEN baseline_monthly_2019 IS NULL THEN 'no_baseline' ELSE 'clean' END AS data_quality_flag,
       {season('ridership_month')} AS season,
       {tier('monthly_recovery_pct', _RTIER, 'Critical')} AS recovery_tier
FROM cw_j
""", "cw_j")

# split crosswalk: k keeps a third, (k + 1) % 20 gets the rest of each month, to the cent
R.add("sp_base_m", """
SELECT station_complex_id, ridership_month, sum(part) AS base_m
FROM (
  SELECT CASE WHEN keeps THEN k ELSE CAST((CAST(k AS BIGINT) + 1) % 20 AS VARCHAR) END AS station_complex_id, ridership_month,
         CASE WHEN first THEN round(base_m * share, 2) ELSE base_m - round(base_m * (1 - share), 2) END AS part
  FROM (
    SELECT station_complex_id AS k, ridership_month, base_m, keeps,
           CASE WHEN keeps THEN CAST(0.333333 AS DECIMAL(9,6)) ELSE CAST(0.666667 AS DECIMAL(9,6)) END AS share,
           keeps = (station_complex_id < CAST((CAST(station_complex_id AS BIGINT) + 1) % 20 AS VARCHAR)) AS first
    FROM base_m, (VALUES (true), (false)) t(keeps)))
GROUP BY 1, 2
""", ("base_m",))
R.add("sp_base_a", "SELECT station_complex_id, sum(base_m) AS base_a FROM sp_base_m GROUP BY 1", ("sp_base_m",))
R.add("sp_j", R._ctes["cw_j"][1].replace("cw_base", "sp_base"), ("monthly", "sp_base_m", "sp_base_a"))
key("crosswalk_split", ORACLE["crosswalk_recovery"].rpartition("\nSELECT *,")[2].join(["SELECT *,", ""]).replace("cw_j", "sp_j"), "sp_j")

# dated crosswalk: every (station, day) walks its links one by one
R.add("cd_links", """
SELECT k AS old_id, CAST(CAST(k AS BIGINT) + step AS VARCHAR) AS new_id, share, since, until
FROM (SELECT DISTINCT station_complex_id AS k FROM stg_all),
     (VALUES (0, 1, 1.0::DOUBLE, DATE '2019-07-10', DATE '9999-12-31'), (1, 1, 0.75::DOUBLE, DATE '2020-01-01', DATE '2021-06-15'),
             (1, 2, 0.25::DOUBLE, DATE '2020-01-01', DATE '2021-06-15'), (2, 1, 1.0::DOUBLE, DATE '2021-01-01', DATE '9999-12-31'),
             (19, -1, 1.0::DOUBLE, DATE '2021-03-01', DATE '2021-05-01')) v(rest, step, share, since, until)
WHERE CASE WHEN rest = 19 THEN k = '19' ELSE CAST(k AS BIGINT) % 4 = rest END
""", ("stg_all",))


def _walk(days: str) -> str:
    return f"""
WITH RECURSIVE w AS (
  SELECT id AS root, day, id AS reached, 1.0::DOUBLE AS share, [id] AS path, false AS looped FROM {days}
  UNION ALL
  SELECT root, day, new_id, w.share * l.share, list_append(path, new_id), list_contains(path, new_id)
  FROM w JOIN cd_links l ON old_id = reached AND since <= day AND day < until WHERE NOT looped
), leaf AS (
  SELECT root, day, reached, share, looped FROM w
  WHERE looped OR NOT EXISTS (SELECT 1 FROM cd_links WHERE old_id = w.reached AND since <= w.day AND w.day < until))
SELECT root, day, CASE WHEN bad THEN root ELSE reached END AS newest, CASE WHEN bad THEN 1.0::DOUBLE ELSE sum(share) END AS share, bad
FROM (SELECT *, bool_or(looped) OVER (PARTITION BY root, day) AS bad FROM leaf)
GROUP BY root, day, CASE WHEN bad THEN root ELSE reached END, bad
"""


R.add("cd_days", f"""
SELECT station_complex_id AS id, transit_date AS day, CAST(sum(CAST(ridership AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS amount,
       max({initcap('station_name')}) AS station_name, max({initcap('borough')}) AS borough,
       sum(CAST(latitude AS DECIMAL(12,6))) AS lat, count(latitude) AS n_lat, sum(CAST(longitude AS DECIMAL(12,6))) AS lon, count(longitude) AS n_lon
FROM stg_all GROUP BY 1, 2
""", ("stg_all",))
R.add("cd_walk", _walk("cd_days"), ("cd_days", "cd_links"))
R.add("cd_parts", """
SELECT d.*, newest, date_trunc('month', d.day)::DATE AS m, newest = id AS own,
       round(CAST(amount AS DECIMAL(27,2)) * CAST(sum(share) OVER upto AS DECIMAL(10,9)), 2)
       - round(CAST(amount AS DECIMAL(27,2)) * CAST(sum(share) OVER upto - share AS DECIMAL(10,9)), 2) AS part
FROM cd_days d JOIN cd_walk w ON w.root = d.id AND w.day = d.day
WINDOW upto AS (PARTITION BY d.id, d.day ORDER BY newest)
""", ("cd_days", "cd_walk"))
_OWN = "coalesce({agg}({x}) FILTER (WHERE own), {agg}({x}))"
key("crosswalk_chain", f"""
SELECT newest AS station_complex_id, {_OWN.format(agg='max', x='station_name')} AS station_name, {_OWN.format(agg='max', x='borough')} AS borough,
       {rnd(sdiv(_OWN.format(agg='sum', x='lat'), _OWN.format(agg='sum', x='n_lat')), 6)} AS latitude,
       {rnd(sdiv(_OWN.format(agg='sum', x='lon'), _OWN.format(agg='sum', x='n_lon')), 6)} AS longitude,
       CAST(year(m) AS BIGINT) AS ridership_year, CAST(month(m) AS BIGINT) AS ridership_month, m AS ridership_month_date,
       CAST(sum(part) AS DOUBLE) AS monthly_ridership
FROM cd_parts GROUP BY newest, m
""", "cd_parts")
R.add("cd_calendar", """
SELECT k AS id, CAST(x AS DATE) AS day FROM (SELECT DISTINCT old_id AS k FROM cd_links),
       generate_series(TIMESTAMP '2019-01-01', TIMESTAMP '2022-12-31', INTERVAL 1 DAY) t(x)
""", ("cd_links",))
R.add("cd_found", _walk("cd_calendar"), ("cd_calendar", "cd_links"))
key("crosswalk_cycles", """
SELECT root AS old_id, min(day) AS valid_from, CAST(max(day) + INTERVAL 1 DAY AS DATE) AS valid_to, 'cycle' AS fault, 1.0::DOUBLE AS share
FROM (SELECT root, day, date_diff('day', DATE '2019-01-01', day) - row_number() OVER (PARTITION BY root ORDER BY day) AS run FROM cd_found WHERE bad)
GROUP BY root, run
""", "cd_found")

# ------------------------------------------------------------------ staging
R.add("stg_defects", _stg("raw_monthly_defects"), ("raw_monthly_defects",))
key("stg_ridership", "SELECT * FROM stg_defects", "stg_defects")
key("ridership_all", """
SELECT * REPLACE (CASE WHEN transit_year < 2025 THEN transfers END AS transfers) FROM stg_cur
""", "stg_cur")
key("stg_rejects", """
SELECT transit_timestamp, station_complex_id, ridership,
       CASE WHEN transit_timestamp IS NULL THEN 'null_timestamp' WHEN station_complex_id IS NULL THEN 'null_station'
            WHEN ridership IS NULL THEN 'null_ridership' ELSE 'negative_ridership' END AS reject_reason
FROM raw_monthly_defects
WHERE NOT (transit_timestamp IS NOT NULL AND station_complex_id IS NOT NULL AND ridership IS NOT NULL AND ridership >= 0)
""", "raw_monthly_defects")

R.add("census_raw", """
SELECT printf('36%03d%06d', 5, n_nationkey) AS geoid,
       lower('region ' || CAST(n_regionkey AS VARCHAR)) AS borough,
       '005' AS county_fips,
       pop AS total_population,
       CAST(floor(pop / 2) + 1 AS BIGINT) AS total_households,
       CAST(floor((floor(pop / 2) + 1) * n_nationkey / 100) AS BIGINT) AS households_no_vehicle,
       CAST(CASE WHEN n_nationkey = 24 THEN -666666666 ELSE 20000 + 6000 * n_nationkey END AS BIGINT) AS median_household_income,
       CASE WHEN n_nationkey = 7 THEN NULL ELSE CAST(floor(pop * n_nationkey / 50) AS BIGINT) END AS population_in_poverty,
       CAST(floor(pop * (n_nationkey % 4) / 20) AS BIGINT) AS population_with_disability,
       1.0::DOUBLE - CAST(n_nationkey AS DOUBLE) / 100.0::DOUBLE AS car_ownership_rate,
       CASE WHEN n_nationkey = 7 THEN NULL ELSE CAST(n_nationkey AS DOUBLE) / 50.0::DOUBLE END AS poverty_rate,
       CAST(n_nationkey % 4 AS DOUBLE) / 20.0::DOUBLE AS disability_rate,
       TIMESTAMP '2024-01-01 00:00:00' AS loaded_at
FROM (SELECT n.n_nationkey, n.n_regionkey, CAST(coalesce(c.pop, 0) AS BIGINT) AS pop
      FROM nation n LEFT JOIN (SELECT c_nationkey, count(*) AS pop FROM customer GROUP BY 1) c ON n.n_nationkey = c.c_nationkey)
""")
R.add("census", f"""
SELECT geoid, {initcap('borough')} AS borough, county_fips, total_population, total_households, households_no_vehicle,
       nullif(median_household_income, -666666666) AS median_household_income,
       population_in_poverty, population_with_disability, car_ownership_rate, poverty_rate, disability_rate, loaded_at
FROM census_raw
""", ("census_raw",))
key("stg_census", "SELECT * FROM census", "census")
key("season_totals", f"""
SELECT transit_year, {season('transit_month')} AS season, {dsum('ridership')} AS total_ridership, count(*) AS row_count
FROM stg_all GROUP BY 1, 2
""", "stg_all")


# ------------------------------------------------------------------ hub + congestion
def _hub(src: str) -> str:
    return f"""
SELECT station_complex_id, max(station_name) AS station_name, max(borough) AS borough,
       {rnd(davg('latitude', 12, 6), 6)} AS latitude,
       {rnd(davg('longitude', 12, 6), 6)} AS longitude,
       transit_date, transit_hour,
       CAST(dayofweek(transit_date) + 1 AS BIGINT) AS day_of_week,
       {dsum('ridership')} AS hourly_ridership,
       CAST(count(ridership) AS BIGINT) AS fare_rows
FROM {src} GROUP BY station_complex_id, transit_date, transit_hour
"""


def _dim(hub: str) -> str:
    return f"""
SELECT station_complex_id, max(station_name) AS station_name, max(borough) AS borough,
       {rnd(davg('latitude', 12, 6), 6)} AS latitude, {rnd(davg('longitude', 12, 6), 6)} AS longitude
FROM {hub} GROUP BY station_complex_id
"""


R.add("hub_coarse", _hub("stg_coarse"), ("stg_coarse",))
R.add("hub_fine", _hub("stg_fine"), ("stg_fine",))
R.add("dim_fine", _dim("hub_fine"), ("hub_fine",))
R.add("stg_coarse_cur", "SELECT * FROM stg_coarse WHERE transit_date >= DATE '2024-01-16'", ("stg_coarse",))
R.add("stg_coarse_base", "SELECT * FROM stg_coarse WHERE transit_date < DATE '2024-01-16'", ("stg_coarse",))
R.add("hub_cur", _hub("stg_coarse_cur"), ("stg_coarse_cur",))
R.add("hub_base", _hub("stg_coarse_base"), ("stg_coarse_base",))
R.add("dim_cur", _dim("hub_cur"), ("hub_cur",))


def _system(hub: str) -> str:
    return f"""
SELECT transit_date, transit_hour, {dsum('hourly_ridership')} AS system_total_ridership, count(*) AS active_stations
FROM {hub} GROUP BY transit_date, transit_hour
"""


def _congestion(hub: str, hours: str = "rows") -> str:
    n = "sum(fare_rows)" if hours == "rows" else "count(*)"
    return f"""
SELECT s.station_complex_id, s.station_name, s.borough, s.latitude, s.longitude, s.transit_date, s.transit_hour, s.day_of_week,
       CAST(year(s.transit_date) AS BIGINT) AS ridership_year,
       {season('month(s.transit_date)')} AS season,
       s.hourly_ridership,
       {rnd(sdiv('s.hourly_ridership', sdiv('s._day', 'nullif(s._hours, 0)')), 3)} AS station_congestion_index,
       {rnd(sdiv('s.hourly_ridership', sdiv('y.system_total_ridership', 'nullif(y.active_stations, 0)')), 3)} AS system_contribution_index,
       CASE WHEN s.hourly_ridership > 5000 THEN 'suspect_high' WHEN s.hourly_ridership < 0 THEN 'suspect_negative' ELSE 'clean' END
         AS data_quality_flag,
       CASE WHEN s._rank = 1 THEN 'Peak Hour' WHEN s._rank <= 3 THEN 'Near Peak'
            WHEN s.transit_hour BETWEEN 5 AND 12 THEN 'AM Off Peak' WHEN s.transit_hour BETWEEN 13 AND 20 THEN 'PM Off Peak'
            ELSE 'Overnight' END AS hour_classification,
       CASE WHEN s._rank = 1 THEN s.transit_hour END AS station_peak_hour
FROM (SELECT *,
             sum(CAST(hourly_ridership AS DECIMAL(18,2))) OVER (PARTITION BY station_complex_id, transit_date) AS _day,
             {n} OVER (PARTITION BY station_complex_id, transit_date) AS _hours,
             dense_rank() OVER (PARTITION BY station_complex_id, transit_date ORDER BY hourly_ridership DESC) AS _rank
      FROM {hub}) s
JOIN ({_system(hub)}) y ON s.transit_date = y.transit_date AND s.transit_hour = y.transit_hour
"""


R.add("cong_coarse", _congestion("hub_coarse"), ("hub_coarse",))
R.add("cong_cur", _congestion("hub_cur"), ("hub_cur",))
key("fare_consolidated", "SELECT * FROM hub_coarse", "hub_coarse")
key("system_hourly", _system("hub_coarse"), "hub_coarse")
key("peak_rank", """
SELECT station_complex_id, transit_date, transit_hour, hourly_ridership,
       CAST(dense_rank() OVER (PARTITION BY station_complex_id, transit_date ORDER BY hourly_ridership DESC) AS BIGINT) AS daily_peak_rank
FROM hub_coarse
""", "hub_coarse")
key("congestion_hourly", "SELECT * FROM cong_coarse", "cong_coarse")
R.add("cong_coarse_distinct", _congestion("hub_coarse", "distinct"), ("hub_coarse",))
key("congestion_hourly_distinct", "SELECT * FROM cong_coarse_distinct", "cong_coarse_distinct")

_BUCKET = "CASE WHEN {h} BETWEEN 5 AND 12 THEN 'AM' WHEN {h} BETWEEN 13 AND 20 THEN 'PM' ELSE 'Late Night' END"
R.add("capacity", f"""
SELECT station_complex_id, {_BUCKET.format(h='transit_hour')} AS time_bucket,
       max(hourly_ridership) AS max_2019_ridership,
       {rnd('quantile_cont(hourly_ridership, 0.95)', 0)} AS p95_capacity_proxy
FROM hub_base GROUP BY 1, 2
""", ("hub_base",))
R.add("capacity_all", R._ctes["capacity"][1].replace("FROM hub_base", "FROM hub_coarse"), ("hub_coarse",))
key("capacity_p95", "SELECT * FROM capacity_all", "capacity_all")
key("capacity_p95_fare_rows", f"""
SELECT station_complex_id, {_BUCKET.format(h='transit_hour')} AS time_bucket,
       max(ridership) AS max_2019_ridership,
       {rnd('quantile_cont(ridership, 0.95)', 0)} AS p95_capacity_proxy
FROM stg_coarse GROUP BY 1, 2
""", "stg_coarse")


def _mode(src: str, keys: list[str], col: str, out: str) -> str:
    """Exact mode with smallest-value tie-break, as a count + row_number."""
    k = ", ".join(keys)
    return f"""
SELECT g.*, m.{out}
FROM (SELECT DISTINCT {k} FROM {src}) g
LEFT JOIN (
  SELECT {k}, {col} AS {out}
  FROM (SELECT {k}, {col}, row_number() OVER (PARTITION BY {k} ORDER BY count(*) DESC, {col} ASC) AS rn
        FROM {src} WHERE {col} IS NOT NULL GROUP BY {k}, {col})
  WHERE rn = 1) m
ON {' AND '.join(f'g.{x} = m.{x}' for x in keys)}
"""


key("top_value_per_group", _mode("cong_coarse", ["station_complex_id", "day_of_week"], "station_peak_hour", "most_common_peak_hour"),
    "cong_coarse")



def _listed(src: str, keys: str, size: int) -> str:
    """The ``size`` most frequent values of each key; what a dropped one may count raises the key's cut."""
    return (f"SELECT {keys}, value, n, miss, greatest(cut, coalesce(max(n + miss) FILTER (WHERE place > {size}) OVER (PARTITION BY {keys}), 0)) AS cut"
            f" FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY n DESC, value) AS place FROM ({src}))"
            f" QUALIFY place <= {size}")


def _merged_counts(src: str, keys: str, fine: str) -> str:
    return (f"SELECT {keys}, value, sum(n) AS n, sum(miss) + any_value(hid) - sum(cut) AS miss, any_value(hid) AS cut FROM {src}"
            f" JOIN (SELECT {keys}, sum(cut) AS hid FROM (SELECT DISTINCT {fine}, cut FROM {src}) GROUP BY {keys}) USING ({keys}) GROUP BY {keys}, value")


_SD = "station_complex_id, day_of_week"
R.add("tv_day", _listed(f"SELECT {_SD}, date_trunc('week', transit_date) AS week, transit_date, hour_classification AS value, count(*) AS n, 0 AS miss, 0 AS cut"
                        " FROM cong_coarse WHERE hour_classification IS NOT NULL GROUP BY ALL", f"{_SD}, week, transit_date", 2), ("cong_coarse",))
R.add("tv_week", _listed(_merged_counts("tv_day", f"{_SD}, week", f"{_SD}, week, transit_date"), f"{_SD}, week", 2), ("tv_day",))
R.add("tv_all", _listed(_merged_counts("tv_week", _SD, f"{_SD}, week"), _SD, 2), ("tv_week",))
key("top_value_from_sketches", f"""
SELECT {_SD}, v AS most_common_period, CAST(top AS BIGINT) AS n_least, CAST(max(n + miss) FILTER (WHERE value = v) AS BIGINT) AS n_most,
       bool_and(value = v OR n + miss < top OR (n + miss = top AND value > v)) AND max(cut) < top AS sure
FROM (SELECT *, first_value(value) OVER w AS v, first_value(n) OVER w AS top FROM tv_all WINDOW w AS (PARTITION BY {_SD} ORDER BY n DESC, value))
GROUP BY {_SD}, v, top
""", "tv_all")


def _cells(src: str, keys: str, size: int = 200) -> str:
    """Weighted values into cells of a ``size``-th of their key's weight by where they begin; heavy ones apart."""
    part, lead = (f"PARTITION BY {keys}", f"{keys}, ") if keys else ("", "")
    return (f"SELECT {lead}max(v) AS v, sum(w) AS w FROM ("
            f"SELECT *, sum(w) OVER ({part} ORDER BY v) - w AS b, sum(w) OVER ({part}) AS n FROM (SELECT {lead}v, sum(w) AS w FROM {src} GROUP BY ALL))"
            f" GROUP BY {lead}CASE WHEN w * {size} < n THEN b * {size} // n END, CASE WHEN w * {size} >= n THEN v END")


R.add("qp_rows", "SELECT station_complex_id, transit_year, transit_month, transit_date, ridership AS v, 1 AS w FROM stg_all WHERE ridership IS NOT NULL", ("stg_all",))
_GRAINS = ["station_complex_id, transit_year, transit_month, transit_date", "station_complex_id, transit_year, transit_month",
           "station_complex_id, transit_year", "station_complex_id", ""]
for _i, _g in enumerate(_GRAINS):
    R.add(f"qp_{_i}", _cells(f"qp_{_i - 1}" if _i else "qp_rows", _g), (f"qp_{_i - 1}" if _i else "qp_rows",))


def _read_points(i: int) -> str:
    keys = _GRAINS[i]
    part, lead = (f"PARTITION BY {keys}", f"{keys}, ") if keys else ("", "")
    reach = ", ".join(f"min(v) FILTER (WHERE e >= {q}::DOUBLE * n) AS {name}" for q, name in ((0.25, "p25"), (0.5, "p50"), (0.95, "p95")))
    return (f"SELECT {lead}CAST(max(n) AS BIGINT) AS n, {reach}, {(i + 1) / 200}::DOUBLE AS rank_error"
            f" FROM (SELECT {lead}v, sum(sum(w)) OVER ({part} ORDER BY v) AS e, sum(sum(w)) OVER ({part}) AS n FROM qp_{i} GROUP BY {lead}v)"
            + (f" GROUP BY {keys}" if keys else ""))


key("quantiles_from_sketches", "\nUNION ALL BY NAME\n".join(_read_points(i) for i in range(1, len(_GRAINS))), f"qp_{len(_GRAINS) - 1}")

_MART_KEYS = ["station_complex_id", "borough", "ridership_year", "season", "day_of_week", "time_period"]
R.add("mart_in", f"""
SELECT c.*, c.hour_classification AS time_period, p.p95_capacity_proxy
FROM cong_cur c LEFT JOIN capacity p
  ON c.station_complex_id = p.station_complex_id AND {_BUCKET.format(h='c.transit_hour')} = p.time_bucket
""", ("cong_cur", "capacity"))
R.add("mart_mode", _mode("mart_in", _MART_KEYS, "station_peak_hour", "most_common_peak_hour"), ("mart_in",))
R.add("mart_g", f"""
SELECT {', '.join(_MART_KEYS)},
       {rnd(davg('latitude', 12, 6), 6)} AS latitude, {rnd(davg('longitude', 12, 6), 6)} AS longitude,
       max(p95_capacity_proxy) AS p95_capacity_ceiling,
       count(*) AS observation_count,
       {rnd(davg('hourly_ridership'), 1)} AS avg_hourly_ridership,
       quantile_disc(hourly_ridership, 0.5) AS median_hourly_ridership,
       {rnd(davg('station_congestion_index', 18, 3), 3)} AS avg_congestion_index,
       {rnd(sdiv(davg('hourly_ridership'), 'max(p95_capacity_proxy)'), 3)} AS throughput_stress_index
FROM mart_in GROUP BY {', '.join(_MART_KEYS)}
""", ("mart_in",))
_ITIER = ((15.0, "High Congestion"), (8.0, "Moderate"), (2.0, "Baseline"))
_ITIER_LOW = ((4.0, "High Congestion"), (3.0, "Moderate"), (1.0, "Baseline"))
_STIER = ((0.90, "At Capacity"), (0.70, "High Stress"), (0.50, "Moderate Stress"))


def _mart_sql(itier) -> str:
    on = " AND ".join(f"g.{x} = m.{x}" for x in _MART_KEYS)
    return f"""
SELECT g.*, m.most_common_peak_hour, d.station_name,
       {tier('g.avg_congestion_index', itier, 'Off Peak')} AS congestion_intensity_tier,
       {tier('g.throughput_stress_index', _STIER, 'Low Stress')} AS throughput_stress_tier
FROM mart_g g JOIN mart_mode m ON {on}
LEFT JOIN dim_cur d ON g.station_complex_id = d.station_complex_id
"""


R.add("mart", _mart_sql(_ITIER), ("mart_g", "mart_mode", "dim_cur"))
R.add("mart_low", _mart_sql(_ITIER_LOW), ("mart_g", "mart_mode", "dim_cur"))
key("congestion_mart", "SELECT * FROM mart", "mart")
key("congestion_mart_low", "SELECT * FROM mart_low", "mart_low")
key("station_thresholds", f"""
SELECT h.station_complex_id, h.transit_date, h.transit_hour, h.hourly_ridership, t.station_threshold,
       h.hourly_ridership > t.station_threshold AS above_threshold
FROM hub_coarse h JOIN (SELECT station_complex_id, {rnd('quantile_cont(hourly_ridership, 0.95)', 2)} AS station_threshold
                        FROM hub_coarse GROUP BY 1) t ON h.station_complex_id = t.station_complex_id
""", "hub_coarse")

# ------------------------------------------------------------------ utilization
R.add("dense_fine", """
SELECT d.station_complex_id, d.transit_date, CAST(h.h AS BIGINT) AS transit_hour,
       coalesce(f.hourly_ridership, 0.0::DOUBLE) AS hourly_ridership,
       CAST(CASE WHEN f.hourly_ridership IS NULL THEN 1 ELSE 0 END AS INTEGER) AS is_gap_hour
FROM (SELECT DISTINCT station_complex_id, transit_date FROM hub_fine) d
CROSS JOIN range(0, 24) h(h)
LEFT JOIN hub_fine f
  ON f.station_complex_id = d.station_complex_id AND f.transit_date = d.transit_date AND f.transit_hour = h.h
""", ("hub_fine",))
R.add("profile_fine", f"""
SELECT station_complex_id, transit_hour,
       CAST(sum(CAST(hourly_ridership AS DECIMAL(18,2))) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS historical_avg_this_hour,
       {rnd(sdiv('count_if(hourly_ridership = 0)', 'count(*)'), 4)} AS historical_zero_rate,
       count(*) AS days_observed
FROM dense_fine GROUP BY 1, 2
""", ("dense_fine",))
R.add("rolling_fine", """
SELECT *, count_if(hourly_ridership = 0) OVER (PARTITION BY station_complex_id, transit_date ORDER BY transit_hour
                                               ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS consecutive_zero_count
FROM dense_fine
""", ("dense_fine",))
R.add("status_fine", """
SELECT r.*, p.historical_avg_this_hour, p.historical_zero_rate, p.days_observed,
       CASE WHEN r.hourly_ridership > 0 THEN 'Active'
            WHEN r.hourly_ridership = 0 AND r.transit_hour BETWEEN 0 AND 4 THEN 'Expected Low'
            WHEN r.hourly_ridership = 0 AND p.historical_zero_rate >= 0.5 THEN 'Expected Low'
            WHEN r.hourly_ridership = 0 AND p.historical_avg_this_hour > 50 AND r.consecutive_zero_count >= 2 THEN 'Possible Disruption'
            WHEN r.hourly_ridership = 0 AND p.historical_avg_this_hour > 50 THEN 'Anomalous Zero'
            ELSE 'Expected Low' END AS utilization_status
FROM rolling_fine r LEFT JOIN profile_fine p
  ON r.station_complex_id = p.station_complex_id AND r.transit_hour = p.transit_hour
""", ("rolling_fine", "profile_fine"))
R.add("daily_fine", f"""
SELECT u.station_complex_id, d.station_name, d.borough, d.latitude, d.longitude, u.transit_date,
       CAST(year(u.transit_date) AS BIGINT) AS ridership_year, {season('month(u.transit_date)')} AS season,
       u.active_hours, u.gap_hours,
       {rnd(sdiv('u.active_hours', '24'), 3)} AS utilization_rate,
       {rnd(sdiv('u._sum', 'u.active_hours'), 2)} AS demand_intensity,
       u.am_active_hours, u.pm_active_hours, u.disruption_hours, u.anomalous_zero_hours, u.expected_low_hours,
       u.max_consecutive_zeros, CAST(u._sum AS DOUBLE) AS daily_ridership
FROM (SELECT station_complex_id, transit_date,
             count_if(hourly_ridership > 0) AS active_hours,
             count_if(is_gap_hour = 1) AS gap_hours,
             sum(CAST(hourly_ridership AS DECIMAL(18,2))) AS _sum,
             count_if(transit_hour BETWEEN 5 AND 12 AND hourly_ridership > 0) AS am_active_hours,
             count_if(transit_hour BETWEEN 13 AND 20 AND hourly_ridership > 0) AS pm_active_hours,
             count_if(utilization_status = 'Possible Disruption') AS disruption_hours,
             count_if(utilization_status = 'Anomalous Zero') AS anomalous_zero_hours,
             count_if(utilization_status = 'Expected Low') AS expected_low_hours,
             max(consecutive_zero_count) AS max_consecutive_zeros
      FROM status_fine GROUP BY 1, 2) u
LEFT JOIN dim_fine d ON u.station_complex_id = d.station_complex_id
""", ("status_fine", "dim_fine"))
R.add("annual_fine", f"""
SELECT station_complex_id, ridership_year AS transit_year,
       {rnd(sdiv('sum(CAST(demand_intensity AS DECIMAL(18,2)))', 'count(demand_intensity)'), 1)} AS avg_demand_intensity,
       {rnd(sdiv('sum(disruption_hours) * 1000', 'sum(active_hours)'), 2)} AS disruption_rate_per_1k_hours
FROM daily_fine GROUP BY 1, 2
""", ("daily_fine",))
key("hour_spine", "SELECT * FROM dense_fine", "dense_fine")
key("hour_profile", "SELECT * FROM profile_fine", "profile_fine")
key("rolling_zero_count", "SELECT * FROM rolling_fine", "rolling_fine")
key("zero_streaks", """
SELECT station_complex_id, transit_date, transit_hour, hourly_ridership,
       CAST(CASE WHEN hourly_ridership = 0 THEN
         count_if(hourly_ridership = 0) OVER (PARTITION BY station_complex_id, transit_date, island ORDER BY transit_hour
                                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
       ELSE 0 END AS BIGINT) AS zero_streak
FROM (SELECT *, sum(CASE WHEN hourly_ridership > 0 THEN 1 ELSE 0 END)
                  OVER (PARTITION BY station_complex_id, transit_date ORDER BY transit_hour
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island
      FROM dense_fine)
""", "dense_fine")
R.add("hub_years", _hub("stg_all"), ("stg_all",))
R.add("dense_years", R._ctes["dense_fine"][1].replace("hub_fine", "hub_years"), ("hub_years",))


def _outages(dense: str) -> str:
    """Gaps and islands over each station's whole series of hours."""
    return f"""
SELECT station_complex_id, CAST(DATE '1970-01-01' + CAST(a // 24 AS INTEGER) AS DATE) AS start_date, a % 24 AS start_hour,
       CAST(DATE '1970-01-01' + CAST(b // 24 AS INTEGER) AS DATE) AS end_date, b % 24 AS end_hour, b - a + 1 AS outage_hours
FROM (SELECT station_complex_id, min(h) AS a, max(h) AS b
      FROM (SELECT station_complex_id, h, h - row_number() OVER (PARTITION BY station_complex_id ORDER BY h) AS island
            FROM (SELECT station_complex_id, CAST(date_diff('day', DATE '1970-01-01', transit_date) AS BIGINT) * 24 + transit_hour AS h
                  FROM {dense} WHERE hourly_ridership = 0))
      GROUP BY station_complex_id, island)
"""


key("active_stations_rollup", """
SELECT CASE WHEN grouping(m) = 1 THEN 'all' WHEN grouping(d) = 1 THEN 'month' WHEN grouping(h) = 1 THEN 'day' ELSE 'hour' END AS grain,
       CASE WHEN grouping(d) = 0 THEN d WHEN grouping(m) = 0 THEN m END AS period_start, h AS transit_hour, count(DISTINCT s) AS active_stations
FROM (SELECT station_complex_id AS s, transit_date AS d, transit_hour AS h, CAST(date_trunc('month', transit_date) AS DATE) AS m FROM hub_fine)
GROUP BY GROUPING SETS ((m, d, h), (m, d), (m), ())
""", "hub_fine")
key("station_hour_thresholds", f"""
SELECT station_complex_id, day_of_week, transit_hour, n, {rnd('m', 4)} AS median_ridership, {rnd('mad', 4)} AS median_deviation,
       {rnd('m + 3.0::DOUBLE * 1.4826::DOUBLE * mad', 4)} AS threshold
FROM (SELECT station_complex_id, day_of_week, transit_hour, count(*) AS n, max(m) AS m, quantile_cont(abs(hourly_ridership - m), 0.5) AS mad
      FROM (SELECT *, quantile_cont(hourly_ridership, 0.5) OVER (PARTITION BY station_complex_id, day_of_week, transit_hour) AS m FROM hub_coarse)
      GROUP BY 1, 2, 3)
""", "hub_coarse")
key("outage_episodes", _outages("dense_fine"), "dense_fine")
key("outage_episodes_years", _outages("dense_years"), "dense_years")
key("utilization_status", "SELECT * FROM status_fine", "status_fine")
key("utilization_daily", "SELECT * FROM daily_fine", "daily_fine")
key("utilization_annual", "SELECT * FROM annual_fine", "annual_fine")


def _mart_family(sfx: str, cong: str, cap: str, dim: str) -> None:
    """Register mart_in/mart_mode/mart_g CTEs for one (hourly, capacity, dim) triple."""
    R.add(f"mart_in{sfx}", f"""
SELECT c.*, c.hour_classification AS time_period, p.p95_capacity_proxy
FROM {cong} c LEFT JOIN {cap} p
  ON c.station_complex_id = p.station_complex_id AND {_BUCKET.format(h='c.transit_hour')} = p.time_bucket
""", (cong, cap))
    R.add(f"mart_mode{sfx}", _mode(f"mart_in{sfx}", _MART_KEYS, "station_peak_hour", "most_common_peak_hour"), (f"mart_in{sfx}",))
    g = R._ctes["mart_g"][1].replace("FROM mart_in ", f"FROM mart_in{sfx} ")
    R.add(f"mart_g{sfx}", g, (f"mart_in{sfx}",))
    on = " AND ".join(f"g.{x} = m.{x}" for x in _MART_KEYS)
    R.add(f"mart{sfx}", f"""
SELECT g.*, m.most_common_peak_hour, d.station_name,
       {tier('g.avg_congestion_index', _ITIER, 'Off Peak')} AS congestion_intensity_tier,
       {tier('g.throughput_stress_index', _STIER, 'Low Stress')} AS throughput_stress_tier
FROM mart_g{sfx} g JOIN mart_mode{sfx} m ON {on}
LEFT JOIN {dim} d ON g.station_complex_id = d.station_complex_id
""", (f"mart_g{sfx}", f"mart_mode{sfx}", dim))


# ------------------------------------------------------------------ catchment (B6)
R.add("entr", """
SELECT s.station_complex_id, e.e AS entrance,
       (CAST(s.station_complex_id AS BIGINT) * 7 + e.e * 3) % 50 AS cx0,
       (CAST(s.station_complex_id AS BIGINT) * 13 + e.e * 5) % 50 AS cy0
FROM (SELECT DISTINCT station_complex_id FROM raw_monthly WHERE station_complex_id IS NOT NULL) s
JOIN range(0, 3) e(e) ON e.e <= CAST(s.station_complex_id AS BIGINT) % 3
""", ("raw_monthly",))
R.add("cc", """
SELECT DISTINCT station_complex_id, CAST(cx0 + dx AS BIGINT) AS cx, CAST(cy0 + dy AS BIGINT) AS cy
FROM entr, range(-8, 9) a(dx), range(-8, 9) b(dy)
WHERE dx * dx + dy * dy <= 64
""", ("entr",))
R.add("tc", """
SELECT geo_id, cx, CAST(unnest(range(y0, y0 + 10)) AS BIGINT) AS cy
FROM (SELECT geo_id, y0, CAST(unnest(range(x0, x0 + 10)) AS BIGINT) AS cx
      FROM (SELECT printf('36%03d%06d', 5, n_nationkey) AS geo_id,
                   (n_nationkey % 5) * 10 AS x0, CAST(floor(n_nationkey / 5) AS BIGINT) * 10 AS y0
            FROM nation))
""")
R.add("cw", """
SELECT s.station_complex_id, s.geo_id, s.intersect_cells, b.buffer_cells, t.tract_cells,
       CAST(s.intersect_cells AS DOUBLE) / CAST(b.buffer_cells AS DOUBLE) AS catchment_weight,
       CAST(s.intersect_cells AS DOUBLE) / CAST(t.tract_cells AS DOUBLE) AS tract_coverage_pct
FROM (SELECT station_complex_id, geo_id, count(*) AS intersect_cells FROM cc JOIN tc USING (cx, cy) GROUP BY 1, 2) s
JOIN (SELECT station_complex_id, count(*) AS buffer_cells FROM cc GROUP BY 1) b USING (station_complex_id)
JOIN (SELECT geo_id, count(*) AS tract_cells FROM tc GROUP BY 1) t USING (geo_id)
""", ("cc", "tc"))
R.add("dim_all", _dim("stg_all"), ("stg_all",))


def _wm(x: str, aware: bool) -> str:
    den = f"sum(CASE WHEN {x} IS NOT NULL THEN intersect_cells END)" if aware else "sum(intersect_cells)"
    return sdiv(f"sum(CAST({x} AS DECIMAL(16,6)) * intersect_cells)", den)


_INCOME = ((40000, "Low Income"), (75000, "Middle Income"), (120000, "Upper Middle Income"))
R.add("demo", f"""
SELECT g.station_complex_id, d.station_name, d.borough, d.latitude, d.longitude,
       g.tracts_in_catchment, g.tracts_with_demographic_data,
       {rnd('g._pop', 2)} AS catchment_population,
       {rnd('g._inc', 2)} AS weighted_mean_income,
       {rnd('g._pov', 4)} AS weighted_poverty_rate,
       {rnd('g._car', 4)} AS weighted_car_ownership_rate,
       {rnd('g._dis', 4)} AS weighted_disability_rate,
       {tier(rnd('g._inc', 2), _INCOME, 'High Income', None, '<')} AS income_tier
FROM (SELECT w.station_complex_id,
             count(w.geo_id) AS tracts_in_catchment,
             count_if(c.median_household_income IS NOT NULL) AS tracts_with_demographic_data,
             {sdiv('sum(c.total_population * w.intersect_cells)', 'max(w.buffer_cells)')} AS _pop,
             {_wm('c.median_household_income', True)} AS _inc,
             {_wm('c.poverty_rate', False)} AS _pov,
             {_wm('c.car_ownership_rate', False)} AS _car,
             {_wm('c.disability_rate', False)} AS _dis
      FROM cw w LEFT JOIN census c ON w.geo_id = c.geoid
      GROUP BY w.station_complex_id) g
LEFT JOIN dim_all d ON g.station_complex_id = d.station_complex_id
""", ("cw", "census", "dim_all"))
key("catchment_cells", "SELECT * FROM cc", "cc")
key("tract_cells", "SELECT * FROM tc", "tc")
key("tract_cells_polygon", "SELECT * FROM tc", "tc")
key("catchment_weights", "SELECT * FROM cw", "cw")

R.add("tracts", """
SELECT '36005' || lpad(CAST(n_nationkey AS VARCHAR), 6, '0') AS geo_id,
       (n_nationkey % 5) * 1000.0::DOUBLE AS xmin, (n_nationkey // 5) * 1000.0::DOUBLE AS ymin,
       (n_nationkey % 5 + 1) * 1000.0::DOUBLE AS xmax, (n_nationkey // 5 + 1) * 1000.0::DOUBLE AS ymax
FROM nation
""")
# Shapes as directed edges (lower end first; d: what the winding number gains to the right of the edge).
# Squares without a rhombus, with a small square in it again; areas of squares cut by cells in closed form (Green).
R.add("shape_edges", """
WITH t AS (SELECT *, (xmin + xmax) / 2 AS mx, (ymin + ymax) / 2 AS my FROM tracts),
p AS (
  SELECT geo_id, 1 AS sign, [[xmin, ymin], [xmax, ymin], [xmax, ymax], [xmin, ymax]] AS r FROM t
  UNION ALL SELECT geo_id, -1, [[mx - 250, my], [mx, my - 300], [mx + 250, my], [mx, my + 300]] FROM t
  UNION ALL SELECT geo_id, 1, [[mx - 60, my - 60], [mx + 60, my - 60], [mx + 60, my + 60], [mx - 60, my + 60]] FROM t
),
e AS (SELECT geo_id, sign, r[i] AS a, r[i % 4 + 1] AS b FROM p, range(1, 5) n(i))
SELECT geo_id, CASE WHEN a[2] < b[2] THEN a[1] ELSE b[1] END AS xl, least(a[2], b[2]) AS yl,
       CASE WHEN a[2] < b[2] THEN b[1] ELSE a[1] END AS xh, greatest(a[2], b[2]) AS yh,
       CASE WHEN a[2] > b[2] THEN sign ELSE -sign END AS d
FROM e WHERE a[2] <> b[2]
""", ("tracts",))


def _swept(cells: str) -> str:
    """Area of each cell right of the shape's edges: the mean of a clamped line has a closed form."""
    g = "CASE WHEN {t} <= x0 THEN x0 * {t} WHEN {t} >= x1 THEN x1 * {t} + (x0 * x0 - x1 * x1) / 2 ELSE ({t} * {t} + x0 * x0) / 2 END"
    return f"""
SELECT geo_id, level, qx, qy, size,
       sum(d * (yb - ya) * (x1 - CASE WHEN abs(xb - xa) < 1e-9 THEN greatest(x0, least(x1, xa))
                                      ELSE ({g.format(t='xb')} - {g.format(t='xa')}) / (xb - xa) END)) AS area
FROM (SELECT *, xl + (xh - xl) * ((ya - yl) / (yh - yl)) AS xa, xl + (xh - xl) * ((yb - yl) / (yh - yl)) AS xb
      FROM (SELECT c.*, e.xl, e.yl, e.xh, e.yh, e.d, qx * size AS x0, (qx + 1) * size AS x1,
                   greatest(e.yl, qy * size) AS ya, least(e.yh, (qy + 1) * size) AS yb
            FROM ({cells}) c JOIN shape_edges e USING (geo_id))
      WHERE ya < yb)
GROUP BY ALL HAVING area > 1e-6
"""


def _quadtree(levels: int = 4, root: float = 1600.0) -> str:
    first = f"""
SELECT geo_id, 0 AS level, CAST(x AS BIGINT) AS qx, CAST(y AS BIGINT) AS qy, {root}::DOUBLE AS size
FROM (SELECT geo_id, floor(min(least(xl, xh)) / {root}) AS xa, ceil(max(greatest(xl, xh)) / {root}) AS xb,
             floor(min(yl) / {root}) AS ya, ceil(max(yh) / {root}) AS yb FROM shape_edges GROUP BY 1),
     range(-100, 100) a(x), range(-100, 100) b(y)
WHERE x >= xa AND x < xb AND y >= ya AND y < yb
"""
    ctes, done = [f"q0 AS ({_swept(first)})"], []
    for n in range(1, levels + 1):
        four = f"""SELECT geo_id, level + 1 AS level, qx * 2 + i AS qx, qy * 2 + j AS qy, size / 2 AS size
FROM q{n - 1}, range(0, 2) a(i), range(0, 2) b(j) WHERE area < size * size - 1e-6"""
        ctes.append(f"q{n} AS ({_swept(four)})")
        done.append(f"SELECT * FROM q{n - 1} WHERE area >= size * size - 1e-6")
    return f"WITH {', '.join(ctes)} " + " UNION ALL ".join([*done, f"SELECT * FROM q{levels}"])


key("tract_cells_rings", f"""
SELECT geo_id, level, qx, qy, area >= size * size - 1e-6 AS inside, {rnd('area', 2)} AS area FROM ({_quadtree()})
""", "shape_edges")

# Discs of 64 points as edges; shared areas by slabs between all heights where edges of a pair begin, end or meet.
R.add("disc_edges", """
WITH p AS (
  SELECT station_complex_id, n.i,
         x + 800.0::DOUBLE * cos(2 * pi() * n.i / 64) AS xa, y + 800.0::DOUBLE * sin(2 * pi() * n.i / 64) AS ya,
         x + 800.0::DOUBLE * cos(2 * pi() * (n.i + 1) / 64) AS xb, y + 800.0::DOUBLE * sin(2 * pi() * (n.i + 1) / 64) AS yb
  FROM (SELECT *, cx0 * 100.0::DOUBLE AS x, cy0 * 100.0::DOUBLE AS y FROM entr), range(0, 64) n(i)
)
SELECT station_complex_id, CASE WHEN ya < yb THEN xa ELSE xb END AS xl, least(ya, yb) AS yl,
       CASE WHEN ya < yb THEN xb ELSE xa END AS xh, greatest(ya, yb) AS yh, CASE WHEN ya > yb THEN 1 ELSE -1 END AS d
FROM p WHERE abs(ya - yb) > 1e-9
""", ("entr",))


def _slabs(edges: str, inside: str) -> str:
    """Covered area of each pair from its edges (s, g, xl, yl, xh, yh, da, db)."""
    return f"""
WITH e AS MATERIALIZED ({edges}),
ys AS (
  SELECT s, g, yl AS y FROM e UNION SELECT s, g, yh FROM e
  UNION SELECT s, g, y FROM (
    SELECT a.s, a.g, a.yl + (b.xl - a.xl - mb * (b.yl - a.yl)) / nullif(ma - mb, 0) AS y, greatest(a.yl, b.yl) AS lo, least(a.yh, b.yh) AS hi
    FROM (SELECT *, (xh - xl) / (yh - yl) AS ma FROM e) a
    JOIN (SELECT *, (xh - xl) / (yh - yl) AS mb FROM e) b ON a.s = b.s AND a.g = b.g AND a.yl < b.yh AND b.yl < a.yh)
  WHERE y > lo AND y < hi
),
slab AS (SELECT s, g, y AS lo, lead(y) OVER (PARTITION BY s, g ORDER BY y) AS hi FROM ys),
met AS (
  SELECT slab.s, slab.g, lo, hi, da, db, xl + (xh - xl) * (((lo + hi) / 2 - yl) / (yh - yl)) AS x
  FROM slab JOIN e ON slab.s = e.s AND slab.g = e.g AND e.yl <= (lo + hi) / 2 AND (lo + hi) / 2 < e.yh WHERE hi > lo
),
walked AS (
  SELECT s, g, lo, hi, x, lead(x) OVER w AS nx, sum(da) OVER (w ROWS UNBOUNDED PRECEDING) AS wa, sum(db) OVER (w ROWS UNBOUNDED PRECEDING) AS wb
  FROM met WINDOW w AS (PARTITION BY s, g, lo ORDER BY x, da, db)
)
SELECT s, g, sum((nx - x) * (hi - lo)) AS area FROM walked WHERE {inside} AND nx IS NOT NULL GROUP BY 1, 2
"""


key("catchment_weights_clipped", f"""
SELECT * FROM (WITH box AS (SELECT station_complex_id, min(xl) - 1e3 AS xa, max(xh) + 1e3 AS xb, min(yl) AS ya, max(yh) AS yb FROM disc_edges GROUP BY 1),
tb AS (SELECT geo_id, min(xl) AS xa, max(xh) AS xb, min(yl) AS ya, max(yh) AS yb FROM shape_edges GROUP BY 1),
pairs AS (SELECT station_complex_id AS s, geo_id AS g FROM box, tb WHERE box.xa < tb.xb AND tb.xa < box.xb AND box.ya < tb.yb AND tb.ya < box.yb),
shared AS ({_slabs("SELECT s, g, xl, yl, xh, yh, d AS da, 0 AS db FROM pairs JOIN disc_edges ON s = station_complex_id UNION ALL SELECT s, g, xl, yl, xh, yh, 0, d FROM pairs JOIN shape_edges ON g = geo_id", "wa > 0 AND wb > 0")}),
buffer AS ({_slabs("SELECT station_complex_id AS s, '' AS g, xl, yl, xh, yh, d AS da, 0 AS db FROM disc_edges", "wa > 0")}),
whole AS (SELECT geo_id, (xmax - xmin) * (ymax - ymin) - 2.0::DOUBLE * 250 * 300 + 120.0::DOUBLE * 120 AS area FROM tracts)
SELECT shared.s AS station_complex_id, shared.g AS geo_id, {rnd('shared.area', 2)} AS intersect_area, {rnd('buffer.area', 2)} AS buffer_area,
       {rnd('whole.area', 2)} AS tract_area, {rnd('shared.area / buffer.area', 6)} AS catchment_weight,
       {rnd('shared.area / whole.area', 6)} AS tract_coverage_pct
FROM shared JOIN buffer ON shared.s = buffer.s JOIN whole ON shared.g = whole.geo_id WHERE {rnd('shared.area', 2)} > 0)
""", "shape_edges", "disc_edges", "tracts")
# stations' own coordinates in metres east and north of (40.5, -74.1) on a sphere, then every cell within 8 cells
key("catchment_latlon", """
SELECT DISTINCT station_complex_id, CAST(ix + dx AS BIGINT) AS cx, CAST(iy + dy AS BIGINT) AS cy
FROM (SELECT station_complex_id,
             floor((longitude + 74.1::DOUBLE) * (pi() / 180 * 6371008.8::DOUBLE * cos(40.5::DOUBLE * (pi() / 180))) / 100.0::DOUBLE) AS ix,
             floor((latitude - 40.5::DOUBLE) * (pi() / 180 * 6371008.8::DOUBLE) / 100.0::DOUBLE) AS iy
      FROM dim_all), range(-8, 9) a(dx), range(-8, 9) b(dy)
WHERE dx * dx + dy * dy <= 64
""", "dim_all")
key("catchment_head_count", f"""
SELECT w.station_complex_id,
       CAST(sum(CAST({rnd(sdiv('c.total_population * w.intersect_cells', 'w.tract_cells'), 6)} AS DECIMAL(24,6))) AS DOUBLE) AS head_count
FROM cw w LEFT JOIN census c ON w.geo_id = c.geoid GROUP BY 1
""", "cw", "census")
key("weighted_mean", f"""
SELECT w.station_complex_id,
       {rnd(_wm('c.poverty_rate', True), 6)} AS null_aware,
       {rnd(_wm('c.poverty_rate', False), 6)} AS null_unaware
FROM cw w LEFT JOIN census c ON w.geo_id = c.geoid
GROUP BY w.station_complex_id
""", "cw", "census")
key("catchment_demographics", "SELECT * FROM demo", "demo")


# ------------------------------------------------------------------ equity / efficiency
def _nl(a: str, b: str) -> str:
    return f"(CASE WHEN ({a}) IS NULL OR ({b}) IS NULL THEN NULL ELSE least({a}, {b}) END)"


def _ng(a: str, b: str) -> str:
    return f"(CASE WHEN ({a}) IS NULL OR ({b}) IS NULL THEN NULL ELSE greatest({a}, {b}) END)"


def _equity(disr: float) -> str:
    c1 = _nl(sdiv(_ng("borough_avg_recovery_pct - recovery_pct", "0.0::DOUBLE"), "20.0"), "1.0::DOUBLE")
    c2 = _nl(sdiv("disruption_rate_per_1k_hours", f"{disr}"), "1.0::DOUBLE")
    c3 = _nl(sdiv(_ng("60000.0::DOUBLE - weighted_mean_income", "0.0::DOUBLE"), "20000.0"), "1.0::DOUBLE")
    score = rnd(f"{c1} * 33.0::DOUBLE + {c2} * 33.0::DOUBLE + {c3} * 34.0::DOUBLE", 1)
    return f"""
SELECT *, {tier('equity_risk_score', ((60, 'High Risk'), (35, 'Moderate Risk')), 'Low Risk', None)} AS equity_risk_tier
FROM (SELECT *, {score} AS equity_risk_score
      FROM (SELECT r.station_complex_id, r.station_name, r.borough, r.latitude, r.longitude, r.transit_year,
                   r.annual_ridership, r.recovery_pct, r.borough_avg_recovery_pct,
                   u.avg_demand_intensity, u.disruption_rate_per_1k_hours,
                   d.weighted_mean_income, d.weighted_poverty_rate, d.income_tier, r.data_quality_flag
            FROM scorecard r
            LEFT JOIN annual_fine u ON r.station_complex_id = u.station_complex_id AND r.transit_year = u.transit_year
            LEFT JOIN demo d ON r.station_complex_id = d.station_complex_id
            WHERE r.record_type = 'station' AND r.data_quality_flag = 'clean'))
"""


R.add("equity50", _equity(50.0), ("scorecard", "annual_fine", "demo"))
R.add("equity10", _equity(10.0), ("scorecard", "annual_fine", "demo"))
key("equity_score", "SELECT * FROM equity50", "equity50")
key("equity_score_default", "SELECT * FROM equity10", "equity10")

R.add("cong_fine", _congestion("hub_fine"), ("hub_fine",))
R.add("stg_fine_base", "SELECT * FROM stg_fine WHERE transit_date < DATE '2024-01-16'", ("stg_fine",))
R.add("hub_fine_base", _hub("stg_fine_base"), ("stg_fine_base",))
R.add("capacity_fine", R._ctes["capacity"][1].replace("FROM hub_base", "FROM hub_fine_base"), ("hub_fine_base",))
_mart_family("_fine", "cong_fine", "capacity_fine", "dim_fine")
key("efficiency_matrix", f"""
SELECT c.station_complex_id, c.station_name, c.borough, c.ridership_year AS transit_year, c.season, c.day_of_week,
       c.time_period, c.latitude, c.longitude, c.avg_hourly_ridership, c.median_hourly_ridership, c.observation_count,
       c.avg_congestion_index, c.congestion_intensity_tier, c.most_common_peak_hour,
       r.recovery_pct, r.data_quality_flag AS recovery_dq_flag,
       CASE WHEN c.avg_congestion_index >= 3.0 AND r.recovery_pct >= 70 THEN 'Thriving but Strained'
            WHEN c.avg_congestion_index >= 3.0 AND r.recovery_pct < 70 THEN 'Structural Bottleneck'
            WHEN c.avg_congestion_index < 3.0 AND r.recovery_pct >= 70 THEN 'Healthy Spare Capacity'
            ELSE 'Underutilized' END AS efficiency_quadrant,
       {tier('c.avg_congestion_index', _ITIER_LOW, 'Off Peak')} AS congestion_tier
FROM mart_fine c
LEFT JOIN (SELECT * FROM scorecard WHERE record_type = 'station') r
  ON c.station_complex_id = r.station_complex_id AND c.ridership_year = r.transit_year
""", "mart_fine", "scorecard")

# ------------------------------------------------------------------ KPIs
key("kpi_disruption_intensity", f"""
SELECT ridership_year, CAST(sum(disruption_hours) AS BIGINT) AS disruption_hours, {dsum('daily_ridership')} AS total_ridership,
       {rnd(sdiv('sum(disruption_hours) * 1000000', 'sum(CAST(daily_ridership AS DECIMAL(18,2)))'), 4)} AS disruption_hours_per_million
FROM daily_fine GROUP BY 1
""", "daily_fine")
key("kpi_disruption_share", f"""
SELECT borough, disruption_hours, {rnd(sdiv('disruption_hours * 100', 'sum(disruption_hours) OVER ()'), 2)} AS share_pct
FROM (SELECT borough, CAST(sum(disruption_hours) AS BIGINT) AS disruption_hours FROM daily_fine GROUP BY 1)
""", "daily_fine")
key("kpi_disruption_yoy", f"""
SELECT borough, period_start, disruption_hours, prev AS prev_disruption_hours,
       {rnd(sdiv('disruption_hours - prev', 'prev') + ' * 100', 2)} AS change_pct
FROM (SELECT *, lag(disruption_hours) OVER (PARTITION BY borough ORDER BY period_start) AS prev
      FROM (SELECT borough, CAST(date_trunc('week', transit_date) AS DATE) AS period_start,
                   CAST(sum(disruption_hours) AS BIGINT) AS disruption_hours
            FROM daily_fine GROUP BY 1, 2))
""", "daily_fine")


def _avg2(x: str) -> str:
    return sdiv(f"sum(CAST({x} AS DECIMAL(18,2)))", f"count({x})")


key("kpi_disruption_yearly", f"""
SELECT borough, period_start, disruption_hours, prev AS prev_disruption_hours,
       {rnd(sdiv('disruption_hours - prev', 'prev') + ' * 100', 2)} AS change_pct
FROM (SELECT *, lag(disruption_hours) OVER (PARTITION BY borough ORDER BY period_start) AS prev
      FROM (SELECT borough, CAST(date_trunc('year', transit_date) AS DATE) AS period_start, count(*) AS disruption_hours
            FROM (SELECT *, count_if(hourly_ridership = 0) OVER (PARTITION BY station_complex_id, transit_date ORDER BY transit_hour
                                                                   ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS zeros FROM dense_years) s
            LEFT JOIN dim_all USING (station_complex_id)
            WHERE hourly_ridership = 0 AND zeros >= 2 GROUP BY 1, 2))
""", "dense_years", "dim_all")
key("kpi_risk_profile", f"""
SELECT transit_year, equity_risk_tier, count(*) AS stations,
       {rnd(_avg2('weighted_mean_income'), 2)} AS avg_income,
       {rnd(_avg2('recovery_pct'), 2)} AS avg_recovery_pct,
       {rnd(_avg2('disruption_rate_per_1k_hours'), 2)} AS avg_disruption_rate
FROM equity50 GROUP BY 1, 2
""", "equity50")
key("kpi_quality_counts", """
SELECT transit_year,
       count_if(recovery_tier = 'Critical') AS critical_stations,
       count_if(data_quality_flag = 'clean') AS clean_stations,
       count_if(data_quality_flag <> 'clean') AS flagged_stations,
       count(*) AS stations
FROM scorecard WHERE record_type = 'station' GROUP BY 1
""", "scorecard")
key("kpi_income_gap", """
SELECT min(weighted_mean_income) AS min_income, max(weighted_mean_income) AS max_income,
       max(weighted_mean_income) - min(weighted_mean_income) AS income_gap,
       count(weighted_mean_income) AS stations_with_income
FROM demo
""", "demo")
key("kpi_system_recovery", f"""
SELECT transit_year, CASE WHEN grouping(borough) = 1 THEN 'System' ELSE borough END AS scope,
       {dsum('monthly_ridership')} AS annual_ridership,
       {dsum('baseline_monthly_2019')} AS annual_baseline_2019,
       {rnd(sdiv('sum(CAST(monthly_ridership AS DECIMAL(18,2)))', 'sum(CAST(baseline_monthly_2019 AS DECIMAL(18,2)))') + ' * 100', 2)} AS recovery_pct
FROM (SELECT ridership_year AS transit_year, * FROM recovery)
GROUP BY GROUPING SETS ((transit_year, borough), (transit_year))
""", "recovery")
key("kpi_row_reduction", f"""
SELECT h AS hourly_rows, m AS mart_rows, {rnd(sdiv('(h - m) * 100', 'h'), 2)} AS reduction_pct
FROM (SELECT (SELECT count(*) FROM cong_cur) AS h, (SELECT count(*) FROM mart) AS m)
""", "cong_cur", "mart")
key("kpi_index_by_class", f"""
SELECT hour_classification, count(station_congestion_index) AS hours,
       {rnd(sdiv('sum(CAST(station_congestion_index AS DECIMAL(18,3)))', 'count(station_congestion_index)'), 3)} AS mean_congestion_index
FROM cong_coarse GROUP BY 1
""", "cong_coarse")

# ------------------------------------------------------------------ meters, profiles
R.add("meter_raw", """
SELECT CAST(user_id % 10 AS VARCHAR) AS c_a, CAST(user_id % 100 AS VARCHAR) AS unit, CAST(user_id AS VARCHAR) AS scp,
       'S' || CAST(user_id % 20 AS VARCHAR) AS station, 'ace' AS line_name, 'ind' AS division,
       CAST(ts AS DATE) AS date, strftime(ts, '%H:%M:%S.%f') AS time,
       CASE WHEN event_id % 17 = 0 THEN 'RECOVR AUD' ELSE 'REGULAR' END AS description,
       ticks % 1000 AS entries, (ticks * 3) % 1000 AS exits
FROM (SELECT *, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS BIGINT) * 144
                + CAST(hour(ts) AS BIGINT) * 6 + CAST(floor(minute(ts) / 10) AS BIGINT) AS ticks
      FROM events)
""")


def _mdelta(cur: str, prev: str, cap) -> str:
    capped = f" WHEN {cur} - {prev} > {cap} THEN NULL" if cap is not None else ""
    return f"CASE WHEN {prev} IS NULL THEN NULL WHEN {cur} < {prev} THEN NULL{capped} ELSE {cur} - {prev} END"


R.add("meter_delta", f"""
SELECT c_a AS control_area, unit, scp, {initcap('station')} AS station_name, {initcap('line_name')} AS line_name,
       {initcap('division')} AS division, date AS turnstile_date, time AS turnstile_time_raw, ts AS turnstile_timestamp,
       entries AS entries_cumulative, exits AS exits_cumulative, pe AS prev_entries_cumulative, px AS prev_exits_cumulative,
       {_mdelta('entries', 'pe', 200)} AS entries_delta,
       {_mdelta('exits', 'px', None)} AS exits_delta,
       {_mdelta('entries', 'pe', 50000)} AS ridership
FROM (SELECT *, lag(entries) OVER (PARTITION BY c_a, unit, scp, station ORDER BY ts) AS pe,
                lag(exits) OVER (PARTITION BY c_a, unit, scp, station ORDER BY ts) AS px
      FROM (SELECT *, CAST(CAST(date AS VARCHAR) || ' ' || time AS TIMESTAMP) AS ts
            FROM meter_raw WHERE upper(description) = 'REGULAR'))
""", ("meter_raw",))
key("meter_delta", "SELECT * FROM meter_delta", "meter_delta")
R.add("meter_delta_5000", R._ctes["meter_delta"][1].replace("> 200 ", "> 5000 "), ("meter_raw",))
key("meter_delta_default", "SELECT * FROM meter_delta_5000", "meter_delta_5000")
_QS = ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"), (0.95, "p95"), (0.99, "p99"), (0.999, "p999"))
key("quantile_profile", "SELECT " + ", ".join(f"{rnd(f'quantile_cont(entries_delta, {q})', 4)} AS {n}" for q, n in _QS)
    + ", max(entries_delta) AS max_value, count(entries_delta) AS n FROM meter_delta WHERE entries_delta IS NOT NULL", "meter_delta")
key("income_profile", "SELECT " + ", ".join(f"quantile_disc(median_household_income, {q}) AS q{i}" for i, q in enumerate((0.0, 0.25, 0.5, 0.75, 1.0)))
    + f", {rnd(davg('median_household_income'), 2)} AS mean_income, min(median_household_income) AS min_income,"
    " max(median_household_income) AS max_income FROM census WHERE median_household_income IS NOT NULL", "census")


# ------------------------------------------------------------------ quality
def _dq(table: str, check: str, column: str, failures: str, severity: str = "error", src: str = "") -> str:
    return (f"SELECT '{table}' AS table_name, '{check}' AS check_name, '{column}' AS column_name, "
            f"CAST(({failures}) AS BIGINT) AS failures, '{severity}' AS severity, "
            f"CASE WHEN ({failures}) = 0 THEN 'pass' WHEN '{severity}' = 'warn' THEN 'warn' ELSE 'fail' END AS status"
            + (f" FROM {src}" if src else ""))


def _unique(table: str, cols: str, src: str, severity: str = "error") -> str:
    return _dq(table, "unique", cols.replace(" ", ""), f"SELECT count(*) FROM (SELECT {cols} FROM {src} GROUP BY {cols} HAVING count(*) > 1)", severity)


_REF_BOROUGHS = "('Manhattan', 'Brooklyn', 'Queens', 'Bronx', 'Staten Island')"
key("dq_not_null", " UNION ALL ".join(
    _dq("stg_ridership", "not_null", c, f"count_if({c} IS NULL)", src="stg_all")
    for c in ("transit_timestamp", "station_complex_id", "ridership", "borough", "latitude")), "stg_all")
key("dq_unique", _unique("monthly_totals", "station_complex_id, ridership_year, ridership_month", "monthly") + " UNION ALL "
    + _unique("monthly_totals", "station_complex_id, ridership_month", "monthly", "warn"), "monthly")
key("dq_accepted_values", " UNION ALL ".join([
    _dq("recovery_monthly", "accepted_values", "data_quality_flag",
        "count_if(data_quality_flag NOT IN ('clean', 'suspect_merged', 'suspect_split', 'no_baseline'))", src="recovery"),
    _dq("recovery_monthly", "accepted_values", "recovery_tier",
        "count_if(recovery_tier NOT IN ('Recovered', 'Recovering', 'Lagging', 'Critical'))", src="recovery"),
    _dq("recovery_monthly", "accepted_values", "borough", f"count_if(borough NOT IN {_REF_BOROUGHS})", "warn", src="recovery"),
    _dq("recovery_monthly", "accepted_values_clean", "recovery_tier",
        "count_if(data_quality_flag = 'clean' AND recovery_tier NOT IN ('Recovered', 'Recovering'))", src="recovery"),
]), "recovery")
key("dq_range", """
SELECT 'equity_score_bounds' AS check_name, station_complex_id, CAST(equity_risk_score AS DOUBLE) AS detail
FROM equity10 WHERE equity_risk_score < 0 OR equity_risk_score > 100
UNION ALL
SELECT 'recovery_pct_bounds', station_complex_id, CAST(monthly_recovery_pct AS DOUBLE)
FROM recovery WHERE data_quality_flag = 'clean' AND (monthly_recovery_pct < 0 OR monthly_recovery_pct > 200)
UNION ALL
SELECT 'ridership_not_negative', station_complex_id, CAST(ridership AS DOUBLE) FROM stg_all WHERE ridership < 0
UNION ALL
SELECT 'transit_year_valid', station_complex_id, CAST(transit_year AS DOUBLE)
FROM stg_all WHERE transit_year NOT IN (2022, 2023, 2024, 2025) AND transit_year IS NOT NULL
""", "equity10", "recovery", "stg_all")
key("orphan_keys", """
SELECT DISTINCT station_complex_id FROM stg_cur
WHERE station_complex_id IS NOT NULL
  AND station_complex_id NOT IN (SELECT station_complex_id FROM stg_base WHERE station_complex_id IS NOT NULL)
""", "stg_cur", "stg_base")
_HC = "('Peak Hour', 'Near Peak', 'AM Off Peak', 'PM Off Peak', 'Overnight')"
key("dq_report", " UNION ALL ".join([
    _dq("stg_ridership", "not_null", "transit_timestamp", "count_if(transit_timestamp IS NULL)", src="stg_all"),
    _dq("stg_ridership", "not_null", "station_complex_id", "count_if(station_complex_id IS NULL)", src="stg_all"),
    _dq("stg_ridership", "not_null", "ridership", "count_if(ridership IS NULL)", src="stg_all"),
    _dq("stg_ridership", "accepted_values", "borough", f"count_if(borough NOT IN {_REF_BOROUGHS})", "warn", src="stg_all"),
    _dq("stg_ridership", "ridership_not_negative", "ridership", "count_if(ridership < 0)", src="stg_all"),
    _dq("recovery_monthly", "not_null", "station_complex_id", "count_if(station_complex_id IS NULL)", src="recovery"),
    _dq("recovery_monthly", "accepted_values", "data_quality_flag",
        "count_if(data_quality_flag NOT IN ('clean', 'suspect_merged', 'suspect_split', 'no_baseline'))", src="recovery"),
    _dq("recovery_monthly", "recovery_pct_bounds", "monthly_recovery_pct",
        "count_if(data_quality_flag = 'clean' AND (monthly_recovery_pct < 0 OR monthly_recovery_pct > 200))", src="recovery"),
    _dq("recovery_scorecard", "accepted_values", "record_type", "count_if(record_type NOT IN ('station', 'borough'))", src="scorecard"),
    _dq("recovery_scorecard", "not_null", "recovery_tier", "count_if(recovery_tier IS NULL)", src="scorecard"),
    _unique("recovery_scorecard", "record_type, borough, station_complex_id, transit_year", "scorecard"),
    _dq("congestion_hourly", "accepted_values", "hour_classification", f"count_if(hour_classification NOT IN {_HC})", src="cong_coarse"),
    _dq("congestion_hourly", "accepted_values", "data_quality_flag", "count_if(data_quality_flag NOT IN ('clean'))", "warn",
        src="cong_coarse"),
]), "stg_all", "recovery", "scorecard", "cong_coarse")

# ------------------------------------------------------------------ contracts
key("contract_bronze", """
SELECT 'transit_timestamp' AS column_name, true AS present, true AS type_ok,
       (SELECT count_if(transit_timestamp IS NULL) FROM raw_monthly_defects) AS null_violations, CAST(0 AS BIGINT) AS domain_violations,
       CAST(0 AS BIGINT) AS range_violations
UNION ALL SELECT 'station_complex_id', true, true, (SELECT count_if(station_complex_id IS NULL) FROM raw_monthly_defects), 0, 0
UNION ALL SELECT 'borough', true, true, 0,
       (SELECT count_if(borough NOT IN ('MANHATTAN', 'BROOKLYN', 'QUEENS', 'BRONX', 'STATEN ISLAND')) FROM raw_monthly_defects), 0
UNION ALL SELECT 'fare_class_category', true, true, 0, (SELECT count_if(fare_class_category NOT IN ('A', 'N', 'R')) FROM raw_monthly_defects), 0
UNION ALL SELECT 'ridership', true, true, (SELECT count_if(ridership IS NULL) FROM raw_monthly_defects), 0,
       (SELECT count_if(ridership < 0) FROM raw_monthly_defects)
UNION ALL SELECT 'latitude', true, false, 0, 0, 0
UNION ALL SELECT 'station_status', false, false, NULL, NULL, NULL
UNION ALL SELECT unnest(['station_complex', 'longitude', 'transit_mode', 'payment_method', 'transfers']), true, NULL, NULL, NULL, NULL
""", "raw_monthly_defects")
key("contract_rejects", """
SELECT * FROM (
  SELECT transit_timestamp, station_complex_id, fare_class_category, ridership,
         concat_ws(',', CASE WHEN transit_timestamp IS NULL THEN 'transit_timestamp:null' END,
                   CASE WHEN station_complex_id IS NULL THEN 'station_complex_id:null' END,
                   CASE WHEN fare_class_category NOT IN ('A', 'R') THEN 'fare_class_category:domain' END,
                   CASE WHEN ridership IS NULL THEN 'ridership:null' END, CASE WHEN ridership < 0 THEN 'ridership:range' END) AS reject_reason
  FROM raw_monthly_defects)
WHERE reject_reason <> ''
""", "raw_monthly_defects")
key("contract_gold", "SELECT * FROM scorecard", "scorecard")

# ------------------------------------------------------------------ sources / sinks
key("scan_bronze_csv", "SELECT * FROM stg_all", "stg_all")
key("time_slice", "SELECT * FROM stg_coarse WHERE transit_timestamp >= TIMESTAMP '2024-01-08' AND transit_timestamp < TIMESTAMP '2024-01-15'",
    "stg_coarse")
key("land_partitioned", """
SELECT *, CAST(year(transit_timestamp) AS INTEGER) AS year, CAST(month(transit_timestamp) AS INTEGER) AS month,
       CAST(transit_timestamp AS DATE) - CAST(((date_diff('day', DATE '2024-01-01', CAST(transit_timestamp AS DATE)) % 7) + 7) % 7 AS INTEGER)
         AS week_starting
FROM raw_coarse
""", "raw_coarse")
key("quarter_bucket", f"""
SELECT transit_year, CAST(quarter(transit_timestamp) AS BIGINT) AS quarter, {dsum('ridership')} AS ridership, count(*) AS row_count
FROM stg_all GROUP BY 1, 2
""", "stg_all")
R.add("census_rows", """
SELECT 'Census Tract ' || CAST(n AS VARCHAR) AS "NAME",
       CASE WHEN n = 3 THEN '-' ELSE CAST(median_household_income AS VARCHAR) END AS "B19013_001E",
       CAST(total_population AS VARCHAR) AS "B01003_001E",
       CAST(households_no_vehicle AS VARCHAR) AS "B08201_002E",
       CAST(total_households AS VARCHAR) AS "B08201_001E",
       CAST(population_in_poverty AS VARCHAR) AS "B17001_002E",
       CAST(population_with_disability AS VARCHAR) AS "B18101_001E",
       '36' AS state,
       CASE n % 3 WHEN 0 THEN '005' WHEN 1 THEN '047' ELSE '999' END AS county,
       lpad(CAST(n AS VARCHAR), 6, '0') AS tract
FROM (SELECT *, CAST(substr(geoid, 6, 6) AS BIGINT) AS n FROM census_raw)
""", ("census_raw",))
R.add("census_typed", """
SELECT "NAME" AS neighborhood_name,
       TRY_CAST("B19013_001E" AS DOUBLE) AS median_household_income,
       TRY_CAST("B01003_001E" AS DOUBLE) AS total_population,
       TRY_CAST("B08201_002E" AS DOUBLE) AS households_no_vehicle,
       TRY_CAST("B08201_001E" AS DOUBLE) AS total_households,
       TRY_CAST("B17001_002E" AS DOUBLE) AS population_in_poverty,
       TRY_CAST("B18101_001E" AS DOUBLE) AS population_with_disability,
       state, county, tract
FROM census_rows
""", ("census_rows",))
key("census_header_json", "SELECT * FROM census_rows", "census_rows")
key("census_rejects", """
SELECT CASE n_nationkey % 9 WHEN 0 THEN 'malformed' WHEN 3 THEN 'empty' WHEN 6 THEN 'no_header' ELSE 'cell_count' END AS reject_reason,
       CASE WHEN n_nationkey % 9 = 1 THEN CAST(1 AS BIGINT) END AS row, count(*) AS n
FROM nation WHERE n_nationkey % 9 IN (0, 1, 3, 6) GROUP BY 1, 2
""")
key("coerce_numeric", "SELECT * FROM census_typed", "census_typed")
key("demographic_rates", f"""
SELECT *, {rnd('1.0::DOUBLE - ' + sdiv('households_no_vehicle', 'total_households'), 4)} AS car_ownership_rate,
          {rnd(sdiv('population_in_poverty', 'total_population'), 4)} AS poverty_rate,
          {rnd(sdiv('population_with_disability', 'total_population'), 4)} AS disability_rate
FROM census_typed
""", "census_typed")
key("geoid_borough", """
SELECT state || county || tract AS geoid,
       CASE county WHEN '005' THEN 'Bronx' WHEN '047' THEN 'Brooklyn' WHEN '061' THEN 'Manhattan' WHEN '081' THEN 'Queens'
                   WHEN '085' THEN 'Staten Island' ELSE 'Unknown' END AS borough,
       county, tract, neighborhood_name
FROM census_typed
""", "census_typed")
key("union_parts", "SELECT * EXCLUDE (transfers) FROM stg_cur UNION ALL BY NAME SELECT * FROM stg_coarse", "stg_cur", "stg_coarse")
key("sample_head", "SELECT * FROM census ORDER BY geoid LIMIT 20", "census")
key("gold_roundtrip", "SELECT * FROM scorecard", "scorecard")
key("gold_zorder", "SELECT * FROM scorecard", "scorecard")

# ------------------------------------------------------------------ incremental / streaming
key("incremental_upsert", """
SELECT event_id, ts, user_id, event_type,
       CASE WHEN event_id % 20 = 0 THEN value + 1 WHEN event_id % 1000 = 1 THEN value + 2 ELSE value END AS value,
       CAST(ts AS DATE) AS event_date
FROM events
""")
key("schema_sync", """
SELECT transit_timestamp, station_complex_id, station_complex, borough, latitude, longitude, transit_mode, payment_method,
       fare_class_category, ridership,
       CASE WHEN transit_timestamp >= TIMESTAMP '2024-01-16' THEN CAST(2 AS BIGINT) END AS ingest_batch
FROM raw_coarse
""", "raw_coarse")
key("stream_landing", "SELECT event_id, ts, user_id, event_type, value FROM events")
key("stream_dedup", "SELECT event_id, ts, user_id, event_type, value FROM events")
key("stream_dedup_late", """
SELECT event_id, ts, user_id, event_type, value FROM events
WHERE event_id % 50 = 0 AND ts < TIMESTAMP '2024-01-08' AND ts < (SELECT max(ts) FROM events) - INTERVAL 7 DAY
""")
key("stream_dedup_stateful", "SELECT event_id, ts, user_id, event_type, value FROM events")
key("stream_dedup_stateful_late", """
SELECT event_id, ts, user_id, event_type, value FROM events
WHERE event_id % 50 = 0 AND ts < TIMESTAMP '2024-01-08' AND ts < (SELECT max(ts) FROM events) - INTERVAL 7 DAY
""")
key("stream_hourly_state", "SELECT station_complex_id, transit_date, transit_hour, hourly_ridership, fare_rows FROM hub_coarse", "hub_coarse")
key("upsert_moved_key", """
SELECT event_id, ts, user_id, event_type, CASE WHEN event_id % 10 = 0 THEN value + 1 ELSE value END AS value,
       CAST(ts AS DATE) + CAST(event_id % 10 = 0 AS INTEGER) AS event_date
FROM events
""")
key("upsert_versions", """
SELECT event_id, ts, user_id, event_type, value, CAST(ts AS DATE) AS event_date, CAST(1 AS BIGINT) AS version
FROM events WHERE event_id % 7 <> 3
UNION ALL
SELECT event_id, ts, user_id, event_type, CASE WHEN moved THEN value + 1 ELSE value END,
       CAST(ts AS DATE) + CAST(moved AS INTEGER), 2
FROM (SELECT *, event_id % 10 = 0 AND event_id % 7 <> 3 AS moved FROM events)
""")
key("marts_incremental", "SELECT * FROM recovery", "recovery")
key("congestion_incremental", "SELECT * FROM cong_coarse_distinct", "cong_coarse_distinct")
key("stream_hourly_late", f"""
SELECT station_complex_id, transit_date, transit_hour, {dsum('ridership')} AS hourly_ridership, count(*) AS fare_rows,
       count(*) FILTER (minute(transit_timestamp) % 2 = 1 AND transit_timestamp < mark) AS late_rows
FROM stg_coarse, (SELECT max(transit_timestamp) - INTERVAL 7 DAY AS mark FROM stg_coarse WHERE minute(transit_timestamp) % 2 = 0)
GROUP BY 1, 2, 3
""", "stg_coarse")
key("stream_hourly", "SELECT station_complex_id, transit_date, transit_hour, hourly_ridership, fare_rows FROM hub_coarse", "hub_coarse")
