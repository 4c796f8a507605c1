"""SQL side of the fixtures: named CTEs over the driver's tables, written for DuckDB."""

from __future__ import annotations


def r(expr: str, digits: int) -> str:
    """Half away from zero on the value, not on summation noise (see functions/numbers.py)."""
    return f"round(round(({expr}) * 1e{digits}, 6)) / 1e{digits}"


def s(expr: str) -> str:
    return f"CAST({expr} AS VARCHAR)"


def aqi_label(col: str) -> str:
    return (
        f"CASE WHEN {col} <= 50 THEN 'Good' WHEN {col} <= 100 THEN 'Moderate' "
        f"WHEN {col} <= 150 THEN 'Unhealthy for Sensitive Groups' WHEN {col} <= 200 THEN 'Unhealthy' "
        f"WHEN {col} <= 300 THEN 'Very Unhealthy' ELSE 'Hazardous' END"
    )


def improvement(base: str, score: str) -> str:
    return r(f"({base} - {score}) / ({base} + 1e-6) * 100", 1)


# Observations: one per event. ``k`` is the integer inside ``props``.
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "ev": ((), "SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"),
    "w": (
        ("ev",),
        """SELECT event_id, event_type AS city, CAST(ts AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour,
           ts AS datetime_utc, CASE WHEN k = 0 THEN NULL ELSE value END AS temperature_2m,
           CAST(k AS DOUBLE) AS relative_humidity_2m, greatest(value - k, 0) AS precipitation,
           abs(value - k) AS wind_speed_10m, k AS weather_code, 'events/' || event_type AS source_file
           FROM ev""",
    ),
    "a": (
        ("ev",),
        """SELECT event_id, event_type AS city, CAST(ts AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour,
           ts AS datetime_utc, value + k AS pm10, CAST(k AS DOUBLE) AS pm2_5, value * 2 AS carbon_monoxide,
           k * CAST(0.5 AS DOUBLE) AS nitrogen_dioxide, value * CAST(0.5 AS DOUBLE) AS sulphur_dioxide,
           CAST(100 - k AS DOUBLE) AS ozone, CAST(k AS DOUBLE) AS european_aqi, value AS us_aqi,
           'events/' || event_type AS source_file
           FROM ev""",
    ),
    "wd": (
        ("w",),
        f"""SELECT city, date AS metric_date, {r('avg(temperature_2m)', 2)} AS avg_temperature_c,
            {r('min(temperature_2m)', 2)} AS min_temperature_c, {r('max(temperature_2m)', 2)} AS max_temperature_c,
            {r('avg(relative_humidity_2m)', 2)} AS avg_humidity_pct,
            {r('sum(precipitation)', 2)} AS total_precipitation_mm,
            {r('avg(wind_speed_10m)', 2)} AS avg_wind_speed_kmh, {r('max(wind_speed_10m)', 2)} AS max_wind_speed_kmh,
            count(*) AS hourly_weather_records FROM w GROUP BY city, date""",
    ),
    "ad": (
        ("a",),
        f"""SELECT city, date AS metric_date, {r('avg(pm2_5)', 2)} AS avg_pm2_5, {r('max(pm2_5)', 2)} AS max_pm2_5,
            {r('avg(pm10)', 2)} AS avg_pm10, {r('max(pm10)', 2)} AS max_pm10,
            {r('avg(carbon_monoxide)', 2)} AS avg_carbon_monoxide,
            {r('avg(nitrogen_dioxide)', 2)} AS avg_nitrogen_dioxide,
            {r('avg(sulphur_dioxide)', 2)} AS avg_sulphur_dioxide, {r('avg(ozone)', 2)} AS avg_ozone,
            {r('avg(us_aqi)', 1)} AS avg_us_aqi, {r('max(us_aqi)', 1)} AS max_us_aqi,
            count(*) AS hourly_aq_records FROM a GROUP BY city, date""",
    ),
    "j": (("wd", "ad"), "SELECT * FROM wd JOIN ad USING (city, metric_date)"),
    "fct": (
        ("j",),
        f"""SELECT md5(city || '_' || {s('metric_date')}) AS daily_metric_id, j.*,
            {aqi_label('avg_us_aqi')} AS aqi_category,
            lag(avg_us_aqi, 1) OVER series AS lag_1d_aqi, lag(avg_us_aqi, 2) OVER series AS lag_2d_aqi,
            lag(avg_us_aqi, 3) OVER series AS lag_3d_aqi,
            {r('avg(avg_us_aqi) OVER (PARTITION BY city ORDER BY metric_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)', 1)}
              AS rolling_7d_avg_aqi
            FROM j WINDOW series AS (PARTITION BY city ORDER BY metric_date)""",
    ),
    "lab": (
        ("fct",),
        """SELECT *, lead(avg_us_aqi) OVER (PARTITION BY city ORDER BY metric_date) AS target_next_day_aqi FROM fct""",
    ),
    "ranked": (
        ("lab",),
        """SELECT *, row_number() OVER (PARTITION BY city ORDER BY metric_date DESC) AS newest_first,
           count(*) OVER (PARTITION BY city) AS n FROM lab WHERE target_next_day_aqi IS NOT NULL""",
    ),
    "split": (
        ("ranked",),
        """SELECT *, CASE WHEN n < 25 THEN 'short' WHEN newest_first <= 12 THEN 'test'
           WHEN newest_first <= 20 THEN 'val' ELSE 'train' END AS split FROM ranked""",
    ),
    # One row per event, as the raw documents hold them.
    "o": (
        ("ev",),
        """SELECT 'user-' || user_id AS city, CAST(ts AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour,
           strftime(date_trunc('minute', ts), '%Y-%m-%dT%H:%M') AS time, value AS temperature_2m,
           CAST(k AS DOUBLE) AS relative_humidity_2m, CAST(event_id AS DOUBLE) AS precipitation,
           abs(value - k) AS wind_speed_10m, CAST(k AS DOUBLE) AS weather_code FROM ev""",
    ),
    # The event with the highest number of every (city, day, hour).
    "h": (("o",), "SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY city, date, hour ORDER BY precipitation DESC) = 1"),
    # What Silver keeps of an hour: the latest minute, then the larger measures.
    "sw": (
        ("o",),
        """SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY city, date, hour ORDER BY time DESC, temperature_2m DESC,
           relative_humidity_2m DESC, precipitation DESC) = 1""",
    ),
    "sa": (
        ("o",),
        """SELECT city, date, hour, least(temperature_2m, 500) AS us_aqi FROM o QUALIFY row_number() OVER (
           PARTITION BY city, date, hour ORDER BY time DESC, wind_speed_10m DESC, relative_humidity_2m DESC, us_aqi DESC) = 1""",
    ),
    "dims": (
        (),
        """SELECT c_custkey, c_name, c_mktsegment, c_acctbal, n_name, r_name FROM customer
           JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    ),
}


def with_ctes(body: str, *names: str) -> str:
    """``body`` after the named CTEs and whatever they need; a body may go on with ", more AS (...)"."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in CTES[name][0]:
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in ordered) + "\n" + body
