"""The shipped data model: streams, rules, rollups, dimension rows, checks and grid.

Operators know none of these names; another model is another module like this one.
All values here are fixed values that results depend on.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.forecast import ForecastSpec, TreeConfig
from tidemark.operators.quality import accepted_values, custom_rows, not_null, unique

# --- streams ---------------------------------------------------------------

WEATHER_MEASURES = {
    "temperature_2m": "double",
    "relative_humidity_2m": "double",
    "precipitation": "double",
    "wind_speed_10m": "double",
    "weather_code": "int",
}
AIR_QUALITY_MEASURES = {
    "pm10": "double",
    "pm2_5": "double",
    "carbon_monoxide": "double",
    "nitrogen_dioxide": "double",
    "sulphur_dioxide": "double",
    "ozone": "double",
    "european_aqi": "double",
    "us_aqi": "double",
}
WEATHER_BOUNDS = {
    "temperature_2m": (-50.0, 65.0),
    "relative_humidity_2m": (0.0, 100.0),
    "wind_speed_10m": (0.0, 180.0),
}
AIR_QUALITY_BOUNDS = {
    "pm2_5": (0.0, 1500.0),
    "pm10": (0.0, 2000.0),
    "us_aqi": (0.0, 1000.0),
}
REJECT_REASONS = {
    "weather": "Weather measurement out of realistic atmospheric bounds",
    "air_quality": "Air quality pollutant concentration out of physical bounds",
}
SILVER_KEYS = ("city", "date", "hour")

# --- staging ---------------------------------------------------------------

_STAGING_KEYS = {
    "city": ("city", None),
    "metric_date": ("date", "date"),
    "metric_hour": ("hour", "int"),
    "measured_at": ("datetime_utc", "timestamp_ntz"),
}
_STAGING_TAIL = {"source_file": ("source_file", None), "silver_processed_at": ("silver_processed_at", None)}
STAGING_WEATHER = {
    **_STAGING_KEYS,
    "temperature_c": ("temperature_2m", "double"),
    "relative_humidity_pct": ("relative_humidity_2m", "double"),
    "precipitation_mm": ("precipitation", "double"),
    "wind_speed_kmh": ("wind_speed_10m", "double"),
    "weather_code": ("weather_code", "int"),
    **_STAGING_TAIL,
}
STAGING_AIR_QUALITY = {
    **_STAGING_KEYS,
    "pm10_ugm3": ("pm10", "double"),
    "pm2_5_ugm3": ("pm2_5", "double"),
    "carbon_monoxide_ugm3": ("carbon_monoxide", "double"),
    "nitrogen_dioxide_ugm3": ("nitrogen_dioxide", "double"),
    "sulphur_dioxide_ugm3": ("sulphur_dioxide", "double"),
    "ozone_ugm3": ("ozone", "double"),
    "european_aqi": ("european_aqi", "double"),
    "us_aqi": ("us_aqi", "double"),
    **_STAGING_TAIL,
}

# --- gold ------------------------------------------------------------------

DAILY_KEYS = ("city", "metric_date")
WEATHER_ROLLUP = {
    "avg_temperature_c": ("avg", "temperature_c", 2),
    "min_temperature_c": ("min", "temperature_c", 2),
    "max_temperature_c": ("max", "temperature_c", 2),
    "avg_humidity_pct": ("avg", "relative_humidity_pct", 2),
    "total_precipitation_mm": ("sum", "precipitation_mm", 2),
    "avg_wind_speed_kmh": ("avg", "wind_speed_kmh", 2),
    "max_wind_speed_kmh": ("max", "wind_speed_kmh", 2),
}
AIR_QUALITY_ROLLUP = {
    "avg_pm2_5": ("avg", "pm2_5_ugm3", 2),
    "max_pm2_5": ("max", "pm2_5_ugm3", 2),
    "avg_pm10": ("avg", "pm10_ugm3", 2),
    "max_pm10": ("max", "pm10_ugm3", 2),
    "avg_carbon_monoxide": ("avg", "carbon_monoxide_ugm3", 2),
    "avg_nitrogen_dioxide": ("avg", "nitrogen_dioxide_ugm3", 2),
    "avg_sulphur_dioxide": ("avg", "sulphur_dioxide_ugm3", 2),
    "avg_ozone": ("avg", "ozone_ugm3", 2),
    "avg_us_aqi": ("avg", "us_aqi", 1),
    "max_us_aqi": ("max", "us_aqi", 1),
}
FACT_LAGS = (1, 2, 3)
FACT_ROLLING = 7
FACT_REACH = max(*FACT_LAGS, FACT_ROLLING - 1) + 1  # rows that a row of the fact looks at, itself included
AQI_CUTS = (
    (50.0, "Good"),
    (100.0, "Moderate"),
    (150.0, "Unhealthy for Sensitive Groups"),
    (200.0, "Unhealthy"),
    (300.0, "Very Unhealthy"),
)
AQI_TOP = "Hazardous"
DISPLAY_CUTS = ((50.0, "Good"), (100.0, "Moderate"), (150.0, "Moderate / USG"), (200.0, "Unhealthy"))
DISPLAY_TOP = "Critical"
ADVISORY_LIMIT = 150.0
ADVISORY_ABOVE = "Wear N95 masks outdoors, run HEPA air filtration indoors."
ADVISORY_BELOW = "Normal outdoor activities permitted for general population."
POLLUTANTS = {
    "avg_pm2_5": "PM2.5",
    "avg_pm10": "PM10",
    "avg_nitrogen_dioxide": "NO2",
    "avg_ozone": "O3",
    "avg_sulphur_dioxide": "SO2",
}
SNAPSHOT_COLUMNS = (
    "city",
    "metric_date",
    *WEATHER_ROLLUP,
    *AIR_QUALITY_ROLLUP,
    "aqi_category",
    "lag_1d_aqi",
    "lag_2d_aqi",
    "lag_3d_aqi",
    "rolling_7d_avg_aqi",
)

CITY_SCHEMA = T.StructType(
    [
        T.StructField("city", T.StringType()),
        T.StructField("city_name", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("population_tier", T.StringType()),
        T.StructField("timezone", T.StringType()),
    ]
)
CITIES = (
    ("delhi", "Delhi", "National Capital Territory", 28.6139, 77.2090, "Tier-1 Megacity", "Asia/Kolkata"),
    ("mumbai", "Mumbai", "Maharashtra", 19.0760, 72.8777, "Tier-1 Megacity", "Asia/Kolkata"),
    ("bengaluru", "Bengaluru", "Karnataka", 12.9716, 77.5946, "Tier-1 Tech Hub", "Asia/Kolkata"),
    ("kolkata", "Kolkata", "West Bengal", 22.5726, 88.3639, "Tier-1 Metro", "Asia/Kolkata"),
    ("chennai", "Chennai", "Tamil Nadu", 13.0827, 80.2707, "Tier-1 Coastal Hub", "Asia/Kolkata"),
    ("hyderabad", "Hyderabad", "Telangana", 17.3850, 78.4867, "Tier-1 Tech Hub", "Asia/Kolkata"),
    ("pune", "Pune", "Maharashtra", 18.5204, 73.8567, "Tier-2 Emerging Metro", "Asia/Kolkata"),
    ("ahmedabad", "Ahmedabad", "Gujarat", 23.0225, 72.5714, "Tier-2 Industrial Hub", "Asia/Kolkata"),
)

# --- forecast --------------------------------------------------------------

FORECAST = ForecastSpec(
    key="city",
    date="metric_date",
    value="avg_us_aqi",
    target="target_next_day_aqi",
    features=(
        "avg_us_aqi",
        "lag_1d_aqi",
        "lag_2d_aqi",
        "lag_3d_aqi",
        "avg_temperature_c",
        "avg_humidity_pct",
        "avg_wind_speed_kmh",
        "avg_pm2_5",
        "avg_pm10",
        "day_of_week",
        "month",
    ),
    configs={
        "depth_3_leaf_3": TreeConfig(3, 0.05, 3, 100),
        "leaf_3_lr_06": TreeConfig(3, 0.06, None, 100),
        "leaf_4_lr_08": TreeConfig(4, 0.08, None, 100),
        "leaf_2_lr_05": TreeConfig(2, 0.05, None, 100),
        "leaf_5_lr_05": TreeConfig(5, 0.05, None, 100),
        "default_leaf_20": TreeConfig(20, 0.1, None, 100),
    },
    fallback=TreeConfig(20, 0.1, None, 100),
)
MODEL_VERSION = "v1.0.0"


# --- quality checks: 15 not-null, 3 unique, 2 accepted values, 1 custom -----


def staging_weather_checks():
    return [
        not_null("city"),
        not_null("metric_date"),
        not_null("metric_hour"),
        accepted_values("metric_hour", list(range(24))),
        not_null("temperature_c"),
    ]


def staging_air_quality_checks():
    return [not_null("city"), not_null("metric_date"), not_null("metric_hour"), not_null("us_aqi")]


def dim_city_checks():
    return [unique("city_id"), not_null("city_id"), unique("city"), not_null("city")]


def aqi_sanity():
    low, high = F.col("avg_us_aqi"), F.col("max_us_aqi")
    return custom_rows(
        "aqi_sanity", "avg_us_aqi", (low < 0.0) | (low > 500.0) | (high < 0.0) | (high > 500.0) | (high < low)
    )


def fact_checks():
    return [
        unique("daily_metric_id"),
        not_null("daily_metric_id"),
        not_null("city"),
        not_null("metric_date"),
        not_null("avg_us_aqi"),
        not_null("aqi_category"),
        accepted_values("aqi_category", [label for _, label in AQI_CUTS] + [AQI_TOP]),
        aqi_sanity(),
    ]
