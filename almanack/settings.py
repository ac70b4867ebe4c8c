"""Run parameters.

The values below are fixed: results depend on them, so they are stated as they
are rather than derived.
"""

from datetime import date

# -- fixed values: calendar -------------------------------------------------
STATION_SWITCH = date(2006, 1, 1)
SITE_CUTS = (date(1983, 1, 1), date(1990, 1, 1), date(2006, 1, 1))
DECADE_CUTS = (date(1980, 1, 1), date(1990, 1, 1), date(2000, 1, 1), date(2010, 1, 1))

# -- fixed values: places, (latitude, longitude) in degrees -----------------
SAMPLER_LATER = (52.62, -1.12)
SAMPLER_EARLIER = (52.93, -1.48)
EARTH_RADIUS_M = 6378137.0
RING_KM = 30

# -- fixed values: rules ----------------------------------------------------
MIN_STATIONS = 2
MIN_YEARS = 27
MIN_PREVALENCE = 0.01
SPAN_WEATHER = 5
SPAN_COUNTS = 7
NEAREST_YEARS = 12
SEASON_SHARE = 0.9
PEAK_RISE = 0.4
TOP_OF_QUANTILES = 7
RUN_WRAP = 1000
OUTLIER_Z = 3.2
MAX_STARTS = 9
UNDERSAMPLE_RATIO = 0.1

# -- fixed values: series ---------------------------------------------------
TOTAL_SERIES = "Total_fungal_spores"
UNKNOWN_SERIES = "Unknown_spores"
UNMODELLED_SERIES = [
    "Coloured_basidiospores", "Hyaline_basidiospores", "Other_spores", "Pleosporaceae",
]

# -- fixed values: weather columns ------------------------------------------
WEATHER_DIRECTIONS = ["c_mean_wind_dir", "c_max_gust_dir"]
LAGGED_WEATHER = [
    "c_avg_airpress", "c_avg_mean_wind_speed", "c_avg_relhum", "c_prcp_amt", "c_gdd",
]
# run-length rules: new column -> (weather column, threshold column)
RUN_RULES = {
    "run_temp_max_lag": ("c_max_air_temp", "temp_threshold"),
    "run_temp_min_lag": ("c_min_air_temp", "temp_threshold"),
    "run_precip_lag": ("c_prcp_amt", "precip_threshold"),
    "run_wind_speed_lag": ("c_max_mean_wind_speed", "max_wind_speed_threshold"),
}
# consensus over stations: input column -> aggregate
CONSENSUS = {
    "max_air_temp": "max", "min_air_temp": "min", "min_grss_temp": "min",
    "min_conc_temp": "min", "prcp_amt": "avg", "cs_24hr_sun_dur": "avg",
    "wmo_24hr_sun_dur": "avg", "thunder_day_flag": "any", "gale_day_flag": "any",
    "glbl_irad_amt": "avg", "difu_irad_amt": "avg", "direct_irad": "avg",
    "irad_bal_amt": "avg", "glbl_s_lat_irad_amt": "avg", "glbl_horz_ilmn": "avg",
}
CATEGORICAL = [
    "month", "site", "decade_cat", "week_1", "year_type_for_doy_lag1",
    "c_mean_wind_dir_class", "c_max_gust_dir_class",
]
NOT_MODELLED_COLUMNS = [
    "c_avg_air_temp", "c_min_air_temp", "c_mean_wind_dir", "c_max_gust_dir",
    "c_avg_cloudcov",
]
# features scored for abnormal periods
SELECTED_FEATURES = [
    "entropy", "lumpiness", "stability", "hurst", "std1st_der", "crossing_points",
    "binarize_mean", "unitroot_kpss", "linearity", "trend_strength", "level_shift_idx",
    "y_acf1", "y_acf5", "diff1y_acf1", "diff1y_acf5", "y_pacf5", "diff1y_pacf5",
    "diff2y_pacf5", "seas_acf1", "seas_pacf1", "holt_alpha",
]
