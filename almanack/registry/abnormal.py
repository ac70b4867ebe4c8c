"""Time-series features and abnormal periods."""

from pyspark.sql import functions as F

from almanack.operators import outliers as ou
from almanack.operators.tsfeatures import (
    ARCH_LAGS, LEVELS, MEMORY, PARTIAL, SHAPE, memory_features, native_features, partial_features, regression_steps,
    selected_features, shape_features, smoothing_features,
)
from almanack.operators.tsnumeric import grouped_features
from almanack.registry import fixtures as fx
from almanack.registry.base import register, with_
from almanack.settings import SELECTED_FEATURES

POSITIONED = """pos AS (
    SELECT series, period, date, value,
           row_number() OVER (PARTITION BY series, period ORDER BY date) - 1 AS pos,
           count(*) OVER (PARTITION BY series, period) AS n,
           avg(value) OVER (PARTITION BY series, period) AS mu,
           median(value) OVER (PARTITION BY series, period) AS med FROM obs)"""

_W = "OVER (PARTITION BY series, period ORDER BY pos)"

SHAPE_SQL = f"""stepped AS (
    SELECT *, lag(value) {_W} AS before, lead(value) {_W} AS after,
           n // 20 + 1 AS k, abs(value - lag(value, 20) {_W}) / 20 AS moved,
           avg(value) OVER (PARTITION BY series, period ORDER BY pos ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS trend
    FROM pos),
  shaped AS (
    SELECT *, CASE WHEN before IS NULL THEN after - value WHEN after IS NULL THEN value - before
                   ELSE (after - before) / 2 END AS gradient,
           CAST((value <= med) <> (before <= med) AS INTEGER) AS crossed,
           CASE WHEN pos < (n % k) * (n // k + 1) THEN pos // (n // k + 1)
                ELSE n % k + (pos - (n % k) * (n // k + 1)) // (n // k) END AS chunk,
           value - trend - avg(value - trend) OVER (PARTITION BY series, period, pos % 7) AS rest
    FROM stepped),
  offs AS (
    SELECT *, power(rest - avg(rest) OVER g, 2) AS off FROM shaped WINDOW g AS (PARTITION BY series, period)),
  without AS (
    SELECT *, CASE WHEN n > 2 THEN (sum(off) OVER g - off * n / (n - 1)) / (n - 2) END AS loo
    FROM offs WINDOW g AS (PARTITION BY series, period)),
  chunks AS (
    SELECT series, period, var_pop(v) AS lumpiness, var_pop(m) AS stability
    FROM (SELECT series, period, var_pop(value) AS v, avg(value) AS m FROM shaped GROUP BY series, period, chunk)
    GROUP BY 1, 2),
  shape AS (
    SELECT s.series, s.period, avg(value) AS mean, var_pop(value) AS var,
           regr_r2(value, CAST(pos AS DOUBLE)) AS linearity, stddev_pop(gradient) AS std1st_der,
           CAST(coalesce(sum(crossed), 0) AS DOUBLE) AS crossing_points,
           avg(CASE WHEN value > mu THEN 1 ELSE 0 END) AS binarize_mean,
           any_value(lumpiness) AS lumpiness, any_value(stability) AS stability,
           CAST(min(pos) FILTER (WHERE moved = top) - 20 AS DOUBLE) AS level_shift_idx,
           max(moved) AS level_shift_size,
           greatest(0.0, 1 - var_pop(rest) / nullif(var_pop(trend + rest), 0)) AS trend_strength,
           var_samp(loo) AS spikiness
    FROM (SELECT *, max(moved) OVER (PARTITION BY series, period) AS top FROM without) s
    JOIN chunks c ON c.series = s.series AND c.period = s.period GROUP BY 1, 2)"""


def _products():
    out = [f"c{c} * lag(c{c}, {lag}) {_W} AS p{c}_{lag}"
           for c in (0, 1, 2) for lag in ([1, 2, 3, 4, 5, 6, 7] if c == 0 else [1, 2, 3, 4, 5])]
    out += [f"CASE WHEN pos >= {ARCH_LAGS} THEN power(lag(c0, {lag}) {_W}, 2) END AS z{lag}" for lag in range(ARCH_LAGS + 1)]
    out += [f"e * lag(e, {lag}) {_W} AS q{lag}" for lag in range(1, 6)]
    out += [f"value - lag(value, {lag}) {_W} AS h{lag}" for lag in range(2, 30)]
    return ", ".join(out)


def _acf(c, lag):
    return f"sum(p{c}_{lag}) / nullif(sum(c{c} * c{c}), 0)"


def _acf5(c):
    squares = " + ".join(f"power(coalesce({_acf(c, lag)}, 0), 2)" for lag in range(1, 6))
    return f"CASE WHEN sum(c{c} * c{c}) > 0 THEN {squares} END"


_LONG_RUN = "sum(e * e) / n + " + " + ".join(
    f"CASE WHEN {lag} <= ceil(3 * sqrt(n) / 13) THEN 2 / n * coalesce(sum(q{lag}), 0) "
    f"* (1 - {lag} / (ceil(3 * sqrt(n) / 13) + 1)) ELSE 0 END" for lag in range(1, 6))
_SPREAD = " UNION ALL ".join(
    f"SELECT series, period, ln({lag}) AS x, ln(nullif(stddev_pop(h{lag}), 0)) AS y FROM multiplied GROUP BY 1, 2"
    for lag in range(2, 30))

def _steps_sql(source, steps):
    for step in steps:
        source = f"SELECT *, {', '.join(f'{e} AS {n}' for n, e in step.items())} FROM ({source})"
    return source


_COVARIANCES = ", ".join(f"covar_pop(z{i}, z{j}) AS s{i}{j}" for i in range(ARCH_LAGS + 1) for j in range(i, ARCH_LAGS + 1))
_LEFT = _steps_sql(f"SELECT series, period, count(z0) AS used, {_COVARIANCES} FROM multiplied GROUP BY 1, 2",
                   regression_steps(lambda i, j: f"s{i}{j}", ARCH_LAGS))

MEMORY_SQL = f"""differenced AS (SELECT *, value - lag(value) {_W} AS d1 FROM pos),
  twice AS (SELECT *, d1 - lag(d1) {_W} AS d2 FROM differenced),
  centred AS (
    SELECT *, value - mu AS c0, d1 - avg(d1) OVER g AS c1, d2 - avg(d2) OVER g AS c2,
           value - regr_slope(value, pos) OVER g * pos - regr_intercept(value, pos) OVER g AS e
    FROM twice WINDOW g AS (PARTITION BY series, period)),
  multiplied AS (
    SELECT *, {_products()},
           sum(e) OVER (PARTITION BY series, period ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s
    FROM centred),
  spread AS ({_SPREAD}),
  uneven AS (SELECT series, period, used * (1 - e{ARCH_LAGS}_00 / nullif(s00, 0)) AS heterogeneity FROM ({_LEFT})),
  lagsums AS (
    SELECT a.series, a.period, b.pos - a.pos AS k, sum(a.c0 * b.c0) AS p
    FROM centred a JOIN centred b ON a.series = b.series AND a.period = b.period AND b.pos >= a.pos GROUP BY ALL),
  correlated AS (
    SELECT *, round(p / nullif(first_value(p) OVER g, 0), 9) AS r FROM lagsums WINDOW g AS (PARTITION BY series, period ORDER BY k)),
  crossings AS (
    SELECT series, period, CAST(min(k) FILTER (WHERE k > 0 AND r <= 0) AS DOUBLE) AS firstzero_ac,
           CAST(min(k) FILTER (WHERE k > 0 AND r < before AND r < after) AS DOUBLE) AS firstmin_ac
    FROM (SELECT *, lag(r) OVER g AS before, lead(r) OVER g AS after FROM correlated
          WINDOW g AS (PARTITION BY series, period ORDER BY k)) GROUP BY 1, 2),
  hurst AS (SELECT series, period, CASE WHEN count(y) > 1 THEN regr_slope(y, x) END AS hurst FROM spread GROUP BY 1, 2),
  memory AS (
    SELECT m.series, m.period, {_acf(0, 1)} AS y_acf1, {_acf5(0)} AS y_acf5,
           {_acf(1, 1)} AS diff1y_acf1, {_acf5(1)} AS diff1y_acf5,
           {_acf(2, 1)} AS diff2y_acf1, {_acf5(2)} AS diff2y_acf5,
           {_acf(0, 7)} AS seas_acf1, any_value(hurst) AS hurst,
           sum(s * s) / (n * n) / nullif({_LONG_RUN}, 0) AS unitroot_kpss,
           any_value(heterogeneity) AS heterogeneity, any_value(firstzero_ac) AS firstzero_ac,
           any_value(firstmin_ac) AS firstmin_ac
    FROM multiplied m JOIN hurst h ON h.series = m.series AND h.period = m.period
    JOIN uneven u ON u.series = m.series AND u.period = m.period
    JOIN crossings x ON x.series = m.series AND x.period = m.period
    GROUP BY m.series, m.period, n)"""


def _long_sql(source, columns):
    return " UNION ALL ".join(
        f"SELECT series, period, '{c}' AS feature, {c} AS value FROM {source}" for c in columns
    )


FEATURES = (fx.SMALL_OBS, POSITIONED, SHAPE_SQL, MEMORY_SQL,
            f"features AS ({_long_sql('shape', SHAPE)} UNION ALL {_long_sql('memory', MEMORY)})")


@register("ts_features_sql", with_(*FEATURES) + "SELECT series, period, feature, round(value, 6) AS value FROM features")
def ts_features_sql(spark, folder):
    return native_features(fx.small_obs(spark, folder)).withColumn("value", F.round("value", 6))


@register("ts_shape_features", with_(*FEATURES[:3]) + "SELECT series, period, "
          + ", ".join(f"round({c}, 6) AS {c}" for c in SHAPE) + " FROM shape")
def ts_shape_features(spark, folder):
    df = shape_features(fx.small_obs(spark, folder))
    return df.withColumns({c: F.round(c, 6) for c in SHAPE})


@register("ts_memory_features", with_(fx.SMALL_OBS, POSITIONED, MEMORY_SQL) + "SELECT series, period, "
          + ", ".join(f"round({c}, 6) AS {c}" for c in MEMORY) + " FROM memory")
def ts_memory_features(spark, folder):
    df = memory_features(fx.small_obs(spark, folder)).select("series", "period", *MEMORY)
    return df.withColumns({c: F.round(c, 6) for c in MEMORY})


_ENTROPY = """waves AS (
    SELECT p.series, p.period, p.n, k, sum((value - mu) * cos(2 * pi() * k * pos / n)) AS re,
           sum((value - mu) * sin(2 * pi() * k * pos / n)) AS im
    FROM pos p, LATERAL (SELECT unnest(generate_series(1, p.n // 2)) AS k) GROUP BY ALL),
  shares AS (
    SELECT *, re * re + im * im AS power, sum(re * re + im * im) OVER g AS total, count(*) OVER g AS bins
    FROM waves WINDOW g AS (PARTITION BY series, period)),
  entropy AS (
    SELECT series, period, CASE WHEN any_value(bins) < 2 OR any_value(total) <= 1e-12 THEN 0
      ELSE -sum(power / total * log2(power / total)) FILTER (WHERE power > 0) / log2(any_value(bins)) END AS value
    FROM shares GROUP BY 1, 2)"""


@register("spectral_entropy", with_(fx.SMALL_OBS, POSITIONED, _ENTROPY) + """
  SELECT g.series, g.period, 'entropy' AS feature, round(coalesce(e.value, 0), 6) AS value
  FROM (SELECT DISTINCT series, period FROM obs) g
  LEFT JOIN entropy e ON e.series = g.series AND e.period = g.period""")
def spectral_entropy(spark, folder):
    found = grouped_features(fx.small_obs(spark, folder), ["entropy"])
    return found.withColumn("value", F.round("value", 6))


def _pacf_sql(c, order):
    """Partial autocorrelations 1 … order of column ``c`` by the Levinson recursion."""
    columns = [
        f"CASE WHEN count(c{c}) > {order} AND sum(c{c} * c{c}) > 0 "
        f"THEN sum(l{c}_{k}) / sum(c{c} * c{c}) END AS r{k}" for k in range(1, order + 1)
    ]
    source = f"SELECT series, period, {', '.join(columns)} FROM shifted GROUP BY 1, 2"
    for k in range(1, order + 1):
        before = [(f"f{k - 1}_{j}", k - j, j) for j in range(1, k)]
        up = " ".join([f"r{k}"] + [f"- {f} * r{back}" for f, back, _ in before])
        down = " ".join(["1"] + [f"- {f} * r{j}" for f, _, j in before])
        source = f"SELECT *, ({up}) / ({down}) AS f{k}_{k} FROM ({source})"
        if k > 1:
            rest = [f"f{k - 1}_{j} - f{k}_{k} * f{k - 1}_{k - j} AS f{k}_{j}" for j in range(1, k)]
            source = f"SELECT *, {', '.join(rest)} FROM ({source})"
    return source


_SHIFTED = "shifted AS (SELECT *, " + ", ".join(
    f"c{c} * lag(c{c}, {k}) {_W} AS l{c}_{k}" for c in (0, 1, 2) for k in range(1, 8)) + " FROM centred)"
_SQUARES = " + ".join(f"f{k}_{k} * f{k}_{k}" for k in range(1, 6))


_PARTIAL = " UNION ALL ".join(
    f"SELECT series, period, '{name}' AS feature, round({value}, 5) AS value FROM ({_pacf_sql(c, order)})"
    for name, c, order, value in [
        ("y_pacf5", 0, 5, _SQUARES), ("diff1y_pacf5", 1, 5, _SQUARES),
        ("diff2y_pacf5", 2, 5, _SQUARES), ("seas_pacf1", 0, 7, "f7_7")])


@register("partial_autocorrelation", with_(
    fx.SMALL_OBS, POSITIONED, MEMORY_SQL.split(",\n  multiplied AS")[0], _SHIFTED) + _PARTIAL)
def partial_autocorrelation(spark, folder):
    return partial_features(fx.small_obs(spark, folder)).withColumn("value", F.round("value", 5))


_LEVELS = "[" + ", ".join(f"CAST({v} AS DOUBLE)" for v in LEVELS) + "]"
_HOLT = f"""smoothed AS (
    SELECT series, period, alpha, list_reduce(
        [CASE WHEN i = 1 THEN {{'v': x[1], 'level': x[1], 'trend': x[2] - x[1], 'error': CAST(0 AS DOUBLE)}}
              ELSE {{'v': x[i], 'level': CAST(0 AS DOUBLE), 'trend': CAST(0 AS DOUBLE), 'error': CAST(0 AS DOUBLE)}} END FOR i IN range(1, len(x) + 1)],
        lambda s, n: {{'v': n.v, 'level': alpha * n.v + (1 - alpha) * (s.level + s.trend),
          'trend': beta * ((alpha * n.v + (1 - alpha) * (s.level + s.trend)) - s.level) + (1 - beta) * s.trend,
          'error': s.error + (n.v - (s.level + s.trend)) * (n.v - (s.level + s.trend))}}).error AS error
    FROM (SELECT series, period, list(value ORDER BY date) AS x FROM obs WHERE value IS NOT NULL GROUP BY 1, 2),
         (SELECT unnest({_LEVELS}) AS alpha), (SELECT unnest({_LEVELS}) AS beta) WHERE len(x) >= 4),
  holt AS (SELECT series, period, arg_min(alpha, (error, alpha)) AS value FROM smoothed GROUP BY 1, 2)"""


@register("holt_alpha", with_(fx.SMALL_OBS, _HOLT) + """
  SELECT g.series, g.period, h.value AS holt_alpha FROM (SELECT DISTINCT series, period FROM obs) g
  LEFT JOIN holt h ON h.series = g.series AND h.period = g.period""")
def holt_alpha(spark, folder):
    return smoothing_features(fx.small_obs(spark, folder))


# entropy where a period has one, as all of the grouped features
_ENTROPY_OF_ALL = """SELECT g.series, g.period, 'entropy' AS feature, round(coalesce(e.value, 0), 6) AS value
  FROM (SELECT DISTINCT series, period FROM obs) g LEFT JOIN entropy e ON e.series = g.series AND e.period = g.period"""


@register("ts_features_grouped", with_(
    fx.SMALL_OBS, POSITIONED, MEMORY_SQL.split(",\n  multiplied AS")[0], _SHIFTED, _ENTROPY, _HOLT) + f"""
  {_PARTIAL} UNION ALL {_ENTROPY_OF_ALL} UNION ALL
  SELECT g.series, g.period, 'holt_alpha' AS feature, h.value FROM (SELECT DISTINCT series, period FROM obs) g
  LEFT JOIN holt h ON h.series = g.series AND h.period = g.period""")
def ts_features_grouped(spark, folder):
    """The features that need a recursion, a transform or a fit."""
    panel = fx.small_obs(spark, folder)
    found = selected_features(panel, [*PARTIAL, "entropy", "holt_alpha"])
    digits = F.when(F.col("feature").endswith("pacf5") | F.col("feature").endswith("pacf1"), F.round("value", 5))
    return found.withColumn("value", F.coalesce(digits, F.round("value", 6)))


_Z = """scored AS (
    SELECT series, period, feature, (value - avg(value) OVER g) / nullif(stddev_pop(value) OVER g, 0) AS z
    FROM features WINDOW g AS (PARTITION BY series, feature))"""


@register("standardise_features", with_(*FEATURES[:3], f"features AS ({_long_sql('shape', SHAPE)})", _Z)
          + "SELECT series, period, feature, round(z, 6) AS z FROM scored")
def standardise_features(spark, folder):
    shape = shape_features(fx.small_obs(spark, folder))
    long = shape.unpivot(["series", "period"], SHAPE, "feature", "value")
    return ou.standardised(long).select("series", "period", "feature", F.round("z", 6).alias("z"))


@register("zscore_outliers", with_(*FEATURES, _Z) + """
  SELECT series, period, round(max(abs(z)), 6) AS max_abs_z FROM scored
  GROUP BY 1, 2 HAVING max(abs(z)) > 3.2""")
def zscore_outliers(spark, folder):
    found = ou.zscore_outliers(native_features(fx.small_obs(spark, folder)))
    return found.withColumn("max_abs_z", F.round("max_abs_z", 6))


@register("merged_exclusions", with_(*FEATURES, _Z, fx.OBS.replace("obs AS", "whole AS", 1),
                                    fx.EXCLUDED.replace("FROM obs", "FROM whole")) + """
  SELECT series, CAST(substr(period, 1, 4) AS INTEGER) AS year FROM scored GROUP BY series, period HAVING max(abs(z)) > 3.2
  UNION SELECT series, year FROM excluded""")
def merged_exclusions(spark, folder):
    """The years to leave out of training: those with an outlying period and the given ones."""
    found = ou.zscore_outliers(native_features(fx.small_obs(spark, folder)))
    derived = found.select("series", F.substring("period", 1, 4).cast("int").alias("year"))
    return ou.merge_exclusions(derived, fx.excluded_years(fx.obs(spark, folder)))


def _selected_features(spark, folder):
    """The features chosen for scoring, months as periods."""
    return selected_features(fx.small_obs(spark, folder), SELECTED_FEATURES)


@register("pca_scores")
def pca_scores(spark, folder):
    return ou.component_scores(_selected_features(spark, folder))


@register("pca_outliers")
def pca_outliers(spark, folder):
    return ou.pca_outliers(_selected_features(spark, folder), 3.2)


_KEPT_Z = """kept AS (
    SELECT f.* FROM features f
    WHERE NOT EXISTS (SELECT 1 FROM features x WHERE x.series = f.series AND x.feature = f.feature AND x.value IS NULL)
      AND NOT EXISTS (SELECT 1 FROM features x WHERE x.series = f.series AND x.period = f.period AND x.feature = 'entropy' AND x.value = 0)),
  scored AS (
    SELECT series, period, feature, (value - avg(value) OVER g) / nullif(stddev_pop(value) OVER g, 0) AS z
    FROM kept WINDOW g AS (PARTITION BY series, feature))"""
_PARTIAL_EXACT = _PARTIAL.replace("round(", "(").replace(", 5) AS value", ") AS value")
SELECTED_SQL = f"""features AS (
    SELECT * FROM ({_long_sql('shape', SHAPE)} UNION ALL {_long_sql('memory', MEMORY)} UNION ALL {_PARTIAL_EXACT}
      UNION ALL {_ENTROPY_OF_ALL.replace("round(coalesce(e.value, 0), 6)", "coalesce(e.value, 0)")}
      UNION ALL SELECT g.series, g.period, 'holt_alpha', h.value FROM (SELECT DISTINCT series, period FROM obs) g
      LEFT JOIN holt h ON h.series = g.series AND h.period = g.period)
    WHERE feature IN ({", ".join(f"'{n}'" for n in SELECTED_FEATURES)}))"""


@register("empty_periods", with_(*FEATURES[:4], _SHIFTED, _ENTROPY, _HOLT, SELECTED_SQL, _KEPT_Z) + """
  SELECT series, period, feature, round(value, 6) AS value FROM kept""")
def empty_periods(spark, folder):
    """The features chosen for scoring, without those that failed in some period of their
    series and without periods that do not vary."""
    kept = ou.without_empty_periods(ou.complete_features(_selected_features(spark, folder)))
    return kept.select("series", "period", "feature", F.round("value", 6).alias("value"))


@register("component_invariants", with_(*FEATURES[:4], _SHIFTED, _ENTROPY, _HOLT, SELECTED_SQL, _KEPT_Z) + """
  SELECT series, count(DISTINCT period) AS periods, least(count(DISTINCT period), count(DISTINCT feature)) AS components,
         round(sum(z * z), 4) AS variation, true AS uncorrelated FROM scored GROUP BY 1""")
def component_invariants(spark, folder):
    """What holds of the scores whatever their signs: their number, their sum of squares,
    which is that of the standardised features, and that no two components correlate."""
    scores = ou.component_scores(_selected_features(spark, folder))
    left, right = scores.alias("a"), scores.alias("b")
    pairs = left.join(right, (F.col("a.series") == F.col("b.series")) & (F.col("a.period") == F.col("b.period")) & (F.col("a.feature") < F.col("b.feature")))
    together = pairs.groupBy(F.col("a.series").alias("series"), F.col("a.feature"), F.col("b.feature")).agg(F.sum(F.col("a.value") * F.col("b.value")).alias("s"))
    worst = together.groupBy("series").agg(F.max(F.abs("s")).alias("worst"))
    whole = scores.groupBy("series").agg(
        F.count_distinct("period").alias("periods"), F.count_distinct("feature").alias("components"), F.sum(F.col("value") ** 2).alias("variation")
    )
    return whole.join(worst, "series", "left").select(
        "series", "periods", "components", F.round("variation", 4).alias("variation"),
        (F.coalesce("worst", F.lit(0.0)) <= F.col("variation") * 1e-9).alias("uncorrelated"),
    )


_YEARLY = fx.SMALL_OBS.replace("'%Y-%m'", "'%Y'")


@register("yearly_features", with_(_YEARLY, *FEATURES[1:4], _SHIFTED, _ENTROPY, _HOLT, SELECTED_SQL) + """
  SELECT series, period, feature, round(value, 5) AS value FROM features""")
def yearly_features(spark, folder):
    """The features chosen for scoring, years as periods."""
    years = fx.small_obs(spark, folder).withColumn("period", F.date_format("date", "yyyy"))
    return selected_features(years, SELECTED_FEATURES).withColumn("value", F.round("value", 5))


@register("yearly_outliers")
def yearly_outliers(spark, folder):
    """The largest score of each year on any component; a limit of 3.2 takes 12 years."""
    years = fx.small_obs(spark, folder).withColumn("period", F.date_format("date", "yyyy"))
    return ou.pca_outliers(selected_features(years, SELECTED_FEATURES), limit=0.0)
