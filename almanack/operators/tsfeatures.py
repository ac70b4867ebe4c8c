"""Shape and memory of one period of a series, as native columns.

Input is ``(series, period, date, value)`` without nulls.  A group is one period
of a daily series, at most 366 rows.  Every window uses the same partitioning, so
a feature set costs one shuffle.

Definitions (n rows x_0 … x_{n-1} of a group in date order):

* ``mean``, ``var``                population moments
* ``linearity``                    r² of x on position
* ``std1st_der``                   population sd of the gradient (central
                                   differences, one-sided at the ends)
* ``crossing_points``              changes of side of the median (at or below / above)
* ``binarize_mean``                share above the mean
* ``lumpiness``, ``stability``     population variance of the chunks' variances and
                                   means, n div 20 + 1 nearly equal chunks
* ``level_shift_idx``, ``_size``   where the 20-row rolling mean moves most, and by how much
* ``trend_strength``               1 - var(rest) / var(trend + rest), not below 0; the trend
                                   is the centred 7-row mean, the season the mean of the
                                   detrended values by position modulo 7
* ``y_acf1``, ``y_acf5``           autocorrelation at lag 1; sum of squares at lags 1-5;
                                   ``diff1y_``, ``diff2y_`` on differences, ``seas_acf1`` at lag 7
* ``hurst``                        slope of log sd of lagged differences on log lag, lags 2-29
* ``unitroot_kpss``                trend-stationary statistic with Bartlett weights
* ``y_pacf5``, ``diff1y_``, ``diff2y_pacf5``, ``seas_pacf1``
                                   sum of squared partial autocorrelations at lags 1-5, and the
                                   one at lag 7, by the Levinson recursion on the lag sums
* ``spikiness``                    sample variance of the leave-one-out sample variances of the
                                   rest beside trend and season
* ``heterogeneity``                rows used times r² of the squared centred values on their
                                   four predecessors
* ``firstzero_ac``                 first lag whose autocorrelation is not positive
* ``firstmin_ac``                  first lag whose autocorrelation is below both neighbours'
* ``holt_alpha``                   smoothing level of the linear-trend smoother with the least
                                   one-step error over a grid, the smallest of equals
"""

from pyspark.sql import Window, functions as F

from almanack.operators.tsnumeric import grouped_features

GROUP = ("series", "period")
CHUNK = 20
SEASON = 7
HURST_LAGS = range(2, 30)
KPSS_MAX_LAG = 5

SHAPE = [
    "mean", "var", "linearity", "std1st_der", "crossing_points", "binarize_mean",
    "lumpiness", "stability", "level_shift_idx", "level_shift_size", "trend_strength", "spikiness",
]
MEMORY = [
    "y_acf1", "y_acf5", "diff1y_acf1", "diff1y_acf5", "diff2y_acf1", "diff2y_acf5",
    "seas_acf1", "hurst", "unitroot_kpss", "heterogeneity", "firstzero_ac", "firstmin_ac",
]
PARTIAL = ["y_pacf5", "diff1y_pacf5", "diff2y_pacf5", "seas_pacf1"]
ARCH_LAGS = 4
LEVELS = [round(0.05 * i, 2) for i in range(1, 20)]


def _ratio(a, b):
    return F.try_divide(a, F.nullif(b, F.lit(0.0)))


def positioned(df):
    """Adds ``pos`` (from 0), ``n``, and the group's ``mu`` and ``med``."""
    whole = Window.partitionBy(*GROUP)
    return df.where("value IS NOT NULL").withColumns(
        {
            "pos": F.row_number().over(whole.orderBy("date")) - 1,
            "n": F.count(F.lit(1)).over(whole),
            "mu": F.avg("value").over(whole),
            "med": F.median("value").over(whole),
        }
    )


def _chunk():
    """Index of the chunk a row falls in; the first n mod k chunks are one longer."""
    return F.expr(
        f"""CASE WHEN pos < (n % (n div {CHUNK} + 1)) * (n div (n div {CHUNK} + 1) + 1)
                 THEN pos div (n div (n div {CHUNK} + 1) + 1)
                 ELSE n % (n div {CHUNK} + 1)
                      + (pos - (n % (n div {CHUNK} + 1)) * (n div (n div {CHUNK} + 1) + 1))
                        div (n div (n div {CHUNK} + 1)) END"""
    )


def shape_features(df):
    """One row per (series, period) with the columns in ``SHAPE``."""
    order = Window.partitionBy(*GROUP).orderBy("pos")
    before, after = F.lag("value").over(order), F.lead("value").over(order)
    gradient = (
        F.when(before.isNull(), after - F.col("value"))
        .when(after.isNull(), F.col("value") - before)
        .otherwise((after - before) / 2)
    )
    below = F.col("value") <= F.col("med")
    crossed = (below != F.lag(below).over(order)).cast("int")
    moved = F.abs(F.col("value") - F.lag("value", CHUNK).over(order)) / CHUNK
    centred = order.rowsBetween(-(SEASON // 2), SEASON // 2)
    rows = positioned(df).withColumns(
        {
            "_gradient": gradient,
            "_crossed": crossed,
            "_moved": moved,
            "_trend": F.avg("value").over(centred),
            "_chunk": _chunk(),
        }
    )
    weekday = Window.partitionBy(*GROUP, F.col("pos") % SEASON)
    rows = rows.withColumn(
        "_rest",
        F.col("value") - F.col("_trend") - F.avg(F.col("value") - F.col("_trend")).over(weekday),
    )
    period = Window.partitionBy(*GROUP)
    off = F.pow(F.col("_rest") - F.avg("_rest").over(period), 2)
    # without a row: the sum of squares less its own, and what moving the mean takes off
    left = (F.sum("_off").over(period) - F.col("_off") * F.col("n") / (F.col("n") - 1)) / (F.col("n") - 2)
    rows = rows.withColumn("_off", off).withColumn("_without", F.when(F.col("n") > 2, left))
    chunks = (
        rows.groupBy(*GROUP, "_chunk")
        .agg(F.var_pop("value").alias("_v"), F.avg("value").alias("_m"))
        .groupBy(*GROUP)
        .agg(F.var_pop("_v").alias("lumpiness"), F.var_pop("_m").alias("stability"))
    )
    rest_share = _ratio(F.var_pop("_rest"), F.var_pop(F.col("_trend") + F.col("_rest")))
    whole = rows.groupBy(*GROUP).agg(
        F.avg("value").alias("mean"),
        F.var_pop("value").alias("var"),
        F.regr_r2("value", F.col("pos").cast("double")).alias("linearity"),
        F.stddev_pop("_gradient").alias("std1st_der"),
        F.coalesce(F.sum("_crossed"), F.lit(0)).cast("double").alias("crossing_points"),
        F.avg((F.col("value") > F.col("mu")).cast("int")).alias("binarize_mean"),
        (F.max_by(F.col("pos"), F.struct("_moved", -F.col("pos"))) - CHUNK).alias("_shift_at"),
        F.max("_moved").alias("level_shift_size"),
        F.greatest(F.lit(0.0), 1 - rest_share).alias("trend_strength"),
        F.var_samp("_without").alias("spikiness"),
    )
    return (
        whole.join(chunks, list(GROUP))
        .withColumn(
            "level_shift_idx",
            F.when(F.col("level_shift_size").isNotNull(), F.col("_shift_at")).cast("double"),
        )
        .select(*GROUP, *SHAPE)
    )


def memory_features(df):
    """One row per (series, period) with the columns in ``MEMORY`` and ``PARTIAL``."""
    whole = Window.partitionBy(*GROUP)
    order = whole.orderBy("pos")
    rows = positioned(df).withColumn("_d1", F.col("value") - F.lag("value").over(order))
    rows = rows.withColumn("_d2", F.col("_d1") - F.lag("_d1").over(order))
    rows = rows.withColumns(
        {
            "_c0": F.col("value") - F.col("mu"),
            "_c1": F.col("_d1") - F.avg("_d1").over(whole),
            "_c2": F.col("_d2") - F.avg("_d2").over(whole),
            "_e": F.col("value")
            - F.regr_slope("value", F.col("pos").cast("double")).over(whole) * F.col("pos")
            - F.regr_intercept("value", F.col("pos").cast("double")).over(whole),
        }
    )
    in_order = "OVER (PARTITION BY series, period ORDER BY pos)"
    lagged = [(f"_p{c}_{lag}", f"_c{c} * lag(_c{c}, {lag}) {in_order}")
              for c in (0, 1, 2) for lag in (1, 2, 3, 4, 5)]
    lagged += [(f"_p0_{lag}", f"_c0 * lag(_c0, {lag}) {in_order}") for lag in (6, SEASON)]
    lagged += [(f"_z{lag}", f"CASE WHEN pos >= {ARCH_LAGS} THEN power(lag(_c0, {lag}) {in_order}, 2) END") for lag in range(ARCH_LAGS + 1)]
    lagged += [(f"_q{lag}", f"_e * lag(_e, {lag}) {in_order}") for lag in range(1, KPSS_MAX_LAG + 1)]
    lagged += [(f"_h{lag}", f"value - lag(value, {lag}) {in_order}") for lag in HURST_LAGS]
    lagged.append(("_s", f"sum(_e) {in_order[:-1]} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"))
    rows = rows.selectExpr("*", *[f"{rule} AS {name}" for name, rule in lagged])

    def acf(c, lag):
        return _ratio(F.sum(f"_p{c}_{lag}"), F.sum(F.pow(F.col(f"_c{c}"), 2)))

    def acf5(c):
        total = F.lit(0.0)
        for lag in range(1, 6):
            total = total + F.pow(F.coalesce(acf(c, lag), F.lit(0.0)), 2)
        return F.when(F.sum(F.pow(F.col(f"_c{c}"), 2)) > 0, total)

    n = F.max("n").cast("double")
    lags_used = F.ceil(3 * F.sqrt(n) / 13)
    long_run = F.sum(F.pow(F.col("_e"), 2)) / n
    for lag in range(1, KPSS_MAX_LAG + 1):
        weight = 1 - lag / (lags_used + 1)
        long_run = long_run + F.when(
            lag <= lags_used, 2 / n * F.coalesce(F.sum(f"_q{lag}"), F.lit(0.0)) * weight
        ).otherwise(0.0)
    kpss = _ratio(F.sum(F.pow(F.col("_s"), 2)) / (n * n), long_run)

    spread = F.expr(
        "array(" + ", ".join(
            f"struct(double({lag}) AS lag, stddev_pop(_h{lag}) AS sd)" for lag in HURST_LAGS
        ) + ")"
    )
    one_row = rows.groupBy(*GROUP).agg(
        acf(0, 1).alias("y_acf1"), acf5(0).alias("y_acf5"),
        acf(1, 1).alias("diff1y_acf1"), acf5(1).alias("diff1y_acf5"),
        acf(2, 1).alias("diff2y_acf1"), acf5(2).alias("diff2y_acf5"),
        acf(0, SEASON).alias("seas_acf1"), kpss.alias("unitroot_kpss"),
        spread.alias("_spread"),
        *[F.when(F.count(f"_c{c}") > most, acf(c, lag)).alias(f"_r{c}_{most}_{lag}") for c, most in _ORDERS for lag in range(1, most + 1)],
        *[F.covar_pop(f"_z{i}", f"_z{j}").alias(f"_s{i}{j}") for i in range(ARCH_LAGS + 1) for j in range(i, ARCH_LAGS + 1)],
        F.count("_z0").alias("_used"),
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "_c0"))), lambda x: x["_c0"]).alias("_values"),
    )
    done = _with_crossings(_with_heterogeneity(_with_hurst(one_row)))
    return _with_partial(done).select(*GROUP, *MEMORY, *PARTIAL)


#: what the partial autocorrelations are of (0: values, 1 and 2: differences), up to which lag
_ORDERS = [(0, 5), (1, 5), (2, 5), (0, SEASON)]


def partial_steps(r, most):
    """``[{name: expression}]``: the Levinson recursion on the columns ``r(1) … r(most)``,
    step by step; ``f<k>_<k>`` is the partial autocorrelation at lag ``k``."""
    steps = []
    for k in range(1, most + 1):
        up = " ".join([r(k), *[f"- f{k - 1}_{j} * {r(k - j)}" for j in range(1, k)]])
        down = " ".join(["1", *[f"- f{k - 1}_{j} * {r(j)}" for j in range(1, k)]])
        steps.append({f"f{k}_{k}": f"({up}) / nullif({down}, 0)"})
        if k > 1:
            steps.append({f"f{k}_{j}": f"f{k - 1}_{j} - f{k}_{k} * f{k - 1}_{k - j}" for j in range(1, k)})
    return steps


def _with_partial(df):
    for name, (c, most) in zip(PARTIAL, _ORDERS):
        for step in partial_steps(lambda lag, c=c, most=most: f"_r{c}_{most}_{lag}", most):
            df = df.withColumns({n: F.expr(e) for n, e in step.items()})
        squares = " + ".join(f"f{k}_{k} * f{k}_{k}" for k in range(1, 6))
        df = df.withColumn(name, F.expr(squares if most == 5 else f"f{most}_{most}"))
        df = df.drop(*[f"f{k}_{j}" for k in range(1, most + 1) for j in range(1, k + 1)])
    return df


def regression_steps(s, most):
    """``[{name: expression}]``: takes the regressors 1 … ``most`` out of the covariances
    ``s(i, j)``; ``e<most>_00`` is what is left of the target's variance.  A regressor that
    the earlier ones explain is passed over."""
    steps, now = [], s
    for k in range(1, most + 1):
        at = lambda i, j, now=now: now(min(i, j), max(i, j))
        own = [0, *range(k + 1, most + 1)]
        steps.append({
            f"e{k}_{i}{j}": f"CASE WHEN {at(k, k)} > 1e-9 * {s(k, k)} THEN {at(i, j)} - {at(i, k)} * {at(k, j)} / {at(k, k)} ELSE {at(i, j)} END"
            for i in own for j in own if i <= j
        })
        now = lambda i, j, k=k: f"e{k}_{i}{j}"
    return steps


def _with_heterogeneity(df):
    for step in regression_steps(lambda i, j: f"_s{i}{j}", ARCH_LAGS):
        df = df.withColumns({n: F.expr(e) for n, e in step.items()})
    return df.withColumn("heterogeneity", F.expr(f"_used * (1 - e{ARCH_LAGS}_00 / nullif(_s00, 0))"))


def _with_crossings(df):
    """Searches the autocorrelations of all lags, which are sums over the period's values."""
    n = F.size("_values")

    def product(lag):
        late, early = F.slice("_values", lag + 1, n), F.slice("_values", F.lit(1), n - lag)
        return F.aggregate(F.zip_with(late, early, lambda a, b: a * b), F.lit(0.0), lambda t, x: t + x)

    total = F.aggregate("_values", F.lit(0.0), lambda t, x: t + x * x)
    every = F.transform(F.sequence(F.lit(0), n - 1), lambda lag: F.round(_ratio(product(lag), F.col("_total")), 9))
    df = df.withColumn("_total", total).withColumn("_ac", F.when(F.col("_total") > 0, every))
    lags = F.sequence(F.lit(1), n - 1)
    value = lambda lag: F.get(F.col("_ac"), lag)
    low = F.filter(lags, lambda k: (value(k) < value(k - 1)) & (value(k) < value(k + 1)))
    not_above = F.filter(lags, lambda k: value(k) <= 0)
    first = lambda found: F.when((n > 1) & F.col("_ac").isNotNull(), F.get(found, F.lit(0))).cast("double")
    return df.withColumns({"firstmin_ac": first(low), "firstzero_ac": first(not_above)})


def smoothing_features(df):
    """``series, period, holt_alpha``: all pairs of level and trend factors of the grid are
    run over the period's values in order, as folds with the smoother's state."""
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("date", "value"))), lambda x: x["value"])
    rows = df.where("value IS NOT NULL").groupBy(*GROUP).agg(ordered.alias("x"))
    levels = F.array(*[F.lit(v) for v in LEVELS])
    tried = rows.withColumn("alpha", F.explode(levels)).withColumn("beta", F.explode(levels))
    state = F.struct(F.get("x", F.lit(0)).alias("level"), (F.get("x", F.lit(1)) - F.get("x", F.lit(0))).alias("trend"), F.lit(0.0).alias("error"))

    def step(s, v):
        expected = s["level"] + s["trend"]
        moved = F.col("alpha") * v + (1 - F.col("alpha")) * expected
        trend = F.col("beta") * (moved - s["level"]) + (1 - F.col("beta")) * s["trend"]
        return F.struct(moved.alias("level"), trend.alias("trend"), (s["error"] + (v - expected) * (v - expected)).alias("error"))

    error = F.aggregate(F.slice("x", F.lit(2), F.size("x")), state, step)["error"]
    best = F.min_by("alpha", F.struct("error", "alpha"))
    return tried.withColumn("error", F.when(F.size("x") >= 4, error)).groupBy(*GROUP).agg(
        F.when(F.count("error") > 0, best).alias("holt_alpha")
    )


def _with_hurst(df):
    """Least-squares slope over the at most 28 lags kept in ``_spread``."""
    points = F.filter(F.col("_spread"), lambda p: p["sd"] > 0)
    logs = F.transform(points, lambda p: F.struct(F.log(p["lag"]).alias("x"), F.log(p["sd"]).alias("y")))
    zero = F.lit(0.0)

    def total(f):
        return F.aggregate(F.col("_logs"), zero, lambda acc, p: acc + f(p))

    k = F.size("_logs").cast("double")
    sx, sy = total(lambda p: p["x"]), total(lambda p: p["y"])
    sxy, sxx = total(lambda p: p["x"] * p["y"]), total(lambda p: p["x"] * p["x"])
    return df.withColumn("_logs", logs).withColumn(
        "hurst", F.when(k > 1, _ratio(k * sxy - sx * sy, k * sxx - sx * sx))
    )


def native_features(df):
    """Long ``(series, period, feature, value)`` of the features of shape and memory."""
    wide = shape_features(df).join(memory_features(df), list(GROUP))
    return wide.unpivot(list(GROUP), SHAPE + MEMORY, "feature", "value")


def partial_features(df):
    """Long, as ``native_features``: the partial autocorrelations."""
    return memory_features(df).unpivot(list(GROUP), PARTIAL, "feature", "value")


def selected_features(df, names):
    """Long, as ``native_features``: the named features, without Python but for entropy."""
    wide = shape_features(df).join(memory_features(df), list(GROUP)).join(smoothing_features(df), list(GROUP))
    own = [c for c in [*SHAPE, *MEMORY, *PARTIAL, "holt_alpha"] if c in names]
    long = wide.unpivot(list(GROUP), own, "feature", "value")
    return long.unionByName(grouped_features(df, ["entropy"])) if "entropy" in names else long
