"""Keep the features that beat shuffled copies of themselves."""

from math import comb, sqrt
from multiprocessing.pool import ThreadPool

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Window, functions as F

from almanack.operators.forests import shadow_gains
from almanack.operators.manytrees import IN_TASK, bin_cuts, with_bins
from almanack.sources.sinks import staged

RANGE_ROWS = 1 << 16
#: Ranges, of about ``RANGE_ROWS`` rows at most, that a task takes.
RANGES_A_TASK = 4


def range_bits(rows):
    """Ranges of at most about ``RANGE_ROWS`` rows of a group of ``rows``."""
    return max(1, -(-rows // RANGE_ROWS) - 1).bit_length()


def tasks_for(bits, groups=1):
    """Tasks for ``2 ** bits`` ranges of each group, so that a task's rows do not grow."""
    return max(1, -(-(groups << bits) // RANGES_A_TASK))


def with_position(df, group, order, name, bits, groups=1):
    """Adds ``name``: the row's place, from 0, in its group by the hash ``order``.

    Hashes are cut into ``2 ** bits`` ranges; the rows of earlier ranges are counted, and a
    window ranks inside one range.  No task holds a group, and tasks follow the ranges of
    the ``groups``.
    """
    ranged = df.withColumn("_range", F.shiftrightunsigned(order, 64 - bits))
    ranged = ranged.repartition(tasks_for(bits, groups), *group, "_range")
    sizes = ranged.groupBy(*group, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*(group or [F.lit(0)])).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = F.row_number().over(Window.partitionBy(*group, "_range").orderBy(order)) - 1
    placed = ranged.withColumn("_inside", inside).join(starts, [*group, "_range"])
    return placed.withColumn(name, F.col("_start") + F.col("_inside")).drop("_range", "_start", "_inside")


def with_shadows(df, columns, key, seed):
    """Adds ``shadow_<column>``: every column permuted on its own, over all rows.

    A row's place is its rank by a hash of the key, a cell's place its rank in the
    column by another hash; each row gets the cell of its place.  One rule for every
    size, with ``columns`` cells a row through the shuffle.
    """
    bits = range_bits(df.count())
    rows = df.withColumn("_h", F.xxhash64(*key, F.lit(seed)))
    rows = with_position(rows, [], F.col("_h"), "_at", bits).drop("_h")
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("v")) for c in columns]))
    cells = df.select(*key, cells.alias("_cell")).select(*key, "_cell.*")
    cells = cells.withColumn("_h", F.xxhash64(*key, F.lit(seed), "name"))
    cells = with_position(cells, ["name"], F.col("_h"), "_at", bits, len(columns))
    # both sides are dealt by place into as many tasks as there are rows for
    many = tasks_for(bits)
    wide = cells.repartition(many, "_at").groupBy("_at").agg(
        *[F.max(F.when(F.col("name") == c, F.col("v"))).alias(f"shadow_{c}") for c in columns]
    )
    return rows.repartition(many, "_at").join(wide, "_at").drop("_at")


def binomial_tail(hits, rounds):
    """Chance of at least ``hits`` heads in ``rounds`` fair tosses."""
    return sum(comb(rounds, k) for k in range(hits, rounds + 1)) / 2 ** rounds


def shadow_selection(train, columns, label, forest, key, rounds=20, level=0.05, seed=1):
    """``(feature, hits, rounds, decision)``, decision in confirmed, rejected, tentative.

    Each round fits ``forest`` on the open features beside shuffled copies; a
    feature scores a hit when its importance exceeds the best copy.  Hits are
    tested against coin tosses, corrected for the number of features, and rejected
    features leave later rounds.  The fits run on Spark; the driver sees one
    importance per feature.
    """
    state = {c: {"hits": 0, "rounds": 0, "decision": "tentative"} for c in columns}
    for number in range(rounds):
        if all(s["decision"] != "tentative" for s in state.values()):
            break
        kept = [c for c in columns if state[c]["decision"] != "rejected"]
        data = with_shadows(train, kept, key, seed + number)
        inputs = kept + [f"shadow_{c}" for c in kept]
        matrix = VectorAssembler(inputCols=inputs, outputCol="features").transform(data)
        model = forest.copy({forest.seed: seed + number}).fit(
            matrix.select("features", F.col(label).cast("double").alias(forest.getLabelCol()))
        )
        importance = model.featureImportances.toArray()
        best_shadow = importance[len(kept):].max()
        for i, c in enumerate(kept):
            s = state[c]
            if s["decision"] != "tentative":
                continue
            s["rounds"] += 1
            s["hits"] += int(importance[i] > best_shadow)
            misses = s["rounds"] - s["hits"]
            if binomial_tail(s["hits"], s["rounds"]) * len(columns) < level:
                s["decision"] = "confirmed"
            elif binomial_tail(misses, s["rounds"]) * len(columns) < level:
                s["decision"] = "rejected"
    table = [(c, s["hits"], s["rounds"], s["decision"]) for c, s in state.items()]
    return train.sparkSession.createDataFrame(
        table, "feature string, hits int, rounds int, decision string"
    )


# -- slots of a matrix, many series at once -------------------------------------


def with_slot_shadows(rows, key, seed, bits, group="series"):
    """Adds ``shadows``: the array ``slots`` with every slot permuted on its own over the
    rows of each group.

    A row's place in its group is its rank by a hash, a cell's its rank in its slot by
    another hash; a row gets the cells of its place.
    """
    placed = with_position(rows.withColumn("_h", F.xxhash64(*key, F.lit(seed))), [group], F.col("_h"), "_at", bits).drop("_h")
    cells = rows.select(*key, *([] if group in key else [group]), F.posexplode("slots").alias("_slot", "_v"))
    cells = cells.withColumn("_h", F.xxhash64(*key, F.lit(seed), "_slot"))
    cells = with_position(cells, [group, "_slot"], F.col("_h"), "_at", bits)
    shadows = cells.groupBy(group, "_at").agg(F.sort_array(F.collect_list(F.struct("_slot", "_v"))).alias("_cells"))
    shadows = shadows.select(group, "_at", F.transform("_cells", lambda c: c["_v"]).alias("shadows"))
    return placed.join(shadows, [group, "_at"]).drop("_at")


def _slot_of(column):
    return lambda i: F.get(column, i)


def forest_size(slots, depth):
    """The number of trees that lets every slot and copy be seen about a hundred times."""
    return max(1, int(100 * sqrt(2 * slots) / depth))


def slot_selection(rows, names, label, forest, key, rounds=20, level=0.05, seed=1, threads=5, group="series", in_task=IN_TASK):
    """``(series, feature, hits, rounds, decision)`` for the slots of every series.

    ``rows``: ``series``, ``key``, ``slots`` (array, without missing values) and ``label``
    (a number, or 0 and 1), a table that is read every round.  ``forest``: a Spark forest.
    The forests of all series of at most ``in_task`` rows are one job a round (``forests``),
    with the settings of ``forest``.  Larger series' copies are made in one job, and their
    forests are fitted by Spark ML from one queue.  Forests see only slots that are not
    rejected.  The driver has the hits of each slot.
    """
    count = {r[group]: r["count"] for r in rows.groupBy(group).count().collect()}
    series = sorted(count)
    small = [s for s in series if count[s] <= in_task]
    bits = range_bits(max(count.values(), default=1))
    tails = {}
    state = {s: {n: [0, 0, "tentative"] for n in names} for s in series}

    def significant(hits, seen):
        if (hits, seen) not in tails:
            tails[hits, seen] = binomial_tail(hits, seen) * len(names) < level
        return tails[hits, seen]

    def kept_of(one):
        return [i for i, n in enumerate(names) if state[one][n][2] != "rejected"]

    def judge(one, kept, importance):
        best = importance[len(kept):].max()
        for i, at in enumerate(kept):
            own = state[one][names[at]]
            if own[2] != "tentative":
                continue
            own[0] += int(importance[i] > best)
            own[1] += 1
            if significant(own[0], own[1]):
                own[2] = "confirmed"
            elif significant(own[1] - own[0], own[1]):
                own[2] = "rejected"

    def fit(job):
        one, data, number = job
        kept = kept_of(one)
        both = F.concat(*[F.transform(F.array(*[F.lit(i) for i in kept]), _slot_of(c)) for c in ("slots", "shadows")])
        matrix = data.where(F.col(group) == one).select(array_to_vector(both).alias("features"), F.col(label).cast("double").alias(forest.getLabelCol()))
        # a level of a forest is a job: one task for as many rows as a range has
        matrix = matrix.coalesce(-(-count[one] // RANGE_ROWS))
        sized = forest.copy({forest.seed: seed + number, forest.numTrees: forest_size(len(kept), forest.getMaxDepth())})
        judge(one, kept, sized.fit(matrix).featureImportances.toArray())

    def fit_small(binned, number):
        kept = {i: kept_of(s) for i, s in enumerate(small) if s in undecided()}
        trees = {i: forest_size(len(k), forest.getMaxDepth()) for i, k in kept.items()}
        drawn = int(forest.getFeatureSubsetStrategy())
        found = shadow_gains(binned, kept, trees, seed + number, drawn, forest.getMaxDepth(), forest.getMinInstancesPerNode())
        for i, gains in found.items():
            judge(small[i], kept[i], gains)

    def undecided():
        return [s for s in series if any(v[2] == "tentative" for v in state[s].values())]

    def large_undecided():
        return [s for s in undecided() if count[s] > in_task]

    def shadowed(number):
        data = rows.where(F.col(group).isin(large_undecided())).select(*key, "slots", label)
        return staged(with_slot_shadows(data, key, seed + number, bits, group), "shadows")

    if small:
        few = rows.where(F.col(group).isin(small))
        at = F.array_position(F.array(*[F.lit(s) for s in small]), F.col(group)) - 1
        binned = with_bins(few, bin_cuts(few, keys=(group,)), keys=(group,)).select(
            at.cast("int").alias("model"), F.xxhash64(*key).alias("at"), "bins", F.col(label).cast("double").alias("y"))
        binned = staged(binned, "selection-bins")
    with ThreadPool(threads) as pool:
        # the next round's copies are made while this round's forests are fitted
        ahead = pool.apply_async(shadowed, (0,)) if rounds and large_undecided() else None
        for number in range(rounds):
            if not undecided():
                break
            if any(s in undecided() for s in small):
                fit_small(binned, number)
            if large_undecided():
                data = ahead.get()
                if number + 1 < rounds:
                    ahead = pool.apply_async(shadowed, (number + 1,))
                pool.map(fit, [(s, data, number) for s in large_undecided()], chunksize=1)
    table = [(s, n, *v) for s in series for n, v in state[s].items()]
    return rows.sparkSession.createDataFrame(table, f"{group} string, feature string, hits int, rounds int, decision string")


def confirmed_slots(selection):
    """``{series: names}`` of the confirmed slots."""
    out = {}
    for r in selection.where("decision = 'confirmed'").orderBy("series", "feature").collect():
        out.setdefault(r["series"], []).append(r["feature"])
    return out


def confirmed(selection):
    return [r["feature"] for r in selection.where("decision = 'confirmed'").collect()]
