"""Balanced bags of boosted trees for a rare label."""

from multiprocessing.pool import ThreadPool

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, functions as F

from almanack.settings import UNDERSAMPLE_RATIO


def draw(key, bag):
    """A number in [0, 1) fixed by the row's key and the bag."""
    bag = bag.cast("string") if isinstance(bag, Column) else F.lit(bag)
    digest = F.md5(F.concat_ws("|", *key, bag))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(2 ** 32)


def class_counts(df, label, group=()):
    return df.groupBy(*group).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) == 0).alias("_neg")
    )


def undersample(df, label, key, bag, ratio=UNDERSAMPLE_RATIO, group=(), counted=None):
    """All positives, and negatives drawn so that positives / negatives is near ``ratio``.

    The draw is a hash of the key: repeatable after a lost task, and the same in SQL.
    ``counted`` may hold the row of ``class_counts``, when many bags are drawn.
    """
    counts = None if counted else class_counts(df, label, group)
    if group:
        counted = df.join(counts, list(group))
        pos, neg = F.col("_pos"), F.col("_neg")
    else:
        row = counted or counts.first()
        counted, pos, neg = df, F.lit(row["_pos"]), F.lit(row["_neg"])
    rate = F.try_divide(pos, F.lit(float(ratio)) * neg)
    keep = (F.col(label) == 1) | (draw(key, bag) < rate)
    return counted.where(keep).drop("_pos", "_neg")


def bag_members(df, label, key, group, bags, ratio):
    """The rows of every bag of every group, with ``bag``: all positives of the group, and
    negatives drawn per bag so that positives / negatives is near ``ratio``.

    ``bags`` and ``ratio`` may be columns.  Classes are counted once for all bags.
    """
    every = F.sequence(F.lit(0), (bags if isinstance(bags, Column) else F.lit(bags)) - 1)
    ratio = ratio if isinstance(ratio, Column) else F.lit(float(ratio))
    counted = df.join(class_counts(df, label, group), list(group))
    rate = F.try_divide(F.col("_pos"), ratio * F.col("_neg"))
    spread = counted.withColumns({"_rate": rate, "bag": F.explode(every)})
    keep = (F.col(label) == 1) | (draw(key, F.col("bag")) < F.col("_rate"))
    return spread.where(keep).drop("_pos", "_neg", "_rate")


def fit_bags(train, label, key, bags=10, ratio=1.0, trees=10, depth=3, features="features", seed=42):
    """One boosted model per bag, a few at a time; the classes are counted once."""
    counted = class_counts(train, label).first()
    learner = GBTClassifier(
        featuresCol=features, labelCol=label, maxIter=trees, maxDepth=depth, seed=seed
    )
    with ThreadPool(min(4, bags)) as pool:
        return pool.map(lambda b: learner.fit(undersample(train, label, key, b, ratio, counted=counted)), range(bags))


def predict_bags(models, df):
    """Adds ``probability`` (mean over bags) and ``prediction`` (0/1).

    Scores are added column by column in one pass; nothing is joined.
    """
    total = F.lit(0.0)
    for number, model in enumerate(models):
        model = model.copy()
        model.setProbabilityCol(f"_p{number}").setRawPredictionCol("_raw").setPredictionCol("_pred")
        df = model.transform(df).drop("_raw", "_pred")
        total = total + vector_to_array(F.col(f"_p{number}"))[1]
    df = df.withColumn("probability", total / len(models))
    return df.drop(*[f"_p{n}" for n in range(len(models))]).withColumn(
        "prediction", (F.col("probability") > 0.5).cast("int")
    )
