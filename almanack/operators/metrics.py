"""Classification scores from one pass of conditional counts."""

from pyspark.sql import functions as F


def classification_metrics(df, prediction="prediction", truth="truth", keys=()):
    """Precision, sensitivity, specificity and their geometric mean; a score whose
    denominator is empty is null."""
    hit, said = F.col(truth) == 1, F.col(prediction) == 1
    tp, fp = F.count_if(said & hit), F.count_if(said & ~hit)
    fn, tn = F.count_if(~said & hit), F.count_if(~said & ~hit)
    counted = df.groupBy(*keys).agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn"))
    scored = counted.withColumns(
        {
            "precision": F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")),
            "sensitivity": F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")),
            "specificity": F.try_divide(F.col("tn"), F.col("tn") + F.col("fp")),
        }
    )
    return scored.withColumn("geometric_mean", F.sqrt(F.col("sensitivity") * F.col("specificity")))
