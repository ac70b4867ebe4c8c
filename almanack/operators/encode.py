"""Feature matrices: one-hot, scaling, selection by name."""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler, VectorSlicer
from pyspark.sql import functions as F


def fit_scaler(train, columns):
    """Mean and population sd per column, as plain numbers.  Runs one aggregate job."""
    row = train.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns],
        *[F.stddev_pop(c).alias(f"s_{c}") for c in columns],
    ).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in columns}


def scale(df, fitted):
    """Standardise with fitted numbers; a column without spread is only centred."""
    return df.withColumns(
        {
            c: (F.col(c) - F.lit(mean)) / F.lit(spread if spread else 1.0)
            for c, (mean, spread) in fitted.items()
        }
    )


def one_hot_stages(columns):
    """``<column>_is`` vectors with one slot per level seen in training; a level
    not seen has no slot set."""
    index = StringIndexer(
        inputCols=columns, outputCols=[f"{c}_at" for c in columns],
        handleInvalid="keep", stringOrderType="alphabetAsc",
    )
    encode = OneHotEncoder(
        inputCols=[f"{c}_at" for c in columns], outputCols=[f"{c}_is" for c in columns]
    )
    return [index, encode]


class Matrix:
    """A fitted encoder: adds the ``features`` vector to a frame.  ``names`` are the slots'."""

    def __init__(self, pipeline, fitted, categorical):
        self.pipeline, self.fitted, self.categorical = pipeline, fitted, list(categorical)
        self.names = None

    def prepared(self, df):
        as_text = {c: F.col(c).cast("string") for c in self.categorical}
        return scale(df.withColumns(as_text) if as_text else df, self.fitted)

    def __call__(self, df):
        scratch = [f"{c}{end}" for c in self.categorical for end in ("_at", "_is")]
        return self.pipeline.transform(self.prepared(df)).drop(*scratch)

    def save(self, spark, path):
        """The pipeline, and the scaling as a table, below ``path``."""
        self.pipeline.write().save(f"{path}/pipeline")
        kinds = [(c, None, None, True) for c in self.categorical] + [(c, m, s, False) for c, (m, s) in self.fitted.items()]
        rows = [(i, *k) for i, k in enumerate(kinds)]
        spark.createDataFrame(rows, "at int, name string, mean double, spread double, categorical boolean").write.parquet(f"{path}/scaling")

    @classmethod
    def load(cls, spark, path):
        rows = spark.read.parquet(f"{path}/scaling").orderBy("at").collect()
        fitted = {r["name"]: (r["mean"], r["spread"]) for r in rows if not r["categorical"]}
        return cls(PipelineModel.load(f"{path}/pipeline"), fitted, [r["name"] for r in rows if r["categorical"]])


def fit_matrix(train, categorical, numeric, invalid="error"):
    """A fitted ``Matrix`` and the slot names.  Fitted on ``train`` only.  ``invalid="keep"``
    leaves missing numbers as NaN slots and missing categories without a slot set."""
    fitted = fit_scaler(train, numeric)
    stages = one_hot_stages(categorical) if categorical else []
    assembler = VectorAssembler(
        inputCols=[f"{c}_is" for c in categorical] + list(numeric), outputCol="features", handleInvalid=invalid
    )
    matrix = Matrix(None, fitted, categorical)
    matrix.pipeline = Pipeline(stages=[*stages, assembler]).fit(matrix.prepared(train))
    matrix.names = slot_names(matrix(train.limit(0)), "features")
    return matrix, matrix.names


def slot_names(df, column):
    attrs = df.schema[column].metadata["ml_attr"]["attrs"]
    slots = sorted((a["idx"], a["name"]) for kind in attrs.values() for a in kind)
    return [name for _, name in slots]


def restrict(df, names, column="features", output="selected"):
    """Only the named slots of the matrix."""
    return VectorSlicer(inputCol=column, outputCol=output, names=list(names)).transform(df)
