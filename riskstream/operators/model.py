"""Training and scoring: split, encode, assemble, fit, evaluate."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream.operators.ids import dense_ids
from riskstream.operators.quantiles import exact_quantile
from riskstream.session import written

TRAIN_SHARE = 0.8
TREES, DEPTH, SEED = 200, 6, 42
# Spark's trees take no missing values: they get a value of their own, below all others.
MISSING = -1e12


def time_split(
    df: DataFrame, time: str = "us", share: float = TRAIN_SHARE
) -> tuple[DataFrame, DataFrame, float | None]:
    """Rows up to the exact time quantile, rows after it, and the quantile.

    A row without time is in neither part.
    """
    border = exact_quantile(df, time, share)
    limit = F.lit(border).cast("double")
    return df.where(F.col(time) <= limit), df.where(F.col(time) > limit), border


def fit_codes(train: DataFrame, columns: list[str]) -> dict[str, DataFrame]:
    """Code table per column: the sorted distinct training values as 0..n-1."""
    return {
        c: dense_ids(train.select(c).where(F.col(c).isNotNull()).distinct(), c, "code", start=0)
        for c in columns
    }


def encode(df: DataFrame, codes: dict[str, DataFrame]) -> DataFrame:
    """Add ``<column>_code``; values not seen in training and nulls are -1."""
    for column, table in codes.items():
        lookup = table.select(F.col(column).alias("_value"), F.col("code").alias("_code"))
        df = (
            df.join(lookup, F.col(column) == F.col("_value"), "left")
            .withColumn(f"{column}_code", F.coalesce("_code", F.lit(-1)).cast("bigint"))
            .drop("_value", "_code")
        )
    return df


def positional(df: DataFrame) -> DataFrame:
    """Columns renamed to f0..fn by position."""
    return df.toDF(*[f"f{i}" for i in range(len(df.columns))])


def class_ratio(df: DataFrame, label: str = "isFraud") -> DataFrame:
    """Negatives, positives, and their ratio; null without positives."""
    counts = df.agg(
        F.count_if(F.col(label) == 0).alias("negatives"),
        F.count_if(F.col(label) == 1).alias("positives"),
    )
    ratio = F.col("negatives") / F.nullif(F.col("positives"), F.lit(0))
    return counts.withColumn("ratio", ratio)


def train(
    df: DataFrame,
    features: list[str],
    label: str = "isFraud",
    trees: int = TREES,
    depth: int = DEPTH,
    seed: int = SEED,
) -> PipelineModel:
    """Boosted trees on class-weighted rows; positives weigh the class ratio."""
    labelled = df.where(F.col(label).isNotNull())
    ratio = class_ratio(labelled, label).first()["ratio"]
    weight = F.when(F.col(label) == 1, F.lit(float(ratio or 1.0))).otherwise(1.0)
    filled = ", ".join(
        f"coalesce(nanvl(cast(`{c}` as double), {MISSING}D), {MISSING}D) as `_in_{c}`"
        for c in features
    )
    fill = SQLTransformer(statement=f"select *, {filled} from __THIS__")
    assembler = VectorAssembler(inputCols=[f"_in_{c}" for c in features], outputCol="features")
    trees_ = GBTClassifier(
        labelCol=label,
        weightCol="_weight",
        featuresCol="features",
        maxIter=trees,
        maxDepth=depth,
        seed=seed,
    )
    # The trees read the rows once per iteration.
    rows = written(
        labelled.withColumn("_weight", weight).select(
            F.col(label).cast("double").alias(label), "_weight", *features
        ),
        "training",
    )
    return Pipeline(stages=[fill, assembler, trees_]).fit(rows)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` plus ``score``, the probability of the positive class, and ``prediction``."""
    scored = model.transform(df).withColumn("score", vector_to_array("probability")[1])
    return scored.select(*df.columns, "score", "prediction")


def evaluate(df: DataFrame, label: Column, prediction: Column) -> DataFrame:
    """Confusion counts with F1, precision and recall of the positive class, 0 when undefined."""
    hit, miss = prediction == 1, label == 1
    counts = df.agg(
        F.count_if(hit & miss).alias("tp"),
        F.count_if(hit & (label == 0)).alias("fp"),
        F.count_if((prediction == 0) & miss).alias("fn"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")

    def share(part: Column, whole: Column) -> Column:
        return F.coalesce(part / F.nullif(whole, F.lit(0)), F.lit(0.0))

    return counts.withColumns(
        {
            "precision": share(tp, tp + fp),
            "recall": share(tp, tp + fn),
            "f1": share(2 * tp, 2 * tp + fp + fn),
        }
    )
