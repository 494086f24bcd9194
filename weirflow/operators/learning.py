"""Logistic regression on table columns: train, predict, evaluate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def train_classifier(df: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str]):
    """Index categories, assemble and scale features, fit; rows with missing features are left out."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler

    stages = []
    encoded = []
    for c in categorical:
        stages.append(StringIndexer(inputCol=c, outputCol=f"{c}__i", handleInvalid="keep", stringOrderType="alphabetAsc"))
        stages.append(OneHotEncoder(inputCol=f"{c}__i", outputCol=f"{c}__v"))
        encoded.append(f"{c}__v")
    stages.append(VectorAssembler(inputCols=[*numeric, *encoded], outputCol="__raw", handleInvalid="skip"))
    stages.append(StandardScaler(inputCol="__raw", outputCol="__features"))
    stages.append(LogisticRegression(featuresCol="__features", labelCol=label, maxIter=50))
    return Pipeline(stages=stages).fit(df)


def predict(model, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Predicted class and the probability of class 1."""
    from pyspark.ml.functions import vector_to_array

    scored = model.transform(df)
    return scored.select(*keep, F.col("prediction").cast("int").alias("predicted"), F.get(vector_to_array("probability"), F.lit(1)).alias("probability"))


def evaluate(predicted: DataFrame, label: str) -> DataFrame:
    """Precision, recall, accuracy, F1 and log loss of predictions, in one aggregation."""
    y, p = F.col(label).cast("int"), F.col("predicted")
    counts = predicted.agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.avg(-F.when(y == 1, F.log(F.greatest("probability", F.lit(1e-15)))).otherwise(F.log(F.greatest(1 - F.col("probability"), F.lit(1e-15))))).alias("log_loss"),
    )
    c = {n: F.col(n).cast("double") for n in ("tp", "fp", "fn", "tn")}
    precision, recall = F.try_divide(c["tp"], c["tp"] + c["fp"]), F.try_divide(c["tp"], c["tp"] + c["fn"])
    return counts.select(
        precision.alias("precision"), recall.alias("recall"),
        F.try_divide(c["tp"] + c["tn"], c["tp"] + c["fp"] + c["fn"] + c["tn"]).alias("accuracy"),
        F.try_divide(2 * precision * recall, precision + recall).alias("f1_score"), "log_loss")


def area_under_roc(predicted: DataFrame, label: str) -> DataFrame:
    """Exact area under the ROC curve from ranks: ties in probability share their rank.

    Probabilities are counted per value first; the running count over values is segmented.
    """
    from weirflow.plans.segments import plan_cuts, running_window

    per_value = predicted.groupBy("probability").agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    running = running_window(per_value, [], ["probability"], {"neg_upto": ("sum", "neg")}, cuts=plan_cuts(predicted, "probability"))
    won = F.sum(F.col("pos") * (F.col("neg_upto") - F.col("neg") / 2))
    return running.agg(F.try_divide(won.cast("double"), (F.sum("pos") * F.sum("neg")).cast("double")).alias("roc_auc"))
