"""The complaint classifiers: training, scoring and their metrics."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import IDF, HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailprep import fixed as X
from mailprep.functions import text as tx
from mailprep.functions.dialect import words
from mailprep.operators.dataset import MAX_CLASSES, class_weights
from mailprep.session import broadcast_if_small, saved

FEATURES = 1 << 16  # hashed words; words that share a number count as one. The model holds FEATURES numbers per class
PATIENCE = 2


def _tokens(df: DataFrame, text_col: str, max_words: int | None = None) -> DataFrame:
    """All words of the text, or the first ``max_words``."""
    text = tx.col(text_col) if max_words is None else tx.truncate_tokens(text_col, max_words)
    return df.withColumn("tokens", words(F.lower(text)))


def _weighted(train: DataFrame) -> DataFrame:
    """The training rows with the balanced weight of their class."""
    weights = broadcast_if_small(class_weights(train).select("label", "weight"), MAX_CLASSES)
    return train.join(weights, "label").withColumn("label", F.col("label").cast("double"))


def _counted(train: DataFrame, text_col: str, features: int, max_words: int | None) -> tuple[PipelineModel, DataFrame]:
    """What makes features of tokens, and the training rows as (label, weight, features). Texts are cut and counted once,
    written as counts, and read from there for each pass that follows."""
    hashing = HashingTF(inputCol="tokens", outputCol="counts", numFeatures=features)
    rows = hashing.transform(_tokens(_weighted(train), text_col, max_words))
    rows = saved(rows.select("label", "weight", "counts"), "counts")
    idf = IDF(inputCol="counts", outputCol="features").fit(rows)
    return PipelineModel([hashing, idf]), idf.transform(rows).select("label", "weight", "features")


def _classifier(num_classes: int, max_iter: int, reg_param: float) -> LogisticRegression:
    return LogisticRegression(labelCol="label", weightCol="weight", maxIter=max_iter, regParam=reg_param,
                              family="binomial" if num_classes == 2 else "multinomial")


def resume(ready: DataFrame, num_classes: int, iterations: int, reg_param: float,
           state: LogisticRegressionModel | None = None) -> LogisticRegressionModel:
    """``iterations`` more from where ``state`` stands, or from the start. The model returned is the next state: its
    coefficients are all that is kept, one number per feature and class, so a written model can be carried on as well.

    Every iteration is one aggregate of gradients over the rows (label, weight, features). The library takes a first
    model only on its Java side.
    """
    estimator = _classifier(num_classes, iterations, reg_param)
    if state is not None:
        estimator._java_obj.setInitialModel(state._java_obj)
    return estimator.fit(ready)


def train_classifier(train: DataFrame, num_classes: int, text_col: str = X.CLEAN_BODY, max_iter: int = 20,
                     reg_param: float = X.WEIGHT_DECAY, features: int = FEATURES,
                     max_words: int | None = None) -> PipelineModel:
    """A class-weighted linear classifier over hashed word counts. Give ``max_words`` to ``score`` as well."""
    featurizer, ready = _counted(train, text_col, features, max_words)
    return PipelineModel(featurizer.stages + [_classifier(num_classes, max_iter, reg_param).fit(ready)])


def argmax(scores: Column | str) -> Column:
    """The index of the largest score, the first one on a tie."""
    s = tx.col(scores)
    return (F.array_position(s, F.array_max(s)) - 1).cast("long")


def score(model: PipelineModel, rows: DataFrame, text_col: str = X.CLEAN_BODY,
          max_words: int | None = None) -> DataFrame:
    """Add TrueLabel, PredictedLabel and Correct."""
    keep = [F.col(f"`{c}`") for c in rows.columns]
    scored = model.transform(_tokens(rows, text_col, max_words))
    return (scored.select(*keep, F.col("label").cast("long").alias("TrueLabel"),
                          argmax(vector_to_array("rawPrediction")).alias("PredictedLabel"))
            .withColumn("Correct", F.col("TrueLabel") == F.col("PredictedLabel")))


def confusion(pred: DataFrame) -> DataFrame:
    """Rows per true and predicted label."""
    return pred.groupBy("TrueLabel", "PredictedLabel").agg(F.count("*").alias("n"))


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom == 0, 0.0).otherwise(top / F.nullif(bottom, F.lit(0)))


def classification_metrics(pred: DataFrame, num_classes: int) -> DataFrame:
    """accuracy, precision, recall and f1: of class 1 for two classes, else the mean over all labels seen."""
    t, p, n = F.col("TrueLabel"), F.col("PredictedLabel"), F.col("n")
    hit, zero = F.when(t == p, n).otherwise(0), F.lit(0).cast("long")
    miss = n - hit
    per_class = (confusion(pred)
                 .select(F.explode(F.array(
                     F.struct(t.alias("c"), hit.alias("tp"), zero.alias("fp"), miss.alias("fn"), n.alias("n")),
                     F.struct(p.alias("c"), zero.alias("tp"), miss.alias("fp"), zero.alias("fn"), zero.alias("n"))))
                     .alias("r"))
                 .groupBy("r.c").agg(*[F.sum(f"r.{x}").alias(x) for x in ("tp", "fp", "fn", "n")]))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    rates = per_class.select("c", "tp", "n", _ratio(tp, tp + fp).alias("precision"),
                             _ratio(tp, tp + fn).alias("recall"), _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))
    def mean(rate: str) -> Column:
        if num_classes == 2:
            return F.coalesce(F.max(F.when(F.col("c") == 1, F.col(rate))), F.lit(0.0)).alias(rate)
        return F.avg(rate).alias(rate)

    return rates.agg((F.sum("tp") / F.sum("n")).alias("accuracy"), mean("precision"), mean("recall"), mean("f1"))


def select_best(train: DataFrame, val: DataFrame, num_classes: int, text_col: str = X.CLEAN_BODY,
                rounds: Iterable[int] = (5, 10, 20, 40), metric: str = "f1", reg_param: float = X.WEIGHT_DECAY,
                features: int = FEATURES,
                max_words: int | None = None) -> tuple[PipelineModel, list[tuple[int, float]]]:
    """Train up to each number of iterations in ``rounds``, judge the model there, and keep the best by validation score.

    A round goes on from the one before, so all of them together cost the iterations of the last. Features of both parts
    are made once. Stops after two rounds in a row without progress, or when the optimiser has nothing left to gain.
    Returns the model and (iterations, score) per round.
    """
    featurizer, ready = _counted(train, text_col, features, max_words)
    checked = saved(featurizer.transform(_tokens(val, text_col, max_words)).select("label", "features"), "features")
    best, best_value, stale, history, state, done = None, float("-inf"), 0, [], None, 0
    for iterations in rounds:
        state = resume(ready, num_classes, iterations - done, reg_param, state)
        settled, done = state.summary.totalIterations < iterations - done, iterations
        guess = state.transform(checked).select(F.col("label").cast("long").alias("TrueLabel"),
                                                argmax(vector_to_array("rawPrediction")).alias("PredictedLabel"))
        value = classification_metrics(guess, num_classes).first()[metric] or 0.0
        history.append((iterations, value))
        if value > best_value:
            best, best_value, stale = PipelineModel(featurizer.stages + [state]), value, 0
        else:
            stale += 1
        if stale == PATIENCE or settled:
            break
    return best, history


def errors(pred: DataFrame) -> DataFrame:
    """The rows that were labelled wrongly."""
    return pred.filter(~F.col("Correct"))
