"""From the cleaned snapshot to a trained classifier and its reports."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailprep import fixed as X
from mailprep.operators import dataset as D
from mailprep.operators import model as M
from mailprep.session import saved
from mailprep.sources import reports


def train_complaints(snapshot: DataFrame, key: str, folder: str | None = None) -> tuple[PipelineModel, DataFrame]:
    """Complaint or not."""
    return _train(D.binary_dataset(snapshot, keep=(key,)), key, 2, None, folder)


def train_complaint_types(snapshot: DataFrame, key: str, folder: str | None = None,
                          type_col: str = X.COMPLAINT_TYPE) -> tuple[PipelineModel, DataFrame]:
    """Which type of complaint."""
    rows = D.type_dataset(snapshot, type_col=type_col, keep=(key,))
    mapping = saved(D.label_mapping(rows, type_col), "labels")
    return _train(D.encode_labels(rows, type_col, mapping=mapping), key, mapping.count(), mapping, folder)


def _train(rows: DataFrame, key: str, num_classes: int, mapping: DataFrame | None,
           folder: str | None) -> tuple[PipelineModel, DataFrame]:
    """Fit on the train part, choose by the validation part, score the test part; write the reports to ``folder``."""
    parts = saved(D.split_dataset(rows, key), "split")
    train, val, test = (parts.filter(F.col("split") == s).drop("split") for s in D.SPLITS)
    model, history = M.select_best(train, val, num_classes)
    scored = M.score(model, test)
    if folder is not None:
        reports.write_stats(D.dataset_stats(parts, mapping), folder)
        reports.write_predictions(scored, folder)
        reports.write_metrics(M.classification_metrics(scored, num_classes), folder)
        reports.write_history(parts.sparkSession, history, folder)
        model.write().save(f"{folder}/model")
    return model, scored
