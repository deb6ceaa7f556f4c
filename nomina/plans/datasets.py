"""Training sets for the text model and for fine-tuning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nomina import fixed
from nomina.functions.cleaning import clean
from nomina.functions.labels import is_labeled
from nomina.operators.dataset import (
    drop_empty_clean,
    drop_junk,
    drop_nulls,
    keep_frequent_classes,
)
from nomina.operators.reports import class_report, confusion, scores
from nomina.operators.sampling import cap_per_class, stratified_split
from nomina.operators.textmodel import TextModel, train_text_model
from nomina.scratch import materialise


def training_set(
    labels: DataFrame,
    min_per_class: int = fixed.TRAIN_MIN_PER_CLASS,
    max_per_class: int = fixed.TRAIN_MAX_PER_CLASS,
    seed: int = fixed.SEED,
    drop_fallback: bool = False,
) -> DataFrame:
    """Rows for the text model: classes are filtered and capped first, texts
    cleaned afterwards. The fallback label stays a class unless dropped.
    ``labels`` is read several times: pass a written table with unique texts."""
    rows = drop_junk(drop_nulls(labels))
    if drop_fallback:
        rows = rows.where(is_labeled(F.col("category")))
    capped = cap_per_class(
        keep_frequent_classes(rows, min_per_class), max_per_class, ["text"], seed
    )
    return drop_empty_clean(capped.withColumn("clean", clean(F.col("text"))))


def finetune_dataset(
    labels: DataFrame,
    min_per_class: int = fixed.FINETUNE_MIN_PER_CLASS,
    max_per_class: int = fixed.FINETUNE_MAX_PER_CLASS,
    val_share: float = fixed.VALIDATION_SHARE,
    seed: int = fixed.SEED,
) -> DataFrame:
    """Rows for fine-tuning with a flag ``is_val``: texts are cleaned first,
    classes filtered and capped afterwards, then split class by class."""
    cleaned = drop_junk(drop_nulls(labels)).withColumn("clean", clean(F.col("text")))
    cleaned = materialise(drop_empty_clean(cleaned), "cleaned")
    capped = cap_per_class(
        keep_frequent_classes(cleaned, min_per_class), max_per_class, ["text"], seed
    )
    return stratified_split(materialise(capped, "capped"), ["text"], val_share, seed)


def write_finetune_dataset(dataset: DataFrame, train_path: str, val_path: str) -> None:
    written = materialise(dataset, "finetune")
    for path, rows in ((train_path, ~F.col("is_val")), (val_path, F.col("is_val"))):
        written.where(rows).drop("is_val").write.mode("overwrite").parquet(path)


def train_and_evaluate(
    dataset: DataFrame, key: str = "text", seed: int = fixed.SEED, **options
) -> tuple[TextModel, DataFrame, DataFrame]:
    """Split, train and evaluate: (model, class report, scores)."""
    split = materialise(stratified_split(materialise(dataset, "dataset"), [key], seed=seed), "split")
    model = train_text_model(split.where(~F.col("is_val")), "clean", **options)
    tested = model.predict(split.where("is_val"), "clean", "predicted")
    report = materialise(class_report(confusion(tested, "category", "predicted")), "report")
    return model, report, scores(report)
