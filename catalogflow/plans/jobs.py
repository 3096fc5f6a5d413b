"""The end-to-end jobs, composed from the operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogflow.functions.hashing import is_gold
from catalogflow.functions.text import clean_description, full_text_strip
from catalogflow.operators import quality
from catalogflow.operators.aggregates import batch_summary
from catalogflow.operators.evaluation import evaluation_summary
from catalogflow.operators.features import prepare_scoring_rows
from catalogflow.operators.joins import decode_label, join_labels, reset_flag, upsert_columns
from catalogflow.operators.learning import StackedModel, stacking_predict
from catalogflow.operators.registry import active_learners, with_lineage
from catalogflow.operators.setops import invalid_classes
from catalogflow.operators.splits import val_selection
from catalogflow.schemas import CLASS_CODES
from catalogflow.sources.writers import prediction_rows


def check_batch(products: DataFrame, labels: DataFrame, batch: int, valid: Sequence[int] = CLASS_CODES) -> None:
    """The batch exists, its keys are unique, every product is labelled with a valid class."""
    rows = products.where(F.col("batch_id") == batch)
    quality.require_empty(quality.empty_batch(products, batch), f"batch {batch} is empty")
    quality.require_empty(quality.duplicate_keys(rows), "duplicate products")
    quality.require_empty(quality.unlabelled_products(rows, labels), "products without label")
    known = labels.join(rows.select("productid"), "productid", "left_semi")
    quality.require_empty(invalid_classes(known, valid), "invalid classes")


def prepared_batch(products: DataFrame, batch: int, clean=clean_description) -> DataFrame:
    """Gold flag and clean text of one batch, keyed by product."""
    return products.where(F.col("batch_id") == batch).select(
        "productid", is_gold(F.col("productid")).alias("is_gold"),
        clean(full_text_strip(F.col("designation"), F.col("description"))).alias("text"),
    )


def ingest_batch(products: DataFrame, labels: DataFrame, batch: int, clean=clean_description,
                 valid: Sequence[int] = CLASS_CODES) -> tuple[DataFrame, DataFrame]:
    """Validate a batch, set its gold flag and text; returns the table and the batch summary.

    Only the batch's rows change; running it again gives the same table. The flag and text
    are functions of the row, so no join is needed to set them.
    """
    check_batch(products, labels, batch, valid)
    here = F.col("batch_id") == batch

    def keep(name: str, kind: str) -> Column:
        return F.col(name) if name in products.columns else F.lit(None).cast(kind)

    text = clean(full_text_strip(F.col("designation"), F.col("description")))
    ready = products.withColumns({
        "is_gold": F.when(here, is_gold(F.col("productid"))).otherwise(keep("is_gold", "boolean")),
        "text": F.when(here, text).otherwise(keep("text", "string")),
    })
    labelled = ready.where(here).join(labels, "productid", "left")
    return ready, batch_summary(labelled, batch, "prdtypecode")


def rebase_val_selection(products: DataFrame, labels: DataFrame, version: int, fraction: float = 0.10,
                         seed: int = 42) -> DataFrame:
    """Set ``is_val_selection_v{version}``; fails when a row was never given its gold flag."""
    unset = products.where((F.col("batch_id") <= version) & F.col("is_gold").isNull()).select("productid")
    quality.require_empty(unset, "products without gold flag")
    column = f"is_val_selection_v{version}"
    stratified = val_selection(
        products.select("productid", "batch_id", "is_gold").join(labels, "productid", "left"),
        version, "prdtypecode", "productid", fraction, seed,
    )
    selected = stratified.where(F.col(column)).select("productid", column)
    return upsert_columns(reset_flag(products, column, version), selected, "productid", [column])


def write_learner_cache(features: DataFrame, products: DataFrame, name: str, version: int,
                        flags: Sequence[str]) -> DataFrame:
    """Learner features with split flags and the model they came from."""
    rows = features.join(products.select("productid", "batch_id", "is_gold", *flags), "productid")
    return with_lineage(rows, name, version)


def score_table(raw: DataFrame, score: Callable[[DataFrame], DataFrame], dimension: DataFrame, date_pred: Column,
                name: str, version: int, family: str, clean=clean_description) -> DataFrame:
    """Raw products to prediction rows. ``score`` adds ``p`` to prepared rows."""
    from catalogflow.functions.vectors import argmax

    scored = score(prepare_scoring_rows(raw, clean)).withColumn("label", argmax(F.col("p")))
    return prediction_rows(decode_label(scored, dimension), date_pred, F.lit(name), F.lit(version), F.lit(family))


def score_requested(requested: DataFrame, pool: DataFrame, score: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Score the requested products that the pool holds, each once."""
    wanted = requested.select("productid").distinct()
    return score(pool.join(wanted, "productid", "left_semi"))


def rescore_all(predictions: DataFrame, pool: DataFrame, score: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Score every product ever predicted again, from the full pool rather than the queue."""
    return score_requested(predictions, pool, score)


def stacked_scorer(model: StackedModel) -> Callable[[DataFrame], DataFrame]:
    return lambda rows: stacking_predict(model, rows)


def evaluate_versions(predictions: DataFrame, aliases: DataFrame, wanted: Sequence[str], split: DataFrame,
                      labels: DataFrame) -> DataFrame:
    """Metrics of every active version on one split.

    ``predictions`` is (name, version, productid, p); each version is evaluated once however
    many aliases it carries, and all versions in the same pass.
    """
    versions = active_learners(aliases, wanted).select("name", "version")
    rows = join_labels(predictions.join(split.select("productid"), "productid", "left_semi"), labels)
    return evaluation_summary(rows.join(versions, ["name", "version"]), by=["name", "version"])
