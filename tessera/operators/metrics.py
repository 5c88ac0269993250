"""Evaluation and corpus statistics: E1-E6.

All metrics are Spark aggregates (partial per partition, then final), so the
accumulate / compute / reset cycle of a batch metric becomes two counters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

IGNORE_LABEL = -100


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ------------------------------------------------------------------ E1
def argmax(logits) -> Column:
    """0-based index of the largest value, lowest index on ties."""
    a = _c(logits)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def token_loss(logits, label) -> Column:
    """Cross-entropy of one position: log-sum-exp(logits) - logits[label]."""
    a = F.transform(_c(logits), lambda x: x.cast("double"))
    m = F.array_max(a)
    lse = m + F.log(F.aggregate(a, F.lit(0.0).cast("double"), lambda acc, x: acc + F.exp(x - m)))
    return lse - F.try_element_at(a, _c(label) + 1)


# ------------------------------------------------------------------ E2, F6
def scored(df: DataFrame, label_col: str = "label") -> DataFrame:
    """positions that count, ``label <> -100``."""
    return df.where(F.col(label_col) != IGNORE_LABEL)


def masked_accuracy(df: DataFrame, pred_col: str = "pred", label_col: str = "label",
                    group_cols=()) -> DataFrame:
    """Share of ``pred = label`` among scored positions (global or per group)."""
    s = scored(df, label_col)
    correct = F.when(F.col(pred_col) == F.col(label_col), 1).otherwise(0)
    return s.groupBy(*group_cols).agg(F.avg(correct).alias("accuracy"),
                                      F.count(F.lit(1)).alias("n_scored"))


# ------------------------------------------------------------------ E3
def accuracy_by_batch(df: DataFrame, batch_col: str = "batch_id", pred_col: str = "pred",
                      label_col: str = "label") -> DataFrame:
    """Accuracy over all batches: per-batch (correct, total), then one ratio.

    Not a mean of batch means.
    """
    s = scored(df, label_col)
    per_batch = s.groupBy(batch_col).agg(
        F.sum(F.when(F.col(pred_col) == F.col(label_col), 1).otherwise(0)).alias("_correct"),
        F.count(F.lit(1)).alias("_total"))
    return per_batch.agg(
        (F.sum("_correct") / F.sum("_total")).alias("accuracy"),
        F.sum("_correct").alias("n_correct"),
        F.sum("_total").alias("n_scored"),
        F.count(F.lit(1)).alias("n_batches"))


# ------------------------------------------------------------------ E4
def perplexity(df: DataFrame, loss_col: str = "loss", group_cols=()) -> DataFrame:
    """``exp(mean loss)``; an overflow is +Infinity."""
    return df.groupBy(*group_cols).agg(
        F.avg(loss_col).alias("eval_loss"),
        F.exp(F.avg(loss_col)).alias("perplexity"))


# ------------------------------------------------------------------ E5
def sample_counts(df: DataFrame, max_samples: int | None, split_col: str = "split") -> DataFrame:
    """``min(max_samples, rows)`` per split."""
    n = F.count(F.lit(1))
    out = n if max_samples is None else F.least(F.lit(max_samples).cast("long"), n)
    return df.groupBy(split_col).agg(out.alias("samples"))


# ------------------------------------------------------------------ E6
def corpus_counts(df: DataFrame, split_col: str = "split", shard_col: str = "shard") -> DataFrame:
    """Sentences and files per split."""
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n_sentences"),
                                     F.countDistinct(shard_col).alias("n_files"))
