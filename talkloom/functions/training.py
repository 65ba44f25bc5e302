"""Scalar arithmetic of training jobs, for planning and for reports on exported losses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def steps_per_epoch(n_batches: int, accumulate: int) -> int:
    """Optimiser steps of an epoch; a last, shorter group of batches counts."""
    if n_batches < 1 or accumulate < 1:
        raise ValueError("batches and accumulation are positive")
    return -(-n_batches // accumulate)


def resume_batch(done_steps: int, accumulate: int, n_batches: int) -> int:
    """Batches of the current epoch that were seen before a stop."""
    if done_steps < 0 or accumulate < 1 or n_batches < 1:
        raise ValueError("steps are not negative, the others positive")
    return done_steps * accumulate % n_batches


def hint_only_share(step: Column, start: int, end: int) -> Column:
    """1 up to ``start``, 0 from ``end``, falling evenly between."""
    return F.when(step <= start, 1.0).when(step >= end, 0.0).otherwise(1.0 - (step - start) / float(max(end - start, 1)))


def mean_without_nan(x: Column) -> Column:
    return F.avg(F.nanvl(x, F.lit(None).cast("double")))


def masked_mean(loss: Column, label: Column, pad: int) -> Column:
    """Mean loss over labels that are targets."""
    return F.avg(F.when(label != pad, loss))
