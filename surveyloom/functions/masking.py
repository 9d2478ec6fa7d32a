"""Masking a share of a column, for imputation tests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from surveyloom.functions.missing import col


def mask_random(c: Column | str, share: float, seed: int, *key: Column | str) -> Column:
    """Blank about ``share`` of the values, drawn by a hash of the row's key and the seed.

    The draw does not depend on partitioning, so a retried task blanks the same rows.
    """
    text = F.concat_ws(":", *[col(k).cast("string") for k in key], F.lit(str(seed)))
    draw = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")
    return F.when(draw >= F.lit(int(share * 2**32)), col(c))


def mask_by(c: Column | str, draw: Column, below: int) -> Column:
    """Blank the values whose draw is below a bound; repeatable for a draw made from the row's key."""
    return F.when(draw >= below, col(c))
