"""The size check in front of every broadcast of derived data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from halocline.session import ensure_checkpoint_dir

# About 64 MB of narrow rows.
BROADCAST_ROWS = 1_000_000


def settle(df: DataFrame) -> DataFrame:
    """Compute a derived dimension once and keep it in the shared checkpoint folder.

    Where no shared folder is known, it stays a plan and is computed where used.
    """
    return df.checkpoint() if ensure_checkpoint_dir(df.sparkSession) else df


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a derived dimension (axis, layers, per-dataset statistics) if counted small.

    Left to itself, the adaptive planner would already be shuffling the cube on a
    handful of dimension keys by the time it learns the dimension is tiny.  Over
    the bound the keys are many, and the shuffled, skew-splitting join is right.
    """
    kept = settle(df)
    return F.broadcast(kept) if kept.limit(max_rows + 1).count() <= max_rows else kept


def need_keys(dataset: Sequence[str]) -> list[str]:
    keys = list(dataset)
    if not keys:
        raise ValueError("name at least one column that identifies the dataset, e.g. 'var'")
    return keys
