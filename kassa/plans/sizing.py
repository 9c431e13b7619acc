"""Size checks that guard every explicit broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def bounded_rows(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows.

    First asks the optimizer for a row bound it can prove from the plan
    (in-memory rows, limits, global aggregates): no job. Otherwise reads at
    most ``max_rows + 1`` rows (the limit is pushed into the scan), so the
    check stays cheap whatever the real size.
    """
    try:
        proven = df._jdf.queryExecution().optimizedPlan().maxRows()
        if proven.isDefined():
            return int(proven.get()) <= max_rows
    except Exception:  # plan introspection unavailable (e.g. Spark Connect)
        pass
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_bounded(df: DataFrame, max_rows: int = 1_000_000) -> DataFrame:
    """``broadcast(df)`` when its row count is proven within ``max_rows``;
    otherwise ``df`` unchanged, so the planner shuffles (and AQE may still
    convert to a broadcast from runtime sizes)."""
    return F.broadcast(df) if bounded_rows(df, max_rows) else df
