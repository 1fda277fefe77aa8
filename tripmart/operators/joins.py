"""Size-checked broadcast joins against dimensions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Dim:
    """A dimension plus an upper bound on its row count, if one is known.

    ``max_rows`` is proven by construction (literal rows, calendar days).
    Dimensions read from files have none: Catalyst and AQE choose the join by
    their measured bytes.
    """
    df: DataFrame
    max_rows: int | None = None

    def side(self, limit: int) -> DataFrame:
        """The dimension, marked for broadcast only when its bound fits."""
        return F.broadcast(self.df) if self.max_rows is not None and self.max_rows <= limit else self.df
