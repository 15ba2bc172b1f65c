"""Row selection that keeps an expensive flag evaluated once per row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_where(df: DataFrame, flag: str) -> DataFrame:
    """Rows where the boolean column `flag` is true.

    A plain `filter` on a computed flag is pushed below the projection that defines
    it, and the optimizer then inlines the whole defining expression into the
    condition (for quality flags: one JSON parse per referenced field, [measured]
    6x slower at sf0.1).  Exploding a zero-or-one-element array is a generator the
    filter cannot be pushed through, so the flag is computed once, in codegen.
    """
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.select(F.explode(F.when(F.col(flag), F.array(row))).alias("_r")).select("_r.*")
