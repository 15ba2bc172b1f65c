"""JSON scalars: payload → struct (X1) and struct → canonical JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakecart.functions._util import to_col


def parse_payload(payload: Column | str, schema: T.StructType) -> Column:
    """Permissive parse with a declared schema: malformed text gives all-null fields."""
    return F.from_json(to_col(payload), schema, {"mode": "PERMISSIVE"})


def canonical_json(columns: list[str], sort_keys: bool = True, keep_nulls: bool = True) -> Column:
    """One JSON object per row from the named columns, keys sorted, nulls written as null."""
    names = sorted(columns) if sort_keys else list(columns)
    return F.to_json(F.struct(*[F.col(n) for n in names]),
                     {"ignoreNullFields": "false" if keep_nulls else "true"})
