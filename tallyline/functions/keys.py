"""Deterministic surrogate keys: the same staged row gets the same keys on every rerun."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_key(kind: str, file_name: str = "FileName", row_id: str = "id") -> Column:
    return F.sha2(F.concat_ws(":", F.col(file_name), F.col(row_id).cast("string"), F.lit(kind)), 256)
