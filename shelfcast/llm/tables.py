"""Small tables whose rows stand in the plan."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table of given rows as one literal; nothing is sent through Python workers."""
    names = [field.split()[0] for field in schema.split(", ")]
    text = json.dumps([dict(zip(names, row)) for row in rows])
    parsed = F.from_json(F.lit(text), f"array<struct<{', '.join(f.replace(' ', ':', 1) for f in schema.split(', '))}>>")
    return spark.range(0, 1, 1, 1).select(F.inline(parsed))
