"""Calendar columns. Monday is 0."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F


def day_of_week(date: Column) -> Column:
    return F.weekday(date)


def is_weekend(date: Column) -> Column:
    return F.weekday(date).isin(5, 6).cast("int")


def calendar_parts(date: Column) -> dict[str, Column]:
    return {
        "day_of_week": day_of_week(date),
        "month": F.month(date),
        "quarter": F.quarter(date),
        "is_weekend": is_weekend(date),
    }


def cycle(value: Column, period: int) -> tuple[Column, Column]:
    angle = value * F.lit(2 * math.pi) / F.lit(period)
    return F.sin(angle), F.cos(angle)


def cyclic_parts(date: Column) -> dict[str, Column]:
    dow_sin, dow_cos = cycle(day_of_week(date), 7)
    month_sin, month_cos = cycle(F.month(date), 12)
    return {"dow_sin": dow_sin, "dow_cos": dow_cos, "month_sin": month_sin, "month_cos": month_cos}
