"""Filters on fused fragments; they run after the top-k, so they may leave fewer rows."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.functions.text import parsed_date


@dataclass(frozen=True)
class Filters:
    """theta keeps scores of at least theta, so 0 drops negative ones.  Topic and format must be equal (null never
    is); language, without case, and date pass where the row has none."""

    topic: int | None = None
    format: str | None = None
    language: str | None = None
    dates: tuple[str | None, str | None] | None = None
    theta: float | None = 0.0

    def predicate(self, score: str = "cosine_score") -> Column:
        parts = [] if self.theta is None else [F.col(score) >= self.theta]
        if self.topic is not None:
            parts.append(F.col("fenomeno").eqNullSafe(self.topic))
        if self.format is not None:
            parts.append(F.col("formato").eqNullSafe(self.format))
        if self.language is not None:
            parts.append(F.col("idioma").isNull() | (F.lower("idioma") == self.language.lower()))
        if self.dates is not None and any(self.dates):
            day = parsed_date(F.col("fecha_publicacion"))
            low, high = (F.lit(d).cast("date") if d else None for d in self.dates)
            inside = reduce(lambda a, b: a & b, ([day >= low] if self.dates[0] else []) + ([day <= high] if self.dates[1] else []))
            parts.append(day.isNull() | inside)
        return reduce(lambda a, b: a & b, parts, F.lit(True))


def filtered(fragments: DataFrame, filters: Filters | None, score: str = "cosine_score") -> DataFrame:
    return fragments if filters is None else fragments.filter(filters.predicate(score))
