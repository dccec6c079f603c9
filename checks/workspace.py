"""Reviews of one data folder, cleaned and modelled once per session, on first use, and then shared by queries."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from reviewmill.operators.sentiment import sample_lexicon
from reviewmill.plans.clean import clean_reviews
from reviewmill.plans.star import Star, build_star
from reviewmill.sources.sample import raw_reviews
from reviewmill.staging import Stage


@dataclass(frozen=True)
class Workspace:
    stage: Stage
    raw: DataFrame

    @cached_property
    def cleaned(self) -> DataFrame:
        # Not stored: the texts of the reviews are many times the size of the tables they come from.
        cleaned = clean_reviews(self.raw, sample_lexicon(self.raw.sparkSession), self.stage, store=False)
        # Refused as by the star, also for queries that do not look at it.
        if not cleaned.filter("review_date is null").isEmpty():
            raise ValueError("reviews without a review_date have no date key")
        return cleaned

    @cached_property
    def star(self) -> Star:
        return build_star(self.cleaned, self.stage)


_BUILT: dict[tuple[str, str], Workspace] = {}


def workspace(spark: SparkSession, folder: str) -> Workspace:
    """Built on first use from the given tables; stored in the session's shared folder."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _BUILT:
        _BUILT[key] = Workspace(Stage(spark), raw_reviews(spark, folder))
    return _BUILT[key]
