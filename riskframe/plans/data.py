"""The chain scan -> clean -> score of one input folder."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators.evaluation import predictions
from riskframe.operators.prep import clean, fit_medians, with_flags
from riskframe.operators.scoring import place_rates, with_risk
from riskframe.schema import CLUSTER_NUMBERS, FILLED_NUMBERS, MODEL_NUMBERS, PLACE, SHIFT
from riskframe.session import checkpointed, stored
from riskframe.sources.fixture import incident_view


#: Filled numbers that the risk score reads.
SCORE_NUMBERS = ["quantidade_suspeitos", "idade_suspeito"]


class IncidentData:
    """Lazy frames over one folder.

    Row-level frames are plans and are not cached.  Kept for reuse are the joined view and medians, each made
    when a query first needs it, the narrow prediction rows, and fitted models (see ``memo``).
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._memo: dict = {}
        self.medians: dict[str, float | None] = {}

    def memo(self, key: str, build):
        if key not in self._memo:
            self._memo[key] = build()
        return self._memo[key]

    @cached_property
    def raw(self) -> DataFrame:
        return incident_view(self.spark, self.sf_dir)

    @cached_property
    def kept(self) -> DataFrame:
        """The view, joined once and written, for what takes several passes: no pass joins again, and each reads only its columns."""
        return stored(incident_view(self.spark, self.sf_dir, counted=True), "incidents")

    def filled(self, *columns: str) -> DataFrame:
        """Cleaned rows in which missing values of these numbers are their medians; other numbers stay null.

        The medians are those of the whole data set.  Only the ones not known yet are fitted, in shared passes.
        """
        fresh = [c for c in columns if c not in self.medians]
        if fresh:
            self.medians |= fit_medians(self.kept, fresh)
        return clean(self.kept if columns else self.raw, {c: self.medians[c] for c in columns})

    @cached_property
    def clean(self) -> DataFrame:
        return self.filled(*FILLED_NUMBERS)

    @cached_property
    def modelled(self) -> DataFrame:
        """Cleaned rows in which the numbers that models read are filled."""
        return self.filled(*[c for c in FILLED_NUMBERS if c in {*MODEL_NUMBERS, *CLUSTER_NUMBERS}])

    @cached_property
    def plain(self) -> DataFrame:
        """Cleaned rows whose missing numbers stay null, for queries that use none: no median is fitted."""
        return self.filled()

    @cached_property
    def kept_plain(self) -> DataFrame:
        """The rows of ``plain`` for queries that read them several times."""
        return clean(self.kept, {})

    @cached_property
    def place_rates(self) -> DataFrame:
        return checkpointed(place_rates(self.kept_plain))

    @cached_property
    def scored(self) -> DataFrame:
        """Scored rows; of the filled numbers only those that the score reads are filled."""
        return with_risk(self.filled(*SCORE_NUMBERS), rates=self.place_rates)

    @cached_property
    def flagged(self) -> DataFrame:
        """Scored and flagged rows in which the numbers that models read are filled."""
        return with_flags(with_risk(self.modelled, rates=self.place_rates))

    @cached_property
    def pred(self) -> DataFrame:
        """The risk score as a prediction of the label (deterministic, so SQL can check it).

        The narrow rows are written once, as evaluation takes several passes over them.
        """
        return checkpointed(predictions(self.scored, "risk_score", keep=[PLACE, "ano_mes", SHIFT]))


_cache: dict[tuple[str, str], IncidentData] = {}


def incident_data(spark: SparkSession, sf_dir: str) -> IncidentData:
    """One ``IncidentData`` per application and folder (the last one is kept)."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _cache:
        _cache.clear()
        _cache[key] = IncidentData(spark, sf_dir)
    return _cache[key]


def forget() -> None:
    """Drop fitted results, so that the next query starts cold."""
    _cache.clear()


def time_text(column: str | Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
