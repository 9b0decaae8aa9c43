"""Which commitments stay unpaid at the end of their year: a class target, a model, and its later years."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.functions.coerce import as_double, quoted
from statloom.functions.columns import flag
from statloom.operators.classify import LogitFit, class_metrics, logit_fit, logit_table, probability
from statloom.session import store


class RiskStudy(NamedTuple):
    """fit and coefficients of the model; scores: every row with its probability; metrics per part."""

    fit: LogitFit
    coefficients: DataFrame
    scores: DataFrame
    metrics: DataFrame


def add_outstanding(df: DataFrame, balance: str = "saldoAPagar", name: str = "em_aberto") -> DataFrame:
    """1 where something is left to pay, else 0; a missing balance counts as paid."""
    return df.withColumn(name, flag(F.coalesce(as_double(df, balance), F.lit(0.0)) > 0))


def study_risk(df: DataFrame, features: Sequence[str], last_year: int, year: str = "anoExercicio",
               target: str = "em_aberto") -> RiskStudy:
    """Fit on the years up to ``last_year`` and judge on those and on the later ones apart.

    Rows without year, target or a feature take no part in fit or metrics; their probability is null.
    """
    table = store(df, "risk")
    early = F.col(quoted(year)) <= last_year
    fit = logit_fit(table.filter(early), target, features)
    scores = table.withColumns({"probability": probability(fit),
                                "part": F.when(early, "train").when(~early, "test")})
    return RiskStudy(fit, logit_table(df, fit), scores, class_metrics(scores, target, "probability", ["part"]))
