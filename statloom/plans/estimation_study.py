"""Sample sizes from threshold flags, and the regression study."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import cached_property
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.functions.columns import flag
from statloom.operators.associate import corr_all_numeric
from statloom.operators.estimation import estimators, sample_size
from statloom.operators.regression import (
    OlsFit,
    coefficient_table,
    ols_fit,
    ols_predict,
    ols_summary,
)
from statloom.session import store

# The payment thresholds that are studied.
THRESHOLDS = {
    "valorPagoMaior500": 500,
    "valorPagoMaior1000": 1000,
    "valorPagoMaior20000": 20000,
}


def add_thresholds(
    df: DataFrame,
    value: str = "valorPagoEmpenho",
    thresholds: Mapping[str, float] = THRESHOLDS,
) -> DataFrame:
    """Fill missing values with 0 and flag the rows at or above each threshold."""
    filled = df.fillna(0, subset=[value])
    return filled.withColumns(
        {name: flag(F.col(value) >= limit) for name, limit in thresholds.items()}
    )


class Estimates(NamedTuple):
    estimators: DataFrame
    sample: DataFrame


def estimate(
    df: DataFrame,
    value: str,
    flag_col: str,
    z: float = 1.96,
    e: float = 0.5,
    group_cols: Sequence[str] = (),
) -> Estimates:
    """Proportion, mean and variance, and the sample the proportion asks for."""
    return Estimates(
        estimators(df, value, flag_col, group_cols),
        sample_size(df, flag_col, z, e, group_cols),
    )


class OlsStudy:
    """Regression of a target on features; each table is computed when it is asked for.

    The columns are written once, since the fit, the residuals and the predictions all
    read them.
    """

    def __init__(self, df: DataFrame, target: str, features: Sequence[str], order_cols: Sequence[str]):
        self.table = store(df, "regression")
        self.target, self.features, self.order_cols = target, list(features), list(order_cols)

    @cached_property
    def fit(self) -> OlsFit:
        return ols_fit(self.table, self.target, self.features)

    @property
    def ranking(self) -> DataFrame:
        """All numeric columns by their signed correlation with the target."""
        return corr_all_numeric(self.table, self.target).withColumn("r", F.round("r", 4))

    @property
    def coefficients(self) -> DataFrame:
        return coefficient_table(self.table, self.fit)

    @property
    def summary(self) -> DataFrame:
        return ols_summary(self.table, self.fit, self.order_cols)

    @property
    def predictions(self) -> DataFrame:
        return ols_predict(self.table, self.fit)


def study_ols(
    df: DataFrame, target: str, features: Sequence[str], order_cols: Sequence[str]
) -> OlsStudy:
    """Rank all numeric columns, fit, summarise and predict every row."""
    return OlsStudy(df, target, features, order_cols)
