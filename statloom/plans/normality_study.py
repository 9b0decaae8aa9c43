"""Is a column normal, and which transform brings it closest?"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.operators.describe import describe
from statloom.operators.normality import (
    ALPHA,
    SAMPLE,
    FittedTransforms,
    add_transforms,
    best_first,
    compare_transforms,
    fit_transforms,
)
from statloom.session import materialise
from statloom.sources.writers import write_csv


class NormalityStudy:
    """Tests of a column and its transforms; each table is computed when it is asked for."""

    def __init__(self, df: DataFrame, value: str, key_cols: Sequence[str], n: int, alpha: float):
        self.table, self.value, self.keys, self.n, self.alpha = df, value, list(key_cols), n, alpha

    @cached_property
    def fitted(self) -> FittedTransforms:
        return fit_transforms(self.table, self.value)

    @cached_property
    def compared(self) -> DataFrame:
        """The column and every feasible transform, tested on one sample."""
        return materialise(compare_transforms(self.table, self.fitted, self.keys, n=self.n, alpha=self.alpha))

    @cached_property
    def normal(self) -> bool:
        """Was the column itself accepted?"""
        return self.compared.filter((F.col("transform") == "Original") & (F.col("p") > self.alpha)).count() == 1

    @property
    def statistics(self) -> DataFrame:
        """Moments of the column."""
        return describe(self.table, [self.value], quartiles=False)

    @property
    def tests(self) -> DataFrame:
        """transform, lambda, n, w, p, result, best first; the column alone if it is normal."""
        tests = self.compared.filter(F.col("transform") == "Original") if self.normal else self.compared
        return tests.orderBy(*best_first())

    @property
    def transformed(self) -> DataFrame:
        """The table, with one target_* column per transform if the column is not normal."""
        return self.table if self.normal else add_transforms(self.table, self.fitted)


def study_normality(
    df: DataFrame,
    value: str,
    key_cols: Sequence[str],
    n: int = SAMPLE,
    alpha: float = ALPHA,
) -> NormalityStudy:
    """Test the column; if it is rejected, try and add every feasible transform."""
    return NormalityStudy(df, value, key_cols, n, alpha)


def save(study: NormalityStudy, folder: str) -> None:
    """Write the table with its transforms, and the tests, as CSV folders."""
    write_csv(study.transformed, f"{folder}/base_analitica_com_transformacoes")
    write_csv(study.tests, f"{folder}/testes_normalidade")
