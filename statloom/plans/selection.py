"""Correlation report, feature selection and the selected base table."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.operators.associate import (
    collinear_pairs,
    corr_with_target,
    rank_by_magnitude,
    with_selection,
)
from statloom.session import materialise, release, store
from statloom.sources.writers import write_csv


class Selection(NamedTuple):
    correlations: DataFrame  # variavel, correlacao, selecionada; strongest first
    collinear: DataFrame  # var_a, var_b, abs_r among the selected
    base: DataFrame  # value, target and the selected columns, strongest first
    selected: list[str]


def select_features(
    features: DataFrame,
    candidates: Sequence[str],
    target: str = "log_target",
    value: str = "valorPagoEmpenho",
    threshold: float = 0.3,
    collinear_above: float = 0.85,
    keep: Sequence[str] = (),
) -> Selection:
    """Rank the candidates, keep the strong ones, list pairs that repeat each other.

    Only the names of the selected columns reach the driver. ``keep`` names further columns
    that the base table starts with, as a key of its rows. The features are computed twice, to
    correlate all and to store the selected ones, which take much less room than all of them.
    """
    features = features.select(*dict.fromkeys([*keep, value, target, *candidates]))
    corr = materialise(with_selection(corr_with_target(features, candidates, target), threshold))
    ranked = rank_by_magnitude(corr)
    chosen = [r["variable"] for r in ranked.filter("selected").select("variable").collect()]
    release(features.sparkSession)
    features = store(features.select(*dict.fromkeys([*keep, value, target, *chosen])), "features")
    report = ranked.select(
        F.col("variable").alias("variavel"),
        F.col("r").alias("correlacao"),
        F.col("selected").alias("selecionada"),
    )
    return Selection(
        report,
        collinear_pairs(features, chosen, collinear_above) if len(chosen) > 1 else _no_pairs(features),
        features,
        chosen,
    )


def _no_pairs(df: DataFrame) -> DataFrame:
    schema = "var_a string, var_b string, abs_r double"
    return df.sparkSession.createDataFrame([], schema)


def save(selection: Selection, folder: str) -> None:
    """Write the base table and the correlation table as CSV folders."""
    write_csv(selection.base, f"{folder}/base_analitica_final")
    write_csv(selection.correlations, f"{folder}/correlacoes")
