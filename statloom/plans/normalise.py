"""The Box-Cox normalised table with metadata and checks."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.functions.columns import reorder
from statloom.functions.power import box_cox
from statloom.operators.describe import closeness_gain, describe, quality, same_rows
from statloom.operators.powerfit import box_cox_fit
from statloom.sources.writers import write_csv, write_json

# Names of the statistics in the metadata file.
STATISTIC_NAMES = {
    "media": "mean",
    "mediana": "median",
    "desvio_padrao": "std",
    "minimo": "min",
    "maximo": "max",
    "assimetria": "skew",
    "curtose": "kurtosis",
}


class Normalised(NamedTuple):
    table: DataFrame  # column, column_normalizado, the rest, lambda_boxcox
    metadata: DataFrame  # one row of nested structs
    checks: DataFrame  # rows, missing and infinite values of both columns
    same_rows: DataFrame  # did the table keep its number of rows?
    gains: DataFrame  # improvement of skewness and kurtosis in percent
    lam: float


def normalise(
    df: DataFrame,
    value: str = "log_target",
    source_name: str = "base_analitica_final",
    output_name: str = "base_normalizada_boxcox",
    lam: float | None = None,
) -> Normalised:
    """Fit (or take) lambda, add the normalised column, describe before and after."""
    lam = box_cox_fit(df, value) if lam is None else lam
    after = f"{value}_normalizado"
    added = df.withColumns({after: box_cox(value, lam), "lambda_boxcox": F.lit(lam)})
    table = reorder(added, [value, after], ["lambda_boxcox"])
    stats = describe(table, [value, after], quartiles=False)

    def pick(column: str, of: str):
        return F.max(F.when(F.col("variable") == of, F.col(column)))

    def block(of: str):
        return F.struct(*(pick(c, of).alias(name) for name, c in STATISTIC_NAMES.items()))

    rows = table.agg(F.count(F.lit(1)).alias("n")).scalar()
    metadata = (
        stats.agg(
            block(value).alias("estatisticas_original"),
            block(after).alias("estatisticas_normalizado"),
        )
        .withColumn("registros", rows)
        .select(
            F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("data_geracao"),
            F.lit(source_name).alias("arquivo_origem"),
            F.lit(output_name).alias("arquivo_saida"),
            "registros",
            F.lit(len(table.columns)).cast("bigint").alias("colunas"),
            F.lit("Box-Cox").alias("transformacao"),
            F.lit(lam).alias("lambda_otimizado"),
            F.lit(value).alias("variavel_original"),
            F.lit(after).alias("variavel_normalizada"),
            "estatisticas_original",
            "estatisticas_normalizado",
        )
    )
    gains = stats.agg(
        closeness_gain(pick("skew", value), pick("skew", after)).alias("skew_gain_pct"),
        closeness_gain(pick("kurtosis", value), pick("kurtosis", after)).alias("kurtosis_gain_pct"),
    )
    return Normalised(table, metadata, quality(table, [value, after]), same_rows(df, table), gains, lam)


def save(result: Normalised, folder: str) -> None:
    """Write the normalised table as CSV and its metadata as JSON."""
    write_csv(result.table, f"{folder}/base_normalizada_boxcox")
    write_json(result.metadata, f"{folder}/metadados_normalizacao_boxcox")
