"""The feature table of payroll commitments: clean, enrich, encode.

Column names are those of the published municipal data and of the tables that
users of this analysis expect.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.functions.coerce import as_double, numbers_or_zero, quoted, to_timestamp
from statloom.functions.columns import (
    date_parts,
    flag,
    list_field_mean,
    list_field_sum,
    list_size,
    log1p_floor0,
    optional,
    ratio,
    unique_sorted,
    with_prefix,
)
from statloom.operators.encode import STATISTICS, stat_encode
from statloom.operators.keyed import left_join, row_salt
from statloom.operators.ordering import ROW_LIMIT, percent_rank_average
from statloom.operators.windows import add_lags
from statloom.session import dealt, materialise, release, store
from statloom.sources.readers import read_json_family

# --- fixed values: names in the source data --------------------------------------

FILES = {
    "commitments": "Despesas com Pessoal",
    "programs": "Despesas por Programas",
    "positions": "Cargos e Vencimentos",
    "advances": "Adiantamentos",
}
TARGET = "valorPagoEmpenho"
SALT = "_row_salt"  # stored with the rows, so that joins need not read them whole
LOG_TARGET = "log_target"
AMOUNTS = [
    "valorEmpenho", "valorEmpenhado", "valorPagoEmpenho", "valorLiquidadoEmpenho",
    "saldoAPagar", "saldoALiquidar", "saldoAPagarLiquidado",
    "valorRestosAPagarProcessados", "valorRestosAPagarNaoProcessados",
    "valorRestosAPagarCancelados", "ValorAnuladoEmpenho", "valorPagoRestosEmpenho",
]
PROGRAM_AMOUNTS = [
    "valorOrcado", "valorOrcadoAtualizado", "valorEmpenhado", "valorLiquidado", "valorPago",
    "percentualEmpenhadoSobreOrcadoAtualizado", "percentualPagoSobreOrcadoAtualizado",
]
LISTS = {
    "n_pagamentos": "pagamentos",
    "n_liquidacoes": "liquidacoes",
    "n_docfiscais": "documentosFiscais",
}
SINGLE_KEYS = [
    "descricaoOrgao", "descricaoPrograma", "descricaoFuncao", "descricaoSubfuncao",
    "descricaoElemento", "tipoRecurso", "descricaoUnidade", "tipoEmpenho",
    "descricaoDetalhamentoElemento", "modalidadeAplicacao",
]
COMBINED_KEYS = {
    "te_orgEle": ["descricaoOrgao", "descricaoElemento"],
    "te_progEle": ["descricaoPrograma", "descricaoElemento"],
    "te_uniEle": ["descricaoUnidade", "descricaoElemento"],
    "te_orgFun": ["descricaoOrgao", "descricaoFuncao"],
    "te_orgRec": ["descricaoOrgao", "tipoRecurso"],
    "te_funEle": ["descricaoFuncao", "descricaoElemento"],
    "te_subEle": ["descricaoSubfuncao", "descricaoElemento"],
    "te_uniFun": ["descricaoUnidade", "descricaoFuncao"],
    "te_orgProgEle": ["descricaoOrgao", "descricaoPrograma", "descricaoElemento"],
}
FINE_KEYS = {"te_credor": ["cnpjCpfCredor"], "te_despesaDot": ["idDespesaDot"]}
SIDE_FEATURES = [
    "prog_valor_orcado", "prog_valor_empenhado", "prog_valor_pago",
    "prog_pct_empenhado", "prog_pct_pago", "prog_n_acoes",
    "cv_n_cargos", "cv_vagas_criadas", "cv_vagas_preenchidas", "cv_salario_medio",
    "cv_taxa_ocupacao", "ad_n_adiantamentos", "ad_valor_total",
]
OTHER_FEATURES = [
    "anoExercicio", "mes_empenho", "trimestre", "dia_mes", "fim_ano", "inicio_ano",
    "n_pagamentos", "n_liquidacoes", "n_docfiscais",
    "tx_anulacao", "tx_restos", "log_saldoAPagar",
    "orgao_lag1_sum", "orgao_roll3_sum", "orgao_lag1_mean",
    "prog_lag1_sum", "prog_roll3_sum",
]


def key_sets() -> dict[str, list[str]]:
    """The 21 key sets whose target statistics become features."""
    return {**{f"te_{k}": [k] for k in SINGLE_KEYS}, **COMBINED_KEYS, **FINE_KEYS}


def candidates(features: DataFrame) -> list[str]:
    """Names of the columns to correlate with the target."""
    return unique_sorted(SIDE_FEATURES, OTHER_FEATURES, with_prefix(features, "te_"))


# --- cleaning and row features ---------------------------------------------------


def clean_commitments(raw: DataFrame) -> DataFrame:
    """Typed columns; only commitments with a positive payment."""
    typed = numbers_or_zero(raw, AMOUNTS).withColumns(
        {
            "dataEmpenho": to_timestamp("dataEmpenho"),
            "anoExercicio": as_double(raw, "anoExercicio"),
            "cnpjCpfCredor": optional(raw, "credor.cnpjCpfCredor"),
            "idDespesaDot": optional(raw, "dotacaoOrcamentaria.idDespesa"),
        }
    )
    return typed.filter(F.col(TARGET) > 0)


def row_features(clean: DataFrame) -> DataFrame:
    """Calendar, list-length, ratio and log features; the nested lists are dropped."""
    parts = date_parts("dataEmpenho")
    rests = F.col("valorRestosAPagarProcessados") + F.col("valorRestosAPagarNaoProcessados")
    return clean.withColumns(
        {
            "mes_empenho": parts["month"],
            "trimestre": parts["quarter"],
            "dia_semana": parts["weekday"],
            "dia_mes": parts["day"],
            "fim_ano": flag(parts["month"] >= 11),
            "inicio_ano": flag(parts["month"] <= 2),
            **{name: list_size(source) for name, source in LISTS.items()},
            "tx_anulacao": ratio("ValorAnuladoEmpenho", "valorEmpenhado"),
            "tx_restos": ratio(rests, "valorEmpenhado"),
            "log_saldoAPagar": log1p_floor0("saldoAPagar"),
            LOG_TARGET: F.log1p(TARGET),
        }
    ).drop(*LISTS.values())


# --- side tables -----------------------------------------------------------------


def program_totals(raw: DataFrame) -> DataFrame:
    """Budget totals per year, program and department."""
    keys = ["ano", "descricaoPrograma", "descricaoOrgao"]
    typed = numbers_or_zero(raw, PROGRAM_AMOUNTS).withColumn("ano", as_double(raw, "ano"))
    return (
        typed.dropna(subset=keys)
        .groupBy(*keys)
        .agg(
            F.sum("valorOrcadoAtualizado").alias("prog_valor_orcado"),
            F.sum("valorEmpenhado").alias("prog_valor_empenhado"),
            F.sum("valorPago").alias("prog_valor_pago"),
            F.avg("percentualEmpenhadoSobreOrcadoAtualizado").alias("prog_pct_empenhado"),
            F.avg("percentualPagoSobreOrcadoAtualizado").alias("prog_pct_pago"),
            # The filter changes no count; it makes Spark shuffle the distinct values without the
            # sums, which are added up inside each task instead of once per distinct value.
            F.expr("count(DISTINCT idAcao) FILTER (WHERE idAcao IS NOT NULL)").alias("prog_n_acoes"),
        )
        .withColumnRenamed("ano", "anoExercicio")
    )


def position_totals(raw: DataFrame) -> DataFrame:
    """Jobs, openings, mean salary and occupancy per year and entity."""
    keys = ["ano", "nomeEntidade"]
    typed = raw.withColumns(
        {
            "ano": as_double(raw, "ano"),
            "created": list_field_sum("quadroVagas", "quantidadeVagasCriadas"),
            "filled": list_field_sum("quadroVagas", "quantidadeVagasPreenchidas"),
            "salary": list_field_mean("niveisSalariais", "valor"),
        }
    )
    totals = (
        typed.dropna(subset=keys)
        .groupBy(*keys)
        .agg(
            F.countDistinct("cargo").alias("cv_n_cargos"),
            F.sum("created").alias("cv_vagas_criadas"),
            F.sum("filled").alias("cv_vagas_preenchidas"),
            F.avg("salary").alias("cv_salario_medio"),
        )
    )
    return totals.withColumn(
        "cv_taxa_ocupacao", ratio("cv_vagas_preenchidas", "cv_vagas_criadas", absolute=False)
    ).withColumnRenamed("ano", "anoExercicio")


def advance_totals(raw: DataFrame) -> DataFrame:
    """Number and value of advances per year and department."""
    typed = numbers_or_zero(raw, ["valorEmpenho"]).withColumn(
        "anoExercicio", F.year(to_timestamp("dataEmpenho")).cast("double")
    )
    return (
        typed.withColumnRenamed("orgao", "descricaoOrgao")
        .dropna(subset=["anoExercicio", "descricaoOrgao"])
        .groupBy("anoExercicio", "descricaoOrgao")
        .agg(
            F.count("numero").alias("ad_n_adiantamentos"),
            F.sum("valorEmpenho").alias("ad_valor_total"),
        )
    )


def side_tables(
    programs: DataFrame, positions: DataFrame, advances: DataFrame
) -> list[tuple[DataFrame, list[str]]]:
    """The three side tables, computed once, with the keys they are joined on."""
    return [
        (materialise(program_totals(programs)), ["anoExercicio", "descricaoPrograma", "descricaoOrgao"]),
        (materialise(position_totals(positions)), ["anoExercicio", "nomeEntidade"]),
        (materialise(advance_totals(advances)), ["anoExercicio", "descricaoOrgao"]),
    ]


def enrich(
    facts: DataFrame, sides: Sequence[tuple[DataFrame, list[str]]], salt: Column | None = None
) -> DataFrame:
    """Left-join the side tables; what has no match counts as 0."""
    wide = facts
    for side, keys in sides:
        wide = left_join(wide, side, keys, stored=True, salt=salt)
    return wide.fillna(0, subset=SIDE_FEATURES)


# --- the rank, which gives the target away ---------------------------------------


def add_rank(table: DataFrame, row_limit: int = ROW_LIMIT) -> DataFrame:
    """Add the rank of the payment within year and department over the group's size."""
    groups = ["anoExercicio", "descricaoOrgao"]
    return percent_rank_average(table, TARGET, groups, "rank_pago_orgao_ano", row_limit)


def payment_ranks(commitments: DataFrame, keep: Sequence[str], row_limit: int = ROW_LIMIT) -> DataFrame:
    """The columns ``keep`` of every paid commitment and its rank, without any other feature.

    Only the columns the rank is made of are stored, shuffled and sorted.
    """
    needed = dict.fromkeys([*keep, "anoExercicio", "descricaoOrgao", TARGET])
    narrow = clean_commitments(commitments).select(*map(quoted, needed))
    ranked = add_rank(store(dealt(narrow), "payments"), row_limit)
    return ranked.select(*map(quoted, keep), "rank_pago_orgao_ano")


# --- some encodings only ----------------------------------------------------------


def payment_encodings(commitments: DataFrame, keep: Sequence[str], wanted: Sequence[str],
                      row_limit: int = ROW_LIMIT) -> DataFrame:
    """The columns ``keep`` and LOG_TARGET of every paid commitment and its encodings ``wanted``
    (as te_orgEle_mean), without any other feature.

    Only the key sets that are asked for are aggregated and joined, medians where they are.
    """
    sets = {p: ks for p, ks in key_sets().items() if any(f"{p}_{s}" in wanted for s in STATISTICS)}
    needed = dict.fromkeys([*keep, TARGET, *(k for ks in sets.values() for k in ks)])
    narrow = clean_commitments(commitments).select(*map(quoted, needed)).withColumn(LOG_TARGET, F.log1p(TARGET))
    base = store(dealt(narrow.withColumn(SALT, row_salt(narrow))), "payments")
    medians = [p for p in sets if f"{p}_median" in wanted]
    encoded = stat_encode(base, sets, LOG_TARGET, row_limit, salt=F.col(SALT), medians=medians)
    return encoded.select(*map(quoted, dict.fromkeys([*keep, LOG_TARGET, *wanted])))


# --- the whole table -------------------------------------------------------------


def build_features(
    commitments: DataFrame,
    programs: DataFrame,
    positions: DataFrame,
    advances: DataFrame,
    with_rank: bool = False,
    row_limit: int = ROW_LIMIT,
    columns: Collection[str] | None = None,
    even: bool = False,
) -> DataFrame:
    """One row per paid commitment with all candidate features.

    The cleaned rows are written once, without the side tables, which take little room by
    themselves. Encodings and lags read a few of their columns; small tables come back by
    broadcast joins, after the rows have been shuffled for a big one. The rank within year and
    department gives the target away, so it is only added on request. ``columns`` names the
    columns of the commitments that are wanted, if not all; ``even`` says that the commitments
    lie evenly, as after ``dealt``.
    """
    spark = commitments.sparkSession
    sides = side_tables(programs, positions, advances)
    release(spark)
    facts = row_features(clean_commitments(commitments))
    if columns is not None:
        keys = {k for ks in [*key_sets().values(), *(ks for _, ks in sides)] for k in ks}
        facts = facts.select(*(quoted(c) for c in facts.columns if c in {*columns, *keys, TARGET, LOG_TARGET}))
    facts = facts if even else dealt(facts)
    base = table = store(facts.withColumn(SALT, row_salt(facts)), "payroll")
    release(spark)
    if with_rank:
        table = add_rank(base, row_limit)

    def beside(rows: DataFrame) -> DataFrame:
        rows = enrich(rows, sides, F.col(SALT))
        rows = add_lags(rows, "anoExercicio", "descricaoOrgao", TARGET, "orgao", totals_from=base)
        return add_lags(
            rows, "anoExercicio", "descricaoPrograma", TARGET, "prog",
            ("lag1_sum", "roll3_sum"), totals_from=base,
        )

    encoded = stat_encode(table, key_sets(), LOG_TARGET, row_limit, statistics_from=base,
                          salt=F.col(SALT), even=True, beside=beside)
    # As the side tables' columns would stand if they were joined first.
    first = [*facts.columns, *(c for side, keys in sides for c in side.columns if c not in keys)]
    return encoded.select(*map(quoted, [*first, *(c for c in encoded.columns if c not in {*first, SALT})]))


def read_sources(spark, folder: str, lines: bool = False, schemas: dict | None = None) -> dict:
    """The four JSON families of a folder, by role."""
    schemas = schemas or {}
    return {
        role: read_json_family(spark, folder, prefix, schemas.get(role), lines)
        for role, prefix in FILES.items()
    }
