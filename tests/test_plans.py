"""The composite studies on small hand-made inputs."""

import json
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from statloom.plans import payroll
from statloom.plans import normalise as normalise_plan
from statloom.plans import selection as selection_plan
from statloom.plans.estimation_study import add_thresholds, estimate, study_ols
from statloom.plans.normalise import normalise
from statloom.plans.normality_study import study_normality
from statloom.plans.report import DistributionReport
from statloom.plans.selection import select_features

YEARS = (2019, 2020, 2021, 2022)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """The four JSON families, with gaps, dirty values and missing keys."""
    path = tmp_path_factory.mktemp("dados")
    rng = np.random.default_rng(12)
    for year in YEARS:
        rows = []
        for i in range(40):
            org, element = f"O{i % 3}", f"E{i % 2}"
            row = {a: float(np.round(rng.exponential(500), 2)) for a in payroll.AMOUNTS}
            row |= {k: f"{k[-3:]}{i % 4}" for k in payroll.SINGLE_KEYS}
            row |= {
                "anoExercicio": str(year), "dataEmpenho": f"{year}-{1 + i % 12:02d}-15",
                "descricaoOrgao": org, "descricaoElemento": element, "nomeEntidade": f"N{i % 2}",
                "valorPagoEmpenho": "0" if i == 7 else str(row["valorPagoEmpenho"] * (1 + i % 2)),
                "pagamentos": [{"n": 1}] * (i % 3), "liquidacoes": None if i % 5 == 0 else [{"n": 1}],
                "documentosFiscais": [],
                "credor": {"cnpjCpfCredor": f"c{i % 9}", "nome": "x"},
                "dotacaoOrcamentaria": {"idDespesa": i % 6},
            }
            if i == 11:
                row["descricaoOrgao"] = None
                row["dataEmpenho"] = "n/d"
                row["saldoAPagar"] = "-"
            rows.append(row)
        (path / f"Despesas com Pessoal {year}.json").write_text(json.dumps(rows))
        programs = [
            {"ano": year, "descricaoPrograma": f"ama{i % 4}", "descricaoOrgao": f"O{i % 3}",
             "idAcao": i % 5, **{a: float(i) for a in payroll.PROGRAM_AMOUNTS}}
            for i in range(20)
        ]
        programs[0]["valorPago"] = "abc"
        (path / f"Despesas por Programas {year}.json").write_text(json.dumps(programs))
        positions = [
            {"ano": year, "nomeEntidade": f"N{i % 2}", "cargo": f"c{i % 4}",
             "quadroVagas": None if i == 0 else [{"quantidadeVagasCriadas": i, "quantidadeVagasPreenchidas": None}],
             "niveisSalariais": [] if i == 1 else [{"valor": 100.0 * i}, {"valor": None}]}
            for i in range(8)
        ]
        (path / f"Cargos e Vencimentos {year}.json").write_text(json.dumps(positions))
        advances = [
            {"dataEmpenho": f"{year}-03-0{1 + i}", "orgao": f"O{i % 2}", "numero": None if i == 0 else str(i),
             "valorEmpenho": 10.0 * i}
            for i in range(6)
        ]
        (path / f"Adiantamentos {year}.json").write_text(json.dumps(advances))
    return str(path)


@pytest.fixture(scope="module")
def features(spark, folder):
    return payroll.build_features(**payroll.read_sources(spark, folder), with_rank=True).cache()


def pandas_facts(folder):
    """The cleaned facts, computed independently."""
    rows = []
    for year in YEARS:
        rows += json.load(open(f"{folder}/Despesas com Pessoal {year}.json"))
    df = pd.json_normalize(rows, max_level=1)
    df["valorPagoEmpenho"] = pd.to_numeric(df["valorPagoEmpenho"])
    df = df[df["valorPagoEmpenho"] > 0].copy()
    df["log_target"] = np.log1p(df["valorPagoEmpenho"])
    return df


def test_feature_table_shape(features, folder):
    assert features.count() == len(pandas_facts(folder)) == 156
    names = payroll.candidates(features)
    assert len(names) == 135 and set(names) <= set(features.columns)
    assert "rank_pago_orgao_ano" not in names and "dia_semana" not in names


def test_encodings_match_pandas(features, folder):
    facts = pandas_facts(folder).rename(
        columns={"credor.cnpjCpfCredor": "cnpjCpfCredor", "dotacaoOrcamentaria.idDespesa": "idDespesaDot"}
    )
    got = features.toPandas()
    for prefix, keys in payroll.key_sets().items():
        stats = facts.groupby(keys)["log_target"].agg(["mean", "median", "std", "max", "count"])
        want = facts.merge(stats.reset_index(), on=keys, how="left")
        for s in ("mean", "median", "std", "max", "count"):
            a = np.sort(got[f"{prefix}_{s}"].astype(float).to_numpy())
            np.testing.assert_allclose(a, np.sort(want[s].to_numpy()), rtol=1e-9, err_msg=f"{prefix}_{s}")


def test_side_tables(spark, folder):
    sources = payroll.read_sources(spark, folder)
    prog = payroll.program_totals(sources["programs"]).filter("anoExercicio = 2020").toPandas()
    cell = prog[(prog.descricaoPrograma == "ama0") & (prog.descricaoOrgao == "O0")].iloc[0]
    assert (cell.prog_n_acoes, cell.prog_valor_pago, cell.prog_pct_pago) == (2, 12.0, 6.0)
    cv = payroll.position_totals(sources["positions"]).filter("anoExercicio = 2020").toPandas()
    even = cv[cv.nomeEntidade == "N0"].iloc[0]
    assert (even.cv_n_cargos, even.cv_vagas_criadas, even.cv_salario_medio) == (2, 12.0, 150.0)
    odd = cv[cv.nomeEntidade == "N1"].iloc[0]
    assert odd.cv_salario_medio == pytest.approx((150 + 250 + 350) / 3) and odd.cv_taxa_ocupacao == 0
    ad = payroll.advance_totals(sources["advances"]).filter("anoExercicio = 2020").toPandas()
    assert ad.set_index("descricaoOrgao").loc["O0"].tolist()[1:] == [2, 60.0]


def test_dirty_rows(features):
    row = features.filter("descricaoOrgao IS NULL").first()
    assert row["mes_empenho"] is None and row["fim_ano"] == 0 and row["log_saldoAPagar"] == 0.0
    assert row["te_descricaoOrgao_mean"] is None and row["orgao_lag1_sum"] is None
    assert row["rank_pago_orgao_ano"] is None and row["ad_n_adiantamentos"] == 0


def test_sliced_features_agree(spark, folder, features):
    again = payroll.build_features(**payroll.read_sources(spark, folder), with_rank=True, row_limit=20)
    digits = [F.round(F.sum(c), 6).alias(c) for c in [*payroll.candidates(features), "rank_pago_orgao_ano"]]
    assert features.agg(*digits).first() == again.agg(*digits).first()


def test_stored_rows_carry_no_side_tables(spark, folder, features, monkeypatch):
    """The side tables' columns come back at the end; columns nobody wants are not stored at all."""
    stored = {}
    keep = lambda df, label="table", **more: stored.setdefault(label, df) and payroll_store(df, label, **more)
    payroll_store = payroll.store
    monkeypatch.setattr(payroll, "store", keep)
    sources = payroll.read_sources(spark, folder)
    got = payroll.build_features(**sources, columns=[payroll.LOG_TARGET, *payroll.OTHER_FEATURES])
    assert not {*payroll.SIDE_FEATURES, "saldoAPagar", "credor.nome"} & set(stored["payroll"].columns)
    assert "rank_pago_orgao_ano" not in got.columns and "saldoAPagar" in features.columns
    digits = [F.round(F.sum(c), 6).alias(c) for c in payroll.candidates(features)]
    assert features.agg(*digits).first() == got.agg(*digits).first()


def test_distinct_values_are_shuffled_without_sums(spark, folder):
    totals = payroll.program_totals(payroll.read_sources(spark, folder)["programs"])
    plan = totals._jdf.queryExecution().sparkPlan().toString()
    assert "Expand" in plan


@pytest.mark.parametrize("limit", [10**6, 20])
def test_ranks_alone_need_the_commitments_only(spark, folder, features, limit):
    sources = payroll.read_sources(spark, folder)
    got = payroll.payment_ranks(sources["commitments"], ["cnpjCpfCredor", payroll.TARGET], limit)
    assert got.columns == ["cnpjCpfCredor", payroll.TARGET, "rank_pago_orgao_ano"]
    rows = lambda df: sorted(map(tuple, df.select(*got.columns).collect()), key=repr)
    assert rows(got) == rows(features)


@pytest.mark.parametrize("limit", [10**6, 20])
def test_some_encodings_need_the_commitments_only(spark, folder, features, limit):
    commitments = payroll.read_sources(spark, folder)["commitments"]
    wanted = ["te_orgEle_mean", "te_orgEle_median", "te_despesaDot_mean", "te_uniEle_median"]
    got = payroll.payment_encodings(commitments, ["cnpjCpfCredor", payroll.TARGET], wanted, limit)
    assert got.columns == ["cnpjCpfCredor", payroll.TARGET, payroll.LOG_TARGET, *wanted]
    near = [F.round(c, 9).alias(c) if c.endswith("mean") else c for c in got.columns]
    rows = lambda df: sorted(map(tuple, df.select(*near).collect()), key=repr)
    assert rows(got) == rows(features)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test data not present")
def test_the_regression_reads_only_what_it_uses(spark, monkeypatch):
    from statloom.registry import studies

    def unused(*_, **__):
        raise AssertionError("no predictor comes from this table")

    for name in ("programs", "positions", "advances", "features"):
        monkeypatch.setattr(studies, name, unused)
    folder = "/root/testdata/sf0.001"
    assert studies.payroll_ols_coefficients(spark, folder).count() == 19


def test_selection(features, tmp_path):
    names = payroll.candidates(features)
    result = select_features(features, names, threshold=0.3, collinear_above=0.85)
    report = result.correlations.collect()
    assert len(report) == 135
    pdf = features.select(*names, "log_target").toPandas().astype(float)
    want = pdf.corr()["log_target"].drop("log_target")
    for r in report:
        if np.isnan(want[r["variavel"]]):
            assert r["correlacao"] is None and not r["selecionada"]
        else:
            assert r["correlacao"] == pytest.approx(want[r["variavel"]], abs=1e-9)
    chosen = [r["variavel"] for r in report if r["selecionada"]]
    assert chosen == result.selected and result.base.columns == ["valorPagoEmpenho", "log_target", *chosen]
    matrix = pdf[chosen].corr().abs()
    pairs = sum(matrix.iloc[i, j] > 0.85 for i in range(len(chosen)) for j in range(i + 1, len(chosen)))
    assert result.collinear.count() == pairs > 0
    selection_plan.save(result, str(tmp_path))
    assert next((tmp_path / "correlacoes").glob("part*")).read_text().startswith("variavel,correlacao,selecionada")


def test_selection_stores_the_selected_columns_only(features, monkeypatch):
    stored, write = [], selection_plan.store
    monkeypatch.setattr(selection_plan, "store", lambda df, *label: (stored.append(df.columns), write(df, *label))[1])
    result = select_features(features, payroll.candidates(features), threshold=0.3)
    assert stored == [["valorPagoEmpenho", "log_target", *result.selected]] and len(result.selected) < 135


def test_normality_study(frame):
    rng = np.random.default_rng(4)
    skewed = frame([(i, float(v)) for i, v in enumerate(np.exp(rng.normal(size=200)))], "id long, v double")
    study = study_normality(skewed, "v", ["id"])
    assert not study.normal and study.tests.count() == 7 and len(study.transformed.columns) == 8
    bell = frame([(i, float(v)) for i, v in enumerate(rng.normal(size=200))], "id long, v double")
    study = study_normality(bell, "v", ["id"])
    assert study.normal and study.tests.count() == 1 and study.transformed.columns == ["id", "v"]


def test_normalise(frame, tmp_path):
    x = np.random.default_rng(5).gamma(3.0, 2.0, 200)
    df = frame([(float(v), float(np.expm1(v))) for v in x], "log_target double, valorPagoEmpenho double")
    result = normalise(df)
    assert result.table.columns == ["log_target", "log_target_normalizado", "valorPagoEmpenho", "lambda_boxcox"]
    meta = result.metadata.first()
    assert meta["registros"] == 200 and meta["colunas"] == 4 and meta["lambda_otimizado"] == result.lam
    assert meta["estatisticas_original"]["media"] == pytest.approx(x.mean())
    assert abs(meta["estatisticas_normalizado"]["assimetria"]) < abs(meta["estatisticas_original"]["assimetria"])
    assert {r["variable"]: r["n_null"] for r in result.checks.collect()} == {"log_target": 0, "log_target_normalizado": 0}
    assert result.gains.first()["skew_gain_pct"] > 50
    normalise_plan.save(result, str(tmp_path))
    text = json.loads(next((tmp_path / "metadados_normalizacao_boxcox").glob("part*")).read_text())
    assert text["transformacao"] == "Box-Cox" and len(text["estatisticas_normalizado"]) == 7


def test_report(frame):
    x = np.random.default_rng(6).gamma(3.0, 2.0, 150)
    df = frame([(i, float(v), float(np.sqrt(v))) for i, v in enumerate(x)], "id long, a double, b double")
    report = DistributionReport(df, "a", "b", ["id"])
    sizes = {
        "histograms": 120, "normal_overlays": 200, "qq_lines": 2, "boxes": 2, "violins": 200,
        "statistics": 11, "tests": 2, "scatter": 150,
    }
    for figure, rows in sizes.items():
        assert getattr(report, figure)().count() == rows, figure
    assert report.qq_points("a").count() == 150


def test_estimation_and_ols(frame):
    rng = np.random.default_rng(7)
    rows = [(i, float(v), float(v * 2 + rng.normal())) for i, v in enumerate(rng.uniform(0, 3000, 120))]
    rows.append((120, None, 1.0))
    df = add_thresholds(frame(rows, "id long, valorPagoEmpenho double, y double"))
    assert df.filter("id = 120").first()["valorPagoMaior500"] == 0
    found = estimate(df, "valorPagoEmpenho", "valorPagoMaior1000")
    p = found.estimators.first()["proportion"]
    assert found.sample.first()["n_raw"] == pytest.approx(1.96**2 * p * (1 - p) / 0.25)
    study = study_ols(df, "y", ["valorPagoEmpenho", "valorPagoMaior1000"], ["id"])
    assert study.ranking.first()["variable"] == "valorPagoEmpenho"
    assert study.coefficients.count() == 3 and study.summary.first()["r2"] > 0.99
    assert study.predictions.filter("id = 20").first()["abs_error"] < 10
