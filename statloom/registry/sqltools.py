"""Pieces of SQL that several equivalents share, and their Spark counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BOX_COX = "CASE WHEN lam = 0 THEN s ELSE (exp(s * lam) - 1) / lam END"
YEO_JOHNSON = """CASE WHEN s >= 0 THEN CASE WHEN lam = 0 THEN s ELSE (exp(s * lam) - 1) / lam END
           ELSE CASE WHEN lam = 2 THEN s ELSE -(exp(-s * (2 - lam)) - 1) / (2 - lam) END END"""


def significant(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column to so many digits behind its first one."""

    def cut(name: str):
        c = F.col(f"`{name}`").cast("double")
        place = F.floor(F.log10(F.abs(c))).cast("double")
        # Powers with whole exponents are exact, their inverses are not.
        up, down = (F.pow(F.lit(10.0), F.greatest(e, F.lit(0.0))) for e in (place, -place))
        return F.coalesce(F.round(c / up * down, digits) * up / down, c).alias(name)

    return df.select(*(
        cut(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`")
        for f in df.schema.fields))


def significant_sql(x: str, digits: int = 6) -> str:
    place = f"floor(log10(nullif(abs({x}), 0)))"
    up, down = (f"pow(10.0::DOUBLE, greatest({e}, 0))" for e in (place, f"-{place}"))
    return f"CASE WHEN ({x}) = 0 THEN 0 ELSE round(({x}) / {up} * {down}, {digits}) * {up} / {down} END"


def fit_ctes(name: str, source: str, power: str, slope: str = "0", reach: int = 48, digits: int = 12) -> str:
    """CTEs that find a lambda: a wide grid, zooming grids and a parabola; the last is ``name`` (lam).

    ``source`` selects the log values as ``s``; ``power`` transforms one by ``lam``; lambdas up
    to ``reach`` are tried, which must not overflow.
    The result is rounded to ``digits``.
    """
    loss = f"0.5 * ln(nullif(var_pop({power}), 0)) - lam * {slope.format(x=f'{name}_x')}"
    levels = [f"{name}_x AS MATERIALIZED ({source})"]
    steps = [(1, reach, "0"), (1 / 16, 16, f"(SELECT b FROM {name}_b0)"),
             (1 / 256, 16, f"(SELECT b FROM {name}_b1)"), (1 / 4096, 16, f"(SELECT b FROM {name}_b2)")]
    for k, (step, around, centre) in enumerate(steps):
        levels.append(
            f"""{name}_g{k} AS (SELECT {centre} + i * {step}::DOUBLE AS lam FROM range({-around}, {around + 1}) t(i)),
            {name}_l{k} AS MATERIALIZED (SELECT lam, {loss} AS loss FROM {name}_x, {name}_g{k} GROUP BY lam),
            {name}_b{k} AS (SELECT arg_min(lam, loss) AS b FROM {name}_l{k})""")
    last = f"{1 / 4096}::DOUBLE"
    levels.append(
        f"""{name}_w AS (SELECT lam, loss AS c, lag(loss) OVER (ORDER BY lam) AS a,
                lead(loss) OVER (ORDER BY lam) AS e FROM {name}_l3),
        {name} AS MATERIALIZED (SELECT round(lam + {last} * 0.5 * (a - e) / (a - 2 * c + e), {digits}) AS lam
                   FROM {name}_w WHERE lam = (SELECT b FROM {name}_b3))""")
    return ", ".join(levels)


def upper_tail_sql(z: str) -> str:
    """Upper tail of the normal distribution: a continued fraction far out, a series near 0."""
    density = f"exp(-0.5 * ({z}) * ({z})) / sqrt(2 * pi())"

    def far(x: str) -> str:
        return (f"({density} / list_reduce([({x})] || [CAST(j AS DOUBLE) FOR j IN range(300, 0, -1)], "
                f"lambda f, j: ({x}) + j / f))")

    terms = (f"list_sum([pow(-1, j) * pow(({z}), 2 * j + 1) / (pow(2.0, j) * gamma(j + 1.0) * (2 * j + 1)) "
             "FOR j IN range(60)])")
    return (f"CASE WHEN ({z}) > 2.5 THEN {far(z)} WHEN ({z}) < -2.5 THEN 1 - {far(f'-({z})')} "
            f"ELSE 0.5 - {terms} / sqrt(2 * pi()) END")


# z of Royston's normal approximation for samples of 12 and more, from w and n.
SHAPIRO_Z = """(ln(1 - w) - (-1.5861 - 0.31082 * ln(n) - 0.083751 * pow(ln(n), 2) + 0.0038915 * pow(ln(n), 3)))
    / exp(-0.4803 - 0.082676 * ln(n) + 0.0030302 * pow(ln(n), 2))"""


def verdict_sql(p: str) -> str:
    return f"CASE WHEN {p} > 0.05 THEN 'Normal' ELSE 'Nao-Normal' END"
