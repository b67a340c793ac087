"""The five hypothesis analyses over deaths, as compositions of operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalframe.functions.text import contains_ignore_case
from vitalframe.operators.association import (
    chi2_independence,
    chi2_statistic,
    kruskal_wallis,
    proportion_statistic,
    proportion_test,
    rate_ratio,
    share_within,
)
from vitalframe.operators.charts import box_stats, density_curve
from vitalframe.operators.counts import count_by, medians, sum_counts
from vitalframe.operators.crosstab import cells, crosstab_percent, pivot_sum, wide_percent
from vitalframe.operators.frequency import group_series

# Category texts, the cause prefix and the age limits of the questions asked.
WITHOUT, WITH = "Sin Asistencia", "Con Asistencia"
NO_ASSISTANCE = "Ninguna"
COVID_PREFIX = "U07"
INFANT_PERIODS = ("Menos De Un Mes", "1 A 11 Meses")
SCHOOLING = ("Ninguna", "Primaria", "Básico", "Diversificado", "Universitario")
CAPITAL = "Guatemala"
STREET = "Pública"
MAN = "Hombre"
YOUNG = (15, 40)
RURAL, URBAN = "Rural", "Urbano"


def assistance_group() -> Column:
    """Two-way assistance; NULL counts as assisted."""
    return F.when(F.col("asist") == NO_ASSISTANCE, WITHOUT).otherwise(WITH)


def infant() -> Column:
    return F.col("perdif").isin(*INFANT_PERIODS)


# --- Cause of death by department and assistance -------------------------------------------


def cause_cells(deaths: DataFrame, prefix: str = COVID_PREFIX) -> DataFrame:
    """``(depocu, _year, asist, n)`` of deaths whose cause starts with ``prefix``."""
    return count_by(deaths.where(F.col("caudef").startswith(prefix)), "depocu", "_year", "asist")


def cause_percent(deaths: DataFrame, values: Sequence[str], prefix: str = COVID_PREFIX) -> DataFrame:
    """Assistance percentages per department, one column per assistance value."""
    return wide_percent(pivot_sum(cause_cells(deaths, prefix), "depocu", "asist", "n", values), "depocu")


def cause_contingency(deaths: DataFrame, prefix: str = COVID_PREFIX) -> DataFrame:
    matching = deaths.where(F.col("caudef").startswith(prefix))
    return count_by(matching.withColumn("asist_cat", assistance_group()), "depocu", "asist_cat")


def cause_ranking(deaths: DataFrame, prefix: str = COVID_PREFIX) -> DataFrame:
    """``(depocu, n, n_without, pct_without)``, the least assisted department first."""
    matching = deaths.where(F.col("caudef").startswith(prefix) & F.col("depocu").isNotNull())
    without = F.count_if(assistance_group() == WITHOUT)
    ranked = matching.groupBy("depocu").agg(
        F.count("*").alias("n"),
        without.alias("n_without"),
        (without / F.count("*") * 100).alias("pct_without"),
    )
    return ranked.orderBy(F.desc("pct_without"), "depocu")


def cause_test(deaths: DataFrame, prefix: str = COVID_PREFIX) -> DataFrame:
    return chi2_independence(cause_contingency(deaths, prefix), "depocu", "asist_cat")


def cause_statistic(deaths: DataFrame, prefix: str = COVID_PREFIX) -> DataFrame:
    return chi2_statistic(cause_contingency(deaths, prefix), "depocu", "asist_cat")


# --- Age at death by schooling --------------------------------------------------------------


def schooling_boxes(deaths: DataFrame, levels: Sequence[str] = SCHOOLING) -> DataFrame:
    return box_stats(deaths, "edadif", "escodif", levels)


def schooling_medians(deaths: DataFrame, levels: Sequence[str] = SCHOOLING) -> DataFrame:
    return medians(deaths, "edadif", "escodif", levels)


def schooling_test(deaths: DataFrame, levels: Sequence[str] = SCHOOLING) -> DataFrame:
    return kruskal_wallis(deaths, "escodif", "edadif", levels)


# --- Infant deaths over time ----------------------------------------------------------------


def infant_cells(deaths: DataFrame) -> DataFrame:
    """``(_year, depocu, n)`` of infant deaths."""
    return count_by(deaths.where(infant()), "_year", "depocu")


def infant_trend(deaths: DataFrame, n: int = 5, must: str | None = CAPITAL) -> DataFrame:
    """Yearly infant deaths of the largest departments and a named one."""
    return group_series(infant_cells(deaths), "_year", "depocu", n, must)


def infant_national(deaths: DataFrame) -> DataFrame:
    return sum_counts(infant_cells(deaths), "_year").orderBy("_year")


def infant_shares(deaths: DataFrame) -> DataFrame:
    """``(_year, total, infantil, pct)`` per year, in one pass."""
    return deaths.groupBy("_year").agg(
        F.count("*").alias("total"),
        F.count_if(infant()).alias("infantil"),
        (F.count_if(infant()) / F.count("*") * 100).alias("pct"),
    )


def infant_contingency(deaths: DataFrame, start: int, end: int) -> DataFrame:
    """Long 2x2 cells ``(_year, kind, n)`` of infant and other deaths in two years."""
    two = deaths.where(F.col("_year").isin(start, end))
    kind = F.when(infant(), "infantil").otherwise("otras")
    return count_by(two.withColumn("kind", kind), "_year", "kind")


def infant_test(deaths: DataFrame, start: int = 2012, end: int = 2021) -> DataFrame:
    return chi2_independence(infant_contingency(deaths, start, end), "_year", "kind")


# --- Deaths in public places ----------------------------------------------------------------


def street_deaths(deaths: DataFrame, text: str = STREET) -> DataFrame:
    return deaths.where(contains_ignore_case(F.col("ocur"), text))


def young_man() -> Column:
    return (F.col("sexo") == MAN) & F.col("edadif").between(*YOUNG)


def street_density(deaths: DataFrame) -> DataFrame:
    return density_curve(street_deaths(deaths), "edadif", "sexo")


def street_shares(deaths: DataFrame) -> DataFrame:
    """Men among all, young men among all, young men among men: ``(measure, hits, base, share)``."""
    street = street_deaths(deaths)
    men = F.col("sexo") == MAN
    one_pass = street.agg(
        F.count("*").alias("all"), F.count_if(men).alias("men"), F.count_if(young_man()).alias("ym")
    )
    measures = (("men", "men", "all"), ("young_men", "ym", "all"), ("young_among_men", "ym", "men"))
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("measure"),
                F.col(hits).alias("hits"),
                F.col(base).alias("base"),
                F.try_divide(F.col(hits), F.col(base)).alias("share"),
            )
            for name, hits, base in measures
        ]
    )
    return one_pass.select(F.inline(rows))


def street_test(deaths: DataFrame, p0: float = 0.5) -> DataFrame:
    return proportion_test(street_deaths(deaths), young_man(), p0)


def street_statistic(deaths: DataFrame, p0: float = 0.5) -> DataFrame:
    return proportion_statistic(street_deaths(deaths), young_man(), p0)


# --- Assistance by area ---------------------------------------------------------------------


def area_percent(deaths: DataFrame) -> DataFrame:
    return crosstab_percent(deaths, "areag", "asist")


def area_contingency(deaths: DataFrame) -> DataFrame:
    two = deaths.where(F.col("areag").isin(RURAL, URBAN))
    return cells(two.withColumn("sin_asist", assistance_group()), "areag", "sin_asist")


def area_test(deaths: DataFrame) -> DataFrame:
    return chi2_independence(area_contingency(deaths), "areag", "sin_asist")


def area_gap(deaths: DataFrame) -> DataFrame:
    """``(rate_a, rate_b, ratio)``: unassisted share, rural against urban."""
    return rate_ratio(deaths, "areag", assistance_group() == WITHOUT, RURAL, URBAN)


def area_share(deaths: DataFrame, area: str) -> DataFrame:
    return share_within(deaths, assistance_group() == WITHOUT, F.col("areag") == area)
