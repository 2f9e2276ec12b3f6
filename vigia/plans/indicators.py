"""Dashboard-level aggregates over the views.

The dashboard groups with NULL keys dropped and ordered keys; every query here
therefore filters NULL keys and any order is explicit.  Filters (state,
municipality) are Column predicates composed *before* the aggregate, so the
planner pushes them below it (and into the scan when possible).  Top-k uses
``orderBy().limit()`` which plans as a per-partition top-k and a final merge
(TakeOrderedAndProject), never a full sort.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import labels
from ..functions.fmt import thousands_dot, two_decimals
from ..functions.lookup import lookup
from ..operators.project import optional_filter, with_constant
from . import views as V


def _view(t: dict[str, DataFrame], view: Callable[[dict[str, DataFrame]], DataFrame]) -> DataFrame:
    """The view as ``t`` holds it (K15: kept for a dashboard run), else stated
    over the tables."""
    kept = [t[name] for name, fn in V.VIEWS.items() if fn is view and name in t]
    return kept[0] if kept else view(t)


def _filtered(df: DataFrame, state: str | None, municipality: str | None) -> DataFrame:
    return optional_filter(df, estado_uf=state, municipio_nome=municipality)


def _sum_by(df: DataFrame, key: str | list[str], measure: str, alias: str | None = None) -> DataFrame:
    keys = [key] if isinstance(key, str) else key
    nonnull = df
    for k in keys:
        nonnull = nonnull.filter(F.col(k).isNotNull())
    return nonnull.groupBy(*keys).agg(F.sum(measure).alias(alias or measure))


def _chart(df: DataFrame, key: str | list[str], measure: str) -> DataFrame:
    """A chart frame: sums by key, in key order (a handful of rows)."""
    return _sum_by(df, key, measure).orderBy(*([key] if isinstance(key, str) else key))


def _top(df: DataFrame, key: str, measure: str, n: int) -> DataFrame:
    """Top ``n`` by measure, ties broken by key (a fixed, documented choice)."""
    return df.orderBy(F.col(measure).desc(), F.col(key).asc()).limit(n)


def _top_list(df: DataFrame, key: str, measure: str, n: int) -> DataFrame:
    """The top ``n`` as bar charts take them: smallest first."""
    return _top(df, key, measure, n).orderBy(F.col(measure).asc(), F.col(key).desc())


def lab_frame(t, state=None, municipality=None) -> DataFrame:
    """K1: the laboratory view with the laboratory name (source id 1 assumed
    when the column is missing)."""
    lab = with_constant(_view(t, V.laboratory_analysis), "source_id", labels.LAB_SOURCE_ID)
    lab = lab.withColumn("nome_laboratorio", lookup(F.col("source_id"), labels.LAB_NAMES, labels.LAB_OTHER))
    return _filtered(lab, state, municipality)


def filter_states(t) -> DataFrame:
    """K2: distinct non-NULL states (sentinel left to the UI)."""
    return (_view(t, V.epidemiological_profile).select("estado_uf").filter(F.col("estado_uf").isNotNull())
            .distinct().orderBy("estado_uf"))


def filter_municipalities(t, state=None) -> DataFrame:
    """K3: distinct non-NULL municipalities, for a state when one is chosen."""
    prof = optional_filter(_view(t, V.epidemiological_profile), estado_uf=state)
    return (prof.select("municipio_nome").filter(F.col("municipio_nome").isNotNull())
            .distinct().orderBy("municipio_nome"))


def kpi_summary(t, state=None, municipality=None, with_text: bool = False) -> DataFrame:
    """K4 (+K5): totals and lethality = all deaths / confirmed x 100 (0 when
    nothing is confirmed; may exceed 100 by construction)."""
    prof = _filtered(_view(t, V.epidemiological_profile), state, municipality)
    agg = prof.agg(F.coalesce(F.sum("total_casos"), F.lit(0)).alias("total_notificacoes"),
                   F.coalesce(F.sum("casos_confirmados"), F.lit(0)).alias("confirmados"),
                   F.coalesce(F.sum("obitos"), F.lit(0)).alias("obitos"))
    out = agg.withColumn("letalidade", F.when(F.col("confirmados") > 0,
                                              F.col("obitos") / F.col("confirmados") * 100).otherwise(F.lit(0.0)))
    if with_text:
        out = out.withColumns({
            "total_notificacoes_txt": thousands_dot(F.col("total_notificacoes")),
            "confirmados_txt": thousands_dot(F.col("confirmados")),
            "obitos_txt": thousands_dot(F.col("obitos")),
            "letalidade_txt": F.concat(two_decimals(F.col("letalidade")), F.lit("%")),
        })
    return out


def confirmed_by_state(t, state=None, municipality=None) -> DataFrame:
    """K6."""
    return _chart(_filtered(_view(t, V.epidemiological_profile), state, municipality), "estado_uf", "casos_confirmados")


def epidemic_curve(t, state=None, municipality=None) -> DataFrame:
    """K7: confirmed and deaths by notification day (no gap filling)."""
    df = _filtered(_view(t, V.cases_by_municipality), state, municipality).filter(F.col("data_notificacao").isNotNull())
    return df.groupBy("data_notificacao").agg(F.sum("casos_confirmados").alias("casos_confirmados"),
                                              F.sum("obitos").alias("obitos")).orderBy("data_notificacao")


def cases_by_sex(t, state=None, municipality=None) -> DataFrame:
    """K8."""
    return _chart(_filtered(_view(t, V.epidemiological_profile), state, municipality), "sexo", "total_casos")


def confirmed_by_age(t, state=None, municipality=None) -> DataFrame:
    """K9."""
    return _chart(_filtered(_view(t, V.epidemiological_profile), state, municipality), "faixa_etaria", "casos_confirmados")


def vaccine_outcome(t, state=None, municipality=None) -> DataFrame:
    """Cases by (vaccination status, class)."""
    return _chart(_filtered(_view(t, V.vaccination_by_result), state, municipality),
                  ["status_vacinal", "classificacao_final"], "total_casos")


def top_symptoms(t, n: int = 10, state=None, municipality=None) -> DataFrame:
    """The n most frequent symptoms."""
    s = _sum_by(_filtered(_view(t, V.frequent_symptoms), state, municipality), "nome_sintoma", "total_ocorrencias")
    return _top_list(s, "nome_sintoma", "total_ocorrencias", n)


def top_laboratory(t, state=None, municipality=None) -> DataFrame:
    """The laboratory with most tests, or "unavailable"/0 when none."""
    labs = _sum_by(lab_frame(t, state, municipality), "nome_laboratorio", "total_testes")
    top = _top(labs, "nome_laboratorio", "total_testes", 1)
    spark = top.sparkSession
    fallback = spark.createDataFrame([(labels.LAB_UNAVAILABLE, 0)], "nome_laboratorio string, total_testes long")
    return _top_or_default(top, fallback)


def _top_or_default(top: DataFrame, fallback: DataFrame) -> DataFrame:
    """The single top row, or the fallback row when there is none."""
    flagged = top.withColumn("_o", F.lit(0)).unionByName(fallback.withColumn("_o", F.lit(1)))
    return flagged.orderBy("_o").limit(1).drop("_o")


def top_municipalities(t, n: int = 10, state=None, municipality=None) -> DataFrame:
    """Municipalities requesting most tests (grouped by name only)."""
    m = _sum_by(lab_frame(t, state, municipality), "municipio_nome", "total_testes")
    return _top_list(m, "municipio_nome", "total_testes", n)


def top_laboratories(t, n: int = 15, state=None, municipality=None) -> DataFrame:
    """Laboratories by test volume."""
    labs = _sum_by(lab_frame(t, state, municipality), "nome_laboratorio", "total_testes")
    return _top_list(labs, "nome_laboratorio", "total_testes", n)
