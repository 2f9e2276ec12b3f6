"""Facts and bridges.

Dimensions are joined with ``sized_broadcast``: shipped whole only after a
row-count check, otherwise left to a shuffle join (and AQE).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import labels
from ..functions.joins import sized_broadcast
from .clean import bool_flags
from .project import project_existing, rename_columns
from .reshape import explode_multivalue


def bridge(clean: DataFrame, column: str, value_name: str, dim: DataFrame, dim_id: str, fk_name: str,
           dim_rows: int | None = None) -> DataFrame:
    """(fk_notificacao, fk_<dim>) pairs, distinct, left-joined on text.
    ``dim_rows``: the dimension's row count when already known."""
    ex = explode_multivalue(clean, column, value_name)
    return (ex.join(sized_broadcast(dim.select(value_name, dim_id), known_rows=dim_rows), value_name, "left")
            .select(F.col("id_notificacao").alias("fk_notificacao"), F.col(dim_id).alias(fk_name)))


def bridge_symptoms(clean: DataFrame, dim: DataFrame, dim_rows: int | None = None) -> DataFrame:
    return bridge(clean, "sintomas", "nome_sintoma", dim, "id_sintoma", "fk_sintoma", dim_rows)


def bridge_conditions(clean: DataFrame, dim: DataFrame, dim_rows: int | None = None) -> DataFrame:
    return bridge(clean, "condicoes", "nome_condicao", dim, "id_condicao", "fk_condicao", dim_rows)


def fact_notifications(clean: DataFrame, dim_loc: DataFrame, dim_race: DataFrame, dim_outcome: DataFrame,
                       with_notification_place: bool = False, dim_rows: dict[str, int] | None = None) -> DataFrame:
    """J3 + J4: the main fact.

    Three left joins (residence locality by municipality code, race and
    outcome by text), the yes/no flags, warehouse names and the 20-column
    list.  ``fk_localidade_notificacao`` is declared by the warehouse but never
    computed by the source system: it stays NULL unless
    ``with_notification_place`` adds the fourth join.  Dates become DATE here.
    ``dim_rows`` ("loc", "race", "outcome"): row counts already known.
    """
    n = dim_rows or {}
    loc = sized_broadcast(dim_loc.select("codigo_ibge_municipio", "id_localidade"), known_rows=n.get("loc"))
    out = (clean.withColumn("_res_code", F.col("municipioIBGE").try_cast("int"))
           .join(loc, F.col("_res_code") == loc.codigo_ibge_municipio, "left")
           .withColumnRenamed("id_localidade", "fk_localidade_residencia")
           .drop("codigo_ibge_municipio", "_res_code"))
    if with_notification_place:
        loc2 = sized_broadcast(dim_loc.select(F.col("codigo_ibge_municipio").alias("_nc"),
                                              F.col("id_localidade").alias("fk_localidade_notificacao")),
                               known_rows=n.get("loc"))
        out = (out.withColumn("_not_code", F.col("municipioNotificacaoIBGE").try_cast("int"))
               .join(loc2, F.col("_not_code") == F.col("_nc"), "left").drop("_nc", "_not_code"))
    else:
        out = out.withColumn("fk_localidade_notificacao", F.lit(None).cast("int"))
    race = sized_broadcast(dim_race.select(F.col("descricao_raca_cor").alias("racaCor"),
                                           F.col("id_raca_cor").alias("fk_raca_cor")), known_rows=n.get("race"))
    outcome = sized_broadcast(dim_outcome.select(F.col("descricao_evolucao").alias("evolucaoCaso"),
                                                 F.col("id_evolucao").alias("fk_evolucao_caso")),
                              known_rows=n.get("outcome"))
    out = out.join(race, "racaCor", "left").join(outcome, "evolucaoCaso", "left")
    out = bool_flags(out)
    out = rename_columns(out, labels.FACT_RENAMES)
    date_cols = ["data_notificacao", "data_inicio_sintomas", "data_encerramento",
                 "data_primeira_dose", "data_segunda_dose"]
    out = out.withColumns({c: F.col(c).cast("date") for c in date_cols if c in out.columns})
    return project_existing(out, labels.FACT_COLUMNS)
