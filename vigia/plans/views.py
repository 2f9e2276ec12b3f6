"""The analytical views (V1-V6) over the warehouse tables.

Each view takes the table mapping (``Warehouse.tables`` or any dict of
DataFrames with the warehouse names) and returns a lazy DataFrame.  Joins to
dimensions are left to the planner: dimensions read from parquet carry their
file size, so they are broadcast only while under the broadcast threshold and
joined by shuffle beyond it.  Aggregations are partial on the map side (one
exchange on the grouping keys).  NULL group keys are kept, as SQL does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import labels


def _count_if(cond) -> F.Column:
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0)))


def _fact_place(t: dict[str, DataFrame], fact_cols: list[str], place_cols: list[str]) -> DataFrame:
    """Facts with a known residence locality (inner join: unknown places drop out)."""
    cols = list(dict.fromkeys([*fact_cols, "fk_localidade_residencia"]))   # ordered, no repeats
    fn = t["fato_notificacoes"].select(*cols)
    dl = t["dim_localidades"].select("id_localidade", *place_cols)
    return fn.join(dl, fn.fk_localidade_residencia == dl.id_localidade)


def cases_by_municipality(t: dict[str, DataFrame]) -> DataFrame:
    """V1: (municipality, state, day) -> notifications, confirmed, discarded, deaths."""
    j = _fact_place(t, ["id_notificacao", "data_notificacao", "classificacao_final", "fk_evolucao_caso"],
                    ["municipio_nome", "estado_uf"])
    de = t["dim_evolucao_caso"].select("id_evolucao", "descricao_evolucao")
    j = j.join(de, j.fk_evolucao_caso == de.id_evolucao, "left")
    return j.groupBy("municipio_nome", "estado_uf", "data_notificacao").agg(
        F.count("id_notificacao").alias("total_notificacoes"),
        _count_if(F.col("classificacao_final") == labels.CONFIRMED).alias("casos_confirmados"),
        _count_if(F.col("classificacao_final") == labels.DISCARDED).alias("casos_descartados"),
        _count_if(F.col("descricao_evolucao") == labels.DEATH).alias("obitos"),
    )


def vaccination_status(received: F.Column, doses: F.Column) -> F.Column:
    """The vaccination CASE, in order."""
    return (F.when(received == labels.VAX_NOT_VACCINATED_CODE, F.lit(labels.VAX_NOT_VACCINATED))
            .when(doses.isNull() | (doses == ""), F.lit(labels.VAX_NOT_INFORMED))
            .when(doses.contains(","), F.lit(labels.VAX_TWO_OR_MORE))
            .otherwise(F.lit(labels.VAX_ONE_OR_OTHER)))


def vaccination_by_result(t: dict[str, DataFrame]) -> DataFrame:
    """V2: (class, vaccination status, state, municipality) -> cases, for the
    two closed classes only (filter pushed below the join)."""
    j = _fact_place(t, ["id_notificacao", "classificacao_final", "codigo_recebeu_vacina", "codigo_doses_vacina"],
                    ["estado_uf", "municipio_nome"])
    j = j.filter(F.col("classificacao_final").isin(labels.CONFIRMED, labels.DISCARDED))
    return (j.withColumn("status_vacinal", vaccination_status(F.col("codigo_recebeu_vacina"),
                                                              F.col("codigo_doses_vacina")))
            .groupBy("classificacao_final", "status_vacinal", "estado_uf", "municipio_nome")
            .agg(F.count("id_notificacao").alias("total_casos")))


def frequent_symptoms(t: dict[str, DataFrame]) -> DataFrame:
    """V3: (state, municipality, symptom) -> occurrences among confirmed cases.

    The two big tables are joined first, on the notification id both are
    bucketed by (no exchange); the small dimensions come after."""
    fn = (t["fato_notificacoes"].filter(F.col("classificacao_final") == labels.CONFIRMED)
          .select("id_notificacao", "fk_localidade_residencia"))
    fns = t["fato_notificacao_sintoma"].select("fk_notificacao", "fk_sintoma")
    dl = t["dim_localidades"].select("id_localidade", "estado_uf", "municipio_nome")
    ds = t["dim_sintomas"].select("id_sintoma", "nome_sintoma")
    j = (fn.join(fns, fn.id_notificacao == fns.fk_notificacao)
         .join(dl, fn.fk_localidade_residencia == dl.id_localidade)
         .join(ds, fns.fk_sintoma == ds.id_sintoma))
    return (j.groupBy("estado_uf", "municipio_nome", "nome_sintoma")
            .agg(F.count("fk_notificacao").alias("total_ocorrencias")))


def age_band(age: F.Column) -> F.Column:
    """The age-band CASE (NULL and negatives fall to "not informed")."""
    expr = None
    for label, low, high in labels.AGE_BANDS:
        if low is None:
            cond = age < high + 1
        elif high is None:
            cond = age >= low
        else:
            cond = age.between(low, high)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(labels.AGE_UNKNOWN))


def epidemiological_profile(t: dict[str, DataFrame]) -> DataFrame:
    """V4: (municipality, state, code, sex, age band, race, class) -> cases,
    confirmed, deaths."""
    j = _fact_place(t, ["id_notificacao", "sexo", "idade", "classificacao_final", "fk_raca_cor", "fk_evolucao_caso"],
                    ["municipio_nome", "estado_uf", "codigo_ibge_municipio"])
    drc = t["dim_raca_cor"].select("id_raca_cor", "descricao_raca_cor")
    de = t["dim_evolucao_caso"].select("id_evolucao", "descricao_evolucao")
    j = (j.join(drc, j.fk_raca_cor == drc.id_raca_cor, "left")
         .join(de, j.fk_evolucao_caso == de.id_evolucao, "left"))
    return (j.withColumn("faixa_etaria", age_band(F.col("idade")))
            .groupBy("municipio_nome", "estado_uf", "codigo_ibge_municipio", "sexo", "faixa_etaria",
                     "descricao_raca_cor", "classificacao_final")
            .agg(F.count("id_notificacao").alias("total_casos"),
                 _count_if(F.col("classificacao_final") == labels.CONFIRMED).alias("casos_confirmados"),
                 _count_if(F.col("descricao_evolucao") == labels.DEATH).alias("obitos")))


def laboratory_analysis(t: dict[str, DataFrame]) -> DataFrame:
    """V5: (state, municipality, test type, maker, source 1) -> tests."""
    ftr = t["fato_testes_realizados"].select("fk_notificacao", "fk_tipo_teste", "fk_fabricante")
    fn = t["fato_notificacoes"].select("id_notificacao", "fk_localidade_residencia")
    dl = t["dim_localidades"].select("id_localidade", "estado_uf", "municipio_nome")
    dt = t["dim_tipos_testes"].select("id_tipo_teste", "descricao_tipo_teste")
    dfab = t["dim_fabricantes"].select("id_fabricante", "nome_fabricante")
    j = (ftr.join(fn, ftr.fk_notificacao == fn.id_notificacao)
         .join(dl, fn.fk_localidade_residencia == dl.id_localidade)
         .join(dt, ftr.fk_tipo_teste == dt.id_tipo_teste, "left")
         .join(dfab, ftr.fk_fabricante == dfab.id_fabricante, "left"))
    return (j.select("estado_uf", "municipio_nome",
                     F.coalesce("descricao_tipo_teste", F.lit(labels.TEST_TYPE_FALLBACK)).alias("tipo_teste"),
                     F.coalesce("nome_fabricante", F.lit(labels.MAKER_FALLBACK)).alias("fabricante"),
                     F.lit(labels.LAB_SOURCE_ID).alias("source_id"))
            .groupBy("estado_uf", "municipio_nome", "tipo_teste", "fabricante", "source_id")
            .agg(F.count(F.lit(1)).alias("total_testes")))


def positivity_rate(t: dict[str, DataFrame]) -> DataFrame:
    """V6: (locality, collection day) -> tests, positives, rate in percent
    (NUMERIC(5,2)).  Declared by the warehouse but filled by nothing in the
    source system; here "positive" = result code 1 of that test slot, and only
    tests with a collection day and a known residence count."""
    ftr = (t["fato_testes_realizados"].filter(F.col("data_coleta").isNotNull())
           .select("fk_notificacao", "data_coleta", "fk_resultado_teste"))
    fn = t["fato_notificacoes"].select("id_notificacao", "fk_localidade_residencia")
    j = ftr.join(fn, ftr.fk_notificacao == fn.id_notificacao).filter(F.col("fk_localidade_residencia").isNotNull())
    agg = (j.groupBy(F.col("fk_localidade_residencia").alias("fk_localidade"),
                     F.col("data_coleta").alias("data_referencia"))
           .agg(F.count(F.lit(1)).alias("total_testes"),
                _count_if(F.col("fk_resultado_teste") == labels.POSITIVE_RESULT_CODE).alias("total_positivos")))
    rate = F.round(F.lit(100.0) * F.col("total_positivos") / F.col("total_testes"), 2).cast("decimal(5,2)")
    return agg.select("fk_localidade", "data_referencia", rate.alias("taxa_positividade"),
                      F.col("total_testes").cast("int").alias("total_testes"),
                      F.col("total_positivos").cast("int").alias("total_positivos"))


def indicator_table(t: dict[str, DataFrame]) -> DataFrame:
    """V6 as the stored table: ``id_indicador`` numbers localities and days in
    order."""
    from ..operators.ids import dense_index

    rate = positivity_rate(t)
    numbered = dense_index(rate, ["fk_localidade", "data_referencia"], "id_indicador")
    return numbered.select(F.col("id_indicador").cast("int").alias("id_indicador"), *rate.columns)


VIEWS = {
    "vw_casos_por_municipio": cases_by_municipality,
    "vw_vacinacao_por_resultado": vaccination_by_result,
    "vw_sintomas_frequentes": frequent_symptoms,
    "vw_perfil_epidemiologico": epidemiological_profile,
    "vw_analise_laboratorial": laboratory_analysis,
}


def register_views(t: dict[str, DataFrame]) -> None:
    """Expose the five views as temp views, for ``spark.sql`` readers."""
    for name, fn in VIEWS.items():
        fn(t).createOrReplaceTempView(name)
