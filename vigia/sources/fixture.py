"""Raw notification records derived from the order tables.

The source system reads one wide CSV of notifications.  No such file ships
with the benchmark data, so this module derives an equivalent wide record from
``orders``, ``customer``, ``nation`` and ``region`` with deterministic rules
(one notification per order).  Every rule below is a column expression, so the
derivation is one scan of ``orders`` joined to ``customer`` and to the
25-row place table; its size grows with the order table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.joins import sized_broadcast
from .tables import fact_table, table


def _null_if(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None)).otherwise(value)


def _days(n: Column) -> Column:
    return F.date_add(F.col("d"), n.cast("int"))


def _items(*pairs: tuple[Column, str]) -> Column:
    """``', '``-joined list of the labels whose condition holds, NULL if none."""
    joined = F.concat_ws(", ", *[F.when(c, F.lit(v)) for c, v in pairs])
    return F.when(joined != "", joined)


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation x region (one row per nation), broadcast after a size check."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return sized_broadcast(n.join(r, n.n_regionkey == r.r_regionkey)
                           .select("n_nationkey", "n_name", "n_regionkey", "r_name"), 10_000)


def _as(places: DataFrame, prefix: str) -> DataFrame:
    return places.select(
        F.col("n_nationkey").alias(f"{prefix}_key"),
        F.col("n_name").alias(f"{prefix}_nation"),
        F.col("n_regionkey").alias(f"{prefix}_regionkey"),
        F.col("r_name").alias(f"{prefix}_region"),
    )


def raw_notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide raw record, 50 columns, ``id_notificacao`` = order key + 1."""
    K, CK, D = F.col("o_orderkey"), F.col("o_custkey"), F.col("d")
    o = fact_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    base = (o.join(c, o.o_custkey == c.c_custkey)
            .withColumn("d", F.to_date("o_orderdate"))
            .withColumn("n2_key", ((K + 5) % 25).cast("int")))
    places = _places(spark, sf_dir)
    base = base.join(_as(places, "n1"), F.col("c_nationkey") == F.col("n1_key"))
    base = base.join(_as(places, "n2"), "n2_key")

    def code(prefix: str) -> Column:
        return (F.lit(11) + F.col(f"{prefix}_regionkey")).cast("bigint") * 100000 + F.col(f"{prefix}_key")

    cols = [
        (K + 1).alias("id_notificacao"),
        _null_if((K % 1000).isin(7, 8), D).alias("dataNotificacao"),
        _null_if(K % 5 == 0, _days(K % 7 - 4)).alias("dataInicioSintomas"),
        _null_if(K % 3 == 0, _days(K % 11 - 2)).alias("dataEncerramento"),
        F.when(F.col("o_orderstatus") == "F", F.lit("Confirmado Laboratorial"))
         .when(F.col("o_orderstatus") == "O", F.lit("Descartado")).alias("classificacaoFinal"),
        _null_if(K % 4 == 0, K % 4).alias("codigoResultadoTeste1"),
        _null_if((K + 1) % 4 == 0, (K + 1) % 4).alias("codigoResultadoTeste2"),
        _null_if(K % 13 == 0, ((CK * 7 + K) % 95).cast("double")).alias("idade"),
        _null_if(K % 17 == 0, F.when(K % 2 == 0, F.lit("Feminino")).otherwise(F.lit("Masculino"))).alias("sexo"),
        _null_if(K % 10 == 9, F.col("c_mktsegment")).alias("racaCor"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("Óbito"))
         .when(F.col("o_orderpriority") == "2-HIGH", F.lit("Cura"))
         .when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("Internado"))
         .when(F.col("o_orderpriority") == "5-LOW", F.lit("Em tratamento domiciliar")).alias("evolucaoCaso"),
        F.col("n1_region").alias("estado"),
        F.substring("n1_region", 1, 2).alias("estadoIBGE"),
        F.col("n1_nation").alias("municipio"),
        _null_if(K % 50 == 0, code("n1")).alias("municipioIBGE"),
        F.col("n2_region").alias("estadoNotificacao"),
        F.substring("n2_region", 1, 2).alias("estadoNotificacaoIBGE"),
        F.concat(F.col("n2_nation"), F.lit(" (N)")).alias("municipioNotificacao"),
        code("n2").alias("municipioNotificacaoIBGE"),
        _items((K % 2 == 0, "Febre"), (K % 3 == 0, " Tosse "), (K % 5 < 2, "Coriza"),
               (K % 6 == 0, "Febre"), (K % 7 == 3, "Dispneia")).alias("sintomas"),
        _items((K % 4 == 1, "Diabetes"), (K % 9 == 2, "Obesidade"), (K % 25 == 0, "Gestante")).alias("condicoes"),
        _null_if(K % 3 == 2, K % 3 + 1).alias("codigoRecebeuVacina"),
        F.when(K % 5 == 1, F.lit("")).when(K % 5 == 2, F.lit("1")).when(K % 5 == 3, F.lit("1,2"))
         .when(K % 5 == 4, F.lit("1,2,Reforço")).alias("codigoDosesVacina"),
        F.when(K % 4 == 0, F.lit("Sim")).when(K % 4 == 1, F.lit("Não"))
         .when(K % 4 == 2, F.lit("Ignorado")).alias("profissionalSaude"),
        F.when(K % 4 == 3, F.lit("Sim")).when(K % 4 == 1, F.lit("Não"))
         .when(K % 4 == 2, F.lit("Ignorado")).alias("profissionalSeguranca"),
        F.when(K % 8 == 0, F.concat((F.lit(2200) + K % 50).cast("string"), F.lit(" - Ocupação"))).alias("cbo"),
        _null_if(K % 6 == 5, K % 4).alias("codigoEstrategiaCovid"),
        _null_if(K % 7 == 0, F.concat(F.lit("LAB"), (K % 5).cast("string"))).alias("codigoLaboratorioPrimeiraDose"),
        _null_if(K % 5 < 2, F.date_sub(D, 200)).alias("dataPrimeiraDose"),
        _null_if(K % 5 < 3, F.date_sub(D, 100)).alias("dataSegundaDose"),
    ]
    for i in range(1, 5):
        cols += [
            _null_if((K + i) % 3 == 0, (K * i) % 5).alias(f"codigoEstadoTeste{i}"),
            _null_if((K + i) % 6 < 3, (K + i) % 4).alias(f"codigoTipoTeste{i}"),
            _null_if(K % 2 == 0, (K + i) % 9).alias(f"codigoFabricanteTeste{i}"),
            _null_if((K + i) % 4 == 0, F.date_add(D, i)).alias(f"dataColetaTeste{i}"),
        ]
    cols += [
        F.concat(F.lit("src-"), (K % 3).cast("string")).alias("source_id"),
        (K % 20 == 0).alias("excluido"),
        (K % 2 == 0).alias("validado"),
        F.when(K % 30 == 0, F.lit("Unidade de saude")).alias("outroLocalRealizacaoTestagem"),
    ]
    return base.select(*cols)
