"""Tables in the columns and types that the warehouse schema declares.

The working tables keep wide integers, so that the load gate can list values
that don't fit.  ``as_declared`` is the narrow projection into the declared
schema: every column, in order, in its declared type.  A value that doesn't
fit, or a NULL where none may be, raises and names the column: nothing wraps,
is cut or becomes NULL.  No shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import labels
from .quality import NOT_NULL

# Declared columns and types.
DECLARED = {
    "dim_localidades": "id_localidade INT, estado_uf VARCHAR(2), estado_nome VARCHAR(50), codigo_ibge_estado INT, "
                       "municipio_nome VARCHAR(100), codigo_ibge_municipio INT",
    "dim_condicoes": "id_condicao SMALLINT, nome_condicao VARCHAR(100)",
    "dim_evolucao_caso": "id_evolucao SMALLINT, descricao_evolucao VARCHAR(50)",
    "dim_raca_cor": "id_raca_cor SMALLINT, descricao_raca_cor VARCHAR(50)",
    "dim_sintomas": "id_sintoma SMALLINT, nome_sintoma VARCHAR(100)",
    "dim_tipos_testes": "id_tipo_teste SMALLINT, descricao_tipo_teste VARCHAR(100)",
    "dim_fabricantes": "id_fabricante SMALLINT, nome_fabricante VARCHAR(100)",
    "fato_notificacoes": "id_notificacao BIGINT, sexo VARCHAR(20), idade INT, profissional_saude BOOLEAN, "
                         "profissional_seguranca BOOLEAN, codigo_cbo VARCHAR(255), fk_raca_cor SMALLINT, "
                         "fk_localidade_residencia INT, fk_localidade_notificacao INT, fk_evolucao_caso SMALLINT, "
                         "data_notificacao DATE, data_inicio_sintomas DATE, data_encerramento DATE, "
                         "classificacao_final VARCHAR(50), codigo_recebeu_vacina SMALLINT, "
                         "codigo_doses_vacina VARCHAR(100), data_primeira_dose DATE, data_segunda_dose DATE, "
                         "nome_fabricante_vacina VARCHAR(255), codigo_estrategia_covid INT",
    "fato_notificacao_sintoma": "fk_notificacao BIGINT, fk_sintoma SMALLINT",
    "fato_notificacao_condicao": "fk_notificacao BIGINT, fk_condicao SMALLINT",
    "fato_testes_realizados": "id_registro BIGINT, fk_notificacao BIGINT, data_coleta DATE, data_resultado DATE, "
                              "codigo_estado_teste SMALLINT, fk_tipo_teste SMALLINT, fk_fabricante SMALLINT, "
                              "fk_resultado_teste SMALLINT",
    "indicadores_municipais": "id_indicador INT, fk_localidade INT, data_referencia DATE, "
                              "taxa_positividade NUMERIC(5,2), total_testes INT, total_positivos INT",
}
# Bits below the sign of the declared integers.
_INTEGERS = {"SMALLINT": 15, "INT": 31, "BIGINT": 63}


def declared_types(table: str) -> dict[str, str]:
    """Column -> declared type, in order."""
    return dict(c.split(" ") for c in DECLARED[table].split(", "))


def _fits(value: Column, declared: str) -> Column:
    """TRUE where a value (not NULL) is one of the declared type."""
    if declared in _INTEGERS:
        bound = 1 << _INTEGERS[declared]
        return (value >= F.lit(-bound)) & (value <= F.lit(bound - 1))
    if declared.startswith("VARCHAR"):
        return F.char_length(value.cast("string")) <= int(declared[8:-1])
    if declared.startswith("NUMERIC"):
        whole, scale = map(int, declared[8:-1].split(","))
        return F.abs(F.round(value.cast(f"decimal({whole + 10},{scale + 4})"), scale)) < 10 ** (whole - scale)
    return F.lit(True)


def test_record_id(fk: Column, number: Column, slots: int = labels.TEST_SLOTS) -> Column:
    """``id_registro`` of a test: unique, in the order of notifications and
    slots, and the same in every version (a sequence has gaps too), so deletes
    and further loads renumber nothing and no shuffle is needed."""
    ok = fk.between(1, (1 << 63) // slots - 1) & number.between(1, slots)
    return F.when(ok, (fk - 1) * slots + number).otherwise(
        F.raise_error(F.lit("id_registro: notification or test number out of range")))


def as_declared(df: DataFrame, table: str) -> DataFrame:
    """``df`` as the declared ``table``.  Columns it lacks are NULL
    (``data_resultado`` has no source; a missing NOT NULL column raises on its
    first row); ``id_registro`` of a test is made from its notification and
    slot; other columns go.  An empty table gives the empty declared table."""
    required = set(NOT_NULL.get(table, ([], []))[1])
    out = []
    for name, declared in declared_types(table).items():
        spark_type = "string" if declared.startswith("VARCHAR") else declared.replace("NUMERIC", "DECIMAL").lower()
        if name in df.columns:
            value = F.col(f"`{name}`")
        elif name == "id_registro":
            value = test_record_id(F.col("fk_notificacao").cast("bigint"), F.col("test_number").cast("bigint"))
        else:
            value = F.lit(None).cast(spark_type)
        shown = F.concat(F.lit(f"{table}.{name}: does not fit {declared}: "), value.cast("string"))
        typed = F.when(value.isNull() | _fits(value, declared), value.cast(spark_type)).otherwise(F.raise_error(shown))
        if name in required:
            typed = F.when(value.isNotNull(), typed).otherwise(F.raise_error(F.lit(f"{table}.{name}: NULL")))
        out.append(typed.alias(name))
    return df.select(*out)


def misfits(df: DataFrame, table: str) -> DataFrame:
    """How many values of each declared column would make ``as_declared`` raise
    (columns without any are left out): one scan, a partial count a task."""
    required = set(NOT_NULL.get(table, ([], []))[1])
    sums = []
    for name, declared in declared_types(table).items():
        if name in df.columns:
            value = F.col(f"`{name}`")
            broken = ~_fits(value, declared)
            if name in required:
                broken = value.isNull() | broken
            sums.append(F.struct(F.lit(name).alias("column_name"),
                                 F.sum(F.when(broken, 1).otherwise(0)).cast("bigint").alias("misfits")))
    return df.agg(F.array(*sums).alias("s")).select(F.inline("s")).filter("misfits > 0")


def write_declared(tables: dict[str, DataFrame], path: str) -> dict[str, int]:
    """Write every declared table that ``tables`` holds as Parquet below
    ``path`` and return the rows of each.  Only scans and projections: a
    bucketed table is written by the tasks that read it.  A value that doesn't
    fit raises; an existing ``path`` is not written over."""
    from pyspark.sql import Observation

    typed = {n: as_declared(tables[n], n) for n in DECLARED if n in tables}
    rows = {}
    for name, df in typed.items():
        seen = Observation(f"declared_{name}")
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("error").parquet(f"{path.rstrip('/')}/{name}")
        rows[name] = int(seen.get["n"])
    return rows
