"""Dimensions.

Deduplication is a ``groupBy`` with a map-side partial aggregate, so the
shuffle carries one row per distinct value per partition, however skewed the
values are.  Numbering uses ``dense_index`` (no one-partition window).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ShortType, StringType, StructField, StructType

from .. import labels
from .ids import dense_index, packed_order
from .reshape import explode_multivalue


# Bits for the position of an item inside one multi-valued cell.
POS_BITS = 20


def narrow_id(c: Column, dtype: str) -> Column:
    """Cast a dense id to the declared narrow type, or raise when it does not
    fit (never a silent wrap, whatever the session's ANSI setting)."""
    limit = {"smallint": 32767, "int": 2147483647}[dtype]
    return (F.when(c <= limit, c.cast(dtype))
            .when(c.isNull(), F.raise_error(F.lit("dimension id is NULL")).cast(dtype))
            .otherwise(F.raise_error(F.lit(f"dimension id does not fit {dtype}")).cast(dtype)))


def first_key(order_cols: list[str]) -> Column:
    """One bigint ordering rows like ``order_cols``: the id alone, or
    (id, position in cell) packed."""
    if len(order_cols) == 1:
        return F.col(order_cols[0]).cast("bigint")
    if len(order_cols) == 2:
        return packed_order(F.col(order_cols[0]), F.col(order_cols[1]), POS_BITS)
    raise ValueError("first appearance is ordered by (id) or (id, position)")


def first_appearance_dim(df: DataFrame, value_col: str, order_cols: list[str], id_name: str,
                         value_name: str) -> DataFrame:
    """Distinct non-NULL values numbered 1..n by first appearance in
    ``order_cols`` (which must identify a row).  The first appearance is a
    ``min`` over one bigint: hash aggregation with a map-side partial."""
    first = (df.filter(F.col(value_col).isNotNull())
             .groupBy(value_col)
             .agg(F.min(first_key(order_cols)).alias("_first")))
    numbered = dense_index(first.select(F.col(value_col).alias(value_name), "_first"), ["_first"], id_name)
    return numbered.select(narrow_id(F.col(id_name), "smallint").alias(id_name), value_name)


def extend_dimension(previous: DataFrame, values: DataFrame, value_name: str, id_name: str,
                     order_cols: list[str]) -> DataFrame:
    """D8, stable-key mode: values already in ``previous`` keep their ids;
    new values get ``max(previous id) + 1 ..`` in first-appearance order.

    ``values`` holds one row per occurrence with ``value_name`` and the
    ``order_cols``.  The previous dimension is small (size-checked broadcast);
    new values are numbered with ``dense_index``."""
    from ..functions.joins import sized_broadcast

    prev = previous.select(F.col(value_name).alias("_pv"), F.col(id_name).alias("_pid"))
    top = previous.select(F.coalesce(F.max(id_name), F.lit(0)).cast("bigint")).scalar()
    first = (values.filter(F.col(value_name).isNotNull()).groupBy(value_name)
             .agg(F.min(first_key(order_cols)).alias("_first")))
    new = first.join(sized_broadcast(prev), F.col(value_name) == F.col("_pv"), "left_anti")
    numbered = dense_index(new.select(value_name, "_first"), ["_first"], "_rank")
    added = numbered.select((top + F.col("_rank")).alias(id_name), value_name)
    kept = previous.select(F.col(id_name).cast("bigint").alias(id_name), value_name)
    dtype = previous.schema[id_name].dataType.simpleString()
    fitted = F.col(id_name) if dtype == "bigint" else narrow_id(F.col(id_name), dtype)
    return kept.unionByName(added).select(fitted.alias(id_name), value_name)


def surrogate_key(df: DataFrame, value_col: str, order_col: str, id_name: str = "id") -> DataFrame:
    """D8 on any table: distinct ``value_col`` numbered by the smallest
    ``order_col`` each value appears with (``order_col`` unique per row)."""
    first = (df.filter(F.col(value_col).isNotNull())
             .groupBy(value_col).agg(F.min(order_col).alias("_first")))
    return dense_index(first, ["_first"], id_name).select(id_name, value_col, F.col("_first").alias("first_" + order_col))


def dim_symptoms(clean: DataFrame) -> DataFrame:
    """Symptom names numbered in (notification id, position) order."""
    ex = explode_multivalue(clean, "sintomas", "nome_sintoma", keep_position=True)
    return first_appearance_dim(ex, "nome_sintoma", ["id_notificacao", "pos"], "id_sintoma", "nome_sintoma")


def dim_conditions(clean: DataFrame) -> DataFrame:
    """Same for conditions."""
    ex = explode_multivalue(clean, "condicoes", "nome_condicao", keep_position=True)
    return first_appearance_dim(ex, "nome_condicao", ["id_notificacao", "pos"], "id_condicao", "nome_condicao")


def dim_race(clean: DataFrame) -> DataFrame:
    """D6."""
    return first_appearance_dim(clean, "racaCor", ["id_notificacao"], "id_raca_cor", "descricao_raca_cor")


def dim_outcome(clean: DataFrame) -> DataFrame:
    """D7."""
    return first_appearance_dim(clean, "evolucaoCaso", ["id_notificacao"], "id_evolucao", "descricao_evolucao")


def locality_rows(clean: DataFrame) -> DataFrame:
    """Residence and notification place columns stacked under one schema,
    residence first (``_src`` 0/1), with the row id kept as tie-breaker."""
    def group(cols: list[str], src: int) -> DataFrame:
        return clean.select(
            *[F.col(a).alias(b) for a, b in zip(cols, labels.PLACE_COLUMNS)],
            F.lit(src).alias("_src"), F.col("id_notificacao").alias("_row"))
    return group(labels.RESIDENCE_PLACE, 0).unionByName(group(labels.NOTIFICATION_PLACE, 1))


def keep_first(df: DataFrame, key: str | list[str], order: list[str], keep: list[str]) -> DataFrame:
    """One row per key, the first in ``order``, keeping that row's values
    even when they are NULL (``min_by`` over a struct; ``first(ignorenulls)``
    or ``dropDuplicates`` would not).  Any order columns; sort-based
    aggregation.  ``keep_first_by`` is the hash-aggregated form for a single
    bigint order."""
    keys = [key] if isinstance(key, str) else list(key)
    return (df.groupBy(*keys)
            .agg(F.min_by(F.struct(*keep), F.struct(*order)).alias("_v"),
                 F.min(F.struct(*order)).alias("_first"))
            .select(*keys, *[F.col(f"_v.{c}").alias(c) for c in keep],
                    *[F.col(f"_first.{c}").alias(c) for c in order]))


def keep_first_by(df: DataFrame, key: str, order: Column, keep: list[str]) -> DataFrame:
    """D2 for a single bigint ``order`` unique per row: (1) ``min(order)`` per
    key, a hash aggregate with a map-side partial; (2) the rows holding those
    minima, picked with a join on (key, order) against the one-row-per-key
    table (broadcast after a size check).  Two linear passes and no sort of the
    input, where a struct-valued ``min_by`` would sort it.  Rows without a key
    are a group of their own, as in ``keep_first``."""
    from ..functions.joins import sized_broadcast

    ordered = df.withColumn("_ord", order)
    firsts = ordered.groupBy(key).agg(F.min("_ord").alias("_min")).withColumnRenamed(key, "_k")
    picked = ordered.join(sized_broadcast(firsts, materialize=True),
                          F.col(key).eqNullSafe(F.col("_k")) & (F.col("_ord") == F.col("_min")), "left_semi")
    return picked.select(key, *keep, "_ord")


def state_code(code_col) -> F.Column:
    """D3: first two digits of the municipality code, as an integer."""
    return F.substring(code_col.cast("string"), 1, 2).try_cast("int")


def dim_localities(clean: DataFrame) -> DataFrame:
    """D1-D3 + D8: the locality dimension."""
    rows = locality_rows(clean).withColumn(
        "codigo_ibge_municipio", F.col("codigo_ibge_municipio").try_cast("int"))
    rows = rows.filter(F.col("codigo_ibge_municipio").isNotNull())
    # residence rows (0) before notification rows (1), then by row id
    first = keep_first_by(rows, "codigo_ibge_municipio", packed_order(F.col("_src"), F.col("_row"), 62),
                          ["estado_nome", "estado_uf", "municipio_nome"])
    numbered = dense_index(first, ["_ord"], "id_localidade")
    return numbered.select(
        narrow_id(F.col("id_localidade"), "int").alias("id_localidade"), "estado_uf", "estado_nome",
        state_code(F.col("codigo_ibge_municipio")).alias("codigo_ibge_estado"),
        "municipio_nome", "codigo_ibge_municipio")


def extend_localities(previous: DataFrame, clean: DataFrame) -> DataFrame:
    """D1-D3 + D8, stable-key mode: known municipality codes keep their row;
    new ones are numbered after the largest id, by first appearance in
    ``clean`` (residence rows before notification rows)."""
    from ..functions.joins import sized_broadcast

    known = previous.select(F.col("codigo_ibge_municipio").alias("_known"))
    top = previous.select(F.coalesce(F.max("id_localidade"), F.lit(0)).cast("bigint")).scalar()
    fresh = dim_localities(clean).join(sized_broadcast(known), F.col("codigo_ibge_municipio") == F.col("_known"), "left_anti")
    # the ids of the load alone are in the right order: renumbered densely after the known ones
    numbered = dense_index(fresh.withColumnRenamed("id_localidade", "_first"), ["_first"], "_rank")
    added = numbered.withColumn("id_localidade", narrow_id(top + F.col("_rank"), "int"))
    return previous.unionByName(added.select(*previous.columns))


TEST_TYPE_SCHEMA = StructType([StructField("id_tipo_teste", ShortType(), False),
                               StructField("descricao_tipo_teste", StringType(), False)])
MAKER_SCHEMA = StructType([StructField("id_fabricante", ShortType(), False),
                           StructField("nome_fabricante", StringType(), False)])


def seed_dimension(spark: SparkSession, schema: StructType, seed: DataFrame | str | None = None) -> DataFrame:
    """Test-type / manufacturer dimensions are declared but never loaded by
    the source system's ETL.  A seed (frame or Parquet path) fills one, with the
    declared types; without it the dimension is empty and views fall back to
    their default labels."""
    if seed is None:
        return spark.createDataFrame([], schema)
    df = spark.read.parquet(seed) if isinstance(seed, str) else seed
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
