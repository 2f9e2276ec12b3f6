"""Multi-valued cells and repeated column groups."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import labels
from ..functions.text import split_literal, strip


def explode_multivalue(df: DataFrame, column: str, value_name: str, id_col: str = "id_notificacao",
                       sep: str = labels.MULTI_SEPARATOR, keep_position: bool = False) -> DataFrame:
    """One row per (id, stripped item) of a separator-joined cell.

    NULL cells give no rows; empty items survive (``"a, b, "`` gives ``''``);
    repeated items of the same id collapse to one row.  The id travels through
    the explode, so no self-join is needed.  With ``keep_position`` the first
    position of each item is kept (``pos``), which is what first-appearance
    numbering of the dimension needs.

    The de-duplication is a ``groupBy(id, item)`` whose shuffle key contains
    the row id, so one heavy item can never land all its rows in one task.
    """
    exploded = (df.select(id_col, F.posexplode(split_literal(F.col(column), sep)).alias("pos", "raw"))
                .select(id_col, "pos", strip(F.col("raw")).alias(value_name)))
    if keep_position:
        return exploded.groupBy(id_col, value_name).agg(F.min("pos").alias("pos"))
    return exploded.select(id_col, value_name).distinct()


def wide_columns(df: DataFrame, metrics: list[str], slots: int) -> list[str]:
    """``<metric><slot>`` names that exist, slot-major (as the source orders them)."""
    present = set(df.columns)
    return [f"{m}{i}" for i in range(1, slots + 1) for m in metrics if f"{m}{i}" in present]


_VAR_SPLIT = r"^(.*?)(\d+)$"


def unpivot(df: DataFrame, ids: list[str], values: list[str], variable: str = "test_variable",
            value: str = "test_value") -> DataFrame:
    """R3 + R4: wide -> long (id.., variable, value), NULL values dropped, and
    the variable name split into ``metric_name`` and ``test_number``.

    Values of mixed types are cast to text first (``unpivot`` needs one common
    type).  Narrow: no shuffle."""
    typed = df.select(*ids, *[F.col(v).cast("string").alias(v) for v in values])
    long = typed.unpivot(ids, values, variable, value).filter(F.col(value).isNotNull())
    return long.withColumns({
        "metric_name": F.regexp_extract(F.col(variable), _VAR_SPLIT, 1),
        "test_number": F.regexp_extract(F.col(variable), _VAR_SPLIT, 2).cast("int"),
    })


def pivot_first(long: DataFrame, index: list[str], column: str, value: str, order: list[str] | Column,
                column_values: list[str]) -> DataFrame:
    """Long -> wide, one column per known ``column`` value holding the
    first non-NULL ``value`` in ``order`` (a total order makes "first" exact).

    Written as one aggregation with a conditional ``min_by`` per output column
    (rows of other metrics, or with a NULL value, have a NULL ordering and are
    skipped), so the plan has a single shuffle on ``index`` with a map-side
    partial aggregate.  ``groupBy().pivot()`` would plan two (index + column,
    then index)."""
    order_col = F.struct(*order) if isinstance(order, list) else order
    hit = F.col(value).isNotNull()
    return long.groupBy(*index).agg(*[
        F.min_by(F.col(value), F.when((F.col(column) == F.lit(v)) & hit, order_col)).alias(v)
        for v in column_values])


def _slot_struct(df: DataFrame, slot: int, metrics: list[str], extra: list[str]) -> Column:
    fields = [F.lit(slot).alias("test_number")]
    for m in metrics + extra:
        name = f"{m}{slot}"
        fields.append((F.col(name) if name in df.columns else F.lit(None)).alias(m))
    return F.struct(*fields)


def tests_long(df: DataFrame, id_col: str = "id_notificacao", metrics: list[str] = labels.TEST_METRICS,
               slots: int = labels.TEST_SLOTS, carry: list[str] | None = None) -> DataFrame:
    """One row per test slot that has at least one non-NULL metric.

    Equivalent to melt + drop NULL + split name + pivot-first, because each
    (id, slot, metric) cell occurs exactly once: written as ``inline`` of an
    array of per-slot structs, it stays a narrow projection (no Exchange).
    ``carry`` adds further per-slot columns that do not decide whether the
    slot exists (the result code, used by the positivity table).

    A metric absent from the input for every slot is left out, as a pivot
    would leave it out."""
    carry = carry or []
    present = [m for m in metrics if any(f"{m}{i}" in df.columns for i in range(1, slots + 1))]
    carried = [m for m in carry if any(f"{m}{i}" in df.columns for i in range(1, slots + 1))]
    arr = F.array(*[_slot_struct(df, i, present, carried) for i in range(1, slots + 1)])
    out = df.select(F.col(id_col), F.inline(arr))
    # OR of IS NOT NULL: a COALESCE over mixed types would cast text to numbers.
    keep = reduce(lambda a, b: a | b, [F.col(m).isNotNull() for m in present]) if present else F.lit(False)
    return out.filter(keep)


def test_fact(df: DataFrame, carry_result: bool = True) -> DataFrame:
    """Tests fact in warehouse names: (fk_notificacao, test_number,
    data_coleta, codigo_estado_teste, fk_tipo_teste, fk_fabricante
    [, fk_resultado_teste])."""
    carry = [labels.TEST_RESULT_METRIC] if carry_result else []
    long = tests_long(df, carry=carry)
    renames = {"id_notificacao": "fk_notificacao", **labels.TEST_RENAMES}
    long = long.withColumnsRenamed({k: v for k, v in renames.items() if k in long.columns})
    wanted = ["fk_notificacao", "test_number", "data_coleta", "codigo_estado_teste", "fk_tipo_teste",
              "fk_fabricante", "fk_resultado_teste"]
    out = long.select(*[c for c in wanted if c in long.columns])
    if "data_coleta" in out.columns:
        out = out.withColumn("data_coleta", F.col("data_coleta").cast("date"))
    return out


def variable_slot(name: str) -> tuple[str, int]:
    """Python twin of the name split, for plan-time use."""
    m = re.match(_VAR_SPLIT, name)
    return (m.group(1), int(m.group(2))) if m else (name, 0)
