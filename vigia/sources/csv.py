"""Raw notification files.

* S1: CSV with header, quoted text, all columns read as text under a declared
  schema (no inference pass).  ``multi_line`` handles quoted newlines but makes
  files unsplittable, so it is off by default.
* S2: the null tokens a pandas read treats as missing become NULL.
* S3: six listed columns are dropped (absent ones ignored).
* S4: every column whose lower-cased name contains ``data`` becomes a
  timestamp (day-first or ISO, or the formats given); other columns get their
  declared logical type, whole numbers also when written with a decimal part
  ("1501402.0").  A malformed value becomes NULL, never an error, and is
  counted by ``typing_failures``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import labels
from ..functions.dates import to_day_first_timestamp
from ..functions.text import null_tokens as _null_tokens
from ..session import compiled_methods

# Declared logical types of the raw notification columns the warehouse uses
# (everything else stays text).
NUMERIC_COLUMNS = {
    "id_notificacao": "bigint",
    "codigoResultadoTeste1": "bigint", "codigoResultadoTeste2": "bigint",
    "codigoResultadoTeste3": "bigint", "codigoResultadoTeste4": "bigint",
    "idade": "double",
    "municipioIBGE": "bigint", "municipioNotificacaoIBGE": "bigint",
    "codigoRecebeuVacina": "bigint", "codigoEstrategiaCovid": "bigint",
    **{f"{m}{i}": "bigint" for i in range(1, 5)
       for m in ("codigoEstadoTeste", "codigoTipoTeste", "codigoFabricanteTeste")},
}


def text_schema(columns: list[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def read_csv(spark: SparkSession, paths: str | list[str], columns: list[str] | None = None,
             multi_line: bool = False) -> DataFrame:
    """All-text read.  With ``columns`` the schema is declared; without it
    only the header line is read for names (still no type inference)."""
    reader = (spark.read.option("header", True).option("quote", '"').option("escape", '"')
              .option("multiLine", multi_line).option("mode", "PERMISSIVE"))
    if columns:
        reader = reader.schema(text_schema(columns))
    else:
        reader = reader.option("inferSchema", False)
    return reader.csv(paths)


def null_tokens(df: DataFrame, tokens: list[str] = labels.NULL_TOKENS) -> DataFrame:
    """One projection over every text column."""
    return df.withColumns({f.name: _null_tokens(F.col(f.name), tokens)
                           for f in df.schema.fields if isinstance(f.dataType, StringType)})


def date_columns(df: DataFrame) -> list[str]:
    """Columns typed as dates by the name rule."""
    return [c for c in df.columns if "data" in c.lower()]


def parse_dates(df: DataFrame, formats: list[str] | None = None) -> DataFrame:
    """Name-driven day-first timestamp typing."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: to_day_first_timestamp(F.col(c), types[c], formats) for c in date_columns(df)})


def typed_number(c, kind: str):
    """Text as a declared numeric type.  Whole-number types also take an
    integral decimal ("1501402.0", "2.", "1e3"); "1.5" becomes NULL.  Plain
    digits, most of all cells, need no decimal."""
    if kind == "double":
        return c.try_cast(kind)
    exact = c.try_cast("decimal(38,10)")
    return F.when(c.rlike(r"^-?[0-9]{1,18}\z"), c.try_cast(kind)).when(exact % 1 == 0, exact.try_cast(kind))


def type_columns(df: DataFrame, numeric: dict[str, str] = NUMERIC_COLUMNS) -> DataFrame:
    """Declared numeric types (bad text -> NULL)."""
    types = dict(df.dtypes)
    return df.withColumns({c: typed_number(F.col(c), t) if types[c] == "string" else F.col(c).try_cast(t)
                           for c, t in numeric.items() if c in df.columns})


def typing_failures(text: DataFrame, formats: list[str] | None = None,
                    numeric: dict[str, str] = NUMERIC_COLUMNS) -> DataFrame:
    """(column, cells, failed) of every typed column of an all-text frame (S1,
    S2): non-empty cells, and those of them that typing turns into NULL.  One
    scan and one row per column."""
    checks = {c: F.col(c).isNotNull() & to_day_first_timestamp(F.col(c), StringType(), formats).isNull()
              for c in date_columns(text)}
    checks |= {c: F.col(c).isNotNull() & typed_number(F.col(c), t).isNull()
               for c, t in numeric.items() if c in text.columns}
    if not checks:
        return text.sparkSession.createDataFrame([], "column string, cells long, failed long")
    names = list(checks)
    sums = text.agg(*[F.count(c).alias(f"cells_{i}") for i, c in enumerate(names)],
                    *[F.count_if(checks[c]).alias(f"failed_{i}") for i, c in enumerate(names)])
    return sums.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"cells_{i}").alias("cells"), F.col(f"failed_{i}").alias("failed"))
        for i, c in enumerate(names)])))


# Columns without which a notification is lost from the warehouse.
REQUIRED_COLUMNS = ["dataNotificacao", "municipioIBGE"]


class TypingError(ValueError):
    pass


def check_typing(text: DataFrame, formats: list[str] | None = None,
                 required: list[str] = REQUIRED_COLUMNS) -> list[tuple[str, int, int]]:
    """(column, cells, failed) where cells failed; raises if a required column
    is among them."""
    failed = [(r["column"], r["cells"], r["failed"]) for r in
              typing_failures(text, formats).where("failed > 0").collect()]  # one row per column
    lost = [f for f in failed if f[0] in required]
    if lost:
        raise TypingError("cells of required columns can't be typed (column, cells, failed): " + str(lost))
    return failed


# Spellings of a true "excluded" flag.
TRUE_TOKENS = ["true", "1", "sim", "s", "yes"]


def active_rows(df: DataFrame, flag: str = "excluido") -> DataFrame:
    """Rows not flagged as excluded (NULL or any non-true spelling is active)."""
    if flag not in df.columns:
        return df
    truthy = F.lower(F.trim(F.col(flag).cast("string"))).isin(TRUE_TOKENS)
    return df.filter(~F.coalesce(truthy, F.lit(False)))


def read_notifications(spark: SparkSession, paths: str | list[str], columns: list[str] | None = None,
                       multi_line: bool = False, with_row_id: bool = True, active_only: bool = False,
                       date_formats: list[str] | None = None, keep_file_id: bool = True,
                       check: bool = False) -> DataFrame:
    """S1-S5 chained: read, null tokens, dense file-order id (assigned before
    any filter), optional active-row filter, drop, typing.

    ``active_only`` keeps only rows whose ``excluido`` flag is not true.  The
    source system drops the flag column *without* filtering (the default
    here); its documentation says only active rows were processed."""
    from .row_ids import with_file_row_id

    compiled_methods(spark)
    df = read_csv(spark, paths, columns, multi_line)
    df = null_tokens(df)
    if check:
        check_typing(df, date_formats)
    if with_row_id and not (keep_file_id and "id_notificacao" in df.columns):
        df = with_file_row_id(df, "id_notificacao")
    if active_only:
        df = active_rows(df)
    df = df.drop(*labels.DROPPED_COLUMNS)
    return type_columns(parse_dates(df, date_formats))


def write_csv(df: DataFrame, path: str, order_by: str | None = None, date_format: str = "d/M/yyyy",
              files: int | None = None, drop_order_column: bool = False) -> None:
    """Write a frame as header CSV, day-first dates, values kept byte for byte
    (no white-space trimming), in ``order_by`` order across files when given
    (range-partitioned: file i holds the i-th key range, sorted)."""
    out = df
    if order_by:
        n = files or max(1, df.sparkSession.sparkContext.defaultParallelism)
        out = df.repartitionByRange(n, order_by).sortWithinPartitions(order_by)
        if drop_order_column:
            out = out.drop(order_by)
    (out.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"')
     .option("dateFormat", date_format).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
