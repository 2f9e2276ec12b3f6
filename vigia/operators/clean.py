"""Ordered cleaning / imputation rules.

Each rule is a ``DataFrame -> DataFrame`` function; ``clean_notifications``
chains them in the required order.  All are narrow column expressions except
C6 (the exact median), which is one extra aggregate pass over the age column
only, planned as a scalar subquery (no join, no driver round trip).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import labels
from ..functions.dates import minus_one_day
from ..functions.flags import yes_flag

CLASS = "classificacaoFinal"
RESULT1 = "codigoResultadoTeste1"
NOTIF = "dataNotificacao"
ONSET = "dataInicioSintomas"
CLOSE = "dataEncerramento"
AGE = "idade"


def impute_class(df: DataFrame) -> DataFrame:
    """C1 + C2: missing class from lab result 1 (1 -> confirmed, 2 -> discarded),
    then "suspected".  C1 is skipped when the result column is absent."""
    steps = [F.col(CLASS)]
    if RESULT1 in df.columns:
        r = F.col(RESULT1).try_cast("int")
        steps.append(F.when(r == 1, F.lit(labels.CONFIRMED)).when(r == 2, F.lit(labels.DISCARDED)))
    steps.append(F.lit(labels.SUSPECTED))
    return df.withColumn(CLASS, F.coalesce(*steps))


def impute_onset(df: DataFrame) -> DataFrame:
    """Missing onset -> notification minus one day (NULL if that is NULL)."""
    return df.withColumn(ONSET, F.coalesce(F.col(ONSET), minus_one_day(F.col(NOTIF))))


def clamp_onset(df: DataFrame) -> DataFrame:
    """C4: onset after notification -> notification.  A NULL comparison keeps
    the onset as it is (``least`` would skip NULLs instead)."""
    return df.withColumn(ONSET, F.when(F.col(ONSET) > F.col(NOTIF), F.col(NOTIF)).otherwise(F.col(ONSET)))


def null_bad_closure(df: DataFrame) -> DataFrame:
    """Closure before notification -> NULL."""
    return df.withColumn(CLOSE, F.when(F.col(CLOSE) < F.col(NOTIF), F.lit(None)).otherwise(F.col(CLOSE)))


def impute_median(df: DataFrame, column: str = AGE) -> DataFrame:
    """Missing age -> exact median of all rows (taken before any row is
    dropped), then truncated toward zero to an integer.

    ``median`` is exact; its buffer is a value -> count map, which stays small
    for an age column (few distinct values) whatever the row count.  The value
    is computed once as a scalar subquery and inlined, so the main plan keeps
    its partitioning and needs no join.
    """
    med = df.select(F.median(F.col(column).cast("double"))).scalar()
    return df.withColumn(column, F.coalesce(F.col(column).cast("double"), med).cast("int"))


def fill_defaults(df: DataFrame) -> DataFrame:
    """Constant fills for sex, race and outcome."""
    return df.fillna({"sexo": labels.SEX_DEFAULT, "racaCor": labels.RACE_DEFAULT,
                      "evolucaoCaso": labels.OUTCOME_DEFAULT})


def drop_missing_notification(df: DataFrame) -> DataFrame:
    """Rows without notification date are dropped (after C1-C7)."""
    return df.dropna(subset=[NOTIF])


def bool_flags(df: DataFrame, columns=("profissionalSaude", "profissionalSeguranca")) -> DataFrame:
    """C9: "Sim" -> true, everything else (incl. NULL) -> false."""
    return df.withColumns({c: yes_flag(F.col(c)) for c in columns if c in df.columns})


def impute_age_with(df: DataFrame, median, column: str = AGE) -> DataFrame:
    """C6 with a known median (``None`` when every age is missing)."""
    fill = F.lit(median).cast("double")
    return df.withColumn(column, F.coalesce(F.col(column).cast("double"), fill).cast("int"))


# Distinct values of a column that may be sorted on the driver.
MEDIAN_VALUES = 100_000


def exact_median(df: DataFrame, column: str, max_values: int = MEDIAN_VALUES) -> float | None:
    """Exact median of a column (mean of the middle two; None without values).

    The values are counted in one pruned scan (a partial count per value), and
    the counts are stored.  While more than ``max_values`` distinct values are
    left, the range around the median is narrowed by approximate percentiles,
    whose ranks are then counted exactly; the rest is picked on the driver."""
    from ..session import shared_dir

    shared_dir(df.sparkSession)
    counts = (df.select(F.col(column).cast("double").alias("v")).where("v is not null and not isnan(v)")
              .groupBy("v").agg(F.count(F.lit(1)).alias("n")).checkpoint(eager=True))
    total = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("values")).first()
    if not total["n"]:
        return None
    low, high = (total["n"] - 1) // 2, total["n"] // 2
    below, left, values = 0, counts, total["values"]
    while values > max_values:
        a, b = left.agg(F.percentile_approx("v", [0.45, 0.55], 1000).alias("p")).first()["p"]
        cut = left.agg(F.sum(F.when(F.col("v") < a, F.col("n")).otherwise(0)).alias("under"),
                       F.sum(F.when(F.col("v") <= b, F.col("n")).otherwise(0)).alias("upto")).first()
        if below + cut["under"] > low:
            left = left.where(F.col("v") < a)
        elif below + cut["upto"] <= low:
            left, below = left.where(F.col("v") > b), below + cut["upto"]
        elif below + cut["upto"] <= high:
            break  # the middle two lie on both sides of b: settled by the sorted rest
        else:
            left, below = left.where(F.col("v").between(a, b)), below + cut["under"]
        values = left.count()
    if values > max_values:  # the value of rank low is the largest up to b, that of rank high the next one
        first = left.where(F.col("v") <= b).agg(F.max("v")).first()[0]
        second = first if low == high else left.where(F.col("v") > b).agg(F.min("v")).first()[0]
        return (first + second) / 2
    found, rank = [], below
    for r in left.orderBy("v").collect():  # at most max_values rows
        found += [r["v"]] * sum(rank <= k < rank + r["n"] for k in {low, high})
        rank += r["n"]
    return sum(found) / len(found)


def clean_deferring_median(df: DataFrame, observation) -> DataFrame:
    """C1-C5, C7, C8 in one pass, ages as read: apply C6 afterwards with
    ``impute_age_with(df, exact_median(input, AGE))``.  The median is that of
    *every* input row, also of those C8 drops.  Observes, for the log only, the
    rows read and the rows without a date."""
    out = impute_class(df)
    out = impute_onset(out)
    out = clamp_onset(out)
    out = null_bad_closure(out)
    out = fill_defaults(out).withColumn(AGE, F.col(AGE).cast("double"))
    out = out.observe(observation, F.count(F.lit(1)).alias("rows_read"),
                      F.sum(F.when(F.col(NOTIF).isNull(), 1).otherwise(0)).alias("rows_without_date"))
    return drop_missing_notification(out)


def clean_notifications(df: DataFrame, observation=None) -> DataFrame:
    """C1-C8 in the source system's order.

    With a ``pyspark.sql.Observation``, the rows read and the rows dropped by
    C8 are counted while the result is being written (no extra job)."""
    out = impute_class(df)
    out = impute_onset(out)
    out = clamp_onset(out)
    out = null_bad_closure(out)
    out = impute_median(out)
    out = fill_defaults(out)
    if observation is not None:
        out = out.observe(observation, F.count(F.lit(1)).alias("rows_read"),
                          F.sum(F.when(F.col(NOTIF).isNull(), 1).otherwise(0)).alias("rows_without_date"))
    return drop_missing_notification(out)
