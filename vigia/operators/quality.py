"""Integrity rules as data-quality jobs (Q1-Q6).

Parquet tables enforce no NOT NULL / UNIQUE / CHECK / FOREIGN KEY, so each
rule becomes a *violations* frame ``(rule, table_name, key, detail)``:

* NOT NULL and CHECK rules of one table are evaluated in one scan (an array of
  failing rule names per row, exploded),
* UNIQUE is a ``groupBy(key)`` with a map-side partial count, all keys of a
  table in one pass (grouping sets),
* FOREIGN KEY is a ``left_anti`` join of the child against the parent's key
  column: broadcast for small parents, bucket by bucket between the facts,
* ON DELETE CASCADE is a ``left_anti`` of each child against deleted keys,
* fact rows no view shows (unknown residence) are reported, not fixed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..functions.joins import sized_broadcast

# What a report shows; violations also name the key columns and hold the typed
# key (``key_columns``, ``key_json``), by which rows are found again.
VIOLATION_COLUMNS = ["rule", "table_name", "key", "detail"]


# Keys are read back from JSON: instants keep their microseconds.
KEY_JSON = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
            "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


class IntegrityError(RuntimeError):
    pass


def _key(cols: list[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in cols])


def _typed_key(cols: list[str]) -> Column:
    """The key columns as JSON: values are quoted by type and NULL is written
    out, so two keys have the same text only if they are the same key."""
    return F.to_json(F.struct(*cols), KEY_JSON)


def _ids(cols: list[str]) -> list[Column]:
    return [F.lit(",".join(cols)).alias("key_columns"), _typed_key(cols).alias("key_json")]


def _empty(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(
        [], "rule string, table_name string, key string, detail string, key_columns string, key_json string")


def _flagged(df: DataFrame, table: str, key: list[str], rule: str, conds: dict[str, Column]) -> DataFrame:
    """Rows where a named condition is TRUE, one output row per (row, name)."""
    if not conds:
        return _empty(df)
    names = F.array(*[F.when(c, F.lit(n)) for n, c in conds.items()])
    hit = reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in conds.values()])
    return (df.filter(hit)
            .select(_key(key).alias("key"), F.explode(F.filter(names, lambda x: x.isNotNull())).alias("detail"), *_ids(key))
            .select(F.lit(rule).alias("rule"), F.lit(table).alias("table_name"), "key", "detail", "key_columns",
                    "key_json"))


def not_null_violations(df: DataFrame, table: str, key: list[str], columns: list[str]) -> DataFrame:
    """Q1: one row per (row, column) holding NULL in a NOT NULL column."""
    cols = [c for c in columns if c in df.columns]
    return _flagged(df, table, key, "not_null", {c: F.col(c).isNull() for c in cols})


def unique_violations(df: DataFrame, table: str, key: list[str]) -> DataFrame:
    """Q2: keys held by more than one row (NULL keys ignored, as UNIQUE does)."""
    nonnull = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])
    return (df.filter(nonnull).groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
            .filter(F.col("_n") > 1)
            .select(F.lit("unique").alias("rule"), F.lit(table).alias("table_name"), _key(key).alias("key"),
                    F.concat(F.lit("rows="), F.col("_n").cast("string")).alias("detail"), *_ids(key)))


def unique_violations_many(df: DataFrame, table: str, keys: list[list[str]]) -> DataFrame:
    """Q2 for all keys of a table: one scan, one shuffle.  The rows are
    expanded to one grouping set a key and counted in a single aggregate."""
    if len(keys) == 1:
        return unique_violations(df, table, keys[0])
    columns = list(dict.fromkeys(c for k in keys for c in k))
    sets = df.select(*columns).groupingSets([[F.col(c) for c in k] for k in keys], *[F.col(c) for c in columns])
    counted = sets.agg(F.count(F.lit(1)).alias("_n"), F.grouping_id().alias("_set")).filter(F.col("_n") > 1)
    # grouping_id: a bit for each column, the first one highest, set where the column is not in the set
    number = [sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in k) for k in keys]
    frames = []
    for k, n in zip(keys, number, strict=True):
        known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in k])
        frames.append(F.when((F.col("_set") == n) & known, F.struct(_key(k).alias("key"), *_ids(k))))
    return (counted.withColumn("_hit", F.coalesce(*frames)).filter(F.col("_hit").isNotNull())
            .select(F.lit("unique").alias("rule"), F.lit(table).alias("table_name"), "_hit.key",
                    F.concat(F.lit("rows="), F.col("_n").cast("string")).alias("detail"), "_hit.key_columns",
                    "_hit.key_json"))


def check_violations(df: DataFrame, table: str, key: list[str], checks: dict[str, Column]) -> DataFrame:
    """Q3: rows where a CHECK condition is FALSE (NULL passes, as in SQL)."""
    return _flagged(df, table, key, "check", {n: ~c for n, c in checks.items()})


def orphan_violations(child: DataFrame, table: str, key: list[str], fk: str,
                      parent: DataFrame, pk: str, parent_name: str) -> DataFrame:
    """Q4: non-NULL foreign keys with no parent row (NULL passes).  See
    ``orphan_violations_many``."""
    return orphan_violations_many([(child, table, key, fk, parent, pk, parent_name)])


def orphan_violations_many(checks: list[tuple]) -> DataFrame:
    """Q4 for several foreign keys in one pass.

    ``checks``: ``(child, table, key, fk, parent, pk, parent_name)`` tuples.
    Each child is anti-joined to its parent's keys as it is stored: a small
    parent is broadcast after a size check (one per parent), so the child is
    scanned once without a shuffle; a child and parent bucketed by the same id
    (the facts) join bucket by bucket; anything else is a shuffle join whose
    hot keys AQE splits."""
    sized: dict[tuple[str, str, int], DataFrame] = {}
    frames = []
    for child, table, key, fk, parent, pk, parent_name in checks:
        slot = (parent_name, pk, id(parent))
        if slot not in sized:
            sized[slot] = sized_broadcast(parent.select(F.col(pk).alias("_parent_key")))
        child_key, parent_key = F.col(fk), F.col("_parent_key")
        if dict(child.dtypes)[fk] != dict(parent.dtypes)[pk]:  # a cast would hide the buckets
            child_key, parent_key = child_key.cast("bigint"), parent_key.cast("bigint")
        frames.append(child.filter(F.col(fk).isNotNull()).join(sized[slot], child_key == parent_key, "left_anti")
                      .select(F.lit("foreign_key").alias("rule"), F.lit(table).alias("table_name"),
                              _key(key).alias("key"), F.lit(f"{fk}->{parent_name}.{pk}").alias("detail"), *_ids(key)))
    return union_all(frames)


def orphan_counts(checks: list[tuple], rows: dict[str, int]) -> dict[str, int]:
    """Q4 as counts: child rows whose foreign key has no parent, by
    ``child|fk``.  One narrow scan of each child with all its parents joined
    (``rows``: known row counts of the tables, which decide what is broadcast;
    children and parents bucketed by the same id meet bucket by bucket)."""
    frames = []
    for table in dict.fromkeys(c[1] for c in checks):
        mine = [c for c in checks if c[1] == table]
        out = mine[0][0].select(*dict.fromkeys(c[3] for c in mine))
        sums = []
        for i, (child, _, _, fk, parent, pk, parent_name) in enumerate(mine):
            there = parent.select(F.col(pk).alias(f"_p{i}"), F.lit(True).alias(f"_is{i}"))
            own, other = F.col(fk), F.col(f"_p{i}")
            if dict(child.dtypes)[fk] != dict(parent.dtypes)[pk]:  # a cast would hide the buckets
                own, other = own.cast("bigint"), other.cast("bigint")
            out = out.join(sized_broadcast(there, known_rows=rows.get(parent_name)), own == other, "left")
            miss = F.col(fk).isNotNull() & F.col(f"_is{i}").isNull()
            sums.append(F.struct(F.lit(f"{table}|{fk}").alias("name"), F.sum(miss.cast("long")).alias("n")))
        frames.append(out.agg(F.array(*sums).alias("s")).select(F.inline("s")))
    return {r["name"]: int(r["n"] or 0) for r in union_all(frames).collect()} if frames else {}


def type_fit_conditions(columns: list[str], spec: dict[str, tuple]) -> dict[str, Column]:
    """Named conditions that are TRUE when a value would not fit its declared
    type.  ``spec`` maps column -> ("varchar", n) | ("smallint",) | ("int",) |
    ("numeric", p, s); columns not in ``columns`` are skipped."""
    conds: dict[str, Column] = {}
    for col, t in spec.items():
        if col not in columns:
            continue
        c = F.col(col)
        if t[0] == "varchar":
            conds[f"{col}:varchar({t[1]})"] = F.length(c.cast("string")) > t[1]
        elif t[0] == "smallint":
            conds[f"{col}:smallint"] = (c < -32768) | (c > 32767)
        elif t[0] == "int":
            conds[f"{col}:int"] = (c < -2147483648) | (c > 2147483647)
        elif t[0] == "numeric":
            bound = 10 ** (t[1] - t[2])
            conds[f"{col}:numeric({t[1]},{t[2]})"] = F.abs(c.cast("double")) >= bound
    return conds


def type_fit_violations(df: DataFrame, table: str, key: list[str], spec: dict[str, tuple]) -> DataFrame:
    """Q6: values that would not fit the declared column type."""
    return _flagged(df, table, key, "type_fit", type_fit_conditions(df.columns, spec))


def scan_rules(table: str, columns: list[str]) -> dict[str, Column]:
    """Every NOT NULL, CHECK and type-fit rule of ``table`` as a condition that
    is TRUE for rows that break it (NULL: not broken)."""
    conds: dict[str, Column] = {}
    if table in NOT_NULL:
        conds.update({f"not_null|{c}": F.col(c).isNull() for c in NOT_NULL[table][1] if c in columns})
    if table == "fato_notificacoes":
        conds.update({f"check|{n}": ~c for n, c in fact_checks().items()})
    if table in TYPE_FIT:
        conds.update({f"type_fit|{n}": c for n, c in type_fit_conditions(columns, TYPE_FIT[table][1]).items()})
    return conds


def rule_counters(table: str, columns: list[str]) -> dict[str, Column]:
    """Aggregate expressions counting, per NOT NULL / CHECK / type-fit rule of
    ``table``, the rows that break it: meant for ``observe`` while the table is
    written, so a clean load needs no extra scan to prove it clean."""
    return {f"broken|{table}|{n}": F.sum(F.when(F.coalesce(c, F.lit(False)), 1).otherwise(0))
            for n, c in scan_rules(table, columns).items()}


def cascade_delete(children: dict[str, tuple[DataFrame, str]], deleted: DataFrame, key: str) -> dict[str, DataFrame]:
    """Q5: rewrite every child without the rows whose ``fk`` is a deleted key.
    The deleted-key set is broadcast when a size check proves it small;
    otherwise the anti-join shuffles (and AQE splits skewed child keys)."""
    keys = sized_broadcast(deleted.select(F.col(key).alias("_del")).distinct(), materialize=True)
    return {name: df.join(keys, F.col(fk) == F.col("_del"), "left_anti") for name, (df, fk) in children.items()}


def gate(violations: DataFrame, mode: str = "report") -> DataFrame:
    """``report`` returns the violations; ``fail`` raises if there is any."""
    if mode == "fail" and violations.limit(1).count() > 0:
        sample = [r.asDict() for r in violations.limit(5).collect()]
        raise IntegrityError(f"integrity violations, e.g. {sample}")
    return violations


def mark_broken(df: DataFrame, violations: DataFrame, table: str, flag: str = "_broken") -> DataFrame:
    """``df`` with ``flag``: whether the row breaks a rule of ``table``.  Each
    violation is matched on the columns it names, by typed values and with NULL
    equal to NULL only: a duplicate ``code = 5`` takes the rows with that code,
    not the row whose id is 5.  The few violating keys are read back from JSON
    as typed columns, the rows are compared as they are.  One join per set of
    key columns (as many as the table has rules at most); the keys are broadcast
    only after a size check."""
    mine = violations.filter(F.col("table_name") == table)
    out, flags = df, []
    for (named,) in sorted(tuple(r) for r in mine.select("key_columns").distinct().collect()):
        columns, at = named.split(","), len(flags)
        typed = StructType([StructField(c, df.schema[c].dataType) for c in columns])
        bad = (mine.filter(F.col("key_columns") == named).select(F.from_json("key_json", typed, KEY_JSON).alias("k"))
               .select(*[F.col(f"k.{c}").alias(f"_k{at}_{i}") for i, c in enumerate(columns)]).distinct()
               .withColumn(f"_hit{at}", F.lit(True)))
        same = [F.col(c).eqNullSafe(F.col(f"_k{at}_{i}")) for i, c in enumerate(columns)]
        out = (out.join(sized_broadcast(bad, materialize=True), reduce(lambda a, b: a & b, same), "left")
               .drop(*[f"_k{at}_{i}" for i in range(len(columns))]))
        flags.append(f"_hit{at}")
    return out.withColumn(flag, F.coalesce(*flags, F.lit(False))).drop(*flags)


def quarantine(df: DataFrame, violations: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """``quarantine`` mode: split ``df`` into (clean rows, rows that break a
    rule of ``table``), see :func:`mark_broken`."""
    marked = mark_broken(df, violations, table)
    return marked.filter(~F.col("_broken")).drop("_broken"), marked.filter("_broken").drop("_broken")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


# Warehouse rules, as declared by the warehouse DDL.
NOT_NULL = {
    "dim_localidades": (["id_localidade"], ["id_localidade", "codigo_ibge_municipio"]),
    "dim_condicoes": (["id_condicao"], ["id_condicao", "nome_condicao"]),
    "dim_evolucao_caso": (["id_evolucao"], ["id_evolucao", "descricao_evolucao"]),
    "dim_raca_cor": (["id_raca_cor"], ["id_raca_cor", "descricao_raca_cor"]),
    "dim_sintomas": (["id_sintoma"], ["id_sintoma", "nome_sintoma"]),
    "dim_tipos_testes": (["id_tipo_teste"], ["id_tipo_teste", "descricao_tipo_teste"]),
    "dim_fabricantes": (["id_fabricante"], ["id_fabricante", "nome_fabricante"]),
    "fato_notificacao_sintoma": (["fk_notificacao", "fk_sintoma"], ["fk_notificacao", "fk_sintoma"]),
    "fato_notificacao_condicao": (["fk_notificacao", "fk_condicao"], ["fk_notificacao", "fk_condicao"]),
    "indicadores_municipais": (["id_indicador"], ["id_indicador", "data_referencia", "taxa_positividade", "total_testes",
                                                  "total_positivos"]),
    "log_alteracoes": (["id_log"], ["id_log", "tabela_afetada", "operacao"]),
    "fato_notificacoes": (["id_notificacao"], ["id_notificacao", "profissional_saude", "profissional_seguranca",
                                               "data_notificacao", "data_inicio_sintomas", "classificacao_final"]),
}
UNIQUE = {
    "dim_localidades": [["id_localidade"], ["codigo_ibge_municipio"]],
    "dim_condicoes": [["id_condicao"], ["nome_condicao"]],
    "dim_evolucao_caso": [["id_evolucao"], ["descricao_evolucao"]],
    "dim_raca_cor": [["id_raca_cor"], ["descricao_raca_cor"]],
    "dim_sintomas": [["id_sintoma"], ["nome_sintoma"]],
    "dim_tipos_testes": [["id_tipo_teste"], ["descricao_tipo_teste"]],
    "dim_fabricantes": [["id_fabricante"], ["nome_fabricante"]],
    "indicadores_municipais": [["id_indicador"], ["fk_localidade", "data_referencia"]],
    "log_alteracoes": [["id_log"]],
    "fato_notificacoes": [["id_notificacao"]],
    "fato_notificacao_sintoma": [["fk_notificacao", "fk_sintoma"]],
    "fato_notificacao_condicao": [["fk_notificacao", "fk_condicao"]],
    "fato_testes_realizados": [["fk_notificacao", "test_number"]],
}
FOREIGN = [
    ("fato_notificacoes", ["id_notificacao"], "fk_raca_cor", "dim_raca_cor", "id_raca_cor"),
    ("fato_notificacoes", ["id_notificacao"], "fk_localidade_residencia", "dim_localidades", "id_localidade"),
    ("fato_notificacoes", ["id_notificacao"], "fk_localidade_notificacao", "dim_localidades", "id_localidade"),
    ("fato_notificacoes", ["id_notificacao"], "fk_evolucao_caso", "dim_evolucao_caso", "id_evolucao"),
    ("fato_notificacao_sintoma", ["fk_notificacao", "fk_sintoma"], "fk_notificacao", "fato_notificacoes", "id_notificacao"),
    ("fato_notificacao_sintoma", ["fk_notificacao", "fk_sintoma"], "fk_sintoma", "dim_sintomas", "id_sintoma"),
    ("fato_notificacao_condicao", ["fk_notificacao", "fk_condicao"], "fk_notificacao", "fato_notificacoes", "id_notificacao"),
    ("fato_notificacao_condicao", ["fk_notificacao", "fk_condicao"], "fk_condicao", "dim_condicoes", "id_condicao"),
    ("fato_testes_realizados", ["fk_notificacao", "test_number"], "fk_notificacao", "fato_notificacoes", "id_notificacao"),
    ("indicadores_municipais", ["id_indicador"], "fk_localidade", "dim_localidades", "id_localidade"),
]
TYPE_FIT = {
    "dim_localidades": (["id_localidade"], {"estado_uf": ("varchar", 2), "estado_nome": ("varchar", 50),
                                            "municipio_nome": ("varchar", 100)}),
    "dim_condicoes": (["id_condicao"], {"id_condicao": ("smallint",), "nome_condicao": ("varchar", 100)}),
    "dim_evolucao_caso": (["id_evolucao"], {"id_evolucao": ("smallint",), "descricao_evolucao": ("varchar", 50)}),
    "dim_raca_cor": (["id_raca_cor"], {"id_raca_cor": ("smallint",), "descricao_raca_cor": ("varchar", 50)}),
    "dim_sintomas": (["id_sintoma"], {"id_sintoma": ("smallint",), "nome_sintoma": ("varchar", 100)}),
    "dim_tipos_testes": (["id_tipo_teste"], {"id_tipo_teste": ("smallint",), "descricao_tipo_teste": ("varchar", 100)}),
    "dim_fabricantes": (["id_fabricante"], {"id_fabricante": ("smallint",), "nome_fabricante": ("varchar", 100)}),
    "indicadores_municipais": (["id_indicador"], {"taxa_positividade": ("numeric", 5, 2), "total_testes": ("int",),
                                                  "total_positivos": ("int",)}),
    "log_alteracoes": (["id_log"], {"tabela_afetada": ("varchar", 50), "operacao": ("varchar", 10),
                                      "usuario_bd": ("varchar", 100)}),
    "fato_notificacoes": (["id_notificacao"], {
        "sexo": ("varchar", 20), "codigo_cbo": ("varchar", 255), "classificacao_final": ("varchar", 50),
        "codigo_recebeu_vacina": ("smallint",), "codigo_doses_vacina": ("varchar", 100),
        "nome_fabricante_vacina": ("varchar", 255), "idade": ("int",), "codigo_estrategia_covid": ("int",)}),
    "fato_testes_realizados": (["fk_notificacao", "test_number"], {
        "codigo_estado_teste": ("smallint",), "fk_tipo_teste": ("smallint",), "fk_fabricante": ("smallint",),
        "fk_resultado_teste": ("smallint",)}),
}


def fact_checks() -> dict[str, Column]:
    """Q3 CHECK constraints of the main fact."""
    return {"idade >= 0": F.col("idade") >= 0,
            "data_inicio_sintomas <= data_notificacao": F.col("data_inicio_sintomas") <= F.col("data_notificacao")}


def load_gate_violations(tables: dict[str, DataFrame], observed: dict[str, int] | None = None) -> DataFrame:
    """All rules (Q1-Q4, Q6) before a warehouse is published, at the cost of
    its key columns:

    * NOT NULL, CHECK and type fit were counted while each table was written
      (``observed``: ``rule_counters`` and the tables' row counts); a table is
      scanned again only to list the rows of a rule that broke, or if nothing
      was counted;
    * UNIQUE: the facts bucket by bucket without a shuffle, the dimensions with
      all keys in one pass;
    * FOREIGN KEY: one narrow scan of each child that counts the misses of all
      its keys; they are listed only where there are any."""
    observed = observed or {}
    frames = [unique_violations_many(tables[t], t, keys) for t, keys in UNIQUE.items() if t in tables]
    for t, df in tables.items():
        counts = [v for k, v in observed.items() if k.startswith(f"broken|{t}|")]
        if scan_rules(t, df.columns) and (not counts or any(counts)):
            frames += scan_violations(df, t)
    fks = foreign_checks(tables)
    missing = orphan_counts(fks, observed)
    broken = [c for c in fks if missing.get(f"{c[1]}|{c[3]}")]
    return union_all(frames + ([orphan_violations_many(broken)] if broken else []))


def foreign_checks(tables: dict[str, DataFrame]) -> list[tuple]:
    return [(tables[c], c, k, fk, tables[p], pk, p) for c, k, fk, p, pk in FOREIGN if c in tables and p in tables]


def scan_violations(df: DataFrame, table: str) -> list[DataFrame]:
    """The NOT NULL, CHECK and type-fit violations of one table."""
    frames = []
    if table in NOT_NULL:
        frames.append(not_null_violations(df, table, *NOT_NULL[table]))
    if table == "fato_notificacoes":
        frames.append(check_violations(df, table, ["id_notificacao"], fact_checks()))
    if table in TYPE_FIT:
        frames.append(type_fit_violations(df, table, *TYPE_FIT[table]))
    return frames


def hidden_from_views(fact: DataFrame) -> DataFrame:
    """Fact rows every view drops (unknown residence locality: the views join
    it as an inner join).  Not a constraint violation; reported so the gap
    between the fact and the views is visible."""
    return (fact.filter(F.col("fk_localidade_residencia").isNull())
            .select(F.lit("hidden_from_views").alias("rule"), F.lit("fato_notificacoes").alias("table_name"),
                    _key(["id_notificacao"]).alias("key"), F.lit("fk_localidade_residencia").alias("detail"),
                    *_ids(["id_notificacao"])))


def warehouse_violations(tables: dict[str, DataFrame], include_not_null: bool = True,
                         include_types: bool = True) -> DataFrame:
    frames: list[DataFrame] = []
    if include_not_null:
        frames += [not_null_violations(tables[t], t, k, cols) for t, (k, cols) in NOT_NULL.items() if t in tables]
    for t, keys in UNIQUE.items():
        if t in tables and (present := [k for k in keys if all(c in tables[t].columns for c in k)]):
            frames.append(unique_violations_many(tables[t], t, present))
    if "fato_notificacoes" in tables:
        frames.append(check_violations(tables["fato_notificacoes"], "fato_notificacoes", ["id_notificacao"],
                                       fact_checks()))
    if fks := foreign_checks(tables):
        frames.append(orphan_violations_many(fks))
    if include_types:
        frames += [type_fit_violations(tables[t], t, k, spec) for t, (k, spec) in TYPE_FIT.items() if t in tables]
    return union_all(frames)
