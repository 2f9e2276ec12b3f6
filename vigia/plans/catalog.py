"""Registry of named queries: ``name -> (spark, sf_dir) -> DataFrame``.

Names follow the operator inventory.  Queries over the warehouse share one
ETL build per Spark application (``warehouse_for``); operator-level queries
(cleaning rules, reshaping, sources, audit) read the benchmark tables, or data
Spark derives from them, directly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import labels
from ..operators import audit as A
from ..operators import clean as C
from ..operators import dims as D
from ..operators import project as P
from ..operators import quality as Q
from ..operators import reshape as R
from ..operators.declared import as_declared
from ..session import compiled_methods, fresh_dir, shared_dir
from ..sources import csv as S
from ..sources.fixture import raw_notifications
from ..sources.row_ids import with_file_row_id
from ..sources.tables import fact_table, table
from ..sources.warehouse import append_table, read_table, view_scan
from ..streaming.audit_stream import Feed, read_log, run_audit_stream, stage_events
from . import indicators as K
from . import versions
from . import views as V
from .etl import build_warehouse, load_warehouse, warehouse_for

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            shared_dir(spark)  # checkpoint / scratch folder: read from the session, set only if unset
            compiled_methods(spark)
            return fn(spark, sf_dir)
        run.__name__ = run.__qualname__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


def _raw(spark, sf):
    return raw_notifications(spark, sf)


def _wh(spark, sf):
    return warehouse_for(spark, sf).tables


# ---------------------------------------------------------------- C: cleaning

@query("impute_class")
def _impute_class(spark, sf):
    return C.impute_class(_raw(spark, sf)).select("id_notificacao", "classificacaoFinal")


@query("impute_onset")
def _impute_onset(spark, sf):
    return C.impute_onset(_raw(spark, sf)).select("id_notificacao", "dataInicioSintomas")


@query("clamp_onset")
def _clamp_onset(spark, sf):
    return C.clamp_onset(C.impute_onset(_raw(spark, sf))).select("id_notificacao", "dataInicioSintomas")


@query("null_bad_closure")
def _null_bad_closure(spark, sf):
    return C.null_bad_closure(_raw(spark, sf)).select("id_notificacao", "dataEncerramento")


@query("impute_median")
def _impute_median(spark, sf):
    return C.impute_median(_raw(spark, sf)).select("id_notificacao", "idade")


@query("fill_defaults")
def _fill_defaults(spark, sf):
    return C.fill_defaults(_raw(spark, sf)).select("id_notificacao", "sexo", "racaCor", "evolucaoCaso")


@query("bool_flag")
def _bool_flag(spark, sf):
    return C.bool_flags(_raw(spark, sf)).select("id_notificacao", "profissionalSaude", "profissionalSeguranca")


@query("drop_null_rows")
def _drop_null_rows(spark, sf):
    return P.drop_null_rows(_raw(spark, sf), ["dataNotificacao"]).select("id_notificacao")


@query("clean_notifications")
def _clean_notifications(spark, sf):
    return _wh(spark, sf)["clean"]


# ----------------------------------------------------------------- R: reshape

@query("explode_multivalue")
def _explode_multivalue(spark, sf):
    return R.explode_multivalue(_wh(spark, sf)["clean"], "sintomas", "nome_sintoma")


@query("tests_long")
def _tests_long(spark, sf):
    return _wh(spark, sf)["fato_testes_realizados"]


# -------------------------------------------------------------- D: dimensions

@query("dim_localities")
def _dim_localities(spark, sf):
    return _wh(spark, sf)["dim_localidades"]


@query("derive_state_code")
def _derive_state_code(spark, sf):
    return _wh(spark, sf)["dim_localidades"].select(
        "codigo_ibge_municipio", D.state_code(F.col("codigo_ibge_municipio")).alias("codigo_ibge_estado"))


@query("dim_symptoms")
def _dim_symptoms(spark, sf):
    return _wh(spark, sf)["dim_sintomas"]


@query("dim_conditions")
def _dim_conditions(spark, sf):
    return _wh(spark, sf)["dim_condicoes"]


@query("dim_race")
def _dim_race(spark, sf):
    return _wh(spark, sf)["dim_raca_cor"]


@query("dim_outcome")
def _dim_outcome(spark, sf):
    return _wh(spark, sf)["dim_evolucao_caso"]


# ------------------------------------------------------------------- J: facts

@query("fact_notifications")
def _fact_notifications(spark, sf):
    return _wh(spark, sf)["fato_notificacoes"]


@query("bridge_symptoms")
def _bridge_symptoms(spark, sf):
    return _wh(spark, sf)["fato_notificacao_sintoma"]


@query("bridge_conditions")
def _bridge_conditions(spark, sf):
    return _wh(spark, sf)["fato_notificacao_condicao"]


# ------------------------------------------------------------------- V: views

for _name, _fn in [("cases_by_municipality", V.cases_by_municipality),
                   ("vaccination_by_result", V.vaccination_by_result),
                   ("frequent_symptoms", V.frequent_symptoms),
                   ("epidemiological_profile", V.epidemiological_profile),
                   ("laboratory_analysis", V.laboratory_analysis),
                   ("positivity_rate", V.positivity_rate),
                   # K: dashboard aggregates, no filter (the whole warehouse)
                   ("lookup_default", K.lab_frame),
                   ("filter_states", K.filter_states),
                   ("filter_municipalities", K.filter_municipalities),
                   ("kpi_summary", K.kpi_summary),
                   ("confirmed_by_state", K.confirmed_by_state),
                   ("epidemic_curve", K.epidemic_curve),
                   ("cases_by_sex", K.cases_by_sex),
                   ("confirmed_by_age", K.confirmed_by_age),
                   ("vaccine_outcome", K.vaccine_outcome),
                   ("top_symptoms", K.top_symptoms),
                   ("top_laboratory", K.top_laboratory),
                   ("top_municipalities", K.top_municipalities),
                   ("top_laboratories", K.top_laboratories)]:
    query(_name)((lambda fn: (lambda spark, sf: fn(_wh(spark, sf))))(_fn))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


_STAGED: dict[tuple, str] = {}


def _staged(spark, sf, kind: str, write) -> str:
    """Input files staged once per session: ``write(path)`` runs on first use.
    Staging stands in for source files that already exist; the queries time
    reading them, not producing them."""
    key = (spark.sparkContext.applicationId, id(spark), sf, kind)
    if key not in _STAGED:
        path = fresh_dir(spark, f"staged-{kind}")
        write(path)
        _STAGED[key] = path
    return _STAGED[key]


def _staged_csv(spark, sf, with_id: bool = True) -> str:
    """The derived notification input as day-first CSV files in id order,
    below the shared checkpoint location.  Without the id column it is what a
    source file looks like: the id is then the file position (S5)."""
    return _staged(spark, sf, f"csv-{with_id}", lambda path: _write_csv(spark, sf, path, with_id))


def _write_csv(spark, sf, path: str, with_id: bool) -> None:
    raw = _raw(spark, sf)
    ordered = raw.withColumn("_pos", F.col("id_notificacao"))
    if not with_id:
        ordered = ordered.drop("id_notificacao")
    S.write_csv(ordered, path, order_by="_pos", drop_order_column=True)


# ------------------------------------------------------------ S: sources

@query("csv_scan")
def _csv_scan(spark, sf):
    return S.read_notifications(spark, _staged_csv(spark, sf, with_id=False))


def _csv_variant(spark, sf, kind: str, change):
    """The staged notification files with some cells written another way."""
    def write(path):
        raw = change(_raw(spark, sf)).withColumn("_pos", F.col("id_notificacao")).drop("id_notificacao")
        S.write_csv(raw, path, order_by="_pos", drop_order_column=True)
    return _staged(spark, sf, f"csv-{kind}", write)


@query("csv_scan_iso")
def _csv_scan_iso(spark, sf):
    """S4 over files whose dates are ISO dates and date-times."""
    def change(raw):
        return raw.withColumns({c: F.when(F.col("id_notificacao") % 2 == 0, F.date_format(c, "yyyy-MM-dd"))
                                .otherwise(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")) for c in S.date_columns(raw)})
    out = S.read_notifications(spark, _csv_variant(spark, sf, "iso", change))
    return out.select("id_notificacao", *S.date_columns(out))


@query("csv_scan_decimal_codes")
def _csv_scan_decimal_codes(spark, sf):
    """Whole-number codes written with a decimal part ("1501402.0")."""
    def change(raw):
        codes = [c for c, t in S.NUMERIC_COLUMNS.items() if t == "bigint" and c in raw.columns and c != "id_notificacao"]
        return raw.withColumns({c: F.col(c).cast("decimal(20,1)").cast("string") for c in codes})
    out = S.read_notifications(spark, _csv_variant(spark, sf, "decimal", change))
    return out.select("id_notificacao", *[c for c in S.NUMERIC_COLUMNS if c in out.columns and c != "id_notificacao"])


@query("null_tokens")
def _null_tokens(spark, sf):
    raw = _raw(spark, sf)
    text = [f.name for f in raw.schema.fields if f.dataType.simpleString() == "string"]
    return S.null_tokens(raw.select("id_notificacao", *text))


@query("drop_columns")
def _drop_columns(spark, sf):
    return P.drop_columns(_raw(spark, sf))


@query("parse_dates")
def _parse_dates(spark, sf):
    raw = _raw(spark, sf)
    dates = S.date_columns(raw)
    # day-first text as the source files hold it (no zero padding on odd ids)
    as_text = raw.select("id_notificacao", *[F.date_format(c, "dd/MM/yyyy").alias(c) for c in dates])
    as_text = as_text.select("id_notificacao", *[
        F.when(F.col("id_notificacao") % 2 == 0, F.col(c))
         .otherwise(F.regexp_replace(F.regexp_replace(F.col(c), r"^0", ""), r"/0", "/")).alias(c)
        for c in dates])
    return S.parse_dates(as_text)


@query("dense_row_id")
def _dense_row_id(spark, sf):
    df = S.read_csv(spark, _staged_csv(spark, sf))
    return with_file_row_id(df, "row_id").select(F.col("id_notificacao").cast("bigint").alias("id_notificacao"),
                                                 "row_id")


@query("sink_roundtrip")
def _sink_roundtrip(spark, sf):
    path = fresh_dir(spark, "sink")
    append_table(_wh(spark, sf)["fato_notificacoes"], path)
    return read_table(spark, path)


@query("view_scan")
def _view_scan(spark, sf):
    t = _wh(spark, sf)
    V.register_views(t)
    return view_scan(spark, "vw_perfil_epidemiologico")


# ------------------------------------------------------- P: projections

@query("project_existing")
def _project_existing(spark, sf):
    wanted = ["id_notificacao", "sexo", "idade", "cbo", "fk_localidade_notificacao", "classificacaoFinal",
              "codigoDosesVacina", "campoInexistente"]
    return P.project_existing(_wh(spark, sf)["clean"], wanted)


@query("rename_columns")
def _rename_columns(spark, sf):
    renamed = P.rename_columns(_wh(spark, sf)["clean"], {**labels.FACT_RENAMES, "campoInexistente": "x"})
    return renamed.select("id_notificacao", *labels.FACT_RENAMES.values())


@query("optional_filter")
def _optional_filter(spark, sf):
    return P.optional_filter(V.epidemiological_profile(_wh(spark, sf)), estado_uf="AM", municipio_nome=labels.ALL)


@query("in_list")
def _in_list(spark, sf):
    fn = _wh(spark, sf)["fato_notificacoes"]
    return fn.filter(F.col("classificacao_final").isin(labels.CONFIRMED, labels.DISCARDED)).select(
        "id_notificacao", "classificacao_final")


@query("constant_column")
def _constant_column(spark, sf):
    return P.with_constant(V.frequent_symptoms(_wh(spark, sf)), "source_id", labels.LAB_SOURCE_ID)


# ----------------------------------------------------------- R: reshape

@query("unpivot")
def _unpivot(spark, sf):
    clean = _wh(spark, sf)["clean"]
    return R.unpivot(clean, ["id_notificacao"], R.wide_columns(clean, labels.TEST_METRICS, labels.TEST_SLOTS))


LINE_VALUES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey"]


@query("pivot_first")
def _pivot_first(spark, sf):
    li = fact_table(spark, sf, "lineitem")
    ids = ["l_orderkey", "l_linenumber", *LINE_ORDER]
    long = li.select(*ids, *LINE_VALUES).unpivot(ids, LINE_VALUES, "metric", "value")
    return R.pivot_first(long, ["l_orderkey", "l_linenumber"], "metric", "value", LINE_ORDER, LINE_VALUES)


# ------------------------------------------------------- D: generic dims

@query("keep_first")
def _keep_first(spark, sf):
    cust = table(spark, sf, "customer")
    first = D.keep_first_by(cust, "c_nationkey", F.col("c_custkey"), ["c_name", "c_mktsegment", "c_acctbal"])
    return first.withColumnRenamed("_ord", "c_custkey")


@query("surrogate_key")
def _surrogate_key(spark, sf):
    return D.surrogate_key(fact_table(spark, sf, "orders"), "o_orderpriority", "o_orderkey", "id")


@query("distinct_values")
def _distinct_values(spark, sf):
    return _wh(spark, sf)["clean"].select("sexo", "racaCor").distinct()


# ------------------------------------------------------- Q: data quality

@query("dq_not_null")
def _dq_not_null(spark, sf):
    t = _wh(spark, sf)
    frames = [Q.not_null_violations(t[n], n, k, cols) for n, (k, cols) in Q.NOT_NULL.items() if n in t]
    frames.append(Q.not_null_violations(_raw(spark, sf), "raw_notificacoes", ["id_notificacao"], ["dataNotificacao"]))
    return Q.union_all(frames).select(*Q.VIOLATION_COLUMNS)


@query("dq_unique")
def _dq_unique(spark, sf):
    t = _wh(spark, sf)
    frames = [Q.unique_violations_many(t[n], n, keys) for n, keys in Q.UNIQUE.items() if n in t]
    frames.append(Q.unique_violations(fact_table(spark, sf, "lineitem"), "lineitem", ["l_orderkey", "l_linenumber"]))
    return Q.union_all(frames).select(*Q.VIOLATION_COLUMNS)


@query("dq_check")
def _dq_check(spark, sf):
    t = _wh(spark, sf)
    raw = _raw(spark, sf)
    return Q.check_violations(t["fato_notificacoes"], "fato_notificacoes", ["id_notificacao"], Q.fact_checks()).unionByName(
        Q.check_violations(raw, "raw_notificacoes", ["id_notificacao"],
                           {"dataInicioSintomas <= dataNotificacao": F.col("dataInicioSintomas") <= F.col("dataNotificacao"),
                            "idade >= 0": F.col("idade") >= 0})).select(*Q.VIOLATION_COLUMNS)


@query("dq_orphans")
def _dq_orphans(spark, sf):
    t = _wh(spark, sf)
    checks = [(t[c], c, k, fk, t[p], pk, p) for c, k, fk, p, pk in Q.FOREIGN]
    # a parent that lost rows: customers with a negative balance removed
    kept = table(spark, sf, "customer").filter(F.col("c_acctbal") >= 0)
    checks.append((fact_table(spark, sf, "orders"), "orders", ["o_orderkey"], "o_custkey", kept, "c_custkey",
                   "customer"))
    return Q.orphan_violations_many(checks).select(*Q.VIOLATION_COLUMNS)


@query("dq_hidden_rows")
def _dq_hidden_rows(spark, sf):
    """Fact rows no view shows (unknown residence), reported rather than fixed."""
    return Q.hidden_from_views(_wh(spark, sf)["fato_notificacoes"]).select(*Q.VIOLATION_COLUMNS)


@query("dq_type_fit")
def _dq_type_fit(spark, sf):
    t = _wh(spark, sf)
    frames = [Q.type_fit_violations(t[n], n, k, spec) for n, (k, spec) in Q.TYPE_FIT.items() if n in t]
    # values that don't fit: every rule kind but int on the order and part tables
    frames.append(Q.type_fit_violations(fact_table(spark, sf, "orders"), "orders", ["o_orderkey"], {
        "o_totalprice": ("numeric", 7, 2), "o_orderkey": ("smallint",), "o_orderpriority": ("varchar", 10)}))
    return Q.union_all(frames).select(*Q.VIOLATION_COLUMNS)


@query("dq_quarantine")
def _dq_quarantine(spark, sf):
    """Order lines that break a CHECK or a UNIQUE rule (by two different keys)
    are moved; every line is returned with where it went."""
    lines = fact_table(spark, sf, "lineitem")
    broken = Q.check_violations(lines, "lineitem", ["l_orderkey", "l_linenumber"],
                                {"l_quantity <= 45": F.col("l_quantity") <= 45}).unionByName(
        Q.unique_violations(lines, "lineitem", ["l_partkey", "l_shipdate"]))
    good, bad = Q.quarantine(lines, broken, "lineitem")
    return (good.select("l_orderkey", "l_linenumber", "l_quantity", F.lit(False).alias("moved"))
            .unionByName(bad.select("l_orderkey", "l_linenumber", "l_quantity", F.lit(True).alias("moved"))))


@query("cascade_survivors")
def _cascade_survivors(spark, sf):
    """The rows themselves that ON DELETE CASCADE leaves in the symptom bridge."""
    deleted = _raw(spark, sf).filter(F.col("excluido")).select("id_notificacao")
    bridge = _wh(spark, sf)["fato_notificacao_sintoma"]
    return Q.cascade_delete({"b": (bridge, "fk_notificacao")}, deleted, "id_notificacao")["b"]


@query("cascade_stored")
def _cascade_stored(spark, sf):
    """ON DELETE CASCADE on the stored warehouse: a new version without the
    notifications flagged as excluded, read back through its pointer."""
    deleted = _raw(spark, sf).filter(F.col("excluido")).select("id_notificacao")
    new = versions.delete_notifications(spark, warehouse_for(spark, sf), deleted, root=fresh_dir(spark, "cascade"))
    t = load_warehouse(spark, new.root).tables if new.version else new.tables
    row = lambda name, key, other: t[name].select(
        F.lit(name).alias("table_name"), F.col(key).alias("id_notificacao"), F.col(other).cast("string").alias("value"))
    return Q.union_all([row("fato_notificacoes", "id_notificacao", "classificacao_final"),
                        row("fato_notificacao_sintoma", "fk_notificacao", "fk_sintoma"),
                        row("fato_notificacao_condicao", "fk_notificacao", "fk_condicao"),
                        row("fato_testes_realizados", "fk_notificacao", "test_number")])


@query("incremental_load")
def _incremental_load(spark, sf):
    """Two loads in sequence: notifications up to the middle id are published,
    the others are added with the dimension ids already there.  The fact with
    its places by code, and the symptoms by id."""
    raw = _staged(spark, sf, "raw", lambda path: _raw(spark, sf).write.parquet(path))
    raw = spark.read.parquet(raw)
    middle = raw.agg(F.max("id_notificacao")).first()[0] // 2
    first = build_warehouse(spark, raw.filter(F.col("id_notificacao") <= middle), root=fresh_dir(spark, "loads"))
    t = versions.append_notifications(spark, first, raw.filter(F.col("id_notificacao") > middle)).tables
    place = t["dim_localidades"].select(F.col("id_localidade").alias("fk_localidade_residencia"), "codigo_ibge_municipio")
    symptoms = t["fato_notificacao_sintoma"].groupBy("fk_notificacao").agg(
        F.array_join(F.array_sort(F.collect_list("fk_sintoma")).cast("array<string>"), ",").alias("symptom_ids"))
    fact = t["fato_notificacoes"]
    return (fact.join(place, "fk_localidade_residencia", "left")
            .join(symptoms, fact.id_notificacao == symptoms.fk_notificacao, "left")
            .select("id_notificacao", "idade", "sexo", "data_notificacao", "data_inicio_sintomas", "classificacao_final",
                    "fk_raca_cor", "fk_evolucao_caso", "codigo_ibge_municipio", "symptom_ids"))


@query("indicator_table")
def _indicator_table(spark, sf):
    return _wh(spark, sf)["indicadores_municipais"]


@query("laboratory_analysis_seeded")
def _laboratory_analysis_seeded(spark, sf):
    """V5 with seeded test types and makers: some codes match, others fall
    back.  The seeds are distinct part brands and supplier names, by code."""
    types = table(spark, sf, "part").select("p_brand").distinct().withColumn(
        "id_tipo_teste", F.substring("p_brand", 7, 1).cast("int")).groupBy("id_tipo_teste").agg(
        F.min("p_brand").alias("descricao_tipo_teste")).filter("id_tipo_teste <= 2")
    makers = table(spark, sf, "supplier").filter("s_suppkey <= 4").select(
        F.col("s_suppkey").alias("id_fabricante"), F.col("s_name").alias("nome_fabricante"))
    t = dict(_wh(spark, sf))
    t["dim_tipos_testes"] = D.seed_dimension(spark, D.TEST_TYPE_SCHEMA, types)
    t["dim_fabricantes"] = D.seed_dimension(spark, D.MAKER_SCHEMA, makers)
    return V.laboratory_analysis(t)


def _several_laboratories(spark, sf):
    """The warehouse with a laboratory view of several source ids: the maker's
    number stands for the laboratory (0: unknown maker)."""
    lab = _laboratory_analysis_seeded(spark, sf)
    source = F.coalesce(F.regexp_extract("fabricante", r"^Supplier#0*([1-9][0-9]*)$", 1).try_cast("int"), F.lit(0))
    return _wh(spark, sf) | {"vw_analise_laboratorial": lab.withColumn("source_id", source)}


@query("top_laboratory_of_several")
def _top_laboratory_of_several(spark, sf):
    """K12 over several laboratories, unknown ids among them."""
    return K.top_laboratory(_several_laboratories(spark, sf))


@query("top_laboratories_of_several")
def _top_laboratories_of_several(spark, sf):
    """K14 over several laboratories."""
    return K.top_laboratories(_several_laboratories(spark, sf))


@query("fact_declared")
def _fact_declared(spark, sf):
    """The main fact in its declared columns and types."""
    return as_declared(_wh(spark, sf)["fato_notificacoes"], "fato_notificacoes")


@query("tests_declared")
def _tests_declared(spark, sf):
    """The tests fact in its declared columns and types, record ids made."""
    return as_declared(_wh(spark, sf)["fato_testes_realizados"], "fato_testes_realizados")


@query("cascade_delete")
def _cascade_delete(spark, sf):
    """Notifications flagged as excluded in the raw input are deleted from the
    main fact; the bridges and the tests fact follow (ON DELETE CASCADE)."""
    t = _wh(spark, sf)
    deleted = _raw(spark, sf).filter(F.col("excluido")).select("id_notificacao")
    children = {"fato_notificacao_sintoma": (t["fato_notificacao_sintoma"], "fk_notificacao"),
                "fato_notificacao_condicao": (t["fato_notificacao_condicao"], "fk_notificacao"),
                "fato_testes_realizados": (t["fato_testes_realizados"], "fk_notificacao")}
    kept = Q.cascade_delete(children, deleted, "id_notificacao")
    parent = Q.cascade_delete({"fato_notificacoes": (t["fato_notificacoes"], "id_notificacao")},
                              deleted, "id_notificacao")
    frames = []
    for name, (before, _) in {**children, "fato_notificacoes": (t["fato_notificacoes"], None)}.items():
        after = kept.get(name, parent.get(name))
        both = (before.select(F.lit(1).alias("b"), F.lit(0).alias("a"))
                .unionByName(after.select(F.lit(0).alias("b"), F.lit(1).alias("a"))))
        frames.append(both.agg(F.sum("b").alias("rows_before"), F.sum("a").alias("rows_after")).select(
            F.lit(name).alias("table_name"), "rows_before", "rows_after",
            (F.col("rows_before") - F.col("rows_after")).alias("rows_deleted")))
    return Q.union_all(frames)


# ------------------------------------------------------- A: change audit

def _order_snapshots(spark, sf):
    """Two versions of the whole ``orders`` table (FIXTURES.md D): the key
    rules only decide which rows differ between them (a tenth deleted, a tenth
    inserted, a tenth updated); every order row is read and compared."""
    # the diff's work is after the shuffle on the key: no spreading of the scan
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    old = o.filter(k % 10 != 3)
    new = (o.filter(k % 10 != 4)
           .withColumn("o_orderstatus", F.when(k % 10 == 5, F.lit("X")).otherwise(F.col("o_orderstatus"))))
    return old, new


@query("audit_snapshot_diff")
def _audit_snapshot_diff(spark, sf):
    old, new = _order_snapshots(spark, sf)
    return A.snapshot_diff(old, new, "o_orderkey", "orders")


@query("audit_log_table")
def _audit_log_table(spark, sf):
    """The stored log of the order snapshots, without time and user."""
    old, new = _order_snapshots(spark, sf)
    log = A.write_log(A.snapshot_diff(old, new, "o_orderkey", "orders"), fresh_dir(spark, "audit-log"))
    return log.drop("data_alteracao", "usuario_bd")


@query("audit_change_log")
def _audit_change_log(spark, sf):
    ev = table(spark, sf, "events")
    return A.change_log(ev, "user_id", ["ts", "event_id"], ["event_type", "props"],
                        F.col("event_type") == "error", "events", keep=["event_id"])


@query("audit_stream")
def _audit_stream(spark, sf):
    """The change feed is staged once per session (4 time slices); every run
    starts a new stream with a fresh checkpoint and sink over it."""
    def stage(path):
        feed = table(spark, sf, "events").select(
            "user_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_id", "event_type", "props")
        _FEED_FILES[path] = stage_events(feed, path, slices=4)

    src = _staged(spark, sf, "events-feed", stage)
    sink, ckpt = fresh_dir(spark, "audit-sink"), fresh_dir(spark, "audit-ckpt")
    run_audit_stream(spark, src, sink, ckpt, max_files_per_trigger=_FEED_FILES[src])
    return read_log(spark, sink)


_FEED_FILES: dict[str, int] = {}

FACT_FEED = Feed("id_notificacao long, ts timestamp_ntz, seq int, classificacao_final string, removed boolean",
                 "id_notificacao", ["ts", "seq"], ["classificacao_final"], "removed", "fato_notificacoes", ["seq"])


@query("audit_stream_fact")
def _audit_stream_fact(spark, sf):
    """The audit stream over the main fact: a notification is recorded as
    suspected, gets its class on the notification day, and is removed two days
    later where the raw input flags it as excluded."""
    def stage(path):
        fact = _wh(spark, sf)["fato_notificacoes"].select("id_notificacao", "data_notificacao", "classificacao_final")
        gone = _raw(spark, sf).filter(F.col("excluido")).select(F.col("id_notificacao").alias("gone"))
        day = F.col("data_notificacao").cast("timestamp_ntz")
        step = lambda days, seq, image, removed: F.struct(
            (day + F.make_dt_interval(F.lit(days))).alias("ts"), F.lit(seq).alias("seq"),
            image.alias("classificacao_final"), F.lit(removed).alias("removed"))
        steps = F.array_compact(F.array(
            step(-1, 1, F.lit(labels.SUSPECTED), False), step(0, 2, F.col("classificacao_final"), False),
            F.when(F.col("gone").isNotNull(), step(2, 3, F.col("classificacao_final"), True))))
        feed = (fact.join(gone, F.col("id_notificacao") == F.col("gone"), "left")
                .select("id_notificacao", F.inline(steps)))
        _FEED_FILES[path] = stage_events(feed, path, 3, FACT_FEED.key, time=FACT_FEED.order[0])

    src = _staged(spark, sf, "fact-feed", stage)
    sink, ckpt = fresh_dir(spark, "audit-sink"), fresh_dir(spark, "audit-ckpt")
    run_audit_stream(spark, src, sink, ckpt, max_files_per_trigger=_FEED_FILES[src], feed=FACT_FEED)
    return read_log(spark, sink, FACT_FEED)


@query("kpi_text")
def _kpi_text(spark, sf):
    return K.kpi_summary(_wh(spark, sf), with_text=True)
