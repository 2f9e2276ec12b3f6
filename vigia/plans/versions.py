"""Changes of a published warehouse (Q5, D8, S6): each makes a new version.

A version is a pointer that names the folders of every table
(``etl.publish``).  A change writes only the folders it must and names the
others again, so nothing a reader has open is touched, and a change that fails
leaves no trace:

* ``delete_notifications`` (Q5, ON DELETE CASCADE): copy-on-write.  Only groups
  of buckets that hold a deleted notification are rewritten, in the main fact
  and everything that refers to it; the stage too, so that deleted persons are
  gone from all tables of the version.
* ``append_notifications`` (S6, D8): a further load.  Known dimension values
  keep their ids, new ones follow the largest; the rows of the load are written
  into folders of their own beside those already there.

Both keep the layout: one bucket is read by one task from however many
folders, so the joins of the views stay without a shuffle.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.joins import fits
from ..operators import clean as C
from ..operators import dims as D
from ..operators import facts as J
from ..operators import quality as Q
from ..operators.reshape import explode_multivalue, test_fact
from ..session import delete_path, shared_dir
from .etl import (BUCKETED, DIMENSIONS, FACTS, INDICATORS, PART, SEEDS, Warehouse, _Steps, bucket_group, load_warehouse,
                  open_parts, open_tables, publish, published_runs)
from .views import indicator_table

ID = "id_notificacao"


class VersionConflict(RuntimeError):
    """Another version was published since the one a change started from."""


def _next(base: Warehouse, root: str | None) -> Warehouse:
    """A version after ``base`` that so far names the same folders."""
    home = (root or base.root).rstrip("/")
    return Warehouse(home, buckets=base.buckets, median_age=base.median_age,
                     run=f"{home}/runs/{time.time_ns():020d}-{uuid.uuid4().hex[:8]}", paths=dict(base.paths),
                     parts={n: list(p) for n, p in base.parts.items()}, schemas=dict(base.schemas), loads=list(base.loads))


@contextmanager
def _bucketed_scans(spark: SparkSession):
    """Tables read as buckets even where no operator asks for it (a write)."""
    key = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, old)


def _change(spark: SparkSession, base: Warehouse, root: str | None, work: Callable[[Warehouse], None]) -> Warehouse:
    """Run ``work`` on the next version and publish it; on any failure its
    folders and catalog entries go and the published version stays."""
    wh = _next(base, root)
    try:
        with _bucketed_scans(spark):
            work(wh)
        newest = published_runs(spark, wh.root)[-1:]
        if wh.root == base.root and newest != [base.version]:
            raise VersionConflict(f"{wh.root}: {newest} was published after {base.version}")
        publish(spark, wh)
    except BaseException:
        wh.close(spark)
        delete_path(spark, wh.run)
        raise
    return wh


def _group_of(folder: str) -> int:
    return int(folder.rsplit(f"{PART}=", 1)[1])


def delete_notifications(spark: SparkSession, base: Warehouse, deleted: DataFrame, root: str | None = None) -> Warehouse:
    """Q5 on the stored warehouse: the notifications whose ids ``deleted``
    holds (column ``id_notificacao``; repeated, unknown and NULL ids are
    allowed) leave the main fact, and with them their rows in the bridges, the
    tests fact and the stage.

    Folders of groups without a deleted notification are named again as they
    are.  Without any known id ``base`` itself is returned.  The indicator
    table is computed anew; dimensions stay (the source system deletes none).
    ``root`` publishes the version elsewhere, sharing the folders."""
    shared_dir(spark)
    id_type = dict(base["fato_notificacoes"].dtypes)[ID]
    ids = deleted.select(F.col(ID).cast(id_type).alias("_del")).where("_del is not null").distinct()
    with _bucketed_scans(spark):
        # one narrow scan of the fact's ids; the ids to delete are the side that moves
        known = base["fato_notificacoes"].select(F.col(ID).alias("_del")).join(
            ids.repartition(base.buckets, "_del"), "_del", "left_semi").checkpoint(eager=True)
    # at most MAX_GROUPS numbers
    groups = {r[0] for r in known.select(bucket_group(F.col("_del"), base.buckets)).distinct().collect()}
    if not groups:
        return base

    def work(wh: Warehouse) -> None:
        st = _Steps(spark, wh)
        keys = F.broadcast(known) if fits(known, 200_000) else known.repartition(wh.buckets, "_del")
        for name, (sub, key) in BUCKETED.items():
            touched = [p for p in wh.parts[name] if _group_of(p) in groups]
            kept = [p for p in wh.parts[name] if _group_of(p) not in groups]
            if touched:
                tname = f"{st.prefix}_{name}_before"
                wh.catalog.append(tname)
                old = open_parts(spark, tname, wh.schemas[name], key, wh.buckets, touched, f"{wh.run}/{sub}_before")
                st.put(name, old.join(keys, F.col(key) == F.col("_del"), "left_anti"), f"{wh.run}/{sub}", bucket_by=key)
                wh.parts[name] = kept + wh.parts[name]
        # rows of an earlier quarantine that belong to a deleted person go too
        for name in [n for n in wh.parts if n not in BUCKETED]:
            key = BUCKETED[name.removeprefix("_quarantine_")][1]
            rows = base[name].join(keys, F.col(key) == F.col("_del"), "left_anti")
            st.put(name, rows, f"{wh.run}/{name}", bucket_by=key)
        open_tables(spark, wh)
        st.put(INDICATORS[0], indicator_table(wh.tables), f"{wh.run}/{INDICATORS[0]}")

    return _change(spark, base, root, work)


def append_notifications(spark: SparkSession, base: Warehouse, raw: DataFrame, load: str | None = None,
                         renumber: bool = False, root: str | None = None) -> Warehouse:
    """S6 + D8: a further load into a published warehouse.

    Known dimension values keep their ids and rows; new ones follow in order of
    appearance.  Symptoms, conditions, races and outcomes so get the ids that
    one load of everything would give if the new notification ids are the
    larger ones (localities may be numbered otherwise: one load stacks all
    residences before all places of notification).  Missing ages take the
    median of the published version, so no stored row changes.

    ``renumber`` adds the largest known id to the ids of ``raw`` (file
    positions start from 1 in every load).  All rules of the load gate hold for
    the whole of both loads: an id that is already there raises.  ``load``
    names the load: one that a version already holds is not loaded again and
    ``base`` is returned, so a failed job can just be repeated."""
    shared_dir(spark)
    if load is not None and load in base.loads:
        return base

    def work(wh: Warehouse) -> None:
        st, t, r = _Steps(spark, wh), wh.tables, wh.rows
        rows = raw
        if renumber:
            # the stage holds every id; one narrow aggregate
            top = base["fato_notificacoes"].agg(F.coalesce(F.max(ID), F.lit(0))).first()[0]
            rows = raw.withColumn(ID, F.col(ID) + F.lit(top))
        read = Observation("raw")
        staged = C.clean_deferring_median(rows, read).repartition(wh.buckets, ID)
        before = wh.parts["clean"]
        stage = st.put("clean", staged, f"{wh.run}/{BUCKETED['clean'][0]}", bucket_by=ID)
        if wh.schemas["clean"] != base.schemas["clean"]:
            raise ValueError("the load's columns are not those of the warehouse")
        wh.parts["clean"] = before + wh.parts["clean"]
        r["raw"] = int(read.get.get("rows_read", 0))
        r["dropped_without_date"] = int(read.get.get("rows_without_date") or 0)
        clean = C.impute_age_with(stage, wh.median_age)
        symptoms = explode_multivalue(clean, "sintomas", "nome_sintoma", keep_position=True)
        conditions = explode_multivalue(clean, "condicoes", "nome_condicao", keep_position=True)
        race = clean.select(F.col("racaCor").alias("descricao_raca_cor"), ID)
        outcome = clean.select(F.col("evolucaoCaso").alias("descricao_evolucao"), ID)
        extended = {
            "dim_localidades": D.extend_localities(base["dim_localidades"], clean),
            "dim_sintomas": D.extend_dimension(base["dim_sintomas"], symptoms, "nome_sintoma", "id_sintoma", [ID, "pos"]),
            "dim_condicoes": D.extend_dimension(base["dim_condicoes"], conditions, "nome_condicao", "id_condicao", [ID, "pos"]),
            "dim_raca_cor": D.extend_dimension(base["dim_raca_cor"], race, "descricao_raca_cor", "id_raca_cor", [ID]),
            "dim_evolucao_caso": D.extend_dimension(base["dim_evolucao_caso"], outcome, "descricao_evolucao",
                                                    "id_evolucao", [ID]),
        }
        for name in DIMENSIONS:
            st.put(name, extended[name], f"{wh.run}/{name}")
        added = {
            "fato_notificacoes": J.fact_notifications(
                clean, t["dim_localidades"], t["dim_raca_cor"], t["dim_evolucao_caso"],
                dim_rows={"loc": r["dim_localidades"], "race": r["dim_raca_cor"], "outcome": r["dim_evolucao_caso"]}),
            "fato_notificacao_sintoma": J.bridge_symptoms(clean, t["dim_sintomas"], r["dim_sintomas"]),
            "fato_notificacao_condicao": J.bridge_conditions(clean, t["dim_condicoes"], r["dim_condicoes"]),
            "fato_testes_realizados": test_fact(clean),
        }
        for name in FACTS:
            before, (sub, key) = wh.parts[name], BUCKETED[name]
            st.put(name, added[name], f"{wh.run}/{sub}", bucket_by=key)
            wh.parts[name] = before + wh.parts[name]
        open_tables(spark, wh)
        st.put(INDICATORS[0], indicator_table(t), f"{wh.run}/{INDICATORS[0]}")
        # rules of a row were counted for the rows of this load; keys hold over all rows
        Q.gate(Q.load_gate_violations({n: t[n] for n in DIMENSIONS + SEEDS + INDICATORS + FACTS}, r), mode="fail")
        if load is not None:
            wh.loads.append(load)

    return _change(spark, base, root, work)


def changed_folders(old: Warehouse, new: Warehouse) -> dict[str, tuple[int, int]]:
    """For each bucketed table of two versions: folders both name, folders only
    the new one names."""
    return {n: (len(set(new.parts[n]) & set(old.parts[n])), len(set(new.parts[n]) - set(old.parts[n]))) for n in new.parts}


__all__ = ["VersionConflict", "append_notifications", "changed_folders", "delete_notifications", "load_warehouse"]
