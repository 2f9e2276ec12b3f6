"""CSV in, warehouse and views out: the file path gives the same answers as
the derived-table path (ids from file position, dates parsed day-first)."""

import pytest
from pyspark.sql import functions as F

from conftest import SMALL_SF
from vigia.plans import views as V
from vigia.plans.etl import build_warehouse
from vigia.session import fresh_dir
from vigia.sources import csv as S
from vigia.sources.fixture import raw_notifications


def test_csv_path_equals_table_path(spark, wh):
    raw = raw_notifications(spark, SMALL_SF)
    path = fresh_dir(spark, "e2e-csv")
    S.write_csv(raw.withColumn("_pos", F.col("id_notificacao")).drop("id_notificacao"), path, order_by="_pos",
                files=3, drop_order_column=True)
    from_csv = build_warehouse(spark, S.read_notifications(spark, path))
    for fn in (V.cases_by_municipality, V.vaccination_by_result, V.frequent_symptoms, V.epidemiological_profile,
               V.laboratory_analysis, V.positivity_rate):
        a = sorted(map(tuple, fn(from_csv.tables).collect()))
        b = sorted(map(tuple, fn(wh.tables).collect()))
        assert a == b, fn.__name__
    assert from_csv.rows["raw"] == wh.rows["raw"]


def test_cli_etl_then_report(spark, capsys):
    import json as _json

    from vigia import cli
    from vigia.plans.etl import load_warehouse

    raw = raw_notifications(spark, SMALL_SF)
    src = fresh_dir(spark, "cli-csv")
    S.write_csv(raw.withColumn("_pos", F.col("id_notificacao")).drop("id_notificacao"), src, order_by="_pos",
                drop_order_column=True)
    out = fresh_dir(spark, "cli-wh")
    types = fresh_dir(spark, "cli-seed")
    spark.createDataFrame([(1, "RT-PCR"), (2, "Antigen")], "id_tipo_teste int, descricao_tipo_teste string").write.parquet(types)
    for wrong in ("dim_tipos_testes", f"dim_raca_cor={types}"):
        with pytest.raises(SystemExit):
            cli.main(["etl", "--csv", src, "--out", out, "--seed", wrong])
    cli.main(["etl", "--csv", src, "--out", out, "--seed", f"dim_tipos_testes={types}"])
    assert load_warehouse(spark, out)["dim_tipos_testes"].count() == 2
    etl = _json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert etl["rows"]["raw"] == 1500
    cli.main(["report", "--warehouse", out, "--state", "AM"])
    rep = _json.loads(capsys.readouterr().out)
    assert rep["kpi"]["total_notificacoes"] > 0 and all(r["estado_uf"] == "AM" for r in rep["confirmed_by_state"])
    # the reopened warehouse keeps its bucket layout
    from planutil import plan_text
    wh = load_warehouse(spark, out)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_text(V.laboratory_analysis(wh.tables), "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("Bucketed: true") == 2


def test_cli_append_and_delete(spark, capsys):
    import json as _json

    from vigia import cli
    from vigia.plans.etl import load_warehouse

    raw = raw_notifications(spark, SMALL_SF).withColumn("_pos", F.col("id_notificacao"))
    parts = []
    for half in ("_pos % 2 = 0", "_pos % 2 = 1"):
        parts.append(fresh_dir(spark, "cli-csv"))
        S.write_csv(raw.filter(half).drop("id_notificacao"), parts[-1], order_by="_pos", drop_order_column=True)
    out, ids = fresh_dir(spark, "cli-wh"), fresh_dir(spark, "cli-ids")
    cli.main(["etl", "--csv", parts[0], "--out", out])
    first = load_warehouse(spark, out)
    before, top = (first["fato_notificacoes"].agg(F.count("*"), F.max("id_notificacao")).first())
    with pytest.raises(SystemExit):
        cli.main(["etl", "--csv", parts[1], "--out", out, "--load", "odd"])
    for _ in range(2):  # a repeated load adds nothing
        cli.main(["etl", "--csv", parts[1], "--out", out, "--append", "--load", "odd"])
    both = load_warehouse(spark, out)
    total = both["fato_notificacoes"].count()
    assert total == raw.filter("dataNotificacao is not null").count() > before
    spark.range(top + 1, top + 4).withColumnRenamed("id", "id_notificacao").write.parquet(ids)
    gone = both["fato_notificacoes"].filter(F.col("id_notificacao").between(top + 1, top + 3)).count()
    capsys.readouterr()
    cli.main(["delete", "--warehouse", out, "--ids", ids])
    said = _json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    last = load_warehouse(spark, out)
    assert last.version == said["version"] and said["folders"]["fato_notificacoes"]["kept"] > 0
    assert gone > 0 and last["fato_notificacoes"].count() == total - gone
    for w in (first, both, last):
        w.close(spark)
