from pyspark.sql import functions as F

from vigia import labels
from vigia.functions.fmt import thousands_dot, two_decimals
from vigia.functions.lookup import lookup
from vigia.functions.text import split_literal, strip
from vigia.operators.project import optional_filter, project_existing, rename_columns, with_constant


def test_lookup_with_default(spark):
    df = spark.createDataFrame([(1,), (3,), (7,), (None,)], "k int")
    got = [r[0] for r in df.select(lookup(F.col("k"), labels.LAB_NAMES, labels.LAB_OTHER)).collect()]
    assert got == [labels.LAB_NAMES[1], labels.LAB_NAMES[3], labels.LAB_OTHER, labels.LAB_OTHER]


def test_number_formats(spark):
    df = spark.createDataFrame([(1234567, 47.647827)], "n long, r double")
    row = df.select(thousands_dot(F.col("n")), two_decimals(F.col("r"))).first()
    assert tuple(row) == ("1.234.567", "47.65")


def test_strip_and_split(spark):
    df = spark.createDataFrame([("  a\t",), ("a, b, ",), ("a.b, c",)], "s string")
    assert [r[0] for r in df.select(strip(F.col("s"))).collect()][0] == "a"
    parts = [r[0] for r in df.select(split_literal(F.col("s"), ", ")).collect()]
    assert parts[1] == ["a", "b", ""] and parts[2] == ["a.b", "c"]


def test_projection_helpers(spark):
    df = spark.createDataFrame([(1, "PA", "Belém"), (2, "SP", "Belém"), (3, "PA", "Ananindeua")],
                               "id long, estado_uf string, municipio_nome string")
    assert project_existing(df, ["municipio_nome", "nope", "id"]).columns == ["municipio_nome", "id"]
    assert rename_columns(df, {"id": "key", "nope": "x"}).columns == ["key", "estado_uf", "municipio_nome"]
    # municipality only: same-named places of two states merge, as the source dashboard does
    assert optional_filter(df, estado_uf=labels.ALL, municipio_nome="Belém").count() == 2
    assert optional_filter(df, estado_uf="PA", municipio_nome="Belém").count() == 1
    assert optional_filter(df, estado_uf=None, cidade="x").count() == 3
    assert with_constant(df, "source_id", 1).columns[-1] == "source_id"
    assert with_constant(with_constant(df, "source_id", 1), "source_id", 2).first().source_id == 1


def test_strip_matches_python_strip(spark):
    samples = ["  a ", "\ta\u00a0", "\x1cFebre\x1f", "\u3000Tosse\u2003", "a  b", "", " ", "\n\r x \x0b"]
    assert any(ch != " " and ch.isspace() for ch in "".join(samples))   # real white space, not escapes
    df = spark.createDataFrame([(x,) for x in samples], "s string")
    got = [r[0] for r in df.select(strip(F.col("s"))).collect()]
    assert got == [x.strip() for x in samples]
