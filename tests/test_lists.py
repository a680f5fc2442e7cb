"""Edge cases of list operators, reports and projections."""

import duckdb
import pytest
from pyspark.sql import functions as F

from atlasmill import registry
from atlasmill.operators import lists as L
from atlasmill.operators import ontology
from atlasmill.operators import pairs as X
from atlasmill.operators import resolution as N


def test_typed_refuses_bad_cells(spark):
    df = spark.createDataFrame([("1",), ("x",)], "a string")
    with pytest.raises(Exception, match="a is no int"):
        L.typed(df, {"a": "int"}, []).collect()
    with pytest.raises(Exception, match="a is missing"):
        L.typed(spark.createDataFrame([("",)], "a string"), {"a": "int"}, ["a"]).collect()


def test_licence_numbers(spark):
    df = spark.createDataFrame([("BLA 0012",), ("none",), ("000",), (None,), ("",)], "n string")
    assert [r[0] for r in df.select(L.bla_number("n")).collect()] == ["12", None, "0", None, None]


def test_tokens_without_repair(spark):
    df = spark.createDataFrame([("A b|C",), (None,)], "t string")
    assert [r[0] for r in df.select(L.clean_tokens("t", repair=False)).collect()] == ["c", ""]


def test_report_names_differ():
    with pytest.raises(ValueError, match="differ"):
        X.reports(None, [("a", None), ("a", None)])


def test_projection_keeps_rows(spark):
    d = "/root/testdata/sf0.001"
    got = registry.queries()["emb_06_projection"](spark, d).toPandas()
    assert len(got) == spark.read.parquet(f"{d}/embeddings.parquet").filter("embedding is not null").count()
    assert got.x.var() >= got.y.var() > 0


def test_resolver_must_answer_all(spark):
    keys = spark.createDataFrame([("a",), (None,), ("a",)], "k string")
    assert [tuple(r) for r in N.resolve_batches(keys, "k", lambda ks: [x + "!" for x in ks], 1).collect()] == [("a", "a!")]
    with pytest.raises(Exception, match="0 answers to 1 keys"):
        N.resolve_batches(keys, "k", lambda ks: [], 1).collect()


def test_prevalence_prints_what_is_stored(spark):
    values = [k * 0.025 for k in range(400_001, 400_101, 6)] + [10000.125, 10000.375, 9.0]
    got = spark.createDataFrame([(x,) for x in values], "v double").select("v", ontology.prevalence_band(F.col("v")).alias("b")).collect()
    assert [r.b for r in got] == [f"{r.v:.2f} in 100,000" if r.v >= 10000 else "1-9 in 100,000" for r in got]
    few = spark.createDataFrame([("a", 150_000.0), ("a", 250_000.0)], "id string, v double")
    bands = [ontology.prevalence_consensus(few, "id", "v", unclear_above=x).first().prevalence for x in (100_000, None)]
    assert bands == ["UNCLEAR", "200000.00 in 100,000"]


HALF = [321727, 5072978, 2391667, 1361371]  # tenths whose mean is 228693.575; doubles added in this order print 57, in the other 58, as their exact mean


def test_mean_adds_in_the_order_asked_for(spark):
    rows = [(k, i, x / 1e6 * 1e5) for k, xs in (("a", HALF), ("b", HALF[::-1]), ("c", [5e6])) for i, x in enumerate(xs)] + [("a", 9, None), ("d", 0, None)]
    table = spark.createDataFrame(rows, "id string, i long, v double").repartition(3, "v")
    of = lambda **x: {r.id: r.prevalence for r in ontology.prevalence_consensus(table, "id", "v", unclear_above=None, **x).collect()}
    said = lambda *x: {k: v and f"{v} in 100,000" for k, v in zip("abcd", (*x, "500000.00", None), strict=True)}
    assert of(order=["i"]) == said("228693.57", "228693.58")
    assert of() == said("228693.58", "228693.58")
    assert {r.prevalence for r in ontology.prevalence_consensus(table, "id", "v", order=["i"]).filter("id < 'd'").collect()} == {"UNCLEAR"}


def test_prevalence_prints_as_its_sql_in_row_order(spark, tmp_path):
    path = str(tmp_path / "lineitem.parquet")
    lines = [(s, x, 1) for s, xs in ((1, HALF), (2, HALF[::-1]), (3, [7])) for x in xs]
    spark.createDataFrame(lines, "l_suppkey long, l_orderkey long, l_linenumber int").coalesce(1).write.parquet(path)
    c = duckdb.connect(config={"threads": 1})
    c.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{path}/*.parquet'")
    got = registry.queries()["ent_33_prevalence"](spark, str(tmp_path))
    assert sorted(map(tuple, got.collect())) == sorted(c.execute(registry.oracle_sql()["ent_33_prevalence"]).fetchall())
