import pytest
from pyspark.sql import functions as F

from atlasmill.contracts import EDGE, NODE, ContractError, validate
from atlasmill.functions.closure import closure
from atlasmill.functions.components import connected_components
from atlasmill.functions.ranks import dense_position, key_text
from atlasmill.operators import graph, ranking
from atlasmill.sources import tables


def test_components_of_chains_repeats_and_nulls(spark):
    rows = [(k, k + 1) for k in range(30)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(rows, "u long, v long")).collect()))
    assert got == {k: 0 for k in range(31)} | {100: 100, 101: 100}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_closure_keeps_shortest_depth_and_ends_on_cycles(spark):
    got = {(r[0], r[1]): r[2] for r in closure(spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c"), ("c", "a")], "child string, parent string")).collect()}
    assert got[("a", "c")] == 1 and got[("b", "a")] == 2 and ("a", "a") not in got


def test_dense_position_is_gapless_with_a_hot_key_and_nulls(spark):
    df = spark.range(500).select(F.when(F.col("id") % 3 > 0, "hot").alias("k"), F.col("id")).withColumn("kk", key_text("k"))
    rows = dense_position(df, "kk", ["id"], "pos", 8).collect()
    for key in {r.kk for r in rows}:
        own = sorted(r.pos for r in rows if r.kk == key)
        assert own == list(range(len(own)))


def test_rank_rows_equals_row_number(spark):
    df = spark.range(300).select(F.col("id"), (F.col("id") * 37 % 11).alias("s"))
    got = {r.id: r.r for r in graph.rank_rows(df, [F.desc("s"), F.col("id")], "r").collect()}
    want = {k: n for n, k in enumerate(sorted(range(300), key=lambda k: (-(k * 37 % 11), k)))}
    assert got == want


def test_null_conditions_drop_rows(spark):
    df = spark.createDataFrame([("a", ["x"]), (None, None), ("b", [])], "c string, l array<string>")
    assert [r.c for r in df.filter(graph.drop_values("c", ["a"])).collect()] == ["b"]
    assert [r.c for r in df.filter(graph.keep_any("l", ["x"])).collect()] == ["a"]


def test_contracts(spark):
    df = spark.createDataFrame([("a", "c", ["c"]), ("a", "c", ["c"])], "id string, category string, all_categories array<string>")
    validate(df, NODE)
    with pytest.raises(ContractError, match="unique"):
        validate(df, NODE, data=True)
    with pytest.raises(ContractError, match="subject"):
        validate(df, EDGE)


def test_auroc_of_ties_and_single_class(spark):
    df = spark.createDataFrame([(1.0, 1), (1.0, 0), (0.0, 0)], "score double, y int")
    assert ranking.auroc(df).first()[0] == 0.75
    assert ranking.auroc(df.filter("y = 1")).first()[0] == 0.5


def test_collapse_uses_unknown_for_a_null_source(spark):
    df = spark.createDataFrame([("a", "p", "b", None, 1, 5, "x"), ("a", "p", "b", "s", 2, None, "y")], "subject string, predicate string, object string, primary_knowledge_source string, num_references long, num_sentences long, publication string")
    row = graph.collapse_edges(df).first()
    assert (row.num_references, row.num_sentences, row.sources) == (3, 5, ["s", "unknown"])


def test_sources(spark, tmp_path):
    assert tables.expand_braces("a/{0..2}/b{x,y}") == ["a/0/bx", "a/0/by", "a/1/bx", "a/1/by", "a/2/bx", "a/2/by"]
    assert tables.best_version(["1.2.0", "1.10.1", "2.0.0"], "1") == "1.10.1"
    assert tables.load(spark, str(tmp_path / "none"), schema="a long", empty_if_missing=True).count() == 0
    df = spark.createDataFrame([(1, ["a", "b"])], "id long, l array<string>")
    tables.write_tsv(tables.to_kgx(df, ["id", "l"]), str(tmp_path / "out"))
    assert tables.read_tsv(spark, str(tmp_path / "out")).first().l == "a\x1fb"
