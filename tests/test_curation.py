"""Curated lists, standard frames and made-up data against plain Python."""

import hashlib

import pytest
from pyspark.sql import functions as F

from atlasmill.operators import checks as V
from atlasmill.operators import curation as U
from atlasmill.operators import fabricate as B
from atlasmill.operators import hierarchy as H
from atlasmill.operators import standardize as S


def test_contained_names_are_whole_words(spark):
    names = spark.createDataFrame([("Vitamin C",), ("iron",), ("",), (None,)], "name string")
    phrases = spark.createDataFrame([("vitamin-C tablets",), ("environment",), ("Iron",), (None,), ("",)], "phrase string")
    assert {tuple(r) for r in U.contained_names(names, phrases).collect()} == {("Vitamin C", "vitamin-C tablets"), ("iron", "Iron")}


def test_release_diff_examples(spark):
    old = spark.createDataFrame([(i, "a", None) for i in range(20)], "id int, v string, w string")
    new = spark.createDataFrame([(i, "b" if i < 15 else "a", None) for i in range(1, 21)], "id int, v string, w string")
    got = {(r["change"], r["column"]): (r["n"], r["examples"]) for r in U.release_diff(old, new, "id").collect()}
    assert got == {("added", "id"): (1, "20"), ("removed", "id"): (1, "0"), ("changed", "v"): (14, "1|10|11|12|13")}


def test_migrate_raises_on_unknown(spark):
    reviews = spark.createDataFrame([("a", 1), ("b", 2)], "id string, v int")
    known, obsolete = spark.createDataFrame([("a",)], "id string"), spark.createDataFrame([("c", "a")], "id string, replacement string")
    with pytest.raises(ValueError):
        U.migrate(reviews, known, obsolete)


def test_core_ids_raise_on_conflict(spark):
    m = spark.createDataFrame([("a", "x"), ("a", "y")], "id string, core_id string")
    with pytest.raises(ValueError):
        H.core_ids(m)
    assert H.core_ids(m, strict=False).collect() == [("a", "x")]


def test_md5_bucket(spark):
    rows = spark.range(50).select("id", B.md5_bucket("id", 1009).alias("b")).collect()
    assert all(r["b"] == int(hashlib.md5(str(r["id"]).encode()).hexdigest(), 16) % 1009 for r in rows)


def test_reduce_vectors_keeps_short_ones(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0, 0.5]), (2, [2.0, 1.0, 0.1]), (3, [0.5, 0.5, 0.9]), (4, None)], "id int, v array<double>")
    assert {len(r["v"]) for r in S.reduce_vectors(df, "v", 2).collect()} == {2}
    assert S.reduce_vectors(df, "v", 3).count() == 3 and S.reduce_vectors(df.filter("id = 4"), "v", 2).count() == 0


def test_encoder_of_empty_texts(spark):
    df = spark.createDataFrame([("",), (None,), ("a b a",)], "t string").select(S.hashed_encoder("t", 4).alias("v")).collect()
    assert df[0]["v"] == df[1]["v"] == [0.0] * 4 and abs(sum(x * x for x in df[2]["v"]) - 1) < 1e-9


def test_standard_edges_once_and_complete(spark):
    raw = spark.createDataFrame([("a", "p", "b"), ("a", "p", "b"), (None, "p", "b")], "subject string, predicate string, object string")
    assert S.standard_edges(raw, "kg", {}, once=True).count() == 1
    with pytest.raises(ValueError):
        S.dispatch({"x": lambda: raw}, "x", S.PAIR)


def test_file_issues(spark):
    lines = spark.createDataFrame([("id|name\r",), ("1| x",), ("2|y|z",)], "value string")
    got = {r["issue"]: r["n"] for r in V.file_issues(lines, ["id", "name"], "|").collect()}
    assert got == {"carriage_return": 1, "column_count": 1, "outer_space": 1, "header_lines": 1}


def test_descendants_of_a_diamond(spark):
    links = spark.createDataFrame([("b", "a"), ("c", "a"), ("d", "b"), ("d", "c")], "child string, parent string")
    got = {(r["id"], r["depth"]) for r in H.descendants(links, spark.createDataFrame([("a",)], "id string")).collect()}
    assert got == {("a", 0), ("b", 1), ("c", 1), ("d", 2)}
