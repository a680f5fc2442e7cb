"""Readers, source rules, made-up datasets, search and walks."""

import json
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from atlasmill.functions import closure
from atlasmill.functions.lineage import materialize, shared_dir
from atlasmill.functions.ranks import ordered_totals
from atlasmill.operators import fabricate, graph, ontology, source_maps, tuning, walks
from atlasmill.operators.comparison import POISSON
from atlasmill.sources import tables


def test_zipped_json_and_triples(spark, tmp_path):
    for k in range(2):
        with zipfile.ZipFile(tmp_path / f"{k}.zip", "w") as z:
            z.writestr("in.json", json.dumps({"a": {"b": [{"x": k, "y": "é\n"}, {"x": k + 10}]}}))
    got = tables.read_zipped_json(spark, f"{tmp_path}/*.zip", "in.json", "a.b")
    assert sorted((r.x, r.y) for r in got.fillna("", ["y"]).collect()) == [(0, "é\n"), (1, "é\n"), (10, ""), (11, "")]
    (tmp_path / "t.nt").write_text('<a:1> <p> "say \\"hi\\""@en .\n# note <a> <b> <c> .\n\n_:b <q> <a:2> .\n<a:3> <p> "4"^^<int> .\n')
    assert [tuple(r) for r in tables.read_triples(spark, str(tmp_path / "t.nt")).collect()] == [("a:1", "p", 'say "hi"'), ("_:b", "q", "a:2"), ("a:3", "p", "4")]


def test_most_specific_category_without_a_join(spark):
    depths = {"a": 0, "b": 1, "c": 1}
    rows = spark.createDataFrame([(1, ["a", "c", "b"]), (2, ["x"]), (3, None), (4, [])], "id int, cats array<string>")
    got = rows.select("id", source_maps.most_specific_of(F.col("cats"), depths).alias("c")).collect()
    assert {r.id: r.c for r in got} == {1: "b", 2: None, 3: None, 4: None}


def test_closure_goes_on_and_cycles_end(spark, monkeypatch):
    chain = spark.createDataFrame([(k, k + 1) for k in range(45)], "child long, parent long")
    assert closure.closure(chain).count() == 45 * 46 // 2
    assert closure.closure(chain, max_depth=3).count() == 45 + 44 + 43
    ring = spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "child long, parent long")
    assert closure.closure(ring).count() == 6
    monkeypatch.setattr(closure, "LEVELS", 10)
    with pytest.raises(RuntimeError):
        closure.closure(chain)


def test_running_totals_over_ranges(spark):
    rows = [(k * 7 % 101, k % 5) for k in range(101)]
    got = ordered_totals(spark.createDataFrame(rows, "o long, v long").repartition(6), [F.col("o").asc()], {"t": "v"}).collect()
    upto = 0
    for o, v in sorted(rows):
        assert next(r.t for r in got if r.o == o) == upto
        upto += v


def test_instructions(spark):
    plan = {"a": {"num_rows": 5, "columns": {"id": {"type": "id", "prefix": "A"}, "n": {"type": "normal", "mean": 0, "deviation": 1}, "d": {"type": "day", "first": "2024-01-01", "last": "2024-01-03"}, "_c": {"type": "copy", "column": "id"}}}, "b": {"num_rows": "@a.num_rows", "columns": {"x": {"type": "reference", "from": "a.id", "in_order": True}, "y": {"type": "bucket", "column": "x", "buckets": 3}}}}
    made = fabricate.datasets(spark, plan)
    assert sorted(r.x for r in made["b"].collect()) == [f"A{k}" for k in range(1, 6)] and made["a"].columns == ["id", "n", "d", "_c"]
    assert sorted(map(str, made["a"].collect())) == sorted(map(str, fabricate.datasets(spark, plan)["a"].repartition(3).collect()))
    with pytest.raises(ValueError, match="circle"):
        fabricate.evaluation_order({"a": {"num_rows": "@b.num_rows", "columns": {}}, "b": {"num_rows": "@a.num_rows", "columns": {}}})
    with pytest.raises(ValueError, match="unknown"):
        fabricate.evaluation_order({"a": {"num_rows": "@z.num_rows", "columns": {}}})


def test_gaussian_search_nears_the_best_of_a_grid():
    f = lambda p: -((p["x"] - 0.3) ** 2) - (p["y"] - 7) ** 2 / 50 + 0.02 * np.cos(20 * p["x"])
    best, value, tried = tuning.gaussian_search(lambda batch: [f(p) for p in batch], {"x": (0, 1), "y": (0, 10)}, calls=32, seed=3)
    grid = max(f({"x": a, "y": b}) for a in np.linspace(0, 1, 101) for b in np.linspace(0, 10, 101))
    drawn = max(v for _, v in tried[:4])
    assert len(tried) == 32 and f(best) == value > drawn and value > grid - 0.02


def test_walk_vectors_tell_two_groups_apart(spark):
    edges = [(f"{g}{i}", f"{g}{j}") for g in "ab" for i in range(8) for j in range(i)] + [("a0", "b0")]
    found = walks.random_walks(spark.createDataFrame(edges, "u string, v string"), 8, 10, 1)
    vectors = {r.id: np.array(r.embedding) for r in walks.walk_vectors(found, 8, 3, 1, 1).collect()}
    cos = lambda x, y: float(vectors[x] @ vectors[y] / np.linalg.norm(vectors[x]) / np.linalg.norm(vectors[y]))
    inside = [cos(f"{g}{i}", f"{g}{j}") for g in "ab" for i in range(1, 8) for j in range(1, i)]
    across = [cos(f"a{i}", f"b{j}") for i in range(1, 8) for j in range(1, 8)]
    assert len(vectors) == 16 and np.mean(inside) > np.mean(across)


def test_consensus_and_unknown_strategy(spark):
    rows = spark.createDataFrame([("a", 0.5), ("a", 5.0), ("a", 0.7), ("b", 3e5), ("c", 20000.0)], "id string, v double")
    of = lambda s: {r.id: r.prevalence for r in ontology.prevalence_consensus(rows, "id", "v", s).collect()}
    assert of("mean") == {"a": "1-9 in 100,000", "b": "UNCLEAR", "c": "20000.00 in 100,000"}
    assert of("mode")["a"] == "<1 in 100,000" == of("lowest")["a"]
    with pytest.raises(ValueError):
        of("best")


def test_no_shared_folder_is_an_error_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(RuntimeError, match="checkpoint"):
        shared_dir(Session())
    assert materialize(spark.range(3), "three").count() == 3


def test_poisson_shares_and_repeated_edges(spark):
    assert abs(POISSON[0] - 0.36787944) < 1e-8 and 1 - POISSON[-1] < 1e-7 and POISSON == sorted(POISSON)
    edges = spark.createDataFrame([("a", "p", "b")] * 3 + [("a", "p", "c")], "subject string, predicate string, object string")
    mapping = spark.createDataFrame([("a", ("A", ["x"]))] * 2, "id string, normalization_struct struct<normalized_id: string, normalized_categories: array<string>>")
    assert sorted((r.subject, r.object, r.subject_normalization_success) for r in graph.normalize_edges(edges, mapping).collect()) == [("A", "b", True), ("A", "c", True)]
