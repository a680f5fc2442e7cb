"""Operators on training data whose results have no SQL form, and their edge cases."""

import hashlib
import re

from atlasmill import registry
from atlasmill.operators import training as M


def test_ensemble_learns(spark):
    found = {r["split"]: r for r in registry.queries()["mdl_15_ensemble"](spark, "/root/testdata/sf0.001").collect()}
    assert found["TEST"]["accuracy"] > 0.9 and found["TEST"]["macro_f1"] > 0.9


def test_empty_truth_retains_all(spark):
    nodes = spark.createDataFrame([("a", ["x"])], "id string, all_categories array<string>")
    pairs = spark.createDataFrame([], "source string, target string, y int")
    kept, ratios = M.valid_pairs(nodes, pairs, ["x"])
    assert kept.count() == 0 and set(ratios.first()) == {1.0}


def test_scaler_without_spread(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert [r["v"] for r in M.scale(df, M.fit_scaler(df, ["v"])).collect()] == [0.0, 0.0]


def test_missing_source_column_keeps_all(spark):
    pairs = spark.createDataFrame([("a", "b"), ("a", "b")], "source string, target string")
    assert M.from_sources(pairs, ["kg"]).count() == 2


def test_replacements_are_found_without_tries(spark):
    rows = [(f"d{k}", "t0", 1) for k in range(6)] + [(f"d{k}", "t1", 1) for k in (0, 1, 4, 5)] + [("d2", f"t{k}", 1) for k in range(2, 9)] + [("d3", "t5", 0)]
    known = spark.createDataFrame(rows, "source string, target string, y int")
    drugs, diseases = sorted({r[0] for r in rows}), sorted({r[1] for r in rows})
    got = M.replacement_sample(known, spark.createDataFrame([(x,) for x in drugs], "source string"), spark.createDataFrame([(x,) for x in diseases], "target string"), 3, 8)
    assert set(re.findall(r"explode\(sequence\(([^,]*),", got._jdf.queryExecution().analyzed().toString())) == {"1"}  # copies from 1 on, no draws from 0 on

    def first(end, names, s, t, copy):
        return int(int(hashlib.md5(f"8|{end}|{s}|{t}|{copy}".encode()).hexdigest()[:8], 16) / 2**32 * len(names))

    pairs, want = {r[:2] for r in rows}, []
    for s, t, y in rows:
        for copy in (1, 2, 3) if y else ():
            for end, names in (("source", drugs), ("target", diseases)):
                at = first(end, names, s, t, copy)
                tried = [names[(at + k) % len(names)] for k in range(len(names))]
                free = [p for p in ((x, t) if end == "source" else (s, x) for x in tried) if p not in pairs]
                want += [(end, copy, *free[0])] if free else []
    assert sorted(map(tuple, got.collect())) == sorted(want)
