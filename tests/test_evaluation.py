"""Statistics of rankings against closed forms, and the errors that tables raise."""

import hashlib
import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from atlasmill import registry
from atlasmill.functions import resample
from atlasmill.operators import comparison as C
from atlasmill.operators import evaluation as E
from atlasmill.operators import pairs as M
from atlasmill.operators import ranking as R
from atlasmill.plans import comparison as plans

PAIRS = "source string, target string, score double"


def test_incomplete_beta_closed_forms():
    for x in (0.01, 0.3, 0.5, 0.77, 0.99):
        assert math.isclose(E.incomplete_beta(x, 1.0, 3.0), 1 - (1 - x) ** 3, rel_tol=1e-10)
        assert math.isclose(E.incomplete_beta(x, 4.0, 1.0), x**4, rel_tol=1e-10)
        assert math.isclose(E.incomplete_beta(x, 0.5, 0.5), 2 / math.pi * math.asin(math.sqrt(x)), rel_tol=1e-9)


def test_correlation_pvalue_with_two_degrees_of_freedom():
    r, n = 0.6, 4
    t = r * math.sqrt((n - 2) / (1 - r * r))
    assert math.isclose(E.correlation_pvalue(r, n), 1 - t / math.sqrt(2 + t * t), rel_tol=1e-9)
    assert E.correlation_pvalue(1.0, 5) == 0.0 and E.correlation_pvalue(0.3, 2) is None


def test_hypergeometric_tail():
    for k in range(0, 7):
        want = sum(math.comb(6, i) * math.comb(14, 6 - i) for i in range(k, 7)) / math.comb(20, 6)
        assert math.isclose(E.hypergeometric_tail(k, 20, 6, 6), want, rel_tol=1e-9)


def test_rank_commonality():
    assert E.rank_commonality(-0.5, 0.5) == 0.5 and E.rank_commonality(None, 0.5) is None and E.rank_commonality(0.0, 0.0) is None


def test_empty_rankings(spark):
    none = spark.createDataFrame([], "source string, target string, rank long")
    assert E.spearman_at(none, none, 5).first() == (None, None)
    assert E.hypergeometric_at(none, none, 5).first() == (None, None)


def test_errors(spark):
    one = spark.createDataFrame([("a", "b", 0.5)], PAIRS)
    with pytest.raises(ValueError):
        C.same_rows(one, one.drop("score"))
    with pytest.raises(ValueError):
        M.transform(one, "unheard")
    with pytest.raises(ValueError):
        M.scores_at_ranks(M.transform(one, "none"), [2])
    assert C.same_rows(one, one.select("score", "target", "source"))


def test_groups_are_ranked_apart(spark):
    rows = [("g", f"t{i}", float(i)) for i in range(50)] + [("h", "t", 1.0)]
    df = spark.createDataFrame(rows, PAIRS)
    from pyspark.sql import functions as F

    got = {(r["source"], r["target"]): r["n"] for r in C.rank_within(df, ["source"], [F.desc("score")], "n").collect()}
    assert got[("g", "t49")] == 1 and got[("g", "t0")] == 50 and got[("h", "t")] == 1


def test_redrawn_is_a_bootstrap_without_a_limit(spark):
    rows = [(g, "s", f"t{k}", k + 1) for g, n in (("a", 1), ("b", 40)) for k in range(n)]
    known = spark.createDataFrame(rows, "model string, source string, target string, rank long")
    got = C.redrawn(known, ["model"], [F.col("rank")], 400, 7).collect()
    drawn = Counter()
    for r in got:
        drawn[r.model, r.resample] += r.copies
    assert drawn == {(g, k): n for g, n in (("a", 1), ("b", 40)) for k in range(400)}
    assert max(r.copies for r in got) > 5
    assert abs(sum(r.copies * r["rank"] for r in got if r.model == "b") / 16000 - 20.5) < 0.4


def test_heads_of_digests():
    for prefix in (b"", b"7|3|one|2|", b"x" * 51, b"y" * 70):
        for first, last in ((0, 101), (9_995, 10_003), (9_999_999_995, 10_000_000_003)):
            want = [int(hashlib.md5(prefix + str(k).encode()).hexdigest()[:8], 16) for k in range(first, last)]
            assert resample.md5_heads(prefix, first, last).tolist() == want


def test_recall_is_drawn_without_rows_of_draws(spark):
    rows = [(g, "s", f"t{k}", 3 * k + 1, k % 3 > 0) for g, n in (("a", 2), ("b", 90)) for k in range(n)]
    ranked = spark.createDataFrame(rows, "model string, source string, target string, rank long, positive boolean")
    got = C.redrawn_recall(ranked, ["model"], 200, 9, 6, 7)
    assert "Generate explode(sequence" not in got._jdf.queryExecution().toString()
    drawn = C.redrawn(ranked.filter("positive"), ["model"], [F.col("rank")], 6, 7)
    want = C.recall_curve(drawn, ["model", "resample"], 200, 9, weight=F.col("copies"))
    key = lambda df: {(r.model, r.resample, round(r.n, 6)): round(r.recall, 9) for r in df.collect()}
    assert key(got) == key(want) and len(key(got)) == 2 * 6 * 9


@pytest.mark.parametrize("sketch", ["right", "too high"])
def test_only_rows_that_can_be_first_are_ranked(spark, monkeypatch, sketch):
    score = {"a": lambda k: k * 37 % 600 / 600, "b": lambda k: float(k % 7), "c": lambda k: None if k % 3 else 1.0, "d": lambda k: 0.5, "e": lambda k: float(k)}
    rows = [(g, f"s{k % 10}", f"t{k}", f(k), k % 4 == 0 if g != "e" else k < 9) for g, f in score.items() for k in range(600 if g != "d" else 30)]
    table = spark.createDataFrame(rows, "model string, source string, target string, score double, positive boolean")
    if sketch == "too high":
        monkeypatch.setattr(C.F, "percentile_approx", lambda c, shares, _: F.array_repeat(F.max(c), len(C.SHARES)))
    ranked, totals = C.first_ranks(table, ["model"], 50)
    whole = C.rank_within(table, ["model"], R.by_score(), "rank")
    first = lambda df: sorted((r.model, r["rank"], r.positive) for r in df.collect() if r["rank"] <= 50)
    assert first(ranked) == first(whole)
    assert {(r.model, r["__all"]) for r in totals.collect()} == {("a", 150), ("b", 150), ("c", 150), ("d", 8), ("e", 9)}
    if sketch == "right":
        kept = Counter(r.model for r in ranked.collect())
        assert kept["a"] < 100 and kept["b"] < 180 and kept["c"] == 200 and kept["d"] == 30 and kept["e"] < 100
    got, want = C.redrawn_recall(ranked, ["model"], 50, 9, 4, 7, totals=totals), C.redrawn_recall(whole, ["model"], 50, 9, 4, 7)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 5 * 4 * 9


def test_hits_are_drawn_without_rows_of_draws(spark, monkeypatch):
    monkeypatch.setattr(C, "PIECE", 7)
    rows = [(g, "s", f"t{k}", 1 + k * k % 11) for g, n in (("a", 1), ("b", 50)) for k in range(n)]
    known = spark.createDataFrame(rows, "model string, source string, target string, rank_negatives long")
    for k_min in (0, 1):
        got = C.redrawn_hits(known, ["model"], [F.col("target")], 6, 5, 7, k_min)
        assert "Generate explode(sequence" not in got._jdf.queryExecution().toString()
        drawn = C.redrawn(known, ["model"], [F.col("target")], 5, 7)
        want = C.hit_curve(drawn, ["model", "resample"], 6, F.col("copies"), k_min)
        key = lambda df: {(r.model, r.resample, r.k): round(r.hit, 9) for r in df.collect()}
        assert key(got) == key(want) and len(key(got)) == 2 * 5 * (7 - k_min)


def test_full_comparison_has_the_production_values(spark):
    assert (plans.TIMES, plans.N_MAX, plans.N_MAX_NEGATIVE, plans.POINTS, plans.FOLD_POINTS, plans.K_MAX) == (100, 100_000, 1_000_000, 1000, 100, 200)
    d, found = "/root/testdata/sf0.001", registry.queries()
    for name, x, points, last in (("cmp_09_recall_curve_full", "n", 1000, 1e5), ("cmp_09_negative_recall_full", "n", 1000, 1e6), ("cmp_10_recall_bootstrap_full", "n", 1000, 1e5), ("cmp_10_negative_bootstrap_full", "n", 1000, 1e6), ("cmp_11_hit_curve_full", "k", 201, 200), ("cmp_12_hit_bootstrap_full", "k", 201, 200), ("cmp_16_recall_by_fold_full", "n", 100, 1e5)):
        row = found[name](spark, d).agg(F.count_distinct(x), F.max(x)).first()
        assert tuple(row) == (points, last), name


def test_commonality_and_entropy_curves(spark):
    lists = {"a": "pqrstu", "b": "qpturs", "c": "vwxyz"}
    rows = [(m, 0, t + "12"[k % 2], t, k + 1) for m, ts in lists.items() for k, t in enumerate(ts)]
    rows = [(m, f, t, t, k) for m, f, _, t, k in rows]
    ranked = spark.createDataFrame(rows, "model string, fold long, source string, target string, rank long")
    got = {(r.one, r.other, r.n): r.commonality for r in C.commonality_curve(ranked, 9, 5).collect()}
    pairs = [(x, y) for x in lists for y in lists if x < y]
    assert got == {(x, y, n): len(set(lists[x][:n]) & set(lists[y][:n])) / n for x, y in pairs for n in (1, 3, 5, 7, 9)}
    seen = "ppqprqs"
    once = spark.createDataFrame([("m", 0, t, str(k), k + 1) for k, t in enumerate(seen)], "model string, fold long, source string, target string, rank long")
    for r in C.entropy_curve(once, "source", 8, 5).collect():
        part = seen[: r.n]
        assert math.isclose(r.entropy, sum(-c / len(part) * math.log(c / len(part), 4) for c in Counter(part).values()), abs_tol=1e-9)
    most = [r.entropy for r in C.maximal_entropy(C.entropy_grid(spark, 8, 5), 4).orderBy("n").collect()]
    assert [round(x, 6) for x in most] == [0, 0.5, 1, round(-4 / 6 * math.log(1 / 3, 4) - 2 / 6 * math.log(1 / 6, 4), 6), 1]


PRODUCTS = ("CartesianProduct", "BroadcastNestedLoopJoin")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["cmp_01_dense", "cmp_04_harmonized", "cmp_05_combined_predictions", "mat_02_open_pairs"])
def test_no_product_is_made(spark, name):
    assert not any(p in plan(registry.queries()[name](spark, "/root/testdata/sf0.001")) for p in PRODUCTS)


@pytest.mark.parametrize("name", ["cmp_02_excluded", "ker_03_known_pairs"])
def test_products_are_not_shuffled(spark, name):
    above = re.split("|".join(PRODUCTS), plan(registry.queries()[name](spark, "/root/testdata/sf0.001")))[0]
    assert "Exchange" not in above and "Join" not in above


def test_pairs_outside(spark, monkeypatch):
    monkeypatch.setattr(R, "BLOCK", 3)
    known = {("a", "t1"), ("a", "t2"), ("b", "t9"), ("x", "t1"), ("b", "x")} | {("c", f"t{k}") for k in range(10)}
    drugs, diseases = [("a",), ("b",), ("c",), ("d",), ("d",)], [(f"t{k}",) for k in range(10)]
    got = R.pairs_outside(spark.createDataFrame(drugs, "source string"), spark.createDataFrame(diseases, "target string"), spark.createDataFrame(sorted(known), "source string, target string"))
    assert sorted(map(tuple, got.collect())) == sorted({(s, t) for (s,) in drugs for (t,) in diseases} - known)


def test_files_of_a_product_are_small(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(R, "TASK", 10_000)
    name = lambda n, c: spark.range(n).select(F.concat(F.lit(f"{c}:"), F.col("id").cast("string")).alias({"S": "source", "T": "target"}[c]))
    drugs, diseases = name(200, "S"), name(40_000, "T")
    known = spark.range(40_000).select(F.concat(F.lit("S:"), (F.col("id") % 200).cast("string")).alias("source"), F.concat(F.lit("T:"), F.col("id").cast("string")).alias("target"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        R.pairs_outside(drugs, diseases, known).write.parquet(str(tmp_path / "out"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.agg(F.count(F.lit(1)), F.count_distinct(F.xxhash64("source", "target"))).first()[:] == (7_960_000, 7_960_000)
    assert got.join(known, ["source", "target"], "left_semi").isEmpty()
    assert sum(f.stat().st_size for f in (tmp_path / "out").glob("*.parquet")) < 0.5 * 7_960_000


def test_spaces_are_compared_without_a_product(spark, monkeypatch):
    tables = [["ap", "aq", "bp"], ["ap", "aq", "bq"], ["ap", "aq", "bp", "bq"], ["ap", "aq"], ["ap", "bp"], ["ap", "aq", "ar", "bp"], ["ap", "aq", "bp", "cp", "cq"]]
    spaces = [C.sparse(spark.createDataFrame([tuple(x) for x in t], "source string, target string"), []) for t in tables]
    lacks = [{(s, t) for s in {x[0] for x in table} for t in {x[1] for x in table}} - {tuple(x) for x in table} for table in tables]
    assert {tuple(r) for r in spaces[0].excluded.collect()} == lacks[0]
    monkeypatch.setattr(C, "pairs_outside", None)
    for k, j in ((0, 0), (0, 1), (2, 3), (2, 4), (0, 5), (0, 6), (3, 0)):
        assert C.same_excluded(spaces[k], spaces[j]) == (lacks[k] == lacks[j])


def test_inconsistent_tests_are_left_out(spark):
    rows = lambda ps: spark.createDataFrame([(p[0], p[1], p[2] == "+") for p in ps], "source string, target string, pos boolean")
    one, other = rows(["ap+", "aq-", "bp+", "bq-"]), rows(["ap+", "aq+", "bp+", "cq-"])
    for drop, want in ((False, {("a", "p", True), ("a", "q", False), ("b", "p", True)}), (True, {("a", "p", True), ("b", "p", True)})):
        common = C.combine([C.sparse(one, ["pos"]), C.sparse(other, ["pos"])], drop)
        assert {tuple(r) for r in common.dense().collect()} == want


def test_combined_in_one_pass_over_a_table(spark):
    found = plan(registry.queries()["cmp_04_harmonized"](spark, "/root/testdata/sf0.001"))
    assert "Join" not in found and found.count("FileScan parquet") == 1


def test_predictions_cost_one_join(spark):
    found = plan(registry.queries()["cmp_05_combined_predictions"](spark, "/root/testdata/sf0.001"))
    assert len(re.findall(r"\w+Join", found)) == 1 and found.count("FileScan parquet") == 2


def test_spaces_of_one_table_and_of_several_are_combined_alike(spark, monkeypatch):
    monkeypatch.setattr(C, "MEET", 2)
    cells = [("a", "p", 1, True), ("a", "p", 2, False), ("a", "p", 3, True), ("a", "q", 1, True), ("a", "q", 2, True), ("a", "q", 3, True), ("b", "p", 1, None), ("b", "p", 2, False), ("b", "p", 3, None), ("b", "q", 1, True), ("b", "q", 1, False), ("b", "q", 3, True), (None, "p", 1, True), ("a", None, 2, True)]
    table = spark.createDataFrame(cells, "source string, target string, part int, pos boolean")
    for parts in ([{1}, {2}, {3}], [{1, 2}, {2, 3}, {1, 3}], [{1}, {2, 3}], [{1, 2, 3}]):
        tables = [{k[:2]: any(c[3] for c in cells if c[:2] == k[:2] and c[2] in own) for k in cells if k[2] in own and None not in k[:2]} for own in parts]
        common = set.intersection(*map(set, tables))
        for drop in (False, True):
            want = sorted((*k, all(t[k] for t in tables)) for k in common if not drop or len({t[k] for t in tables}) == 1)
            cut = [C.sparse(table, ["pos"], F.col("part").isin(*own)) for own in parts]
            apart = [C.sparse(table.filter(F.col("part").isin(*own)), ["pos"]) for own in parts]
            for spaces in (cut, apart, [cut[0], *apart[1:]]):
                got = C.combine(spaces, drop)
                assert sorted(map(tuple, got.dense().collect())) == want
                assert sorted(map(tuple, got.pairs.collect())) == [w[:2] for w in want]
                assert {r.source for r in got.drugs.collect()} == set.intersection(*[{k[0] for k in t} for t in tables])
    with pytest.raises(ValueError):
        C.combine([C.sparse(table, ["pos"]), C.sparse(table, [])])


def test_known_and_predicted(spark):
    known = spark.createDataFrame([("a", "p"), ("b", "q"), ("b", "r"), ("b", "r")], "source string, target string")
    said = spark.createDataFrame([("a", "p", True), ("a", "q", True), ("b", "r", False), ("z", "p", True)], "source string, target string, predicted boolean")
    got = M.known_and_predicted(known, said)
    want = M.with_predictions(M.known_pairs(known), said)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(got.columns).collect())) and got.count() == 6
