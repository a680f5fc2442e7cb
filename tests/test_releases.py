"""Limits of the reports: the reference's production values."""

from atlasmill import registry
from atlasmill.plans import ranking, releases


def test_limits():
    assert (releases.MAX_ERRORS, releases.MAX_EXAMPLES, releases.MAX_MINOR, ranking.N_REPORTING) == (1000, 100, 50, 10_000)


def test_shown_components_are_minor_ones(spark):
    c = spark.createDataFrame([(f"n{k}", k) for k in range(70)] + [("x", 0)], "id string, component_rank long")
    core = spark.createDataFrame([("n0",), ("n60",)], "id string")
    assert sorted(tuple(r) for r in releases.shown_components(c, core, 50).collect()) == [(k, 1) for k in [*range(1, 51), 60]]


def test_reports_are_longer_than_the_small_ones(spark):
    d, found = "/root/testdata/sf0.01", registry.queries()
    for name in ("dsh_14_failed_examples", "mat_09_top_pairs"):
        assert found[f"{name}_full"](spark, d).count() > found[name](spark, d).count()
