"""Graph-store exports and lists without deleted rows."""

import pytest

from atlasmill.sources import tables


def test_graph_store_export(spark):
    n = spark.createDataFrame([("a", "A", "biolink:Drug", None, ["k"], ["p", "q"], 1)], "id string, name string, category string, description string, upstream_data_source array<string>, publications array<string>, other int")
    row = tables.graph_nodes(n).first()
    assert row.label == "biolink:Drug" and row.property_keys == ["name", "category", "description"] and row.property_values == ["A", "biolink:Drug", None]
    assert row.array_property_keys == ["upstream_data_source", "publications"] and row.array_property_values == [["k"], ["p", "q"]] and "other" not in row
    e = spark.createDataFrame([("a", p, "b", ["k"], ["p"], ["s"]) for p in ("biolink:treats:x", "bare")], "subject string, predicate string, object string, upstream_data_source array<string>, publications array<string>, aggregator_knowledge_source array<string>")
    assert [r.label for r in tables.graph_edges(e).collect()] == ["treats:x", None]


def test_live_rows(spark):
    make = lambda rows: spark.createDataFrame(rows, "id string, deleted boolean")
    assert [r.id for r in tables.live_rows(make([("a", False), ("a", True), ("b", False)]), ["id"]).orderBy("id").collect()] == ["a", "b"]
    for rows in ([("a", False), ("a", False)], [(None, False)], [("a", None)]):
        with pytest.raises(ValueError):
            tables.live_rows(make(rows), ["id"])
