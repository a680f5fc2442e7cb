"""Spark-native analytics engine for heterogeneous knowledge graphs and entity-pair ranking."""
