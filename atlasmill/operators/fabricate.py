"""Reproducible made-up data: every value is a function of a seed, a column name and the row's id, never of partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def ids(spark: SparkSession, rows: int, prefix: str = "", width: int = 0) -> DataFrame:
    """(row, id): unique ids of a prefix and zero-padded numbers from 1."""
    number = (F.col("id") + 1).cast("string")
    return spark.range(rows).select(F.col("id").alias("row"), F.concat(F.lit(prefix), F.lpad(number, width, "0") if width else number).alias("id"))


def share(seed: int, name: str, *columns: str) -> Column:
    """A number in [0, 1) from the md5 of seed, name and columns."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(name), *[F.col(c).cast("string") for c in columns]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def choice(u: Column, values: list, weights: list[float] | None = None) -> Column:
    """A value by a number in [0, 1), by weight."""
    weights = weights or [1.0] * len(values)
    total, upto, out = sum(weights), 0.0, F.lit(values[-1])
    limits = []
    for w in weights:
        upto += w
        limits.append(upto / total)
    for value, limit in reversed(list(zip(values[:-1], limits[:-1], strict=True))):
        out = F.when(u < limit, F.lit(value)).otherwise(out)
    return out


def md5_bucket(column: str, n: int) -> Column:
    """The whole 128-bit digest modulo n, by its 32-bit quarters."""
    digest, out = F.md5(F.col(column).cast("string")), F.lit(0).cast("long")
    for k in range(4):
        part = F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")
        out = F.pmod(out * F.lit((1 << 32) % n) + part, F.lit(n))
    return out


def mapped(column: str, table: dict, default=None) -> Column:
    """A value's image in a small table."""
    entries = [F.lit(x) for kv in table.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*entries), F.col(column)), F.lit(default))


def day(u: Column, first: str, last: str) -> Column:
    """A day of a closed range."""
    a, b = F.to_date(F.lit(first)), F.to_date(F.lit(last))
    return F.date_add(a, F.floor(u * (F.datediff(b, a) + 1)).cast("int"))


def some_of(values: list[str], seed: int, name: str, most: int, *columns: str) -> Column:
    """Up to ``most`` distinct values in hash order; how many is itself drawn."""
    key = F.concat_ws("|", F.lit(str(seed)), F.lit(name), *[F.col(c).cast("string") for c in columns])
    ordered = F.array_sort(F.transform(F.array(*[F.lit(v) for v in values]), lambda v: F.struct(F.md5(F.concat_ws("|", key, v)).alias("h"), v.alias("v"))))
    n = F.floor(share(seed, name + "#", *columns) * (most + 1)).cast("int")
    return F.transform(F.slice(ordered, F.lit(1), n), lambda s: s["v"])


def with_nulls(value: Column, u: Column, probability: float) -> Column:
    return F.when(u >= probability, value)


def uniform(u: Column, low: float, high: float) -> Column:
    return F.lit(float(low)) + F.lit(float(high - low)) * u


def normal(u: Column, v: Column, mean: float, deviation: float) -> Column:
    """Normal numbers from two numbers in [0, 1)."""
    return F.lit(float(mean)) + F.lit(float(deviation)) * F.sqrt(-2 * F.ln(1 - u)) * F.cos(2 * F.pi() * v)


def exponential(u: Column, mean: float) -> Column:
    return -F.lit(float(mean)) * F.ln(1 - u)


def crossed(values: list, column: Column) -> Column:
    """Array of (a, b): every value of a short list with every item of an array."""
    return F.flatten(F.transform(F.lit(values), lambda a: F.transform(column, lambda b: F.struct(a.alias("a"), b.alias("b")))))


def skewed_score(u: Column, positive: Column, negative: Column, skew: float) -> Column:
    """Scores near 1 for positives, near 0 for negatives (more so with a larger skew), uniform for others: inverse Beta(skew, 1) and Beta(1, skew)."""
    power = F.lit(1.0 / skew)
    return F.when(positive, F.pow(u, power)).when(negative, 1 - F.pow(1 - u, power)).otherwise(u)


# --- instructions: datasets of columns, in an order that their references allow ---


def _references(columns: dict[str, dict], rows) -> set[str]:
    """The datasets that a dataset's row count and columns name (``table.column`` and ``@table.num_rows``)."""
    out = {rows[1:].split(".")[0]} if isinstance(rows, str) else set()
    return out | {c["from"].split(".")[0] for c in columns.values() if c["type"] == "reference"}


def evaluation_order(instructions: dict[str, dict]) -> list[str]:
    """Datasets so that each comes after those that it refers to; a circle or an unknown name is an error."""
    needs = {name: _references(d["columns"], d["num_rows"]) - {name} for name, d in instructions.items()}
    unknown = {r for rs in needs.values() for r in rs} - set(needs)
    if unknown:
        raise ValueError(f"unknown datasets: {sorted(unknown)}")
    order: list[str] = []
    while len(order) < len(needs):
        ready = [n for n in needs if n not in order and needs[n] <= set(order)]
        if not ready:
            raise ValueError(f"datasets refer to each other in a circle: {sorted(set(needs) - set(order))}")
        order += ready
    return order


def _made(spec: dict, seed: int, name: str) -> Column:
    u, kind = share(seed, name, "row"), spec["type"]
    if kind == "id":
        number = (F.col("row") + 1).cast("string")
        return F.concat(F.lit(spec.get("prefix", "")), F.lpad(number, spec["width"], "0") if spec.get("width") else number)
    if kind == "choice":
        return choice(u, spec["values"], spec.get("weights"))
    if kind == "some_of":
        return some_of(spec["values"], seed, name, spec["most"], "row")
    if kind == "uniform":
        return uniform(u, spec["low"], spec["high"])
    if kind == "normal":
        return normal(u, share(seed, name + "#", "row"), spec["mean"], spec["deviation"])
    if kind == "exponential":
        return exponential(u, spec["mean"])
    if kind == "day":
        return day(u, spec["first"], spec["last"])
    if kind == "bucket":
        return md5_bucket(spec["column"], spec["buckets"])
    if kind == "map":
        return mapped(spec["column"], spec["table"], spec.get("default"))
    if kind == "copy":
        return F.col(spec["column"])
    if kind == "expression":
        return F.expr(spec["sql"])
    raise ValueError(f"unknown column type {kind}")


def datasets(spark: SparkSession, instructions: dict[str, dict], seed: int = 0, sources: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Every dataset of ``instructions``: {name: {"num_rows": number or "@other.num_rows", "columns": {name: spec}}}.

    A spec has a ``type``: id, choice, some_of, uniform, normal, exponential, day, bucket, map, copy, expression (the last four of columns before it), or reference
    (``from``: "other.column"): a value of that column for each row, drawn or (``in_order``) row by row from the
    first again; ``nulls`` is a share of nulls. Names that begin with ``_`` are left out of the results.
    ``sources`` are datasets that are there already. Values depend on the seed, the name and the row only.
    """
    from atlasmill.functions.lineage import materialize
    from atlasmill.operators.graph import rank_rows

    made: dict[str, DataFrame] = {}
    given = {n: {"columns": {}, "num_rows": None, "frame": df} for n, df in (sources or {}).items()}
    for name in evaluation_order({**{n: {"columns": {}, "num_rows": 0} for n in given}, **instructions}):
        if name in given and name not in instructions:
            made[name] = given[name]["frame"]
            continue
        spec = instructions[name]
        rows = made[spec["num_rows"][1:].split(".")[0]].count() if isinstance(spec["num_rows"], str) else spec["num_rows"]
        out = spark.range(rows).select(F.col("id").alias("row"))
        for column, how in spec["columns"].items():
            label = f"{name}.{column}"
            if how["type"] == "reference":
                other, theirs = how["from"].split(".")
                values = made[other].select(F.col(theirs).alias(column))
                listed = rank_rows(values.distinct() if how.get("distinct", True) else values, [F.col(column).asc_nulls_last()], "__at")
                n = listed.count()
                at = F.col("row") % max(1, n) if how.get("in_order") else F.floor(share(seed, label, "row") * n)
                out = out.withColumn("__at", at.cast("long")).join(listed, "__at", "left").drop("__at")
            else:
                out = out.withColumn(column, _made(how, seed, label))
            if how.get("nulls"):
                out = out.withColumn(column, with_nulls(F.col(column), share(seed, label + "?", "row"), how["nulls"]))
        made[name] = materialize(out.select(*([] if spec.get("drop_row", True) else ["row"]), *spec["columns"]), f"made-{name}")
    return {n: df for n, df in made.items() if n in instructions and not n.startswith("_")}


# --- graphs that keep to a vocabulary ---


def valid_predicates(slots: DataFrame, classes: DataFrame) -> DataFrame:
    """(subject_category, predicate, object_category) of all categories of which both have an ancestor, or are themselves, the predicate's domain and range.

    ``slots``: (predicate, domain, range); ``classes``: (name, ancestor), reflexive. Both are vocabularies.
    """
    subject = classes.select(F.col("name").alias("subject_category"), F.col("ancestor").alias("domain"))
    target = classes.select(F.col("name").alias("object_category"), F.col("ancestor").alias("range"))
    return slots.join(subject, "domain").join(target, "range").select("subject_category", "predicate", "object_category").distinct()


def sample_graph(triples: DataFrame, each: int, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges): ``each`` edges between nodes of their own for every valid triple of categories; ids are made from seed, triple and number."""
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), "subject_category", "predicate", "object_category", "n"))
    rows = triples.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(each)))).withColumn("key", key)
    edges = rows.select(F.concat(F.lit("S:"), "key").alias("subject"), "predicate", F.concat(F.lit("O:"), "key").alias("object"), "subject_category", "object_category")
    nodes = edges.select(F.col("subject").alias("id"), F.col("subject_category").alias("category")).union(edges.select("object", "object_category"))
    return nodes, edges.drop("subject_category", "object_category")
