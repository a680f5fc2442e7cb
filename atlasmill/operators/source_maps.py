"""Raw columns of each known source to the standard node, edge and pair tables, as tables of rules.

A rule names where a standard column comes from: the source's column, its parts, or a constant. What a
source has no rule for is null. Everything is one projection, so only the columns named are read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlasmill.operators.standardize import least_row, pieces, project

TEXT, LIST, NUMBER, WHOLE = "string", "array<string>", "float", "int"
NODE = {"id": TEXT, "name": TEXT, "category": TEXT, "description": TEXT, "equivalent_identifiers": LIST, "all_categories": LIST, "publications": LIST, "labels": LIST, "international_resource_identifier": TEXT, "upstream_data_source": LIST}
QUALIFIERS = [f"{x}_qualifier" for x in ("subject_aspect", "subject_direction", "subject_part", "object_aspect", "object_direction", "object_specialization", "object_part", "species_context", "disease_context", "frequency", "stage", "anatomical_context", "onset", "sex")]
SUPPORT = {"num_references": WHOLE, "num_sentences": WHOLE, "has_confidence_score": NUMBER, "extraction_confidence_score": NUMBER, "affinity": NUMBER, "affinity_parameter": TEXT, "supporting_study_method_type": TEXT}
PROVENANCE = {"knowledge_level": TEXT, "agent_type": TEXT, "primary_knowledge_source": TEXT, "aggregator_knowledge_source": LIST, "publications": LIST, "upstream_data_source": LIST}
EDGE = {"subject": TEXT, "predicate": TEXT, "object": TEXT, "qualified_predicate": TEXT, **dict.fromkeys(QUALIFIERS, TEXT), "qualifiers": TEXT, **PROVENANCE, **SUPPORT}


@dataclass
class Table:
    """How a source's nodes or edges become standard ones.

    ``take``: standard column to source column; ``parts``: likewise, split at ``separator``; ``once``: the
    least row of each of these; ``needed``: rows without them leave; ``specific``: the category is the most
    specific of all categories; ``more``: other rules.
    """

    source: str
    take: dict[str, str] = field(default_factory=dict)
    parts: dict[str, str] = field(default_factory=dict)
    separator: str = "|"
    once: list[str] = field(default_factory=list)
    needed: list[str] = field(default_factory=list)
    specific: bool = False
    more: dict[str, Column] = field(default_factory=dict)


def most_specific_of(column: Column, depths: dict[str, int]) -> Column:
    """The deepest of the known names in an array, ties to the smaller name; without a known one null."""
    depth = F.create_map(*[F.lit(x) for name, d in sorted(depths.items()) for x in (name, d)])
    known = F.filter(F.transform(column, lambda c: F.struct((-F.element_at(depth, c)).alias("d"), c.alias("c"))), lambda s: s["d"].isNotNull())
    return F.array_min(known)["c"]


def standard(df: DataFrame, table: Table, schema: dict[str, str], depths: dict[str, int] | None = None) -> DataFrame:
    """The standard columns of a source's rows."""
    column = lambda name: F.col(f"`{name}`")
    rules = {c: column(s) for c, s in table.take.items()} | {c: pieces(f"`{s}`", table.separator) for c, s in table.parts.items()} | table.more
    rules = {c: F.lit(None) for c in schema} | rules | {"upstream_data_source": F.array(F.lit(table.source))}
    if table.specific:
        rules["category"] = most_specific_of(rules["all_categories"], depths or {})
    out = project(df, rules, schema)
    if table.needed:
        out = out.dropna(subset=table.needed)
    return least_row(out, table.once) if table.once else out


def same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


# The columns of the sources' files, by version.
ROBOKOP_NODES = {
    "c5ec1f282158182f": lambda: Table("robokop", {"id": "id:ID", "name": "name:string", "description": "description:string"}, {"all_categories": "category:LABEL", "labels": "category:LABEL", "equivalent_identifiers": "equivalent_identifiers:string[]"}, specific=True),
    "30fd1bfc18cd5ccb": lambda: Table("robokop", same("id", "name", "description"), {"all_categories": "category", "labels": "category", "equivalent_identifiers": "equivalent_identifiers"}, specific=True),
}
ROBOKOP_NODES["30fd1bfc18cd5ccb.1"] = ROBOKOP_NODES["30fd1bfc18cd5ccb"]
ROBOKOP_EDGES = {
    "c5ec1f282158182f": lambda: Table(
        "robokop",
        {"subject": "subject:START_ID", "predicate": "predicate:TYPE", "object": "object:END_ID", "has_confidence_score": "Combined_score:string", "extraction_confidence_score": "tmkp_confidence_score:float", "affinity": "supporting_affinities:float[affinity:float", "supporting_study_method_type": "detection_method:string"}
        | {c: f"{c}:string" for c in ("qualified_predicate", "object_aspect_qualifier", "object_direction_qualifier", "species_context_qualifier", "frequency_qualifier", "stage_qualifier", "onset_qualifier", "sex_qualifier", "knowledge_level", "agent_type", "primary_knowledge_source", "affinity_parameter")},
        {c: f"{c}:string[]" for c in ("aggregator_knowledge_source", "publications")},
    ),
    "30fd1bfc18cd5ccb": lambda: Table(
        "robokop",
        same("subject", "predicate", "object", "qualified_predicate", "qualifiers", "knowledge_level", "agent_type", "primary_knowledge_source", "affinity", "affinity_parameter", *[q for q in QUALIFIERS if not q.startswith(("subject_aspect", "subject_direction"))])
        | {"has_confidence_score": "Combined_score", "extraction_confidence_score": "tmkp_confidence_score", "supporting_study_method_type": "detection_method"},
        same("aggregator_knowledge_source", "publications"),
    ),
}
ROBOKOP_EDGES["30fd1bfc18cd5ccb.1"] = ROBOKOP_EDGES["30fd1bfc18cd5ccb"]
SPOKE_NODES = {
    "V5.7": lambda: Table("spoke", {"id": "id", "name": "id"}, {"all_categories": "category"}, once=["id"], specific=True),
    "V5.2": lambda: Table("spoke", same("id", "name", "description"), {"all_categories": "category"}, specific=True),
}
SPOKE_EDGES = {
    "V5.7": lambda: Table("spoke", same("subject", "object"), once=["subject", "object", "predicate"], more={"predicate": F.concat(F.lit("biolink:"), F.col("predicate"))}),
    "V5.2": lambda: Table("spoke", same("subject", "predicate", "object")),
}
PRIMEKG_NODES = {"2.1": lambda: Table("primekg", same("id", "name", "category", "description"), {"all_categories": "category", "labels": "category"})}
PRIMEKG_EDGES = {"2.1": lambda: Table("primekg", same("subject", "predicate", "object", "subject_aspect_qualifier", "object_aspect_qualifier", "object_direction_qualifier", "knowledge_level", "agent_type", "primary_knowledge_source"), same("aggregator_knowledge_source", "publications"))}
EMBIOLOGY_NODES = {"latest": lambda: Table("embiology", same("id", "name", "category"), same("all_categories", "equivalent_identifiers"))}
EMBIOLOGY_EDGES = {"latest": lambda: Table("embiology", same("subject", "predicate", "object", "num_references", "num_sentences"), same("publications"))}


def medical_node_table(once: bool = True) -> Table:
    own = F.col("normalized_curie")
    more = {"category": F.lit("category"), "labels": F.array("types"), "all_categories": F.array("types"), "equivalent_identifiers": F.array(own), "international_resource_identifier": own}
    return Table("ec_medical", {"id": "normalized_curie", "name": "label"}, needed=["id"], once=["id"] if once else [], more=more)


def medical_edge_table(once: bool = True) -> Table:
    team = F.lit("medical team")
    more = {"predicate": F.concat(F.lit("biolink::"), F.col("Label")), "primary_knowledge_source": team, "aggregator_knowledge_source": F.array(team), "publications": F.array(team)}
    return Table("ec_medical", {"subject": "SourceId", "object": "TargetId"}, needed=["subject", "object"], once=["subject", "object", "predicate"] if once else [], more=more)


def pair_edges(df: DataFrame, names: dict[str, str], predicate: str, label: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(edges, ids of their ends) of a list of pairs whose columns are renamed by ``names``; all other columns stay."""
    edges = df.withColumnsRenamed(names).withColumn("predicate", F.lit(predicate))
    if label is not None:
        edges = edges.withColumn("y", F.lit(label))
    return edges, edges.select(F.col("subject").alias("id")).union(edges.select("object")).distinct()


# The column names of the lists, and their predicates.
OFF_LABEL = {"curie_drug": "subject", "ec_drug_id": "subject_ec_id", "curie_disease": "object"}
INDICATIONS = {"translator_id": "subject", "ec_id": "subject_ec_id", "target": "object"}


def off_label_pairs(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return pair_edges(df, OFF_LABEL, "off_label", 1)


def indication_pairs(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return pair_edges(df, INDICATIONS, "JaM")


def drug_nodes(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"id": "ec_id", "translator_id": "id"}).withColumn("category", F.lit("biolink:Drug"))


def disease_nodes(df: DataFrame) -> DataFrame:
    return df.withColumn("category", F.lit("biolink:Disease"))
