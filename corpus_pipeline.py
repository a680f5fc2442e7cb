"""A training-data pipeline over ``documents``: each stage is written and read again by the next.

The stages keep all columns of documents but for the last, which returns where each piece of each
text goes. A text that the mix takes several times goes on as several rows of one doc_id.

Nulls in any column go through: a null, empty or letterless text is rejected by the first stage, a null
language, source or id is a value of its own. Very long texts stay whole until the last stage cuts them
into pieces. Repeated rows pass the first two stages each and are one class in the third; ties there go
to the least (id, hash of the text). With no rows left a stage gives an empty result. Extra columns are
carried along, whatever their names, up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from atlasmill.functions.lineage import materialize
from atlasmill.llm import langid, mixing, ngram_join, packing, quality
from atlasmill.llm.common import table
from atlasmill.llm.queries import tokenizer_file


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that the calibrated model accepts; it is trained on the labelled rows among ``docs``, and without any rejects all."""
    judged = langid.predict(docs, langid.fit(docs))
    return judged.filter("not rejected").select(docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts within the limits of their language and source; limits come from ``docs``, so a lone text is within its own."""
    return quality.quality_rules(docs).filter("kept").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of the n-gram join (five words, similarity 0.8), the one of the least id."""
    return ngram_join.one_per_class(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes, a text once for each time; sources of no words give none."""
    return mixing.mixed_texts(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the texts in sequences of at most 4096 tokens, each row packed by itself."""
    return packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("source_mix", source_mix),
    ("pack", pack),
]

#: Training, hashing and the packing search have no SQL form; tests/llm compares each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
