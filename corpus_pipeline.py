"""A corpus pipeline of five stages, each written as Parquet and read again as the next one's documents.

Language identification drops texts that are in no known language; the n-gram Jaccard join leaves one document of each group
of near copies (five words, 0.8); substring dedup cuts passages of 50 words and more that an earlier document has; mixing takes
the sources' shares; packing deals the token pieces of what is left to sequences of 1024 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hillframe.llm import chains, langid, mixing, ngram_join, packing
from hillframe.llm.common import cut

#: Language models, greedy covers of lists and zlib sums have no SQL; tests hold the stages against brute force instead.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    trees = langid.train_trees(docs.where(~langid.held_out()).select("doc_id", "text", "lang"))
    return langid.keep_in_a_language(docs, trees)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs, k=5, numerator=80)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    spans, copies = chains.repeated_passages(docs)
    return chains.remove_passages(docs, chains.passages(cut(spans, "spans"), copies, both_sides=False))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(packing.token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), 1024, 2), 1024)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("passages", passages),
    ("mix", mix),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
