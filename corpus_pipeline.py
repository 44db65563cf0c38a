"""Corpus pipeline: weak-label classifier -> quality rules -> near-duplicate
removal -> mixing to target weights -> tokens."""

from __future__ import annotations

from vqaspark.llm import mixing, near_dup, quality_classifier, quality_rules, tokens
from vqaspark.session import scratch_path, ship_package
from vqaspark.sources.tables import read_table


def classify(spark, docs, sf_dir):
    """Operator 5: documents that the classifier rejects go."""
    ship_package(spark)
    return quality_classifier.keep_good(docs)


def rules(spark, docs, sf_dir):
    """Operator 7: documents that the rules reject go."""
    ship_package(spark)
    return quality_rules.keep_good(docs)


def near_duplicates(spark, docs, sf_dir):
    """Operator 10: one document of each group of near copies stays."""
    ship_package(spark)
    return near_dup.keep_one(docs)


def mix(spark, docs, sf_dir):
    """Operator 8: sources are repeated or cut to their target weights."""
    ship_package(spark)
    return mixing.mix_documents(docs)


def encode(spark, docs, sf_dir):
    """Operator 2: the mix as token ids (little-endian unsigned 32-bit)."""
    ship_package(spark)
    return tokens.encode(docs.select("doc_id", "source", "lang", "text")).drop("text")


STAGES = [("quality_classifier", classify), ("quality_rules", rules), ("near_duplicates", near_duplicates),
          ("mix_sources", mix), ("bpe_encode", encode)]

#: Trained models and hash-based draws are not SQL; tests hold the operators against brute force and the stages on edge rows.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``; each is written and reread as the next one's input."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = scratch_path(spark, f"pipeline-{i}-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
