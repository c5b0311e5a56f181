"""Corpus pipeline: documents through quality, language, near-duplicate, contamination and mixing stages.

Each stage takes (spark, docs, sf_dir), works on all documents its predecessor kept and returns the columns of
documents; the last adds each row's rate and copy number. Stages are written as Parquet and reread.
"""

from __future__ import annotations

from peakcast.llm import common, decontaminate, language, mixing, near_dup, quality


def quality_stage(spark, docs, sf_dir):
    """Documents that the quality classifier accepts."""
    return quality.accept(docs, common.table(spark, sf_dir, "labels"))


def language_stage(spark, docs, sf_dir):
    """Documents in one of the learned languages."""
    return language.accept(docs)


def near_duplicate_stage(spark, docs, sf_dir):
    """One document of each group of near duplicates (five-word shingles, similarity 0.8 or more)."""
    return near_dup.deduplicate(docs, percent=80)


def decontamination_stage(spark, docs, sf_dir):
    """Documents without a passage of the benchmark."""
    return decontaminate.decontaminate(docs, common.table(spark, sf_dir, "benchmark"))


def mixing_stage(spark, docs, sf_dir):
    """Documents as often as their rates say, so that the languages' tokens meet the target weights."""
    return mixing.mixed(docs, mixing.languages(docs))


STAGES = [("quality", quality_stage), ("language", language_stage), ("near_duplicates", near_duplicate_stage),
          ("decontamination", decontamination_stage), ("mixing", mixing_stage)]

#: Classifiers and signatures are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
