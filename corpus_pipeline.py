"""Corpus pipeline: documents to shuffled shards of a mixed, cleaned training set.

Each stage works on all rows its predecessor kept. ``run`` writes every stage's
rows as Parquet under ``spark.checkpoint.dir`` and reads them back, which cuts
lineage and leaves each stage restartable; a stage's input folder and what it cut
on its way go once its output is written.

Defined results: null and empty texts pass toxicity as texts without known words, form
one near-duplicate group (so one of them stays), are never contaminated and have size 0
in mixing, so they cost no budget and are taken in every epoch; null ids and sources are
values like others; repeated rows are near duplicates of each other; an empty table
gives no rows. Every stage but the last returns the columns that it got.
"""

from __future__ import annotations

from tidemark.llm import decontamination, mixing, sharding, simhash, toxicity
from tidemark.llm.common import cuts, drop_folder, release, table
from tidemark.session import scratch_dir


def reject_toxic(spark, docs, sf_dir):
    """Documents that the classifier scores below 0.7 stay."""
    return toxicity.accepted_rows(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark, docs, sf_dir):
    """One document of each SimHash group stays: the smallest id."""
    return simhash.keep_one(docs)


def drop_contaminated(spark, docs, sf_dir):
    """Documents with at least one word in twenty inside benchmark windows go."""
    return decontamination.clean_rows(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark, docs, sf_dir):
    """Every document as often as its source's target takes it (whole texts)."""
    return mixing.mixed_rows(docs)


def shard_rows(spark, docs, sf_dir):
    """All rows with shard and slot in a reproducible shuffle."""
    return sharding.shard(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard_rows),
]

#: Toxicity and SimHash have no SQL form; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The last stage's rows over the whole ``documents`` table of ``sf_dir``."""
    docs, held = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        folder, before = scratch_dir(spark, "corpus-pipeline", name), cuts()
        stage(spark, docs, sf_dir).write.parquet(folder)
        release(spark, before)
        docs = spark.read.parquet(folder)
        if held:
            drop_folder(spark, held)
        held = folder
    return STAGES[-1][1](spark, docs, sf_dir)
