"""The corpus pipeline: raw documents to encoded training text in five stages.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and
is written as Parquet before the next one reads it.  All but the last return the
columns of ``documents``; the last returns every kept document's pieces.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from chatloom.llm.exact_dedup import drop_exact
from chatloom.llm.language_id import drop_rejected, fit_language_models
from chatloom.llm.mixing import sample_mix
from chatloom.llm.near_dedup import drop_similar
from chatloom.llm.pieces import encode_pieces
from chatloom.llm.queries import CLEAN, TARGETS, domain, table
from chatloom.llm.shared import collecting, cut, discard


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without texts that have no letter or read like none of the learned languages."""
    return drop_rejected(docs, fit_language_models(docs))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group equal but for blanks."""
    return drop_exact(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard of 0.8 or more on five-word shingles."""
    return drop_similar(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Thinned until the domains' tokens match ``TARGETS``; clean documents stay."""
    return sample_mix(docs, table(spark, sf_dir, "labels"), domain(), TARGETS, CLEAN)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces, the columns of ``encode_pieces``; few words held, for the sake of memory after four other stages."""
    return encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"), remembered=24 << 20, together=1 << 20)


#: Rows that go to a Python worker at a time: few, since texts may be long and workers share the executor's memory with the JVM.
BATCH = 2000

_left: list[str] = []


def _staged(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """``stage``, which first removes the scratch tables of the stage before: what that returned has been written by then."""

    @wraps(stage)
    def staged(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH)
        discard(spark, _left)
        with collecting(_left):
            return stage(spark, docs, sf_dir)

    return staged


STAGES = [(stage.__name__, _staged(stage)) for stage in (language, exact, near, mixture, pieces)]

#: Language models, fingerprint components and fitted rates are not SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
