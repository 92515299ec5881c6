"""The corpus pipeline: from `documents` to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; its
result is written as Parquet and read again. All but the last return the columns of docs.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import line_dedup, ngram_join, quality, sentencepiece_codec, source_mixing
from tablewright.llm import text as T
from tablewright.session import drop, materialize, recorded, release

#: Near copies: shingles of five words, Jaccard of 80 percent or more.
SHINGLE, NEAR = 5, 80
#: Percentage of the tokens that the mixture takes; no document is taken twice.
SHARE, EPOCHS = 90, 1
SOURCE_WEIGHTS = {"lang": {"en": 4, "de": 2}}


_steps: dict[str, list[str]] = {}


def stage(after: str | None):
    """A stage that first removes what the stage before it wrote on its way, and what the driver holds of it.

    That stage's result is written when the next one is called with it, so nothing reads its
    steps any more.
    """

    def made(work):
        @functools.wraps(work)
        def alone(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            drop(spark, _steps.pop(after, []))
            release(spark)
            with recorded() as paths:
                out = work(spark, docs, sf_dir)
            _steps.setdefault(work.__name__, []).extend(paths)
            return out

        return alone

    return made


@stage(after=None)
def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    vectors, network = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality.score(docs.select(T.boxed(docs), "text"), vectors, network, "row")
    return scored.where(F.col("score") >= quality.THRESHOLD).select("row.*")


@stage(after="keep_good")
def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that repeat an earlier one; n_chars follows the text."""
    rows = line_dedup.without_repeated_lines(docs)
    changed = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return rows.select(*(changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


@stage(after="drop_repeated_lines")
def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least doc_id of each group of near copies."""
    return ngram_join.one_of_each(docs, SHINGLE, NEAR)


@stage(after="keep_one_of_each")
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the token budgets of domains, languages and sources take in."""
    return source_mixing.mixed_documents(docs, F.substring("source", 1, 4), share=SHARE, epochs=EPOCHS, weights=SOURCE_WEIGHTS)


@stage(after="mix_sources")
def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_ids, ids and round_trip of each document."""
    return sentencepiece_codec.encode(docs, "doc_id", "lang", "source")


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", keep_one_of_each),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", tokenize),
]

#: Models, hashes and components: SQL cannot express them. tests/llm has the brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = T.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)
