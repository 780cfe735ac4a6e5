"""The training-data pipeline: toxicity, near copies, benchmark leaks, source mix, token files.

Each stage takes all that the one before kept. All but the last return the
columns of ``documents``; the last writes the token shards and returns, read
back from them, each document's place and the checksum of its ids.
"""

from pyspark.sql import DataFrame, SparkSession

from vitals.llm import curriculum, decontaminate, minhash, tokens, toxicity
from vitals.llm.common import stored, table

#: SQL has no way to train a classifier or to tokenize; tests/llm compares with brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).filter("score < 0.5").select("doc.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays, the first by id."""
    return minhash.deduplicated(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, whole or edited, go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, as often as their source's target asks; whole where a target ends within one."""
    mixed = curriculum.mix(docs, keep=docs.columns)
    return curriculum.training_order(mixed).select("kept.*")


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards of all that is left."""
    return tokens.read_documents(spark, tokens.write(docs))


STAGES = [
    ("toxicity", drop_toxic), ("near_duplicates", drop_near_copies), ("decontamination", drop_leaks),
    ("source_mix", mix_sources), ("token_output", write_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
