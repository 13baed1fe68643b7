"""The corpus pipeline: quality, near duplicates, decontamination, secrets, tokens.

Each stage takes (spark, docs, sf_dir) and returns a table that is written and read
again as the next one's documents. The first four keep the columns of documents:

quality      fits the passage classifier on the labels whose documents' ids aren't
             held out, and drops documents that score below 0.3;
near_dups    keeps of each component of near duplicates the document of smallest id
             (of rows that repeat that id, each);
decontaminate drops documents with a passage of a benchmark item;
secrets      masks secrets in the texts and brings n_chars up to date;
tokens       encodes what is left, with each text's ids and decoded text as digests.

Null texts go through as empty texts. Rows without id are numbered beyond the largest
id for each stage's work and lose that number again, so they are compared, searched
and masked like others; a duplicate of a document with id is the one that goes. Rows
that repeat an id stay or go together. Extra columns stay as they are, whatever their
names. Empty tables give empty tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.llm.bpe import bpe_round_trip
from threadloom.llm.common import materialize, table
from threadloom.llm.decontaminate import contaminated
from threadloom.llm.jaccard_join import jaccard_components
from threadloom.llm.quality import held_out, score, train
from threadloom.llm.queries import word_bpe
from threadloom.llm.secret_scan import redact, secret_scan

LEAST_SCORE = 0.3


def fresh(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` doesn't have."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def numbered(docs: DataFrame) -> tuple[DataFrame, int | None]:
    """``docs`` with numbers for the ids that are missing, and the largest id before (None: none was missing)."""
    lost = docs.where("doc_id IS NULL")
    if lost.isEmpty():
        return docs, None
    top = docs.agg(F.max("doc_id")).first()[0]
    top = -1 if top is None else int(top)
    # Written, so that each use sees the same numbers.
    given = materialize(lost.withColumn("doc_id", F.monotonically_increasing_id() + (top + 1)), "numbered")
    return docs.where("doc_id IS NOT NULL").withColumn("doc_id", F.col("doc_id").cast("bigint")).unionByName(given), top


def without(docs: DataFrame, found: Callable[[DataFrame], DataFrame], label: str) -> DataFrame:
    """``docs`` without the documents whose ids ``found`` gives in its column doc_id."""
    every, top = numbered(docs)
    # Written, so that the planner knows how few there are.
    gone = materialize(found(every).select("doc_id").distinct(), label)
    kept = every.join(gone, "doc_id", "left_anti").select(docs.columns)
    return kept if top is None else kept.withColumn("doc_id", F.when(F.col("doc_id") <= top, F.col("doc_id")).cast(docs.schema["doc_id"].dataType))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = train(docs, table(spark, sf_dir, "labels"), learnable=~held_out(F.col("id")))
    name = fresh(docs, "score")
    return score(docs, model, score_col=name).where(F.col(name) >= LEAST_SCORE).drop(name)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without(docs, lambda every: jaccard_components(every).where("component_id <> doc_id"), "gone")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without(docs, lambda every: contaminated(every, table(spark, sf_dir, "benchmark")), "gone")


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Values that several owners carry are copied examples; they are masked like those that look live.
    found = secret_scan(docs).where(F.size("spans") > 0).select("doc_id").distinct()
    name = fresh(docs, "has_secret")
    marked = materialize(found.withColumn(name, F.lit(True)), "with-secrets")
    joined = docs.join(marked, "doc_id", "left")
    # Few have no id, so those are masked without asking.
    changed = F.col(name).isNotNull() | F.col("doc_id").isNull()
    text = F.when(changed, redact(F.col("text"))).otherwise(F.col("text"))
    return joined.withColumn("text", text).withColumn("n_chars", F.when(changed, F.char_length("text").cast(dict(docs.dtypes)["n_chars"])).otherwise(F.col("n_chars"))).select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    made = bpe_round_trip(docs, word_bpe(), outputs=("ids_text", "decoded"))
    return made.select("doc_id", "n_tokens", F.sha2("ids_text", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("secrets", secrets), ("tokens", tokens)]

# The classifier's and the retrieval's decisions can't be written in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
