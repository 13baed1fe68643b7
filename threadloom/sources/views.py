"""Deterministic views over the test tables: messages from conversations, reuse records from documents.

The conversations have neither times, parents nor marker lines, so the view adds them
by arithmetic on (conv_id, turn): each rule of the engine meets rows for which it holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.functions import text as T

# In SQL that Spark and DuckDB share, so that an oracle starts from the same rows.
MESSAGES_SQL = """
SELECT conv_id, turn, role, concat('conv-', CAST(conv_id AS STRING)) AS conversation_id, concat('m-', CAST(conv_id AS STRING), '-', CAST(turn AS STRING)) AS message_id,
       CASE WHEN turn = 0 THEN NULL ELSE concat('m-', CAST(conv_id AS STRING), '-', CAST(turn - 1 AS STRING)) END AS parent_message_id,
       concat('conversations-', lpad(CAST(conv_id % 35 AS STRING), 3, '0'), '.json') AS source_file,
       concat('2024-', lpad(CAST(1 + (conv_id % 12) AS STRING), 2, '0'), '-', lpad(CAST(1 + (conv_id % 28) AS STRING), 2, '0'), 'T', lpad(CAST(turn % 24 AS STRING), 2, '0'), ':00:00+00:00') AS ts,
       CASE WHEN (conv_id * 7 + turn) % 19 = 0 THEN concat('Decision: adopt plan ', CAST(conv_id % 5 AS STRING), '.', chr(10), own)
            WHEN (conv_id * 7 + turn) % 19 = 1 THEN concat('Entity: Tool', CAST(conv_id % 7 AS STRING), ' (product)', chr(10), own)
            WHEN (conv_id * 7 + turn) % 19 = 2 THEN concat('Person: Name', CAST(conv_id % 9 AS STRING), chr(10), own)
            WHEN (conv_id * 7 + turn) % 19 = 3 THEN concat('relationship: Tool', CAST(conv_id % 7 AS STRING), ' | depends_on | Name', CAST(conv_id % 9 AS STRING), chr(10), own)
            WHEN (conv_id * 7 + turn) % 19 = 4 THEN concat('timeline: 2024-05-0', CAST(1 + conv_id % 9 AS STRING), ' | approved | step ', CAST(turn AS STRING), chr(10), own)
            WHEN role <> 'user' THEN own
            WHEN (conv_id * 7 + turn) % 19 = 5 THEN 'Yes, add this to the plan.'
            WHEN (conv_id * 7 + turn) % 19 = 6 THEN 'no, not what i meant'
            WHEN (conv_id * 7 + turn) % 19 = 7 THEN 'yes, but change the title to Plan B'
            WHEN (conv_id * 7 + turn) % 19 = 8 THEN concat('Here is a thought on it all. ', chr(10), before)
            WHEN (conv_id * 7 + turn) % 19 = 9 THEN concat('can you rewrite this email below:', chr(10), chr(10), before)
            WHEN (conv_id * 7 + turn) % 19 = 10 THEN 'maybe'
            WHEN (conv_id * 7 + turn) % 19 = 11 THEN concat(own, chr(10), 'Unsubscribe here: https://a.example privacy policy', chr(10), own)
            WHEN (conv_id * 7 + turn) % 19 = 12 THEN concat('Pros: 1. fast', chr(10), 'Cons: 1. dear', chr(10), own)
            WHEN (conv_id * 7 + turn) % 19 = 13 THEN before
            WHEN (conv_id * 7 + turn) % 19 = 14 THEN concat('Entity: Tool3 | technology', chr(10), own)
            WHEN (conv_id * 7 + turn) % 19 = 15 THEN concat('Please summarize the transcript of a youtube video for me. The entire transcript is given below.', chr(10), before)
            WHEN (conv_id * 7 + turn) % 19 = 16 THEN concat('## Plan', chr(10), '| a | b |', chr(10), own)
            WHEN (conv_id * 7 + turn) % 19 = 17 THEN concat('Agent One [9:15 AM] ', own, chr(10), 'Agent Two [10:20 PM] "', own, '"')
            ELSE own END AS text
FROM (SELECT conv_id, turn, role, coalesce(text, '') AS own, coalesce(lag(text) OVER (PARTITION BY conv_id ORDER BY turn), '') AS before FROM conversations) c
"""

REUSE_SQL = """
SELECT doc_id AS canonical_id, text, source, CASE WHEN doc_id % 10 = 9 THEN NULL ELSE doc_id END AS ts,
       CASE WHEN doc_id % 3 = 0 THEN 'user' ELSE 'assistant' END AS role
FROM documents
"""


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = spark.sql(MESSAGES_SQL.replace("FROM conversations", "FROM {conversations}"), conversations=read(spark, sf_dir, "conversations"))
    return made.withColumn("canonical_id", T.source_record_id(F.col("source_file"), F.col("conversation_id"), F.col("message_id")))


def reuse_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(REUSE_SQL.replace("FROM documents", "FROM {documents}"), documents=read(spark, sf_dir, "documents"))
