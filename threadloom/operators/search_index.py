"""A written index for ranked search: what a query reads grows with its words' posting lists, not with the store.

Words lie in buckets by their hash and in order within them, so a query opens its words'
buckets alone and of their files only the parts in which the words can be. A posting
holds the places of a word in a record; the phrase is looked for where its words stand
in a row, and its exact text, punctuation included, in the few records that are left.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from threadloom.operators.store import searchable, tokens

WORD = "[a-z0-9]+"


def _bucket(word: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(buckets)).cast("int").alias("bucket")


SLICES = 16  # parts in which a bucket's postings are sorted and written


def postings_of(rows: DataFrame) -> DataFrame:
    """(doc, current, word, places): where each word stands in each row. Texts are dealt by rows, in which all of a word's places lie, so that no place is shuffled."""
    texts = rows.select("doc", (F.col("canonical_status") == "CURRENT").alias("current"), searchable().alias("text")).repartition("doc")
    each = texts.select("doc", "current", F.posexplode(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("place", "word"))
    return each.groupBy("doc", "current", "word").agg(F.array_sort(F.collect_list("place")).alias("places"))


def build(store: DataFrame, path: str, buckets: int = 64) -> None:
    """Writes rows (with their number doc), postings (doc, current, word, places) and words (how many records have each) below ``path``."""
    spark = store.sparkSession
    numbered = store.withColumn("doc", F.monotonically_increasing_id())
    numbered.select("*", F.pmod("doc", F.lit(buckets)).cast("int").alias("part")).write.partitionBy("part").parquet(f"{path}/rows")
    fields = StructType([*numbered.schema, StructField("part", IntegerType())])
    rows = spark.read.schema(fields).parquet(f"{path}/rows")
    postings = postings_of(rows).select("*", _bucket(F.col("word"), buckets))
    # By slices of rows, so that a word that most records have lies in many files; ranges would make all postings twice to find their borders.
    sliced = postings.repartition("bucket", F.pmod(F.xxhash64("doc"), F.lit(SLICES)))
    sliced.sortWithinPartitions("bucket", "word", "doc").write.partitionBy("bucket").parquet(f"{path}/postings")
    counts = spark.read.schema(POSTINGS).parquet(f"{path}/postings").groupBy("bucket", "word").agg(F.count("*").alias("n"))
    counts.repartitionByRange("bucket", "word").sortWithinPartitions("bucket", "word").write.partitionBy("bucket").parquet(f"{path}/words")
    # Last: an index without it isn't whole.
    spark.createDataFrame([(buckets, numbered.schema.json())], "buckets int, fields string").coalesce(1).write.parquet(f"{path}/size")


POSTINGS = "doc bigint, current boolean, word string, places array<int>, bucket int"


def buckets_of(spark: SparkSession, path: str) -> int:
    """How many buckets an index was built with."""
    return spark.read.parquet(f"{path}/size").first()["buckets"]


def _rows(spark: SparkSession, path: str) -> DataFrame:
    fields = StructType.fromJson(json.loads(spark.read.parquet(f"{path}/size").first()["fields"]))
    return spark.read.schema(StructType([*fields, StructField("part", IntegerType())])).parquet(f"{path}/rows")


def _postings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(POSTINGS).parquet(f"{path}/postings")


def lists(spark: SparkSession, path: str, words: list[str], buckets: int) -> DataFrame:
    """The words' postings; others' buckets aren't opened."""
    where = [r[0] for r in spark.createDataFrame([(w,) for w in words], "word string").select(_bucket(F.col("word"), buckets)).distinct().collect()]
    return _postings(spark, path).where(F.col("bucket").isin(where) & F.col("word").isin(words))


def phrase_docs(spark: SparkSession, path: str, phrase: str, buckets: int, include_history: bool) -> tuple[DataFrame, bool]:
    """(doc): records that hold the phrase, wherever its ends lie within words; and whether each of them has one of the phrase's words as a whole."""
    order = spark.range(1).select(F.regexp_extract_all(F.lit(phrase), F.lit(WORD), F.lit(0)).alias("w")).first()["w"]
    rows = _rows(spark, path).where("canonical_status = 'CURRENT' OR " + str(include_history).lower())
    holds = F.contains(searchable(), F.lit(phrase))
    if not order:
        # Nothing but punctuation stands in no list.
        return rows.where(holds).select("doc"), False
    first, last = phrase.startswith(order[0]), phrase.endswith(order[-1])
    vocabulary = spark.read.schema("word string, n bigint, bucket int").parquet(f"{path}/words").select("word")
    met, exact = None, []
    for at, word in enumerate(order):
        opens, closes = at == 0 and first, at == len(order) - 1 and last
        if opens or closes:
            found = F.contains("word", F.lit(word)) if opens and closes else F.endswith("word", F.lit(word)) if opens else F.startswith("word", F.lit(word))
            alike = vocabulary.where(found)
            slot = _postings(spark, path).join(alike.withColumn("bucket", _bucket(F.col("word"), buckets)), ["bucket", "word"], "left_semi")
        else:
            exact.append(word)
            slot = lists(spark, path, [word], buckets)
        placed = slot.where(F.col("current") | F.lit(include_history)).select("doc", F.explode("places").alias("p")).select("doc", (F.col("p") - at).alias("base")).distinct()
        met = placed if met is None else met.join(placed, ["doc", "base"], "left_semi")
    candidates = met.select("doc").distinct().select("doc", F.pmod("doc", F.lit(buckets)).cast("int").alias("part"))
    return rows.join(candidates, ["part", "doc"], "left_semi").where(holds).select("doc"), bool(exact)


def search(spark: SparkSession, path: str, query: str, include_history: bool = False, limit: int = 10) -> DataFrame:
    """The rows that ``store.search`` gives for the store that was indexed, with their scores."""
    if not query.strip() or not 1 <= limit <= 100:
        raise ValueError("a query needs text, and a limit from 1 to 100")
    phrase, buckets = query.strip().lower(), buckets_of(spark, path)
    own = spark.range(1).select(tokens(F.lit(phrase)).alias("w")).first()["w"]
    holding, whole = phrase_docs(spark, path, phrase, buckets, include_history)
    bonus = holding.select("doc", F.lit(max(2, len(own))).alias("bonus"))
    if own:
        found = lists(spark, path, own, buckets).where(F.col("current") | F.lit(include_history)).select("doc")
        # Who holds the phrase and one of its words as a whole scores more than all words give; enough of these leave out the others.
        if whole and holding.limit(limit).count() == limit:
            found = found.join(holding, "doc", "left_semi")
        scored = found.groupBy("doc").agg(F.count("*").alias("n")).join(bonus, "doc", "full").select("doc", (F.coalesce("n", F.lit(0)) + F.coalesce("bonus", F.lit(0))).cast("int").alias("score"))
    else:
        scored = bonus.select("doc", F.col("bonus").alias("score"))
    # The least score that can be among the best; what lies below isn't looked up.
    least, left = 1, limit
    for row in sorted(scored.groupBy("score").count().collect(), reverse=True):  # scores are at most twice the words
        left -= row["count"]
        least = row["score"]
        if left <= 0:
            break
    best = scored.where(F.col("score") >= least).withColumn("part", F.pmod("doc", F.lit(buckets)).cast("int"))
    rows = _rows(spark, path)
    return rows.join(best, ["part", "doc"]).orderBy(F.desc("score"), F.desc("revision"), "knowledge_id").limit(limit).drop("part", "doc")
