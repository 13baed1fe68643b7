"""Readers of exports: chat trees, fragment trees, flat CSV, JSON lines, markdown notes, wiki blocks, releases.

Schemas are explicit. A strict reader fails on the first bad record, a lenient one drops it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threadloom.functions import text as T

MESSAGE = "struct<id:string, author:struct<role:string, name:string>, create_time:double, content:struct<content_type:string, parts:variant, content:string, thoughts:array<struct<content:string>>>>"
CHAT = f"id string, conversation_id string, title string, create_time double, current_node string, mapping map<string, struct<id:string, parent:string, message:{MESSAGE}>>"
FRAGMENTS = "id string, title string, inserted_at string, mapping map<string, struct<id:string, parent:string, children:array<string>, message:struct<model:string, inserted_at:string, fragments:array<struct<type:string, content:string>>>>>"
CSV = "Conversation string, Time string, Author string, Message string"
BLOCKS = "page_id string, page_title string, created_time string, last_edited_time string, blocks array<struct<depth:int, id:string, type:string, text:string>>, raw_text string"
EXPORT_NAME = r"^conversations-[0-9]{3}\.json\z"
VERSION = "1.1.0"


class SourceError(RuntimeError):
    """A source is missing or breaks its contract."""


def file_name() -> Column:
    return F.col("_metadata.file_name")


def chat_export(spark: SparkSession, path: str) -> DataFrame:
    """One row a conversation of all files conversations-NNN.json; an error without any."""
    rows = spark.read.schema(CHAT).option("multiLine", True).option("mode", "FAILFAST").option("pathGlobFilter", "conversations-*.json").json(path)
    named = rows.withColumn("source_file", file_name()).where(F.col("source_file").rlike(EXPORT_NAME))
    if named.isEmpty():
        raise SourceError(f"no conversations-NNN.json in {path}")
    return named.withColumn("conversation_id", F.coalesce("conversation_id", "id"))


def joined_text(content: Column) -> Column:
    """A message's text by its content type; of the parts only those that are strings in the export count, whatever they hold."""
    kind = content["content_type"]
    # A variant keeps what a part was; strings come with their quotes, so that text that looks like an object stays text.
    parts = F.coalesce(F.try_variant_get(content["parts"], "$", "array<variant>"), F.array().cast("array<variant>"))
    plain = F.transform(F.filter(parts, lambda p: F.schema_of_variant(p) == "STRING"), lambda p: F.try_variant_get(p, "$", "string"))
    told = F.transform(F.coalesce(content["thoughts"], F.array().cast("array<struct<content:string>>")), lambda t: t["content"])
    return T.cases([(kind.isin("text", "multimodal_text"), F.array_join(plain, "\n")), (kind == "reasoning_recap", F.coalesce(content["content"], F.lit(""))), (kind == "thoughts", F.array_join(told, "\n\n"))], "")


def chat_nodes(conversations: DataFrame) -> DataFrame:
    """(source_file, conversation_id, conversation_title, node_id, parent, message): one row a node."""
    keyed = conversations.select("source_file", "conversation_id", F.col("title").alias("conversation_title"), "current_node", F.explode("mapping").alias("node_id", "node"))
    return keyed.select("source_file", "conversation_id", "conversation_title", "current_node", "node_id", F.col("node.parent").alias("parent"), F.col("node.message").alias("message"))


def chat_messages(conversations: DataFrame) -> DataFrame:
    """Normalised messages of chat trees, with place and branch."""
    from threadloom.operators import messages as M

    nodes = chat_nodes(conversations)
    key = F.concat_ws("\x1f", "source_file", "conversation_id").alias("conversation_id")
    tree = nodes.select(key, "node_id", "parent")
    path = M.main_path(tree, conversations.select(key, "current_node")).withColumnRenamed("conversation_id", "tree")
    children = M.child_lists(tree).withColumnRenamed("conversation_id", "tree")
    told = nodes.where("message IS NOT NULL").withColumn("tree", F.concat_ws("\x1f", "source_file", "conversation_id")).join(path, ["tree", "node_id"], "left").join(children, ["tree", "node_id"], "left")
    message_id = F.coalesce("message.id", "node_id")
    return told.select(
        T.source_record_id(F.col("source_file"), F.col("conversation_id"), message_id).alias("source_record_id"), message_id.alias("message_id"), "node_id", "conversation_id", "conversation_title", "source_file",
        F.col("message.author.role").alias("role"), F.col("message.author.name").alias("author_name"), T.iso_from_seconds(F.col("message.create_time")).alias("timestamp"), F.col("message.content.content_type").alias("content_type"),
        F.col("parent").alias("parent_message_id"), joined_text(F.col("message.content")).alias("text"), "branch", "sequence_index", F.coalesce("children", F.array().cast("array<string>")).alias("child_message_ids"), F.lit(VERSION).alias("ingest_version"),
    )


def fragment_messages(spark: SparkSession, path: str) -> DataFrame:
    """One row a fragment of each node; requests are the user's."""
    rows = spark.read.schema(FRAGMENTS).option("multiLine", True).option("mode", "FAILFAST").json(path).withColumn("source_file", file_name())
    nodes = rows.select(F.col("id").alias("conversation_id"), F.col("title").alias("conversation_title"), "source_file", F.explode("mapping").alias("node_id", "node")).where("node.message IS NOT NULL")
    cut = nodes.select("*", F.posexplode("node.message.fragments").alias("fragment_index", "fragment"))
    role = T.cases([(F.col("fragment.type") == "REQUEST", F.lit("user")), (F.col("fragment.type") == "RESPONSE", F.lit("assistant"))], "unknown")
    message_id = F.concat_ws("#", "node_id", F.col("fragment_index").cast("string"))
    return cut.select(
        T.source_record_id(F.col("source_file"), F.col("conversation_id"), message_id).alias("source_record_id"), message_id.alias("message_id"), "node_id", "conversation_id", "conversation_title", "source_file", role.alias("role"),
        F.col("node.message.inserted_at").alias("timestamp"), F.col("node.parent").alias("parent_message_id"), F.coalesce("fragment.content", F.lit("")).alias("text"), F.col("node.message.model").alias("model"), "fragment_index", F.col("fragment.type").alias("fragment_type"), F.lit("fragment").alias("source_format"), F.lit("2.0.0").alias("ingest_version"),
    )


def csv_messages(spark: SparkSession, path: str) -> DataFrame:
    """Flat export with a byte order mark; the row number is the place in the file (multi-line files aren't split)."""
    rows = spark.read.schema(CSV).option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path)
    ordered = rows.withColumn("source_file", file_name()).withColumn("n", F.monotonically_increasing_id())
    number = ordered.withColumn("csv_row_number", F.col("n") - F.min("n").over(Window.partitionBy("source_file")))
    role = T.cases([(F.col("Author") == "Human", F.lit("user")), (F.col("Author") == "AI", F.lit("assistant"))], "unknown")
    return number.select(
        T.hashed_id("csvmsg_", T.seed(F.col("source_file"), F.col("csv_row_number")), 32).alias("source_record_id"), F.col("Conversation").alias("conversation_title"), T.hashed_id("csvconv_", F.coalesce("Conversation", F.lit("")), 32).alias("conversation_id"), "source_file", role.alias("role"),
        F.col("Time").alias("timestamp"), F.coalesce("Message", F.lit("")).alias("text"), F.col("Author").alias("source_author"), "csv_row_number", F.lit("csv").alias("source_format"), F.lit("1.0.0").alias("ingest_version"),
    )


def json_lines(spark: SparkSession, path: str, schema: str, mode: str = "strict") -> DataFrame:
    """strict: a bad line is an error; lenient: it is left out; tolerant: a missing or empty file has no rows."""
    if mode == "tolerant":
        jvm = spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
            return spark.createDataFrame([], schema)
    lines = spark.read.text(path).where("trim(value) <> ''")
    if mode == "strict":
        return lines.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")
    parsed = lines.select(F.from_json("value", f"{schema}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r"))
    return parsed.select("r.*").where("_bad IS NULL").drop("_bad")


def notes(spark: SparkSession, path: str) -> DataFrame:
    """Markdown notes below a folder: path, hash, front matter as a map, body."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.md").select(F.col("_metadata.file_path").alias("source_path"), F.col("value").alias("text"))
    return files.select("source_path", F.sha2("text", 256).alias("source_hash"), front_matter(F.col("text")).alias("fields"), F.regexp_replace("text", r"(?s)\A---\s*\n.*?\n---\s*\n", "").alias("body"))


def front_matter(text: Column) -> Column:
    """map<string, string> of ``key: value`` lines between the first two rules, without a pair of quotes around values; of a key that is written twice the last value holds."""
    block = F.regexp_extract(text, r"(?s)\A---\s*\n(.*?)\n---\s*\n", 1)
    pairs = F.filter(F.split(block, "\n"), lambda x: x.contains(":") & (F.trim(F.substring_index(x, ":", 1)) != ""))
    entry = lambda x: F.struct(F.trim(F.substring_index(x, ":", 1)).alias("key"), F.regexp_replace(F.trim(F.regexp_replace(x, r"\A[^:]*:", "")), r"(?s)\A([\"'])(.*)\1\z", "$2").alias("value"))
    every = F.transform(pairs, entry)
    later = lambda e, i: F.exists(F.slice(e, i + 2, F.size(e)), lambda y: y["key"] == F.get(e, i)["key"])
    return F.map_from_entries(F.flatten(F.transform(F.array(every), lambda e: F.filter(e, lambda x, i: ~later(e, i)))))


def typed_value(value: Column, negative: bool = True) -> Column:
    """A front matter value as a variant: true and false in any case, whole numbers (``negative``: with a minus too), else text."""
    number = F.rlike(value, F.lit(r"\A-?[0-9]{1,18}\z" if negative else r"\A[0-9]{1,18}\z"))
    text = F.to_variant_object(F.array(value))
    return T.cases([(F.lower(value).isin("true", "false"), F.parse_json(F.lower(value))), (number, F.parse_json(value.try_cast("bigint").cast("string")))], F.variant_get(text, "$[0]", "variant"))


def typed_fields(fields: Column, negative: bool = True) -> Column:
    """Front matter with typed values: map<string, variant>."""
    return F.transform_values(fields, lambda _, v: typed_value(v, negative))


def block_text(kind: Column, text: Column) -> Column:
    """A wiki block as markdown."""
    prefix = {"heading_1": "# ", "heading_2": "## ", "heading_3": "### ", "bulleted_list_item": "- ", "numbered_list_item": "1. ", "to_do": "- [ ] ", "quote": "> "}
    return T.cases([(kind == k, F.concat(F.lit(p), text)) for k, p in prefix.items()] + [(kind == "code", F.concat(F.lit("```\n"), text, F.lit("\n```"))), (kind == "divider", F.lit("---"))], text)


PHONE = r"\+?\d[\d ().-]{7,}\d"


def property_text(kind: Column, value: Column) -> Column:
    """A page's property as text; telephone numbers are masked."""
    return T.cases([(kind == "checkbox", F.when(value == "true", "yes").otherwise("no")), (kind == "phone_number", F.regexp_replace(value, PHONE, "[REDACTED]")), (kind.isin("multi_select", "people", "relation"), F.regexp_replace(value, r"\s*[;,]\s*", ", "))], value)


def block_tree(blocks: DataFrame, most_depth: int = 4, child_pages: bool = False) -> DataFrame:
    """(page_id, id, type, text, depth, path) of the blocks that a walk from each page reaches, at most ``most_depth`` levels.

    ``blocks``: (page_id, id, parent_id (null: at the page's top), ord, type, text). ``path``
    orders them as they stand. Below child pages the walk goes on only if asked to.
    """
    step = F.lpad(F.col("ord").cast("string"), 8, "0")
    level = blocks.where("parent_id IS NULL").select("page_id", "id", "type", "text", F.lit(0).alias("depth"), step.alias("path"))
    found = level
    for depth in range(1, most_depth):
        open_ = level if child_pages else level.where("type <> 'child_page'")
        above = open_.select("page_id", F.col("id").alias("parent_id"), F.col("path").alias("above"))
        level = blocks.join(above, ["page_id", "parent_id"]).select("page_id", "id", "type", "text", F.lit(depth).alias("depth"), F.concat("above", F.lit("."), step).alias("path"))
        found = found.unionByName(level)
    return found


def tree_markdown(tree: DataFrame) -> DataFrame:
    """(page_id, markdown): each page's blocks in order, two spaces a level."""
    line = F.concat(F.expr("repeat('  ', depth)"), block_text(F.col("type"), F.coalesce("text", F.lit(""))))
    return tree.groupBy("page_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("path", line.alias("line")))), lambda x: x["line"]), "\n").alias("markdown"))


def wiki_pages(spark: SparkSession, path: str, most_depth: int = 4) -> DataFrame:
    """Pages with their blocks' markdown, blocks below ``most_depth`` left out."""
    pages = spark.read.schema(BLOCKS).json(path)
    lines = F.transform(F.filter("blocks", lambda b: b["depth"] < most_depth), lambda b: block_text(b["type"], F.coalesce(b["text"], F.lit(""))))
    return pages.withColumn("markdown", F.array_join(lines, "\n"))


def latest_release(spark: SparkSession, path: str, release_id: str | None = None) -> DataFrame:
    """A frozen release: the given one, or the last by name of those in the release table."""
    table = spark.read.parquet(f"{path}/releases")
    chosen = release_id or table.agg(F.max("release_id")).first()[0]
    if chosen is None:
        raise SourceError(f"no release in {path}")
    return spark.read.parquet(f"{path}/data/{chosen}")
