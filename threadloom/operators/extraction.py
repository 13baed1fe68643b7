"""Typed knowledge records from messages: thoughts, entities, relationships, timelines, canonical entries.

Messages have canonical_id, message_id, conversation_id, source_file, role, ts and text.
Ids follow from content. "First" and "last" are by scan order (file, conversation,
time, id), never by arrival.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadloom.functions import predicates as P
from threadloom.functions import text as T
from threadloom.operators.ordering import numbered
from threadloom.storage import stored

EPOCH = "1970-01-01T00:00:00+00:00"
ENTITY_TYPES = ("person", "organization", "place", "product", "technology")
RELATION_TYPES = ("related_to", "builds_on", "supersedes", "contradicts", "depends_on", "part_of", "inspired_by", "evolved_into")
TIMELINE_EVENTS = ("originated", "developed", "approved", "implemented", "superseded", "rejected", "revisited", "completed")
SCAN = ("source_file", "conversation_id", "ts", "canonical_id")


def scan_order(alias: str = "ord"):
    return F.struct(F.col("source_file"), F.col("conversation_id"), F.coalesce("ts", F.lit("")).alias("ts"), F.col("canonical_id")).alias(alias)


def thoughts(messages: DataFrame, principal: str = "principal") -> DataFrame:
    """One row a message that isn't blank. The wide id is unique; the display id has seven digits and may collide."""
    text = F.trim(F.regexp_replace("text", r"^\s+|\s+$", ""))
    seed = T.seed("thought", F.col("canonical_id"), F.col("stripped"))
    rows = messages.withColumn("stripped", text).where("stripped <> ''")
    return rows.select(
        T.hashed_id("TH", seed, 24).alias("thought_id"), T.numbered_id("T", seed).alias("display_id"), T.safe_title(F.col("text")).alias("name"), T.thought_type(F.col("text")).alias("type"),
        T.originator(F.col("role"), principal).alias("originator"), T.role_class(F.col("role")).alias("evidence_class"), T.role_confidence(F.col("role")).alias("confidence"),
        F.coalesce("ts", F.lit(EPOCH)).alias("created_at"), T.summary(F.col("text")).alias("summary"), F.col("stripped").alias("detail"), "canonical_id", "message_id", "conversation_id", "source_file", "role", "ts",
    )


def unique_display_ids(rows: DataFrame, order: list[Column], seed: Column, prefix: str = "T", digits: int = 7, tries: int | None = None) -> DataFrame:
    """``rows`` with display ids that no two share, as a scan in ``order`` gives them: a row whose id an earlier one holds takes that of its seed with the number of rows before it added, and again where that is held too.

    An id belongs to the first row that asks for it, so rounds come to the same end as the
    scan: each takes the later askers' ids away, and they ask anew. A round reads ids and
    numbers; seeds are read for those that lost. ``tries``: how often a row may ask again;
    its last id stays, even where it is held too (off: ids are unique).
    """
    rows = rows.withColumn("_seed", seed).drop("display_id")
    placed = stored(numbered(rows, order, name="_i"), "placed")
    n = placed.count()
    if n > 10**digits:
        raise ValueError(f"{n} rows don't have ids of {digits} digits each")
    claims = stored(placed.select("_i", F.lit(0).alias("_tries"), T.numbered_id(prefix, F.col("_seed"), digits).alias("_id")), "claims")
    tried = 0
    while tries is None or tried < tries:
        held = claims.groupBy("_id").agg(F.min("_i").alias("_holder"), F.count("*").alias("_n")).where("_n > 1").select("_id", "_holder")
        lost = stored(claims.join(held, "_id").where("_i <> _holder").select("_i", (F.col("_tries") + 1).alias("_tries")), "lost")
        if lost.isEmpty():
            break
        more = F.concat(F.col("_seed"), F.expr("repeat(concat(chr(31), CAST(_i AS STRING)), _tries)"))
        anew = placed.select("_i", "_seed").join(lost, "_i").select("_i", "_tries", T.numbered_id(prefix, more, digits).alias("_id"))
        claims = stored(claims.join(lost.select("_i"), "_i", "left_anti").select("_i", "_tries", "_id").unionByName(anew), "claims")
        tried += 1
    return placed.join(claims.select("_i", F.col("_id").alias("display_id")), "_i").drop("_i", "_seed")


def display_ids(messages: DataFrame, principal: str = "principal", digits: int = 7, tries: int | None = None) -> DataFrame:
    """Thoughts with display ids that are unique, in the order in which messages are scanned; with ``tries`` a row asks for another id so many times at most."""
    made = thoughts(messages, principal)
    order = [F.col("source_file").asc(), F.col("conversation_id").asc(), F.coalesce("ts", F.lit("")).asc(), F.col("canonical_id").asc()]
    return unique_display_ids(made, order, T.seed("thought", F.col("canonical_id"), F.col("detail")), digits=digits, tries=tries)


def entity_mentions(messages: DataFrame) -> DataFrame:
    """One row a marker line that names an entity: its type stands in brackets, after a bar, or is the marker."""
    lines = messages.select(*SCAN, "role", F.posexplode(F.regexp_extract_all("text", F.lit(P.java(P.ENTITY_LINE)), F.lit(0))).alias("pos", "line"))
    raw = F.trim(F.regexp_extract("line", P.java(P.ENTITY_LINE), 2))
    kinds = "|".join(ENTITY_TYPES)
    pattern = rf"(?i)^\s*([^()|]+?)\s*(?:\(({kinds})\)|\|\s*({kinds}))?\s*$"
    part = lambda i: F.regexp_extract("raw", pattern, i)
    prefix = F.lower(F.regexp_extract("line", P.java(P.ENTITY_LINE), 1))
    named = lines.withColumn("raw", raw).withColumn("name", F.trim(part(1))).withColumn("type", F.lower(F.coalesce(F.nullif(part(2), F.lit("")), F.nullif(part(3), F.lit("")), prefix)))
    return named.where((F.col("name") != "") & F.col("type").isin(*ENTITY_TYPES)).withColumn("norm", T.normalized_key(F.col("name"))).where("norm <> ''").drop("raw", "line")


def entities(messages: DataFrame) -> DataFrame:
    """One row for a normalised name and type, with first and last mention in scan order."""
    at = F.struct(scan_order(), "pos")
    mentions = entity_mentions(messages).withColumn("at", at)
    grouped = mentions.groupBy("norm", "type").agg(
        F.min_by("name", "at").alias("name"), F.min_by("role", "at").alias("first_role"), F.min("at").alias("first"), F.max("at").alias("last"), F.count("*").alias("mention_count"),
        F.array_sort(F.collect_set("canonical_id")).alias("provenance_refs"),
    )
    return grouped.select(
        T.numbered_id("E", T.seed(F.col("type"), F.col("norm"))).alias("entity_id"), "name", "norm", "type", T.role_class(F.col("first_role")).alias("evidence_class"),
        F.col("first.ord.conversation_id").alias("first_conversation"), F.col("first.ord.ts").alias("first_ts"), F.col("last.ord.conversation_id").alias("last_conversation"), F.col("last.ord.ts").alias("last_ts"),
        "mention_count", "provenance_refs",
    )


def relationship_mentions(messages: DataFrame) -> DataFrame:
    """(a, type, b) of each marker line: three parts between bars, or free words with the longest type that occurs."""
    lines = messages.select(*SCAN, "role", F.explode(F.regexp_extract_all("text", F.lit(P.RELATION_LINE), F.lit(1))).alias("line")).withColumn("line", F.trim("line"))
    parts = F.transform(F.split("line", r"\|"), lambda x: F.trim(x))
    free = sorted(RELATION_TYPES, key=lambda t: (-len(t), t))
    spoken = lambda t: t.replace("_", " ")
    which = T.cases([(F.lower("line").contains(f" {spoken(t)} "), F.lit(t)) for t in free], F.lit(None))
    barred = F.size("parts") == 3
    rows = lines.withColumn("parts", parts).withColumn("rel", F.when(barred, F.lower(F.col("parts")[1])).otherwise(which))
    at = F.instr(F.lower("line"), F.translate("rel", "_", " "))
    left = F.when(barred, F.col("parts")[0]).otherwise(F.trim(F.expr("substring(line, 1, at - 1)")))
    right = F.when(barred, F.get("parts", F.lit(2))).otherwise(F.trim(F.expr("substring(line, at + length(rel))")))
    return rows.where("rel IS NOT NULL").withColumn("at", at).select(*SCAN, "role", left.alias("a"), F.col("rel").alias("type"), right.alias("b"))


def relationships(messages: DataFrame, thought_rows: DataFrame, entity_rows: DataFrame) -> DataFrame:
    """Marker lines whose both ends are known; a thought's summary goes before an entity's name."""
    names = thought_rows.select(T.normalized_key(F.col("summary")).alias("norm"), F.col("thought_id").alias("id"), F.lit(0).alias("rank")).where("norm <> ''").unionByName(entity_rows.select("norm", F.col("entity_id").alias("id"), F.lit(1).alias("rank")))
    lookup = names.groupBy("norm").agg(F.min(F.struct("rank", "id")).alias("x")).select("norm", F.col("x.id").alias("id"))
    found = relationship_mentions(messages).where(F.col("type").isin(*RELATION_TYPES)).withColumn("na", T.normalized_key(F.col("a"))).withColumn("nb", T.normalized_key(F.col("b")))
    joined = found.join(lookup.select(F.col("norm").alias("na"), F.col("id").alias("source_id")), "na").join(lookup.select(F.col("norm").alias("nb"), F.col("id").alias("target_id")), "nb")
    seed = T.seed(F.col("source_id"), F.col("type"), F.col("target_id"), F.col("canonical_id"))
    return joined.select(T.hashed_id("R", seed).alias("relationship_id"), "source_id", "type", "target_id", T.role_class(F.col("role")).alias("evidence_class"), "canonical_id").dropDuplicates(["relationship_id"])


def timelines(messages: DataFrame, thought_rows: DataFrame) -> DataFrame:
    """An origin for each thought, and the marker lines with a known event. One id has one date, event and description; where messages share it, the greatest subject stands."""
    own = thought_rows.select(F.col("thought_id").alias("subject_id"), F.substring("created_at", 1, 10).alias("date"), F.lit("originated").alias("event"), F.col("summary").alias("description"))
    own = own.select(T.hashed_id("TL", T.seed("originated", F.col("subject_id"), F.col("date"))).alias("timeline_id"), "subject_id", "date", "event", "description")
    lines = messages.select("canonical_id", F.explode(F.regexp_extract_all("text", F.lit(P.TIMELINE_LINE), F.lit(0))).alias("line"))
    part = lambda i: F.trim(F.regexp_extract("line", P.TIMELINE_LINE, i))
    said = lines.select("canonical_id", part(1).alias("date"), F.lower(part(2)).alias("event"), part(3).alias("description")).where(F.col("event").isin(*TIMELINE_EVENTS))
    said = said.join(thought_rows.select("canonical_id", F.col("thought_id").alias("subject_id")), "canonical_id")
    seed = T.seed("explicit", F.col("canonical_id"), F.col("date"), F.col("event"), F.col("description"))
    return own.unionByName(said.select(T.hashed_id("TL", seed).alias("timeline_id"), "subject_id", "date", "event", "description")).groupBy("timeline_id").agg(F.max(F.struct("subject_id", "date", "event", "description")).alias("x")).select("timeline_id", "x.*")


def canonical_records(thought_rows: DataFrame) -> DataFrame:
    """One record a normalised summary: the first thought's detail, then a line for each further one. Details of the others never meet: of a group only ids and summaries are gathered."""
    place = F.struct(F.col("source_file"), F.col("conversation_id"), F.coalesce("ts", F.lit("")).alias("ts"), F.col("thought_id"))
    item = F.struct(*(F.col("place")[c].alias(c) for c in ("source_file", "conversation_id", "ts", "thought_id")), F.col("message_id"), F.col("summary"))
    keyed = thought_rows.withColumn("key", T.normalized_key(F.col("summary"))).where("key <> ''").withColumn("place", place)
    grouped = keyed.groupBy("key").agg(F.min_by(F.struct("summary", "detail"), "place").alias("first"), F.sort_array(F.collect_list(item)).alias("items"))
    more = F.transform(F.slice("items", 2, F.greatest(F.size("items") - 1, F.lit(1))), lambda x: F.concat(F.lit("- "), x["summary"], F.lit(" ("), x["thought_id"], F.lit(")")))
    content = F.when(F.size("items") > 1, F.concat(F.col("first.detail"), F.lit("\n\nAdditional provenance-backed occurrences:\n"), F.array_join(more, "\n"))).otherwise(F.col("first.detail"))
    evidence = F.array_sort(F.array_distinct(F.concat(F.transform("items", lambda x: x["thought_id"]), F.transform("items", lambda x: x["message_id"]))))
    return grouped.select(
        T.hashed_id("MBK-EXTRACT-", F.col("key"), 12, upper=True).alias("knowledge_id"), F.lit(1).alias("revision"), F.lit("CURRENT").alias("canonical_status"), T.safe_title(F.col("first.summary")).alias("title"),
        F.col("first.summary").alias("summary"), content.alias("content"), evidence.alias("evidence_ids"), F.lit("ACCEPTED").alias("approval_status"), F.lit("PUBLISH").alias("projection_policy"),
    )


def relay_events(messages: DataFrame, least_chars: int = 200) -> DataFrame:
    """Messages that relay others' turns, with the actors in order."""
    actors = F.regexp_extract_all("text", F.lit(P.RELAY_HEADER), F.lit(1))
    return messages.where(F.char_length("text") >= least_chars).select("canonical_id", "conversation_id", actors.alias("actors")).where(F.size("actors") >= 1)
