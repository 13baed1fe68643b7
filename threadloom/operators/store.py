"""Governed store: lookup and ranked search over revisions, intake, review, projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.functions.text import cases, yaml_value

STATUSES = ("CANDIDATE", "CURRENT", "SUPERSEDED", "REJECTED", "CONFLICT", "RETIRED")


class NotFound(LookupError):
    """No such id or revision."""


def current(store: DataFrame) -> DataFrame:
    return store.where("canonical_status = 'CURRENT'")


def get(store: DataFrame, knowledge_id: str, revision: int | None = None) -> DataFrame:
    """The exact revision, or the current one; NotFound without."""
    found = store.where(F.col("knowledge_id") == knowledge_id.strip())
    found = current(found) if revision is None else found.where(F.col("revision") == revision)
    if found.isEmpty():
        raise NotFound(f"{knowledge_id}, revision {revision or 'current'}")
    return found


def tokens(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0)))


def searchable() -> Column:
    """The text that a search looks through, in lower case."""
    return F.lower(F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("summary", F.lit("")), F.coalesce("content", F.lit(""))))


def search(store: DataFrame, query: str, include_history: bool = False, limit: int = 10) -> DataFrame:
    """Distinct query words found, plus a bonus if the whole phrase occurs; best first, then newer revision, then id."""
    if not query.strip() or not 1 <= limit <= 100:
        raise ValueError("a query needs text, and a limit from 1 to 100")
    phrase = query.strip().lower()
    text = searchable()
    own = tokens(F.lit(phrase))
    score = F.size(F.array_intersect(own, tokens(text))) + F.when(F.contains(text, F.lit(phrase)), F.greatest(F.lit(2), F.size(own))).otherwise(0)
    rows = store if include_history else current(store)
    return rows.withColumn("score", score).where("score > 0").orderBy(F.desc("score"), F.desc("revision"), "knowledge_id").limit(limit)


def violations(store: DataFrame) -> DataFrame:
    """(rule, knowledge_id) of each breach of the store's contract."""
    rule = lambda df, name: df.select(F.lit(name).alias("rule"), "knowledge_id")
    return (
        rule(store.groupBy("knowledge_id", "revision").count().where("count > 1"), "duplicate_revision")
        .unionByName(rule(current(store).groupBy("knowledge_id").count().where("count > 1"), "several_current"))
        .unionByName(rule(store.where(~F.col("canonical_status").isin(*STATUSES)), "unknown_status"))
        .unionByName(rule(store.where(F.size("evidence_ids") == 0), "no_evidence"))
    )


def note_fields(notes: DataFrame) -> DataFrame:
    """Notes as read from a folder (source_path, source_hash, fields, body) with the fields that a candidate proposes."""
    field = lambda name: F.get(F.map_values(F.map_filter("fields", lambda k, v: k == name)), F.lit(0))
    refs = F.filter(F.split(F.coalesce(field("provenance_refs"), F.lit("")), r"\s*,\s*"), lambda x: x != "")
    return notes.select(
        "source_path", "source_hash", F.coalesce(field("proposed_operation"), F.lit("UNKNOWN")).alias("proposed_operation"), F.nullif(field("proposed_knowledge_id"), F.lit("")).alias("proposed_knowledge_id"),
        F.expr("try_cast(get(map_values(map_filter(fields, (k, v) -> k = 'base_canonical_revision')), 0) AS INT)").alias("base_canonical_revision"), F.trim(F.col("body"), F.lit(" \n")).alias("content"), refs.alias("evidence_ids"), F.coalesce(field("submitter"), F.lit("")).alias("submitter"),
    )


def intake(notes: DataFrame, queue: DataFrame, store: DataFrame) -> DataFrame:
    """New queue rows of ``notes`` (source_path, source_hash, ...): unchanged notes are left out, revisions count on, and the status tells whether the base is stale."""
    fresh = notes.join(queue.select("source_path", "source_hash"), ["source_path", "source_hash"], "left_anti")
    last = queue.groupBy("source_path").agg(F.max("candidate_revision").alias("last"))
    now = current(store).select(F.col("knowledge_id").alias("proposed_knowledge_id"), F.col("revision").alias("now"))
    status = cases([(F.col("now").isNull(), F.lit("SUBMITTED")), (F.col("base_canonical_revision") < F.col("now"), F.lit("CONFLICT_OPEN"))], "REVIEW_READY")
    joined = fresh.join(last, "source_path", "left").join(now, "proposed_knowledge_id", "left")
    return joined.select(F.concat(F.lit("MBC-"), F.upper(F.substring(F.sha2("source_path", 256), 1, 16))).alias("candidate_id"), (F.coalesce("last", F.lit(0)) + 1).alias("candidate_revision"), "source_path", "source_hash", "proposed_operation", "proposed_knowledge_id", "base_canonical_revision", "content", "evidence_ids", status.alias("status"))


def _words(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(c, F.lit(r"\w+"), F.lit(0)))


def review(candidates: DataFrame, store: DataFrame, verified: DataFrame | None = None) -> DataFrame:
    """Classification of each candidate against the current record, with evidence and confidence. ``verified``: (evidence_id); none: all count as verified."""
    now = current(store).select(F.col("knowledge_id").alias("proposed_knowledge_id"), F.col("revision").alias("now"), F.lower(F.trim("summary")).alias("now_summary"), F.lower(F.trim("content")).alias("now_content"), F.col("evidence_ids").alias("now_evidence"))
    rows = candidates.join(now, "proposed_knowledge_id", "left").withColumn("own", F.lower(F.trim("content")))
    known, op = F.col("now").isNotNull(), F.col("proposed_operation")
    duplicate = (F.col("own") != "") & (F.col("now_content") != "") & F.contains(F.col("now_content"), F.col("own"))
    words = _words(F.col("own"))
    both = F.size(F.array_intersect(words, _words(F.concat_ws(" ", "now_summary", "now_content"))))
    reaffirmed = (F.col("own") != "") & ((F.col("own") == F.col("now_summary")) | (both * 10 > F.size(words) * 8))
    stale = F.col("base_canonical_revision") < F.col("now")
    cls = cases(
        [
            (F.col("proposed_knowledge_id").isNull(), F.when(op == "CREATE", "NEW_KNOWLEDGE").otherwise("INSUFFICIENT_EVIDENCE")),
            (~known, F.when(op.isin("UPDATE", "SUPERSEDE", "RETIRE"), "INSUFFICIENT_EVIDENCE").otherwise("NEW_KNOWLEDGE")),
            (op == "RETIRE", F.lit("RETIREMENT")), (op == "SUPERSEDE", F.lit("SUPERSESSION")), ((op == "UPDATE") & stale, F.lit("CONFLICT")), ((op == "UPDATE") & duplicate, F.lit("DUPLICATE")),
            ((op == "UPDATE") & reaffirmed, F.lit("REAFFIRMATION")), (op == "UPDATE", F.lit("UPDATE")),
        ],
        "INSUFFICIENT_EVIDENCE",
    )
    rows = rows.withColumn("classification", cls)
    if verified is None:
        rows = rows.withColumn("supporting", F.array_sort(F.array_distinct("evidence_ids")))
    else:
        ids = rows.select("candidate_id", F.explode(F.array_distinct("evidence_ids")).alias("evidence_id")).join(verified, "evidence_id", "left_semi").groupBy("candidate_id").agg(F.array_sort(F.collect_set("evidence_id")).alias("supporting"))
        rows = rows.join(ids, "candidate_id", "left").withColumn("supporting", F.coalesce("supporting", F.array().cast("array<string>")))
    n_new = F.size(F.array_except("supporting", F.coalesce("now_evidence", F.array().cast("array<string>"))))
    confidence = cases(
        [
            (F.col("proposed_knowledge_id").isNull(), F.when(F.col("classification") == "NEW_KNOWLEDGE", 60).otherwise(50)), (~known, F.lit(30)), (F.col("classification") == "DUPLICATE", F.lit(95)), (F.col("classification") == "REAFFIRMATION", F.lit(85)),
            (F.col("classification") == "CONFLICT", F.lit(60)), (n_new > 0, F.least(F.lit(90), 50 + 10 * n_new)), (F.size("supporting") > 0, F.lit(70)),
        ],
        40,
    )
    return rows.select("candidate_id", "candidate_revision", "proposed_operation", "proposed_knowledge_id", "classification", confidence.alias("confidence_pct"), F.size("supporting").alias("n_supporting"), n_new.alias("n_new"), F.col("now").alias("current_revision"), "base_canonical_revision")


def publishable(store: DataFrame) -> DataFrame:
    return store.where("canonical_status = 'CURRENT' AND approval_status = 'ACCEPTED' AND projection_policy = 'PUBLISH'")


def projection(store: DataFrame, notes: DataFrame) -> DataFrame:
    """What publishing does to each note (knowledge_id, note_revision, note_hash, managed, tampered): no_op, published or why it is refused."""
    joined = publishable(store).select("knowledge_id", "revision", F.sha2("content", 256).alias("content_hash")).join(notes, "knowledge_id", "left")
    action = cases(
        [(F.col("note_revision").isNull(), F.lit("published")), (~F.col("managed"), F.lit("refused_human_note")), ((F.col("note_hash") == F.col("content_hash")) & (F.col("note_revision") == F.col("revision")), F.lit("no_op")), (F.col("tampered"), F.lit("refused_tampered")), (F.col("revision") <= F.col("note_revision"), F.lit("refused_not_newer"))],
        "published",
    )
    return joined.select("knowledge_id", "revision", action.alias("action"))


AUTHORITY, AUTHORITY_CLASS, TEMPERATURE = "CANONICAL_STORE", "AUTHORITATIVE", "COLD_DEEP"
# Who may approve, and domains whose records only the founder's approval changes.
APPROVERS = ("FOUNDER", "ARCHITECTURE_BOARD", "KNOWLEDGE_CURATOR")
FOUNDERS_DOMAINS = ("constitutional", "master-plan", "governance", "architecture-ownership", "major-strategy", "constitution")


def envelope(found: DataFrame, store_id: str, store_sha256: str, mode: str) -> DataFrame:
    """Records with where they were retrieved from, how, their evidence, and the query's score where there is one."""
    retrieval = F.struct(F.lit(store_id).alias("store_id"), F.lit(store_sha256).alias("store_sha256"), F.lit(AUTHORITY).alias("retrieved_from"), F.lit(None).cast("string").alias("indexed_from"), F.lit(mode).alias("retrieval_mode"))
    rows = found.withColumnRenamed("score", "query_score") if "score" in found.columns else found
    return rows.withColumns({"source_authority": F.lit(AUTHORITY), "authority_class": F.lit(AUTHORITY_CLASS), "source_temperature": F.lit(TEMPERATURE), "provenance": F.struct("evidence_ids"), "retrieval_authority": retrieval})


def proposals(reviewed: DataFrame) -> DataFrame:
    """``review``'s rows with the action that each classification asks for, the revision it leads to, and whether the founder must approve."""
    cls, now = F.col("classification"), F.col("current_revision")
    action = cases(
        [
            (cls.isin("DUPLICATE", "REAFFIRMATION", "INSUFFICIENT_EVIDENCE", "REJECTED"), F.lit("NO_COMMIT")), (cls == "CONFLICT", F.lit("DEFER")), (F.col("n_supporting") == 0, F.lit("EVIDENCE_REQUIRED")),
            (cls == "NEW_KNOWLEDGE", F.lit("CREATE")), (cls == "UPDATE", F.lit("UPDATE")), (cls == "SUPERSESSION", F.lit("SUPERSEDE")), (cls == "RETIREMENT", F.lit("RETIRE")),
        ],
        "NO_COMMIT",
    )
    revision = cases([(F.col("action") == "CREATE", F.lit(1)), (F.col("action").isin("UPDATE", "SUPERSEDE", "RETIRE"), F.coalesce(now, F.lit(0)) + 1)], now)
    domain = F.lower(F.coalesce("proposed_knowledge_id", F.lit(""))).rlike("|".join(FOUNDERS_DOMAINS))
    founder = cases([(cls.isin("DUPLICATE", "REAFFIRMATION", "INSUFFICIENT_EVIDENCE", "REJECTED"), F.lit(False)), (cls.isin("RETIREMENT", "CONFLICT", "SUPERSESSION"), F.lit(True))], domain)
    return reviewed.withColumn("action", action).withColumn("proposed_revision", revision).withColumn("founder_approval_required", founder)


def conflict_packets(reviewed: DataFrame) -> DataFrame:
    """What a conflict's resolution needs: the candidate, the record, and both revisions."""
    return reviewed.where("classification = 'CONFLICT'").select("candidate_id", "candidate_revision", "proposed_knowledge_id", "base_canonical_revision", "current_revision", F.lit("OPEN").alias("conflict_status"))


REVIEWABLE = ("SUBMITTED", "REVIEW_READY", "CONFLICT_OPEN")


def reviewable(queue: DataFrame, reviewer: str) -> DataFrame:
    """(candidate_id, refusal): why a candidate (status, submitter, content, content_hash) can't be reviewed by ``reviewer``; null if it can."""
    refusal = cases(
        [
            (~F.coalesce(F.col("status"), F.lit("")).isin(*REVIEWABLE), F.lit("status is not reviewable")), (F.col("submitter").isNull() | F.col("content").isNull() | F.col("content_hash").isNull(), F.lit("incomplete")),
            (F.col("submitter") == reviewer, F.lit("submitter reviews their own")), (F.sha2("content", 256) != F.col("content_hash"), F.lit("content hash mismatch")),
        ],
        F.lit(None).cast("string"),
    )
    return queue.select("candidate_id", refusal.alias("refusal"))


def approvals(reviews: DataFrame, artifacts: DataFrame, verified: DataFrame | None = None) -> DataFrame:
    """(review_id, refusal, packet...) of each approval of ``reviews``: why it is refused, or null with the change packet, which nothing here executes.

    ``reviews``: review_id, candidate_id, proposed_knowledge_id, proposed_revision, classification,
    action, reviewer_identity, founder_approval_required. ``artifacts``: approval_id, review_id,
    approver_identity, authority, decision, issued_at. ``verified``: (approval_id) that the
    caller's verifier has accepted; none: nothing counts as verified.
    """
    fields = ("approval_id", "approver_identity", "authority", "decision", "issued_at")
    known = (artifacts.limit(0).select("approval_id") if verified is None else verified.select("approval_id")).distinct().withColumn("_verified", F.lit(True))
    rows = reviews.join(artifacts, "review_id", "left").join(known, "approval_id", "left")
    blank = F.lit(False)
    for c in fields:
        blank = blank | F.col(c).isNull() | (F.trim(c) == "")
    refusal = cases(
        [
            (blank, F.lit("incomplete")), (F.col("decision") != "APPROVE", F.lit("not an approval")), (~F.col("authority").isin(*APPROVERS), F.lit("unknown authority")), (F.col("approver_identity") == F.col("reviewer_identity"), F.lit("reviewer approves their own review")),
            (F.col("founder_approval_required") & (F.col("authority") != "FOUNDER"), F.lit("founder required")), (F.col("_verified").isNull(), F.lit("not verified")), (F.col("action").isin("NO_COMMIT", "DEFER", "EVIDENCE_REQUIRED"), F.lit("nothing to commit")),
        ],
        F.lit(None).cast("string"),
    )
    packet = F.concat(F.lit("CCP-"), F.upper(F.substring(F.sha2(F.concat_ws("\x1f", "review_id", "approval_id"), 256), 1, 16)))
    out = rows.withColumn("refusal", refusal)
    fine = F.col("refusal").isNull()
    return out.select(
        "review_id", "approval_id", "refusal", F.when(fine, packet).alias("change_packet_id"), "candidate_id", F.when(fine, F.col("proposed_knowledge_id")).alias("knowledge_id"), F.when(fine, F.col("proposed_revision")).alias("proposed_revision"), "classification",
        F.when(fine, "NOT_EXECUTED").alias("execution_status"),
    )


def bulk_result(outcomes: DataFrame, operation: str) -> DataFrame:
    """One row over (identifier, error; null: it went well): status success, partial or failed, and the counts."""
    one = outcomes.agg(F.count_if(F.col("error").isNull()).alias("success_count"), F.count_if(F.col("error").isNotNull()).alias("failure_count"))
    status = cases([(F.col("failure_count") == 0, F.lit("success")), (F.col("success_count") == 0, F.lit("failed"))], "partial")
    return one.select(F.lit(operation).alias("operation"), status.alias("status"), "success_count", "failure_count")


def rendered(store: DataFrame) -> DataFrame:
    """(name, text) of the managed note of each publishable record."""
    body = F.concat_ws("\n", F.concat(F.lit("# "), "title"), F.lit(""), F.coalesce("summary", F.lit("")), F.lit(""), F.col("content"), F.lit(""))
    fields = {
        "managed_projection": F.lit("true"), "knowledge_id": yaml_value(F.col("knowledge_id")), "canonical_revision": F.col("revision").cast("string"), "canonical_status": F.lower("canonical_status"), "approval_status": F.lower("approval_status"),
        "projection_policy": F.lower("projection_policy"), "source_authority": F.lit(AUTHORITY), "canonical_hash": F.sha2(F.concat_ws("\x1f", "knowledge_id", F.col("revision").cast("string"), "title", "summary", "content"), 256), "projected_body_sha256": F.sha2(body, 256),
    }
    lines = [F.concat(F.lit(f"{k}: "), v) for k, v in fields.items()]
    return publishable(store).select(F.concat("knowledge_id", F.lit(".md")).alias("name"), F.concat_ws("\n", F.lit("---"), *lines, F.lit("---"), F.lit(""), body).alias("text"))
