"""Command line: ``python -m threadloom.cli VERB ...`` writes tables as Parquet, or prints rows as JSON."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.config import Config, ConfinementError, confined
from threadloom.engine import ConversationEngine
from threadloom.operators import store as S
from threadloom.operators.store import NotFound
from threadloom.sources import sinks
from threadloom.sources.commits import CommitError, CommitLog
from threadloom.sources.exports import SourceError

TABLES = ("thoughts", "entities", "relationships", "timelines", "canonical")
QUEUE = "candidate_id string, candidate_revision int, source_path string, source_hash string, proposed_operation string, proposed_knowledge_id string, base_canonical_revision int, content string, evidence_ids array<string>, status string"
SHOWN = 1_000  # rows that are printed; what follows is counted


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="threadloom")
    verbs = top.add_subparsers(dest="verb", required=True)
    ingest = verbs.add_parser("ingest", help="messages of chat exports")
    ingest.add_argument("source"), ingest.add_argument("target")
    for name in (*TABLES, "all"):
        extract = verbs.add_parser(f"extract-{name}", help="records of messages")
        extract.add_argument("messages"), extract.add_argument("target")
    get = verbs.add_parser("get", help="a record")
    get.add_argument("store"), get.add_argument("knowledge_id"), get.add_argument("--revision", type=int)
    search = verbs.add_parser("search", help="ranked records")
    search.add_argument("store"), search.add_argument("query"), search.add_argument("--history", action="store_true"), search.add_argument("--limit", type=int, default=10)
    doctor = verbs.add_parser("doctor", help="breaches of the store's contract")
    doctor.add_argument("store")
    diagnose = verbs.add_parser("diagnose", help="whether an engine's folders are ready; the environment may move them")
    diagnose.add_argument("root")
    propose = verbs.add_parser("propose", help="a candidate note of each extracted record")
    propose.add_argument("store"), propose.add_argument("folder")
    publish = verbs.add_parser("publish", help="one record's managed note")
    publish.add_argument("store"), publish.add_argument("folder"), publish.add_argument("knowledge_id")
    every = verbs.add_parser("publish-all", help="managed notes of all publishable records")
    every.add_argument("store"), every.add_argument("folder")
    intake = verbs.add_parser("intake", help="one candidate note into the queue")
    intake.add_argument("store"), intake.add_argument("folder"), intake.add_argument("queue"), intake.add_argument("note")
    for name in ("intake-all", "review-all"):
        verb = verbs.add_parser(name, help="all candidate notes into the queue" if name == "intake-all" else "verdicts on all candidates")
        verb.add_argument("store"), verb.add_argument("folder") if name == "intake-all" else None, verb.add_argument("queue")
    review = verbs.add_parser("review", help="a verdict on one candidate")
    review.add_argument("store"), review.add_argument("queue"), review.add_argument("candidate_id")
    return top


def show(rows: DataFrame) -> int:
    """Prints rows as JSON, and how many more there are than are shown; gives their number."""
    lines, n = rows.toJSON().take(SHOWN), rows.count()
    print(*lines, sep="\n")
    if n > len(lines):
        print(json.dumps({"not_shown": n - len(lines)}))
    return n


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    engine = ConversationEngine(spark)
    try:
        if args.verb == "ingest":
            twice = lambda df: df.groupBy("canonical_id").count().where("count > 1")
            sinks.staged_write(engine.ingest(args.source), args.target, twice)
        elif args.verb.startswith("extract-"):
            rows, name = spark.read.parquet(args.messages), args.verb.removeprefix("extract-")
            for table in TABLES if name == "all" else (name,):
                made, target = getattr(engine, table)(rows), f"{args.target}/{table}" if name == "all" else args.target
                sinks.replace_own(made, target, "threadloom.extraction") if table == "canonical" else sinks.staged_write(made, target)
        elif args.verb == "diagnose":
            found = engine.diagnose(Config.load(args.root))
            show(found)
            return int(not found.where("status = 'fail'").isEmpty())
        else:
            return on_store(engine, spark.read.parquet(args.store), args)
    except (SourceError, sinks.SinkError, CommitError, NotFound, ConfinementError, ValueError) as error:
        print(error, file=sys.stderr)
        return 1
    return 0


def on_store(engine: ConversationEngine, records: DataFrame, args: argparse.Namespace) -> int:
    if args.verb == "get":
        show(engine.get(records, args.knowledge_id, args.revision))
    elif args.verb == "search":
        show(engine.search(records, args.query, args.history, args.limit))
    elif args.verb == "doctor":
        return int(show(engine.doctor(records)) > 0)
    elif args.verb == "propose":
        print(json.dumps({"operation": args.verb, "written": engine.candidate_notes(records, args.folder)}))
    elif args.verb in ("publish", "publish-all"):
        if args.verb == "publish":
            found = engine.get(records, args.knowledge_id)
            if S.publishable(found).isEmpty():
                raise ValueError(f"{args.knowledge_id} is not publishable")
            records = found
        print(json.dumps({"operation": args.verb, "written": engine.publish_notes(records, args.folder)}))
    elif args.verb in ("intake", "intake-all"):
        notes = engine.candidates(args.folder)
        if args.verb == "intake":
            path = confined(args.note, args.folder)
            notes = notes.where(F.col("source_path").endswith(path.partition("://")[2] or path))
            if notes.isEmpty():
                raise SourceError(f"no note {args.note} in {args.folder}")
        queue = CommitLog(engine.spark, args.queue, QUEUE)
        # Revisions count on from what is committed; a lost race works them out again.
        version = queue.append(lambda known: engine.intake(notes, known, records))
        print(json.dumps({"operation": args.verb, "taken_in": queue.read_version(version).count()}))
    else:
        queue = CommitLog(engine.spark, args.queue, QUEUE).read()
        if args.verb == "review":
            queue = queue.where(F.col("candidate_id") == args.candidate_id)
            if queue.isEmpty():
                raise NotFound(args.candidate_id)
        show(engine.review(queue, records))
    return 0


if __name__ == "__main__":
    sys.exit(main())
