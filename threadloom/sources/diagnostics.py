"""What an engine needs to run, looked at without changing anything."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from threadloom.config import Config
from threadloom.operators import store
from threadloom.sources.commits import CommitLog
from threadloom.sources.sinks import _fs

# Columns of a governed record.
RECORD = ["knowledge_id", "revision", "canonical_status", "title", "summary", "content", "evidence_ids"]


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where)


def store_check(spark: SparkSession, path: str) -> tuple[str, str]:
    if not exists(spark, path):
        return "fail", "no store"
    try:
        records = spark.read.parquet(path)
    except AnalysisException as error:
        return "fail", f"not a table: {error.getCondition()}"
    missing = [c for c in RECORD if c not in records.columns]
    if missing:
        return "fail", f"columns missing: {', '.join(missing)}"
    broken = sorted(r[0] for r in store.violations(records).select("rule").distinct().collect())
    return ("fail", f"breaches: {', '.join(broken)}") if broken else ("ok", f"{records.select('knowledge_id').distinct().count()} ids")


def queue_check(spark: SparkSession, path: str) -> tuple[str, str]:
    if not exists(spark, path):
        return "ok", "nothing taken in yet"
    log = CommitLog(spark, path, "candidate_id string")
    commits, last, lost = log.commits(), log.version(), log.orphans()
    missing = [c["folder"] for c in commits if not exists(spark, f"{path}/data/{c['folder']}")]
    if missing:
        return "fail", f"{len(missing)} commits have no rows"
    if len(commits) < last:
        return "warn", f"{last - len(commits)} of {last} versions are torn and count for nothing"
    return ("warn", f"{len(lost)} folders that no commit names") if lost else ("ok", f"{last} versions")


def report(spark: SparkSession, config: Config) -> DataFrame:
    """(check, status, detail), a row a check."""
    rows = [("store", *store_check(spark, config.store)), ("queue", *queue_check(spark, config.queue))]
    rows.append(("reviews", "ok", "there") if exists(spark, config.reviews) else ("reviews", "ok", "none yet"))
    if config.notes is None:
        rows.append(("notes", "fail", "no folder of notes is set"))
    else:
        rows.append(("notes", "ok", "there") if exists(spark, config.notes) else ("notes", "fail", "no such folder"))
    return spark.createDataFrame(rows, "check string, status string, detail string")
