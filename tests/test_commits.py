"""Appends of several writers, merges of streams, releases."""

from __future__ import annotations

import hashlib
import json
import threading

import pytest
from pyspark.sql import functions as F

from threadloom.sources import exports, releases, sinks
from threadloom.sources.commits import CommitError, CommitLog
from threadloom.streaming import incremental

ROWS = "candidate string, revision int"


def next_revision(spark, key):
    def make(known):
        last = known.where(F.col("candidate") == key).agg(F.coalesce(F.max("revision"), F.lit(0)).alias("n"))
        return last.select(F.lit(key).alias("candidate"), (F.col("n") + 1).cast("int").alias("revision"))

    return make


def test_two_writers_get_successive_revisions(spark, tmp_path):
    errors = []

    def work():
        try:
            log = CommitLog(spark, f"file://{tmp_path}/t", ROWS)
            for _ in range(3):
                log.append(next_revision(spark, "a"))
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=work) for _ in range(3)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    log = CommitLog(spark, f"file://{tmp_path}/t", ROWS)
    assert not errors and sorted(r.revision for r in log.read().collect()) == [*range(1, 10)]
    assert [c["version"] for c in log.commits()] == [*range(1, 10)] and log.orphans() == []
    assert sorted(r.revision for r in log.read(4).collect()) == [1, 2, 3, 4]


def test_a_lost_race_is_worked_out_again(spark, tmp_path):
    log, other = (CommitLog(spark, str(tmp_path / "t"), ROWS) for _ in range(2))
    asked = []

    def make(known):
        asked.append(known.count())
        if len(asked) == 1:
            other.append(next_revision(spark, "a"))
        return next_revision(spark, "a")(known)

    assert log.append(make, wait=lambda _: None) == 2 and asked == [0, 1]
    assert sorted(r.revision for r in log.read().collect()) == [1, 2] and log.orphans() == []
    with pytest.raises(CommitError):
        log.append(lambda known: (other.append(next_revision(spark, "b")), known.limit(0))[1], attempts=2, wait=lambda _: None)
    assert log.orphans() == []


def test_torn_writes_are_invisible(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "t"), ROWS)
    log.append(next_revision(spark, "a"))
    # A writer that died with its rows written, and one whose entry of the log is half there.
    spark.createDataFrame([("x", 9)], ROWS).write.parquet(str(tmp_path / "t/data/lost"))
    (tmp_path / f"t/_log/{2:020d}.json").write_text('{"folder": "lo')
    assert [tuple(r) for r in log.read().collect()] == [("a", 1)] and log.orphans() == ["lost"]
    assert log.append(next_revision(spark, "a")) == 3
    assert sorted(tuple(r) for r in log.read().collect()) == [("a", 1), ("a", 2)]


def test_nothing_committed_yet(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "t"), ROWS)
    assert log.version() == 0 and log.commits() == [] and log.read().collect() == [] and log.orphans() == []


SCHEMA = "source_record_id string, v string"


def feed(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps({"source_record_id": k, "v": v}) for k, v in rows))


def merged(spark, target):
    return sorted(tuple(r) for r in incremental.read_target(spark, target, SCHEMA).collect())


def test_stream_keeps_the_first_in_scan_order(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    go = lambda: incremental.ingest_stream(spark, str(source), SCHEMA, target, str(tmp_path / "cp"), buckets=8).awaitTermination()
    feed(source, "b.json", [("x", "b1"), ("y", "b2"), ("x", "b3"), (None, "no key")])
    feed(source, "a.json", [("y", "a1"), ("y", "a2"), ("z", None)])
    go()
    assert merged(spark, target) == [("x", "b1"), ("y", "a1"), ("z", None)]
    # Late: a file that sorts before, with a key that is merged already.
    feed(source, "0.json", [("x", "late"), ("w", "new")])
    go()
    go()
    assert merged(spark, target) == [("w", "new"), ("x", "b1"), ("y", "a1"), ("z", None)]


def batch(spark, rows):
    return spark.createDataFrame(rows, "source_record_id string, v string, _order int")


def test_replayed_and_concurrent_batches(spark, tmp_path):
    log = incremental.table(spark, str(tmp_path / "out"), SCHEMA)
    one, two = (incremental.merge_batch(log, "source_record_id", 4, writer) for writer in ("one", "two"))
    one(batch(spark, [("a", "1", 2), ("a", "0", 1), ("b", "1", 3)]), 0)
    one(batch(spark, [("c", "other rows under a number that is done", 1)]), 0)
    two(batch(spark, [("b", "2", 1), ("d", "2", 2)]), 0)
    one(batch(spark, []), 1)
    one(batch(spark, [("d", "3", 1), ("e", "3", 2)]), 2)
    assert merged(spark, str(tmp_path / "out")) == [("a", "0"), ("b", "1"), ("d", "2"), ("e", "3")]
    assert [(c["writer"], c["batch"]) for c in log.commits()] == [("one", 0), ("two", 0), ("one", 1), ("one", 2)]


def test_a_batch_reads_its_buckets_alone(spark, tmp_path):
    log = incremental.table(spark, str(tmp_path / "out"), SCHEMA)
    run = incremental.merge_batch(log, "source_record_id", 16)
    run(batch(spark, [(f"k{i}", "v", i) for i in range(200)]), 0)
    known = log.read().where(F.col("_bucket").isin([3])).select("_bucket", "source_record_id")
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_bucket" in plan and "ReadSchema: struct<source_record_id:string>" in plan
    assert {r[0] for r in known.select(F.input_file_name()).collect() if "_bucket=3" not in r[0]} == set() and known.count() > 0


DATA = [(i, "s" if i % 3 else None, f"text é {i}") for i in range(2500)]


@pytest.fixture
def frozen(spark, tmp_path):
    rows = spark.createDataFrame(DATA, "id int, source string, text string").repartition(3)
    assert releases.freeze_release(rows, str(tmp_path), "id") == "RELEASE_001"
    return rows, str(tmp_path)


def plain_json(row):
    return json.dumps(row, sort_keys=True, separators=(",", ":"))


def test_canonical_json_equals_a_writer_of_sorted_escaped_json(spark):
    values = ["plain", "é ü", "日本", "𝒳 and 😀", 'quote " and \\ and \\u000B', "\x0b\x1f\n\t\x7f", "a/b", "", None]
    rows = [(i, v, {"z": i, "é": None}, [v, "x"], (2, v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "n int, b string, m map<string,int>, a array<string>, s struct<y:int,x:string>")
    got = {r.n: r.j for r in df.select("n", releases.canonical_json(df).alias("j")).collect()}
    for n, b, m, a, s in rows:
        assert got[n] == plain_json({"n": n, "b": b, "m": m, "a": a, "s": {"y": s[0], "x": s[1]}})


def test_release_is_frozen_and_read_only(spark, frozen, tmp_path):
    rows, path = frozen
    releases.verify_release(spark, path, "RELEASE_001")
    entry = releases.listed(spark, path, "RELEASE_001")
    hashes = [hashlib.sha256(plain_json({"id": i, "source": s, "text": t}).encode()).hexdigest() for i, s, t in DATA]
    chunks = [hashlib.sha256("".join(hashes[i : i + 1024]).encode()).hexdigest() for i in range(0, 2500, 1024)]
    assert entry["root"] == hashlib.sha256("".join(chunks).encode()).hexdigest() and entry["n"] == 2500 and entry["parent"] is None
    assert {(r.source, r.n) for r in spark.read.parquet(f"{path}/sources/RELEASE_001").collect()} == {("s", 1666), (None, 834)}
    assert all(p.stat().st_mode & 0o222 == 0 for p in (tmp_path / "data/RELEASE_001").iterdir() if p.name.startswith("part"))
    assert exports.latest_release(spark, path).count() == 2500
    for bad in (rows.unionByName(rows.limit(1)), rows.unionByName(spark.createDataFrame([(None, "s", "x")], rows.schema))):
        with pytest.raises(sinks.SinkError):
            releases.freeze_release(bad, path, "id")
    with pytest.raises(sinks.SinkError):
        releases.verify_release(spark, path, "RELEASE_009")


def test_a_changed_row_shows_in_its_chunk(spark, frozen, tmp_path):
    rows, path = frozen
    changed = rows.withColumn("text", F.when(F.col("id") == 1500, "other").otherwise(F.col("text")))
    changed.write.mode("overwrite").parquet(f"{path}/data/RELEASE_001")
    assert [(r.idx, r.first_key, r.last_key) for r in releases.tampered_chunks(spark, path, "RELEASE_001").collect()] == [(1, 1024, 2047)]
    with pytest.raises(sinks.SinkError):
        releases.freeze_release(rows, path, "id", "RELEASE_001")


def test_a_child_adds_one_column_and_keeps_its_parents_rows(spark, frozen):
    rows, path = frozen
    extra = rows.select("id", F.concat(F.lit("c-"), F.col("id").cast("string")).alias("canonical"))
    assert releases.child_release(spark, path, "RELEASE_001", extra) == "RELEASE_002"
    parent, child = (releases.listed(spark, path, r) for r in ("RELEASE_001", "RELEASE_002"))
    assert child["parent"] == "RELEASE_001" and child["parent_root"] == parent["root"] != child["root"]
    assert exports.latest_release(spark, path).columns == ["id", "source", "text", "canonical"]
    for bad in (extra.where("id > 0"), extra.unionByName(extra.limit(1)), extra.withColumnRenamed("canonical", "Text"), extra.withColumn("more", F.lit(1))):
        with pytest.raises(sinks.SinkError):
            releases.child_release(spark, path, "RELEASE_001", bad)
    with pytest.raises(sinks.SinkError):
        spark.read.parquet(f"{path}/chunks/RELEASE_001").limit(1).write.mode("overwrite").parquet(f"{path}/chunks/RELEASE_001x")
        releases.verify_release(spark, path, "RELEASE_001x")


def test_an_empty_release(spark, tmp_path):
    rows = spark.createDataFrame([], "id int, text string")
    assert releases.freeze_release(rows, str(tmp_path), "id") == "RELEASE_001"
    releases.verify_release(spark, str(tmp_path), "RELEASE_001")
    assert releases.listed(spark, str(tmp_path), "RELEASE_001")["root"] is None


def test_chunks_hash_each_row_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def looked_at(i):
        seen.add(1)
        return f"v{i}"

    made = releases.chunks_of(spark.range(200).select(F.col("id").alias("k"), looked_at("id").alias("v")), "k", 64)
    assert sorted((r.idx, r.first_key, r.last_key, r.n) for r in made.collect()) == [(0, 0, 63, 64), (1, 64, 127, 64), (2, 128, 191, 64), (3, 192, 199, 8)] and seen.value == 200
