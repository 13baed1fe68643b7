"""Readers, sinks, streaming and the command line on small files."""

from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from threadloom import ConversationEngine, cli
from threadloom.config import Config, ConfinementError, confined
from threadloom.operators import messages
from threadloom.sources import exports, sinks
from threadloom.streaming import incremental


def node(i, parent, text=None, kind="text", role="user", at=0.0):
    content = {"content_type": kind, "parts": [text, {"image": 1}]} if kind == "text" else {"content_type": kind, "content": text} if kind == "reasoning_recap" else {"content_type": kind, "thoughts": [{"content": text}, {"content": "more"}]}
    return {"id": i, "parent": parent, "message": None if text is None else {"id": f"m-{i}", "author": {"role": role}, "create_time": at, "content": content}}


@pytest.fixture
def chats(tmp_path):
    mapping = {"r": node("r", None), "a": node("a", "r", "Hello. There", at=1.5), "b": node("b", "a", "Entity: Loom (product)", role="assistant"), "c": node("c", "a", "aside"), "d": node("d", "b", "recap", "reasoning_recap"), "e": node("e", "d", "deep", "thoughts")}
    chat = [{"id": "k1", "conversation_id": "k1", "title": "T", "current_node": "e", "mapping": mapping}, {"id": "k2", "title": None, "current_node": "gone", "mapping": {"x": node("x", None, "lost")}}]
    (tmp_path / "conversations-001.json").write_text(json.dumps(chat))
    (tmp_path / "conversations-9.json").write_text("[]")
    return tmp_path


def test_chat_export(spark, chats):
    rows = {r.node_id: r for r in exports.chat_messages(exports.chat_export(spark, str(chats))).collect()}
    assert set(rows) == {"a", "b", "c", "d", "e", "x"}
    assert (rows["a"].sequence_index, rows["e"].sequence_index, rows["c"].branch, rows["x"].branch) == (1, 4, "alternate", "alternate")
    assert rows["a"].text == "Hello. There" and rows["d"].text == "recap" and rows["e"].text == "deep\n\nmore"
    assert rows["a"].timestamp == "1970-01-01T00:00:01.500000+00:00" and rows["a"].child_message_ids == ["b", "c"]
    assert len({r.source_record_id for r in rows.values()}) == 6 and rows["a"].source_record_id.startswith("srcmsg_")


def test_missing_and_malformed_exports(spark, tmp_path):
    (tmp_path / "x.json").write_text("[]")
    with pytest.raises(Exception):
        exports.chat_export(spark, str(tmp_path))
    (tmp_path / "conversations-002.json").write_text("{bad")
    with pytest.raises(Exception):
        exports.chat_messages(exports.chat_export(spark, str(tmp_path))).collect()


def test_fragments_and_csv(spark, tmp_path):
    chat = [{"id": "f", "title": "t", "inserted_at": "z", "mapping": {"1": {"id": "1", "parent": "root", "children": [], "message": {"model": "m", "inserted_at": "2024", "fragments": [{"type": "REQUEST", "content": "q"}, {"type": "RESPONSE", "content": "a"}, {"type": "X", "content": None}]}}}}]
    (tmp_path / "f.json").write_text(json.dumps(chat))
    assert [(r.fragment_index, r.role, r.text) for r in exports.fragment_messages(spark, str(tmp_path / "f.json")).orderBy("fragment_index").collect()] == [(0, "user", "q"), (1, "assistant", "a"), (2, "unknown", "")]
    (tmp_path / "c.csv").write_text('﻿Conversation,Time,Author,Message\nA,2024-01-02,AI,"two\nlines"\nA,2024-01-01,Human,first\nA,2024-01-02,Human,same time\n', encoding="utf-8")
    rows = exports.csv_messages(spark, str(tmp_path / "c.csv"))
    placed = {r.csv_row_number: (r.sequence_index, r.reordered) for r in messages.chronology(rows.withColumnRenamed("timestamp", "ts"), "csv_row_number").collect()}
    assert placed == {0: (2, 1), 1: (0, 1), 2: (1, 1)} and rows.where("csv_row_number = 0").first().text == "two\nlines"


def test_json_lines_modes(spark, tmp_path):
    p = tmp_path / "l.jsonl"
    p.write_text('{"a": 1}\n\n{bad\n{"a": 2}\n')
    assert [r.a for r in exports.json_lines(spark, str(p), "a int", "lenient").collect()] == [1, 2]
    with pytest.raises(Exception):
        exports.json_lines(spark, str(p), "a int").collect()
    assert exports.json_lines(spark, str(tmp_path / "none"), "a int", "tolerant").collect() == []


def test_notes_and_blocks(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "n.md").write_text('---\nkind: "x"\nrevision: -3\n---\nBody\n')
    (tmp_path / "plain.md").write_text("no front matter")
    got = {r.body: r.fields for r in exports.notes(spark, str(tmp_path)).collect()}
    assert got["Body\n"] == {"kind": "x", "revision": "-3"} and got["no front matter"] == {}
    (tmp_path / "w.jsonl").write_text(json.dumps({"page_id": "p", "blocks": [{"depth": 0, "type": "heading_1", "text": "H"}, {"depth": 1, "type": "code", "text": "c"}, {"depth": 9, "type": "quote", "text": "deep"}]}))
    assert exports.wiki_pages(spark, str(tmp_path / "w.jsonl")).first().markdown == "# H\n```\nc\n```"


def test_staged_write_keeps_what_was_there(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.staged_write(spark.range(3), path)
    with pytest.raises(sinks.SinkError):
        sinks.staged_write(spark.range(9), path, lambda df: df.where("id > 5"))
    assert spark.read.parquet(path).count() == 3 and [p.name for p in tmp_path.iterdir()] == ["t"]


def test_deterministic_json_lines_and_numbers(spark, tmp_path):
    rows = spark.createDataFrame([(2, None), (1, "é")], "b int, a string")
    for name in ("x", "y"):
        sinks.json_lines(rows.repartition(2), str(tmp_path / name), ["b"])
    read = lambda n: "".join(p.read_text() for p in sorted((tmp_path / n).glob("part-*")))
    assert read("x") == read("y") == '{"a":"é","b":1}\n{"a":null,"b":2}\n'
    assert [r.number for r in sinks.with_numbers(spark.range(5), "rh_", ["id"]).orderBy("id").collect()] == [f"rh_{i:06d}" for i in range(1, 6)]


def test_stream_replay_changes_nothing(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    target = str(tmp_path / "out")
    for i, ids in enumerate((["a", "b", "a"], ["b", "c"])):
        (source / f"{i}.json").write_text("\n".join(json.dumps({"source_record_id": x, "v": i}) for x in ids))
        incremental.ingest_stream(spark, str(source), "source_record_id string, v int", target, str(tmp_path / "cp")).awaitTermination()
    assert sorted((r[0], r[1]) for r in incremental.read_target(spark, target, "source_record_id string, v int").collect()) == [("a", 0), ("b", 0), ("c", 1)]


def test_end_to_end_by_command_line(spark, chats, tmp_path, capsys):
    out = tmp_path / "made"
    assert cli.main(["ingest", str(chats), str(out / "m")]) == 0
    assert cli.main(["extract-all", str(out / "m"), str(out / "x")]) == 0
    assert cli.main(["doctor", str(out / "x" / "canonical")]) == 0
    assert cli.main(["search", str(out / "x" / "canonical"), "loom"]) == 0 and "Loom" in capsys.readouterr().out
    assert cli.main(["get", str(out / "x" / "canonical"), "K"]) == 1
    assert ConversationEngine(spark).entities(spark.read.parquet(str(out / "m"))).count() == 1


def test_parts_that_look_like_objects_stay_text(spark, tmp_path):
    parts = ['{"k": 1} is my config', {"asset": "x"}, "tail", "", None, '"quoted"', 5]
    node = {"id": "n", "parent": None, "message": {"id": "m", "author": {"role": "user"}, "create_time": 1.0, "content": {"content_type": "text", "parts": parts}}}
    other = {"id": "o", "parent": "n", "message": {"id": "p", "author": {"role": "assistant"}, "create_time": 2.0, "content": {"content_type": "code"}}}
    (tmp_path / "conversations-000.json").write_text(json.dumps([{"id": "c", "title": "t", "current_node": "o", "mapping": {"n": node, "o": other}}]))
    got = {r.message_id: r.text for r in exports.chat_messages(exports.chat_export(spark, str(tmp_path))).collect()}
    assert got == {"m": '{"k": 1} is my config\ntail\n\n"quoted"', "p": ""}


def test_front_matter_with_a_key_written_twice(spark):
    text = "---\na: 1\nb: \"x\"\na: 2\n---\nbody"
    got = spark.createDataFrame([(text,), ("no fields",)], "t string").select(exports.front_matter(F.col("t")).alias("f")).collect()
    assert got[0].f == {"a": "2", "b": "x"} and got[1].f == {}


def test_block_trees(spark):
    rows = [("p", "a", None, 0, "heading_1", "Top"), ("p", "b", "a", 1, "quote", "second"), ("p", "c", "a", 0, "paragraph", "first"), ("p", "d", "b", 0, "code", "x"), ("p", "e", "d", 0, "paragraph", "deep"), ("p", "f", None, 1, "child_page", "Sub"), ("p", "g", "f", 0, "paragraph", "inside")]
    blocks = spark.createDataFrame(rows, "page_id string, id string, parent_id string, ord int, type string, text string")
    assert exports.tree_markdown(exports.block_tree(blocks, 3)).first().markdown == "# Top\n  first\n  > second\n    ```\nx\n```\nSub"
    assert {r.id for r in exports.block_tree(blocks, 4, child_pages=True).collect()} == set("abcdefg")
    assert [r[0] for r in spark.createDataFrame([("checkbox", "true"), ("phone_number", "call +1 (555) 123-4567"), ("multi_select", "a;b"), ("title", "t")], "k string, v string").select(exports.property_text(F.col("k"), F.col("v"))).collect()] == ["yes", "call [REDACTED]", "a, b", "t"]


def test_a_write_that_fails_leaves_what_was_there(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.staged_write(spark.range(3), path)
    with pytest.raises(sinks.SinkError):
        sinks.staged_write(spark.range(5), path, lambda df: df.where("id = 4"))
    assert spark.read.parquet(path).count() == 3
    sinks.staged_write(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5 and sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["t"]


RECORD = [("MBK-1", 1, "CURRENT", "One: a", "first", "content one", ["e1"], "ACCEPTED", "PUBLISH"), ("MBK-2", 1, "CURRENT", "Two", None, "content two", ["e2", "e3"], "ACCEPTED", "HOLD")]
STORE = "knowledge_id string, revision int, canonical_status string, title string, summary string, content string, evidence_ids array<string>, approval_status string, projection_policy string"


def test_notes_are_written_and_human_ones_are_not_overwritten(spark, tmp_path):
    records, folder = spark.createDataFrame(RECORD, STORE), tmp_path / "notes"
    made = sinks.candidate_notes(records)
    assert sinks.write_notes(made, str(folder)) == 2 and sinks.write_notes(made, str(folder)) == 0
    text = (folder / "MBK-2.md").read_text()
    assert text.startswith("---\nextraction_generated: true\n") and "provenance_refs: \"e2, e3\"" in text and text.endswith("## Provenance\n\n- e2\n- e3\n")
    (folder / "MBK-1.md").write_text("my own note")
    with pytest.raises(sinks.SinkError):
        sinks.write_notes(made.withColumn("text", F.concat("text", F.lit("x"))), str(folder))
    assert (folder / "MBK-1.md").read_text() == "my own note" and (folder / "MBK-2.md").read_text() == text
    with pytest.raises(sinks.SinkError):
        sinks.write_notes(made.withColumn("name", F.lit("../x.md")), str(folder))


def test_command_line_from_notes_to_reviews_and_projection(spark, tmp_path, capsys):
    store, queue, notes, out = (str(tmp_path / x) for x in ("store", "queue", "candidates", "published"))
    records = spark.createDataFrame(RECORD, STORE)
    records.write.parquet(store)
    sinks.write_notes(sinks.candidate_notes(records), notes)
    assert cli.main(["intake", store, notes, queue, "MBK-1.md"]) == 0 and cli.main(["intake-all", store, notes, queue]) == 0 and cli.main(["intake-all", store, notes, queue]) == 0
    said = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    assert [x["taken_in"] for x in said] == [1, 1, 0]
    assert cli.main(["intake", store, notes, queue, "../else.md"]) == 1
    assert cli.main(["review-all", store, queue]) == 0
    rows = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    assert len(rows) == 2 and all(r["classification"] == "INSUFFICIENT_EVIDENCE" or r["action"] for r in rows)
    assert cli.main(["review", store, queue, rows[0]["candidate_id"]]) == 0 and cli.main(["review", store, queue, "none"]) == 1
    capsys.readouterr()
    assert cli.main(["publish-all", store, out]) == 0 and cli.main(["publish", store, out, "MBK-1"]) == 0 and cli.main(["publish", store, out, "MBK-2"]) == 1
    assert [json.loads(x)["written"] for x in capsys.readouterr().out.splitlines()] == [1, 0]
    assert '"' not in Path(out, "MBK-1.md").read_text().split("---")[1]


def test_configuration_and_confinement():
    c = Config.load("/data/", {"THREADLOOM_QUEUE": "s3a://b/q"})
    assert c.store == "/data/store" and c.queue == "s3a://b/q" and c.notes is None and c.shown()["THREADLOOM_QUEUE"] == "s3a://b/q"
    assert confined("a/./b.md", "/root/x") == "/root/x/a/b.md" and confined("s3a://b/q/../n/a.md", "s3a://b/n") == "s3a://b/n/a.md"
    for path in ("../y", "/root/xy/a", "a/../..", "", "hdfs:///root/x/a"):
        with pytest.raises(ConfinementError):
            confined(path, "/root/x")


def test_front_matter_values_have_types(spark):
    values = ["true", "FALSE", "7", "-12", "007", "--5", "1.5", "", "text", '"', "12345678901234567890", "it's"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    kind = lambda negative: [tuple(r) for r in df.select(F.schema_of_variant(exports.typed_value(F.col("v"), negative)), exports.typed_value(F.col("v"), negative).try_cast("string")).collect()]
    want = [("BOOLEAN", "true"), ("BOOLEAN", "false"), ("BIGINT", "7"), ("BIGINT", "-12"), ("BIGINT", "7"), *(("STRING", v) for v in values[5:])]
    assert kind(True) == want and kind(False)[3] == ("STRING", "-12")
    text = "---\na: 'x'\nb: \"y'\nc: '\nd: '3'\n---\nbody"
    got = spark.createDataFrame([(text,)], "t string").select(exports.front_matter(F.col("t")).alias("f")).select("f", exports.typed_fields(F.col("f"))["d"].cast("int").alias("d")).first()
    assert got.f == {"a": "x", "b": "\"y'", "c": "'", "d": "3"} and got.d == 3


def test_proposals_and_diagnostics_by_command_line(spark, tmp_path, capsys, monkeypatch):
    root = tmp_path / "root"
    said = lambda: {x["check"]: x["status"] for x in map(json.loads, capsys.readouterr().out.splitlines())}
    assert cli.main(["diagnose", str(root)]) == 1 and said() == {"store": "fail", "queue": "ok", "reviews": "ok", "notes": "fail"}
    spark.createDataFrame(RECORD, STORE).write.parquet(str(root / "store"))
    monkeypatch.setenv("THREADLOOM_NOTES", str(root / "candidates"))
    assert cli.main(["propose", str(root / "store"), str(root / "candidates")]) == 0
    assert json.loads(capsys.readouterr().out)["written"] == len(RECORD)
    assert cli.main(["intake-all", str(root / "store"), str(root / "candidates"), str(root / "queue")]) == 0
    capsys.readouterr()
    assert cli.main(["diagnose", str(root)]) == 0 and said() == {"store": "ok", "queue": "ok", "reviews": "ok", "notes": "ok"}
    spark.range(1).write.parquet(str(root / "queue/data/commit=lost"))
    assert cli.main(["diagnose", str(root)]) == 0 and said()["queue"] == "warn"


def test_merges_of_other_columns_and_shingle_keys(spark):
    import zlib

    from threadloom.functions import text as T
    from threadloom.operators import messages

    a, b = spark.createDataFrame([(1, "x")], "k int, v string"), spark.createDataFrame([(2,)], "k int")
    assert messages.merge_delta(a, b, "k").count() == 2 and messages.merge_delta(a, a, "k", strict=True).count() == 1
    with pytest.raises(ValueError, match="missing: .'v'."):
        messages.merge_delta(a, b, "k", strict=True)
    assert a.select(T.shingle_key(F.lit("a é b"))).first()[0] == zlib.crc32("a é b".encode())
