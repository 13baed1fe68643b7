"""A fake paged service, read as a batch and as a stream."""

from __future__ import annotations

import json

import pytest

from threadloom.sources.exports import SourceError
from threadloom.sources.paged import Busy, PagedSource, paged

@pytest.fixture(scope="module")
def service(spark):
    spark.dataSource.register(PagedSource)
    return "tests.fake_paged_service:fetch"


def resource(folder, n):
    folder.mkdir(exist_ok=True)
    (folder / "rows.json").write_text(json.dumps([{"id": f"{folder.name}{i}", "n": i, "tags": ["x"]} for i in range(n)]))
    return str(folder)


def test_pages_with_back_off():
    pages, waits = {None: {"results": [1, 2], "has_more": True, "next_cursor": "x"}, "x": {"results": [3], "has_more": False}}, []
    busy = iter([True, True, False, False])

    def fetch(cursor):
        if next(busy):
            raise Busy(1.5 if not waits else 0)
        return pages[cursor]

    assert [*paged(fetch, wait=waits.append)] == [1, 2, 3] and waits == [1.5, 2.0]

    def always(cursor):
        raise Busy()

    for bad in (always, lambda c: {"results": [1] * 101}, lambda c: {"results": [], "has_more": True, "next_cursor": c}):
        with pytest.raises(SourceError):
            [*paged(bad, wait=lambda _: None)]


def test_batch(spark, service, tmp_path):
    a, b, c = (resource(tmp_path / name, n) for name, n in (("a", 25), ("b", 3), ("c", 0)))
    (tmp_path / "a/busy").touch()
    load = spark.read.format("paged").option("service", service).option("resources", f"{a}, {b},{c}").option("page_size", 10)
    rows = load.load()
    assert rows.rdd.getNumPartitions() == 3
    assert sorted((r.resource, json.loads(r.result)["n"]) for r in rows.collect()) == [*((a, i) for i in range(25)), *((b, i) for i in range(3))]
    typed = load.schema("id string, n int, tags string, missing double").load()
    assert sorted(typed.where("n < 1").collect()) == [("a0", 0, '["x"]', None), ("b0", 0, '["x"]', None)]
    with pytest.raises(Exception, match="module:function"):
        spark.read.format("paged").load().collect()


def test_stream_goes_on_after_a_failure(spark, service, tmp_path):
    a, b = resource(tmp_path / "a", 20), resource(tmp_path / "b", 5)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")

    def go():
        stream = spark.readStream.format("paged").option("service", service).option("resources", f"{a},{b}").option("page_size", 10).schema("id string, n int").load()
        return stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds").start(out)

    def seen():
        return sorted(r.id for r in spark.read.schema("id string, n int").parquet(out).collect())

    def run(n):
        resource(tmp_path / "a", n)
        query = go()
        query.processAllAvailable()
        query.stop()
        assert seen() == sorted([f"a{i}" for i in range(n)] + [f"b{i}" for i in range(5)])

    run(20)
    (tmp_path / "a/broken").write_text("30")
    with pytest.raises(Exception, match="down"):
        run(40)
    before = seen()
    assert before == sorted([f"a{i}" for i in range(20)] + [f"b{i}" for i in range(5)])
    (tmp_path / "a/broken").unlink()
    for n in (40, 40, 47):
        run(n)
