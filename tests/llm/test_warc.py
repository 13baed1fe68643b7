from __future__ import annotations

import hashlib

import numpy as np
import pytest

from threadloom.llm import warc


def brute(rows):
    first = {}
    for page, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 100 and page is not None:
            first[data] = min(first.get(data, page), page)
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        again = page is not None and first.get(data, page) != page
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first[data] if again else None))
    return sorted(out, key=str)


MAGIC = "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nX-Page-Id: 666\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"


def rows():
    long = "<p>é</p>" * 40
    made = [(i, f"http://a/{i} b\r\nX: y", long if i % 3 == 0 else f"page {i} " * (i % 40)) for i in range(200)]
    made += [(900, None, None), (901, "u", ""), (902, "u", "x" * 99), (903, "u", "x" * 99), (904, "u", "x" * 100), (905, "u", "x" * 100)]
    made += [(950 + i, "u", MAGIC * 3 + "y" * i) for i in range(5)] + [(None, "u", long), (7, "u", "page 7 " * 7), (960, "u", "﻿ tail\r\n")]
    return made


def test_round_trip_with_magic_in_payloads(spark, tmp_path):
    df = spark.createDataFrame(rows(), "page_id bigint, url string, html string").repartition(3)
    assert sorted(map(tuple, warc.archive_round_trip(df, path=str(tmp_path / "w")).collect()), key=str) == brute(rows())


@pytest.mark.parametrize("chunk", [64, 1000, 5000])
def test_small_chunks_give_the_same(spark, tmp_path, chunk):
    df = spark.createDataFrame(rows(), "page_id bigint, url string, html string").coalesce(1)
    warc.write_archives(df, str(tmp_path / "w"))
    read = warc.read_archives(spark, str(tmp_path / "w"), chunk_bytes=chunk)
    assert sorted(r.page for r in read.collect()) == sorted("null" if r[0] is None else str(r[0]) for r in rows())


def test_magic_is_no_record(tmp_path):
    data = warc.record(1, "u", MAGIC.encode() * 2, "d", 2, None, "t") + b"\r\n" + warc.record(2, "u", b"x", "d", 1, None, "t") + b"\r\n"
    found = [*warc.candidates(data)]
    assert len(found) == 4
    offsets, successors = np.array([f[0] for f in found]), np.array([f[1] for f in found])
    assert warc.jumps(offsets, successors, 10**6).tolist()[0] == -1 and successors[-1] == len(data)


def test_test_table_and_clashing_columns(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").selectExpr("*", "1 AS digest", "'x' AS id")
    want = brute([(r.page_id, r.url, r.html) for r in pages.collect()])
    assert sorted(map(tuple, warc.archive_round_trip(pages).collect()), key=str) == want


def test_empty_table(spark):
    assert warc.archive_round_trip(spark.createDataFrame([], "page_id bigint, url string, html string")).collect() == []


def test_one_page_with_several_payloads(spark, tmp_path):
    a, b, c = "a" * 150, "b" * 150, "c" * 150
    made = [(3, "u", a), (5, "u", a), (5, "u", b), (5, "u", "short"), (5, "u", None), (9, "u", b), (2, "u", c), (3, "u", c), (None, "u", a), (5, "u", a)]
    path = str(tmp_path / "w")
    read = warc.archive_round_trip(spark.createDataFrame(made, "page_id bigint, url string, html string").repartition(3), path=path)
    assert sorted(map(tuple, read.collect()), key=str) == brute(made)
    data = b"".join(p.read_bytes() for p in (tmp_path / "w").glob("part-*"))
    fields = [f for _, _, f, _ in warc.candidates(data)]
    first = {f["warc-record-id"]: f for f in fields if f["warc-type"] == "response"}
    again = [f for f in fields if f["warc-type"] == "revisit"]
    assert len(again) == 4 and all(first[f["warc-refers-to"]]["warc-payload-digest"] == f["warc-payload-digest"] for f in again)


def test_long_urls_and_broken_files(spark, tmp_path):
    made = [(i, "http://a/" + (" WARC/1.1" * 40_000 if i == 5 else "x"), f"page {i}") for i in range(20)]
    df = spark.createDataFrame(made, "page_id bigint, url string, html string").coalesce(1)
    assert sorted(map(tuple, warc.archive_round_trip(df, path=str(tmp_path / "w")).collect()), key=str) == brute(made)
    # The archive with most records; the long url's page lies in one of its own.
    data = max((p.read_bytes() for p in (tmp_path / "w").glob("part-*")), key=lambda x: x.count(b"WARC-Type: "))
    cut = data.rindex(b"WARC/1.1\r\n")
    for i, bad in enumerate((data[:-1], data + b"x", data[:cut] + b"X" + data[cut + 1 :], data[1:], b"nothing")):
        (tmp_path / f"{i}").mkdir()
        (tmp_path / f"{i}" / "part-0").write_bytes(bad)
        with pytest.raises(ValueError, match="end"):
            warc.read_archives(spark, str(tmp_path / f"{i}"), chunk_bytes=1000)


def test_large_pages_lie_in_archives_of_their_own(spark, tmp_path):
    rows = [(i, f"http://a/{i}", "x" * (200 + i)) for i in range(300)] + [(1000 + i, None, "y" * (200_000 + i)) for i in range(5)] + [(2000, "http://b", "y" * 200_001)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1)
    warc.write_archives(df, str(tmp_path / "a"), file_bytes=400_000)
    sizes = sorted(p.stat().st_size for p in (tmp_path / "a").glob("part-*"))
    assert len(sizes) >= 5 and sizes[-1] < 400_000 * 12
    got = {(r.page, r.bytes, r.kind) for r in warc.read_archives(spark, str(tmp_path / "a")).collect()}
    assert got == {(str(i), len(h), "revisit" if i == 2000 else "response") for i, _, h in rows}
