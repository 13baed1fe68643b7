"""WARC archives: writing with revisit records, and reading by boundary chains.

Writing: payloads of some length are grouped by digest; the smallest page id of a
group writes a response, the others a revisit of it without payload. Records end
with an empty line, which Spark's text writer adds as its row end, so archives
land on any file system that Spark writes to.

Reading: tasks look for the version line anywhere and emit, for each such place,
where its record would end. Within a chunk of a file each place's pointer jumps to
the first place after the chunk that its chain reaches; between chunks the
pointers are doubled in joins. Only places that the chain from the file's start
reaches are records, so version lines inside payloads are never taken for one.

Defined results: a null payload counts as empty; a null page id always writes a
response; of rows with the group's smallest id each is a response; a null url
leaves out the target; an id with several payloads is decided for each; extra columns
are dropped.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bound_batches, materialize, shared_path, slices

VERSION = re.compile(rb"(?<![^\n])WARC/1\.[01]\r\n")
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"


def record_id(page: object, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, json.dumps([page, digest]))}>"


def clean(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record(page: object, url: str | None, payload: bytes, digest: str, size: int, refers: object, date: str) -> bytes:
    """One record without the line feed pair that the writer adds."""
    block = HTTP + f"Content-Length: {size}\r\n\r\n".encode()
    kind = b"response" if refers is None else b"revisit"
    if refers is None:
        block += payload
    head = [b"WARC/1.1", b"WARC-Type: " + kind, f"WARC-Record-ID: {record_id(page, digest)}".encode(), f"WARC-Date: {date}".encode()]
    if url is not None:
        head.append(b"WARC-Target-URI: " + clean(url).encode())
    head += [f"WARC-Payload-Digest: sha256:{digest}".encode(), f"X-Page-Id: {json.dumps(page)}".encode(), f"X-Payload-Bytes: {size}".encode()]
    if refers is not None:
        head += [f"WARC-Refers-To: {record_id(refers, digest)}".encode(), f"X-Refers-To-Page: {json.dumps(refers)}".encode(), b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += [b"Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}".encode()]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n"


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 100, file_records: int = 8_192, file_bytes: int = 134_217_728, date: str = "1970-01-01T00:00:00Z") -> None:
    """Writes ``pages`` as archives of at most ``file_records`` records and of about ``file_bytes`` each.

    Pages of more than twelve times the mean size lie in archives of their own, with fewer
    records the larger the largest is. So no archive has more than twelve times ``file_bytes``,
    or one page's, and each is read whole by one task.
    """
    kind = dict(pages.dtypes)[id_col]
    pages = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    weight = F.octet_length("payload") + 3 * F.octet_length(F.coalesce("url", F.lit("")))
    sizes = bound_batches(pages).agg(F.avg(weight).alias("mean"), F.max(weight).alias("most")).first()
    mean, most = int(sizes.mean or 0) + 1_024, int(sizes.most or 0) + 1_024
    pages = pages.withColumn("large", weight > 12 * mean)
    pages = pages.withColumn("digest", F.when((F.octet_length("payload") >= least) & F.col("id").isNotNull(), F.sha2("payload", 256)))
    slim = pages.where(F.col("digest").isNotNull()).select("id", "url", "digest", F.octet_length("payload").cast("bigint").alias("size"))
    groups = slim.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").select("digest", "first")
    # Written, so that its size is known: a small table of revisits is broadcast by the planner, a large one is joined by shuffling.
    revisits = materialize(slim.join(groups, "digest").where("id <> first").select("id", "url", "digest", "size", F.col("first").alias("refers")), "revisits")
    # An id may have several payloads, so id and digest together say which rows are revisits; rows without digest never are.
    responses = pages.join(revisits.select("id", "digest").distinct(), ["id", "digest"], "left_anti").select("id", "url", "payload", "digest", F.lit(None).cast("bigint").alias("size"), F.lit(None).cast(kind).alias("refers"), "large")
    again = revisits.select("id", "url", F.lit("").alias("payload"), "digest", "size", "refers", F.octet_length(F.coalesce("url", F.lit(""))) * 3 > 12 * mean)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "payload", 4_000_000):
            made = []
            for page, url, payload, digest, size, refers in zip(*(c.to_pylist() for c in batch.columns[:6]), strict=True):
                data = payload.encode()
                made.append(record(page, url, data, digest or hashlib.sha256(data).hexdigest(), len(data) if size is None else size, refers, date))
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["record"])

    def write(rows: DataFrame, records: int) -> None:
        made = rows.mapInArrow(run, "record binary").select(F.col("record").cast("string"))
        made.write.mode("append").option("lineSep", "\r\n").option("maxRecordsPerFile", max(1, min(file_records, records))).text(path)

    rows = responses.union(again)
    write(rows.where("NOT large"), file_bytes // mean)
    if most > 12 * mean:
        write(rows.where("large"), file_bytes // most)


def _header(data: bytes, at: int, to: int) -> tuple[dict[str, str], int] | None:
    end = data.find(b"\r\n\r\n", at, to)
    if end < 0:
        return None
    fields = {}
    for line in data[at:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if colon:
            fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    return fields, end + 4


def candidates(data: bytes) -> Iterator[tuple[int, int, dict[str, str], int]]:
    """(offset, where the record's successor would be, fields, the block's start) of each version line with a whole record after it."""
    places = [m.start() for m in VERSION.finditer(data)]
    # A header has no second version line, so it ends before the next one: headers may be long, and the search stays linear.
    for at, to in zip(places, [*places[1:], len(data)], strict=False):
        found = _header(data, at, to)
        size = found[0].get("content-length", "") if found else ""
        if size.isdigit():
            end = found[1] + int(size)
            if data[end : end + 4] == b"\r\n\r\n":
                yield at, end + 4, found[0], found[1]


def jumps(offsets: np.ndarray, successors: np.ndarray, chunk: int) -> np.ndarray:
    """For each place, the first place beyond its chunk that its chain reaches; where the chain breaks in the chunk, -1."""
    ends = (offsets // chunk + 1) * chunk
    to = successors.copy()
    for _ in range(max(1, int(len(offsets)).bit_length())):
        inside = (to >= 0) & (to < ends)
        if not inside.any():
            break
        place = np.searchsorted(offsets, to[inside])
        known = (place < len(offsets)) & (offsets[np.minimum(place, len(offsets) - 1)] == to[inside])
        to[inside] = np.where(known, to[np.minimum(place, len(offsets) - 1)], -1)
    return to


FIELDS = "path string, chunk bigint, off bigint, succ bigint, exit bigint, size bigint, page string, bytes bigint, digest string, kind string, refers string, sound boolean"


def _emit(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in FIELDS.split(", ")]
    types = [pa.string(), *[pa.int64()] * 5, pa.string(), pa.int64(), *[pa.string()] * 3, pa.bool_()]
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            data = content.as_py()
            # The file's end counts as a place, which a sound file's chain reaches.
            found = [*candidates(data), (len(data), -1, {}, len(data))]
            offsets, successors = (np.array([f[i] for f in found], np.int64) for i in (0, 1))
            exits = jumps(offsets, successors, chunk)
            rows = []
            for (off, succ, fields, block), leaves in zip(found, exits.tolist(), strict=True):
                kind, named = fields.get("warc-type", ""), fields.get("warc-payload-digest", "").removeprefix("sha256:")
                size, sound, digest = fields.get("x-payload-bytes", ""), True, named
                if kind == "response":
                    at = data.find(b"\r\n\r\n", block, succ - 4)
                    payload = data[at + 4 : succ - 4] if at >= 0 else b""
                    digest, size = hashlib.sha256(payload).hexdigest(), str(len(payload))
                    sound = digest == named or not named
                rows.append((path, off // chunk, off, succ, leaves, len(data), fields.get("x-page-id"), int(size) if size.isdigit() else None, digest, kind, fields.get("x-refers-to-page"), sound))
            for i in range(0, len(rows), 5_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i : i + 5_000], strict=True), types, strict=True)], names=names)


def _walk(part: pd.DataFrame) -> pd.DataFrame:
    """Keeps what the chain from the chunk's entry reaches. A chunk's bytes bound its rows."""
    part = part.sort_values("off")
    place = {o: i for i, o in enumerate(part["off"])}
    after, keep, at = part["succ"].tolist(), [], int(part["entry"].iloc[0])
    while at in place:
        keep.append(place[at])
        at = after[place[at]]
    return part.iloc[keep].drop(columns="entry")


def read_archives(spark: SparkSession, path: str, chunk_bytes: int = 8_388_608, pattern: str = "part-*") -> DataFrame:
    """(page, bytes, digest, kind, refers, sound) of each reachable record; page ids as JSON. A file whose records don't lead from its start to its end raises an error."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "content")
    found = materialize(files.mapInArrow(lambda batches: _emit(batches, chunk_bytes), FIELDS), "candidates")
    # Places where a chain can enter a chunk; of most files' chunks there is one.
    exits = found.where("exit >= 0").select("path", F.col("exit").alias("off")).distinct()
    gates = found.join(exits, ["path", "off"], "left_semi").unionByName(found.where("off = 0")).select("path", "chunk", "off", F.col("exit").alias("to")).distinct()
    gates = materialize(gates, "gates")
    chunks = gates.agg(F.max("chunk")).first()[0]
    reached, hop = gates.where("off = 0").select("path", "off"), gates.select("path", "off", "to")
    for _ in range(int(chunks or 0).bit_length()):
        reached = materialize(reached.unionByName(reached.join(hop, ["path", "off"]).select("path", F.col("to").alias("off"))).distinct(), "reached")
        hop = materialize(hop.join(hop.select("path", F.col("off").alias("to"), F.col("to").alias("beyond")), ["path", "to"]).select("path", "off", F.col("beyond").alias("to")), "hops")
    entries = gates.join(reached, ["path", "off"], "left_semi").select("path", "chunk", F.col("off").alias("entry"))
    walked = materialize(found.join(entries, ["path", "chunk"]).groupBy("path", "chunk").applyInPandas(_walk, FIELDS), "records")
    broken = found.where("off = size").join(walked.where("off = size").select("path"), "path", "left_anti").select("path").first()
    if broken:
        raise ValueError(f"the records of {broken.path} don't lead to the file's end")
    return walked.where("off < size").select("page", "bytes", "digest", "kind", "refers", "sound")


def archive_round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 100, path: str | None = None) -> DataFrame:
    """Writes and reads back: (id, payload_bytes, payload_digest, record_type, refers_to). A record whose payload doesn't fit its digest raises an error."""
    path = path or shared_path(pages.sparkSession, "archives")
    write_archives(pages, path, id_col, url_col, payload_col, least)
    kind = dict(pages.dtypes)[id_col]
    value = lambda c: F.from_json(F.concat(F.lit('{"x":'), c, F.lit("}")), f"x {kind}")["x"]
    read = read_archives(pages.sparkSession, path)
    digest = F.when(F.col("sound"), F.col("digest")).otherwise(F.raise_error("a payload doesn't fit its digest"))
    return read.select(value("page").alias(id_col), F.col("bytes").alias("payload_bytes"), digest.alias("payload_digest"), F.col("kind").alias("record_type"), value("refers").alias("refers_to"))
