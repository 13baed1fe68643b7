"""Token-id files: a static range asymmetric numeral system over shared frequencies.

The ids of all documents, in ascending order of document id, are written to shard
files. A shard is a row of frames; each frame has a kind, a length and a CRC-32:

    H  shard number, scale, lanes, and the frequency table (shared by all shards)
    D  ids and lengths of documents
    B  a block: how many ids, the first id's place in the shard, the CRC-32 of its
       ids, the lanes' states, then 32-bit words
    E  totals

A block's lanes are interleaved coders that need nothing but the block and the
table, so blocks are the checkpoints from which readers decode in parallel. Frames
end with a line feed, as Spark's text writer ends its rows: any file system that
Spark writes to will do, and its commit protocol covers lost tasks.

Defined results: a null or empty text holds only the end id; null ids come first;
rows of equal ids follow the order of their token ids; extra columns are dropped.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import ChunkEncoder, id_width, strings, tokenizer_json
from .common import bound_batches, materialize, resident, shared_path, slices

MAGIC = b"TLRA"
SCALE = 20  # bits of the frequencies' sum
LANES = 256
BLOCK = 65_536
GROUP = 16  # blocks coded side by side
FLOOR = np.uint64(1 << 31)


class LibraryEncoder(ChunkEncoder):
    """Encodes pieces with the tokenizers library's model."""

    def __init__(self, text: str):
        from tokenizers import Tokenizer

        super().__init__(json.loads(text), 500_000)
        self.tokenize = Tokenizer.from_str(text).model.tokenize

    def ids_of(self, symbols: str) -> list[int]:
        return [t.id for t in self.tokenize(symbols)]


def token_ids(docs: DataFrame, tokenizer: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str]:
    """(id, n, ids in little-endian bytes) of each row with ``end_id`` after it, and the ids' width."""
    text = tokenizer_json(tokenizer)
    width = id_width(json.loads(text), end_id)
    shared = bound_batches(docs).sparkSession.sparkContext.broadcast(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = resident(("library", shared.value), lambda: LibraryEncoder(shared.value))
        for batch in slices(batches, "text", 8_000_000):
            ids, bounds = encode.batch(batch.column(1))
            n = np.diff(bounds) + 1
            ends = bounds + np.arange(len(bounds))
            out = np.full(int(ends[-1]), end_id, width)
            out[np.arange(len(ids)) + np.repeat(np.arange(len(n)), n - 1)] = ids
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), strings(out.view(np.uint8), ends * out.itemsize, pa.binary())], names=["id", "n", "ids"])

    kind = dict(docs.dtypes)[id_col]
    return docs.selectExpr(f"`{id_col}` AS id", f"`{text_col}` AS text").mapInArrow(run, f"id {kind}, n bigint, ids binary"), width


def flat_ids(column: pa.Array, width: str) -> np.ndarray:
    """The ids of all rows in one array, without a copy."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(width) if len(column) and offsets[-1] > offsets[0] else np.zeros(0, width)


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts scaled to a sum of 2 ** SCALE, none that occurs below 1."""
    whole = 1 << SCALE
    if np.count_nonzero(counts) > whole // 2:
        raise ValueError("too many symbols for the scale")
    total = int(counts.sum())
    if not total:
        return np.zeros(len(counts), np.uint32)
    f = np.where(counts > 0, np.maximum(1, counts.astype(object) * whole // total), 0).astype(np.int64)
    left = whole - int(f.sum())
    for j in np.argsort(-f, kind="stable"):
        if left >= 0:
            break
        take = min(int(f[j]) // 2, -left)
        f[j] -= take
        left += take
    f[int(np.argmax(f))] += left
    return f.astype(np.uint32)


class Coder:
    def __init__(self, f: np.ndarray):
        self.f = f.astype(np.uint64)
        self.low = np.concatenate([[0], np.cumsum(f, dtype=np.uint64)])[:-1].astype(np.uint64)
        self.most = int(np.argmax(f)) if len(f) else 0

    def encode(self, ids: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """ids (blocks, steps, lanes) -> states (blocks, lanes) and each block's words."""
        blocks, steps, lanes = ids.shape
        x = np.full((blocks, lanes), FLOOR, np.uint64)
        words = np.empty((blocks, steps, lanes), np.uint32)
        out = np.empty((blocks, steps, lanes), bool)
        for t in range(steps - 1, -1, -1):
            s = ids[:, t]
            f = self.f[s]
            over = x >= f << np.uint64(63 - SCALE)
            words[:, t], out[:, t] = x, over  # the low 32 bits
            x = np.where(over, x >> np.uint64(32), x)
            q = x // f
            x = (q << np.uint64(SCALE)) + (x - q * f) + self.low[s]
        return x, [words[b][out[b]] for b in range(blocks)]

    def decoder(self) -> None:
        if not hasattr(self, "symbol"):
            self.symbol = np.repeat(np.arange(len(self.f), dtype=np.uint32), self.f.astype(np.int64))

    def decode(self, states: np.ndarray, words: list[np.ndarray], steps: int) -> np.ndarray:
        self.decoder()
        x = states.astype(np.uint64)
        flat = np.concatenate([*words, np.zeros(1, np.uint32)]).astype(np.uint64)
        at = np.concatenate([[0], np.cumsum([len(w) for w in words])])[:-1]
        out = np.empty((x.shape[0], steps, x.shape[1]), np.uint32)
        mask = np.uint64((1 << SCALE) - 1)
        for t in range(steps):
            slot = x & mask
            s = self.symbol[slot]
            out[:, t] = s
            x = self.f[s] * (x >> np.uint64(SCALE)) + slot - self.low[s]
            short = x < FLOOR
            ends = np.cumsum(short, 1)
            x[short] = (x[short] << np.uint64(32)) | flat[(at[:, None] + ends - 1)[short]]
            at = at + ends[:, -1]
        return out


def frame(kind: bytes, payload: bytes) -> bytes:
    return MAGIC + kind + struct.pack("<II", len(payload), zlib.crc32(payload)) + payload


def frames(content: memoryview) -> Iterator[tuple[bytes, memoryview]]:
    at = 0
    while at < len(content):
        if bytes(content[at : at + 4]) != MAGIC:
            raise ValueError(f"no frame at byte {at}")
        size, crc = struct.unpack_from("<II", content, at + 5)
        payload = content[at + 13 : at + 13 + size]
        if zlib.crc32(payload) != crc:
            raise ValueError(f"damaged frame at byte {at}")
        yield bytes(content[at + 4 : at + 5]), payload
        at += 14 + size


def encode_blocks(coder: Coder, ids: np.ndarray, first: int) -> Iterator[bytes]:
    """Frames of ids whose place in the shard is ``first``; all but a last block are full."""
    for at in range(0, len(ids), BLOCK * GROUP):
        part = ids[at : at + BLOCK * GROUP]
        full = len(part) // BLOCK
        for shape in ([part[: full * BLOCK].reshape(full, -1, LANES)] if full else []) + ([part[full * BLOCK :]] if len(part) % BLOCK else []):
            if shape.ndim == 1:
                n = len(shape)
                shape = np.concatenate([shape, np.full(-n % LANES, coder.most, shape.dtype)]).reshape(1, -1, LANES)
            else:
                n = BLOCK
            states, words = coder.encode(shape)
            for b in range(len(shape)):
                own = shape[b].reshape(-1)[:n].astype("<u4")
                yield frame(b"B", struct.pack("<IQI", n, first, zlib.crc32(own.tobytes())) + states[b].astype("<u8").tobytes() + words[b].astype("<u4").tobytes())
                first += n


def write_token_files(staged: DataFrame, width: str, path: str, shard_ids: int = 4_000_000) -> None:
    """Writes shards of about ``shard_ids`` ids, in ascending order of id."""
    spark = staged.sparkSession

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, np.int64)
        for batch in batches:
            found = np.bincount(flat_ids(batch.column(0), width))
            if len(found) > len(total):
                total = np.concatenate([total, np.zeros(len(found) - len(total), np.int64)])
            total[: len(found)] += found
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["token", "n"])

    # Bounded by the vocabulary: one row a token.
    counted = staged.select("ids").mapInArrow(count, "token int, n bigint").groupBy("token").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(int(counted["token"].max()) + 1 if len(counted) else 1, np.int64)
    counts[counted["token"].to_numpy(np.int64)] = counted["n"].to_numpy(np.int64)
    f = frequencies(counts)
    table = spark.sparkContext.broadcast(f)
    shards = max(1, -(-int(counts.sum()) // shard_ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        coder, shard = Coder(table.value), TaskContext.get().partitionId()
        out = lambda made: pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["frame"])
        kept: list[np.ndarray] = []
        held = first = docs = 0

        def flush(last: bool) -> list[bytes]:
            nonlocal kept, held, first
            ids = np.concatenate(kept) if kept else np.zeros(0, width)
            n = len(ids) if last else len(ids) - len(ids) % (BLOCK * GROUP)
            made = [*encode_blocks(coder, ids[:n], first)]
            first += n
            kept, held = [ids[n:]], len(ids) - n
            return made

        for batch in batches:
            if not docs and batch.num_rows:
                yield out([frame(b"H", struct.pack("<IHHI", shard, SCALE, LANES, len(table.value)) + zlib.compress(table.value.astype("<u4").tobytes()))])
            docs += batch.num_rows
            ids = [np.frombuffer(x.as_buffer(), width) for x in batch.column(1)]
            kept += ids
            held += sum(map(len, ids))
            made = [frame(b"D", zlib.compress(json.dumps([batch.column(0).to_pylist(), [len(x) for x in ids]]).encode()))]
            if held >= BLOCK * GROUP:
                made += flush(False)
            yield out(made)
        if docs:
            yield out([*flush(True), frame(b"E", struct.pack("<QQ", docs, first))])

    ordered = staged.select("id", "ids").repartitionByRange(shards, F.asc_nulls_first("id")).sortWithinPartitions(F.asc_nulls_first("id"), "ids")
    ordered.mapInArrow(run, "frame binary").select(F.col("frame").cast("string")).write.text(path)


def read_token_files(spark: SparkSession, path: str, kind: str = "bigint", with_ids: bool = False) -> DataFrame:
    """(shard, place in the shard, id, n, crc32[, ids]) of each document, from the files alone; damage raises an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                if content.is_valid and len(content.as_buffer()):
                    yield from shard(memoryview(content.as_buffer()))

    def shard(content: memoryview) -> Iterator[pa.RecordBatch]:
        number, coder, names, sizes, blocks, total = 0, None, [], [], [], None
        ids = []

        def flush() -> None:
            # Blocks of one length are decoded side by side.
            while blocks:
                n = blocks[0][0]
                group = [b for b in blocks[:GROUP] if b[0] == n]
                del blocks[: len(group)]
                steps = -(-n // LANES)
                made = coder.decode(np.stack([np.frombuffer(b[3], "<u8", LANES) for b in group]), [np.frombuffer(b[3], "<u4", offset=8 * LANES) for b in group], steps)
                for b, x in zip(group, made, strict=True):
                    own = x.reshape(-1)[:n].astype("<u4")
                    if zlib.crc32(own.tobytes()) != b[2]:
                        raise ValueError(f"damaged block at id {b[1]}")
                    ids.append(own)

        for k, payload in frames(content):
            if k == b"H":
                number, scale, lanes, _ = struct.unpack_from("<IHHI", payload)
                if (scale, lanes) != (SCALE, LANES):
                    raise ValueError("written with other parameters")
                coder = Coder(np.frombuffer(zlib.decompress(payload[12:]), "<u4"))
            elif k == b"D":
                a, b = json.loads(zlib.decompress(payload))
                names += a
                sizes += b
            elif k == b"B":
                blocks.append((*struct.unpack_from("<IQI", payload), payload[16:]))
                if len(blocks) == GROUP:
                    flush()
            elif k == b"E":
                total = struct.unpack_from("<QQ", payload)
        flush()
        flat = np.concatenate(ids) if ids else np.zeros(0, "<u4")
        if total != (len(names), len(flat)) or sum(sizes) != len(flat):
            raise ValueError(f"shard {number} is not whole")
        raw = memoryview(flat.tobytes())
        ends = np.cumsum(sizes)
        for i in range(0, len(names), 5_000):
            span = [(int(e) - s, int(e)) for e, s in zip(ends[i : i + 5_000], sizes[i : i + 5_000], strict=True)]
            columns = [pa.array([number] * len(span), pa.int64()), pa.array([a for a, _ in span], pa.int64()), pa.array(names[i : i + 5_000], pa.int64() if kind == "bigint" else None), pa.array([b - a for a, b in span], pa.int64()), pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in span], pa.int64())]
            if with_ids:
                columns.append(pa.array([flat[a:b] for a, b in span], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=["shard", "place", "id", "n", "crc32", "ids"][: len(columns)])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(run, f"shard bigint, place bigint, id {kind}, n bigint, crc32 bigint" + ", ids array<int>" * with_ids)


def token_file_round_trip(docs: DataFrame, tokenizer: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Writes the token files and reads them back: (id, start, n_tokens, ids_crc32)."""
    spark = docs.sparkSession
    path = path or shared_path(spark, "token-files")
    made, width = token_ids(docs, tokenizer, end_id, id_col, text_col)
    write_token_files(materialize(made, "ids"), width, path)
    read = materialize(read_token_files(spark, path, dict(docs.dtypes)[id_col]), "read")
    # One row a shard.
    totals = read.groupBy("shard").agg(F.sum("n").alias("n"))
    before = totals.select("shard", F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return read.join(before, "shard").select(F.col("id").alias(id_col), (F.col("before") + F.col("place")).alias("start"), F.col("n").alias("n_tokens"), F.col("crc32").alias("ids_crc32"))
