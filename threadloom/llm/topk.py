"""Exact top-k inner products over norm-sorted blocks.

Components become integers, floor(scale * x). The eigenvectors of all vectors'
Gram matrix (their right singular vectors) rotate them, so that a few leading
coordinates carry most of an inner product. Vectors lie in blocks of descending
length. The block of the longest gives each query a first k-th best score; a
query block meets only the blocks whose longest vector could reach it, and in
them only vectors whose leading partial sum plus the product of both residual
lengths (Cauchy-Schwarz) could. What is left is scored exactly in integers.

Queries and rows meet in blocks of bounded size that are joined on the block's
number; each gives k rows a query at most. A block holds vectors of about one number
of components, and as many as its size allows; only the first ``ROTATED`` components are
rotated, others belong to the residual, so that one long vector costs the others nothing.
Matrices travel in the narrowest type that holds their integers.

Defined results: vectors that are null or hold null or non-finite components take
no part (components that are infinite once scaled count as such), nor do rows without
id; every other vector does, however long. Scores are exact; one beyond 64 bits counts as
the nearest number of 64 bits. A shorter vector counts as padded with zeros; a
query never meets rows of its own id; each repeated query row is a query of its
own; other repeated rows are candidates each; extra columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

EXACT = 2.0**52  # products of lengths below this are exact in doubles
MOST, LEAST = 2**63 - 1, -(2**63)
WHOLE = 2.0**62  # smaller components fit in 64 bits
ROTATED = 1024  # components
CELLS = 8_192 * 1_024  # components of a block


def lists_of(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return lists, np.diff(lists.offsets.to_numpy())


def matrix(lists: pa.Array, sizes: np.ndarray, width: int, scale: float) -> np.ndarray:
    """The lists' values as doubles, scaled and floored, each row cut or padded to ``width``."""
    flat = np.floor(scale * lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    inside = place < width
    out = np.zeros((len(sizes), width))
    out[row[inside], place[inside]] = flat[inside]
    return out


def gram(vectors: DataFrame, width: int, scale: float) -> np.ndarray:
    """The Gram matrix of all vectors' first ``width`` components: a matrix a task, added up in two steps. It decides how well bounds prune, no result, so huge components are scaled down."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            m = matrix(*lists_of(batch.column(0)), width, scale)
            m *= np.minimum(1.0, 1e9 / np.maximum(1.0, np.abs(m).max(1, initial=0.0)))[:, None]
            total += m.T @ m
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["g"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width * width)
        for batch in batches:
            for x in batch.column(0):
                total += np.frombuffer(x.as_buffer())
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["g"])

    found = vectors.select("x").mapInArrow(part, "g binary").repartition(8).mapInArrow(add, "g binary").collect()
    return sum((np.frombuffer(r.g).reshape(width, width) for r in found), np.zeros((width, width)))


def narrow(m: np.ndarray) -> tuple[str, bytes]:
    """The integers of ``m`` in the narrowest type that holds them."""
    top = np.abs(m).max(initial=0.0)
    kind = "<i2" if top < 2**15 else "<i4" if top < 2**31 else "<f8"
    return kind, m.astype(kind).tobytes()


def widen(kind: str, data: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(data, kind).reshape(rows, -1).astype(np.float64)


def exact_scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Integer inner products, those beyond 64 bits as the nearest number of 64 bits."""
    lengths = np.outer(np.sqrt((q * q).sum(1)), np.sqrt((v * v).sum(1)))
    near = q @ v.T
    if lengths.max(initial=0) < EXACT:
        return near.astype(np.int64)
    # Sums modulo 2 ** 64 are right where the whole sum fits, which the doubles tell but for a narrow band.
    whole = np.clip(q, -WHOLE, WHOLE).astype(np.int64) @ np.clip(v, -WHOLE, WHOLE).astype(np.int64).T
    slack = 1e-9 * lengths + 1
    large = (np.abs(q).max(1, initial=0) >= WHOLE)[:, None] | (np.abs(v).max(1, initial=0) >= WHOLE)[None, :]
    over, under = near - slack > 2.0**63, near + slack < -(2.0**63)
    whole[over], whole[under] = MOST, LEAST
    for i, j in np.argwhere(~over & ~under & (large | ~(np.abs(near) + slack < 2.0**63))).tolist():
        whole[i, j] = max(LEAST, min(MOST, sum(int(a) * int(b) for a, b in zip(q[i].tolist(), v[j].tolist(), strict=True))))
    return whole


def turned(m: np.ndarray, rotation: np.ndarray, lead: int) -> tuple[np.ndarray, np.ndarray]:
    """Leading coordinates of each row, and the length of what they leave."""
    near = m[:, : len(rotation)] @ rotation[: m.shape[1]]
    return near[:, :lead], np.sqrt((near[:, lead:] ** 2).sum(1) + (m[:, len(rotation) :] ** 2).sum(1))


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best by score, then smaller id."""
    if len(scores) > 4 * k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        kept = np.flatnonzero(scores >= floor)
        return kept[np.lexsort((ids[kept], -scores[kept]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def search_block(qi: np.ndarray, q: np.ndarray, least: np.ndarray, vi: np.ndarray, v: np.ndarray, rotation: np.ndarray, k: int, lead: int, step: int = 2048) -> list[tuple[int, int, int]]:
    """(query's place, id, score) of the block's rows that may be among the k best; ``least``: known k-th best scores; ``v`` by descending length."""
    (qr, q_rest), (vr, v_rest) = turned(q, rotation, lead), turned(v, rotation, lead)
    qn, vn = np.sqrt((q * q).sum(1)), np.sqrt((v * v).sum(1))
    # Components that the other side lacks count as products with zero.
    width = min(q.shape[1], v.shape[1])
    q, v = q[:, :width], v[:, :width]
    least = least.astype(np.float64).copy()
    found: list[list] = [[np.zeros(0, np.int64), np.zeros(0, np.int64)] for _ in qi]
    for at in range(0, len(vi), step):
        part = slice(at, at + step)
        # Lengths beyond doubles give nan, which prunes nothing.
        alive = np.flatnonzero(~(qn * vn[part].max() * (1 + 1e-9) + 1 < least))
        if not len(alive):
            break
        # Rounding in doubles is far below the slack of 1e-9 of the lengths' product plus 1.
        bound = qr[alive] @ vr[part].T + np.outer(q_rest[alive], v_rest[part]) + 1e-9 * np.outer(qn[alive], vn[part]) + 1
        may = ~(bound < least[alive, None])
        columns = np.flatnonzero(may.any(0))
        if not len(columns):
            continue
        scores = exact_scores(q[alive], v[part][columns])
        ids = vi[part][columns]
        for row, place in enumerate(alive.tolist()):
            own = may[row, columns] & (ids != qi[place])
            if own.any():
                s, i = np.concatenate([found[place][0], scores[row, own]]), np.concatenate([found[place][1], ids[own]])
                top = best(s, i, k)
                found[place] = [s[top], i[top]]
                if len(top) == k:
                    least[place] = max(least[place], s[top[-1]])
    return [(place, int(i), int(s)) for place, (ss, ii) in enumerate(found) for s, i in zip(ss, ii, strict=True)]


def top_k(rows: DataFrame, is_query, k: int = 10, scale: float = 1024.0, id_col: str = "vec_id", vector_col: str = "embedding", block_rows: int = 8_192, lead: int = 16) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row for which ``is_query`` holds, the k rows of highest inner product, ties to the smaller id."""
    spark = rows.sparkSession
    sound = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) != float("inf"))
    vectors = rows.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("x")).where(F.col("id").isNotNull() & F.col("x").isNotNull() & F.forall("x", sound))
    # The integers' squares, as a double: blocks need the order of lengths only roughly.
    squares = F.aggregate("x", F.lit(0.0), lambda a, x: a + F.pow(F.abs(x * scale) + 1, F.lit(2.0)))
    vectors = vectors.withColumn("l", squares)
    shape = vectors.agg(F.max(F.size("x")).alias("d"), F.count("*").alias("n")).first()
    schema = "query_id bigint, rank int, vec_id bigint, score bigint"
    if not shape.n:
        return spark.createDataFrame([], schema)
    width = max(1, min(ROTATED, shape.d))
    g = gram(vectors, width, scale)
    values, axes = np.linalg.eigh(g / max(1.0, float(np.abs(g).max())))
    rotation = np.ascontiguousarray(axes[:, np.argsort(-values)])
    lead = min(lead, width)
    blocks = -(-shape.n // block_rows)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows into packed blocks of ``block_rows`` at most, in their order; a block's vectors have as many components but for a factor of two."""
        open_: dict[int, tuple[list, list]] = {}

        def out(ids: list, parts: list) -> pa.RecordBatch:
            i, m = np.concatenate(ids), np.concatenate(parts)
            with np.errstate(over="ignore"):
                lengths = np.sqrt((m * m).sum(1))
            order = np.lexsort((i, -lengths))
            kind, data = narrow(m[order])
            return pa.RecordBatch.from_arrays([pa.array([float(lengths.max())]), pa.array([len(i)], pa.int32()), pa.array([kind]), pa.array([i[order].tobytes()], pa.binary()), pa.array([data], pa.binary())], names=["longest", "n", "kind", "ids", "m"])

        for batch in batches:
            lists, sizes = lists_of(batch.column(1))
            ids = batch.column(0).to_numpy()
            wide = 1 << np.ceil(np.log2(np.maximum(1, sizes))).astype(np.int64)
            wide = np.where(wide < shape.d, wide, max(1, shape.d))
            for w in np.unique(wide).tolist():
                own = np.flatnonzero(wide == w)
                most = max(1, min(block_rows, CELLS // w))
                held = open_.setdefault(w, ([], []))
                at = 0
                while at < len(own):
                    room = most - sum(map(len, held[0]))
                    take = own[at : at + room]
                    held[0].append(ids[take])
                    held[1].append(matrix(lists.take(pa.array(take)), sizes[take], w, scale))
                    at += room
                    if sum(map(len, held[0])) >= most:
                        yield out(*held)
                        held[0].clear()
                        held[1].clear()
        for held in open_.values():
            if held[0]:
                yield out(*held)

    packed = "longest double, n int, kind string, ids binary, m binary"
    sorted_ = vectors.repartitionByRange(blocks, F.desc("l")).sortWithinPartitions(F.desc("l")).select("id", "x")
    data = materialize(sorted_.mapInArrow(pack, packed).withColumn("block", F.monotonically_increasing_id()), "blocks")
    # One block of bounded size: the longest vectors. Its number is found without the others' vectors.
    longest = data.select("longest", "block").orderBy(F.desc(F.col("n") > k), F.desc("longest"), "block").first()
    head = data.where(F.col("block") == longest.block).first()
    queries = materialize(vectors.where(is_query(F.col("id"))).select("id", "x").repartition(blocks, F.xxhash64("id")).mapInArrow(pack, packed).withColumn("q", F.monotonically_increasing_id()), "queries")
    shared = spark.sparkContext.broadcast((rotation, np.frombuffer(head.ids, np.int64), widen(head.kind, head.m, head.n)))

    def seed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rotation, vi, v = shared.value
        for batch in batches:
            for q, n, kind, ids, m in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                qi, qm = np.frombuffer(ids, np.int64), widen(kind, m, n)
                least = np.full(len(qi), -np.inf)
                rows: dict[int, list[int]] = {}
                for place, _, score in search_block(qi, qm, least, vi, v, rotation, k, lead):
                    rows.setdefault(place, []).append(score)
                for place, scores in rows.items():
                    if len(scores) == k:
                        least[place] = scores[-1]
                norms = np.sqrt((qm * qm).sum(1))
                # The least length of a block that could still matter to a query of this one.
                need = float(np.where(least > 0, least / np.maximum(norms, 1e-300), -np.inf).min(initial=np.inf))
                yield pa.RecordBatch.from_arrays([pa.array([q]), pa.array([least.tobytes()], pa.binary()), pa.array([need])], names=["q", "least", "need"])

    seeded = materialize(queries.select("q", "n", "kind", "ids", "m").mapInArrow(seed, "q bigint, least binary, need double"), "seeds")
    # Numbers of blocks only; their vectors join last.
    wanted = seeded.select("q", "need").join(data.select("block", "longest"), F.col("longest") * (1 + 1e-9) + 1 >= F.col("need")).select("q", "block")
    asked = wanted.join(seeded.select("q", "least"), "q").join(queries.select("q", *(F.col(c).alias(f"q{c}") for c in ("n", "kind", "ids", "m"))), "q")
    pairs = asked.join(data.select("block", "n", "kind", "ids", "m"), "block").select("q", "qn", "qkind", "qids", "qm", "least", "n", "kind", "ids", "m")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rotation = shared.value[0]
        for batch in batches:
            for i in range(batch.num_rows):
                q, qn, qkind, qids, qm, least, n, kind, ids, m = (c[i].as_py() for c in batch.columns)
                qi = np.frombuffer(qids, np.int64)
                rows = search_block(qi, widen(qkind, qm, qn), np.frombuffer(least), np.frombuffer(ids, np.int64), widen(kind, m, n), rotation, k, lead)
                if rows:
                    place, vec, got = (np.array(c, np.int64) for c in zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(vec), q, np.int64)), pa.array(place), pa.array(qi[place]), pa.array(vec), pa.array(got)], names=["q", "place", "query_id", "vec_id", "score"])

    found = pairs.mapInArrow(score, "q bigint, place bigint, query_id bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("q", "place").orderBy(F.desc("score"), "vec_id")).alias("rank")
    return found.select("query_id", rank, "vec_id", "score").where(F.col("rank") <= k)
