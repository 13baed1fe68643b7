"""N-gram Jaccard self-join with PartEnum signatures, down to connected components.

A document's set has its distinct word shingles, hashed to 64 bits. Sizes fall in
bands of ratio 1/threshold; a set has the tags of its own band and of the next, so
that similar sets have one in common. Similar sets of a tag differ in at most k
elements, k following from the tag's largest size.

Signatures: a tag cuts the hash domain into first partitions, each into three second
ones, and enumerates the subsets of two of these three. A signature is what a set has
in such a subset, unless that is empty. A difference spoils one second partition, so
two are needed to spoil all signatures of a first partition with elements in two or
three of its parts, one where they are in one part. Where these needs add up to more
than k for a set, it shares a signature with each similar set. Sets for which they
don't (few) have their elements of smallest hash as signatures besides, as many as
the prefix filter asks for, so that two such sets share one of these.

The carriers of one signature are candidates. Signatures with the same carriers
are one group. First each carrier is linked with the smallest one (a star). Each document
keeps a parity sketch: an element flips one of about 2n bits, so the bits in which
two sketches differ are a lower bound of the sets' difference, and most false
candidates end there. The rest is verified exactly on the sets; then pairs of one
group that still lie in different components are verified too: by stars around other
centres, at last each such pair. Nothing is capped.

Skew: equal sets are one class, of which a task's first alone has signatures; a
signature carried by many documents of one slice of text is sent on once from
there; joins on groups have one row a group on one side, but for the last round's.

Defined results: null or empty texts, and texts of white space, have an empty set
and are linked with nothing; a null id takes no part in links and is its own
component (null); rows with an id that occurs more than once: one row each, each
compared by its own text, linked as one vertex; extra columns are dropped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, discard, materialize, mix64, release_memory, slices, split_words, word_hashes
from .graph import components

WORDS = 16  # of 64 bits in the shortest sketch, to which all can be folded
LOCAL_HOT = 16  # a signature of so many documents in one slice is forwarded once
WEIGHTS = mix64(np.arange(1, 65, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)  # with no sums in common


def shingle_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text (A-Z lower-cased)."""
    import pyarrow.compute as pc

    words, bounds = split_words(pc.ascii_lower(pc.fill_null(texts, "")))
    h = word_hashes(words)
    total = max(0, len(h) - n + 1)
    rolled = np.zeros(total, np.uint64)
    for j in range(n):
        rolled += h[j : j + total] * WEIGHTS[j]
    rolled = mix64(rolled)
    out = []
    for b, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if e - b >= n:
            s = np.sort(rolled[b : e - n + 1])
            if len(s) > 1:
                s = s[np.concatenate([[True], s[1:] != s[:-1]])]
        elif e > b:  # the whole sequence, with its length in the hash
            s = mix64((h[b:e] * WEIGHTS[: e - b]).sum(dtype=np.uint64, keepdims=True) + WEIGHTS[63:] * np.array([e - b], np.uint64))
        else:
            s = np.zeros(0, np.uint64)
        out.append(s)
    return out


def bands(threshold: float, to: int) -> list[tuple[int, int]]:
    """[(smallest, largest size)] up to a band that holds ``to``."""
    out, low = [], 1
    while not out or out[-1][1] < to:
        high = max(low, int(low / threshold + 1e-9))
        out.append((low, high))
        low = high + 1
    return out


def first_partitions(k: np.ndarray) -> np.ndarray:
    """So many that what spoils a set's signatures is seldom within ``k`` differences: nearly two a partition, and some for partitions with few elements."""
    return np.ceil(0.5 * (k + 1) + 0.2 * np.sqrt(k)).astype(np.int64)


def signatures(sets: list[np.ndarray], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(signature, place of the set) of all sets: similar sets share one."""
    sizes = np.array([len(s) for s in sets], np.int64)
    if not sizes.sum():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    table = bands(threshold, int(sizes.max()))
    table += [(table[-1][1] + 1, int((table[-1][1] + 1) / threshold + 1e-9))]
    highs = np.array([h for _, h in table], np.int64)
    band = np.searchsorted(highs, sizes)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    mixed = mix64(flat + np.uint64(0x51ED270B))
    spoil = (1 - threshold) / (1 + threshold)
    partner = np.floor(sizes / threshold + 1e-9).astype(np.int64)
    out, wanting = [], np.zeros(len(sets), bool)
    for up in (0, 1):
        tag = band + up
        high = highs[tag]
        firsts = first_partitions(np.floor(2 * high * spoil + 1e-9))
        part = (((flat >> np.uint64(32)) * (3 * firsts).astype(np.uint64)[owner]) >> np.uint64(32)).astype(np.int64)  # ascends within a set
        starts = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (part[1:] != part[:-1])]))
        whose, part = owner[starts], part[starts]
        first = part // 3
        heads = np.concatenate([[True], (whose[1:] != whose[:-1]) | (first[1:] != first[:-1])])
        row = np.cumsum(heads) - 1
        content = np.zeros((int(row[-1]) + 1, 3), np.uint64)
        content[row, part - 3 * first] = np.add.reduceat(mixed, starts)
        parts = np.bincount(row)
        whose, first = whose[heads], first[heads]
        # What one part's absence leaves; nothing, where all elements are in that part.
        left = content.sum(1, keepdims=True) - content
        some = (parts[:, None] > 1) | (content == 0)
        salt = mix64(first.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + tag[whose].astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
        out.append((mix64(left + salt[:, None] + np.arange(3, dtype=np.uint64) * np.uint64(0x8CB92BA72F3D8DD7))[some], np.repeat(whose, 3).reshape(-1, 3)[some]))
        k = np.floor((sizes + np.minimum(partner, high)) * spoil + 1e-9)
        wanting |= (sizes > 0) & (np.bincount(whose, np.minimum(parts, 2), len(sets)) <= k)
    ends = np.cumsum(sizes)
    for i in np.flatnonzero(wanting).tolist():
        own = np.sort(mixed[ends[i] - sizes[i] : ends[i]])
        prefix = own[: len(own) - math.ceil(len(own) * threshold - 1e-9) + 1]
        out.append((mix64(prefix), np.full(len(prefix), i)))
    return np.concatenate([x for x, _ in out]), np.concatenate([x for _, x in out])


def set_key(s: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(s.tobytes())


def packed(rows: np.ndarray, hot: np.ndarray) -> bytes:
    """The smallest row, then four bytes a row and mark where the range allows it."""
    low = rows.min()
    if int(rows.max()) - int(low) < 2**31:
        return low.tobytes() + ((rows - low) << 1 | hot).astype(np.uint32).tobytes()
    return low.tobytes() + rows.tobytes() + hot.astype(np.uint8).tobytes()


def unpacked(data, n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(data) == 8 + 4 * n:
        both = np.frombuffer(data, np.uint32, offset=8).astype(np.int64)
        return (both >> 1) + np.frombuffer(data, np.int64, 1)[0], (both & 1).astype(bool)
    return np.frombuffer(data, np.int64, n, 8), np.frombuffer(data, np.uint8, offset=8 + 8 * n).astype(bool)


def short(sigs: np.ndarray) -> bytes:
    """The lower six bytes of each; the bucket tells most of the rest."""
    return sigs.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def long(data, bucket: int) -> np.ndarray:
    """A bucket's signatures again, as numbers of six bytes and the bucket above."""
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<i8").reshape(-1) | (np.int64(bucket) << np.int64(48))


def number(sigs: np.ndarray, buckets: int) -> np.ndarray:
    """What long() makes of the signatures."""
    bucket = ((sigs >> np.uint64(48)) * np.uint64(buckets)) >> np.uint64(16)
    return ((sigs & np.uint64(2**48 - 1)) | (bucket << np.uint64(48))).view(np.int64)


def sketch(s: np.ndarray) -> bytes:
    """Parities of the elements that fall on each of 2 ** j >= 2n bits, 64 * WORDS at least."""
    bits = max(64 * WORDS, 1 << (2 * len(s) - 1).bit_length()) if len(s) else 64 * WORDS
    places = (mix64(s ^ np.uint64(0x2545F491)) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(places, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def difference_at_least(a, b) -> int:
    """A lower bound of the sets' symmetric difference; the longer sketch is folded, as its places agree modulo the shorter's."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) < len(y):
        x, y = y, x
    if len(x) > len(y):
        x = np.bitwise_xor.reduce(x.reshape(-1, len(y)), 0)
    return int(np.bitwise_count(x ^ y).sum())


def _sets(docs: DataFrame, n: int) -> DataFrame:
    """(key, the set itself) of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = shingle_sets(batch.column(0), n)
            yield pa.RecordBatch.from_arrays([pa.array([set_key(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["key", "data"])

    return docs.select("text").mapInArrow(run, "key binary, data binary")


def _folded(sketches: DataFrame) -> DataFrame:
    """(row, n, w0, w1, ...): each sketch folded to WORDS 64-bit words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = np.stack([np.bitwise_xor.reduce(np.frombuffer(x.as_buffer(), np.int64).reshape(-1, WORDS), 0) for x in batch.column(2)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(words[:, i]) for i in range(WORDS))], names=["row", "n", *(f"w{i}" for i in range(WORDS))])

    return sketches.mapInArrow(run, "row bigint, n bigint, " + ", ".join(f"w{i} bigint" for i in range(WORDS)))


ROW = {"bucket": ("int", pa.int32()), "gid": ("bigint", pa.int64()), "row": ("bigint", pa.int64()), "id": ("bigint", pa.int64()), "sigs": ("binary", pa.binary()), "rows": ("binary", pa.binary()), "n": ("bigint", pa.int64()), "key": ("binary", pa.binary()), "data": ("binary", pa.binary())}


def _rows(names: list[str], **columns) -> pa.RecordBatch:
    size = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([columns[c] if isinstance(columns.get(c), pa.Array) else pa.array(columns[c], ROW[c][1]) if c in columns else pa.nulls(size, ROW[c][1]) for c in names], names=names)


def _groups(sig: np.ndarray, row: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(group, row) of signatures that several rows carry; those with the same carriers are one group. A signature that slices have sent to the result by itself is its own group."""
    order = np.argsort(sig)
    sig, row, hot = sig[order], row[order], hot[order]
    del order
    starts = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
    sizes = np.diff(np.concatenate([starts, [len(sig)]]))
    direct = np.logical_or.reduceat(hot, starts)
    carriers = mix64(np.add.reduceat(mix64(row.view(np.uint64) + np.uint64(0x2545F491)), starts) + sizes.astype(np.uint64)).view(np.int64)
    gid = np.where(direct, sig[starts], carriers)
    kept = np.flatnonzero((sizes > 1) | direct)
    kept = kept[np.unique(gid[kept], return_index=True)[1]]
    ends = np.cumsum(sizes[kept])
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(gid[kept], sizes[kept]), row[np.arange(total) + np.repeat(starts[kept] - ends + sizes[kept], sizes[kept])]


def _gathered(docs: DataFrame, n: int, threshold: float) -> DataFrame:
    """Two kinds of rows: (gid, row) of groups of rows that carry one signature, and (row, id, n, key, data) of each row."""
    # A bucket is a partition. A task holds its signatures in memory, so there are twice the usual number of them.
    buckets = min(2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 32_768)
    result = ["gid", "row", "id", "n", "key", "data"]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in slices(batches, "text", 4_000_000):
            sets = shingle_sets(batch.column(2), n)
            keys = [set_key(s) if len(s) else None for s in sets]
            yield _rows([*ROW], row=batch.column(0), id=batch.column(1), n=[len(s) for s in sets], key=keys, data=[sketch(s) for s in sets])
            rows = batch.column(0).to_numpy()
            known = batch.column(1).is_valid().to_pylist()
            for i, key in enumerate(keys):
                if key is not None:
                    if key in seen or not known[i]:
                        sets[i] = sets[i][:0]
                    elif len(seen) < 500_000:
                        seen.add(key)
            sig, owner = signatures(sets, threshold)
            if not len(sig):
                continue
            order = np.argsort(sig)
            sig, owner = sig[order], owner[order]
            starts = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
            counts = np.diff(np.concatenate([starts, [len(sig)]]))
            hot = np.repeat(counts >= LOCAL_HOT, counts)
            if hot.any():  # known to be carried by several: straight to the result, and one goes on to meet other slices
                yield _rows([*ROW], sigs=[number(sig[hot], buckets).tobytes()], rows=[packed(rows[owner[hot]], hot[hot])])
                kept = ~hot
                kept[starts[counts >= LOCAL_HOT]] = True
                sig, owner, hot = sig[kept], owner[kept], hot[kept]
            bucket = (((sig >> np.uint64(48)) * np.uint64(buckets)) >> np.uint64(16)).astype(np.int64)  # ascends with the signature
            cut = np.searchsorted(bucket, np.arange(buckets + 1))
            spans = [(b, i, j) for b, (i, j) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)) if j > i]
            yield _rows([*ROW], bucket=[b for b, _, _ in spans], sigs=[short(sig[i:j]) for _, i, j in spans], rows=[packed(rows[owner[i:j]], hot[i:j]) for _, i, j in spans])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sigs, rows, marks = [], [], []
        for batch in batches:
            if batch.column("bucket").null_count:
                direct = batch.filter(batch.column("bucket").is_null())
                documents = direct.filter(direct.column("sigs").is_null())
                yield pa.RecordBatch.from_arrays([documents.column(c) for c in result], names=result)
                for a, b in zip(direct.column("sigs"), direct.column("rows"), strict=True):
                    if a.is_valid:
                        sig = np.frombuffer(a.as_buffer(), np.int64)
                        yield _rows(result, gid=sig, row=unpacked(b.as_buffer(), len(sig))[0])
            for k, a, b in zip(batch.column("bucket").to_pylist(), batch.column("sigs"), batch.column("rows"), strict=True):
                if k is not None:
                    sigs.append(long(a.as_buffer(), k))
                    who, hot = unpacked(b.as_buffer(), len(sigs[-1]))
                    rows.append(who)
                    marks.append(hot)
        if not sigs:
            return
        found = _groups(np.concatenate(sigs), np.concatenate(rows), np.concatenate(marks))
        sigs.clear(), rows.clear(), marks.clear()
        for i in range(0, len(found[0]), 100_000):
            yield _rows(result, gid=found[0][i : i + 100_000], row=found[1][i : i + 100_000])
        del found
        release_memory()

    sent = docs.mapInArrow(emit, ", ".join(f"{c} {t}" for c, (t, _) in ROW.items()))
    # Rows without a bucket go anywhere.
    dealt = sent.repartitionById(buckets, F.coalesce(F.col("bucket"), F.pmod(F.xxhash64("sigs", "row"), F.lit(buckets)).cast("int")))
    return dealt.mapInArrow(meet, ", ".join(f"{c} {ROW[c][0]}" for c in result))


def _links(docs: DataFrame, named: DataFrame, pairs: DataFrame, n: int, threshold: float) -> DataFrame:
    """(u, v) of candidate pairs of rows that are linked: by sketches, then by exact intersection."""
    num, den = round(threshold * 100), 100

    def both(pairs: DataFrame, u: str, v: str, data: DataFrame, by: str, *more: str) -> DataFrame:
        """The pairs with what ``data`` has of both sides."""
        sides = [data.select(F.col(by).alias(side), *(F.col(c).alias(c + end) for c in more)) for side, end in ((u, "u"), (v, "v"))]
        return pairs.join(sides[0], u).join(sides[1], v)

    def may(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nu, nv = (batch.column(i).to_numpy() for i in (2, 3))
            # inter = (nu + nv - d) / 2 and union = (nu + nv + d) / 2 with the symmetric difference d
            most = (nu + nv) * (den - num) // (den + num)
            keep = np.abs(nu - nv) <= most
            for i in np.flatnonzero(keep):
                keep[i] = difference_at_least(batch.column(4)[i].as_buffer(), batch.column(5)[i].as_buffer()) <= most[i]
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(keep)) for i in (0, 1)], names=["u", "v"])

    likely = materialize(both(pairs, "u", "v", named, "row", "n", "data").select("u", "v", "nu", "nv", "datau", "datav").mapInArrow(may, "u bigint, v bigint"), "likely")
    # Written, so that the planner knows its size: ids of few documents are broadcast, and the texts stay where they are.
    needed = materialize(named.join(likely.select(F.explode(F.array("u", "v")).alias("row")).distinct(), "row").select("row", "id", "key"), "needed")
    texts = docs.join(needed.select("id").distinct(), "id", "left_semi")
    sets = materialize(_sets(texts, n).join(needed.select("key").distinct(), "key", "left_semi").groupBy("key").agg(F.first("data").alias("data")), "sets")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for a, b in zip(batch.column(2), batch.column(3), strict=True):
                joined = np.concatenate([np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)])
                joined.sort()
                common = int((joined[1:] == joined[:-1]).sum())
                linked.append(common > 0 and den * common >= num * (len(joined) - common))
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(linked, pa.bool_())) for i in (0, 1)], names=["u", "v"])

    keyed = both(likely, "u", "v", needed, "row", "key")
    linked = materialize(both(keyed, "keyu", "keyv", sets, "key", "data").select("u", "v", "datau", "datav").mapInArrow(exact, "u bigint, v bigint"), "linked")
    discard(likely, needed, sets)
    return linked


def jaccard_components(docs: DataFrame, n: int = 5, threshold: float = 0.75, id_col: str = "doc_id", text_col: str = "text", stars: int = 2) -> DataFrame:
    """(id, n_shingles, component_id) of each row; linked if intersection / union >= threshold (in hundredths).

    ``stars``: how many rounds join only star candidates before all pairs of a
    group that lie in different components are verified.
    """
    docs = bound_batches(docs).select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    gathered = materialize(_gathered(docs, n, threshold), "gathered")
    info = gathered.where("gid IS NULL").select("row", "id", "n", "key", "data")
    named = info.where("id IS NOT NULL AND key IS NOT NULL")

    def stars_of(rows: DataFrame, by: str) -> DataFrame:
        """Links of all rows that are alike in a column with the first of them."""
        # Written, so that the join stands apart from the count and may be split where one value is carried by very many rows.
        several = materialize(rows.groupBy(by).agg(F.min("row").alias("u"), F.max("row").alias("last")).where("u < last").select(by, "u"), "several")
        alike = materialize(rows.join(several, by).where("row <> u").select("u", F.col("row").alias("v")), "alike")
        discard(several)
        return alike

    # Equal sets are one class, named by its first row; candidates are sought between classes only.
    same = stars_of(named.select("row", "key"), "key")
    groups = gathered.where("gid IS NOT NULL").select("gid", "row").join(same.select(F.col("v").alias("row"), "u"), "row", "left")
    members = materialize(groups.select("gid", F.coalesce("u", "row").alias("row")).distinct(), "members")
    links = same.unionByName(stars_of(info.where("id IS NOT NULL").select("row", "id"), "id"))
    checked, found, done = None, components(links), [members]
    for turn in range(stars + 1):
        placed = members.join(found.select(F.col("v").alias("row"), "root"), "row", "left").select("gid", "row", F.coalesce("root", "row").alias("c"))
        centre = F.struct(F.xxhash64(F.lit(turn), "row").alias("o"), "row", "c") if turn else F.struct("row", "c")
        spread = placed.groupBy("gid").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.min(centre).alias("x")).where("low < high")
        if turn < stars:
            pairs = placed.join(spread.select("gid", F.col("x.row").alias("rowx"), F.col("x.c").alias("cx")), "gid").where("c <> cx")
        else:
            # The sketches are compared in the join's condition, so that of a group only likely pairs leave the join.
            open_ = materialize(placed.join(spread.select("gid"), "gid"), "open")
            shown = materialize(_folded(named.join(open_.select("row").distinct(), "row", "left_semi").select("row", "n", "data")), "folded")
            open_ = open_.join(shown, "row")
            other = open_.select("gid", *(F.col(c).alias(f"{c}x") for c in open_.columns if c != "gid"))
            num = round(threshold * 100)
            differ = sum((F.bit_count(F.col(f"w{i}").bitwiseXOR(F.col(f"w{i}x"))) for i in range(1, WORDS)), F.bit_count(F.col("w0").bitwiseXOR(F.col("w0x"))))
            near = (F.greatest(F.abs(F.col("n") - F.col("nx")), differ) * (100 + num) <= (F.col("n") + F.col("nx")) * (100 - num))
            pairs = open_.join(other, (open_["gid"] == other["gid"]) & (F.col("c") < F.col("cx")) & near)
        pairs = pairs.select(F.least("row", "rowx").alias("u"), F.greatest("row", "rowx").alias("v")).distinct()
        if checked is not None:
            pairs = pairs.join(checked, ["u", "v"], "left_anti")
        pairs = materialize(pairs, "pairs")
        done.append(pairs)
        if not pairs.isEmpty():
            fresh = _links(docs, named, pairs, n, threshold)
            checked = pairs if checked is None else checked.unionByName(pairs)
            if not fresh.isEmpty():
                links = links.unionByName(fresh)
                found = components(links)
    discard(*done)
    placed = info.select("row", "id", "n").join(found.select(F.col("v").alias("row"), "root"), "row", "left")
    least = placed.where("root IS NOT NULL").groupBy("root").agg(F.min("id").alias("least"))
    return placed.join(least, "root", "left").select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("least", "id").alias("component_id"))
