"""Benchmark decontamination by latent semantic retrieval.

Terms are the benchmark's words. One pass over the corpus counts in how many passages
each term stands and sketches the passages' Gram matrix with random vectors; both
are sums, so tasks add up what they read. With the inverse document frequencies
the sketch gives the leading right singular vectors of the TF-IDF matrix (a
randomised SVD in Nystrom's form, which needs no second pass).

A second pass slides windows of about each item's length over every text. Windows and
items whose latent vectors have a high cosine are candidates; the longest common
subsequence of words, around the window, and that of the item's answer (its last
words) decide. The grid and the cosine miss some of what these accept, so windows at
every word that share enough of an item's rarest words, as any accepted one does, are
candidates too: no window of 1.5 times an item's length that is accepted is missed.

The benchmark is broadcast in blocks of ``block_items`` items, each with its own
pass, so what is broadcast doesn't grow with it.

Defined results: null or empty texts and items match nothing; items of fewer than
``least_words`` words must occur wholly; each item is found in its own right where
items are equal; rows of repeated documents are found each; rows without id are
reported with a null id; extra columns are dropped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, slices, split_words

MARKS = ".,;:!?\"'()[]{}<>|*#%&$-_–—…“”‘’«»¿¡"
PASSAGE = 128
STEP = 8  # words between windows' borders
ANSWER = 8  # last words of an item


def terms_of(texts: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Each word's place in the vocabulary (-1: none), lower-cased and without marks around it, and each text's first word (with the end)."""
    words, bounds = split_words(texts)
    if not len(words):
        return np.zeros(0, np.int64), bounds
    coded = words.dictionary_encode()
    found = pc.fill_null(pc.index_in(plain(coded.dictionary), value_set=vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    return found[coded.indices.to_numpy(zero_copy_only=False)], bounds


def plain(words: pa.Array) -> pa.Array:
    return pc.utf8_trim(pc.utf8_lower(words), characters=MARKS)


@dataclass
class Items:
    """A block of benchmark items in terms."""

    ids: list
    vocabulary: list[str]
    terms: list[np.ndarray]

    @classmethod
    def of(cls, rows: list) -> Items:
        words = [[w for w in plain(split_words(pa.array([r[1]], pa.string()))[0]).to_pylist() if w] for r in rows]
        vocabulary = sorted({w for x in words for w in x})
        place = {w: i for i, w in enumerate(vocabulary)}
        return cls([r[0] for r in rows], vocabulary, [np.array([place[w] for w in x], np.int64) for x in words])


PIECE = 8_192  # doubles that one task adds up from all tasks' vectors


def pieces(x: np.ndarray) -> pa.RecordBatch:
    """A vector of doubles in numbered pieces."""
    cut = [x[at : at + PIECE].tobytes() for at in range(0, len(x), PIECE)]
    return pa.RecordBatch.from_arrays([pa.array(np.arange(len(cut)), pa.int32()), pa.array(cut, pa.binary())], names=["i", "x"])


def add_up(rows: DataFrame, size: int) -> np.ndarray:
    """The sum of vectors in pieces (i, x): each piece's sum is a task's work, however many tasks there were; the driver gets one vector, which the block of items bounds."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = np.frombuffer(x.as_buffer())
                total[i] = total[i] + own if i in total else own.copy()
        yield pa.RecordBatch.from_arrays([pa.array([*total], pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["i", "x"])

    found = np.zeros(size)
    for i, x in rows.repartition(max(1, -(-size // PIECE)), "i").mapInArrow(add, "i int, x binary").collect():
        found[i * PIECE : i * PIECE + len(x) // 8] = np.frombuffer(x)
    return found


def by_radix(x: np.ndarray, most: int) -> np.ndarray:
    """A stable order; numpy sorts 16-bit integers by radix."""
    return np.argsort(x.astype(np.uint16) if most <= 65_536 else x, kind="stable")


def changes(*columns: np.ndarray) -> np.ndarray:
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def corpus_sketch(docs: DataFrame, vocabulary: list[str], omega: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """Passages, passages with each term, and A^T A omega over all passages' term weights A (1 + log of the count)."""
    v, r = omega.shape
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, omega.astype(np.float32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, probe = pa.array(shared.value[0], pa.string()), shared.value[1]
        n, df, s = 0, np.zeros(v), np.zeros((v, r))
        for batch in slices(batches, "text", 1_000_000):
            t, bounds = terms_of(batch.column(0), words)
            sizes = np.diff(bounds)
            counts = -(-sizes // PASSAGE)
            n += int(counts.sum())
            owner = np.repeat(np.arange(len(sizes)), sizes)
            p = (np.cumsum(counts) - counts)[owner] + (np.arange(len(t)) - bounds[:-1][owner]) // PASSAGE
            known = np.flatnonzero(t >= 0)
            if not len(known):
                continue
            # By term, in each by passage: the stable sort keeps the passages' order.
            order = known[by_radix(t[known], v)]
            t, p = t[order], p[order]
            starts = changes(t, p)
            a = (1 + np.log(np.diff(np.concatenate([starts, [len(t)]])))).astype(np.float32)
            t, p = t[starts], p[starts]
            df += np.bincount(t, minlength=v)
            order = by_radix(p, int(p.max()) + 1)
            heads = changes(p[order])
            y = np.zeros((int(p.max()) + 1, r), np.float32)
            y[p[order][heads]] = np.add.reduceat(a[order, None] * probe[t[order]], heads, 0)
            cuts = changes(t)
            s[t[cuts]] += np.add.reduceat(a[:, None] * y[p], cuts, 0)
        yield pieces(np.concatenate([[float(n)], df, s.ravel()]))

    total = add_up(docs.select("text").mapInArrow(run, "i int, x binary"), 1 + v + v * r)
    return int(total[0]), total[1 : 1 + v], total[1 + v :].reshape(v, r)


def latent_terms(n: int, df: np.ndarray, sketch: np.ndarray, omega: np.ndarray, rank: int) -> np.ndarray:
    """Terms' idf-weighted latent vectors (terms x rank), each direction divided by its singular value: else what all passages share would rule the cosines."""
    idf = np.maximum(np.log((n + 1) / (df + 1)), 0.05)
    # sketch = A^T A omega, and omega = D test with D = diag(idf): the TF-IDF Gram matrix D A^T A D times test is D sketch.
    test = omega / idf[:, None]
    w = idf[:, None] * sketch
    shift = 1e-8 * max(1.0, float(np.linalg.norm(w)))
    w = w + shift * test
    core = test.T @ w
    core = (core + core.T) / 2
    values, vectors = np.linalg.eigh(core)
    values = np.maximum(values, values.max(initial=1e-300) * 1e-12)
    u, roots, _ = np.linalg.svd(w @ (vectors / np.sqrt(values)), full_matrices=False)
    kept = roots[:rank] > 1e-6 * roots[:1]
    return np.ascontiguousarray(idf[:, None] * u[:, :rank][:, kept] / roots[:rank][kept] * float(roots[:1].sum()), np.float32)


def masks_of(terms: np.ndarray) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, t in enumerate(terms.tolist()):
        out[t] = out.get(t, 0) | 1 << i
    return out


def common_subsequence(masks: dict[int, int], n: int, terms: list[int]) -> int:
    """Length of the longest common subsequence, a bit for each of the item's n words."""
    full = (1 << n) - 1
    v = full
    for t in terms:
        m = masks.get(t)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


class Searcher:
    def __init__(self, items: Items, latent: np.ndarray, df: np.ndarray, cosine: float, share: float, answer: float, verbatim: float, least_words: int):
        self.items, self.latent = items, latent
        self.cosine, self.share, self.answer, self.verbatim, self.least = cosine, share, answer, verbatim, least_words
        self.words = pa.array(items.vocabulary, pa.string())
        self.padded = np.concatenate([latent, np.zeros((1, latent.shape[1]), np.float32)])  # the last row, -1, is for other words
        self.masks = [masks_of(t) for t in items.terms]
        self.answers = [masks_of(t[-ANSWER:]) for t in items.terms]
        self.groups: dict[int, list[int]] = {}
        for i, t in enumerate(items.terms):
            if len(t):
                # Few widths, each for items of about its length.
                self.groups.setdefault(int(round(1.4 ** round(np.log(max(1, len(t) / STEP)) / np.log(1.4)))), []).append(i)
        self.vectors = {}
        for width, members in self.groups.items():
            m = np.stack([latent[items.terms[i]].sum(0) for i in members])
            self.vectors[width] = m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)
        self.post(df)

    def post(self, df: np.ndarray) -> None:
        """Posts each item's rarest words. Of n words at least k must be common; then of any n - k + c words c are, here of the rarest."""
        count = len(self.items.terms)
        self.hits, self.reach = np.ones(count, np.int64), np.ones(count, np.int64)
        pairs: list[tuple[int, int]] = []
        for i, terms in enumerate(self.items.terms):
            n = len(terms)
            if n:
                k = n if n < self.least else next((k for k in range(1, n) if k / n >= self.share), n)
                self.hits[i], self.reach[i] = min(k, max(1, -(-n // 4))), n + n // 2
                pairs += [(t, i) for t in {*sorted(terms.tolist(), key=lambda t: (df[t], t))[: n - k + int(self.hits[i])]}]
        posted = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        self.posted = posted[:, 1]
        # The last row, -1, is for other words.
        self.sizes = np.bincount(posted[:, 0], minlength=len(self.items.vocabulary) + 1)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def shared_words(self, t: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(text's place, item, first and last word where a window may start) of all windows of 1.5 times an item's length that have enough of its rarest words."""
        at = np.flatnonzero(self.sizes[t])
        sizes = self.sizes[t[at]]
        total = int(sizes.sum())
        if not total:
            return
        item = self.posted[np.arange(total) + np.repeat(self.starts[t[at]] - np.cumsum(sizes) + sizes, sizes)]
        order = by_radix(item, len(self.items.terms))
        item, place = item[order], np.repeat(at, sizes)[order]
        doc = np.searchsorted(bounds, place, side="right") - 1
        last = np.arange(total) + self.hits[item] - 1
        to = np.minimum(last, total - 1)
        found = np.flatnonzero((last < total) & (item[to] == item) & (doc[to] == doc) & (place[to] - place < self.reach[item]))
        if not len(found):
            return
        item, doc, stop = item[found], doc[found], place[found]
        begin = np.maximum(bounds[doc], place[to[found]] - self.reach[item] + 1)
        heads = np.flatnonzero(np.concatenate([[True], (item[1:] != item[:-1]) | (doc[1:] != doc[:-1]) | (begin[1:] > stop[:-1] + 1)]))
        ends = np.concatenate([heads[1:], [len(found)]]) - 1
        yield from zip(doc[heads].tolist(), item[heads].tolist(), begin[heads].tolist(), stop[ends].tolist(), strict=True)

    def shared_by_part(self, t: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """``shared_words`` of some texts at a time, to hold little in memory; a longer text stands alone."""
        lo = 0
        while lo < len(bounds) - 1:
            base = int(bounds[lo])
            hi = max(lo + 1, int(np.searchsorted(bounds, base + 16_384, side="right")) - 1)
            for doc, item, begin, stop in self.shared_words(t[base : int(bounds[hi])], bounds[lo : hi + 1] - base):
                yield doc + lo, item, begin + base, stop + base
            lo = hi

    def by_words(self, t: np.ndarray, bounds: np.ndarray, best: dict) -> None:
        """Adds all texts and items, of those that aren't found yet, that have a window on which ``judge`` agrees."""
        known = set(best)
        for doc, item, begin, stop in self.shared_by_part(t, bounds):
            if (doc, item) in known:
                continue
            reach, masks, n = int(self.reach[item]), self.masks[item], len(self.items.terms[item])
            least = 1 if n < self.least else self.share
            for piece in range(begin, stop + 1, reach):
                words = t[piece : min(int(bounds[doc + 1]), piece + 2 * reach)].tolist()
                if common_subsequence(masks, n, words) / n < least:
                    continue
                # A window may as well start at its first common word.
                for i in range(min(reach, stop + 1 - piece)):
                    if words[i] in masks and (found := self.judge(item, words[i : i + reach])):
                        before = best.get((doc, item))
                        if not before or found > before[:2]:
                            window, own = (self.padded[x].sum(0) for x in (words[i : i + reach], self.items.terms[item]))
                            near = float(window @ own / max(1e-12, float(np.linalg.norm(window) * np.linalg.norm(own))))
                            best[doc, item] = (*found, near, piece + i - int(bounds[doc]))
                        if found[0] >= 0.95:
                            break

    def judge(self, item: int, terms: list[int]) -> tuple[float, float] | None:
        n = len(self.items.terms[item])
        share = common_subsequence(self.masks[item], n, terms) / n
        if n < self.least:
            return (share, share) if share == 1 else None
        if share < self.share:
            return None
        answer = common_subsequence(self.answers[item], min(n, ANSWER), terms) / min(n, ANSWER)
        return (share, answer) if answer >= self.answer or share >= self.verbatim else None

    def search(self, texts: pa.Array) -> list[tuple[int, int, float, float, float, int]]:
        """(text's place, item's place, share, answer's share, cosine, first word) of the best match of each text and item."""
        t, bounds = terms_of(texts, self.words)
        if not (t >= 0).any():
            return []
        sizes = np.diff(bounds)
        blocks = -(-sizes // STEP)
        first = np.concatenate([[0], np.cumsum(blocks)])
        owner = np.repeat(np.arange(len(sizes)), sizes)
        block = first[:-1][owner] + (np.arange(len(t)) - bounds[:-1][owner]) // STEP
        # Other words add nothing, so only the items' are looked up.
        known = np.flatnonzero(t >= 0)
        heads = changes(block[known])
        each = np.zeros((int(first[-1]), self.latent.shape[1]), np.float32)
        each[block[known][heads]] = np.add.reduceat(self.latent[t[known]], heads, 0)
        sums = np.zeros((len(each) + 1, each.shape[1]), np.float64)
        np.cumsum(each, 0, out=sums[1:])
        whose = np.repeat(np.arange(len(sizes)), blocks)
        place = np.arange(len(whose)) - first[:-1][whose]
        best: dict[tuple[int, int], tuple[float, float, float, int]] = {}
        for width, members in self.groups.items():
            last = np.maximum(0, blocks[whose] - width)
            starts = np.flatnonzero((place <= last) & ((place % max(1, width // 4) == 0) | (place == last)))
            ends = np.minimum(starts + width, first[1:][whose[starts]])
            for at in range(0, len(starts), 4_096):
                windows = (sums[ends[at : at + 4_096]] - sums[starts[at : at + 4_096]]).astype(np.float32)
                near = windows @ self.vectors[width].T
                reach = self.cosine * np.sqrt(np.einsum("ij,ij->i", windows, windows))
                hits = np.flatnonzero(near.max(1) >= reach)
                near = near[hits] / np.maximum(reach[hits, None] / self.cosine, 1e-12)
                for h, m in np.argwhere(near >= self.cosine).tolist():
                    w = int(hits[h])
                    doc, item = int(whose[starts[at + w]]), members[m]
                    known = best.get((doc, item))
                    if known and known[0] >= 0.95:
                        continue
                    margin = len(self.items.terms[item]) // 4 + STEP
                    begin = max(int(bounds[doc]), int(bounds[doc] + place[starts[at + w]] * STEP - margin))
                    region = t[begin : min(int(bounds[doc + 1]), begin + width * STEP + 2 * margin)].tolist()
                    found = self.judge(item, region)
                    if found and (not known or found > known[:2]):
                        best[doc, item] = (*found, float(near[h, m]), begin - int(bounds[doc]))
        self.by_words(t, bounds, best)
        return [(d, i, *x) for (d, i), x in sorted(best.items())]


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", rank: int = 48, probes: int = 56, cosine: float = 0.65, share: float = 0.6, answer: float = 0.5, verbatim: float = 0.8, least_words: int = 8, block_items: int = 2_000) -> DataFrame:
    """(id, item, share, answer_share, cosine, first_word): documents with a passage of an item, and where it is (in words)."""
    spark = bound_batches(docs).sparkSession
    kinds = dict(docs.dtypes)[id_col], dict(benchmark.dtypes)[item_col]
    schema = f"id {kinds[0]}, item {kinds[1]}, share double, answer_share double, cosine double, first_word bigint"
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found, block = None, []
    listed = benchmark.select(F.col(item_col).alias("id"), F.coalesce(F.col(item_text), F.lit("")).alias("text")).orderBy("id", "text")

    def look(rows: list) -> DataFrame:
        items = Items.of(rows)
        if not items.vocabulary:
            return spark.createDataFrame([], schema)
        omega = np.random.default_rng(7).normal(size=(len(items.vocabulary), probes))
        n, df, sketch = corpus_sketch(docs, items.vocabulary, omega)
        latent = latent_terms(n, df, sketch, omega, rank)
        shared = spark.sparkContext.broadcast(Searcher(items, latent, df, cosine, share, answer, verbatim, least_words))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text", 1_000_000):
                rows = shared.value.search(batch.column(1))
                if rows:
                    doc, item, *rest = zip(*rows, strict=True)
                    names = shared.value.items.ids
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc)), pa.array([names[i] for i in item]), *(pa.array(c, pa.float64()) for c in rest[:3]), pa.array(rest[3], pa.int64())], names=["id", "item", "share", "answer_share", "cosine", "first_word"])

        return docs.mapInArrow(run, schema)

    for row in listed.toLocalIterator():  # a block at a time on the driver
        block.append(row)
        if len(block) == block_items:
            found, block = (look(block) if found is None else found.unionByName(look(block))), []
    if block or found is None:
        found = look(block) if found is None else found.unionByName(look(block))
    return found.withColumnsRenamed({"id": id_col, "item": item_col})
