"""BPE encoding by backtracking over longest token matches, and decoding by an offset table.

A piece of text is encoded without replaying merges: an Aho-Corasick automaton
gives the longest token at each place, a token is accepted after another only if
the two are compatible (no merge of lower rank could have joined across their
border), and a dead end takes back one token. Each place is given up at most
once, so the work is linear in the piece's length. The result equals the ranked
merges exactly.

The tokenizer file fixes normalisation (NFC, lower case by character), the piece
pattern, byte symbols and the end-of-word suffix; other layouts are refused.

Defined results: a null or empty text has no tokens and decodes to the empty
text; special tokens written in a text become their ids; repeated rows are
encoded each on its own; extra columns are dropped.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import bound_batches, raw, resident, slices, split_words

MAX_FILE_MB = 64  # what may be broadcast: tokenizer files are a few MB and don't grow with the data
FINAL = 0xE000  # a word's last symbol stands in this private range


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if printable, else the next free one from 256 on."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(kept)]
    return [chr(b) if b in set(kept) else chr(256 + rest.index(b)) for b in range(256)]


def offset_table(spelled: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All spellings one after the other, and where each begins (with the end)."""
    data = [x.encode() for x in spelled]
    return np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in data])]).astype(np.int64)


class Vocabulary:
    """Tokens in rank order: base symbols, then merge results; ``ids`` has the file's id of each rank."""

    def __init__(self, text: str):
        import ahocorasick

        spec = json.loads(text)
        model = spec["model"]
        suffix = model.get("end_of_word_suffix") or ""
        if not suffix:
            raise ValueError("this tokenizer's layout is not supported")
        vocab = model["vocab"]
        self.symbols = byte_symbols()
        names = {c: c for c in self.symbols} | {c + suffix: chr(FINAL + ord(c)) for c in self.symbols}
        self.text_of = [*names.values()]  # by rank, in the alphabet of symbols
        self.ids = [vocab[x] for x in names]
        self.split = [(i, i) for i in range(len(names))]
        rank = {x: i for i, x in enumerate(names)}
        self.pair: dict[tuple[int, int], int] = {}
        for m in model["merges"]:
            a, b = (m if isinstance(m, list) else m.split(" "))
            left, right, new = rank[a], rank[b], len(self.ids)
            if a + b in rank:
                raise ValueError(f"token {a + b!r} is made by two merges")
            rank[a + b] = new
            self.pair[left, right] = new
            self.split.append((left, right))
            self.text_of.append(self.text_of[left] + self.text_of[right])
            self.ids.append(vocab[a + b])
        self.lengths = [len(x) for x in self.text_of]
        self.automaton = ahocorasick.Automaton()
        by_text = {}
        for i, x in enumerate(self.text_of):
            self.automaton.add_word(x, i)
            by_text[x] = i
        self.automaton.make_automaton()
        self.prefix = [-1] * len(self.ids)  # the longest token that is a proper prefix
        for i, x in enumerate(self.text_of):
            for n in range(len(x) - 1, 0, -1):
                if (j := by_text.get(x[:n])) is not None:
                    self.prefix[i] = j
                    break
        self.special = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
        self.compatible: dict[tuple[int, int], bool] = {}
        names = {i: x for x, i in vocab.items()} | {i: x for x, i in self.special.items()}
        self.blob, self.offsets = offset_table([names.get(i, "") + " " for i in range(max(names) + 1)])
        self.decimal = offset_table([f"{i} " for i in range(max(names) + 1)])

    def fits(self, left: int, right: int) -> bool:
        """Whether the ranked merges of left's and right's symbols together leave just these two tokens."""
        known = self.compatible.get((left, right))
        if known is None:
            if len(self.compatible) >= 250_000:
                self.compatible.clear()
            known = self.compatible[left, right] = self._fits(left, right)
        return known

    def _fits(self, a: int, b: int) -> bool:
        # Undo the later of the two merges again and again; a pair at the border that merges before that undone merge breaks both.
        base, before = 2 * len(self.symbols), len(self.ids)
        while True:
            joined = self.pair.get((a, b))
            if joined is not None and joined < before:
                return False
            if a < base and b < base:
                return True
            if a > b:
                before, a = a, self.split[a][1]
            else:
                # Of equal tokens, or of pairs of one rank, the left is merged first.
                before, b = b + 1, self.split[b][0]

    def encode(self, word: str) -> list[int]:
        """Token ids of one piece, given in byte symbols without the end mark."""
        word = word[:-1] + chr(FINAL + ord(word[-1]))
        n, lengths, prefix = len(word), self.lengths, self.prefix
        longest = [-1] * n
        for end, token in self.automaton.iter(word):
            longest[end + 1 - lengths[token]] = token  # ends ascend, so the longest stays
        out: list[int] = []
        alive = bytearray(b"\1") * (n + 1)
        at, token = 0, longest[0]
        while True:
            last = out[-1] if out else -1
            end = at + lengths[token]
            if alive[end] and (last < 0 or self.fits(last, token)):
                out.append(token)
                at = end
                if at == n:
                    ids = self.ids
                    return [ids[t] for t in out]
                token = longest[at]
            elif prefix[token] >= 0:
                token = prefix[token]
            else:
                alive[at] = 0
                token = out.pop()
                at -= lengths[token]
                # The place after this token is dead, so the next turn goes on to its prefixes.

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens' texts, each with a space after it."""
        starts = self.offsets[ids]
        sizes = self.offsets[ids + 1] - starts
        ends = np.cumsum(sizes)
        places = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)
        return self.blob[places].tobytes()


def id_width(spec: dict, *more: int) -> str:
    """The narrowest little-endian type that holds all of the tokenizer's ids, and ``more``."""
    top = max([*more, *spec["model"]["vocab"].values(), *(x["id"] for x in spec.get("added_tokens", []))])
    return "<u2" if top < 65_536 else "<u4"


def strings(data: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Strings or binaries of these bytes; a batch of more than 2 GB is refused."""
    if bounds[-1] >= 2**31:
        raise ValueError("a single text is too long to be encoded")
    return pa.Array.from_buffers(kind, len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def ragged(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places starts[i], ..., starts[i] + sizes[i] - 1 of all i, one after the other, and where each i ends among them."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if total < 2**31 and int(starts.max(initial=0)) + int(sizes.max(initial=0)) < 2**31 else np.int64
    return np.arange(total, dtype=kind) + np.repeat((starts - ends + sizes).astype(kind), sizes), ends


MARKS = b".,!?:;"  # one of these behind a word is encoded apart from it
IS_MARK, IS_ALNUM = np.zeros(256, bool), np.zeros(256, bool)
IS_MARK[[*MARKS]] = True
IS_ALNUM[[*b"0123456789abcdefghijklmnopqrstuvwxyz"]] = True


def stems(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words in lower case, without one mark behind a letter or digit, and that mark's byte (0: none). Words with characters beyond U+024F, or with one whose lower case isn't one character, stay as they are."""
    data, at = raw(words)
    beyond = data >= 0xCA
    beyond[:-1] |= (data[:-1] == 0xC9) & (data[1:] >= 0x90) | (data[:-1] == 0xC4) & (data[1:] == 0xB0)
    odd = np.logical_or.reduceat(beyond, at[:-1])
    low = pc.utf8_lower(words)
    data, at = raw(pc.if_else(pa.array(odd), words, low) if odd.any() else low)
    last, sizes = at[1:] - 1, np.diff(at)
    before, lead = data[np.maximum(last - 1, 0)], data[np.maximum(last - 2, 0)]
    letter = IS_ALNUM[before] | ((before >= 0x80) & (sizes > 2) & (lead >= 0xC3) & (lead <= 0xC9) & ~((lead == 0xC3) & ((before == 0x97) | (before == 0xB7))))
    cut = IS_MARK[data[last]] & (sizes > 1) & letter & ~odd
    marks = np.where(cut, data[last], 0)
    kept = np.ones(len(data), bool)
    kept[last[cut]] = False
    return strings(data[kept], at - np.concatenate([[0], np.cumsum(cut)]), pa.string()), marks


class ChunkEncoder:
    """Encodes the distinct words between white space of a batch of texts.

    Words it has met are kept in an Arrow array with their ids in another, since a
    Python dict of so many costs more than the rest. When full, the older half goes,
    so its memory is bounded. Subclasses say how a piece in byte symbols becomes ids.
    """

    MOST_BYTES = 64_000_000

    def __init__(self, spec: dict, most: int = 1_000_000):
        import regex
        from tokenizers import Regex, normalizers, pre_tokenizers

        kinds = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        pieces = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        if spec["model"]["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or [x.get("type") for x in pieces] != ["Split", "ByteLevel"] or spec.get("decoder") or spec.get("post_processor"):
            raise ValueError("this tokenizer's layout is not supported")
        pattern = pieces[0]["pattern"]["Regex"]
        self.most, self.width = most, id_width(spec)
        self.size, self.format = int(self.width[2]), "<%d" + {"<u2": "H", "<u4": "I"}[self.width]
        self.packers = [struct.Struct(self.format % n).pack for n in range(16)]
        self.known, self.ids, self.bounds = pa.array([], pa.string()), np.zeros(0, self.width), np.zeros(1, np.int64)
        self.pieces = regex.compile(pattern).findall
        self.short: dict[str, bytes] = {}
        self.special = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
        self.marks = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.table = dict(enumerate(byte_symbols()))
        # Beyond Latin letters, normalising and cutting pieces is left to the tokenizers library's own tables: Unicode versions differ in what is a letter.
        self.normalize = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()]).normalize_str
        self.cut = pre_tokenizers.Split(Regex(pattern), "removed", invert=True).pre_tokenize_str

    def ids_of(self, symbols: str) -> list[int]:
        raise NotImplementedError

    def pack(self, ids: list[int]) -> bytes:
        n = len(ids)
        return self.packers[n](*ids) if n < 16 else struct.pack(self.format % n, *ids)

    def symbols(self, piece: str) -> str:
        return piece.encode().decode("latin-1").translate(self.table)

    def word(self, piece: str) -> bytes:
        if len(piece) > 2:
            return self.pack(self.ids_of(piece if piece.isascii() and piece.isalnum() else self.symbols(piece)))
        # Marks, digits, endings.
        found = self.short.get(piece)
        if found is None:
            if len(self.short) >= 100_000:
                self.short.clear()
            found = self.short[piece] = self.pack(self.ids_of(self.symbols(piece)))
        return found

    def chunk(self, text: str) -> bytes:
        """The ids of a text without white space."""
        if not text.isascii() and max(text) > "\u024f":
            return b"".join([self.word(piece) for piece, _ in self.cut(self.normalize(text))])
        # Up to this letter nothing composes or decomposes, and lower case goes by character.
        text = text.lower()
        return self.word(text) if text.isalpha() else b"".join(map(self.word, self.pieces(text)))

    def plain(self, text: str) -> bytes:
        # str.split() also cuts at these four, which are no white space to the pattern.
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return self.chunk(text)
        return b"".join(map(self.chunk, text.split()))

    def packed(self, text: str) -> bytes:
        """The ids of one text."""
        if self.marks and any(x in text for x in self.special):
            return b"".join(self.pack([self.special[x]]) if x in self.special else self.plain(x) for x in self.marks.split(text) if x)
        return self.plain(text)

    def learn(self, words: pa.Array) -> None:
        """Keeps the ids of words that aren't known yet."""
        names = words.to_pylist()
        latin = [w for w in names if not w.isascii() and w.isalpha() and max(w) <= "\u024f" and "\u0130" not in w]
        # No letter's byte is a line feed, whose symbol parts the words again.
        spelled = iter(self.symbols("\n".join(latin)).split(self.table[10])) if latin else iter(())
        ids_of, pack, chunk = self.ids_of, self.pack, self.chunk
        found = []
        for w in names:
            if not w.isalpha():
                found.append(chunk(w))
            elif w.isascii():
                found.append(pack(ids_of(w)))
            else:
                found.append(pack(ids_of(next(spelled))) if max(w) <= "\u024f" and "\u0130" not in w else chunk(w))
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found))) // self.size + len(self.ids)
        self.known = pa.concat_arrays([self.known, words])
        self.ids, self.bounds = np.concatenate([self.ids, np.frombuffer(b"".join(found), self.width)]), np.concatenate([self.bounds, ends])

    def forget(self) -> None:
        """Drops the older half, or all where few long words are too much."""
        n = len(self.known) // 2 if self.known.nbytes < self.MOST_BYTES else len(self.known)
        # Copies, so that the whole arrays go.
        self.known = pa.concat_arrays([self.known.slice(n), pa.array([], pa.string())])
        self.ids, self.bounds = self.ids[self.bounds[n] :].copy(), self.bounds[n:] - self.bounds[n]

    def of_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct words, and where each word's begin (with the end)."""
        if len(self.known) >= self.most or self.known.nbytes >= self.MOST_BYTES:
            self.forget()
        stem, marks = stems(words)
        coded = stem.dictionary_encode()
        place = pc.index_in(coded.dictionary, value_set=self.known)
        if place.null_count:
            new, before = place.is_null(), len(self.known)
            self.learn(coded.dictionary.filter(new))
            place = place.fill_null(0).to_numpy(zero_copy_only=False).copy()
            place[new.to_numpy(zero_copy_only=False)] = np.arange(before, len(self.known))
        else:
            place = place.to_numpy(zero_copy_only=False)
        code = place[coded.indices.to_numpy(zero_copy_only=False)]
        first = self.bounds[code]
        sizes = self.bounds[code + 1] - first
        source, ends = ragged(first, sizes)
        # Each mark is a token behind its word.
        behind = np.cumsum(marks > 0)
        bounds = np.concatenate([[0], ends + behind])
        out = np.empty(int(bounds[-1]), self.width)
        out[np.arange(len(source)) + np.repeat(behind - (marks > 0), sizes)] = self.ids[source]
        for mark in MARKS:
            if (at := marks == mark).any():
                out[bounds[1:][at] - 1] = np.frombuffer(self.word(chr(mark)), self.width)[0]
        return out, bounds

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and where each text's begin (with the end); null counts as empty. Each distinct word of the batch is looked up once."""
        texts = pc.fill_null(texts, "")
        rare = np.zeros(len(texts), bool)
        for begin in {x[:2] for x in self.special}:
            rare |= pc.match_substring(texts, begin).to_numpy(zero_copy_only=False)
        words, cut = split_words(pc.if_else(pa.array(rare), "", texts) if rare.any() else texts)
        if len(words):
            coded = words.dictionary_encode()
            flat, bounds = self.of_words(coded.dictionary)
            code = coded.indices.to_numpy(zero_copy_only=False)
            source, ends = ragged(bounds[code], (bounds[1:] - bounds[:-1])[code])
            ids, ends = flat[source], np.concatenate([[0], ends])[cut]
        else:
            ids, ends = np.zeros(0, self.width), np.zeros(len(texts) + 1, np.int64)
        if not rare.any():
            return ids, ends
        own = {int(i): np.frombuffer(self.packed(texts[int(i)].as_py()), self.width) for i in np.flatnonzero(rare)}
        parts = [own[i] if i in own else ids[a:b] for i, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True))]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])


class Encoder(ChunkEncoder):
    """Encodes by backtracking."""

    def __init__(self, text: str, most: int = 1_000_000):
        super().__init__(json.loads(text), most)
        self.v = Vocabulary(text)
        self.ids_of = self.v.encode

    def __call__(self, text: str) -> str:
        """Decimal ids joined by spaces."""
        return " ".join(map(str, np.frombuffer(self.packed(text), self.width).tolist()))


def spelled_out(blob: np.ndarray, offsets: np.ndarray, ids: np.ndarray, bounds: np.ndarray, step: int = 200_000) -> pa.Array:
    """Each text's ids' spellings, joined by the space that ends each spelling; ``step`` ids at a time, to hold little in memory."""
    sizes = np.diff(offsets).astype(np.int32)[ids]
    sizes[bounds[1:][bounds[1:] > bounds[:-1]] - 1] -= 1  # no space behind a text's last
    ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    out = np.empty(int(ends[-1]), np.uint8)
    for at in range(0, len(ids), step):
        to = min(at + step, len(ids))
        out[ends[at] : ends[to]] = blob[ragged(offsets[ids[at:to]], sizes[at:to])[0]]
    return strings(out, ends[bounds], pa.string())


def decode_text(vocabulary: Vocabulary, decimal: str, step: int = 400_000) -> str:
    """Decodes ids given in decimal, a bounded piece at a time."""
    out, at = [], 0
    while at < len(decimal):
        to = len(decimal) if at + step >= len(decimal) else decimal.index(" ", at + step) if " " in decimal[at + step :] else len(decimal)
        out.append(vocabulary.decode(np.fromstring(decimal[at:to], np.int64, sep=" ")))
        at = to + 1
    return b"".join(out)[:-1].decode()


def tokenizer_json(path: str) -> str:
    """The tokenizer file's text, read on the driver; refused beyond MAX_FILE_MB, as it is broadcast."""
    with open(path, encoding="utf-8") as file:
        text = file.read(MAX_FILE_MB * 1_000_000 + 1)
    if len(text) > MAX_FILE_MB * 1_000_000:
        raise ValueError(f"the tokenizer file is larger than {MAX_FILE_MB} MB")
    return text


def bpe_round_trip(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", outputs: tuple[str, ...] = ("ids", "decoded")) -> DataFrame:
    """Encodes each text and decodes its ids again.

    ``outputs`` chooses among ids (array<int>), ids_text (decimal, joined by a
    space) and decoded (string); ``id_col`` and n_tokens are always there.
    """
    shared = bound_batches(docs).sparkSession.sparkContext.broadcast(tokenizer_json(tokenizer))
    types = {"ids": ("array<int>", pa.list_(pa.int32())), "ids_text": ("string", pa.string()), "decoded": ("string", pa.string())}
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = resident(("bpe", shared.value), lambda: Encoder(shared.value))
        for batch in slices(batches, "text"):
            ids, bounds = encode.batch(batch.column(1))
            made = {"id": batch.column(0), "n_tokens": pa.array(np.diff(bounds), pa.int64())}
            if "ids" in outputs:
                made["ids"] = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.astype(np.int32)))
            if "ids_text" in outputs:
                made["ids_text"] = spelled_out(*encode.v.decimal, ids, bounds)
            if "decoded" in outputs:
                made["decoded"] = spelled_out(encode.v.blob, encode.v.offsets, ids, bounds)
            yield pa.RecordBatch.from_arrays([made[k] for k in ["id", "n_tokens", *outputs]], names=["id", "n_tokens", *outputs])

    schema = ", ".join([f"id {kind}", "n_tokens bigint", *(f"{k} {types[k][0]}" for k in outputs)])
    return docs.selectExpr(f"`{id_col}` AS id", f"`{text_col}` AS text").mapInArrow(run, schema).withColumnRenamed("id", id_col)
