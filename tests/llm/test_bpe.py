from __future__ import annotations

import random

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from threadloom.llm.bpe import Encoder, bpe_round_trip, decode_text, spelled_out, tokenizer_json

PATH = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = "aaabcdethinsr  '’sS tTréÉßΣσİ 中文字１２3٣\t\n\x1c\x85\xa0é́😀.,!?-_ﬁǅ"


@pytest.fixture(scope="module")
def both():
    return Encoder(tokenizer_json(PATH)), Tokenizer.from_file(PATH)


def texts():
    rnd = random.Random(1)
    for k in range(4000):
        yield "".join(rnd.choice(ALPHABET) for _ in range(rnd.randrange(41))) + "<|endoftext|>x<|startoftext|>" * (k % 9 == 0)
        yield "".join(chr(rnd.randrange(1, 0x2FFF)) for _ in range(12))
        yield "".join(rnd.choice("thinganerso") for _ in range(rnd.randrange(1, 60)))


def test_equals_the_library(both):
    encode, library = both
    for text in [*texts(), "", " ", "x" * 5000]:
        ids = library.encode(text, add_special_tokens=False).ids
        made = encode(text)
        assert made == " ".join(map(str, ids)), repr(text)
        assert decode_text(encode.v, made, step=50) == library.decode(ids, skip_special_tokens=False)


def test_batches_equal_the_library(both):
    encode, library = both
    rnd = random.Random(3)
    marks = "abT .,!?:;'’０１aéÉ×÷ªµºÀſƿǅȺɏɐİıß́  \xa0\x1c.,"
    many = [*texts(), "", None, " ", "x" * 5000, *("".join(rnd.choice(marks) for _ in range(rnd.randrange(30))) for _ in range(20_000))]
    want = [library.encode(t or "", add_special_tokens=False).ids for t in many]
    for step in (1_000, 30_000):
        got, decimal, decoded = [], [], []
        for at in range(0, len(many), step):
            ids, bounds = encode.batch(pa.array(many[at : at + step]))
            got += [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            decimal += spelled_out(*encode.v.decimal, ids, bounds).to_pylist()
            decoded += spelled_out(encode.v.blob, encode.v.offsets, ids, bounds).to_pylist()
        assert got == want
        assert decimal == [" ".join(map(str, x)) for x in want]
        assert decoded == [library.decode(x, skip_special_tokens=False) for x in want]


def test_a_full_cache_forgets_and_learns_again(both):
    words = [f"w{'abcdefghij'[i % 10] * (1 + i // 10)}" for i in range(200)]
    small = Encoder(tokenizer_json(PATH), most=30)
    for at in range(0, 200, 10):
        texts = pa.array([" ".join(words[at : at + 10]), "one two"])
        ids, bounds = small.batch(texts)
        assert " ".join(map(str, ids[: bounds[1]])) == both[0](texts[0].as_py())
    assert len(small.known) < 60


def test_each_token_encodes_to_itself(both):
    encode, _ = both
    v = encode.v
    final = [i for i, x in enumerate(v.text_of) if ord(x[-1]) >= 0xE000]
    for i in final[::7]:
        word = v.text_of[i]
        assert v.encode(word[:-1] + chr(ord(word[-1]) - 0xE000)) == [v.ids[i]]


def test_bounded_caches_change_nothing(both):
    small = Encoder(tokenizer_json(PATH), most=3)
    for text in ("one two three four five one two", "a b c d e f g a b c"):
        assert small(text) == both[0](text)


def test_nulls_repeats_and_outputs(spark):
    df = spark.createDataFrame([(1, "Hi there", "x"), (1, "Hi there", "x"), (None, None, None), (2, "", "n_tokens")], "doc_id bigint, text string, ids string")
    got = sorted(map(tuple, bpe_round_trip(df, PATH, outputs=("ids", "ids_text", "decoded")).collect()), key=str)
    assert got == sorted([(1, 2, [1883, 997], "1883 997", "hi</w> there</w>")] * 2 + [(None, 0, [], "", ""), (2, 0, [], "", "")], key=str)
    assert bpe_round_trip(df.limit(0), PATH).collect() == []
