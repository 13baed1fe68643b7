from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from threadloom.llm import rans

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("n,symbols", [(0, 3), (1, 1), (255, 2), (256, 7), (257, 900), (70_000, 40_000), (600_000, 300)])
def test_blocks_round_trip(n, symbols):
    ids = (np.random.default_rng(n).pareto(1.0, n) * 3).astype(np.int64) % symbols
    coder = rans.Coder(rans.frequencies(np.bincount(ids, minlength=symbols)))
    out = []
    for kind, payload in rans.frames(memoryview(b"".join(x + b"\n" for x in rans.encode_blocks(coder, ids, 0)))):
        count, first, crc = rans.struct.unpack_from("<IQI", payload)
        assert kind == b"B" and first == sum(map(len, out))
        own = coder.decode(np.frombuffer(payload[16:], "<u8", rans.LANES)[None], [np.frombuffer(payload[16:], "<u4", offset=8 * rans.LANES)], -(-count // rans.LANES))[0].reshape(-1)[:count]
        assert zlib.crc32(own.astype("<u4").tobytes()) == crc
        out.append(own)
    assert np.array_equal(np.concatenate(out) if out else ids, ids)


def test_frequencies_keep_each_symbol_and_the_sum():
    counts = np.array([10**12, *[1] * 60_000, 0])
    f = rans.frequencies(counts)
    assert f.sum() == 1 << rans.SCALE and (f[:-1] > 0).all() and f[-1] == 0


def test_files_round_trip(spark, tmp_path):
    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choice(["the", "Of", "añadir", "x<|endoftext|>", "naïve\x1cz"]) for _ in range(rnd.randrange(30)))) for i in range(300)]
    rows += [(None, None), (5, "again"), (5, "again"), (7, "")]
    rnd.shuffle(rows)
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id bigint, text string, n bigint")
    got = rans.token_file_round_trip(df, PATH, path=str(tmp_path / "files")).collect()
    library = Tokenizer.from_file(PATH)
    want, at = [], 0
    encoded = [(d, library.encode(t or "", add_special_tokens=False).ids + [1]) for d, t in rows]
    for d, ids in sorted(encoded, key=lambda x: (x[0] is not None, x[0] or 0, np.array(x[1], "<u2").tobytes())):
        want.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_damage_is_noticed(spark, tmp_path):
    made, width = rans.token_ids(spark.createDataFrame([(1, "some text")], "doc_id bigint, text string"), PATH)
    rans.write_token_files(made, width, str(tmp_path / "f"))
    file = next(p for p in (tmp_path / "f").glob("part-*") if p.stat().st_size)
    data = bytearray(file.read_bytes())
    data[-40] ^= 1
    (tmp_path / "g").mkdir()
    (tmp_path / "g" / "part-0").write_bytes(data)
    with pytest.raises(Exception, match="damaged|no frame|not whole"):
        rans.read_token_files(spark, str(tmp_path / "g")).collect()


def test_empty_table(spark):
    assert rans.token_file_round_trip(spark.createDataFrame([], "doc_id bigint, text string"), PATH).collect() == []
