import zlib

import numpy as np
import public_tokenizers
import pytest
import tokenizers

from assaylake.llm import queries, rans, token_files
from assaylake.session import scratch_folder

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def plain():
    tokenizer = tokenizers.Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_query_equals_library(spark, sf, documents, plain, rows):
    want, start = [], 0
    for doc_id, text in sorted((r.doc_id, r.text) for r in documents.collect()):
        ids = np.array([*plain(text), 1], "<u4")
        want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert rows(queries.op2_tokens(spark, sf)) == sorted(want, key=repr)


def test_odd_rows_come_back_in_order(spark, odd, empty, plain):
    path = scratch_folder(spark, "tokens")
    token_files.write_tokens(odd, path, PATH, end=1)
    got = token_files.read_tokens(spark, path).orderBy("start").collect()
    keys = [r.key for r in got]
    assert keys == sorted(keys, key=lambda k: (k is not None, k)) and len(keys) == odd.count()
    want = sorted(((r.doc_id is not None, r.doc_id or 0), [*plain(r.text), 1]) for r in odd.collect())
    assert sorted(((r.key is not None, r.key or 0), r.ids) for r in got) == want
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()
    path = scratch_folder(spark, "tokens")
    token_files.write_tokens(empty, path, PATH, end=1)
    assert token_files.read_checksums(spark, path).collect() == []


@pytest.mark.parametrize(
    "text", ["", " ", "Héllo  WORLD it's o'clock's. can't!!", "x<|endoftext|>y <|startoftext|>", "J̌ T̈ İ K ́abc ΣΑΣ. ﬁ １２",
             "日本語 👍🏽!!", "a,b c.d... 'tis 'S 12.5%%\x1c\x85x\x0by"]
)
def test_words_apart_equal_the_whole(plain, text):
    for remembered in (0, 1000):
        coder = token_files.WordCoder(PATH, remembered)
        for _ in range(3):
            assert np.frombuffer(coder.encode(text.encode()), "<u4").tolist() == plain(text)


@pytest.mark.parametrize(
    "text", ["a <|ENDOFTEXT|> b", "A <|EndOfText|> <|endoftext|>", "X<|STARTOFTEXT|>Y, <|startoftext|>Z!", "<|ENDOFTEXT|><|endoftext|>..."]
)
def test_special_tokens_in_other_case(plain, text):
    assert np.frombuffer(token_files.WordCoder(PATH).encode(text.encode()), "<u4").tolist() == plain(text)


@pytest.mark.parametrize("n", [0, 1, 31, 32, 33, 16_384, 16_385, 70_001])
def test_codec_round_trip(n):
    ids = np.minimum(np.random.default_rng(n).zipf(1.3, n), 49_000).astype(np.uint32)
    coded = rans.encode(ids)
    assert (rans.decode(coded) == ids).all()
    if n > 10_000:
        counts = np.bincount(ids)
        share = counts[counts > 0] / n
        assert 8 * len(coded) < 1.15 * n * -(share * np.log2(share)).sum() + 40 * len(share) + 30_000


def test_more_symbols_than_the_table_holds():
    ids = np.random.default_rng(2).integers(0, 2**32, 150_000).astype(np.uint32)
    assert (rans.decode(rans.encode(ids)) == ids).all()


def test_damage_is_found():
    ids = np.random.default_rng(3).integers(0, 500, 50_000).astype(np.uint32)
    coded = rans.encode(ids)
    altered = bytearray(coded)
    altered[-5_000] ^= 4
    for bad in (bytes(altered), coded[:-100], b"?" + coded[1:]):
        with pytest.raises(ValueError):
            rans.decode(bad)


@pytest.mark.parametrize(
    "text", ["Étude ÀÍà íß, naÏve... été! ÿŸ x×y÷z", "É<|ENDOFTEXT|>É Straße%% µm ª² ¼ ½", "word wörd WÖRD's l'ÉTÉ. été́ \xa0nbsp\xa0É\xad \x85É"]
)
def test_letters_below_256(plain, text):
    for remembered in (0, 1000):
        coder = token_files.WordCoder(PATH, remembered)
        assert [np.frombuffer(x, "<u4").tolist() for x in coder.encode_all([text.encode(), b"", text.upper().encode()])] == [plain(text), [], plain(text.upper())]


def test_plain_words_are_merged_without_the_steps_before():
    """Words of letters, with marks and capitals or without, never go through the tokenizer's steps before the merges."""
    coder = token_files.WordCoder(PATH)
    coder._whole = lambda words: pytest.fail(f"{words} went through the whole tokenizer") if set(words) - {b".", b",", b"!!"} else None
    coder.known.update({b".": b"", b",": b"", b"!!": b""})
    assert len(coder.encode("Étude naïve, Plainword. été!!".encode())) > 0
    assert {"étude".encode(), "naïve".encode(), b"plainword", "été".encode()} <= coder.known.keys()
