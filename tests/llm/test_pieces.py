import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from assaylake.llm import pieces, queries

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Pieces.load(PATH)


@pytest.fixture(scope="module")
def plain(vocabulary):
    """Viterbi over a whole text, with all backpointers kept."""
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    known = {model.id_to_piece(i): (i, model.get_score(i)) for i in range(model.get_piece_size())
             if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
    worst, longest = min(s for _, s in known.values()) - 10, max(map(len, known))

    def encode(text):
        text = (" " + text).replace(" ", "▁") if text else ""
        best = [(0.0, 0, -1)]
        for end in range(1, len(text) + 1):
            ways = [(best[end - 1][0] + worst, end - 1, -1)]
            for start in range(max(0, end - longest), end):
                if text[start:end] in known:
                    i, score = known[text[start:end]]
                    ways.append((best[start][0] + score, start, i))
            best.append(max(ways, key=lambda w: (w[0], w[2] >= 0, -w[1])))
        out, at = [], len(text)
        while at:
            _, start, i = best[at]
            out[:0] = [i] if i >= 0 else [vocabulary.byte_ids[b] for b in text[start:at].encode()]
            at = start
        return out

    return encode


def test_query_equals_whole_text_viterbi(spark, sf, documents, plain):
    docs = {r.doc_id: r.text for r in documents.collect()}
    got = queries.op5_pieces(spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = plain(docs[r.doc_id])
        assert (r.n_tokens, r.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


def test_odd_rows_round_trip(odd, empty, plain):
    encoded = pieces.encode_texts(odd, PATH, into="node")
    assert encoded.columns == odd.columns
    for r in encoded.select("text", "node", pieces.decoded(PATH, "node").alias("back")).collect():
        text = r.text or ""
        assert r.back == text.replace("▁", " ")
        if len(text) < 10_000:
            assert r.node == plain(text)
    assert pieces.encode_texts(empty, PATH).collect() == []


@pytest.mark.parametrize("text", ["", " ", "  a  b ", "\n", "a\n\n b \n", "日本語 👍🏽", "▁▁x ▁", "x\x00y\t\tz", "ab " * 50, " " * 40, "é" * 20])
def test_stream_and_encoder_agree(vocabulary, plain, text):
    stream = list(vocabulary.stream((" " + text).replace(" ", "▁"))) if text else []
    encoded = np.frombuffer(pieces.Encoder(vocabulary, remembered=3).encode(text), "<u4").tolist()
    assert stream == encoded == plain(text)
    assert vocabulary.decode(encoded) == text.replace("▁", " ")


def test_window_is_bounded():
    """Ids are final long before the text ends, though its pieces overlap everywhere."""
    vocabulary = pieces.Pieces([("<unk>", 0.0), ("a", -3.0), ("aa", -4.0), ("aab", -5.0), ("ba", -3.5), ("b", -3.0)], {}, unknown=0)
    read = []

    def chars():
        for c in "aab" * 400:
            read.append(c)
            yield c

    ids = vocabulary.stream(chars())
    first = [next(ids) for _ in range(100)]
    assert len(first) == 100 and len(read) < 500
    assert vocabulary.decode(first + list(ids)) == "aab" * 400


def test_unknown_without_bytes():
    vocabulary = pieces.Pieces([("<unk>", 0.0), ("▁", -1.0), ("a", -1.0)], {}, unknown=0)
    assert np.frombuffer(pieces.Encoder(vocabulary).encode("aXa"), "<u4").tolist() == [1, 2, 0, 2]
