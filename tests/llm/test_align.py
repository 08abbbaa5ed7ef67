import bisect
import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from assaylake.llm import align, queries

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain():
    """The libraries, text by text, and what the contract says of two tokenizations."""
    byte_level, model = tokenizers.Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    byte_level.encode_special_tokens = True
    byte_of = align.byte_alphabet()

    def tokens(text):
        a = [(i, bytes(byte_of[c] for c in byte_level.id_to_token(i))) for i in byte_level.encode(f" {text}", add_special_tokens=False).ids]
        b = [(i, bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()) for i in model.encode(text)]
        return (a, b) if text and b"".join(x for _, x in a) == b"".join(x for _, x in b) == f" {text}".encode() else ([], [])

    def documents(rows):
        read, counts = [], Counter()
        for key, text in rows:
            a, b = tokens(text or "")
            ends = [np.cumsum([len(x) for _, x in side]).tolist() for side in (a, b)]
            common = sorted(set(ends[0]) & set(ends[1]))
            at = [{e: i for (i, _), e in zip(side, end, strict=True)} for side, end in zip((a, b), ends, strict=True)]
            links = [(at[0][e], at[1][e]) for e in common]
            counts.update(links)
            groups, overlaps = [([], []) for _ in common], 0
            for k, (side, end) in enumerate(zip((a, b), ends, strict=True)):
                for (i, _), e in zip(side, end, strict=True):
                    groups[bisect.bisect_left(common, e)][k].append(str(i))
            spans = [list(zip([0, *end], end, strict=False)) for end in ends]
            if len(a) < 200:
                overlaps = sum(max(x, u) < min(y, v) for x, y in spans[0] for u, v in spans[1])
            written = ";".join(f"{','.join(x)}|{','.join(y)}" for x, y in groups)
            read.append((key, len(a), len(b), len(common), links, hashlib.sha256(written.encode()).hexdigest() if a else "", overlaps, sum(len(x) * len(y) for x, y in groups)))
        most = defaultdict(int)
        for (_, b), n in counts.items():
            most[b] = max(most[b], n)
        return [
            (key, n_a, n_b, n, len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), sha, overlaps, grouped)
            for key, n_a, n_b, n, links, sha, overlaps, grouped in read
        ]

    return documents


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps", "n_in_groups"]


def test_query_equals_plain_version(spark, sf, documents, plain):
    want = plain((r.doc_id, r.text) for r in documents.select("doc_id", "text").collect())
    got = [tuple(r) for r in queries.op12_alignment(spark, sf).collect()]
    unmeasured = lambda rows: sorted((*r[:8], r[8] if r[1] < 200 else 0, r[9]) for r in rows)
    assert unmeasured(got) == sorted(want)
    assert sum(r[4] for r in got) > 10_000


@pytest.mark.parametrize("block_bytes", [1, 3000, 1 << 20])
def test_odd_rows(spark, odd, empty, plain, block_bytes):
    more = [(20, "a▁b"), (21, "<s></s><unk> <0x41> ▁▁"), (22, "  two  spaces \t\n\x00end "), (23, "é ﬁ ½ Ⅷ 👩‍👩‍👧 ﻿"), (24, "A" * 3000), (25, "<|endoftext|>"), (26, "cpm cpm")]
    frame = odd.withColumn("n_a", F.lit(1)).withColumn("block", F.lit(2)).withColumn("key", F.lit("k")).unionByName(
        spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True
    )
    rows = [(r.doc_id, r.text) for r in frame.collect() if r.doc_id != 11]
    kept = frame.where("doc_id is null or doc_id <> 11")
    got = [tuple(r) for r in align.align_documents(kept, A, B, "doc_id", block_bytes=block_bytes).select("doc_id", *COLUMNS).collect()]
    unmeasured = lambda rows: sorted(((*r[:8], r[8] if r[1] < 200 else 0, r[9]) for r in rows), key=repr)
    assert unmeasured(got) == unmeasured(plain(rows))
    zeros = {r[0] for r in got if r[1] == 0}
    assert {1, 2, 20} <= zeros and 22 not in zeros
    assert align.align_documents(empty, A, B, "doc_id").collect() == []


def test_sections_change_no_token(documents, monkeypatch):
    texts = [r.text for r in documents.select("text").collect() if r.text] + ["don't go  to 12 places; he'll see - I 'd go\nx y\tz a b"]
    monkeypatch.setattr(align, "SECTION", 50)
    assert all(" ".join(align.sections(t)) == t for t in texts) and max(len(align.sections(t)) for t in texts) > 100
    parted = [align._encoded(align.tokenizer(p), texts) for p in (A, B)]
    monkeypatch.setattr(align, "SECTION", 1 << 30)
    for path, (ids, counts) in zip((A, B), parted, strict=True):
        whole_ids, whole_counts = align._encoded(align.tokenizer(path), texts)
        assert np.array_equal(ids, whole_ids) and np.array_equal(counts, whole_counts)


def _dense(m):
    out = np.zeros((m.height, m.width), np.int64)
    np.add.at(out, (m.row_of, m.columns), m.values)
    return out


def test_products_equal_dense_ones():
    rng = np.random.default_rng(1)
    for _ in range(30):
        h, w, v = rng.integers(1, 9, 3)
        dense = [rng.integers(0, 3, s) * (rng.random(s) < 0.4) for s in ((h, w), (w, v))]
        made = []
        for d in dense:
            row, column = np.nonzero(d)
            made.append(align.Rows(np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(d))))), column, d[row, column], d.shape[1]))
        assert np.array_equal(_dense(align.product(*made)), dense[0] @ dense[1])
        assert np.array_equal(_dense(made[0].transposed()), dense[0].T)
    nothing = align.incidence(np.empty(0, np.int64))
    assert align.product(nothing, nothing.transposed()).height == 0


def test_links_of_one_text():
    found = align.align([" x" * 3, "", "tokenization of words"], align.tokenizer(A), align.tokenizer(B))
    shared = align.shared_group_links(found)
    assert shared.starts[-1] == found.n_shared_group().sum() >= found.together.sum() == found.n_groups.sum()
    lengths = align.tokenizer(A).spelling.lengths[found.a_ids]
    assert np.array_equal(np.bincount(found.link_a, found.shared), lengths)


def test_what_is_done_byte_by_byte_takes_half_the_room():
    """Bytes are counted in 32 bits; sums and products that pass them are not cut."""
    lengths = np.array([3, 1, 4])
    found = align.product(align.incidence(lengths), align.incidence(lengths[::-1]).transposed())
    assert found.columns.dtype == np.int32 and found.values.tolist() == [3, 1, 1, 3]
    assert align.index_type(1 << 31) is np.int64
    large = align.Rows(np.array([0, 2]), np.array([0, 1], np.int32), np.full(2, 1 << 30, np.int32), 2)
    column = align.Rows(np.array([0, 1, 2]), np.zeros(2, np.int32), np.full(2, 1 << 20, np.int32), 1)
    assert align.product(large, column).values.tolist() == [1 << 51]


@pytest.mark.parametrize("remembered", [0, 1000])
def test_units_apart_equal_the_whole(monkeypatch, remembered):
    monkeypatch.setattr(align, "REMEMBERED", remembered)
    coder, whole = align.ByteLevel(A), tokenizers.Tokenizer.from_file(A)
    whole.encode_special_tokens = True
    texts = [
        "it's I'll 's 'S x's, don't 12 3a4 a1. naïve 日本語\nnext line. end\n\nfeed", "a\nb\nc", "tail\n", "tail ", " lead", "two  spaces", "tab\t x\ty\x0bz", "nbsp\xa0x \xa0y",
        "next\x85line \x1cx\x1c", "thin space ideographic　space   x", "﻿bom a​b", "<|endoftext|> x<|endoftext|> y", "é '́s 👩‍👩‍👧!!", "A" * 3000 + " b", "\n", " ", "...\n'll",
    ]
    for _ in range(3):
        got = coder.ids(texts)
        assert [list(x) for x in got] == [whole.encode(f" {t}", add_special_tokens=False).ids for t in texts]


def test_each_unit_is_encoded_once():
    """A word that comes again, in this text or another, does not go to the library again."""
    coder, asked = align.ByteLevel(A), []
    plain = coder._plain
    coder._plain = lambda texts: asked.extend(texts) or plain(texts)
    first = coder.ids(["some words of some words\nand some more"])
    coder.ids(["more words of some", "some more"])
    assert "".join(asked).count(" some") == 1 and "".join(asked).count(" more") == 1
    assert coder.tokenizer.decode(first[0].tolist()) == " some words of some words\nand some more"
