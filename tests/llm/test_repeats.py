import hashlib
import tracemalloc
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from assaylake.llm import blocks, queries, repeats


def _plain(texts, width):
    """Every window of every text, one by one."""
    seen = Counter(t[p : p + width] for t in texts for p in range(len(t) - width + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - width + 1):
            if seen[t[p : p + width]] > 1:
                gone[p : p + width] = b"\1" * width
        spans = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(t)))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def _found(frame):
    return frame.select("n_bytes", "n_removed", "n_spans", F.sha2(F.coalesce("kept", F.lit(b"")), 256))


def test_query_equals_all_windows(spark, sf, documents, rows):
    texts = [(r.doc_id, (r.text or "").encode()) for r in documents.collect()]
    want = [(i, *rest) for (i, _), rest in zip(texts, _plain([t for _, t in texts], 400))]
    assert rows(queries.op1_repeats(spark, sf)) == sorted(want, key=repr)


def test_odd_rows_and_narrow_windows(odd, texts, rows):
    # The long text repeats itself at every byte; it is held against its closed form.
    short = [t.encode() for _, t in texts if len(t) < 100_000]
    frame = odd.where("coalesce(length(text), 0) < 100000")
    assert rows(_found(repeats.find_repeats(frame, width=60))) == sorted(_plain(short, 60), key=repr)
    whole = repeats.find_repeats(odd).where("doc_id = 11").first()
    assert (whole.n_bytes, whole.n_removed, whole.n_spans, bytes(whole.kept)) == (480_000, 480_000, 1, b"")


def test_many_blocks(documents, rows, monkeypatch):
    """The result does not depend on how the documents are dealt to shards."""
    one = rows(_found(repeats.find_repeats(documents, width=200)))
    make = blocks.make_blocks
    monkeypatch.setattr(repeats, "make_blocks", lambda df, text, _: make(df.repartition(4), text, block_bytes=20_000))
    assert rows(_found(repeats.find_repeats(documents, width=200))) == one


def test_more_text_than_buckets(documents, rows, monkeypatch):
    """Beyond the bound on buckets several blocks share one."""
    one = rows(_found(repeats.find_repeats(documents, width=200)))
    monkeypatch.setattr(blocks, "BUCKET_BYTES", 1)
    monkeypatch.setattr(blocks, "MAX_BUCKETS", 3)
    asked, bucketed = [], blocks.bucketed
    monkeypatch.setattr(blocks, "bucketed", lambda df, key, n: asked.append(n) or bucketed(df, key, n))
    make = blocks.make_blocks
    monkeypatch.setattr(repeats, "make_blocks", lambda df, text, _: make(df.repartition(2), text, block_bytes=20_000))
    assert rows(_found(repeats.find_repeats(documents, width=200))) == one
    assert asked == [3]


def test_columns_stay_and_characters_go_whole(spark, odd, empty):
    assert repeats.remove_repeats(empty).collect() == []
    cut = repeats.remove_repeats(odd)
    assert cut.columns == odd.columns and cut.schema["text"].dataType == odd.schema["text"].dataType
    # The last bytes of both accented letters are equal and begin a repeated string; the first ones are not.
    both = spark.createDataFrame([(1, "a\u00e9" + "b" * 400), (2, "x\u0169" + "b" * 400)], "doc_id long, text string")
    assert [r.n_removed for r in repeats.find_repeats(both).collect()] == [401, 401]
    assert [r.text for r in repeats.remove_repeats(both).orderBy("doc_id").collect()] == ["a", "x"]


def test_hashes_hold_no_tables_of_a_blocks_size():
    """A worker that has hashed a block keeps little, and needs little besides the sums while it does."""
    data = np.random.default_rng(1).integers(0, 256, 1 << 20).astype(np.uint8)
    starts = np.arange(0, len(data) - 400, 997)
    blocks.span_hashes(blocks.prefix_hashes(data[:1000]), np.array([0, 1]), np.array([5, 9]))
    tracemalloc.start()
    before = tracemalloc.get_traced_memory()[0]
    prefix = blocks.prefix_hashes(data)
    hashes = blocks.span_hashes(prefix, starts, starts + 400)
    held = len(prefix) * 8 + len(hashes) * 8
    after, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert after - before < held + (1 << 20) and most - before < held + (4 << 20)
    # Equal bytes have equal hashes wherever they stand, also across the places where work is parted.
    twice = np.concatenate((data[:200_000], data[:200_000]))
    prefix, at = blocks.prefix_hashes(twice), np.arange(0, 199_000, 501)
    assert np.array_equal(blocks.span_hashes(prefix, at, at + 900), blocks.span_hashes(prefix, at + 200_000, at + 200_900))


def test_cut_and_decoded_by_one_worker(documents):
    """A task of the last step runs one Python worker."""
    plan = repeats.remove_repeats(documents, width=250)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "ArrowEvalPython" not in plan
