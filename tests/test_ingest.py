"""Loading by increments, pruned reading, storage by sample, on files laid out as the raw ones are."""

import io
import re
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from assaylake import bind, domain
from assaylake.operators import counts, matrix, prepare, profiles
from assaylake.plans import ingest as plan
from assaylake.plans.trusted import build_trusted
from assaylake.sinks.tables import write_by_sample
from assaylake.sources import measurements
from assaylake.sources.metadata import METADATA_SCHEMA

HEAD = "gene_id\tgene_name\tgene_type\tunstranded\tstranded_first\tstranded_second\ttpm_unstranded\tfpkm_unstranded\tfpkm_uq_unstranded"


def uid(n):
    return f"{n:08x}-1111-2222-3333-444444444444"


def put(root, n, value, folder=None):
    place = root / "raw" / (folder or uid(n))
    place.mkdir(parents=True, exist_ok=True)
    body = [f"ENSG{i}.1\tname{i}\tprotein_coding\t1\t1\t1\t{value + i}\t1\t1" for i in range(3)]
    (place / f"{uid(n)}.{domain.RAW_FILE_NEEDLE}.tsv").write_text("\n".join(["# comment", HEAD, "N_unmapped\t\t\t1\t1\t1\t\t\t", *body]))


def meta_of(spark, files):
    """(file, sample, class, size)"""
    rows = [(uid(n), f"{n}.tsv", size, "c", f"case-{s}", s, s, "Primary Tumor", "P", cls, cls) for n, s, cls, size in files]
    return spark.createDataFrame(rows, METADATA_SCHEMA)


FILES = [(1, "s1", "OV", 5), (2, "s1", "OV", 9), (3, "s2", "OV", 5), (4, "s3", "GBM", 5), (5, "s4", "LGG", 5)]


def content(made):
    """All three tables as sorted rows."""
    return [sorted(map(repr, frame.select(*sorted(frame.columns)).collect())) for frame in (made.long, made.samples, made.dictionary)]


def full(spark, meta, root, name):
    return content(build_trusted(spark, meta, str(root / "raw"), str(root / name)))


def test_increments_equal_a_full_build(spark, tmp_path):
    meta = meta_of(spark, FILES)
    run = lambda m=meta: plan.ingest(spark, m, str(tmp_path / "raw"), str(tmp_path / "made"))
    for n in (1, 3, 4):
        put(tmp_path, n, n * 10.0)
    first = run()
    assert len(first.read) == 3 and first.classes == ["GBM", "OV"]
    assert content(first.trusted) == full(spark, meta, tmp_path, "full1")
    again = run()
    assert again.read == [] and again.classes == []
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "made" / "long").rglob("*.parquet")}

    # A file of a new class: nothing else is read or written.
    put(tmp_path, 5, 50.0)
    more = run()
    assert [uid(5) in p for p in more.read] == [True] and more.classes == ["LGG"]
    assert all(p.stat().st_mtime_ns == t for p, t in files.items())
    assert content(more.trusted) == full(spark, meta, tmp_path, "full2")

    # A larger file of a sample takes the place of the one that was chosen; the class keeps its other sample unread.
    put(tmp_path, 2, 20.0)
    more = run()
    assert [uid(2) in p for p in more.read] == [True] and more.classes == ["OV"]
    assert content(more.trusted) == full(spark, meta, tmp_path, "full3")

    # A changed file, a file that is gone with its class, and changed metadata.
    put(tmp_path, 3, 333333.5)
    gone = next((tmp_path / "raw" / uid(4)).iterdir())
    gone.rename(tmp_path / "gone.tsv")
    more = run()
    assert more.classes == ["GBM", "OV"] and [uid(3) in p for p in more.read] == [True]
    assert not (tmp_path / "made" / "long" / "cancer_type=GBM").exists()
    assert content(more.trusted) == full(spark, meta, tmp_path, "full4")
    moved = meta_of(spark, [*FILES[:4], (5, "s4", "OV", 5)])
    assert content(run(moved).trusted) == full(spark, moved, tmp_path, "full5")
    states = {r.estado_descarga: r.n for r in run(moved).manifest.groupBy("estado_descarga").agg(F.count("*").alias("n")).collect()}
    assert states == {"present": 4, "missing": 1}


def test_a_run_that_fails_midway_is_made_good_by_the_next(spark, tmp_path, monkeypatch):
    meta = meta_of(spark, FILES)
    put(tmp_path, 1, 1.0)
    put(tmp_path, 4, 4.0)
    plan.ingest(spark, meta, str(tmp_path / "raw"), str(tmp_path / "made"))
    put(tmp_path, 2, 2.0)

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(prepare, "feature_dictionary", broken)
        with pytest.raises(RuntimeError, match="lost"):
            plan.ingest(spark, meta, str(tmp_path / "raw"), str(tmp_path / "made"))
    made = plan.ingest(spark, meta, str(tmp_path / "raw"), str(tmp_path / "made"))
    assert len(made.read) == 1
    assert content(made.trusted) == full(spark, meta, tmp_path, "full")


def test_nothing_there_yet(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    made = plan.ingest(spark, meta_of(spark, FILES), str(tmp_path / "raw"), str(tmp_path / "made"))
    assert made.read == [] and made.trusted.long.count() == made.trusted.samples.count() == 0


def test_only_chosen_files_are_opened(spark, tmp_path):
    for n in (1, 2, 3):
        put(tmp_path, n, float(n))
    put(tmp_path, 2, 99.0, folder=f"copy of [{uid(2)}]")  # a copy of equal length in a folder with pattern characters
    meta = meta_of(spark, FILES)
    files = measurements.one_path_per_file(measurements.list_raw_files(spark, str(tmp_path / "raw")))
    assert files.count() == 3
    paths = measurements.paths_of(files, prepare.choose_listed(meta, files, ["OV"]))
    read = measurements.read_paths(spark, paths)
    assert len(paths) == 2 and len(read.inputFiles()) == 2
    assert read.filter("gene_id like 'ENSG%'").count() == 6
    assert measurements.read_paths(spark, []).count() == 0
    made = build_trusted(spark, meta, str(tmp_path / "raw"), str(tmp_path / "made"))
    assert made.long.count() == 6 and made.long.select("source_file").distinct().count() == 2


def explained(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("simple")
    return re.sub(r"#\d+L?", "", out.getvalue())


@pytest.fixture(scope="module")
def by_sample(spark, sf, tmp_path_factory):
    place = tmp_path_factory.mktemp("by_sample")
    return place, write_by_sample(bind.long(spark, sf), "by_sample_test", str(place / "long"), buckets=3)


def test_sample_by_sample_plans_shuffle_nothing_below(by_sample):
    _, stored = by_sample
    features = ["Brand#1", "Brand#2"]
    assert "Exchange" not in explained(matrix.to_matrix(stored, features, unique=True, placed=True))
    assert "Exchange" not in explained(matrix.to_matrix(stored, features, placed=True))
    assert "Exchange" not in explained(prepare.dedupe_samples(prepare.candidate_samples(stored)))
    assert "Exchange" not in explained(prepare.enforce_grain(stored))
    # One exchange per class above the aggregate per sample, one for the order of the report.
    text = explained(profiles.detected_features(stored))
    below = text[text.rindex("Exchange hashpartitioning"):]
    assert "Exchange hashpartitioning(cancer_type" in below and "hashpartitioning(sample_id" not in text
    assert explained(profiles.detected_features(stored)).count("Exchange") == 2


def test_one_sorted_file_per_bucket_with_bloom_filters(spark, by_sample):
    import pyarrow.parquet as pq

    place, stored = by_sample
    found = list((place / "long").glob("*.parquet"))
    assert len(found) == 3
    for path in found:
        rows = pq.read_table(path, columns=["gene_id_base", "sample_id"]).to_pylist()
        assert rows == sorted(rows, key=lambda r: (r["gene_id_base"].encode(), r["sample_id"].encode()))
    # Where a dictionary does not serve, the feature has a bloom filter.
    sizes = {}
    spark.conf.set("parquet.enable.dictionary", "false")
    try:
        for bloom in (True, False):
            path = place / f"bloom-{bloom}"
            write_by_sample(stored, f"by_sample_{bloom}", str(path), buckets=3, bloom=bloom)
            sizes[bloom] = sum(p.stat().st_size for p in path.glob("*.parquet"))
    finally:
        spark.conf.unset("parquet.enable.dictionary")
    assert sizes[True] > sizes[False]
    assert counts.cardinalities(stored).collect() == counts.cardinalities(spark.read.parquet(str(path))).collect()
