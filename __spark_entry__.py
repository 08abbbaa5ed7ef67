
from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracles  # noqa: E402
from assaylake import bind  # noqa: E402
from assaylake.functions import class_lookup, rounded, vector_values  # noqa: E402
from assaylake.models import bayes, scoring, storage, training  # noqa: E402
from assaylake.operators import (  # noqa: E402
    checks, counts, curves, evaluate, feeds, intake, matrix, moments, prepare, profiles, ranking,
)
from assaylake.plans import ingest, modelling, trusted as trusted_plan  # noqa: E402
from assaylake.roles import DEFAULT as R  # noqa: E402
from assaylake.session import ensure_shared_folder, reliable, scratch_folder, tune  # noqa: E402
from assaylake.sinks import exports, manifest, tables as table_sinks  # noqa: E402
from assaylake.sources import (  # noqa: E402
    measurements as raw, metadata as listing, new_samples as new_files, tables as table_sources,
)

try:
    from assaylake.llm import registry as corpus  # noqa: E402
except ModuleNotFoundError as missing:  # the corpus subpackage may be left out; nothing else may be missing
    if missing.name != "assaylake.llm":
        raise
    corpus = None
try:
    import corpus_pipeline  # noqa: E402
except ModuleNotFoundError as missing:
    if missing.name not in ("assaylake.llm", "corpus_pipeline"):
        raise
    corpus_pipeline = None

Query = Callable[[SparkSession, str], DataFrame]

SAMPLE_SF = "/root/testdata/sf0.001"
N_LABELS = bind.N_SCORES
PROJECTS = {f"SEG-{c}": (c, c.lower()) for c in bind.CLASSES if c != "MACHINERY"}


def entry(spark: SparkSession) -> DataFrame:
    """Value distribution per class, from raw measurements and metadata."""
    return queries()["value_stats"](spark, SAMPLE_SF)


def oracle_sql() -> dict[str, str]:
    found = oracles.oracle_sql()
    if corpus:
        found |= corpus.ORACLE_SQL
    if corpus_pipeline and corpus_pipeline.ORACLE_SQL:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


def queries() -> dict[str, Query]:
    found = {}
    for group in (_preparation, _storage, _counting, _distributions, _matrix, _evaluation, _intake, _feeds, _models):
        found.update(group())
    if corpus:
        found |= corpus.QUERIES
    if corpus_pipeline:
        found["pipeline"] = corpus_pipeline.run
    return {name: _tuned(query) for name, query in found.items()}


def _tuned(query: Query) -> Query:
    return lambda spark, sf_dir: query(tune(ensure_shared_folder(spark)), sf_dir)


def _r4(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: rounded(F.col(f"`{c}`"), 4) for c in columns})


def _measured(df: DataFrame) -> DataFrame:
    # Measures have five decimals, so four would round many exact halves.
    return _r4(df, R.value).withColumn(R.measure, rounded(R.measure, 8))


def _scratch(spark: SparkSession) -> str:
    """A new folder for tables that a query stores and reads back."""
    return scratch_folder(spark, "assaylake")


# Raw to trusted


def _hit_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as nested listing hits: some without cases, some cases without samples, some with two of each."""
    customer = bind.table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    orders = bind.table(spark, sf, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
    rank, key = F.substring("o_orderpriority", 1, 1), F.col("o_orderkey")

    def sample(suffix: str):
        return F.struct(
            F.concat_ws("-", F.col("o_custkey").cast("string"), F.concat(rank, F.lit(suffix))).alias("sample_id"),
            F.concat_ws("-", "c_name", F.concat(rank, F.lit(suffix))).alias("submitter_id"),
            F.col("o_orderpriority").alias("sample_type"),
        )

    def case(prefix: str):
        return F.struct(
            F.concat(F.lit(prefix), F.col("o_custkey")).alias("case_id"),
            F.col("c_name").alias("submitter_id"),
            F.struct(F.concat(F.lit("SEG-"), F.col("c_mktsegment")).alias("project_id")).alias("project"),
            F.filter(F.array(sample(""), sample("-second")), lambda _: key % 5 != 0).alias("samples"),
        )

    hit = F.struct(
        key.cast("string").alias("file_id"),
        F.concat(F.lit("order-"), key, F.lit(".tsv")).alias("file_name"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("file_size"),
        F.lit("Transcriptome Profiling").alias("data_category"),
        F.lit("Gene Expression Quantification").alias("data_type"),
        F.when(key % 2 == 0, "open").otherwise("controlled").alias("access"),
        F.struct(F.lit("STAR - Counts").alias("workflow_type")).alias("analysis"),
        F.filter(F.array(case("case-"), case("second-")), lambda _: key % 11 != 0).alias("cases"),
    )
    return orders.select(F.array(hit).alias("hits"))


def _hits(spark: SparkSession, sf: str) -> DataFrame:
    return listing.explode_hits(_hit_documents(spark, sf))


def _select_files(spark: SparkSession, sf: str) -> DataFrame:
    wanted = listing.select_files(_hits(spark, sf), ["SEG-BUILDING", "SEG-FURNITURE"])
    return listing.flatten_metadata(wanted, PROJECTS).select(R.file, R.project)


def _file_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Paths with a UUID made of the order key's hash, and the id read back from the path."""
    digits = F.md5(F.col("o_orderkey").cast("string"))
    parts = [F.substring(digits, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    path = F.concat(F.lit("/raw/"), F.concat_ws("-", *parts), F.lit("/counts.tsv"))
    stored = bind.table(spark, sf, "orders").select("o_orderkey", path.alias(R.source))
    return raw.with_file_id(stored).select("o_orderkey", R.file)


def _class_lookup(spark: SparkSession, sf: str) -> DataFrame:
    code, name = class_lookup(R.project, PROJECTS)
    return bind.metadata(spark, sf).select(R.file, code.alias("code"), name.alias("name"))


def _official(spark: SparkSession, sf: str) -> DataFrame:
    return prepare.official_samples(bind.metadata(spark, sf), bind.CLASSES, bind.NEEDLE, bind.SUBJECT_PREFIX)


def _clean(spark: SparkSession, sf: str) -> DataFrame:
    return _measured(bind.clean(spark, sf).select(R.file, *R.feature_columns, R.measure, R.value))


def _attach(spark: SparkSession, sf: str) -> DataFrame:
    joined = prepare.attach_metadata(bind.clean(spark, sf), _official(spark, sf))
    return _measured(prepare.select_present(joined, R.long_columns))


def _manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as expected files; those with wanted line items as arrived ones, their positive rows as the size."""
    arrived = (
        bind.clean(spark, sf)
        .groupBy(R.file, F.col(R.source).alias("path"))
        .agg(F.count_if(F.col(R.measure) > 0).alias("length"))
    )
    return manifest.ingest_manifest(bind.metadata(spark, sf), arrived)


def _preparation() -> dict[str, Query]:
    return {
        "flatten_metadata": lambda s, sf: listing.flatten_metadata(_hits(s, sf), PROJECTS),
        "select_files": _select_files,
        "file_ids": _file_ids,
        "class_lookup": _class_lookup,
        "official_samples": _official,
        "clean_measurements": _clean,
        "attach_metadata": _attach,
        "candidate_samples": bind.candidates,
        "dedupe_samples": lambda s, sf: prepare.dedupe_samples(bind.candidates(s, sf)),
        "keep_selected": lambda s, sf: _measured(bind.undeduplicated_long(s, sf)),
        "trusted_long": lambda s, sf: _measured(bind.long(s, sf)),
        "enforce_grain": lambda s, sf: _measured(
            prepare.enforce_grain(bind.undeduplicated_long(s, sf)).select(R.long_columns)
        ),
        "feature_dictionary": lambda s, sf: bind.trusted(s, sf).dictionary,
        "ingest_manifest": _manifest,
        "manifest_states": lambda s, sf: manifest.manifest_states(_manifest(s, sf)),
    }


# Stored tables


def _stored_long(spark: SparkSession, sf: str) -> DataFrame:
    path = _scratch(spark)
    table_sinks.write_long(bind.long(spark, sf), path, [R.cls], [R.feature])
    return _measured(table_sources.read_path(spark, path).select(R.long_columns))


def _registered_table(spark: SparkSession, sf: str) -> DataFrame:
    path, name = _scratch(spark), f"assaylake_long_{uuid.uuid4().hex}"
    table_sinks.write_long(bind.long(spark, sf), path, [R.cls])
    table_sinks.register_location(spark, name, path)
    return table_sources.read_table(spark, name).groupBy(R.cls).agg(F.count("*").alias("n"))


def _csv_export(spark: SparkSession, sf: str) -> DataFrame:
    folder = _scratch(spark)
    exports.export_tables({"refined_conteo_clases": counts.class_counts(bind.long(spark, sf))}, folder)
    return table_sources.load_refined(spark, "conteo_clases", "csv", folder)


def _published_table(spark: SparkSession, sf: str) -> DataFrame:
    """A report as a managed table, in a database that lies in the scratch folder."""
    space = f"assaylake_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {space} LOCATION '{_scratch(spark)}'")
    name = f"{space}.refined_conteo_clases"
    table_sinks.publish(counts.class_counts(bind.long(spark, sf)), name)
    return table_sources.table_or_compute(spark, name, lambda: spark.range(0))


def _table_status(spark: SparkSession, sf: str) -> DataFrame:
    folder, long = _scratch(spark), bind.long(spark, sf)
    exports.export_tables(
        {"refined_conteo_clases": counts.class_counts(long), "refined_top_genes_por_clase": ranking.top_features(long)},
        folder,
    )
    return table_sources.table_status(spark, "csv", folder).drop("origen")


def _table_status_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """The same of tables published to a database, whose rows the catalog knows."""
    space, long = f"assaylake_{uuid.uuid4().hex}", bind.long(spark, sf)
    spark.sql(f"CREATE DATABASE {space} LOCATION '{_scratch(spark)}'")
    for name, frame in (("refined_conteo_clases", counts.class_counts(long)), ("refined_top_genes_por_clase", ranking.top_features(long))):
        table_sinks.publish(frame, f"{space}.{name}")
    return table_sources.table_status(spark, "table", namespace=space).drop("origen")


def _metadata_json(spark: SparkSession, sf: str) -> DataFrame:
    path = _scratch(spark)
    _hit_documents(spark, sf).write.json(path)
    return listing.flatten_metadata(listing.explode_hits(listing.read_hits(spark, path, multi_line=False)), PROJECTS)


def _metadata_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = _scratch(spark)
    exports.export_csv(bind.metadata(spark, sf), path)
    return listing.official_files(listing.read_metadata_csv(spark, path), bind.CLASSES, bind.NEEDLE)


def _metadata_csv_reordered(spark: SparkSession, sf: str) -> DataFrame:
    """The columns of the file in reverse order, two of them left out."""
    path, rows = _scratch(spark), bind.metadata(spark, sf).drop(R.file_name, R.case)
    exports.export_csv(rows.select(*reversed(rows.columns)), path)
    return listing.official_files(listing.read_metadata_csv(spark, path), bind.CLASSES, bind.NEEDLE)


def _uuid_of(key: str):
    digits = F.md5(F.col(key).cast("string"))
    return F.concat_ws("-", *[F.substring(digits, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def _raw_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as rows of measurement files, one file per supplier, in a folder named by a UUID."""
    unused = [F.lit(1.0).alias(c) for c in ("unstranded", "stranded_first", "stranded_second")]
    unused_too = [F.lit(1.0).alias(c) for c in ("fpkm_unstranded", "fpkm_uq_unstranded")]
    number = F.col("l_linenumber").cast("string")
    return bind.table(spark, sf, "lineitem").select(
        "l_suppkey",
        _uuid_of("l_suppkey").alias("folder"),
        F.when(number == "7", "N_unmapped").otherwise(F.concat(F.lit("G"), number, F.lit(".1"))).alias("gene_id"),
        F.concat(F.lit("g"), number).alias(R.feature_name),
        F.when(F.col("l_returnflag") == "A", "lncRNA").otherwise("protein_coding").alias(R.feature_type),
        *unused,
        F.when(F.round(F.col("l_tax") * 100) != 8, F.col("l_extendedprice")).alias(R.measure),
        *unused_too,
    )


def _write_raw(lines: DataFrame, path: str) -> None:
    # All rows of a folder in one task, so that each folder gets one file.
    writer = lines.drop("l_suppkey").repartition("folder").write.mode("append").partitionBy("folder")
    writer.option("header", True).option("sep", "\t").csv(path)


def _measurement_files(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as TSV files, one folder per supplier named by a UUID, read back and summed up per file."""
    path = _scratch(spark)
    _write_raw(_raw_lines(spark, sf), path)
    read = prepare.clean_measurements(raw.with_file_id(raw.read_measurements(spark, path)))
    summed = read.groupBy(R.file, R.feature).agg(
        F.count("*").alias("n"), F.sum(R.measure).alias(R.measure), F.avg(R.value).alias(R.value)
    )
    return _r4(summed, R.measure, R.value)


def _supplier_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """Metadata of the supplier files: every third supplier of a nation, its class, is a file of one sample."""
    supplier = bind.table(spark, sf, "supplier").join(bind.table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    third = (F.col("s_suppkey") % 3).cast("string")
    sample = F.concat_ws("-", "n_name", third)
    return supplier.select(
        _uuid_of("s_suppkey").alias(R.file), F.col("s_name").alias(R.file_name),
        F.round(F.col("s_acctbal") * 100).cast("bigint").alias(R.file_size), F.concat(F.lit("case-"), F.col("s_name")).alias(R.case),
        F.concat(F.lit("case-"), sample).alias(R.case_submitter), sample.alias(R.sample), sample.alias(R.sample_submitter),
        F.lit("Primary Tumor").alias(R.sample_type), F.col("n_name").alias(R.project), F.col("n_name").alias(R.cls),
        F.lower("n_name").alias(R.cls_name),
    )


def _nations(spark: SparkSession, sf: str) -> list[str]:
    return [row[0] for row in bind.table(spark, sf, "nation").select("n_name").orderBy("n_name").limit(100).collect()]


def _from_files(long: DataFrame) -> DataFrame:
    return _measured(long.select(*R.sample_columns, *R.feature_columns, R.measure, R.value))


def _trusted_from_files(spark: SparkSession, sf: str) -> DataFrame:
    """TSV files and metadata to the stored trusted table in one build."""
    path = _scratch(spark)
    _write_raw(_raw_lines(spark, sf), f"{path}/raw")
    made = trusted_plan.build_trusted(
        spark, _supplier_metadata(spark, sf), f"{path}/raw", f"{path}/trusted", _nations(spark, sf), raw_needle="part-", glob="*.csv"
    )
    return _from_files(made.long)


def _ingest_by_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """The same in two increments: the files of some suppliers arrive after the first load."""
    path, lines, meta = _scratch(spark), _raw_lines(spark, sf), _supplier_metadata(spark, sf)
    late = F.col("l_suppkey") % 7 == 3
    for part in (lines.filter(~late), lines.filter(late)):
        _write_raw(part, f"{path}/raw")
        made = ingest.ingest(
            spark, meta, f"{path}/raw", f"{path}/trusted", _nations(spark, sf), raw_needle="part-", glob="*.csv"
        )
    return _from_files(made.trusted.long)


def _by_sample(spark: SparkSession, sf: str) -> DataFrame:
    name = f"assaylake_by_sample_{uuid.uuid4().hex}"
    return table_sinks.write_by_sample(bind.long(spark, sf), name, _scratch(spark))


def _matrix_by_sample(spark: SparkSession, sf: str) -> DataFrame:
    stored = _by_sample(spark, sf)
    features = _features(stored)
    return _r4(matrix.to_matrix(stored, features, unique=True, placed=True), *features)


def _storage() -> dict[str, Query]:
    return {
        "stored_long": _stored_long,
        "registered_table": _registered_table,
        "published_table": _published_table,
        "csv_export": _csv_export,
        "table_status": _table_status,
        "table_status_catalog": _table_status_catalog,
        "metadata_json": _metadata_json,
        "metadata_csv": _metadata_csv,
        "metadata_csv_reordered": _metadata_csv_reordered,
        "measurement_files": _measurement_files,
        "trusted_from_files": _trusted_from_files,
        "ingest_by_manifest": _ingest_by_manifest,
        "detected_by_sample": lambda s, sf: profiles.detected_features(_by_sample(s, sf)),
        "matrix_by_sample": _matrix_by_sample,
    }


# Counts and checks


def _summary(spark: SparkSession, sf: str) -> DataFrame:
    t = bind.trusted(spark, sf)
    return counts.summary(t.long, t.samples, t.dictionary)


def _consistency(spark: SparkSession, sf: str) -> DataFrame:
    t = bind.trusted(spark, sf)
    return counts.consistency(t.long, t.samples)


def _table_counts(spark: SparkSession, sf: str) -> DataFrame:
    t = bind.trusted(spark, sf)
    return counts.table_counts({"long": t.long, "samples": t.samples, "dictionary": t.dictionary})


def _shared_values(spark: SparkSession, sf: str) -> DataFrame:
    customers = bind.table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"))
    buyers = bind.table(spark, sf, "orders").select(F.col("o_custkey").alias("custkey"))
    return checks.shared_values(customers, buyers, "custkey")


def _counting() -> dict[str, Query]:
    expected = ["AEROSPACE", *[c for c in bind.CLASSES if c != "MACHINERY"]]
    return {
        "summary": _summary,
        "consistency": _consistency,
        "cardinalities": lambda s, sf: counts.cardinalities(bind.long(s, sf)),
        "n_distinct": lambda s, sf: counts.n_distinct(bind.long(s, sf), R.subject),
        "files_per_class": lambda s, sf: counts.files_per_class(bind.metadata(s, sf)),
        "samples_per_class": lambda s, sf: counts.samples_per_class(bind.long(s, sf)),
        "class_counts": lambda s, sf: counts.class_counts(bind.long(s, sf)),
        "class_counts_samples": lambda s, sf: counts.class_counts_samples(bind.samples(s, sf)),
        "class_imbalance": lambda s, sf: counts.class_imbalance(bind.long(s, sf)),
        "type_counts": lambda s, sf: counts.type_counts(bind.long(s, sf)),
        "samples_per_subject": lambda s, sf: counts.samples_per_subject(bind.long(s, sf)),
        "duplicate_samples": lambda s, sf: checks.duplicate_samples(bind.candidates(s, sf)),
        "duplicate_pairs": lambda s, sf: checks.duplicate_pairs(bind.undeduplicated_long(s, sf)),
        "domain_check": lambda s, sf: checks.domain_check(bind.long(s, sf), expected),
        "table_counts": _table_counts,
        "shared_values": _shared_values,
    }


# Distributions and rankings


def _restricted(spark: SparkSession, sf: str) -> DataFrame:
    long = bind.long(spark, sf)
    wanted = ranking.by_variability(ranking.variability(long), 10)
    return _r4(prepare.restrict_features(long, wanted).select(R.sample, R.feature, R.value), R.value)


def _moments(spark: SparkSession, sf: str) -> DataFrame:
    """Moments stored per project, a part of its own, and merged to classes: what the reports of this kind read."""
    path = _scratch(spark)
    by_project = moments.feature_moments(bind.long(spark, sf), [R.project])
    by_project.write.partitionBy(R.project).parquet(path)
    return moments.merge_moments(spark.read.parquet(path), [R.cls, R.feature, R.feature_name])


def _variable_by_moments(spark: SparkSession, sf: str) -> DataFrame:
    top = ranking.by_variability(moments.variability_of(_moments(spark, sf)), 5000)
    return _r4(top, "media_global", "sd_entre_clases", "rango_entre_clases")


def _scaler_deviations(spark: SparkSession, sf: str) -> DataFrame:
    stored = _moments(spark, sf)
    n_samples = bind.samples(spark, sf).count()
    return _r4(moments.scaler_deviations(stored, n_samples), "sd")


def _sketches(spark: SparkSession, sf: str, long: DataFrame) -> DataFrame:
    path = _scratch(spark)
    moments.value_sketches(long).write.parquet(path)
    return spark.read.parquet(path)


def _sketch_rank_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Quartiles of merged sketches against exact ranks: how many rows there are, and whether each is inside the bound."""
    long = bind.long(spark, sf)
    found = moments.quantiles_of(_sketches(spark, sf, long), profiles.QUARTILES, [R.cls])
    errors = moments.rank_errors(long, found, profiles.QUARTILES)
    return errors.select(R.cls, "quantile", "n", (F.col("rank_error") <= moments.RANK_BOUND).alias("within_bound"))


def _distributions() -> dict[str, Query]:
    return {
        "quality_by_moments": lambda s, sf: moments.quality_of(_moments(s, sf)),
        "variable_by_moments": _variable_by_moments,
        "top_by_moments": lambda s, sf: moments.top_features_of(_moments(s, sf)),
        "scaler_deviations": _scaler_deviations,
        "sketch_rank_errors": _sketch_rank_errors,
        "quality": lambda s, sf: profiles.quality(bind.long(s, sf)),
        "detected_features": lambda s, sf: profiles.detected_features(bind.long(s, sf)),
        "value_stats": lambda s, sf: profiles.value_stats(bind.long(s, sf), exact=True),
        "value_stats_approx": lambda s, sf: profiles.value_stats(bind.long(s, sf)),
        "top_features": lambda s, sf: ranking.top_features(bind.long(s, sf)),
        "variable_features": lambda s, sf: ranking.variable_features(bind.long(s, sf)),
        "top_variable": lambda s, sf: ranking.variable_features(bind.long(s, sf), 20),
        "restrict_features": _restricted,
    }


# Matrix and split


def _features(long: DataFrame) -> list[str]:
    return ranking.select_features(ranking.variability(long), 25)


def _wide(spark: SparkSession, sf: str) -> DataFrame:
    long = bind.long(spark, sf)
    features = _features(long)
    return _r4(matrix.to_matrix(long, features, unique=True), *features)


def _vectors(spark: SparkSession, sf: str) -> DataFrame:
    """The vector form, its cells spread out again by feature name."""
    long = bind.long(spark, sf)
    features = _features(long)
    cells = matrix.to_vectors(long, features, unique=True).withColumn("cells", vector_values("features_raw"))
    named = [rounded(F.get("cells", F.lit(at)), 4).alias(f) for at, f in enumerate(features)]
    return cells.select(R.sample, R.subject, R.cls, *named)


def _split(spark: SparkSession, sf: str) -> DataFrame:
    rows = bind.samples(spark, sf).select(R.sample, R.subject, R.cls)
    return matrix.stratified_split(rows).select(R.sample, R.subject, R.cls, "split")


def _matrix() -> dict[str, Query]:
    return {
        "matrix": _wide,
        "matrix_vectors": _vectors,
        "stratified_split": _split,
        "take_split": lambda s, sf: matrix.take_split(_split(s, sf), "validation"),
        "split_counts": lambda s, sf: counts.split_counts(_split(s, sf)),
        "leakage_check": lambda s, sf: checks.leakage_check(_split(s, sf)),
    }


# Evaluation

_SCORES = [
    "accuracy", "balanced_accuracy", "precision_macro", "recall_macro", "f1_macro", "precision_weighted",
    "recall_weighted", "f1_weighted", "roc_auc_macro_ovr", "pr_auc_macro_ovr",
]
_GAPS = ["gap_f1_macro_train_validation", "gap_accuracy_train_validation"]
_REPORTED = [s for s in _SCORES if not s.endswith("weighted")] + _GAPS[:1]


def _metrics(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.metrics_table(bind.scored_splits(spark, sf), N_LABELS)


def _stacked(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics of each scorer on its own, stacked, with the gaps added afterwards."""
    rows = bind.scored_splits(spark, sf)
    one_by_one = [
        evaluate.metrics_table(rows.filter(F.col("modelo") == m), N_LABELS, gaps=False) for m in ("score", "reversed")
    ]
    return evaluate.overfit_gap(evaluate.stack_metrics(one_by_one)).select("modelo", "split", *_GAPS)


def _report(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.class_report(bind.scored(spark, sf), bind.LABELS)


def _points(kind: Callable, *columns: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        rows = bind.scored(spark, sf)
        return _r4(kind(rows, bind.LABELS, evaluate.top_support(rows)), *columns)

    return query


def _errors(spark: SparkSession, sf: str) -> DataFrame:
    table = evaluate.prediction_table(bind.scored(spark, sf), bind.LABELS)
    return evaluate.top_errors(table, R.cls, "cancer_predicho")


def _evaluation() -> dict[str, Query]:
    def on_scored(operator: Callable, *columns: str) -> Query:
        return lambda s, sf: _r4(operator(bind.scored(s, sf), N_LABELS), *columns)

    prf = [f"{score}_{kind}" for kind in ("macro", "weighted") for score in ("precision", "recall", "f1")]
    return {
        "accuracy_metrics": lambda s, sf: _r4(
            evaluate.accuracy_metrics(bind.scored(s, sf)), "accuracy", "balanced_accuracy"
        ),
        "prf_metrics": on_scored(evaluate.prf_metrics, *prf),
        "confusion": lambda s, sf: evaluate.confusion(bind.scored(s, sf), bind.LABELS),
        "confusion_wide": lambda s, sf: evaluate.confusion_wide(
            evaluate.confusion(bind.scored(s, sf), bind.LABELS), bind.LABELS
        ),
        "class_report": lambda s, sf: _r4(_report(s, sf), "precision", "recall", "f1-score", "support"),
        "top_errors": _errors,
        "prediction_table": lambda s, sf: evaluate.prediction_table(bind.scored(s, sf), bind.LABELS),
        "roc_auc_ovr": on_scored(curves.roc_auc_ovr, "roc_auc_macro_ovr"),
        "average_precision_ovr": on_scored(curves.average_precision_ovr, "pr_auc_macro_ovr"),
        "rank_metrics_by_class": on_scored(curves.rank_metrics_by_class, "roc_auc", "average_precision", "pr_area"),
        "roc_points": _points(curves.roc_points, "fpr", "tpr"),
        "roc_corners": _points(partial(curves.roc_points, corners=True), "fpr", "tpr"),
        "pr_points": _points(curves.pr_points, "recall", "precision"),
        "curve_areas": _points(curves.curve_areas, "roc_auc", "pr_auc"),
        "metrics_table": lambda s, sf: _r4(_metrics(s, sf), *_SCORES, *_GAPS),
        "overfit_gap": lambda s, sf: _r4(_stacked(s, sf), *_GAPS),
        "select_best": lambda s, sf: _r4(evaluate.select_best(_metrics(s, sf)), *_SCORES, *_GAPS),
        "metrics_report": lambda s, sf: _r4(evaluate.metrics_report(_metrics(s, sf)), *_REPORTED),
    }


# Intake


def _new_samples(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as uploaded rows: text values, some no numbers, some null, some without subject."""
    number = F.col("l_linenumber")
    return bind.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias(R.sample),
        F.when(F.col("l_orderkey") % 5 != 0, F.col("l_suppkey").cast("string")).alias(R.subject),
        F.concat(F.lit("g"), number).alias(R.feature),
        F.when(number == 7, "n/a")
        .when(F.round(F.col("l_tax") * 100) != 8, F.col("l_extendedprice").cast("string"))
        .alias(R.value),
    )


def _new_samples_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = _scratch(spark)
    exports.export_csv(_new_samples(spark, sf), path)
    return _r4(intake.clean_new_samples(new_files.read_new_samples(spark, path)), R.value)


def _validated(spark: SparkSession, sf: str) -> DataFrame:
    lists = ("errores", "advertencias", "columnas")
    report = intake.validate_new_samples(_new_samples(spark, sf))
    return report.withColumns({c: F.concat_ws("|", c) for c in lists})


def _preview(spark: SparkSession, sf: str) -> DataFrame:
    rows = bind.samples(spark, sf).select(R.file, R.case_submitter, R.sample)
    return intake.preview(rows, 300, [R.sample])


def _by_alias(spark: SparkSession, sf: str) -> DataFrame:
    targets = {
        "clase": ["clase", "cancer_type"], "bytes": ["size"], "proyecto": ["Proyecto", "project"], "nada": ["zzz"],
    }
    return intake.select_by_alias(bind.metadata(spark, sf).select(R.cls, R.file_size, R.project), targets)


def _standardized(spark: SparkSession, sf: str) -> DataFrame:
    named = bind.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("Clave del  Cliente"), F.col("c_name").alias("¡Nómbre!")
    )
    return intake.standardize_columns(named)


def _intake() -> dict[str, Query]:
    return {
        "validate_new_samples": _validated,
        "clean_new_samples": lambda s, sf: _r4(intake.clean_new_samples(_new_samples(s, sf)), R.value),
        "new_samples_csv": _new_samples_csv,
        "to_numeric": lambda s, sf: _r4(
            intake.to_numeric(_new_samples(s, sf), R.value).select(R.sample, R.feature, R.value), R.value
        ),
        "profile_columns": lambda s, sf: intake.profile_columns(bind.table(s, sf, "events")),
        "preview": _preview,
        "select_by_alias": _by_alias,
        "standardize_columns": _standardized,
    }


# Feeds


def _kpis(spark: SparkSession, sf: str) -> DataFrame:
    long, folder = bind.long(spark, sf), _scratch(spark)
    class_counts = counts.class_counts(long)
    exports.export_tables(
        {"refined_conteo_clases": class_counts, "refined_calidad_datos": profiles.quality(long)}, folder
    )
    status = table_sources.table_status(spark, "csv", folder)
    wide = matrix.to_matrix(long, _features(long))
    return feeds.kpis(status, table_sources.load_refined(spark, "conteo_clases", "csv", folder), wide, _metrics(spark, sf))


def _feeds() -> dict[str, Query]:
    return {
        "kpis": _kpis,
        "class_feed": lambda s, sf: feeds.class_feed(counts.class_counts(bind.long(s, sf)), 20),
        "model_feed": lambda s, sf: _r4(feeds.model_feed(_metrics(s, sf)), "f1_macro"),
        "accuracy_feed": lambda s, sf: _r4(feeds.accuracy_feed(_metrics(s, sf)), "balanced_accuracy"),
        "value_feed": lambda s, sf: feeds.value_feed(profiles.value_stats(bind.long(s, sf))),
        "feature_feed": lambda s, sf: feeds.feature_feed(ranking.top_features(bind.long(s, sf))),
        "feature_feed_class": lambda s, sf: feeds.feature_feed(ranking.top_features(bind.long(s, sf)), "BUILDING"),
        "class_list": lambda s, sf: feeds.class_list(ranking.top_features(bind.long(s, sf))),
        "class_f1_feed": lambda s, sf: _r4(
            feeds.class_f1_feed(_report(s, sf)), "precision", "recall", "f1-score", "support"
        ),
        "missing_feed": lambda s, sf: feeds.missing_feed(profiles.quality(bind.long(s, sf))),
        "variable_feed": lambda s, sf: feeds.variable_feed(ranking.variable_features(bind.long(s, sf))),
    }


# Models


def _train_compare(spark: SparkSession, sf: str) -> DataFrame:
    values = reliable(bind.document_values(spark, sf))
    return modelling.compare_models(values, n_features=15).metrics


def _score_new(spark: SparkSession, sf: str) -> DataFrame:
    """Train on the labelled documents, store and load the model, score all documents as if without a label.

    The probabilities are written as ten-thousandths in label order.
    """
    values, path = reliable(bind.document_values(spark, sf)), _scratch(spark)
    compared = modelling.compare_models(values, n_features=15, names=["NaiveBayes"])
    storage.save_model(spark, training.pick(compared.models, "NaiveBayes"), path, compared.features)
    uploaded = values.select(R.sample, R.subject, R.feature, F.col(R.value).cast("string").alias(R.value))
    scored = scoring.score_new(uploaded, storage.load_model(path), storage.load_features(spark, path))
    shown = F.transform("probability_array", lambda p: F.round(p * 10_000).cast("bigint").cast("string"))
    return _r4(scored, "probabilidad_predicha").withColumn("probability_array", F.array_join(shown, "|"))


def _bayes_statistics(spark: SparkSession, sf: str) -> DataFrame:
    """Priors and feature shares of the multinomial model as the trained pipeline holds them, one row per class and feature."""
    compared = modelling.compare_models(reliable(bind.document_values(spark, sf)), n_features=15, names=["NaiveBayes"])
    found = bayes.model_statistics(training.pick(compared.models, "NaiveBayes"), compared.features, spark)
    return _r4(found, "log_prior", "log_share")


def _bayes_aggregates(spark: SparkSession, sf: str) -> DataFrame:
    """The same by aggregates over the long table, without the matrix."""
    values = reliable(bind.document_values(spark, sf))
    features = ranking.select_features(ranking.variability(values), 15)
    train = matrix.take_split(matrix.stratified_split(prepare.restrict_features(values, features)), "train")
    return _r4(bayes.naive_bayes_statistics(train, features), "log_prior", "log_share")


def _train_invariants(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per model and split, and whether all of them have a probability per class, a sum of 1, and the class of the
    greatest one as prediction."""
    compared = modelling.compare_models(reliable(bind.document_values(spark, sf)), n_features=15)
    p = F.col("probability")
    total = F.aggregate(p, F.lit(0.0), lambda a, x: a + x)
    return compared.predictions.groupBy("modelo", "split").agg(
        F.count("*").alias("n"),
        F.every(F.size(p) == len(compared.labels)).alias("one_per_class"),
        F.every(F.abs(total - 1) < 1e-9).alias("sum_is_one"),
        F.every(F.element_at(p, F.col("prediction") + 1) == F.array_max(p)).alias("prediction_is_greatest"),
    )


def _unknown_classes(spark: SparkSession, sf: str) -> DataFrame:
    """All documents of the first source as the only subject of a class, which so falls to the test split and cannot be
    scored."""
    documents = bind.table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias(R.sample), "source")
    first = documents.agg(F.min("source").alias("source"))
    rare = documents.join(F.broadcast(first), "source").select(R.sample).withColumn("_rare", F.lit(True))
    values = bind.document_values(spark, sf).join(rare, R.sample, "left")
    is_rare = F.coalesce("_rare", F.lit(False))
    values = values.withColumns({
        R.cls: F.when(is_rare, "rare").otherwise(F.col(R.cls)), R.subject: F.when(is_rare, "rare-0").otherwise(F.col(R.subject)),
    })
    return modelling.compare_models(reliable(values.drop("_rare")), n_features=15, names=["NaiveBayes"]).unknown


def _models() -> dict[str, Query]:
    return {
        "train_compare": _train_compare, "score_new": _score_new, "unknown_classes": _unknown_classes,
        "bayes_statistics": _bayes_statistics, "bayes_aggregates": _bayes_aggregates, "train_invariants": _train_invariants,
    }
