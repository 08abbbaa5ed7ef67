"""The registered queries as SQL for DuckDB, written over the same parquet tables."""

from __future__ import annotations

_META = """
meta AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS file_id, 'order-' || o_orderkey || '.tsv' AS file_name,
         CAST(round(o_totalprice * 100) AS BIGINT) AS file_size, 'case-' || o_custkey AS case_id,
         CASE WHEN o_custkey % 7 <> 0 THEN c_name END AS case_submitter_id,
         o_custkey || '-' || substr(o_orderpriority, 1, 1) AS sample_id,
         c_name || '-' || substr(o_orderpriority, 1, 1) AS sample_submitter_id,
         o_orderpriority AS sample_type, 'SEG-' || c_mktsegment AS project_id,
         c_mktsegment AS cancer_type, lower(c_mktsegment) AS cancer_name
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

_CLEAN = """
meas AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS file_id,
         CASE WHEN l_linenumber = 7 THEN 'N_unmapped' ELSE p_brand || '.' || l_linenumber END AS gene_id,
         lower(p_brand) AS gene_name,
         CASE WHEN l_returnflag = 'A' THEN 'lncRNA' ELSE 'protein_coding' END AS gene_type,
         CASE WHEN round(l_tax * 100) = 8 THEN NULL WHEN l_discount = 0 THEN 0e0 ELSE l_extendedprice / 1000 END AS tpm,
         '/raw/' || l_orderkey || '.tsv' AS source_file
  FROM lineitem JOIN part ON l_partkey = p_partkey),
clean AS (
  SELECT file_id, split_part(gene_id, '.', 1) AS gene_id_base, gene_name, gene_type,
         coalesce(tpm, 0e0) AS tpm_unstranded, log2(coalesce(tpm, 0e0) + 1) AS log2_tpm, source_file
  FROM meas WHERE gene_id NOT LIKE 'N\\_%' ESCAPE '\\' AND gene_type = 'protein_coding')"""

_CHOSEN = f"""{_META},{_CLEAN},
official AS (
  SELECT *, coalesce(case_submitter_id, substr(sample_submitter_id, 1, 18), sample_id) AS patient_id
  FROM meta WHERE cancer_type IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')
    AND lower(sample_type) LIKE '%i%'),
cand AS (SELECT DISTINCT * FROM official WHERE file_id IN (SELECT file_id FROM clean)),
samples AS (
  SELECT * EXCLUDE (nth) FROM (
    SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY file_size DESC NULLS LAST, file_id) AS nth FROM cand)
  WHERE nth = 1)"""

_SAMPLE_COLUMNS = """file_id, file_name, file_size, case_id, case_submitter_id, sample_id, sample_submitter_id,
  patient_id, sample_type, project_id, cancer_type, cancer_name"""

_LONG = f"""{_CHOSEN},
joined AS (SELECT * FROM clean JOIN samples USING (file_id)),
long AS (
  SELECT {_SAMPLE_COLUMNS}, gene_id_base, min(gene_name) AS gene_name, min(gene_type) AS gene_type,
         avg(tpm_unstranded) AS tpm_unstranded, avg(log2_tpm) AS log2_tpm, min(source_file) AS source_file
  FROM joined GROUP BY {_SAMPLE_COLUMNS}, gene_id_base)"""

_ROUNDED_LONG = f"""SELECT {_SAMPLE_COLUMNS}, gene_id_base, gene_name, gene_type,
  round(tpm_unstranded, 8) AS tpm_unstranded, round(log2_tpm, 4) AS log2_tpm, source_file FROM """

_QUALITY = """
quality AS (
  SELECT cancer_type, count(*) AS n_registros, count(*) FILTER (log2_tpm IS NULL) AS n_log2_tpm_null,
         count(*) FILTER (tpm_unstranded IS NULL) AS n_tpm_null, count(*) FILTER (tpm_unstranded = 0) AS n_tpm_cero,
         round(100 * count(*) FILTER (tpm_unstranded = 0) / count(*), 2) AS pct_tpm_cero
  FROM long GROUP BY cancer_type)"""

_CLASS_COUNTS = """
counts AS (
  SELECT cancer_type, cancer_name, count(DISTINCT sample_id) AS n_muestras, count(DISTINCT patient_id) AS n_pacientes
  FROM long GROUP BY cancer_type, cancer_name)"""

_TOP = """
means AS (
  SELECT cancer_type, gene_id_base, gene_name, avg(log2_tpm) AS m FROM long GROUP BY ALL),
top AS (
  SELECT cancer_type, rank_gen, gene_id_base, gene_name, round(m, 4) AS avg_log2_tpm FROM (
    SELECT *, row_number() OVER (PARTITION BY cancer_type ORDER BY m DESC, gene_id_base, gene_name) AS rank_gen
    FROM means)
  WHERE rank_gen <= 10)"""

_VARIABLE = """
class_means AS (
  SELECT gene_id_base, gene_name, cancer_type, avg(log2_tpm) AS m FROM long GROUP BY ALL),
variable AS (
  SELECT gene_id_base, gene_name, avg(m) AS media, stddev_samp(m) AS sd, max(m) - min(m) AS rango
  FROM class_means GROUP BY ALL)"""

_SPLIT = """
subjects AS (SELECT DISTINCT patient_id, cancer_type FROM samples),
share AS (
  SELECT patient_id, cancer_type,
         CAST(row_number() OVER (PARTITION BY cancer_type ORDER BY md5(patient_id || '-42'), patient_id) AS DOUBLE)
           / count(*) OVER (PARTITION BY cancer_type) AS share
  FROM subjects),
parts AS (
  SELECT patient_id, cancer_type,
         CASE WHEN share <= 7e-1 THEN 'train' WHEN share <= 85e-2 THEN 'validation' ELSE 'test' END AS split
  FROM share),
split_samples AS (SELECT sample_id, patient_id, cancer_type, split FROM samples JOIN parts USING (patient_id, cancer_type))"""

_SCORES = """[list_sum([CAST(floor(CAST(x AS DOUBLE) * 1000000) AS BIGINT) FOR x, i IN embedding IF (i - 1) % 10 = k])::DOUBLE / 1000000
  FOR k IN range(10)]"""

_SCORED = """
rows AS (SELECT vec_id, label, """ + _SCORES + """ AS probability FROM embeddings),
pred AS (
  SELECT 'score' AS modelo, 'all' AS split, vec_id, label,
         list_position(probability, list_max(probability)) - 1 AS prediction, probability FROM rows)"""

_SCORED_SPLITS = """
rows AS (
  SELECT vec_id, label, """ + _SCORES + """ AS probability,
         CASE WHEN substr(md5(CAST(vec_id AS VARCHAR)), 1, 2) < 'b3' THEN 'train'
              WHEN substr(md5(CAST(vec_id AS VARCHAR)), 1, 2) < 'd9' THEN 'validation' ELSE 'test' END AS split
  FROM embeddings),
pred AS (
  SELECT 'score' AS modelo, split, vec_id, label,
         list_position(probability, list_max(probability)) - 1 AS prediction, probability FROM rows
  UNION ALL
  SELECT 'reversed', split, vec_id, label, list_position(probability, list_min(probability)) - 1,
         [-x FOR x IN probability] FROM rows)"""

_GROUPS = """
grp AS (SELECT DISTINCT modelo, split FROM pred),
label_dim AS (SELECT CAST(range AS INTEGER) AS k FROM range(10))"""

_CLASS_SCORES = f"""{_GROUPS},
tallies AS (
  SELECT modelo, split, k,
         (SELECT count(*) FROM pred p WHERE p.modelo = g.modelo AND p.split = g.split AND label = k AND prediction = k) AS tp,
         (SELECT count(*) FROM pred p WHERE p.modelo = g.modelo AND p.split = g.split AND label = k) AS support,
         (SELECT count(*) FROM pred p WHERE p.modelo = g.modelo AND p.split = g.split AND prediction = k) AS predicted
  FROM grp g, label_dim),
scores AS (
  SELECT modelo, split, k, support, CASE WHEN predicted = 0 THEN 0e0 ELSE tp / predicted END AS precision,
         CASE WHEN support = 0 THEN 0e0 ELSE tp / support END AS recall,
         CASE WHEN support + predicted = 0 THEN 0e0 ELSE 2 * tp / (support + predicted) END AS f1
  FROM tallies),
prf AS (
  SELECT modelo, split, avg(precision) AS precision_macro, avg(recall) AS recall_macro, avg(f1) AS f1_macro,
         sum(precision * support) / sum(support) AS precision_weighted,
         sum(recall * support) / sum(support) AS recall_weighted, sum(f1 * support) / sum(support) AS f1_weighted
  FROM scores GROUP BY ALL),
acc AS (
  SELECT modelo, split, sum(hits) / sum(n) AS accuracy, avg(hits / n) AS balanced_accuracy FROM (
    SELECT modelo, split, label, count(*) AS n, count(*) FILTER (label = prediction) AS hits FROM pred GROUP BY ALL)
  GROUP BY ALL)"""

_RANKED = """
one_vs_rest AS (
  SELECT modelo, split, CAST(range AS INTEGER) AS k, probability[range + 1] AS score, label FROM pred, range(10)),
tied AS (
  SELECT modelo, split, k, score, count(*) FILTER (label = k) AS p, count(*) FILTER (label <> k) AS q
  FROM one_vs_rest GROUP BY ALL),
ranked AS (
  SELECT *, CAST(sum(p) OVER w AS DOUBLE) AS tp, CAST(sum(q) OVER w AS DOUBLE) AS fp,
         CAST(sum(p) OVER (PARTITION BY modelo, split, k) AS DOUBLE) AS np,
         CAST(sum(q) OVER (PARTITION BY modelo, split, k) AS DOUBLE) AS nq
  FROM tied WINDOW w AS (PARTITION BY modelo, split, k ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
areas AS (
  SELECT modelo, split, k,
         CASE WHEN max(np) > 0 AND max(nq) > 0 THEN sum(q * (2 * tp - p)) / (2 * max(np) * max(nq)) END AS roc_auc,
         CASE WHEN max(np) > 0 AND max(nq) > 0 THEN sum(p * tp / (tp + fp)) / max(np) END AS average_precision,
         CASE WHEN max(np) > 0 AND max(nq) > 0 THEN
           sum(p * (tp / (tp + fp) + CASE WHEN tp - p + fp - q = 0 THEN 1e0 ELSE (tp - p) / (tp - p + fp - q) END) / 2)
           / max(np) END AS pr_area
  FROM ranked GROUP BY ALL),
auc AS (
  SELECT modelo, split, CASE WHEN count(roc_auc) = 10 THEN avg(roc_auc) END AS roc_auc_macro_ovr,
         CASE WHEN count(average_precision) = 10 THEN avg(average_precision) END AS pr_auc_macro_ovr
  FROM areas GROUP BY ALL)"""

_TOP_SUPPORT = """
top_support AS (
  SELECT modelo, split, k FROM (
    SELECT modelo, split, label AS k, row_number() OVER (PARTITION BY modelo, split ORDER BY count(*) DESC, label) AS nth
    FROM pred GROUP BY modelo, split, label)
  WHERE nth <= 6)"""

_METRIC_COLUMNS = [
    "accuracy", "balanced_accuracy", "precision_macro", "recall_macro", "f1_macro", "precision_weighted",
    "recall_weighted", "f1_weighted", "roc_auc_macro_ovr", "pr_auc_macro_ovr", "gap_f1_macro_train_validation",
    "gap_accuracy_train_validation",
]

_METRICS = f"""{_SCORED_SPLITS},{_CLASS_SCORES},{_RANKED},
plain AS (SELECT * FROM acc JOIN prf USING (modelo, split) JOIN auc USING (modelo, split)),
gaps AS (
  SELECT t.modelo, t.f1_macro - v.f1_macro AS gap_f1_macro_train_validation,
         t.accuracy - v.accuracy AS gap_accuracy_train_validation
  FROM plain t JOIN plain v ON t.modelo = v.modelo AND t.split = 'train' AND v.split = 'validation'),
metrics AS (SELECT * FROM plain LEFT JOIN gaps USING (modelo))"""


def _rounded(columns) -> str:
    return ", ".join(f"round({c}, 4) AS {c}" for c in columns)


_REPORT = f"""{_SCORED},{_CLASS_SCORES},
report AS (
  SELECT modelo, split, 'c' || k AS clase, precision, recall, f1, CAST(support AS DOUBLE) AS support FROM scores
  UNION ALL SELECT modelo, split, 'accuracy', accuracy, accuracy, accuracy, accuracy FROM acc
  UNION ALL SELECT modelo, split, 'macro avg', precision_macro, recall_macro, f1_macro,
    (SELECT CAST(sum(support) AS DOUBLE) FROM scores s WHERE s.modelo = prf.modelo AND s.split = prf.split) FROM prf
  UNION ALL SELECT modelo, split, 'weighted avg', precision_weighted, recall_weighted, f1_weighted,
    (SELECT CAST(sum(support) AS DOUBLE) FROM scores s WHERE s.modelo = prf.modelo AND s.split = prf.split) FROM prf)"""

_REPORT_COLUMNS = """modelo, split, clase, round(precision, 4) AS precision, round(recall, 4) AS recall,
  round(f1, 4) AS "f1-score", round(support, 4) AS support"""

_STATS = """
stats AS (
  SELECT cancer_type, count(*) AS n_registros, round(avg(log2_tpm), 4) AS media_log2_tpm,
         round(stddev_samp(log2_tpm), 4) AS sd_log2_tpm, round(min(log2_tpm), 4) AS min_log2_tpm,
         round(quantile_disc(log2_tpm, 0.25), 4) AS q1_log2_tpm, round(quantile_disc(log2_tpm, 0.5), 4) AS mediana_log2_tpm,
         round(quantile_disc(log2_tpm, 0.75), 4) AS q3_log2_tpm, round(max(log2_tpm), 4) AS max_log2_tpm
  FROM long GROUP BY cancer_type)"""

_INTAKE = """
intake AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS sample_id,
         CASE WHEN l_orderkey % 5 <> 0 THEN CAST(l_suppkey AS VARCHAR) END AS patient_id,
         'g' || l_linenumber AS gene_id_base,
         CASE WHEN l_linenumber = 7 THEN 'n/a' WHEN round(l_tax * 100) <> 8 THEN CAST(l_extendedprice AS VARCHAR) END
           AS log2_tpm
  FROM lineitem)"""

_HITS = """
flat AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS file_id, 'order-' || o_orderkey || '.tsv' AS file_name,
         CAST(round(o_totalprice * 100) AS BIGINT) AS file_size, 'case-' || o_custkey AS case_id,
         c_name AS case_submitter_id,
         CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey || '-' || substr(o_orderpriority, 1, 1) END AS sample_id,
         CASE WHEN o_orderkey % 5 <> 0 THEN c_name || '-' || substr(o_orderpriority, 1, 1) END AS sample_submitter_id,
         CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS sample_type,
         'SEG-' || c_mktsegment AS project_id,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN 'DESCONOCIDO' ELSE c_mktsegment END AS cancer_type,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN 'DESCONOCIDO' ELSE lower(c_mktsegment) END AS cancer_name
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 11 <> 0)"""

_MANIFEST = f"""{_META},{_CLEAN},
listing AS (
  SELECT file_id, source_file AS path, CAST(sum(CASE WHEN tpm_unstranded > 0 THEN 1 ELSE 0 END) AS BIGINT) AS length
  FROM clean GROUP BY file_id, source_file),
manifest AS (
  SELECT file_id, file_name,
         CASE WHEN length > 0 THEN 'present' WHEN length IS NOT NULL THEN 'empty' ELSE 'missing' END AS estado_descarga,
         path AS ruta_local
  FROM meta LEFT JOIN listing USING (file_id))"""

# Letters of whole documents as features, the 15 most variable ones, the split, and the multinomial model of its train part.
_LETTERS = """
letters AS (
  SELECT doc_id, lang, letter, log2(count(*) + 1) AS v
  FROM (SELECT doc_id, lang, unnest(string_split(lower(text), '')) AS letter FROM documents)
  WHERE regexp_matches(letter, '^\\p{L}$') GROUP BY ALL),
features AS (
  SELECT letter, row_number() OVER (ORDER BY sd DESC NULLS LAST, code) AS place, code FROM (
    SELECT letter, 'ch_' || printf('%04X', unicode(letter)) AS code, stddev_samp(m) AS sd
    FROM (SELECT letter, lang, avg(v) AS m FROM letters GROUP BY ALL) GROUP BY letter)
  QUALIFY place <= 15),
cells AS (
  SELECT doc_id, concat_ws('-', lang, doc_id // 3) AS patient_id, lang AS cancer_type, code, v FROM letters JOIN features USING (letter)),
subjects AS (SELECT DISTINCT patient_id, cancer_type FROM cells),
parts AS (
  SELECT patient_id, cancer_type, CASE WHEN share <= 7e-1 THEN 'train' WHEN share <= 85e-2 THEN 'validation' ELSE 'test' END AS split
  FROM (SELECT *, CAST(row_number() OVER (PARTITION BY cancer_type ORDER BY md5(patient_id || '-42'), patient_id) AS DOUBLE)
               / count(*) OVER (PARTITION BY cancer_type) AS share FROM subjects)),
split_cells AS (SELECT * FROM cells JOIN parts USING (patient_id, cancer_type)),
classes AS (
  SELECT cancer_type, n, row_number() OVER (ORDER BY n DESC, cancer_type) - 1 AS label,
         ln((n + 1) / (sum(n) OVER () + count(*) OVER ())) AS log_prior
  FROM (SELECT cancer_type, count(DISTINCT doc_id) AS n FROM split_cells WHERE split = 'train' GROUP BY ALL)),
shares AS (
  SELECT c.cancer_type, c.label, c.log_prior, f.code,
         ln((coalesce(total, 0e0) + 1) / (sum(coalesce(total, 0e0)) OVER (PARTITION BY c.cancer_type) + 15)) AS log_share
  FROM classes c CROSS JOIN features f LEFT JOIN (
    SELECT cancer_type, code, sum(v) AS total FROM split_cells WHERE split = 'train' GROUP BY ALL) USING (cancer_type, code)),
likely AS (
  SELECT c.doc_id, c.patient_id, s.label, s.cancer_type AS class, any_value(s.log_prior) + sum(c.v * s.log_share) AS ll
  FROM cells c JOIN shares s USING (code) GROUP BY ALL),
posterior AS (
  SELECT *, exp(ll - max(ll) OVER doc) / sum(exp(ll - top)) OVER doc AS p
  FROM (SELECT *, max(ll) OVER (PARTITION BY doc_id) AS top FROM likely) WINDOW doc AS (PARTITION BY doc_id))"""

_FROM_FILES = """
WITH keyed AS (
  SELECT *, md5(CAST(s_suppkey AS VARCHAR)) AS h, n_name || '-' || (s_suppkey % 3) AS sample FROM supplier
  JOIN nation ON s_nationkey = n_nationkey),
files AS (
  SELECT substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12)
           AS file_id, s_name AS file_name, CAST(round(s_acctbal * 100) AS BIGINT) AS file_size, 'case-' || s_name AS case_id,
         'case-' || sample AS case_submitter_id, sample AS sample_id, sample AS sample_submitter_id, 'case-' || sample AS patient_id,
         'Primary Tumor' AS sample_type, n_name AS project_id, n_name AS cancer_type, lower(n_name) AS cancer_name, s_suppkey
  FROM keyed WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem)),
chosen AS (
  SELECT * EXCLUDE (nth) FROM (
    SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY file_size DESC NULLS LAST, file_id) AS nth FROM files) WHERE nth = 1),
cells AS (
  SELECT l_suppkey, 'G' || l_linenumber AS gene_id_base, 'g' || l_linenumber AS gene_name,
         CASE WHEN round(l_tax * 100) = 8 THEN 0e0 ELSE l_extendedprice END AS v
  FROM lineitem WHERE l_linenumber <> 7 AND l_returnflag <> 'A')
SELECT c.* EXCLUDE (s_suppkey), gene_id_base, min(gene_name) AS gene_name, 'protein_coding' AS gene_type,
       round(avg(v), 8) AS tpm_unstranded, round(avg(log2(v + 1)), 4) AS log2_tpm
FROM cells JOIN chosen c ON l_suppkey = s_suppkey GROUP BY ALL"""

# Feature columns of the matrix: the 25 brands.
BRANDS = [f"Brand#{n}" for n in range(1, 26)]
_MATRIX = ", ".join(
    f"coalesce(avg(log2_tpm) FILTER (gene_id_base = '{b}'), 0e0) AS \"{b}\"" for b in BRANDS
)
_MATRIX_ROUNDED = ", ".join(f'round("{b}", 4) AS "{b}"' for b in BRANDS)
_CONFUSION_WIDE = ", ".join(f"count(*) FILTER (prediction = {k}) AS c{k}" for k in range(10))

_PAIR = """(SELECT count(*) FROM (SELECT patient_id FROM split_samples WHERE split = '{a}'
  INTERSECT SELECT patient_id FROM split_samples WHERE split = '{b}')) AS {a}_{b}"""

_EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
_NUMBER_TEXT = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"
_PROFILE = " UNION ALL ".join(
    f"""SELECT '{c}' AS columna, count(*) FILTER (regexp_matches(CAST({c} AS VARCHAR), '{_NUMBER_TEXT}')) AS n_numeric
    FROM events"""
    for c in _EVENT_COLUMNS
)


def _with(frames: str, query: str) -> str:
    return f"WITH {frames}\n{query}"


def oracle_sql() -> dict[str, str]:
    top_f1 = f"""SELECT {_REPORT_COLUMNS} FROM (
        SELECT * FROM report WHERE clase NOT IN ('accuracy', 'macro avg', 'weighted avg')
        ORDER BY f1 DESC, clase LIMIT 10)"""
    found = {
        # raw to trusted
        "flatten_metadata": _with(_HITS, "SELECT * FROM flat"),
        "select_files": _with(
            _HITS,
            """SELECT file_id, project_id FROM flat WHERE project_id IN ('SEG-BUILDING', 'SEG-FURNITURE')
            AND CAST(file_id AS BIGINT) % 2 = 0""",
        ),
        "file_ids": """
            WITH h AS (SELECT o_orderkey, md5(CAST(o_orderkey AS VARCHAR)) AS h FROM orders)
            SELECT o_orderkey, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-'
              || substr(h, 17, 4) || '-' || substr(h, 21, 12) AS file_id FROM h""",
        "class_lookup": _with(
            _META,
            """SELECT file_id, CASE WHEN cancer_type = 'MACHINERY' THEN 'DESCONOCIDO' ELSE cancer_type END AS code,
              CASE WHEN cancer_type = 'MACHINERY' THEN 'DESCONOCIDO' ELSE cancer_name END AS name FROM meta""",
        ),
        "official_samples": _with(_CHOSEN, f"SELECT {_SAMPLE_COLUMNS} FROM official"),
        "clean_measurements": _with(
            _CLEAN,
            """SELECT file_id, gene_id_base, gene_name, gene_type, round(tpm_unstranded, 8) AS tpm_unstranded,
              round(log2_tpm, 4) AS log2_tpm FROM clean""",
        ),
        "attach_metadata": _with(_CHOSEN, _ROUNDED_LONG + "clean JOIN official USING (file_id)"),
        "candidate_samples": _with(_CHOSEN, f"SELECT {_SAMPLE_COLUMNS} FROM cand"),
        "dedupe_samples": _with(_CHOSEN, f"SELECT {_SAMPLE_COLUMNS} FROM samples"),
        "keep_selected": _with(_LONG, _ROUNDED_LONG + "joined"),
        "trusted_long": _with(_LONG, _ROUNDED_LONG + "long"),
        "enforce_grain": _with(_LONG, _ROUNDED_LONG + "long"),
        "feature_dictionary": _with(_LONG, "SELECT DISTINCT gene_id_base, gene_name, gene_type FROM long"),
        "ingest_manifest": _with(_MANIFEST, "SELECT * FROM manifest"),
        "manifest_states": _with(
            _MANIFEST, "SELECT estado_descarga, count(*) AS n_archivos FROM manifest GROUP BY estado_descarga"
        ),
        "stored_long": _with(_LONG, _ROUNDED_LONG + "long"),
        "registered_table": _with(_LONG, "SELECT cancer_type, count(*) AS n FROM long GROUP BY cancer_type"),
        "csv_export": _with(f"{_LONG},{_CLASS_COUNTS}", "SELECT * FROM counts"),
        "published_table": _with(f"{_LONG},{_CLASS_COUNTS}", "SELECT * FROM counts"),
        "table_status": _with(
            f"{_LONG},{_CLASS_COUNTS},{_TOP}",
            """SELECT 'calidad_datos' AS clave, 'refined_calidad_datos' AS tabla, 'csv' AS modo, FALSE AS existe,
              0 AS filas, 0 AS columnas
            UNION ALL SELECT 'conteo_clases', 'refined_conteo_clases', 'csv', TRUE, (SELECT count(*) FROM counts), 4
            UNION ALL SELECT 'expresion_global', 'refined_expresion_global', 'csv', FALSE, 0, 0
            UNION ALL SELECT 'resumen_general', 'refined_resumen_general', 'csv', FALSE, 0, 0
            UNION ALL SELECT 'top_genes', 'refined_top_genes_por_clase', 'csv', TRUE, (SELECT count(*) FROM top), 5
            UNION ALL SELECT 'metricas', 'refined_metricas_modelos_sparkml', 'csv', FALSE, 0, 0
            UNION ALL SELECT 'matriz_genes', 'refined_ml_matriz', 'csv', FALSE, 0, 0""",
        ),
        "metadata_json": _with(_HITS, "SELECT * FROM flat"),
        "metadata_csv": _with(_META, "SELECT * FROM meta WHERE lower(sample_type) LIKE '%i%'"),
        "metadata_csv_reordered": _with(
            _META,
            """SELECT * REPLACE (CAST(NULL AS VARCHAR) AS file_name, CAST(NULL AS VARCHAR) AS case_id)
            FROM meta WHERE lower(sample_type) LIKE '%i%'""",
        ),
        "score_new": _with(
            _LETTERS,
            """SELECT CAST(doc_id AS VARCHAR) AS sample_id, patient_id, arg_max(class, p) AS cancer_predicho,
              round(max(p), 4) AS probabilidad_predicha, CAST(arg_max(label, p) AS DOUBLE) AS prediction,
              string_agg(CAST(CAST(round(p * 10000) AS BIGINT) AS VARCHAR), '|' ORDER BY label) AS probability_array
            FROM posterior GROUP BY doc_id, patient_id""",
        ),
        "bayes_statistics": _with(
            _LETTERS,
            """SELECT cancer_type, CAST(label AS INTEGER) AS label, code AS gene_id_base, round(log_prior, 4) AS log_prior,
              round(log_share, 4) AS log_share FROM shares""",
        ),
        "train_invariants": _with(
            _LETTERS,
            """SELECT modelo, split, count(DISTINCT doc_id) AS n, TRUE AS one_per_class, TRUE AS sum_is_one,
              TRUE AS prediction_is_greatest
            FROM split_cells, (VALUES ('LogisticRegression'), ('RandomForest'), ('NaiveBayes')) AS m(modelo) GROUP BY ALL""",
        ),
        "unknown_classes": """
            SELECT 'rare' AS cancer_type, 'test' AS split, count(*) AS n FROM documents
            WHERE source = (SELECT min(source) FROM documents) AND regexp_matches(text, '\\p{L}')""",
        "measurement_files": """
            WITH h AS (
              SELECT md5(CAST(l_suppkey AS VARCHAR)) AS h, 'G' || l_linenumber AS gene_id_base,
                CASE WHEN round(l_tax * 100) = 8 THEN 0e0 ELSE l_extendedprice END AS v
              FROM lineitem WHERE l_linenumber <> 7 AND l_returnflag <> 'A')
            SELECT substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-'
              || substr(h, 21, 12) AS file_id, gene_id_base, count(*) AS n, round(sum(v), 4) AS tpm_unstranded,
              round(avg(log2(v + 1)), 4) AS log2_tpm
            FROM h GROUP BY ALL""",
        "trusted_from_files": _FROM_FILES,
        "ingest_by_manifest": _FROM_FILES,
        # counts and checks
        "summary": _with(
            _LONG,
            """SELECT (SELECT count(*) FROM long) AS n_registros_long,
              (SELECT count(DISTINCT sample_id) FROM long) AS n_muestras_long,
              (SELECT count(*) FROM samples) AS n_filas_samples,
              (SELECT count(DISTINCT sample_id) FROM samples) AS n_muestras_samples,
              (SELECT count(DISTINCT patient_id) FROM long) AS n_pacientes,
              (SELECT count(DISTINCT cancer_type) FROM long) AS n_clases,
              (SELECT count(DISTINCT gene_id_base) FROM long) AS n_genes_long,
              (SELECT count(DISTINCT gene_id_base) FROM long) AS n_genes_diccionario""",
        ),
        "consistency": _with(
            _LONG,
            """SELECT (SELECT count(DISTINCT sample_id) FROM long) AS muestras_unicas_long,
              (SELECT count(*) FROM samples) AS filas_samples,
              (SELECT count(DISTINCT sample_id) FROM samples) AS muestras_unicas_samples,
              (SELECT count(DISTINCT patient_id) FROM long) AS pacientes_unicos_long,
              (SELECT count(DISTINCT gene_id_base) FROM long) AS genes_unicos_long""",
        ),
        "cardinalities": _with(
            _LONG,
            """SELECT count(*) AS n_registros, count(DISTINCT sample_id) AS n_muestras,
              count(DISTINCT patient_id) AS n_pacientes, count(DISTINCT gene_id_base) AS n_genes FROM long""",
        ),
        "n_distinct": _with(_LONG, "SELECT count(DISTINCT patient_id) AS n FROM long"),
        "files_per_class": _with(_META, "SELECT cancer_type, count(*) AS n_archivos FROM meta GROUP BY cancer_type"),
        "samples_per_class": _with(
            _LONG, "SELECT cancer_type, count(DISTINCT sample_id) AS n_muestras FROM long GROUP BY cancer_type"
        ),
        "class_counts": _with(f"{_LONG},{_CLASS_COUNTS}", "SELECT * FROM counts"),
        "class_counts_samples": _with(
            _CHOSEN,
            """SELECT cancer_type, count(*) AS n_muestras, count(DISTINCT patient_id) AS n_pacientes
            FROM samples GROUP BY cancer_type""",
        ),
        "class_imbalance": _with(
            f"{_LONG}, c AS (SELECT cancer_type, count(DISTINCT sample_id) AS n FROM long GROUP BY cancer_type)",
            """SELECT cancer_type, n AS n_muestras, round(100 * n / (SELECT sum(n) FROM c), 2) AS porcentaje,
              round((SELECT max(n) / min(n) FROM c), 2) AS razon_desbalance_global FROM c""",
        ),
        "type_counts": _with(
            _LONG,
            """SELECT sample_type, count(DISTINCT sample_id) AS n_muestras, count(DISTINCT patient_id) AS n_pacientes
            FROM long GROUP BY sample_type""",
        ),
        "samples_per_subject": _with(
            _LONG,
            """SELECT cancer_type, count(*) AS n_pacientes, count(*) FILTER (n > 1) AS pacientes_con_mas_de_una_muestra,
              max(n) AS max_muestras_por_paciente
            FROM (SELECT patient_id, cancer_type, count(DISTINCT sample_id) AS n FROM long GROUP BY ALL)
            GROUP BY cancer_type""",
        ),
        "duplicate_samples": _with(
            _CHOSEN,
            """SELECT sample_id, count(*) AS n_filas, count(DISTINCT file_id) AS n_file_ids,
              count(DISTINCT patient_id) AS n_patient_ids, min(cancer_type) AS cancer_type
            FROM cand GROUP BY sample_id HAVING count(*) > 1""",
        ),
        "duplicate_pairs": _with(
            _LONG,
            "SELECT sample_id, gene_id_base, count(*) AS n_filas FROM joined GROUP BY ALL HAVING count(*) > 1",
        ),
        "domain_check": _with(
            _LONG,
            """SELECT 'AEROSPACE' AS cancer_type, 'missing' AS estado
               WHERE NOT EXISTS (SELECT 1 FROM long WHERE cancer_type = 'AEROSPACE')
            UNION ALL SELECT DISTINCT cancer_type, 'unexpected' FROM long
               WHERE cancer_type NOT IN ('AEROSPACE', 'AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD')""",
        ),
        "table_counts": _with(
            _LONG,
            """SELECT 'long' AS tabla, (SELECT count(*) FROM long) AS n_filas
            UNION ALL SELECT 'samples', (SELECT count(*) FROM samples)
            UNION ALL SELECT 'dictionary', (SELECT count(*) FROM (SELECT DISTINCT gene_id_base, gene_name, gene_type FROM long))""",
        ),
        # distributions and rankings
        "quality": _with(f"{_LONG},{_QUALITY}", "SELECT * FROM quality"),
        "detected_features": _with(
            _LONG,
            """SELECT cancer_type, count(*) AS n_muestras, round(avg(found), 2) AS media_genes_detectados,
              round(stddev_samp(found), 2) AS sd_genes_detectados, min(found) AS min_genes_detectados,
              max(found) AS max_genes_detectados, round(100 * avg(found / n), 2) AS pct_promedio_genes_detectados
            FROM (SELECT sample_id, cancer_type, count(*) FILTER (tpm_unstranded > 0) AS found, count(*) AS n
                  FROM long GROUP BY ALL)
            GROUP BY cancer_type""",
        ),
        "value_stats": _with(f"{_LONG},{_STATS}", "SELECT * FROM stats"),
        "scaler_deviations": _with(
            f"""{_LONG},
            cells AS (SELECT gene_id_base, sample_id, avg(log2_tpm) AS v FROM long GROUP BY ALL),
            grid AS (SELECT f.gene_id_base, coalesce(v, 0e0) AS v FROM (SELECT DISTINCT gene_id_base FROM long) f
                     CROSS JOIN (SELECT sample_id FROM samples) s LEFT JOIN cells USING (gene_id_base, sample_id))""",
            "SELECT gene_id_base, round(stddev_samp(v), 4) AS sd FROM grid GROUP BY gene_id_base",
        ),
        "sketch_rank_errors": _with(
            _LONG,
            """SELECT cancer_type, quantile, count(log2_tpm) AS n, TRUE AS within_bound
            FROM long, (VALUES ('q1_log2_tpm'), ('mediana_log2_tpm'), ('q3_log2_tpm')) AS q(quantile) GROUP BY ALL""",
        ),
        "top_features": _with(f"{_LONG},{_TOP}", "SELECT * FROM top"),
        "variable_features": _with(
            f"{_LONG},{_VARIABLE}",
            """SELECT gene_id_base, gene_name, round(media, 4) AS media_global, round(sd, 4) AS sd_entre_clases,
              round(rango, 4) AS rango_entre_clases FROM variable ORDER BY sd DESC, gene_id_base LIMIT 5000""",
        ),
        "top_variable": _with(
            f"{_LONG},{_VARIABLE}",
            """SELECT gene_id_base, gene_name, round(media, 4) AS media_global, round(sd, 4) AS sd_entre_clases,
              round(rango, 4) AS rango_entre_clases FROM variable ORDER BY sd DESC, gene_id_base LIMIT 20""",
        ),
        "restrict_features": _with(
            f"{_LONG},{_VARIABLE}",
            """SELECT sample_id, gene_id_base, round(log2_tpm, 4) AS log2_tpm FROM long WHERE gene_id_base IN
              (SELECT gene_id_base FROM variable ORDER BY sd DESC, gene_id_base LIMIT 10)""",
        ),
        # matrix and split
        "matrix": _with(
            f"{_LONG}, m AS (SELECT sample_id, patient_id, cancer_type, {_MATRIX} FROM long GROUP BY ALL)",
            f"SELECT sample_id, patient_id, cancer_type, {_MATRIX_ROUNDED} FROM m",
        ),
        "matrix_vectors": _with(
            f"{_LONG}, m AS (SELECT sample_id, patient_id, cancer_type, {_MATRIX} FROM long GROUP BY ALL)",
            f"SELECT sample_id, patient_id, cancer_type, {_MATRIX_ROUNDED} FROM m",
        ),
        "stratified_split": _with(f"{_CHOSEN},{_SPLIT}", "SELECT * FROM split_samples"),
        "take_split": _with(
            f"{_CHOSEN},{_SPLIT}",
            "SELECT sample_id, patient_id, cancer_type FROM split_samples WHERE split = 'validation'",
        ),
        "split_counts": _with(
            f"{_CHOSEN},{_SPLIT}", "SELECT split, cancer_type, count(*) AS n FROM split_samples GROUP BY ALL"
        ),
        "leakage_check": _with(
            f"{_CHOSEN},{_SPLIT}",
            "SELECT "
            + ", ".join(
                _PAIR.format(a=a, b=b)
                for a, b in [("train", "validation"), ("train", "test"), ("validation", "test")]
            ),
        ),
        "shared_values": """
            SELECT DISTINCT c_custkey AS custkey FROM customer
            INTERSECT SELECT DISTINCT o_custkey FROM orders""",
        # evaluation
        "accuracy_metrics": _with(
            f"{_SCORED},{_CLASS_SCORES}",
            "SELECT modelo, split, round(accuracy, 4) AS accuracy, round(balanced_accuracy, 4) AS balanced_accuracy FROM acc",
        ),
        "prf_metrics": _with(
            f"{_SCORED},{_CLASS_SCORES}",
            "SELECT modelo, split, "
            + _rounded(f"{s}_{k}" for k in ("macro", "weighted") for s in ("precision", "recall", "f1"))
            + " FROM prf",
        ),
        "confusion": _with(
            f"{_SCORED},{_GROUPS}",
            """SELECT g.modelo, g.split, 'c' || t.k AS true_class, 'c' || p.k AS predicted_class,
              (SELECT count(*) FROM pred x WHERE x.modelo = g.modelo AND x.split = g.split AND label = t.k
                 AND prediction = p.k) AS n
            FROM grp g, label_dim t, label_dim p""",
        ),
        "confusion_wide": _with(
            _SCORED, f"SELECT modelo, split, 'c' || label AS true_class, {_CONFUSION_WIDE} FROM pred GROUP BY ALL"
        ),
        "class_report": _with(_REPORT, f"SELECT {_REPORT_COLUMNS} FROM report"),
        "top_errors": _with(
            _SCORED,
            """SELECT 'c' || label AS cancer_type, 'c' || prediction AS cancer_predicho, count(*) AS n_errores
            FROM pred WHERE label <> prediction GROUP BY ALL""",
        ),
        "prediction_table": _with(
            _SCORED,
            """SELECT CAST(vec_id AS VARCHAR) AS sample_id, CAST(vec_id AS VARCHAR) AS patient_id,
              'c' || label AS cancer_type, 'c' || prediction AS cancer_predicho, CAST(label AS INTEGER) AS label,
              CAST(prediction AS INTEGER) AS prediction FROM pred""",
        ),
        "roc_auc_ovr": _with(
            f"{_SCORED},{_RANKED}", "SELECT modelo, split, round(roc_auc_macro_ovr, 4) AS roc_auc_macro_ovr FROM auc"
        ),
        "average_precision_ovr": _with(
            f"{_SCORED},{_RANKED}", "SELECT modelo, split, round(pr_auc_macro_ovr, 4) AS pr_auc_macro_ovr FROM auc"
        ),
        "rank_metrics_by_class": _with(
            f"{_SCORED},{_RANKED}",
            "SELECT modelo, split, k, " + _rounded(["roc_auc", "average_precision", "pr_area"]) + " FROM areas",
        ),
        "roc_points": _with(
            f"{_SCORED},{_RANKED},{_TOP_SUPPORT}",
            """SELECT modelo, split, 'c' || k AS clase, round(fp / nq, 4) AS fpr, round(tp / np, 4) AS tpr
            FROM ranked JOIN top_support USING (modelo, split, k)
            UNION ALL SELECT modelo, split, 'c' || k, 0e0, 0e0 FROM top_support""",
        ),
        "roc_corners": _with(
            f"""{_SCORED},{_RANKED},{_TOP_SUPPORT},
            steps AS (SELECT *, lead(p) OVER w AS next_p, lead(q) OVER w AS next_q FROM ranked JOIN top_support USING (modelo, split, k)
                      WINDOW w AS (PARTITION BY modelo, split, k ORDER BY score DESC))""",
            """SELECT modelo, split, 'c' || k AS clase, round(fp / nq, 4) AS fpr, round(tp / np, 4) AS tpr
            FROM steps WHERE next_p IS NULL OR p * next_q <> q * next_p
            UNION ALL SELECT modelo, split, 'c' || k, 0e0, 0e0 FROM top_support""",
        ),
        "pr_points": _with(
            f"{_SCORED},{_RANKED},{_TOP_SUPPORT}",
            """SELECT modelo, split, 'c' || k AS clase, round(tp / np, 4) AS recall, round(tp / (tp + fp), 4) AS precision
            FROM ranked JOIN top_support USING (modelo, split, k)
            UNION ALL SELECT modelo, split, 'c' || k, 0e0, 1e0 FROM top_support""",
        ),
        "curve_areas": _with(
            f"{_SCORED},{_RANKED},{_TOP_SUPPORT}",
            """SELECT modelo, split, 'c' || k AS clase, round(roc_auc, 4) AS roc_auc, round(pr_area, 4) AS pr_auc
            FROM areas JOIN top_support USING (modelo, split, k)""",
        ),
        "metrics_table": _with(_METRICS, f"SELECT modelo, split, {_rounded(_METRIC_COLUMNS)} FROM metrics"),
        "overfit_gap": _with(
            _METRICS, f"SELECT modelo, split, {_rounded(_METRIC_COLUMNS[-2:])} FROM metrics"
        ),
        "select_best": _with(
            _METRICS,
            f"""SELECT modelo, split, {_rounded(_METRIC_COLUMNS)} FROM (SELECT * FROM metrics WHERE split = 'validation'
            ORDER BY f1_macro DESC NULLS LAST, balanced_accuracy DESC NULLS LAST, pr_auc_macro_ovr DESC NULLS LAST, modelo
            LIMIT 1)""",
        ),
        "metrics_report": _with(
            _METRICS,
            "SELECT modelo, split, "
            + _rounded(c for c in _METRIC_COLUMNS[:-1] if not c.endswith("weighted"))
            + " FROM metrics WHERE split IN ('validation', 'test')",
        ),
        # intake
        "validate_new_samples": _with(
            _INTAKE,
            """SELECT FALSE AS valido,
              'La columna log2_tpm tiene ' || (SELECT count(*) FROM intake WHERE TRY_CAST(log2_tpm AS DOUBLE) IS NULL)
                || ' valores no numéricos o nulos.' AS errores,
              'El archivo contiene ' || (SELECT count(DISTINCT sample_id) FROM intake)
                || ' muestras. La inferencia debe procesarse por muestra.|El archivo contiene solo '
                || (SELECT count(DISTINCT gene_id_base) FROM intake)
                || ' genes únicos. Para una predicción real debe contener suficientes genes usados por el modelo.'
                AS advertencias,
              count(*) AS filas, 'sample_id|patient_id|gene_id_base|log2_tpm' AS columnas,
              count(DISTINCT sample_id) AS muestras, count(DISTINCT patient_id) AS pacientes,
              count(DISTINCT gene_id_base) AS genes FROM intake""",
        ),
        "clean_new_samples": _with(
            _INTAKE,
            """SELECT sample_id, patient_id, gene_id_base, round(TRY_CAST(log2_tpm AS DOUBLE), 4) AS log2_tpm FROM intake
            WHERE patient_id IS NOT NULL AND TRY_CAST(log2_tpm AS DOUBLE) IS NOT NULL""",
        ),
        "new_samples_csv": _with(
            _INTAKE,
            """SELECT sample_id, patient_id, gene_id_base, round(TRY_CAST(log2_tpm AS DOUBLE), 4) AS log2_tpm FROM intake
            WHERE patient_id IS NOT NULL AND TRY_CAST(log2_tpm AS DOUBLE) IS NOT NULL""",
        ),
        "to_numeric": _with(
            _INTAKE, "SELECT sample_id, gene_id_base, round(TRY_CAST(log2_tpm AS DOUBLE), 4) AS log2_tpm FROM intake"
        ),
        "profile_columns": f"""
            SELECT columna, n_numeric, CASE WHEN n_numeric > 0 THEN 'numeric' ELSE 'categorical' END AS kind
            FROM ({_PROFILE})""",
        "preview": _with(
            _CHOSEN,
            """SELECT file_id, coalesce(case_submitter_id, '') AS case_submitter_id, sample_id FROM samples
            ORDER BY sample_id LIMIT 300""",
        ),
        "select_by_alias": _with(
            _META, "SELECT cancer_type AS clase, file_size AS bytes, project_id AS proyecto FROM meta"
        ),
        "standardize_columns": "SELECT c_custkey AS clave_del_cliente, c_name AS nombre FROM customer",
        # feeds
        "kpis": _with(
            f"{_LONG},{_CLASS_COUNTS}",
            "SELECT '2/7' AS fuentes, (SELECT count(*) FROM counts) AS clases, 25 AS genes_matriz, 2 AS modelos",
        ),
        "class_feed": _with(
            f"{_LONG},{_CLASS_COUNTS}",
            "SELECT cancer_type, n_muestras FROM counts ORDER BY n_muestras DESC, cancer_type LIMIT 20",
        ),
        "model_feed": _with(
            _METRICS, "SELECT modelo, split, round(f1_macro, 4) AS f1_macro FROM metrics WHERE split <> 'train'"
        ),
        "accuracy_feed": _with(
            _METRICS, "SELECT modelo, split, round(balanced_accuracy, 4) AS balanced_accuracy FROM metrics"
        ),
        "value_feed": _with(
            f"{_LONG},{_STATS}",
            "SELECT cancer_type, media_log2_tpm FROM stats ORDER BY media_log2_tpm DESC, cancer_type LIMIT 30",
        ),
        "feature_feed": _with(
            f"{_LONG},{_TOP}",
            "SELECT * FROM top ORDER BY avg_log2_tpm DESC, cancer_type, gene_id_base LIMIT 25",
        ),
        "feature_feed_class": _with(
            f"{_LONG},{_TOP}",
            """SELECT * FROM top WHERE cancer_type = 'BUILDING'
            ORDER BY avg_log2_tpm DESC, cancer_type, gene_id_base LIMIT 25""",
        ),
        "class_list": _with(f"{_LONG},{_TOP}", "SELECT DISTINCT cancer_type FROM top"),
        "class_f1_feed": _with(_REPORT, top_f1),
        "missing_feed": _with(
            f"{_LONG},{_QUALITY}",
            """SELECT cancer_type, n_log2_tpm_null + n_tpm_null AS n_faltantes FROM quality
            ORDER BY n_faltantes DESC, cancer_type LIMIT 25""",
        ),
        "variable_feed": _with(
            f"{_LONG},{_VARIABLE}",
            """SELECT gene_id_base, gene_name, round(media, 4) AS media_global, round(sd, 4) AS sd_entre_clases,
              round(rango, 4) AS rango_entre_clases FROM variable ORDER BY round(sd, 4) DESC, gene_id_base LIMIT 20""",
        ),
    }
    # Another storage, the same report.
    found["table_status_catalog"] = found["table_status"].replace("'csv'", "'table'")
    same = {
        "detected_by_sample": "detected_features", "matrix_by_sample": "matrix", "quality_by_moments": "quality",
        "variable_by_moments": "variable_features", "top_by_moments": "top_features",
        "bayes_aggregates": "bayes_statistics",
    }
    return found | {query: found[of] for query, of in same.items()}
