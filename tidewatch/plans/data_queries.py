"""Cleaning, labelling, sampling and splitting over the connection view."""

from pyspark.sql import functions as F

from tidewatch.functions.hashing import hash_u32_sql
from tidewatch.operators import clean as C
from tidewatch.plans.common import r6, rounded
from tidewatch.plans.views import ctes, view

# the feature vector of the `conn` view
VECTOR = ["protocol_type", "service", "flag", "duration", "src_bytes", "dst_bytes", "conn_count",
          "srv_count", "serror_rate", "same_srv_rate", "num_outbound_cmds"]
VEC = ", ".join(VECTOR)


def labelled(spark, d):
    return C.label_connections(view(spark, d, "conn"))


def clean_rows(spark, d):
    return C.clean_vectors(labelled(spark, d), VECTOR, "row_id")


LABELLED = f"""{ctes('conn')},
labelled AS (SELECT * EXCLUDE (attack_type), rtrim(attack_type, '.') AS attack_type,
  CAST(CASE WHEN rtrim(attack_type, '.') <> 'normal' THEN 1 ELSE 0 END AS TINYINT) AS label
  FROM conn)"""
CLEAN = f"""{LABELLED},
clean AS (SELECT * EXCLUDE (rn, lo, hi) FROM (
  SELECT *, row_number() OVER (PARTITION BY {VEC} ORDER BY row_id) AS rn,
    min(label) OVER (PARTITION BY {VEC}) AS lo, max(label) OVER (PARTITION BY {VEC}) AS hi
  FROM labelled) q WHERE rn = 1 AND lo = hi)"""


def ranked_sql(source: str, seed, by_label: bool = True, key: str = "row_id") -> str:
    part = "PARTITION BY label " if by_label else ""
    return (f"SELECT *, row_number() OVER ({part}ORDER BY {hash_u32_sql(seed, key)}, {key}) AS rk, "
            f"count(*) OVER ({part.strip()}) AS size FROM {source}")


SPLIT = f"""{CLEAN},
split_rows AS (SELECT * EXCLUDE (rk, size),
  CASE WHEN rk <= floor(size * 0.6::DOUBLE + 1e-9) THEN 'train'
       WHEN rk <= floor(size * 0.8::DOUBLE + 1e-9) THEN 'validation' ELSE 'test' END AS split
  FROM ({ranked_sql('clean', 42)}) q)"""


def split_rows(spark, d):
    return C.stratified_split(clean_rows(spark, d), "row_id")


def q_label(spark, d):
    return labelled(spark, d).select("row_id", "attack_type", "label")


def q_dedupe(spark, d):
    return C.dedupe(labelled(spark, d), [*VECTOR, "label", "attack_type"])


def q_conflicts(spark, d):
    return C.drop_conflicts(labelled(spark, d), VECTOR).select("row_id", "label", "attack_type")


def q_first(spark, d):
    return C.first_per_key(labelled(spark, d), VECTOR, "row_id")


def q_clean(spark, d):
    return clean_rows(spark, d)


def q_audit(spark, d):
    return C.cleaning_audit(labelled(spark, d), VECTOR)


SAMPLE_ROWS = 120  # per_class = 60, available at every scale factor


def q_balanced(spark, d):
    return C.balanced_sample(clean_rows(spark, d), SAMPLE_ROWS, "row_id").select(
        "row_id", "label", "attack_type")


def q_split(spark, d):
    return split_rows(spark, d).select("row_id", "label", "split")


def q_leak(spark, d):
    return C.split_leakage(split_rows(spark, d), VECTOR)


def q_split_summary(spark, d):
    return rounded(C.split_summary(split_rows(spark, d)))


def q_kfold(spark, d):
    return C.stratified_kfold(clean_rows(spark, d), "row_id", 5).select("row_id", "label", "fold")


def q_sample(spark, d):
    return C.seeded_sample(clean_rows(spark, d), 200, "row_id").select("row_id", "attack_type")


def q_normal(spark, d):
    return C.normal_rows(labelled(spark, d), check=False).select("row_id", "label", *VECTOR)


def q_write_splits(spark, d):
    from tidewatch.session import scratch_path
    from tidewatch.sources.tables import write_splits
    return write_splits(split_rows(spark, d), scratch_path(spark, "splits"))


def q_manifest(spark, d):
    from tidewatch.session import scratch_path
    from tidewatch.sources.tables import audit_manifest, read_splits, write_splits
    path = scratch_path(spark, "splits")
    manifest = write_splits(split_rows(spark, d), path)
    return audit_manifest(read_splits(spark, path), manifest)


QUERIES = {
    "label_connections": q_label,
    "dedupe_full_row": q_dedupe,
    "conflict_removal": q_conflicts,
    "dedupe_feature_vector": q_first,
    "clean_connections": q_clean,
    "cleaning_audit": q_audit,
    "balanced_sample": q_balanced,
    "stratified_split": q_split,
    "split_leakage_check": q_leak,
    "split_summary": q_split_summary,
    "stratified_kfold": q_kfold,
    "seeded_sample": q_sample,
    "normal_only": q_normal,
    "write_splits_parquet": q_write_splits,
    "manifest_audit": q_manifest,
}

SUMMARY_SQL = f"""SELECT split, count(*) AS rows, count(*) FILTER (label = 0) AS normal,
 count(*) FILTER (label = 1) AS attack"""

ORACLES = {
    "label_connections": f"WITH {LABELLED} SELECT row_id, attack_type, label FROM labelled",
    "dedupe_full_row": f"WITH {LABELLED} SELECT DISTINCT {VEC}, label, attack_type FROM labelled",
    "conflict_removal": f"""WITH {LABELLED} SELECT row_id, label, attack_type FROM (
  SELECT *, min(label) OVER (PARTITION BY {VEC}) AS lo, max(label) OVER (PARTITION BY {VEC}) AS hi
  FROM labelled) q WHERE lo = hi""",
    "dedupe_feature_vector": f"""WITH {LABELLED} SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY {VEC} ORDER BY row_id) AS rn FROM labelled) q
  WHERE rn = 1""",
    "clean_connections": f"WITH {CLEAN} SELECT * FROM clean",
    "cleaning_audit": f"""WITH {LABELLED}, v AS (SELECT count(*) AS n, min(label) AS lo,
  max(label) AS hi FROM labelled GROUP BY {VEC})
SELECT CAST(sum(n) AS BIGINT) AS source_rows, count(*) FILTER (lo = hi) AS unique_feature_rows,
  CAST(coalesce(sum(n) FILTER (lo <> hi), 0) AS BIGINT) AS conflicting_label_rows,
  CAST(sum(n) - coalesce(sum(n) FILTER (lo <> hi), 0) - count(*) FILTER (lo = hi) AS BIGINT)
    AS redundant_rows_removed FROM v""",
    "balanced_sample": f"""WITH {CLEAN} SELECT row_id, label, attack_type
  FROM ({ranked_sql('clean', 42)}) q WHERE rk <= {SAMPLE_ROWS // 2}""",
    "stratified_split": f"WITH {SPLIT} SELECT row_id, label, split FROM split_rows",
    "split_leakage_check": f"""WITH {SPLIT}, v AS (SELECT min(split) AS lo, max(split) AS hi,
  count(*) AS n, count(split) AS inn FROM split_rows GROUP BY {VEC})
SELECT count(*) FILTER (lo <> hi) AS leaking_vectors, CAST(sum(n) AS BIGINT) AS total_rows,
  CAST(sum(inn) AS BIGINT) AS assigned_rows FROM v""",
    "split_summary": f"""WITH {SPLIT} {SUMMARY_SQL}, {r6('avg(label)', 'attack_rate')}
  FROM split_rows GROUP BY split""",
    "stratified_kfold": f"""WITH {CLEAN} SELECT row_id, label, CAST((rk * 5 + size - 1) // size AS INT) AS fold
  FROM ({ranked_sql('clean', 42)}) q""",
    "seeded_sample": f"""WITH {CLEAN} SELECT row_id, attack_type
  FROM ({ranked_sql('clean', 42, False)}) q WHERE rk <= 200""",
    "normal_only": f"WITH {LABELLED} SELECT row_id, label, {VEC} FROM labelled WHERE label = 0",
    "write_splits_parquet": f"WITH {SPLIT} {SUMMARY_SQL} FROM split_rows GROUP BY split",
    "manifest_audit": f"""WITH {SPLIT} SELECT split, count(*) AS expected_rows,
  count(*) AS actual_rows, true AS matches FROM split_rows GROUP BY split""",
}
