"""Profiling, feature engineering, selection and encoding."""

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidewatch import schemas as S
from tidewatch.functions.connection import network_features
from tidewatch.operators import profile as P
from tidewatch.operators import select as SEL
from tidewatch.operators import stages as ST
from tidewatch.operators.models import one_hot_stages
from tidewatch.operators.ranking import melt
from tidewatch.plans.common import r6, rounded
from tidewatch.plans.data_queries import CLEAN, LABELLED, VECTOR, clean_rows, labelled
from tidewatch.plans.views import ctes, view

NUMERIC = [c for c in VECTOR if c not in S.CATEGORICAL]
SELECT_ON = ["duration", "src_bytes", "conn_count", "srv_count", "serror_rate", "same_srv_rate",
             "num_outbound_cmds"]
THRESHOLD = 0.35


def with_gaps(spark, d):
    """Connection rows with missing and unseen values, made from the rows themselves."""
    return labelled(spark, d).select(
        "row_id", "label", "protocol_type",
        F.when(F.col("row_id") % 13 != 0, F.col("service")).alias("service"),
        F.when(F.col("row_id") % 7 != 0, F.col("src_bytes").cast("double")).alias("src_bytes"),
        F.when(F.col("row_id") % 5 != 0, F.col("duration").cast("double")).alias("duration"),
        "serror_rate")


GAPS = f"""{LABELLED}, gaps AS (SELECT row_id, label, protocol_type,
  CASE WHEN row_id % 13 <> 0 THEN service END AS service,
  CASE WHEN row_id % 7 <> 0 THEN CAST(src_bytes AS DOUBLE) END AS src_bytes,
  CASE WHEN row_id % 5 <> 0 THEN CAST(duration AS DOUBLE) END AS duration, serror_rate
  FROM labelled)"""
NAN_EVERY, NAN_AT = 11, 3  # rows whose bytes a file written from pandas would hold as NaN


def with_nans(rows):
    return rows.withColumn("src_bytes", F.when(
        F.col("row_id") % NAN_EVERY == NAN_AT, float("nan")).otherwise(F.col("src_bytes").cast("double")))


def nans_sql(source: str) -> str:
    """NaN is no value to either engine's operator, so the twin leaves it out."""
    return (f"(SELECT * REPLACE (CASE WHEN row_id % {NAN_EVERY} <> {NAN_AT} THEN CAST(src_bytes AS "
            f"DOUBLE) END AS src_bytes) FROM {source})")


GAP_COLS = ["protocol_type", "service", "src_bytes", "duration", "serror_rate"]


# --- profiling ------------------------------------------------------------------------------
def q_dictionary(spark, d):
    return P.feature_dictionary(with_gaps(spark, d), GAP_COLS)


def q_describe(spark, d):
    return rounded(P.describe_features(with_gaps(spark, d),
                                       ["src_bytes", "duration", "serror_rate"],
                                       ["protocol_type", "service"]))


def q_value_counts(spark, d):
    return P.value_counts(labelled(spark, d), "attack_type")


def q_attack_rate(spark, d):
    rows = clean_rows(spark, d)
    return rounded(P.attack_rate_by(rows, "protocol_type").unionByName(
        P.attack_rate_by(rows, "service", 15)))


def q_histogram(spark, d):
    rows = network_features(labelled(spark, d), ["src_bytes", "dst_bytes", "duration"])
    raw = P.equal_width_histogram(rows, "src_bytes", 60).withColumn("scale", F.lit("raw"))
    log = P.equal_width_histogram(rows, "log_src_bytes", 60).withColumn("scale", F.lit("log1p"))
    return rounded(raw.unionByName(log))


def q_density(spark, d):
    return rounded(P.equal_width_histogram(view(spark, d, "scored"), "score", 60, by="label"))


def q_crosstab(spark, d):
    return P.crosstab(labelled(spark, d), "protocol_type", "flag")


def q_cramers(spark, d):
    rows = labelled(spark, d)
    pairs = [("protocol_type", "service"), ("protocol_type", "flag"), ("service", "flag")]
    out = None
    for a, b in pairs:
        one = P.cramers_v(rows, a, b)
        out = one if out is None else out.unionByName(one)
    return rounded(out)


def q_melt(spark, d):
    wide = labelled(spark, d).groupBy("service").agg(
        F.avg("src_bytes").alias("roc_auc"), F.avg("duration").alias("average_precision"))
    return rounded(melt(wide, ["service"], ["roc_auc", "average_precision"], "metric", "value"))


def q_pca(spark, d):
    rows = clean_rows(spark, d)
    cols = ["src_bytes", "dst_bytes", "duration", "conn_count", "serror_rate"]
    scaler = ST.PopStandardScaler(inputCols=cols).fit(rows.where("label = 0"))
    scaled = scaler.transform(rows)
    points, ratios = P.pca_projection(scaled.where("label = 0"), scaled, cols,
                                      ["row_id", "label"])
    return rounded(points.withColumn("pc1_ratio", F.lit(ratios[0])).withColumn(
        "pc2_ratio", F.lit(ratios[1])))


def q_rank_curve(spark, d):
    return P.score_rank_curve(view(spark, d, "conn_scored"), THRESHOLD).select(
        "row_id", "score", "rank", "predicted")


def q_ecdf(spark, d):
    return rounded(P.ecdf(view(spark, d, "scored")))


# --- engineering ----------------------------------------------------------------------------
def q_network(spark, d):
    rows = view(spark, d, "conn41").withColumn(
        "src_bytes", F.when(F.col("row_id") % 17 != 0, F.col("src_bytes")))
    return rounded(network_features(rows, keep=["row_id"]).select(
        "row_id", "protocol_type", "src_bytes", *S.DERIVED))


def q_spearman(spark, d):
    return rounded(SEL.spearman_matrix(labelled(spark, d), SELECT_ON[:6]))


def q_spearman_gaps(spark, d):
    return rounded(SEL.spearman_matrix(with_gaps(spark, d),
                                       ["src_bytes", "duration", "serror_rate"]))


def q_constant(spark, d):
    flat = set(SEL.constant_columns(labelled(spark, d), VECTOR))
    return spark.createDataFrame([(c, c in flat) for c in VECTOR],
                                 "feature string, is_constant boolean")


def q_duplicates(spark, d):
    return spark.createDataFrame(SEL.duplicate_columns(labelled(spark, d), VECTOR),
                                 "left string, right string")


def q_selector(spark, d):
    model = ST.CorrelationSelector(inputCols=SELECT_ON).fit(labelled(spark, d))
    return rounded(model.report_frame(spark))


def q_selector_all(spark, d):
    """All raw and derived columns."""
    rows = network_features(view(spark, d, "conn41"), keep=[])
    model = ST.CorrelationSelector(inputCols=rows.columns).fit(rows)
    return rounded(model.report_frame(spark))


def q_impute(spark, d):
    rows = with_nans(with_gaps(spark, d))
    model = ST.MedianImputer(inputCols=["src_bytes", "duration"]).fit(rows.where("label = 0"))
    return rounded(model.transform(rows).select("row_id", "src_bytes", "duration"))


def q_standard(spark, d):
    rows = with_nans(labelled(spark, d))
    model = ST.PopStandardScaler(inputCols=NUMERIC).fit(rows.where("label = 0"))
    return rounded(model.transform(rows).select("row_id", *NUMERIC))


def q_robust(spark, d):
    rows = labelled(spark, d)
    model = ST.ExactRobustScaler(inputCols=NUMERIC).fit(rows.where("label = 0"))
    return rounded(model.transform(rows).select("row_id", *NUMERIC))


def q_one_hot(spark, d):
    rows = labelled(spark, d)
    cats = ["protocol_type", "service"]
    fitted = Pipeline(stages=one_hot_stages(cats)).fit(rows.where("service <> 'svc6'"))
    out = fitted.transform(rows)
    names = F.array(*[F.lit(f"{c}={v}") for c, labels in zip(cats, fitted.stages[0].labelsArray)
                      for v in labels])
    flags = F.concat(*[vector_to_array(F.col(f"{c}_vec")) for c in cats])
    return out.select("row_id", F.explode(F.arrays_zip(names.alias("category"),
                                                       flags.alias("flag"))).alias("z")).select(
        "row_id", "z.category", "z.flag").where("flag = 1.0")


def q_routing(spark, d):
    model = ST.CorrelationSelector(inputCols=[*S.CATEGORICAL, *NUMERIC]).fit(labelled(spark, d))
    return spark.createDataFrame(
        [(c, "categorical") for c in model.categorical_features()]
        + [(c, "numeric") for c in model.numeric_features()], "feature string, route string")


QUERIES = {
    "feature_dictionary": q_dictionary,
    "describe_features": q_describe,
    "value_counts": q_value_counts,
    "group_attack_rate": q_attack_rate,
    "equal_width_histogram": q_histogram,
    "score_density": q_density,
    "crosstab": q_crosstab,
    "cramers_v": q_cramers,
    "melt_metrics": q_melt,
    "pca_projection": q_pca,
    "score_rank_curve": q_rank_curve,
    "ecdf": q_ecdf,
    "network_features": q_network,
    "spearman_matrix": q_spearman,
    "spearman_pairwise_complete": q_spearman_gaps,
    "constant_columns": q_constant,
    "duplicate_columns": q_duplicates,
    "correlation_selector": q_selector,
    "correlation_selector_all": q_selector_all,
    "median_impute": q_impute,
    "standard_scale": q_standard,
    "robust_scale": q_robust,
    "one_hot": q_one_hot,
    "column_routing": q_routing,
}


def _union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


def _describe_num(c: str) -> str:
    x = f"CAST({c} AS DOUBLE)"
    return f"""SELECT '{c}' AS feature, count({c}) AS count, CAST(NULL AS BIGINT) AS unique_values,
 CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS freq, {r6(f'avg({x})', 'mean')},
 {r6(f'stddev_samp({x})', 'std')}, {r6(f'min({x})', 'min')},
 {r6(f'quantile_cont({x}, 0.25)', 'q25')}, {r6(f'quantile_cont({x}, 0.5)', 'q50')},
 {r6(f'quantile_cont({x}, 0.75)', 'q75')}, {r6(f'max({x})', 'max')} FROM gaps"""


def _describe_str(c: str) -> str:
    none = ", ".join(f"CAST(NULL AS DOUBLE) AS {n}"
                     for n in ("mean", "std", "min", "q25", "q50", "q75", "max"))
    return f"""SELECT '{c}' AS feature, CAST(sum(n) AS BIGINT) AS count,
 count(*) AS unique_values, arg_min(v, (-n, v)) AS top, max(n) AS freq, {none}
 FROM (SELECT {c} AS v, count(*) AS n FROM gaps WHERE {c} IS NOT NULL GROUP BY {c}) q"""


def _hist(col: str, scale: str) -> str:
    return f"""SELECT '{scale}' AS scale, bin, count(*) AS n, {r6('min(lo + bin * w)', 'left_edge')}
 FROM (SELECT CAST(least(floor(({col} - lo) / w), 59) AS INT) AS bin, lo, w FROM eng,
   (SELECT min({col}) AS lo, (max({col}) - min({col})) / 60 AS w FROM eng) b) q GROUP BY bin"""


def _cramer(a: str, b: str) -> str:
    return f"""SELECT '{a}' AS left_column, '{b}' AS right_column,
 {r6('sqrt(greatest(chi2, 0) / (n * (least(r, c) - 1)))', 'cramers_v')}
 FROM (SELECT sum((coalesce(o, 0) - e) * (coalesce(o, 0) - e) / e) AS chi2, max(n) AS n,
   count(DISTINCT x) AS r, count(DISTINCT y) AS c
   FROM (SELECT x, y, rn * cn / n AS e, n, o FROM
     (SELECT {a} AS x, CAST(count(*) AS DOUBLE) AS rn FROM labelled GROUP BY 1) r
     CROSS JOIN (SELECT {b} AS y, CAST(count(*) AS DOUBLE) AS cn FROM labelled GROUP BY 1) c
     CROSS JOIN (SELECT CAST(count(*) AS DOUBLE) AS n FROM labelled) t
     LEFT JOIN (SELECT {a} AS x, {b} AS y, count(*) AS o FROM labelled GROUP BY 1, 2) j
       USING (x, y)) z) q"""


def _rank(c: str) -> str:
    return (f"(rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE)")


def _spearman(pairs, source: str) -> str:
    out = []
    for a, b in pairs:
        if a == b:
            out.append(f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", 1.0::DOUBLE AS rho")
        else:
            out.append(f"""SELECT '{a}' AS "left", '{b}' AS "right", {r6('corr(x, y)', 'rho')}
 FROM (SELECT {_rank(a)} AS x, {_rank(b)} AS y FROM {source}
   WHERE {a} IS NOT NULL AND {b} IS NOT NULL) q""")
    return _union(out)


ENG = f"""{ctes('conn41')}, eng AS (SELECT row_id, protocol_type, src_bytes,
 total_bytes, src_bytes / (total_bytes + 1) AS src_byte_share,
 total_bytes / (duration + 1) AS bytes_per_second,
 CAST(coalesce(total_bytes = 0, false) AS INT) AS zero_bytes,
 srv_count / (cnt + 1) AS srv_count_share,
 dst_host_srv_count / (dst_host_count + 1) AS host_srv_share,
 ln(duration + 1) AS log_duration, ln(src_bytes + 1) AS log_src_bytes,
 ln(dst_bytes + 1) AS log_dst_bytes, ln(total_bytes + 1) AS log_total_bytes,
 ln(total_bytes / (duration + 1) + 1) AS log_bytes_per_second
 FROM (SELECT *, src_bytes + dst_bytes AS total_bytes FROM (SELECT row_id, protocol_type,
   CASE WHEN row_id % 17 <> 0 THEN CAST(src_bytes AS DOUBLE) END AS src_bytes,
   CAST(dst_bytes AS DOUBLE) AS dst_bytes, CAST(duration AS DOUBLE) AS duration,
   CAST("count" AS DOUBLE) AS cnt, CAST(srv_count AS DOUBLE) AS srv_count,
   CAST(dst_host_count AS DOUBLE) AS dst_host_count,
   CAST(dst_host_srv_count AS DOUBLE) AS dst_host_srv_count FROM conn41) a) b)"""

S6 = SELECT_ON[:6]
ORACLES = {
    "feature_dictionary": f"WITH {GAPS} " + _union(
        f"""SELECT '{c}' AS feature, count(*) - count({c}) AS missing,
 count(DISTINCT {c}) AS unique_values, '{t}' AS dtype FROM gaps"""
        for c, t in zip(GAP_COLS, ["string", "string", "double", "double", "double"])),
    "describe_features": f"WITH {GAPS} " + _union(
        [_describe_num(c) for c in ("src_bytes", "duration", "serror_rate")]
        + [_describe_str(c) for c in ("protocol_type", "service")]),
    "value_counts": f"WITH {LABELLED} SELECT attack_type, count(*) AS rows FROM labelled GROUP BY 1",
    "group_attack_rate": f"WITH {CLEAN} " + _union(
        f"""SELECT * FROM (SELECT '{c}' AS "column", {c} AS segment, count(*) AS rows,
 {r6('avg(label)', 'attack_rate')} FROM clean GROUP BY {c} ORDER BY rows DESC, segment LIMIT 15) q"""
        for c in ("protocol_type", "service")),
    "equal_width_histogram": f"""WITH {LABELLED}, eng AS (SELECT CAST(src_bytes AS DOUBLE) AS raw,
 ln(CAST(src_bytes AS DOUBLE) + 1) AS logged FROM labelled)
 """ + _union([_hist("raw", "raw"), _hist("logged", "log1p")]),
    "score_density": f"""WITH {ctes('scored')} SELECT label, bin, n,
 {r6('lo + bin * w', 'left_edge')}, {r6('n / (sum(n) OVER (PARTITION BY label) * w)', 'density')}
 FROM (SELECT label, CAST(least(floor((score - lo) / w), 59) AS INT) AS bin, min(lo) AS lo,
   min(w) AS w, count(*) AS n FROM scored,
   (SELECT min(score) AS lo, (max(score) - min(score)) / 60 AS w FROM scored) b
   GROUP BY 1, 2) q""",
    "crosstab": f"""WITH {LABELLED} SELECT protocol_type, flag, count(*) AS n FROM labelled
 GROUP BY 1, 2""",
    "cramers_v": f"WITH {LABELLED} " + _union(
        [_cramer("protocol_type", "service"), _cramer("protocol_type", "flag"),
         _cramer("service", "flag")]),
    "melt_metrics": f"WITH {LABELLED} " + _union(
        f"SELECT service, '{m}' AS metric, {r6(f'avg({c})', 'value')} FROM labelled GROUP BY 1"
        for m, c in (("roc_auc", "src_bytes"), ("average_precision", "duration"))),
    "score_rank_curve": f"""WITH {ctes('conn_scored')} SELECT row_id, score,
 row_number() OVER (ORDER BY score, row_id) AS rank,
 CAST(score >= {THRESHOLD} AS INT) AS predicted FROM conn_scored""",
    "ecdf": f"""WITH {ctes('scored')} SELECT DISTINCT label, score,
 {r6('cume_dist() OVER (PARTITION BY label ORDER BY score)', 'ecdf')} FROM scored""",
    "network_features": f"""WITH {ENG} SELECT row_id, protocol_type, {r6('src_bytes', 'src_bytes')},
 zero_bytes, {', '.join(r6(c, c) for c in S.DERIVED if c != 'zero_bytes')} FROM eng""",
    "spearman_matrix": f"WITH {LABELLED} " + _spearman(
        [(a, b) for a in S6 for b in S6], "labelled"),
    "spearman_pairwise_complete": f"WITH {GAPS} " + _spearman(
        [(a, b) for a in ("src_bytes", "duration", "serror_rate")
         for b in ("src_bytes", "duration", "serror_rate")], "gaps"),
    "constant_columns": f"WITH {LABELLED} " + _union(
        f"""SELECT '{c}' AS feature, count(DISTINCT {c}) + CAST(count(*) > count({c}) AS BIGINT)
 <= 1 AS is_constant FROM labelled""" for c in VECTOR),
    "duplicate_columns": f"WITH {LABELLED} SELECT * FROM (" + _union(
        f"""SELECT '{a}' AS "left", '{b}' AS "right" FROM labelled
 HAVING bool_and(CAST({a} AS VARCHAR) IS NOT DISTINCT FROM CAST({b} AS VARCHAR))"""
        for i, a in enumerate(VECTOR) for b in VECTOR[i + 1:]) + ") q",
    "median_impute": f"""WITH {GAPS} SELECT row_id, """ + ", ".join(r6(
        f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM {nans_sql('gaps')} q WHERE label = 0))", c)
        for c in ("src_bytes", "duration")) + f" FROM {nans_sql('gaps')} q",
    "standard_scale": f"""WITH {LABELLED}, given AS {nans_sql("labelled")}, st AS (SELECT """ + ", ".join(
        f"avg({c}) AS m_{c}, coalesce(nullif(stddev_pop({c}), 0), 1) AS s_{c}" for c in NUMERIC)
    + " FROM given WHERE label = 0) SELECT row_id, " + ", ".join(
        r6(f"({c} - m_{c}) / s_{c}", c) for c in NUMERIC) + " FROM given, st",
    "robust_scale": f"""WITH {LABELLED}, st AS (SELECT """ + ", ".join(
        f"""quantile_cont(CAST({c} AS DOUBLE), 0.5) AS m_{c},
 coalesce(nullif(quantile_cont(CAST({c} AS DOUBLE), 0.75) - quantile_cont(CAST({c} AS DOUBLE), 0.25),
 0), 1) AS s_{c}""" for c in NUMERIC)
    + " FROM labelled WHERE label = 0) SELECT row_id, " + ", ".join(
        r6(f"({c} - m_{c}) / s_{c}", c) for c in NUMERIC) + " FROM labelled, st",
    "one_hot": f"WITH {LABELLED} " + _union(
        f"""SELECT row_id, '{c}=' || {c} AS category, 1.0::DOUBLE AS flag FROM labelled
 WHERE {c} IN (SELECT {c} FROM labelled WHERE service <> 'svc6')"""
        for c in ("protocol_type", "service")),
}


def _selector_sql() -> str:
    """The greedy walk written out for the columns of the registered query.

    Which columns are dropped follows from the view (one constant, one duplicate pair, one
    mirrored pair); the correlations are computed.
    """
    return f"""WITH {LABELLED},
 rho AS ({_spearman([("conn_count", "srv_count"), ("serror_rate", "same_srv_rate")], "labelled")}),
 flat AS (SELECT count(DISTINCT num_outbound_cmds) <= 1 AS c FROM labelled)
SELECT 'srv_count' AS removed, 'conn_count' AS retained, rho AS correlation, 'duplicate' AS reason
 FROM rho WHERE "left" = 'conn_count' AND (SELECT bool_and(conn_count = srv_count) FROM labelled)
UNION ALL SELECT 'same_srv_rate', 'serror_rate', rho, 'Spearman' FROM rho
 WHERE "left" = 'serror_rate' AND abs(rho) >= 0.9
UNION ALL SELECT 'num_outbound_cmds', NULL, NULL, 'constant' FROM flat WHERE c"""


ORACLES["correlation_selector"] = _selector_sql()
