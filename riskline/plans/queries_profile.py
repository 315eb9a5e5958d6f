"""Exploration, key checks, text clean-up, feature-store and model-input queries, with oracles."""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rowwise import clean_text
from ..operators import profile as PR
from ..operators import quality as Q
from ..operators.split import feature_matrix
from ..params import CLEAN_COLS, DEFAULTS, DERIVED_COLS, FEATURE_COLS, PAY_COLS
from ..session import scratch_root
from ..sources import feature_store as FS
from ..sources.credit import credit_profile, credit_profile_dirty
from . import oracle_base as O
from .stages import drift_inputs, feature_table, split_table

VC_COLS = ["SEX", "EDUCATION", "MARRIAGE"] + PAY_COLS
# fixed values: documented codes of the data dictionary
DOCUMENTED = [("EDUCATION", ["EDUCATION"], [1, 2, 3, 4]), ("MARRIAGE", ["MARRIAGE"], [1, 2, 3]),
              ("PAY_*", PAY_COLS, list(range(-1, 10)))]
SIGNAL_COLS = ["util_ratio", "pay_delay_max", "n_months_delayed", "pct_paid", "avg_bill"]
ESC = "\u001b"


def _fs_root(spark: SparkSession, sf: str) -> str:
    return f"{scratch_root(spark)}/feature_store/{os.path.basename(sf.rstrip('/'))}"


# ---------------------------------------------------------------- spark side
def q_value_counts(spark: SparkSession, sf: str) -> DataFrame:
    return PR.value_counts(credit_profile(spark, sf), VC_COLS)


def q_undocumented_codes(spark: SparkSession, sf: str) -> DataFrame:
    return PR.undocumented(credit_profile(spark, sf), DOCUMENTED)


def q_profile(spark: SparkSession, sf: str) -> DataFrame:
    return PR.describe(split_table(spark, sf), FEATURE_COLS)


def q_target_signal(spark: SparkSession, sf: str) -> DataFrame:
    return PR.target_signal(split_table(spark, sf), SIGNAL_COLS)


def q_target_corr(spark: SparkSession, sf: str) -> DataFrame:
    return PR.target_corr(split_table(spark, sf), DERIVED_COLS)


def q_key_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Output assertions of the cleaning, feature and split stages."""
    s = split_table(spark, sf)
    matrix_cols = feature_matrix(s.drop("split"), DEFAULTS.split).columns
    any_null = F.lit(False)
    for c in CLEAN_COLS:
        any_null = any_null | F.col(f"`{c}`").isNull()
    agg = s.agg(
        F.count_if(~F.col("EDUCATION").isin(1, 2, 3, 4)).alias("education_documented"),
        F.count_if(~F.col("MARRIAGE").isin(1, 2, 3)).alias("marriage_documented"),
        F.count_if(any_null).alias("cleaned_no_nulls"),
        (F.count(F.lit(1)) - F.count_distinct("customer_id")).alias("customer_id_unique"),
        F.count_if(~F.col("split").isin("train", "val", "test")).alias("split_labels_valid"),
    )
    # Rows of the feature table without a split, and split rows that it doesn't have
    feats = feature_table(spark, sf).select("customer_id")
    placed = s.filter(F.col("split").isin("train", "val", "test")).select("customer_id")
    missing = feats.join(placed, "customer_id", "left_anti").unionByName(placed.join(feats, "customer_id", "left_anti"))
    schema_bad = int("ID" in s.columns) + sum(int(c in matrix_cols) for c in ("default", "customer_id", "event_time"))
    checks = ["education_documented", "marriage_documented", "cleaned_no_nulls", "customer_id_unique", "split_labels_valid"]
    long = agg.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("check"), F.col(c).cast("long").alias("n_bad")) for c in checks])).alias("r")).select("r.*")
    long = long.unionByName(missing.agg(F.lit("splits_cover_all").alias("check"), F.count(F.lit(1)).cast("long").alias("n_bad")))
    long = long.unionByName(spark.createDataFrame([("id_and_target_not_in_matrix", schema_bad)], "check string, n_bad long"))
    return long.withColumn("success", F.col("n_bad") == 0)


def q_clean_notes(spark: SparkSession, sf: str) -> DataFrame:
    """P16 over generated error notes of every failing row of the dirty batch."""
    bad = Q.bad_rows(credit_profile_dirty(spark, sf), DEFAULTS.quality)
    raw = F.concat(F.lit(f"{ESC}[31mQuality gate{ESC}[0m: "), F.col("failed_rules"), F.lit("\n\t  row "),
                   F.col("ID").cast("string"), F.lit(" — check upstream  "))
    return bad.select("ID", clean_text(raw).alias("note"))


def q_feature_groups(spark: SparkSession, sf: str) -> DataFrame:
    """The projection of each group, counted in one pass over the features."""
    s = split_table(spark, sf)
    p = DEFAULTS.features
    n = s.count()
    rows = [(name, p.feature_group_version, n, 2 + len(cols), ",".join([p.primary_key, p.event_time, *cols]))
            for name, cols in p.feature_groups]
    return spark.createDataFrame(rows, "feature_group string, version int, n_rows long, n_columns int, columns string")


def q_feature_group_status(spark: SparkSession, sf: str) -> DataFrame:
    s = split_table(spark, sf).drop("split")
    return FS.sync_status(spark, s, _fs_root(spark, sf), DEFAULTS.features)


def q_feature_view(spark: SparkSession, sf: str) -> DataFrame:
    s = split_table(spark, sf).drop("split")
    root = _fs_root(spark, sf) + "_view"
    FS.write_groups(s, root, DEFAULTS.features)
    return FS.feature_view(spark, root, DEFAULTS.features)


def q_class_weights(spark: SparkSession, sf: str) -> DataFrame:
    s = split_table(spark, sf)
    return PR.class_weights(s.filter(F.col("split") == "train"))


def q_standardize(spark: SparkSession, sf: str) -> DataFrame:
    """M1: z-scores with ddof 0 (constant column -> scale 1) from training moments.
    The 2 x 33 moments are one aggregate row, inlined as literals."""
    s = split_table(spark, sf)
    train = s.filter(F.col("split") == "train")
    m = train.agg(*[F.avg(F.col(f"`{c}`").cast("double")).alias(f"m_{c}") for c in FEATURE_COLS],
                  *[F.stddev_pop(F.col(f"`{c}`").cast("double")).alias(f"s_{c}") for c in FEATURE_COLS]).first()
    cols = []
    for c in FEATURE_COLS:
        sd = m[f"s_{c}"] or 0.0
        scale = sd if sd > 0 else 1.0
        cols.append(F.round((F.col(f"`{c}`").cast("double") - F.lit(m[f"m_{c}"])) / F.lit(scale), 6).alias(c))
    return train.select("customer_id", *cols)


def q_batch_density(spark: SparkSession, sf: str) -> DataFrame:
    """AGE density histograms (30 bins, own edges) of reference, clean and drifted."""
    reference, _, clean, drifted = drift_inputs(spark, sf)
    col = DEFAULTS.drift.bias_column
    long = (reference.select(F.lit("reference").alias("batch"), F.col(col).cast("double").alias("value"))
            .unionByName(clean.select(F.lit("clean").alias("batch"), F.col(col).cast("double").alias("value")))
            .unionByName(drifted.select(F.lit("drifted").alias("batch"), F.col(col).cast("double").alias("value"))))
    return PR.density_histogram(long, "batch", 30)


# ---------------------------------------------------------------- oracle side
def _long(src: str, cols: list[str], keep: list[str] = (), typ: str = "DOUBLE", name: str = "column") -> str:
    sel = ", ".join([f'"{k}"' for k in keep] + [f'CAST("{c}" AS {typ}) AS "{c}"' for c in cols])
    on = ", ".join(f'"{c}"' for c in cols)
    return f"(UNPIVOT (SELECT {sel} FROM {src}) ON {on} INTO NAME \"{name}\" VALUE value)"


def _clean_text_sql(s: str) -> str:
    return (f"regexp_replace(trim(regexp_replace(regexp_replace({s}, chr(27) || '\\[[0-9;]*m', '', 'g'), "
            f"'\\s+', ' ', 'g')), '[^\\x00-\\x7F]', '?', 'g')")


def oracles() -> dict[str, str]:
    from ..functions.sqlexpr import bin_index_sql
    from .queries_drift import drift_cte
    from .queries_quality import _bad_rows_sql

    cp = O.credit_profile_cte()
    split = f"WITH {cp},\n{O.split_cte()}"
    drift = f"WITH {cp},\n{drift_cte()}"
    und = []
    for label, cols, doc in DOCUMENTED:
        docs = ", ".join(str(d) for d in doc)
        anyb = " OR ".join(f'("{c}" IS NOT NULL AND "{c}" NOT IN ({docs}))' for c in cols)
        und.append(f"""SELECT '{label}' AS "column",
  coalesce((SELECT string_agg(CAST(v AS VARCHAR), ',' ORDER BY v) FROM (SELECT DISTINCT value AS v FROM {_long('credit_profile', cols, typ='BIGINT')} WHERE value NOT IN ({docs}))), '') AS undocumented_codes,
  (SELECT count(*) FROM credit_profile WHERE {anyb}) AS n_rows,
  round(100.0 * (SELECT count(*) FROM credit_profile WHERE {anyb}) / (SELECT count(*) FROM credit_profile), 4) AS pct_rows""")
    null_any = " OR ".join(f'"{c}" IS NULL' for c in CLEAN_COLS)
    p = DEFAULTS.features
    fg_rows = " UNION ALL ".join(
        f"SELECT '{name}' AS feature_group, {p.feature_group_version} AS version, (SELECT count(*) FROM split_assign) AS n_rows, "
        f"{2 + len(cols)} AS n_columns, '{','.join([p.primary_key, p.event_time, *cols])}' AS columns"
        for name, cols in p.feature_groups)
    std_cols = ", ".join(
        f'round((CAST("{c}" AS DOUBLE) - (SELECT avg(CAST("{c}" AS DOUBLE)) FROM _tr)) / '
        f'(SELECT CASE WHEN coalesce(stddev_pop(CAST("{c}" AS DOUBLE)), 0) > 0 THEN stddev_pop(CAST("{c}" AS DOUBLE)) ELSE 1.0 END FROM _tr), 6) AS "{c}"'
        for c in FEATURE_COLS)
    view_cols = ", ".join(["customer_id", "event_time"] + [f'"{c}"' for _, cols in p.feature_groups for c in cols])
    raw_note = ("chr(27) || '[31mQuality gate' || chr(27) || '[0m: ' || failed_rules || chr(10) || chr(9) || '  row ' "
                "|| CAST(\"ID\" AS VARCHAR) || ' — check upstream  '")
    dens_bin = bin_index_sql("value", "lo", "step", 30)
    return {
        "value_counts": f"""WITH {cp}
SELECT "column", value, count(*) AS n FROM {_long('credit_profile', VC_COLS, typ='BIGINT')} GROUP BY ALL""",
        "undocumented_codes": f"WITH {cp}\n" + "\nUNION ALL\n".join(und),
        "profile": f"""{split}
SELECT feature, count(value) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, min(value) AS min, max(value) AS max
FROM {_long('split_assign', FEATURE_COLS, name='feature')} GROUP BY feature""",
        "target_signal": f"""{split}
SELECT feature, round(avg(value) FILTER (WHERE "default" = 0), 6) AS mean_0, round(avg(value) FILTER (WHERE "default" = 1), 6) AS mean_1,
       round(avg(value) FILTER (WHERE "default" = 1) - avg(value) FILTER (WHERE "default" = 0), 6) AS gap
FROM {_long('split_assign', SIGNAL_COLS, keep=['default'], name='feature')} GROUP BY feature""",
        "target_corr": f"""{split},
_c AS (SELECT feature, round(corr(value, CAST("default" AS DOUBLE)), 6) AS "corr"
       FROM {_long('split_assign', DERIVED_COLS, keep=['default'], name='feature')} GROUP BY feature)
SELECT feature, "corr", CAST(row_number() OVER (ORDER BY abs("corr") DESC NULLS LAST, feature) AS INTEGER) AS rank FROM _c""",
        "key_checks": f"""{split},
_k AS (
  SELECT 'education_documented' AS "check", count(*) FILTER (WHERE "EDUCATION" NOT IN (1, 2, 3, 4)) AS n_bad FROM split_assign
  UNION ALL SELECT 'marriage_documented', count(*) FILTER (WHERE "MARRIAGE" NOT IN (1, 2, 3)) FROM split_assign
  UNION ALL SELECT 'cleaned_no_nulls', count(*) FILTER (WHERE {null_any}) FROM split_assign
  UNION ALL SELECT 'customer_id_unique', count(*) - count(DISTINCT customer_id) FROM split_assign
  UNION ALL SELECT 'split_labels_valid', count(*) FILTER (WHERE split NOT IN ('train', 'val', 'test')) FROM split_assign
  UNION ALL SELECT 'splits_cover_all', count(*) FROM features f WHERE NOT EXISTS (SELECT 1 FROM split_assign s WHERE s.customer_id = f.customer_id)
  UNION ALL SELECT 'id_and_target_not_in_matrix', 0
)
SELECT "check", CAST(n_bad AS BIGINT) AS n_bad, n_bad = 0 AS success FROM _k""",
        "clean_notes": f"""WITH {cp},
{O.dirty_cte()},
_bad AS ({_bad_rows_sql('credit_profile_dirty', __import__('riskline.params', fromlist=['RAW_COLS']).RAW_COLS)})
SELECT "ID", {_clean_text_sql(raw_note)} AS note FROM _bad""",
        "feature_groups": f"{split}\n{fg_rows}",
        "feature_group_status": f"""{split}
SELECT TRUE AS connected, '{','.join(n for n, _ in p.feature_groups)}' AS feature_groups_written,
       (SELECT count(*) FROM split_assign) AS rows_written, (SELECT count(*) FROM split_assign) AS read_back_rows,
       'All 4 groups are stored and readable.' AS note""",
        "feature_view": f"{split} SELECT {view_cols} FROM split_assign",
        "class_weights": f"""{split},
_g AS (SELECT "default" AS label, count(*) AS n FROM split_assign WHERE split = 'train' GROUP BY 1)
SELECT label, n, round(CAST(sum(n) OVER () AS DOUBLE) / (count(*) OVER () * n), 6) AS weight FROM _g""",
        "standardize": f"""{split},
_tr AS (SELECT * FROM split_assign WHERE split = 'train')
SELECT customer_id, {std_cols} FROM _tr""",
        "batch_density": f"""{drift},
_l AS (SELECT 'reference' AS batch, CAST("AGE" AS DOUBLE) AS value FROM _train
       UNION ALL SELECT 'clean', CAST("AGE" AS DOUBLE) FROM _clean
       UNION ALL SELECT 'drifted', CAST("AGE" AS DOUBLE) FROM _drifted),
_st AS (SELECT batch, min(value) AS lo, max(value) AS hi, count(*) AS total, (max(value) - min(value)) / 30.0 AS step FROM _l GROUP BY batch),
_b AS (SELECT l.batch, {dens_bin} AS bin, count(*) AS n FROM _l l JOIN _st USING (batch) GROUP BY ALL),
_g AS (SELECT _st.*, CAST(g.bin AS INTEGER) AS bin FROM _st, range(0, 30) g(bin))
SELECT g.batch, g.bin, round(g.lo + CAST(g.bin AS DOUBLE) * g.step, 6) AS bin_lo, CAST(coalesce(b.n, 0) AS BIGINT) AS n,
       round(CAST(coalesce(b.n, 0) AS DOUBLE) / ((CASE WHEN g.bin = 29 THEN g.hi ELSE g.lo + CAST(g.bin + 1 AS DOUBLE) * g.step END)
             - (g.lo + CAST(g.bin AS DOUBLE) * g.step)) / CAST(g.total AS DOUBLE), 8) AS density
FROM _g g LEFT JOIN _b b ON g.batch = b.batch AND g.bin = b.bin""",
    }


QUERIES = {
    "value_counts": q_value_counts,
    "undocumented_codes": q_undocumented_codes,
    "profile": q_profile,
    "target_signal": q_target_signal,
    "target_corr": q_target_corr,
    "key_checks": q_key_checks,
    "clean_notes": q_clean_notes,
    "feature_groups": q_feature_groups,
    "feature_group_status": q_feature_group_status,
    "feature_view": q_feature_view,
    "class_weights": q_class_weights,
    "standardize": q_standardize,
    "batch_density": q_batch_density,
}
