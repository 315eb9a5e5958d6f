"""Row-wise behavioural features (R1-R4, P6-P9) and the dense surrogate key (K2)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rowwise import col
from ..functions.sqlexpr import derived_feature_sql
from ..params import FeatureParams
from .clean import ROW_ORDER
from .ordering import dense_index


def derived_columns() -> list:
    """R1-R4, P6-P8 as one SQL expression each (no nulls after cleaning)."""
    return [F.expr(sql).alias(name) for name, sql in derived_feature_sql()]


def engineer_features(cleaned: DataFrame, params: FeatureParams = FeatureParams()) -> DataFrame:
    """Cleaned rows (with ``_row_order``) -> key first, cleaned columns, derived columns, event time.

    The key is the dense 0..n-1 position in first-seen order, computed by the range-partitioned
    helper rather than a global single-task window.
    """
    base_cols = [c for c in cleaned.columns if c != ROW_ORDER]
    keyed = dense_index(cleaned, [ROW_ORDER], out=params.primary_key)
    return keyed.select(
        F.col(params.primary_key),
        *[col(c) for c in base_cols],
        *derived_columns(),
        F.lit(params.event_time_value).cast("timestamp_ntz").alias(params.event_time),
    )
