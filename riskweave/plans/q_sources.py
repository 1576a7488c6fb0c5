"""Registered queries for sources and sinks."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from riskweave.operators import features as fe
from riskweave.operators import split as sp
from riskweave.plans.registry import register
from riskweave.session import shared_path
from riskweave.sources import io
from riskweave.sources import testdata as td

_SCAN_SQL = """
SELECT event_id, epoch_us(ts)::BIGINT AS ts_us, user_id, event_type, round(value, 6) AS value, props FROM events"""


def _scan_cols(df):
    us = F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col("ts").cast("timestamp_ntz"))
    return df.select("event_id", us.alias("ts_us"), "user_id", "event_type", "value", "props")


@register("scan_events", _SCAN_SQL)
def scan_events(spark, sf_dir):
    """S1+S2: resolve the events file in the data folder and read it (Parquet)."""
    path = io.resolve_data_path("events.parquet", sf_dir)
    return _scan_cols(io.load_dataset(spark, path))


@register("scan_events_csv", _SCAN_SQL)
def scan_events_csv(spark, sf_dir):
    """S1 CSV branch: the events table written as CSV (header) into the shared
    folder and read back with its declared schema."""
    src = io.load_dataset(spark, os.path.join(sf_dir, "events.parquet"))
    path = shared_path(spark, f"events-csv-{uuid.uuid4().hex}.csv")
    io.write_csv(src, path)
    return _scan_cols(io.load_dataset(spark, path, schema=src.schema))


def _metadata_sql() -> str:
    from riskweave.plans.q_split_encode import _full_ctes

    numeric = ",".join(["amount", *fe.ENGINEERED_FEATURES])
    return td.with_views(
        _full_ctes()
        + f"""SELECT 'is_fraud' AS target_column, 'transaction_time' AS timestamp_column, 'user_id' AS user_id_column,
  'transaction_id' AS transaction_id_column, 'amount' AS amount_column, '{numeric}' AS numeric_features,
  (SELECT CASE WHEN count(DISTINCT merchant) <= 50 THEN 'merchant' ELSE '' END FROM tr) AS categorical_features,
  '{numeric},' || (SELECT string_agg(c, ',' ORDER BY c = 'merchant_infrequent_sklearn', c)
                   FROM (SELECT DISTINCT output_column AS c FROM voc)) AS output_features,
  '{",".join(fe.ENGINEERED_FEATURES)}' AS built_features, 'is_fraud,transaction_time,transaction_id' AS dropped_features,
  '' AS unavailable_features, '' AS limitations, 'time_based' AS split_method,
  count_if(split = 'train')::BIGINT AS train_rows, count_if(split = 'valid')::BIGINT AS valid_rows, count_if(split = 'test')::BIGINT AS test_rows,
  least(count_if(is_fraud = 0), count_if(is_fraud = 1)) >= 3 AS can_stratify
FROM f""",
        "events_txn",
    )


@register("feature_metadata", _metadata_sql())
def feature_metadata(spark, sf_dir):
    """Roles, feature lists and split sizes written as JSON and read back."""
    from riskweave.plans import workflows as wf

    data = wf.prepare_model_data(spark, sf_dir)
    sizes = {r["split"]: r["rows"] for r in sp.split_sizes(data.df).collect()}
    r = data.roles
    stratify = sp.can_stratify(data.df, r.target).first()["can_stratify"]
    meta = io.FeatureMetadata(
        r.target, r.timestamp, r.user_id, r.transaction_id, r.amount, data.numeric, data.categorical, data.features,
        data.built, data.dropped, data.unavailable, data.limitations, data.split_method,
        sizes.get("train", 0), sizes.get("valid", 0), sizes.get("test", 0), stratify,
    )
    path = shared_path(spark, f"metadata-{uuid.uuid4().hex}")
    io.write_metadata(spark, meta, path)
    back = io.read_metadata(spark, path).to_frame(spark)
    lists = [f.name for f in io.METADATA_SCHEMA.fields if f.dataType.typeName() == "array"]
    return back.withColumns({c: F.concat_ws(",", c) for c in lists})
