"""Every registered query with the SQL that gives the same result on the same tables.

Doubles are rounded on both sides, as two engines may add them in a different order.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.scalar import parsed_time, truth
from riskloom.operators import forest, merge, metrics, validate
from riskloom.operators import normalise as norm
from riskloom.operators.features import compute, latest_per_user, trailing_counts, trailing_windows
from riskloom.operators.ordered import positions, quantiles
from riskloom.plans import evaluate, inputs, jobs, monitor, profile, scoring
from riskloom.schema import ABSOLUTE_FEATURES, FEATURES, TRANSACTION_COLUMNS
from riskloom.session import checkpoint_folder, pinned
from riskloom.sources import tables
from riskloom.streaming.ingest import Layers, affected_rows, ingest_available, late_rows

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles and decimals as doubles of ``digits`` digits, whole numbers as bigint."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            column = F.round(column.cast("double"), digits)
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            column = column.cast("bigint")
        columns.append(column.alias(field.name))
    return df.select(*columns)


# ---------------------------------------------------------------- SQL building blocks

TX = """tx AS (
  SELECT CAST(event_id AS VARCHAR) AS transaction_id, CAST(user_id AS VARCHAR) AS user_id,
         ts AS event_time, CAST(value AS DECIMAL(12,2)) AS amount, event_type AS txn_type,
         CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS label
  FROM events)"""

ORDER_TX = """tx AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id, CAST(o_custkey AS VARCHAR) AS user_id,
         o_orderdate AS event_time, CAST(o_totalprice AS DECIMAL(12,2)) AS amount,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS label
  FROM orders)"""

SKEWED_TX = """tx AS (
  SELECT CAST(event_id AS VARCHAR) AS transaction_id,
         CASE WHEN user_id % 3 = 0 THEN 'busy' ELSE CAST(user_id AS VARCHAR) END AS user_id,
         ts AS event_time, CAST(value AS DECIMAL(12,2)) AS amount, event_type AS txn_type,
         CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS label
  FROM events)"""

DENSE_TX = f"""tx AS (
  SELECT CAST(event_id AS VARCHAR) AS transaction_id, 'busy' AS user_id,
         TIMESTAMP '{inputs.AS_OF}' + (ts - date_trunc('day', ts)) AS event_time,
         CAST(value AS DECIMAL(12,2)) AS amount, event_type AS txn_type,
         CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS label
  FROM events)"""


def features_of(rows: str, out: str) -> str:
    """CTEs that compute the seven features of CTE ``rows`` into CTE ``out``."""
    return f"""{out}_w AS (
  SELECT *,
    sum(amount) OVER (PARTITION BY user_id ORDER BY event_time
      RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW)
    - coalesce(sum(amount) OVER (PARTITION BY user_id, event_time ORDER BY transaction_id
      ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS total,
    count(*) OVER (PARTITION BY user_id ORDER BY event_time
      RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW)
    - count(*) OVER (PARTITION BY user_id, event_time ORDER BY transaction_id
      ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS n,
    date_diff('microsecond', lag(event_time) OVER (PARTITION BY user_id
      ORDER BY event_time, transaction_id), event_time) / 1e6 / 3600.0 AS gap
  FROM {rows}),
{out}_b AS (
  SELECT *,
    median(CAST(amount AS DOUBLE)) OVER earlier AS base_amount,
    avg(CAST(n AS DOUBLE)) OVER earlier AS base_count,
    median(gap) OVER earlier AS base_gap
  FROM {out}_w
  WINDOW earlier AS (PARTITION BY user_id ORDER BY event_time, transaction_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
{out} AS (
  SELECT transaction_id, user_id, event_time, amount, label,
    CAST(total AS DOUBLE) AS total_amount_24h,
    CAST(n AS BIGINT) AS txn_count_24h,
    CAST(total AS DOUBLE) / n AS avg_amount_24h,
    coalesce(gap, -1.0) AS hours_since_last_txn,
    CASE WHEN base_amount > 0 THEN CAST(amount AS DOUBLE) / base_amount ELSE 1.0 END
      AS amount_vs_user_median,
    CASE WHEN base_count > 0 THEN n / base_count ELSE 1.0 END AS count_vs_user_typical,
    CASE WHEN gap IS NOT NULL AND base_gap > 0 THEN gap / base_gap ELSE 1.0 END
      AS gap_vs_user_typical
  FROM {out}_b)"""


FEATURE_LIST = """transaction_id, user_id, event_time,
  round(total_amount_24h, 6) AS total_amount_24h, txn_count_24h,
  round(avg_amount_24h, 6) AS avg_amount_24h,
  round(hours_since_last_txn, 6) AS hours_since_last_txn,
  round(amount_vs_user_median, 6) AS amount_vs_user_median,
  round(count_vs_user_typical, 6) AS count_vs_user_typical,
  round(gap_vs_user_typical, 6) AS gap_vs_user_typical"""

TRUTH = """gt AS (
  SELECT transaction_id, CASE CAST(user_id AS INTEGER) % 3 WHEN 0 THEN 'card_testing'
    WHEN 1 THEN 'account_takeover' ELSE 'subtle' END AS fraud_type
  FROM tx WHERE label = 1),
truth AS (
  SELECT tx.*, coalesce(fraud_type, 'legitimate') AS fraud_type
  FROM tx LEFT JOIN gt USING (transaction_id))"""

RANKINGS = f"""{TX},
{TRUTH},
rk AS (
  SELECT transaction_id, label, fraud_type, 'value' AS model, CAST(amount AS DOUBLE) AS score
  FROM truth
  UNION ALL
  SELECT transaction_id, label, fraud_type, 'hour', CAST(extract(hour FROM event_time) AS DOUBLE)
  FROM truth)"""


def curve_of(rows: str) -> str:
    return f"""g AS (
  SELECT model, score AS threshold, count(*) FILTER (WHERE label = 1) AS hits, count(*) AS n
  FROM {rows} GROUP BY model, score),
cum AS (
  SELECT *, CAST(sum(hits) OVER w AS DOUBLE) AS tp, CAST(sum(n) OVER w AS DOUBLE) AS flagged,
    CAST(sum(hits) OVER (PARTITION BY model) AS DOUBLE) AS positives,
    CAST(sum(n) OVER (PARTITION BY model) AS DOUBLE) AS total_rows
  FROM g WINDOW w AS (PARTITION BY model ORDER BY threshold DESC)),
pr AS (
  SELECT *, tp / flagged AS precision, tp / positives AS recall FROM cum WHERE positives > 0),
curve AS (
  SELECT *, CASE WHEN precision + recall > 0
    THEN 2.0 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM pr)"""


BEST = """best AS (
  SELECT model, threshold, precision, recall, f1 FROM (
    SELECT *, row_number() OVER (PARTITION BY model ORDER BY f1 DESC, threshold) AS place
    FROM curve) WHERE place = 1)"""

POINT = """CASE WHEN flagged > 0 THEN caught / flagged ELSE 0.0 END AS precision,
  CASE WHEN positives > 0 THEN caught / positives ELSE 0.0 END AS recall"""


def point_sql(source: str, keys: str) -> str:
    return f"""SELECT {keys}, round(threshold, 6) AS threshold, round(precision, 6) AS precision,
  round(recall, 6) AS recall,
  round(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
    ELSE 0.0 END, 6) AS f1,
  CAST(flagged AS BIGINT) AS flagged, CAST(caught AS BIGINT) AS true_positives,
  round(flagged / total_rows, 6) AS alert_rate
FROM (SELECT *, {POINT} FROM {source})"""


SCORES = f"""{TX},
sc AS (
  SELECT transaction_id, user_id, event_time, CAST(amount AS DOUBLE) / 1000.0 AS score,
    amount >= 100 AS flagged, 'v-' || txn_type AS model_version,
    event_time + INTERVAL 1 HOUR AS scored_at, label
  FROM tx)"""

LANDING = """landing AS (
  SELECT
    CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0
      THEN CAST(event_id - 1 AS VARCHAR) ELSE CAST(event_id AS VARCHAR) END AS transaction_id,
    ' U' || user_id || ' ' AS user_id,
    CASE WHEN event_id % 83 = 0 THEN 'not-a-date'
      ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS event_time,
    CASE WHEN event_id % 79 = 0 THEN 'twelve pounds'
      WHEN event_id % 73 = 0 THEN '-' || CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR)
      ELSE CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) END AS amount,
    'm' || (event_id % 10) AS merchant_id,
    CASE WHEN event_id % 7 = 0 THEN 'NA' ELSE 'IN' END AS merchant_country,
    event_type AS txn_type, CAST(NULL AS VARCHAR) AS device_id,
    CASE WHEN event_id % 71 = 0 THEN '999.999.999.999' WHEN event_id % 67 = 0 THEN NULL
      ELSE '10.0.' || (user_id % 256) || '.' || (event_id % 256) END AS ip_address,
    CASE WHEN event_id % 61 = 0 THEN NULL WHEN event_type = 'error' THEN '1' ELSE '0' END AS label,
    strftime(ts, '%Y-%m-%d') AS source_file, event_id AS row_pos
  FROM events)"""

CHECKED = (
    LANDING
    + """,
parsed AS (
  SELECT *, TRY_CAST(event_time AS TIMESTAMP) AS t, TRY_CAST(amount AS DOUBLE) AS a,
    row_number() OVER (PARTITION BY source_file, transaction_id ORDER BY row_pos) AS copy
  FROM landing),
flags AS (
  SELECT *, t IS NULL AS invalid_event_time, a IS NULL AS invalid_amount,
    coalesce(a < 0, false) AS negative_amount,
    NOT coalesce(regexp_matches(ip_address,
      '^((25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\\.){3}(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])$'),
      false) AS invalid_ip,
    transaction_id IS NULL AS missing_transaction_id, copy > 1 AS duplicate_transaction_id
  FROM parsed),
checked AS (
  SELECT *, concat_ws(';',
    CASE WHEN invalid_event_time THEN 'invalid_event_time' END,
    CASE WHEN invalid_amount THEN 'invalid_amount' END,
    CASE WHEN negative_amount THEN 'negative_amount' END,
    CASE WHEN invalid_ip THEN 'invalid_ip' END,
    CASE WHEN missing_transaction_id THEN 'missing_transaction_id' END,
    CASE WHEN duplicate_transaction_id THEN 'duplicate_transaction_id' END) AS failure_reason
  FROM flags)"""
)

AS_OF = f"TIMESTAMP '{inputs.AS_OF}'"
SEEN = f"event_time < TIMESTAMP '{inputs.SEEN_UNTIL}'"
BATCH = f"event_time >= TIMESTAMP '{inputs.BATCH_FROM}'"


# ------------------------------------------------------------------- features


@register(
    "features",
    f"WITH {TX}, {features_of('tx', 'f')} SELECT {FEATURE_LIST} FROM f",
)
def features(spark: SparkSession, folder: str) -> DataFrame:
    """W1-W9, P11."""
    return rounded(compute(inputs.transactions(spark, folder)))


@register(
    "features_ties",
    f"WITH {ORDER_TX}, {features_of('tx', 'f')} SELECT {FEATURE_LIST} FROM f",
)
def features_ties(spark: SparkSession, folder: str) -> DataFrame:
    """W1-W9 where many rows of a user share one time."""
    return rounded(compute(inputs.order_transactions(spark, folder)))


@register(
    "features_skewed",
    f"WITH {SKEWED_TX}, {features_of('tx', 'f')} SELECT {FEATURE_LIST} FROM f",
)
def features_skewed(spark: SparkSession, folder: str) -> DataFrame:
    """W1-W9 with a third of the rows under one user, which is cut into slices."""
    rows = inputs.skewed_transactions(spark, folder)
    return rounded(compute(rows, hot_rows=1000, slice_rows=500))


@register(
    "features_dense",
    f"WITH {DENSE_TX}, {features_of('tx', 'f')} SELECT {FEATURE_LIST} FROM f",
)
def features_dense(spark: SparkSession, folder: str) -> DataFrame:
    """W1-W9 with all rows in one day of one user."""
    return rounded(compute(inputs.dense_transactions(spark, folder)))


@register(
    "trailing_24h_half_open",
    f"""WITH {TX}
SELECT transaction_id, user_id, event_time,
  count(*) OVER (PARTITION BY user_id ORDER BY event_time RANGE BETWEEN
    INTERVAL '23 hours 59 minutes 59.999999 seconds' PRECEDING AND CURRENT ROW)
  - count(*) OVER (PARTITION BY user_id, event_time ORDER BY transaction_id
    ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS txn_count_24h
FROM tx""",
)
def trailing_24h_half_open(spark: SparkSession, folder: str) -> DataFrame:
    """W10."""
    return trailing_counts(inputs.transactions(spark, folder))


@register(
    "feature_store_rows",
    f"""WITH {TX}, {features_of('tx', 'f')},
last AS (SELECT *, row_number() OVER (PARTITION BY user_id
  ORDER BY event_time DESC, transaction_id DESC) AS place FROM f)
SELECT user_id, round(total_amount_24h, 2) AS last_24h_total,
  txn_count_24h AS last_24h_txn_count, round(avg_amount_24h, 2) AS last_24h_avg_amount
FROM last WHERE place = 1""",
)
def feature_store_rows(spark: SparkSession, folder: str) -> DataFrame:
    """W11 (D5)."""
    return rounded(latest_per_user(trailing_windows(inputs.transactions(spark, folder))))


@register(
    "global_positions",
    f"""WITH {TX} SELECT transaction_id,
  row_number() OVER (ORDER BY event_time, transaction_id) AS position FROM tx""",
)
def global_positions(spark: SparkSession, folder: str) -> DataFrame:
    """W13."""
    rows = inputs.transactions(spark, folder).select("transaction_id", "event_time")
    return positions(rows, ["event_time", "transaction_id"]).select("transaction_id", "position")


# -------------------------------------------------------------- validation


@register(
    "validated_rows",
    f"""WITH {CHECKED} SELECT row_pos, source_file, t AS event_time, round(a, 6) AS amount,
  invalid_event_time, invalid_amount, negative_amount, invalid_ip, missing_transaction_id,
  duplicate_transaction_id, failure_reason, failure_reason <> '' AS is_bad FROM checked""",
)
def validated_rows(spark: SparkSession, folder: str) -> DataFrame:
    """P1, P4, P5, V1-V8."""
    checked = validate.annotate(inputs.landing(spark, folder))
    return rounded(
        checked.select(
            "row_pos", "source_file", "event_time", "amount", *validate.RULES, "failure_reason",
            "is_bad",
        )
    )


@register(
    "rule_counts",
    f"""WITH {CHECKED} SELECT source_file, count(*) AS rows,
  count(*) FILTER (WHERE failure_reason = '') AS valid_rows,
  count(*) FILTER (WHERE failure_reason <> '') AS invalid_rows,
  {', '.join(f'count(*) FILTER (WHERE {rule}) AS {rule}' for rule in validate.RULES)}
FROM checked GROUP BY source_file""",
)
def rule_counts(spark: SparkSession, folder: str) -> DataFrame:
    """V9."""
    return validate.rule_counts(validate.annotate(inputs.landing(spark, folder)))


@register(
    "valid_rows",
    f"""WITH {CHECKED} SELECT transaction_id, user_id, t AS event_time, round(a, 6) AS amount,
  merchant_id, merchant_country, txn_type, device_id, ip_address, label
FROM checked WHERE failure_reason = ''""",
)
def valid_rows(spark: SparkSession, folder: str) -> DataFrame:
    """V10, P3."""
    return rounded(validate.valid_rows(validate.annotate(inputs.landing(spark, folder))))


@register(
    "quarantined_rows",
    f"""WITH {CHECKED} SELECT transaction_id, user_id, t AS event_time, round(a, 6) AS amount,
  merchant_id, merchant_country, txn_type, device_id, ip_address, label, failure_reason
FROM checked WHERE failure_reason <> ''""",
)
def quarantined_rows(spark: SparkSession, folder: str) -> DataFrame:
    """V10, K1."""
    return rounded(validate.invalid_rows(validate.annotate(inputs.landing(spark, folder))))


# ---------------------------------------------- projections, parsing, filters

NORMALISED = f"""{LANDING},
normal AS (
  SELECT trim(transaction_id) AS transaction_id, trim(user_id) AS user_id,
    TRY_CAST(event_time AS TIMESTAMP) AS event_time,
    TRY_CAST(amount AS DECIMAL(12,2)) AS amount, trim(merchant_id) AS merchant_id,
    trim(merchant_country) AS merchant_country, trim(txn_type) AS txn_type,
    trim(device_id) AS device_id, trim(ip_address) AS ip_address,
    coalesce(TRY_CAST(label AS INTEGER), 0) AS label
  FROM landing)"""


@register(
    "normalised_rows",
    f"""WITH {NORMALISED} SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount,
  CAST(label AS BIGINT) AS label) FROM normal""",
)
def normalised_rows(spark: SparkSession, folder: str) -> DataFrame:
    """P1-P9."""
    return rounded(norm.normalise(inputs.landing(spark, folder)))


@register(
    "loadable_rows",
    f"""WITH {NORMALISED} SELECT transaction_id, event_time, CAST(amount AS DOUBLE) AS amount
FROM normal WHERE event_time IS NOT NULL AND amount IS NOT NULL""",
)
def loadable_rows(spark: SparkSession, folder: str) -> DataFrame:
    """P10: rows kept."""
    rows = norm.loadable(norm.normalise(inputs.landing(spark, folder)))
    return rounded(rows.select("transaction_id", "event_time", "amount"))


@register(
    "dropped_row_count",
    f"""WITH {NORMALISED}
SELECT count(*) FILTER (WHERE event_time IS NOT NULL AND amount IS NOT NULL) AS kept_rows,
  count(*) FILTER (WHERE event_time IS NULL OR amount IS NULL) AS dropped_rows FROM normal""",
)
def dropped_row_count(spark: SparkSession, folder: str) -> DataFrame:
    """P10: rows dropped."""
    return norm.dropped_rows(norm.normalise(inputs.landing(spark, folder)))


@register(
    "parsed_times",
    """SELECT event_id, CASE event_id % 7
  WHEN 0 THEN ts WHEN 1 THEN date_trunc('second', ts) - INTERVAL 2 HOURS
  WHEN 6 THEN NULL ELSE date_trunc('day', ts) END AS event_time FROM events""",
)
def parsed_times(spark: SparkSession, folder: str) -> DataFrame:
    """One accepted form per residue, the last is not a time."""
    kind = F.col("event_id") % 7
    text = (
        F.when(kind == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .when(kind == 1, F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("+02:00")))
        .when(kind == 2, F.date_format("ts", "yyyy-MM-dd"))
        .when(kind == 3, F.date_format("ts", "yyyyMMdd"))
        .when(kind == 4, F.date_format("ts", "MM/dd/yyyy"))
        .when(kind == 5, F.date_format("ts", "MMM d yyyy"))
        .otherwise("10 o'clock")
    )
    events = inputs.table(spark, folder, "events")
    return events.select("event_id", parsed_time(text).alias("event_time"))


@register(
    "parsed_time_shapes",
    """SELECT event_id, CASE event_id % 9
  WHEN 0 THEN ts WHEN 1 THEN date_trunc('minute', ts) WHEN 2 THEN date_trunc('second', ts) + INTERVAL 3 HOURS
  WHEN 3 THEN date_trunc('minute', ts) WHEN 4 THEN date_trunc('minute', ts)
  WHEN 5 THEN date_trunc('second', ts) WHEN 6 THEN date_trunc('minute', ts)
  WHEN 7 THEN date_trunc('day', ts) ELSE NULL END AS event_time FROM events""",
)
def parsed_time_shapes(spark: SparkSession, folder: str) -> DataFrame:
    """More accepted forms, one per residue; a month 13 is not a time."""
    kind = F.col("event_id") % 9
    text = (
        F.when(kind == 0, F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("789Z")))
        .when(kind == 1, F.date_format("ts", "yyyy/MM/dd HH:mm"))
        .when(kind == 2, F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("-0300")))
        .when(kind == 3, F.date_format("ts", "dd MMM yyyy HH:mm"))
        .when(kind == 4, F.date_format("ts", "yyyy-MM-dd hh:mm a"))
        .when(kind == 5, F.date_format("ts", "M/d/yyyy h:mm:ss a"))
        .when(kind == 6, F.date_format("ts", "M/d/yyyy HH:mm"))
        .when(kind == 7, F.date_format("ts", "yyyy/M/d"))
        .otherwise("2024/13/01 10:00")
    )
    events = inputs.table(spark, folder, "events")
    return events.select("event_id", parsed_time(text).alias("event_time"))


@register(
    "flag_texts",
    """SELECT event_id, event_type IN ('click', 'view') AS flagged FROM events""",
)
def flag_texts(spark: SparkSession, folder: str) -> DataFrame:
    """P13."""
    kind = F.col("event_type")
    text = (
        F.when(kind == "click", "True")
        .when(kind == "view", "1")
        .when(kind == "error", "no")
        .when(kind == "signup", "0")
    )
    events = inputs.table(spark, folder, "events")
    return events.select("event_id", truth(text).alias("flagged"))


@register(
    "scan_last_days",
    f"""WITH {TX} SELECT transaction_id, user_id, event_time, CAST(amount AS DOUBLE) AS amount
FROM tx WHERE event_time >= {AS_OF} - INTERVAL 10 DAYS""",
)
def scan_last_days(spark: SparkSession, folder: str) -> DataFrame:
    """S3."""
    return rounded(tables.last_days(inputs.transactions(spark, folder), 10, inputs.AS_OF))


@register(
    "scan_last_24_hours",
    f"""WITH {TX} SELECT user_id, event_time, CAST(amount AS DOUBLE) AS amount
FROM tx WHERE event_time >= {AS_OF} - INTERVAL 24 HOURS""",
)
def scan_last_24_hours(spark: SparkSession, folder: str) -> DataFrame:
    """S4."""
    return rounded(tables.last_day(inputs.transactions(spark, folder), inputs.AS_OF))


@register(
    "days_before_latest",
    f"""WITH {TX} SELECT transaction_id, event_time FROM tx
WHERE event_time > (SELECT max(event_time) FROM tx) - INTERVAL 7 DAYS""",
)
def days_before_latest(spark: SparkSession, folder: str) -> DataFrame:
    """P16."""
    rows = tables.since_latest(inputs.transactions(spark, folder), 7)
    return rows.select("transaction_id", "event_time")


@register(
    "scores_scan",
    f"""WITH {SCORES} SELECT transaction_id, user_id, event_time, round(score, 6) AS score,
  flagged, model_version, scored_at FROM sc WHERE event_time IS NOT NULL""",
)
def scores_scan(spark: SparkSession, folder: str) -> DataFrame:
    """A table whose names, times and flags arrive as text."""
    text = inputs.scores(spark, folder).drop("label")
    text = text.withColumns(
        {
            "flagged": F.initcap(F.col("flagged").cast("string")),
            "event_time": F.col("event_time").cast("string"),
        }
    )
    return rounded(tables.clean_scores(text.toDF(*[name.upper() for name in text.columns])))


@register(
    "score_window",
    f"""WITH {SCORES} SELECT transaction_id, event_time, round(score, 6) AS score FROM sc
WHERE CAST(event_time AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' AND score >= 0.05
  AND flagged""",
)
def score_window(spark: SparkSession, folder: str) -> DataFrame:
    """P14, P15."""
    day = inputs.AS_OF.date()
    rows = monitor.in_window(
        inputs.scores(spark, folder), day.replace(day=5), day.replace(day=20), 0.05, True
    )
    return rounded(rows.select("transaction_id", "event_time", "score"))


@register(
    "rows_of_users",
    f"""WITH {TX} SELECT transaction_id, user_id FROM tx WHERE user_id IN (
  SELECT CAST(user_id AS VARCHAR) FROM events WHERE event_type = 'purchase' AND value >= 150)""",
)
def rows_of_users(spark: SparkSession, folder: str) -> DataFrame:
    """All rows of users with a large purchase."""
    rows = inputs.transactions(spark, folder)
    large = rows.where("txn_type = 'purchase' AND amount >= 150")
    return affected_rows(rows, large).select("transaction_id", "user_id")


@register(
    "union_of_files",
    f"""WITH {TX}, o AS ({ORDER_TX.removeprefix('tx AS (').removesuffix(')')})
SELECT 'events' AS origin, transaction_id, CAST(amount AS DOUBLE) AS amount FROM tx
UNION ALL SELECT 'orders', transaction_id, CAST(amount AS DOUBLE) FROM o""",
)
def union_of_files(spark: SparkSession, folder: str) -> DataFrame:
    """U1, S2."""
    first = inputs.transactions(spark, folder).withColumn("origin", F.lit("events"))
    second = inputs.order_transactions(spark, folder).withColumn("origin", F.lit("orders"))
    both = first.unionByName(second, allowMissingColumns=True)
    return rounded(both.select("origin", "transaction_id", "amount"))


# --------------------------------------------------------------------- joins


@register(
    "features_with_label",
    f"""WITH {TX}, {features_of('tx', 'f')}
SELECT transaction_id, txn_count_24h, CAST(amount AS DOUBLE) AS amount,
  CAST(label AS BIGINT) AS label FROM f""",
)
def features_with_label(spark: SparkSession, folder: str) -> DataFrame:
    """Amount and label travel with the features."""
    rows = compute(inputs.transactions(spark, folder), carry=["amount", "label"])
    return rounded(rows.select("transaction_id", "txn_count_24h", "amount", "label"))


@register(
    "fraud_types",
    f"WITH {TX}, {TRUTH} SELECT transaction_id, fraud_type FROM truth",
)
def fraud_types(spark: SparkSession, folder: str) -> DataFrame:
    """J2, S6."""
    return inputs.with_truth(spark, folder).select("transaction_id", "fraud_type")


@register(
    "label_coverage",
    f"""WITH {LANDING}, j AS (SELECT tx.transaction_id, l.label FROM (SELECT
  CAST(event_id AS VARCHAR) AS transaction_id, event_id FROM events) tx
  LEFT JOIN landing l ON tx.event_id = l.row_pos)
SELECT count(*) AS rows, count(*) FILTER (WHERE label IS NULL) AS unlabelled,
  count(*) FILTER (WHERE label IS NULL) = 0 AS usable FROM j""",
)
def label_coverage(spark: SparkSession, folder: str) -> DataFrame:
    """Labels are used only if every row has one."""
    rows = inputs.transactions(spark, folder).select("transaction_id")
    labels = inputs.landing(spark, folder).select(
        F.col("row_pos").cast("string").alias("transaction_id"), "label"
    )
    missing = F.count_if(F.col("label").isNull())
    return rows.join(labels, "transaction_id", "left").agg(
        F.count(F.lit(1)).alias("rows"), missing.alias("unlabelled"), (missing == 0).alias("usable")
    )


@register(
    "scores_with_label",
    f"WITH {SCORES} SELECT transaction_id, round(score, 6) AS score, CAST(label AS BIGINT) AS label FROM sc",
)
def scores_with_label(spark: SparkSession, folder: str) -> DataFrame:
    """J4."""
    scores = inputs.scores(spark, folder).select("transaction_id", "score")
    labels = inputs.transactions(spark, folder).select("transaction_id", "label")
    return rounded(scores.join(labels, "transaction_id", "left"))


@register(
    "top_with_raw",
    f"""WITH {SCORES} SELECT transaction_id, sc.user_id, sc.event_time,
  CAST(amount AS DOUBLE) AS amount, round(score, 6) AS score, flagged,
  CAST(sc.label AS BIGINT) AS label
FROM sc JOIN tx USING (transaction_id) ORDER BY sc.score DESC, transaction_id LIMIT 10""",
)
def top_with_raw(spark: SparkSession, folder: str) -> DataFrame:
    """J6."""
    scores = inputs.scores(spark, folder).drop("label")
    return rounded(monitor.top_with_raw(scores, inputs.transactions(spark, folder)))


@register(
    "lookup",
    f"WITH {SCORES} SELECT transaction_id, round(score, 6) AS score, flagged FROM sc WHERE transaction_id = '321'",
)
def lookup(spark: SparkSession, folder: str) -> DataFrame:
    """J7."""
    row = monitor.lookup(inputs.scores(spark, folder), "321")
    return rounded(row.select("transaction_id", "score", "flagged"))


@register(
    "table_diff",
    f"""WITH {TX}, l AS (SELECT * FROM tx WHERE {SEEN}),
r AS (SELECT * REPLACE (amount + 1 AS amount) FROM tx WHERE {BATCH}),
j AS (SELECT l.transaction_id AS a, r.transaction_id AS b,
  abs(l.amount - r.amount) AS d_amount, abs(l.label - r.label) AS d_label
  FROM l FULL JOIN r ON l.transaction_id = r.transaction_id)
SELECT count(a) AS left_rows, count(b) AS right_rows,
  count(*) FILTER (WHERE a IS NULL OR b IS NULL) AS unmatched, 'amount' AS "column",
  CAST(max(d_amount) AS DOUBLE) AS max_diff, false AS matches FROM j
UNION ALL SELECT count(a), count(b), count(*) FILTER (WHERE a IS NULL OR b IS NULL), 'label',
  CAST(max(d_label) AS DOUBLE), false FROM j""",
)
def table_diff(spark: SparkSession, folder: str) -> DataFrame:
    """J8."""
    rows = inputs.transactions(spark, folder)
    return rounded(
        merge.table_diff(inputs.seen(rows), inputs.batch(rows), "transaction_id", ["amount", "label"])
    )


# --------------------------------------------------------------------- merges (K4-K7)

UPSERT_RAW = f"""{TX}, l AS (SELECT *, TIMESTAMP '2024-01-21' AS loaded_at FROM tx WHERE {SEEN}),
r AS (SELECT * REPLACE (amount + 1 AS amount), {AS_OF} AS loaded_at FROM tx WHERE {BATCH}),
m AS (SELECT coalesce(l.transaction_id, r.transaction_id) AS transaction_id,
  CASE WHEN r.transaction_id IS NULL THEN l.amount ELSE r.amount END AS amount,
  coalesce(l.loaded_at, r.loaded_at) AS loaded_at,
  CASE WHEN l.transaction_id IS NULL THEN 'inserted' WHEN r.transaction_id IS NULL
    THEN 'kept' ELSE 'updated' END AS action
  FROM l FULL JOIN r ON l.transaction_id = r.transaction_id)"""


def _raw_merge(spark: SparkSession, folder: str) -> DataFrame:
    rows = inputs.transactions(spark, folder)
    old = inputs.seen(rows).withColumn("loaded_at", F.lit(inputs.SEEN_UNTIL).cast("timestamp_ntz"))
    new = inputs.batch(rows).withColumn("loaded_at", F.lit(inputs.AS_OF).cast("timestamp_ntz"))
    return merge.merged(old, new, "transaction_id", insert_only=["loaded_at"])


@register(
    "upsert_raw",
    f"WITH {UPSERT_RAW} SELECT transaction_id, CAST(amount AS DOUBLE) AS amount, loaded_at, action FROM m",
)
def upsert_raw(spark: SparkSession, folder: str) -> DataFrame:
    """K4, J5."""
    rows = _raw_merge(spark, folder)
    return rounded(rows.select("transaction_id", "amount", "loaded_at", "action"))


@register(
    "upsert_counts",
    f"""WITH {UPSERT_RAW} SELECT count(*) FILTER (WHERE action = 'inserted') AS inserted,
  count(*) FILTER (WHERE action = 'updated') AS updated, count(*) AS table_rows FROM m""",
)
def upsert_counts(spark: SparkSession, folder: str) -> DataFrame:
    """K7."""
    return merge.action_counts(_raw_merge(spark, folder))


@register(
    "upsert_scores",
    f"""WITH {SCORES}, l AS (SELECT * FROM sc WHERE {SEEN}),
r AS (SELECT * REPLACE (score / 2 AS score, false AS flagged, {AS_OF} AS scored_at)
  FROM sc WHERE {BATCH})
SELECT transaction_id, round(score, 6) AS score, flagged, scored_at FROM r
UNION ALL SELECT transaction_id, round(score, 6), flagged, scored_at FROM l
WHERE transaction_id NOT IN (SELECT transaction_id FROM r)""",
)
def upsert_scores(spark: SparkSession, folder: str) -> DataFrame:
    """K5."""
    rows = inputs.scores(spark, folder).drop("label")
    late = rows.where(F.col("event_time") >= F.lit(inputs.BATCH_FROM).cast("timestamp_ntz"))
    new = late.withColumns(
        {
            "score": F.col("score") / 2,
            "flagged": F.lit(False),
            "scored_at": F.lit(inputs.AS_OF).cast("timestamp_ntz"),
        }
    )
    done = merge.merged(inputs.seen(rows), new, "transaction_id")
    return rounded(done.select("transaction_id", "score", "flagged", "scored_at"))


@register(
    "upsert_feature_store",
    f"""WITH {TX}, old AS (SELECT * FROM tx WHERE {SEEN}),
new AS (SELECT * FROM tx WHERE event_time >= {AS_OF} - INTERVAL 24 HOURS),
{features_of('old', 'fo')}, {features_of('new', 'fn')},
lo AS (SELECT *, row_number() OVER (PARTITION BY user_id
  ORDER BY event_time DESC, transaction_id DESC) AS place FROM fo),
ln AS (SELECT *, row_number() OVER (PARTITION BY user_id
  ORDER BY event_time DESC, transaction_id DESC) AS place FROM fn),
o AS (SELECT * FROM lo WHERE place = 1), n AS (SELECT * FROM ln WHERE place = 1)
SELECT coalesce(n.user_id, o.user_id) AS user_id,
  round(coalesce(n.total_amount_24h, o.total_amount_24h), 2) AS last_24h_total,
  coalesce(n.txn_count_24h, o.txn_count_24h) AS last_24h_txn_count,
  CASE WHEN n.user_id IS NULL THEN TIMESTAMP '{inputs.SEEN_UNTIL}' ELSE {AS_OF} END AS updated_at
FROM o FULL JOIN n ON o.user_id = n.user_id""",
)
def upsert_feature_store(spark: SparkSession, folder: str) -> DataFrame:
    """K6, S4, W11."""
    rows = inputs.transactions(spark, folder)

    def at(part: DataFrame, when) -> DataFrame:
        return latest_per_user(trailing_windows(part)).withColumn(
            "updated_at", F.lit(when).cast("timestamp_ntz")
        )

    recent = tables.last_day(rows, inputs.AS_OF, extra=("transaction_id",))
    done = merge.merged(
        at(inputs.seen(rows), inputs.SEEN_UNTIL), at(recent, inputs.AS_OF), "user_id"
    )
    return rounded(done.drop("action", "last_24h_avg_amount"))


@register("keyed_scores", ORACLES["upsert_scores"])
def keyed_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Two merges into the score table, and a replay of the second, read back."""
    table = tables.score_table(spark, f"{checkpoint_folder(spark)}/scores-{uuid.uuid4().hex}")
    rows = inputs.scores(spark, folder).drop("label")
    late = rows.where(F.col("event_time") >= F.lit(inputs.BATCH_FROM).cast("timestamp_ntz"))
    new = late.withColumns(
        {
            "score": F.col("score") / 2,
            "flagged": F.lit(False),
            "scored_at": F.lit(inputs.AS_OF).cast("timestamp_ntz"),
        }
    )
    table.merge(inputs.seen(rows), "first")
    for _ in range(2):
        table.merge(new, "second")
    return rounded(table.read().select("transaction_id", "score", "flagged", "scored_at"))


@register("keyed_feature_store", ORACLES["upsert_feature_store"])
def keyed_feature_store(spark: SparkSession, folder: str) -> DataFrame:
    """Two merges into the feature store, read back."""
    table = tables.feature_store(spark, f"{checkpoint_folder(spark)}/store-{uuid.uuid4().hex}")
    rows = inputs.transactions(spark, folder)
    recent = tables.last_day(rows, inputs.AS_OF, extra=("transaction_id",))
    for part, at in ((inputs.seen(rows), inputs.SEEN_UNTIL), (recent, inputs.AS_OF)):
        latest = latest_per_user(trailing_windows(part)).withColumn("updated_at", F.lit(at).cast("timestamp_ntz"))
        table.merge(latest, f"until-{at:%Y%m%d}")
    return rounded(table.read().drop("user_bucket", "last_24h_avg_amount"))


@register(
    "layer_counts",
    f"""WITH {CHECKED}
SELECT 'landing' AS layer, count(*) AS rows, count(DISTINCT row_pos) AS distinct_keys FROM landing
UNION ALL SELECT 'valid', count(*), count(DISTINCT row_pos) FROM checked WHERE failure_reason = ''
UNION ALL SELECT 'quarantine', count(*), count(DISTINCT row_pos) FROM checked
  WHERE failure_reason <> ''""",
)
def layer_counts(spark: SparkSession, folder: str) -> DataFrame:
    """A15."""
    rows = inputs.landing(spark, folder)
    checked = validate.annotate(rows)
    return merge.layer_counts(
        {
            "landing": rows,
            "valid": checked.where("NOT is_bad"),
            "quarantine": checked.where("is_bad"),
        },
        "row_pos",
    )


@register(
    "ingest_replay",
    f"""WITH {CHECKED}, ok AS (SELECT * FROM checked WHERE failure_reason = ''),
u AS (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY t, a) AS place FROM ok)
SELECT transaction_id, trim(user_id) AS user_id, t AS event_time, round(a, 2) AS amount,
  CAST(coalesce(label, '0') AS BIGINT) AS label FROM u WHERE place = 1""",
)
def ingest_replay(spark: SparkSession, folder: str) -> DataFrame:
    """Daily files through the ingest stream, run twice."""
    raw = _replayed(spark, inputs.landing(spark, folder))
    return rounded(raw.select("transaction_id", "user_id", "event_time", "amount", "label"))


def _replayed(spark: SparkSession, rows: DataFrame) -> DataFrame:
    layers = Layers(f"{checkpoint_folder(spark)}/replay-{uuid.uuid4().hex}")
    ordered = rows.repartition("source_file").sortWithinPartitions("source_file", "row_pos")
    writer = ordered.drop("row_pos").write.partitionBy("source_file").option("escape", '"')
    writer.option("header", True).csv(layers.landing)
    for _ in range(2):
        ingest_available(spark, layers)
    return tables.raw_table(spark, layers.raw).read()


@register(
    "ingest_line_breaks",
    f"""WITH {CHECKED}, ok AS (SELECT * FROM checked WHERE failure_reason = ''),
u AS (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY t, a) AS place FROM ok)
SELECT transaction_id, t AS event_time, round(a, 2) AS amount, CASE WHEN row_pos % 5 = 0
  THEN 'unit ' || row_pos || chr(10) || chr(10) || '"b", c' END AS device_id FROM u WHERE place = 1""",
)
def ingest_line_breaks(spark: SparkSession, folder: str) -> DataFrame:
    """As ``ingest_replay``, with line breaks, quotes and commas inside quoted cells."""
    rows = inputs.landing(spark, folder)
    text = F.concat(F.lit("unit "), F.col("row_pos").cast("string"), F.lit('\n\n"b", c'))
    rows = rows.withColumn("device_id", F.when(F.col("row_pos") % 5 == 0, text))
    raw = _replayed(spark, rows)
    return rounded(raw.select("transaction_id", "event_time", "amount", "device_id"))


# ------------------------------------------------------- curves, thresholds


@register(
    "pr_curve",
    f"""WITH {RANKINGS}, {curve_of('rk')} SELECT model, round(threshold, 6) AS threshold,
  CAST(tp AS BIGINT) AS tp, CAST(flagged AS BIGINT) AS flagged,
  round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM curve""",
)
def pr_curve(spark: SparkSession, folder: str) -> DataFrame:
    """E1, W12."""
    points = metrics.curve(inputs.rankings(spark, folder))
    return rounded(
        points.select("model", "threshold", "tp", "flagged", "precision", "recall", "f1")
    )


@register(
    "best_f1",
    f"""WITH {RANKINGS}, {curve_of('rk')}, {BEST} SELECT model, round(threshold, 6) AS threshold,
  round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM best""",
)
def best_f1(spark: SparkSession, folder: str) -> DataFrame:
    """E2."""
    return rounded(metrics.best_f1(metrics.curve(inputs.rankings(spark, folder))))


@register(
    "alert_rate_thresholds",
    f"""WITH {RANKINGS} SELECT model, round(quantile_cont(score, 1.0 - 0.02), 6) AS two_percent,
  round(quantile_cont(score, 1.0 - 0.001), 6) AS one_per_mille FROM rk GROUP BY model""",
)
def alert_rate_thresholds(spark: SparkSession, folder: str) -> DataFrame:
    """E3."""
    rates = {"two_percent": 0.02, "one_per_mille": 0.001}
    return rounded(metrics.alert_rate_thresholds(inputs.rankings(spark, folder), rates))


@register(
    "metrics_at_threshold",
    f"""WITH {RANKINGS}, {curve_of('rk')}, {BEST},
m AS (SELECT rk.model, threshold, count(*) AS total_rows,
  CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) AS positives,
  CAST(count(*) FILTER (WHERE score >= threshold) AS DOUBLE) AS flagged,
  CAST(count(*) FILTER (WHERE score >= threshold AND label = 1) AS DOUBLE) AS caught
  FROM rk JOIN best ON rk.model = best.model GROUP BY rk.model, threshold)
{point_sql('m', 'model')}""",
)
def metrics_at_threshold(spark: SparkSession, folder: str) -> DataFrame:
    """E4."""
    rows = inputs.rankings(spark, folder)
    return rounded(metrics.metrics_at(rows, metrics.best_f1(metrics.curve(rows))))


@register(
    "areas",
    f"""WITH {RANKINGS}, {curve_of('rk')} SELECT model,
  round(sum(hits / positives * precision), 6) AS pr_auc,
  round(sum((n - hits) * (tp - hits + hits / 2.0)) / (max(positives) *
    (max(total_rows) - max(positives))), 6) AS roc_auc FROM curve GROUP BY model""",
)
def areas(spark: SparkSession, folder: str) -> DataFrame:
    """E5, E6."""
    return rounded(metrics.areas(metrics.curve(inputs.rankings(spark, folder))))


@register(
    "typology_recall",
    f"""WITH {RANKINGS}, {curve_of('rk')}, {BEST} SELECT rk.model, fraud_type AS typology,
  count(*) AS n, count(*) FILTER (WHERE score >= threshold) AS caught,
  round(count(*) FILTER (WHERE score >= threshold) / CAST(count(*) AS DOUBLE), 6) AS recall
FROM rk JOIN best ON rk.model = best.model WHERE fraud_type <> 'legitimate'
GROUP BY rk.model, fraud_type""",
)
def typology_recall(spark: SparkSession, folder: str) -> DataFrame:
    """E7."""
    rows = inputs.rankings(spark, folder)
    return rounded(metrics.typology_recall(rows, metrics.best_f1(metrics.curve(rows))))


@register(
    "alert_budgets",
    f"""WITH {RANKINGS}, rates AS (SELECT unnest({metrics.ALERT_RATES}::DOUBLE[]) AS budget),
cuts AS ({' UNION ALL '.join(f"SELECT model, CAST({rate} AS DOUBLE) AS budget, quantile_cont(score, {1.0 - rate}) AS threshold FROM rk GROUP BY model" for rate in metrics.ALERT_RATES)}),
m AS (SELECT rk.model, budget, threshold, count(*) AS total_rows,
  CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) AS positives,
  CAST(count(*) FILTER (WHERE score >= threshold) AS DOUBLE) AS flagged,
  CAST(count(*) FILTER (WHERE score >= threshold AND label = 1) AS DOUBLE) AS caught
  FROM rk JOIN cuts ON rk.model = cuts.model GROUP BY rk.model, budget, threshold)
{point_sql('m', 'model, round(budget, 6) AS budget')}""",
)
def alert_budgets(spark: SparkSession, folder: str) -> DataFrame:
    """E8."""
    return rounded(metrics.alert_budgets(inputs.rankings(spark, folder)))


@register(
    "curve_samples",
    f"""WITH {RANKINGS}, {curve_of('rk')},
targets AS (SELECT unnest(range({len(metrics.RECALL_TARGETS)})) AS target_no,
  unnest({metrics.RECALL_TARGETS}::DOUBLE[]) AS target),
near AS (SELECT model, target_no, recall, precision, threshold,
  row_number() OVER (PARTITION BY model, target_no ORDER BY abs(recall - target), threshold) AS place
  FROM curve CROSS JOIN targets),
kept AS (SELECT *, row_number() OVER (PARTITION BY model, round(recall, 4) ORDER BY target_no) AS again
  FROM near WHERE place = 1)
SELECT model, round(recall, 6) AS recall, round(precision, 6) AS precision,
  round(threshold, 6) AS threshold FROM kept WHERE again = 1""",
)
def curve_samples(spark: SparkSession, folder: str) -> DataFrame:
    """E9."""
    return rounded(metrics.curve_samples(metrics.curve(inputs.rankings(spark, folder))))


@register(
    "baseline_rankings",
    f"""WITH {TX}, rk AS (
SELECT '{evaluate.BY_AMOUNT}' AS model, CAST(amount AS DOUBLE) AS score, label FROM tx
UNION ALL SELECT '{evaluate.BY_CHANCE}',
  CAST(CAST('0x' || substr(md5(transaction_id || ':42'), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0,
  label FROM tx), {curve_of('rk')}
SELECT model, round(sum(hits / positives * precision), 6) AS pr_auc FROM curve GROUP BY model""",
)
def baseline_rankings(spark: SparkSession, folder: str) -> DataFrame:
    """M10, M11."""
    rows = inputs.transactions(spark, folder)
    ranked = rows.select(
        F.lit(evaluate.BY_AMOUNT).alias("model"), F.col("amount").cast("double").alias("score"), "label"
    ).unionByName(
        rows.select(
            F.lit(evaluate.BY_CHANCE).alias("model"), metrics.random_score(42).alias("score"), "label"
        )
    )
    return rounded(metrics.areas(metrics.curve(ranked)).select("model", "pr_auc"))


# ------------------------------------------------------------ splits, folds, weights

SPLIT = f"""{TX}, days AS (SELECT list_sort(list(DISTINCT CAST(event_time AS DATE))) AS d FROM tx),
cut AS (SELECT d[CAST(floor(len(d) * CAST(0.7 AS DOUBLE)) AS BIGINT) + 1] AS cutoff FROM days),
sp AS (SELECT tx.*, CASE WHEN CAST(event_time AS DATE) < cutoff THEN 'train' ELSE 'test' END AS split
  FROM tx CROSS JOIN cut)"""


@register("temporal_split", f"WITH {SPLIT} SELECT transaction_id, split FROM sp")
def temporal_split(spark: SparkSession, folder: str) -> DataFrame:
    """M8."""
    rows = metrics.with_split(inputs.transactions(spark, folder))
    return rows.select("transaction_id", "split")


@register(
    "split_summary",
    f"""WITH {SPLIT} SELECT split, count(*) AS rows, count(*) FILTER (WHERE label = 1) AS positives,
  round(avg(label), 6) AS prevalence FROM sp GROUP BY split""",
)
def split_summary(spark: SparkSession, folder: str) -> DataFrame:
    """A14."""
    return rounded(metrics.split_summary(metrics.with_split(inputs.transactions(spark, folder))))


@register(
    "walk_forward_folds",
    f"""WITH {SPLIT}, p AS (SELECT *, row_number() OVER (ORDER BY event_time, transaction_id) AS pos,
  count(*) OVER () AS n FROM sp WHERE split = 'train')
SELECT transaction_id, CAST(CASE WHEN (n - pos) // (n // 6) < 5
  THEN 5 - (n - pos) // (n // 6) ELSE 0 END AS BIGINT) AS fold FROM p""",
)
def walk_forward_folds(spark: SparkSession, folder: str) -> DataFrame:
    """M9."""
    rows = metrics.with_split(inputs.transactions(spark, folder)).where("split = 'train'")
    return rounded(metrics.with_folds(rows).select("transaction_id", "fold"))


@register(
    "balanced_weights",
    f"""WITH {TX} SELECT transaction_id, round(count(*) OVER () /
  (2.0 * count(*) OVER (PARTITION BY label)), 6) AS weight FROM tx""",
)
def balanced_weights(spark: SparkSession, folder: str) -> DataFrame:
    """M7."""
    rows = metrics.balanced_weights(inputs.transactions(spark, folder))
    return rounded(rows.select("transaction_id", "weight"))


@register(
    "scored_contract",
    f"""WITH {TX}, b AS (SELECT min(amount) AS lo, max(amount) AS hi FROM tx)
SELECT transaction_id, user_id, event_time,
  round(CAST(amount - lo AS DOUBLE) / CAST(hi - lo AS DOUBLE), 6) AS score, amount >= 100 AS flagged,
  'v1' AS model_version, {AS_OF} AS scored_at FROM tx CROSS JOIN b""",
)
def scored_contract(spark: SparkSession, folder: str) -> DataFrame:
    """M3, M4, A13, P17, P19, with the amount as raw score."""
    raw = inputs.transactions(spark, folder).withColumn("raw_score", F.col("amount").cast("double"))
    return rounded(scoring.scored_rows(raw, 100.0, "v1", inputs.AS_OF).drop("raw_score"))


# ------------------------------------------------------------- monitoring


@register(
    "kpis",
    f"""WITH {SCORES} SELECT count(*) AS scored, count(*) FILTER (WHERE flagged) AS flagged,
  round(avg(CASE WHEN flagged THEN 1.0 ELSE 0.0 END), 6) AS alert_rate,
  round(max(score), 6) AS max_score FROM sc""",
)
def kpis(spark: SparkSession, folder: str) -> DataFrame:
    """A7."""
    return rounded(monitor.kpis(inputs.scores(spark, folder)))


def _bucket_sql(where: str, unit: str, minutes: int) -> str:
    return f"""WITH {SCORES}, w AS (SELECT * FROM sc WHERE {where}),
s AS (SELECT unnest(generate_series(date_trunc('{unit}', min(event_time)), max(event_time),
  INTERVAL {minutes} MINUTES)) AS bucket FROM w),
c AS (SELECT date_trunc('{unit}', event_time) AS bucket, count(*) AS n,
  count(*) FILTER (WHERE flagged) AS f FROM w GROUP BY 1)
SELECT bucket, CAST({minutes} AS BIGINT) AS minutes, coalesce(n, 0) AS transactions,
  coalesce(f, 0) AS flagged, (SELECT count(*) FROM s) < 5 AS few_buckets FROM s LEFT JOIN c USING (bucket)"""


@register("buckets_daily", _bucket_sql("true", "day", 1440))
def buckets_daily(spark: SparkSession, folder: str) -> DataFrame:
    """A8 over the whole span."""
    return monitor.buckets(inputs.scores(spark, folder))


@register(
    "buckets_hourly",
    _bucket_sql("event_time >= TIMESTAMP '2024-01-10' AND event_time < TIMESTAMP '2024-01-12'", "hour", 60),
)
def buckets_hourly(spark: SparkSession, folder: str) -> DataFrame:
    """A8 over two days."""
    day = inputs.AS_OF.date()
    rows = monitor.in_window(inputs.scores(spark, folder), day.replace(day=10), day.replace(day=11))
    return monitor.buckets(rows)


@register(
    "histogram",
    f"""WITH {SCORES} SELECT CAST(least(floor(score * 60) + 1, 60) AS BIGINT) AS bin, flagged,
  count(*) AS transactions FROM sc GROUP BY ALL""",
)
def histogram(spark: SparkSession, folder: str) -> DataFrame:
    """A9."""
    return monitor.histogram(inputs.scores(spark, folder))


@register(
    "flags_by_label",
    f"""WITH {SCORES} SELECT CAST(label AS BIGINT) AS label, count(*) AS n,
  count(*) FILTER (WHERE flagged) AS flagged FROM sc GROUP BY label""",
)
def flags_by_label(spark: SparkSession, folder: str) -> DataFrame:
    """A10."""
    return rounded(monitor.flags_by_label(inputs.scores(spark, folder)))


@register(
    "daily_flags",
    f"""WITH {SCORES} SELECT CAST(event_time AS DATE) AS day, count(*) AS txns,
  count(*) FILTER (WHERE flagged) AS flagged FROM sc GROUP BY 1""",
)
def daily_flags(spark: SparkSession, folder: str) -> DataFrame:
    """A11."""
    return monitor.daily_flags(inputs.scores(spark, folder))


@register(
    "score_summary",
    f"""WITH {SCORES} SELECT count(*) AS total, count(*) FILTER (WHERE flagged) AS flagged,
  round(avg(CASE WHEN flagged THEN 1.0 ELSE 0.0 END) * 100, 6) AS alert_pct,
  round(min(score), 6) AS min_score, round(max(score), 6) AS max_score,
  count(DISTINCT model_version) AS models FROM sc""",
)
def score_summary(spark: SparkSession, folder: str) -> DataFrame:
    """A12."""
    return rounded(monitor.summary(inputs.scores(spark, folder)))


def _top_sql(rows: int) -> str:
    return f"""WITH {SCORES} SELECT transaction_id, user_id, event_time, round(score, 6) AS score,
  flagged, model_version FROM sc ORDER BY sc.score DESC, transaction_id LIMIT {rows}"""


@register("top_scored", _top_sql(monitor.TOP_ROWS))
def top_scored(spark: SparkSession, folder: str) -> DataFrame:
    """L2."""
    return rounded(monitor.top_scored(inputs.scores(spark, folder)))


@register("drill_down_rows", _top_sql(monitor.DRILL_DOWN_ROWS))
def drill_down_rows(spark: SparkSession, folder: str) -> DataFrame:
    """L4."""
    return rounded(monitor.top_scored(inputs.scores(spark, folder), monitor.DRILL_DOWN_ROWS))


@register(
    "alerts",
    f"""WITH {SCORES}, r AS (SELECT * FROM sc WHERE flagged
  AND scored_at >= {AS_OF} - INTERVAL 24 HOURS)
SELECT transaction_id, round(score, 6) AS score, model_version, scored_at,
  (SELECT count(*) FROM r) AS flagged_rows FROM r
WHERE (SELECT count(*) FROM r) >= 3 ORDER BY r.score DESC, transaction_id LIMIT 5""",
)
def alerts(spark: SparkSession, folder: str) -> DataFrame:
    """L3."""
    return rounded(monitor.alerts(inputs.scores(spark, folder), inputs.AS_OF, threshold=3))


# ------------------------------------------------------------------- profile


@register(
    "profile_dataset",
    f"""WITH {TX} SELECT count(*) AS rows, count(DISTINCT user_id) AS users,
  min(event_time) AS first_event, max(event_time) AS last_event,
  count(DISTINCT event_time) AS distinct_times,
  round(count(DISTINCT event_time) / CAST(count(*) AS DOUBLE), 6) AS distinct_time_share,
  count(DISTINCT CAST(event_time AS DATE)) AS distinct_days,
  CAST(sum(label) AS BIGINT) AS fraud_rows, round(avg(label), 6) AS fraud_rate FROM tx""",
)
def profile_dataset(spark: SparkSession, folder: str) -> DataFrame:
    """A1."""
    return rounded(profile.dataset(inputs.transactions(spark, folder)))


@register(
    "profile_rows_per_user",
    f"""WITH {TX}, c AS (SELECT count(*) AS n FROM tx GROUP BY user_id)
SELECT min(n) AS min_rows, round(median(n), 6) AS median_rows, round(avg(n), 6) AS mean_rows,
  max(n) AS max_rows FROM c""",
)
def profile_rows_per_user(spark: SparkSession, folder: str) -> DataFrame:
    """A2."""
    return rounded(profile.rows_per_user(inputs.transactions(spark, folder)))


@register(
    "profile_rows_in_24h",
    f"""WITH {TX}, c AS (SELECT count(*) OVER (PARTITION BY user_id ORDER BY event_time RANGE BETWEEN
    INTERVAL '23 hours 59 minutes 59.999999 seconds' PRECEDING AND CURRENT ROW)
  - count(*) OVER (PARTITION BY user_id, event_time ORDER BY transaction_id
    ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS n FROM tx)
SELECT round(median(n), 6) AS median_count, round(avg(n), 6) AS mean_count, max(n) AS max_count,
  round(avg(CASE WHEN n = 1 THEN 1.0 ELSE 0.0 END), 6) AS share_of_one FROM c""",
)
def profile_rows_in_24h(spark: SparkSession, folder: str) -> DataFrame:
    """A3."""
    return rounded(profile.rows_in_24h(inputs.transactions(spark, folder)))


@register(
    "profile_amounts_by_label",
    f"""WITH {TX} SELECT CAST(label AS BIGINT) AS label,
  round(quantile_cont(CAST(amount AS DOUBLE), 0.5), 6) AS p50,
  round(quantile_cont(CAST(amount AS DOUBLE), 0.9), 6) AS p90,
  round(quantile_cont(CAST(amount AS DOUBLE), 0.99), 6) AS p99,
  CAST(max(amount) AS DOUBLE) AS max_amount FROM tx GROUP BY label""",
)
def profile_amounts_by_label(spark: SparkSession, folder: str) -> DataFrame:
    """A4."""
    return rounded(profile.amounts_by_label(inputs.transactions(spark, folder)))


@register(
    "profile_overlap",
    f"""WITH {TX}, b AS (SELECT quantile_cont(CAST(amount AS DOUBLE), 0.05) AS lo,
  quantile_cont(CAST(amount AS DOUBLE), 0.95) AS hi FROM tx WHERE label = 0)
SELECT round(avg(CASE WHEN CAST(amount AS DOUBLE) BETWEEN lo AND hi THEN 1.0 ELSE 0.0 END), 6)
  AS overlap_share FROM tx CROSS JOIN b WHERE label = 1""",
)
def profile_overlap(spark: SparkSession, folder: str) -> DataFrame:
    """A5."""
    return rounded(profile.overlap(inputs.transactions(spark, folder)))


@register(
    "profile_by_hour",
    f"""WITH {TX} SELECT extract(hour FROM event_time) AS hour, count(*) AS transactions
FROM tx GROUP BY 1""",
)
def profile_by_hour(spark: SparkSession, folder: str) -> DataFrame:
    """A6."""
    return rounded(profile.by_hour(inputs.transactions(spark, folder)))


@register(
    "exact_quantiles",
    """SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.1), 6) AS p10,
  round(quantile_cont(l_extendedprice, 0.5), 6) AS p50,
  round(quantile_cont(l_extendedprice, 0.999), 6) AS p999 FROM lineitem GROUP BY l_returnflag""",
)
def exact_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    """E3 on the largest table."""
    rows = inputs.table(spark, folder, "lineitem")
    wanted = {"p10": 0.1, "p50": 0.5, "p999": 0.999}
    return rounded(quantiles(rows, "l_extendedprice", wanted, ["l_returnflag"], steady=True))


# -------------------------------------------------------------- incremental


@register(
    "affected_history",
    f"""WITH {TX}, late AS (SELECT DISTINCT user_id FROM tx
  WHERE event_time >= {AS_OF} - INTERVAL 1 HOUR)
SELECT transaction_id, user_id FROM tx WHERE user_id IN (SELECT user_id FROM late)""",
)
def affected_history(spark: SparkSession, folder: str) -> DataFrame:
    """Users to compute again."""
    rows = inputs.transactions(spark, folder)
    late = tables.trailing_window(rows, timedelta(hours=1), inputs.AS_OF, ("user_id",))
    return affected_rows(rows, late).select("transaction_id", "user_id")


@register(
    "late_rows",
    f"""WITH {TX} SELECT transaction_id, event_time FROM tx
WHERE TIMESTAMP '{inputs.SEEN_UNTIL}' > event_time + INTERVAL 2 DAYS""",
)
def late(spark: SparkSession, folder: str) -> DataFrame:
    """Rows loaded long after their event."""
    rows = inputs.transactions(spark, folder).withColumn(
        "loaded_at", F.lit(inputs.SEEN_UNTIL).cast("timestamp_ntz")
    )
    return late_rows(rows, 2).select("transaction_id", "event_time")


# --------------------------------------------------- models (no SQL form: rows only)


def _split_features(spark: SparkSession, folder: str) -> DataFrame:
    truth_rows = inputs.ground_truth(spark, folder)
    return evaluate.labelled_features(inputs.transactions(spark, folder), truth_rows)


@register("isolation_forest_scores")
def isolation_forest_scores(spark: SparkSession, folder: str) -> DataFrame:
    """M1, M2, M3, E2."""
    rows = pinned(compute(inputs.transactions(spark, folder), carry=["label"]))
    _, raw = forest.fit_and_score(rows, FEATURES)
    choice = scoring.choose_threshold(raw)
    return scoring.scored_rows(raw, choice.value, "isoforest_1", inputs.AS_OF)


@register("stored_model_scores")
def stored_model_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Train, store, load the newest model, score with it."""
    rows = inputs.transactions(spark, folder)
    layers = Layers(f"{checkpoint_folder(spark)}/models-{uuid.uuid4().hex}")
    jobs.train(spark, rows, layers, now=inputs.AS_OF)
    since = inputs.AS_OF - timedelta(days=10)
    return jobs.score_rows(spark, rows, layers, inputs.AS_OF, since)


def _evaluation(spark: SparkSession, folder: str, models: Sequence[str]) -> DataFrame:
    split = _split_features(spark, folder)
    choosing, reporting = (pinned(part) for part in evaluate.scored(split, models))
    return evaluate.report(choosing, reporting)[0]


@register("evaluate_unsupervised")
def evaluate_unsupervised(spark: SparkSession, folder: str) -> DataFrame:
    """M1, M2, M8, M10, M11, E1-E8, E10, K11."""
    names = [evaluate.FOREST_4, evaluate.FOREST_7, evaluate.BY_AMOUNT, evaluate.BY_CHANCE]
    return _evaluation(spark, folder, names)


@register("evaluate_logistic")
def evaluate_logistic(spark: SparkSession, folder: str) -> DataFrame:
    """M5, M7, M9, E10."""
    return _evaluation(spark, folder, [evaluate.LOGISTIC_7])


@register("evaluate_random_forest")
def evaluate_random_forest(spark: SparkSession, folder: str) -> DataFrame:
    """M6, M7, M9, E10."""
    return _evaluation(spark, folder, [evaluate.RANDOM_FOREST_7])
