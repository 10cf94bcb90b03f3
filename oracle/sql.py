"""The same queries as plain SQL for DuckDB, written without the library."""

from __future__ import annotations

DOMAIN = """
WITH n AS (SELECT count(*) AS n_users FROM customer),
users AS (
  SELECT c_custkey AS id, c_name AS username,
    CASE WHEN c_custkey % 13 <> 0 THEN c_mktsegment = 'MACHINERY' END AS is_test_account,
    CASE WHEN c_custkey % 11 <> 0 THEN 1960 + c_custkey % 55 END AS year_of_birth,
    TIMESTAMP '2023-06-01' + to_days(CAST(c_custkey % 200 AS INTEGER)) AS created_at
  FROM customer),
base AS (
  SELECT event_id, ts, epoch_us(ts) AS us, user_id, event_type, value, props,
    CASE event_type WHEN 'signup' THEN 'upload' WHEN 'view' THEN 'view' WHEN 'click' THEN 'comment'
      WHEN 'error' THEN 'flag' WHEN 'purchase' THEN 'comment_flag' END AS kind
  FROM events),
images AS (
  SELECT event_id AS id, user_id,
    CASE WHEN event_id % 7 <> 0 THEN props END AS caption,
    ['Bread', 'Dairy product', 'Dessert', 'Egg', 'Fried food', 'Meat', 'Noodles/Pasta', 'Rice',
     'Seafood', 'Soup', 'Vegetable/Fruit', NULL][event_id % 12 + 1] AS category,
    ts AS created_at,
    CASE WHEN value > 150 THEN ts + INTERVAL 1 DAY END AS deleted_at
  FROM base WHERE kind = 'upload'),
activity AS (
  SELECT event_id, ts, us, user_id, kind,
    last_value(CASE WHEN kind = 'upload' THEN event_id END IGNORE NULLS) OVER w AS image_id,
    last_value(CASE WHEN kind = 'comment' THEN event_id END IGNORE NULLS) OVER w AS last_comment
  FROM base
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
views AS (SELECT event_id, image_id, ts FROM activity WHERE kind = 'view'),
comments AS (
  SELECT event_id AS id, image_id, (event_id * 7) % (SELECT n_users FROM n) AS user_id, ts AS created_at
  FROM activity WHERE kind = 'comment'),
flags AS (
  SELECT event_id AS id, CASE WHEN kind = 'flag' THEN image_id END AS image_id,
    CASE WHEN kind = 'comment_flag' THEN last_comment END AS comment_id,
    (event_id * 7) % (SELECT n_users FROM n) AS user_id, ts AS created_at
  FROM activity WHERE kind IN ('flag', 'comment_flag')),
signals AS (SELECT event_id, image_id, kind, ts, us FROM activity WHERE kind IN ('view', 'comment', 'flag')),
requests AS (
  SELECT event_id AS request_id, image_id, coalesce(['viral', 'suspicious', NULL][event_id % 3 + 1], 'unknown') AS trigger, ts, us
  FROM activity WHERE kind = 'comment_flag' AND image_id IS NOT NULL),
"""

ELIGIBLE = """
marked AS (
  SELECT i.*, u.created_at AS user_created_at, coalesce(u.is_test_account, false) AS is_test,
    u.year_of_birth IS NOT NULL AND year(i.created_at) - u.year_of_birth < 18 AS is_minor,
    i.deleted_at IS NOT NULL AS is_deleted
  FROM images i JOIN users u ON i.user_id = u.id),
eligible AS (SELECT * FROM marked WHERE NOT is_test AND NOT is_minor AND NOT is_deleted),
ok_comments AS (
  SELECT c.* FROM comments c LEFT JOIN users u ON c.user_id = u.id
  WHERE NOT coalesce(u.is_test_account, false)
    AND NOT coalesce(year(c.created_at) - u.year_of_birth < 18, false)),
ok_flags AS (
  SELECT f.* FROM flags f LEFT JOIN users u ON f.user_id = u.id
  WHERE NOT coalesce(u.is_test_account, false)
    AND NOT coalesce(year(f.created_at) - u.year_of_birth < 18, false)),
"""


def iso(column: str, name: str | None = None) -> str:
    return f"strftime({column}, '%Y-%m-%dT%H:%M:%S.%f') AS {name or column}"


def windows_of(seconds: int, source: str = "signals") -> str:
    return f"""
  SELECT kind, image_id, time_bucket(INTERVAL {seconds} SECOND, ts) AS window_start,
    time_bucket(INTERVAL {seconds} SECOND, ts) + INTERVAL {seconds} SECOND AS window_end,
    count(*) AS event_count
  FROM {source} WHERE image_id IS NOT NULL GROUP BY ALL"""


LABELS = """
labels_of AS (
  SELECT i.id AS image_id, CAST(EXISTS (
      SELECT 1 FROM ok_flags f WHERE f.image_id = i.id AND f.created_at >= i.created_at
        AND f.created_at <= i.created_at + INTERVAL 24 HOUR) AS BIGINT) AS label
  FROM eligible i),
"""


def _counted(kind: str, minutes: int | None, name: str) -> str:
    recent = "" if minutes is None else f" AND w.window_end > p.cutoff - INTERVAL {minutes} MINUTE"
    return f"CAST(coalesce(sum(w.event_count) FILTER (w.kind = '{kind}'{recent}), 0) AS BIGINT) AS {name}"


FEATURES = f"""
windows AS ({windows_of(3600)}),
points AS (
  SELECT i.id AS image_id, i.created_at, i.user_id, m AS decision_point_minutes,
    i.created_at + to_minutes(CAST(m AS INTEGER)) AS cutoff
  FROM eligible i, (SELECT unnest([0, 360, 1440]) AS m)),
window_counts AS (
  SELECT p.image_id, CAST(p.decision_point_minutes AS BIGINT) AS decision_point_minutes,
    {_counted('view', 60, 'views_5min')}, {_counted('view', 720, 'views_1hr')},
    {_counted('comment', 60, 'comments_5min')}, {_counted('comment', 720, 'comments_1hr')},
    {_counted('flag', 60, 'flags_5min')}, {_counted('flag', 720, 'flags_1hr')},
    {_counted('flag', None, 'total_flags')}
  FROM points p LEFT JOIN windows w
    ON w.image_id = p.image_id AND w.window_start >= p.created_at AND w.window_end <= p.cutoff
  GROUP BY 1, 2),
user_counts AS (
  SELECT p.image_id, CAST(p.decision_point_minutes AS BIGINT) AS decision_point_minutes,
    (SELECT count(*) FROM eligible e WHERE e.user_id = p.user_id AND e.created_at <= p.cutoff) AS user_image_count
  FROM points p),
"""

TRAINING = f"""
training AS (
  SELECT CAST(i.id AS VARCHAR) AS image_id, c.decision_point_minutes,
    c.decision_point_minutes * 60 AS time_since_upload_seconds,
    hour(i.created_at) AS hour_of_day, isodow(i.created_at) - 1 AS day_of_week,
    CAST(isodow(i.created_at) >= 6 AS BIGINT) AS is_weekend,
    views_5min, views_1hr, comments_5min, comments_1hr, flags_5min, flags_1hr, total_flags,
    CASE WHEN views_5min > 0 THEN views_5min / 5.0::DOUBLE ELSE 0.0::DOUBLE END AS view_velocity_per_min,
    comments_1hr / greatest(views_1hr, 1)::DOUBLE AS comment_to_view_ratio,
    CAST(views_5min + 5 * comments_5min AS DOUBLE) AS recent_engagement_score,
    length(coalesce(i.caption, '')) AS caption_length,
    CAST(length(coalesce(i.caption, '')) > 0 AS BIGINT) AS has_caption,
    user_image_count,
    CAST(trunc((epoch_us(i.created_at) - epoch_us(i.user_created_at)) / 86400e6) AS BIGINT) AS user_age_days,
    coalesce(i.category, 'Unknown') AS category,
    l.label AS label_needs_moderation_24h
  FROM eligible i JOIN labels_of l ON l.image_id = i.id
    JOIN window_counts c ON c.image_id = i.id
    JOIN user_counts u ON u.image_id = i.id AND u.decision_point_minutes = c.decision_point_minutes),
"""

SERVING = """
at_request AS (
  SELECT r.request_id, r.image_id, r.trigger, r.ts,
    count(*) FILTER (s.kind = 'view' AND s.us >= r.us - 3600000000) AS views_5min,
    count(*) FILTER (s.kind = 'view' AND s.us >= r.us - 43200000000) AS views_1hr,
    count(*) FILTER (s.kind = 'comment' AND s.us >= r.us - 3600000000) AS comments_5min,
    count(*) FILTER (s.kind = 'comment' AND s.us >= r.us - 43200000000) AS comments_1hr,
    count(*) FILTER (s.kind = 'flag' AND s.us >= r.us - 3600000000) AS flags_5min,
    count(*) FILTER (s.kind = 'flag' AND s.us >= r.us - 43200000000) AS flags_1hr,
    count(*) FILTER (s.kind = 'view') AS total_views,
    count(*) FILTER (s.kind = 'comment') AS total_comments,
    count(*) FILTER (s.kind = 'flag') AS total_flags
  FROM requests r LEFT JOIN signals s ON s.image_id = r.image_id AND s.us <= r.us
  GROUP BY 1, 2, 3, 4),
metadata AS (
  SELECT i.id AS image_id, i.user_id, coalesce(nullif(i.category, ''), 'Unknown') AS category,
    length(coalesce(i.caption, '')) AS caption_length,
    CAST(length(coalesce(i.caption, '')) > 0 AS BIGINT) AS has_caption,
    i.created_at AS uploaded_at, u.created_at AS user_created_at,
    (SELECT count(*) FROM images x WHERE x.user_id = i.user_id) AS user_image_count
  FROM images i JOIN users u ON u.id = i.user_id),
request_features AS (
  SELECT a.*, m.* EXCLUDE (image_id),
    CAST(trunc((epoch_us(a.ts) - epoch_us(m.uploaded_at)) / 1e6) AS BIGINT) AS time_since_upload_seconds,
    CAST(trunc((epoch_us(a.ts) - epoch_us(m.user_created_at)) / 86400e6) AS BIGINT) AS user_age_days,
    hour(m.uploaded_at) AS hour_of_day, isodow(m.uploaded_at) - 1 AS day_of_week,
    CAST(isodow(m.uploaded_at) >= 6 AS BIGINT) AS is_weekend,
    CASE WHEN views_5min > 0 THEN views_5min / 5.0::DOUBLE ELSE 0.0::DOUBLE END AS view_velocity_per_min,
    comments_1hr / greatest(views_1hr, 1)::DOUBLE AS comment_to_view_ratio,
    CAST(views_5min + 5 * comments_5min AS DOUBLE) AS recent_engagement_score
  FROM at_request a JOIN metadata m ON m.image_id = a.image_id),
"""


def scored(source: str) -> str:
    """Rule score with the limits for the test data; one column per rule."""
    return f"""
ruled AS (
  SELECT *,
    total_flags > 0 AS r1,
    comments_5min > 0 AS r2,
    comment_to_view_ratio::FLOAT::DOUBLE > 0.5 AS r3,
    comments_1hr > 1 AND views_1hr < 2 AS r4,
    view_velocity_per_min::FLOAT::DOUBLE > 0.1 AS r5,
    recent_engagement_score > 2 AS r6,
    user_image_count > 10 AS r7
  FROM {source}),
scored AS (
  SELECT *, least(greatest(0.3::DOUBLE
    + CASE WHEN r1 THEN 0.4::DOUBLE ELSE 0::DOUBLE END
    + CASE WHEN r2 THEN 0.3::DOUBLE ELSE 0::DOUBLE END
    + CASE WHEN r3 THEN 0.2::DOUBLE ELSE 0::DOUBLE END
    + CASE WHEN r4 THEN 0.3::DOUBLE ELSE 0::DOUBLE END
    + CASE WHEN r5 THEN 0.2::DOUBLE ELSE 0::DOUBLE END
    + CASE WHEN r6 THEN 0.15::DOUBLE ELSE 0::DOUBLE END
    + CASE WHEN r7 THEN -0.1::DOUBLE ELSE 0::DOUBLE END, 0::DOUBLE), 1::DOUBLE) AS probability
  FROM ruled),
"""


MESSAGES = """
sent AS (
  SELECT event_id AS seq,
    CASE WHEN event_id % 17 = 0 THEN 'like' WHEN kind = 'comment_flag' THEN 'flag' ELSE kind END AS event_type,
    CASE WHEN kind <> 'comment_flag' THEN CAST(image_id AS VARCHAR) END AS image_id,
    CASE WHEN kind = 'comment' AND event_id % 19 <> 0 THEN CAST(event_id AS VARCHAR) END AS comment_id,
    kind = 'view' AS is_view,
    -- Time text sits in viewed_at for views; a view renamed to another type has none where it is looked for.
    CASE WHEN event_id % 10 NOT IN (3, 4)
      AND (kind = 'view') = (event_id % 17 <> 0 AND kind = 'view') THEN us END AS us,
    ts, event_id
  FROM activity),
timed AS (
  SELECT *, CASE event_type WHEN 'view' THEN 'views' WHEN 'comment' THEN 'comments' WHEN 'upload' THEN 'uploads'
      WHEN 'flag' THEN 'flags' END AS topic,
    event_type <> 'like' AND image_id IS NOT NULL AND us IS NOT NULL
      AND (event_type <> 'comment' OR comment_id IS NOT NULL) AS ok
  FROM sent),
"""

COUNTS = """
user_counts_at AS (
  SELECT event_id, user_id, kind, ts, us,
    count(*) FILTER (kind = 'view') OVER own1 AS v1, count(*) FILTER (kind = 'view') OVER own2 AS v2,
    count(*) FILTER (kind = 'view') OVER own7 AS v7,
    count(*) FILTER (kind = 'comment') OVER own1 AS c1, count(*) FILTER (kind = 'comment') OVER own2 AS c2,
    count(*) FILTER (kind = 'comment') OVER own7 AS c7,
    count(*) FILTER (kind = 'flag') OVER own1 AS f1, count(*) FILTER (kind = 'flag') OVER own2 AS f2,
    count(*) FILTER (kind = 'flag') OVER own7 AS f7,
    count(*) FILTER (kind = 'view') OVER x1 AS xv1, count(*) FILTER (kind = 'view') OVER x2 AS xv2,
    count(*) FILTER (kind = 'view') OVER x7 AS xv7,
    count(*) FILTER (kind = 'view') OVER (PARTITION BY user_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) AS total_views
  FROM base WHERE kind IN ('view', 'comment', 'flag')
  WINDOW own1 AS (PARTITION BY user_id ORDER BY us RANGE BETWEEN 86399999999 PRECEDING AND CURRENT ROW),
    own2 AS (PARTITION BY user_id ORDER BY us RANGE BETWEEN 172799999999 PRECEDING AND CURRENT ROW),
    own7 AS (PARTITION BY user_id ORDER BY us RANGE BETWEEN 604799999999 PRECEDING AND CURRENT ROW),
    x1 AS (PARTITION BY user_id ORDER BY us RANGE BETWEEN 86400000000 PRECEDING AND CURRENT ROW),
    x2 AS (PARTITION BY user_id ORDER BY us RANGE BETWEEN 172800000000 PRECEDING AND CURRENT ROW),
    x7 AS (PARTITION BY user_id ORDER BY us RANGE BETWEEN 604800000000 PRECEDING AND CURRENT ROW)),
crossed AS (
  SELECT user_id, event_id, ts, 'viral' AS alert_type, 'views_5min' AS metric,
    CASE WHEN kind = 'view' THEN v2 ELSE xv2 END AS value FROM user_counts_at WHERE kind <> 'flag' AND value >= 3
  UNION ALL
  SELECT user_id, event_id, ts, 'suspicious', 'comments_1min', c1 FROM user_counts_at WHERE kind = 'comment' AND c1 >= 2
  UNION ALL
  SELECT user_id, event_id, ts, 'popular', 'views_1hr', CASE WHEN kind = 'view' THEN v7 ELSE xv7 END AS value
  FROM user_counts_at WHERE kind <> 'flag' AND (CASE WHEN kind = 'view' THEN v7 ELSE xv7 END) >= 4),
first_alerts AS (
  SELECT * FROM crossed
  QUALIFY row_number() OVER (PARTITION BY user_id, alert_type ORDER BY ts, event_id) = 1),
reached AS (
  SELECT user_id, 'views' AS milestone_type, m AS milestone_value, ts AS reached_at, event_id
  FROM user_counts_at, (SELECT unnest([1, 5, 10]) AS m)
  WHERE kind = 'view' AND total_views >= m
  QUALIFY row_number() OVER (PARTITION BY user_id, m ORDER BY ts, event_id) = 1),
"""

RAW = """
raw_users AS (
  SELECT id, CASE WHEN id % 29 <> 0 THEN 'name-' || CAST(id // 2 AS VARCHAR) END AS username,
    CASE WHEN id % 7 <> 0 THEN id % 4 END AS tos_version_accepted,
    CASE WHEN id % 11 <> 0 THEN 1880 + id % 160 END AS year_of_birth, is_test_account
  FROM users),
raw_images AS (
  SELECT id, user_id, CASE WHEN id % 9 <> 0 THEN 'x' END AS s3_url,
    ['user_upload', 'synthetic', 'import', 'scrape', NULL][id % 5 + 1] AS source, CASE WHEN id % 3 = 0 THEN 1 END AS views,
    deleted_at
  FROM images),
raw_comments AS (
  SELECT id, image_id, user_id, 'text' AS content, CASE WHEN id % 2 = 0 THEN false END AS moderator_hidden,
    id + 1 AS moderator_action_id, created_at
  FROM comments),
raw_flags AS (
  SELECT id, user_id, image_id, comment_id, 'spam' AS reason,
    ['pending', 'confirmed', 'rejected', 'open', NULL][id % 5 + 1] AS review_status,
    CASE WHEN id % 3 = 0 THEN id END AS moderation_action_id
  FROM flags),
raw_moderation AS (
  SELECT id, ['image', 'comment', 'account', 'page', NULL][id % 5 + 1] AS target_type,
    coalesce(image_id, comment_id) AS target_id, 'heuristic' AS inference_mode, (id % 50) / 40.0 AS risk_score,
    CASE WHEN id % 2 = 0 THEN 'v1' END AS policy_version
  FROM flags),
"""

UPLOADS = """
uploads AS (
  SELECT CAST(id AS VARCHAR) AS image_id, CASE WHEN id % 3 = 0 THEN 'Soup' ELSE coalesce(category, 'unknown') END AS category,
    CAST(length(coalesce(caption, '')) AS VARCHAR) AS caption_length,
    strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f') AS uploaded_at,
    CASE WHEN id % 4 <> 0 THEN CAST(user_id AS VARCHAR) ELSE '' END AS user_id,
    CASE WHEN id % 3 = 0 THEN id + 1000000000 ELSE id END AS seq, created_at
  FROM images),
"""

FILES = """
names AS (
  SELECT ['training', 'validation', 'evaluation'][event_id % 3 + 1] AS split, event_id % 13 AS number,
    ['jpg', 'JPEG', 'png', 'txt', 'Jpg'][event_id % 5 + 1] AS ending, event_id
  FROM base),
image_names AS (
  SELECT *, 'class_' || lpad(CAST(number AS VARCHAR), 2, '0') AS class FROM names WHERE ending <> 'txt'),
"""


def sql(body: str, *parts: str) -> str:
    return (DOMAIN + "".join(parts)).rstrip().rstrip(",") + "\n" + body


WINDOW_COLUMNS = f"kind, image_id, {iso('window_start')}, {iso('window_end')}, event_count"
TRAIN = (ELIGIBLE, LABELS, FEATURES, TRAINING)
# Names and order of the numeric columns and of the vector.
NUMERIC = [
    "time_since_upload_seconds",
    "hour_of_day",
    "day_of_week",
    "views_5min",
    "views_1hr",
    "comments_5min",
    "comments_1hr",
    "flags_5min",
    "flags_1hr",
    "total_flags",
    "view_velocity_per_min",
    "comment_to_view_ratio",
    "recent_engagement_score",
    "caption_length",
    "user_image_count",
    "user_age_days",
]
TRAINING_COLUMNS = [
    ("image_id", "string"),
    ("decision_point_minutes", "int"),
    ("time_since_upload_seconds", "bigint"),
    ("hour_of_day", "int"),
    ("day_of_week", "int"),
    ("is_weekend", "int"),
    ("views_5min", "bigint"),
    ("views_1hr", "bigint"),
    ("comments_5min", "bigint"),
    ("comments_1hr", "bigint"),
    ("flags_5min", "bigint"),
    ("flags_1hr", "bigint"),
    ("total_flags", "bigint"),
    ("view_velocity_per_min", "double"),
    ("comment_to_view_ratio", "double"),
    ("recent_engagement_score", "double"),
    ("caption_length", "int"),
    ("has_caption", "int"),
    ("user_image_count", "bigint"),
    ("user_age_days", "bigint"),
    ("category", "string"),
    ("label_needs_moderation_24h", "int"),
]
VECTOR = [
    "time_since_upload_seconds",
    "hour_of_day",
    "day_of_week",
    "is_weekend",
    "views_5min",
    "views_1hr",
    "comments_5min",
    "comments_1hr",
    "flags_5min",
    "flags_1hr",
    "total_flags",
    "view_velocity_per_min",
    "comment_to_view_ratio",
    "recent_engagement_score",
    "caption_length",
    "has_caption",
    "user_image_count",
    "user_age_days",
]
HOT = [
    ("category_Bread", "Bread"), ("category_Dairy", "Dairy product"), ("category_Dessert", "Dessert"),
    ("category_Egg", "Egg"), ("category_Fried", "Fried food"), ("category_Meat", "Meat"),
    ("category_Noodles", "Noodles/Pasta"), ("category_Rice", "Rice"), ("category_Seafood", "Seafood"),
    ("category_Soup", "Soup"), ("category_Veggie", "Vegetable/Fruit"),
]
VECTOR_SQL = ", ".join(
    [f"CAST(CAST({n} AS FLOAT) AS DOUBLE) AS {n}" for n in VECTOR]
    + [f"CAST(trim(category) = '{v}' AS INTEGER)::DOUBLE AS {c}" for c, v in HOT]
)


def _summary_line(i: int, name: str, compact: bool) -> str:
    if name.startswith("category_"):
        value = dict(HOT)[name]
        text = f"CASE WHEN trim(category) = '{value}' THEN 'Yes' ELSE 'No' END"
        zero = f"trim(category) <> '{value}'"
    else:
        text = f"CAST(CAST(trunc({name}::FLOAT) AS BIGINT) AS VARCHAR)"
        zero = f"{name} = 0"
    line = f"'  [{i:2d}] {name:<30s} = ' || {text}"
    if compact and name != "total_flags":
        line = f"CASE WHEN NOT ({zero}) THEN {line} END"
    return line


def _summary(compact: bool) -> str:
    names = VECTOR + [c for c, _ in HOT]
    lines = ", ".join(_summary_line(i, n, compact) for i, n in enumerate(names))
    return f"concat_ws(chr(10), {lines})"


REASONS = """concat_ws(' | ',
  CASE WHEN r1 THEN format('[HIGH RISK] Content has been flagged {} time(s)', total_flags) END,
  CASE WHEN r2 THEN format('[HIGH RISK] Unusual comment activity ({} comments in 5 minutes)', comments_5min) END,
  CASE WHEN r3 THEN format('[HIGH RISK] High comment-to-view ratio ({:.2f})', comment_to_view_ratio::FLOAT::DOUBLE) END,
  CASE WHEN r4 THEN format('[HIGH RISK] Suspicious pattern: {} comments but only {} views in 1 hour', comments_1hr, views_1hr) END,
  CASE WHEN r5 THEN format('[MEDIUM RISK] Viral content ({:.1f} views/min) - may need review', view_velocity_per_min::FLOAT::DOUBLE) END,
  CASE WHEN r6 THEN format('[MEDIUM RISK] High recent activity (score: {})', CAST(recent_engagement_score AS BIGINT)) END,
  CASE WHEN r7 THEN format('[LOW RISK] Established user ({} images)', user_image_count) END,
  CASE WHEN NOT (r1 OR r2 OR r3 OR r4 OR r5 OR r6 OR r7) THEN
    CASE WHEN total_flags = 0 AND comments_1hr < 5 THEN '[LOW RISK] Normal activity, no flags'
      ELSE 'No significant risk signals detected' END END)"""

# Factors by falling absolute value; ties stay in rule order.
RANKED = """concat_ws(', ', CASE WHEN r1 THEN 'flags_reported=0.40' END, 'base=0.30',
  CASE WHEN r2 THEN 'comment_spam=0.30' END, CASE WHEN r4 THEN 'bot_pattern=0.30' END,
  CASE WHEN r3 THEN 'unusual_engagement=0.20' END, CASE WHEN r5 THEN 'viral_content=0.20' END,
  CASE WHEN r6 THEN 'high_activity=0.15' END, CASE WHEN r7 THEN 'established_user=-0.10' END)"""

WINDOWS_SQL = sql(f"SELECT {WINDOW_COLUMNS} FROM ({windows_of(3600)})")
TOTALS_SQL = sql(
    """SELECT image_id, count(*) FILTER (kind = 'view') AS total_views,
      count(*) FILTER (kind = 'comment') AS total_comments, count(*) FILTER (kind = 'flag') AS total_flags
    FROM signals WHERE image_id IS NOT NULL GROUP BY 1"""
)
ALERTS_SQL = sql(f"SELECT user_id, alert_type, event_id, {iso('ts')}, metric, value FROM first_alerts", COUNTS)
REQUESTS_SQL = sql(
    """SELECT user_id AS image_id, alert_type AS trigger, metric, value, epoch_us(ts) AS epoch_us
    FROM first_alerts WHERE alert_type IN ('viral', 'suspicious')""",
    COUNTS,
)
MILESTONES_SQL = sql(
    f"SELECT user_id, milestone_type, CAST(milestone_value AS BIGINT) AS milestone_value, event_id, {iso('reached_at')} FROM reached",
    COUNTS,
)

METADATA_SQL = sql("SELECT * EXCLUDE (created_at) FROM uploads", UPLOADS)


def _check(table: str, rule: str, broken: str) -> str:
    return f"SELECT '{table}' AS \"table\", '{rule}' AS rule, CAST(id AS VARCHAR) AS row_key FROM raw_{table} WHERE {broken}"


KEPT = {
    "users": "NOT coalesce(is_test_account, false)",
    "images": "deleted_at IS NULL",
    "comments": "created_at >= TIMESTAMP '2024-01-16'",
    "moderation": "target_id IS NOT NULL",
}


def _foreign_key(child: str, column: str, parent: str) -> str:
    return f"""SELECT '{child}.{column}' AS "constraint", CAST({column} AS VARCHAR) AS missing_key, count(*) AS child_rows
    FROM raw_{child} WHERE {column} IS NOT NULL
      AND {column} NOT IN (SELECT id FROM raw_{parent} WHERE {KEPT[parent]}) GROUP BY 1, 2"""


def _nulls(table: str, columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS \"table\", '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS nulls FROM raw_{table}"
        for c in columns.split()
    )


def _default(table: str, column: str, value: str) -> str:
    return f"""SELECT '{table}.{column}' AS "column", CAST(coalesce({column}, {value}) AS VARCHAR) AS value, count(*) AS rows
    FROM raw_{table} GROUP BY 1, 2"""


ORACLE: dict[str, str] = {
    "event_routing_counts": sql(
        "SELECT topic, event_type, count(*) AS events FROM timed WHERE ok GROUP BY 1, 2", MESSAGES
    ),
    "event_parse_stats": sql(
        """SELECT event_type, count(*) AS events_read, count(*) FILTER (ok) AS events_processed,
          count(*) FILTER (NOT ok) AS events_skipped FROM timed GROUP BY 1""",
        MESSAGES,
    ),
    "event_quarantine": sql(
        """SELECT event_type, CASE WHEN event_type = 'like' THEN 'unknown_type' WHEN image_id IS NULL THEN 'missing_image'
          WHEN event_type = 'comment' AND comment_id IS NULL THEN 'missing_comment' ELSE 'bad_time' END AS reason,
          count(*) AS events FROM timed WHERE NOT ok GROUP BY 1, 2""",
        MESSAGES,
    ),
    "iso_timestamp_parse": sql(
        f"""SELECT seq, us AS epoch_us, us - us % 300000000 AS bucket_us,
          {iso('make_timestamp(us - us % 300000000 + 300000000)', 'bucket_end')},
          year(make_timestamp(us)) AS year FROM timed""",
        MESSAGES,
    ),
    "event_json_roundtrip": sql(
        """SELECT seq, topic, event_type, image_id, comment_id, CASE WHEN is_view THEN clock END AS viewed_at,
          CASE WHEN NOT is_view THEN clock END AS created_at
        FROM (SELECT *, CASE event_id % 10
            WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z'
            WHEN 1 THEN strftime(ts + INTERVAL 330 MINUTE, '%Y-%m-%dT%H:%M:%S.%f') || '+05:30'
            WHEN 2 THEN strftime(ts - INTERVAL 5 HOUR, '%Y-%m-%dT%H:%M:%S.%f') || '-05:00'
            WHEN 3 THEN 'yesterday' WHEN 4 THEN NULL
            ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS clock FROM timed)""",
        MESSAGES,
    ),
    "event_projections": sql(
        """SELECT 'views' AS topic, CAST(json_object('event_type', 'view', 'image_id', CAST(image_id AS VARCHAR),
            'viewed_at', strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')) AS VARCHAR) AS value FROM views
        UNION ALL SELECT 'comments', CAST(json_object('event_type', 'comment', 'comment_id', CAST(id AS VARCHAR),
            'image_id', CAST(image_id AS VARCHAR), 'user_id', CAST(user_id AS VARCHAR), 'content', 'nice',
            'created_at', strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00') AS VARCHAR) FROM comments
        UNION ALL SELECT 'uploads', CAST(json_object('event_type', 'upload', 'image_id', CAST(id AS VARCHAR),
            'user_id', CAST(user_id AS VARCHAR), 'category', category, 'caption', caption,
            'created_at', strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00',
            's3_url', 'http://store/images/' || CAST(id AS VARCHAR)) AS VARCHAR) FROM images
        UNION ALL SELECT 'flags', CAST(json_object('event_type', 'flag', 'flag_id', CAST(id AS VARCHAR),
            'user_id', CAST(user_id AS VARCHAR), 'image_id', CAST(image_id AS VARCHAR),
            'comment_id', CAST(comment_id AS VARCHAR), 'reason', 'spam',
            'created_at', strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00') AS VARCHAR) FROM flags
          WHERE image_id IS NOT NULL OR comment_id IS NOT NULL"""
    ),
    "topic_rollup": sql(
        """SELECT coalesce(topic, 'TOTAL') AS topic, count(*) AS messages FROM timed WHERE topic IS NOT NULL
        GROUP BY ROLLUP (topic)""",
        MESSAGES,
    ),
    "raw_snapshots": sql(
        " UNION ALL ".join(
            f"""SELECT '{t}' AS "table", count(*) AS rows, CAST(sum(id) AS BIGINT) AS id_sum,
              max(strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f')) AS newest FROM {t}"""
            for t in ("users", "images", "comments", "flags")
        )
    ),
    "training_metadata": sql(
        "SELECT '7' AS snapshot_id, count(*) AS rows_seen, 'LogisticRegression' AS algorithm FROM training", *TRAIN
    ),
    "comment_dedup": sql("SELECT image_id, count(DISTINCT id) AS comments FROM comments GROUP BY 1"),
    "tumbling_counts_5min": sql(f"SELECT {WINDOW_COLUMNS} FROM ({windows_of(300)})"),
    "tumbling_partial_final": WINDOWS_SQL,
    "windows_per_kind": sql(
        f"SELECT kind, count(*) AS windows, CAST(sum(event_count) AS BIGINT) AS events FROM ({windows_of(300)}) GROUP BY 1"
    ),
    "lifetime_totals": TOTALS_SQL,
    "view_counter_update": sql(
        """SELECT i.id, i.id % 3 + (SELECT count(*) FROM views v WHERE v.image_id = i.id) AS views FROM images i"""
    ),
    "images_per_user": sql("SELECT user_id, count(*) AS images FROM images GROUP BY 1"),
    "views_on_known_images": sql(
        """SELECT v.image_id, count(*) AS views, i.id IS NOT NULL AS known
        FROM views v LEFT JOIN images i ON i.id = v.image_id AND i.deleted_at IS NULL GROUP BY 1, 3"""
    ),
    "activity_score": sql(
        """SELECT id AS image_id, 1 + (SELECT count(*) FROM views v WHERE v.image_id = i.id)
          + 2 * (SELECT count(*) FROM comments c WHERE c.image_id = i.id)
          + 3 * (SELECT count(*) FROM flags f WHERE f.image_id = i.id)
          + 2 * (SELECT count(*) FROM flags f JOIN comments c ON c.id = f.comment_id WHERE c.image_id = i.id) AS activity_score
        FROM images i"""
    ),
    "flag_targets": sql(
        """SELECT f.id, f.image_id, f.comment_id, coalesce(f.image_id, c.image_id) AS target_image_id
        FROM flags f LEFT JOIN comments c ON c.id = f.comment_id"""
    ),
    "rolling_counts": sql(
        """SELECT event_id, user_id, kind, CASE kind WHEN 'view' THEN v1 WHEN 'comment' THEN c1 ELSE f1 END AS count_1min,
          CASE kind WHEN 'view' THEN v2 WHEN 'comment' THEN c2 ELSE f2 END AS count_5min,
          CASE kind WHEN 'view' THEN v7 WHEN 'comment' THEN c7 ELSE f7 END AS count_1hr FROM user_counts_at""",
        COUNTS,
    ),
    "rolling_cross_counts": sql(
        """SELECT event_id, xv1 AS views_1min, xv2 AS views_5min, xv7 AS views_1hr, total_views AS views_total
        FROM user_counts_at WHERE kind = 'comment'""",
        COUNTS,
    ),
    "running_totals_sampled": sql(
        """SELECT event_id, user_id, total_views AS views_total FROM user_counts_at
        WHERE kind = 'view' AND (total_views % 10 = 0 OR total_views IN (1, 5, 10))""",
        COUNTS,
    ),
    "alerts_first_crossing": ALERTS_SQL,
    "milestones": MILESTONES_SQL,
    "moderation_requests": REQUESTS_SQL,
    "stream_alert_requests": REQUESTS_SQL,
    "alert_stats": sql(
        """SELECT alert_type, count(DISTINCT user_id) AS alerts FROM crossed GROUP BY 1
        UNION ALL SELECT 'milestones', count(*) FROM reached""",
        COUNTS,
    ),
    "recent_alerts_topk": sql(
        """SELECT alert_type, user_id, event_id, row_number() OVER (PARTITION BY alert_type ORDER BY ts DESC, user_id DESC) AS recency_rank
        FROM first_alerts QUALIFY recency_rank <= 20""",
        COUNTS,
    ),
    "milestone_insert_absent": sql(
        """SELECT user_id, milestone_type, CAST(milestone_value AS BIGINT) AS milestone_value, event_id
        FROM reached WHERE reached_at >= TIMESTAMP '2024-01-16'""",
        COUNTS,
    ),
    "milestone_history": sql(
        f"""SELECT r.user_id, CAST(milestone_value AS BIGINT) AS milestone_value, {iso('reached_at')}
        FROM reached r JOIN users u ON u.id = r.user_id WHERE u.is_test_account""",
        COUNTS,
    ),
    "eligible_images": sql(
        f"""SELECT CAST(id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS user_id, caption, category,
          {iso('created_at')}, {iso('user_created_at')} FROM eligible""",
        ELIGIBLE,
    ),
    "eligibility_summary": sql(
        """SELECT count(*) AS total_images, count(*) FILTER (is_test) AS excluded_test,
          count(*) FILTER (is_minor) AS excluded_minor, count(*) FILTER (is_deleted) AS excluded_deleted,
          count(*) FILTER (NOT is_test AND NOT is_minor AND NOT is_deleted) AS remaining FROM marked""",
        ELIGIBLE,
    ),
    "eligible_comments": sql(f"SELECT id, image_id, user_id, {iso('created_at')} FROM ok_comments", ELIGIBLE),
    "eligible_flags": sql(
        f"SELECT id, image_id, comment_id, user_id, {iso('created_at')} FROM ok_flags", ELIGIBLE
    ),
    "labels_24h": sql("SELECT image_id, label AS label_needs_moderation_24h FROM labels_of", ELIGIBLE, LABELS),
    "image_window_features": sql("SELECT * FROM window_counts", ELIGIBLE, FEATURES),
    "user_image_count_asof": sql("SELECT * FROM user_counts", ELIGIBLE, FEATURES),
    "training_set": sql("SELECT * FROM training", *TRAIN),
    "label_distribution": sql(
        "SELECT label_needs_moderation_24h, count(*) AS samples FROM training GROUP BY 1", *TRAIN
    ),
    "training_as_of": sql(
        """SELECT as_of, image_id, CASE WHEN as_of = 2 AND early THEN 2 ELSE 1 END * count(*) AS rows,
          max(label_needs_moderation_24h) AS label
        FROM (SELECT t.*, i.created_at < TIMESTAMP '2024-01-16' AS early
            FROM training t JOIN images i ON CAST(i.id AS VARCHAR) = t.image_id),
          (SELECT CAST(unnest([1, 2]) AS BIGINT) AS as_of)
        WHERE as_of = 2 OR early GROUP BY as_of, image_id, early""",
        *TRAIN,
    ),
    "training_newest": sql(
        "SELECT image_id, decision_point_minutes, CAST(2 AS BIGINT) AS snapshot_id, total_flags FROM training", *TRAIN
    ),
    "training_exclude_deleted": sql(
        """SELECT t.image_id, count(*) AS rows FROM training t
        WHERE t.image_id NOT IN (SELECT CAST(id AS VARCHAR) FROM images WHERE category = 'Meat') GROUP BY 1""",
        *TRAIN,
    ),
    "training_excluded_after_rebuilds": sql(
        """SELECT t.image_id, count(*) AS rows FROM training t
        JOIN images i ON CAST(i.id AS VARCHAR) = t.image_id
        WHERE t.category <> 'Meat' AND i.user_id % 2 <> 0 GROUP BY 1""",
        *TRAIN,
    ),
    "training_after_withdrawal": sql(
        "SELECT image_id, count(*) AS rows FROM training WHERE category <> 'Meat' GROUP BY 1", *TRAIN
    ),
    "model_score_checks": sql(
        """SELECT label_needs_moderation_24h AS label, decision_point_minutes, count(*) AS rows,
          CAST(0 AS BIGINT) AS out_of_range, CAST(0 AS BIGINT) AS gap FROM training GROUP BY 1, 2""",
        *TRAIN,
    ),
    "model_request_checks": sql(
        """SELECT "trigger", 'model' AS inference_mode, 'v1' AS model_version, count(*) AS requests,
          CAST(0 AS BIGINT) AS out_of_range FROM request_features GROUP BY 1""",
        SERVING,
    ),
    "features_at_request": sql("SELECT * EXCLUDE (ts) FROM at_request", SERVING),
    "serving_metadata": sql(
        f"SELECT * EXCLUDE (uploaded_at, user_created_at), {iso('uploaded_at')}, {iso('user_created_at')} FROM metadata",
        SERVING,
    ),
    "merged_features": sql(
        """SELECT id AS image_id, CASE WHEN deleted_at IS NULL THEN category ELSE 'unknown' END AS category,
          user_id AS uploader, CASE WHEN deleted_at IS NULL THEN length(coalesce(caption, '')) END AS caption_length
        FROM images"""
    ),
    "feature_vector": sql(f"SELECT request_id, {VECTOR_SQL} FROM request_features", SERVING),
    "feature_summary": sql(
        f"SELECT request_id, {_summary(False)} AS summary, {_summary(True)} AS compact FROM request_features", SERVING
    ),
    "risk_scores": sql(
        """SELECT image_id, decision_point_minutes, total_flags, user_image_count,
          probability AS moderation_probability, probability >= 0.7::DOUBLE AS needs_review FROM scored""",
        *TRAIN,
        scored("training"),
    ),
    "request_risk_scores": sql(
        """SELECT request_id, image_id, trigger, probability AS moderation_probability,
          probability >= 0.7::DOUBLE AS needs_review FROM scored""",
        SERVING,
        scored("request_features"),
    ),
    "risk_reasons": sql(
        f"SELECT request_id, {REASONS} AS reasons FROM scored", SERVING, scored("request_features")
    ),
    "risk_explain_ranked": sql(
        f"SELECT request_id, {RANKED} AS factors FROM scored", SERVING, scored("request_features")
    ),
    "decisions_by_trigger": sql(
        """SELECT trigger AS trigger_type, 'heuristic' AS inference_mode, count(*) AS decisions,
          round(avg(probability), 6) AS avg_risk_score FROM scored GROUP BY 1""",
        SERVING,
        scored("request_features"),
    ),
    "constraint_violations": sql(
        " UNION ALL ".join(
            [
                _check("users", "tos_version", "tos_version_accepted < 1"),
                _check("users", "year_of_birth", "year_of_birth NOT BETWEEN 1900 AND 2026"),
                _check("images", "source", "source NOT IN ('user_upload', 'synthetic', 'import')"),
                _check("flags", "target", "image_id IS NULL AND comment_id IS NULL"),
                _check("flags", "review_status", "review_status NOT IN ('pending', 'confirmed', 'rejected')"),
                _check("moderation", "target_type", "target_type NOT IN ('image', 'comment', 'account')"),
                _check("moderation", "risk_score", "risk_score NOT BETWEEN 0 AND 1"),
            ]
        ),
        RAW,
    ),
    "fk_violations": sql(
        " UNION ALL ".join(
            _foreign_key(*k)
            for k in (
                ("images", "user_id", "users"),
                ("comments", "image_id", "images"),
                ("comments", "user_id", "users"),
                ("comments", "moderator_action_id", "moderation"),
                ("flags", "user_id", "users"),
                ("flags", "image_id", "images"),
                ("flags", "comment_id", "comments"),
                ("flags", "moderation_action_id", "moderation"),
            )
        ),
        RAW,
    ),
    "unique_violations": sql(
        "SELECT username, count(*) AS copies FROM raw_users WHERE username IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
        RAW,
    ),
    "null_violations": sql(
        " UNION ALL ".join(
            [
                _nulls("users", "id username tos_version_accepted is_test_account"),
                _nulls("images", "id user_id s3_url source"),
                _nulls("comments", "id image_id user_id content moderator_hidden"),
                _nulls("flags", "id user_id reason review_status"),
                _nulls("moderation", "id target_type target_id inference_mode risk_score policy_version"),
            ]
        ),
        RAW,
    ),
    "column_defaults": sql(
        " UNION ALL ".join(
            [
                _default("users", "tos_version_accepted", "1"),
                _default("users", "is_test_account", "false"),
                _default("images", "source", "'user_upload'"),
                _default("images", "views", "0"),
                _default("comments", "moderator_hidden", "false"),
                _default("flags", "review_status", "'pending'"),
                _default("moderation", "policy_version", "'v1'"),
            ]
        ),
        RAW,
    ),
    "users_get_or_create": sql(
        """SELECT asked.username, coalesce(u.id, asked.id) AS id, u.id IS NULL AS created
        FROM (SELECT 'Customer#' || lpad(CAST(event_id % 2000 AS VARCHAR), 9, '0') AS username,
            min(event_id) + 1000000000 AS id FROM base GROUP BY 1) asked
        LEFT JOIN users u ON u.username = asked.username"""
    ),
    "upload_metadata_upsert": METADATA_SQL,
    "latest_features_lookup": sql(
        """SELECT asked.image_id, u.category, u.uploaded_at, u.user_id, CAST(u.caption_length AS BIGINT) AS caption_length,
          CASE WHEN u.image_id IS NOT NULL THEN CAST(u.caption_length <> '0' AS BIGINT) END AS has_caption,
          CASE WHEN u.image_id IS NOT NULL THEN coalesce(v5, 0) END AS views_5min, CASE WHEN u.image_id IS NOT NULL THEN coalesce(v1, 0) END AS views_1hr,
          CASE WHEN u.image_id IS NOT NULL THEN coalesce(c5, 0) END AS comments_5min, CASE WHEN u.image_id IS NOT NULL THEN coalesce(c1, 0) END AS comments_1hr,
          CASE WHEN u.image_id IS NOT NULL THEN coalesce(f5, 0) END AS flags_5min, CASE WHEN u.image_id IS NOT NULL THEN coalesce(f1, 0) END AS flags_1hr,
          CASE WHEN u.image_id IS NOT NULL THEN coalesce(tv, 0) END AS total_views, CASE WHEN u.image_id IS NOT NULL THEN coalesce(tc, 0) END AS total_comments,
          CASE WHEN u.image_id IS NOT NULL THEN coalesce(tf, 0) END AS total_flags,
          CASE WHEN u.image_id IS NOT NULL THEN coalesce(v5, 0) / 5.0::DOUBLE END AS view_velocity,
          CASE WHEN u.image_id IS NOT NULL THEN coalesce(tc, 0) / greatest(coalesce(tv, 0), 1)::DOUBLE END AS comment_ratio,
          CASE WHEN u.image_id IS NOT NULL THEN CAST(coalesce(v5, 0) + 5 * coalesce(c5, 0) AS DOUBLE) END AS recent_engagement,
          CAST(trunc((epoch_us(TIMESTAMP '2024-01-31') - epoch_us(u.created_at)) / 1e6) AS BIGINT) AS time_since_upload_seconds
        FROM (SELECT CAST(event_id AS VARCHAR) AS image_id FROM base) asked
        LEFT JOIN uploads u ON u.image_id = asked.image_id
        LEFT JOIN (SELECT CAST(image_id AS VARCHAR) AS image_id,
            count(*) FILTER (kind = 'view' AND ts >= TIMESTAMP '2024-01-30 23:00:00') AS v5,
            count(*) FILTER (kind = 'view' AND ts >= TIMESTAMP '2024-01-30 12:00:00') AS v1,
            count(*) FILTER (kind = 'comment' AND ts >= TIMESTAMP '2024-01-30 23:00:00') AS c5,
            count(*) FILTER (kind = 'comment' AND ts >= TIMESTAMP '2024-01-30 12:00:00') AS c1,
            count(*) FILTER (kind = 'flag' AND ts >= TIMESTAMP '2024-01-30 23:00:00') AS f5,
            count(*) FILTER (kind = 'flag' AND ts >= TIMESTAMP '2024-01-30 12:00:00') AS f1,
            count(*) FILTER (kind = 'view') AS tv, count(*) FILTER (kind = 'comment') AS tc, count(*) FILTER (kind = 'flag') AS tf
          FROM signals WHERE image_id IS NOT NULL AND ts <= TIMESTAMP '2024-01-31' GROUP BY 1) s ON s.image_id = u.image_id""",
        UPLOADS,
    ),
    "feature_keys_like": sql("SELECT image_id FROM uploads WHERE image_id LIKE '1%7_'", UPLOADS),
    "path_category_rollup": sql(
        """SELECT CASE WHEN g = 3 THEN 'TOTAL' ELSE split END AS split,
          CASE g WHEN 3 THEN 'TOTAL' WHEN 1 THEN 'SUBTOTAL' ELSE class END AS class, files
        FROM (SELECT split, class, count(*) AS files, grouping(split, class) AS g FROM image_names GROUP BY ROLLUP (split, class))""",
        FILES,
    ),
    "path_categories": sql(
        """SELECT class, coalesce(['Bread', 'Dairy product', 'Dessert', 'Egg', 'Fried food', 'Meat', 'Noodles/Pasta', 'Rice',
          'Seafood', 'Soup', 'Vegetable/Fruit'][number + 1], 'Unknown') AS category, count(*) AS files
        FROM image_names GROUP BY 1, 2""",
        FILES,
    ),
    "object_keys": sql(
        """SELECT name, ending AS extension, 'http://store:9000/images/' || stem || '.' || ending AS url, left(name, 8) AS short
        FROM (SELECT ending, CAST(number AS VARCHAR) || '_' || CAST(event_id AS VARCHAR) AS stem, stem || '.' || ending AS name FROM names)""",
        FILES,
    ),
    "table_profile": sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", '{t}' AS type, count(*) AS row_count, count({c}) AS present FROM training"
            for c, t in TRAINING_COLUMNS
        ),
        *TRAIN,
    ),
    "table_head": sql(
        """SELECT image_id, decision_point_minutes, category, total_flags, user_image_count FROM training
        ORDER BY image_id, decision_point_minutes LIMIT 5""",
        *TRAIN,
    ),
    "model_inputs": sql(
        "SELECT image_id, decision_point_minutes, label_needs_moderation_24h, category, "
        "CAST(is_weekend AS VARCHAR) AS is_weekend, CAST(has_caption AS VARCHAR) AS has_caption, "
        + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in NUMERIC)
        + " FROM training",
        *TRAIN,
    ),
    "scaler_statistics": sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS deviation FROM training"
            for c in NUMERIC
        ),
        *TRAIN,
    ),
    "category_values": sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, count(*) AS samples FROM training GROUP BY 2"
            for c in ("is_weekend", "has_caption", "category")
        ),
        *TRAIN,
    ),
    "stream_tumbling_counts": WINDOWS_SQL,
    "stream_lifetime_totals": TOTALS_SQL,
    "stream_rolling_alerts": ALERTS_SQL,
    "stream_redelivered_alerts": ALERTS_SQL,
    "stream_milestones": MILESTONES_SQL,
    "milestones_by_selection": MILESTONES_SQL,
    "alerts_with_memory": sql(
        f"""SELECT CAST(w.size AS BIGINT) AS memory_size, c.user_id, c.alert_type, c.event_id, {iso('c.ts', 'ts')}, c.metric, c.value
        FROM walked w JOIN crossed_in_turn c ON c.alert_type = w.alert_type AND c.turn = w.turn WHERE w.alerts""",
        COUNTS,
        """
crossed_in_turn AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY alert_type ORDER BY ts, event_id) AS turn FROM crossed),
walked AS (
  SELECT size, alert_type, CAST(0 AS BIGINT) AS turn, CAST([] AS BIGINT[]) AS held, false AS alerts
  FROM (SELECT unnest([1, 10, 1000]) AS size), (SELECT DISTINCT alert_type FROM crossed_in_turn)
  UNION ALL
  SELECT w.size, w.alert_type, c.turn,
    CASE WHEN list_contains(held, user_id) THEN held ELSE list_append(held, user_id)[-w.size:] END,
    NOT list_contains(held, user_id)
  FROM walked w JOIN crossed_in_turn c ON c.alert_type = w.alert_type AND c.turn = w.turn + 1),""",
    ).replace("WITH n AS", "WITH RECURSIVE n AS", 1),
    "fixed_windows_from_first": sql(
        f"""SELECT user_id, {iso('start', 'window_start')}, count(*) AS event_count FROM (
          SELECT e.user_id, e.event_id, max(c.ts) AS start
          FROM base e JOIN chain c ON c.user_id = e.user_id AND c.ts <= e.ts
          WHERE e.kind IN ('view', 'comment', 'flag') GROUP BY 1, 2) GROUP BY 1, 2""",
        """
chain AS (
  SELECT user_id, min(ts) AS ts FROM base WHERE kind IN ('view', 'comment', 'flag') GROUP BY 1
  UNION ALL
  SELECT c.user_id, min(e.ts) FROM chain c JOIN base e ON e.user_id = c.user_id
    AND e.kind IN ('view', 'comment', 'flag') AND e.ts >= c.ts + INTERVAL 2 DAY
  GROUP BY 1),""",
    ).replace("WITH n AS", "WITH RECURSIVE n AS", 1),
    "stream_request_counts": sql(
        """SELECT request_id, image_id, trigger, views_5min, views_1hr, comments_5min, comments_1hr,
          flags_5min, flags_1hr FROM at_request""",
        SERVING,
    ),
    "features_from_prefix_sums": sql("SELECT * EXCLUDE (ts) FROM at_request", SERVING),
    "upsert_buckets": METADATA_SQL,
    "stream_statistics": sql("SELECT 'windows' AS query, CAST(3 AS BIGINT) AS batches, count(*) AS rows FROM signals"),
    "stream_upload_metadata": METADATA_SQL,
    "stream_upload_last_write": METADATA_SQL.replace("'Soup'", "'Bread'"),
    "stream_users_created": sql(
        """SELECT username, min(id) AS id FROM (
          SELECT 'Customer#' || lpad(CAST(event_id % 2000 AS VARCHAR), 9, '0') AS username, event_id + 1000000000 AS id FROM base)
        WHERE username NOT IN (SELECT username FROM users) GROUP BY 1"""
    ),
    "stream_sliding_counts": sql(
        f"""SELECT user_id, {iso('w', 'window_start')}, count(*) FILTER (kind = 'view') AS views,
          count(*) FILTER (kind = 'comment') AS comments, count(*) FILTER (kind = 'flag') AS flags
        FROM (SELECT user_id, kind, unnest([date_trunc('day', ts), date_trunc('day', ts) - INTERVAL 1 DAY]) AS w
          FROM base WHERE kind IN ('view', 'comment', 'flag')) GROUP BY 1, 2"""
    ),
    "stream_scoring": sql(
        f"""SELECT image_id, trigger AS trigger_type, probability AS risk_score, 'heuristic' AS inference_mode,
          {iso('ts', 'created_at')} FROM scored""",
        SERVING,
        scored("request_features"),
    ),
}
