"""Explicit schemas of every table and message; nothing is inferred.

Fixed values: the column names and types of the data model.
"""

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

TEXT = StringType()
INT = IntegerType()
LONG = LongType()
REAL = DoubleType()
TIME = TimestampType()
FLAG = BooleanType()


def _schema(**columns) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


USERS = _schema(
    id=TEXT,
    username=TEXT,
    tos_version_accepted=INT,
    tos_accepted_at=TIME,
    country_of_residence=TEXT,
    year_of_birth=INT,
    is_test_account=FLAG,
    created_at=TIME,
)
IMAGES = _schema(
    id=TEXT,
    user_id=TEXT,
    s3_url=TEXT,
    source=TEXT,
    caption=TEXT,
    category=TEXT,
    created_at=TIME,
    deleted_at=TIME,
    views=INT,
)
COMMENTS = _schema(
    id=TEXT,
    image_id=TEXT,
    user_id=TEXT,
    content=TEXT,
    moderator_hidden=FLAG,
    moderator_action_id=TEXT,
    deleted_at=TIME,
    created_at=TIME,
)
FLAGS = _schema(
    id=TEXT,
    user_id=TEXT,
    image_id=TEXT,
    comment_id=TEXT,
    reason=TEXT,
    moderation_action_id=TEXT,
    review_status=TEXT,
    resolved_at=TIME,
    created_at=TIME,
)
MODERATION = _schema(
    id=TEXT,
    inference_request_id=TEXT,
    target_type=TEXT,
    target_id=TEXT,
    inference_mode=TEXT,
    model_version=TEXT,
    risk_score=REAL,
    trigger_type=TEXT,
    policy_version=TEXT,
    rationale=TEXT,
    created_at=TIME,
)
TABLES = {
    "users": USERS,
    "images": IMAGES,
    "comments": COMMENTS,
    "flags": FLAGS,
    "moderation": MODERATION,
}

# Where a message came in: arrivals are ordered by (arrived_at, partition, offset), since
# an offset orders one partition only. (partition, offset) also names the event.
ARRIVAL = _schema(arrived_at=TIME, partition=INT, offset=LONG)
LANDED = _schema(topic=TEXT, value=TEXT, arrival=ARRIVAL)

# One wide message for the view, comment, upload and flag topics.
EVENT = _schema(
    event_type=TEXT,
    image_id=TEXT,
    comment_id=TEXT,
    flag_id=TEXT,
    user_id=TEXT,
    content=TEXT,
    category=TEXT,
    caption=TEXT,
    s3_url=TEXT,
    reason=TEXT,
    viewed_at=TEXT,
    created_at=TEXT,
    uploaded_at=TEXT,
)
REQUEST = _schema(image_id=TEXT, trigger=TEXT, context=MapType(TEXT, INT), timestamp=REAL)
WINDOW_COUNTS = _schema(
    image_id=TEXT, window_start=TIME, window_end=TIME, event_count=LONG, processed_at=TIME
)
TRAINING = _schema(
    image_id=TEXT,
    decision_point_minutes=INT,
    time_since_upload_seconds=LONG,
    hour_of_day=INT,
    day_of_week=INT,
    is_weekend=INT,
    views_5min=LONG,
    views_1hr=LONG,
    comments_5min=LONG,
    comments_1hr=LONG,
    flags_5min=LONG,
    flags_1hr=LONG,
    total_flags=LONG,
    view_velocity_per_min=REAL,
    comment_to_view_ratio=REAL,
    recent_engagement_score=REAL,
    caption_length=INT,
    has_caption=INT,
    user_image_count=LONG,
    user_age_days=LONG,
    category=TEXT,
    label_needs_moderation_24h=INT,
)
