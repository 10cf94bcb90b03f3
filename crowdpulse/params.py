"""Parameters of the operators and the values that are fixed by the data model."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# Category names in class order (class_00 .. class_10).
CATEGORIES = (
    "Bread",
    "Dairy product",
    "Dessert",
    "Egg",
    "Fried food",
    "Meat",
    "Noodles/Pasta",
    "Rice",
    "Seafood",
    "Soup",
    "Vegetable/Fruit",
)

# One indicator column per category, same order as CATEGORIES.
CATEGORY_COLUMNS = (
    "category_Bread",
    "category_Dairy",
    "category_Dessert",
    "category_Egg",
    "category_Fried",
    "category_Meat",
    "category_Noodles",
    "category_Rice",
    "category_Seafood",
    "category_Soup",
    "category_Veggie",
)

# Positions of the 29-element serving vector.
FEATURE_NAMES = (
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
) + CATEGORY_COLUMNS

# Model inputs.
NUMERIC_INPUTS = (
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
)
CATEGORICAL_INPUTS = ("is_weekend", "has_caption", "category")
LABEL = "label_needs_moderation_24h"

# Allowed values of checked columns.
IMAGE_SOURCES = ("user_upload", "synthetic", "import")
REVIEW_STATUSES = ("pending", "confirmed", "rejected")
TARGET_TYPES = ("image", "comment", "account")

# Event kinds and the topics they travel on.
TOPIC_OF_KIND = {
    "view": "views",
    "comment": "comments",
    "upload": "uploads",
    "flag": "flags",
}
REQUEST_TOPIC = "moderation_requests"


@dataclass(frozen=True)
class RiskRules:
    """Limits (all strict) and contributions of the rule score."""

    base: float = 0.3
    flags: int = 0
    comments_5min: int = 10
    comment_ratio: float = 0.5
    bot_comments_1hr: int = 50
    bot_views_1hr: int = 100
    velocity: float = 20.0
    engagement: float = 100.0
    user_images: int = 10
    quiet_comments_1hr: int = 5
    review_threshold: float = 0.7


@dataclass(frozen=True)
class EngagementParams:
    tumbling_seconds: int = 300
    rolling_seconds: dict = field(
        default_factory=lambda: {"1min": 60, "5min": 300, "1hr": 3600}
    )
    recency_minutes: dict = field(default_factory=lambda: {"5min": 5, "1hr": 60})
    decision_points: tuple = (0, 5, 30)
    label_horizon_hours: int = 24
    adult_age: int = 18
    viral_views_5min: int = 100
    suspicious_comments_1min: int = 10
    popular_views_1hr: int = 50
    milestones: tuple = (10, 100, 1000)
    alert_tracking: int = 1000
    rules: RiskRules = RiskRules()

    @property
    def serving_seconds(self) -> dict:
        return {k: 60 * m for k, m in self.recency_minutes.items()}


DEFAULT = EngagementParams()

# The test tables are sparse (one event per user in several hours), so checks on
# them use wider windows and lower limits; the operators are the same.
SCALED = replace(
    DEFAULT,
    tumbling_seconds=3600,
    rolling_seconds={"1min": 86_400, "5min": 2 * 86_400, "1hr": 7 * 86_400},
    recency_minutes={"5min": 60, "1hr": 720},
    decision_points=(0, 360, 1440),
    viral_views_5min=3,
    suspicious_comments_1min=2,
    popular_views_1hr=4,
    milestones=(1, 5, 10),
    rules=RiskRules(
        comments_5min=0,
        comment_ratio=0.5,
        bot_comments_1hr=1,
        bot_views_1hr=2,
        velocity=0.1,
        engagement=2.0,
        user_images=10,
    ),
)
