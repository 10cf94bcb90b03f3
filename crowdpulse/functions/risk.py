"""Engagement ratios, the serving vector and the rule score, as Columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from crowdpulse.params import FEATURE_NAMES, RiskRules

# Contribution of each factor and the text of its reason.
CONTRIBUTIONS = {
    "flags_reported": 0.4,
    "comment_spam": 0.3,
    "unusual_engagement": 0.2,
    "bot_pattern": 0.3,
    "viral_content": 0.2,
    "high_activity": 0.15,
    "established_user": -0.1,
}
REASONS = {
    "flags_reported": "[HIGH RISK] Content has been flagged %d time(s)",
    "comment_spam": "[HIGH RISK] Unusual comment activity (%d comments in 5 minutes)",
    "unusual_engagement": "[HIGH RISK] High comment-to-view ratio (%s)",
    "bot_pattern": "[HIGH RISK] Suspicious pattern: %d comments but only %d views in 1 hour",
    "viral_content": "[MEDIUM RISK] Viral content (%s views/min) - may need review",
    "high_activity": "[MEDIUM RISK] High recent activity (score: %d)",
    "established_user": "[LOW RISK] Established user (%d images)",
}
QUIET = "[LOW RISK] Normal activity, no flags"
NO_SIGNAL = "No significant risk signals detected"


def view_velocity(views_5min: Column) -> Column:
    return F.when(views_5min > 0, views_5min / F.lit(5.0)).otherwise(F.lit(0.0))


def comment_to_view_ratio(comments_1hr: Column, views_1hr: Column) -> Column:
    return comments_1hr / F.greatest(views_1hr, F.lit(1)).cast("double")


def recent_engagement(views_5min: Column, comments_5min: Column) -> Column:
    return (views_5min + comments_5min * 5).cast("double")


def vector_element(value: Column) -> Column:
    """float32 with NaN as 0 and infinities as +-1e6."""
    x = F.coalesce(value.cast("float"), F.lit(0.0).cast("float"))
    x = F.nanvl(x, F.lit(0.0).cast("float"))
    return (
        F.when(x == float("inf"), F.lit(1e6))
        .when(x == float("-inf"), F.lit(-1e6))
        .otherwise(x)
        .cast("float")
    )


def feature_vector() -> Column:
    """The named feature columns as one array, in vector order."""
    return F.array(*[vector_element(F.col(n)) for n in FEATURE_NAMES])


def checked_vector(vector: Column) -> Column:
    """Fail the query on a vector of the wrong length."""
    wrong = F.raise_error(F.lit(f"feature vector must have {len(FEATURE_NAMES)} elements"))
    return F.when(F.size(vector) == len(FEATURE_NAMES), vector).otherwise(wrong)


def vector_map(vector: Column) -> Column:
    return F.map_from_arrays(F.array(*[F.lit(n) for n in FEATURE_NAMES]), checked_vector(vector))


def vector_summary(vector: Column, compact: bool = False) -> Column:
    """One `name = value` line per element; compact leaves out zeros except totals."""
    pairs = F.arrays_zip(F.array(*[F.lit(n) for n in FEATURE_NAMES]).alias("n"), vector.alias("v"))
    lines = F.transform(
        pairs,
        lambda p, i: F.struct(
            i.alias("i"), p.getField("n").alias("n"), p.getField("v").alias("v")
        ),
    )
    if compact:
        lines = F.filter(lines, lambda p: (p["v"] != 0) | (p["n"] == "total_flags"))
    text = F.transform(
        lines,
        lambda p: F.format_string(
            "  [%2d] %-30s = %s",
            p["i"],
            p["n"],
            F.when(
                p["n"].startswith("category_"), F.when(p["v"] == 1, F.lit("Yes")).otherwise("No")
            ).otherwise(F.format_string("%d", p["v"].cast("bigint"))),
        ),
    )
    return F.array_join(text, "\n")


class RuleScore:
    """The rule score over named feature columns.

    Rules read the float32 value of a feature, as the serving vector stores it.
    """

    def __init__(self, rules: RiskRules = RiskRules()):
        self.rules = rules
        f = {
            n: F.coalesce(F.col(n), F.lit(0)).cast("float").cast("double")
            for n in FEATURE_NAMES
            if not n.startswith("category_")
        }
        self._features = f
        self.conditions = {
            "flags_reported": f["total_flags"] > rules.flags,
            "comment_spam": f["comments_5min"] > rules.comments_5min,
            "unusual_engagement": f["comment_to_view_ratio"] > rules.comment_ratio,
            "bot_pattern": (f["comments_1hr"] > rules.bot_comments_1hr)
            & (f["views_1hr"] < rules.bot_views_1hr),
            "viral_content": f["view_velocity_per_min"] > rules.velocity,
            "high_activity": f["recent_engagement_score"] > rules.engagement,
            "established_user": f["user_image_count"] > rules.user_images,
        }

    def score(self) -> Column:
        # Plain left-to-right sum of doubles, so equal inputs give equal bits.
        parts = [
            F.when(cond, F.lit(CONTRIBUTIONS[name])).otherwise(F.lit(0.0))
            for name, cond in self.conditions.items()
        ]
        raw = reduce(lambda a, b: a + b, parts, F.lit(self.rules.base))
        return F.least(F.greatest(raw, F.lit(0.0)), F.lit(1.0))

    def factors(self) -> Column:
        """Map of factor name to contribution, with the base."""
        entries = [F.struct(F.lit("base").alias("factor"), F.lit(self.rules.base).alias("contribution"))]
        entries += [
            F.when(cond, F.struct(F.lit(name).alias("factor"), F.lit(CONTRIBUTIONS[name]).alias("contribution")))
            for name, cond in self.conditions.items()
        ]
        return F.map_from_entries(F.array_compact(F.array(*entries)))

    def reasons(self) -> Column:
        f = self._features

        def whole(n: str) -> Column:
            return f[n].cast("bigint")

        # bround first: the text rounds half to even, format_string half up.
        values = {
            "flags_reported": [whole("total_flags")],
            "comment_spam": [whole("comments_5min")],
            "unusual_engagement": [F.format_string("%.2f", F.bround(f["comment_to_view_ratio"], 2))],
            "bot_pattern": [whole("comments_1hr"), whole("views_1hr")],
            "viral_content": [F.format_string("%.1f", F.bround(f["view_velocity_per_min"], 1))],
            "high_activity": [whole("recent_engagement_score")],
            "established_user": [whole("user_image_count")],
        }
        found = F.array_compact(
            F.array(
                *[
                    F.when(cond, F.format_string(REASONS[name], *values[name]))
                    for name, cond in self.conditions.items()
                ]
            )
        )
        quiet = (f["total_flags"] == 0) & (f["comments_1hr"] < self.rules.quiet_comments_1hr)
        fallback = F.array(F.when(quiet, F.lit(QUIET)).otherwise(F.lit(NO_SIGNAL)))
        return F.when(F.size(found) > 0, found).otherwise(fallback)

    def needs_review(self) -> Column:
        return self.score() >= self.rules.review_threshold


def ranked_factors(factors: Column) -> Column:
    """Entries of the factor map by falling absolute contribution, ties in rule order."""
    names = F.array(*[F.lit(n) for n in ("base", *CONTRIBUTIONS)])
    entries = F.transform(
        F.map_entries(factors),
        lambda e: F.struct(
            (-F.abs(e["value"])).alias("rank"),
            F.array_position(names, e["key"]).alias("place"),
            e["key"].alias("factor"),
            e["value"].alias("contribution"),
        ),
    )
    return F.transform(
        F.array_sort(entries), lambda e: F.struct(e["factor"].alias("factor"), e["contribution"].alias("contribution"))
    )
