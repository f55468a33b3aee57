"""Column specs, key configs, field allow-lists and constants.

Everything between the FIXED VALUES markers must equal the source system's
contract for results to line up (aliases, cast targets, field order, window
sizes); it is data, stated plainly, in the source's natural order.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class ColSpec:
    source: str
    alias: str
    cast: str  # STRING | INT64 | FLOAT64 | DATE | TIMESTAMP | JSON_STRING


# ---------------------------------------------------------------- FIXED VALUES
# Parent specs: source column, ODS alias, cast target (payload field order).
PARENT_SPECS: dict[str, list[ColSpec]] = {
    "ads": [
        ColSpec("id", "ad_id", "STRING"),
        ColSpec("adset_id", "adset_id", "STRING"),
        ColSpec("campaign_id", "campaign_id", "STRING"),
        ColSpec("account_id", "account_id", "STRING"),
        ColSpec("name", "ad_name", "STRING"),
        ColSpec("status", "configured_status", "STRING"),
        ColSpec("effective_status", "effective_status", "STRING"),
        ColSpec("creative__id", "creative_id", "STRING"),
        ColSpec("created_time", "created_at", "TIMESTAMP"),
        ColSpec("updated_time", "updated_at", "TIMESTAMP"),
    ],
    "ad_sets": [
        ColSpec("id", "adset_id", "STRING"),
        ColSpec("campaign_id", "campaign_id", "STRING"),
        ColSpec("account_id", "account_id", "STRING"),
        ColSpec("name", "adset_name", "STRING"),
        ColSpec("effective_status", "effective_status", "STRING"),
        ColSpec("bid_strategy", "bid_strategy", "STRING"),
        ColSpec("daily_budget", "daily_budget", "FLOAT64"),
        ColSpec("lifetime_budget", "lifetime_budget", "FLOAT64"),
        ColSpec("targeting__age_min", "targeting_age_min", "INT64"),
        ColSpec("targeting__age_max", "targeting_age_max", "INT64"),
        ColSpec("start_time", "start_time", "TIMESTAMP"),
        ColSpec("end_time", "end_time", "TIMESTAMP"),
        ColSpec("created_time", "created_at", "TIMESTAMP"),
        ColSpec("updated_time", "updated_at", "TIMESTAMP"),
    ],
    "ad_creatives": [
        ColSpec("id", "creative_id", "STRING"),
        ColSpec("account_id", "account_id", "STRING"),
        ColSpec("name", "creative_name", "STRING"),
        ColSpec("title", "title", "STRING"),
        ColSpec("body", "body", "STRING"),
        ColSpec("link_url", "link_url", "STRING"),
        ColSpec("image_url", "image_url", "STRING"),
        ColSpec("thumbnail_url", "thumbnail_url", "STRING"),
        ColSpec("video_id", "video_id", "STRING"),
        ColSpec("call_to_action_type", "cta_type", "STRING"),
        ColSpec("object_type", "media_type", "STRING"),
        ColSpec("instagram_permalink_url", "instagram_permalink_url", "STRING"),
    ],
    "ad_creatives_asset_feed": [
        ColSpec("id", "creative_id", "STRING"),
        ColSpec("account_id", "account_id", "STRING"),
        ColSpec("asset_feed_spec", "asset_feed_spec_json", "JSON_STRING"),
    ],
    "campaigns": [
        ColSpec("id", "campaign_id", "STRING"),
        ColSpec("account_id", "account_id", "STRING"),
        ColSpec("name", "campaign_name", "STRING"),
        ColSpec("status", "configured_status", "STRING"),
        ColSpec("effective_status", "effective_status", "STRING"),
        ColSpec("objective", "objective", "STRING"),
        ColSpec("buying_type", "buying_type", "STRING"),
        ColSpec("bid_strategy", "bid_strategy", "STRING"),
        ColSpec("daily_budget", "daily_budget", "FLOAT64"),
        ColSpec("lifetime_budget", "lifetime_budget", "FLOAT64"),
        ColSpec("budget_remaining", "budget_remaining", "FLOAT64"),
        ColSpec("start_time", "start_time", "TIMESTAMP"),
        ColSpec("stop_time", "stop_time", "TIMESTAMP"),
        ColSpec("created_time", "created_at", "TIMESTAMP"),
        ColSpec("updated_time", "updated_at", "TIMESTAMP"),
    ],
    "ads_insights": [
        ColSpec("ad_id", "ad_id", "STRING"),
        ColSpec("ad_name", "ad_name", "STRING"),
        ColSpec("adset_id", "adset_id", "STRING"),
        ColSpec("adset_name", "adset_name", "STRING"),
        ColSpec("campaign_id", "campaign_id", "STRING"),
        ColSpec("campaign_name", "campaign_name", "STRING"),
        ColSpec("account_id", "account_id", "STRING"),
        ColSpec("objective", "objective", "STRING"),
        ColSpec("date_start", "date_start", "DATE"),
        ColSpec("date_stop", "date_stop", "DATE"),
        ColSpec("impressions", "impressions", "INT64"),
        ColSpec("reach", "reach", "INT64"),
        ColSpec("clicks", "clicks", "INT64"),
        ColSpec("unique_clicks", "unique_clicks", "INT64"),
        ColSpec("inline_link_clicks", "inline_link_clicks", "INT64"),
        ColSpec("spend", "spend", "FLOAT64"),
        ColSpec("cpc", "cpc", "FLOAT64"),
        ColSpec("cpm", "cpm", "FLOAT64"),
        ColSpec("ctr", "ctr", "FLOAT64"),
        ColSpec("frequency", "frequency", "FLOAT64"),
        ColSpec("quality_ranking", "quality_ranking", "STRING"),
        ColSpec("conversion_rate_ranking", "conversion_rate_ranking", "STRING"),
        ColSpec("engagement_rate_ranking", "engagement_rate_ranking", "STRING"),
        ColSpec("_dlt_id", "parent_dlt_id", "STRING"),
    ],
}

PARENT_KEYS: dict[str, tuple[str, ...]] = {
    "ads": ("ad_id",),
    "ad_sets": ("adset_id",),
    "ad_creatives": ("creative_id",),
    "ad_creatives_asset_feed": ("creative_id",),
    "campaigns": ("campaign_id",),
    "ads_insights": ("ad_id", "date_start"),
}

CHILD_SPEC_ACTIONS = [
    ColSpec("_dlt_id", "child_dlt_id", "STRING"),
    ColSpec("_dlt_parent_id", "parent_dlt_id", "STRING"),
    ColSpec("_dlt_list_idx", "list_idx", "INT64"),
    ColSpec("action_type", "action_type", "STRING"),
    ColSpec("action_target_id", "action_target_id", "STRING"),
    ColSpec("action_destination", "action_destination", "STRING"),
    ColSpec("value", "value", "FLOAT64"),
    ColSpec("_1d_view", "value_1d_view", "FLOAT64"),
    ColSpec("_1d_click", "value_1d_click", "FLOAT64"),
    ColSpec("_7d_view", "value_7d_view", "FLOAT64"),
    ColSpec("_7d_click", "value_7d_click", "FLOAT64"),
]
CHILD_SPEC_VIDEO = [
    ColSpec("_dlt_id", "child_dlt_id", "STRING"),
    ColSpec("_dlt_parent_id", "parent_dlt_id", "STRING"),
    ColSpec("_dlt_list_idx", "list_idx", "INT64"),
    ColSpec("action_type", "action_type", "STRING"),
    ColSpec("action_target_id", "action_target_id", "STRING"),
    ColSpec("action_destination", "action_destination", "STRING"),
    ColSpec("value", "value", "FLOAT64"),
]
CHILD_SPECS: dict[str, list[ColSpec]] = {
    "ads_insights__actions": CHILD_SPEC_ACTIONS,
    "ads_insights__action_values": CHILD_SPEC_ACTIONS,
    "ads_insights__video_p25_watched_actions": CHILD_SPEC_VIDEO,
    "ads_insights__video_p50_watched_actions": CHILD_SPEC_VIDEO,
    "ads_insights__video_p75_watched_actions": CHILD_SPEC_VIDEO,
    "ads_insights__video_p100_watched_actions": CHILD_SPEC_VIDEO,
}

# Field allow-lists requested per entity from the source API.
FIELD_LISTS: dict[str, list[str]] = {
    "ads": ["id", "adset_id", "campaign_id", "account_id", "name", "status",
            "effective_status", "creative", "tracking_specs", "created_time",
            "updated_time"],
    "ad_sets": ["id", "campaign_id", "account_id", "name", "effective_status",
                "bid_strategy", "daily_budget", "lifetime_budget", "targeting",
                "start_time", "end_time", "created_time", "updated_time"],
    "ad_creatives": ["id", "account_id", "name", "status", "object_story_spec",
                     "degrees_of_freedom_spec", "image_hash", "image_url",
                     "video_id", "thumbnail_url", "template_url",
                     "product_set_id", "instagram_user_id",
                     "effective_object_story_id", "object_type",
                     "call_to_action_type", "url_tags"],
    "ad_creatives_asset_feed": ["id", "account_id", "asset_feed_spec"],
    "campaigns": ["id", "account_id", "name", "status", "effective_status",
                  "objective", "buying_type", "bid_strategy", "daily_budget",
                  "lifetime_budget", "budget_remaining", "start_time",
                  "stop_time", "created_time", "updated_time"],
    "ads_insights": ["ad_id", "ad_name", "adset_id", "adset_name",
                     "campaign_id", "campaign_name", "account_id", "objective",
                     "date_start", "date_stop", "impressions", "reach",
                     "clicks", "unique_clicks", "inline_link_clicks", "spend",
                     "cpc", "cpm", "ctr", "frequency", "quality_ranking",
                     "conversion_rate_ranking", "engagement_rate_ranking",
                     "actions", "action_values", "video_p25_watched_actions",
                     "video_p50_watched_actions", "video_p75_watched_actions",
                     "video_p100_watched_actions"],
}

# Nesting depth at which lists stop becoming child tables.
MAX_NESTING = {"ad_creatives": 2, "ad_creatives_asset_feed": 1, "ads_insights": 2}

# Date-window planning.
INSIGHTS_CHUNK_DAYS = 7
GRAPH_IDS_BATCH_SIZE = 50
INSIGHTS_STEADY_STATE_DAYS = 7
INITIAL_LOAD_DAYS_BY_ENV = {"dev": 7, "staging": 365, "prod": 1125}
INITIAL_LOAD_DAYS_DEFAULT = 1125
INSIGHTS_CATCHUP_THRESHOLD_DAYS = 90
INSIGHTS_TARGET_MIN_DEPTH_DAYS = 730
SAMPLE_DAYS = 7

# Hash of a NULL extraction time.
EXTRACTED_AT_FALLBACK_MICROS = 0

# Asset kinds, in report order.
ASSET_KINDS = ("image", "thumbnail", "video")

# Report-job states.
TERMINAL_SUCCESS = ("Job Completed",)
TERMINAL_FAILURE = ("Job Failed", "Job Skipped")

# Error-body keys kept in a redacted summary, in output order.
ERROR_KEYS = ("message", "type", "code", "error_subcode", "error_user_title",
              "error_user_msg", "fbtrace_id")
ERROR_UNPARSEABLE = "<unparseable>"
ERROR_NO_BLOCK = "<no error block>"

# Query-shape constants hashed into a fingerprint.
ACTION_BREAKDOWNS = "action_type,action_target_id,action_destination"
ATTRIBUTION_WINDOWS = "1d_view,7d_view,1d_click,7d_click"
TIME_INCREMENT = "1"
API_VERSION = "v25.0"

# Rate-limit pressure thresholds (percent) and the low access tier name.
PRESSURE_ERROR = 100
PRESSURE_WARNING = 80
PRESSURE_INFO = 50
LOW_ACCESS_TIER = "development_access"

# Entity allow-list for the raw lake (parents and children).
KNOWN_ENTITIES = tuple(PARENT_SPECS) + tuple(CHILD_SPECS)

# Date presets accepted by the report window.
DATE_PRESETS = ("today", "yesterday", "last_3d", "last_7d", "last_14d",
                "last_28d", "last_30d", "last_90d", "this_month", "last_month",
                "maximum")
# ---------------------------------------------------------------- END FIXED VALUES

CAST_TYPES = ("STRING", "INT64", "FLOAT64", "DATE", "TIMESTAMP", "JSON_STRING")
