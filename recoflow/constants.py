"""Fixed values that must equal the source system's for results to match.

Everything in this module is data, not logic: deny lists, the category
alias map, default thresholds, and the three filter specs of the
deployment config.  Keep them here, in natural order, so they can be
reviewed in one place.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the source system's configuration)
# ---------------------------------------------------------------------------

# The one web property whose events are kept.
APP_ID = "theglobeandmail-website"

# Event name and page type of a usable interaction.
PAGE_VIEW = "page_view"
ARTICLE = "article"

# Platform value that marks crawler traffic.
BOT_PLATFORM = "Bot"

# Service code marking premium-bundle traffic (batch only).
PREMIUM_SERVICE_CODE = "PREMIUM~PREMIUM~~~~~"

# Internet providers whose traffic is dropped (batch only).
ISP_DENYLIST = (
    "Amazon.com",
    "Amazon",
    "Googlebot",
    "Digital Ocean",
    "The Globe and Mail",
)

# Page hosts whose traffic is dropped (batch and stream).
HOST_DENYLIST = (
    "localhost",
    "sandbox.tgam.arcpublishing.com",
    "arc-local.theglobeandmail.com",
    "arc-dev.theglobeandmail.com",
    "origin-arc-dev.tgam.arcpublishing.com",
    "origin-sandbox.tgam.arcpublishing.com",
    "preview-subscribe.theglobeandmail.com",
    "stg-subscribe.theglobeandmail.com",
)

# Item exclusion rule: sponsored, this section, or these keywords.
EXCLUDED_SECTION = "life/horoscopes"
EXCLUDED_KEYWORDS = ("omit", "zerocanada")

# The four top-level columns the batch pivot keeps next to the map keys.
RAW_MAIN_COLUMNS = ("timestamp", "datetime_collector_local", "eventdate", "datetime_local")

# Rolling windows of the two batch ETL jobs, in days before as_of.
INTERACTION_WINDOW_DAYS = 7
ITEM_WINDOW_DAYS = 14

# Age cut of the dated item filters, in days before as_of.
ITEM_AGE_FILTER_DAYS = 3

# Stream text limit (characters) for item ContentText.
CONTENT_TEXT_LIMIT = 20000

# Request parsing: default result count, and the hard cap on numResults.
DEFAULT_LIMIT = 25
MAX_RESULTS = 500

# Request category: default, and alias map applied after extraction.
DEFAULT_CATEGORY = "canada"
CATEGORY_ALIASES = {
    "technology": "business",
    "globe-investor": "investing",
    "news": "canada",
    "globe-drive": "drive",
    "report-on-business": "business",
}

# Filter context used when a request's context has no entry.
DEFAULT_CONTEXT = "default"
DEFAULT_FILTER_SUFFIX = "unread"

# Deployment filter specs (context, name, include and exclude clauses, filter_values, limit_time_range,
# include_time_range_for_sections).  The "default" context is the unread filter.
FILTER_SPECS = (
    {
        "context": "art_same_section_mostpopular",
        "name": "category",
        "clauses": ("include_category", "exclude_flagged"),
        "filter_values": ["category"],
        "limit_time_range": False,
        "include_time_range_for_sections": [
            "canada", "world", "business", "investing",
            "politics", "sports", "arts", "opinion",
        ],
    },
    {
        "context": "default",
        "name": "unread",
        "clauses": ("include_created", "exclude_flagged"),
        "filter_values": None,
        "limit_time_range": True,
        "include_time_range_for_sections": None,
    },
    {
        "context": "mobile_art_morestories",
        "name": "exclcat",
        "clauses": ("include_created", "exclude_category", "exclude_flagged"),
        "filter_values": ["category"],
        "limit_time_range": True,
        "include_time_range_for_sections": None,
    },
)

# Reply field renames, applied after lower-casing metadata attribute names.
REPLY_RENAMES = {
    "wordcount": "word_count",
    "contenttype": "content_type",
    "publisheddate": "published_at",
    "updateddate": "updated_at",
    "section": "section_meta_title",
    "canonicalurl": "url",
    "creditline": "credit",
    "contentid": "content_id",
    "contentrestriction": "protection_product",
    "label": "label",
}

# Content metadata attributes fetched for a reply.
METADATA_ATTRIBUTES = (
    "Title", "Deck", "Byline", "Category", "Section", "Keywords", "State",
    "CanonicalURL", "CreditLine", "Ownership", "Sponsored", "ContentId",
    "ContentType", "ContentRestriction", "PublishedDate", "WordCount",
    "Caption", "UpdatedDate", "Label",
)

# Monitoring: metric period (seconds) and alarm rules
# (name, metric, statistic, threshold, consecutive periods, and where given
# how periods without data count).
METRIC_PERIOD_SECONDS = 300
ALARM_RULES = (
    ("GetRecommendationsErrorAlarm", "GetRecommendationsErrors", "sum", 2.0, 2),
    ("PutContentErrorAlarm", "PutContentErrors", "sum", 10.0, 2),
    ("PutEventsErrorAlarm", "PutEventsErrors", "sum", 10.0, 2),
    ("PutContentThrottlesAlarm", "PutContentThrottles", "sum", 1.0, 1),
    ("PutEventsThrottlesAlarm", "PutEventsThrottles", "sum", 1.0, 1),
    ("RecThrottlesAlarm", "GetRecommendationsThrottles", "sum", 1.0, 2),
    ("EventsIteratorAge", "PutEventsIteratorAge", "max", 10000.0, 10),
    ("ContentIteratorAge", "PutContentIteratorAge", "max", 10000.0, 1),
    ("ReturnBackupRecommendations", "ReturnBackupRecommendations", "max", 1.0, 1, "notBreaching"),
    ("MissingRecommendationsAlarm", "MissingRecommendations", "avg", 1.0, 1, "notBreaching"),
    ("MissingDataImagesAlarm", "MissingDataImages", "avg", 1.0, 1, "notBreaching"),
    ("MissingDataMetadataAlarm", "MissingDataMetadata", "avg", 1.0, 1, "notBreaching"),
)

# Stream consumer lag threshold (milliseconds).
LAG_ALARM_MS = 10000

# Exploration: share of a list's places for fresh items, and their greatest age.
EXPLORATION_WEIGHT = 0.3
EXPLORATION_AGE_SECONDS = 86400

# ---------------------------------------------------------------------------
# OWN DEFINITIONS of scoring (the source system delegates it)
# ---------------------------------------------------------------------------
SIMILAR_TOP_K = 10
AFFINITY_WEIGHT = 0.7
FRESHNESS_WEIGHT = 0.3
FRESH_AGE_SECONDS = 86400
RECENCY_HALF_LIFE_SECONDS = 86400
