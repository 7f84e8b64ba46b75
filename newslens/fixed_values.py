"""Values that have to be exactly these for the answers to be right."""

# ---------------------------------------------------------------------------
# Fixed values. They decide results and are kept in their natural order.
# ---------------------------------------------------------------------------

# Company-suffix rule. Alternation binds loosest: only "group" needs a leading
# space and only "asa" is anchored, all other words match anywhere.
CORP_SUFFIX_PATTERN = (
    r"\s(group)|(ltd)|(plc)|(co)|(inc)|(corp)|(llc)|(nv)|(spa)|(se)|(sa)|(ag)|(gmbh)|(oao)|(asa)$"
)
# Opt-in reading of the same list: a separate last word.
CORP_SUFFIX_PATTERN_STRICT = (
    r"\s(group|ltd|plc|co|inc|corp|llc|nv|spa|se|sa|ag|gmbh|oao|asa)$"
)

# Exchange codes that the price vendor files under "US".
US_EXCHANGES = (
    "NYSE",
    "NASDAQ",
    "BATS",
    "OTCQB",
    "PINK",
    "OTCQX",
    "OTCMKTS",
    "NMFQS",
    "NYSE MKT",
    "OTCBB",
    "OTCGREY",
    "OTC",
)
US_EXCHANGE_CODE = "US"

# Pages that are not company news.
SKIPPED_HEADLINE_PREFIXES = ("Letter", "FT Crossword")
SKIPPED_BODY_PREFIXES = ("Good morning", "This article is an on-site version")
REQUIRED_SECTION = "Companies"
MIN_BREADCRUMBS = 3
ARTICLE_SOURCE = "FT"

# Sitemap file names.
NEWS_SITEMAP_SUFFIX = "news.xml"
ARCHIVE_YEAR_PATTERN = r"archive-(\d{4})-"

# Price vendor request.
PRICE_API_BASE = "https://eodhistoricaldata.com/api"
PRICE_API_FORMAT = "json"

# Windows, thresholds and model sizes.
STREAM_TOPIC_PREFIX = "/stream"
PRICE_WINDOW_DAYS = 28
LABEL_HORIZON_DAYS = 7
FEED_WINDOW_DAYS = 7
NGRAM_SIZE = 3
NEIGHBOURS = 1
DEFAULT_MAX_DISTANCE = 0.4
PRODUCTION_MAX_DISTANCE = 0.3
COMPANY_SIMILARITY_THRESHOLD = 50
TRAIN_FRACTION = 0.7
BOOSTING_ROUNDS = 10
SUMMARY_MIN_LENGTH = 50
SUMMARY_MAX_LENGTH = 100
SUMMARY_LENGTH_PENALTY = 2.0
SUMMARY_BEAMS = 4
RISE = "rise"
FALL = "fall"
ORGANISATION = "ORG"
