"""Parameters as dataclasses.

Fixed values that must equal the original pipeline's defaults are stated together below, as
plain text in their natural order. Parameters tuned to the driver tables follow them.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------------------------
# FIXED VALUES (defaults of the original pipeline; keep equal for identical results)
# ---------------------------------------------------------------------------------------------
DEFAULT_SUBREDDITS = ["stocks", "investing", "wallstreetbets"]
DEFAULT_KEYWORDS = ["AAPL", "TSLA", "AMZN", "GOOGL", "MSFT"]
FALLBACK_TICKERS = ["AAPL", "TSLA", "AMZN", "GOOGL", "MSFT"]
INGEST_POST_LIMIT = 100
INGEST_MIN_POST_SCORE = 10
INGEST_MIN_POST_LENGTH = 200
INGEST_MIN_COMMENT_SCORE = 5
INGEST_MIN_COMMENT_LENGTH = 50
RELEVANCE_MIN_CHARS = 50
RELEVANCE_TITLE_CUT = 200
RELEVANCE_TEXT_CUT = 800
SANITIZE_TITLE = 500
SANITIZE_SELFTEXT = 10000
SANITIZE_BODY = 5000
SEARCH_SUBREDDITS = ["stocks", "investing", "wallstreetbets", "SecurityAnalysis", "ValueInvesting"]
SEARCH_IGNORE_KEYWORDS = ["yolo", "gain", "loss", "portfolio", "bought", "sold", "trade"]
SEARCH_NEWEST_PER_COMMUNITY = 200
SEARCH_MIN_POST_SCORE = 5
SEARCH_MIN_POST_LENGTH = 100
SEARCH_MIN_COMMENT_SCORE = 3
SEARCH_MIN_COMMENT_LENGTH = 30
SEARCH_POST_LIMIT = 50
SEARCH_COMMENTS_PER_POST = 10
SEARCH_TEXT_CUT = 5000
SEARCH_SAMPLE_SIZE = 20
SEARCH_QUOTA_PER_HOUR = 10
TIMEFRAME_HOURS = {"1h": 1, "6h": 6, "12h": 12, "24h": 24, "2d": 48, "7d": 168, "30d": 720}
TIMEFRAME_DEFAULT_HOURS = 24
API_TICKER_PATTERN = "^[A-Z]{1,10}$"
API_TICKER_MAX_LENGTH = 10
SEARCH_TICKER_PATTERN = "^[A-Z]{1,5}$"
API_ITEM_TYPES = {"all": None, "posts": "post", "comments": "comment"}
RECENT_ROWS = 20
DISPLAY_CUT = 100
SITE_HOST = "https://reddit.com"
EXTRACT_LIMIT = 1000
EXTRACT_MIN_SCORE = 10
EXTRACT_MIN_LENGTH = 100
LABELABLE_MIN_CHARS = 50
CLEAN_TEXT_CUT = 1000
LABEL_TEXT_CUT = 800
LABEL_MAP = {"informative": 0, "emotional": 1}
LABELS = ["informative", "emotional"]
LABEL_NEEDS_REVIEW = "needs_review"
LABELER_OK = "gemini-2.5-flash"
LABELER_ERROR = "gemini-error"
SPLIT_TEST_SIZE = 0.2
SPLIT_SEED = 42
SENTIMENTS = ["POSITIVE", "NEGATIVE", "NEUTRAL", "MIXED"]
CHART_SENTIMENTS = ["POSITIVE", "NEGATIVE", "NEUTRAL"]
CONTENT_TYPES = ["INFORMATIVE", "EMOTIONAL"]
COMBINED_LABELS = ["POSITIVE_INFORMATIVE", "POSITIVE_EMOTIONAL", "NEGATIVE_INFORMATIVE",
                   "NEGATIVE_EMOTIONAL", "NEUTRAL_INFORMATIVE", "NEUTRAL_EMOTIONAL"]
CONFIDENT_MIN = 0.7
METRIC_PERIOD_SECONDS = 300
DAILY_QUOTA = 10000
# alarms: (name, statistic, threshold, consecutive periods)
ALARMS = [("ingest_errors", "sum", 5.0, 2), ("ingest_duration", "avg", 120000.0, 2),
          ("api_5xx", "sum", 10.0, 2), ("api_latency", "avg", 10000.0, 3)]
# messages, markers and tags the original emits or matches
ERROR_ACCESS_DENIED = "You don't have access to the model"
ERROR_THROTTLED = ["ThrottlingException", "Too many requests"]
ERROR_VALIDATION = "ValidationException"
INVALID_TICKER_API = "Invalid ticker format. Use 1-10 uppercase letters."
INVALID_TYPE_API = "Invalid content type. Use: all, posts, or comments."
INVALID_TICKER_SEARCH = "Invalid ticker format. Please provide a valid stock ticker (e.g., AAPL, TSLA)."
NO_RESULTS_MESSAGE = "No relevant posts found for this ticker in the specified timeframe."
NO_DATA = "No data"
NO_CONTENT = "No content"
NO_TRAINING_DATA = "No training data to upload"
NO_LABELED_DATA = "No labeled data found in the dataset"
LABEL_NOTE = "AI labeled on {}"
FALLBACK_SOURCE = "fallback_default"
OTHER_COMBINED = "MIXED_OTHER"
MISSING_CONTENT_TYPE = "N/A"
UNKNOWN = "UNKNOWN"
DISABLED = "DISABLED"
# Python's str.split()/strip() whitespace set, as one regex class both Java and RE2 accept.
PY_WHITESPACE_CLASS = (r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
                       r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
PY_WHITESPACE = ("\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
                 "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
# ---------------------------------------------------------------------------------------------

# The error a scorer reports for a text it is told to reject.
REJECTED_TEXT = "unsupported text"


@dataclass(frozen=True)
class TextCuts:
    """How many characters a scorer reads; None is the whole text. The rule scorers need no cut."""
    relevance_title: int | None = None
    relevance_text: int | None = None
    search: int | None = None
    label: int | None = None


WHOLE_TEXT = TextCuts()
MODEL_CUTS = TextCuts(RELEVANCE_TITLE_CUT, RELEVANCE_TEXT_CUT, SEARCH_TEXT_CUT, LABEL_TEXT_CUT)

# Vocabularies of our rule scorers.
RELEVANCE_TERMS = ["share", "equity", "equities", "dividend", "bond", "fund", "broker", "ticker", "revenue", "profit",
                   "margin", "valuation", "portfolio", "quarter", "guidance", "inflation", "bank", "merger", "ipo"]
INFORMATIVE_CUES = ["percent", "quarter", "revenue", "guidance", "because", "according", "estimate", "growth", "margin",
                    "balance", "statement", "ratio", "rate", "compared", "source", "table", "chart", "announced"]
EMOTIONAL_CUES = ["love", "hate", "awesome", "terrible", "wow", "lol", "omg", "crazy", "insane", "happy", "sad", "angry",
                  "scared", "believe", "feel", "never", "always", "rocket", "gonna"]


@dataclass(frozen=True)
class IngestParams:
    keywords: tuple = tuple(DEFAULT_KEYWORDS)
    ignore_keywords: tuple = ()
    mark: float | None = None
    newest_per_community: int | None = INGEST_POST_LIMIT  # None: all posts
    min_post_score: int = INGEST_MIN_POST_SCORE
    min_post_length: int = INGEST_MIN_POST_LENGTH
    min_comment_score: int = INGEST_MIN_COMMENT_SCORE
    min_comment_length: int = INGEST_MIN_COMMENT_LENGTH
    budget: int | None = INGEST_POST_LIMIT  # None: everything accepted
    relevance_check: bool = True
    relevance_terms: tuple = tuple(RELEVANCE_TERMS)
    keyword_match: str = "substring"  # or "word"
    communities: tuple | None = None  # None -> every community in the data, name order
    batch_timestamp: str = "2024-01-16-00-00-00"
    cuts: TextCuts = WHOLE_TEXT


@dataclass(frozen=True)
class SearchParams:
    ticker: str = "AAPL"
    timeframe: str = "24h"
    as_of: float = 0.0
    ignore_keywords: tuple = tuple(SEARCH_IGNORE_KEYWORDS)
    newest_per_community: int | None = SEARCH_NEWEST_PER_COMMUNITY  # None: all posts
    min_post_score: int = SEARCH_MIN_POST_SCORE
    min_post_length: int = SEARCH_MIN_POST_LENGTH
    min_comment_score: int = SEARCH_MIN_COMMENT_SCORE
    min_comment_length: int = SEARCH_MIN_COMMENT_LENGTH
    comments_per_post: int = SEARCH_COMMENTS_PER_POST
    budget: int | None = SEARCH_POST_LIMIT
    communities: tuple | None = None
    rejects: str | None = None  # texts holding this cannot be scored
    cuts: TextCuts = WHOLE_TEXT


@dataclass(frozen=True)
class Lexicon:
    """Words of market talk; a list of one's own fits any column scorer here."""
    positive: tuple = ("gain", "gains", "up", "beat", "beats", "growth", "profit", "strong", "bullish", "buy", "record",
                       "upgrade", "good", "great", "win", "rally", "rise", "rises", "surge", "outperform")
    negative: tuple = ("loss", "losses", "down", "miss", "missed", "decline", "debt", "weak", "bearish", "sell", "lawsuit",
                       "downgrade", "bad", "terrible", "lose", "crash", "fall", "falls", "plunge", "underperform")


@dataclass(frozen=True)
class DashboardParams:
    ticker: str = "ALL"
    item_type: str = "all"
    as_of: float = 0.0  # response timestamp (a parameter, for repeatable output)


@dataclass(frozen=True)
class TrainParams:
    num_features: int = 1 << 18
    max_iter: int = 15
    reg_param: float = 0.01
    passes: tuple = (1, 2, 3)
    seed: int = SPLIT_SEED
    test_size: float = SPLIT_TEST_SIZE
