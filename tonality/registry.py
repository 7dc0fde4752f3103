"""Configuration tables: datasets, label domain, templates and news sources.

Everything below the ``FIXED VALUES`` marker must stay byte-identical to the
behaviour being reproduced (prompt wording, label words, URL templates,
thresholds); everything else is ordinary configuration.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --------------------------------------------------------------------------
# FIXED VALUES — must equal the original strings/numbers for equal results.
# --------------------------------------------------------------------------

# Instruction prefix put before every input text.
INSTRUCTION_PREFIX = (
    "What is the sentiment of the financial text? Please choose an answer "
    "from {negative/neutral/positive}: "
)

# System message of the three-role chat layout.
SYSTEM_PROMPT = (
    "You are a helpful AI assistant that analyzes financial sentiment. Your task "
    "is to classify the sentiment of financial text into one of the following "
    "categories: positive, negative, or neutral. Please provide your analysis in "
    "a clear and concise manner."
)

# Three-role chat layout markers.
CHAT_START = "<|im_start|>"
CHAT_END = "<|im_end|>"

# Label words, their sorted order, and the sentinel for anything else.
LABELS = ("negative", "neutral", "positive")
UNKNOWN = "unknown"

# Numeric label codes of the integer-labelled dataset.
NUMERIC_LABEL_MAP = {"0": "negative", "1": "neutral", "2": "positive"}

# Constant metadata attached to every knowledge-base entry.
KB_METADATA_SOURCE = "Phrasebank"
KB_METADATA_TYPE = "financial_news"

# Link fragments never followed (MarketWatch listing only).
URL_BLOCKLIST = ("barrons.com",)

# Retrieval: candidates from the vector index, then overlap threshold.
OVERLAP_THRESHOLD = 0.8

# Seed of the deterministic shuffles, and the query sample size.
SEED = 42
QUERY_SAMPLE_SIZE = 10

# Batch sizes: inference batches and training micro-batches; sequence length.
INFER_BATCH = 32
TRAIN_BATCH = 4
MAX_TOKENS = 512
PAD_MULTIPLE = 8


@dataclass(frozen=True)
class NewsSource:
    order: int           # position in the result union
    name: str
    threshold: float     # title-similarity threshold (strict >)
    date_op: str | None  # "after" / "since" / None
    base_url: str        # prefix for relative links
    search_url: str      # ``{q}`` is replaced by the percent-encoded query


# News sources in result order: threshold, date operator, link base, search URL.
SOURCES = (
    NewsSource(1, "MarketWatch", 0.8, "after", "https://www.marketwatch.com",
               "https://www.marketwatch.com/search?q={q}&m=Keyword&rpp=15&mp=806&bd=false&rs=true"),
    NewsSource(2, "Seeking Alpha", 0.2, None, "https://seekingalpha.com",
               "https://seekingalpha.com/search?q={q}"),
    NewsSource(3, "Bloomberg", 0.2, None, "https://www.bloomberg.com",
               "https://www.bloomberg.com/search?query={q}"),
    NewsSource(4, "CNBC", 0.2, None, "https://www.cnbc.com",
               "https://www.cnbc.com/search/?query={q}&qsearchterm={q}"),
    NewsSource(5, "Yahoo Finance", 0.8, "after", "https://finance.yahoo.com",
               "https://finance.yahoo.com/news/search?q={q}"),
    NewsSource(6, "Reuters", 0.8, "after", "https://www.reuters.com",
               "https://www.reuters.com/search/news?blob={q}"),
    NewsSource(7, "Market Screener", 0.8, "after", "https://www.marketscreener.com",
               "https://www.marketscreener.com/search/?q={q}"),
    NewsSource(8, "Twitter", 0.8, "since", "https://twitter.com",
               "https://twitter.com/search?q={q}&src=typed_query&f=live"),
    NewsSource(9, "Reddit", 0.8, "after", "https://www.reddit.com",
               "https://www.reddit.com/search/?q={q}&t=all"),
)

# Article-text routing: URL fragment -> paragraph scope.
ARTICLE_SCOPES = (
    ("seekingalpha.com", "container", "article-content"),
    ("marketwatch.com", "class", "article__body"),
)

# Relative time phrases in matching order: (regex over lower-cased text,
# days per unit or None for a fixed number of days, fixed days).
TIME_PATTERNS = (
    (r"([0-9]+)[WS]*(?:days?|d)[WS]*ago", 1, None),
    (r"([0-9]+)[WS]*(?:weeks?|w)[WS]*ago", 7, None),
    (r"([0-9]+)[WS]*(?:months?|m)[WS]*ago", 30, None),
    (r"([0-9]+)[WS]*(?:years?|y)[WS]*ago", 365, None),
    (r"today", None, 0),
    (r"yesterday", None, 1),
    (r"last[WS]+week", None, 7),
    (r"last[WS]+month", None, 30),
    (r"last[WS]+year", None, 365),
)

# HTML entities decoded in extracted text (``&amp;`` is decoded last).
HTML_ENTITIES = (
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
    ("&nbsp;", " "), ("&middot;", "·"), ("&copy;", "©"),
    ("&amp;", "&"),
)

# --------------------------------------------------------------------------
# Ordinary configuration
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class DatasetSpec:
    """One labelled input dataset.

    ``path`` is read with ``fmt``; ``input_field``/``output_field`` are mapped
    to ``text``/``label``; ``label_type`` selects numeric mapping or the
    substring normaliser.
    """

    name: str
    path: str | None = None
    fmt: str = "parquet"
    input_field: str = "text"
    output_field: str = "label"
    id_field: str = "id"
    label_type: str = "text"  # "text" | "numeric"
    label_mapping: dict = field(default_factory=lambda: dict(NUMERIC_LABEL_MAP))
    train_ratio: float = 0.8
    reader: object = None  # optional callable(spark) -> DataFrame for derived inputs
