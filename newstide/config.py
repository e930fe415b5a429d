"""Settings and fixed values shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# --- fixed values -----------------------------------------------------------
# These lists, weights and thresholds define the results and are stated as is.

SOURCE_WEIGHTS = {
    "reuters.com": 1.00,
    "apnews.com": 0.98,
    "bbc.com": 0.95,
    "cnn.com": 0.90,
    "unknown": 0.70,
}

CATEGORY_WEIGHTS = {
    "general": 1.00,
    "world": 0.95,
    "business": 0.90,
    "technology": 0.80,
    "science": 0.75,
    "health": 0.75,
    "sports": 0.60,
    "entertainment": 0.50,
}

TOPICS = [
    "politics and government",
    "sports and athletics",
    "science and research",
    "technology and innovation",
    "health and medicine",
    "business and finance",
    "entertainment and celebrity",
    "crime and justice",
    "climate and environment",
    "education and schools",
    "war and conflict",
    "travel and tourism",
]

FEED_CATEGORIES = [
    "business",
    "entertainment",
    "general",
    "health",
    "science",
    "sports",
    "technology",
]

UNWANTED_SNIPPETS = [
    "A required part of this site couldn't load",
    "A required part of this site couldnt load",
]

BOILERPLATE_KEYWORDS = [
    "copyright",
    "©",
    "all rights reserved",
    "terms of use",
    "disclaimer",
    "reproduction prohibited",
    "unauthorized reproduction",
    "no part of this",
    "ap photo",
    "ap images",
    "getty images",
    "reuters",
    "afp",
    "associated press",
    "via ap",
    "image credit",
    "photo credit",
    "file photo",
    "bbc is not responsible",
    "cnn's",
    "fox news",
    "nytimes.com",
    "the guardian",
    "advertisement",
    "sponsored content",
    "click here",
    "read more",
    "see also",
    "watch now",
]

PHOTO_CREDIT_PATTERN = r"\(AP Photo/.*?\)"
SAMPLE_ID_PATTERN = r"^\d+-(202[5-9]|20[3-9]\d)-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])$"
SENTENCE_BREAK_PATTERN = r"(?<=[.!?]) +"
WORD_PATTERN = r"[\p{L}\p{N}_]{2,}"

INVALID_TOPICS = ["", "topic", "unknown", "none"]
INVALID_SENTIMENTS = ["", "n/a", "label", "unknown", "none"]

UNTITLED = "(untitled)"
LABEL_SEPARATOR = " – "

# Every character the trimming rules treat as white space.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Short function-word list used when the caller passes no other.
ENGLISH_STOP_WORDS = (
    "a about above after again against all also am an and any are as at be because been before being "
    "below between both but by can could did do does doing down during each few for from further had "
    "has have having he her here hers herself him himself his how i if in into is it its itself just "
    "me more most must my myself no nor not now of off on once only or other our ours ourselves out "
    "over own same she should so some such than that the their theirs them themselves then there these "
    "they this those through to too under until up upon us very was we were what when where which while "
    "who whom why will with within without would you your yours yourself yourselves"
).split()
# --- end of fixed values ----------------------------------------------------


@dataclass(frozen=True)
class ScoringConfig:
    """Article and cluster scoring."""

    source_weights: dict[str, float] = field(default_factory=lambda: dict(SOURCE_WEIGHTS))
    category_weights: dict[str, float] = field(default_factory=lambda: dict(CATEGORY_WEIGHTS))
    recency_tau_hours: float = 42.0
    diversity_zeta: float = 0.5
    reputable_from: float = 0.9
    missing_age_hours: float = 72.0


@dataclass(frozen=True)
class TrendsConfig:
    """Thread linking over days."""

    link_similarity: float = 0.80
    ema_lambda: float = 0.70
    novelty_days: int = 7


@dataclass(frozen=True)
class ClusterConfig:
    """Average-linkage clustering."""

    distance: float = 0.30
    min_size: int = 3
    block_rows: int = 1000
    # Components up to this many distinct vectors are finished inside one task;
    # larger ones are merged by distributed rounds, with the same result.
    local_rows: int = 2000
    # Larger ones of dense vectors are finished inside one task once they have shrunk to this many rows, without a matrix of distances.
    task_rows: int = 20_000
    # As ``local_rows`` for sparse vectors, which a task lays out dense over the slots they share.
    sparse_local_rows: int = 800


@dataclass(frozen=True)
class EngineConfig:
    scoring: ScoringConfig = field(default_factory=ScoringConfig)
    trends: TrendsConfig = field(default_factory=TrendsConfig)
    clusters: ClusterConfig = field(default_factory=ClusterConfig)
    top_words: int = 15
    prune_days: int = 7


def config_from(stored: dict | None = None, overrides: dict | None = None) -> EngineConfig:
    """Build the settings from a stored document, else defaults, then overrides.

    Keys are the field names of the three sections; unknown keys are refused.
    """
    cfg = EngineConfig()
    for values in (stored or {}, overrides or {}):
        for key, value in values.items():
            for section in ("scoring", "trends", "clusters"):
                part = getattr(cfg, section)
                if hasattr(part, key):
                    cfg = replace(cfg, **{section: replace(part, **{key: value})})
                    break
            else:
                if key not in ("top_words", "prune_days"):
                    raise KeyError(f"unknown setting {key!r}")
                cfg = replace(cfg, **{key: value})
    return cfg
