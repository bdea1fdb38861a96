"""Run configuration and the hashes that make stored results comparable.

Field names and defaults are part of the stored-artifact contract: the config
hash is taken over them.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, is_dataclass, replace
from datetime import datetime, timedelta
from typing import Any

from threadlens.wordlists import stopwords

PREPROCESS_VERSION = "v1"
LOCAL_KEYWORDS_VERSION = "tfidf_v2_1"
CORPUS_KEYWORDS_VERSION = "tfidf_v3"
CORPUS_VERSION = "corpus_v1"
KEYWORD_QUALITY_VERSION = "v1"

NORMALIZATIONS = ("none", "stem_en")


@dataclass(frozen=True, kw_only=True)
class TokenRules:
    """How a clean text becomes tokens; shared by statistics and keywords."""

    min_token_len: int = 2
    drop_numeric_tokens: bool = True
    lowercase: bool = True
    drop_stopwords: bool = True
    stopwords_lang: str = "en"
    stopwords_hash: str = "dummy"
    normalization: str = "none"

    def __post_init__(self) -> None:
        if self.normalization not in NORMALIZATIONS:
            raise ValueError(f"normalization must be one of {NORMALIZATIONS}, got {self.normalization!r}")
        if self.drop_stopwords:
            stopwords(self.stopwords_lang)

    def with_stopwords_hash(self):
        """The same rules, stamped with the hash of the stopword list in use."""
        return replace(self, stopwords_hash=stopwords_hash(self.stopwords_lang))


@dataclass(frozen=True, kw_only=True)
class TokenStatsConfig(TokenRules):
    top_n_tokens: int = 30


@dataclass(frozen=True, kw_only=True)
class KeywordConfig(TokenRules):
    """``min_df``/``max_df``: an int is an absolute count, a float a share of N."""

    top_k: int = 30
    min_df: int | float = 2
    max_df: int | float = 0.9
    tf_mode: str = "norm"
    idf_mode: str = "smooth_log_plus1_ln"
    ngram_range: tuple[int, int] = (1, 1)
    min_ngram_df: int = 2

    def __post_init__(self) -> None:
        super().__post_init__()
        smallest, largest = self.ngram_range
        if smallest < 1:
            raise ValueError(f"ngram_range must start at 1 or more, got {self.ngram_range}")
        if largest < smallest:
            raise ValueError(f"ngram_range must not end before it starts, got {self.ngram_range}")
        if self.min_ngram_df < 1:
            raise ValueError(f"min_ngram_df must be 1 or more, got {self.min_ngram_df}")


def config_hash(value: Any) -> str:
    """First 16 hex digits of SHA-256 over the key-sorted compact JSON."""
    plain = asdict(value) if is_dataclass(value) else value
    text = json.dumps(plain, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    return hashlib.sha256(text.encode("utf-8")).hexdigest()[:16]


def stopwords_hash(language: str) -> str:
    return config_hash(stopwords(language))


def keyword_config_hash(config: KeywordConfig) -> str:
    return config_hash({"config": asdict(config), "keywords_version": KEYWORD_QUALITY_VERSION})


# The settings that decide which features a text yields.
FEATURE_FIELDS = (
    "min_token_len",
    "drop_numeric_tokens",
    "lowercase",
    "drop_stopwords",
    "stopwords_lang",
    "stopwords_hash",
    "normalization",
    "ngram_range",
)


def corpus_config_hash(config: KeywordConfig) -> str:
    """Hash over the feature settings only: a corpus serves any df band or top-k."""
    return config_hash({name: getattr(config, name) for name in FEATURE_FIELDS})


def threshold_text(value: int | float) -> str:
    """Threshold as stored text; keeps 1 (a count) apart from 1.0 (a share)."""
    return str(int(value)) if isinstance(value, bool) else repr(value)


def parse_threshold(text: str) -> int | float:
    return float(text) if any(c in text for c in ".einf") else int(text)


def require_utc(moment: datetime) -> datetime:
    if moment.utcoffset() is None:
        raise ValueError(f"{moment!r} has no time zone; a UTC time is required")
    if moment.utcoffset() != timedelta(0):
        raise ValueError(f"{moment!r} is not in UTC")
    return moment
