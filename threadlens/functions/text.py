"""Column functions on comment text. All of them work inside one row: no shuffle."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.config import TokenRules
from threadlens.wordlists import stopwords

# Patterns of the cleaning and token contract. Spaces are listed one by
# one because Java's \s covers ASCII only; NFKC turns the rarer ones into U+0020.
NFKC_SPACES = r"\t-\r\x1c-\x20\x85\x{1680}\x{2028}\x{2029}"
SPACES = NFKC_SPACES + r"\xa0\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}"
URL = re.compile(r"https?://\S+|www\.\S+", re.IGNORECASE)
WORD = "[a-zA-Z0-9_']"
WORD_BYTES = np.array([bool(re.match(WORD, chr(byte))) for byte in range(256)])
NUMBER = "[0-9]+"
LETTER_PAIR_RUN = r"([a-zA-Z]{2})\1{2,}"
LETTER_RUN_PATTERN = r"([a-zA-Z])\1{2,}"
LETTER_RUN = re.compile(LETTER_RUN_PATTERN)
# The letters outside ASCII that have letters of words as their small forms.
LOWERED_TO_ASCII = {"\u0130": "i\u0307", "\u212a": "k"}
URL_MARK = "<URL>"
# Texts that are Python strings at a time while they are cleaned.
COMPOSED_ROWS = 64
# Words whose token a Python worker remembers from one batch to the next.
KNOWN_WORDS = 1 << 17


def _clean(text: str, mark: str) -> str:
    composed = normalize("NFKC", text)
    lowered = composed.lower()
    # Looking for a fixed text is far cheaper than the pattern, and most comments hold no link.
    if "://" in lowered or "www." in lowered:
        lowered = URL.sub(lambda _: mark, composed).lower()
    return " ".join(lowered.split())


@F.arrow_udf(T.StringType())
def _compose(texts: pa.Array, marks: pa.Array = None) -> pa.Array:
    # Arrow's own utf8_normalize leaves composed forms decomposed, hence the standard library.
    # A batch is taken in runs of texts: Python strings are several times their Arrow bytes.
    mark = URL_MARK if marks is None or not len(marks) else marks[0].as_py()
    runs = (texts.slice(start, COMPOSED_ROWS).to_pylist() for start in range(0, len(texts), COMPOSED_ROWS))
    composed = [pa.array([None if t is None else _clean(t, mark) for t in run], pa.string()) for run in runs]
    return pa.concat_arrays(composed) if composed else pa.array([], pa.string())


def clean_text(text: Column, url_mark: str = URL_MARK) -> Column:
    """NFKC, URLs to a mark, lower case, single spaces, trimmed. NFKC needs Python; the rest takes a fifth there of what
    patterns and a lower() per step take over texts that are not ASCII."""
    return _compose(text, F.lit(url_mark))


def is_blank(text: Column) -> Column:
    """Null, empty or only spaces."""
    return text.isNull() | ~text.rlike(f"[^{SPACES}]")


def collapse_letters(text: Column) -> Column:
    """Three or more equal letters in a row become two."""
    return F.regexp_replace(text, LETTER_RUN_PATTERN, "$1$1")


def is_letter_pair_run(word: Column) -> Column:
    """One pair of letters three or more times and nothing else: hahaha, xdxdxd."""
    return word.rlike(f"^{LETTER_PAIR_RUN}$")


def word_runs(text: Column, rules: TokenRules) -> Column:
    """Stretches of ASCII, which all characters of words are, in reading order; none of a NULL. ``kept_words`` takes them apart: a
    string per stretch is a fraction of one per word."""
    if rules.lowercase:
        for capital, small in LOWERED_TO_ASCII.items():
            text = F.replace(text, F.lit(capital), F.lit(small))
    runs = F.regexp_extract_all(text, F.lit(r"[\x00-\x7f]+"), F.lit(0))
    return F.coalesce(runs, F.array().cast("array<string>"))


@lru_cache(maxsize=8)
def word_rule(rules: TokenRules) -> Callable[[str], str | None]:
    """The token that a run of word characters stands for, or None: it is too short, one repeated letter pair, a number or
    a stopword. Runs of letters are collapsed first."""
    noise = re.compile(f"{NUMBER}|{LETTER_PAIR_RUN}" if rules.drop_numeric_tokens else LETTER_PAIR_RUN)
    dropped = frozenset(stopwords(rules.stopwords_lang)) if rules.drop_stopwords else frozenset()
    shortest = max(rules.min_token_len, 1)

    @lru_cache(maxsize=KNOWN_WORDS)
    def token(run: str) -> str | None:
        word = LETTER_RUN.sub(r"\1\1", run.lower() if rules.lowercase else run)
        return None if len(word) < shortest or word in dropped or noise.fullmatch(word) else word

    return token


def kept_words(
    runs: pa.Array, rules: TokenRules, finish: Callable[[str], str] | None = None
) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The tokens of lists of stretches (see ``word_runs``): (list they are in, code), in reading order, and the words of
    the codes.

    The rules look at each distinct word of a batch once, ``finish`` (a stemmer, say) at each distinct token.
    """
    flat = runs.flatten()
    if not len(flat):
        return np.empty(0, "int32"), np.empty(0, "int32"), pa.array([], pa.string())
    _, offsets, chars = flat.buffers()
    offsets = np.frombuffer(offsets, "int32", len(flat) + 1, flat.offset * 4)
    chars = np.frombuffer(chars or b"", "uint8")[offsets[0] : offsets[-1]]
    borders = offsets - offsets[0]
    # A word goes from one of its bytes behind another byte, or first in its stretch, up to the next such or other byte.
    inside = WORD_BYTES[chars]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    heads = borders[:-1][borders[:-1] < len(chars)]
    first[heads] = inside[heads]
    last[:-1] &= ~inside[1:] | first[1:]
    starts = np.flatnonzero(first)
    ends = np.cumsum(np.flatnonzero(last) + 1 - starts)
    buffers = (pa.py_buffer(x) for x in (np.concatenate(([0], ends)).astype("int32"), chars[inside]))
    encoded = pa.StringArray.from_buffers(len(starts), *buffers).dictionary_encode()
    rule = word_rule(rules)
    tokens = [rule(word) for word in encoded.dictionary.to_pylist()]
    if finish is not None:
        tokens = [None if token is None else finish(token) for token in tokens]
    merged = pa.array(tokens, pa.string()).dictionary_encode()
    code_of = pc.fill_null(merged.indices, -1).to_numpy(zero_copy_only=False)
    codes = code_of[encoded.indices.to_numpy(zero_copy_only=False)]
    kept = codes >= 0
    stretches = pc.fill_null(pc.list_value_length(runs), 0).to_numpy(zero_copy_only=False)
    words = np.diff(np.searchsorted(starts, borders[np.concatenate(([0], np.cumsum(stretches)))]))
    rows = np.repeat(np.arange(len(runs), dtype="int32"), words)
    return rows[kept], codes[kept], merged.dictionary


def word_tokens(text: Column, rules: TokenRules, finish: Callable[[str], str] | None = None) -> Column:
    """Filtered tokens of a text in reading order, each changed by ``finish``."""

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def tokens(runs: pa.Array) -> pa.Array:
        rows, codes, words = kept_words(runs, rules, finish)
        offsets = np.searchsorted(rows, np.arange(len(runs) + 1)).astype("int32")
        return pa.ListArray.from_arrays(pa.array(offsets), words.take(pa.array(codes)))

    return tokens(word_runs(text, rules))


def ngram_size(feature: Column) -> Column:
    """Number of words in a feature."""
    return F.size(F.split(feature, " "))
