"""English stemming: the published Snowball "Porter2" algorithm as an Arrow function.

A batch of token lists is dictionary-encoded first, so the Python rules run once
per distinct word of a batch (and, through the cache, about once per worker), never
once per occurrence. Token lists stay in their row: stemming adds no shuffle.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the published algorithm.
IRREGULAR = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli",
    "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas",
    "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
KEPT_AFTER_PLURAL = {
    "inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed",
}
STEP_2 = {
    "ization": "ize", "ational": "ate", "fulness": "ful", "ousness": "ous", "iveness": "ive",
    "tional": "tion", "biliti": "ble", "lessli": "less", "entli": "ent", "ation": "ate",
    "alism": "al", "aliti": "al", "ousli": "ous", "iviti": "ive", "fulli": "ful", "enci": "ence",
    "anci": "ance", "abli": "able", "izer": "ize", "ator": "ate", "alli": "al", "bli": "ble",
    "ogi": "og", "li": "",
}
STEP_3 = {
    "ational": "ate", "tional": "tion", "alize": "al", "icate": "ic", "iciti": "ic",
    "ative": "", "ical": "ic", "ness": "", "ful": "",
}
STEP_4 = (
    "ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism", "ate", "iti",
    "ous", "ive", "ize", "ion", "al", "er", "ic",
)

_VOWEL = re.compile("[aeiouy]")
_REGION = re.compile("[aeiouy][^aeiouy]")
_REGION_PREFIX = re.compile("gener|commun|arsen")
_CONSONANT_Y = re.compile("(^|[aeiouy])y")
_SHORT_SYLLABLE = re.compile("(?:[^aeiouy][aeiouy][^aeiouywxY]|^[aeiouy][^aeiouy])$")
_DOUBLE = re.compile("(?:bb|dd|ff|gg|mm|nn|pp|rr|tt)$")
_PAST_OR_GERUND = re.compile("(?:eedly|ingly|edly|eed|ing|ed)$")


def _regions(word: str) -> tuple[int, int]:
    """Start positions of the regions R1 and R2."""
    prefix = _REGION_PREFIX.match(word)
    found = prefix or _REGION.search(word)
    first = found.end() if found else len(word)
    found = _REGION.search(word, first)
    return first, found.end() if found else len(word)


def _longest(word: str, suffixes) -> str | None:
    return max((s for s in suffixes if word.endswith(s)), key=len, default=None)


def _plural(word: str) -> str:
    if word.endswith("sses"):
        return word[:-2]
    if word.endswith(("ied", "ies")):
        return word[:-2] if len(word) > 4 else word[:-1]
    if word.endswith("s") and not word.endswith(("us", "ss")) and _VOWEL.search(word[:-2]):
        return word[:-1]
    return word


def _past_or_gerund(word: str, r1: int) -> str:
    found = _PAST_OR_GERUND.search(word)
    if not found:
        return word
    base = word[: found.start()]
    if found.group().startswith("eed"):
        return base + "ee" if found.start() >= r1 else word
    if not _VOWEL.search(base):
        return word
    if base.endswith(("at", "bl", "iz")):
        return base + "e"
    if _DOUBLE.search(base):
        return base[:-1]
    if len(base) <= r1 and _SHORT_SYLLABLE.search(base):
        return base + "e"
    return base


def _derivation(word: str, r1: int, r2: int) -> str:
    suffix = _longest(word, STEP_2)
    if suffix and len(word) - len(suffix) >= r1:
        base = word[: len(word) - len(suffix)]
        allowed = {"ogi": base.endswith("l"), "li": base.endswith(tuple("cdeghkmnrt"))}
        if allowed.get(suffix, True):
            word = base + STEP_2[suffix]
    suffix = _longest(word, STEP_3)
    if suffix and len(word) - len(suffix) >= (r2 if suffix == "ative" else r1):
        word = word[: len(word) - len(suffix)] + STEP_3[suffix]
    suffix = _longest(word, STEP_4)
    if suffix and len(word) - len(suffix) >= r2:
        base = word[: len(word) - len(suffix)]
        if suffix != "ion" or base.endswith(("s", "t")):
            word = base
    return word


def _final_letter(word: str, r1: int, r2: int) -> str:
    end = len(word) - 1
    if word.endswith("e") and (end >= r2 or (end >= r1 and not _SHORT_SYLLABLE.search(word[:-1]))):
        return word[:-1]
    if word.endswith("ll") and end >= r2:
        return word[:-1]
    return word


@lru_cache(maxsize=1 << 18)
def stem_word(word: str) -> str:
    word = word.lower()
    if len(word) <= 2:
        return word
    if word in IRREGULAR:
        return IRREGULAR[word]
    word = _CONSONANT_Y.sub(r"\1Y", word.removeprefix("'"))
    r1, r2 = _regions(word)
    word = _plural(re.sub("'(?:s'?)?$", "", word))
    if word in KEPT_AFTER_PLURAL:
        return word
    word = _past_or_gerund(word, r1)
    if len(word) > 2 and word[-1] in "yY" and not _VOWEL.match(word[-2]):
        word = word[:-1] + "i"
    word = _final_letter(_derivation(word, r1, r2), r1, r2)
    return word.replace("Y", "y")


def _stem_distinct(words: pa.Array) -> pa.Array:
    encoded = words.dictionary_encode()
    stems = [None if w is None else stem_word(w) for w in encoded.dictionary.to_pylist()]
    return pa.array(stems, pa.string()).take(encoded.indices)


@F.arrow_udf(T.StringType())
def stem(words: pa.Array) -> pa.Array:
    """Stem of a single word."""
    return _stem_distinct(words)


@F.arrow_udf(T.ArrayType(T.StringType()))
def stem_tokens(lists: pa.Array) -> pa.Array:
    """Stems of a token list, positions kept."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype("int32")
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), _stem_distinct(lists.flatten()))
