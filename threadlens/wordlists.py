"""Word lists of the keyword contract.

The three lists below are FIXED VALUES: results and config hashes depend on
every entry, so they are data and not tuning knobs.
"""

from __future__ import annotations

# English function words and contractions.
FUNCTION_WORDS_EN = """
a am an and are as at be but by
for from just has have he her hers him his
i if in into is it its me my not of
on or our ours she so that the their theirs
them then there these they this those to too
up us was we were what when where which who
why will with you your yours do does did
can could would should than very all any
each few more most other some such same
only it's you're i'm that's gonna wanna
""".split()

# Filler words of comment platforms.
PLATFORM_FILLER_EN = """
hi hii hiii hello yes yeah yep no nah nope
video vid videos bro lol hey omg
ok okay pls please wow damn uh huh channel
upload post comment comments sub subscribe much
now vids ah ahh ahhh ahhhh thanks thank
thx lmao lmfao rofl wtf idk btw
""".split()

# Words of general praise that make poor keywords.
SENTIMENT_EN = """
amazing great awesome perfect beautiful favorite
favourite nice cool sweet love best top excite
excited exciting incredible dangerous freaking
""".split()

STOPWORDS_BY_LANGUAGE = {"en": frozenset(FUNCTION_WORDS_EN) | frozenset(PLATFORM_FILLER_EN)}


def stopwords(language: str) -> list[str]:
    """Sorted stopwords of a language; an unknown language is an error."""
    if language not in STOPWORDS_BY_LANGUAGE:
        raise ValueError(f"no stopword list for language {language!r}")
    return sorted(STOPWORDS_BY_LANGUAGE[language])
