"""Script-agnostic text measures as Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The sets and tables below define the language of the data model.
SENTENCE_END = ".!?।॥。！？؟…"
CLAUSE_END = ",;:،、，；：—–"
CLOSERS = "\"'”’)]»"
UNSPACED_LANGUAGES = ("zh", "ja", "th", "lo", "my", "km", "yue", "bo")
LANGUAGE_NAMES = {
    "en": ("english", "eng"),
    "hi": ("hindi", "hin"),
    "hi-en": ("hinglish",),
    "bn": ("bengali", "bangla", "ben"),
    "ta": ("tamil", "tam"),
    "te": ("telugu", "tel"),
    "mr": ("marathi", "mar"),
    "gu": ("gujarati", "guj"),
    "kn": ("kannada", "kan"),
    "ml": ("malayalam", "mal"),
    "pa": ("punjabi", "pan"),
    "or": ("odia", "oriya", "ori"),
    "ur": ("urdu", "urd"),
    "as": ("assamese", "asm"),
}
STREAM_TAGS = {
    "en": "eng", "hi": "hin", "bn": "ben", "ta": "tam", "te": "tel", "mr": "mar", "gu": "guj", "kn": "kan", "ml": "mal",
    "pa": "pan", "or": "ori", "ur": "urd", "as": "asm", "fr": "fre", "de": "ger", "es": "spa", "ja": "jpn", "zh": "chi",
}

_SPACE = r"(?U)\s"
_SPOKEN = r"[^\p{L}\p{M}\p{N}]"
#: Neither spoken nor white space, of any script.
_SILENT = r"(?U)[^\p{L}\p{M}\p{N}\s]"


def _chars(s: str) -> str:
    """A character class of these characters."""
    return "[" + "".join("\\" + c if c in "[]\\^-" else c for c in s) + "]"


def strip(text: Column) -> Column:
    """Without white space, of any script, at either end."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def normalize_language(code: Column) -> Column:
    """Short code of a language name or code; null for none."""
    c = F.replace(F.lower(strip(code)), F.lit("_"), F.lit("-"))
    out = None
    for short, names in LANGUAGE_NAMES.items():
        out = F.when(c.isin(*names), F.lit(short)) if out is None else out.when(c.isin(*names), F.lit(short))
    return F.when(F.coalesce(code, F.lit("")) != "", out.otherwise(c))


def base_language(code: Column) -> Column:
    return F.split_part(normalize_language(code), F.lit("-"), F.lit(1))


def container_language_tags(code: Column) -> Column:
    """Sorted spellings of a language in stream tags."""
    lang, base = normalize_language(code), base_language(code)
    tag = None
    for short, long in STREAM_TAGS.items():
        tag = F.when(base == short, F.lit(long)) if tag is None else tag.when(base == short, F.lit(long))
    tags = F.array_sort(F.array_distinct(F.array_compact(F.array(lang, base, tag))))
    return F.when(F.coalesce(lang, F.lit("")) == "", F.array().cast("array<string>")).otherwise(tags)


def spoken_char_count(text: Column) -> Column:
    """Letters, marks and digits of any script."""
    return F.length(F.regexp_replace(text, _SPOKEN, "")).cast("long")


def tokenize(text: Column) -> Column:
    """Lower-cased words reduced to letters, marks and digits."""
    # one pass over the text, not one a word
    words = F.split(F.lower(F.regexp_replace(text, _SILENT, "")), _SPACE + "+")
    return F.filter(words, lambda w: w != "")


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, also inside lambdas."""
    return F.transform(F.array(value), use)[0]


def repetition_ratio(text: Column, n: int = 3) -> Column:
    """Share of word n-grams that repeat an earlier one."""

    def ratio(t: Column) -> Column:
        # by place: a slice copies the whole array each time
        grams = F.transform(F.sequence(F.lit(0), F.greatest(F.size(t) - n, F.lit(0))), lambda i: F.concat_ws(" ", *(F.get(t, i + k) for k in range(n))))
        return F.when(F.size(t) < n + 1, F.lit(0.0)).otherwise(bound(grams, lambda g: 1 - F.size(F.array_distinct(g)) / F.size(g)))

    return bound(tokenize(text), ratio)


def _ends_with(text: Column, marks: str) -> Column:
    bare = F.regexp_replace(F.regexp_replace(text, r"(?U)\s+$", ""), _chars(CLOSERS) + "+$", "")
    return bare.rlike(_chars(marks) + r"\z")


def ends_sentence(text: Column) -> Column:
    """Whether the text, without space and then closing quotes or brackets, ends a sentence."""
    return _ends_with(text, SENTENCE_END)


def ends_clause(text: Column) -> Column:
    return _ends_with(text, CLAUSE_END)


def is_cased(text: Column) -> Column:
    return text.rlike(r"\p{IsUppercase}")


def starts_lowercase(text: Column) -> Column:
    """Whether the first letter is lower case."""
    return F.regexp_extract(text, r"\p{L}", 0).rlike(r"^\p{IsLowercase}")


def with_leading_space(token: Column, language: Column) -> Column:
    """A bare token in the spacing convention of its language."""
    t = strip(token)
    return F.when(F.coalesce(base_language(language), F.lit("")).isin(*UNSPACED_LANGUAGES), t).otherwise(F.concat(F.lit(" "), t))


def per_second(count: Column, seconds: Column) -> Column:
    """A rate; null for no duration."""
    return F.try_divide(count.cast("double"), seconds)


def join_words(words: Column, include_events: bool = False) -> Column:
    """Text of an array of words (text, kind, ...), events left out unless asked for."""
    chosen = words if include_events else F.filter(words, lambda w: w["kind"] == "word")
    return strip(F.array_join(F.transform(chosen, lambda w: w["text"]), ""))
