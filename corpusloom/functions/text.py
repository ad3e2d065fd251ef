"""Text functions: trimming, splitting, tagged spans, words, n-grams and numbers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.bind import let

# The characters that count as whitespace for stripping and for word splitting.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The same set and the word characters as regular-expression classes. Written out because the
# JVM's \s and \w cover ASCII only.
WS_CLASS = r"\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WORD_CLASS = r"\p{L}\p{N}_"

WORD_PATTERN = f"[{WORD_CLASS}]+|[^{WORD_CLASS}{WS_CLASS}]"
# A signed decimal that is not part of a word or of a dotted number. A number directly followed
# by a full stop does not count.
NUMBER_PATTERN = rf"(?<![{WORD_CLASS}.])[-+]?\p{{Nd}}+(?:\.\p{{Nd}}+)?(?![{WORD_CLASS}.])"


def strip(text: Column) -> Column:
    """Remove all leading and trailing whitespace (Spark's ``trim`` removes spaces only)."""
    return F.btrim(text, F.lit(WHITESPACE))


def strip_newlines(text: Column) -> Column:
    return F.btrim(text, F.lit("\n"))


def lstrip_newlines(text: Column) -> Column:
    return F.ltrim(text, F.lit("\n"))


def rstrip_newlines(text: Column) -> Column:
    return F.rtrim(text, F.lit("\n"))


def before_first(text: Column, marker: str) -> Column:
    """Text before the first marker; the whole text when the marker is absent."""
    return F.substring_index(text, marker, 1)


def after_first(text: Column, marker: str) -> Column:
    """Text after the first marker; null when the marker is absent."""
    pos = F.instr(text, marker)
    return F.when(pos > 0, F.substring(text, pos + F.lit(len(marker)), F.length(text)))


def after_last(text: Column, marker: str) -> Column:
    """Text after the last marker; the whole text when the marker is absent."""
    return F.substring_index(text, marker, -1)


def count_of(text: Column, piece: str) -> Column:
    """Number of non-overlapping occurrences of ``piece``."""
    removed = F.length(F.replace(text, F.lit(piece), F.lit("")))
    return ((F.length(text) - removed) / F.lit(len(piece))).cast("int")


def contains_ignore_case(text: Column, piece: Column) -> Column:
    return F.contains(F.lower(text), F.lower(piece))


def tag_pattern(tag: str) -> str:
    """Shortest span between ``<tag>`` and ``</tag>``, newlines included."""
    return f"(?s)<{tag}>(.*?)</{tag}>"


def tag_spans(text: Column, tag: str) -> Column:
    """Bodies of all ``<tag>…</tag>`` spans, in order."""
    return F.regexp_extract_all(text, F.lit(tag_pattern(tag)), F.lit(1))


def remove_tag_spans(text: Column, tag: str, trailing_space: bool = False) -> Column:
    pattern = tag_pattern(tag) + (f"[{WS_CLASS}]*" if trailing_space else "")
    return F.regexp_replace(text, pattern, "")


def words(text: Column) -> Column:
    """Lower-cased words and single punctuation marks."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), F.lit(0))


def whitespace_words(text: Column) -> Column:
    """Number of whitespace-separated words; 0 for blank text."""
    stripped = strip(text)
    return F.when(F.length(stripped) == 0, F.lit(0)).otherwise(
        F.size(F.split(stripped, f"[{WS_CLASS}]+"))
    )


def token_runs(tokens: Column, n: int, join: Callable[..., Column]) -> Column:
    """``join`` applied to every run of ``n`` tokens; empty when there are fewer than ``n``."""

    def build(bound: Column) -> Column:
        heads = F.slice(bound, F.lit(1), F.greatest(F.size(bound) - F.lit(n - 1), F.lit(0)))
        return F.transform(heads, lambda first, i: join(first, *[F.get(bound, i + F.lit(k)) for k in range(1, n)]))

    return let(tokens, build)


def _with_spaces(*tokens: Column) -> Column:
    return F.concat(tokens[0], *[x for t in tokens[1:] for x in (F.lit(" "), t)])


def ngrams(tokens: Column, n: int) -> Column:
    """All runs of ``n`` tokens, each joined by a space.

    Tokens hold no whitespace, so the joined text identifies the run, and ``array_distinct``
    can hash plain strings instead of comparing nested arrays pairwise.
    """
    return token_runs(tokens, n, _with_spaces)


def repeat_share(tokens: Column, n: int = 3, cap: float = 0.5) -> Column:
    """Share of repeated n-grams, doubled, scaled and capped at ``cap``; 0 without n-grams."""

    def score(grams: Column) -> Column:
        total = F.size(grams)
        repeats = total - F.size(F.array_distinct(grams))
        return F.when(total == 0, F.lit(0.0)).otherwise(
            F.least(F.lit(float(cap)), repeats * F.lit(float(cap)) * F.lit(2.0) / total)
        )

    return let(ngrams(tokens, n), score)


def repeat_fraction(text: Column, n: int = 3, cap: float = 0.5) -> Column:
    """``repeat_share`` over the words of a text."""
    return repeat_share(words(text), n, cap)


def numbers(text: Column) -> Column:
    """Signed decimals found in the text once thousands commas are removed."""
    plain = F.replace(text, F.lit(","), F.lit(""))
    found = F.regexp_extract_all(plain, F.lit(NUMBER_PATTERN), F.lit(0))
    return F.transform(found, lambda x: x.try_cast("double"))


# Mathematical symbols and the ASCII text that replaces them before evaluation.
MATH_SYMBOLS = {
    "^": "**",
    "×": "*",
    "÷": "/",
    "−": "-",
    "²": "**2",
    "³": "**3",
    "（": "(",
    "）": ")",
}


def ascii_math(expression: Column) -> Column:
    """Write mathematical symbols in plain ASCII."""
    for symbol, plain in MATH_SYMBOLS.items():
        expression = F.replace(expression, F.lit(symbol), F.lit(plain))
    return expression


def keep_head(text: Column, n: int) -> Column:
    return F.left(text, F.lit(n))


def keep_tail(text: Column, n: int) -> Column:
    return F.right(text, F.lit(n))
