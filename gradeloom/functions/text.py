"""String columns that follow Python's text rules, evaluated inside the JVM."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points for which Python's str.isspace() is true.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
WHITESPACE_RUN = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_or_empty(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(""))


def trim_py(c: Column | str) -> Column:
    """``str.strip()``: Spark's own ``trim`` would leave tabs and newlines."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def words(c: Column | str) -> Column:
    """``str.split()``: no empty pieces, so an empty text has no words."""
    return F.array_remove(F.split(text_or_empty(c), WHITESPACE_RUN), "")


def slug(c: Column | str) -> Column:
    return F.replace(F.lower(_col(c)), F.lit(" "), F.lit("_"))


def capitalize_py(c: Column | str) -> Column:
    """``str.capitalize()``: first letter upper, the rest lower."""
    c = _col(c)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 2147483647)))


def preview(c: Column | str, n: int = 200) -> Column:
    """``text[:n]``, counted in code points as Python does."""
    return F.substring(_col(c), 1, n)


def strip_prompt(generated: Column | str, prompt: Column | str) -> Column:
    """Cut the echoed prompt off a generation by its length, then strip."""
    return trim_py(F.substr(_col(generated), F.length(_col(prompt)) + 1))


def has_text(c: Column | str) -> Column:
    return F.length(text_or_empty(c)) > 0


# -- tokenizers -------------------------------------------------------------------------
#
# A tokenizer prepares the text in the JVM and names the pattern that separates its
# tokens. ``tokenize`` splits in the JVM; the pair kernel splits the prepared text in
# Arrow, which moves one string per row instead of a list of them.


@dataclass(frozen=True)
class Splitter:
    """Where tokens end: a separator pattern, and the same rule for single UTF-8 bytes.

    ``token_bytes`` are the bytes that belong to tokens. ``wide`` matches separators
    outside ASCII, for which the byte rule alone would be wrong.
    """

    pattern: str
    token_bytes: bytes
    wide: str | None = None


@dataclass(frozen=True)
class Tokenizer:
    prepare: Callable[[Column], Column]
    splitter: Splitter


_ASCII_SPACES = WHITESPACE.encode("ascii", "ignore")
BY_WHITESPACE = Splitter(
    WHITESPACE_RUN, bytes(b for b in range(256) if b not in _ASCII_SPACES), WHITESPACE_RUN.replace(r"\t-\r\x1c-\x20", "")
)
# ROUGE tokens: runs of [a-z0-9]; every other character separates
BY_OTHER_THAN_ALNUM = Splitter("[^a-z0-9]+", b"abcdefghijklmnopqrstuvwxyz0123456789")


def lowered(c: Column | str) -> Column:
    return F.lower(text_or_empty(c))


# The published Treebank word-splitting rules for lower-cased text, in order,
# rules that only put spaces around a mark taken together. The flag tells whether a rule can
# apply to a text without any quotation mark.
CONTRACTION = r"\b(?:(can)(not)|(gim|lem)(me)|(gon|wan)(na)|(got)(ta))\b"
CONTRACTED = ("cannot", "gimme", "lemme", "gonna", "wanna", "gotta")
TREEBANK_RULES: Sequence[tuple[str, str, bool]] = (
    # opening quotes
    (r"([«“‘„]|`+)", r" $1 ", False),
    (r"^\"", r" `` ", False),
    (r"([ \(\[{<])(\"|'{2})", r"$1 `` ", False),
    (r"(')(?!re|ve|ll|m|t|s|d|n)(\w)\b", r"$1 $2", False),
    # a full stop that ends a sentence
    (r"([^\.])(\.)([\]\)}>\"'»”’ ]*)(?=\s|\z)", r"$1 $2 $3 ", True),
    # colons and commas, except inside numbers
    (r"([:,])([^\d]|\z)", r" $1 $2", True),
    # ellipses, dashes, brackets and other marks
    (r"(\.{2,}|--|[;@#$%&?!*\]\[(){}<>])", r" $1 ", True),
    (r"([^'])' ", r"$1 ' ", False),
    (r"\z", r" ", False),
    # closing quotes and clitics
    (r"([»”’]|'')", r" $1 ", False),
    (r"(\")", r" '' ", False),
    (r"([^' ])('ll|'re|'ve|n't|'s|'m|'d|') ", r"$1 $2 ", False),
    # contractions
    (CONTRACTION, r" $1$3$5$7 $2$4$6$8 ", True),
    (r"\b(?:(d)('ye)|(more)('n))\b", r" $1$3 $2$4 ", False),
    (r" ('t)(is|was)\b", r" $1 $2 ", False),
)
QUOTATION_MARK = "[\"'`«“‘„»”’]"


def treebank_text(c: Column | str) -> Column:
    """Lower-cased text with spaces between its word tokens by the Treebank rules.

    The public word tokenizer first cuts sentences with a trained model that is
    not available here. On lower-cased text that model ends a sentence at every
    word-final full stop except after learned abbreviations, so this splits off
    every word-final full stop. Texts without quotation marks skip the rules that
    need one, and texts without a contracted word the rule for these; rules put spaces
    between letters and never join any.
    """

    def apply(x: Column, rules) -> Column:
        for pattern, replacement, _ in rules:
            x = F.regexp_replace(x, pattern, replacement)
        return x

    def split_marks(x: Column) -> Column:
        plain = [rule for rule in TREEBANK_RULES if rule[2]]
        plainest = [rule for rule in plain if rule[0] != CONTRACTION]
        contracted = reduce(or_, [x.contains(word) for word in CONTRACTED])
        return F.when(x.rlike(QUOTATION_MARK), apply(x, TREEBANK_RULES)).when(contracted, apply(x, plain)).otherwise(apply(x, plainest))

    # the one-element array names the lowered text, so it is computed once for the test and the rules
    return F.transform(F.array(lowered(c)), split_marks)[0]


TOKENIZERS: dict[str, Tokenizer] = {
    "whitespace": Tokenizer(lowered, BY_WHITESPACE),
    "alnum": Tokenizer(lowered, BY_OTHER_THAN_ALNUM),
    "treebank": Tokenizer(treebank_text, BY_WHITESPACE),
}


def tokenizer_named(name: str) -> Tokenizer:
    if name not in TOKENIZERS:
        raise ValueError(f"unknown tokenizer {name!r}; known: {sorted(TOKENIZERS)}")
    return TOKENIZERS[name]


def tokenize(c: Column | str, tokenizer: str) -> Column:
    rule = tokenizer_named(tokenizer)
    return F.array_remove(F.split(rule.prepare(_col(c)), rule.splitter.pattern), "")
