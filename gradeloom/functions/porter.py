"""Porter's suffix stripper with the common later extensions.

Follows the published algorithm (Porter 1980) plus the departures used by the
usual English ROUGE stemmer: short words are kept, ``ies`` of four-letter words
gives ``ie``, ``y`` becomes ``i`` after any consonant that is not the first
letter, ``fulli`` and ``logi`` are handled in step 2, and a small set of words
is irregular.
"""

from __future__ import annotations

from functools import lru_cache

# Irregular words and suffix tables of the published algorithm.
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}
STEP2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ("fulli", "ful"),
)
STEP3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
    ("ful", ""), ("ness", ""),
)
STEP4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion",
    "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)


def _shape(word: str) -> str:
    """One letter per character: v for a vowel, c for a consonant (y depends on its left)."""
    out: list[str] = []
    for ch in word:
        if ch in "aeiou" or (ch == "y" and out and out[-1] == "c"):
            out.append("v")
        else:
            out.append("c")
    return "".join(out)


def _measure(stem: str) -> int:
    return _shape(stem).count("vc")


def _ends_double(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _ends_cvc(word: str) -> bool:
    shape = _shape(word)
    if len(word) > 2:
        return shape.endswith("cvc") and word[-1] not in "wxy"
    return shape == "vc"


def _swap(word: str, rules, minimum: int) -> str:
    for suffix, repl in rules:
        if word.endswith(suffix):
            stem = word[: len(word) - len(suffix)]
            return stem + repl if _measure(stem) >= minimum else word
    return word


def _step2(word: str) -> str:
    if word.endswith("alli") and _measure(word[:-4]) > 0:
        return _step2(word[:-2])
    if word.endswith("logi"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    return _swap(word, STEP2, 1)


def _step4(word: str) -> str:
    for suffix in STEP4:
        if word.endswith(suffix):
            stem = word[: len(word) - len(suffix)]
            fits = _measure(stem) > 1 and (suffix != "ion" or stem[-1:] in ("s", "t"))
            return stem if fits else word
    return word


def stem(word: str) -> str:
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    # plurals
    if word.endswith("ies") and len(word) == 4:
        word = word[:-1]
    elif word.endswith(("sses", "ies")):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    # past tense and gerund
    if word.endswith("ied"):
        word = word[:-1] if len(word) == 4 else word[:-2]
    elif word.endswith("eed"):
        word = word[:-1] if _measure(word[:-3]) > 0 else word
    else:
        for suffix in ("ed", "ing"):
            base = word[: len(word) - len(suffix)]
            if word.endswith(suffix) and "v" in _shape(base):
                if base.endswith(("at", "bl", "iz")):
                    base += "e"
                elif _ends_double(base):
                    base = base if base[-1] in "lsz" else base[:-1]
                elif _measure(base) == 1 and _ends_cvc(base):
                    base += "e"
                word = base
                break
    if word.endswith("y") and len(word) > 2 and _shape(word[:-1])[-1] == "c":
        word = word[:-1] + "i"
    word = _step2(word)
    word = _swap(word, STEP3, 1)
    word = _step4(word)
    # final e, final double l
    if word.endswith("e"):
        base = word[:-1]
        m = _measure(base)
        if m > 1 or (m == 1 and not _ends_cvc(base)):
            word = base
    if word.endswith("ll") and _measure(word[:-1]) > 1:
        word = word[:-1]
    return word


@lru_cache(maxsize=1 << 16)
def rouge_stem(word: str) -> str:
    """ROUGE stems only words of more than three characters."""
    return stem(word) if len(word) > 3 else word
