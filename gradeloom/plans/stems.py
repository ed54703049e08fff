"""The stemmer of ROUGE words as SQL: steps over the distinct words, each a CTE.

Written from the published description, step by step, as a check of the Python form: a
word's letters become ``v`` and ``c``, and the measure of a stem is the number of ``vc``.
"""

from __future__ import annotations


def shape(word: str) -> str:
    """``v`` or ``c`` per letter; a y is a vowel behind a consonant."""
    return (
        f"list_reduce(string_split({word}, ''), lambda done, letter: done || CASE WHEN letter IN ('a', 'e', 'i', 'o', 'u') "
        "OR (letter = 'y' AND done[-1:] = 'c') THEN 'v' WHEN letter = '' THEN '' ELSE 'c' END, '')"
    )


def measure(of_shape: str) -> str:
    return f"((len({of_shape}) - len(replace({of_shape}, 'vc', ''))) // 2)"


def cvc(word: str, of_shape: str) -> str:
    """Ends in consonant, vowel, consonant other than w, x, y; or is a vowel and a consonant."""
    return f"CASE WHEN len({word}) > 2 THEN {of_shape}[-3:] = 'cvc' AND {word}[-1:] NOT IN ('w', 'x', 'y') ELSE {of_shape} = 'vc' END"


def doubled(word: str, of_shape: str) -> str:
    return f"(len({word}) > 1 AND {word}[-1:] = {word}[-2:-2] AND {of_shape}[-1:] = 'c')"


def step(name: str, before: str, suffixes: str, result: str) -> str:
    """CTE ``name`` (word, w): of the longest of ``suffixes`` that ends ``w``, ``result`` by ``suffix, stem, s, m``.

    ``s`` is the shape of the stem, ``m`` its measure; words without such a suffix stay.
    """
    return f""",
{name}_cut AS (
  SELECT word, w, suffix, w[:len(w) - len(suffix)] AS stem, {shape('w[:len(w) - len(suffix)]')} AS s
  FROM (SELECT word, w, regexp_extract(w, '({suffixes})$', 1) AS suffix FROM {before})
),
{name} AS (SELECT word, CASE WHEN suffix = '' THEN w ELSE {result} END AS w FROM (SELECT *, {measure('s')} AS m FROM {name}_cut))"""


# Irregular words, and the suffix pairs of the second and third step.
IRREGULAR = """MAP {'sky': 'sky', 'skies': 'sky', 'dying': 'die', 'lying': 'lie', 'tying': 'tie', 'news': 'news',
  'inning': 'inning', 'innings': 'inning', 'outing': 'outing', 'outings': 'outing', 'canning': 'canning', 'cannings': 'canning',
  'howe': 'howe', 'proceed': 'proceed', 'exceed': 'exceed', 'succeed': 'succeed'}"""
SECOND = """MAP {'ational': 'ate', 'tional': 'tion', 'enci': 'ence', 'anci': 'ance', 'izer': 'ize', 'bli': 'ble', 'alli': 'al',
  'entli': 'ent', 'eli': 'e', 'ousli': 'ous', 'ization': 'ize', 'ation': 'ate', 'ator': 'ate', 'alism': 'al', 'iveness': 'ive',
  'fulness': 'ful', 'ousness': 'ous', 'aliti': 'al', 'iviti': 'ive', 'biliti': 'ble', 'fulli': 'ful'}"""
SECOND_SUFFIXES = (
    "ational|tional|enci|anci|izer|bli|alli|entli|eli|ousli|ization|ation|ator|alism|iveness|fulness|ousness|aliti|iviti|biliti|fulli"
)
THIRD = "MAP {'icate': 'ic', 'ative': '', 'alize': 'al', 'iciti': 'ic', 'ical': 'ic', 'ful': '', 'ness': ''}"

STEPS = (
    step("plural", "regular", "sses|ies|ss|s", """CASE suffix WHEN 'ies' THEN CASE WHEN len(w) = 4 THEN w[:3] ELSE w[:len(w) - 2] END
      WHEN 'sses' THEN w[:len(w) - 2] WHEN 'ss' THEN w ELSE w[:len(w) - 1] END""")
    # what loses its -ed or -ing is repaired in the next CTE
    + step("past", "plural", "ied|eed|ed|ing", """CASE suffix WHEN 'ied' THEN CASE WHEN len(w) = 4 THEN w[:3] ELSE w[:len(w) - 2] END
      WHEN 'eed' THEN CASE WHEN m > 0 THEN w[:len(w) - 1] ELSE w END
      ELSE CASE WHEN contains(s, 'v') THEN stem || '+' ELSE w END END""")
    + f""",
repaired AS (
  SELECT word, CASE WHEN w[-1:] <> '+' THEN w
    WHEN regexp_matches(base, '(at|bl|iz)$') THEN base || 'e'
    WHEN {doubled('base', 's')} THEN CASE WHEN base[-1:] IN ('l', 's', 'z') THEN base ELSE base[:len(base) - 1] END
    WHEN {measure('s')} = 1 AND {cvc('base', 's')} THEN base || 'e'
    ELSE base END AS w
  FROM (SELECT word, w, rtrim(w, '+') AS base, {shape("rtrim(w, '+')")} AS s FROM past)
)"""
    + step("y_to_i", "repaired", "y", "CASE WHEN len(w) > 2 AND s[-1:] = 'c' THEN stem || 'i' ELSE w END")
    # -alli loses its -li first, and what is left goes through the second step
    + step("less_li", "y_to_i", "alli", "CASE WHEN m > 0 THEN stem || 'al' ELSE w END")
    + step("less_logi", "less_li", "ogi", "CASE WHEN stem[-1:] = 'l' AND m > 0 THEN stem || 'og' ELSE w END")
    + step("second", "less_logi", SECOND_SUFFIXES, f"CASE WHEN m > 0 THEN stem || {SECOND}[suffix] ELSE w END")
    + step("third", "second", "icate|ative|alize|iciti|ical|ful|ness", f"CASE WHEN m > 0 THEN stem || {THIRD}[suffix] ELSE w END")
    + step(
        "fourth", "third", "al|ance|ence|er|ic|able|ible|ant|ement|ment|ent|ion|ou|ism|ate|iti|ous|ive|ize",
        "CASE WHEN m > 1 AND (suffix <> 'ion' OR stem[-1:] IN ('s', 't')) THEN stem ELSE w END",
    )
    + step("less_e", "fourth", "e", f"CASE WHEN m > 1 OR (m = 1 AND NOT {cvc('stem', 's')}) THEN stem ELSE w END")
    + step("less_l", "less_e", "ll", f"CASE WHEN {measure(shape("stem || 'l'"))} > 1 THEN stem || 'l' ELSE w END")
)


def stemmed(tokens, source: str) -> str:
    """CTEs up to ``pairs``: those of ``source`` (model, id, prediction, reference) with every ROUGE word stemmed.

    ``tokens`` is the SQL of a text's words. Words of up to three letters stay.
    """
    return f""",
spelled_words AS (
  SELECT model, id, side, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM (
    SELECT model, id, 'p' AS side, {tokens('prediction')} AS words FROM {source}
    UNION ALL SELECT model, id, 'r', {tokens('reference')} FROM {source})
),
distinct_words AS (SELECT DISTINCT word FROM spelled_words),
regular AS (SELECT word, word AS w FROM distinct_words WHERE len(word) > 3 AND {IRREGULAR}[word] IS NULL){STEPS},
stems AS (
  SELECT word, w FROM less_l
  UNION ALL SELECT word, coalesce({IRREGULAR}[word], word) FROM distinct_words WHERE len(word) <= 3 OR {IRREGULAR}[word] IS NOT NULL
),
stemmed_sides AS (
  SELECT model, id, side, string_agg(w, ' ' ORDER BY place) AS text FROM spelled_words JOIN stems USING (word) GROUP BY ALL
),
pairs AS (
  SELECT {source}.model, {source}.id, coalesce(p.text, '') AS prediction, coalesce(r.text, '') AS reference FROM {source}
  LEFT JOIN stemmed_sides p ON p.model = {source}.model AND p.id = {source}.id AND p.side = 'p'
  LEFT JOIN stemmed_sides r ON r.model = {source}.model AND r.id = {source}.id AND r.side = 'r'
)"""
