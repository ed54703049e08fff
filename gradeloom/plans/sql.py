"""SQL forms of the input tables and shared steps, for an independent SQL engine."""

from __future__ import annotations

from gradeloom.functions.templates import SYSTEM_LINE
from gradeloom.functions.text import WHITESPACE_RUN
from gradeloom.plans.tables import MODELS
from gradeloom.schemas import CRITERIA

SPACES = "[ \\n\\t\\r]+"

INSTRUCT = f"""
instruct_words AS (
  SELECT doc_id, lang, list_filter(regexp_split_to_array(text, '{SPACES}'), lambda x: x <> '') AS ws,
         CASE WHEN doc_id % 3 = 0 THEN 'empty' WHEN doc_id % 3 = 1 AND doc_id % 2 = 0 THEN 'blank' ELSE 'full' END AS kind
  FROM documents
),
instruct AS (
  SELECT doc_id AS id, lang AS category, array_to_string(ws[1:12], ' ') AS instruction,
         CASE kind WHEN 'empty' THEN '' WHEN 'blank' THEN ' ' ELSE array_to_string(ws[13:60], ' ') END AS context,
         array_to_string(CASE kind WHEN 'full' THEN ws[61:] ELSE ws[13:] END, ' ') AS response
  FROM instruct_words
)"""

PRED = INSTRUCT + """,
response_words AS (
  SELECT id, list_filter(string_split(response, ' '), lambda x: x <> '') AS ws FROM instruct
),
pred AS (
  SELECT 'base' AS model, id, array_to_string(list_reverse(ws), ' ') AS prediction FROM response_words
  UNION ALL
  SELECT 'drop3', id, array_to_string(list_filter(ws, lambda x, i: i % 3 <> 0), ' ') FROM response_words
  UNION ALL
  SELECT 'half', id, array_to_string(ws[1:ceil(len(ws) / 2.0)::INT], ' ') FROM response_words
),
pairs AS (
  SELECT model, id, prediction, response AS reference FROM pred JOIN instruct USING (id)
)"""

REQUESTS = """
req AS (
  SELECT event_type AS framework, event_id AS request_id, ts, value AS latency_s,
         (props->>'$.k')::INT AS tokens_generated,
         CASE WHEN event_type <> 'signup' THEN (1 + user_id % 12)::DOUBLE END AS memory_used_gb
  FROM events
),
timed AS (
  SELECT *, CASE WHEN latency_s > 0 THEN tokens_generated / latency_s ELSE 0 END AS rate FROM req
)"""

RATINGS = f"""
rating AS (
  SELECT doc_id AS sample_id, s AS system, c AS criterion,
         ((doc_id * 7 + quality * 3 + toxic + k) % 6)::INT AS score
  FROM labels, (VALUES {', '.join(
      f"('{s}', '{c}', {i * 3 + j})" for i, s in enumerate(('a', 'b')) for j, c in enumerate(CRITERIA)
  )}) AS t(s, c, k)
)"""

RUNS = """
runs AS (
  SELECT event_type AS framework, strftime(ts, '%Y%m%d_%H%M%S') AS run_id, event_id AS tie_break,
         user_id % 2 = 0 AS has_merged, user_id % 3 <> 0 AS has_adapter, user_id % 5 <> 0 AS has_stats
  FROM events
)"""

SPLIT_ORDER = "md5('{seed}:' || id::VARCHAR)"

USER_MESSAGE = (
    "CASE WHEN trim(context, ' ' || chr(9) || chr(10) || chr(13)) <> '' "
    "THEN instruction || chr(10) || chr(10) || 'Context: ' || context ELSE instruction END"
)
CHAT_TEXT = (
    f"'<|system|>' || chr(10) || '{SYSTEM_LINE}</s>' || chr(10) || '<|user|>' || chr(10) || {USER_MESSAGE} "
    "|| '</s>' || chr(10) || '<|assistant|>' || chr(10) || response || '</s>'"
)
CHAT_PROMPT = (
    f"'<|system|>' || chr(10) || '{SYSTEM_LINE}</s> ' || chr(10) || '<|user|>' || chr(10) || {USER_MESSAGE} "
    "|| '</s>' || chr(10) || '<|assistant|>' || chr(10)"
)
HEADINGS = (
    "'### Instruction:' || chr(10) || instruction || chr(10) || chr(10) "
    "|| CASE WHEN length(context) > 0 THEN '### Context:' || chr(10) || context || chr(10) || chr(10) ELSE '' END "
    "|| '### Response:' || chr(10)"
)


def splits(train: str, validation: str) -> str:
    """CTE ``splits``; quotas are SQL expressions over the row count ``n``."""
    order = SPLIT_ORDER.format(seed=42)
    return INSTRUCT + f""",
quota AS (SELECT n, {train} AS n_train, {validation} AS n_val FROM (SELECT count(*) AS n FROM instruct)),
ranked AS (SELECT *, row_number() OVER (ORDER BY {order}, id) AS rank FROM instruct),
splits AS (
  SELECT ranked.*, CASE WHEN rank <= n_train THEN 'train' WHEN rank <= n_train + n_val THEN 'validation' ELSE 'test' END AS split
  FROM ranked, quota
)"""


# The default quotas (12000/2000/1000) shrunk to the rows at hand when there are fewer.
DEFAULT_SPLITS = splits(
    "CASE WHEN n < 15000 THEN floor(12000 * (n / 15000.0::DOUBLE))::BIGINT ELSE 12000 END",
    "CASE WHEN n < 15000 THEN floor(2000 * (n / 15000.0::DOUBLE))::BIGINT ELSE 2000 END",
) + ",\nchosen AS (SELECT * FROM splits WHERE rank <= 15000)"

# The same proportions over any number of rows.
WHOLE_SPLITS = splits(
    "floor(12000 * (n / 15000.0::DOUBLE))::BIGINT", "floor(2000 * (n / 15000.0::DOUBLE))::BIGINT"
) + ",\nchosen AS (SELECT * FROM splits)"


def whitespace_tokens(text: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({text}), '{WHITESPACE_RUN}'), lambda x: x <> '')"


def alnum_tokens(text: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({text}), '[^a-z0-9]+'), lambda x: x <> '')"


def grams(tokens, orders: int) -> str:
    """CTEs ``lens`` (token counts) and ``shared`` (clipped matches per order) for ``pairs``."""
    leads = "".join(
        f", lead(token, {k}) OVER (PARTITION BY model, id, side ORDER BY pos) AS t{k}" for k in range(1, orders)
    )
    rows = " UNION ALL ".join(
        "SELECT model, id, side, {n} AS n, {gram} AS gram FROM stream{where}".format(
            n=n,
            gram=" || ' ' || ".join(["token"] + [f"t{k}" for k in range(1, n)]),
            where=f" WHERE t{n - 1} IS NOT NULL" if n > 1 else "",
        )
        for n in range(1, orders + 1)
    )
    return f""",
tokens AS (
  SELECT model, id, {tokens('prediction')} AS p, {tokens('reference')} AS r FROM pairs
),
lens AS (SELECT model, id, len(p) AS pl, len(r) AS rl FROM tokens),
spelled AS (
  SELECT model, id, 'p' AS side, unnest(p) AS token, generate_subscripts(p, 1) AS pos FROM tokens
  UNION ALL
  SELECT model, id, 'r', unnest(r), generate_subscripts(r, 1) FROM tokens
),
stream AS (SELECT *{leads} FROM spelled),
grams AS ({rows}),
both_sides AS (
  SELECT model, id, n, gram, count(*) FILTER (WHERE side = 'p') AS cp, count(*) FILTER (WHERE side = 'r') AS cr
  FROM grams GROUP BY model, id, n, gram
),
shared AS (
  SELECT model, id, {', '.join(f'coalesce(sum(least(cp, cr)) FILTER (WHERE n = {n}), 0) AS m{n}' for n in range(1, orders + 1))}
  FROM both_sides GROUP BY model, id
),
matched AS (
  SELECT lens.*, {', '.join(f'coalesce(m{n}, 0)::DOUBLE AS m{n}' for n in range(1, orders + 1))}
  FROM lens LEFT JOIN shared USING (model, id)
)"""


def bleu(order: int) -> str:
    """Sentence BLEU of one ``matched`` row."""
    terms = " + ".join(
        f"ln(CASE WHEN m{n} > 0 THEN m{n} ELSE 0.1 END / greatest(1, pl - {n - 1})) / {order}" for n in range(1, order + 1)
    )
    brevity = "CASE WHEN pl > rl THEN 1.0 ELSE exp(1 - rl / pl::DOUBLE) END"
    return f"CASE WHEN m1 > 0 THEN {brevity} * exp({terms}) ELSE 0.0 END"


def share(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN {part} / ({whole})::DOUBLE ELSE 0.0 END"


def f1(p: str, r: str) -> str:
    return f"CASE WHEN {p} + {r} > 0 THEN 2 * {p} * {r} / ({p} + {r}) ELSE 0.0 END"


def rouge_n(n: int) -> str:
    p = f"({share(f'm{n}', f'pl - {n - 1}')})"
    r = f"({share(f'm{n}', f'rl - {n - 1}')})"
    return f1(p, r)


BITS = 124
FULL = (1 << BITS) - 1

# Longest common subsequence of the token lists of ``pairs``: rows of the bit-parallel
# recurrence as lists of 124-bit blocks, with the carry handed from block to block.
LCS = f""",
words AS (
  SELECT model, id, {alnum_tokens('prediction')} AS p, {alnum_tokens('reference')} AS r FROM pairs
),
refs AS (SELECT id, any_value(r) AS r FROM words GROUP BY id),
ref_blocks AS (
  SELECT id, token, (pos - 1) // {BITS} AS b, sum(1::HUGEINT << ((pos - 1) % {BITS})::HUGEINT)::HUGEINT AS bits
  FROM (SELECT id, unnest(r) AS token, generate_subscripts(r, 1) AS pos FROM refs) GROUP BY ALL
),
ref_masks AS (
  SELECT id, token, list_transform(range(0, (len(r) + {BITS - 1}) // {BITS}), lambda b: coalesce(found[b], 0::HUGEINT)) AS mask
  FROM (SELECT id, token, map_from_entries(list((b, bits))) AS found FROM ref_blocks GROUP BY id, token)
  JOIN refs USING (id)
),
pred_masks AS (
  SELECT model, id, list(mask ORDER BY pos) AS masks
  FROM (SELECT model, id, unnest(p) AS token, generate_subscripts(p, 1) AS pos FROM words)
  JOIN ref_masks USING (id, token) GROUP BY model, id
),
last_row AS (
  SELECT model, id, list_reduce(masks, lambda v, m: list_reduce(
      list_transform(range(1, len(v) + 1), lambda b: [v[b], m[b]]),
      lambda acc, x: list_concat(
        [(x[1] + (x[1] & x[2]) + acc[1]) >> {BITS}::HUGEINT], acc[2:],
        [((x[1] + (x[1] & x[2]) + acc[1]) & {FULL}::HUGEINT) | (x[1] & ~x[2])]),
      [0::HUGEINT])[2:],
    list_transform(masks[1], lambda x: {FULL}::HUGEINT)) AS v
  FROM pred_masks
),
lcs AS (
  SELECT words.model, words.id, len(p) AS pl, len(r) AS rl,
         coalesce(list_sum(list_transform(v, lambda x: {BITS} - bit_count(x)))::BIGINT, 0) AS lcs
  FROM words LEFT JOIN last_row ON words.model = last_row.model AND words.id = last_row.id
)"""

LCS_P, LCS_R = share("lcs", "pl"), share("lcs", "rl")
LCS_F = f1(f"({LCS_P})", f"({LCS_R})")


def treebank_tokens(text: str) -> str:
    """Word tokens of a lower-cased text, as the published description has them, mark by mark.

    Written out for texts of letters, digits and the marks below; a word that opens with an
    apostrophe keeps it only before a clitic, which needs no look-ahead when each of the
    possible first letters is told apart.
    """
    steps = (
        (r"([«“‘„]|`+)", r" \1 "),
        (r'^"', r" `` "),
        (r"""([ (\[{<])("|'')""", r"\1 `` "),
        # an apostrophe before a single letter that is no clitic of one letter: m, t, s, d, n
        (r"'([a-ce-lo-ru-z0-9_])\b", r"' \1"),
        (r"""([^.])(\.)([\])}>"'»”’ ]*)(\s|$)""", r"\1 \2 \3 \4"),
        (r"([:,])([^0-9]|$)", r" \1 \2"),
        (r"(\.\.+|--|[;@#$%&?!*\[\](){}<>])", r" \1 "),
        (r"([^'])' ", r"\1 ' "),
        (r"$", " "),
        (r"([»”’]|'')", r" \1 "),
        (r'"', r" '' "),
        (r"([^' ])('ll|'re|'ve|n't|'s|'m|'d|') ", r"\1 \2 "),
        (r"\b(can)(not)\b", r" \1 \2 "),
        (r"\b(gim|lem)(me)\b", r" \1 \2 "),
        (r"\b(gon|wan)(na)\b", r" \1 \2 "),
        (r"\b(got)(ta)\b", r" \1 \2 "),
        (r"\b(d)('ye)\b", r" \1 \2 "),
        (r"\b(more)('n)\b", r" \1 \2 "),
        (r" ('t)(is|was)\b", r" \1 \2 "),
    )
    out = f"lower({text})"
    for pattern, replacement in steps:
        quoted = [x.replace("'", "''") for x in (pattern, replacement)]
        out = f"regexp_replace({out}, '{quoted[0]}', '{quoted[1]}', 'g')"
    return f"list_filter(regexp_split_to_array({out}, '{WHITESPACE_RUN}'), lambda x: x <> '')"


def per_model(columns: dict[str, str], source: str) -> str:
    means = ", ".join(f"round(avg({expr}), 6) AS {name}" for name, expr in columns.items())
    return f"SELECT model, count(*) AS num_samples, {means} FROM {source} GROUP BY model"


def pick(key: str, value: str, names=MODELS) -> str:
    return ", ".join(f"max({value}) FILTER (WHERE {key} = '{m}') AS {m}" for m in names)
