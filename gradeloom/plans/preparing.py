"""Queries over the instruction table: templates, splits, samples, statistics, tokens."""

from __future__ import annotations

from pyspark.sql import functions as F

from gradeloom.functions import templates, text
from gradeloom.operators import profile, splits, tokens
from gradeloom.plans import sql as S
from gradeloom.plans import tables
from gradeloom.plans.registry import query
from gradeloom.session import shared_folder
from gradeloom.sources import readers, writers

# -- templates --------------------------------------------------------------------------


@query("format_chat", f"WITH {S.INSTRUCT} SELECT id, {S.CHAT_TEXT} AS text FROM instruct")
def format_chat(spark, sf_dir):
    return templates.apply_template(tables.instructions(spark, sf_dir), "chat").select("id", "text")


@query(
    "format_eval",
    f"WITH {S.INSTRUCT} SELECT id, {S.CHAT_PROMPT} AS prompt, response AS reference, instruction, context, category FROM instruct",
)
def format_eval(spark, sf_dir):
    return templates.evaluation_rows(tables.instructions(spark, sf_dir))


@query("format_headings", f"WITH {S.INSTRUCT} SELECT id, {S.HEADINGS} AS prompt FROM instruct")
def format_headings(spark, sf_dir):
    return templates.apply_template(tables.instructions(spark, sf_dir), "headings", "prompt").select("id", "prompt")


@query(
    "format_question",
    f"""WITH {S.INSTRUCT} SELECT id,
    concat('### Instruction:', chr(10), instruction, chr(10), chr(10), '### Response:') AS prompt FROM instruct""",
)
def format_question(spark, sf_dir):
    return templates.apply_template(tables.instructions(spark, sf_dir), "question", "prompt").select("id", "prompt")


@query(
    "serving_text",
    f"""WITH {S.INSTRUCT} SELECT id,
    CASE WHEN length(context) > 0 THEN concat('<|system|>', chr(10), context, '</s>', chr(10)) ELSE '' END
    || CASE WHEN length(instruction) > 0 THEN concat('<|user|>', chr(10), instruction, '</s>', chr(10)) ELSE '' END
    || concat('<|assistant|>', chr(10), response, '</s>') AS text FROM instruct""",
)
def serving_text(spark, sf_dir):
    df = tables.instructions(spark, sf_dir)
    return df.select("id", templates.serving_text(F.col("context"), F.col("instruction"), F.col("response")).alias("text"))


@query(
    "render_conversations",
    """SELECT conv_id, string_agg(CASE WHEN role IN ('system', 'user', 'assistant')
         THEN concat('<|', role, '|>', chr(10), text, '</s>', chr(10)) ELSE '' END, '' ORDER BY turn) AS text
       FROM conversations GROUP BY conv_id""",
)
def render_conversations(spark, sf_dir):
    return templates.render_conversations(tables.messages(spark, sf_dir))


@query(
    "render_for_generation",
    """SELECT conv_id, string_agg(CASE WHEN role IN ('system', 'user', 'assistant')
         THEN concat('<|', role, '|>', chr(10), text, '</s>', chr(10)) ELSE '' END, '' ORDER BY turn)
         || '<|assistant|>' || chr(10) AS text
       FROM conversations GROUP BY conv_id""",
)
def render_for_generation(spark, sf_dir):
    return templates.render_conversations(tables.messages(spark, sf_dir), add_generation_prompt=True)


@query(
    "strip_prompt",
    f"WITH {S.PRED} SELECT model, id, trim(prediction, ' ' || chr(10)) AS generated FROM pred",
)
def strip_prompt(spark, sf_dir):
    """Generations that echo their prompt, cut back to the answer."""
    instruct = tables.instructions(spark, sf_dir)
    prompts = templates.apply_template(instruct, "headings", "prompt").select("id", "prompt")
    raw = tables.predictions(instruct).join(prompts, "id").withColumn(
        "output", F.concat("prompt", F.lit(" \n"), "prediction", F.lit("\n"))
    )
    return raw.select("model", "id", text.strip_prompt("output", "prompt").alias("generated"))


@query(
    "length_features",
    f"""WITH {S.INSTRUCT} SELECT id, length(instruction) AS instruction_len, length(context) AS context_len,
    length(response) AS response_len, length(context) > 0 AS has_context FROM instruct""",
)
def length_features(spark, sf_dir):
    return profile.with_lengths(tables.instructions(spark, sf_dir)).select(
        "id", *profile.LENGTHS, "has_context"
    )


# -- order, splits, samples -------------------------------------------------------------

_SHUFFLED = S.SPLIT_ORDER.format(seed=42)


@query(
    "seeded_shuffle",
    f"WITH {S.INSTRUCT} SELECT id, row_number() OVER (ORDER BY {_SHUFFLED}, id) AS rank FROM instruct",
)
def seeded_shuffle(spark, sf_dir):
    return splits.seeded_shuffle(tables.instructions(spark, sf_dir).select("id"))


@query("split_exact", f"WITH {S.DEFAULT_SPLITS} SELECT id, split FROM chosen")
def split_exact(spark, sf_dir):
    return splits.create_splits(tables.instructions(spark, sf_dir).select("id"))


_HALF = S.splits(
    "floor(12000 * ((n // 2) / 15000.0::DOUBLE))::BIGINT", "floor(2000 * ((n // 2) / 15000.0::DOUBLE))::BIGINT"
)


@query("split_max_samples", f"WITH {_HALF} SELECT id, split FROM splits, quota WHERE rank <= quota.n // 2")
def split_max_samples(spark, sf_dir):
    """Down-sampling to half of the table, quotas in the same proportion."""
    df = tables.instructions(spark, sf_dir).select("id")
    return splits.create_splits(df, max_samples=df.count() // 2)


@query(
    "select_range",
    f"""WITH {S.INSTRUCT}, ranked AS (SELECT id, row_number() OVER (ORDER BY {_SHUFFLED}, id) AS rank FROM instruct)
    SELECT id, rank FROM ranked WHERE rank > (SELECT count(*) FROM instruct) // 4 AND rank <= (SELECT count(*) FROM instruct) // 2""",
)
def select_range(spark, sf_dir):
    df = tables.instructions(spark, sf_dir).select("id")
    n = df.count()
    return splits.select_range(splits.seeded_shuffle(df), n // 4, n // 2)


_TAIL = "SELECT * FROM (SELECT * FROM instruct ORDER BY id DESC LIMIT 1000)"


@query(
    "tail_holdout",
    f"WITH {S.INSTRUCT} SELECT id, {S.HEADINGS} AS prompt, response AS reference FROM ({_TAIL}) ORDER BY id LIMIT 100",
)
def tail_holdout(spark, sf_dir):
    held = splits.tail_holdout(tables.instructions(spark, sf_dir), 100)
    return templates.evaluation_rows(held, "headings").select("id", "prompt", "reference")


@query(
    "human_sample",
    f"""WITH {S.INSTRUCT}, tail AS ({_TAIL})
    SELECT row_number() OVER (ORDER BY {_SHUFFLED}, id) AS sample_no, id, {S.HEADINGS} AS prompt, response AS reference
    FROM tail ORDER BY {_SHUFFLED}, id LIMIT 5""",
)
def human_sample(spark, sf_dir):
    tail = splits.tail_holdout(tables.instructions(spark, sf_dir), splits.HOLDOUT)
    sample = splits.number_sample(splits.seeded_sample(tail, 5))
    return templates.apply_template(sample, "headings", "prompt").select(
        "sample_no", "id", "prompt", F.col("response").alias("reference")
    )


@query(
    "token_sample",
    f"""WITH {S.INSTRUCT} SELECT id, len({S.whitespace_tokens("instruction || ' ' || context || ' ' || response")}) + 1 AS total_tokens
    FROM instruct ORDER BY {_SHUFFLED}, id LIMIT 1000""",
)
def token_sample(spark, sf_dir):
    sample = splits.seeded_sample(tables.instructions(spark, sf_dir), 1000)
    return tokens.with_token_count(sample).select("id", "total_tokens")


@query(
    "category_examples",
    f"""WITH {S.INSTRUCT}, firsts AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY id) AS n FROM instruct)
    SELECT id, category, instruction[1:200] AS instruction, response[1:200] AS response
    FROM firsts WHERE n = 1 ORDER BY id LIMIT 3""",
)
def category_examples(spark, sf_dir):
    firsts = splits.first_per_category(tables.instructions(spark, sf_dir))
    return firsts.select(
        "id", "category", text.preview("instruction").alias("instruction"), text.preview("response").alias("response")
    )


@query("distinct_categories", f"WITH {S.INSTRUCT} SELECT DISTINCT category FROM instruct")
def distinct_categories(spark, sf_dir):
    return tables.instructions(spark, sf_dir).select("category").distinct()


@query(
    "cycle_prompts",
    f"""WITH {S.INSTRUCT},
    ranked AS (SELECT id, {S.CHAT_PROMPT} AS prompt, row_number() OVER (ORDER BY {_SHUFFLED}, id) - 1 AS place FROM instruct),
    size AS (SELECT count(*) AS m FROM instruct),
    positions AS (SELECT unnest(range(m * 5 // 2)) AS position FROM size)
    SELECT position, id, prompt FROM positions JOIN ranked ON place = position % (SELECT m FROM size)""",
)
def cycle_prompts(spark, sf_dir):
    """The shuffled prompt list repeated to two and a half times its length."""
    df = tables.instructions(spark, sf_dir)
    size = df.count()
    ranked = splits.seeded_shuffle(templates.evaluation_rows(df).select("id", "prompt"))
    return splits.cycle_to(ranked, size, size * 5 // 2).select("position", "id", "prompt")


@query(
    "prompt_trials",
    f"WITH {S.INSTRUCT} SELECT id, trial, {S.CHAT_PROMPT} AS prompt FROM instruct, range(1, 4) AS t(trial)",
)
def prompt_trials(spark, sf_dir):
    prompts = templates.evaluation_rows(tables.instructions(spark, sf_dir)).select("id", "prompt")
    return splits.repeat_trials(prompts, 3)


# -- statistics -------------------------------------------------------------------------


def _formatted_splits(spark, sf_dir):
    return templates.apply_template(splits.create_splits(tables.instructions(spark, sf_dir), shares=True), "chat")


@query(
    "dataset_stats",
    f"""WITH {S.WHOLE_SPLITS}, texts AS (SELECT split, category, {S.CHAT_TEXT} AS text FROM chosen)
    SELECT split, count(*) AS num_samples, count(DISTINCT category) AS num_categories,
    round(avg(length(text)), 6) AS avg_text_length, max(length(text)) AS max_text_length,
    min(length(text)) AS min_text_length FROM texts GROUP BY split""",
)
def dataset_stats(spark, sf_dir):
    return profile.dataset_stats(_formatted_splits(spark, sf_dir))


@query(
    "category_counts",
    f"WITH {S.WHOLE_SPLITS} SELECT split, category, count(*) AS n FROM chosen GROUP BY split, category",
)
def category_counts(spark, sf_dir):
    return profile.category_counts(splits.create_splits(tables.instructions(spark, sf_dir).select("id", "category"), shares=True))


@query(
    "category_maps",
    f"""WITH {S.WHOLE_SPLITS}, counts AS (SELECT split, category, count(*) AS n FROM chosen GROUP BY split, category)
    SELECT split, '{{' || string_agg('"' || category || '":' || n, ',' ORDER BY category) || '}}' AS categories FROM counts GROUP BY split""",
)
def category_maps(spark, sf_dir):
    """The category counts of each split as one map, written as JSON."""
    made = splits.create_splits(tables.instructions(spark, sf_dir).select("id", "category"), shares=True)
    return profile.category_map(made).withColumn("categories", F.to_json("categories"))


_LENGTHS = S.INSTRUCT + """,
sizes AS (
  SELECT 'instruction_len' AS metric, length(instruction) AS value FROM instruct
  UNION ALL SELECT 'context_len', length(context) FROM instruct
  UNION ALL SELECT 'response_len', length(response) FROM instruct
)"""


@query(
    "length_describe",
    f"""WITH {_LENGTHS} SELECT metric, count(*) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
    min(value)::DOUBLE AS min, max(value)::DOUBLE AS max, round(quantile_cont(value::DOUBLE, 0.25), 6) AS p25,
    round(quantile_cont(value::DOUBLE, 0.5), 6) AS p50, round(quantile_cont(value::DOUBLE, 0.75), 6) AS p75
    FROM sizes GROUP BY metric""",
)
def length_describe(spark, sf_dir):
    return profile.describe(profile.with_lengths(tables.instructions(spark, sf_dir)), profile.LENGTHS)


@query(
    "context_share",
    f"""WITH {S.INSTRUCT} SELECT length(context) > 0 AS has_context, count(*) AS n,
    round(count(*) / (SELECT count(*) FROM instruct)::DOUBLE, 6) AS share FROM instruct GROUP BY 1""",
)
def context_share(spark, sf_dir):
    return profile.value_share(profile.with_lengths(tables.instructions(spark, sf_dir)), "has_context")


@query(
    "category_share",
    f"""WITH {S.INSTRUCT} SELECT category, count(*) AS n,
    round(count(*) / (SELECT count(*) FROM instruct)::DOUBLE, 6) AS share FROM instruct GROUP BY 1""",
)
def category_share(spark, sf_dir):
    return profile.value_share(tables.instructions(spark, sf_dir), "category")


@query(
    "length_histogram",
    f"""WITH {_LENGTHS}, spans AS (SELECT metric, min(value) AS low, max(value) - min(value) AS span FROM sizes GROUP BY metric)
    SELECT metric, bin, round(any_value(low) + bin * any_value(span)::DOUBLE / 50, 6) AS bin_start, count(*) AS n
    FROM (SELECT metric, low, span, least(floor((value - low) / span::DOUBLE * 50), 49)::BIGINT AS bin FROM sizes JOIN spans USING (metric))
    GROUP BY metric, bin""",
)
def length_histogram(spark, sf_dir):
    return profile.histogram(profile.with_lengths(tables.instructions(spark, sf_dir)), profile.LENGTHS)


# -- tokens -----------------------------------------------------------------------------

_JOINED = "instruction || ' ' || context || ' ' || response"
_TOTAL_TOKENS = f"len({S.whitespace_tokens(_JOINED)}) + 1"


@query("token_counts", f"WITH {S.INSTRUCT} SELECT id, {_TOTAL_TOKENS} AS total_tokens FROM instruct")
def token_counts(spark, sf_dir):
    return tokens.with_token_count(tables.instructions(spark, sf_dir)).select("id", "total_tokens")


@query(
    "truncation_report",
    f"""WITH {S.INSTRUCT} SELECT count(*) AS num_samples, count(*) FILTER (WHERE n > 2048) AS over_limit,
    round(count(*) FILTER (WHERE n > 2048) * 100.0::DOUBLE / count(*), 6) AS over_percent
    FROM (SELECT {_TOTAL_TOKENS} AS n FROM instruct)""",
)
def truncation_report(spark, sf_dir):
    return profile.over_length(tokens.with_token_count(tables.instructions(spark, sf_dir)), "total_tokens")


@query(
    "token_estimate",
    f"""WITH {S.INSTRUCT} SELECT id, greatest(1, least(length(response) // 4, 256)) AS estimated,
    len({S.whitespace_tokens('response')}) AS words FROM instruct""",
)
def token_estimate(spark, sf_dir):
    response = F.col("response")
    return tables.instructions(spark, sf_dir).select(
        "id", tokens.estimated_tokens(response, 256).alias("estimated"), tokens.word_count(response).alias("words")
    )


@query(
    "steps_per_epoch",
    f"WITH {S.WHOLE_SPLITS} SELECT split, count(*) AS n, ceil(count(*) / 16.0)::BIGINT AS steps FROM chosen GROUP BY split",
)
def steps_per_epoch(spark, sf_dir):
    counts = splits.create_splits(tables.instructions(spark, sf_dir).select("id"), shares=True).groupBy("split").agg(
        F.count(F.lit(1)).alias("n")
    )
    return counts.withColumn("steps", tokens.steps_per_epoch(F.col("n")))


def _vocabulary(size: int) -> str:
    return S.INSTRUCT + f""",
formatted AS (SELECT id, {S.whitespace_tokens(S.CHAT_TEXT)} AS words FROM instruct),
counted AS (SELECT token, count(*) AS n FROM (SELECT unnest(words) AS token FROM formatted) GROUP BY token),
vocab AS (
  SELECT token, n, row_number() OVER (ORDER BY n DESC, token) + 2 AS token_id
  FROM counted ORDER BY n DESC, token LIMIT {size}
)"""

_ENCODED = _vocabulary(32000) + """,
spelled AS (SELECT id, unnest(words) AS token, generate_subscripts(words, 1) AS pos FROM formatted),
encoded AS (
  SELECT id, list_concat([1::BIGINT], list(coalesce(token_id, 0) ORDER BY pos)) AS ids
  FROM spelled LEFT JOIN vocab USING (token) GROUP BY id
)"""


@query("build_vocab", f"WITH {_vocabulary(tokens.VOCABULARY_LIMIT)} SELECT token, n, token_id FROM vocab")
def build_vocab(spark, sf_dir):
    return tokens.build_vocabulary(templates.apply_template(tables.instructions(spark, sf_dir), "chat"))


def _encoded(spark, sf_dir, max_length=None):
    """Encoded training texts over a vocabulary smaller than the table's own."""
    formatted = templates.apply_template(tables.instructions(spark, sf_dir), "chat").select("id", "text")
    return tokens.encode(formatted, tokens.build_vocabulary(formatted), max_length=max_length)


def _joined(*columns):
    return [F.array_join(F.col(c).cast("array<string>"), " ").alias(c) for c in columns]


@query(
    "encode",
    f"""WITH {_ENCODED} SELECT id, array_to_string(ids, ' ') AS input_ids,
    array_to_string(list_transform(ids, lambda x: 1), ' ') AS attention_mask, array_to_string(ids, ' ') AS labels FROM encoded""",
)
def encode(spark, sf_dir):
    return _encoded(spark, sf_dir).select("id", *_joined("input_ids", "attention_mask", "labels"))


@query(
    "encode_max_length",
    f"WITH {_ENCODED} SELECT id, len(ids[1:1024]) AS num_tokens, array_to_string(ids[1:1024], ' ') AS input_ids FROM encoded",
)
def encode_max_length(spark, sf_dir):
    """Encoding with the tokenizer's own length limit, which is the feature here."""
    return _encoded(spark, sf_dir, 1024).select("id", F.size("input_ids").alias("num_tokens"), *_joined("input_ids"))


_BATCHES = _ENCODED + f""",
placed AS (SELECT id, ids, (row_number() OVER (ORDER BY {S.SPLIT_ORDER.format(seed=7)}, id) - 1) // 16 AS batch_id FROM encoded),
batched AS (SELECT *, (ceil(max(len(ids)) OVER (PARTITION BY batch_id) / 8.0) * 8)::BIGINT AS padded_length FROM placed)"""


@query(
    "padded_batches",
    f"""WITH {_BATCHES} SELECT batch_id, id, padded_length, len(ids) AS num_tokens,
    array_to_string(list_concat(ids, list_transform(range(padded_length - len(ids)), lambda x: 2::BIGINT)), ' ') AS input_ids,
    array_to_string(list_concat(list_transform(ids, lambda x: 1), list_transform(range(padded_length - len(ids)), lambda x: 0)), ' ') AS attention_mask,
    array_to_string(list_concat(ids, list_transform(range(padded_length - len(ids)), lambda x: -100::BIGINT)), ' ') AS labels
    FROM batched""",
)
def padded_batches(spark, sf_dir):
    return tokens.padded_batches(_encoded(spark, sf_dir), 16, 7).select(
        "batch_id", "id", "padded_length", "num_tokens", *_joined("input_ids", "attention_mask", "labels")
    )


@query(
    "padding_waste",
    f"""WITH {_BATCHES} SELECT count(DISTINCT batch_id) AS num_batches, sum(padded_length)::BIGINT AS positions,
    sum(len(ids))::BIGINT AS tokens, round(1 - sum(len(ids)) / sum(padded_length)::DOUBLE, 6) AS waste FROM batched""",
)
def padding_waste(spark, sf_dir):
    return tokens.padding_waste(tokens.padded_batches(_encoded(spark, sf_dir), 16, 7))


# -- written tables ---------------------------------------------------------------------


@query("saved_split", f"WITH {S.WHOLE_SPLITS} SELECT id, category, {S.CHAT_TEXT} AS text FROM chosen WHERE split = 'train'")
def saved_split(spark, sf_dir):
    """The training split, read back from the saved split table."""
    root = shared_folder(spark, "splits")
    writers.save_splits(_formatted_splits(spark, sf_dir), root)
    return readers.read_splits(spark, root, "train").select("id", "category", "text")


@query(
    "saved_eval_set",
    f"""WITH {S.WHOLE_SPLITS} SELECT id, {S.CHAT_PROMPT} AS prompt, response AS reference, instruction, context, category
    FROM chosen WHERE split = 'test'""",
)
def saved_eval_set(spark, sf_dir):
    """The evaluation rows of the test split, read back from JSON lines."""
    path = shared_folder(spark, "eval-set")
    test = splits.create_splits(tables.instructions(spark, sf_dir), shares=True).where("split = 'test'").drop("split")
    writers.save_eval_set(templates.evaluation_rows(test), path)
    return readers.read_eval_set(spark, path)


# Text bytes of one of the files of an evaluation set.
EVAL_FILE_BYTES = 32 << 20


def _eval_files(spark, sf_dir):
    """Evaluation rows without an id, as JSON lines over as many files as their size asks for, in the order of their ids."""
    path = shared_folder(spark, "eval-set")
    rows = templates.evaluation_rows(tables.instructions(spark, sf_dir))
    total = tables.table(spark, sf_dir, "documents").agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    ordered = rows.repartitionByRange(max(4, -(-total // EVAL_FILE_BYTES)), "id").sortWithinPartitions("id")
    writers.save_eval_set(ordered.select(*[c for c in rows.columns if c != "id"]), path)
    return path


@query(
    "eval_set_without_id",
    f"""WITH {S.INSTRUCT} SELECT row_number() OVER (ORDER BY id) - 1 AS id, {S.CHAT_PROMPT} AS prompt, response AS reference,
    instruction, context, category FROM instruct""",
)
def eval_set_without_id(spark, sf_dir):
    """Evaluation rows read from files without ids: a row's id is its place."""
    return readers.read_eval_set(spark, _eval_files(spark, sf_dir))


@query(
    "first_prompts",
    f"""WITH {S.INSTRUCT} SELECT row_number() OVER (ORDER BY id) - 1 AS id, {S.CHAT_PROMPT} AS prompt
    FROM instruct ORDER BY instruct.id LIMIT 25""",
)
def first_prompts(spark, sf_dir):
    """The first prompts of an evaluation set, in the order of its lines."""
    return readers.read_prompts(spark, _eval_files(spark, sf_dir), 25)


@query("stored_instructions", f"WITH {S.INSTRUCT} SELECT id, instruction, context, length(response) AS response_len, category FROM instruct")
def stored_instructions(spark, sf_dir):
    """The instruction table written as JSON lines and read back by its schema."""
    path = shared_folder(spark, "instructions")
    writers.save_records(tables.instructions(spark, sf_dir), path)
    found = readers.read_instructions(spark, path, "json")
    return found.select("id", "instruction", "context", F.length("response").alias("response_len"), "category")


@query("category_slugs", f"WITH {S.INSTRUCT} SELECT DISTINCT category, 'brief_answer_in_' || category AS slug FROM instruct")
def category_slugs(spark, sf_dir):
    categories = tables.instructions(spark, sf_dir).select("category").distinct()
    return categories.withColumn("slug", text.slug(F.concat(F.lit("Brief Answer in "), F.upper("category"))))
