"""Queries over predictions: pairing, BLEU, ROUGE, BERTScore, comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F

from gradeloom.functions import templates
from gradeloom.operators import compare, generate, matching, quality, ratings
from gradeloom.plans import sql as S
from gradeloom.plans import stems, tables, workflows
from gradeloom.plans.registry import query
from gradeloom.session import shared_folder
from gradeloom.sources import readers, versions, writers
from gradeloom.streaming import jobs


def pairs(spark, sf_dir, tokenizer=None, by_id=False):
    instruct = tables.instructions(spark, sf_dir, by_id)
    return quality.pair_predictions(tables.predictions(instruct), instruct, tokenizer)


@query("pair_predictions", f"WITH {S.PRED} SELECT model, id, prediction, reference FROM pairs")
def pair_predictions(spark, sf_dir):
    return pairs(spark, sf_dir)


@query(
    "sample_results",
    f"""WITH {S.PRED} SELECT model, id, instruction, context, response AS reference, prediction, category
    FROM pred JOIN instruct USING (id)""",
)
def sample_results(spark, sf_dir):
    instruct = tables.instructions(spark, sf_dir)
    return quality.attach_predictions(instruct, tables.predictions(instruct))


@query(
    "side_by_side",
    f"""WITH {S.PRED} SELECT instruct.id, instruction, response AS reference,
    max(prediction) FILTER (WHERE model = 'drop3') AS generated_drop3, max(prediction) FILTER (WHERE model = 'half') AS generated_half
    FROM instruct LEFT JOIN pred ON pred.id = instruct.id GROUP BY instruct.id, instruction, response""",
)
def side_by_side(spark, sf_dir):
    instruct = tables.instructions(spark, sf_dir)
    references = instruct.select("id", "instruction", F.col("response").alias("reference"))
    return compare.side_by_side(references, tables.predictions(instruct), ("drop3", "half"))


@query(
    "sample_previews",
    f"""WITH {S.PRED} SELECT id, ({S.HEADINGS})[1:200] AS prompt, response[1:200] AS reference, prediction[1:200] AS generated
    FROM instruct JOIN pred USING (id) WHERE model = 'half' ORDER BY id LIMIT 10""",
)
def sample_previews(spark, sf_dir):
    instruct = tables.instructions(spark, sf_dir)
    prompts = templates.evaluation_rows(instruct, "headings").select("id", "prompt", "reference")
    answers = tables.predictions(instruct).where("model = 'half'").select("id", F.col("prediction").alias("generated"))
    return writers.sample_previews(prompts.join(answers, "id"))


_WS4 = S.PRED + S.grams(S.whitespace_tokens, 4)
_ROUGE2 = S.PRED + S.grams(S.alnum_tokens, 2)
_BLEU = {f"bleu_{n}": S.bleu(n) for n in range(1, 5)}
_BLEU100 = {name: f"100 * ({expr})" for name, expr in _BLEU.items()}


@query("bleu_by_model", f"WITH {_WS4} {S.per_model(_BLEU100, 'matched')}")
def bleu_by_model(spark, sf_dir):
    return quality.scorecard(quality.score_pairs(pairs(spark, sf_dir), ["bleu"], bleu_scale=100.0))


@query(
    "bleu_word_tokens", f"WITH {S.PRED + S.grams(S.treebank_tokens, 4)} {S.per_model(_BLEU100, 'matched')}"
)
def bleu_word_tokens(spark, sf_dir):
    return quality.scorecard(
        quality.score_pairs(pairs(spark, sf_dir, "treebank"), ["bleu"], tokenizer="treebank", bleu_scale=100.0)
    )


@query(
    "pair_scores",
    f"WITH {_WS4} SELECT model, id, round({S.bleu(1)}, 6) AS bleu_1, round({S.bleu(4)}, 6) AS bleu_4 FROM matched",
)
def pair_scores(spark, sf_dir):
    return quality.score_pairs(pairs(spark, sf_dir), ["bleu_1", "bleu_4"]).drop("prediction", "reference")


_ROUGE_N = {"rouge_1": S.rouge_n(1), "rouge_2": S.rouge_n(2)}


@query("rouge_n_by_model", f"WITH {_ROUGE2} {S.per_model(_ROUGE_N, 'matched')}")
def rouge_n_by_model(spark, sf_dir):
    return quality.scorecard(quality.score_pairs(pairs(spark, sf_dir), ["rouge_1", "rouge_2"], stem=False))


_ROUGE_L = {"rouge_l": S.LCS_F, "rouge_l_precision": S.LCS_P, "rouge_l_recall": S.LCS_R}


@query("rouge_l_by_model", f"WITH {S.PRED + S.LCS} {S.per_model(_ROUGE_L, 'lcs')}")
def rouge_l_by_model(spark, sf_dir):
    return quality.scorecard(quality.score_pairs(pairs(spark, sf_dir), ["rouge_l"], stem=False))


_ROUGE_GRAMS = (
    S.grams(S.alnum_tokens, 2)
    .replace("tokens AS", "r_tokens AS").replace("FROM tokens", "FROM r_tokens")
    .replace("lens", "r_lens").replace("spelled", "r_spelled").replace("stream", "r_stream")
    .replace("\ngrams AS", "\nr_grams AS").replace("FROM grams", "FROM r_grams")
    .replace("both_sides", "r_both_sides").replace("shared", "r_shared").replace("matched AS", "r_matched AS")
)


_STEMMED = S.PRED.replace("pairs AS (", "raw_pairs AS (") + stems.stemmed(S.alnum_tokens, "raw_pairs")


@query(
    "rouge_stemmed",
    f"""WITH {_STEMMED}{_ROUGE_GRAMS}{S.LCS},
    rouge_part AS ({S.per_model(_ROUGE_N, 'r_matched')}), lcs_part AS ({S.per_model(_ROUGE_L, 'lcs')})
    SELECT rouge_part.*, rouge_l, rouge_l_precision, rouge_l_recall FROM rouge_part JOIN lcs_part USING (model)""",
)
def rouge_stemmed(spark, sf_dir):
    return quality.scorecard(quality.score_pairs(pairs(spark, sf_dir), ["rouge"], stem=True))


@query(
    "word_stems",
    f"WITH {_STEMMED} SELECT word, w AS stem FROM stems",
)
def word_stems(spark, sf_dir):
    """The stem of every distinct ROUGE word of predictions and references."""
    return quality.word_stems(pairs(spark, sf_dir), ("prediction", "reference"))


@query(
    "quality_scorecard",
    f"""WITH {_WS4}{_ROUGE_GRAMS}{S.LCS},
    bleu_part AS ({S.per_model(_BLEU, 'matched')}), rouge_part AS ({S.per_model(_ROUGE_N, 'r_matched')}),
    lcs_part AS ({S.per_model(_ROUGE_L, 'lcs')})
    SELECT bleu_part.*, rouge_1, rouge_2, rouge_l, rouge_l_precision, rouge_l_recall
    FROM bleu_part JOIN rouge_part USING (model) JOIN lcs_part USING (model)""",
)
def quality_scorecard(spark, sf_dir):
    return quality.scorecard(quality.score_pairs(pairs(spark, sf_dir), stem=False))


_VECTORS = S.PRED + f""",
tokens AS (SELECT model, id, {S.whitespace_tokens('prediction')} AS p, {S.whitespace_tokens('reference')} AS r FROM pairs),
units AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE / sqrt(list_sum(list_transform(embedding, lambda y: y::DOUBLE * y::DOUBLE)))) AS u FROM embeddings),
cosine AS (SELECT a.vec_id AS va, b.vec_id AS vb, list_dot_product(a.u, b.u) AS c FROM units a, units b),
spelled AS (
  SELECT model, id, 'p' AS side, unnest(p) AS token FROM tokens UNION ALL SELECT model, id, 'r', unnest(r) FROM tokens
),
hashed AS (
  SELECT model, id, side, ('0x' || substr(md5(token), 1, 6))::BIGINT % (SELECT count(*) FROM embeddings) AS v, count(*) AS n
  FROM spelled GROUP BY ALL
),
p_side AS (SELECT * FROM hashed WHERE side = 'p'), r_side AS (SELECT * FROM hashed WHERE side = 'r'),
alike AS (
  SELECT model, id, p_side.v AS pv, r_side.v AS rv, p_side.n AS pn, r_side.n AS rn, c
  FROM p_side JOIN r_side USING (model, id) JOIN cosine ON va = p_side.v AND vb = r_side.v
),
best_p AS (SELECT model, id, sum(n * c) / sum(n) AS precision FROM (SELECT model, id, pv, any_value(pn) AS n, max(c) AS c FROM alike GROUP BY model, id, pv) GROUP BY model, id),
best_r AS (SELECT model, id, sum(n * c) / sum(n) AS recall FROM (SELECT model, id, rv, any_value(rn) AS n, max(c) AS c FROM alike GROUP BY model, id, rv) GROUP BY model, id),
bert AS (
  SELECT model, id, coalesce(precision, 0) AS p, coalesce(recall, 0) AS r
  FROM pairs LEFT JOIN best_p USING (model, id) LEFT JOIN best_r USING (model, id)
)"""


@query(
    "bertscore_greedy",
    f"""WITH {_VECTORS} {S.per_model({
        'bertscore_precision': 'p', 'bertscore_recall': 'r',
        'bertscore_f1': S.f1('p', 'r')}, 'bert')}""",
)
def bertscore_greedy(spark, sf_dir):
    vectors = tables.token_vectors(spark, sf_dir, tables.instructions(spark, sf_dir))
    return quality.scorecard(matching.match_tokens(pairs(spark, sf_dir, by_id=True), vectors, kept=("model", "id")))


_BERT = _VECTORS.removeprefix(S.PRED).replace("tokens AS (", "b_tokens AS (").replace("FROM tokens", "FROM b_tokens").replace("spelled", "b_spelled")


@query(
    "rescored_version",
    f"""WITH {_WS4}{_ROUGE_GRAMS}{_BERT},
    bleu_part AS ({S.per_model(_BLEU, 'matched')}), rouge_part AS ({S.per_model(_ROUGE_N, 'r_matched')}),
    bert_part AS ({S.per_model({'bertscore_precision': 'p', 'bertscore_recall': 'r', 'bertscore_f1': S.f1('p', 'r')}, 'bert')})
    SELECT bleu_part.*, rouge_1, rouge_2, bertscore_precision, bertscore_recall, bertscore_f1
    FROM bleu_part JOIN rouge_part USING (model) JOIN bert_part USING (model)""",
)
def rescored_version(spark, sf_dir):
    """Stored samples scored again: the last version holds the first one's BLEU with ROUGE and BERTScore put in."""
    root, path = shared_folder(spark, "scores"), shared_folder(spark, "samples")
    writers.save_records(pairs(spark, sf_dir, by_id=True), path, **writers.SMALL_FILES)
    vectors = tables.token_vectors(spark, sf_dir, tables.instructions(spark, sf_dir))
    stored = spark.read.schema("model STRING, id BIGINT, prediction STRING, reference STRING").json(path)
    workflows.rescore(stored, root, metrics=["bleu"])
    workflows.rescore(stored, root, vectors, ["rouge_1", "rouge_2"], stem=False)
    return quality.scorecard(versions.read_version(spark, root))


# -- comparisons ------------------------------------------------------------------------

_METRICS = ("bleu_1", "bleu_4", "rouge_1", "rouge_2")
_WIDE = f"""{_WS4}{_ROUGE_GRAMS},
wide AS (
  SELECT * FROM ({S.per_model({k: f'100 * ({_BLEU[k]})' for k in ('bleu_1', 'bleu_4')}, 'matched')})
  JOIN (SELECT model, rouge_1, rouge_2 FROM ({S.per_model(_ROUGE_N, 'r_matched')})) USING (model)
),
long AS (UNPIVOT (SELECT model, {', '.join(_METRICS)} FROM wide) ON {', '.join(_METRICS)} INTO NAME metric VALUE value)"""


def _wide(spark, sf_dir):
    scored = quality.score_pairs(pairs(spark, sf_dir), _METRICS, stem=False, bleu_scale=100.0)
    card = quality.scorecard(scored)
    return card.select("model", *[F.round(c, 6).alias(c) for c in _METRICS])


@query("comparison_matrix", f"WITH {_WIDE} SELECT metric, {S.pick('model', 'value')} FROM long GROUP BY metric")
def comparison_matrix(spark, sf_dir):
    return compare.comparison_matrix(_wide(spark, sf_dir), tables.MODELS, _METRICS)


@query(
    "best_per_metric",
    f"""WITH {_WIDE} SELECT metric, model, value FROM
    (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY value DESC, model) AS n FROM long) WHERE n = 1""",
)
def best_per_metric(spark, sf_dir):
    long = compare.unpivot(_wide(spark, sf_dir), "model", _METRICS)
    return compare.best_per_metric(long, order=tables.MODELS)


@query(
    "before_after",
    f"""WITH {_WIDE}, base AS (SELECT metric, value AS baseline FROM long WHERE model = 'base')
    SELECT model, metric, baseline, value, round(value - baseline, 6) AS delta,
    CASE WHEN value > baseline AND baseline <> 0 THEN round((value - baseline) / baseline * 100, 6) END AS improvement_percent
    FROM long JOIN base USING (metric) WHERE model <> 'base'""",
)
def before_after(spark, sf_dir):
    return compare.before_after(_wide(spark, sf_dir), "base", _METRICS)


@query(
    "metric_upsert",
    f"""WITH {_WS4},
    old AS (SELECT model, id, {S.bleu(1)} AS bleu_1 FROM matched WHERE model IN ('base', 'drop3')),
    new AS (SELECT model, id, 100 * ({S.bleu(1)}) AS bleu_1, 100 * ({S.bleu(4)}) AS bleu_4 FROM matched WHERE model IN ('drop3', 'half'))
    SELECT model, id, round(coalesce(new.bleu_1, old.bleu_1), 6) AS bleu_1, round(new.bleu_4, 6) AS bleu_4
    FROM old FULL JOIN new USING (model, id)""",
)
def metric_upsert(spark, sf_dir):
    """Stored scores of two models updated by a later scoring of one of them and a third."""
    found = pairs(spark, sf_dir)
    old = quality.score_pairs(found.where("model IN ('base', 'drop3')"), ["bleu_1"])
    new = quality.score_pairs(found.where("model IN ('drop3', 'half')"), ["bleu_1", "bleu_4"], bleu_scale=100.0)
    drop = ("prediction", "reference")
    return compare.upsert_metrics(old.drop(*drop), new.drop(*drop), ["model", "id"])


@query(
    "rescored_samples",
    f"WITH {_WS4} {S.per_model({'bleu_4': _BLEU['bleu_4']}, 'matched')}",
)
def rescored_samples(spark, sf_dir):
    """Samples saved as JSON lines, read back and scored again."""
    path = shared_folder(spark, "samples")
    writers.save_records(pairs(spark, sf_dir), path)
    stored = spark.read.schema("model STRING, id BIGINT, prediction STRING, reference STRING").json(path)
    return quality.scorecard(quality.score_pairs(stored, ["bleu_4"]))


@query(
    "scorable_models",
    f"""WITH {_WS4} SELECT model AS name, count(*)::INT AS num_samples, round(avg({S.bleu(4)}), 6) AS bleu FROM matched
    WHERE model = 'drop3' GROUP BY model""",
)
def scorable_models(spark, sf_dir):
    """Evaluation results of the models whose samples are stored too."""
    folder, found = shared_folder(spark, "evaluations"), pairs(spark, sf_dir)
    card = quality.scorecard(quality.score_pairs(found, ["bleu_4"]))
    for model in ("base", "drop3"):
        writers.save_records(writers.evaluation_record(card.where(F.col("model") == model)), f"{folder}/{model}_eval.json", one_per_file=True)
    for model in ("drop3", "half"):
        writers.save_records(found.where(F.col("model") == model).drop("model"), f"{folder}/{model}_samples.json")
    evals = readers.evaluation_rows(readers.collect_results(spark, folder, "eval"))
    samples = readers.read_samples(spark, f"{folder}/*_samples.json", "lines")
    return readers.scorable_models(evals, samples).select("name", "num_samples", "bleu")


@query(
    "stored_samples",
    f"""WITH {S.PRED} SELECT 'half' AS source, id, instruction, context, response AS reference, prediction AS generated, category
    FROM pred JOIN instruct USING (id) WHERE model = 'half'""",
)
def stored_samples(spark, sf_dir):
    """Full sample records of a model, written and read back."""
    instruct, folder = tables.instructions(spark, sf_dir), shared_folder(spark, "sample-records")
    records = quality.attach_predictions(instruct, tables.predictions(instruct).where("model = 'half'")).drop("model")
    writers.save_records(records, f"{folder}/half_samples.json")
    return readers.read_samples(spark, f"{folder}/*_samples.json", "lines").drop("prompt")


@query(
    "sql_scores",
    f"""WITH {_WS4}{S.LCS}, bleu_part AS ({S.per_model({'bleu': S.bleu(4)}, 'matched')}), lcs_part AS ({S.per_model({'rouge_l': S.LCS_F}, 'lcs')})
    SELECT model, bleu, rouge_l FROM bleu_part JOIN lcs_part USING (model)""",
)
def sql_scores(spark, sf_dir):
    """The scores by their functions in SQL text."""
    quality.register_sql_functions(spark)
    return spark.sql(
        "SELECT model, avg(bleu(prediction, reference)) AS bleu, avg(rouge_l(prediction, reference)) AS rouge_l FROM {pairs} GROUP BY model",
        pairs=pairs(spark, sf_dir),
    )


# -- ratings ----------------------------------------------------------------------------

_SCORES = ", ".join(
    f"avg(score) FILTER (WHERE criterion = '{c}'{{extra}}) AS {c}" for c in ratings.CRITERIA
)


def _human(extra: str) -> str:
    mean = " + ".join(ratings.CRITERIA)
    rounded = ", ".join(f"round({c}, 6) AS {c}" for c in ratings.CRITERIA)
    return f"""WITH {S.RATINGS}, means AS (SELECT system, {_SCORES.format(extra=extra)} FROM rating GROUP BY system)
    SELECT system, {rounded}, round(({mean}) / 3, 6) AS average FROM means"""


@query("human_scores", _human(" AND score > 0"))
def human_scores(spark, sf_dir):
    return ratings.human_scores(tables.ratings(spark, sf_dir))


@query(
    "human_levels",
    f"""WITH {S.RATINGS}, rated AS (SELECT system, criterion, nullif(score, 0) AS score FROM rating)
    SELECT 'both' AS level, system, criterion, round(avg(score), 6) AS mean, count(score) AS rated, count(*) AS entries FROM rated GROUP BY system, criterion
    UNION ALL SELECT 'system', system, NULL, round(avg(score), 6), count(score), count(*) FROM rated GROUP BY system
    UNION ALL SELECT 'criterion', NULL, criterion, round(avg(score), 6), count(score), count(*) FROM rated GROUP BY criterion
    UNION ALL SELECT 'all', NULL, NULL, round(avg(score), 6), count(score), count(*) FROM rated""",
)
def human_levels(spark, sf_dir):
    return ratings.score_levels(tables.ratings(spark, sf_dir))


@query("human_scores_raw", _human(""))
def human_scores_raw(spark, sf_dir):
    return ratings.human_scores(tables.ratings(spark, sf_dir), zero_is_missing=False)


@query(
    "human_prompt_scores",
    f"""WITH {S.RATINGS} SELECT sample_id, round(avg(score) FILTER (WHERE system = 'a'), 6) AS mean_a,
    round(avg(score) FILTER (WHERE system = 'b'), 6) AS mean_b FROM rating GROUP BY sample_id""",
)
def human_prompt_scores(spark, sf_dir):
    return ratings.prompt_scores(tables.ratings(spark, sf_dir), tables.SYSTEMS)


@query(
    "annotation_sheet",
    f"""WITH {S.PRED} SELECT id, instruction AS prompt, response AS reference, prediction AS generated,
    0 AS helpfulness, 0 AS factuality, 0 AS instruction_following, '' AS notes
    FROM instruct JOIN pred USING (id) WHERE model = 'drop3'""",
)
def annotation_sheet(spark, sf_dir):
    """Annotation rows written as JSON and read back."""
    instruct = tables.instructions(spark, sf_dir)
    answers = tables.predictions(instruct).where("model = 'drop3'").select("id", F.col("prediction").alias("generated"))
    samples = instruct.select("id", F.col("instruction").alias("prompt"), F.col("response").alias("reference"))
    path = shared_folder(spark, "annotation")
    writers.save_for_annotation(samples.join(answers, "id"), path)
    return readers.read_annotations(spark, path, fmt="lines")


# -- generation and streams -------------------------------------------------------------


@query(
    "batch_generate",
    f"""WITH {S.INSTRUCT}, prompts AS (SELECT id, list_filter(regexp_split_to_array({S.HEADINGS}, '{S.SPACES}'), lambda x: x <> '') AS ws FROM instruct)
    SELECT id, array_to_string(list_reverse(ws), ' ') AS text, len(ws) AS tokens_generated, 'ok' AS status FROM prompts""",
)
def batch_generate(spark, sf_dir):
    prompts = templates.evaluation_rows(tables.instructions(spark, sf_dir), "headings").select("id", "prompt")
    return generate.batch_generate(prompts, "echo").select("id", "text", "tokens_generated", "status")


def _refusing_engine(**options):
    """An engine that fails on prompts without context."""

    def answer(prompts):
        for prompt in prompts:
            if "### Context:" not in prompt:
                raise RuntimeError("no context")
        return [prompt.split()[-1] for prompt in prompts]

    return answer


@query(
    "generation_errors",
    f"""WITH {S.INSTRUCT} SELECT CASE WHEN length(context) > 0 THEN 'ok' ELSE 'error' END AS status,
    CASE WHEN length(context) > 0 THEN NULL ELSE 'no context' END AS error, count(*) AS n,
    sum(CASE WHEN length(context) > 0 THEN 1 ELSE 0 END)::BIGINT AS tokens FROM instruct GROUP BY 1, 2""",
)
def generation_errors(spark, sf_dir):
    """Failed requests stay as rows with their error; the rest are generated all the same."""
    prompts = templates.evaluation_rows(tables.instructions(spark, sf_dir), "headings").select("id", "prompt")
    made = generate.batch_generate(prompts, _refusing_engine, timeout_latency=60.0)
    return made.groupBy("status", "error").agg(
        F.count(F.lit(1)).alias("n"), F.sum("tokens_generated").alias("tokens")
    )


@query("score_stream", f"WITH {_WS4} SELECT model, id, round({S.bleu(4)}, 6) AS bleu_4 FROM matched")
def score_stream(spark, sf_dir):
    """Predictions scored while they arrive as files."""
    instruct = tables.instructions(spark, sf_dir)
    landing = shared_folder(spark, "landing")
    tables.predictions(instruct).write.parquet(landing)
    arriving = jobs.file_stream(spark, landing, "model STRING, id BIGINT, prediction STRING")
    return jobs.run_to_end(jobs.score_stream(arriving, instruct, ["bleu_4"]), "scores")
