from pyspark.sql import functions as F

from gradeloom.plans import tables, workflows
from gradeloom.sources import readers


def test_prepare_then_evaluate(spark, sf_dir, tmp_path):
    instruct = tables.instructions(spark, sf_dir)
    stats = {r.split: r for r in workflows.prepare_dataset(instruct, str(tmp_path)).collect()}
    assert sum(r.num_samples for r in stats.values()) == instruct.count()
    rows = readers.read_eval_set(spark, f"{tmp_path}/test-eval")
    assert rows.count() == stats["test"].num_samples

    def quoting(**options):
        # repeats its prompt, as causal models do, before answering
        return lambda prompts: [{"text": f"{p} the answer", "tokens": 2, "metadata": {"total_duration": 7}} for p in prompts]

    answers = workflows.generate_answers(rows, "quoting", quoting)
    assert {(r.prediction, r.tokens_generated) for r in answers.collect()} == {("the answer", 2)}
    echoed = workflows.generate_answers(rows, "echo", "echo")
    references = instruct.select("id", "response")
    both = answers.unionByName(echoed)
    scored, card = workflows.evaluate(both, references, tables.token_vectors(spark, sf_dir, instruct))
    assert scored.count() == 2 * rows.count()
    found = {r.model: r for r in card.collect()}
    assert found.keys() == {"quoting", "echo"} and 0 <= found["echo"].bertscore_f1 <= 1
    compared = workflows.compare_models(card, "echo", ("echo", "quoting"))
    assert compared["matrix"].count() == compared["best"].count() == compared["before_after"].count() == 12


def test_benchmark(spark, sf_dir):
    found = workflows.summarise_benchmark(tables.requests(spark, sf_dir), "click", tables.FRAMEWORKS)
    assert found["summary"].count() == 5 and found["winners"].count() == 3
    assert found["speedup"].where("framework = 'click'").first().speedup == 1
    assert found["records"].select(F.max("results.avg_throughput_tokens_per_s")).first()[0] > 0
