import random

import pytest
from pyspark.sql import functions as F

from gradeloom.functions import templates, text
from gradeloom.operators import profile, splits, tokens
from gradeloom.operators.prefix import global_rank, rank_within, running
from gradeloom.sources import readers

INSTRUCT = "id BIGINT, instruction STRING, context STRING, response STRING, category STRING"


@pytest.fixture(scope="module")
def instruct(spark):
    rows = [
        (0, "Do it", "", "Done", "a"),
        (1, "Do it", " \n\t", "Done", "a"),
        (2, "Do it", None, "Done", None),
        (3, "Do it", "With care", "Done", "b"),
    ]
    return spark.createDataFrame(rows, INSTRUCT)


def _column(df, c):
    return [r[0] for r in df.orderBy("id").select(c).collect()]


def test_chat_template(instruct):
    texts = _column(templates.apply_template(instruct, "chat"), "text")
    plain = (
        f"<|system|>\n{templates.SYSTEM_LINE}</s>\n<|user|>\nDo it</s>\n<|assistant|>\nDone</s>"
    )
    assert texts[0] == texts[1] == texts[2] == plain
    assert texts[3] == plain.replace("Do it", "Do it\n\nContext: With care")


def test_prompt_templates(instruct):
    prompts = _column(templates.evaluation_rows(instruct), "prompt")
    assert prompts[0].startswith(f"<|system|>\n{templates.SYSTEM_LINE}</s> \n<|user|>\n")
    assert prompts[0].endswith("Do it</s>\n<|assistant|>\n")
    headings = _column(templates.apply_template(instruct, "headings", "prompt"), "prompt")
    assert headings[0] == headings[2] == "### Instruction:\nDo it\n\n### Response:\n"
    assert headings[1] == "### Instruction:\nDo it\n\n### Context:\n \n\t\n\n### Response:\n"
    with pytest.raises(ValueError):
        templates.apply_template(instruct, "unknown")
    templates.register_template("shout", lambda: F.upper("instruction"))
    assert _column(templates.apply_template(instruct, "shout"), "text")[0] == "DO IT"


def test_conversations(spark):
    rows = [(1, 1, "assistant", "Hello"), (1, 0, "user", "Hi"), (1, 2, "tool", "?"), (2, 0, "system", "Be brief")]
    df = spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, content STRING")
    found = {r.conv_id: r.text for r in templates.render_conversations(df).collect()}
    assert found == {1: "<|user|>\nHi</s>\n<|assistant|>\nHello</s>\n", 2: "<|system|>\nBe brief</s>\n"}
    asked = {r.conv_id: r.text for r in templates.render_conversations(df, True).collect()}
    assert asked[2] == found[2] + "<|assistant|>\n"


def test_python_text_rules(spark):
    samples = ["", "  a\tb\n", "　x y\x1c", "MiXed case", "one", " \n "]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "id BIGINT, s STRING")
    rows = df.select(
        "id", text.trim_py("s").alias("strip"), text.words("s").alias("split"), text.slug("s").alias("slug"),
        text.capitalize_py("s").alias("cap"), text.preview("s", 3).alias("cut"),
    ).orderBy("id").collect()
    for row, s in zip(rows, samples):
        assert row.strip == s.strip() and row.split == s.split()
        assert row.slug == s.lower().replace(" ", "_") and row.cap == s.capitalize() and row.cut == s[:3]


def test_strip_prompt(spark):
    df = spark.createDataFrame([("Q: why?\n because ", "Q: why?"), ("short", "longer than that")], "g STRING, p STRING")
    assert [r[0] for r in df.select(text.strip_prompt("g", "p")).collect()] == ["because", ""]


@pytest.mark.parametrize(
    "rows, max_samples, expected",
    [(20000, None, (12000, 2000, 1000)), (15000, None, (12000, 2000, 1000)), (1000, None, (800, 133, 67)),
     (20000, 100, (80, 13, 7)), (50, 100, (40, 6, 4)), (0, None, (0, 0, 0))],
)
def test_split_sizes(rows, max_samples, expected):
    assert splits.split_sizes(rows, max_samples=max_samples) == expected


def test_splits_are_disjoint_exact_and_stable(spark):
    df = spark.range(3000)
    made = splits.create_splits(df, train=1000, validation=200, test=100)
    counts = {r.split: r["count"] for r in made.groupBy("split").count().collect()}
    assert counts == {"train": 1000, "validation": 200, "test": 100}
    assert made.select("id").distinct().count() == 1300
    again = splits.create_splits(df.repartition(5), train=1000, validation=200, test=100)
    assert sorted(made.collect()) == sorted(again.collect())


def test_global_rank_is_dense(spark):
    ranks = sorted(r["rank"] for r in global_rank(spark.range(5000).repartition(6), 1).collect())
    assert ranks == list(range(1, 5001))


def test_rank_within_and_running_cross_chunks(spark):
    rng = random.Random(2)
    rows = [(rng.choice("aab"), i, rng.randrange(100)) for i in range(400)]
    df = spark.createDataFrame(rows, "k STRING, t BIGINT, v BIGINT").withColumn("chunk", F.floor(F.col("t") / 37))
    low = running(df, ["k"], "chunk", ["t"], "v", "min", "low", inclusive=False)
    total = running(low, ["k"], "chunk", ["t"], "v", "sum", "total")
    ranked = rank_within(total, ["k"], F.floor(F.col("t") / 50), ["t"], "n")
    for key in "ab":
        mine = [r for r in rows if r[0] == key]
        found = ranked.where(F.col("k") == key).orderBy("t").collect()
        for i, row in enumerate(found):
            earlier = [v for _, _, v in mine[:i]]
            assert row.n == i + 1 and row.total == sum(earlier) + mine[i][2]
            assert row.low == (min(earlier) if earlier else None)


def test_samples(spark):
    df = spark.range(2500).withColumn("category", (F.col("id") % 7).cast("string"))
    tail = [r.id for r in splits.tail_holdout(df, 3).collect()]
    assert tail == [1500, 1501, 1502]
    assert splits.seeded_sample(df, 5000).count() == 2500
    first = [r.id for r in splits.seeded_sample(df, 5).collect()]
    assert first == [r.id for r in splits.seeded_sample(df.repartition(9), 5).collect()]
    assert [r.category for r in splits.first_per_category(df).collect()] == ["0", "1", "2"]
    ranked = df.limit(4).select("id", (F.col("id") + 1).alias("rank"))
    cycled = [r.id for r in splits.cycle_to(ranked, 4, 10).orderBy("position").collect()]
    assert cycled == [i % 4 for i in range(10)]
    assert [r.id for r in splits.cycle_to(ranked, 4, 3).orderBy("position").collect()] == [0, 1, 2]


def test_statistics(instruct):
    described = {r.metric: r for r in profile.describe(profile.with_lengths(instruct), profile.LENGTHS).collect()}
    assert described["context_len"]["count"] == 3 and described["context_len"].p50 == 3
    counts = {r.category: r.n for r in profile.category_counts(instruct.withColumn("split", F.lit("s"))).collect()}
    assert counts == {"a": 2, "b": 1, "unknown": 1}
    mapped = profile.category_map(instruct.withColumn("split", F.lit("s"))).first()
    assert mapped.categories == counts
    flat = profile.histogram(instruct.withColumn("n", F.lit(3)), ["n"]).collect()
    assert [(r.bin, r.n) for r in flat] == [(25, 4)]


def test_histogram_has_all_rows(spark):
    rows = profile.histogram(spark.range(1001), ["id"]).collect()
    assert sum(r.n for r in rows) == 1001 and max(r.bin for r in rows) == 49


def test_encoding(spark):
    df = spark.createDataFrame([(1, "b a a c"), (2, ""), (3, "zzz a")], "id BIGINT, text STRING")
    vocabulary = tokens.build_vocabulary(df, size=2)
    assert [(r.token, r.n, r.token_id) for r in vocabulary.orderBy("token_id").collect()] == [("a", 3, 3), ("b", 1, 4)]
    shipped = tokens.encode(df, vocabulary).select("id", "input_ids", "attention_mask", "labels").orderBy("id").collect()
    assert [r.input_ids for r in shipped] == [[1, 4, 3, 3, 0], [1], [1, 0, 3]]
    assert [r.input_ids for r in tokens.encode(df, vocabulary, max_length=2).orderBy("id").collect()] == [[1, 4], [1], [1, 0]]


def test_encoding_of_repeated_rows_and_many_tokens(spark):
    many = spark.range(200_000).select(F.concat(F.lit("w"), "id").alias("token"), (F.col("id") + 3).cast("int").alias("token_id"))
    twice = many.unionByName(spark.createDataFrame([("w5", 999_999)], "token STRING, token_id INT"))
    df = spark.createDataFrame([(1, "w0 w199999"), (1, "w5 w5 other"), (1, None)], "id BIGINT, text STRING")
    rows = sorted(r.input_ids for r in tokens.encode(df, twice).collect())
    assert rows == [[1], [1, 3, 200_002], [1, 8, 8, 0]]
    # a vocabulary that workers may not hold whole is joined by blocks, with the same result
    for size in (1, 20, 1 << 20):
        joined = tokens.encode(df, twice, max_vocabulary_bytes=1000, block_bytes=size)
        assert sorted(map(str, joined.collect())) == sorted(map(str, tokens.encode(df, twice).collect()))
        assert joined.schema.simpleString() == tokens.encode(df, twice).schema.simpleString()
    assert tokens.encode(df.limit(0), twice, max_vocabulary_bytes=1000).count() == 0


def test_rank_keeps_rows_without_id(spark):
    df = spark.createDataFrame([(i,) for i in range(50)] + [(None,)] * 3, "id BIGINT")
    ranked = splits.seeded_shuffle(df).collect()
    assert sorted(r["rank"] for r in ranked) == list(range(1, 54))
    assert {r["rank"] for r in ranked if r.id is None} == {51, 52, 53}


def test_split_prunes_before_the_shuffle(spark):
    df = spark.range(5000)
    wanted = splits.create_splits(df, train=60, validation=20, test=20)
    ranks = {r.id: r["rank"] for r in splits.seeded_shuffle(df).collect()}
    assert {ranks[r.id] for r in wanted.collect()} == set(range(1, 101))


def test_padding(spark):
    df = spark.range(50).select("id", F.sequence(F.lit(1), (F.col("id") % 11 + 1).cast("int")).alias("input_ids"))
    df = df.withColumns({"attention_mask": F.transform("input_ids", lambda x: F.lit(1)), "labels": F.col("input_ids")})
    rows = tokens.padded_batches(df, 8, 0).collect()
    assert len(rows) == 50 and len({r.batch_id for r in rows}) == 7
    for r in rows:
        longest = max(x.num_tokens for x in rows if x.batch_id == r.batch_id)
        assert r.padded_length == -(-longest // 8) * 8 == len(r.input_ids) == len(r.labels) == len(r.attention_mask)
        assert sum(r.attention_mask) == r.num_tokens and r.labels.count(-100) == r.padded_length - r.num_tokens


def test_a_vocabulary_is_counted_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def passing(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    vocabulary = spark.createDataFrame([("a", 3), ("b", 4)], "token STRING, token_id INT").mapInArrow(passing, "token STRING, token_id INT")
    df = spark.createDataFrame([(1, "b a x")], "id BIGINT, text STRING")
    assert tokens.encode(df, vocabulary).first().input_ids == [1, 4, 3, 0]
    assert seen.value == 2


def test_a_large_batch_is_looked_up_in_slices():
    import tracemalloc

    import numpy as np
    import pyarrow as pa
    from gradeloom.functions.text import BY_WHITESPACE

    texts = pa.array([" ".join(f"word{i % 997}" for i in range(k, k + 400)) for k in range(8000)])
    look_up = tokens._LookUp(BY_WHITESPACE, pa.array(["word5"], pa.large_string()), np.array([7]))
    tracemalloc.start()
    found = look_up(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 8000 and found[0].as_py() == [1] + [7 if i == 5 else 0 for i in range(400)]
    # of 25 MB of text
    assert peak < 100_000_000


def test_evaluation_files_grow_in_number_with_the_texts(spark, sf_dir, monkeypatch):
    from gradeloom.plans import preparing

    few = spark.read.text(preparing._eval_files(spark, sf_dir))
    monkeypatch.setattr(preparing, "EVAL_FILE_BYTES", 20_000)
    path = preparing._eval_files(spark, sf_dir)
    many = spark.read.text(path)
    assert len(many.inputFiles()) > 8 >= len(few.inputFiles())
    assert sorted(r.value for r in many.collect()) == sorted(r.value for r in few.collect())
    assert [(r.id, r.prompt) for r in readers.read_eval_set(spark, path).orderBy("id").collect()] == [
        (r.id, r.prompt) for r in preparing.eval_set_without_id(spark, sf_dir).orderBy("id").collect()
    ]
