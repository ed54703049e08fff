"""The language model against plain counts, a network written out step by step, and held-out text."""

from __future__ import annotations

import math
import random
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from gradeloom.llm import language_model, recurrent
from gradeloom.llm.catalog import QUERIES

SHAPE = recurrent.Shape((0, 1, 3, 7), 4)
MASSES = np.array([5.0, 9, 4, 3, 2, 1, 1])


def small_parameters(seed=1):
    rng = np.random.default_rng(seed)
    p = recurrent.start(SHAPE, MASSES)
    return {k: (v + rng.normal(0, 0.4, v.shape)).astype(np.float32) for k, v in p.items()}


def plain_steps(p, docs, size=4):
    """Natural log probabilities of documents, one word at a time, in doubles."""
    p = {k: v.astype(float) for k, v in p.items()}
    sigmoid = lambda v: 1 / (1 + np.exp(-v))
    softmax = lambda v: np.exp(v) / np.exp(v).sum()
    class_of = [c for c, (a, b) in enumerate(zip(SHAPE.edges, SHAPE.edges[1:])) for _ in range(a, b)]
    out = []
    for doc in docs:
        h, before, total = np.zeros(size), recurrent.END, 0.0
        for now in [*doc, recurrent.END]:
            g, a = p["inputs"][:, before], p["state"] @ h
            r, z = sigmoid(g[:size] + a[:size]), sigmoid(g[size : 2 * size] + a[size : 2 * size])
            new = np.tanh(g[2 * size :] + r * a[2 * size :])
            h = (1 - z) * new + z * h
            c = class_of[now]
            own = slice(SHAPE.edges[c], SHAPE.edges[c + 1])
            total += math.log(softmax(p["class_w"] @ h + p["class_b"][:, 0])[c])
            total += math.log(softmax(p["id_w"][own] @ h + p["id_b"][own, 0])[now - own.start])
            before = now
        out.append(total)
    return out


@pytest.fixture(scope="module")
def sequences():
    rng = random.Random(3)
    return [np.array([rng.randrange(1, 7) for _ in range(n)], np.int16) for n in [0, 1, 2, 90, 0, 7, 33, 5, 5, 16, 64]]


@pytest.mark.parametrize("lanes, size", [(1, 8), (3, 12), (100, 400), (4, 4)])
def test_windows_carry_the_state_through_whole_documents(sequences, lanes, size):
    p = small_parameters()
    got = recurrent.document_scores(sequences, p, SHAPE, lanes, size)
    assert got == pytest.approx(plain_steps(p, sequences), rel=1e-4)
    seen = Counter()
    for w in recurrent.windows(sequences, lanes, size):
        seen.update(zip(w.doc[w.valid].tolist(), w.y[w.valid].tolist()))
    assert seen == Counter((k, i) for k, d in enumerate(sequences) for i in [*d.tolist(), 0])


def test_probabilities_sum_to_one():
    p = small_parameters()
    # after the word 3: all continuations by one word
    starts = plain_steps(p, [[3]])
    assert starts[0] < 0
    state = recurrent._forward(p, next(recurrent.windows([np.array([3], np.int16)])), np.zeros((4, 1), np.float32))[0]
    states = np.repeat(recurrent._columns(state)[:, 1:2], 7, axis=1)
    assert np.exp(recurrent.Scorer(p, SHAPE)(states, np.arange(7))).sum() == pytest.approx(1, rel=1e-5)


def test_gradients_are_those_of_small_changes(sequences):
    p = small_parameters()
    w = next(recurrent.windows(sequences, 5, 60))
    h = np.random.default_rng(0).normal(0, 0.3, (4, w.x.shape[1])).astype(np.float32)
    _, _, grads, seen = recurrent.gradients(p, SHAPE, w, h)
    full = {**grads, "inputs": np.zeros_like(p["inputs"])}
    full["inputs"][:, seen] = grads["inputs"]
    for name, values in p.items():
        for at in list(np.ndindex(values.shape))[::5]:
            moved = []
            for step in (0.01, -0.01):
                q = {k: v.copy() for k, v in p.items()}
                q[name][at] += step
                moved.append(-recurrent.gradients(q, SHAPE, w, h)[0].astype(float).sum())
            assert full[name][at] == pytest.approx((moved[0] - moved[1]) / 0.02, abs=0.02, rel=0.02), (name, at)


def stepwise_states(p, w, h):
    """The network with everything done step by step."""
    steps, lanes = w.x.shape
    size = len(h)
    gates = np.take(p["inputs"], w.x, axis=1).swapaxes(0, 1)  # steps, 3 * hidden, lanes
    keep = (w.x != recurrent.END).astype(np.float32)
    states, befores, inner = (np.empty((steps, size, lanes), np.float32) for _ in range(3))
    state = p["state"]
    for t in range(steps):
        g = gates[t]
        h = np.multiply(h, keep[t], out=befores[t])
        a = state @ h
        rz = g[: 2 * size]
        rz += a[: 2 * size]
        # the logistic function as a hyperbolic tangent
        rz *= 0.5
        np.tanh(rz, out=rz)
        rz *= 0.5
        rz += 0.5
        inner[t] = a[2 * size :]
        new = g[2 * size :]
        new += rz[:size] * inner[t]
        np.tanh(new, out=new)
        h = np.subtract(h, new, out=states[t])
        h *= rz[size:]
        h += new
    return states, befores, inner, gates  # gates hold r, z and the new state now


def stepwise_gradients(p, shape, w, h):
    size = shape.hidden
    steps, lanes = w.x.shape
    states, befores, inner, gates = stepwise_states(p, w, h)
    valid = np.flatnonzero(w.valid)
    own = recurrent._columns(states)
    found, d_valid, grads = recurrent.Scorer(p, shape)(np.take(own, valid, axis=1), w.y.ravel()[valid], gradient=True)
    d_own = np.zeros_like(own)
    d_own[:, valid] = d_valid
    d_states = d_own.reshape(size, steps, lanes)
    d_gates, d_sums = np.empty((3 * size, steps, lanes), np.float32), np.empty((3 * size, steps, lanes), np.float32)
    keep = (w.x != recurrent.END).astype(np.float32)
    carried = np.zeros((size, lanes), np.float32)
    back = np.ascontiguousarray(p["state"].T)
    s = np.empty((3 * size, lanes), np.float32)
    for t in range(steps - 1, -1, -1):
        dh = d_states[:, t] + carried
        r, z, new = gates[t, :size], gates[t, size : 2 * size], gates[t, 2 * size :]
        d_new = dh * (1 - z)
        d_new *= 1 - new * new
        s[:size] = d_new * inner[t] * r * (1 - r)
        dh *= z
        s[size : 2 * size] = dh * (befores[t] - new) * (1 - z)
        d_gates[: 2 * size, t] = s[: 2 * size]
        d_gates[2 * size :, t] = d_new
        np.multiply(d_new, r, out=s[2 * size :])
        d_sums[:, t] = s
        dh += back @ s
        dh *= keep[t]
        carried = dh
    grads["state"] = d_sums.reshape(3 * size, -1) @ recurrent._columns(befores).T
    x = w.x.ravel()
    order = np.argsort(x.astype(np.int16), kind="stable")
    sorted_x = x[order]
    begins = np.flatnonzero(np.diff(sorted_x, prepend=-1))
    grads["inputs"] = np.add.reduceat(np.take(d_gates.reshape(3 * size, -1), order, axis=1), begins, axis=1)
    return found, states[-1], grads, sorted_x[begins]


def test_steps_of_few_lanes_take_fewer_calls_and_give_the_same_bits():
    rng = np.random.default_rng(4)
    shape = recurrent.Shape((0, 1, 3, 7), 8)
    p = recurrent.start(shape, MASSES)
    for lengths in ([3000], [40, 3, 0, 700, 5, 0, 61] * 9):
        w = next(recurrent.windows([rng.integers(1, 7, n).astype(np.int16) for n in lengths]))
        h = rng.normal(0, 0.3, (8, w.x.shape[1])).astype(np.float32)
        plain, got = stepwise_gradients(p, shape, w, h), recurrent.gradients(p, shape, w, h)
        for a, b in zip([*plain[:2], *(plain[2][k] for k in sorted(plain[2])), plain[3]], [*got[:2], *(got[2][k] for k in sorted(got[2])), got[3]]):
            assert np.array_equal(a, b)
    # a long document alone: what its steps take is the number of calls
    w, h = next(recurrent.windows([rng.integers(1, 7, 4000).astype(np.int16)])), np.zeros((8, 1), np.float32)
    least = {}
    for _ in range(7):
        for f in (stepwise_gradients, recurrent.gradients):
            begun = time.process_time()
            f(p, shape, w, h)
            least[f] = min(least.get(f, math.inf), time.process_time() - begun)
    assert least[recurrent.gradients] < 0.9 * least[stepwise_gradients]


def plain_base(docs):
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in docs]
    words = [(t or "").encode().lower().split() for _, t in docs]
    c = Counter(w for ws, out in zip(words, held) if not out for w in [*ws, None])
    n, v = c.total(), len(c)
    rows = Counter()
    for (i, _), ws, out in zip(docs, words, held):
        tokens = [*ws, None]
        score = sum(math.log10((c[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens)
        rows[(i, out, len(tokens), sum(c[t] > 0 for t in tokens), n, round(score, 6))] += 1
    return rows


def base_of(rows):
    return Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows)


def test_whole_table(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = QUERIES["op12_language_model"](spark, sf_dir).collect()
    assert base_of(rows) == plain_base(docs)
    held = [r for r in rows if r["held_out"]]
    assert held and all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_order_of_words_is_learnt(spark):
    rng = random.Random(2)
    follows = {w: f"w{(7 * k + 3) % 40}" for k, w in enumerate(f"w{k}" for k in range(40))}

    def text():
        w = f"w{rng.randrange(40)}"
        made = [w]
        for _ in range(40):
            w = follows[w] if rng.random() < 0.9 else f"w{rng.randrange(40)}"
            made.append(w)
        return " ".join(made)

    docs = spark.createDataFrame([(i, text()) for i in range(9000)], "doc_id long, text string").repartition(2)
    held = language_model.score_documents(docs).where("held_out").selectExpr("sum(score) / sum(n_tokens) s", "sum(base_score) / sum(n_tokens) b").first()
    assert held["s"] > 0.75 * held["b"]  # the next word is far likelier than by its count


def test_score_is_the_network_and_the_rest(spark):
    rng = random.Random(9)
    docs = [(i, " ".join(f"w{int(rng.paretovariate(0.7)) % 90}" for _ in range(rng.randrange(30)))) for i in range(60)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    coded, model = language_model.resolved(language_model.numbered(frame, rows=9), 6, 2)
    model = language_model.trained(coded, model, 2)
    global SHAPE
    kept, SHAPE = SHAPE, model.shape
    try:
        got = {r["doc_id"]: r["score"] for r in language_model.scored(coded, model, 40).collect()}
        c = Counter(w for i, t in docs if not language_model.held_out(i) for w in t.split())
        inside = {w for w, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:6]}
        rest = {w: n for w, n in c.items() if w not in inside}
        under = sum(rest.values()) + 0.5 * (len(rest) + 1)
        assert set(model.ids) == inside
        for i, t in docs:
            ids = [model.ids.get(w, model.other) for w in t.split()]
            expected = plain_steps(model.parameters, [ids], model.shape.hidden)[0] / math.log(10)
            expected += sum(math.log10((rest.get(w, 0) + 0.5) / under) for w in t.split() if w not in inside)
            assert got[i] == pytest.approx(expected, rel=1e-4)
    finally:
        SHAPE = kept


def test_every_word_reaches_the_network(spark):
    rng = random.Random(5)
    docs = [(i, " ".join(f"w{int(rng.paretovariate(0.6)) % 400}" for _ in range(rng.randrange(40)))) for i in range(80)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    words = language_model.numbered(frame, rows=13)
    coded, model = language_model.resolved(words, 6, 2, 8)
    c = Counter(w for i, t in docs if not language_model.held_out(i) for w in t.split())
    shared = lambda w: zlib.crc32(w.encode()) % 8
    assert len({*model.ids.values(), *model.others.tolist()}) == 6 + 8 and model.shape.n_ids == 6 + 8 + 1
    tokens, distinct = Counter(), Counter()
    for w, n in c.items():
        if w not in model.ids:
            tokens[shared(w)] += n
            distinct[shared(w)] += 1
    rows = {r["doc_id"]: r for r in coded.collect()}
    for i, t in docs:
        assert list(rows[i]["codes"]) == [model.ids.get(w, model.others[shared(w)]) for w in t.split()]
        rest = [(c[w] + 0.5) / (tokens[shared(w)] + 0.5 * (distinct[shared(w)] + 1)) for w in t.split() if w not in model.ids]
        assert rows[i]["rest_score"] == pytest.approx(sum(map(math.log10, rest)))
    # the order of words that are no ids of their own is learnt as well
    follows = {f"w{k}": f"w{(7 * k + 3) % 40}" for k in range(40)}
    made = []
    for i in range(3000):
        text = [f"w{rng.randrange(40)}"]
        while len(text) < 40:
            text.append(follows[text[-1]])
        made.append((i, " ".join(text)))
    made = spark.createDataFrame(made, "doc_id long, text string").repartition(2)
    held = language_model.score_documents(made, model_words=1).where("held_out").selectExpr("sum(score) s", "sum(base_score) b").first()
    assert held["s"] > 0.9 * held["b"]


def test_odd_rows(spark):
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
    docs = [(1, None), (2, ""), (3, "a"), (4, long), (5, "B b"), (5, "B b"), (None, "no id"), (7, "\n \t "), (8, "x" * 20_000), (9, "ünï 日本 👩")]
    frame = spark.createDataFrame([(i, t, 1, 2, "x", 0.5) for i, t in docs], "doc_id long, text string, block long, turn int, codes string, score double")
    rows = language_model.score_documents(frame).collect()
    assert base_of(rows) == plain_base(docs)
    assert all(math.isfinite(r["score"]) for r in rows)
    assert language_model.score_documents(frame.limit(0)).count() == 0
    alone = language_model.score_documents(frame, held=lambda i: True).collect()
    assert {r["train_tokens"] for r in alone} == {0} and all(r["base_score"] == 0 for r in alone)


def test_words_are_those_of_the_bytes():
    rng = random.Random(11)
    marks = [*" \t\n\x0b\x0c\r", "a", "B", "Z", "É", "\x1c", "\x85", "\u00a0", "\u2003", "\x00", "İ"]
    texts = ["".join(rng.choice(marks) for _ in range(rng.randrange(12))) for _ in range(3000)] + ["", None, " ", "\t\n"]
    for begin in (0, 7):
        words, n = language_model.split(pa.array(texts)[begin:])
        expected = [(t or "").encode().lower().split() for t in texts[begin:]]
        assert n.tolist() == list(map(len, expected))
        assert words.cast(pa.binary()).to_pylist() == [w for ws in expected for w in ws]
    assert language_model.split(pa.array([None, ""], pa.string()))[1].tolist() == [0, 0]


def test_packed_ids_are_the_ids(spark):
    docs = [(i, " ".join(f"w{(i * k) % 23}" for k in range(i % 9)) or None) for i in range(70)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    words = language_model.numbered(frame, rows=11)
    made = [language_model.resolved(words, 5, 2, 3, packed) for packed in (False, True)]
    arrays, packed = ({r["doc_id"]: r.asDict() for r in coded.collect()} for coded, _ in made)
    ids = {i: np.frombuffer(r.pop("codes"), np.int16).tolist() for i, r in packed.items()}
    assert ids == {i: list(r.pop("codes")) for i, r in arrays.items()} and any(ids.values())
    drop = lambda rows: {i: {k: v for k, v in r.items() if k != "turn"} for i, r in rows.items()}
    assert drop(packed) == drop(arrays)
    scores = [{r["doc_id"]: r["score"] for r in language_model.scored(coded, model).collect()} for coded, model in made]
    assert scores[0] == pytest.approx(scores[1], rel=1e-6)


def test_documents_are_not_carried_number_by_number(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    blocks = language_model.numbered(docs)
    assert all(t not in blocks.schema.simpleString() for t in ("array", "map"))  # the words need no explode
    coded, _ = language_model.resolved(blocks, 100, 2, packed=True)
    assert dict(coded.dtypes)["codes"] == "binary"
