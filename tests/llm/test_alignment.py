"""Alignment of two tokenizers against a plain walk over token ends."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gradeloom.llm import alignment
from gradeloom.llm.catalog import PIECES, QUERIES, TOKENIZER

PATHS = (public_tokenizers.path(TOKENIZER), public_tokenizers.path(PIECES))


@pytest.fixture(scope="module")
def models():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(x): x for x in prints}
    rest = [x for x in range(256) if x not in prints]
    table.update({chr(256 + k): x for k, x in enumerate(rest)})

    def bytes_a(i):
        return bytes(table[c] for c in a.id_to_token(i))

    def bytes_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    return a, b, bytes_a, bytes_b


def plain_align(docs, models):
    a, b, bytes_a, bytes_b = models
    made, held = [], Counter()
    for i, text in docs:
        spaced = (" " + text).encode() if text else b""
        one = a.encode(spaced.decode(), add_special_tokens=False).ids if text else []
        two = b.encode(text) if text else []
        if b"".join(map(bytes_a, one)) != spaced or b"".join(map(bytes_b, two)) != spaced:
            one, two = [], []
        ends = []
        for ids, size in ((one, bytes_a), (two, bytes_b)):
            at, own = 0, []
            for t in ids:
                at += len(size(t))
                own.append(at)
            ends.append(own)
        common = sorted(set(ends[0]) & set(ends[1]))
        groups = defaultdict(lambda: ([], []))
        for side, (ids, own) in enumerate(zip((one, two), ends)):
            for t, e in zip(ids, own):
                groups[next(c for c in common if c >= e)][side].append(t)
        groups = [groups[c] for c in common]
        links = Counter((x, y) for xs, ys in groups for x in xs for y in ys)
        held.update(set(links))
        digest = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in groups)
        made.append((i, len(one), len(two), len(groups), links, digest))
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    return Counter(
        (
            i, n_a, n_b, n_groups, links.total(), sum(n for p, n in links.items() if held[p] == best[p[0]]),
            sum(n * held[p] for p, n in links.items()), hashlib.sha256(digest.encode()).hexdigest() if digest else "",
        )
        for i, n_a, n_b, n_groups, links, digest in made
    )


def got(df):
    names = [f.split(" ")[0] for f in alignment.RESULT.split(", ")]
    return Counter(tuple(r[c] for c in names) for r in df.collect())


ODD = [
    (1, None), (2, ""), (3, "a"), (4, "Größe 日本語  👩‍👧 naïve\n\n\tend  "), (5, "same text"), (5, "same text"), (None, "no id"),
    (6, " "), (7, "  lead"), (8, "▁mark"), (9, "x▁y z"), (10, "<s> </s> <unk> <0x0A> <|endoftext|>"), (11, "nul\x00l \x7f\r\n"),
    (12, "=" * 3001 + " " * 777 + "-" * 500), (13, "ﬁ Å Å ​﻿"), (14, "a b 　c "), (15, "w1 w2 " * 2000),
]


def test_odd_rows(spark, models):
    frame = spark.createDataFrame([(i, t, 1, "r", 2, [3]) for i, t in ODD], "doc_id long, text string, block long, refs string, n_a long, pairs array<int>")
    assert got(alignment.align_documents(frame, *PATHS)) == plain_align(ODD, models)
    assert alignment.align_documents(frame.limit(0), *PATHS).count() == 0


def test_counts_are_those_of_all_blocks(spark, models):
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choice(["the", "thé", "überaus", "Zebra9", "a-b", "日本", "zzq"]) for _ in range(rng.randrange(40)))) for i in range(150)]
    docs += docs[:9]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    expected = plain_align(docs, models)
    for rows, size in ((4096, 1 << 20), (7, 1 << 20), (4096, 300)):
        assert got(alignment.align_documents(frame, *PATHS, rows, size)) == expected


def test_whole_table(spark, sf_dir, models):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert got(QUERIES["op11_alignment"](spark, sf_dir)) == plain_align([(r["doc_id"], r["text"]) for r in docs.collect()], models)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab é▁日\n\t=.9  \x00👩"), max_size=25), max_size=5))
def test_pieces_are_the_same_apart(texts):
    model = alignment.PieceIds(PATHS[1], cache_words=5)
    texts = [t for t in texts if t]
    for _ in range(2):
        assert model.encode([" " + t for t in texts]) == model.model.encode(texts)
