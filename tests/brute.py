"""Plain restatements of the scores, slow and obvious, for small fixtures."""

import math
from collections import Counter


def grams(tokens, n):
    return Counter(tuple(tokens[i:i + n]) for i in range(len(tokens) - n + 1))


def bleu(pred, ref, order):
    shared = [sum((grams(pred, n) & grams(ref, n)).values()) for n in range(1, order + 1)]
    if not pred or not shared[0]:
        return 0.0
    total = 0.0
    for n, m in enumerate(shared, 1):
        total += math.log((m or 0.1) / max(1, len(pred) - n + 1)) / order
    brevity = 1.0 if len(pred) > len(ref) else math.exp(1 - len(ref) / len(pred))
    return brevity * math.exp(total)


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        previous = row[:]
        for j, y in enumerate(b, 1):
            row[j] = previous[j - 1] + 1 if x == y else max(previous[j], row[j - 1])
    return row[-1]


def f1(p, r):
    return 2 * p * r / (p + r) if p + r else 0.0


def rouge_n(pred, ref, n):
    m = sum((grams(pred, n) & grams(ref, n)).values())
    p = m / (len(pred) - n + 1) if len(pred) >= n else 0.0
    r = m / (len(ref) - n + 1) if len(ref) >= n else 0.0
    return f1(p, r)


def rouge_l(pred, ref):
    m = lcs(pred, ref)
    p = m / len(pred) if pred else 0.0
    r = m / len(ref) if ref else 0.0
    return p, r, f1(p, r)


def cosine_match(pred_vecs, ref_vecs):
    def cos(a, b):
        dot = sum(x * y for x, y in zip(a, b))
        norm = math.sqrt(sum(x * x for x in a)) * math.sqrt(sum(x * x for x in b))
        return dot / norm if norm else 0.0

    p = sum(max(cos(a, b) for b in ref_vecs) for a in pred_vecs) / len(pred_vecs)
    r = sum(max(cos(a, b) for a in pred_vecs) for b in ref_vecs) / len(ref_vecs)
    return p, r
