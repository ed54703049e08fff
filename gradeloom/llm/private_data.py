"""Personal data: exact base patterns, and a semi-Markov conditional random field that adds spans.

The base patterns always stay. Around what they leave, a text is searched for islands: runs
of atoms (digit runs, letter runs, single marks, spaces) in which a digit or an at sign,
or one written out, stands. What stands before an at sign, the sign, each host name after it and
each dot written out between two of them are one atom each, however long, so no address is cut.
On an island, every run of at most ``MAX_ATOMS`` atoms and ``MAX_CHARS`` code points, the bounds of
an entity, is a candidate segment for every kind. Features look at the whole candidate (how many digits, how grouped, which marks,
whether a checksum holds), not at single atoms. Dynamic programming over end positions,
bounded by the length of an entity, chooses boundaries and kinds together; base spans are
held fixed in it.

The weights are learned here by maximum likelihood, on labelled snippets drawn from a seeded
generator of notations (written addresses, grouped numbers) and of look-alikes (dates,
prices, versions, identifiers).
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.common import slices

KINDS = ("email", "ip", "card", "phone")
MAX_ATOMS = 19
#: Longer than any address can be: 64 code points, a sign and 255 more, with room for signs written out.
MAX_CHARS = 512

# One pass each, without retries. Possessive and look-behind forms only spare repeated work on long runs.
_EMAIL_REST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[^0-9]+")
_HOST = r"[A-Za-z0-9]++(?:-++[A-Za-z0-9]++)*+(?:\.[A-Za-z0-9]++(?:-++[A-Za-z0-9]++)*+)*+"
#: A dot written out between two host names.
_DOT = r"(?: ?[(\[{](?:dot|DOT|\.)[)\]}] ?| (?:dot|DOT) | \. )"
#: An at sign written out: in brackets, or bare before a dot or a dot written out.
_AT_WORD = re.compile(rf"[(\[{{](?:at|AT)[)\]}}]| (?:at|AT) (?=[A-Za-z0-9-]++(?:\.|{_DOT})[A-Za-z])")
_ANY = re.compile(rf"[0-9@]|{_AT_WORD.pattern}")
#: An at sign in any form, with the space around it.
_AT = re.compile(r" ?(?:@|[(\[{](?:at|AT)[)\]}]) ?| (?:at|AT) ")
_HOST_NAME = re.compile(_HOST)
_NEXT_HOST = re.compile(f"({_DOT})({_HOST})")
#: All host names after an at sign.
_HOSTS = re.compile(f" ?{_HOST}(?:{_DOT}{_HOST})*+")

Span = tuple[int, int, str]


def passes_luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _octet(part: str) -> bool:
    return len(part.lstrip("0")) <= 3 and int(part[-3:] if len(part.lstrip("0")) else "0") <= 255


def base_spans(text: str) -> list[Span]:
    """``(start, end, kind)`` of the base patterns, by start and then kind."""
    found: list[tuple[int, int, int]] = []
    last = 0
    if "@" in text:
        for m in _EMAIL_REST.finditer(text):
            begin = m.start()
            while begin > last and text[begin - 1] in _LOCAL:
                begin -= 1
            if begin < m.start():
                found.append((begin, 0, m.end()))
                last = m.end()
    for m in _IP.finditer(text):
        if all(_octet(p) for p in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and passes_luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGITS.sub("", m.group())) <= 15:
                found.append((m.start(), 3, m.end()))
    return [(s, e, KINDS[k]) for s, k, e in sorted(found)]


# ---- islands and candidates

_ATOM = re.compile(r"[0-9]+|[A-Za-z]+|\s+|.", re.S)
#: Marks that may stand inside an entity.
_MARKS = frozenset("@.-_+()[]{}/ \t")


#: What an entity may consist of between two spaces.
_SOLID = _LOCAL | _MARKS - set(" \t")
_SOLID_RUN = re.compile(r"[A-Za-z0-9._%+@()\[\]{}/-]*+")


def islands(text: str, reach: int = 48) -> list[tuple[int, int]]:
    """Stretches worth a search, in order and apart from each other.

    They reach a few dozen characters around every digit run and at sign, also one written
    out, and from there to the end of what stands without a space, and of the host names
    after an at sign. Every character is looked at a bounded number of times.
    """
    out: list[list[int]] = []
    at = hosts = 0
    while m := _ANY.search(text, at):
        at = m.end()
        while at < len(text) and "0" <= text[at] <= "9":
            at += 1
        end = min(len(text), at + reach)
        if not m.group().isdigit() and at >= hosts and (names := _HOSTS.match(text, at)):
            hosts = names.end()
            end = max(end, hosts)
        floor = out[-1][1] if out else 0
        if end <= floor:
            continue
        if text[end - 1] in _SOLID:
            end = _SOLID_RUN.match(text, end).end()
        begin = max(floor, m.start() - reach)
        while floor < begin < len(text) and text[begin] in _SOLID and text[begin - 1] in _SOLID:
            begin -= 1
        if out and begin <= floor:
            out[-1][1] = end
        else:
            out.append([begin, end])
    return [(b, e) for b, e in out]


def atoms(text: str, begin: int, end: int) -> list[tuple[int, int]]:
    """``text[begin:end]`` in pieces without a gap; an address has one for each of its parts."""
    out: list[tuple[int, int]] = []
    at = begin

    def plain(stop: int) -> None:
        out.extend(m.span() for m in _ATOM.finditer(text, at, stop))

    for m in _AT.finditer(text, begin, end):
        sign, after = m.span()
        if sign < at:  # among the host names of the sign before
            continue
        last = sign
        while last > at and text[last - 1] in "._%+-":
            last -= 1
        first = last
        while first > at and text[first - 1] in _LOCAL:
            first -= 1
        while first < last and text[first] in "._%+-":
            first += 1
        plain(first)
        if first < last:
            out.append((first, last))
        at = last
        plain(sign)
        out.append((sign, after))
        at = after
        if names := _HOST_NAME.match(text, at, end):
            out.append(names.span())
            at = names.end()
            while names := _NEXT_HOST.match(text, at, end):
                out += [names.span(1), names.span(2)]
                at = names.end()
    plain(end)
    return out


def has_at(span: str) -> bool:
    return _AT.search(span) is not None


def segment_features(text: str, begin: int, end: int) -> tuple[str, ...] | None:
    """Features of a whole span, or None where no entity can be."""
    span = text[begin:end]
    digits = [c for c in span if "0" <= c <= "9"]
    n = len(digits)
    at = has_at(span)
    letters = sum(c.isalpha() for c in span)
    if not at and (letters or not 4 <= n <= 20):  # letters stand in addresses only
        return None
    groups = re.findall(r"[0-9]+", span)
    sizes = "-".join(str(min(len(g), 20)) for g in groups[:6])
    gaps = "".join(sorted(set(re.sub(r"[0-9A-Za-z]", "", span))))[:8]
    before, after = text[begin - 1 : begin], text[end : end + 1]
    edge = ("w" if before.isalnum() else "m" if before in "-_/.+@#$%&=\"'" and before else "s") + (
        "w" if after.isalnum() else "m" if after in "-_/@=" and after else "s"
    )
    out = [
        f"n{min(n, 20)}" if not at else "at",
        f"g{sizes}" if not at else f"ga{'d' if re.search(r'[.]|dot|DOT', span) else ''}",
        f"m{gaps}" if not at else "ma",
        f"e{edge}",
        f"l{min(letters, 3)}{'a' if at else ''}",
        "plus" if span[0] == "+" else "zz" if groups and span.startswith("00") else "nop",
    ]
    if not letters and not at:
        if 12 <= n <= 19:
            out.append("luhn" if passes_luhn("".join(digits)) else "noluhn")
        if len(groups) == 4:
            out.append("octets" if all(_octet(g) for g in groups) else "nooctets")
        if 9 <= n <= 15:
            out.append("phonelong")
    if at:
        sign = _AT.search(span)
        local, rest = span[: sign.start()], re.sub(_DOT, ".", span[sign.end() :])
        out.append("mail" if re.fullmatch(r"[A-Za-z0-9._%+-]+", local) and re.fullmatch(r"[A-Za-z0-9-]+(\.[A-Za-z]{2,})+", rest) else "nomail")
        out.append("more" if _NEXT_HOST.match(text, end) else "done")
    return tuple(out)


class Field:
    """Weights by (feature, kind), with likelihood training and decoding."""

    def __init__(self, weights: dict[str, np.ndarray] | None = None, outside: float = 0.0):
        self.weights = weights or {}
        self.outside = outside

    def score(self, features: tuple[str, ...]) -> np.ndarray:
        total = np.full(len(KINDS), -1.0)
        for f in features:
            if (w := self.weights.get(f)) is not None:
                total = total + w
            else:
                total = total - 0.5  # a shape never seen in training is less likely to be an entity
        return total

    def candidates(self, text: str, cells: list[tuple[int, int]]) -> Iterator[tuple[int, int, tuple[str, ...]]]:
        """``(first, end, features)`` in atoms, for every segment that may be an entity."""
        sign, signs = len(cells) + MAX_ATOMS, []  # for every atom, the next that is an at sign
        for begin, end in reversed(cells):
            if text[begin] in " @([{" and _AT.fullmatch(text, begin, end):
                sign = len(cells) - 1 - len(signs)
            signs.append(sign)
        for i, (begin, _) in enumerate(cells):
            head = text[begin]
            if not (head.isalnum() or head in "+("):
                continue
            addressed = signs[-1 - i] < i + MAX_ATOMS
            for j in range(i + 1, min(len(cells), i + MAX_ATOMS) + 1):
                b, e = cells[j - 1]
                if e - begin > MAX_CHARS:
                    break
                last = text[b]
                if not (last.isascii() and last.isalnum() or last in _MARKS) or last.isalpha() and not addressed:
                    break
                if not last.isalnum():
                    continue
                if features := segment_features(text, begin, e):
                    yield i, j, features

    def decode(self, text: str, begin: int, end: int, fixed: list[Span]) -> list[Span]:
        """The best segmentation of one island; fixed spans are kept whole and free of others."""
        cells = atoms(text, begin, end)
        taken = [any(s < stop and start < e for start, stop, _ in fixed) for s, e in cells] if fixed else [False] * len(cells)
        blocked = np.concatenate([[0], np.cumsum(taken)])
        by_end: dict[int, list[tuple[int, float, int]]] = {}
        for i, j, features in self.candidates(text, cells):
            if blocked[j] - blocked[i]:
                continue
            scores = self.score(features)
            kind = int(scores.argmax())
            if scores[kind] > 0:  # a segment that scores below leaving its atoms outside never wins
                by_end.setdefault(j, []).append((i, float(scores[kind]), kind))
        if not by_end:
            return []
        best, back = [0.0], [None]
        for j in range(1, len(cells) + 1):
            top, how = best[j - 1], None
            for i, score, kind in by_end.get(j, ()):
                if best[i] + score > top:
                    top, how = best[i] + score, (i, kind)
            best.append(top)
            back.append(how)
        out, j = [], len(cells)
        while j:
            if back[j] is None:
                j -= 1
            else:
                i, kind = back[j]
                out.append((cells[i][0], cells[j - 1][1], KINDS[kind]))
                j = i
        return out[::-1]

    def learn(self, examples: list[tuple[str, list[Span]]], rounds: int = 30, rate: float = 0.3, decay: float = 1e-3) -> Field:
        """Ascend the conditional likelihood of the labelled segmentations (forward and backward sums)."""
        index: dict[str, int] = {}
        cases = []
        for text, gold in examples:
            cells = atoms(text, 0, len(text))
            segments = list(self.candidates(text, cells))
            truth = {(s, e): KINDS.index(k) for s, e, k in gold}
            rows = [[index.setdefault(f, len(index)) for f in fs] for _, _, fs in segments]
            label = [truth.get((cells[i][0], cells[j - 1][1]), -1) for i, j, _ in segments]
            cases.append((len(cells), [(i, j) for i, j, _ in segments], rows, label))
        w = np.zeros((len(index), len(KINDS)))
        history = np.full_like(w, 1e-8)
        for _ in range(rounds):
            grad = -decay * w
            for n, spans, rows, label in cases:
                if not spans:
                    continue
                scores = np.array([w[r].sum(axis=0) - 1.0 for r in rows])
                weight = np.exp(np.clip(scores, -40, 40))
                whole = weight.sum(axis=1)
                ahead, behind = np.zeros(n + 1), np.zeros(n + 1)
                ahead[0] = behind[n] = 1.0
                ending: dict[int, list[int]] = {}
                starting: dict[int, list[int]] = {}
                for k, (i, j) in enumerate(spans):
                    ending.setdefault(j, []).append(k)
                    starting.setdefault(i, []).append(k)
                for j in range(1, n + 1):
                    ahead[j] = ahead[j - 1] + sum(ahead[spans[k][0]] * whole[k] for k in ending.get(j, ()))
                for i in range(n - 1, -1, -1):
                    behind[i] = behind[i + 1] + sum(behind[spans[k][1]] * whole[k] for k in starting.get(i, ()))
                for k, (i, j) in enumerate(spans):
                    change = -weight[k] * (ahead[i] * behind[j] / ahead[n])
                    if label[k] >= 0:
                        change[label[k]] += 1.0
                    for r in rows[k]:
                        grad[r] += change
            grad /= len(cases) or 1
            history += grad * grad
            w += rate * grad / np.sqrt(history)
        return Field({f: w[k] for f, k in index.items()})


# ---- labelled snippets


def _luhn_number(rng: random.Random, n: int, right: bool = True) -> str:
    body = rng.choice("3456") + "".join(rng.choice("0123456789") for _ in range(n - 2))
    for check in rng.sample("0123456789", 10):
        if passes_luhn(body + check) == right:
            return body + check
    return body + "0"


def labelled_snippets(n: int = 500, seed: int = 5) -> list[tuple[str, list[Span]]]:
    """Seeded examples: entities in many notations, and numbers that are none."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(2, 8)))
    digits = lambda k: "".join(rng.choice("0123456789") for _ in range(k))

    def mail() -> str:
        at = rng.choice(["@", " @ ", " at ", " (at) ", "(at)", "[at]", " [at] "])
        dot = rng.choice([".", ".", " dot ", " (dot) ", "[dot]"]) if at != "@" else "."
        local = rng.choice([word(), word() + "." + word(), word() + digits(2), "-".join(word() for _ in range(rng.randint(2, 9)))])
        host = rng.choice([word(), word(), word() + "-" + word(), word() + dot + word()])
        if rng.random() < 0.1:
            at, dot = at.upper(), dot.upper()
        return local + at + host + dot + rng.choice(["com", "org", "net", "de", "fr"])

    def address() -> str:
        join = rng.choice([".", ".", "[.]", " . "])
        return join.join(str(rng.randint(0, rng.choice([9, 99, 255]))) for _ in range(4))

    def card() -> str:
        number, gap = _luhn_number(rng, 16), rng.choice(["", " ", "-", ".", "/"])
        return gap.join(number[i : i + 4] for i in range(0, 16, 4))

    def phone() -> str:
        shape = rng.choice(["(ddd) ddd-dddd", "ddd-ddd-dddd", "ddd.ddd.dddd", "00dd ddd ddddddd", "+d (ddd) ddd-dddd", "0ddd ddddddd", "+d-ddd-ddd-dddd"])
        return "".join(digits(1) if c == "d" else c for c in shape)

    def none() -> str:
        return rng.choice(
            [
                f"{rng.randint(1900, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}",
                f"{rng.randint(1, 28)}.{rng.randint(1, 12)}.{rng.randint(1900, 2030)}",
                f"{rng.randint(1, 99)}:{digits(2)}:{digits(2)}",
                f"{digits(3)},{digits(3)}.{digits(2)}",
                f"v{rng.randint(1, 9)}.{rng.randint(0, 20)}.{rng.randint(0, 99)}",
                f"{rng.randint(1, 9)}.{rng.randint(0, 20)}.{rng.randint(300, 999)}.{rng.randint(256, 999)}",
                digits(4), digits(5), digits(6), digits(8), digits(9), digits(10), digits(13), digits(20),
                _luhn_number(rng, 16, False),
                f"{digits(4)} {digits(4)}", f"{digits(4)}-{digits(4)}",
                f"{digits(3)} {digits(3)} {digits(3)} {digits(3)}",
                " ".join(digits(rng.randint(1, 3)) for _ in range(8)),
                hashlib.sha1(digits(6).encode()).hexdigest(),
                f"look at {word()} dot",
                f"{digits(4)} - {digits(4)}",
                f"978-{digits(1)}-{digits(4)}-{digits(4)}-{digits(1)}",
                f"#{digits(7)}", f"${digits(4)}.{digits(2)}",
            ]
        )

    makers = (mail, address, card, phone)
    out = []
    for k in range(n):
        text, gold = "", []
        for _ in range(rng.randint(1, 3)):
            text += " ".join(word() for _ in range(rng.randint(1, 3))) + rng.choice([" ", " ", ": ", ", "])
            if rng.random() < 0.5:
                kind = rng.randrange(4)
                value = makers[kind]()
                gold.append((len(text), len(text) + len(value), KINDS[kind]))
                text += value
            else:
                text += none()
            text += rng.choice([" ", ". ", ", ", "\n"])
        out.append((text + word(), gold))
    return out


@lru_cache(maxsize=1)
def trained_field(snippets: int = 500, seed: int = 5) -> Field:
    """The field used by default; fitted once in a process, the same way every time."""
    return Field().learn(labelled_snippets(snippets, seed))


# ---- over documents

SPANS = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
    "spans_list array<struct<start:long,stop:long,kind:string>>"
)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def all_spans(text: str, field: Field) -> tuple[list[Span], list[Span]]:
    """Base spans, and these together with what the field adds."""
    if not _ANY.search(text):
        return [], []
    base = base_spans(text)
    added = []
    for begin, end in islands(text):
        inside = [s for s in base if s[0] < end and begin < s[1]]
        added += field.decode(text, begin, end, inside)
    return base, sorted(base + added, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def find_private(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """Counts and digest of the base spans, and all spans, for every row of ``docs``.

    Offsets are code points, ends exclusive. A null or empty text has no spans, zero
    counts and the digest of the empty string. Repeated rows give equal rows; other
    columns are ignored.
    """
    field = field or trained_field()
    names = [c.split()[0] for c in SPANS.split(", ")]
    struct = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("kind", pa.string())]))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            rows = []
            for text in part.column(1).to_pylist():
                base, spans = all_spans(text or "", field)
                counts = [sum(k == kind for _, _, k in base) for kind in KINDS]
                listed = [{"start": s, "stop": e, "kind": k} for s, e, k in spans]
                rows.append((*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans), listed))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [struct]
            yield pa.RecordBatch.from_arrays(
                [part.column(0).cast(pa.int64()), *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))], names=names
            )

    return docs.select("doc_id", "text").mapInArrow(measure, SPANS)


def mask(text: str, spans: list[Span]) -> str:
    """``text`` with every span replaced by its kind in angle brackets; of overlapping ones the first, then longest."""
    out, at = [], 0
    for start, end, kind in sorted(spans, key=lambda s: (s[0], -s[1])):
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def masked_text(field: Field | None = None):
    """A column function from a text to the text without its personal data (null stays null)."""
    field = field or trained_field()

    @F.pandas_udf("string")
    def without(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t if t is None or not _ANY.search(t) else mask(t, all_spans(t, field)[1]))

    def apply(text: Column) -> Column:
        return without(text)

    return apply
