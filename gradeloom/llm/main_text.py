"""Main text of web pages: the maximum-scoring contiguous stretch of words and tags.

A page is a sequence of words and tags. Words score by where they stand (paragraph,
heading, link, inside a menu, a notice, ...), tags score negative; the scores are log
ratios counted on labelled pages. One linear scan finds the stretch with the highest
sum. Inside it, what stands in a menu, advert, form or comment thread is left out.
"""

from __future__ import annotations

import html
import random
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gradeloom.llm.common import slices

_NAME = re.compile(r"/?([A-Za-z][A-Za-z0-9:-]*)")
_STOP = re.compile("[\"'>]")
#: Elements whose content is no markup, each with the pattern of its end.
_RAW = {
    name: re.compile(rf"</{name}\s*>", re.I)
    for name in "script style title noscript template iframe textarea select svg object math".split()
}
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|aria-label|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)

#: Elements that run on inside a line of text; all others part words.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that never hold main text.
APART = {"nav": "menu", "menu": "menu", "footer": "footer", "aside": "sidebar", "form": "form", "button": "form", "dialog": "notice", "head": "head", "header": "header", "fieldset": "form"}
#: Words in a class, id or role that tell what an element is.
SIGNS = (
    ("menu", "nav navbar navigation menu breadcrumb breadcrumbs topbar toolbar pagination pager tabs skip toc"),
    ("header", "header masthead banner branding logo"),
    ("footer", "footer foot copyright colophon legal"),
    ("sidebar", "sidebar side aside related recommended recommendations widget popular trending promo teaser more complementary contentinfo rail"),
    ("notice", "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe signup paywall disclaimer"),
    ("advert", "ad ads adv advert advertisement adsense sponsor sponsored sponsors banner-ad adbox ad-slot"),
    ("comments", "comment comments disqus respond reply replies discussion"),
    ("form", "form search searchform login share sharing social"),
)
_SIGN = {word: kind for kind, words in SIGNS for word in words.split()}
#: A wrapper named after what the page has ("has-sidebar") is not that itself.
_PAGE_SIGN = frozenset("has with no without".split())
_MAIN_SIGN = frozenset("article main content post entry story body text".split())
NOT_MAIN = frozenset(f"in {k}" for k in (*APART.values(), *_SIGN.values(), "link"))
#: Most that one element set apart may take from the sum, so that an advert inside an article does not cut it.
APART_LIMIT = 6.0


def _kind(name: str, attrs: str) -> str:
    """What an element is set apart as, or nothing."""
    kind = APART.get(name, "")
    if name in ("html", "body", "article", "main"):
        return ""
    if attrs:
        for key, *values in _ATTRIBUTE.findall(attrs):
            key, value = key.lower(), next((v for v in values if v), "").lower()
            if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value):
                return "notice"
            if key in ("class", "id", "role", "aria-label"):
                for word in re.findall(r"[a-z0-9]+(?:-[a-z0-9]+)*", value.replace("_", "-")):
                    if found := _SIGN.get(word):
                        return found
                    parts = word.split("-")
                    if len(parts) > 1 and not _MAIN_SIGN & set(parts) and parts[0] not in _PAGE_SIGN:
                        for part in parts:
                            if found := _SIGN.get(part):
                                return found
    return kind


def _markup(page: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """``(start, end, name, closes, attributes)`` of everything that is no text; comments and the like have no name.

    One scan forward: whether a tag ends depends on where its quotes open, so an opening that
    led nowhere is remembered, and so is the next place where anything can end.
    """
    at, n, last_end = 0, len(page), page.rfind(">")
    dead: set[int] = set()  # quotes that open and never lead to the end of a tag
    stop_from = stop = -1
    while (i := page.find("<", at)) >= 0:
        if page.startswith("<!--", i):
            end = page.find("-->", i + 4)
            at = n if end < 0 else end + 3
            yield i, at, "", False, ""
            continue
        if page[i + 1 : i + 2] in ("!", "?"):
            end = page.find(">", i) if last_end > i else -1
            at = n if end < 0 else end + 1
            yield i, at, "", False, ""
            continue
        m = _NAME.match(page, i + 1)
        at = i + 1
        if not m or last_end < i:
            continue
        closes, name = page[i + 1] == "/", m[1].lower()
        if not closes and name in _RAW:
            end = _RAW[name].search(page, page.find(">", i) + 1)
            at = end.end() if end else n
            yield i, at, name, False, ""
            continue
        place, opened = m.end(), []
        while True:
            if not stop_from <= place <= stop:
                found = _STOP.search(page, place)
                stop_from, stop = place, found.start() if found else n
            if stop == n or stop in dead:
                dead.update(opened)
                break
            if page[stop] == ">":
                at = stop + 1
                yield i, at, name, closes, page[m.end() : stop]
                break
            opened.append(stop)
            close = page.find(page[stop], stop + 1)
            if close < 0:
                dead.update(opened)
                break
            place = close + 1


#: Share of a page's words that a wrapper named like a side matter holds when it is none.
MOST_WORDS = 0.8
#: What no wrapper of the article is named after.
_NEVER_MAIN = frozenset(("comments", "menu"))


def read_page(page: str) -> list[tuple[str, str, int]]:
    """The page as ``(feature, text, apart)``: a text with its surroundings, or a tag with an empty text.

    ``apart`` numbers the outermost element set apart around a text (0: none). Texts have
    their character references decoded; ``" "`` stands for what parts words. An element that
    its class sets apart, and that holds most of the page's words, is the page's main
    element under a name of its own, and is not set apart.
    """
    pieces, wide = _read(page, frozenset())
    return _read(page, wide)[0] if wide else pieces


def _read(page: str, whole: frozenset[int]) -> tuple[list[tuple[str, str, int]], frozenset[int]]:
    """The pieces with the elements in ``whole`` (by their place) not set apart, and those that should be in it."""
    out: list[tuple[str, str, int]] = []
    stack: list[tuple[str, str, int, int]] = []  # name, kind, words before it, place where its class sets it apart (or -1)
    marked: list[int] = []  # places of the stack that have a kind
    opened: Counter[str] = Counter()
    passing: Counter[str] = Counter()  # of the marked, by what ends them early
    held: list[tuple[int, int]] = []  # words and place of elements set apart by their class
    number, inside, links, block = 0, 0, 0, "div"
    at = words = 0

    def text(raw: str) -> None:
        nonlocal words
        where = stack[marked[0]][1] if marked else "link" if links else block
        words += len(raw.split())
        out.append((f"in {where}", html.unescape(raw), inside))

    def ends_early(name: str, kind: str) -> str:
        """What ends with the page's main element: a head that was left open, a form around the page, a wrapper's mark."""
        return "head" if kind == "head" else "form" if name == "form" else "side" if name == "div" and kind == "sidebar" else ""

    def release(sorts: tuple[str, ...]) -> None:
        k = len(marked) - 1
        while any(passing[sort] for sort in sorts):
            name, kind, before, _ = stack[marked[k]]
            if (sort := ends_early(name, kind)) in sorts:
                passing[sort] -= 1
                if sort == "head":
                    opened[name] -= 1
                stack[marked[k]] = ("" if sort == "head" else name, "", before, -1)
                del marked[k]
            k -= 1

    def leave(k: int) -> None:
        for name, kind, before, place in stack[k:]:
            opened[name] -= 1
            if kind:
                passing[ends_early(name, kind)] -= 1
            if kind and place >= 0:
                held.append((words - before, place))
        del stack[k:]
        while marked and marked[-1] >= k:
            marked.pop()

    for start, end, name, closes, attrs in _markup(page):
        if start > at:
            text(page[at:start])
        at = end
        if not name:
            continue
        if name in _RAW and not closes:
            out.append((f"<{name}", " ", inside))
            continue
        if name in VOID:
            if name not in INLINE:
                out.append((f"<{name}", " ", inside))
            continue
        if name not in INLINE:
            block = name if name in ("p", "h1", "h2", "h3", "h4", "li", "td", "blockquote", "pre", "dd") and not closes else "div"
            out.append((f"<{name}", " ", inside))
        if name == "a":
            links = 0 if closes else 1
        was = bool(marked)
        if closes:
            if opened[name] > 0:
                k = len(stack) - 1
                while stack[k][0] != name:
                    k -= 1
                leave(k)
        else:
            if name in ("p", "li", "td", "tr", "dd", "dt", "option") and stack and stack[-1][0] == name:
                leave(len(stack) - 1)  # its end tag may be left out
            kind = _kind(name, attrs)
            if kind == "header" and name == "header" and (opened["article"] > 0 or opened["main"] > 0):
                kind = ""  # an article's own heading
            by_class = kind and name not in APART and kind not in _NEVER_MAIN
            if by_class and start in whole:
                kind = ""
            if name in ("body", "article", "main"):
                release(("head", "form", "side")[: 1 + ("body", "article", "main").index(name)])
            if kind:
                marked.append(len(stack))
                passing[ends_early(name, kind)] += 1
            stack.append((name, kind, words, start if by_class else -1))
            opened[name] += 1
        if marked and not was:
            number += 1
        inside = number if marked else 0
    if at < len(page):
        text(page[at:])
    leave(0)
    return out, frozenset(place for n, place in held if n > MOST_WORDS * words)


class Scorer:
    """Log ratios by feature: positive for words more often inside the main text; tags never above a small negative."""

    def __init__(self, ratios: dict[str, float]):
        self.ratios = ratios

    def __call__(self, feature: str, words: int) -> float:
        if feature[0] == "<":
            return min(self.ratios.get(feature, -0.5), -0.1)
        return words * self.ratios.get(feature, -0.5 if feature in NOT_MAIN else 0.5)


def fit_scorer(pages: list[list[tuple[str, str, bool]]]) -> Scorer:
    """Count features of ``(feature, text, is_main)`` sequences and take smoothed log ratios."""
    inside, outside = Counter(), Counter()
    for page in pages:
        for feature, text, is_main in page:
            n = 1 if feature[0] == "<" else len(text.split())
            (inside if is_main else outside)[feature] += n
    ratios = {}
    for kind in ("<", "i"):
        names = {f for f in (*inside, *outside) if f[0] == kind}
        total_in, total_out = sum(inside[f] for f in names) + len(names), sum(outside[f] for f in names) + len(names)
        for f in names:
            ratio = np.log((inside[f] + 1) / total_in) - np.log((outside[f] + 1) / total_out)
            ratios[f] = float(np.clip(ratio, -3, 3))
    return Scorer(ratios)


def best_stretch(scores: list[float]) -> tuple[int, int]:
    """Begin and end of the contiguous stretch with the largest positive sum; the first such, ``(0, 0)`` if none."""
    best, answer, total, begin = 0.0, (0, 0), 0.0, 0
    for k, score in enumerate(scores):
        if total <= 0:
            total, begin = 0.0, k
        total += score
        if total > best:
            best, answer = total, (begin, k + 1)
    return answer


def main_text(page: str, scorer: Scorer) -> str:
    pieces = read_page(page)
    scores, spent, element = [], 0.0, 0
    for feature, text, apart in pieces:
        score = scorer(feature, len(text.split()))
        if apart:
            spent = spent if apart == element else 0.0
            element = apart
            score = max(score, -APART_LIMIT - spent)
            spent += score
        scores.append(score)
    begin, end = best_stretch(scores)
    # whole lines: what is joined to the stretch without a break belongs to it
    while begin and pieces[begin - 1][0][0] != "<":
        begin -= 1
    while end < len(pieces) and pieces[end][0][0] != "<":
        end += 1
    return " ".join("".join(" " if apart else text for _, text, apart in pieces[begin:end]).split())


# ---- labelled pages


def labelled_pages(n: int = 120, seed: int = 3) -> list[list[tuple[str, str, bool]]]:
    """Seeded pages in several layouts, each piece marked as main text or not."""
    rng = random.Random(seed)
    mark = "\u2063"  # stands before every word of main text, and is taken out again

    def words(low: int, high: int, main: bool = False) -> str:
        made = ("".join(rng.choice("abcdefghijklmnoprstu") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(low, high)))
        return " ".join((mark if main else "") + w for w in made)

    def entries(k: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/{i}">{words(1, 3)}</a></li>' for i in range(k)) + "</ul>"

    out = []
    for _ in range(n):
        body = "".join(
            rng.choice(
                [f"<p>{words(10, 80, True)}</p>"] * 6
                + [f"<h2>{words(2, 6, True)}</h2>", f"<blockquote>{words(8, 30, True)}</blockquote>", f"<ul><li>{words(4, 12, True)}</li><li>{words(4, 12, True)}</li></ul>"]
                + [f'<p>{words(5, 20, True)} <a href="/x">{words(1, 3, True)}</a> <b>{words(1, 4, True)}</b></p>']
                + [f"<div>{words(10, 60, True)}</div>", f"<section><h3>{words(2, 6, True)}</h3>{words(10, 60, True)}</section>", f"{words(10, 40, True)}<br><br>{words(10, 40, True)}"]
                + [f"<table><tr><td>{words(1, 9, True)}</td><td>{words(1, 9, True)}</td></tr></table>", f"<pre>{words(5, 30, True)}</pre>", f"<h4>{words(2, 6, True)}</h4>"]
                + [f"<dl><dt>{words(1, 3, True)}</dt><dd>{words(4, 20, True)}</dd></dl>"]
                + [f'<div class="ad">{words(4, 20)}</div>', f'<aside>{words(5, 20)}</aside>']
            )
            for _ in range(rng.randint(2, 12))
        )
        holder = rng.choice([("<article>", "</article>"), ("<main>", "</main>"), ('<div class="content">', "</div>"), ('<div id="post">', "</div>")])
        page = (
            f"<html><head><title>{words(3, 8)}</title></head><body>"
            + rng.choice(["", f"<header><h1>{words(1, 3)}</h1></header>", f'<div class="header">{words(2, 5)}</div>'])
            + rng.choice([f"<nav>{entries(6)}</nav>", f'<div class="menu">{entries(8)}</div>', f"<nav>{entries(12)}</nav>"])
            + rng.choice(["", f'<div class="cookie">{words(8, 30)} <button>{words(1, 2)}</button></div>', f'<div class="ad">{words(4, 20)}</div>'])
            + holder[0] + f"<h1>{words(3, 9, True)}</h1>" + body + holder[1]
            + rng.choice(["", f'<div class="comments"><p>{words(5, 60)}</p><p>{words(5, 60)}</p></div>', f"<aside><h3>{words(2, 3)}</h3>{entries(5)}</aside>", f"<form>{words(2, 9)}<input></form>"])
            + f"<footer>{words(5, 25)} {entries(3)}</footer></body></html>"
        )
        pieces = read_page(page)
        marked = [k for k, (_, t, _) in enumerate(pieces) if mark in t]
        main = range(marked[0], marked[-1] + 1)
        out.append([(f, t.replace(mark, ""), k in main and not apart) for k, (f, t, apart) in enumerate(pieces)])
    return out


@lru_cache(maxsize=1)
def trained_scorer() -> Scorer:
    """The scorer used by default; fitted once in a process, the same way every time."""
    return fit_scorer(labelled_pages())


TEXTS = "page_id long, url string, text string, n_chars long"


def extract_pages(pages: DataFrame, scorer: Scorer | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages``.

    A null or empty page, or one without any scoring word, gives the empty text.
    Repeated rows give equal rows; other columns are ignored.
    """
    scorer = scorer or trained_scorer()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = [main_text(page or "", scorer) for page in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).cast(pa.int64()),
                    part.column(1).cast(pa.string()),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", "url", "html").mapInArrow(measure, TEXTS)
