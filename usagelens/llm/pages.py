"""Main text of web pages by the maximum-scoring subsequence.

A page is a sequence of tags and text. Words score positive, tags negative, and so do words
of links and of elements that are boilerplate by their name, role or class. A linear scan
finds the contiguous region with the highest sum; its text outside boilerplate is the main
text. The weights are learnt from pages that mark their article themselves: whenever the
best region of such a page is not the marked one, the weights move from what the scan took
to what it should have taken. The marks themselves score nothing; of a marked article that the
best region meets, all that is not boilerplate is main text. Words of classes and ids that
name containers outside the marked articles only are learnt as hints of boilerplate, next to
a first list of them. Hidden elements are boilerplate.

Blocks are the contents of block elements; white space inside one becomes a single space and
blocks are joined by an empty line.

Defined cases: a null or empty page, or one without a word that scores, gives an empty text;
unclosed comments, scripts and tags end with the page; an element that looks like boilerplate
by words of layout in its class or id only is taken for a wrapper if it holds more than half
of the page's words and an h1, a marked article or a div or section without a hint; without
pages that mark their article the first weights are used; rows that repeat a page, null ids
and other columns are left alone.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Labelled pages that the weights are learnt from, and passes over them.
LABELLED_PAGES, PASSES = 300, 8

# A quote opens a value only behind a "="; a value without its closing quote ends with the tag.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|title|textarea|noscript|template|iframe|svg|object|select)\b.*?"
    r"(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-z][a-z0-9:-]*)(?P<rest>(?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^<>])*+)(?:>|(?=<)|\Z)"
    r"|<[!?][^<>]*(?:>|(?=<)|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
# Values of a style that hide an element.
HIDING = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption dd details div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table"
    " tbody tfoot thead tr ul".split()
)
CLOSES_ITSELF = frozenset("p li dt dd tr td th option".split())
STRUCTURE = frozenset("html body main article".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements whose class or id can name a boilerplate block by one of its parts, and those where
# a whole class must.
CONTAINERS = frozenset(
    "div section aside nav header footer form ul ol dl table fieldset details menu dialog center figure".split()
)
SMALL_PARTS = frozenset("li td th tr span a button label dd dt".split())
BOILERPLATE = frozenset("nav aside footer form menu dialog button header".split())
ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert menu menubar form".split()
)
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion menu nav"
    " navbar navigation breadcrumb breadcrumbs sidebar widget widgets footer header masthead comment"
    " comments discussion discussions disqus respond replies cookie cookies consent gdpr notice notices alert popup modal overlay"
    " newsletter subscribe subscription signup login share sharing social related recommended"
    " recommendations pagination pager toolbar copyright skip search".split()
)
# Hints that wrappers of whole pages carry as well, as in "with-sidebar".
LAYOUT = frozenset(
    "banner breadcrumb breadcrumbs footer header masthead menu nav navbar navigation search sidebar skip"
    " toolbar widget widgets".split()
)
MARKS = frozenset("article main".split())
FIRST_WEIGHTS = {"word": 1.0, "link word": -0.5, "boilerplate word": -0.2, "open": -0.2, "close": -0.1}
LEAST_WORD, LEAST_TAG = 0.2, -0.05
# Labelled pages, and their share, on which a word must name outside containers to become a hint.
HINT_PAGES, HINT_SHARE = 5, 0.02


def attributes(rest: str) -> dict[str, str]:
    """Attributes of a tag; the first of a name counts."""
    out: dict[str, str] = {}
    for name, *values in ATTRIBUTE.findall(rest):
        out.setdefault(name.lower(), html.unescape("".join(values)))
    return out


def named_parts(of: dict[str, str]) -> set[str]:
    return {w for key in ("class", "id") for w in re.split(r"[^a-z]+", of.get(key, "").lower()) if w}


class Page:
    """Tokens (feature, count, text, block boundary) of a page, the token ranges of its marked
    articles, and for every container the words that name it and its range."""

    def __init__(self, page: str, hints: frozenset[str] = frozenset()) -> None:
        self.hints = HINTS | hints
        self.tokens: list[tuple] = []
        self.raw: list[tuple] = []
        self.stack: list[tuple[str, int, int, int]] = []  # name, hint, mark, container
        self.open: Counter = Counter()
        # Of every element that looks like boilerplate: the one around it, whether more than
        # words of layout say so, whether it encloses content, and its words.
        self.outer: list[int] = []
        self.sure: list[bool] = []
        self.encloses: list[bool] = []
        self.held: list[int] = []
        self.hint = -1
        self.marks: list[list] = []  # name, first, last, hint around it
        self.containers: list[list] = []  # words of class and id, first, last
        for found in TOKEN.finditer(page):
            self.take(found)
        self.close_to(0)
        self.finish()

    def close_to(self, depth: int) -> None:
        while len(self.stack) > depth:
            name, hint, mark, container = self.stack.pop()
            self.open[name] -= 1
            if hint >= 0:
                self.hint = self.outer[hint]
            if mark >= 0:
                self.marks[mark][2] = len(self.raw)
            if container >= 0:
                self.containers[container][2] = len(self.raw)

    def take(self, found: re.Match) -> None:
        text = found["text"]
        if text is not None:
            text = html.unescape(text)
            count = len(text.split())
            if self.hint >= 0:
                self.held[self.hint] += count
            # A linked heading is a heading.
            linked = self.open["a"] and not any(self.open[h] for h in HEADINGS)
            self.raw.append(("link word" if linked else "word", count, text, False, self.hint))
            return
        name = found["name"]
        if name is None:
            return
        name = name.lower()
        block = name in BLOCKS
        if found["close"]:
            if self.open[name]:
                depth = next(k for k in range(len(self.stack) - 1, -1, -1) if self.stack[k][0] == name)
                self.close_to(depth)
            self.raw.append(("close " + name, 1, " " if name in ("td", "th") else "", block, -1))
            return
        if block and self.open["p"] or name in CLOSES_ITSELF and self.open[name]:
            for k in range(len(self.stack) - 1, -1, -1):
                at = self.stack[k][0]
                if at == name and name in CLOSES_ITSELF or block and at == "p":
                    self.close_to(k)
                    break
                if at in BLOCKS and at not in CLOSES_ITSELF:
                    break
        self.raw.append(("open " + name, 1, " " if name in ("br", "td", "th") else "", block, -1))
        if name not in VOID and not found["rest"].endswith("/"):
            self.enter(name, attributes(found["rest"]))

    def enter(self, name: str, of: dict[str, str]) -> None:
        hint = mark = container = -1
        hidden = "hidden" in of or of.get("aria-hidden", "").lower() == "true" or HIDING.search(of.get("style", ""))
        if name not in STRUCTURE or hidden:
            in_article = self.open["article"] or self.open["main"]
            looks = sure = bool(hidden) or name in BOILERPLATE and not (name == "header" and in_article)
            if of.get("role", "").lower() in ROLES:
                looks = sure = True
            if name in CONTAINERS:
                named = self.hints & named_parts(of)
                looks = looks or bool(named - {"header"} if in_article else named)
                sure = sure or bool(named - LAYOUT)
            elif name in SMALL_PARTS:
                whole = {w for key in ("class", "id") for w in of.get(key, "").lower().split()}
                looks = sure = looks or bool(self.hints & whole)
            if looks:
                hint = len(self.outer)
                self.outer.append(self.hint)
                self.sure.append(bool(sure))
                self.encloses.append(False)
                self.held.append(0)
                self.hint = hint
        if hint < 0 and self.hint >= 0 and (name in MARKS or name in ("h1", "div", "section")):
            self.encloses[self.hint] = True
        if name in CONTAINERS and (words := named_parts(of)):
            container = len(self.containers)
            self.containers.append([words, len(self.raw), len(self.raw)])
        if name in MARKS:
            mark = len(self.marks)
            self.marks.append([name, len(self.raw), len(self.raw), self.hint])
        self.open[name] += 1
        self.stack.append((name, hint, mark, container))

    def finish(self) -> None:
        # What an element holds or encloses, those around it do, too, up to a sure one.
        for k in range(len(self.outer) - 1, -1, -1):
            around = self.outer[k]
            self.encloses[k] = self.encloses[k] and not self.sure[k]
            if around >= 0:
                self.held[around] += self.held[k]
                self.encloses[around] = self.encloses[around] or self.encloses[k]
        total = sum(count for feature, count, *_ in self.raw if feature.endswith("word"))
        dropped: list[bool] = []
        for k, around in enumerate(self.outer):
            wraps = 2 * self.held[k] > total and self.encloses[k]
            dropped.append(not wraps or around >= 0 and dropped[around])
        for feature, count, text, block, hint in self.raw:
            if hint >= 0 and dropped[hint]:
                feature = "boilerplate word"
            self.tokens.append((feature, count, text, block))
        kept = [m for m in self.marks if m[3] < 0 or not dropped[m[3]]]
        articles = [m for m in kept if m[0] == "article"] or kept
        # The ranges come in the order of their starts, so one loop leaves out nested ones.
        self.articles: list[tuple[int, int]] = []
        for _, first, last, _ in articles:
            if not self.articles or first >= self.articles[-1][1]:
                self.articles.append((first, last))


def parse(page: str, hints: frozenset[str] = frozenset()) -> tuple[list[tuple], tuple[int, int] | None]:
    """Tokens of a page and the token range of its marked article, None unless there is one."""
    read = Page(page, hints)
    return read.tokens, read.articles[0] if len(read.articles) == 1 else None


def learnt_hints(pages: list[Page]) -> frozenset[str]:
    """Words of classes and ids that name containers outside the marked article on many pages,
    and never one inside it or around it."""
    outside: Counter = Counter()
    inside: set[str] = set()
    marked = [page for page in pages if len(page.articles) == 1]
    for page in marked:
        (first, last), apart = page.articles[0], set()
        for words, start, end in page.containers:
            if end <= first or start >= last:
                apart |= words
            else:
                inside |= words
        outside.update(apart)
    least = max(HINT_PAGES, HINT_SHARE * len(marked))
    return frozenset(w for w, n in outside.items() if n >= least and w not in inside and len(w) > 1)


def weight(weights: dict[str, float], feature: str) -> float:
    if feature in weights:
        return weights[feature]
    kind, _, name = feature.partition(" ")
    return 0.0 if name in MARKS else weights[kind]


def best_region(tokens: list[tuple], weights: dict[str, float]) -> tuple[int, int]:
    """The first token range with the highest sum; empty if no sum is positive."""
    best, best_range, total, start = 0.0, (0, 0), 0.0, 0
    for k, (feature, count, _, _) in enumerate(tokens):
        if total <= 0:
            total, start = 0.0, k
        total += weight(weights, feature) * count
        if total > best:
            best, best_range = total, (start, k + 1)
    return best_range


def learn(pages: list[str], passes: int = PASSES) -> dict[str, float]:
    """Weights that make the marked article of the labelled pages the best region."""
    weights = dict(FIRST_WEIGHTS)
    hints = learnt_hints([Page(page) for page in pages])
    weights |= {f"hint {word}": 1.0 for word in sorted(hints)}
    labelled = [(tokens, mark) for tokens, mark in (parse(page, hints) for page in pages) if mark]
    for step in range(passes):
        rate = 0.2 / (1 + step) / max(1, len(labelled)) ** 0.5
        for tokens, (first, last) in labelled:
            start, end = best_region(tokens, weights)
            change: Counter = Counter()
            for lo, hi, sign in ((first, last, 1), (start, end, -1)):
                for feature, count, _, _ in tokens[lo:hi]:
                    change[feature] += sign * count
            for feature, amount in change.items():
                if not amount or feature.partition(" ")[2] in MARKS:
                    continue
                moved = weight(weights, feature) + rate * max(-5, min(5, amount))
                weights[feature] = (
                    max(LEAST_WORD, moved) if feature == "word" else min(LEAST_TAG, moved)
                )
    return weights


def main_text(page: str | None, weights: dict[str, float]) -> str:
    read = Page(page or "", frozenset(w[5:] for w in weights if w.startswith("hint ")))
    tokens = read.tokens
    start, end = best_region(tokens, weights)
    # Of a marked article that the region meets, nothing is lost to links or lists.
    met = [m for m in read.articles if m[0] < end and start < m[1]]
    if met and (len(read.articles) == 1 or any(m[0] <= start and end <= m[1] for m in met)):
        start, end = met[0]
    elif met:
        start, end = min(start, met[0][0]), max(end, met[-1][1])
    blocks: list[list[str]] = [[]]
    for feature, _, text, block in tokens[start:end]:
        if block:
            blocks.append([])
        if text and feature != "boilerplate word":
            blocks[-1].append(text)
    joined = (" ".join("".join(block).split()) for block in blocks)
    return "\n\n".join(block for block in joined if block)


def fit(pages: DataFrame, labelled: int = LABELLED_PAGES) -> dict[str, float]:
    """Weights from at most ``labelled`` pages that mark their article, in the order of a hash."""
    marked = pages.filter(F.col("html").rlike("(?i)<(article|main)[ >]")).withColumn(
        "place", F.xxhash64("html")
    )
    # The hashes are ranked first, so that only the pages themselves reach the driver.
    last = marked.select("place").orderBy("place").limit(labelled).agg(F.max("place")).first()[0]
    if last is None:
        return learn([])
    rows = marked.filter(F.col("place") <= last).select("html").limit(labelled).collect()
    return learn([row["html"] for row in rows])


def extract(pages: DataFrame, weights: dict[str, float], keep: list[str] | None = None) -> DataFrame:
    """``pages``, or its columns ``keep``, with the main text as ``text``. One pass without a shuffle."""
    rest = [c for c in keep or pages.columns if c != "text"]
    kinds = pages.select(*rest).schema.add("text", "string")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[rest].assign(text=[main_text(page, weights) for page in batch.html])

    return pages.select(*dict.fromkeys([*rest, "html"])).mapInPandas(run, kinds)
