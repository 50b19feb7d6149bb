"""Main text of web pages by equivalence-class template deduction.

The tokens of a page are its structural tags, told apart by their path of tags, classes and ids. For
each host the tokens are grouped by their occurrence vector, the number of times they occur in each
page: tokens with the same vector over enough pages form an equivalence class. Classes whose tokens
hang below tokens of valid classes nest into the host's template. An article or main element that
nearly every page of the host has once is the article slot, and what lies outside it goes, constant or
not; otherwise the deepest slot that leaves out no text but the host's constant text and lists of links.

Vectors are never collected: a vector is compared by the exclusive or of hashes of (page, count),
which Spark sums up per host and token with partial aggregation. Pages aren't shuffled by host
unless the templates are too large for Spark to broadcast. What menus, adverts, comments and the
like are called is fixed below and is cut on every page first, never around an article; pages of hosts
with too few pages, or without their host's article slot, go by these names alone.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from firmalign.llm.common import cut_lineage, cut_rows, map_arrow, table, texts_of

#: A class is valid with so many pages, and this share of the pages of its host.
LEAST_PAGES, LEAST_SHARE = 3, 0.5
#: A slot of links has this share of its text in links.
LINK_SHARE = 0.6

# Names from the HTML standard and usual class names.
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s "
                   "samp small span strike strong sub sup time tt u var img wbr svg math path".split())
CLOSED_BY_BLOCK = frozenset("p li dt dd tr td th option h1 h2 h3 h4 h5 h6 pre blockquote".split())
CHROME_TAGS = frozenset("nav footer aside form script style noscript iframe template head title "
                        "button select textarea option input dialog menu svg canvas object".split())
CHROME_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar "
    "navigation menu sidebar side aside widget footer foot header masthead topbar toolbar cookie cookies "
    "consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login "
    "social share sharing related recommended breadcrumb breadcrumbs pagination pager comment comments "
    "reply replies disqus respond discussion search form skip legal copyright".split())
MAIN_NAMES = frozenset("main".split())
#: Words that say nothing of their own next to one of the names above.
PLAIN_NAMES = frozenset(
    "box list block wrap wrapper section area container bar item items link links post posts article "
    "articles entry story news user users reader readers inner outer content contents top bottom left "
    "right fixed sticky site page pages global main primary secondary group panel row col column text "
    "title heading icon button btn image img unit slot zone body count form".split())

_TAG = re.compile(
    r"<!--.*?-->|<!--.*|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.DOTALL)
_MAIN_TAG = re.compile(r"<(?:article|main)(?=[\s/>])", re.I)
_NAMES = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_DIGITS = re.compile(r"\d+")
_HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")
_SPACES = re.compile(r"\s+")


def host_of(url: str | None) -> str:
    match = _HOST.match(url or "")
    return match[1].lower() if match else ""


def _signed(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "replace")) - (1 << 63)


def _named(attributes: str) -> dict[str, str]:
    return {k.lower(): a or b or c for k, a, b, c in _NAMES.findall(attributes)} if attributes else {}


def _chrome_words(names: dict[str, str]) -> set[str]:
    """The fixed names an element goes by. A compound name counts if the rest of it says nothing, so
    ``comment-list`` does and ``has-sidebar`` and ``related-work`` don't."""
    found: set[str] = set()
    for value in names.values():
        for name in value.split():
            parts = {p.lower() for p in _PARTS.findall(name)}
            if parts <= CHROME_NAMES | PLAIN_NAMES:
                found |= parts & CHROME_NAMES
    return found


class Element:
    __slots__ = ("tag", "role", "chrome", "main", "chars", "links", "said", "own", "words")

    def __init__(self, tag: str, attributes: str, parent: Element | None, holds_main: bool):
        names = _named(attributes)
        label = _DIGITS.sub("0", " ".join(f"{k}={names[k]}" for k in sorted(names)))
        self.tag = tag
        self.role = _signed(f"{parent.role if parent else 0} {tag} {label}")
        words = {p.lower() for k in ("class", "id", "role") if k in names
                 for p in _PARTS.findall(names[k])}
        self.main = tag in ("article", "main") or bool(words & MAIN_NAMES)
        inside = parent is not None and parent.chrome
        chrome = _chrome_words(names)
        if parent is not None and parent.main:      # an article may have a header of its own
            chrome -= {"header"}
        own = tag in CHROME_TAGS or (tag not in ("html", "body") and bool(chrome) and not holds_main
                                     and not (self.main and not chrome & {"comment", "comments"}))
        header = tag == "header" and not (parent is not None and parent.main)
        self.chrome = inside or own or header
        self.main = (self.main or (parent is not None and parent.main)) and not self.chrome
        self.chars = self.links = self.said = self.own = self.words = 0


def _end_of(tag: str, html: str, at: int) -> int:
    """Where an element opened before ``at`` ends: at its end tag, or where a block ends a paragraph."""
    paragraph = tag == "p" or tag in ("h1", "h2", "h3", "h4", "h5", "h6")
    depth = 1
    for match in re.compile(rf"<(/?){tag}(?=[\s/>])" + "|<(?:/?)(?:div|section|article|main|body|html)(?=[\\s/>])"
                            * (paragraph or tag in INLINE), re.I).finditer(html, at):
        if match[1] is None or (paragraph and not match[1]):
            return match.start()
        depth += -1 if match[1] else 1
        if not depth:
            end = html.find(">", match.end())
            return end + 1 if end >= 0 else len(html)
    return len(html)


def events(html: str) -> Iterator[tuple]:
    """("open", element), ("close", element), ("break",), ("link", on) and ("text", text), in order.

    Elements that need no end tag are closed by the block that follows, and end tags without a
    start are passed over, so every opened element is closed in the end.
    """
    stack: list[Element] = []
    at, end = 0, len(html)
    while at < end:
        match = _TAG.search(html, at)
        if not match:
            yield "text", html[at:]
            break
        if match.start() > at:
            yield "text", html[at:match.start()]
        at = match.end()
        tag = (match[2] or match[5] or "").lower()
        if not tag:
            continue
        closing, attributes = match[1] or match[4], match[3] or match[6] or ""
        if tag == "a":
            yield "link", not closing
        if tag in INLINE:
            if attributes and not closing and tag not in VOID and _chrome_words(_named(attributes)):
                at = _end_of(tag, html, at)
            continue
        yield ("break",)
        if tag in VOID:
            continue
        if tag in CLOSED_BY_BLOCK:        # blocks of text, but no tokens of a template
            if attributes and not closing and _chrome_words(_named(attributes)):
                at = _end_of(tag, html, at)
            continue
        if closing:
            if any(e.tag == tag for e in stack):
                while True:
                    gone = stack.pop()
                    yield "close", gone
                    if gone.tag == tag:
                        break
            continue
        if attributes.endswith("/") and tag in ("svg", "path", "iframe"):
            continue
        if tag in RAW:
            stop = re.compile(f"</{tag}", re.I).search(html, at)
            at = stop.start() if stop else end
            skip = html.find(">", at)
            at = skip + 1 if skip >= 0 else end
            continue
        holds_main = bool(attributes) and tag not in CHROME_TAGS and bool(
            _MAIN_TAG.search(html, at, _end_of(tag, html, at)))
        element = Element(tag, attributes, stack[-1] if stack else None, holds_main)
        stack.append(element)
        yield "open", element
    while stack:
        yield "close", stack.pop()


def _joined(said: int, more: int) -> int:
    """The hash, as a bigint, of a text and the one that follows it."""
    return (said * 1_000_003 + more + (1 << 63)) % (1 << 64) - (1 << 63)


def page_tokens(html: str) -> list[tuple]:
    """(role, parent role, times, characters of text, of these in links, hash of the text, 1 in main
    or article, characters outside other tokens, their hash) of each token of a page."""
    found: dict[int, list] = {}
    stack: list[Element] = []
    link = 0
    for kind, *rest in events(html):
        if kind == "open":
            own = found.setdefault(rest[0].role, [stack[-1].role if stack else 0, 0, 0, 0, 0,
                                                 int(rest[0].main), 0, 0])
            own[1] += 1
            stack.append(rest[0])
        elif kind == "close":
            gone = stack.pop()
            own = found[gone.role]
            own[2] += gone.chars
            own[3] += gone.links
            own[4] = _joined(own[4], gone.said)
            own[6] += gone.own
            own[7] = _joined(own[7], gone.words)
            if stack and not gone.chrome:
                stack[-1].chars += gone.chars
                stack[-1].links += gone.links
                stack[-1].said = _joined(stack[-1].said, gone.said)
        elif kind == "link":
            link = rest[0]
        elif kind == "text" and stack and not stack[-1].chrome:
            own_text = rest[0].strip()
            n = len(own_text)
            if n:
                stack[-1].said = _joined(stack[-1].said, _signed(own_text))
                stack[-1].own += n
                stack[-1].words = _joined(stack[-1].words, _signed(own_text))
            stack[-1].chars += n
            stack[-1].links += n * link
    return [(role, *own) for role, own in found.items()]


def main_text(html: str, article: int | None = None, dropped: frozenset = frozenset()) -> str:
    """Text of the article slot, or without one of main, article or body, by blocks."""
    texts: dict[str, list] = {"slot": [], "main": [], "all": []}
    block: list[str] = []
    depth, skipped = 0, 0
    stack: list[Element] = []

    def flush():
        if block:
            text = _SPACES.sub(" ", entities.unescape("".join(block))).strip()
            block.clear()
            if text:
                where = ["all"] + ["main"] * (stack[-1].main if stack else False)
                for name in where + ["slot"] * (depth > 0):
                    texts[name].append(text)

    for kind, *rest in events(html):
        if kind == "text":
            if not skipped and not (stack and stack[-1].chrome):
                block.append(rest[0])
        elif kind == "break":
            flush()
        elif kind == "open":
            flush()
            element = rest[0]
            stack.append(element)
            depth += element.role == article
            skipped += element.role in dropped
        elif kind == "close":
            flush()
            element = stack.pop()
            depth -= element.role == article
            skipped -= element.role in dropped
    flush()
    return "\n".join(texts["slot"] or texts["main"] or texts["all"])


TOKENS = ("host string, page bigint, roles array<bigint>, parents array<bigint>, marks array<bigint>, "
          "chars array<bigint>, links array<bigint>, once array<int>, said array<bigint>, "
          "main array<int>, own array<bigint>, words array<bigint>")


def _tokens(batches) -> Iterator[list]:
    for batch in cut_rows(batches):
        rows = []
        for page_id, url, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                      texts_of(batch.column(2)), strict=True):
            own = page_tokens(html)
            rows.append((host_of(url), page_id, [t[0] for t in own], [t[1] for t in own],
                         [_signed(f"{page_id} {url} {t[2]}") for t in own], [t[3] for t in own],
                         [t[4] for t in own], [int(t[2] == 1) for t in own], [t[5] for t in own],
                         [t[6] for t in own], [t[7] for t in own], [t[8] for t in own]))
        yield [list(c) for c in zip(*rows, strict=True)]


def deduce(pages: DataFrame, least_pages: int = LEAST_PAGES,
           least_share: float = LEAST_SHARE) -> DataFrame:
    """The template of each host: host, n_pages, article (role), dropped and template (roles)."""
    tokens = cut_lineage(map_arrow(pages.select(
        F.col("page_id").cast("bigint"), F.col("url").cast("string"),
        F.col("html").cast("string")), _tokens, TOKENS), "page-tokens")
    hosts = tokens.groupBy("host").agg(F.count(F.lit(1)).alias("n_pages"))
    each = tokens.select("host", F.explode(F.arrays_zip(
        "roles", "parents", "marks", "chars", "links", "once", "said", "main", "own",
        "words")).alias("t"))
    roles = each.groupBy("host", F.col("t.roles").alias("role")).agg(
        F.count(F.lit(1)).alias("support"), F.bit_xor("t.marks").alias("vector"),
        F.first("t.parents").alias("parent"), F.sum("t.chars").alias("chars"),
        F.sum("t.links").alias("links"), F.sum("t.once").alias("once"),
        (F.min("t.said") == F.max("t.said")).alias("constant"), F.max("t.main").alias("main"),
        F.when(F.min("t.words") != F.max("t.words"), F.sum("t.own")).otherwise(0).alias("own"))
    roles = cut_lineage(roles.join(hosts, "host").withColumn(
        "often", (F.col("support") >= least_pages)
        & (F.col("support") >= F.col("n_pages") * F.lit(least_share))), "page-roles")
    # The text of slots that few pages have counts as text of the slot around them.
    rare = roles.where("NOT often AND chars > 0").groupBy("host", F.col("parent").alias("role")).agg(
        F.sum("chars").alias("rare"))
    # A host keeps at most 1 / least_share times the tokens of a page on average.
    frequent = roles.where("often").drop("often").join(rare, ["host", "role"], "left").withColumn(
        "own", F.col("own") + F.coalesce("rare", F.lit(0))).drop("rare")
    return cut_lineage(frequent.groupBy("host").applyInPandas(
        _template, "host string, n_pages bigint, article bigint, dropped array<bigint>, "
                   "template array<bigint>"), "templates")


def _template(rows: pd.DataFrame) -> pd.DataFrame:
    """Nest the valid classes of one host and choose its article slot."""
    rows = rows.assign(**{c: 0 for c in ("own", "constant", "main") if c not in rows})
    by_role = {r.role: r for r in rows.itertuples()}
    valid: dict[int, bool] = {}

    def nested(role: int) -> bool:
        chain = []
        while role and role not in valid:
            chain.append(role)
            role = by_role[role].parent if role in by_role else None
        good = role == 0 or (role is not None and valid.get(role, False))
        for r in reversed(chain):
            good = valid[r] = good and r in by_role
        return good

    template = [r for r in by_role if nested(r)]
    roots = [r for r in template if by_role[r].parent == 0]
    article, dropped = None, []
    if roots:
        root = max(roots, key=lambda r: (by_role[r].chars, r))
        article, vector = root, by_role[root].vector
        aside = lambda r: not by_role[r].main and by_role[r].chars and (
            by_role[r].constant or by_role[r].links >= LINK_SHARE * by_role[r].chars)
        # An article or main element of the root's class, or near it, is the slot: what the host's pages
        # have outside it is no part of the article, whether it is constant or not.
        whole = [r for r in template if by_role[r].main and by_role[r].chars
                 and by_role[r].parent in by_role and not by_role[by_role[r].parent].main
                 and by_role[r].once == by_role[r].support
                 and by_role[r].support >= 0.9 * by_role[root].support] if not by_role[root].main else []
        if whole:
            article = max(whole, key=lambda r: (by_role[r].chars, r))
        while not whole:
            # Tokens of the root's own class, or near it, that occur once in a page.
            children = [r for r in template if by_role[r].parent == article]
            left = by_role[article].own + sum(by_role[r].chars for r in children if not aside(r))
            inner = [r for r in children if not aside(r)
                     and (by_role[r].vector == vector
                          or by_role[r].once == by_role[r].support
                          and by_role[r].support >= 0.9 * by_role[root].support)
                     and by_role[r].chars >= max(left, 1)]
            if not inner:
                break
            article = max(inner, key=lambda r: (by_role[r].chars, r))
        below = {article}
        grew = True
        while grew:
            more = {r for r in template if by_role[r].parent in below} - below
            below |= more
            grew = bool(more)
        dropped = [r for r in below - {article} if not by_role[article].main and aside(r)
                   and not by_role[root].constant]
        if not by_role[root].chars:
            article = None
    return pd.DataFrame({"host": [rows["host"].iloc[0]], "n_pages": [int(rows["n_pages"].iloc[0])],
                         "article": pd.array([article], "Int64"), "dropped": [sorted(dropped)],
                         "template": [sorted(template)]})


def extract_text(pages: DataFrame, templates: DataFrame) -> DataFrame:
    """page_id, url and the main text of every page: empty where there is none.

    A missing html is an empty page, a missing url belongs to a host without a name, and a missing
    page_id is kept. Repeated rows each give a row; other columns are ignored.
    """
    known = templates.where("article IS NOT NULL").select("host", "article", "dropped")
    host = F.lower(F.regexp_extract("url", _HOST.pattern, 1))
    joined = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url",
                          F.col("html").cast("string").alias("html")).withColumn(
        "host", F.coalesce(host, F.lit(""))).join(known, "host", "left")

    def run(batches) -> Iterator[list]:
        for batch in cut_rows(batches):
            texts = [main_text(html, article, frozenset(dropped or ())) for html, article, dropped
                     in zip(texts_of(batch.column(2)), batch.column(3).to_pylist(),
                            batch.column(4).to_pylist(), strict=True)]
            yield [batch.column(0), batch.column(1), texts]

    return map_arrow(joined.select("page_id", F.col("url").cast("string"), "html", "article",
                                   "dropped"), run, "page_id bigint, url string, text string")


def op8_main_text(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract_text(pages, deduce(pages)).withColumn(
        "n_chars", F.length("text").cast("bigint"))
