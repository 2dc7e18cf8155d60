"""Main text of web pages by the container paths on which the pages of a host agree."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import bounded, small_batches, stable

#: Attributes end at the next "<" outside quotes and are never tried again, so that broken tags take linear time; a tag whose
#: quotes don't close ends at its next ">".
_ATTRS = r"(?:\"[^\"]*\"|'[^']*'|[^<>\"'])*+"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(?P<raw>script|style|noscript|template|textarea|iframe|title|svg|xmp|math)\b(?:{_ATTRS}>|[^<>]*+>).*?(?:</(?P=raw)\s*>|\Z)"
    rf"|</(?P<end>[a-z][^\s>/]*)[^<>]*>?|<(?P<tag>[a-z][^\s<>/]*)(?:(?P<attrs>{_ATTRS})>|(?P<broken>[^<>]*+)>)|<[!?/][^>]*(?:>|\Z)|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_ATTR = re.compile(r"([a-z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)

#: Elements that begin a block of text, and those that never have an end tag.
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements and class words that mark what is not the article.
OFF_TAGS = frozenset("nav footer aside form button select option fieldset dialog menu head label legend search frameset".split())
OFF_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion menu nav navbar navigation breadcrumb breadcrumbs sidebar footer foot masthead topbar notice notices alert cookie cookies "
    "consent gdpr popup modal overlay newsletter subscribe subscription share sharing social related recommended recommendations comment comments commentlist disqus reply replies respond responses discussion login signin signup "
    "register search searchbox widget toolbar pagination pager copyright contentinfo complementary hidden skip toc tags outbrain taboola paywall".split()
)
#: Of these, what an element inside a paragraph may say.
INLINE_WORDS = frozenset("ad ads adv advert adverts advertisement advertising sponsored promo hidden".split())
#: Last parts of a class that say how something is laid out, not what it is.
LAYOUT = frozenset("box list wrapper wrap container section area block link links bar inner outer form button buttons icons panel posts articles stories item items slot unit content holder group".split())
#: First parts of a class that say what something has or hasn't, not what it is.
ABOUT = frozenset("has have no not non with without is in show hide on off".split())
HEADER_WORDS = frozenset({"header", "head", "banner", "top"})
#: An element of these closes an open element of the same kind.
SELF_CLOSING = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = frozenset("ul ol dl table article section div main body blockquote aside nav footer header form figure".split())
_WORDS = re.compile(r"[a-z]+")


class Node:
    """A container: its generalised path, whether its element (``hard``) or a word of its classes (``off``) says that it is
    not of the article, what holds it, and the characters in it that may belong to an article and that may not."""

    __slots__ = ("tag", "path", "off", "hard", "good", "bad", "main", "up")

    def __init__(self, tag: str, path: str, hard: bool, off: bool, main: bool, up: Node | None):
        self.tag, self.path, self.hard, self.off, self.main, self.up = tag, path, hard, off, main, up
        self.good = self.bad = 0


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(raw)}


def _step(tag: str, attrs: dict[str, str]) -> str:
    """One step of a path: the tag and its classes, numbers in them generalised."""
    classes = sorted({re.sub(r"\d+", "0", c) for c in attrs.get("class", "").lower().split()})
    return ".".join([tag, *classes]) if classes else tag


def _hidden(attrs: dict[str, str]) -> bool:
    return "hidden" in attrs or attrs.get("aria-hidden") == "true" or bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", "")))


def _says(attrs: dict[str, str], words: frozenset[str]) -> bool:
    """Whether a class, id or role as a whole is one of ``words``, or its last part but for layout words is (site-footer, adBanner, ad-box) and its first
    doesn't only tell what there is (has-sidebar, no-comments)."""
    for name in ("class", "id", "role"):
        for token in re.sub(r"([a-z])([A-Z])", r"\1-\2", attrs.get(name, "")).lower().split():
            parts = _WORDS.findall(token)
            while len(parts) > 1 and parts[-1] in LAYOUT:
                parts.pop()
            if parts and parts[-1] in words and (len(parts) == 1 or parts[0] not in ABOUT):
                return True
    return False


def _is_off(tag: str, attrs: dict[str, str], in_main: bool) -> bool:
    if tag in ("html", "body", "article", "main"):
        return False
    return _says(attrs, OFF_WORDS) or not in_main and (tag == "header" or _says(attrs, HEADER_WORDS))


def blocks(html: str) -> tuple[list[tuple[str, list[Node]]], list[Node]]:
    """Blocks of text in page order with the containers that hold them, outermost first, and all containers."""
    root = Node("", "", False, False, False, None)
    stack, nodes, out, run = [root], [], [], []
    link = linked = 0
    mute: list = []  # an element inside a paragraph that isn't of the article, and how many of its kind are open in it

    def flush():
        nonlocal linked
        if run:
            text = " ".join(unescape("".join(run)).split())
            run.clear()
            if text:
                out.append((text, stack[1:], min(linked, len(text))))
        linked = 0

    for m in _TOKEN.finditer(html):
        kind = m.lastgroup
        if kind == "text":
            if not mute:
                run.append(m["text"])
                if link:
                    linked += len(m["text"])
        elif m["tag"]:
            tag = m["tag"].lower()
            raw = m["attrs"] if m["attrs"] is not None else m["broken"]
            if tag == "br":
                run.append(" ")
            elif tag == "a":
                link = 1
            if tag not in BLOCKS:
                if mute:
                    mute[1] += tag == mute[0]
                elif raw and tag not in VOID and not raw.endswith("/"):
                    attrs = _attributes(raw)
                    if _hidden(attrs) or _says(attrs, INLINE_WORDS):
                        mute = [tag, 1]
                continue
            flush()
            link, mute = 0, []
            if tag in VOID:
                continue
            closes = SELF_CLOSING.get(tag, {"p"} if tag not in ("html", "body") else set())
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in closes:
                    del stack[i:]
                elif stack[i].tag in _SCOPE:
                    break
            attrs = _attributes(raw) if raw else {}
            if tag == "body" and any(s.tag == "body" for s in stack):
                continue
            if tag == "body" and stack[-1].tag == "head":
                stack.pop()
            up = stack[-1]
            node = Node(tag, f"{up.path}/{_step(tag, attrs)}", up.hard or tag in OFF_TAGS or _hidden(attrs), _is_off(tag, attrs, up.main), up.main or tag in ("article", "main"), up)
            stack.append(node)
            nodes.append(node)
        elif m["end"]:
            tag = m["end"].lower()
            if tag == "a":
                link = 0
            if mute and tag == mute[0]:
                mute[1] -= 1
                if not mute[1]:
                    mute = []
            if tag not in BLOCKS:
                continue
            flush()
            mute = []
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if tag == "p" and stack[i].tag in _SCOPE:
                    break
        elif m["raw"] is None and m[0].startswith("<![CDATA["):
            run.append(m[0][9:].removesuffix("]]>"))
    flush()
    _settle(out, nodes)
    for text, chain, n_linked in out:
        bad = len(text) if chain and chain[-1].off else n_linked
        for s in chain:
            s.good += len(text) - bad
            s.bad += bad
    return [(text, chain or [root]) for text, chain, _ in out], nodes


def _settle(found: list[tuple[str, list[Node], int]], nodes: list[Node]) -> None:
    """Decide which containers are off, and hand that down. A word of a class doesn't exclude a container that holds most of
    the page's text, links apart, if little would be left without it and nothing in an article or main element."""
    held: dict[int, int] = {}
    whole = left = named = 0
    for text, chain, n_linked in found:
        if chain and chain[-1].hard:
            continue
        n = len(text) - n_linked
        whole += n
        if not any(s.off for s in chain):
            left += n
            named += n if chain and chain[-1].main else 0
        for s in chain:
            if s.off:
                held[id(s)] = held.get(id(s), 0) + n
    spare = 4 * left < whole and not named
    for node in nodes:  # a container comes after what holds it
        own = node.off and not (spare and 2 * held.get(id(node), 0) > whole)
        node.off = node.hard or own or (node.up is not None and node.up.off)


def path_scores(nodes: list[Node]) -> dict[str, float]:
    """Each path's part of the page's best score: article-like characters times their share of the container's text."""
    good: dict[str, int] = {}
    bad: dict[str, int] = {}
    for n in nodes:
        if not n.off and n.tag != "html":
            good[n.path] = good.get(n.path, 0) + n.good
            bad[n.path] = bad.get(n.path, 0) + n.bad
    scores = {p: g * g / (g + bad[p]) * _prior(p) for p, g in good.items() if g}
    top = max(scores.values(), default=0)
    return {p: s / top for p, s in scores.items()} if top else {}


def _prior(path: str) -> float:
    """Elements that say what they are, and containers more than single paragraphs."""
    tag = path.rpartition("/")[2].partition(".")[0]
    return 1.3 if tag in ("article", "main") else 0.5 if tag in ("p", "li", "h1", "h2", "h3", "h4", "h5", "h6", "td", "th", "dd", "dt", "pre") else 1.0


def extract(html: str, winners: list[str] | None, least: float = 0.1) -> str:
    """Blocks inside the containers of the first winning path that holds a fair part of the page and no less text than the
    page's own best, else of the page's own best."""
    found, nodes = blocks(html)
    own = path_scores(nodes)
    best = max(own, key=lambda p: (own[p], p.count("/"), p), default=None)
    if best is None:
        return ""
    inside = lambda path: [t for t, chain in found if not chain[-1].off and any(n.path == path for n in chain)]
    whole = inside(best)
    fair = (inside(p) for p in winners or [] if own.get(p, 0.0) >= least)
    return "\n\n".join(next((x for x in fair if sum(map(len, x)) >= sum(map(len, whole))), whole))


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", winners: int = 8, least_share: float = 0.5) -> DataFrame:
    """The article of every page: ``key, url, text, n_chars``.

    Pages vote, in Spark, for the generalised tag-class paths of their best containers (those with ``least_share`` of the
    page's best score), each with its share; a host's ``winners`` paths with most votes, deeper and then lesser paths first
    in a tie, are applied to all its pages. A page in which none holds as much as its own best container uses that. Votes are
    summed before they are shuffled, so a host of a third of all pages is no more work than others; the winners, a few
    short paths a host, are broadcast if they are small, else joined.

    A null or empty page has an empty text; a null or odd url votes with all others without a host; repeated rows each
    come out; other columns are left out; an empty table gives an empty one. Broken markup is read as far as it makes
    sense: open elements end with the page, stray end tags are ignored.
    """
    small_batches(pages.sparkSession)
    host = F.lower(F.regexp_extract(F.coalesce(F.col(f"`{url}`"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    rows = pages.select(F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").alias("url"), F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("html"), host.alias("host"))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            votes: dict[tuple[str, str], float] = {}
            for h, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for p, share in path_scores(blocks(t)[1]).items():
                    if share >= least_share:
                        votes[h, p] = votes.get((h, p), 0.0) + round(share, 3)
            yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in votes], pa.string()), pa.array([p for _, p in votes], pa.string()), pa.array(votes.values(), pa.float64())], ["host", "path", "votes"])

    votes = rows.select("host", "html").mapInArrow(vote, "host string, path string, votes double").groupBy("host", "path").agg(F.round(F.sum("votes"), 3).alias("votes"))
    place = F.row_number().over(Window.partitionBy("host").orderBy(F.desc("votes"), F.desc(F.size(F.split("path", "/"))), "path"))
    best = votes.withColumn("place", place).where(F.col("place") <= winners).groupBy("host").agg(F.sort_array(F.collect_list(F.struct("place", "path"))).alias("w"))
    best = stable(best.select(F.col("host").alias("its"), F.transform("w", lambda x: x["path"]).alias("winners")), "winners")
    size = best.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length(F.concat_ws("", "winners"))).alias("c")).first()
    best = bounded(best, size.n, 64 + (size.c or 0) // max(1, size.n))
    rows = rows.join(best, F.col("host") == F.col("its"), "left")

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [extract(t, w) for t, w in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["key", "url", "text", "n_chars"])

    kind = pages.schema[key].dataType.simpleString()
    out = rows.select("key", "url", "html", "winners").mapInArrow(take, f"key {kind}, url string, text string, n_chars long")
    return out.select(F.col("key").alias(key), F.col("url").alias(url), "text", "n_chars")
