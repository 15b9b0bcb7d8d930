"""Main text of web pages by consensus of a host's pages on where the article stands.

Each page scores its containers by the text in them, without what is marked as something else, and
votes for their paths: the tags from the root with their classes, digits left out. Votes are added
up per host and path in Spark, combined before the shuffle, so a host of any size costs a row per
path and task. Each page is then read again with its host's winning path; a page that lacks it
takes its own best container.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.llm.common import MOST_BROADCAST_KEYS, added, annotate, checkpoint, quoted

# Fixed values of the language of web pages.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("article blockquote body center div html main section table tbody td tr".split())
RAW = frozenset("script style textarea title template noscript iframe svg math select object audio video canvas".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements that are never article text, and such classes, ids and roles.
OTHER = frozenset("nav footer aside form menu dialog button fieldset".split())
OTHER_NAMES = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside ad ads advert adverts "
    "advertisement advertising banner promo promotion sponsor sponsored cookie cookies consent gdpr notice notices alert "
    "popup modal overlay newsletter subscribe subscription share sharing social related recommended comment comments "
    "reply replies disqus pagination pager widget toolbar login signup search complementary contentinfo".split()
)
#: What a container's text counts by its tag, or by a hint in its class.
WEIGHT = {"article": 1.3, "main": 1.2, "body": 0.8, "html": 0.7, "": 0.6}
HINTS, HINT_WEIGHT = frozenset("article content post entry story main body text".split()), 1.1
#: Share of a block's text in links from which it counts as a menu.
LINKS = 0.6

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>|<[/!?a-zA-Z][^<>]*>",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"(?<![^\s\"'/])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_HIDDEN = re.compile(r"(?<!\S)hidden(?=[\s=/]|$)", re.IGNORECASE)
_PART = re.compile(r"[a-z]+")
_DIGITS = re.compile(r"\d+")
_HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


class Page:
    """Blocks of text of a page and the containers they stand in.

    nodes: parent, path key, step (last tag and classes), depth; blocks: text, container, whether
    it is something else than an article's text, share of links.
    """

    def __init__(self, source: str) -> None:
        self.parent, self.key, self.step, self.depth = [-1], [b""], [""], [0]
        self.blocks: list[tuple[str, int, bool, float]] = []
        # Open elements: tag, container, whether something else, whether a link.
        stack: list[tuple[str, int, bool]] = [("", 0, False)]
        open_tags: dict[str, int] = {}
        pieces: list[str] = []
        linked = [0, 0]  # depth of links, characters in them
        at, last = 0, source.rfind(">") + 1  # beyond the last bracket no tag ends

        def flush() -> None:
            raw = "".join(pieces)
            if raw:
                text = " ".join(html.unescape(raw).split() if "&" in raw else raw.split())
                if text:
                    _, node, other = stack[-1]
                    self.blocks.append((text, node, other, linked[1] / max(1, len(raw))))
            pieces.clear()
            linked[1] = 0

        def text(piece: str) -> None:
            if piece:
                pieces.append(piece)
                if linked[0]:
                    linked[1] += len(piece)

        def close(tag: str) -> None:
            while stack[-1][0] != tag:
                open_tags[stack.pop()[0]] -= 1
            open_tags[stack.pop()[0]] -= 1

        while True:
            m = _TOKEN.search(source, at)
            if m is None:
                text(source[at:])
                break
            text(source[at : m.start()])
            at = m.end()
            tag = m["tag"]
            if tag is None:
                continue
            tag, ends = tag.lower(), bool(m["end"])
            if tag in RAW:
                if not ends and not m["rest"].endswith("/"):
                    stop = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.IGNORECASE).search(source, at, last)
                    at = stop.end() if stop else len(source)
                continue
            if tag == "br":
                text(" ")
            elif tag == "a":
                linked[0] = 0 if ends else 1
            if tag not in BLOCKS:
                continue
            flush()
            linked[0] = 0
            if ends:
                if open_tags.get(tag):
                    close(tag)
                continue
            # A new block ends an open paragraph, a new item an open one of its kind.
            if stack[-1][0] == "p" or (tag in ("li", "td", "th", "tr", "dt", "dd", "option") and stack[-1][0] == tag):
                open_tags[stack.pop()[0]] -= 1
            if tag in VOID:
                continue
            _, node, other = stack[-1]
            named = {k.lower(): (a or b or c).lower() for k, a, b, c in _ATTRIBUTE.findall(m["rest"])} if m["rest"] else {}
            if not other:
                other = tag in OTHER or bool(m["rest"] and _HIDDEN.search(_ATTRIBUTE.sub("", m["rest"])))
                other |= tag == "header" and not any(t in ("article", "main") for t, n in open_tags.items() if n)
                if named and tag not in ("html", "body", "article", "main"):
                    other |= not OTHER_NAMES.isdisjoint(_PART.findall(" ".join(named.values())))
            if tag in CONTAINERS:
                step = ".".join([tag, *sorted(set(_DIGITS.sub("", named.get("class", "")).split()))])
                self.key.append(hashlib.blake2b(self.key[node] + step.encode(), digest_size=16).digest())
                self.parent.append(node)
                self.step.append(step)
                self.depth.append(self.depth[node] + 1)
                node = len(self.parent) - 1
            stack.append((tag, node, other))
            open_tags[tag] = open_tags.get(tag, 0) + 1
        flush()

    def votes(self) -> dict[bytes, tuple[int, int]]:
        """For each path with a vote: thousandths of the page's text that speak for it, and its depth."""
        own, noise = [0] * len(self.parent), [0] * len(self.parent)
        for text, node, other, links in self.blocks:
            (noise if other or links > LINKS else own)[node] += len(text)
        for n in range(len(self.parent) - 1, 0, -1):
            own[self.parent[n]] += own[n]
            noise[self.parent[n]] += noise[n]
        found: dict[bytes, tuple[int, int]] = {}
        for n, key in enumerate(self.key):
            tag, *classes = self.step[n].split(".")
            weight = WEIGHT.get(tag) or (HINT_WEIGHT if not HINTS.isdisjoint(_PART.findall(" ".join(classes))) else 1.0)
            vote = round(1000 * (weight * own[n] - noise[n]) / max(1, own[0]))
            if own[n] and vote > 0:
                found[key] = (found.get(key, (0, 0))[0] + vote, self.depth[n])
        return found

    def text(self, path: bytes | None) -> str:
        """The text at the path; without the path on this page, at its own best one."""
        if path is None or path not in self.key:
            votes = self.votes()
            path = max(votes, key=lambda k: (*votes[k], k)) if votes else b""
        inside = [False] * len(self.parent)
        for n, key in enumerate(self.key):
            inside[n] = key == path or (n > 0 and inside[self.parent[n]])
        return " ".join(text for text, node, other, _ in self.blocks if inside[node] and not other)


def host_paths(pages: DataFrame, url: str = "url", source: str = "html") -> DataFrame:
    """(host, path): the container path that a host's pages voted for, ties to the deeper one."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for host, content in zip(*batch.columns):
                name = host.as_py()
                rows += [(name, k, v, d) for k, (v, d) in Page(content.as_py() or "").votes().items()]
            columns = zip(*rows) if rows else ((), (), (), ())
            types = (pa.string(), pa.binary(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["host", "path", "vote", "depth"])

    votes = with_host(pages, url, source).select("host", "source").mapInArrow(vote, "host string, path binary, vote long, depth int")
    total = votes.groupBy("host", "path").agg(F.sum("vote").alias("n"), F.max("depth").alias("depth"))
    return total.groupBy("host").agg(F.max_by("path", F.struct("n", "depth", "path")).alias("path"))


def with_host(pages: DataFrame, url: str, source: str, keep: list[str] = ()) -> DataFrame:
    host = F.coalesce(F.lower(F.regexp_extract(pages[quoted(url)].cast("string"), _HOST, 1)), F.lit(""))
    return pages.select(*[pages[quoted(c)] for c in keep], host.alias("host"), pages[quoted(source)].cast("string").alias("source"))


def extract(pages: DataFrame, id: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """(id, url, text, path) for each row of pages.

    text holds the blocks of the article, each with its character references decoded and white space
    turned into single spaces, in page order, joined by one space; empty if there is none, as for
    null and empty pages. Pages without a url form a host of their own. Repeated rows each have their
    result and their vote; an empty table gives an empty one.
    """
    own = with_host(pages.select(pages[quoted(id)].alias("id"), pages[quoted(url)].alias("url"), pages[quoted(source)].alias("html")), "url", "html", ["id", "url"])
    paths = checkpoint(host_paths(pages, url, source))
    paths = paths.select(F.col("host").alias("of"), "path")
    paths = F.broadcast(paths) if paths.count() <= MOST_BROADCAST_KEYS else paths
    joined = own.join(paths, own.host == paths.of, "left").select("id", "url", "source", "path")

    def make() -> Callable:
        def work(contents: pa.Array, chosen: pa.Array) -> list[pa.Array]:
            return [pa.array([Page(c.as_py() or "").text(p.as_py()) for c, p in zip(contents, chosen)], pa.string())]

        return work

    found = annotate(joined, "text string", make, ["source", "path"], ["id", "url", "path"])
    return found.select("id", "url", added(found, "text").alias("text"), "path")
