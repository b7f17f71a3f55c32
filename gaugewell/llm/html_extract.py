"""Main text of web pages by consensus paths of a host.

Each page's containers are scored: text of their own paragraphs against link text.  A
container's *path* is its chain of tags with classes, numbers in classes generalised.
Pages vote with their scores for paths, per host, in Spark; each page is then extracted
again by the best path of its host that it has, from where it climbs to the container of
all text that is no noise.  Hosts lay out their pages alike, so a page with little text
still gets the right container.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugewell.llm.common import slices, stored

# A quote opens a value after an equals sign only; nothing is tried twice.
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?>[^>\"'=]+|=\s*\"[^\"]*\"|=\s*'[^']*'|[=\"'])*+)>",
    re.S,
)
#: Name and value of an attribute, from where the one before it ends.
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")

# Tags of HTML by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title svg math iframe object select head".split())
SKIP = frozenset("nav footer aside form button menu dialog".split()) | RAW
BLOCKS = frozenset(
    "address article blockquote body caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html li main ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("article main section div td body center".split())
CLOSES_P = BLOCKS - {"html", "body"}
ARTICLE = frozenset(("article", "main"))
#: Names of boxes that hold no article text, as parts of class and id names.
NOISE = re.compile(
    r"(?:^|[-_\s])(?:ad|ads|advert\w*|sponsor\w*|promo\w*|cookie\w*|consent|popup|modal|newsletter|subscribe|nav\w*|menu\w*|"
    r"breadcrumbs?|sidebar|footer|masthead|topbar|toolbar|comments?|disqus|pagination|pager|login|signup)(?:$|[-_\s])",
    re.I,
)
#: Names that boxes of an article have too: inside one they count as noise only if they are mostly links.
DOUBTFUL = re.compile(
    r"(?:^|[-_\s])(?:banner|notice|side|aside|foot|header|respond|replies|reply|related|recommend\w*|share|sharing|social|"
    r"widget|search|skip|hidden|copyright|legal|disclaimer)(?:$|[-_\s])",
    re.I,
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu".split())


def _attributes(text: str) -> tuple[str, bool]:
    """Class and id names of a tag, and whether it is hidden or of no article role.  The first of equal names counts."""
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    off = (
        "hidden" in found
        or found.get("role", "").lower() in ROLES
        or found.get("aria-hidden", "").lower() == "true"
        or "display:none" in found.get("style", "").replace(" ", "").lower()
    )
    return " ".join(found[n] for n in ("class", "id") if found.get(n)), off


class Page:
    """Text blocks of a page in order, and the containers around them.

    A container is a number: its parent's is smaller (-1 outside of all).  ``keys`` are hashes of
    paths: two containers of one key have the same chain of tags and classes.  So a page of
    any depth takes memory in proportion to its length.
    """

    def __init__(self, page: str):
        self.parents: list[int] = []
        self.keys: list[bytes] = []
        self.named: list[bool] = []
        self._elements: list[tuple[int, str]] = []  # parent element, shape
        self._element_of: list[int] = []  # by container
        self.blocks: list[tuple[int, str, bool]] = []  # container, text, is link text
        self._parse(page)

    def path(self, container: int) -> str:
        shapes, at = [], self._element_of[container]
        while at >= 0:
            at, shape = self._elements[at]
            shapes.append(shape)
        return ">".join(reversed(shapes))

    def _parse(self, page: str) -> None:
        # open elements: tag, number, key of the path, skipped, container before it or None, doubtful box before it or None
        stack: list[tuple] = []
        opened: Counter = Counter()
        boxes: list[list[int]] = []  # link and plain characters of doubtful boxes in articles
        box_parent: list[int] = []
        found: list[tuple[int, str, bool, int]] = []
        parts: list[str] = []
        linked = plain = in_link = skipped = article = 0
        here = box = -1
        at, raw = 0, None

        def text(piece: str) -> None:
            nonlocal linked, plain
            if piece and not skipped:
                parts.append(piece)
                n = len(piece.strip())
                if in_link:
                    linked += n
                else:
                    plain += n

        def flush() -> None:
            nonlocal linked, plain
            if parts:
                body = " ".join(html.unescape("".join(parts)).split())
                if body:
                    found.append((here, body, linked > plain, box))
                if box >= 0:
                    boxes[box][0] += linked
                    boxes[box][1] += plain
                parts.clear()
            linked = plain = 0

        def close(n: int) -> None:
            nonlocal in_link, skipped, article, here, box
            while len(stack) > n:
                tag, _, _, skip, around, outer_box = stack.pop()
                if tag in BLOCKS or skip or outer_box is not None:
                    flush()
                if around is not None:
                    here = around
                if outer_box is not None:
                    box = outer_box
                opened[tag] -= 1
                skipped -= skip
                in_link -= tag == "a"
                article -= tag in ARTICLE

        def close_last(tags: tuple[str, ...], stop) -> bool:
            if not any(opened[t] for t in tags):
                return False
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in tags:
                    close(i)
                    return True
                if stack[i][0] in stop:
                    return False
            return False

        for m in _TAG.finditer(page):
            if raw:
                if not (m[1] and m[2].lower() == raw):
                    continue
                raw = None
            else:
                text(page[at : m.start()])
            at = m.end()
            if m[2] is None:
                if m[0].startswith("<![CDATA["):
                    text(m[0][9:].removesuffix("]]>"))
                continue
            tag = m[2].lower()
            if m[1]:
                if not close_last((tag,), ()) and tag == "p":
                    flush()
                continue
            if tag == "br":
                text(" ")
                continue
            if tag in VOID:
                if tag == "hr":
                    flush()
                continue
            if tag in CLOSES_P:
                # an open paragraph ends where a block begins; what is inline in it ends with it
                close_last(("p",), BLOCKS - {"p"})
            if tag in ("li", "dd", "dt", "tr", "td", "th", "option"):
                close_last(("dd", "dt") if tag in ("dd", "dt") else (tag,), ("ul", "ol", "dl", "table"))
            attributes = m[3].rstrip()
            if attributes.endswith("/") and tag in RAW:
                continue
            names, off = _attributes(attributes) if attributes else ("", False)
            skip, doubtful = off or tag in SKIP or tag == "header" and not article, False
            if not skip and names and tag not in ("html", "body", "article", "main"):
                skip = bool(NOISE.search(names))
                doubtful = not skip and bool(DOUBTFUL.search(names))
                skip, doubtful = skip or doubtful and not article, doubtful and article > 0
            if tag in BLOCKS or skip or doubtful:
                flush()
            shape = tag + "".join("." + re.sub(r"\d+", "#", c) for c in sorted(set(names.lower().split()))[:3])
            key = blake2b((stack[-1][2] if stack else b"") + shape.encode("utf-8", "replace"), digest_size=16).digest()
            self._elements.append((stack[-1][1] if stack else -1, shape))
            container = tag in CONTAINERS and not skip and not skipped
            stack.append((tag, len(self._elements) - 1, key, skip, here if container else None, box if doubtful else None))
            opened[tag] += 1
            if container:
                self.parents.append(here)
                self.keys.append(key)
                self.named.append(tag in ARTICLE)
                self._element_of.append(len(self._elements) - 1)
                here = len(self.parents) - 1
            if doubtful:
                boxes.append([0, 0])
                box_parent.append(box)
                box = len(boxes) - 1
            skipped += skip
            in_link += tag == "a"
            article += tag in ARTICLE
            if tag in ("script", "style", "textarea", "title", "noscript", "template", "iframe"):
                raw = tag
        if not raw:
            text(page[at:])
        close(0)
        flush()
        # a box has the text of the boxes in it; one of links goes with all that is in it
        for i in range(len(boxes) - 1, -1, -1):
            if box_parent[i] >= 0:
                boxes[box_parent[i]][0] += boxes[i][0]
                boxes[box_parent[i]][1] += boxes[i][1]
        gone: list[bool] = []
        for (links, other), parent in zip(boxes, box_parent):
            gone.append(links > other or parent >= 0 and gone[parent])
        self.blocks = [(c, body, is_link) for c, body, is_link, b in found if b < 0 or not gone[b]]


def scores(page: Page) -> dict[bytes, float]:
    """Score of each container path of a page: its blocks' text, half of it for each container further out, links against."""
    own = [0.0] * len(page.parents)
    for container, text, is_link in page.blocks:
        if container >= 0:
            own[container] += -len(text) if is_link else len(text)
    total: dict[bytes, float] = {}
    some = [False] * len(own)
    for container, _, _ in page.blocks:
        if container >= 0:
            some[container] = True
    for c in range(len(own) - 1, -1, -1):
        if not some[c]:
            continue
        total[page.keys[c]] = total.get(page.keys[c], 0.0) + own[c] * (2 if page.named[c] else 1)
        if page.parents[c] >= 0:
            own[page.parents[c]] += own[c] / 2
            some[page.parents[c]] = True
    return total


def main_text(page: Page, key: bytes) -> tuple[list[str], int]:
    """A page's main text, given the key of a container of it: its blocks, and the container that holds them all.

    That is the innermost one around it with all text that is no link text, of the
    outermost article or main around it if there is one, else of the page (-1 where no
    container holds it).  Boxes of links alone stay out unless they lie in the given one.
    """
    n = len(page.parents)
    inside = [False] * n  # in a container of the key
    for c in range(n):
        inside[c] = page.keys[c] == key or page.parents[c] >= 0 and inside[page.parents[c]]
    at = next(c for c, _, _ in page.blocks if c >= 0 and inside[c])
    while page.keys[at] != key:
        at = page.parents[at]
    chain = [at]
    while page.parents[chain[-1]] >= 0:
        chain.append(page.parents[chain[-1]])
    chain.reverse()
    named = [i for i, c in enumerate(chain) if page.named[c]]
    outer = chain[named[0] :] if named else chain
    # how far down the chain of keys each container lies: 0 outside of it
    place = {page.keys[c]: i + 1 for i, c in enumerate(outer)}
    level = [0] * n
    for c in range(n):
        level[c] = max(level[page.parents[c]] if page.parents[c] >= 0 else 0, place.get(page.keys[c], 0))

    def of(c: int) -> int:
        return level[c] if c >= 0 else 0

    least = 1 if named else 0
    kept = [b for b in page.blocks if of(b[0]) >= least]
    depth = min((of(c) for c, _, is_link in kept if not is_link), default=len(outer))
    boxes = {page.keys[c] if c >= 0 else None for c, _, is_link in kept if not is_link}
    texts = [
        text for c, text, is_link in kept
        if c >= 0 and inside[c] or of(c) >= depth and (not is_link or (page.keys[c] if c >= 0 else None) in boxes)
    ]
    return texts, outer[depth - 1] if depth else -1


def _host():
    return F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def winning_paths(pages: DataFrame) -> DataFrame:
    """(host, paths): keys of a host's container paths by votes, best first; a page votes for each with its share of the score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                votes: dict[tuple[str, bytes], float] = {}
                for host, page in zip(part.column("host").to_pylist(), part.column("html")):
                    found = {k: v for k, v in scores(Page(page.as_py() or "")).items() if v > 0}
                    most = max(found.values(), default=0)
                    for path, value in found.items():
                        votes[host, path] = votes.get((host, path), 0.0) + value / most
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([h for h, _ in votes], pa.string()),
                        pa.array([p for _, p in votes], pa.binary()),
                        pa.array([round(v * 1000) for v in votes.values()], pa.int64()),
                    ],
                    ["host", "path", "votes"],
                )

    votes = pages.select(_host().alias("host"), "html").mapInArrow(run, "host string, path binary, votes long")
    summed = votes.groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    best = summed.groupBy("host").agg(F.max(F.struct("votes", "path")).alias("best"))
    ranked = summed.join(best, "host").where("votes * 5 >= best.votes")
    return ranked.groupBy("host").agg(F.array_sort(F.collect_list(F.struct((-F.col("votes")).alias("against"), "path"))).alias("paths")).select("host", F.col("paths.path").alias("paths"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, path; one row per row of ``pages`` (page_id, url, html).

    Main text by the best of the host's winning paths that the page has, by the page's own
    best container if it has none, and by the containers around it that hold the rest of the
    text (:func:`main_text`); ``path`` is the outermost one taken.  A page without any container is its blocks, with a NULL
    path.  Blocks are joined by line ends.  NULL or empty html gives the empty text and a
    NULL path; a NULL url is the host ''.
    """
    kind = pages.schema["page_id"].dataType.simpleString()
    winners = stored(winning_paths(pages), "host-paths")
    joined = pages.select("page_id", "url", "html", _host().alias("host")).join(winners, "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                texts, used = [], []
                for page, paths in zip(part.column("html"), part.column("paths")):
                    found = Page(page.as_py() or "")
                    own = scores(found)
                    key = next((p for p in paths.as_py() or () if p in own), None)
                    if key is None and own:
                        key = max(own, key=lambda p: (own[p], p))
                    main, container = [text for _, text, _ in found.blocks], -1
                    if key is not None:
                        main, container = main_text(found, key)
                    texts.append("\n".join(main))
                    used.append(found.path(container) if container >= 0 else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(used, pa.string())],
                    ["page_id", "url", "text", "path"],
                )

    return joined.select("page_id", "url", "html", "paths").mapInArrow(run, f"page_id {kind}, url string, text string, path string")
