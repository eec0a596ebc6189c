"""Main text of web pages by minimum cuts.

A page becomes a tree of containers with text blocks as leaves.  Every block
has costs for being called content or boilerplate: from a classifier on the
shape of its text, whose odds are counted over all blocks of all pages that
the markup itself settles (inside ``article``, inside ``nav`` and so on), and
from what the containers around it are called.  The costs are the capacities
to the two terminals; neighbours in page order, and a node and its container,
are tied by edges.  The maximum flow gives the cheapest division.

Nodes whose own cost outweighs their edges, and nodes tied to a neighbour by
more than all else, are settled before the flow; neither changes the result.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names as HTML defines them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes noscript xmp".split())
UNSEEN = frozenset("script style textarea title iframe noembed noframes noscript head template svg object canvas audio video select button datalist".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES_P = BLOCKS - frozenset("body caption html tbody td tfoot th thead tr legend".split())
#: An opening tag ends an open element of these names, unless one of the fences lies between.
ENDS = {"li": ("li", "ul ol menu dir"), "dd": ("dd dt", "dl"), "dt": ("dd dt", "dl"), "td": ("td th", "tr table"), "th": ("td th", "tr table"),
        "tr": ("tr td th caption", "table"), "tbody": ("tbody thead tfoot tr td th caption", "table"), "thead": ("tbody thead tfoot tr td th caption", "table"),
        "tfoot": ("tbody thead tfoot tr td th caption", "table")}
ENDS = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in ENDS.items()}

# What containers are called.
TAGS = {"article": "main", "main": "main", "nav": "off", "menu": "off", "aside": "off", "footer": "off", "form": "weak", "dialog": "off", "search": "off", "header": "head"}
ROLES = {"main": "main", "article": "main", "navigation": "off", "banner": "head", "contentinfo": "off", "complementary": "off", "search": "off",
         "form": "weak", "dialog": "off", "alertdialog": "off", "alert": "off", "menu": "off", "menubar": "off", "toolbar": "off"}
OFF = frozenset("""nav navbar navigation navlist subnav topnav sidenav menu menubar submenu megamenu sidebar sidebars rail footer foot colophon breadcrumb breadcrumbs
    cookie cookies cookiebar consent gdpr banner ad ads adv advert adverts advertisement advertisements advertising adslot adsense dfp sponsor sponsored sponsors promo
    promos promotion newsletter subscribe subscription signup login signin register share sharing sharebar social related recommended recommendations
    popup popover modal overlay lightbox toolbar pagination pager widget widgets copyright skip skiplink topbar notice notices notification notifications alert alerts
    disclaimer outbrain taboola searchbox searchform form forms""".split())
TALK = frozenset("comment comments commentlist commentary discussion disqus respond reply replies responses".split())
HEAD = frozenset("header masthead head".split())
MAIN = frozenset("article post entry story content main text body articlebody maincontent postbody storybody".split())
NOT_NAMED = frozenset("no has with without hide open closed status count enabled disabled".split())

#: Gains of being content, in hundredths: for what the containers say, and the bounds of what the text says.
GAIN = {"off": -800, "talk": -800, "main": 500, "named": 400, None: 80}
TEXT_BOUND = 250
NEXT, NEAR = 120, 100      # capacities between neighbours in one container, and from a node to its container
#: Content's share in each bin before anything is counted, worth so many blocks.
PRIOR, PRIOR_BLOCKS = {
    "words": [0.3, 0.35, 0.45, 0.6, 0.8, 0.9], "links": [0.6, 0.6, 0.4, 0.2, 0.1], "stop": [0.35, 0.7], "commas": [0.45, 0.65],
    "tag": [0.75, 0.6, 0.4, 0.4, 0.5, 0.7], "sign": [0.5, 0.1]}, 200

TOKEN = re.compile(r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*>?|</>|</[^a-zA-Z>][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^=>]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""(?:^|(?<=[\s/"']))(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
STOP = re.compile(r"[.!?:;…。！？][\"'”’»)\]]*$")


# ---- pages

@lru_cache(maxsize=50_000)
def called(tag: str, attributes: str) -> str | None:
    """What a container is called: ``off`` or ``weak`` (boilerplate, by its element or only by class or id), ``talk`` (comments), ``head``, ``main``,
    ``named`` (content by class or id) or nothing."""
    found, names = TAGS.get(tag), []
    for name, *values in ATTRIBUTE.findall(attributes) if attributes else ():
        value = next((v for v in values if v), "")
        if name.lower() == "role":
            found = ROLES.get(value.strip().lower(), found)
        else:
            names += value.split()
    parts = set()
    for name in names:
        words = {w.lower() for w in PARTS.findall(name)} | {name.lower()}
        if not words & NOT_NAMED:
            parts |= words
    if tag in ("html", "body"):
        return found
    if parts & TALK:
        return "talk"
    if found in ("main", "off"):
        return found
    if found == "weak" or parts & OFF:
        return "weak"
    if found:
        return found
    if parts & MAIN:
        return "named"
    return "head" if parts & HEAD and tag not in HEADINGS else None


class Page:
    """Containers (``parent``, ``kind``) and blocks (``text``, ``links`` in characters, ``tag``, ``inside``: the container), in page order."""

    def __init__(self, source: str):
        self.parent, self.kind, self.blocks = [-1], [None], []
        self._read(source)

    def _read(self, source: str) -> None:
        stack = [("html", 0)]                # open elements that hold blocks
        held: list[str] = []                 # pieces of the block that is open
        pos, size, links, link, hidden, closed = 0, len(source), 0, -1, [], {}

        def flush():
            nonlocal links
            if held:
                text = " ".join(html.unescape("".join(held)).split())
                if text:
                    self.blocks.append((text, min(links, len(text)), stack[-1][0], stack[-1][1]))
                held.clear()
            links = 0

        def close(depth: int):
            nonlocal link
            flush()
            del stack[depth:]
            if link > depth:
                link = -1

        while pos < size:
            m = TOKEN.search(source, pos)
            end = m.start() if m else size
            if end > pos and not hidden:
                held.append(source[pos:end])
                if link >= 0:
                    links += end - pos
            if not m:
                break
            pos, name = m.end(), m[2]
            if name is None:
                continue
            name, shut = name.lower(), m[1]
            if hidden == ["head"] and name in BLOCKS and not shut:
                hidden.clear()               # the head ends where the body begins
            if hidden:                       # inside an element whose text is never seen
                if name == hidden[-1] and shut:
                    hidden.pop()
                elif not shut and name in RAW:
                    pos = self._skip(source, pos, name)
                elif not shut and name == hidden[-1]:
                    hidden.append(name)
                continue
            if not shut and name in UNSEEN:
                held.append(" ")
                if name in RAW:
                    pos = self._skip(source, pos, name)
                elif not m[3].endswith("/"):
                    if name not in closed:   # where its last closing tag stands
                        closed[name] = max((x.start() for x in re.finditer(f"</{name}", source, re.I)), default=-1)
                    if name == "head" or closed[name] >= pos:
                        hidden.append(name)
            elif name == "a":
                link = -1 if shut else len(stack)
            elif name in VOID:
                if name == "hr":
                    flush()
                elif name in ("br", "img", "input", "embed"):
                    held.append(" ")
            elif name not in BLOCKS and "-" not in name:
                continue                     # inline
            elif shut:
                same = HEADINGS if name in HEADINGS else (name,)
                at = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] in same), 0)
                if at:
                    close(at)
                else:
                    flush()
            else:
                if name in ("html", "body"):
                    continue
                flush()
                if name in CLOSES_P:
                    for i in range(len(stack) - 1, 0, -1):
                        if stack[i][0] == "p":
                            close(i)
                            break
                        if stack[i][0] in ("td", "th", "table", "div", "section", "article", "li", "body"):
                            break
                if name in HEADINGS and stack[-1][0] in HEADINGS:
                    close(len(stack) - 1)
                if name in ENDS:
                    ended, fences = ENDS[name]
                    for i in range(len(stack) - 1, 0, -1):
                        if stack[i][0] in fences:
                            break
                        if stack[i][0] in ended:
                            close(i)
                kind = called(name, m[3])
                self.parent.append(stack[-1][1])
                self.kind.append(kind)
                if not m[3].endswith("/") or name in BLOCKS:
                    stack.append((name, len(self.parent) - 1))
        flush()

    @staticmethod
    def _skip(source: str, pos: int, name: str) -> int:
        m = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(source, pos)
        return m.end() if m else len(source)

    def said(self) -> list[str | None]:
        """For every container, what it and the containers around it say of a block inside.

        A container that is off speaks for all inside it, unless it wraps the
        article: it holds a large ``main`` or ``article``, or, on a page
        without any, most of the text.  Comments are comments wherever they
        stand; a header says nothing inside an article.
        """
        n = len(self.parent)
        size = [0] * n
        for text, _, _, inside in self.blocks:
            size[inside] += len(text)
        for i in range(n - 1, 0, -1):
            size[self.parent[i]] += size[i]
        most = max((size[i] for i in range(1, n) if self.kind[i] == "main"), default=-1)
        wraps = [False] * n
        for i in range(n - 1, 0, -1):
            if most < 0:
                wraps[i] = self.kind[i] == "weak" and 10 * size[i] > 6 * size[0]
            elif wraps[i] or self.kind[i] == "main" and 2 * size[i] >= most:
                wraps[i] = wraps[self.parent[i]] = True
        out: list[str | None] = [None] * n
        for i in range(1, n):
            around, own = out[self.parent[i]], self.kind[i]
            if own == "head":
                own = None if around in ("main", "named") or wraps[i] else "off"
            if own in ("off", "weak"):
                own = None if wraps[i] else "off"
            out[i] = around if around in ("off", "talk") or own == "named" and around == "main" else own or around
        return out


def shape(block: tuple) -> list[tuple[str, int]]:
    """The bins of a block's text."""
    text, links, tag, _ = block
    words, share = text.count(" ") + 1, links / len(text)
    if words < 4 and len(text) > 12 * words:
        words = len(text) // 3               # scripts without blanks
    return [("words", sum(words > n for n in (2, 5, 10, 20, 40))), ("links", sum(share > x for x in (0, 0.2, 0.5, 0.9))), ("stop", int(bool(STOP.search(text)))),
            ("commas", int("," in text or "、" in text or "，" in text)),
            ("tag", 0 if tag == "p" else 1 if tag in HEADINGS else 2 if tag == "li" else 3 if tag in ("td", "th") else 5 if tag in ("pre", "blockquote", "dd", "dt", "figcaption") else 4),
            ("sign", int("©" in text))]


# ---- classifier

def fit_blocks(pages: DataFrame, source: str = "html") -> dict[tuple[str, int], int]:
    """Gains of content for every bin, in hundredths, from all blocks that the markup settles; a few dozen counts come to the driver."""
    from math import log

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for s in batch.column(0):
                page = Page(s.as_py())
                said = page.said()
                for block in page.blocks:
                    settled = said[block[3]]
                    if settled in ("main", "off", "talk"):
                        seen.update((f, b, settled == "main") for f, b in shape(block))
        keys = sorted(seen)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64()),
                                          pa.array([k[2] for k in keys], pa.bool_()), pa.array([seen[k] for k in keys], pa.int64())], names=["f", "b", "main", "n"])

    counted = (pages.select(F.col(f"`{source}`").alias("s")).where("s is not null").mapInArrow(count, "f string, b long, main boolean, n long")
               .groupBy("f", "b", "main").agg(F.sum("n").alias("n")).collect())
    n = {(r["f"], r["b"], r["main"]): r["n"] for r in counted}
    gains = {}
    for f, shares in PRIOR.items():
        kept = [(n.get((f, b, True), 0) + PRIOR_BLOCKS * p, n.get((f, b, False), 0) + PRIOR_BLOCKS * (1 - p)) for b, p in enumerate(shares)]
        # the shares of a bin in content and in the rest, so that how much of the pages is content plays no part
        main, off = sum(k[0] for k in kept), sum(k[1] for k in kept)
        gains.update({(f, b): round(100 * log((m / main) / (o / off))) for b, (m, o) in enumerate(kept)})
    return gains


# ---- cut

def capacities(page: Page, gains: dict) -> tuple[list[int], list[tuple[int, int, int]]]:
    """Gains of content for all nodes (blocks first, then containers) and the edges between them."""
    said, n = page.said(), len(page.blocks)
    own = [GAIN[said[b[3]]] + max(-TEXT_BOUND, min(TEXT_BOUND, sum(gains[x] for x in shape(b)))) for b in page.blocks]
    edges = [(i, n + b[3], NEAR) for i, b in enumerate(page.blocks)]
    edges += [(n + i, n + p, NEAR) for i, p in enumerate(page.parent) if p >= 0]
    for i in range(n - 1):
        a, b = page.blocks[i][3], page.blocks[i + 1][3]
        near = a == b or page.parent[a] == page.parent[b]
        if said[a] == said[b]:
            edges.append((i, i + 1, NEXT if near else NEXT // 2))
    return own + [0] * len(page.parent), edges


def minimum_cut(gains: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """The division (True: content) that loses least; of equal ones that with the most content."""
    n = len(gains)
    t, tied = list(gains), [{} for _ in range(n)]
    for a, b, c in edges:
        if a != b and c:
            tied[a][b] = tied[a].get(b, 0) + c
            tied[b][a] = tied[b].get(a, 0) + c
    total = [sum(x.values()) for x in tied]
    label: list = [None] * n
    follows: list[tuple[int, int]] = []
    gone, waiting = [False] * n, deque(range(n))
    while waiting:
        u = waiting.popleft()
        if gone[u]:
            continue
        if t[u] >= total[u] or t[u] < -total[u]:
            label[u] = t[u] >= total[u]
            gone[u] = True
            for v, c in tied[u].items():
                t[v] += c if label[u] else -c
                total[v] -= c
                del tied[v][u]
                waiting.append(v)
        elif len(tied[u]) <= 8:
            v, c = max(tied[u].items(), key=lambda x: x[1])
            if c > total[u] - c + abs(t[u]):
                gone[u] = True
                follows.append((u, v))
                t[v] += t[u]
                del tied[v][u]
                total[v] -= c
                for w, d in tied[u].items():
                    if w != v:
                        del tied[w][u]
                        tied[w][v] = tied[w].get(v, 0) + d
                        tied[v][w] = tied[v].get(w, 0) + d
                        total[v] += d
                        waiting.append(w)
                waiting.append(v)
    left = [u for u in range(n) if not gone[u]]
    if left:
        for u, side in zip(left, maximum_flow(left, t, tied)):
            label[u] = side
    for u, v in reversed(follows):
        label[u] = label[v]
    return label


def maximum_flow(nodes: list[int], gains: list[int], tied: list[dict[int, int]]) -> list[bool]:
    """The source side, as large as it can be, after flow in shortest augmenting paths, level by level."""
    place = {u: i for i, u in enumerate(nodes)}
    s, e = len(nodes), len(nodes) + 1
    room: list[dict[int, int]] = [{place[v]: c for v, c in tied[u].items()} for u in nodes] + [{}, {}]
    for i, u in enumerate(nodes):
        if gains[u] > 0:
            room[s][i], room[i][s] = gains[u], 0
        elif gains[u] < 0:
            room[i][e], room[e][i] = -gains[u], 0
    while True:
        level, queue = {s: 0}, deque([s])
        while queue:
            u = queue.popleft()
            for v, c in room[u].items():
                if c > 0 and v not in level:
                    level[v] = level[u] + 1
                    queue.append(v)
        if e not in level:
            break
        ahead = {u: [v for v in room[u] if level.get(v) == level[u] + 1] for u in level}
        path = [s]
        while path:
            u = path[-1]
            if u == e:
                steps = list(zip(path, path[1:]))
                least = min(room[a][b] for a, b in steps)
                for a, b in steps:
                    room[a][b] -= least
                    room[b][a] += least
                path = path[:next(i for i, (a, b) in enumerate(steps) if not room[a][b]) + 1]
                continue
            while ahead[u] and room[u][ahead[u][-1]] <= 0:
                ahead[u].pop()
            if ahead[u]:
                path.append(ahead[u][-1])
            else:
                path.pop()
                if path:
                    ahead[path[-1]].pop()
    reach, queue = {e}, deque([e])           # what can still send to the sink
    while queue:
        v = queue.popleft()
        for u in room[v]:
            if u not in reach and room[u][v] > 0:
                reach.add(u)
                queue.append(u)
    return [i not in reach for i in range(len(nodes))]


def page_text(source: str, gains: dict) -> tuple[str, int, int]:
    """The main text, and how many of the page's blocks it holds."""
    page = Page(source)
    content = minimum_cut(*capacities(page, gains))
    kept = [b[0] for b, c in zip(page.blocks, content) if c]
    return " ".join(kept), len(kept), len(page.blocks)


def extract_text(pages: DataFrame, gains: dict, source: str = "html") -> DataFrame:
    """Add ``main_text``, ``n_chars`` (its code points), ``kept_blocks`` and ``page_blocks``.

    A null or empty page, and one without content, has an empty text.  Every
    page is parsed whole, whatever its length, repeated rows each; input
    columns of these names are replaced.
    """
    @F.arrow_udf("struct<text:string,kept:long,blocks:long>")
    def extract(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = [page_text(s.as_py() or "", gains) for s in batch]
            yield pa.StructArray.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()),
                                              pa.array([r[2] for r in rows], pa.int64())], ["text", "kept", "blocks"])

    done = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"), extract(F.col(f"`{source}`")).alias("done"))
    names = {"main_text": F.col("done.text"), "n_chars": F.length("done.text").cast("long"), "kept_blocks": F.col("done.kept"), "page_blocks": F.col("done.blocks")}
    return done.select(*[F.col(f"row.`{c}`") for c in pages.columns if c.lower() not in names], *[c.alias(n) for n, c in names.items()])
