"""HTML extraction by wrapper induction over pages of a host.

Pages of a host meet in blocks of ``BLOCK`` pages and up to twice as many for the host's last block
(a stream sorted by host, so memory is a block's whatever the host's size; hosts with many pages are
dealt over several tasks, each with several blocks). So a block is smaller only if all pages of its
host are in it. Within a block the
pages' DOM trees are aligned with a reference page's by simple tree matching: the most node pairs
that keep tags, order and ancestry. A reference node whose text is the same in nearly all pages that
have it is template, the others are slots. Near copies say nothing about templates, so only pages
whose texts differ from each other count. The main text of a page is the text of its slots and
unmatched nodes within the article, without parts that HTML itself marks as something else.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 64
DEPTH = 256        # levels of a tree; far below what Python's calls bear
# Element names of HTML by their role here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var wbr img".split())
DROPPED = frozenset("head script style noscript template nav footer aside form button select textarea input iframe "
                    "svg canvas object audio video map menu dialog".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
                     "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
        "th": ("td", "th"), "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("thead", "tr", "td", "th")}
SCOPES = frozenset("ul ol dl table article section div body main td th".split())
# Words in class, id or role that mark something other than the article.
MARKS = frozenset("ad ads adbox adslot advert adverts advertisement advertising adsense sponsor sponsored promo "
                  "promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter "
                  "subscribe subscription paywall sidebar sidebars aside menu menus nav navbar navigation breadcrumb "
                  "breadcrumbs pagination pager footer footers masthead topbar toolbar comment comments commentlist "
                  "disqus reply replies respond share sharing social related recommended recommendations teaser "
                  "widget widgets login signup signin search searchbox complementary contentinfo dialog "
                  "skip hidden copyright legal disclaimer".split())
HEADERS = frozenset(("header", "headers", "head"))   # marks that count outside of the article only
# Of the marks, those of a reader's part: dropped even if they hold an article of their own.
READERS = frozenset("comment comments commentlist disqus reply replies respond related recommended recommendations "
                    "teaser ad ads advert adverts advertisement sponsored".split())
_WORDS = re.compile(r"[A-Za-z][a-z]*|[A-Z]+(?![a-z])")


class Node:
    """An element. ``parent`` is the one it was opened in, ``home`` the one that holds it in the tree:
    below ``DEPTH`` levels elements stand side by side, as in browsers; ``off`` if it was opened in a
    dropped one there, which its place no longer says."""
    __slots__ = ("tag", "marks", "parent", "home", "depth", "off", "children", "key", "no")

    def __init__(self, tag: str, marks: frozenset = frozenset(), parent: "Node | None" = None):
        self.children: list[Node | str] = []
        self.tag, self.marks, self.parent, self.home, self.depth, self.off = tag, marks, parent, None, 0, False
        if parent is not None:
            self.home = parent
            if parent.depth >= DEPTH:
                self.home, self.marks = parent.home, marks | parent.marks
                self.off = parent.off or parent.tag in DROPPED
            self.depth = self.home.depth + 1
            self.home.children.append(self)


class TreeBuilder(HTMLParser):
    """A lenient DOM: void elements, implied end tags, stray end tags ignored."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root")
        self.skipped: Counter = Counter()      # inline elements opened below DEPTH: their text is their parent's

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """Sections ``<![name[...]]>`` of names that the parser doesn't know are comments up to their ``>``."""
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:
            return self.rawdata.find(">", i) + 1 or -1

    def _open(self, tag: str, attrs: list) -> Node:
        marks = {w.lower() for k, v in attrs if v and k in ("class", "id", "role") for w in _WORDS.findall(v)}
        if any(k == "hidden" for k, _ in attrs):
            marks.add("hidden")
        return Node(tag, frozenset(marks), self.at)

    def _close(self, tags: tuple, stop: frozenset) -> None:
        node = self.at
        while node.parent is not None and node.tag not in stop:
            if node.tag in tags:
                self.at = node.parent
                if self.at.depth >= DEPTH:     # what follows stands beside the element that ended
                    self.at = Node(self.at.tag, self.at.marks, self.at.parent)
                return
            node = node.parent

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in CLOSES_P:
            self._close(("p",), SCOPES)
        if tag in SAME:
            self._close(SAME[tag], frozenset(("ul", "ol", "dl", "table")) if tag != "option" else SCOPES)
        if tag == "body" or (tag in CLOSES_P and self.at.tag == "head"):
            self._close(("head",), frozenset())
        if tag in INLINE and self.at.depth >= DEPTH:
            self.skipped[tag] += tag not in VOID
            return
        node = self._open(tag, attrs)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if self.skipped[tag]:
            self.skipped[tag] -= 1
        elif tag not in VOID:
            self._close((tag,), frozenset())

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse(html: str) -> Node:
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    return builder.root


def _holds_article(node: Node) -> bool:
    return any(not isinstance(c, str) and (_holds_article(c) or c.tag in ("article", "main") and not c.marks & MARKS)
               for c in node.children)


def _bad(node: Node, inside: bool) -> bool:
    if node.tag in DROPPED or node.off or node.marks & READERS:
        return True
    if node.marks & MARKS or not inside and (node.tag == "header" or node.marks & HEADERS):
        return not _holds_article(node)     # a layout box around the article, such as "with-sidebar"
    return False


def prune(node: Node, inside: bool = False) -> None:
    """Drop what element names and marks set apart from an article."""
    kept = []
    for c in node.children:
        if isinstance(c, str):
            kept.append(c)
        elif c.tag in ("html", "body") or not _bad(c, inside):
            prune(c, inside or c.tag in ("article", "main"))
            kept.append(c)
    node.children = kept


def blocks(node: Node, template: frozenset = frozenset()) -> list[str]:
    """The texts of the blocks below ``node`` in page order; nodes numbered in ``template`` left out."""
    out, now = [], []

    def flush() -> None:
        text = " ".join("".join(now).split())
        if text:
            out.append(text)
        now.clear()

    def walk(n: Node) -> None:
        for c in n.children:
            if isinstance(c, str):
                now.append(c)
            elif getattr(c, "no", None) in template:
                continue
            elif c.tag in INLINE:
                walk(c)
            else:
                flush()
                walk(c)
                flush()

    walk(node)
    flush()
    return out


def _find(node: Node, tag: str, found: list[Node]) -> list[Node]:
    for c in node.children:
        if not isinstance(c, str):
            if c.tag == tag:
                found.append(c)
            else:
                _find(c, tag, found)
    return found


def content_root(root: Node) -> tuple[Node, bool]:
    """All articles, else main, else the whole page; and whether the page marks it itself.

    Readers' parts are pruned before. Several articles stand together below one node, in page order.
    """
    for tag in ("article", "main"):
        found = _find(root, tag, [])
        if len(found) > 1:
            both = Node(tag)
            both.children = list(found)
            return both, True
        if found:
            return found[0], True
    return root, False


class Skeleton:
    """A tree of blocks for alignment: neighbours of one kind that hold text only are one node."""
    __slots__ = ("tag", "text", "children", "nodes")

    def __init__(self, node: Node):
        self.tag, self.nodes, self.children = node.tag, [node], []
        own = []
        for c in node.children:
            if isinstance(c, str):
                own.append(c)
            elif c.tag in INLINE:
                own += blocks(c)
            else:
                child = Skeleton(c)
                last = self.children[-1] if self.children else None
                if last and last.tag == child.tag and not last.children and not child.children:
                    last.text, last.nodes = f"{last.text}\n{child.text}", last.nodes + child.nodes
                else:
                    self.children.append(child)
        self.text = " ".join("".join(own).split())


def match(a: Skeleton, b: Skeleton) -> tuple[int, list[tuple[Skeleton, Skeleton]]]:
    """Simple tree matching: the number of pairs of the best alignment, and the pairs.

    Only pairs of children that both have children are matched in turn; two others pair as they are.
    """
    if a.tag != b.tag:
        return 0, []
    n, m = len(a.children), len(b.children)
    best = [[0] * (m + 1)]
    own: dict[tuple[int, int], tuple[int, list]] = {}
    for i, x in enumerate(a.children):
        above, row, at = best[-1], [0], 0
        for j, y in enumerate(b.children):
            score = 0
            if x.tag == y.tag:
                score = 1
                if x.children and y.children:
                    own[i, j] = match(x, y)
                    score = own[i, j][0]
            at = max(above[j + 1], at, above[j] + score)
            row.append(at)
        best.append(row)
    pairs, i, j = [(a, b)], n, m
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs += own[i, j][1] if (i, j) in own else [(a.children[i], b.children[j])]
    return best[n][m] + 1, pairs


def _differing(texts: list[str]) -> list[int]:
    """Pages of which each has half its 5-word shingles to itself; near copies count once."""
    seen: set[int] = set()
    out = []
    for i, t in enumerate(texts):
        w = t.split()
        own = {hash(tuple(w[k:k + 5])) for k in range(max(1, len(w) - 4))} if w else set()
        if own and len(own & seen) * 2 < len(own):
            out.append(i)
            seen |= own
    return out


class Wrapper:
    """What the pages of a block have in common."""

    def __init__(self, roots: list[tuple[Node, bool]]):
        trees = [Skeleton(r) for r, _ in roots]
        texts = ["\n".join(blocks(r)) for r, _ in roots]
        count = _differing(texts)
        self.constant: dict[int, frozenset] = {}
        if len(count) < 3:
            return
        ref = trees[max(count, key=lambda i: (len(trees[i].children), -i))]
        aligned = [match(ref, t)[1] for t in trees]
        had: Counter = Counter()
        said: dict[int, Counter] = {}
        for i in count:
            for r, s in aligned[i]:
                had[id(r)] += 1
                said.setdefault(id(r), Counter())[s.text] += 1
        for i, (_, marked) in enumerate(roots):
            # Within an article that the page marks, a line is only template on strong evidence.
            least, share = (8, 0.8) if marked else (3, 0.6)
            drop = []
            for r, s in aligned[i]:
                if s.text and not s.children and had[id(r)] >= least and said[id(r)][s.text] >= share * had[id(r)]:
                    drop += s.nodes
            for k, node in enumerate(drop):
                node.no = k
            self.constant[i] = frozenset(range(len(drop)))

    def text(self, i: int, root: Node) -> str:
        return " ".join(blocks(root, self.constant.get(i, frozenset())))


def _linked(node: Node) -> int:
    """Characters within links."""
    total = 0
    for c in node.children:
        if not isinstance(c, str):
            total += sum(map(len, blocks(c))) if c.tag == "a" else _linked(c)
    return total


def _drop_link_lists(node: Node) -> None:
    """Drop lists and boxes that are mostly links, on pages that don't mark their article."""
    kept = []
    for c in node.children:
        if not isinstance(c, str) and c.tag in ("ul", "ol", "div", "section", "table", "p", "header"):
            size = sum(map(len, blocks(c)))
            if size and _linked(c) * 2 > size:
                continue
        if not isinstance(c, str):
            _drop_link_lists(c)
        kept.append(c)
    node.children = kept


def extract(pages: list[str]) -> list[str]:
    """The main texts of pages of one host."""
    roots = []
    for html in pages:
        tree = parse(html)
        prune(tree)
        root, marked = content_root(tree)
        if not marked:
            _drop_link_lists(root)
        roots.append((root, marked))
    wrapper = Wrapper(roots)
    return [wrapper.text(i, root) for i, (root, _) in enumerate(roots)]


RESULT = "page_id bigint, url string, text string, n_chars bigint"


def _extract_stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def done(rows: list) -> pd.DataFrame:
        texts = extract([r[2] for r in rows])
        out = pd.DataFrame([(r[0], r[1], t, len(t)) for r, t in zip(rows, texts)],
                           columns=["page_id", "url", "text", "n_chars"])
        return out.astype({"page_id": "Int64"})

    rows, host = [], None
    for batch in batches:
        for own, page_id, url, html in batch[["__host", "page_id", "url", "html"]].itertuples(index=False):
            if rows and own != host:
                yield done(rows)
                rows = []
            elif len(rows) == 2 * BLOCK:      # what is left goes on with the pages that follow
                yield done(rows[:BLOCK])
                rows = rows[BLOCK:]
            host = own
            rows.append((None if pd.isna(page_id) else int(page_id), url, html))
    if rows:
        yield done(rows)


def main_texts(pages: DataFrame, parts: int = 1000) -> DataFrame:
    """(page_id, url, text, n_chars): a row per row of ``pages``.

    Null or empty html gives the empty text, and so does a page without an article's text. Pages of
    null or odd urls are grouped by what stands for the host. Repeated rows are extracted each. An
    empty table gives no rows; other columns are not read. Hosts with more than a ``parts``-th of all
    pages (fewer than ``parts`` hosts, so their list is broadcast) are dealt over several tasks.
    """
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))
    p = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                     F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    p = p.withColumn("__host", host)
    sizes = p.groupBy("__host").agg(F.count(F.lit(1)).alias("n"))
    total = pages.count()
    share = max(4 * BLOCK, -(-total // parts))     # so that hardly a task is dealt less than a block
    hot = sizes.filter(F.col("n") > share).select("__host", F.ceil(F.col("n") / share).cast("int").alias("__salts"))
    dealt = p.join(F.broadcast(hot), "__host", "left").withColumn(
        "__salt", F.pmod(F.xxhash64("page_id", "url"), F.coalesce("__salts", F.lit(1))).cast("int"))
    ordered = dealt.repartition("__host", "__salt").sortWithinPartitions("__host", "__salt", F.xxhash64("page_id"))
    return ordered.select("__host", "page_id", "url", "html").mapInPandas(_extract_stream, RESULT)
