"""The main text of web pages by a site style tree.

Each page is parsed to blocks of text, each at a node: the path of elements above
it, with their classes and ids. Pages of a host are merged into one tree. Of each
node it knows, over the pages of the host that have it, the normalised entropy of
its content (what they say there) and of its presentation (how many blocks they lay
out at it, and below it). The importance of a block's content counts as far as the
layout at its node, or of a branch that it hangs on, differs between pages:
``content * (PLAIN + (1 - PLAIN) * presentation)``. Branches that are the same on
all pages, or filled into the same form on all, come out low.

What a page says of its own branches is a prior that scales their importance: that
of branches whose element or names call them something else (``ASIDE``, ``NAMES``)
to near nothing, that of what lies outside, where a page marks its article, to a
fifth; inside it a branch starts from ``MARKED``. On pages that mark nothing, the
tree alone decides. A page loses the blocks below ``LEAST`` times the importance of
its most important one. Nodes of fewer than ``SHARED`` pages, or of less than
``RARE`` of a host's, have no evidence against them; so the tree of a host that a
page needs is at most ``1 / RARE`` times as long as a page.

Merged statistics are sums over (host, node, value), so that a host may hold any
share of the pages. Pages of a host with equal blocks count once.

Defined cases. Null or empty html gives an empty text. Pages without a host
share one tree. Broken markup is read as browsers do: a block element closes an
open paragraph, and what is open at the end counts as closed there. Pages of any
length and depth take time in proportion. Repeated rows give repeated results.
Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanloom.llm.common import settled, slices

# --- fixed values -----------------------------------------------------------------
#: Elements that never hold text of a page.
SILENT = frozenset("script style noscript template head title svg math canvas object iframe audio video map select option datalist button textarea".split())
#: Elements that are never part of an article.
ASIDE = frozenset("nav footer aside form menu dialog fieldset".split())
#: Elements that begin a block.
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup "
    "hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words in a class, id or role that say what a branch is.
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies copyright disclaimer "
    "disqus footer masthead menu nav navbar navigation newsletter notice notices notification pagination pager popup promo promoted related respond sharing "
    "share sidebar social sponsor sponsored subscribe toolbar topbar widget widgets alert modal login signup search contentinfo complementary".split()
)
#: Elements that an end tag of an outer one does not reach through.
SCOPE = frozenset("table td th caption html body".split())
# ----------------------------------------------------------------------------------

#: Importance, as a share of the page's greatest, that a block needs.
LEAST = 0.6

#: Pages, and share of a host's pages, that give evidence of a node; and the pages that prior belief counts for.
SHARED, RARE, BELIEF = 3, 0.01, 0.5

#: Importance of content in an unvarying layout, and of marked articles without evidence; scales of noise and of what an article leaves out.
PLAIN, MARKED, NOISE, OUTSIDE = 0.2, 0.55, 0.02, 0.2

BATCH_BYTES = 8 << 20
_SPACE = re.compile(r"\s+")
_PARTS = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _names(attrs: list[tuple[str, str | None]]) -> set[str]:
    found = " ".join(v for k, v in attrs if v and k in ("class", "id", "role"))
    return set(_PARTS.split(_CAMEL.sub(" ", found).lower()))


@lru_cache(maxsize=1 << 14)
def _below(node: int, step: str) -> int:
    return digest(f"{node}/{step}")


class Blocks(HTMLParser):
    """Blocks of text in page order: (node, marked as article, marked as noise, text); and each node's parent."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, bool, bool, bool]] = []  # tag, node, article, noise, silent
        self.count: Counter = Counter()  # open elements by tag
        self.parent: dict[int, int] = {}  # parents first; 0 for what hangs on the body
        self.out: list[tuple[int, bool, bool, str]] = []
        self.text: list[str] = []
        self.unnamed = 0

    def _state(self) -> tuple[str, int, bool, bool, bool]:
        return self.open[-1] if self.open else ("", 0, False, False, False)

    def _close(self, k: int) -> None:
        """Close the open elements from the k-th on."""
        while len(self.open) > k:
            self.count[self.open.pop()[0]] -= 1

    def flush(self) -> None:
        if self.text:
            text = _SPACE.sub(" ", "".join(self.text)).strip()
            self.text = []
            if text:
                _, node, article, noise, _ = self._state()
                self.out.append((node, article, noise, text))

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCK:
            self._end_to("p")
            if tag in ("li", "dd", "dt", "tr", "td", "th"):
                self._end_like(tag)
            self.flush()
        if tag in VOID:
            if tag in ("br", "hr"):
                self.text.append(" ")
            return
        _, node, article, noise, silent = self._state()
        if tag in SILENT:
            silent = True
        if tag in BLOCK:
            own = _names(attrs) if attrs else set()
            hidden = any(k == "hidden" or k == "aria-hidden" and v == "true" or k == "style" and "display:none" in (v or "").replace(" ", "").lower() for k, v in attrs)
            if tag in ("article", "main") or "main" in own and tag not in ASIDE:
                # An article below a noisy branch, as a reader's comment or a teaser, stays noise.
                article = article or not noise
            noise = noise or hidden or tag in ASIDE or bool(own & NAMES) and tag not in ("body", "html", "main") or tag == "header" and not article
            if tag not in ("body", "html"):
                style = sorted(x for x in own if x and not x.isdigit())
                # Branches of the body that have no name are told apart by their place among these.
                if not node and not style and tag in ("div", "section"):
                    self.unnamed += 1
                    style = [str(self.unnamed)]
                above, node = node, _below(node, ".".join([tag, *style]))
                self.parent.setdefault(node, above)
        self.open.append((tag, node, article, noise, silent))
        self.count[tag] += 1

    def _end_to(self, tag: str) -> None:
        """Close the open element ``tag``, if one is in reach, and all in it."""
        if not self.count[tag]:
            return
        for k in range(len(self.open) - 1, -1, -1):
            name = self.open[k][0]
            if name == tag:
                self.flush()
                self._close(k)
                return
            if tag == "p" and name in BLOCK or name in SCOPE and tag not in SCOPE:
                return

    def _end_like(self, tag: str) -> None:
        """A list item, cell or row ends the one before it in the same list or table."""
        stop = {"li": ("ul", "ol", "menu"), "dd": ("dl",), "dt": ("dl",)}.get(tag, ("table",))
        same = ("dd", "dt") if tag in ("dd", "dt") else ("td", "th") if tag in ("td", "th") else (tag,)
        if not any(self.count[x] for x in same):
            return
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] in stop:
                return
            if self.open[k][0] in same:
                self.flush()
                self._close(k)
                return

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID:
            if tag == "br":
                self.text.append(" ")
            return
        if not self.count[tag]:
            return
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                if tag in BLOCK:
                    self.flush()
                # An end tag of running text, as </b>, leaves blocks inside it open.
                if tag in BLOCK or tag in SILENT or not any(x[0] in BLOCK for x in self.open[k:]):
                    self._close(k)
                return
            if self.open[k][0] in BLOCK and tag not in BLOCK and tag not in SILENT:
                return

    def handle_data(self, data: str) -> None:
        if not self._state()[4]:
            self.text.append(data)


def parsed(html: str | None) -> Blocks:
    page = Blocks()
    page.feed(html or "")
    page.close()
    page.flush()
    return page


def digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def branches_of(page: Blocks) -> list[dict]:
    """A page's part of the tree: of each node what it says there, and how many blocks at it and below it."""
    nodes: dict[int, list[str]] = {}
    for node, _, _, t in page.out:
        nodes.setdefault(node, []).append(t)
    below = {n: len(nodes.get(n, ())) for n in (*page.parent, 0)}
    for n, above in reversed(page.parent.items()):
        if above:
            below[above] += below[n]
    return [{"node": n, "content": digest("\n".join(nodes[n])) if n in nodes else None, "own": len(nodes.get(n, ())), "below": below[n]} for n in below if below[n]]


def site_trees(seen: DataFrame) -> DataFrame:
    """(host, tree) of hosts, tree an array of (node, m, content, own, below), from (host, page, branches).

    With ``m`` pages at a node and ``c`` of them showing each of its values, an
    entropy is ``sum(c / m * log(m / c)) / log(m)``: 1 where each page differs, 0
    where all are alike.
    """
    rows = seen.select("host", "page", F.explode("branches").alias("b")).select("host", "page", "b.*").distinct()
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.col(c).cast("long").alias("v")) for k, c in enumerate(("content", "own", "below")))))
    counted = rows.select("host", "node", each.alias("x")).filter(F.col("x.v").isNotNull()).groupBy("host", "node", "x.kind", "x.v").agg(F.count("*").alias("c"))
    m = F.sum("c")
    entropy = F.when(m > 1, (F.log(m.cast("double")) - F.sum(F.col("c") * F.log(F.col("c").cast("double"))) / m) / F.log(m.cast("double"))).otherwise(1.0)
    nodes = counted.groupBy("host", "node", "kind").agg(m.alias("m"), entropy.alias("e"))
    of = lambda k: F.coalesce(F.max(F.when(F.col("kind") == k, F.col("e"))), F.lit(1.0))
    nodes = nodes.groupBy("host", "node").agg(F.max("m").alias("m"), of(0).alias("content"), of(1).alias("own"), of(2).alias("below"))
    pages = seen.groupBy("host").agg(F.count_distinct("page").alias("pages"))
    nodes = nodes.filter(F.col("m") >= SHARED).join(pages, "host").filter(F.col("m") >= RARE * F.col("pages"))
    return nodes.groupBy("host").agg(F.collect_list(F.struct("node", "m", "content", "own", "below")).alias("tree"))


def importances(page: Blocks, tree: dict[int, tuple[int, float, float, float]]) -> list[float]:
    """The importance of each of a page's blocks; ``tree`` has (m, content, own, below) of the nodes with evidence."""
    none = (0, 1.0, 1.0, 1.0)
    inherited = {0: 0.0}
    for n, above in page.parent.items():
        # How the layout differs in the branches that a node hangs on.
        inherited[n] = max(inherited[above], tree[above][3]) if above in tree else inherited[above]
    marked = any(article and not noise for _, article, noise, _ in page.out)
    out = []
    for node, article, noise, _ in page.out:
        m, content, own, _ = tree.get(node, none)
        value = content * (PLAIN + (1 - PLAIN) * max(own, inherited[node]))
        value = (m * value + BELIEF) / (m + BELIEF)
        if marked:
            value = MARKED + (1 - MARKED) * value
        out.append(value * (NOISE if noise else OUTSIDE if marked and not article else 1.0))
    return out


def main_text(html: str | None, tree: dict[int, tuple[int, float, float, float]]) -> str:
    page = parsed(html)
    value = importances(page, tree)
    least = LEAST * max(value, default=0.0)
    # Where all is noise, none is the article.
    noise = all(noise for _, _, noise, _ in page.out)
    return "" if noise else "\n\n".join(t for (_, _, _, t), v in zip(page.out, value) if v >= least)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of (page_id, url, html).

    Pages are parsed twice, once for the tree and once for their text, so that no
    copy of the parsed text is kept between.
    """

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html", BATCH_BYTES):
            found = [branches_of(parsed(html)) for html in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array([digest(repr(b)) for b in found], pa.int64()), pa.array(found, BRANCHES)], names=["host", "page", "branches"])

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: dict[str, dict] = {}
        for batch in slices(batches, "html", BATCH_BYTES):
            text = []
            hosts, rows = batch.column("host").to_pylist(), batch.column("tree")
            for k, html in enumerate(batch.column("html").to_pylist()):
                if hosts[k] not in trees:
                    if len(trees) >= HOSTS:
                        trees.clear()
                    trees[hosts[k]] = {b["node"]: (b["m"], b["content"], b["own"], b["below"]) for b in rows[k].as_py() or ()}
                text.append(main_text(html, trees[hosts[k]]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], names=["page_id", "url", "text", "n_chars"]
            )

    rows = pages.select("page_id", "url", host(F.col("url")).alias("host"), "html")
    found = settled(rows.select("host", "html").mapInArrow(seen, "host string, page long, branches array<struct<node: bigint, content: bigint, own: int, below: int>>"), "branches")
    trees = settled(site_trees(found), "trees")
    out = rows.join(trees, "host", "left").select("page_id", "url", "host", "html", "tree")
    return out.mapInArrow(kept, "page_id long, url string, text string, n_chars long")


#: Trees of hosts that a task remembers.
HOSTS = 64

#: The kind of a page's branches as Arrow has it.
BRANCHES = pa.list_(pa.struct([("node", pa.int64()), ("content", pa.int64()), ("own", pa.int32()), ("below", pa.int32())]))
