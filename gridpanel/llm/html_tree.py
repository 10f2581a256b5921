"""Main text of web pages by a site style tree.

The DOMs of a host's pages are merged: elements with the same path of tags and
class names are one node. A node's presentation importance is the entropy of its
child sequences over the pages that have it, its content importance falls with
the pages that share its texts. A branch goes when no node in it is important.
What a page says about itself comes first: elements that are named as menus,
adverts and the like are never text, and those named as the article always stay.

Pages are read twice, once to count and once to cut; between the two only counts
are shuffled, with map-side combine, so a host with a third of all pages is no
heavier for one task than the number of its different nodes and texts.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpanel.session import Stored

THRESHOLD = 0.2  # importance below which a node is noise
NOISE_ROWS = 100_000  # most noise nodes that are broadcast
CACHED = 1_000  # characters of attributes up to which an element's key is remembered

RAW = frozenset("script style title textarea noscript iframe template xmp noembed noframes select svg".split())
FALLBACK = frozenset("object canvas audio video".split())  # their content is shown where they cannot be; they end with their parent
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split())
NOISE_TAGS = RAW | FALLBACK | frozenset("head nav header footer aside form button menu dialog fieldset".split())
NOISE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus "
    "disclaimer footer gdpr header masthead menu modal nav navbar navigation newsletter notice notification pagination pager popup promo promoted "
    "promotion related respond share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget widgets".split())
HOLDERS = frozenset(  # words that say no more than that an element holds something
    "area bar block box button buttons container form group holder icons inner item items link links list outer panel post posts row section wrap wrapper".split())
NOISE_ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
MAIN_TAGS = frozenset(["article", "main"])
KEPT_TAGS = frozenset(["html", "body", "article", "main"])  # their names do not make them noise
MAIN_NAMES = frozenset(["articlebody", "main"])
CLOSES = {  # elements that a start tag ends when one is open in the same parent block
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
KEEPS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "tbody": {"table"}, "tfoot": {"table"}}

_TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)", re.S)
# An attribute from the first character of its name on, as in HTML: a quote opens a value after "=" only.
_ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]*+))?+""")
# Attributes up to the end of their tag, values of any length. No way through them is tried twice, so a scan is linear.
_ATTRIBUTES = re.compile(rf"((?:[\s/]++|{_ATTRIBUTE.pattern})*+)>")
_UNQUOTED = re.compile(r"([^>]*+)>")
_NAMED = frozenset("class id role itemprop hidden".split())
_SPLIT = re.compile(r"[^a-zA-Z0-9]+|(?<=[a-z])(?=[A-Z])")
_DIGITS = re.compile(r"\d+")


def _key(*parts) -> int:
    return xxhash.xxh64_intdigest("\x00".join(map(str, parts))) - (1 << 63)


@lru_cache(1 << 16)
def _element(above: int, tag: str, attributes: str) -> tuple[int, bool, bool, bool, bool]:
    """The key of an element below the node ``above``, whether it is noise by itself, by its name, by its name within an article, and whether it is the article.

    Outside the article one word of a class or id is enough; within it a whole
    class must say noise, besides words like "list", since articles have headers
    and speak of notice periods.
    """
    names, noise, named, within, main = "", tag in NOISE_TAGS, False, False, tag in MAIN_TAGS
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name not in _NAMED:
            continue
        if name == "hidden":
            noise = True
        elif name == "role":
            noise = noise or value.lower() in NOISE_ROLES
            main = main or value.lower() == "main"
        else:
            if name != "itemprop":
                names += "." + _DIGITS.sub("#", value)
                if tag not in KEPT_TAGS:
                    for one in value.split():
                        words = {w.lower() for w in _SPLIT.split(one) if w}
                        told = not NOISE_NAMES.isdisjoint(words)
                        named, within = named or told, within or (told and words <= NOISE_NAMES | HOLDERS)
            main = main or value.lower() in MAIN_NAMES
    return _key(above, tag, names), noise, named, within, main


class Page:
    """Elements and text blocks of one page.

    ``nodes`` holds (key, parent place, tag, side): the key is the path of tags and
    names, the side is -1 inside what is named as noise, 1 inside the article, else
    0. Without ``named`` classes and ids mark nothing. ``texts`` holds (node place, text); None instead of a text ends a block.
    """

    __slots__ = ("nodes", "texts", "children", "named")

    def __init__(self, source: str, named: bool = True):
        self.named = named
        self.nodes: list[tuple[int, int, str, int]] = [(0, -1, "", 0)]
        self.children: list[list[str]] = [[]]
        self.texts: list[tuple[int, str | None]] = []
        self._read(source)

    def _open(self, parent: int, tag: str, attributes: str) -> int:
        above, _, _, side = self.nodes[parent]
        element = _element if len(attributes) <= CACHED else _element.__wrapped__
        key, noise, named, within, main = element(above, tag, attributes)
        inside = side == 1
        if side == 0 and main:
            side = 1
        if (noise and not (tag == "header" and side == 1)) or (self.named and (within if inside else named)):
            side = -1
        self.children[parent].append(tag)
        self.nodes.append((key, parent, tag, side))
        self.children.append([])
        return len(self.nodes) - 1

    def _read(self, source: str) -> None:
        stack, at, quoted = [0], 0, True
        nodes, texts = self.nodes, self.texts
        for token in iter(lambda: _TOKEN.search(source, at), None):
            if token.start() > at:
                texts.append((stack[-1], source[at:token.start()]))
            at = token.end()
            tag = token.group(2)
            if tag is None:
                if token.group().startswith("<![CDATA["):
                    texts.append((stack[-1], token.group()[9:].removesuffix("]]>")))
                continue
            # A quote without a closing one is a character of its value. Where values leave no end to a tag,
            # it and those after it end at their first ">"; without one, the rest is no text.
            rest = _ATTRIBUTES.match(source, at) if quoted else None
            if rest is None:
                quoted, rest = False, _UNQUOTED.match(source, at)
            if rest is None:
                at = token.start()
                break
            at, attributes = rest.end(), rest.group(1)
            tag = tag.lower()
            if tag == "br":
                texts.append((stack[-1], " "))
            elif tag in BLOCKS:
                texts.append((stack[-1], None))
            if token.group(1):
                for depth in range(len(stack) - 1, 0, -1):
                    if nodes[stack[depth]][2] == tag:
                        del stack[depth:]
                        break
                continue
            if tag in BLOCKS and tag != "html":
                # An open paragraph ends where a block begins; items end where the next one begins.
                for depth in range(len(stack) - 1, 0, -1):
                    name = nodes[stack[depth]][2]
                    if name == "p":
                        del stack[depth:]
                        break
                    if name in BLOCKS:
                        break
            if tag in CLOSES:
                for depth in range(len(stack) - 1, 0, -1):
                    name = nodes[stack[depth]][2]
                    if name in KEEPS.get(tag, ()):
                        break
                    if name in CLOSES[tag]:
                        del stack[depth:]
            if tag in VOID:
                self.children[stack[-1]].append(tag)
                continue
            place = self._open(stack[-1], tag, attributes)
            if tag == "svg" and attributes.endswith("/"):
                continue
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(source, at)
                at = end.end() if end else len(source)
            elif not attributes.endswith("/") or tag in BLOCKS:
                stack.append(place)
        if at < len(source):
            rest = source[at:]
            cut = re.search(r"<[a-zA-Z/!]", rest)  # a tag that never ends is no text
            texts.append((stack[-1], rest[:cut.start()] if cut else rest))

    def gone(self, noise: frozenset | set) -> list[bool]:
        """Whether each node is cut: named as noise, or in a branch that the host's tree calls noise."""
        out: list[bool] = []
        for key, parent, _, side in self.nodes:
            out.append(side < 0 or (parent >= 0 and out[parent]) or (side == 0 and key in noise))
        return out

    def blocks(self, gone: list[bool]) -> Iterator[tuple[int, str]]:
        """(node of its first text, block) for every block with text, character references decoded."""
        parts: list[str] = []
        first = 0
        for node, text in [*self.texts, (0, None)]:
            if text is None:
                if parts:
                    block = " ".join(html_lib.unescape("".join(parts)).split())
                    if block:
                        yield first, block
                    parts = []
            elif not gone[node]:
                if not parts:
                    first = node
                parts.append(text)


def host(url: str | None) -> str:
    """The host of a url, lower-cased, without user and port; empty when there is none."""
    found = re.match(r"\s*[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#\s]*)", url or "")
    return found.group(1).rpartition("@")[2].split(":")[0].lower() if found else ""


def style_tree(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, node, pages, importance) of every element outside what is named as noise.

    A node's importance is the largest in its branch. With the pages that have it
    as m, presentation counts the entropy, to base m, of its child sequences, and
    content 1 minus the mean of log_m of the pages that share a text. On one page
    all is important.
    """

    def count(batches):
        for batch in batches:
            hosts, nodes, kinds, values = [], [], [], []
            for own, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                page = Page(source)
                seen: dict[int, list[str]] = {}
                above: dict[int, set[int]] = {}
                for place, (key, parent, _, side) in enumerate(page.nodes):
                    if side < 0:
                        continue
                    seen.setdefault(key, []).extend(["|", *page.children[place]])
                    line = above.setdefault(key, set())
                    if parent >= 0:
                        line.update(above[page.nodes[parent][0]])
                    line.add(key)
                rows = {(key, 0, _key(*style)) for key, style in seen.items()}
                rows |= {(key, 2, up) for key, line in above.items() for up in line}
                rows |= {(page.nodes[node][0], 1, _key(text)) for node, text in page.blocks([n[3] < 0 for n in page.nodes])}
                for key, kind, value in rows:
                    hosts.append(own)
                    nodes.append(key)
                    kinds.append(kind)
                    values.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(nodes, pa.int64()), pa.array(kinds, pa.int32()), pa.array(values, pa.int64())],
                                             ["host", "node", "kind", "value"])

    found = pages.mapInArrow(count, "host string, node long, kind int, value long")
    found = Stored(found.groupBy("host", "node", "kind", "value").agg(F.count(F.lit(1)).alias("n")))
    n, style, content = F.col("n").cast("double"), F.col("kind") == 0, F.col("kind") == 1
    sums = found.df.where("kind < 2").groupBy("host", "node").agg(
        F.sum(F.when(style, n)).alias("m"), F.sum(F.when(style, n * F.ln(n))).alias("s"),
        F.count(F.when(content, 1)).alias("texts"), F.sum(F.when(content, F.ln(n))).alias("t"))
    shown = (F.ln("m") - F.col("s") / F.col("m")) / F.ln("m")
    said = F.when(F.col("texts") > 0, 1 - F.col("t") / F.col("texts") / F.ln("m")).otherwise(0.0)
    own = sums.select("host", "node", "m", F.when(F.col("m") <= 1, F.lit(1.0)).otherwise(F.greatest(shown, said)).alias("importance"))
    up = found.df.where("kind = 2").select("host", "node", F.col("value").alias("branch"))
    branch = up.join(own, ["host", "node"]).groupBy("host", "branch").agg(F.max("m").cast("long").alias("pages"), F.max("importance").alias("importance"))
    return branch.withColumnRenamed("branch", "node")


def main_text(df: DataFrame, url_col: str = "url", html_col: str = "html", threshold: float = THRESHOLD) -> DataFrame:
    """``df`` with text, the page's main text, and n_chars, its code points.

    Blocks stand on lines of their own; white space within one is a single space.
    Where every branch of a page would go, the tree is left aside and only what is
    named as noise is cut; where nothing would be left then, only what is noise by
    its tag, role or attribute. A null or empty page gives an empty text. A page without
    a host is judged alone. Repeated rows each get their text. Input columns text
    and n_chars are replaced.
    """
    spark = df.sparkSession
    df = df.drop("text", "n_chars")

    def hosts(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([host(u) for u in batch.column("url").to_pylist()], pa.string()), batch.column("html")], ["host", "html"])

    asked = df.where(F.col(html_col).isNotNull()).select(F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    asked = asked.mapInArrow(hosts, "host string, html string").where("host <> ''")
    tree = style_tree(asked)
    noise = Stored(tree.where(F.col("importance") < threshold).select("host", "node"))
    few = noise.df.limit(NOISE_ROWS + 1).count() <= NOISE_ROWS
    cuts = {}
    if few:
        for row in noise.df.collect():
            cuts.setdefault(row[0], set()).add(row[1])
    shared = spark.sparkContext.broadcast(cuts)

    def cut(batches):
        for batch in batches:
            names = batch.schema.names
            urls, sources = batch.column(names.index(url_col)).to_pylist(), batch.column(names.index(html_col)).to_pylist()
            told = batch.column(names.index("__noise")).to_pylist() if "__noise" in names else [None] * len(urls)
            texts = []
            for url, source, own in zip(urls, sources, told):
                page = Page(source or "")
                marked = set(own or ()) if not few else shared.value.get(host(url), ())
                text = "\n".join(b for _, b in page.blocks(page.gone(marked)))
                if not text and marked:
                    text = "\n".join(b for _, b in page.blocks(page.gone(())))
                if not text and source:
                    page = Page(source, named=False)
                    text = "\n".join(b for _, b in page.blocks(page.gone(())))
                texts.append(text)
            kept = [(c, v) for c, v in zip(names, batch.columns) if c not in ("__noise", "__host")]
            yield pa.RecordBatch.from_arrays([*(v for _, v in kept), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             [*(c for c, _ in kept), "text", "n_chars"])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.schema.fields)
    if not few:  # too many to broadcast: each page meets its host's nodes by a join
        site = F.coalesce(F.lower(F.regexp_extract(F.col(url_col), r"^\s*[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#\s]*@)?([^/?#\s:]*)", 1)), F.lit(""))
        lists = Stored(noise.df.groupBy(F.col("host").alias("__host")).agg(F.collect_list("node").alias("__noise")))
        df = df.withColumn("__host", site).join(lists.df, "__host", "left")
    return df.mapInArrow(cut, f"{schema}text string, n_chars long")
