"""Main text of web pages by a site style tree."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import slices, text_or_empty
from riskloom.session import materialize

LEAST_IMPORTANCE = 0.6
DECAY = 0.9
#: What HTML suggests before any page is seen, and how many pages that counts for: by kind of element. Elements that may
#: be content start above LEAST_IMPORTANCE, so it takes evidence against them, on a host of any size, to cut them.
PRIOR = {"noise": (0.0, 1000), "block": (0.7, 30), "other": (0.7, 30), "inside": (1.0, 30), "outside": (0.3, 30)}

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong "
                   "sub sup time tt u var wbr ruby rb rt rp".split())
#: Elements whose content is no text of the page. RAW ones hold no markup and run to the end of the page if never closed.
RAW = frozenset("script style".split())
SILENT = RAW | frozenset("noscript template iframe object svg canvas math audio video select datalist textarea button map".split())
FOREIGN = frozenset("svg math".split())  # these may close themselves
NOISE_TAGS = frozenset("nav footer aside form menu dialog fieldset header option optgroup".split())
MAIN_TAGS = frozenset("article main".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form toolbar".split())
NOISE_WORDS = frozenset("ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu "
                        "breadcrumb breadcrumbs sidebar side aside footer header masthead topbar toolbar cookie cookies consent gdpr notice "
                        "notices alert popup modal overlay newsletter subscribe signup login share sharing social related recommended "
                        "comment comments reply replies respond disqus widget pagination pager skip copyright legal".split())
#: Words that mark noise wherever they stand in a class name, whatever the element holds.
STRONG_WORDS = frozenset("ad ads advert adverts advertisement advertising sponsored cookie cookies consent gdpr newsletter share sharing "
                         "social related recommended comment comments disqus".split())
_CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
                      "hr main menu nav ol p pre section table ul".split())
_CLOSES_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
                "option": {"option"}, "tbody": {"tbody", "thead", "tr", "td", "th"}}
_SCOPE = frozenset("table ul ol dl select div article section body aside nav main footer header form".split())
_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote".split())


class _Node:
    __slots__ = ("tag", "path", "up", "hard", "soft", "strong", "main", "outer", "children", "outside", "noise", "holds", "size")

    def __init__(self, tag: str, path: str, up: _Node | None = None, hard: bool = False, soft: bool = False, strong: bool = False,
                 main: bool = False):
        """`hard` noise by tag or role, `soft` by class names, `strong` by ones that leave no doubt."""
        self.tag, self.path, self.up, self.hard, self.soft, self.strong, self.main = tag, path, up, hard, soft, strong, main
        self.outer = main and not up.main
        self.children, self.outside, self.noise, self.holds, self.size = [], False, False, False, 0

    @property
    def prior(self) -> str:
        """`main` is the outermost element of its kind only, `outside` what stands beside it on its page."""
        if self.noise:
            return "noise"
        if self.main:
            return "main" if self.outer else "inside"
        return "outside" if self.outside else "block" if self.tag in _BLOCKS else "other"


# a comment, a tag, a tag with unbalanced quotes, a declaration, or text
_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*>|([^<]+|<)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")


def _marks(named: str) -> list[list[str]]:
    """The words of each class name."""
    return [w for w in (re.findall("[a-z]+", re.sub("([a-z])([A-Z])", r"\1 \2", name).lower()) for name in named.split()) if w]


class PageTree:
    """Block elements of one page as a tree, and its texts in page order with the element each belongs to.

    Inline markup belongs to the block around it, but for what class names mark as adverts, share links and the like.
    Elements that HTML or their class names mark as menus, notices, adverts and the like are presentation of importance
    0 wherever they stand. Outside an `article` or `main` any word of a class name tells, inside it only a name's last
    word does (and STRONG_WORDS anywhere). Class names that may mean the layout don't make noise of an element that
    holds the outermost `article` or `main`, nor, on a page without one, of an element that holds half of the text. The
    outermost `article` or `main` has importance 1. Where such elements hold at least half of a page's text, HTML
    suggests that the rest lies outside.
    """

    def __init__(self):
        self.root = _Node("", "")
        self.stack, self.blocks, self.open_text, self.silent = [self.root], [], [], ""
        self.nodes = [self.root]

    def _end_block(self) -> None:
        text = " ".join("".join(self.open_text).split())
        self.open_text.clear()
        if text:
            self.blocks.append((self.stack[-1], text))

    def _pop_to(self, depth: int) -> None:
        self._end_block()
        del self.stack[depth:]

    def _close_open(self, tags: frozenset | set, stop: frozenset) -> None:
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag in tags:
                self._pop_to(i)
                return
            if self.stack[i].tag in stop:
                return

    def _start_tag(self, tag: str, attrs: str) -> None:
        if tag in SILENT:
            if not (tag in FOREIGN and attrs.rstrip().endswith("/")):
                self.silent = tag
        elif tag == "br":
            self.open_text.append(" ")
        elif tag == "hr":
            self._end_block()
        elif tag in INLINE:
            if attrs and ("class" in attrs or "hidden" in attrs):
                about = {n.lower(): v.strip("\"'") for n, v in _ATTRIBUTE.findall(attrs)}
                if "hidden" in about or any(w in STRONG_WORDS for name in _marks(about.get("class", "")) for w in name):
                    self.silent = tag
        elif tag not in VOID:
            self._start(tag, {n.lower(): v.strip("\"'") for n, v in _ATTRIBUTE.findall(attrs)} if attrs else {})

    def _start(self, tag: str, about: dict[str, str]) -> None:
        if tag in ("body", "html") and any(n.tag == tag for n in self.stack):
            return
        if tag == "body":
            self._close_open({"head"}, frozenset())
        if tag in _CLOSES_P:
            self._close_open({"p"}, _SCOPE)
        if tag in _CLOSES_SAME:
            self._close_open(_CLOSES_SAME[tag], frozenset({"table"}) if tag in ("td", "th", "tr", "tbody") else _SCOPE)
        self._end_block()
        named = f"{about.get('class', '')} {about.get('id', '')}".strip()
        names = _marks(named) if named else []
        marks = sorted({w for name in names for w in name})
        up = self.stack[-1]
        role = about.get("role", "").lower()
        inside_title = tag == "header" and up.main
        hard = tag == "head" or (tag in NOISE_TAGS and not inside_title) or role in NOISE_ROLES or "hidden" in about
        soft = strong = False
        if tag not in ("html", "body", "main"):
            strong = any(m in STRONG_WORDS for m in marks)
            telling = [name[-1] for name in names] if up.main else marks
            soft = any(m in NOISE_WORDS and not (m == "header" and up.main) for m in telling)
        main = up.main or tag in MAIN_TAGS or role in ("main", "article")
        node = _Node(tag, f"{up.path}/{tag}{'.' if marks else ''}{'.'.join(marks)}", up, hard, soft, strong, main)
        up.children.append(node.path.rpartition("/")[2])
        self.stack.append(node)
        self.nodes.append(node)

    def _end_tag(self, tag: str) -> None:
        if tag == "br":
            self.open_text.append(" ")
            return
        if tag in INLINE or tag in VOID or tag in ("html", "body"):
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                self._pop_to(i)
                return
            if self.stack[i].tag in ("article", "main", "body", "table") and tag not in ("article", "main", "table", "div", "section"):
                return

    def read(self, html: str) -> PageTree:
        at, end = 0, len(html)
        while at < end:
            if self.silent:  # what these elements hold is no text of the page
                at = self._after_silent(html, at)
                continue
            found = _TOKEN.match(html, at)
            at = found.end()
            text = found[7]
            if text is not None:
                self.open_text.append(unescape(text) if "&" in text else text)
            elif found[2] or found[5]:
                closing, tag, attrs = found.group(1, 2, 3) if found[2] else found.group(4, 5, 6)
                if closing:
                    self._end_tag(tag.lower())
                else:
                    self._start_tag(tag.lower(), attrs)
        self._end_block()
        self._judge()
        return self

    def _after_silent(self, html: str, at: int) -> int:
        tag, self.silent = self.silent, ""
        if tag in RAW:
            close = re.compile(rf"</{tag}\b[^>]*>", re.I).search(html, at)
            return close.end() if close else len(html)
        depth = 1
        for found in re.compile(rf"<(/?){tag}\b[^>]*>", re.I).finditer(html, at):
            depth += -1 if found[1] else not found[0].endswith("/>")
            if not depth:
                return found.end()
        return at  # never closed: only the tag is passed over

    def _judge(self) -> None:
        """Which elements are noise, from the whole page."""
        for node, text in self.blocks:
            node.size += len(text)
        for node in reversed(self.nodes):  # children come after their elements
            if node.up is not None:
                node.up.size += node.size
                node.up.holds |= node.holds or (node.outer and not node.strong and not node.hard)
        whole = self.root.size
        has_main = self.root.holds
        for node in self.nodes[1:]:
            spared = node.holds or (node.outer and not node.hard) if has_main else 2 * node.size >= whole
            node.noise = node.up.noise or node.hard or node.strong or (node.soft and not spared)
        within = sum(len(t) for n, t in self.blocks if n.main and not n.noise)
        if within and 2 * within >= sum(len(t) for n, t in self.blocks if not n.noise):
            for node in self.nodes:
                node.outside = not node.main


def _hash(*parts: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest("\x00".join(parts)) - (1 << 63)


def host_of(url: str | None) -> str:
    found = re.match(r"(?i)[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", url or "")
    return found[1].lower() if found else ""


def _observations(tree: PageTree) -> Iterator[tuple[str, str, int]]:
    """(path, prior, kind, feature) of a page, each once: the sequence of an element's children, and its texts."""
    seen = set()
    for node in tree.nodes:
        runs = [c for i, c in enumerate(node.children) if i == 0 or c != node.children[i - 1]]
        seen.add((node.path, node.prior, "style", _hash(*runs)))
    for node, text in tree.blocks:
        seen.add((node.path, node.prior, "text", _hash(text)))
    return iter(seen)


_OBSERVED = "host string, path string, prior string, kind string, feature long, pages long"


def observe(pages: DataFrame) -> DataFrame:
    """Style and text features of all elements, counted per host and batch."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            total = Counter()
            for url, html in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                host = host_of(url)
                for found in _observations(PageTree().read(html)):
                    total[(host, *found)] += 1
            names = ("host", "path", "prior", "kind", "feature")
            columns = {n: [k[i] for k in total] for i, n in enumerate(names)} | {"pages": list(total.values())}
            yield pa.RecordBatch.from_pydict({n: pa.array(v, pa.string() if i < 4 else pa.int64()) for i, (n, v) in enumerate(columns.items())})

    return pages.mapInArrow(rows, _OBSERVED)


def importance(observed: DataFrame) -> DataFrame:
    """(host, path, prior, pages, importance) of the merged tree of each host.

    For an element on m pages: presentation importance is the entropy, to base m, of its children's arrangements; content
    importance is 1 less the mean entropy of its texts over the pages, ln c / ln m for a text on c pages. Content weighs
    DECAY. What HTML suggests counts as PRIOR says, so few pages do not overrule it.
    """
    counts = observed.groupBy("host", "path", "prior", "kind", "feature").agg(F.sum("pages").alias("c"))
    shares = counts.groupBy("host", "path", "prior").agg(
        F.sum(F.when(F.col("kind") == "style", F.col("c"))).alias("m"),
        F.sum(F.when(F.col("kind") == "style", F.col("c") * F.log("c"))).alias("styles"),
        F.sum(F.when(F.col("kind") == "text", F.log("c"))).alias("texts"),
        F.count(F.when(F.col("kind") == "text", 1)).alias("n"))
    log_m = F.log("m")
    shown = (log_m - F.col("styles") / F.col("m")) / log_m
    told = F.when(F.col("n") > 0, 1 - F.coalesce("texts", F.lit(0.0)) / F.col("n") / log_m).otherwise(0.0)
    seen = F.when(F.col("m") > 1, (1 - DECAY) * shown + DECAY * told).otherwise(1.0)

    def prior(i: int):
        return F.element_at(F.create_map(*[F.lit(x) for k, v in PRIOR.items() for x in (k, float(v[i]))]), F.col("prior"))

    blended = (F.col("m") * seen + prior(1) * prior(0)) / (F.col("m") + prior(1))
    return shares.select("host", "path", "prior", F.col("m").alias("pages"), F.when(F.col("prior") == "main", 1.0).otherwise(blended).alias("importance"))


def main_texts(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per input row: page_id, url, text, n_chars, removed (the number of element paths cut away).

    The trees of a host's pages are merged by element path; features are counted per task first, so a host with most
    pages is a few rows per task. A branch goes if its texts lie in elements of low importance: what HTML marks as menu,
    footer or advert goes on a host of any size, the outermost `article` or `main` is fixed at 1, the rest is for the
    host's pages to tell. Elements inside it start at 1 and go where they repeat from page to page, unless nothing of it
    would be left; elements beside it start low, and stay where they differ. Only the paths where the tree says
    otherwise than HTML are gathered, per host, and join the pages in a join that adaptive execution can split.

    Null html is an empty page with empty text; a null url belongs to the host ''. Broken markup is read as far as it
    goes. Repeated rows are extracted one by one and count as pages of their host. An empty table gives no rows. Other
    columns are not read.
    """
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), text_or_empty(F.col(html)).alias("html"))
    observed = materialize(observe(rows), "style-tree")
    told = importance(observed)
    high = F.col("importance") >= LEAST_IMPORTANCE
    odd = told.where((F.col("prior") != "noise") & F.when(F.col("prior") == "outside", high).otherwise(~high))
    cut = materialize(odd.groupBy(F.col("host").alias("_host")).agg(
        F.sort_array(F.collect_set(F.concat_ws(" ", "prior", "path"))).alias("odd")), "branches")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts, removed = [], []
            for page, odd in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                tree = PageTree().read(page)
                odd = frozenset(odd or ())
                high = [not n.noise and (f"{n.prior} {n.path}" in odd) == n.outside for n, _ in tree.blocks]
                if not any(h for h, (n, _) in zip(high, tree.blocks) if n.main):  # a page that is nothing but copies
                    high = [h or n.main and not n.noise for h, (n, _) in zip(high, tree.blocks)]
                kept, gone = [], set()
                for keep, (node, text) in zip(high, tree.blocks):
                    if keep:
                        kept.append(text)
                    else:
                        gone.add(node.path)
                texts.append("\n".join(kept))
                removed.append(len(gone))
            yield pa.RecordBatch.from_pydict({
                "page_id": batch.column(0), "url": batch.column(1), "text": pa.array(texts, pa.string()),
                "n_chars": pa.array([len(t) for t in texts], pa.int64()), "removed": pa.array(removed, pa.int64())})

    host = F.lower(F.regexp_extract("url", "(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    joined = rows.withColumn("_h", F.coalesce(host, F.lit(""))).join(cut, F.col("_h") == F.col("_host"), "left")
    return joined.select("page_id", "url", "html", "odd").mapInArrow(
        extract, "page_id long, url string, text string, n_chars long, removed long")
