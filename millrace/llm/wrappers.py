"""Main text of web pages by wrappers: aligned trees of the pages of one host."""

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from math import ceil
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import map_batches, written
from millrace.llm.urls import host_and_path

#: Different pages of a host that must agree on a text before it counts as template.
LEAST_PAGES = 3
#: Trees folded into one at a time; levels of elements, beyond which tags don't nest.
FOLD, DEEPEST = 256, 100
#: Share of nodes in which two containers must agree to be repeats of one record.
ALIKE = 0.7
#: Share of the text that one child must hold to be looked into instead of its parent;
#: share that an article needs; share of linked letters that makes a menu.
MOST_OF_IT, SOME_OF_IT, MENU = 0.6, 0.2, 0.8

# Element names of HTML, and words by which pages name their parts.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td "
    "tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An element that starts ends an open one of these, unless one of the bounds is between.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tr": (("tr",), ("table",)),
}
LEFT_OUT = frozenset(
    "applet aside audio button canvas datalist dialog footer form frameset iframe input label math menu nav noframes noscript "
    "object option optgroup script search select style svg template textarea title video".split()
)
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
READERS = frozenset("comment comments commentlist discussion disqus replies reply respond responses".split())
PARTS = READERS | frozenset(
    "ad ads advert advertisement advertisements adverts alert alerts aside banner breadcrumb breadcrumbs consent cookie cookies "
    "footer gdpr login masthead menu menus modal nav navbar navigation navs newsletter notice notices notification overlay "
    "pager pagination popup promo promoted promotion related search share sharing sidebar sidebars signup skip social sponsor "
    "sponsored subscribe subscription toolbar topbar widget widgets".split()
)
#: Words that mark the main text; ``header`` beside one of them, or in an article, is a headline.
MAIN = frozenset("article content entry headline main post story".split())

#: Elements whose content is no markup; all of them are left out.
RAW = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in "iframe noembed noframes script style textarea title xmp".split()}

WORD = re.compile(r"[a-z]{2,}")
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
ATTRIBUTE = re.compile(r"""[\s/]*([^\s/>=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*|["'])))?""")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Slot:
    """A node of a page's tree or of a wrapper: a block element with its signature."""

    __slots__ = ("sign", "kids", "number", "merged", "used")

    def __init__(self, sign: str):
        self.sign, self.kids = sign, []
        self.number, self.merged, self.used = -1, None, False

    def final(self) -> "Slot":
        slot = self
        while slot.merged:
            slot = slot.merged
        return slot

    def size(self) -> int:
        return 1 + sum(kid.size() for kid in self.kids)


class Block(NamedTuple):
    slot: Slot
    text: str
    linked: int


class _Open(NamedTuple):
    tag: str
    slot: Slot
    left_out: str


class _Reader:
    """The blocks of a page with the tree of elements that they stand in.

    Tags of inline elements are no nodes. Elements that their name, role, class or id
    marks as no main text are left out with all they hold. Time is linear in the page,
    whatever its markup; what ends inside a tag or comment ends there.
    """

    def __init__(self):
        self.root = Slot("page")
        self.open: list[_Open] = []
        self.tags: Counter[str] = Counter()
        self.blocks: list[Block] = []
        self.run: list[str] = []
        self.linked = 0

    def read(self, html: str) -> None:
        at, last = 0, html.rfind(">")
        while 0 <= (found := html.find("<", at)):
            self._text(html[at:found])
            if html.startswith("<!--", found):
                end = html.find("-->", found + 2)
                at = end + 3 if end >= 0 else len(html)
                continue
            closing = html.startswith("/", found + 1)
            name = NAME.match(html, found + 1 + closing)
            if name is None and not (closing or html[found + 1 : found + 2] in ("!", "?")):
                self._text("<")
                at = found + 1
            elif found > last:
                at = len(html)
            elif name is None or closing:
                at = html.find(">", found) + 1
                if name:
                    self._end(name[0].lower())
            else:
                at = self._tag(html, name)
        self._text(html[at:])
        self._flush()

    def _tag(self, html: str, name: re.Match) -> int:
        """Take a start tag in; the place behind it, and behind content that is no markup."""
        tag, at, attributes = name[0].lower(), name.end(), {}
        while part := ATTRIBUTE.match(html, at):
            attributes.setdefault(part[1].lower(), part[2] or part[3] or part[4] or "")
            at = part.end()
        at = html.find(">", at) + 1 or len(html)
        if tag in RAW:
            end = RAW[tag].search(html, at)
            return (html.find(">", end.end()) + 1 or len(html)) if end else len(html)
        self._start(tag, attributes)
        return at

    @property
    def slot(self) -> Slot:
        return self.open[-1].slot if self.open else self.root

    def _flush(self) -> None:
        text = " ".join("".join(self.run).split())
        if text:
            slot = self.slot
            self.blocks.append(Block(slot, text, min(len(text), self.linked)))
            slot.used = True
        self.run.clear()
        self.linked = 0

    def _close(self, tags: tuple[str, ...], bounds: tuple[str, ...]) -> None:
        """End the innermost open one of some elements, unless a bound is inside it."""
        if not any(self.tags[tag] for tag in tags):
            return
        for i in range(len(self.open) - 1, -1, -1):
            tag = self.open[i].tag
            if tag in tags:
                if any(entry.tag in BLOCKS for entry in self.open[i:]):
                    self._flush()
                self.tags.subtract(entry.tag for entry in self.open[i:])
                del self.open[i:]
                return
            if tag in bounds:
                return

    def _reason(self, tag: str, attributes: dict[str, str], words: set[str]) -> str:
        """Why an element is left out: "" if it isn't, "class" if only its words say so."""
        if tag in LEFT_OUT or "hidden" in attributes or attributes.get("aria-hidden") == "true":
            return "element"
        if attributes.get("role", "").lower() in ROLES or HIDDEN.search(attributes.get("style", "")):
            return "element"
        if tag in ("html", "body", "main", "h1"):
            return ""
        if words & READERS:
            return "readers"
        if tag != "article" and words & PARTS:
            return "class"
        in_text = words & MAIN or self.tags["article"] or self.tags["main"]
        return "class" if (tag == "header" or "header" in words) and not in_text else ""

    def _start(self, tag: str, attributes: dict[str, str]) -> None:
        if tag == "br":
            self._text(" ")
        elif tag == "hr":
            self._flush()
        if tag in VOID:
            return
        words = set(WORD.findall(f"{attributes.get('class', '')} {attributes.get('id', '')}".lower()))
        if tag in BLOCKS:
            self._close(("p",), ("table", "td", "th", "caption", "button"))
            if tag in ENDS:
                self._close(*ENDS[tag])
        inherited = self.open[-1].left_out if self.open else ""
        if inherited == "class" and tag in ("article", "main") and not words & READERS:  # the page's text after all
            for i in range(len(self.open) - 1, -1, -1):
                if not self.open[i].left_out:
                    break
                self.open[i] = self.open[i]._replace(left_out="")
            inherited = ""
        left_out = inherited or self._reason(tag, attributes, words)
        slot = self.slot
        if tag in BLOCKS:
            self._flush()
            if not left_out and tag not in ("html", "body") and len(self.open) < DEEPEST:
                above, slot = slot, Slot(".".join([tag, *sorted(words)]))
                above.kids.append(slot)
        self.open.append(_Open(tag, slot, left_out))
        self.tags[tag] += 1

    def _end(self, tag: str) -> None:
        if tag not in ("html", "body"):
            self._close((tag,), () if tag in ("table", "tr", "td", "th") else ("td", "th"))

    def _text(self, text: str) -> None:
        if text and not (self.open and self.open[-1].left_out):
            text = unescape(text)
            self.run.append(text)
            if self.tags["a"]:
                self.linked += len(" ".join(text.split()))


# Trees


def match(a: Slot, b: Slot) -> tuple[int, list[tuple[Slot, Slot]]]:
    """Simple tree matching: the largest number of nodes that can be paired, roots
    with roots and children in order, and the pairs of the roots' children."""
    if a.sign != b.sign:
        return 0, []
    if not a.kids or not b.kids:
        return 1, []
    weights = [[match(x, y)[0] for y in b.kids] for x in a.kids]
    n, m = len(a.kids), len(b.kids)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + weights[i - 1][j - 1])
    pairs, i, j = [], n, m
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((a.kids[i], b.kids[j]))
    return best[n][m] + 1, pairs[::-1]


def _repeats(a: Slot, b: Slot) -> bool:
    """Whether two children of one node are repeats of one slot: paragraphs, rows."""
    if a.sign != b.sign or bool(a.kids) != bool(b.kids):
        return False
    return not a.kids or 2 * match(a, b)[0] >= ALIKE * (a.size() + b.size())


def merge(tree: Slot, other: Slot) -> None:
    """Align ``other`` with ``tree`` and add what ``tree`` lacks, in its place."""
    partners = {id(theirs): mine for mine, theirs in match(tree, other)[1]}
    other.merged, place = tree, 0
    for kid in other.kids:
        mine = partners.get(id(kid)) or next((own for own in tree.kids if _repeats(own, kid)), None)
        if mine:
            merge(mine, kid)
            place = tree.kids.index(mine) + 1
        else:
            tree.kids.insert(place, kid)
            place += 1


def collapse(node: Slot) -> bool:
    """Drop nodes without text and merge repeats below a node; whether it has text."""
    kept: list[Slot] = []
    for kid in node.kids:
        if collapse(kid):
            same = next((own for own in kept if _repeats(own, kid)), None)
            if same:
                merge(same, kid)
            else:
                kept.append(kid)
    node.kids = kept
    return node.used or bool(kept)


def numbered(tree: Slot) -> list[Slot]:
    """All nodes, parents first, with their places as numbers."""
    nodes, waiting = [], [tree]
    while waiting:
        node = waiting.pop()
        node.number = len(nodes)
        nodes.append(node)
        waiting += reversed(node.kids)
    return nodes


def to_text(tree: Slot) -> str:
    return tree.sign if not tree.kids else f"{tree.sign} ( {' '.join(map(to_text, tree.kids))} )"


def from_text(text: str) -> Slot:
    above: list[Slot] = []
    last = None
    for token in text.split(" "):
        if token == "(":
            above.append(last)
        elif token == ")":
            last = above.pop()
        else:
            last = Slot(token)
            if above:
                above[-1].kids.append(last)
    return last


class Page(NamedTuple):
    tree: str
    slots: list[int]
    texts: list[str]
    linked: list[int]


def read_page(html: str | None) -> Page:
    """The tree of a page and, in page order, its blocks of text with their places in
    the tree and their letters inside links."""
    reader = _Reader()
    reader.read(html or "")
    collapse(reader.root)
    numbered(reader.root)
    blocks = reader.blocks
    return Page(
        to_text(reader.root),
        [block.slot.final().number for block in blocks],
        [block.text for block in blocks],
        [block.linked for block in blocks],
    )


# Wrappers


def fold(trees: list[str]) -> str:
    """One tree with the nodes of all, aligned one after another."""
    wrapper = from_text(trees[0])
    for tree in trees[1:]:
        merge(wrapper, from_text(tree))
    return to_text(wrapper)


def places(tree: str, wrapper: str) -> list[int]:
    """For each node of a tree the number of its node in the wrapper."""
    whole, own = from_text(wrapper), from_text(tree)
    nodes = numbered(own)
    merge(whole, own)
    numbered(whole)
    return [node.final().number for node in nodes]


class SlotText(NamedTuple):
    """Letters of the different texts of a slot, and how many of them are links."""

    letters: int
    linked: int


def main_slots(wrapper: str, texts: dict[int, SlotText]) -> list[int]:
    """The slots of a wrapper that hold main text.

    Articles that have a good part of the varying text, else the deepest node with
    most of it; without lists of links, and with a headline that stands above.
    """
    root = from_text(wrapper)
    nodes = numbered(root)
    own = [texts.get(i, SlotText(0, 0)) for i in range(len(nodes))]
    mass = [max(0, text.letters - text.linked) for text in own]
    parent = {kid.number: node.number for node in nodes for kid in node.kids}
    for i in range(len(nodes) - 1, 0, -1):
        mass[parent[i]] += mass[i]

    def tag(node: Slot) -> str:
        return node.sign.split(".")[0]

    def top(name: str) -> list[Slot]:
        found = [node for node in nodes if tag(node) == name and mass[node.number] >= SOME_OF_IT * mass[0]]
        inner = {below.number for node in found for below in _below(node)[1:]}
        return [node for node in found if node.number not in inner] if mass[0] else []

    regions = top("article") or top("main")
    if not regions:
        node = root
        while inside := [kid for kid in node.kids if kid.kids and mass[kid.number] >= MOST_OF_IT * mass[node.number] > 0]:
            node = inside[0]
        regions = [node]
    chosen = {below.number for region in regions for below in _below(region)}
    if not any(tag(nodes[i]) == "h1" for i in chosen):
        chosen |= {node.number for node in nodes if tag(node) == "h1"}
    menus = {
        i
        for i, text in enumerate(own)
        if text.linked > MENU * text.letters and tag(nodes[i]) not in HEADINGS | {"p", "pre", "blockquote"}
    }
    return sorted(chosen - menus)


def _below(node: Slot) -> list[Slot]:
    found, waiting = [], [node]
    while waiting:
        found.append(waiting.pop())
        waiting += found[-1].kids
    return found


# Over a table

BLOCK = "array<struct<slot:int,text:string,hash:long,linked:int>>"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, len(batch), 64):
            part = batch.slice(start, 64)
            pages = [read_page(html) for html in part["html"].to_pylist()]
            blocks = [
                [
                    {"slot": slot, "text": text, "hash": xxhash.xxh64_intdigest(text) - (1 << 63), "linked": linked}
                    for slot, text, linked in zip(page.slots, page.texts, page.linked, strict=True)
                ]
                for page in pages
            ]
            kind = pa.list_(pa.struct([("slot", pa.int32()), ("text", pa.string()), ("hash", pa.int64()), ("linked", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [part["page_id"], part["url"], part["host"], pa.array([page.tree for page in pages]), pa.array(blocks, kind)],
                names=["page_id", "url", "host", "tree", "blocks"],
            )


def _fold(group: pa.Table) -> pa.Table:
    return pa.table({"host": group["host"][:1], "tree": pa.array([fold(sorted(group["tree"].to_pylist()))])})


def wrappers(trees: DataFrame) -> DataFrame:
    """host, wrapper: all trees (host, tree) of a host in one, whatever their number.

    Trees are dealt by their hash into groups of about ``FOLD``, each folded in the
    order of the trees, and so again: the result depends on the set of trees alone.
    """
    most = trees.groupBy("host").count().agg(F.max("count")).first()[0] or 1
    folded, groups = trees.select("host", "tree"), most
    while True:
        groups = ceil(groups / FOLD)
        bucket = F.pmod(F.xxhash64("tree"), F.lit(groups)).alias("bucket")
        folded = folded.groupBy("host", bucket).applyInArrow(_fold, "host string, tree string")
        if groups == 1:
            return folded.withColumnRenamed("tree", "wrapper")


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [places(tree.as_py(), wrapper.as_py()) for tree, wrapper in zip(batch["tree"], batch["wrapper"], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch["host"], batch["tree"], pa.array(found, pa.list_(pa.int32()))], names=["host", "tree", "places"]
        )


def _main(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [
            main_slots(wrapper.as_py(), {t["place"]: SlotText(t["letters"], t["linked"]) for t in texts.as_py() or []})
            for wrapper, texts in zip(batch["wrapper"], batch["texts"], strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [batch["host"], pa.array(found, pa.list_(pa.int32())), batch["template"]], names=["host", "main", "template"]
        )


class Extraction(NamedTuple):
    """``pages``: see ``main_text``. ``wrappers``: host, wrapper (a tree of elements),
    main (its slots of main text), template (slot:hash of texts that never vary)."""

    pages: DataFrame
    wrappers: DataFrame


def induce(pages: DataFrame, least_pages: int = LEAST_PAGES) -> Extraction:
    """Wrappers of all hosts, and the main text of all pages by them.

    Every page becomes a tree of its block elements, in which repeated siblings are
    one slot, and blocks of text in slots. The different trees of a host are aligned
    by simple tree matching into its wrapper. In a slot of the wrapper, a text that
    stands in every different page that has the slot, ``least_pages`` or more, is
    template. What varies in the main region is the main text.

    Pages are parsed once and written with their blocks; counts go by host and slot
    with equal pages counted once, so a host with a third of all pages is no hot
    group: only its different trees meet, in groups of a bounded number. The texts move
    once more only where the decisions on all trees are too many to broadcast.
    """
    host = host_and_path(F.col("url"))[0].alias("host")
    rows = pages.select("page_id", "url", host, "html")
    kept = {name: dict(rows.dtypes)[name] for name in ("page_id", "url")}
    schema = f"page_id {kept['page_id']}, url {kept['url']}, host string, tree string, blocks {BLOCK}"
    read = written(map_batches(rows, _read, schema), "blocks", compression="zstd")
    texts = F.transform(
        "blocks", lambda b: F.struct(b["slot"].alias("slot"), b["hash"].alias("hash"), F.length(b["text"]).alias("letters"), b["linked"].alias("linked"))
    )
    facts = read.select("host", "tree", texts.alias("blocks"))
    digest = F.xxhash64("tree", F.transform("blocks", lambda b: b["hash"])).alias("digest")
    facts = written(facts.select("*", digest).dropDuplicates(["host", "tree", "digest"]).drop("digest"), "facts")
    trees = written(facts.select("host", "tree").distinct(), "trees")
    whole = written(wrappers(trees), "wrappers")
    aligned = written(map_batches(trees.join(whole, "host"), _places, "host string, tree string, places array<int>"), "places")
    placed = F.transform("blocks", lambda b: F.struct(F.get("places", b["slot"]).alias("place"), b["hash"].alias("hash"), b["letters"].alias("letters"), b["linked"].alias("linked")))
    slots = facts.join(aligned, ["host", "tree"]).select("host", placed.alias("blocks"))
    in_page = F.explode(F.array_distinct("blocks")).alias("b")
    per_text = slots.select("host", in_page).groupBy("host", "b.place", "b.hash")
    per_text = written(
        per_text.agg(F.count("*").alias("n"), F.max("b.letters").alias("letters"), F.max("b.linked").alias("linked")), "texts"
    )
    has_slot = F.explode(F.array_distinct(F.transform("blocks", lambda b: b["place"]))).alias("place")
    n_pages = slots.select("host", has_slot).groupBy("host", "place").agg(F.count("*").alias("n_pages"))
    often = per_text.where(F.col("n") >= least_pages).join(n_pages, ["host", "place"])
    never_vary = often.where("n = n_pages").groupBy("host")
    never_vary = never_vary.agg(F.collect_list(F.concat_ws(":", "place", "hash")).alias("template"))
    per_slot = per_text.groupBy("host", "place").agg(F.sum("letters").alias("letters"), F.sum("linked").alias("linked"))
    per_host = per_slot.groupBy("host").agg(F.collect_list(F.struct("place", "letters", "linked")).alias("texts"))
    known = whole.join(per_host, "host", "left").join(never_vary, "host", "left")
    known = known.select("host", "wrapper", "texts", F.coalesce("template", F.array().cast("array<string>")).alias("template"))
    decided = written(map_batches(known, _main, "host string, main array<int>, template array<string>"), "main-slots")
    by_tree = aligned.join(decided, "host")
    by_tree = by_tree.select(
        "host",
        "tree",
        "places",
        "template",
        F.transform("places", lambda place: F.array_contains("main", place)).alias("holds"),
    )
    by_tree = written(by_tree, "decisions")  # its size is known then, and Spark broadcasts it if small

    def main(block):
        key = F.concat_ws(":", F.get("places", block["slot"]), block["hash"])
        return F.get("holds", block["slot"]) & ~F.array_contains("template", key)

    text = F.array_join(F.transform(F.filter("blocks", main), lambda b: b["text"]), "\n").alias("text")
    found = read.join(by_tree, ["host", "tree"]).select("page_id", "url", text)
    return Extraction(found, whole.join(decided, "host"))


def main_text(pages: DataFrame, least_pages: int = LEAST_PAGES) -> DataFrame:
    """page_id, url and text: the main text of each page, blocks joined by line breaks.

    Elements for navigation, page headers and footers, sidebars, notices, adverts,
    forms, scripts and comments of readers are left out by name, role, class or id;
    of the rest, what the host's wrapper finds to be template, outside the main region
    or a list of links. Character references are decoded, white space in a block is one
    space, ``<br>`` is white space.

    A null or empty page has an empty text. Pages whose url is null or has no host are
    one host's. Equal pages count once and each has its text; a host with fewer than
    ``least_pages`` different pages has no template. Rows with null or repeated ids
    are pages like others; other columns are ignored; an empty table gives no rows.
    """
    return induce(pages, least_pages).pages
