"""Main text of web pages, by wrapper induction.

The pages of a host come from few templates. Each page is parsed to a slot tree, in which
neighbouring siblings of one kind are one slot. The commonest tree of a host is its reference; the trees of
its pages are aligned to it by simple tree matching (the largest order-keeping match of
children, level by level). A slot whose whole text is the same in most pages of the
host is template; the others are content slots. What a page says in content slots is its text, without the parts
that their markup names as something else than the article (menus, adverts, comments).

Pages meet only as counts: of trees for a host, and of text hashes for a slot.
"""

from __future__ import annotations

import hashlib
import html
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenura.llm.storage import stored
from tenura.llm.url_filter import url_host

# HTML element names, and words that name a part of a page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr
q ruby rt rp s samp small span strike strong sub sup time tt u var wbr br img""".split())
RAW = set("script style textarea title xmp noframes iframe noembed".split())
SKIPPED = set("""head script style noscript template svg math iframe object audio video canvas map select option
button textarea datalist dialog title""".split())
ASIDE = set("nav header footer aside form menu".split())
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"},
    "tfoot": {"tbody", "tr", "td", "th"},
}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"},
         "th": {"table"}, "thead": {"table"}, "tbody": {"table"}, "tfoot": {"table"}, "option": {"select"}}
#: Never the article, whatever stands inside.
STRANGE = set("""ad ads adv advert adverts advertisement advertising adsbygoogle banner sponsor sponsored promo promotion
cookie cookies consent gdpr comment comments commentlist disqus reply replies respond related recommended recommendations
newsletter subscribe subscription popup modal overlay share sharing social breadcrumb breadcrumbs pagination pager login
signup paywall toast""".split())
#: Not the article, unless one stands inside.
AROUND = set("""nav navbar navigation topnav sidenav subnav menu menus sidebar sidebars footer header masthead topbar toolbar widget widgets
notice notices notification alert alerts announcement copyright legal disclaimer search skip aside""".split())
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alertdialog",
         "alert", "menu", "menubar", "toolbar"}
MAIN = set("content main article post entry story articlebody postbody".split())

TAG = re.compile("<(/)?[a-zA-Z]")
NAME_END, QUOTE_OR_END = re.compile(r"[\s/>]"), re.compile("[\"'>]")
#: One attribute after the other, so that nothing inside a value is taken for a name.
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?|\"[^\"]*\"|'[^']*'")
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
#: Slots deeper than this are part of their ancestor there; elements are followed at any depth.
MOST_DEPTH = 200
#: Pairs of children that are compared one by one.
MOST_CELLS = 40_000
#: Code points of a block that is taken for prose, on pages without a named article.
LONG_BLOCK = 200
PLAIN, ARTICLE_LIKE, ARTICLE = 0, 1, 2


def _names(value: str) -> set[str]:
    return {p.lower() for p in PARTS.findall(value)} | set(re.split(r"[^a-z0-9]+", value.lower()))


class Slot:
    """A place in a page: neighbouring siblings of one kind share one."""

    __slots__ = ("key", "kids", "number", "size", "shape")

    def __init__(self, key: str, number: int):
        self.key, self.kids, self.number, self.size, self.shape = key, [], number, 1, 0


class Open:
    """An element that is open while a page is parsed."""

    __slots__ = ("tag", "slot", "out", "level", "link")

    def __init__(self, tag, slot, out, level, link):
        self.tag, self.slot, self.out, self.level, self.link = tag, slot, out, level, link


class Tokens:
    """The tokens of a page: (text, end tag?, tag, attributes, where it ends). Linear in the page's length.

    A tag whose quotes or bracket are never closed isn't one. What a search in vain has seen is remembered, so that no part of
    the page is searched again and again.
    """

    def __init__(self, page: str):
        self.page = page
        self.vain: set[int] = set()  # opening quotes from which no end is reached
        #: For each pattern a stretch without it: where it starts, and what ends it (-1: none yet).
        self.last = {NAME_END: (0, -1), QUOTE_OR_END: (0, -1)}

    def _next(self, what: re.Pattern, at: int) -> int:
        start, end = self.last[what]
        if not start <= at <= end:
            m = what.search(self.page, at)
            end = m.start() if m else len(self.page)
            self.last[what] = (at, end)
        return end

    def _tag_end(self, at: int) -> int:
        """The place of the bracket that ends a tag, quoted values left out; -1 if there is none."""
        seen = []
        while (at := self._next(QUOTE_OR_END, at)) < len(self.page):
            if self.page[at] == ">":
                return at
            close = -1 if at in self.vain else self.page.find(self.page[at], at + 1)
            if close < 0:
                seen.append(at)
                break
            seen.append(at)
            at = close + 1
        self.vain.update(seen)
        return -1

    def at(self, position: int) -> tuple[str | None, bool, str | None, str, int]:
        page, n = self.page, len(self.page)
        if page[position] != "<":
            end = page.find("<", position)
            end = n if end < 0 else end
            return page[position:end], False, None, "", end
        if page.startswith("<!--", position):
            end = page.find("-->", position + 4)
            return None, False, None, "", n if end < 0 else end + 3
        tag = TAG.match(page, position)
        if tag:
            name = self._next(NAME_END, tag.end())
            end = self._tag_end(name)
            if end >= 0:
                return None, bool(tag[1]), page[tag.end() - 1:name], page[name:end], end + 1
            if not tag[1]:
                cut_off = page.find("<", position + 1) < 0
                return (None, False, None, "", n) if cut_off else ("<", False, None, "", position + 1)
        if page[position + 1:position + 2] in ("!", "?", "/") and position + 1 < n:
            end = page.find(">", position)
            return None, False, None, "", n if end < 0 else end + 1
        return "<", False, None, "", position + 1


KINDS: dict[tuple[str, str, bool], tuple[str, str, int]] = {}


def _kind(tag: str, attributes: str, inside: bool) -> tuple[str, str, int]:
    """(key, how far outside the article: '' / around / strange, level). ``inside``: in a named article."""
    if (tag, attributes, inside) not in KINDS:
        if len(KINDS) > 10_000:
            KINDS.clear()
        KINDS[tag, attributes, inside] = _read_kind(tag, attributes, inside)
    return KINDS[tag, attributes, inside]


def _leading(label: str) -> set[str]:
    """The first part of each class or id: 'comment-body' is a comment, 'category-social' isn't social."""
    return {re.split("[-_:]", token)[0].lower() for token in label.split()}


def _closing(label: str) -> set[str]:
    """The last part of each class or id: 'site-footer' is a footer, 'legal-analysis' is an analysis."""
    return {re.split("[-_:]", token)[-1].lower() for token in label.split()}


def _read_kind(tag: str, attributes: str, inside: bool) -> tuple[str, str, int]:
    named = {}
    for m in ATTRIBUTE.finditer(attributes):
        if m[1] and m[1].lower() not in named:
            named[m[1].lower()] = m[2] or m[3] or m[4] or ""
    label = f"{named.get('class', '')} {named.get('id', '')}"
    names = _names(label) if label != " " else ()
    role = named.get("role", "").lower()
    out, level = "", PLAIN
    if tag in SKIPPED or "hidden" in named or named.get("aria-hidden") == "true" or re.search(
            r"display\s*:\s*none", named.get("style", "")):
        out = "strange"
    elif tag in ("article", "main") or role in ("main", "article") or named.get("itemprop", "").lower() == "articlebody":
        level = ARTICLE
        # themes name an article after its categories and tags as well
        out = "strange" if names and not STRANGE.isdisjoint(_leading(label)) else ""
    elif tag not in ("html", "body") and tag not in INLINE:
        if names and not STRANGE.isdisjoint(names):
            out = "strange"
        elif tag in ASIDE or role in ROLES:
            out = "around"
        elif names and not (AROUND - {"header"} if not MAIN.isdisjoint(names) else AROUND).isdisjoint(
                _closing(label) if inside else names):
            out = "around"  # an article's header holds its title
        if names and not out and not MAIN.isdisjoint(names):
            level = ARTICLE_LIKE
    elif tag in INLINE and names and not STRANGE.isdisjoint(names):
        out = "strange"
    return f"{tag}.{'.'.join(sorted(n for n in names if n and not n.isdigit()))}" if names else tag, out, level


def parse(page: str) -> tuple[list[Slot], list[tuple[int, str, str, int, float]]]:
    """The slots in the order they open (the first is the root), and the blocks of text: (slot, text, out, level, share of link text).

    ``out`` is '' for blocks that may be the article. Markup that is broken or cut off is read as far as it goes.
    """
    root = Slot("#", 0)
    slots, blocks = [root], []
    stack = [Open("#", root, "", PLAIN, False)]
    held: list[str] = []
    linked = 0
    at = None
    position, n = 0, len(page)
    tokens, opened = Tokens(page), Counter()

    def flush():
        nonlocal held, linked
        if held:
            whole = html.unescape("".join(held))
            text = " ".join(whole.split())
            if text:
                blocks.append((at.slot.number, text, at.out, at.level, linked / max(1, len(whole))))
            held, linked = [], 0

    def close(to: int):
        while len(stack) > to:
            opened[stack.pop().tag] -= 1

    while position < n:
        text, end, tag, attributes, position = tokens.at(position)
        if text is not None:
            top = stack[-1]
            if not held:
                at = top
            elif at.out != top.out and not text.isspace():  # an inline element that isn't the article
                flush()
                at = top
            held.append(text)
            if top.link:
                linked += len(text)
            continue
        if tag is None:
            continue
        tag = tag.lower()
        inline = tag in INLINE
        if end:
            if not inline:
                flush()
            for i in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                if stack[i].tag == tag:
                    close(i)
                    break
                if inline and stack[i].tag not in INLINE:
                    break
            continue
        if tag == "br":
            held.append(" ")
            at = at if len(held) > 1 else stack[-1]
            continue
        if not inline:
            flush()
            shuts = CLOSES.get(tag)
            some = opened["p"] or shuts and any(opened[name] for name in shuts)
            for i in range(len(stack) - 1, 0, -1) if some else ():
                name = stack[i].tag
                if name == "p" or shuts and name in shuts:
                    close(i)
                    if not shuts or name != "p":
                        break
                elif name not in INLINE:
                    if not shuts or name in SCOPE.get(tag, ()):
                        break
            while stack[-1].tag in INLINE and len(stack) > 1 and stack[-1].tag != "a":
                close(len(stack) - 1)  # formatting that was never closed ends with its block
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        top = stack[-1]
        key, out, level = _kind(tag, attributes if tag != "a" or "class" in attributes else "", top.level == ARTICLE)
        if level == ARTICLE and not out and top.out == "around":
            inherited = ""
        elif tag in ("h1", "h2", "h3", "h4", "h5", "h6") and top.level == ARTICLE and top.tag == "header":
            inherited = "" if top.out == "around" else top.out  # the article's own title
        else:
            inherited = top.out
        out = "strange" if "strange" in (out, inherited) else out or inherited
        level = max(level, top.level)
        if tag in RAW:
            close_tag = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, position)
            position = close_tag.end() if close_tag else n
            continue
        if page[position - 2] == "/" and tag in ("svg", "math"):
            continue
        slot = top.slot
        if not inline and len(stack) < MOST_DEPTH:
            if slot.kids and slot.kids[-1].key == key:
                slot = slot.kids[-1]
            else:
                child = Slot(key, len(slots))
                slot.kids.append(child)
                slots.append(child)
                slot = child
        stack.append(Open(tag, slot, out, level, top.link or tag == "a"))
        opened[tag] += 1
    flush()
    return slots, blocks


def skeleton(slots: list[Slot]) -> str:
    """The slot tree as text; what hangs deeper than the parser goes is part of its parent."""
    out = []

    def walk(slot):
        out.append(slot.key.replace("(", "").replace(")", "").replace(" ", ""))
        if slot.kids:
            out.append("(")
            for kid in slot.kids:
                walk(kid)
            out.append(")")

    walk(slots[0])
    return " ".join(out)


def from_skeleton(text: str) -> Slot:
    """The root of a slot tree; slots are numbered in reading order."""
    root = Slot("", -1)
    stack, number = [root], 0
    for token in text.split(" "):
        if token == "(":
            stack.append(stack[-1].kids[-1])
        elif token == ")":
            stack.pop()
        else:
            stack[-1].kids.append(Slot(token, number))
            number += 1
    todo = [root.kids[0]]
    for slot in todo:
        todo += slot.kids
    for slot in reversed(todo):  # children before their parents
        slot.size = 1 + sum(kid.size for kid in slot.kids)
        slot.shape = text_hash(f"{slot.key} {' '.join(str(kid.shape) for kid in slot.kids)}")
    return root.kids[0]


def tree_matching(a: Slot, b: Slot) -> tuple[int, list[tuple[int, int]]]:
    """Simple tree matching: the size of the largest match that keeps order and depth, and its pairs of slots.

    Equal subtrees at the beginning and the end of two lists of children match as they are. Of more than ``MOST_CELLS`` pairs of
    the others, the next ones of equal kind are matched in order.
    """
    if a.key != b.key:
        return 0, []
    if a.shape == b.shape:
        return a.size, _alike(a, b)
    pairs, size = [(a.number, b.number)], 1
    first, rest_a, rest_b = 0, len(a.kids), len(b.kids)
    while first < min(rest_a, rest_b) and a.kids[first].shape == b.kids[first].shape:
        pairs += _alike(a.kids[first], b.kids[first])
        size += a.kids[first].size
        first += 1
    while min(rest_a, rest_b) > first and a.kids[rest_a - 1].shape == b.kids[rest_b - 1].shape:
        rest_a, rest_b = rest_a - 1, rest_b - 1
        pairs += _alike(a.kids[rest_a], b.kids[rest_b])
        size += a.kids[rest_a].size
    more, found = _match_lists(a.kids[first:rest_a], b.kids[first:rest_b])
    return size + more, pairs + found


def _alike(a: Slot, b: Slot) -> list[tuple[int, int]]:
    """The pairs of two equal trees; numbers follow the reading order."""
    return [(a.number + i, b.number + i) for i in range(a.size)]


def _match_lists(left: list[Slot], right: list[Slot]) -> tuple[int, list[tuple[int, int]]]:
    rows, columns = len(left), len(right)
    if rows * columns > MOST_CELLS:
        size, pairs, at = 0, [], 0
        places: dict[str, list[int]] = {}
        for j, y in enumerate(right):
            places.setdefault(y.key, []).append(j)
        for x in left:
            j = next((j for j in places.get(x.key, [])[bisect_left(places.get(x.key, []), at):][:1]), None)
            if j is not None:
                n, found = tree_matching(x, right[j])
                size, pairs, at = size + n, pairs + found, j + 1
        return size, pairs
    found = {(i, j): tree_matching(x, y) for i, x in enumerate(left) for j, y in enumerate(right) if x.key == y.key}
    best = [[0] * (columns + 1) for _ in range(rows + 1)]
    for i in range(1, rows + 1):
        for j in range(1, columns + 1):
            w = found[i - 1, j - 1][0] if (i - 1, j - 1) in found else 0
            best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + w)
    pairs, i, j = [], rows, columns
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            pairs += found[i - 1, j - 1][1]
            i, j = i - 1, j - 1
    return best[rows][columns], pairs


class Aligner:
    """Names the slots of pages after the slots of their host's reference tree; remembers trees seen before."""

    def __init__(self):
        self.references, self.seen = {}, {}

    def names(self, tree: str, reference: str | None) -> list[str]:
        """The name of each slot of a page in the order of its skeleton."""
        if (tree, reference) not in self.seen:
            if len(self.seen) > 10_000:
                self.seen.clear()
            page = from_skeleton(tree)
            pairs = {}
            if reference is not None:
                if len(self.references) > 1_000:
                    self.references.clear()
                if reference not in self.references:
                    self.references[reference] = from_skeleton(reference)
                pairs = dict(tree_matching(page, self.references[reference])[1])
            out = []

            def walk(slot, path):
                path = f"{path}/{slot.key}"
                out.append(f"={pairs[slot.number]}" if slot.number in pairs else path)
                for kid in slot.kids:
                    walk(kid, path)

            walk(page, "")
            self.seen[tree, reference] = out
        return self.seen[tree, reference]


def _in_reading_order(slots: list[Slot]) -> list[int]:
    """For each slot's number its place in the skeleton."""
    place = [0] * len(slots)
    stack, n = [slots[0]], 0
    while stack:
        slot = stack.pop()
        place[slot.number] = n
        n += 1
        stack += reversed(slot.kids)
    return place


def read_page(page: str | None) -> tuple[str, list[int], list[str], list[str], list[int], list[float]]:
    """The skeleton, then for each block its slot's place in the skeleton, text, out, level, share of link text."""
    slots, blocks = parse(page or "")
    place = _in_reading_order(slots)
    number, text, out, level, link = (list(c) for c in zip(*blocks)) if blocks else ([],) * 5
    return skeleton(slots), [place[i] for i in number], text, out, level, link


def whole_texts(names: list[str], texts: list[str], outs: list[str]) -> dict[str, str]:
    """What a page says in each slot that may be the article."""
    whole: dict[str, list[str]] = {}
    for name, text, out in zip(names, texts, outs):
        if not out:
            whole.setdefault(name, []).append(text)
    return {k: " ".join(v) for k, v in whole.items()}


def text_hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "big", signed=True) | 1


def main_text(names: list[str], texts: list[str], outs: list[str], levels: list[int], links: list[float],
              template: dict[str, int], everywhere: dict[str, int] | None = None) -> str:
    """The text of a page from its blocks and the constant slots (name: text hash) of its host.

    ``template`` holds for pages without a named article, ``everywhere`` inside one.
    """
    inside = [i for i, out in enumerate(outs) if not out]
    level = max((levels[i] for i in inside), default=PLAIN)
    inside = [i for i in inside if levels[i] == level]
    content = inside
    if template := template if level == PLAIN else everywhere:
        constant = {k for k, v in whole_texts(names, texts, outs).items() if template.get(k) == text_hash(v)}
        content = [i for i in inside if names[i] not in constant]
    def length(some):
        return sum(len(texts[i]) for i in some)

    if level == PLAIN:
        content = [i for i in content if links[i] < 0.5]
        # a host whose pages have one body under their own headlines: long prose that outweighs what varies is no template
        prose = [i for i in inside if links[i] < 0.2 and len(texts[i]) >= LONG_BLOCK]
        if 4 * length(content) < length(prose):
            content = sorted({*content, *prose})
    elif 2 * length(content) < length(inside):  # what most of an article says is not its template, even if nothing varies
        content = inside
    return " ".join(texts[i] for i in content)


BLOCKS = ("tree string, slots array<int>, texts array<string>, outs array<string>, levels array<int>, "
          "links array<double>")
KINDS_OF_BLOCKS = [pa.string(), pa.list_(pa.int32()), pa.list_(pa.string()), pa.list_(pa.string()),
                   pa.list_(pa.int32()), pa.list_(pa.float64())]


def read_pages(pages: DataFrame) -> DataFrame:
    """``pages`` with their html read to blocks (and left out)."""
    rest = [c for c in pages.columns if c != "html"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = zip(*map(read_page, batch.column("html").to_pylist())) if batch.num_rows else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in rest), *(pa.array(c, k) for c, k in zip(made, KINDS_OF_BLOCKS))],
                [*rest, *(x.split()[0] for x in BLOCKS.split(", "))])

    schema = T.StructType([*pages.drop("html").schema.fields, *T.StructType.fromDDL(BLOCKS).fields])
    return pages.mapInArrow(read, schema)


def induce(read: DataFrame, min_pages: int = 3, share: float = 0.8) -> DataFrame:
    """The wrappers of hosts: ``host``, ``reference`` (a tree) and ``template`` (name and text hash of constant slots).

    ``read`` has ``host`` and the columns of ``read_pages``. A slot is constant if one text fills it in at least
    ``min_pages`` pages and is ``usual``, in ``share`` of the host's pages, or ``everywhere``, in as many as have a named
    article. Pages with equal blocks count once.
    """
    counts = read.groupBy("host", "tree").count()
    references = stored(counts.groupBy("host").agg(
        F.max_by("tree", F.struct("count", "tree")).alias("reference"), F.sum("count").alias("pages")))

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner()
        for batch in batches:
            rows = []
            for host, tree, reference, slots, said, outs, levels, page in zip(*(batch.column(c).to_pylist() for c in (
                    "host", "tree", "reference", "slots", "texts", "outs", "levels", "page"))):
                names = aligner.names(tree, reference)
                rows.append((host, "", 0, page))
                if any(level != PLAIN and not out for level, out in zip(levels, outs)):
                    rows.append((host, "", 1, page))
                for name, text in whole_texts([names[i] for i in slots], said, outs).items():
                    rows.append((host, name, text_hash(text), page))
            columns = list(zip(*rows)) if rows else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.int64()))],
                ["host", "slot", "hash", "page"])

    often = references.where(F.col("pages") >= min_pages)
    said = read.select("host", "tree", "slots", "texts", "outs", "levels", F.xxhash64("tree", "slots", "texts").alias("page"))
    said = with_wrapper(said, often, "inner").mapInArrow(texts, "host string, slot string, hash bigint, page bigint")
    # a text of one host in one slot, by the number of different pages
    said = said.distinct().groupBy("host", "slot", "hash").agg(F.count("*").alias("n"))
    said = stored(said.where((F.col("n") >= min_pages) | (F.col("slot") == "")))
    hosts = said.where("slot = ''").groupBy("host").agg(
        F.max(F.when(F.col("hash") == 0, F.col("n"))).alias("all"), F.max(F.when(F.col("hash") == 1, F.col("n"))).alias("named"))
    slots = said.where("slot <> ''").groupBy("host", "slot").agg(F.max(F.struct("n", "hash")).alias("top"))
    slots = slots.join(hosts, "host").select(
        "host", "slot", F.col("top.hash").alias("hash"), (F.col("top.n") >= share * F.col("all")).alias("usual"),
        F.coalesce(F.col("top.n") >= F.col("named"), F.lit(False)).alias("everywhere"))
    constant = slots.where("usual OR everywhere")
    constant = constant.groupBy("host").agg(F.collect_list(F.struct("slot", "hash", "usual", "everywhere")).alias("template"))
    return stored(references.drop("pages").join(constant, "host", "left"))


def with_wrapper(pages: DataFrame, wrappers: DataFrame, how: str, max_broadcast: int = 16 << 20) -> DataFrame:
    """``pages`` joined to the wrappers of their hosts, which are broadcast if their trees are small together."""
    bytes_of = F.length("reference") + 200
    if "template" in wrappers.columns:
        slots = F.aggregate("template", F.lit(0), lambda total, x: total + F.length(x["slot"]) + 50)
        bytes_of = bytes_of + F.coalesce(slots, F.lit(0))
    size = wrappers.agg(F.sum(bytes_of)).first()[0] or 0
    side = F.broadcast(wrappers) if size <= max_broadcast else wrappers
    return pages.join(side, "host", how)


def extract(pages: DataFrame, url: str = "url", html: str = "html", keep: tuple[str, ...] | None = None,
            min_pages: int = 3, share: float = 0.8) -> DataFrame:
    """``pages`` with ``text``: the main text, its blocks in page order with one space between them.

    In a block every run of white space is one space and character references are decoded. The article is what
    ``article`` or ``main`` elements hold, else elements named like it, else whatever varies between the
    pages of the host and isn't mostly links. Parts that markup names as something else are left out, and so
    are constant slots; inside a named article those only that say the same on all pages with one, unless nothing would stay.

    Null or empty html has an empty text. Pages without url or host form a host of their own. Hosts with fewer than
    ``min_pages`` pages have no template; their pages are read by their markup alone. Repeated pages
    count once. A column ``text`` of ``pages`` is replaced, all others (or those in ``keep``) are kept.
    """
    kept = [c for c in pages.columns if c != "text"] if keep is None else list(keep)
    rows = pages.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row"),
                        url_host(F.col(f"`{url}`")).alias("host"), F.col(f"`{html}`").alias("html"))
    read = stored(read_pages(rows))
    joined = with_wrapper(read, induce(read, min_pages, share), "left")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner()
        for batch in batches:
            made = []
            for tree, reference, slots, said, outs, levels, links, template in zip(*(
                    batch.column(c).to_pylist() for c in ("tree", "reference", "slots", "texts", "outs", "levels",
                                                          "links", "template"))):
                names = aligner.names(tree, reference)
                made.append(main_text([names[i] for i in slots], said, outs, levels, links,
                                      *({x["slot"]: x["hash"] for x in template or () if x[kind]}
                                        for kind in ("usual", "everywhere"))))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(made, pa.string())], ["row", "text"])

    schema = rows.select("row", F.lit("").cast("string").alias("text")).schema
    return joined.mapInArrow(texts, schema).select("row.*", "text")
