"""Main text of web pages by wrappers: union-free regular expressions inferred from pages of one host.

Pages become streams of tags and texts in which every element is closed. Pages of one host whose article
lies at the same place have one template. Each distinct skeleton of a template, with what its texts have in
common on all its pages, is aligned, one after another, with the wrapper so far: siblings alike become a
repeated group, what only one side has becomes optional, and texts that differ become slots. Names of tags
and classes say where an article may be; in it, a block whose texts are the same on all pages that have it,
of several titles, belongs to the template and goes. Where a page departs from its wrapper, its own tags
are judged by the rules that marked the wrapper.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.common import Bounded, present, stored

#: Titles of pages that a block has to be the same under to be part of the template: copies of a page have one title.
SAME_TITLES = 3
#: Texts of a repeated group in one page that are compared with those of other pages; more are a slot.
GROUP_TEXTS = 16
#: Rows of an alignment of siblings between two that are kept.
KEPT_ROWS = 256
#: Skeletons that a task unites before it hands them on, and parts that those of a template are united in first.
HELD, PARTS = 500, 64
#: Elements below this depth are not part of wrappers.
DEPTH = 60

# What HTML says of its elements, and what elements and classes are called that are not the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg math textarea select object video audio canvas".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong "
    "sub sup time tt u var img wbr br".split()
)
CLOSES_PARAGRAPH = frozenset(
    "address article aside blockquote body center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
CLOSED_BY = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "option": frozenset(["option"]),
}
SCOPES = frozenset("table ul ol dl div article section main aside nav body td th button blockquote".split())
AROUND = frozenset("head title nav footer aside form button menu dialog fieldset input label legend".split()) | RAW
ARTICLE_ROOTS = frozenset("html body main article".split())
COMMENTS = frozenset("comment comments reply replies disqus respond".split())
AROUND_WORDS = COMMENTS | frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs consent cookie cookies footer gdpr masthead menu "
    "modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted promotion related share sharing "
    "sidebar signup skip social sponsor sponsored subscribe toolbar widget complementary contentinfo search alert".split()
)
MAIN_WORDS = frozenset("articlebody content entry post story".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<given>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<given2>[^>]*)(?:>|\Z)",
    re.S,
)
GIVEN = re.compile(r"(?:^|\s)(class|id|role|itemprop|hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
NO_WORDS: frozenset[str] = frozenset()


def _words(given: str) -> frozenset[str]:
    """Words of the class, role and the like; those of the id behind a #."""
    found = set()
    for name, a, b, c in GIVEN.findall(given):
        of_id = "#" if name.lower() == "id" else ""
        found.update(["hidden"] if name.lower() == "hidden" else [of_id + w for w in re.findall(r"[a-z]+", (a or b or c).lower())])
    return frozenset(found)


def events(html: str) -> list[tuple]:
    """The page's stream: ``(0, text)``, ``(1, name, words)`` at a start and ``(2, name, None)`` at the end of each element."""
    out: list[tuple] = []
    stack: list[str] = []
    at, lower = 0, None

    def close(down_to: int) -> None:
        while len(stack) > down_to:
            out.append((2, stack.pop(), None))

    while True:
        found = TOKEN.search(html, at)
        if found is None:
            if at < len(html):
                out.append((0, html[at:], None))
            break
        begin, end = found.span()
        if begin > at:
            out.append((0, html[at:begin], None))
        at = end
        name = found["name"] or found["name2"]
        if not name:
            continue
        name = name.lower()
        if found["end"] or found["end2"]:
            if name in stack:
                close(len(stack) - 1 - stack[::-1].index(name))
            continue
        given = found["given"] or found["given2"] or ""
        words = _words(given) if given else NO_WORDS
        closes = CLOSED_BY.get(name) or (frozenset(["p"]) if name in CLOSES_PARAGRAPH else None)
        if closes:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth] in closes:
                    close(depth)
                    break
                if stack[depth] in SCOPES:
                    break
        out.append((1, name, words))
        if name in VOID or given.endswith("/") and name not in ARTICLE_ROOTS and name in ("svg", "math", "path"):
            out.append((2, name, None))
        elif name in RAW:  # its content is no part of the text
            if lower is None:
                lower = html.lower()
            stop = lower.find(f"</{name}", at) if len(lower) == len(html) else -1
            if stop < 0 and len(lower) != len(html):
                match = re.compile(f"</{name}", re.I).search(html, at)
                stop = match.start() if match else -1
            at = len(html) if stop < 0 else stop
            stack.append(name)
        else:
            stack.append(name)
    close(0)
    return out


# A wrapper element is [label, name, words, occurs, children, mark]; occurs is "", "?", "+" or "*". A text is
# ["#", hashes, titles]: of what it says on every page (None if pages differ), and of the first titles of these pages.


def _label(name: str, words: frozenset[str]) -> str:
    return ".".join([name, *sorted(words)])


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(" ".join(text.split()).encode("utf-8", "replace")) >> 1


def title(stream: list[tuple]) -> int:
    """The hash of the page's title, or of all its text."""
    texts: list[str] = []
    inside = False
    for kind, value, _ in stream:
        if kind == 0 and inside and value.strip():
            texts.append(value)
        elif kind and value == "title":
            if kind == 2 and texts:
                break
            inside = kind == 1
    return _hash(" ".join(texts or [value for kind, value, _ in stream if kind == 0]))


def tree(stream: list[tuple]) -> list:
    """The stream's elements, siblings alike folded into repeated groups."""
    root: list = ["", "", [], "", [], 0]
    stack, depth, titles = [root], 0, [title(stream)]
    for kind, value, words in stream:
        if kind == 1:
            depth += 1
            if depth <= DEPTH:
                stack.append([_label(value, words), value, sorted(words), "", [], 0])
        elif kind == 2:
            if depth <= DEPTH:
                done = stack.pop()
                done[4] = folded(done[4], True)
                stack[-1][4].append(done)
            depth -= 1
        elif value.strip():
            if depth <= DEPTH:
                stack[-1][4].append(["#", [_hash(value)], titles])
            else:  # a text below the wrapper is no text that pages have in common
                stack[-1][4].append(["#", None, titles])
    root[4] = folded(root[4], True)
    return root


def folded(children: list, one_page: bool) -> list:
    """Runs of siblings with one label as one repeated element, their contents aligned."""
    out: list = []
    for child in children:
        if out and child[0] == out[-1][0]:
            if child[0] == "#":
                out[-1] = united(out[-1], child, one_page)
            else:
                last = out[-1]
                last[3] = "*" if "?" in (last[3], child[3]) or "*" in (last[3], child[3]) else "+"
                last[4] = aligned(last[4], child[4], one_page)
        else:
            out.append(child)
    return out


def _optional(node: list) -> list:
    if node[0] != "#":
        node[3] = {"": "?", "+": "*"}.get(node[3], node[3])
    return node


class Common:
    """Lengths of the longest common subsequences of what is left of two lists, a bit for each pair.

    In the row of ``a[i:]``, the bit ``m - 1 - j`` is 0 where ``b[j:]`` has one more in common than ``b[j + 1:]``. Every
    :data:`KEPT_ROWS`-th row is kept, and those up to the next are made again when they are asked for.
    """

    def __init__(self, a: list, b: list):
        self.a, self.m, self.all = a, len(b), (1 << len(b)) - 1
        self.places: dict = {}
        for j, label in enumerate(b):
            self.places[label] = self.places.get(label, 0) | 1 << (self.m - 1 - j)
        self.kept, row = {len(a): self.all}, self.all
        for i in range(len(a) - 1, -1, -1):
            row = self._before(i, row)
            if i % KEPT_ROWS == 0:
                self.kept[i] = row
        self.made: dict[int, int] = {}

    def _before(self, i: int, row: int) -> int:
        """The row of ``a[i:]`` from that of ``a[i + 1:]``."""
        found = row & self.places.get(self.a[i], 0)
        return (row + found | row - found) & self.all

    def _row(self, i: int) -> int:
        if i in self.kept:
            return self.kept[i]
        if i not in self.made:
            above = min((i // KEPT_ROWS + 1) * KEPT_ROWS, len(self.a))
            self.made, row = {}, self.kept[above]
            for k in range(above - 1, i - 1, -1):
                self.made[k] = row = self._before(k, row)
        return self.made[i]

    def without_first(self, i: int, j: int) -> bool:
        """Whether ``a[i + 1:]`` has as much in common with ``b[j:]`` as ``a[i:]`` has with ``b[j + 1:]``, or more."""
        if j == self.m:
            return True
        below, row = self._row(i + 1), self._row(i)
        left = (1 << (self.m - j)) - 1
        # Bits that are 1 are those without a gain; of j itself the row of b[j + 1:] has none.
        return (below & left).bit_count() <= (row & left >> 1).bit_count() + 1


def aligned(a: list, b: list, one_page: bool) -> list:
    """One sequence for both: longest common subsequence of labels, the rest optional."""
    n, m = len(a), len(b)
    common = Common([x[0] for x in a], [x[0] for x in b])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and a[i][0] == b[j][0]:
            out.append(united(a[i], b[j], one_page))
            i, j = i + 1, j + 1
        elif j == m or i < n and common.without_first(i, j):
            out.append(_optional(a[i]))
            i += 1
        else:
            out.append(_optional(b[j]))
            j += 1
    return folded(out, one_page)


def united(a: list, b: list, one_page: bool = False) -> list:
    """One node for both: of one page all that they say, of two pages what both say."""
    if a[0] == "#":
        says = None
        if a[1] is not None and b[1] is not None:
            says = sorted({*a[1], *b[1]}) if one_page else a[1] if a[1] == b[1] else None
        return ["#", says if says and len(says) <= GROUP_TEXTS else None, sorted({*a[2], *b[2]})[:SAME_TITLES] if says else []]
    repeated, missing = any(x[3] in ("+", "*") for x in (a, b)), any(x[3] in ("?", "*") for x in (a, b))
    return [a[0], a[1], a[2], {(0, 0): "", (0, 1): "?", (1, 0): "+", (1, 1): "*"}[repeated, missing], aligned(a[4], b[4], one_page), 0]


def _any(words, of: frozenset[str]) -> bool:
    return any(w.lstrip("#") in of for w in words)


def surrounds(name: str, words, inside: int) -> bool:
    """Whether an element is no part of an article, by its name and by its class, id and role.

    ``inside`` is the level of the article it is in, or 0. In an <article> ids are anchors of its sections.
    """
    if name in ARTICLE_ROOTS:
        return _any(words, COMMENTS)
    if name in AROUND or "hidden" in words or name == "header" and not inside:
        return True
    return bool(AROUND_WORDS.intersection(words)) if inside == 3 else _any(words, AROUND_WORDS)


def level(name: str, words) -> int:
    """How surely an element is the article: 3, 2, 1 or 0."""
    if name == "article":
        return 3
    if name == "main" or _any(words, frozenset(["main"])):
        return 2
    return int(_any(words, MAIN_WORDS))


def template(stream: list[tuple]) -> tuple[int, int]:
    """The page's highest level, and the hash of the names on the way to the first element of that level."""
    highest, where, way, around = 0, "", [], 0
    for kind, value, words in stream:
        if around:
            around += (kind == 1) - (kind == 2)
        elif kind == 1:
            if surrounds(value, words, 0):
                around = 1
                continue
            way.append(_label(value, [w for w in words if w[0] != "#"]))
            if (here := level(value, words)) > highest:
                highest, where = here, "/".join(way)
        elif kind == 2:
            way.pop()
    return highest, _hash(where)


def _constants(node: list, of: dict[int, set]) -> set:
    """Hashes of the texts in an element that are the same on every page, noted by element."""
    says: set = set()
    for child in node[4]:
        if child[0] != "#":
            says |= _constants(child, of)
        elif child[1] is not None and len(child[2]) >= SAME_TITLES:
            says.update(child[1])
    of[id(node)] = says
    return says


def marked(wrapper: list, best: int | None = None) -> list:
    """The wrapper with its elements marked: 1 main text, 2 around it, 3 main text unless it says only what is on all pages, 0 neither."""
    if best is None:
        best, stack = 0, [wrapper]
        while stack:
            for child in stack.pop()[4]:
                if child[0] != "#" and not surrounds(child[1], child[2], 0):
                    best = max(best, level(child[1], child[2]))
                    stack.append(child)
    constants: dict[int, set] = {}
    _constants(wrapper, constants)
    stack = [(wrapper, False)]
    while stack:
        node, inside = stack.pop()
        for child in node[4]:
            if child[0] == "#":
                continue
            if surrounds(child[1], child[2], best if inside else 0):
                child[5] = 2
            else:
                main = inside or best == 0 and child[1] == "body" or best > 0 and level(child[1], child[2]) == best
                child[5] = int(main)
                if inside and child[1] not in INLINE and constants[id(child)]:
                    child[5] = 3
                    child.append(sorted(constants[id(child)]))
                stack.append((child, main))
    wrapper[5] = best
    return wrapper


def infer(pages: list[str]) -> list:
    """The marked wrapper of pages of one template."""
    wrapper = None
    for page in pages:
        other = tree(events(page))
        wrapper = other if wrapper is None else united(wrapper, other)
    return marked(wrapper or tree([]))


def compact(node: list) -> list:
    """The wrapper without texts: label, occurrence, mark, children, and with mark 3 the hashes of what is on all pages."""
    return [node[0], node[3], node[5], [compact(c) for c in node[4] if c[0] != "#"], *node[6:]]


def _says_only(stream: list[tuple], at: int, hashes: list[int]) -> bool:
    """Whether all texts of the element that starts at a place of the stream are among some."""
    depth, some = 0, False
    for kind, value, _ in stream[at:]:
        depth += (kind == 1) - (kind == 2)
        if depth == 0:
            break
        if kind == 0 and value.strip():
            some = True
            if _hash(value) not in hashes:
                return False
    return some


def extract(html: str, wrapper: list | None) -> str:
    """Blocks of main text in page order, white space as one space, joined by an empty line.

    The page's own highest level decides what the article is; a wrapper of another level is not used. What
    the template says is kept where the page says nothing else.
    """
    stream = events(html)
    return _extract(html, stream, wrapper, True) or _extract(html, stream, wrapper, False)


def _extract(html: str, stream: list[tuple], wrapper: list | None, drop: bool) -> str:
    best = template(stream)[0]
    if wrapper is not None and wrapper[2] != best:
        wrapper = None
    blocks: list[str] = []
    buffer: list[str] = []

    def flush() -> None:
        if buffer:
            text = " ".join("".join(buffer).split())
            buffer.clear()
            if text:
                blocks.append(text)

    # For each open element: its place in the wrapper, the next child looked for there, and whether it is main text.
    place, following, main = [wrapper], [0], [False]
    skipped = 0
    for at, (kind, value, words) in enumerate(stream):
        if kind == 0:
            if not skipped and main[-1]:
                buffer.append(entities.unescape(value))
            continue
        if value == "br":
            buffer.append(" ")
        elif value not in INLINE:
            flush()
        if kind == 2:
            if skipped:
                skipped -= 1
            else:
                place.pop(), following.pop(), main.pop()
            continue
        if skipped:
            skipped += 1
            continue
        inside, here = main[-1], None
        if place[-1] is not None:
            label, children, start = _label(value, words), place[-1][3], following[-1]
            for k in range(start, len(children)):
                if children[k][0] == label:
                    here = children[k]
                    following[-1] = k if here[1] in ("+", "*") else k + 1
                    break
        mark = here[2] if here is not None else None
        if mark == 3 and drop and _says_only(stream, at, here[4]):
            mark = 2
        if mark is None:
            mark = 2 if surrounds(value, words, best if inside else 0) else int(
                inside or best == 0 and value == "body" or best > 0 and level(value, words) == best
            )
        if mark == 2:
            skipped = 1
            continue
        place.append(here), following.append(0), main.append(bool(mark))
    flush()
    if best == 0 and not blocks and "<body" not in html.lower():
        return _bare(stream)
    return "\n\n".join(blocks)


def _bare(stream: list[tuple]) -> str:
    """A page without a body element: all that is not around an article."""
    return extract_stream([(1, "body", NO_WORDS), *stream, (2, "body", None)])


def extract_stream(stream: list[tuple]) -> str:
    blocks, buffer, skipped = [], [], 0
    for kind, value, words in [*stream, (2, "body", None)]:
        if kind == 0:
            if not skipped:
                buffer.append(entities.unescape(value))
            continue
        if value == "br":
            buffer.append(" ")
        elif value not in INLINE:
            text = " ".join("".join(buffer).split())
            buffer = []
            if text:
                blocks.append(text)
        if skipped:
            skipped += 1 if kind == 1 else -1
        elif kind == 1 and surrounds(value, words, 0):
            skipped = 1
    return "\n\n".join(blocks)


def host(url: str = "url"):
    """The address's host in lower case, empty where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1)), F.lit(""))


def _shape(node: list) -> list:
    return [node[0], node[3], [_shape(c) if c[0] != "#" else 0 for c in node[4]]]


def _dumped(value) -> str:
    return json.dumps(value, separators=(",", ":"))


TEMPLATE = ["host", "level", "template"]


def with_template(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, host`` of every row, and ``level`` and ``template`` of the page."""
    rows = pages.select("page_id", "url", present("html").alias("html"), host().alias("host"))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = [template(events(page.as_py())) for page in batch.column(2)]
            columns = [*batch.columns, pa.array([x for x, _ in of], pa.int32()), pa.array([x for _, x in of], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "html", *TEMPLATE])

    return rows.mapInArrow(run, ", ".join([*kinds, "level int", "template long"]))


def host_wrappers(pages: DataFrame) -> DataFrame:
    """``host``, ``level``, ``template`` and ``wrapper`` of each template of each host, from all pages.

    Pages of one skeleton are united in each task first, which gives the same in any order; the skeletons
    of a template then in the order of their hashes, in parts and the parts with each other.
    """
    rows = pages.select(host().alias("host"), present("html").alias("html")).where("html <> ''")
    names = [*TEMPLATE, "skeleton", "tree"]
    schema = pa.schema([("host", pa.string()), ("level", pa.int32()), ("template", pa.int64()), ("skeleton", pa.int64()), ("tree", pa.string())])

    def skeletons(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}

        def handed() -> pa.RecordBatch:
            out = [(*key, _dumped(node)) for key, node in held.items()]
            held.clear()
            return pa.RecordBatch.from_pylist([dict(zip(names, row)) for row in out], schema=schema)

        for batch in batches:
            for name, page in zip(batch.column(0).to_pylist(), batch.column(1)):
                stream = events(page.as_py())
                node = tree(stream)
                key = (name, *template(stream), _hash(_dumped(_shape(node))))
                held[key] = united(held[key], node) if key in held else node
                if len(held) >= HELD:
                    yield handed()
        yield handed()

    def whole(table: pa.Table) -> list:
        by: dict[int, list] = {}
        for skeleton, text in zip(table["skeleton"].to_pylist(), table["tree"]):
            node = json.loads(text.as_py())
            by[skeleton] = united(by[skeleton], node) if skeleton in by else node
        wrapper = None
        for skeleton in sorted(by):
            wrapper = by[skeleton] if wrapper is None else united(wrapper, by[skeleton])
        return wrapper

    def part(table: pa.Table) -> pa.Table:
        first = table.slice(0, 1).select(TEMPLATE)
        return first.append_column("skeleton", table["part"].slice(0, 1).cast(pa.int64())).append_column("tree", pa.array([_dumped(whole(table))]))

    def last(table: pa.Table) -> pa.Table:
        wrapper = compact(marked(whole(table), table["level"][0].as_py()))
        return table.slice(0, 1).select(TEMPLATE).append_column("wrapper", pa.array([_dumped(wrapper)]))

    key = "host string, level int, template long"
    found = rows.mapInArrow(skeletons, f"{key}, skeleton long, tree string").withColumn("part", F.pmod("skeleton", F.lit(PARTS)).cast("int"))
    parts = found.groupBy(*TEMPLATE, "part").applyInArrow(part, f"{key}, skeleton long, tree string")
    return stored(parts.groupBy(*TEMPLATE).applyInArrow(last, f"{key}, wrapper string"), "wrappers")


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row with ``page_id``, ``url`` and ``html``.

    Null or empty html gives an empty text. A page cut off in the middle is read as far as it goes. Null
    and strange addresses are one host without a name. Repeated rows and ids each keep a row, an empty
    table gives none, and other columns are not read. Neither tags nor texts are dropped for length.
    """
    rows = with_template(pages)
    joined = rows.join(host_wrappers(pages), TEMPLATE, "left").select("page_id", "url", "html", "wrapper")
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:2]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Bounded(json.loads, 1000)
        for batch in batches:
            texts = [
                extract(page.as_py(), known[w] if (w := wrapper.as_py()) else None) for page, wrapper in zip(batch.column(2), batch.column(3))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return joined.mapInArrow(run, ", ".join([*kinds, "text string", "n_chars long"]))
