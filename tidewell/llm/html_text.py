"""Main text of web pages by wrapper induction.

The DOM trees of the pages of a host are aligned by simple tree matching: two trees match if their
roots carry the same label, and their children are aligned so that the most nodes match in order. The
aligned trees of a host add up to its template, which counts for each node how often it occurs and how
often with which text. Nodes whose text stays the same belong to the template; the others are slots, and
the node that holds most of the varying text outside links is where the content is. Templates add
up in any order, so tasks fold their own pages first and only templates are shuffled, never pages.
"""

from __future__ import annotations

import hashlib
import html as html_lib
import json
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ._common import stored

#: Fixed values of HTML: elements by their role in the text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary "
    "table tbody td tfoot th thead title tr ul".split()
)
RAW = frozenset("script style textarea title xmp iframe noembed noframes template svg math noscript select button object".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = BLOCKS - {"body", "head", "html", "caption", "tbody", "td", "tfoot", "th", "thead", "title", "tr", "legend"}
#: An element of the key closes an open one of these, unless one of the others lies between.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "body": ({"head"}, set()),
}
#: Elements that hold the page, whatever their names.
WHOLE_PAGE = frozenset(("html", "body"))
#: Elements, roles and name parts (of class and id) that are not the article.
NOT_CONTENT = frozenset("nav header footer aside form head dialog menu search".split())
NOT_CONTENT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert".split())
NOT_CONTENT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disqus footer form header login masthead menu modal nav navbar navigation newsletter notice notices "
    "pagination pager popup promo reactions related replies reply respond search share sharing sidebar signup social "
    "sponsor sponsored subscribe toolbar widget".split()
)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

DEEPEST = 150
#: Texts that a template node remembers with their counts. Where a page has k siblings of a label side by side,
#: a text is counted k / TEXTS of the pages too low at most.
TEXTS = 64
#: A text is template if it stands at its node on more than this share of at least so many pages.
CONSTANT, LEAST_PAGES = 0.5, 2
#: Templates that one merging task takes.
MERGED = 256


class Node:
    """An element that makes blocks. ``items`` are (text, in a link), child nodes, or None between blocks."""

    __slots__ = ("tag", "label", "names", "items", "refused")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag = tag
        found = {}
        if attributes:
            for name, value in _ATTRIBUTE.findall(attributes):
                found.setdefault(name.lower(), value.strip("\"'"))
        names = f"{found.get('class', '')} {found.get('id', '')}"
        self.names = {part.lower() for part in _NAME_PARTS.findall(names)}
        # an id without its digits, which often are the page's own
        named = (found.get("class", "").split() or re.sub(r"\d+", "", found.get("id", "")).split() or [""])[0]
        self.label = f"{tag}.{named}" if named else tag
        self.items: list = []
        self.refused = (
            tag in NOT_CONTENT or found.get("role", "").lower() in NOT_CONTENT_ROLES or bool(self.names & NOT_CONTENT_NAMES)
        )
        if found.get("role", "").lower() == "main":
            self.tag = "main"

    @property
    def children(self) -> list["Node"]:
        return [item for item in self.items if isinstance(item, Node)]


def parse(html: str) -> Node:
    """The tree of block elements. Scripts, styles, comments and form controls are left out; what is
    nested deeper than a bound stays in its ancestor, as blocks of their own."""
    root = Node("#root")
    stack: list[tuple[str, Node]] = [("#root", root)]
    at = links = 0

    def add(text: str) -> None:
        if text:
            stack[-1][1].items.append((text, links > 0))

    def pop_to(index: int) -> None:
        for _, node in stack[index:]:
            stack[index - 1][1].items.append(None) if node is stack[index - 1][1] else None
        del stack[index:]

    while True:
        token = _TOKEN.search(html, at)
        if token is None:
            add(html[at:])
            return root
        add(html[at : token.start()])
        at = token.end()
        closing, tag, attributes = token.group(1, 2, 3) if token.group(2) else token.group(4, 5, 6)
        if tag is None:
            continue
        tag = tag.lower()
        if tag in RAW and not closing:
            if not attributes.endswith("/") or tag not in ("svg", "math"):
                end = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
                at = end.end() if end else len(html)
        elif tag == "a":
            links = 0 if closing else 1
        elif tag == "br":
            add(" ")
        elif tag not in BLOCKS:
            pass
        elif closing:
            for index in range(len(stack) - 1, 0, -1):
                if stack[index][0] == tag:
                    pop_to(index)
                    links = 0
                    break
        else:
            if tag in CLOSES_P:
                for index in range(len(stack) - 1, 0, -1):
                    if stack[index][0] == "p":
                        pop_to(index)
                        break
                    if stack[index][0] in ("td", "th", "caption"):
                        break
            closes, between = IMPLIED.get(tag, ((), ()))
            for index in range(len(stack) - 1, 0, -1):
                if stack[index][0] in between:
                    break
                if stack[index][0] in closes:
                    pop_to(index)
                    if tag != "tr":
                        break
            links = 0
            parent = stack[-1][1]
            if len(stack) > DEEPEST:
                parent.items.append(None)
                node = parent
            else:
                node = Node(tag, attributes)
                parent.items.append(node)
            if tag not in VOID:
                stack.append((tag, node))


def blocks(node: Node, skip) -> Iterator[str]:
    """Texts of the blocks below a node in page order, white space as one blank; ``skip`` leaves
    out whole nodes."""
    run: list[str] = []

    def flush() -> Iterator[str]:
        text = " ".join(html_lib.unescape("".join(run)).split())
        run.clear()
        if text:
            yield text

    for item in node.items:
        if isinstance(item, tuple):
            run.append(item[0])
        else:
            yield from flush()
            if item is not None and not skip(item):
                yield from blocks(item, skip)
    yield from flush()


def _amounts(node: Node) -> tuple[int, int]:
    """Characters of text below a node, and those in links."""
    text = link = 0
    for item in node.items:
        if isinstance(item, tuple):
            n = len(item[0].strip())
            text += n
            link += n * item[1]
        elif item is not None:
            t, k = _amounts(item)
            text += t
            link += k
    return text, link


# -- templates ---------------------------------------------------------------------------
# A template node is a list [label, pages, own characters, own characters in links, texts, children];
# texts maps a digest of the node's own text to the pages that have it; for adjacent siblings of one label,
# which are one node, it has the text of each.


def template_of(node: Node, seen: dict[int, list] | None = None) -> list:
    """The template of one page. Adjacent siblings of one label are one node. ``seen`` collects the
    template of every single node by its identity."""
    own = "".join(item[0] for item in node.items if isinstance(item, tuple)).strip()
    link = sum(len(item[0].strip()) for item in node.items if isinstance(item, tuple) and item[1])
    children: list[list] = []
    for child in (template_of(child, seen) for child in node.children):
        if children and children[-1][0] == child[0]:
            children[-1] = _joined(children[-1], child)
        else:
            children.append(child)
    made = [node.label, 1, len(own), link, {_digest(own): 1} if own else {}, children]
    if seen is not None:
        seen[id(node)] = made
    return made


def _digest(text: str) -> str:
    """A digest that ends with the text's length."""
    return f"{hashlib.md5(text.encode(errors='surrogatepass')).hexdigest()[:12]}:{len(text)}"


def _joined(a: list, b: list) -> list:
    """Two siblings of one page as one node."""
    children = add_templates([a[0], 0, 0, 0, {}, a[5]], [a[0], 0, 0, 0, {}, b[5]])[5]
    for child in children:
        child[1] = 1
    return [a[0], 1, a[2] + b[2], a[3] + b[3], dict.fromkeys([*a[4], *b[4]], 1), children]


def align(a: list[str], b: list[str], value) -> list[tuple[int, int]]:
    """Pairs (i, j) in order of matching labels with the greatest sum of values."""
    if a == b:
        return [(i, i) for i in range(len(a))]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            most = max(best[i + 1][j], best[i][j + 1])
            if a[i] == b[j]:
                most = max(most, best[i + 1][j + 1] + value(i, j))
            best[i][j] = most
    pairs, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j] and best[i][j] == best[i + 1][j + 1] + value(i, j):
            pairs.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return pairs


def matched(a: list, b: list) -> int:
    """Simple tree matching: the nodes of two trees that can be matched top-down and in order."""
    if a[0] != b[0]:
        return 0
    if not a[5] or not b[5]:
        return 1
    return 1 + sum(matched(a[5][i], b[5][j]) for i, j in pairs_of(a[5], b[5]))


def pairs_of(a: list[list], b: list[list]) -> list[tuple[int, int]]:
    values: dict[tuple[int, int], int] = {}

    def value(i: int, j: int) -> int:
        if (i, j) not in values:
            values[i, j] = matched(a[i], b[j])
        return values[i, j]

    return align([x[0] for x in a], [x[0] for x in b], value)


def add_templates(a: list, b: list) -> list:
    """The sum of two templates of the same label; unmatched nodes are kept in order."""
    texts = dict(a[4])
    for text, count in b[4].items():
        texts[text] = texts.get(text, 0) + count
    while len(texts) > TEXTS:  # the rarest go, and the others pay for it
        least = min(texts.values())
        texts = {text: count - least for text, count in texts.items() if count > least}
    children, i, j = [], 0, 0
    for p, q in pairs_of(a[5], b[5]) + [(len(a[5]), len(b[5]))]:
        children += a[5][i:p] + b[5][j:q]
        if p < len(a[5]):
            children.append(add_templates(a[5][p], b[5][q]))
        i, j = p + 1, q + 1
    return [a[0], a[1] + b[1], a[2] + b[2], a[3] + b[3], texts, children]


def _common(template: list) -> dict[str, int]:
    """The texts that stand at the node on most pages that have it, with the number of these."""
    if template[1] < LEAST_PAGES:
        return {}
    return {text: count for text, count in template[4].items() if count > CONSTANT * template[1]}


def fixed_chars(template: list) -> int:
    """Of the node's own characters on all pages those of texts that are template."""
    return min(template[2], sum(count * int(text.split(":")[1]) for text, count in _common(template).items()))


def constant(template: list) -> bool:
    """Whether most of the node's own text is the same on most pages that have it."""
    return template[2] > 0 and 2 * fixed_chars(template) > template[2]


def without_rare_texts(template: list) -> list:
    """A finished template: only texts that are template are still of use, and nodes that hold or lead to any."""
    return [*template[:4], _common(template), [without_rare_texts(child) for child in template[5]]]


def varying(template: list) -> float:
    """Varying characters outside links below a template node, without what its labels refuse."""
    tag, _, name = template[0].partition(".")
    if tag in WHOLE_PAGE:
        pass
    elif tag in NOT_CONTENT or {part.lower() for part in _NAME_PARTS.findall(name)} & NOT_CONTENT_NAMES:
        return 0.0
    own = 0 if constant(template) else template[2] - fixed_chars(template) - 2 * template[3]
    return max(0, own) + sum(map(varying, template[5]))


def slot_path(template: list, share: float = 0.8) -> list[int]:
    """The way down to the deepest node that holds most of the varying text."""
    path: list[int] = []
    total = varying(template)
    while total:
        amounts = [varying(child) for child in template[5]]
        best = max(range(len(amounts)), key=amounts.__getitem__, default=None)
        if best is None or amounts[best] < share * total or not template[5][best][5]:
            break
        path.append(best)
        template = template[5][best]
    return path


# -- pages -------------------------------------------------------------------------------


def _spared(root: Node) -> set[int]:
    """The nodes that are neither refused nor dropped for their links: html and body, what holds most of
    the page's text outside links, and what wraps the only article. What is marked as something else
    counts as a wrapper if the page's title is in it, or nearly all of a page without one."""
    sums: dict[int, tuple[int, int, int]] = {}

    def add(node: Node) -> tuple[int, int, int]:
        text = titles = articles = 0
        for item in node.items:
            if isinstance(item, tuple):
                text += 0 if item[1] else len(item[0].strip())
            elif item is not None:
                t, n, k = add(item)
                text, titles, articles = text + t, titles + n, articles + k
        titles += node.tag == "h1"
        articles += node.tag in ("article", "main") and not node.refused
        sums[id(node)] = text, titles, articles
        return text, titles, articles

    all_text, all_titles, all_articles = add(root)
    spared: set[int] = set()

    def look(node: Node) -> None:
        for child in node.children:
            text, titles, articles = sums[id(child)]
            most = 2 * text > all_text
            if child.tag in WHOLE_PAGE or (most and not child.refused):
                spared.add(id(child))
            elif most and (titles or articles or (not all_titles and 5 * text >= 4 * all_text)):
                spared.add(id(child))
            elif child.refused and (child.tag == "form" or child.tag not in NOT_CONTENT) and 0 < articles == all_articles:
                spared.add(id(child))
            look(child)

    look(root)
    return spared


def _article(root: Node, spared: set[int]) -> list[Node]:
    """The outermost article or main elements that are not refused; of several, those that are not links."""
    found: list[Node] = []

    def look(node: Node) -> None:
        for child in node.children:
            if child.refused and id(child) not in spared:
                continue
            if child.tag in ("article", "main"):
                found.append(child)
            else:
                look(child)

    look(root)
    found = [node for node in found if _amounts(node)[0]]
    return [node for node in found if not _linked(node)] or found


def _below(node: Node) -> Iterator[Node]:
    for child in node.children:
        yield child
        yield from _below(child)


class Wrapper:
    """The template of a host, the way to its slot, and whether its pages differ enough to tell
    what is template."""

    def __init__(self, template: list):
        self.template = template
        self.path = slot_path(template)
        self.differs = not _same_article(template, self.path)


def extract(html: str | None, wrapper: Wrapper | None = None) -> str:
    """The main text of a page, given the wrapper of its host."""
    if not html:
        return ""
    root = parse(html)
    fixed: set[int] = set()
    slot = None
    if wrapper is not None:
        seen: dict[int, list] = {}
        template_of(root, seen)
        slot = _mark(root, wrapper.template, wrapper.path, fixed, seen)
        if not wrapper.differs:
            fixed.clear()
    spared = _spared(root)
    gone = lambda node: id(node) in fixed or (node.refused and id(node) not in spared)
    articles = _article(root, spared)
    within = {id(node) for node in articles}
    if articles:
        # a title may stand before the article, and a main may hold one article and what belongs to it
        loose = {id(x) for node in articles if node.tag == "main" for x in _beside(node, spared)}

        def skip(node: Node) -> bool:
            # an article's own header holds its title
            own_header = node.tag == "header" and not node.names & NOT_CONTENT_NAMES - {"header"}
            return (gone(node) and not (own_header and id(node) not in fixed)) or (
                id(node) in loose and id(node) not in spared and _linked(node)
            )

        titles = [] if any(x.tag == "h1" for node in articles for x in _below(node)) else _titles(root, within, gone)
        return "\n".join(text for node in [*titles, *articles] for text in blocks(node, skip))
    if slot is not None and slot is not root:
        within = {id(slot), *map(id, _below(slot))}
        spared |= _way(root, slot)
    skip = lambda node: gone(node) or (id(node) not in spared and id(node) not in within and _linked(node))
    # nothing is left where all of it lies in refused elements: then only their innermost are left out
    inner = lambda node: (
        id(node) in fixed
        or node.tag in ("nav", "footer", "menu", "dialog")
        or (node.refused and not node.children)
        or (id(node) not in spared and _linked(node))
    )
    return "\n".join(blocks(root, skip)) or "\n".join(blocks(root, inner))


def _beside(main: Node, spared: set[int]) -> Iterator[Node]:
    """The nodes of a main element that are neither in an article of it nor around one."""
    if any(node.tag == "article" and not node.refused for node in _below(main)):
        for child in main.children:
            if child.tag != "article" and not any(node.tag == "article" for node in _below(child)):
                yield child
            elif child.tag != "article":
                yield from _beside(child, spared)


def _titles(node: Node, articles: set[int], gone) -> list[Node]:
    """The first-level headings outside the articles."""
    found: list[Node] = []
    for child in node.children:
        if id(child) in articles or gone(child):
            continue
        if child.tag == "h1":
            found += [] if _linked(child) else [child]
        else:
            found += _titles(child, articles, gone)
    return found


def _way(node: Node, to: Node) -> set[int]:
    """The nodes from one down to another below it."""
    if node is to:
        return {id(node)}
    for child in node.children:
        way = _way(child, to)
        if way:
            return way | {id(node)}
    return set()


def _same_article(template: list, path: list[int]) -> bool:
    """Whether most pages of the host repeat one article, so that what they share is no template."""
    for step in path:
        template = template[5][step]

    def sums(node: list) -> tuple[int, int]:
        below = [sums(child) for child in node[5]]
        return fixed_chars(node) + sum(f for f, _ in below), node[2] + sum(t for _, t in below)

    fixed, total = sums(template)
    return 2 * fixed > total


def _linked(node: Node) -> bool:
    text, link = _amounts(node)
    return text > 0 and 2 * link > text


def _mark(
    node: Node, template: list, path: list[int] | None, fixed: set[int], seen: dict[int, list]
) -> Node | None:
    """Aligns a page with the template. Collects the nodes whose text is the template's, and returns
    the node at the path, if the page has it. ``seen`` has the template of each of the page's nodes."""
    found = node if path == [] else None
    children = node.children
    runs: list[list[Node]] = []
    for child in children:
        if runs and runs[-1][0].label == child.label:
            runs[-1].append(child)
        else:
            runs.append([child])
    own = [seen[id(run[0])] for run in runs]
    for i, j in pairs_of(own, template[5]):
        part = template[5][j]
        common = _common(part)
        down = path[1:] if path and path[0] == j else None
        for child in runs[i]:
            if not child.children and seen[id(child)][4].keys() & common.keys():
                fixed.add(id(child))
            found = _mark(child, part, down, fixed, seen) or found
    return found


# -- jobs --------------------------------------------------------------------------------

_TEMPLATES = "host string, task int, template string"


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The templates of the hosts of a task's pages."""
    sums: dict[str, list] = {}
    task = 0
    for batch in batches:
        if batch.num_rows:
            task = batch.column("task")[0].as_py()
        for host, page in zip(batch.column("host").to_pylist(), batch.column("html")):
            template = template_of(parse(page.as_py()))
            sums[host] = add_templates(sums[host], template) if host in sums else template
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(list(sums), pa.string()),
            pa.array([task] * len(sums), pa.int32()),
            pa.array([json.dumps(template) for template in sums.values()], pa.string()),
        ],
        names=["host", "task", "template"],
    )


def _merge(group: pd.DataFrame) -> pd.DataFrame:
    total = None
    for text in group.sort_values("task")["template"]:
        template = json.loads(text)
        total = template if total is None else add_templates(total, template)
    return pd.DataFrame(
        {"host": [group["host"].iloc[0]], "task": [group["task"].iloc[0] // MERGED], "template": [json.dumps(total)]}
    )


def _finish(templates: pd.Series) -> pd.Series:
    return templates.map(lambda text: json.dumps(without_rare_texts(json.loads(text))))


def induce(pages: DataFrame) -> DataFrame:
    """(host, template) from rows of (host, html), over all pages."""
    found = pages.select(F.spark_partition_id().alias("task"), "host", "html").mapInArrow(_fold, _TEMPLATES)
    tasks = max(1, pages.rdd.getNumPartitions())
    while True:
        salt = F.expr(f"task div {MERGED}").alias("part")
        found = found.groupBy("host", salt).applyInPandas(_merge, _TEMPLATES)
        tasks = -(-tasks // MERGED)
        if tasks <= 1:
            return found.select("host", F.pandas_udf(_finish, "string")("template").alias("template"))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    wrappers: dict[str | None, Wrapper | None] = {None: None}
    for batch in batches:
        texts = []
        for page, template in zip(batch.column("html"), batch.column("template").to_pylist()):
            if template not in wrappers:
                if len(wrappers) > 256:
                    wrappers = {None: None}
                wrappers[template] = Wrapper(json.loads(template))
            texts.append(extract(page.as_py(), wrappers[template]))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("page_id"),
                batch.column("url"),
                pa.array(texts, pa.string()),
                pa.array(list(map(len, texts)), pa.int64()),
            ],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract_pages(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    The text is the article from the whole html: character references decoded, white space inside a
    block as one blank, trimmed, blocks joined by a line feed in page order. Pages with an article or
    main element have their text there, but for parts that are marked as something else, after a
    first-level heading outside; on others it is all blocks but those that are template, marked as
    something else, or mostly links outside the slot of the host's template. A null or empty html gives an empty text. Pages whose url is
    null or has no host share the template of the host ''. Repeated rows give repeated results; other
    columns are not read. An empty table gives no rows.
    """
    host = F.lower(
        F.regexp_extract(F.coalesce(F.col(url_col).cast("string"), F.lit("")), r"^[A-Za-z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    )
    rows = pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).alias("url"),
        host.alias("host"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"),
    )
    templates = stored(induce(rows.select("host", "html")), "templates")
    schema = rows.select("page_id", "url").schema.add("text", "string").add("n_chars", "long")
    return rows.join(templates, "host", "left").select("page_id", "url", "html", "template").mapInArrow(_extract, schema)
