"""Main text of web pages by scoring the tree.

Paragraphs pass points for their length and commas to their ancestors, less the higher they
stand and less the more of the text is links. The element with the most points, or the article
around it, is kept, with siblings that score well or read like text. Menus, forms, adverts,
comments and the like are left out by element, role and name before scoring.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entiva.llm.common import ship

#: Elements that end a block of text.
BLOCKS = frozenset(
    "address article aside blockquote body br button canvas caption center dd details dialog dir "
    "div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html "
    "legend li main menu nav noscript ol optgroup option output p pre section select summary "
    "table tbody td tfoot th thead tr ul video".split()
)
VOID = frozenset(
    "area base br col embed frame hr img input keygen link meta param source track wbr".split()
)
#: Elements whose content is no markup.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
DROPPED = frozenset(
    "head script style noscript template iframe object embed svg math canvas nav menu aside "
    "footer form button select option textarea input dialog audio video map title link meta "
    "noembed noframes".split()
)
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar "
    "toolbar form status note".split()
)
_bad = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|nav|navbar|navigation|menu|"
    r"breadcrumbs?|sidebar|side|widget|footer|foot|header|masthead|topbar|toolbar|comments?|"
    r"commentlist|disqus|respond|replies|reply|cookies?|consent|gdpr|notice|alert|popup|modal|"
    r"overlay|newsletter|subscribe|subscription|signup|login|share|sharing|social|related|"
    r"recommend\w*|outbrain|taboola|pagination|pager|tags|toc|search|form|skip|hidden|"
    r"copyright|legal|disclaimer|paywall)(?=$|[\s_-])"
)
_good = re.compile(
    r"(?:^|[\s_-])(?:article|body|content|entry|main|page|post|text|story|blog)(?=$|[\s_-])"
)
#: Names that a good word beside them does not redeem.
_strong = re.compile(
    r"(?:^|[\s_-])(?:comments?|commentlist|disqus|respond|replies|reply|share|sharing)(?=$|[\s_-])"
)
#: Parts of a name that tell what the page has or has not, not what the element is.
_modifier = re.compile(
    r"(?:(?<=\s)|^)(?:has|no|with|without)[_-]\S+|"
    r"(?:(?<=\s)|^)comments?[_-](?:open|closed|enabled|disabled|on|off)(?=\s|$)"
)
#: Elements that an open one of the same group ends.
ENDED_BY = {
    "li": frozenset({"li"}),
    "dt": frozenset({"dt", "dd"}),
    "dd": frozenset({"dt", "dd"}),
    "tr": frozenset({"tr", "td", "th"}),
    "td": frozenset({"td", "th"}),
    "th": frozenset({"td", "th"}),
    "option": frozenset({"option"}),
}
#: An end is not looked for beyond these.
SCOPES = frozenset("html body table ul ol dl article section div main nav aside footer".split())

LISTS = ("ul", "ol", "dl", "table")

_name = re.compile(r"<(/?)([A-Za-z][^\s/>]*)")
#: The rest of a tag: quoted values may hold its closing sign. Nothing is tried twice.
_rest = re.compile(r"""((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_attribute = re.compile(
    r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?"""
)


class Node:
    __slots__ = (
        "tag", "parent", "parts", "names", "out", "score", "chars", "linked", "commas", "prose",
        "spared", "wraps",
    )

    def __init__(self, tag: str, parent: Node | None):
        self.tag = tag
        self.parent = parent
        self.parts: list[str | Node] = []
        self.names = ""
        self.out = False
        self.score = 0.0
        self.chars = self.linked = self.commas = self.prose = 0
        self.spared = False
        self.wraps = False


def tags(source: str) -> Iterator[tuple[int, int, bool, str | None, str]]:
    """``start, end, closes, name, attributes`` of each tag in page order; comments and
    declarations have no name. Who iterates sends the place to go on from, or None.

    From the first tag on that no sign closes outside quotes, quotes do not count: a broken
    one then spoils a tag, not the page, and nothing is searched again and again.
    """
    position, quotes = 0, True
    while (start := source.find("<", position)) >= 0:
        if source.startswith("<!--", start):
            close = source.find("-->", start + 4)
            end = close + 3 if close >= 0 else len(source)
            found = (start, end, False, None, "")
        elif source.startswith(("<!", "<?"), start):
            close = source.find(">", start)
            if close < 0:
                return
            end = close + 1
            found = (start, end, False, None, "")
        elif opening := _name.match(source, start):
            rest = _rest.match(source, opening.end()) if quotes else None
            if rest is None:
                quotes = False
                close = source.find(">", opening.end())
                if close < 0:
                    return
                end, attributes = close + 1, source[opening.end() : close]
            else:
                end, attributes = rest.end(), rest[1]
            found = (start, end, bool(opening[1]), opening[2].lower(), attributes)
        else:
            position = start + 1
            continue
        moved = yield found
        position = end if moved is None else moved


def parse(source: str) -> tuple[Node, list[Node]]:
    """The tree of a page, and its elements in page order; tolerant of missing ends."""
    root = Node("html", None)
    nodes = [root]
    open_ = [root]
    names = Counter()  # of the open elements
    endless: set[str] = set()  # raw elements that nothing ends from here on
    at = 0
    scan = tags(source)
    found = next(scan, None)

    def close(depth: int) -> None:
        names.subtract(one.tag for one in open_[depth:])
        del open_[depth:]

    while found is not None:
        start, end, closes, tag, attributes = found
        moved = None
        if start > at:
            open_[-1].parts.append(source[at:start])
        at = end
        if tag is None or (tag == "html" and not closes and len(open_) == 1):
            pass
        elif closes:
            for depth in range(len(open_) - 1, 0, -1) if names[tag] > 0 else ():
                if open_[depth].tag == tag:
                    close(depth)
                    break
                if open_[depth].tag in SCOPES and tag not in SCOPES:
                    break
        else:
            if tag in BLOCKS and tag != "br":
                ended = ENDED_BY.get(tag, frozenset()) | {"p"}
                if any(names[one] > 0 for one in ended):
                    for depth in range(len(open_) - 1, 0, -1):
                        if open_[depth].tag in ended:
                            close(depth)
                        elif open_[depth].tag in SCOPES:
                            break
            node = Node(tag, open_[-1])
            open_[-1].parts.append(node)
            nodes.append(node)
            if attributes:
                describe(node, attributes)
            if tag in RAW:
                over = None
                if tag not in endless:
                    over = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(source, at)
                if over is not None:
                    at = moved = over.end()
                elif tag in ("title", "textarea", "iframe"):
                    endless.add(tag)
                else:
                    at = moved = len(source)
            elif tag not in VOID and (
                not attributes.endswith("/") or tag in BLOCKS or tag == "a"
            ):
                open_.append(node)
                names[tag] += 1
        try:
            found = scan.send(moved)
        except StopIteration:
            found = None
    if at < len(source):
        open_[-1].parts.append(source[at:])
    return root, nodes


def describe(node: Node, attributes: str) -> None:
    names = []
    for match in _attribute.finditer(attributes):
        name = match[1].lower()
        value = (match[2] or match[3] or match[4] or "").lower()
        if name in ("class", "id"):
            names.append(value)
        elif name == "role":
            node.out |= value in DROPPED_ROLES
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            node.out = True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            node.out = True
    node.names = _modifier.sub("", " ".join(names))


def is_out(node: Node) -> bool:
    if out_by_kind(node):
        return True
    if node.spared or not node.names or node.tag in ("body", "html", "main"):
        return False
    if _strong.search(node.names):
        return True
    if node.tag == "article":
        return False
    return bool(_bad.search(node.names)) and not _good.search(node.names)


def out_by_kind(node: Node) -> bool:
    return node.out or (node.tag in DROPPED and not node.wraps) or node.tag == "header"


def count_prose(nodes: list[Node]) -> int:
    """Characters of paragraph text in every element, and in all; what is out by kind or stands
    in a link does not count, nor do parts under comment, reply and share names."""
    for one in reversed(nodes):
        one.prose = 0
        if out_by_kind(one) or one.tag == "a":
            continue
        for part in one.parts:
            if isinstance(part, str):
                text = part.strip()
                if len(text) >= 25 or one.tag in ("p", "pre", "blockquote"):
                    one.prose += len(text)
            elif not (part.names and _strong.search(part.names)):
                one.prose += part.prose
    return nodes[0].prose


def keep_wrapping_forms(nodes: list[Node]) -> None:
    """Mark forms that hold most of the page's paragraph text: they wrap the page, as some
    servers do with every page, and are no form of it."""
    forms = [one for one in nodes if one.tag == "form"]
    if not forms:
        return
    for one in forms:
        one.wraps = True
    total = count_prose(nodes)
    for one in forms:
        one.wraps = one.prose > 0.5 * total


def spare(nodes: list[Node]) -> None:
    """Mark elements whose name must not decide, as the page's main text is in them.

    These hold the longest article or, on a page without articles, most of the paragraph text.
    Cards of a quarter of the text at most are no such article. Text under comment, reply and
    share names does not count, and such elements stay only for the longest article, if it is
    most of the text, or if there is no other text.
    """
    if not any(one.names and _bad.search(one.names) for one in nodes):
        return
    total = count_prose(nodes)
    gone: set[int] = set()  # what stands in an element that is out whatever its name
    lead: Node | None = None
    for one in nodes:
        if out_by_kind(one) or (one.parent is not None and id(one.parent) in gone):
            gone.add(id(one))
        elif one.tag in ("article", "main") and not (one.names and _strong.search(one.names)):
            if lead is None or one.prose > lead.prose:
                lead = one
    holders: set[int] = set()
    above = lead.parent if lead is not None else None
    while above is not None:
        holders.add(id(above))
        above = above.parent
    leads = lead is not None and lead.prose >= 0.25 * total
    for one in nodes:
        if one.names and _strong.search(one.names):
            if one.tag == "article":
                one.spared = one.prose > total
            else:
                one.spared = total == 0 or (
                    id(one) in holders and lead is not None and lead.prose > 0.5 * total
                )
        else:
            most = one.prose > 0.5 * total
            one.spared = (leads or most) if id(one) in holders else most and lead is None


def measure(node: Node, nodes: list[Node]) -> None:
    """Characters, characters in links and commas of every element, those left out aside."""
    keep_wrapping_forms(nodes)
    spare(nodes)
    for one in nodes:
        one.out = is_out(one) or (one.parent is not None and one.parent.out)
    for one in reversed(nodes):
        if one.out:
            one.chars = one.linked = one.commas = 0
            continue
        for part in one.parts:
            if isinstance(part, str):
                one.chars += len("".join(part.split()))
                one.commas += part.count(",") + part.count("،") + part.count("、")
            else:
                one.chars += part.chars
                one.linked += part.linked
                one.commas += part.commas
        if one.tag == "a":
            one.linked = one.chars


def weight(node: Node) -> float:
    points = {"article": 30.0, "main": 25.0, "div": 5.0, "section": 5.0, "td": 3.0, "pre": 3.0}
    score = points.get(node.tag, -3.0 if node.tag in ("ul", "ol", "dl", "li", "th") else 0.0)
    if node.names:
        score += 25.0 * bool(_good.search(node.names)) - 25.0 * (
            not node.spared and bool(_bad.search(node.names))
        )
    return score


def density(node: Node) -> float:
    return node.linked / node.chars if node.chars else 0.0


def best_container(nodes: list[Node]) -> Node | None:
    """The element with the most points; None if nothing reads like a paragraph."""
    scored: dict[int, Node] = {}
    for node in nodes:
        if node.out or node.chars < 25:
            continue
        if node.tag not in ("p", "pre", "td", "blockquote") and not (
            node.tag in ("div", "section", "article", "body", "main", "li")
            and any(isinstance(p, str) and len(p.strip()) >= 25 for p in node.parts)
        ):
            continue
        points = 1 + node.commas + min(node.chars // 100, 3)
        level = 0
        receiver = node.parent if node.tag in ("p", "pre", "td", "blockquote", "li") else node
        while receiver is not None and level < 4:
            if id(receiver) not in scored:
                scored[id(receiver)] = receiver
                receiver.score = weight(receiver)
            receiver.score += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
            receiver = receiver.parent
            level += 1
    best = None
    for node in scored.values():
        node.score *= 1 - density(node)
        if best is None or node.score > best.score:
            best = node
    return best


def kept_parts(nodes: list[Node]) -> list[Node]:
    best = best_container(nodes)
    whole = [n for n in nodes if n.tag in ("article", "main") and not n.out and n.chars]
    if best is None or best.tag == "html":
        # too short to score: an article is kept as it is, else what is not left out
        return [n for n in whole if not _inside(n, ("article", "main"))] or nodes[:1]
    around: Node | None = best
    while around is not None:
        if around.tag in ("article", "main"):
            best = around
            if around.tag == "article":
                break
        around = around.parent
    if best.parent is None or best.tag == "body":
        return [best]
    least = max(10.0, best.score * 0.2)
    result = []
    for part in best.parent.parts:
        if not isinstance(part, Node) or part.out:
            continue
        text_like = (
            part.tag in ("p", "h1", "h2", "h3", "h4", "pre", "blockquote") and density(part) < 0.25
        )
        scores = part.score >= least and density(part) < 0.5
        if part is best or scores or (text_like and part.chars and best.tag != "article"):
            result.append(part)
    return result


def _inside(node: Node, tags: tuple[str, ...]) -> bool:
    parent = node.parent
    while parent is not None:
        if parent.tag in tags:
            return True
        parent = parent.parent
    return False


def blocks(node: Node, found: list[str]) -> None:
    """Append the text of ``node`` block by block; inline elements do not part words."""
    run: list[str] = []
    whole = node.tag in ("article", "main") or _inside(node, ("article", "main"))

    def flush() -> None:
        text = " ".join(html.unescape("".join(run)).split())
        run.clear()
        if text:
            found.append(text)

    stack: list[tuple[Node, int]] = [(node, 0)]
    while stack:  # pages may be nested deeper than Python may recurse
        current, i = stack.pop()
        if i == 0 and current.tag in BLOCKS:
            flush()
        while i < len(current.parts):
            part = current.parts[i]
            i += 1
            if isinstance(part, str):
                run.append(part)
            elif part.out:
                if part.tag in BLOCKS:
                    flush()
            elif part.tag in LISTS and not whole and part.chars and density(part) > 0.6:
                flush()  # a list of links is a menu, but for one in an article
            else:
                stack.append((current, i))
                stack.append((part, 0))
                break
        else:
            if current.tag in BLOCKS:
                flush()
    flush()


def main_text(source: str) -> str:
    """The blocks of a page's main text, joined by one space."""
    if not source.strip():
        return ""
    root, nodes = parse(source)
    measure(root, nodes)
    found: list[str] = []
    for part in kept_parts(nodes):
        blocks(part, found)
    return " ".join(found)


def extract(
    pages: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row; nothing is shuffled.

    Null and empty pages, and pages without main text, give an empty text. Repeated rows are
    extracted each by itself, an empty table gives no rows, other columns are ignored.
    """
    rows = pages.select(
        F.col(id_column).alias("page_id"),
        F.col(url_column).alias("url"),
        F.coalesce(F.col(html_column), F.lit("")).alias("html"),
    )
    ship(pages.sparkSession)
    kinds = dict(rows.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    return rows.mapInArrow(
        run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    )
