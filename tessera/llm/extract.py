"""Main text of web pages by scoring the page's tree.

Blocks of text pass points, for their length and commas, to the elements around
them: all to the nearest, half to the next, less to those further out. Points are
discounted by the share of text in links. The element with the most points holds
the article; siblings that score well beside it, or read like its paragraphs,
belong to it. Menus, notices, adverts, forms and comments are cut out by their
elements and by names that mean nothing else; names that articles use too (warning,
related, discussion and so on) only make an element doubtful: it stays if the tree
puts it inside the article and it reads like text, and goes otherwise.

A page is read once, and every step takes time in proportion to its length, however
deep its elements are nested and whatever is left open.
"""

from __future__ import annotations

import re
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _shared

#: Elements that end at their own end tag only, that are cut out, that make blocks, that are no blocks.
_RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes")
_CUT = frozenset(("head", "nav", "header", "footer", "aside", "form", "button", "select", "option", "menu", "dialog", "template", "svg", "object", "audio", "video", "canvas", "map", "datalist", "fieldset"))
_BLOCK = frozenset("html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure figcaption address center details summary hgroup".split()) | _CUT
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Open elements that a start tag closes, and those that it does so within.
_CLOSES = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select")}
_FAMILIES = tuple((frozenset(a.split()), frozenset(b.split())) for a, b in dict.fromkeys(_CLOSES.values()))
_FAMILY = {k: list(dict.fromkeys(_CLOSES.values())).index(v) for k, v in _CLOSES.items()}
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_SCOPES = frozenset(("td", "th", "button", "object", "table"))
_KEEPS = frozenset(("html", "body", "main", "article"))
#: Words in a class, id or role of what is never the article, and of what may be a part of it.
_ASIDE = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertise\w*|advertising|sponsor\w*|promos?|promotion\w*|comments?|commentlist|comment-\w*|disqus|repl(?:y|ies)|cookies?|consent|gdpr|notices?|notification\w*|"
    r"side-?bars?|menus?|nav|navbar|navigation|breadcrumbs?|share|sharing|social|newsletter|subscribe|paywall|pop-?ups?|modal|foot|footer|header|masthead|"
    r"site-?header|toolbar|widgets?|login|sign-?(?:in|up)|pagination|pager|complementary|contentinfo|byline-links|outbrain|taboola)(?:$|[\s_-])",
    re.I,
)
_DOUBT = re.compile(r"(?:^|[\s_-])(?:banners?|respond|responses|discussion|alerts?|warning|rail|related|recommend\w*|read-?more|trending|popular|subscription|overlay|head|search|skip|tags?|meta|hidden)(?:$|[\s_-])", re.I)
_MAIN = re.compile(r"(?:^|[\s_-])(?:article|content|main|post|entry|story|text|body|page)(?:$|[\s_-])", re.I)
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(?:!|\?)[^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(?:^|[\s\"'/])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_RAW_END = {x: re.compile(rf"</{x}\s*(?:>|\Z)|</{x}[\s/][^>]*>", re.I) for x in _RAW}


class _Node:
    __slots__ = ("tag", "parent", "cut", "doubt", "points", "chars", "linked", "weight", "order", "line", "closed")

    def __init__(self, tag, parent, cut, doubt, weight, order):
        self.tag, self.parent, self.cut, self.doubt, self.weight, self.order = tag, parent, cut, doubt, weight, order
        self.points = 0.0
        self.chars = self.linked = 0
        # the nearest open paragraph or heading, and of each family the outermost element that its next one closes
        self.line = self if tag == "p" or tag in _HEADINGS else None if tag in _SCOPES or parent is None else parent.line
        closed = parent.closed if parent else (None,) * len(_FAMILIES)
        if any(tag in own or tag in within for own, within in _FAMILIES):
            closed = tuple(None if tag in within and tag not in own else up or (self if tag in own else None) for (own, within), up in zip(_FAMILIES, closed))
        self.closed = closed


def _nature(tag: str, attributes: str) -> tuple[bool, bool, float]:
    """Whether the element is cut out, whether it is doubtful, and the points it begins with."""
    weight = {"article": 25.0, "main": 20.0, "section": 3.0, "div": 3.0, "td": 2.0, "blockquote": 2.0, "ul": -2.0, "ol": -2.0, "table": -1.0}.get(tag, 0.0)
    if tag in _CUT:
        return True, False, weight
    doubt = False
    if attributes:
        for name, a, b, c in _ATTRIBUTE.findall(attributes):
            value = a or b or c
            name = name.lower()
            if name in ("class", "id", "role"):
                if tag not in _KEEPS:
                    if _ASIDE.search(value) and not (_MAIN.search(value) and tag in ("section", "div") and not re.search(r"comment|sidebar|foot|nav|ad[s_-]|menu|cookie|notice", value, re.I)):
                        return True, False, weight
                    doubt = doubt or bool(_DOUBT.search(value)) and not _MAIN.search(value)
                if _MAIN.search(value):
                    weight += 15
            elif tag not in _KEEPS and (name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I)):
                return True, False, weight
    return False, doubt, weight - 10 * doubt


def main_text(html: str) -> str:
    """The article's blocks, in page order, joined by a space; empty if there is none."""
    root = node = _Node("#", None, False, False, 0.0, 0)
    nodes, blocks = [root], []  # blocks: (node, text, characters in links)
    opened: dict[str, int] = {}  # open elements by tag
    parts: list[str] = []
    links = in_link = at = 0
    skipped, deep, within = "", 0, 0  # an inline element that is cut out: its tag, open ones of that tag, open blocks in it

    def flush():
        nonlocal parts, links
        if parts:
            if not node.cut:
                text = " ".join(unescape("".join(parts)).split())
                if text:
                    blocks.append((node, text, min(links, len(text))))
            parts, links = [], 0

    def take(text):
        nonlocal links
        if text and not skipped:
            parts.append(text)
            if in_link:
                links += len(text)

    def up_to(target):
        """Closes elements until the target is the innermost open one."""
        nonlocal node
        while node is not target:
            opened[node.tag] -= 1
            node = node.parent

    size = len(html)
    while at < size:
        found = _TOKEN.search(html, at)
        if not found:
            take(html[at:])
            break
        take(html[at : found.start()])
        at = found.end()
        tag = found[2] or found[5]
        if not tag:
            continue
        tag, ends, attributes = tag.lower(), found[1] or found[4], found[3] or found[6] or ""
        if not ends and tag in _RAW_END:
            over = _RAW_END[tag].search(html, at)
            at = over.end() if over else size
            continue
        if skipped:
            # it ends with its own end tag, or, left open, with the block around it
            if tag == skipped:
                deep += -1 if ends else 1
                if not deep:
                    skipped = ""
                continue
            if tag not in _BLOCK:
                continue
            if ends and within:
                within -= 1
                continue
            if not ends and not (within == 0 and node.line is not None):
                within += 1
                continue
            skipped = ""
        if tag == "a":
            in_link = 0 if ends else 1
        if tag in _VOID:
            if tag in ("br", "hr"):
                take(" ")
            continue
        if tag not in _BLOCK:
            if not ends and attributes and not attributes.endswith("/") and tag != "html" and _nature(tag, attributes)[0]:
                skipped, deep, within = tag, 1, 0
            continue
        flush()
        if ends:
            if opened.get(tag):
                while node.tag != tag:
                    up_to(node.parent)
                up_to(node.parent)
            in_link = 0
            continue
        if tag in ("html", "body"):
            continue
        if tag in _FAMILY and (last := node.closed[_FAMILY[tag]]):
            up_to(last.parent)
        if (line := node.line) and (line.tag == "p" or tag in _HEADINGS):
            up_to(line.parent)
        in_link = 0
        cut, doubt, weight = (True, False, 0.0) if node.cut else _nature(tag, attributes)
        node = _Node(tag, node, cut, doubt, weight, len(nodes))
        opened[tag] = opened.get(tag, 0) + 1
        nodes.append(node)
    flush()
    if not blocks:
        return ""
    for own, text, linked in blocks:
        points = min(len(text) / 100, 3.0) + text.count(",") + (len(text) >= 25)
        holder = own.parent if own.tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "pre", "dt", "dd", "figcaption", "caption", "summary", "address") and own.parent else own
        share, level, up = 1.0, 0, holder
        while up and level < 5:
            up.points += points * share
            level += 1
            share = 0.5 if level == 1 else 1 / (3 * level)
            up = up.parent
        own.chars += len(text)
        own.linked += linked
    for x in reversed(nodes[1:]):  # children come after their parents
        x.parent.chars += x.chars
        x.parent.linked += x.linked
    score = lambda x: (x.points + x.weight) * (1 - x.linked / x.chars) if x.chars else 0.0
    held = [x for x in nodes if x.chars]
    best = max(held, key=lambda x: (score(x), -x.order))
    up = best
    while up:  # an article around it is the whole of it
        if up.tag in ("article", "main") and up.chars:
            best = up
            break
        up = up.parent
    inside = {best.order}
    least = max(10.0, 0.2 * score(best))
    for x in held:
        if x.parent is best.parent and x is not best and best.parent is not None and not x.doubt:
            density = x.linked / x.chars
            if score(x) >= least or x.tag == "p" and (x.chars > 80 and density < 0.25):
                inside.add(x.order)
    # 0: outside, 1: in the article, 2: in a doubtful part of it that does not read like text
    state = [0] * len(nodes)
    for x in nodes:
        up = state[x.parent.order] if x.parent else 0
        state[x.order] = 1 if x.order in inside else 2 if up == 1 and x.doubt and x.linked * 3 > x.chars else up
    return " ".join([text for own, text, _ in blocks if state[own.order] == 1])


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row.

    A null or empty page has an empty text. Ties go to the element that begins
    first. Pages are worked on one by one, whole: repeated rows alike, an empty table
    as empty; other columns are left aside.
    """

    def work():
        def step(chunk):
            texts = [main_text(x) for x in chunk.column("html").to_pylist()]
            return {"page_id": chunk.column("page_id"), "url": chunk.column("url"), "text": texts, "n_chars": [len(x) for x in texts]}

        return step

    source = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    return _shared.map_chunks(source, work, "page_id long, url string, text string, n_chars long", "html")
