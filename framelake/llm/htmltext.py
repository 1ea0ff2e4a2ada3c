"""HTML extraction with site template removal.

Every page is tokenised into elements.  For each element a hash of its whole subtree is taken, all of them in one pass
from the leaves up; Spark counts them for each host, once for each page, and the subtrees that recur on many pages of a
host are that site's template and are deleted from the whole page.  Pages of a host whose text is the same (mirrors,
print views) count once.  Only then the main content is chosen from what is left: the page's article elements, else its
main element or one with that role, else the body.  Elements that are no article text by their nature (scripts, styles,
menus, headers, footers, asides, forms, adverts, notices, comments) go by tag, role, or class and id.  Outside the main
content one word of a class or id is enough, as a site may have too few pages for counting.  Inside it no name drops a
heading, a paragraph or another text block, nor a container with text of its own, but for containers that say in full
that they are reader comments, adverts or notices; others go where they are lists of links, and by the counts.

What holds main content or plain text is never template: articles, a main element and all around them, and inside the
main content text blocks (paragraphs, headings, list items, quotes) and containers that hold such blocks with text
besides links: a passage, list or table that many articles share is still text of each.

Null pages are empty and give an empty text.  Null or broken urls belong to one host without a name.  Repeated rows
count as one page for the template and get equal rows.  Unclosed and stray tags are closed and skipped; of a page cut
short, what is there is kept; a quote that is never closed ends with its tag.  Elements may be nested to any depth.
Further columns are left out.  An empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.llm.bpe import pieces
from framelake.llm.common import small_batches, written

#: A token: comment, declaration, or tag with its attributes.  A quote that has no end in its tag is an ordinary character.
_AFTER = r"(?=\s*/?>|\s+[a-zA-Z@:_-]+\s*[=/>])"
_ATTRS = rf"""(?:[^>=]++|=\s*+"[^"<]*+"(?=[\s/>])|=\s*+'[^'<]*+'(?=[\s/>])|=\s*+"[^"]*+"{_AFTER}|=\s*+'[^']*+'{_AFTER}|=)*+"""
TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)({_ATTRS})>", re.S)
ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
#: Elements by kind (fixed values of the HTML standard).  RAW content is skipped; of NESTED elements up to their own end.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg object canvas xmp noembed noframes".split())
NESTED = frozenset("noscript template svg object canvas".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split())
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre dd dt td th tr figcaption b i em strong span a u s code br sub sup small mark q cite abbr time".split())
#: Blocks whose text, links aside, makes a container part of the article.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre dd dt td th figcaption".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES_P = BLOCK - {"caption", "dd", "dt", "td", "th", "tr", "tbody", "thead", "tfoot", "li", "option", "legend", "summary", "body", "html"} | {"li", "dd", "dt"}
#: What an opening tag closes among its open siblings, and where the search for them ends.
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
DROPPED_TAGS = frozenset("nav footer aside form button select dialog menu head search annotation annotation-xml".split()) | RAW
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
#: Words of class and id that mark what is not the article (fixed values).
DROPPED_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising adsense banner banners sponsor sponsored sponsors promo promos promotion
nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars side rail header masthead topbar footer foot bottombar
cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login paywall disclaimer
comment comments commentlist disqus respond reply replies discussion share sharing social related recommended recommendations
trending widget widgets tags pagination pager toolbar skip form forms search""".split())
#: Whole names that mark a container inside the main content as something else, whatever it holds: reader comments by class
#: or id, adverts and notices by class (fixed values).
COMMENT_NAMES = frozenset("comments comment-list commentlist comments-area comments-section comment-section comment-form comment-respond respond disqus disqus-thread".split())
NOTICE_NAMES = frozenset("""ad ads advert adverts advertisement banner-ad adsense sponsored sponsored-content promo-box cookie-banner cookie-notice cookie-bar cookie-consent
    consent-banner gdpr-banner popup newsletter-signup newsletter-box newsletter-form subscribe-box""".split())
NOTICE_STARTS = frozenset("ad ads advert adverts advertisement adsense".split())
#: Whole names that mark it where it holds links, and besides them headings at most (fixed values).
LINK_NAMES = frozenset("""advertising navbar nav-bar main-nav site-nav navigation main-menu breadcrumb breadcrumbs sidebar sidebars side-bar site-header masthead
    topbar footer site-footer page-footer article-footer bottombar newsletter subscribe paywall share-buttons share-bar share-box share-links social-share
    social-links social-buttons social-media related related-posts related-articles related-content related-links related-stories recommended
    recommendations trending widget widgets pagination pager toolbar search-form login-form skip-link""".split())
#: Characters of a label beside links ("Share this:").
LABEL = 30
#: Bytes of template hashes that may be broadcast.
SMALL = 4_000_000
SPLIT = re.compile(r"[^a-zA-Z]+|(?<=[a-z])(?=[A-Z])")


@dataclass
class Node:
    tag: str
    attrs: str
    children: list = field(default_factory=list)  # nodes and strings
    hash: int = 0  # of the subtree


def parse(page: str) -> Node:
    root = Node("#root", "")
    stack = [root]
    is_open: Counter[str] = Counter()  # how many elements of a tag are open

    def close(i: int) -> None:
        is_open.subtract(x.tag for x in stack[i:])
        del stack[i:]

    at = 0
    n = len(page)
    while at < n:
        m = TOKEN.search(page, at)
        if m is None:
            rest = page[at:]
            cut = rest.rfind("<")
            # an unfinished tag at the very end is no text
            stack[-1].children.append(rest[:cut] if cut >= 0 and re.match(r"<[/a-zA-Z!]", rest[cut:]) else rest)
            break
        if m.start() > at:
            stack[-1].children.append(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if is_open[tag] > 0:
                close(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag))
            continue
        if tag in CLOSES_P and is_open["p"] > 0:
            i = next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag in BLOCK)
            if stack[i].tag == "p":
                close(i)
        if tag in IMPLIED and any(is_open[x] > 0 for x in IMPLIED[tag][0]):
            ended, stop = IMPLIED[tag]
            i = next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag in ended or stack[i].tag in stop)
            if stack[i].tag in ended:
                close(i)
        node = Node(tag, m[3] or "")
        stack[-1].children.append(node)
        if tag in NESTED:
            if tag in ("svg", "object") and node.attrs.endswith("/"):
                continue
            at = nested_end(page, at, tag, stack[-1].tag)
        elif tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else n if tag in ("script", "style") else parent_end(page, at, stack[-1].tag)
        elif tag not in VOID and not (m[3] or "").endswith("/") or tag in ("p", "div", "span", "a"):
            stack.append(node)
            is_open[tag] += 1
    return root


def parent_end(page: str, at: int, parent: str) -> int:
    end = re.compile(rf"</{re.escape(parent)}\s*>", re.I).search(page, at)
    return end.start() if end else len(page) if parent == "#root" else at


def nested_end(page: str, at: int, tag: str, parent: str) -> int:
    """Where the element that starts before at ends: after its own end tag, or else at its parent's."""
    depth = 1
    for m in re.compile(rf"<(/?){re.escape(tag)}(?=[\s/>])[^>]*>", re.I).finditer(page, at):
        depth += -1 if m[1] else not m[0].endswith("/>")
        if not depth:
            return m.end()
    return parent_end(page, at, parent)


def attributes(node: Node) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in ATTR.finditer(node.attrs)} if node.attrs.strip(" /") else {}


def unwanted(node: Node, in_main: bool) -> bool:
    if node.tag in DROPPED_TAGS:
        return True
    if node.tag == "header" and not in_main:
        return True
    if not node.attrs:
        return False
    a = attributes(node)
    if "hidden" in a or a.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", a.get("style", "")) or a.get("role", "").lower() in DROPPED_ROLES:
        return True
    if node.tag in ("html", "body", "article", "main"):
        return False
    loose = any(w.lower() in DROPPED_WORDS for k in ("class", "id") if a.get(k) for w in SPLIT.split(a[k]))
    if not loose or not in_main:
        return loose
    if node.tag in TEXT_BLOCKS:  # a heading's or paragraph's name is an anchor or a style
        return False
    named = False
    for kind in ("class", "id"):
        for name in a.get(kind, "").split():
            parts = [w.lower() for w in SPLIT.split(name) if w]
            whole = "-".join(parts)
            if whole in COMMENT_NAMES or kind == "class" and (whole in NOTICE_NAMES or parts and parts[0] in NOTICE_STARTS):
                return True
            named |= whole in LINK_NAMES or whole in NOTICE_NAMES
    return link_list(node) if named else mostly_links(node)


def walk(root: Node, enter=None) -> Iterator[tuple[Node | str, Node, int]]:
    """What is below root, in page order, with its parent and depth, without recursion; enter(node) tells whether to go into a node."""
    stack = [(root, iter(root.children))]
    while stack:
        parent, rest = stack[-1]
        c = next(rest, None)
        if c is None:
            stack.pop()
            continue
        yield c, parent, len(stack)
        if isinstance(c, Node) and (enter is None or enter(c)):
            stack.append((c, iter(c.children)))


def inherited(root: Node, of: frozenset[str], enter) -> Iterator[tuple[str, bool]]:
    """The strings below root with whether an element of these tags is around them, within root."""
    inside = [False]
    for c, parent, depth in walk(root, enter):
        del inside[depth:]
        if isinstance(c, str):
            yield c, inside[-1]
        else:
            inside.append(inside[-1] or c.tag in of)


def link_list(node: Node) -> bool:
    """Whether there are links, no paragraph, list item or quote has text outside them, and besides headings they hold most of the text, but for a label."""
    text = lambda x: len("".join(x.split()))
    into = lambda c: c.tag not in RAW
    linked = sum(text(x) for x, a in inherited(node, frozenset("a"), into) if a)
    own = any(a and x.strip() for x, a in inherited(node, PROSE - HEADINGS, lambda c: into(c) and c.tag != "a"))
    alone = sum(text(x) for x, _ in inherited(node, frozenset(), lambda c: into(c) and c.tag != "a" and c.tag not in HEADINGS))
    return linked > 0 and alone <= max(linked, LABEL) and not own


def mostly_links(node: Node) -> bool:
    """Whether links hold at least three quarters of the text, and no heading or paragraph has text outside them."""
    text = lambda x: len("".join(x.split()))
    linked = sum(text(x) for x, a in inherited(node, frozenset("a"), lambda c: c.tag not in RAW) if a)
    alone = sum(text(x) for x, a in inherited(node, frozenset("a"), lambda c: c.tag not in RAW) if not a)
    own = any(a and x.strip() for x, a in inherited(node, frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split()), lambda c: c.tag not in RAW and c.tag != "a"))
    return not own and linked >= 3 * alone


def mains(root: Node) -> list[Node]:
    found: dict[str, list[Node]] = {"article": [], "main": [], "body": []}
    skipped: set[int] = set()
    inside = [""]  # the main element around, by depth
    for c, _, depth in walk(root, lambda c: id(c) not in skipped):
        del inside[depth:]
        if not isinstance(c, Node):
            continue
        if c.tag != "header" and unwanted(c, False):
            skipped.add(id(c))
            continue
        tag = c.tag
        if tag != "article" and c.attrs and re.search(r"\brole\s*=\s*[\"']?main\b", c.attrs):
            tag = "main"
        if tag in found and tag != inside[-1]:
            found[tag].append(c)
        if tag == "article":
            skipped.add(id(c))
        else:
            inside.append(tag if tag in found else inside[-1])
    return found["article"] or found["main"] or found["body"] or [root]


def digest(node: Node) -> None:
    """Sets the hash of a node whose children have theirs."""
    h = xxhash.xxh64(node.tag)
    h.update(node.attrs.strip())
    for c in node.children:
        if not isinstance(c, str):
            h.update(c.hash.to_bytes(8, "little"))
        elif s := c.strip():
            h.update(b"\0" + s.encode("utf-8", "replace"))
    node.hash = h.intdigest()


def signed(h: int) -> int:
    return h - 2**64 if h >= 2**63 else h


def candidates(root: Node) -> dict[int, list[Node]]:
    """What could be template: the elements by their subtree hash, as signed 64-bit integers."""
    main = {id(x) for x in mains(root)}
    in_main, plain = set(main), set()  # plain: text blocks of the main content, and what is in them
    parents: dict[int, Node] = {}
    order: list[Node] = []
    for c, parent, _ in walk(root):
        if isinstance(c, Node):
            parents[id(c)] = parent
            order.append(c)
            if id(parent) in in_main:
                in_main.add(id(c))
                if id(c) not in main and (c.tag in TEXT_BLOCKS or id(parent) in plain):
                    plain.add(id(c))
    holds = set(main)  # what is around main content
    text: set[int] = set()  # elements with text besides links and what is unwanted
    prose: set[int] = set()  # elements that hold a text block with such text
    out: dict[int, list[Node]] = {}
    for c in reversed(order):  # children come before their parents
        digest(c)
        me, up = id(c), id(parents[id(c)])
        if any(isinstance(x, str) and x.strip() for x in c.children):
            text.add(me)
        if c.tag != "a" and me in in_main and (me in text or me in prose) and not unwanted(c, True):
            if me in text:
                text.add(up)
            if me in prose or c.tag in PROSE and me in text:
                prose.add(up)
        if me in holds:
            holds.add(up)
        elif me not in plain and c.tag not in RAW and c.tag not in VOID and me not in prose:
            out.setdefault(signed(c.hash), []).append(c)
    return out


def seen_on(page: str | None) -> tuple[int, list[int]]:
    """Hash of the page's text without template removal, and the hashes of the candidates."""
    if not page:
        return 0, []
    root = parse(page)
    return signed(xxhash.xxh64_intdigest(text_of(root).encode("utf-8", "replace"))), list(candidates(root))


def extract(page: str, template: frozenset[int] = frozenset()) -> str:
    """The main text of a page whose template subtrees are deleted first."""
    root = parse(page)
    if template:
        gone = {id(x) for h, nodes in candidates(root).items() if h in template for x in nodes}
        for node in [root, *(c for c, _, _ in walk(root, lambda c: id(c) not in gone) if isinstance(c, Node) and id(c) not in gone)]:
            # a deleted block still ends the line that it stood in
            node.children = [Node("hr", "") if isinstance(c, Node) and id(c) in gone else c for c in node.children]
    return text_of(root)


def text_of(root: Node) -> str:
    blocks: list[str] = []
    line: list[str] = []

    def flush() -> None:
        if line:
            if s := " ".join(entities.unescape("".join(line)).split()):
                blocks.append(s)
            line.clear()

    for m in mains(root):
        flush()
        dropped: set[int] = set()
        open_blocks: list[int] = []  # depths of the blocks that are open
        for c, _, depth in walk(m, lambda c: id(c) not in dropped):
            while open_blocks and open_blocks[-1] >= depth:
                open_blocks.pop()
                flush()
            if isinstance(c, str):
                line.append(c)
                continue
            if unwanted(c, True):
                dropped.add(id(c))
                if c.tag in BLOCK:
                    flush()
            elif c.tag == "br":
                line.append("\n")
            elif c.tag in BLOCK:
                flush()
                open_blocks.append(depth)
        flush()
    return "\n\n".join(blocks)


def host_of(url: str = "url"):
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1), F.lit("")))


def templates(pages: DataFrame, least_pages: int = 5, least_share: float = 0.2) -> DataFrame:
    """host, template: the template subtrees of each host that has any (array).

    The table has a row for each host and at most 1 / least_share times as many hashes of it as a page has elements.
    A subtree is template if it is on least_pages pages of the host at least and on least_share of them, pages with the
    same main text counted once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            got = [seen_on(p) for p in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.list_(pa.int64()))], ["pk", "host", "main", "hashes"])

    seen = pages.select("pk", "host", "html").mapInArrow(run, "pk long, host string, main long, hashes array<long>").dropDuplicates(["pk"])
    seen = written(seen, "page-hashes")  # pages are parsed once for the uses below
    rows = seen.select("pk", "host", "main", F.explode("hashes").alias("h"))
    per_host = seen.select("host", "main").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    often = rows.select("host", "h", "main").distinct().groupBy("host", "h").agg(F.count("*").alias("n")).where(f"n >= {least_pages}")
    often = often.join(per_host, "host").where(F.col("n") >= least_share * F.col("pages")).select("host", "h")
    return often.groupBy("host").agg(F.collect_list("h").alias("template"))


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row."""
    small_batches(pages.sparkSession)
    keyed = pages.select("page_id", "url", "html", host_of().alias("host"), F.xxhash64("page_id", "url", "html").alias("pk"))
    # written first, so that its size is known before the pages move: a small table goes to them, else they are dealt by host
    marks = written(templates(keyed), "templates")
    size = marks.agg(F.coalesce(F.sum(8 * F.size("template") + F.octet_length("host") + 32), F.lit(0))).first()[0]
    found = keyed.join(F.broadcast(marks) if size <= SMALL else marks, "host", "left").select("page_id", "url", "html", "template")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            texts = [extract(p, frozenset(t or ())) if p else "" for p, t in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long"
    return found.mapInArrow(run, schema)
