"""Main text of web pages by line-block distribution.

Markup is stripped to lines: every block-level tag begins a new line, so that regions of
markup without text become runs of empty lines.  Menus, headers, footers, sidebars, forms,
adverts, notices and reader comments are recognised by their element, role, class or id
and leave empty lines.  Over the lines, the text lengths (outside links) of ``WINDOW``
consecutive lines are summed; the text between a surge of these sums and the next dive to
nothing is kept.  Where the page marks its article (``article``, ``main``), only lines
inside it carry length and any length is a surge, so element and class lists alone decide
there; elsewhere a surge needs ``SURGE`` characters, and the densest stretch is taken when
none reaches that.  A shorter stretch (a heading, a table row, a closing line) is kept with
its neighbours when fewer than ``WINDOW`` empty elements, dropped lines or lines of links lie
between, tags around text not counted, and when it has a container in common with a surge.

Names of taxonomy, layout and negation ("category-social", "has-related", "ad-free") mark
nothing.  Where the lists leave no text, or little beside an element that they drop although it
holds the article or most of the page's text (a form around the page, a "widget" of a page
builder), the page is read again without dropping such elements; hidden ones stay out.

Edge cases: NULL or empty html gives an empty text; unclosed elements end with their
parent, to any depth in linear time, and an unclosed boilerplate element ends at the next block; pages of any length
are read whole; repeated rows are extracted each; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .frames import read
from .words import slices

WINDOW = 3
SURGE = 86
SCHEMA = "page_id long, url string, text string, n_chars long"

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
                    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
                    r"""|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""([^\s=/"'>]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_RAW = ("script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre
    section summary table tbody td tfoot th thead tr ul""".split())
_DROP = frozenset("""aside audio button canvas datalist dialog embed fieldset footer form head map menu nav noscript
    object option select svg template video""".split())
_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search "
                   "toolbar".split())
#: parts of class and id names that mark boilerplate
_PARTS = frozenset("""ad ads adsense advert advertisement adverts advertising banner breadcrumb breadcrumbs comment
    comments consent cookie cookies disclaimer disqus footer gdpr login menu modal nav navbar navigation newsletter
    notice notices notification pagination pager popup promo promotion related replies reply respond search share
    sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget widgets""".split())
_WEAK = frozenset(["header", "masthead", "topbar"])
#: names like "content-with-sidebar" describe the main part
_MAIN = frozenset("article body content entry has main no post with without".split())
_STRONG = frozenset("ad ads advert comment comments cookie disqus related share social sponsored".split())
_CONTENT = ("article", "main")
#: class names that say what a page is about, what it has or lacks
_ABOUT = re.compile(r"(?:category|tag|has|no|not|with|without)[-_]|.*[-_]free$", re.I)
LITTLE = 4  # text lost to one dropped element, in lengths of the text found, at which a page is read again
#: parts of a table, which is the container of their text
_ROWS = frozenset("caption tbody td tfoot th thead tr".split())
_SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[A-Z])")


def _values(attrs: str) -> dict[str, str]:
    return {k.lower(): v.strip("\"'") for k, v in _ATTR.findall(attrs)}


def _hidden(attrs: str) -> bool:
    values = _values(attrs)
    return "hidden" in values or values.get("aria-hidden") == "true" \
        or bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", values.get("style", "")))


def _marks(name: str, attrs: str, inside: bool) -> bool:
    """Whether an element's own name and attributes mark it as boilerplate."""
    if name in _DROP or name == "header" and not inside:
        return True
    if not attrs.strip() or name in ("html", "body"):
        return False
    if _hidden(attrs):
        return True
    values = _values(attrs)
    if values.get("role", "").lower() in _ROLES:
        return True
    for token in f"{values.get('class', '')} {values.get('id', '')}".split():
        if _ABOUT.match(token):
            continue
        parts = {x.lower() for x in _SPLIT.split(token) if x}
        found = parts & _PARTS
        if found & _STRONG or (found or parts & _WEAK and not inside) and not parts & _MAIN:
            return True
    return False


def _tokens(page: str):
    """(kind, a, b) tokens: text, open (name, attributes), close (name); raw elements skipped."""
    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        if not m:
            yield "text", page[at:], ""
            return
        if m.start() > at:
            yield "text", page[at: m.start()], ""
        at = m.end()
        name = m.group(2) or m.group(5)
        if name is None:
            if m.group().startswith("<![CDATA["):
                yield "text", m.group()[9:].removesuffix("]]>"), ""
            continue
        name = name.lower()
        if m.group(1) or m.group(4):
            yield "close", name, ""
            continue
        attrs = m.group(3) or m.group(6) or ""
        if name in _RAW and not attrs.endswith("/"):
            end = re.compile(rf"</{name}\s*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else size
            yield "break" if name == "title" else "text", " ", ""
            continue
        yield "open", name, attrs
        if name not in _VOID and attrs.endswith("/") and name not in _BLOCK:
            yield "close", name, ""


def _unclosed(tokens: list) -> set[int]:
    """Indexes of open tags that no close tag of their own ends."""
    stack: list[tuple[str, int]] = []
    live: Counter = Counter()
    out = set()
    for i, (kind, name, _) in enumerate(tokens):
        if kind == "open" and name not in _VOID:
            stack.append((name, i))
            live[name] += 1
        elif kind == "close" and live[name]:
            while stack[-1][0] != name:
                lost, at = stack.pop()
                live[lost] -= 1
                out.add(at)
            stack.pop()
            live[name] -= 1
    return out | {i for _, i in stack}


def _holders(tokens: list) -> dict[int, int]:
    """Text outside links of every element that holds an article or more than half of all such text."""
    stack: list[tuple[str, int, int, int]] = []  # name, index, text and contents before it
    live: Counter = Counter()
    sizes, seen, contents, links = {}, 0, 0, 0

    def pop():
        nonlocal links
        name, at, before, articles = stack.pop()
        live[name] -= 1
        links -= name == "a"
        sizes[at] = seen - before, contents > articles

    for i, (kind, name, _) in enumerate(tokens):
        if kind == "text":
            seen += 0 if links else len(" ".join(name.split()))
        elif kind == "open" and name not in _VOID:
            stack.append((name, i, seen, contents))
            contents += name in _CONTENT
            live[name] += 1
            links += name == "a"
        elif kind == "close" and live[name]:
            while stack[-1][0] != name:
                pop()
            pop()
    while stack:
        pop()
    return {i: size for i, (size, article) in sizes.items() if article or 2 * size > seen}


def lines_of(page: str, tokens: list | None = None, keep: frozenset = frozenset(),
             lost: set | None = None) -> list[tuple[str, int, bool, bool, int]]:
    """(text, length outside links, inside the marked article, void, container) of each line.

    Dropped lines are empty.  Empty lines of dropped and of empty elements are void, those of
    tags around text are not.  A container is the index of the tag that opened it.  Elements whose
    index is in ``keep`` are not dropped; indexes of dropped ones are added to ``lost``.
    """
    tokens = list(_tokens(page)) if tokens is None else tokens
    unclosed = _unclosed(tokens)
    out: list[tuple[str, int, bool, bool, int]] = []
    # name, drops, drops up to the next block, container of text in it, innermost block that is no part of a table
    stack: list[tuple[str, bool, bool, int, int]] = []
    live: Counter = Counter()
    text: list[str] = []
    linked = drops = article = links = 0
    bare = False  # no text and no other block since a block began

    def flush(ends: bool = False):
        nonlocal linked, bare
        line = " ".join(entities.unescape("".join(text)).split())
        out.append((line, max(0, len(line) - linked), bool(article), drops > 0 or ends and bare, stack[-1][3] if line and stack else -1))
        text.clear()
        linked = 0
        bare = False

    def pop():
        nonlocal drops, article, links
        name, drop, *_ = stack.pop()
        live[name] -= 1
        drops -= drop
        article -= name in _CONTENT and not drop
        links -= name == "a"

    for i, (kind, name, attrs) in enumerate(tokens):
        if kind == "text":
            if not drops:
                text.append(name)
                linked += len(name.strip()) if links else 0
        elif kind == "break":
            flush()
        elif kind == "open":
            if name in _BLOCK:
                flush()
                while stack and stack[-1][2]:
                    pop()
                if name in ("p", "li", "dt", "dd", "tr", "td", "th") or name[0] == "h" and name[1:].isdigit():
                    while stack and stack[-1][0] == "p":  # a block ends an open paragraph
                        pop()
            elif name == "br":
                text.append(" ")
            if name not in _VOID:
                drop = i not in keep and _marks(name, attrs, article > 0)
                if drop and lost is not None:
                    lost.add(i)
                home, near = stack[-1][3:] if stack else (-1, -1)
                if name in _BLOCK:
                    home, near = near, near if name in _ROWS else i
                stack.append((name, drop, drop and i in unclosed, home, near))
                live[name] += 1
                bare = bare or name in _BLOCK
                drops += drop
                article += name in _CONTENT and not drop
                links += name == "a"
        else:
            if name in _BLOCK:
                flush(ends=True)
            if live[name]:
                while stack[-1][0] != name:
                    pop()
                pop()
    flush()
    return out


def main_text(page: str, window: int = WINDOW, surge: int = SURGE) -> str:
    """Text between the surge and dive points of a page's line-block distribution."""
    tokens, lost = list(_tokens(page)), set()
    text = _between(lines_of(page, tokens, lost=lost), window, surge)
    if not lost or LITTLE * len(text) >= sum(len(a) for kind, a, _ in tokens if kind == "text"):
        return text
    holders = _holders(tokens)
    doubtful = frozenset(i for i in lost if i in holders and not _hidden(tokens[i][2]))
    if text:  # beside a text, what carries a strong name (comments, adverts) stays out
        doubtful = frozenset(i for i in doubtful if holders[i] >= LITTLE * len(text) and not _strong(tokens[i][2]))
    return _between(lines_of(page, tokens, doubtful), window, surge) if doubtful else text


def _strong(attrs: str) -> bool:
    values = _values(attrs)
    return any({x.lower() for x in _SPLIT.split(token)} & _STRONG
               for token in f"{values.get('class', '')} {values.get('id', '')}".split() if not _ABOUT.match(token))


def _between(lines: list, window: int, surge: int) -> str:
    marked = any(x[2] and x[0] for x in lines)
    lengths = [(len(line) if inside else 0) if marked else own for line, own, inside, *_ in lines]
    least = 1 if marked else surge
    sums, total = [], 0
    for i in range(len(lengths) + window - 1):  # sums[i]: the window that ends with line i
        total += lengths[i] if i < len(lengths) else 0
        total -= lengths[i - window] if i >= window else 0
        sums.append(total)
    sums = sums[window - 1:]                    # sums[i]: the window that begins with line i
    kept, stretches, begin = [], [], None
    for i, s in enumerate([*sums, 0]):
        if begin is None and s > 0:
            begin = i
        elif begin is not None and s == 0:
            stretches.append((max(sums[begin:i]), begin, i))
            begin = None
    found = [x for x in stretches if x[0] >= least] or sorted(stretches, key=lambda x: -x[0])[:1]
    if len(found) < len(stretches):
        found = _bridged(lines, lengths, stretches, found, window)
    for _, a, b in found:
        kept += [x[0] for x in lines[a:b] if x[0] and (x[2] or not marked)]
    return "\n".join(kept)


def _bridged(lines: list, lengths: list, stretches: list, found: list, window: int) -> list:
    """Stretches that surge, those that join them without a gap, and those in a container of theirs."""
    runs: list[list] = []
    for x in stretches:
        first = next(i for i in range(x[1], x[2]) if lengths[i])
        gap = sum(bool(line or void) for line, _, _, void, _ in lines[runs[-1][-1][2]: first]) if runs else window
        if gap < window:
            runs[-1].append(x)
        else:
            runs.append([x])
    surges = set(found)
    homes = {lines[i][4] for _, a, b in found for i in range(a, b) if lengths[i]}
    out = []
    for run in runs:
        whole = not surges.isdisjoint(run)
        out += [x for x in run if whole or any(lengths[i] and lines[i][4] in homes for i in range(x[1], x[2]))]
    return out


def _extract(window: int, surge: int):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "html"):
                texts = [main_text(x, window, surge) if x else "" for x in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                     pa.array([len(x) for x in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])
    return run


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
            window: int = WINDOW, surge: int = SURGE) -> DataFrame:
    """page_id, url, main text and its length in code points; narrow, one pass."""
    return (pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                         F.col(html).alias("html"))
            .mapInArrow(_extract(window, surge), SCHEMA))


def query(spark, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"))
