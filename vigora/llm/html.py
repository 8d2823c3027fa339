"""Main text of web pages by consensus host paths.

Each page is parsed once for a vote: from the body down, as long as one
container holds most of the text that is no boilerplate, then up to an
enclosing article or main element. The container's generalised path - tags and
classes, digits dropped - is the page's vote. Spark sums the votes by host, and
a second pass extracts the blocks inside the elements with the host's winning
path; a page without such an element uses its own choice.

Boilerplate is known by tags, roles and words in class names and ids. A name
made of such words alone ("related-posts") marks an element everywhere, one that
only has such a word ("related-work") not inside an article. What a name marks is
taken back where the page would lose its text by it: if the element has a name of
the second kind or holds an article (readers' comments aside), and over twice the text of the rest; and if
the rest has no text at all.

Defined results: null or empty html has an empty text; very long pages are read
whole, in time linear in their length; pages without a host vote together under
''; a tie goes to the path with the smaller text; repeated rows and ids each vote
and are each extracted; an empty table gives no rows; other columns, whatever
their names, are left out; broken markup is read as browsers do where that
matters here (open paragraphs end at the next block, text in an unfinished tag or
comment is lost).
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigora.llm.common import checkpointed, map_arrow, table

TOKEN = re.compile(r"""<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
SPACE = re.compile(r"\s+")
RAW = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in ("script", "style", "textarea", "title", "xmp", "noembed", "noframes", "iframe")}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody thead tfoot tr td th caption ul".split())
CONTAINER = set("body article main section div td center blockquote".split())
SKIP_TAGS = set("head nav footer aside form script style noscript iframe svg math button select textarea input template object canvas audio video map dialog menu search title xmp noembed noframes".split())
SKIP_WORDS = set("ad ads adsbygoogle advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar sidenav rail menu nav navbar navigation breadcrumb breadcrumbs footer footnav colophon masthead topbar comment comments commentlist disqus respond replies cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup share sharing social related recommended recommendations widget widgets toolbar pagination pager login search copyright disclaimer skip hidden".split())
SKIP_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
#: What an opening tag ends: open elements of these kinds, up to one of the stops.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select", "datalist"}), "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"})}
#: Those of readers' comments, each of which may be an article by tag.
READERS = set("comment comments commentlist disqus respond replies".split())
#: Words that say nothing of an element beside one of SKIP_WORDS.
PLAIN_WORDS = set("area bar block body box button buttons card container content entry feed form global header icons inline inner item items label left link links list lists main media module outer panel post posts primary right row section site static sticky text title top wide widget wrap wrapper article articles page stories story tags text thread zone unit units slot main bottom site".split())
CLASS_WORD = re.compile(r"[a-z]+")
#: Says what stands beside an element, not what it is: "with-sidebar".
BESIDE = re.compile(r"(?<![a-z])(?:with|has|no|without)[-_][a-z]+")
#: A container takes the vote over its parent if it has so much of the parent's text.
SHARE = 0.6
#: Hosts whose winning paths may be broadcast.
MAX_BROADCAST = 50_000


class Element:
    """skip: boilerplate by tag or role; marks: the elements from here up that are boilerplate by name."""

    __slots__ = ("tag", "parent", "skip", "story", "path", "weight", "link", "marks", "mark")

    def __init__(self, tag, parent, skip, story, path, link, mark=None):
        self.tag, self.parent, self.skip, self.story, self.path, self.weight, self.link, self.mark = tag, parent, skip, story, path, 0.0, link, mark
        above = parent.marks if parent is not None else ()
        self.marks = (*above, mark) if mark is not None else above


class Mark:
    """An element that its name marks as boilerplate: whether the name has other words too, the text in it, whether it holds an article."""

    __slots__ = ("weak", "readers", "text", "article")

    def __init__(self, weak, readers=False):
        self.weak, self.readers, self.text, self.article = weak, readers, 0, False


def _marked(names: str, own_id: str, in_story: bool) -> Mark | None:
    weak = False
    for name in [*names.split(), *([own_id] if own_id else [])]:
        words = CLASS_WORD.findall(BESIDE.sub("", name))
        if not SKIP_WORDS.isdisjoint(words):
            if all(w in SKIP_WORDS or w in PLAIN_WORDS for w in words):
                return Mark(False, not READERS.isdisjoint(words))
            weak = not in_story
        elif not in_story and "header" in words:
            return Mark(len(words) > 1)
    return Mark(True) if weak else None


def _open(tag: str, attributes: str, parent: Element) -> Element:
    skip, story, mark = parent.skip, parent.story or tag in ("article", "main"), None
    label = tag
    if attributes and not attributes.isspace() and tag in BLOCK:
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)}
        names = found.get("class", "").lower()
        if names:
            label += "." + ".".join(sorted(set(re.sub(r"\d+", "", names).split())))
        role = found.get("role", "").lower()
        story = story or role in ("main", "article") or found.get("itemprop") == "articleBody"
        if tag not in ("html", "body", "article", "main"):
            skip = skip or role in SKIP_ROLES
            mark = _marked(names, found.get("id", "").lower(), parent.story)
        skip = skip or "hidden" in found or "display:none" in found.get("style", "").replace(" ", "").lower() or found.get("aria-hidden") == "true"
    skip = skip or tag in SKIP_TAGS or tag == "header" and not parent.story
    return Element(tag, parent, skip, story, f"{parent.path}>{label}" if tag in CONTAINER or tag == "html" else parent.path, parent.link or tag == "a", mark)


def blocks(html: str) -> list[tuple[Element, str]]:
    """(innermost container, text) of each block of text that is no boilerplate, in page order; containers have their texts' weights."""
    root = Element("", None, False, False, "", False)
    node, out, text, linked, at, end = root, [], [], 0, 0, len(html)

    def flush():
        nonlocal linked
        if text:
            if made := SPACE.sub(" ", unescape("".join(text))).strip():
                holder = node
                while holder.tag not in CONTAINER and holder.parent is not None:
                    holder = holder.parent
                out.append((holder, made, max(0.0, len(made) - 1.5 * linked), node.marks))
                for mark in node.marks:
                    mark.text += len(made)
            text.clear()
        linked = 0

    def close_to(target):
        nonlocal node
        node = target.parent

    while at < end:
        m = TOKEN.search(html, at)
        stop = m.start() if m else end
        if stop > at and not node.skip:
            text.append(html[at:stop])
            if node.link:
                linked += stop - at
        if not m:
            break
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag = tag.lower()
        if m[5] and not html.endswith(">", 0, at):
            break
        if m[1] or m[4]:
            if tag in BLOCK:
                flush()
            target = node
            while target.parent is not None and target.tag != tag:
                if tag not in BLOCK and target.tag in BLOCK:
                    break
                target = target.parent
            if target.parent is not None and target.tag == tag and tag not in ("html", "body"):
                close_to(target)
            continue
        if tag in BLOCK:
            flush()
            target = node
            while target.parent is not None and target.tag not in CONTAINER and target.tag not in ("p", "li", "ul", "ol", "table"):
                target = target.parent
            if target.tag == "p" and tag not in ("html", "body"):
                close_to(target)
            if tag in ENDS:
                ends, stops = ENDS[tag]
                target, found = node, None
                while target.parent is not None and target.tag not in stops:
                    if target.tag in ends:
                        found = target
                    target = target.parent
                if found is not None:
                    close_to(found)
        elif tag == "br":
            if not node.skip:
                text.append(" ")
        if tag in VOID:
            continue
        attributes = m[3] or m[6] or ""
        if tag in ("html", "body") and any(True for _ in _named(node, tag)):
            continue
        if tag in RAW:
            close = RAW[tag].search(html, at)
            stop = close.start() if close else end
            at = html.find(">", stop) + 1 if close else end
            at = at or end
            continue
        if attributes.endswith("/") and tag in ("svg", "math"):
            continue
        node = _open(tag, attributes, node)
        if node.marks and tag in ("article", "main") and not node.skip and node.mark is None:
            for mark in node.marks:
                mark.article = not mark.readers
    flush()
    return _kept(out)


def _kept(found) -> list[tuple[Element, str]]:
    """The blocks outside of elements that are boilerplate by name, those that are taken back left aside; weights are added up."""
    rest = sum(len(text) for _, text, _, marks in found if not marks)
    back = {id(m) for _, _, _, marks in found for m in marks if (m.weak or m.article) and m.text > 2 * rest}
    kept = [x for x in found if all(id(m) in back for m in x[3])]
    if not kept and found:
        # Nothing else: the outermost elements that have text, with what is boilerplate inside of them left out, if that leaves any.
        back |= {id(x[3][0]) for x in found}
        kept = [x for x in found if all(id(m) in back for m in x[3])] or found
    for holder, _, weight, _ in kept:
        while holder is not None:
            holder.weight += weight
            holder = holder.parent
    return [(holder, text) for holder, text, _, _ in kept]


def _named(node, tag):
    while node is not None:
        if node.tag == tag:
            yield node
        node = node.parent


def choice(found: list[tuple[Element, str]]) -> Element | None:
    """The page's own main container."""
    if not found:
        return None
    children: dict[int, dict[int, Element]] = {}
    top = None
    for holder, _ in found:
        node = holder
        while node.parent is not None:
            above = node.parent
            while above.parent is not None and above.tag not in CONTAINER:
                above = above.parent
            children.setdefault(id(above), {})[id(node)] = node
            node = above
        top = node
    at = top
    while True:
        best = max(children.get(id(at), {}).values(), key=lambda x: x.weight, default=None)
        if best is None or best.weight < SHARE * at.weight or best.weight <= 0:
            break
        at = best
    node = at
    while node is not None:
        if node.tag in ("article", "main"):
            return node
        node = node.parent
    return at


def extract(html: str | None, path: str | None = None) -> str:
    """The main text: the blocks inside elements of the given path, else inside the page's own choice."""
    found = blocks(html or "")
    if path is not None:
        inside = [t for holder, t in found if any(n.path == path and (n.tag in CONTAINER) for n in _up(holder))]
        if inside:
            return "\n".join(inside)
    best = choice(found)
    return "\n".join(t for holder, t in found if best in _up(holder)) if best is not None else ""


def _up(node):
    while node is not None:
        yield node
        node = node.parent


def _host():
    return F.lower(F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def host_paths(pages: DataFrame) -> DataFrame:
    """host, path: the container path that most pages of the host chose."""

    def make():
        def f(c):
            votes = Counter()
            for host, html in zip(c["host"], c["html"]):
                if (best := choice(blocks(html or ""))) is not None:
                    votes[host, best.path] += 1
            return {"host": [h for h, _ in votes], "path": [p for _, p in votes], "votes": list(votes.values())}
        return f

    votes = map_arrow(pages.select(_host().alias("host"), "html"), make, "host string, path string, votes long", rows=256)
    summed = votes.groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    return summed.groupBy("host").agg(F.min(F.struct((-F.col("votes")).alias("n"), "path")).path.alias("path"))


def extract_all(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars, path (the host's); a row for each row."""
    winners = checkpointed(host_paths(pages))
    small = winners.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST
    joined = pages.select("page_id", "url", "html", _host().alias("host")).join(F.broadcast(winners) if small else winners, "host", "left")

    def make():
        def f(c):
            texts = [extract(h, p) for h, p in zip(c["html"], c["path"])]
            return {"page_id": c["page_id"], "url": c["url"], "text": texts, "n_chars": [len(t) for t in texts], "path": c["path"]}
        return f

    return map_arrow(joined.select("page_id", "url", "html", "path"), make, "page_id long, url string, text string, n_chars long, path string", rows=256)


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_all(table(spark, sf_dir, "pages"))
