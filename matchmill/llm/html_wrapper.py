"""Main text of web pages by wrappers inferred per host.

A wrapper is a union-free regular expression over a host's pages, kept as a tree: each element
occurs once, optionally or repeatedly; a text is the same on all pages or a slot. Pages are aligned
with the wrapper one after the other. What one of both lacks becomes optional, what comes again
next to its like a repetition, what comes again elsewhere a repeated group of optionals, and texts
that differ become slots. A level names each element once, by its tag and classes, and no more than
LEVEL of them: beyond that, those of a tag are one repetition. A wrapper has at most ELEMENTS elements,
however many pages there are. Wrappers of parts of a host can be aligned like pages: every task folds
its own pages, and only the results are shuffled.

A page is then read by its host's wrapper: the region with the article, without what is a menu,
header, footer, sidebar, advert, form, script or reader comment by its element, class or role. Where
such a name does not tell for sure, the wrapper has to confirm it: by being mostly links or the same on
all pages. Only where no element names the article does the wrapper alone decide what is the host's.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchmill.llm.url_filter import host_and_path
from matchmill.session import cut_lineage

#: Hosts folded at a time by a task; at more, what it has is passed on and aligned later.
HOSTS_HELD = 2_000
#: Parts that a host's partial wrappers are aligned in before the parts are.
PARTS = 32
#: Elements nested deeper than this belong to the one at this depth.
DEEPEST = 150
#: Different elements that a level names, and elements of a wrapper.
LEVEL, ELEMENTS = 64, 1_500
#: Different pages on which a text has to be the same to count as the host's, where no element tells.
SAME_ON = 5

# Elements of HTML by what they are.
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg canvas object textarea title".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
PHRASES = INLINE | {"button", "label"}
CLOSES = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}
ASIDE = frozenset("head nav footer aside form button select option input label fieldset dialog menu".split()) | RAW
ASIDE_WORDS = frozenset(
    """ad ads adv advert adverts advertisement advertising adsense adslot banner sponsor sponsored sponsors promo promos promotion
    sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs footer masthead topbar toolbar pagination pager
    cookie cookies consent gdpr notice notices alert alerts popup modal overlay newsletter subscribe subscription signup
    comment comments reply replies respond disqus discussion share sharing social related recommended recommendations
    widget widgets login search skip copyright""".split()
)
#: Of these, words that the names of a text's own parts have too: the host's wrapper has to confirm them.
UNSURE_WORDS = frozenset(
    """search share sharing social login menu menus notice notices alert alerts related recommended recommendations discussion
    banner copyright skip reply replies respond subscribe subscription signup promotion sponsor sponsors overlay navigation widget widgets""".split()
)
#: Elements that names make asides, and words after which a name says no more.
CONTAINERS = frozenset("div section ul ol dl table center figure span".split())
TAILS = frozenset("box wrapper wrap container inner outer block area section list item items bar form links buttons posts left right top bottom".split())
#: Words that name something in this many words are a title's rather than a part's: ``history-of-the-ad``.
TITLE_WORDS = 4
#: Within these, a button or a label is a word of the sentence.
SENTENCES = HEADINGS | frozenset("p li dt dd td th blockquote figcaption caption pre".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<raw>" + "|".join(sorted(RAW)) + r")\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attributes>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</[^>]*+>",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@dataclass
class Element:
    """An element of a page: its content in order, as texts, line breaks (None) and elements."""

    tag: str
    key: str
    aside: bool
    unsure: bool
    content: list = field(default_factory=list)

    @property
    def inline(self) -> bool:
        return self.tag in INLINE or self.tag in PHRASES and not self.aside


def _element(tag: str, attributes: str, above: list[Element]) -> Element:
    words: list[str] = []
    aside, unsure = tag in ASIDE, False
    inside = any(e.tag in ("article", "main") for e in above)
    if tag in PHRASES - INLINE and any(e.tag in SENTENCES for e in above):
        aside = False
    if tag == "header":
        aside = not inside
    if tag == "article" and any(e.tag == "article" for e in above):
        aside = True  # an article within an article is a reader's comment or another text's teaser
    if attributes and not attributes.isspace():
        for name, value in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'")
            if name in ("class", "id"):
                for part in value.split():
                    names = [w.lower() for w in _NAME.findall(part)]
                    if name == "class":  # an id is one element's own
                        words += names
                    title = len(names) >= TITLE_WORDS
                    if tag in CONTAINERS and names and names[0] not in ("has", "with", "no", "without"):
                        while len(names) > 1 and names[-1] in TAILS:
                            names = names[:-1]
                        if names[-1] in ASIDE_WORDS:
                            sure = not (ASIDE_WORDS - UNSURE_WORDS).isdisjoint(names) if names[-1] in UNSURE_WORDS else not title
                            aside, unsure = aside or sure, unsure or not sure
                        if names[-1] == "header" and not inside:
                            site = len(names) == 1 or names[0] in ("site", "page", "global", "main", "top")
                            aside, unsure = aside or site, unsure or not site
            elif name == "role":
                aside |= value.lower() in ASIDE_ROLES
            else:
                gone = name == "hidden" or name == "aria-hidden" and value.lower() == "true"
                aside |= gone or name == "style" and "display:none" in value.replace(" ", "").lower()
    return Element(tag, ".".join([tag, *words]), aside, unsure and not aside)


def _weigh_forms(root: Element) -> None:
    """A form round the page or its article is no form to leave out: one with an article, or, outside of any, half of the text."""
    forms: list[tuple[Element, int, bool]] = []

    def weigh(node: Element, inside: bool) -> tuple[int, bool]:
        chars, article = 0, node.tag in ("article", "main", "h1")
        inside = inside or node.tag in ("article", "main")
        for x in node.content:
            if isinstance(x, str):
                chars += len(x) - x.count(" ")
            elif x is not None:
                own, marked = weigh(x, inside)
                chars, article = chars + own * (x.tag not in ("select", "option", "button", "label")), article or marked
        if node.tag == "form":
            forms.append((node, 0 if inside else chars, article))
        return chars, article

    total, _ = weigh(root, False)
    for form, chars, article in forms:
        form.aside = form.aside and not article and 2 * chars <= total


def parse(html: str | None) -> Element:
    """The tree of a page, however broken: end tags without a start are passed over, open elements closed where their parent ends."""
    root = Element("", "", False, False)
    stack = [root]
    passed: list[Element] = []  # open elements below DEEPEST, whose content goes to the last of the stack
    hidden = at = 0  # asides among them
    for token in _TOKEN.finditer(html or ""):
        if token.start() > at and not hidden:
            stack[-1].content.append(html[at : token.start()])
        at = token.end()
        tag = token["name"]
        if tag is None:
            continue
        tag = tag.lower()
        if token["end"]:
            depth = next((i for i in range(len(passed) - 1, -1, -1) if passed[i].tag == tag), None)
            if depth is not None:
                hidden -= sum(e.aside for e in passed[depth:])
                del passed[depth:]
                if tag not in INLINE:
                    stack[-1].content.append(None)
                continue
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    passed, hidden = [], 0
                    break
            continue
        if tag not in PHRASES and passed:
            if passed[-1].tag == "p" or passed[-1].tag in CLOSES.get(tag, ()):
                hidden -= passed.pop().aside
        elif tag not in PHRASES:
            closes, scope = CLOSES.get(tag, ()), SCOPES.get(tag, ())
            for depth in range(len(stack) - 1, 0, -1):
                open_tag = stack[depth].tag
                if open_tag in closes or open_tag == "p":
                    del stack[depth:]
                    break
                if open_tag in scope or not closes and open_tag not in INLINE:
                    break
        if tag in ("html", "body") and any(e.tag == tag for e in stack):
            continue
        if tag in ("br", "wbr"):
            stack[-1].content.append(" " if tag == "br" else "")
        elif tag in VOID:
            if tag not in INLINE:
                stack[-1].content.append(None)
        elif len(stack) < DEEPEST:
            element = _element(tag, token["attributes"], stack)
            stack[-1].content.append(element)
            stack.append(element)
        else:
            passed.append(_element(tag, token["attributes"], stack))
            hidden += passed[-1].aside
            if tag not in INLINE:
                stack[-1].content.append(None)
    if html and at < len(html) and not hidden:
        rest = html[at:]
        stack[-1].content.append(rest if not re.match(r"<[a-zA-Z/]", rest) else "")
    if re.search(r"<form\b", html or "", re.IGNORECASE):
        _weigh_forms(root)
    return root


# --- wrappers -----------------------------------------------------------------------------------


def _text_hash(text: str) -> str:
    import hashlib

    return hashlib.blake2b(text.encode(), digest_size=8).hexdigest()


def wrapper_of(element: Element, page: int = 0) -> dict:
    """The wrapper of one element of the page with the hash ``page``: pages (the SAME_ON least hashes), chars, chars in links, text (a hash, or null: a slot), group, children.

    A child is [least, most, wrapper]; least is 0 or 1, most 1 or 2 (which means any number).
    """
    return _within(_wrapper_of(element, page))


def _wrapper_of(element: Element, page: int) -> dict:
    texts: list[str] = []
    links = 0
    children: dict[str, list] = {}
    last, group = None, False

    def visit(node: Element, in_link: bool) -> None:
        nonlocal links, last, group
        for x in node.content:
            if isinstance(x, str):
                text = " ".join(x.split())
                if text:
                    texts.append(text)
                    links += len(text) * in_link
            elif x is not None and x.inline and not x.aside:
                visit(x, in_link or x.tag == "a")
            elif x is not None:
                own = _wrapper_of(x, page)
                if x.key not in children:
                    children[x.key] = [1, 1, own]
                else:
                    group |= x.key != last
                    children[x.key] = [1, 2, _align(children[x.key][2], own)]
                last = x.key

    visit(element, False)
    text = " ".join(texts)
    chars = len(text) + sum(c[2]["chars"] for c in children.values())
    links += sum(c[2]["links"] for c in children.values())
    return {"pages": [page], "chars": chars, "links": links, "text": _text_hash(text), "group": group, "children": children, "aside": element.aside, "unsure": element.unsure}


def align(a: dict, b: dict) -> dict:
    """The wrapper of what either wrapper fits, within its bounds."""
    return _within(_align(a, b))


def _size(wrapper: dict) -> int:
    return 1 + sum(_size(c[2]) for c in wrapper["children"].values())


def _within(wrapper: dict) -> dict:
    """A wrapper of no more than LEVEL names on a level and ELEMENTS in all."""
    most = LEVEL
    wrapper = _folded_level(wrapper, most)
    while _size(wrapper) > ELEMENTS and most > 1:
        most //= 4
        wrapper = _folded_level(wrapper, most)
    return wrapper


def _folded_level(wrapper: dict, most: int) -> dict:
    """The same with the elements of a tag as one repetition (``tag.*``) where a level has more than ``most`` names.

    Asides and what counts stay apart; if there are too many tags as well, all are one.
    """
    children = wrapper["children"]
    group = wrapper["group"]
    for rule in (lambda key: key.split(".")[0] + ".*", lambda key: "*.*"):
        if len(children) <= most:
            break
        folded: dict[str, list] = {}
        for key, (_, _, own) in children.items():
            name = rule(key) if not own["aside"] else rule(key) + "aside"
            if own["aside"]:
                own = {**own, "children": {}}
            folded[name] = [0, 2, _align(folded[name][2], own) if name in folded else own]
        children, group = folded, True
    return {**wrapper, "group": group, "children": {k: [a, b, _folded_level(own, most)] for k, (a, b, own) in children.items()}}


def _align(a: dict, b: dict) -> dict:
    children: dict[str, list] = {}
    left, right = list(a["children"]), list(b["children"])
    group = a["group"] or b["group"]
    common_left = [k for k in left if k in b["children"]]
    common_right = [k for k in right if k in a["children"]]
    if common_left != common_right:
        group = True  # the order differs: any of them, again and again
    at = 0
    for key in left:
        if key in b["children"]:
            while at < len(right) and right[at] != key and not group:
                if right[at] not in a["children"]:
                    children[right[at]] = [0, *b["children"][right[at]][1:]]
                at += 1
            at += not group
            (least_a, most_a, own_a), (least_b, most_b, own_b) = a["children"][key], b["children"][key]
            children[key] = [min(least_a, least_b), max(most_a, most_b), _align(own_a, own_b)]
        else:
            children[key] = [0, *a["children"][key][1:]]
    for key in right:
        if key not in children:
            children[key] = [0, *b["children"][key][1:]]
    return {
        "pages": a["pages"] if a["pages"] == b["pages"] else sorted({*a["pages"], *b["pages"]})[:SAME_ON],
        "chars": a["chars"] + b["chars"],
        "links": a["links"] + b["links"],
        "text": a["text"] if a["text"] == b["text"] else None,
        "group": group,
        "children": children,
        "aside": a["aside"] and b["aside"],
        "unsure": a["unsure"] and b["unsure"],
    }


def expression(wrapper: dict, key: str = "") -> str:
    """A wrapper as a union-free regular expression; # is a slot, = a text that is always the same."""
    inner = []
    if wrapper["text"] != _text_hash(""):
        inner.append("#" if wrapper["text"] is None else "=")
    for k, (least, most, own) in wrapper["children"].items():
        times = {(1, 1): "", (0, 1): "?", (1, 2): "+", (0, 2): "*"}[0 if wrapper["group"] else least, 1 if wrapper["group"] else most]
        whole = expression(own, k)
        inner.append(f"({whole}){times}" if times else whole)
    body = "".join(inner)
    if wrapper["group"]:
        body = f"({body})+"
    return f"<{key}>{body}</>" if key else body


def _page_hash(html: str | None) -> int:
    import hashlib

    return int.from_bytes(hashlib.blake2b((html or "").encode("utf-8", "surrogatepass"), digest_size=6).digest())


def _always_same(wrapper: dict) -> bool:
    return wrapper["text"] is not None and all(_always_same(c[2]) for c in wrapper["children"].values())


def _of_the_host(wrapper: dict, parent: dict) -> bool:
    """Whether an element is the same on pages that differ beside it; copies of a page count once."""
    return len(wrapper["pages"]) >= SAME_ON and wrapper["chars"] > 0 and _always_same(wrapper) and not _always_same(parent)


def rules_of(wrapper: dict) -> dict:
    """What to read by: the paths of keys to the regions, and the paths below them to leave out."""
    marked: list[tuple[bool, int, list[str]]] = []

    def find(node: dict, path: list[str]) -> None:
        for key, (_, _, own) in node["children"].items():
            if own["aside"]:
                continue
            tag = key.split(".")[0]
            if tag == "*":
                tag = ""
            if tag in ("article", "main"):
                marked.append((tag == "article", own["chars"], [*path, key]))
                if tag == "article":
                    continue
            find(own, [*path, key])

    find(wrapper, [])
    if marked:
        drop: list[list[str]] = []

        def confirm(w: dict, path: list[str]) -> None:
            for key, (_, _, own) in w["children"].items():
                # What a marked article says on all pages, and its lists of links, are its text all the same,
                # unless a name makes them something else.
                linked = own["chars"] > 0 and own["links"] >= 0.7 * own["chars"]
                if own["unsure"] and (linked or _of_the_host(own, w)) and not key.endswith("*"):
                    drop.append([*path, key])
                elif not own["aside"]:
                    confirm(own, [*path, key])

        articles = any(m[0] for m in marked)
        regions = [path for is_article, _, path in marked if is_article or not articles]
        for path in regions:
            region = wrapper
            for key in path:
                region = region["children"][key][2]
            confirm(region, path)
        return {"regions": regions, "drop": drop}
    drop, node, path = [], wrapper, []

    def weight(w: dict) -> int:
        own = w["chars"] - w["links"]
        return own - sum(c[2]["chars"] - c[2]["links"] for c in w["children"].values() if c[2]["aside"])

    def boilerplate(w: dict, parent: dict) -> bool:
        return w["aside"] or w["chars"] > 0 and w["links"] >= 0.7 * w["chars"] or _of_the_host(w, parent)

    while True:
        heavy = [(weight(own), key, own) for key, (_, most, own) in node["children"].items() if not boilerplate(own, node)]
        best = max(heavy, key=lambda x: x[0], default=None)
        if best is None or best[0] < 0.6 * max(1, weight(node)) or not best[2]["children"]:
            break
        path.append(best[1])
        node = best[2]

    def leave_out(w: dict, below: list[str]) -> None:
        for key, (_, _, own) in w["children"].items():
            if not own["aside"] and boilerplate(own, w) and not key.endswith("*"):
                drop.append([*below, key])
            elif not own["aside"]:
                leave_out(own, [*below, key])

    leave_out(node, path)
    return {"regions": [path], "drop": drop}


def _blocks(element: Element, drop: frozenset, path: tuple[str, ...], out: list[str], parts: list[str]) -> None:
    def flush() -> None:
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            out.append(text)

    for x in element.content:
        if x is None:
            flush()
        elif isinstance(x, str):
            parts.append(entities.unescape(x) if "&" in x else x)
        elif x.aside:
            if not x.inline:
                flush()
        elif x.inline:
            _blocks(x, drop, path, out, parts)
        else:
            flush()
            below = (*path, x.key)
            if below not in drop:
                _blocks(x, drop, below, out, parts)
                flush()


def _below(paths: list[list[str]], element: Element) -> list[list[str]]:
    """What is left of the paths that lead through an element, by its own name or else by one that several were folded to."""
    for name in (element.key, f"{element.tag}.*", "*.*"):
        if found := [p[1:] for p in paths if p[0] == name]:
            return found
    return []


def _regions(element: Element, paths: list[list[str]], at: tuple[str, ...] = ()) -> Iterator[tuple[Element, tuple[str, ...]]]:
    """The regions in page order, none within another, and their paths."""
    if [] in paths:
        yield element, at
        return
    for x in element.content:
        if isinstance(x, Element):
            if x.inline and not x.aside:
                yield from _regions(x, paths, at)
            elif not x.aside and (below := _below(paths, x)):
                yield from _regions(x, below, (*at, x.key))


def _read(page: Element, rules: dict) -> list[str] | None:
    drop = frozenset(tuple(p) for p in rules["drop"])
    out: list[str] = []
    found = False
    for region, path in _regions(page, rules["regions"]):
        found = True
        parts: list[str] = []
        _blocks(region, drop, path, out, parts)
        text = " ".join("".join(parts).split())
        if text:
            out.append(text)
    return out if found else None


@lru_cache(maxsize=4096)
def _rules(text: str) -> dict:
    return json.loads(text)


def main_text(html: str | None, rules: str | None) -> str:
    """The main text of a page by its host's rules; by its own wrapper where they name a region it lacks or leave nothing."""
    page = parse(html)
    blocks = _read(page, _rules(rules)) if rules else None
    if not blocks:
        blocks = _read(page, rules_of(wrapper_of(page)))
    return "\n\n".join(blocks or [])


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Wrappers of the pages of one task, by host."""
    held: dict[str, dict] = {}

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array([json.dumps(w) for w in held.values()], pa.string())], names=["host", "wrapper"])

    for batch in batches:
        for host, html in zip(batch.column("host"), batch.column("html"), strict=True):
            text = html.as_py()
            own, key = wrapper_of(parse(text), _page_hash(text)), host.as_py()
            held[key] = align(held[key], own) if key in held else own
            if len(held) > HOSTS_HELD:
                yield out()
                held.clear()
    if held:
        yield out()


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by host: its wrappers aligned, one after the other."""
    host, wrapper = None, None

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([host], pa.string()), pa.array([json.dumps(wrapper)], pa.string())], names=["host", "wrapper"])

    for batch in batches:
        for key, text in zip(batch.column("host").to_pylist(), batch.column("wrapper").to_pylist(), strict=True):
            own = json.loads(text)
            if key == host:
                wrapper = align(wrapper, own)
            else:
                if wrapper is not None:
                    yield out()
                host, wrapper = key, own
    if wrapper is not None:
        yield out()


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """host and wrapper (JSON) of every host, from all of its pages; null urls have the host ''."""
    host, _ = host_and_path(F.col("url"))
    schema = "host string, wrapper string"
    partial = pages.select(host.alias("host"), "html").mapInArrow(_folded, schema)
    part = F.pmod(F.xxhash64("wrapper"), F.lit(PARTS)).alias("part")
    parts = partial.select("host", "wrapper", part).repartition("host", "part").sortWithinPartitions("host", "wrapper")
    aligned = parts.select("host", "wrapper").mapInArrow(_merged, schema)
    return aligned.repartition("host").sortWithinPartitions("host", "wrapper").mapInArrow(_merged, schema)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text of every page: blocks of the article in page order, joined by an empty line.

    Null or empty html and pages without an article have an empty text. Character references are
    decoded, white space within a block is one space. Repeated rows are repeated, and other columns
    of ``pages`` are not read.
    """

    @F.arrow_udf(T.StringType())
    def rules(wrappers: pa.Array) -> pa.Array:
        return pa.array([json.dumps(rules_of(json.loads(w.as_py()))) for w in wrappers], pa.string())

    @F.arrow_udf(T.StringType())
    def text(htmls: pa.Array, rules_texts: pa.Array) -> pa.Array:
        return pa.array([main_text(h.as_py(), r.as_py()) for h, r in zip(htmls, rules_texts, strict=True)], pa.string())

    hosts = cut_lineage(infer_wrappers(pages).select(F.col("host").alias("__host"), rules("wrapper").alias("__rules")), "wrappers")
    host, _ = host_and_path(F.col("url"))
    joined = pages.select("page_id", "url", "html", host.alias("__page_host")).join(hosts, F.col("__page_host") == F.col("__host"), "left")
    return joined.select("page_id", "url", text("html", "__rules").alias("text"))
