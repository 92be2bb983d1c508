"""Main text of web pages by deducing the template of same-host pages from equivalence classes.

A page is a stream of tokens: tags of its layout, and blocks (a block's whole word sequence is one token), each
told apart by the path of elements it stands in. Over the pages of a host, tokens with the same occurrence vector
(how often they occur in each page) form an equivalence class. A class is valid if its tokens come in the same
order in every page; valid classes that lie in one gap of another are nested there, and together they are the
template. What lies between template tags is a slot. The slot that holds most text over the pages names the
container of the main text: the innermost template element around it, widened to the article or main element it
stands in. A block is template text if its token occurs once in each of many pages and always stands right beside
a template tag, so a short sentence that many articles use somewhere stays.

Elements and names decide two things only: what never is main text (menus, headers, footers, forms, notices,
comments), and, where a page marks its article, that slots outside the marks do not compete. The name of an
element that holds an article or main element says nothing about it.

Pages of a host are dealt to lanes of about LANE_PAGES pages, so a host with a third of all pages is
many groups; pages with the same open text count once when vectors are compared. Pages that lack the container,
and hosts with fewer pages than a template can be deduced from, are read by the elements alone.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from candlewright.llm.common import settle

LANE_PAGES = 64
#: Parts that the pages of a host are joined to its page count in.
HOST_PARTS = 16
#: Different pages that a class of tags, and a block of words that is not content, must be seen in.
TAG_PAGES = 2
WORD_PAGES = 8

# Elements by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe svg math canvas object select datalist xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br".split()
)
OUTSIDE = frozenset("nav header footer aside form button dialog menu fieldset legend label head address".split())
CONTENT = frozenset("article main".split())
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog form menu menubar toolbar".split())

# Words in class and id names of what surrounds an article.
OUTSIDE_NAMES = frozenset(
    """ad ads adbox adsense advert adverts advertisement advertising alert announcement banner breadcrumb breadcrumbs comment commentlist
    comments consent cookie cookies dialog disclaimer discussion disqus footer form gdpr header infobar login masthead menu modal nav navbar
    navigation navigator newsletter notice notices overlay pager pagination popup promo promotion recommended related replies reply respond
    responses search share sharebar sharing sidebar signup sitemap skiplink snackbar social sponsor sponsored subscribe subscription toast
    toolbar topbar widget widgets""".split()
)
CONTENT_NAMES = frozenset("article articlebody entry post story".split())
# First words of class names that tell a state of what is inside, and elements of running text.
STATE_NAMES = frozenset("has no with without is".split())
TEXT_LEVEL = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th tr ul ol dl pre blockquote figcaption".split())

_tag = re.compile(r"<(/?)([A-Za-z][^\s/>]*)((?>[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*+)>")
_attribute = re.compile(r"([A-Za-z_:][\w:.-]*+)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))")
_name = re.compile(r"[a-z]+|[0-9]+")
_hidden = re.compile(r"(?:^|\s)hidden(?:\s|=|$)")
_space = re.compile(r"\s+")
_number = re.compile(r"\d+")


@dataclass(eq=False)
class Element:
    """`barred` by its kind, `named` like a surrounding; `holds` an article or main element, `within` one itself."""

    name: str
    label: str
    path: str
    barred: bool
    named: bool
    content: bool
    landmark: bool
    within: bool
    block: int
    holds: bool = False

    def outside(self) -> bool:
        frees = self.holds and not self.within
        return self.barred and not (frees and self.name == "form") or self.named and not frees


@dataclass
class Page:
    """Tokens in order (role, block or -1), the text of blocks and the elements around them."""

    tokens: list[tuple[tuple, int]]
    blocks: dict[int, list[str]]
    around: dict[int, tuple[Element, ...]]
    links: dict[int, int]
    texts: dict[int, str]
    open: dict[int, bool]
    """Blocks that no surrounding holds: whether an article holds them."""


def _element(name: str, attributes: str, block: int, stack: list[Element]) -> Element:
    found = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _attribute.finditer(attributes)} if "=" in attributes else {}
    label = " ".join(filter(None, (found.get("class", ""), found.get("id", "")))).lower()
    role = found.get("role", "").lower()
    # A name counts by its words and by all of them together: side-bar is a sidebar.
    tokens = [words for words in map(_name.findall, label.split()) if words and words[0] not in STATE_NAMES] if label else []
    names = {part for words in tokens for part in (*words, "".join(words))}
    landmark = name in CONTENT or role in ("main", "article")
    within = any(e.content for e in stack)
    says_content = name in ("div", "section") and bool(names & CONTENT_NAMES)
    # An element that is called a post outright is one, whatever states its other names tell.
    outright = says_content and not within and any("".join(words) in CONTENT_NAMES for words in tokens)
    barred = name in OUTSIDE or not landmark and (role in OUTSIDE_ROLES or name not in ("html", "body") and bool(_hidden.search(attributes)))
    named = not landmark and not outright and name not in ("html", "body") and bool(names & OUTSIDE_NAMES)
    content = (landmark or "articlebody" in found.get("itemprop", "").lower() or says_content) and not barred and not named
    parent = stack[-1].path if stack else ""
    shown = f"{name}.{_number.sub('0', label)}" if label else name
    path = parent if name in INLINE else f"{parent}>{shown}" if parent else shown
    return Element(name, shown, path, barred, named, content, landmark, within, block)


def read(source: str) -> Page:
    """Tokens and blocks of a page; unclosed and misplaced tags are read as browsers do in the main."""
    page = Page([], defaultdict(list), {}, defaultdict(int), {}, {})
    stack: list[Element] = []
    next_block = at = 0
    n = len(source)

    def current() -> int:
        return stack[-1].block if stack else 0

    def path() -> str:
        return stack[-1].path if stack else ""

    def fresh() -> int:
        nonlocal next_block
        next_block += 1
        return next_block

    def close(names: frozenset | set, stop: frozenset) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i].name in names:
                del stack[i:]
                if stack:
                    stack[-1].block = fresh()
                return
            if stack[i].name in stop:
                return

    def add(text: str) -> None:
        if "&" in text:
            text = html.unescape(text)
        block = current()
        page.blocks[block].append(text)
        if not text.isspace():
            if block not in page.around:
                page.around[block] = tuple(stack)
                page.tokens.append((("b", "", path()), block))
            if any(e.name == "a" for e in stack):
                page.links[block] += len(text)

    while at < n:
        low = source.find("<", at)
        if low < 0:
            add(source[at:])
            break
        if low > at:
            add(source[at:low])
        if source.startswith("<!--", low):
            end = source.find("-->", low + 4)
            at = n if end < 0 else end + 3
            continue
        if source.startswith(("<!", "<?"), low):
            end = source.find(">", low)
            at = n if end < 0 else end + 1
            continue
        m = _tag.match(source, low)
        if not m:
            add("<")
            at = low + 1
            continue
        at = m.end()
        closing, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        name = name.lower()
        if closing:
            if name not in INLINE:
                page.tokens.append((("/", name, path()), -1))
            if name in INLINE:
                close({name}, frozenset(e.name for e in stack if e.name not in INLINE))
            elif any(e.name == name for e in stack):
                close({name}, frozenset())
            continue
        if name in RAW:
            end = re.compile(f"</{re.escape(name)}\\s*>", re.I).search(source, at)
            page.tokens.append((("<", name, path()), -1))
            if not attributes.rstrip().endswith("/") or name in ("script", "style", "title"):
                at = end.end() if end else n
            continue
        if name == "br":
            add(" ")
            continue
        if name not in INLINE:
            if name not in VOID:
                close({"p"}, frozenset(("article", "body", "div", "main", "section", "td", "li", "blockquote")))
            if name == "li":
                close({"li"}, frozenset(("ul", "ol")))
            elif name in ("td", "th"):
                close({"td", "th"}, frozenset(("tr", "table")))
            elif name == "tr":
                close({"tr"}, frozenset(("table",)))
            elif name == "body":
                close({"head"}, frozenset())
            if stack:
                stack[-1].block = fresh() if name in VOID else stack[-1].block
        if name in VOID:
            continue
        element = _element(name, attributes, current() if name in INLINE else fresh(), stack)
        if element.landmark:
            for outer in stack:
                outer.holds = True
        if name not in INLINE:
            page.tokens.append((("<", element.label, path()), -1))
        if not attributes.rstrip().endswith("/"):
            stack.append(element)
            if name not in INLINE and len(stack) > 1:
                stack[-2].block = fresh()
    for block, elements in page.around.items():
        page.texts[block] = _space.sub(" ", "".join(page.blocks[block])).strip()
        if not any(e.outside() for e in elements):
            page.open[block] = any(e.content for e in elements)
    page.tokens = [(role if block < 0 else ("b", page.texts[block], role[2]), block) for role, block in page.tokens]
    return page


def classes(pages: list[Page], least: int = TAG_PAGES) -> list[list[tuple]]:
    """Valid equivalence classes: roles with one occurrence vector, in one order in every page.

    Roles need half the pages that are not empty; blocks WORD_PAGES of them, too.
    """
    filled = sum(bool(page.tokens) for page in pages)
    seen_in = Counter(role for page in pages for role in {role for role, block in page.tokens if block >= 0})
    words = {role for role, n in seen_in.items() if n >= WORD_PAGES}
    streams = [[role for role, block in page.tokens if block < 0 or role in words] for page in pages]
    vectors: dict[tuple, dict[int, int]] = defaultdict(dict)
    for p, stream in enumerate(streams):
        for role, times in Counter(stream).items():
            vectors[role][p] = times
    grouped: dict[tuple, list[tuple]] = defaultdict(list)
    for role, vector in vectors.items():
        if len(vector) >= least and 2 * len(vector) >= filled:
            grouped[tuple(sorted(vector.items()))].append(role)
    valid = []
    for vector, roles in grouped.items():
        members = set(roles)
        orders = []
        for p, times in vector:
            seen = [role for role in streams[p] if role in members]
            rounds = [seen[i * len(members) : (i + 1) * len(members)] for i in range(times)]
            orders += rounds
        first = orders[0]
        if all(order == first for order in orders) and len(set(first)) == len(members):
            valid.append(first)
            continue
        # Tokens that keep their place relative to all others still make a class when each occurs once.
        if all(times == 1 for _, times in vector):
            places = [{role: i for i, role in enumerate(order)} for order in orders]
            steady = []
            for role in first:
                if all(all(place[kept] < place[role] for kept in steady[-1:]) for place in places):
                    steady.append(role)
            if len(steady) > 1:
                valid.append(steady)
    return valid


def nest(valid: list[list[tuple]], pages: list[Page]) -> list[tuple[list[tuple], int | None, int]]:
    """(class, index of the class around it or None, gap there): classes that lie in one gap of another in every page.

    Classes that cross a gap of an outer class are left out.
    """
    ordered = sorted(valid, key=lambda c: -len(c))
    whole = [c for c in ordered if c]
    known = {role for c in whole for role in c}
    place: list[dict[tuple, list[int]]] = []
    for page in pages:
        at: dict[tuple, list[int]] = defaultdict(list)
        for i, (role, _) in enumerate(page.tokens):
            if role in known:
                at[role].append(i)
        place.append(at)
    once = [c for c in whole if all(len(at.get(c[0], [])) <= 1 for at in place)]
    kept: list[tuple[list[tuple], int | None, int]] = []
    for c in sorted(whole, key=lambda c: (c not in once, -len(c))):
        around, gap, crosses = None, 0, False
        for k, (outer, _, _) in enumerate(kept):
            if outer not in once:
                continue
            gaps = set()
            for at in place:
                marks = [at[r][0] for r in outer if r in at]
                positions = [i for r in c for i in at.get(r, [])]
                if marks and positions:
                    gaps |= {sum(m < i for m in marks) for i in (min(positions), max(positions))} if len(marks) == len(outer) else set()
            if len(gaps) == 1:
                around, gap = k, gaps.pop()
            elif len(gaps) > 1 and c in once:
                inside = {i for i in gaps if 0 < i < len(outer)}
                crosses = crosses or bool(inside) and gaps != {0, len(outer)}
        if not crosses:
            kept.append((c, around, gap))
    return kept


@dataclass
class Template:
    """Tags and blocks that pages have once, and the path of the element that holds the main slot."""

    tags: frozenset[tuple] = frozenset()
    spelled: frozenset[tuple] = frozenset()
    container: str | None = None


def _slots(page: Page, tags: frozenset[tuple] | set[tuple]) -> dict[int, tuple[tuple | None, tuple | None, bool]]:
    """For each block: the template tags before and after it, and whether one of them is right beside it.

    Beside means: nothing between but the tags of the block's own elements of running text.
    """
    out: dict[int, tuple[tuple | None, tuple | None, bool]] = {}
    before, near, waiting = None, True, []

    def own(role: tuple) -> bool:
        return role[1].split(".", 1)[0] in TEXT_LEVEL

    def settle_waiting(after: tuple | None) -> None:
        beside = True  # only the last open block can stand right before the tag
        for block, left, touches in reversed(waiting):
            out[block] = (left, after, touches or beside and after is not None)
            beside = beside and block not in page.open
        waiting.clear()

    for role, block in page.tokens:
        if block < 0 and role in tags:
            settle_waiting(role)
            before, near = role, True
        elif block < 0:
            near = near and own(role)
        else:
            waiting.append((block, before, near and before is not None))
            near = near and block not in page.open
    settle_waiting(None)
    return out


def deduce(pages: list[Page]) -> Template:
    """Template of the pages of one group; pages with the same open text count once."""
    told = list({tuple(page.texts[b] for b in page.open): page for page in pages}.values())
    if len(told) < TAG_PAGES:
        return Template()
    nested = nest(classes(told), told)
    roles = {role for c, _, _ in nested for role in c}
    most: Counter[tuple] = Counter()
    for page in told:
        for role, n in Counter(role for role, _ in page.tokens if role in roles).items():
            most[role] = max(most[role], n)
    once = {role for role, n in most.items() if n == 1}
    tags = frozenset(role for role in once if role[0] != "b")
    slots = [_slots(page, tags) for page in told]
    # A block of the template stands beside a template tag in every page that has it.
    loose = {role for page, places in zip(told, slots) for role, block in page.tokens if block >= 0 and not places[block][2]}
    spelled = frozenset(role for role in once if role[0] == "b") - loose
    held: dict[tuple, int] = defaultdict(int)
    paths: dict[tuple, list[str]] = {}
    for page, places in zip(told, slots):
        for role, block in page.tokens:
            if block in page.open and role not in spelled:
                slot = (page.open[block], *places[block][:2])
                held[slot] += len(page.texts[block])
                parts = role[2].split(">")
                known = paths.setdefault(slot, parts)
                paths[slot] = [a for i, (a, b) in enumerate(zip(known, parts)) if known[:i] == parts[:i] and a == b]
    if not held:
        return Template(tags, spelled)
    marked = sum(any(page.open.values()) for page in told)
    chosen = max(held, key=lambda s: (s[0] and 2 * marked >= len(told), held[s], str(s)))
    path = paths[chosen]
    while path and (("<", path[-1], ">".join(path[:-1])) not in tags or path[-1].split(".", 1)[0] in TEXT_LEVEL):
        path = path[:-1]
    contents = {e.path for page in told for elements in page.around.values() for e in elements if e.content}
    wide = next((i for i in range(1, len(path) + 1) if ">".join(path[:i]) in contents), len(path))
    return Template(tags, spelled, ">".join(path[:wide]))


def main_text(page: Page, template: Template) -> str:
    """Text of the slots of the container, block by block; of what is marked as an article where marks are there."""
    spelled = {block for role, block in page.tokens if role in template.spelled}
    path = {block: role[2] for role, block in page.tokens if block >= 0}
    inside = template.container
    slots = [b for b in page.open if inside is not None and (not inside or f"{path[b]}>".startswith(f"{inside}>"))] or list(page.open)
    marks = [b for b in slots if page.open[b]]
    texts = {b: page.texts[b] for b in marks or slots if b not in spelled}
    if not marks:  # no article is marked: leave out blocks that are mostly links
        texts = {b: t for b, t in texts.items() if 2 * page.links[b] <= len(t)}
    return " ".join(texts.values())


def extract(sources: list[str]) -> list[str]:
    """Main text of each page of one group of same-host pages."""
    different = {source: read(source) for source in sources}
    template = deduce(list(different.values()))
    told = {source: main_text(page, template) for source, page in different.items()}
    return [told[source] for source in sources]


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", lane_pages: int = LANE_PAGES) -> DataFrame:
    """page_id, url, text, n_chars of every row.

    Null html counts as empty and gives empty text. Pages without a host (null or relative url) form a
    group like a host. Repeated rows each get a row; an empty table gives an empty result; other columns
    are not read.
    """
    host = F.lower(F.coalesce(F.regexp_extract(url_col, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))
    counts = settle(pages.select(host.alias("host")).groupBy("host").agg(F.count(F.lit(1)).alias("pages")), "hosts")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(html_col, F.lit("")).alias("html"), host.alias("host"))
    # A host's rows meet its count in parts, so a host with a third of all pages is not one task's.
    part = F.pmod(F.xxhash64("url", "page_id", F.lit(1)), F.lit(HOST_PARTS))
    parted = counts.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(HOST_PARTS - 1).cast("long"))).alias("part"))
    lane = F.pmod(F.xxhash64("page_id", "url"), F.ceil(F.col("pages") / lane_pages))
    dealt = rows.withColumn("part", part).join(parted, ["host", "part"]).select("page_id", "url", "html", "host", lane.alias("lane"))

    def group(table: pa.Table) -> pa.Table:
        texts = extract(table.column("html").to_pylist())
        return pa.table({"page_id": table.column("page_id"), "url": table.column("url"), "text": pa.array(texts, pa.string()), "n_chars": pa.array(map(len, texts), pa.int64())})

    kind = rows.schema["page_id"].dataType.simpleString()
    return dealt.groupBy("host", "lane").applyInArrow(group, f"page_id {kind}, url string, text string, n_chars long")
