"""Operator 7, HTML extraction: equivalence-class template deduction.

A page is a sequence of tokens: tags (named by their path of tags), texts
(their path and content) and names that hint at boilerplate. Over the pages of a
host each token has an occurrence vector, the number of times it occurs in each
page. Tokens with equal vectors form an equivalence class; a class is large
enough and on most pages of the host. A class is valid if on every page its
tokens come in one order, and its tuples lie whole between the same two
consecutive tokens of each valid class before it (on more pages, or larger), or
hold that class so, or lie beside it. Valid classes make up the host's template;
what lies between their tokens are slots. The container with the most slot text
is the host's main container, if its host has enough pages.

The main text of a page are its blocks in the main container; one inside
``article`` or ``main`` counts as all of these, and their text is main text on
any page. Pages without either keep all blocks. What stands in navigation,
headers, footers, asides, forms, adverts, notices, comment threads and the like
is left out, and, outside ``article`` and ``main``, texts of the template: those
of a class that has tags outside the main container. Texts that pages share as
content (copies and near copies of one article, a common passage) stay.

Vectors are never built: a page contributes a hash of (page, count) to each of
its tokens, and the exclusive-or of these with the number of pages tells equal
vectors apart. Order and nesting are checked page by page on stored token sequences. These aggregates are combined map-side, so a host with a third
of all pages is no larger group than another. Templates are broadcast to the pages while
their counted tokens are few (``BROADCAST_IDS``); beyond that both are shuffled by host, and
a hot host's pages are left to the skew join.

Defined cases: NULL or empty html gives an empty text; a page without a URL is
of the empty host; a page most of whose main text is template (copies and
near copies of one page) keeps it; broken markup is read as browsers do. Repeated rows are
extracted alike; extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_IDS, map_batches, stage

#: A class is valid from this many pages of a host, this share of them, and this many tokens.
MIN_PAGES = 5
MIN_SHARE = 0.5
MIN_TOKENS = 2

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|noscript|template|textarea|iframe|svg|math|object|title)\b"
    r"(?:\"[^\"]*\"|'[^']*'|[^'\">])*>(?P<body>.*?)(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][\w:-]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|<[!?][^>]*>|(?P<text>[^<]+|<)", re.S | re.I)
_HINT = re.compile(r"\b(class|id|role|style|aria-hidden)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s "
                    "samp small span strike strong sub sup time tt u var wbr".split())
_OUT = frozenset("nav header footer aside script style noscript template button select option input textarea iframe svg "
                 "math object head title menu dialog canvas audio video map".split())
_FORM = frozenset(("form", "fieldset"))
_OUT_ROLE = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())
_OUT_NAME = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adbox|adsense|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notices?|notification\w*|alert|"
    r"popup|modal|overlay|sidebar|side-bar|aside|menu|nav|navbar|navigation|breadcrumbs?|header|masthead|topbar|footer|bottombar|"
    r"comments?|commentlist|disqus|replies|respond|share|sharing|social|related|recommend\w*|newsletter|subscribe|subscription|"
    r"signup|login|widgets?|toolbar|pagination|pager|skip-link|copyright|legal|disclaimer)(?:$|[\s_-])", re.I)
_KEEP_NAME = frozenset(("html", "body", "article", "main"))
_THREAD = re.compile(r"(?:^|[\s_-])(?:comments?|commentlist|disqus|replies|respond)(?:$|[\s_-])", re.I)
_TITLED = frozenset("h1 h2 h3 h4 h5 h6 section hgroup".split())
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
           "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead"}}


class Block:
    """A text block. ``pieces``: its texts with what leaves them out (``None`` for always, else marks)."""

    __slots__ = ("path", "text", "core", "at", "pieces")

    def __init__(self, path, core, at, pieces):
        self.path, self.core, self.at, self.pieces = path, core, at, pieces  # at: tags before it
        self.text = self.shown(frozenset())

    def shown(self, honoured) -> str:
        """The text less pieces left out always or by an honoured mark."""
        kept = [t for t, marks in self.pieces if marks is not None and honoured.isdisjoint(marks)]
        return " ".join(unescape("".join(kept)).split()) if kept else ""


class Mark:
    """An element that its name, or being a form, says to leave out.

    ``confirm``: only if the host's template has it. ``thread``: a comment thread.
    """

    __slots__ = ("path", "value", "confirm", "thread", "at")

    def __init__(self, path, value, confirm, thread, at):
        self.path, self.value, self.confirm, self.thread, self.at = path, value, confirm, thread, at


def _named(name: str, key: str, value: str, core: bool, titled: bool) -> tuple[bool, bool]:
    """Whether a class or id hints at an element to leave out, and whether the template has to confirm it.

    Inside article or main an id is often a heading's slug, and so are names of
    headings and sections and of what stands in a heading.
    """
    if name in _KEEP_NAME or not _OUT_NAME.search(value):
        return False, False
    if not core:
        return True, False
    slug = key == "id" and (name in _INLINE or not all(_OUT_NAME.fullmatch(part) for part in re.split(r"[\s_-]+", value) if part))
    return True, titled or slug


def blocks(html: str) -> tuple[list[Block], list[str], list[Mark]]:
    """Text blocks of a page in order, the paths of its tags, and its marks."""
    stack: list[tuple[str, bool, bool, tuple]] = []  # name, left out, inside article or main, marks
    found: list[Block] = []
    paths: list[str] = []
    marks: list[Mark] = []
    parts: list[tuple[str, tuple | None]] = []
    where: list = [None]

    def flush():
        if parts:
            block = Block(*where[0], parts[:])
            if block.text:
                found.append(block)
            parts.clear()
        where[0] = None

    def path():
        return "/".join([s[0] for s in stack if s[0] not in _INLINE])

    def pop_to(i: int):
        del stack[i:]

    for m in _TOKEN.finditer(html):
        text = m["text"]
        if text is not None:
            if where[0] is None:
                where[0] = path(), bool(stack) and stack[-1][2], len(paths)
            parts.append((text, () if not stack else None if stack[-1][1] else stack[-1][3]))
            continue
        name = m["name"]
        if name is None:
            continue  # comments, raw-text elements, declarations
        name = name.lower()
        if name == "br":
            parts.append((" ", ()))
            if where[0] is None:
                where[0] = path(), bool(stack) and stack[-1][2], len(paths)
            continue
        if name not in _INLINE:
            flush()
        if m["close"]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    pop_to(i)
                    break
            continue
        if name not in _INLINE:  # what this element closes
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p" or stack[i][0] in _CLOSES.get(name, ()):
                    pop_to(i)
                    break
                if stack[i][0] not in _INLINE and (stack[i][0] != "p"):
                    break
            paths.append("/".join([s[0] for s in stack if s[0] not in _INLINE] + [name]))
        if name in _VOID:
            continue
        attrs = m["attrs"]
        _, out, inside, on = stack[-1] if stack else ("", False, False, ())
        out = out or name in _OUT
        core = inside or name in ("article", "main")
        if not out and name in _FORM:
            on += (len(marks),)
            marks.append(Mark(path() + "/" + name, "", False, False, len(paths)))
        if attrs.strip() and not out:
            for a in _HINT.finditer(attrs):
                key, value = a[1].lower(), (a[2] or a[3] or a[4] or "").strip()
                if key in ("class", "id"):
                    titled = name in _TITLED or name in _INLINE and any(s[0] in _TITLED and s[0] != "section" for s in stack)
                    hit, confirm = _named(name, key, value, inside, titled)
                    if hit:
                        on += (len(marks),)
                        marks.append(Mark(path() + "/" + name, value, confirm, bool(_THREAD.search(value)), len(paths)))
                elif key == "role":
                    out |= value.lower() in _OUT_ROLE
                    core |= value.lower() in ("main", "article")
                elif key == "aria-hidden":
                    out |= value.lower() == "true"
                else:
                    out |= "display:none" in value.replace(" ", "").lower()
            out |= bool(_HIDDEN.search(re.sub(r"\"[^\"]*\"|'[^']*'", "", attrs)))
        if not attrs.rstrip().endswith("/") or name in _INLINE or name in ("p", "div", "article", "main"):
            stack.append((name, out, core, on))
    flush()
    return found, paths, marks


def honoured(found: list[Block], marks: list[Mark], template=frozenset()) -> frozenset[int]:
    """The marks that leave their element out.

    The text of article and main (of the whole page without them) is what a
    page is about: an element with half of it wraps the page's content, whatever
    its name, unless it is a comment thread; and marks never take all of it.
    """
    if not marks:
        return frozenset()
    about = [b for b in found if b.core] or found
    held, total = [0] * len(marks), 0
    for b in about:
        for text, on in b.pieces:
            size = len(text) if on is not None and not text.isspace() else 0
            total += size
            for i in on or ():
                held[i] += size
    yes = frozenset(i for i, m in enumerate(marks) if (m.thread or 2 * held[i] < total or not held[i])
                    and (not m.confirm or _code("mark", m.path, m.value) in template))
    if total and not any(b.shown(yes) for b in about):
        yes = frozenset(i for i in yes if not held[i])
    return yes


def container(path: str) -> str:
    return path.rpartition("/")[0]


def host_of(url):
    """Lower-case host of a URL column (empty if there is none)."""
    return F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


PAGES = ("host string, page long, token array<long>, kind array<string>, path array<string>, n array<long>, "
         "chars array<long>, seq array<int>")
NESTING = "host string, outer int, inner int, bad boolean, low long, high long"


def _code(kind: str, path: str, text: str = "") -> int:
    import xxhash

    return xxhash.xxh64_intdigest(f"{kind}\x00{path}\x00{text}") - (1 << 63)


def _tokens(pages: DataFrame) -> DataFrame:
    """Per page its distinct tokens with their counts, and their sequence; shown texts have their length."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for host, page, html in zip(*(batch.column(c).to_pylist() for c in ("host", "page", "html")), strict=True):
            found, paths, marks = blocks(html)
            leave = honoured(found, marks)
            # a tag opens after the texts before it; a mark stands at its element's tag
            events = [(i, 1, "tag", path, _code("tag", path), 0) for i, path in enumerate(paths)]
            events += [(b.at, 0, "text", container(b.path), _code("text", b.path, b.text), len(b.shown(leave))) for b in found]
            events += [(m.at, -1, "mark", m.path, _code("mark", m.path, m.value), 0) for m in marks if m.confirm]
            events.sort(key=lambda e: e[:2])
            count: dict[int, list] = {}
            seq = []
            for _, _, kind, path, token, chars in events:
                e = count.setdefault(token, [len(count), kind, path, 0, 0])
                e[3] += 1
                e[4] += chars
                seq.append(e[0])
            _, kind, path, n, chars = zip(*count.values(), strict=True) if count else [()] * 5
            rows.append((host, page, list(count), kind, path, n, chars, seq))
        types = [pa.string(), pa.int64(), *map(pa.list_, (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int32()))]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                          names=[f.split()[0] for f in PAGES.split(", ")])
    return map_batches(pages.withColumn("page", F.monotonically_increasing_id()), run, PAGES)


def nesting(tokens: list[int], of: dict[int, int], size: dict[int, int]):
    """``outer, inner, bad, place`` of the classes of one page's token sequence.

    ``of`` names tokens' classes, lower numbers first in rank. A class is ordered
    if its tokens come in one and the same order again and again (the row with
    itself; the place is that order). Two classes nest if each tuple of one
    lies between two consecutive tokens of the other, or beside its tuples (the
    place tells which two tokens).
    """
    at: dict[int, list] = {}
    for i, token in enumerate(tokens):
        if token in of:
            at.setdefault(of[token], []).append(i)
    spots = {}
    for c in sorted(at):
        k = size[c]
        order = tuple(tokens[i] for i in at[c][:k])
        ordered = len(set(order)) == k and len(at[c]) % k == 0 and all(
            tokens[i] == order[j % k] for j, i in enumerate(at[c]))
        yield c, c, not ordered, hash(order) if ordered else 0
        if ordered:
            spots[c] = np.array(at[c])
    names = list(spots)
    for i, a in enumerate(names):
        for b in names[i + 1:]:
            place = _inside(spots[a], size[a], spots[b], size[b])
            if place is None:
                place = _inside(spots[b], size[b], spots[a], size[a])
                place = place if place is None else -1 - place
            yield a, b, place is None, place or 0


def _inside(a: np.ndarray, k: int, b: np.ndarray, m: int) -> int | None:
    """The one gap of ``a``'s tuples that holds every tuple of ``b`` whole (0: beside them), or None."""
    gap = np.searchsorted(a, b)
    if (gap.reshape(-1, m) != gap[::m, None]).any():
        return None
    gap = gap % k
    return int(gap[0]) if (gap == gap[0]).all() else None


def _valid(seqs: DataFrame, often: DataFrame, classes: DataFrame) -> DataFrame:
    """``host, vector, on`` of the classes that are ordered and nest with all valid ones before them."""
    rank = Window.partitionBy("host").orderBy(F.desc("on"), F.desc("size"), "depth", "vector")
    ranked = stage(classes.withColumn("cls", F.row_number().over(rank)), "classes")
    named = (often.join(ranked, ["host", "vector", "on"]).groupBy("host")
             .agg(F.collect_list("token").alias("known"), F.collect_list("cls").alias("cls")))
    named = stage(named, "named")
    total = named.agg(F.sum(F.size("known"))).first()[0] or 0
    named = F.broadcast(named) if total <= BROADCAST_IDS else named

    def run(batch: pa.RecordBatch):
        memo, seen = {}, {}
        for i, host in enumerate(batch.column("host").to_pylist()):
            if host not in memo:
                of = dict(zip(batch.column("known")[i].as_py(), batch.column("cls")[i].as_py(), strict=True))
                memo[host] = of, Counter(of.values())
            token = batch.column("token")[i].as_py()
            for a, b, bad, place in nesting([token[j] for j in batch.column("seq")[i].as_py()], *memo[host]):
                e = seen.setdefault((host, a, b), [bad, place, place])
                seen[host, a, b] = [e[0] or bad, min(e[1], place), max(e[2], place)]
        rows = [(*key, *e) for key, e in seen.items()]
        if rows:
            types = (pa.string(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                             names=[f.split()[0] for f in NESTING.split(", ")])
    found = map_batches(seqs.select("host", "token", "seq").join(named, "host"), run, NESTING)
    clash = (found.groupBy("host", "outer", "inner").agg(F.max("bad").alias("bad"), F.min("low").alias("low"), F.max("high").alias("high"))
             .filter("bad OR low <> high").groupBy("host").agg(F.collect_list(F.struct("outer", "inner")).alias("clash")))

    def accept(batch: pa.RecordBatch) -> pa.RecordBatch:
        gone = [rejected((e["outer"], e["inner"]) for e in x) for x in batch.column("clash").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("host"), pa.array(gone, pa.list_(pa.int32()))], names=["host", "gone"])
    gone = (stage(map_batches(clash, accept, "host string, gone array<int>"), "rejected")
            .select("host", F.explode("gone").alias("cls")))
    return ranked.join(gone, ["host", "cls"], "left_anti").select("host", "vector", "on")


def rejected(clashes) -> list[int]:
    """Classes that clash with themselves, or with one before them that is not rejected."""
    before: dict[int, list] = {}
    for a, b in clashes:
        before.setdefault(b, []).append(a)
    gone: set[int] = set()
    for c in sorted(before):
        if any(a == c or a not in gone for a in before[c]):
            gone.add(c)
    return sorted(gone)


def templates(pages: DataFrame) -> DataFrame:
    """``host, template array<long>, main string``: tokens of the valid classes and the main container."""
    hosts = pages.groupBy("host").agg(F.count("*").alias("pages"))
    seqs = stage(_tokens(pages), "pages")
    each = seqs.select("host", "page", F.explode(F.arrays_zip("token", "kind", "path", "n", "chars")).alias("t")).select("host", "page", "t.*")
    tokens = (each.groupBy("host", "token").agg(
        F.first("kind").alias("kind"), F.first("path").alias("path"), F.count("*").alias("on"), F.sum("chars").alias("chars"),
        F.bit_xor(F.xxhash64("page", "n")).alias("vector")))
    tokens = stage(tokens, "tokens").join(F.broadcast(hosts) if hosts.count() <= BROADCAST_IDS else hosts, "host")
    often = tokens.filter((F.col("on") >= MIN_PAGES) & (F.col("on") >= MIN_SHARE * F.col("pages")))
    classes = often.groupBy("host", "vector", "on").agg(F.count("*").alias("size"), F.min(F.length("path")).alias("depth"))
    valid = _valid(seqs, often, classes.filter(F.col("size") >= MIN_TOKENS))
    template = often.join(valid, ["host", "vector", "on"])
    template = stage(template, "template")
    # slots: texts of no class that has tags; the container with most of their text, if it outweighs the template's
    skeleton = template.filter("kind = 'tag'").select("host", "vector", "on").distinct()
    fixed = template.filter("kind = 'text'").join(skeleton, ["host", "vector", "on"], "left_semi")
    slots = (tokens.filter((F.col("kind") == "text") & (F.col("chars") > 0) & (F.col("pages") >= MIN_PAGES))
             .join(fixed.select("host", "token"), ["host", "token"], "left_anti"))
    main = (slots.groupBy("host", "path").agg(F.sum("chars").alias("chars"))
            .groupBy("host").agg(F.max_by("path", F.struct("chars", "path")).alias("main"), F.sum("chars").alias("free"))
            .join(fixed.groupBy("host").agg(F.sum("chars").alias("bound")), "host", "left")
            .filter(F.col("free") >= F.coalesce("bound", F.lit(0))).select("host", "main"))
    # a text is boilerplate if its class has a tag outside the main container; else pages share it as content
    outside = (template.filter("kind = 'tag'").join(main, "host", "left")
               .filter(F.col("main").isNull() | ~F.concat("path", F.lit("/")).startswith(F.concat("main", F.lit("/"))))
               .select("host", "vector", "on").distinct())
    listed = (template.filter("kind <> 'text'").unionByName(fixed.join(outside, ["host", "vector", "on"], "left_semi").select(template.columns))
              .groupBy("host").agg(F.collect_set("token").alias("template")))
    return hosts.select("host").join(listed, "host", "left").join(main, "host", "left")


def main_text(html: str, template: frozenset[int] | set[int], main: str | None) -> str:
    found, _, marks = blocks(html)
    leave = honoured(found, marks, template)
    shown = [(b, text) for b in found if (text := b.shown(leave))]
    if main is not None:  # the slots inside article or main are all that it holds
        inside = [x for x in shown if x[0].path == main or x[0].path.startswith(main + "/") or container(x[0].path) == main]
        if any(x[0].core for x in inside):
            inside = [x for x in shown if x[0].core]
        else:
            inside = [x for x in shown if x[0].core or x in inside]
    else:
        inside = [x for x in shown if x[0].core]
    kept = inside or shown
    own = [x for x in kept if x[0].core or _code("text", x[0].path, x[0].text) not in template] if template else kept
    if 2 * sum(len(text) for _, text in own) < sum(len(text) for _, text in kept):
        own = kept  # mostly shared text: a near copy of other pages
    return "\n".join(text for _, text in own)


EXTRACTED = "page_id long, url string, text string, n_chars long"


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"), host_of(F.col("url")).alias("host"))
    known = stage(templates(rows), "templates")
    size = known.agg(F.sum(F.coalesce(F.size("template"), F.lit(0)) + 8)).first()[0] or 0
    known = F.broadcast(known) if size <= BROADCAST_IDS else known

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        text, memo = [], {}
        for host, html, template, main in zip(*(batch.column(c) for c in ("host", "html", "template", "main")), strict=True):
            host = host.as_py()
            if host not in memo:
                memo[host] = (frozenset(template.as_py() or ()), main.as_py())
            text.append(main_text(html.as_py(), *memo[host]))
        return pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(text, pa.string()), pa.array(np.array([*map(len, text)], np.int64))],
            names=["page_id", "url", "text", "n_chars"])
    return map_batches(rows.join(known, "host", "left").select("page_id", "url", "html", "host", "template", "main"), run, EXTRACTED)
