"""Main text of web pages by template deduction from equivalence classes.

A page is walked once. Its tokens are its elements, named by their path (tag names with classes and ids), and its text
blocks, named by the path of their block and a digest of their words. A token's occurrence vector says how often it occurs
on each page of a host. Tokens with equal vectors form a class. Vectors are compared by a hash that is folded over (page,
count) pairs in a group-by, so a host with any share of all pages is spread over all tasks and nothing is gathered per
host but its tokens that occur on at least ``SUPPORT`` of the pages, of which there are at most a few per page element.

A class is valid if it has two or more tokens (that of the page itself counts), its tokens come in one order (by their mean places), and its outer
tokens lie in one slot of the classes above; what lies in several slots is split into a class a slot. A token that shares
its vector with no other is data, not template. Valid classes nest by path into the template, whose elements bound its
slots. The classes decide:

- the main slot: the deepest container of a valid class with one occurrence a page that holds ``MAIN_SHARE`` of the text;
- words: text blocks in the class of the main slot stand on each page that has the slot, once: the template's words, not
  the article's (unless they are over ``WORDS_SHARE`` of the host's text: then the pages are copies of a text);
- menus: slots outside the main one that are linked text by ``LINK_SHARE``; inside it those of its own class.

The remaining slots are extracted, block by block in page order. Elements that are no part of an article by their tag, role,
hidden attribute or a whole class or id name (``marked_out``) never count, but for such names on html, body, main, article
or on what holds most of a page's text.

Templates meet their pages in a join: Spark broadcasts the table of templates while it is small by its file sizes, and
otherwise shuffles, splitting the partitions of a large host.

Defined cases: null or empty html gives an empty text; a host of fewer than ``LEAST_PAGES`` pages has no vectors to tell
template from data, so its pages, like pages without their host's main slot, use the container of most text on the page
itself; a url without a host belongs to host ""; repeated rows give equal rows; extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

SUPPORT, MAIN_SHARE, LINK_SHARE, WORDS_SHARE = 0.5, 0.6, 0.6, 0.5
LEAST_PAGES = 3
_FLUSH = 100_000
_MARK = "\x1f"
_LISTS = frozenset("ul ol menu dl table".split())
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>"
    r"|<(?P<raw>script|style|noscript|template|svg|iframe|textarea|title)\b[^>]*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][a-z0-9:-]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-z][a-z0-9:-]*+)(?P<rest2>[^>]*+)>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NOTABLE = re.compile(r"\b(?:class|id|role|style|hidden)\b", re.I)
_NAME_PARTS = re.compile(r"[^\W\d_]+")
_CONTAINERS = frozenset("html body main article section div td".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
_CLOSES_P = _BLOCKS - frozenset("td th tr tbody thead tfoot dd dt li body html".split())
_OUT = frozenset("nav header footer aside form head button select option menu dialog input label object audio video canvas map".split())
#: Names of what is no part of an article.
_OUT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner promo promotion sponsor sponsored sidebar aside menu nav navbar navigation"
    " breadcrumb breadcrumbs footer header masthead topbar cookie cookies consent gdpr notice notices alert popup modal overlay newsletter"
    " subscribe subscription signup login share sharing social related recommended comment comments disqus reply replies respond widget"
    " toolbar pagination pager skip legal copyright contentinfo complementary search dialog alertdialog".split()
)
#: Words that may stand beside them in a name without changing what it names.
_BESIDE = frozenset("section list area box container wrapper block bar panel group main site page global top bottom left right primary secondary links link button buttons form slot unit inner outer".split())
#: Never an article, whatever its share of the text.
_ADVERTS = frozenset("ad ads adv advert adverts advertisement advertising promo sponsored cookie cookies consent gdpr".split())
_NEVER_OUT = frozenset("html body main article".split())
_SAME = {"li": ("ul", "ol", "menu"), "dd": ("dl",), "dt": ("dl",), "td": ("tr", "table"), "th": ("tr", "table"), "tr": ("table", "tbody", "thead", "tfoot"), "option": ("select",)}


def marked_out(name: str) -> frozenset[str]:
    """Those words of a class, id or role that name no part of an article; none if any other word tells of something else
    (site-footer and comments-section are out, no-sidebar, has-comments and legal-article are not)."""
    parts = frozenset(w.lower() for w in _NAME_PARTS.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name)))
    out = parts & _OUT_WORDS
    return out if out and parts <= _OUT_WORDS | _BESIDE else frozenset()


class _Names(dict):
    """name -> marked_out; remembers a bounded number of names."""

    def __missing__(self, name: str) -> frozenset[str]:
        out = marked_out(name)
        if len(self) < _FLUSH:
            self[name] = out
        return out


_NAMES = _Names()


class Block(NamedTuple):
    where: str
    text: str
    chars: int
    links: int
    place: int


class Page:
    """One walk over a page: how often each element path occurs, in which order they come first, and the text blocks."""

    def __init__(self, source: str) -> None:
        spared: frozenset[int] = frozenset()
        while more := self._walk(source, spared) - spared:  # a marked element with most of the text is the article's own
            spared |= more

    def _walk(self, source: str, spared: frozenset[int]) -> set[int]:
        """Reads the page; returns the elements, numbered, that their marks put out though they hold most of the text."""
        self.count: Counter = Counter()
        self.place: dict[str, int] = {}
        self.blocks: list[Block] = []
        stack: list[tuple[str, str, int, bool]] = [("", "", 0, False)]  # name, path, what puts it out of the article (a marked element's number, -1 a tag), link
        marked: Counter = Counter()
        number = 0
        text: list[str] = []
        where, chars, links = "", 0, 0

        def flush() -> None:
            nonlocal chars, links
            if text:
                block = " ".join(entities.unescape("".join(text)).split())
                if block:
                    self.blocks.append(Block(where, block, chars, links, number))
                text.clear()
                chars = links = 0

        def add(part: str) -> None:
            nonlocal where, chars, links
            _, path, out, link = stack[-1]
            if out > 0:
                marked[out] += len("".join(part.split()))
            if out or not part:
                return
            if not text:
                where = next((e[1] for e in reversed(stack) if e[0] in _BLOCKS), "")
            text.append(part)
            if not part.isspace():
                size = len(part) - part.count(" ")
                chars += size
                if link:
                    links += size

        def close(depth: int) -> None:
            if any(e[0] in _BLOCKS for e in stack[depth:]):
                flush()
            del stack[depth:]

        at = 0
        for m in _TOKEN.finditer(source):
            if m.start() > at:
                add(source[at : m.start()])
            at = m.end()
            name = (m["name"] or m["name2"] or "").lower()
            if not name:
                continue
            if m["end"] or m["end2"]:
                for d in range(len(stack) - 1, 0, -1):
                    if stack[d][0] == name:
                        close(d)
                        break
                    if stack[d][0] in ("td", "th", "table", "article", "body") and name in ("p", "b", "i", "span", "a", "li"):
                        break
                continue
            rest = m["rest"] or m["rest2"] or ""
            if name == "br":
                add(" ")
                continue
            if name in _CLOSES_P:
                for d in range(len(stack) - 1, 0, -1):
                    if stack[d][0] == "p":
                        close(d)
                        break
                    if stack[d][0] in _BLOCKS:
                        break
            elif name in _SAME:
                for d in range(len(stack) - 1, 0, -1):
                    if stack[d][0] == name:
                        close(d)
                        break
                    if stack[d][0] in _SAME[name]:
                        break
            if name in _BLOCKS:
                flush()
            key, words, hidden = name, frozenset(), False
            if rest and _NOTABLE.search(rest):
                notes = {k.lower(): a or b or c for k, a, b, c in reversed(_ATTRIBUTE.findall(rest))}
                hidden = "hidden" in notes or re.search(r"(?:^|;)\s*display\s*:\s*none\s*(?:!important\s*)?(?:;|$)", notes.get("style", ""), re.I) is not None
                key += "".join(sorted(f"{sign}{w}" for k, sign in (("class", "."), ("id", "#"), ("role", "@")) for w in notes.get(k, "").split() if not any(map(str.isdigit, w))))
                if name not in _NEVER_OUT:
                    words = frozenset().union(*(_NAMES[w] for k in ("class", "id", "role") for w in notes.get(k, "").split()))
            _, path, out, link = stack[-1]
            path = f"{path}>{key}" if path else key
            number += 1
            if name in _OUT or words & _ADVERTS or (hidden and name not in ("html", "body")):
                out = -1
            elif number not in spared and words:
                out = out or number
            self.count[path] += 1
            self.place.setdefault(path, number)
            if name not in _VOID and not rest.endswith("/"):
                stack.append((name, path, out, link or name == "a"))
        if at < len(source):
            add(source[at:])
        flush()
        self.chars = sum(b.chars for b in self.blocks)
        total = self.chars + sum(marked.values())
        return {k for k, n in marked.items() if 2 * n > total}

    def mass(self) -> tuple[Counter, Counter]:
        """Characters of text and of linked text under each path, those of the paths below it included."""
        chars, links = Counter(), Counter()
        for b in self.blocks:
            above = b.where
            while above:
                chars[above] += b.chars
                links[above] += b.links
                above = above.rpartition(">")[0]
        return chars, links


def _tag(path: str) -> str:
    return re.split(r"[.#@]", path.rpartition(">")[2], maxsplit=1)[0]


def _main(once: dict[str, float], total: float) -> str:
    """The deepest container that occurs once and holds most of the text."""
    fits = [p for p, chars in once.items() if chars >= MAIN_SHARE * total and _tag(p) in _CONTAINERS]
    return max(fits, key=lambda p: (p.count(">"), once[p], p), default="")


def text_token(b: Block) -> str:
    """The name of a text block: its path, a mark that no path holds, and a digest of its words."""
    return b.where + _MARK + xxhash.xxh64_hexdigest(b.text.encode("utf-8", "surrogatepass"))


def host_column(url: object) -> object:
    return F.coalesce(F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1)), F.lit(""))


def tokens(pages: DataFrame) -> DataFrame:
    """(host, token, n_pages, n_times, vector, place, chars, links): vectors as hashes; token "" stands for the page itself."""
    names = ["host", "token", "n_pages", "n_times", "vector", "place", "chars", "links"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, str], list[int]] = {}

        def rows() -> pa.RecordBatch:
            columns = list(zip(*[(h, t, *v) for (h, t), v in sums.items()], strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.string(), pa.string(), *[pa.int64()] * 6], strict=True)], names=names)

        for b in common.pieces_of(batches):
            for host, page_key, source in zip(*(c.to_pylist() for c in b.columns), strict=True):
                page = Page(source)
                chars, links = page.mass()
                seen = [("", 1, 0, page.chars, 0)]
                seen += [(t, n, page.place[t], chars[t], links[t]) for t, n in page.count.items()]
                texts: dict[str, list[int]] = {}
                for x in page.blocks:
                    v = texts.setdefault(text_token(x), [0, x.place, 0, 0])
                    for i, n in ((0, 1), (2, x.chars), (3, x.links)):
                        v[i] += n
                seen += [(t, *v) for t, v in texts.items()]
                for t, n, place, c, k in seen:
                    v = sums.setdefault((host, t), [0] * 6)
                    for i, x in enumerate((1, n, 0, place, c, k)):
                        v[i] += x
                    v[2] ^= xxhash.xxh64_intdigest(f"{page_key} {n}") - (1 << 63)
                if len(sums) > _FLUSH:
                    yield rows()
                    sums = {}
        if sums:
            yield rows()

    schema = "host string, token string, n_pages long, n_times long, vector long, place long, chars long, links long"
    found = common.map_arrow(pages.select("host", F.xxhash64("page_id", "url").alias("page_key"), "html"), work, schema)
    return found.groupBy("host", "token").agg(*[F.sum(c).alias(c) for c in ("n_pages", "n_times", "place", "chars", "links")], F.bit_xor("vector").alias("vector"))


def _path_of(token: str) -> str:
    return token.partition(_MARK)[0]


def equivalence_classes(page: tuple[int, int, int], found: list[dict]) -> list[dict]:
    """The valid classes of a host's well-supported tokens, outer ones first: vector (as hash, pages, times), once (one
    occurrence a page), whole (the class of the page itself), tokens in order, and within, the number of the class whose slot holds it."""
    groups = defaultdict(list)
    for t in found:
        groups[t["vector"], t["n_pages"], t["n_times"]].append(t)
    left = sorted(groups.items(), key=lambda g: (min(t["place"] / t["n_pages"] for t in g[1]), min(t["token"] for t in g[1])))
    out: list[dict] = []
    owner: dict[str, int] = {}
    for vector, members in left:
        members = sorted(members, key=lambda t: (t["place"] / t["n_pages"], t["token"]))
        own = {t["token"] for t in members if _MARK not in t["token"]}
        slots: dict[str, list[dict]] = defaultdict(list)  # by the element above that a valid class holds; inner tokens follow their outer ones
        slot_of: dict[str, str] = {}
        for t in members:
            path = _path_of(t["token"])
            above = path if _MARK in t["token"] else path.rpartition(">")[0]
            while above and above not in owner and above not in own:
                above = above.rpartition(">")[0]
            slot = slot_of.get(above, above)
            slot_of[t["token"]] = slot
            slots[slot].append(t)
        whole = vector == page
        for slot, inside in slots.items():
            places = [t["place"] / t["n_pages"] for t in inside if _MARK not in t["token"]]
            if len(inside) + whole < 2 or any(a >= b for a, b in zip(places, places[1:], strict=False)):
                continue
            for t in inside:
                if _MARK not in t["token"]:
                    owner[t["token"]] = len(out)
            out.append({"vector": list(vector), "once": vector[1] == vector[2], "whole": whole, "tokens": [t["token"] for t in inside], "within": owner.get(slot)})
    return out


def deduce(page: dict, found: list[dict]) -> dict:
    """The template of a host: main slot, slots of links, the template's words, and the classes they come from. page: the
    statistics of the token "", found: those of the host's tokens with enough support."""
    classes = equivalence_classes((page["vector"], page["n_pages"], page["n_times"]), found)
    of = {t: c for c in classes for t in c["tokens"]}
    held = {t["token"]: t for t in found if t["token"] in of}
    elements = {t: x for t, x in held.items() if _MARK not in t}
    main = _main({t: x["chars"] for t, x in elements.items() if of[t]["once"]}, page["chars"])
    home = lambda t: of[t]["vector"] == of[main]["vector"] if main else of[t]["whole"]
    inside = lambda t: t == main or t.startswith(main + ">")
    lists = [t for t, x in elements.items() if _tag(t) in _BLOCKS and x["links"] > LINK_SHARE * x["chars"] > 0 and not (main == t or main.startswith(t + ">")) and (home(t) or not main or not inside(t))]
    words = [x for t, x in held.items() if _MARK in t and home(t)]
    if sum(x["chars"] for x in words) > WORDS_SHARE * page["chars"]:
        words = []
    return {"main": main, "lists": sorted(lists), "words": sorted(x["token"] for x in words), "classes": json.dumps(classes, ensure_ascii=False)}


def templates(pages: DataFrame) -> DataFrame:
    """One row per host of at least LEAST_PAGES pages: main, lists, words and classes (JSON)."""
    found = common.staged(tokens(pages), "tokens")
    fields = ("n_pages", "n_times", "vector", "chars")
    hosts = found.where("token = ''").select("host", F.struct(*fields).alias("page")).where(F.col("page.n_pages") >= LEAST_PAGES)
    hosts = common.staged(hosts, "hosts")  # of known size: broadcast while small, so no host meets in a task
    kept = found.where("token <> ''").join(hosts, "host").where(F.col("n_pages") >= SUPPORT * F.col("page.n_pages"))
    packed = kept.groupBy("host").agg(F.collect_list(F.struct("token", "n_pages", "n_times", "vector", "place", "chars", "links")).alias("found"))
    packed = hosts.join(packed, "host", "left").select("host", "page", "found")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.pieces_of(batches):
            out = [deduce(p, f or []) for p, f in zip(*(b.column(i).to_pylist() for i in (1, 2)), strict=True)]
            texts = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array([o[k] for o in out], t) for k, t in (("main", pa.string()), ("lists", texts), ("words", texts), ("classes", pa.string()))]],
                names=["host", "main", "lists", "words", "classes"],
            )

    return common.map_arrow(packed, work, "host string, main string, lists array<string>, words array<string>, classes string")


def _under(path: str, top: str) -> bool:
    return not top or path == top or path.startswith(top + ">")


def extract_page(source: str, main: str | None = None, lists: list[str] | None = None, words: frozenset[str] = frozenset()) -> str:
    """The remaining slots of a page, block by block. main, lists and words are its host's; None where it has no template."""
    page = Page(source)
    if main is None or (main and not page.count[main]):
        chars, _ = page.mass()
        main = _main({p: chars[p] for p, n in page.count.items() if n == 1}, page.chars)
    left = [b for b in page.blocks if not any(_under(b.where, s) for s in lists or ()) and not (words and text_token(b) in words)]
    inner = main if _tag(main) in ("article", "main") or (main and _tag(main) not in ("html", "body")) else None
    chars, links = page.mass()

    def menu(b: Block) -> bool:  # a block or a list of links beside the main slot
        above = b.where
        while above and (inner is None or not _under(inner, above)) and _tag(above) not in ("html", "body"):
            if _tag(above) in _LISTS and links[above] > LINK_SHARE * chars[above]:
                return True
            above = above.rpartition(">")[0]
        return inner is not None and b.links > LINK_SHARE * b.chars

    kept = [b.text for b in left if (inner is not None and _under(b.where, inner)) or not menu(b)]
    return "\n\n".join(kept)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, text, n_chars) for each page."""
    rows = pages.select("page_id", "url", host_column(F.col("url")).alias("host"), common.text_of(F.col("html")).alias("html"))
    known = common.staged(templates(rows).drop("classes"), "templates")
    id_type = pages.schema["page_id"].dataType.simpleString()
    url_type = pages.schema["url"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[str, frozenset[str]] = {}
        for b in common.pieces_of(batches):
            texts = []
            for host, source, main, lists, words in zip(*(b.column(i).to_pylist() for i in range(2, 7)), strict=True):
                if words and host not in sets:
                    if len(sets) > 1000:
                        sets.clear()
                    sets[host] = frozenset(words)
                texts.append(extract_page(source, main, lists, sets[host] if words else frozenset()))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(3)), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "host", "text", "n_chars"])

    joined = rows.join(known, "host", "left").select("page_id", "url", "host", "html", "main", "lists", "words")
    return common.map_arrow(joined, work, f"page_id {id_type}, url {url_type}, host string, text string, n_chars long")


def query(spark, sf_dir: str) -> DataFrame:
    return extract(common.read_texts(spark, sf_dir, "pages", "page_id", "url", "html")).select("page_id", "url", "text", "n_chars")
