"""Main text of web pages by consensus host paths.

Pages of one host share a template.  Each page scores its containers: a text
block counts for its parent in full and for its grandparent by half, less what
is link text, and furniture (menus, headers, footers, adverts, forms, comments
...) counts for nothing.  The best container's path of tags and classes, digits
generalised, is the page's vote, after a climb from the best container to the
outermost article or main, and on while the text stays mostly the same.  Spark counts the votes per host; every page is
then read again with its host's winning path, or with its own if it has no text
there.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession

from .common import maybe_broadcast, stage, table, tidy
from .urlfilter import host_and_path

_TAG = re.compile(r"<!--(?:>|->|.*?(?:-->|\Z))|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>?|<[!?/][^>]*>?", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_DIGITS = re.compile("[0-9]+")
#: Their content is no text, whatever it looks like.
_RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_CONTAINERS = frozenset("article main section div body td center blockquote".split())
#: Parts of a text rather than the whole: their blocks count for the container around them.
_PARTS = frozenset("section td blockquote".split())
_FURNITURE = frozenset("nav header footer aside button select menu dialog template svg head object video audio canvas".split())
_FURNITURE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar navigation breadcrumb breadcrumbs "
    "cookie cookies consent gdpr notice notification alert popup modal overlay newsletter subscribe signup share sharing social comment comments disqus respond replies "
    "related recommended footer header masthead topbar login search widget toolbar pagination pager copyright contentinfo complementary search form".split()
)
_COMMENT_NAMES = frozenset("comment comments disqus respond replies".split())
#: Inside an article or main these are furniture only with controls or mostly links in them.
_WEAK_NAMES = frozenset("form search share sharing social related recommended widget".split())
_CONTROLS = frozenset("input button select textarea".split())
#: With these around, a name of furniture may also be that of a wrapper.
_QUALIFIERS = frozenset("site page top bottom left right main primary secondary global mobile container wrapper wrap box area list links bar section block inner".split())
#: Furniture unless they hold most of the page's text.
_DOUBTFUL = frozenset("form fieldset".split())
#: Share of a parent's text that makes a container's text mostly the same; of the whole body's, which may add no links either.
SAME, SAME_BODY = 2 / 3, 0.9
_NAME = re.compile(r"[_-]+")
#: Open elements that a start tag of the key ends first, up to the nearest of the second set.
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
_TOP = frozenset(("article", "main", "body", "html"))


class _Element:
    """An open element; ``path`` is its number in the page's ``_Paths``, so nesting costs no text."""

    __slots__ = ("tag", "path", "out", "link", "holder", "above", "doubt", "outer", "inside", "weak", "near_p", "score", "weight", "linked", "menus", "controls")

    def __init__(self, tag, path, out, link, holder, above, doubt=None):
        self.tag, self.path, self.out, self.link, self.holder, self.above, self.doubt = tag, path, out, link, holder, above, doubt
        self.outer, self.inside = None, False
        self.weak, self.near_p, self.score, self.weight, self.linked, self.menus, self.controls = False, -1, 0.0, 0, 0, 0, False


class _Paths:
    """Numbers of tag-class paths: a path is its parent's number and its own label."""

    def __init__(self):
        self.numbers: dict[tuple[int, str], int] = {}
        self.steps: list[tuple[int, str]] = [(-1, "")]

    def number(self, parent: int, label: str) -> int:
        found = self.numbers.get((parent, label))
        if found is None:
            found = self.numbers[parent, label] = len(self.steps)
            self.steps.append((parent, label))
        return found

    def spelled(self, number: int) -> str:
        labels = []
        while number > 0:
            number, label = self.steps[number]
            labels.append(">" + label)
        return "".join(reversed(labels))

    def find(self, path: str) -> int | None:
        number = 0
        for label in path.split(">")[1:]:
            number = self.numbers.get((number, label))
            if number is None:
                return None
        return number


class Blocks(list):
    """(text, characters in links, innermost container) in page order, with the page's paths and containers."""

    def __init__(self, rows, paths: _Paths, holders: list):
        super().__init__(rows)
        self.paths, self.holders = paths, holders


def _names(attributes: str) -> tuple[str, bool, bool, bool, bool]:
    """Generalised classes as path suffix; whether a whole name is one of furniture, may be one, is one of a kind that articles use too, is one of comments."""
    classes, furniture, doubtful, weak, comment = [], False, False, False, False
    if "=" in attributes:
        for m in _ATTRIBUTE.finditer(attributes):
            names = (m[2] or m[3] or m[4] or "").lower().split()
            if m[1].lower() == "class":
                classes = sorted({_DIGITS.sub("0", c).replace(">", "") for c in names})
            for name in names:
                words = {w for w in _NAME.split(name) if w}
                if not _FURNITURE_NAMES.isdisjoint(words):
                    weak = weak or words <= _WEAK_NAMES
                    furniture = furniture or words <= _FURNITURE_NAMES and not words <= _WEAK_NAMES
                    comment = comment or words <= _COMMENT_NAMES
                    doubtful = doubtful or words <= _FURNITURE_NAMES | _QUALIFIERS
    return "".join("." + c for c in classes), furniture, doubtful and not furniture and not weak, weak and not furniture, comment


def blocks(page: str, *, names: bool = True) -> Blocks:
    """The page's text blocks, furniture left out.

    If that leaves nothing, names, forms and the like are no reason to leave text out.
    """
    paths = _Paths()
    root = _Element("", 0, False, False, None, None)
    root.holder = root
    stack, found = [root], []
    open_tags: dict[str, int] = {}
    holders, doubted, marks = [root], [], []
    parts: list[tuple[str, bool]] = []
    holder, doubt = root, None

    def flush():
        if parts:
            text = " ".join("".join(p for p, _ in parts).split())
            if text:
                found.append((text, sum(len(" ".join(p.split())) for p, link in parts if link), holder))
                marks.append(doubt)
            parts.clear()

    def push(e):
        stack.append(e)
        open_tags[e.tag] = open_tags.get(e.tag, 0) + 1

    def pop_to(i):
        for e in stack[i:]:
            if e.tag not in _INLINE:
                flush()
                break
        for e in stack[i:]:
            open_tags[e.tag] -= 1
        del stack[i:]

    at, end = 0, len(page)
    while at < end:
        m = _TAG.search(page, at)
        stop = m.start() if m else end
        top = stack[-1]
        if stop > at and not top.out:
            if not parts:
                holder, doubt = top.holder, top.doubt
            parts.append((html.unescape(page[at:stop]), top.link))
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1) if open_tags.get(tag) else ():
                if stack[i].tag == tag:
                    pop_to(i)
                    break
                if stack[i].tag in _TOP and tag in ("p", "li", "a", "b", "i", "em", "strong", "span"):
                    break
            continue
        if tag in _CONTROLS and top.doubt is not None:
            top.doubt.controls = True
        if tag in _RAW:
            if tag != "title" and tag not in _INLINE:
                flush()
            close = re.compile(f"</{re.escape(tag)}(?=[\\s/>]|$)", re.I).search(page, at)
            at = close.start() if close else end
            continue
        if tag == "br":
            if not top.out and parts:
                parts.append((" ", False))
            continue
        if tag not in _INLINE:
            flush()
            if tag in _ENDS:
                ended, within = _ENDS[tag]
                for i in range(len(stack) - 1, 0, -1) if any(map(open_tags.get, ended)) else ():
                    if stack[i].tag in within:
                        break
                    if stack[i].tag in ended:
                        pop_to(i)
                        break
            elif top.near_p >= 0:
                pop_to(top.near_p)
        if tag in _VOID or m[3].endswith("/") and tag not in _CONTAINERS and tag not in ("p", "a"):
            continue
        above = stack[-1]
        if tag in _INLINE:
            e = _Element(tag, above.path, above.out, above.link or tag == "a", above.holder, None, above.doubt)
            e.near_p, e.inside = above.near_p, above.inside
            push(e)
            continue
        suffix, named, doubtful, weak, comment = _names(m[3])
        inside = above.inside
        if tag in ("article", "main"):
            out, doubtful = above.out and (named or weak or doubtful) or comment, doubtful or named or weak
        else:
            weak_out = weak and not inside
            out = above.out or tag in _FURNITURE and not (tag == "header" and inside) or names and (named or weak_out) and tag not in _TOP
            doubtful = doubtful and tag not in _TOP
        e = _Element(tag, paths.number(above.path, tag + suffix), out, above.link, above.holder, above.holder, above.doubt)
        e.near_p, e.inside = len(stack) if tag == "p" else -1, inside or tag in ("article", "main")
        if names and not out and (tag in _DOUBTFUL or doubtful or weak and inside):
            e.weak = weak and inside and tag not in _DOUBTFUL and not doubtful
            e.outer, e.doubt = above.doubt, e
            doubted.append(e)
        if tag in _CONTAINERS and tag not in _PARTS:
            e.holder = e
            holders.append(e)
        push(e)
    flush()
    if doubted:
        for (text, linked, _), mark in zip(found, marks):
            if mark is not None:
                mark.weight += len(text)
                mark.linked += linked
        for e in reversed(doubted):
            if e.outer is not None:
                e.outer.weight += e.weight
                e.outer.linked += e.linked
                e.outer.controls |= e.controls
        half, fine = sum(len(text) for text, _, _ in found) / 2, {None: True}
        for e in doubted:
            own = not e.controls and 4 * e.linked < e.weight if e.weak else e.weight > half
            fine[e] = own and fine[e.outer]
        for e in doubted:
            e.weight = e.linked = 0
        found = [f for f, mark in zip(found, marks) if fine[mark]]
    return Blocks(found, paths, holders) if found or not names else blocks(page, names=False)


def best_path(found: Blocks) -> str | None:
    """The path of the container with the highest score, or of the one around it that the climb ends at; of equals, the first in the page.

    The page itself, with an empty path, is the outermost.
    """
    if not found:
        return None
    for text, linked, holder in found:
        weight = max(0, len(text) - 2 * linked)
        holder.weight += len(text)
        holder.menus += 2 * linked >= len(text)
        holder.score += weight
        if holder.above is not None:
            holder.above.score += 0.5 * weight
    for e in reversed(found.holders):
        if e.above is not None:
            e.above.weight += e.weight
            e.above.menus += e.menus
    best = max(found.holders, key=lambda e: (e.score, e.weight > 0))
    e = best.above
    while e is not None:
        if e.tag in ("article", "main"):
            best = e
        e = e.above
    while best.above is not None and best.tag != "body":
        around, whole = best.above, best.above.tag in ("body", "")
        if best.weight < (SAME_BODY if whole else SAME) * around.weight or whole and best.menus < around.menus:
            break
        best = around
    for e in found.holders:
        e.weight, e.menus, e.score = 0, 0, 0.0
    return found.paths.spelled(best.path)


def text_at(found: Blocks, path: str | None) -> str:
    """Blocks in or below containers of ``path``, one a line."""
    number = None if path is None else found.paths.find(path)
    if number is None:
        return ""
    inside = {}
    for e in found.holders:
        inside[id(e)] = e.path == number or e.above is not None and inside[id(e.above)]
    return "\n".join(text for text, _, holder in found if inside[id(holder)])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row; null html is empty; rows without a host vote among themselves."""
    host, _ = host_and_path("url")
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"), F.coalesce(host, F.lit("")).alias("host"))

    def vote(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([best_path(blocks(h)) for h in batch.column(1).to_pylist()], pa.string())], ["host", "path"])

    votes = pages.select("host", "html").mapInArrow(tidy(vote), "host string, path string").filter("path is not null")
    counted = votes.groupBy("host", "path").agg(F.count("*").alias("n"))
    winners = counted.groupBy("host").agg(F.min_by("path", F.struct((-F.col("n")).alias("n"), "path")).alias("path"))

    def read(batches):
        for batch in batches:
            texts = []
            for page, path in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                found = blocks(page)
                texts.append(text_at(found, path) or text_at(found, best_path(found)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    joined = pages.join(maybe_broadcast(stage(winners, "paths")), "host", "left").select("page_id", "url", "html", "path")
    return joined.mapInArrow(tidy(read), "page_id long, url string, text string, n_chars long")


def op2_consensus_host_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
