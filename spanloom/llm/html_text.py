"""Main text of web pages by the maximum-scoring subsequence.

A page is a sequence of words and tags. Words score positive and tags negative,
by log odds of standing in an article, counted on pages whose markup names
their article. A linear scan finds the contiguous region with the best sum;
blocks of the region that menus, notices, adverts, forms or comments hold are
left out.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled pages that the weights are counted on at most: those of the smallest hash of page_id.
SAMPLE = 1000

_PIECE = re.compile(
    r"<!---?>|<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(?P<raw>script|style|noscript|iframe|textarea|title)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[/!?](?![a-zA-Z])[^>]*(?:>|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<loose>/?)(?P<bare>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|[^<]+|<",
    re.S | re.I,
)
_COMMENT_OR_TAG = re.compile(
    r"<!---?>|<!--.*?(?:--!?>|\Z)|<(?P<raw>script|style)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_PARTS = re.compile(r"[^a-z]+|(?<=[a-z])(?=[A-Z])")
# HTML element names.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby rt rp s samp small span strike strong sub sup time tt u var wbr".split())
_DROPPED = set("nav footer aside form button menu dialog head".split())
# Parts of class, id and role names that stand for what isn't main text.
_NOISE = set("ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice popup modal overlay newsletter subscribe subscription paywall sidebar nav navbar navigation menu breadcrumb breadcrumbs comment comments disqus respond replies share sharing social related recommended login signup search pagination pager toolbar widget complementary contentinfo".split())
_OUTER_NOISE = set("header masthead footer topbar bottombar".split())
# Parts of class and id names that tell a state of the element, or of what lies beside it: no-sidebar, with-nav, comments-open.
_STATE = set("no not non without with has have hide is open opened closed enabled disabled on off layout".split())
# Parts of class and id names that tell what kind of box an element is, and nothing of what it holds.
_BOX = set("bar block body box button buttons column container content count footer form group header heading holder icon icons inner item items left link links list main module outer page panel post posts right row section site slot top bottom title unit wrap wrapper".split())
# Elements of running text, which a box of menus or adverts seldom is.
_TEXTUAL = set("p h1 h2 h3 h4 h5 h6 blockquote pre table tbody tr td th dl dt dd figure figcaption span b i em strong".split())
# Elements whose content is cut, and those that an unclosed one of them, or a drawing, can't hold.
_CUT = set("svg math object template select".split())
_FOREIGN = set("foreignobject annotation-xml".split())
_BLOCKS = set("address article aside blockquote body center dd details div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table tbody td th tr ul".split())
_KEPT = set("html body article main".split())
# By HTML, what an opening tag ends that is still open, and the elements past which it doesn't look for that.
_ENDS = {name: set(ended.split()) for names, ended in (("li", "li"), ("dt dd", "dt dd"), ("td th", "td th"), ("tr", "td th tr"), ("tbody thead tfoot", "td th tr tbody thead tfoot"), ("option", "option"), ("optgroup", "option optgroup"), ("body", "head")) for name in names.split()}
_SCOPES = {name: set(scope.split()) for names, scope in (("li", "ul ol menu dir"), ("dt dd", "dl"), ("td th tr tbody thead tfoot", "table"), ("option optgroup", "select datalist")) for name in names.split()}
_P_SCOPE = set("table caption td th button object".split())
_TABLE = set("table caption colgroup thead tbody tfoot tr td th".split())


def pieces(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, text): ``text`` with its characters decoded, ``open`` and ``close`` with attributes; comments, scripts and styles are gone."""
    at = 0
    while m := _PIECE.match(page, at):
        at = m.end()
        name = m["name"] or m["bare"]
        if name and not (m["close"] or m["loose"]) and name.lower() in _CUT:
            at = _end_of_cut(page, m)
            yield "cut", name.lower(), ""
        elif name:
            yield ("close" if (m["close"] or m["loose"]) else "open"), name.lower(), m["attrs"] or ""
        elif m["raw"]:
            yield "cut", m["raw"].lower(), ""
        elif m[0][0] != "<" or len(m[0]) == 1:
            yield "text", "", html.unescape(m[0]) if "&" in m[0] else m[0]


def _end_of_cut(page: str, opened: re.Match) -> int:
    """Where a drawing or an object ends that ``opened`` starts: after its close tag, or at the next block tag if it isn't closed."""
    name = (opened["name"] or opened["bare"]).lower()
    drawn = name in ("svg", "math")
    if drawn and opened[0].endswith("/>"):
        return opened.end()
    depth, inner, block = 1, 0, None
    for m in _COMMENT_OR_TAG.finditer(page, opened.end()):
        other, close = (m["name"] or "").lower(), bool(m["close"])
        alone = m[0].endswith("/>")
        if other == name:
            depth += -1 if close else 0 if drawn and alone else 1
            if depth == 0:
                return m.end()
        elif drawn and other in _FOREIGN:
            inner = max(0, inner + (-1 if close else 0 if alone else 1))
        elif other in _BLOCKS:
            block = m.start() if block is None else block
            if (drawn and not inner) or (other in ("body", "article", "main") and not inner and name != "template"):
                return block  # a drawing holds no blocks of its own
    return len(page) if block is None else block


def noisy(name: str, attrs: str, inside: bool) -> bool:
    """Whether the element holds no main text; headers and footers of an article's own are judged by ``inside``.

    A class, id or role names it. Inside an article, and for elements of running
    text, the whole name must speak of menus, adverts or the like: share-buttons
    does, share-price doesn't. Elsewhere a part of it is enough.
    """
    if name in _KEPT:
        return False
    if name in _DROPPED or (name == "header" and not inside):
        return True
    if not attrs:
        return False
    given: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(attrs):
        given.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    if "hidden" in given or given.get("aria-hidden", "").strip().lower() == "true" or _UNSEEN.search(given.get("style", "")):
        return True
    strict = inside or name in _TEXTUAL
    labels = ("class", "role") if name in _TEXTUAL else ("class", "id", "role", "aria-label")  # a heading's or paragraph's id is an anchor
    named = [{w.lower() for w in _PARTS.split(v) if w} for label in labels for v in given.get(label, "").split()]
    named = [parts for parts in named if not parts & _STATE and not (strict and parts - _NOISE - _BOX - _OUTER_NOISE)]
    words = {w for parts in named for w in parts}
    return bool(words & _NOISE) or (not inside and bool(words & _OUTER_NOISE))


def wrappers(steps: list[tuple[str, str, str]]) -> set[int]:
    """Places of the form tags that wrap a page's content: an article or main element, or over half of its words in paragraphs."""
    out, opened, holds, words, block, total = set(), None, False, 0, "", 0

    def judged() -> None:
        if opened is not None:
            found.append((opened, holds, words))

    found: list[tuple[int, bool, int]] = []
    for i, (kind, name, more) in enumerate(steps):
        if kind == "text":
            n = len(more.split())
            total += n
            words += n if block == "p" else 0
        elif kind == "open" and name == "form" and opened is None:  # forms don't nest
            opened, holds, words = i, False, 0
        elif kind == "close" and name == "form":
            judged()
            opened = None
        elif kind != "cut" and name not in _INLINE and name != "br":
            block = name if kind == "open" else ""
            holds = holds or (kind == "open" and name in ("article", "main"))
    judged()
    for i, whole, n in found:
        if whole or 2 * n > total:
            out.add(i)
    return out


class _Open:
    """The elements that are open at a place of a page, without those of running text, and the places of each name."""

    def __init__(self) -> None:
        self.names: list[str] = []
        self.places: dict[str, list[int]] = {}

    def begin(self, name: str) -> None:
        """An opening tag ends what HTML lets it end: a list's item the item before, a block the paragraph before."""
        if name in _ENDS:
            self._cut(_ENDS[name], _SCOPES.get(name, set()), 0)
        if name in _BLOCKS:
            self._cut({"p"}, _P_SCOPE, 0)
        self.places.setdefault(name, []).append(len(self.names))
        self.names.append(name)

    def end(self, name: str) -> None:
        """A closing tag ends its element and all that is open in it; from a table's cell it doesn't reach beyond the table's parts."""
        self._cut({name}, set() if name in _TABLE else _TABLE, -1)

    def _cut(self, names: set[str], scope: set[str], which: int) -> None:
        """Ends the first or last open element of the names behind the last one of the scope."""
        found = [at for name in names for at in (self.places.get(name) or ())[which:][:1]] if not scope else []
        if scope:
            limit = max((self.places[s][-1] for s in scope if self.places.get(s)), default=-1)
            for name in names:
                at = self.places.get(name)
                if at and at[-1] > limit:
                    found.append(at[-1] if which else at[bisect_right(at, limit)])
        if found:
            for name in reversed(self.names[min(found) :]):
                self.places[name].pop()
            del self.names[min(found) :]


def walk(page: str) -> Iterator[tuple[str, str, bool, bool, str]]:
    """(feature kind, name, in an article, left out, text) for each tag and text of a page, in order."""
    inside, block, links = 0, "", 0
    opened = _Open()
    drop, depth, level = "", 0, 0  # the element that is left out; how often an inline one is open; how many elements hold it
    steps = list(pieces(page))
    kept = wrappers(steps) if any(name == "form" for _, name, _ in steps) else set()
    for i, (kind, name, more) in enumerate(steps):
        if kind == "text":
            if more:
                yield "word", "a" if links else block, inside > 0, bool(drop), more
            continue
        if kind == "cut":
            yield "tag", name, inside > 0, bool(drop), ""
            continue
        if name in ("article", "main"):
            inside = max(0, inside + (1 if kind == "open" else -1))
            if drop and kind == "open":
                drop = ""  # a menu that was never closed ends here
        was = bool(drop)
        structural = name not in _INLINE and name not in _VOID
        if structural:
            opened.begin(name) if kind == "open" else opened.end(name)
        if drop:
            if drop in _INLINE:
                depth += (1 if kind == "open" else -1) if name == drop else 0
                ended = depth <= 0 or len(opened.names) < level
            else:
                ended = len(opened.names) - (structural and kind == "open") < level
            if ended:
                drop = ""
        if was and not drop and kind == "close":
            yield "tag", name, inside > 0, True, ""
            continue
        if not drop and kind == "open" and name not in _VOID and i not in kept and noisy(name, more, inside > 0):
            drop, depth, level = name, 1, len(opened.names)
        if name == "a":
            links = 1 if kind == "open" else 0
        elif name not in _INLINE and name not in ("br",):
            block = name if kind == "open" else ""
        yield "tag", name, inside > 0, bool(drop), ""


def _name(kind: str, name: str, inside: bool, marked: bool) -> str:
    """The feature of a word or tag; in pages that mark their article it says whether it stands inside."""
    return f"{kind}:{name}" + (":in" if inside else ":out") * marked


def weights(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Log odds of features from counts of (feature, in an article): at least 0.2 for words of articles and at most -0.01 for tags."""
    total = {side: sum(n for (_, s), n in counts.items() if s == side) + 1.0 for side in (True, False)}
    out = {}
    for feature in {f for f, _ in counts}:
        odds = log((counts.get((feature, True), 0) + 0.5) / total[True]) - log((counts.get((feature, False), 0) + 0.5) / total[False])
        odds = max(-6.0, min(3.0, odds))
        out[feature] = min(odds, -0.01) if feature.startswith("tag:") else max(odds, 0.2) if odds > 0 or feature.endswith(":in") else odds
    return out


def feature_counts(page: str | None) -> Counter:
    """Counts of (feature, in an article) of a page that marks its article, with and without the mark in the feature."""
    steps = list(walk(page or ""))
    if not any(inside for _, _, inside, _, _ in steps):
        return Counter()
    out: Counter = Counter()
    for kind, name, inside, left, text in steps:
        n = len(text.split()) if kind == "word" else 1
        content = inside and not left
        for marked in (True, False):
            out[_name(kind, name, inside, marked), content] += n
    return out


def best_region(scores: Iterable[float]) -> tuple[int, int]:
    """Start and stop of the contiguous part with the greatest sum, in one scan: the longest of equal ones that end last, empty if no sum is positive."""
    best = score = 0.0
    start = at = stop = 0
    for i, x in enumerate(scores):
        score += x
        if score <= 0:
            score, at = 0.0, i + 1
        elif score >= best:
            best, start, stop = score, at, i + 1
    return start, stop


def step_scores(steps: list[tuple[str, str, bool, bool, str]], weight: dict[str, float]) -> Iterator[float]:
    """A tag's weight, or that of a word of its kind times the words of a text."""
    marked = any(inside for _, _, inside, _, _ in steps)
    for kind, name, inside, left, text in steps:
        many = len(text.split()) if kind == "word" else 1
        if not many or (left and inside):  # what an article holds but isn't its text doesn't part it
            yield 0.0
        elif kind == "word" and left:
            yield -0.5 * many
        else:
            yield many * weight.get(_name(kind, name, inside, marked), -0.05 if kind == "tag" else 1.0)


def main_text(page: str | None, weight: dict[str, float]) -> str:
    """The blocks of the best region, each with single spaces, joined by line breaks.

    If the region holds parts of articles, what stands between two articles is
    left out.
    """
    steps = list(walk(page or ""))
    start, stop = best_region(step_scores(steps, weight))
    in_article = any(inside and kind == "word" and text.strip() for kind, _, inside, _, text in steps[start:stop])
    blocks, held = [], []
    for kind, name, inside, left, text in steps[start:stop]:
        if kind == "word":
            if not left and (inside or not in_article):
                held.append(text)
        elif name not in _INLINE:
            blocks.append(" ".join("".join(held).split()))
            held = []
    blocks.append(" ".join("".join(held).split()))
    return "\n".join(b for b in blocks if b)


def fit_weights(pages: DataFrame, sample: int = SAMPLE) -> dict[str, float]:
    """Weights from ``sample`` pages at most that have an article or main element; they are picked by id, and then read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for page in batch.column(0):
                total.update(feature_counts(page.as_py()))
        if total:
            yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in total]), pa.array([s for _, s in total]), pa.array(list(total.values()), pa.int64())], names=["feature", "inside", "n"])

    labelled = pages.filter(F.col("html").rlike("(?i)<(?:article|main)[\\s>]"))
    named = labelled.select("page_id", F.xxhash64("page_id").alias("h"), F.xxhash64("html").alias("body"))
    ids = named.orderBy("h", "page_id", "body").limit(sample).select(F.col("page_id").alias("picked_id"), "body").distinct()
    picked = labelled.join(F.broadcast(ids), F.col("page_id").eqNullSafe(F.col("picked_id")) & (F.xxhash64("html") == F.col("body")), "left_semi").select("html")
    rows = picked.mapInArrow(run, "feature string, inside boolean, n long").groupBy("feature", "inside").agg(F.sum("n").alias("n")).collect()
    return weights({(r["feature"], r["inside"]): r["n"] for r in rows})


def extract(pages: DataFrame, weight: dict[str, float] | None = None) -> DataFrame:
    """page_id, url, text string, n_chars long for every row of ``pages``, from the whole html.

    Null or empty html, or a page without main text: an empty text. Repeated
    rows, null ids and urls are returned as they are. Further columns are
    dropped. Without labelled pages fixed usual weights hold.
    """
    weight = fit_weights(pages) if weight is None else weight

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py(), weight) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    chosen = pages.select("page_id", "url", "html")
    schema = pages.select("page_id", "url").schema.add("text", "string")
    return chosen.mapInArrow(run, schema).withColumn("n_chars", F.length("text").cast("long"))
