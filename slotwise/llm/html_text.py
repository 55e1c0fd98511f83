"""Main text of web pages by consensus paths per host.

1. Each page is parsed into containers (body, main, article, section, div, table cells) and
   text blocks. A container scores the share of the page's text (links discounted) that lies in
   it. Containers inside an article don't compete: an article is one piece.
2. Every page votes for each generalised path it has (tags and classes without digits, from the
   body down) with the share that all places of the path hold, however small. Spark sums the
   votes per host and path: a path wins on a host if the pages that have it hold at least
   ``WINS`` of their text there on average, and at least ``COMMON`` of the host's pages have it. Other
   paths that so many pages have, neither around nor below a winner, are outside if their text
   repeats from page to page or is mostly links (or fewer than ``EVIDENCE`` pages show it).
   Votes leave each task already summed, so a host with a third of all pages is no hot key.
3. Each page is read again: its text is that of the blocks below the deepest winning path it
   has (all places of that path, in page order); a page without one uses its own best container.
   A winner is widened to its parent while that adds blocks that are neither outside nor mostly
   links, and further up while less than ``WINS`` of the page's text not outside is held.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments are
left out by tag, role and class name wherever they stand (a header inside an article is the
article's). Where only a part of a class name says so (``ad-free``, ``page-header``), the host's pages
decide: such a block stays if it holds ``LONG`` of the text on average (``LONG_ALONE`` with too few pages to
compare), is not mostly links and differs from page to page. Character references are decoded,
white space inside a block becomes one space, blocks are joined by one space.

Defined results: null, empty or tag-less html gives the text of what stands there (empty for
null); a null url is a host of its own; unclosed and crossing tags, cut tags and comments at the
end are tolerated; repeated pages vote each time and give equal texts; an empty table gives an
empty result; only the named columns are read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.llm.common import cut, query, table

#: Least mean share of a winning path, and least share of the host's pages that have it.
WINS, COMMON = 0.8, 0.05
#: Pages that must show a path before its texts are compared; share of distinct texts, and of link
#: characters, from which a path repeats or is mostly links; shares that make a doubtful block long.
EVIDENCE, DISTINCT, LINKS, LONG, LONG_ALONE = 3, 0.5, 0.5, 0.1, 0.2

# Element names of HTML by their part in a page.
CONTAINERS = frozenset("body main article section div td center".split())
BLOCKS = CONTAINERS | frozenset(
    "address aside blockquote caption dd details dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html li nav ol p pre summary table tbody tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math".split())
LEFT_OUT = frozenset("head nav header footer aside form button select option dialog menu label canvas object audio video".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
NOISE = frozenset(
    "nav navbar navigation menu header masthead footer sidebar aside ad ads adv advert adverts advertisement banner promo "
    "sponsor sponsored cookie cookies consent notice alert popup modal overlay newsletter subscribe subscription signup "
    "login comment comments discussion disqus reply replies respond share sharing social breadcrumb breadcrumbs "
    "related recommended widget pagination pager toolbar search copyright skip".split())
#: Part names that always mean what they say.
READERS = frozenset("comment comments discussion disqus reply replies respond".split())
#: A start tag of the key ends an open element of these names.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*?)(?:>|\Z)", re.S)
_LOOSE = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([A-Za-z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_DIGITS = re.compile(r"\d+")


IN, DOUBTFUL, OUT = 0, 1, 2


def _noise(tag: str, attrs: dict[str, str], in_article: bool) -> int:
    """Whether an element is left out: by tag, role or a whole class name; doubtful if only the
    first or last part of a name says so."""
    if tag in LEFT_OUT and not (tag == "header" and in_article):
        return OUT
    if not attrs or tag in ("body", "html", "main", "article"):
        return IN
    if attrs.get("role", "").lower() in ROLES or "hidden" in attrs or attrs.get("aria-hidden") == "true" \
            or "display:none" in attrs.get("style", "").replace(" ", "").lower():
        return OUT
    found = IN
    for name in f"{attrs.get('class', '')} {attrs.get('id', '')}".lower().split():
        parts = [p for p in re.split(r"[-_]+", name) if p]
        if name in NOISE or len(parts) == 1 and parts[0] in NOISE:
            return OUT
        if len(parts) > 1 and (parts[0] in NOISE or parts[-1] in NOISE) and parts[0] not in ("with", "has", "no", "without"):
            if parts[0] in READERS or parts[-1] in READERS or tag not in BLOCKS:
                return OUT
            found = DOUBTFUL
    return found


class Page:
    """Containers (paths, parents) and text blocks of one page, in page order."""

    def __init__(self, html: str) -> None:
        self.paths: list[str] = ["body"]
        self.parents: list[int] = [-1]
        self.doubt: list[int] = [-1]                       # the doubtful element around each container, or itself
        self.blocks: list[tuple[int, str, int]] = []       # container, text, characters inside links
        self._open: list[tuple[str, int, bool]] = []       # tag, container, left out
        self._words: list[str] = []
        self._links = 0
        self._read(html)

    def _here(self) -> tuple[int, bool]:
        return (self._open[-1][1], self._open[-1][2]) if self._open else (0, False)

    def _flush(self) -> None:
        if self._words:
            text = " ".join("".join(self._words).split())
            if text:
                self.blocks.append((self._here()[0], text, min(self._links, len(text))))
            self._words, self._links = [], 0

    def _text(self, raw: str) -> None:
        if not self._here()[1]:
            text = unescape(raw) if "&" in raw else raw
            self._words.append(text)
            if any(tag == "a" for tag, _, _ in self._open[-4:]):
                self._links += len(text.strip())

    def _close(self, names: set[str], stop: frozenset[str]) -> None:
        """End the innermost open element of these names and all inside it, unless an
        element of ``stop`` stands between."""
        for i in range(len(self._open) - 1, -1, -1):
            if self._open[i][0] in names:
                if any(tag in BLOCKS for tag, _, _ in self._open[i:]):
                    self._flush()
                del self._open[i:]
                return
            if self._open[i][0] in stop:
                return

    def _start(self, tag: str, raw: str) -> None:
        if tag in BLOCKS:
            self._flush()
            self._close({"p"}, CONTAINERS | {"table", "li", "blockquote"})
        if tag in ENDS:
            self._close(ENDS[tag], frozenset({"table", "ul", "ol", "dl", "select"}))
        if tag in VOID:
            if tag == "br" and not self._here()[1]:
                self._words.append(" ")
            return
        if tag in ("html", "body"):
            return
        attrs = {a.lower(): b or c or d for a, b, c, d in _ATTR.findall(raw)} if raw.strip(" /") else {}
        at, out = self._here()
        noise = OUT if out else _noise(tag, attrs, "/article" in self.paths[at])
        out = noise == OUT
        if not out and (tag in CONTAINERS or noise == DOUBTFUL):
            classes = sorted(_DIGITS.sub("", c) for c in attrs.get("class", "").lower().split())
            self.paths.append(self.paths[at] + "/" + ".".join([tag, *dict.fromkeys(c for c in classes if c)]))
            self.parents.append(at)
            new = len(self.paths) - 1
            self.doubt.append(self.doubt[at] if self.doubt[at] >= 0 or noise != DOUBTFUL else new)
            at = new
        if not raw.rstrip().endswith("/") or tag in BLOCKS or tag == "a":
            self._open.append((tag, at, out))

    def _read(self, html: str) -> None:
        at, size = 0, len(html)
        while at < size:
            lt = html.find("<", at)
            if lt < 0:
                self._text(html[at:])
                break
            if lt > at:
                self._text(html[at:lt])
            m = _TOKEN.match(html, lt)
            if m is None or (m.end() == size and m[2] and html[-1] != ">"):
                m = _LOOSE.match(html, lt) or m          # an attribute whose quote never ends
            if m is None:
                self._text("<")
                at = lt + 1
                continue
            at = m.end()
            if not m[2]:
                continue
            tag = m[2].lower()
            if m[1]:
                if tag in BLOCKS:
                    self._flush()
                self._close({tag}, CONTAINERS - {tag} if tag not in BLOCKS else frozenset())
            elif tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\s*(?:>|\Z)", re.I).search(html, at) \
                    if not m[3].rstrip().endswith("/") else m
                at = size if end is None else end.end()
            else:
                self._start(tag, m[3])
        self._flush()

    def weights(self) -> list[float]:
        """Characters below each container, links discounted; doubtful elements only count for
        the containers inside them."""
        weight = [0.0] * len(self.paths)
        for at, text, links in self.blocks:
            weight[at] += max(0, len(text) - 2 * links)
        for i in range(len(weight) - 1, 0, -1):             # parents come first
            if self.doubt[i] != i:
                weight[self.parents[i]] += weight[i]
        return weight

    def shares(self) -> dict[int, float]:
        """Share of the page's text below each container that competes."""
        weight = self.weights()
        inside = [False] * len(self.paths)
        for i in range(1, len(self.paths)):
            up = self.parents[i]
            inside[i] = inside[up] or self.paths[up].rsplit("/", 1)[-1].split(".")[0] == "article"
        return {i: w / weight[0] for i, w in enumerate(weight) if not inside[i] and self.doubt[i] < 0} if weight[0] else {}

    def doubtful(self) -> dict[str, float]:
        """Share of each doubtful path in the text that the page would have with it."""
        weight, out = self.weights(), defaultdict(float)
        for i, around in enumerate(self.doubt):
            if around == i:
                out[self.paths[i]] += weight[i]
        return {p: w / (weight[0] + w) for p, w in out.items() if w}

    def signs(self) -> dict[str, tuple[int, float]]:
        """Per path: a hash of all its text on the page, and the share of link characters."""
        held: dict[str, list] = {}
        for at, text, links in self.blocks:
            i, seen = at, set()
            while i >= 0:
                if self.paths[i] not in seen:
                    seen.add(self.paths[i])
                    one = held.setdefault(self.paths[i], [[], 0, 0])
                    one[0].append(text)
                    one[1] += links
                    one[2] += len(text)
                i = self.parents[i]
        return {p: (xxhash.xxh3_64_intdigest("\n".join(t)) - (1 << 63), k / n) for p, (t, k, n) in held.items()}

    def best(self) -> str:
        """The page's own choice: the deepest container with ``WINS`` of its text."""
        good = [i for i, share in self.shares().items() if share >= WINS]
        return self.paths[max(good, key=lambda i: (self.paths[i].count("/"), -i))] if good else "body"

    def below(self, paths: set[str]) -> list[bool]:
        """Whether each container is one of ``paths`` or lies in one."""
        out = [False] * len(self.paths)
        for i, p in enumerate(self.paths):
            out[i] = p in paths or (i > 0 and out[self.parents[i]])
        return out

    def text(self, path: str, outside: set[str] | None = None, kept: set[str] | None = None) -> str:
        """The blocks below ``path``; with ``outside``, widened upwards where it misses some that
        aren't there. Doubtful elements stay whose path is in ``kept``."""
        blocks = [b for b in self.blocks if self.doubt[b[0]] < 0 or self.paths[self.doubt[b[0]]] in (kept or ())]
        held, out = self.below({path}), self.below(outside or set())
        if outside is None:
            return " ".join(t for at, t, _ in blocks if held[at])
        rest = [(at, len(t) - 2 * links) for at, t, links in blocks if not held[at] and not out[at] and 2 * links < len(t)]
        enough = WINS * (sum(max(0, len(t) - 2 * links) for at, t, links in blocks if held[at]) + sum(w for _, w in rest))
        top = path
        while rest and top != "body":
            up = top.rsplit("/", 1)[0]
            wider = self.below({up})
            left = [(at, w) for at, w in rest if not wider[at]]
            have = sum(max(0, len(t) - 2 * links) for at, t, links in blocks if wider[at] and (held[at] or not out[at]))
            if len(left) == len(rest) and have >= enough:
                break
            top, rest = up, left
        wider = self.below({top})
        return " ".join(t for at, t, _ in blocks if held[at] or (wider[at] and not out[at]))


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[tuple, list[float]] = defaultdict(lambda: [0, 0.0, 0.0])

    def out() -> pa.RecordBatch:
        keys = list(sums)
        return pa.RecordBatch.from_arrays([
            *(pa.array([k[i] for k in keys], t) for i, t in enumerate((pa.string(), pa.string(), pa.bool_(), pa.int64()))),
            *(pa.array([sums[k][i] for k in keys], t) for i, t in enumerate((pa.int64(), pa.float64(), pa.float64())))],
            ["host", "path", "doubtful", "sign", "n", "share", "links"])

    for batch in batches:
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            page = Page(html or "")
            shares: dict[str, float] = defaultdict(float)      # places of one path never hold each other
            for i, share in page.shares().items():
                shares[page.paths[i]] += share
            signs = page.signs()
            for doubtful, found in ((False, shares), (True, page.doubtful())):
                for path, share in found.items():
                    # a path with most of the page's text is never outside: its text needs no sign
                    sign, links = (0, 0.0) if not doubtful and share >= WINS else signs.get(path, (0, 0.0))
                    held = sums[host, path, doubtful, sign]
                    held[0] += 1
                    held[1] += share
                    held[2] += links
        if len(sums) > 50_000:
            yield out()
            sums.clear()
    yield out()


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for html, winners, outside, kept in zip(*(batch.column(c).to_pylist() for c in ("html", "winners", "outside", "kept"))):
            page = Page(html or "")
            have, kept = set(page.paths), set(kept or ())
            path = next((w for w in winners or [] if w in have and (w != "body" or len(have) == 1)), None)
            texts.append(page.text(path, have.intersection(outside or ()), kept) if path else page.text(page.best(), None, kept))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


_VOTES = "host string, path string, doubtful boolean, sign long, n long, share double, links double"


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, winners, outside, kept): the winning paths of each host, deepest first; its common
    paths that neither hold a winner nor lie in one and are no text (outermost only); its
    doubtful paths that are text. ``pages``: host, html."""
    signed = pages.select("host", "html").mapInArrow(_vote, _VOTES).groupBy("host", "path", "doubtful", "sign") \
        .agg(F.sum("n").alias("n"), F.sum("share").alias("share"), F.sum("links").alias("links"))
    votes = signed.groupBy("host", "path", "doubtful").agg(
        F.sum("n").alias("n"), F.sum("share").alias("share"), F.sum("links").alias("links"), F.count(F.lit(1)).alias("texts"))
    votes = cut(votes, "html-votes")
    most = votes.where("NOT doubtful").groupBy("host").agg(F.max("n").alias("pages"))       # every voting page votes for its body
    empty = (F.col("links") >= LINKS * F.col("n")) | ((F.col("n") >= EVIDENCE) & (F.col("texts") <= DISTINCT * F.col("n")))
    long = F.when(F.col("n") >= EVIDENCE, LONG).otherwise(LONG_ALONE) * F.col("n") <= F.col("share")
    common = votes.alias("v").join(most.alias("m"), F.col("v.host").eqNullSafe(F.col("m.host")), "left") \
        .where(F.col("doubtful") | (F.col("n") >= COMMON * F.col("pages"))) \
        .select("v.host", "n", "path", "doubtful", (~F.col("doubtful") & (F.col("share") >= WINS * F.col("n"))).alias("wins"),
                (empty | (F.col("n") < EVIDENCE)).alias("other"), (F.col("doubtful") & long & ~empty).alias("kept"))
    w = F.struct((-F.size(F.split("path", "/"))).alias("depth"), (-F.col("n")).alias("n"), "path")
    per_host = common.groupBy("host").agg(
        F.sort_array(F.collect_list(F.when(F.col("wins"), w)))["path"].alias("winners"),
        F.collect_list(F.when(~F.col("wins") & ~F.col("doubtful") & F.col("other"), F.col("path"))).alias("others"),
        F.collect_list(F.when(F.col("kept"), F.col("path"))).alias("kept"))
    return per_host.mapInArrow(_mark, "host string, winners array<string>, outside array<string>, kept array<string>")


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        marked = []
        for winners, others in zip(batch.column("winners").to_pylist(), batch.column("others").to_pylist()):
            wins = set(winners)
            around = {w[:k] for w in wins for k, c in enumerate(w) if c == "/"}
            deep = {w for w in wins if w not in around}           # no winner below
            outside: list[str] = []
            for path in sorted(others, key=lambda p: p.count("/")):
                ups = {path[:k] for k, c in enumerate(path) if c == "/"}
                if path not in around and not ups & deep and not ups.intersection(outside):
                    outside.append(path)
            marked.append(outside)
        yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("winners"), pa.array(marked, pa.list_(pa.string())),
                                          batch.column("kept")], ["host", "winners", "outside", "kept"])


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars (code points) of every page."""
    url = F.col(url_col).cast("string")
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1))
    narrow = pages.select(F.col(id_col).cast("long").alias("page_id"), url.alias("url"),
                          F.col(html_col).cast("string").alias("html"), host.alias("host"))
    # at most 1 / COMMON times the paths of a page per host; the planner sees the real size and
    # sends the table to all tasks or splits crowded hosts at run time
    winners = cut(host_paths(narrow), "html-winners").select(F.col("host").alias("of"), "winners", "outside", "kept")
    return narrow.join(winners, narrow["host"].eqNullSafe(winners["of"]), "left") \
        .select("page_id", "url", "html", "winners", "outside", "kept") \
        .mapInArrow(_extract, "page_id long, url string, text string, n_chars long")


@query("op2_html_text")
def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))
