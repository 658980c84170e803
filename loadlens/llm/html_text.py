"""HTML extraction with removal of site templates.

Each page is parsed once into its text runs; a run carries the hashes of the
element subtrees that it lies in.  Parts that are never article text (menus,
headers, footers, forms, scripts ...) are left out by element, role and class.
Spark counts in how many different pages of a host each subtree hash occurs; runs inside
a subtree that recurs across most pages of a small host, or many pages of a large
one, are site template and go.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import checkpointed, written

TEMPLATE_SHARE = 0.7        # share of a host's pages that a template subtree occurs in
TEMPLATE_PAGES = 8          # and at least so many pages
MANY_PAGES = 20             # a subtree in so many pages is template from a lower share on:
MANY_SHARE = 0.2            # sections of a site; an article's own lines recur in up to 0.09 of a host's pages in the given tables
MAX_BROADCAST = 200_000     # template hashes (16 bytes each) broadcast at most

#: HTML's elements without content, with raw text, and of block kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
BLOCK = frozenset("""address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul""".split())
CLOSES_P = BLOCK - frozenset("br body html td th tr tbody thead tfoot option li dd dt legend summary figcaption".split())
#: Start tags that end an open element of their kind, up to the given container.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "thead": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
        "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"})}
#: Elements, roles and class or id words that are not article text.
DROP_TAGS = frozenset("nav header footer aside form button select menu dialog svg canvas object audio video map datalist".split()) | RAW
DROP_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar note status".split())
DROP_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist consent
cookie cookies disclaimer disqus footer header hidden login masthead menu modal nav navbar navigation newsletter notice notices overlay pager pagination
popup promo promos promotion related reply replies respond responses share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget""".split())
KEEP_TAGS = frozenset(["html", "body", "article", "main"])   # never template themselves

_TAG = re.compile(r"<!--(?:>|->|.*?(?:-->|--!>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                  r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|</[^a-zA-Z][^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)|(?=[\s/]|$))", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW}
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


HARD, SOFT = 2, 1
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
OF_ARTICLE = "header"       # dropped as the header of an article: its headings stay


def dropped(tag: str, attributes: str) -> int:
    """An element that is no article text: ``HARD`` by its kind or role, ``SOFT`` by a
    word of its class or id (a wrapper of the article may have such a word)."""
    if tag in DROP_TAGS:
        return HARD
    if tag in KEEP_TAGS and tag != "article" or not attributes or attributes.isspace():
        return 0
    found = 0
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or "").strip("\"'")
        if name in ("class", "id") and not DROP_WORDS.isdisjoint(w.lower() for w in _WORD.findall(value)):
            found = SOFT
        if name == "role" and value.lower() in DROP_ROLES or name == "hidden" or name == "aria-hidden" and value.lower() == "true" \
                or name == "style" and _HIDDEN.search(value):
            return HARD
    return found


class Page:
    """Text runs of a page: level (2 article, 1 main, 0 elsewhere), text, the
    hashes of the subtrees around it, the softly dropped elements around its
    article or main part and inside that, and the number of the outermost
    softly dropped element inside it."""

    def __init__(self, html: str):
        self.runs: list[tuple[int, str, tuple[int, ...], int, int, int]] = []
        self.hashes: list[int] = []
        # open elements: tag, hash so far, dropped, level, path of element numbers, number, soft ones outside, inside, first one inside, itself soft
        self.open: list[list] = [["", xxhash.xxh3_64(), False, 0, (), -1, 0, 0, -1, False]]
        at, n, skip_to = 0, len(html), _TAG.search
        while at < n:
            m = skip_to(html, at)
            if m is None:
                self._text(html[at:])
                break
            if m.start() > at:
                self._text(html[at:m.start()])
            at = m.end()
            tag = (m[2] or m[5] or "").lower()
            if not tag:
                continue
            if m[1] or m[4]:
                self._end(tag)
                continue
            self._start(tag, m[3] or m[6] or "")
            if tag in RAW:
                end = _RAW_END[tag].search(html, at)
                at = end.start() if end else n
                self._end(tag) if end is None else None
        while len(self.open) > 1:
            self._close()

    def _text(self, raw: str) -> None:
        top = self.open[-1]
        if top[2]:
            return
        text = unescape(raw) if "&" in raw else raw
        if text and (not text.isspace() or self.runs):
            top[1].update(" ".join(text.split()).encode("utf-8", "surrogatepass") + b"\1")
            self.runs.append((top[3], text, top[4], *top[6:9]))

    def _break(self) -> None:
        if self.runs and self.runs[-1][1] != " ":
            self.runs.append((self.open[-1][3], " ", self.open[-1][4], *self.open[-1][6:9]))

    def _start(self, tag: str, attributes: str) -> None:
        if tag in CLOSES_P:
            self._end_open({"p"}, {"button", "td", "th", "table", "li", "body", "article", "section", "div"} - {tag} if tag == "p" else {"button", "td", "th", "table"})
        if tag in ENDS:
            self._end_open(*ENDS[tag])
        if tag in BLOCK:
            self._break()
        if tag in VOID or attributes.endswith("/") and tag in VOID:
            return
        top = self.open[-1]
        level = max(top[3], 2 if tag == "article" else 1 if tag == "main" or "role" in attributes and re.search(r"role\s*=\s*[\"']?main\b", attributes) else 0)
        own = dropped(tag, attributes)
        drop, soft = top[2] or own == HARD, own == SOFT
        if tag == "header" and top[3] == 2 and not top[2] and dropped("div", attributes) != HARD:
            drop = OF_ARTICLE
        elif top[2] == OF_ARTICLE:
            drop = own == HARD or tag not in HEADINGS and OF_ARTICLE
        outside, inside, first = top[6], top[7] + soft, len(self.hashes) if soft and not top[7] else top[8]
        if level > top[3]:   # an article or main part: the soft ones are around it
            outside, inside, first = outside + inside, 0, -1
        path = top[4]
        if not drop and tag not in KEEP_TAGS:
            path = (*path, len(self.hashes))
        self.open.append([tag, xxhash.xxh3_64(tag.encode("utf-8", "surrogatepass") + b"\0"), drop, level, path, len(self.hashes), outside, inside, first, soft])
        self.hashes.append(0)

    def _end_open(self, kinds: set[str], stop: set[str]) -> None:
        """Close the nearest open element of ``kinds`` that lies inside no ``stop``."""
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] in kinds:
                while len(self.open) > i:
                    self._close()
                if len(kinds) == 1:
                    return
            elif self.open[i][0] in stop:
                return

    def _end(self, tag: str) -> None:
        if tag in BLOCK:
            self._break()
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] == tag:
                while len(self.open) > i:
                    self._close()
                return

    def _close(self) -> None:
        tag, digest, drop, _, _, number, *_, soft = self.open.pop()
        h = digest.intdigest() - (1 << 63)
        self.hashes[number] = h
        if self.open[-1][2] is not True:
            self.open[-1][1].update(tag.encode("utf-8", "surrogatepass") + b"\2" if soft else h.to_bytes(8, "little", signed=True))
        if tag in BLOCK and not drop:
            self._break()

    def main_runs(self) -> list[tuple[str, tuple[int, ...]]]:
        """Runs of the articles; without any the main part's; else all.

        Softly dropped elements are left out, but not one around the articles
        or the main part, unless more text lies outside it; nor, on pages
        without these, one that holds most of the text."""
        size = [0 if r[1].isspace() else len(r[1]) for r in self.runs]
        base, lifted = [], []
        for level in (2, 1, 0):
            plain = [i for i, r in enumerate(self.runs) if r[0] >= level and not r[3] and not r[4]]
            if any(size[i] for i in plain):
                base = plain
                break
        else:
            level = 0
        if level < 2:
            for above in range(2, 0, -1):
                within = [i for i, r in enumerate(self.runs) if r[0] >= above and r[3] and not r[4] and size[i]]
                if within:
                    least = min(self.runs[i][3] for i in within)
                    lifted = [i for i, r in enumerate(self.runs) if r[0] >= above and r[3] == least and not r[4]]
                    break
            if sum(size[i] for i in lifted) > sum(size[i] for i in base):
                base = lifted
            elif level == 0 and not lifted:
                held: dict[int, int] = {}
                for r, n in zip(self.runs, size):
                    if r[4] == 1:
                        held[r[5]] = held.get(r[5], 0) + n
                most = max(held, key=held.get, default=None)
                if most is not None and 2 * held[most] > sum(size):
                    base = [i for i, r in enumerate(self.runs) if not r[4] or r[4] == 1 and r[5] == most]
        return [(self.runs[i][1], tuple(self.hashes[k] for k in self.runs[i][2])) for i in base] if any(size[i] for i in base) else []


def _parse():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("text", pa.string()), ("path", pa.list_(pa.int64()))]))
        for b in batches:
            for s in range(0, b.num_rows, 1000):
                part = b.slice(s, 1000)
                runs = [[{"text": t.encode("utf-8", "replace").decode(), "path": list(p)} for t, p in Page(x or "").main_runs()] for x in part.column(1).to_pylist()]
                page = [xxhash.xxh3_64_intdigest(" ".join("".join(r["text"] for r in x).split())) - (1 << 63) for x in runs]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(runs, kind), pa.array(page, pa.int64()), *part.columns[2:]],
                                                 names=["row", "runs", "page", *part.schema.names[2:]])
    return run


def host_of(url: str = "url"):
    """Host of an address in lower case; null where it has none."""
    host = F.lower(F.regexp_extract(F.col(url), r"(?i)^\s*(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def _join(kept):
    text = F.concat_ws("", F.transform(kept, lambda r: r["text"]))
    return F.trim(F.regexp_replace(text, r"(?U)[\s\u001c-\u001f]+", " "))


def extract_text(pages: DataFrame, share: float = TEMPLATE_SHARE, least_pages: int = TEMPLATE_PAGES,
                 many_pages: int = MANY_PAGES, many_share: float = MANY_SHARE) -> DataFrame:
    """One row per row of ``pages``: ``page_id, url, text, n_chars``.

    Null and empty html gives the empty text.  Broken mark-up is read as
    browsers do: open elements end with their parents, a lone ``<`` is text.
    Pages without an article or main part give all text outside the dropped
    parts.  Of a ``header`` inside an article the headings stay.  A subtree is template if it occurs in at least ``share`` of its
    host's pages and in ``least_pages`` pages, or in ``many_share`` of them and in
    ``many_pages`` pages; pages without a host have no template.  Repeated rows stay; pages of one host and the same main text count
    as one, so copies of an article do not make its own parts a template.  Only page_id, url and
    html are read; an empty table gives an empty result."""
    rows = pages.select(F.monotonically_increasing_id().alias("row"), "html", "page_id", "url", host_of("url").alias("host"))
    id_type, url_type = (dict(pages.dtypes)[c] for c in ("page_id", "url"))
    parsed = written(rows.mapInArrow(_parse(), f"row bigint, runs array<struct<text: string, path: array<bigint>>>, page bigint, page_id {id_type}, url {url_type}, host string"), "html-runs")
    known = parsed.where("host is not null")
    sizes = known.groupBy("host", "page").agg(F.lit(1)).groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    seen = known.select("host", "page", F.explode(F.array_distinct(F.flatten("runs.path"))).alias("h")).groupBy("host", "h", "page").agg(F.lit(1))\
        .groupBy("host", "h").agg(F.count(F.lit(1)).alias("n"))\
        .where(F.col("n") >= least_pages)
    template = checkpointed(seen.join(sizes, "host").where(
        (F.col("n") >= share * F.col("pages")) | (F.col("n") >= many_pages) & (F.col("n") >= many_share * F.col("pages"))).groupBy("host").agg(F.collect_set("h").alias("gone")))
    # a host has at most (subtrees of a page) / (the lower share) template hashes
    total = template.agg(F.coalesce(F.sum(F.size("gone")), F.lit(0))).first()[0]
    marked = parsed.join(F.broadcast(template) if total <= MAX_BROADCAST else template, "host", "left")
    kept = F.when(F.col("gone").isNull(), F.col("runs")).otherwise(F.filter("runs", lambda r: ~F.arrays_overlap(r["path"], F.col("gone"))))
    return marked.select("page_id", "url", _join(kept).alias("text")).withColumn("n_chars", F.length("text").cast("bigint"))
