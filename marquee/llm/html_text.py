"""Main text of web pages by structure and the runs of words that a host repeats.

A page is read into blocks of text. Elements end as HTML has it: ``p``, ``li``, ``dt``, ``dd``, cells, rows and options without end tags at what
follows them, everything else at its end tag or that of an element around it. What stands in menus, headers, footers, sidebars, dialogs, form
controls, scripts, styles, or in elements whose class, id or role names a notice, an advert or comments is apparatus. Apparatus whose own end tag is missing
ends at the next paragraph, heading, section or the like. ``article`` and ``main`` hold content. A form around one of them is only a frame. The ``header`` of
an article is a header and goes with its heading. Inside content a name is apparatus only if all its parts say so: ``share-buttons``, not ``share-price``.

The words of a page's blocks are a stream; blocks of fewer than ``RUN`` words are put together with their neighbours. Each run of ``RUN`` words is a
suffix cut to that depth; the smallest of every ``WINDOW`` neighbouring runs, by hash, stands for them, so that equal stretches give equal runs
whatever surrounds them. A shuffle counts the distinct pages of each (host, run). Template is what more than half of a host's pages, and at
least three, have; a block goes when more than half of its runs are template. Equal pages count once. So do near copies: pages that consist of
template to four fifths or more are counted again as one page. An article that most pages of a host repeat is therefore content, and what two
pages quote from one another too. Nothing depends on how many pages a host has otherwise.

On pages with content, blocks outside of it go as well. Character references are decoded, white space in a block is one space, and blocks are joined
by one space in page order. NULL and empty html give an empty text. Rows that repeat a page are counted once and each give a row. Pages with NULL or odd
urls are one host. Columns beyond ``page_id``, ``url`` and ``html`` are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import WordHashes, shingles, slices, starts_of
from marquee.session import staged

RUN = 8
WINDOW = 8
#: Fewer pages cannot tell a template from a quotation.
LEAST_PAGES = 3
#: A page that is template to this share is a near copy.
COPY = 0.8

# Element names by their role.
RAW = ("script", "style", "noscript", "template", "svg", "iframe", "textarea", "select", "title")
APPARATUS = frozenset("nav header footer aside form button menu dialog head".split())
CONTENT = ("article", "main")
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark math q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose start ends an open paragraph, or apparatus that lacks its end tag.
BREAKS = frozenset(
    """
    address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p
    pre section table ul
    """.split()
)
RESUMES = frozenset("p h1 h2 h3 h4 h5 h6 section div article main table blockquote pre figure hr".split())
# For elements with optional end tags, those of their kind that their start ends, and where the search for one stops.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
}
OPTIONAL_END = frozenset({*SIBLINGS, "p"})
# An end tag does not reach out of these, but for the parts of a table that stop at the table.
SCOPES = frozenset("table td th caption object".split())
STOP_INLINE = BREAKS | SCOPES | SIBLINGS.keys()
# Words of class, id and role that name apparatus.
HINTS = frozenset(
    """
    ad ads advert adverts advertisement advertising adsense sponsored sponsor promo promotion banner sidebar side-bar aside menu menubar nav navbar navigation
    navigational breadcrumb breadcrumbs header masthead footer foot cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter
    subscribe subscription signup sign-up login comment comments commentlist disqus respond reply replies discussion share sharing social related recommended
    recommendations widget toolbar pagination pager skip-link contentinfo complementary search searchform form
    """.split()
)
# Words that name a place or a shape beside such a word, and words that as an id inside content are more likely a heading's anchor.
LAYOUT = frozenset(
    """
    area bar block body bottom box button buttons container content desktop entry fixed footer group icon icons inline inner item items left link links list
    main mobile outer page panel placeholder post posts primary reader right row secondary section side site slot small sticky text top unit user wrap wrapper
    """.split()
)
ANCHORS = frozenset("ad ads alert consent discussion foot header notice notices promotion related reply respond search share social subscription".split())
# First parts of names that tell of a layout, not of what an element is.
ABOUT = ("has", "with", "no", "without", "is")

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + r")\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<tag2>[a-zA-Z][a-zA-Z0-9:-]*)[^>]*>"
    r"|<[!?/][^>]*(?:>|\Z)|</?[a-zA-Z][^>]*\Z|(?P<text>[^<]+|<)",
    re.S | re.I,
)
ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)


def _hinted(tag: str, attrs: str, inside: bool) -> bool:
    """Whether class, id or role name apparatus: a whole name, or a part of one (``cookie-notice``, not ``has-sidebar``); inside content and on
    content elements all parts must be of apparatus or layout."""
    if "=" not in attrs and "hidden" not in attrs.lower():
        return False
    for found in ATTR.finditer(attrs):
        anchor = inside and found[1].lower() == "id"
        for name in (found[2] or found[3] or found[4] or "").lower().split():
            if name in HINTS:
                if not (anchor and name in ANCHORS):
                    return True
                continue
            parts = re.split(r"[-_]+", name)
            if tag in CONTENT or parts[0] in ABOUT or HINTS.isdisjoint(parts):
                continue
            if not inside or all(p in HINTS or p in LAYOUT or p.isdigit() for p in parts):
                return True
    return bool(HIDDEN.search(attrs))


class _Open:
    """The open elements of a page, outermost first, as (name, serial number)."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, int]] = []
        self.counts: dict[str, int] = {}

    def push(self, tag: str, serial: int) -> None:
        self.stack.append((tag, serial))
        self.counts[tag] = self.counts.get(tag, 0) + 1

    def cut(self, at: int) -> list[tuple[str, int]]:
        gone = self.stack[at:]
        del self.stack[at:]
        for tag, _ in gone:
            self.counts[tag] -= 1
        return gone

    def innermost(self, names, stops) -> int | None:
        """Place of the innermost element among ``names`` that no element among ``stops`` hides."""
        for name in names:
            if self.counts.get(name):
                break
        else:
            return None
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] in names:
                return i
            if self.stack[i][0] in stops:
                return None
        return None

    def before(self, tag: str) -> list[tuple[str, int]]:
        """What the start of ``tag`` ends."""
        gone: list[tuple[str, int]] = []
        if tag in INLINE:
            return gone
        if tag in BREAKS and self.counts.get("p") and (at := self.innermost({"p"}, SCOPES | {"button"})) is not None:
            gone += self.cut(at)
        if tag in SIBLINGS and (at := self.innermost(*SIBLINGS[tag])) is not None:
            # An outer row or group ends at its own kind even where cells are still open.
            while at > 0 and self.stack[at - 1][0] in SIBLINGS[tag][0]:
                at -= 1
            gone += self.cut(at)
        return gone

    def closed(self, tag: str) -> list[tuple[str, int]]:
        """What the end tag of ``tag`` ends, ``tag`` itself first; nothing where none is open."""
        if self.stack and self.stack[-1][0] == tag:
            self.counts[tag] -= 1
            return [self.stack.pop()]
        if not self.counts.get(tag):
            return []
        if tag in INLINE:
            stops = STOP_INLINE
        elif tag in SIBLINGS:
            stops = SIBLINGS[tag][1] - {"tr"}
        else:
            stops = frozenset() if tag == "table" else SCOPES - {tag}
        at = self.innermost({tag}, stops)
        return [] if at is None else self.cut(at)


def _tags(page: str) -> Iterator[tuple[str, bool, str, str]]:
    """(name, whether an end tag, attributes, text) of each tag, or of a piece of text with an empty name."""
    for m in TOKEN.finditer(page):
        if (text := m["text"]) is not None:
            yield "", False, "", text
        elif tag := (m["tag"] or m["tag2"] or "").lower():
            if tag not in ("html", "body"):  # they end with the page, whatever it says
                yield tag, bool(m["close"] or m["close2"]), m["attrs"] or "", ""


def _unclosed(tags: list[tuple[str, bool, str, str]]) -> set[int]:
    """Serial numbers of the elements that need an end tag and have none."""
    open_, out = _Open(), set()

    def lost(gone: list[tuple[str, int]]) -> None:
        out.update(n for tag, n in gone if tag not in OPTIONAL_END)

    for n, (tag, close, attrs, _) in enumerate(tags):
        if not tag or tag in VOID:
            continue
        if close:
            lost(open_.closed(tag)[1:])
            continue
        lost(open_.before(tag))
        if not attrs.endswith("/"):
            open_.push(tag, n)
    lost(open_.stack)
    return out


def blocks_of(page: str | None) -> tuple[list[str], list[bool]]:
    """Texts of the blocks that are not apparatus, and whether each stands in ``article`` or ``main``."""
    texts: list[str] = []
    inside: list[bool] = []
    piece: list[str] = []
    tags = list(_tags(page or ""))
    loose = _unclosed(tags)
    open_ = _Open()
    content: set[int] = set()  # open article and main elements
    skipped: set[int] = set()  # open apparatus

    def end() -> None:
        if piece:
            text = " ".join(entities.unescape("".join(piece)).split())
            if text:
                texts.append(text)
                inside.append(bool(content))
            piece.clear()

    def leave(gone: list[tuple[str, int]]) -> None:
        for name, _ in gone:
            if name not in INLINE:
                end()
                break
        for _, n in gone:
            content.discard(n)
            skipped.discard(n)

    for n, (tag, close, attrs, text) in enumerate(tags):
        if not tag:
            if not skipped:
                piece.append(text)
            continue
        if close:
            leave(open_.closed(tag))
            if tag not in INLINE:
                end()
            continue
        leave(open_.before(tag))
        if skipped and tag in RESUMES:
            skipped -= loose
        if tag not in INLINE:
            end()
        hinted = _hinted(tag, attrs, bool(content))
        if tag in CONTENT and not hinted and skipped and not content:
            forms = {serial for name, serial in open_.stack if name == "form"}
            if skipped <= forms:
                skipped -= forms
        if tag in VOID or attrs.endswith("/"):
            continue
        open_.push(tag, n)
        if tag in APPARATUS or hinted:
            skipped.add(n)
        elif tag in CONTENT and not skipped:
            content.add(n)
    end()
    return texts, inside


def _hashes(pages: list[list[str]], memo: WordHashes) -> tuple[list[np.ndarray], list[list[int]], np.ndarray]:
    """Chosen runs of each stretch of blocks, the stretch of each block of each page, and the first stretch of each page (one more at the end).

    A stretch has ``RUN`` words or more, or is all that there is. All pages are hashed at once.
    """
    stretches: list[list[bytes]] = []
    places, firsts = [], [0]
    for blocks in pages:
        short = False  # whether the last stretch may still grow
        at: list[int] = []
        for block in blocks:
            words = block.encode("utf-8", "surrogatepass").split()
            if short and len(words) < RUN:
                stretches[-1] += words
            else:
                stretches.append(words)
                short = len(words) < RUN
            at.append(len(stretches) - 1)
        places.append(at)
        firsts.append(len(stretches))
    lengths = np.array([len(w) for w in stretches], np.int64)
    hashes = np.concatenate([memo.of(w) for w in stretches]) if stretches else np.empty(0, np.uint64)
    runs = shingles(hashes, RUN) if len(hashes) >= RUN else np.empty(0, np.uint64)
    least = runs.copy()  # the smallest of the WINDOW runs that begin here
    for i in range(1, WINDOW):
        np.minimum(least[:-i], runs[i:], out=least[:-i])
    n_runs = np.maximum(lengths - RUN + 1, 0)
    wide = n_runs > WINDOW
    n_chosen = np.where(wide, n_runs - WINDOW + 1, n_runs)
    ends = starts_of(n_chosen)
    where = np.arange(ends[-1]) + np.repeat(starts_of(lengths)[:-1] - ends[:-1], n_chosen)
    chosen = np.where(np.repeat(wide, n_chosen), least[where], runs[where]).view(np.int64)
    return np.split(chosen, ends[1:-1]) if stretches else [], places, np.array(firsts)


def kept_blocks(blocks: list[str], inside: list[bool], template: np.ndarray, memo: WordHashes) -> list[str]:
    """The blocks that stay on a host with these template runs."""
    content = any(inside)
    gone: list[bool] = []
    if len(template):
        runs, (at,), _ = _hashes([blocks], memo)
        out = [len(r) > 0 and 2 * int(np.isin(r, template).sum()) > len(r) for r in map(np.unique, runs)]
        gone = [out[i] for i in at]
    return [b for i, b in enumerate(blocks) if (inside[i] or not content) and not (gone and gone[i])]


def _templates(pages: DataFrame) -> DataFrame:
    """(host, template): the runs that more than half of a host's ``pages`` (host, runs, copy) have; its copies count as one page.

    A page has few runs that most pages have, so a list holds no more than twice the runs of an average page.
    """
    once = F.count_if(~F.col("copy")) + F.max(F.col("copy").cast("long"))
    hosts = pages.groupBy("host").agg(once.alias("pages")).where(F.col("pages") >= LEAST_PAGES)
    runs = pages.select("host", "copy", F.explode("runs").alias("run")).groupBy("host", "run").agg(once.alias("n"))
    most = runs.where(F.col("n") >= LEAST_PAGES).join(hosts, "host").where(2 * F.col("n") > F.col("pages"))
    return most.groupBy("host").agg(F.collect_list("run").alias("template"))


def host_templates(rows: DataFrame) -> DataFrame:
    """(host, template) for the hosts of ``rows`` (host, html) that have one."""

    def parse(batches):
        memo = WordHashes()
        for batch in (part for whole in batches for part in slices(whole, 200)):
            pages = [blocks_of(page)[0] for page in batch.column(1).to_pylist()]
            digests = [xxhash.xxh3_64_intdigest("\n".join(blocks).encode("utf-8", "surrogatepass")) - (1 << 63) for blocks in pages]
            runs, _, firsts = _hashes(pages, memo)
            chosen = [np.unique(np.concatenate(runs[i:j])) if j > i else np.empty(0, np.int64) for i, j in zip(firsts, firsts[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.int64()), pa.array(chosen, pa.list_(pa.int64()))], names=["host", "page", "runs"])

    parsed = rows.select("host", "html").mapInArrow(parse, "host string, page long, runs array<long>")
    # Equal pages have equal runs: any one stands for all of them.
    pages = staged(parsed.groupBy("host", "page").agg(F.first("runs").alias("runs")), "page-runs")
    first = staged(_templates(pages.withColumn("copy", F.lit(False))), "templates")
    of_template = F.size(F.array_intersect("runs", "template")) >= COPY * F.size("runs")
    marked = pages.join(first, "host").select("host", "runs", ((F.size("runs") > 0) & of_template).alias("copy"))
    copied = staged(marked.where("copy").select("host").distinct(), "copied-hosts")
    again = _templates(marked.join(copied, "host", "left_semi"))
    return first.join(copied, "host", "left_anti").unionByName(again)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for each row of ``pages`` (page_id, url, html)."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"), host.alias("host"))
    templates = staged(host_templates(rows), "host-templates")

    def texts(batches):
        memo = WordHashes()
        for batch in (part for whole in batches for part in slices(whole, 200)):
            out = []
            for page, template in zip(batch.column(2).to_pylist(), batch.column(3), strict=True):
                blocks, inside = blocks_of(page)
                out.append(" ".join(kept_blocks(blocks, inside, np.array(template.as_py() or [], np.int64), memo)))
            columns = [pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], names=["page_id", "url", "text", "n_chars"])

    # Few hosts have a template that structure does not show; only their pages meet one, and a hot host is split by the skew join.
    joined = rows.join(templates, "host", "left").select("page_id", "url", "html", "template")
    return joined.mapInArrow(texts, "page_id long, url string, text string, n_chars long")
