"""Main text of web pages: page structure, then what repeats between the pages of each host.

Parsing leaves the blocks of the article, or of the body where a page marks no article. What repeats
between pages of a host is boilerplate: each run of ``DEPTH`` tokens is counted by the distinct pages
of the host that have it, over the whole host, and runs on several pages cover the words they hold.
Blocks that are mostly covered go. ``repeats`` gives the same counts for one host from a suffix array.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.llm.common import prepare, records
from assay.llm.lm import Hashes
from assay.session import stage

DEPTH = 8  # tokens of a long substring, a power of two
COVERED = 0.8  # share of a block's tokens from which it counts as boilerplate
# In a marked article, only what stands on this share of the pages, and on at least so many.
ARTICLE_SHARE, ARTICLE_PAGES = 0.5, 4
LINKED = 0.6  # share of link text from which a block outside a marked article is a menu

# Elements by their role in a page.
BLOCKS = set(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol "
    "option p pre section select summary table tbody tfoot thead title tr ul".split()
)
SPACED = {"td", "th"}
DROPPED = set(
    "aside audio button canvas datalist dialog footer form head iframe input label map menu nav "
    "noscript object option select svg template textarea title video".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|template|textarea|title|svg|iframe"
ROLES = set("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
# Names in class or id, apart from case. A name of several words counts if all are here or in PLACES, so
# that with-sidebar, comments-open or tag-search say nothing of an element.
NAMES = set(
    "ad ads adbox advert adverts advertisement advertising adslot banner breadcrumb breadcrumbs comment "
    "comments commentlist consent cookie cookies copyright disclaimer disqus footer gdpr login masthead "
    "menu modal nav navbar navigation newsletter notice notices notification overlay pager pagination "
    "popup promo promoted promotion related replies reply respond search share sharing sidebar signup "
    "skip social sponsor sponsored sponsors subscribe subscription toolbar topbar widget widgets".split()
)
# These name parts of an article as well as of a page, and count only outside one.
OUTER_NAMES = {"header", "head", "top", "bottom", "side"}

PLACES = set(
    "area bar block bottom box button buttons card cards container content entry fixed form global group head "
    "header holder inner items left line link links list main outer page panel post posts primary right "
    "row secondary section site slot small sticky text thread title top unit wrap wrapper".split()
)
# An article goes by its class only with one of these; and within an element so named, or one
# of FIRM_ELEMENTS, an article is a card or a comment.
FIRM = set(
    "ad ads advert advertisement comment comments commentlist disqus promo promoted promotion related "
    "replies reply respond sponsor sponsored".split()
)
FIRM_ELEMENTS = {"aside", "nav", "footer"}
SMALL = 0.5  # marked text of less than this share of the unmarked text may be cards beside the main text

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b[^>]*(?<!/)>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][^\s/>]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^\"'>])*+)>"
    r"|</?[a-z][^<>]*(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.IGNORECASE | re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"']+)))?")
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


def _named(values: dict[str, str], in_article: bool) -> set[str]:
    """The words that count of an element's class and id."""
    found: set[str] = set()
    names = NAMES if in_article else NAMES | OUTER_NAMES
    for name in f"{values.get('class', '')} {values.get('id', '')}".split():
        words = {w.lower() for w in _NAME_WORD.findall(name)}
        if words <= NAMES | PLACES | OUTER_NAMES and (words & NAMES or words and words <= names):
            found |= words & names
    return found


def _dropping(name: str, rest: str, in_article: bool) -> tuple[bool, bool]:
    """Whether an element is no part of the main text, and whether that holds for articles in it."""
    if name in DROPPED or (name == "header" and not in_article):
        return True, name in FIRM_ELEMENTS
    if not rest.strip() or name in ("html", "body", "main"):
        return False, False
    values = {k.lower(): unescape(a or b or c) for k, a, b, c in _ATTRIBUTE.findall(rest)}
    if "hidden" in values or values.get("aria-hidden", "").lower() == "true":
        return True, False
    if values.get("role", "").lower() in ROLES or _HIDDEN.search(values.get("style", "").lower()):
        return True, False
    found = _named(values, in_article)
    firm = bool(found & FIRM)
    # of ads, those left open are many: an article in one is an article
    lasting = bool(found & (FIRM - {"ad", "ads", "advert", "advertisement"}))
    return (firm if name == "article" else bool(found)), lasting


def blocks(page: str) -> tuple[list[str], bool]:
    """The blocks of a page's main text, and whether the page marks it as an article."""
    # (name, dropped, in article, in link, dropped with its articles) of each open element
    stack: list[tuple[str, bool, bool, bool, bool]] = [("", False, False, False, False)]
    found: list[tuple[str, bool, int]] = []  # text, in article, characters in links
    parts: list[str] = []
    linked = 0
    inside = False  # whether the current block is in an article

    def close() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            found.append((text, inside, linked))
        parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked, inside
        _, dropped, in_article, in_link, _ = stack[-1]
        if text and not dropped:
            text = unescape(text)
            parts.append(text)
            inside = in_article
            linked += len(text.strip()) if in_link else 0

    at = 0
    for token in _TOKEN.finditer(page):
        add(page[at : token.start()])
        at = token.end()
        name = (token["name"] or "").lower()
        if not name:
            continue
        if name in BLOCKS:
            close()
        elif name in SPACED:
            add(" ")
        if token["end"]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == name:
                    del stack[depth:]
                    break
            continue
        if name in VOID or (token["rest"] or "").rstrip().endswith("/"):
            continue
        if name in ("p", "li", "dt", "dd", "tr", "td", "th", "option") and stack[-1][0] == name:
            stack.pop()
        _, dropped, in_article, in_link, firm = stack[-1]
        marks = name in ("article", "main")
        drops, firmly = _dropping(name, token["rest"] or "", in_article or marks)
        # an article inside something else left open is an article all the same
        stays = not marks or in_article or (firm and name == "article")
        firm = firmly or (firm and (dropped and stays))
        dropped = drops or (dropped and stays)
        stack.append((name, dropped, in_article or marks, in_link or name == "a", firm))
    add(page[at:])
    close()
    article = [text for text, marked, _ in found if marked]
    others = sum(len(text) for text, marked, links in found if not marked and links < LINKED * len(text))
    if article and sum(map(len, article)) >= SMALL * others:
        return article, True
    return [text for text, _, links in found if links < LINKED * len(text)], False


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in records(batches, 128):
        made = [blocks(x or "") for x in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                batch.column(3),
                pa.array([b for b, _ in made], pa.list_(pa.string())),
                pa.array([m for _, m in made], pa.bool_()),
            ],
            ["page_id", "url", "host", "blocks", "marked"],
        )


def repeats(tokens: np.ndarray, pages: np.ndarray) -> np.ndarray:
    """For each token the most pages on which a substring of ``DEPTH`` tokens over it stands.

    ``pages`` has the page of each token, in order. The suffixes are ranked by their first 1, 2, 4 and
    8 tokens; equal ranks are neighbours in the suffix array that agree to that depth. Substrings do
    not cross pages.
    """
    count = len(tokens)
    on = np.zeros(count, np.int64)
    if count < DEPTH:
        return on
    rank, width = np.unique(tokens, return_inverse=True)[1].astype(np.int64), 1
    while width < DEPTH:
        following = np.full(count, -1, np.int64)
        following[:-width] = rank[width:]
        rank = np.unique(rank * (count + 1) + following + 1, return_inverse=True)[1].astype(np.int64)
        width *= 2
    starts = np.flatnonzero(pages[: count - DEPTH + 1] == pages[DEPTH - 1 :])
    seen = np.unique(np.stack([rank[starts], pages[starts]], axis=1), axis=0)
    distinct = np.bincount(seen[:, 0], minlength=count)[rank[starts]]
    for k in range(DEPTH):
        np.maximum.at(on, starts + k, distinct)
    return on


def run_hashes(blocks: list[str], host: int, hashes: Hashes) -> np.ndarray:
    """A 64-bit hash of the host and each run of ``DEPTH`` tokens of a page, across its blocks."""
    words = hashes.of([w for b in blocks for w in b.encode("utf-8", "replace").split(b" ")])
    count = max(0, len(words) - DEPTH + 1)
    mixed = np.full(count, host & (1 << 64) - 1, np.uint64)
    for i in range(DEPTH):
        mixed = (mixed + words[i : i + count]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return mixed.astype(np.int64)


def _page_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, host, blocks) to (run, row), once for each run of a page."""
    hashes = Hashes()
    for batch in records(batches, 64):
        runs = [
            np.unique(run_hashes(b, h, hashes))
            for h, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
        ]
        rows = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), [len(r) for r in runs])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(runs), pa.int64()), pa.array(rows, pa.int64())], ["run", "row"]
        )


def main_text(lines: list[str], marked: bool, on: np.ndarray, pages: int) -> str:
    """A page's text without the blocks that repeat. ``on`` has the pages each token's runs are on,
    ``pages`` the number of the host's."""
    framing = max(ARTICLE_PAGES, ARTICLE_SHARE * pages)
    least = framing if marked else 2
    kept, total = [], 0
    unframed, rest = [], 0
    at = 0
    for line in lines:
        size = line.count(" ") + 1
        here = on[at : at + size]
        at += size
        if np.mean(here >= least) < COVERED:
            kept.append(line)
            total += size
        if np.mean(here >= framing) < COVERED:
            unframed.append(line)
            rest += size
    # what stands on most pages of a host frames the text; of the others, a text that is mostly
    # repeated is a copy of an article
    return "\n".join((kept if 2 * total >= rest else unframed) or lines)


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(page_id, url, host, blocks, marked, pages, runs, counts) to the text of each page."""
    hashes = Hashes()
    for batch in records(batches, 64):
        made = []
        for host, lines, marked, pages, repeated in zip(
            *(batch.column(k).to_pylist() for k in range(2, 7)), strict=True
        ):
            own = run_hashes(lines, host, hashes)
            on = np.zeros(len(own) + DEPTH - 1, np.int64)
            counts = {r["run"]: r["n"] for r in repeated or ()}
            each = np.fromiter((counts.get(r, 1) for r in own.tolist()), np.int64, len(own))
            for k in range(DEPTH):
                np.maximum(on[k : k + len(own)], each, out=on[k : k + len(own)])
            if not len(own):  # fewer tokens than a run has
                on = np.zeros(DEPTH, np.int64)
            made.append(main_text(lines, marked, on, pages))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(made, pa.string())], ["page_id", "url", "text"]
        )


def extract(
    pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """Rows ``(page_id, url, text, n_chars)``, one for each row of ``pages``.

    Blocks are joined by a line end in page order; a page without main text, a null or an empty one
    gives an empty text. A page whose url is null or has no host belongs to the host "". Broken and
    unclosed markup is read as browsers do, an unfinished tag at the end is dropped. Repeated rows give
    repeated rows, other columns are not read. Repeats are counted over all pages of a host, however many.
    """
    prepare(pages.sparkSession)
    host = F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][\w+.-]*://([^/?#]*)", 1)), F.lit(""))
    rows = pages.select(
        F.col(key).cast("long").alias("page_id"),
        F.col(url).alias("url"),
        F.coalesce(html, F.lit("")).alias("html"),
        host.alias("host"),
    )
    placed = rows.select("page_id", "url", "html", F.xxhash64("host").alias("host"))
    parsed = placed.mapInArrow(
        _parsed, "page_id long, url string, host long, blocks array<string>, marked boolean"
    )
    # written, so that the number of each row is fixed
    parsed = stage(parsed.withColumn("row", F.monotonically_increasing_id()), "pages")
    runs = parsed.select("row", "host", "blocks").mapInArrow(_page_runs, "run long, row long")
    # the run's hash has the host in it, so that hot hosts are spread over all tasks
    counts = runs.groupBy("run").agg(F.count("*").alias("n")).where("n > 1")
    # written, so that the join has no aggregate in its stage and Spark can split a hot run
    counts = stage(counts, "runs")
    repeated = (
        runs.join(counts, "run").groupBy("row").agg(F.collect_list(F.struct("run", "n")).alias("repeated"))
    )
    sizes = stage(parsed.groupBy("host").agg(F.count("*").alias("pages")), "hosts")
    whole = (
        parsed.join(sizes, "host")
        .join(repeated, "row", "left")
        .select("page_id", "url", "host", "blocks", "marked", "pages", "repeated")
    )
    texts = whole.mapInArrow(_cleaned, "page_id long, url string, text string")
    return texts.withColumn("n_chars", F.length("text").cast("long"))
