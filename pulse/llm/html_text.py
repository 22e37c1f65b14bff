"""Main-text extraction from web pages with a host suffix array.

1. *Parse.*  A page becomes a list of blocks in page order.  Elements that are
   never content (menus, headers, footers, sidebars, notices, adverts, forms,
   scripts, styles, reader comments) are boilerplate by their mark-up; blocks
   inside the marked article are content by theirs.  What is left is *open*.
2. *Host suffix array.*  The token streams of a host's pages, outside marked
   articles, are concatenated, a separator after each page.  Sorted suffixes put
   equal substrings side by side; those of ``MIN_REPEAT`` tokens or more that
   occur on ``MIN_PAGES`` distinct pages and a ``MIN_SHARE`` of the host's pages
   are repeats.  A host's pages are dealt by key to as many arrays of about
   ``CHUNK_TOKENS`` as its tokens need; each array reports
   its prefixes of ``MIN_REPEAT`` tokens, equal ones together, and prefixes of
   different arrays meet by an equi-join, so the result does not depend on how a
   host was cut.  (A token lies in a repeated substring
   of at least that length if and only if it lies in a repeated prefix.)
3. *Keep.*  An open block that repeated substrings cover from end to end is
   removed; one with words of its own stays whole, so a quotation that many pages
   have is not cut out of a sentence.  A page that nothing would be left of keeps
   its open blocks.  Blocks of a marked article stay, also where two pages of a
   host carry the same article; only what is marked as boilerplate inside goes.

An element is marked by its name, by being hidden, or by a class, id or role
name: the whole name, or all words of a hyphenated one, must be words for
boilerplate or for boxes (``cookie-notice``, ``ad-box``; not ``notice-board``,
``related-work``).

On pages that mark their article, marks decide and the suffix array only
confirms them; on other pages it decides what is left.

Defined cases: a null or empty html gives an empty text; unclosed and crossed
tags close as browsers do, roughly: an end tag closes the innermost open
element of its name, if any; rows that repeat a page (id, url and html) are one
page to the suffix array; a null url has the empty host; very long pages take
time in proportion to their length, however deep or crossed their elements;
only the id and url columns are returned, so other columns may have any name.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from pulse.llm.common import write_out
from pulse.llm.url_filter import host_of

MIN_REPEAT = 6  # tokens
MIN_PAGES, MIN_SHARE = 3, 0.1  # of a host: phrases that fewer pages have are no boilerplate
CHUNK_TOKENS = 32_768
BUCKETS = 4096  # of a host's pages, which learn their host's size by host and bucket

# Element names of the HTML standard.
RAW = ("script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILERPLATE = frozenset(
    "nav header footer aside form menu dialog button select option datalist fieldset legend label input "
    "svg canvas audio video object applet map head".split()
)
CONTENT = frozenset(["article", "main"])
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section "
    "summary table tbody td tfoot th thead tr ul".split()
)
#: Words of class, id or role that mark boilerplate.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsored sponsor promo banner comment comments disqus reply replies "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login "
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar aside widget widgets related recommended share sharing social "
    "footer header masthead copyright pagination pager search toolbar skip complementary contentinfo hidden".split()
)
#: Words that say nothing of what a box holds, beside a mark in a hyphenated name.
BOXES = frozenset(
    "area bar block bottom box col column container content global group holder inner item layer left link links list "
    "main outer page panel primary right secondary section site slot strip sub top unit wrap wrapper".split()
)
MARKED_OR_BOX = MARKS | BOXES
NEVER_MARKED = frozenset("html body article main".split())
#: The page's own header inside its article holds the title and stays.
KEPT_IN_ARTICLE = frozenset(["header"])

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_PART = re.compile(r"[a-z]+")
_END = {name: re.compile(f"</{name}", re.I | re.A) for name in RAW}
_SPACE = re.compile(r"\s+")


def _named(names: str) -> bool:
    """Whether one of the names, or all parts of it, are words for boilerplate or for boxes, and one is a mark."""
    for name in names.split():
        parts = _PART.findall(name)
        if not MARKS.isdisjoint(parts) and MARKED_OR_BOX.issuperset(parts):
            return True
    return False


def _marked(attributes: str) -> bool:
    """Whether class, id or role name boilerplate, or the element is hidden."""
    if "=" not in attributes and "hidden" not in attributes:
        return False
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name in ("class", "id", "role") and _named(value):
            return True
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and "display:none" in value.replace(" ", ""):
            return True
    return False


def blocks(page: str | None) -> list[tuple[str, bool, bool]]:
    """(text, in the marked article, marked as boilerplate) of the blocks in page order; white space is one space."""
    out: list[tuple[str, bool, bool]] = []
    parts: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # element, article, boilerplate: of what it contains
    opened: Counter[str] = Counter()  # the elements in the stack, so that an end tag of none need not search it
    article = dropped = False

    def flush() -> None:
        if parts:
            text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
            parts.clear()
            if text:
                out.append((text, article, dropped))

    page = page or ""
    at = 0
    while True:
        m = _TOKEN.search(page, at)
        if m is None:
            parts.append(page[at:])
            break
        parts.append(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            if not opened[name]:
                if name in BLOCKS:
                    flush()
                continue
            depth = next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name)
            before = stack[depth - 1][1:] if depth else (False, False)
            if name in BLOCKS or before != (article, dropped):
                flush()
            opened.subtract(e[0] for e in stack[depth:])  # what was searched goes: each element is once
            del stack[depth:]
            article, dropped = before
            continue
        if name in BLOCKS:
            flush()
        if name in RAW and not m[3].endswith("/"):
            end = _END[name].search(page, at)
            # An element that never ends hides the rest of the page.
            at = len(page) if end is None else (page.find(">", end.start()) + 1 or len(page))
            continue
        if name in VOID or m[3].endswith("/"):
            continue
        in_article = article or name in CONTENT
        drop = (
            dropped
            or (name in BOILERPLATE and not (article and name in KEPT_IN_ARTICLE))
            or (name not in NEVER_MARKED and _marked(m[3]))
        )
        if (in_article, drop) != (article, dropped):
            flush()
        if name == "p":  # a paragraph ends where the next begins
            if stack and stack[-1][0] == "p":
                stack.pop()
                opened["p"] -= 1
        stack.append((name, in_article, drop))
        opened[name] += 1
        article, dropped = in_article, drop
    flush()
    return out


def tokens(text: str) -> list[str]:
    return text.split(" ")


# --- suffix arrays -----------------------------------------------------------------
def suffix_ranks(stream: np.ndarray, length: int) -> np.ndarray:
    """Rank of each suffix among the sorted suffixes, cut to ``length`` tokens: equal cut suffixes share a rank.

    Prefix doubling: ranks by the first n tokens of two places n apart give
    ranks by the first 2 n tokens.
    """
    rank = np.unique(stream, return_inverse=True)[1].astype(np.int64) + 1
    done = 1
    while done < length:
        step = min(done, length - done)
        after = np.zeros_like(rank)
        after[: len(rank) - step] = rank[step:]
        rank = np.unique(rank * (rank.max() + 1) + after, return_inverse=True)[1].astype(np.int64) + 1
        done += step
    return rank


def repeated_prefixes(streams: list[np.ndarray], pages: list[int], length: int) -> list[tuple[int, int, int]]:
    """(hash of a prefix of ``length`` tokens, page, place) from the suffix array of the streams.

    One entry for each place, equal prefixes together; ``streams`` hold token hashes.
    """
    from xxhash import xxh64_intdigest

    ends = -np.arange(1, len(streams) + 1)  # separators: no suffix goes on past its page
    joined = np.concatenate([x for s, e in zip(streams, ends) for x in (s.astype(np.int64), np.array([e], dtype=np.int64))])
    page = np.repeat(np.arange(len(streams)), [len(s) + 1 for s in streams])
    start = np.concatenate([np.arange(len(s) + 1) for s in streams])
    room = np.concatenate([len(s) - np.arange(len(s) + 1) for s in streams])
    rank = suffix_ranks(joined, length)
    whole = np.flatnonzero(room >= length)
    order = whole[np.lexsort((start[whole], page[whole], rank[whole]))]  # the suffix array, equal prefixes page by page
    raw = joined.tobytes()
    out, last, h = [], None, 0
    for i in order.tolist():
        if rank[i] != last:
            last, h = rank[i], xxh64_intdigest(raw[8 * i : 8 * (i + length)])
        out.append((h - (1 << 64) if h >> 63 else h, pages[page[i]], int(start[i])))
    return out


def _hashes(words: list[str]) -> np.ndarray:
    from xxhash import xxh64_intdigest

    # The sign bit is kept free for separators.
    return np.array([xxh64_intdigest(w.encode("utf-8", "surrogatepass")) >> 1 for w in words], dtype=np.int64)


# --- Spark -----------------------------------------------------------------------
def parse(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """id, url, key (of the row's content), host, text (of the content blocks), open (blocks left to the suffix array), stream."""
    schema = (
        "id {0}, url string, key long, host string, ready boolean, text string, "
        "blocks array<struct<text:string,keep:boolean,open:boolean>>, stream array<long>"
    ).format(dict(pages.dtypes)[id_col])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for i, url, key, host, page in zip(batch["id"], batch["url"], batch["key"], batch["host"], batch["html"]):
                found = blocks(page)
                stream = [w for text, article, _ in found if not article for w in tokens(text)]
                # Ready: nothing is left for the suffix array to decide.
                ready = not any(not article and not dropped for _, article, dropped in found)
                text = " ".join(t for t, article, dropped in found if article and not dropped) if ready else None
                kept = None if ready else [{"text": t, "keep": a and not d, "open": not a and not d} for t, a, d in found if not d or not a]
                rows.append((i, url, key, host, ready, text, kept, _hashes(stream)))
            yield pd.DataFrame(rows, columns=["id", "url", "key", "host", "ready", "text", "blocks", "stream"])

    return pages.select(
        F.col(id_col).alias("id"),
        F.col(url_col).alias("url"),
        F.xxhash64(id_col, url_col, html_col).alias("key"),
        host_of(F.col(url_col)).alias("host"),
        F.col(html_col).alias("html"),
    ).mapInPandas(run, schema)


def repeats(parsed: DataFrame, length: int, least: int = 2, share: float = 0.0) -> DataFrame:
    """(key, starts): places in a page's stream where substrings begin that ``least`` pages and a ``share`` of the host's have."""
    streams = parsed.select("host", "key", "stream").where(F.size("stream") >= length).dropDuplicates(["host", "key"])
    streams = streams.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(BUCKETS)))
    # A host has at most BUCKETS rows here, whatever its pages; streams meet them by host and bucket.
    sizes = streams.groupBy("host", "bucket").agg(F.sum(F.size("stream")).alias("tokens"), F.count(F.lit(1)).alias("n"))
    host = Window.partitionBy("host")
    sizes = sizes.select("host", "bucket", F.sum("tokens").over(host).alias("total"), F.sum("n").over(host).alias("of"))
    chunk = F.pmod(F.xxhash64("key", "host"), F.ceil(F.col("total") / CHUNK_TOKENS))
    dealt = streams.join(sizes, ["host", "bucket"]).select("host", chunk.alias("chunk"), "key", "stream", "of")

    def array(group: pd.DataFrame) -> pd.DataFrame:
        found = repeated_prefixes(list(group["stream"]), group["key"].tolist(), length)
        out = pd.DataFrame(found, columns=["prefix", "key", "start"])
        out["host"], out["of"] = group["host"].iloc[0], group["of"].iloc[0]
        out["first"] = (~out.duplicated(["prefix", "key"])).astype("int32")  # a page is in one array only
        return out[["host", "prefix", "key", "start", "first", "of"]]

    # Dealt by chunk as well: else the partitioning by host that the join left would do for the grouping.
    prefixes = write_out(
        dealt.repartition("host", "chunk").groupBy("host", "chunk").applyInPandas(array, "host string, prefix long, key long, start int, first int, of long"), "prefixes"
    )
    shared = (
        prefixes.groupBy("host", "prefix")
        .agg(F.sum("first").alias("pages"), F.max("of").alias("of"))
        .where((F.col("pages") >= least) & (F.col("pages") >= F.col("of") * share))
        .select("host", "prefix")
    )
    return prefixes.join(shared, ["host", "prefix"]).groupBy("host", "key").agg(F.collect_list("start").alias("starts"))


def unique_runs(blocks_, starts, length: int) -> str:
    """The text of the kept blocks and of the open ones that have uncovered words."""
    covered: set[int] = set()
    for s in () if starts is None else starts:
        covered.update(range(int(s), int(s) + length))
    out, at = [], 0
    for b in blocks_:
        words = tokens(b["text"])
        if b["keep"]:
            out.append(b["text"])
            continue
        if b["open"] and not all(k in covered for k in range(at, at + len(words))):
            out.append(b["text"])  # phrases that other pages have too are the block's own
        at += len(words)  # blocks outside the article make up the stream
    return " ".join(out or [b["text"] for b in blocks_ if b["open"]])  # a body that other pages have too is still a body


def extract(
    pages: DataFrame, min_repeat: int = MIN_REPEAT, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per input row: id, url, text."""
    parsed = write_out(parse(pages, id_col, url_col, html_col), "parsed-pages")
    covered = repeats(parsed, min_repeat, MIN_PAGES, MIN_SHARE)

    @F.pandas_udf("string")
    def runs(rows: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for b, s in rows:
            yield pd.Series([unique_runs(x, y, min_repeat) for x, y in zip(b, s)], dtype=object)

    ready = parsed.where("ready").select("id", "url", "text")
    left = parsed.where("not ready").join(covered, ["host", "key"], "left").select("id", "url", runs("blocks", "starts").alias("text"))
    return ready.union(left).select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text")
