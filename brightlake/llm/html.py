"""Main text of web pages, with repeated runs of a host removed by a suffix array.

A page is cut into blocks of text at block-level tags. Blocks inside an article
element (else inside main, else any) are the candidates, without those whose element
or class names say that they are none of the text.

All blocks of all pages of a host, candidates or not, are token sequences whose suffixes are
ranked by prefix doubling. Ranks are compared where blocks begin: a stretch of whole blocks of
``RUN_TOKENS`` or more tokens, the shortest from each block on and up to each block, has the
rank of its first and of its last 2 ** k tokens. Stretches of equal rank on
``MIN_PAGES`` pages (inside an article ``ARTICLE_PAGES``) and ``PAGE_SHARE`` percent of the
host's pages repeat, and those that overlap or meet join to maximal runs. A candidate block inside such a run goes, whole: no
sentence is cut. Ranks are 64-bit hashes, so equal suffixes meet in an aggregate
by (host, rank): a host with a third of all pages is summed like any other, and no task
holds a whole host.

An article may stand on several pages: pages of equal candidate text count as one page, and
runs that hold half of an article's tokens or more, or all text of a page without an article
element, are that text itself and stay.

Defined cases: a null or empty page, or one without text, gives the empty text;
a null url is a host of its own, of addresses without a host; a null id is kept; an unclosed
tag at the end is no text. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightlake.llm.text import mix64
from brightlake.session import scratch_path, written

#: Tokens of the shortest run that counts as repeated; a power of two.
RUN_TOKENS = 8
#: A run repeats that stands on so many pages of its host, and on this percentage of them;
#: inside an article, whose opening line may well stand on a few pages, on more pages.
MIN_PAGES, ARTICLE_PAGES, PAGE_SHARE = 3, 10, 50

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)"""
                  r"""((?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z)""", re.S)
_NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""",
                    re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no text.
RAW = frozenset("script style noscript template iframe svg canvas object audio video math "
                "textarea title".split())
#: Never part of an article.
APART = frozenset("nav footer aside form head button select dialog menu option label".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q "
                   "rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_ENDS_P = frozenset("address article aside blockquote details dialog div dl fieldset figcaption "
                    "figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre "
                    "section table ul".split())
_ENDS_ITSELF = {"li": {"ul", "ol", "menu"}, "option": {"select"}, "tr": {"table"},
                "td": {"tr", "table"}, "th": {"tr", "table"}, "dt": {"dl"}, "dd": {"dl"}}
_NAMED_APART = re.compile(
    r"(?:ads?|advert(?:s|isements?|ising)?|sponsor(?:ed|s)?|promo(?:s|tions?)?|banner|cookies?|"
    r"consent|gdpr|notices?|alerts?|sidebar|menu|nav|navbar|navigation|breadcrumbs?|comments?|"
    r"respond|repl(?:y|ies)|disqus|share|sharing|social|related|recommend(?:ed|ations)?|"
    r"newsletter|subscribe|signup|popup|modal|footer|pagination|pager|widgets?|search|"
    r"complementary|contentinfo)(?:[-_].*)?")
_NAMED_HEADER = re.compile(r"(?:header|masthead|topbar|toolbar|banner)(?:[-_].*)?")


def _apart(name: str, attributes: str, in_article: bool) -> bool:
    if name in APART or (name == "header" and not in_article):
        return True
    if not attributes or name in ("html", "body", "main"):
        return False
    if _HIDDEN.search(attributes):
        return True
    for found in _NAMES.findall(attributes):
        for word in unescape(found[0] or found[1] or found[2]).lower().split():
            if _NAMED_APART.fullmatch(word) or (not in_article and _NAMED_HEADER.fullmatch(word)):
                return True
    return False


def blocks(page: str) -> list[tuple[int, bool, str]]:
    """``(level, apart, text)`` of every block: level 2 in an article, 1 in main, 0 elsewhere."""
    out: list[tuple[int, bool, str]] = []
    stack: list[tuple[str, int, bool]] = [("", 0, False)]
    run: list[str] = []
    at, low, n = 0, None, len(page)

    def end_block():
        if run:
            text = " ".join(unescape("".join(run)).split())
            if text:
                out.append((stack[-1][1], stack[-1][2], text))
            run.clear()

    def pop_to(name: str, bounds: set[str] | frozenset[str] = frozenset()):
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] == name:
                if any(s[0] not in INLINE for s in stack[k:]) or stack[k][2] != stack[k - 1][2]:
                    end_block()
                del stack[k:]
                return
            if stack[k][0] in bounds:
                return

    while at < n:
        found = _TAG.search(page, at)
        if found is None:
            run.append(page[at:])
            break
        if found.start() > at:
            run.append(page[at:found.start()])
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        if found[1]:
            if name not in INLINE:
                end_block()
            pop_to(name)
            continue
        if name in RAW:
            end_block()
            low = page.lower() if low is None else low
            close = low.find("</" + name, at) if len(low) == n else -1
            if close < 0 and len(low) != n:
                m = re.compile("</" + name, re.I).search(page, at)
                close = m.start() if m else -1
            if name in ("script", "style", "title", "textarea", "noscript") or close >= 0:
                after = page.find(">", close) if close >= 0 else -1
                at = after + 1 if after >= 0 else n
            continue
        if name in _ENDS_P:
            pop_to("p", {"div", "section", "article", "td", "li", "main"})
        if name in _ENDS_ITSELF:
            pop_to(name, _ENDS_ITSELF[name])
        _, level, apart = stack[-1]
        if name not in INLINE:
            end_block()
        if name in VOID or found[3].rstrip().endswith("/") and name not in _ENDS_P:
            continue
        new_apart = apart or _apart(name, found[3], level == 2)
        new_level = max(level, 2 if name == "article" else 1 if name == "main" else 0)
        if new_apart != apart and name in INLINE:
            end_block()
        stack.append((name, new_level, new_apart))
    end_block()
    return out


def host_of(url: str | None) -> str:
    found = re.match(r"\s*(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#]*@)?(\[[^\]]*\]|[^/?#:]*)", url or "")
    return found[1].lower() if found else ""


def candidates(found: list[tuple[int, bool, str]]) -> tuple[bool, list[int]]:
    """Whether the page has an article, and its blocks: of the innermost kind of container
    that has any, else all that are not apart."""
    for level in (2, 1):
        at = [i for i, (of, apart, _) in enumerate(found) if of >= level and not apart]
        if at:
            return True, at
    return False, [i for i, (_, apart, _) in enumerate(found) if not apart]


_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _token_code(token: str) -> int:
    return int.from_bytes(hashlib.blake2b(token.encode("utf-8", "replace"), digest_size=8).digest(),
                          "little")


class _Codes(dict):
    """Codes of the tokens met so far."""

    def __missing__(self, token: str) -> int:
        code = self[token] = _token_code(token)
        return code


def _doubled(rank: np.ndarray, step: int) -> np.ndarray:
    """Ranks by ``2 * step`` tokens from those by ``step``."""
    return mix64(rank[:-step] * _FACTOR + rank[step:])


def suffix_ranks(tokens: list[str], length: int = RUN_TOKENS) -> np.ndarray:
    """Rank of every suffix by its first ``length`` tokens, by prefix doubling."""
    rank = np.array([_token_code(t) for t in tokens], dtype=np.uint64)
    step = 1
    while step < length and len(rank) > step:
        rank = _doubled(rank, step)
        step *= 2
    return rank if step >= length else rank[:0]


def stretches(codes: np.ndarray, sizes: np.ndarray,
              least: int = RUN_TOKENS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(rank, first block, last block)`` of the shortest stretches of whole blocks, ``least``
    tokens or more, from each block on and up to each block.

    Every longer run of whole blocks is a union of these. ``codes`` are the tokens' codes, and
    ``sizes`` the blocks' numbers of tokens.
    """
    ends = np.cumsum(sizes)
    starts = ends - sizes
    blocks_ = np.arange(len(sizes))
    last = np.searchsorted(ends, starts + least)
    first = np.searchsorted(starts, ends - least, side="right") - 1
    pairs = np.concatenate([np.stack([blocks_, last], 1)[last < len(sizes)],
                            np.stack([first, blocks_], 1)[first >= 0]])
    pairs = np.unique(pairs, axis=0)
    lo, hi = starts[pairs[:, 0]], ends[pairs[:, 1]]
    n = hi - lo
    level = np.frexp(n)[1] - 1
    out = np.zeros(len(n), np.uint64)
    rank = codes
    for k in range(int(level.max()) + 1 if len(n) else 0):
        step = 1 << k
        now = level == k
        out[now] = mix64(mix64(rank[lo[now]] * _FACTOR + rank[hi[now] - step]) + n[now].astype(np.uint64))
        if k < level.max():
            rank = _doubled(rank, step)
    return out, pairs[:, 0], pairs[:, 1]


_STRETCHES = pa.list_(pa.struct([("rank", pa.int64()), ("first", pa.int32()), ("last", pa.int32())]))


def parse(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """One row a page: its blocks (null where no candidate), the candidates' places, the tokens of
    each block, a code of the candidates' text, and the ranked stretches of all blocks."""
    kind = pages.schema[key].dataType.simpleString()

    def run(batches):
        known = _Codes()
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                if len(known) > 200_000:
                    known.clear()
                columns = [[] for _ in range(7)]
                for address, page in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    found = blocks(page or "")
                    whole, at = candidates(found)
                    tokens = [b[2].split() for b in found]
                    sizes = np.array([len(t) for t in tokens], dtype=np.int64)
                    codes = np.array([known[t] for block in tokens for t in block], dtype=np.uint64)
                    rank, lo, hi = stretches(codes, sizes)
                    texts = [None] * len(found)
                    for i in at:
                        texts[i] = found[i][2]
                    text = _token_code(" ".join(found[i][2] for i in at)) - (1 << 63)
                    row = (host_of(address), text, whole, texts, at, sizes.tolist(),
                           [{"rank": r, "first": a, "last": b} for r, a, b in
                            zip(rank.view(np.int64).tolist(), lo.tolist(), hi.tolist())])
                    for column, value in zip(columns, row):
                        column.append(value)
                kinds = [pa.string(), pa.int64(), pa.bool_(), pa.list_(pa.string()),
                         pa.list_(pa.int32()), pa.list_(pa.int32()), _STRETCHES]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                    [key, url, "_host", "_code", "_whole", "_blocks", "_at", "_sizes", "_stretches"])

    return pages.select(key, F.col(url).cast("string"), html).mapInArrow(
        run, f"`{key}` {kind}, `{url}` string, _host string, _code long, _whole boolean, "
             "_blocks array<string>, _at array<int>, _sizes array<int>, "
             "_stretches array<struct<rank: long, first: int, last: int>>")


def repeated_blocks(parsed: DataFrame) -> DataFrame:
    """``_row`` and ``_runs``, the (first, last) blocks of its stretches that repeat on its host."""
    ranked = parsed.select("_row", "_host", "_code", "_whole", F.inline("_stretches"))
    pages = (parsed.select("_host", "_code").distinct()
             .groupBy("_host").agg(F.count(F.lit(1)).alias("_pages")))
    common = (ranked.select("_host", "rank", "_code").distinct().groupBy("_host", "rank")
              .agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= MIN_PAGES)
              .join(pages, "_host").filter(F.col("_n") * 100 >= F.col("_pages") * PAGE_SHARE))
    return (ranked.join(common.select("_host", "rank", "_n"), ["_host", "rank"])
            .filter(~F.col("_whole") | (F.col("_n") >= ARTICLE_PAGES))
            .groupBy("_row").agg(F.collect_set(F.struct("first", "last")).alias("_runs")))


def extract(pages: DataFrame, key: str = "page_id", url: str = "url",
            html: str = "html") -> DataFrame:
    """``key``, ``url``, ``text`` and ``n_chars`` (code points) of every page."""
    spark = pages.sparkSession
    path = scratch_path(spark, "html-pages")
    (parse(pages, key, url, html).withColumn("_row", F.monotonically_increasing_id())
     .write.option("compression", "zstd").parquet(path))
    parsed = spark.read.parquet(path)
    # Written, so that Spark knows its size: texts are shuffled only where many pages hold runs.
    runs = written(repeated_blocks(parsed), "html-runs")
    marked = parsed.drop("_stretches", "_host", "_code").join(runs, "_row", "left")
    gone = F.flatten(F.transform("_runs", lambda r: F.sequence(r["first"], r["last"])))

    def tokens(places):
        return F.aggregate(places, F.lit(0).cast("long"), lambda n, i: n + F.get("_sizes", i))

    # Runs that are (half of) the text are the text.
    left, all_ = tokens(F.col("_left")), tokens(F.col("_at"))
    cut = F.when(F.col("_whole"), left * 2 > all_).otherwise(left > 0)
    places = F.when(cut, F.col("_left")).otherwise(F.col("_at"))
    kept = F.transform(places, lambda i: F.get("_blocks", i))
    return (marked.withColumn("_left", F.array_except("_at", gone)).select(key, url, F.array_join(kept, " ").alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))
