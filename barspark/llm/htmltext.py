"""Main-text extraction: marked blocks, then a suffix array of each host's token streams.

A page is cut into blocks.  Markup settles what it names: scripts, styles,
forms, menus, page headers and footers, sidebars, notices, adverts and
reader comments go; an article (else a main element) holds the text, and a
page that declares neither offers all its other blocks.  A main element with
as many words outside links as the articles of its page together, or three times
the longest one, is the text, and the articles are teasers.  Names that are
words of articles too (``related``, ``social``, ``hidden``) mark furniture
alone or beside names of boxes, unless nearly all of the article stands there;
beside other words they do if most words inside are links.  The kept blocks of a
host's pages are then concatenated as token streams into a suffix array
(prefix doubling up to ``run`` tokens).  Runs of at least ``run`` tokens that
many pages share are boilerplate: in pages that declare no article, runs that
half of the host's pages carry go (``open_share`` of them, and at least
``open_pages`` pages), so a passage that a few pages quote stays; inside a
declared article only runs that nearly every page of the host carries go
(``furniture`` of them, and at least ``least_pages`` pages).  Pages of equal
text count once: neither copies nor repeated rows make a run boilerplate.

Pages with and without an article are compared among themselves, a host's all
together.  The distinct texts of a host of many pages are dealt into shards by hash
of the text, and a suffix array per shard counts the runs there.  A shard
names its runs of at least half the share with their counts, so the counts of
the shards add up to bounds for every run of the host; runs that the bounds leave
open are counted in all texts.  How many shards there are changes no result.

Edge cases: null or empty html gives an empty text; a null or unparsable url
puts a page on the host ``''``; unclosed and stray tags are tolerated;
repeated rows are given each and count once.  Texts are never cut short.
"""

from __future__ import annotations

import hashlib
import html
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barspark.llm.common import materialize
from barspark.llm.tokens import Ranges, hash_words
from barspark.llm.urls import host

_U = np.uint64
RUN, SHARD_PAGES = 8, 1500

# Element and class names that mark what a block is.
BLOCK = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre
section summary table tbody tfoot thead tr ul""".split())
SPACED = frozenset("br td th img input wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FURNITURE = frozenset("nav footer aside form button select option dialog menu datalist noscript template svg canvas".split())
RAW = frozenset("script style textarea title iframe".split())  # what they hold is no markup
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar".split())
MARKS = frozenset("""nav navbar submenu sidebar footer masthead cookie cookies consent gdpr ad ads advert
adverts advertisement advertising sponsored promo popup modal comment comments disqus respond subscribe newsletter signup
login breadcrumb breadcrumbs pagination pager widget widgets toolbar""".split())
# names that are words of articles too: alone or beside HOLDERS they mark furniture, else the words inside decide
AMBIGUOUS = frozenset("""alert banner copyright disclaimer hidden menu navigation notice notices notification overlay promotion
recommended recommendations related reply replies share sharing skip social sponsor""".split())
HOLDERS = frozenset("""area articles bar block body bottom box btn button buttons card cards col column container content danger element
footer group header icons info inner item items left link links list main media module more news outer page panel post posts
primary right row secondary section site slot stories strip success text this to top unit warning wrap wrapper""".split())
ARTICLE_MARKS = frozenset("comment comments reply ad advert promo related teaser".split())
BODY = frozenset("article article-body article-content post-content entry-content post-body story-body articlebody".split())
MAIN = frozenset("main main-content maincontent".split())

_NAME = re.compile(r"[a-zA-Z][\w:-]*")
_SPACE = re.compile(r"\s*")
_ATTR = re.compile(r"([\w:-]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_LONG_REF = re.compile(r"&#([0-9]{8,})")
_TEXTS = pa.schema([("host", pa.string()), ("declared", pa.bool_()), ("th", pa.int64()), ("shard", pa.int64()),
                    ("blocks", pa.list_(pa.string()))])
# how a block counts: not at all, only if it makes up nearly all of its article, only if most of its words are no links
GONE, MOSTLY, IF_WORDS = -1, -2, -3


def _kind(tag: str, attrs: str, inside: int) -> int:
    """GONE, MOSTLY, IF_WORDS, 2: an article, 1: a main element, 0: neither."""
    if tag in FURNITURE or tag == "header" and not inside:
        return GONE
    base = 2 if tag == "article" else 1 if tag == "main" else 0
    if not attrs.strip() or tag in ("html", "body"):
        return base
    a = {k.lower(): v.strip("\"'") for k, v in _ATTR.findall(attrs)}
    if "hidden" in a or a.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", a.get("style", ""), re.I):
        return GONE
    role = a.get("role", "").lower()
    names = (a.get("class", "") + " " + a.get("id", "")).split()
    low = {x.lower() for x in names}
    if base:
        return GONE if low & ARTICLE_MARKS and tag == "article" else base
    if role in ROLES:
        return GONE
    if role in ("article", "main") or low & BODY or low & MAIN or a.get("itemprop", "").lower() == "articlebody":
        return 1 if role == "main" or low & MAIN else 2
    kind = 0
    for x in names:
        if not re.match(r"(?:has|no|with|without|js|is)[-_]", x.lower()):
            parts = {p.lower() for p in re.findall(r"[A-Z]?[a-z]+|[A-Z]+", x)}
            if parts & MARKS or not inside and "header" in parts:
                return GONE
            if parts & AMBIGUOUS:
                kind = MOSTLY if kind == MOSTLY or parts <= AMBIGUOUS | HOLDERS else IF_WORDS
    return kind


def markup(page: str):
    """(start, end, tag, whether it closes, attributes) of a page's markup, in one pass; the tag of comments is empty.

    Quotes hide a ``>`` only as an attribute's value.  A tag whose quote or
    bracket never closes ends at the next ``>``; without one the page was cut
    there, and the rest is no text.  Raw elements come as one piece."""
    size, at, plain = len(page), 0, 0  # before ``plain`` quotes are known to lead nowhere
    while True:
        start = page.find("<", at)
        if start < 0:
            return
        tag, closes, attrs = "", False, ""
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            end = size if end < 0 else end + 3
        elif page.startswith("<![CDATA[", start):
            end = page.find("]]>", start)
            end = size if end < 0 else end + 3
        elif page.startswith(("<!", "<?"), start):
            end = page.find(">", start) + 1 or size
        else:
            closes = page.startswith("</", start)
            name = _NAME.match(page, start + 1 + closes)
            if not name:
                at = start + 1
                continue
            tag, here = name[0].lower(), name.end()
            first = gt = page.find(">", here)
            while gt >= 0 and start >= plain:
                eq = page.find("=", here, gt)
                if eq < 0:
                    break
                here = _SPACE.match(page, eq + 1).end()
                quote = page[here:here + 1]
                if quote in ("'", '"'):
                    close = page.find(quote, here + 1)
                    if close > gt:
                        gt = page.find(">", close)
                    if close < 0 or gt < 0:
                        plain, gt = here + 1 if close < 0 else size, first
                    here = close + 1
            end = gt + 1 or size
            attrs = page[name.end():gt if gt >= 0 else size]
            if tag in RAW and not closes and gt >= 0 and not attrs.endswith("/"):
                last = re.compile("</" + tag + r"(?=[\s/>])", re.I).search(page, end)
                end = page.find(">", last.end()) + 1 or size if last else size
                tag = ""
        yield start, end, tag, closes, attrs
        at = end


def _text(s: str) -> str:
    """Character references decoded, numbers of any length included."""
    if "&" not in s:
        return s
    return html.unescape(_LONG_REF.sub(lambda m: "&#" + (m[1].lstrip("0") if len(m[1].lstrip("0")) < 8 else "65533"), s))


def _chosen(out: list[tuple[int, int, int, str, int]], kinds: list[int]) -> tuple[int, list[str]]:
    """The main text among (zone, article, group, text, words in links): by words, links and marks together."""
    own = [len(s.split()) - links if len(kinds) > 1 or zone else 0 for zone, _, _, s, links in out]
    plain, linked = [0] * len(kinds), [0] * len(kinds)
    for (_, _, g, _, links), n in zip(out, own):
        plain[g] += n
        linked[g] += links
    kept = {g for g, k in enumerate(kinds) if k == 0 or k == IF_WORDS and plain[g] > linked[g]}
    main, articles = 0, Counter()
    for (zone, art, g, _, _), n in zip(out, own):
        if g in kept and zone == 1:
            main += n
        elif g in kept and zone == 2:
            articles[art] += n
    held = {zone for zone, _, g, _, _ in out if g in kept} or {zone for zone, *_ in out} or {0}
    best = max(held)
    # teaser cards beside or inside a main element that holds the story
    if best == 2 and main and (main >= articles.total() or main >= 3 * max(articles.values())):
        best = 1
    rest = main if best == 1 else articles.total()
    if best:
        kept |= {g for g, k in enumerate(kinds) if k == MOSTLY and plain[g] > 2 * linked[g] and plain[g] > 3 * rest}
    return best, [s for zone, _, g, s, _ in out if zone == best and g in kept]


def blocks(page: str | None) -> tuple[int, list[str]]:
    """Kept blocks of a page, in order, and how they are marked: 2 article, 1 main, 0 neither."""
    out: list[tuple[int, int, int, str, int]] = []
    stack: list[tuple[str, tuple[int, int, int, bool]]] = []
    opened: Counter[str] = Counter()  # elements on the stack by tag, so that a stray end tag costs nothing
    text: list[str] = []
    kinds = [0]  # of the groups of blocks that ambiguous names mark
    state = top = (0, 0, 0, False)  # zone, article, group, whether to skip
    links = articles = at = 0
    if not page:
        return 0, []

    def flush():
        nonlocal links
        s = " ".join("".join(text).split())
        if s:
            out.append((*state[:3], s, links))
        text.clear()
        links = 0

    def read(s: str):
        nonlocal links
        if s and not state[3]:
            s = _text(s)
            text.append(s)
            if opened["a"]:
                links += len(s.split())

    for start, end, tag, closes, attrs in markup(page):
        read(page[at:start])
        at = end
        if not tag:
            continue
        block = tag in BLOCK
        if block:
            flush()
        elif tag in SPACED:
            text.append(" ")
        if closes:
            while opened[tag]:
                last, _ = stack.pop()
                opened[last] -= 1
                if last == tag:
                    break
            state = stack[-1][1] if stack else top
            continue
        if tag in VOID or attrs.endswith("/"):
            continue
        if block and stack and stack[-1][0] == "p":
            stack.pop()
            opened["p"] -= 1
            state = stack[-1][1] if stack else top
        if block and tag != "p" or tag in FURNITURE or attrs.strip():
            zone, article, group, skip = state
            kind = _kind(tag, attrs, zone)
            if kind == GONE:
                if not block and not skip:
                    text.append(" ")
                skip = True
            elif kind == 2 and zone < 2:
                articles += 1
                article = articles
            elif kind == MOSTLY and not block:
                skip = True
            elif kind in (MOSTLY, IF_WORDS) and block and not group and not skip:
                kinds.append(kind)
                group = len(kinds) - 1
            state = (max(zone, kind), article, group, skip)
            stack.append((tag, state))
            opened[tag] += 1
    read(page[at:])
    flush()
    return _chosen(out, kinds)


def _parse(it):
    for batch in it:
        got = [blocks(x) for x in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("page_id", "url", "host")), pa.array([z > 0 for z, _ in got]),
             pa.array([b for _, b in got], pa.list_(pa.string()))], ["page_id", "url", "host", "declared", "blocks"])


def _parse_distinct(it):
    """Texts of pages, each text of a host once a task, with its hash; pages without words have none."""
    seen: set[tuple[str, bool, int]] = set()
    for batch in it:
        rows = []
        for page, host_, shards in zip(*(batch.column(c).to_pylist() for c in ("html", "host", "shards"))):
            zone, b = blocks(page)
            th = int.from_bytes(hashlib.blake2b(" ".join(b).encode(), digest_size=8).digest(), "little", signed=True)
            if b and (key := (host_, zone > 0, th)) not in seen:
                seen.add(key)
                rows.append({"host": host_, "declared": zone > 0, "th": th, "shard": th % shards, "blocks": b})
        yield pa.RecordBatch.from_pylist(rows, _TEXTS)


def repeated_runs(tokens: np.ndarray, page: np.ndarray, run: int = RUN):
    """Suffix array of the streams, sorted to a depth of ``run`` tokens.

    Returns, for every place with ``run`` tokens left in its page, the number
    of distinct pages whose streams hold the run that starts there.
    """
    n = len(tokens)
    _, rank = np.unique(tokens, return_inverse=True)
    left = np.ones(n, bool)
    have = 1
    while have < run:
        step = min(have, run - have)
        nxt = np.full(n, -1, np.int64)
        nxt[: n - step] = rank[step:]
        same = np.zeros(n, bool)
        same[: n - step] = (page[step:] == page[: n - step]) & left[step:]
        left &= same
        _, rank = np.unique(rank * np.int64(n + 1) + np.where(left, nxt + 1, 0), return_inverse=True)
        have += step
    pages = np.zeros(n, np.int64)
    at = np.flatnonzero(left)
    if len(at):
        order = at[np.lexsort((page[at], rank[at]))]  # the suffix array
        r, p = rank[order], page[order]
        first = np.concatenate([[True], r[1:] != r[:-1]])
        other = first | np.concatenate([[True], p[1:] != p[:-1]])
        group = np.cumsum(first) - 1
        pages[order] = np.bincount(group, weights=other)[group].astype(np.int64)
    return pages


def _covered(starts: np.ndarray, run: int) -> np.ndarray:
    edge = np.zeros(len(starts) + 1, np.int64)
    at = np.flatnonzero(starts)
    edge[at] += 1
    np.add.at(edge, np.minimum(at + run, len(starts)), -1)
    return np.cumsum(edge[:-1]) > 0


def _without(words: list[list[str]], gone: np.ndarray) -> list[str]:
    out, at = [], 0
    for w in words:
        g = gone[at:at + len(w)]
        at += len(w)
        kept = [x for x, y in zip(w, g) if not y] if g.any() else w
        if kept:
            out.append(" ".join(kept))
    return out


def _shard(run: int, furniture: float, least_pages: int, open_share: float, open_pages: int):
    """One suffix array over the distinct pages of a host, all declared or none of them."""
    def work(t: pa.Table) -> pa.Table:
        pages = [[b.split() for b in p] for p in t.column("blocks").to_pylist()]
        first: dict[str, int] = {}  # distinct texts, by the first page that holds each
        same = [first.setdefault(" ".join(w for b in p for w in b), i) for i, p in enumerate(pages)]
        own = [i for i in first.values() if any(pages[i])]
        n = np.array([sum(map(len, pages[i])) for i in own], np.int64)
        h = hash_words([w.encode() for i in own for b in pages[i] for w in b])
        many = repeated_runs(h, np.repeat(np.arange(len(own)), n), run)
        share, least = (furniture, least_pages) if t.column("declared")[0].as_py() else (open_share, open_pages)
        need = max(least, share * len(own))
        gone_of = {i: _covered(many[end - size:end] >= need, run) for i, end, size in zip(own, np.cumsum(n), n)}
        kept = []
        for p, i in zip(pages, same):
            gone = gone_of.get(i)
            kept.append(_without(p, gone) if gone is not None and gone.any() else [" ".join(b) for b in p])
        return pa.table({"page_id": t.column("page_id"), "url": t.column("url"), "blocks": pa.array(kept, pa.list_(pa.string()))})
    return work


def _page_runs(page: list[str], run: int) -> np.ndarray:
    """Hashes of the runs that start at each token of a page."""
    rng = Ranges(hash_words([w.encode() for b in page for w in b.split()]))
    at = np.arange(max(0, len(rng.sums) - run))
    return rng.of(at, at + run).view(np.int64)


def _shard_counts(run: int, shares: dict[bool, float], named: float):
    """Of a shard's distinct texts: their number, the least count that is named, and the runs of such counts."""
    def work(t: pa.Table) -> pa.Table:
        _, one = np.unique(t.column("th").to_numpy(), return_index=True)
        words = [[w.encode() for b in p for w in b.split()] for p in t.column("blocks").take(one).to_pylist()]
        h = hash_words([w for p in words for w in p])
        many = repeated_runs(h, np.repeat(np.arange(len(words)), [len(p) for p in words]), run)
        declared = t.column("declared")[0].as_py()
        least = max(1, math.ceil(named * shares[declared] * len(words)))
        at = np.flatnonzero(many >= least)
        runs, first = np.unique(Ranges(h).of(at, at + run).view(np.int64), return_index=True)
        return pa.table({"host": t.column("host").slice(0, 1), "declared": [declared], "texts": [len(words)], "least": [least],
                         "runs": pa.array([[{"run": int(x), "n": int(y)} for x, y in zip(runs, many[at][first])]],
                                          pa.list_(pa.struct([("run", pa.int64()), ("n", pa.int64())])))})
    return work


def _carried(run: int):
    """Of the runs asked for, those that each text carries."""
    def work(it):
        for batch in it:
            has = [np.intersect1d(_page_runs(p, run), asked) for p, asked in zip(*(batch.column(c).to_pylist() for c in ("blocks", "asked")))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("host", "declared", "th")), pa.array(has, pa.list_(pa.int64()))],
                                             ["host", "declared", "th", "runs"])
    return work


def _drop_runs(run: int):
    def work(it):
        for batch in it:
            out = []
            for p, bad in zip(*(batch.column(c).to_pylist() for c in ("blocks", "bad"))):
                if bad:
                    words = [b.split() for b in p]
                    starts = np.zeros(sum(map(len, words)), bool)
                    runs = _page_runs(p, run)
                    starts[: len(runs)] = np.isin(runs, np.asarray(bad, np.int64))
                    p = _without(words, _covered(starts, run))
                out.append(p)
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(out, pa.list_(pa.string()))],
                                             ["page_id", "url", "blocks"])
    return work


def boilerplate(pages: DataFrame, run: int, furniture: float, least_pages: int, open_share: float, open_pages: int,
                named: float = 0.5) -> DataFrame:
    """Hashes of the runs that enough distinct texts of a host carry: host, declared, bad.

    A shard names its runs of at least ``named`` times the share (``least`` texts; ``named`` is 1 at most), so a
    run that it does not name has at most ``least - 1`` texts there."""
    texts = pages.select("host", "html", "shards").mapInArrow(
        _parse_distinct, "host string, declared boolean, th long, shard long, blocks array<string>")
    key = ["host", "declared"]
    shards = materialize(texts.groupBy(*key, "shard").applyInArrow(
        _shard_counts(run, {True: furniture, False: open_share}, named),
        "host string, declared boolean, texts long, least long, runs array<struct<run:long,n:long>>"), "shard_runs")
    share, least = (F.when(F.col("declared"), F.lit(x)).otherwise(F.lit(y)) for x, y in ((furniture, open_share), (least_pages, open_pages)))
    hosts = shards.groupBy(*key).agg(F.sum("texts").alias("texts"), F.sum(F.col("least") - 1).alias("unnamed"))
    hosts = hosts.select(*key, "unnamed", F.greatest(least.cast("double"), share * F.col("texts")).alias("need"))
    runs = shards.select(*key, "least", F.explode("runs").alias("r")).groupBy(*key, F.col("r.run").alias("run")).agg(
        F.sum("r.n").alias("n"), F.sum(F.col("least") - 1).alias("own"))
    runs = materialize(runs.join(hosts, key).where("n + unnamed - own >= need").select(*key, "run", "n", "need"), "host_runs")
    sure = runs.where("n >= need").select(*key, "run")
    open_ = runs.where("n < need")
    if not open_.isEmpty():
        asked = open_.groupBy(*key).agg(F.collect_list("run").alias("asked"))
        has = texts.join(asked, key).select(*key, "th", "blocks", "asked").mapInArrow(
            _carried(run), "host string, declared boolean, th long, runs array<long>")
        counts = has.select(*key, "th", F.explode("runs").alias("run")).groupBy(*key, "run").agg(F.count_distinct("th").alias("all"))
        sure = sure.union(open_.join(counts, [*key, "run"]).where(F.col("all") >= F.col("need")).select(*key, "run"))
    return materialize(sure.groupBy(*key).agg(F.collect_list("run").alias("bad")), "boilerplate")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", run: int = RUN,
            furniture: float = 0.9, least_pages: int = 10, open_share: float = 0.5, open_pages: int = 3,
            shard_pages: int = SHARD_PAGES) -> DataFrame:
    """One row per page: page_id, url, blocks (the kept ones in page order)."""
    p = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
                     F.coalesce(host(F.col(url_col)), F.lit("")).alias("host"))
    # hosts of several shards only; stored, so that its size is known when the join is planned
    hosts = materialize(p.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / shard_pages).alias("shards")).where("shards > 1"), "hot_hosts")
    p = p.join(hosts, "host", "left").withColumn("shards", F.coalesce("shards", F.lit(1)).cast("long"))
    fields = "page_id long, url string, host string, declared boolean, blocks array<string>"
    parse = lambda d: d.select("page_id", "url", "html", "host").mapInArrow(_parse, fields)
    rules = (run, furniture, least_pages, open_share, open_pages)
    done = parse(p.where("shards = 1")).groupBy("host", "declared").applyInArrow(_shard(*rules), "page_id long, url string, blocks array<string>")
    many = p.where("shards > 1")
    rest = parse(many).join(boilerplate(many, *rules), ["host", "declared"], "left").select("page_id", "url", "blocks", "bad").mapInArrow(
        _drop_runs(run), "page_id long, url string, blocks array<string>")
    return done.unionByName(rest)
