"""Main text of pages: structure first, and suffix arrays over the pages of a host for what structure doesn't settle.

A page is read into blocks of text. Blocks inside ``article`` or ``main`` may be its text, but for menus,
headers, footers, asides, forms, scripts, notices, adverts and comments in there (by element, role or a
word of class or id). All blocks go to their host, whose pages have two suffix arrays:

* Inside of articles. A run of ``least`` tokens that stands in more than half of the host's articles, ``few`` at least,
  is a notice, menu or advert that no element tells. A block that such runs cover whole is dropped; parts of
  blocks never are, as sentences of prose repeat, too. Copies aren't notices: an article half of which or more is
  covered by what most articles of its array hold doesn't count for a run, and an article of nothing but notices stays whole.
* Outside of articles, boilerplate and not. The common prefix lengths give every run of ``least`` or more tokens that
  stands in two distinct pages, and what such runs cover is boilerplate: ``repeated`` is how many tokens that are.
  A page without an article keeps the runs that are its own: of every block that is not boilerplate by its
  structure, the tokens that no repeated run covers.

A host with more pages than ``group_pages``, or more html than ``group_bytes``, is cut in groups of about that size by
a hash of the page, so that a hot host fills no task. What the arrays of its groups find is settled over the whole host:
outside of articles Spark counts hashes of all windows of ``least`` tokens, and those on two distinct pages are sent to the
groups they stand in and cover there; inside, a run in more than half of the articles is so in one group at least,
and the runs that are so in a group are counted in the arrays of all groups. Pages are shuffled once, for all steps.

Defined results: null or empty html has empty text; cut-off markup ends where it ends; entities that
are cut off stay as they are; a null address has the host ''; pages that share an id are distinct pages;
other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslens.llm import frames, textcore
from newslens.llm.fm_index import suffix_array
from newslens.llm.jaccard_join import _groups
from newslens.settings import stored

LEAST = 6
FEW = 5
GROUP_PAGES = 512
GROUP_BYTES = 8 << 20

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|svg|iframe|object|select)\b.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)|</?([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_WORD = re.compile(r"[a-z0-9]+")
_STATES = set("has have with without no not is hide show layout page post single theme body".split())  # has-sidebar is no sidebar
_SPACE = re.compile(r"\s+")
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr br img input button".split()
)
_APART = set("nav header footer aside form button menu dialog fieldset title head".split())
_ROLES = set("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
_MARKS = set(
    "ad ads advert adverts advertisement sponsor sponsored promo promotion banner cookie cookies consent notice notices "
    "sidebar menu nav navbar navigation breadcrumb breadcrumbs footer masthead comment comments disqus related share sharing "
    "social newsletter subscribe popup modal widget toolbar login signup paywall".split()
)
_BODY = {"article", "main"}
APART, BODY, REST = 0, 1, 2
BOX, DOUBTFUL = 3, 4  # while a page is read: in an element that only its class sets apart, and in an article in there


def _marked(value: str) -> bool:
    """Whether a class or id says that the element isn't the article's."""
    for name in value.split():
        words = _WORD.findall(name)
        if not _MARKS.isdisjoint(words) and words[0] not in _STATES:
            return True
    return False


def _set_apart(tag: str, attributes: str) -> int | None:
    """APART by element, role or hiding, BOX by a word of class or id, None if neither. A word doesn't set articles apart."""
    if tag in _APART:
        return APART
    if tag in ("body", "html") or not attributes.strip():
        return None
    box = None
    for name, *values in _ATTRIBUTE.findall(attributes):
        value = next((v for v in values if v), "").lower()
        if name.lower() == "role":
            if value in _ROLES:
                return APART
        elif name.lower() in ("hidden", "aria-hidden"):
            if value != "false":
                return APART
        elif tag not in _BODY and _marked(value):
            box = BOX
    return box


def _below(state: int, tag: str, attributes: str) -> int:
    """What text in an element is, given what it is around it."""
    if state == APART:
        return APART
    apart = _set_apart(tag, attributes)
    if apart is not None:
        return APART if apart == APART or state == DOUBTFUL else BOX
    if tag in _BODY:
        return {REST: BODY, BOX: DOUBTFUL}.get(state, state)
    return state


def blocks(page: str) -> list[tuple[int, str]]:
    """(APART, BODY or REST, text) of every block of text, in page order. An article in an element that only its class
    sets apart is BODY where the page has no other, else APART. Every step takes constant time but for elements it closes."""
    out: list[tuple[int, str]] = []
    stack: list[tuple[str, int]] = []  # open elements, and what text in them is
    is_open: Counter[str] = Counter()  # block elements
    inline: list[Counter[str]] = [Counter()]  # inline elements in each open block: their ends close no block
    parts: list[str] = []
    state, at = REST, 0

    def close(depth: int) -> None:
        nonlocal state
        now = stack[depth - 1][1] if depth else REST
        if now != state:
            end()
        while len(stack) > depth:
            gone = stack.pop()[0]
            if gone not in _INLINE:
                inline.pop()
            (inline[-1] if gone in _INLINE else is_open)[gone] -= 1
        state = now

    def end() -> None:
        text = _SPACE.sub(" ", entities.unescape("".join(parts))).strip()
        parts.clear()
        if text:
            out.append((state, text))

    for found in _TOKEN.finditer(page):
        if found.start() > at:
            parts.append(page[at : found.start()])
        at = found.end()
        tag = (found.group(2) or "").lower()
        if not tag:
            continue
        if tag == "br":
            parts.append(" ")
        if tag in _VOID:
            if tag == "hr":
                end()
            continue
        closing = page.startswith("</", found.start())
        if tag not in _INLINE:
            end()
        if closing:
            if (inline[-1] if tag in _INLINE else is_open)[tag]:
                depth = len(stack) - 1
                while stack[depth][0] != tag:
                    depth -= 1
                close(depth)
            continue
        if tag in ("p", "li") and is_open[tag]:
            depth = len(stack) - 1
            while depth > len(stack) - 4 and depth and stack[depth][0] in _INLINE:
                depth -= 1
            if stack[depth][0] == tag:
                close(depth)
        if not found.group(3).rstrip().endswith("/"):
            now = _below(state, tag, found.group(3))
            if now != state:
                end()
            stack.append((tag, now))
            (inline[-1] if tag in _INLINE else is_open)[tag] += 1
            if tag not in _INLINE:
                inline.append(Counter())
            state = now
    if at < len(page):
        parts.append(page[at:])
    end()
    alone = all(k != BODY for k, _ in out)
    return [({BOX: APART, DOUBTFUL: BODY if alone else APART}.get(k, k), text) for k, text in out]


def repeated(tokens: np.ndarray, pages: np.ndarray, least: int) -> np.ndarray:
    """Which tokens lie in a run of ``least`` or more that stands in two distinct pages.

    ``tokens`` are positive numbers, with one of its own after each block; ``pages`` the page of each.
    """
    covered = np.zeros(len(tokens) + 1, np.int64)
    if len(tokens) < 2 * least:
        return covered[:-1] > 0
    order = suffix_array(tokens)
    # length of the common prefix of neighbours in the array, as far as ``least`` and then to its end
    a, b = order[:-1], order[1:]
    length = np.zeros(len(a), np.int64)
    alive = np.arange(len(a))
    padded = np.concatenate([tokens, [0]])
    while len(alive):
        x, y = a[alive] + length[alive], b[alive] + length[alive]
        same = (np.maximum(x, y) < len(tokens)) & (padded[np.minimum(x, len(tokens))] == padded[np.minimum(y, len(tokens))])
        alive = alive[same]
        length[alive] += 1
    # suffixes that share ``least`` tokens are a stretch of the array; it counts if two pages are in it
    far = length >= least
    group = np.concatenate([[0], np.cumsum(~far)])
    page = pages[order]
    low = np.full(group[-1] + 1, np.iinfo(np.int64).max)
    high = np.full(group[-1] + 1, -1)
    np.minimum.at(low, group, page)
    np.maximum.at(high, group, page)
    two = (low < high)[group]
    # from such a place on, the longest run shared with a suffix of another page covers
    reach = np.where(two, least, 0)
    other = far & (page[:-1] != page[1:])
    reach[:-1] = np.maximum(reach[:-1], np.where(other, length, 0))
    reach[1:] = np.maximum(reach[1:], np.where(other, length, 0))
    some = reach > 0
    np.add.at(covered, order[some], 1)
    np.add.at(covered, np.minimum(order[some] + reach[some], len(tokens)), -1)
    return np.cumsum(covered)[:-1] > 0


def _tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of ``texts``, and the text of each."""
    data = np.frombuffer("\n".join([*texts, ""]).encode(), np.uint8)  # blocks have no white space but single spaces
    ends = np.flatnonzero((data == 0x20) | (data == 0x0A))
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    last = np.flatnonzero(data[ends] == 0x0A)  # last token of each text
    return textcore.span_hashes(data, starts, ends), np.searchsorted(last, np.arange(len(ends)))


def _starts(text: np.ndarray, least: int) -> np.ndarray:
    """Tokens at which windows of ``least`` tokens of one text begin."""
    return np.flatnonzero(text[least - 1 :] == text[: max(len(text) - least + 1, 0)])


def _window_hashes(hashes: np.ndarray, at: np.ndarray, least: int) -> np.ndarray:
    out = np.zeros(len(at), textcore.U64)
    for k in range(least):
        out = textcore.mix(out * textcore.U64(0x9E3779B97F4A7C15) + hashes[at + k])
    return out


def _windows(texts: list[str], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Where in the tokens of ``texts`` (all in a row, one after each text) windows of ``least`` tokens begin, and their hashes."""
    hashes, text = _tokens(texts)
    at = _starts(text, least)
    return at + text[at], _window_hashes(hashes, at, least)


def _cover(size: int, at: np.ndarray, least: int) -> np.ndarray:
    """Which of ``size`` places the windows that begin at ``at`` cover."""
    steps = np.bincount(at, minlength=size + 1) - np.bincount(at + least, minlength=size + 1)
    return np.cumsum(steps)[:size] > 0


def _article_blocks(articles: list[str]) -> tuple[list[str], np.ndarray]:
    """The blocks of all articles, and the article of each."""
    split = [article.split("\n\n") for article in articles]
    return [text for article in split for text in article], np.repeat(np.arange(len(split)), [len(article) for article in split])


def standing(articles: list[str], least: int, few: int, asked: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of windows of ``least`` tokens in a group's articles, and in how many articles each stands, copies left out:
    of those that stand in more than half of the articles, or of those ``asked`` for.

    A copy is an article half of whose tokens or more lie in windows that stand in more than half of the articles, ``few`` at least.
    """
    texts, of = _article_blocks(articles)
    hashes, text = _tokens(texts)
    number = np.unique(hashes, return_inverse=True)[1]
    size = len(hashes) + len(texts)
    at = np.arange(len(hashes)) + text
    stream, owner, is_window = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, bool)
    stream[at], owner[at] = number + 1, of[text]
    stream[stream == 0] = len(hashes) + 1 + np.arange(len(texts))  # no run reaches over the end of a block
    is_window[at[_starts(text, least)]] = True
    # suffixes that share ``least`` tokens are a stretch of the array
    order = suffix_array(stream)
    order = order[is_window[order]]
    same = np.ones(max(len(order) - 1, 0), bool)
    for k in range(least):
        same &= stream[order[:-1] + k] == stream[order[1:] + k]
    stretch = np.cumsum(np.concatenate([[0], ~same]))[: len(order)]
    first = order[np.concatenate([[True], ~same])[: len(order)]]
    many = 2 * np.bincount(stretch, minlength=len(first)) > len(articles)
    if asked is None:
        wanted = many
    else:
        wanted = np.isin(_window_hashes(hashes, np.searchsorted(at, first), least), asked)
    some = (many | wanted)[stretch]
    pairs = np.unique(stretch[some] * len(articles) + owner[order[some]])
    run, page = pairs // len(articles), pairs % len(articles)
    counts = np.bincount(run, minlength=len(first))
    common = (2 * counts > len(articles)) & (counts >= few)
    if common.any():
        covered = _cover(size, order[common[stretch]], least)
        copy = 2 * np.bincount(owner[covered], minlength=len(articles)) >= np.bincount(of[text], minlength=len(articles))
        counts = np.bincount(run[~copy[page]], minlength=len(first))
    keep = wanted & (2 * counts > len(articles)) if asked is None else wanted
    place = np.searchsorted(at, first[keep])
    return _window_hashes(hashes, place, least), counts[keep]


def _without_notices(articles: list[str], notices: np.ndarray, least: int) -> list[str]:
    """The articles without blocks all of whose tokens lie in windows of ``notices``; whole where these are all of an article."""
    texts, of = _article_blocks(articles)
    hashes, text = _tokens(texts)
    at = _starts(text, least)
    covered = _cover(len(hashes), at[np.isin(_window_hashes(hashes, at, least), notices)], least)
    whole = np.bincount(of[text], covered, minlength=len(articles)) == np.bincount(of[text], minlength=len(articles))
    gone = np.bincount(text, covered, minlength=len(texts)) == np.bincount(text, minlength=len(texts))
    kept: list[list[str]] = [[] for _ in articles]
    for k in np.flatnonzero(~gone | whole[of]).tolist():
        kept[of[k]].append(texts[k])
    return ["\n\n".join(page) for page in kept]


def _host_texts(pages: list[list[tuple[int, str]]], seeds: np.ndarray, least: int) -> tuple[list[str], list[int]]:
    """Of every page of a group, given its blocks outside of articles: the text that no repeated run covers, and how
    many tokens they cover. ``seeds`` are hashes of windows that repeat on the host, if this is not all of it."""
    number: dict[str, int] = {}
    split = [[(kind, text.split(" ")) for kind, text in page] for page in pages]
    for page in split:
        for _, tokens in page:
            for token in tokens:
                number.setdefault(token, len(number) + 1)
    stream, owner, gap = [], [], len(number) + 1
    for k, page in enumerate(split):
        for _, tokens in page:
            stream += [number[t] for t in tokens]
            stream.append(gap)  # no run reaches over the end of a block
            gap += 1
            owner += [k] * (len(tokens) + 1)
    covered = repeated(np.array(stream, np.int64), np.array(owner, np.int64), least)
    if len(seeds):
        at, hashes = _windows([text for page in pages for _, text in page], least)
        at = at[np.isin(hashes, seeds)]
        for k in range(least):
            covered[at + k] = True
    texts, counts, at = [], [], 0
    for page in split:
        kept, count = [], 0
        for kind, tokens in page:
            mask = covered[at : at + len(tokens)].tolist()
            at += len(tokens) + 1
            count += sum(mask)
            if kind == REST:
                rest = " ".join(t for t, gone in zip(tokens, mask, strict=True) if not gone)
                if rest:
                    kept.append(rest)
        texts.append("\n\n".join(kept))
        counts.append(count)
    return texts, counts


_DEALT = ["host_key", "group"]


def _read(rows: DataFrame) -> DataFrame:
    """row, the blocks inside of the article (joined; null for a page without one) and those outside of it."""
    block = T.ArrayType(T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("text", T.StringType())]))
    block_type = pa.list_(pa.struct([("kind", pa.int32()), ("text", pa.string())]))
    kept = ["row", *_DEALT, "groups"]
    schema = T.StructType([*[rows.schema[c] for c in kept], T.StructField("text", T.StringType()), T.StructField("blocks", block)])
    names = schema.names

    def cut(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                found = [blocks(page or "") for page in part.column("text").to_pylist()]
                texts = ["\n\n".join(t for k, t in page if k == BODY) if any(k == BODY for k, _ in page) else None for page in found]
                rest = [[{"kind": k, "text": t} for k, t in page if k != BODY] for page in found]
                columns = [part.column(c) for c in kept]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string()), pa.array(rest, block_type)], names=names)

    return rows.mapInArrow(cut, schema)


def _host_windows(dealt: DataFrame, least: int) -> DataFrame:
    """host_key, group and window: hashes of windows outside of articles that stand on two distinct pages of a host
    of several groups, once per group of theirs."""

    def cut(batches):
        for table in _groups(batches, _DEALT):
            if table.column("groups")[0].as_py() > 1:
                key, group = (table.column(c)[0].as_py() for c in _DEALT)
                found = [np.unique(_windows([b["text"] for b in page], least)[1]) for page in table.column("blocks").to_pylist()]
                page = np.repeat((group << 32) + np.arange(len(found)), [len(f) for f in found])
                window = np.concatenate(found)
                order = np.lexsort((page, window))
                window, page = window[order].view(np.int64), page[order]
                new = np.concatenate([[True], window[1:] != window[:-1]])[: len(window)]
                low, high = page[new], page[np.concatenate([new[1:], [True]])[: len(window)]]
                columns = [pa.repeat(pa.scalar(key, pa.int64()), len(low)), pa.repeat(pa.scalar(group, pa.int32()), len(low))]
                columns += [pa.array(window[new]), pa.array(low), pa.array(high)]
                yield pa.RecordBatch.from_arrays(columns, names=[*_DEALT, "window", "low", "high"])

    counted = (
        dealt.mapInArrow(cut, "host_key long, group int, window long, low long, high long")
        .groupBy("host_key", "window")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"), F.collect_set("group").alias("in"))
    )
    return counted.where(F.col("low") < F.col("high")).select("host_key", F.explode("in").alias("group"), "window")


def _notices(dealt: DataFrame, least: int, few: int) -> DataFrame:
    """host_key, group and window: hashes of windows that stand in more than half of a host's articles, once per group of the host.

    What does so on the host does so in one of its groups at least: the arrays of the groups give candidates, those of
    the hosts that have any count them.
    """

    def look(batches):
        for table in _groups(batches, _DEALT):
            articles = table.column("text").drop_null().to_pylist()
            windows, counts = standing(articles, least, few)
            key, groups = (table.column(c)[0].as_py() for c in ("host_key", "groups"))
            if groups == 1:
                windows = windows[counts >= few]
            if articles and (groups > 1 or len(windows)):
                columns = [pa.array([key]), pa.array([groups], pa.int32()), pa.array([len(articles)])]
                columns.append(pa.array([windows.view(np.int64)], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names=["host_key", "groups", "articles", "windows"])

    def count(batches):
        for table in _groups(batches, _DEALT):
            asked = np.array(table.column("windows")[0].as_py(), np.int64).view(textcore.U64)
            windows, counts = standing(table.column("text").drop_null().to_pylist(), least, few, asked)
            key, groups, articles = (table.column(c)[0].as_py() for c in ("host_key", "groups", "articles"))
            size = len(windows)
            columns = [pa.repeat(pa.scalar(key, pa.int64()), size), pa.repeat(pa.scalar(groups, pa.int32()), size)]
            columns += [pa.repeat(pa.scalar(articles, pa.int64()), size), pa.array(windows.view(np.int64)), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["host_key", "groups", "articles", "window", "n"])

    every_group = F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("group")
    hosts = (
        dealt.mapInArrow(look, "host_key long, groups int, articles long, windows array<long>")
        .groupBy("host_key")
        .agg(
            F.max("groups").alias("groups"),
            F.sum("articles").alias("articles"),
            F.array_distinct(F.flatten(F.collect_list("windows"))).alias("windows"),
        )
        .where(F.size("windows") > 0)
        .select("host_key", every_group, "articles", "windows")
    )
    counted = (
        dealt.join(hosts, _DEALT)
        .sortWithinPartitions(*_DEALT)
        .mapInArrow(count, "host_key long, groups int, articles long, window long, n long")
        .groupBy("host_key", "window")
        .agg(F.max("groups").alias("groups"), F.max("articles").alias("articles"), F.sum("n").alias("n"))
    )
    return counted.where((2 * F.col("n") > F.col("articles")) & (F.col("n") >= few)).select("host_key", every_group, "window")


def extract(
    pages: DataFrame,
    *,
    url: str = "url",
    html: str = "html",
    keep: list[str] | None = None,
    least: int = LEAST,
    few: int = FEW,
    group_pages: int = GROUP_PAGES,
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """The ``keep`` columns (default: all but the html) with ``text`` and ``repeated``, the number of tokens
    outside of articles that repeated runs of the host cover."""
    keep = [c for c in pages.columns if c != html] if keep is None else [c for c in keep if c != html]
    host = F.regexp_extract(F.lower(F.coalesce(F.col(frames.quoted(url)).cast("string"), F.lit(""))), r"^[a-z]+://([^/?#:]*)", 1)
    own = [F.col(frames.quoted(c)) for c in keep] or [F.lit(None).cast("int").alias("none")]
    rows = pages.select(F.struct(*own).alias("row"), F.col(frames.quoted(html)).cast("string").alias("text"), host.alias("host"))
    share = F.greatest(F.count("*") / group_pages, F.sum(F.octet_length("text")) / group_bytes)
    large = stored(rows.groupBy("host").agg(F.ceil(share).cast("int").alias("groups")).where("groups > 1"), "hosts")
    rows = rows.join(large, "host", "left").withColumn("groups", F.coalesce("groups", F.lit(1)))  # hosts of one group aren't in there
    # never null, else the join below would filter nulls out in a shuffle of its own
    group = F.coalesce(F.pmod(F.xxhash64("row", "text"), "groups").cast("int"), F.lit(0))
    read = _read(rows.select("row", "text", F.xxhash64("host").alias("host_key"), group.alias("group"), "groups"))
    dealt = read.repartition(*_DEALT)  # every step below reads this one shuffle
    in_order = dealt.sortWithinPartitions(*_DEALT)
    outside = _host_windows(in_order, least).withColumn("inside", F.lit(False))
    found = outside.unionByName(_notices(in_order, least, few).withColumn("inside", F.lit(True)))
    schema = T.StructType([rows.schema["row"], *T.StructType.fromDDL("text string, repeated long").fields])

    def work(table: pa.Table, windows: pa.Table) -> pa.Table:
        hashes, inside = windows.column("window").to_numpy().view(textcore.U64), windows.column("inside").to_numpy()
        pieces = [[(b["kind"], b["text"]) for b in page] for page in table.column("blocks").to_pylist()]
        texts, covered = _host_texts(pieces, hashes[~inside], least)
        articles = table.column("text").to_pylist()
        whole = [k for k, article in enumerate(articles) if article is not None]
        for k, text in zip(whole, _without_notices([articles[k] for k in whole], hashes[inside], least), strict=True):
            texts[k] = text
        row = table.column("row").combine_chunks()
        return pa.table([row, pa.array(texts, pa.string()), pa.array(covered, pa.int64())], names=schema.names)

    done = dealt.groupBy(*_DEALT).cogroup(found.groupBy(*_DEALT)).applyInArrow(work, schema)
    return frames.unpack(done, html, keep, text=F.col("text"), repeated=F.col("repeated"))


def op4(spark, sf_dir: str) -> DataFrame:
    found = extract(spark.read.parquet(f"{sf_dir}/pages.parquet"), keep=["page_id", "url"])
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "repeated")
