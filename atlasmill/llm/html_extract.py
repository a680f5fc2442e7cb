"""Main text of web pages: every block of every page goes through the suffix arrays of its host, and markup roles filter what they leave.

1. A page is parsed into blocks. All of them, menus and adverts too, are the page's token stream; only
   scripts, styles and other raw text are no blocks. A first pass gives each distinct stream an id, its
   size and a MinHash signature of its candidates (the blocks that markup does not rule out).
2. Copies of a stream are one page. Near copies are one story: pages of a host that share a band of their
   signatures and have an estimated Jaccard similarity of ``LIKE`` of their 5-grams are linked, and a
   story is a component of such links. The least page of each story represents it.
3. The streams of a host's stories are concatenated and their suffix array (sorted to ``WINDOW`` tokens)
   finds the windows that are on many distinct pages: at least ``PAGES`` and ``SHARE`` of the host's
   stories. Runs of such windows are the long repeated substrings.
4. A last pass over all pages marks the tokens covered by repeated windows. A block of which ``COVER`` or
   more is covered is boilerplate and goes, other blocks stay whole, so an article that quotes a passage
   which other pages have too loses nothing. Of the blocks left, those stay which markup does not rule
   out: nothing in elements whose name, role or class says menu, header, footer, sidebar, notice, advert,
   form or comments, and if the page has a main element (or else an article) only what is inside, with
   the headline (h1) wherever it is. Unique adverts and readers' comments can only be known by markup.

A host with more than ``CHUNK`` bytes of distinct streams is dealt to several suffix arrays by the page's
hash; each sends the windows that are on ``SHARE`` / 4 of its stories with their count, and the counts are
added up, so no task gets a whole hot host. Where what chunks may not have sent could decide, the window is
counted again over the host's pages, so results do not depend on the number of chunks. A host's repeated windows are at most 1 / ``SHARE`` times the tokens of its average
page; they are joined to the pages by host. Page texts are shuffled once, for the arrays.

Nulls: null html is empty (text ``''``); a null url has the empty host. Unclosed and cut off markup is
closed by the end of the page; parsing is linear in the page's length, and a very long page is a slice of
its own. Repeated rows get equal texts; a page of boilerplate alone gets ``''``; an empty table gives an
empty result; input columns named like a result are replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atlasmill.functions.components import connected_components
from atlasmill.functions.lineage import materialize
from atlasmill.llm.common import small_batches, text_slices, without
from atlasmill.llm.ngram_join import _P, gram_hashes, mix, rolled, word_hashes

WINDOW = 8
#: A window is repeated if it is on so many distinct pages of its host and on such a share of them: what fewer share are quotes and reposts.
PAGES = 10
SHARE = 0.3
COVER = 0.8
CHUNK = 2 << 20
#: Bands and rows of the signatures (recall 0.98 at 0.8, 0.9998 at 0.9) and the estimated similarity of near copies.
BANDS, ROWS, LIKE = 10, 5, 0.8
# fixed values: names of HTML elements by role, and words in class or id attributes that name what is not the article
RAW = {"script", "style", "textarea", "title", "xmp", "noframes", "iframe", "noembed"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
DROP = {"nav", "footer", "aside", "form", "head", "noscript", "template", "svg", "button", "select", "option", "dialog", "menu", "object", "canvas", "video", "audio", "math", "datalist", "map"} | RAW
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "output", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
DROP_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "alertdialog", "dialog", "menu", "menubar", "toolbar"}
DROP_WORDS = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertisements", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "commentlist", "consent", "cookie", "cookies", "disclaimer", "disqus", "footer", "gdpr", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "popup", "promo", "promoted", "related", "replies", "respond", "share", "sharing", "sidebar", "social", "sponsor", "sponsored", "subscribe", "topbar", "widget"}
CLOSES_ITSELF = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
#: words that may stand beside one of DROP_WORDS in a class or id
BESIDE = {"area", "articles", "bar", "block", "bottom", "box", "button", "buttons", "container", "content", "footer", "form", "header", "icon", "icons", "inner", "item", "items", "left", "link", "links", "list", "main", "message", "outer", "page", "panel", "post", "posts", "primary", "right", "secondary", "section", "site", "slot", "stories", "text", "title", "top", "unit", "user", "wrapper"}
READERS = {"comment", "comments", "reply", "replies"}
SCOPE = {"article", "main", "div", "section", "ul", "ol", "dl", "table", "body", "blockquote", "td", "th"}

_MARKUP = re.compile(r"<!--.*?(?:-->|$)|<(?:!|\?)[^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)|</?[a-zA-Z][^>]*(?:>|$)|</[^>]*(?:>|$)", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z][\w:-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
LOOSE, MAIN, ARTICLE = 0, 1, 2


def _names_other(value: str) -> bool:
    """Whether a class or id attribute says that the element is not article text."""
    for token in value.split():
        parts = [p for p in re.split(r"[^a-z0-9]+", token) if p]
        if "".join(parts) in DROP_WORDS or (not DROP_WORDS.isdisjoint(parts) and all(p in DROP_WORDS or p in BESIDE or p.isdigit() for p in parts)):
            return True
    return False


def _role(name: str, attributes: str, inside: int) -> tuple[bool, int]:
    """(dropped, zone bits) that an element opens."""
    drop, zone = name in DROP or (name == "header" and not inside), {"article": ARTICLE, "main": MAIN}.get(name, LOOSE)
    if attributes and not drop:
        for key, a, b, c in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), (a or b or c).lower()
            if key in ("class", "id"):
                if name == "article":
                    drop = drop or any(t in READERS or t.startswith("comment-") for t in value.split())
                elif name not in ("html", "body", "main"):
                    drop = drop or _names_other(value)
            elif key == "role":
                drop = drop or value in DROP_ROLES or value == "comment"
                zone |= {"main": MAIN, "article": ARTICLE}.get(value, LOOSE)
            elif key == "hidden" or (key == "aria-hidden" and value == "true"):
                drop = True
            elif key == "itemprop":
                zone |= ARTICLE if value == "articlebody" else LOOSE
                drop = drop or value == "comment"
    return drop, zone


def blocks(html: str) -> list[tuple[bool, int, bool, str]]:
    """(dropped, zone bits, in a headline, text) of each block, in page order; references decoded, white space collapsed."""
    out: list[tuple[bool, int, bool, str]] = []
    stack: list[tuple[str, bool, int, bool]] = []  # name, dropped, zone, headline: all including what is around
    frames: list[Counter] = [Counter()]  # open elements by name since each open element of SCOPE, so that no search is in vain
    everywhere: Counter = Counter()
    parts: list[str] = []
    now = free = (False, LOOSE, False)

    def close() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append((*now, text))
            parts.clear()

    def pop_from(k: int) -> None:
        for name, *_ in reversed(stack[k:]):
            everywhere[name] -= 1
            if name in SCOPE:
                frames.pop()
            frames[-1][name] -= 1
        del stack[k:]

    at, end = 0, len(html)
    while at < end:
        found = _MARKUP.search(html, at)
        stop = found.start() if found else end
        if stop > at:
            parts.append(unescape(html[at:stop]))
        if not found:
            break
        at = found.end()
        name = (found.group(2) or "").lower()
        if not name:
            continue
        if name not in INLINE:
            close()
        if found.group(1):
            if (frames[-1][name] if name in INLINE else everywhere[name]) > 0:
                k = len(stack) - 1
                while stack[k][0] != name:
                    k -= 1
                if now != (stack[k - 1][1:] if k else free):
                    close()
                pop_from(k)
        else:
            attributes = found.group(3) or ""
            if name in VOID:
                continue
            if name in CLOSES_ITSELF and any(frames[-1][x] > 0 for x in CLOSES_ITSELF[name]):
                k = len(stack) - 1
                while stack[k][0] not in CLOSES_ITSELF[name]:
                    k -= 1
                pop_from(k)
                now = stack[-1][1:] if stack else free
            drop, zone = _role(name, attributes, now[1])
            inner = (now[0] or drop, now[1] | zone, now[2] or name == "h1")
            if inner != now:
                close()
            if name in RAW:
                shut = re.compile(f"</{re.escape(name)}[^a-zA-Z0-9>]*>?", re.I).search(html, at)
                at = shut.end() if shut else end
                continue
            if not attributes.rstrip().endswith("/") or name not in ("svg", "math"):
                frames[-1][name] += 1
                everywhere[name] += 1
                if name in SCOPE:
                    frames.append(Counter())
                stack.append((name, *inner))
        now = stack[-1][1:] if stack else free
    close()
    return out


def candidates(found: list[tuple[bool, int, bool, str]]) -> list[bool]:
    """Which blocks markup leaves: all not dropped, or if some of them are in a main element (else an article) only those and headlines."""
    zones = {zone & bit for dropped, zone, _, _ in found if not dropped for bit in (MAIN, ARTICLE)}
    inside = MAIN if MAIN in zones else ARTICLE if ARTICLE in zones else LOOSE
    return [not dropped and (not inside or bool(zone & inside) or headline) for dropped, zone, headline, _ in found]


def _read(page: bytes | None) -> tuple[list[str], list[bool]]:
    """(texts of all blocks, whether each is a candidate)."""
    found = blocks((page or b"").decode("utf-8", "replace"))
    return [text for *_, text in found], candidates(found)


# --- the first pass: streams, copies and stories ---


def _stream_id(host: str, stream: str) -> bytes:
    return blake2b(f"{host}\n{stream}".encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _sketch(batches: Iterator[pa.RecordBatch], html_col: str) -> Iterator[pa.RecordBatch]:
    seeds = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * _P) | np.uint64(1)
    for rows, pages in text_slices(batches, html_col):
        hosts = rows.column("__host").to_pylist()
        ids, size, said = [], [], []
        for host, page in zip(hosts, pages, strict=True):
            texts, keep = _read(page)
            stream = " ".join(texts)
            ids.append(_stream_id(host, stream))
            size.append(len(stream.encode("utf-8", "surrogatepass")))
            said.append(" ".join(t for t, k in zip(texts, keep, strict=True) if k).encode("utf-8", "surrogatepass"))
        grams, at = gram_hashes(said)
        some = np.flatnonzero(np.diff(at))
        least = np.zeros((len(some), len(seeds)), np.int32)
        with np.errstate(over="ignore"):
            for k, seed in enumerate(seeds):
                if len(some):
                    least[:, k] = (np.minimum.reduceat(grams * seed, at[:-1][some]) >> np.uint64(33)).astype(np.int32)
        signature: list[list[int] | None] = [None] * len(pages)
        for d, row in zip(some.tolist(), least.tolist(), strict=True):
            signature[d] = row
        yield pa.RecordBatch.from_arrays([rows.column("__host"), pa.array(ids, pa.binary()), pa.array(size, pa.int64()), pa.array(signature, pa.list_(pa.int32()))], names=["__host", "page", "size", "signature"])


def stories(streams: DataFrame) -> DataFrame:
    """(__host, page) of the page that represents each story of the distinct ``streams``."""
    bands = F.array(*[F.xxhash64(F.slice("signature", ROWS * k + 1, ROWS), F.lit(k)) for k in range(BANDS)])
    banded = streams.filter("signature is not null").select("__host", "page", F.explode(bands).alias("code"))
    least = banded.groupBy("__host", "code").agg(F.min("page").alias("least"), F.max("page").alias("most")).filter("least <> most").drop("most")
    stars = banded.join(least, ["__host", "code"]).filter("page <> least").select("page", "least").distinct()
    one, other = streams.select("page", F.col("signature").alias("a")), streams.select(F.col("page").alias("least"), F.col("signature").alias("b"))
    same = F.aggregate(F.zip_with("a", "b", lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    alike = stars.join(one, "page").join(other, "least").filter(same >= LIKE * BANDS * ROWS).select("page", "least")
    found = connected_components(alike, "page", "least", "stories")
    copies = found.filter("node <> component").select(F.col("node").alias("page"))
    return streams.select("__host", "page").join(copies, "page", "left_anti")


# --- the suffix arrays ---


def window_ranks(code: np.ndarray, window: int) -> np.ndarray:
    """Rank of the window that begins at each position, by prefix doubling (the suffix array's sorting, to that depth)."""
    rank, width = np.unique(code, return_inverse=True)[1].astype(np.int64), 1
    while width < window:
        step = min(width, window - width)
        after = np.zeros(len(rank), np.int64)
        after[: max(0, len(rank) - step)] = rank[step:] + 1
        rank = np.unique(rank * (int(after.max(initial=0)) + 1) + after, return_inverse=True)[1].astype(np.int64)
        width += step
    return rank


def _often(names: np.ndarray, least: int) -> np.ndarray:
    """Which of the fingerprints occur ``least`` times or more."""
    run = np.sort(names)
    new = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]])) if len(run) else np.zeros(0, np.int64)
    found = run[new][np.diff(np.append(new, len(run))) >= least]
    if not len(found):
        return np.zeros(len(names), bool)
    return found[np.minimum(np.searchsorted(found, names), len(found) - 1)] == names


def window_pages(streams: list[bytes], window: int = WINDOW, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint of each distinct window, the number of ``streams`` it is on), of windows on ``least`` streams or more, by a suffix array over all of them; stretches without a window that occurs so often are left out before sorting."""
    words, at = word_hashes(streams)
    owner = np.repeat(np.arange(len(streams)), np.diff(at))
    inside = np.arange(len(words)) + window <= at[1:][owner] if len(words) else np.zeros(0, bool)
    place = np.flatnonzero(inside)  # no window passes the end of a page
    names = rolled(words, window)
    place = place[_often(names[place], least)]
    if not len(place):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    edge = np.zeros(len(words) + 1, np.int64)
    edge[place] += 1
    edge[place + window] -= 1
    used = np.cumsum(edge[:-1]) > 0
    rank = window_ranks(words[used], window)[np.cumsum(used)[place] - 1]
    order = np.argsort(rank, kind="stable")  # by window, then by place and so by page
    rank, page = rank[order], owner[place[order]]
    new = np.ones(len(order), bool)
    new[1:] = rank[1:] != rank[:-1]
    other = new.copy()
    other[1:] |= page[1:] != page[:-1]
    many = np.add.reduceat(other.astype(np.int64), np.flatnonzero(new))
    enough = many >= least
    return mix(names[place[order][new]][enough]), many[enough]


def _dealt_streams(batches: Iterator[pa.RecordBatch], html_col: str) -> Iterator[pa.RecordBatch]:
    """The stream of each page; one that this task has sent already is left out."""
    sent: set[bytes] = set()
    for rows, pages in text_slices(batches, html_col):
        pick, ids, packed = [], [], []
        for k, (host, page) in enumerate(zip(rows.column("__host").to_pylist(), pages, strict=True)):
            stream = " ".join(_read(page)[0])
            name = _stream_id(host, stream)
            if name not in sent:
                sent.add(name)
                pick.append(k), ids.append(name), packed.append(stream.encode("utf-8", "surrogatepass"))
        pick = pa.array(pick, pa.int64())
        yield pa.RecordBatch.from_arrays([rows.column("__host").take(pick), rows.column("chunks").take(pick), pa.array(ids, pa.binary()), pa.array(packed, pa.binary())], names=["__host", "chunks", "page", "stream"])


def _arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by host, chunk, page and kind: a page's streams count if a row without stream (it is a story) comes first, and then once."""
    now, story, streams, chunks, need = None, None, [], 1, 1

    def done() -> pa.RecordBatch:
        least = need if chunks == 1 else max(1, int(np.ceil(SHARE * len(streams) / 4)))
        windows, many = window_pages(streams, WINDOW, least)
        unsent = [0 if chunks == 1 else least - 1] * (len(many) + 1)  # the most that a window may have here without being sent
        names = pa.array([*windows.view(np.int64).tolist(), None], pa.int64())  # the last row is the chunk's own
        return pa.RecordBatch.from_arrays([pa.array([now[0]] * len(names), pa.string()), names, pa.array([*many.tolist(), 0], pa.int64()), pa.array(unsent, pa.int64()), pa.array([need] * len(names), pa.int64())], names=["__host", "window", "n", "unsent", "need"])

    for batch in batches:
        for host, chunk, many, page, stream, least in zip(*(batch.column(c).to_pylist() for c in ("__host", "chunk", "chunks", "page", "stream", "need")), strict=True):
            if (host, chunk) != now:
                if streams:
                    yield done()
                now, streams = (host, chunk), []
            if stream is None:
                story, chunks, need = page, many, least
            elif page == story:
                streams.append(stream)
                story = None
    if streams:
        yield done()


def _seen(batches: Iterator[pa.RecordBatch], html_col: str) -> Iterator[pa.RecordBatch]:
    """(__host, page, windows): which of its host's asked windows the stream of each page has; pages without are left out."""
    for rows, pages in text_slices(batches, html_col):
        hosts, ids, found = [], [], []
        for host, page, asked in zip(rows.column("__host").to_pylist(), pages, rows.column("windows"), strict=True):
            stream = " ".join(_read(page)[0])
            words, _ = word_hashes([stream.encode("utf-8", "surrogatepass")])
            if len(words) >= WINDOW:
                has = np.intersect1d(mix(rolled(words, WINDOW)[: len(words) - WINDOW + 1]).view(np.int64), asked.values.to_numpy())
                if len(has):
                    hosts.append(host), ids.append(_stream_id(host, stream)), found.append(has.tolist())
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(ids, pa.binary()), pa.array(found, pa.list_(pa.int64()))], names=["__host", "page", "windows"])


def _recounted(read: DataFrame, html_col: str, reps: DataFrame, unsure: DataFrame) -> DataFrame:
    """(__host, window) of the ``unsure`` windows that are on enough stories, counted page by page; where none is unsure no page is parsed."""
    asked = unsure.groupBy("__host").agg(F.sort_array(F.collect_list("window")).alias("windows"))
    seen = read.select("__host", html_col).join(asked, "__host").mapInArrow(lambda it: _seen(it, html_col), "__host string, page binary, windows array<long>")
    once = seen.groupBy("__host", "page").agg(F.first("windows").alias("windows")).join(reps, ["__host", "page"], "left_semi")
    counts = once.select("__host", F.explode("windows").alias("window")).groupBy("__host", "window").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(unsure, ["__host", "window"]).filter("n >= need").select("__host", "window")


def repeated_windows(read: DataFrame, html_col: str) -> DataFrame:
    """(__host, windows): the fingerprints of the windows that are on many distinct pages of the host, sorted; hosts without are left out."""
    schema = T.StructType([T.StructField("__host", T.StringType()), T.StructField("page", T.BinaryType()), T.StructField("size", T.LongType()), T.StructField("signature", T.ArrayType(T.IntegerType()))])
    sketched = read.select("__host", html_col).mapInArrow(lambda it: _sketch(it, html_col), schema)
    streams = materialize(sketched.groupBy("__host", "page").agg(F.first("size").alias("size"), F.first("signature").alias("signature")), "streams")
    reps = materialize(stories(streams), "stories")
    n = reps.groupBy("__host").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= PAGES)
    hosts = materialize(
        streams.groupBy("__host").agg(F.ceil(F.sum("size") / CHUNK).cast("int").alias("chunks")).join(n, "__host").select("__host", F.greatest(F.col("chunks"), F.lit(1)).alias("chunks"), F.greatest(F.lit(PAGES), F.ceil(F.col("n") * SHARE)).cast("long").alias("need")), "hosts"
    )
    chunk = F.pmod(F.xxhash64("page"), F.col("chunks")).cast("int").alias("chunk")
    dealt = "__host string, chunks int, page binary, stream binary"
    texts = read.select("__host", html_col).join(hosts.select("__host", "chunks"), "__host").mapInArrow(lambda it: _dealt_streams(it, html_col), dealt)
    marks = reps.join(hosts, "__host").select("__host", chunk, "chunks", "page", F.lit(None).cast("binary").alias("stream"), "need")
    rows = marks.union(texts.select("__host", chunk, "chunks", "page", "stream", F.lit(None).cast("long"))).repartition("__host", "chunk").sortWithinPartitions("__host", "chunk", "page", F.col("stream").isNotNull())
    counted = materialize(rows.mapInArrow(_arrays, "__host string, window long, n long, unsent long, need long"), "windows")
    sums = counted.filter("window is not null").groupBy("__host", "window").agg(F.sum("n").alias("n"), F.sum("unsent").alias("unsent"), F.max("need").alias("need"))
    most = counted.filter("window is null").groupBy("__host").agg(F.sum("unsent").alias("most"))
    unsure = materialize(sums.filter("n < need").join(most, "__host").filter("n + most - unsent >= need").select("__host", "window", "need"), "unsure")
    shared = sums.filter("n >= need").select("__host", "window").unionByName(_recounted(read, html_col, reps, unsure))
    return materialize(shared.groupBy("__host").agg(F.sort_array(F.collect_list("window")).alias("windows")), "repeated")


# --- the last pass: what is left of each page ---


def _covered(words: np.ndarray, windows: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Which words of one stream lie in a window of the sorted ``windows``."""
    n = len(words) - window + 1
    if n < 1 or not len(windows):
        return np.zeros(len(words), bool)
    name = mix(rolled(words, window)[:n]).view(np.int64)
    hit = windows[np.minimum(np.searchsorted(windows, name), len(windows) - 1)] == name
    edge = np.zeros(len(words) + 1, np.int64)
    edge[:n] += hit
    edge[window : n + window] -= hit
    return np.cumsum(edge[:-1]) > 0


def left_of(texts: list[str], keep: list[bool], covered: np.ndarray) -> str:
    """The candidates of which less than ``COVER`` is covered."""
    begins = np.cumsum([0, *(t.count(" ") + 1 for t in texts)])
    upto = np.concatenate([[0], np.cumsum(covered)])
    hits = upto[begins[1:]] - upto[begins[:-1]]
    own = hits < COVER * np.diff(begins)
    return " ".join(t for t, k, o in zip(texts, keep, own.tolist(), strict=True) if k and o)


def _extract(batches: Iterator[pa.RecordBatch], html_col: str, keep: list[str]) -> Iterator[pa.RecordBatch]:
    for rows, pages in text_slices(batches, html_col):
        read = [_read(p) for p in pages]
        known = rows.column("windows")
        asked = known.is_valid().to_pylist()
        words, at = word_hashes([" ".join(texts).encode("utf-8", "surrogatepass") if ask else b"" for (texts, _), ask in zip(read, asked, strict=True)])
        out, many = [], []
        for k, (texts, candidate) in enumerate(read):
            covered = _covered(words[at[k] : at[k + 1]], known[k].values.to_numpy()) if asked[k] else np.zeros(sum(t.count(" ") + 1 for t in texts), bool)
            out.append(left_of(texts, candidate, covered))
            many.append(int(covered.sum()))
        yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in keep], pa.array(out, pa.string()), pa.array(many, pa.int64())], names=[*keep, "text", "n_repeated"])


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (id and url, if not given) with ``text``, ``n_chars`` and ``n_repeated`` (words covered by repeated windows) of every row."""
    small_batches(pages.sparkSession, 500)
    made = ["text", "n_chars", "n_repeated"]
    pages = without(pages, [c for c in made if c not in (id_col, url_col, html_col)])
    keep = [id_col, url_col] if keep is None else [c for c in keep if c in pages.columns]
    read = pages.select(*dict.fromkeys([*keep, html_col]), host_of(F.col(url_col)).alias("__host"))
    known = repeated_windows(read, html_col)
    schema = T.StructType([*[read.schema[c] for c in keep], T.StructField("text", T.StringType()), T.StructField("n_repeated", T.LongType())])
    found = read.join(known, "__host", "left").mapInArrow(lambda it: _extract(it, html_col, keep), schema)
    return found.select(*keep, "text", F.length("text").cast("long").alias("n_chars"), "n_repeated")
