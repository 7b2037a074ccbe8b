"""Main text of web pages: page structure and a suffix array for each host.

A page is split into blocks of text, each in one of three zones: ``chrome``
(menus, headers, footers, sidebars, notices, adverts, forms, comments, told by
element names, by roles and by class names and ids that as a whole name such a part), ``article`` (inside an
article or main element) and ``plain`` (neither).  Such names, and a form, say
nothing of a wrapper that holds the page's main article (its largest, and not
one among comments or adverts if there is another); articles inside an article
are its parts.  An element so named that holds most of the page's text outside
of links is plain, unless it is named for comments, adverts or the like.
Scripts, styles, markup and buttons (but as headings) are in no block.

Structure decides first: chrome goes, and beside an article plain blocks that
are mostly links.  The rest is decided by repetition on the host, by a suffix
array over the pages' token streams.  A page has two streams: ``article``, the
running text of its articles, and ``open``, everything else.  Plain blocks and
article blocks that are mostly links lose the runs of ``MIN_RUN`` tokens or
more that the open streams of at least ``MIN_PAGES`` different pages share.
Running text loses only runs that the article streams of more than half of the
host's pages, and of ``MIN_PAGES`` at least, share, as copies and quoted
passages are text.  A block that is all covered goes, others lose covered runs
of that length and keep the rest.

A host may have any share of all pages, so its streams are dealt to shards of
about ``SHARD_TOKENS`` tokens; each shard sorts its suffixes to depth
``MIN_RUN`` and returns counts for intervals of equal prefixes: a run of the
minimum length or longer is repeated on the host if and only if its prefixes
are.  The shards of a host follow from the bytes of its pages.  For open streams
the counts are added up over a host's shards; they are used on hosts that have
open blocks.  A run in more than half of a host's pages is in more
than half of the pages of some shard, so for article streams only those runs
are returned, and the pages that hold them are then counted over the whole
host.  Pages that are equal in every block count once.

Pages are split once for the sizes of hosts, once for the streams and once for
the result, which takes less disk than to store the blocks.

A null html is an empty page, a null or relative URL has the empty host.
Rows are independent: repeated rows and ids give repeated rows, an empty table
an empty one; other columns are ignored.  Pages of any length are read whole.
"""

from __future__ import annotations

import hashlib
import html as entities
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import by_batch, stored

MIN_RUN = 6
MIN_PAGES = 3
SHARD_TOKENS = 500_000

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("head script style noscript template textarea select option iframe object svg canvas audio video annotation annotation-xml title".split())
CHROME = frozenset("nav footer aside form dialog menu".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
# A start tag of the second kind ends an open element of the first.
ENDS = {"p": BLOCK, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "tr": {"tr"}, "option": {"option"}}
HINTS = frozenset("""ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments cookie cookies consent disqus footer
    menu modal nav navbar navigation newsletter notice pagination pager popup promo promoted related share sharing sidebar social sponsor sponsored
    subscribe toolbar widget""".split())
# Hints that no amount of text speaks against.
FIRM = frozenset("ad ads advert adverts advertisement comment comments consent cookie cookies disqus pagination promo promoted related sponsor sponsored".split())
# Words that stand beside a hint in the name of such a part; before a hint, the second ones say that the element is something else.
BESIDE = frozenset("""area bar block bottom box button buttons container content desktop fixed form global group icon icons inner item items left
    link links list main mobile outer overlay page panel post posts primary right secondary section signup site slot sticky stories text title
    toggle top unit wrap wrapper""".split())
BEFORE = frozenset("has hide is no not show with without".split())
ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search".split())

_RAW = "script|style|noscript|template|textarea|iframe|title"
_MARKUP = re.compile(
    rf"(?is)<!--.*?(?:-->|\Z)|<(?P<raw>{_RAW})(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*+>|\Z)"
    r"|<(?P<end>/)?(?P<name>[a-z][^\s/>]*+)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)")
_ATTRIBUTE = re.compile(r"""([^\s/>=][^\s/>=]*+)\s*+(?:=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?""")
_READ = frozenset("class id role hidden aria-hidden itemprop".split())
_NAME_WORDS = re.compile(r"[a-z0-9]+").findall

Blocks = list[tuple[str, str, bool]]


def _attributes(text: str) -> dict[str, str]:
    """The attributes that are read, by whole names; the first of a name counts."""
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(text):
        if (name := name.lower()) in _READ:
            found.setdefault(name, "".join(values).lower())
    return found


class _Element:
    """An open element; its zone is known when the whole page is read."""

    __slots__ = ("name", "parent", "kind", "is_article", "is_part", "skipped", "shut", "firm", "size", "spared", "zone")

    def __init__(self, name: str, parent: _Element | None, kind: str, is_article: bool, is_part: bool):
        self.name, self.parent, self.kind, self.is_article, self.is_part = name, parent, kind, is_article, is_part
        self.skipped = kind == "skipped" or parent is not None and parent.skipped
        self.shut = kind in ("skipped", "chrome") or parent is not None and parent.shut
        self.firm = kind == "firm" or parent is not None and parent.firm
        self.size = 0  # characters outside of links
        self.spared = False  # holds, or is, the page's main article
        self.zone = "plain"


def _hint(names: list[str], slug: bool, hints: frozenset[str]) -> str:
    """The hint among whole names of parts of a page: one word, or up to three
    of which the last is a hint or the first with others that stand beside it.
    A ``slug`` (an id may be a headline) needs such others in any case."""
    for name in names:
        words = _NAME_WORDS(name)
        if not words or len(words) > 3 or words[0] in BEFORE:
            continue
        first, last = words[0] in hints, words[-1] in hints
        if len(words) == 1 and first or first and all(w in BESIDE or w in hints for w in words[1:]):
            return words[0]
        if last and (not slug or all(w in BESIDE or w in hints for w in words[:-1])):
            return words[-1]
    return ""


def _kind(name: str, attributes: str, in_article: bool, in_heading: bool) -> tuple[str, bool]:
    """What an element says of its content, and whether it is an article:
    ``skipped``, ``chrome``, ``firm`` or ``hinted`` (chrome unless it holds the
    main article or, if not firm, most of the page), ``article`` or nothing."""
    if name in SKIPPED or name == "button" and not in_heading:
        return "skipped", False
    found = _attributes(attributes) if attributes.strip() else {}
    role = found.get("role")
    if "hidden" in found or found.get("aria-hidden") == "true":
        return "skipped", False
    if name in CHROME and name != "form" or role in ROLES and role != "form" or name == "header" and not in_article:
        return "chrome", False
    is_article = name in ("article", "main") or role == "main" or found.get("itemprop") == "articlebody"
    if name not in ("html", "body", "main"):
        hints = HINTS if in_article else HINTS | {"header"}
        hint = _hint(found.get("class", "").split(), False, hints) or _hint(found.get("id", "").split(), True, hints)
        if hint or name == "form" or role == "form":
            return "firm" if hint in FIRM else "hinted", is_article
    return "article" if is_article else "", is_article


def _set_zones(elements: list[_Element], outside: int) -> None:
    """Zones from the elements' kinds, sizes and parents; ``outside`` is the
    size of the text in no element."""
    for e in reversed(elements):  # parents come first
        if e.parent is not None:
            e.parent.size += e.size
    total = outside + sum(e.size for e in elements if e.parent is None)
    articles = [e for e in elements if e.is_article and not e.shut and not e.is_part]
    for likely in ([e for e in articles if e.kind == "article" and not e.firm], [e for e in articles if not e.firm], articles):
        if likely:
            around = max(likely, key=lambda e: e.size)
            while around is not None:
                around.spared, around = True, around.parent
            break
    for e in elements:
        inside = e.parent.zone if e.parent else "plain"
        if e.skipped:
            e.zone = "skipped"
        elif inside == "chrome" or e.kind == "chrome":
            e.zone = "chrome"
        elif e.kind in ("firm", "hinted") and not e.spared:
            # repetition decides on what is most of the page
            e.zone = "plain" if e.kind == "hinted" and 2 * e.size > total else "chrome"
        else:
            e.zone = "article" if e.is_article else inside


def split_page(page: str) -> Blocks:
    """``(zone, text, mostly links)`` of the blocks, in page order."""
    found: list[tuple[_Element | None, str, bool]] = []
    stack: list[_Element] = []  # open elements
    elements: list[_Element] = []
    texts: list[str] = []
    linked = 0  # characters of the block that are inside links and buttons
    links = articles = bodies = headings = 0
    outside = 0
    last = 0

    def end_block() -> None:
        nonlocal linked, outside
        if texts:
            text = " ".join("".join(texts).split())
            if text:
                found.append((stack[-1] if stack else None, text, 2 * linked >= len(text)))
                size = max(0, len(text) - linked)
                if stack:
                    stack[-1].size += size
                else:
                    outside += size
            texts.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw and not (stack and stack[-1].skipped):
            text = entities.unescape(raw) if "&" in raw else raw
            texts.append(text)
            if links:
                linked += len(text.strip())

    def close(n: int) -> None:
        """Close the elements from place ``n`` of the stack on."""
        nonlocal links, articles, bodies, headings
        if any(e.name in BLOCK for e in stack[n:]):
            end_block()
        for e in stack[n:]:
            links -= e.name in ("a", "button")
            articles -= e.name in ("article", "main")
            bodies -= e.name == "article"
            headings -= e.name in HEADING
        del stack[n:]

    for m in _MARKUP.finditer(page):
        add(page[last : m.start()])
        last = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if m["end"]:
            for n in range(len(stack) - 1, -1, -1):
                if stack[n].name == name:
                    close(n)
                    break
                if stack[n].name in ("article", "main", "body") and name not in ("body", "html", "article", "main"):
                    break  # an end tag without its start inside this part
            continue
        if name == "br":
            texts.append(" ")
            continue
        # elements whose end tags may be left out
        for n in range(len(stack) - 1, -1, -1):
            open_name = stack[n].name
            if name in ENDS.get(open_name, ()):
                close(n)
                break
            if open_name in BLOCK:
                break
        if name in BLOCK:
            end_block()
        if name in VOID or m["attributes"].rstrip().endswith("/") and name not in BLOCK and name != "a":
            continue
        # an article element inside another is a part of it, such as a comment
        e = _Element(name, stack[-1] if stack else None, *_kind(name, m["attributes"], articles > 0, headings > 0), name == "article" and bodies > 0)
        elements.append(e)
        stack.append(e)
        links += name in ("a", "button")
        articles += name in ("article", "main")
        bodies += name == "article"
        headings += name in HEADING
    add(page[last:])
    end_block()
    _set_zones(elements, outside)
    return [(e.zone if e else "plain", text, mostly) for e, text, mostly in found]


def host_of(url: Column) -> Column:
    return F.lower(F.substring_index(F.regexp_extract(F.coalesce(url, F.lit("")), "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), "@", -1))


def open_blocks(blocks: Blocks) -> list[bool]:
    """Which blocks lose what the open streams of several pages share."""
    article = any(zone == "article" for zone, *_ in blocks)
    return [links if zone == "article" else zone == "plain" and not (article and links) for zone, _, links in blocks]


def kept_text(blocks: Blocks, covered: set[int], in_articles: set[int] | frozenset[int] = frozenset()) -> str:
    """The main text, given the places in the page's streams that are covered."""
    out, at, at_article = [], 0, 0
    for (zone, text, _), is_open in zip(blocks, open_blocks(blocks)):
        n = text.count(" ") + 1
        running = zone == "article" and not is_open
        places, start = (in_articles, at_article) if running else (covered, at)
        if (running or is_open) and places:
            text = " ".join(_unique(text.split(" "), [start + i in places for i in range(n)]))
        if text and (running or is_open):
            out.append(text)
        if running:
            at_article += n
        else:
            at += n
    return "\n\n".join(out)


def _unique(words: list[str], covered: list[bool]) -> list[str]:
    """The words without covered runs of the least length; fewer covered words
    beside a block's own are the end of a run of its neighbour's."""
    if all(covered):
        return []
    out: list[str] = []
    run: list[str] = []
    for word, c in zip([*words, ""], [*covered, False]):
        if c:
            run.append(word)
            continue
        out += run * (len(run) < MIN_RUN) + [word]
        run = []
    return out[:-1]


def streams(blocks: Blocks) -> tuple[str, str]:
    """The open and the article stream of a page, words joined by spaces."""
    parts: tuple[list[str], list[str]] = [], []
    for (zone, text, _), is_open in zip(blocks, open_blocks(blocks)):
        parts[zone == "article" and not is_open].append(text)
    return " ".join(parts[0]), " ".join(parts[1])


def _token(word: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(word)


def _tokens(words: list[str]) -> np.ndarray:
    """Hashes of the words; each different word is hashed once."""
    coded = pa.array(words, pa.large_string()).dictionary_encode()
    known = np.fromiter(map(_token, coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    return known[coded.indices.to_numpy()] if words else known


def prefixes(tokens: np.ndarray) -> np.ndarray:
    """Hashes of the first ``MIN_RUN`` tokens of all suffixes that have them."""
    n = len(tokens) - MIN_RUN + 1
    out = np.zeros(max(n, 0), np.uint64)
    for i in range(MIN_RUN if n > 0 else 0):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + tokens[i : i + n]
    return out


def suffix_array(tokens: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes sorted by their first ``depth`` tokens, by doubling of ranks,
    and for each place whether it shares them with the place before."""
    _, rank = np.unique(tokens, return_inverse=True)
    known = 1
    while known < depth:
        step = min(known, depth - known)
        second = np.full(len(rank), -1, np.int64)
        second[:-step] = rank[step:]
        _, rank = np.unique(rank * (len(rank) + 1) + second + 1, return_inverse=True)
        known += step
    order = np.argsort(rank, kind="stable")
    return order, np.concatenate([[False], rank[order][1:] == rank[order][:-1]])


def repeated_in(streams: list[list[str]]) -> list[tuple[int, int]]:
    """``(prefix hash, pages)`` of the intervals of a shard's suffix array."""
    run, pages = _intervals(streams)
    return list(zip(run.tolist(), pages.tolist()))


def _intervals(streams: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    none = np.zeros(0, np.int64)
    if not streams:
        return none, none
    lengths = np.array([len(words) for words in streams])
    at = np.arange(lengths.sum()) + np.repeat(np.arange(len(streams)), lengths)
    tokens = np.zeros(lengths.sum() + len(streams), np.uint64)
    tokens[at] = _tokens([w for words in streams for w in words])
    page = np.repeat(np.arange(len(streams)), lengths + 1)
    ends = np.cumsum(lengths + 1) - 1
    tokens[ends] = np.arange(len(streams))  # a page number ends each stream; runs across it are left out
    left = ends[page] - np.arange(len(tokens))
    order, same = suffix_array(tokens, MIN_RUN)
    inside = left[order] >= MIN_RUN
    interval = np.cumsum(~same)[inside]
    order = order[inside]
    if not len(order):
        return none, none
    # distinct pages of each interval
    pairs = np.unique(interval * len(streams) + page[order])
    _, pages = np.unique(pairs // len(streams), return_counts=True)
    start = order[np.unique(interval, return_index=True)[1]]
    window = np.zeros(len(start), np.uint64)
    for i in range(MIN_RUN):
        window = (window ^ (window >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + tokens[start + i]
    return window.view(np.int64), pages


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col, url_col, text, n_chars`` of every page."""
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), host_of(F.col(url_col)).alias("host"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    rows = rows.withColumn("key", F.md5(F.concat(F.md5("host"), "html")))

    # a token and the space behind it are two bytes at least
    tokens = F.sum(F.octet_length("html") / F.lit(2) + F.lit(1))
    sizes = stored(rows.groupBy("host").agg(F.ceil(tokens / SHARD_TOKENS).cast("int").alias("shards")), "pages-sizes")

    def parse(batch: pa.RecordBatch) -> dict[str, list]:
        out: dict[str, list] = {c: [] for c in ("host", "shard", "shards", "same", "has_open", "open", "article")}
        seen = set()
        for host, html, shards in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "shards"))):
            blocks = split_page(html)
            same = _same(blocks)
            if (host, same) in seen:
                continue
            seen.add((host, same))
            of_open, article = streams(blocks)
            values = host, int.from_bytes(same[:4], "big") % shards, shards, same, any(open_blocks(blocks)), of_open, article
            for column, value in zip(out.values(), values):
                column.append(value)
        return out

    dealt = by_batch(rows.select("host", "html").join(sizes, "host"), parse, "host string, shard int, shards int, same binary, has_open boolean, open string, article string")

    def shard(table: pa.Table) -> pa.Table:
        different = {same: (o, a) for same, o, a in zip(*(table.column(c).to_pylist() for c in ("same", "open", "article")))}
        host, alone = table.column("host")[0].as_py(), table.column("shards")[0].as_py() == 1
        words = [[(s[k] or "").split() for s in different.values()] for k in (0, 1)]
        run, n = _intervals(words[0])
        keep = n >= (MIN_PAGES if alone else 1)
        own_run, own_n = _intervals(words[1])
        most = (2 * own_n > len(different)) & (own_n >= (MIN_PAGES if alone else 1))
        run, n, own_run, own_n = run[keep], n[keep], own_run[most], own_n[most]
        has_open = [False, *table.column("has_open").to_pylist()]
        kinds = ["open"] * len(run) + ["article"] * len(own_run) + ["pages", "has_open"]
        return pa.table({"host": pa.array([host] * len(kinds), pa.string()), "kind": pa.array(kinds, pa.string()),
                         "run": pa.array(np.concatenate([run, own_run, [0, 0]]).astype(np.int64)), "pages": pa.array(np.concatenate([n, own_n, [len(different), any(has_open)]]).astype(np.int64))})

    counted = dealt.groupBy("host", "shard").applyInArrow(shard, "host string, kind string, run long, pages long")
    counted = stored(counted.groupBy("host", "kind", "run").agg(F.sum("pages").alias("pages")).where((F.col("kind") != "open") | (F.col("pages") >= MIN_PAGES)), "pages-counted")
    # runs of open streams matter on hosts that have open blocks
    with_open = counted.where("kind = 'has_open' and pages > 0").select("host")
    candidates = counted.where("kind = 'article'").unionByName(counted.where("kind = 'open'").join(with_open, "host", "left_semi"))
    candidates = stored(candidates.select("host", "kind", "run"), "pages-candidates")
    hosts = stored(candidates.groupBy("host").agg(F.max(F.col("kind") == "open").alias("open"), F.max(F.col("kind") == "article").alias("article")), "pages-hosts")

    def runs(batch: pa.RecordBatch) -> dict[str, list]:
        out: dict[str, list] = {c: [] for c in ("key", "same", "host", "kind", "at", "run")}
        seen = set()
        for key, host, html, *wanted in zip(*(batch.column(c).to_pylist() for c in ("key", "host", "html", "open", "article"))):
            if key in seen:
                continue
            seen.add(key)
            blocks = split_page(html)
            wanted[0] = wanted[0] and any(open_blocks(blocks))
            for kind, words, is_wanted in zip(("open", "article"), streams(blocks), wanted):
                found = prefixes(_tokens(words.split())).view(np.int64).tolist() if is_wanted else []
                for column, value in zip(("key", "same", "host", "kind"), (key, _same(blocks), host, kind)):
                    out[column] += [value] * len(found)
                out["at"] += range(len(found))
                out["run"] += found
        return out

    places = by_batch(rows.select("key", "host", "html").join(hosts, "host"), runs, "key string, same binary, host string, kind string, at int, run long")
    matched = stored(places.join(candidates, ["host", "kind", "run"]), "pages-matched")
    # article runs on most pages of the whole host
    total = counted.where("kind = 'pages'").select("host", F.col("pages").alias("total"))
    most = matched.where("kind = 'article'").groupBy("host", "kind", "run").agg(F.count_distinct("same").alias("n")).join(total, "host")
    most = most.where((2 * F.col("n") > F.col("total")) & (F.col("n") >= MIN_PAGES)).select("host", "kind", "run")
    decided = matched.where("kind = 'open'").select("key", "kind", "at").unionByName(matched.join(most, ["host", "kind", "run"]).select("key", "kind", "at"))
    at = lambda kind: F.collect_set(F.when(F.col("kind") == kind, F.col("at"))).alias(f"at_{kind}")
    covered = stored(decided.groupBy("key").agg(at("open"), at("article")), "pages-covered")

    def finish(batch: pa.RecordBatch) -> dict[str, list]:
        columns = (batch.column(c).to_pylist() for c in ("html", "at_open", "at_article"))
        return {"id": batch.column("id"), "url": batch.column("url"), "text": [kept_text(split_page(h), _spread(o), _spread(a)) for h, o, a in zip(*columns)]}

    out = by_batch(rows.join(covered, "key", "left").select("id", "url", "html", "at_open", "at_article"), finish, "id long, url string, text string")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.char_length("text").cast("long").alias("n_chars"))


def _same(blocks: Blocks) -> bytes:
    """Equal for pages that are equal in every block."""
    return hashlib.md5("\n".join(f"{zone} {links:d} {text}" for zone, text, links in blocks).encode("utf-8", "surrogatepass")).digest()


def _spread(at: list[int] | None) -> set[int]:
    return {a + i for a in at or () for i in range(MIN_RUN)}
