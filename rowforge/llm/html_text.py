"""Main text of web pages by their marks and by suffixes that a host's pages share.

A page is read into blocks in order. Scripts, styles, menus, footers, sidebars, forms, and
elements whose class or id names a notice, an advert or reader comments are left out. The blocks' words are a stream, and the streams of a host's pages
are searched like a suffix array: suffixes are ordered by their first ``LEAST`` words, and suffixes that agree in
them on distinct pages are repeats.

On pages without an article or main element, blocks that repeats cover are boilerplate, blocks with unique runs stay; what the
host's articles hold counts as a repeat, too. Pages are distinct if their own blocks differ, a page's own block being the longest
when its length counts by how few of the host's pages hold it: a footer longer than the articles is no page's own, and an article read
twice with another date is one page. Ordering by a bounded beginning is an aggregation by host and hash, so that a host with
a third of all pages is spread over tasks.

Inside an article or main element a passage may well be met again, as copies of an article are articles. There a block is
boilerplate only if runs cover it that more than half of the host's distinct articles hold, ``ARTICLES`` at least, and an article
that is half of such blocks or more stays whole. Articles are distinct if their longest blocks differ. Such runs are
few, so they are found without moving all suffixes: first pages are counted by host and bucket of the runs' hashes, and only the runs in
buckets that enough pages hold are counted one by one.

Null or empty pages give an empty text. Pages without a host in their url are compared among
themselves. Repeated rows come back one by one and are no distinct pages to each other. Other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowforge.llm.neardup import _mix
from rowforge.llm.shared import written

LEAST, COVERED = 6, 0.8
ARTICLES, BUCKETS, SENT = 5, 4096, 1 << 20
# Elements left out, elements that end a block, and names that mark furniture.
DROP = frozenset("head script style noscript template iframe svg canvas object nav footer aside form button select textarea dialog menu".split())
BLOCK = frozenset("address article blockquote body caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 header hgroup hr html li main ol p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MARKED = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|sponsored|sponsor|promo|banner|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|newsletter|subscribe|signup|"
    r"nav|navbar|navigation|menu|breadcrumbs?|sidebar|widget|footer|masthead|topbar|toolbar|pagination|pager|share|sharing|social|related|recommended|"
    r"comments?|commentlist|disqus|replies|respond|login|search|skip-link)(?:$|[\s_-])",
    re.I,
)
# Inside an article these name furniture only if the other parts of the name are furniture words, too: share-buttons, not market-share.
DOUBTFUL = re.compile(r"^(?:promo|banner|notice|alert|overlay|navigation|menu|widget|share|sharing|social|related|recommended|replies|respond|login)$", re.I)
PARTS = frozenset("area articles bar block bottom box button buttons container content float group icon icons inline inner item items left link links list main media outer page posts right section site small sticky stories top topics tools wrap wrapper".split())
# Names of article elements that are no article.
ASIDE = re.compile(r"(?:^|\s)(?:(?:user-)?comments?|reply|replies|teaser|related|recommended|sponsored|promo|ads?|advert|advertisement)(?:[-_](?:articles?|body|box|cards?|entry|item|list|posts?|teaser))?(?:$|\s)", re.I)
# names of headers, furniture outside an article or main element only
HEADER = re.compile(r"(?:^|[\s_-])(?:site-header|page-header|header)(?:$|[\s_-])", re.I)
ROLE = re.compile(r"""\brole\s*=\s*["']?(?:navigation|banner|contentinfo|complementary|search|form|dialog|alert|menu)""", re.I)
NAMES = re.compile(r"""\b(?:class|id)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
# Elements whose end tag may be left out, and the start tags that end them.
ENDS = {
    "p": frozenset("address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table td th tr ul".split()),
    "li": frozenset(["li"]), "dd": frozenset(["dd", "dt"]), "dt": frozenset(["dd", "dt"]),
    **dict.fromkeys(("td", "th"), frozenset("td th tr tbody tfoot thead".split())), **dict.fromkeys(("tr",), frozenset("tr tbody tfoot thead".split())),
    **dict.fromkeys(("tbody", "tfoot", "thead"), frozenset("tbody tfoot thead".split())), "option": frozenset(["option", "optgroup"]),
}
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<(script|style|noscript|template|textarea|svg|iframe)\b[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][\w:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S | re.I)


ENDERS = frozenset().union(*ENDS.values())


def furniture(names: str, inside: bool) -> bool:
    """Whether a class or id names furniture."""
    if not inside:
        return bool(MARKED.search(names) or HEADER.search(names))
    for name in names.split():
        parts = [x for x in re.split(r"[_-]", name) if x]
        marks = [x for x in parts if MARKED.search(x)]
        if name.lower() == "skip-link" or any(not DOUBTFUL.match(x) and x.lower() != "search" for x in marks):
            return True
        if any(DOUBTFUL.match(x) for x in marks) and all(MARKED.search(x) or x.lower() in PARTS for x in parts):
            return True
    return False


def cut(stack: list[str], at: int, opens: dict[str, int]) -> None:
    """Take off ``stack`` what lies from ``at``; ``opens`` counts the names on it."""
    for x in stack[at:]:
        opens[x] -= 1
    del stack[at:]


def opened(stack: list[str], name: str, opens: dict[str, int]) -> None:
    """Take off ``stack`` what the start tag ends."""
    if name not in ENDERS:
        return
    at = len(stack) - 1
    while at >= 0:
        if name in ENDS.get(stack[at], ()):
            cut(stack, at, opens)
        elif stack[at] in BLOCK or stack[at] in DROP:
            return
        at -= 1


def closed(stack: list[str], name: str, opens: dict[str, int]) -> None:
    """Take off ``stack`` what the end tag ends; inline end tags end nothing outside their block."""
    if not opens.get(name):
        return
    for at in range(len(stack) - 1, -1, -1):
        if stack[at] == name:
            cut(stack, at, opens)
            return
        if (stack[at] in BLOCK and name not in BLOCK and name not in DROP) or (stack[at] in ("td", "th", "caption") and name in ("p", "li", "dd", "dt")):
            return


def blocks(page: str) -> tuple[list[str], list[bool]]:
    """Texts of the page's blocks without marked furniture, and which lie in an article or main element."""
    out: list[str] = []
    main: list[bool] = []
    run: list[str] = []
    stack: list[str] = []  # open elements, of the inline ones only one that is left out
    opens: dict[str, int] = defaultdict(int)
    ends: dict[str, int] = {}
    skip, nested, inside, last = 0, 0, 0, 0  # skip: how many elements are open in the one left out and around it; nested: inline ones of its name within

    def ended(name: str) -> bool:
        """Whether an end tag of ``name`` follows."""
        if name not in ends:
            ends[name] = max((m.start() for m in re.finditer(rf"</{re.escape(name)}\s*>", page, re.I)), default=-1)
        return ends[name] >= last

    def push(name: str) -> None:
        stack.append(name)
        opens[name] += 1

    def end() -> None:
        if run:
            if text := " ".join(html.unescape("".join(run)).split()):
                out.append(text)
                main.append(bool(inside))
            run.clear()

    for m in TOKEN.finditer(page):
        if not skip and m.start() > last:
            run.append(page[last : m.start()])
        last = m.end()
        name = (m[3] or "").lower()
        if not name:
            continue
        closing = bool(m[2])
        inline = name not in BLOCK and name not in DROP and name not in ENDS
        if skip and inline and len(stack) == skip and name == stack[-1] and (nested or not closing):
            nested += -1 if closing else not (m[4] or "").rstrip().endswith("/")
            continue
        (closed if closing else opened)(stack, name, opens)
        if skip:
            if len(stack) >= skip:
                if not closing and not inline and name not in VOID:
                    push(name)
                continue
            own = closing and len(stack) == skip - 1
            skip = nested = 0
            if own:
                continue
        if name == "br":
            run.append(" ")
        elif closing:
            if name in BLOCK:
                end()
            if name in ("article", "main"):
                inside = max(0, inside - 1)
        else:
            if name in BLOCK or name in DROP:
                end()
            attrs = m[4] or ""
            marked = name in DROP or (name == "header" and not inside)
            if attrs and not marked and name not in ("html", "body", "main") and name not in VOID:
                names = [x[0] or x[1] or x[2] for x in NAMES.findall(attrs)]
                if name == "article":
                    marked = any(ASIDE.search(x) for x in names)
                else:
                    marked = bool(ROLE.search(attrs)) or any(furniture(x, bool(inside)) for x in names)
            holds = name not in VOID and not attrs.rstrip().endswith("/")
            # an element never closed marks nothing but itself, unless its end tag may be left out
            leaves = holds and marked and (name in ENDS or ended(name))
            if holds and (leaves or not inline):
                push(name)
            if leaves:
                skip = len(stack)
            elif name in ("article", "main") and not marked:
                inside += 1
    if not skip:
        run.append(page[last:])
    end()
    return out, main


def _read(batches):
    """The blocks of each page; of pages with an article or main element those inside, and apart the rest."""
    for batch in batches:
        keys, urls, pages = (batch.column(k).to_pylist() for k in range(3))
        for k in range(0, len(pages), 256):
            article, own, rest = [], [], []
            for page in pages[k : k + 256]:
                found, main = blocks(page) if page else ([], [])
                article.append(any(main))
                own.append([b for b, m in zip(found, main, strict=True) if m or not article[-1]])
                rest.append([b for b, m in zip(found, main, strict=True) if article[-1] and not m])
            texts = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(keys[k : k + 256], pa.int64()), pa.array(urls[k : k + 256], pa.string()), pa.array(article, pa.bool_()), pa.array(own, texts), pa.array(rest, texts)], ["page_id", "url", "article", "blocks", "rest"])


class _Runs:
    """Hashes of the runs of ``LEAST`` words of a page's blocks; word hashes are remembered."""

    def __init__(self, keep: int = 150_000):
        import xxhash

        self.hash, self.keep, self.seen = xxhash.xxh3_64_intdigest, keep, {}

    def __call__(self, found: list[str]) -> np.ndarray:
        words = " ".join(found).split()
        if len(self.seen) > self.keep:
            self.seen.clear()
        seen = self.seen
        for w in set(words):
            if w not in seen:
                seen[w] = self.hash(w.encode("utf-8", "surrogatepass"))
        h = np.fromiter(map(seen.__getitem__, words), np.uint64, len(words))
        n = min(LEAST, len(words))
        out = np.full(len(h) - n + 1, np.uint64(n))
        for k in range(n):
            out = _mix(out + h[k : len(h) - n + 1 + k])
        return out.view(np.int64)


def _buckets(batches):
    """How many pages of a host hold a run of each bucket, summed up over the partition."""
    runs, held = _Runs(), {}

    def counted():
        for host, n in held.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([host] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at])], ["host", "bucket", "n"])
        held.clear()

    for batch in batches:
        for host, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if host not in held and len(held) >= 256:
                yield from counted()
            held.setdefault(host, np.zeros(BUCKETS, np.int64))[np.unique(runs(found) % BUCKETS)] += 1
    yield from counted()


def _runs_in(batches):
    """host, sign and run, for the runs of each page that lie in the buckets asked for."""
    runs = _Runs()
    for batch in batches:
        for host, sign, found, wanted in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            asked = np.zeros(BUCKETS, bool)
            asked[wanted] = True
            own = np.unique(runs(found))
            own = own[asked[own % BUCKETS]]
            if len(own):
                yield pa.RecordBatch.from_arrays([pa.array([host] * len(own), pa.string()), pa.array([sign] * len(own), pa.int64()), pa.array(own)], ["host", "sign", "run"])


def _articles(batches):
    """The text of an article without the blocks that the host's common runs cover."""
    runs = _Runs()
    for batch in batches:
        out = []
        for found, common in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            if common:
                places = np.flatnonzero(np.isin(runs(found), np.array(common, np.int64)))
                left = _uncovered(found, places)
                if 2 * sum(len(x.split()) for x in left) > sum(len(x.split()) for x in found):
                    found = left
            out.append("\n\n".join(found))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], ["page_id", "url", "text"])


def _suffixes(batches):
    """host, hash of the first words, sign of the page, and the suffix's place."""
    import xxhash

    for batch in batches:
        rows: list[tuple] = []
        for host, key, found, sign in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            words = " ".join(found).split()
            for k in range(max(1, len(words) - LEAST + 1)):
                head = "\0".join(words[k : k + LEAST])
                rows.append((host, int(np.uint64(xxhash.xxh3_64_intdigest(head.encode("utf-8", "surrogatepass"))).view(np.int64)), sign, key, k))
        if rows:
            columns = list(zip(*rows, strict=True))
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["host", "head", "sign", "key", "at"])


def _uncovered(found: list[str], places) -> list[str]:
    """The blocks that runs from these places do not cover."""
    sizes = [len(x.split()) for x in found]
    cover = np.zeros(sum(sizes) + LEAST, bool)
    for k in places:
        cover[k : k + LEAST] = True
    ends = np.cumsum(sizes)
    return [x for x, n, e in zip(found, sizes, ends, strict=True) if cover[e - n : e].sum() < COVERED * n]


def _unique(batches):
    """The text of a page from its blocks and the places of its repeated suffixes."""
    for batch in batches:
        out = ["\n\n".join(_uncovered(found, places or ())) for found, places in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], ["page_id", "url", "text"])


def _signs(pages: DataFrame) -> DataFrame:
    """host, page and sign, the hash of the page's own block, for ``pages`` with host, page and blocks."""
    distinct = pages.dropDuplicates(["host", "page"])
    total = distinct.groupBy("host").agg(F.count("*").alias("pages"))
    held = distinct.select("host", "page", F.explode(F.array_distinct("blocks")).alias("b")).select("host", "page", F.xxhash64("b").alias("block"), F.length("b").alias("size"))
    held_by = held.groupBy("host", "block").agg(F.count("*").alias("n"))
    weight = F.struct((F.col("size") * F.log(F.col("pages") / F.col("n"))).alias("weight"), "size", "block")
    return held.join(held_by, ["host", "block"]).join(total, "host").groupBy("host", "page").agg(F.max(weight)["block"].alias("sign"))


def _few(frame: DataFrame) -> DataFrame:
    """A written frame, broadcast if it holds at most ``SENT`` rows."""
    return F.broadcast(frame) if frame.count() <= SENT else frame


def _common(articles: DataFrame) -> DataFrame:
    """host and run, written, for runs that more than half of the host's distinct articles hold."""
    totals = articles.groupBy("host").agg(F.count_distinct("sign").alias("signs")).filter(F.col("signs") >= ARTICLES)
    counts = articles.select("host", "blocks").mapInArrow(_buckets, "host string, bucket int, n long").groupBy("host", "bucket").agg(F.sum("n").alias("n"))
    # a bucket's pages are at least the distinct articles of each of its runs
    asked = counts.join(totals, "host").filter("2 * n > signs").groupBy("host").agg(F.collect_set("bucket").alias("buckets"), F.any_value("signs").alias("signs"))
    asked = _few(written(asked, "buckets"))
    met = articles.join(asked.select("host", "buckets"), "host").select("host", "sign", "blocks", "buckets").mapInArrow(_runs_in, "host string, sign long, run long")
    held = met.groupBy("host", "run").agg(F.count_distinct("sign").alias("n")).join(asked.select("host", "signs"), "host")
    return written(held.filter((F.col("n") >= ARTICLES) & (2 * F.col("n") > F.col("signs"))).select("host", "run"), "common")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages`` (page_id, url, html)."""
    read = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(_read, "page_id long, url string, article boolean, blocks array<string>, rest array<string>")
    read = written(read, "pages")
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][\w+.-]*://([^/?#]+)", 1)), F.lit(""))
    filled = read.filter("size(blocks) > 0").withColumn("host", host).withColumn("key", F.xxhash64("page_id", "url", F.array_join("blocks", "\n")))
    open_ = filled.filter("not article")
    # pages with an article are evidence for the others of their host
    hosts = _few(written(open_.select("host").distinct(), "hosts"))
    known = filled.join(hosts, "host", "left_semi").withColumn("blocks", F.concat("blocks", "rest")).select("host", "key", "blocks", F.xxhash64(F.array_join("blocks", "\n")).alias("page"))
    shape = "host string, head long, sign long, key long, at int"
    streams = known.join(_signs(known), ["host", "page"]).select("host", "key", "blocks", "sign").mapInArrow(_suffixes, shape)
    repeats = streams.groupBy("host", "head").agg(F.min("sign").alias("lo"), F.max("sign").alias("hi")).filter("lo <> hi").select("host", "head")
    asked = open_.select("host", "key", "blocks", F.lit(0).cast("long").alias("sign")).mapInArrow(_suffixes, shape)
    places = asked.join(repeats, ["host", "head"], "left_semi").groupBy("key").agg(F.collect_set("at").alias("places"))
    opened = open_.join(places, "key", "left").select("page_id", "url", "blocks", "places").mapInArrow(_unique, "page_id long, url string, text string")
    longest = F.array_max(F.transform("blocks", lambda b: F.struct(F.length(b).alias("size"), F.xxhash64(b).alias("sign"))))
    articles = filled.filter("article").select("page_id", "url", "host", "blocks", longest["sign"].alias("sign"))
    common = _common(articles)
    runs = common.groupBy("host").agg(F.collect_set("run").alias("runs"))
    runs = F.broadcast(runs) if common.count() <= SENT else runs
    whole = articles.join(runs, "host", "left").select("page_id", "url", "blocks", "runs").mapInArrow(_articles, "page_id long, url string, text string")
    done = read.filter("size(blocks) = 0").select("page_id", "url", F.lit("").alias("text"))
    return done.unionByName(opened).unionByName(whole).withColumn("n_chars", F.length("text").cast("long"))
