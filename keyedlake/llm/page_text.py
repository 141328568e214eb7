"""Main text of web pages by differencing each with its nearest page.

Pages are put in order of (host, URL path, page id).  Of the two neighbours that a page
has within its host, the one whose path has the longer common beginning is its nearest
page.  Both are cut into text lines (one for each block element) and the lines are
aligned by longest common subsequence: lines that both pages have belong to the
site, not to the page, and are deleted.

On markup that names its parts the alignment alone is wrong both ways: an article line
that the neighbour quotes would go, and a reader's comment or the menu of a host with one
page would stay.  So markup corrects the alignment where it speaks:

* lines of elements that aren't the article's (``nav``, ``footer``, ``aside``, ``form``,
  parts whose role, class or id says advert, sidebar, cookie notice, comments ...) go;
* lines of ``article`` elements (of ``main`` where there are none) that are not in such a
  part stay, shared or not;
* all other lines stay if the alignment has not found them in the nearest page.

Pages are dealt by split points in that order, so that a hot host, or one path with a
third of all pages, is spread over many tasks.  The first and last page of each part
are sent to the neighbouring part as well, so that no page misses its neighbour; a task
streams its sorted pages and holds three of them.  Split points (at most ``MOST_PARTS``)
are all that passes the driver.

Defined results
---------------
* null html, or html without text, gives an empty text; null urls have no host and such
  pages aren't paired; a neighbour with the very same lines says nothing and is passed over;
* a tag, comment or script that the end of the html cuts off is dropped;
* ``br`` and inline tags are inside a block, ``br`` is white space; table cells are blocks;
* rows that repeat are neighbours of each other and have equal results;
* an empty table gives an empty result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map

#: Pages that a part is meant to hold, and the most parts (beyond it parts grow; tasks stream them).
PART_PAGES, MOST_PARTS = 512, 4096
#: Sampled keys for each split point, about (a key is in the sample by its hash).
SAMPLES = 20
#: Bits of alignment rows that are kept at once; larger alignments are halved first.
ALIGN_BITS = 1 << 26

# Element names of HTML.
_BLOCKS = frozenset("""
    address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search
    section summary table tbody td tfoot th thead tr ul""".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
_NEVER = frozenset("""
    aside audio button canvas datalist dialog fieldset footer form head math menu nav noscript object search select
    svg template video""".split())
# Words of roles, classes and ids that name parts beside the article.
_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
_PARTS = frozenset("""
    ad ads advert adverts advertisement advertisements banner breadcrumb breadcrumbs consent cookie cookies copyright
    footer login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo related
    search share sharing sidebar social sponsor sponsored subscribe toolbar widget""".split())
_COMMENTS = frozenset("comment comments commentlist disqus replies respond".split())

_TOKEN = re.compile(r"""
      <!--(?:-?>|.*?(?:--!?>|\Z))
    | <(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>=]++|=\s*+(?:"[^"]*"|'[^']*')?)*+)(?:>|(?P<cut>\Z))
    | <[!?][^>]*+(?:>|\Z)
    | </(?![A-Za-z])[^>]*+(?:>|\Z)""", re.S | re.X)
_ATTR = re.compile(r"""([^\s=/"'<>]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
_WORD = re.compile("[a-z0-9]+")


def _words(attrs: str) -> tuple[set[str], set[str]]:
    """(roles and flags, words of class and id) of a tag's attributes."""
    roles, words = set(), set()
    for name, *values in _ATTR.findall(attrs):
        name, value = name.lower(), "".join(values).lower()
        if name == "role":
            roles.update(value.split())
        elif name == "hidden":
            roles.add("hidden")
        elif name in ("class", "id"):
            words.update(_WORD.findall(value))
    return roles, words


# What an open element says of the text in it.
_PLAIN, _ARTICLE, _MAIN, _NAMED, _BESIDE = range(5)


def _part(name: str, attrs: str, inside: bool) -> int:
    """The kind of part that a start tag opens; ``inside``: within an article or main."""
    if name in _NEVER or name == "header" and not inside:
        return _BESIDE
    if not attrs or attrs.isspace() or name in ("html", "body"):
        return {"article": _ARTICLE, "main": _MAIN}.get(name, _PLAIN)
    roles, words = _words(attrs)
    if "hidden" in roles or words & _COMMENTS or roles & _ROLES:
        return _BESIDE
    if name == "article":
        return _ARTICLE
    if name == "main" or "main" in roles:
        return _MAIN
    return _NAMED if words & _PARTS or not inside and "header" in words else _PLAIN


def lines_of(html: str) -> list[tuple[int, str]]:
    """(part, text) of each block with text, in page order."""
    lines: list[tuple[int, str]] = []
    text: list[str] = []
    stack: list[tuple[str, int]] = []  # open elements and the part that holds in them
    state, at = _PLAIN, 0

    def flush() -> None:
        line = " ".join("".join(text).split())
        if line:
            lines.append((state, line))
        text.clear()

    while True:
        m = _TOKEN.search(html, at)
        piece = html[at:m.start() if m else len(html)]
        if piece:
            text.append(entities.unescape(piece) if "&" in piece else piece)
        if not m:
            break
        at = m.end()
        name = m["name"]
        if name is None or m["cut"] is not None:
            continue
        name = name.lower()
        if m["close"]:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if name in _BLOCKS or depth is not None and stack[depth][1] != state:
                flush()
            if depth is not None:
                del stack[depth:]
                state = stack[-1][1] if stack else _PLAIN
            elif name == "p":
                flush()
        elif name == "br":
            text.append(" ")
        elif name in _RAW:
            end = re.compile(f"</{name}(?=[\\s/>])", re.I).search(html, at)
            at = end.start() if end else len(html)
            if name == "iframe":
                flush()
        else:
            if name in _BLOCKS or name in _NEVER:
                flush()
            if name in _VOID or m["attrs"].endswith("/"):
                continue
            if name in ("p", "li", "option", "td", "th", "tr", "dt", "dd") and stack and stack[-1][0] == name:
                stack.pop()  # these end where the next one begins
                state = stack[-1][1] if stack else _PLAIN
            kind = _part(name, m["attrs"], any(s in (_ARTICLE, _MAIN) for _, s in stack))
            # nothing inside a part beside the article counts, but a wrapper that only a word named may hold the article
            if state == _BESIDE or kind == _PLAIN or state == _NAMED and kind not in (_ARTICLE, _MAIN, _BESIDE):
                kind = state
            elif kind == _MAIN and state == _ARTICLE:
                kind = state
            if kind != state:
                flush()
            stack.append((name, kind))
            state = kind
    flush()
    return lines


def _rows(a: list, b: list) -> list[int]:
    """Rows of the bit-parallel LCS of a (bits) and b (rows): zeros mark where the length grows."""
    masks: dict = {}
    for i, x in enumerate(a):
        masks[x] = masks.get(x, 0) | 1 << i
    row, full, out = (1 << len(a)) - 1, (1 << len(a)) - 1, []
    for x in b:
        hit = row & masks.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
        out.append(row)
    return out


def _prefix_lengths(a: list, b: list) -> np.ndarray:
    """LCS lengths of b with each beginning of a."""
    row = _rows(a, b)[-1]
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(a) // 8 + 1, "little"), np.uint8), bitorder="little")[:len(a)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def common(a: list, b: list) -> list[int]:
    """Positions in ``a`` of a longest common subsequence with ``b``."""
    of_b, of_a = set(b), set(a)
    where = [i for i, x in enumerate(a) if x in of_b]
    return [where[i] for i in _common([a[i] for i in where], [x for x in b if x in of_a])]


def _common(a: list, b: list) -> list[int]:
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    ends = list(range(head)), list(range(len(a) - tail, len(a)))
    a, b = a[head:len(a) - tail], b[head:len(b) - tail]
    if not a or not b:
        return ends[0] + ends[1]
    if len(a) * len(b) > ALIGN_BITS and len(b) > 1:
        half = len(b) // 2
        left = _prefix_lengths(a, b[:half])
        right = _prefix_lengths(a[::-1], b[half:][::-1])[::-1]
        cut = int((left + right).argmax())
        middle = _common(a[:cut], b[:half]) + [cut + i for i in _common(a[cut:], b[half:])]
    else:
        rows, middle = _rows(a, b), []
        i, j = len(a), len(b)
        while i and j:
            if rows[j - 1] >> (i - 1) & 1:
                i -= 1
            else:
                j -= 1
                if not j or rows[j - 1] >> (i - 1) & 1:
                    i -= 1
                    middle.append(i)
        middle.reverse()
    return ends[0] + [head + i for i in middle] + ends[1]


@dataclass
class _Page:
    key: tuple
    page_id: int | None
    url: str | None
    ghost: bool
    lines: list[tuple[int, str]]
    texts: list[str] = field(init=False)

    def __post_init__(self):
        self.texts = [t for _, t in self.lines]


def _near(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def extract(page: _Page, before: _Page | None, after: _Page | None) -> tuple[str, int]:
    """(main text, lines shared with the nearest page)."""
    usable = [p for p in (before, after) if p is not None and page.key[1] and p.key[:2] == page.key[:2]
              and p.texts != page.texts]
    nearest = max(usable, key=lambda p: _near(page.key[2], p.key[2]), default=None)
    shared = set(common(page.texts, nearest.texts)) if nearest else set()
    kinds = {k for k, _ in page.lines}
    own = _ARTICLE if _ARTICLE in kinds else _MAIN
    kept = [t for i, (k, t) in enumerate(page.lines)
            if k == own or k not in (_NAMED, _BESIDE) and i not in shared]
    return "\n".join(kept), len(shared)


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    before = page = None
    out: list[tuple] = []
    size = 0

    def done(after: _Page | None) -> None:
        nonlocal size
        if page is not None and not page.ghost:
            text, shared = extract(page, before, after)
            size += len(text)
            out.append((page.page_id, page.url, text, len(text), shared))

    def batch_of() -> pa.RecordBatch:
        columns = list(zip(*out))
        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)],
                               names=["page_id", "url", "text", "n_chars", "n_shared"])

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("part", "host", "path", "page_id", "url", "ghost")]
        for i, (part, host, path, page_id, url, ghost) in enumerate(zip(*columns)):
            html = batch.column("html")[i].as_py()
            read = _Page((part, host, path), page_id, url, ghost, lines_of(html) if html else [])
            done(read)
            before, page = page, read
            if size > 1 << 22 or len(out) > 2000:
                yield batch_of()
                out.clear()
                size = 0
    done(None)
    if out:
        yield batch_of()


def main_text(pages: DataFrame) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars, n_shared."""
    spark = pages.sparkSession
    keyed = pages.select(
        F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)).alias("host"),
        F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1).alias("path"),
        F.col("page_id").cast("long").alias("page_id"), "url", "html")
    key = F.struct(F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"),
                   F.coalesce("page_id", F.lit(-1)).alias("page_id"))
    pages_n = keyed.count()
    parts = min(max(pages_n // PART_PAGES, 1), MOST_PARTS)
    share = int(min(1.0, SAMPLES * parts / max(pages_n, 1)) * (1 << 30))
    sample = [r["k"] for r in keyed.select(key.alias("k")).filter(F.pmod(F.xxhash64("k"), F.lit(1 << 30)) < share)
              .collect()]
    sample.sort()
    splits = sorted({tuple(sample[i * len(sample) // parts]) for i in range(1, parts)}) if sample else []
    # the number of split points at or below a key, first by every 64th; the points are one folded literal
    lists = [[dict(zip(("host", "path", "page_id"), s)) for s in splits[i:i + 64]] for i in range(0, len(splits), 64)]
    points = F.from_json(F.lit(json.dumps(lists)), "array<array<struct<host:string,path:string,page_id:bigint>>>")
    above = F.size(F.filter(points, lambda ks: ks[0] <= F.col("key")))
    inside = F.size(F.filter(F.get(points, F.col("group") - 1), lambda k: k <= F.col("key")))
    dealt = (keyed.withColumn("key", key).withColumn("group", above)
             .withColumn("part", F.when(F.col("group") > 0, (F.col("group") - 1) * 64 + inside).otherwise(0))
             .drop("group"))
    ends = (dealt.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last"))
            .orderBy("part").collect())  # at most MOST_PARTS rows
    ghosts = [(*tuple(a["last"]), b["part"]) for a, b in zip(ends, ends[1:])] + [
        (*tuple(b["first"]), a["part"]) for a, b in zip(ends, ends[1:])]
    sent = (spark.createDataFrame(ghosts, "host string, path string, page_id bigint, part int")
            .groupBy(F.struct("host", "path", "page_id").alias("key")).agg(F.collect_set("part").alias("also")))
    copies = F.explode(F.concat(F.array(F.struct("part", F.lit(False).alias("ghost"))),
                                F.transform(F.coalesce("also", F.array().cast("array<int>")),
                                            lambda p: F.struct(p.alias("part"), F.lit(True).alias("ghost")))))
    spread = (dealt.join(F.broadcast(sent), "key", "left").withColumn("copy", copies)
              .select("copy.part", "copy.ghost", "host", "path", "page_id", "url", "html")
              .repartition(len(ends) or 1, "part")
              .sortWithinPartitions("part", "host", "path", "page_id", F.xxhash64("html"), "ghost"))
    return arrow_map(spread, _extracted, "page_id bigint, url string, text string, n_chars bigint, n_shared bigint")
