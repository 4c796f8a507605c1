"""Main text of pages by union-free wrappers inferred from the pages of each host.

A page is a stream of tokens: block elements opening and closing, and text. Streams of a host are aligned
one after the other. Equal neighbours in a stream fold into a repeated group; where two streams disagree,
what one of them lacks becomes an optional group; texts that disagree become a slot. The result is a
regular expression without unions, kept as nested groups: the wrapper of the host.

* Batches align their own pages first; streams of one structure only compare their texts. Partial wrappers
  of a host are merged in two steps, salted before, so a host with a third of all pages is no single task's.
* A text varies if its group is a slot, or if its group was seen on half of the host's distinct pages at most;
  with fewer than three distinct pages every text counts as varying. Equal pages of a host count as one: each
  is weighted by one over their number, counted before.
* Every page is read by its host's wrapper and decided on by itself: its content is the innermost of its articles,
  its main element and its varying texts that holds at least half of the varying text, so articles that are mere
  cards beside a body do not displace it, and a page without them has its other texts. A page without any
  of the three keeps all of its texts. Menus, headers, footers, sidebars, notices, adverts, forms and comments
  are left out by element and by class throughout.

Blocks come in page order, joined by a line feed; character references are decoded and white space is one
space. Defined cases: a null or empty page has an empty text; elements left open end with the element around
them, a paragraph also at the next block; markup cut off at the end of a page is dropped; a page without a
host belongs to the empty host; repeated pages and equal ids are read each; extra columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import tokens
from tidemark.llm.common import broadcast_if_small, stored

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|iframe|textarea|select|button)\b.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][\w:-]*)([^>]*)(>|\Z)|<[!?][^>]*(?:>|\Z)|([^<]+|<)", re.S | re.I)
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
HIDDEN = re.compile(r"\shidden\b|display\s*:\s*none", re.I)
# Fixed values of HTML: elements inside a line, elements without content, and elements around the content.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby rp rt s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ASIDE = frozenset("nav aside footer form head title menu dialog fieldset figcaption".split())
# Words in a class, id or role that name what surrounds the content.
AROUND = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent notice gdpr "
    "sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header masthead comment comments discussion reply replies respond "
    "share sharing social newsletter subscribe signup login search related recommended popular trending widget popup modal overlay "
    "toolbar pagination pager skip alert disclaimer copyright legal tags toc".split()
)
MAIN = frozenset(["article", "main"])
PARAGRAPH_ENDS = frozenset("p div ul ol dl table h1 h2 h3 h4 h5 h6 article section header footer nav aside form pre blockquote main hr".split())
SLOT = None


def label(name: str, attributes: str) -> str:
    """An element with the words of its class, id and role that tell its part in the page."""
    if not attributes.strip():
        return name
    words = {w for m in NAMED.finditer(attributes) for w in re.split(r"[^a-z0-9]+", next(g for g in m.groups() if g is not None).lower())}
    told = sorted(words & AROUND) + (["main"] if "main" in words and name != "main" else []) + (["hidden"] if HIDDEN.search(attributes) else [])
    return ".".join([name, *told])


def read(page: str) -> list[tuple[tuple[str, ...], str]]:
    """The page's blocks: the groups a block lies in, outermost first, and its text."""
    path: list[str] = []
    out: list[tuple[tuple[str, ...], str]] = []
    text: list[str] = []

    def end_block() -> None:
        if text:
            words = " ".join(html.unescape("".join(text)).split())
            text.clear()
            if words:
                out.append((tuple(path), words))

    for m in TOKEN.finditer(page):
        if m[6] is not None:
            if m[6] != "<":
                text.append(m[6])
            elif m.end() < len(page):
                text.append("<")
            continue
        if m[3] is None:
            if m[1]:
                text.append(" ")
            continue
        name = m[3].lower()
        if name == "br":
            text.append(" ")
            continue
        if name in INLINE or not m[5]:
            continue
        end_block()
        if m[2]:
            for i in range(len(path) - 1, -1, -1):
                if path[i].partition(".")[0] == name:
                    del path[i:]
                    break
            continue
        if path and path[-1].partition(".")[0] == "p" and name in PARAGRAPH_ENDS or path and path[-1].partition(".")[0] == name and name in ("li", "td", "th", "tr", "dt", "dd", "option"):
            path.pop()
        if name not in VOID and not m[4].rstrip().endswith("/"):
            path.append(label(name, m[4]))
    end_block()
    return out


# A wrapper group: [label, text, mass, optional, repeated, [groups], distinct pages]; text is SLOT where it varies, "" where there is none.
def stream(blocks: list[tuple[tuple[str, ...], str]], weight: float = 1.0) -> list:
    """A page as a wrapper of its own, equal neighbours folded into repeated groups."""
    root = ["", "", 0, False, False, [], weight]
    open_: list[list] = [root]
    names: list[str] = []
    for path, text in blocks:
        keep = 0
        while keep < min(len(names), len(path)) and names[keep] == path[keep]:
            keep += 1
        if keep == len(path) and keep and keep == len(names):
            keep -= 1  # another element of the same kind
        del open_[keep + 1 :]
        names = list(path)
        for name in path[keep:]:
            group = [name, "", 0, False, False, [], weight]
            open_[-1][5].append(group)
            open_.append(group)
        group = open_[-1]
        group[1] = text if group[1] in ("", text) else SLOT
        group[2] += len(text)
    return fold(root)


def fold(group: list) -> list:
    out: list[list] = []
    for child in map(fold, group[5]):
        if out and out[-1][0] == child[0]:
            out[-1] = align(out[-1], child, add=True)
            out[-1][4] = True
        else:
            out.append(child)
    group[5] = out
    return group


def align(a: list, b: list, add: bool = False) -> list:
    """The wrapper of both: common groups aligned in order, the others optional.

    ``mass`` is the text per page; add: both are parts of one page.
    """
    left, right = a[5], b[5]
    n, m = len(left), len(right)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if left[i][0] == right[j][0] else max(best[i + 1][j], best[i][j + 1])
    groups, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and left[i][0] == right[j][0]:
            groups.append(align(left[i], right[j], add))
            i, j = i + 1, j + 1
        elif j == m or i < n and best[i + 1][j] >= best[i][j + 1]:
            groups.append([*left[i][:3], True, *left[i][4:]])
            i += 1
        else:
            groups.append([*right[j][:3], True, *right[j][4:]])
            j += 1
    text = a[1] if a[1] == b[1] else SLOT
    return [a[0], text, a[2] + b[2] if add else max(a[2], b[2]), a[3] or b[3], a[4] or b[4], groups, max(a[6], b[6]) if add else a[6] + b[6]]


def around(name: str) -> bool:
    tag, *words = name.split(".")
    return tag in ASIDE or "hidden" in words or any(w in AROUND for w in words)


#: Bits of a group: in an article, in a main element, with text that varies, outside of what surrounds the content.
ARTICLE, MAIN_PART, VARIES, BODY = 1, 2, 4, 8


def main_groups(wrapper: list) -> dict[tuple[str, ...], int]:
    """The bits of the groups by their paths, as far as their text can be a page's content."""
    pages = wrapper[6]
    out: dict[tuple[str, ...], int] = {}

    def visit(group: list, path: tuple[str, ...], within: int, body: bool) -> None:
        tag = group[0].partition(".")[0]
        body = body and tag != "header"
        if body and path and (tag in MAIN or group[0].endswith(".main")):
            within |= ARTICLE if tag == "article" else MAIN_PART
        # weights of copies add up to a page but for their last digits
        varies = group[1] is SLOT or group[1] != "" and (pages < 2.5 or group[6] <= pages / 2 + 1e-6)
        if within or body:
            out[path] = out.get(path, 0) | within | (BODY | VARIES * varies if body else 0)
        for child in group[5]:
            if not around(child[0]):
                visit(child, (*path, child[0]), within, body)

    visit(wrapper, (), 0, True)
    return out


def content(blocks: list[tuple[tuple[str, ...], str]], bits: dict[tuple[str, ...], int]) -> list[str]:
    """The texts of a page's content, by the groups of its host."""
    marked = [(bits.get(path, 0), text) for path, text in blocks]

    def mass(of: int) -> int:
        return sum(len(text) for b, text in marked if b & of)

    for part in (ARTICLE, MAIN_PART, VARIES, BODY):
        own = mass(part)
        if own and 2 * own >= mass(part | VARIES):
            return [text for b, text in marked if b & part]
    return []


def _partial(pages: DataFrame) -> DataFrame:
    """(host, pages, wrapper) of every batch of (host, page, copies)."""

    def run(stream_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream_:
            known: dict[str, list] = {}
            for host, page, copies in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                own = stream(read(page.as_py()), 1 / copies)
                if host in known:
                    known[host] = [known[host][0] + 1, align(known[host][1], own)]
                else:
                    known[host] = [1, own]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(known), pa.string()), pa.array([v[0] for v in known.values()], pa.int64()), pa.array([json.dumps(v[1]) for v in known.values()], pa.string())],
                ["host", "pages", "wrapper"],
            )

    return pages.mapInArrow(run, "host string, pages long, wrapper string")


def _merged(group: pa.Table) -> pa.Table:
    wrapper, total = None, 0
    for n, text in sorted(zip(group.column("pages").to_pylist(), group.column("wrapper").to_pylist()), key=lambda x: (-x[0], x[1])):
        wrapper = json.loads(text) if wrapper is None else align(wrapper, json.loads(text))
        total += n
    return pa.table({"host": pa.array([group.column("host")[0].as_py()], pa.string()), "pages": pa.array([total], pa.int64()), "wrapper": pa.array([json.dumps(wrapper)], pa.string())})


def infer(pages: DataFrame) -> DataFrame:
    """(host, pages, wrapper) from (host, page)."""
    schema = "host string, pages long, wrapper string"
    hashed = pages.withColumn("hash", F.xxhash64("page"))
    again = stored(hashed.groupBy("host", "hash").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1"), "equal-pages")
    counted = hashed.join(broadcast_if_small(again), ["host", "hash"], "left").select("host", "page", F.coalesce("copies", F.lit(1)).alias("copies"))
    salted = _partial(counted).withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(16)))
    return salted.groupBy("host", "salt").applyInArrow(_merged, schema).groupBy("host").applyInArrow(_merged, schema)


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    url = F.col(f"`{url_col}`").cast("string")
    rows = pages.select(
        F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit("")).alias("host"),
        F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).alias("page"),
        F.col(f"`{id_col}`").cast("long").alias("id"),
        url.alias("url"),
    )
    inferred = stored(infer(rows.select("host", "page")), "wrappers")
    size = inferred.agg(F.sum(F.octet_length("wrapper"))).first()[0] or 0
    known = inferred if size > 16 << 20 else F.broadcast(inferred)
    joined = rows.join(known, "host", "left").select("id", "url", "page", "wrapper")

    def run(stream_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen: dict[str, dict] = {}
        for batch in stream_:
            for at, to in tokens.chunks(batch.column(2)):
                texts = []
                for page, wrapper in zip(*(batch.column(i).slice(at, to - at) for i in (2, 3))):
                    key = wrapper.as_py()
                    if key not in chosen:
                        if len(chosen) > 10_000:
                            chosen.clear()
                        chosen[key] = main_groups(json.loads(key))
                    texts.append("\n".join(content(read(page.as_py()), chosen[key])))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, to - at), batch.column(1).slice(at, to - at), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    return joined.mapInArrow(run, "page_id long, url string, text string, n_chars long")
