"""Main text of web pages by nearest-URL page differencing.

Pages are paired with the page of the nearest URL path on their host. The text lines of both are aligned by longest common
subsequence; shared lines belong to the site's template and are deleted. What a page marks itself needs no guess: a
paragraph or heading inside its article (or main) element stays even if another page has it too, and menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles and reader comments go by their elements, roles and names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import settle

# Elements by their role in a page.
DROPPED = frozenset(
    "head nav footer aside form script style noscript template button select option textarea iframe svg canvas object "
    "dialog menu input label math title".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BREAKS = frozenset(
    "address article aside blockquote body br caption dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hr html legend li main menu nav ol option p pre section select summary table tbody td textarea tfoot "
    "th thead title tr ul".split()
)
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre dd dt figcaption td th caption".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar widget widgets footer header masthead cookie cookies consent gdpr notice notices "
    "notification alert popup modal overlay newsletter subscribe signup login share sharing social related recommended "
    "recommendations comments comment commentlist replies respond disqus pagination pager toolbar skip".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())

_SPACE = re.compile(r"\s+")
_NAME = re.compile(r"[a-z0-9]+")


class Lines(HTMLParser):
    """The text lines of a page. Each is (text, dropped, container, prose): whether something marks it as no content, the
    number of its article or main element (0: none), and whether it is a paragraph, heading or list entry there.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, bool, int, bool]] = []
        self.open: list[tuple[str, bool, int, bool, bool]] = []  # tag, dropped, container, prose, in header
        self.parts: list[str] = []
        self.containers = 0

    def state(self) -> tuple[str, bool, int, bool, bool]:
        return self.open[-1] if self.open else ("", False, 0, False, False)

    def end_line(self) -> None:
        text = _SPACE.sub(" ", "".join(self.parts)).strip()
        self.parts = []
        if text:
            _, dropped, container, prose, header = self.state()
            self.lines.append((text, dropped or header, container, prose))

    def marked(self, tag: str, attributes: list[tuple[str, str | None]]) -> bool:
        for name, value in attributes:
            value = (value or "").lower()
            if name in ("class", "id") and not NAMES.isdisjoint(_NAME.findall(value)):
                return True
            if name == "role" and value in ROLES or name == "hidden":
                return True
            if name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
                return True
        return False

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BREAKS:
            self.end_line()
        if tag in VOID:
            return
        if tag in ("p", "li") and self.open and self.open[-1][0] == tag:
            self.open.pop()
        _, dropped, container, prose, header = self.state()
        marked = self.marked(tag, attrs)
        if tag in ("article", "main"):
            # An article starts anew: what its surroundings are named does not count, unless they are dropped elements.
            comment = marked or (dropped and container > 0) or any(t in DROPPED for t, *_ in self.open)
            if not comment:
                self.containers += 1
                container, dropped, header = self.containers, False, False
            else:
                dropped = True
            prose = False
        elif tag not in ("html", "body"):
            dropped = dropped or marked or tag in DROPPED
            if tag == "header":
                header = True
            prose = prose or tag in PROSE
        if header and container and re.fullmatch("h[1-6]", tag):
            header = False  # the title of the article
        self.open.append((tag, dropped, container, prose, header))

    def handle_endtag(self, tag: str) -> None:
        if tag in BREAKS:
            self.end_line()
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                # An inline end tag does not close the blocks around it.
                if tag in BREAKS or not any(t in BREAKS for t, *_ in self.open[i + 1 :]):
                    del self.open[i:]
                return

    def handle_data(self, data: str) -> None:
        if self.open and self.open[-1][0] in ("script", "style"):
            return
        self.parts.append(data)


def lines_of(html: str) -> list[tuple[str, bool, int, bool]]:
    parser = Lines()
    parser.feed(html)
    parser.close()
    parser.end_line()
    return parser.lines


def line_hash(text: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def shared_lines(own: list[int], other: list[int]) -> list[int]:
    """Places in ``own`` of a longest common subsequence with ``other``; none if all lines are equal (the same page)."""
    if not own or list(own) == list(other):
        return []
    lead = 0
    while lead < min(len(own), len(other)) and own[lead] == other[lead]:
        lead += 1
    tail = 0
    while tail < min(len(own), len(other)) - lead and own[-1 - tail] == other[-1 - tail]:
        tail += 1
    a, b = own[lead : len(own) - tail], other[lead : len(other) - tail]
    common = set(a) & set(b)
    rows = [i for i, h in enumerate(a) if h in common]
    b = [h for h in b if h in common]
    table = np.zeros((len(rows) + 1, len(b) + 1), np.int32)
    right = np.array(b, np.int64)
    for i in range(len(rows) - 1, -1, -1):
        hit = np.concatenate([np.where(right == a[rows[i]], table[i + 1, 1:] + 1, 0), [0]]).astype(np.int32)
        best = np.maximum(hit, table[i + 1])
        table[i] = np.maximum.accumulate(best[::-1])[::-1]
    inner, i, j = [], 0, 0
    while i < len(rows) and j < len(b):
        if a[rows[i]] == b[j] and table[i, j] == table[i + 1, j + 1] + 1:
            inner.append(lead + rows[i])
            i, j = i + 1, j + 1
        elif table[i + 1, j] >= table[i, j + 1]:
            i += 1
        else:
            j += 1
    return [*range(lead), *inner, *range(len(own) - tail, len(own))]


def main_text(lines: list[tuple[str, bool, int, bool]], shared: set[int]) -> str:
    inside = any(container and not dropped for _, dropped, container, _ in lines)
    kept = []
    for i, (text, dropped, container, prose) in enumerate(lines):
        if dropped or (inside and not container):
            continue
        if i in shared and not (container and prose):
            continue
        kept.append(text)
    return "\n".join(kept)


def _keyed(pages: DataFrame) -> DataFrame:
    address = F.coalesce("url", F.lit(""))
    path = F.regexp_extract(address, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return pages.select(
        F.col("page_id").cast("long").cast("string"), "url", F.coalesce("html", F.lit("")).alias("html"),
        F.xxhash64("page_id", "url", "html").alias("key"),
        F.lower(F.regexp_extract(address, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)).alias("host"),
        F.regexp_replace(path, r"(\.html?)?/*$", "").alias("path"),
    )


def _common_prefix(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def neighbours(paths: DataFrame) -> DataFrame:
    """Of every (host, path, key) with distinct paths the key of the nearest other path of the host: host, path, other.

    Paths are sorted over all hosts by range partitions, so that one large host is spread; only the ends of partitions
    are compared across them (two short rows per partition).
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Two rows are held back, as the nearest may be the next; the ends of the partition are marked.
        held: pd.DataFrame | None = None
        first = True
        for batch in batches:
            if not len(batch):
                continue
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            if len(rows) >= 3:
                yield _nearest(rows, first, False)
                first, held = False, rows.iloc[-2:]
            else:
                held = rows
        if held is not None:
            yield _nearest(held, first, True)

    # Keys that may be null go as text: pandas would make doubles of them.
    names = "host string, path string, key string, other string, near int, edge boolean"
    ordered = paths.repartitionByRange("host", "path").sortWithinPartitions("host", "path")
    found = settle(ordered.mapInPandas(run, names), "near")
    ends = found.where("edge")
    order = Window.orderBy("host", "path")

    def beside(step: int) -> Column:
        return F.lag(F.struct("host", "path", "key"), step).over(order)

    both = ends.select("host", "path", "other", "near", beside(1).alias("p"), beside(-1).alias("n"))

    def ends_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                best = (-1, None) if pd.isna(r.near) or r.near < 0 else (r.near, r.other)
                for x in (r.p, r.n):
                    if x is not None and x["host"] == r.host and _common_prefix(x["path"], r.path) > best[0]:
                        best = (_common_prefix(x["path"], r.path), x["key"])
                out.append((r.host, r.path, best[1]))
            yield pd.DataFrame(out, columns=["host", "path", "other"])

    closed = both.mapInPandas(ends_of, "host string, path string, other string")
    near = found.where("not edge").select("host", "path", "other").unionByName(closed).where("other is not null")
    return near.withColumn("other", F.col("other").cast("long"))


def _nearest(rows: pd.DataFrame, first: bool, last: bool) -> pd.DataFrame:
    """Rows but the held-back ones, with the nearer of the rows before and behind."""
    hosts, paths, keys = rows["host"].tolist(), rows["path"].tolist(), rows["key"].tolist()
    out = []
    begin = 0 if first else 1
    end = len(rows) if last else len(rows) - 1
    for i in range(begin, end):
        best, other = -1, None
        for j in (i - 1, i + 1):
            if 0 <= j < len(rows) and hosts[j] == hosts[i]:
                near = _common_prefix(paths[i], paths[j])
                if near > best:
                    best, other = near, str(keys[j])
        out.append((hosts[i], paths[i], str(keys[i]), other, best, (first and i == 0) or (last and i == len(rows) - 1)))
    return pd.DataFrame(out, columns=["host", "path", "key", "other", "near", "edge"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url and text of every row of ``pages`` (page_id, url, html); other columns are ignored.

    Null html is empty. Pages of one path of a host are not compared with each other, and a page whose lines all equal its
    neighbour's keeps them. A null or odd url has the empty host and path. Repeated rows give repeated results.
    """

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            hashes = [[line_hash(x[0]) for x in lines_of(h)] for h in batch["html"]]
            yield batch[["key", "host", "path"]].assign(hashes=hashes)

    rows = _keyed(pages)
    schema = "key long, host string, path string, hashes array<long>"
    lines = settle(rows.select("key", "host", "path", "html").mapInPandas(hashed, schema), "lines")
    paths = lines.groupBy("host", "path").agg(F.min("key").alias("key"))
    near = neighbours(paths)
    others = lines.select(F.col("key").alias("other"), F.col("hashes").alias("other_hashes")).dropDuplicates(["other"])
    beside = near.join(others, "other").select("host", "path", "other_hashes")
    pairs = lines.dropDuplicates(["key"]).join(beside, ["host", "path"])

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            shared = [shared_lines(list(a), list(b)) for a, b in zip(batch["hashes"], batch["other_hashes"], strict=True)]
            yield pd.DataFrame({"key": batch["key"], "shared": shared})

    aligned = pairs.mapInPandas(align, "key long, shared array<int>").where(F.size("shared") > 0)
    aligned = settle(aligned, "aligned")

    def final(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [
                main_text(lines_of(h), set() if s is None else set(s))
                for h, s in zip(batch["html"], batch["shared"], strict=True)
            ]
            yield batch[["page_id", "url"]].assign(text=texts)

    joined = rows.select("key", "page_id", "url", "html").join(aligned, "key", "left")
    joined = joined.select("page_id", "url", "html", "shared")
    done = joined.mapInPandas(final, "page_id string, url string, text string")
    return done.withColumn("page_id", F.col("page_id").cast("long"))
