"""Main text of HTML pages by wrapper induction.

Up to ``REFERENCES`` pages of a host are merged into one tree: each is aligned with the tree so far by simple tree
matching, and elements without a match are added to it. All pages of the host are then aligned with that tree. An element
of the tree is a slot. A text that stands in the same slot on most of the host's different pages is template; a slot whose
text varies is content, and so is what matches no slot. Pairs of elements with the same text, if several of the merged
pages share it, weigh more in the matching, so that such a block keeps its slot behind lists of any length.
Menus, headers, footers, sidebars, notices, adverts, forms and comments that HTML itself marks (by element, class, id or
role) are left out before, and take no part in the alignment.

Scale: one pass over all pages aligns them and stores their blocks with slots; what a template holds and what a page keeps
are read from there. Copies of a page are one row before blocks are counted, counts are combined in the tasks, and only
texts on at least ``PAGES * SHARE`` pages go further, so a host with a third of all pages adds only counts. What a host
learns is two rows: its tree, and the template's blocks, which are on most pages and so no more than a page or two holds.

* null html: empty text; null url: the pages without a host share one wrapper
* fewer than ``PAGES`` different pages of a host: there is no template, only the marks of HTML
* copies of a page count as one page, so a copied article does not become template
* repeated rows keep their rows; extra columns are dropped, so their names cannot clash; an empty table gives an empty result
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Collection, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens.llm import dom
from loadlens.llm.shared import stored
from loadlens.llm.url_rules import host

#: Different pages that a host needs for a template, and the share of them that must agree on a slot's text.
PAGES = 5
SHARE = 0.6
#: Pages of a host, at most, that are merged into its tree.
REFERENCES = 8

BLOCKS = "array<struct<text: string, slot: int, hash: bigint, in_article: boolean, in_main: boolean, linked: int>>"


def _hash(text: str) -> int:
    return int.from_bytes(xxhash.xxh3_64_digest(text.encode("utf-8", "surrogatepass")), "big", signed=True)


def _marked(page: str, constant: Collection[int] | None) -> tuple[dom.Element, list[dom.Block]]:
    """A page's tree and blocks; elements are marked by those of their texts that are in ``constant``."""
    tree = dom.parse(page)
    found = dom.blocks(tree)
    for x in found if constant else ():
        if (text := _hash(x.text)) in constant:
            x.element.marks += (text,)
    dom.measured(tree)
    return tree, found


def merged(pages: list[str]) -> dom.Element:
    """One tree of several pages, marked by the texts that two of them or more share."""
    counts = Counter(text for page in pages for text in {_hash(x.text) for x in _marked(page, None)[1]})
    shared = {text for text, n in counts.items() if n > 1}
    tree, known = dom.load("[]"), {}
    for page in pages:
        dom.merge(tree, _marked(page, shared)[0], known)
    return tree


class Reference:
    """A host's merged tree; the texts it is marked by; and sizes of matchings with it, for the next page."""

    def __init__(self, tree: dom.Element):
        self.tree, self.known = tree, {}
        self.constant = {text for element in dom.measured(tree) for text in element.marks}


class References:
    """Trees of a task; a few hosts at a time."""

    def __init__(self):
        self.trees: dict[str, Reference] = {}

    def get(self, dumped: str) -> Reference:
        if dumped not in self.trees:
            if len(self.trees) >= 64:
                self.trees.clear()
            self.trees[dumped] = Reference(dom.load(dumped))
        return self.trees[dumped]


def aligned(page: str, reference: Reference) -> list[tuple[dom.Block, int]]:
    """The blocks of a page, each with the number of the reference's element that its element matches, or -1."""
    tree, found = _marked(page, reference.constant)
    pairs = dom.match(tree, reference.tree, reference.known)
    return [(x, pairs.get(x.element.number, -1)) for x in found]


def main_text(found: list[tuple[dom.Block, int]], template: Collection[tuple[int, int]]) -> str:
    """Blocks that are not template: those in articles if they hold most of the text, else those in main if they do, else
    all; outside of articles and main only those that are not mostly links. Linked text does not count."""
    left = [x for x, slot in found if (slot, _hash(x.text)) not in template]
    size = lambda some: sum(max(0, len(x.text) - x.linked) for x in some)
    for inner in ([x for x in left if x.in_article], [x for x in left if x.in_main]):
        if inner and 2 * size(inner) >= size(left):
            break
    else:
        inner = [x for x in left if x.in_article or x.in_main or 2 * x.linked <= len(x.text)]
    return "\n\n".join(x.text for x in inner)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, pages) to (host, reference)."""
    for batch in batches:
        trees = pa.array((dom.dump(merged(x.as_py())) for x in batch["pages"]), pa.string())
        yield pa.RecordBatch.from_arrays([batch["host"], trees], names=["host", "reference"])


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to (html, reference, ...) the page's hash and blocks, in place of these two."""
    references = References()
    item = pa.struct(
        [("text", pa.string()), ("slot", pa.int32()), ("hash", pa.int64()), ("in_article", pa.bool_()), ("in_main", pa.bool_()), ("linked", pa.int32())]
    )
    for batch in batches:
        pages, blocks = [], []
        for html, reference in zip(batch["html"], batch["reference"], strict=True):
            html = html.as_py()
            found = aligned(html, references.get(reference.as_py()))
            pages.append(_hash(html))
            blocks.append([(x.text, slot, _hash(x.text), x.in_article, x.in_main, x.linked) for x, slot in found])
        rest = batch.drop_columns(["html", "reference"])
        arrays = [*rest.columns, pa.array(pages, pa.int64()), pa.array(blocks, pa.list_(item))]
        yield pa.RecordBatch.from_arrays(arrays, names=[*rest.schema.names, "page", "blocks"])


def references(pages: DataFrame) -> DataFrame:
    """From (host, html): host, reference (its dumped tree); one row per host."""
    # of each of some hash buckets the page of smallest hash; combined in the tasks, so that a host with many pages sends
    # a few of each task
    bucket = F.pmod(F.xxhash64(F.lit(5), "html"), F.lit(REFERENCES))
    least = pages.groupBy("host", bucket.alias("bucket")).agg(F.min_by("html", F.struct(F.xxhash64("html"), "html")).alias("html"))
    some = least.groupBy("host").agg(F.transform(F.array_sort(F.collect_list(F.struct("bucket", "html"))), lambda x: x["html"]).alias("pages"))
    return some.mapInArrow(_merge, "host string, reference string")


def templates(found: DataFrame) -> DataFrame:
    """From (host, page, blocks): host, template (array of slot and text hash); one row per host that has one."""
    slots = F.array_distinct(F.transform("blocks", lambda x: F.struct(x["slot"].alias("slot"), x["hash"].alias("text"))))
    pages = found.groupBy("host", "page").agg(F.first(F.filter(slots, lambda x: x["slot"] >= 0)).alias("slots"))
    pages = stored(pages, "slots")
    totals = pages.groupBy("host").agg(F.count("*").alias("pages")).where(F.col("pages") >= PAGES)
    counts = pages.select("host", F.explode("slots").alias("s")).groupBy("host", "s").agg(F.count("*").alias("n"))
    held = counts.where(F.col("n") >= PAGES * SHARE).join(totals, "host").where(F.col("n") >= SHARE * F.col("pages"))
    return held.groupBy("host").agg(F.collect_list("s").alias("template"))


def extract(pages: DataFrame, page_host: Column | None = None) -> DataFrame:
    """``pages`` (page_id, url, html): page_id, url, text."""
    name = host(F.col("url")) if page_host is None else page_host
    own = pages.select("page_id", "url", F.coalesce(name, F.lit("")).alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    trees = stored(references(own.select("host", "html")), "references")
    columns = own.select("page_id", "url", "host")
    given = T.StructType([*columns.schema.fields, T.StructField("page", T.LongType()), T.StructField("blocks", T.DataType.fromDDL(BLOCKS))])
    found = stored(own.join(trees, "host").select("page_id", "url", "host", "html", "reference").mapInArrow(_align, given), "blocks")

    @F.arrow_udf("string")
    def text(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for blocks, template in batches:
            out = []
            for page, slots in zip(blocks, template, strict=True):
                left = [(dom.Block(x["text"], None, x["in_article"], x["in_main"], x["linked"]), x["slot"]) for x in page.as_py()]
                out.append(main_text(left, {(s["slot"], s["text"]) for s in slots.as_py() or ()}))
            yield pa.array(out, pa.string())

    # stored, so that Spark knows its size: small ones are broadcast, and texts are not shuffled for them
    return found.join(stored(templates(found), "templates"), "host", "left").select("page_id", "url", text("blocks", "template").alias("text"))
