"""Main text of web pages by wrapper induction.

The element trees of pages of one host are aligned by simple tree matching: two trees match by their roots' labels (element
and class) and the best order-keeping matching of their children, found by dynamic programming. Each host has two
reference pages, and so has each of its layouts: the pages whose containers near the root have the same paths. Every page is aligned
with the references of its host and of its layout, and each text slot of a reference is counted: in how many pages it is
aligned, in how many with equal text. Slots with the same text in nearly all pages are the template; the text of varying
slots is content. A page that repeats most of a reference's text is a copy of it and no evidence about the template.
A layout of too few pages to tell has the host's references only.

Varying slots also hold menus, adverts and footers that differ from page to page. Those are told by the element or the name
of the part they stand in (nav, footer, aside, form, ..., or class, id and role words such as "ad" or "comments"). If a page
marks its article, only that is content.

The references and templates of all hosts go to the tasks as a broadcast while they are small, else by a join on the host;
the results are the same. Counting is done inside the tasks before the shuffle, so a hot host costs a few rows per task.

Null and empty pages have an empty text, pages without host are read without a template. Repeated rows give repeated
results, other columns are ignored, an empty table gives no rows. No length is limited.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from vellum.llm.common import write_shared
from vellum.llm.dom import Node, articles, content, parse

KEPT = 200_000


@dataclass(frozen=True)
class WrapperConfig:
    """share: of the aligned pages that must agree on a slot's text. pages: that must be aligned there, and that a layout must
    have. depth: of the paths that tell layouts apart. sent: bytes of a broadcast."""

    share: float = 0.8
    pages: int = 4
    depth: int = 4
    copy: float = 0.5
    sent: int = 32 << 20


class Matcher:
    """Simple tree matching of one page tree with another; equal structures are recognised by number."""

    def __init__(self) -> None:
        self.numbers: dict[tuple, int] = {}
        self.scores: dict[tuple[int, int], int] = {}

    def measured(self, root: Node) -> list[Node]:
        """Number the structures and sizes of all subtrees; the text leaves in page order, each node knowing its range."""
        leaves: list[Node] = []
        todo: list[tuple[Node, bool]] = [(root, False)]
        while todo:
            node, done = todo.pop()
            if done or not node.children:
                if not done:
                    node.first = len(leaves)
                    if node.text is not None:
                        leaves.append(node)
                node.last = len(leaves)
                key = (node.label, *[c.sig for c in node.children])
                node.sig = self.numbers.setdefault(key, len(self.numbers))
                node.size = 1 + sum([c.size for c in node.children])
            else:
                node.first = len(leaves)
                todo.append((node, True))
                todo.extend((c, False) for c in reversed(node.children))
        return leaves

    def trimmed(self, a: list[Node], b: list[Node]) -> tuple[int, int]:
        """How many children at the start and at the end have equal structures; matching those to each other is optimal."""
        n = min(len(a), len(b))
        start = 0
        while start < n and a[start].sig == b[start].sig:
            start += 1
        end = 0
        while end < n - start and a[-1 - end].sig == b[-1 - end].sig:
            end += 1
        return start, end

    def score(self, a: Node, b: Node) -> int:
        """Size of the largest matching of two subtrees with each other."""
        if a.sig == b.sig:
            return a.size
        if a.label != b.label:
            return 0
        key = (a.sig, b.sig)
        known = self.scores.get(key)
        if known is None:
            start, end = self.trimmed(a.children, b.children)
            known = 1 + sum([c.size for c in a.children[:start]]) + sum([c.size for c in a.children[len(a.children) - end :]])
            table = self.table(a.children[start : len(a.children) - end], b.children[start : len(b.children) - end])
            known += table[-1][-1]
            if len(self.scores) >= KEPT:
                self.scores.clear()
            self.scores[key] = known
        return known

    def table(self, a: list[Node], b: list[Node]) -> list[list[int]]:
        """Best matchings of the first children of both."""
        rows = [[0] * (len(b) + 1)]
        for x in a:
            above, row = rows[-1], [0]
            for j, y in enumerate(b):
                best = max(above[j + 1], row[j])
                if x.label == y.label:
                    best = max(best, above[j] + self.score(x, y))
                row.append(best)
            rows.append(row)
        return rows

    def aligned(self, a: Node, b: Node) -> list[tuple[int, int]]:
        """Pairs of text leaves (by number) that the best matching of two trees aligns."""
        pairs: list[tuple[int, int]] = []
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            if a.sig == b.sig:
                pairs.extend(zip(range(a.first, a.last), range(b.first, b.last), strict=True))
                continue
            x, y = a.children, b.children
            start, end = self.trimmed(x, y)
            todo.extend(zip(x[:start], y[:start], strict=True))
            todo.extend(zip(x[len(x) - end :], y[len(y) - end :], strict=True))
            x, y = x[start : len(x) - end], y[start : len(y) - end]
            table = self.table(x, y)
            i, j = len(x), len(y)
            while i and j:
                if table[i][j] == table[i - 1][j]:
                    i -= 1
                elif table[i][j] == table[i][j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    todo.append((x[i], y[j]))
        return pairs


def within(parts: list[Node]) -> set[int]:
    """Numbers of the text leaves of the parts that no noise holds."""
    found, todo = set(), list(parts)
    while todo:
        node = todo.pop()
        if node.text is not None:
            found.add(node.first)
        elif not node.noise:
            todo.extend(node.children)
    return found


#: Elements whose presence tells layouts apart; what an article is written in does not.
CONTAINERS = frozenset("html body div section header footer nav aside main article form table".split())


def layout(root: Node, depth: int) -> str:
    """The layout of a page: the distinct paths of its containers down to a depth, as a short digest.

    Containers inside an article or inside noise are left out, and so is one without a class below the second level.
    """
    paths = set()
    todo = [(root, "", 0)]
    while todo:
        node, path, level = todo.pop()
        for c in node.children:
            if c.tag in CONTAINERS and (level < 2 or c.label != c.tag or c.tag != "div"):
                inner = f"{path}/{c.label}"
                paths.add(inner)
                if level + 1 < depth and c.tag != "article" and not c.noise:
                    todo.append((c, inner, level + 1))
    return hashlib.md5("\n".join(sorted(paths)).encode()).hexdigest()[:16]


class Wrapper:
    """Two reference pages of a host or of one of its layouts, and the template slots of each."""

    def __init__(self, matcher: Matcher, pages: list[str], slots: list[list[int]]):
        self.trees = [parse(p) for p in pages]
        self.leaves = [matcher.measured(t) for t in self.trees]
        self.texts = [[leaf.text.strip() for leaf in leaves] for leaves in self.leaves]
        self.slots = [set(s) for s in slots]


class Extractor:
    """Aligns pages with the references of their host and of their layout."""

    def __init__(self, config: WrapperConfig):
        self.config, self.matcher = config, Matcher()
        self.wrappers: dict[tuple[str, str], Wrapper] = {}

    def wrapper(self, key: tuple[str, str], pages: list[str], slots: list[list[int]]) -> Wrapper:
        if len(self.matcher.numbers) > KEPT or len(self.wrappers) > 256:
            self.matcher, self.wrappers = Matcher(), {}
        known = self.wrappers.get(key)
        if known is None:
            known = self.wrappers[key] = Wrapper(self.matcher, pages, slots)
        return known

    def evidence(self, tree: Node, leaves: list[Node], wrapper: Wrapper) -> Iterator[tuple[int, int, bool]]:
        """(reference, slot, whether the texts are equal) of the slots that a page shares with the references."""
        own = within(articles(tree))
        mass = sum([len(leaves[i].text) for i in own])
        for which, texts in enumerate(wrapper.texts):
            pairs = self.matcher.aligned(wrapper.trees[which], tree)
            equal = [texts[i] == leaves[j].text.strip() for i, j in pairs]
            same = sum([len(leaves[j].text) for (_, j), e in zip(pairs, equal, strict=True) if e and j in own])
            if same <= self.config.copy * mass:
                yield from ((which, i, e) for (i, _), e in zip(pairs, equal, strict=True))

    def template(self, tree: Node, leaves: list[Node], wrapper: Wrapper) -> set[int]:
        """The leaves of a page (by identity) that are template."""
        found = set()
        for which, slots in enumerate(wrapper.slots):
            if slots:
                for i, j in self.matcher.aligned(wrapper.trees[which], tree):
                    if i in slots and wrapper.texts[which][i] == leaves[j].text.strip():
                        found.add(id(leaves[j]))
        return found


def host_of(url: str = "url") -> Column:
    """The host of an address in lower case, empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1), F.lit("")))


#: What pages are sent with: references and their slots by host and layout, the layout of a host's own being empty.
Sent = dict[tuple[str, str], tuple[list[str], list[list[int]]]]
WRAPPER = "array<struct<layout: string, refs: array<string>, slots: array<array<int>>>>"


def attached(pages: DataFrame, wrappers: DataFrame, config: WrapperConfig) -> tuple[DataFrame, Sent | None]:
    """Pages (host, layout, ..) with the wrappers of their host and layout, by a broadcast of checked size or by joins.

    For the joins ``layout`` is worked out before; with a broadcast the tasks do that as they go.
    """
    size = wrappers.agg(F.sum(F.aggregate("refs", F.lit(0).cast("long"), lambda s, x: s + F.octet_length(x)))).first()[0] or 0
    if size <= config.sent:
        found = {(r["host"], r["layout"]): (r["refs"], r["slots"]) for r in wrappers.collect()}
        return pages.withColumn("wrappers", F.lit(None).cast(WRAPPER)), found
    one = wrappers.select("host", "layout", F.struct("layout", "refs", "slots").alias("wrapper"))
    general = one.filter("layout = ''").select("host", F.col("wrapper").alias("general"))
    special = one.filter("layout <> ''").select("host", "layout", F.col("wrapper").alias("special"))
    columns = pages.columns
    placed = with_layout(pages, config).join(general, "host", "left").join(special, ["host", "layout"], "left")
    return placed.select(*columns, F.array_compact(F.array("general", "special")).alias("wrappers")), None


def with_layout(pages: DataFrame, config: WrapperConfig) -> DataFrame:
    """Pages with their layout as one more column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [layout(parse(p), config.depth) for p in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], [*batch.schema.names, "layout"])

    return pages.mapInArrow(run, StructType([*pages.schema.fields, StructField("layout", StringType())]))


def wrapped(batch: pa.RecordBatch, extractor: Extractor, sent: Sent | None) -> Iterator[tuple[str, Node, list[Node], list[tuple[str, Wrapper]]]]:
    """(host, tree, leaves, [(layout, wrapper)]) of each row."""
    hosts, pages = batch.column("host").to_pylist(), batch.column("html").to_pylist()
    for row, (host, page) in enumerate(zip(hosts, pages, strict=True)):
        tree = parse(page)
        if sent is not None:
            keys = [(host, ""), (host, layout(tree, extractor.config.depth))] if (host, "") in sent else []
            held = [(k, *sent[k]) for k in keys if k in sent]
        else:
            held = [((host, w["layout"]), w["refs"], w["slots"]) for w in batch.column("wrappers")[row].as_py() or []]
        found = [(key[1], extractor.wrapper(key, refs, slots)) for key, refs, slots in held]
        yield host, tree, extractor.matcher.measured(tree) if found else [], found


def references(pages: DataFrame, config: WrapperConfig) -> DataFrame:
    """(host, layout, refs): two pages of each host (the same one, if it has one), and of each layout of enough pages unless
    they are the host's."""
    known = pages.filter("host <> ''").withColumn("pick", F.xxhash64("page_id", "html"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [layout(parse(p), config.depth) for p in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(found, pa.string()), batch.column("pick")], ["host", "layout", "pick"])

    signed = known.select("host", "html", "pick").mapInArrow(sign, "host string, layout string, pick long")
    picked = signed.groupBy("host", "layout").agg(F.min("pick").alias("lo"), F.max("pick").alias("hi"), F.count(F.lit(1)).alias("n"))
    picked = write_shared(picked, "layouts")
    general = picked.groupBy("host").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    special = picked.filter(F.col("n") >= config.pages).join(general.withColumnsRenamed({"lo": "first", "hi": "last"}), "host")
    special = special.filter("lo <> first OR hi <> last").select("host", "layout", "lo", "hi")
    picks = general.select("host", F.lit("").alias("layout"), "lo", "hi").unionByName(special)
    picks = picks.select("host", "layout", F.explode(F.array_distinct(F.array("lo", "hi"))).alias("pick"))
    chosen = known.select("host", "pick", "html").join(picks.select("host", "pick").distinct(), ["host", "pick"], "left_semi")
    refs = chosen.dropDuplicates(["host", "pick"]).join(picks, ["host", "pick"])
    refs = refs.groupBy("host", "layout").agg(F.sort_array(F.collect_list(F.struct("pick", "html"))).alias("refs"))  # two at most
    return refs.select("host", "layout", F.transform("refs", lambda r: r["html"]).alias("refs"))


def induced(pages: DataFrame, config: WrapperConfig) -> DataFrame:
    """(host, layout, refs, slots): the reference pages and their template slots."""
    refs = references(pages, config)
    refs = write_shared(refs.withColumn("slots", F.transform("refs", lambda r: F.array().cast("array<int>"))), "references")
    rows, sent = attached(pages.filter("host <> ''").select("host", "html"), refs, config)
    shared = pages.sparkSession.sparkContext.broadcast(sent)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extractor, counts = Extractor(config), {}

        def emptied() -> pa.RecordBatch:
            keys, values = list(counts), list(counts.values())
            columns = [[k[i] for k in keys] for i in range(4)] + [[v[i] for v in values] for i in range(2)]
            kinds = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
            counts.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["host", "layout", "which", "slot", "aligned", "equal"]
            )

        for batch in batches:
            for host, tree, leaves, wrappers in wrapped(batch, extractor, shared.value):
                for name, wrapper in wrappers:
                    for which, slot, equal in extractor.evidence(tree, leaves, wrapper):
                        entry = counts.setdefault((host, name, which, slot), [0, 0])
                        entry[0] += 1
                        entry[1] += equal
            if len(counts) > KEPT:
                yield emptied()
        if counts:
            yield emptied()

    counted = rows.mapInArrow(count, "host string, layout string, which int, slot int, aligned long, equal long")
    counted = counted.groupBy("host", "layout", "which", "slot").agg(F.sum("aligned").alias("aligned"), F.sum("equal").alias("equal"))
    constant = counted.filter((F.col("aligned") >= config.pages) & (F.col("equal") >= config.share * F.col("aligned")))
    slots = constant.groupBy("host", "layout").agg(F.collect_list(F.struct("which", "slot")).alias("found"))  # slots of two pages
    one = F.transform("refs", lambda r, i: F.transform(F.filter("found", lambda f: f["which"] == i), lambda f: f["slot"]))
    empty = F.transform("refs", lambda r: F.array().cast("array<int>"))
    slots = refs.drop("slots").join(slots, ["host", "layout"], "left")
    return slots.select("host", "layout", "refs", F.when(F.col("found").isNull(), empty).otherwise(one).alias("slots"))


def main_texts(pages: DataFrame, config: WrapperConfig | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    config = config or WrapperConfig()
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host_of().alias("host"))
    wrappers = write_shared(induced(rows, config), "wrappers")
    rows, sent = attached(rows, wrappers, config)
    shared = pages.sparkSession.sparkContext.broadcast(sent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extractor = Extractor(config)
        for batch in batches:
            out = []
            for _, tree, leaves, wrappers in wrapped(batch, extractor, shared.value):
                template = set().union(*[extractor.template(tree, leaves, w) for _, w in wrappers])
                out.append(content(articles(tree), template))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
