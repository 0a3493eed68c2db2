"""Main text of web pages by templates deduced from the pages of a host.

Tokens of a page are its start tags, told apart by their path, names and (for nameless boxes) position, and its runs of
text with their path. Tokens of a host that occur equally often on every page share an occurrence vector and make an
equivalence class. A class is valid if its tokens keep one order on the pages and its spans do not cut those of another
class; valid classes nest into the host's template. Runs of text that belong to it are template text. What is left fills
slots, each owned by the innermost template tag around it; the slot that owns most of the host's text is the article's.
Where markup says ``article`` or ``main``, that names the slot. Elements that markup calls menus, headers, footers,
sidebars, notices, adverts, forms or comments never count.

Vectors are not kept: a token carries two sums of hashes over its pages, so vectors are equal where sums are, and all is
counted by keyed sums, a hot host's pages in as many tasks as they lie in. What a host's pages are given back (its
template) is bounded: tokens on three fifths of the pages, so at most 5/3 of the tokens of a mean page.

Hosts of fewer than five pages, and pages without a host, have no template: the article is then the innermost box
with three fifths of the page's text. Template text that makes up more than half of a page's article is taken for copies
of one article and stays. Null html is empty; pages without text give an empty string. Repeated rows count as pages
each. An empty table gives no rows. Whole pages are read. Columns other than page_id, url and html are left out.
"""

from __future__ import annotations

from bisect import bisect
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import in_arrow, keep, mix, slices
from tidemark.llm.page_tree import Block, Page

LEAST_PAGES = 5
#: share of a host's pages that hold a template token, and of its text that a slot owns
SUPPORT = 0.6
#: share of pages on which a class may break the order or nesting
BROKEN = 0.05
#: templates of all hosts together that may go to every task
MOST_BROADCAST = 32 << 20
#: pages of a host joined with its template in one task, where templates are not sent to every task
PAGES_TOGETHER = 1_000_000


def host_of(url: Column) -> Column:
    """The host in lower case; null without one."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1))
    return F.when(host != "", host)


def occurrences(pages: DataFrame) -> DataFrame:
    """Per batch, host and token: pages, two sums that stand for the vector, and the sum of first places."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "html"):
            found: dict = defaultdict(lambda: [0, 0, 0, 0])
            for host, key, html in zip(rows["host"].to_pylist(), rows["key"].to_pylist(), rows["html"]):
                seen: dict = {}
                tokens = Page(html.as_py() or "").tokens
                for at, token in enumerate(tokens):
                    entry = seen.get(token)
                    if entry is None:
                        seen[token] = [1, at]
                    else:
                        entry[0] += 1
                counts = np.array([e[0] for e in seen.values()], np.uint64)
                hashes = mix(mix(counts) ^ np.uint64(key & (2**64 - 1)))
                for (token, (_, at)), one, two in zip(seen.items(), (hashes >> np.uint64(33)).tolist(), (hashes & np.uint64(2**31 - 1)).tolist()):
                    entry = found[host, token]
                    entry[0] += 1
                    entry[1] += one
                    entry[2] += two
                    entry[3] += at
            columns = {"host": pa.array([h for h, _ in found], pa.string())}
            columns |= {"token": pa.array([t for _, (t, _) in found], pa.int64()), "text": pa.array([x for _, (_, x) in found], pa.bool_())}
            for k, name in enumerate(("pages", "one", "two", "at")):
                columns[name] = pa.array([e[k] for e in found.values()], pa.int64())
            yield pa.record_batch(columns)

    key = F.xxhash64("page_id", "url", "html").alias("key")
    kinds = "host string, token long, text boolean, pages long, one long, two long, at long"
    return in_arrow(pages.where("host is not null").select("host", key, "html"), count, kinds)


def classes(pages: DataFrame) -> DataFrame:
    """Per host of enough pages: host, pages, and the tokens of classes of two or more with their class and first place."""
    hosts = pages.where("host is not null").groupBy("host").agg(F.count(F.lit(1)).alias("of_host")).where(F.col("of_host") >= LEAST_PAGES)
    sums = [F.sum(c).alias(c) for c in ("pages", "one", "two", "at")]
    tokens = occurrences(pages).groupBy("host", "token", "text").agg(*sums)
    # most tokens occur on one page: they go before hosts are joined
    frequent = tokens.where(F.col("pages") >= LEAST_PAGES * SUPPORT).join(hosts, "host").where(F.col("pages") >= F.col("of_host") * SUPPORT)
    named = frequent.withColumn("class", F.xxhash64("one", "two", "pages"))
    named = named.withColumn("members", F.count(F.lit(1)).over(Window.partitionBy("host", "class"))).where("members > 1")
    # all tokens of a host here are at most 5/3 of those of a mean page
    token = F.struct("token", "class", "at", "text")
    return named.groupBy("host", F.col("of_host").alias("pages")).agg(F.collect_list(token).alias("tokens"))


def given(pages: DataFrame, plans: DataFrame, most_broadcast: int = MOST_BROADCAST, together: int = PAGES_TOGETHER) -> DataFrame:
    """Pages with the plan of their host, or nulls. Plans go to every task only if their measured size allows it."""
    size = plans.agg(F.sum(F.length(F.to_json(F.struct("*"))))).first()[0] or 0
    if size <= most_broadcast:
        return pages.join(F.broadcast(plans), "host", "left")
    # few hosts are this large; their pages are dealt to several copies of the plan
    parts = F.ceil(F.col("pages") / together).cast("int")
    hot = plans.where(F.col("pages") > together).select("host", parts.alias("parts"))
    salted = pages.join(F.broadcast(hot), "host", "left").withColumn("salt", F.coalesce(F.pmod(F.xxhash64("url", "html"), F.col("parts")).cast("int"), F.lit(0)))
    copies = plans.withColumn("salt", F.explode(F.sequence(F.lit(0), parts - 1)))
    return salted.drop("parts").join(copies, ["host", "salt"], "left").drop("salt")


def spans_of(places: list[int], order: list[int]) -> list[tuple[int, int]] | None:
    """First and last place of each repeat of a class on a page, or None where its tokens leave their order.

    ``places``: places of the class's tokens on the page; ``order``: at each of them, the token's number in the class.
    """
    size = max(order) + 1
    if len(order) % size or any(k % size != number for k, number in enumerate(order)):
        return None
    return [(places[k], places[k + size - 1]) for k in range(0, len(places), size)]


def _inside(spans: list[tuple[int, int]], marks: list[int]) -> bool:
    """Whether each span lies between two neighbouring marks, or before or behind all of them."""
    return all(bisect(marks, a) == bisect(marks, b) for a, b in spans)


def broken_classes(tokens: list[tuple[int, bool]], member: dict) -> set[int]:
    """Classes that leave their order on a page, or whose spans cut those of a class with no more repeats.

    ``member``: class and number in it of each template token.
    """
    places: dict = defaultdict(list)
    order: dict = defaultdict(list)
    for at, token in enumerate(tokens):
        entry = member.get(token)
        if entry:
            places[entry[0]].append(at)
            order[entry[0]].append(entry[1])
    broken, spans = set(), {}
    for name in places:
        found = spans_of(places[name], order[name])
        if found is None:
            broken.add(name)
        else:
            spans[name] = found
    names = sorted(spans, key=lambda n: (len(spans[n]), -len(places[n]), n))
    for k, outer in enumerate(names):
        for inner in names[k + 1 :]:
            if not (_inside(spans[inner], places[outer]) or _inside(spans[outer], places[inner])):
                broken.add(inner)
    return broken


def judged(pages: DataFrame) -> DataFrame:
    """Per host and class the pages it is broken on; per host and role of a tag the text inside it, and its depth."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "html"):
            found: dict = defaultdict(int)
            members: dict = {}
            for host, tokens, html in zip(rows["host"].to_pylist(), rows["tokens"], rows["html"]):
                if host not in members:
                    members[host] = numbered(tokens.as_py())
                member = members[host]
                page = Page(html.as_py() or "")
                for name in broken_classes(page.tokens, member):
                    found[host, "broken", name, 0] += 1
                for block in page.blocks:
                    if not block.skip and (block.token, True) not in member:
                        shown = len(block.text) - block.links
                        for depth, (role, _) in enumerate(block.around):
                            if (role, False) in member:
                                found[host, "text", role, depth] += max(shown, 0)
            columns = [list(c) for c in zip(*found)] or [[], [], [], []]
            kinds = [pa.string(), pa.string(), pa.int64(), pa.int32()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)] + [pa.array(list(found.values()), pa.int64())]
            yield pa.record_batch(arrays, names=["host", "kind", "name", "depth", "value"])

    rows = in_arrow(pages.where("tokens is not null").select("host", "tokens", "html"), judge, "host string, kind string, name long, depth int, value long")
    return rows.groupBy("host", "kind", "name", "depth").agg(F.sum("value").alias("value"))


def numbered(tokens: list[dict] | None) -> dict:
    """Class of each template token and its number there, by first places."""
    by_class: dict = defaultdict(list)
    for t in tokens or ():
        by_class[t["class"]].append((t["at"], t["token"], t["text"]))
    return {(token, text): (name, k) for name, members in by_class.items() for k, (_, token, text) in enumerate(sorted(members))}


def templates(pages: DataFrame, most_broadcast: int = MOST_BROADCAST, together: int = PAGES_TOGETHER) -> DataFrame:
    """Per host of enough pages: host, pages, ``texts`` (its template text) and ``slot`` (the role that owns the article)."""
    found = keep(classes(pages), "classes")
    facts = keep(judged(given(pages, found, most_broadcast, together)), "slots")
    broken = facts.where("kind = 'broken'").groupBy("host").agg(F.collect_list(F.struct(F.col("name").alias("class"), "value")).alias("broken"))
    valid = found.join(broken, "host", "left").withColumn(
        "tokens",
        F.filter(
            "tokens",
            lambda t: ~F.exists(
                F.coalesce("broken", F.array().cast("array<struct<class: bigint, value: bigint>>")),
                lambda b: (b["class"] == t["class"]) & (b["value"] > F.col("pages") * BROKEN),
            ),
        ),
    )
    tags = valid.select("host", F.explode(F.filter("tokens", lambda t: ~t["text"])).alias("t")).select("host", F.col("t.token").alias("name"))
    owned = facts.where("kind = 'text'").join(tags, ["host", "name"])
    largest = owned.groupBy("host").agg(F.max("value").alias("all"))
    deep = owned.join(largest, "host").where(F.col("value") >= F.col("all") * SUPPORT)
    slots = deep.groupBy("host").agg(F.max_by("name", F.struct("depth", "value", "name")).alias("slot"))
    texts = F.transform(F.filter("tokens", lambda t: t["text"]), lambda t: t["token"])
    return keep(valid.select("host", "pages", texts.alias("texts")).join(slots, "host", "left"), "templates")


def article(blocks: list[Block], texts: frozenset[int], slot: int | None) -> list[str]:
    """The blocks of the article."""
    shown = [b for b in blocks if not b.skip]
    region = _named(shown, "article") or _named(shown, "main")
    if not region and slot is not None:
        region = [b for b in shown if any(role == slot for role, _ in b.around)]
    if not region:
        region = _innermost(shown)
    total = sum(len(b.text) for b in region)
    boiler = sum(len(b.text) for b in region if b.token in texts)
    if 2 * boiler <= total:
        region = [b for b in region if b.token not in texts]
    menus = _menus(region)
    return [b.text for b in region if b.list_number < 0 or b.list_number not in menus]


def _named(blocks: list[Block], tag: str) -> list[Block]:
    """Blocks in elements of this tag; if one of several holds most of the text, its blocks alone."""
    sizes: dict = defaultdict(int)
    for b in blocks:
        if b.region[0] == tag:
            sizes[b.region[1]] += len(b.text)
    largest = max(sizes, key=lambda n: (sizes[n], -n), default=None)
    alone = len(sizes) > 1 and 2 * sizes[largest] > sum(sizes.values())
    return [b for b in blocks if b.region[0] == tag and (not alone or b.region[1] == largest)]


def _innermost(blocks: list[Block]) -> list[Block]:
    """Blocks of the innermost box that holds three fifths of the text outside links."""
    sizes: dict = defaultdict(int)
    total = 0
    for b in blocks:
        own = max(len(b.text) - b.links, 0)
        total += own
        for depth, (_, number) in enumerate(b.around):
            sizes[depth, number] += own
    chosen = [(depth, number) for (depth, number), size in sizes.items() if size >= SUPPORT * total and total]
    if not chosen:
        return blocks
    number = max(chosen)[1]
    return [b for b in blocks if any(n == number for _, n in b.around)]


def _menus(blocks: list[Block]) -> set[int]:
    """Lists of two or more items that are links for four fifths."""
    items: dict = defaultdict(lambda: [0, 0, 0])
    for b in blocks:
        if b.list_number >= 0:
            entry = items[b.list_number]
            entry[0] += 1
            entry[1] += b.links
            entry[2] += len(b.text)
    return {number for number, (n, links, size) in items.items() if n > 1 and 5 * links >= 4 * size}


def main_texts(pages: DataFrame, most_broadcast: int = MOST_BROADCAST, together: int = PAGES_TOGETHER) -> DataFrame:
    """Per page: page_id, url, text (blocks parted by an empty line) and n_chars."""
    rows = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), "html")
    planned = given(rows, templates(rows, most_broadcast, together), most_broadcast, together)
    key = pages.schema["page_id"].dataType.simpleString()

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            found, known = [], {}
            for host, texts, slot, html in zip(batch["host"].to_pylist(), batch["texts"], batch["slot"].to_pylist(), batch["html"]):
                if host not in known:
                    known[host] = frozenset(texts.as_py() or ())
                found.append("\n\n".join(article(Page(html.as_py() or "").blocks, known[host], slot)))
            columns = {"page_id": batch["page_id"], "url": batch["url"], "text": pa.array(found, pa.string())}
            yield pa.record_batch(columns | {"n_chars": pa.array([len(t) for t in found], pa.int64())})

    return in_arrow(planned.select("page_id", "url", "host", "texts", "slot", "html"), extract, f"page_id {key}, url string, text string, n_chars long")
