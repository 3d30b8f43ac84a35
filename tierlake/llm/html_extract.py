"""Main text of web pages by template deduction over equivalence classes of tokens.

The tokens of a page are its block elements by path and its blocks of text. A
token's occurrence vector over the pages of a host says how often each page has
it; tokens of equal vectors form a class. A class that is large enough and spans
at least three and half of a host's pages is valid: its tokens were written by the
template. Pages of one host whose blocks are the same count once, whatever their
urls, scripts or comments: copies say nothing about what a template writes.

The elements of valid classes nest by their paths into the template of the host; what
no valid class wrote is in the slot of the innermost of them around it. The main slot
is found from the outside in: where one nested element holds more than half of the
text in the slots of the one around it, it takes its place, down to an <article> or
<main>, which is never divided. So the template says where on its pages the main text
stands, and text that it writes itself goes.

Tags and names are hints: text in menus, headers, footers, sidebars, notices, adverts,
forms and comments counts for no slot and is left out. Inside the main slot the text in
<article> or <main>, if there is any, is the main text, and is kept even if other pages
repeat it. Outside it a first heading that the template did not write is kept, unless
the slot is an article. Pages of hosts without a template, and pages on which the main
slot does not exist, go by the hints alone.

A page is named by a hash of its blocks in their order, and vectors by an
exclusive or of hashes of (page, count) over distinct pages. Rows are dealt by host
and token, so no host is ever gathered.

* Null or empty html gives an empty text. Pages without a host have no template.
* Hosts of one or two distinct pages have no template either.
* Repeated rows are rows of their own; for the template they count once. An empty table gives an empty table; other
  columns are not read.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.llm.common import located, ship, spelled, stored
from tierlake.llm.markup import MAIN, Block, blocks

#: Least tokens of a class, least distinct pages it spans, and least share of the host's distinct pages.
CLASS_TOKENS, CLASS_PAGES, CLASS_SHARE = 2, 3, 0.5
#: Share of the text in an element's slots above which a nested element takes its place.
SLOT_SHARE = 0.5
TAG = re.compile(r"/([^/\[\]]+)(?:\[[^\]]*\])?$")


#: Stands for a whole page among the tokens.
WHOLE = 0


def host_of(url: Column) -> Column:
    """What follows the first :// up to / ? # or the end, A-Z in lower case; empty without."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def token(block: Block) -> int:
    """A number for a block element by its path, or for a text by path and content."""
    return xxhash.xxh3_64_intdigest(f"{block.element.path}\n{block.text}".encode("utf-8", "surrogatepass")) - (1 << 63)


def inside(path: str, region: str) -> bool:
    """Whether an element of this path is one of the region, or nested in one."""
    return not region or path == region or path.startswith(f"{region}/")


def undivided(path: str) -> bool:
    tag = TAG.search(path)
    return bool(tag) and tag[1] in MAIN


def tokens_on(html: str) -> tuple[int, list[tuple[int, int, int, str, bool]]]:
    """The number of the page's content, and token, count, characters, path and whether it is text, of its tokens.

    The characters are those of text that no hint sets beside, in elements all that is nested in them.
    """
    order, beside, paths, texts = array("q"), bytearray(), {}, set()
    counts, held = Counter(), Counter()
    for block in blocks(html):
        element = block.element
        if element.hidden:
            continue
        key = token(block)
        order.append(key)
        beside.append(element.beside)
        counts[key] += 1
        paths[key] = element.path
        if block.text:
            texts.add(key)
            if not element.beside:
                for path in ("", *element.within):
                    held[path] += len(block.text)
                held[key] += len(block.text)
    page = xxhash.xxh3_64_intdigest(order.tobytes() + bytes(beside)) - (1 << 63)
    rows = [(key, n, held[key if key in texts else paths[key]], paths[key], key in texts) for key, n in counts.items()]
    return page, [*rows, (WHOLE, 1, held[""], "", False)]


def main_slot(whole: int, members: list[tuple[str, bool, int]]) -> str:
    """The path of the main slot, from all characters and path, text or element, and characters of the template's tokens."""
    slots = {"": whole} | {path: chars for path, text, chars in members if not text}
    for path, text, chars in members:
        if text and chars:
            for around in slots:
                if inside(path, around):
                    slots[around] -= chars
    region = ""
    while not undivided(region):
        nested = [
            path for path, chars in slots.items()
            if path != region and inside(path, region) and chars > SLOT_SHARE * slots[region]
        ]
        if not nested:
            break
        region = min(nested, key=lambda path: (len(path), path))
    return region


def templates(pages: DataFrame) -> DataFrame:
    """host, region (path of its main slot) and template (texts that it writes), from pages (host, html)."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for host, html in zip(batch["host"], batch["html"], strict=True):
                page, rows = tokens_on(html)
                out += [(host, page, *row) for row in rows]
            yield pd.DataFrame(out, columns=["host", "page", "token", "n", "chars", "path", "written"])

    schema = "host string, page bigint, token bigint, n bigint, chars bigint, path string, written boolean"
    tokens = pages.where("host <> ''").mapInPandas(read, schema)
    # Copies count once; one shuffle by host and token serves both steps.
    once = tokens.repartition("host", "token").distinct()
    vectors = once.groupBy("host", "token", "path", "written").agg(
        F.bit_xor(F.xxhash64("page", "n")).alias("vector"), F.count("*").alias("pages"), F.sum("chars").alias("chars")
    )
    vectors = stored(vectors.where(F.col("pages") >= CLASS_PAGES), "html-vectors")
    sizes = vectors.where(F.col("token") == WHOLE).select(
        "host", F.col("pages").alias("all_pages"), F.col("chars").alias("whole")
    )
    spanning = vectors.where(F.col("token") != WHOLE).join(sizes, "host").where(
        F.col("pages") >= CLASS_SHARE * F.col("all_pages")
    )
    # A host has at most tokens per page / CLASS_SHARE such tokens, however many pages it has.
    member = F.struct("token", "path", "written", "chars")
    classes = spanning.groupBy("host", "whole", "vector").agg(F.collect_list(member).alias("members"))
    valid = classes.where(F.size("members") >= CLASS_TOKENS)
    made = valid.groupBy("host", "whole").agg(F.flatten(F.collect_list("members")).alias("members"))

    def nest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            regions = [
                main_slot(whole, [(m["path"], m["written"], m["chars"]) for m in members])
                for whole, members in zip(batch["whole"], batch["members"], strict=True)
            ]
            texts = [[m["token"] for m in members if m["written"]] for members in batch["members"]]
            yield pd.DataFrame({"host": batch["host"], "region": regions, "template": texts})

    # Stored, so that the join with the pages has shuffles of its own and a hot host's pages can be split.
    return stored(made.mapInPandas(nest, "host string, region string, template array<bigint>"), "html-templates")


def main_text(html: str, template: frozenset[int], region: str = "") -> str:
    """The blocks in the main slot, one per line."""
    shown = [block for block in blocks(html) if not block.element.hidden]
    found = [block for block in shown if block.text and not block.element.beside]
    if region and any(inside(block.element.path, region) for block in shown):
        found = [
            block for block in found if inside(block.element.path, region)
            or not undivided(region) and block.element.path.endswith("/h1") and token(block) not in template
        ]
    article = [block for block in found if block.element.main]
    if article:
        # Articles in comments or sidebars count only if there is none outside them.
        chosen = [block for block in article if not block.element.lifted] or article
        return "\n".join(block.text for block in chosen)
    return "\n".join(block.text for block in found if token(block) not in template)


def extract(pages: DataFrame, identifier: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    ship(pages.sparkSession)
    rows = located(pages)
    read = rows.frame.select(
        spelled(identifier).alias("page_id"), F.col(url).alias("url"), host_of(F.col(url)).alias("host"),
        F.coalesce(html, F.lit("")).alias("html"),
    )
    found = templates(read.select("host", "html"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            # One set per host and batch.
            hosts = batch.drop_duplicates("host")
            known = {
                host: (frozenset(template), region)
                for host, template, region in zip(hosts["host"], hosts["template"], hosts["region"], strict=True)
                if region is not None
            }
            texts = [
                main_text(content, *known.get(host, (frozenset(), "")))
                for host, content in zip(batch["host"], batch["html"], strict=True)
            ]
            yield pd.DataFrame({
                "page_id": batch["page_id"], "url": batch["url"], "text": texts, "n_chars": [len(text) for text in texts],
            })

    kind = rows.frame.schema[identifier].dataType.simpleString()
    joined = read.join(found, "host", "left").select("page_id", "url", "host", "html", "template", "region")
    extracted = joined.mapInPandas(write, "page_id string, url string, text string, n_chars bigint")
    return extracted.withColumn("page_id", F.col("page_id").cast(kind))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
