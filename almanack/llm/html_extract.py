"""Main text of web pages: markup where it speaks, page differencing where it is silent.

A page is cut into text lines, one per block.  Lines inside ``article`` or ``main`` are
its text, lines in menus, footers, adverts and the like are not; both are certain.  In a
page without the former, lines in elements whose class names say content come first, or
else all that are left, and these are decided by the page with the nearest URL: pages are sorted by host and
path, each is paired with the neighbour of the same host that shares the longest path
prefix, their lines are aligned by a longest common subsequence, and shared lines are
deleted.  A neighbour that shares more than half of the undecided text is a copy and
says nothing about what is boilerplate; then all undecided lines stay.

Neighbours come from a range sort of slim rows (host, path, row hash); the first and
last rows of the ranges are matched in one more step, so no host needs to fit in a task.
Only line hashes of the neighbour travel to a page.

Defined results: null or empty html gives an empty text; a null or odd URL has its whole
self as path and no host in common with others but such; equal rows are one for the
pairing and get equal texts; other columns pass through, result names are replaced.
"""

import html
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanack.llm.base import free_name, register, staged, table

# Elements and attribute words by their use on web pages.
BLOCKS = set(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
OUTSIDE = set("aside dialog footer form head menu nav".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BOILERPLATE = set(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies copyright disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices "
    "notification pager pagination popup promo promoted promotion recommended related reply replies respond share sharing "
    "sidebar signup skip social sponsor sponsored subscribe toolbar widget".split()
)
CONTENT = set(
    "article article-body article-content article-text content entry entry-content main main-content page-content post "
    "post-body post-content post-text story story-body story-content".split()
)
NEGATED = set("has no with without".split())
ROLES = set("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())

# elements without text: of the raw ones only their own end tag, or the page's end, is the
# end; the others end with their parent at the latest
SKIPPED = set("noscript template svg select button object math canvas audio video".split())
UNNESTED = {"select", "button"}
_RAW = "script|style|textarea|iframe"
_REST = r"(?:\"[^\"]*\"|'[^']*'|[^'\">])*+"
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<({_RAW})(?=[\s/>])(?:(?:/|{_REST}(?<=[\s\"']/))>|.*?(?:</\1(?=[\s/>])[^>]*>|\Z))"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>"
    r"|<[!?/][^>]*>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
SURE, LIKELY, UNDECIDED, OUT = "sure", "likely", "undecided", "out"


def _kind(tag, attributes, in_main):
    """(whether the element is left out, its claim to be the text: 2 by tag, 1 by name)."""
    own = tag in ("article", "main")
    if tag in OUTSIDE or (tag == "header" and not in_main):
        return True, 0
    if not attributes.strip() or tag in ("html", "body"):
        return False, 2 * own
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)}
    if "hidden" in found or found.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", found.get("style", "")):
        return True, 0
    roles = set(found.get("role", "").lower().split())
    if ROLES & roles:
        return True, 0
    names = (found.get("class", "") + " " + found.get("id", "")).lower().split()
    for name in names:
        words = set(re.split("[_-]+", name))
        if words & {"comment", "comments"} or not own and words & BOILERPLATE and not words & NEGATED:
            return True, 0
        if "header" in words and not in_main and not own:
            return True, 0
    named = found.get("itemprop") == "articleBody" or bool(CONTENT & {n.replace("_", "-") for n in names})
    return False, 2 if own or "main" in roles else int(named)


def lines_of(page):
    """``[(text, zone)]`` in page order, a line per block."""
    if not page:
        return []
    out, part, stack, at = [], [], [], 0
    # the element being skipped, tags open inside it, inline tags open outside it
    skipped, inner, inline = None, Counter(), Counter()

    def close():
        text = " ".join(html.unescape("".join(part)).split())
        part.clear()
        if text:
            claim = max((s[2] for s in stack), default=0)
            out.append((text, OUT if any(s[1] for s in stack) else (UNDECIDED, LIKELY, SURE)[claim]))

    for m in TOKEN.finditer(page):
        if not skipped:
            part.append(page[at : m.start()])
        at = m.end()
        tag = (m[3] or m[6] or "").lower()
        if not tag:
            continue
        ends, empty = m[2] or m[5], tag in VOID or (m[4] or m[7] or "").endswith("/")
        if skipped:
            if not ends:
                inner[tag] += not empty and not (tag == skipped and tag in UNNESTED)
                continue
            if inner[tag]:
                inner[tag] -= 1
                continue
            if tag == skipped:
                skipped = None
                continue
            if not inline[tag] and all(s[0] != tag for s in stack):
                continue
            skipped = None
        elif tag in SKIPPED:
            if not ends and not empty:
                skipped, inner = tag, Counter()
            continue
        if tag not in BLOCKS and tag not in OUTSIDE and not empty:
            inline[tag] = max(0, inline[tag] - 1) if ends else inline[tag] + 1
        if tag == "br":
            part.append(" ")
            continue
        block = tag in BLOCKS or tag in OUTSIDE
        attributes = m[4] or m[7] or ""
        if ends:
            if block:
                close()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    if not block and stack[k][1]:
                        close()
                    del stack[k:]
                    break
            continue
        in_main = any(s[2] == 2 for s in stack)
        if block:
            close()
            # a paragraph ends where the next block begins; a body ends the head
            if stack and stack[-1][0] == "p":
                stack.pop()
            if tag == "body":
                stack.clear()
        if empty:
            continue
        out_here, claim = _kind(tag, attributes, in_main)
        if block and tag not in ("html", "body"):
            stack.append((tag, out_here, claim))
        elif out_here:
            close()
            stack.append((tag, True, 0))
    if not skipped:
        part.append(page[at:])
    close()
    return out


def common_lines(a, b):
    """Places in ``a`` of a longest common subsequence with ``b``, by threshold lists."""
    where = {}
    for j, v in enumerate(b):
        where.setdefault(v, []).append(j)
    ends, chain, best = [], [], []
    import bisect

    for i, v in enumerate(a):
        for j in reversed(where.get(v, ())):
            k = bisect.bisect_left(ends, j)
            node = (i, best[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                best.append(node)
            else:
                ends[k], best[k] = j, node
    node = best[-1] if best else None
    while node:
        chain.append(node[0])
        node = node[1]
    return set(chain)


def _hash(text):
    import xxhash

    return xxhash.xxh64_intdigest(text) - (1 << 63)


def main_text(page, neighbour):
    """The text of a page, given the line hashes of its neighbour (or None)."""
    lines = lines_of(page)
    sure = [t for t, z in lines if z == SURE]
    if sure:
        return "\n".join(sure)
    shared = common_lines([_hash(t) for t, _ in lines], neighbour) if neighbour is not None and len(neighbour) else set()
    best = LIKELY if any(z == LIKELY for _, z in lines) else UNDECIDED
    open_lines = [(t, k in shared) for k, (t, z) in enumerate(lines) if z == best]
    if 2 * sum(len(t) for t, s in open_lines if s) > sum(len(t) for t, _ in open_lines):
        return "\n".join(t for t, _ in open_lines)
    return "\n".join(t for t, s in open_lines if not s)


def _line_hashes(batches):
    for batch in batches:
        rows = [[_hash(t) for t, _ in lines_of(p)] for p in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.int64()))], names=["row", "lines"])


def _prefix(a, b):
    """Length of the common prefix: the place of the first characters that differ, in time
    linear in the lengths, as a URL can be a whole ``data:`` file."""
    same = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x.eqNullSafe(y))
    ends = F.array_position(same, F.lit(False)) - 1
    return F.least(F.when(ends >= 0, ends), F.length(a), F.length(b)).cast("int")


def nearest(rows):
    """``host, path, row`` (distinct) -> ``row, other``: the neighbour in the order of host
    and path with the same host and the longest common path prefix; none for lone hosts."""
    keys = ["host", "path", "row"]
    parts = staged(
        rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("part", F.spark_partition_id()), "urls"
    )
    me = F.struct(*keys)
    order = W.partitionBy("part").orderBy(*keys)
    near = parts.select(*keys, "part", F.lag(me).over(order).alias("before"), F.lead(me).over(order).alias("after"))
    # the rows at the ends of a range find theirs in the next range that has rows
    ends = parts.groupBy("part").agg(F.min(me).alias("first"), F.max(me).alias("last"))
    whole = W.orderBy("part")
    ends = ends.select(
        F.col("part"), F.lag("last").over(whole).alias("before_part"), F.lead("first").over(whole).alias("after_part")
    )
    near = near.join(F.broadcast(ends), "part")
    near = near.withColumn("before", F.coalesce("before", "before_part")).withColumn("after", F.coalesce("after", "after_part"))
    length = lambda side: F.when(F.col(f"{side}.host") == F.col("host"), _prefix(F.col(f"{side}.path"), F.col("path"))).otherwise(-1)
    near = near.withColumn("p", length("before")).withColumn("n", length("after"))
    other = F.when(F.greatest("p", "n") >= 0, F.when(F.col("p") >= F.col("n"), F.col("before.row")).otherwise(F.col("after.row")))
    return near.select("row", other.alias("other")).where("other IS NOT NULL")


def extract(pages, url="url", page="html"):
    """``pages`` with ``text`` and ``n_chars``."""
    pages = pages.drop(*[c for c in pages.columns if c.lower() in ("text", "n_chars") and c not in (url, page)])
    link = F.coalesce(F.col(url), F.lit(""))
    host = F.lower(F.regexp_extract(link, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    path = F.regexp_replace(link, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*|#.*$", "")
    own, shared = free_name(pages, "_row"), free_name(pages, "_lines")
    rows = pages.withColumn(own, F.xxhash64(url, page))
    slim = rows.select(host.alias("host"), path.alias("path"), F.col(own).alias("row")).distinct()
    pairs = nearest(slim)
    lines = rows.select(F.col(own).alias("row"), F.col(page).alias("html")).mapInArrow(_line_hashes, "row long, lines array<long>")
    lines = lines.dropDuplicates(["row"])
    near = pairs.join(lines.withColumnRenamed("row", "other"), "other").select(F.col("row").alias(own), F.col("lines").alias(shared))
    joined = rows.join(near, own, "left").drop(own)
    schema = T.StructType([*pages.schema.fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    names = pages.columns

    def run(batches):
        for batch in batches:
            source = batch.column(batch.schema.get_field_index(page)).to_pylist()
            lines = batch.column(batch.schema.get_field_index(shared))
            texts = [main_text(p, lines[k].as_py()) for k, p in enumerate(source)]
            columns = [batch.column(batch.schema.get_field_index(c)) for c in names]
            size = np.fromiter(map(len, texts), np.int64, len(texts))
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string()), pa.array(size)], names=[*names, "text", "n_chars"])

    return joined.mapInArrow(run, schema)


@register("op2_html_text")
def op2_html_text(spark, folder):
    return extract(table(spark, folder, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")
