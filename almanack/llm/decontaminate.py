"""Benchmark decontamination by Wu-Manber search over words.

Windows of ``width`` consecutive words of the benchmark items are the patterns.  A
table addressed by a hash of a block of two words says how far a scan may jump from
a position without passing an occurrence; where it says nought, a bucket addressed
by the last and the first block of the window gives the patterns to compare word by
word.  All rows of a chunk are scanned in step: one array holds a position per row.

Documents are only mapped, never shuffled.  The benchmark is collected in blocks of
about ``block_words`` words, so that what a task holds has a bound whatever the size
of the benchmark; each block is one more pass over the same rows.

Defined results: a null or empty text has no words and no hits; an item without
text or without id has no windows; items with equal ids count as one; documents are
rows, so equal ids or texts are answered row by row; other columns pass through,
and those named like a result are replaced.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanack.llm.base import packed, register, staged, table
from almanack.llm.textbytes import ALNUM, U, chunks, mixed, words

WIDTH = 10
BLOCK_WORDS = 2_000_000
SPANS, ITEMS, COUNT = "hit_spans", "hit_items", "n_words"
#: a word before lower-casing
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _pair(a, b):
    return mixed(a * U(0x9E3779B97F4A7C15) + (b ^ (b >> U(29))))


def _block_hashes(h, size):
    """The hash of the block that ends at each word."""
    if size == 1:
        return mixed(h)
    out = np.zeros(len(h), U)
    out[1:] = _pair(h[:-1], h[1:])
    return out


class Patterns:
    """Shift table, buckets and patterns of one length."""

    def __init__(self, windows, owners):
        order = np.lexsort(windows.T[::-1])
        windows, owners = windows[order], owners[order]
        new = np.ones(len(windows), bool)
        new[1:] = (windows[1:] != windows[:-1]).any(axis=1)
        self.length = windows.shape[1]
        self.size = min(2, self.length)
        pattern = np.cumsum(new) - 1
        rows = windows[new]
        # patterns in order of their bucket, their owners beside them
        flat = _block_hashes(rows.ravel(), self.size).reshape(rows.shape)
        key = _pair(flat[:, -1], flat[:, self.size - 1])
        by_key = np.argsort(key, kind="stable")
        place = np.empty(len(rows), np.int64)
        place[by_key] = np.arange(len(rows))
        self.rows, self.keys = rows[by_key], key[by_key]
        pairs = np.unique(np.stack([place[pattern], owners], axis=1), axis=0)
        self.owners = pairs[:, 1]
        self.owner_at = np.searchsorted(pairs[:, 0], np.arange(len(rows) + 1))
        bits = max(12, int(np.ceil(np.log2(rows.size + 1))) + 4)
        self.mask = U((1 << bits) - 1)
        self.shift = np.full(1 << bits, self.length - self.size + 1, np.int32)
        for end in range(self.size - 1, self.length):
            np.minimum.at(self.shift, (flat[:, end] & self.mask).astype(np.int64), self.length - 1 - end)

    def find(self, h, at):
        """(end word, pattern) of every occurrence in the rows bounded by ``at``."""
        block = _block_hashes(h, self.size)
        jump = self.shift[(block & self.mask).astype(np.int64)]
        here, stop = at[:-1] + self.length - 1, at[1:]
        alive = here < stop
        here, stop = here[alive], stop[alive]
        found = []
        while len(here):
            step = jump[here]
            zero = step == 0
            if zero.any():
                found.append(here[zero])
            here = here + np.maximum(step, 1)
            alive = here < stop
            here, stop = here[alive], stop[alive]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        end = np.concatenate(found)
        key = _pair(block[end], block[end - self.length + self.size])
        low, high = np.searchsorted(self.keys, key), np.searchsorted(self.keys, key, side="right")
        many = high - low
        end, low = np.repeat(end, many), np.repeat(low, many)
        nth = np.arange(len(end)) - np.repeat(np.cumsum(many) - many, many)
        pattern = low + nth
        same = np.ones(len(end), bool)
        for back in range(self.length):
            same &= h[end - back] == self.rows[pattern, self.length - 1 - back]
        return end[same], pattern[same]


def build(items, width=WIDTH):
    """(item names in order, patterns by length) of ``[(id, text)]``."""
    items = [(str(i), t) for i, t in items if i is not None and t is not None]
    names = sorted({i for i, _ in items})
    index = {n: k for k, n in enumerate(names)}
    parts = {}
    texts = pa.array([t for _, t in items], pa.large_string())
    for first, last, x, at in chunks(texts):
        h, of_row = words(x, at, ALNUM)
        for row in range(first, last):
            own = h[of_row[row - first] : of_row[row - first + 1]]
            if len(own):
                view = np.lib.stride_tricks.sliding_window_view(own, min(width, len(own)))
                windows, owners = parts.setdefault(view.shape[1], ([], []))
                windows.append(view)
                owners.append(np.full(len(view), index[items[row][0]]))
    return names, [Patterns(np.concatenate(w), np.concatenate(o)) for w, o in parts.values()]


def _merged(spans):
    """Sorted, disjoint [first, last) spans."""
    out = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _scan(sets, names, texts):
    """Per row: word count, merged spans of hit words, names of the items."""
    for first, last, x, at in chunks(texts):
        h, of_row = words(x, at, ALNUM)
        rows = last - first
        edge = np.zeros(len(h) + 1, np.int32)
        owners = [np.zeros((0, 2), np.int64)]
        for p in sets:
            end, pattern = p.find(h, of_row)
            np.add.at(edge, end - p.length + 1, 1)
            np.add.at(edge, end + 1, -1)
            many = p.owner_at[pattern + 1] - p.owner_at[pattern]
            row = np.repeat(np.searchsorted(of_row, end, side="right") - 1, many)
            nth = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
            item = p.owners[np.repeat(p.owner_at[pattern], many) + nth]
            owners.append(np.unique(np.stack([row, item], axis=1), axis=0))
        hit = np.cumsum(edge[:-1]) > 0
        turn = np.diff(np.concatenate(([False], hit, [False])).astype(np.int8))
        starts, ends = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
        # a run of hit words that crosses rows is cut at their bounds
        inner = of_row[1:-1]
        inner = np.unique(inner[(inner > 0) & (inner < len(h))])
        inner = inner[hit[inner] & hit[inner - 1]] if len(inner) else inner
        starts, ends = np.union1d(starts, inner), np.union1d(ends, inner)
        row = np.searchsorted(of_row, starts, side="right") - 1
        spans = [[] for _ in range(rows)]
        for r, a, b in zip(row.tolist(), starts.tolist(), ends.tolist()):
            spans[r].append([a - int(of_row[r]), b - int(of_row[r])])
        items = [[] for _ in range(rows)]
        for r, i in np.unique(np.concatenate(owners), axis=0).tolist():
            items[r].append(names[i])
        yield np.diff(of_row).tolist(), spans, items


def find_occurrences(docs, benchmark, width=WIDTH, block_words=BLOCK_WORDS, text="text", item="item_id", item_text="text"):
    """``docs`` with ``n_words``, ``hit_spans`` (first word, last word + 1; disjoint) and
    ``hit_items`` (ids as text, sorted as strings) of the whole text of each row."""
    spark = docs.sparkSession
    total = benchmark.agg(F.sum(F.regexp_count(item_text, F.lit(WORD)))).head()[0] or 0
    blocks = max(1, -(-total // block_words))
    docs = docs.drop(*[c for c in docs.columns if c.lower() in (SPANS, ITEMS, COUNT)])
    added = [
        T.StructField(COUNT, T.LongType()),
        T.StructField(SPANS, T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField(ITEMS, T.ArrayType(T.StringType())),
    ]
    plain = docs.columns
    schema = T.StructType([*docs.schema.fields, *added])
    kinds = [pa.int64(), pa.list_(pa.list_(pa.int64())), pa.list_(pa.string())]
    for block in range(blocks):
        part = benchmark.where(F.pmod(F.xxhash64(item), F.lit(blocks)) == block) if blocks > 1 else benchmark
        rows = part.select(item, item_text).collect()
        names, sets = build([tuple(r) for r in rows], width)
        sent = spark.sparkContext.broadcast((names, sets))

        def scan(batches, sent=sent, again=block > 0):
            names, sets = sent.value
            for batch in batches:
                done = [[], [], []]
                for part in _scan(sets, names, batch.column(batch.schema.get_field_index(text))):
                    for all_rows, rows in zip(done, part):
                        all_rows.extend(rows)
                if again:
                    before = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (SPANS, ITEMS)]
                    done[1] = [_merged(a + b) for a, b in zip(before[0], done[1])]
                    done[2] = [sorted({*a, *b}) for a, b in zip(before[1], done[2])]
                columns = [batch.column(batch.schema.get_field_index(c)) for c in plain]
                columns += [pa.array(v, k) for v, k in zip(done, kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=[*plain, COUNT, SPANS, ITEMS])

        docs = docs.mapInArrow(scan, schema)
        if block < blocks - 1:
            # a stage of its own, so that no task holds two blocks
            docs = staged(docs, "hits")
    return docs


def digest(found):
    """Counts, the digest of the item list and the verdict, from ``find_occurrences``."""
    hit = F.aggregate(SPANS, F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return (
        found.withColumn("n_hit", hit)
        .withColumn("n_items", F.size(ITEMS).cast("long"))
        .withColumn("items_sha256", F.sha2(F.array_join(ITEMS, ","), 256))
        .withColumn("contaminated", F.col("n_hit") > 0)
    )


def clean(docs, benchmark, **options):
    """``docs`` without the rows in which an item's window occurs; columns unchanged."""
    rows = packed(docs, F.col(options.get("text", "text")))
    return find_occurrences(rows, benchmark, **options).where(F.size(SPANS) == 0).select("_doc.*")


LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL = f"""
WITH d AS (SELECT doc_id, coalesce({WORDS}, []) AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
p AS (SELECT DISTINCT item, len(win) AS size, array_to_string(win, ' ') AS win FROM (
  SELECT item, unnest([w[i:i + least({WIDTH}, len(w)) - 1] FOR i IN range(1, greatest(len(w) - {WIDTH}, 0) + 2)]) AS win
  FROM b WHERE len(w) > 0)),
s AS (SELECT DISTINCT size FROM p),
v AS (SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS i, w FROM d, s WHERE len(w) >= size),
o AS (SELECT doc_id, i, p.size, item FROM v JOIN p ON v.size = p.size AND array_to_string(w[i:i + v.size - 1], ' ') = win),
h AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM o) GROUP BY doc_id),
g AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, item FROM o) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(g.n, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN g USING (doc_id)
"""


@register("op10_decontaminate", SQL)
def op10_decontaminate(spark, folder):
    found = find_occurrences(
        table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark")
    )
    return digest(found).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
