"""Language-model scores by context-tree weighting over bytes.

A byte is eight binary decisions.  Each of the 255 decision nodes has a context tree
over the preceding bytes, up to ``DEPTH`` of them; every tree node holds a Krichevsky-
Trofimov estimate, and a node's weighted probability is half its own block estimate and
half the product over its children.  The trees are learnt from counts: Spark sums the
byte strings of DEPTH + 1 over all training documents, and the weights follow from the
counts in closed form, leaves first.

A tree grows under a node wherever training visits it at least ``VISITS`` times, so the
trees grow with the corpus.  What passes below a node by rarer contexts is one more child,
"other", so no count is lost.

No task holds the trees.  Subtrees under two bytes of context are worked out where Spark
has grouped their strings: once for the weight that they hand up, and, when the nodes above
are known, once for the probability of every string.  Above are at most 255 * 257 nodes,
whatever the corpus; these alone travel to all tasks.  The documents lie in blocks of about
``BLOCK_BYTES``, a row each.  A block's distinct strings go out in a row for each pair of
bytes, sorted and packed, its words in a row for each range of their hashes; their values
come back in the same order, in steps of 2^-32, and meet the block's documents in one task.
Both tasks hold the block's text and take its strings share by share of their pairs.

The text is scored as its words with single spaces between and an end mark, lower-case
in A-Z.

Defined results: a null or blank text is the end mark alone; rows without an id are in
training; equal rows get equal scores; with an empty training part all counts are 0.
"""

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import StorageLevel, TaskContext
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from almanack.llm.base import register, staged, table, whole_groups
from almanack.llm.textbytes import SOLID, U, chunks, runs, word_bounds, words

DEPTH = 7
VISITS = 2
TOP = 2
BLOCK_BYTES = 48 << 20
FOLDS, HELD = 7, 2
END, SPACE = 0x0A, 0x20
CHUNK = 2 << 20
#: text of a block that is taken apart at a time
BLOCK_CHUNK = 1 << 18
HOLD = 2_000_000
#: strings of a block that are looked up at a time, and places of its text whose strings are counted
SHARE_KEYS = 1 << 19
SHARE_PLACES = 1 << 22
#: end marks before the first row, so that eight bytes end at any place
LEAD = 7
GROUP_KEYS = 1_000_000
RANGES = 16
STEP = 2.0**32
#: groups of words follow those of strings
WORDS_FROM = 1 << 16


def sequences(x, at):
    """(bytes, row offsets): words, single spaces, and an end mark for each row."""
    inside, starts, ends = word_bounds(x, at, SOLID)
    of_row = np.searchsorted(starts, at)
    lengths = ends - starts
    count = np.diff(of_row)
    empty = (count == 0).astype(np.int64)
    row = np.repeat(np.arange(len(count)), count)
    before = np.cumsum(lengths) - lengths
    start = before + np.arange(len(lengths)) + (np.cumsum(empty) - empty)[row]
    total = int(lengths.sum()) + len(lengths) + int(empty.sum())
    out = np.full(total, SPACE, np.uint8)
    out[np.arange(int(lengths.sum())) + np.repeat(start - before, lengths)] = x[inside]
    size = empty.copy()
    np.add.at(size, row, lengths + 1)
    out_at = np.concatenate(([0], np.cumsum(size)))
    out[out_at[1:] - 1] = END
    return out, out_at


def strings(seq, at, depth=DEPTH):
    """Each byte with the ``depth`` before it in its row (end marks before the first), as
    a number: the byte lowest, the farthest highest."""
    marked, starts = _marked(seq, at, depth)
    return _strings_at(marked, np.flatnonzero(_unmarked(np.ones(len(marked), bool), starts, depth)), depth)


def _marked(seq, at, depth):
    """(bytes, where rows start): rows with ``depth`` end marks before each, after ``LEAD`` of them."""
    starts = LEAD + at[:-1] + depth * np.arange(1, len(at))
    out = np.full(LEAD + len(seq) + depth * (len(at) - 1), END, np.uint8)
    out[_unmarked(np.ones(len(out), bool), starts, depth)] = seq
    return out, starts


def _unmarked(chosen, starts, depth):
    """``chosen`` without the end marks that ``_marked`` put before rows."""
    chosen[:LEAD] = False
    for back in range(1, depth + 1):
        chosen[starts - back] = False
    return chosen


def _strings_at(marked, places, depth):
    """The byte strings that end at ``places``."""
    eight = np.ndarray(len(marked) - LEAD, ">u8", marked, strides=(1,))
    return eight[places - LEAD].astype(U) & U((1 << (8 * (depth + 1))) - 1)


class _Counter:
    """Sums of counts by key, held sorted; handed on when they are many."""

    def __init__(self):
        self.parts, self.size, self.limit = [], 0, HOLD

    def add(self, keys, counted=True):
        """Count each key once, or only make it known."""
        keys.sort()
        at, n = runs(keys)
        self.parts.append((keys[at], n.astype(np.int32) if counted else np.zeros(len(at), np.int32)))
        self.size += len(at)
        if self.size > self.limit:
            self.merge()
            self.limit = max(HOLD, self.size * 3 // 2)

    def merge(self):
        """One sorted part of all, range by range of the keys, as whole copies are large."""
        if len(self.parts) > 1:
            long = max((k for k, _ in self.parts), key=len)
            cuts = np.unique(long[:: max(1, -(-len(long) // RANGES))])
            places = [np.concatenate(([0], np.searchsorted(k, cuts[1:]), [len(k)])) for k, _ in self.parts]
            made = [self._merged(r, places) for r in range(max(1, len(cuts)))]
            self.parts = []
            self.parts = [(np.concatenate([k for k, _ in made]), np.concatenate([n for _, n in made]))]
            self.size = len(self.parts[0][0])

    def _merged(self, r, places):
        cut = [(k[at[r] : at[r + 1]], n[at[r] : at[r + 1]]) for (k, n), at in zip(self.parts, places)]
        keys, n = (np.concatenate(v) for v in zip(*cut))
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order]
        at, _ = runs(keys)
        return keys[at], np.add.reduceat(n, at).astype(n.dtype) if len(at) else n

    def rows(self, **same):
        """Arrow batches of ``key, n`` after the columns that are the same in every row."""
        self.merge()
        for keys, n in self.parts:
            for a in range(0, len(keys), 1 << 17):
                k = keys[a : a + (1 << 17)].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(k), v, np.int32)) for v in same.values()] + [pa.array(k), pa.array(n[a : a + (1 << 17)].astype(np.int64))],
                    names=[*same, "key", "n"],
                )
        self.parts, self.size = [], 0


WORD, STRING = 0, 1


def _count(batches):
    """text -> partial counts of words and byte strings."""
    kinds = {WORD: _Counter(), STRING: _Counter()}
    for batch in batches:
        for _, _, x, at in chunks(batch.column(0), CHUNK):
            kinds[WORD].add(words(x, at, SOLID)[0])
            kinds[STRING].add(strings(*sequences(x, at)))
            for kind, c in kinds.items():
                if c.size > HOLD:
                    yield from c.rows(kind=kind)
    for kind, c in kinds.items():
        yield from c.rows(kind=kind)


def _planes(x):
    """64-bit numbers by byte planes, packed."""
    x = np.ascontiguousarray(x, U)
    return pa.compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T).tobytes(), "zstd", asbytes=True)


def _unplanes(packed, size):
    flat = pa.decompress(packed, decompressed_size=8 * size, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(flat, np.uint8).reshape(8, size).T).view(U).ravel()


def _sorted_keys(packed, size):
    return np.cumsum(_unplanes(packed, size), dtype=U)


def _make_blocks(limit):
    """doc_id, held_out, text -> rows of whole blocks, packed."""

    def run(batches):
        held, size, made = [], 0, 0

        def block():
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=6))) as out:
                for batch in held:
                    # a reader holds one piece at a time
                    rows = max(1, len(batch) * CHUNK // max(1, batch.nbytes))
                    for first in range(0, len(batch), rows):
                        out.write_batch(batch.slice(first, rows))
            number = (TaskContext.get().partitionId() << 32) + made
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["block", "docs"])

        for batch in batches:
            length = pa.compute.binary_length(batch.column(2)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            cut = np.flatnonzero(np.diff((size + np.cumsum(length)) // limit, prepend=size // limit)) + 1
            for first, last in zip([0, *cut.tolist()], [*cut.tolist(), len(batch)]):
                if last > first:
                    held.append(batch.slice(first, last - first))
                    size += int(length[first:last].sum())
                if size >= limit:
                    yield block()
                    held, size, made = [], 0, made + 1
        if held:
            yield block()

    return run


def _give_back():
    """Return memory that freed arrays left with the allocators; a worker keeps it else."""
    pa.default_memory_pool().release_unused()
    # numpy's arrays; the C library has it on Linux alone
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def _rows_of(packed):
    return pa.ipc.open_stream(packed)


def _turned(keys):
    """Byte strings with the two bytes before the last highest, so that pairs sort together."""
    return (keys >> U(8) << U(48)) | (keys >> U(24) << U(8)) | (keys & U(255))


def _back(keys):
    """What ``_turned`` was given."""
    return (keys << U(16) >> U(24) << U(24)) | (keys >> U(48) << U(8)) | (keys & U(255))


def _pairs(marked):
    """The two bytes before each place from ``LEAD`` on, as a number."""
    return marked[LEAD - 1 : -1].astype(np.uint16) | marked[LEAD - 2 : -2].astype(np.uint16) << 8


def _shares(size, limit):
    """Of each pair the share it is in: neighbours of about ``limit`` by their ``size``."""
    return np.unique((np.cumsum(size) - size) // limit, return_inverse=True)[1]


def _places(marked, starts, own, depth):
    """Where the byte strings under the pairs of ``own`` end."""
    chosen = np.zeros(len(marked), bool)
    chosen[LEAD:] = own[_pairs(marked)]
    return np.flatnonzero(_unmarked(chosen, starts, depth))


def _counted_strings(texts, depth):
    """(strings, counts) of ``texts`` (see ``_marked``; and whether rows are held out), sorted,
    one share of the pairs after the other."""
    size = sum(np.bincount(_pairs(marked), minlength=1 << 16) for marked, _, _ in texts)
    share_of = _shares(size, SHARE_PLACES)
    for share in range(share_of.max() + 1):
        own, c = share_of == share, _Counter()
        sides = {True: [], False: []}

        def add(limit):
            for counted, found in sides.items():
                if sum(map(len, found)) > limit:
                    c.add(np.concatenate(found), counted)
                    found.clear()

        for marked, starts, held in texts:
            places = _places(marked, starts, own, depth)
            keys = _turned(_strings_at(marked, places, depth))
            out = np.repeat(held, np.diff(np.append(starts, len(marked))))[places - starts[0]]
            sides[True].append(keys[~out])
            sides[False].append(keys[out])
            add(SHARE_KEYS)
        add(0)
        c.merge()
        yield from c.parts


def _packed_rows(number, group, keys, n):
    """A row for each group, which are runs of keys."""
    at, size = runs(group)
    made = [(group[a], a, a + k) for a, k in zip(at.tolist(), size.tolist())]
    for a in range(0, len(made), 256):
        some = made[a : a + 256]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([g for g, _, _ in some], pa.int32()),
                pa.array([number] * len(some), pa.int64()),
                pa.array([j - i for _, i, j in some], pa.int64()),
                pa.array([_planes(np.diff(keys[i:j], prepend=U(0))) for _, i, j in some], pa.binary()),
                pa.array([_planes(n[i:j]) for _, i, j in some], pa.binary()),
            ],
            names=["pair", "block", "size", "keys", "counts"],
        )


def _count_blocks(depth):
    """block, docs -> each block's sorted words and byte strings with their counts, a row for
    each group; rows that are held out make theirs known and add nothing to counts."""

    def run(batches):
        for batch in batches:
            for number, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                c, texts = _Counter(), []
                for rows in _rows_of(packed.as_buffer()):
                    outside = rows.column(1).to_numpy(zero_copy_only=False)
                    for first, last, x, at in chunks(rows.column(2), BLOCK_CHUNK):
                        h, of_row = words(x, at, SOLID)
                        out = np.repeat(outside[first:last], np.diff(of_row))
                        c.add(h[~out])
                        c.add(h[out], counted=False)
                        texts.append((*_marked(*sequences(x, at), depth), outside[first:last]))
                c.merge()
                for keys, n in c.parts:
                    yield from _packed_rows(number, (keys >> U(56)).astype(np.int32) + WORDS_FROM, keys, n)
                rows = c = keys = n = x = h = out = None
                _give_back()
                for keys, n in _counted_strings(texts, depth):
                    yield from _packed_rows(number, (keys >> U(48)).astype(np.int32), _back(keys), n)
                texts = keys = n = None
                _give_back()

    return run


def _log_gamma(x):
    """log Gamma for x > 0, by Stirling's series after eight steps up."""
    shift = np.ones_like(x)
    for k in range(8):
        shift *= x + k
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(shift)


FEW = 1 << 12
_OF_FEW = {shift: _log_gamma(np.arange(FEW) + shift) for shift in (0.5, 1.0)}


def _log_gamma_after(n, shift):
    """log Gamma(n + shift) of whole numbers; those below ``FEW`` from a table."""
    out = _OF_FEW[shift][np.minimum(n, FEW - 1).astype(np.int64)]
    far = np.flatnonzero(n >= FEW)
    out[far] = _log_gamma(n[far] + shift)
    return out


def log_kt(a, b):
    """Log of the Krichevsky-Trofimov probability of a block with ``a`` 0s and ``b`` 1s."""
    return _log_gamma_after(a, 0.5) + _log_gamma_after(b, 0.5) - np.log(np.pi) - _log_gamma_after(a + b, 1.0)


def _kt(a, b):
    return (b + 0.5) / (a + b + 1.0)


def fold_up(levels, first=0, below=None):
    """Leaves first: ``levels`` has (sorted keys, 0s, 1s) of the nodes at depth ``first`` and
    on, ``below`` (keys, 0s, 1s, log weights) of nodes under the last -> what ``fold_down``
    needs, and the first level with its log weights."""
    prepared = [None] * len(levels)
    for d in range(len(levels) - 1, -1, -1):
        keys, a, b = levels[d]
        own, other, split, has = log_kt(a, b), (a, b), 0.0, np.zeros(len(keys), bool)
        if below is not None and len(below[0]):
            parent = np.searchsorted(keys, below[0] & U((1 << (8 * (first + d + 1))) - 1))
            ca, cb, split = (np.bincount(parent, v, len(keys)) for v in below[1:])
            other, has = (a - ca, b - cb), np.bincount(parent, minlength=len(keys)) > 0
        split = split + log_kt(*other)
        both = np.where(has, np.log(0.5) + np.logaddexp(own, split), own)
        beta = np.where(has, np.exp(np.log(0.5) + own - both), 1.0)
        prepared[d] = (keys, _kt(a, b), beta, _kt(*other))
        below = (keys, a, b, both)
    return prepared, below


def fold_down(prepared, first=0, above=None):
    """From the root: (keys, P(1)) by depth, the weighted prediction where no deeper node is
    known; and of the last level (keys, prediction so far, weight left) for those under it."""
    out = []
    for d, (keys, kt, beta, other) in enumerate(prepared):
        if above is None:
            sofar, left = np.zeros(len(keys)), np.ones(len(keys))
        else:
            parent = np.searchsorted(above[0], keys & U((1 << (8 * (first + d))) - 1))
            sofar, left = above[1][parent], above[2][parent]
        out.append((keys, np.clip(sofar + left * (beta * kt + (1 - beta) * other), 1e-12, 1 - 1e-12)))
        above = (keys, sofar + left * beta * kt, left * (1 - beta))
    return out, above


def weigh(levels):
    """``levels[d]``: (sorted keys, 0s, 1s) of the nodes at depth d -> (keys, P(1)) by depth."""
    return fold_down(fold_up(levels)[0])[0]


def log_probabilities(model, keys):
    """log10 of the probability of each byte string's byte after its context."""
    byte = keys & U(255)
    total = np.zeros(len(keys))
    for k in range(8):
        prefix = (byte >> U(8 - k)) | U(1 << k)
        bit = ((byte >> U(7 - k)) & U(1)).astype(bool)
        node = (keys & ~U(255)) | prefix
        p = np.full(len(keys), 0.5)
        wait = np.arange(len(keys))
        for d in range(len(model) - 1, -1, -1):
            own, value = model[d]
            if not len(own) or not len(wait):
                continue
            key = node[wait] & U((1 << (8 * (d + 1))) - 1)
            at = np.minimum(np.searchsorted(own, key), len(own) - 1)
            hit = own[at] == key
            p[wait[hit]] = value[at[hit]]
            wait = wait[~hit]
        total += np.log10(np.where(bit, p, 1.0 - p))
    return total


class _Lookup:
    """Places of keys by a table of hashes; those whose slot another has, by a second one
    with another hash, then by search."""

    def __init__(self, keys, values):
        if (keys[1:] < keys[:-1]).any():
            order = np.argsort(keys)
            keys, values = keys[order], values[order]
        self.keys, self.values = keys, values
        self.tables, left = [], np.arange(len(keys), dtype=np.int32)
        for odd in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
            bits = max(4, int(2 * len(left)).bit_length())
            slots, lost = np.zeros(1 << bits, np.int32), []
            parts = [left[a : a + CHUNK] for a in range(0, len(left), CHUNK)]
            for some in parts:
                slots[self._slot(keys[some], odd, bits)] = some
            for some in parts:
                lost.append(some[slots[self._slot(keys[some], odd, bits)] != some])
            left = np.concatenate([*lost, left[:0]])
            self.tables.append((odd, bits, slots))

    def _slot(self, keys, odd, bits):
        return (keys * U(odd)) >> U(64 - bits)

    def __call__(self, keys):
        """(values, whether known); unknown keys have 0."""
        known = np.ones(len(keys), bool)
        if not len(self.keys):
            return np.zeros(len(keys), self.values.dtype), ~known
        (*one, slots), (*two, more) = self.tables
        at = slots[self._slot(keys, *one)]
        miss = np.flatnonzero(self.keys[at] != keys)
        at[miss] = more[self._slot(keys[miss], *two)]
        miss = miss[self.keys[at[miss]] != keys[miss]]
        at[miss] = np.minimum(np.searchsorted(self.keys, keys[miss]), len(self.keys) - 1)
        known[miss] = self.keys[at[miss]] == keys[miss]
        found = self.values[at]
        found[~known] = 0
        return found, known


def nodes(keys, n, depth, visits):
    """(sorted keys, 0s, 1s) of the nodes at ``depth`` with enough visits, from counts of strings."""
    low = keys & U((1 << (8 * (depth + 1))) - 1)
    order = np.argsort(low, kind="stable")
    low, n = low[order], n[order]
    made = []
    if len(low):
        at, size = runs(low >> U(8))
        often = np.repeat(np.add.reduceat(n, at) >= visits, size)
        low, n = low[often], n[often]
    for k in range(8 if len(low) else 0):
        node = (low & ~U(255)) | ((low & U(255)) >> U(8 - k)) | U(1 << k)
        at, _ = runs(node)
        one = np.add.reduceat(n * ((low >> U(7 - k)) & U(1)), at)
        made.append((node[at], np.add.reduceat(n, at) - one, one))
    if not made:
        return np.zeros(0, U), np.zeros(0), np.zeros(0)
    node, zero, one = (np.concatenate(v) for v in zip(*made))
    kept = np.flatnonzero(zero + one >= visits)
    kept = kept[np.argsort(node[kept])]
    return node[kept], zero[kept], one[kept]


def _nodes(counts, depth, least):
    """Spark: the tree nodes at ``depth`` with enough visits, from counts of strings."""
    # all 64 bits are -1 as a signed number
    low = F.col("key").bitwiseAND(F.lit((1 << (8 * (depth + 1))) - 1 if depth < 7 else -1))
    sums = counts.where(F.col("kind") == STRING).groupBy(low.alias("key")).agg(F.sum("n").alias("n"))
    context = F.shiftright("key", 8)
    sums = sums.withColumn("context", context).withColumn("visits", F.sum("n").over(W.partitionBy("context")))
    sums = sums.where(F.col("visits") >= least)
    byte = F.col("key").bitwiseAND(F.lit(255)).cast("int")
    steps = F.array(
        *[
            F.struct(
                (F.shiftright(byte, 8 - k).bitwiseOR(F.lit(1 << k))).alias("prefix"),
                F.shiftright(byte, 7 - k).bitwiseAND(F.lit(1)).alias("bit"),
            )
            for k in range(8)
        ]
    )
    each = sums.select("context", "n", F.explode(steps).alias("s"))
    node = F.shiftleft("context", 8).bitwiseOR(F.col("s.prefix").cast("long"))
    each = each.select(node.alias("node"), "n", "s.bit")
    out = each.groupBy("node").agg(F.sum(F.when(F.col("bit") == 0, F.col("n")).otherwise(0)).alias("a"), F.sum(F.when(F.col("bit") == 1, F.col("n")).otherwise(0)).alias("b"))
    return out.where(F.col("a") + F.col("b") >= least)


def _level(counts, depth, visits):
    """The nodes at ``depth`` with enough visits, at the driver."""
    got = _nodes(counts, depth, visits).toArrow()
    keys = got.column("node").to_numpy().view(U)
    a, b = (got.column(c).to_numpy().astype(np.float64) for c in "ab")
    if depth == 0:
        # the first decisions are always known
        zero, one = np.zeros(255), np.zeros(255)
        zero[keys.astype(np.int64) - 1], one[keys.astype(np.int64) - 1] = a, b
        return np.arange(1, 256, dtype=U), zero, one
    order = np.argsort(keys)
    return keys[order], a[order], b[order]


def learn(counts, positions, depth=DEPTH, least=0.0):
    """The prediction tables of all depths at the driver, for a small corpus or, with a least
    share of all positions for a node, at most 8 / least nodes a depth."""
    visits = max(VISITS, int(np.ceil(least * positions)))
    return weigh([_level(counts, d, visits) for d in range(depth + 1)])


def _added(at, values, size):
    """Sums of ``values`` by place; of none ``np.bincount`` would make whole numbers."""
    return np.bincount(at, values, size).astype(np.float64)


def _subtrees(batches, depth, visits):
    """From strings sorted by the two bytes before theirs: (keys, subtrees, weights handed up)."""
    for rows, _ in whole_groups(batches, ["pair"]):
        keys = rows.column("key").to_numpy().view(U)
        n = rows.column("n").to_numpy().astype(np.float64)
        seen = n > 0
        yield keys, *fold_up([nodes(keys[seen], n[seen], d, visits) for d in range(TOP, depth + 1)], TOP)


def _hand_up(depth, visits):
    def run(batches):
        for _, _, (keys, *values) in _subtrees(batches, depth, visits):
            parent, at = np.unique(keys & U((1 << (8 * TOP)) - 1), return_inverse=True)
            sums = [pa.array(_added(at, v, len(parent))) for v in values]
            yield pa.RecordBatch.from_arrays([pa.array(parent.view(np.int64)), *sums], names=["node", "a", "b", "weight"])

    return run


def _look_down(sent, depth, visits):
    def run(batches):
        top, above = sent.value
        for keys, prepared, _ in _subtrees(batches, depth, visits):
            value = log_probabilities([*top, *fold_down(prepared, TOP, above)[0]], keys)
            kind = np.full(len(keys), STRING, np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(keys.view(np.int64)), pa.array(value)], names=["kind", "key", "value"])

    return run


def string_values(counts, depth=DEPTH, visits=VISITS):
    """``kind, key, n`` -> ``kind, key, value``: of each byte string the log10 probability of
    its last byte after those before it, learnt from all strings with their counts."""
    spark = counts.sparkSession
    context = F.shiftright("key", 8).bitwiseAND(F.lit((1 << (8 * TOP)) - 1)).cast("int")
    grouped = counts.where(F.col("kind") == STRING).select("key", "n", context.alias("pair")).repartition("pair").sortWithinPartitions("pair")
    up = grouped.mapInArrow(_hand_up(depth, visits), "node long, a double, b double, weight double")
    up = up.groupBy("node").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("weight").alias("weight")).toArrow()
    below = (up.column("node").to_numpy().view(U), *(up.column(c).to_numpy() for c in ("a", "b", "weight")))
    prepared, _ = fold_up([_level(counts, d, visits) for d in range(TOP)], 0, below)
    sent = spark.sparkContext.broadcast(fold_down(prepared))
    return grouped.mapInArrow(_look_down(sent, depth, visits), "kind int, key long, value double")


UP, COUNTED, ALL_WORDS = 0, 1, 2


def _summed_keys(rows):
    """Distinct keys of packed rows with their counts, one row after the other."""
    c = _Counter()
    for size, keys, counts in zip(rows.column("size").to_pylist(), rows.column("keys"), rows.column("counts")):
        c.parts.append((_sorted_keys(keys.as_buffer(), size), _unplanes(counts.as_buffer(), size).view(np.int64)))
        c.size += size
        if c.size > c.limit:
            c.merge()
            c.limit = max(HOLD, c.size * 3 // 2)
    c.merge()
    return c.parts[0]


def _packed_groups(batches):
    """From packed rows sorted by group: (rows, distinct keys, counts, whether strings) of a
    few whole groups at a time."""
    for rows, at in whole_groups(batches, ["pair"]):
        sizes = np.add.reduceat(rows.column("size").to_numpy(), at[:-1])
        words_from = rows.column("pair").to_numpy()[at[:-1]] >= WORDS_FROM
        start, total = 0, 0
        for k in range(len(sizes)):
            total += int(sizes[k])
            if k + 1 == len(sizes) or total + sizes[k + 1] > GROUP_KEYS or words_from[k] != words_from[k + 1]:
                some = rows.slice(at[start], at[k + 1] - at[start])
                yield some, *_summed_keys(some), not words_from[k]
                start, total = k + 1, 0


def _subtree(keys, n, depth, visits):
    seen = n > 0
    keys, n = keys[seen], n[seen].astype(np.float64)
    return fold_up([nodes(keys, n, d, visits) for d in range(TOP, depth + 1)], TOP)


def _sum_up(depth, visits):
    """What the nodes above must know of each group."""

    def batch(kind, node, a, b, weight):
        columns = [np.full(len(node), kind, np.int32), node.view(np.int64), a, b, weight]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["kind", "node", "a", "b", "weight"])

    def run(batches):
        for _, keys, n, string in _packed_groups(batches):
            if not string:
                yield batch(ALL_WORDS, np.zeros(1, U), np.array([n.sum()], float), np.array([(n > 0).sum()], float), np.zeros(1))
                continue
            _, (low, *values) = _subtree(keys, n, depth, visits)
            parent, at = np.unique(low & U((1 << (8 * TOP)) - 1), return_inverse=True)
            yield batch(UP, parent, *(_added(at, v, len(parent)) for v in values))
            seen = n > 0
            byte, at = np.unique(keys[seen] & U((1 << (8 * TOP)) - 1), return_inverse=True)
            none = np.zeros(len(byte))
            yield batch(COUNTED, byte, _added(at, n[seen], len(byte)), none, none)

    return run


def _send_back(sent, depth, visits):
    """To each block the values of its strings, in steps, and the counts of its words."""

    def run(batches):
        top, above = sent.value
        for rows, keys, n, string in _packed_groups(batches):
            value = n.view(U)
            if string:
                below = fold_down(_subtree(keys, n, depth, visits)[0], TOP, above)[0]
                value = np.concatenate([np.rint(-STEP * log_probabilities([*top, *below], keys[a : a + CHUNK])).astype(U) for a in range(0, len(keys), CHUNK)])
            for a in range(0, len(rows), 256):
                some = rows.slice(a, min(256, len(rows) - a))
                made = [
                    _planes(value[np.searchsorted(keys, _sorted_keys(k.as_buffer(), size))])
                    for size, k in zip(some.column("size").to_pylist(), some.column("keys"))
                ]
                made = [*(some.column(c).combine_chunks() for c in ("block", "pair", "size", "keys")), pa.array(made, pa.binary())]
                yield pa.RecordBatch.from_arrays([c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in made], names=["block", "pair", "size", "keys", "values"])
        _give_back()

    return run


SCORED = "held_out boolean, words long, seen long, bytes long, base double, score double"


def _unpacked(values, rows):
    """Keys and values of some rows, one row after the other."""
    size = values.column("size").to_numpy()[rows]
    key, value, start = np.zeros(size.sum(), U), np.zeros(size.sum(), U), 0
    for r, k in zip(rows.tolist(), size.tolist()):
        key[start : start + k] = _sorted_keys(values.column("keys")[r].as_buffer(), k)
        value[start : start + k] = _unplanes(values.column("values")[r].as_buffer(), k)
        start += k
    return key, value


def _string_sums(texts, values, rows, depth):
    """Of each row of ``texts`` (see ``_marked``) the sum of its strings' values, in steps, so
    exact in any order.  ``rows`` of values are in order of their pairs; the strings under a
    few pairs, about ``SHARE_KEYS``, are looked up in the whole block before the next ones."""
    pair, size = (values.column(c).to_numpy()[rows] for c in ("pair", "size"))
    share_of = _shares(np.bincount(pair, size, 1 << 16).astype(np.int64), SHARE_KEYS)
    sums = [np.zeros(len(starts), np.int64) for _, starts in texts]
    for share in range(share_of.max() + 1):
        key, value = _unpacked(values, rows[share_of[pair] == share])
        string = _Lookup(_turned(key), value.view(np.int64))
        key = value = None
        own = share_of == share
        for (marked, starts), total in zip(texts, sums):
            places = _places(marked, starts, own, depth)
            found, _ = string(_turned(_strings_at(marked, places, depth)))
            upto = np.concatenate((np.zeros(1, np.int64), np.cumsum(found)))
            total += np.diff(upto[np.append(np.searchsorted(places, starts), len(places))])
        string = None
    return sums


def _score_block(docs, values, depth):
    """A block's documents with the values of its words and strings."""
    _give_back()
    pair = values.column("pair").to_numpy()
    order = np.argsort(pair, kind="stable")
    key, n = _unpacked(values, order[pair[order] >= WORDS_FROM])
    word = _Lookup(key[n > 0], np.log10(n[n > 0] + 1.0))
    key = n = None
    parts, texts = [], []
    for batch in (b for packed in docs.column("docs") for b in _rows_of(packed.as_buffer())):
        for first, last, x, at in chunks(batch.column(2), BLOCK_CHUNK):
            h, of_row = words(x, at, SOLID)
            tokens = np.diff(of_row)
            count, known = word(h)
            base = np.diff(np.concatenate(([0.0], np.cumsum(count)))[of_row])
            seen = np.diff(np.concatenate(([0], np.cumsum(known)))[of_row])
            seq, seq_at = sequences(x, at)
            texts.append(_marked(seq, seq_at, depth))
            ids = [v.slice(first, last - first) for v in batch.columns[:2]]
            parts.append((ids, [tokens.astype(np.int64), seen.astype(np.int64), np.diff(seq_at).astype(np.int64), base]))
    word = batch = x = h = seq = count = known = None
    _give_back()
    sums = _string_sums(texts, values, order[pair[order] < WORDS_FROM], depth)
    texts = None
    # the next block arrives before this is called again
    _give_back()
    names = ["doc_id", *(c.split()[0] for c in SCORED.split(", "))]
    return pa.Table.from_batches(
        [pa.RecordBatch.from_arrays([*ids, *map(pa.array, columns), pa.array(total / -STEP)], names=names) for (ids, columns), total in zip(parts, sums)]
    )


def score(docs, doc_id="doc_id", text="text", depth=DEPTH, visits=VISITS):
    """One row per row of ``docs``: see the module and the columns of the last select.
    ``depth`` is 2 to 7."""
    spark = docs.sparkSession
    held = F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == HELD, F.lit(False))
    rows = docs.select(F.col(doc_id).alias("doc_id"), held.alias("held_out"), F.col(text).alias("text"))
    size, trained = rows.agg(F.sum(F.octet_length("text")), F.count_if(~F.col("held_out"))).head()
    tasks = max(spark.sparkContext.defaultParallelism, -(-(size or 0) // BLOCK_BYTES))
    blocks = staged(rows.coalesce(tasks).mapInArrow(_make_blocks(BLOCK_BYTES * 3 // 2), "block long, docs binary"), "blocks")
    parts = blocks.mapInArrow(_count_blocks(depth), "pair int, block long, size long, keys binary, counts binary")
    # read on both ways through the trees; kept until the session's cache is cleared
    parts = parts.repartition("pair").sortWithinPartitions("pair").persist(StorageLevel.DISK_ONLY)
    up = parts.mapInArrow(_sum_up(depth, visits), "kind int, node long, a double, b double, weight double")
    up = up.groupBy("kind", "node").agg(*(F.sum(c).alias(c) for c in ("a", "b", "weight"))).toArrow()
    up = {c: up.column(c).to_numpy() for c in up.column_names}
    of = lambda kind, *names: [up[c][up["kind"] == kind] for c in names]
    n_words, distinct = (int(v.sum()) for v in of(ALL_WORDS, "a", "b"))
    total, distinct = n_words + trained, distinct + (trained > 0)
    node, *below = of(UP, "node", "a", "b", "weight")
    key, n = of(COUNTED, "node", "a")
    key = key.view(U)
    # the first decisions are always known
    zero, one = np.zeros(256), np.zeros(256)
    first, a, b = nodes(key, n, 0, visits)
    zero[first.astype(np.int64)], one[first.astype(np.int64)] = a, b
    levels = [(np.arange(1, 256, dtype=U), zero[1:], one[1:]), nodes(key, n, 1, visits)]
    prepared, _ = fold_up(levels, 0, (node.view(U), *below))
    sent = spark.sparkContext.broadcast(fold_down(prepared))
    values = parts.mapInArrow(_send_back(sent, depth, visits), "block long, pair int, size long, keys binary, values binary")
    main = blocks.groupBy("block").cogroup(values.groupBy("block")).applyInArrow(
        lambda d, v: _score_block(d, v, depth), f"doc_id {dict(rows.dtypes)['doc_id']}, {SCORED}"
    )
    tokens = F.col("words") + 1
    floor = float(np.log10(total + distinct + 1.0))
    return main.select(
        "doc_id",
        "held_out",
        tokens.alias("n_tokens"),
        (F.col("seen") + F.lit(int(trained > 0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base") + F.lit(float(np.log10(trained + 1.0))) - tokens * F.lit(floor)).alias("base_score"),
        "score",
        F.col("bytes").alias("n_bytes"),
        (-F.col("score") / F.log10(F.lit(2.0)) / F.col("bytes")).alias("bits_per_byte"),
    )


@register("op7_context_tree")
def op7_context_tree(spark, folder):
    return score(table(spark, folder, "documents").select("doc_id", "text"))
