"""A quality classifier by co-training.

Two views of a document: its text (which words occur, shares of symbols and repeats) and
its page metadata (source, language, length and layout of lines).  Each view has its own
logistic regression.  In every round each view is calibrated on labelled rows that it was
not fitted on, scores all unlabelled documents, and hands the rows it is sure about to the
other view as labels.  At the end a third regression over the two calibrated log-odds,
fitted on the same held-back rows, combines the views.

A document is good when its quality label is 1 and its toxic label is not 1.

Features of all documents are made in one map and staged in blocks of rows, two bytes a
word.  Both views are fitted on all labels and all sure guesses.  A round first stages the
rows that have a label in it, with the columns in use alone; every step of the L-BFGS
searches is one pass over these, in which tasks sum loss and gradient of both views, and
the driver holds weights and gradients alone, of a fixed size.  Bounds: of the labels a quarter, but
about ``MAX_HELD`` at most, is held back; the held-back rows' two log-odds come to the
driver for the calibrations (two or three numbers each).  Scores of all documents are made
in one map over whole texts, no shuffle.

Defined results: a null text is an empty one; null metadata is a value of its own; a
label row without id or quality is no label; documents without id are unlabelled; an id
with several labels is good only if all are; without labels of both kinds, fitted and held
back, every document scores 1 and is kept; a document whose score is at least ``KEEP`` is
kept; other columns pass through, result names are replaced.  Sums of the fit are taken in
no fixed order, so scores agree between runs up to rounding.
"""

import pickle
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanack.llm.base import register, staged, table
from almanack.llm.textbytes import ALNUM, SOLID, U, chunks, mixed, word_bounds, words
from almanack.sources.sinks import removed, staging_path

MAX_HELD = 5_000
ROUNDS = 2
SURE = 0.98
KEEP = 0.5
BITS = 18
WORDS = 1 << BITS
SITES = 1 << 10
TEXT, META = "text", "meta"
LIMIT = 12.0
DECAY = {TEXT: 3e-5, META: 1e-3}
LEAST_ROWS = 5
STEPS = 60
BLOCK_CELLS = 1 << 18
#: text that a worker takes apart at a time; some 50 bytes are held for each
CHUNK_BYTES = 1 << 19
PART_BLOCKS = 32
#: columns come in so many ranges of 2^16
RANGES = WORDS >> 16
LISTS = [f"{name}{kind}" for name in (TEXT, META) for kind in ("_ranges", "", "_dense")]
FEW_PARTS = 32

_PLAIN = ALNUM | ~SOLID
_PLAIN[[ord("."), ord(",")]] = True


def _sums(flags, at):
    return np.diff(np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))[at])


def features(texts, sources, langs):
    """Chunks of (first, last, {view: (offsets, columns, dense)})."""
    for first, last, x, at in chunks(texts, CHUNK_BYTES):
        rows = last - first
        size = np.maximum(np.diff(at), 1)
        h, of = words(x, at, ALNUM)
        row = np.repeat(np.arange(rows), np.diff(of))
        key = (row.astype(U) << U(BITS)) | (h >> U(64 - BITS))
        key = np.unique(key)
        columns = (key & U(WORDS - 1)).astype(np.int32)
        ptr = np.searchsorted(key, np.arange(rows + 1).astype(U) << U(BITS))
        total, distinct = np.maximum(np.diff(of), 1), np.maximum(np.diff(ptr), 1)
        space = ~SOLID[x]
        text = [
            _sums(~_PLAIN[x], at) / size,
            _sums(space, at) / size,
            1 - distinct / total,
            np.log1p(total / distinct),
            _sums(ALNUM[x], at) / total / 10,
        ]
        line = np.ones(256, bool)
        line[10] = False
        _, starts, ends = word_bounds(x, at, line)
        of_line = np.searchsorted(starts, at)
        lines = np.maximum(np.diff(of_line), 1)
        longest = np.zeros(rows)
        if len(starts):
            np.maximum.at(longest, np.repeat(np.arange(rows), np.diff(of_line)), (ends - starts).astype(float))
        meta = [np.log1p(size), np.log1p(lines), np.log1p(longest), np.log1p(size / lines)]
        site = []
        for s, g in zip(sources[first:last], langs[first:last]):
            for name in (f"s={s!r}", f"l={g!r}", f"{g!r}|{s!r}"):
                site.append(xxhash.xxh64_intdigest(name.encode()))
        site = mixed(np.array(site, U)) % U(SITES)
        # marks of a row that share a column count once
        pair = np.unique((np.repeat(np.arange(rows), 3).astype(U) << U(BITS)) | site)
        site = (pair & U(WORDS - 1)).astype(np.int32)
        of_site = np.searchsorted(pair, np.arange(rows + 1).astype(U) << U(BITS))
        yield first, last, {
            TEXT: (ptr, columns, np.stack(text, axis=1)),
            META: (of_site, site, np.stack(meta, axis=1)),
        }


class Regression:
    """Weighted logistic regression over indicator columns and scaled dense ones."""

    def __init__(self, columns, decay, mean, scale):
        self.columns, self.decay, self.mean, self.scale = columns, decay, mean, scale
        self.w = np.zeros(columns + len(mean) + 1)
        self.free = np.ones(len(self.w), bool)

    def raw(self, ptr, index, dense):
        sums = np.concatenate(([0.0], np.cumsum(self.w[index])))
        return np.diff(sums[ptr]) + (dense - self.mean) / self.scale @ self.w[self.columns : -1] + self.w[-1]

    def sums(self, part, good, weight):
        """Summed loss and its gradient over the free weights; rows of weight 0 do not count."""
        ptr, index, dense = part
        z = self.raw(*part)
        rest = weight * (_chance(z) - good)
        grad = np.bincount(index, np.repeat(rest, np.diff(ptr)), self.columns)
        grad = np.concatenate((grad, ((dense - self.mean) / self.scale).T @ rest, [rest.sum()]))
        return np.concatenate(([(weight * (np.logaddexp(0, z) - good * z)).sum()], grad[self.free]))

    def small(self):
        """The regression over the free columns alone, in their order."""
        out = Regression(int(self.free[: self.columns].sum()), self.decay, self.mean, self.scale)
        out.w = self.w[self.free]
        return out

    def search(self, usual=None, steps=STEPS):
        """L-BFGS with backtracking on the mean loss and the squared weights: sets the
        weights, waits for ``sums`` over all rows, whose weights sum to 1, and ends with
        the best weights.  Columns that are not ``usual`` keep the weight 0, and no
        gradient of them is made or kept."""
        if usual is not None:
            self.free[: self.columns] = usual
        start = self.w[self.free]

        def whole(w):
            out = np.zeros(len(self.free))
            out[self.free] = w
            return out

        def loss(w):
            self.w = whole(w)
            made = yield
            grad = made[1:].copy()
            grad[:-1] += self.decay * w[:-1]
            return made[0] + self.decay / 2 * (w[:-1] ** 2).sum(), grad

        w = start
        now, grad = yield from loss(w)
        past = []
        for _ in range(steps):
            q, marks = grad.copy(), []
            for s, y, r in reversed(past):
                a = r * (s @ q)
                q -= a * y
                marks.append(a)
            if past:
                s, y, _ = past[-1]
                q *= (s @ y) / (y @ y)
            for (s, y, r), a in zip(past, reversed(marks)):
                q += s * (a - r * (y @ q))
            slope, step = grad @ q, 1.0
            while step > 1e-8:
                ahead, turned = yield from loss(w - step * q)
                if ahead <= now - 1e-4 * step * slope:
                    break
                step /= 2
            else:
                break
            s, y = -step * q, turned - grad
            if s @ y > 1e-12:
                past = [*past[-9:], (s, y, 1 / (s @ y))]
            done = now - ahead < 1e-6
            w, now, grad = w + s, ahead, turned
            if done:
                break
        self.w = whole(w)


def _line(x, good):
    """A regression over a few dense columns of held-back rows, at the driver."""
    model = Regression(0, 1e-4, x.mean(axis=0), x.std(axis=0) + 1e-9)
    part, weight = (np.zeros(len(x) + 1, np.int64), np.zeros(0, np.int64), x), np.full(len(x), 1 / len(x))
    search = model.search()
    try:
        next(search)
        while True:
            search.send(model.sums(part, good, weight))
    except StopIteration:
        return model


def _dense(model, x):
    return model.raw(np.zeros(len(x) + 1, np.int64), np.zeros(0, np.int64), x)


def _chance(odds):
    return 1 / (1 + np.exp(-odds))


class View:
    """A regression of one view and its calibration (a line through the log-odds)."""

    def __init__(self, model, line):
        self.model, self.line = model, line

    def odds(self, part):
        return np.clip(_dense(self.line, self.model.raw(*part)[:, None]), -LIMIT, LIMIT)


class Scorer:
    """The two fitted views and their combination; small enough to send to every task."""

    def __init__(self, views, last):
        self.views, self.last = views, last

    def score(self, parts):
        both = np.stack([self.views[n].odds(parts[n]) for n in (TEXT, META)], axis=1)
        mixed = _dense(self.last, both)
        return _chance(both[:, 0]), _chance(both[:, 1]), _chance(np.clip(mixed, -30, 30))


def _packed(ptr, index):
    """Sorted columns of rows as (how many of a row lie in each range of 2^16, low halves)."""
    row = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
    ranges = np.bincount(row * RANGES + (index >> 16), minlength=(len(ptr) - 1) * RANGES)
    return ranges.astype(np.int32), index.astype(np.uint16)


def _unpacked(ranges, low):
    """(offsets, columns) of rows from ``_packed``."""
    ptr = np.concatenate(([0], np.cumsum(ranges.reshape(-1, RANGES).sum(axis=1))))
    return ptr, low + np.repeat(np.tile(np.arange(RANGES) << 16, len(ptr) - 1), ranges)


def _taken(part, rows):
    """The rows of a part where ``rows`` is true."""
    ptr, index, dense = part
    size = np.diff(ptr)
    return np.concatenate(([0], np.cumsum(size[rows]))), index[np.repeat(rows, size)], dense[rows]


def _binary(values, at):
    """An Arrow column of ``values`` cut at ``at``."""
    at = (at * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(values))])


def _values(column, kind):
    """The values of a column made by ``_binary``."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, kind)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data.slice(at[0], at[-1] - at[0]) if data else b"", kind)


def _gather(batches):
    """Features of documents, a row each."""
    for batch in batches:
        ids, texts, sources, langs = batch.columns
        for first, last, parts in features(texts, sources.to_pylist(), langs.to_pylist()):
            out = [ids.slice(first, last - first)]
            each = np.arange(last - first + 1)
            for name in (TEXT, META):
                ptr, index, dense = parts[name]
                ranges, low = _packed(ptr, index)
                out += [_binary(ranges, each * RANGES), _binary(low, ptr), _binary(dense.ravel(), each * dense.shape[1])]
            size = np.diff(parts[TEXT][0]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*out, pa.array(size)], names=["id", *LISTS, "cells"])


def _block(*values):
    return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(values, 5)], pa.binary())], names=["block"])


def _blocks(batches):
    """Blocks of rows: (sort key, label or NaN, whether held back, {view: features})."""
    for batch in batches:
        size = batch.column(3).to_numpy()
        cut = np.flatnonzero(np.diff(np.cumsum(size, dtype=np.int64) // BLOCK_CELLS, prepend=0)).tolist()
        for first, last in zip([0, *cut], [*cut, len(batch)]):
            if first == last:
                continue
            key, good, hold, _, *columns = batch.slice(first, last - first).columns
            parts = {}
            for name, (ranges, low, dense) in ((TEXT, columns[:3]), (META, columns[3:])):
                parts[name] = (_values(ranges, np.int32), _values(low, np.uint16), _values(dense, np.float64).reshape(last - first, -1))
            plain = lambda c: c.to_numpy(zero_copy_only=False)
            yield _block(plain(key), plain(good).astype(np.float64), plain(hold).astype(bool), parts)


def _opened(batches):
    """What ``_block`` was given, with the columns of each part unpacked."""
    for batch in batches:
        for block in batch.column(0):
            *values, parts = pickle.loads(block.as_buffer())
            yield *values, {name: (*_unpacked(*part[:2]), *part[2:]) for name, part in parts.items()}


def staged_blocks(docs, labels, max_held):
    """All documents as staged blocks."""
    good = (F.min("quality") == 1) & (F.coalesce(F.max("toxic"), F.lit(0)) != 1)
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
    known = known.agg(good.cast("double").alias("good")).select(F.col("doc_id").alias("id"), "good", F.lit(-1).cast("long").alias("nth"))
    share = min(1 << 28, (max_held << 30) // max(known.count(), 1))
    lists = ", ".join(f"{name} binary" for name in LISTS) + ", cells int"
    schema = T.StructType([T.StructField("id", docs.schema["doc_id"].dataType), *T._parse_datatype_string(lists).fields])
    rows = docs.select(F.col("doc_id").alias("id"), "text", "source", "lang").mapInArrow(_gather, schema)
    # rows without an id have no label; their number deals them out over all tasks
    number = F.when(F.col("id").isNull(), F.monotonically_increasing_id()).otherwise(-1)
    # labels grow with the documents: the same join at every size
    rows = rows.withColumn("nth", number).join(known.hint("merge"), ["id", "nth"], "left")
    key = F.xxhash64(F.lit(3), "id")
    hold = F.col("good").isNotNull() & (F.pmod(key, F.lit(1 << 30)) < share)
    rows = rows.select(key.alias("key"), "good", hold.alias("hold"), "cells", *LISTS)
    return staged(rows.mapInArrow(_blocks, "block binary"), "views")


def _summed(blocks, parts, of_block):
    """The sum over all blocks of a dictionary of arrays; None without blocks."""

    def run(batches):
        total = None
        for values in _opened(batches):
            made = of_block(*values)
            total = made if total is None else _plus(total, made)
        if total is not None:
            yield _block(total)

    made = blocks.mapInArrow(run, "block binary")
    if parts > FEW_PARTS:
        return made.rdd.map(lambda row: pickle.loads(row[0])[0]).treeReduce(_plus)
    # as Arrow the driver's JVM hands the bytes on and makes no rows of them
    return reduce(_plus, (pickle.loads(row.as_buffer())[0] for row in made.toArrow().column(0)), None)


def _plus(a, b):
    return b if a is None else {k: a[k] + b[k] for k in a}


def _labels(name, good, hold, parts, views, sure):
    """Labels that a view is fitted on: known ones, and the other view's sure guesses
    where none is known; NaN for all else."""
    own = np.where(hold, np.nan, good)
    if views:
        other = META if name == TEXT else TEXT
        p = _chance(views[other].odds(parts[other]))
        open_rows = np.isnan(good)
        own[open_rows & (p >= sure)] = 1
        own[open_rows & (p <= 1 - sure)] = 0
    return own


def train(docs, labels, rounds=ROUNDS, max_held=MAX_HELD, sure=SURE, seen=None):
    """A fitted ``Scorer``, or None without labels of both kinds.

    ``seen``, a list, gets for each round the rows of both kinds that each view is fitted on."""
    spark = docs.sparkSession
    context = spark.sparkContext
    blocks = staged_blocks(docs, labels, max_held)
    parts = max(context.defaultParallelism, blocks.count() // PART_BLOCKS)
    blocks = blocks.coalesce(parts)

    def first(key, good, hold, parts):
        kinds = [(~hold & (good == g)).sum() for g in (0, 1)] + [(hold & (good == g)).sum() for g in (0, 1)]
        out = {"kinds": np.array(kinds), "rows": np.array([len(key)])}
        for name in (TEXT, META):
            out |= {name: parts[name][2].sum(axis=0), f"{name} squares": (parts[name][2] ** 2).sum(axis=0)}
        return out

    whole = _summed(blocks, parts, first) if not blocks.isEmpty() else None
    if whole is None or not whole["kinds"].all():
        return None
    models, views = {}, None
    for name, columns in ((TEXT, WORDS), (META, SITES)):
        mean = whole[name] / whole["rows"]
        scale = np.sqrt(np.maximum(whole[f"{name} squares"] / whole["rows"] - mean**2, 0)) + 1e-9
        models[name] = Regression(columns, DECAY[name], mean, scale)
    for turn in range(rounds + 1):
        given = context.broadcast(views)

        def kinds(key, good, hold, parts):
            out = {}
            for name, columns in ((TEXT, WORDS), (META, SITES)):
                own = _labels(name, good, hold, parts, given.value, sure)
                ptr, index, _ = parts[name]
                used = np.repeat(~np.isnan(own), np.diff(ptr))
                out[name] = np.array([(own == 0).sum(), (own == 1).sum()])
                out[f"{name} columns"] = np.bincount(index[used], minlength=columns)
            return out

        count = _summed(blocks, parts, kinds)
        if seen is not None:
            seen.append({name: count[name].tolist() for name in models})
        each = {name: 0.5 / count[name] for name in models}
        usual = {name: count[f"{name} columns"] >= LEAST_ROWS for name in models}
        searches = {name: m.search(usual[name]) for name, m in models.items()}
        for search in searches.values():
            next(search)
        sent = context.broadcast(usual)

        def labelled(batches):
            for _, good, hold, parts in _opened(batches):
                out = {}
                for name in (TEXT, META):
                    own = _labels(name, good, hold, parts, given.value, sure)
                    ptr, index, dense = _taken(parts[name], ~np.isnan(own))
                    used = sent.value[name][index]
                    ptr = np.concatenate(([0], np.cumsum(used)))[ptr]
                    index = (np.cumsum(sent.value[name]) - 1)[index[used]]
                    out[name] = (*_packed(ptr, index), dense, own[~np.isnan(own)])
                yield _block(out)

        path = staging_path(spark, "turn")
        turned = staged(blocks.mapInArrow(labelled, "block binary"), "turn", path).coalesce(parts)
        sent.destroy()
        while searches:
            sent = context.broadcast({name: models[name].small() for name in searches})

            def sums(parts):
                out = {}
                for name, model in sent.value.items():
                    *part, own = parts[name]
                    out[name] = model.sums(part, own, np.where(own == 1, each[name][1], each[name][0]))
                return out

            made = _summed(turned, parts, sums)
            sent.destroy()
            for name in list(searches):
                try:
                    searches[name].send(made[name])
                except StopIteration:
                    del searches[name]
        removed(spark, path)
        sent = context.broadcast(models)

        def held(batches):
            for key, good, hold, parts in _opened(batches):
                raw = [sent.value[n].raw(*_taken(parts[n], hold)) for n in (TEXT, META)]
                columns = [key[hold].view(np.float64), good[hold], *raw]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=list("kgtm"))

        rows = blocks.mapInArrow(held, "k double, g double, t double, m double").toArrow()
        rows = np.column_stack([c.to_numpy() for c in rows.columns])
        sent.destroy()
        given.destroy()
        rows = rows[np.argsort(rows[:, 0].copy().view(np.int64), kind="stable")]
        good = rows[:, 1]
        views = {n: View(models[n], _line(rows[:, [k]], good)) for k, n in ((2, TEXT), (3, META))}
    both = np.stack([np.clip(_dense(views[n].line, rows[:, [k]]), -LIMIT, LIMIT) for k, n in ((2, TEXT), (3, META))], axis=1)
    return Scorer(views, _line(both, good))


ADDED = ["text_score", "meta_score", "score", "keep"]


def scored(docs, labels, **options):
    """``docs`` with ``text_score``, ``meta_score``, ``score`` and ``keep``."""
    model = train(docs, labels, **options)
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ADDED])
    if model is None:
        one = F.lit(1.0)
        return docs.withColumns({"text_score": one, "meta_score": one, "score": one, "keep": F.lit(True)})
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, T.DoubleType()) for n in ADDED[:3]], T.StructField("keep", T.BooleanType())])

    def run(batches):
        model = sent.value
        for batch in batches:
            column = lambda name: batch.column(batch.schema.get_field_index(name))
            made = features(column("text"), column("source").to_pylist(), column("lang").to_pylist())
            for first, last, parts in made:
                scores = model.score(parts)
                own = [batch.column(k).slice(first, last - first) for k in range(len(names))]
                yield pa.RecordBatch.from_arrays(
                    [*own, *[pa.array(s) for s in scores], pa.array(scores[2] >= KEEP)], names=[*names, *ADDED]
                )

    return docs.mapInArrow(run, schema)


def good_only(docs, labels, **options):
    """``docs`` that the classifier keeps; columns unchanged."""
    return scored(docs, labels, **options).where("keep").select(*docs.columns)


@register("op5_cotraining")
def op5_cotraining(spark, folder):
    return scored(table(spark, folder, "documents"), table(spark, folder, "labels")).select("doc_id", *ADDED)
