"""Language-model scoring with Brown class-based n-grams.

Exchange clustering assigns every training word to one of ``CLASSES`` classes:

1.  The ``CORE`` most frequent words are exchanged one at a time, each to the class that raises
    the likelihood of the class bigrams most, until no move does.
2.  The other frequent words (``FREQUENT``, in descending frequency) are inserted, and all of
    them exchanged, in parallel sweeps: each word's own class bigrams are counted over the
    whole corpus, and it goes to its best class against the classes as they stand. Every other
    word may move in a sweep, in turns, until fewer than ``SETTLED`` of them do or the
    likelihood stops rising.
3.  All words beyond, however many, are inserted in the same way by their own class bigrams;
    their classes stay in a table.

A text's probability is the product over its tokens of

    (1 - MIX) P(class | class of the word before) P(word | class) + MIX P(word)

    P(class | ..)     bigram counts, smoothed towards the class's share by as many counts as the
                      context has classes; words beyond FREQUENT are one context, unseen ones too
    P(word | class)   (c + 0.1) / (N_class + 0.1 (V_class + 1)); an unseen word takes the one
                      place left in the class with the most words
    P(word)           (c + 0.1) / (N + 0.1 (V + 1)), the base model

Texts are split into words twice, once to count and once to write them as word numbers; all
later passes read the numbers. What comes to the driver is bounded by constants of the
method: bigrams of the core, and counts and classes of the frequent words, which are sent
out. All other words meet their classes and counts in a join, which has no hot key as the
frequent words are out of it.

Defined results
    null, empty text    one token, the end
    null id             counts as the empty text where documents are dealt by id
    no training rows    every word unseen; base score 0
    repeated rows       counted and scored each
    very long texts     scored whole, a batch at a time
    ties                words of equal counts by hash; of equal gains the present class, then
                        the first
    clashing names      only the id and text columns are read
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbre import scratch
from lumbre.llm.words import id_crc32, slices, small_batches, split_words

CORE, CLASSES, FREQUENT = 2048, 64, 1 << 18
#: What a word may stand after or before: a class, 0 being the end's, or a word beyond FREQUENT.
TAIL = CLASSES
STATES = CLASSES + 1
SWEEPS, SETTLED = 6, 0.01
BLOCK, SALTS, TAIL_ROWS = 1024, 64, 400_000
ADD, MIX = 0.1, 0.2


def _hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of distinct words, as signed."""
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words.to_pylist()), np.uint64, len(words)).view(np.int64)


# --- words as numbers -------------------------------------------------------------------


def _vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word counts of a task, as (h, n)."""
    hs, ns, held = [], [], 0

    def merged() -> pa.RecordBatch:
        h, back = np.unique(np.concatenate(hs), return_inverse=True)
        return pa.RecordBatch.from_arrays([pa.array(h), pa.array(np.bincount(back, np.concatenate(ns)).astype(np.int64))], names=["h", "n"])

    for batch in slices(batches, "text"):
        codes, words, _ = split_words(batch.column(0))
        hs.append(_hashes(words))
        ns.append(np.bincount(codes, minlength=len(words)))
        held += len(words)
        if held > 1_000_000:
            yield merged()
            hs, ns, held = [], [], 0
    if hs:
        yield merged()


class WordMap:
    """Numbers of the frequent words, by hash, in descending frequency; -1 for all others."""

    def __init__(self, h: np.ndarray, n: np.ndarray):
        first = np.lexsort((h, -n))
        self.n = n[first]
        order = np.argsort(h[first])
        self.h, self.number = h[first][order], order.astype(np.int32)

    def __len__(self) -> int:
        return len(self.n)

    def look_up(self, h: np.ndarray) -> np.ndarray:
        if not len(self.h):
            return np.full(len(h), -1, np.int32)
        at = np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)
        return np.where(self.h[at] == h, self.number[at], -1).astype(np.int32)


@dataclass
class Vocabulary:
    words: WordMap
    counted: DataFrame
    tokens: int
    distinct: int
    ends: int


def vocabulary(docs: DataFrame, text_col: str = "text", frequent: int = FREQUENT) -> Vocabulary:
    """Counts of all words of ``docs``; the ``frequent`` most frequent ones, to a level of counts, by number."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    counted = scratch.save(texts.mapInArrow(_vocabulary, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")), "lm-words")
    level = F.floor(F.log2("n") * 8).cast("int")
    levels = sorted(counted.groupBy(level.alias("level")).agg(F.count("*").alias("words"), F.sum("n").alias("n")).collect(), key=lambda r: -r["level"])
    least, room = None, frequent
    for r in levels:
        room -= r["words"]
        if room < 0:
            break
        least = r["level"]
    top = (counted.filter(level >= least) if least is not None else counted.limit(0)).select("h", "n").toArrow()
    return Vocabulary(WordMap(*(top.column(c).to_numpy() for c in ("h", "n"))), counted, sum(r["n"] for r in levels), sum(r["words"] for r in levels), docs.count())


CODED = "uid long, doc_id long, held_out boolean, codes binary, tails binary"


def _bytes_of(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Binary values: ``values`` cut at ``offsets``."""
    raw = np.ascontiguousarray(values)
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer((offsets * raw.itemsize).astype(np.int32)), pa.py_buffer(raw)])


def _values_of(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(all numbers of a binary column, the first of each value and the end)."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw.view(kind), (at - at[0]) // np.dtype(kind).itemsize


def _coded(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            codes, words, offsets = split_words(batch.column(3))
            h = _hashes(words)
            numbers = shared.value.look_up(h)[codes]
            rare = numbers < 0
            before = np.concatenate([[0], np.cumsum(rare)])
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], _bytes_of(numbers, offsets), _bytes_of(h[codes[rare]], before[offsets])], names=[x.split()[0] for x in CODED.split(", ")])

    return run


def coded(docs: DataFrame, words: WordMap, held_out, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document as the numbers of its words, -1 for words beyond, whose hashes follow in order."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("doc_id"), held_out.alias("held_out"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return scratch.save(rows.mapInArrow(_coded(docs.sparkSession.sparkContext.broadcast(words)), CODED), "lm-coded")


def _with_ends(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values with a 0 for each document's end, places of the words among them, first token of each document and the end)."""
    docs = len(offsets) - 1
    starts = offsets + np.arange(docs + 1)
    place = np.ones(len(values) + docs, bool)
    place[starts[1:] - 1] = False
    out = np.zeros(len(place), np.int64)
    out[place] = values
    return out, place, starts


# --- sums of sparse tables over all tasks -----------------------------------------------

SPARSE = "block int, salt int, cells binary, counts binary"


def _sparse(block: int, cells: np.ndarray, counts: np.ndarray) -> tuple:
    pack = zstandard.ZstdCompressor(level=1).compress
    return block, -1, pack(cells.astype("<u4").tobytes()), pack(counts.astype("<i8").tobytes())


def _read_sparse(cells, counts) -> tuple[np.ndarray, np.ndarray]:
    unpack = zstandard.ZstdDecompressor().decompress
    return np.frombuffer(unpack(cells), "<u4").astype(np.int64), np.frombuffer(unpack(counts), "<i8")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[x.split()[0] for x in SPARSE.split(", ")])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, block = np.zeros(0, np.int64), None
    for batch in batches:
        for b, cells, counts in zip(batch.column(0), batch.column(2), batch.column(3), strict=True):
            at, n = _read_sparse(cells.as_py(), counts.as_py())
            block = b.as_py()
            if len(at) and at[-1] >= len(total):
                total = np.concatenate([total, np.zeros(int(at[-1]) + 1 - len(total), np.int64)])
            total[at] += n
    found = np.flatnonzero(total)
    yield _batch([_sparse(block, found, total[found])])


_added.__annotations__ = {"batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}


def _summed(parts: DataFrame) -> DataFrame:
    """One row a block; first over some of the tasks, then over all, a batch at a time."""
    salted = parts.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    return salted.groupBy("block", "salt").applyInArrow(_added, SPARSE).groupBy("block").applyInArrow(_added, SPARSE)


def _table(rows: list, block: int, size: int) -> np.ndarray:
    out = np.zeros(size, np.int64)
    for r in rows:
        if r["block"] == block:
            cells, counts = _read_sparse(r["cells"], r["counts"])
            out[cells] += counts
    return out


# --- exchange ---------------------------------------------------------------------------


def _core_bigrams(core: int):
    """Bigrams of units: 0 the end, 1 to ``core`` the most frequent words, then all others; a block a unit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = core + 2
        table = np.zeros(units * units, np.int64)
        for batch in slices(batches, "codes", 8 << 20):
            codes, offsets = _values_of(batch.column(0), "<i4")
            seq, _, _ = _with_ends(np.where((codes >= 0) & (codes < core), codes + 1, core + 1), offsets)
            table += np.bincount(np.concatenate([[0], seq[:-1]]) * units + seq, minlength=units * units)
        table = table.reshape(units, units)
        rows = [_sparse(int(u), cells, table[u][cells]) for u in np.flatnonzero(table.any(axis=1)) for cells in [np.flatnonzero(table[u])]]
        if rows:
            yield _batch(rows)

    return run


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def exchange(bigrams: np.ndarray, classes: int = CLASSES, rest: bool = False) -> np.ndarray:
    """The class of each unit, exchanged one at a time until no move gains. Unit 0, the end,
    keeps class 0 to itself; with ``rest`` the last unit keeps one more class."""
    b = bigrams.astype(np.float64)
    size = b.sum(axis=0) + b.sum(axis=1)
    free = len(b) - 1 if rest else len(b)
    order = [u for u in np.argsort(-size, kind="stable") if 0 < u < free and size[u] > 0]
    owner = np.zeros(len(b), np.int64)
    owner[1:] = 1 + np.arange(len(b) - 1) % (classes - 1)
    for i, u in enumerate(order):
        owner[u] = 1 + i % (classes - 1)
    if rest:
        owner[-1] = classes
    every = np.arange(classes + rest)
    hot = np.zeros((len(b), len(every)))
    hot[np.arange(len(b)), owner] = 1
    right, left = b @ hot, b.T @ hot  # of each unit: its followers' and its predecessors' classes
    n = hot.T @ right
    moved = 1
    while moved:
        moved = 0
        for u in order:
            a, own = owner[u], b[u, u]
            r, l = right[u].copy(), left[u].copy()
            r[a] -= own
            l[a] -= own
            n[a, :] -= r
            n[:, a] -= l
            n[a, a] -= own
            cell = n[every, every]
            some_r, some_l = np.flatnonzero(r), np.flatnonzero(l)
            x, y = n[:, some_r], n.T[:, some_l]
            gain = (_f(x + r[some_r]) - _f(x)).sum(axis=1) + (_f(y + l[some_l]) - _f(y)).sum(axis=1)
            gain += _f(cell + r + l + own) + _f(cell) - _f(cell + r) - _f(cell + l)
            out, into = n.sum(axis=1) + l, n.sum(axis=0) + r  # what leads to and from u counts wherever u goes
            gain -= _f(out + r.sum() + own) - _f(out) + _f(into + l.sum() + own) - _f(into)
            gain[0] = gain[classes:] = -np.inf
            best = int(gain.argmax())
            if gain[best] <= gain[a] + 1e-6:
                best = int(a)
            n[best, :] += r
            n[:, best] += l
            n[best, best] += own
            if best != a:
                owner[u] = best
                right[:, a] -= b[:, u]
                right[:, best] += b[:, u]
                left[:, a] -= b[u, :]
                left[:, best] += b[u, :]
                moved += 1
    return owner


def best_classes(word: np.ndarray, key: np.ndarray, count: np.ndarray, own: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The class of most gain of each word, against class bigrams ``n`` (STATES x STATES).

    (word, key, count) in order of word, all words from 0: how often a word stands after
    state ``key``, or before state ``key - STATES``. ``own``: the classes that the words
    are counted in, or -1.
    """
    out, into = n.sum(axis=1)[:CLASSES].astype(float), n.sum(axis=0)[:CLASSES].astype(float)
    table = np.concatenate([n[:, :CLASSES], n[:CLASSES, :].T]).astype(float)  # of each key: the bigrams with each class
    best = own.copy()
    edges = np.searchsorted(word, np.arange(len(own) + 1))
    at = 0
    while at < len(own):
        end = max(at + 1, int(np.searchsorted(edges, edges[at] + 50_000)) - 1)
        a, b = edges[at], edges[end]
        r, k, w = count[a:b, None].astype(float), key[a:b], word[a:b] - at
        x = table[k]
        d = _f(x + r) - _f(x)
        mine = own[at:end]
        there = np.flatnonzero(mine[w] >= 0)
        if len(there):
            c = mine[w[there]]
            d[there, c] = _f(x[there, c]) - _f(np.maximum(x[there, c] - r[there, 0], 0))
        starts = edges[at:end] - a
        gain = np.add.reduceat(d, starts)
        after = np.add.reduceat(np.where(k < STATES, r[:, 0], 0), starts)[:, None]  # times as a second word, and as a first
        before = np.add.reduceat(np.where(k < STATES, 0, r[:, 0]), starts)[:, None]
        loss = _f(out + before) - _f(out) + _f(into + after) - _f(into)
        rows = np.flatnonzero(mine >= 0)
        if len(rows):
            c = mine[rows]
            loss[rows, c] = _f(out[c]) - _f(np.maximum(out[c] - before[rows, 0], 0)) + _f(into[c]) - _f(np.maximum(into[c] - after[rows, 0], 0))
        gain -= loss
        gain[:, 0] = -np.inf
        found = gain.argmax(axis=1)
        if len(rows):
            found[rows] = np.where(gain[rows, found[rows]] > gain[rows, mine[rows]] + 1e-6, found[rows], mine[rows])
        best[at:end] = found
        at = end
    return best


def _contexts(shared):
    """Of each frequent word, how often it stands after and before each state, by blocks of words; as block -1 the class bigrams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states = shared.value  # of each word; the last one is that of words beyond
        table = np.zeros(STATES * STATES, np.int64)
        keys, counts, held = [], [], 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            k, back = np.unique(np.concatenate(keys), return_inverse=True)
            return k, np.bincount(back, np.concatenate(counts)).astype(np.int64)

        for batch in slices(batches, "codes", 4 << 20):
            codes, offsets = _values_of(batch.column(0), "<i4")
            seq, place, _ = _with_ends(states[codes], offsets)
            before = np.concatenate([[0], seq[:-1]])
            table += np.bincount(before * STATES + seq, minlength=STATES * STATES)
            known = codes >= 0
            first = codes[known].astype(np.int64) * (2 * STATES)
            after = np.append(seq[1:], 0)[place][known]
            k, n = np.unique(np.concatenate([first + before[place][known], first + STATES + after]), return_counts=True)
            keys.append(k)
            counts.append(n)
            held += len(k)
            if held > 4_000_000:
                k, n = merged()
                keys, counts, held = [k], [n], 0
        found = np.flatnonzero(table)
        if not len(found):
            return
        yield _batch([_sparse(-1, found, table[found])])
        if keys:
            k, n = merged()
            size = BLOCK * 2 * STATES
            for block in np.unique(k // size):
                a, b = np.searchsorted(k, [block * size, (block + 1) * size])
                yield _batch([_sparse(int(block), k[a:b] - block * size, n[a:b])])

    return run


def _moves(shared):
    """(block, words, classes): where the words of each block that may move belong."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner, n, turn = shared.value
        for batch in batches:
            for block, cells, counts in zip(batch.column(0), batch.column(2), batch.column(3), strict=True):
                key, count = _read_sparse(cells.as_py(), counts.as_py())
                word = key // (2 * STATES) + block.as_py() * BLOCK
                may = (owner[word] == TAIL) | (word % 2 == turn)
                ids, word = np.unique(word[may], return_inverse=True)
                if len(ids):
                    own = np.where(owner[ids] == TAIL, -1, owner[ids]).astype(np.int64)
                    yield _batch([_sparse(block.as_py(), ids, best_classes(word, key[may] % (2 * STATES), count[may], own, n))])

    return run


def _likelihood(n: np.ndarray) -> float:
    x = n.astype(np.float64)
    return float(_f(x).sum() - _f(x.sum(axis=0)).sum() - _f(x.sum(axis=1)).sum())


def cluster(train: DataFrame, words: WordMap, core: int = CORE, sweeps: int = SWEEPS) -> np.ndarray:
    """The class of each frequent word, by exchange over the coded rows ``train``."""
    spark = train.sparkSession
    owner = np.full(len(words) + 1, TAIL, np.int8)
    core = min(core, len(words))
    rows = _summed(train.select("codes").mapInArrow(_core_bigrams(core), SPARSE)).collect()
    if not rows or not core:
        return owner
    bigrams = np.array([_table(rows, u, core + 2) for u in range(core + 2)])
    owner[:core] = exchange(bigrams, rest=True)[1 : core + 1]
    last, moved = None, [len(words)]
    for sweep in range(sweeps):
        counts = scratch.save(_summed(train.select("codes").mapInArrow(_contexts(spark.sparkContext.broadcast(owner)), SPARSE)), "lm-contexts")
        n = _table(counts.filter("block = -1").collect(), -1, STATES * STATES).reshape(STATES, STATES)
        now = _likelihood(n)
        if last is not None and sweep > 1 and now <= last[0]:
            return last[1]
        last = (now, owner.copy())
        found = counts.filter("block >= 0").mapInArrow(_moves(spark.sparkContext.broadcast((owner, n, sweep % 2))), SPARSE).collect()
        scratch.discard(counts)
        changed = 0
        for r in found:
            ids, best = _read_sparse(r["cells"], r["counts"])
            changed += int((owner[ids] != best).sum())
            owner[ids] = best
        moved.append(changed)
        if sweep and moved[-1] + moved[-2] < SETTLED * len(words):
            break
    return owner


def _tail_contexts(shared):
    """(h, after, before) of every word beyond the frequent ones; the class bigrams in one row without h."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states = shared.value
        table = np.zeros(STATES * STATES, np.int64)
        for batch in slices(batches, "codes", 4 << 20):
            codes, offsets = _values_of(batch.column(0), "<i4")
            h, _ = _values_of(batch.column(1), "<i8")
            seq, place, _ = _with_ends(states[codes], offsets)
            before = np.concatenate([[0], seq[:-1]])
            table += np.bincount(before * STATES + seq, minlength=STATES * STATES)
            rare = codes < 0
            a, b = before[place][rare].astype(np.int16), np.append(seq[1:], 0)[place][rare].astype(np.int16)
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(a), pa.array(b), pa.nulls(len(h), pa.binary())], names=["h", "a", "b", "cells"])
        if table.any():
            blob = pa.array([table.astype("<i8").tobytes()], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int16()), pa.nulls(1, pa.int16()), blob], names=["h", "a", "b", "cells"])

    return run


def _inserted(n: np.ndarray):
    """(h, n, cls) of some words beyond the frequent ones, and their bigrams (state before, class) in one row without h."""

    def run(table: pa.Table) -> pa.Table:
        h, a, b = (table.column(c).to_numpy() for c in ("h", "a", "b"))
        ids, word = np.unique(h, return_inverse=True)
        pair, count = np.unique(np.concatenate([word * (2 * STATES) + a, word * (2 * STATES) + STATES + b]), return_counts=True)
        cls = best_classes(pair // (2 * STATES), pair % (2 * STATES), count, np.full(len(ids), -1), n)
        into = np.bincount(a.astype(np.int64) * STATES + cls[word], minlength=STATES * STATES)
        return pa.table({
            "h": pa.array([*ids.tolist(), None], pa.int64()),
            "n": pa.array(np.append(np.bincount(word, minlength=len(ids)), 0)),
            "cls": pa.array(np.append(cls, 0).astype(np.int32)),
            "cells": pa.array([None] * len(ids) + [into.astype("<i8").tobytes()], pa.binary()),
        })

    return run


def _sum_of_tables(rows: DataFrame) -> np.ndarray:
    """The sum of the tables in ``cells``, on the executors but for one table a bounded number of parts."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(STATES * STATES, np.int64)
        for batch in batches:
            for x in batch.column(0):
                total += np.frombuffer(x.as_buffer(), "<i8")
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["cells"])

    some = rows.filter("cells IS NOT NULL").select("cells").mapInArrow(add, "cells binary").repartition(SALTS).mapInArrow(add, "cells binary").collect()
    return sum((np.frombuffer(r["cells"], "<i8") for r in some), np.zeros(STATES * STATES, np.int64)).reshape(STATES, STATES)


@dataclass
class ClassModel:
    words: WordMap
    states: np.ndarray  # of each frequent word, then TAIL
    step: np.ndarray  # P(class | state before)
    out_of: np.ndarray  # of each class: what a word's count and the addend are divided by
    open_class: int  # where unseen words fall
    tokens: int
    distinct: int
    ends: int

    @property
    def base(self) -> float:
        """log10 of the base model's denominator."""
        return float(np.log10(self.tokens + ADD * (self.distinct + 1)))

    @property
    def end(self) -> float:
        """log10 of the end's count and the addend."""
        return float(np.log10(self.ends + ADD))

    @cached_property
    def along(self) -> np.ndarray:
        """log10 of a token's probability after a state, but for its count and addend; whole for the end."""
        given = self.step / self.out_of[None, :]
        given[:, 0] = self.step[:, 0] / (self.ends + ADD)  # the end is alone in its class
        x = np.log10((1 - MIX) * given + MIX * 10**-self.base)
        x[:, 0] += self.end
        return x


def fit(train: DataFrame, vocab: Vocabulary, core: int = CORE, sweeps: int = SWEEPS) -> tuple[ClassModel, DataFrame]:
    """The model of the coded rows ``train``, and (h, n, cls) of all words beyond the frequent ones."""
    spark = train.sparkSession
    states = cluster(train, vocab.words, core, sweeps)
    tails = scratch.save(train.select("codes", "tails").mapInArrow(_tail_contexts(spark.sparkContext.broadcast(states)), "h long, a short, b short, cells binary"), "lm-tails")
    n = _sum_of_tables(tails)
    rare = tails.filter("h IS NOT NULL").select("h", "a", "b")
    buckets = max(1, -(-rare.count() // TAIL_ROWS))
    # A word beyond the frequent ones has at most a small share of all rows, so that buckets are even.
    dealt = rare.withColumn("bucket", F.pmod(F.xxhash64("h"), F.lit(buckets))).groupBy("bucket")
    placed = scratch.save(dealt.applyInArrow(_inserted(n), "h long, n long, cls int, cells binary"), "lm-placed")
    scratch.discard(tails)
    tail = placed.filter("h IS NOT NULL").select("h", "n", "cls")

    steps = n[:, :CLASSES] + _sum_of_tables(placed)[:, :CLASSES]
    words = np.bincount(states[:-1], minlength=STATES)[:CLASSES].astype(np.int64)
    for r in tail.groupBy("cls").count().collect():
        words[r["cls"]] += r["count"]
    into, out = steps.sum(axis=0), steps.sum(axis=1)
    share = (into + 0.5) / (into + 0.5).sum()
    pull = np.maximum((steps > 0).sum(axis=1, keepdims=True), 1)
    step = (steps + pull * share[None, :]) / (out[:, None] + pull)
    out_of = into + ADD * (words + 1)
    open_class = 1 + int(words[1:].argmax())
    ends = vocab.ends
    return ClassModel(vocab.words, states, step, out_of, open_class, vocab.tokens + ends, vocab.distinct + (1 if ends else 0), ends), tail


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT, core: int = CORE, sweeps: int = SWEEPS) -> tuple[ClassModel, DataFrame]:
    """The model of ``docs``, and (h, n, cls) of all words beyond the frequent ones."""
    vocab = vocabulary(docs, text_col, frequent)
    return fit(coded(docs, vocab.words, F.lit(False), id_col, text_col), vocab, core, sweeps)


# --- scores -----------------------------------------------------------------------------

SCORED = "h long, s short, uid long, k long, doc_id long, held_out boolean, n_tokens long, n_known long, logs double, path double"


def _scored(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: ClassModel = shared.value
        names = [x.split()[0] for x in SCORED.split(", ")]
        logs_of = np.append(np.log10(model.words.n + ADD), 0.0)
        for batch in slices(batches, "codes", 4 << 20):
            uid = batch.column(0).to_numpy()
            codes, offsets = _values_of(batch.column(3), "<i4")
            h, _ = _values_of(batch.column(4), "<i8")
            docs = batch.num_rows
            if not docs:
                continue
            seq, place, starts = _with_ends(model.states[codes], offsets)
            known = seq < TAIL
            before = np.concatenate([[0], seq[:-1]])
            cls = np.where(known, seq, 0)
            along = np.where(known, model.along[before, cls], 0.0)
            along[place] += logs_of[codes]
            path = np.add.reduceat(along, starts[:-1])
            of = np.repeat(np.arange(docs), np.diff(offsets))
            logs = np.bincount(of, logs_of[codes], minlength=docs)
            seen = np.bincount(of, codes >= 0, minlength=docs).astype(np.int64) + (1 if model.ends else 0)
            keys = np.fromiter((xxhash.xxh64_intdigest(u.to_bytes(8, "little"), 9) for u in uid.tolist()), np.uint64, docs).view(np.int64)
            nothing = np.zeros(docs, np.int64)
            about = [batch.column(1), batch.column(2), pa.array(np.diff(offsets) + 1), pa.array(seen), pa.array(logs + model.end), pa.array(path)]
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.nulls(docs, pa.int16()), pa.array(uid), pa.array(nothing), *about], names=names)
            if len(h):
                rare = codes < 0
                row = np.stack([of[rare], h, before[place][rare]])
                order = np.lexsort(row[::-1])
                row = row[:, order]
                first = np.concatenate([[0], 1 + np.flatnonzero((row[:, 1:] != row[:, :-1]).any(axis=0))])
                k = np.diff(np.append(first, row.shape[1]))
                d, w, s = row[:, first]
                empty = lambda kind: pa.nulls(len(k), kind)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w), pa.array(s.astype(np.int16)), pa.array(uid[d]), pa.array(k), empty(pa.int64()), empty(pa.bool_()), empty(pa.int64()), empty(pa.int64()), empty(pa.float64()), empty(pa.float64())],
                    names=names,
                )

    return run


def score_coded(rows: DataFrame, model: ClassModel, tail: DataFrame) -> DataFrame:
    """Base and class-model log10 probabilities of each coded document."""
    small_batches(rows.sparkSession)
    spark = rows.sparkSession
    parts = rows.mapInArrow(_scored(spark.sparkContext.broadcast(model)), SCORED).join(tail, "h", "left")
    steps = [(s, c, float(model.along[s, c])) for s in range(STATES) for c in range(CLASSES)]
    steps = spark.createDataFrame(steps, "s short, _cls int, along double")  # STATES x CLASSES rows
    cls = F.coalesce("cls", F.lit(model.open_class))
    parts = parts.withColumn("_cls", cls).join(F.broadcast(steps), ["s", "_cls"], "left")
    k, n = F.col("k"), F.coalesce("n", F.lit(0))
    logs = k * F.log10(n + F.lit(ADD))
    total = parts.groupBy("uid").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("held_out").alias("held_out"),
        F.max("n_tokens").alias("n_tokens"),
        (F.sum("n_known") + F.sum(F.when(F.col("n").isNotNull(), k).otherwise(0))).alias("n_known"),
        (F.sum("logs") + F.sum(F.when(F.col("s").isNotNull(), logs).otherwise(0))).alias("logs"),
        (F.sum("path") + F.sum(F.coalesce(k * F.col("along") + logs, F.lit(0.0)))).alias("path"),
    )
    return total.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * F.lit(model.base)).alias("base_score"),
        F.col("path").alias("score"),
    )


def score(docs: DataFrame, model: ClassModel, tail: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base and class-model log10 probabilities of each document's text."""
    return score_coded(coded(docs, model.words, held_out, id_col, text_col), model, tail)


def op9_score_documents(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    fold = F.pmod(id_crc32(F.col("doc_id")), F.lit(10)) == 0
    vocab = vocabulary(docs.filter(~fold))
    rows = coded(docs, vocab.words, fold)
    model, tail = fit(rows.filter("NOT held_out"), vocab)
    return score_coded(rows, model, tail)
