"""Benchmark decontamination by latent semantic retrieval.

1.  The words of all rows are written once as hashed cells; document frequencies are counted on them.
2.  A latent space of ``RANK`` dimensions: a randomised SVD (Gaussian start, one power iteration and
    Nystrom's approximation, each pass over the rows summed across tasks) of TF-IDF passages of
    ``PASSAGE`` words, of which each distinct one counts once, of the whole corpus and the whole
    benchmark. Words that stand in like company lie close together in it.
3.  Every document is folded in as windows of ``WINDOW`` words every ``STEP`` words. A window
    whose cosine with a passage of an item is ``COSINE`` or more is a candidate; as such a
    candidate needs the item's answer, documents without it are passed over before their
    windows are folded. What is rare is lost from a truncated space, so that a residual search
    goes beside it: an inverted index of each passage's rarest words finds every window that
    holds as many of them as equal words need, whatever their latent vectors are.
4.  A candidate is decided on words: the longest common subsequence of the item and the text
    around the window must reach ``SURE`` of the item, or ``LIKELY`` of it together with the
    item's answer. In a latent candidate words of like latent vectors (``SYNONYM``) stand for
    each other. Without an answer column the answer is the rarest quarter of the item's
    distinct words, of which ``ANSWER`` must occur as they are.

Benchmark items are the stated query set; they are taken in blocks of up to ``BLOCK_WORDS``
words, and meet the corpus in one scan a block, without a shuffle.

Defined results
    null text, no words     never a leak; an item without words is not searched
    null id, null item      a row like any other
    items under SHORT words found as a whole run of words alone
    repeated rows           a result row for each
    ties                    of an item's windows in a document the one with the largest share,
                            then cosine, then the first
    very long texts         read whole, a batch at a time
    empty tables            no rows
    clashing names          only the named columns are read
"""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumbre import scratch
from lumbre.llm.words import BROADCAST_ROWS, give_back, slices, small_batches, split_words, text_hash, without_rows

CELL_BITS = 18
CELLS = 1 << CELL_BITS
#: Words of a passage and of a window: every run of PASSAGE words lies in some window.
PASSAGE, PASSAGE_STEP, WINDOW, STEP = 48, 24, 60, 12
RANK, EXTRA = 64, 8
COSINE, SYNONYM, SEEN = 0.4, 0.8, 8
SURE, LIKELY, ANSWER = 0.75, 0.5, 0.8
SHORT = 5
BLOCK_WORDS = 1 << 21
#: Rows of what tasks add up, write and turn at a time.
CHUNK = 1 << 12
#: Sums of cells that are made at a time.
RUNS = 1 << 10
#: Words of a task of the SVD, whose sums take CELLS x (RANK + EXTRA) floats however few the words are; blocks at a time.
TASK_WORDS, PIECE = 1 << 26, 1 << 13
#: Times that a word occurs in passages: above FEW it has a vector, from SEEN on synonyms.
FEW = 2
_EDGES = string.punctuation + "«»„“”‘’…–—¿¡"


def normal_hashes(words: pa.Array) -> np.ndarray:
    """Hash of each word in lower case without punctuation at its ends; 0 where nothing else is left."""
    bare = pc.utf8_trim(words, _EDGES)
    found = np.fromiter(map(xxhash.xxh64_intdigest, map(str.lower, bare.to_numpy(zero_copy_only=False))), np.uint64, len(bare))
    return np.where(pc.binary_length(bare).to_numpy() > 0, np.maximum(found, 1), 0).astype(np.uint64)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first word of each text and the end), words of punctuation alone left out."""
    codes, words, offsets = split_words(texts)
    h = normal_hashes(words)[codes]
    empty = h == 0
    if empty.any():
        offsets = offsets - np.concatenate([[0], np.cumsum(empty)])[offsets]
        h = h[~empty]
    return h, offsets


def cells_of(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def packed_words(docs: DataFrame) -> DataFrame:
    """``docs`` with ``row`` and ``words`` in place of ``text``: the cells of its words, three
    bytes each, and the number of the row's first passage among all."""
    others = [c for c in docs.columns if c != "text"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 33
        for batch in slices(batches, "text"):
            h, offsets = word_hashes(batch.column("text"))
            raw = np.ascontiguousarray(cells_of(h).astype("<i4").view(np.uint8).reshape(-1, 4)[:, :3])
            words = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer((3 * offsets).astype(np.int32)), pa.py_buffer(raw)])
            upto = at + np.cumsum(np.maximum(1, -(-np.diff(offsets) // PASSAGE_STEP)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(np.append([at], upto[:-1])), words], names=[*others, "row", "words"])
            at = int(upto[-1])

    kind = ", ".join([*(f"{c} {docs.schema[c].dataType.simpleString()}" for c in others), "row long", "words binary"])
    return docs.select(*others, "text").mapInArrow(pack, kind)


def unpacked(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(cell of each word, first word of each row and the end) of ``packed_words``."""
    at = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    raw = np.frombuffer(words.buffers()[2] or b"", np.uint8)[at[0] : at[-1]].reshape(-1, 3)
    cells = np.zeros((len(raw), 4), np.uint8)
    cells[:, :3] = raw
    return cells.view("<i4").ravel(), (at - at[0]) // 3


def summed(rows: DataFrame, partial: Callable[[Iterator[pa.RecordBatch]], list[np.ndarray]], features: int) -> DataFrame:
    """(chunk, part) of the sums of the float arrays, of ``features`` rows each, that ``partial``
    makes of each partition of ``rows``, side by side: CHUNK rows of them a row. They are added
    up on the executors and written, as the driver has no need of all of them at once.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = [x.reshape(features, -1) for x in partial(batches)]
        for i in range(0, features, CHUNK):
            part = np.hstack([x[i : i + CHUNK] for x in made]).astype(np.float32)
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([i // CHUNK], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["chunk", "part"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, part in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                more = np.frombuffer(part.as_buffer(), np.float32)
                if chunk in totals:
                    totals[chunk] += more
                else:
                    totals[chunk] = more.copy()
        for chunk, total in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["chunk", "part"])

    kind = "chunk int, part binary"
    return scratch.save(rows.mapInArrow(emit, kind).repartition("chunk").mapInArrow(add, kind), "leak-sums")


def of_chunks(sums: DataFrame, columns: int, make: Callable[[int, np.ndarray], list[np.ndarray]], whole: bool = False) -> Iterator[list[bytes]]:
    """What ``make`` makes of (first row, rows) of each chunk of ``columns`` columns, or the sums
    of it over a task's chunks, as bytes, one chunk or task after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(made: list[np.ndarray]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([[x.tobytes() for x in made]], pa.list_(pa.binary()))], names=["made"])

        total = None
        for batch in batches:
            for chunk, part in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                made = make(chunk * CHUNK, np.frombuffer(part.as_buffer(), np.float32).reshape(-1, columns))
                if not whole:
                    yield row([np.array([chunk * CHUNK]), *made])
                else:
                    total = made if total is None else [x + y for x, y in zip(total, made, strict=True)]
        if total is not None:
            yield row(total)

    return (r["made"] for r in sums.mapInArrow(run, "made array<binary>").toLocalIterator())


def gram(sums: DataFrame, columns: int, make: Callable[[int, np.ndarray], list[np.ndarray]], *shapes: tuple[int, int]) -> list[np.ndarray]:
    """The sums of the matrices of double precision that ``make`` makes of each chunk."""
    total = [np.zeros(shape) for shape in shapes]
    for made in of_chunks(sums, columns, make, whole=True):
        for x, raw in zip(total, made, strict=True):
            x += np.frombuffer(raw, np.float64).reshape(x.shape)
    return total


@dataclass
class Frequencies:
    """Documents, words and documents with a word of each cell, over the whole corpus."""

    documents: int
    words: int
    df: np.ndarray

    @cached_property
    def idf(self) -> np.ndarray:
        return np.log(1 + max(self.documents, 1) / np.maximum(self.df, 1)).astype(np.float32)


def frequencies(docs: DataFrame) -> Frequencies:
    """Counted over all rows of ``docs`` (text)."""
    return counted(packed_words(docs.select("text")))


def counted(words: DataFrame) -> Frequencies:
    """Counted over all rows of ``words``, added up in the JVM; CELLS rows come to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows, words = np.zeros(CELLS, np.int64), 0, 0
        for batch in slices(batches, "words", 1 << 20):
            cells, offsets = unpacked(batch.column("words"))
            pairs = np.repeat(np.arange(batch.num_rows), np.diff(offsets)) << CELL_BITS | cells
            pairs.sort()
            first = np.ones(len(pairs), bool)
            first[1:] = pairs[1:] != pairs[:-1]
            total += np.bincount(pairs[first] & (CELLS - 1), minlength=CELLS)
            rows, words = rows + batch.num_rows, words + len(cells)
        if rows:
            cells = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(cells, [-1, -2])), pa.array(np.append(total[cells], [rows, words]))], names=["cell", "n"])

    found = words.select("words").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    cells, n = found.column("cell").to_numpy(), found.column("n").to_numpy()
    df = np.zeros(CELLS, np.int64)
    df[cells[cells >= 0]] = n[cells >= 0]
    return Frequencies(int(n[cells == -1].sum()), int(n[cells == -2].sum()), df)


def blocks_of(cells: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cells of each block of PASSAGE_STEP words of a text, filled up with CELLS; first block of each text and the end)."""
    n = -(-np.diff(offsets) // PASSAGE_STEP)
    first = np.concatenate([[0], np.cumsum(n)])
    blocks = np.full((int(first[-1]), PASSAGE_STEP), CELLS, np.int32)
    blocks.ravel()[np.arange(len(cells)) + np.repeat(first[:-1] * PASSAGE_STEP - offsets[:-1], np.diff(offsets))] = cells
    return blocks, first


def passages_of(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first block, whether a second one follows) of every passage; passages are two
    blocks that follow each other, or the only one."""
    n = np.diff(first)
    many = np.where(n > 0, np.maximum(1, n - 1), 0)
    text = np.repeat(np.arange(len(n)), many)
    return text, first[:-1][text] + np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many), n[text] > 1


@cache
def cell_keys() -> np.ndarray:
    keys = np.random.default_rng(11).integers(0, 1 << 64, CELLS + 1, np.uint64)
    keys[CELLS] = 0
    return keys


def passage_keys(blocks: np.ndarray, left: np.ndarray, two: np.ndarray) -> np.ndarray:
    """64 bits of the words of each passage, in any order."""
    mix = cell_keys()
    sums = np.append(np.concatenate([mix[blocks[i : i + PIECE]].sum(axis=1) for i in range(0, len(blocks), PIECE)] or [np.zeros(0, np.uint64)]), np.uint64(0))
    return (sums[left] + np.where(two, sums[left + 1], np.uint64(0))).view(np.int64)


def own_passages(words: DataFrame) -> DataFrame:
    """(row, kept) of the rows of ``words`` (row, words) of which some passage also stands in
    another row or twice: which of their passages count. Of equal passages the first one
    counts. Only numbers are shuffled.
    """

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "words", 1 << 20):
            blocks, first = blocks_of(*unpacked(batch.column("words")))
            text, left, two = passages_of(first)
            row = batch.column("row").to_numpy()[text]
            yield pa.RecordBatch.from_arrays([pa.array(passage_keys(blocks, left, two)), pa.array(row), pa.array(row + left - first[text])], names=["key", "row", "id"])

    # Passages are numbered as rows are, so that the least row is the one of the least passage.
    owners = words.mapInArrow(keys, "key long, row long, id long").groupBy("key").agg(F.min("row").alias("row"), F.min("id").alias("id"))
    kept = owners.groupBy("row").agg(F.collect_list((F.col("id") - F.col("row")).cast("int")).alias("kept"))
    blocks = F.ceil(F.length("words") / (3 * PASSAGE_STEP))
    whole = words.select("row", F.when(blocks > 1, blocks - 1).otherwise(blocks).alias("n"))
    cut = whole.join(kept, "row", "left").filter("n > coalesce(size(kept), 0)")
    return scratch.save(cut.select("row", F.coalesce("kept", F.array().cast("array<int>")).alias("kept")), "leak-passages", compact=True)


def scatter_add(total: np.ndarray, cells: np.ndarray, block: np.ndarray, values: np.ndarray) -> None:
    """total[cells] += values[block], with cells that come often. Runs of a cell are added up
    first, all their first rows at once and so on, and long ones on their own."""
    code = cells.astype(np.int64) << 32 | block
    code.sort()
    cells, block = code >> 32, code & 0xFFFFFFFF
    starts = np.flatnonzero(np.diff(cells, prepend=-1))
    size = np.diff(np.append(starts, len(cells)))
    order = np.argsort(-size, kind="stable")
    starts, size = starts[order], size[order]
    for at in range(0, len(starts), RUNS):  # few enough at a time for a core's cache
        first, n = starts[at : at + RUNS], size[at : at + RUNS]
        sums = values.take(block[first], axis=0)
        for k in range(1, 16):
            longer = int(np.searchsorted(-n, -k, side="left"))
            if not longer:
                break
            sums[:longer] += values.take(block[first[:longer] + k], axis=0)
        for i in range(int(np.searchsorted(-n, -16, side="left"))):
            sums[i] += values.take(block[first[i] + 16 : first[i] + n[i]], axis=0).sum(axis=0)
        total[cells[first]] += sums


def listed_rows(batches: Iterator[pa.RecordBatch], basis: np.ndarray) -> list[np.ndarray]:
    """A'A ``basis`` and how often each feature occurs, of the sparse rows A (cells array, weights array)."""
    total, seen = np.zeros(basis.shape, np.float32), np.zeros(len(basis), np.float32)
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            cells, weights = batch.column(0).slice(at, 1000), batch.column(1).slice(at, 1000)
            offsets = cells.offsets.to_numpy()
            full = offsets[:-1][np.diff(offsets) > 0] - offsets[0]
            if len(full):
                cells, weights = cells.flatten().to_numpy(), weights.flatten().to_numpy().astype(np.float32)
                y = np.add.reduceat(weights[:, None] * basis[cells], full)
                back = weights[:, None] * np.repeat(y, np.diff(np.append(full, len(cells))), axis=0)
                scatter_add(total, cells, np.arange(len(cells)), back)
                seen += np.bincount(cells, minlength=len(seen))
    return [total, seen]


def passage_rows(idf: np.ndarray):
    """As ``listed_rows``, of the TF-IDF passages, of length one, of rows (words, kept)."""
    square = np.append(idf, np.float32(0)) ** 2

    def product(batches: Iterator[pa.RecordBatch], basis: np.ndarray) -> list[np.ndarray]:
        width = basis.shape[1]
        table, total, seen = np.zeros((CELLS + 1, width), np.float32), np.zeros((CELLS + 1, width), np.float32), np.zeros(CELLS + 1)
        np.multiply(basis, idf[:, None], out=table[:-1])
        del basis
        place = np.arange(2 * PASSAGE_STEP, dtype=np.int32)
        for batch in slices(batches, "words", 3 * PASSAGE_STEP * PIECE):
            blocks, first = blocks_of(*unpacked(batch.column("words")))
            text, left, two = passages_of(first)
            keep = np.ones(len(text), np.float32)
            listed = batch.column("kept").is_valid().to_numpy(zero_copy_only=False)
            if listed.any():
                ends = np.searchsorted(text, np.arange(batch.num_rows + 1))
                for d in np.flatnonzero(listed).tolist():
                    keep[ends[d] : ends[d + 1]] = 0
                    keep[ends[d] + batch.column("kept")[d].values.to_numpy()] = 1
            for at in range(0, len(left), PIECE):
                some, second = left[at : at + PIECE], two[at : at + PIECE]
                low = int(some[0])
                part = blocks[low : int(some[-1]) + 2]
                a, b = some - low, np.where(second, some - low + 1, len(part))
                both = np.vstack([part, np.full((1, PASSAGE_STEP), CELLS, np.int32)])
                both = np.concatenate([both[a], both[b]], axis=1)
                both.sort(axis=1)
                new = np.ones(both.shape, bool)
                new[:, 1:] = both[:, 1:] != both[:, :-1]
                run = place - np.maximum.accumulate(np.where(new, place, 0), axis=1)
                norm = np.einsum("ij,ij->i", (2 * run + 1).astype(np.float32), square[both])  # sum of (n idf)^2
                weight = keep[at : at + PIECE] / np.maximum(norm, 1e-12)
                folded = np.zeros((len(part) + 1, width), np.float32)
                for i in range(0, len(part), 64):
                    folded[i : min(i + 64, len(part))] = table.take(part[i : i + 64].ravel(), axis=0).reshape(-1, PASSAGE_STEP, width).sum(axis=1)
                y = (folded[a] + folded[b]) * weight[:, None]
                back, times = np.zeros((len(part) + 1, width), np.float32), np.zeros(len(part) + 1)
                back[a] = y
                back[b[second]] += y[second]
                times[a] = keep[at : at + PIECE]
                times[b[second]] += keep[at : at + PIECE][second]
                cells, block = part.ravel(), np.repeat(np.arange(len(part)), PASSAGE_STEP)
                scatter_add(total, cells, block, back)
                seen += np.bincount(cells, times[block], CELLS + 1)
        total[:-1] *= idf[:, None]
        return [total[:-1], seen[:-1]]

    return product


def turned(x: np.ndarray, *turns: np.ndarray) -> np.ndarray:
    """``x`` times one turn after the other, in single precision each time."""
    for turn in turns:
        x = (x.astype(np.float64) @ turn).astype(np.float32)
    return x


def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``x.T @ y`` in double precision."""
    return x.astype(np.float64).T @ y.astype(np.float64)


def roots(gram: np.ndarray, least: float) -> np.ndarray:
    """A turn that makes columns of this Gram matrix orthonormal, without those below ``least`` of the largest."""
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    some = values > least * max(values.max(), 1e-30)
    return vectors[:, some] / np.sqrt(values[some])


def randomised_svd(rows: DataFrame, features: int, rank: int, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """(right singular vectors (features x rank), singular values) of the sparse rows (cells array, weights array)."""
    z, turn, values, _ = latent_vectors(rows, features, rank, listed_rows, seed)
    v = np.zeros((features, len(values)), np.float32)
    for at, part in of_chunks(z, len(turn), lambda at, x: [turned(x, turn)]):
        at, part = int(np.frombuffer(at, np.int64)[0]), np.frombuffer(part, np.float32).reshape(-1, len(values))
        v[at : at + len(part)] = part
    return v, values


def latent_vectors(rows: DataFrame, features: int, rank: int, product, seed: int = 3) -> tuple[DataFrame, np.ndarray, np.ndarray, np.ndarray]:
    """(chunks of an array, what turns it into the right singular vectors, singular values,
    occurrences of each feature) of the rows A that ``product`` takes A'A times a basis of: once
    for a Gaussian basis, once for what that gives. The arrays stay with the executors; the
    driver holds products of their columns and, to send it out, one in half precision.
    """
    width = min(features, rank + EXTRA)

    def start(batches: Iterator[pa.RecordBatch]) -> list[np.ndarray]:
        return product(batches, np.random.default_rng(seed).standard_normal((features, width), np.float32))

    sums, turns = summed(rows, start, features), []
    for _ in range(2):  # the second time for what rounding left
        done = tuple(turns)
        (square,) = gram(sums, width + 1, lambda _, x: [products(y := turned(x[:, :-1], *done), y)], (turns[-1].shape[1],) * 2 if turns else (width, width))
        turns.append(roots(square, 1e-12))
    # Any basis near this one will do, but both uses of it must be of the same.
    done, unit = tuple(turns), np.float32(np.sqrt(features))
    half, seen = np.zeros((features, turns[-1].shape[1]), np.float16), np.zeros(features, np.float32)
    for at, part, often in of_chunks(sums, width + 1, lambda _, x: [(turned(x[:, :-1], *done) * unit).astype(np.float16), x[:, -1]]):
        at, often = int(np.frombuffer(at, np.int64)[0]), np.frombuffer(often, np.float32)
        half[at : at + len(often)] = np.frombuffer(part, np.float16).reshape(len(often), -1)
        seen[at : at + len(often)] = often
    scratch.discard(sums)
    kept = half.shape[1]
    shared = rows.sparkSession.sparkContext.broadcast(half)
    del half

    def again(batches: Iterator[pa.RecordBatch]) -> list[np.ndarray]:
        return product(batches, shared.value.astype(np.float32))[:1]

    z = summed(rows, again, features)
    both, square = gram(z, kept, lambda at, x: [products(shared.value[at : at + len(x)], x), products(x, x)], (kept, kept), (kept, kept))
    shared.destroy()
    root = roots(both, 1e-6)  # A'A is near z (half' z)^-1 z'
    values, turn = np.linalg.eigh(root.T @ square @ root)
    best = np.argsort(-values)[: min(rank, width)]
    best = best[values[best] > 1e-6 * max(values.max(initial=0), 1e-30)]
    return z, root @ turn[:, best] / np.sqrt(values[best]), np.sqrt(values[best]), seen


@dataclass
class LatentSpace:
    """Of each cell: its row of ``vectors`` (the latent vector times the weight, by the roots of
    the singular values, so that the first dimensions do not drown the others; in any unit, so that
    half precision holds them) or -1, the last row, which is zero; and whether it is seen often
    enough to have synonyms."""

    row: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    often: np.ndarray

    def fold(self, cells: np.ndarray) -> np.ndarray:
        return self.vectors[self.row[cells]].sum(axis=0, dtype=np.float32)

    def meanings(self, cells: np.ndarray) -> np.ndarray:
        """Unit vectors of words, by what they stand with."""
        x = self.vectors[self.row[cells]] * self.values**1.5
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def latent_space(words: DataFrame, freq: Frequencies, rank: int = RANK) -> LatentSpace:
    """Fit on all rows of ``words`` (row, words), those of the corpus and of the benchmark."""
    own = own_passages(words)
    if own.count() <= BROADCAST_ROWS:  # sent out only if it is few by count; the words are many times as much
        own = F.broadcast(own)
    rows = words.join(own, "row", "left").select("words", "kept")
    # Each task sends sums of all cells, so that tasks are as many as their words make worth it.
    idf = freq.idf
    z, turn, values, seen = latent_vectors(rows.coalesce(1 + freq.words // TASK_WORDS), CELLS, rank, passage_rows(idf))
    used = np.flatnonzero(seen > FEW) if len(values) else np.zeros(0, np.int64)
    row = np.full(CELLS, -1, np.int32)
    row[used] = np.arange(len(used))
    if not len(used):
        return LatentSpace(row, np.zeros((1, 1), np.float32), np.ones(1, np.float32), np.zeros(1, bool))
    columns, values = len(turn), values.astype(np.float32)

    def weighted(at: int, x: np.ndarray) -> np.ndarray:
        return turned(x, turn) * idf[at : at + len(x), None] / np.sqrt(values)

    largest = max(float(np.frombuffer(x, np.float32)[0]) for _, x in of_chunks(z, columns, lambda at, x: [np.abs(weighted(at, x)).max(keepdims=True)]))
    unit, kept = np.float32(2.0**14 / largest), row >= 0
    vectors = np.zeros((len(used) + 1, len(values)), np.float16)
    for at, part in of_chunks(z, columns, lambda at, x: [(weighted(at, x) * unit)[kept[at : at + len(x)]].astype(np.float16)]):
        part, first = np.frombuffer(part, np.float16).reshape(-1, len(values)), int(np.searchsorted(used, np.frombuffer(at, np.int64)[0]))
        vectors[first : first + len(part)] = part
    scratch.discard(z)
    return LatentSpace(row, vectors, values, np.append(seen[used] >= SEEN, False))


@dataclass
class Item:
    item_id: object
    words: np.ndarray
    answer: frozenset[int]

    @cached_property
    def masks(self) -> dict[int, int]:
        out: dict[int, int] = {}
        for i, x in enumerate(self.words.tolist()):
            out[x] = out.get(x, 0) | 1 << i
        return out


@dataclass
class Index:
    """A block of items: their passages in latent space, their rare words, the short ones."""

    items: list[Item]
    space: LatentSpace
    passages: np.ndarray  # unit latent vectors
    owner: np.ndarray  # of each passage: its item
    #: Inverted index of groups of rare words: of each cell the first and the end of its groups.
    starts: np.ndarray
    groups: np.ndarray
    need: np.ndarray  # of each group: how many of its words a window must hold
    group_owner: np.ndarray
    is_answer: np.ndarray  # of each group: whether it is an item's whole answer
    short: dict[int, tuple[np.ndarray, np.ndarray]]  # by number of words: run hashes in order, items
    cosine: float


def run_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """A hash of every run of ``n`` words."""
    x = np.zeros(max(0, len(h) - n + 1), np.uint64)
    for i in range(n):
        x = (x ^ h[i : i + len(x)]) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
    return x


def build_index(items: list[tuple[object, np.ndarray, frozenset[int] | None]], freq: Frequencies, space: LatentSpace, cosine: float = COSINE) -> Index:
    """The index of a block of items (id, word hashes, answer).

    Groups of a passage of n distinct words. What ``decide`` takes with SURE lacks at most
    n - SURE n of them, so it has all but so many of the rarest half. What it takes with
    LIKELY has, in some passage, ANSWER of the passage's words of an implicit answer, and
    with an answer of its own all but n - LIKELY n of the rarest three quarters.
    """
    kept, vectors, owner, postings, need, group_owner, is_answer = [], [], [], [], [], [], []
    short: dict[int, list[tuple[int, int]]] = {}
    for item_id, h, said in items:
        k = len(kept)
        distinct = np.unique(h)
        rare = distinct[np.argsort(-freq.idf[cells_of(distinct)], kind="stable")]
        answer = frozenset(int(x) for x in rare[: max(3, len(rare) // 4)]) if said is None else said
        kept.append(Item(item_id, h, answer))
        if len(h) < SHORT:
            short.setdefault(len(h), []).append((int(run_hashes(h, len(h))[0]), k))
            continue

        def group(words: np.ndarray, least: int, whole: bool = False) -> None:
            cells = np.unique(cells_of(words))
            least -= len(words) - len(cells)  # words that share a cell count once
            if len(cells):
                postings.extend((int(c), len(need)) for c in cells)
                need.append(max(1, least))
                group_owner.append(k)
                is_answer.append(whole)

        group(np.array(sorted(answer), np.uint64), int(np.ceil(ANSWER * len(answer))), True)
        for at in range(0, max(1, len(h) - PASSAGE_STEP) if len(h) > PASSAGE else 1, PASSAGE_STEP):
            part = h[at : at + PASSAGE]
            vector = space.fold(cells_of(part))
            if (norm := float(np.linalg.norm(vector))) > 1e-6:
                vectors.append(vector / norm)
                owner.append(k)
            own, copies = np.unique(part, return_counts=True)
            order = np.argsort(-freq.idf[cells_of(own)], kind="stable")
            own, lacking = own[order], int((1 - SURE) * len(part))
            m = max(min(len(own), lacking + 1), (len(own) + 1) // 2)
            group(own[:m], m - lacking)
            if said is None:
                there = np.array([x for x in own.tolist() if x in answer], np.uint64)
                group(there, int(np.ceil(ANSWER * len(there))))
            else:
                lacking = int((1 - LIKELY) * len(part))
                m = max(min(len(own), lacking + 1), (3 * len(own) + 3) // 4)
                group(own[:m], m - lacking)
    postings.sort()
    cells = np.array([c for c, _ in postings], np.int64)
    return Index(
        kept,
        space,
        np.array(vectors, np.float32).reshape(len(vectors), space.vectors.shape[1]),
        np.array(owner, np.int64),
        np.searchsorted(cells, np.arange(CELLS + 1)).astype(np.int32),
        np.array([g for _, g in postings], np.int64),
        np.array(need, np.int64),
        np.array(group_owner, np.int64),
        np.array(is_answer, bool),
        {n: tuple(np.array(x) for x in zip(*sorted(runs), strict=True)) for n, runs in short.items()},
        cosine,
    )


def common_subsequence(masks: dict[int, int], length: int, words: np.ndarray) -> int:
    """Length of the longest common subsequence, one big-integer step a word."""
    return _steps((masks.get(w, 0) for w in words.tolist()), length)


def _steps(masks: Iterator[int], length: int) -> int:
    full = (1 << length) - 1
    v = full
    for m in masks:
        if m:
            u = v & m
            v = (v + u | v - u) & full
    return length - v.bit_count()


def like_subsequence(space: LatentSpace, item: Item, region: np.ndarray) -> int:
    """As ``common_subsequence``, with words that are equal or of like latent vectors."""
    a, b = cells_of(item.words), cells_of(region)
    known = space.often[space.row[a]][:, None] & space.often[space.row[b]][None, :]
    like = (space.meanings(a) @ space.meanings(b).T >= SYNONYM) & known | (item.words[:, None] == region[None, :])
    packed = np.packbits(like, axis=0, bitorder="little").T
    return _steps((int.from_bytes(x.tobytes(), "little") for x in packed), len(item.words))


def decide(item: Item, region: np.ndarray, space: LatentSpace | None = None) -> tuple[bool, float, bool]:
    """(leak, share of the item in common order, answer found) of the text around a window.

    With a space, words of like vectors may stand for each other beside the answer.
    """
    size = len(item.words)
    share = common_subsequence(item.masks, size, region) / size
    if share >= SURE:
        return True, share, len(item.answer & set(region.tolist())) >= ANSWER * len(item.answer)
    if share < LIKELY and space is None:
        return False, share, False
    found = len(item.answer & set(region.tolist())) >= ANSWER * len(item.answer)
    if found and share < LIKELY:
        share = like_subsequence(space, item, region) / size
    return share >= LIKELY and found, share, found


def windows(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, first word) of every window."""
    blocks = -(-np.diff(offsets) // STEP)
    of = np.repeat(np.arange(len(blocks)), blocks)
    return of, offsets[:-1][of] + (np.arange(len(of)) - np.repeat(np.cumsum(blocks) - blocks, blocks)) * STEP


def latent_candidates(index: Index, cells: np.ndarray, offsets: np.ndarray, doc: int, items: np.ndarray) -> Iterator[tuple[int, int, float]]:
    """(first word, item, cosine) of a document's windows that lie near a passage of one of ``items``."""
    mine = np.flatnonzero(np.isin(index.owner, items))
    if not len(mine):
        return
    vectors, row, span = index.space.vectors, index.space.row, WINDOW // STEP
    a, b = int(offsets[doc]), int(offsets[doc + 1])
    for at in range(a, b, STEP << 12):
        rows = row[cells[at : min(b, at + (STEP << 12) + WINDOW - STEP)]]
        single = np.add.reduceat(vectors[rows].astype(np.float32), np.arange(0, len(rows), STEP))
        folded = single[: 1 << 12].copy()
        for k in range(1, span):
            more = single[k : k + len(folded)]
            folded[: len(more)] += more
        folded /= np.maximum(np.linalg.norm(folded, axis=1, keepdims=True), 1e-9)
        cosines = folded @ index.passages[mine].T
        for w, p in zip(*np.nonzero(cosines >= index.cosine), strict=True):
            yield at + STEP * int(w), int(index.owner[mine[p]]), float(cosines[w, p])


def indexed_candidates(index: Index, cells: np.ndarray, of: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(window, item) of the windows that hold as many of a group's words as it needs, and
    (document, item) of the documents that hold an item's answer."""
    none = np.zeros(0, np.int64)
    a, n = index.starts[cells], index.starts[cells + 1] - index.starts[cells]
    hit = np.flatnonzero(n)
    if not len(hit):
        return none, none, none, none
    a, n, groups = a[hit].astype(np.int64), n[hit].astype(np.int64), len(index.need)
    group = index.groups[np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum())]
    block = np.repeat(np.searchsorted(first, hit, side="right") - 1, n)
    # Groups that a whole document does not hold often enough fall out first.
    whole, back, count = np.unique(of[block] * groups + group, return_inverse=True, return_counts=True)
    enough = count >= index.need[whole % groups]
    answered = whole[enough & index.is_answer[whole % groups]]
    some = enough[back] & ~index.is_answer[group]
    block, group = block[some], group[some]
    span = WINDOW // STEP
    window = (block[:, None] - np.arange(span)[None, :]).ravel()
    inside = (window >= 0) & (of[np.maximum(window, 0)] == np.repeat(of[block], span))
    pair, count = np.unique((window * groups + np.repeat(group, span))[inside], return_counts=True)
    pair = pair[count >= index.need[pair % groups]]
    return pair // groups, index.group_owner[pair % groups], answered // groups, index.group_owner[answered % groups]


LEAKS = "doc_id long, item_id long, cosine double, lcs_share double, answer_found boolean, word_start long, text_hash long"


def _search(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = shared.value
        for batch in slices(batches, "text", 2 << 20):
            h, offsets = word_hashes(batch.column(2))
            cells, best = cells_of(h), {}
            of, first = windows(offsets)

            def consider(doc: int, at: int, k: int, space: LatentSpace | None, cosine: float | None) -> None:
                item = index.items[k]
                around = len(item.words)
                region = h[max(offsets[doc], at - around) : min(offsets[doc + 1], at + WINDOW + around)]
                leak, share, found = decide(item, region, space)
                if not leak or ((doc, k) in best and best[doc, k][1] > share):
                    return
                if cosine is None:
                    own, want = (index.space.fold(cells_of(x)) for x in (h[at : min(at + WINDOW, offsets[doc + 1])], item.words))
                    cosine = float(own @ want / max(np.linalg.norm(own) * np.linalg.norm(want), 1e-9))
                mark = (cosine, share, found, at - int(offsets[doc]))
                if (doc, k) not in best or (share, cosine, -mark[3]) > (best[doc, k][1], best[doc, k][0], -best[doc, k][3]):
                    best[doc, k] = mark

            window, held, answered, asked = indexed_candidates(index, cells, of, first)
            for w, k in zip(window.tolist(), held.tolist(), strict=True):
                consider(int(of[w]), int(first[w]), k, None, None)
            for doc in np.unique(answered).tolist():
                for at, k, cosine in latent_candidates(index, cells, offsets, doc, asked[answered == doc]):
                    consider(doc, at, k, index.space, cosine)
            for n, (runs, items) in index.short.items():
                x = run_hashes(h, n)
                whole = np.searchsorted(offsets, np.arange(len(x)), side="right") - 1
                for at in np.flatnonzero(np.isin(x, runs)).tolist():
                    doc = int(whole[at])
                    if at + n <= offsets[doc + 1]:
                        for k in items[np.searchsorted(runs, x[at]) : np.searchsorted(runs, x[at], side="right")].tolist():
                            best.setdefault((doc, k), (1.0, 1.0, True, at - int(offsets[doc])))
            if best:
                rows = pa.array([d for d, _ in best])
                columns = list(zip(*best.values(), strict=True))
                made = [pa.array(c, t) for c, t in zip(columns, (pa.float64(), pa.float64(), pa.bool_(), pa.int64()), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), pa.array([index.items[k].item_id for _, k in best], pa.int64()), *made, batch.column(1).take(rows)],
                    names=[x.split()[0] for x in LEAKS.split(", ")],
                )

    return run


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    answer_col: str | None = None,
    cosine: float = COSINE,
) -> DataFrame:
    """(doc_id, item_id, cosine, lcs_share, answer_found, word_start, text_hash) of every document that holds an item."""
    spark = docs.sparkSession
    small_batches(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_hash(F.col(text_col)).alias("text_hash"), text.alias("text"))
    answer = F.col(answer_col) if answer_col else F.lit(None).cast("string")
    asked = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text"), answer.alias("answer")).filter("text IS NOT NULL")
    upto = F.sum(F.regexp_count("text", F.lit(r"\S+"))).over(Window.orderBy("item_id", "text").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    asked = scratch.save(asked.withColumn("block", F.floor(upto / BLOCK_WORDS)), "leak-items")
    texts = rows.select("text", F.lit(False).alias("item")).unionByName(asked.select("text", F.lit(True).alias("item")))
    words = scratch.save(packed_words(texts), "leak-words")
    freq, found = counted(words.filter("NOT item")), None
    space = latent_space(words, freq)
    scratch.discard(words)
    give_back()  # the driver's too, which a pipeline shares with other stages
    for (block,) in asked.select("block").distinct().orderBy("block").collect():
        taken = asked.filter(F.col("block") == block).orderBy("item_id", "text").collect()
        h, offsets = word_hashes(pa.array([r["text"] for r in taken], pa.string()))
        items = []
        for r, a, b in zip(taken, offsets[:-1], offsets[1:], strict=True):
            if b > a:
                said = frozenset(int(x) for x in word_hashes(pa.array([r["answer"]]))[0]) if r["answer"] else None
                items.append((r["item_id"], h[a:b], said or None))
        if items:
            shared = spark.sparkContext.broadcast(build_index(items, freq, space, cosine))
            leaks = rows.mapInArrow(_search(shared), LEAKS)
            found = leaks if found is None else found.union(leaks)
    return found if found is not None else spark.createDataFrame([], LEAKS)


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kwargs) -> DataFrame:
    """The rows of ``docs`` that hold no item; rows are told apart by id and text."""
    return without_rows(docs, find_leaks(docs, benchmark, id_col, text_col, **kwargs), id_col, text_col)


def op2_find_leaks(spark, sf_dir: str) -> DataFrame:
    return find_leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
