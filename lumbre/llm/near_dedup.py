"""Near-duplicate documents by MinHash, odd sketches and exact sets.

1.  One pass over the texts: each document's set of 5-word shingles as 64-bit hashes,
    its digest, ``HASHES`` MinHash values, their band keys and their odd sketch (the
    parity of MinHash samples hashed into ``SKETCH_BITS`` bits).
2.  Documents of equal sets are one node, known by a number.
3.  Nodes that share a band key are candidates. Each is first held against the smallest
    node of its bucket: a star, not all pairs. A pair goes on if the sizes allow 0.75 and
    the population count of the XOR of the sketches does not rule it out, and is then
    decided on the full sets.
4.  Buckets whose nodes are not one component by then are taken whole: in one task a
    bucket, or in pairs of blocks where it is large, the remaining pairs are sifted by
    sketch, decided on the full sets, and only links that join components come out.

A pair of similarity 0.75 shares none of the 32 bands of 4 rows with probability 5e-6,
and a sketch rules it out with probability below 1e-6.

Defined results
    null text, no words   an empty set: linked with nothing, its own component
    fewer than 5 words    the whole sequence is the one shingle
    null id               larger than every id; a component of null ids alone has a null
                          component_id, and is kept
    repeated ids          rows with equal texts are one group; rows that repeat the
                          component's id are all kept
    very long texts       whole sets; memory holds one batch and one block of sets
    empty table           no rows
    clashing names        only the id and text columns are read
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbre import scratch
from lumbre.components import connected_components
from lumbre.llm.words import BROADCAST_ROWS, small_batches, slices, split_words, text_hash, without_rows

WORDS = 5
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
SKETCH_BITS = 512
#: Most differing bits of two sketches whose estimate is 0.5 or more.
MOST_BITS = int(SKETCH_BITS / 2 * (1 - np.exp(-4 * HASHES * 0.5 / SKETCH_BITS)))
BLOCK = 2048

_rng = np.random.default_rng(20240607)
_A = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes of each text in ascending order, first of each text and the end)."""
    codes, words, offsets = split_words(texts)
    h = np.fromiter((xxhash.xxh64_intdigest(w.as_buffer()) for w in words), np.uint64, len(words))[codes]
    n = np.diff(offsets)
    docs = len(n)
    parts, owner = [], []
    if len(h) >= WORDS:
        x = np.zeros(len(h) - WORDS + 1, np.uint64)
        for i in range(WORDS):
            x = _mix(x + h[i : len(h) - WORDS + 1 + i])
        of = np.repeat(np.arange(docs), n)
        whole = of[: len(x)] == of[WORDS - 1 :]
        parts.append(x[whole])
        owner.append(of[: len(x)][whole])
    for d in np.flatnonzero((n > 0) & (n < WORDS)):
        x = np.zeros(1, np.uint64)
        for w in h[offsets[d] : offsets[d + 1]]:
            x = _mix(x + w)
        parts.append(_mix(x + np.uint64(n[d])))
        owner.append(np.array([d]))
    x, of = (np.concatenate(parts), np.concatenate(owner)) if parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    order = np.lexsort((x, of))
    x, of = x[order], of[order]
    if len(x):
        first = np.concatenate([[True], (x[1:] != x[:-1]) | (of[1:] != of[:-1])])
        x, of = x[first], of[first]
    return x, np.searchsorted(of, np.arange(docs + 1))


def digests(x: np.ndarray, starts: np.ndarray) -> list[bytes | None]:
    """128 bits of each set; None for empty sets."""
    return [xxhash.xxh3_128_digest(x[a:b].tobytes()) if b > a else None for a, b in zip(starts[:-1], starts[1:], strict=True)]


def min_hashes(x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """MinHash values, one row per non-empty set."""
    full = starts[:-1][np.diff(starts) > 0]
    out = np.zeros((len(full), HASHES), np.uint64)
    if len(full):
        for k in range(HASHES):
            out[:, k] = np.minimum.reduceat(x * _A[k] + _B[k], full)
    return out


def band_keys(values: np.ndarray) -> np.ndarray:
    keys = np.zeros((len(values), BANDS), np.uint64)
    for j in range(BANDS):
        x = np.full(len(values), j, np.uint64)
        for i in range(ROWS):
            x = _mix(x + values[:, j * ROWS + i])
        keys[:, j] = x
    return keys.view(np.int64)


def odd_sketches(values: np.ndarray) -> np.ndarray:
    """Parity bitmaps as rows of 64-bit words."""
    out = np.zeros((len(values), SKETCH_BITS // 64), np.uint64)
    rows = np.arange(len(values))
    for k in range(HASHES):
        bit = _mix(values[:, k] + np.uint64(k)) % np.uint64(SKETCH_BITS)
        out[rows, (bit >> np.uint64(6)).astype(np.int64)] ^= np.uint64(1) << (bit & np.uint64(63))
    return out.view(np.int64)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether 100 times the intersection is 75 times the union or more."""
    if 4 * min(len(a), len(b)) < 3 * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= 75 * (len(a) + len(b) - shared)


SKETCHED = "doc_id long, text_hash long, n long, digest binary, bands array<long>, sketch array<long>"


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        x, starts = shingle_sets(batch.column(2))
        n = np.diff(starts)
        values = min_hashes(x, starts)
        row = np.where(n > 0, np.cumsum(n > 0) - 1, -1)
        lists = []
        for table in (band_keys(values), odd_sketches(values)):
            offsets = pa.array(np.concatenate([[0], np.cumsum(np.where(row >= 0, table.shape[1], 0))]).astype(np.int32))
            lists.append(pa.ListArray.from_arrays(offsets, pa.array(table.ravel())))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(n.astype(np.int64)), pa.array(digests(x, starts), pa.binary()), *lists],
            names=["doc_id", "text_hash", "n", "digest", "bands", "sketch"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        x, starts = shingle_sets(batch.column(0))
        sets = [x[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(digests(x, starts), pa.binary()), pa.array(sets, pa.binary())], names=["digest", "items"])


def _decided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "a_items"):
        yes = [similar(np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)) for a, b in zip(batch.column(2), batch.column(3), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(yes)), batch.column(1).filter(pa.array(yes))], names=["u", "v"])


def _joined_up(table: pa.Table) -> pa.Table:
    """Links between components within a bucket, or between two blocks of one."""
    nodes, roots = table.column("node").to_pylist(), table.column("root").to_pylist()
    sketches = np.array(table.column("sketch").to_pylist(), np.int64).view(np.uint64).reshape(len(nodes), -1)
    n = table.column("n").to_numpy()
    items = table.column("items").combine_chunks()
    number = {r: i for i, r in enumerate(dict.fromkeys(roots))}
    group = np.array([number[r] for r in roots])
    u, v = [], []
    for i in range(1, len(nodes)):
        bits = np.bitwise_count(sketches[:i] ^ sketches[i]).sum(axis=1)
        small, large = np.minimum(n[:i], n[i]), np.maximum(n[:i], n[i])
        likely = np.flatnonzero((bits <= MOST_BITS) & (4 * small >= 3 * large))
        for j in likely[np.argsort(bits[likely], kind="stable")]:
            if group[i] != group[j] and similar(np.frombuffer(items[i].as_buffer(), np.uint64), np.frombuffer(items[int(j)].as_buffer(), np.uint64)):
                u.append(nodes[i])
                v.append(nodes[j])
                group[group == group[j]] = group[i]
    return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})


def _with_small(df: DataFrame, small: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """A join whose other side is sent out if it is counted and has at most BROADCAST_ROWS rows."""
    return df.join(F.broadcast(small) if small.count() <= BROADCAST_ROWS else small, on, how)


def _bits(a: str, b: str) -> Column:
    total = F.lit(0)
    for i in range(SKETCH_BITS // 64):
        total = total + F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i]))
    return total


def _sets_of(rows: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, items) of the wanted nodes, from the text of one document each."""
    few = scratch.save(nodes.join(wanted, "node", "left_semi").select("node", "digest", "doc_id"), "near-ids", compact=True)
    ids = few.filter("doc_id IS NOT NULL").select("doc_id").distinct()
    texts = _with_small(rows.filter("doc_id IS NOT NULL"), ids, "doc_id", "left_semi")
    # Nodes whose documents all lack an id are found again by their digest alone.
    lacking = rows.filter("doc_id IS NULL") if few.filter("doc_id IS NULL").head(1) else rows.limit(0)
    found = texts.union(lacking).select("text").mapInArrow(_sets, "digest binary, items binary").filter("digest IS NOT NULL")
    return scratch.save(found.join(few.select("node", "digest"), "digest").select("node", "items").dropDuplicates(["node"]), "near-sets", compact=True)


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, n, root, component_id) of every row; ``root`` names its group, null for an empty set."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sketched = scratch.save(rows.select("doc_id", text_hash(F.col("text")).alias("text_hash"), "text").mapInArrow(_sketched, SKETCHED), "near-sketched")
    nodes = sketched.filter("n > 0").groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    nodes = scratch.save(nodes.withColumn("node", F.monotonically_increasing_id()), "near-nodes")

    banded = nodes.select("node", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.min("node").alias("leader"), F.count("*").alias("members")).filter("members > 1")
    members = scratch.save(banded.join(shared, "key"), "near-members")
    star = members.filter("node != leader").select("node", "leader").distinct()
    about = nodes.select("node", "n", "sketch")
    other = about.select(F.col("node").alias("leader"), F.col("n").alias("n2"), F.col("sketch").alias("sketch2"))
    likely = star.join(about, "node").join(other, "leader").filter((4 * F.least("n", "n2") >= 3 * F.greatest("n", "n2")) & (_bits("sketch", "sketch2") <= MOST_BITS))
    likely = scratch.save(likely.select("node", "leader"), "near-star", compact=True)
    wanted = likely.select("node").union(likely.select("leader")).distinct()
    sets = _sets_of(rows, nodes, wanted)
    left = sets.select("node", F.col("items").alias("a_items"))
    right = sets.select(F.col("node").alias("leader"), F.col("items").alias("b_items"))
    pairs = likely.join(left, "node").join(right, "leader").select("node", "leader", "a_items", "b_items")
    links = scratch.save(pairs.mapInArrow(_decided, "u long, v long"), "near-links", compact=True)
    roots = scratch.save(connected_components(links), "near-roots", compact=True)

    # Buckets that the stars have left in more than one component; equal buckets once.
    rooted = members.filter("members > 2").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_keys = rooted.groupBy("key").agg(
        F.min("root").alias("a"), F.max("root").alias("b"), F.first("members").alias("members"), F.bit_xor(F.xxhash64("node")).alias("same")
    ).filter("a != b").groupBy("members", "same").agg(F.min("key").alias("key"))
    left_over = scratch.save(rooted.join(open_keys.select("key", (F.ceil(F.col("members") / BLOCK)).alias("blocks")), "key").select("key", "node", "root", "blocks"), "near-open", compact=True)
    more = _closed(rows, nodes, sets, left_over)
    if more is not None:
        roots = scratch.save(connected_components(links.union(more)), "near-roots", compact=True)

    grouped = nodes.select("node", "digest", "doc_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = grouped.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = scratch.save(grouped.join(least, "root").select("digest", "root", "component_id"), "near-named")
    out = sketched.select("doc_id", "text_hash", "n", "digest").join(named, "digest", "left")
    return out.select("doc_id", "text_hash", "n", "root", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row."""
    found = near_groups(docs, id_col, text_col)
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` of which one stays of each group, and all whose set is empty.

    Of a group the row with the least id stays, a null id last; then the one whose text
    has the least hash. Rows of one id and different texts are told apart by their texts.
    """
    found = scratch.save(near_groups(docs, id_col, text_col).filter("n > 0"), "near-groups")
    rows = found.groupBy("root", "doc_id", "text_hash").agg(F.count("*").alias("copies"))
    row = F.struct(F.col("doc_id").isNull().alias("lacks"), "doc_id", "text_hash")
    best = found.groupBy("root").agg(F.min(row).alias("best")).select("root", F.col("best.doc_id").alias("best_id"), F.col("best.text_hash").alias("best_hash"))
    chosen = F.col("doc_id").eqNullSafe(F.col("best_id")) & (F.col("text_hash") == F.col("best_hash"))
    told = scratch.save(rows.join(best, "root").select("doc_id", "text_hash", "copies", chosen.alias("chosen")), "near-told", compact=True)
    kept = without_rows(docs, told.filter("NOT chosen"), id_col, text_col)
    repeated = told.filter("chosen AND copies > 1")
    if not repeated.head(1):
        return kept
    again = F.broadcast(repeated.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))) if repeated.count() <= BROADCAST_ROWS else repeated.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    same = kept[id_col].cast("long").eqNullSafe(again["_id"]) & (text_hash(kept[text_col]) == again["_hash"])
    whole = F.struct(*[F.col(c) for c in docs.columns])
    once = kept.join(again, same).groupBy("_id", "_hash").agg(F.min_by(whole, F.xxhash64(*[F.col(c) for c in docs.columns])).alias("_row")).select("_row.*")
    return without_rows(kept, repeated, id_col, text_col).unionByName(once)


def _closed(rows: DataFrame, nodes: DataFrame, sets: DataFrame, left_over: DataFrame) -> DataFrame | None:
    """Links within the buckets of ``left_over`` (key, node, root, blocks) that join components."""
    if not left_over.head(1):
        return None
    wanted = left_over.select("node").distinct().join(sets, "node", "left_anti")
    all_sets = sets.union(_sets_of(rows, nodes, scratch.save(wanted, "near-wanted", compact=True)))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    pair = F.transform(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int")), lambda i: F.struct(F.least(i, block).alias("i"), F.greatest(i, block).alias("j")))
    dealt = left_over.withColumn("pair", F.explode(pair)).select("key", "pair", "node", "root")
    full = dealt.join(nodes.select("node", "n", "sketch"), "node").join(all_sets, "node")
    return scratch.save(full.groupBy("key", "pair").applyInArrow(_joined_up, "u long, v long"), "near-more", compact=True)


def op7_near_duplicates(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: Shingles are told apart by their words here, not by hashes. Links between different sets
#: are closed by taking, again and again, the least id that a linked set has.
OP7_SQL = r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT rid, doc_id, list_sort(list_distinct(CASE WHEN len(ws) = 0 THEN []
         WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
         ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END)) AS items FROM w),
g AS (SELECT items, min(doc_id) AS node, len(items) AS n FROM s WHERE len(items) > 0 GROUP BY items),
x AS (SELECT node, n, unnest(items) AS item FROM g),
l AS (SELECT a.node AS u, b.node AS v FROM x a JOIN x b ON a.item = b.item AND a.node <> b.node AND 4 * least(a.n, b.n) >= 3 * greatest(a.n, b.n)
      GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
r AS (SELECT node, node AS root FROM g UNION SELECT r.node, l.v FROM r JOIN l ON l.u = r.root),
c AS (SELECT node, min(root) AS component_id FROM r GROUP BY node)
SELECT s.doc_id, CAST(len(s.items) AS BIGINT) AS n_shingles, coalesce(c.component_id, s.doc_id) AS component_id,
       coalesce(c.component_id, s.doc_id) = s.doc_id AS kept
FROM s LEFT JOIN g ON g.items = s.items LEFT JOIN c ON c.node = g.node
"""
