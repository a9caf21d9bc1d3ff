"""Token-ID output as sorted-string-table shards.

Documents are range-partitioned and sorted by identifier, encoded, and written as
immutable table files; a lookup reads a file's footer, asks its Bloom filter, finds the
block by binary search in the sparse index and decodes that block alone.

File layout (integers little-endian, ``v`` a varint)
    blocks   zstd of entries: v shared key bytes, v other key bytes, v value bytes, the
             other key bytes, the value: token ids of ``width`` bytes each
    index    zstd of one entry per block: v key bytes, last key, v offset, v length, v ids before
    bloom    bits, ``hashes`` probes by double hashing of xxhash64
    footer   offset and length of index and bloom (4 x u64), documents u64, ids u64,
             bloom bits u64, hashes u32, width u32, 8 bytes of magic
Keys: 00 for null, 01 and the id as big-endian signed order for integers, 02 and UTF-8
for text, so that byte order is ascending key order.

Spark's own text writer commits the files (one record, one file; the line end is the
magic's last byte), so that a lost executor or a speculative task leaves no partial
file and any store that Spark can write to will do.

Defined results
    null text         encoded as the empty text: only the end id
    null id           first; null ids and repeated ids keep an entry each, in order of a
                      hash of their texts
    ids beyond width  an error: ``width`` follows from the vocabulary unless it is given
    very long texts   one entry, held in memory once
    empty table       no file, no rows
    clashing names    only the id and text columns are read
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumbre import scratch
from lumbre.llm.words import slices, small_batches, split_words

MAGIC = b"LUMSST1\n"
FOOTER = struct.Struct("<7Q2I8s")
HASHES, BITS_PER_KEY = 7, 10


def pack_key(key) -> bytes:
    if key is None:
        return b"\x00"
    if isinstance(key, int):
        return b"\x01" + struct.pack(">Q", (key + (1 << 63)) & (1 << 64) - 1)
    return b"\x02" + key.encode("utf-8")


def unpack_key(raw: bytes):
    if raw[:1] == b"\x00":
        return None
    return struct.unpack(">Q", raw[1:])[0] - (1 << 63) if raw[:1] == b"\x01" else raw[1:].decode("utf-8")


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(raw: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = raw[at]
        value |= (b & 127) << shift
        at, shift = at + 1, shift + 7
        if b < 128:
            return value, at


def _probes(key: bytes, bits: int, hashes: int) -> list[int]:
    a, b = xxhash.xxh64_intdigest(key, 0), xxhash.xxh64_intdigest(key, 1) | 1
    return [(a + i * b) % (1 << 64) % bits for i in range(hashes)]


class TableWriter:
    """One table file in memory; entries come in ascending key order."""

    def __init__(self, width: int = 2, block_bytes: int = 64 << 10):
        self.width, self.block_bytes, self.kind = width, block_bytes, "<u2" if width == 2 else "<u4"
        self.pack = zstandard.ZstdCompressor(level=1)
        self.body, self.block, self.index, self.keys = [], [], [], []
        self.size = self.in_block = self.ids = self.before = 0
        self.last = b""

    def add(self, key: bytes, ids: np.ndarray) -> None:
        if len(ids) and int(ids.max()) >= 1 << 8 * self.width:
            raise ValueError(f"an id of {int(ids.max())} does not fit {self.width} bytes")
        shared = 0
        if self.block:
            for x, y in zip(key, self.last, strict=False):
                if x != y:
                    break
                shared += 1
        value = ids.astype(self.kind).tobytes()
        self.block += [_varint(shared), _varint(len(key) - shared), _varint(len(value)), key[shared:], value]
        self.in_block += len(value) + len(key) - shared + 4
        self.last = key
        self.keys.append(key)
        self.ids += len(ids)
        if self.in_block >= self.block_bytes:
            self._close()

    def _close(self) -> None:
        if self.block:
            raw = self.pack.compress(b"".join(self.block))
            self.index += [_varint(len(self.last)), self.last, _varint(self.size), _varint(len(raw)), _varint(self.before)]
            self.body.append(raw)
            self.size += len(raw)
            self.block, self.in_block, self.before = [], 0, self.ids

    def finish(self) -> bytes:
        self._close()
        index = self.pack.compress(b"".join(self.index))
        bits = max(64, len(self.keys) * BITS_PER_KEY)
        bloom = bytearray(-(-bits // 8))
        for key in self.keys:
            for p in _probes(key, bits, HASHES):
                bloom[p >> 3] |= 1 << (p & 7)
        end = self.size + len(index)
        footer = FOOTER.pack(self.size, len(index), end, len(bloom), len(self.keys), self.ids, bits, HASHES, self.width, MAGIC)
        return b"".join([*self.body, index, bytes(bloom), footer])


class TableReader:
    """A table file's entries, in order or by key."""

    def __init__(self, raw: bytes):
        self.raw = raw
        at, size, bloom_at, bloom_size, self.documents, self.ids, self.bits, self.hashes, self.width, magic = FOOTER.unpack(raw[-FOOTER.size :])
        if magic != MAGIC:
            raise ValueError("not a table file")
        self.kind = "<u2" if self.width == 2 else "<u4"
        self.bloom = raw[bloom_at : bloom_at + bloom_size]
        self.open = zstandard.ZstdDecompressor()
        index, self.blocks, i = self.open.decompress(raw[at : at + size]) if self.documents else b"", [], 0
        while i < len(index):
            n, i = _read_varint(index, i)
            key, i = index[i : i + n], i + n
            offset, i = _read_varint(index, i)
            length, i = _read_varint(index, i)
            before, i = _read_varint(index, i)
            self.blocks.append((key, offset, length, before))

    def block(self, n: int) -> Iterator[tuple[bytes, int, np.ndarray]]:
        """(key, ids of the file before it, ids) of a block's entries."""
        _, offset, length, start = self.blocks[n]
        raw = self.open.decompress(self.raw[offset : offset + length])
        i, key = 0, b""
        while i < len(raw):
            shared, i = _read_varint(raw, i)
            own, i = _read_varint(raw, i)
            size, i = _read_varint(raw, i)
            key = key[:shared] + raw[i : i + own]
            i += own
            ids = np.frombuffer(raw, self.kind, size // self.width, i)
            yield key, start, ids
            i, start = i + size, start + len(ids)

    def __iter__(self):
        for n in range(len(self.blocks)):
            yield from self.block(n)

    def get(self, key) -> list[np.ndarray]:
        """The ids of all entries of a key."""
        want = pack_key(key)
        if not all(self.bloom[p >> 3] >> (p & 7) & 1 for p in _probes(want, self.bits, self.hashes)):
            return []
        low, high = 0, len(self.blocks)
        while low < high:
            mid = (low + high) // 2
            low, high = (mid + 1, high) if self.blocks[mid][0] < want else (low, mid)
        found = []
        while low < len(self.blocks):
            entries = [ids for k, _, ids in self.block(low) if k == want]
            found += entries
            if not entries or self.blocks[low][0] > want:
                break
            low += 1
        return found


#: A run of letters that no normaliser changes but for case, or of full stops and commas:
#: one pre-token, whose last id ends a word.
_ONE = r"^(?:[a-zß-öø-ÿāăąćčďđēęěğģīįķļłńňŋōőœřśşšťūůűųźżž]+|[.,]+)$"
_BEFORE_STOP = r"([a-zß-öø-ÿ0-9])([.,])"


def _depends(kinds: dict) -> str | None:
    """What in a tokenizer could make a word's ids depend on its neighbours, or None.

    Normalisers must work within a word, white space apart; the text must be split at white
    space before the model, and no space be put before a word.
    """
    parts = lambda x, inner: x.get(inner, [x]) if x else []
    for x in parts(kinds["normalizer"], "normalizers"):
        if x["type"] not in ("NFC", "NFD", "NFKC", "NFKD", "Lowercase", "StripAccents") and not (x["type"] == "Replace" and x["pattern"] == {"Regex": r"\s+"} and x["content"] == " "):
            return f"normaliser {x['type']}"
    split = False
    for x in parts(kinds["pre_tokenizer"], "pretokenizers"):
        if x["type"] in ("Whitespace", "WhitespaceSplit", "BertPreTokenizer") or x["type"] == "Split" and x["behavior"] == "Removed" and x["invert"] and r"[^\s" in x["pattern"].get("Regex", ""):
            split = True
        elif not (x["type"] in ("Punctuation", "Digits") or x["type"] == "ByteLevel" and not x["add_prefix_space"] and not x["use_regex"]):
            return f"pre-tokenizer {x['type']}"
    return None if split and kinds["model"]["type"] == "BPE" else "pre-tokenizer or model"


class WordEncoder:
    """Encodes texts word by word, each distinct word once while it is remembered.

    Its ids are those of the whole text: each is what the tokenizer gives for that word, and
    a tokenizer for which words could depend on each other is refused. It must lower-case in
    its normaliser, split at white space and punctuation before its model, and end each
    pre-token with an id that ends a word; and a probe must come out alike. Full stops and commas are split off first,
    where the pre-tokenizer would split anyway. Plain words are encoded many in one
    string, and cut apart at the ids that end a word; other words one by one.
    """

    def __init__(self, path: str, remember: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.remember = Tokenizer.from_file(path), remember
        vocabulary = self.tokenizer.get_vocab()
        if why := _depends(json.loads(self.tokenizer.to_str())):
            raise ValueError(f"this tokenizer's {why} may join words; encode whole texts instead")
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        whole = self.tokenizer.encode("Aa bb,\n c.", add_special_tokens=False).ids
        if whole != sum((self.tokenizer.encode(x, add_special_tokens=False).ids for x in ("aa", "bb", ",", "c", ".")), []):
            raise ValueError("this tokenizer does not encode word by word; encode whole texts instead")
        self.forget()

    def forget(self) -> None:
        self.slot: dict[str, int] = {}
        self.flat, self.first, self.size = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        self.held = 0

    def _keep(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        at = len(self.slot)
        self.slot.update(zip(words, range(at, at + len(words)), strict=True))
        self.flat.append(ids)
        self.size.append(sizes)
        self.first.append(self.held + np.cumsum(sizes) - sizes)
        self.held += len(ids)

    def _learn(self, words: pa.Array) -> np.ndarray:
        """The slots of words that have none yet."""
        slots = np.zeros(len(words), np.int64)
        plain = pc.match_substring_regex(words, _ONE).to_numpy(zero_copy_only=False)
        words, other = words.to_pylist(), list(np.flatnonzero(~plain))
        simple = np.flatnonzero(plain)
        for at in range(0, len(simple), 2000):
            part = simple[at : at + 2000]
            texts = [words[i] for i in part]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(texts)], add_special_tokens=False)[0].ids, np.uint32)
            last = np.flatnonzero(self.ends[ids])
            if len(last) == len(part):
                slots[part] = len(self.slot) + np.arange(len(part))
                self._keep(texts, ids, np.diff(last, prepend=-1))
            else:
                other += list(part)
        for at in range(0, len(other), 2000):
            part = other[at : at + 2000]
            texts = [words[i] for i in part]
            found = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            slots[part] = len(self.slot) + np.arange(len(part))
            self._keep(texts, np.array([i for x in found for i in x], np.uint32), np.array([len(x) for x in found], np.int64))
        return slots

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, first id of each text and the end)."""
        texts = pc.replace_substring_regex(pc.ascii_lower(texts), _BEFORE_STOP, r"\1 \2")
        codes, words, offsets = split_words(texts, lower=False)
        if len(self.slot) > self.remember:
            self.forget()
        slots = np.fromiter(map(self.slot.get, words.to_pylist(), repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(slots < 0)
        slots[new] = self._learn(words.take(pa.array(new)))
        self.flat, self.first, self.size = ([np.concatenate(x)] for x in (self.flat, self.first, self.size))
        slots = slots[codes]
        sizes = self.size[0][slots]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.flat[0][np.repeat(self.first[0][slots] - ends[:-1], sizes) + np.arange(ends[-1])]
        return ids, ends[offsets]


def _tables(tokenizer: str, end_id: int, file_ids: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, table = WordEncoder(tokenizer), TableWriter(width)
        # The file's last byte is written by the text writer as the end of its line.
        ready = lambda t: pa.RecordBatch.from_arrays([pa.array([t.finish()[:-1]], pa.binary())], names=["table"])
        for batch in slices(batches, "text", 4 << 20):
            ids, starts = encoder.encode(batch.column(1))
            for key, a, b in zip(batch.column(0).to_pylist(), starts[:-1], starts[1:], strict=True):
                table.add(pack_key(key), np.append(ids[a:b], np.uint32(end_id)))
                if table.ids >= file_ids:
                    yield ready(table)
                    table = TableWriter(width)
        if table.keys:
            yield ready(table)

    return run


def write_tables(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    width: int | None = None,
    file_ids: int = 4 << 20,
    partition_bytes: int = 24 << 20,
    most_partitions: int = 1 << 15,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode ``docs`` and write table files below ``path``.

    ``width``: bytes an id, 2 or 4, by default as the vocabulary needs. A partition is read
    a batch at a time and only the open file is held, so that partitions may grow once
    there are ``most_partitions`` of them; ``file_ids`` ids fill a file.
    """
    from tokenizers import Tokenizer

    if width is None:
        width = 2 if max(end_id, *Tokenizer.from_file(tokenizer).get_vocab().values()) < 1 << 16 else 4
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()["b"]
    parts = min(most_partitions, max(1, -(-int(total) // partition_bytes)))
    # Rows of one id are dealt by their texts, rows of one id and text by a number: no id is too hot for a range.
    keyed = rows.withColumns({"_hash": F.xxhash64("text"), "_number": F.monotonically_increasing_id()})
    order = [F.col("doc_id").asc_nulls_first(), F.col("_hash"), F.col("_number")]
    ordered = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "text")
    tables = ordered.mapInArrow(_tables(tokenizer, end_id, file_ids, width), "table binary")
    tables.select(F.col("table").cast("string")).write.option("maxRecordsPerFile", 1).option("lineSep", MAGIC[-1:].decode()).text(path)


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1), strict=True):
            rows = [(unpack_key(k), start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for k, start, ids in TableReader(content.as_py())]
            keys, starts, sizes, sums = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array([path.as_py()] * len(rows), pa.string()), pa.array(keys, pa.int64()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(sums, pa.int64())],
                names=["file", "doc_id", "offset", "n_tokens", "ids_crc32"],
            )


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every entry of the files below ``path``.

    ``start`` counts the ids of all entries before it: of its own file by the index, of
    earlier files by a running sum over one row a file.
    """
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.read.format("binaryFile").schema(schema).load(path).filter(F.col("length") > 0).select("path", "content")
    rows = scratch.save(files.mapInArrow(_entries, "file string, doc_id long, offset long, n_tokens long, ids_crc32 long"), "token-rows")
    first = F.min(F.struct(F.col("doc_id").isNotNull().alias("some"), "doc_id"))
    last = F.max(F.struct(F.col("doc_id").isNotNull().alias("some"), "doc_id"))
    totals = rows.groupBy("file").agg(F.sum("n_tokens").alias("n"), first.alias("first"), last.alias("last"))
    # Files are written in order of their partition and of their place in it, and named so.
    earlier = Window.orderBy("first", "last", "file").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    starts = scratch.save(starts.coalesce(1), "token-starts")
    return rows.join(starts, "file").select("doc_id", (F.col("before") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def op6_token_tables(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    path = scratch.new_path(spark, "token-tables")
    write_tables(docs, path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return read_digests(spark, path)
