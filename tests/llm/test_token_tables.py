import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lumbre.llm import token_tables as tt

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def whole(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


ODD = ["", " ", "a.b,c d..e ,.", "It's THE dog's 's", "İstanbul ﬁn Å e\u0301x \u00a0y\u00a0", "<|endoftext|> a<|startoftext|>b", "12.5, 3,4 ...", "naïve œuvre ΑΣ ΟΔΟΣ.", "\x0b\x0c\x1cx\x85y", "日本語。テスト", "x" * 5000, "\U0001f600.\U0001f600,a"]


def test_words_encode_like_whole_texts(tokenizer):
    encoder = tt.WordEncoder(PATH, remember=10)
    for _ in range(2):
        ids, starts = encoder.encode(pa.array(ODD))
        assert [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:])] == [whole(tokenizer, t) for t in ODD]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=30), max_size=5))
def test_any_text(texts):
    encoder = test_any_text.__dict__.setdefault("encoder", tt.WordEncoder(PATH))
    ids, starts = encoder.encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:])] == [whole(encoder.tokenizer, t) for t in texts]


def test_query(spark, sf_dir, tokenizer):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    got = {r["doc_id"]: tuple(r)[1:] for r in tt.op6_token_tables(spark, sf_dir).collect()}
    start = 0
    for key, text in docs:
        ids = np.array([*whole(tokenizer, text), 2], "<u4")
        assert got[key] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert len(got) == len(docs)


def test_table_round_trip():
    rng = np.random.default_rng(0)
    keys = sorted({int(k) for k in rng.integers(-(10**12), 10**12, 3000)} | {0, 255, 256})
    entries = [(None, np.array([5])), *((k, rng.integers(0, 60_000, rng.integers(0, 40))) for k in keys)]
    entries.insert(10, entries[9])  # a repeated key
    writer = tt.TableWriter(2, block_bytes=512)
    for k, ids in entries:
        writer.add(tt.pack_key(k), ids)
    reader = tt.TableReader(writer.finish())
    read = list(reader)
    assert [tt.unpack_key(k) for k, _, _ in read] == [k for k, _ in entries]
    assert all((a == b[1]).all() for (_, _, a), b in zip(read, entries))
    assert [s for _, s, _ in read] == np.concatenate([[0], np.cumsum([len(i) for _, i in entries])])[:-1].tolist()
    assert len(reader.blocks) > 10 and reader.documents == len(entries)
    assert all(any((x == ids).all() for x in reader.get(k) if len(x) == len(ids)) for k, ids in entries[::37])
    assert len(reader.get(entries[9][0])) == 2 and reader.get(10**13) == []
    absent = [k for k in range(10**12 + 1, 10**12 + 1001)]
    passed = sum(all(reader.bloom[p >> 3] >> (p & 7) & 1 for p in tt._probes(tt.pack_key(k), reader.bits, reader.hashes)) for k in absent)
    assert passed < 40
    with pytest.raises(ValueError):
        tt.TableReader(b"x" * 200)


def test_messy(spark, messy, nothing, tokenizer, tmp_path):
    tt.write_tables(messy, f"file://{tmp_path}/t", PATH, 2, file_ids=1000)
    got = sorted(tt.read_digests(spark, f"file://{tmp_path}/t").collect(), key=lambda r: r["start"])
    want = sorted((r["doc_id"] is not None, r["doc_id"] or 0, len(whole(tokenizer, r["text"])) + 1) for r in messy.collect())
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_tokens"]) for r in got) == want
    assert [(r["doc_id"] is not None, r["doc_id"] or 0) for r in got] == [w[:2] for w in want]
    assert [r["start"] for r in got] == np.concatenate([[0], np.cumsum([r["n_tokens"] for r in got])])[:-1].tolist()
    tt.write_tables(nothing, f"file://{tmp_path}/e", PATH, 2)
    assert tt.read_digests(spark, f"file://{tmp_path}/e").count() == 0


def test_width(spark, tmp_path):
    writer = tt.TableWriter(2)
    with pytest.raises(ValueError):
        writer.add(tt.pack_key(1), np.array([70_000]))
    wide = tt.TableWriter(4)
    wide.add(tt.pack_key(1), np.array([70_000]))
    assert [x.tolist() for x in tt.TableReader(wide.finish()).get(1)] == [[70_000]]
    docs = spark.createDataFrame([(1, "a word")], "doc_id long, text string")
    tt.write_tables(docs, f"file://{tmp_path}/w", PATH, 70_000)
    (raw,) = [p.read_bytes() for p in (tmp_path / "w").glob("part-*") if p.stat().st_size]
    reader = tt.TableReader(raw)
    assert reader.width == 4 and reader.get(1)[0][-1] == 70_000


def test_tokenizers_that_join_words_are_refused():
    import json

    kinds = json.loads(Tokenizer.from_file(PATH).to_str())
    assert tt._depends(kinds) is None
    assert tt._depends(kinds | {"pre_tokenizer": None}) and tt._depends(kinds | {"normalizer": {"type": "Prepend", "prepend": "_"}})
    assert tt._depends(kinds | {"pre_tokenizer": {"type": "Metaspace"}}) and tt._depends(kinds | {"model": {"type": "Unigram"}})


def test_a_hot_id_fills_many_partitions(spark, tmp_path):
    rows = [(5, f"text number {i}") for i in range(300)] + [(5, "same text") for _ in range(300)] + [(4, "before"), (6, "after")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    tt.write_tables(docs, f"file://{tmp_path}/h", PATH, 2, partition_bytes=1000)
    files = [p for p in (tmp_path / "h").glob("part-*") if p.stat().st_size]
    assert len(files) > 4
    got = sorted(tt.read_digests(spark, f"file://{tmp_path}/h").collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [4] + [5] * 600 + [6]
    assert [r["start"] for r in got] == np.concatenate([[0], np.cumsum([r["n_tokens"] for r in got])])[:-1].tolist()
