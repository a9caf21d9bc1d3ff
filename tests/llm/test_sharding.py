import zlib

from pyspark.sql import functions as F

from lumbre.llm.sharding import op3_shard_documents, shard_records


def test_contract(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = op3_shard_documents(spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    slots = {}
    for r in got:
        raw = docs[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(raw) + 1, zlib.crc32(raw), "key")
        assert 0 <= r["shard"] < 16 and (r["grown_shard"] == r["shard"] or r["grown_shard"] == 16)
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sorted(got) == sorted(op3_shard_documents(spark, sf_dir).collect())


def test_shuffles_and_keeps_rows(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id")).alias("text"))
    got = shard_records(docs, 4, bucket_bytes=20_000).collect()
    assert sorted((r["doc_id"], r["text"]) for r in got) == [(i, f"t{i}") for i in range(4000)]
    assert len({r["bucket"] for r in got}) > 4
    own = [r["doc_id"] for r in sorted((r for r in got if r["shard"] == 0), key=lambda r: r["slot"])]
    rising = sum(a < b for a, b in zip(own, own[1:])) / (len(own) - 1)
    assert 0.4 < rising < 0.6 and 800 < len(own) < 1200
    other = shard_records(docs, 4, seed=8, bucket_bytes=20_000).collect()
    assert {r["doc_id"]: r["slot"] for r in other} != {r["doc_id"]: r["slot"] for r in got}


def test_equal_rows_are_spread_alike_whatever_the_partitions(spark):
    docs = spark.range(3000).select(F.when(F.col("id") < 1000, -1).otherwise(F.col("id")).alias("doc_id"), F.lit("same").alias("text"))
    seen = []
    for parts in (1, 7):
        got = shard_records(docs.repartition(parts), 2, bucket_bytes=10_000).collect()
        hot = [r for r in got if r["doc_id"] == -1]
        assert len(hot) == 1000 and len({r["shard"] for r in hot}) == 1 and len({r["bucket"] for r in hot}) > 5
        for s in (0, 1):
            assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
        seen.append(sorted((r["doc_id"], r["text"], r["shard"], r["bucket"], r["slot"]) for r in got))
    assert seen[0] == seen[1]


def test_messy(messy, nothing):
    got = shard_records(messy)
    assert got.count() == messy.count() and got.columns.count("shard") == 1
    assert {c for c in messy.columns} <= set(got.columns)
    assert shard_records(nothing).count() == 0


def test_written_files(spark, tmp_path):
    docs = spark.range(50).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    shard_records(docs, 3, path=f"file://{tmp_path}/s").count()
    assert {p.name for p in (tmp_path / "s").glob("shard=*")} == {"shard=0", "shard=1", "shard=2"}
