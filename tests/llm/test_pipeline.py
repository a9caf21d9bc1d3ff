import collections
import random

import corpus_pipeline as cp
import pyarrow as pa
from lumbre.llm import decontamination as dc
from lumbre.llm.sharding import shard_of
from pyspark.sql import functions as F
from tests.llm.test_mixing import targets
from tests.llm.test_near_dedup import brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    junk = spark.createDataFrame([(900_001, "1234 !!!", "en", "src0", 8), (900_002, None, "en", "src0", 0)], docs.schema)
    at = docs.union(junk)
    seen = {}
    for name, stage in cp.STAGES:
        before = at.collect()
        at = stage(spark, at, sf_dir)
        assert at.columns[:5] == COLUMNS and (name == "shard" or at.columns == COLUMNS)
        at = spark.createDataFrame(at.collect(), at.schema)
        seen[name] = (before, at.collect())

    before, after = seen["language_id"]
    assert {r["doc_id"] for r in before} - {r["doc_id"] for r in after} == {900_001, 900_002}

    before, after = seen["near_dedup"]
    kept = {i for i, (_, _, k) in brute([(r["doc_id"], r["text"]) for r in before]).items() if k}
    assert {r["doc_id"] for r in after} == kept and len(after) == len(kept)

    before, after = seen["decontaminate"]
    gone = {r["doc_id"] for r in before} - {r["doc_id"] for r in after}
    h, offsets = dc.word_hashes(pa.array([r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]))
    items = [h[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])]
    for r in before:
        w = dc.word_hashes(pa.array([r["text"]]))[0].tolist()
        places = collections.defaultdict(list)
        for i, x in enumerate(w):
            places[x].append(i)
        whole = any(any(w[i : i + len(t)] == t for i in places.get(t[0], ())) for t in items)
        assert whole == (r["doc_id"] in gone)

    before, after = seen["mix_sources"]
    size = {r["doc_id"]: len(r["text"].split()) for r in before}
    source = {r["doc_id"]: r["source"] for r in before}
    sizes = collections.Counter()
    for i, n in size.items():
        sizes[source[i]] += n
    got = collections.Counter()
    for r in after:
        got[r["source"]] += size[r["doc_id"]]
    assert max(collections.Counter(r["doc_id"] for r in after).values()) <= 3
    for s, t in targets(dict(sizes), (1, 2, 3)).items():
        assert 0 <= got[s] - t + 1 <= 1 + max(n for i, n in size.items() if source[i] == s)

    before, after = seen["shard"]
    assert sorted((r["doc_id"], r["text"]) for r in before) == sorted((r["doc_id"], r["text"]) for r in after)
    want = {r["doc_id"]: r["s"] for r in spark.createDataFrame(before).select("doc_id", shard_of(F.col("doc_id"), 16, 7).alias("s")).collect()}
    slots = collections.defaultdict(list)
    for r in after:
        assert r["shard"] == want[r["doc_id"]]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_run(spark, sf_dir):
    got = cp.run(spark, sf_dir)
    assert got.columns == [*COLUMNS, "shard", "slot"] and got.count() > 100


def test_messy_documents(spark, messy, sf_dir):
    at = messy.select(*COLUMNS)
    for _, stage in cp.STAGES:
        at = spark.createDataFrame(stage(spark, at, sf_dir).collect(), stage(spark, at.limit(0), sf_dir).schema)
    assert at.count() > 0


def test_rows_are_told_apart_by_id_and_text(spark, sf_dir):
    """No distinct text is lost to an id that it shares, and null ids are judged like others."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").orderBy("item_id").first()["text"]
    a, b, c = (" ".join(f"{x}{i}" for i in range(20)) for x in "abc")
    near = b.replace("b0 ", "")
    rows = [(1, a), (1, a), (1, b), (2, a), (None, near), (None, c), (None, item), (3, item), (3, "clean words of number three")]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], schema)
    once = cp.drop_near_duplicates(spark, docs, sf_dir)
    assert sorted((r["doc_id"] or 0, r["text"]) for r in once.collect()) == sorted([(1, a), (1, b), (0, c), (3, item), (3, "clean words of number three")])
    left = cp.drop_benchmark(spark, docs, sf_dir)
    assert sorted((r["doc_id"] or 0, r["text"]) for r in left.collect()) == sorted((i or 0, t) for i, t in rows if t != item)


def test_decontamination_learns_from_every_row(spark, sf_dir, monkeypatch):
    """Words that occur four times in 800,000 are known to the stage's latent space."""
    rng = random.Random(13)
    common = [f"{a}{b}" for a in "bdfgklmnpr" for b in range(300)]
    texts = [rng.choices(common, k=400) for _ in range(2000)]
    marks = [f"mark{i}x" for i in range(300)]
    for m in marks:
        for d in rng.sample(range(2000), 4):
            texts[d].insert(rng.randint(0, len(texts[d])), m)
    docs = spark.createDataFrame([(i, " ".join(w), "en", "s", 1) for i, w in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    seen, build = [], dc.build_index
    monkeypatch.setattr(dc, "build_index", lambda items, freq, space, cosine: seen.append(space) or build(items, freq, space, cosine))
    assert cp.drop_benchmark(spark, docs, sf_dir).columns == COLUMNS
    assert (seen[0].row[dc.cells_of(dc.word_hashes(pa.array(marks))[0])] >= 0).all()
