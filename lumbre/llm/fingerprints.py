"""Document fingerprints by consistent weighted sampling, in DataFrame functions alone.

A document is its words (A-Z lower-cased) weighted by their counts. For each of
``samples`` draws every word has r, c ~ Gamma(2, 1) and beta ~ U(0, 1) from its hash;
with t = floor(ln w / r + beta), the word with the least ln c - r (t - beta) - r is
drawn, and the sample is the pair (word, t). Two documents draw the same sample with
the probability of their generalised Jaccard similarity, sum of min over sum of max
of the weights. A fingerprint is the samples' 24-bit hashes as hexadecimal text;
likeness is the share of equal samples.

The next document is the one with the next lower id. Rows are dealt into id ranges,
the neighbours within a range come from a window over it, those across ranges from
one row a range. Everything from there to the fingerprints keeps that partitioning,
so the texts are shuffled once.

Defined results
    null text         the empty text; texts without words have the fingerprint of
                      zeros, alike among themselves
    null id           after all others
    repeated ids      a fixed order by text; each row has its own result
    one row           it is its own next document
    empty table       no rows
    clashing names    only the id and text columns are read
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumbre import scratch


DIGITS = 6
MOST_RANGES = 1 << 16
#: Samples, of the query too: likenesses move in steps of 1/48, with a standard error of up to 0.072.
SAMPLES = 48


def _part(bits: Column, shift: int, width: int) -> Column:
    """``width`` bits of a hash as a number strictly between 0 and 1."""
    return (F.shiftrightunsigned(bits, shift).bitwiseAND(F.lit((1 << width) - 1)) + F.lit(0.5)) / F.lit(float(1 << width))


def _rank(word: Column, log_weight: Column, k: int) -> Column:
    """ln c - r (t - beta) - r for draw ``k`` of a word. It is the same number exactly where
    word and t are the same, so that the least rank names the sample."""
    one, two = F.xxhash64(word, F.lit(2 * k)), F.xxhash64(word, F.lit(2 * k + 1))
    r = -F.ln(_part(one, 0, 21) * _part(one, 21, 21))
    beta = _part(one, 42, 22)
    c = -F.ln(_part(two, 0, 32) * _part(two, 32, 32))
    # t is 0 for a word that stands once, as most do: the same number without a division.
    above = F.when(log_weight == 0, 1 - beta).otherwise(F.floor(log_weight / r + beta) - beta + 1)
    return F.ln(c) - r * above


def weighted_words(texts: DataFrame, keys: list[str], text_cols: list[str]) -> DataFrame:
    """(keys, word as a hash, and of each text the natural logarithm of the word's count, null for none)."""
    sides = texts.select(*keys, F.posexplode(F.array(*text_cols)).alias("side", "t"))
    words = F.explode(F.split(F.translate(F.col("t"), "\t\n\x0b\x0c\r", "     "), " "))
    each = sides.select(*keys, "side", words.alias("w")).filter(F.col("w") != "")
    hashed = each.select(*keys, "side", F.xxhash64(F.translate(F.col("w"), _UPPER, _UPPER.lower())).alias("word"))
    counted = hashed.groupBy(*keys, "word").agg(*[F.count_if(F.col("side") == i).alias(f"n{i}") for i in range(len(text_cols))])
    # The logarithm of 0 is null.
    return counted.select(*keys, "word", *[F.ln(F.col(f"n{i}").cast("double")).alias(f"log_weight{i}") for i in range(len(text_cols))])


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def weighted_samples(terms: DataFrame, keys: list[str], samples: int, weights: dict[str, str]) -> DataFrame:
    """Fingerprints of (keys, word, logarithms of weights): a column for each of ``weights``,
    by the name of its logarithms. A word is drawn for once for all of them. A key without
    a word of some weight has null there, one without words has no row."""
    drawn = [F.min(_rank(F.col("word"), F.col(w), k)).alias(f"{name}{k}") for k in range(samples) for name, w in weights.items()]
    least = terms.groupBy(*keys).agg(*drawn)
    low = F.lit((1 << 4 * DIGITS) - 1)
    text = lambda name: F.concat(*[F.lpad(F.lower(F.hex(F.xxhash64(f"{name}{k}").bitwiseAND(low))), DIGITS, "0") for k in range(samples)])
    return least.select(*keys, *[F.when(F.col(f"{name}0").isNotNull(), text(name)).alias(name) for name in weights])


def likeness(a: Column, b: Column, samples: int) -> Column:
    """Share of equal samples of two fingerprints."""
    equal = [F.when(F.substring(a, DIGITS * k + 1, DIGITS) == F.substring(b, DIGITS * k + 1, DIGITS), 1).otherwise(0) for k in range(samples)]
    total = equal[0]
    for x in equal[1:]:
        total = total + x
    return total / F.lit(float(samples))


def _bounds(docs: DataFrame, range_bytes: int) -> list[int]:
    """The highest id of each id range, ascending. All but the last are approximate
    quantiles, which are ids of rows, so that no range is empty."""
    size = F.sum(F.coalesce(F.octet_length("text"), F.lit(0)))
    whole = docs.agg(F.coalesce(size, F.lit(0)).alias("bytes"), F.max("order_id").alias("top")).first()
    n = int(max(1, min(MOST_RANGES, -(-int(whole["bytes"]) // range_bytes))))
    if whole["top"] is None:
        return []
    shares = F.array(*[F.lit(i / n) for i in range(1, n)]) if n > 1 else None
    inner = docs.agg(F.percentile_approx("order_id", shares, 20 * n).alias("q")).first()["q"] if n > 1 else []
    return sorted({*inner, whole["top"]})


def _range(bounds: list[int]) -> Column:
    """The number of a row's range, by binary search."""
    table = F.array(*[F.lit(b).cast("long") for b in bounds[:-1]])
    steps = [1 << i for i in reversed(range(max(0, len(bounds) - 1).bit_length()))]
    if not steps:
        return F.lit(0)

    # The id goes in with the state: optimiser rules overlook columns that only a lambda's body names.
    start = F.struct(F.lit(0).alias("at"), F.col("order_id").alias("id"))

    def halve(now: Column, step: Column) -> Column:
        probe = now["at"] + step
        beyond = (probe < len(bounds)) & (F.get(table, probe - 1) < now["id"])
        return F.struct(F.when(beyond, probe).otherwise(now["at"]).alias("at"), now["id"].alias("id"))

    found = F.aggregate(F.array(*[F.lit(x) for x in steps]), start, halve, lambda now: now["at"])
    # Never null, so that no side of a join gets a filter of its own and shuffles can be shared.
    return F.coalesce(found, F.lit(0))


def fingerprint_neighbours(docs: DataFrame, samples: int = SAMPLES, range_bytes: int = 2 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text, of its edited text and their likenesses.

    The edited text is the text with its last floor(n / 2) code points replaced by the
    first as many, or all, of the next document's.
    """
    lowest = F.lit(-(1 << 63))
    docs = docs.select(F.coalesce(F.col(id_col).cast("long"), lowest).alias("order_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    bounds = _bounds(docs, range_bytes)
    tops = docs.sparkSession.createDataFrame([(i, b, i - 1 if i else len(bounds) - 1) for i, b in enumerate(bounds)], "range int, order_id long, next_range int")
    # At most MOST_RANGES rows of three numbers.
    heads = docs.join(F.broadcast(tops), "order_id").groupBy("range").agg(F.min("text").alias("head")).withColumnRenamed("range", "next_range")
    after = tops.select("range", "next_range")
    heads = scratch.save(after.join(heads, "next_range").select("range", "head"), "fp-heads")
    # Partitions of a few ranges, whose words fit an executor's memory.
    docs = docs.withColumn("range", _range(bounds)).repartition(max(1, -(-len(bounds) // 4)), "range")

    order = Window.partitionBy("range").orderBy(F.desc("order_id"), "text")
    placed = docs.withColumns({"place": F.row_number().over(order), "next": F.lead("text").over(order)})
    placed = placed.join(heads, "range", "left").withColumn("next", F.coalesce("next", "head")).drop("head")
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.left(F.col("text"), n - half), F.left(F.col("next"), half))
    rows = placed.select("range", "place", "order_id", "text", edited.alias("edited"), n.cast("long").alias("n_chars"))

    words = weighted_words(rows, ["range", "place"], ["text", "edited"])
    printed = weighted_samples(words, ["range", "place"], samples, {"fingerprint": "log_weight0", "edited_fingerprint": "log_weight1"})
    zeros = F.lit("0" * DIGITS * samples)
    # Both branches read the same columns of the texts, so that one shuffle serves both.
    about = rows.select("range", "place", "order_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"))
    table = about.join(printed, ["range", "place"], "left").withColumns({c: F.coalesce(c, zeros) for c in ("fingerprint", "edited_fingerprint")})
    table = scratch.save(table, "fp-rows")

    firsts = table.filter("place = 1").select(F.col("range").alias("next_range"), F.col("fingerprint").alias("first"))
    firsts = after.join(firsts, "next_range").select("range", "first")
    in_range = Window.partitionBy("range").orderBy("place")
    paired = table.withColumn("next", F.lead("fingerprint").over(in_range)).join(firsts, "range", "left")
    following = F.coalesce("next", "first")
    return paired.select(
        F.when(F.col("order_id") != lowest, F.col("order_id")).alias("doc_id"),
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint"), samples).alias("near_edited"),
        likeness(F.col("fingerprint"), following, samples).alias("near_next"),
    )


def op8_fingerprint_documents(spark, sf_dir: str) -> DataFrame:
    return fingerprint_neighbours(spark.read.parquet(f"{sf_dir}/documents.parquet"), samples=SAMPLES)
