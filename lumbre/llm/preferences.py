"""Preference formatting: one prompt and two masked completions from two conversations.

The longest common turn prefix of the chosen and the rejected conversation (equal role
and text, turn by turn) is rendered once as the prompt; what follows it in each is
rendered as its completion. A mask in run lengths goes with each completion: ``1xN``
are N characters to learn from (an assistant's words and the mark that ends its turn),
``0xN`` are N to read only (headers and other roles).

Defined results
    null text             the empty text
    null role             the role ``unknown``, never learned from
    null conversation id  each turn is a conversation of its own, without a partner
    repeated rows         kept as turns, ordered by turn, role and text
    equal conversations   everything is prompt; both completions and masks are empty
    no common turn        the prompt is empty
    empty table           no rows
    clashing names        only the named columns are read
A conversation is one record and is held as one row, as its rendering must be.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

END = "<|end|>\n"


def _turn(turn_col: str, role_col: str, text_col: str) -> Column:
    return F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("unknown")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def _alone(id_col: str) -> Column:
    """What keeps turns without an id apart: their own number, null for all others."""
    return F.when(F.col(id_col).isNull(), F.monotonically_increasing_id())


def conversations(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turns): the turns of each conversation as an array of (role, text)."""
    sorted_turns = F.array_sort(F.collect_list(_turn(turn_col, role_col, text_col)))
    pairs = F.transform(sorted_turns, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return turns.groupBy(F.col(id_col).alias("conv_id"), _alone(id_col).alias("_alone")).agg(pairs.alias("turns")).drop("_alone")


def common_turns(a: Column, b: Column) -> Column:
    """Length of the longest common prefix of two arrays of turns."""
    shorter = F.least(F.size(a), F.size(b))
    differs = F.filter(F.sequence(F.lit(0), F.greatest(shorter - 1, F.lit(0))), lambda i: ~F.get(a, i).eqNullSafe(F.get(b, i)))
    return F.least(F.coalesce(F.array_min(differs), shorter), shorter)


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit("<|"), t["role"], F.lit("|>\n"), t["text"], F.lit(END))), "")


def mask(turns: Column, learned: str) -> Column:
    def runs(t: Column) -> Column:
        head, body = F.length(t["role"]) + 5, F.length(t["text"]) + len(END)
        both = F.concat(F.lit("0x"), head.cast("string"), F.lit(",1x"), body.cast("string"))
        return F.when(t["role"] == learned, both).otherwise(F.concat(F.lit("0x"), (head + body).cast("string")))

    return F.array_join(F.transform(turns, runs), ",")


def format_preferences(pairs: DataFrame, id_col: str = "pair_id", learned: str = "assistant") -> DataFrame:
    """From (id, chosen, rejected), arrays of (role, text): id, common_turns, prompt, and
    completion and mask of both."""
    some = lambda c: F.coalesce(F.col(c), F.expr("CAST(array() AS ARRAY<STRUCT<role: STRING, text: STRING>>)"))
    rows = pairs.select(F.col(id_col), some("chosen").alias("chosen"), some("rejected").alias("rejected"))
    rows = rows.withColumn("common_turns", common_turns(F.col("chosen"), F.col("rejected")))
    n = F.col("common_turns")
    rest = lambda c: F.slice(F.col(c), n + 1, F.greatest(F.size(c) - n, F.lit(0)))
    return rows.select(
        F.col(id_col),
        n.cast("long").alias("common_turns"),
        rendered(F.slice(F.col("chosen"), 1, n)).alias("prompt"),
        rendered(rest("chosen")).alias("chosen"),
        mask(rest("chosen"), learned).alias("chosen_mask"),
        rendered(rest("rejected")).alias("rejected"),
        mask(rest("rejected"), learned).alias("rejected_mask"),
    )


def answer_pairs(turns: DataFrame) -> DataFrame:
    """(conv_id, chosen, rejected) for each conversation: as it is, and with its last
    assistant turn's words replaced by those of its partner's last assistant turn (ids 2k
    and 2k + 1 are partners). Without a partner's answer the turn is left out of the
    rejected conversation; without an own answer both are the conversation as it is.
    """
    side = F.col("conv_id").bitwiseAND(F.lit(1))
    keyed = turns.select(F.shiftright("conv_id", 1).alias("pair"), _alone("conv_id").alias("alone"), F.coalesce(side, F.lit(0).cast("long")).alias("side"), "conv_id", _turn("turn", "role", "text").alias("t"))
    # Partners meet in one group, so that one shuffle does.
    both = keyed.groupBy("pair", "alone").agg(*[F.array_sort(F.collect_list(F.when(F.col("side") == i, F.col("t")))).alias(f"turns{i}") for i in (0, 1)], *[F.max(F.when(F.col("side") == i, F.col("conv_id"))).alias(f"id{i}") for i in (0, 1)])

    def answer(c: str) -> Column:
        found = F.filter(F.sequence(F.lit(0), F.greatest(F.size(c) - 1, F.lit(0))), lambda i: F.get(F.col(c), i)["role"] == "assistant")
        return F.array_max(found)

    plain = lambda c: F.transform(c, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    both = both.select("id0", "id1", plain("turns0").alias("turns0"), plain("turns1").alias("turns1"))
    both = both.withColumns({f"last{i}": answer(f"turns{i}") for i in (0, 1)})
    sides = [F.struct(F.col(f"id{i}").alias("conv_id"), F.col(f"turns{i}").alias("turns"), F.col(f"last{i}").alias("last"), F.get(F.col(f"turns{1 - i}"), F.col(f"last{1 - i}"))["text"].alias("other")) for i in (0, 1)]
    each = both.select(F.explode(F.array(*sides)).alias("c")).select("c.*").filter(F.size("turns") > 0)
    swapped = F.transform(
        "turns", lambda t, i: F.when(i == F.col("last"), F.struct(t["role"].alias("role"), F.col("other").alias("text"))).otherwise(t)
    )
    cut = F.filter("turns", lambda t, i: i != F.col("last"))
    rejected = F.when(F.col("last").isNull(), F.col("turns")).when(F.col("other").isNull(), cut).otherwise(swapped)
    return each.select("conv_id", F.col("turns").alias("chosen"), rejected.alias("rejected"))


def op5_format_preferences(spark, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return format_preferences(answer_pairs(turns), "conv_id")


OP5_SQL = r"""
WITH t AS (SELECT conv_id, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS alone, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
c AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn, role, text) AS turns FROM t GROUP BY conv_id, alone),
l AS (SELECT conv_id, turns, list_max(list_filter(range(1, len(turns) + 1), lambda i: turns[i].role = 'assistant')) AS last FROM c),
p AS (SELECT l.conv_id, l.turns AS chosen, l.last, o.turns[o.last].text AS other
      FROM l LEFT JOIN l o ON o.conv_id = xor(l.conv_id, 1)),
r AS (SELECT conv_id, chosen, CASE WHEN last IS NULL THEN chosen
        WHEN other IS NULL THEN list_transform(list_filter(range(1, len(chosen) + 1), lambda i: i <> last), lambda i: chosen[i])
        ELSE list_transform(range(1, len(chosen) + 1), lambda i: CASE WHEN i = last THEN {'role': chosen[i].role, 'text': other} ELSE chosen[i] END)
        END AS rejected FROM p),
n AS (SELECT *, coalesce(list_min(list_filter(range(1, least(len(chosen), len(rejected)) + 1),
        lambda i: chosen[i].role <> rejected[i].role OR chosen[i].text <> rejected[i].text)) - 1, least(len(chosen), len(rejected))) AS n FROM r),
s AS (SELECT conv_id, n, list_filter(list_transform(range(1, len(chosen) + 1), lambda i: CASE WHEN i <= n THEN chosen[i] END), lambda x: x IS NOT NULL) AS pre,
        list_filter(list_transform(range(1, len(chosen) + 1), lambda i: CASE WHEN i > n THEN chosen[i] END), lambda x: x IS NOT NULL) AS ch,
        list_filter(list_transform(range(1, len(rejected) + 1), lambda i: CASE WHEN i > n THEN rejected[i] END), lambda x: x IS NOT NULL) AS rj FROM n)
SELECT conv_id, CAST(n AS BIGINT) AS common_turns,
  coalesce(list_aggregate(list_transform(pre, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)), 'string_agg', ''), '') AS prompt,
  coalesce(list_aggregate(list_transform(ch, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)), 'string_agg', ''), '') AS chosen,
  coalesce(list_aggregate(list_transform(ch, lambda t: CASE WHEN t.role = 'assistant' THEN '0x' || (length(t.role) + 5) || ',1x' || (length(t.text) + 8)
    ELSE '0x' || (length(t.role) + length(t.text) + 13) END), 'string_agg', ','), '') AS chosen_mask,
  coalesce(list_aggregate(list_transform(rj, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)), 'string_agg', ''), '') AS rejected,
  coalesce(list_aggregate(list_transform(rj, lambda t: CASE WHEN t.role = 'assistant' THEN '0x' || (length(t.role) + 5) || ',1x' || (length(t.text) + 8)
    ELSE '0x' || (length(t.role) + length(t.text) + 13) END), 'string_agg', ','), '') AS rejected_mask
FROM s
"""
