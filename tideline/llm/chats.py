"""Chat formatting (operator 5), with DataFrame functions only: snapshots that begin longer conversations go.

A conversation logged after every turn leaves many snapshots. Every turn has a hash of its place, role
and text; the running combination of a conversation's hashes names each of its prefixes. What equals
a proper prefix of another conversation is dropped, of equal conversations the least conv_id stays, and
the rest is rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TURNS_PER_CHUNK = 64  # turns that one window orders
TURNS_PER_PART = 512  # turns of one rendered row

# Fixed values of the format: a header with the role, the text, an end mark.
_HEAD, _MIDDLE, _TAIL = "<|im_start|>", "\n", "<|im_end|>\n"


def _marked(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def _ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (1, 2, ...), role, text: repeated rows once, ordered by turn, then role and text.

    A conversation is numbered in chunks of turn numbers, so that no task orders a long one alone.
    """
    turns = conversations.where("conv_id is not null").select("conv_id", "turn", "role", "text").distinct()
    chunked = turns.withColumn("chunk", F.coalesce(F.floor(F.col("turn") / TURNS_PER_CHUNK), F.lit(-(1 << 62))))
    sizes = chunked.groupBy("conv_id", "chunk").agg(F.count("*").alias("n"))
    before = sizes.withColumn("before", F.sum("n").over(Window.partitionBy("conv_id").orderBy("chunk")) - F.col("n")).drop("n")
    order = Window.partitionBy("conv_id", "chunk").orderBy(F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    placed = chunked.withColumn("inside", F.row_number().over(order)).join(before, ["conv_id", "chunk"])
    return placed.select("conv_id", "chunk", (F.col("before") + F.col("inside")).alias("place"), "role", "text")


def _prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, place and the 128-bit hash (hi, lo) of the conversation's first `place` turns."""

    def turn_hash(seed: int) -> Column:
        return F.xxhash64(F.lit(seed), "place", F.col("role").isNull(), "role", F.col("text").isNull(), "text")

    hashed = turns.select("conv_id", "chunk", "place", turn_hash(1).alias("hi"), turn_hash(2).alias("lo"))
    sums = hashed.groupBy("conv_id", "chunk").agg(F.bit_xor("hi").alias("chunk_hi"), F.bit_xor("lo").alias("chunk_lo"))
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("conv_id", "chunk", *[F.coalesce(F.bit_xor(f"chunk_{x}").over(earlier), F.lit(0)).alias(f"before_{x}") for x in ("hi", "lo")])
    inside = Window.partitionBy("conv_id", "chunk").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    running = hashed.select("conv_id", "chunk", "place", *[F.bit_xor(x).over(inside).alias(x) for x in ("hi", "lo")])
    return running.join(before, ["conv_id", "chunk"]).select("conv_id", "place", *[F.col(x).bitwiseXOR(F.col(f"before_{x}")).alias(x) for x in ("hi", "lo")])


def maximal(conversations: DataFrame, scratch: str) -> tuple[DataFrame, DataFrame]:
    """(conv_id and copies of the conversations that no other one continues, all ordered turns)."""
    spark = conversations.sparkSession
    _ordered_turns(conversations).write.parquet(f"{scratch}/turns")
    turns = spark.read.parquet(f"{scratch}/turns")
    _prefixes(turns).write.parquet(f"{scratch}/prefixes")
    prefixes = spark.read.parquet(f"{scratch}/prefixes")
    lengths = prefixes.groupBy("conv_id").agg(F.max("place").alias("n"))
    ends = prefixes.join(lengths, "conv_id")
    whole = ends.where("place = n").groupBy("n", "hi", "lo").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("copies"))
    inner = ends.where("place < n").select(F.col("place").alias("n"), "hi", "lo").distinct()
    return whole.join(inner, ["n", "hi", "lo"], "left_anti").select("conv_id", F.col("n").alias("n_turns"), "copies"), turns


def rendered(turn: Column, role: Column, text: Column) -> Column:
    return F.struct(turn.alias("place"), F.concat(F.lit(_HEAD), role, F.lit(_MIDDLE), text, F.lit(_TAIL)).alias("shown"))


def format_chats(conversations: DataFrame, scratch: str) -> DataFrame:
    """conv_id, n_turns, copies, part, text of every maximal conversation (conv_id, turn, role, text; other columns are left out).

    Part k holds the turns from 512 k + 1 on, so that a conversation of any length is rendered in bounded rows;
    its parts one after another are the whole. Repeated rows count once; turns of one number are ordered by role
    and text, a null turn comes first. Null roles and texts are rendered empty, but differ from empty
    ones when conversations are compared. Rows without conv_id belong to no conversation and are left out.
    `copies` counts equal conversations. Tables in between are written below `scratch`, on shared storage.
    """
    kept, turns = maximal(conversations, scratch)
    shown = turns.join(kept, "conv_id").select(
        "conv_id", "n_turns", "copies", F.floor((F.col("place") - 1) / TURNS_PER_PART).cast("int").alias("part"), rendered(F.col("place"), _marked("role"), _marked("text")).alias("turn")
    )
    parts = shown.groupBy("conv_id", "n_turns", "copies", "part").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    return parts.select("conv_id", "n_turns", "copies", "part", F.array_join(F.transform("turns", lambda t: t["shown"]), "").alias("text"))


SQL = f"""
WITH turns AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS place FROM turns),
whole AS (SELECT conv_id, count(*) AS n_turns,
  list(CASE WHEN role IS NULL THEN 'n' ELSE 'r' || role END || chr(31) || CASE WHEN text IS NULL THEN 'n' ELSE 't' || text END ORDER BY place) AS said FROM placed GROUP BY conv_id),
once AS (SELECT min(conv_id) AS conv_id, n_turns, said, count(*) AS copies FROM whole GROUP BY n_turns, said),
inner_ AS (SELECT DISTINCT said[1:k] AS said FROM (SELECT said, unnest(range(1, n_turns)) AS k FROM once)),
kept AS (SELECT conv_id, n_turns, copies FROM once o WHERE NOT EXISTS (SELECT 1 FROM inner_ i WHERE i.said = o.said))
SELECT k.conv_id, k.n_turns, k.copies, ((p.place - 1) // {TURNS_PER_PART})::INTEGER AS part,
  string_agg('{_HEAD}' || coalesce(p.role, '') || chr(10) || coalesce(p.text, '') || '<|im_end|>' || chr(10), '' ORDER BY p.place) AS text
FROM kept k JOIN placed p USING (conv_id) GROUP BY 1, 2, 3, 4
"""
