"""Chat formatting: logged snapshots of a growing conversation collapse to the longest, which is rendered.

A conversation's turns are hashed in order into a rolling hash of each prefix (xor of 64-bit hashes of place, role and
text, two of them). A conversation whose whole hash is another one's hash at the same, not last, place is a prefix of
it; an anti-join drops it. Of equal conversations the one with the smallest id stays. Only hashes are compared and
shuffled for that; texts move once, for the conversations that stay.

Exact repeats of a row count once. Turns are ordered by number (null first), then by their hashes, so ties have one
order wherever they occur. Null roles and texts are told apart from empty ones, and rendered as empty. Nothing says that
rows without a conversation id belong together: each is a conversation of its own, of one turn. Other columns are ignored, whatever their names. No rows: no rows.

A conversation of more than ``RANGE`` rows is hashed on two levels: turns are ranked and hashed within ranges of their
order, each range a task's, and the counts and hashes of the ranges before are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetmart.session import materialize

#: Most rows of a conversation that one window takes.
RANGE = 1 << 16

BEGIN, END = "<|im_start|>", "<|im_end|>"


def _hash(salt: int) -> Column:
    return F.xxhash64(F.lit(salt), F.isnull("role"), "role", F.isnull("text"), "text")


def _turns(conversations: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """``key`` stands for the conversation and is never null, so joins and groups can share one shuffle."""
    told = conversations.select(
        F.col(conversation).alias("conversation"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text")
    )
    own = F.concat_ws(" ", F.lit("row"), F.coalesce(F.col("turn").cast("string"), F.lit("none")), _hash(1), _hash(2))
    key = F.coalesce(F.concat(F.lit("id "), F.col("conversation").cast("string")), own)
    return told.select(key.alias("key"), "conversation", "turn", "role", "text")


def _marks(turns: DataFrame) -> DataFrame:
    return turns.select("key", "conversation", "turn", _hash(1).alias("x"), _hash(2).alias("y")).distinct()


def _links(place: str) -> list[Column]:
    return [F.xxhash64(place, "x", "y"), F.xxhash64("y", place, "x")]


def _short_prefixes(turns: DataFrame) -> DataFrame:
    whole = W.partitionBy("key")
    order = whole.orderBy(F.col("turn").asc_nulls_first(), "x", "y")
    placed = _marks(turns).withColumn("place", F.row_number().over(order).cast("long")).withColumn("n_turns", F.count(F.lit(1)).over(whole))
    so_far = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    rolling = [F.bit_xor(link).over(so_far).alias(name) for link, name in zip(_links("place"), "ab", strict=True)]
    return placed.select("key", "conversation", "place", "n_turns", *rolling)


def _long_prefixes(turns: DataFrame, ranges: int) -> DataFrame:
    """The same for conversations of any length, by ranges of their turns."""
    order = [F.col("turn").asc_nulls_first(), F.col("x").asc(), F.col("y").asc()]
    dealt = _marks(turns).repartitionByRange(ranges, F.col("key").asc(), *order).withColumn("part", F.spark_partition_id())
    dealt = materialize(dealt, "ranges")  # fixes the ranges
    before = W.partitionBy("key").orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # over a row per range
    sizes = dealt.groupBy("key", "part").agg(F.count(F.lit(1)).alias("size"))
    sizes = sizes.select(
        "key", "part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("from"), F.sum("size").over(W.partitionBy("key")).alias("n_turns")
    )
    own = W.partitionBy("key", "part")
    ranked = dealt.withColumn("rank", F.row_number().over(own.orderBy(*order)))
    placed = ranked.join(F.broadcast(sizes), ["key", "part"]).withColumn("place", F.col("rank") + F.col("from"))
    placed = materialize(placed.select("key", "conversation", "part", "place", "n_turns", *[c.alias(n) for c, n in zip(_links("place"), "pq", strict=True)]), "places")
    sums = placed.groupBy("key", "part").agg(F.bit_xor("p").alias("p"), F.bit_xor("q").alias("q"))
    sums = sums.select("key", "part", *[F.coalesce(F.bit_xor(c).over(before), F.lit(0)).alias(f"{c}_before") for c in "pq"])
    so_far = own.orderBy("place").rowsBetween(W.unboundedPreceding, W.currentRow)
    rolling = placed.select("key", "conversation", "part", "place", "n_turns", *[F.bit_xor(c).over(so_far).alias(c) for c in "pq"])
    whole = [F.col(c).bitwiseXOR(F.col(f"{c}_before")).alias(name) for c, name in zip("pq", "ab", strict=True)]
    return rolling.join(F.broadcast(sums), ["key", "part"]).select("key", "conversation", "place", "n_turns", *whole)


def prefixes(turns: DataFrame) -> DataFrame:
    """(key, conversation, place, n_turns, a, b): the rolling hashes of every prefix."""
    # At most one key for RANGE rows, so few enough to be sent.
    long = materialize(turns.groupBy("key").count().where(F.col("count") > RANGE), "long_conversations")
    rows = long.agg(F.sum("count")).first()[0]
    if not rows:
        return _short_prefixes(turns)
    sent = F.broadcast(long.select("key"))
    ranges = min(rows // RANGE + 1, 4 * int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return _short_prefixes(turns.join(sent, "key", "left_anti")).unionByName(_long_prefixes(turns.join(sent, "key", "left_semi"), ranges))


def maximal(turns: DataFrame) -> DataFrame:
    """(key, n_turns) of the conversations that are no prefix of a longer one, one of each set of equals."""
    marks = prefixes(turns)
    first = F.min(F.struct(F.isnull("conversation"), "conversation", "key")).alias("first")
    ends = marks.where("place = n_turns").groupBy("n_turns", "a", "b").agg(first)
    inner = marks.where("place < n_turns").select(F.col("place").alias("n_turns"), "a", "b").distinct()
    return ends.join(inner, ["n_turns", "a", "b"], "left_anti").select(F.col("first.key").alias("key"), "n_turns")


def format_chats(
    conversations: DataFrame, begin: str = BEGIN, end: str = END,
    conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """(id, n_turns, text) of every maximal conversation, rendered turn by turn."""
    turns = _turns(conversations, conversation, turn, role, text)
    # The repeats of a row without an id share a key; one of each is enough.
    once = turns.where("conversation IS NOT NULL").unionByName(turns.where("conversation IS NULL").distinct())
    own = once.join(maximal(turns), "key")
    parts = F.sort_array(F.collect_set(F.struct("turn", _hash(1).alias("x"), _hash(2).alias("y"), "role", "text")))
    empty = F.lit("")
    shown = F.transform(
        parts, lambda t: F.concat(F.lit(begin), F.coalesce(t["role"], empty), F.lit("\n"), F.coalesce(t["text"], empty), F.lit(f"{end}\n"))
    )
    told = own.groupBy("key").agg(F.first("conversation").alias("id"), F.first("n_turns").alias("n_turns"), F.array_join(shown, "").alias("text"))
    return told.select(F.col("id").alias(conversation), "n_turns", "text")
