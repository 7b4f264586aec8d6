"""Joins that stay even when a few keys hold most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkdex import session

# A key counts as hot when it holds at least this share of all rows, so at most HOT_KEYS keys are
# hot whatever the data. Their total length is bounded in the same way: every hot key is stored in
# at least one HOT_KEYS-th of the rows, so all of them together are no longer than HOT_KEYS keys of
# average length.
HOT_KEYS = 50_000


def join_by_weight(rows: DataFrame, keyed: DataFrame, key: str, weight: str, hot_keys: int = HOT_KEYS) -> DataFrame:
    """Inner join of ``rows`` with a stored table of one row per key.

    ``weight`` is a column of ``keyed``: how many of ``rows`` hold the key. Hot keys are joined by
    broadcast where their rows lie, so the rows of the commonest keys are not exchanged at all; the
    others go through an ordinary join in which no key holds more than one ``hot_keys``-th of the
    rows. ``rows`` is read twice then, so it should be a stored table too. If there are no more than
    ``hot_keys`` keys in all, they are broadcast and ``rows`` is read once.
    """
    # Bytes of whole rows: texts and lists by their length, other values as eight.
    texts = [c for c, kind in keyed.dtypes if kind in ("string", "binary")]
    lists = [c for c, kind in keyed.dtypes if kind.startswith(("array", "struct", "map"))]
    wide = [F.coalesce(F.octet_length(c), F.lit(0)) for c in texts]
    wide += [F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)) for c in lists]
    length = F.sum(sum(wide, F.lit(8 * len(keyed.columns))).cast("bigint"))
    sizes = keyed.agg(F.sum(weight).alias("total"), F.count(F.lit(1)).alias("keys"), length.alias("bytes")).first()
    if sizes["keys"] <= hot_keys and (sizes["bytes"] or 0) <= session.BROADCAST_BYTES:
        return rows.join(F.broadcast(keyed), key)
    # Of wide rows fewer are hot, so that the hot ones are no longer than a broadcast may be.
    average = max((sizes["bytes"] or 0) // max(sizes["keys"], 1), 1)
    least = -(-sizes["total"] // max(min(hot_keys, session.BROADCAST_BYTES // average), 1))
    hot, cold = keyed.where(F.col(weight) >= least), keyed.where(F.col(weight) < least)
    common = rows.join(F.broadcast(hot), key)
    rare = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return common.unionByName(rare.join(cold, key))


def join_at_documents(rows: DataFrame, wanted: DataFrame, few: bool) -> DataFrame:
    """Inner join of ``rows`` by term and document with ``wanted``, a stored table of these two columns and others.

    A table that is ``few`` is broadcast. Of a larger one the documents are, so that of ``rows`` only those of
    these documents are exchanged; both sides are exchanged as they are only if not even the ids fit a broadcast.
    """
    if few:
        return rows.join(session.side(wanted, few), ["term", "doc_id"])
    ids, few_ids = session.settle_sized(wanted.select("doc_id").distinct(), "ids")
    if few_ids:
        rows = rows.join(F.broadcast(ids), "doc_id", "left_semi")
    return rows.join(session.side(wanted, few), ["term", "doc_id"])


# Rows per side and key that one group of a join by blocks holds.
BLOCK_ROWS = 10_000


def join_blocks(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_rows: tuple[str, str],
    right_rows: tuple[str, str],
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Many-to-many inner join in which no group is large on either side.

    Each side is given as (rows of the key on that side, column to divide them by); both sides have
    the two counts as columns. A key of many rows is cut into blocks by hash, and every block meets
    every block of the other side in a group of its own.
    """

    def blocks(count: str):
        return F.greatest(F.ceil(F.col(count) / block_rows), F.lit(1)).cast("bigint")

    def divided(rows: DataFrame, own: tuple[str, str], own_name: str, other: tuple[str, str], other_name: str) -> DataFrame:
        mine = F.pmod(F.xxhash64(own[1]), blocks(own[0])).alias(own_name)
        theirs = F.explode(F.sequence(F.lit(0).cast("bigint"), blocks(other[0]) - 1)).alias(other_name)
        return rows.select("*", mine, theirs)

    a = divided(left, left_rows, "left_block", right_rows, "right_block")
    b = divided(right, right_rows, "right_block", left_rows, "left_block").drop(left_rows[0], right_rows[0])
    return a.join(b, [key, "left_block", "right_block"]).drop("left_block", "right_block")
