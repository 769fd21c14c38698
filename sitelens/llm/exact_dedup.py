"""Exact de-duplication by a Golomb-coded fingerprint exchange.

1. Every input partition normalises its texts, fingerprints them (64 bits) and
   splits its sorted distinct fingerprints by owner, an owner holding one range
   of the hash space.  Each list travels Golomb-Rice coded.
2. An owner decodes its lists, finds the fingerprints that more than one
   partition sent, and answers every list with a bitmap.
3. Rows whose bit is set, or whose fingerprint repeats inside their own
   partition, are suspects.  Only they take part in the byte verification:
   grouped by the whole normalised text, with map-side aggregation.

Fingerprints never decide: a group is a set of rows with equal normalised bytes,
which then go by their SHA-256.

Defined cases: null text is the empty text; empty texts form one group; rows
that repeat a ``doc_id`` are members in their own right (``kept`` is true for
each that carries the ``keep_id``); a null ``doc_id`` loses every tie; an empty
table gives an empty result.  Other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, slots, text_or_empty, whole_row

#: Fingerprints an owner holds, on average, at most.
OWNER_SIZE = 1 << 18
WHITESPACE = (" ", "\t", "\n", "\x0b", "\x0c", "\r")


def normalised(text: Column) -> Column:
    for ch in WHITESPACE:
        text = F.replace(text, F.lit(ch), F.lit(""))
    return text


def rice_encode(sorted_values: np.ndarray, low: int, width: int) -> tuple[int, bytes]:
    """Parameter and code of ascending uint64 values in [low, low + width).

    The unary quotients stand first, the fixed-width remainders behind them."""
    n = len(sorted_values)
    k = max(0, int(width // max(n, 1)).bit_length() - 1)
    gaps = np.diff(sorted_values, prepend=np.uint64(low))
    quotients = (gaps >> np.uint64(k)).astype(np.int64)
    ends = np.cumsum(quotients + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1 if n else 0, np.uint8)
    unary[ends] = 1
    shifts = np.arange(k - 1, -1, -1, dtype=np.uint64)
    rest = ((gaps[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel()
    return k, np.packbits(unary).tobytes() + np.packbits(rest).tobytes()


def rice_decode(code: bytes, n: int, k: int, low: int) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(code, np.uint8))
    tail = (n * k + 7) // 8 * 8
    ends = np.flatnonzero(bits[:len(bits) - tail])[:n]
    quotients = np.diff(ends, prepend=-1) - 1
    gaps = quotients.astype(np.uint64) << np.uint64(k)
    if k:
        rest = bits[len(bits) - tail:][:n * k].reshape(n, k).astype(np.uint64)
        gaps += (rest << np.arange(k - 1, -1, -1, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return np.cumsum(gaps, dtype=np.uint64) + np.uint64(low)


def owner_range(owner: int, owners: int) -> tuple[int, int]:
    """First value and width of an owner's part of the 64-bit space."""
    low = -(-(owner << 64) // owners)
    return low, -(-((owner + 1) << 64) // owners) - low


def owner_of(hashes: np.ndarray, owners: int) -> np.ndarray:
    lows = np.array([owner_range(o, owners)[0] for o in range(owners)], np.uint64)
    return np.searchsorted(lows, hashes, side="right") - 1


EXCHANGE_SCHEMA = ("kind string, doc_id bigint, digest string, part int, owner int, pos int, "
                   "again boolean, size int, k int, code binary")


def send(owners: int):
    """Per partition: its rows with their place in the lists, then the lists."""
    def run(batches):
        import pandas as pd
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        frames = [b for b in batches if len(b)]
        if not frames:
            return
        rows = pd.concat(frames, ignore_index=True)
        own = rows.pop("h").to_numpy(np.int64).view(np.uint64)
        values, place, count = np.unique(own, return_inverse=True, return_counts=True)
        owner = owner_of(values, owners)
        first = np.searchsorted(owner, np.arange(owners))
        rows["kind"], rows["part"] = "row", part
        rows["owner"] = owner[place]
        rows["pos"] = place - first[owner[place]]
        rows["again"] = count[place] > 1
        rows["size"] = rows["k"] = 0
        rows["code"] = None
        names = [c.split()[0] for c in EXCHANGE_SCHEMA.split(", ")]
        yield rows[names]
        lists = []
        for o in np.unique(owner):
            mine = values[first[o]:np.searchsorted(owner, o, "right")]
            low, width = owner_range(int(o), owners)
            k, code = rice_encode(mine, low, width)
            lists.append(("list", None, None, part, int(o), 0, False, len(mine), k, code))
        yield pd.DataFrame(lists, columns=names).astype({"doc_id": "Int64"})
    return run


def answer(owners: int):
    """Per owner: the bitmap of each list, a bit set where another list has the value."""
    def run(pdf):
        import pandas as pd
        low, _ = owner_range(int(pdf["owner"].iloc[0]), owners)
        lists = [rice_decode(c, n, k, low) for c, n, k in zip(pdf["code"], pdf["size"], pdf["k"], strict=True)]
        _, place, count = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
        flags = np.split(count[place] > 1, np.cumsum([len(x) for x in lists])[:-1])
        return pd.DataFrame({"part": pdf["part"], "owner": pdf["owner"],
                             "bitmap": [np.packbits(f).tobytes() for f in flags]})
    return run


def bit_at(bitmap: Column, pos: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(pos / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, 7 - pos % 8) == 1


def exact_groups(docs: DataFrame, fingerprint_bits: int = 64) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    With fewer ``fingerprint_bits`` more texts share a fingerprint (tests do so);
    the byte check then separates more suspects and the result is the same."""
    spark = docs.sparkSession
    spare = 64 - fingerprint_bits
    norm = normalised(text_or_empty())
    scan = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.sha2(norm, 256).alias("digest"),
                       F.shiftleft(F.shiftrightunsigned(F.xxhash64(norm), spare), spare).alias("h"))
    owners = max(slots(spark), -(-docs.count() // OWNER_SIZE))
    sent = materialize(scan.mapInPandas(send(owners), EXCHANGE_SCHEMA), "dedup-sent", by="kind")
    rows = sent.where("kind = 'row'").select("doc_id", "digest", "part", "owner", "pos", "again")
    bitmaps = (sent.where("kind = 'list'").select("part", "owner", "size", "k", "code")
               .groupBy("owner").applyInPandas(answer(owners), "part int, owner int, bitmap binary"))
    # the rows grow with the documents, Spark sizes them at an eighth: never broadcast
    marked = materialize(rows.hint("merge").join(bitmaps, ["part", "owner"]).select(
        "doc_id", "digest", (F.col("again") | bit_at(F.col("bitmap"), F.col("pos"))).alias("suspect")),
        "dedup-marked")

    # a doc_id is suspect with all its rows
    ids = marked.where("suspect").select(F.col("doc_id").alias("suspect_id")).distinct()
    is_suspect = F.col("doc_id").eqNullSafe(F.col("suspect_id"))
    held = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
            .join(ids, is_suspect, "left_semi")
            .select(normalised(F.col("text")).alias("norm"),
                    # ~id orders ids downwards without overflow; a null id comes last
                    F.struct(F.char_length("text").alias("n"), F.bitwise_not("doc_id").alias("down")).alias("rank")))
    groups = (held.groupBy("norm").agg(F.max("rank").alias("best"), F.count(F.lit(1)).alias("group_size"))
              .select(F.sha2("norm", 256).alias("digest"), "group_size", F.bitwise_not("best.down").alias("keep_id")))
    members = marked.join(ids, is_suspect, "left_semi").join(groups, "digest")
    alone = (marked.join(ids, is_suspect, "left_anti")
             .withColumn("keep_id", F.col("doc_id")).withColumn("group_size", F.lit(1).cast("bigint")))
    columns = ["doc_id", "keep_id", "group_size",
               F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("digest").alias("text_sha256")]
    return members.select(*columns).unionByName(alone.select(*columns))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one for each text, all columns kept whatever their
    names.  A row goes by its id and text, so a repeated or null id keeps or drops no
    other text; of rows with the id that stays the one with the most code points does, of
    equally long ones the one whose text comes first."""
    kept = (exact_groups(docs).where("kept").select(F.col("doc_id").alias("id"), F.col("text_sha256").alias("digest"))
            .distinct())
    rows = docs.select(whole_row(docs).alias("row"), F.col("doc_id").cast("bigint").alias("id"),
                       F.sha2(normalised(text_or_empty()), 256).alias("digest"), text_or_empty().alias("text"))
    both = rows.alias("r").join(kept.alias("k"), (F.col("r.digest") == F.col("k.digest"))
                                & F.col("r.id").eqNullSafe(F.col("k.id")), "left_semi")
    order = F.struct((-F.char_length("text")).alias("n"), "text")
    return both.groupBy("id", "digest").agg(F.min_by("row", order).alias("row")).select("row.*")
