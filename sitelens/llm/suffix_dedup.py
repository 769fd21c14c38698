"""Removal of long repeats with a logarithmic family of suffix arrays.

A string of ``length`` bytes (a window) repeats if it starts at two places, in one
text or in two.  Every window has an anchor, the leftmost of its 16-byte grams with
the least hash, and lies in a segment of windows with one anchor.  Equal windows have
equal anchors at equal distances, so what surrounds the anchor in all windows of a
segment, its core, is equal too.

1. Pruning: segments whose core is nowhere else have no repeat.  Of the others, equal
   ones (bytes and distance from the anchor) are one entry, ``many`` if it stands at
   several places, whose windows then all repeat.
2. Entries that share a core with other entries are dealt by core over buckets and
   taken into an index family, batch by batch.  A batch gets a suffix array per
   bucket: its windows in byte order, in which repeats are neighbours.  It is
   merge-scanned against the array of each level; a window found there repeats, on
   both sides.  Then it becomes a level itself, and before the next batch levels of
   equal size are merged, so that n batches leave at most about log2(n) levels.
   Levels are tables in the shared folder, a row a bucket.
3. A core of more than ``hot`` entries doesn't go to one bucket: its segments are cut
   into shorter ones, which have longer cores, and start again at 1.; segments of a
   single window are equal or have nothing in common.
4. The repeated windows of a text are united into spans, which are removed.

Texts that are equal as a whole stand for one another and are removed whole, if they
have a window.  Every comparison of windows in 2. is one of all their bytes; segments
and texts are identified by 128 and 120 bits of a cryptographic hash.

Defined cases: null text is empty; texts shorter than a window have none; rows that
repeat are copies of each other, whatever their ids, and a null id is kept; a text of
any length is walked in chunks; an empty table gives an empty result.  Other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitelens.session import scratch_dir

from .common import materialize, text_or_empty

LENGTH, GRAM = 400, 16
#: Windows walked at once; the low bits of a gram's key hold its place.
CHUNK, PLACE_BITS = 1 << 19, 20
#: Entries of one core that may go to one bucket, windows of a bucket, batches of a run.
HOT, BUCKET_WINDOWS, BATCHES = 512, 49_152, 4

SEGMENTS = "core bigint, k1 bigint, k2 bigint, place bigint"
ENTRY = "e1 bigint, e2 bigint, core bigint, n int, delta int, body binary"
RUN = "bucket int, data binary, n binary, ids binary, sa binary, hits array<struct<e1:bigint,e2:bigint,first:int,last:int>>"


# --- segments -------------------------------------------------------------------

def anchors(data: np.ndarray, length: int) -> np.ndarray:
    """The anchor's place for each window of the bytes, at most ``CHUNK`` windows."""
    span = length - GRAM + 1
    words = np.ndarray((len(data) - 7,), "<u8", buffer=data.tobytes(), strides=(1,)).copy()
    key = words[:len(data) - GRAM + 1] * np.uint64(0x9E3779B97F4A7C15) ^ words[8:] * np.uint64(0xC2B2AE3D27D4EB4F)
    key = (key ^ (key >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    low = np.uint64((1 << PLACE_BITS) - 1)
    key = (key & ~low) | np.arange(len(key), dtype=np.uint64)
    windows = len(key) - span + 1
    # least key of each window: of the end of one block and the beginning of the next
    blocks = np.concatenate([key, np.full(-len(key) % span, ~np.uint64(0))]).reshape(-1, span)
    begin = np.minimum.accumulate(blocks, axis=1).ravel()
    end = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(end[:windows], begin[span - 1:span - 1 + windows]) & low).astype(np.int64)


def pieces(first: int, n: int, delta: int, width: int):
    """Cuts ``n`` windows, the first ``delta`` before its anchor, where the distance is a
    multiple of ``width``: ``(offset, n, delta, part)``."""
    done = 0
    while done < n:
        part = (delta - done) // width
        size = min(n - done, delta - done - part * width + 1)
        yield done, size, delta - done, part
        done += size


def core_hash(data, anchor: int, part: int, width: int, length: int) -> int:
    """Hash of the bytes that all windows of the part have around the anchor."""
    import xxhash
    near, far = part * width, min(part * width + width - 1, length - GRAM)
    return xxhash.xxh3_64_intdigest(data[anchor - near:anchor - far + length], seed=part)


def segments(data: bytes, length: int):
    """``(core, first window, windows, distance of the first to its anchor)`` of a text."""
    width, view = length // 2 + 1, memoryview(data)
    whole = np.frombuffer(data, np.uint8)
    for low in range(0, max(0, len(data) - length + 1), CHUNK):
        chunk = whole[low:low + CHUNK + length - 1]
        at = anchors(chunk, length)
        starts = np.flatnonzero(np.diff(at, prepend=-1))
        for first, n, anchor in zip(starts.tolist(), np.diff(starts, append=len(at)).tolist(), at[starts].tolist(), strict=True):
            for offset, size, delta, part in pieces(first, n, anchor - first, width):
                yield core_hash(view, low + anchor, part, width, length), low + first + offset, size, delta


def scan(length: int):
    """Per partition the segments of its texts, equal texts once."""
    def run(batches):
        import pyarrow as pa
        seen = set()
        for batch in batches:
            cores, places, owners = [], [], []
            for k1, k2, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if (k1, k2) in seen or len(text) * 4 < length:
                    continue
                seen.add((k1, k2))
                data = text.encode()
                if len(data) < length:
                    continue
                for core, first, n, delta in segments(data, length):
                    cores.append(core)
                    places.append(first << 24 | n << 12 | delta)
                    owners.append((k1, k2))
                if len(cores) > 1 << 17:
                    yield rows(pa, cores, places, owners)
                    cores, places, owners = [], [], []
            if cores:
                yield rows(pa, cores, places, owners)

    def rows(pa, cores, places, owners):
        keys = np.array(owners, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.array(cores, np.uint64).view(np.int64)), pa.array(keys[:, 0].copy()),
                                           pa.array(keys[:, 1].copy()), pa.array(np.array(places, np.int64))],
                                          names=["core", "k1", "k2", "place"])
    return run


def entry_id(body: bytes, delta: int) -> tuple[int, int]:
    code = hashlib.blake2b(body, digest_size=16, salt=delta.to_bytes(8, "big")).digest()
    return tuple(np.frombuffer(code, np.int64).tolist())


def cut_out(length: int):
    """The suspect segments of texts: a row a place, with the bytes where the task meets them first."""
    def run(batches):
        import pandas as pd
        seen = set()
        for batch in batches:
            out = []
            for k1, k2, text, parts in zip(batch["k1"], batch["k2"], batch["text"], batch["parts"], strict=True):
                data = text.encode()
                for part in parts:
                    first, n, delta = part["place"] >> 24, part["place"] >> 12 & 4095, part["place"] & 4095
                    body = data[first:first + n - 1 + length]
                    e1, e2 = entry_id(body, delta)
                    out.append((e1, e2, part["core"], n, delta, None if (e1, e2) in seen else body, k1, k2, first))
                    seen.add((e1, e2))
                if len(out) > 1 << 14:
                    yield pd.DataFrame(out, columns=CUT_COLUMNS)
                    out = []
            if out:
                yield pd.DataFrame(out, columns=CUT_COLUMNS)
    return run


CUT = ENTRY + ", k1 bigint, k2 bigint, first bigint"
CUT_COLUMNS = [c.split()[0] for c in CUT.split(", ")]


# --- the index family -----------------------------------------------------------

class Run:
    """The entries of a bucket and the suffix array of their different windows."""

    def __init__(self, data: bytes, n: np.ndarray, ids: np.ndarray, sa: np.ndarray, length: int):
        self.data, self.n, self.ids, self.sa, self.length = data, n, ids, sa, length
        self.begins = np.concatenate([[0], np.cumsum(n + length - 1)[:-1]]).astype(np.int64)

    @classmethod
    def read(cls, row, length: int) -> Run:
        return cls(row["data"], np.frombuffer(row["n"], np.int64), np.frombuffer(row["ids"], np.int64).reshape(-1, 2),
                   np.frombuffer(row["sa"], np.int64), length)

    def places(self) -> np.ndarray:
        """Where each window of the entries begins in ``data``."""
        before = np.cumsum(self.n) - self.n
        return np.repeat(self.begins - before, self.n) + np.arange(int(self.n.sum()))

    def windows(self, places: np.ndarray) -> np.ndarray:
        """The bytes of windows; all are of one length, so padding can't make two equal."""
        data = np.frombuffer(self.data, np.uint8)
        view = np.lib.stride_tricks.sliding_window_view(data, self.length)
        return np.ascontiguousarray(view[places]).view(f"S{self.length}").ravel()

    def hits(self, places: np.ndarray) -> list[tuple[int, int, int, int]]:
        """Repeated windows as ``(e1, e2, first, last)``."""
        if not len(places):
            return []
        places = np.unique(places)
        entry = np.searchsorted(self.begins, places, side="right") - 1
        new = np.ones(len(places), bool)
        new[1:] = (np.diff(places) != 1) | (np.diff(entry) != 0)
        at = np.flatnonzero(new)
        last = np.append(at[1:], len(places)) - 1
        base = self.begins[entry[at]]
        return list(zip(self.ids[entry[at], 0].tolist(), self.ids[entry[at], 1].tolist(),
                        (places[at] - base).tolist(), (places[last] - base).tolist(), strict=True))

    def row(self, bucket: int, hits: list) -> tuple:
        return (bucket, self.data, self.n.tobytes(), self.ids.tobytes(), self.sa.tobytes(), hits)


def build(length: int):
    """The run of a batch's entries in one bucket, and their repeats among each other."""
    def run(pdf):
        import pandas as pd
        made = Run(b"".join(pdf["body"]), pdf["n"].to_numpy(np.int64), pdf[["e1", "e2"]].to_numpy(np.int64),
                   np.zeros(0, np.int64), length)
        places = made.places()
        windows = made.windows(places)
        order = np.argsort(windows, kind="stable")
        places = places[order]
        same = np.concatenate([windows[order[k + 1:k + 4097]] == windows[order[k:k + 4096][:len(order) - k - 1]]
                               for k in range(0, max(1, len(order) - 1), 4096)])
        repeated = np.concatenate([places[1:][same], places[:-1][same]])
        made.sa = places[np.concatenate([[True], ~same])]
        return pd.DataFrame([made.row(int(pdf["bucket"].iloc[0]), made.hits(repeated))], columns=RUN_COLUMNS)
    return run


RUN_COLUMNS = ["bucket", "data", "n", "ids", "sa", "hits"]


def scan_levels(length: int):
    """Merge-scan of a batch's run against a level's: the repeats on both sides."""
    def run(batches):
        import pandas as pd
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                new = Run.read(row, length)
                old = Run.read({k: row[f"old_{k}"] for k in ("data", "n", "ids", "sa")}, length)
                mine, theirs = new.windows(new.sa), old.windows(old.sa)
                at = np.searchsorted(theirs, mine)
                found = theirs[np.minimum(at, len(theirs) - 1)] == mine
                out += new.hits(new.sa[found]) + old.hits(old.sa[at[found]])
            yield pd.DataFrame(out, columns=["e1", "e2", "first", "last"])
    return run


def merge_runs(length: int):
    """Two levels' runs as one; a window of both stays once."""
    def run(batches):
        import pandas as pd
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                runs = [Run.read({k: row[p + k] for k in ("data", "n", "ids", "sa")}, length)
                        for p in ("", "old_") if row[p + "data"] is not None]
                made = runs[0]
                if len(runs) == 2:
                    a, b = (r.windows(r.sa) for r in runs)
                    at = np.searchsorted(a, b)
                    other = a[np.minimum(at, len(a) - 1)] != b
                    sa = np.insert(runs[0].sa, at[other], runs[1].sa[other] + len(runs[0].data))
                    made = Run(runs[0].data + runs[1].data, np.concatenate([r.n for r in runs]),
                               np.concatenate([r.ids for r in runs]), sa, length)
                out.append(made.row(row["bucket"], []))
            yield pd.DataFrame(out, columns=RUN_COLUMNS)
    return run


class IndexFamily:
    """Suffix arrays in levels of 1, 2, 4 ... batches, stored in the shared folder."""

    def __init__(self, spark, length: int = LENGTH):
        self.spark, self.length = spark, length
        self.levels: list[tuple[int, str]] = []         # (batches, folder), the largest first

    def _store(self, runs: DataFrame) -> str:
        path = scratch_dir(self.spark, "suffix-level")
        runs.write.option("compression", "zstd").parquet(path)
        return path

    def _read(self, path: str) -> DataFrame:
        return self.spark.read.schema(RUN).parquet(path)

    def _drop(self, path: str) -> None:
        sc = self.spark.sparkContext
        folder = sc._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)

    def _beside(self, runs: DataFrame, path: str, how: str) -> DataFrame:
        old = self._read(path).drop("hits")
        old = old.select("bucket", *[F.col(c).alias(f"old_{c}") for c in ("data", "n", "ids", "sa")])
        return runs.join(old, "bucket", how)

    def _merge_equal(self) -> None:
        """Geometric merging: of two levels of equal size becomes one of twice the size."""
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (size, newer), (_, older) = self.levels.pop(), self.levels.pop()
            both = self._beside(self._read(newer), older, "full_outer")
            self.levels.append((2 * size, self._store(both.mapInPandas(merge_runs(self.length), RUN))))
            self._drop(newer)
            self._drop(older)

    def add(self, entries: DataFrame) -> DataFrame:
        """Takes ``entries(bucket, e1, e2, n, body)`` in; returns the repeated windows
        ``e1, e2, first, last``, of these entries and of earlier ones that they repeat."""
        self._merge_equal()
        path = self._store(entries.groupBy("bucket").applyInPandas(build(self.length), RUN))
        new = self._read(path)
        found = new.select(F.explode("hits").alias("h")).select("h.*")
        for _, level in self.levels:
            pairs = self._beside(new.drop("hits"), level, "inner")
            found = found.unionByName(pairs.mapInPandas(scan_levels(self.length), HITS))
        found = materialize(found, "suffix-hits")
        self.levels.append((1, path))
        return found

    def close(self) -> None:
        """Deletes the levels."""
        while self.levels:
            self._drop(self.levels.pop()[1])


HITS = "e1 bigint, e2 bigint, first int, last int"


# --- repeats of entries ---------------------------------------------------------

def united(found: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, ranges``: an entry's ranges of windows as an array of ``(first, last)``,
    those that touch united, so that joins with its places don't multiply them."""
    lists = found.groupBy(*keys).agg(F.array_sort(F.collect_set(F.struct("first", "last"))).alias("all"))

    def add(done, r):
        end = F.element_at(done, -1)
        grown = F.concat(F.slice(done, F.lit(1), F.size(done) - 1),
                         F.array(F.struct(end["first"].alias("first"), F.greatest(end["last"], r["last"]).alias("last"))))
        return F.when((F.size(done) > 0) & (r["first"] <= F.try_element_at(done, F.lit(-1))["last"] + 1), grown).otherwise(
            F.concat(done, F.array(r)))
    nothing = F.array().cast("array<struct<first:int,last:int>>")
    return lists.select(*keys, F.aggregate("all", nothing, add).alias("ranges"))


def refine(length: int, width: int):
    """Entries cut at multiples of ``width`` from their anchor."""
    def run(batches):
        import pandas as pd
        columns = ["f1", "f2", "core", "n", "delta", "body", "e1", "e2", "at"]
        for batch in batches:
            out = []
            for r in batch.itertuples():
                for offset, n, delta, part in pieces(0, int(r.n), int(r.delta), width):
                    core = core_hash(memoryview(r.body), int(r.delta), part, width, length)
                    body = r.body[offset:offset + n - 1 + length]
                    # a single window's hash says all
                    out.append((*entry_id(body, delta), core - (core >> 63 << 64), n, delta,
                                body if width > 1 else b"", r.e1, r.e2, offset))
                if len(out) > 1 << 14:
                    yield pd.DataFrame(out, columns=columns)
                    out = []
            yield pd.DataFrame(out, columns=columns)
    return run


def repeats(entries: DataFrame, length: int, hot: int, batches: int, widths: tuple[int, ...]) -> DataFrame:
    """Repeated windows ``e1, e2, first, last`` of different
    ``entries(e1, e2, core, n, delta, body, many)``, some twice."""
    spark = entries.sparkSession
    shared = materialize(entries.groupBy("core").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("windows"))
                         .where("m > 1"), "suffix-cores")
    whole = entries.where("many").select("e1", "e2", F.lit(0).alias("first"), (F.col("n") - 1).alias("last"))
    out = [whole]
    apart = F.col("m") > hot if widths else F.lit(False)
    windows = shared.where(~apart).agg(F.sum("windows")).first()[0] or 0
    buckets = -(-windows // BUCKET_WINDOWS)
    if buckets:
        dealt = materialize(
            entries.join(shared.where(~apart).select("core"), "core", "left_semi")
            .select(F.pmod("core", F.lit(buckets)).cast("int").alias("bucket"),
                    F.pmod(F.xxhash64("e1", "e2"), F.lit(batches)).cast("int").alias("batch"), "e1", "e2", "n", "body"),
            "suffix-batches", by="batch")
        family = IndexFamily(spark, length)
        out += [family.add(dealt.where(F.col("batch") == b)) for b in range(batches)]
        family.close()
    if widths and not shared.where(apart).isEmpty():
        # dealt out anew, as the join brings a core's entries together
        cut = entries.join(shared.where(apart).select("core"), "core", "left_semi").repartition("e1", "e2")
        places = materialize(cut.mapInPandas(refine(length, widths[0]),
                                             "f1 bigint, f2 bigint, core bigint, n int, delta int, body binary, "
                                             "e1 bigint, e2 bigint, at int")
                             .join(entries.select("e1", "e2", "many"), ["e1", "e2"]), "suffix-pieces")
        spot = F.xxhash64("e1", "e2", "at")
        several = (places.groupBy("f1", "f2")
                   .agg((F.max("many") | (F.min(spot) != F.max(spot))).alias("many")))
        if widths[0] == 1:
            found = several.where("many").select("f1", "f2", F.lit(0).alias("first"), F.lit(0).alias("last"))
        else:
            one = places.drop("many", "e1", "e2", "at").dropDuplicates(["f1", "f2"]).join(several, ["f1", "f2"])
            one = materialize(one.withColumnsRenamed({"f1": "e1", "f2": "e2"}), "suffix-pieces")
            found = repeats(one, length, hot, batches, widths[1:]).withColumnsRenamed({"e1": "f1", "e2": "f2"})
        found = materialize(united(found, ["f1", "f2"]), "suffix-found")
        out.append(places.select("f1", "f2", "e1", "e2", "at").join(found, ["f1", "f2"])
                   .select("e1", "e2", "at", F.explode("ranges").alias("r"))
                   .select("e1", "e2", (F.col("at") + F.col("r.first")).alias("first"),
                           (F.col("at") + F.col("r.last")).alias("last")))
    both = out[0]
    for more in out[1:]:
        both = both.unionByName(more)
    return both


# --- spans ----------------------------------------------------------------------

def remove(batches):
    """Unites the repeated ranges of each text and takes them out."""
    import pandas as pd
    for batch in batches:
        out = []
        for k1, k2, text, ranges in zip(batch["k1"], batch["k2"], batch["text"], batch["ranges"], strict=True):
            data, spans, kept, end = text.encode(), [], hashlib.sha256(), 0
            for begin, stop in sorted((r["begin"], r["stop"]) for r in ranges):
                if spans and begin <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], stop)
                else:
                    spans.append([begin, stop])
            for begin, stop in spans:
                kept.update(data[end:begin])
                end = stop
            kept.update(data[end:])
            out.append((k1, k2, sum(b - a for a, b in spans), spans, kept.hexdigest()))
        yield pd.DataFrame(out, columns=["k1", "k2", "n_removed", "spans", "kept_sha256"])


def text_keys(text: Column) -> list[Column]:
    """Two halves of 120 bits of the text's SHA-256."""
    code = F.sha2(text, 256)
    return [F.conv(F.substring(code, a, 15), 16, 10).cast("bigint").alias(k) for k, a in (("k1", 1), ("k2", 16))]


def removed_spans(docs: DataFrame, length: int = LENGTH, hot: int = HOT, batches: int = BATCHES) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_bytes, n_removed, spans`` (byte ranges, the ends
    exclusive) and ``kept_sha256`` of the remaining bytes."""
    if length < 2 * GRAM or length > 4095:
        raise ValueError(f"length must be {2 * GRAM} to 4095")
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    keyed = keyed.select("doc_id", "text", *text_keys(F.col("text")))
    texts = keyed.select("k1", "k2", "text")
    cores = materialize(texts.mapInArrow(scan(length), SEGMENTS), "suffix-segments")
    spot = F.xxhash64("k1", "k2", "place")
    again = materialize(cores.groupBy("core").agg(F.min(spot).alias("a"), F.max(spot).alias("b"))
                        .where("a <> b").select("core"), "suffix-again")
    suspects = (cores.join(again, "core", "left_semi").groupBy("k1", "k2")
                .agg(F.collect_set(F.struct("core", "place")).alias("parts")))
    held = materialize(texts.groupBy("k1", "k2").agg(F.first("text").alias("text")).join(suspects, ["k1", "k2"]),
                       "suffix-texts")
    cut = materialize(held.mapInPandas(cut_out(length), CUT), "suffix-cut")
    spot = F.xxhash64("k1", "k2", "first")
    several = cut.groupBy("e1", "e2").agg((F.min(spot) != F.max(spot)).alias("many"))
    entries = materialize(cut.where(F.col("body").isNotNull()).dropDuplicates(["e1", "e2"])
                          .select("e1", "e2", "core", "n", "delta", "body").join(several, ["e1", "e2"]), "suffix-entries")
    narrow = max(2, length // 16)
    found = materialize(united(repeats(entries, length, hot, batches, (narrow, 1)), ["e1", "e2"]), "suffix-repeats")
    ranges = (cut.select("e1", "e2", "k1", "k2", F.col("first").alias("begin")).join(found, ["e1", "e2"])
              .select("k1", "k2", "begin", F.explode("ranges").alias("r"))
              .select("k1", "k2", (F.col("begin") + F.col("r.first")).alias("begin"),
                      (F.col("begin") + F.col("r.last") + length).alias("stop"))
              .groupBy("k1", "k2").agg(F.collect_set(F.struct("begin", "stop")).alias("ranges")))
    cleaned = held.drop("parts").join(ranges, ["k1", "k2"]).mapInPandas(
        remove, "k1 bigint, k2 bigint, n_removed bigint, spans array<array<bigint>>, kept_sha256 string")
    rows = keyed.select("doc_id", "k1", "k2", F.octet_length("text").cast("bigint").alias("n_bytes"),
                        F.sha2("text", 256).alias("sha"))
    copies = (rows.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("copies"), F.min("n_bytes").alias("size"))
              .where((F.col("copies") > 1) & (F.col("size") >= length))
              .select("k1", "k2", F.col("size").alias("n_removed"),
                      F.array(F.array(F.lit(0).cast("bigint"), F.col("size"))).alias("spans"),
                      F.sha2(F.lit(b""), 256).alias("kept_sha256")))
    changed = materialize(copies.unionByName(cleaned.join(copies.select("k1", "k2"), ["k1", "k2"], "left_anti")),
                          "suffix-changed")
    return rows.join(changed, ["k1", "k2"], "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("spans", F.array().cast("array<array<bigint>>")).alias("spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"))
