"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints of 64 bits are made from word shingles.  Over the distinct
fingerprints:

1. Bits that correlate over the corpus are grouped into four blocks of 16; the
   exact number of fingerprint pairs at each distance within a block follows
   from the block's histogram (an XOR autocorrelation).
2. Blocks are merged to 1-4 parts.  Parts get thresholds ``t_i >= -1`` with
   ``sum(t_i) = max_distance - parts + 1``: two fingerprints within
   ``max_distance`` are then within ``t_i`` in some part.  Dynamic programming
   picks the thresholds, and the number of parts, of least estimated cost;
   -1 leaves a part out.
3. Each fingerprint probes the part values within ``t_i`` of its own; pairs that
   meet are verified on all 64 bits.  No pair within the distance is lost.

Documents with equal fingerprints never form pairs: only distinct fingerprints
are compared.  Components come from the links between them.

Defined cases: null and empty texts and texts without words have fingerprint
zero, which links like any other; fewer words than a shingle are one shingle; a
component of rows without any ``doc_id`` has a null ``component_id``; an empty
table gives an empty result.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_or_empty, whole_row
from .components import connected_components

BITS, BLOCK, HASH_SEED = 64, 16, 42
#: Cost of one candidate pair in probes: it carries two fingerprints and gathers in hot buckets.
CANDIDATE_COST = 16


def fingerprint(text: str | None, shingle: int) -> int:
    """The fingerprint as an unsigned integer."""
    from xxhash import xxh64_intdigest as xxh64
    words = (text or "").encode().lower().split()      # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    shingle = min(shingle, len(words))
    joined = b" ".join(words)
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    total, ones = len(words) - shingle + 1, np.zeros(BITS, np.int64)
    for at in range(0, total, 1 << 15):
        spans = zip(starts[at:min(at + (1 << 15), total)], ends[at + shingle - 1:], strict=False)
        h = np.array([xxh64(joined[s:e - 1], HASH_SEED) for s, e in spans], ">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """``(doc_id, fp)`` of every row; ``fp`` holds the bits as a signed long."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       fingerprint_of(shingle)(text_or_empty()).alias("fp"))


def fingerprint_of(shingle: int):
    """The fingerprint of a text column, as a signed long."""
    @F.pandas_udf("bigint")
    def of(texts: pd.Series) -> pd.Series:
        values = np.fromiter((fingerprint(t, shingle) for t in texts), np.uint64, len(texts))
        return pd.Series(values.view(np.int64))
    return of


def _bits(values: np.ndarray) -> np.ndarray:
    """Rows of 64 bits, bit 0 the lowest."""
    return np.unpackbits(values.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_correlations(fps: DataFrame) -> np.ndarray:
    """Absolute correlation of each two bits over all fingerprints."""
    def partial(batches):
        both = np.zeros((BITS, BITS))
        n = 0
        for pdf in batches:
            x = _bits(pdf["fp"].to_numpy()).astype(np.float32)
            both += x.T @ x
            n += len(x)
        i, j = np.triu_indices(BITS)
        if n:
            yield pd.DataFrame({"i": np.append(i, -1), "j": np.append(j, -1),
                                "n": np.append(both[i, j], n).astype(np.int64)})

    sums = fps.select("fp").mapInPandas(partial, "i int, j int, n bigint").groupBy("i", "j").agg(F.sum("n").alias("n"))
    found = {(r.i, r.j): r.n for r in sums.collect()}          # 2081 rows
    n = max(found.get((-1, -1), 0), 1)
    joint = np.zeros((BITS, BITS))
    for (i, j), k in found.items():
        if i >= 0:
            joint[i, j] = joint[j, i] = k / n
    p = np.diag(joint)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    return np.abs(joint - np.outer(p, p)) / np.outer(spread, spread)


def correlated_blocks(correlation: np.ndarray) -> list[list[int]]:
    """Four blocks of 16 bits: each grows by the bit that correlates most with it."""
    left, blocks = set(range(BITS)), []
    while left:
        rest = sorted(left)
        block = [max(rest, key=lambda b: correlation[b, rest].sum())]
        left.discard(block[0])
        while len(block) < BLOCK:
            block.append(max(sorted(left), key=lambda b: correlation[b, block].sum()))
            left.discard(block[-1])
        blocks.append(block)
    return blocks


def mask_of(bits: list[int]) -> int:
    """The bits as a signed 64-bit mask."""
    return int(np.uint64(sum(1 << b for b in bits)).astype(np.int64))


def block_distances(fps: DataFrame, blocks: list[list[int]]) -> tuple[int, list[np.ndarray]]:
    """Number of fingerprints; per block the share of ordered pairs at each distance.

    At most 65,536 counts a block reach the driver, whatever the input."""
    masks = F.array(*[F.lit(mask_of(b)) for b in blocks])
    counts = (fps.select("fp", F.posexplode(masks).alias("block", "mask"))
              .select("block", F.col("fp").bitwiseAND(F.col("mask")).alias("value"))
              .groupBy("block", "value").count().toPandas())
    near = np.array([bin(x).count("1") for x in range(1 << BLOCK)])
    shares, n = [], 0
    for k, bits in enumerate(blocks):
        own = counts[counts["block"] == k]
        compact = _bits(own["value"].to_numpy(np.int64))[:, bits] @ (1 << np.arange(BLOCK))
        h = np.bincount(compact, weights=own["count"], minlength=1 << BLOCK)
        n = int(h.sum())
        step = 1
        while step < len(h):                                  # Walsh-Hadamard transform
            h = h.reshape(-1, 2, step)
            h = np.stack([h[:, 0] + h[:, 1], h[:, 0] - h[:, 1]], axis=1).ravel()
            step *= 2
        h *= h
        step = 1
        while step < len(h):
            h = h.reshape(-1, 2, step)
            h = np.stack([h[:, 0] + h[:, 1], h[:, 0] - h[:, 1]], axis=1).ravel()
            step *= 2
        shares.append(np.bincount(near, weights=h / len(h), minlength=BLOCK + 1) / max(n, 1) ** 2)
    return n, shares


def allocate(n: int, parts: list[tuple[int, np.ndarray]], max_distance: int) -> tuple[float, list[int]]:
    """Thresholds of least cost for parts given as (bits, share of pairs at each distance)."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for width, share in parts:
        grown: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for t in range(-1, max_distance + 1):
                probes = sum(math.comb(width, e) for e in range(t + 1))
                pairs = n * n * float(share[:t + 1].sum()) if t >= 0 else 0.0
                option = (cost + n * probes + CANDIDATE_COST * max(0.0, pairs - n * (t >= 0)), [*chosen, t])
                if used + t not in grown or option < grown[used + t]:
                    grown[used + t] = option
        best = grown
    return best[max_distance - len(parts) + 1]


def plan(fps: DataFrame, max_distance: int) -> list[tuple[list[int], int]]:
    """The parts to probe, as (bits, threshold)."""
    blocks = correlated_blocks(bit_correlations(fps))
    n, shares = block_distances(fps, blocks)
    options = []
    for merged in ([[0, 1, 2, 3]], [[0, 1], [2, 3]], [[0, 1], [2], [3]], [[0], [1], [2], [3]]):
        parts = []
        for group in merged:
            share = np.ones(1)
            for b in group:
                share = np.convolve(share, shares[b])
            parts.append((BLOCK * len(group), share))
        cost, thresholds = allocate(n, parts, max_distance)
        options.append((cost, [(sum((blocks[b] for b in g), []), t)
                               for g, t in zip(merged, thresholds, strict=True) if t >= 0]))
    return min(options, key=lambda o: o[0])[1]


def links(fps: DataFrame, max_distance: int) -> DataFrame:
    """All pairs ``a < b`` of the distinct ``fp`` values within the distance."""
    probes, index = None, None
    for k, (bits, t) in enumerate(plan(fps, max_distance)):
        flips = [mask_of(list(c)) for e in range(t + 1) for c in itertools.combinations(bits, e)]
        value = F.col("fp").bitwiseAND(F.lit(mask_of(bits)))
        probe = fps.select(F.lit(k).alias("part"), F.col("fp").alias("a"),
                           F.explode(F.array(*[F.lit(x) for x in flips])).alias("flip"), value.alias("value"))
        probe = probe.select("part", F.col("value").bitwiseXOR(F.col("flip")).alias("value"), "a")
        entry = fps.select(F.lit(k).alias("part"), value.alias("value"), F.col("fp").alias("b"))
        probes = probe if probes is None else probes.union(probe)
        index = entry if index is None else index.union(entry)
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance
    # Spark sizes the probes as if the explode added no rows: never broadcast, one plan at every size
    return (probes.hint("merge").join(index, ["part", "value"]).where((F.col("a") < F.col("b")) & near)
            .select("a", "b").distinct())


def components(rows: DataFrame, max_distance: int) -> DataFrame:
    """``fp, component, component_id`` of every fingerprint of ``rows(doc_id, fp)``, stored:
    the smallest fingerprint and the smallest id of those that links reach."""
    nodes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-nodes")
    parts = connected_components(links(nodes.select("fp"), max_distance))
    grouped = (nodes.join(parts.withColumnRenamed("node", "fp"), "fp", "left")
               .withColumn("component", F.coalesce("component", "fp")))
    ids = grouped.groupBy("component").agg(F.min("first_id").alias("component_id"))
    return materialize(grouped.join(ids, "component").select("fp", "component", "component_id"), "simhash-components")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_distance: int = 3) -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits) and ``component_id`` of every row."""
    rows = materialize(fingerprints(docs, shingle), "simhash-rows")
    by_fp = components(rows, max_distance).drop("component")
    return rows.join(by_fp, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                         "component_id")


def keep_first(docs: DataFrame, shingle: int = 3, max_distance: int = 3) -> DataFrame:
    """The rows of ``docs`` that stay, one of each component, all columns kept whatever
    their names: the row of the component's smallest id, a null id only if it has no
    other; of several rows with that id the one of the smallest fingerprint and text."""
    rows = materialize(fingerprints(docs, shingle), "simhash-rows")
    by_fp = components(rows, max_distance)
    keyed = docs.select(whole_row(docs).alias("row"), F.col("doc_id").cast("bigint").alias("id"),
                        text_or_empty().alias("text"), fingerprint_of(shingle)(text_or_empty()).alias("fp"))
    first = keyed.join(by_fp, "fp").where(F.col("id").eqNullSafe(F.col("component_id")))
    return first.groupBy("component").agg(F.min_by("row", F.struct("fp", "text")).alias("row")).select("row.*")
