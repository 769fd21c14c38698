"""Source divergence audit: how far a source's words are from its language's and from other sources'.

1. Every partition cuts its texts into terms and counts them by length.  Terms of
   up to 8 and of up to 16 bytes become one and two big-endian uint64 words, radix
   sorted (stable passes over 16-bit digits) and run-counted in numpy; longer terms
   stand in buckets of doubling width and are byte-sorted.  A run is a term in a
   group (language, source) with its occurrences and documents.
2. The runs are added up by packed term, with map-side combine.
3. A language keeps the terms in at least ``min_docs`` of its documents.  A kept
   term's smoothed share in a group, or in the language, is the integer
   ``1 + floor(10**9 * (count + 2) / (N + 2 * V))``, and two shares p and q are
   ``floor((p - q)**2 / (p + q))`` apart.
4. Terms are listed for each group where it has more than its language.  For pairs
   of sources the kept terms are dealt over cells of a few thousand terms and tiles
   of some dozens of sources; a cell's counts are laid out in numpy, and terms that
   neither tile holds are all equally far apart and counted, not visited.

A hot source or word is many partial counts before the shuffle and a few rows after
it.  All arithmetic is on integers (decimals where a long may overflow).

Defined cases: null text, lang and source are the empty string; repeated rows and
ids count each; a group without terms has the shares of count 0; a language without
kept terms lists its pairs with value 0; equal values are ranked by the item's
bytes; an empty table gives an empty result.  Other columns are ignored, whatever
their names.  A long text is cut in slices of ``SLICE`` bytes at term borders.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

MIN_DOCS, TOP_TERMS = 10, 10
#: Bytes of text counted at once, and runs that a task holds before it sends them on.
SLICE, HELD_RUNS = 1 << 21, 1 << 20
#: Terms and sources of one cell of the pair sums.
CELL_TERMS, TILE = 4096, 64

RUNS = "lang string, source string, hi bigint, lo bigint, tail binary, n bigint, docs bigint"
ONE = 1_000_000_000


def lowered() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def term_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the runs of letters and of bytes from 0x80 on."""
    inside = (data >= 0x80) | ((data >= 0x61) & (data <= 0x7A)) | ((data >= 0x41) & (data <= 0x5A))
    edges = np.diff(inside.astype(np.int8), prepend=0, append=0)
    starts = np.flatnonzero(edges == 1)
    return starts, np.flatnonzero(edges == -1) - starts


def padded(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int) -> np.ndarray:
    """The terms as rows of ``width`` bytes, filled up with zeros, which no term has."""
    at = starts[:, None] + np.arange(width)
    rows = data[np.minimum(at, len(data) - 1)]
    rows[np.arange(width) >= lengths[:, None]] = 0
    return rows


def radix_order(words: list[np.ndarray]) -> np.ndarray:
    """Stable ascending order of uint64 words, the first the most significant."""
    order = np.arange(len(words[0]))
    for word in reversed(words):
        for shift in range(0, 64, 16):
            digit = (word >> np.uint64(shift)).astype(np.uint16)
            if len(digit) and digit.min() != digit.max():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def run_counts(changes: np.ndarray, docs: np.ndarray, groups: np.ndarray) -> tuple:
    """Of occurrences sorted by term, then document: first place, occurrences and
    documents of each run of one term and group.  ``changes`` marks new terms."""
    other = changes.copy()
    other[1:] |= docs[1:] != docs[:-1]
    first = changes.copy()
    first[1:] |= groups[1:] != groups[:-1]
    at = np.flatnonzero(first)
    return at, np.diff(at, append=len(docs)), np.add.reduceat(other.astype(np.int64), at)


def count_slice(texts: list[bytes], groups: np.ndarray) -> dict[int, list[np.ndarray]]:
    """Runs of texts in group order, by width of the bucket: arrays of the term's
    words (or of its bytes, from 32 on), group, occurrences and documents."""
    data = lowered()[np.frombuffer(b"\n".join(texts), np.uint8)]
    starts, lengths = term_bounds(data)
    ends = np.cumsum([len(t) + 1 for t in texts])
    docs = np.searchsorted(ends, starts, side="right")
    out, low, width = {}, 0, 8
    longest = int(lengths.max(initial=0))
    while low < longest:
        mine = np.flatnonzero((lengths > low) & (lengths <= width))
        if len(mine):
            terms = term_columns(padded(data, starts[mine], lengths[mine], width))
            order = term_order(terms)
            terms = [w[order] for w in terms]
            doc = docs[mine][order]
            at, n, in_docs = run_counts(new_terms(terms), doc, groups[doc])
            out[width] = [*[w[at] for w in terms], groups[doc[at]], n, in_docs]
        low, width = width, width * 2
    return out


def term_columns(rows: np.ndarray) -> list[np.ndarray]:
    """One or two words of short terms, the bytes of longer ones."""
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1]
    return [w.astype(np.uint64) for w in rows.view(">u8").T] if width <= 16 else [rows.view(f"S{width}").ravel()]


def term_order(terms: list[np.ndarray]) -> np.ndarray:
    return radix_order(terms) if terms[0].dtype == np.uint64 else np.argsort(terms[0], kind="stable")


def new_terms(terms: list[np.ndarray]) -> np.ndarray:
    changes = np.ones(len(terms[0]), bool)
    changes[1:] = np.any([w[1:] != w[:-1] for w in terms], axis=0)
    return changes


def merged(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Runs of one width, those of one term and group added up."""
    columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
    order = np.argsort(columns[-3].astype(np.uint16), kind="stable") if columns[-3].max() < 1 << 16 else \
        np.argsort(columns[-3], kind="stable")
    order = order[term_order([c[order] for c in columns[:-3]])]
    columns = [c[order] for c in columns]
    first = new_terms(columns[:-3])
    first[1:] |= columns[-3][1:] != columns[-3][:-1]
    at = np.flatnonzero(first)
    return [*[c[at] for c in columns[:-2]], *[np.add.reduceat(c, at) for c in columns[-2:]]]


def slices(text: bytes):
    """A text in parts of about ``SLICE`` bytes, cut before a byte that is in no term."""
    while len(text) > SLICE:
        cut = next((i for i in range(SLICE, len(text)) if text[i] < 0x41 or 0x5B <= text[i] <= 0x60
                    or 0x7B <= text[i] <= 0x7F), len(text))
        yield text[:cut]
        text = text[cut:]
    yield text


def count_long(text: bytes, code: int) -> dict[int, list[np.ndarray]]:
    """One long document, part by part; a term counts it once."""
    by_width: dict[int, list] = {}
    for part in slices(text):
        for width, run in count_slice([part], np.array([code])).items():
            by_width.setdefault(width, []).append(run)
            if len(by_width[width]) > 8:
                by_width[width] = [merged(by_width[width])]
    found = {width: merged(runs) for width, runs in by_width.items()}
    return {width: [*run[:-1], np.ones_like(run[-1])] for width, run in found.items()}


def count_terms(batches):
    """Per partition: its runs, added up before they are sent on."""
    import pyarrow as pa
    held: dict[int, list[list[np.ndarray]]] = {}
    codes: dict[tuple[str, str], int] = {}

    def size() -> int:
        return sum(len(run[-1]) for runs in held.values() for run in runs)

    def add(found: dict[int, list[np.ndarray]]) -> bool:
        """True if what is held should be sent on."""
        for width, run in found.items():
            held.setdefault(width, []).append(run)
        if size() < HELD_RUNS:
            return False
        for width, runs in held.items():
            held[width] = [merged(runs)]
        return size() > HELD_RUNS // 2

    def sent():
        names = [pa.array([n[k] for n in codes], pa.string()) for k in (0, 1)]
        for width, runs in held.items():
            run = merged(runs)
            group, n, docs = (pa.array(c.astype(np.int64)) for c in run[-3:])
            words = [pa.array(w.view(np.int64)) for w in run[:-3]] if width <= 16 else []
            words += [pa.array(np.zeros(len(n), np.int64))] * (2 - len(words))
            tail = pa.nulls(len(n), pa.binary()) if width <= 16 else pa.array(run[0].tolist(), pa.binary())
            columns = [*[name.take(group) for name in names], *words, tail, n, docs]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in RUNS.split(", ")])
        held.clear()

    def counted(texts, own):
        order = np.argsort(own, kind="stable")
        return count_slice([texts[i] for i in order], np.array(own)[order])

    for batch in batches:
        texts, own, held_bytes = [], [], 0
        for lang, source, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            code, text = codes.setdefault((lang, source), len(codes)), text.encode()
            if len(text) > SLICE:
                if add(count_long(text, code)):
                    yield from sent()
                continue
            texts.append(text)
            own.append(code)
            held_bytes += len(text)
            if held_bytes >= SLICE:
                if add(counted(texts, own)):
                    yield from sent()
                texts, own, held_bytes = [], [], 0
        if texts and add(counted(texts, own)):
            yield from sent()
    yield from sent()


def term_text(hi: Column, lo: Column, tail: Column) -> Column:
    """The packed term as a string."""
    words = F.concat(F.hex(hi), F.when(lo != 0, F.hex(lo)).otherwise(F.lit("")))
    return F.coalesce(tail.cast("string"), F.replace(F.unhex(words).cast("string"), F.lit("\x00"), F.lit("")))


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10**9 * (count + 2) / (total + 2 * kept)), exactly."""
    wide = lambda c: c.cast("decimal(38,0)")
    return F.call_function("div", (wide(count) + 2) * ONE, wide(total) + wide(kept) * 2) + 1


def apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def term_runs(docs: DataFrame) -> DataFrame:
    """``lang, source, hi, lo, tail, n, docs`` of every term of every group."""
    blank = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)
    runs = docs.select(blank("lang"), blank("source"), blank("text")).mapInArrow(count_terms, RUNS)
    return (runs.groupBy("lang", "source", "hi", "lo", "tail")
            .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def pair_sums(counts: DataFrame, groups: DataFrame, sizes: DataFrame) -> DataFrame:
    """``lang, a, b, value, seen``: for a < b the distance summed over the terms that a
    cell holds for their tiles, and the number of those terms.

    counts(lang, source, hi, lo, tail, p), groups(lang, source, p0),
    sizes(lang, cells, tiles)."""
    tile = lambda: F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int")
    both = F.explode(F.transform(F.sequence(F.lit(0), F.col("tiles") - 1),
                                 lambda t: F.struct(F.least(t, F.col("tile")).alias("ta"),
                                                    F.greatest(t, F.col("tile")).alias("tb"))))
    keys = ["lang", "cell", "ta", "tb"]
    term = F.xxhash64("hi", "lo", "tail")
    # a term's place is its full packed form; the hash only deals terms out
    dealt = (counts.join(sizes, "lang").withColumn("tile", tile())
             .withColumn("cell", F.pmod(term, F.col("cells")).cast("int"))
             .withColumn("two", both)
             .select("lang", "cell", "two.ta", "two.tb", "source", "tile", "hi", "lo", "tail", "p"))
    members = (groups.join(sizes, "lang").withColumn("tile", tile())
               .withColumn("cell", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
               .withColumn("two", both)
               .select("lang", F.col("cell").cast("int").alias("cell"), "two.ta", "two.tb", "source", "tile", "p0"))
    held = materialize(members.join(dealt.select(*keys).distinct(), keys), "audit-members")
    return dealt.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInPandas(
        cell_sums, "lang string, a string, b string, value bigint, seen bigint")


def cell_sums(rows, members):
    """The pair sums of one cell: every source of the first tile with those of the second."""
    import pandas as pd
    columns = ["lang", "a", "b", "value", "seen"]
    if not len(rows) or not len(members):
        return pd.DataFrame([], columns=columns)
    lang, ta, tb = rows["lang"].iloc[0], rows["ta"].iloc[0], rows["tb"].iloc[0]
    tails = rows["tail"].map(lambda t: b"" if t is None else bytes(t))
    terms = pd.MultiIndex.from_arrays([rows["hi"], rows["lo"], tails]).factorize()[0]
    seen = int(terms.max()) + 1
    names = members["source"].tolist()
    place = {s: i for i, s in enumerate(names)}
    p = np.repeat(members["p0"].to_numpy(np.int64)[:, None], seen, axis=1)
    p[rows["source"].map(place).to_numpy(), terms] = rows["p"].to_numpy(np.int64)
    tiles = members["tile"].to_numpy()
    others = np.flatnonzero(tiles == tb)
    out = []
    for i in np.flatnonzero(tiles == ta):
        gap, total = p[others] - p[i], p[others] + p[i]
        values = (gap * gap // total).sum(axis=1).tolist()
        for j, value in zip(others.tolist(), values, strict=True):
            if ta != tb or names[i] < names[j]:
                out.append((lang, names[i], names[j], value, seen))
    return pd.DataFrame(out, columns=columns)


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS,
               cell_terms: int = CELL_TERMS, tile: int = TILE) -> DataFrame:
    """``lang, source, part, item, value, rank``: the ``term`` rows of each group (its
    ``top_terms`` terms furthest above the language) and its ``pair`` rows (every
    other source of the language)."""
    runs = materialize(term_runs(docs), "audit-runs")
    packed = ["hi", "lo", "tail"]
    kept = (runs.groupBy("lang", *packed).agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
            .where(F.col("docs") >= min_docs).drop("docs"))
    # tails are null for short terms: a null never equals itself in a join on names
    whole = lambda df: df.withColumn("tail", F.coalesce("tail", F.lit(b"")))
    kept = materialize(whole(kept), "audit-kept")
    blank = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)
    groups = docs.select(blank("lang"), blank("source")).distinct()
    langs = materialize(groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources")).join(
        kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total")), "lang", "left")
        .select("lang", "sources", F.coalesce("v", F.lit(0)).alias("v"),
                F.coalesce("lang_total", F.lit(0)).alias("lang_total")), "audit-langs")
    found = materialize(whole(runs).join(kept, ["lang", *packed]), "audit-found")
    totals = found.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sized = materialize(groups.join(totals, ["lang", "source"], "left").join(langs, "lang")
                        .withColumn("total", F.coalesce("total", F.lit(0)))
                        .withColumn("p0", F.when(F.col("v") > 0, share(F.lit(0), F.col("total"), F.col("v")))),
                        "audit-groups")
    shares = found.join(sized.drop("p0", "sources"), ["lang", "source"]).select(
        "lang", "source", *packed, share(F.col("n"), F.col("total"), F.col("v")).alias("p"),
        share(F.col("lang_n"), F.col("lang_total"), F.col("v")).alias("q"))
    shares = materialize(shares, "audit-shares")

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = (shares.where("p > q").select("lang", "source", F.lit("term").alias("part"),
                                          term_text(F.col("hi"), F.col("lo"), F.nullif(F.col("tail"), F.lit(b""))).alias("item"),
                                          apart(F.col("p"), F.col("q")).alias("value"))
             .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_terms))

    sizes = langs.select("lang", F.ceil(F.greatest("v", F.lit(1)) / cell_terms).cast("int").alias("cells"),
                         F.ceil(F.col("sources") / tile).cast("int").alias("tiles"))
    sums = (pair_sums(shares.drop("q"), sized.where("v > 0").select("lang", "source", "p0"), sizes)
            .groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen")))
    sums = sums.union(sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value", "seen"))
    # the result has a row for every two sources of a language
    mine = sized.select("lang", "source", "v", F.col("p0").alias("pa"))
    other = sized.select("lang", F.col("source").alias("item"), F.col("p0").alias("pb"))
    unseen = (F.col("v") - F.coalesce("seen", F.lit(0))) * apart(F.col("pa"), F.col("pb"))
    pairs = (mine.join(other, "lang").where("source <> item")
             .join(sums.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value", "seen"),
                   ["lang", "source", "item"], "left")
             .select("lang", "source", F.lit("pair").alias("part"), "item",
                     (F.coalesce("value", F.lit(0)) + F.coalesce(unseen, F.lit(0))).alias("value"))
             .withColumn("rank", F.row_number().over(order)))
    return pairs.unionByName(terms).withColumn("rank", F.col("rank").cast("int"))
