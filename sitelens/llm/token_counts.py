"""Token counts of a byte-level BPE, huge texts by overlap resynchronisation.

Texts of more than ``CHUNK`` characters are encoded in chunks that overlap.  Where
two chunks share text, both list the token boundaries that are stable: places at
which the pattern that splits a text before merging always splits, whatever
stands around them (a visible character before white space, a letter beside a
digit, a letter before a mark outside ASCII), and no special token can lie.
Tokens on either side of such a place don't depend on the other side, so the
chunks are spliced at one that both have.  A text without any in some overlap is
encoded again with wider overlaps, in the end as one chunk.

The library's vocabulary file gives the special tokens, its twin as ranks the
merges; both are parameters, read on the driver and broadcast (1 MB).  Special
strings inside a text are special tokens, as is the library's default.

Defined cases: null text is the empty text, with no tokens; repeated rows and
rows without id are counted each; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import json

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_or_empty, tokenizer_path

VOCABULARY, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
CHUNK, OVERLAP, WIDEN, LIMIT = 1 << 15, 512, 8, 1024


def read_vocabulary(vocabulary: str | None = None, ranks: str | None = None, pattern: str | None = None) -> tuple:
    """(pattern, special tokens, content of the rank file)."""
    with open(vocabulary or tokenizer_path(VOCABULARY)) as f:
        special = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
    with open(ranks or tokenizer_path(RANKS), "rb") as f:
        data = f.read()
    if pattern is None:
        import public_tokenizers
        pattern = public_tokenizers.PATTERN
    return pattern, special, data


class Counter:
    def __init__(self, pattern: str, special: dict[str, int], data: bytes):
        import base64

        import tiktoken
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
        self.special = special
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
        self.width = np.zeros(max([*ranks.values(), *special.values()]) + 1, np.int64)
        for token, i in itertools.chain(ranks.items(), ((s.encode(), i) for s, i in special.items())):
            self.width[i] = len(token)

    def ids(self, text: str) -> list[int]:
        if any(s in text for s in self.special):
            return self.encoding.encode(text, allowed_special="all", disallowed_special=())
        return self.encoding.encode_ordinary(text)

    def count(self, text: str | None) -> int:
        return len(self.ids(text)) if text else 0

    def boundaries(self, s: str, ids: list[int], begin: int, end: int) -> tuple[list[int], list[int]]:
        """Stable boundaries between two positions, from ``begin`` on, and the tokens before each."""
        ends = np.cumsum(self.width[ids])
        at, offset, last = [], [], begin
        bytes_before = len(s[:begin].encode())
        for x in range(max(begin, 1), min(end, len(s) - 1) + 1):
            if stable(s[x - 1], s[x] if x < len(s) else ""):
                bytes_before += len(s[last:x].encode())
                last = x
                at.append(x - begin)
                offset.append(bytes_before)
        place = np.searchsorted(ends, offset)
        hit = [k for k, (p, o) in enumerate(zip(place, offset, strict=True)) if p < len(ends) and ends[p] == o]
        return [at[k] for k in hit], [int(place[k]) + 1 for k in hit]


def stable(before: str, after: str) -> bool:
    """The pattern splits here in every context."""
    if after in (" ", "\n", "\t", "\r"):
        return not before.isspace()
    plain = before.isascii() and after.isascii()
    if plain:
        return (before.isalpha() and after.isdigit()) or (before.isdigit() and after.isalpha())
    return before.isalpha() and not after.isascii() and not (after.isalnum() or after.isspace() or after.isnumeric())


def splice(parts: list[tuple[int, list, list, list, list]]) -> int | None:
    """Tokens of a text from its chunks (tokens, head places and counts, tail places and counts)."""
    total = parts[0][0]
    for (n, _, _, at, before), (m, head_at, head_before, _, _) in itertools.pairwise(parts):
        common = set(at) & set(head_at)
        if not common:
            return None
        x = sorted(common)[len(common) // 2]
        total += m - head_before[list(head_at).index(x)] - (n - before[list(at).index(x)])
    return total


_loaded: dict[int, Counter] = {}


def counter_of(vocabulary: tuple) -> Counter:
    key = hash(vocabulary[2])
    if key not in _loaded:
        _loaded[key] = Counter(*vocabulary)
    return _loaded[key]


PART = ("tokens bigint, head_at array<int>, head_before array<int>, tail_at array<int>, tail_before array<int>")


def huge_counts(texts: DataFrame, shared, chunk: int, overlap: int) -> DataFrame:
    """``row, n_tokens`` of ``texts(row, text)``; null where two chunks don't align."""
    def cut(batches):
        for pdf in batches:
            for row, text in zip(pdf["row"], pdf["text"], strict=True):
                n = max(1, -(-(len(text) - overlap) // chunk))
                rows = ((row, k, k == n - 1, text[k * chunk:(k + 1) * chunk + overlap]) for k in range(n))
                while part := list(itertools.islice(rows, 64)):
                    yield pd.DataFrame(part, columns=["row", "chunk", "last", "s"])

    def count(batches):
        c = counter_of(shared.value)
        for pdf in batches:
            out = []
            for k, last, s in zip(pdf["chunk"], pdf["last"], pdf["s"], strict=True):
                ids = c.ids(s)
                head = c.boundaries(s, ids, 0, overlap) if k else ([], [])
                tail = c.boundaries(s, ids, chunk, chunk + overlap) if not last else ([], [])
                out.append((len(ids), *head, *tail))
            yield pdf[["row", "chunk"]].join(pd.DataFrame(
                out, columns=[x.split()[0] for x in PART.split(", ")], index=pdf.index))

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [tuple(r) for r in pdf.sort_values("chunk")[[x.split()[0] for x in PART.split(", ")]].to_numpy()]
        total = splice(parts)
        return pd.DataFrame({"row": pdf["row"].iloc[:1], "n_tokens": pd.array([total], "Int64")})

    chunks = (texts.mapInPandas(cut, "row bigint, chunk int, last boolean, s string")
              .repartition(F.col("row"), F.col("chunk")))
    return (chunks.mapInPandas(count, f"row bigint, chunk int, {PART}")
            .groupBy("row").applyInPandas(join, "row bigint, n_tokens bigint"))


def token_counts(docs: DataFrame, vocabulary: tuple, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    @F.pandas_udf("bigint")
    def whole(texts: pd.Series) -> pd.Series:
        c = counter_of(shared.value)
        return pd.Series([c.count(t) for t in texts], dtype="int64")

    huge = F.char_length(text_or_empty()) > chunk
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    key = F.xxhash64("text")
    small = rows.where(~huge).select("doc_id", F.octet_length("text").alias("n_bytes"), whole("text").alias("n_tokens"))
    texts = rows.where(huge).select(key.alias("row"), "text").dropDuplicates(["row"])
    done, open_ = None, texts
    while True:
        found = materialize(huge_counts(open_, shared, chunk, overlap), "token-counts")
        ok = found.where("n_tokens is not null")
        done = ok if done is None else done.union(ok)
        if found.where("n_tokens is null").isEmpty():
            break
        open_ = texts.join(found.where("n_tokens is null").select("row"), "row", "left_semi")
        overlap *= WIDEN
    large = (rows.where(huge).select("doc_id", F.octet_length("text").alias("n_bytes"), key.alias("row"))
             .join(done, "row").select("doc_id", "n_bytes", "n_tokens"))
    return small.unionByName(large).select("doc_id", F.col("n_bytes").cast("bigint"), "n_tokens",
                                           (F.col("n_tokens") > LIMIT).alias("over_limit"))
