"""SentencePiece encoding and decoding, giant texts by a max-plus scan.

A BPE segmentation is the one sequence of pieces in which every piece, and every
two neighbours, encode to themselves.  That makes encoding a lattice of
(position, last piece) with weight 0 for allowed and minus infinity for forbidden
steps, whose only finite path is the library's result.

Texts of more than ``CHUNK`` characters are cut every ``CHUNK`` characters:

1. At a cut, a state is (first piece end at or behind the cut, that piece).  Both
   sides list the states from the text around the cut.  Each chunk yields a
   max-plus matrix from its entry to its exit states.
2. Per text the matrices are multiplied (max-plus is associative), forwards and
   backwards: one state stays at each cut.
3. Each chunk traces its own path between its two states.

Shorter texts are one chunk, and one chunk is what the library encodes at once.  It
also encodes what lies in a chunk between the first and the last place that no
piece spans (before a space that follows another character), so the lattice runs
only around cuts and in long runs without spaces.

Encoding is the library's, without begin or end.  Decoding gives the text back,
except that U+2581 stands for a space in this vocabulary and comes back as one.

Defined cases: null text encodes to no ids, as the empty text; a null or empty id
list decodes to the empty text; repeated rows are encoded each.  An input column
that has the name of an added one is replaced.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, text_or_empty, tokenizer_path

MODEL = "piece_bpe_32k.model"
#: Characters of a chunk; texts up to this length are one chunk.
CHUNK = 1 << 15
#: Pairs of pieces a Python worker remembers.
REMEMBERED = 100_000
#: Texts that are encoded at a time.
ROWS = 256
SPACE = "▁"
START = ""
NONE, FREE = np.float32(-np.inf), np.float32(0)


class Pieces:
    """A BPE model: its library encoder and the lattice over its pieces."""

    def __init__(self, model: bytes):
        import sentencepiece
        self.sp = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = sp.get_piece_size()
        self.ids = {sp.id_to_piece(i): i for i in range(size)
                    if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))}
        self.byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.bytes = [sp.id_to_piece(i).replace(SPACE, " ").encode() for i in range(size)]
        for b, i in enumerate(self.byte_ids):
            self.bytes[i] = bytes([b])
        self.rank = {piece: -sp.get_score(i) for piece, i in self.ids.items()}
        self.longest = max(map(len, self.ids))
        self.allowed: dict[tuple[str, str], bool] = {}
        if any(SPACE in p.lstrip(SPACE) or "\0" in p for p in self.ids):
            raise ValueError("a piece goes on behind a space: words can't be told apart")

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        return self.sp.encode([t or "" for t in texts], num_threads=1)

    def span(self, s: str) -> list[int]:
        """Ids of a normalised text, from a space on, whose ends no piece spans."""
        if len(s) < 2:
            return [self.ids[s]] if s else []
        return self.sp.encode(s[1:])                       # the library puts the first space there itself

    def decode(self, ids) -> str:
        if ids is None or not len(ids):
            return ""
        table = self.bytes
        return b"".join([table[i] for i in ids])[1:].decode("utf-8", "replace")

    # lattice

    def pieces_at(self, s: str, at: int) -> list[str]:
        ids = self.ids
        found = [p for n in range(1, min(self.longest, len(s) - at) + 1) if (p := s[at:at + n]) in ids]
        if s[at] not in ids:
            found.append(s[at])                        # falls back to bytes, joins nothing
        return found

    def may_follow(self, left: str, right: str) -> bool:
        key = (left, right)
        found = self.allowed.get(key)
        if found is None:
            if len(self.allowed) >= REMEMBERED:
                self.allowed.clear()
            free = left == START or left not in self.ids or right not in self.ids
            found = self.proper(right) and (free or self.merged(left + right) == [left, right])
            self.allowed[key] = found
        return found

    def proper(self, piece: str) -> bool:
        return piece not in self.ids or self.merged(piece) == [piece]

    def merged(self, s: str) -> list[str]:
        """Pieces of a few characters: the best-ranked neighbours join first, the left ones of equals."""
        parts = list(s)
        while True:
            best = min(((self.rank[a + b], k) for k, (a, b) in enumerate(itertools.pairwise(parts))
                        if a + b in self.rank), default=None)
            if best is None:
                return parts
            parts[best[1]:best[1] + 2] = ["".join(parts[best[1]:best[1] + 2])]

    def states(self, s: str, cut: int, end: bool = False) -> list[tuple[int, str]]:
        """(end, piece) of all pieces that end at the cut or span it; at a text's end, that end there."""
        out = []
        for start in range(max(0, cut - self.longest), cut):
            out += [(start + len(p), p) for p in self.pieces_at(s, start)
                    if start + len(p) >= cut and (not end or start + len(p) == cut) and self.proper(p)]
        return sorted(out)

    def reach(self, s: str, entries: list[tuple[int, str]], stop: int) -> dict[int, dict[str, int]]:
        """Per position from ``stop`` on and last piece: the entries, as bits, with a path to it."""
        at: dict[int, dict[str, int]] = {}
        for k, (pos, piece) in enumerate(entries):
            here = at.setdefault(pos, {})
            here[piece] = here.get(piece, 0) | 1 << k
        for pos in range(min(at, default=stop), stop):
            for left, bits in at.pop(pos, {}).items():
                for right in self.pieces_at(s, pos):
                    if self.may_follow(left, right):
                        there = at.setdefault(pos + len(right), {})
                        there[right] = there.get(right, 0) | bits
        return at

    def trace(self, s: str, entry: tuple[int, str], goal: tuple[int, str] | None, stop: int) -> list[int]:
        """Ids of the one path from the entry to the goal, or to any piece that ends at ``stop``."""
        back: dict[int, dict[str, str]] = {entry[0]: {entry[1]: None}}
        for pos in range(entry[0], stop):
            for left in back.get(pos, ()):
                for right in self.pieces_at(s, pos):
                    if self.may_follow(left, right):
                        back.setdefault(pos + len(right), {})[right] = left
        pos, piece = goal or (stop, next(iter(back[stop])))
        path = []
        while (pos, piece) != tuple(entry):
            path.append(piece)
            pos, piece = pos - len(piece), back[pos][piece]
        return [i for p in reversed(path) for i in self.ids_of(p)]

    def ids_of(self, piece: str) -> list[int]:
        return [self.ids[piece]] if piece in self.ids else [self.byte_ids[b] for b in piece.encode()]

    # chunks

    def ends(self, chunk: Chunk) -> tuple[list[tuple[int, str]], list[tuple[int, str]]]:
        entries = [(0, START)] if chunk.first else self.states(chunk.s, chunk.begin)
        return entries, self.states(chunk.s, chunk.end, chunk.last)

    def transfer(self, chunk: Chunk) -> np.ndarray:
        """Max-plus matrix from the chunk's entry to its exit states."""
        entries, exits = self.ends(chunk)
        m = np.full((len(entries), len(exits)), NONE, np.float32)
        free = chunk.free_cuts()
        if free:
            bits = 0
            for found in self.reach(chunk.s, [e if e[0] <= free[0] else (len(chunk.s) + 1, e[1]) for e in entries],
                                    free[0]).get(free[0], {}).values():
                bits |= found
            into = np.array([bits >> k & 1 for k in range(len(entries))], bool)
            met = self.reach(chunk.s, [(free[1], START)], chunk.end)
            out = np.array([bool(met.get(pos, {}).get(piece)) for pos, piece in exits], bool)
            m[np.ix_(into, out)] = FREE
        else:
            met = self.reach(chunk.s, entries, chunk.end)
            for j, (pos, piece) in enumerate(exits):
                bits = met.get(pos, {}).get(piece, 0)
                m[[k for k in range(len(entries)) if bits >> k & 1], j] = FREE
        return m

    def backtrace(self, chunk: Chunk, entry: int, exit_: int) -> list[int]:
        """The chunk's ids between its two states."""
        entries, exits = self.ends(chunk)
        free = chunk.free_cuts()
        if not free:
            return self.trace(chunk.s, entries[entry], exits[exit_], chunk.end)
        head = self.trace(chunk.s, entries[entry], None, free[0]) if entries[entry][0] < free[0] else []
        tail = self.trace(chunk.s, (free[1], START), exits[exit_], chunk.end) if exits[exit_][0] > free[1] else []
        return head + self.span(chunk.s[free[0]:free[1]]) + tail


class Chunk:
    """Positions ``begin`` to ``end`` of the text piece ``s``, which goes on around them."""

    def __init__(self, s: str, begin: int, end: int, first: bool, last: bool):
        self.s, self.begin, self.end, self.first, self.last = s, begin, end, first, last

    def free_cuts(self) -> tuple[int, int] | None:
        """First and last place in the chunk that no piece spans."""
        if self.first:
            low = self.begin
        else:
            low = next((k for k in range(self.begin + 1, self.end)
                        if self.s[k] == SPACE and self.s[k - 1] != SPACE), None)
        if low is None:
            return None
        high = next((k for k in range(self.end - 1, low, -1) if self.s[k] == SPACE and self.s[k - 1] != SPACE), low)
        return low, high


def normal(text: str) -> str:
    return SPACE + text.replace(" ", SPACE)


def chunks(text: str, size: int, margin: int):
    """(position, Chunk) of a normalised text."""
    s = normal(text)
    for begin in range(0, len(s), size):
        end = min(begin + size, len(s))
        low = max(0, begin - margin)
        yield begin // size, Chunk(s[low:end + margin], begin - low, end - low, begin == 0, end == len(s))


def multiply(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product."""
    return (a[:, :, None] + b[None]).max(axis=1, initial=NONE)


def scan(matrices: list[np.ndarray]) -> list[int]:
    """The state at every cut of the one finite path, first entry to last exit."""
    forwards = list(itertools.accumulate(matrices, multiply))
    states = [int(np.argmax(forwards[-1][0]))]
    for ahead, m in zip(reversed(forwards[:-1]), reversed(matrices[1:]), strict=True):
        states.append(int(np.argmax(ahead[0] + m[:, states[-1]])))
    return [0, *reversed(states)]


_loaded: dict[int, Pieces] = {}


def pieces_of(model: bytes) -> Pieces:
    """The worker's own copy."""
    key = hash(model)
    if key not in _loaded:
        _loaded[key] = Pieces(model)
    return _loaded[key]


def read_model(path: str | None = None) -> bytes:
    with open(path or tokenizer_path(MODEL), "rb") as f:
        return f.read()


CHUNK_SCHEMA = "row bigint, chunk int, s string, begin int, end int, first boolean, last boolean"


def encode(docs: DataFrame, model: bytes, size: int = CHUNK, verify: bool = False) -> DataFrame:
    """``docs`` with ``token_ids`` of its ``text``, and ``round_trip``, whether they decode to it, if asked for."""
    shared = docs.sparkSession.sparkContext.broadcast(model)      # half a megabyte

    def whole(batches):
        import pyarrow as pa
        p = pieces_of(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                texts = part.column("text").to_pylist()
                ids = [np.array(i, np.int32) for i in p.encode(texts)]
                columns = [*part.columns, pa.array(ids, pa.list_(pa.int32()))]
                if verify:
                    columns.append(pa.array([p.decode(i) == (t or "").replace(SPACE, " ")
                                             for i, t in zip(ids, texts, strict=True)]))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    def cut(batches):
        p = pieces_of(shared.value)
        for pdf in batches:
            for row, text in zip(pdf["row"], pdf["text"], strict=True):
                rows = ((row, k, c.s, c.begin, c.end, c.first, c.last) for k, c in chunks(text, size, p.longest))
                while part := list(itertools.islice(rows, 64)):
                    yield pd.DataFrame(part, columns=[c.split()[0] for c in CHUNK_SCHEMA.split(", ")])

    def transfers(batches):
        p = pieces_of(shared.value)
        for pdf in batches:
            found = [p.transfer(Chunk(*r)) for r in zip(*(pdf[c] for c in ("s", "begin", "end", "first", "last")),
                                                        strict=True)]
            yield pd.DataFrame({"row": pdf["row"], "chunk": pdf["chunk"], "n": [len(m) for m in found],
                                "matrix": [m.tobytes() for m in found]})

    def states(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("chunk")
        at = scan([np.frombuffer(m, np.float32).reshape(n, -1) for m, n in zip(pdf["matrix"], pdf["n"], strict=True)])
        return pd.DataFrame({"row": pdf["row"], "chunk": pdf["chunk"], "entry": at[:-1], "exit_": at[1:]})

    def paths(batches):
        p = pieces_of(shared.value)
        for pdf in batches:
            ids = [np.array(p.backtrace(Chunk(*r[:5]), *r[5:]), np.int32)
                   for r in zip(*(pdf[c] for c in ("s", "begin", "end", "first", "last", "entry", "exit_")),
                                strict=True)]
            yield pd.DataFrame({"row": pdf["row"], "chunk": pdf["chunk"], "ids": ids})

    docs = docs.drop("token_ids", *["round_trip"] * verify)
    added = [T.StructField("token_ids", T.ArrayType(T.IntegerType())), T.StructField("round_trip", T.BooleanType())]
    schema = T.StructType([*docs.schema.fields, *added[:2 if verify else 1]])
    names = schema.names
    giant = F.char_length(text_or_empty()) > size
    key = F.xxhash64(text_or_empty())
    small = docs.where(~giant).mapInArrow(whole, schema)
    texts = docs.where(giant).select(key.alias("row"), "text").dropDuplicates(["row"])
    parts = materialize(texts.mapInPandas(cut, CHUNK_SCHEMA).repartition(F.col("row"), F.col("chunk")), "piece-chunks")
    chosen = (parts.mapInPandas(transfers, "row bigint, chunk int, n int, matrix binary")
              .groupBy("row").applyInPandas(states, "row bigint, chunk int, entry int, exit_ int"))
    traced = parts.join(chosen, ["row", "chunk"]).mapInPandas(paths, "row bigint, chunk int, ids array<int>")
    joined = (traced.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("chunk", "ids"))).alias("runs"))
              .select("row", F.flatten(F.transform("runs", lambda r: r["ids"])).alias("token_ids")))
    large = (docs.where(giant).select(F.struct(*docs.columns).alias("d"), key.alias("row")).join(joined, "row")
             .select("d.*", "token_ids"))
    if verify:
        decoded = decoder(docs, model)(F.col("token_ids"))
        large = large.withColumn("round_trip", decoded == F.replace(text_or_empty(), F.lit(SPACE), F.lit(" ")))
    return small.unionByName(large)


def decoder(docs: DataFrame, model: bytes):
    """Text of an id list as a column function."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def decoded(ids: pd.Series) -> pd.Series:
        p = pieces_of(shared.value)
        return pd.Series([p.decode(i) for i in ids], dtype=object)
    return decoded


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``docs`` with ``token_ids``, ``n_tokens`` and ``round_trip``: whether the ids decode to the text."""
    return (encode(docs, read_model(path), verify=True)
            .withColumn("n_tokens", F.size("token_ids").cast("bigint")))
