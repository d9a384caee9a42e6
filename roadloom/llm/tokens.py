"""Byte-pair encoding of whole texts with a public rank file.

Merging uses a rank queue: positions of the linked list of symbols lie in a bucket for the rank of the merge that starts
there, a three-level bitmap marks the buckets that are filled, find-first-set gives the next rank, and an entry whose
pair has changed meanwhile is skipped.  Each position enters a bucket at most once per change of its pair, so the
time is near linear in the length of a pre-token, however long.

Texts are cut at white space first; a cut piece always encodes alike, so its ids are kept in a bounded cache.
Null and empty texts have no ids (an empty array).
"""

from __future__ import annotations

import base64
import re
from array import array
from bisect import insort
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import tokenizer_file

VOCABULARY = "byte_bpe_50k.tiktoken"
CACHE_PIECES = 1 << 18
ROWS_AT_ONCE = 512
# The white space of the pre-token pattern (Unicode White_Space) and the pattern itself.
_W = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_PIECE = re.compile(rf" ?[^{_W}]+|[{_W}]+(?![^{_W}])|[{_W}]+")
_PRETOKEN = rf"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_W}\p{{L}}\p{{N}}]+|[{_W}]+(?![^{_W}])|[{_W}]+"""


class RankQueue:
    """Buckets by rank under a hierarchical bitmap of 64-way words."""

    def __init__(self, ranks: int):
        self.buckets: dict[int, list[int]] = {}
        self.low = [0] * ((ranks >> 6) + 1)
        self.mid = [0] * ((ranks >> 12) + 1)
        self.top = 0

    def push(self, rank: int, at: int) -> None:
        b = self.buckets.get(rank)
        if b is None:
            self.buckets[rank] = [at]
            self.low[rank >> 6] |= 1 << (rank & 63)
            self.mid[rank >> 12] |= 1 << ((rank >> 6) & 63)
            self.top |= 1 << (rank >> 12)
        elif at > b[-1]:
            b.append(at)
        else:
            insort(b, at)

    def pop_bucket(self) -> tuple[int, list[int]] | None:
        """The lowest rank and its positions from left to right."""
        if not self.top:
            return None
        t = (self.top & -self.top).bit_length() - 1
        m = self.mid[t]
        w = (t << 6) + (m & -m).bit_length() - 1
        lo = self.low[w]
        bit = lo & -lo
        rank = (w << 6) + bit.bit_length() - 1
        self.low[w] = lo = lo ^ bit
        if not lo:
            self.mid[t] = m = m ^ (1 << (w & 63))
            if not m:
                self.top ^= 1 << t
        return rank, self.buckets.pop(rank)


class Encoder:
    def __init__(self, path: str):
        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        self.ranks = {base64.b64decode(a): int(b) for a, b in pairs}
        self.single = [self.ranks[bytes([i])] for i in range(256)]
        self.queue = RankQueue(max(self.ranks.values()) + 1)
        self.pretokens = regex.compile(_PRETOKEN).findall

    def merge(self, raw: bytes) -> list[int]:
        whole = self.ranks.get(raw)
        if whole is not None:
            return [whole]
        n, ranks, queue = len(raw), self.ranks, self.queue
        end = list(range(1, n + 1))  # where the symbol that starts at i ends; 0 for a start that is merged away
        prev = list(range(-1, n - 1))
        pair = [-1] * n  # rank of the merge of the symbol at i with the next one
        for i in range(n - 1):
            r = ranks.get(raw[i : i + 2])
            if r is not None:
                pair[i] = r
                queue.push(r, i)
        while (got := queue.pop_bucket()) is not None:
            r, places = got
            for i in places:
                if pair[i] != r or not end[i]:
                    continue  # stale
                j = end[i]
                k = end[j]
                end[i], end[j], pair[j] = k, 0, -1
                if k < n:
                    prev[k] = i
                    q = ranks.get(raw[i : end[k]])
                    pair[i] = -1 if q is None else q
                    if q is not None:
                        queue.push(q, i)
                else:
                    pair[i] = -1
                p = prev[i]
                if p >= 0:
                    q = ranks.get(raw[p:k])
                    pair[p] = -1 if q is None else q
                    if q is not None:
                        queue.push(q, p)
        out, i = [], 0
        while i < n:
            out.append(ranks[raw[i : end[i]]])
            i = end[i]
        return out

    def piece(self, text: str) -> list[int]:
        return [t for p in self.pretokens(text) for t in self.merge(p.encode("utf-8", "surrogatepass"))]


class Cache(dict):
    """Ids of white-space pieces as packed 32-bit integers; forgets everything when full."""

    def __init__(self, encoder: Encoder, most: int = CACHE_PIECES):
        super().__init__()
        self.encoder, self.most = encoder, most

    def __missing__(self, piece: str) -> bytes:
        v = array("i", self.encoder.piece(piece)).tobytes()
        if len(piece) <= 64:
            if len(self) >= self.most:
                self.clear()
            self[piece] = v
        return v


def packed(cache: Cache, text: str | None) -> bytes:
    return b"".join(map(cache.__getitem__, _PIECE.findall(text))) if text else b""


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, counts_only: bool = False) -> DataFrame:
    """(id, ids) of every row, or (id, n_tokens): no special tokens, no shuffle; null and empty texts give [] and 0."""
    path = tokenizer_file(vocabulary)
    out = "n_tokens bigint" if counts_only else "ids array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Cache(Encoder(path))
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                b = whole.slice(at, ROWS_AT_ONCE)
                ids = [packed(cache, t) for t in b.column(1).to_pylist()]
                if counts_only:
                    col = pa.array([len(x) >> 2 for x in ids], pa.int64())
                else:
                    offsets, total = array("i", [0]), 0
                    for x in ids:
                        total += len(x) >> 2
                        offsets.append(total)
                    values = pa.Array.from_buffers(pa.int32(), total, [None, pa.py_buffer(b"".join(ids))])
                    col = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
                yield pa.RecordBatch.from_arrays([b.column(0), col], names=[id_col, out.split()[0]])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, f"{id_col} {kind}, {out}")
