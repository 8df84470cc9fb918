"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Pre-tokens are linked lists of byte runs.  Every adjacent pair that the rank
table can merge sits in the bucket of its rank; a two-level bitmap of the
non-empty buckets gives the lowest rank by find-first-set, and a bucket is
worked off from left to right.  A pair changed by a neighbouring merge leaves a
stale entry, which is skipped when it comes up, so n bytes take O(n log n)
however long a pre-token is.

Rows are independent: texts are encoded where they are scanned, without a
shuffle.  The rank table (at most a few hundred thousand entries) is the only
thing broadcast.

Edge cases: a null or empty text has no ids and decodes to no bytes; ids that
are null decode to no bytes; extra columns are kept, those with the name of
an output (in any case) are replaced; repeated rows are encoded each on their own.
"""

from __future__ import annotations

import base64
import gc
import uuid
from array import array
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardloom.llm.common import add_columns, columns_but, python_ready, small_batches

#: Bytes that a Python worker spends on the ids it remembers, of units and of pre-tokens, in each of
#: two generations (88 MB in all); and the bytes of an entry besides its text and ids.
UNIT_BYTES, PIECE_BYTES = 40 << 20, 4 << 20
ENTRY_BYTES = 150
#: Longer strings are not remembered.
REMEMBERED = 64
#: Longer texts are encoded in parts, cut at single blanks.
LONG = 1 << 20
DECODE_ROWS = 512
#: Ids decoded at once: two places a byte are held meanwhile.
DECODE_IDS = 1 << 18
#: Text that is encoded together: what is new in it is learned before the next.
BATCH_BYTES = 1 << 20
#: New pre-tokens that share a queue (their lists then stay in the CPU's cache).
TOGETHER = 512


def load_ranks(path: str) -> dict[bytes, int]:
    """Rank file: one base64 token and its rank a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(tok): int(rank) for tok, rank in (line.split() for line in f if line.strip())}


class RankTable:
    """The ranks, by token and by pair of ids."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.joins: list[dict[int, int]] = [{} for _ in range(max(ranks.values()) + 1)]  # left id -> right id -> rank
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    self.joins[left][right] = rank
        self.bytes_join = np.full((256, 256), -1, np.int32)
        for a in range(256):
            for b in range(256):
                self.bytes_join[a, b] = ranks.get(bytes([a, b]), -1)


def merge_pieces(pieces: list[bytes], table: RankTable) -> list[list[int]]:
    """Ids of each pre-token: merges by lowest rank, leftmost first.

    All pieces share one linked list (a node is the place of its first byte, a
    node merged into its left neighbour is dead) with a gap after each piece,
    and one queue.  A popped bucket is worked off from left to right; should a
    merge make a pair of a lower rank, the rest of the bucket waits for it."""
    joins = table.joins
    data = np.frombuffer(b"\0".join([*pieces, b""]), np.uint8)
    gaps = np.cumsum([len(p) + 1 for p in pieces]) - 1
    first_ids = table.byte_id[data]
    first_ids[gaps] = -1
    ranks = np.full(len(data), -1, np.int32)  # of a node and its right neighbour
    ranks[:-1] = table.bytes_join[data[:-1], data[1:]]
    ranks[gaps] = ranks[gaps - 1] = -1
    places = np.flatnonzero(ranks >= 0)
    places = places[np.argsort(ranks[places], kind="stable")]
    live, starts = np.unique(ranks[places], return_index=True)
    places, starts = places.tolist(), [*starts.tolist(), len(places)]
    live = live.tolist()
    buckets = {r: places[a:b] for r, a, b in zip(live, starts, starts[1:])}
    ids, rank_at = first_ids.tolist(), ranks.tolist()
    words: dict[int, int] = {}  # bitmap of the ranks that have a bucket, 256 a word
    for rank in buckets:
        words[rank >> 8] = words.get(rank >> 8, 0) | 1 << (rank & 255)
    top = 0  # bitmap of the words that are not empty
    for w in words:
        top |= 1 << w
    after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
    while top:
        w = (top & -top).bit_length() - 1
        bits = words[w]
        rank = w << 8 | (bits & -bits).bit_length() - 1
        words[w] = bits = bits & (bits - 1)
        if not bits:
            top &= top - 1
        bucket = buckets.pop(rank)
        bucket.sort()
        joins_rank = joins[rank].get
        for place, i in enumerate(bucket):
            if rank_at[i] != rank:
                continue  # stale: the node or its neighbour has changed
            j = after[i]
            k = after[i] = after[j]  # the gap at the latest
            before[k] = i
            ids[i], ids[j], rank_at[j] = rank, -1, -1
            right = ids[k]
            p = before[i]
            left = ids[p] if p >= 0 else -1
            new = rank_at[i] = joins_rank(right, -1) if right >= 0 else -1
            least = rank
            if new >= 0:
                if new in buckets:
                    buckets[new].append(i)
                else:
                    buckets[new] = [i]
                    w = new >> 8
                    words[w] = words.get(w, 0) | 1 << (new & 255)
                    top |= 1 << w
                if new < least:
                    least = new
            if left >= 0:
                new = rank_at[p] = joins[left].get(rank, -1)
                if new >= 0:
                    if new in buckets:
                        buckets[new].append(p)
                    else:
                        buckets[new] = [p]
                        w = new >> 8
                        words[w] = words.get(w, 0) | 1 << (new & 255)
                        top |= 1 << w
                    if new < least:
                        least = new
            if least < rank:
                if rest := bucket[place + 1 :]:
                    buckets[rank] = buckets.get(rank, []) + rest
                    w = rank >> 8
                    words[w] = words.get(w, 0) | 1 << (rank & 255)
                    top |= 1 << w
                break
    out, at = [], 0
    for gap in gaps.tolist():
        out.append([x for x in ids[at:gap] if x >= 0])
        at = gap + 1
    return out


class _Remembered:
    """Two generations of strings and their ids, of at most ``limit`` bytes each:
    when the young one is full it becomes the old one, so what is asked for again
    stays.  What a batch needs lives in the batch; only then is it remembered."""

    def __init__(self, limit: int):
        self.limit, self.held, self.young, self.old = limit, 0, {}, {}

    def known(self, keys: Iterator[str]) -> tuple[dict[str, bytes], list[str]]:
        """(ids of the distinct ``keys`` that are remembered, the other keys)."""
        found, new, young, old = {}, [], self.young.get, self.old.get
        for key in keys:
            ids = young(key) or old(key)
            if ids is None:
                new.append(key)
            else:
                found[key] = ids
        return found, new

    def add(self, entries: dict[str, bytes]) -> None:
        young = self.young
        for key, ids in entries.items():
            if len(key) <= REMEMBERED and key not in young:
                young[key] = ids
                self.held += ENTRY_BYTES + len(key) * (1 if key.isascii() else 4) + len(ids)
                if self.held > self.limit:
                    self.old, self.held = young, 0
                    young = self.young = {}


class Encoder:
    """Texts -> int32 ids.

    A text is cut at single blanks first.  The split pattern attaches a single
    blank to a non-blank that follows it, so a blank starts a pre-token whatever
    stands before it, and the ids of blank + unit do not depend on the
    neighbours - unless a unit is empty or white space touches its edges; then
    the text is split whole.  Ids of units and pre-tokens seen lately are
    remembered; what is new in a batch goes through one queue together."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.findall = regex.compile(pattern).findall
        self.units, self.pieces = _Remembered(UNIT_BYTES), _Remembered(PIECE_BYTES)
        self.table = RankTable(ranks)

    def _merge(self, pieces: list[str]) -> list[bytes]:
        """Ids of each of the distinct pieces."""
        data = [p.encode() for p in pieces]
        out = [None if (w := self.table.ranks.get(d)) is None else array("i", (w,)).tobytes() for d in data]
        left = [i for i, ids in enumerate(out) if ids is None]
        for start in range(0, len(left), TOGETHER):
            some = left[start : start + TOGETHER]
            for i, ids in zip(some, merge_pieces([data[i] for i in some], self.table), strict=True):
                out[i] = array("i", ids).tobytes()
        return out

    def _parts(self, text: str) -> Iterator[str]:
        """A long text's parts: each but the first starts with a single blank."""
        start = 0
        while len(text) - start > LONG:
            cut = text.find(" ", start + LONG)
            while cut >= 0 and (cut + 1 == len(text) or text[cut - 1].isspace() or text[cut + 1].isspace()):
                cut = text.find(" ", cut + 1)
            if cut < 0:
                break
            yield text[start:cut]
            start = cut
        yield text[start:]

    def batch(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, as the bytes of an int32 array."""
        if not any(t and len(t) > LONG for t in texts):
            return self._short(texts)
        return [b"".join(self._short([p])[0] for p in self._parts(t)) if t else b"" for t in texts]

    def _short(self, texts: list[str | None]) -> list[bytes]:
        findall, get, unknown = self.findall, self.units.young.get, repeat(b"")
        firsts, looked, asked = [], [], []  # of each text: first unit; ids of the others (empty: not known); units not known
        for t in texts:
            first, blank, rest = t.partition(" ") if t else ("", "", "")
            units = rest.split(" ") if blank else []
            ids = list(map(get, units, unknown))
            firsts.append(first)
            looked.append(ids)
            asked.append([] if all(ids) else [u for u, x in zip(units, ids, strict=True) if not x])
        split: dict[str, list[str]] = {}
        words, joined = [], set()  # units that are a pre-token each; units that cannot stand alone
        known, missing = self.units.known(set().union(*asked))
        for u in missing:
            if u.isalpha():
                words.append(u)
            elif not u or u[0].isspace() or u[-1].isspace():
                joined.add(u)
            else:
                split[u] = findall(" " + u)
        odd = [bool(t) and (not f or f[-1].isspace() or not joined.isdisjoint(new)) for t, f, new in zip(texts, firsts, asked, strict=True)]
        heads = [findall(t if o else f) if t else [] for t, f, o in zip(texts, firsts, odd, strict=True)]
        pieces = {p for parts in split.values() for p in parts}.union(*heads)
        inside = {p[1:] for p in pieces if p[0] == " " and p[1:].isalpha()}  # blank and word: remembered as a unit
        more, missing = self.units.known(inside.difference(known, words))
        known.update(more)
        words += missing
        ids_of, missing = self.pieces.known(p for p in pieces if not (p[0] == " " and p[1:] in inside))
        made = self._merge([" " + w for w in words] + missing)
        known.update(zip(words, made))
        fresh = dict(zip(missing, made[len(words) :], strict=True))
        self.pieces.add(fresh)
        ids_of.update(fresh)
        ids_of.update((" " + w, known[w]) for w in inside)
        piece = ids_of.__getitem__
        for u, parts in split.items():
            known[u] = b"".join(map(piece, parts))
        out = []
        for ids, new, head, o in zip(looked, asked, heads, odd, strict=True):
            parts = list(map(piece, head))
            if not o:
                late = map(known.__getitem__, new)
                parts += [x or next(late) for x in ids] if new else ids
            out.append(b"".join(parts))
        self.units.add(known)
        return out

    def __call__(self, text: str | None) -> bytes:
        return self.batch([text])[0]


_WORKER: dict[str, Encoder] = {}


def _lists(chunks: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *(len(c) // 4 for c in chunks)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(chunks), np.int32)))


def encode_documents(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, *, text: str = "text", out: str = "ids", decoded: str | None = None
) -> DataFrame:
    """``docs`` plus ``out``: array<int> of token ids of the whole text, and if
    asked ``decoded``: the bytes those ids decode to (the same as
    ``decode_documents`` gives, without another worker)."""
    spark = docs.sparkSession
    python_ready(spark)
    shared = spark.sparkContext.broadcast((ranks, pattern))
    token = uuid.uuid4().hex
    kept = docs.select(*columns_but(docs, [out, decoded or out]))
    added = [T.StructField(out, T.ArrayType(T.IntegerType(), False))]
    added += [T.StructField(decoded, T.BinaryType())] if decoded else []
    at = kept.columns.index(text)
    tokens = token_bytes(ranks) if decoded else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
        if token not in _WORKER:  # a reused worker keeps what it remembers
            _WORKER.clear()
            _WORKER[token] = Encoder(*shared.value)
        encode = _WORKER[token]
        gc.disable()  # strings and lists only: no cycles, and many to walk
        try:
            for batch in batches:
                for part in small_batches(batch, at, BATCH_BYTES):
                    ids = _lists(encode.batch(part.column(at).to_pylist()))
                    more = [pa.array([_decode(x, *tokens) for x in ids], pa.binary())] if tokens else []
                    yield part.columns, [ids, *more]
        finally:
            gc.enable()
            pa.default_memory_pool().release_unused()

    return add_columns(kept, added, run)


def token_bytes(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens' bytes by rank, and where each starts and how long it is."""
    lengths = np.zeros(max(ranks.values(), default=-1) + 1, np.int64)
    for tok, rank in ranks.items():
        lengths[rank] = len(tok)
    blob = b"".join(tok for tok, _ in sorted(ranks.items(), key=lambda x: x[1]))
    return np.frombuffer(blob, np.uint8), np.cumsum(lengths) - lengths, lengths


def decode_documents(tokens: DataFrame, ranks: dict[bytes, int], *, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``tokens`` plus ``out``: the bytes (binary) that its ids stand for."""
    spark = tokens.sparkSession
    python_ready(spark)
    shared = spark.sparkContext.broadcast(token_bytes(ranks))
    kept = tokens.select(*columns_but(tokens, [out]))
    at = kept.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
        table = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, DECODE_ROWS):
                part = batch.slice(start, DECODE_ROWS)
                texts = [_decode(x, *table) for x in part.column(at)]
                yield part.columns, [pa.array(texts, pa.binary())]

    return add_columns(kept, [T.StructField(out, T.BinaryType())], run)


def _decode(ids: pa.ListScalar, blob: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> bytes:
    """Gather the ids' bytes from the concatenated tokens."""
    if not ids.is_valid or not len(ids.values):
        return b""
    whole, out = ids.values.to_numpy(), []
    for start in range(0, len(whole), DECODE_IDS):
        at = whole[start : start + DECODE_IDS]
        size = lengths[at]
        ends = np.cumsum(size)
        out.append(blob[np.arange(ends[-1]) + np.repeat(starts[at] - (ends - size), size)].tobytes())
    return b"".join(out)


def ids_sha256(ids) -> F.Column:
    """SHA-256, in lower-case hex, of the decimal ids joined by commas."""
    return F.sha2(F.concat_ws(",", F.col(ids).cast("array<string>")), 256)
