"""Byte-level BPE encoding and decoding with a segment tree per piece.

A text is cut by the pattern; each piece is a row of live byte ranges.  The
leaves of a segment tree hold the rank of the pair that starts at a byte
position (infinite where there is none), and every node the leftmost minimum
below it.  A merge takes the root, joins the two ranges, and makes at most three
point updates: the merged pair, the pair on its left, and the leaf that died.
A piece of n bytes costs O(n log n), however its pairs fall.

Pieces of ordinary length come again and again, so each worker keeps a bounded
table of what runs of non-space text encode to; a run between two single spaces
is always cut in the same way, whatever stands around it.

Defined cases: a null text counts as empty and has no ids; ids outside the
vocabulary raise; an empty table gives an empty result; special tokens are
ordinary text.
"""

from __future__ import annotations

import base64
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, functions as F

from tessera.llm.hashing import Prefix

#: Entries of each of a worker's two tables of encoded runs, and the longest run in them.
#: They stay over tasks; about 300,000 entries of about 200 bytes.
TABLE, LONGEST = 150_000, 48
#: Pieces of up to so many bytes are merged many at a time.
WIDEST = 64
#: Texts of one Arrow batch in and out of Python, by characters.
BATCH_CHARS = 1_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Vocabulary file: a base64 token and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}


def _tokens(ranks: dict[bytes, int]) -> list[bytes]:
    """Tokens by rank."""
    tokens = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return tokens


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: the lowest rank first, leftmost on ties."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    size = 1
    while size < n:
        size *= 2
    none = 1 << 60
    get = ranks.get
    # a node holds rank * size + position, so the minimum is also the leftmost
    tree = [none] * (2 * size)
    for i in range(n - 1):
        r = get(piece[i:i + 2])
        if r is not None:
            tree[size + i] = r * size + i
    for i in range(size - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b

    def update(i: int, value: int) -> None:
        i += size
        tree[i] = value
        i >>= 1
        while i:
            a, b = tree[2 * i], tree[2 * i + 1]
            v = a if a < b else b
            if tree[i] == v:
                return
            tree[i] = v
            i >>= 1

    end = list(range(1, n + 1))       # of the live range that starts here
    start = list(range(-1, n))        # of the live range that ends here; index by end
    while tree[1] != none:
        i = tree[1] & (size - 1)
        j = end[i]
        k = end[j]
        end[i], start[k] = k, i
        update(j, none)
        r = get(piece[i:end[k]]) if k < n else None
        update(i, none if r is None else r * size + i)
        if i:
            h = start[i]
            r = get(piece[h:k])
            update(h, none if r is None else r * size + h)
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return out


class PairRanks:
    """Rank of the token that two tokens join to, looked up for arrays of pairs."""

    def __init__(self, ranks: dict[bytes, int]):
        keys, values = [], []
        get = ranks.get
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = get(token[:cut]), get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(rank)
        order = np.argsort(np.asarray(keys, np.int64))
        self.keys = np.append(np.asarray(keys, np.int64)[order], np.iinfo(np.int64).max)
        self.values = np.append(np.asarray(values, np.int64)[order], 0)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks, -1 where the two do not join; a negative id joins with nothing."""
        want = left << 32 | np.maximum(right, 0)
        at = np.searchsorted(self.keys, want)
        return np.where((self.keys[at] == want) & (left >= 0) & (right >= 0), self.values[at], -1)


def merge_many(pieces: list[bytes], ranks: dict[bytes, int], pairs: PairRanks) -> list[bytes]:
    """:func:`merge_piece` of many pieces of 2 to ``WIDEST`` bytes, one tree per row of an array.

    Each step does one merge in every piece that has one left.  Ids come as int32 bytes.
    """
    out: list = [None] * len(pieces)
    byte_id = np.asarray([ranks[bytes([i])] for i in range(256)], np.int64)
    none = np.int32(1 << 30)  # above every rank * width
    lengths = np.asarray([len(x) for x in pieces])
    width = 2
    while width <= WIDEST:
        rows = np.flatnonzero((lengths <= width) & (lengths > width // 2 if width > 2 else lengths <= 2))
        for lo in range(0, len(rows), 20_000):
            part = rows[lo:lo + 20_000]
            n = lengths[part]
            m = len(part)
            raw = np.frombuffer(b"".join(pieces[i].ljust(width, b"\0") for i in part.tolist()), np.uint8).reshape(m, width)
            cols = np.arange(width)
            wide = width + 1
            tok = np.full((m, wide), -1, np.int64)
            tok[:, :width] = np.where(cols < n[:, None], byte_id[raw], -1)
            end = np.tile(np.arange(1, width + 2, dtype=np.int32), m)
            prev = np.tile(np.arange(-1, width, dtype=np.int32), m)
            tree = np.full((m, 2 * width), none, np.int32)
            r = pairs(tok[:, :width].ravel(), tok[:, 1:].ravel()).reshape(m, width)
            tree[:, width:] = np.where(r >= 0, r * width + cols, none)
            for node in range(width - 1, 0, -1):
                np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1], out=tree[:, node])
            live = np.flatnonzero(tree[:, 1] < none)
            flat, tree = tok.ravel(), tree.ravel()  # row r starts at r * wide and at r * 2 * width
            while len(live):
                base, top = live * wide, live * (2 * width)
                root = tree.take(top + 1)
                i, rank = root & (width - 1), root >> (width.bit_length() - 1)
                j = end.take(base + i)
                k = end.take(base + j)
                flat[base + i] = rank
                flat[base + j] = -1
                end[base + i] = k
                prev[base + k] = i
                h = prev.take(base + i)
                has = h >= 0
                h_at = np.where(has, h, i)
                both = pairs(np.concatenate([rank, np.where(has, flat.take(base + h_at), -1)]),
                             np.concatenate([flat.take(base + k), rank]))
                after, before = both[:len(live)], both[len(live):]
                leaf = top + width
                here = np.where(after >= 0, after * width + i, none)
                tree[leaf + j] = none
                tree[leaf + i] = here
                tree[leaf + h_at] = np.where(has, np.where(before >= 0, before * width + h, none), here)
                base3 = np.concatenate([top, top, top])
                node = np.concatenate([j, i, h_at]) + width >> 1
                while node[0]:
                    two = base3 + 2 * node
                    tree[base3 + node] = np.minimum(tree.take(two), tree.take(two + 1))
                    node >>= 1
                live = live[tree.take(live * (2 * width) + 1) < none]
            ids = tok[tok >= 0].astype(np.int32).tobytes()
            stops = (4 * np.cumsum((tok >= 0).sum(1))).tolist()
            at = 0
            for row, stop in zip(part.tolist(), stops):
                out[row] = ids[at:stop]
                at = stop
        width *= 2
    return out


def _run_starts(raw: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where runs start: at every text, and at every single space between two other characters than white space.

    A space next to a byte that may belong to white space outside ASCII is not
    taken, which only makes a run longer.
    """
    low = np.zeros(256, bool)
    low[[9, 10, 11, 12, 13, 32]] = True
    space = np.flatnonzero(raw == 32)
    space = space[(space > 0) & (space < len(raw) - 1)]
    lead = np.zeros(256, bool)
    lead[[0xC2, 0xE1, 0xE2, 0xE3]] = True
    after, before = raw[space + 1], raw[space - 1]
    open_ = (before >= 0x80) & (lead[raw[np.maximum(space - 2, 0)]] | lead[raw[np.maximum(space - 3, 0)]])
    cut = space[~low[after] & ~low[before] & ~lead[after] & ~open_]
    start = np.zeros(len(raw), bool)
    start[cut] = start[first] = True
    return np.flatnonzero(start)


def ragged(offsets: np.ndarray, lengths: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The stretches ``values[offset:offset + length]`` one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.arange(total) + np.repeat(offsets - (ends - lengths), lengths)]


class Encoder:
    """Pattern, ranks and a bounded table of encoded runs and pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pairs = ranks, PairRanks(ranks)
        # White_Space, as \s stands for in the pattern's own dialect
        self.cut = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}")
                                 .replace(r"\S", r"\P{White_Space}")).findall
        self.runs: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        tokens = _tokens(ranks)
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.token_size = np.asarray([len(t) for t in tokens], np.int64)
        self.token_start = np.cumsum(self.token_size) - self.token_size

    def _cut(self, runs: list[bytes]) -> tuple[list[bytes], np.ndarray]:
        """Pieces of all runs, and each run's number of pieces; runs are cut together, a line end between them, where that is safe."""
        joined = b"\n".join(runs).decode()
        pieces = self.cut(joined)
        end = np.fromiter(map("\n".__eq__, pieces), bool, len(pieces))
        if joined.count("\n") == len(runs) - 1 == np.count_nonzero(end):
            counts = np.diff(np.concatenate([[-1], np.flatnonzero(end), [len(pieces)]])) - 1
            return [p for p in map(str.encode, pieces) if p != b"\n"], counts
        cuts = [self.cut(r.decode()) for r in runs]
        return list(map(str.encode, chain.from_iterable(cuts))), np.fromiter(map(len, cuts), np.int64, len(cuts))

    def _fill(self, new: list[bytes]) -> list[bytes]:
        """Ids of new runs; each piece that is not known yet is merged once."""
        if len(self.runs) + len(new) > TABLE:  # the older half goes
            self.older, self.runs = self.runs, {}
        known, older, out = self.runs, self.older, [b""] * len(new)
        plain, rest = [], []
        for i, r in enumerate(new):
            (plain if len(r.split()) == 1 and r[-1] > 32 and r[:2].strip() and b"\n" not in r else rest).append(i)
        long = [r for r in new if len(r) > LONGEST]
        for group in (plain, rest):
            if not group:
                continue
            runs = [new[i] for i in group]
            pieces, counts = self._cut(runs)
            ask = list(set(pieces).difference(known))
            long += [p for p in ask if len(p) > LONGEST]
            kept = [p for p in ask if p in older]
            known.update(zip(kept, map(older.__getitem__, kept)))
            short = []
            for piece in set(ask).difference(kept):
                whole = self.ranks.get(piece)
                if whole is not None:
                    known[piece] = whole.to_bytes(4, "little")
                elif len(piece) > WIDEST:
                    known[piece] = np.asarray(merge_piece(piece, self.ranks), np.int32).tobytes()
                else:
                    short.append(piece)
            known.update(zip(short, merge_many(short, self.ranks, self.pairs)))
            ids = list(map(known.__getitem__, pieces))
            upto = np.concatenate([[0], np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))])
            ends = upto[np.cumsum(counts)].tolist()
            flat, lo = b"".join(ids), 0
            for i, hi in zip(group, ends):
                out[i], lo = flat[lo:hi], hi
            known.update(zip(runs, map(out.__getitem__, group)))
        for r in long:
            known.pop(r, None)
        return out

    def encode_many(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text's ids start and end.

        Runs are told apart by a 64-bit hash; a hash that stood for two runs
        would show when the ids are decoded, and the texts are then done one
        by one.
        """
        data = [t.encode() for t in texts]
        sizes = np.asarray([len(d) for d in data], np.int64)
        whole = b"".join(data)
        if not whole:
            return np.empty(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        raw = np.frombuffer(whole, np.uint8)
        first = np.cumsum(sizes) - sizes
        lo = _run_starts(raw, first[sizes > 0])
        hi = np.append(lo[1:], len(raw))
        _, one, which = np.unique(Prefix(raw).hash(lo, hi), return_index=True, return_inverse=True)
        runs = [whole[a:b] for a, b in zip(lo[one].tolist(), hi[one].tolist())]
        known, older = self.runs.get, self.older.get
        ids = [x or older(r) for r, x in zip(runs, map(known, runs))]
        missing = [i for i, x in enumerate(ids) if x is None]
        if missing:
            for i, got in zip(missing, self._fill([runs[i] for i in missing])):
                ids[i] = got
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), np.int32)
        out = ragged((np.cumsum(size) - size)[which], size[which], flat)
        upto = np.concatenate([[0], np.cumsum(size[which])])
        ends = upto[np.searchsorted(lo, np.append(first, len(raw)))]
        if len(texts) > 1 and self.decode(out) != whole:
            parts = [self.encode_many([t])[0] for t in texts]
            return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])
        return out, ends

    def encode(self, text: str) -> list[int]:
        return self.encode_many([text])[0].tolist()

    def decode(self, ids: np.ndarray) -> bytes:
        ids = np.asarray(ids, np.int64)
        return ragged(self.token_start[ids], self.token_size[ids], self.token_bytes).tobytes()


@lru_cache(maxsize=2)
def _encoder(name: str, pattern: str) -> Encoder:
    return Encoder(read_ranks(SparkFiles.get(name)), pattern)


def _slices(batches, column: str):
    """Batches of about ``BATCH_CHARS`` characters, each with its texts."""
    for b in batches:
        upto = np.cumsum(pc.fill_null(pc.utf8_length(b.column(column)), 0).to_numpy().astype(np.int64) + 64)
        lo = 0
        while lo < b.num_rows:
            hi = min(int(np.searchsorted(upto, BATCH_CHARS + (upto[lo - 1] if lo else 0))) + 1, b.num_rows)
            part = b.slice(lo, hi - lo)
            yield part, part.column(column).to_pylist()
            lo = hi


def _add(batch: pa.RecordBatch, column: pa.Array, name: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, name])


def _share(df: DataFrame, path: str) -> str:
    """Ship the vocabulary file to the executors; its base name there."""
    df.sparkSession.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]


def encode(df: DataFrame, path: str, pattern: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``df`` with ``ids_col array<int>``: ids of each whole text; no shuffle. A column of that name is replaced."""
    name = _share(df, path)
    df = df.drop(ids_col)

    def run(batches):
        enc = _encoder(name, pattern)
        for part, texts in _slices(batches, text_col):
            ids, ends = enc.encode_many([t or "" for t in texts])
            yield _add(part, pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32))), ids_col)

    return df.mapInArrow(run, df.select("*", F.lit(None).cast("array<int>").alias(ids_col)).schema)


def decode(df: DataFrame, path: str, ids_col: str = "ids", bytes_col: str = "decoded", pattern: str = "") -> DataFrame:
    """``df`` with ``bytes_col binary``: the bytes that the ids stand for. A column of that name is replaced.

    Done by Spark's own functions, so a task that encodes and decodes has one Python worker; needs no ``pattern``.
    """
    tokens = _tokens(read_ranks(SparkFiles.get(_share(df, path))))
    df = df.drop(bytes_col)
    known = F.split(F.lit(",".join(t.hex() for t in tokens)), ",")
    ids = F.coalesce(df[f"`{ids_col}`"], F.array().cast("array<int>"))
    # what is not in the vocabulary is no hex text
    text = F.array_join(F.transform(ids, lambda i: F.get(known, i.try_cast("int"))), "", "?")
    outside = F.raise_error(F.lit("ids outside the vocabulary")).cast("binary")
    return df.withColumn(bytes_col, F.coalesce(F.unhex(text), outside))
