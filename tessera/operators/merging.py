"""Pair merging over a distributed word table, many merges a round.

One-at-a-time merging takes the best pair of all each time.  Pairs are ordered by

    count (most first), covered characters (fewest first), left, right.

A merge of (A, B) changes the count of those pairs only that share a place with it:
(., A) and (B, .).  A pair that comes before all of these in the order, here called
*ready*, will be merged at its present count, whatever is merged before it:
counts of other pairs never grow, and a pair that a merge brings up
covers more characters than the pair it replaces at no higher count, so it can't come first
either.  All ready pairs are therefore merged in one round, and sorted by the order they are the
sequence that one-at-a-time merging gives.  The order needs the length so that ties
never let a new pair overtake a ready one.

The exception is a pair whose product is a symbol already (or reads like one): merging it adds to
the counts of that symbol's pairs.  It is a barrier: pairs after it wait, and it is merged alone
when it is the best of all.  Where pairs after it were merged already, the round goes back to the last
state at which the sequence was known to be whole, and merges only what comes before it.

A round reads the words once, as lists of symbol numbers (numpy inside the tasks), writes those that
still have a pair, and the changes of the pair counts; the counts are summed by pair.  The driver sees
the best pairs only, never more than the size of the vocabulary.  Each round's tables are
staged in the shared folder, and older ones are deleted.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.session import checkpoint_dir, scratch_path
from tessera.sources import fs

PREFIX = "##"
#: Pairs that the driver looks at in a round, at least.
LEAST = 1024
_PAIR = "left string, right string, n long"
_ROW = "n long, symbols array<int>, left string, right string, change long"


def product(left: str, right: str) -> str:
    """The symbol that two symbols join to."""
    return left + (right[len(PREFIX):] if right.startswith(PREFIX) else right)


def covered(left: str, right: str) -> int:
    """Characters of the words that a pair covers."""
    return sum(len(s) - len(PREFIX) * s.startswith(PREFIX) for s in (left, right))


def merge_rows(flat: np.ndarray, sizes: np.ndarray, keys: np.ndarray, products: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lists of symbol numbers, one after the other, with all pairs in ``keys`` joined from the left."""
    if len(flat) < 2 or not len(keys):
        return flat, sizes
    pair = flat[:-1] << 32 | flat[1:]
    at = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
    hit = keys[at] == pair
    ends = np.cumsum(sizes)
    hit[(ends[(ends > 0) & (ends < len(flat))] - 1)] = False
    # only a pair of one symbol with itself can follow itself: every second one of a row is joined
    n = np.arange(len(hit))
    start = np.maximum.accumulate(np.where(hit & ~np.concatenate([[False], hit[:-1]]), n, -1))
    hit &= (n - start) % 2 == 0
    place = np.flatnonzero(hit)
    out = flat.copy()
    out[place] = products[at[place]]
    keep = np.ones(len(flat), bool)
    keep[place + 1] = False
    gone = np.concatenate([[0], np.cumsum(~keep)])
    return out[keep], sizes - (gone[ends] - gone[ends - sizes])


def _pairs(flat: np.ndarray, sizes: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if len(flat) < 2:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    inside = np.ones(len(flat) - 1, bool)
    ends = np.cumsum(sizes)
    inside[(ends[(ends > 0) & (ends < len(flat))] - 1)] = False
    return (flat[:-1] << 32 | flat[1:])[inside], np.repeat(weight, sizes)[:-1][inside]


def _pass(words: DataFrame, names: list[str], merges: list[tuple[int, int, int]], first: bool) -> DataFrame:
    """Words (``n``, ``symbols``) after ``merges`` (left, right, product), and the changes of pair counts."""
    merges = sorted((left << 32 | right, new) for left, right, new in merges)
    keys = np.asarray([k for k, _ in merges], np.int64)
    products = np.asarray([p for _, p in merges], np.int64)
    strings = pa.array(names, pa.string())

    def run(batches):
        for b in batches:
            weight = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            lists = b.column(1)
            sizes = np.asarray(lists.value_lengths().fill_null(0), np.int64)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            new, after = merge_rows(flat, sizes, keys, products)
            if first:
                pair, change = _pairs(flat, sizes, weight)
            else:
                touched = after != sizes
                old = _pairs(flat[np.repeat(touched, sizes)], sizes[touched], weight[touched])
                now = _pairs(new[np.repeat(touched, after)], after[touched], weight[touched])
                pair, change = np.concatenate([old[0], now[0]]), np.concatenate([-old[1], now[1]])
            found, place = np.unique(pair, return_inverse=True)
            total = np.zeros(len(found), np.int64)
            np.add.at(total, place, change)
            found, total = found[total != 0], total[total != 0]
            more = after > 1
            symbols = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(after[more])]).astype(np.int32)),
                                               pa.array(new[np.repeat(more, after)].astype(np.int32)))
            kept, rows = int(more.sum()), len(found)
            left, right = strings.take(pa.array(found >> 32)), strings.take(pa.array(found & 0xFFFFFFFF))
            yield pa.record_batch([
                pa.concat_arrays([pa.array(weight[more]), pa.nulls(rows, pa.int64())]),
                pa.concat_arrays([symbols, pa.nulls(rows, symbols.type)]),
                pa.concat_arrays([pa.nulls(kept, pa.string()), left]), pa.concat_arrays([pa.nulls(kept, pa.string()), right]),
                pa.concat_arrays([pa.nulls(kept, pa.int64()), pa.array(total)])], names=["n", "symbols", "left", "right", "change"])

    return words.select("n", "symbols").mapInArrow(run, _ROW)


@dataclass
class _State:
    words: str
    pairs: str
    done: list = field(default_factory=list)      # merges in final order, up to the last barrier
    recent: list = field(default_factory=list)    # merges since then, in any order

    def copy(self) -> "_State":
        return _State(self.words, self.pairs, list(self.done), list(self.recent))

    def order(self) -> list:
        return self.done + sorted(self.recent)


class PairMerger:
    """Rounds of merges over ``words`` (``n``, ``symbols array<string>``)."""

    def __init__(self, words: DataFrame, alphabet: list[str], min_frequency: int):
        self.spark = words.sparkSession
        checkpoint_dir(self.spark)
        self.names = list(alphabet)
        self.number = {s: i for i, s in enumerate(self.names)}
        self.alphabet, self.known = set(alphabet), set(alphabet)
        self.least = min_frequency
        self.rounds = 0
        number = dict(self.number)

        def run(batches):
            for b in batches:
                lists = b.column(1)
                ids = [number[s] for s in lists.flatten().to_pylist()]
                ends = np.concatenate([[0], np.cumsum(np.asarray(lists.value_lengths().fill_null(0), np.int64))])
                yield pa.record_batch([b.column(0), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids, pa.int32()))],
                                      names=["n", "symbols"])

        numbered = words.where(F.size("symbols") > 1).select("n", "symbols").mapInArrow(run, "n long, symbols array<int>")
        at = self._stage(_pass(numbered, self.names, [], True), "words")
        self.state = _State(at, self._stage(self._sum(self._changes(at)), "pairs"))
        self.clean = self.state.copy()
        self.floor = None

    def _stage(self, df: DataFrame, name: str) -> str:
        at = scratch_path(self.spark, name)
        df.write.parquet(at)
        return at

    def _read(self, at: str, schema: str = _ROW) -> DataFrame:
        return self.spark.read.schema(schema).parquet(at)

    def _changes(self, at: str) -> DataFrame:
        return self._read(at).where(F.col("left").isNotNull()).select("left", "right", F.col("change").alias("n"))

    @staticmethod
    def _sum(rows: DataFrame) -> DataFrame:
        return rows.groupBy("left", "right").agg(F.sum("n").alias("n")).where(F.col("n") > 0)

    def _drop(self, state: _State) -> None:
        for at in (state.words, state.pairs):
            if at not in (self.clean.words, self.clean.pairs, self.state.words, self.state.pairs):
                fs.remove(self.spark, at)

    def _best(self, limit: int) -> list:
        """The best pairs, as (order, left, right)."""
        chars = lambda c: F.char_length(c) - F.when(F.col(c).startswith(PREFIX), len(PREFIX)).otherwise(0)
        rows = (self._read(self.state.pairs, _PAIR).where(F.col("n") >= self.least)
                .select("left", "right", "n", (chars("left") + chars("right")).alias("c"))
                .orderBy(F.desc("n"), "c", "left", "right").limit(limit).collect())
        return [((-r["n"], r["c"], r["left"], r["right"]), r["left"], r["right"]) for r in rows]

    def _barrier(self, best: list):
        """Order of the first pair whose product is a symbol already, or reads like one of another place."""
        seen = set()
        for key, left, right in best:
            new = product(left, right)
            if new in self.known or new in seen or new.startswith(PREFIX) and not left.startswith(PREFIX):
                return key
            seen.add(new)
        return None

    @staticmethod
    def _ready(best: list, before) -> list:
        """Pairs that come before every pair that shares a place with them."""
        by_right, by_left = {}, {}
        for key, left, right in best:
            by_right.setdefault(right, key)
            by_left.setdefault(left, key)
        return [(key, left, right) for key, left, right in best
                if (before is None or key < before) and by_right.get(left, key) >= key and by_left.get(right, key) >= key]

    def run(self, room: int, one_at_a_time: bool = False) -> list[str]:
        """The new symbols of the first merges, in order, until ``room`` are there or no pair is left."""
        while sum(m[3] for m in self.state.done) < room:
            new = [m for m in self.state.order() if m[3]]
            best = self._best(max(LEAST, room - len(new)))
            if len(new) >= room:
                best = [p for p in best if p[0] < new[room - 1][0]]
            if not best:
                break
            barrier = self._barrier(best)
            if barrier is not None and any(m[0] > barrier for m in self.state.recent):
                gone, self.state = self.state, self.clean.copy()
                self.known = self.alphabet | {product(m[1], m[2]) for m in self.state.order()}
                self.floor = barrier if self.floor is None else min(barrier, self.floor)
                self._drop(gone)
                continue
            before = min((k for k in (barrier, self.floor) if k is not None), default=None)
            ready = [] if one_at_a_time else self._ready(best, before)
            self._merge(ready or best[:1], not ready)
        return [product(m[1], m[2]) for m in self.state.order() if m[3]][:max(room, 0)]

    def _merge(self, chosen: list, alone: bool) -> None:
        merges, old = [], self.state
        for key, left, right in chosen:
            new = product(left, right)
            old.recent.append((key, left, right, new not in self.known))
            self.known.add(new)
            if new not in self.number:
                self.number[new] = len(self.names)
                self.names.append(new)
            merges.append((self.number[left], self.number[right], self.number[new]))
        words = self._read(old.words).where(F.col("symbols").isNotNull())
        at = self._stage(_pass(words, self.names, merges, False), "words")
        pairs = self._read(old.pairs, _PAIR).unionByName(self._changes(at))
        self.state = _State(at, self._stage(self._sum(pairs), "pairs"), old.done, old.recent)
        self.rounds += 1
        if alone:  # all before it is whole
            gone = self.clean
            self.state.done, self.state.recent = self.state.order(), []
            self.clean, self.floor = self.state.copy(), None
            self._drop(gone)
        self._drop(old)

    def close(self) -> None:
        """Deletes the last staged tables."""
        for at in {self.state.words, self.state.pairs, self.clean.words, self.clean.pairs}:
            fs.remove(self.spark, at)
