"""Suffix-array dedup: every byte covered by a long repeat goes.

A repeat is a byte string of ``LENGTH`` bytes that starts at two places or more,
in one document or in several.  Places are judged on the input, overlaps count.

Partitioning.  A window of ``LENGTH`` bytes belongs to the smallest hash among
its ``GRAM``-byte strings.  Equal windows have equal smallest hashes, so they
meet, and neighbouring windows mostly share theirs: a maximal stretch of starts
with one hash is a *run* (about 190 starts), kept as one string.  A run whose hash
occurs nowhere else holds no repeat and is dropped before any text moves.

1. Hashes of runs are counted (numbers only).  If all runs of a hash are equal
   (128 bits), every one of them is a repeat as a whole.
2. Otherwise one string of each distinct run goes to the task of its hash.  There
   the strings form an enhanced suffix array (prefix doubling, then common
   prefixes of neighbours).  A stack scan builds the common-prefix interval tree;
   an interval of at least ``LENGTH`` whose occurrences have different bytes on
   their left is a maximal repeat, and its group holds all its occurrences.
   An interval with one and the same byte on the left lies inside a longer repeat.
3. A hash whose distinct runs hold more than ``HOT`` bytes (a passage that very many
   documents share, each with other text around) would make one large group.
   Its windows are counted by a 128-bit hash instead, exactly as many rows as
   it has windows, spread over all tasks.
4. Covered ranges meet their documents and are cut out.

Tables of counted size are broadcast, larger ones are joined by shuffle.

Passages of many short words may be shorter than ``LENGTH`` bytes.  On request
passages of a number of words that stand in several documents go too: runs are made of
windows of words in the same way, those with equal copies in several documents are taken
as a whole, and the windows of the others that share a hash are counted by 128-bit hashes.

Defined cases: a null text is empty; rows with the same id and text are two
documents and repeat each other; texts below ``LENGTH`` bytes stay whole; other
columns pass through; an empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tessera.llm.hashing import Prefix, mix, word_hashes
from tessera.session import scratch_path
from tessera.sources.fs import remove

LENGTH, GRAM = 400, 32
#: White space between words.
SPACE = r"\x20\x09-\x0D"
#: Bytes of the distinct runs of one hash beyond which its windows are counted by
#: hash: a suffix array takes about 70 bytes for each byte of text.
HOT = 4 << 20
#: Bytes of text of one suffix array, and of one step of the scan.
ARRAY, STEP = 1 << 20, 1 << 20
#: Windows of words after which a batch of them ends.
WINDOWS = 50_000
#: Rows, and elements of their lists, up to which a table is broadcast.
BROADCAST_ROWS, BROADCAST_ITEMS = 200_000, 1_000_000


def window_minima(grams: np.ndarray, width: int) -> np.ndarray:
    """Smallest value of every stretch of ``width`` values."""
    n = len(grams) - width + 1
    pad = -len(grams) % width
    x = np.concatenate([grams, np.full(pad, np.iinfo(np.uint64).max)]).reshape(-1, width)
    left = np.minimum.accumulate(x, axis=1).ravel()
    right = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1:width - 1 + n])


def _pieces(texts: list[bytes], length: int):
    """Texts of enough bytes, joined to buffers of about STEP: (buffer, [(text, offset in text, from, to)])."""
    parts, where, size = [], [], 0
    for i, t in enumerate(texts):
        for lo in range(0, len(t) - length + 1, STEP):
            part = t[lo:lo + STEP + length - 1]
            parts.append(part), where.append((i, lo, size, size + len(part)))
            size += len(part)
            if size >= STEP:
                yield b"".join(parts), where
                parts, where, size = [], [], 0
    if parts:
        yield b"".join(parts), where


def find_runs(texts: list[bytes], length: int = LENGTH, gram: int = GRAM):
    """Arrays ``text, start, starts, hash, print, again`` of all runs of the texts.

    ``again``: the smallest hash stands at two places of the run or more, so the
    run may hold equal windows itself.
    """
    width = length - gram + 1
    out = []
    for raw, where in _pieces(texts, length):
        sums = Prefix(np.frombuffer(raw, np.uint8))
        grams = sums.windows(gram)
        low = window_minima(grams, width)
        lo = np.asarray([w[2] for w in where])
        hi = np.asarray([w[3] for w in where]) - length + 1  # starts of each text: [lo, hi)
        cut = np.ones(len(low), bool)
        cut[1:] = low[1:] != low[:-1]
        cut[lo] = True
        owner = np.searchsorted(lo, np.arange(len(low)), "right") - 1
        inside = np.arange(len(low)) < hi[owner]
        first = np.flatnonzero(cut & inside)
        stop = np.minimum(np.append(np.flatnonzero(cut), len(low))[np.searchsorted(np.flatnonzero(cut), first) + 1], hi[owner[first]])
        own = owner[first]
        shift = np.asarray([w[1] - w[2] for w in where])
        # places that are the smallest of some window: the largest minimum of the windows over them is theirs
        around = np.concatenate([np.full(width - 1, ~np.uint64(0)), ~low, np.full(width - 1, ~np.uint64(0))])
        spots = np.flatnonzero(~window_minima(around, width) == grams)
        a, z = np.searchsorted(spots, first), np.searchsorted(spots, stop + width - 1)
        run = np.repeat(np.arange(len(first)), z - a)
        spot = spots[np.arange(len(run)) - np.repeat(np.cumsum(z - a) - (z - a), z - a) + np.repeat(a, z - a)]
        many = np.bincount(run[grams[spot] == low[first[run]]], minlength=len(first)) > 1
        out.append((np.asarray([w[0] for w in where])[own], first + shift[own], stop - first,
                    low[first].astype(np.int64), sums.hash(first, stop + length - 1).astype(np.int64), many))
    if not out:
        return [np.empty(0, np.int64)] * 5 + [np.empty(0, bool)]
    return [np.concatenate(c) for c in zip(*out)]


def suffix_order(strings: list[bytes], stop: int):
    """Prefix doubling over the strings, each with an end sign below all bytes.

    Returns the end of each position's string, the ranks by (7, 14, 28, ...)
    symbols until ``stop``, and the symbols.
    """
    lengths = np.asarray([len(s) for s in strings])
    ends = np.cumsum(lengths + 1) - 1
    sym = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8).astype(np.int16) + np.int16(1)
    sym[ends] = 0
    n = len(sym)
    end = np.repeat(ends.astype(np.int32), lengths + 1)
    at = np.arange(n, dtype=np.int32)
    key = np.zeros(n, np.int64)
    for j in range(7):
        key <<= 9
        key |= sym[np.minimum(at + j, end)]
    act = np.argsort(key, kind="stable").astype(np.int32)
    rank = np.empty(n, np.int32)

    def heads(sorted_keys):
        new = np.ones(len(sorted_keys), bool)
        new[1:] = sorted_keys[1:] != sorted_keys[:-1]
        return new

    new = heads(key[act])
    first = np.flatnonzero(new)
    rank[act] = np.repeat(first, np.diff(np.append(first, n)))
    del at
    size, levels = 7, [rank.copy()]

    def several(act, new):
        first = np.flatnonzero(new)
        return act[np.repeat(np.diff(np.append(first, len(act))) > 1, np.diff(np.append(first, len(act))))]

    del key
    act = several(act, new)
    while size < stop and len(act):
        key = rank[act].astype(np.int64) * n + rank[np.minimum(act + np.int64(size), end[act])]
        order = np.argsort(key, kind="stable")
        act, key = act[order], key[order]
        old = key // n
        was, new = heads(old), heads(key)
        i = np.arange(len(act))
        rank[act] = old + np.maximum.accumulate(np.where(new, i, 0)) - np.maximum.accumulate(np.where(was, i, 0))
        act = several(act, new)
        size *= 2
        levels.append(rank.copy())
    return end, levels, sym


def common_prefixes(a: np.ndarray, b: np.ndarray, end, levels, sym) -> np.ndarray:
    """Lengths of the common prefixes of the suffixes at ``a`` and ``b``, without end signs."""
    n = np.zeros(len(a), np.int64)
    for i in range(len(levels) - 1, -1, -1):
        r = levels[i]
        n += np.where(r[np.minimum(a + n, end[a])] == r[np.minimum(b + n, end[b])], 7 << i, 0)
    for _ in range(7):
        n += sym[np.minimum(a + n, end[a])] == sym[np.minimum(b + n, end[b])]
    return np.minimum(n, np.minimum(end[a] - a, end[b] - b))


def maximal_repeats(lcp: list[int], left: list[int], length: int):
    """Stack scan of neighbours' common prefixes: yields ``(length, ranges, whole)``.

    ``left`` holds the byte before each suffix, -1 for one without equal.
    ``whole`` is the range (first, last) of all occurrences in suffix order;
    ``ranges`` are those that no longer repeat below has covered yet.
    """
    stack: list[list] = []  # [common prefix, first, left byte or -1, open ranges]
    for i in range(len(left)):
        h = lcp[i] if i < len(lcp) else 0  # with the next suffix
        mine = [(i, i)]
        sign, first = left[i], i
        while stack and stack[-1][0] > h:
            top = stack.pop()
            top[3] += mine
            top[2] = top[2] if top[2] == sign else -1
            mine, sign, first = top[3], top[2], top[1]
            if sign < 0:
                yield top[0], mine, (first, i)
                mine = []
        if h >= length:
            if stack and stack[-1][0] == h:
                top = stack[-1]
                top[3] += mine
                top[2] = top[2] if top[2] == sign else -1
            else:
                stack.append([h, first, sign, mine])
        elif stack:  # cannot be: all open prefixes are at least ``length``
            raise AssertionError("open interval")


def repeats_in(strings: list[bytes], starts: list[int], before: list[int], length: int = LENGTH):
    """Maximal repeats of at least ``length`` among the first ``starts[i]`` suffixes of string ``i``.

    Yields ``(repeat length, [(string, offset), ...] newly covered, number of occurrences)``.
    ``before[i]`` is the byte before string ``i``, which counts as unlike any other,
    since that occurrence is not among the starts.
    """
    end, levels, sym = suffix_order(strings, max(map(len, strings), default=0) + 1)
    base = np.concatenate([[0], np.cumsum([len(s) + 1 for s in strings])])
    count = np.asarray(starts)
    pos = np.repeat(base[:-1] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
    string = np.repeat(np.arange(len(strings)), count)
    order = np.argsort(levels[-1][pos], kind="stable")
    sa, string = pos[order], string[order]
    lcp = common_prefixes(sa[:-1], sa[1:], end, levels, sym) if len(sa) > 1 else np.empty(0, np.int64)
    long_ = lcp >= length
    if not long_.any():
        return
    keep = np.zeros(len(sa), bool)  # suffixes next to a long common prefix
    keep[:-1] |= long_
    keep[1:] |= long_
    at = np.flatnonzero(keep)
    offset = sa[at] - base[string[at]]
    left = np.where(offset > 0, sym[np.maximum(sa[at] - 1, 0)], -1).tolist()
    short = np.where(np.diff(at) == 1, lcp[np.minimum(at[:-1], len(lcp) - 1)], 0)
    short = np.where(short >= length, short, 0).tolist()
    for n, ranges, (first, last) in maximal_repeats(short, left, length):
        yield n, [(int(string[at[i]]), int(offset[i])) for lo, hi in ranges for i in range(lo, hi + 1)], last - first + 1


def merge_spans(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [tuple(x) for x in out]


_SPAN = "d long, t long, lo long, hi long"


def _span_batch(rows):
    d, t, lo, hi = zip(*rows) if rows else ((), (), (), ())
    return pa.record_batch([pa.array(x, pa.int64()) for x in (d, t, lo, hi)], names=["d", "t", "lo", "hi"])


def _array_spans(batches, length: int):
    """Suffix arrays over whole hash groups, several in one array; spans of runs that occur once."""
    group, held, size, last = [], [], 0, None

    def solve(rows):
        cover: dict[int, list] = {}
        strings = [r["string"] for r in rows]
        for n, places, _ in repeats_in(strings, [r["starts"] for r in rows], [-1] * len(rows), length):
            for i, off in places:
                if rows[i]["n"] == 1:
                    cover.setdefault(i, []).append((off, off + n))
        return [(rows[i]["d"], rows[i]["t"], rows[i]["s"] + lo, rows[i]["s"] + hi)
                for i, spans in cover.items() for lo, hi in merge_spans(spans)]

    for b in batches:
        for row in b.to_pylist():
            if row["h"] != last:
                held, last = held + group, row["h"]
                group = []
                if size >= ARRAY:
                    yield _span_batch(solve(held))
                    held, size = [], 0
            group.append(row)
            size += len(row["string"])
    held += group
    yield _span_batch(solve(held) if held else [])


def _small(df: DataFrame, items: str | Column | None = None) -> bool:
    n = df.agg(F.count(F.lit(1)), F.lit(0) if items is None else F.sum(F.size(items))).first()
    return n[0] <= BROADCAST_ROWS and (n[1] or 0) <= BROADCAST_ITEMS


def _with_key(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Adds ``d`` (id, or the smallest long for null) and ``t`` (hash of the text): the key of a row."""
    return docs.withColumns({"d": F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)).cast("long")),
                             "t": F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))})


def word_places(raw: bytes) -> list[tuple[int, int]]:
    """Ranges of bytes of a text's words."""
    return [m.span() for m in re.finditer(rf"[^{SPACE}]+".encode(), raw)]


def repeat_spans(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``d, t, spans array<struct<lo, hi>>`` of the documents that hold repeats; ranges may overlap."""
    spark = docs.sparkSession
    stage = scratch_path(spark, "repeats")
    keyed = _with_key(docs.select(id_col, text_col), id_col, text_col).select(
        "d", "t", F.coalesce(text_col, F.lit("")).alias("text"))

    def runs_of(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 400):
                part = b.slice(lo, 400)
                text, s, m, h, f, again = find_runs([x.encode() for x in part.column("text").to_pylist()], length)
                take = pa.array(text)
                yield pa.record_batch([pa.array(h), pa.array(f), part.column("d").take(take), part.column("t").take(take),
                                       pa.array(s, pa.int64()), pa.array(m, pa.int64()), pa.array(again)],
                                      names=["h", "f", "d", "t", "s", "m", "again"])

    keyed.mapInArrow(runs_of, "h long, f long, d long, t long, s long, m long, again boolean").write.parquet(f"{stage}/runs")
    runs = spark.read.parquet(f"{stage}/runs")
    counted = (runs.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("f").alias("f0"), F.max("f").alias("f1"),
                                     F.max("again").alias("again"))
               .where("n > 1 or again").select(F.col("h").alias("_h"), F.expr("n > 1 and f0 = f1").alias("equal")))
    runs.join(counted, F.col("h") == F.col("_h")).drop("_h", "again").write.parquet(f"{stage}/shared")
    remove(spark, f"{stage}/runs")
    shared = spark.read.parquet(f"{stage}/shared")
    whole = lambda df: df.select("d", "t", F.col("s").alias("lo"), (F.col("s") + F.col("m") + length - 1).alias("hi"))

    # distinct runs of the hashes that have several
    mixed = shared.where("not equal")
    kinds = mixed.groupBy("h", "f").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("d", "t", "s", "m")).alias("r"))
    kinds.write.parquet(f"{stage}/kinds")
    kinds = spark.read.parquet(f"{stage}/kinds")
    again = kinds.where("n > 1").select(F.col("h").alias("_h"), F.col("f").alias("_f"))
    copies = mixed.join(again, (F.col("h") == F.col("_h")) & (F.col("f") == F.col("_f"))).drop("_h", "_f")

    # their strings, one of each
    hot = kinds.groupBy("h").agg(F.sum(F.col("r.m") + length).alias("k")).where(F.col("k") > HOT).select(F.col("h").alias("_h"), F.lit(True).alias("hot"))
    asked = (kinds.join(hot, F.col("h") == F.col("_h"), "left")
             .select(F.col("r.d").alias("d"), F.col("r.t").alias("t"), F.struct(
                 "h", "n", F.col("r.s").alias("s"), F.col("r.m").alias("m"), F.coalesce("hot", F.lit(False)).alias("hot")).alias("x"))
             .groupBy("d", "t").agg(F.collect_list("x").alias("xs")).checkpoint())
    texts = keyed.join(F.broadcast(asked) if _small(asked, "xs") else asked, ["d", "t"])

    def cut(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 64):
                rows = []
                for r in b.slice(lo, 64).to_pylist():
                    raw = r["text"].encode()
                    rows += [(x["h"], x["n"], x["hot"], r["d"], r["t"], x["s"], x["m"], raw[x["s"]:x["s"] + x["m"] + length - 1])
                             for x in r["xs"]]
                cols = list(zip(*rows)) or [()] * 8
                yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, (
                    pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                    names=["h", "n", "hot", "d", "t", "s", "starts", "string"])

    texts.mapInArrow(cut, "h long, n long, hot boolean, d long, t long, s long, starts long, string binary") \
        .dropDuplicates(["h", "d", "t", "s"]).write.parquet(f"{stage}/strings")
    strings = spark.read.parquet(f"{stage}/strings")
    found = (strings.where("not hot").repartition("h").sortWithinPartitions("h")
             .mapInArrow(lambda it: _array_spans(it, length), _SPAN))

    def windows(batches):
        for b in batches:
            for r in b.to_pylist():
                raw = np.frombuffer(r["string"], np.uint8)
                one = Prefix(raw).windows(length)
                two = Prefix(raw ^ np.uint8(0x5A)).windows(length)
                n = len(one)
                yield pa.record_batch([pa.array(one.astype(np.int64)), pa.array(two.astype(np.int64)),
                                       pa.array(np.full(n, r["n"])), pa.array(np.full(n, r["d"])), pa.array(np.full(n, r["t"])),
                                       pa.array(r["s"] + np.arange(n))], names=["w", "v", "n", "d", "t", "s"])

    every = strings.where("hot").mapInArrow(windows, "w long, v long, n long, d long, t long, s long")
    twice = every.groupBy("w", "v").agg(F.sum("n").alias("c")).where("c > 1").select(F.col("w").alias("_w"), F.col("v").alias("_v"))
    counted_spans = (every.join(twice, (F.col("w") == F.col("_w")) & (F.col("v") == F.col("_v")))
                     .select("d", "t", F.col("s").alias("lo"), (F.col("s") + length).alias("hi")))
    spans = whole(shared.where("equal")).unionByName(whole(copies)).unionByName(found).unionByName(counted_spans)
    return _gathered(spans, stage)


def _gathered(spans: DataFrame, stage: str) -> DataFrame:
    """``d, t, spans`` of rows ``d, t, lo, hi``, kept on their own; the tables in ``stage`` go."""
    out = spans.groupBy("d", "t").agg(F.sort_array(F.collect_set(F.struct("lo", "hi"))).alias("spans")).checkpoint()
    remove(spans.sparkSession, stage)
    return out


def _hash_words(text: bytes) -> np.ndarray:
    """Hashes of a text's words, ``STEP`` bytes at a time."""
    out, lo = [], 0
    while lo < len(text):
        gap = re.compile(f"[{SPACE}]".encode()).search(text, lo + STEP)
        hi = gap.start() if gap else len(text)
        out.append(word_hashes([text[lo:hi]], lower=False)[0])
        lo = hi
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def _word_parts(texts: list[bytes], words: int):
    """Stretches of about ``STEP`` bytes: (text of each, its first word, where the words of each start, their hashes)."""
    lo = 0
    while lo < len(texts):
        hi, size = lo + 1, len(texts[lo])
        if size > STEP:
            one = _hash_words(texts[lo])
            for at in range(0, len(one) - words + 1, STEP // 8):
                part = one[at:at + STEP // 8 + words - 1]
                yield np.asarray([lo]), np.asarray([at]), np.asarray([0, len(part)]), part
        else:
            while hi < len(texts) and size + len(texts[hi]) < STEP:
                size += len(texts[hi])
                hi += 1
            one, at = word_hashes(texts[lo:hi], lower=False)
            yield np.arange(lo, hi), np.zeros(hi - lo, np.int64), at, one
        lo = hi


def find_word_runs(texts: list[bytes], words: int):
    """Arrays ``text, start, starts, hash, print`` of all runs of windows of ``words`` words."""
    gram = max(1, words // 6)
    width = words - gram + 1
    out = []
    for text, offset, at, one in _word_parts(texts, words):
        if len(one) < words:
            continue
        sums = Prefix(one)
        low = window_minima(sums.windows(gram), width)
        own = np.repeat(np.arange(len(text)), np.diff(at))[:len(low)]
        inside = np.arange(len(low)) + words <= at[1:][own]
        cut = np.ones(len(low), bool)
        cut[1:] = (low[1:] != low[:-1]) | (own[1:] != own[:-1]) | (inside[1:] != inside[:-1])
        first = np.flatnonzero(cut)
        stop = np.append(first[1:], len(low))
        first, stop = first[inside[first]], stop[inside[first]]
        own = own[first]
        out.append((text[own], first - at[own] + offset[own], stop - first, low[first].astype(np.int64),
                    sums.hash(first, stop + words - 1).astype(np.int64)))
    if not out:
        return [np.empty(0, np.int64)] * 5
    return [np.concatenate(c) for c in zip(*out)]


def word_windows(text: bytes, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of 64 bits of each window of ``words`` words, the second by other hashes of the words."""
    one = _hash_words(text)
    two = mix(one ^ np.uint64(0x5A5A5A5A5A5A5A5A))
    return Prefix(one).windows(words).astype(np.int64), Prefix(two).windows(words).astype(np.int64)


def word_spans(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``d, t, spans array<struct<lo, hi>>``: windows of ``words`` words that stand in two documents or more.

    Ranges count words and may overlap.
    """
    spark = docs.sparkSession
    stage = scratch_path(spark, "words")
    keyed = _with_key(docs.select(id_col, text_col), id_col, text_col).select(
        "d", "t", F.coalesce(text_col, F.lit("")).alias("text"))

    def runs_of(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 400):
                part = b.slice(lo, 400)
                text, s, m, h, f = find_word_runs(part.column("text").cast(pa.binary()).to_pylist(), words)
                take = pa.array(text)
                yield pa.record_batch([pa.array(h), pa.array(f), *[part.column(c).take(take) for c in ("d", "t", "doc")],
                                       pa.array(s, pa.int64()), pa.array(m, pa.int64())], names=["h", "f", "d", "t", "doc", "s", "m"])

    (keyed.withColumn("doc", F.monotonically_increasing_id())
     .mapInArrow(runs_of, "h long, f long, d long, t long, doc long, s long, m long").write.parquet(f"{stage}/runs"))
    runs = spark.read.parquet(f"{stage}/runs")
    across = lambda: (F.min("doc").alias("a"), F.max("doc").alias("z"))
    counted = (runs.groupBy("h").agg(*across(), F.min("f").alias("f0"), F.max("f").alias("f1"))
               .where("a < z").select(F.col("h").alias("_h"), F.expr("f0 = f1").alias("equal")))
    runs.join(counted, F.col("h") == F.col("_h")).drop("_h").write.parquet(f"{stage}/shared")
    remove(spark, f"{stage}/runs")
    shared = spark.read.parquet(f"{stage}/shared")
    whole = lambda df: df.select("d", "t", F.col("s").alias("lo"), (F.col("s") + F.col("m") + words - 1).alias("hi"))

    # runs of one document meet the windows of all its places, those of several are repeats as a whole
    mixed = shared.where("not equal")
    (mixed.groupBy("h", "f").agg(*across(), F.min(F.struct("d", "t", "s", "m")).alias("r"))
     .write.parquet(f"{stage}/kinds"))
    kinds = spark.read.parquet(f"{stage}/kinds")
    kind = kinds.select(F.col("h").alias("_h"), F.col("f").alias("_f"), "a", "z")
    known = (F.col("h") == F.col("_h")) & (F.col("f") == F.col("_f"))
    copies = mixed.join(kind.where("a < z"), known)
    asked = (mixed.join(kind.where("a = z"), known).select("d", "t", "s", "m", "a", "z")
             .unionByName(kinds.where("a < z").select("r.*", "a", "z"))
             .groupBy("d", "t").agg(F.collect_set(F.struct("s", "m", "a", "z")).alias("xs")).checkpoint())
    texts = keyed.join(F.broadcast(asked) if _small(asked, "xs") else asked, ["d", "t"])

    def windows(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 64):
                part = b.slice(lo, 64)
                rows, held = [], 0
                for i, (text, xs) in enumerate(zip(part.column("text").cast(pa.binary()).to_pylist(), part.column("xs").to_pylist())):
                    one, two = word_windows(text, words)
                    own = np.repeat(np.arange(len(xs)), [x["m"] for x in xs])
                    at = np.concatenate([np.arange(x["s"], x["s"] + x["m"]) for x in xs])
                    a, z = (np.asarray([x[c] for x in xs])[own] for c in "az")
                    rows.append((one[at], two[at], a, z, at, np.full(len(at), i)))
                    held += len(at)
                    if held >= WINDOWS or i == part.num_rows - 1:
                        w, v, a, z, s, row = (pa.array(np.concatenate(c)) for c in zip(*rows))
                        yield pa.record_batch([w, v, a, z, part.column("d").take(row), part.column("t").take(row), s],
                                              names=["w", "v", "a", "z", "d", "t", "s"])
                        rows, held = [], 0

    every = texts.mapInArrow(windows, "w long, v long, a long, z long, d long, t long, s long")
    twice = (every.groupBy("w", "v").agg(F.min("a").alias("a0"), F.max("z").alias("z0")).where("a0 < z0")
             .select(F.col("w").alias("_w"), F.col("v").alias("_v")))
    # those of copies are known
    found = (every.where("a = z").join(twice, (F.col("w") == F.col("_w")) & (F.col("v") == F.col("_v")))
             .select("d", "t", F.col("s").alias("lo"), (F.col("s") + words).alias("hi")))
    return _gathered(whole(shared.where("equal")).unionByName(whole(copies)).unionByName(found), stage)


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
                   in_place: bool = False, words: int | None = None) -> DataFrame:
    """``docs`` with ``removed array<struct<lo, hi>>`` (maximal ranges of bytes) and ``kept binary``.

    ``in_place`` gives ``docs`` with ``text_col`` cut instead; of a character that
    lost some of its bytes the others go too, and a null text stays null.
    ``words``: so many words in a row that stand in two documents or more go too, whatever
    white space is between them; their bytes reach from the first word's start to the last word's end.
    Columns named ``removed`` or ``kept`` are replaced unless ``in_place``; others may have any name.
    """
    docs = docs if in_place else docs.drop("removed", "kept")
    schema, plain = docs.schema, docs.columns
    id_col, text_col = (f"in_{plain.index(c)}" for c in (id_col, text_col))
    docs = docs.toDF(*[f"in_{i}" for i in range(len(plain))])
    own = docs.columns
    none = F.array().cast("array<struct<lo:bigint,hi:bigint>>")
    spans = repeat_spans(docs, length, id_col, text_col).withColumn("by_word", none)
    if words:
        found = word_spans(docs, words, id_col, text_col)
        spans = spans.unionByName(found.select("d", "t", none.alias("spans"), F.col("spans").alias("by_word")))
        spans = spans.groupBy("d", "t").agg(*[F.flatten(F.collect_list(c)).alias(c) for c in ("spans", "by_word")]).checkpoint()
    small = _small(spans, F.concat("spans", "by_word"))
    spans = spans.toDF("_d", "_t", "_spans", "_by_word")
    rows = _with_key(docs, id_col, text_col)
    joined = rows.join(F.broadcast(spans) if small else spans,
                       (F.col("d") == F.col("_d")) & (F.col("t") == F.col("_t")), "left").drop("d", "t", "_d", "_t")

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                kept, removed = [], []
                for text, spans, by_word in zip(*[part.column(c).to_pylist() for c in (text_col, "_spans", "_by_word")]):
                    raw = (text or "").encode()
                    at = word_places(raw) if by_word else ()
                    cut = merge_spans([(x["lo"], x["hi"]) for x in spans or ()]
                                      + [(at[x["lo"]][0], at[x["hi"] - 1][1]) for x in by_word or ()])
                    at, parts = 0, []
                    for a, z in cut:
                        parts.append(raw[at:a])
                        at = z
                    kept.append(b"".join([*parts, raw[at:]]))
                    removed.append([{"lo": a, "hi": z} for a, z in cut])
                if in_place:
                    text = [None if t is None else k.decode("utf-8", "ignore")
                            for t, k in zip(part.column(text_col).to_pylist(), kept)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(text, pa.string()) if c == text_col else part.column(c) for c in own], names=plain)
                    continue
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in own],
                     pa.array(removed, pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))),
                     pa.array(kept, pa.binary())], names=[*plain, "removed", "kept"])

    if in_place:
        return joined.mapInArrow(run, schema)
    more = docs.select(F.lit(None).cast("array<struct<lo:bigint,hi:bigint>>").alias("removed"), F.lit(None).cast("binary").alias("kept"))
    return joined.mapInArrow(run, type(schema)(schema.fields + more.schema.fields))
