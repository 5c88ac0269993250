"""Token ids in files of Simple-8b words, and back.

A file is a row of segments; a segment holds whole documents in ascending id order:

    8 bytes   magic
    6 x u64   bytes of the segment, documents, blocks, words, ids, first nulls (documents without an id)
    i64 each  document id
    u64 each  ids of the document
    u64 each  word at which a block starts, and the end of the last
    u64 each  id at which a block starts, and the end of the last
    u64 each  words
    u32       crc32 of all that stands before

and a line end, all little-endian.  A document is cut into blocks of ``BLOCK`` ids
(its last one shorter); every block starts on a word, so any block is decoded by its own
offsets, and many at once as arrays.  The top four bits of a word select how it holds ids:

    1 to 14   as many ids as ``COUNTS`` says, of 60 // count bits each, the first lowest
    0         escape: the next word is one id of up to 64 bits as it is

The count of the last word of a block follows from the block's number of ids.

Files are written by Spark's own sink under any path that Spark can write to, so a task
that is tried again replaces its file; a small table beside them (``manifest``) has each
file's documents, ids, and the ids before it.

Defined cases: a null text or id list counts as empty; documents with a null id come first;
rows with one id come in the order of a hash of their text, equal rows in any order;
a table without rows gives no documents; other columns are not read, whatever their names;
a segment whose crc32 or lengths don't hold raises.
"""

from __future__ import annotations

import os
import zlib
from functools import lru_cache
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.llm.bpe import _share, ragged
from tessera.operators.rowindex import with_running_total
from tessera.session import scratch_path

#: Ids a word can hold, by selector; selector 0 is the escape.
COUNTS = (0, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
#: Ids of a block, bytes after which a segment ends, and segments of a file.
BLOCK, SEGMENT, PER_FILE = 4096, 1 << 20, 16
#: Entries of a worker's table of encoded words, and the longest word in it, in bytes.
TABLE, LONGEST = 600_000, 48
#: Bytes of text that are cut into words together.
PART = 4_000_000
#: Rows of the manifest that are broadcast (about 200 bytes each); a larger one is joined by a shuffle.
FILES = 200_000

_MAGIC = b"TOKEN8B\x01"
_HEAD = 6
_U64 = np.dtype("<u8")
_PAD = max(COUNTS)


# ------------------------------------------------------------------ words
def _bits(ids: np.ndarray) -> np.ndarray:
    """Bits that each id takes."""
    out = np.zeros(len(ids), np.uint8)
    rest = ids
    for step in (32, 16, 8, 4, 2, 1):
        high = rest >> np.uint64(step)
        more = high > 0
        out += more.astype(np.uint8) * np.uint8(step)
        rest = np.where(more, high, rest)
    return out + (rest > 0)


_SMALL = _bits(np.arange(1 << 16, dtype=np.uint64))


def pack(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of blocks of ``lengths`` ids, one after the other, and each block's number of words.

    Each word takes the most ids that the next ones' bits allow.
    """
    ids = np.asarray(ids, np.uint64)
    lengths = np.asarray(lengths, np.int64)
    # every block is followed by zeros, so that no word reaches into the next one
    wide = lengths + _PAD
    starts = np.cumsum(wide) - wide
    total = int(wide.sum()) if len(wide) else 0
    flat = np.zeros(total, np.uint64)
    flat[np.arange(len(ids)) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)] = ids
    bits = _SMALL[flat] if not len(ids) or ids.max() < len(_SMALL) else _bits(flat)
    # most[n][i]: the widest of the n ids from i; each from two shorter windows
    most = {1: bits}
    selector = np.zeros(total, np.uint8)
    selector[bits <= 60] = len(COUNTS) - 1
    for s in range(len(COUNTS) - 2, 0, -1):
        n = COUNTS[s]
        a = max(most)
        most[n] = bits.copy() if n == 1 else most[a].copy()
        b = max((m for m in most if m >= n - a and m <= a), default=a, key=lambda m: -m)
        np.maximum(most[n][:total - (n - b)], most[b][n - b:], out=most[n][:total - (n - b)])
        selector[most[n] <= 60 // n] = s
        for m in [m for m in most if m < n and 2 * m < n]:
            del most[m]
    # one word of every block at a time
    step = np.asarray([1, *COUNTS[1:]], np.uint8)[selector]
    first = np.zeros(total, bool)
    i, hi = starts[lengths > 0], (starts + lengths)[lengths > 0]
    while len(i):
        first[i] = True
        i = i + step[i]
        live = i < hi
        if not live.all():
            i, hi = i[live], hi[live]
    at = np.flatnonzero(first)
    words = np.diff(np.searchsorted(at, np.append(starts, total)))
    chosen = selector[at]
    # an escape takes two words
    extra = chosen == 0
    size = 1 + extra.astype(np.int64)
    place = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint64)
    for s in range(1, len(COUNTS)):
        rows = np.flatnonzero(chosen == s)
        if len(rows):
            n = COUNTS[s]
            word = np.full(len(rows), np.uint64(s) << np.uint64(60), np.uint64)
            for k in range(n):
                word |= flat[at[rows] + k] << np.uint64(k * (60 // n))
            out[place[rows]] = word
    out[place[extra] + 1] = flat[at[extra]]
    if extra.any():
        words = words + np.add.reduceat(np.append(extra, False).astype(np.int64), np.minimum(np.cumsum(words) - words, len(extra))) \
            * (words > 0)
    return out, words


def unpack(words: np.ndarray, word_counts: np.ndarray, id_counts: np.ndarray) -> np.ndarray:
    """The ids of blocks that take ``word_counts`` words and hold ``id_counts`` ids each."""
    n = len(words)
    selector = (words >> np.uint64(60)).astype(np.int64)
    # of a row of words that look like escapes every second one is raw, and so is the word after an odd row
    like = selector == 0
    if like.any():
        before = np.maximum.accumulate(np.where(like, -1, np.arange(n)))
        raw = np.zeros(n, bool)
        raw[1:] = (np.arange(n) - before)[:-1] % 2 == 1
        raw[1:] &= like[:-1]
        # a raw word with other top bits ends its row, so rows are told apart rightly
        escape = like & ~raw
    else:
        raw = escape = np.zeros(n, bool)
    held = np.asarray(COUNTS, np.int64)[np.where(raw | escape, 0, selector)] + raw
    start = np.cumsum(held) - held
    out = np.zeros(int(held.sum()), np.uint64)
    for s in range(1, len(COUNTS)):
        rows = np.flatnonzero((selector == s) & ~raw)
        if len(rows):
            k = COUNTS[s]
            mask = np.uint64((1 << 60 // k) - 1)
            for j in range(k):
                out[start[rows] + j] = (words[rows] >> np.uint64(j * (60 // k))) & mask
    out[start[raw]] = words[raw]
    upto = np.concatenate([[0], np.cumsum(held)])
    first = np.cumsum(word_counts) - word_counts
    return ragged(upto[first], np.asarray(id_counts, np.int64), out)


# ------------------------------------------------------------------ segments
def _blocks(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of each block of documents with ``counts`` ids, and each document's number of blocks."""
    n = -(-counts // BLOCK)
    out = np.full(int(n.sum()), BLOCK, np.int64)
    last = np.cumsum(n)[n > 0] - 1
    out[last] = (counts - (n - 1) * BLOCK)[n > 0]
    return out, n


def segment(doc_ids: np.ndarray, nulls: int, counts: np.ndarray, ids: np.ndarray) -> bytes:
    """One segment; its first ``nulls`` documents have no id."""
    sizes, _ = _blocks(counts)
    words, used = pack(ids, sizes)
    tables = [np.asarray(doc_ids, "<i8"), np.asarray(counts, _U64),
              np.concatenate([[0], np.cumsum(used)]).astype(_U64), np.concatenate([[0], np.cumsum(sizes)]).astype(_U64),
              words.astype(_U64)]
    body = b"".join(t.tobytes() for t in tables)
    head = np.asarray([len(_MAGIC) + 8 * _HEAD + len(body) + 4, len(counts), len(sizes), len(words), len(ids), nulls], _U64)
    whole = _MAGIC + head.tobytes() + body
    return whole + zlib.crc32(whole).to_bytes(4, "little")


def segments(raw: bytes):
    """Start, and the six numbers of the head, of each segment of a file."""
    at = 0
    while at < len(raw):
        head = np.frombuffer(raw, _U64, _HEAD, at + len(_MAGIC)).tolist() if len(raw) >= at + len(_MAGIC) + 8 * _HEAD else [0]
        if raw[at:at + len(_MAGIC)] != _MAGIC or raw[at + head[0]:at + head[0] + 1] != b"\n":
            raise ValueError(f"no segment at byte {at}")
        yield at, head
        at += head[0] + 1


def open_segment(raw: bytes, at: int, head: list[int]):
    """Document ids, first nulls, ids of each document, and all ids of one segment."""
    size, n_docs, n_blocks, n_words, n_ids, nulls = head
    if zlib.crc32(memoryview(raw)[at:at + size - 4]) != int.from_bytes(raw[at + size - 4:at + size], "little"):
        raise ValueError(f"crc32 of the segment at byte {at}")
    lo, out = at + len(_MAGIC) + 8 * _HEAD, []
    for n, kind in ((n_docs, "<i8"), (n_docs, _U64), (n_blocks + 1, _U64), (n_blocks + 1, _U64), (n_words, _U64)):
        out.append(np.frombuffer(raw, kind, n, lo))
        lo += 8 * n
    doc_ids, counts, word_at, id_at, words = out
    ids = unpack(words, np.diff(word_at.astype(np.int64)), np.diff(id_at.astype(np.int64)))
    return doc_ids, nulls, counts.astype(np.int64), ids


# ------------------------------------------------------------------ tokenizer
class Words:
    """A tokenizer of the public library and a bounded table of what words encode to.

    The tokenizer drops white space and no merge crosses it, so a text's ids are those of its
    words; unseen words of letters go to the library together, others one by one.
    A table that is full becomes the older one, from which
    words are still taken.
    """

    #: ASCII signs that the pattern always parts from a letter or digit before them, at a word's end.
    ENDS = frozenset(b".,;:!?")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.table: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        vocab = self.library.get_vocab(with_added_tokens=True)
        self.ends_piece = np.zeros(max(vocab.values()) + 1, bool)
        self.ends_piece[[i for token, i in vocab.items() if token.endswith("</w>")]] = True

    def _ask(self, words: list[bytes]) -> list[bytes]:
        """Ids of words as little-endian 32-bit integers."""
        texts = [w.decode() for w in words]
        out: list = [None] * len(words)
        # a word of letters is one piece, and a piece's last token says so
        plain = [i for i, t in enumerate(texts) if t.isalpha()]
        groups = [plain[lo:lo + 256] for lo in range(0, len(plain), 256)]
        joined = [" ".join([texts[i] for i in g]) for g in groups]
        for group, got in zip(groups, self.library.encode_batch_fast(joined, add_special_tokens=False)):
            ids = np.asarray(got.ids, "<u4")
            stops = (4 * (np.flatnonzero(self.ends_piece[ids]) + 1)).tolist()
            if len(stops) == len(group):
                raw, lo = ids.tobytes(), 0
                for i, hi in zip(group, stops):
                    out[i], lo = raw[lo:hi], hi
        rest = [i for i, x in enumerate(out) if x is None]
        for i, got in zip(rest, self.library.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False)):
            out[i] = np.asarray(got.ids, "<u4").tobytes()
        return out

    def _learn(self, new: list[bytes]) -> list[bytes]:
        """Adds unseen words to the table; those too long to stay there."""
        table, older = self.table, self.older
        cores, ends = [], []
        for w in new:
            v = w if b"<|" in w else w.lower()  # the library tells its special tokens by case
            if v[-1] in self.ENDS and v[-2:-1].isalnum():
                cores.append(v[:-1])
                ends.append(v[-1:])
            else:
                cores.append(v)
                ends.append(b"")
        want = ({*cores, *ends} - {b""}).difference(table)
        kept = [w for w in want if w in older]
        table.update(zip(kept, map(older.__getitem__, kept)))
        ask = list(want.difference(kept))
        table.update(zip(ask, self._ask(ask)))
        get = table.__getitem__
        table[b""] = b""  # no end, and no word between two signs of white space
        table.update(zip(new, map(add, map(get, cores), map(get, ends))))
        return [w for w in {*new, *ask} if len(w) > LONGEST]

    def encode_many(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and each text's number of ids; a null text has none."""
        lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
        coded = lists.flatten().dictionary_encode()
        words, which = _values(coded.dictionary), coded.indices.to_numpy()
        if len(self.table) + len(words) > TABLE:
            self.table, self.older = {}, self.table
        table, older = self.table, self.older
        new = [w for w in words if w and w not in table]
        kept = [w for w in new if w in older]
        table.update(zip(kept, map(older.__getitem__, kept)))
        long = self._learn([w for w in new if w not in table])
        ids = list(map(table.__getitem__, words))
        for w in long:
            del table[w]
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), "<u4")
        per_word = size[which]
        upto = np.concatenate([[0], np.cumsum(per_word)])
        ends = upto[np.cumsum(pc.list_value_length(lists).to_numpy())]
        return ragged((np.cumsum(size) - size)[which], per_word, flat), np.diff(ends, prepend=0)


def _values(texts: pa.LargeStringArray) -> list[bytes]:
    """The bytes of each text, none of them null."""
    _, offsets, raw = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1].tolist()
    raw = raw.to_pybytes() if raw else b""
    return [raw[a:b] for a, b in zip(ends, ends[1:])]


@lru_cache(maxsize=1)
def _words(name: str) -> Words:
    return Words(SparkFiles.get(name))


def _parts(batches):
    """Stretches of the batches of about ``PART`` bytes of text."""
    for b in batches:
        ends = np.cumsum(pc.binary_length(b.column("text")).fill_null(0).to_numpy().astype(np.int64) + 64)
        lo = 0
        while lo < b.num_rows:
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + PART, "right")))
            yield b.slice(lo, hi - lo)
            lo = hi


# ------------------------------------------------------------------ tables
def in_order(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id``, ``text`` in ascending id order over range partitions; rows with one id are split as well."""
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.monotonically_increasing_id()]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named = rows.select("*", *[k.alias(c) for k, c in zip(keys[1:], ("_hash", "_row"))])
    order = [keys[0], F.col("_hash"), F.col("_row")]
    return named.repartitionByRange(n, *order).sortWithinPartitions(*order).select("doc_id", "text")


def write_texts(df: DataFrame, path: str, tokenizer: str, end_id: int | None = None,
                id_col: str = "doc_id", text_col: str = "text") -> None:
    """Ids of every whole text by the tokenizer file, ``end_id`` after each document, as files under ``path``."""
    name = _share(df, tokenizer)
    tail = np.asarray([] if end_id is None else [end_id], np.uint64)

    def batches_of(batches):
        words = _words(name)
        for part in _parts(batches):
            ids, counts = words.encode_many(part.column("text"))
            if len(tail):
                whole = np.full(len(ids) + len(counts), tail[0], np.uint64)
                whole[np.arange(len(ids)) + np.repeat(np.arange(len(counts)), counts)] = ids
                ids, counts = whole, counts + 1
            yield part.column("doc_id"), counts, ids.astype(np.uint64)

    _write(in_order(df, id_col, text_col), path, batches_of)


def write_ids(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> None:
    """Id lists (``array<int>`` or ``array<long>``, none negative or null) as files under ``path``."""
    def batches_of(batches):
        for b in batches:
            lists = b.column("text")
            counts = np.asarray(lists.value_lengths().fill_null(0), np.int64)
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            if len(ids) and ids.min() < 0:
                raise ValueError("negative token id")
            yield b.column("doc_id"), counts, ids.astype(np.uint64)

    _write(in_order(df, id_col, ids_col), path, batches_of)


def _write(ordered: DataFrame, path: str, batches_of) -> None:
    def run(batches):
        held, size = [], 0

        def close():
            docs = pa.concat_arrays([h[0] for h in held])
            whole = segment(docs.fill_null(0).to_numpy(zero_copy_only=False), docs.null_count,
                            np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held]))
            return pa.record_batch([pa.array([whole], pa.binary())], names=["segment"])

        for docs, counts, ids in batches_of(batches):
            ends = np.cumsum(counts)
            lo = 0
            while lo < len(counts):  # documents until the segment is full; two bytes an id, 16 a document
                base = int(ends[lo] - counts[lo])
                cost = 2 * (ends[lo:] - base) + 16 * np.arange(1, len(ends) - lo + 1)
                hi = lo + min(int(np.searchsorted(cost, SEGMENT - size)) + 1, len(counts) - lo)
                held.append((docs.slice(lo, hi - lo), counts[lo:hi], ids[base:int(ends[hi - 1])]))
                size += int(cost[hi - lo - 1])
                if size >= SEGMENT:
                    yield close()
                    held, size = [], 0
                lo = hi
        if held:
            yield close()

    (ordered.mapInArrow(run, "segment binary").select(F.col("segment").cast("string").alias("value"))
     .write.option("maxRecordsPerFile", PER_FILE).option("compression", "none").text(f"{path}/data"))

    def heads(batches):
        for b in batches:
            rows = []
            for name, raw in zip(b.column(0).to_pylist(), b.column(1)):
                found = [h for _, h in segments(raw.as_buffer().to_pybytes())]
                rows.append((name, sum(h[1] for h in found), sum(h[4] for h in found)))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64()))],
                                  names=["path", "n_docs", "n_ids"])

    spark = ordered.sparkSession
    name = F.regexp_extract("path", r"[^/]+$", 0)
    number = lambda pattern: F.regexp_extract("file", pattern, 1).cast("long")
    files = (_files(spark, path).mapInArrow(heads, "path string, n_docs long, n_ids long")
             .select(name.alias("file"), "n_docs", "n_ids")
             .select("*", number(r"^part-(\d+)").alias("part"), number(r"-c(\d+)[.]\w+$").alias("roll")))
    (with_running_total(files, ["part", "roll"], "n_ids").select("file", "n_docs", "n_ids", "start")
     .write.parquet(f"{path}/manifest"))


def _files(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/data")
            .select("path", "content"))


def read_ids(spark: SparkSession, path: str, raw: bool = False) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, and ``ids array<long>``.

    With ``raw`` the ids come as ``binary``: unsigned 32-bit integers, little-endian.
    """
    manifest = spark.read.parquet(f"{path}/manifest").select("file", "start")
    if manifest.count() <= FILES:
        manifest = F.broadcast(manifest)
    files = (_files(spark, path).withColumn("file", F.regexp_extract("path", r"[^/]+$", 0))
             .join(manifest, "file").select("start", "content"))
    kind = pa.binary() if raw else pa.list_(pa.int64())

    def run(batches):
        for b in batches:
            for base, content in zip(b.column(0).to_pylist(), b.column(1)):
                whole = content.as_buffer().to_pybytes()
                for at, head in segments(whole):
                    docs, nulls, counts, ids = open_segment(whole, at, head)
                    ends = np.cumsum(counts)
                    offsets = np.concatenate([[0], ends]).astype(np.int32)
                    if raw:
                        if len(ids) and int(ids.max()) >> 32:
                            raise ValueError("token id of more than 32 bits")
                        data = pa.BinaryArray.from_buffers(kind, len(docs), [
                            None, pa.py_buffer((offsets * 4).tobytes()), pa.py_buffer(ids.astype("<u4").tobytes())])
                    else:
                        data = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int64)))
                    yield pa.record_batch([
                        pa.array(docs.astype(np.int64), mask=np.arange(len(docs)) < nulls),
                        pa.array(base + ends - counts), pa.array(counts), data], names=["doc_id", "start", "n_tokens", "ids"])
                    base += int(ends[-1]) if len(ends) else 0

    return files.mapInArrow(run, f"doc_id long, start long, n_tokens long, ids {'binary' if raw else 'array<long>'}")


def round_trip(df: DataFrame, tokenizer: str, end_id: int | None = None, path: str | None = None) -> DataFrame:
    """Writes the ids of ``df`` (``doc_id``, ``text``) and reads them back, as 32-bit integers."""
    spark = df.sparkSession
    path = path or scratch_path(spark, "ids")
    write_texts(df, path, tokenizer, end_id)
    return read_ids(spark, path, raw=True)
