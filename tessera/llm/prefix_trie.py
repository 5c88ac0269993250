"""Trie of conversation prefixes, built as a z-fast trie in batches.

A conversation is a string whose signs are its turns; the prefix of d turns has a 128-bit
key, chained from the key of d - 1 turns and the hash of the turn.  Branches and ends are the trie's
explicit nodes.  The edge from depth p down to an explicit node at depth e is found by its
*handle*: the key at the depth of (p, e] that the highest power of two divides.

A batch does three things, each as joins on keys over all strings that are not in yet:

* locate: a fat binary search over the depths a string has looks up one handle a step, so a
  string of n turns finds its deepest explicit node in about log2(n) joins; the edge that
  leaves this node with the string's next turn gives the exact depth at which it exits;
* elect: of the strings that exit at one place with the same next turn, one (by hash) is
  inserted as a new path from there; a string that ends at its exit is only marked;
* split: explicit nodes are added where paths begin or strings end, and the handles of the
  new edges follow.

The others try again in the next batch, below the path that was just inserted; about half of a
group's strings share more with it each time, so the number of batches grows with the logarithm
of the strings.  Finally the paths are folded from the last batch to the first: each gets the
totals of the paths that begin on it, sums them from its end upwards, and its edges expand
to one node per depth.

Skew: equal conversations become one string before the trie is built, and their ids are
hashed in slices of at most ``SLICE`` ids that pass by in order, never held together; events at one
place are summed before they meet; the few places with very many children reach them by broadcast.

Bounds: a conversation is one row of 24 bytes a turn (texts are hashed before any shuffle),
so its length is bounded by a row's size, not by a cap.

Defined cases: turns are ordered by ``turn`` (null first), then role, then the turn's hash; a
null role or text counts as empty; repeated rows are turns like any others; rows
without ``conv_id`` belong to no conversation and take no part; a table without conversations
has no node; other columns are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.session import checkpoint_dir, scratch_path

#: Key of the empty prefix; also the root path's name.
ROOT = bytes(16)
#: Conversation ids that are hashed together lie in one range of so many numbers (2 ** 12).
SLICE = 12
#: Children of a place that holds more than one in so many of all paths get their parent by broadcast.
HOT = 4096


# ------------------------------------------------------------------ strings
def sequences(df: DataFrame) -> DataFrame:
    """``conv_id``, ``turns array<struct<h: binary, size: int>>`` in order, from one row per turn."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    sign = F.sha2(F.encode(F.concat(F.octet_length(text("role")).cast("string"), F.lit(":"), text("role"), text("text")), "UTF-8"), 256)
    turn = F.struct(F.col("turn").isNotNull().alias("has"), "turn", text("role").alias("role"), sign.alias("h"),
                    F.octet_length(text("text")).alias("size"))
    rows = df.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    return rows.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list("t")), lambda t: F.struct(
        F.unhex(F.substring(t["h"], 1, 32)).alias("h"), t["size"].alias("size"))).alias("turns"))


def rebuild(seqs: DataFrame, group: int = 5, spread: int = 9) -> DataFrame:
    """Every conversation's first turns replaced by those of its group's first id.

    Conversation c keeps its own turns after the first h = crc32(c) % ``spread``; before them come the
    first h turns of conversation c - c % ``group`` (all if fewer, none if absent).
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % spread).cast("int")
    heads = seqs.select(F.col("conv_id").alias("base"), F.slice("turns", 1, spread - 1).alias("head"))
    own = seqs.select("conv_id", "turns", (F.col("conv_id") - F.col("conv_id") % group).alias("base"), h.alias("h"))
    none = F.slice("turns", 1, 0)
    return own.join(heads, "base", "left").select("conv_id", F.concat(
        F.slice(F.coalesce("head", none), F.lit(1), F.col("h")), F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))


def _keyed(seqs: DataFrame) -> DataFrame:
    """``conv_id``, ``id`` (key of the whole string), ``len``, ``keys`` (all keys in a row) and ``sizes``."""
    def run(batches):
        for b in batches:
            ids, keys = [], []
            for turns in b.column("h").to_pylist():
                key, out = ROOT, []
                for h in turns:
                    key = hashlib.sha256(key + h).digest()[:16]
                    out.append(key)
                ids.append(key)
                keys.append(b"".join(out))
            yield pa.record_batch([b.column("conv_id"), pa.array(ids, pa.binary()), pa.array([len(k) // 16 for k in keys], pa.int32()),
                                   pa.array(keys, pa.binary()), b.column("sizes")], names=["conv_id", "id", "len", "keys", "sizes"])

    return seqs.select("conv_id", F.col("turns.h").alias("h"), F.col("turns.size").alias("sizes")).mapInArrow(
        run, "conv_id long, id binary, len int, keys binary, sizes array<int>")


def _members(keyed: DataFrame) -> DataFrame:
    """``id``, ``n``, ``conv`` (smallest) and ``ends`` (sha256 of the ids in order) of each distinct string."""
    slices = (keyed.groupBy("id", F.shiftright("conv_id", SLICE).alias("slice"))
              .agg(F.array_sort(F.collect_list("conv_id")).alias("c"))
              .select("id", "slice", F.size("c").cast("long").alias("n"), F.element_at("c", 1).alias("conv"),
                      F.array_join(F.col("c").cast("array<string>"), ",").alias("c")))

    def run(batches):
        at = None

        def row():
            key, n, conv, sha = at
            return pa.record_batch([pa.array([key], pa.binary()), pa.array([n], pa.int64()), pa.array([conv], pa.int64()),
                                    pa.array([sha.hexdigest()])], names=["id", "n", "conv", "ends"])

        out = []
        for b in batches:
            for key, n, conv, c in zip(*(b.column(i).to_pylist() for i in (0, 2, 3, 4))):
                if at is None or at[0] != key:
                    if at is not None:
                        out.append(row())
                        if len(out) == 1000:
                            yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
                            out = []
                    at = [key, n, conv, hashlib.sha256(c.encode())]
                else:
                    at[1] += n
                    at[3].update(b"," + c.encode())
        if at is not None:
            out.append(row())
            yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]

    return (slices.repartition("id").sortWithinPartitions("id", "slice")
            .mapInArrow(run, "id binary, n long, conv long, ends string"))


# ------------------------------------------------------------------ z-fast search
def fattest(a, b):
    """The number in (a, b] that the highest power of two divides; a < b."""
    low = F.length(F.bin(a.bitwiseXOR(b))) - 1
    return F.call_function("shiftleft", F.call_function("shiftright", b, low), low)


def _key(keys, depth):
    return F.substring(keys, (depth - 1) * 16 + 1, F.lit(16))


def _edges(paths: DataFrame, stops: DataFrame) -> DataFrame:
    """One row per edge: ``path``, depths ``p`` and ``e``, ``handle``, ``extent`` and ``first`` key, and all keys on it."""
    own = stops.groupBy(F.col("path").alias("id")).agg(F.collect_set("x").alias("stops"))
    cuts = F.array_sort(F.array_distinct(F.concat(F.array("x0"), F.coalesce("stops", F.array().cast("array<int>")), F.array("len"))))
    cut = (paths.where(F.col("id") != F.lit(ROOT)).join(own, "id", "left").select("id", "keys", cuts.alias("cuts"))
           .select("id", "keys", F.explode(F.arrays_zip(
               F.slice("cuts", F.lit(1), F.size("cuts") - 1).alias("p"), F.slice("cuts", F.lit(2), F.size("cuts")).alias("e"))).alias("c")))
    p, e = F.col("c.p"), F.col("c.e")
    return cut.select(F.col("id").alias("path"), p.alias("p"), e.alias("e"), _key(F.col("keys"), fattest(p, e)).alias("handle"),
                      _key(F.col("keys"), e).alias("extent"), _key(F.col("keys"), p + 1).alias("first"),
                      F.substring(F.col("keys"), p * 16 + 1, (e - p) * 16).alias("edge"))


def locate(pending: DataFrame, edges: DataFrame, steps: int) -> DataFrame:
    """``pending`` (``id``, ``len``, ``keys``) with its exit: ``path`` and depth ``x``, and ``next``, the key below it (null at its end)."""
    keys, a, b, n = F.col("keys"), F.col("a"), F.col("b"), F.col("len")
    handles = edges.select("handle", F.col("path").alias("hp"), F.col("p").alias("h0"), F.col("e").alias("h1"), "extent")
    state = pending.select("id", "len", "keys", F.lit(0).alias("a"), n.alias("b"), F.lit(ROOT).alias("q"))
    for _ in range(steps):
        probe = state.withColumn("f", F.when(a < b, fattest(a, b)))
        probe = probe.withColumn("k", F.when(a < b, _key(keys, F.col("f"))))
        found = probe.join(handles, probe["k"] == handles["handle"], "left")
        hit = F.col("hp").isNotNull()
        whole = hit & (F.col("h1") <= n) & (_key(keys, F.col("h1")) == F.col("extent"))
        state = found.select(
            "id", "len", "keys",
            F.when(whole, F.col("h1")).when(hit, F.col("h0")).otherwise(a).alias("a"),
            F.when(whole, F.greatest(b, F.col("h1"))).when(hit, F.col("h0")).when(a < b, F.col("f") - 1).otherwise(b).alias("b"),
            F.when(whole, F.col("hp")).otherwise(F.col("q")).alias("q"))
    exits = edges.select("first", F.col("path").alias("ep"), F.col("e").alias("e1"), "edge")
    state = state.withColumn("k", F.when(a < n, _key(keys, a + 1)))
    last = state.join(exits, state["k"] == exits["first"], "left")
    same = lambda i: F.substring(F.col("edge"), (i - 1) * 16 + 1, F.lit(16)) == _key(keys, a + i)
    shared = F.size(F.filter(F.sequence(F.lit(1), F.least(F.col("e1"), n) - a), same))
    inside = F.col("ep").isNotNull()
    x = F.when(inside, a + shared).otherwise(a)
    return (last.select("id", "len", "keys", F.when(inside, F.col("ep")).otherwise(F.col("q")).alias("path"), x.alias("x"))
            .withColumn("next", F.when(F.col("x") < n, _key(keys, F.col("x") + 1))))


def _staged(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    at = scratch_path(spark, name)
    df.write.parquet(at)
    return spark.read.parquet(at)


def insert(strings: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Inserts ``strings`` (``id``, ``len``, ``keys``) in batches.

    Paths (``id``, ``parent``, ``x0``, ``len``, ``keys``, ``batch``), marks of the strings that end
    on another one's path (``id``, ``path``, ``x``), and the number of batches.
    """
    spark = strings.sparkSession
    longest = strings.agg(F.max("len")).first()[0] or 0
    steps = longest.bit_length() + 1
    schema = "id binary, parent binary, x0 int, len int, keys binary, batch int"
    paths = spark.createDataFrame([(ROOT, None, -1, 0, b"", 0)], schema)
    marks = spark.createDataFrame([], "id binary, path binary, x int")
    pending = strings.where(F.col("len") > 0).select("id", "len", "keys")
    batch = 0
    while not pending.isEmpty():
        batch += 1
        if batch == 1:
            found = pending.select("id", "len", "keys", F.lit(ROOT).alias("path"), F.lit(0).alias("x"), _key(F.col("keys"), F.lit(1)).alias("next"))
        else:
            stops = paths.select(F.col("parent").alias("path"), F.col("x0").alias("x")).unionByName(marks.select("path", "x"))
            edges = _staged(_edges(paths, stops), "edges")
            found = locate(pending, edges, steps)
        found = _staged(found.withColumn("hash", F.xxhash64("id")), "exits")
        marks = marks.unionByName(found.where(F.col("next").isNull()).select("id", "path", "x"))
        going = found.where(F.col("next").isNotNull())
        least = going.groupBy("next").agg(F.min("hash").alias("hash"))
        # strings of one hash are told apart by their keys
        elected = _staged(going.join(least, ["next", "hash"]).groupBy("next").agg(F.min("id").alias("id")), "elected")
        new = going.join(elected.select("id"), "id").select("id", F.col("path").alias("parent"), F.col("x").alias("x0"), "len", "keys",
                                                            F.lit(batch).alias("batch"))
        paths = paths.unionByName(_staged(new, "paths"))
        pending = _staged(going.join(elected.select("id"), "id", "left_anti").select("id", "len", "keys"), "pending")
    return paths, marks, batch


# ------------------------------------------------------------------ fold
_NODE = "array<struct<conv: bigint, n: bigint, kids: bigint, leaves: bigint, saved: bigint, ends: string>>"
_EMPTY = hashlib.sha256(b"").hexdigest()


def _fold(paths: DataFrame) -> DataFrame:
    """Nodes of each path from its depth ``x0`` + 1 down, with what is below them summed.

    ``paths`` has ``id``, ``parent``, ``x0``, ``sizes``, the string's own ``n``, ``conv`` and ``ends``, and ``events``.
    """
    kind = pa.list_(pa.struct([("conv", pa.int64()), ("n", pa.int64()), ("kids", pa.int64()), ("leaves", pa.int64()),
                               ("saved", pa.int64()), ("ends", pa.string())]))

    def run(batches):
        for b in batches:
            out = []
            cols = [b.column(c).to_pylist() for c in ("x0", "sizes", "n", "conv", "ends", "events")]
            for x0, sizes, own, conv, ends, events in zip(*cols):
                at = {e["x"]: e for e in events or ()}
                nodes = []
                low, n, leaves, saved = conv, own or 0, 0, 0
                mark = ends or _EMPTY
                depth = x0 + len(sizes)
                for d in range(depth, x0, -1):
                    kids = int(d < depth)
                    if d < depth:
                        mark = _EMPTY
                    e = at.get(d)
                    if e is not None:
                        n, kids, leaves, saved = n + e["n"], kids + e["kids"], leaves + e["leaves"], saved + e["saved"]
                        low = e["conv"] if low is None else min(low, e["conv"])
                        mark = e["ends"] or mark
                    if not kids:
                        leaves += 1
                    saved += (n - 1) * sizes[d - x0 - 1]
                    nodes.append((low, n, kids, leaves, saved, mark))
                nodes.reverse()
                out.append([dict(zip(("conv", "n", "kids", "leaves", "saved", "ends"), v)) for v in nodes])
            yield pa.record_batch([b.column("id"), b.column("parent"), b.column("x0"), pa.array(out, kind)],
                                  names=["id", "parent", "x0", "nodes"])

    return paths.mapInArrow(run, f"id binary, parent binary, x0 int, nodes {_NODE}")


def _events(marked: DataFrame, folded: DataFrame | None) -> DataFrame:
    """Per path one list of what joins it at a depth: strings that end there, and paths that begin there."""
    rows = marked
    if folded is not None:
        top = F.col("nodes")[0]
        rows = rows.unionByName(folded.select(
            F.col("parent").alias("id"), F.col("x0").alias("x"), top["n"].alias("n"), top["conv"].alias("conv"), F.lit(1).cast("long").alias("kids"),
            top["leaves"].alias("leaves"), top["saved"].alias("saved"), F.lit(None).cast("string").alias("ends")))
    total = lambda c: F.sum(c).alias(c)
    return (rows.groupBy("id", "x").agg(total("n"), F.min("conv").alias("conv"), total("kids"), total("leaves"), total("saved"),
                                        F.max("ends").alias("ends"))
            .groupBy("id").agg(F.collect_list(F.struct("x", "n", "conv", "kids", "leaves", "saved", "ends")).alias("events")))


def trie(seqs: DataFrame) -> DataFrame:
    """One row per distinct prefix of the ``turns`` of ``seqs`` (``conv_id``, ``turns``; one row each).

    Columns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``.
    """
    checkpoint_dir(seqs.sparkSession)
    keyed = _staged(_keyed(seqs), "keyed")
    members = _staged(_members(keyed), "members")
    strings = _staged(members.join(keyed.drop("id"), F.col("conv") == F.col("conv_id")).drop("conv_id"), "strings")
    if strings.isEmpty():
        return seqs.sparkSession.createDataFrame([], _SCHEMA)
    paths, marks, batches = insert(strings)

    zero = F.lit(0).cast("long")
    marked = _staged(marks.join(strings.select("id", "n", "conv", "ends"), "id").select(
        F.col("path").alias("id"), "x", "n", "conv", zero.alias("kids"), zero.alias("leaves"), zero.alias("saved"), "ends"), "marks")
    own = strings.select("id", "n", "conv", "ends", "sizes")
    done, folded = [], None
    for batch in range(batches, -1, -1):
        mine = paths.where(F.col("batch") == batch).select("id", "parent", "x0").join(own, "id", "left")
        sizes = F.when(F.col("x0") < 0, F.array(F.lit(0))).otherwise(F.slice("sizes", F.greatest("x0", F.lit(0)) + 1, F.greatest(F.size("sizes"), F.lit(0))))
        mine = mine.withColumn("sizes", sizes).join(_events(marked, folded), "id", "left")
        folded_now = _staged(_fold(mine), "folded")
        done.append(folded_now)
        folded = folded_now if folded is None else folded.unionByName(folded_now)

    count = folded.count()
    nodes = folded.select("id", "parent", "x0", F.posexplode("nodes").alias("i", "v"), "nodes").select(
        "id", "parent", "x0", "i", (F.col("x0") + 1 + F.col("i")).alias("depth"), "v",
        F.when(F.col("i") > 0, F.get(F.col("nodes"), F.col("i") - 1)["conv"]).alias("up"))
    above = nodes.where(F.col("v.kids") > 0).select(F.col("id").alias("parent"), F.col("depth").alias("x0"), F.col("v.conv").alias("top"), F.col("v.kids").alias("k"))
    wide = F.broadcast(above.where(F.col("k") * HOT > count).drop("k"))
    slim = above.where(F.col("k") * HOT <= count).drop("k")
    first = nodes.where((F.col("i") == 0) & (F.col("x0") >= 0))
    rest = nodes.where((F.col("i") > 0) | (F.col("x0") < 0)).withColumn("top", F.col("up"))
    tops = first.join(wide, ["parent", "x0"]).unionByName(
        first.join(wide.select("parent", "x0"), ["parent", "x0"], "left_anti").join(slim, ["parent", "x0"]))
    return rest.unionByName(tops).select(
        F.col("v.conv").alias("conv_id"), F.col("depth").cast("long").alias("depth"), F.col("top").alias("parent_conv_id"),
        F.col("v.n").alias("n_convs"), F.col("v.kids").alias("n_children"), F.col("v.leaves").alias("n_leaves"),
        F.col("v.saved").alias("saved_tokens"), F.col("v.ends").alias("ends_sha256"))


_SCHEMA = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
           "ends_sha256 string")

#: crc32 of a short text as SQL: bit by bit, with the usual polynomial reversed.
_CRC = """xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(conv_id::VARCHAR, ''),
    lambda c: ord(c)::UBIGINT)), lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), list_transform(range(8), lambda i: 0::UBIGINT)),
    lambda v, i: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END))))"""

ORACLE_SQL = f"""
WITH t AS (
    SELECT conv_id, strlen(coalesce(text, '')) AS size, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS s,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
            sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS p
    FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 5 AS base, {_CRC} % 9 AS h FROM (SELECT DISTINCT conv_id FROM t)),
m AS (SELECT c.conv_id, base, h, (SELECT count(*) FROM t WHERE t.conv_id = c.base AND t.p <= c.h) AS got FROM c),
q AS (
    SELECT m.conv_id, t.p AS d, t.s, t.size FROM m JOIN t ON t.conv_id = m.base AND t.p <= m.h
    UNION ALL SELECT m.conv_id, m.got + t.p - m.h, t.s, t.size FROM m JOIN t ON t.conv_id = m.conv_id AND t.p > m.h),
k AS (
    SELECT conv_id, d, size, string_agg(s, '') OVER (PARTITION BY conv_id ORDER BY d) AS key,
        coalesce(string_agg(s, '') OVER (PARTITION BY conv_id ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS up FROM q
    UNION ALL SELECT conv_id, 0, 0, '', NULL FROM c),
e AS (SELECT key, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends
    FROM (SELECT conv_id, arg_max(key, d) AS key FROM k GROUP BY conv_id) GROUP BY key),
n AS (SELECT key, min(d) AS d, min(up) AS up, min(size) AS size, min(conv_id) AS conv_id, count(*) AS n FROM k GROUP BY key),
kids AS (SELECT up, count(*) AS kids FROM n WHERE up IS NOT NULL GROUP BY up),
v AS (SELECT n.*, coalesce(kids, 0) AS kids, coalesce(ends, sha256('')) AS ends FROM n LEFT JOIN kids ON kids.up = n.key LEFT JOIN e ON e.key = n.key),
below AS (SELECT k.key, sum((v.n - 1) * v.size) AS saved, sum(CASE WHEN v.kids = 0 THEN 1 ELSE 0 END) AS leaves
    FROM v JOIN k ON k.conv_id = v.conv_id AND k.d <= v.d GROUP BY k.key)
SELECT v.conv_id::BIGINT AS conv_id, v.d::BIGINT AS depth, u.conv_id::BIGINT AS parent_conv_id, v.n::BIGINT AS n_convs,
    v.kids::BIGINT AS n_children, below.leaves::BIGINT AS n_leaves, below.saved::BIGINT AS saved_tokens, v.ends AS ends_sha256
FROM v JOIN below USING (key) LEFT JOIN n u ON u.key = v.up
"""
