"""WordPiece segmentation, encoding and training-table preparation:
W6, W7, M1-M5."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.keyed import hash_key
from tessera.operators import corpus
from tessera.operators.rowindex import with_row_index
from tessera.operators.split import hash_rank
from tessera.operators.vocab import CONTINUATION_PREFIX, word_array
from tessera.session import checkpoint_dir

# Fixed values of the WordPiece model and the collator.
MAX_INPUT_CHARS_PER_WORD = 100
IGNORE_LABEL = -100
MASK_SHARE, RANDOM_SHARE = 0.8, 0.1      # of the chosen positions; the rest unchanged
# A vocabulary of up to this many bytes is broadcast to the substring join.
BROADCAST_VOCAB_BYTES = 256 << 20
# A word with more than this share of all tokens is hot; at most 1 / share exist.
HOT_WORDS = 10_000


def _vocab_facts(vocab: DataFrame, *pieces: str) -> tuple[DataFrame, int, list[int]]:
    """The vocabulary as a join side, its longest piece and the ids of ``pieces``,
    from one aggregate."""
    plen = F.when(F.col("piece").startswith(CONTINUATION_PREFIX),
                  F.length("piece") - len(CONTINUATION_PREFIX)).otherwise(F.length("piece"))
    row = vocab.agg(F.max(plen), F.sum(F.octet_length("piece") + 16),
                    *[F.max(F.when(F.col("piece") == p, F.col("token_id"))) for p in pieces]).first()
    for piece, token_id in zip(pieces, row[2:]):
        if token_id is None:
            raise ValueError(f"vocabulary lacks {piece}")
    side = vocab.select("token_id", "piece")
    return (F.broadcast(side) if row[1] <= BROADCAST_VOCAB_BYTES else side,
            row[0] or 1, [int(i) for i in row[2:]])


# ------------------------------------------------------------------ W6
def wordpiece_segment(words: DataFrame, vocab: DataFrame, word_col: str = "word",
                      unk_token: str = "[UNK]",
                      max_chars: int = MAX_INPUT_CHARS_PER_WORD) -> DataFrame:
    """Greedy longest-match-first segmentation of distinct words.

    Every (start, length) substring up to the longest piece is looked up in
    the vocabulary with one join (``##`` before non-initial substrings); the
    longest hit per start becomes a map, and ``aggregate`` walks it from the
    left.  A word gets ``[UNK]`` when the walk is stuck or it has more than
    ``max_chars`` characters.  Output ``(word, ids array<int>)``.
    """
    return _segment(words.select(F.col(word_col).alias("word")).distinct(),
                    _vocab_facts(vocab, unk_token), max_chars)


def _segment(words: DataFrame, facts: tuple, max_chars: int = MAX_INPUT_CHARS_PER_WORD) -> DataFrame:
    """Segments of words that are distinct already; ``facts`` of the vocabulary
    end with the id of the unknown token."""
    side, longest, (*_, unk) = facts
    w = words.select("word", F.length("word").alias("_L"))
    # one linear pipeline: words too long or without any hit survive the
    # outer explode / left join with null starts and end as [UNK]
    starts = F.when(F.col("_L") <= max_chars, F.sequence(F.lit(0), F.col("_L") - 1)) \
              .otherwise(F.array().cast("array<int>"))
    cands = w.select("word", "_L", F.explode_outer(starts).alias("s"))
    cands = cands.select("word", "_L", "s", F.explode_outer(F.when(
        F.col("s").isNotNull(),
        F.sequence(F.lit(1), F.least(F.lit(longest), F.col("_L") - F.col("s"))))).alias("l"))
    sub = F.substring(F.col("word"), F.col("s") + 1, F.col("l"))
    cands = cands.withColumn("piece", F.when(F.col("s") == 0, sub)
                             .otherwise(F.concat(F.lit(CONTINUATION_PREFIX), sub)))
    hits = cands.join(side, "piece", "left")
    # longest hit per start: (length, id) packed in one long, so the
    # aggregation is hash-based rather than sort-based
    packed = F.when(F.col("token_id").isNotNull(),
                    F.shiftleft(F.col("l").cast("long"), 32) + F.col("token_id").cast("long"))
    best = hits.groupBy("word", "_L", "s").agg(F.max(packed).alias("_b"))
    best = best.withColumn("b", F.when(F.col("_b").isNotNull(), F.struct(
        F.shiftright("_b", 32).cast("int").alias("l"),
        F.col("_b").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("token_id"))))
    per_word = best.groupBy("word", "_L").agg(F.map_from_entries(F.collect_list(
        F.when(F.col("b").isNotNull(), F.struct("s", "b")))).alias("m"))
    init = F.struct(F.lit(0).alias("pos"), F.lit(True).alias("ok"),
                    F.array().cast("array<int>").alias("ids"))

    def step(acc, i):
        m = F.element_at(F.col("m"), i)
        at = (i == acc["pos"]) & acc["ok"]
        return F.when(~at, acc).when(
            m.isNull(), F.struct(acc["pos"].alias("pos"), F.lit(False).alias("ok"), acc["ids"].alias("ids"))
        ).otherwise(F.struct((acc["pos"] + m["l"]).alias("pos"), F.lit(True).alias("ok"),
                             F.concat(acc["ids"], F.array(m["token_id"])).alias("ids")))

    walked = per_word.select("word", "_L", F.aggregate(
        F.sequence(F.lit(0), F.col("_L") - 1), init, step).alias("w"))
    done = F.col("w.ok") & (F.col("w.pos") == F.col("_L")) & (F.col("_L") <= max_chars)
    return walked.select("word", F.when(done, F.col("w.ids")).otherwise(F.array(F.lit(unk))).alias("ids"))


# ------------------------------------------------------------------ W7
def encode(df: DataFrame, vocab: DataFrame, max_len: int | None = 512, text_col: str = "text",
           id_cols=("row_id",), padding: bool = False, truncation: bool = True,
           with_length: bool = True) -> DataFrame:
    """``[CLS] pieces [SEP]`` per row, truncated to ``max_len`` including the
    special tokens, with ``token_type_ids`` (0), ``attention_mask`` (1),
    ``special_tokens_mask`` and ``length``; ``padding`` pads to ``max_len``.

    Words are segmented once per distinct word and joined back; rows are
    regrouped in word order.  Segments of hot words (more than one in
    ``HOT_WORDS`` of all tokens, so fewer than ``HOT_WORDS`` words, of at most
    100 characters) reach their tokens by broadcast, and longer words are
    unknown without a lookup; such tokens spread over the shuffle of the others
    by row, so no word fills one task.  The text is scanned and normalised once:
    the rows' words are checkpointed, and so are the distinct words with their
    counts.  A row with no words encodes as ``[CLS] [SEP]``.
    """
    id_cols = list(id_cols)
    facts = _vocab_facts(vocab, "[CLS]", "[SEP]", "[PAD]", "[UNK]")
    cls_id, sep_id, pad_id, unk_id = facts[2]
    checkpoint_dir(df.sparkSession)
    rows = df.select(*id_cols, word_array(text_col).alias("_words")).checkpoint(eager=True)
    # rows without words keep one null-word row, so no second pass over rows
    words = rows.select(*id_cols, F.posexplode_outer("_words").alias("word_no", "word"))
    counts = (words.where(F.length("word") <= MAX_INPUT_CHARS_PER_WORD)
              .groupBy("word").agg(F.count(F.lit(1)).alias("n")).checkpoint(eager=True))
    total = counts.agg(F.sum("n")).first()[0] or 0
    is_hot = F.col("n") > F.lit(total // HOT_WORDS)
    hot = _segment(counts.where(is_hot), facts).withColumnRenamed("ids", "_hot")
    cold = _segment(counts.where(~is_hot), facts)
    tokens = words.join(F.broadcast(hot), "word", "left")
    long_word = F.when(F.length("word") > MAX_INPUT_CHARS_PER_WORD, F.array(F.lit(unk_id)))
    tokens = tokens.withColumn("_own", F.coalesce("_hot", long_word))
    spread = F.xxhash64(*id_cols, "word_no").cast("string")
    tokens = tokens.withColumn("_key", F.when(F.col("word").isNull() | F.col("_own").isNotNull(), spread)
                               .otherwise(F.col("word")))
    joined = tokens.join(cold.select(F.col("word").alias("_key"), F.col("ids").alias("_cold")), "_key", "left")
    joined = joined.withColumn("ids", F.when(F.col("word").isNotNull(), F.coalesce("_own", "_cold")))
    pieces = (joined.groupBy(*id_cols)
              .agg(F.flatten(F.transform(F.array_sort(F.collect_list(
                  F.when(F.col("ids").isNotNull(), F.struct("word_no", "ids")))),
                  lambda s: s["ids"])).alias("_ids")))
    empty = F.array().cast("array<int>")
    body = F.coalesce(F.col("_ids"), empty)
    if truncation and max_len is not None:
        body = F.slice(body, 1, max_len - 2) if max_len > 2 else empty
    out = pieces.withColumn(
        "input_ids", F.concat(F.array(F.lit(cls_id)), body, F.array(F.lit(sep_id))))
    n = F.size("input_ids")
    out = out.select(
        *id_cols, "input_ids",
        F.transform("input_ids", lambda x: F.lit(0)).alias("token_type_ids"),
        F.transform("input_ids", lambda x, i: F.when((i == 0) | (i == n - 1), 1).otherwise(0))
         .alias("special_tokens_mask"),
        F.transform("input_ids", lambda x: F.lit(1)).alias("attention_mask"))
    if with_length:
        out = out.withColumn("length", F.size("input_ids"))
    if padding and max_len is not None:
        out = pad_to(out, F.lit(max_len), pad_id)
    return out


def pad_to(df: DataFrame, target: Column, pad_id: int = 0) -> DataFrame:
    """Pad the example arrays to ``target`` (pads: id ``pad_id``, type 0,
    attention 0, special 1, label -100)."""
    df = df.withColumn("_k", F.greatest(target - F.size("input_ids"), F.lit(0)).cast("int"))
    fills = {"input_ids": pad_id, "token_type_ids": 0, "attention_mask": 0,
             "special_tokens_mask": 1, "labels": IGNORE_LABEL}
    for c, v in fills.items():
        if c in df.columns:
            df = df.withColumn(c, F.concat(c, F.array_repeat(F.lit(v), F.col("_k"))))
    return df.drop("_k")


# ------------------------------------------------------------------ M1
def line_by_line(df: DataFrame, vocab: DataFrame, max_len: int = 512, text_col: str = "text",
                 id_cols=("row_id",), padding: bool = False) -> DataFrame:
    """Drop empty / whitespace-only lines, then encode one example per line."""
    return encode(corpus.drop_blank_lines(df, text_col), vocab, max_len, text_col, id_cols, padding)


# ------------------------------------------------------------------ M2
ARRAY_FIELDS = ("input_ids", "token_type_ids", "attention_mask", "special_tokens_mask")


def pack_blocks(encoded: DataFrame, max_len: int, order_cols=("row_id",),
                group_rows: int = 1000) -> DataFrame:
    """Concatenate the examples of each group of ``group_rows`` consecutive
    rows and cut the stream into blocks of ``max_len``; the tail is dropped,
    except that a group shorter than ``max_len`` keeps one short block.

    Rows are numbered by the range-partitioned index; running offsets are a
    window partitioned by group (``group_rows`` rows).  Both see the order
    columns and lengths alone; the arrays, checkpointed once, are joined
    afterwards.  Each row contributes one slice per block it overlaps, and
    blocks are re-assembled in row order.
    Output ``(group_id, block_no, input_ids, token_type_ids, attention_mask,
    special_tokens_mask)``.
    """
    fields = [c for c in ARRAY_FIELDS if c in encoded.columns]
    checkpoint_dir(encoded.sparkSession)
    source = encoded.select(*order_cols, *fields, F.monotonically_increasing_id().alias("_row")).checkpoint(eager=True)
    idx = with_row_index(source.select(*order_cols, "_row", F.size("input_ids").alias("_len")),
                         list(order_cols), "_idx")
    idx = idx.withColumn("group_id", F.floor(F.col("_idx") / group_rows))
    g = Window.partitionBy("group_id")
    gw = g.orderBy("_idx").rowsBetween(Window.unboundedPreceding, -1)
    idx = idx.withColumn("_off", F.coalesce(F.sum("_len").over(gw), F.lit(0))) \
             .withColumn("_total", F.sum("_len").over(g))
    nblocks = F.when(F.col("_total") < max_len, F.lit(1)).otherwise(
        F.floor(F.col("_total") / max_len))
    keep_end = F.when(F.col("_total") < max_len, F.col("_total")).otherwise(nblocks * max_len)
    live = idx.where((F.col("_len") > 0) & (F.col("_off") < keep_end))
    first_b = F.floor(F.col("_off") / max_len)
    last_b = F.floor((F.least(F.col("_off") + F.col("_len"), keep_end) - 1) / max_len)
    spans = live.select("_row", "group_id", "_idx", "_off", F.sequence(first_b, last_b).alias("_blocks"))
    parts = spans.join(source.select("_row", *fields), "_row").select(
        "group_id", "_idx", "_off", *fields, F.explode("_blocks").alias("block_no"))
    lo = F.greatest(F.col("block_no") * max_len - F.col("_off"), F.lit(0))
    hi = F.least((F.col("block_no") + 1) * max_len - F.col("_off"), F.size("input_ids"))
    parts = parts.select("group_id", "block_no", "_idx",
                         *[F.slice(c, lo + 1, hi - lo).alias(c) for c in fields])
    agg = parts.groupBy("group_id", "block_no").agg(
        F.array_sort(F.collect_list(F.struct("_idx", *fields))).alias("_p"))
    def field(c):
        return lambda s: s[c]

    return agg.select("group_id", "block_no",
                      *[F.flatten(F.transform("_p", field(c))).alias(c) for c in fields])


# ------------------------------------------------------------------ M3
def mask_tokens(df: DataFrame, vocab_size: int, mask_id: int, p: float = 0.15, seed: int = 42,
                epoch: int = 0, row_cols=("row_id",)) -> DataFrame:
    """Masked-LM inputs: non-special positions chosen with probability ``p``;
    of those 80% become ``[MASK]``, 10% a uniform random id, 10% stay;
    ``labels`` = original id where chosen, else -100.

    One MD5 per (seed, epoch, row, position) gives three independent 40-bit
    draws (hex digits 1-10: chosen, 11-20: replacement kind, 21-30: random
    id); a new ``epoch`` re-masks, as a per-batch collator would.
    """
    row_key = [F.col(c) for c in row_cols]
    digests = F.transform("input_ids", lambda x, i: F.md5(
        hash_key(F.lit(seed), F.lit(epoch), *row_key, i)))

    def field(i, k):
        return F.conv(F.substring(F.element_at(F.col("_md5"), i + 1), 10 * k + 1, 10), 16, 10) \
                .cast("long")

    def draw(i, k):
        return field(i, k) / F.lit(float(1 << 40))

    special = F.col("special_tokens_mask")
    out = df.withColumn("_md5", digests)
    out = out.withColumn("_chosen", F.transform(
        "input_ids", lambda x, i: (F.element_at(special, i + 1) == 0) & (draw(i, 0) < p)))
    new_ids = F.transform("input_ids", lambda x, i: F.when(
        ~F.element_at(F.col("_chosen"), i + 1), x).when(
        draw(i, 1) < MASK_SHARE, F.lit(mask_id)).when(
        draw(i, 1) < MASK_SHARE + RANDOM_SHARE, (field(i, 2) % vocab_size).cast("int")).otherwise(x))
    labels = F.transform("input_ids", lambda x, i: F.when(
        F.element_at(F.col("_chosen"), i + 1), x).otherwise(F.lit(IGNORE_LABEL)))
    return out.withColumn("labels", labels).withColumn("input_ids", new_ids).drop("_chosen", "_md5")


# ------------------------------------------------------------------ M4
def length_batches(df: DataFrame, batch_size: int, mega_mult: int | None = None, seed: int = 42,
                   key_cols=("row_id",), length_col: str = "length") -> DataFrame:
    """Length-grouped batches: keyed shuffle, mega-batches of
    ``batch_size * mega_mult``, each sorted by length descending and cut into
    batches; the longest example's batch is swapped to the front.

    ``mega_mult`` defaults to ``min(n // (batch_size * 4), 50)`` (at least 1).
    Adds ``rank`` (shuffle order, from ``split.hash_rank``: no global sort),
    ``batch_id`` and ``batch_pos``.  The input is checkpointed, as the ranks, the
    row count and the longest example each read it.  Ranks and places are found
    on keys and lengths alone; the other columns are joined afterwards.
    """
    checkpoint_dir(df.sparkSession)
    df = df.withColumn("_row", F.monotonically_increasing_id()).checkpoint(eager=True)
    narrow = list(dict.fromkeys([*key_cols, length_col]))
    ranked = hash_rank(df.select("_row", *narrow), list(key_cols), seed, "rank")
    if mega_mult is None:
        n = df.agg(F.count(F.lit(1))).first()[0]   # one scalar
        mega_mult = max(min(n // (batch_size * 4), 50), 1)
    mega = batch_size * mega_mult
    ranked = ranked.withColumn("_mega", F.floor(F.col("rank") / mega))
    w = Window.partitionBy("_mega").orderBy(F.desc(length_col), "rank")
    ranked = ranked.withColumn("_pos", F.row_number().over(w) - 1)
    # the longest example (first of its mega-batch) trades places with the
    # first example of mega-batch 0
    top = ranked.where(F.col("_pos") == 0).orderBy(F.desc(length_col), "_mega").select("_mega").first()
    m_star = 0 if top is None else top[0]
    first_of = (F.col("_pos") == 0)
    new_mega = F.when(first_of & (F.col("_mega") == 0), F.lit(m_star)).when(
        first_of & (F.col("_mega") == m_star), F.lit(0)).otherwise(F.col("_mega"))
    ranked = ranked.withColumn("_mega", new_mega)
    placed = ranked.select(
        "_row", *narrow, "rank",
        (F.col("_mega") * mega_mult + F.floor(F.col("_pos") / batch_size)).cast("long").alias("batch_id"),
        (F.col("_pos") % batch_size).cast("int").alias("batch_pos"))
    others = [c for c in df.columns if c not in narrow]
    if len(others) > 1:  # more than _row
        placed = df.select(*others).join(placed, "_row")
    return placed.select(*[c for c in df.columns if c != "_row"], "rank", "batch_id", "batch_pos")


# ------------------------------------------------------------------ M5
def pad_batch(df: DataFrame, batch_col: str = "batch_id", multiple: int | None = 8,
              pad_id: int = 0) -> DataFrame:
    """Pad each example to its batch's longest, rounded up to ``multiple``."""
    longest = F.max(F.size("input_ids")).over(Window.partitionBy(batch_col))
    target = longest if not multiple else F.ceil(longest / multiple) * multiple
    return pad_to(df.withColumn("_target", target.cast("int")), F.col("_target"), pad_id).drop("_target")
