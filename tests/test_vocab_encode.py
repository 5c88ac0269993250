"""Vocabulary learner, WordPiece segmentation, encoding and the training
table operators: crafted rows, a restatement of the learner, and the public
``tokenizers`` library as an oracle for segmentation (tests only)."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.operators import encode as E
from tessera.operators import vocab as V
from conftest import SF001


def vocab_df(spark, pieces):
    return spark.createDataFrame(list(enumerate(V.special_token_list(10) + pieces)),
                                 "token_id int, piece string")


def test_wordpiece_crafted(spark):
    vocab = vocab_df(spark, ["un", "##aff", "##able"])
    words = spark.createDataFrame([("unaffable",), ("unx",), ("u" * 101,)], "word string")
    got = {r.word: list(r.ids) for r in E.wordpiece_segment(words, vocab).collect()}
    assert got["unaffable"] == [15, 16, 17]
    assert got["unx"] == [1]
    assert got["u" * 101] == [1]


def test_encode_matches_tokenizers_library(spark):
    tk = pytest.importorskip("tokenizers")
    from tokenizers import Tokenizer, normalizers, pre_tokenizers, processors
    from tokenizers.models import WordPiece
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    counts = V.word_counts(V.pretokenize(docs, "text", ["doc_id"]))
    top = [r.word for r in counts.orderBy(F.desc("n"), "word").limit(300).collect()]
    chars = sorted({c for w in top for c in w})
    pieces = sorted(set(top + chars + ["##" + c for c in chars] + ["##" + w for w in top[:100]])
                    - set(V.special_token_list(10)))
    vocab = vocab_df(spark, pieces)
    conv = spark.read.parquet(f"{SF001}/conversations.parquet").select("conv_id", "turn", "text")
    got = {(r.conv_id, r.turn): list(r.input_ids)
           for r in E.encode(conv, vocab, 48, "text", ["conv_id", "turn"]).collect()}
    v = {p: i for i, p in enumerate(V.special_token_list(10) + pieces)}
    tok = Tokenizer(WordPiece(v, unk_token="[UNK]", max_input_chars_per_word=100))
    tok.normalizer = normalizers.Sequence([normalizers.NFKC(), normalizers.Strip()])
    tok.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    tok.post_processor = processors.BertProcessing(("[SEP]", 3), ("[CLS]", 2))
    tok.enable_truncation(48)
    for r in conv.collect():
        assert got[(r.conv_id, r.turn)] == tok.encode(r.text).ids


def py_learn(word_counts, vocab_size, num_unused=10, min_frequency=2, limit_alphabet=None):
    """One merge at a time; ties by (count desc, left, right)."""
    freq = Counter()
    for w, n in word_counts.items():
        for c in w:
            freq[c] += n
    ranked = sorted(freq, key=lambda c: (-freq[c], c))
    alpha = sorted(ranked if limit_alphabet is None else ranked[:limit_alphabet])
    keep = set(alpha)
    words = {w: [c if i == 0 else "##" + c for i, c in enumerate(w) if c in keep] for w in word_counts}
    vocab = V.special_token_list(num_unused) + alpha
    vocab += sorted({s for sy in words.values() for s in sy if s.startswith("##")} - set(vocab))
    known = set(vocab)
    while len(vocab) < vocab_size:
        pairs = Counter()
        for w, sy in words.items():
            for a, b in zip(sy, sy[1:]):
                pairs[(a, b)] += word_counts[w]
        if not pairs:
            break
        (a, b), n = min(pairs.items(), key=lambda kv: (-kv[1], sum(len(x) - 2 * x.startswith("##") for x in kv[0]), kv[0]))
        if n < min_frequency:
            break
        new = V.merged_piece(a, b)
        if new not in known:
            vocab.append(new)
            known.add(new)
        for w, sy in words.items():
            out, i = [], 0
            while i < len(sy):
                if i + 1 < len(sy) and sy[i] == a and sy[i + 1] == b:
                    out.append(new)
                    i += 2
                else:
                    out.append(sy[i])
                    i += 1
            words[w] = out
    return vocab


@pytest.mark.parametrize("batch", [False, True])
def test_learner_equals_one_at_a_time(spark, batch):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").limit(40)
    counts = V.word_counts(V.pretokenize(docs, "text", ["doc_id"]))
    wc = {r.word: r.n for r in counts.collect()}
    size = len(py_learn(wc, 0)) + 60
    want = py_learn(wc, size)
    got = [r.piece for r in V.learn_wordpiece(counts, size, limit_alphabet=None, batch=batch)
           .orderBy("token_id").collect()]
    assert got == want


def test_alphabet_limit(spark):
    counts = spark.createDataFrame([("ab", 3), ("b", 1), ("c", 4)], "word string, n long")
    got = [(r.char, r.n) for r in V.alphabet(counts, 2).collect()]
    assert got == [("b", 4), ("c", 4)]


def test_pretokenize_modes(spark):
    df = spark.createDataFrame([(1, " a　b  ｃ ")], "doc_id int, text string")
    assert [r.word for r in V.pretokenize(df).orderBy("word_no").collect()] == ["a", "b", "c"]
    got = V.pretokenize(df, mode="unidic_lite", splitter=lambda t: list(t.replace(" ", "")))
    assert [r.word for r in got.orderBy("word_no").collect()] == ["a", "b", "c"]
    with pytest.raises(ValueError):
        V.pretokenize(df, mode="other")


def enc_rows(spark, lists):
    rows = [(i, l, [0] * len(l), [1] * len(l), [0] * len(l)) for i, l in enumerate(lists)]
    return spark.createDataFrame(rows, "row_id long, input_ids array<int>, token_type_ids array<int>, "
                                 "attention_mask array<int>, special_tokens_mask array<int>")


def test_pack_blocks_crafted(spark):
    df = enc_rows(spark, [[1, 2, 3], [4, 5, 6], [7, 8, 9], [10, 11, 12]])
    got = [(r.group_id, list(r.input_ids))
           for r in E.pack_blocks(df, 4, ["row_id"], group_rows=3).orderBy("group_id", "block_no").collect()]
    assert got == [(0, [1, 2, 3, 4]), (0, [5, 6, 7, 8]), (1, [10, 11, 12])]


def test_pad_batch_crafted(spark):
    df = spark.createDataFrame([(0, 7, [1] * 5, [1] * 5), (1, 7, [1] * 9, [1] * 9)],
                               "row_id long, batch_id long, input_ids array<int>, attention_mask array<int>")
    got = {r.row_id: (len(r.input_ids), sum(r.attention_mask)) for r in E.pad_batch(df).collect()}
    assert got == {0: (16, 5), 1: (16, 9)}


def test_mask_tokens_properties(spark):
    n = 4000
    df = spark.range(n).select(F.col("id").alias("row_id"),
                               F.array_repeat(F.lit(7), 12).alias("input_ids"),
                               F.array(*[F.lit(1 if i in (0, 11) else 0) for i in range(12)])
                               .alias("special_tokens_mask"))
    out = E.mask_tokens(df, 100, 4, p=0.15, seed=1).collect()
    chosen = masked = 0
    for r in out:
        assert r.labels[0] == -100 and r.labels[11] == -100
        for x, lab in zip(r.input_ids, r.labels):
            if lab != -100:
                chosen += 1
                masked += x == 4
            else:
                assert x == 7
    share = chosen / (n * 10)
    assert 0.14 < share < 0.16 and 0.77 < masked / chosen < 0.83
    again = E.mask_tokens(df, 100, 4, p=0.15, seed=1, epoch=1).collect()
    assert [list(r.labels) for r in again] != [list(r.labels) for r in out]


def test_length_batches_properties(spark):
    lengths = [(i, (i * 37) % 50 + 1) for i in range(500)]
    df = spark.createDataFrame(lengths, "row_id long, length int")
    out = E.length_batches(df, 16, 4, seed=2).collect()
    assert sorted(r.row_id for r in out) == list(range(500))
    by_batch = {}
    for r in out:
        by_batch.setdefault(r.batch_id, []).append(r)
    assert all(len(v) <= 16 for v in by_batch.values())
    first = min(by_batch)
    assert max(r.length for r in by_batch[first]) == 50


def test_vocabulary_recipe_round_trip(spark, tmp_dir):
    import os
    from tessera.operators import corpus
    from tessera.plans import recipes
    from tessera.sources import sinks
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    lines = corpus.explode_lines(docs, normalize=True)
    vocab = recipes.vocabulary(lines, sample_size=500, vocab_size=260, seed=3)
    rows = vocab.orderBy("token_id").collect()
    assert [r.token_id for r in rows] == list(range(len(rows))) and len(rows) <= 260
    assert [r.piece for r in rows[:15]] == V.special_token_list(10)
    f = sinks.write_vocab(vocab, os.path.join(tmp_dir, "vocab"))
    back = V.load_vocab(spark, f).orderBy("token_id").collect()
    assert [(r.token_id, r.piece) for r in back] == [(r.token_id, r.piece) for r in rows]
    # learned from a sample, the vocabulary still covers nearly all tokens
    enc = E.encode(docs.select("doc_id", "text"), vocab, None, "text", ["doc_id"], truncation=False)
    toks = enc.select(F.explode("input_ids").alias("t"))
    unk, total = toks.where("t = 1").count(), toks.count()
    assert unk < 0.01 * total


def test_encode_rows_without_words(spark):
    vocab = vocab_df(spark, ["a", "##b"])
    rows = spark.createDataFrame([(0, ""), (1, "   "), (2, "ab a"), (3, None)], "row_id long, text string")
    got = {r.row_id: (list(r.input_ids), list(r.special_tokens_mask), r.length)
           for r in E.encode(rows, vocab, 8).collect()}
    assert got[0] == ([2, 3], [1, 1], 2) and got[1] == ([2, 3], [1, 1], 2)
    assert got[2] == ([2, 15, 16, 15, 3], [1, 0, 0, 0, 1], 5)
    assert got[3] == ([2, 3], [1, 1], 2)


def test_word_symbols_prefix_follows_original_position(spark):
    counts = spark.createDataFrame([("xab", 3), ("abx", 2), ("xx", 1)], "word string, n long")
    alpha = spark.createDataFrame([("a",), ("b",)], "char string")
    got = {r.word: list(r.symbols) for r in V.word_symbols(counts, alpha).collect()}
    assert got == {"xab": ["##a", "##b"], "abx": ["a", "##b"], "xx": []}


def test_learner_limited_alphabet(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").limit(40)
    counts = V.word_counts(V.pretokenize(docs, "text", ["doc_id"]))
    wc = {r.word: r.n for r in counts.collect()}
    limit = 20
    size = len(py_learn(wc, 0, limit_alphabet=limit)) + 40
    want = py_learn(wc, size, limit_alphabet=limit)
    got = [r.piece for r in V.learn_wordpiece(counts, size, limit_alphabet=limit)
           .orderBy("token_id").collect()]
    assert got == want


def test_encode_hot_and_long_words(spark):
    """A word that holds most tokens, words above 100 characters, a word of
    digits and rare words all keep their segments and order."""
    pieces = ["[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]", "a", "##b", "7"]
    vocab = spark.createDataFrame([(i, p) for i, p in enumerate(pieces)], "token_id int, piece string")
    texts = ["a " * 30_000 + "ab", "x" * 101 + " ab a", None, "7 ab zz"]
    df = spark.createDataFrame(list(enumerate(texts)), "row_id long, text string")
    got = {r["row_id"]: r["input_ids"] for r in E.encode(df, vocab, None, truncation=False).collect()}
    assert got == {0: [2] + [5] * 30_000 + [5, 6, 3], 1: [2, 1, 5, 6, 5, 3], 2: [2, 3], 3: [2, 7, 5, 6, 1, 3]}


def test_learner_never_cuts_the_alphabet(spark):
    counts = spark.createDataFrame([("abcdefgh", 5), ("hgfedcba", 3)], "word string, n long")
    least = len(V.special_token_list(10)) + 16
    with pytest.raises(ValueError):
        V.learn_wordpiece(counts, least - 1)
    got = {r.piece for r in V.learn_wordpiece(counts, least).collect()}
    assert len(got) == least and {x for c in "abcdefgh" for x in (c, "##" + c)} <= got


def test_ranks_and_offsets_see_no_arrays(spark):
    rows = [(i, [100 * i + j for j in range(i % 7 + 1)]) for i in range(60)]
    df = spark.createDataFrame(rows, "row_id long, input_ids array<int>").repartition(4)
    df = df.withColumn("length", F.size("input_ids"))
    batched = E.length_batches(df, 4, 2)
    assert batched.columns == ["row_id", "input_ids", "length", "rank", "batch_id", "batch_pos"]
    got = batched.collect()
    assert {(r.row_id, tuple(r.input_ids)) for r in got} == {(i, tuple(a)) for i, a in rows}
    assert sorted(r["rank"] for r in got) == list(range(60))
    assert len({(r.batch_id, r.batch_pos) for r in got}) == 60
    blocks = {(r.group_id, r.block_no): r.input_ids for r in E.pack_blocks(df.drop("length"), 8, ["row_id"], 20).collect()}
    want = {}
    for g in range(3):
        flat = [x for _, a in rows[20 * g:20 * g + 20] for x in a]
        want.update({(g, b): flat[8 * b:8 * b + 8] for b in range(len(flat) // 8)})
    assert blocks == want
    for plan in (batched._jdf.queryExecution().toString(), E.pack_blocks(df, 8)._jdf.queryExecution().toString()):
        physical = plan[plan.index("== Physical Plan =="):]
        assert "input_ids" not in "".join(s for s in physical.splitlines() if "Window" in s or "rangepartitioning" in s)
    # rows that share a key stay apart
    twins = df.union(df.limit(5)).withColumn("row_id", F.lit(1).cast("long"))
    assert E.length_batches(twins, 4, 2).count() == 65


def test_encode_normalises_once(spark):
    vocab = spark.createDataFrame([(i, p) for i, p in enumerate(["[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]", "a", "##b"])],
                                  "token_id int, piece string")
    df = spark.createDataFrame([(1, "ab \uff41"), (2, None), (3, "  "), (4, "q")], "row_id long, text string")
    out = E.encode(df, vocab)
    assert {r.row_id: r.input_ids for r in out.collect()} == {1: [2, 5, 6, 5, 3], 2: [2, 3], 3: [2, 3], 4: [2, 1, 3]}
    assert "ArrowEvalPython" not in out._jdf.queryExecution().toString()  # the words are read from the checkpoint


def test_learner_reads_its_counts_once(spark):
    read = spark.sparkContext.accumulator(0)

    def once(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    rows = [("aab", 5), ("aac", 3), ("bba", 2)]
    counts = spark.createDataFrame(rows, "word string, n long").mapInArrow(once, "word string, n long")
    pieces = {r.piece for r in V.learn_wordpiece(counts, 24, 10).collect()}
    assert {"a", "##b", "aa"} <= pieces and read.value == len(rows)
