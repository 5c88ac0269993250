"""Token files, whitening and the prefix trie against the library, brute force and round trips."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import prefix_trie, tokenfile, whiten

public_tokenizers = pytest.importorskip("public_tokenizers")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [None, "", " \n\t ", "One", "a\x0bb\x0cc\r\nd", "word " * 9000, "x" * 30000, "é　\u0085x ΟΔΟΣ. İstanbul's", "don't; DON'T! 12.5% (a)b.",
         "<|endoftext|> <|ENDOFTEXT|> a<|startoftext|>b.", "\x01 a\x01b \x1c \x00", "é ́x ﬁ K Å", "same text", "same text", "日本語。テスト!?"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(TOKENIZER)


# ------------------------------------------------------------------ token files
@pytest.mark.parametrize("seed", range(6))
def test_words_round_trip(seed):
    rng = np.random.default_rng(seed)
    for _ in range(25):
        sizes = rng.integers(0, 300, rng.integers(0, 6))
        bits = rng.integers(1, 65, int(sizes.sum())) if seed % 2 else np.full(int(sizes.sum()), rng.integers(1, 18))
        ids = np.asarray([random.Random(int(b) + i).getrandbits(int(b)) for i, b in enumerate(bits)], np.uint64)
        if seed > 3 and len(ids):
            ids[rng.random(len(ids)) < 0.4] = (1 << 64) - 1
            ids[rng.random(len(ids)) < 0.3] = 1 << 60
            ids[rng.random(len(ids)) < 0.3] = 0
        words, used = tokenfile.pack(ids, sizes)
        assert used.sum() == len(words)
        assert (tokenfile.unpack(words, used, sizes) == ids).all()


def test_words_take_the_most_ids_they_can():
    words, used = tokenfile.pack(np.zeros(60, np.uint64), np.asarray([60]))
    assert len(words) == 1
    words, _ = tokenfile.pack(np.full(9, (1 << 20) - 1, np.uint64), np.asarray([9]))
    assert len(words) == 3
    words, _ = tokenfile.pack(np.asarray([1 << 61], np.uint64), np.asarray([1]))
    assert words.tolist() == [0, 1 << 61]


def test_blocks_are_packed_as_each_alone():
    rng = np.random.default_rng(4)
    sizes = np.asarray([0, 3, 0, 0, 4096, 1, 700, 0])
    ids = rng.integers(0, 1 << 16, int(sizes.sum()), np.uint64)
    ids[rng.random(len(ids)) < 0.1] = (1 << 64) - 1
    words, used = tokenfile.pack(ids, sizes)
    alone = [tokenfile.pack(part, np.asarray([len(part)])) for part in np.split(ids, np.cumsum(sizes)[:-1])]
    assert used.tolist() == [int(u[0]) for _, u in alone] and words.tolist() == [x for w, _ in alone for x in w.tolist()]
    texts = pa.array(["", "a", "", "é\x00b", "日本"], pa.large_string())
    assert tokenfile._values(texts) == [t.encode() for t in texts.to_pylist()]
    assert tokenfile._values(texts.slice(1, 3)) == [b"a", b"", "é\x00b".encode()] and tokenfile._values(texts[:0]) == []


def test_tokenizer_with_its_table(library, monkeypatch):
    words = tokenfile.Words(TOKENIZER)
    for size in (600_000, 12):  # a small table is renewed with every call
        monkeypatch.setattr(tokenfile, "TABLE", size)
        for part in (TEXTS, TEXTS[::-1], TEXTS[3:9]):
            ids, counts = words.encode_many(pa.array(part, pa.string()))
            want = [library.encode(t or "", add_special_tokens=False).ids for t in part]
            assert counts.tolist() == [len(w) for w in want]
            assert ids.tolist() == [i for w in want for i in w]


@pytest.mark.parametrize("segment", [1 << 20, 300])
def test_token_files(spark, library, tmp_dir, monkeypatch, segment):
    monkeypatch.setattr(tokenfile, "SEGMENT", segment)
    monkeypatch.setattr(tokenfile, "PER_FILE", 2)
    rng = random.Random(3)
    texts = TEXTS + [" ".join(rng.choice(["ab", "the", "Queue.", "überall"]) for _ in range(rng.randint(0, 400))) for _ in range(60)]
    ids = [None if i in (4, 20) else (7 if i in (8, 9, 30) else -i) for i in range(len(texts))]
    df = spark.createDataFrame([(i, t, "clash", 1, "x") for i, t in zip(ids, texts)], "doc_id long, text string, start string, _hash int, value string")
    path = f"{tmp_dir}/ids-{segment}"
    got = tokenfile.round_trip(df, TOKENIZER, end_id=1, path=path).collect()
    got.sort(key=lambda r: r.start)
    coded = {t: library.encode(t or "", add_special_tokens=False).ids + [1] for t in texts}
    assert [r.doc_id for r in got] == sorted(ids, key=lambda i: (i is not None, i))
    at = 0
    for r in got:
        own = [coded[t] for i, t in zip(ids, texts) if i == r.doc_id]
        have = np.frombuffer(r.ids, "<u4").tolist()
        assert r.start == at and r.n_tokens == len(have) and have in own
        at += len(have)
    assert sorted(np.frombuffer(r.ids, "<u4").tolist() for r in got) == sorted(coded[t] for t in texts)


def test_token_files_of_lists_and_faults(spark, tmp_dir):
    rows = [(3, [1 << 61, 5, 0]), (1, None), (2, []), (None, [7])]
    df = spark.createDataFrame(rows, "doc_id long, ids array<long>")
    tokenfile.write_ids(df, f"{tmp_dir}/lists")
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids) for r in tokenfile.read_ids(spark, f"{tmp_dir}/lists").collect())
    assert [g for g in got if g[2]] == [(0, None, 1, [7]), (1, 3, 3, [1 << 61, 5, 0])]
    assert sorted(g[1] for g in got if not g[2]) == [1, 2]
    tokenfile.write_ids(df.where("false"), f"{tmp_dir}/none")
    assert tokenfile.read_ids(spark, f"{tmp_dir}/none").count() == 0
    whole = tokenfile.segment(np.asarray([1]), 0, np.asarray([2]), np.asarray([3, 4], np.uint64)) + b"\n"
    (at, head), = tokenfile.segments(whole)
    assert tokenfile.open_segment(whole, at, head)[3].tolist() == [3, 4]
    bad = whole[:-8] + bytes([whole[-8] ^ 1]) + whole[-7:]
    with pytest.raises(ValueError):
        tokenfile.open_segment(bad, 0, head)
    with pytest.raises(ValueError):
        list(tokenfile.segments(whole[:-1]))


# ------------------------------------------------------------------ whitening
def _whitened(spark, rows, **how):
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<double>, n int, key string")
    return whiten.whiten(df, **how).collect()


@pytest.mark.parametrize("weights", ["count", "one"])
def test_whitening_matches_numpy(spark, monkeypatch, weights):
    monkeypatch.setattr(whiten, "HOT", 8)
    rng = random.Random(5)
    base = [[rng.gauss(0, 1 + j) for j in range(6)] for _ in range(60)]
    rows = list(enumerate(base + [base[0]] * 40 + [base[1]] * 3))
    out = [(200, None), (201, []), (202, [1.0, None] * 3), (203, [float("nan")] * 6), (204, [float("inf")] + [0.0] * 5), (205, [1.0, 2.0])]
    rows += [(None, base[2]), (5, base[3]), (300, [0.0] * 6)]
    got = _whitened(spark, rows + out, components=4, weights=weights)
    x = np.floor(64 * np.asarray([v for _, v in rows])).astype(np.int64) + 1_000_000
    fitted = x if weights == "count" else np.unique(x, axis=0)
    n, sums = len(fitted), fitted.sum(0)
    centred = fitted - sums / n
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:4], u[:, ::-1][:, :4]
    y = (x - sums / n) @ u / np.sqrt(e)
    assert len(got) == 4 * len(rows)
    by = defaultdict(list)
    for r in got:
        assert r.n == n and r.identity_error < 1e-9
        assert abs(r.explained / (e[r.component - 1] / np.trace(v)) - 1) < 1e-12
        by[r.component].append((r.deviation, r.whitened, r.vec_id))
    for c in range(1, 5):
        want = [(int(((n * a - sums) ** 2).sum()), b, i) for a, b, (i, _) in zip(x, y[:, c - 1], rows)]
        key = lambda t: (t[0], t[2] is not None, t[2] or 0)
        a, b = sorted(by[c], key=key), sorted(want, key=key)
        sign = 1 if abs(a[0][1] - b[0][1]) < 1e-6 else -1
        assert all(p[0] == q[0] and p[2] == q[2] and abs(p[1] * sign - q[1]) < 1e-8 for p, q in zip(a, b))


def test_whitening_without_variance(spark):
    assert _whitened(spark, []) == []
    assert _whitened(spark, [(1, None)]) == []
    assert _whitened(spark, [(1, [1.0, 2.0])] * 3) == []
    one = _whitened(spark, [(1, [0.0, 5.0]), (2, [1.0, 5.0]), (2, [1.0, 5.0])])
    assert {r.component for r in one} == {1} and len(one) == 3
    huge = _whitened(spark, [(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [0.0, 9.0])])
    assert len(huge) and all(r.deviation is None for r in huge if r.vec_id != 3)


def test_products_are_exact():
    rng = random.Random(1)
    x = np.asarray([[rng.randint(-(1 << k), 1 << k) for _ in range(3)] for k in (3, 20, 26, 27, 40, 60)])
    w = np.asarray([1, 1 << 30, 5, 7, 1, 3])
    want = sum(int(k) * np.outer(r.astype(object), r.astype(object)) for r, k in zip(x, w))
    assert (whiten.weighted_gram(x, w) == want).all()


# ------------------------------------------------------------------ prefix trie
TURNS = "conv_id long, turn long, role string, text string, n int, path string"


def brute_trie(strings):
    """Node rows from {conv_id: list of (role, text)}."""
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(strings):
        s = tuple(strings[c])
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
        ends[s].append(c)
    kids = defaultdict(set)
    for p in members:
        if p:
            kids[p[:-1]].add(p)

    def below(p):
        return [p] + [q for k in kids[p] for q in below(k)]
    out = []
    for p, m in members.items():
        sub = below(p)
        out.append((m[0], len(p), members[p[:-1]][0] if p else None, len(m), len(kids[p]), sum(not kids[q] for q in sub),
                    sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in sub if q),
                    hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest()))
    return sorted(out, key=repr)


def rebuilt(rows):
    own = defaultdict(list)
    for r in rows:
        if r[0] is not None:
            own[r[0]].append(r)
    own = {c: [(r[2] or "", r[3] or "") for r in sorted(v, key=lambda r: (r[1] is not None, r[1] or 0))] for c, v in own.items()}
    out = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = own.get(base, [])[:h] + v[h:]
    return own, out


@pytest.mark.parametrize("seed,hot", [(1, 4096), (2, 3)])
def test_trie_matches_brute_force(spark, monkeypatch, seed, hot):
    monkeypatch.setattr(prefix_trie, "HOT", hot)
    monkeypatch.setattr(prefix_trie, "SLICE", 2)
    rng = random.Random(seed)
    rows = []
    for c in [*range(-7, 60), 5_000_000_000]:
        role = None
        length = rng.choice([1, 2, 3, 9, 17, 40])
        stem = rng.random() < 0.5
        for t in range(length):
            text = f"hot {t}" if stem and t < rng.randint(1, 40) else rng.choice(["a", "", None, "é" * 3, "long " * 200])
            rows.append((c, t if t else None, role, text, 0, "x"))
            role = rng.choice(["user", "assistant"])
    for c in range(100, 130):  # copies
        rows += [(c, t, "user", f"copy {t}", 0, "x") for t in range(12)]
    rows += [(None, 1, "user", "no id", 0, "x"), (200, 3, None, None, 0, "x")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, TURNS)
    own, new = rebuilt(rows)
    seqs = prefix_trie.sequences(df)
    assert sorted(map(tuple, prefix_trie.trie(seqs).collect()), key=repr) == brute_trie(own)
    got = prefix_trie.trie(prefix_trie.rebuild(seqs)).collect()
    assert sorted(map(tuple, got), key=repr) == brute_trie(new)
    assert any(r.depth == 0 and r.parent_conv_id is None for r in got)


def test_trie_of_little(spark):
    empty = spark.createDataFrame([], TURNS)
    assert prefix_trie.trie(prefix_trie.sequences(empty)).count() == 0
    one = prefix_trie.sequences(spark.createDataFrame([(4, 1, "user", "a", 0, "x")] * 2, TURNS))
    assert sorted(map(tuple, prefix_trie.trie(one).collect()), key=repr) == brute_trie({4: [("user", "a")] * 2})
    turnless = one.selectExpr("conv_id", "slice(turns, 1, 0) AS turns")
    assert sorted(map(tuple, prefix_trie.trie(turnless).collect()), key=repr) == brute_trie({4: []})


def test_fattest_number(spark):
    pairs = [(a, b) for a in range(0, 40) for b in range(a + 1, 41)]
    df = spark.createDataFrame(pairs, "a int, b int")
    for r in df.select("a", "b", prefix_trie.fattest(df.a, df.b).alias("f")).collect():
        assert r.f == max(range(r.a + 1, r.b + 1), key=lambda f: f & -f)


# ------------------------------------------------------------------ names and ids of the earlier operators
def test_clashing_column_names(spark):
    from tessera.llm import bpe, quality, repeats
    text = " ".join(f"w{i}" for i in range(120))
    rows = [(i, text if i < 2 else f"{text} {i}", "s", 5, "d", "t", [1], "k") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_words int, d string, t string, ids array<int>, kept string")
    got = quality.filter_documents(docs)
    assert got.columns == docs.columns and got.count() == 3 and {r.n_words for r in got.collect()} == {5}
    cut = repeats.remove_repeats(docs)
    assert cut.columns == [c for c in docs.columns if c != "kept"] + ["removed", "kept"]
    assert {(r.d, r.t, bytes(r.kept)) for r in cut.where("doc_id < 2").collect()} == {("d", "t", b"")}
    same = repeats.remove_repeats(docs, in_place=True)
    assert same.schema == docs.schema and {r.kept for r in same.collect()} == {"k"}
    coded = bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    assert coded.columns.count("ids") == 1 and all(len(r.ids) > 100 for r in coded.collect())


def test_mix_keeps_large_ids_beside_null_ones(spark):
    from tessera.llm import mixing
    big = 1 << 60
    rows = [(big + i, "a b c " * (i + 1), "s") for i in range(1, 20)] + [(None, "a b", "s"), (None, "a b", "s"), (5, "x", "r")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted((r.doc_id is not None, r.doc_id or 0, r["size"]) for r in mixing.mix(docs).collect())
    assert got == sorted((i is not None, i or 0, len(t.split())) for i, t, _ in rows)
