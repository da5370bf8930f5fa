"""Encoders against the public tokenizer libraries."""
import itertools
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from partnerlens.llm import byte_bpe, id_store, token_count

RANKS, WORDS = P.path("byte_bpe_50k.tiktoken"), P.path("word_bpe_49k.json")
PARTS = ["a", "b", "th", "the", "T", " ", "  ", "\n", "\t", "'s", "'", "é", "É", "ß", "中", "😀", "1", "23", "\x1c", "\x85", " ", " ", "\r\n", "!", "??",
         "́", "ﬁ", "Σ", "İ", "ΑΣ", "\x00", "\v", "\f", "\x1f", "\xa0", "À", "Œuf", "--", "~", " ~ ", "a~b", "<|endoftext|>", "<|STARTOFTEXT|>", "<|startoftext|>", "DON'T", "word,"]


def texts(n, seed=1):
    r = random.Random(seed)
    return ["".join(r.choice(PARTS) for _ in range(r.randint(0, 30))) for _ in range(n)] + ["", "a" * 3000, "the" * 999, "=-" * 500, " " * 400, "~"]


@pytest.fixture(scope="module")
def reference():
    ranks = {t: i for i, t in enumerate(byte_bpe.read_ranks(RANKS))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORDS)


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def test_byte_bpe_equals_the_library(reference):
    bpe = byte_bpe.coder(RANKS, P.PATTERN)
    for t in texts(3000):
        ids = bpe.encode(t)
        assert ids == packed(reference.encode_ordinary(t)), repr(t)
        assert bpe.decode(ids) == t.encode()


def test_byte_bpe_on_joined_tokens(reference):
    bpe, r = byte_bpe.coder(RANKS, P.PATTERN), random.Random(5)
    for _ in range(2000):
        t = b"".join(r.choice(bpe.tokens) for _ in range(r.randint(1, 6))).decode("utf-8", "replace")
        assert bpe.encode(t) == packed(reference.encode_ordinary(t)), repr(t)


def test_byte_bpe_long_words_are_linear(reference):
    bpe = byte_bpe.coder(RANKS, P.PATTERN)
    for t in ("a" * 200_000, "ab" * 100_000, "=-" * 100_000):
        assert bpe.encode(t) == packed(reference.encode_ordinary(t))


def test_byte_bpe_forgets_within_its_bound(reference, monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 100)
    bpe = byte_bpe.ByteBpe(byte_bpe.read_ranks(RANKS), P.PATTERN)
    for t in texts(300, seed=2):
        assert bpe.encode(t) == packed(reference.encode_ordinary(t))
    assert len(bpe.known) < 150 and len(bpe.pairs) <= 50


def test_byte_bpe_table(spark, docs, odd, reference):
    df = docs(odd)
    both = byte_bpe.decode(byte_bpe.encode(df, RANKS, P.PATTERN), RANKS, P.PATTERN)
    assert both.columns == ["doc_id", "token_ids", "decoded"]
    got = sorted((r.doc_id or -1, bytes(r.token_ids), bytes(r.decoded)) for r in both.collect())
    assert got == sorted((i or -1, packed(reference.encode_ordinary(t or "")), (t or "").encode()) for i, t in odd)
    assert byte_bpe.encode(df.limit(0), RANKS, P.PATTERN).count() == 0


def test_byte_bpe_round_trip_equals_encode_and_decode(docs, odd):
    df = docs(odd)
    once, chained = byte_bpe.round_trip(df, RANKS, P.PATTERN), byte_bpe.decode(byte_bpe.encode(df, RANKS, P.PATTERN), RANKS, P.PATTERN)
    assert once.schema == chained.schema
    assert sorted(map(repr, once.collect())) == sorted(map(repr, chained.collect()))


def test_byte_bpe_queries_take_one_worker_a_task(spark, tmp_path):
    import corpus_pipeline
    from partnerlens.llm import queries

    spark.createDataFrame([(1, "one two"), (2, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    op1 = queries.op1_byte_bpe(spark, str(tmp_path))
    stage = corpus_pipeline.tokens(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
    for found in (op1, stage):
        assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
        assert found.count() == 2


def test_token_counts_equal_the_library(library):
    some = texts(4000, seed=3)
    assert token_count.counter(WORDS).count(some) == [len(e.ids) for e in library.encode_batch(some, add_special_tokens=False)]


def test_token_count_table(spark, docs, odd, library):
    df = docs(odd)
    got = token_count.token_counts(df, WORDS, limit=6)
    want = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in odd]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(((*w, w[2] > 6) for w in want), key=repr)
    assert token_count.token_counts(df.limit(0), WORDS, 6).count() == 0


def test_encoder_in_stretches_equals_whole_texts(library):
    some = texts(4000, seed=4)
    code = id_store.Encoder(WORDS, 2, True)
    assert code.encode(some) == [packed([*e.ids, 2]) for e in library.encode_batch(some, add_special_tokens=False)]
    assert id_store.Encoder(WORDS, 2, False).encode(some[:50]) == code.encode(some[:50])


@pytest.mark.parametrize("n", [0, 1, 5, 511, 512, 513, 5000])
@pytest.mark.parametrize("most", [1, 2, 300, 50_000, 2**32])
def test_blocks_round_trip(n, most):
    random = np.random.default_rng(n + most)
    ids = random.integers(0, most, n, dtype=np.uint64).astype("<u4")
    if n > 600:
        ids[random.integers(0, n, n // 20)] = 2**32 - 1  # exceptions
    data, sizes = id_store.encode_blocks(ids)
    assert len(data) == sizes.sum()
    assert id_store.decode_blocks(data, np.cumsum(sizes) - sizes).tolist() == ids.tolist()


def test_outliers_are_exceptions():
    ids = np.full(512, 7, "<u4")
    plain = len(id_store.encode_blocks(ids)[0])
    ids[100] = 2**32 - 1
    assert len(id_store.encode_blocks(ids)[0]) == plain + 6


def test_shard_round_trip(tmp_path):
    random = np.random.default_rng(1)
    rows = [(k if k != 7 else None, random.integers(0, 49_000, int(n)).astype("<u4").tobytes()) for k, n in enumerate(random.integers(0, 900, 700))]
    rows.insert(50, (5000, random.integers(0, 49_000, 1_200_000).astype("<u4").tobytes()))
    shard = id_store.Shard(str(tmp_path), 0.9)
    for row in rows:
        shard.add(*row)
    path, n_docs, n_ids = shard.close()
    assert (n_docs, n_ids) == (len(rows), sum(len(x) // 4 for _, x in rows))
    assert [(i, ids) for i, _, ids in id_store.read_shard(path)] == rows


def test_id_files(spark, docs, odd, library):
    rows = odd + [(100 + k, f"document {k} " * (k % 50)) for k in range(300)]
    manifest = id_store.write_ids(docs(rows), id_store.new_folder(spark), WORDS, 2, cut_at_spaces=True, shard_ids=400)
    assert manifest.count() > 5
    got = sorted((r.start, r.doc_id, bytes(r.token_ids)) for r in id_store.read_ids(manifest).collect())
    want, start = [], 0
    for i, t in sorted(rows, key=lambda x: (-1 if x[0] is None else x[0], (x[1] or "").encode())):
        ids = packed([*library.encode(t or "", add_special_tokens=False).ids, 2])
        want.append((start, i, ids))
        start += len(ids) // 4
    assert got == want
    assert [zlib.crc32(x[2]) for x in got] == [zlib.crc32(x[2]) for x in want]
    assert id_store.read_ids(id_store.write_ids(docs([]), id_store.new_folder(spark), WORDS, 2)).count() == 0


def test_merging_looks_up_each_pair_once():
    """A merge changes two neighbours; no other pair is looked up again."""
    class Counted(dict):
        asked = 0

        def get(self, *key):
            Counted.asked += 1
            return super().get(*key)

    coder = byte_bpe.ByteBpe([bytes([i]) for i in range(256)] + [b"ab", b"abab", b"abababab"], r"\S+|\s+")
    coder.ranks = Counted(coder.ranks)
    assert coder.merged("ab" * 64) == ["abababab"] * 16
    assert Counted.asked <= 3 * 128


def test_longest_tokens_that_do_not_fit_are_stepped_back_from():
    """Every piece of few letters as its plain merges give it, also where the longest token is wrong."""
    coder = byte_bpe.ByteBpe([bytes([i]) for i in range(256)] + [b"bc", b"ab", b"bcd", b"abc", b"dab"], r"\S+|\s+")
    for n in range(1, 7):
        for letters in itertools.product("abcd", repeat=n):
            piece = "".join(letters)
            assert [coder.texts[i] for i in coder.encode_piece(piece)] == coder.merged(piece), piece


def test_byte_bpe_takes_longest_tokens_in_one_pass(reference):
    class Sole:  # an automaton that is asked for the longest tokens only
        def iter(self, piece):
            raise AssertionError("all matches are listed")

    class Wrong(Sole):
        def iter_long(self, piece):
            return iter([(0, (bpe.ranks[piece[0]], 1)), (len(piece) - 1, (bpe.ranks[piece[-1]], 1))])

    bpe = byte_bpe.ByteBpe(byte_bpe.read_ranks(RANKS), P.PATTERN)
    real = bpe.automaton
    words = [" shufflepartition", " toothbrushless", " dataframes"]
    expected = [packed(reference.encode_ordinary(w)) for w in words]
    bpe.automaton = Sole()
    bpe.automaton.iter_long = real.iter_long
    assert [packed(bpe.encode_piece(w)) for w in words] == expected
    bpe.automaton = Wrong()
    bpe.automaton.iter = real.iter
    assert [packed(bpe.encode_piece(w)) for w in words] == expected
