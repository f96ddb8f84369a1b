import random
import zlib

import numpy as np
import pytest

from shelfmark.llm import simple8b
from shelfmark.llm.packing import pack, packed
from shelfmark.llm.token_counts import RankMerger, token_counts
from shelfmark.llm.token_file import read_tokens, write_tokens

P = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

TEXTS = ["", None, "a", "it's I'll x'LL 'story \n\n a  b\n c   ", "<|endoftext|> hi <|startoftext|>x", "日本語 テスト 12３４ ½ ²", "x" * 50 + " " * 7,
         "é'té l'd", " 's 'll", "\r\n\r\n \t x", "ΣΑΣ ΟΔΟΣ İs", "ét", "🎉🎉 ok", "aaaaaaaa aaa", "q" * 3000, "word " * 3000]


def rows():
    r = random.Random(5)
    more = ["".join(r.choice("aAb'sltrevm \n.,!12éÉ日<|>") for _ in range(r.randint(0, 60))) for _ in range(300)]
    return [(i, t, "x", -1) for i, t in enumerate(TEXTS + more)] + [(None, "no id", "x", -1), (3, TEXTS[3], "x", -1)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), "doc_id long, text string, n_tokens string, start long").repartition(3)


def test_simple8b_round_trip_with_escapes_and_blocks():
    r = np.random.default_rng(0)
    for n in (0, 1, 255, 256, 257, 3000):
        for high in (1, 100, 50257, (1 << 64) - 1):
            v = r.integers(0, high, n, dtype=np.uint64, endpoint=True)
            v[r.random(n) < 0.5] //= np.uint64(9)
            words, offsets = simple8b.encode(v)
            assert (simple8b.decode(words, offsets, n) == v).all()
            for b in range(len(offsets)):
                assert (simple8b.decode_block(words, offsets, n, b) == v[b * 256:(b + 1) * 256]).all()
    words, _ = simple8b.encode(np.zeros(240, np.uint64))
    assert len(words) == 2


def test_token_file_is_the_library_in_doc_order(docs, spark, tmp_path):
    library = tokenizers.Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    path = f"file://{tmp_path}/tokens"
    write_tokens(docs, path, P.path("byte_bpe_50k.json"), end_id=0)
    got = read_tokens(spark, path).orderBy("start").collect()
    start, expected = 0, sorted(((-1 if i is None else i), t or "") for i, t, _, _ in rows())
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens) for r in got) == sorted((i, len(library.encode(t).ids) + 1) for i, t in expected)
    texts = dict(expected)
    for r in got:
        assert r.start == start and r.ids == library.encode(texts[-1 if r.doc_id is None else r.doc_id]).ids + [0]
        start += r.n_tokens
    assert [r.doc_id for r in got] == sorted([r.doc_id for r in got], key=lambda x: (x is not None, x or 0))
    digest = {r.start: r.ids_crc32 for r in read_tokens(spark, path, kind="digest").collect()}
    assert digest == {r.start: zlib.crc32(np.array(r.ids, "<u4")) for r in got}


def test_token_file_of_no_rows(spark, tmp_path):
    write_tokens(spark.createDataFrame([], "doc_id long, text string"), f"file://{tmp_path}/none", P.path("byte_bpe_50k.json"))
    assert read_tokens(spark, f"file://{tmp_path}/none").count() == 0


def test_counts_are_the_library(docs, spark):
    library = tokenizers.Tokenizer.from_file(P.path("word_bpe_49k.json"))
    got = token_counts(docs, P.path("word_bpe_49k.json"), limit=20).collect()
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 20) for i, t, _, _ in rows()]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert token_counts(docs.limit(0), P.path("word_bpe_49k.json")).count() == 0


def test_one_merge_at_a_time_where_a_later_symbol_ranks_lower():
    names = [chr(b) for b in range(33, 127)]
    model = {"vocab": {c: i for i, c in enumerate([*dict.fromkeys(__import__("shelfmark.llm.token_counts", fromlist=["x"])._byte_names()), "bc", "ab", "abc"])}, "merges": ["ab c", "a b", "b c"]}
    merger = RankMerger(model)
    assert names and not merger.together
    assert merger.counts([b"abc", b"ababc", b"", b"bcbc"]).tolist() == [1, 2, 0, 2]


def test_packing_places_every_id_once(docs, spark):
    library = tokenizers.Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = packed(docs, P.path("byte_bpe_50k.json"), length=64).collect()
    ids = [(i, library.encode(t or "").ids + [1]) for i, t, _, _ in rows()]
    assert sum(r.length for r in got) == sum(len(x) for _, x in ids)
    by_id = dict(ids)
    places, sequences = {}, {}
    for r in got:
        assert r.ids == by_id[r.doc_id][r.start:r.start + r.length] and r.doc_tokens == len(by_id[r.doc_id])
        places.setdefault(r.doc_id, []).append((r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, x in by_id.items():
        if i != 3:  # two equal rows
            at = 0
            for start, n in sorted(places[i]):
                assert start == at
                at += n
            assert at == len(x)
    short = 0
    for x in sequences.values():
        at = 0
        for offset, n in sorted(x):
            assert offset == at
            at += n
        short += at < 64
    assert short <= 1
    assert packed(docs.limit(0), P.path("byte_bpe_50k.json")).count() == 0


def test_a_seed_is_followed_by_its_nearest_neighbour():
    r = np.random.default_rng(1)
    topics = [np.arange(k * 100, k * 100 + 30) for k in range(6)]
    docs = [r.choice(topics[k % 6], 20) for k in range(12)]
    pieces = [p for p in pack(docs, length=40) if p[3] == 0]
    assert [p[0] for p in pieces] == [0, 6]


def thue_morse(n, letters):
    """A word and its complement: sums of products over their letters agree, whatever the factors."""
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


def test_built_words_keep_their_own_ids(spark, tmp_path):
    words = ["q" * 8 + thue_morse(4096, x) + "q" * 8 for x in ("ab", "ba")] + [thue_morse(1024, x) for x in ("xy", "yx")]
    library = tokenizers.Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    docs = spark.createDataFrame(list(enumerate(words)), "doc_id long, text string").coalesce(1)
    write_tokens(docs, f"file://{tmp_path}/t", P.path("byte_bpe_50k.json"), end_id=0)
    assert {r.doc_id: r.ids[:-1] for r in read_tokens(spark, f"file://{tmp_path}/t").collect()} == {i: library.encode(w).ids for i, w in enumerate(words)}
    counts = tokenizers.Tokenizer.from_file(P.path("word_bpe_49k.json"))
    got = {r.doc_id: r.n_tokens for r in token_counts(docs, P.path("word_bpe_49k.json"), limit=2048).collect()}
    assert got == {i: len(counts.encode(w, add_special_tokens=False).ids) for i, w in enumerate(words)}


def test_a_pre_token_is_compared_whole(monkeypatch):
    from shelfmark.llm import pretokens

    monkeypatch.setattr(pretokens, "span_hashes", lambda data, starts, ends: np.full(len(starts), 7, np.uint64))
    texts = [b"a" * 10 + bytes([c]) * 20 + b"z" * 10 for c in b"xy"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    memo = pretokens.Memo(lambda words: (np.ones(len(words), np.int64), np.array([w[15] for w in words], np.int32)))
    entry, other = memo.look_up(data, np.array([0, 40, 0]), np.array([40, 80, 40]))
    assert other.tolist() == [False, True, False] and memo.gather(entry[:1]).tolist() == [ord("x")]


def test_new_pre_tokens_reach_the_library_many_to_a_text():
    from shelfmark.llm.byte_ids import ByteIds

    encoder, texts = ByteIds(P.path("byte_bpe_50k.json")), []
    merger = encoder.merger

    class Counted:
        def encode_batch_fast(self, batch, **more):
            texts.extend(batch)
            return merger.encode_batch_fast(batch, **more)

    encoder.merger = Counted()
    words = [f" w{k:x}é".encode() for k in range(700)] + ["\n\n ".encode(), "日本語".encode(), b" " * 9, b"q" * 3000, "🎉ÿ\x00\x7f­".encode(), b"'ll"]
    lengths, ids = encoder._encode(words)
    assert len(texts) < 20
    expected = [encoder.library.encode(w.decode(), add_special_tokens=False).ids for w in words]
    whole = [w for w, x in zip(words, expected) if len(encoder.library.encode(w.decode()).word_ids) and set(encoder.library.encode(w.decode()).word_ids) == {0}]
    at = np.cumsum(lengths) - lengths
    got = {w: ids[a:a + n].tolist() for w, a, n in zip(words, at, lengths)}
    assert sum(lengths) == len(ids) and whole and all(got[w] == expected[words.index(w)] for w in whole)


def test_a_full_memo_starts_again_with_the_same_values():
    from shelfmark.llm.pretokens import Memo

    memo = Memo(lambda words: (np.array([len(w) for w in words]), np.frombuffer(b"".join(words), np.uint8).astype(np.int32)), bits=6)
    r = random.Random(2)
    for n in (30, 30, 5, 200, 30, 0):
        words = ["".join(r.choice("abé") for _ in range(r.randint(1, 30))).encode() for _ in range(n)]
        sizes = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(sizes)
        entry, other = memo.look_up(np.frombuffer(b"".join(words), np.uint8), ends - sizes, ends)
        assert not other.any() and memo.gather(entry).tolist() == list(b"".join(words))
