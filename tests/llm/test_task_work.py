"""What one task of the operators computes and keeps: word hashes, shingle sets, sums by key."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from catalytics.llm import common, jaccard_join, packing, piece_lattice, sentence_pieces, suffix_tree
from catalytics.llm.queries import tokenizer_file

RNG = random.Random(3)
TEXTS = ["".join(RNG.choices(" \t\n\x0b\x0c\rabcABÉé\x85_1", k=RNG.choice([0, 1, 2, 3, 10, 60]))) for _ in range(400)]
TEXTS += ["", " ", "x" * 200_000, "X" * 200_000 + " y", "one", "a B c", "ab ba", "é" * 40 + " " + "É" * 40]


# 4, 5
def test_word_hashes_tell_words_apart():
    words = [t.encode().lower().split() for t in TEXTS]
    hashes, counts = common.word_hashes(pa.array(TEXTS))
    assert counts.tolist() == [len(w) for w in words]
    flat = [w for some in words for w in some]
    number, word = dict(zip(flat, hashes.tolist(), strict=True)), dict(zip(hashes.tolist(), flat, strict=True))
    assert [number[w] for w in flat] == hashes.tolist() and [word[h] for h in hashes.tolist()] == flat and 0 not in word
    # a slice, another type and one long text give the same numbers
    assert [number[w] for some in words[100:150] for w in some] == common.word_hashes(pa.array(TEXTS, pa.large_string()).slice(100, 50))[0].tolist()
    whole = common.word_hashes(pa.array([" ".join(TEXTS * 2)]))
    assert whole[0].tolist() == [number[w] for w in flat * 2] and whole[1].tolist() == [2 * len(flat)]
    assert [len(x) for x in common.word_hashes(pa.array([], pa.string()))] == [0, 0]


def test_word_hashes_keep_nothing():
    def run(k):
        return common.word_hashes(pa.array([" ".join(f"w{i}_{k}" for i in range(100_000))]))[0].sum()

    run(0)
    tracemalloc.start()
    for k in range(1, 4):
        run(k)
    kept = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert kept < 1e6


# 5
def test_shingle_sets():
    got = jaccard_join.shingle_sets(pa.array(TEXTS))
    seen = {}
    for text, found in zip(TEXTS, got, strict=True):
        w = text.encode().lower().split()
        want = {tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set()
        assert len(found) == len(want) and (found[1:] > found[:-1]).all()
        seen.setdefault(frozenset(want), found.tobytes())
        assert seen[frozenset(want)] == found.tobytes()
    assert len(set(seen.values())) == len(seen)
    assert len(set().union(*[x.tolist() for x in got])) == len(set().union(*seen))
    assert jaccard_join.shingle_sets(pa.array([], pa.string())) == []


# 3
def test_remembered_chunks_are_bounded():
    words = packing.WordIds(tokenizer_file("word_bpe_49k.json"))
    for k in range(3):
        words.encode([" ".join(f"{i}{'abc'[k]}" for i in range(130_000))])
        assert len(words.chunks) <= 261_000
    assert words.encode(["1a 2b"])[0].tolist() == words.tokenizer.encode("1a 2b", add_special_tokens=False).ids


# 3
def test_a_job_may_remember_less():
    assert corpus_pipeline.REMEMBERED < packing.REMEMBERED
    path, texts = tokenizer_file("word_bpe_49k.json"), [" ".join(f"{i}{'abc'[k % 3]} Ab{i % 7}" for i in range(1_000)) for k in range(6)]
    few, many = packing.word_ids(path, 500), packing.word_ids(path)
    for text in texts:
        assert few.encode([text])[0].tolist() == many.encode([text])[0].tolist()
        assert len(few.chunks) <= 500 + 1_008 and len(few.words) <= 500 + 1_008
    assert len(many.chunks) >= 3_000 and few is packing.word_ids(path, 500)


# 4
def test_sums_by_key(monkeypatch):
    rng = np.random.default_rng(4)
    random_keys = rng.integers(0, 2**64, 5_000, np.uint64)
    near = np.uint64(7 << 60) + rng.integers(0, 50, 5_000, np.uint64)  # agree in their high bits
    for keys in (random_keys, near, np.repeat(random_keys[:50], 100), random_keys[:0]):
        order, ordered = suffix_tree._sorted(keys)
        assert (ordered == np.sort(keys)).all() and (keys[order] == ordered).all() and len(set(order.tolist())) == len(keys)
    # random keys need no argsort; the words of a chunk are summed without sorting every symbol
    monkeypatch.setattr(np, "argsort", lambda *_: 1 / 0)
    places, values = rng.integers(0, 5_000, 40_000), rng.integers(0, 2, 40_000)
    words = suffix_tree._Words(random_keys, places, values)
    plain = suffix_tree._Keys(random_keys[places], values, np.ones(40_000, bool))
    total = words.spread(words.sums, 40_000)
    assert (total == plain.spread(plain.sums, 40_000)).all() and (words.keys == np.sort(random_keys)).all()


# 2
@pytest.fixture(scope="module")
def model():
    import sentencepiece

    path = tokenizer_file("piece_bpe_32k.model")
    v = sentencepiece.SentencePieceProcessor(model_file=path), sentence_pieces.load(path)
    return *v, piece_lattice.pieces_of(v[1].pieces, len(v[1].hex_of), v[1].longest, v[1].first_byte)


def ids_of(words, texts):
    ids, n = words.texts(texts, sentence_pieces.MARK)
    return [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]


WHOLE_TEXTS = ["", " ", "  two  blanks ", "▁▁ a ▁b", "日本 😀\x00 é", "a\nb\tc  ", "aab" * 200, "x" * 3000, " " * 300 + "=" * 300]
WORDY = random.Random(5)
WHOLE_TEXTS += ["".join(WORDY.choices("  theandouringly.,AÉß日😀=▁", k=WORDY.choice([3, 40, 900]))) for _ in range(150)]


@pytest.mark.parametrize("few, walked, block", [(24, 1 << 12, 1 << 18), (1, 1 << 12, 1 << 18), (10**9, 40, 1 << 18), (10**9, 7, 64), (3, 20, 100)])
def test_folds_equal_the_library(model, monkeypatch, few, walked, block):
    """All lanes at once, word by word, and long words in stretches."""
    for name, value in (("FEW", few), ("WALKED", walked), ("BLOCK", block)):
        monkeypatch.setattr(piece_lattice, name, value)
    library, _, pieces = model
    want = [library.encode(t) for t in WHOLE_TEXTS]
    assert ids_of(piece_lattice.Words(pieces), pa.array(WHOLE_TEXTS)) == want
    sliced = pa.array(["other", *WHOLE_TEXTS, "texts"], pa.large_string()).slice(1, len(WHOLE_TEXTS))
    assert ids_of(piece_lattice.Words(pieces), sliced) == want


def test_words_are_remembered_up_to_a_bound(model):
    library, _, pieces = model
    for remembered in (0, 300, 10**6):
        words, most = piece_lattice.Words(pieces, remembered), 0
        for at in range(0, len(WHOLE_TEXTS), 10):
            some = WHOLE_TEXTS[at : at + 10]
            before = len(words.flat)
            assert ids_of(words, pa.array(some)) == [library.encode(t) for t in some]
            most = max(most, before)
            assert before <= remembered or len(words.flat) <= sum(map(len, map(library.encode, some)))
            assert len(words.known) == len(set(words.known.to_pylist())) == len(words.counts)
    assert ids_of(piece_lattice.Words(pieces), pa.array([""])) == [[]] and most > 0


def test_texts_are_taken_by_bytes(monkeypatch):
    monkeypatch.setattr(sentence_pieces, "TEXT", 10)
    batch = pa.record_batch({"id": list(range(6)), "text": ["é" * 4, "a", "", "x" * 50, "b" * 10, "c"]})
    assert [b.column(0).to_pylist() for b in sentence_pieces.by_bytes(batch, 1)] == [[0, 1, 2], [3], [4], [5]]


def test_encoding_moves_no_rows(spark, model):
    """No word occurrence is shuffled or written: the texts stay where they are."""
    library, v, _ = model
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(WHOLE_TEXTS[:40])] + [(None, None), (3, None)], "doc_id long, text string")
    encoded = sentence_pieces.encode(docs.repartition(3), v)
    plan = encoded._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan.split("MapInArrow")[0] for x in ("Exchange", "Join", "Aggregate")) and plan.count("Exchange") == 1
    got = encoded.withColumn("back", sentence_pieces.decode(F.col("ids"), v)).collect()
    assert len(got) == 42 and all(r.ids == library.encode(r.text) for r in got)
    assert [r.back for r in got if "▁" not in r.text] == [r.text for r in got if "▁" not in r.text]
    odd = spark.sql("SELECT 1L AS doc_id, cast(X'41EDA0804220FF42' AS string) AS text")
    assert sentence_pieces.encode(odd, v).first().ids == library.encode("A\ufffdB \ufffdB")
