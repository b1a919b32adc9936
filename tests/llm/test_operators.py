"""Each operator against a brute-force version, and its defined results on odd input."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalytics.llm import (
    automata,
    chat_format,
    exact_dedup,
    jaccard_join,
    licence_scan,
    packing,
    quality,
    secrets,
    sentence_pieces,
    suffix_tree,
    url_filter,
)
from catalytics.llm.queries import tokenizer_file

SCHEMA = "doc_id long, text string, locator string, verdict string, masked string, n long, row long, n_chars long"
BASE = " ".join(f"word{i}" for i in range(60))
ODD = [None, "", " \t\n", "one", "one", "a b c", "A B C", "x" * 5000, BASE, BASE + " tail", "other " + BASE, BASE.upper(), "é " * 30 + "\r\n|", "token=abcdef12 done"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, "one"), (None, "no id"), (None, None)]
    return spark.createDataFrame([(i, t, "l", "v", "m", 1, 2, len(t or "")) for i, t in rows], SCHEMA).coalesce(1)


@pytest.fixture(scope="module")
def some(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def rows_of(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


# 1
def test_rules_and_propagation(spark):
    pages = [
        (1, "http://a.org/x", '<a href="http://b.net/">'),
        (2, "https://b.net/p?q", '<a href="http://c.net/1">x</a>'),
        (3, "http://c.net", ""),
        (4, "http://sub.example.org/es/1", None),
        (5, "http://farm.net/", '<a href=http://sub.example.org/es/1>'),
        (6, "http://EXAMPLE.org/en/12#f", None),
        (7, None, None),
        (8, "no url", "x"),
    ]
    got = {r.page_id: r for r in url_filter.judge(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert [got[i].rule for i in range(1, 9)] == ["org/", None, None, "example.org/es/", None, "example.org/en/1", None, None]
    assert [got[i].verdict for i in range(1, 9)] == ["allow", "allow", "allow", "block", "block", "block", "allow", "allow"]
    assert (got[7].host, got[7].path, got[6].host, got[6].path) == ("", "", "example.org", "/en/12")
    assert got[2].trust > got[3].trust > 0 and got[5].distrust > 0
    # power series of the seeds along the arcs
    seed, d = 1.0, url_filter.DAMPING
    assert math.isclose(got[2].trust, (1 - d) * d * seed) and math.isclose(got[3].trust, (1 - d) * d * d * seed)
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# 2
def test_words_are_dealt_into_partitions_of_bounded_size(spark, monkeypatch):
    v = sentence_pieces.load(tokenizer_file("piece_bpe_32k.model"))
    words = spark.createDataFrame([(f"▁{w}{i}",) for i in range(20) for w in ("the", "thndou")], "word string")
    whole = sorted(map(tuple, sentence_pieces.encoded_words(words, v).collect()))
    monkeypatch.setattr(sentence_pieces, "WORDS", 3)
    counts, lattice = [], sentence_pieces.lattice
    monkeypatch.setattr(sentence_pieces, "lattice", lambda dealt, v: counts.append(dealt.rdd.getNumPartitions()) or lattice(dealt, v))
    assert sorted(map(tuple, sentence_pieces.encoded_words(words, v).collect())) == whole and len(whole) == 40
    assert counts == [14]


def test_pieces_equal_the_library(spark, docs, some):
    import sentencepiece

    path = tokenizer_file("piece_bpe_32k.model")
    library, v = sentencepiece.SentencePieceProcessor(model_file=path), sentence_pieces.load(path)
    extra = spark.createDataFrame([(100 + i, t) for i, t in enumerate(["  two  blanks ", "日本 😀\x00", "aab" * 200, "====  ==", "<s> </s>"])], "doc_id long, text string")
    sample = docs.select("doc_id", "text").unionByName(extra).unionByName(some.filter("doc_id < 40").select("doc_id", "text"))
    got = sentence_pieces.encode(sample, v).withColumn("back", sentence_pieces.decode(F.col("ids"), v)).collect()
    assert len(got) == sample.count()
    assert all(library.encode(r.text) == r.ids and r.back == r.text for r in got)


# 3
def test_packing_round_trip(docs, some):
    from tokenizers import Tokenizer

    path = tokenizer_file("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    for frame in (docs.filter("doc_id is not null").dropDuplicates(["doc_id"]), some):
        got = packing.pack(frame, path, max_len=256).toPandas()
        assert got.sequence_id.is_unique and (got.length & (got.length - 1) == 0).all() and (got.offset == 0).all()
        for doc, text in rows_of(frame):
            mine = got[got.doc_id == doc].sort_values("start")
            ids = t.encode(text, add_special_tokens=False).ids + [packing.END_ID]
            assert np.concatenate(list(mine.ids)).tolist() == ids and (mine.doc_tokens == len(ids)).all()
            assert [zlib.crc32(np.asarray(i, "<u4").tobytes()) for i in mine.ids] == mine.ids_crc32.tolist()
    assert packing.pack(docs.limit(0), path).count() == 0
    assert packing.piece_lengths(4096 * 2 + 5) == [4096, 4096, 4, 1]
    odd = ["Don't <|endoftext|> İSTANBUL ΣΑΣ é ´x\x85y z\xa0w", "ÿ×÷ß 'S 's l'l"]
    assert [x.tolist() for x in packing.WordIds(path).encode(odd)] == [t.encode(x, add_special_tokens=False).ids for x in odd]


# 4
def test_suffix_tree_scores(some, monkeypatch):
    monkeypatch.setattr(suffix_tree, "FLUSH", 20_000)
    symbols = {i: t.encode().lower().split() + [b"\n"] for i, t in rows_of(some)}
    c = [collections.Counter() for _ in range(3)]
    for i, x in symbols.items():
        if not suffix_tree.held_out(i):
            for n in range(3):
                c[n].update(zip(*(x[k:] for k in range(n + 1)), strict=False))
    total, types, mu = sum(c[0].values()), len(c[0]), suffix_tree.MU

    def p(gram, out=0):
        if len(gram) == 1:
            return (c[0][gram] + 0.5) / (total + 0.5 * (types + 1))
        seen = c[len(gram) - 2][gram[:-1]]
        return (max(c[len(gram) - 1][gram] - out, 0) + mu * p(gram[1:], out)) / (max(seen - out, 0) + mu)

    gain = collections.Counter()
    for n in (1, 2):
        for gram, k in c[n].items():
            if c[n - 1][gram[:-1]] >= suffix_tree.MIN_COUNT:
                gain[gram[:-1]] += k * math.log2(p(gram, 1) / p(gram[1:], 1))
    got = suffix_tree.score(some).collect()
    assert len(got) == len(symbols)
    for r in got:
        x, want = symbols[r.doc_id], 0.0
        for k in range(len(x)):
            gram = next((g for n in (2, 1) if k >= n and gain[(g := tuple(x[k - n : k + 1]))[:-1]] >= suffix_tree.MIN_GAIN), (x[k],))
            want += math.log10(p(gram))
        assert math.isclose(r.score, want, rel_tol=1e-6, abs_tol=0.5)
        assert math.isclose(r.base_score, sum(math.log10(p((w,))) for w in x), rel_tol=1e-9)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(x), sum(c[0][(w,)] > 0 for w in x), total)


def test_suffix_tree_on_odd_input(docs):
    got = suffix_tree.score(docs).collect()
    assert len(got) == docs.count() and all(r.n_tokens >= 1 for r in got)
    assert suffix_tree.score(docs.limit(0)).count() == 0


# 5
def brute_components(rows):
    sets = {}
    for key, (_, text) in enumerate(rows):
        w = text.encode().lower().split()
        sets[key] = {tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set()
    root = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in range(a):
                x, y = sets[a], sets[b]
                if x and y and root[a] != root[b] and 100 * len(x & y) >= 85 * len(x | y):
                    root = [min(root[a], root[b]) if r in (root[a], root[b]) else r for r in root]
                    changed = True
    out = []
    for key, (doc, _) in enumerate(rows):
        ids = [rows[k][0] for k in sets if root[k] == root[key] and rows[k][0] is not None]
        out.append((doc, len(sets[key]), min(ids) if sets[key] and doc is not None else doc))
    return out


def test_jaccard_components(spark, docs):
    rng = np.random.default_rng(5)
    core = [f"w{i}" for i in range(80)]
    family = [(1000 + k, " ".join(w for w in core if rng.random() > rng.choice([0, 0.02, 0.06]))) for k in range(60)]
    frame = docs.select("doc_id", "text", "n").unionByName(spark.createDataFrame([(i, t, 0) for i, t in family], "doc_id long, text string, n long"))
    got = [tuple(r) for r in jaccard_join.link_components(frame).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(got, key=key) == sorted(brute_components(rows_of(frame)), key=key)


def test_jaccard_keeps_columns_and_empty_tables(docs):
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert jaccard_join.link_components(docs.limit(0)).count() == 0


# 6
def test_licences(spark, some):
    texts = [None, "", "nothing here", "x\nReleased under the MIT License.\ny", "Licensed under CC BY-NC 4.0.", "a license to drive under the sun"]
    frame = some.select("doc_id", "text").unionByName(spark.createDataFrame([(9000 + i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    got = {r.doc_id: r.licences for r in licence_scan.scan(frame).collect()}
    assert [got[9000 + i] for i in range(6)] == [[], [], [], ["mit"], ["cc"], []]
    lines = {"apache": "Licensed under the Apache License, Version 2.0.", "gpl": "GNU General Public License, version 3.", "mit": "Released under the MIT License.", "cc": "Licensed under CC BY-NC 4.0."}
    for doc, text in rows_of(some):
        assert got[doc] == sorted(k for k, x in lines.items() if x in text)
    words = licence_scan.anchors()
    for family in licence_scan.NOTICES:
        for pairs in licence_scan.notice_pairs(family):
            assert sum(not set(p.split()) & set(words) for p in pairs) < licence_scan.CONFIRMED * len(pairs)


# 7
def test_secrets(spark, docs, some):
    plain = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    texts = [(1, "é token=abcdef0123 AKIA" + "A" * 16), (2, "api_key: 'x'"), (3, None), (4, "see ghp_" + "aB3" * 12 + " ok"), (5, "a" * 30), (6, "SECRET  =  \"Zz/+==-12\"")]
    frame = some.select("doc_id", "text").unionByName(spark.createDataFrame([(9000 + i, t) for i, t in texts], "doc_id long, text string"))
    got = {r.doc_id: r for r in secrets.scan(frame).collect()}
    for doc, text in rows_of(frame):
        spans = [(m.start(), 0, m.end()) for m in plain.finditer(text) if len(m[2]) >= 6]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        joined = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(spans))
        assert got[doc].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert ",".join(x for x in got[doc].spans.split(",") if not x.startswith("format")) == joined
    assert got[9004].n_format == 1 and sum(r.n_format for r in got.values()) == 1
    masked = secrets.redact(docs)
    assert masked.columns == docs.columns and masked.count() == docs.count()
    assert masked.filter("doc_id = 13").first().text == "[secret] done"
    assert secrets.scan(docs.limit(0)).count() == 0


def test_automaton_accepts_what_it_learned():
    examples = [f"ab{i % 7}{i % 5}{i % 3}" for i in range(200)]
    model = automata.learn(examples)
    assert all(model.log2_likelihood(x) > -math.inf for x in examples)
    assert model.log2_likelihood("zz") == -math.inf
    for step, end in zip(model.steps, model.ends, strict=True):
        assert math.isclose(sum(2**p for _, p in step.values()) + 2**end, 1, abs_tol=1e-9)


# 8
@pytest.mark.parametrize("bits", [256, 4])
def test_exact_classes(docs, some, bits):
    frame = docs.select("doc_id", "text").unionByName(some.select("doc_id", "text"))
    rows, groups = rows_of(frame), collections.defaultdict(list)
    normal = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t)
    for i, t in rows:
        groups[normal(t)].append((-len(t), i is None, i))
    want = sorted((str(i), str(min(groups[normal(t)])[2]), len(groups[normal(t)])) for i, t in rows)
    got = exact_dedup.classes(frame, bits)[0].collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size) for r in got) == want
    assert sum(r.kept for r in got) == len(groups)


def test_exact_stream_goes_on(spark, tmp_path, docs):
    located, name = exact_dedup.located(docs)
    prints = exact_dedup.fingerprints(located, name)
    folder, checkpoint = f"{tmp_path}/in", f"{tmp_path}/state"
    prints.filter("doc_id < 5").write.parquet(folder)
    first = {r.digest: r.group_size for r in exact_dedup.run_stream(spark, folder, checkpoint, prints.schema).collect()}
    prints.filter("doc_id >= 5").write.mode("append").parquet(folder)
    both = {r.digest: r.group_size for r in exact_dedup.run_stream(spark, folder, checkpoint, prints.schema, 1).collect()}
    assert sum(first.values()) < sum(both.values()) == prints.filter("doc_id is not null").count()
    assert exact_dedup.keep_first(docs).columns == docs.columns and exact_dedup.keep_first(docs.limit(0)).count() == 0


# 9
def test_quality_statistics_and_verdicts(spark, docs, some):
    for _, text in rows_of(docs) + rows_of(some):
        s, words, lines = quality.statistics(text), text.encode().split(), text.split("\n")
        seen = collections.Counter(zip(words, words[1:], words[2:], strict=False))
        covered = {k + j for k, w in enumerate(zip(words, words[1:], words[2:], strict=False)) if seen[w] > 1 for j in range(3)}
        dup = sum(bool(x.encode().split()) and x in lines[:k] for k, x in enumerate(lines))
        assert (s["n_words"], s["n_dup_lines"], s["n_repeat_words"]) == (len(words), dup, len(covered))
        assert s["word_chars"] == sum(len(w.decode()) for w in words) and s["n_symbols"] == len(re.findall(r"[#*$%&|<>]", text))
    judged, name = quality.judge(docs)
    assert name != "verdict" and judged.columns[:-1] == docs.columns
    assert quality.keep_good(docs.limit(0)).count() == 0


def test_quality_against_labels(spark):
    folder = "/root/testdata/sf0.01"
    judged, name = quality.judge(spark.read.parquet(f"{folder}/documents.parquet"))
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    rows = judged.join(labels, "doc_id").filter(f"not {name}.base_failed").select("quality", f"{name}.kept").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.1 * len(bad)


# 10
def test_snapshots_collapse(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (2, 0, "user", "hi"), (3, 0, "user", "hi"), (3, 1, "assistant", "yo"), (4, 0, None, None), (5, 0, "user", "hi"), (5, 1, "assistant", "no"), (5, 1, "assistant", "no"), (None, 0, "user", "x")]
    rows += [(6, t, "user", f"t{t}") for t in range(1200)] + [(7, t, "user", f"t{t}") for t in range(1100)]
    got = {r.conv_id: r for r in chat_format.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert sorted(got) == [1, 4, 5, 6] and got[1].n_equal == 2 and got[5].n_turns == 2 and got[6].n_turns == 1200
    assert got[1].chat == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nyo<|im_end|>\n"
    assert got[6].chat.count("<|im_start|>") == 1200 and got[6].chat.index("t999") < got[6].chat.index("t1199")
    assert chat_format.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
