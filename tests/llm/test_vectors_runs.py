"""Operators 11 to 13 against brute force, and their defined results on odd input."""

import hashlib
import math
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from catalytics.llm import near_vectors, periodic_runs, queries, vector_codes

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int, row int, links int, space string, code string, part string"


def made_vectors(spark, rows):
    return spark.createDataFrame([(i, v, lab, 1, 2, "s", "c", "p") for i, v, lab in rows], VECTORS)


# 11
def lloyd(rows, parts, entries, rounds):
    """Plain rounds over (id, vector) lists: ids, codes, errors, codebooks."""
    v = np.array([[math.floor(256 * x) for x in row] for _, row in rows]).reshape(len(rows), parts, -1)
    order = sorted(range(len(rows)), key=lambda i: rows[i][0])
    books = [[list(v[i, p]) for i in order[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((int(a) - int(b)) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for x in v[:, p]:
                members.setdefault(nearest(p, x)[1], []).append(x)
            for e, own in members.items():
                books[p][e] = [int(sum(int(x[k]) for x in own) // len(own)) for k in range(v.shape[2])]
    best = [[nearest(p, x[p]) for p in range(parts)] for x in v]
    codes = {rows[i][0]: ("".join(f"{e:02x}" for _, e in b), sum(d for d, _ in b)) for i, b in enumerate(best)}
    return codes, hashlib.sha256(",".join(str(x) for book in books for c in book for x in c).encode()).hexdigest()


@pytest.mark.parametrize(("parts", "entries", "rounds", "owner"), [(16, 64, 2, 100_000), (4, 5, 3, 7), (2, 256, 1, 10)])
def test_codes(spark, parts, entries, rounds, owner):
    rng = np.random.default_rng(parts)
    rows = [(int(i), [float(x) for x in np.float32(rng.normal(size=32) * (1 + i % 3))], int(i % 3)) for i in rng.permutation(150)]
    rows += [(200 + i, rows[0][1], 1) for i in range(60)]  # one value again and again
    coded, books = vector_codes.compress(made_vectors(spark, rows).repartition(3), parts=parts, entries=entries, rounds=rounds, owner=owner)
    codes, digest = lloyd([(i, v) for i, v, _ in rows], parts, entries, rounds)
    assert {r.id: (r.code, r.error) for r in coded.collect()} == codes
    assert vector_codes.digest(books) == digest


def test_only_changed_parts_migrate(spark):
    rows = spark.createDataFrame([(i, [i % 7, i % 5, i, -i]) for i in range(50)], "row long, v array<int>")
    first = np.array([[[0, 0], [3, 3]], [[0, 0], [20, -20]]])
    dealt = [r for b in rows.coalesce(1).toArrow().to_batches() for r in vector_codes._first_owners(first)([b])]
    books = np.array([[[0, 0], [2, 2]], [[0, 0], [40, -40]]])
    stay = [r for x in vector_codes._judged(books, True)(dealt) for r in x.to_pylist()]
    gone = [r for x in vector_codes._judged(books, False)(dealt) for r in x.to_pylist()]
    assert len(stay) + len(gone) == 100 and 0 < len(gone) < len(stay)
    before = {(r["row"], r["position"]): r["entry"] for x in dealt for r in x.to_pylist()}
    assert all(before[r["row"], r["position"]] == r["entry"] for r in stay)
    assert all(before[r["row"], r["position"]] != r["entry"] for r in gone)


def test_codes_of_odd_rows(spark):
    good = [0.5] * 16
    odd = [(1, None, 1), (2, [], 1), (3, [0.1] * 15, 1), (4, [*good[1:], None], 1), (5, [*good[1:], math.nan], 1), (6, [*good[1:], math.inf], 1), (7, [*good[1:], 1e30], 1)]
    rows = [*odd, (8, good, None), (8, good, None), (9, [-0.001] * 16, 2), (None, [0.7] * 16, None), (10, [0.1] * 32, 3)]
    coded, books = vector_codes.compress(made_vectors(spark, rows))
    got = sorted((r.id or 99, r.code, r.error, r.label_error) for r in vector_codes.label_errors(coded).collect())
    assert [g[0] for g in got] == [8, 8, 9, 99] and got[0] == got[1] and {g[3] for g in got} == {0}
    assert books.shape == (16, 4, 1) and books[0, :, 0].tolist() == [128, 128, -1, 179] and [g[1][:2] for g in got] == ["00", "00", "02", "03"]
    empty, books = vector_codes.compress(made_vectors(spark, []))
    assert empty.columns == ["id", "label", "code", "error"] and empty.count() == 0 and books.size == 0


def test_codes_drop_rows_as_the_sql_does(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = [(int(i), [float(x) for x in np.float32(rng.normal(size=32))], int(i % 4) if i % 5 else None) for i in range(120)]
    rows += [(-1, None, 1), (-2, [*rows[0][1][1:], None], 2), (-3, [*rows[0][1][1:], math.nan], 2), (-4, [*rows[0][1][1:], -math.inf], 2)]
    made_vectors(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    got = queries.QUERIES["op11_vector_codes"](spark, str(tmp_path))
    want = con.execute(queries.ORACLE_SQL["op11_vector_codes"])
    names = [d[0] for d in want.description]
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(want.fetchall())


# 12
def linked(rows, threshold):
    """(id -> number of links, smallest id reachable) by all pairs."""
    able = [(i, np.array(v, float), lab) for i, v, lab in rows if v and lab is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    to = {i: [] for i, _, _ in rows}
    for n, (a, v, lab) in enumerate(able):
        for b, w, other in able[n + 1 :]:
            if lab == other and len(v) == len(w) and v @ w / math.sqrt((v @ v) * (w @ w)) >= threshold:
                to[a].append(b)
                to[b].append(a)
    out = {}
    for i in to:
        seen, todo = {i}, [i]
        while todo:
            for j in to[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out[i] = (len(to[i]), min(seen))
    return out


@pytest.mark.parametrize(("room", "spread"), [(1024, 0.2), (40, 0.2), (25, 1.0)])
def test_links(spark, room, spread):
    rng = np.random.default_rng(room)
    centres = rng.normal(size=(6, 12))
    rows = []
    for i in range(240):
        v = centres[i % 6] + spread * rng.normal(size=12)
        rows.append((int(900 - i), [float(x) for x in np.float32(v * (1 + i % 3))], 0 if i % 3 else 1))
    rows += [(1000 + i, rows[5][1], rows[5][2]) for i in range(80)]  # a third are copies
    rows += [(2000, [2 * x for x in rows[5][1]], rows[5][2])]
    want = linked(rows, near_vectors.THRESHOLD)
    got = near_vectors.link_vectors(made_vectors(spark, rows).repartition(4), room=room).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want and len(got) == len(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert sum(n for n, _ in want.values()) > 6000


def test_links_of_odd_rows(spark):
    v = [1.0, 2.0]
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [1.0, math.nan], 1), (6, [math.inf, 1.0], 1), (7, v, None), (8, v, None)]
    rows += [(10, v, 2), (11, v, 3), (13, [1e30, 2e30], 4), (12, [1e-30, 2e-30], 4), (14, [1.0, 2.0, 0.0], 4), (15, [-1.0, -2.0], 4)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors.link_vectors(made_vectors(spark, rows)).collect()}
    assert {i for i, r in got.items() if r[0]} == {12, 13} and got[13] == (1, 12, False) and got[12] == (1, 12, True)
    assert all(got[i] == (0, i, True) for i in got if i not in (12, 13)) and len(got) == len(rows)
    again = near_vectors.link_vectors(made_vectors(spark, [(1, v, 1), (1, v, 1), (None, v, 1), (None, [0.0], 1)])).collect()
    assert sorted((r.n_links, r.component_id or 0, r.kept) for r in again) == [(0, 0, True), (2, 1, False), (2, 1, True), (2, 1, True)]
    assert near_vectors.link_vectors(made_vectors(spark, [])).count() == 0


def test_boundaries_keep_every_link():
    rng = np.random.default_rng(1)
    u = rng.normal(size=(400, 4))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    radius = math.sqrt(2 - 2 * 0.93)
    home, near = near_vectors.cells(u, u[:8], radius)
    a, b = np.nonzero(np.triu(u @ u.T >= 0.93, 1))
    assert ((home[a] == home[b]) | (near[a, home[b]] & near[b, home[a]])).all()
    assert near.mean() < 0.5  # and leaves most of the others out


# 13
def runs_by_definition(words):
    """Equal words q apart, for every q; a period is smallest if no smaller one repeats the stretch."""
    codes = np.unique(words, return_inverse=True)[1] if words else np.array([], int)
    out, n = [], len(codes)
    for q in range(1, n // 4 + 1):
        equal = np.concatenate([[False], codes[:-q] == codes[q:], [False]])
        turns = np.flatnonzero(equal[1:] != equal[:-1]).tolist()
        for i, j in zip(turns[::2], turns[1::2], strict=True):
            length = j + q - i
            if length >= max(6, 4 * q) and not any((codes[i : i + length - d] == codes[i + d : i + length]).all() for d in range(1, q)):
                out.append((i, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_by_definition():
    rng = random.Random(7)
    for _ in range(1500):
        size = rng.choice([1, 2, 3, 30])
        words = [str(rng.randrange(size)) for _ in range(rng.randrange(45))]
        for _ in range(rng.randrange(3)):
            again = [str(rng.randrange(size)) for _ in range(rng.randrange(1, 7))] * rng.randrange(2, 8)
            at = rng.randrange(len(words) + 1)
            words[at:at] = again[: rng.randrange(1, len(again) + 1)]
        assert list(map(tuple, periodic_runs.find_runs(words).tolist())) == runs_by_definition(words)


def test_all_repetitions_of_twice_the_period():
    found = periodic_runs.runs_of([1, 1, 2, 1, 1, 2, 1, 1, 3, 3])  # "aabaabaacc"
    assert found.tolist() == [[0, 2, 1], [0, 8, 3], [3, 2, 1], [6, 2, 1], [8, 2, 1]]
    assert periodic_runs.runs_of([]).tolist() == periodic_runs.runs_of([1]).tolist() == []


def test_very_long_text():
    words = [str(i * i % 1009) for i in range(30_000)] + ["a", "b", "c"] * 20_000
    runs = periodic_runs.find_runs(words)
    assert [30_000, 60_000, 3] in runs.tolist()
    assert [0, 30_000, 1009] in [[s, n, q] for s, n, q in runs.tolist() if q == 1009]


def test_runs_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in queries.QUERIES["op13_periodic_runs"](spark, SF).collect()}
    assert len(got) == len(rows)
    planted = 0
    for r in rows:
        words = (r.text or "").encode().split()
        h, n = zlib.crc32(str(r.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = runs_by_definition(words)
        planted += bool(found)
        one = got[r.doc_id]
        best = min(found, key=lambda x: (-x[1], x[0], x[2]), default=(None,) * 3)
        milli = best[1] and 1000 * best[1] // best[2]
        assert (one.n_runs, one.start, one.length, one.period, one.exponent_milli) == (len(found), *best, milli)
        assert one.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest()
        held = {i for s, n, q in found for i in range(s + q, s + n)}
        assert one.collapsed_sha256 == hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in held)).hexdigest()
    assert planted > 5


def test_runs_of_odd_rows(spark):
    texts = [None, "", " \t\n", "a", "a a a a a a", "a a a a a a", "é é " * 7, "x " * 100_000, "no run here"]
    rows = [(i, t, "r", "c", 1) for i, t in enumerate(texts)] + [(None, "b b b b b b", "r", "c", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, runs string, collapsed string, n_words int")
    got = {r.doc_id: ([tuple(x) for x in r.runs], r.collapsed, r.n_words) for r in periodic_runs.scan(frame).collect()}
    assert [got[i] for i in range(4)] == [([], "", 0)] * 3 + [([], "a", 1)]
    assert got[4] == got[5] == ([(0, 6, 1)], "a", 6) and got[None] == ([(0, 6, 1)], "b", 6)
    assert got[6] == ([(0, 7, 1)], "é é", 7) and got[7] == ([(0, 100_000, 1)], "x", 100_000) and got[8][0] == []
    assert periodic_runs.scan(frame.limit(0)).count() == 0
    ties = periodic_runs.scan(spark.createDataFrame([(1, "a a a a a a z b b b b b b")], "doc_id long, text string"))
    assert ties.select(F.struct(periodic_runs.longest()).alias("r")).first().r[0].start == 0
