"""N-gram Jaccard self-join through a token-group matrix (operator 5).

A document's set is its distinct 4-word shingles (64-bit hashes); two documents link
when 100 * intersection >= 85 * union.  The answer is exact: every step below only
drops what provably has no link, and links are confirmed on the whole sets.

1. Sets.  Equal sets get one representative (a 128-bit digest of the sorted set).
2. Prune.  If x links to y, it shares at least o = ceil(.85 |x|) shingles with it, so
   the first |x| - o + k shingles of both in hash order share k.  With k about .15 |x|
   each task sends those shingles, packed by hash range, and a set stays when enough
   of them occur in another set.  Shingles that a task already sees twice travel once,
   so a shingle of a third of all documents sends a row per task, not per document.
3. Groups.  Similar sets are partitioned into groups: each set meets the leader of its
   four minimum-hash classes (the most shared member), confirmed links are followed,
   and a component is a group.  Thousands of near copies cost a comparison or four
   each, not one per pair.
4. Matrix.  The union of each group's shingles gives rows (shingle, group), and a bitmap
   of WORDS longs.  A set asks the other groups that hold one of its rarest shingles and
   a member of its own size or more; bits of the set that are missing in the group's
   bitmap bound its overlap with every member.
5. Open.  Only groups whose bound is high enough are opened; each member's size and
   bitmap bound the overlap again, and what is left is compared in full.  Pairs inside
   a group are never listed: they are connected already.

Defined results: a null, empty or blank text has an empty set and no link; fewer than
four words are one shingle.  A null doc_id is never linked.  Repeated rows are equal
sets.  Only id and text are read.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalytics.llm.common import cut_lineage, mix, pack, parts, settings, small_batches, text_or_empty, unpack, word_hashes
from catalytics.llm.components import components
from catalytics.llm.exact_dedup import located

WIDTH = 4
NUMERATOR, DENOMINATOR = 85, 100
#: Shingles that a task gathers before it sends them.
FLUSH = 1_500_000
#: Hash ranges for each shuffle partition.
RANGES = 3
ODD = np.uint64(0x9E3779B97F4A7C15)
#: Longs of a set's bitmap.
WORDS = 16
#: Minimum-hash classes in which a set meets a leader.
MEETINGS = 4


def shingle_sets(texts: pa.Array, width: int = WIDTH) -> list[np.ndarray]:
    """Of each text the sorted distinct hashes of its word windows."""
    words, counts = word_hashes(texts)
    first = np.cumsum(counts) - counts
    sizes = np.minimum(counts, width)
    windows = counts - sizes + (counts > 0)
    cuts = np.r_[0, np.cumsum(windows)]
    size = np.repeat(sizes, windows)
    at = np.arange(cuts[-1]) + np.repeat(first - cuts[:-1], windows)
    h = size.astype(np.uint64)
    for i in range(width):
        longer = size > i
        if longer.all():
            h = mix(h, words[at + i])
        else:
            h[longer] = mix(h[longer], words[at[longer] + i])
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        h[low:high].sort()
    new = np.r_[True, h[1:] != h[:-1]][: len(h)]
    new[cuts[:-1][windows > 0]] = True
    cuts = np.r_[0, np.cumsum(new)][cuts]
    h = h[new]
    return [h[low:high] for low, high in zip(cuts[:-1], cuts[1:], strict=True)]


def overlap_needed(n):
    """Least overlap with any partner of a set of ``n``: ceil(.85 n)."""
    return -(-NUMERATOR * n // DENOMINATOR)


def extra(n):
    """k: how many shared shingles the sent prefix must show (grows with n)."""
    return 15 * n // 100 + 1


def sent_prefix(n):
    return np.minimum(n, n - overlap_needed(n) + extra(n))


def least_shared(n):
    """Shared shingles a set of ``n`` shows at least when its partner, which may be as
    small as .85 n, sends its own prefix."""
    return np.minimum(extra(overlap_needed(n)), overlap_needed(n))


def _digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def _key(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


#: Rows of an Arrow batch of packed sets: two of the largest sets to a row must fit a worker.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "128"}


def _source(docs: DataFrame, *more: str) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"), *more)


def set_rows(docs: DataFrame, with_tokens: bool = False, locator: str | None = None) -> DataFrame:
    """doc_id, n, digest, set_key; with_tokens: also the packed set; locator: also that column, as ``place``."""

    def run(batches):
        for batch in small_batches(batches):
            sets = shingle_sets(batch.column(1))
            digests = [_digest(s) for s in sets]
            columns = {
                "doc_id": batch.column(0),
                "n": pa.array([len(s) for s in sets], pa.int64()),
                "digest": pa.array(digests, pa.binary()),
                "set_key": pa.array([_key(d) for d in digests], pa.int64()),
            }
            if with_tokens:
                columns["tokens"] = pa.array([s.tobytes() for s in sets], pa.binary())
            if locator:
                columns["place"] = batch.column(2)
            yield pa.RecordBatch.from_pydict(columns)

    kinds = "doc_id long, n long, digest binary, set_key long" + ", tokens binary" * with_tokens
    if locator:
        kinds += f", place {docs.schema[locator].dataType.simpleString()}"
    return _source(docs, *[locator] * bool(locator)).mapInArrow(run, kinds)


SENT = "bucket int, tokens binary, holders binary, seen binary, counts binary"


def _sent(docs: DataFrame, ranges: int) -> DataFrame:
    """Prefix shingles by hash range: those seen in one set here with its key as holder,
    others with holder 0; and per set how many of its own were seen in another set here."""

    def flush(sets: dict[int, np.ndarray]):
        if not sets:
            return
        keys = np.fromiter(sets, np.int64, len(sets))
        sizes = np.fromiter(map(len, sets.values()), np.int64, len(sets))
        tokens, holders = np.concatenate(list(sets.values())), np.repeat(keys, sizes)
        order = np.argsort(tokens)
        tokens, holders = tokens[order], holders[order]
        first = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]])
        times = np.diff(np.r_[first, len(tokens)])
        shared = np.repeat(times > 1, times)
        seen, counts = np.unique(holders[shared], return_counts=True)
        tokens, holders = tokens[first], np.where(times > 1, 0, holders[first])
        cuts = np.searchsorted(tokens, np.arange(ranges, dtype=np.uint64) * np.uint64(2**64 // ranges))
        cuts = np.r_[cuts, len(tokens)]
        for b in range(ranges):
            at = slice(cuts[b], cuts[b + 1])
            mine = slice(len(seen) * b // ranges, len(seen) * (b + 1) // ranges)
            if at.stop > at.start or mine.stop > mine.start:
                yield b, pack(tokens[at]), pack(holders[at]), pack(seen[mine]), pack(counts[mine])

    def run(batches):
        sets, size = {}, 0
        names = ["bucket", "tokens", "holders", "seen", "counts"]

        def out():
            for row in flush(sets):
                yield pa.RecordBatch.from_pydict(
                    dict(zip(names, [pa.array([row[0]], pa.int32()), *(pa.array([x], pa.binary()) for x in row[1:])], strict=True))
                )

        for batch in small_batches(batches):
            for tokens in shingle_sets(batch.column(1)):
                if not len(tokens):
                    continue
                key = _key(_digest(tokens))
                if key not in sets:
                    # a prefix holds small hashes; times an odd number they fill all ranges alike
                    sets[key] = tokens[: sent_prefix(len(tokens))] * ODD
                    size += len(sets[key])
                if size >= FLUSH:
                    yield from out()
                    sets, size = {}, 0
        yield from out()

    return _source(docs).mapInArrow(run, SENT)


def _held_by_others(tokens: np.ndarray, holders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per holder, how many of its tokens have another holder (0 stands for several)."""
    if not len(tokens):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.lexsort((holders, tokens))
    t, h = tokens[order], holders[order]
    new = np.r_[True, (t[1:] != t[:-1]) | (h[1:] != h[:-1])]
    t, h = t[new], h[new]
    first = np.flatnonzero(np.r_[True, t[1:] != t[:-1]])
    times = np.diff(np.r_[first, len(t)])
    # 0 beside the holder counts as another one, as it should
    own, n = np.unique(h[np.repeat(times > 1, times) & (h != 0)], return_counts=True)
    return own, n.astype(np.int64)


def _shared_counts(sent: DataFrame) -> DataFrame:
    """(set_key, shared): how many sent shingles of a set occur in another set (or more)."""

    def run(table: pa.Table) -> pa.Table:
        arrays = lambda name, kind: [unpack(x, kind) for x in table.column(name).to_pylist()]
        tokens, holders = arrays("tokens", np.uint64), arrays("holders", np.int64)
        seen, counts = arrays("seen", np.int64), arrays("counts", np.int64)
        t, h = np.concatenate(tokens), np.concatenate(holders)
        own, n = _held_by_others(t, h)
        return pa.table({"set_key": np.concatenate([own, *seen]), "shared": np.concatenate([n, *counts])})

    return sent.groupBy("bucket").applyInArrow(run, "set_key long, shared long").groupBy("set_key").agg(F.sum("shared").alias("shared"))


def candidate_sets(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """(digest, n, doc_id, share) of sets that may have a link; one row per distinct set."""
    counts = _shared_counts(_sent(docs, RANGES * parts(docs.sparkSession)))
    n = F.col("n")
    needed = F.ceil(n * NUMERATOR / DENOMINATOR)
    least = F.least(F.floor(needed * 15 / 100) + 1, needed)
    distinct = rows.filter("n > 0").groupBy("digest").agg(F.first("n").alias("n"), F.first("set_key").alias("set_key"), F.min("doc_id").alias("doc_id"))
    return distinct.join(counts, "set_key").filter(F.col("shared") >= least).withColumn("share", F.col("shared") / n)


def _intersects(name_a: str, name_b: str) -> Column:
    """Whether two packed sets link."""

    @F.pandas_udf("boolean")
    def of(a, b):
        import pandas as pd

        out = []
        for x, y in zip(a, b, strict=True):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            out.append(DENOMINATOR * both >= NUMERATOR * (len(x) + len(y) - both))
        return pd.Series(out, dtype=bool)

    return of(F.col(name_a), F.col(name_b))


def _exploded(name: str) -> Column:
    @F.pandas_udf("array<long>")
    def of(sets):
        import pandas as pd

        return pd.Series([np.frombuffer(s, np.int64) for s in sets])

    return F.explode(of(F.col(name)))


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of pairs (a, b) of set numbers, those whose sets link."""
    left = sets.select(F.col("sid").alias("a"), F.col("tokens").alias("x"), F.col("n").alias("n_a"))
    right = sets.select(F.col("sid").alias("b"), F.col("tokens").alias("y"), F.col("n").alias("n_b"))
    fitting = (DENOMINATOR * F.least("n_a", "n_b")) >= (NUMERATOR * F.greatest("n_a", "n_b"))
    slim = pairs.join(left.drop("x"), "a").join(right.drop("y"), "b").filter(fitting).select("a", "b")
    full = slim.join(right.drop("n_b"), "b").join(left.drop("n_a"), "a")
    return full.filter(_intersects("x", "y")).select("a", "b")


def _meetings(sets: DataFrame) -> DataFrame:
    """Pairs of a set and the most shared member of each of its minimum-hash classes."""

    @F.pandas_udf("array<struct<turn:int, least:long>>")
    def classes(packed):
        import pandas as pd

        out = []
        for data in packed:
            tokens = np.frombuffer(data, np.uint64)
            out.append([(i, int(mix(tokens, 2 * i + 1).view(np.int64).min())) for i in range(MEETINGS)])
        return pd.Series(out)

    rows = sets.select("sid", "share", F.explode(classes("tokens")).alias("class")).select("sid", "share", "class.*")
    leaders = rows.groupBy("turn", "least").agg(F.max(F.struct("share", F.bitwise_not("sid").alias("inverse"))).alias("top"))
    leaders = leaders.select("turn", "least", F.bitwise_not("top.inverse").alias("b"))
    met = rows.join(cut_lineage(leaders, "leaders"), ["turn", "least"])
    return met.filter("sid <> b").select(F.least("sid", "b").alias("a"), F.greatest("sid", "b").alias("b")).distinct()


def _bitmaps(name: str) -> Column:
    @F.pandas_udf(", ".join(f"w{i} long" for i in range(WORDS)))
    def of(sets):
        import pandas as pd

        out = np.zeros((len(sets), WORDS), np.uint64)
        for row, data in zip(out, sets, strict=True):
            bit = (np.frombuffer(data, np.uint64) * ODD) % np.uint64(64 * WORDS)
            np.bitwise_or.at(row, (bit >> np.uint64(6)).astype(int), np.uint64(1) << (bit & np.uint64(63)))
        return pd.DataFrame(out.view(np.int64), columns=[f"w{i}" for i in range(WORDS)])

    return of(F.col(name))


def _bits(words) -> Column:
    return sum((F.bit_count(w) for w in words), F.lit(0))


def _overlap_of_equals(n: Column) -> Column:
    """Least overlap of a set of ``n`` with a partner of its size or more."""
    return F.ceil(n * (2 * NUMERATOR) / (NUMERATOR + DENOMINATOR))


def _between(sets: DataFrame, groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sid, token) of shingles that several groups hold, and (sid, n, share, bits), for
    the sets whose links across groups they could make up."""
    tokens = sets.select("sid", "n", _exploded("tokens").alias("token")).join(groups, "sid")
    spread = tokens.groupBy("token").agg(F.min("grp").alias("low"), F.max("grp").alias("high"))
    between = tokens.join(spread.filter("low <> high").select("token"), "token", "left_semi")
    able = between.groupBy("sid").agg(F.count(F.lit(1)).alias("common"), F.first("n").alias("n"))
    able = able.filter(F.col("common") >= F.ceil(F.col("n") * NUMERATOR / DENOMINATOR)).select("sid")
    members = sets.select("sid", "n", "share", _bitmaps("tokens").alias("bits")).join(able, "sid", "left_semi")
    return cut_lineage(between.join(able, "sid").select("sid", "token"), "between-groups"), cut_lineage(members, "members")


def _across(sets: DataFrame, groups: DataFrame, between: DataFrame, members: DataFrame, leaders_only: bool) -> DataFrame:
    """Links between sets of different groups, through the token-group matrix.

    ``leaders_only``: only the most shared member of each group asks.  That joins large
    groups by a link or two before all members ask, so the many links between
    the members of two such groups need not be listed.
    """
    words = [f"w{i}" for i in range(WORDS)]
    members = members.join(groups, "sid")
    unions = members.groupBy("grp").agg(F.max("n").alias("largest"), *[F.bit_or(f"bits.{w}").alias(w) for w in words])
    matrix = between.join(groups, "sid").select("token", "grp").distinct().join(unions, "grp")
    matrix = matrix.select("token", F.col("grp").alias("to"), "largest", F.struct(*words).alias("union"))
    matrix = cut_lineage(matrix, "token-groups")
    rarity = matrix.groupBy("token").agg(F.count(F.lit(1)).alias("held_by")).filter("held_by > 1")

    asking = members
    if leaders_only:
        top = members.groupBy("grp").agg(F.max(F.struct("share", "sid")).alias("top")).select(F.col("top.sid").alias("sid"))
        asking = members.join(top, "sid", "left_semi")
    # rarest shingles first; those that no other group holds come before all that are left here
    order = between.join(rarity, "token").groupBy("sid").agg(F.sort_array(F.collect_list(F.struct("held_by", "token"))).alias("order"))
    asking = asking.join(order, "sid")
    spare = F.col("n") - _overlap_of_equals(F.col("n"))
    prefix = F.greatest(F.lit(0), spare + 1 - (F.col("n") - F.size("order"))).cast("int")
    asking = asking.select("sid", "n", "grp", "bits", F.explode(F.slice("order", F.lit(1), prefix)).alias("rare"))
    asking = asking.select("sid", "n", "grp", "bits", F.col("rare.token").alias("token"))
    missing = _bits(F.col(f"bits.{w}").bitwiseAND(F.bitwise_not(F.col(f"union.{w}"))) for w in words)
    asked = asking.join(matrix, "token").filter((F.col("grp") != F.col("to")) & (F.col("largest") >= F.col("n")) & (missing <= spare))
    asked = asked.groupBy("sid", "to").agg(F.first("n").alias("n"), F.first("bits").alias("bits"))

    inside = members.select(F.col("sid").alias("b"), F.col("grp").alias("to"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b"))
    fits = (F.col("n_b") >= F.col("n")) & (DENOMINATOR * F.col("n") >= NUMERATOR * F.col("n_b"))
    needed = F.ceil((F.col("n") + F.col("n_b")) * NUMERATOR / (NUMERATOR + DENOMINATOR))
    apart = _bits(F.col(f"bits.{w}").bitwiseXOR(F.col(f"bits_b.{w}")) for w in words)
    opened = asked.join(inside, "to").filter(fits & (apart <= F.col("n") + F.col("n_b") - 2 * needed))
    return _confirmed(opened.select(F.col("sid").alias("a"), "b"), sets)


def link_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs``."""
    with settings(docs.sparkSession, BATCH):
        return _components(docs, cut_lineage(set_rows(docs), "sets")).select("doc_id", "n_shingles", "component_id")


def _components(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` (the ``set_rows`` of ``docs``) with n_shingles and component_id; ``class``
    also tells apart components that share an id because rows do."""
    able = cut_lineage(candidate_sets(docs, rows), "able-sets")
    wanted = docs.join(able.select("doc_id").distinct(), "doc_id", "left_semi")
    held = set_rows(wanted, with_tokens=True).join(able.select("digest", "share"), "digest")
    held = held.groupBy("digest").agg(F.first("n").alias("n"), F.first("share").alias("share"), F.first("tokens").alias("tokens"))
    sets = cut_lineage(held.withColumn("sid", F.monotonically_increasing_id()), "held-sets")

    edges = cut_lineage(_confirmed(_meetings(sets), sets), "links")
    found = components(edges)
    groups = sets.select("sid").join(found.withColumnRenamed("node", "sid"), "sid", "left")
    groups = cut_lineage(groups.select("sid", F.coalesce("root", "sid").alias("grp")), "groups")
    between, members = _between(sets, groups)
    for leaders_only in (True, False):
        more = cut_lineage(_across(sets, groups, between, members, leaders_only), "links")
        joined = more.join(groups.toDF("a", "ga"), "a").join(groups.toDF("b", "gb"), "b").select(F.col("ga").alias("a"), F.col("gb").alias("b"))
        groups = groups.join(components(joined).toDF("grp", "root"), "grp", "left")
        groups = cut_lineage(groups.select("sid", F.coalesce("root", "grp").alias("grp")), "groups")
    merged = groups

    # names of classes: per digest first, so a text with a third of all rows is one row here
    of_set = sets.select("sid", "digest").join(merged, "sid").select("digest", "grp")
    texts = cut_lineage(rows.groupBy("digest").agg(F.min("doc_id").alias("least")).join(of_set, "digest", "left"), "texts")
    linked = texts.filter("grp is not null")
    of_group = linked.groupBy("grp").agg(F.min("least").alias("component"), F.min("digest").alias("class"))
    linked = linked.join(of_group, "grp").select("digest", "component", "class")
    names = linked.unionByName(texts.filter("grp is null").select("digest", F.col("least").alias("component"), F.col("digest").alias("class")))
    names = cut_lineage(names, "names")
    empty = F.col("n") == 0
    return rows.join(names, "digest").select(
        *[c for c in rows.columns if c in ("doc_id", "place")],
        "class",
        F.col("n").alias("n_shingles"),
        F.when(empty | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component, columns unchanged: the row with the smallest doc_id,
    of rows with that id the first by place.  Rows without an id and texts without words
    all stay.  Rows are told apart by their place in the files, not by their ids."""
    columns = docs.columns
    placed, name = located(docs)
    with settings(docs.sparkSession, BATCH):
        rows = _components(docs, cut_lineage(set_rows(placed, locator=name), "sets"))
        rows = rows.filter("n_shingles > 0 AND doc_id IS NOT NULL")
        first = rows.groupBy("class").agg(F.min(F.struct("doc_id", "place")).alias("first"))
        # a group with a third of all rows meets its one row of ``first``; the join may split it
        gone = rows.join(cut_lineage(first, "first-rows"), "class").filter("place <> first.place")
        gone = cut_lineage(gone.select(F.col("place").alias(name)), "near-copies")
    return placed.join(gone, name, "left_anti").select(*columns)
