"""Operators 1-5 against brute force, on small fixtures with awkward rows."""

import hashlib
import os
import re
import tempfile
from collections import Counter

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import decontaminate as D
from ledgerlake.llm import jaccard_join as J
from ledgerlake.llm import oracles as O
from ledgerlake.llm import quality_classifier as Q
from ledgerlake.llm import quality_rules as R
from ledgerlake.llm import suffix_dedup as S
from ledgerlake.llm.tables import Tables

SF = "/root/testdata/sf0.001"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi pi rho".split()


def prose(seed: int, n: int) -> str:
    rng = np.random.Generator(np.random.PCG64(seed))
    return " ".join(f"{WORDS[i]}{rng.integers(0, 50)}" for i in rng.integers(0, len(WORDS), n))


AWKWARD = [(1, "a b c d"), (2, None), (3, ""), (4, "x X a b"), (4, "x X a b"), (None, "c d"),
           (5, " \n\t "), (6, prose(1, 6000)), (7, prose(1, 6000) + " tail"), (8, "É é İ q"),
           (9, prose(2, 40)), (10, prose(2, 40)), (11, prose(2, 38) + " changed end")]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(
        [(i, t, "s") for i, t in AWKWARD], "doc_id long, text string, spans string")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def duck(sql: str, **tables):
    con = duckdb.connect()
    for name, at in tables.items():
        con.execute(f"create view {name} as select * from '{at}'")
    return sorted((tuple(r) for r in con.execute(sql).fetchall()), key=repr)


def saved(df) -> str:
    path = os.path.join(tempfile.mkdtemp(prefix="ll-llm-"), "t.parquet")
    pq.write_table(df.toArrow(), path)
    return path


# ---------------------------------------------------------------- operator 1
ITEMS = [(7, "a B"), (8, "c"), (9, None), (None, "d"), (10, "x x a"), (10, "q"), (11, prose(1, 30)),
         (12, "...")]


def test_decontamination_matches_sql_on_awkward_rows(spark, awkward):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = duck(O.DECONTAMINATION, documents=saved(awkward), benchmark=saved(items))
    for limit in (50_000, 0):           # pushed into the scan, and joined
        got = D.decontaminate(awkward, items, push_limit=limit)
        digest = got.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long"),
                            F.sha2(F.array_join("item_ids", ","), 256), "contaminated")
        assert rows(digest) == want
        assert got.count() == len(AWKWARD)


def test_decontamination_empty_tables(spark, awkward):
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.decontaminate(awkward, none).where("contaminated or n_hit > 0").count() == 0
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert D.decontaminate(awkward.limit(0), items).count() == 0


# ---------------------------------------------------------------- operator 2
def jaccard_brute(data, percent=75):
    sets = []
    for _, t in data:
        w = [x.translate(str.maketrans(D.UPPER, D.LOWER)) for x in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
        sets.append({tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set())
    root = list(range(len(data)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(data)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(data):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least.get(find(i)) if sets[i] else d)
                   for i, (d, _) in enumerate(data)), key=repr)


def family(n: int):
    """Near copies of one text, a chain, unrelated texts that share a passage."""
    base = prose(5, 120).split()
    out = []
    rng = np.random.Generator(np.random.PCG64(9))
    for i in range(n):
        w = list(base)
        for k in rng.integers(0, len(w), rng.integers(0, 6)):
            w[k] = f"m{i}x{k}"
        out.append((100 + i, " ".join(w)))
    out += [(300 + i, prose(50 + i, 30) + " " + " ".join(base[:25])) for i in range(n)]
    return out


def test_jaccard_components_awkward_and_recursive(spark, awkward):
    assert rows(J.jaccard_components(awkward)) == jaccard_brute(AWKWARD)
    data = family(30)
    df = spark.createDataFrame(data, "doc_id long, text string")
    want = jaccard_brute(data)
    for kw in ({}, dict(leaf=4, block=8, rounds=2), dict(leaf=3, block=4, rounds=0, small=0)):
        assert rows(J.jaccard_components(df, **kw)) == want, kw
    assert J.jaccard_components(df.limit(0)).count() == 0


def test_jaccard_regions_of_equal_members_stand_once(spark):
    base = prose(6, 60)
    data = [(i, f"{base} own{i} a{i} b{i} c{i} d{i} e{i}") for i in range(4)]
    own = spark.createDataFrame(data, "doc_id long, text string").coalesce(1)
    tables = Tables(spark, "regions")
    often = J.frequent_shingles(own, 5, 1000, tables)
    assert (often[1] == 4).sum() == 56                   # counts below the old least one of 4 + 1
    few = J.frequent_shingles(own, 5, 3, tables)
    assert len(few[0]) <= 3
    none = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    sets = J.write_sets(own, 5, 50, none, tables)
    pairs, members = J.initial_regions(sets, tables, 100)
    shared = sets.select(F.explode("region").alias("rid")).groupBy("rid").count().where("count = 4").count()
    assert shared > 1 and members.groupBy("rid").count().where("count = 4").count() == 1
    labels = sets.select("key", F.lit(1).cast("long").alias("label"))
    assert J.live_members(members, labels, tables).count() == 0
    assert J.live_members(members, labels.limit(0), tables).count() == members.count()


def test_jaccard_bounds_never_exclude_a_link():
    rng = np.random.Generator(np.random.PCG64(4))
    for _ in range(200):
        x = rng.integers(0, 1 << 48, rng.integers(1, 90)).astype(np.uint64)
        y = np.concatenate([x[: rng.integers(0, len(x) + 1)], rng.integers(0, 1 << 48, 9).astype(np.uint64)])
        x, y = np.unique(x), np.unique(y)
        for each in (1, 8):
            low = J.differing(J.parity_bitmap(x, each), J.parity_bitmap(y, each))
            assert low <= len(np.setxor1d(x, y))
        assert (J.unpack48(J.pack48(x)) == x).all()


# ---------------------------------------------------------------- operator 3
def test_quality_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    stats = Q.with_statistics(docs).checkpoint()
    got = Q.score(stats, Q.fit(Q.labelled(stats, labels))).join(labels, "doc_id").where(~Q.learnable("doc_id"))
    right = got.where("(score >= 0.7) = (quality = 1)").count()
    assert got.count() > 50 and right >= 0.97 * got.count()


def test_quality_awkward_rows(spark, awkward):
    stats = Q.with_statistics(awkward)
    assert stats.columns == ["doc_id", "spans", "qc_stats"]
    labels = spark.createDataFrame([(1, 1), (1, 0), (4, 1), (9, 1), (6, 0), (7, 0), (None, 1), (2, 5)],
                                   "doc_id long, quality int")
    assert Q.labelled(stats, labels).count() <= 6                # 1 is disputed, 2 has no valid label
    none = Q.score(stats, Q.fit(Q.labelled(stats, labels.limit(0))))
    assert {r["score"] for r in none.collect()} == {0.5} and none.count() == len(AWKWARD)
    some = Q.score(stats, Q.fit(Q.labelled(stats, labels))).collect()
    assert all(0 <= r["score"] <= 1 for r in some)


# ---------------------------------------------------------------- operator 4
def test_quality_rules_match_sql_on_awkward_rows(spark, awkward):
    text = "same words over and over again here\n" * 9 + "buy | sell | rent | home\nAll rights reserved."
    more = awkward.union(spark.createDataFrame([(20, text, ""), (21, "A### b$$$ c!! d&&& e**", "")],
                                               awkward.schema))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
             "kept", "lost_words"]
    out = R.quality_rules(more)
    assert out.columns[:3] == more.columns
    got = rows(out.select("doc_id", *[f"qr_{c}" for c in names]))
    want = duck(O.QUALITY_RULES, documents=saved(more))
    assert got == want
    lines = out.where("doc_id = 20").first()
    assert {x["reason"] for x in lines["qr_failed_lines"]} == {"navigation", "boilerplate"}
    assert R.quality_rules(more.limit(0)).count() == 0
    with pytest.raises(ValueError):
        R.quality_rules(out.select("doc_id", "text", "qr_kept"))


# ---------------------------------------------------------------- operator 5
def dedup_brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[i:i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for t in raw:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        runs = sum(gone[i] and (i == 0 or not gone[i - 1]) for i in range(len(t)))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("length,letters,memory", [(4, "ab", 1 << 10), (5, "abc", 1 << 20), (8, "ab", 64),
                                                   (6, "abcdé", 200)])
def test_induction_marks_repeated_windows(length, letters, memory):
    rng = np.random.Generator(np.random.PCG64(length))
    for turn in range(15):
        parts = ["".join(rng.choice(list(letters), rng.integers(0, 60))).encode()
                 for _ in range(rng.integers(1, 12))] + [b"a" * 40] * (turn % 3 == 0)
        seen = Counter(p[i:i + length] for p in parts for i in range(len(p) - length + 1))
        want = [[i for i in range(len(p) - length + 1) if seen[p[i:i + length]] > 1] for p in parts]
        with tempfile.TemporaryDirectory() as folder:
            got = S.repeated_windows(parts, folder, length, memory)
            assert [list(g) for g in got] == want


def test_suffix_dedup_against_brute_force(spark, awkward):
    passage = prose(77, 60)
    extra = [(30 + i, prose(100 + i, 20 + i) + " " + passage + " " + prose(200 + i, 15)) for i in range(6)]
    extra += [(40, "ab" * 400), (41, "é" * 150), (42, passage[:199]), (43, passage[3:203])]
    data = [(i, t) for i, t in AWKWARD] + extra
    df = spark.createDataFrame([(i, t, 0) for i, t in data], "doc_id long, text string, row long")
    got = S.suffix_dedup(df, with_text=True)
    want = dedup_brute([t for _, t in data], 200)
    assert rows(got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) == sorted(
        ((d, *w) for (d, _), w in zip(data, want)), key=repr)
    for r in got.collect():
        assert len(r.kept) == r.n_bytes - r.n_removed
        assert sum(s["b"] - s["a"] for s in r.spans) == r.n_removed
    assert S.suffix_dedup(df.limit(0)).count() == 0


@pytest.mark.parametrize("hold", [1, 700, 5000])
def test_suffix_dedup_hot_anchor_and_small_groups(spark, hold):
    """A passage under 200 bytes in many rows, in groups and shards of any size."""
    passage = prose(77, 60)[:190]
    data = [(i, prose(500 + i, 20) + " " + passage + " " + prose(600 + i % 9, 20)) for i in range(40)]
    data += [(50 + i, prose(700 + i // 2, 60) + prose(800 + i, 30)) for i in range(20)] + data[:3]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = S.suffix_dedup(df, shards=2, hold=hold)
    want = dedup_brute([t for _, t in data], 200)
    assert rows(got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) == sorted(
        ((d, *w) for (d, _), w in zip(data, want)), key=repr)


def test_queues_are_read_by_blocks(tmp_path):
    q = S.Queues(str(tmp_path), "q", 64)
    for k in range(50):
        q.push(7, np.arange(10 * k, 10 * k + 10))
    blocks = list(q.read(7, block=16))
    assert max(map(len, blocks)) <= 16 and np.concatenate(blocks).tolist() == list(range(500))
    assert np.concatenate(list(q.read(7, back=True, block=16))).tolist() == list(range(499, -1, -1))
    seen = []
    for x in q.pop(7):
        seen += x.tolist()
        if len(seen) == 500:
            q.push(7, np.arange(500, 520))
    assert seen == list(range(520)) and not list(q.pop(7))
