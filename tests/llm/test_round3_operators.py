"""Operators 11-13 against the library itself or brute force."""

import base64
import hashlib
import heapq
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from ledgerlake.llm import byte_bpe as B
from ledgerlake.llm import conversation_repair as C
from ledgerlake.llm import hard_negatives as N
from ledgerlake.llm import html_extract as H
from ledgerlake.llm import secret_scan as S

SF = "/root/testdata/sf0.001"
MULTI = str(P.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(MULTI, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


# --------------------------------------------------------------- operator 11
TEXTS = [(1, "Hello, world! it's  fine…"), (2, None), (3, ""), (4, "x" * 70_000), (5, "tail <|endoftext|> 12"),
         (5, "tail <|endoftext|> 12"), (None, "É é  ΑΣ　漢字 🙂\x00\x1c"), (6, "word " * 7000), (7, " \n\t  \n"),
         (8, "a\n\n  b  c 12345 ½²")]


@pytest.mark.parametrize("block_text", [40, B.BLOCK_TEXT])
def test_byte_bpe_equals_library(spark, library, block_text):
    df = spark.createDataFrame([(i, t, -1, "z") for i, t in TEXTS], "doc_id long, text string, ids int, block string")
    out = B.decode(B.encode(df, MULTI, P.PATTERN, block_text=block_text), MULTI).collect()
    want = [(i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t in TEXTS]
    got = [(r.doc_id, list(r.ids), bytes(r.decoded)) for r in out]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert all(r.n_tokens == len(r.ids) for r in out)


def test_number_code():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5000):
        x = rng.integers(0, 1 << 32, n, dtype=np.uint32) >> rng.integers(0, 32, n, dtype=np.uint32)
        assert (B.expand(B.squeeze(x), n) == x).all()
    edges = np.array([0, 191, 192, B._TWO - 1, B._TWO, B._THREE - 1, B._THREE, 2 ** 32 - 1], np.uint32)
    assert (B.expand(B.squeeze(edges), len(edges)) == edges).all()


def test_byte_bpe_shuffles_words_and_ids_only(spark):
    df = spark.createDataFrame(TEXTS, "doc_id long, text string")
    out = B.encode(df, MULTI, P.PATTERN)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Bucketed: true" in plan
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("ledgerlake_")]


def test_byte_bpe_query(spark, library):
    from ledgerlake.llm.queries import QUERIES
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = set()
    for r in docs:
        ids = library.encode_ordinary(r.text or "")
        want.add((r.doc_id, len(ids), sha(",".join(map(str, ids)).encode()), sha((r.text or "").encode())))
    assert {tuple(r) for r in QUERIES["op11_byte_bpe"](spark, SF).collect()} == want


def test_byte_bpe_awkward(spark):
    df = spark.createDataFrame([("k", "a b")], "key string, body string")
    none = B.encode(df.limit(0), MULTI, P.PATTERN, doc_id="key", text="body")
    assert none.count() == 0 and none.columns == ["doc_id", "n_tokens", "ids"]
    assert B.encode(df.withColumn("body", df.body.substr(9, 1)), MULTI, P.PATTERN, "key", "body").first().ids == []
    odd = spark.createDataFrame([([5, None, -3, 10 ** 8],), (None,), ([],)], "ids array<int>")
    one = B.decode(spark.createDataFrame([([5],)], "ids array<int>"), MULTI).first().decoded
    assert [r.decoded for r in B.decode(odd, MULTI).collect()] == [one, None, b""]
    with pytest.raises(ValueError, match="decoded"):
        B.decode(odd.withColumnRenamed("ids", "Decoded"), MULTI, "Decoded")


# --------------------------------------------------------------- operator 12
def cheapest(rows, c=C.Costs()):
    """Dijkstra over whole audits: (cost, audit) of (initial, must go, truncated) rows."""
    heap, shut = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, said = heapq.heappop(heap)
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", said):
            return cost, audit
        if (i, said) in shut:
            continue
        shut.add((i, said))
        steps = [("I", c.insert, i, x) for x in "ua"] if len(said) < len(rows) + 3 else []
        if i < len(rows):
            initial, gone, cut = rows[i]
            steps.append(("D", c.delete, i + 1, ""))
            if not gone:
                more = c.truncated * cut
                steps += [("K", more, i + 1, initial)] * (initial != "")
                steps += [("R", c.rerole + more, i + 1, x) for x in "ua"]
        for letter, price, j, x in steps:
            if re.fullmatch("s?(ua)*u?", said + x):
                heapq.heappush(heap, (cost + price, audit + letter, j, said + x))


def viterbi(rows, costs=C.Costs()):
    v = C.Viterbi(costs)
    for r in rows:
        v.row(*r)
    return v.finish()


def test_viterbi_equals_all_paths():
    rng = random.Random(5)
    for n in range(7):
        for _ in range(120):
            rows = [(rng.choice("uuuaaas "), rng.random() < 0.15, rng.random() < 0.2) for _ in range(n)]
            assert viterbi(rows) == cheapest(rows), rows
    odd = C.Costs(rerole=3, delete=4, insert=1, truncated=2)  # inserting is cheap
    for _ in range(150):
        rows = [(rng.choice("uas"), rng.random() < 0.1, rng.random() < 0.2) for _ in range(rng.randrange(6))]
        assert viterbi(rows, odd) == cheapest(rows, odd), rows


def test_viterbi_forgets_what_is_decided():
    v = C.Viterbi()
    for k in range(4000):
        v.row("ua"[k % 2], False, k % 7 == 0)
        assert len(v.decided) >= k - 8
    v = C.Viterbi()  # one role only: every second edit depends on how many rows are to come
    for k in range(20_001):
        v.row("u", False, False)
    nodes, todo = 0, [v.root]
    while todo:
        nodes, todo = nodes + 1, todo[1:] + todo[0].children
    assert nodes <= 8 and v.finish() == (10_002, "D" + "KR" * 10_000)


def by_hand(rows):
    """The contract, plainly: rows are (turn, role, text) after damage."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
    seen, states, turns = set(), [], {r[0] for r in rows if r[0] is not None}
    n = {"b": 0, "d": 0, "t": 0}
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        fault = "b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        if fault:
            n[fault] += 1
        states.append((role[:1], fault in ["b", "d"], fault == "t"))
    initials = [s[0] for s in states]
    illegal = sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:]))
    cost, audit = cheapest(states)
    out, i = [], 0
    for e in audit:
        due = "assistant" if out and out[-1][0][:1] == "u" else "user"
        if e == "I":
            out.append((due, ""))
            continue
        if e != "D":
            out.append((due if e == "R" else rows[i][1], rows[i][2]))
        i += 1
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    digest = hashlib.sha256("\n".join(f"{a}:{b}" for a, b in out).encode()).hexdigest()
    return (gaps, n["b"], n["d"], n["t"], illegal, cost, audit, digest)


def hurt(rows):
    """Damage of (conv, turn, role, text) rows, plainly."""
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        how = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        if how == 0:
            continue
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        yield from [(conv, (turn, "user" if how == 4 else role, text))] * (2 if how == 3 else 1)


def repaired(rows):
    want = {r[0]: [] for r in rows}
    for conv, row in hurt(rows):
        want[conv].append(row)
    return {(conv, *by_hand(own)) for conv, own in want.items()}


def test_conversation_query(spark):
    from ledgerlake.llm.queries import QUERIES
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    got = {tuple(r) for r in QUERIES["op12_conversation_repair"](spark, SF).collect()}
    assert len(got) == len({r[0] for r in rows}) and got == repaired(rows)


def test_conversation_awkward_rows(spark, tmp_path):
    from ledgerlake.llm.queries import QUERIES
    rng = random.Random(3)
    rows = [(c, rng.choice([None, 0, 1, 2, 3, 9]), rng.choice(["user", "assistant", "system", "tool", "", None]),
             rng.choice([None, "", " \n", "Yes.", "No", "Why? ", "x" * 50_000 + "!"]))
            for c in [None, *range(40)] for _ in range(rng.randrange(1, 7))]
    ddl = "conv_id long, turn long, role string, text string"
    for name, data in (("some", rows + rows[:9]), ("none", [])):
        df = spark.createDataFrame(data, ddl)
        df.withColumns({"digest": F.lit(1), "n": F.lit("x")}).write.parquet(f"{tmp_path}/{name}/conversations.parquet")
        got = {tuple(r) for r in QUERIES["op12_conversation_repair"](spark, f"{tmp_path}/{name}").collect()}
        assert got == repaired(data)


def test_conversation_rows_come_back(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "user", "Ah."), (1, 2, "user", ""), (2, 0, "system", "S.")],
                               "conv_id long, turn long, role string, text string")
    found = C.audits(df)
    assert {(r.conv_id, r.cost, r.audit) for r in found.collect()} == {(1, 3, "KRD"), (2, 2, "D")}
    got = sorted(tuple(r) for r in C.replay(df, found).collect())
    assert got == [(1, 0, "K", 0, "user", "Hi."), (1, 1, "R", 1, "assistant", "Ah.")]
    cheap = C.Costs(rerole=3, delete=4, insert=1)
    found = C.audits(df.where("conv_id = 2"), costs=cheap)
    assert [tuple(r)[1:] for r in C.replay(df.where("conv_id = 2"), found).collect()] == [
        (0, "K", 0, "system", "S."), (1, "I", None, "user", ""), (2, "I", None, "assistant", "")]


# --------------------------------------------------------------- operator 13
def mined(rows, every=100, k=5):
    """Plainly: (vec_id, vector, label) rows to the result's rows."""
    fine = [(i, np.floor(256 * np.array(v, float)).astype(np.int64), label) for i, v, label in rows
            if label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for n, (anchor, q, label) in enumerate(fine):
        if anchor is None or anchor % every:
            continue
        m = lambda v: int(q[:len(v)] @ v[:len(q)])
        rest = sorted(((-m(v), i is None, i or 0, i, lab) for j, (i, v, lab) in enumerate(fine) if j != n))
        for p in [r for r in rest if r[4] == label][:k]:
            near = [r for r in rest if r[4] != label and -80 * p[0] <= -100 * r[0] <= -100 * p[0]]
            out += [(anchor, p[3], g + 1, r[3], -p[0], -r[0]) for g, r in enumerate(near[:k])]
    return sorted(out, key=str)


def test_intervals_hold():
    rng = np.random.default_rng(2)
    for size in (64, 256):
        x = np.floor(256 * rng.normal(size=(300, size)) * rng.choice([0, 0.01, 1, 50], (300, 1))).astype(np.int64)
        x[:3] = [np.zeros(size), np.ones(size), np.full(size, -7)]
        q = np.concatenate([x[:20], x[5:25] + rng.integers(-9, 9, (20, size))])
        low, high = N.intervals(q, *N.encode(x, 9), 9)
        true = q @ x.T
        assert (low <= true).all() and (true <= high).all()
        assert np.allclose((N.rotate(x.astype(float), 9) ** 2).sum(1), (x ** 2).sum(1))
        apart = np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(x, axis=1) + 1
        assert np.median((high - low) / apart) < 1.4  # Cauchy-Schwarz alone gives 2


def test_hard_negatives_query(spark):
    from ledgerlake.llm.queries import QUERIES
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    rows = [(i, v, (n + 1) % 10 if i % 7 == 0 else n) for i, v, n in rows]
    got = QUERIES["op13_hard_negatives"](spark, SF)
    assert sorted(map(tuple, got.collect()), key=str) == mined(rows) and got.count() > 0


@pytest.mark.parametrize("block_rows, anchor_rows", [(4096, 2048), (7, 3)])
def test_hard_negatives_awkward(spark, block_rows, anchor_rows):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=5).round(1).tolist(), int(rng.integers(0, 3))) for i in range(120)]
    rows += [(3, None, 1), (4, [1.0, None], 1), (5, [float("nan")] * 5, 2), (6, [float("inf")] * 5, 2),
             (20, [1.0, 2.0], None), (None, [2.0, 2.0, 2.0], 1), (None, [3.0], 0), (40, [], 1), (10, [0.5] * 70, 2)]
    rows += rows[:30]  # repeated rows, anchors among them
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    flat = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], n) for i, v, n in rows]
    df = df.withColumns({"score": F.lit("x"), "key": F.lit(1), "block": F.lit(0)})
    got = N.mine(df, F.col("vec_id") % 10 == 0, block_rows=block_rows, anchor_rows=anchor_rows)
    assert sorted(map(tuple, got.collect()), key=str) == mined(flat, 10)
    assert N.mine(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert N.mine(df, F.col("vec_id") < 0).count() == 0


# ------------------------------------------- operator 10: time and fieldsets
@pytest.mark.parametrize("bit", ["<div>", "<b>", "<div>x", "</i></b>", "<!", '<a href="x ', "<a b='", "<a", "<li>x",
                                 "<p>a<table><tr><td>", "</script", "<a>x<div>", "<p"])
def test_html_time_is_linear_however_broken(bit):
    def spent(n):
        page = "<p>" + bit * (n // len(bit)) + ">"
        t = time.process_time()
        H.main_text(page)
        return time.process_time() - t
    spent(10_000)
    small, large = min(spent(60_000) for _ in range(2)), spent(480_000)
    assert large < 8 * 3 * small + 0.2            # quadratic time would be 64 times as much


def test_html_fieldset_around_the_article_stays():
    story = "".join(f"<p>Sentence {i}, with commas, and some more words to read here.</p>" for i in range(5))
    page = f"<body><nav>menu</nav><fieldset><h1>Told</h1>{story}</fieldset><form><fieldset>Name <input></fieldset></form></body>"
    text = H.main_text(page)
    assert text.startswith("Told\nSentence 0") and text.count("\n") == 5 and "Name" not in text


# ------------------------------------- operator 7: words of many languages, keys
WORDS = """przedsiebiorczosc odpowiedzialnosc najprawdopodobniej bezpieczenstwo-narodowe niepodleglosciowy
lentokonesuihkuturbiinimoottori epajarjestelmallisyys tietosuojavaltuutettu ymparistoministerio
Geschwindigkeitsbegrenzung Rechtsschutzversicherung ganzheitlichkeitsmedizin Donaudampfschifffahrt
anticonstitutionnellement electroencephalogramme incomprehensibilite rez-de-chaussee-haut
desafortunadamente internacionalizacion responsabilidades-compartilhadas precipitevolissimevolmente
felhasznalobarat-szolgaltatas kozlekedesbiztonsagi zdravotnickeho-zarizeni nejkulatoulinkatejsi
sorumlulugumuzdan uluslararasilastirma arbeidsongeschiktheidsverzekering verantwoordelijkheidsgevoel
realisationsvinstbeskattning menneskerettighetsorganisasjonene internationalization
responsibility-driven-design some_long_snake_case_name_12 getElementsByClassName 2024-01-01T00-00-00
20240101T000000Z 2024-01-01_12-30-59-123456""".split()


def test_secret_scan_leaves_words_and_finds_keys(spark):
    import string
    rng = random.Random(11)
    alphabets = {"alnum": string.ascii_letters + string.digits, "base64": string.ascii_letters + string.digits + "+/",
                 "base32": string.ascii_uppercase + "234567", "lower": string.ascii_lowercase,
                 "hex": "0123456789ABCDEF", "lower-digits": string.ascii_lowercase + string.digits}
    rows = [("word", w, f"a {w} b") for w in WORDS]
    rows += [(a, str(n), "key " + "".join(rng.choice(c) for _ in range(n)) + " end")
             for a, c in alphabets.items() for n in (16, 24, 40) for _ in range(400)]
    df = spark.createDataFrame(rows, "kind string, what string, text string")
    got = S.secret_scan(df, MULTI, P.PATTERN, masked=False).groupBy("kind", "what").agg(
        F.avg((F.col("ss_n_random") > 0).cast("int")).alias("share")).collect()
    assert not [r.what for r in got if r.kind == "word" and r.share]
    assert all(r.share >= 0.95 for r in got if r.kind != "word"), [r for r in got if r.kind != "word" and r.share < 0.95]


def test_secret_scan_long_texts_and_edges(spark):
    key = "Zq8kX2vB7nM4pL9wR3tY6uJ1"
    long = "plain words. " * 90_000
    df = spark.createDataFrame([(1, long + key), (2, None), (3, "")], "doc_id long, text string")
    got = {r.doc_id: r for r in S.secret_scan(df, MULTI, P.PATTERN).collect()}
    assert got[1].ss_spans == f"random:{len(long)}:{len(long) + len(key)}" and got[1].ss_masked_text == long + "[SECRET]"
    assert got[2].ss_spans == got[3].ss_spans == "" and S.secret_scan(df.limit(0), MULTI, P.PATTERN).count() == 0
    with pytest.raises(ValueError, match="exist"):
        S.secret_scan(df.withColumnRenamed("doc_id", "SS_spans"), MULTI, P.PATTERN)


# --------------------------------- operator 6: many languages, names, long texts
def test_language_of_many_values_and_long_texts(spark):
    from ledgerlake.llm import language_id as L
    rows = [(i, f"zz{i} " * 5, f"junk{i}") for i in range(300)]
    rows += [(1000 + i, "le chat et le chien dans la maison " * 20, "fr") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(2)
    codes = L.fit(df)
    assert len(codes.languages) == 301 and np.isfinite(codes.weights).all()
    # The same weights as from all counts at once.
    counts = {}
    for r in L.count_trigrams(df).collect():
        counts.setdefault(r.lang, np.zeros(L.BUCKETS))[r.bucket] += r.n
    rate = np.array([(counts[x] + 0.5) / (counts[x] + 0.5).sum() for x in codes.languages])
    k = 3
    want = np.log(rate[codes.book[:, k] > 0].mean(0)) - np.log(rate[codes.book[:, k] < 0].mean(0))
    assert np.allclose(codes.weights[:-1, k], want)
    long = spark.createDataFrame([(1, "le chat et le chien " * 100_000, None)], "doc_id long, text string, lang string")
    assert L.decode(L.with_margins(long, codes), codes).first().lang_pred == "fr"
    with pytest.raises(ValueError, match="li_margins"):
        L.with_margins(df.withColumnRenamed("doc_id", "LI_margins"), codes)


def test_clashing_columns_are_ignored_or_refused(spark):
    from ledgerlake.llm import jaccard_join as J
    from ledgerlake.llm import quality_classifier as Q
    from ledgerlake.llm import token_rollups as T
    text = "one two three four five six seven"
    df = spark.createDataFrame([(1, text, 9, "x"), (2, text, 8, "y")], "doc_id long, text string, key int, row string")
    assert {tuple(r) for r in J.jaccard_components(df).collect()} == {(1, 3, 1), (2, 3, 1)}
    assert J.jaccard_components(df.limit(0)).count() == 0
    with pytest.raises(ValueError, match="qc_stats"):
        Q.with_statistics(df.withColumnRenamed("row", "QC_stats"))
    own = df.withColumns({"source": F.lit("s"), "lang": F.lit("en"), "tokens": F.lit(-1), "version": F.lit("z")})
    got = T.count_tokens(own, "word_bpe_49k", str(P.path("word_bpe_49k.json")), "1").collect()
    assert {r.version for r in got} == {"1"} and all(r.tokens > 0 for r in got)
