"""Pipeline operators on texts against brute force, on small tables with the awkward cases."""

import hashlib
import os
import random
import re
import sys
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from quarry.llm import bpe, line_dedup, mixing, multiset_hash, quality, simhash, substring_dedup, toxicity  # noqa: E402

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("size", T.StringType()),
                       T.StructField("key", T.LongType()), T.StructField("row", T.LongType())])
WORDS = ["the", "of", "Über", "naïve", "x", "12", "a", "tion", "中文", "end."]


def table(spark, rows):
    """Documents with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, s, "size", 1, 2) for i, t, s in rows], SCHEMA)


def corpus(seed, n):
    """Random texts, near and exact copies, shared passages and lines, long, empty and null ones, equal rows."""
    r = random.Random(seed)
    say = lambda k: " ".join(r.choice(WORDS) + str(r.randint(0, 40)) for _ in range(k))
    passages, lines = [say(20) for _ in range(3)], [" Common Line \t", "other line"]
    rows = []
    for i in range(n):
        kind = r.randint(0, 6)
        t = say(r.randint(0, 60))
        if kind == 1 and rows:
            t = r.choice(rows)[1]
        elif kind == 2:
            t = t + " " + r.choice(passages) + "\n" + say(5)
        elif kind == 3:
            t = t + "\n" + r.choice(lines) + "\n\n" + r.choice(lines).upper()
        elif kind == 4 and rows and rows[-1][1]:
            w = rows[-1][1].split(" ")
            w[r.randrange(len(w))] = "edit"
            t = " ".join(w)
        rows.append((i * 3 % (2 * n), t, r.choice(["a", "b", None, "Z"])))
    rows += [(5000, None, "a"), (5001, "", "b"), (5002, " \t\r\n ", None), (None, passages[0], "a"), (5003, "it " * 3000, "a"),
             (5004, "it " * 3000 + passages[1], "b")]
    return rows + [rows[0], rows[0], (rows[1][0], rows[1][1] + " more", "b")]


@pytest.fixture(scope="module")
def rows():
    return corpus(1, 120)


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def test_op3_components_match_all_pairs(spark, rows):
    got = simhash.near_duplicates(table(spark, rows)).collect()
    prints = {}
    for i, t, _ in rows:
        low = "".join(c.lower() if c.isascii() else c for c in t or "")
        w = words(low)
        shingles = [" ".join(w[j:j + 3]) for j in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        prints[i, t] = sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h)) if h else 0
    distinct = sorted(set(prints.values()))
    root = {f: f for f in distinct}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for x in distinct:
        for y in distinct:
            if bin(x ^ y).count("1") <= 2:
                root[find(x)] = find(y)
    least = defaultdict(list)
    for (i, _), f in prints.items():
        least[find(f)].append(i)
    want = Counter((i, f"{prints[i, t]:016x}", min((x for x in least[find(prints[i, t])] if x is not None), default=None))
                   for i, t, _ in rows)
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == want


@pytest.mark.parametrize("radius", [1, 2])
def test_op3_covering_tables_lose_no_pair(spark, radius):
    r = random.Random(radius)
    prints = set()
    for _ in range(60):
        f = r.getrandbits(64)
        prints.add(f)
        for _ in range(r.randint(0, 6)):  # chains of close ones
            for b in r.sample(range(64), r.randint(1, radius + 1)):
                f ^= 1 << b
            prints.add(f)
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    edges = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), radius).collect()
    assert all(bin((a ^ b) & (1 << 64) - 1).count("1") <= radius for a, b in edges)

    def classes(pairs):
        root = {x: x for x in signed}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in pairs:
            root[find(a)] = find(b)
        groups = defaultdict(set)
        for x in signed:
            groups[find(x)].add(x)
        return {frozenset(g) for g in groups.values()}

    assert classes(edges) == classes([(a, b) for a in signed for b in signed if bin((a ^ b) & (1 << 64) - 1).count("1") <= radius])


def test_op3_one_row_of_each_component_stays(spark, rows):
    docs = table(spark, rows)
    groups: list[tuple[set[int], list]] = []  # components of fingerprints and the ids of their rows
    for r in simhash.near_duplicates(docs).collect():
        own = int(r["fingerprint"], 16)
        linked = [g for g in groups if any(bin(own ^ f).count("1") <= 2 for f in g[0])]
        groups = [g for g in groups if g not in linked]
        groups.append((set().union({own}, *(g[0] for g in linked)), [r["doc_id"]] + [i for g in linked for i in g[1]]))
    first = [min(ids, key=lambda i: (i is None, i or 0)) for _, ids in groups]
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted(first, key=str)


def test_op3_unlinked_rows_without_an_id_or_under_one_id_stay(spark):
    say = lambda k: " ".join(f"{k}{j}" for j in range(30))
    rows = [(None, say("a"), "a"), (None, say("b"), "b"), (None, say("c"), "a"), (None, say("c"), "a"), (None, say("d"), "a"),
            (7, say("d"), "a"), (8, say("e"), "a"), (8, say("f"), "b"), (9, say("f"), "a"), (10, say("g"), "b"),
            (10, say("g"), "b"), (11, None, "a"), (11, say("h"), "a")]
    want = Counter([(None, say("a")), (None, say("b")), (None, say("c")), (7, say("d")), (8, say("e")), (8, say("f")),
                    (10, say("g")), (11, None), (11, say("h"))])
    prints = {simhash.simhash(t.encode()) for _, t, _ in rows if t}
    assert all(x == y or bin(x ^ y).count("1") > 2 for x in prints | {0} for y in prints | {0})
    for order in (rows, rows[::-1]):
        kept = simhash.drop_near_duplicates(table(spark, order)).collect()
        assert Counter((r["doc_id"], r["text"]) for r in kept) == want


@pytest.mark.parametrize("min_docs", [2, 10])
def test_op8_lines(spark, rows, min_docs):
    key = lambda x: "".join(c.lower() if c.isascii() else c for c in x.strip(" \t\n\v\f\r"))
    n = Counter(k for _, t, _ in rows for k in {key(x) for x in (t or "").split("\n")} if k)
    want = Counter()
    for i, t, _ in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if n[key(x)] < min_docs]
        want[i, None if t is None else "\n".join(stay), len(lines), len(lines) - len(stay)] += 1
    docs = table(spark, rows)
    got = line_dedup.drop_repeated_lines(docs, min_docs)
    assert got.columns == [c for c in docs.columns if c != "text"] + ["text", "n_lines", "n_dropped"]
    assert Counter((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in got.collect()) == want


def test_op8_a_full_filter_changes_nothing(spark, rows):
    docs = table(spark, rows)
    texts = lambda bits: sorted(map(str, line_dedup.drop_repeated_lines(docs, 3, max_bits=bits).collect()))
    assert texts(line_dedup.SLICE * 8) == texts(1 << 24)


def test_op8_keep_first(spark):
    docs = table(spark, [(3, "same\nx", "a"), (1, "SAME ", "a"), (2, "same\ny", "a")])
    got = {r["doc_id"]: r["text"] for r in line_dedup.drop_repeated_lines(docs, 2, keep_first=True).collect()}
    assert got == {1: "SAME ", 2: "y", 3: "x"}


def brute_passages(rows, window):
    first = {}
    for i, t, _ in rows:
        w = words(t)
        for j in range(len(w) - window + 1):
            if i is not None:
                k = tuple(w[j:j + window])
                first[k] = min(first.get(k, i), i)
    want = Counter()
    for i, t, _ in rows:
        w = words(t)
        gone = set()
        for j in range(len(w) - window + 1):
            if i is not None and first[tuple(w[j:j + window])] < i:
                gone |= set(range(j, j + window))
        want[i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)] += 1
    return want


@pytest.mark.parametrize("options", [{}, {"anchor_limit": 1}, {"shard_words": 40, "gram": 2}])
def test_op2_passages(spark, rows, options):
    got = substring_dedup.drop_repeated_passages(table(spark, rows), **options)
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got.collect()) == brute_passages(rows, 13)


def test_op2_index_counts(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    text = np.append(rng.integers(1, 4, 400), 0)
    index = substring_dedup.FMIndex(text, 5, 5)
    starts = np.arange(390)
    at, low, high = index.search(starts)
    found = dict(zip(at.tolist(), (high - low).tolist()))
    patterns = [tuple(text[s:s + 5]) for s in starts]
    n = Counter(tuple(text[s:s + 5]) for s in range(397))
    assert {i: n[p] for i, p in enumerate(patterns) if n[p] > 1} == found


def test_op4_exact(spark, rows):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    extra = [(9000, "<|endoftext|>a b<|endoftext|> <|endoftext|> \x1c᠎", "a"), (9001, "ab" * 400 + "  \n\n x's't", "a"),
             (9002, "".join(map(chr, range(1, 0x900))), "b")]
    docs = table(spark, rows + extra)
    tables = bpe.prepare(docs, path, lexicon_size=64)
    got = bpe.encode_documents(docs, tables, decode=True)
    back = bpe.decode_documents(got.drop("decoded"), tables).collect()
    assert len(back) == len(rows) + 3
    for r in [*got.collect(), *back]:
        ids = tok.encode(r["text"] or "", add_special_tokens=False).ids
        assert b"".join(i.to_bytes(4, "little") for i in ids) == bytes(r["ids"]) and r["n_tokens"] == len(ids)
        assert r["decoded"] == tok.decode(ids, skip_special_tokens=False)


def test_op4_automaton_is_minimal_and_numbers_words():
    import numpy as np

    found = sorted({(a + b).encode() for a in ("", "re", "un", "unre") for b in ("do", "doing", "made", "making")})
    m = bpe.Minimal(found)
    assert len(m.states) < sum(map(len, found)) / 2
    codec = bpe.Codec.__new__(bpe.Codec)
    codec.t = type("T", (), m.arrays())
    assert codec.look_up(found).tolist() == list(range(len(found)))
    assert codec.look_up([b"", b"d", b"doin", b"doings", b"zzz"]).tolist() == [-1] * 5
    assert np.all(np.diff(m.arrays()["arc"]) > 0)


def test_op6_neighbours(spark, rows):
    known = [r for r in rows if r[0] is not None]
    single = list({i: (i, t, s) for i, t, s in known}.values())  # one row an id: a defined order
    got = {r["doc_id"]: r for r in multiset_hash.edit_likeness(table(spark, single)).collect()}
    order = sorted(single, key=lambda r: -r[0])
    assert len(got) == len(order)
    for (i, t, _), (_, nxt, _) in zip(order, order[1:] + order[:1]):
        t, nxt = t or "", nxt or ""
        edited = t[:len(t) - len(t) // 3] + nxt[:len(t) // 3]
        a, e, b = (multiset_hash.fingerprint(x.encode()) for x in (t, edited, nxt))
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (multiset_hash.to_hex(a), multiset_hash.to_hex(e))
        assert r["near_edited"] == multiset_hash.likeness(a, e) and r["near_next"] == multiset_hash.likeness(a, b)
    assert multiset_hash.edit_likeness(table(spark, rows)).count() == len(rows)
    assert multiset_hash.edit_likeness(table(spark, single[:1])).first()["near_next"] == 1.0


def test_op6_missing_and_repeated_ids_are_spread_and_ordered(spark):
    def order_of(row):
        i, t, _ = row
        h = 42 if t is None else xxhash.xxh64_intdigest(t.encode(), seed=42)
        return (i is None, -(i or 0), h - (1 << 64) if h >> 63 else h)

    def result(i, t, nxt):
        edited = t[:len(t) - len(t) // 3] + nxt[:len(t) // 3]
        a, e, b = (multiset_hash.fingerprint(x.encode()) for x in (t, edited, nxt))
        return (i, len(t), hashlib.sha256(edited.encode()).hexdigest(), multiset_hash.likeness(a, e), multiset_hash.likeness(a, b))

    texts = [f"row {n} " + " ".join(str(n * k % 89) for k in range(n % 13)) for n in range(1500)]
    ids = [None if n % 3 else 7 if n % 5 == 0 else n for n in range(1500)]  # two thirds missing, a fifteenth repeated
    many = [(i, t, "a") for i, t in zip(ids, texts, strict=True)] + [(None, None, "b"), (None, "", "b"), (7, None, "a")]
    cases = [(many, 16), (many, 1), ([(None, t, "a") for t in texts[:200]], 8), ([(5, t, "a") for t in texts[:200]], 8),
             ([(5, "same", "a")] * 50 + [(4, "x y z", "a")] * 50 + [(None, "same", "a")] * 50, 4), ([(None, "one", "a")], 4), ([], 4)]
    for rows, number in cases:
        docs = table(spark, rows).select("doc_id", "text")
        laid = multiset_hash.with_next(docs, number)
        sizes = [r["count"] for r in laid.where("tail = 0").groupBy("bucket").count().collect()]
        assert sum(sizes) == len(rows) and laid.where("tail = 1").count() == len(sizes)  # one row a bucket is sent twice
        if len({(i, t) for i, t, _ in rows}) > 100 and number > 1:
            assert max(sizes) <= 2.2 * len(rows) / number, sorted(sizes)
        line = sorted(rows, key=order_of)
        want = Counter(result(i, t or "", nxt or "") for (i, t, _), (_, nxt, _) in zip(line, line[1:] + line[:1], strict=True))
        kinds = multiset_hash.edit_likeness(docs).schema
        got = multiset_hash.paired(laid, kinds).collect()
        assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) for r in got) == want


def test_op6_multisets():
    import numpy as np

    f, parts = multiset_hash.fingerprint, [b"one two", b"three", b"", b"three"]
    assert (f(b"\n".join(parts)) == f(b"\n".join(parts[::-1]))).all()
    assert (multiset_hash.inserted(f(b"a\nb"), [b"c"]) == f(b"c\na\nb")).all()
    assert (multiset_hash.deleted(f(b"a\nb"), [b"a"]) == f(b"b")).all()
    assert (multiset_hash.from_hex(multiset_hash.to_hex(f(b"x"))) == f(b"x")).all() and f(b"x").dtype == np.uint16
    assert multiset_hash.likeness(f(b"x"), f(b"x")) == 1.0 and (f(b"x") != f(b"x\nx")).any()


def test_op6_lanes_hold_many_equal_pieces(spark):
    f, empty = multiset_hash.fingerprint, multiset_hash.fingerprint(b"")
    assert (f(b"x\n" * 65536) != empty).any()
    assert (multiset_hash.deleted(f(b"x\n" * 100000), [b"x"] * 99999) == f(b"x\n")).all()
    assert (multiset_hash.inserted(f(b"x\n" * 50000), [b"x"] * 50000) == f(b"x\n" * 100000)).all()
    assert multiset_hash.to_hex(f(b"x\n" * 100000)) != multiset_hash.to_hex(f(b"x\n" * 34464))
    whole = "x\n" * 100000
    got = {r["doc_id"]: r for r in multiset_hash.edit_likeness(table(spark, [(2, whole, "a"), (1, "", "a")])).collect()}
    # the last third goes and nothing comes in: counts c and 2c / 3 of one piece, 2 * 2/3 / (1 + 4/9) alike
    assert abs(got[2]["near_edited"] - 12 / 13) < 1e-3 and got[2]["near_next"] < 0.001


def held(i, folds, fold):
    return i is not None and zlib.crc32(str(i).encode()) % folds == fold


@pytest.mark.parametrize("name, column", [("op7_quality", "quality"), ("op9_toxicity", "toxic")])
def test_op7_op9_held_out_accuracy(spark, name, column):
    from quarry.llm.queries import QUERIES

    sf = "/root/testdata/sf0.1"
    got = QUERIES[name](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    x = got.join(labels, "doc_id").where("held_out").toPandas()
    folds = (5, 0) if column == "quality" else (4, 2)
    assert x["doc_id"].map(lambda i: held(i, *folds)).all()
    assert ((x["score"] >= 0.3) == (x["predicted"] == 1)).all() and x["score"].between(0, 1).all()
    assert (x["predicted"] == x[column]).mean() > 0.97
    assert (x[x[column] == 0]["predicted"] == 0).mean() > 0.97


def test_op7_op9_awkward_rows(spark, rows):
    docs = table(spark, rows).select("doc_id", "text")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.fit(docs, none) is None and toxicity.fit(docs, none) is None
    assert {r["predicted"] for r in quality.score_documents(docs, None).collect()} == {1}
    assert {r["score"] for r in toxicity.tag_documents(docs, None).collect()} == {0.0}
    labels = docs.select("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("doc_id") % 2).cast("int").alias("quality"),
                         (F.col("doc_id") % 2).cast("int").alias("toxic"))
    scored = quality.score_documents(docs, quality.fit(docs, labels)).collect()
    tagged = toxicity.tag_documents(docs, toxicity.fit(docs, labels, min_docs=1)).collect()
    assert len(scored) == len(tagged) == len(rows) and all(0 <= r["score"] <= 1 for r in scored + tagged)


def test_op7_learns_from_every_labelled_row_in_any_order(spark):
    # 9,000 rows of one label and 1,000 of the other, and the quantile that parts them is that of all rows
    docs = spark.range(10_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 > 0, F.concat(F.lit("A plain line no. "), "id"))
                                      .otherwise(F.concat(F.lit("#$% | "), "id")).alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 10 > 0).cast("int").alias("quality"))
    one, other = (quality.fit(docs.repartition(n), labels) for n in (1, 7))
    assert one.quantile == 0.1 and one.threshold == other.threshold and (one.weights == other.weights).all()
    assert quality.score_documents(docs, one).join(labels, "doc_id").where("predicted != quality").count() == 0


def test_op7_loss_is_that_of_all_pairs(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    x, label = rng.random((300, quality.FEATURES)), np.arange(300) % 3 // 2
    rows = spark.createDataFrame([(int(y), v.tolist()) for y, v in zip(label, x)], "label int, features array<double>")
    width = quality.expand(x).shape[1]
    mean, scale = quality._moments(rows, width)
    assert np.allclose(mean, quality.expand(x).mean(axis=0)) and np.allclose(scale, quality.expand(x).std(axis=0), atol=1e-4)
    w, z = rng.normal(0, 0.1, width), quality.standardise(x, mean, scale)
    pair = (z[label == 1][:, None] - z[label == 0][None]).reshape(-1, width)
    wrong = 1 / (1 + np.exp(pair @ w))
    found = quality._Pairs(rows, mean, scale, w, 1e-3)
    assert abs(found.loss - np.logaddexp(0, -(pair @ w)).mean() - 1e-3 * w @ w) < 1e-3
    assert np.allclose(found.gradient, -(pair * wrong[:, None]).mean(axis=0) + 2e-3 * w, atol=3e-3)
    assert np.allclose(found.curvature(), (pair * (wrong * (1 - wrong))[:, None]).T @ pair / len(pair) + 2e-3 * np.eye(width), atol=1e-2)


def test_op9_forward_backward_equals_enumeration():
    import itertools

    import numpy as np

    rng = np.random.default_rng(5)
    field = toxicity.Field(rng.normal(size=toxicity.CLASSES), rng.normal(size=(2, 2)), rng.normal(size=2))
    for _ in range(10):
        c = rng.integers(0, toxicity.CLASSES, 8) * (rng.random(8) < 0.5)
        weight = np.zeros((8, 2))
        for path in itertools.product((0, 1), repeat=8):
            w = field.start[path[0]] + sum(field.emission[k] for k, s in zip(c, path) if s)
            w = np.exp(w + sum(field.move[a, b] for a, b in zip(path, path[1:])))
            for t, s in enumerate(path):
                weight[t, s] += w
        at, p = field.marginals(c)
        assert np.allclose(p, (weight[:, 1] / weight.sum(axis=1))[at])


def test_op9_gradient_is_that_of_the_enumerated_likelihood():
    """At the fitted field the seen counts equal those expected over all paths (the ridge aside)."""
    import itertools

    import numpy as np

    r = np.random.default_rng(3)
    classes = r.integers(0, toxicity.CLASSES, (12, 5))
    classes[3, 3:] = -1  # a short one
    tags = ((classes > 2) & (r.random(classes.shape) < 0.8) & (classes >= 0)).astype(int)
    field = toxicity.fit_field(classes, tags, np.ones(len(classes)), steps=3000, rate=0.05, ridge=1e-3)

    def counts(row, path):
        out = np.zeros(toxicity.CLASSES + 6)
        for c, t in zip(row, path):
            out[c] += t
        for a, b in zip(path, path[1:]):
            out[toxicity.CLASSES + 2 * a + b] += 1
        out[toxicity.CLASSES + 4 + path[0]] += 1
        return out

    theta = np.r_[field.emission, field.move.ravel(), field.start]
    gradient = np.zeros_like(theta)
    for row, own in zip(classes, tags):
        row = row[row >= 0]
        every = [counts(row, path) for path in itertools.product((0, 1), repeat=len(row))]
        weight = np.exp([c @ theta for c in every])
        gradient += counts(row, own[:len(row)]) - (weight[:, None] * every).sum(axis=0) / weight.sum()
    assert np.abs(gradient / len(classes) - 1e-3 * theta).max() < 2e-3


LABELLED = "doc_id long, text string, lang string"


def tagger_of(spark, texts, toxic, **options):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], LABELLED).withColumn("score", F.lit("x")).withColumn("label", F.lit(2))
    labels = spark.createDataFrame([(i, y) for i, y in enumerate(toxic)], "doc_id long, toxic int")
    tagger = toxicity.fit(docs, labels, **options)
    scored = toxicity.tag_documents(docs, tagger).collect()
    assert all(0 <= r["score"] <= 1 for r in scored) and len(scored) == len(texts)
    return tagger, [r["score"] for r in scored]


def test_op9_labels_that_teach_nothing(spark):
    clean = [f"some plain words {i}" for i in range(40)]
    for texts, toxic in (([None, ""] * 20, [0, 1] * 20), (clean, [0] * 40), ([], []), (clean, [int(i % 2) for i in range(40)]), (["a", None], [1, 0])):
        tagger, scores = tagger_of(spark, texts, toxic)
        assert tagger is None and not any(scores)


def test_op9_few_labels_use_all_texts(spark):
    # four toxic texts that share words, among many clean ones: a half may lack a kind
    for n in range(3):
        texts = ["you vile rotten fool again"] * (3 + n) + [f"a kind and quiet note {i}" for i in range(60)] + [None, ""]
        tagger, scores = tagger_of(spark, texts, [1] * (3 + n) + [0] * 62, min_docs=1)
        assert tagger is not None and min(scores[:3 + n]) > max(scores[3 + n:])


def test_op9_windows_come_from_the_whole_text():
    import numpy as np

    at = np.arange(0, 100_000, 50)
    table = toxicity._windows(np.ones(len(at), np.int64), at, 100_000, 1, per_text=40)
    assert len(table) in (40, 41) and table.shape[1:] == (2, 2 * toxicity.WINDOW + 1)
    late = np.arange(90_000, 90_100)
    table = toxicity._windows(np.full(100, 2), late, 100_000, 1)
    assert (table[:, 0] == 2).sum() and len(table) <= 9
    assert len(toxicity._windows(np.zeros(0, np.int64), np.zeros(0, np.int64), 0, 0)) == 0
    assert len(toxicity._windows(np.zeros(0, np.int64), np.zeros(0, np.int64), 3, 0)) == 1


def test_op9_offsets():
    import numpy as np

    text = "né idiot  中文 clown"
    got = toxicity.spans(text.encode(), np.array([1, 3]), np.array([0.9, 0.8]))
    assert [text[s["start"]:s["end"]] for s in got] == ["idiot", "clown"]


def test_op10_targets_and_totals(spark, rows):
    docs = table(spark, rows)
    got = mixing.mix_table(docs).join(docs.select("doc_id", "source").distinct(), "doc_id").collect()
    assert mixing.mix_table(docs).collect() and sorted(map(str, mixing.mix_table(docs).collect())) == sorted(map(str, mixing.mix_table(docs).collect()))
    size = defaultdict(int)
    for _, t, s in rows:
        size[s] += len(words(t))
    names = sorted(size, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = 1.5 * sum(size.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        level = (total - sum(2 * size[s] for s in capped)) / sum(weight[s] for s in free)
        above = {s for s in free if level * weight[s] > 2 * size[s]}
        if not above:
            break
        capped |= above
    want = {s: 2.0 * size[s] if s in capped else level * weight[s] for s in names}
    by = {r["source_size"]: r["target"] for r in got}
    assert all(abs(by[size[s]] - want[s]) < 1e-6 for s in names)
    taken = defaultdict(int)
    biggest = max(len(words(t)) for _, t, _ in rows)
    for r in mixing.mix_table(docs).collect():
        assert r["taken"] <= 2 * r["size"]
        taken[r["source_size"]] += r["taken"]
    for s in names:
        assert abs(taken[size[s]] - want[s]) <= 1.5 * biggest


def test_op10_mix_repeats_rows_as_planned(spark, rows):
    docs = table(spark, rows)
    plan = Counter()
    for r in mixing.mix_table(docs).collect():
        plan[r["doc_id"]] += r["copies"]
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert Counter(r["doc_id"] for r in mixed.collect()) == +plan


@pytest.mark.parametrize("rows", [
    [(None, f"w{i} " * 10, "hot") for i in range(600)] + [(i, f"x{i} " * 10, "hot") for i in range(1000)],  # null ids, own texts
    [(7, "w " * 10, "hot") for i in range(640)] + [(100 + i, f"x{i} " * 10, "hot") for i in range(960)],  # equal rows: 40 % of the words
    [(None, "w " * 10, "hot")] * 1600, [(7, f"w{i % 2} " * 10, None) for i in range(1600)], [(1, "w " * 10, "hot")],
], ids=["null ids", "equal rows", "all equal", "two texts", "one row"])
def test_op10_equal_rows_are_parted(spark, rows):
    """Null and repeated ids: every source within one document of its target, in the table and in the mix."""
    others = [(5000 + i, f"y{i} z", s) for i in range(400) for s in ("a", "b", "c")]
    docs = table(spark, rows + others)
    source = rows[0][2]
    planned = mixing.mix_table(docs).where(F.col("source_size") == 10 * len(rows)).collect()
    assert len(planned) == len(rows) and sum(r["taken"] for r in planned) == sum(r["copies"] * r["size"] for r in planned)
    assert abs(sum(r["taken"] for r in planned) - planned[0]["target"]) <= 10 and max(r["taken"] for r in planned) <= 20
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert sum(len(r["text"].split()) for r in mixed.where(F.col("source").eqNullSafe(F.lit(source))).collect()) == sum(r["taken"] for r in planned)


def test_op10_weights_make_probabilities_unequal(spark):
    """Documents of weight 9 are sampled at about nine times the odds of the others."""
    docs = spark.createDataFrame([(i, f"w{i} x", "s" if i < 4000 else "t", 9.0 if i % 2 else 1.0) for i in range(8000)],
                                 "doc_id long, text string, source string, w double")
    got = mixing.mix_table(docs, weights=(1, 3), share=0.5, weight=F.col("w")).where("doc_id < 4000").collect()
    heavy, light = (sum(r["copies"] for r in got if r["doc_id"] % 2 == odd) / 2000 for odd in (1, 0))
    want = got[0]["target"] / got[0]["source_size"]
    assert abs((heavy + light) / 2 - want) < 0.01 and 5 < (heavy / (1 - heavy)) / (light / (1 - light)) < 14


def test_empty_tables(spark):
    docs = table(spark, [])
    assert simhash.near_duplicates(docs).count() == simhash.drop_near_duplicates(docs).count() == 0
    assert line_dedup.drop_repeated_lines(docs).count() == substring_dedup.drop_repeated_passages(docs).count() == 0
    assert mixing.mix_table(docs).count() == mixing.mix(docs).count() == multiset_hash.edit_likeness(docs).count() == 0
    import public_tokenizers as P

    assert bpe.encode_documents(docs, bpe.prepare(docs, P.path("byte_bpe_50k.json"))).count() == 0
    assert quality.score_documents(docs, None).count() == toxicity.tag_documents(docs, None).count() == 0
