"""Vector codes, the source audit and HTML wrappers against brute force, and their awkward rows."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.llm import html_wrappers as hw
from quarry.llm import source_audit, vector_codes
from quarry.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", ["op11_html_text", "op12_source_audit", "op13_vector_codes"])
def test_queries_match_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = QUERIES[key](spark, SF)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLE[key]})").fetchall()
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


# ---- vector codes


def product_codes(rows, parts, entries, rounds):
    """Plain Python over (id, vector, label): codes, errors, codebooks."""
    ok = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not ok:
        return [], []
    whole = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in ok]
    first = sorted(whole, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    dim = len(first[0][1])
    whole = [r for r in whole if len(r[1]) == dim]
    first = [r for r in first if len(r[1]) == dim][:entries]
    sizes = [dim // parts + (p < dim % parts) for p in range(parts)]
    cuts = [(sum(sizes[:p]), sum(sizes[:p + 1])) for p in range(parts)]
    books = [[r[1][a:z] for r in first] for a, z in cuts]

    def nearest(part, v):
        return min((sum((x - y) ** 2 for x, y in zip(v, e)), i) for i, e in enumerate(books[part]))

    for _ in range(rounds):
        for part, (a, z) in enumerate(cuts):
            took = defaultdict(list)
            for _, v, _ in whole:
                took[nearest(part, v[a:z])[1]].append(v[a:z])
            books[part] = [[sum(c) // len(c) for c in zip(*took[i])] if i in took else e for i, e in enumerate(books[part])]
    out = []
    for i, v, label in whole:
        best = [nearest(part, v[a:z]) for part, (a, z) in enumerate(cuts)]
        out.append((i, label, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best)))
    return out, books


def coded(spark, rows, **options):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").select(
        "vec_id", "embedding", "label", F.lit("x").alias("row"), F.lit(1).alias("part"), F.lit(2).alias("code"))
    found, books = vector_codes.compress(table, **options)
    return sorted(map(tuple, found.collect()), key=repr), books, found


def test_op13_equals_plain_python(spark):
    r = random.Random(5)
    rows = [(i, [r.gauss(0, 0.2) for _ in range(10)], r.choice([None, 1, 2])) for i in range(300)]
    rows += [(400 + i, rows[3][1], 7) for i in range(150)]  # copies of one vector
    rows += [(250, rows[9][1], 1), (None, rows[8][1], None), (600, None, 1), (601, [math.nan] * 10, 1), (602, [None] * 10, 1),
             (603, [math.inf] * 10, 1), (604, [1.0], 1), (605, [], None)]
    got, books, found = coded(spark, rows, entries=20, block_rows=16)
    want, want_books = product_codes(rows, 4, 20, 4)
    assert got == sorted(want, key=repr) and books == want_books
    sums = defaultdict(int)
    for _, label, _, error in want:
        sums[label] += error
    for row in vector_codes.label_errors(found).collect():
        assert row["label_error"] == sums[row["label"]]


@pytest.mark.parametrize("size", [1e3, 2e7, 1e30])
def test_op13_wide_numbers_stay_exact(spark, size):
    r = random.Random(6)
    rows = [(i, [r.uniform(-size, size) for _ in range(8)], 1) for i in range(60)]
    got, books, _ = coded(spark, rows, entries=6, block_rows=8)
    want, want_books = product_codes(rows, 4, 6, 4)
    assert books == want_books
    assert got == sorted([(*w[:3], w[3] if w[3] < 2 ** 63 else None) for w in want], key=repr)


def test_op13_empty_and_one_row(spark):
    assert coded(spark, [])[0] == [] and coded(spark, [(1, None, 1)])[0] == []
    assert coded(spark, [(1, [0.5] * 8, None)])[0] == [(1, None, "00000000", 0)]
    assert coded(spark, [(1, [0.5, 0.25], None)])[0] == [(1, None, "00000000", 0)]  # fewer components than parts
    with pytest.raises(ValueError):
        coded(spark, [], entries=257)


@pytest.mark.parametrize("d,bits", [(2, 4), (3, 3), (5, 2), (4, 1)])
def test_op13_curve_visits_neighbours(d, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * d, indexing="ij"), -1).reshape(-1, d)
    keys = [k.tobytes() for k in vector_codes.hilbert_keys(cells, bits)]
    order = sorted(range(len(keys)), key=keys.__getitem__)
    assert len(set(keys)) == len(keys)
    assert (np.abs(np.diff(cells[order], axis=0)).sum(axis=1) == 1).all()


def test_op13_shortlists_leave_entries_out():
    r = np.random.default_rng(1)
    book = vector_codes.Codebook([[int(x) for x in v] for v in r.integers(-1000, 1000, (256, 4))])
    box = r.integers(-1000, 1000, 4).astype(float)
    among = book.shortlist(box - 20, box + 20)
    assert 0 < len(among) < 64
    for x in r.integers(-20, 21, (200, 4)) + box:
        assert book.nearest(x[None, :], among)[0][0] == book.nearest(x[None, :], np.arange(256))[0][0]


# ---- source audit


def audit(rows, min_docs, smooth, scale, top):
    """Plain Python over (text, lang, source)."""
    rows = [tuple(v or "" for v in r) for r in rows]
    count, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        count[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    groups = sorted({r[1:] for r in rows})
    for lang in sorted({g[0] for g in groups}):
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        sources = [s for one, s in groups if one == lang]

        def rates(counter):
            n = sum(counter[t] for t in kept)
            return {t: 1 + scale * (counter[t] + smooth) // (n + smooth * len(kept)) for t in kept}

        p = {s: rates(count[lang, s]) for s in sources}
        q = rates(sum((count[lang, s] for s in sources), Counter()))
        for s in sources:
            pair = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            term = [(t, p[s][t] - q[t]) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, found, limit in (("pair", pair, None), ("term", term, top)):
                for rank, (item, value) in enumerate(sorted(found, key=lambda f: (-f[1], f[0].encode()))[:limit]):
                    out.append((lang, s, part, item, value, rank + 1))
    return sorted(out)


AUDIT_TEXTS = ["the cat", "The dog-cat", "é É naïve", "", None, "a1b2c", "中文 words", "x" * 50_000 + " end", "zz zz zz zz", "A\nB\tC"]


def audit_rows(seed, n):
    r = random.Random(seed)
    rows = [(" ".join(str(r.choice(AUDIT_TEXTS) or "") for _ in range(r.randint(0, 5))), r.choice(["en", "de", None]),
             r.choice(["s1", "s2", None, "é", "S1", "hot", "hot", "hot"])) for _ in range(n)]
    return rows + [(None, None, None), ("", "fr", "only"), ("", "fr", "other"), ("!!", "xx", "one")]


@pytest.mark.parametrize("block,cells,slice_bytes", [(64, 65_536, 8 << 20), (2, 4, 700), (1, 65_536, 1)])
def test_op12_equals_plain_python(spark, block, cells, slice_bytes):
    rows = audit_rows(7, 60)
    table = spark.createDataFrame(rows, "text string, lang string, source string").withColumn("term", F.lit(1)).withColumn("n", F.lit(1))
    got = source_audit.divergence(table, min_docs=3, top=4, block=block, bucket_cells=cells, slice_bytes=slice_bytes)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == audit(rows, 3, 5, 1_000_000_000, 4)


def test_op12_empty(spark):
    assert source_audit.divergence(spark.createDataFrame([], "text string, lang string, source string")).collect() == []


def test_op12_slices_count_terms():
    r = random.Random(8)
    for _ in range(60):
        texts = ["".join(r.choice(["a", "ab", "é", " ", "B", "9", "xyzxyzxyz", "\n", "中文" * 5]) for _ in range(r.randint(0, 400)))
                 for _ in range(r.randint(1, 8))]
        langs, sources = [r.choice("xy") for _ in texts], [r.choice(["", "s"]) for _ in texts]
        n, docs = Counter(), Counter()
        for text, lang, source in zip(texts, langs, sources):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
            n.update((lang, source, t.encode()) for t in terms)
            docs.update((lang, source, t.encode()) for t in set(terms))
        for small in (256, 0):  # with and without the shortcut for small runs
            source_audit.SMALL, before = small, source_audit.SMALL
            out = source_audit._count_slice(pa.array([t.encode() for t in texts], pa.large_binary()), langs, sources)
            source_audit.SMALL = before
            assert {k: v for *k, d, c in zip(*(c.to_pylist() for c in out.columns)) for k, v in [(tuple(k), (d, c))]} == {
                k: (docs[k], n[k]) for k in n}


def test_op12_pointers_stand_in_order():
    data = np.frombuffer(b"banana band ban bandana banana " + b"\0" * 8, np.uint8)
    start, length, _ = source_audit.term_pointers(data[:-8], np.array([len(data) - 8]))
    order, run = source_audit.sort_terms(data, start, length)
    words = [bytes(data[start[p]:start[p] + length[p]]) for p in order]
    assert words == sorted(words) and run.tolist() == [0, 1, 1, 2, 3]


# ---- wrappers


def extract(spark, pages, columns=("page_id", "url", "html")):
    table = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("text", F.lit("old")).withColumn("host", F.lit("h"))
    out = hw.extract_main_text(table).collect()
    assert all(r["n_chars"] == len(r["text"]) and r["host"] == "h" for r in out)
    return {r["page_id"]: r["text"] for r in out}


ARTICLE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="<article><p>no</p>";</script></head><body class="has-sidebar">
<header><a href="/">Logo</a></header><nav><ul><li>Menu<li>More</ul></nav><div class="ad">Buy {n}</div><article><header><h1>Title {n} &amp; co</h1></header>
<p><b>First {n}<br>line &lt;kept&gt;<p class="x">Second   para\n graph</p><div class="advert">Buy again</div><form>Your mail <input></form>
<ul><li>one<li>two {n}</ul><!-- <p>no</p> --><aside>See also</aside><footer>Tags</footer><section id="comments"><p>Nonsense {n}</p></section></article>
<div class="sidebar"><p>Side {n}</p></div><div id="cookie-notice">Cookies</div><footer>&copy; {n}</footer>"""


def article(n):
    return f"Title {n} & co\nFirst {n} line <kept>\nSecond para graph\none\ntwo {n}"


def test_op11_article_and_its_surroundings(spark):
    pages = [(n, f"https://user@Site.example:80/{n}", ARTICLE.format(n=n)) for n in range(5)]
    assert extract(spark, pages) == {n: article(n) for n in range(5)}


DIVS = """<div class="top-header"><a>Home</a></div><div class="c{n}"><div><h2>Head {n}</h2><p>Words of {n}</p>{more}</div></div>
<div class="box">Read our paper every day</div><div class="comment-list"><article class="comment"><p>Bad {n}</p></article></div><div>Fixed words</div>"""


def test_op11_no_marker_uses_the_host(spark):
    pages = [(n, "http://a.example/", DIVS.format(n=n, more="<p>Also</p>" * n)) for n in range(4)]
    pages.append((9, "http://b.example/", DIVS.format(n=9, more="")))  # one page shows no template
    got = extract(spark, pages)
    for n in range(4):
        assert got[n] == "\n".join([f"Head {n}", f"Words of {n}"] + ["Also"] * n)
    assert got[9] == "Head 9\nWords of 9\nRead our paper every day\nFixed words"


def test_op11_equal_pages_keep_their_words(spark):
    page = "<body><p>All the same</p></body>"
    assert extract(spark, [(n, "http://a/", page) for n in range(3)]) == {n: "All the same" for n in range(3)}


def test_op11_awkward_pages(spark):
    pages = [(1, None, None), (2, "", ""), (3, "::", "plain &amp; words"), (4, "http://x/", "<script>never closed"), (5, "http://x/", "<p>cut <b off"),
             (6, "http://y/", "<div>" * 5000 + "deep"), (7, "http://z/", "</p></div><p>a</span>b</p>c<br/>d<hr>e"), (None, "http://n/", "<p>x"),
             (8, "http://t/", "<table><tr><td>1<td>2<tr><td>3</table>"), (9, "http://q/", "<p title='a>b'>q</p><p a=\"open>r</p>s"),
             (10, "http://l/", "<main>" + "<p>long words</p>" * 20_000 + "</main>"), (11, "http://e/", "<p>&#x41;&eacute;&notreal; &amp;lt;</p>")]
    got = extract(spark, pages)
    assert got[1] == got[2] == got[4] == "" and got[3] == "plain & words" and got[5] == "cut" and got[6] == "deep"
    assert got[7] == "ab\nc d\ne" and got[None] == "x" and got[8] == "1\n2\n3" and got[9].startswith("q")
    assert got[10] == "\n".join(["long words"] * 20_000) and got[11] == "Aé¬real; &lt;"
    assert extract(spark, []) == {}


def test_op11_wrappers_are_union_free():
    pages = ["<ul>" + "<li><a>x</a></li>" * n + "</ul><dl>" + f"<dt>k{n}</dt><dd>v{n}</dd>" * (n + 1) + "</dl>" + ("<p>maybe</p>" if n % 2 else "")
             for n in range(1, 5)]
    whole = hw.page_expression(pages[0])
    for p in pages[1:]:
        whole = hw._merge(whole, hw.page_expression(p))
    text = hw.expression_text(whole)
    assert text == "<ul><li>'%s'</>+</> <dl>(<dt>_</> <dd>_</>)+</> <p>'%s'</>?" % (
        tuple(f"{__import__('xxhash').xxh64_intdigest(t):x}" for t in ("x", "maybe")))
    assert "|" not in text


def test_op11_irregular_sequences_stay_small():
    r = random.Random(9)
    whole = None
    for _ in range(40):
        page = "".join(f"<{t}>w</{t}>" for t in (r.choice(["p", "h2", "h3", "pre", "ul", "blockquote", "table"]) for _ in range(300)))
        own = hw.page_expression(page)
        whole = own if whole is None else hw._merge(whole, own)
    assert len(whole[4]) <= hw.MAX_SEQUENCE and len(hw.expression_text(whole)) < 2_000


def test_op11_order_of_hosts_and_tasks_does_not_matter(spark):
    pages = [(n, f"http://h{n % 3}.example/", DIVS.format(n=n, more="<p>Also</p>" * (n % 4))) for n in range(60)]
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    ways = [table.repartition(1), table.repartition(7), table.orderBy(F.desc("page_id"))]
    found = [{r["page_id"]: hashlib.sha256(r["text"].encode()).hexdigest() for r in hw.extract_main_text(w).collect()} for w in ways]
    assert found[0] == found[1] == found[2]
    readable = hw.wrappers_text(hw.infer_wrappers(table)).collect()
    assert sum(r["pages"] for r in readable) == 60 and len(readable) == 3
