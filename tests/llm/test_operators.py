"""Each operator against brute force on small tables with nulls, empty and long texts, ties,
repeated rows, empty tables and further columns whose names clash with internal ones."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from quirelake.llm import bpe, exact_dedup, fingerprint, html_extract, langid, mixing, ngram_join, quality, suffix_dedup, token_counts
from quirelake.llm.common import shingle_set

SCHEMA = "doc_id long, text string, source string, id string, sha string, node string, slice int, copy boolean, rn int, size double, n int"
WORDS = [f"w{i:x}{i * 7919 % 997:x}" for i in range(400)]


def low(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def make_texts(seed=3):
    rnd = random.Random(seed)
    base = [" ".join(rnd.choices(WORDS, k=rnd.randint(1, 160))) for _ in range(24)]
    long = " ".join(rnd.choices(WORDS, k=9000))
    near = base[0].split()
    near[len(near) // 2] = "other"
    shared = base[1][:260].ljust(260, "x")
    out = base + [long, long.upper(), base[3], base[3], " ".join(near), "", "", None, "a", "A", "é " * 300, "Zz " * 400, "x", shared + base[5], base[6] + shared + "!", "　  \n", "one two three"]
    return out


@pytest.fixture(scope="module")
def rows():
    out = []
    for k, t in enumerate(make_texts()):
        out.append((k if k % 13 else None, t, [None, "b", "a", "ü"][k % 4], "i", "s", "n", 1, True, 2, 0.5, 3))
    return out + [out[5], out[5], out[13], out[13]]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


# -- mixing ---------------------------------------------------------------------------


def share_targets(sizes, weights, total, most=2.0):
    """Targets by weight; none above most times its size, the excess reshared until none is above."""
    target, free = [0.0] * len(sizes), [i for i in range(len(sizes)) if sizes[i] > 0 and weights[i] > 0]
    left = min(float(total), sum(most * sizes[i] for i in free))
    while free:
        unit = left / sum(weights[i] for i in free)
        full = [i for i in free if weights[i] * unit >= most * sizes[i]]
        for i in full or free:
            target[i] = most * sizes[i] if full else weights[i] * unit
            left -= target[i]
        free = [i for i in free if i not in full] if full else []
    return target


def test_targets_share_the_excess(spark):
    assert share_targets([10, 100, 100], [3, 1, 2], 315) == pytest.approx([20, 98.333333, 196.666667])
    rnd = random.Random(2)
    for n in (0, 1, 2, 5, 40, 400):
        sizes, weights = [rnd.choice([0, 1, rnd.randint(1, 10_000)]) for _ in range(n)], [rnd.choice([0.0, 1.0, rnd.random() * 9]) for _ in range(n)]
        for budget in (0.0, 0.5, 1.5, 3.0):
            total = budget * sum(sizes)
            unit = mixing.share_unit(spark.createDataFrame(list(zip(sizes, weights, strict=True)), "size long, weight double"), total, 2.0)
            assert [min(2 * s, w * unit) if s and w else 0.0 for s, w in zip(sizes, weights, strict=True)] == pytest.approx(share_targets(sizes, weights, total))


def test_mix_of_many_sources(spark):
    """More sources than a task, a broadcast or a batch would be given rows for; blocks of two slices."""
    rnd = random.Random(4)
    rows = [(k, "w " * rnd.randint(0, 5), rnd.choice([None, "hot", "hot", f"s{rnd.randint(0, 900)}"])) for k in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mixing.plan_mix(docs, rows_per_slice=16, slices_per_block=2, max_broadcast_bytes=0).collect()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    targets = dict(zip(names, share_targets([sizes[s] for s in names], [(3, 1, 2)[i % 3] for i in range(len(names))], 1.5 * sum(sizes.values())), strict=True))
    taken = dict.fromkeys(names, 0)
    for r in plan:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        taken[r.source] += r.taken
    assert len(plan) == len(rows) and all(abs(taken[s] - targets[s]) <= 5 for s in names)
    assert sorted(map(str, plan)) == sorted(map(str, mixing.plan_mix(docs, rows_per_slice=16).collect()))


def test_mix(docs, rows):
    plan = mixing.plan_mix(docs, rows_per_slice=4).collect()
    sizes = {}
    for r in rows:
        sizes[r[2]] = sizes.get(r[2], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    targets = dict(zip(names, share_targets([sizes[s] for s in names], [(3, 1, 2)[i % 3] for i in range(len(names))], 1.5 * sum(sizes.values())), strict=True))
    assert len(plan) == len(rows)
    taken = {}
    for r in plan:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        assert r.taken <= 2 * r["size"] and len(r.positions) == r.copies and all(0 <= p <= 1 for p in r.positions)
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s in names:
        assert abs(taken[s] - targets[s]) <= max(r["size"] for r in plan if r.source == s)


def test_mix_positions_follow_the_schedule(spark):
    docs = spark.createDataFrame([(i, "a b c d", "s") for i in range(400)], "doc_id long, text string, source string")
    early = mixing.plan_mix(docs, budget=1.0, schedule_of=lambda i, s: [(0.0, 1.0), (1.0, 0.0)], rows_per_slice=50)
    at = sorted(p for r in early.collect() for p in r.positions)
    # weight 1 - t: half of the demand comes before 1 - sqrt(1/2)
    assert len(at) == 400 and at[200] == pytest.approx(1 - 0.5**0.5, abs=0.01)
    order = [r.position for r in mixing.training_order(early, partitions=3).collect()]
    assert order == sorted(order)


def test_mix_reruns_agree_and_empty(docs, none):
    a, b = (sorted(map(str, mixing.mix_documents(d).collect())) for d in (docs, docs.repartition(7)))
    assert a == b
    assert mixing.mix_documents(none).count() == 0


# -- quality --------------------------------------------------------------------------


def quality_rows():
    rnd = random.Random(8)
    out = []
    for i in range(600):
        good = i % 3 > 0
        words = rnd.choices(WORDS, k=rnd.randint(20, 80))
        out.append((i, (" ".join(words) + "." if good else " ".join(w + "###" for w in words)), int(good)))
    return out


def test_quality_held_out(spark):
    rows = quality_rows()
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    truth = {i: q for i, _, q in rows}
    got = quality.score_quality(docs, labels).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == 600 and held
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.97
    assert {r.doc_id for r in quality.keep_quality(docs, labels).collect()} == {r.doc_id for r in got if r.predicted}


def test_flattened_trees_equal_plain_walk():
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 4))
    forest = quality.fit(x, (x[:, 0] + x[:, 1] ** 2 > 0.5).astype(float), trees=12)
    for row, s in zip(x[:50], forest.score(x[:50]), strict=True):
        raw = forest.base
        for node in forest.roots:
            while forest.left[node] >= 0:
                node = forest.left[node] if row[forest.feature[node]] <= forest.threshold[node] else forest.right[node]
            raw += forest.value[node]
        assert s == pytest.approx(1 / (1 + np.exp(-raw)))


def test_statistics_do_not_depend_on_the_batch():
    texts = [(t or "").encode() for t in make_texts()]
    import numpy as np

    whole = quality.statistics(texts)
    assert np.isfinite(whole).all()
    for t, row in zip(texts, whole, strict=True):
        assert quality.statistics([t])[0] == pytest.approx(row)


def test_quality_odd_tables(spark, docs, none):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality.score_quality(docs, labels).collect()} == {0.5}
    assert quality.score_quality(none, labels).count() == 0
    assert quality.keep_quality(docs, labels, threshold=0.4).columns == docs.columns


# -- BPE ------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def codec():
    import public_tokenizers

    return bpe.Codec(bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN)


def test_bpe_as_the_library(docs, rows, codec, none):
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.round_trip_digests(docs).collect())
    want = []
    for r in rows:
        ids = codec.enc.encode_ordinary(r[1] or "")
        want.append((r[0] is None, r[0] or 0, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest()))
    assert got == sorted(want)
    assert bpe.round_trip_digests(none).count() == 0


def test_bpe_pieces_and_long_gaps(codec):
    rnd = random.Random(1)
    for _ in range(200):
        t = "".join(rnd.choices(["a", "bc", " ", "  ", "\n", "'s", "1", "é", "日本", "!!", "\t"], k=rnd.randint(0, 300)))
        assert codec.encode(t, 10) == codec.enc.encode_ordinary(t)
        assert [c for p in bpe.split_safely(t, 10) for c in p] == list(t)
    for t in ("x" + " " * 30000 + "y", "\n" * 20000, "a " * 20000 + "\t" * 12000 + "'s"):
        assert codec.encode(t, 1000) == codec.enc.encode_ordinary(t)
    t = " " * 1_500_000 + "z"  # the library alone gives up on this one
    assert codec.decode(codec.encode(t)) == t.encode()


def test_bpe_ids_and_bytes(docs, rows):
    back = bpe.decode_documents(bpe.encode_documents(docs)).collect()
    assert sorted(bytes(r.bytes) for r in back) == sorted((r[1] or "").encode() for r in rows)


# -- fingerprints ---------------------------------------------------------------------


def keyed_texts(spark, rows):
    """Rows (id, text) in the order of neighbours."""
    df = spark.createDataFrame(rows, "id long, text string").withColumn("text", F.coalesce("text", F.lit("")))
    hashed = [(r.id, r.text, r.th) for r in df.withColumn("th", F.xxhash64("text")).collect()]
    return [(i, t) for i, t, _ in sorted(hashed, key=lambda r: (r[0] is None, -(r[0] or 0), -r[2]))]


def test_neighbours_of_hot_ids(spark, monkeypatch):
    rnd = random.Random(6)
    rows = [(rnd.choice([None, None, 7, k, k, k]), rnd.choice(["same", "", None, f"t{rnd.randint(0, 900)}"])) for k in range(3000)]
    order = keyed_texts(spark, rows)
    want = sorted(map(str, ((i, t, order[(k + 1) % len(order)][1]) for k, (i, t) in enumerate(order))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for ranges, fine, per_slice in ((256, 4096, 8192), (256, 4096, 40), (4, 64, 40), (2, 4, 300)):
        monkeypatch.setattr(fingerprint, "RANGES", ranges)
        monkeypatch.setattr(fingerprint, "FINE", fine)
        got = fingerprint.neighbours(docs, rows_per_slice=per_slice, bytes_per_slice=per_slice << 20).select("id", "text", "next_text").collect()
        assert sorted(str(tuple(r)) for r in got) == want
        rows_ = docs.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("th", F.xxhash64("text")).withColumn("rn", F.rand(1))
        most = fingerprint._sliced(rows_, per_slice, per_slice << 20).groupBy("slice").count().agg(F.max("count")).first()[0]
        assert most <= max(2.5 * per_slice, 6 * 3000 / (ranges * fine)) or per_slice > 3000


def test_fingerprint(spark, rows, none):
    """Sketches of texts, edited texts and next texts against full sets."""
    docs = spark.createDataFrame(rows, SCHEMA)
    got = fingerprint.edited_fingerprints(docs, rows_per_slice=6, bytes_per_slice=6 << 10).collect()
    order = keyed_texts(spark, [(r[0], r[1]) for r in rows])
    want = {}
    for k, (i, t) in enumerate(order):
        after, half = order[(k + 1) % len(order)][1], len(t) // 2
        want.setdefault((i, len(t), hashlib.sha256((t[: len(t) - half] + after[:half]).encode()).hexdigest()), []).append((t, t[: len(t) - half] + after[:half], after))
    assert len(got) == len(rows)
    texts = {x for v in want.values() for y in v for x in y}
    hashes = {r.text: sorted(set(r.h)) for r in spark.createDataFrame([(t,) for t in texts], "text string").select("text", fingerprint.shingle_hashes(F.col("text")).alias("h")).collect()}
    plain = {t: set(shingle_set(t.encode()).tolist()) for t in texts}
    as_text = {r.text: r.s for r in spark.createDataFrame([(t, h[: fingerprint.K]) for t, h in hashes.items()], "text string, s array<long>").select("text", fingerprint.as_text(F.col("s")).alias("s")).collect()}
    share = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    for r in got:
        t, edited, after = want[r.doc_id, r.n_chars, r.edited_sha256].pop()
        assert len(hashes[t]) == len(plain[t])
        assert r.fingerprint == as_text[t] and r.edited_fingerprint == as_text[edited]
        a, b, c = plain[t], plain[edited], plain[after]
        exact = max(len(a | b), len(a | c)) <= fingerprint.K
        assert r.near_edited == pytest.approx(share(a, b), abs=1e-9 if exact else 0.12)
        assert r.near_next == pytest.approx(share(a, c), abs=1e-9 if exact else 0.12)
        assert r.distinct_shingles == pytest.approx(len(a), rel=1e-9 if len(a) < fingerprint.K else 0.2)
        assert r.contained_in_edited == pytest.approx(len(a & b) / len(a) if a else 1.0, abs=1e-9 if exact else 0.2)
    assert fingerprint.edited_fingerprints(none).count() == 0


def test_fingerprint_merges(spark):
    parts = spark.createDataFrame([("g", " ".join(WORDS[k : k + 40])) for k in range(0, 360, 20)], "g string, text string").withColumn("s", fingerprint.sketch(F.col("text"), 32))
    got = fingerprint.merge_all(parts, ["g"], "s", 32).first().s
    every = sorted({h for r in parts.select(fingerprint.shingle_hashes(F.col("text")).alias("h")).collect() for h in r.h})
    assert got == every[:32]
    one = parts.select(fingerprint.containment(F.col("s"), F.col("s"), 32).alias("c")).first().c
    assert one == 1.0


# -- HTML -----------------------------------------------------------------------------


def html_text(html):
    return html_extract.main_text(html_extract.parse(html))


def test_html_blocks():
    html = "<!DOCTYPE html><html><head><title>t</title><script>var a='</p><article>no</article>'</script></head><body><nav><a href='/'>Home</a></nav><div>buy</div>"
    html += "<article><h1>T &amp; <b>U</b></h1><p>one\n two<p><i>three</i>&nbsp;4<br>5<p></p><form><input><p>mail</p></form></article><aside>more</aside><footer>&copy; x</footer></body></html>"
    assert html_text(html) == "T & U\none two\nthree 4 5"


def test_html_names_are_not_read():
    for part in ("<h2 id='related-work'>Work</h2>", "<section id='discussion'><p>Work</p></section>", "<h2 id='social-impact'>Work</h2>", "<p class='notice-period'>Work</p>", "<h2 id='share-price'>Work</h2>", "<p><math><mi>Work</mi></math></p>", "<p><label>Work</label></p>", "<fieldset><p>Work</p></fieldset>"):
        assert html_text(f"<body><article><h1>Title</h1>{part}<p>end</p></article></body>") == "Title\nWork\nend", part


def op5_pages(spark, pages, **options):
    df = spark.createDataFrame([(i, f"https://h.example.org/{i}", t) for i, t in enumerate(pages)], "page_id long, url string, html string").repartition(4)
    return [r.text for r in sorted(html_extract.extract_main_text(df, **options).collect(), key=lambda r: r.page_id)]


def test_html_comments_and_links_are_captioned_records(spark):
    def html(i):
        comments = "".join(f"<div><b>user {i}{k}</b><p>I say {i * k}</p></div>" for k in range(i % 4))
        links = "".join(f"<li><a href='/{k}'>see {i + k}</a></li>" for k in range(3))
        more = "<section><h2>Methods</h2>" + "".join(f"<p>step {i} {k}</p>" for k in range(2)) + f"<table><tr><td>x</td><td>{i}</td></tr></table></section>"
        return f"<body><article><h1>Story {i}</h1><p>Text {i} of the story</p>{more}<section><h3>{i % 4} comments</h3>{comments}</section><div><h3>Related</h3><ul>{links}</ul></div></article></body>"

    got = op5_pages(spark, [html(i) for i in range(16)])
    for i, t in enumerate(got):
        want = f"Story {i}\nText {i} of the story\nMethods\nstep {i} 0\nstep {i} 1\nx\n{i}"
        assert t == want, i


def test_html_equals_the_article_on_all_pages(spark):
    sf = "/root/testdata/sf0.01"
    html = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = {r.page_id: r for r in html_extract.op5_html(spark, sf).collect()}
    assert set(got) == set(html)
    off = 0
    for i, h in html.items():
        want = "\n".join(html_extract.blocks(html_extract.parse(h[h.index("<article>") : h.index("</article>")])))
        assert got[i].text == want and got[i].n_chars == len(want)
        off += want != "\n".join(html_extract.blocks(html_extract.parse(h)))  # without a wrapper
    assert off == len(html)


def test_html_induction_finds_the_template(spark):
    # no element tells the article here: only what varies over the host's pages is content
    html = "<html><body><div><p>Welcome to our site</p></div><div><p>{}</p><p>{}</p></div><div><p>All rights reserved</p></div></body></html>"
    pages = [(i, f"https://h.example.org/{i}", html.format(f"Story {i}", f"Body {i * 7}"), "x", 1) for i in range(20)]
    pages += [(100, "https://one.example.org/", html.format("A", "B"), "x", 1), (101, None, None, "x", 1), (102, "nonsense", "", None, None), (103, "//u@h.example.org:80/z", "<p>Welcome", "x", 1), (0, "https://h.example.org/0", html.format("Story 0", "Body 0"), "x", 1)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, ref string, host int").repartition(4)
    for limit in (16 << 20, 0):
        got = html_extract.extract_main_text(df, max_broadcast_bytes=limit).collect()
        assert len(got) == len(pages)
        text = {r.page_id: r.text for r in got}
        assert all(text[i] == f"Story {i}\nBody {i * 7}" for i in range(20))
        assert text[100] == "Welcome to our site\nA\nB\nAll rights reserved"  # a host of one page has no template
        assert text[101] == text[102] == "" and text[103] == "Welcome"
    assert html_extract.extract_main_text(df.limit(0)).count() == 0


def test_html_copies_are_one_page(spark):
    # copies of one story make nine tenths of a host; only what other stories have too is its template
    html = "<html><head><link href='{0}'></head><body><div><p>Welcome</p></div><{3}><p>{1}</p><p>{2}</p></{3}><div class='ad'>{0}</div></body></html>"
    for tag, copies in (("div", 90), ("article", 180)):
        pages = [(i, f"https://h.example.org/{i}", html.format(i, "Copied story", "Its body", tag)) for i in range(copies)]
        pages += [(1000 + i, f"https://h.example.org/{1000 + i}", html.format(i, f"Story {i}", f"Body {i}", tag)) for i in range(10)]
        text = {r.page_id: r.text for r in html_extract.extract_main_text(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(4)).collect()}
        assert len(text) == len(pages)
        assert {text[i] for i in range(copies)} == {"Copied story\nIts body"}
        assert all(text[1000 + i] == f"Story {i}\nBody {i}" for i in range(10))


def test_html_small_hosts_have_templates(spark):
    html = "<html><body><div><p>Welcome {0}</p></div><{3}><p>{1}</p><p>{2}</p><p>Share this</p></{3}></body></html>"
    pages = []
    for n in (1, 2, 3, 5, 6, 7, 8, 12):
        for tag in ("div", "article"):
            pages += [(1000 * n + 100 * (tag == "div") + i, f"https://{tag}{n}.example.org/{i}", html.format(n, f"Story {i}", f"Body {i}", tag)) for i in range(n)]
    pages += [(20 + i, f"https://odd.example.org/{i}", html.format(0, "Same" if i < 2 else "Other", f"Body {i}", "div")) for i in range(3)]
    text = {r.page_id: r.text for r in html_extract.extract_main_text(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(4)).collect()}
    for n in (2, 3, 5, 6, 7, 8, 12):
        for i in range(n):
            assert text[1000 * n + 100 + i] == text[1000 * n + i] == f"Story {i}\nBody {i}" + "\nShare this" * (n < 6)  # few pages don't prove it in the slot
    assert text[1100] == text[1000] == "Story 0\nBody 0\nShare this"  # hosts of one page share a template
    assert [text[20 + i] for i in range(3)] == [f"{t}\nBody {i}\nShare this" for i, t in enumerate(["Same", "Same", "Other"])]


def test_html_odd_markup():
    deep = "<div>" * 20_000 + "x"
    a, b = html_extract.parse(deep + "</div>" * 19_000 + "<p>y"), html_extract.parse(deep)
    assert html_extract.main_text(a) == "x\ny" and html_extract.main_text(b) == "x"
    assert len(html_extract.match(a, b)) == 20_001
    assert html_extract.main_text(html_extract.parse("<p>word " * 100_000)).count("\n") == 99_999
    for t in ("<", "<p", "a<b", "<!--", "<script>", "</", "<p class='", "a &lt; b &#x41; &bogus;"):
        html_text(t)
    assert html_text("a &lt;b&gt; &#x41;") == "a <b> A"


def test_tree_matching_is_maximal():
    a = html_extract.parse("<div><ul><li>1<li>2</ul><p>x</p><p>y</p></div>")
    b = html_extract.parse("<div><p>x</p><ul><li>1</ul><p>z</p></div>")
    # root, div, ul, li, one p
    assert len(html_extract.match(a, b)) == 5


def plain_matching(x, y):
    if x.key != y.key:
        return 0
    best = [[0] * (len(y.kids) + 1) for _ in range(len(x.kids) + 1)]
    for i, a in enumerate(x.kids, 1):
        for j, b in enumerate(y.kids, 1):
            best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + plain_matching(a, b))
    return 1 + best[-1][-1]


def random_tree(rng, depth, most):
    x = html_extract.Node("p", rng.choice("abc"))
    x.kids = [random_tree(rng, depth - 1, most) for _ in range(rng.randrange(most) if depth else 0)]
    return x


def test_tree_matching_equals_the_plain_table():
    rng = random.Random(3)
    for _ in range(150):
        a, b = (random_tree(rng, 3, 6) for _ in range(2))
        a.key = b.key = "r"
        for cells in (1, 12, 1 << 20):
            found = html_extract.match(a, b, cells)
            assert len(found) == plain_matching(a, b)
            assert all(x.key == y.key for x, y in found) and len({id(x) for x, _ in found}) == len({id(y) for _, y in found}) == len(found)
            assert {(id(x), id(y)) for x, y in found} == {(id(x), id(y)) for x, y in html_extract.match(a, b)}


def test_long_lists_are_aligned_whole():
    def tree(n):
        kinds = ("<p>one <b>{}</b></p>", "<p><i>{}</i> two <a>x</a></p>", "<p>three</p>")
        return html_extract.parse(f"<body>{''.join(kinds[k % 3].format(k) for k in range(n))}<div><span>All rights</span><h5>reserved {n}</h5></div><h6>end<b>x</b><i>{'y' * n}</i></h6>{'<ul><li>z</ul>' * (n > 100)}</body>")

    for n, m in ((160, 60), (60, 160), (101, 20), (230, 231)):
        a, b = tree(n), tree(m)
        found = html_extract.match(a, b)
        assert {"div", "span", "h5", "h6"} <= {x.tag for x, _ in found}
        assert len(found) == plain_matching(a, b) == len(html_extract.match(a, b, 50))


# -- token counts ---------------------------------------------------------------------


def test_edits_equal_counting_anew(codec):
    import public_tokenizers

    rnd = random.Random(5)
    counter = token_counts.Counter(codec, public_tokenizers.PATTERN)
    alphabet = ["a", "bc", "'", "ll", "s", " ", "  ", "\n", "\t", "1", "23", ".", "!!", "é", "日", "the ", "'re", "'ve"]
    mk = lambda k: "".join(rnd.choices(alphabet, k=k))
    for _ in range(800):
        tree = token_counts.CountTree(mk(rnd.randint(0, 60)), counter, leaf=rnd.choice([1, 2, 3, 8, 64]))
        for _ in range(4):
            s = rnd.randint(0, len(tree.text) + 3)
            tree.edit(s, s + rnd.choice([0, 0, 1, 2, 5, 30]), mk(rnd.choice([0, 0, 1, 2, 3, 20])))
            assert tree.tokens == len(codec.encode(tree.text)) and tree.tree[1][2] == len(tree.text)


def test_edit_is_local(codec):
    import public_tokenizers

    tree = token_counts.CountTree("word " * 50_000, token_counts.Counter(codec, public_tokenizers.PATTERN))
    tree.edit(100_000, 100_003, "new")
    assert tree.encoded < 10 and tree.tokens == len(codec.encode(tree.text))


def test_stored_trees(spark, docs, rows, codec, monkeypatch):
    import public_tokenizers

    counter = token_counts.Counter(codec, public_tokenizers.PATTERN)
    tree = token_counts.CountTree("some words here " * 900, counter, leaf=8)
    tree.edit(5000, 5003, "new")
    asked = []
    count = token_counts.Counter.count
    monkeypatch.setattr(token_counts.Counter, "count", lambda self, piece: asked.append(piece) or count(self, piece))
    again = token_counts.CountTree(tree.text, token_counts.Counter(codec, public_tokenizers.PATTERN), stored=tree.packed())
    assert not asked and (again.tree, again.leaves, again.counts, again.leaf) == (tree.tree, tree.leaves, tree.counts, 8)
    again.edit(9000, 9001, "zz")
    assert len(asked) == again.encoded < 10 and again.tokens == len(codec.encode(again.text))
    monkeypatch.undo()
    edit = lambda k: F.array(F.struct(F.lit(k).alias("start"), F.lit(k + 1).alias("stop"), F.lit("é!").alias("new")))
    trees = token_counts.build_trees(docs, leaf=4)
    assert sorted(r.n_tokens for r in trees.collect()) == sorted(len(codec.encode(r[1] or "")) for r in rows)
    once = token_counts.apply_edits(trees.withColumn("e", edit(2)), edits_col="e").select("doc_id", "text", "tree", F.col("edited_tokens").alias("was"))
    got = token_counts.apply_edits(once.withColumn("e", edit(9)), edits_col="e").collect()
    texts = [t[:9] + "é!" + t[10:] for t in ((r[1] or "")[:2] + "é!" + (r[1] or "")[3:] for r in rows)]
    assert sorted((r.text, r.edited_tokens) for r in got) == sorted((t, len(codec.encode(t))) for t in texts)
    assert all(r.reencoded < 40 or len(r.text) < 400 for r in got)
    none = token_counts.apply_edits(once.withColumn("tree", F.lit(None).cast("binary")).withColumn("e", edit(9)), edits_col="e").collect()
    assert sorted((r.text, r.edited_tokens) for r in none) == sorted((r.text, r.edited_tokens) for r in got)


def test_token_counts_query(docs, rows, codec, none):
    edits = F.array(F.struct(F.lit(2).alias("start"), F.lit(5).alias("stop"), F.lit("é!").alias("new")), F.lit(None).cast("struct<start int, stop int, new string>"))
    got = token_counts.count_edited(docs.withColumn("edits", edits), edits_col="edits").collect()
    want = sorted((len(t), len(codec.encode(t)), len(codec.encode(t[:2] + "é!" + t[5:]))) for t in ((r[1] or "") for r in rows))
    assert sorted((r.n_chars, r.n_tokens, r.edited_tokens) for r in got) == want
    assert token_counts.count_edited(none.withColumn("edits", edits), edits_col="edits").count() == 0


# -- language ID ----------------------------------------------------------------------


def test_language(spark):
    rnd = random.Random(2)
    vocabulary = {"aa": ["kata", "tomo", "nari", "suko"], "bb": ["gwyll", "llyn", "ffordd", "cwm"]}
    mk = lambda x, k: " ".join(rnd.choices(vocabulary[x], k=k))
    docs = spark.createDataFrame([(i, mk("ab"[i % 2] * 2, 30), "ab"[i % 2] * 2) for i in range(60)] + [(None, "x", "aa"), (99, "y", None)], "doc_id long, text string, lang string")
    names, table = langid.train(docs, id_col="doc_id", text_col="text", lang_col="lang", max_train_rows=40)
    assert names == ["aa", "bb"]
    pages = [(i, f"https://h{i % 2}.example.{'aa' if i % 2 == 0 else 'bb'}/", f"<html lang='{'ab'[i % 2] * 2}-XX'><body><p>{mk('ab'[i % 2] * 2, 12)}</p><script>gwyll</script></body>", "z") for i in range(40)]
    # no text: the host decides; a wrong declaration loses against text and host
    pages += [(100, "https://h1.example.bb/e", "<html><body></body></html>", "z"), (101, "https://h0.example.aa/f", f"<html lang=bb><body>{mk('aa', 20)}", "z"), (102, None, None, None), (102, None, None, None)]
    records = langid.page_records(spark.createDataFrame(pages, "page_id long, url string, html string, ll string"))
    got = {r.id: r for r in langid.identify(records, names, table).collect()}
    assert all(got[i].lang == "ab"[i % 2] * 2 for i in range(40))
    assert got[100].lang == "bb" and got[101].lang == "aa" and got[101].declared == "bb" and 0 < got[102].prob <= 1
    assert langid.identify(records, names, table).count() == len(pages)
    none = langid.train(docs.where("false"), id_col="doc_id", text_col="text", lang_col="lang", max_train_rows=40)
    assert {(r.lang, r.prob) for r in langid.identify(records, *none).collect()} == {(None, 0.0)}
    assert langid.identify(records.where("false"), names, table).count() == 0


# -- exact dedup ----------------------------------------------------------------------


@pytest.mark.parametrize("full", [False, True])
def test_exact(docs, rows, full, monkeypatch):
    if full:  # a filter that is full lets all rows through
        monkeypatch.setattr(exact_dedup, "repeated_filter", lambda *a: lambda c: F.lit(True))
    groups = {}
    for r in rows:
        groups.setdefault(hashlib.sha256(low(r[1] or "").encode()).hexdigest(), []).append(r[0])
    got = exact_dedup.duplicate_groups(docs).collect()
    assert len(got) == len(rows)
    kept = {}
    for r in got:
        ids = groups[r.text_sha256]
        assert r.group_size == len(ids) and r.keep_id == max((i for i in ids if i is not None), default=None)
        if r.kept:
            assert r.doc_id == r.keep_id
            kept[r.text_sha256] = kept.get(r.text_sha256, 0) + 1
    assert kept == dict.fromkeys(groups, 1)
    left = exact_dedup.drop_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted(hashlib.sha256(low(r.text or "").encode()).hexdigest() for r in left.collect()) == sorted(groups)


def test_suspects_hold_all_repeats(spark):
    rnd = random.Random(5)
    hashes = [rnd.randrange(-(1 << 63), 1 << 63) for _ in range(6000)]
    rows = hashes + hashes[:300] + hashes[:40] * 5 + [hashes[0]] * 3000
    df = spark.createDataFrame([(h,) for h in rows], "h long").repartition(7)
    for cells in (1 << 25, 1 << 14, 1 << 10):
        found = {r.h for r in exact_dedup.suspects(df, len(rows), part_cells=cells).collect()}
        assert set(hashes[:300]) <= found <= set(hashes)
        assert len(found) < 400 or cells < 1 << 14
    for limit in (32 << 20, 64):
        maybe = exact_dedup.repeated_filter(df, len(rows), max_filter_bytes=limit)
        kept = {r.h for r in df.where(maybe("h")).collect()}
        assert set(hashes[:300]) <= kept and (len(kept) < 500 or limit == 64)


def test_one_of_very_many_equal_rows(spark):
    docs = spark.createDataFrame([(None if k % 3 else 7, "Same" if k % 2 else "same") for k in range(3000)] + [(1, "other")], "doc_id long, text string").repartition(5)
    got = exact_dedup.duplicate_groups(docs).collect()
    assert len(got) == 3001 and sum(r.kept for r in got) == 2 and {r.group_size for r in got} == {3000, 1} and all(r.doc_id == r.keep_id for r in got if r.kept)
    assert sorted(r.doc_id for r in exact_dedup.drop_duplicates(docs).collect()) == [1, 7]


def test_exact_empty(none):
    assert exact_dedup.duplicate_groups(none).count() == 0
    assert exact_dedup.drop_duplicates(none).count() == 0


# -- n-gram join ----------------------------------------------------------------------


def brute_links(texts, threshold=0.8):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", low(t or ""))
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    return [[j for j in range(len(sets)) if j != i and sets[i] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j])] for i in range(len(sets))]


def families(seed, n_base=6, copies=14):
    rnd = random.Random(seed)
    out = []
    for _ in range(n_base):
        w = rnd.choices(WORDS, k=80)
        for k in range(copies):
            v = list(w)
            for _ in range(k % 5):
                v[rnd.randrange(len(v))] = rnd.choice(WORDS)
            out.append(" ".join(v))
    return out


@pytest.mark.parametrize("block", [1024, 5])
def test_ngram_join(spark, rows, block):
    texts = [r[1] for r in rows] + families(4)
    links = brute_links(texts)
    docs = spark.createDataFrame([(i, t, "n", 1) for i, t in enumerate(texts)], "doc_id long, text string, node string, copies int").repartition(3)
    got = {r.doc_id: r for r in ngram_join.near_duplicates(docs, block=block).collect()}
    assert len(got) == len(texts)
    seen = {}

    def reach(i):
        found, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in found:
                    found.add(j)
                    todo.append(j)
        return found

    for i in range(len(texts)):
        seen = reach(i)
        assert (got[i].class_id, got[i].class_size, got[i].n_links) == (min(seen), len(seen), len(links[i])), i
    left = ngram_join.drop_near_duplicates(docs, block=block)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted({min(reach(i)) for i in range(len(texts))})


def test_components_of_stars_and_chains(spark):
    rnd = random.Random(7)
    edges = [(f"s{0:04}", f"s{k:04}") for k in range(1, 400)] + [(f"c{k:04}", f"c{k + 1:04}") for k in range(300)]
    edges += [(f"r{rnd.randrange(300):04}", f"r{rnd.randrange(300):04}") for _ in range(220)] + [("s0399", "t0000"), ("a", "a")]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    df = spark.createDataFrame([(a.encode(), b.encode()) for a, b in edges], "u binary, v binary").repartition(3)
    got = {bytes(r.node).decode(): bytes(r.root).decode() for r in ngram_join.components(df).collect()}
    assert got == {x: find(x) for x in root}


def test_ngram_join_odd_ids(docs, rows, none):
    got = ngram_join.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    links = brute_links([r[1] for r in rows])
    assert sorted(r.n_links for r in got) == sorted(map(len, links))
    assert ngram_join.near_duplicates(none).count() == 0
    left = ngram_join.drop_near_duplicates(docs)
    assert left.columns == docs.columns and ngram_join.drop_near_duplicates(none).count() == 0
    ids = [r.doc_id for r in left.collect() if r.doc_id is not None]
    assert len(ids) == len(set(ids))


def test_band_shape_keeps_its_recall():
    for t in (0.5, 0.7, 0.8, 0.9):
        bands, rows = ngram_join.band_shape(t)
        assert 1 - (1 - t**rows) ** bands >= 0.9995 and bands * rows <= 160


# -- suffix dedup ---------------------------------------------------------------------


def test_deep_shallow_sort():
    rnd = random.Random(1)
    for _ in range(200):
        alphabet = rnd.choice([b"ab", b"abc", bytes(range(256))])
        prefix = bytes(rnd.choices(alphabet, k=rnd.randint(0, 30)))
        items = list({prefix + bytes(rnd.choices(alphabet, k=rnd.randint(0, 40))) for _ in range(rnd.randint(2, 40))})
        assert [items[i] for i in suffix_dedup.deep_shallow_sort(items, 0, rnd.choice([0, 8, 24]))] == sorted(items)
    assert [int(i) for i in suffix_dedup.deep_shallow_sort([b"b", b"a", b"b"], 0, 8)] in ([1, 0, 2], [1, 2, 0])


def brute_cut(texts, length):
    from collections import Counter

    data = [(t or "").encode() for t in texts]
    times = Counter(d[k : k + length] for d in data for k in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = [False] * len(d)
        for k in range(len(d) - length + 1):
            if times[d[k : k + length]] > 1:
                gone[k : k + length] = [True] * length
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((len(d), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(d, gone, strict=True) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("limit", [100_000, 2])
@pytest.mark.parametrize(("length", "gram"), [(200, 64), (40, 16), (12, 3)])
def test_suffix_dedup(spark, docs, rows, length, gram, limit):
    def result(df):
        return sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(df, length=length, gram=gram, group_limit=limit).collect())

    assert result(docs) == sorted(brute_cut([r[1] for r in rows], length))
    rnd = random.Random(length)
    pool = ["".join(rnd.choices("abé", k=rnd.randint(5, 90))) for _ in range(12)]
    texts = ["".join(rnd.choices(pool, k=rnd.randint(0, 9))) for _ in range(40)] + ["ab" * 300, "a" * 500]
    assert result(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)) == sorted(brute_cut(texts, length))


def test_suffix_dedup_hot_grams(spark, docs, rows, monkeypatch):
    """All grams dealt by context as well."""
    monkeypatch.setattr(suffix_dedup, "_hot_grams", lambda texts, emit, share: [r.gram for r in texts.mapInArrow(emit, suffix_dedup.ANCHOR).select("gram").distinct().collect()])
    for limit in (100_000, 2):
        got = suffix_dedup.remove_repeats(docs, length=40, gram=16, group_limit=limit).collect()
        assert sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(brute_cut([r[1] for r in rows], 40))


def test_hot_grams_are_few(spark):
    texts = spark.createDataFrame([(k, f"{'common line ' * 20} {k}") for k in range(4000)], "id long, text string")
    keyed = suffix_dedup._keyed(texts, "id", "text").select("k1", "k2", "text")
    assert 0 < len(suffix_dedup._hot_grams(keyed, suffix_dedup._emit_anchors(40, 16), 50)) < 50


@pytest.mark.parametrize("limit", [100_000, 2])
def test_suffix_dedup_shuffles_texts_once(spark, docs, rows, tmp_path, limit):
    docs.select("doc_id", "text").write.parquet(str(tmp_path / "documents"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # else so small a table is broadcast
    try:
        got = suffix_dedup.remove_repeats(spark.read.parquet(str(tmp_path / "documents")), length=40, gram=16, group_limit=limit)
        assert sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect()) == sorted(brute_cut([r[1] for r in rows], 40))
        plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "== Final Plan ==" in plan
    assert plan.count("FileScan parquet") == 1  # reused exchanges are named without what is below them


def test_suffix_dedup_empty(none):
    assert suffix_dedup.remove_repeats(none).count() == 0
