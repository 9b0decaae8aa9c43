"""Page text, archives, languages, neighbours and the pipeline."""

import base64
import gzip
import hashlib
import os
import random
import time
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from statloom.llm import ann, html_text, language, warc
from test_dedup import SPACE, plain_classes, plain_fingerprint
from test_mix_shard_pack import plain_targets
from tests_llm_rows import CLASH, odd_documents, words

FOLDER = "/root/testdata/sf0.001"
given = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test data not present")

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>if(a<b){"<p>x</p>"}</script></head>
<body class="has-sidebar"><header><h1>Site</h1></header><div role="navigation"><a href=x>Home</a></div><main>
<article class="post"><header class="article-header"><h1>Caf&eacute; &#233; &lt;b&gt;</h1></header><p>Short.
<p class="ad">Buy now<p>More \t text<br>after br</p><!-- <p>gone</p> --><ul><li>one<li class="comment">bad<li>two</ul>
<aside>side</aside><section id="comments"><p>c1</section><p>End<form>mail</form></article></main>
<div class="cookie-banner">Cookies</div><footer>f</footer>"""


def test_page_text():
    tree = html_text.grow(*html_text.labelled_blocks())
    assert html_text.main_text(PAGE, tree) == "Café é <b>\nShort.\nMore text after br\none\ntwo\nEnd"
    x, y = html_text.labelled_blocks()
    assert (html_text.is_main(tree, x) == y).mean() > 0.95
    for page in (None, "", "<", "<p", "<!--", "<script>", "&amp", "</p></div>", "<a '" * 50_000, "<div>" * 5_000):
        assert isinstance(html_text.main_text(page, tree), str)
    long = "<article>" + "<p>word word</p>" * 50_000
    assert html_text.main_text(long, tree).count("\n") == 49_999


TEXT = ("<p>The first paragraph has quite a few words in it so that it counts as text.</p>"
        "<p>The second paragraph too goes on and on about the river.</p>")
PLAIN = ("The first paragraph has quite a few words in it so that it counts as text.\n"
         "The second paragraph too goes on and on about the river.")


@pytest.mark.parametrize("page", [
    f'<form id="aspnetForm"><nav>Menu here</nav><article>{TEXT}</article><footer>f</footer></form>',
    f'<div class="page has-sidebar sidebar-right"><article>{TEXT}</article>'
    '<div class="sidebar"><article><p>teaser</p></article></div></div>',
    f'<div id="page" class="site social"><main>{TEXT}</main></div>',
    f'<div class="modal-open no-overlay cookie"><article>{TEXT}</article></div>',
    f'<article><svg class="i"/>{TEXT}</article>',
    f'<article><svg><text>drawn</text></svg>{TEXT}</article>',
    f'<article><iframe src=v />{TEXT}</article>',
    f'<article><iframe src=v>{TEXT}</article>',
    f"<article><svg-icon></svg-icon><title-card></title-card>{TEXT}</article>",
    f'<article><section class="related-work" id="search-engines">{TEXT}</section>'
    '<div class="related-posts"><p>Other posts</p></div></article>',
    f'<article>{TEXT}</article><div class="comments"><article class="comment"><p>I like this text so very much'
    " that I read it again</p></article></div>",
    f'<main>{TEXT}<div id="comments"><article><p>I like it so very much indeed and more</p></article></div></main>',
    f"<main><form><h2 hidden>x</h2>{TEXT.replace('</p>', '</p><p></p>')}</form></main>",
])
def test_page_layouts(page):
    assert html_text.main_text(page, html_text.grow(*html_text.labelled_blocks())) == PLAIN


def test_long_broken_pages():
    tree = html_text.grow(*html_text.labelled_blocks())
    start = time.process_time()
    for page in ("<div>" * 70_000 + "</section>" * 70_000, "<svg>" * 200_000, "<title>" * 150_000, "<form><article>" * 60_000):
        assert html_text.main_text(page + "<p>x", tree) is not None
    assert time.process_time() - start < 20


def test_what_markup_tells_is_kept():
    tree = html_text.grow(*html_text.labelled_blocks())
    rng = np.random.default_rng(0)
    x = np.column_stack([rng.choice(v, 5_000) for v in ([1, 2, 3, 5, 9, 20, 80, 300], [0, 0, 0.06, 0.1, 0.5, 1]) * 5]
                        + [np.ones(5_000), rng.integers(0, 2, 5_000)])
    assert html_text.is_main(tree, x).all()
    x[:, -2] = -1
    assert not html_text.is_main(tree, x).any()


@pytest.mark.parametrize("with_place,least", [(True, 0.95), (False, 0.8)])
def test_tree_on_held_out_pages(with_place, least):
    pages, right, total = html_text.labelled_pages(), 0, 0
    for fold in range(5):
        x, y = (np.concatenate(c) for c in zip(*(p for i, p in enumerate(pages) if i % 5 != fold)))
        z, w = (np.concatenate(c) for c in zip(*pages[fold::5]))
        if not with_place:
            x[:, -2] = z[:, -2] = 0
        right, total = right + (html_text.is_main(html_text.grow(x, y), z) == w).sum(), total + len(w)
    assert right / total > least


def test_page_rows(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (None, None, None, None), (2, "v", "", "y")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_text.extract(table)
    assert got.columns == ["page_id", "url", "html", "text", "n_chars"]
    assert sorted((r.n_chars, len(r.text)) for r in got.collect()) == [(0, 0), (0, 0), (48, 48), (48, 48)]
    assert html_text.extract(table.limit(0)).collect() == []


def test_loser_tree_merges_runs():
    r = random.Random(5)
    for _ in range(200):
        runs = [sorted(r.randint(0, 9) for _ in range(r.randint(0, 12))) for _ in range(r.randint(0, 7))]
        got = [(runs[k][i], k, i) for k, i in warc.loser_tree_merge(runs)]
        assert got == sorted((x, k, i) for k, run in enumerate(runs) for i, x in enumerate(run))


def test_url_keys():
    assert warc.url_key("https://WWW.Example.com:8080/a?b=1#c") == "com,example:8080)/a?b=1"
    assert [warc.url_key(u) for u in (None, "", "no host", "http://[bad")] == ["", "", "no host", "http://[bad"]


@pytest.mark.parametrize("min_bytes", [0, 10])
def test_archives_round_trip(spark, tmp_path, monkeypatch, min_bytes):
    tricky = "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n\x00é\U0001f600"
    payloads = [tricky, tricky, None, "", "tiny", "tiny", words(3, 20_000), *(f"page {i % 20}" * 3 for i in range(60))]
    rows = [(i, f"https://h{i % 3}.example.org/p{i % 7}\r\nX: y", p, "x") for i, p in enumerate(payloads)]
    rows += [(None, None, "no id", None), (3, rows[3][1], "", "x")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, sha string").repartition(3)
    monkeypatch.setattr(warc, "MERGE_ROWS", 20)
    warc.write_archives(table, str(tmp_path / "w"), min_bytes=min_bytes, archive_bytes=30_000)
    files = [p for p in os.listdir(tmp_path / "w") if p.endswith(".gz")]
    assert len(files) > 1
    with gzip.open(tmp_path / "w" / files[0]) as f:
        assert list(warc.parse(f.read()))
    got = warc.read_archives(spark, str(tmp_path / "w")).orderBy("order_no").collect()
    bodies = {}
    for i, _, p, _ in rows:
        bodies.setdefault((p or "").encode(), []).append(-1 if i is None else i)
    expected = Counter()
    for i, _, p, _ in rows:
        body = (p or "").encode()
        first = max(bodies[body])
        again = len(body) >= min_bytes and (-1 if i is None else i) != first
        sha = base64.b32encode(hashlib.sha1(body).digest()).decode()
        expected[i, len(body), sha, "revisit" if again else "response", first if again else None] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == expected
    assert [r.order_no for r in got] == list(range(len(rows)))
    keys = [(r.url_key, r.captured_at) for r in got]
    assert keys == sorted(keys)
    warc.write_archives(table.limit(0), str(tmp_path / "none"))
    assert warc.read_archives(spark, str(tmp_path / "none")).count() == 0


def plain_phrases(text, reference):
    count = 0
    for at in range(0, len(text), language.PIECE):
        part, i = text[at:at + language.PIECE], 0
        while i < len(part):
            j = i + 1
            while j <= len(part) and part[i:j] in reference:
                j += 1
            count += 1
            i = max(i + 1, j - 1)
    return count


def test_cross_parsing_is_greedy_longest_match():
    model = language.Model(("aa", "bb"), (words(1, 300, "abcd"), words(2, 300, "cdef")))
    parser = language.Parser(model)
    for text in (words(3, 900, "abcd"), words(4, 40, "abcdefgh"), "xyz", "a", words(5, 700, "cdez")):
        points = language.code_points(text)
        plain = "".join(map(chr, points.tolist()))
        assert parser.phrases([points])[0].tolist() == [plain_phrases(plain, t) for t in model.texts]
    assert language.classify([words(8, 50, "abcd"), words(9, 50, "cdef")], model)[0] == ["aa", "bb"]


@pytest.mark.parametrize("cells", [language.__dict__.get("DENSE_CELLS", 0), 0])
def test_rare_scripts_are_told_apart(monkeypatch, cells):
    """Many letters of a big script leave two small ones their own."""
    monkeypatch.setattr(language, "DENSE_CELLS", cells, raising=False)
    big = "".join(chr(0x4E00 + i % 90) + " " * (i % 7 == 0) for i in range(18_000))
    greek, cyrillic = "αβγδεζηθικλμ", "абвгдежзиклм"
    model = language.Model(("el", "ru", "zh"), (words(1, 60, greek), words(1, 60, cyrillic), big))
    texts = [words(2, 40, greek), words(2, 40, cyrillic), big[500:900]]
    assert language.classify(texts, model)[0] == ["el", "ru", "zh"]
    points = [language.code_points(t) for t in texts]
    plain = ["".join(map(chr, p.tolist())) for p in points]
    assert language.Parser(model).phrases(points).tolist() == [
        [plain_phrases(t, reference) for reference in model.texts] for t in plain]


def test_shared_openings_and_copies_do_not_fill_the_sample(spark):
    opening = "licence " * 60
    rows = [(i, opening + words(i, 3_000, "abcd"), "aa") for i in range(60)]
    rows += [(100 + i, "copy " * 100, "aa") for i in range(300)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(table)
    text = model.texts[0]
    assert len(text) > 20_000 and text.count("licence") * 8 < len(text) / 10
    assert text.count("copy") * 5 <= language.SAMPLE_CHARS


def test_the_sample_does_not_depend_on_how_many_rows_are_drawn(spark, monkeypatch):
    rows = [(i, "xy"[i % 2], f"text {'abcdefghij'[i % 10]} {'klmnopqrst'[i // 10 % 10] * 9}") for i in range(600)]
    docs = spark.createDataFrame([*rows, (None, "x", "no id"), (1, None, "none"), (2, "z", None)],
                                 "doc_id long, lang string, text string")
    monkeypatch.setattr(language, "SAMPLE_DOCS", 30)
    models = []
    for drawn in (0.5, 1000):
        monkeypatch.setattr(language, "DRAWN", drawn)
        models.append(language.fit(docs))
    assert models[0] == models[1] and models[0].languages == ("x", "y")


def test_language_of_odd_rows(odd, none):
    model = language.fit(odd)
    got = language.identify(odd, model)
    assert got.columns == [c for c in odd.columns if c not in ("lang_pred", "score")] + ["lang_pred", "score"] or set(
        got.columns) == set(odd.columns)
    for r in got.select("text", "lang_pred", "score").collect():
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and 0 <= float(r.score) <= 1
    empty = language.fit(none)
    assert empty.languages == ()
    assert {r.lang_pred for r in language.identify(odd, empty).collect()} == {"und"}
    assert language.identify(none, model).collect() == []


@given
def test_held_out_accuracy(spark):
    from statloom.llm.registry import QUERIES

    got = QUERIES["op4_language_id"](spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = got.filter("held_out").join(docs, "doc_id").collect()
    assert len(rows) > 200 and np.mean([r.lang == r.lang_pred for r in rows]) > 0.98


def brute(ids, vectors, asks, top):
    out = {}
    for q in asks:
        scores = vectors @ vectors[ids.index(q)]
        order = sorted((i for i in range(len(ids)) if ids[i] != q), key=lambda i: (-scores[i], ids[i]))[:top]
        out[q] = [ids[i] for i in order]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append(r)
    return out


def test_few_vectors_are_found_whole(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0]) for i in range(60)] + [(100 + i, [0.5, float(i)]) for i in range(5)]
    bad = [(200, None), (201, []), (202, [0.0, 0.0]), (203, [nan, 1.0]), (204, [inf, 1.0]), (205, [None, 1.0]),
           (None, [1.0, 1.0]), (206, [1.0, 2.0, 3.0])]
    table = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").withColumn(
        "score", ann.F.lit("x"))
    got = answers(ann.nearest(table, ann.F.col("vec_id") % 20 == 0))
    want = brute([i for i, _ in rows], np.array([v for _, v in rows]), [0, 20, 40, 100], 20)
    assert {q: [r.vec_id for r in v] for q, v in got.items()} == want
    assert all([r.rank for r in v] == list(range(1, 21)) for v in got.values())
    small = answers(ann.nearest(table.filter("vec_id in (0, 1, 2, 202)"), ann.F.col("vec_id") % 20 == 0))
    assert [r.vec_id for r in small[0]] == [1, 2]
    assert ann.nearest(table.limit(0), ann.F.lit(True)).collect() == []


def test_recall_of_lists(spark, monkeypatch):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(6000, 16)) * rng.uniform(0.5, 2, (6000, 1))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    monkeypatch.setattr(ann, "LIST_ROWS", 20)
    got = answers(ann.nearest(table, ann.F.col("vec_id") % 100 == 0))
    want = brute(list(range(6000)), x, list(range(0, 6000, 100)), 20)
    hits = [len({r.vec_id for r in got[q]} & set(want[q])) / 20 for q in want]
    assert np.mean(hits) >= 0.9
    for q, found in got.items():
        assert len(found) == 20
        assert all(abs(r.score - x[q] @ x[r.vec_id]) < 1e-9 for r in found)


def test_lists_grow_until_recall(spark, monkeypatch):
    """Where the least ratio is too small, a sample of the queries raises it; walks go on as far."""
    x = np.random.default_rng(6).normal(size=(4000, 24))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    monkeypatch.setattr(ann, "LIST_ROWS", 20)
    monkeypatch.setattr(ann, "PROBE_RATIO", 1.0)
    monkeypatch.setattr(ann, "WALK", 4)
    monkeypatch.setattr(ann, "REPLICAS", 2)
    got = answers(ann.nearest(table, ann.F.col("vec_id") % 20 == 0))
    want = brute(list(range(4000)), x, list(range(0, 4000, 20)), 20)
    assert np.mean([len({r.vec_id for r in got[q]} & set(want[q])) / 20 for q in want]) >= 0.94


def test_rows_made_grow_with_the_queries_not_with_the_lists(spark, monkeypatch):
    """Many more lists than tasks, which are cut into parts, as are the queries and the batches."""
    x = np.random.default_rng(8).normal(size=(3000, 12))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    for name, value in {"LIST_ROWS": 10, "PROBE_RATIO": 3.0, "CHUNK_ROWS": 24, "QUERY_ROWS": 70, "CELLS": 20_000}.items():
        monkeypatch.setattr(ann, name, value)
    made, plain = [], ann.compare

    def counted(*args):
        found = ann.store(plain(*args), "found")
        made.append(found.count())
        return found

    monkeypatch.setattr(ann, "compare", counted)
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch)
    spark.conf.set(batch, "33")
    try:
        got = answers(ann.nearest(table, ann.F.col("vec_id") % 20 == 0))
    finally:
        spark.conf.set(batch, before)
    # All lists, well over a hundred, are looked into.
    assert {q: [r.vec_id for r in v] for q, v in got.items()} == brute(list(range(3000)), x, list(range(0, 3000, 20)), 20)
    assert made == [150 * 21 * int(spark.conf.get("spark.sql.shuffle.partitions"))]


def test_ties_at_the_edge_go_to_the_smaller_id(spark, monkeypatch):
    x = np.random.default_rng(9).integers(-2, 3, (900, 4)).astype(float)
    x[(x == 0).all(axis=1)] = 1.0
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    monkeypatch.setattr(ann, "LIST_ROWS", 20)
    monkeypatch.setattr(ann, "PROBE_RATIO", 50.0)
    monkeypatch.setattr(ann, "CELLS", 500)
    got = answers(ann.nearest(table, ann.F.col("vec_id") % 20 == 0))
    assert {q: [r.vec_id for r in v] for q, v in got.items()} == brute(list(range(900)), x, list(range(0, 900, 20)), 20)


def test_pipeline_on_odd_rows(spark, odd, none):
    docs, counts = odd, []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == odd.columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        counts.append(docs.count())
    texts = [t for _, t, _, _ in odd_documents() if any(c.isalpha() for c in t or "")]
    assert counts[0] == len(texts) and counts[1] == len({" ".join(t.split()) for t in texts})
    assert 0 < counts[2] <= counts[1] and counts[3] > 0 and counts[4] >= counts[3]
    docs = none
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame([], stage(spark, docs, FOLDER).schema)
    assert docs.columns[0] == "doc_id"


def test_pipeline_stage_by_stage(spark, odd):
    """Every stage against a plain version of it, on rows whose other columns have generated names."""
    def written(df):
        return spark.createDataFrame(df.collect(), df.schema)

    def pairs(df):
        return Counter((r.doc_id, r.text) for r in df.collect())

    stage = dict(corpus_pipeline.STAGES)
    docs = written(stage["language_id"](spark, odd, FOLDER))
    rows = [(i, t) for i, t, _, _ in odd_documents() if any(c.isalpha() for c in t or "")]
    assert pairs(docs) == Counter(rows)

    docs = written(stage["exact_dedup"](spark, docs, FOLDER))
    first = {}
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault(SPACE.sub(" ", t), (i, SPACE.sub(" ", t)))
    assert Counter((i, SPACE.sub(" ", t)) for i, t in pairs(docs).elements()) == Counter(first.values())

    rows = [(r.doc_id, r.text) for r in docs.collect()]
    docs = written(stage["simhash_near_dedup"](spark, docs, FOLDER))
    classes = {}
    for (i, t), c in zip(rows, plain_classes([plain_fingerprint(t) for _, t in rows]), strict=True):
        classes.setdefault(c, []).append((i is None, i or 0, i, t))
    assert pairs(docs) == Counter(min(members)[2:] for members in classes.values())

    size = Counter()
    for r in docs.collect():
        size[r.source] += len(r.text.split())
    whole = {r.doc_id: len(r.text.split()) for r in docs.collect()}
    docs = written(stage["source_mixing"](spark, docs, FOLDER))
    taken, per_doc = Counter(), Counter()
    for r in docs.collect():
        taken[r.source] += len(r.text.split())
        per_doc[r.doc_id] += len(r.text.split())
    target = plain_targets(size)
    assert {s: int(target[s] + 1e-6) for s in size} == taken
    assert all(n <= 2 * whole[i] for i, n in per_doc.items())
    assert all(r[c] == "x" for r in docs.collect() for c in CLASH)

    packed = Counter()
    for r in stage["best_fit_packing"](spark, docs, FOLDER).collect():
        packed[r.doc_id] += r.n_words
    assert packed == per_doc


@given
def test_pipeline_runs(spark):
    got = corpus_pipeline.run(spark, FOLDER)
    rows = got.collect()
    ids = {r.doc_id for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert rows and {r.doc_id for r in rows} <= ids and len({r.bin_id for r in rows}) < len(rows)
