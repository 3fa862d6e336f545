import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from terrane.llm import html, licenses, passages, queries, toxicity

SF = "/root/testdata/sf0.001"


# Toxicity


def labelled(spark, n=400, seed=5):
    r = random.Random(seed)
    vocab = [f"word{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}" for i in range(100)]
    rows, marks = [], []
    for i in range(n):
        grade = r.choice([0, 0, 0, 1, 2])
        bad = [r.choice(["nastyone", "nastytwo", "vileish", "foulest"]) for _ in range(grade * 3)]
        words = r.choices(vocab, k=r.randrange(20, 200)) + bad
        r.shuffle(words)
        rows.append((i, " ".join(words), "x"))
        marks.append((i, int(grade > 0), "y"))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic string"), spark.createDataFrame(marks, "doc_id long, toxic int, text string")


def test_toxicity_is_accurate_on_held_out_documents(spark):
    docs, labels = labelled(spark)
    model = toxicity.fit(docs, labels.where("doc_id < 300"))
    assert model.thresholds == sorted(model.thresholds) and len(model.thresholds) >= 2
    held = toxicity.score(docs.drop("toxic").where("doc_id >= 300"), model).join(labels.select("doc_id", "toxic"), "doc_id").collect()
    right = sum(r._toxicity.toxic == bool(r.toxic) for r in held)
    assert right >= 0.97 * len(held)
    for r in held:
        assert 0 <= r._toxicity.expected_severity <= len(model.thresholds)


def test_toxicity_on_given_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    train = labels.where("doc_id % 2 = 0")
    model = toxicity.fit(docs, train)
    held = toxicity.score(docs, model).join(labels.where("doc_id % 2 = 1").select("doc_id", F.col("toxic").alias("y")), "doc_id")
    wrong = held.where(F.col("_toxicity.toxic") != (F.col("y") == 1)).count()
    assert wrong <= 0.02 * held.count()
    assert held.where("_toxicity.toxic AND y = 0").count() <= 0.01 * held.count()


def test_toxicity_edge_cases(spark):
    docs, labels = labelled(spark, 60)
    assert toxicity.fit(docs, labels.where("false")).weights == {}
    assert toxicity.fit(docs, labels.where("toxic = 0")).weights == {}
    odd = spark.createDataFrame([(1, None), (2, ""), (None, "nastyone nastytwo")], "doc_id long, text string")
    got = {r.doc_id: r._toxicity for r in toxicity.score(odd, toxicity.OrdinalModel()).collect()}
    assert not any(x.toxic for x in got.values()) and len(got) == 3
    kept = toxicity.drop_toxic(docs.withColumn("_toxicity", F.lit("own")), labels)
    assert kept.columns == [*docs.columns, "_toxicity"] and {r._toxicity for r in kept.collect()} == {"own"}
    assert toxicity.score(docs.limit(0), toxicity.OrdinalModel()).collect() == []


def test_fit_ordinal_gradient_is_that_of_the_likelihood():
    r = np.random.default_rng(1)
    n = 500
    x = r.random((n, 3)) < 0.5
    latent = x @ np.array([2.0, -1.0, 0.5]) + r.logistic(size=n)
    grades = (latent > 0).astype(int) + (latent > 2)
    rows, cols = np.nonzero(x)
    w, theta = toxicity.fit_ordinal(rows, cols, grades, 3, 3, ridge=0.01, steps=2000)

    def loss(w, theta):
        cdf = 1 / (1 + np.exp((x @ w)[:, None] - theta))
        e = np.hstack([np.zeros((n, 1)), cdf, np.ones((n, 1))])
        return -np.log(e[np.arange(n), grades + 1] - e[np.arange(n), grades]).sum() + 0.005 * (w**2).sum()

    best = loss(w, theta)
    for i in range(3):
        for step in (-0.05, 0.05):
            assert loss(w + step * np.eye(3)[i], theta) >= best - 1e-3
    for i in range(2):
        for step in (-0.05, 0.05):
            assert loss(w, theta + step * np.eye(2)[i]) >= best - 1e-3


# HTML


def page(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, text string")


def one(spark, markup, url="http://a.example/x"):
    return html.extract_text(page(spark, [(1, url, markup, "clash")])).collect()[0]


def test_article_text_without_chrome(spark):
    got = one(
        spark,
        "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p><article>';</script></head><body><nav><ul><li>Menu</ul></nav>"
        "<!-- ad <p>no --><div class=\"ad\">Buy</div><article><h1>Head &amp; more</h1><p>One\n  two <b>three</b>&nbsp;&#8364;<br>four<p>Fi<i>v</i>e"
        "<form><p>Mail</p><input></form><aside>Side</aside><div class='share-bar'>Share</div><ul><li>x<li>y</ul><section id=comments><p>Reader</p></section></article>"
        "<footer>&copy;</footer></body></html>",
    )
    assert got.text == "Head & more\nOne two three € four\nFive\nx\ny" and got.n_chars == len(got.text)


@pytest.mark.parametrize("markup,text", [(None, ""), ("", ""), ("<p", ""), ("<article>a &am", "a &am"), ("<article><p>a<!-- b", "a"), ("<main>x</main></p></div>", "x"), ("<article><script>x", ""), ("just text", "just text")])
def test_broken_markup(spark, markup, text):
    assert one(spark, markup, None).text == text


def test_repeated_runs_of_a_host_go_and_unique_runs_stay(spark):
    menu = "home news sport weather all about us here"
    rows = [(i, f"http://h{i % 2}.example/{i}", f"<div><p>{menu}</p><p>own{i} words of{i} page{i} number{i} alone{i}</p><p>{menu} tail{i}</p></div>", None) for i in range(10)]
    rows.append((50, "http://other.example/", f"<p>{menu}</p>", None))
    rows.append((51, "http://h0.example/z", f"<article><p>{menu}</p></article>", None))
    got = {r.page_id: r.text for r in html.extract_text(page(spark, rows), min_tokens=6, long_tokens=8).collect()}
    assert got[50] == menu and got[51] == menu
    for i in range(10):
        assert got[i] == f"own{i} words of{i} page{i} number{i} alone{i}\ntail{i}"
    assert html.extract_text(page(spark, [])).collect() == []
    twice = html.extract_text(page(spark, rows[:1] * 5)).collect()
    assert len(twice) == 5 and all(menu in r.text for r in twice)


def test_covered_tokens_match_a_plain_suffix_array(spark):
    r = random.Random(8)
    texts = {i: r.choices("a b c".split(), k=r.randrange(0, 40)) for i in range(12)}
    rows = [(i, "http://h.example/", f"<p>{' '.join(t)}</p>", None) for i, t in texts.items()]
    got = {x.page_id: x.text for x in html.extract_text(page(spark, rows), min_tokens=4, min_pages=3, long_tokens=6).collect()}
    suffixes = sorted((t[i:], p, i) for p, t in texts.items() for i in range(len(t)) if len(t) - i >= 4)
    gone = defaultdict(set)
    at = 0
    while at < len(suffixes):  # intervals of the array with a common prefix of four tokens
        end = at
        while end < len(suffixes) and suffixes[end][0][:4] == suffixes[at][0][:4]:
            end += 1
        if len({p for _, p, _ in suffixes[at:end]}) >= 3:
            for _, p, i in suffixes[at:end]:
                gone[p].update(range(i, i + 4))
        at = end
    want = {}
    for p, t in texts.items():
        if len(gone[p]) == len(t):
            want[p] = ""
            continue
        runs, left = [], sorted(gone[p])
        for i in left:
            if runs and runs[-1][-1] == i - 1:
                runs[-1].append(i)
            else:
                runs.append([i])
        out = {i for run in runs if len(run) >= 6 for i in run}
        want[p] = " ".join(w for i, w in enumerate(t) if i not in out)
    assert got == want


def test_suffixes_are_in_order_with_their_lcp(spark):
    """Ranges cut through an interval that all pages of a host are in; tokens may hold control characters."""
    r = random.Random(3)
    menu = "home news sport weather all about us here"
    texts = [(f"h{i % 3 // 2}", i, [menu, " ".join(r.choices(["a", "b", "a\x01", "\u00e9", "b-"], k=r.randrange(0, 30)))]) for i in range(120)]
    rows = [(h, str(i), i, True, [{"kind": 1, "text": t} for t in ts]) for h, i, ts in texts]
    df = spark.createDataFrame(rows, "_host string, _page string, _row long, _open boolean, rest array<struct<kind:int,text:string>>").repartition(5)
    own = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "64"}  # small ranges are not put together
    before = {k: spark.conf.get(k) for k in own}
    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        got = sorted(html.suffix_array(df, 5, 20).collect(), key=lambda x: (x.part, x.place))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    tokens = {i: " ".join(ts).split() for _, i, ts in texts}
    want = sorted(((h, "".join(w + " " for w in tokens[i][k : k + 20]).encode(), i, k) for h, i, _ in texts for k in range(len(tokens[i]) - 4)))
    assert [(x._host, x._row, x.start) for x in got] == [(h, i, k) for h, _, i, k in want]
    assert len({x.part for x in got}) > 4
    number = 0
    for at, x in enumerate(got):
        own = tokens[x._row][x.start : x.start + 20]
        if at:
            y = got[at - 1]
            other = tokens[y._row][y.start : y.start + 20]
            lcp = next((k for k, (v, w) in enumerate(zip(own, other, strict=False)) if v != w), min(len(own), len(other))) if x._host == y._host else -1
            assert x.lcp == (lcp if x.part == y.part else None)
            number += lcp < 5
        assert x.interval == number
    menus = [x for x in got if x._host == "h0" and x.start == 0]
    assert len({x.interval for x in menus}) == 1 and len({x.part for x in menus}) > 1


def test_phrases_of_a_large_host_stay(spark):
    menu = "home news sport weather all about us here"
    rows = [(i, "http://h.example/", f"<div><p>{menu}</p><p>page{i} says one two three four five six on day{i}</p><p>{'seldom said by any page here' if i % 40 == 0 else f'own{i}'}</p></div>", None) for i in range(200)]
    got = {x.page_id: x.text for x in html.extract_text(page(spark, rows)).collect()}
    # Five pages are under a twentieth of the host; a run of six tokens inside a block is a phrase.
    assert all(got[i] == f"page{i} says one two three four five six on day{i}\n" + ("seldom said by any page here" if i % 40 == 0 else f"own{i}") for i in range(200))


@pytest.mark.parametrize(
    "markup,text",
    [
        ('<div class="page with-sidebar no-ads"><article><p>kept</p></article></div>', "kept"),
        ('<div id="comments-wrapper"><article>kept</article></div>', "kept"),
        ('<article><p class="warning">kept</p><ul class="toc-entry"><li>too</ul><div class="share-bar">gone</div></article>', "kept\ntoo"),
        ('<article><p title="the hidden truth">a</p><p title="id = search">b</p><p data-x="class=ad">c</p><p hidden>d</p><p style="display: none">e</p></article>', "a\nb\nc"),
        ("<svg/><article>kept<svg><text>gone</text></svg></article>", "kept"),
        ("<article><p>" + "main words " * 9 + "</p></article><article><p>teaser words</p></article>", ("main words " * 9).strip()),
        ("<main><h1>Title</h1><article>" + "main words " * 9 + "</article><article>short</article></main>", "Title\n" + ("main words " * 9).strip()),
        ("<article>" + "one text " * 5 + "</article><article>" + "two text " * 5 + "</article>", ("one text " * 5).strip() + "\n" + ("two text " * 5).strip()),
        ("<article>kept</article><div class=comments><article>reader says more than that</article></div>", "kept"),
        ("<aside><article>only a teaser</article></aside>", ""),
        ("<form><article>kept<form>gone</form></article></form>", "kept"),
        ("<article>a</article></div></article><p>b", "a"),
    ],
)
def test_articles_and_what_is_round_them(markup, text):
    assert "\n".join(t for kind, t in html.blocks(markup) if not kind) == text


def test_long_pages_are_read_in_one_pass():
    import time

    began = time.perf_counter()
    page_ = "<article>" + "</i></b></span>" * 60_000 + "<p>text</p>" * 30_000 + "<div>" * 20_000 + "deep" + "</article>" + "<!--" * 5_000
    found = [t for kind, t in html.blocks(page_) if not kind]
    assert found == ["text"] * 30_000 + ["deep"] and time.perf_counter() - began < 20


def test_given_pages_match_a_plain_parser(spark):
    from html.parser import HTMLParser

    import duckdb

    class Plain(HTMLParser):
        def __init__(self):
            super().__init__()
            self.inside, self.out, self.now = False, [], ""

        def cut(self):
            if self.inside and self.now.split():
                self.out.append(" ".join(self.now.split()))
            self.now = ""

        def handle_starttag(self, tag, attrs):
            if tag in ("article", "p", "h1"):
                self.cut()
            self.inside |= tag == "article"
            self.now += " " if tag == "br" else ""

        def handle_endtag(self, tag):
            if tag in ("article", "p", "h1"):
                self.cut()
            self.inside &= tag != "article"

        def handle_data(self, data):
            self.now += data

    pages = duckdb.sql(f"SELECT page_id, html FROM '{SF}/pages.parquet'").fetchall()
    got = {x.page_id: x.text for x in queries.op10_html_text(spark, SF).collect()}
    assert len(got) == len(pages)
    for key, markup in pages:
        plain = Plain()
        plain.feed(markup or "")
        assert got[key] == "\n".join(plain.out)


# Licenses


def test_licenses_are_found_with_spans(spark):
    mit = licenses.TEMPLATES["MIT"][1]
    texts = {
        1: "Foo bar. Released under the MIT License. end",
        2: f"intro words {mit} tail",
        3: "x " + mit.replace("free of charge,", "without any charge at all,").replace("publish,", "") + " y",
        4: "nothing of the kind under the sun",
        5: None,
        6: "",
        7: "Licensed under CC BY-NC 4.0.\nLicensed under the Apache License, Version 2.0.",
    }
    df = spark.createDataFrame([(i, t, "z") for i, t in texts.items()], "doc_id long, text string, license string")
    got = {(r.doc_id, r.license): r for r in licenses.scan_licenses(df).collect()}
    assert set(got) == {(1, "MIT"), (2, "MIT"), (3, "MIT"), (7, "CC-BY-NC-4.0"), (7, "Apache-2.0")}
    assert (got[1, "MIT"].start_word, got[1, "MIT"].end_word, got[1, "MIT"].coverage) == (2, 7, 1.0)
    assert got[2, "MIT"].start_word == 2 and got[2, "MIT"].coverage == 1.0 and 0.8 <= got[3, "MIT"].coverage < 1.0


def test_every_short_notice_is_found_anywhere():
    r = random.Random(3)
    index = licenses.Index(licenses.TEMPLATES, 3, 2)
    for name, texts in licenses.TEMPLATES.items():
        for t in texts:
            own = licenses.words(t)
            for _ in range(20):
                before = [r.choice(["the", "under", "license", "foo", "software", "of"]) for _ in range(r.randrange(6))]
                found = licenses.scan_text(" ".join([*before, "zzz", t, "zzz", *before]), index, 0.8, 6)
                assert any(f[0] == name and f[2] == len(before) + 1 and f[3] == len(before) + 1 + len(own) for f in found), (name, t, found)


@pytest.mark.parametrize(
    "text,name",
    [
        ("Licensed under CC BY 4.0.", "CC-BY-4.0"),
        ("Licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0"),
        ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0"),
        ("This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.", "CC-BY-NC-ND-4.0"),
        ("you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", "GPL-2.0"),
        ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License", "AGPL-3.0"),
        ("Licensed under the Apache License, Version 1.1.", None),
        ("Distributed under the Boost Software License, Version 1.0.", "BSL-1.0"),
    ],
)
def test_telling_words_decide_between_licenses_of_a_family(text, name):
    found = licenses.scan_text(f"zzz {text} zzz", licenses.Index(licenses.TEMPLATES, 3, 2), 0.8, 6)
    assert [f[0] for f in found] == ([name] if name else [])


def plain_coverage(template, text):
    """The most template words that some stretch of the text matches in order."""
    best = [0] * (len(text) + 1)
    for w in template:
        row = [0]
        for j, v in enumerate(text):
            row.append(max(best[j + 1], row[-1], best[j] + (v == w)))
        best = row
    return best[-1] / len(template)


def test_licenses_of_given_texts_match_an_alignment_without_index(spark):
    import duckdb

    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    got = defaultdict(set)
    for x in queries.op5_license_scan(spark, SF).collect():
        got[x.doc_id].add(x.license)
    short = [(n, licenses.words(t)) for n, ts in licenses.TEMPLATES.items() for t in ts if len(licenses.words(t)) < 16]
    for key, text in texts.items():
        want = set()
        for line in (text or "").split("\n"):
            w = licenses.words(line)
            if {"license", "licensed", "cc"} & set(w):
                want |= {n for n, t in short for i in range(len(w)) if plain_coverage(t, w[i : i + len(t)]) >= 0.8 and licenses.telling(t) == licenses.telling(w[i : i + len(t)])}
        assert want <= got[key], key


# Passages


def plain_windows(v, least):
    out = []
    for p in range(len(v)):
        lo = p
        while lo > 0 and v[lo - 1] > v[p]:
            lo -= 1
        hi = p
        while hi < len(v) - 1 and v[hi + 1] >= v[p]:
            hi += 1
        if hi - lo + 1 >= least:
            out.append((lo, p, hi))
    return out


@pytest.mark.parametrize("top", [3, 10, 10**9])
def test_compact_windows_match_their_definition(top):
    r = np.random.default_rng(top)
    for n in (0, 1, 4, 5, 6, 23, 100, 301):
        for least in (1, 2, 5, 7, 46):
            v = r.integers(0, top, n).astype(np.uint64)
            got = list(zip(*(x.tolist() for x in passages.compact_windows(v, least)), strict=True))
            assert got == plain_windows(v.tolist(), least)


def test_windows_of_texts_end_to_end_are_those_of_each_text():
    r = np.random.default_rng(4)
    texts = [r.integers(0, top, n).astype(np.uint64) for top, n in ((9, 30), (10**9, 3), (10**9, 200), (2, 50), (5, 0), (10**9, 7))]
    begins = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = list(zip(*(x.tolist() for x in passages.compact_windows(np.concatenate(texts), 7, begins)), strict=True))
    assert got == [tuple(int(begins[i] + x) for x in w) for i, t in enumerate(texts) for w in plain_windows(t.tolist(), 7)]


@pytest.mark.parametrize("n", [1, 2, 40, 300])
def test_interval_join_of_windows_matches_all_pairs(n):
    r = np.random.default_rng(n)
    p, q, f, x, y, u, v = (r.integers(lo, hi, n) for lo, hi in ((60, 60 + 9 * n), (60, 99), (0, 6), (0, 46), (0, 46), (0, 46), (0, 46)))
    at_a, at_b = ((p << 27) | (f << 24) | (np.maximum(x, y) << 12) | np.minimum(x, y)), ((q << 27) | (f << 24) | (np.maximum(u, v) << 12) | np.minimum(u, v))
    runs = [(p[i] - max(x[i], y[i]), p[i] - min(x[i], y[i]), q[i] - max(u[i], v[i]), q[i] - min(u[i], v[i]), f[i]) for i in range(n)]
    want = [any(a[4] != b[4] and a[0] <= b[1] and b[0] <= a[1] and a[2] <= b[3] and b[2] <= a[3] for b in runs) for a in runs]
    assert passages.joined_windows(at_a, at_b).tolist() == want


def test_compact_windows_cover_every_run_once():
    v = np.random.default_rng(9).integers(0, 10**6, 80).astype(np.uint64)
    lo, p, hi = passages.compact_windows(v, 10)
    for i in range(71):
        for j in range(i + 9, 80):
            assert [int(x) for x in p[(lo <= i) & (i <= p) & (p <= j) & (j <= hi)]] == [i + int(v[i : j + 1].argmin())]


def shingles(text):
    w = text.split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def prose(r, n):
    return [f"w{r.randrange(3000)}" for _ in range(n)]


def test_planted_passages_are_found_and_clean_documents_left_alone(spark):
    r = random.Random(11)
    shared = [prose(r, n) for n in (52, 60, 90, 200)]
    texts, group = {}, {}
    for i in range(60):
        if i < 24:
            body = prose(r, 100) + shared[i % 4] + prose(r, 100)
            group[i] = i % 4
        elif i < 40:
            body = list(shared[3])  # near copies of a passage, one word changed
            body[r.randrange(60, 140)] = "edited"
            group[i] = 3
        else:
            body = prose(r, 300) + ["one", "common", "line", "of", "seven", "words", "here"] * (i % 2)
        texts[i] = " ".join(body)
    texts |= {100: None, 101: "", 102: texts[50], 103: texts[50].upper(), 104: "a b c"}
    group |= {50: 9, 102: 9, 103: 9}
    df = spark.createDataFrame([(i, t, 0) for i, t in texts.items()], "doc_id long, text string, n_links int")
    got = {x.doc_id: x for x in passages.passage_classes(df).collect()}
    assert set(got) == set(group)
    for i, g in group.items():
        assert got[i].class_id == min(j for j, h in group.items() if h == g)
    assert all(s.s <= 100 and s.e >= 100 + 52 for i in range(0, 24, 4) for s in got[i].spans)
    assert passages.passage_classes(df.limit(0)).collect() == []


def test_verified_passages_are_similar(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for x in passages.similar_passages(docs).collect():
        a, b = (shingles(" ".join((texts[d] or "").encode().lower().decode().split()[s:e])) for d, s, e in ((x.a, x.a_start, x.a_end), (x.b, x.b_start, x.b_end)))
        assert len(a & b) >= 0.8 * len(a | b) and max(x.a_end - x.a_start, x.b_end - x.b_start) >= 50


# Pipeline


def test_pipeline_stages_match_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    cut = docs
    for name, f in corpus_pipeline.STAGES[:-1]:
        out = f(spark, cut, SF)
        assert out.columns == docs.columns, name
        out = out.cache()
        if name != "source_mixing":
            assert out.exceptAll(cut).count() == 0  # rows are only removed
        cut = out
    ids = {r.doc_id for r in cut.collect()}
    rows = corpus_pipeline.STAGES[-1][1](spark, cut, SF).collect()
    assert {r.doc_id for r in rows} == ids and sorted(r.slot for r in rows) == list(range(len(rows)))
    assert corpus_pipeline.run(spark, SF).count() == len(rows)


def one_phrase_rows(r, groups=12, others=60):
    """Unrelated texts around one phrase whose hash is least under the first function, and pairs that also share a passage around it."""
    vocab = [f"word{i}" for i in range(20_000)]
    seed = np.uint64(passages.xxhash.xxh64_intdigest("function 0"))
    tries = [[f"p{i}{k}" for k in range(5)] for i in range(30_000)]
    h = passages.shingle_hashes([" ".join(t) for t in tries])[0]
    phrase = tries[int(passages._mix(h ^ seed).argmin())]
    rows = []
    for g in range(groups):
        shared = r.choices(vocab, k=30), r.choices(vocab, k=30)
        rows += [(2 * g + c, " ".join(r.choices(vocab, k=60) + shared[0] + phrase + shared[1] + r.choices(vocab, k=60))) for c in range(2)]
    rows += [(1000 + i, " ".join(r.choices(vocab, k=90) + phrase + r.choices(vocab, k=90))) for i in range(others)]
    return rows


def test_passages_around_a_common_phrase_are_found(spark):
    rows = one_phrase_rows(random.Random(11))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(x.a, x.b) for x in passages.similar_passages(df, functions=1, agree=1).collect()}
    assert got == {(2 * g + 1, 2 * g) for g in range(12)}


def test_recall_of_short_passages_near_the_limit(spark):
    r = random.Random(17)
    vocab = [f"word{i}" for i in range(20_000)]
    rows, want = [], set()
    for i in range(200):
        n = r.choice((50, 50, 60, 80, 100))
        passage = r.choices(vocab, k=n)
        copy = list(passage)
        for k in range(n // 50):
            copy[n * (2 * k + 1) // (2 * (n // 50))] = f"changed{k}"
        x, y = (shingles(" ".join(p)) for p in (passage, copy))
        for c, p in enumerate((passage, copy)):
            rows.append((2 * i + c, " ".join(p)))
        if len(x & y) >= 0.8 * len(x | y):
            want.add((2 * i + 1, 2 * i))
    got = {(x.a, x.b) for x in passages.similar_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(want) > 150 and got <= {(2 * i + 1, 2 * i) for i in range(200)}
    assert len(got & want) >= 0.98 * len(want), len(got & want) / len(want)


@pytest.mark.parametrize("changed,least", [(0, 1.0), (1, 0.98)])
def test_passages_round_one_common_line_are_found(spark, changed, least):
    """Pairs of passages of 54 words and more in documents that all have one line of 20 words in the middle of them."""
    r = random.Random(23)
    vocab = [f"word{i}" for i in range(20_000)]
    line = r.choices(vocab, k=20)
    rows, want = [], set()
    for i in range(200):
        n = 17 if not changed else r.randrange(20, 30)
        left, right = r.choices(vocab, k=n), r.choices(vocab, k=n)
        passage = left + line + right
        copy = list(passage)
        for k in range(changed):
            copy[r.randrange(4, n - 4)] = f"changed{k}"
        x, y = shingles(" ".join(passage)), shingles(" ".join(copy))
        rows += [(2 * i + c, " ".join(r.choices(vocab, k=50) + p + r.choices(vocab, k=50))) for c, p in enumerate((passage, copy))]
        if len(x & y) >= 0.8 * len(x | y):
            want.add((2 * i + 1, 2 * i))
    got = {(x.a, x.b) for x in passages.similar_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(want) > 150 and got <= {(2 * i + 1, 2 * i) for i in range(200)}
    assert len(got & want) >= least * len(want), len(got & want) / len(want)


def test_variants_of_one_passage_are_one_class_and_copies_cost_no_pairs(spark):
    """300 variants of a passage, each changed in its own place, and 500 copies of one of them."""
    r = random.Random(29)
    vocab = [f"word{i}" for i in range(20_000)]
    passage = r.choices(vocab, k=120)
    rows = []
    for i in range(300):
        p = list(passage)
        for k in r.sample(range(120), 2):
            p[k] = f"own{i}x{k}"
        rows.append((i, " ".join(r.choices(vocab, k=30) + p + r.choices(vocab, k=30))))
    rows += [(1000 + i, rows[7][1]) for i in range(500)] + [(None, rows[7][1]), (2000, rows[8][1] + " more"), (2000, "another text of the same id " * 9)]
    got = {x.doc_id: x for x in passages.passage_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(got) == {*range(300), *range(1000, 1500), 2000}
    assert {x.class_id for x in got.values()} == {0}
    assert all(got[i].n_dup_words == 180 for i in range(1000, 1500))


def plain_overlaps(windows):
    """Pairs of windows ``key, p, f, first, final, n`` of two functions with a run in common, the lower function first."""
    return [(x, y) for x in windows for y in windows if x[2] < y[2] and x[1] - x[3] <= y[1] - y[4] and y[1] - y[3] <= x[1] - x[4]]


def test_common_windows_stand_together_with_those_beside_them():
    r = random.Random(31)
    texts = []
    for _ in range(40):
        windows = {(10 * f + k, p, f, max(x, y), min(x, y), 2 if k < 3 else 90) for f in range(5) for k, p, x, y in ((r.randrange(6), r.randrange(50, 250), r.randrange(46), r.randrange(46)) for _ in range(r.randrange(6)))}
        texts.append(sorted(windows))
    at = [[{"key": k, "place": p << 27 | f << 24 | a << 12 | b, "n": n} for k, p, f, a, b, n in t] for t in texts]
    kind = pa.list_(pa.struct([("key", pa.int64()), ("place", pa.int64()), ("n", pa.int64())]))
    batch = pa.RecordBatch.from_arrays([pa.array(range(40), pa.int64()), pa.array(at, kind)], ["node", "at"])
    got = [x for b in passages._paired(8, 2)([batch]) for x in b.to_pylist()]
    alone, joint = [], []
    for node, t in enumerate(texts):
        pairs = plain_overlaps(t)
        beside = {w for x, y in pairs if x[5] <= 8 and y[5] <= 8 for w in (x, y)}
        alone += [(w[0], node, w[1]) for w in beside]
        joint += [((x[0], y[0]), node, x[1], y[1], max(x[1] - x[3], y[1] - y[3]), min(x[1] - x[4], y[1] - y[4])) for x, y in pairs if x[5] > 8 or y[5] > 8]
    assert sorted((x["key"], x["node"], x["p"] >> 27) for x in got if x["q"] is None) == sorted(alone)
    narrowed = lambda x: (x["node"], x["p"] >> 27, x["q"] >> 27, *{((x[c] >> 27) - (x[c] >> 12 & 4095), (x[c] >> 27) - (x[c] & 4095)) for c in "pq"})
    two = [x for x in got if x["q"] is not None]
    assert sorted(narrowed(x) for x in two) == sorted((n, p, q, (lo, hi)) for _, n, p, q, lo, hi in joint) and len(alone) > 20 < len(joint)
    assert len({x["key"] for x in two}) == len({x[0] for x in joint})  # as many keys as there are pairs of values
    assert len(next(passages._paired(8, 1)([batch]))) == sum(map(len, texts))


def test_few_open_windows_of_a_large_group_meet_all_others(spark):
    rows = [(1, node, node << 27, None, node in (3, 20)) for node in range(30)] + [(2, node, node << 27, 5 << 27, True) for node in range(30)] + [(3, 1, 0, None, True)]
    grouped = passages._grouped(spark.createDataFrame(rows, "k long, node long, p long, q long, open boolean"), "k")
    assert {(x.k, x.n) for x in grouped.collect()} == {(1, 2), (2, 30)}
    met = passages._meetings(grouped, "k", 8, lambda p, q: F.when(q.isNull(), 1).otherwise(3)).collect()
    first = [x for x in met if len(x.met) == 1]
    assert {frozenset((x.a, x.b)) for x in first} == {frozenset((o, n)) for o in (3, 20) for n in range(30) if n != o} and len(first) == 57
    assert all(m.pa == x.a << 27 and m.pb == x.b << 27 for x in first for m in x.met)
    led = [x for x in met if len(x.met) == 2]
    assert len({x.b for x in led}) <= 2 and {x.a for x in led} | {x.b for x in led} == set(range(30)) and {x.f for x in led} == {3}


def test_words_are_hashed_as_split_takes_them():
    r = random.Random(37)
    for _ in range(200):
        texts = ["".join(r.choices("ab AB\t\n\r\x0b\x0c\x1c\x85é日, ", k=r.choice((0, 1, 3, 40)))) if r.random() < 0.95 else None for _ in range(r.randrange(5))]
        hashes, begins, n = passages.shingle_hashes(texts)
        words = [(t or "").encode().lower().split() for t in texts]
        want = [tuple(w[i : i + 5]) for w in words for i in range(len(w) - 4)]
        assert n.tolist() == [len(w) for w in words] and begins.tolist() == np.cumsum([0] + [max(0, len(w) - 4) for w in words]).tolist()
        assert len(hashes) == len(want) and len(set(zip(want, hashes.tolist(), strict=True))) == len(set(want)) == len(set(hashes.tolist()))


def test_texts_are_compared_again_only_where_they_meet_anew(spark):
    at = lambda p: p << passages._P

    def meetings(rows):
        return spark.createDataFrame(rows, "a long, b long, f int, met array<struct<pa:long,pb:long>>")

    first = passages._candidates(meetings([(9, 1, 3, [(at(100), at(40))]), (1, 8, 3, [(at(5), at(300))]), (7, 2, 1, [(at(0), at(0))])]), 2, 46, [])
    assert sorted((r.a, r.b, r.at_a, r.at_b) for r in first.collect()) == [(8, 1, [at(300)], [at(5)]), (9, 1, [at(100)], [at(40)])]
    again = [
        (1, 9, 3, [(at(42), at(102))]),  # the same diagonal and stretch, stated the other way round
        (8, 1, 3, [(at(301), at(5))]),  # the diagonal beside it
        (6, 1, 3, [(at(100), at(40))]),  # a pair that is new
    ]
    assert sorted((r.a, r.b) for r in passages._candidates(meetings(again), 2, 46, [first]).collect()) == [(6, 1), (8, 1)]
    further = passages._candidates(meetings([(9, 1, 3, [(at(100), at(40)), (at(400), at(340))])]), 2, 46, [first, first])
    assert [(r.a, r.b, len(r.at_a)) for r in further.collect()] == [(9, 1, 2)]


def test_empty_and_single_texts_have_no_passages(spark):
    kind = "doc_id long, text string"
    one = " ".join(f"w{i}" for i in range(80))
    for rows in ([], [(1, one)], [(1, None), (None, one), (2, ""), (3, "a b")]):
        assert passages.passage_classes(spark.createDataFrame(rows, kind)).collect() == []
