"""Nearest neighbours, Pfair mixing, page extraction, revisits."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeingest.llm.hash_forest import SYMBOLS, TREES, blocks_of, candidates, nearest, shared_symbol, votes_of
from lakeingest.llm.html_extract import extract_pages, main_text
from lakeingest.llm.pfair_mix import (BLOCK_ROWS, exact_quotas, mix_documents, picks, quotas, rounded_quotas, schedule,
                                      scheduled)
from lakeingest.llm.warc_revisit import canonical_url, resolve_revisits

from .fixtures import DOCUMENTS, documents, rows


def brute_nearest(data, k=5):
    good = {i: np.array(v, dtype=float) for i, v in data
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = {}
    for q, x in good.items():
        scored = [(-float(x @ y / (np.linalg.norm(x) * np.linalg.norm(y))), i) for i, y in good.items()
                  if i != q and len(y) == len(x)]
        out[q] = sorted((round(s, 9), i) for s, i in scored)[:k]
    return out


def test_nearest_on_awkward_vectors(spark):
    rng = np.random.default_rng(1)
    data = [(i, [float(np.float32(x)) for x in rng.standard_normal(8)]) for i in range(60)]
    data += [(100 + i, data[3][1]) for i in range(12)]                 # copies: ties go to the smaller id
    data += [(200, None), (201, []), (202, [0.0] * 8), (203, [1.0, None] + [0.0] * 6), (204, [float("nan")] * 8),
             (205, [float("inf")] + [0.0] * 7), (None, [1.0] * 8), (206, [1.0, 2.0]), (207, [2.0, 1.0]), (5, data[5][1]),
             (208, [3e38] * 8), (209, [1e-38] * 8)]
    frame = spark.createDataFrame([(i, v, "x") for i, v in data], "vec_id long, embedding array<float>, vector string")
    got = {}
    for r in nearest(frame, F.lit(True), k=5).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = brute_nearest([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in data])
    assert set(got) == {q for q, v in want.items() if v}
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, len(found) + 1))
        assert [round(-f[2], 9) for f in found] == pytest.approx([s for s, _ in want[q]], abs=1e-8)
        if q >= 100 and q < 112 or q == 3:
            assert [f[1] for f in found] == [i for _, i in want[q]]
    assert nearest(frame.limit(0), F.lit(True)).collect() == []


def test_recall_with_a_small_budget(spark):
    """Isotropic vectors, the hardest case, and a budget of about a fifth of them."""
    rng = np.random.default_rng(2)
    x = rng.standard_normal((4000, 32)).astype(np.float32)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = nearest(frame, F.col("vec_id") % 50 == 0, budget=1000).groupBy("query_id").agg(
        F.collect_set("vec_id").alias("ids")).collect()
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    hits = 0
    for r in got:
        s = u @ u[r.query_id]
        s[r.query_id] = -2
        hits += len(set(np.argsort(-s)[:5].tolist()) & set(r.ids))
    assert len(got) == 80 and hits / 400 >= 0.9


def test_recall_does_not_hang_on_the_budget(spark):
    """Isotropic vectors in blocks far above the budget of the first look."""
    rng = np.random.default_rng(4)
    x = rng.standard_normal((20000, 64)).astype(np.float32)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = nearest(frame, F.col("vec_id") % 400 == 0, budget=1).groupBy("query_id").agg(
        F.collect_set("vec_id").alias("ids")).collect()
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    hits = 0
    for r in got:
        s = u @ u[r.query_id]
        s[r.query_id] = -2
        hits += len(set(np.argsort(-s)[:5].tolist()) & set(r.ids))
    assert len(got) == 50 and hits / 250 >= 0.95
    assert [blocks_of(n) for n in (0, 2000, 20000, 1 << 20, 1 << 21)] == [1, 1, 9, 16, 32]


def test_the_bar_sets_what_is_ranked():
    assert votes_of(64, TREES, SYMBOLS, 0) == (0, 0)             # no cosine yet: everything
    p = shared_symbol(64)
    assert p[0] < 0.02 and p[-1] == 1 and (np.diff(p) > -0.01).all()
    for step in (32, 48, 60):
        level, votes = votes_of(64, TREES, SYMBOLS, step)
        chance = p[step] ** level
        assert sum(math.comb(TREES, i) * chance ** i * (1 - chance) ** (TREES - i) for i in range(votes)) <= 0.05


def test_ascent_takes_the_longest_prefixes_first():
    strings = np.array([[0, 1, 2, 3, 16, 17, 33, 63]] * 2)       # base 4, 3 symbols
    order = np.array([[0, 1, 2, 3, 4, 5, 6, 7], [7, 1, 2, 3, 4, 5, 6, 0]])
    got = candidates(strings, order, np.array([1, 1]), 4, 3, 1)
    assert got.tolist() == [1]
    assert set(candidates(strings, order, np.array([1, 1]), 4, 3, 3).tolist()) == {1, 2, 3}
    assert len(candidates(strings, order, np.array([1, 1]), 4, 3, 8)) == 8


def test_every_block_is_in_its_window(spark):
    rng = random.Random(3)
    for sizes in ([1000], [500, 300, 200], [900, 37, 37, 26], [rng.randint(1, 500) for _ in range(40)]):
        counts = spark.createDataFrame([(f"={i:03}", n) for i, n in enumerate(sizes)], "key string, n long")
        q = {r.key: r.q for r in quotas(counts).collect()}
        assert sum(q.values()) == 1000 and min(q.values()) >= 1
        plan = schedule(quotas(counts)).collect()
        assert sorted(r.spot for r in plan) == list(range(1000))
        for r in plan:
            assert r.turn * 1000 // r.q <= r.spot < -(-(r.turn + 1) * 1000 // r.q)


def test_mix_keeps_rows_and_shares(spark):
    data = [(i, f"t{i}", "en", "big" if i % 3 else f"s{i % 5}", 1, "n", i, "k") for i in range(3000)] + rows()
    docs = documents(spark, data)
    placed = scheduled(docs).select("doc_id", "source", "mix.*").collect()
    assert len(placed) == len(data)
    slots = {}
    for r in placed:
        assert r.release <= r.slot < r.deadline and 0 <= r.in_block < BLOCK_ROWS
        slots.setdefault(r.slot, set()).add((r.source, r.block))
    assert all(len(s) == 1 for s in slots.values())
    # until a source runs out, each has its share to within less than one block at every slot
    runs = {s: max(r.block for r in placed if r.source == s) for s in {r.source for r in placed}}
    share = {r.key: r.q / 1000 for r in quotas(docs.groupBy(F.when(F.col("source").isNull(), "").otherwise(
        F.concat(F.lit("="), "source")).alias("key")).agg(F.count("*").alias("n"))).collect()}
    done = dict.fromkeys(runs, 0)
    for t in range(min(max(r.slot for r in placed if r.source == s) for s in runs)):
        for s, _ in slots.get(t, ()):
            done[s] += 1
        for s in runs:
            assert abs(done[s] - (t + 1) * share["" if s is None else f"={s}"]) < 1
    mixed = mix_documents(docs)
    assert mixed.columns == DOCUMENTS.names
    assert sorted(map(repr, mixed.collect())) == sorted(map(repr, docs.collect()))
    assert mix_documents(documents(spark, [])).collect() == []
    weights = {r.key: r.q for r in quotas(spark.createDataFrame([("=a", 5), ("=b", 5)], "key string, n long"),
                                          weights={"a": 3, "b": 1}).collect()}
    assert weights == {"=a": 750, "=b": 250}
    with pytest.raises(ValueError, match="sources"):
        scheduled(docs, cycle=2)


def test_shares_are_those_of_the_weights(spark):
    assert rounded_quotas({"a": 900, "b": 100}, 1000) == {"a": 900, "b": 100}
    assert rounded_quotas({"a": 990, "b": 5, "c": 5}, 1000) == {"a": 990, "b": 5, "c": 5}
    many = rounded_quotas({"a": 100000, **{f"b{i:02}": 1 for i in range(50)}}, 1000)
    assert many == {"a": 950, **{f"b{i:02}": 1 for i in range(50)}}
    assert exact_quotas({"a": 4, "b": 2, "c": 0}) == {"a": 666, "b": 333, "c": 1}
    heavy = {"a": 900000, **{f"b{i:02}": 1000 for i in range(19)}}
    for weights in (heavy, {"a": 500, **{f"b{i:03}": 1 for i in range(500)}}, {"a": 997, "b": 3001, "c": 7, "d": 1009}):
        quota = [exact_quotas(weights)[k] for k in sorted(weights)]
        cycle, total, done = sum(quota), sum(weights.values()), [0] * len(weights)
        target = [weights[k] for k in sorted(weights)]
        for t, i in enumerate(picks(quota, cycle, 3 * cycle), 1):       # against the weights, cycle after cycle
            done[i] += 1
            assert all(abs(d * total - t * w) < total for d, w in zip(done, target))
    data = [(i, "t", "en", "a" if i % 10 else "b", 1, "n", i, "k") for i in range(4000)]
    placed = scheduled(documents(spark, data), block_rows=1, weights={"a": 6007, "b": 661}).select("source", "mix.*").collect()
    assert len(placed) == len({r.slot for r in placed}) == 4000
    for r in placed:
        w = {"a": 6007, "b": 661}[r.source]
        assert (r.release, r.deadline) == (r.block * 6668 // w, -(-(r.block + 1) * 6668 // w))
        assert r.release <= r.slot < r.deadline


def test_any_number_of_sources(spark):
    data = [(i, "t", "en", f"host{i % 2500}.org", 1, "n", i, "k") for i in range(5000)]
    placed = scheduled(documents(spark, data), block_rows=1).select("source", "mix.*").collect()
    assert len(placed) == len({r.slot for r in placed}) == 5000
    assert all(r.release <= r.slot < r.deadline for r in placed)


ARTICLE = "".join(f"<p>Paragraph {i}, with commas, and enough words to count as text of the story.</p>" for i in range(4))
TEXT = " ".join(f"Paragraph {i}, with commas, and enough words to count as text of the story." for i in range(4))


@pytest.mark.parametrize("html,want", [
    (None, ""), ("", ""), ("<html><body></body></html>", ""), ("plain words", "plain words"),
    (f"<body><div class='site-header'><a href=/>Home</a></div><div id='content'>{ARTICLE}</div></body>", TEXT),
    (f"<body><nav><ul><li><a>Menu, item, one, two, three, four words</a></ul></nav><article><h1>Title</h1>{ARTICLE}"
     "</article><aside><p>Side, bar, text, that, is, long, and, has, many, commas, in, it, indeed.</p></aside>"
     "<footer>Foot</footer>", "Title " + TEXT),
    (f"<div class='layout'><div class='story'>{ARTICLE}<script>var x='<p>no</p>';</script><form><p>Mail, please, your, "
     f"address, here, now</p></form></div><div id='comments'>{ARTICLE.replace('Paragraph', 'Reader')}</div></div>", TEXT),
    (f"<article>{ARTICLE}<ul><li><a>one</a><li><a>two</a><li><a>three</a></ul><div class='cookie-notice'>We, use, it.</div>"
     "</article>", TEXT + " one two three"),
    (f"<article><p>Fish &amp; chips&nbsp;cost &pound;5 &#x1F600; &lt;now&gt;<br>a<b>b</b>c<p>next {ARTICLE}</article>",
     "Fish & chips cost £5 😀 <now> abc next " + TEXT),
    (f"<!-- <p>gone</p> --><main><section>{ARTICLE}</section><section>{ARTICLE}</section></main>", TEXT + " " + TEXT),
    (f"<article>{ARTICLE}<div hidden>secret</div><p style='display: none'>secret</p></span></b></td>end</article>", TEXT + " end"),
])
def test_main_text(html, want):
    assert main_text(html) == want


def test_hostile_pages_end():
    for html in ("<div>" * 20000 + "deep text here", "<b>" * 20000 + "x", "</p>" * 20000 + "y", "<" * 20000,
                 "<p " + "a='" * 5000, "<script>" + "x" * 10000, "&" * 10000, "<table><tr><td>" * 3000 + "z"):
        assert isinstance(main_text(html), str)
    long = "<article>" + ARTICLE * 3000 + "</article>"
    assert main_text(long) == " ".join([TEXT] * 3000)


def test_pages_keep_their_rows(spark):
    data = [(1, "u", f"<article>{ARTICLE}</article>", "t"), (2, None, None, "t"), (None, "u", "", "t"), (1, "u", f"<article>{ARTICLE}</article>", "t")]
    pages = spark.createDataFrame(data, "page_id long, url string, html string, text string")
    got = sorted((tuple(r) for r in extract_pages(pages).collect()), key=repr)
    assert got == sorted([(1, "u", TEXT, len(TEXT)), (2, None, "", 0), (None, "u", "", 0), (1, "u", TEXT, len(TEXT))], key=repr)
    assert extract_pages(pages.limit(0)).collect() == []


def test_canonical_urls(spark):
    urls = {"https://WWW.Host.org/a/": "host.org/a", "http://m.host.org/a?utm_source=x#top": "host.org/a",
            "host.org/A?b=1&utm_x=2&c=3": "host.org/A?b=1&c=3", "HTTPS://host.org": "host.org", None: None}
    got = spark.createDataFrame([(u,) for u in urls], "u string").select("u", canonical_url(F.col("u")).alias("c")).collect()
    assert {r.u: r.c for r in got} == urls


def test_revisits(spark):
    schema = "record_id long, url string, captured_at long, is_revisit boolean, headers map<string,string>, body string, day string"
    day = 86400
    u = "http://h.org/a"
    data = [
        (1, u, 100, False, {"ETag": "v1", "Content-Type": "t", "Date": "d1"}, "one", ""),
        (2, "https://www.h.org/a/#x", 200, False, {"ETag": 'W/v2', "Last-Modified": "m2"}, "two", ""),
        (3, u, 200, False, {"ETag": "v3"}, "three", ""),                        # same time: the larger id counts
        (10, u, 100, True, {}, None, ""), (11, u, 150, True, {"etag": "v1", "content-type": "no", "Date": "d2"}, None, ""),
        (12, u, 200, True, {"ETAG": "v1"}, None, ""), (13, u, 3 * day, True, {"etag": "v3"}, None, ""),
        (14, u, 3 * day, True, {"last-modified": "m2"}, None, ""), (15, u, 4 * day, True, None, None, ""),
        (16, "http://other.org/", 500, True, {}, None, ""), (17, None, 500, True, {}, None, ""),
        (18, u, None, True, {}, None, ""), (15, u, 4 * day, True, None, None, ""), (4, None, 1, False, {}, "x", ""),
        (5, u, None, False, {}, "x", ""), (None, u, 300, False, {}, "x", ""),
    ]
    got = resolve_revisits(spark.createDataFrame(data, schema)).collect()
    assert len(got) == 10
    r = {x.record_id: x for x in got}
    assert {k: (x.outcome, x.resolved_id, x.body) for k, x in r.items()} == {
        10: ("no_response", None, None), 11: ("resolved", 1, "one"), 12: ("resolved", 1, "one"), 13: ("resolved", 3, "three"),
        14: ("mismatch", 3, None), 15: ("resolved", 3, "three"), 16: ("no_response", None, None),
        17: ("no_response", None, None), 18: ("no_response", None, None)}
    assert r[11].headers == {"etag": "v1", "content-type": "t", "date": "d2"}
    assert resolve_revisits(spark.createDataFrame([], schema)).collect() == []


LONG = "<p>" + "Some long sentence, with commas, that goes on and on for a while. " * 4 + "</p>"
LONG_TEXT = " ".join(["Some long sentence, with commas, that goes on and on for a while."] * 4)


@pytest.mark.parametrize("html, want", [
    (f"<article class='post comments-open'>{LONG}</article>", LONG_TEXT),
    (f"<div id='content' class='has-sidebar'>{LONG}{LONG}</div><div class='sidebar-left'>{LONG}</div>", f"{LONG_TEXT} {LONG_TEXT}"),
    (f"<article><h2 id='search'>Search</h2>{LONG}</article>", f"Search {LONG_TEXT}"),
    (f"<article>{LONG}<section id='related-work'><h2>Related work</h2>{LONG}</section></article>",
     f"{LONG_TEXT} Related work {LONG_TEXT}"),
    (f"<article>{LONG}<ul><li><a href=a>One</a><li><a href=b>Two</a><li><a href=c>Three</a></ul></article>",
     f"{LONG_TEXT} One Two Three"),
    (f"<div class='modal'><article>{LONG}</article></div>", LONG_TEXT),
    (f"<article>{LONG}<div class='ad'>Buy</div><div class='cookie-banner'>Eat</div><div class='adverb'>slowly</div></article>"
     f"<div id=comments><article class='comment-body'>{LONG}</article></div><ul class=main-nav><li>Home</ul>", f"{LONG_TEXT} slowly"),
    (f"<div class='site-header'>Site</div><article>{LONG}</article><section class='comment-list'>{LONG}</section>", LONG_TEXT),
])
def test_names_count_as_a_whole(html, want):
    assert main_text(f"<html><body>{html}</body></html>") == want


def test_mix_oracle_on_unequal_sources(spark):
    """Exact weights: sources of 9 to 1 rows, a null source, and thousands of sources."""
    import duckdb

    from lakeingest.llm.pfair_mix import ORACLE, scheduled
    for data in ([(i, "big" if i % 10 else "small") for i in range(1, 600)] + [(None, "small"), (700, None)],
                 [(i, f"s{i % 40 * (i % 3)}") for i in range(900)], [(1, "a")], []):
        got = scheduled(spark.createDataFrame(data, "doc_id long, source string")).select("doc_id", "source", "mix.*")
        con = duckdb.connect()
        con.execute("CREATE TABLE documents (doc_id BIGINT, source VARCHAR)")
        if data:
            con.executemany("INSERT INTO documents VALUES (?, ?)", data)
        want = con.execute(ORACLE)
        assert [d[0] for d in want.description] == got.columns
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want.fetchall(), key=str)


def test_mix_keeps_columns_of_its_own_names(spark):
    from lakeingest.llm.pfair_mix import in_slots, mix_documents
    docs = spark.createDataFrame([(i, f"s{i % 3}", "m", i, "row", "k") for i in range(50)],
                                 "doc_id long, source string, mix string, slot long, row string, key string")
    assert sorted(map(tuple, mix_documents(docs).collect())) == sorted(map(tuple, docs.collect()))
    placed = in_slots(docs)
    assert placed.columns == ["doc_id", "source", "mix", "row", "key", "slot", "in_block"] and placed.count() == 50
