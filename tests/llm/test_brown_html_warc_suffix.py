"""Language-model scores, HTML extraction, WARC archives, repeated strings."""

import collections
import gzip
import glob
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

import __spark_entry__ as E
from maskweave.llm import brown, html_extract, suffix_dedup, warc
from maskweave.llm.common import word_slices
from maskweave.session import scratch_path


def tokens(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None]


def check_scores(rows, docs, train):
    c = collections.Counter(w for k, t in docs if train(k) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    want = sorted((k, len(tokens(t)), sum(c[w] > 0 for w in tokens(t)),
                   round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t)), 6)) for k, t in docs)
    assert sorted((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in rows) == want
    assert {r.train_tokens for r in rows} == {n}


def test_brown_counts_and_gain(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    rows = E.queries()["op2_lm_scoring"](spark, SF_SMALL).collect()
    check_scores(rows, docs, lambda k: zlib.crc32(str(k).encode()) % 10 != 0)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_brown_edges_and_texts_longer_than_a_block(spark, monkeypatch):
    docs = [(1, None), (2, ""), (3, "a b a b a c"), (3, "a b a b a c"), (4, "A b new"), (6, "x y " * 3000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("x"))
    whole = brown.train_and_score(df, F.col("doc_id") != 4).collect()
    check_scores(whole, docs, lambda k: k != 4)
    blocks = brown._Blocks()
    monkeypatch.setattr(brown, "BLOCK", 7)
    words = np.arange(1, 24, dtype=np.uint64)
    out = list(blocks.add(1, 0, True, words)) + ([blocks.flush()] if blocks.n else [])
    own = [w for b in out for w, n in zip(b.column("words")[0].as_py(), b.column("counts")[0].as_py()) for _ in range(n)]
    assert sorted(own) == words.tolist() and len(out) == 4
    assert brown.train_and_score(df.limit(0), F.lit(True)).count() == 0
    none = brown.train_and_score(df, F.lit(False)).collect()
    assert {r.train_tokens for r in none} == {0} and {r.n_known for r in none} == {0}


def plain_scores(docs, train, core_n, classes, mixed, rounds):
    """The class model on plain dictionaries; words go by their hashes."""
    import pyarrow as pa

    def hashed(t):
        return [int(h) for _, _, hs, _ in word_slices(pa.array([t or ""])) for h in hs] + [int(brown.END)]

    texts = [(k, hashed(t)) for k, t in docs]
    c = collections.Counter(w for k, t in texts if train(k) for w in t)
    n, v = sum(c.values()), len(c)
    pairs = collections.Counter(p for k, t in texts if train(k) for p in zip(t, t[1:]))
    signed = lambda w: w - (1 << 64) if w >> 63 else w
    core = sorted(sorted(c, key=lambda w: (-c[w], signed(w)))[:core_n])
    place = {w: i for i, w in enumerate(core)}
    cls = {}

    def table(item):
        out = np.zeros((len(core) + classes, len(core) + classes))
        for (a, b), m in pairs.items():
            if item(a) is not None and item(b) is not None:
                out[item(a), item(b)] += m
        return out

    def item(w):
        return place.get(w, len(core) + cls[w] if w in cls else None)

    def others(by_item, core_cls):
        seen = np.full((classes, classes), 0.01)
        of = [*core_cls, *range(classes)]
        for i, j in zip(*np.nonzero(by_item)):
            seen[of[i], of[j]] += by_item[i, j]
        after, before = np.log(seen / seen.sum(axis=1, keepdims=True)), np.log(seen / seen.sum(axis=0))
        now = {**cls, **{w: core_cls[i] for w, i in place.items()}}
        gain = {}
        for (a, b), m in pairs.items():
            if a not in place and b in now:
                gain[a] = gain.get(a, 0) + m * after[:, now[b]]
            if b not in place and a in now:
                gain[b] = gain.get(b, 0) + m * before[now[a]]
        return {w: int(np.argmax(g)) for w, g in gain.items()}

    by_item, counts = table(item), np.array([c[w] for w in core])
    core_cls = brown.exchange(by_item[:len(core), :len(core)], counts, classes)
    cls = others(by_item, core_cls)
    for _ in range(rounds):
        by_item = table(item)
        core_cls = brown.exchange(by_item, counts, classes, start=np.append(core_cls, range(classes)))[:len(core)]
        cls = others(by_item, core_cls)
    cls = {**{w: classes - 1 for w in c}, **cls, **{w: core_cls[i] for w, i in place.items()}}
    seen, size = np.zeros((classes + 2, classes)), np.zeros(classes)
    for k, t in texts:
        for a, b in zip([None, *t], t):
            if train(k):
                seen[classes if a is None else cls.get(a, classes + 1), cls[b]] += 1
                size[cls[b]] += 1
    prior = (size + 0.1) / (size.sum() + 0.1 * classes)
    move = (seen + prior) / (seen.sum(axis=1, keepdims=True) + 1)
    return [(k, sum(math.log10(
        (1 - mixed) * (c[b] + 0.1) / (n + 0.1 * (v + 1))
        + (mixed * move[classes if a is None else cls.get(a, classes + 1), cls[b]] * c[b] / size[cls[b]] if b in c else 0))
        for a, b in zip([None, *t], t))) for k, t in texts]


@pytest.mark.parametrize("share", [3, 10_000])  # words summed in tasks, and words sent as lists
def test_brown_scores_by_brute_force(spark, monkeypatch, share):
    monkeypatch.setattr(brown, "HOT_SHARE", share)
    rng = np.random.default_rng(5)
    docs = [(k, " ".join(f"w{int(x)}" for x in rng.zipf(1.4, 60) % 97)) for k in range(40)] + [(40, None), (41, "new w1")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for rounds in (0, 2):
        got = brown.train_and_score(df, F.col("doc_id") % 7 != 6, core_words=12, classes=4, mixed=0.6, rounds=rounds)
        want = dict(plain_scores(docs, lambda k: k % 7 != 6, 12, 4, 0.6, rounds))
        assert {r.doc_id: round(r.score, 6) for r in got.collect()} == {k: round(x, 6) for k, x in want.items()}


def test_exchange_finds_planted_classes():
    rng = np.random.default_rng(0)
    kind = rng.integers(0, 3, 60)
    seq = []
    for k in range(30_000):  # classes follow one another in a cycle
        seq.append(rng.choice(np.flatnonzero(kind == k % 3)))
    pairs = np.zeros((60, 60))
    np.add.at(pairs, (seq[:-1], seq[1:]), 1)
    got = brown.exchange(pairs, pairs.sum(axis=1), classes=3)
    assert len({(a, b) for a, b in zip(kind, got)}) == 3


def test_exchange_gain_never_lowers_the_likelihood():
    rng = np.random.default_rng(1)
    pairs = rng.poisson(0.7, (40, 40)).astype(float)

    def likelihood(cls):
        m = np.eye(5)[cls]
        big = m.T @ pairs @ m
        f = lambda x: (x * np.log(np.maximum(x, 1))).sum()
        return f(big) - f(big.sum(axis=0)) - f(big.sum(axis=1))

    last = -np.inf
    for sweeps in range(4):
        now = likelihood(brown.exchange(pairs, pairs.sum(axis=1), classes=5, sweeps=sweeps))
        assert now >= last - 1e-9
        last = now


PAGE = """<!DOCTYPE html><html><head><title>No</title><script>var a = "<p>no</p>";</script></head><body class="has-sidebar">
<header><h1>no</h1></header><nav><ul><li><a href="/x">no</a></ul></nav><div id="cookie-notice">no</div>
<article><h1>Title &amp;  more</h1><p>One<br>two&nbsp;three <b>bold</b><p>Four <!-- no --> five<style>p{}</style>
<aside>no</aside><ul><li>six<li>seven</ul><form><p>no</form><pre>eight
  nine</pre><div class="comments"><p>no</p></div></article><div class="ad banner">no</div><footer>no</footer></body></html>"""
TEXT = "Title & more\n\nOne two three bold\n\nFour five\n\nsix\n\nseven\n\neight nine"


def test_page_text():
    page = html_extract.Page(PAGE)
    assert page.best()[0] == "/body.has-sidebar/article" and page.text(None) == TEXT
    assert html_extract.Page("").text(None) == "" and html_extract.Page("a &lt; b < c").text(None) == "a < b < c"
    assert html_extract.Page("<p>open <i>tags").text(None) == "open tags"


def test_wrappers_named_like_menus_keep_the_page():
    inner = "<p>" + "words of the article " * 9 + "</p>"
    text = " ".join(inner[3:-4].split())
    side = "<div class='sidebar'><p>no</p></div><form><p>no</p></form>"
    for wrapper in ("<div class='page-with-sidebar'>", "<div class='main-content sidebar-left'>",
                    "<div class='layout header-fixed'>", "<form id='form1'>", "<form class='aspnet'><div id='nav-top'>"):
        for entry in (f"<div class='entry'>{inner}</div>", f"<article>{inner}</article>"):
            page = f"<body><p>few words</p>{wrapper}{entry}{side}"
            assert html_extract.Page(page).text(None) == text, (wrapper, entry)
    assert html_extract.Page(f"<body><div class='widget'><main>{inner}</main></div>").text(None) == text
    # what is not the article stays out, however long
    long = "<p>" + "no " * 999 + "</p>"
    for other in ("<div class='comments'>", "<div id='cookie-notice'>", "<div class='comments-area'><article>",
                  "<div class='sidebar'>", "<nav>", "<aside>", "<div hidden>"):
        page = f"<body><div class='post'>{inner}</div>{other}{long}"
        assert html_extract.Page(page).text(None) == text, other
    assert html_extract.Page(f"<body><nav>{long}</nav>").text(None) == ""


def test_parts_of_an_article_stay_with_its_title():
    page = ("<body><div class='post'><h1>Title</h1><div class='lead'><p>lead</p></div><div class='entry'><p>"
            + "entry " * 99 + "</p></div></div><div class='other'><p>no</p></div>")
    assert html_extract.Page(page).text(None) == "Title\n\nlead\n\n" + ("entry " * 99).strip()


def test_html_query_brute_force(spark):
    import html

    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()
    rows = {r.page_id: r for r in E.queries()["op1_html_extraction"](spark, SF_SMALL).collect()}
    for p in pages:  # the tables' pages have one article with headings and paragraphs
        inner = re.search(r"<article>(.*)</article>", p.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert rows[p.page_id].text == "\n\n".join(b for b in blocks if b)
        assert rows[p.page_id].n_chars == len(rows[p.page_id].text) and rows[p.page_id].url == p.url


def test_host_votes_decide(spark):
    """A page whose comments outweigh its article follows its host."""
    usual = "<body><div class='post-{}'><p>{}</p></div><div class='talk'><p>short</p></div></body>"
    rows = [(k, "http://H.example:80/x", usual.format(k, "long article text " * 9), "t") for k in range(5)]
    rows.append((9, "https://h.example/y", "<body><div class='post-9'><p>brief</p></div><div class='talk'><p>"
                 + "talk " * 90 + "</p></div></body>", "t"))
    rows += [(10, None, None, "t"), (11, "http://h.example/", "", "t"), (11, "http://h.example/", "", "t"),
             (None, "no url", "<p>alone " + "z" * 200_000, "t")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = [(r.page_id, r.text) for r in html_extract.extract(df).collect()]
    assert len(got) == len(rows) and dict(got)[9] == "brief" and dict(got)[10] == "" and dict(got)[11] == ""
    assert dict(got)[None].endswith("zzz")
    assert html_extract.extract(df.limit(0)).count() == 0


def test_warc_round_trip_and_standard_members(spark):
    rows = [(5, "http://a/1", "same", "x"), (3, "http://a/2", "same", "x"), (4, None, None, "x"), (6, "u", "", "x"),
            (7, "http://a/é\n%", "ü" * 100_000, "x"), (3, "http://a/2", "same", "x"), (None, "u", "same", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    folder = scratch_path(spark, "warc-test")
    index = warc.write(df, folder)
    got = warc.read(index, folder).collect()
    assert sorted(((r.key, r.record_type, r.refers_to) for r in got), key=str) == sorted(
        [(5, "revisit", 3), (3, "response", None), (3, "response", None), (4, "response", None), (6, "revisit", 4),
         (7, "response", None), (None, "revisit", 3)], key=str)
    long = next(r for r in got if r.key == 7)
    assert bytes(long.payload).decode() == "ü" * 100_000 and long.url == "http://a/é\n%" and long.payload_bytes == 200_000
    data = b"".join(gzip.open(p).read() for p in glob.glob(folder.removeprefix("file:") + "/*.warc.gz"))
    assert data.count(b"WARC/1.1\r\n") == len(rows)
    some = warc.read(index.where("key = 5"), folder).collect()  # only selected records
    assert [(r.key, r.payload_bytes) for r in some] == [(5, 4)]
    assert {r.record_type for r in warc.read(warc.write(df, scratch_path(spark, "w"), least=10 ** 7), folder).limit(0).collect()} == set()
    big = warc.write(df, scratch_path(spark, "w"), least=4)
    assert {(r.key, r.record_type) for r in big.collect() if r.key in (4, 6)} == {(4, "response"), (6, "response")}
    assert warc.round_trip(df.limit(0)).count() == 0


def test_warc_detects_changed_archives(spark):
    df = spark.createDataFrame([(1, "u", "payload")], "page_id long, url string, html string")
    folder = scratch_path(spark, "warc-test")
    index = warc.write(df, folder).withColumn("payload_digest", F.lit("X" * 32))
    with pytest.raises(Exception, match="differs from its digest"):
        warc.read(index, folder).collect()


def brute_removed(docs, length):
    low = {}
    for k, t in docs:
        raw = (t or "").encode()
        for i in range(len(raw) - length + 1):
            w = raw[i:i + length]
            low[w] = min(low.get(w, k), k)
    out = []
    for k, t in docs:
        raw = (t or "").encode()
        gone = [False] * len(raw)
        for i in range(len(raw) - length + 1):
            if low[raw[i:i + length]] < k:
                gone[i:i + length] = [True] * length
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((k, len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_suffix_brute_force(spark):
    rnd = random.Random(6)
    pool = ["".join(rnd.choice("ab é") for _ in range(rnd.randrange(20, 160))) for _ in range(12)]
    docs = [(k, "".join(rnd.choice(pool) for _ in range(rnd.randrange(0, 6)))) for k in range(60)]
    docs += [(100, "a" * 300), (90, "a" * 120), (91, "a" * 51), (92, "a" * 49), (93, None), (94, ""), (95, "=" * 70),
             (80, docs[3][1]), (81, docs[3][1]), (95, "=" * 70), (200, "q" * 20_000 + pool[0] + pool[1]), (201, pool[1] + "q" * 70)]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, digest string")
    got = sorted(tuple(r) for r in suffix_dedup.report(df).collect())
    assert got == brute_removed(docs, 50)
    got = sorted(tuple(r) for r in suffix_dedup.report(df, 24).collect())
    assert got == brute_removed(docs, 24)


def test_suffix_edges(spark):
    df = spark.createDataFrame([(None, "z" * 60), (1, "z" * 55)], "doc_id long, text string")
    assert sorted((r.n_bytes, r.n_removed, r.n_spans) for r in suffix_dedup.report(df).collect()) == [(55, 0, 0), (60, 60, 1)]
    assert suffix_dedup.report(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        suffix_dedup.report(df, 100)


def test_columns_are_sorted_suffixes_with_their_common_prefixes():
    rng = np.random.default_rng(2)
    m = rng.integers(97, 99, (50, 11)).astype(np.uint8)
    for column, order, prefix in suffix_dedup.columns(m, 5):
        suffixes = [bytes(m[i, column:]) for i in order]
        assert suffixes == sorted(suffixes)
        for i in range(1, len(order)):
            a, b = suffixes[i - 1], suffixes[i]
            same = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
            assert prefix[i] == min(same, 5)


LONG = "Long text of the article that goes on for a while and says something. " * 4


@pytest.mark.parametrize("source,want", [
    ('<article><h1 class="header-title">Title</h1><p>Text.</p></article>', "Title\n\nText."),
    ('<article><h1>T</h1><p>It costs <span class="share-price">12 dollars</span> today.</p></article>',
     "T\n\nIt costs 12 dollars today."),
    (f'<article><h1>T</h1><p>{LONG}</p><section class="related-work"><h2>Related work</h2><p>Others did so.</p>'
     '</section></article>', f"T\n\n{LONG.strip()}\n\nRelated work\n\nOthers did so."),
    ('<article><h1>T</h1><p class="ad-free">Free of adverts.</p></article>', "T\n\nFree of adverts."),
    ('<article><h1>T</h1><blockquote class="legal-notice">Quoted law.</blockquote></article>', "T\n\nQuoted law."),
    (f'<body><div class=page><div>{LONG}</div><div>Second part of the same, not as long but text.</div></div></body>',
     f"{LONG.strip()}\n\nSecond part of the same, not as long but text."),
    (f'<body><div class=post><h2>Title</h2><div class=lead>Lead.</div><div class=entry><p>{LONG}</p></div></div></body>',
     f"Title\n\nLead.\n\n{LONG.strip()}"),
    # what is not the article goes as before
    (f'<body><div class=post><h1>T</h1><p>{LONG}</p></div><div class="sidebar-left"><p>{LONG[:90]}</p></div></body>',
     f"T\n\n{LONG.strip()}"),
    (f'<article><h1>T</h1><p>{LONG}</p><p class="notice">We use cookies.</p><div class="related-posts"><p>See others.</p>'
     '</div><ul class="share-links"><li>Tell</li></ul><div class="comment-list"><p>First!</p></div></article>',
     f"T\n\n{LONG.strip()}"),
    ('<article><h1>T</h1><p>Text.</p><section class="related-work"><a href=x>One</a> <a href=y>Two</a></section></article>',
     "T\n\nText."),
    ('<article><h1>T</h1><p>Text.</p><h2 class="comments">Comments</h2></article>', "T\n\nText."),
])
def test_names_drop_no_article_text(source, want):
    assert html_extract.Page(source).text(None) == want
