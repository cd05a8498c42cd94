"""URL rules, WARC bundles and HTML extraction against brute force."""

import base64
import hashlib
import random
import re
from collections import Counter

import pytest
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import functions as F

from postwave.llm import html_extract, url_rules, warc_bundles
from postwave.llm.queries import LLM_ORACLE, LLM_QUERIES

SF = "/root/testdata/sf0.01"
ODD = "page_id long, url string, html string, host string, tokens string, payload string, h string"
URLS = ["http://a.example.com/en/1", "https://WWW.Example.COM/en/x?q=1#f", "http://www.example.com/en/", "http://b.net/es/", "http://b.net/esx", "ftp://b.net/fr/y",
        "http://com", "http://com/", "http://xcom/", "no scheme", "", None, "://", "http://", "http://É.com/ü", "http://example.org:8080/en/?a&b=2", "x://y://z/en",
        "http://example.com?en/", "http://net/es/a\nb", "http://.net/fr/"]


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y", "z", "w") for i, u, h in rows], ODD)


def expected(url):
    host = path = ""
    if url is not None and "://" in url:
        m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1])
        host, path = re.sub("[A-Z]", lambda x: x.group().lower(), m.group(1)), m.group(2)
    fit = [r for r in url_rules.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fit, key=lambda r: len(r.text), default=None)
    return host, path, best and best.text, best and best.verdict


def test_given_rules(spark):
    rows = [(k, u, None) for k, u in enumerate(URLS)] + [(0, URLS[0], None), (None, URLS[3], None)]
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = url_rules.judge(pages(spark, rows), none).collect()
    want = Counter((i, *expected(u)[:3], expected(u)[3] or "allow") for i, u, _ in rows)
    assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got) == want
    assert url_rules.judge(pages(spark, []), none).collect() == []


def test_mined_rules_match_brute_force(spark):
    rows, labels = [], []
    for k in range(400):
        host = ["shop.spam.org", "news.fine.org", "blog.mixed.org"][k % 3]
        path = "/win/now" if k % 3 == 0 or k % 12 == 1 else "/read"
        rows.append((k, f"http://{host}{path}/{k}?ref=z", None))
        bad = k % 3 == 0 or (k % 3 == 1 and path == "/win/now")
        labels.append((k, None if k % 50 == 7 else 0 if bad else 1, 0))
    rows += [(1000, "http://shop.spam.org/other/1", None), (1001, None, None), (5, rows[5][1], None)]
    lab = spark.createDataFrame([*labels, (1, 1, 1), (None, 0, 1)], "doc_id long, quality int, toxic int")
    src = pages(spark, rows)
    urls = url_rules.parsed(src, "page_id", "url")
    rules = url_rules.mine(urls, lab).collect()
    token_of = {r.page_id: set(r.tokens) for r in urls.collect()}
    bad_of = {}
    for i, q, t in labels + [(1, 1, 1)]:
        if q is not None:
            bad_of[i] = bad_of.get(i, False) or q == 0 or t == 1
    seen = [(token_of[i], b) for i, b in bad_of.items()] + [(token_of[5], bad_of[5])]
    assert rules
    for r in rules:
        hold = [b for t, b in seen if set(r.antecedent) <= t]
        assert r.confidence == pytest.approx(sum(hold) / len(hold)) and r.confidence >= 0.6 and r.anchor in r.antecedent
    got = url_rules.judge(src, lab).collect()
    for r in got:
        hit = any(set(x.antecedent) <= token_of[r.page_id] for x in rules)
        assert (r.mined_rule is not None) == hit and r.verdict == ("block" if hit else "allow")
    assert {r.page_id for r in got if r.verdict == "block"} >= {0, 3, 1, 1000}
    assert len(got) == len(rows)


def test_mined_rules_see_late_segments_and_parameters(spark):
    rows, labels = [], []
    for k in range(120):
        path = "/a/b/c/d/" + ("casino" if k % 3 == 0 else "news")
        query = "?m=1&n=2&o=3&p=4&" + ("promo=1" if k % 3 == 1 else "page=1")
        rows.append((k, f"http://site.org{path}/{k}{query}", None))
        labels.append((k, 1 if k % 3 == 2 else 0, 0))
    lab = spark.createDataFrame(labels[:90], "doc_id long, quality int, toxic int")
    got = {r.page_id: r.verdict for r in url_rules.judge(pages(spark, rows), lab).collect()}
    assert got == {k: "allow" if k % 3 == 2 else "block" for k in range(120)}


def test_rules_are_mined_from_the_given_rules_verdicts(spark):
    src = spark.read.parquet(f"{SF.replace('0.01', '0.1')}/pages.parquet")
    got = url_rules.judge(src, min_lift=1.2).collect()
    mined = {r.mined_rule for r in got if r.mined_rule}
    assert mined and all(r.verdict == ("block" if r.mined_rule else "allow") for r in got if r.rule is None)
    assert any(r.verdict == "block" and r.rule is None for r in got)
    seen = [({*r.tokens}, expected(r.url)[3]) for r in url_rules.parsed(src, "page_id", "url").collect() if expected(r.url)[3]]
    for rule in mined:                                  # each is as sure on the covered pages as it claims
        hold = [v == "block" for t, v in seen if {*rule.split(" ")} <= t]
        assert sum(hold) >= 0.6 * len(hold) > 0 and all(r.confidence == pytest.approx(sum(hold) / len(hold)) for r in got if r.mined_rule == rule)


def test_url_query_uses_no_python_workers(spark):
    plan = LLM_QUERIES["op1_url_rules"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def warc_rows():
    big = "".join(f"<p>{k} ü</p>" for k in range(60_000))
    return [(5, "http://a/1", "same"), (3, "http://a/2", "same"), (9, None, None), (8, "http://b\r\nX: y", ""), (7, "http://c", big), (4, "http://a/3", "same"),
            (4, "http://a/3", "same"), (None, "http://d", "only"), (11, "http://e", "only"), (12, "http://f", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n")]


def test_warc_round_trip(spark):
    rows = warc_rows()
    manifest = warc_bundles.write(pages(spark, rows).repartition(3), frame_bytes=200)
    got = warc_bundles.read(manifest).collect()
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    want = Counter()
    for i, _, h in rows:
        p = (h or "").encode()
        refers = first[h or ""] if i != first[h or ""] else None
        want[None if i is None else str(i), len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if refers is not None else "response",
             None if refers is None else str(refers), None if refers is not None else p] += 1
    key = lambda r: (r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload))
    assert Counter(map(key, got)) == want
    wanted = spark.createDataFrame([(7,), (4,), (999,)], "page_id long")
    assert Counter(map(key, warc_bundles.fetch(manifest, wanted).collect())) == Counter({k: n for k, n in want.items() if k[0] in ("7", "4")})


def test_warc_frames_are_independent_and_seekable(spark):
    manifest = warc_bundles.write(pages(spark, warc_rows()).coalesce(1), frame_bytes=100).collect()
    (uri,) = {r.path for r in manifest}
    fs, path = pafs.FileSystem.from_uri(uri)
    raw = fs.open_input_file(path).read()
    table = warc_bundles.seek_table(fs.open_input_file(path))
    assert {(r.frame_start, r.frame_bytes) for r in manifest} == {(a, n) for a, n, _ in table} and len(table) > 3
    for r in manifest:
        data = zstandard.ZstdDecompressor().decompress(raw[r.frame_start:r.frame_start + r.frame_bytes])
        (rec,) = warc_bundles.records(data[r.record_start:r.record_start + r.record_bytes])
        assert rec["page_id"] == r.page_id and rec["record_type"] == r.record_type
    # A plain zstd reader sees the whole archive: the seek table is a skippable frame.
    whole = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
    assert len(list(warc_bundles.records(whole))) == len(warc_rows())


def test_warc_of_an_empty_table_and_of_short_payloads(spark):
    assert warc_bundles.read(warc_bundles.write(pages(spark, []))).collect() == []
    got = warc_bundles.read(warc_bundles.write(pages(spark, warc_rows()), min_bytes=5)).collect()
    assert all(r.record_type == "response" for r in got)


def test_warc_reader_refuses_a_changed_payload():
    rec = warc_bundles.record("1", "u", b"abc", 3, base64.b32encode(hashlib.sha1(b"abd").digest()).decode(), None, "d")
    with pytest.raises(ValueError):
        list(warc_bundles.records(rec))


ARTICLE = "<article><h1>A title</h1><p>First <b>bold</b>part of it.<p>Second   part &amp; more,<br>next line.</p><ul><li>one thing</li><li>other &eacute;</li></ul></article>"
TEXT = "A title\nFirst boldpart of it.\nSecond part & more,\nnext line.\none thing\nother é"


@pytest.mark.parametrize("page, text", [
    (ARTICLE, TEXT),
    (f"<html><head><title>t</title><style>p{{}}</style><script>var a='</p>';</script></head><body><nav><ul><li><a href=/x>menu</a></li></ul></nav>{ARTICLE}<footer>foot words here</footer></body></html>", TEXT),
    (f"<body><header>site header</header><aside>side words</aside><main>{ARTICLE}</main><div class='comments'><article><p>a reader wrote many many words here</p></article></div>", TEXT),
    (ARTICLE.replace("<p>Second", "<div class='ad-banner'>buy now please</div><form><input>your mail</form><p>Second").replace("</article>", "<footer>by nobody</footer></article>"), TEXT),
    (f"<div id=cookie-notice>we use cookies and more</div>{ARTICLE}<section id=comments><p>nice article by the way, thanks</p></section>", TEXT),
    ("", ""), ("just text", "just text"), ("a < b &lt; c", "a < b < c"), ("<nav>only menu", ""), ("<p>cut off <b>he", "cut off he"), ("<!-- x --><p>seen</p><!-- cut", "seen"),
    ("<p>x" + "y " * 30_000 + "</p>", "x" + "y " * 29_999 + "y"), ("<" * 3000, "<" * 3000), ("<p a='" * 500 + "end", None),
])
def test_main_text(page, text):
    got = html_extract.main_text(page, html_extract.weights({}))
    assert text is None or got == text


@pytest.mark.parametrize("page, text", [
    ('<article><p>one <svg class="i"/> two three</p><p>four</p></article>', "one two three\nfour"),
    ("<html><head><title>t</title><p>all the text</p>", "all the text"),
    ("<html><head><meta charset=utf-8><noscript><img src=x></noscript>all the text", "all the text"),
    ("<html><head><title>t</title><body><p>all the text</p></html>", "all the text"),
    ("<article><p>one <svg><path d='m'> two</p><p>four</p></article>", "one two\nfour"),
    ("<article><p>one <svg><text>label</text><path d='m'/></svg> two</p><p>four</p></article>", "one two\nfour"),
    ("<article><iframe src=x><p>one two</p><object data=y /><p>three</p></article>", "one two\nthree"),
    ("<article><p>one <svg> <p>two three</p><svg><g>label</g></svg><p>four</p></article>", "one\ntwo three\nfour"),
    ("<article><p>one</p><select><option>a<option>b</select><noscript><p>turn on</p></noscript><p>two</p></article>", "one\ntwo"),
    ("<article><p>so <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> holds</p></article>", "so x=1 holds"),
    ("<p>one</p><template><p>no</p></template><p>two</p><script>var a='<p>no</p>'", "one\ntwo"),
])
def test_elements_without_an_end_tag_cut_nothing(page, text):
    assert html_extract.main_text(page, html_extract.weights({})) == text


def test_html_extraction_over_the_pages(spark):
    def truth(page):
        body = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S).group(1)
        import html
        parts = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", x))).strip() for x in re.split(r"</?(?:p|h1|br)>", body)]
        return "\n".join(x for x in parts if x)

    src = spark.read.parquet(f"{SF}/pages.parquet")
    want = {r.page_id: truth(r.html) for r in src.collect()}
    got = html_extract.extract(src).collect()
    assert {r.page_id: r.text for r in got} == want and all(r.n_chars == len(r.text) for r in got)


def test_html_extraction_odd_rows(spark):
    rows = [(1, None, None), (2, "u", ""), (3, "u", ARTICLE), (3, "u", ARTICLE), (None, "v", "<p>words</p>")]
    got = html_extract.extract(pages(spark, rows)).collect()
    assert Counter((r.page_id, r.url, r.text, r.n_chars) for r in got) == Counter(
        [(1, None, "", 0), (2, "u", "", 0), (3, "u", TEXT, len(TEXT)), (3, "u", TEXT, len(TEXT)), (None, "v", "words", 5)])
    assert html_extract.extract(pages(spark, [])).collect() == []


def test_learned_weights_follow_the_labelled_pages(spark):
    rows = [(k, "u", f"<div class=qqx>junk words {k} of this box</div><article><p class=lead>main words {k} here and there</p></article>") for k in range(40)]
    w = html_extract.fit(pages(spark, rows))
    assert w["n:qqx"] < -2 < 0 < w["n:lead"] and w["T:div"] < w["T:p"] < 0
    assert html_extract.main_text("<div class=qqx>junk words one two three</div><div><p class=lead>the main words</p></div>", w) == "the main words"


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_oracle(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = LLM_QUERIES[name](spark, SF)
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({LLM_ORACLE[name]})").fetchall()
    assert Counter(map(tuple, df.collect())) == Counter(want)


PROSE = "The quick brown fox jumps over the lazy dog and then it runs away from the farm again."


@pytest.mark.parametrize("page,kept,gone", [
    (f'<body class="single post no-sidebar"><h1>Head</h1><p>{PROSE}</p></body>', 1, ""),
    (f'<body><div class="elementor-widget-container"><p>{PROSE}</p><p>{PROSE}</p></div></body>', 2, ""),
    (f'<form id=aspnetForm><div><h1>Head</h1><p>{PROSE}</p></div></form>', 1, ""),
    (f'<article><p>{PROSE}</p><p class="related-work">{PROSE}</p></article>', 2, ""),
    (f'<article><p>{PROSE}</p><div class="related"><a href=x>Other news of the day</a> <a href=y>More news to read here</a></div></article>', 1, "news"),
    (f'<body><div class=post><p>{PROSE}</p></div><div class="comments"><p>{"reader says so " * 60}</p></div></body>', 1, "reader"),
    (f'<body><div class=post><p>{PROSE}</p></div><footer><p>{"legal words here " * 60}</p></footer></body>', 1, "legal"),
])
def test_names_weigh_but_do_not_exclude_alone(page, kept, gone):
    got = html_extract.main_text(page, html_extract.weights({}))
    assert got.count(PROSE) == kept and (not gone or gone not in got)


def test_deep_and_unmatched_pages_take_linear_time():
    import time
    for page, words in (("<div>" * 20_000 + "word " * 30 + "</div>" * 20_000, 30), ("<div>" * 20_000 + "</p>" * 20_000, 0),
                        ("<svg>" + "<g>" * 20_000 + "<li>one", None), ("<article>" + "<div class=x>a b " * 5_000, 10_000)):
        began = time.time()
        got = html_extract.main_text(page, html_extract.weights({}))
        html_extract.observe("<article>" + page)
        assert time.time() - began < 10 and (words is None or len(got.split()) == words)


def test_the_chosen_run_is_the_best_of_all_runs():
    rnd = random.Random(9)
    for _ in range(300):
        gains = [rnd.choice([(float(rnd.randint(1, 9)), -1.0), (0.0, rnd.random() * 4), (-rnd.random() * 3, 0.0), (0.0, 0.0)]) for _ in range(rnd.randint(0, 25))]
        run, worth = 0.0, []
        for gain, cost in gains:                        # a run of boilerplate words costs RUN_COST at most
            paid = min(cost, html_extract.RUN_COST - run) if cost > 0 else 0.0
            run = run + paid if cost > 0 else 0.0 if cost < 0 else run
            worth.append(gain - paid)
        begin, end = html_extract.best_run(gains)
        every = [sum(worth[a:b]) for a in range(len(worth)) for b in range(a + 1, len(worth) + 1)]
        assert abs(sum(worth[begin:end]) - max([0.0, *every])) < 1e-9


def test_archive_ids_are_unique_and_read_in_ranges(spark):
    rows = [("a\r\nX-Page-ID: forged", "u", f"payload {k}" * 50) for k in range(3)] + [(None, "u", "x"), (None, "v", "y"), ("50%41", None, "z"), ("b", None, "z")]
    df = spark.createDataFrame(rows, "page_id string, url string, html string")
    manifest = warc_bundles.write(df, frame_bytes=200)
    back = warc_bundles.read(manifest, range_bytes=300)
    assert back.rdd.getNumPartitions() > 1
    got = back.collect()
    assert Counter(r.page_id for r in got) == Counter(r[0] for r in rows)
    assert {r.page_id: r.refers_to for r in got if r.record_type == "revisit"} == {"b": "50%41"}
    urns = []
    for row in manifest.select("path").distinct().collect():
        with pafs.FileSystem.from_uri(row.path)[0].open_input_file(pafs.FileSystem.from_uri(row.path)[1]) as f:
            for start, n, size in warc_bundles.seek_table(f):
                f.seek(start)
                urns += re.findall(rb"WARC-Record-ID: (\S+)", zstandard.ZstdDecompressor().decompress(f.read(n), max_output_size=size))
    assert len(urns) == len(set(urns)) == len(rows)
