"""Web pages: main text and archive."""

import hashlib
from collections import Counter

import pytest
from check import compare, connect

from marquee.llm import warc
from marquee.llm.html_text import extract
from marquee.llm.queries import ORACLES, QUERIES

SCHEMA = "page_id long, url string, html string"
PAGE = """<!DOCTYPE html><html class="js"><head><title>T</title><style>p{{}}</style><script>var a="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><!-- c --><div class="cookie-notice">We use cookies<div>now</div></div>
<main id="page"><h1>Title&nbsp;{0}</h1><p>First <b>bold</b> &amp; part{0}.<br>Line &lt;two&gt;</p><div class="ad">Buy <p>things</p></div><aside>Side</aside>
<form><input name=q>Search</form><p>Last   part &eacute;</p><section id='comments'><article>Nice post</article></section></main>
<footer>&copy; Us</footer></body></html>"""


def texts(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS host", "'y' AS part", "'z' AS text").repartition(3)
    return {r["page_id"]: r for r in extract(df).collect()}


def test_main_text(spark):
    got = texts(spark, [(i, f"https://h.example/{i}", PAGE.format(i)) for i in range(3)])
    for i in range(3):
        assert got[i]["text"] == f"Title {i} First bold & part{i}. Line <two> Last part é" and got[i]["n_chars"] == len(got[i]["text"])


def test_pages_without_a_content_element(spark):
    rows = [(i, "http://a.example/", f"<div>Our site is the best site that you can find on the web</div><p>{' '.join(f'word{i}x{j}' for j in range(12))}</p>") for i in range(4)]
    got = texts(spark, rows)
    assert all(got[i]["text"] == " ".join(f"word{i}x{j}" for j in range(12)) for i in range(4))


def test_copies_of_an_article_stay(spark):
    rows = [(i, "http://a.example/", "<article><p>" + "the same words again and again in every copy of it</p></article>") for i in range(40)]
    assert {r["text"] for r in texts(spark, rows).values()} == {"the same words again and again in every copy of it"}


@pytest.mark.parametrize(
    ("html", "text"),
    [(None, ""), ("", ""), ("plain &amp words", "plain & words"), ("<p>cut <a hre", "cut"), ("<p>a<script>x", "a"), ("a < b <p>c", "a < b c"), ("<nav>menu<article>x y</article>", "x y"), ("<p title='a>b'>t</p>", "t"), ("<ul><li>a<li>b</ul>", "a b"), ("<div class='page with-sidebar'><main class='no-header'>t</main></div>", "t"), ("<main>t<article class='comment'>c</article></main>", "t")],
)
def test_odd_markup(spark, html, text):
    assert texts(spark, [(1, None, html)])[1]["text"] == text


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<p class=notice>Site notice<p>The real article text<p>more", "The real article text more"),
        ("<ul><li class=menu>x<li>real one</ul><p>rest", "real one rest"),
        ("<nav><a>Home</a><p>real text</p>", "real text"),
        ("<div><nav><ul><li>menu</ul></nav><p>real</div><p>more", "real more"),
        ("<table><tr><td>a<td class=ad>b<tr><td>c</table>d", "a c d"),
        ("<dl><dt>a<dd class=ad>b<dt>c</dl>", "a c"),
        ("<div>a</p>b</div>", "a b"),
        ("<section id=comments><article>Nice</article></section><p>ok", "ok"),
        ("<form><main>z</main>q</form>", "z"),
        ("<article>a <math><mi>x</mi></math> b <object>o</object> <canvas>c</canvas></article>", "a x b o c"),
        ("<article><div class=share-price>5</div><div class='search-theory'>6</div><h2 id=discussion>D</h2><p class=related-work>7</article>", "5 6 D 7"),
        ("<article>t<div class='share-buttons'>S</div><div class=comment-list>C</div><header><h1>H</h1></header></article>", "t"),
        ("<div/><p>" * 3000 + "deep", "deep"),
    ],
)
def test_ends_and_names(spark, html, text):
    assert texts(spark, [(1, None, html)])[1]["text"] == text


def words(seed, n):
    return " ".join(f"w{seed}x{i}" for i in range(n))


def test_near_copies_and_quotations_stay(spark):
    rows = [(i, "http://a.example/", f"<p>{words(0, 300)}</p><p>{i} May</p>") for i in range(2)]
    rows += [(10 + i, "http://b.example/", f"<p>{words(0, 300)}</p><p>{i} May</p>") for i in range(7)]
    rows += [(20 + i, "http://c.example/", f"<p>{words(20 + i, 60)}</p><p>{words(1, 20) if i < 2 else words(90 + i, 20)}</p>") for i in range(6)]
    got = texts(spark, rows)
    assert all(got[i]["text"] == f"{words(0, 300)} {i % 10} May" for i in (0, 1, *range(10, 17)))
    assert all(got[20 + i]["text"] == f"{words(20 + i, 60)} {words(1, 20) if i < 2 else words(90 + i, 20)}" for i in range(6))


def test_template_goes_where_most_pages_are_copies(spark):
    template = f"<p>{words(7, 40)}</p>"
    rows = [(i, "http://a.example/", f"{template}<p>{words(0, 300)}</p><p>copy {i}</p>") for i in range(6)]
    rows += [(10 + i, "http://a.example/", f"{template}<p>{words(10 + i, 60)}</p>") for i in range(4)] + [(20, "http://a.example/", template)]
    got = texts(spark, rows)
    assert all(got[i]["text"] == f"{words(0, 300)} copy {i}" for i in range(6))
    assert all(got[10 + i]["text"] == words(10 + i, 60) for i in range(4)) and got[20]["text"] == ""


@pytest.mark.parametrize("n", [3, 1999, 2001, 20_000])
@pytest.mark.parametrize("tag", ["div", "article"])
def test_hosts_of_any_size(spark, n, tag):
    """A template goes from all pages; what four pages share stays on all of them."""
    html = f"concat('<{tag}><p>{words(1, 12)}</p><p>', if(id < 4, '{words(2, 30)}', concat_ws(' ', transform(sequence(1, 30), i -> concat('u', id, 'x', i)))), ' ', id, '</p></{tag}>')"
    pages = spark.range(n).selectExpr("id AS page_id", "'https://h.example/' AS url", f"{html} AS html")
    got = extract(pages)
    want = f"concat(if(page_id < 4, '{words(2, 30)}', concat_ws(' ', transform(sequence(1, 30), i -> concat('u', page_id, 'x', i)))), ' ', page_id)"
    if n == 3:  # here all pages share it, and are near copies of one another
        want = f"concat('{words(1, 12)} ', {want})"
    assert got.count() == n and got.where(f"text <> {want}").count() == 0


def chosen_by_hand(blocks):
    """The smallest of every eight runs of eight words in a row, stretch by stretch."""
    import numpy as np

    from marquee.llm.common import WordHashes, shingles

    out, waiting = set(), None
    stretches = []
    for words in (b.split() for b in blocks):
        if len(words) < 8 and waiting is not None:
            waiting += words
            continue
        waiting = words if len(words) < 8 else None
        stretches.append(words)
    for words in stretches:
        if len(words) >= 8:
            runs = [int(x) for x in shingles(WordHashes().of([w.encode() for w in words]), 8)]
            out |= {min(runs[i : i + 8]) for i in range(len(runs) - 7)} if len(runs) > 8 else set(runs)
    return set(np.array(sorted(out), np.uint64).view(np.int64).tolist())


def test_templates_against_brute_force(spark):
    """Runs counted page by page in plain Python on random pages of few words."""
    import numpy as np

    from marquee.llm import html_text
    from marquee.llm.common import WordHashes

    rng = np.random.default_rng(4)
    rows = []
    for i in range(120):
        blocks = [" ".join(map(str, rng.integers(0, 400, rng.integers(1, 40)))) for _ in range(3)] + [words(h, 25) for h in range(6) if rng.random() < 0.2 + 0.1 * h]
        rng.shuffle(blocks)
        rows.append((i, f"http://h{i % 3}.example/", "".join(f"<p>{b}</p>" for b in blocks)))
    got = {r["host"]: set(r["template"]) for r in html_text.host_templates(spark.createDataFrame(rows, SCHEMA).selectExpr("regexp_extract(url, '//([^/]*)', 1) AS host", "html").repartition(4)).collect()}
    for h in range(3):
        pages = {tuple(html_text.blocks_of(html)[0]) for _, url, html in rows if url == f"http://h{h}.example/"}
        runs = [set(np.concatenate(html_text._hashes([list(p)], WordHashes())[0]).tolist()) for p in pages]
        assert runs == [chosen_by_hand(p) for p in pages]

        def most(groups):
            counts = Counter(run for group in groups for run in set().union(*group))
            return {run for run, n in counts.items() if n >= 3 and 2 * n > len(groups)}

        found = most([[r] for r in runs])
        copies = [r for r in runs if r and len(r & found) >= 0.8 * len(r)]
        want = most([[r] for r in runs if r not in copies] + [copies]) if copies else found
        assert got.get(f"h{h}.example", set()) == want and want


def test_extract_empty(spark):
    assert extract(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("name", ["op8_warc", "op7_chat_format"])
def test_against_sql(spark, name):
    sf = "/root/testdata/sf0.01"
    assert compare(spark, connect(sf), name, QUERIES[name], ORACLES[name], sf) is None


def test_archive_edges(spark, tmp_path):
    big = "é" * 60
    rows = [(4, "u", big), (2, None, big), (9, "x\r\ny", big), (2, "u", big), (None, "u", big), (5, "u", None), (6, "u", ""), (7, "u", "short"), (8, "u", "short"), (1, "u", "z" * 300_000)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'d' AS digest", "'p' AS payload").repartition(2)
    got = Counter((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in warc.archive_round_trip(df).collect())
    revisits = [(d, "revisit", 2, 120) for d in (4, 9, None)]
    responses = [(d, "response", None, n) for d, n in ((2, 120), (2, 120), (5, 0), (6, 0), (7, 5), (8, 5), (1, 300_000))]
    assert got == Counter(revisits + responses)
    digests = {r["page_id"]: r["payload_digest"] for r in warc.archive_round_trip(df).collect()}
    assert digests[9] == hashlib.sha256(big.encode()).hexdigest() and digests[5] == hashlib.sha256(b"").hexdigest()


def test_records_come_back_byte_for_byte(spark, tmp_path):
    df = spark.createDataFrame([(1, "http://a/", "x" * 200), (2, "http://b/", "x" * 200), (3, "http://c/", "y")], SCHEMA)
    path = str(tmp_path / "archive")
    warc.write_archive(df, path)
    records = {r["page_id"]: bytes(r["record"]) for r in warc.read_archive(spark, path).collect()}
    assert records[1].endswith(b"\r\n\r\n" + b"x" * 200 + b"\r\n\r\n") and b"WARC-Type: response" in records[1]
    assert records[2].endswith(b"Content-Length: 0\r\n\r\n\r\n\r\n") and b"WARC-Refers-To: <urn:page:1>" in records[2]
    assert spark.read.parquet(f"{path}/payloads").count() == 1
    assert warc.archive_round_trip(df.limit(0)).count() == 0
