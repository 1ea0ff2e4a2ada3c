import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from oracle import SF, same
from pyspark.sql import functions as F

import corpus_pipeline
from framelake.llm import bpe, fingerprint, htmltext, langid, mixing, neardup, queries, recompress, tokenfile, topk, toxicity

from .conftest import SCHEMA, corpus, prose

W = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    same(queries.queries()[name](spark, SF), queries.ORACLES[name])


# --- top-k


def test_topk_against_brute_force(spark):
    rng = np.random.default_rng(3)
    v = {i: rng.normal(size=6).round(2).tolist() for i in range(400)}
    v |= {7: v[8], 9: v[8], 500: [1e9] * 6, 550: [-1e9] * 6}
    rows = [(i, x) for i, x in v.items()] + [(600, None), (601, [1.0, None]), (650, [float("nan")]), (700, []), (None, [1.0] * 6), (750, [1.0, 2.0]), (0, v[0])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1)), 50, 5, per_shard=60, per_block=3).collect()
    whole = {i: [int(np.floor(256 * c)) for c in x] for i, x in v.items()}
    for q in [i for i in whole if i % 50 == 0]:
        want = sorted(((-sum(a * b for a, b in zip(whole[q], x)), i) for i, x in whole.items() if i != q))[:5]
        assert [(-r.score, r.vec_id) for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])] == want
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_topk_repeated_ids(spark):
    rows = [(1, [1.0, 0.0]), (1, [9.0, 0.0]), (1, [5.0, 0.0]), (2, [4.0, 0.0]), (3, [3.0, 0.0]), (50, [1.0, 0.0]), (50, [2.0, 0.0])]
    v = [(i, [int(256 * c) for c in x]) for i, x in rows]
    want = sorted(((sum(a * b for a, b in zip(x, y)), -j) for i, x in v if i == 50 for j, y in v if j != 50), reverse=True)[:5]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 50, 5, per_shard=2, per_block=1).collect()
    assert [(r.score, -r.vec_id) for r in sorted(got, key=lambda r: r["rank"])] == want


def test_topk_matches_sql_on_repeated_ids_and_small_negatives(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = [(i % 70, [float(x) for x in rng.normal(size=4).round(1)]) for i in range(120) if i % 70 != 50 or i < 70] + [(80, [-1e-20, -0.0, 1e-20, -2.0**-60]), (81, [-1e-20] * 4)]
    d = spark.createDataFrame([*rows, rows[3], (None, [1.0] * 4)], "vec_id long, embedding array<double>").where("vec_id is null or vec_id % 50 <> 0 or vec_id = 50").unionByName(spark.createDataFrame([(100, [-3e-20, 9.0, 1.0, -1.0])], "vec_id long, embedding array<double>"))
    import pyarrow.parquet as pq

    pq.write_table(d.toArrow(), f"{tmp_path}/embeddings.parquet")
    same(queries.op1_ball_tree_topk(spark, str(tmp_path)), queries.ORACLES["op1_ball_tree_topk"], str(tmp_path))
    assert topk.integers(d).where("exists(v, x -> x = -1)").count() >= 2


# --- near-duplicates


def sets(text):
    w = W.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text)) if text else []
    k = min(5, len(w))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()


def brute_components(rows, percent):
    ids = sorted({-(2**63) if r[0] is None else r[0] for r in rows})
    own = {i: [sets(r[1]) for r in rows if (-(2**63) if r[0] is None else r[0]) == i] for i in ids}
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and any(s and t and 100 * len(s & t) >= percent * len(s | t) for s in own[a] for t in own[b]):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {i: root(i) for i in ids}


def test_neardup_against_brute_force(docs, empty):
    got = neardup.clusters(docs).collect()
    want = brute_components(corpus(), 85)
    assert len(got) == len(corpus())
    for r in got:
        i = -(2**63) if r.doc_id is None else r.doc_id
        assert (-(2**63) if r.component_id is None else r.component_id) == want[i] and r.kept == (want[i] == i)
    n = Counter(len(sets(r[1])) for r in corpus())
    assert Counter(r.n_shingles for r in got) == n
    assert neardup.clusters(empty).count() == 0


@pytest.mark.parametrize("block", [512, 7, 2])
def test_neardup_cluster_without_a_hub(spark, block):
    """A chain of copies, each like its neighbours only, and a star whose hub has the largest id; buckets of one block and of many."""
    rows, words = [], prose(11, 300).split(" ")
    for i in range(25):
        rows.append((i, " ".join(words), None, None))
        words = [w if not (i * 9 <= k < i * 9 + 9) else f"n{i}.{k}" for k, w in enumerate(words)]
    hub = prose(12, 200).split(" ")
    for i in range(30):
        rows.append((100 + i, " ".join(w if k not in (i * 6, i * 6 + 3) else f"e{i}" for k, w in enumerate(hub)), None, None))
    rows.append((999, " ".join(hub), None, None))
    got = {r.doc_id: r.component_id for r in neardup.clusters(spark.createDataFrame(rows, SCHEMA), block=block).collect()}
    assert got == brute_components(rows, 85)


def test_one_bucket_is_many_tasks(spark):
    """A bucket of 5,000 members: every pair of members meets in one pair of blocks, and the pairs go to many tasks."""
    members = spark.range(5000).select(F.lit("0:x").alias("bucket"), F.col("id").alias("k"), F.col("id").alias("comp"), F.lit(5000).alias("m"))
    rows = neardup.pairs_of_blocks(members, 512).cache()
    groups = rows.groupBy("i", "j").agg(F.count("*").alias("n")).collect()
    assert len(groups) == 10 * 11 // 2 and max(r["n"] for r in groups) < 2 * 700 and rows.count() == 5000 * 10
    sets = spark.createDataFrame([(0, b"", b"")], "k long, sig binary, full binary")
    plan = neardup.rest_links(members, sets, 1, 85)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(bucket#\d+, i#\d+, j#\d+", plan)
    tasks = rows.repartition(8, "bucket", "i", "j").select(F.spark_partition_id().alias("at")).groupBy("at").count().collect()
    assert len(tasks) >= 6 and max(r["count"] for r in tasks) < 0.4 * 50000


def test_rest_links_across_blocks(spark):
    """Members of one bucket with components of their own, in blocks of all sizes: joined as brute force joins them."""
    base = prose(21, 120).split(" ")
    texts = {}
    for i in range(60):
        words = list(base)
        for k in range(i % 12):
            words[(i // 12 * 20 + k * 7) % 120] = f"n{i // 12}.{k}"
        texts[i] = " ".join(words)
    rows = [(i, t, None, None) for i, t in texts.items()]
    signed = {i: neardup.shingle_hashes(neardup.normal(t))[0] for i, t in texts.items()}
    sets_ = spark.createDataFrame([(i, neardup.signature(h).tobytes(), h.tobytes()) for i, h in signed.items()], "k long, sig binary, full binary")
    met = [i for i in texts if (neardup.signature(signed[i])[:4] == neardup.signature(signed[0])[:4]).all()]
    members = spark.createDataFrame([("0:x", i, i, len(met)) for i in met], "bucket string, k long, comp long, m long")
    assert len(met) > 8

    def parts(links):
        root = {i: i for i in met}
        for a, b in links:
            x, y = root[a], root[b]
            root = {i: min(x, y) if r in (x, y) else r for i, r in root.items()}
        return root

    alike = [(a, b) for a in met for b in met if a < b and 100 * len(sets(texts[a]) & sets(texts[b])) >= 85 * len(sets(texts[a]) | sets(texts[b]))]
    for block in (2, 5, 512):
        links = [(r["a"], r["b"]) for r in neardup.rest_links(members, sets_, 1, 85, block).collect()]
        assert set(links) <= set(alike) and parts(links) == parts(alike)


def several_texts():
    """Ids, and missing ids, with several unlike texts, whose near and exact copies have other ids."""
    rows = []
    for i in range(12):
        base = prose(100 + i, 80)
        near = base.split(" ")
        near[40] = f"other{i}"
        rows += [(i // 4 if i < 8 else None, base, "en", "s"), (50 + i, " ".join(near), "en", "s"), (70 + i, base, "en", "s")]
    return [*rows, (60, None, "en", "s"), (60, prose(100, 80), "en", "s"), (None, None, "en", "s"), (1, "", "en", "s"), rows[0]]


def test_neardup_ids_with_several_texts(spark):
    rows = several_texts()
    want = brute_components(rows, 85)
    got = neardup.clusters(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    for r in got:
        i = -(2**63) if r.doc_id is None else r.doc_id
        assert (-(2**63) if r.component_id is None else r.component_id) == want[i] and r.kept == (want[i] == i)


# --- HTML


def page(body, nav="<nav>menu</nav>"):
    return f"<html><head><title>t</title><style>p{{}}</style></head><body>{nav}<div class='ad-box'>buy</div>{body}<footer>foot</footer></body></html>"


@pytest.mark.parametrize(("html", "want"), [
    ("", ""),
    (page("<article><h1>A &amp; B</h1><p>one\n two<p>three<br>four</article>"), "A & B\n\none two\n\nthree four"),
    (page("<main><section><p>x</p><div id=comments><p>bad</p></div><ul><li>a<li>b</ul></section></main>"), "x\n\na\n\nb"),
    (page("<article><p>x<script>var t='</p>'</script> y</p><form><p>no</p></form><aside>no</aside></article><article><p>z</p></article>"), "x y\n\nz"),
    ("plain &lt;text&gt;", "plain <text>"),
    ("<body><nav>menu</nav><article><p>cut short <b", "cut short"),
])
def test_extract(html, want):
    assert htmltext.extract(html) == want


@pytest.mark.parametrize("name", ["id=discussion", "id=related-work", "id=head-injury", "class=share-price", "class=social-history", "class=side-effects", "class=tags"])
@pytest.mark.parametrize("tag", ["section", "div", "h2", "p", "span"])
def test_one_word_drops_no_article_text(name, tag):
    inner = "<p>kept</p>" if tag in ("section", "div") else "kept"
    assert htmltext.extract(page(f"<article><{tag} {name}>{inner}</{tag}></article>")) == "kept"
    assert htmltext.extract(page("<article><p>x</p><div class='share-tools'><a href=/>Share</a></div><div class=comment-list><p>bad</p></div></article>")) == "x"


ARTICLE_FORMS = [
    "<section id='recommendations'><h2>kept</h2><p>text</p></section>", "<h2 id='recommendations'>kept</h2><p>text</p>", "<h2 id='comments'>kept</h2><p>text</p>", "<h2 id='footer'>kept</h2><p>text</p>", "<p id='advertising'>kept</p><p>text</p>",
    "<p class='related'>kept</p><p>text</p>", "<section class='navigation'><h2>kept</h2><p>text</p></section>", "<section id='paywall'><h2>kept</h2><p>text</p></section>", "<section id='trending'><h2>kept</h2><p>text</p></section>", "<div role='note'>kept</div><p>text</p>",
    "<section id='ads'><h2>kept</h2><p>text</p></section>", "<div class='related-work'>kept</div><p>text</p>", "<ul class='related'><li>kept</li><li>text</li></ul>", "<section class='navigation'>kept</section><p>text</p>", "<blockquote class='newsletter'>kept</blockquote><p>text</p>",
    "<section class='related'><h2>kept</h2><p>text <a href=/></a></p></section>",
]


@pytest.mark.parametrize("form", ARTICLE_FORMS)
@pytest.mark.parametrize("frame", ["<article>{}</article>", "<main>{}</main>", "<article><div>{}</div></article>"])
def test_names_drop_no_text_of_the_article(form, frame):
    assert htmltext.extract(page(frame.format(form))) == "kept\n\ntext"


@pytest.mark.parametrize("form", [
    "<div class='related-posts'><h3>Related</h3><ul><li><a href=/1>one</a></li><li><a href=/2>two</a></li></ul></div>", "<div class='share-buttons'><span>Share:</span> <a href=/>there</a></div>", "<div class='pagination'><a href=/2>next page</a></div>",
    "<section id='comments'><h2>2 comments</h2><div><p>bad</p></div></section>", "<div class='ad'><p>buy this</p></div>", "<div class='ad-slot wide'>buy this</div>", "<div class='cookie-notice'><p>we use cookies</p></div>", "<ol class='comment-list'><li>bad</li></ol>",
    "<div class='newsletter-signup'><p>write to us</p></div>", "<div role='navigation'><p>go</p></div>", "<div class='toolbar'><a href=/>print this</a> or <a href=/>save it</a></div>", "<div id='sponsored'><a href=/>a thing to buy</a></div>",
])
def test_what_is_not_the_article_still_goes(form):
    assert htmltext.extract(page(f"<article><p>kept</p>{form}<p>text</p></article>")) == "kept\n\ntext"


def test_counts_alone_give_the_given_pages_texts(spark, monkeypatch):
    """With all lists of names and roles empty and no article element to go by, the counted templates leave of the given pages what the article is."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").toPandas()
    want = [htmltext.extract(h) for h in pages["html"]]
    for name in ("DROPPED_WORDS", "COMMENT_NAMES", "NOTICE_NAMES", "NOTICE_STARTS", "LINK_NAMES", "DROPPED_ROLES"):
        monkeypatch.setattr(htmltext, name, frozenset())
    assert [htmltext.extract(h) for h in pages["html"]] == want
    # a site's frame in divisions without names; what it holds is the same on its pages
    bars = [f"<div><div><a href=/{w}>{w}</a> <a href=/>home</a></div><div>call us on {w}</div></div>" for w in ("one", "two", "three")]
    framed = [re.sub('(?s)<div class="ad">(.*?)</div>', r"<aside>\1</aside>", h).replace("<article>", bars[i % 3] + "<div>").replace("</article>", "</div><div>all rights of the house</div>") for i, h in zip(pages["page_id"], pages["html"])]
    rows = [(int(i), f"https://h{i % 3}.org/{i}", h) for i, h in zip(pages["page_id"], framed)]
    plain = sum(htmltext.extract(h) == w for (_, _, h), w in zip(rows, want))
    marks = {r.host: frozenset(r.template) for r in htmltext.templates(spark.createDataFrame(rows, "pk long, url string, html string").withColumn("host", htmltext.host_of())).collect()}
    got = [htmltext.extract(h, marks[f"h{i % 3}.org"]) for i, _, h in rows]
    assert plain == 0 and len(marks) == 3 and got == want  # 250 of 250 by the counts, none without them


@pytest.mark.parametrize(("html", "want"), [
    ("<article><p>a <svg class='i'/> b</p><p>c</p></article>", "a b\n\nc"),
    ("<article><p>a <svg/> b</p><p>c <svg><g>no</g></svg> d</p></article>", "a b\n\nc d"),
    ("<article><p>a <object data=x /> b</p><p>c</p></article>", "a b\n\nc"),
    ("<article><p>a</p><div><svg><g></div><p>b</p><p>c <svg>no</svg> d</p></article>", "a\n\nb\n\nc d"),
    ("<article><p>a</p><div><iframe src=x></div><p>b</p></article>", "a\n\nb"),
    ("<article><p>a <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>no</annotation></math> b <math/> c</p></article>", "a x=1 b c"),
])
def test_unclosed_and_self_closed(html, want):
    assert htmltext.extract(html) == want


@pytest.mark.parametrize("small", [0, 4_000_000])
def test_site_template(spark, monkeypatch, small):
    monkeypatch.setattr(htmltext, "SMALL", small)
    bar = "<div><span>follow us everywhere</span></div>"
    rows = [(i, f"https://a.org/{i}", f"<body>{bar}<div><p>text {i}</p><p>shared by all</p></div></body>") for i in range(8)]
    rows += [(8, "https://b.org/1", f"<body>{bar}<p>alone</p></body>"), (9, None, None), (9, None, None)]
    got = {r.page_id: r.text for r in htmltext.extracted(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(1))).collect()}
    assert got[3] == "text 3\n\nshared by all" and got[8] == "follow us everywhere\n\nalone" and got[9] == ""


def test_copies_and_shared_blocks_stay(spark):
    table = "<table><tr><td>cell</td></tr></table>"
    rows, want = [], {}

    def add(host, html, text):
        want[len(rows)] = text
        rows.append((len(rows), f"https://{host}/{len(rows)}", html))

    for n in (5, 25, 1000):  # mirrors of one article: with paragraphs, and with bare text
        for i in range(n):
            add(f"p{n}.org", f"<body><!-- {i} --><article><div class='entry'><p>one</p><p>two</p></div></article></body>", "one\n\ntwo")
            add(f"b{n}.org", f"<body><div data-n={i}><div>bare text</div></div></body>", "bare text")
    for i in range(8):
        add("t.org", f"<article><p>text {i}</p>{table}<ul><li>item</ul><div><a href=/>link</a></div></article>", f"text {i}\n\ncell\n\nitem")
    got = {r.page_id: r.text for r in htmltext.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == want


@pytest.mark.parametrize("tag", ["div", "p", "li", "b", "article", "section class='ad'", "ul", "td"])
def test_deep_nesting(tag):
    name = tag.split()[0]
    assert htmltext.extract(f"<body><p>x</p>{f'<{tag}>' * 100000}</body>") in ("x", "")
    htmltext.seen_on(f"<article><p>x</p>{f'<{tag}>' * 20000}y{f'</{name}>' * 20000}</article>")
    assert htmltext.extract("<article><p>x</p>" + "</b></div>" * 100000 + "<p>y</p></article>") == "x\n\ny"


@pytest.mark.parametrize(("html", "want"), [
    ('<article><p>see <a href="x>link</a> here</p><p class="b">two</p></article>', "see link here\n\ntwo"),
    ("<article><p>see <a href='x>link</a> here</p><p>it's</p></article>", "see link here\n\nit's"),
    ('<article><p>a <a title="x > y" href=z>b</a> c</p></article>', "a b c"),
    ('<article><p>a <img alt="1 < 2" src="q"> b</p></article>', "a b"),
    ('<article><p>5 < 6 and "so" on</p></article>', '5 < 6 and "so" on'),
    ("<article><p " + 'a="b" ' * 5000 + ">x</p></article>", "x"),
    ("<article><p>x</p><p " + 'a="b" ' * 5000, "x"),
    ('<article><div class="entry-header"><h1>Title</h1></div><p class="side-by-side">one</p><div class="form-factor"><p>two</p></div></article>', "Title\n\none\n\ntwo"),
])
def test_quotes_and_names(html, want):
    assert htmltext.extract(html) == want


def brute_templates(pages, least_pages=5, least_share=0.2):
    """host -> hashes of its template, by plain loops over distinct pages."""
    by_host, texts = {}, {}
    for host, html in {(h, x) for h, x in pages if x}:
        main, found = htmltext.seen_on(html)
        texts.setdefault(host, set()).add(main)
        for h in found:
            by_host.setdefault(host, {}).setdefault(h, set()).add(main)
    return {host: {h for h, on in found.items() if len(on) >= least_pages and len(on) >= least_share * len(texts[host])} for host, found in by_host.items()}


def test_templates_against_brute_force(spark):
    """On the given pages: the same templates, and the same texts from them."""
    pages = spark.read.parquet(f"{SF.replace('sf0.001', 'sf0.01')}/pages.parquet")
    rows = pages.withColumn("host", htmltext.host_of()).collect()
    want = brute_templates([(r.host, r.html) for r in rows])
    got = {r.page_id: r.text for r in htmltext.extracted(pages).collect()}
    assert len(got) == len(rows)
    for r in rows:
        assert got[r.page_id] == htmltext.extract(r.html, frozenset(want[r.host]))
    # of each article, all text and nothing else: what is left of its markup by a plain pattern
    import html as entities

    for r in rows:
        body = re.sub(r"(?s)<!--.*?-->|<(script|style|aside|form|nav|footer|header)\b.*?</\1>", "", "".join(re.findall(r"(?s)<article\b[^>]*>(.*?)(?:</article>|$)", r.html)))
        words = entities.unescape(re.sub(r"<[a-zA-Z/][^>]*>", " ", body)).split()
        assert got[r.page_id].split() == words


def test_counts_decide_where_names_do_not(spark):
    """Sites without article elements whose boilerplate has no telling names: with the template step the text is the page's own, without it it is not."""
    rows, want = [], {}
    for i in range(12):
        own = "".join(f"<p>own {i} {k}</p>" for k in range(3))
        rows.append((i, f"https://x.org/{i}", f"<body><div class=q1><a href=/a>Start</a> <a href=/b>Shop</a></div><div><div class=z9><span>Call us now</span></div>{own}<div><i>Best of the web</i></div></div><div>Copyright</div></body>"))
        want[i] = "\n\n".join(f"own {i} {k}" for k in range(3))
    got = {r.page_id: r.text for r in htmltext.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == want
    assert all("Call us now" in htmltext.extract(h) and "Copyright" in htmltext.extract(h) for _, _, h in rows)


def test_extraction_of_no_pages_and_clashing_columns(spark):
    schema = "page_id int, url string, html string, pk int, host int, template int, text int, n_chars int"
    assert htmltext.extracted(spark.createDataFrame([], schema)).count() == 0
    long = "<article>" + "<p>word</p>" * 100000 + "</article>"
    got = htmltext.extracted(spark.createDataFrame([(1, "u", long, 1, 2, 3, 4, 5), (1, "u", long, 1, 2, 3, 4, 5)], schema)).collect()
    assert [r.n_chars for r in got] == [6 * 100000 - 2] * 2


# --- fingerprints


def test_fingerprints(docs, empty):
    got = fingerprint.fingerprints(docs).collect()
    rows = sorted({(-(2**63) if r[0] is None else r[0], r[1] or "") for r in corpus()})
    cut = lambda t: set(re.findall(r"[^\n]{1,256}", t))
    alike = lambda a, b: 1.0 if not a | b else len(a & b) / len(a | b)
    by = {}
    for i, (k, t) in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)][1]
        n = len(t) // 4
        e = t[: len(t) - n] + nxt[:n]
        by[k] = (len(t), hashlib.sha256(e.encode()).hexdigest(), alike(cut(t), cut(e)), alike(cut(t), cut(nxt)), t)
    prints = {}
    assert len(got) == len(corpus())
    for r in got:
        n, sha, ne, nn, t = by[-(2**63) if r.doc_id is None else r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, sha) and r.near_edited == pytest.approx(ne) and r.near_next == pytest.approx(nn)
        assert prints.setdefault(t, r.fingerprint) == r.fingerprint
    assert fingerprint.fingerprints(empty).count() == 0


def test_larger_sketches_until_peeling_succeeds(spark):
    rng = np.random.default_rng(2)
    rows = []
    for only_a, only_b, both in ((0, 0, 0), (0, 0, 50), (1, 0, 0), (3, 2, 30), (9, 9, 5), (40, 35, 100), (180, 190, 10), (600, 0, 20), (900, 800, 300), (0, 3000, 1)):
        x = rng.integers(-(2**63), 2**63, only_a + only_b + both, dtype=np.int64).tolist()
        rows.append((sorted(x[: only_a + both]), sorted(x[only_a:]), only_a, only_b, both))
    d = spark.createDataFrame(rows, "a array<long>, b array<long>, x long, y long, z long")
    got = d.select("*", fingerprint.difference(F.col("a"), F.col("b"), fingerprint.sketch(F.col("a"), 18), fingerprint.sketch(F.col("b"), 18)).alias("g")).collect()
    assert all((r.g.plus, r.g.minus) == (r.x, r.y) for r in got)
    sizes = {(r.x, r.y): r.g.m for r in got}
    assert sizes[1, 0] == 18 and sizes[180, 190] >= 370 and sizes[900, 800] >= 1700 and sizes[0, 3000] >= 3000


def test_cells_by_hand(spark):
    digests = [5, -7, 2**62, 11, 13]
    row = spark.range(1).select(fingerprint.sketch(F.array(*map(F.lit, digests)), 18).alias("s"), F.transform(F.array(*map(F.lit, digests)), lambda x: fingerprint._entries(x, F.lit(1), F.lit(18))).alias("e")).first()
    want = [[0, 0, 0] for _ in range(18)]
    for own in row.e:
        assert [x.c // 6 for x in own] == [0, 1, 2]
        for x in own:
            c = want[x.c]
            c[0], c[1], c[2] = c[0] + 1, c[1] ^ x.key, c[2] ^ x.check
    assert [[c.n, c.key, c.check] for c in row.s] == want


# --- BPE and token files


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.vocabulary())
    t.no_padding()
    t.no_truncation()
    return t


@pytest.mark.parametrize("leaf", [5, 7, 64, 500, 4096])
def test_tree_is_exact(library, leaf):
    enc = bpe.Encoder(queries.vocabulary(), leaf=leaf)
    texts = [r[1] for r in corpus() if r[1]] + ["thequick" * 990, "é漢字" * 800, "!?-" * 700 + "'s", " " * 9000 + "x", "it's" * 400 + " 's 'll " * 300, "12٣½" * 300, "don't we'll " * 500, "\n \n  x" * 300, "a" * 5000 + " " + "b" * 5000, "a\x1c b " * 99, "x <|endoftext|> " * 40, ""]
    assert enc.encode(texts) == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    assert enc.joins > 20 and enc.windows > enc.joins  # trees ran, and some windows had to grow


def test_tree_without_whole_arrays(library, monkeypatch):
    """Texts beyond LONGEST go by the pattern."""
    monkeypatch.setattr(bpe, "LONGEST", 100)
    enc = bpe.Encoder(queries.vocabulary(), leaf=64)
    texts = [r[1] for r in corpus() if r[1]]
    assert enc.encode(texts) == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)] and enc.joins


def test_two_units_of_one_hash(library, monkeypatch):
    monkeypatch.setattr(bpe, "hashes", lambda raw, starts, ends, seed: (ends - starts).astype(np.uint64))
    texts = ["the cat and a dog sat", "red fox ran off"]
    assert bpe.Encoder(queries.vocabulary()).encode(texts) == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]


def test_encoded(docs, empty, library):
    got = bpe.encoded(docs, queries.vocabulary(), with_ids=True).collect()
    want = Counter()
    for r in corpus():
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        want[(r[0], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want
    assert all(len(r.ids) == r.n_tokens for r in got) and bpe.encoded(empty, queries.vocabulary()).count() == 0


def test_token_files(spark, docs, empty, library):
    manifest = tokenfile.write(docs, queries.vocabulary(), 2, length=64)
    got = tokenfile.read(spark, manifest).orderBy("start").collect()
    rows = sorted(corpus(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    at = 0
    for r, g in zip(rows, got, strict=True):
        ids = [*library.encode(r[1] or "", add_special_tokens=False).ids, 2]
        assert (g.doc_id, g.start, g.n_tokens, g.ids_crc32) == (r[0], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    shard = tokenfile.TokenFile(manifest.orderBy("shard").first()["base"])
    seqs = [shard.sequence(i) for i in range(len(shard))]
    assert sum(int(m.sum()) for _, m in seqs) == manifest.orderBy("shard").first()["n_ids"] and all(len(s) == 64 for s, _ in seqs) and all(m.all() for _, m in seqs[:-1])
    assert tokenfile.read(spark, tokenfile.write(empty, queries.vocabulary(), 2)).count() == 0


def test_token_files_deal_one_id_out(spark, library):
    texts = [f"{i * 7919 % 1000:03d} {prose(i, 5)}" for i in range(1000)]
    rows = spark.createDataFrame([(None, t) for t in texts] + [(5, "last")], "doc_id long, text string").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # or shards as small as these are one
    try:
        manifest = tokenfile.write(rows, queries.vocabulary(), 2)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["n_ids"] for r in manifest.collect()]
    assert len(sizes) > 2 and max(sizes) < 0.6 * sum(sizes)
    got, at = tokenfile.read(spark, manifest).orderBy("start").collect(), 0
    for (i, t), g in zip([*((None, t) for t in sorted(texts)), (5, "last")], got, strict=True):
        ids = [*library.encode(t, add_special_tokens=False).ids, 2]
        assert (g.doc_id, g.start, g.n_tokens, g.ids_crc32) == (i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


# --- toxicity and language


def test_toxicity(spark, empty):
    rows = [(i, prose(i, 60) + (" you zorblat" + "abcdefgh"[i % 8] + " fool" if i % 6 == 0 else ""), int(i % 6 == 0)) for i in range(600)]
    d = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(9000, None), (9001, "")], "doc_id long, text string")
    lab = spark.createDataFrame([(i, y) for i, _, y in rows if i % 4] + [(None, 1), (5, None)], "doc_id long, toxic int")
    m = toxicity.fit(d, lab, F.lit(True))
    got = {r.doc_id: r for r in toxicity.scored(d, m).collect()}
    assert all(got[i].predicted == y for i, _, y in rows) and got[9000].predicted == got[9001].predicted == 0 and all(0 <= r.score <= 1 for r in got.values())
    none = toxicity.fit(d, lab.where("false"), F.lit(True))
    s = {r.doc_id: r.predicted for r in toxicity.scored(spark.createDataFrame([(1, "you stupid idiot, pathetic moron"), (2, "a fine day")], "doc_id long, text string"), none).collect()}
    assert s == {1: 1, 2: 0} and toxicity.scored(empty, none).count() == 0


def test_toxicity_patterns(spark):
    assert toxicity.odd("you are such an id1ot", {"you"}) >= {("masked", "idiot"), ("addressed", "id")}
    assert ("masked", "idiot") in toxicity.odd("I.d.i.o.t", set()) and ("stretched", "idiot") in toxicity.odd("idiooot", {"idiooot"})
    assert ("addressed", "idiot") in toxicity.odd("You are an idiot", set()) and ("shouted", "idiot") in toxicity.odd("an IDIOT", set())
    none = toxicity.fit(spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "doc_id long, toxic int"), F.lit(True))
    clean = none.score("a fine day, room 4b, mid-week, www.example.org, cooool")
    assert all(none.score(t) > 0.3 > clean for t in ("so id1ot", "an i.d.i.o.t here", "stupiiiid thing", "you are a moron"))


def test_toxicity_keeps_clashing_columns_and_long_texts(spark):
    m = toxicity.fit(spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "doc_id long, toxic int"), F.lit(True))
    d = spark.createDataFrame([(1, "idiot " * 200000, 5, 6), (1, "idiot " * 200000, 5, 6), (None, None, None, 7)], "doc_id long, text string, score int, hits int")
    got = toxicity.scored(d, m, keep=("doc_id", "score", "hits")).collect()
    assert [(r.doc_id, r.hits, r.predicted) for r in got] == [(1, 6, 1), (1, 6, 1), (None, 7, 0)]


def held_out(spark, name, truth):
    """Rows of a query over the given table beside the truth, held-out ones with a truth only."""
    sf = SF.replace("sf0.001", "sf0.1")  # the smaller tables have too few labels
    t = spark.read.parquet(f"{sf}/{truth[0]}.parquet").where(f"{truth[1]} is not null").select("doc_id", F.col(truth[1]).alias("truth"))
    return queries.queries()[name](spark, sf).where("held_out").join(t, "doc_id").collect()


def test_toxicity_on_held_out_labels(spark):
    rows = held_out(spark, "op7_toxicity", ("labels", "toxic"))
    toxic, clean = [r for r in rows if r.truth == 1], [r for r in rows if r.truth == 0]
    assert len(toxic) >= 100 and sum(r.predicted for r in toxic) >= 0.8 * len(toxic) and sum(r.predicted for r in clean) <= 0.005 * len(clean)


def test_language_on_held_out_documents(spark):
    rows = [r for r in held_out(spark, "op10_language_id", ("documents", "lang")) if r.lang_pred != "und"]
    assert len(rows) >= 3000 and sum(r.lang_pred == r.truth for r in rows) >= 0.98 * len(rows)


def test_language(spark, empty):
    a, b = "the of and with there where house when".split(), "der und nicht mit haus wenn eine sich".split()
    import random

    r = random.Random(1)
    rows = [(i, " ".join(r.choice(a if i % 2 else b) for _ in range(30)), "en" if i % 2 else "de") for i in range(200)]
    d = spark.createDataFrame([*rows, (900, None, "en"), (901, "12 34", None), (None, "the house", "en")], "doc_id long, text string, lang string")
    dicts = langid.dictionaries(d, F.col("doc_id") < 100)
    got = {x.doc_id: x for x in langid.predict(d, dicts).collect()}
    assert all(got[i].lang_pred == y for i, _, y in rows) and got[900].lang_pred == got[901].lang_pred == "und"
    assert langid.predict(empty, dicts).count() == 0
    clash = d.withColumns({"score": F.lit(1), "rejected": F.lit(2)}).unionByName(d.limit(1).withColumns({"text": F.lit("the house and there " * 100000), "score": F.lit(1), "rejected": F.lit(2)}))
    assert langid.predict(clash, dicts).where("doc_id = 1 or length(lang_pred) > 9").count() == 1 and langid.predict(clash, dicts).count() == 204
    assert langid.dictionaries(empty, F.lit(True)) == {} and [x.lang_pred for x in langid.predict(d, {}).collect()] == ["und"] * 203


# --- substring dedup


def brute_removed(rows, n=20):
    first, texts = {}, {}
    for r in rows:
        k = -(2**63) if r[0] is None else r[0]
        w = W.findall(r[1] or "")
        texts[k] = w
        for i in range(len(w) - n + 1):
            s = tuple(w[i : i + n])
            first[s] = min(first.get(s, (k, i)), (k, i))
    out = {}
    for k, w in texts.items():
        gone = set()
        for i in range(len(w) - n + 1):
            if first[tuple(w[i : i + n])] != (k, i):
                gone.update(range(i, i + n))
        out[k] = (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    return out


@pytest.mark.parametrize("group_bytes", [2_000, 6_000_000])
def test_recompression_against_brute_force(docs, empty, group_bytes):
    want = brute_removed(corpus())
    clashing = docs.withColumns({c: F.lit(2) for c in ("k", "n_words", "r", "n", "keys", "kind", "bits")})
    got = recompress.deduped(clashing, group_bytes)
    assert set(got.columns) == set(clashing.columns) | {"n_words", "n_removed", "kept"}
    for r in got.collect():
        assert (r.n_words, r.n_removed, r.kept) == want[-(2**63) if r.doc_id is None else r.doc_id] and (r.k, r.g) == (2, 1)
    assert recompress.deduped(empty).count() == 0
    assert recompress.deduped(docs.select("doc_id", "text"), group_bytes).columns == ["doc_id", "text", "n_words", "n_removed", "kept"]


def test_recompression_on_few_words(spark):
    import random

    r = random.Random(5)
    rows = [(i, " ".join(r.choice("ab" if i % 2 else "abc") for _ in range(r.randint(0, 120))), None, None) for i in range(60)]
    got = recompress.deduped(spark.createDataFrame(rows, SCHEMA)).collect()
    want = brute_removed(rows)
    assert all((x.n_words, x.n_removed, x.kept) == want[x.doc_id] for x in got) and len(got) == 60


def morse(n, a, b):
    """The Thue-Morse word over a and b: with its swap, the pair that polynomials modulo a power of two take for equal."""
    return "".join((a, b)[bin(i).count("1") % 2] for i in range(n))


def test_thue_morse_words_are_told_apart(spark, library):
    rows = []
    for n in (256, 512, 1024, 4096):
        for k, x in enumerate((morse(n, "a", "b"), morse(n, "b", "a"))):
            rows.append((n * 10 + k, " ".join([f"w{n}.{i}" for i in range(10)] + [x] + [f"v{n}.{i}" for i in range(9)]), None, None))
    d = spark.createDataFrame(rows, SCHEMA)
    assert all(r.n_removed == 0 for r in recompress.deduped(d).collect())
    assert all(r.n_shingles == len(sets(dict((i, t) for i, t, *_ in rows)[r.doc_id])) for r in neardup.clusters(d).collect())
    enc = bpe.Encoder(queries.vocabulary())
    texts = [t for _, t, *_ in rows] + [t.split(" ")[10] for _, t, *_ in rows]
    assert enc.encode(texts) == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    assert recompress.deduped(spark.createDataFrame([(1, morse(2048, "a ", "b "), None, None), (2, morse(2048, "b ", "a "), None, None)], SCHEMA)).count() == 2


def test_few_windows_stay_open(spark):
    """The rounds close the windows that occur once."""
    import pyarrow as pa

    texts = [prose(i, 400) for i in range(40)] + [prose(50, 100)] * 2
    steps, t = recompress.Steps(1), pa.table({"text": pa.array(texts), "__g": pa.array([0] * 42, pa.int32()), "__own": pa.array(range(42))})
    n, answers = [], None
    for turn in range(recompress.ROUNDS):
        share = steps.share(turn, steps.name(turn, t, answers))
        answers = share if answers is None else pa.concat_tables([answers, share])
        n.append(len(recompress.Answers(answers, 1).state(recompress.Words(t.column("text")), turn + 1)))
    total = len(recompress.Words(t.column("text")).windows())
    assert total > 15000 and 162 <= n[1] <= n[0] < total / 4


@pytest.fixture
def reordered(monkeypatch):
    """Hands the rows of a group to each step in another order, as shuffles that are read again from several machines do."""

    class Steps(recompress.Steps):
        def name(self, turn, t, answers=None):
            return super().name(turn, other_order(t, turn), answers)

        def compare(self, t, bits):
            return super().compare(other_order(t, 8), bits)

        def remove(self, t, bits, names):
            return super().remove(other_order(t, 9), bits, names)

    def other_order(t, seed):
        return t.take(np.random.default_rng(seed).permutation(t.num_rows))

    monkeypatch.setattr(recompress, "Steps", Steps)


def passages():
    """Prose, two thirds of it with passages of 60 words that come again, a repeated row, an exact copy and a null id."""
    rows = [(i, prose(i, 150) + (" " + prose(1000 + i % 7, 60) if i % 3 else "") + "\n" + prose(2000 + i, 50), "en", "s") for i in range(300)]
    return [*rows, rows[5], (700, rows[8][1], "en", "s"), (None, prose(9, 150), "en", "s")]


def test_recompression_whatever_the_order_of_rows(spark, reordered):
    rows = passages()
    want = brute_removed(rows)
    got = recompress.deduped(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.n_removed, r.kept) == want[-(2**63) if r.doc_id is None else r.doc_id]


def test_pipeline_removes_passages_whatever_the_order_of_rows(spark, reordered):
    docs = spark.createDataFrame(passages(), SCHEMA).withColumn("n_chars", F.length("text").cast("long"))
    want = brute_removed(passages())
    got = corpus_pipeline.drop_repeated_passages(spark, docs, "").collect()
    assert len(got) == docs.count()
    for r in got:
        _, n, kept = want[-(2**63) if r.doc_id is None else r.doc_id]
        assert (" ".join(W.findall(r.text)), r.n_chars) == (kept, len(r.text)) and (n == 0 or r.text == kept)


# --- mixing


def test_targets(spark):
    s = spark.createDataFrame([("a", 100), ("b", 1000), ("c", 4000), (None, 50)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(s).collect()}
    assert got["a"] == 200 and got[None] == 100 and sum(got.values()) == pytest.approx(1.5 * 5150) and got["b"] == 2000


def test_mixing(spark, docs, empty):
    rows = [(i, prose(i, i % 90), None, f"s{min(i % 9, 3)}") for i in range(900)]
    d = spark.createDataFrame(rows, SCHEMA)
    got = mixing.taken(d, block=16, slots=64).collect()
    assert len(got) == 900 and all(r.size == len(W.findall(rows[r.doc_id][1])) and 0 <= r.taken <= 2 * r.size for r in got)
    for s in {r.source for r in got}:
        own = [r for r in got if r.source == s]
        assert sum(r.taken for r in own) == pytest.approx(own[0].target, rel=0.02)
    again = mixing.taken(d.repartition(7), block=16, slots=64).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    mixed = mixing.mixed(d, block=16, slots=64).collect()
    n = Counter()
    for r in mixed:
        n[r.doc_id] += len(W.findall(r.text))
    assert all(n[r.doc_id] == r.taken for r in got)
    assert len(mixing.taken(docs).collect()) == len(corpus()) and mixing.taken(empty).count() == 0 and mixing.mixed(empty).count() == 0
    assert mixing.mixed(docs).columns == docs.columns
    words = Counter()  # repeated rows and ids
    for r in mixing.mixed(docs).collect():
        words[r.doc_id, r.source] += len(W.findall(r.text))
    took = Counter()
    for r in mixing.taken(docs).collect():
        took[r.doc_id, r.source] += r.taken
    assert +words == +took


def test_small_sources_meet_their_targets(spark):
    sizes = {f"{n}-{i}": n for n in (10, 30, 65, 200) for i in range(60)} | {"hot": 40000}
    got = mixing.taken(spark.createDataFrame([(i, prose(i, n), None, s) for i, (s, n) in enumerate(sizes.items())], SCHEMA)).collect()
    for n in (10, 30, 65, 200, 40000):
        own = [r for r in got if r.size == n]
        assert sum(r.taken for r in own) == pytest.approx(sum(r.target for r in own), rel=0.05)


def test_each_small_source_meets_its_target(spark):
    sizes = {"a": 10, "b": 30, "c": 1, "d": 333, "e": 70, "f": 3000, "g": 7}
    d = spark.createDataFrame([(i, prose(i, n), None, s) for i, (s, n) in enumerate(sizes.items())], SCHEMA)
    for r in mixing.taken(d).collect():
        assert abs(r.taken - r.target) <= max(1, r.size / 64) and r.taken <= 2 * r.size


def reference_places(n, keys, rounds):
    """Swap-or-not by hand: the hashes come from the caller."""
    places = list(range(n))
    for own, heads in rounds:
        places = [(own - x) % n if heads[max(x, (own - x) % n)] else x for x in places]
    return places


def test_permutations(spark):
    for n in (1, 2, 97, 1000, 2**33 + 5):
        k = min(n, 1000)
        rows = spark.range(k).select(mixing.permuted(F.col("id"), F.lit(n), F.lit(3), F.lit(1), 17).alias("b")).distinct()
        assert rows.count() == k and rows.where(f"b < 0 or b >= {n}").count() == 0
    n = 97
    key = F.xxhash64(F.lit(3), F.lit(17))
    rounds = []
    for r in range(mixing.ROUNDS):
        row = spark.range(n).select("id", F.pmod(F.xxhash64(key, F.lit(r)), F.lit(n)).alias("own"), F.xxhash64("id", F.lit(r), key).bitwiseAND(F.lit(1)).alias("heads")).orderBy("id").collect()
        rounds.append((row[0].own, [x.heads for x in row]))
    got = [x.b for x in spark.range(n).select("id", mixing.permuted(F.col("id"), F.lit(n), 3, 17).alias("b")).orderBy("id").collect()]
    assert got == reference_places(n, None, rounds)
    a, b = (spark.range(1000).select("id", mixing.permuted(F.col("id"), F.lit(1000), k).alias("b")).orderBy("id").toPandas()["b"].to_numpy() for k in (1, 2))
    assert abs(np.corrcoef(a, np.arange(1000))[0, 1]) < 0.15 and abs(np.corrcoef(a, b)[0, 1]) < 0.15 and (a == b).sum() < 10


def test_mix_against_brute_force(spark):
    """From the blocks that the plan uses, in plain loops: each document's words, each source's blocks and each shard's counts."""
    rows = [(i if i % 11 else None, prose(i, 5 + i * 7 % 190), None, f"s{min(i % 7, 3)}") for i in range(500)] + [(7, prose(7, 54), None, "s0")] * 3
    d = spark.createDataFrame(rows, SCHEMA)
    placed, sources, use = mixing.mix(d, block=16, slots=64)
    use, placed, sources = use.collect(), placed.collect(), {r["rank"]: r for r in sources.collect()}
    times = Counter((u["rank"], u.b) for u in use)
    want = Counter()
    for rank, src in sources.items():
        own = sorted((p for p in placed if p["rank"] == rank and p.size), key=lambda p: p.lo)
        assert [p.lo for p in own] == list(np.cumsum([0] + [p.size for p in own])[:-1]) and sum(p.size for p in own) == src.source_size
        n = -(-src.source_size // 16)
        slots = [u for u in use if u["rank"] == rank]
        assert len(slots) == round(src.target * n / src.source_size) and {u.b for u in slots} <= set(range(n))
        assert all(sum(u.b == b for u in slots if u.turn == t) <= 1 for t in (0, 1) for b in range(n))
        for p in own:
            want[p.k, p.tie, p.lo] = sum(times[rank, w // 16] for w in range(p.lo, p.lo + p.size))
    key = lambda r: (-(2**63) if r.doc_id is None else r.doc_id, r.size, r.taken)
    size = {(p.k, p.tie, p.lo): p.size for p in placed}
    assert sorted(map(key, mixing.taken(d, block=16, slots=64).collect())) == sorted((k[0], size[k], n) for k, n in want.items())
    shards = Counter(u.shard for u in use)
    assert set(shards) == set(range(-(-len(use) // 64))) and all(n == 64 for s, n in shards.items() if s != max(shards))
    by_shard = Counter((u.shard, u["rank"]) for u in use)
    assert {(r.shard, r["rank"]): r.n for r in mixing.counts(spark.createDataFrame(use)).collect()} == by_shard
    for rank in sources:  # a multinomial's spread, as far as the totals leave it
        p = sum(u["rank"] == rank for u in use) / len(use)
        got = [by_shard[s, rank] for s in shards if s != max(shards)]
        assert abs(np.mean(got) - 64 * p) < 4 * (64 * p * (1 - p) / len(got)) ** 0.5 + 0.5 and np.var(got) < 4 * 64 * p * (1 - p) + 1


# --- pipeline


def test_one_row_of_each_group_stays(spark, docs):
    want = brute_components(corpus(), 80)
    got = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert got.columns == docs.columns
    assert sorted(-(2**63) if r.doc_id is None else r.doc_id for r in got.collect()) == sorted(set(want.values()))


def test_unlike_texts_of_one_id_stay(spark):
    rows = several_texts()
    got = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), SF).collect()
    # the smallest id's text of each of the twelve groups, and the texts without words
    want = [(r[0], r[1]) for r in rows[:36:3]] + [(60, None), (None, None), (1, "")]
    assert Counter((r.doc_id, r.text) for r in got) == Counter(want)


def test_pipeline(spark):
    out = corpus_pipeline.run(spark, SF)
    assert set(out.columns) == {"doc_id", "source", "lang", "n_tokens", "ids_sha256", "decoded_sha256", "ids"} and out.count() > 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "substring_dedup", "mix", "bpe"]


def test_pipeline_on_odd_rows(spark, docs, empty):
    """Nulls, repeated rows and ids, empty and long texts, clashing columns, through the whole chain; and no rows at all."""
    first = docs.withColumns({c: F.lit(3) for c in ("k", "n", "text_", "component", "predicted", "n_removed", "cuts", "turn", "n_tokens")})
    for rows in (first, empty):
        got = rows
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, got, SF)
            assert out.columns == got.columns, name
            got = out
        last = corpus_pipeline.STAGES[-1][1](spark, got, SF)
        assert last.count() == got.count() and {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} <= set(last.columns)
    assert all(r.k == 3 and r.n_removed == 3 and r.kept == 1 for r in corpus_pipeline.STAGES[2][1](spark, first, SF).collect())


def test_no_machine_local_folder_on_a_cluster():
    from types import SimpleNamespace

    from framelake.llm.common import shared_dir

    session = SimpleNamespace(conf={}, sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077"))
    with pytest.raises(ValueError):
        shared_dir(session)


def test_memory_is_handed_back():
    """In a process of its own: what is free between blocks in use goes back to the system."""
    import subprocess
    import sys

    code = """
import re
from framelake.llm.common import hand_back
def mb(): return int(re.search(r"VmRSS:\\s+(\\d+)", open("/proc/self/status").read())[1]) / 1024
blocks = [bytes(9000) for _ in range(20000)]
del blocks[:-1]
before = mb()
hand_back()
assert before - mb() > 100, (before, mb())
"""
    subprocess.run([sys.executable, "-c", code], check=True)
