"""Packing, mixing, vectors, pages, classifiers and the pipeline: round trips, brute force, held-out accuracy."""

import random
from itertools import product

import numpy as np
import pytest
from brute import cosine_links, water_fill
from pyspark.sql import functions as F

import corpus_pipeline
from tidemart.llm import embedding_dedup, mixing, quality_classifier, toxicity
from tidemart.llm.embedding_dedup import embedding_components
from tidemart.llm.html_extract import Flow, extract, extract_main_text
from tidemart.llm.packing import pack_mixture
from tidemart.llm.queries import QUERIES
from tidemart.llm.tokens import encoder

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def published():
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_encoder_equals_the_published_pipeline(published):
    texts = ["Hello, wörld! It's ÀÉÎ ß ÿ", "tabs\tand\nlines\x0b\x0c\r x", "Σίσυφος ΟΔΟΣ 東京 naïve é a b c", "1234 a1b2 ...%%% $x", "",
             "<|endoftext|> x<|startoftext|>y", "don't we'll they're I'd", "\x1c\x1d mixed\x85"]
    got = [np.frombuffer(x, dtype="<u2").tolist() for x in encoder()([t.encode() for t in texts])]
    assert got == [published.encode(t, add_special_tokens=False).ids for t in texts]


def check_pieces(pieces, ids, width):
    """Every id once, sequences gapless, at most ``width``, padded only below a power of two."""
    by_doc, by_seq = {}, {}
    for r in pieces:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(ids)
    for d, ps in by_doc.items():
        at = 0
        for p in sorted(ps, key=lambda r: r["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids[d])
            part = np.array(ids[d][at:at + p["length"]], dtype="<u4").tobytes()
            assert bytes(p["ids"]) == part
            at += p["length"]
        assert at == len(ids[d])
    for ps in by_seq.values():
        at = 0
        for p in sorted(ps, key=lambda r: r["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= width and (at == width or at & (at - 1) == 0)


def test_packing_round_trip_and_proportions(spark, published):
    df = spark.read.parquet(f"{SF}/documents.parquet").repartition(3)
    docs = df.toPandas()
    ids = {d: published.encode(t or "", add_special_tokens=False).ids + [2] for d, t in zip(docs.doc_id, docs.text)}
    pieces = pack_mixture(df).collect()
    check_pieces(pieces, ids, 4096)
    source = dict(zip(docs.doc_id, docs.source))
    total = {}
    for d, x in ids.items():
        total[source[d]] = total.get(source[d], 0) + len(x)
    everything = sum(total.values())
    full = {r["sequence_id"] for r in pieces if (r["sequence_id"] + 1) * 4096 <= everything}
    for s in list(full)[1:20]:
        inside = {}
        for r in pieces:
            if r["sequence_id"] == s:
                inside[source[r["doc_id"]]] = inside.get(source[r["doc_id"]], 0) + r["length"]
        for name, n in total.items():  # a window may cut two rounds, each exact to a token
            assert abs(inside.get(name, 0) - 4096 * n / everything) <= 0.06 * 4096


@pytest.mark.parametrize("targets", [None, {"a": 3, "b": 1, None: 2}])
@pytest.mark.parametrize("queues", [256, 2])
def test_packing_odd_rows(spark, published, targets, queues):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["alpha", "Beta,", "γ", "x1"]) for _ in range(rng.randint(0, 60))), "en",
             rng.choice(["a", "a", "b", None, "é"]), 1) for i in range(60)]
    rows += [(100, None, None, "a", None), (101, "", "en", None, 0), (102, "z " * 900, "en", "a", 1)]
    df = spark.createDataFrame(rows, DOCS).repartition(4)
    ids = {r[0]: published.encode(r[1] or "", add_special_tokens=False).ids + [2] for r in rows}
    check_pieces(pack_mixture(df, width=64, targets=targets, max_queues=queues).collect(), ids, 64)
    assert pack_mixture(df.limit(0)).count() == 0


def test_packing_repeated_rows_and_null_ids(spark):
    df = spark.createDataFrame([(None, "a b c", "en", "s", 1)] * 3 + [(7, "a b c", "en", "s", 1)] * 2, DOCS)
    pieces = pack_mixture(df).collect()
    assert sum(r["length"] for r in pieces) == 5 * 4


def test_mixing_targets_and_repeats(spark):
    rng = random.Random(1)
    rows = [(i if i % 5 else None, " ".join(["w"] * rng.randint(0, 6)) + rng.choice(["", "  x\n"]), "en",
             rng.choice(["a", "b", "é", None, "Z"]), 1) for i in range(300)]
    rows += [(1, None, "en", "q", 0)] + [(7, "same text here", "en", "big", 1)] * 3000
    df = spark.createDataFrame(rows, DOCS)
    out = mixing.mix_sources(df, carry=["source"]).collect()
    sizes, taken = {}, {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len((r[1] or "").split())
    want = water_fill(sizes)
    assert len(out) == len(rows)
    for r in out:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] <= 3 * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    again = mixing.mix_sources(df.repartition(5), carry=["source"]).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    assert mixing.mix_sources(df.limit(0)).count() == 0


def test_nearest_subset_equals_enumeration():
    rng = random.Random(5)
    for _ in range(200):
        size = np.array([rng.randint(1, 12) for _ in range(rng.randint(0, 5))], dtype=np.int64)
        n = np.array([rng.randint(0, 4) for _ in size], dtype=np.int64)
        budget = rng.randint(0, 60)
        sums = {0}
        for s, c in zip(size.tolist(), n.tolist()):
            sums = {v + k * s for v in sums for k in range(c + 1)}
        pick = mixing.nearest_subset(size, n, budget)
        assert (pick <= n).all() and abs((pick * size).sum() - budget) == min(abs(v - budget) for v in sums)


@pytest.mark.parametrize("cell,block", [(2048, 32768), (16, 64), (50, 1000)])
def test_embeddings_equal_brute_force(spark, cell, block):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 6))
    rows = []
    for i in range(250):
        v = centres[rng.integers(12)] * rng.choice([1, 3, 1e-30])
        rows.append((i if i % 9 else None, [float(x) for x in v * (1 + rng.normal(size=6) * rng.choice([0, .1, .3]))]))
    rows += [(500, None), (501, []), (502, [0.0] * 6), (503, [float("nan")] + [1.0] * 5), (504, [None] + [1.0] * 5),
             (505, [float("inf")] + [1.0] * 5), (506, [1.0, 2.0]), (507, [1.0, 2.0]), (508, [2.0, 4.1])]
    rows += [(600 + i, [1.0, .5, .25, 0.0, 0.0, 1.0]) for i in range(40)] + [(600, [1.0, .5, .25, 0.0, 0.0, 1.0])] * 3
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, u long, n int")
    want = [(i, *x) for (i, _), x in zip(rows, cosine_links([r[0] for r in rows], [r[1] for r in rows], 0.9))]
    out = embedding_components(df.repartition(4), cell_rows=cell, visitor_rows=block).collect()
    assert sorted(str(tuple(r)[:3]) for r in out) == sorted(map(str, want))
    assert all(r["kept"] == (r["vec_id"] == r["component"]) for r in out)


def test_embedding_query_on_whole_table(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    want = dict(zip(e.vec_id, cosine_links(list(e.vec_id), list(e.embedding), 0.9)))
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in QUERIES["op10_embedding_dedup"](spark, SF).collect()}
    assert got == want


def test_embeddings_empty_table(spark):
    assert embedding_components(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_pairs_of_vectors_are_not_moved(spark, monkeypatch):
    # chunks meet where they lie: copies of vectors for every pair of chunks passed an exchange before
    plans, write = [], embedding_dedup.write_and_read
    def noted(df, label, *options):
        plans.append((label, df._jdf.queryExecution().executedPlan().toString()))
        return write(df, label, *options)
    monkeypatch.setattr(embedding_dedup, "write_and_read", noted)
    rng = np.random.default_rng(3)
    vectors = [*rng.normal(size=(300, 16)), *(np.ones(16) + rng.normal(size=(300, 16)) * .1)]  # apart, and all linked
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    out = embedding_components(df, cell_rows=8, visitor_rows=16).collect()
    want = [(i, *x) for (i, _), x in zip(rows, cosine_links([r[0] for r in rows], [r[1] for r in rows], 0.9))]
    assert sorted(tuple(r)[:3] for r in out) == want and sum(w[2] == 300 for w in want) == 300
    join = dict(plans)["vector-links"]
    assert "Exchange" not in join and "CartesianProduct" in join


def test_signs_of_zero_and_lengths_of_vectors(spark):
    rows = [(1, [0.0, 1.0]), (2, [-0.0, 1.0]), (3, [0.0, 1.0, 0.0]), (4, [-0.0, 2.0]), (5, None), (6, [-0.0, 0.0])]
    out = embedding_components(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), cell_rows=1).collect()
    assert sorted(tuple(r)[:3] for r in out) == [(1, 2, 1), (2, 2, 1), (3, 0, 3), (4, 2, 1), (5, 0, 5), (6, 0, 6)]


PAGES = [
    ("<p>a<b>b</b>c &lt;d&gt; &#233;&eacute;<script>if(a<b)x('</p>')</script> e", "abc <d> éé e"),
    ("<body><header><h1>Site</h1></header><nav><a href=x>Home</a></nav><div class=content><h1>Title here</h1><p>One two "
     "three four five six.</p><div class='ad'>Buy now</div><p>Ok.</p><form><label>Mail</label><input></form></div><aside>"
     "<p>Side words go on and on</p></aside><section id=comments><article><p>Nice post thanks</p></article></section>"
     "<footer>&copy; me</footer>", "Title here One two three four five six. Ok."),
    ("<div class=menu><ul><li><a href=1>A</a><li><a href=2>B</a></ul></div><div><p>Long paragraph text with words.</p><p>"
     "Tiny.</p></div><div class='cookie-notice'>We use cookies</div>", "Long paragraph text with words. Tiny."),
    ("<main><article><h1>T</h1><p>P one.</p><div class=newsletter><p>Sign up</p></div><p>P two.</p></article></main>"
     "<div>unmarked text elsewhere on the page</div>", "T P one. P two."),
    ("<article><p>x<p>y<div>z</article>after", "x y z"),
    ("plain text only & stuff", "plain text only & stuff"), ("", ""), (None, ""), ("<p", ""), ("<!-- open", ""),
    ("<article><p hidden>no</p><p>A &amp; B&nbsp;C</p></article>", "A & B C"),
]


def test_pages(spark):
    df = spark.createDataFrame([(i if i else None, None, h, "x") for i, (h, _) in enumerate(PAGES)],
                               "page_id long, url string, html string, text string")
    got = sorted((r["text"] for r in extract_main_text(df).collect()))
    assert got == sorted(w for _, w in PAGES)
    assert extract_main_text(df.limit(0)).count() == 0


def test_page_articles_of_the_table(spark):
    import html
    import re
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in QUERIES["op1_html_extract"](spark, SF).collect():
        body = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        want = " ".join(html.unescape(re.sub(r"<(?!/?b>)[^>]*>", " ", body).replace("<b>", "").replace("</b>", "")).split())
        assert r["text"] == want and r["n_chars"] == len(want)


def test_a_very_long_page_is_linear():
    text, blocks, main = extract("<article>" + "<p>some words here</p>" * 5000 + "</article><div>out</div>")
    assert blocks == 5001 and main == 5000 and text.count("some") == 5000


def test_flow_is_a_minimum_cut():
    rng = random.Random(2)
    for _ in range(100):
        n = rng.randint(1, 7)
        odds = [rng.uniform(-3, 3) for _ in range(n)]
        edges = [(a, b, rng.uniform(0, 2)) for a in range(n) for b in range(a + 1, n) if rng.random() < .5]
        flow = Flow(n + 2)
        for i, o in enumerate(odds):
            if o > 0:
                flow.edge(n, i, o, 0.0)
            else:
                flow.edge(i, n + 1, -o, 0.0)
        for a, b, w in edges:
            flow.edge(a, b, w, w)

        def cost(side):
            return (sum(abs(o) for o, s in zip(odds, side) if (o > 0) != bool(s))
                    + sum(w for a, b, w in edges if side[a] != side[b]))

        assert cost(flow.source_side(n, n + 1)[:n]) == pytest.approx(min(cost(s) for s in product([0, 1], repeat=n)))


def held_out(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    part = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    return docs, labels.where(~part), labels.where(part)


def test_quality_classifier_on_held_out_labels(spark):
    docs, train, test = held_out(spark, "/root/testdata/sf0.01")
    out = quality_classifier.score_quality(docs, train).join(test, "doc_id")
    assert out.where("kept = (quality = 1)").count() >= 0.95 * out.count()
    good = out.where("quality = 1")
    assert good.where("kept").count() >= 0.98 * good.count()


def test_quality_classifier_odd_rows(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "a b " * 30, None, "s", 9)]
    df = spark.createDataFrame(rows, DOCS)
    none = spark.createDataFrame([(1, None, 0)], "doc_id long, quality int, toxic int")
    out = quality_classifier.score_quality(df, none).collect()
    assert len(out) == 4 and all(r["kept"] and r["score"] == 0.5 for r in out)
    one = spark.createDataFrame([(1, 0, 0), (2, 1, 0), (2, 1, 1), (None, 0, 1)], "doc_id long, quality int, toxic int")
    assert quality_classifier.score_quality(df, one).count() == 4
    assert quality_classifier.keep_good(df, one).columns == df.columns
    assert quality_classifier.score_quality(df.limit(0), one).count() == 0


def test_toxicity_on_held_out_labels(spark):
    docs, train, test = held_out(spark, "/root/testdata/sf0.1")
    out = toxicity.score_toxicity(docs, train).withColumnRenamed("toxic", "flag").join(test, "doc_id").cache()
    bad, clean = out.where("toxic = 1"), out.where("toxic = 0")
    assert bad.where("flag").count() >= 0.85 * bad.count()
    assert clean.where("flag").count() <= 0.02 * clean.count()
    assert bad.agg(F.avg("expected_severity")).first()[0] > 1 > clean.agg(F.avg("expected_severity")).first()[0]


def test_toxicity_terms_and_odd_rows(spark):
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(40, 3)), rng.integers(0, 4, 40).astype(np.int32)
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array(list(x)), pa.array(y)], names=["x", "grade"])
    p, w, h = np.array([-1., .3, 1.2, .1, -.2, .3]), {True: 2., False: 1.}, 1e-5
    at = toxicity.terms(batch, p, 3, w)
    for i in range(6):
        up, down = p.copy(), p.copy()
        up[i], down[i] = up[i] + h, down[i] - h
        a, b = toxicity.terms(batch, up, 3, w), toxicity.terms(batch, down, 3, w)
        assert (a[0] - b[0]) / (2 * h) == pytest.approx(at[1 + i], abs=1e-4)
        assert (a[1:7] - b[1:7]) / (2 * h) == pytest.approx(at[7:].reshape(6, 6)[i], abs=1e-3)
    df = spark.createDataFrame([(None, None, None, None, 0), (1, "", "en", "s", 0), (1, "", "en", "s", 0)], DOCS)
    labels = spark.createDataFrame([(1, 1, None), (1, 1, 0)], "doc_id long, quality int, toxic int")
    out = toxicity.score_toxicity(df, labels).collect()
    assert len(out) == 3 and all(r["p_toxic"] == 0 and not r["toxic"] for r in out)
    words = "red blue green small large old new tall short warm cold dry".split()
    pick = random.Random(3)
    graded = spark.createDataFrame([(i, " ".join(f"{pick.choice(words)} vile" for _ in range(i % 4)) + " plain words here " +
                                     " ".join(pick.sample(words, 5)), "en", "s", 1) for i in range(200)], DOCS)
    grades = graded.select("doc_id", (F.col("doc_id") % 4).cast("int").alias("toxic"))
    means = dict(toxicity.score_toxicity(graded, grades).groupBy((F.col("doc_id") % 4).alias("g")).agg(
        F.avg("expected_severity")).collect())
    assert means[0] < means[1] < means[2] < means[3]
    assert toxicity.score_toxicity(df.limit(0), labels).count() == 0


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    schema, n = docs.schema, docs.count()
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "simhash_near_dedup", "suffix_array_dedup", "source_mixing", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.write_and_read(stage(spark, docs, SF), name)
        assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in schema]
        if name != "source_mixing":
            assert out.count() <= docs.count()
        docs = out
    pieces = corpus_pipeline.run(spark, SF).collect()
    tokens = sum(r["length"] for r in pieces)
    by_doc = {}
    for r in pieces:
        by_doc.setdefault(r["doc_id"], []).append(r)
    assert tokens > 0 and 0 < len(by_doc) <= n
    again = corpus_pipeline.run(spark, SF).collect()
    assert sorted(map(tuple, pieces)) == sorted(map(tuple, again))


def test_pipeline_on_odd_rows(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0),
            (2, "some words " * 60, "en", None, 9), (3, "some words " * 60, "en", "t", 9)]
    docs = spark.createDataFrame(rows, DOCS)
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.write_and_read(stage(spark, docs, SF), name)
        assert out.count() >= 0
        empty = stage(spark, docs.limit(0), SF)
        assert empty.count() == 0
        docs = out


LONG = "<p>This paragraph has well over twenty five words so that its length alone says that it belongs to the text of an article and not to a menu or an advert.</p>"


@pytest.mark.parametrize("page", [
    '<article class="post type-post hentry tag-python"><div class="entry-content">%s</div></article>',
    '<article class="post has-sidebar">%s</article>', '<article class="review">%s</article>',
    '<main><article class="review"><p>Short.</p>%s</article></main>',
    '<div class="content no-comments">%s</div>', '<div class="post tag-python">%s</div>',
    '<article><h1>T</h1><section id="discussion">%s</section></article>', '<section id="discussion">%s</section>',
    '<form id="aspnetForm"><div>%s</div></form>'])
def test_pages_whose_class_words_mislead(page):
    body = LONG * 8
    text = extract(page % body)[0]
    assert text.count("This paragraph") == 8 and ("Short" in page) == ("Short" in text)
    few = f"<article>{body}<div class=comments><p>Nice post, thanks</p></div><div class=ad><p>Buy this now</p></div></article>"
    assert "Nice" not in extract(few)[0] and "Buy" not in extract(few)[0]
    blog = f"<div class=content>{body}</div><div id=comments>{LONG.replace('This paragraph', 'A comment') * 20}</div>"
    assert "A comment" not in extract(blog)[0] and extract(blog)[0].count("This paragraph") == 8


COMMENTS = '<section id="comments"><ol>%s</ol></section>' % "".join(
    f"<li>{LONG.replace('This paragraph', f'Reader {i}')}</li>" for i in range(12))
SIDE = LONG.replace("This paragraph", "Elsewhere it")


@pytest.mark.parametrize("page", [
    "<body>%s" + COMMENTS + "</body>", "<main><article>%s</article>" + COMMENTS + "</main>",
    "<article>%s" + COMMENTS + "</article>", "<div class=content>%s</div><div id=disqus_thread>" + SIDE * 9 + "</div>",
    "<article>%s<section id=comments>" + SIDE * 4 + "</section></article>",
    "<main>%s<div class=sidebar>" + SIDE * 10 + "</div></main>", "<body>%s<div class=sidebar>" + SIDE * 10 + "</div></body>",
    "<main>%s<div class=related-posts>" + SIDE * 8 + "</div></main>",
    "<body><div class=cookie-notice>" + SIDE * 4 + "</div>%s</body>", "<article>%s<form>" + SIDE * 5 + "</form></article>",
    "<body><div class=newsletter><div class=content>" + SIDE * 6 + "</div></div>%s</body>"])
def test_regions_beside_an_article_stay_out_however_long(page):
    text = extract(page % (LONG * 4))[0]
    assert text.count("This paragraph") == 4 and "Reader" not in text and "Elsewhere" not in text


def test_deep_unclosed_elements_are_linear():
    import time
    times = []
    for n in (2000, 16000):
        page = "<div>some words of a text that goes on " * n
        start = time.process_time()
        assert extract(page)[1] == n
        times.append(time.process_time() - start)
    assert times[1] < 30 * max(times[0], 0.02)


@pytest.mark.parametrize("value", ["<p>x</p>" * 20, "<i title='a'>" + "y" * 5000 + "</i>", "a => b > c", "class=sidebar"])
def test_markup_inside_attributes_is_no_text(value):
    page = f"<article><div data-props=\"{value}\" class=post><p>Words of the page.</p></div></article>"
    assert extract(page) == ("Words of the page.", 1, 1)
    assert extract("<p title=\"open>Words of the page.")[0] == "Words of the page."
    assert extract("<article><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> <object>be so</object></p></article>")[0] == (
        "Let x=1 be so")


def test_many_attributes_are_read_once():
    page = "<article>" + "<p data-x='<b>\">' title=\"it's >\">some words</p>" * 20000 + "</article>"
    assert extract(page)[1] == 20000


@pytest.mark.parametrize("targets", [None, {"s1": 3, "s2": 0.5, None: 2}])
def test_packing_keeps_proportions_with_many_sources(spark, targets):
    rng = random.Random(3)
    rows = [(i, " ".join(["alpha"] * rng.randint(0, 90)), "en", rng.choice([None, *(f"s{k}" for k in range(12))]), 1)
            for i in range(150)]
    df = spark.createDataFrame(rows, DOCS).repartition(3).localCheckpoint()
    few = pack_mixture(df, width=64, targets=targets).collect()
    many = pack_mixture(df, width=64, targets=targets, max_queues=2).collect()
    assert sorted(map(str, many)) == sorted(map(str, few))
    if targets:  # s1 gets six times the tokens of s2 while both last
        source, inside = {r[0]: r[3] for r in rows}, {"s1": 0, "s2": 0}
        for r in many:
            if r["sequence_id"] < 8 and source[r["doc_id"]] in inside:
                inside[source[r["doc_id"]]] += r["length"]
        assert abs(inside["s1"] - 6 * inside["s2"]) <= 6


def test_pipeline_equals_brute_force_stage_by_stage(spark, published):
    import zlib
    from collections import Counter

    from brute import fingerprint, fingerprint_components, kept_texts

    def rows(df):
        return sorted((tuple(r) for r in df.collect()), key=str)

    table = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    long = sorted((r for r in table.join(labels.where("quality = 1"), "doc_id").collect()), key=lambda r: -len(r["text"]))
    added = [(10**6 + i, r["text"], r["lang"], r["source"], r["n_chars"]) for i, r in enumerate(long[:5])]  # copies
    added += [(2 * 10**6 + i, r["text"][:3000] + " " + long[9]["text"][:700], r["lang"], r["source"], 3701)
              for i, r in enumerate(long[5:8])]  # passages shared with others
    docs = table.unionByName(spark.createDataFrame(added, table.schema))
    docs = corpus_pipeline.write_and_read(docs, "brute")
    stages = dict(corpus_pipeline.STAGES)

    def run(name, df):
        return corpus_pipeline.write_and_read(stages[name](spark, df, SF), f"brute-{name}")

    kept = run("quality_classifier", docs)
    scored = quality_classifier.score_quality(docs, labels).where("kept").select("doc_id")
    assert rows(kept) == rows(docs.join(scored, "doc_id", "left_semi").select(*docs.columns))
    good = docs.join(labels.where("quality = 1"), "doc_id", "left_semi")
    assert kept.join(good, "doc_id", "left_semi").count() >= 0.95 * good.count()

    before, one = rows(kept), run("simhash_near_dedup", kept)
    ids = [r[0] for r in before]
    names = fingerprint_components(ids, [fingerprint(r[1]) for r in before], 4)
    assert rows(one) == [r for r, name in zip(before, names) if r[0] == name] and len(set(names)) < len(ids)

    before, cut = rows(one), run("suffix_array_dedup", one)
    texts = kept_texts([r[1].encode() for r in before], corpus_pipeline.PASSAGE_BYTES)
    assert rows(cut) == sorted(((r[0], t, *r[2:4], len(t)) for r, t in zip(before, texts)), key=str)
    assert any(t != r[1] for r, t in zip(before, texts))

    before, mixed = rows(cut), rows(run("source_mixing", cut))
    sizes, taken, copies = Counter(), Counter(), Counter(mixed)
    for r in before:
        sizes[r[3]] += len(r[1].split())
    for r in mixed:
        taken[r[3]] += len(r[1].split())
    assert set(copies) <= set(before) and max(copies.values()) <= 3
    assert all(abs(taken[s] - x) <= 1 for s, x in water_fill(sizes).items())

    numbered = spark.createDataFrame([(i, *r[1:]) for i, r in enumerate(mixed)], table.schema)  # copies apart
    encoded = {i: published.encode(r[1], add_special_tokens=False).ids + [2] for i, r in enumerate(mixed)}
    pieces = run("packing", numbered).collect()
    check_pieces(pack_mixture(numbered).collect(), encoded, 4096)
    seen = Counter()
    for p in pieces:
        part = np.array(encoded[p["doc_id"]][p["start"]:p["start"] + p["length"]], dtype="<u4").tobytes()
        assert zlib.crc32(part) == p["ids_crc32"]
        seen[p["doc_id"]] += p["length"]
    assert seen == {i: len(x) for i, x in encoded.items()}


def test_rare_words_do_not_drive_out_frequent_ones(monkeypatch):
    from tokenizers import Tokenizer

    from tidemart.llm import tokens
    import public_tokenizers
    monkeypatch.setattr(tokens, "TABLE_SIZE", 40)
    tokens.encoder.cache_clear()
    seen, real = [], Tokenizer.from_file(public_tokenizers.path(tokens.DEFAULT_FILE))

    class Told:
        model = real.model
        get_vocab_size = real.get_vocab_size

        def encode(self, text, **how):
            seen.append(text)
            return real.encode(text, **how)

    monkeypatch.setattr(Tokenizer, "from_file", lambda path: Told())
    try:
        texts = [f"x1 {i}-{i} y2 {i}+{i}" for i in range(200)]
        got = tokens.encoder(None)([t.encode() for t in texts])
    finally:
        tokens.encoder.cache_clear()
    assert seen.count("x1") == seen.count("y2") == 1  # met again in every text
    want = [b"".join(i.to_bytes(2, "little") for i in real.encode(t, add_special_tokens=False).ids) for t in texts]
    assert got == want
