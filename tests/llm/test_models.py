"""Language identification, page texts and exact top-k."""

import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from termloom.llm import langid, page_text
from termloom.llm.page_text import extract_pages, main_text, smoothed
from termloom.llm.top_products import top_products


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = langid.predict(docs, langid.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    right = np.mean([r.lang_pred == r.lang for r in held])
    assert right > 0.97 and abs(np.mean([r.score for r in held]) - right) < 0.03


def test_predictions_come_from_the_text_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs)
    other = docs.withColumn("doc_id", F.col("doc_id") + 7).withColumn("lang", F.lit(None).cast("string"))
    a = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(docs, model).collect()}
    b = {r.doc_id - 7: (r.lang_pred, r.score) for r in langid.predict(other, model).collect()}
    assert a == b
    # held-out rows teach nothing
    changed = docs.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), "zz").otherwise(F.col("lang")))
    assert np.array_equal(langid.fit(changed).weights, model.weights)
    assert (model.weights == 0).mean() > 0.5


def test_languages_of_odd_rows(odd, none):
    model = langid.fit(odd)
    assert model is None or model.languages == ["xx"]
    rows = langid.predict(odd, model).collect()
    assert len(rows) == odd.count()
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in rows if r.doc_id in (1, 2, 3))
    assert all(r.lang_pred == "xx" for r in rows if r.doc_id in (4, 5))
    kept = langid.drop_unidentified(odd, model)
    assert kept.columns == odd.columns and kept.filter("doc_id in (1, 2, 3)").count() == 0
    assert langid.fit(none) is None
    assert {r.lang_pred for r in langid.predict(odd, None).collect()} == {"und"}
    assert langid.predict(none, None).collect() == [] and langid.drop_unidentified(none, None).collect() == []


def test_fit_is_bounded_whatever_the_ids(spark):
    texts = [(None, "xx", f"some words {i:03d}") for i in range(300)] + [(None, "yy", "other text")] * 300
    df = spark.createDataFrame(texts, "doc_id long, lang string, text string").repartition(4)
    seen = []
    fit_weights = langid._fit_weights
    try:
        langid._fit_weights = lambda train, n, how: seen.append(len(train)) or fit_weights(train, n, how)
        model = langid.fit(df, sample_per_language=40)
    finally:
        langid._fit_weights = fit_weights
    assert model.languages == ["xx", "yy"]
    # one part of the rows is for calibration
    assert seen[0] <= 41


def test_threshold_follows_the_number_of_languages(spark):
    df = spark.createDataFrame([(1, "abc abc"), (2, "q")], "doc_id long, text string")
    weights = np.zeros((langid.FEATURES, 2))
    unsure = langid.Model(["xx", "yy"], weights, np.array([0.1, 0.0]), 1.0)
    sure = langid.Model(["xx", "yy"], weights, np.array([1.0, 0.0]), 1.0)
    assert langid.drop_unidentified(df, unsure).count() == 0
    assert langid.drop_unidentified(df, sure).count() == 2


def test_slices_have_the_grams_of_whole_texts(monkeypatch):
    grams = langid.Grams()
    for text in ("Ab 1c, é中\U00020000 xy " * 9, "a", "", "no end", "  two  gaps ", "x1"):
        whole = sorted(np.concatenate([np.zeros(0, np.uint32), *grams.of(text)]).tolist())
        for size in (1, 2, 3, 7):
            monkeypatch.setattr(langid, "CHUNK", size)
            assert sorted(np.concatenate([np.zeros(0, np.uint32), *grams.of(text)]).tolist()) == whole
        monkeypatch.undo()


def test_steps_of_the_leader_against_a_plain_version():
    """Every coordinate by itself, from the published update; in the order that the fit takes."""
    rng = np.random.default_rng(4)
    how = langid.Ftrl(passes=2)
    rows = [(rng.choice(50, 6, replace=False), rng.uniform(0.1, 3, 6), int(rng.integers(0, 3))) for _ in range(25)]
    z, n = {}, {}

    def weight(i, k):
        lead = z.get((i, k), 0.0)
        if abs(lead) <= how.l1:
            return 0.0
        return -(lead - math.copysign(how.l1, lead)) / ((how.beta + math.sqrt(n[i, k])) / how.alpha + how.l2)

    order = np.random.default_rng(11)
    for _ in range(how.passes):
        for r in order.permutation(len(rows)):
            at, x, y = rows[r]
            pairs = [*zip(at.tolist(), x.tolist()), (langid.FEATURES, 1.0)]
            score = [sum(v * weight(i, k) for i, v in pairs) for k in range(3)]
            total = sum(math.exp(s) for s in score)
            step = {(i, k): v * (math.exp(score[k]) / total - (k == y)) for i, v in pairs for k in range(3)}
            for (i, k), g in step.items():
                w, old = weight(i, k), n.get((i, k), 0.0)
                n[i, k] = old + g * g
                z[i, k] = z.get((i, k), 0.0) + g - (math.sqrt(n[i, k]) - math.sqrt(old)) / how.alpha * w
    weights, bias = langid._fit_weights(rows, 3, how)
    for i in range(50):
        np.testing.assert_allclose(weights[i], [weight(i, k) for k in range(3)], atol=1e-12)
    np.testing.assert_allclose(bias, [weight(langid.FEATURES, k) for k in range(3)], atol=1e-12)
    assert np.count_nonzero(weights) == sum(weight(i, k) != 0 for i in range(50) for k in range(3))


def test_idf_and_temperature_against_plain_versions(spark):
    rows = [(i, "xx" if i % 2 else "yy", t) for i, t in enumerate(["ab ab", "ab cd", "cd", "ef ab", "ab", "zz cd ef", "ab ef"] * 3)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    learned = [(lang, t) for i, lang, t in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    grams = langid.Grams()
    found = df.filter(~langid.held_out(F.col("doc_id"))).select("text").mapInArrow(langid._document_frequencies, "feature long, df long")
    got = {r.feature: r.df for r in found.groupBy("feature").agg(F.sum("df").alias("df")).collect()}
    want = {}
    for _, t in learned:
        for f in {int(f) for part in grams.of(t) for f in part}:
            want[f] = want.get(f, 0) + 1
    assert got.pop(langid.FEATURES) == len(learned) and got == want
    # the temperature has the least loss of all on a fine grid
    rng = np.random.default_rng(1)
    scores, right = rng.normal(0, 3, (200, 3)), rng.integers(0, 3, 200)
    scores[np.arange(200), right] += 2.0

    def loss(t):
        x = scores / t
        x = x - x.max(1, keepdims=True)
        return -(x[np.arange(200), right] - np.log(np.exp(x).sum(1))).mean()

    t = langid._fit_temperature(scores, right)
    assert loss(t) <= min(loss(x) for x in np.geomspace(0.05, 20, 400)) + 1e-4


def test_long_texts_have_the_same_grams():
    grams = langid.Grams()
    whole = np.concatenate(list(grams.of("Ab 1c, é中\U00020000 " * 10)))
    assert len(whole) and whole.max() < langid.FEATURES
    assert sum(map(len, grams.of("ab " * langid.CHUNK))) > 3 * langid.CHUNK
    assert not list(grams.of("1 2 ... \U0001f600")) or not sum(map(len, grams.of("1 2 ...")))


ARTICLE = "<h1>Title</h1><p>First paragraph of the article, with   some words &amp; a bit more.</p><p>Short.</p><p>Last <b>paragraph</b> of\nthis article, also with quite some words in it.</p>"
TEXT = "Title\nFirst paragraph of the article, with some words & a bit more.\nShort.\nLast paragraph of this article, also with quite some words in it."


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var x='</p>';</script></head><body>{body}</body></html>"


def test_page_texts():
    around = "<nav><ul><li><a href=x>Menu</a></li></ul></nav><div class='cookie-notice'>We use cookies.</div><div class=ad>Buy this now, it is very good!</div>"
    after = "<section id=comments><article><p>A long comment of some reader, many words.</p></article></section><aside>More</aside><footer>&copy; me</footer>"
    form = "<form><label>Mail</label><input name=a><button>Go</button></form>"
    assert main_text(page(around + f"<article>{ARTICLE}{form}</article>" + after)) == TEXT
    assert main_text(page(around + f"<main>{ARTICLE}</main>" + after)) == TEXT
    assert main_text(page(around + f"<div class=content>{ARTICLE}</div>" + after)) == TEXT
    # left open or cut off
    assert main_text(page("<div class=ad>Buy!<article>" + ARTICLE)) == TEXT
    assert main_text(page(around + "<article>" + ARTICLE) + "<p") == TEXT
    assert main_text("<article><p>one two three<p>four five six</article><!-- cut") == "one two three\nfour five six"
    assert main_text(None) == main_text("") == main_text("<html><nav>a</nav>") == ""
    assert main_text("plain &eacute;&#8217;&#x41; text") == "plain é’A text"


def test_names_of_topics_are_content():
    ids = ["legal-history", "search-algorithms", "comments-in-code", "Social_structure", "legal", "Comments"]
    for i in ids:
        assert main_text(page(f"<article><section id='{i}'>{ARTICLE}</section></article>")) == TEXT
        assert main_text(page(f"<main><div class=section id='{i}'>{ARTICLE}</div></main>")) == TEXT
        assert main_text(page("<article>" + ARTICLE.replace("<h1>", f"<h1 id='{i}'>") + "</article>")) == TEXT
        assert main_text(page("<article>" + ARTICLE.replace("Title", f"<span id='{i}'>Title</span>") + "</article>")) == TEXT
        assert main_text(page("<article>" + ARTICLE.replace("<h1>", "<h1 class='search-heading'>") + "</article>")) == TEXT
    for i in ids[:4]:
        assert main_text(page(f"<article id='{i}'>{ARTICLE}</article>")) == TEXT
        assert main_text(page(f"<section id='{i}'>{ARTICLE}</section>")) == TEXT
    other = "<p>Something that is not of the article, but of some length and many words.</p></"
    for start, end in [("div class=ad", "div"), ("div class='x social-share'", "div"), ("div id=comments", "div"), ("ul class=related", "ul")]:
        assert main_text(page(f"<article>{ARTICLE}<{start}>{other}{end}></article>")) == TEXT
    assert main_text(page(f"<main><article>{ARTICLE}</article><section id=comments>{other}section></main>")) == TEXT


STORY = "".join(f"<p>Paragraph {i} of a story that has some length, and words enough to be read.</p>" for i in range(6))
STORY_TEXT = "\n".join(f"Paragraph {i} of a story that has some length, and words enough to be read." for i in range(6))


def test_names_around_everything_drop_nothing():
    for start in ("div class='post comments-open'", "div class='layout has-sidebar'", "div id='legal'", "div class='widget'"):
        assert main_text(page(f"<{start}>{STORY}</div>")) == STORY_TEXT
        assert main_text(page(f"<{start}>{STORY}</div><div class=ad>Buy this, it is very good!</div>")) == STORY_TEXT
    # short articles with many comments keep none of them
    comments = f"<div id=comments>{STORY.replace('story', 'comment')}</div>"
    assert main_text(page(f"<div>{STORY}</div>{comments * 3}")) == STORY_TEXT


def test_articles_count_alone_only_with_most_of_the_text():
    cards = "".join(f"<article><h3>Teaser {i}</h3><p>Another story, in short.</p></article>" for i in range(3))
    got = main_text(page(f"<div id=content>{STORY}</div><section>{cards}</section>"))
    assert got.startswith(STORY_TEXT)
    assert main_text(page(f"<div>{ARTICLE}</div><article>{STORY}</article>")) == STORY_TEXT


def test_dropped_parts_within_a_line_do_not_end_it():
    line = "<p>Use the <button>Go <b>on</b></button> key <span class=share>Share <i>it</i></span>or not<script>x='<p>'</script>, as you like.</p>"
    want = "Use the key or not, as you like."
    assert main_text(page(f"<article>{line}{STORY}</article>")) == f"{want}\n{STORY_TEXT}"
    assert main_text(page(f"<div>{line}{STORY}</div>")) == f"{want}\n{STORY_TEXT}"


def plain_selection(html):
    """Ratios, kernel, threshold and regions number by number, over the lines of the parser."""
    if not html:
        return ""
    parser = page_text._Lines()
    parser.feed(page_text._OPEN_TAG_AT_END.sub("", html))
    parser.close()
    lines = [line for line in parser.lines if line.tags or line.parts]
    total = sum(len(line.text) for line in lines if not line.dropped)
    texts = []
    articles = any(line.article and not line.dropped and not line.named and line.text for line in lines)
    for line in lines:
        gone = line.dropped or articles and bool(line.named)
        for k in line.named:
            held = sum(len(x.text) for x in lines if not x.dropped and k in x.named)
            share = {"name": 2 / 3, "comment": 9 / 10}[parser.named[k]]
            gone = gone or held <= share * total
        signs = len(line.text.replace(" ", ""))
        menu = not line.article and (0 if gone else line.linked) * 10 >= 9 * (0 if gone else signs)
        texts.append("" if gone or menu else line.text)
    weights = [math.exp(-d * d / 2) for d in (-2, -1, 0, 1, 2)]

    def chosen():
        ratios = [len(t) / max(1, line.tags) for line, t in zip(lines, texts)]
        smooth = []
        for i in range(len(ratios)):
            near = [ratios[min(max(i + d, 0), len(ratios) - 1)] for d in (-2, -1, 0, 1, 2)]
            smooth.append(sum(w * r for w, r in zip(weights, near)) / sum(weights))
        mean = sum(smooth) / len(smooth)
        threshold = math.sqrt(sum((x - mean) ** 2 for x in smooth) / len(smooth))
        return [x > threshold and r > 0 for x, r in zip(smooth, ratios)]

    if not lines:
        return ""
    picked = chosen()
    size = sum(len(t) for t, c in zip(texts, picked) if c)
    if size and 2 * sum(len(t) for t, c, line in zip(texts, picked, lines) if c and line.article) >= size:
        texts = [t if line.article else "" for t, line in zip(texts, lines)]
        picked = chosen()
    regions = {line.region for line, c in zip(lines, picked) if c}
    return "\n".join(t for t, line in zip(texts, lines) if t and line.region in regions)


def test_every_page_as_by_the_plain_version(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in extract_pages(pages).collect()}
    assert got == {r.page_id: plain_selection(r.html) for r in pages.collect()}
    clashing = pages.withColumns({"n_chars": F.lit("odd"), "region": F.lit("odd"), "text": F.lit("odd"), "id": F.lit("odd")})
    assert {r.page_id: r.text for r in extract_pages(clashing).collect()} == got
    long = "<div>" + STORY * 2_000 + "</div>"
    assert len(main_text(long)) > 400_000


def test_pages_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = {r.page_id: r for r in extract_pages(pages).collect()}
    for p in pages.collect():
        assert rows[p.page_id].url == p.url and rows[p.page_id].n_chars == len(rows[p.page_id].text)
        assert "<" not in rows[p.page_id].text or "&lt;" in p.html
    odd = spark.createDataFrame(
        [(1, "u", None, "x"), (1, None, "", "x"), (None, "u", "<p>a b</p>", "x"), (2, "u", "<p>" + "word " * 100_000, "x")],
        "page_id long, url string, html string, text string",
    )
    got = sorted((r.page_id or 0, r.n_chars) for r in extract_pages(odd).collect())
    assert got == [(0, 3), (1, 0), (1, 0), (2, 499_999)]
    assert extract_pages(odd.filter("false")).collect() == []


def test_smoothing_keeps_constants():
    assert np.allclose(smoothed(np.full(7, 3.0)), 3.0) and len(smoothed(np.ones(1))) == 1


def brute(vectors, asked, k):
    out = {}
    for q, v in vectors.items():
        if asked(q):
            scores = sorted(
                (-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in vectors.items() if i != q
            )
            out[q] = [(i, -s) for s, i in scores[:k]]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_top_products(spark):
    rng = np.random.default_rng(2)
    kinds = {
        "like": rng.normal(0, 1, (600, 8)),
        "lengths": rng.normal(0, 1, (600, 8)) * rng.lognormal(0, 1.5, (600, 1)),
        "ties": rng.integers(-1, 2, (600, 3)) / 64,
        "close": np.ones((600, 4)) + rng.normal(0, 0.05, (600, 4)),
    }
    for rows in kinds.values():
        rows = rows.astype(np.float32)
        df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], "vec_id long, embedding array<float>")
        whole = {i: np.floor(r.astype(float) * 64).astype(int).tolist() for i, r in enumerate(rows)}
        got = found(top_products(df, F.col("id") % 20 == 0, k=5, chunk=40, block=7, tile=2))
        assert got == brute(whole, lambda q: q % 20 == 0, 5)


def test_top_products_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5]), (1, [1.0, 0.5]), (1, [1.0, 0.5]), (2, None), (3, [None, 1.0]), (4, [nan, 1.0]), (5, [inf, 1.0]),
        (6, []), (7, [2.0]), (None, [9.0, 9.0]), (20, [0.0, 0.0]), (40, [1e30, -1e30]),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, score string")
    got = found(top_products(df, F.col("id") % 20 == 0, k=20))
    assert got[0] == [(40, 2**63 - 1), (7, 128 * 64), (1, 64 * 64 + 32 * 32), (6, 0), (20, 0)]
    assert {i for i, _ in got[0]} == {1, 6, 7, 20, 40} and {i for i, _ in got[20]} == {0, 1, 6, 7, 40}
    assert found(top_products(df.filter("false"), F.col("id") % 20 == 0)) == {}
    assert found(top_products(df.filter("vec_id = 0"), F.col("id") % 20 == 0)) == {}
