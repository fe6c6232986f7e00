"""Main text of pages, language-model scores, and the pipeline."""

import html
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from odd_rows import ODD

from tradeflow.llm import dom_gbt, nce_lm

PAGES = "/root/testdata/sf0.01/pages.parquet"


def article_of(page):
    """The text of the test pages' one article, by their template."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    blocks = re.split(r"</?(?:p|h1)>", inner)
    done = (re.sub(r"[\x20\x09-\x0D]+", " ", html.unescape(re.sub(r"</?b>", "", b).replace("<br>", " "))).strip(" ") for b in blocks)
    return "\n\n".join(b for b in done if b)


@pytest.fixture(scope="module")
def trees(spark):
    return dom_gbt.train(spark.read.parquet(PAGES))


def test_pages_held_out(spark, trees):
    rows = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").where("page_id >= 2000").limit(300).collect()
    got = {r.page_id: r for r in dom_gbt.main_text(spark.createDataFrame(rows), trees=trees).collect()}
    equal = [got[r.page_id].text == article_of(r.html) for r in rows]
    assert np.mean(equal) >= 0.98 and all(got[r.page_id].n_chars == len(got[r.page_id].text) for r in rows)


def test_other_layouts_held_out(spark, trees):
    rng = random.Random(77)
    rows = spark.read.parquet(PAGES).where("page_id >= 200").collect()
    good = 0
    for r in rows:
        page = dom_gbt.Page(r.html)
        junk = [t for t in page.text(dom_gbt.labels(page) < 1).split("\n\n") if t]
        blocks = article_of(r.html).split("\n\n")[:30]
        gold = dom_gbt.layouts(blocks, junk, rng)
        named = dom_gbt.Page(gold)
        other = dom_gbt.Page(re.sub(r"gold(?:article|junk) ?", "", gold))
        good += other.text(other.decode(trees.odds(other.features()))) == named.text(dom_gbt.labels(named) > 0)
    assert good / len(rows) >= 0.9


def test_page_cases(spark, trees):
    page = ('<html><head><title>x</title></head><body><nav><ul><li><a href="/">Home</a></li></ul></nav><article><h1>A &lt;b&gt; title</h1>'
            '<p>First  line<br>and\n more &amp; more words, as an article has them, in some number.<p>Second <b>para</b>graph &#8364;5, which '
            'also has a number of words, so that it is dense.</p><script>var t="</p>";</script><!-- <p>no</p> --></article>'
            '<footer>&copy; all</footer></body></html>')
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (4, "u", "<p></p><br/>"), (5, "u", "<div" * 2000), (6, "u", "</a></b><p>"),
            (1, "u", page), (7, "u", "<div>" * 3000 + "deep" + "</div>" * 10)]
    df = spark.createDataFrame([(*r, "k", "t") for r in rows], "page_id long, url string, html string, text string, n_chars string")
    got = dom_gbt.main_text(df, trees=trees).collect()
    assert len(got) == 8
    by = {r.page_id: r.text for r in got}
    assert by[1] == ("A <b> title\n\nFirst line and more & more words, as an article has them, in some number.\n\n"
                     "Second paragraph €5, which also has a number of words, so that it is dense.")
    assert by[2] == by[3] == by[4] == ""
    assert dom_gbt.main_text(df.where("false")).count() == 0


LONG = ("The river had risen in the night, and by the morning the lower fields were under water, as they had been in the spring "
        "of the year before. Nobody in the village was surprised, and few had moved their cattle.")
MORE = "A second paragraph follows the first, with some more words, so that the article has the size that articles have."

HAND_MADE = {  # inside the article, and its text
    "list": ("<ul><li>Flour</li><li>Two eggs</li></ul><ol><li>Mix</li><li>Bake</li></ol>", ["Flour", "Two eggs", "Mix", "Bake"]),
    "table": ("<table><tr><th>Year</th><th>Rain</th></tr><tr><td>2019</td><td>640 mm</td></tr></table>", ["Year", "Rain", "2019", "640 mm"]),
    "terms": ("<dl><dt>Ford</dt><dd>A shallow place</dd></dl>", ["Ford", "A shallow place"]),
    "section": ("<section><h2>Later</h2><p>It fell again.</p></section>", ["Later", "It fell again."]),
    "details": ("<details><summary>Notes</summary><p>Measured at the bridge.</p></details>", ["Notes", "Measured at the bridge."]),
    "line": ("<div>A line by itself.</div>", ["A line by itself."]),
    "figure": ("<figure><img src=x><figcaption>The bridge</figcaption></figure>", ["The bridge"]),
    "loose": ("Loose words in the article.", ["Loose words in the article."]),
    "aside": ('<aside class="related"><p>Read more about rivers</p></aside>', []),
    "ad": ('<div class="ad">Buy boots now</div>', []),
}


@pytest.mark.parametrize("kind", list(HAND_MADE))
@pytest.mark.parametrize("frame", ["plain", "notices"])
def test_hand_made_articles_are_kept_whole(trees, kind, frame):
    inner, want = HAND_MADE[kind]
    article = f"<article><header><h1>High water</h1></header><p>{LONG}</p>{inner}<p>{MORE}</p></article>"
    around = ("<nav><ul><li><a href=/>Home</a></li><li><a href=/a>News</a></li></ul></nav>{}<footer>Contact us</footer>" if frame == "plain"
              else "This site uses cookies.<nav><a href=/>Home</a></nav>{}<form><input><label>Your name</label></form>&copy; 2024 Example")
    page = dom_gbt.Page(f"<!doctype html><html><head><title>t</title></head><body>{around.format(article)}</body></html>")
    got = page.text(page.decode(trees.odds(page.features())))
    assert got.split("\n\n") == ["High water", LONG, *want, MORE]


def test_unmatched_end_tags_take_linear_time():
    start = time.process_time()
    dom_gbt.Page("<div>" * 3000 + "</p>" * 20_000 + "text")
    dom_gbt.Page("<x-box>" * 20_000 + "text")
    assert time.process_time() - start < 3


def test_decoding_never_contradicts():
    rng = np.random.default_rng(6)
    page = dom_gbt.Page("<div><p>a<p>b<ul><li>c<li>d</ul></div><div><section><p>e</section><p>f</div>")
    for _ in range(50):
        odds = rng.normal(0, 2, len(page.tag))
        keep = page.decode(odds)
        assert all(keep[page.parent[i]] for i in range(1, len(keep)) if keep[i])

        def best(i):  # gain of keeping i, by trying all
            return odds[i] + sum(max(0, best(c)) for c in range(len(keep)) if page.parent[c] == i)
        assert abs(sum(odds[keep]) - max(0, best(0))) < 1e-9


def test_boosting_fits_an_interaction():
    rng = np.random.default_rng(4)
    x = rng.random((4000, 3)).astype(np.float32)
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    t = dom_gbt.Trees.fit(x[:3000], y[:3000])
    assert ((t.odds(x[3000:]) > 0) == (y[3000:] > 0)).mean() > 0.97


def test_lm_scores(spark, documents):
    sample = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").limit(500).collect()]
    rows = [r for r in sample if r[0] > 20] + ODD
    docs = documents(rows)
    got = nce_lm.lm_scores(docs, table_words=2000).collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    counts = Counter(w for i, t in rows if not held(i) for w in nce_lm.tokens_of(t or ""))
    total, kinds = sum(counts.values()), len(counts)

    def expect(i, t):
        words = nce_lm.tokens_of(t or "")
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in words)
        return str(i), held(i), len(words), sum(counts[w] > 0 for w in words), total, round(base, 4)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == sorted(
        expect(i, t) for i, t in rows)
    out = [r for r in got if r.held_out and r.n_tokens > 30]
    assert len(out) > 20 and sum(r.score for r in out) > sum(r.base_score for r in out)
    again = {r.doc_id: r.score for r in nce_lm.lm_scores(docs, table_words=2000).collect()}
    assert all(again[r.doc_id] == r.score for r in got if r.doc_id not in (6,))


def test_lm_probabilities_sum_to_one():
    rng = np.random.default_rng(9)
    size = 40
    par = {k: rng.normal(0, 1, (size, nce_lm.DIM)) for k in ("r1", "r2", "q")} | {"bias": rng.normal(0, 1, (size, 1))}
    model = nce_lm.Model(par)
    a, b = rng.integers(0, size, 200), rng.integers(0, size, 200)
    p = sum(10 ** model.log10(a, b, np.full(200, w)) for w in range(size))
    assert np.allclose(p, 1)
    table = [(f"w{i}".encode(), 100 - i) for i in range(60)]
    mass, kinds = np.zeros(10), np.zeros(10)
    for w, c in table[30:]:
        mass[nce_lm.bucket_of(w, 10)] += c
        kinds[nce_lm.bucket_of(w, 10)] += 1
    s = nce_lm.Symbols(table, mass, kinds, 30, 10)
    for k in range(10):                       # the words of a class and one unseen word share all of it
        own = [c for w, c in table[30:] if nce_lm.bucket_of(w, 10) == k]
        total = sum(10 ** (math.log10(c + 0.1) - s.log_share[30 + k]) for c in [*own, 0])
        assert abs(total - 1) < 1e-9


def test_lm_cases(documents):
    docs = documents(ODD)
    assert len(nce_lm.lm_scores(docs, rounds=1).collect()) == len(ODD)
    assert nce_lm.lm_scores(docs.where("false")).count() == 0
    only_held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    r = nce_lm.lm_scores(documents([(only_held, "no training text")])).first()
    assert r.held_out and r.train_tokens == 0 and r.n_known == 0 and abs(r.base_score - 4 * math.log10(0.1 / 0.1)) < 1e-9


def test_lm_rounds_learn_from_all_trigrams(spark):
    rng = np.random.default_rng(10)
    size = 40
    symbols = [rng.integers(0, size, 500) for _ in range(3)]
    code = np.unique((symbols[0] << 20) | (symbols[1] << 10) | symbols[2])
    n = rng.integers(1, 9, len(code))
    counts = np.bincount(code & 1023, n, size)
    # Counts come in halves, from several tasks; equal trigrams are added up.
    own = nce_lm.mixed(code)
    assert (nce_lm.mixed(own, nce_lm.UNMIX) == code).all() and len(np.unique(own)) == len(code)
    order = np.argsort(own)
    rows = [r for k in (n // 2, n - n // 2) for r in nce_lm.piece_rows(own[order], k[order]).to_pylist()]
    pieces = spark.createDataFrame([tuple(r.values()) for r in rows], nce_lm._PIECES).repartition(3)
    table = nce_lm.learners(pieces, 5)
    assert table.count() == nce_lm.PARTS
    parts = [order[(own[order] >> nce_lm.PLACE_BITS) % nce_lm.PARTS == p] for p in range(nce_lm.PARTS)]
    par = nce_lm.start_parameters(size, counts)
    past = {k: np.full(v.shape, 1e-6) for k, v in par.items()}
    for step in range(2 * nce_lm.PARTS):
        part = parts[step % nce_lm.PARTS]
        nce_lm.nce_steps(par, past, code[part], n[part].astype(np.float64), counts, 1_000_003 * step)
    got = nce_lm.train(table, counts, rounds=2)
    assert all(np.allclose(got[k], par[k], atol=1e-3) for k in par)


def test_lm_scores_do_not_depend_on_the_layout(spark, documents, monkeypatch):
    monkeypatch.setattr(nce_lm, "LEARNER", 4_000)  # several learners
    monkeypatch.setattr(nce_lm, "TOGETHER", 700)
    sample = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    one = {r.doc_id: (r.score, r.base_score) for r in nce_lm.lm_scores(documents(sample, 1)).collect()}
    monkeypatch.setattr(nce_lm, "FLUSH_TOKENS", 5_000)
    many = documents(sample, 2).repartition(5, "n_chars", "doc_id")
    assert {r.doc_id: (r.score, r.base_score) for r in nce_lm.lm_scores(many).collect()} == one


@pytest.mark.parametrize("page", [
    "<!doctype html><html><head><meta charset=u><title>t</title><body><p>one</p><p>two</p>",
    "<head><link rel=x><title>t</title><style>p{}</style><p>one<p>two",
    "<body><p>one <svg class=i viewBox='0 0 1 1'/></p><svg/><p>two</p>",
    "<body><svg><title/><path d='M0'/><g><text>no</text></g></svg><p>one</p><div><button>no</div><p>two</p>",
    "<body><button>no<p>one</p><select><option>no<p>two</p>",
    "<body><div><button><p>no</p></button><select><option>no</select>one</div><canvas>no<p>two</p>",
    "<body><button-bar>one</button-bar><object-list><p>two</p></object-list><template><p>no</p></template>",
    "<body><object data=x><object><p>no</p></object>no</object><p>one</p><script>'<p>no'</script ><p>two",
    "<head></head><body><p>one</p><header-box></header-box><head><p>two</p><noscript><p>no</p></noscript>",
])
def test_dropped_elements_take_no_text_with_them(page):
    made = dom_gbt.Page(page)
    assert made.text(np.ones(len(made.tag), bool)).split() == ["one", "two"]
