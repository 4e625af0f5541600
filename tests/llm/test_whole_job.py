"""Cases in which an operator once did less than the whole job."""

import random
import time

import numpy as np

from ranklab.llm import html_text, packing, quality_knn, quality_rules
from ranklab.llm.queries import tokenizer


def test_table_junk_is_rejected_and_prose_kept(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 8)))
    plain = [" ".join(word() for _ in range(rng.randint(60, 200))) for _ in range(300)]
    junk = [" | ".join(f"{word()} {word()}" for _ in range(rng.randint(20, 60))) for _ in range(40)]     # 0.33 symbols a word
    docs = [(i, t, "en", "s") for i, t in enumerate(plain + junk)]
    out = quality_rules.judge(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")).collect()
    assert not any(r["kept"] or r["base_failed"] for r in out if r["doc_id"] >= 300)
    assert sum(not r["kept"] for r in out if r["doc_id"] < 300) <= 3


def text(page):
    return html_text.text_of(html_text.parse(page))


def test_attribute_values_are_no_names():
    kept = ['href="/hidden/beaches.html"', 'title="the hidden cost"', 'href="/x?id=related"', 'href="/a?x=1&class=share"', "title='id=nav'",
            "href=/a?x=1&class=share", 'data-hidden="1"', 'data-class="nav"', 'title="a" alt="role=search"', '"hidden"', 'href="/x"title="id=ad"']
    for a in kept:
        assert text(f"<article><p>one <a {a}>two</a> three<div {a}>four</div></article>") == "one two three four", a
    for a in ('hidden', 'HIDDEN=""', 'class="x nav"', "id=share", 'role = "search"', 'title="x"hidden', "a=b/ class='ad'", 'href="/hidden" hidden'):
        assert text(f"<article><p>one <a {a}>two</a> three<div {a}>four</div></article>") == "one three", a


def test_wrappers_around_an_article_keep_it():
    page = "<body><{0}><nav>menu</nav><article><p>one</p><form>mail</form><p>two</p></article><button>go</button></{0}></body>"
    assert {text(page.format(w)) for w in ("form", "div", "aside", "dialog", "nav")} == {"one two"}
    assert text("<form><h1>one</h1><div>two</div><button>go</button></form>") == "one two"
    assert text("<form><div>one</div><nav>menu</nav></form>") == "one"
    assert text("<p>one</p><form>mail</form><aside><h1>two</h1></aside>") == "one"
    assert text("<head><title>t</title><meta><body><p>one</p>") == "one"


def test_embedded_elements_end():
    for e in ('<svg class="icon"/>', "<svg><path></svg>", '<svg class="icon"><path d=""/>', "<svg>", "<select><option>a</select>", "<object data=x>",
              "<iframe src=x>", "<iframe src=x />", "<noscript>", "<textarea>", "<title>", "<math/>", "<svg><title>a</title><text>b</text></svg>"):
        assert text(f"<article>{e}<p>one</p><p>two {e} three</p><p>four</p></article><div>five</div>") == "one two three four", e
    assert text("<article><p>let <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> be</p><p>so</p></article>") == "let x = 1 be so"
    assert text("<article><p>one</p><textarea><p>no</article></textarea><p>two</p></article>") == "one two"


def test_any_number_of_open_elements():
    for t in ("a", "b", "font"):
        assert text(f"<div><article><p>one {f'<{t}>' * 3000}two</article><p>three</p></div>") == "one two"
    started = time.time()
    assert text("<article>one " + "<b>" * 20000 + "</i>" * 20000 + "<svg><title>" * 20000) == "one"
    assert time.time() - started < 20


def test_packing_gives_the_ids_of_an_unmodified_tokenizer():
    from tokenizers import Tokenizer

    exact, own = Tokenizer.from_file(tokenizer()), packing.Ids(tokenizer())
    added = [t.content for t in exact.get_added_tokens_decoder().values()]
    assert "<|endoftext|>" in added
    for t in added:
        for x in (t, f"one {t} two", f"one{t}{t}two's", f"漢字 {t}\n", t[:-1], f"one {t[1:]} {t}"):
            assert own(x) == own(x) == np.array(exact.encode(x, add_special_tokens=False).ids, "<u4").tobytes(), x
    assert own("<|endoftext|>") == np.array([50256], "<u4").tobytes()


def test_repeated_tokens_count_at_any_length():
    rng = random.Random(4)
    sign = lambda n: quality_knn.terms(" ".join(f"w{rng.randint(0, 30)}" for _ in range(n)))[-3]
    assert all(abs(sign(n) - sign(200)) < 0.1 for n in (399, 400, 401, 5000)) and sign(400) > 4
    assert quality_knn.terms(" ".join(f"w{i}" for i in range(5000)))[-3] == 0


def test_names_do_not_empty_pages():
    assert text('<body class="has-sidebar"><p>hello</p></body>') == text('<body class="sidebar"><p>hello</p></body>') == "hello"
    assert text('<article class="post comments-open"><p>hello</p></article>') == "hello"
    assert text('<article><p>one</p><p class="social-security">two</p></article>') == "one two"
    assert text('<div class="share"><p>all there is on this page</p></div>') == "all there is on this page"
    long = "<p>" + "much text " * 20 + "</p>"
    for name in ("ad", "site-footer", "cookie-banner", "ad-slot-3", "social share", "post-comments", "sidebar widget"):
        assert text(f'<body>{long}<div class="{name}">noise</div></body>').endswith("text"), name
        assert text(f'<article>{long}<div id="{name.replace(" ", "-")}">noise</div></article>').endswith("text"), name


def test_comments_go_whatever_they_hold():
    page = '<article><p>one</p><div id="comments"><h1>What readers say</h1><article><p>first!</p></article></div></article>'
    assert text(page) == "one"
    assert text('<main><p>one</p></main><section class="comments"><article class="comment"><p>' + "long " * 50 + "</p></article></section>") == "one"
    assert text('<article><p>one</p></article><article class="comment"><p>two</p></article>') == "one"


def test_main_text_beats_a_teaser():
    assert text("<main><p>The text of this page is here, in main.</p><article><p>A teaser</p></article></main>").startswith("The text of this page")
    assert text("<main><div>x</div><article><p>The text</p></article><p>by</p></main>") == "The text"


def test_template_inside_articles_decides(spark):
    """Containers that recur in many different articles of a host go; paragraphs, large parts and parts of copies stay."""
    box = '<div class="x9"><span>Read us every day</span></div>'
    body = "<article><h1>title {0}</h1><p>text number {0} which is long enough to be most of it all</p>{1}<p>shared line</p></article>"
    pages = [(i, f"http://a.example/{i}", body.format(i, box)) for i in range(12)]
    pages += [(100 + i, f"http://b.example/{i}", body.format(0, box) + f"<p>{i}</p>") for i in range(12)]           # copies of one article
    pages += [(200 + i, f"http://c.example/{i}", f"<article><p>{i}</p><div>a large part of a short article</div></article>") for i in range(12)]
    pages += [(300 + i, f"http://d.example/{i}", body.format(i, box)) for i in range(4)]                              # too few pages
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    out = {r["page_id"]: r["text"] for r in html_text.extract(df).collect()}
    off = {r["page_id"]: r["text"] for r in html_text.extract(df, share=2.0).collect()}
    assert all("every day" not in out[i] and "every day" in off[i] and "shared line" in out[i] and f"text number {i}" in out[i] for i in range(12))
    assert all("every day" in out[100 + i] and "large part" in out[200 + i] for i in range(12)) and "every day" in out[300]
    # brute force: the pages of each subtree
    counts = {}
    for i, url, page in pages:
        root = html_text.parse(page)
        for h in html_text.subtrees(root):
            counts.setdefault((url.split("/")[2], h), set()).add(html_text.identity(root))
    n = {}
    for _, url, page in pages:
        n.setdefault(url.split("/")[2], set()).add(html_text.identity(html_text.parse(page)))
    want = {(host, h) for (host, h), own in counts.items() if len(own) >= 5 and len(own) >= 0.3 * len(n[host])}
    got = {(r["host"], bytes(h)) for r in html_text.site_templates(df).collect() for h in r["template"]}
    assert got == want and want


def test_neighbour_votes_against_plain_loops():
    """The 25 largest cosines by a sort, ties by training row; the same scores in blocks of any size."""
    import math

    import numpy as np
    from ranklab.llm import quality_knn as knn

    rng = np.random.default_rng(3)
    x = rng.poisson(0.3, (400, knn.TERMS)).astype(np.float32)
    x[200:] = x[:200]                                            # every vector twice, with other labels
    x[7] = 0
    base = np.linalg.qr(rng.normal(size=(knn.TERMS, knn.RANK)))[0]
    model = knn.Model(rng.random(knn.TERMS).astype(np.float32), base, np.zeros((0, knn.RANK)), rng.integers(0, 2, 400).astype(float), 0.4)
    model.vectors = model.project(x)
    asked = np.concatenate([x[:40], rng.poisson(0.3, (20, knn.TERMS)).astype(np.float32)])
    scores = model.score(asked)
    for q, score in zip(asked, scores):
        if not q.any():
            assert score == 0.4
            continue
        z = [sum(a) for a in zip(*(float(v) * float(w) * row for v, w, row in zip(q, model.weight, base) if v))]
        z = [v / math.sqrt(sum(a * a for a in z)) for v in z]
        near = [round(sum(a * b for a, b in zip(z, row)), 9) for row in model.vectors]
        top = sorted(range(400), key=lambda i: (-near[i], i))[:25]
        votes = [max(near[i], 0) ** 4 for i in top]
        assert abs(score - sum(v * model.labels[i] for v, i in zip(votes, top)) / sum(votes)) < 1e-6
    for size in (1, 7, 60):
        assert (np.concatenate([model.score(asked[at: at + size]) for at in range(0, 60, size)]) == scores).all()


def test_ngrams_leave_a_task_in_pieces(monkeypatch):
    """A task holds n-grams of a few documents at a time, however many documents its batch has."""
    import pyarrow as pa
    import pytest
    from ranklab.llm import toxicity
    from ranklab.llm.common import words

    given = []

    def stop(df, work, schema):
        given.append(work)
        raise RuntimeError

    monkeypatch.setattr(toxicity, "map_batches", stop)
    monkeypatch.setattr(toxicity, "CELLS", 500, raising=False)
    with pytest.raises(RuntimeError):
        toxicity.select(None)
    texts = [f"some words {i} of text number{i} and others" for i in range(100)]
    made = given[0](pa.RecordBatch.from_pydict({"at": list(range(100)), "label": [i % 2 for i in range(100)], "text": texts}))
    pieces = [made] if isinstance(made, dict) else list(made)
    longest = max(len(toxicity.damped(words(t))) for t in texts)
    assert max(len(p["gram"]) for p in pieces) < 500 + longest
    cells = [c for p in pieces for c in zip(p["gram"], p["toxic"], p["fold"], p["weight"])]
    assert cells == [(g, i % 2 > 0, i % 3, w) for i, t in enumerate(texts) for g, w in toxicity.damped(words(t)).items()]
