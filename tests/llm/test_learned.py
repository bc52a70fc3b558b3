import random
import re

import numpy as np
import pytest
from sessionmart.llm import html_extract as H
from sessionmart.llm import toxicity as T

PAGES = [
    ("<html><body><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav><header><h1>Site name</h1></header><article><h1>A title here</h1>"
     "<p>First   paragraph of the text &amp; more,\n with words.<p>Second paragraph, which says <b>some</b>thing else.</article>"
     "<section class='comments'><div class=comment><p>I do not agree with this at all.</p></div></section><footer>&copy; Site</footer></body></html>",
     "A title here First paragraph of the text & more, with words. Second paragraph, which says something else."),
    ("<div class='cookie-notice'>We use cookies to make the site better for you.</div><div id=content><p>The only paragraph of the page is this one here."
     "<form><label>Mail</label><button>Send</button></form><script>var x='<p>no</p>';</script></div><aside class=sidebar><p>Other texts you could read next week.</aside>",
     "The only paragraph of the page is this one here."),
]


@pytest.fixture(scope="module")
def model():
    return H.train_default()


def test_main_text_of_small_pages(model):
    for page, text in PAGES:
        assert H.main_text(model, page)[0] == text
    for page in (None, "", " ", "<p", "<!-- x", "<script>var a", "</p></div>", "<p></p>"):
        assert H.main_text(model, page)[0] == ""


def test_held_out_pages_are_decoded(model):
    wrong = total = 0
    for page, labels in H.labelled_pages(150, seed=1234):
        got = model.decode(H.features(H.blocks(page)))
        wrong += sum(a != b for a, b in zip(got, labels))
        total += len(labels)
    assert wrong / total < 0.03


def renamed(page, how):
    """The page with its class and id names replaced by unknown ones, or removed."""
    r = random.Random(1)
    return re.sub(r"\s(class|id)=(\"[^\"]*\"|'[^']*'|[^\s>]+)", lambda k: f' {k[1]}="zq{r.randrange(999)}"' if how == "unknown" else "", page)


@pytest.mark.parametrize("how, precision, recall", [("unknown", 0.78, 0.9), ("removed", 0.7, 0.95)])
def test_pages_whose_names_say_nothing(model, how, precision, recall):
    hit = kept = there = 0
    for page, y in H.labelled_pages(150, seed=99):
        got = model.decode(H.features(H.blocks(renamed(page, how))))
        hit, kept, there = hit + sum(a and b for a, b in zip(got, y)), kept + sum(got), there + sum(y)
    assert hit / kept >= precision and hit / there >= recall


def test_hand_written_pages_of_other_shapes(model):
    long = "The river rose again in the night, and by the morning the lower road was under water. Nobody had expected it so early in the year."
    pages = {
        "old": f"<html><body bgcolor=white><center><a href=/>Home</a> | <a href=/a>Archive</a> | <a href=/b>About us</a></center><hr><h1>Flood</h1><p>{long}<p>{long}<hr></body></html>",
        "bare": f"<p>{long}</p>\n<p>{long}</p>",
        "app": f"<div id=root><nav><a href=/>Start</a><a href=/x>News</a></nav><main><h2>Flood</h2><p>{long}</p><p>{long}</p></main><footer>© 2024 River Post</footer></div>",
    }
    for name, page in pages.items():
        text, kept = H.main_text(model, page)
        assert text.count("The river rose again") == 2, name
        assert "Archive" not in text and "River Post" not in text and "News" not in text, (name, text)


def test_viterbi_finds_the_best_path(model):
    for page, _ in H.labelled_pages(20, seed=5):
        feats = H.features(H.blocks(page))[:9]

        def value(path):
            v = model.start[path[0]]
            for i, y in enumerate(path):
                v += sum(model.weight.get(f, 0) for f in feats[i]) * y + (model.trans[path[i - 1]][y] if i else 0)
            return v
        paths = [[k >> i & 1 for i in range(len(feats))] for k in range(1 << len(feats))]
        assert abs(value(model.decode(feats)) - max(map(value, paths))) < 1e-9


def test_extract_keeps_other_columns(spark, model):
    rows = [(1, "u", PAGES[0][0], "t"), (None, None, None, None), (2, "v", "<p>" * 3000 + "x" + "<b " * 100, "t"), (2, "v", PAGES[1][0] * 30, "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = H.extract(pages, model).collect()
    assert len(got) == 4 and got[0].text == PAGES[0][1] and got[1].text == "" and got[1].page_id is None
    assert H.extract(pages.where("false"), model).collect() == []


def test_gradient_of_the_network_agrees_with_differences():
    r = np.random.default_rng(1)
    net = T.Network(3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    table = np.vstack((r.normal(size=(9, T.INPUTS)), np.zeros(T.INPUTS)))
    idx = r.integers(0, 10, (5, 7))
    idx[0] = 9
    y, w = np.array([1, 0, 1, 0, 0.0]), np.ones(5)

    def loss():
        p = 1 / (1 + np.exp(-net.scores(table, idx).astype(float)))
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()
    g = net.gradient(table, idx, y, w)
    for k, v in net.p.items():
        for at in list(np.ndindex(v.shape))[::5]:
            old = v[at]
            v[at] = old + 1e-3
            up = loss()
            v[at] = old - 1e-3
            down = loss()
            v[at] = old
            assert abs((up - down) / 2e-3 - g[k][at]) < 2e-3


def test_windows_cover_every_word():
    at = np.array([0, 0, 5, 69, 300])
    idx, doc = T.windows(at, np.arange(300), 999)
    for d in range(4):
        seen = set(idx[doc == d].ravel()) - {999}
        assert seen == set(range(at[d], at[d + 1]))
    assert (doc == 0).sum() == 1


def test_held_out_accuracy_and_odd_rows(spark):
    r = random.Random(4)
    vocabulary = ["".join(r.choices(["ta", "ri", "mo", "ken", "su", "la"], k=r.randint(1, 4))) for _ in range(300)]
    rude = ["vexq" + x for x in ("a", "en", "ito", "or", "um", "ix", "al", "us")] + ["nasty", "rotten"]
    rows = []
    for i in range(500):
        w = r.choices(vocabulary, k=r.randint(5, 200))
        if i % 5 == 0:
            for _ in range(r.randint(1, 4)):
                w.insert(r.randint(0, len(w)), r.choice(rude))
        rows.append((i, " ".join(w), int(i % 5 == 0)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(600, None), (601, ""), (None, "nasty"), (0, "again tamo")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows] + [(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    got = {}
    for x in T.score(docs, labels, train_on="doc_id % 10 < 7").collect():
        got.setdefault(x.doc_id, x.score)
    held = [(got[i], y) for i, _, y in rows if i % 10 >= 7 and i]
    right = sum((s >= 0.5) == (y == 1) for s, y in held)
    assert right / len(held) > 0.93 and got[600] == got[601] < 0.5 and all(0 <= s <= 1 for s in got.values())
    assert len(got) == 503
    none = T.score(docs, labels.where("toxic = 0")).collect()
    assert {x.score for x in none} == {0.0} and T.score(docs.where("false"), labels).collect() == []


def test_missing_end_tags_and_embedded_elements_lose_no_text():
    text = lambda page: [b[0] for b in H.blocks(page)]
    for head in ("<head><title>No</title><meta charset=utf-8>", "<head><title>No</title></head>", "<head><style>p{}</style><script>var a</script>", ""):
        assert text(f"<html>{head}<body><p>First words.<p>More words.</body></html>") == ["First words.", "More words."]
    assert text("<head><title>No</title><p>First words.") == ["First words."]
    for tag in ("svg", "noscript", "iframe", "template"):
        assert text(f"<article><div>One <{tag}><g>no</div><p>Two.</p></article><p>Three.") == ["One", "Two.", "Three."]
        assert text(f"<article><p>One <{tag}><g>no</g></{tag}> and two.</p><p>Three.</article>") == ["One and two.", "Three."]
    assert text("<noscript><p>no</p><div>no</div></noscript><p>One <noscript><div>no</div></noscript>and two.") == ["One and two."]
    assert text("<div><svg><path d=x><p>One.</p><p>Two.</p></div>") == ["One.", "Two."]
    assert text("<p>Let <math><mi>x</mi></math> be <object data=a>given</object> here.<p>Next.") == ["Let x be given here.", "Next."]
    assert text("<article><object data=a><p>One.</article><p>Two.") == ["One.", "Two."]
