import math
import random
import re

import pytest
from parity import compare, duck
from sessionmart.llm.license_scan import labelled, scan
from sessionmart.llm.licenses import PHRASES, TEMPLATES, Template
from sessionmart.llm.registry import ORACLE, QUERIES

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SHAPE = "doc_id long, text string"


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(text, templates, threshold):
    """All (template, from, to, share) by comparing every block with every template."""
    w, out = words(text), set()
    for i, t in enumerate(templates):
        own = words(t.text)
        if not own:
            continue
        s = max(16, 1 << math.ceil(math.log2(len(own))))
        for k in range(0, len(w), s):
            held = set(w[k:k + 2 * s])
            n = len(set(own) & held)
            if n >= threshold * len(set(own)) - 1e-9 and set(t.needs) <= held and not set(t.without) & held:
                out.add((i, k, min(k + 2 * s, len(w)), round(n / len(set(own)), 9)))
    return out


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_every_block_over_the_threshold_is_found(spark, threshold):
    r = random.Random(8)
    vocabulary = [f"w{i}" for i in range(40)]
    weights = [1 / (i + 1) for i in range(40)]
    templates = [Template(f"t{i}", " ".join(r.choices(vocabulary, weights, k=r.choice([1, 5, 12, 20, 40, 70]))),
                          needs=tuple(r.sample(vocabulary[:6], i % 2)), without=tuple(r.sample(vocabulary[30:], i % 3))) for i in range(40)]
    templates += [Template("empty", " .. "), templates[0]]
    texts = [None, "", " - ", "w1", "W1 é", *(" ".join(r.choices(vocabulary + [f"x{j}" for j in range(30)], k=r.randint(1, 400))) for _ in range(60))]
    texts += [r.choice(["", "own words "]) + t.text.upper() + ". more" for t in templates] + ["w1, w2. " * 30_000, texts[-1]]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[7]), (3, texts[9])]
    docs = spark.createDataFrame(rows, SHAPE).selectExpr("*", "1 as n_words", "'a' as places", "2 as blocks", "3 as word", "4 as n").repartition(4)
    got = scan(docs, templates, [("none", "")], threshold).collect()
    want = sorted((str(d), len(words(t)), sorted(brute(t, templates, threshold))) for d, t in rows)
    assert sorted((str(x.doc_id), x.n_words, sorted((b.template, b["from"], b.to, round(b.share, 9)) for b in x.blocks)) for x in got) == want
    assert sum(len(x[2]) for x in want) > 100 and not any(x.places for x in got)
    assert scan(docs.where("false"), templates, PHRASES).collect() == []
    assert all(x.blocks == [] for x in scan(docs, [], []).collect())


def test_notices_and_edited_notices_get_their_labels_and_prose_none(spark):
    r = random.Random(9)
    prose = lambda n: " ".join(r.choice("abcdefgh") + str(r.randrange(300)) for _ in range(n))
    rows, want = [], {}
    for i, t in enumerate(TEMPLATES):
        edited = [x if r.random() > 0.05 or x.lower().strip(",.") in t.needs else "edited" for x in t.text.split()]
        rows += [(10 * i, f"{prose(90)}\n * {t.text}\n{prose(200)}"), (10 * i + 1, prose(50) + " # " + " ".join(edited))]
        want |= {10 * i: t.label, 10 * i + 1: t.label}
    rows += [(9000 + i, prose(400)) for i in range(20)]
    got = {x.doc_id: x for x in labelled(scan(spark.createDataFrame(rows, SHAPE), TEMPLATES, PHRASES)).collect()}
    for d, label in want.items():
        assert got[d].labels.split(",") == [label], (got[d], rows)
        assert got[d].score >= 0.8
    assert all(got[9000 + i].labels == "" and got[9000 + i].score == 0 for i in range(20))


def test_phrases_are_counted_where_their_words_stand_together(spark):
    rows = [(1, "Released under the MIT License. Under, the-mit\nlicense"), (2, "under the mit"), (3, "CC BY-NC cc by nc"), (4, None),
            (5, "license"), (6, "Apache License, Version 2.0 cc"), (7, "by nc"), (8, "under the mitlicense")]
    got = {x.doc_id: (x.n_words, x.n_base, x.first_word, x.last_word, x.base_labels, x.labels, x.score)
           for x in labelled(scan(spark.createDataFrame(rows, SHAPE), TEMPLATES, PHRASES)).collect()}
    assert got[1] == (9, 2, 1, 5, "mit", "mit", 1.0) and got[3] == (6, 2, 0, 3, "cc-by-nc", "cc-by-nc", 1.0)
    assert got[6] == (6, 1, 0, 0, "apache-2", "apache-2", 1.0)
    assert all(got[d][1:] == (0, None, None, "", "", 0.0) for d in (2, 4, 5, 7, 8))


def test_query_equals_sql_at_a_larger_size(spark):
    r = compare(QUERIES["op12_license_scans"](spark, "/root/testdata/sf0.1"), duck("/root/testdata/sf0.1"), ORACLE["op12_license_scans"])
    assert r["cols_match"] and r["values_match"], r
