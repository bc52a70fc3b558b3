"""Line dedup against a brute-force search for repeated runs of words."""

import random

import pytest
from conftest import SF01
from sessionmart.llm.line_dedup import dedup_lines

SHAPE = "doc_id long, text string"


def repeated(rows, least):
    """Maximal runs of ``least`` words or more that stand at an earlier place too: (doc, first word, one past the last).

    Rows of different documents, in the order of the operator.
    """
    seen, out = set(), []
    for d, t in rows:
        w = (t or "").split()
        open_ = None
        for i in range(len(w) - least + 1):
            g = tuple(w[i:i + least])
            if g in seen:
                if open_ and i <= open_[1]:
                    open_[1] = i + least
                else:
                    open_ = [i, i + least]
                    out.append((d, open_))
            seen.add(g)
    return [(d, a, b) for d, (a, b) in out]


def kept_flags(text, removed):
    """Per word of the text before, whether it was kept."""
    flags, at = [], 0
    for w in (text or "").split():
        at = text.index(w, at)
        flags.append(not any(x["from"] <= at < x["to"] for x in removed or []))
        at += len(w)
    return flags


def shares(docs, rows, least=51):
    """Runs over 50 words: how many, how many lost no word, and the share of their words deleted."""
    got = {x.doc_id: x.removed for x in dedup_lines(docs).collect()}
    text, runs = dict(rows), repeated(rows, least)
    flags = {d: kept_flags(text[d], got[d]) for d in {r[0] for r in runs}}
    gone = [sum(not f for f in flags[d][a:b]) for d, a, b in runs]
    return len(runs), sum(g == 0 for g in gone), sum(gone) / max(1, sum(b - a for _, a, b in runs)), runs, got


def test_every_long_verbatim_run_of_the_given_documents_goes(spark):
    rows = sorted((x.doc_id, x.text) for x in spark.read.parquet(f"{SF01}/documents.parquet").collect())
    n, missed, share, runs, got = shares(spark.read.parquet(f"{SF01}/documents.parquet"), rows)
    assert n > 50 and missed == 0 and share > 0.98
    # nothing goes that no earlier place has: documents without a repeated run of 16 words stay whole
    some = {d for d, _, _ in repeated(rows, 16)}
    assert all(x is None for d, x in got.items() if d not in some)


@pytest.mark.parametrize("length", [51, 58, 75, 150])
@pytest.mark.parametrize("style", ["sentences", "no stops", "few words"])
def test_runs_inside_edited_sentences_are_found_to_their_ends(spark, length, style):
    r = random.Random(length)
    size = 12 if style == "few words" else 3000

    def words(n):
        out = [f"{r.choice('abcdefgh')}{r.randrange(size)}" for _ in range(n)]
        return out if style == "no stops" else [w + "." if r.random() < 0.08 else w for w in out]
    rows = []
    for k in range(25):
        run = words(length)
        for i in range(2):
            rows.append((10 * k + i, " ".join([f"own{k}x{i}y{j}" for j in range(r.randint(0, 60))] + [f"l{k}x{i}"] + run + [f"r{k}x{i}"]
                                              + [f"end{k}x{i}y{j}" for j in range(r.randint(0, 60))])))
    got = {x.doc_id: x for x in dedup_lines(spark.createDataFrame(rows, SHAPE)).collect()}
    for k in range(25):
        assert got[10 * k].removed is None and got[10 * k].text == dict(rows)[10 * k]
        assert got[10 * k + 1].removed_words == length
        assert got[10 * k + 1].text.split() == [w for w in rows[2 * k + 1][1].split() if w.startswith(("own", "end")) or w[1:] == f"{k}x1"]


def test_columns_with_any_names_pass_through(spark):
    text = " ".join(f"w{i}" for i in range(80))
    docs = spark.createDataFrame([(1, text), (2, text), (3, None)], SHAPE).selectExpr(
        "*", "1 as doc", "2 as hash", "3 as chains", "4 as __runs", "5 as doc_", "6 as HASH_", "7 as chains_", "8 as part", "9 as removed")
    got = {x.doc_id: x for x in dedup_lines(docs).collect()}
    assert got[1].text == text and got[2].text == "" and got[3].text is None
    assert all([x[c] for c in ("doc", "hash", "chains", "__runs", "doc_", "HASH_", "chains_", "part")] == list(range(1, 9)) for x in got.values())
