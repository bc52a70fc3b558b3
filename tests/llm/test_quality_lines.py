import random
import re
from collections import Counter

from parity import compare
from sessionmart.llm.line_dedup import dedup_lines
from sessionmart.llm.quality_rules import clean, judge
from sessionmart.llm.registry import ORACLE

WORD = re.compile("[^\x20\x09-\x0d]+")


def base(text):
    text = text or ""
    w = WORD.findall(text)
    grams = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    hit = {j for i in range(len(w) - 7) if grams[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit))


def test_base_counts_agree_with_plain_python(spark):
    r = random.Random(1)
    texts = [None, "", " ", "a", "\n\n", "a\n a\na\nA", "x " * 8, "x " * 9, "# <b> $%&|*", "é ß\x0bx\x0cy\rz\tq", "nbsp x"]
    texts += [" ".join(r.choices("a b c d".split(), k=r.randint(1, 80))) + r.choice(["", "\n", "\nsame\nsame"]) for _ in range(100)]
    texts += ["w%d " % i * 3 for i in range(5)] + ["long text with words " * 5000]
    rows = [(i, t, None) for i, t in enumerate(texts)] + [(None, "n", "s"), (1, "", None)]
    got = judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == sorted(
        (str(d), *base(t)) for d, t, _ in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert judge(spark.createDataFrame([], "doc_id long, text string, source string")).collect() == []


def test_frequent_lines_go_and_depleted_documents_with_them(spark):
    own = lambda i, n: " ".join(f"w{i}x{j}" for j in range(n))
    rows = [(i, f"Share   this PAGE now\n{own(i, 30)}", "h") for i in range(40)]
    rows += [(100, "share this page now\n" + own(100, 15), "h"), (101, "share this page now\n" + own(101, 30), "other"), (102, own(102, 25), "h")]
    rows += [(200 + i, own(200, 40) + "\n" + own(201, 40), "h") for i in range(60)]  # copies count once
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 as host", "'z' as removed_lines")
    got = {r.doc_id: r for r in judge(docs).collect()}
    assert got[0].removed_words == 4 and got[0].kept and not got[100].kept and got[101].removed_words == 0
    assert all(got[200 + i].kept and got[200 + i].removed_words == 0 for i in range(60))
    left = {r.doc_id: r for r in clean(docs).collect()}
    assert set(left) == {r[0] for r in rows} - {100}
    assert left[0].text == own(0, 30) and left[102].text == own(102, 25) and left[0].removed_lines == "z"


def test_template_lines_go_although_own_lines_start_like_them(spark):
    own = lambda i, n: " ".join(f"w{i}x{j}" for j in range(n))
    rows = [(i, f"Read more about our partners and their many offers\nAll rights reserved by the makers\nRead more about {own(i, 25)}", "h")
            for i in range(60)]
    lines = [own(7000 + j, 14) for j in range(12)]
    for i in range(60):  # near copies with a word changed, left out or put in count once
        words = [x.split() for x in lines]
        at = words[i % 12], i % 14
        at[0][at[1]:at[1] + (i % 3 < 2)] = [f"e{i}"] * (i % 3 != 1)
        rows.append((1000 + i, "\n".join(map(" ".join, words)), "h"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 as row_", "2 as HOST_", "3 as __lines", "4 as lines_")
    got = {x.doc_id: x.removed_words for x in judge(docs).collect()}
    assert all(got[i] == 15 for i in range(60)) and not any(got[1000 + i] for i in range(60))
    left = {x.doc_id: x for x in clean(docs).collect()}
    assert all(left[i].text == f"Read more about {own(i, 25)}" and (left[i].row_, left[i].HOST_, left[i]["__lines"]) == (1, 2, 3) for i in range(60))


def test_judge_equals_sql_where_lines_are_frequent(spark, tmp_path):
    r = random.Random(12)
    pool = [" ".join(r.choices("abcdefghij", k=r.randint(1, 14))) for _ in range(60)]
    rows = []
    for i in range(900):
        lines = r.sample(pool[:r.choice([10, 60])], r.randint(0, 9)) + [f"own{i} " + " ".join(r.choices("abcdefghij", k=12)) for _ in range(r.randint(0, 3))]
        for _ in range(r.randint(0, 2)):
            k = r.randrange(len(lines) + 1)
            if k < len(lines):
                w = lines[k].split()
                w[r.randrange(len(w))] = r.choice(["edit", "a", f"e{i}", "b b"])
                lines[k] = " ".join(w)
        rows.append((i, r.choice(["\n", "\n\n", " \n"]).join(lines), r.choice("pq")))
    rows += rows[:30]
    spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1).write.parquet(str(tmp_path / "documents"))
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents/*.parquet')")
    got = judge(spark.read.parquet(str(tmp_path / "documents"))).drop("removed_lines", "row", "host")
    res = compare(got, con, ORACLE["op5_quality_rules"])
    assert res["cols_match"] and res["values_match"], res
    assert got.where("removed_words > 0").count() > 100


def sentences(r, n):
    return [" ".join(r.choice("abcdefghijklmnop") + str(r.randrange(500)) for _ in range(r.randint(4, 14))) + "." for _ in range(n)]


def test_planted_passages_stay_once_and_clean_texts_stay_whole(spark):
    r = random.Random(5)
    passages = [sentences(r, 7) for _ in range(6)]
    passages = [p for p in passages if sum(len(s.split()) for s in p) >= 50]
    rows, holds = [], {}
    for i in range(120):
        own, k = sentences(r, 12), r.randrange(len(passages) * 3)
        if k < len(passages):
            at = r.randrange(12)
            own[at:at] = passages[k]
            holds.setdefault(k, []).append(i)
        rows.append((i, "".join(s + r.choice([" ", "\n"]) for s in own)))
    rows += [(500, None), (501, ""), (502, "short. short. short."), (503, rows[0][1]), (504, "same words over and over. " * 400), (None, rows[1][1])]
    got = {x.doc_id: x for x in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    flat = lambda t: " ".join(t.split())
    text = dict(rows)
    for k, docs in holds.items():
        for d in docs:
            assert (" ".join(passages[k]) in flat(got[d].text)) == (d == min(docs))
            left = flat(text[d]).replace(" ".join(passages[k]), "") if d != min(docs) else flat(text[d])
            assert flat(got[d].text) == flat(left)
    touched = {d for docs in holds.values() for d in docs if d != min(docs)} | {503, 504, None}
    for d, t in rows:
        if d not in touched:
            assert got[d].text == t and not got[d].removed_words
    assert got[503].text == "" and got[503].removed[0]["from"] == 0
    assert got[None].text == "" and 0 < len(got[504].text.split()) < 60
    for d in touched - {None}:
        gone = "".join(text[d][x["from"]:x["to"]] for x in got[d].removed)
        assert len(gone.split()) == got[d].removed_words


def test_rows_repeated_with_their_id_are_one_document(spark):
    r = random.Random(6)
    t = " ".join(sentences(r, 12))
    docs = spark.createDataFrame([(1, t, "x"), (1, t, "y"), (2, t, "z")], "doc_id long, text string, runs string")
    got = sorted((x.doc_id, x.runs, x.text) for x in dedup_lines(docs).collect())
    assert got == [(1, "x", t), (1, "y", t), (2, "z", "")]
    assert dedup_lines(docs.where("false")).collect() == []
    alone = spark.createDataFrame([(i, " ".join(sentences(r, 12))) for i in range(30)], "doc_id long, text string")
    assert all(x.removed is None for x in dedup_lines(alone).collect())  # hash ranges without any repeat


def test_template_lines_of_a_host_go_however_many_its_pages_share(spark):
    own = lambda i, n: " ".join(f"w{i}x{j}" for j in range(n))
    rows = [(100 * t + i, "\n".join([f"line {k} of template {t} here" for k in range(t)] + [own(100 * t + i, 30 + 4 * t)]), f"h{t}")
            for t in (2, 5, 10, 40) for i in range(60)]
    article = [own(9000 + j, 12) for j in range(20)]
    for i in range(60):  # near copies, one word each edited, count once
        lines = [x.split() for x in article]
        lines[i % 20][i % 12] = f"e{i}"
        rows.append((10_000 + i, "\n".join(map(" ".join, lines)), "h0"))
    rows += [(20_000 + i, "\n".join([own(3, 20), own(4, 20), own(500 + i // 3, 30)]), "h1") for i in range(60)]  # 20 texts, three times each
    got = {r.doc_id: r.removed_words for r in judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    for t in (2, 5, 10, 40):
        assert all(got[100 * t + i] == 6 * t for i in range(60))
    assert not any(got[d] for d in got if d >= 10_000)
