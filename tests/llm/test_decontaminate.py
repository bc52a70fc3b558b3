import random

import numpy as np
from sessionmart.llm.decontaminate import align, decontaminate, matches


def plain_align(a, b):
    """Best local alignment score, cell by cell."""
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if x == y else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
    return max(map(max, h))


def test_alignment_scores_agree_with_the_table_method():
    r = random.Random(1)
    pairs = [([r.randrange(5) for _ in range(r.randint(1, 12))], [r.randrange(5) for _ in range(r.randint(1, 20))]) for _ in range(200)]
    score, _, _ = align([np.array(a, np.uint64) for a, _ in pairs], [np.array(b, np.uint64) for _, b in pairs])
    assert score.tolist() == [plain_align(a, b) for a, b in pairs]


def least(item):
    """Score that counts: half of a full match, and seven matched words, or all words of a shorter item."""
    return max(len(item), 2 * min(7, len(item)))


def edited(r, words, share):
    out = []
    for w in words:
        x = r.random()
        out += [] if x < share / 3 else [f"new{r.randrange(9999)}"] if x < share * 2 / 3 else [w, f"ins{r.randrange(9999)}"] if x < share else [w]
    return out


def test_edited_copies_are_found_and_clean_documents_are_not(spark):
    r = random.Random(3)
    vocabulary = [f"w{int(i ** 1.3)}" for i in range(400)]
    say = lambda n: r.choices(vocabulary, weights=[1 / (i + 1) for i in range(400)], k=n)
    items = [say(r.randint(18, 50)) for _ in range(25)]
    rows, planted = [], set()
    for i in range(200):
        words = say(r.randint(0, 300))
        if i % 4 == 0:
            k, at = r.randrange(len(items)), r.randint(0, len(words))
            words[at:at] = edited(r, items[k], r.choice([0, 0.05, 0.15]))
            planted.add((i, k))
        rows.append((i, " ".join(words).capitalize() + "."))
    rows += [(900, None), (901, ""), (902, " ".join(items[0]).upper()), (None, " ".join(items[1]))]
    planted |= {(902, 0), (None, 1)}
    docs = spark.createDataFrame([(*x, "k") for x in rows], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(k, ", ".join(w)) for k, w in enumerate(items)] + [(100, None), (101, "two words"), (102, "")], "item_id long, text string")
    text = dict(rows)
    for block in (1_000_000, 300):
        got = {(m.doc_id, m.item_id): m for m in matches(docs, bench, block_words=block).collect()}
        assert planted <= set(got)
        for (d, k), m in got.items():  # whatever is found is a true alignment of that score
            words = [w.strip(".,").lower() for w in (text[d] or "").split()]
            assert plain_align(items[k], words) >= 0.5 * 2 * len(items[k])
            assert plain_align(items[k], words[m.word_from:m.word_to]) == round(m.score * 2 * len(items[k]))
    clean = decontaminate(docs, bench, block_words=300).collect()
    assert sorted(str(x.doc_id) for x in clean) == sorted(str(d) for d, _ in rows if d not in {p for p, _ in got})
    assert matches(docs, bench.where("false")).collect() == [] and matches(docs.where("false"), bench).collect() == []
    assert decontaminate(docs, bench.where("false")).count() == len(rows)


def test_no_spread_of_edits_hides_a_copy(spark):
    r = random.Random(8)
    items = [[f"w{k}x{j}" for j in range(n)] for k, n in enumerate([3, 4, 26, 33, 60, 120] * 4)]
    rows, planted = [], set()

    def plant(k, words):
        at, own = r.randrange(60), [f"own{r.randrange(9999)}" for _ in range(60)]
        own[at:at] = words
        if plain_align(items[k], words) >= least(items[k]):  # all that is planted, of items of 7 words or more
            planted.add((len(rows), k))
        assert len(items[k]) < 7 or (len(rows), k) in planted
        rows.append((len(rows), " ".join(own)))
    for k, item in enumerate(items):
        for step in (3, 4, 5):  # every third, fourth, fifth word changed, and verbatim copies beside
            plant(k, [f"new{r.randrange(9999)}" if j % step == step - 1 else w for j, w in enumerate(item)])
        plant(k, [x for w in item for x in (w, f"ins{r.randrange(9999)}")])  # a word behind every word
        plant(k, item)
        for share in (0.2, 0.25):
            words = edited(r, item, share)
            if plain_align(item, words) >= len(item):
                plant(k, words)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    assert {(m.doc_id, m.item_id) for m in matches(docs, bench).collect()} == planted


def test_all_alignments_that_count_are_found_in_texts_of_few_words(spark):
    r = random.Random(9)
    say = lambda n: [r.choice("abcdefg") for _ in range(n)]
    items, docs = [say(r.choice([3, 4, 5, 8, 12, 16])) for _ in range(40)], [say(r.randint(0, 60)) for _ in range(60)]
    want = {(d, k): plain_align(x, y) for d, y in enumerate(docs) for k, x in enumerate(items) if plain_align(x, y) >= least(x)}
    got = matches(spark.createDataFrame([(d, " ".join(w)) for d, w in enumerate(docs)], "doc_id long, text string"),
                  spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")).collect()
    assert len(want) > 20 and {(m.doc_id, m.item_id): round(m.score * 2 * len(items[m.item_id])) for m in got} == want


def test_case_is_folded_beyond_a_to_z(spark):
    text = "ñandú éxito straße übung ключ слово"
    docs = spark.createDataFrame([(1, text.upper()), (2, text)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, text)], "item_id long, text string")
    assert sorted((m.doc_id, m.score) for m in matches(docs, bench).collect()) == [(1, 1.0), (2, 1.0)]


def test_short_items_do_not_match_ordinary_text(spark):
    items = ["name the largest planet", "what is the capital of the country", "who wrote the book about the old man of the sea",
             "which of these is the name of the tallest mountain in the world"]
    rows = [(1, "we know the largest of them and name the country of the man"), (2, "the capital of the state is what the old book of the world is about"),
            (3, "it is the name of some book on our world and on the tallest of the old"), (4, "the " * 300), (5, "of the sea of the sea who is the man")]
    rows += [(100 + k, f"some text before. {t.upper()}! some text behind") for k, t in enumerate(items)]
    rows += [(200, "see: who wrote the book about an old man of the sea"), (201, "which of these is the name of the highest mountain in our world"),
             (202, "what is the capital of this country")]  # the last one lacks a word of a short item
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(m.doc_id, m.item_id) for m in matches(docs, bench).collect()}
    assert got == {(100 + k, k) for k in range(4)} | {(200, 2), (201, 3)}
    assert sorted(x.doc_id for x in decontaminate(docs, bench).collect()) == [1, 2, 3, 4, 5, 202]
