"""The pipeline's stages against brute force on a small corpus."""

import random

import corpus_pipeline
from sessionmart.llm.registry import tokenizer_file
from test_ngram_join import brute


def small(seed=8):
    r = random.Random(seed)
    vocabulary = [f"w{int(i ** 1.4)}" for i in range(300)]
    say = lambda n: " ".join(r.choices(vocabulary, k=n)).capitalize() + "."
    item = say(30)
    passage = " ".join(say(12) for _ in range(6))
    docs = {i: "\n".join(say(r.randint(8, 30)) for _ in range(r.randint(3, 8))) for i in range(60)}
    docs[10] += "\n" + item
    docs[11] = "too short"
    docs[12] = "same words again and again " * 30
    for i in (20, 21, 22):
        docs[i] += "\n" + passage
    docs[31] = say(120)
    w = docs[31].split(" ")
    w[60] = "changed"
    docs[99] = " ".join(w)  # a near copy that line dedup leaves a few words of
    docs[100] = docs[31].upper()  # one that it leaves whole
    docs[101] = docs[32]
    return docs, item, passage


def test_stages_take_effect_in_order(spark, tmp_path):
    docs, item, passage = small()
    spark.createDataFrame([(i, t, "en", "src", len(t)) for i, t in docs.items()],
                          "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "packing"]
    now = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns, seen = now.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in now.collect()}
        now = corpus_pipeline.written(stage(spark, now, str(tmp_path)), name)
        if name == "packing":
            break
        assert now.columns == columns
        after = {r.doc_id: r.text for r in now.collect()}
        gone = set(before) - set(after)
        if name == "quality_rules":
            assert gone == {11, 12}
        if name == "line_dedup":
            assert gone == {99, 101}
            flat = {d: " ".join(t.split()) for d, t in after.items()}
            assert [d for d in flat if passage in flat[d]] == [20]
        if name == "ngram_jaccard_join":
            assert gone == {d for d, _, c in brute(list(before.items())) if d != c} and 100 in gone
        if name == "benchmark_decontamination":
            assert gone == {10}
        seen.append(after)
    pieces = now.collect()
    assert {p.doc_id for p in pieces} == set(seen[-1])
    whole = {}
    for p in sorted(pieces, key=lambda p: (p.doc_id, p.start)):
        assert p.start == whole.get(p.doc_id, 0)
        whole[p.doc_id] = p.start + p.length
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_file())
    assert whole == {d: len(tok.encode(t, add_special_tokens=False).ids) + 1 for d, t in seen[-1].items()}
    assert {p.doc_id for p in corpus_pipeline.run(spark, str(tmp_path)).collect()} == set(seen[-1])
