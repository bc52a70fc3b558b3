import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from conftest import SF001
from llm_fixtures import frame  # noqa: F401
from sessionmart.llm.packing import UnitEncoder, pack
from sessionmart.llm.registry import tokenizer_file
from sessionmart.llm.sharding import shard, write_shards
from tokenizers import Tokenizer

TOKENIZER = Tokenizer.from_file(tokenizer_file())
ODD = [None, "", " ", "\n\n x", "a  b\n\nc ", "don't  stop\t\tnow", "x y   z", "<|endoftext|> end", "end <|endoftext|> start", "a<|endoftext|><|endoftext|>b  c", "ünï cödé 日本語 text\r\n", " lead", "trail  \n "]


def test_unit_lookup_gives_the_tokenizers_ids():
    r = random.Random(5)
    texts = [t or "" for t in ODD] + ["".join(r.choices(["ab", "é", " ", "  ", "\n", "'s", "1", ".", "\t", "Z"], k=r.randint(0, 60))) for _ in range(300)]
    enc = UnitEncoder(tokenizer_file())
    for _ in range(2):
        for t, ids in zip(texts, enc(texts)):
            assert ids.tolist() == plain_ids(t), t
    assert plain_ids("end <|endoftext|> start") == [437, 220, 50256, 923]


def test_new_latin_words_skip_the_pre_tokeniser_and_units_take_few_bytes(monkeypatch):
    r = random.Random(6)
    enc, seen = UnitEncoder(tokenizer_file()), []
    whole = enc.whole
    monkeypatch.setattr(enc, "whole", lambda t: seen.append(t) or whole(t))
    words = ["".join(r.choices("abcdeXYZéüßñČőƀɏ", k=r.randint(1, 12))) for _ in range(3000)]
    texts = [" ".join(words[i:i + 100]) for i in range(0, 3000, 100)] + ["don't stop", "x1 2y ×÷ª ǃa ɐb", "日本 語x", "a" * 1_500_000]
    for t, ids in zip(texts, enc(texts)):
        assert ids.tolist() == plain_ids(t), t[:50]
    assert not any(w in t for t in seen for w in words if len(w) > 4)
    assert enc.known.nbytes + enc.slot.nbytes == 16 * len(enc.known) > 16 * 2000


def test_other_pre_tokenisers_are_encoded_whole():
    path = tokenizer_file("word_bpe_49k.json")
    enc, tok = UnitEncoder(path), Tokenizer.from_file(path)
    for t, ids in zip(ODD, enc([t or "" for t in ODD])):
        assert ids.tolist() == tok.encode(t or "", add_special_tokens=False).ids


def test_limits_bind_in_the_query_and_each_document_is_whole(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(x.doc_id, x.text) for x in docs.collect()]
    for segments, loss in ((256, 2048), (3, 2048), (256, 1500), (2, 700)):
        got = pack(docs, tokenizer_file(), max_segments=segments, max_loss_tokens=loss).collect()
        assert check_pieces(rows, got, 2048, segments, loss) < 0.01 * sum(p.length for p in got)
        by_seq = defaultdict(list)
        for p in got:
            by_seq[p.sequence_id].append(p)
        assert segments == 256 or max(map(len, by_seq.values())) == segments
        assert (max(p.sequence_tokens for p in got) == 2048) == (loss == 2048)  # a sequence closed by loss is a power of two long


def plain_ids(text):
    """Ids by the library alone, with its defaults."""
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


def check_pieces(rows, got, limit, segments, loss):
    want = defaultdict(int)
    for d, t in rows:
        want[(d, tuple(plain_ids(t)) + (1,))] += 1
    docs, seqs = defaultdict(list), defaultdict(list)
    for p in got:
        ids = np.frombuffer(p.ids, "<u4").tolist()
        assert len(ids) == p.length
        docs[p.doc_id].append((p.start, ids))
        seqs[p.sequence_id].append((p.offset, p.length, p.sequence_tokens, p.loss_tokens))
    for d, pieces in docs.items():
        if d is not None and sum(r[0] == d for r in rows) == 1:
            whole = []
            for start, ids in sorted(pieces):
                assert start == len(whole)
                whole += ids
            assert want[(d, tuple(whole))] == 1
    assert sum(len(i) for p in docs.values() for _, i in p) == sum(len(k[1]) * n for k, n in want.items())
    padding = 0
    for pieces in seqs.values():
        at = 0
        for offset, length, total, _ in sorted(pieces):
            assert offset == at
            at += length
        assert at == pieces[0][2] <= limit and len(pieces) <= segments and sum(x[3] for x in pieces) <= loss
        padding += 0 if at & (at - 1) == 0 else limit - at
    return padding


@pytest.mark.parametrize("segments,loss", [(256, 2048), (3, 2048), (256, 40)])
def test_each_id_in_one_piece_and_limits_hold(frame, segments, loss):
    r = random.Random(7)
    rows = [(i, " ".join(r.choices(["the", "of", "zebra", "Ünï"], k=r.choice([0, 1, 3, 30, 200])))) for i in range(120)]
    rows += [(1000 + i, t) for i, t in enumerate(ODD)] + [(None, "null id"), (3, "again"), (2000, "long text " * 9000)]
    got = pack(frame(rows), tokenizer_file(), max_tokens=64, max_segments=segments, max_loss_tokens=loss).collect()
    assert check_pieces(rows, got, 64, segments, loss) == 0


def test_prompt_tokens_bear_no_loss(frame):
    for row, loss in (((1, "a b c d e f g", 4), 4), ((2, "x", None), 1)):
        (p,) = pack(frame([row], "doc_id long, text string, lead int"), tokenizer_file(), max_tokens=16, prompt="lead").collect()
        assert p.loss_tokens == loss
    assert pack(frame([]), tokenizer_file()).collect() == []


def least_capacity(sizes, shards):
    """Smallest capacity of contiguous shards, by trying every start of a shard."""
    lo, hi = max(sizes), sum(sizes)
    while lo < hi:
        mid, n, room = (lo + hi) // 2, 1, (lo + hi) // 2
        for s in sizes:
            if s > room:
                n, room = n + 1, mid
            room -= s
        lo, hi = (lo, mid) if n <= shards else (mid + 1, hi)
    return lo


def shard_case(frame, spark, rows, shards):
    from pyspark.sql import functions as F
    docs = frame(rows)
    got = shard(docs, shards).collect()
    keyed = docs.select(F.xxhash64(F.coalesce("text", F.lit(""))).alias("k"), F.coalesce("text", F.lit("")).alias("t")).collect()
    groups = defaultdict(int)
    for r in keyed:
        groups[r.k] += len(r.t.encode()) + 1
    best = least_capacity([groups[k] for k in sorted(groups)], shards)
    load, slots, of_text = defaultdict(int), defaultdict(list), {}
    for r in got:
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
        assert 0 <= r.shard < shards
    assert max(load.values()) <= best == got[0].capacity
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == sorted(
        (str(d), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    by_id = {r.doc_id: r.shard for r in got if r.doc_id is not None}
    for d, t in rows:
        if d is not None:
            assert of_text.setdefault(t or "", by_id[d]) == by_id[d]
    return load


def test_shards_have_the_least_capacity(frame, spark):
    r = random.Random(2)
    rows = [(i, "".join(r.choices("abcé", k=r.randint(0, 60)))) for i in range(400)] + [(900, None), (901, ""), (None, "z")]
    load = shard_case(frame, spark, rows, 16)
    assert max(load.values()) < 1.3 * sum(load.values()) / 16


def test_a_hot_group_stays_whole(frame, spark):
    rows = [(i, "same text") for i in range(300)] + [(1000 + i, f"text {i}") for i in range(300)]
    load = shard_case(frame, spark, rows, 4)
    assert len(load) == 4
    shard_case(frame, spark, [(1, "only")], 16)
    assert shard(frame([]), 16).collect() == []


def test_shards_are_written(frame, spark, tmp_path):
    rows = [(i, f"text {i % 40}") for i in range(100)]
    place = write_shards(frame(rows), str(tmp_path / "out"), 4)
    there = {(r.doc_id, r.shard) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert there == {(r.doc_id, r.shard) for r in place.collect()}
