import hashlib
import random

import numpy as np
from parity import compare
from sessionmart.llm.chat_format import digests, escape, format_conversations, mask, parse, render, unescape
from sessionmart.llm.registry import ORACLE, RULES, tokenizer_file
from sessionmart.llm.url_filter import filter_urls, propagate

HARD = ["", "\\", "###", "\\### Assistant: </turn> ok", "####", "</turn>", "<</turn>>", "a\\", "\n", "  lead", "trail \n ", "é 日本", "a: b", "\\\\###\\", "</turn>\n### user: x"]


def test_rendering_is_reversible():
    turns = [(r, t) for r in ("user", "assistant", "", "we:ird\\###", "</turn>") for t in HARD]
    text, spans = render(turns)
    assert list(parse(text)) == turns
    assert [unescape(text[a:b]) for a, b in spans] == [t for _, t in turns]
    assert all(unescape(escape(t)) == t for t in HARD)


def test_mask_agrees_with_a_scan_of_the_tokens():
    r = random.Random(1)
    for _ in range(50):
        ends = sorted(r.sample(range(1, 80), 12)) + [80]
        offsets = list(zip([0] + ends[:-1], ends))
        cuts = sorted(r.sample(range(80), 6))
        spans = np.array(cuts).reshape(-1, 2)
        lo, hi, clipped = mask(offsets, spans)
        for (a, b), i, j, (c, d) in zip(spans, lo, hi, clipped):
            assert [k for k, (s, e) in enumerate(offsets) if s < b and e > a] == list(range(i, j))
            assert (c, d) == (a, b)


def expected(rows):
    """Digests by plain Python."""
    convs = {}
    for c, t, r, x in sorted(rows, key=lambda y: (y[0] is not None, y[0] or 0, y[1] is not None, y[1] or 0, y[2] or "")):
        convs.setdefault(c, []).append((r or "", x or ""))
    out = {}
    for c, turns in convs.items():
        loss = "".join(x for r, x in turns if r == "assistant")
        whole = "".join(f"{r}\n{x}\n" for r, x in turns)
        out[c] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(render(turns)[0]))
    return out


def test_digests_read_back_equal_plain_python(spark):
    r = random.Random(2)
    rows = [(c, t, r.choice(["user", "assistant", "system"]), r.choice(HARD + ["plain words here"])) for c in range(30) for t in range(r.randint(1, 6))]
    rows += [(100, t, "assistant", "turn %d " % t * 40) for t in range(200)] + [(None, 0, None, None), (None, 1, "assistant", "x"), (200, None, "user", "null turn"), (200, 0, "assistant", "b")]
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for block in (65_536, 50):
        blocks = format_conversations(docs, tokenizer_file(), block_chars=block)
        got = {x.conv_id: tuple(x[1:]) for x in digests(blocks).collect()}
        assert got == expected(rows)
    assert digests(format_conversations(docs.where("false"), tokenizer_file())).collect() == []


def test_blocks_have_the_tokens_of_the_whole(spark):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_file())
    rows = [(1, t, "user" if t % 2 else "assistant", x) for t, x in enumerate(HARD * 3)]
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for block in (65_536, 10):
        got = format_conversations(docs, tokenizer_file(), block_chars=block).orderBy("turn", "part").collect()
        whole = "".join(b.formatted for b in got)
        ids = np.concatenate([np.frombuffer(b.ids, "<u4") for b in got]).tolist()
        assert ids == tok.encode(whole, add_special_tokens=False).ids


URLS = [(1, "http://a.example.org/es/1?x"), (2, "https://example.org/en/1#t"), (3, "ftp://EXAMPLE.ORG/fr/"), (4, "http://x.com/fr/a"), (5, "http://x.com/de/a"),
        (6, "http://x.com/en/a"), (7, None), (8, "no scheme"), (9, "http://notexample.org/es/"), (10, "http://host.net"), (11, "://"), (None, "http://b.net/?q=/a"), (1, "http://a.example.org/es/1?x")]


def test_rules_and_parts_of_urls(spark):
    pages = spark.createDataFrame([(i, u, None) for i, u in URLS], "page_id long, url string, html string")
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in filter_urls(pages, RULES).collect()), key=str)
    want = sorted([
        (1, "a.example.org", "/es/1", "example.org/es/", "block"), (1, "a.example.org", "/es/1", "example.org/es/", "block"),
        (2, "example.org", "/en/1", "example.org/en/1", "block"), (3, "example.org", "/fr/", "org/", "allow"),
        (4, "x.com", "/fr/a", "com/fr/", "allow"), (5, "x.com", "/de/a", "com/de/", "block"), (6, "x.com", "/en/a", None, "allow"),
        (7, "", "", None, "allow"), (8, "", "", None, "allow"), (9, "notexample.org", "/es/", "org/", "allow"), (10, "host.net", "", None, "allow"),
        (11, "", "", None, "allow"), (None, "b.net", "/", None, "allow")], key=str)
    assert got == want
    assert filter_urls(pages.where("false"), RULES).collect() == []


def test_distrust_flows_back_to_linking_hosts(spark):
    rows = [(1, "http://bad.com/de/x", ""), (2, "http://links.net/a", '<a href="http://bad.com/de/x">x</a><a HREF=//bad.com>'),
            (3, "http://good.org/", "<a href='https://friend.net/z'>"), (4, "http://friend.net/z", "<a href='/self'>"), (5, "http://far.net/", "<a href='http://links.net/'>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in filter_urls(pages, RULES).collect()}
    assert got[2].verdict == "block" and got[4].verdict == "allow" and got[4].trust > 0 and got[5].distrust > 0


def test_scores_agree_with_plain_iteration(spark):
    r = random.Random(3)
    hosts = [f"h{i}" for i in range(12)]
    edges = {(r.choice(hosts), "h0" if r.random() < 0.3 else r.choice(hosts)) for _ in range(40)}
    edges = sorted(e for e in edges if e[0] != e[1])
    good, bad = {h: r.random() for h in hosts}, {h: r.random() for h in hosts}
    t, d = {h: .15 * good[h] for h in hosts}, {h: .15 * bad[h] for h in hosts}
    for _ in range(12):
        n = {h: .15 * good[h] for h in hosts}, {h: .15 * bad[h] for h in hosts}
        for a, b in edges:
            n[0][b] += .85 * t[a] / sum(x == a for x, _ in edges)
            n[1][a] += .85 * d[b] / sum(x == b for _, x in edges)
        t, d = n
    seeds = spark.createDataFrame([(h, good[h], bad[h]) for h in hosts], "host string, good double, bad double")
    for x in propagate(seeds, spark.createDataFrame(edges, "src string, dst string")).collect():
        assert abs(x.trust - t[x.host]) < 1e-9 and abs(x.distrust - d[x.host]) < 1e-9


def test_hosts_that_link_to_a_blocked_host_are_blocked_however_many_they_are(spark):
    linking, rows = {}, []
    for n in (3, 30, 300):
        for crawled in (True, False):
            bad = f"bad{n}{crawled}.com"
            for i in range(n):
                linking[len(rows)] = n
                rows.append((len(rows), f"http://links{i}.of{bad[:-4]}.net/a", f"<a href='http://{bad}/de/x?q'>x</a>" + "<a href='//friend.net/z'>" * (i == 0)))
            rows += [(10_000 + len(rows), f"http://{bad}/de/x", "")] if crawled else []
    clean = [(1000, "http://plain.net/", "<a href='http://friend.net/z'>"), (1001, "http://friend.net/z", ""), (1002, "http://fan.net/", "<a href='http://good.org/p'>")]
    got = {r.page_id: r.verdict for r in filter_urls(spark.createDataFrame(rows + clean, "page_id long, url string, html string"), RULES).collect()}
    assert len(got) == len(rows) + 3 and all(got[i] == "block" for i in linking)
    assert all(got[i] == "allow" for i, _, _ in clean)


def test_verdicts_equal_sql_where_hosts_link_to_each_other(spark, tmp_path):
    import duckdb
    r = random.Random(21)
    hosts = [f"{r.choice(['', 'www.', 'A.'])}h{i}.{r.choice(['com', 'net', 'org', 'example.org'])}" for i in range(60)]
    far = [f"far{i}.{r.choice(['com', 'net', 'org'])}" for i in range(20)]
    path = lambda: r.choice(["/de/x", "/fr/y?q", "/es/1", "/en/1", "/", "", "#f", "/z"])
    rows = []
    for i in range(400):
        links = [f"<A HREF={q}{r.choice(['http:', 'https:', ''])}//{r.choice(hosts[:12] * 3 + hosts + far)}{path()}{q}>x</a>"
                 for q in r.choices(["'", '"'], k=r.choice([0, 0, 1, 3, 8]))]
        rows.append((i, r.choice([f"http://{r.choice(hosts)}{path()}"] * 9 + [None, "no scheme", "://"]), r.choice([None] + 5 * ["".join(links)])))
    pages = spark.createDataFrame(rows + rows[:9], "page_id long, url string, html string").selectExpr("*", "1 as host", "2 as path", "3 as trust", "4 as rules")
    pages.coalesce(1).write.parquet(str(tmp_path / "pages"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages/*.parquet')")
    got = filter_urls(spark.read.parquet(str(tmp_path / "pages")), RULES).drop("trust", "distrust")
    res = compare(got, con, ORACLE["op2_url_filters"])
    assert res["cols_match"] and res["values_match"], res
    spread = [x.verdict for x in got.where("rule is null and host <> ''").collect()]
    assert min(spread.count("allow"), spread.count("block")) > 20
