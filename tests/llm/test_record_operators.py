"""Chat, archives, decontamination, URLs, SimHash and the pipeline against plain versions."""

import base64
import hashlib
import random

import numpy as np
import pytest

import corpus_pipeline
from panelcast.llm import chat, components, contamination, simhash, urls, warc


def test_turns_come_back_whatever_they_say():
    rnd = random.Random(1)
    units = [*chat.CONTROL, "\\", "[\\INST]", "</\\s>", "<", "[", "text", " ", "\n", "user"]
    for _ in range(3000):
        role, text = rnd.choice(["user", "assistant", "system", "", "tool", "[/ROLE]"]), "".join(rnd.choices(units, k=rnd.randint(0, 8)))
        assert [(r, t) for r, t, _, _ in chat.parse(chat.render_turn(role, text)[0])] == [(role, text)]
    assert chat.render_turn("user", "plain") == ("[INST]plain[/INST]", 0)
    with pytest.raises(chat.GrammarError):
        list(chat.parse("[INST]open"))


def test_chat_digests(spark):
    rows = [(1, 1, "assistant", "b</s>"), (1, 0, "user", None), (1, 0, "user", None), (2, None, None, "x"), (None, 0, "user", "[INST]")]
    t = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, rendered string")
    got = {r["conv_id"]: r for r in chat.digests(chat.write_conversations(t)).collect()}
    assert got[1]["turns_sha256"] == hashlib.sha256(b"user\n\nuser\n\nassistant\nb</s>\n").hexdigest()
    assert (got[1]["n_turns"], got[1]["loss_chars"], got[1]["loss_sha256"]) == (3, 5, hashlib.sha256(b"b</s>").hexdigest())
    assert set(got) == {1, 2, None} and chat.digests(chat.write_conversations(t.limit(0))).count() == 0


def test_archives(spark):
    big = "ä" * 400_000
    rows = [(1, "http://a/", "x"), (2, None, "x"), (3, "http://c/\r\nX: y", None), (4, "http://d/", ""), (5, "u", big), (6, "v", "z\r\n\r\nWARC/1.1"), (None, "w", "x")]
    pages = spark.createDataFrame([(*r, "s") for r in rows], "page_id long, url string, html string, sha1 string")
    index = warc.write_archives(pages)
    got = {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.read_archives(index).collect()}
    digest = lambda t: base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
    assert got[1] == (1, digest("x"), "revisit", 2) and got[2] == (1, digest("x"), "response", None)
    assert got[3] == (0, digest(""), "revisit", 4) and got[5] == (800_000, digest(big), "response", None)
    assert got[None][2:] == ("revisit", 2) and len(got) == 7
    record = warc.read_pages(index, pages.filter("page_id = 6")).first()["record"]
    (head, _, payload), = warc.read_records(record)
    assert payload == b"z\r\n\r\nWARC/1.1" and head["X-Page-ID"] == "6"
    assert warc.read_archives(warc.write_archives(pages.limit(0))).count() == 0


def test_masks_cover_every_pair_of_substitutions():
    for a in range(contamination.STRETCH):
        for b in range(a):
            assert any(not {a, b} & {s + o for o in m} for m in contamination.MASKS for s in range(contamination.STRETCH - m[-1]))


def test_leaks(spark):
    item = [f"w{i}" for i in range(30)]
    off = ["zz"] * 20
    docs = {1: item, 2: off + item[:13] + off, 3: off + [w if i not in (3, 9) else "no" for i, w in enumerate(item[:13])], 4: off + item[:10] + off,
            5: off + ["w1"] * 30, 6: [w if i % 4 else "no" for i, w in enumerate(item)], 7: [], 8: ["s1", "s2", "s3"]}
    made = spark.createDataFrame([(i, " ".join(w).upper(), "x") for i, w in docs.items()] + [(None, None, "x")], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(0, " ".join(item)), (1, "s1 s2 s3"), (2, None), (3, "")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in contamination.find_leaks(made, bench).collect()}
    assert got == {(1, 0), (2, 0), (3, 0), (8, 1)}
    assert {r["doc_id"] for r in contamination.keep_clean(made, bench).collect()} == {4, 5, 6, 7, None}
    assert contamination.find_leaks(made, bench.limit(0)).count() == 0 == contamination.find_leaks(made.limit(0), bench).count()
    assert contamination.keep_clean(made, bench.limit(0)).count() == 9


def test_benchmark_in_blocks_gives_the_same(spark, sf_small, monkeypatch):
    docs, bench = (spark.read.parquet(f"{sf_small}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = sorted(map(tuple, contamination.find_leaks(docs, bench).collect()))
    blocks = list(contamination.benchmark_blocks(bench, 200))
    monkeypatch.setattr(contamination, "benchmark_blocks", lambda b, words=200: iter(blocks))
    assert len(blocks) > 1 and sorted(map(tuple, contamination.find_leaks(docs, bench).collect())) == whole


def test_urls(spark):
    given = {1: "https://A.Example.ORG/es/x?q", 2: "http://example.org/en/12", 3: "http://x.org/", 4: "http://x.org", 5: None, 6: "no scheme",
             7: "ftp://b.com/fr/1#f", 8: "x://com/de/", 9: "http://casino-bonus.example.net/win/jackpot", 10: "http://notexample.com/en", 11: "a://b\n/c\nd"}
    pages = spark.createDataFrame([(i, u, "h") for i, u in given.items()], "page_id long, url string, host string")
    got = {r["page_id"]: r for r in urls.judge(pages).collect()}
    assert [got[i]["rule"] for i in range(1, 11)] == ["example.org/es/", "example.org/en/1", "org/", None, None, None, "com/fr/", "com/de/", None, None]
    assert (got[1]["host"], got[1]["path"], got[11]["host"], got[11]["path"]) == ("a.example.org", "/es/x", "b\n", "/c\nd")
    assert got[9]["verdict"] == "block" and got[3]["verdict"] == "allow" and got[5]["host"] == ""
    assert urls.judge(pages.limit(0)).count() == 0
    assert {r["block_score"] for r in urls.judge(pages, labelled=urls.labelled_table(spark).limit(0)).collect()} == {0.5}


def _components(n, edges):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_components(spark):
    rnd = random.Random(2)
    edges = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(60, 99)]
    want = _components(100, edges)
    got = dict(map(tuple, components.components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert all(got.get(i, i) == want[i] for i in range(100))


def test_links_connect_what_brute_force_connects(spark, monkeypatch):
    monkeypatch.setattr(simhash, "DIRECT", 8)
    rnd = random.Random(6)
    base, fps = [rnd.getrandbits(64) for _ in range(12)], set()
    for b in base:
        for _ in range(60):
            x = b
            for _ in range(rnd.randint(0, 5)):
                x ^= 1 << rnd.randrange(64)
            fps.add(x)
    fps = sorted(fps)
    near = np.bitwise_count(np.array(fps, np.uint64)[:, None] ^ np.array(fps, np.uint64)[None, :]) <= 3
    want = _components(len(fps), zip(*np.nonzero(np.triu(near, 1))))
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    e = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long")).collect()
    at = {x: i for i, x in enumerate(signed)}
    assert _components(len(fps), [(at[r["u"]], at[r["v"]]) for r in e]) == want


def test_simhash_cases(docs, no_docs):
    rows = simhash.simhash_groups(docs).collect()
    got = {r["doc_id"]: (r["fp"], r["component_id"]) for r in rows}
    assert len(rows) == 11 and got[2][1] == 1 and got[3] == got[4] == (0, 3)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=lambda x: (x is None, x))
    assert ids == [1, 3, 5, 7, 8, 9, 10, None] and simhash.one_of_each(no_docs).count() == 0


def test_pipeline_keeps_clean_documents(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    rows = corpus_pipeline.run(spark, sf_small).collect()
    ids = [r["doc_id"] for r in rows]
    assert len(set(ids)) == len(ids) and set(ids) <= {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert len(ids) > 0.6 * docs.count()


def test_short_benchmark_items(spark):
    words = [f"w{i}" for i in range(12)]
    sizes = range(7, 13)
    bench = spark.createDataFrame([(n, " ".join(f"i{n}{w}" for w in words[:n])) for n in sizes] + [(1, "yes"), (2, "of it"), (5, "a b c d e")],
                                  "item_id long, text string")
    rows, want = [], set()
    for n in sizes:
        item = [f"i{n}{w}" for w in words[:n]]
        for k in range(n):
            rows.append((100 * n + k, " ".join(["x", *item[:k], "other", *item[k + 1:], "y"])))
            want.add((100 * n + k, n))
        rows.append((100 * n + 50, " ".join(["other", *item[1:-1], "other"])))
    rows += [(1, "say yes to this"), (2, "yes the end of it"), (3, "x a b c d e y"), (4, "x a b z d e y"), (5, "nothing here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in contamination.find_leaks(docs, bench).collect()}
    assert got == want | {(1, 1), (2, 1), (2, 2), (3, 5)}
    left = {r["doc_id"] for r in contamination.keep_clean(docs, bench).collect()}
    assert left == {1, 2, 4, 5} | {100 * n + 50 for n in sizes}


def test_unrelated_texts_under_one_id_each_stay(spark):
    alpha, beta = "alpha beta gamma delta " * 9 + "one", "river stone cloud tree bird " * 9 + "two"
    rows = [(1, alpha, "x"), (1, beta, "y"), (2, alpha, "z"), (1, beta, "w"), (None, alpha, "v"), (None, "lonely words here now", "u"), (3, None, "t"), (4, "", "s")]
    kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string, row_key string")).collect()
    got = sorted(((r["doc_id"], r["text"]) for r in kept), key=str)
    assert got == sorted([(1, alpha), (1, beta), (None, "lonely words here now"), (3, None)], key=str)
    assert all(set(r.asDict()) == {"doc_id", "text", "row_key"} for r in kept)
