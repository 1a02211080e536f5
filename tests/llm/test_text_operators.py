"""Tokenising, token files, licenses, quality and language against plain versions."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest

from panelcast.llm import bpe, language, licenses, mphf, quality, tokenfile

RANKS, WORDS = P.path("byte_bpe_multi_50k.tiktoken"), P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_transducer_equals_library_on_random_text(tiktoken_encoding):
    c, rnd = bpe.codec(bpe.read_ranks(RANKS), P.PATTERN), random.Random(4)
    units = ["a", "th", "er", " ", "  ", "\n", "\t", "é", "ß", "中", "🙂", "12", "'s", "..", "\x1c", "\x85", "\xa0", "A", "\x00", "ing"]
    for _ in range(2000):
        text = "".join(rnd.choice(units) for _ in range(rnd.randint(0, 30)))
        ids = [i for run in c.encode(text) for i in run]
        assert ids == tiktoken_encoding.encode_ordinary(text)
        state, out = c.utf8.start, ""
        for i in ids:                       # one token at a time
            part, state = c.utf8.feed([i], state)
            out += part
        assert out + c.utf8.finish(state) == text


def test_transducer_survives_full_caches(tiktoken_encoding, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_STATES", 50)
    monkeypatch.setattr(bpe, "MAX_CHUNKS", 5)
    monkeypatch.setattr(bpe, "MAX_PIECES", 5)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    c, text = bpe.Codec(ranks, P.PATTERN), "unbelievableschadenfreude" * 40 + " und so weiter"
    assert [i for run in c.encode(text) for i in run] == tiktoken_encoding.encode_ordinary(text)


def test_codec_is_freed_when_released(tiktoken_encoding):
    """What one stage keeps in a worker goes at once when the next stage builds its model."""
    import gc
    import weakref
    c = bpe.Codec(tiktoken_encoding._mergeable_ranks, P.PATTERN)
    assert [i for b in c.encode("one line.\nnext line") for i in b] == tiktoken_encoding.encode_ordinary("one line.\nnext line")
    gone = weakref.ref(c)
    gc.disable()
    try:
        c.release()
        del c
        assert gone() is None
    finally:
        gc.enable()


def test_broken_utf8_is_replaced_as_python_does():
    for data in (b"a\xffb", b"\xe4\xb8", b"\xf0\x9f\x99", b"\xed\xa0\x80x", b"\xc3(", b"\xe0\x80\x80"):
        m = bpe.Utf8Machine({i: data[i:i + 1] for i in range(len(data))})
        text, state = m.feed(range(len(data)))
        assert text + m.finish(state) == data.decode("utf-8", "replace")


def test_round_trip_rows(docs, no_docs, tiktoken_encoding):
    got = sorted(tuple(r) for r in bpe.round_trip(docs.filter("doc_id is not null"), RANKS, P.PATTERN).collect())
    want = []
    for r in docs.filter("doc_id is not null").collect():
        ids = tiktoken_encoding.encode_ordinary(r["text"] or "")
        want.append((r["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((r["text"] or "").encode()).hexdigest()))
    assert got == sorted(want)
    assert bpe.round_trip(no_docs, RANKS, P.PATTERN).count() == 0
    assert bpe.decode(bpe.encode(docs, RANKS, P.PATTERN), RANKS, P.PATTERN).filter("doc_id = 10").first()["text"].startswith("漢字")


def test_perfect_hash_is_minimal_and_knows_foreign_keys():
    keys = mphf.mix(np.arange(20000, dtype=np.uint64), 3)
    h, _ = mphf.PerfectHash.from_bytes(mphf.PerfectHash.build(keys).to_bytes())
    assert sorted(h.find(keys)) == list(range(20000))
    assert (h.find(mphf.mix(np.arange(20000, 40000, dtype=np.uint64), 3)) >= 0).sum() <= 2
    assert len(mphf.PerfectHash.build(keys[:0]).find(keys)) == 20000


def test_token_files(docs, no_docs):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(WORDS)
    rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r))
    want, start = [], 0
    for doc_id, text in rows:
        ids = tok.encode(text, add_special_tokens=False).ids + [1]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    _, index, parts = tokenfile.token_files(docs, WORDS)
    got = tokenfile.read_all(docs, index, parts).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    _, index, parts = tokenfile.token_files(no_docs, WORDS)
    assert tokenfile.read_all(docs, index, parts).count() == 0


def test_word_cache_equals_library():
    from tokenizers import Tokenizer
    tok, spec = Tokenizer.from_file(WORDS), open(WORDS, encoding="utf-8").read()
    c, rnd = tokenfile.WordCache(spec, "<u2"), random.Random(2)
    units = ["a", "Th", "ER", " ", "\n", "\t", "é", "É", "ß", "İ", "Σ", "中", "🙂", "12", "'s", ".", ",", "\xa0", "<|endoftext|>", "́"]
    assert c.direct
    for _ in range(1500):
        text = "".join(rnd.choice(units) for _ in range(rnd.randint(0, 25)))
        assert np.frombuffer(c.encode(text), "<u2").tolist() == tok.encode(text, add_special_tokens=False).ids


def test_strings_of_added_tokens_are_those_tokens(spark):
    from tokenizers import Tokenizer
    tok, texts = Tokenizer.from_file(WORDS), ["hello <|endoftext|> world", "<|startoftext|>a<|endoftext|>", "<|ENDOFTEXT|> b"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    _, index, parts = tokenfile.token_files(df, WORDS)
    got = {r["doc_id"]: r["ids_crc32"] for r in tokenfile.read_all(df, index, parts).collect()}
    for i, text in enumerate(texts):
        ids = tok.encode(text, add_special_tokens=False).ids + [1]
        assert got[i] == zlib.crc32(np.array(ids, "<u4").tobytes())
    assert 49407 in tok.encode(texts[0], add_special_tokens=False).ids


def test_texts_without_letters_have_no_language(spark):
    import unicodedata
    for c in map(chr, range(0x30000)):
        if not 0xD800 <= ord(c) < 0xE000:
            letters = [x for x in c.lower() if unicodedata.category(x).startswith("L")]
            assert "".join(language.normalise(c).split()) == "".join(letters), c
    model = language.fit(spark.createDataFrame([(i, "the house and the garden " * 4, "en") for i in range(9)], "doc_id long, text string, lang string"))
    rows = [(1, "½ ²"), (2, "①"), (3, "Ⅷ"), (4, "² garden"), (5, "__ 12")]
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert got == {1: "und", 2: "und", 3: "und", 4: "en", 5: "und"}


def _plain_scan(text):
    import re
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    spots = sorted(i for _, p in licenses.BASE for i in range(len(words)) if words[i:i + len(p.split())] == p.split())
    return len(words), len(spots), spots[0] if spots else None, spots[-1] if spots else None


def test_license_places_and_labels(docs, no_docs, monkeypatch):
    monkeypatch.setattr(licenses, "BLOCK", 64)
    scan = licenses.Scanner(licenses.BASE, licenses.TEMPLATES).scan
    rnd = random.Random(1)
    units = "gnu general public license apache cc by mit licensed under the 2 0 version or later nc 4 é".split()
    for _ in range(500):
        text = rnd.choice(["\n", " ", "-"]).join(rnd.choice(units) for _ in range(rnd.randint(0, 60)))
        assert scan(text)[:4] == _plain_scan(text)
    assert scan("Licensed under the Apache License, Version 2.0.")[5] == "apache,apache-2.0"
    assert "gpl-3.0" in scan("licensed under the GNU General Public License, version 3 or any later version")[5]
    assert scan("licensed under the apache LICENSE version two")[5] == "apache"
    assert scan("licensed under CC BY-NC 4.0")[5:] == ("cc-by,cc-by-nc-4.0", 1.0)
    got = {(r["doc_id"], r["n_words"], r["labels"], r["score"]) for r in licenses.scan_licenses(docs).collect() if r["doc_id"] in (3, 4)}
    assert got == {(3, 0, "", 0.0), (4, 0, "", 0.0)}
    assert licenses.scan_licenses(no_docs).count() == 0


def test_template_markup():
    m = licenses.TokenAutomaton(["a <<optional>>b <<var max=2>><<end>> c"])
    assert [bool(m.accepts(t)) for t in ("a c", "a b c", "a b x y c", "a b x y z c", "a x c", "", "a c c")] == [True, True, True, False, False, False, False]
    with pytest.raises(ValueError):
        licenses.parse_template("<<optional>>a")


def _repeat_words(words):
    at = {}
    for i in range(len(words) - 2):
        at.setdefault(tuple(words[i:i + 3]), []).append(i)
    return len({p + k for s in at.values() if len(s) > 1 for p in s for k in range(3)})


def test_quality_metrics(docs, no_docs, spark):
    import re
    rnd = random.Random(3)
    texts = [" ".join(rnd.choice("abc") for _ in range(rnd.randint(0, 40))) + rnd.choice(["", "\na\n \na"]) for _ in range(200)]
    made = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in quality.score_quality(made).collect():
        t = texts[r["doc_id"]]
        words, lines = re.findall(r"[^\x20\x09-\x0D]+", t), [x for x in t.split("\n") if x.strip()]
        assert (r["n_words"], r["n_repeat_words"], r["n_dup_lines"]) == (len(words), _repeat_words(words), len(lines) - len(set(lines)))
    kept = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in quality.score_quality(docs).collect()}
    assert kept[3] == kept[4] == kept[5] == (True, False)
    assert quality.keep_good(docs).columns == docs.columns and quality.keep_good(no_docs).count() == 0


def test_clean_short_documents_keep_a_repeated_line(spark):
    sf = "/root/testdata/sf0.1"
    good = [r["doc_id"] for r in spark.read.parquet(f"{sf}/labels.parquet").filter("quality = 1 and doc_id in (30, 962)").collect()]
    rows = spark.read.parquet(f"{sf}/documents.parquet").filter(f"doc_id in ({','.join(map(str, good))})")
    got = [(r["n_dup_lines"] / r["n_lines"] > 0.3, r["kept"]) for r in quality.score_quality(rows).collect()]
    assert len(good) == 2 and got == [(True, True)] * 2
    line, rest = " ".join(f"longish{i:07}" for i in range(14)), " ".join(f"of {i}" for i in range(10, 40))
    weighed = spark.createDataFrame([(1, f"{line}\n{line}\n{rest}", "en")], "doc_id long, text string, lang string")
    made = quality.score_quality(weighed).first()
    assert (made["n_dup_chars"], made["n_line_chars"]) == (len(line), 2 * len(line) + len(rest))
    assert (made["base_failed"], made["kept"]) == (False, False)


def test_languages_without_stop_words_are_kept(spark):
    text = " ".join(f"слово{i} город{i} река{i}" for i in range(30))
    rows = [(1, text, "ru"), (2, text, None), (3, text, "en"), (4, text, "EN-gb"), (5, "# " * 60 + text, "ru")]
    made = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r["doc_id"]: r["kept"] for r in quality.score_quality(made).collect()} == {1: True, 2: True, 3: False, 4: False, 5: False}
    assert {r["doc_id"] for r in quality.keep_good(made).collect()} == {1, 2}
    assert quality.score_quality(made.drop("lang")).filter("kept").count() == 4


def test_long_texts_take_the_unpacked_path(docs, monkeypatch):
    short = {r["doc_id"]: r["n_repeat_words"] for r in quality.score_quality(docs).collect()}
    monkeypatch.setattr(quality, "_INDEX_BITS", 4)
    assert {r["doc_id"]: r["n_repeat_words"] for r in quality.score_quality(docs).collect()} == short


def test_language(docs, no_docs, spark, sf_small):
    table = spark.read.parquet(f"{sf_small}/documents.parquet")
    model = language.fit(table)
    rows = language.identify(table, model).join(table.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.9 * len(rows) > 0
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(docs, model).collect()}
    assert got[3] == got[4] == got[8] == "und" and got[5] == "en"
    assert language.fit(no_docs) == "{}" and {r["lang_pred"] for r in language.identify(docs, "{}").collect()} == {"und"}
    assert language.keep_identified(docs, model).columns == docs.columns


def test_phrases_are_longest_matches():
    text, rnd = "abracadabra alakazam", random.Random(5)
    auto = language.SuffixAutomaton(text)
    for _ in range(300):
        line = "".join(rnd.choice("abrcdlkzm x") for _ in range(rnd.randint(0, 30)))
        n, at = 0, 0
        while at < len(line):
            end = at + 1
            while end < len(line) and line[at:end + 1] in text:
                end += 1
            n, at = n + 1, end
        assert auto.phrases(line) == n
