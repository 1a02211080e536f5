"""Whitening, suffix-array deduplication and the Merkle manifest against plain versions."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from panelcast.llm import merkle, repeats, whitening


# ------------------------------------------------------------------ whitening

def spectrum(values, seed=0):
    n = len(values)
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(n, n)))
    q = q.astype(np.longdouble)
    for _ in range(3):
        q = q @ (1.5 * np.eye(n) - 0.5 * q.T @ q)
    return (q * np.array(values, np.longdouble)) @ q.T


@pytest.mark.parametrize("values", [
    list(np.linspace(1, 2, 40)), [1.0] * 12, [0, 0, 0, 1, 2], [1, 1e-4, 1e-8, 1e-10, 1e-12, 1e-13, 1e-13],
    [1, 1 + 1e-9, 1 + 2e-9, 2, 3, 3, 3 + 1e-12, 5, 9, 14], list(1 + 1e-8 * np.arange(15)) + list(2 + 1e-5 * np.arange(15))])
def test_refined_eigenvectors_hold_beyond_double_precision(values):
    a = spectrum(values)
    lam, x = whitening.eigen(a)
    size = np.abs(a).max()
    assert np.abs(lam - np.sort(np.array(values, np.longdouble))[::-1]).max() < 1e-16 * max(1, max(values))
    assert np.abs(a @ x - x * lam).max() < 1e-17 * size * len(a)
    assert np.abs(x.T @ x - np.eye(len(a))).max() < 1e-17


def test_clustered_eigenvalues_are_told_apart_by_sub_solves():
    values = [1, 1 + 1e-11, 1 + 2e-11, 4, 4 + 1e-10, 7]
    a = spectrum(values, 3)
    start = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    lam, x = whitening.refine(a, start)
    assert np.abs(a @ x - x * lam).max() < 1e-17
    split = whitening.clusters(np.array([1, 1 + 1e-11, 4.0]), 1e-9)
    assert [len(g) for g in split] == [2, 1]


def test_whitened_vectors_equal_a_plain_version(spark):
    rng = np.random.default_rng(4)
    v = (rng.normal(size=(300, 20)) * np.linspace(0.2, 3, 20)).astype(np.float32)
    rows = [(i, [float(c) for c in r]) for i, r in enumerate(v)] + [(999, [float(c) for c in v[7]])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).toPandas()
    x = np.floor(64 * v.astype(float)).astype(np.int64) + whitening.SHIFT
    u = np.unique(x, axis=0)
    n, s = len(u), u.sum(0)
    cov = (u - s / n).T @ (u - s / n) / n
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1][:16], q[:, ::-1][:, :16]
    want = (x - s / n) @ q / np.sqrt(e)
    have = got[got.vec_id < 999].pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert np.abs(have * np.sign((have * want).sum(0)) - want).max() < 1e-8
    assert np.allclose(have[7], got[got.vec_id == 999].sort_values("component").whitened)
    assert set(got.n) == {n} and got.identity_error.max() < 1e-9 and len(got) == 301 * 16
    for i, d in got[got.component == 1][["vec_id", "deviation"]].itertuples(index=False):
        assert d == sum(int(n * c - t) ** 2 for c, t in zip(x[i if i < 999 else 7].tolist(), s.tolist()))
    assert np.allclose(got.sort_values(["vec_id", "component"]).explained[:16], e / np.trace(cov), rtol=1e-9)


def test_vectors_with_nulls_other_lengths_and_no_spread(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 1.0]), (2, None), (3, [nan, 1.0]), (4, [inf, 0.0]), (5, [None, 1.0]), (6, [0.25, -1.0]),
            (6, [0.25, -1.0]), (None, [1.5, 2.0]), (7, []), (8, [1.0]), (9, [2.0]), (10, [1e30, 0.0])]
    df = spark.createDataFrame([(*r, 0, 0.0) for r in rows], "vec_id long, embedding array<float>, n long, whitened double")
    got = whitening.whiten(df).collect()
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, []).append(r)
    assert set(by_id) == {1, 6, None, 8, 9} and len(by_id[6]) == 4 and len(by_id[8]) == 1
    assert {r.n for r in by_id[1]} == {3} and {r.n for r in by_id[9]} == {2}
    assert whitening.whiten(df.limit(0)).count() == 0
    assert whitening.whiten(df.filter("vec_id in (1, 2)")).count() == 0      # one vector has no spread


def test_deviation_beyond_a_long_is_null_and_kept_exact(spark):
    rows = [(1, [3e9, 1.0]), (2, [0.0, 0.0]), (3, [1.0, 5.0])]
    got = {r.vec_id: r for r in whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    x = [[int(64 * c) + whitening.SHIFT for c in v] for _, v in rows]
    s = [sum(c) for c in zip(*x)]
    assert got[1].deviation is None and int(got[1].deviation_exact) == sum((3 * c - t) ** 2 for c, t in zip(x[0], s))


# ------------------------------------------------------------------ suffix sorting

def plain_removal(rows, length):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    seen, out = set(), []
    for i in order:
        b = (rows[i][1] or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            s = b[p:p + length]
            if s in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(s)
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((rows[i][0], len(b), sum(gone), sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1])), kept))
    return sorted(out, key=str)


def removal(df, **options):
    return sorted([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in repeats.remove_repeats(df, **options).collect()], key=str)


def test_repeated_starts_equal_a_plain_search():
    rng = random.Random(5)
    for _ in range(150):
        length = rng.choice([3, 5, 8, 11])
        segs = [bytes(rng.choice(b"\0ab\xff") for _ in range(length + rng.randrange(0, 30))) for _ in range(rng.randrange(1, 8))]
        owner, first = np.array(rng.sample(range(100), len(segs))), np.array([rng.randrange(50) for _ in segs])
        s, p = repeats.repeated_starts(np.frombuffer(b"".join(segs), np.uint8), np.cumsum([len(x) for x in segs]), owner, first, length)
        places = [(owner[i], first[i] + j, x[j:j + length], i) for i, x in enumerate(segs) for j in range(len(x) - length + 1)]
        least = {}
        for o, q, x, _ in places:
            least[x] = min(least.get(x, (999, 0)), (o, q))
        assert set(zip(s.tolist(), p.tolist())) == {(i, q) for o, q, x, i in places if (o, q) > least[x]}


def test_suffix_order_is_lexicographic_and_prefixes_are_measured():
    t = np.frombuffer(b"mississippi\xff\0mississippi", np.uint8)
    ends, starts = np.array([len(t)]), np.ones(len(t), bool)
    order = repeats.suffix_order(t, ends, starts, 40)
    whole = bytes(t)
    assert [whole[i:] for i in order] == sorted(whole[i:] for i in range(len(whole)))
    shared = repeats.common_prefixes(t, order, 7).tolist()
    for k in range(1, len(order)):
        a, b = whole[order[k - 1]:], whole[order[k]:]
        want = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert shared[k] == min(7, want) or order[k - 1] + 7 > len(whole) or order[k] + 7 > len(whole)


def test_equal_strings_meet_under_one_key():
    rng = random.Random(2)
    passage = bytes(rng.randrange(256) for _ in range(400))
    texts = [bytes(rng.randrange(256) for _ in range(rng.randrange(300))) + passage + bytes(rng.randrange(256) for _ in range(90)) for _ in range(2)]
    at = []
    for text in texts:
        key, first, n = repeats.runs_of(np.frombuffer(text, np.uint8), 100)
        assert n.sum() == len(text) - 99 and (np.diff(first) == n[:-1]).all()
        begin = text.index(passage)
        at.append(np.repeat(key, n)[begin:begin + 301].tolist())
    assert at[0] == at[1]


def test_removal_equals_a_plain_version(spark):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcé") for _ in range(rng.randrange(1, 9))) for _ in range(12)]

    def text():
        k = rng.randrange(6)
        if k < 3:
            return [None, "a" * rng.randrange(0, 400), "ab\0" * rng.randrange(0, 100)][k]
        return " ".join(rng.choice(words) for _ in range(rng.randrange(0, 200)))

    base = [text() for _ in range(50)]
    rows = [(i, rng.choice(base)) for i in range(100)] + [(None, base[3])] * 2 + [(200, base[5])] * 2
    df = spark.createDataFrame([(*r, 1, b"x") for r in rows], "doc_id long, text string, at long, kept binary")
    assert removal(df) == plain_removal(rows, 100)
    assert removal(df, length=20) == plain_removal(rows, 20)
    assert removal(df, length=20, hot=2) == plain_removal(rows, 20)     # every busy key dealt by its strings
    assert removal(df.limit(0)) == []


def test_very_long_text_is_taken_whole(spark):
    rng = random.Random(1)
    tail = "".join(rng.choice("xyz ") for _ in range(150))
    long = "q" * (repeats.CHUNK + 500) + tail
    got = removal(spark.createDataFrame([(1, long), (2, tail), (3, "short")], "doc_id long, text string"))
    assert [(r[0], r[1], r[2], r[3]) for r in got] == [(1, len(long), repeats.CHUNK + 499, 1), (2, 150, 150, 1), (3, 5, 0, 0)]


def test_given_documents_equal_a_plain_version(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    assert removal(df) == plain_removal(rows, 100)


# ------------------------------------------------------------------ manifest

def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_manifest(rows):
    def part(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([H(*levels[-1][k:k + 16]) for k in range(0, len(levels[-1]), 16)])
        return levels

    def path(levels, k):
        for level in levels[:-1]:
            yield k % 16, level[k // 16 * 16:k // 16 * 16 + 16]
            k //= 16

    by = {}
    for r in rows:
        by.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, H(*map(part, r)), r))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(by[s], key=lambda x: x[:3])]) for s in order}
    top = tree([trees[s][-1][0] for s in order])
    out = []
    for place, s in enumerate(order):
        for k, (_, _, leaf, r) in enumerate(sorted(by[s], key=lambda x: x[:3])):
            steps = [*path(trees[s], k), *path(top, place)]
            node = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                node = H(*map(part, (*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]))))
            for p, run in steps:
                node = H(*run[:p], node, *run[p + 1:])
            out.append((r[0], leaf, trees[s][-1][0], top[-1][0], H(*("".join(run[:p] + run[p + 1:]) for p, run in steps)), node, node == top[-1][0]))
    return sorted(out, key=str)


def manifest(df):
    return sorted([tuple(r)[:7] for r in merkle.manifest(df).collect()], key=str)


@pytest.mark.parametrize("n", [0, 1, 2, 17, 300, 4500])
def test_manifest_equals_a_plain_version(spark, n):
    rng = random.Random(n)
    sources = [None, "", "a", "é", "z"] if n < 1000 else ["a"] * 40 + [f"s{i}" for i in range(20)]
    rows = [(rng.choice([None, i, i // 2]), rng.choice(sources), rng.choice([None, "", "en"]), rng.choice([None, 3]),
             rng.choice([None, "", "Abc", "x"])) for i in range(n)]
    df = spark.createDataFrame([(*r, "t", 5) for r in rows],
                               "doc_id long, source string, lang string, n_chars long, text string, tree string, pos long")
    assert manifest(df) == (plain_manifest(rows) if rows else [])


def test_full_block_and_one_more(spark):
    for n in (merkle.BLOCK, merkle.BLOCK + 1):
        rows = [(i, "s", "en", i, f"T{i}") for i in range(n)]
        df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
        assert manifest(df) == plain_manifest(rows)


def test_sweeps_of_one_block():
    level = [H(str(i)) for i in range(40)]
    rows = merkle.forward(level, None)
    assert [len(r) for r in rows] == [40, 3, 1]
    assert [len(r) for r in merkle.forward(level[:1], 3)] == [1, 1, 1, 1]
    for i, proof in enumerate(merkle.backward(rows, b"")):
        assert merkle.fold(level[i], proof) == rows[-1][0] and merkle.fold(H("x"), proof) != rows[-1][0]


def test_given_documents_have_the_plain_manifest(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [tuple(r) for r in df.select(*merkle.FIELDS).collect()]
    assert manifest(df) == plain_manifest(rows)
