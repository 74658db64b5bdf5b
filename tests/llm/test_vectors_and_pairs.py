"""Whitening, nearest neighbours and pair bitmaps against brute force."""

from collections import Counter
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapflow.llm import contour_whitening as cw, pair_bitmaps as pb, stable_search as ss

EXTRA = "vec_id long, embedding array<double>, component int, score double, cell int, h1 long, vector string, n long"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 0.5, 2, 3, "x", 4) for i, v in rows], EXTRA).repartition(4)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    spread = np.linspace(3, 0.2, 12)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((300, 12)) * spread)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)] + [rows[8], rows[8], (8, rows[9][1]), (None, rows[10][1]), (None, rows[11][1])]
    odd = [None, [], [1.0] * 11, [0.0] * 11 + [float("nan")], [None] + [1.0] * 11, [float("inf")] + [0.0] * 11, [0.0] * 12]
    return rows, [(2000 + 20 * i, v) for i, v in enumerate(odd)]


def whitened_by_hand(rows, k):
    x = np.floor(64 * np.array([v for _, v in rows])).astype(np.int64) + 1_000_000
    n, total = len(x), x.sum(axis=0)
    apart = n * x - total
    values, vectors = np.linalg.eigh(np.cov((apart / n).T, bias=True))
    order = np.argsort(-values)[:k]
    return n, (apart ** 2).sum(axis=1), (apart / n) @ vectors[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def test_whitening(spark, vectors):
    rows, odd = vectors
    usable = rows + odd[-1:]                                    # the zero vector counts here
    n, deviation, z, share = whitened_by_hand(usable, 12)
    out = cw.whitening_report(table(spark, rows + odd)).collect()
    assert len(out) == n * 12 and {r["n"] for r in out} == {n} and max(r["identity_error"] for r in out) < 1e-12
    got = {}
    for r in out:
        got.setdefault((r["vec_id"], r["deviation"]), {}).setdefault(r["component"], []).append((r["whitened"], r["explained"]))
    sign = None
    for (i, _), d, want in zip(usable, deviation.tolist(), z):
        mine = np.array([got[i, d][c][0][0] for c in range(1, 13)])
        sign = np.sign(mine * want) if sign is None else sign
        assert np.allclose(mine, sign * want, atol=1e-10)
    first = got[usable[0][0], int(deviation[0])]
    assert np.allclose([first[c][0][1] for c in range(1, 13)], share, rtol=1e-12)


def test_whitening_without_spread(spark):
    flat = [(i, [1.0, float(i % 3), float(2 * (i % 3))]) for i in range(9)]          # rank one
    out = cw.whitening_report(table(spark, flat)).collect()
    assert len(out) == 9 and {r["component"] for r in out} == {1} and abs(out[0]["explained"] - 1) < 1e-12
    assert cw.whitening_report(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    assert cw.whitening_report(table(spark, [(1, None)])).count() == 0
    huge = [(i, [i * 2.0 ** 34, -i * 2.0 ** 33 * (i % 2)]) for i in range(1, 60)]       # squares beyond a long
    got = {r["vec_id"]: r for r in cw.whitening_report(table(spark, huge)).filter("component = 1").collect()}
    x = [[int(64 * v[0]) + 1_000_000, int(64 * v[1]) + 1_000_000] for _, v in huge]
    total = [sum(c) for c in zip(*x)]
    for (i, _), row in zip(huge, x):
        exact = sum((len(x) * a - s) ** 2 for a, s in zip(row, total))
        assert int(got[i]["deviation_exact"]) == exact and got[i]["deviation"] == (exact if exact < 2 ** 63 else None)


def test_inertia_and_contours():
    rng = np.random.default_rng(1)
    q, _ = np.linalg.qr(rng.standard_normal((20, 20)))
    values = np.array([9, 9, 9, 8.999, 5, 4, 4, 1] + [0.5] * 10 + [0, 0])
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    for shift in (-1, 0.25, 0.75, 3, 4.5, 8.9995, 10):
        assert cw.count_above(a, shift) == (values > shift).sum()
    parts = cw.intervals(a, 18, 4)
    assert sum(x.count for x in parts) == 18
    found = [cw.contour_pairs(a, x.low, x.high, x.count) for x in parts]
    assert np.allclose(np.concatenate([e for e, _ in found]), values[:18], atol=1e-12)
    v = np.concatenate([u for _, u in found], axis=1)
    assert np.allclose(v.T @ v, np.eye(18), atol=1e-10)


def by_hand(rows, asked, k):
    rows = list(dict.fromkeys((i, tuple(v)) for i, v in rows))
    x = np.array([v for _, v in rows])
    out = {}
    for at, (i, v) in enumerate(rows):
        if i is not None and asked(i):
            scores = np.einsum("ij,j->i", x, x[at])
            others = sorted((j for j in range(len(rows)) if j != at),
                            key=lambda j: (-scores[j], rows[j][0] is None, rows[j][0] or 0))[:k]
            out.setdefault(i, []).append([(rows[j][0], scores[j]) for j in others])
    return out


def test_search(spark, vectors):
    rows, odd = vectors
    sure = ss.SearchPlan(dims=4, sure=1 - 1e-12, cell_rows=64, query_rows=16, leaf_rows=16)
    for k, plan in ((20, sure), (500, sure)):
        got = {}
        for r in ss.nearest(table(spark, rows + odd), F.col("vec_id") % 4 == 0, k, plan).orderBy("rank").collect():
            got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
        want = by_hand(rows, lambda i: i % 4 == 0, k)
        assert got.keys() == want.keys()
        for i, lists in want.items():
            if len(lists) == 1:
                assert [(a, b) for a, b, _ in got[i]] == [(n + 1, j) for n, (j, _) in enumerate(lists[0])], i
                assert np.allclose([s for _, _, s in got[i]], [s for _, s in lists[0]], rtol=1e-14, atol=1e-14)
            else:
                assert sorted(b if b is not None else -1 for _, b, _ in got[i]) == sorted(j if j is not None else -1 for x in lists for j, _ in x)
    none = table(spark, odd[:1])
    assert ss.nearest(none, F.lit(True), 3).count() == 0
    assert ss.nearest(table(spark, rows[:1]), F.lit(True), 3).count() == 0


def test_search_recall(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in docs.collect()]
    want = by_hand(rows, lambda i: i % 20 == 0, 20)
    got = {}
    for r in ss.nearest(docs, F.col("vec_id") % 20 == 0, 20).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert np.mean([len(got[i] & {j for j, _ in x[0]}) / 20 for i, x in want.items()]) >= 0.95
    assert abs(ss.chi_square(ss.chi_square_bound(0.9, 8), 8) - 0.9) < 1e-12 and abs(ss.chi_square_bound(0.95, 4) - 9.4877) < 1e-3


def tokens_by_hand():
    import sentencepiece
    from tokenizers import Tokenizer
    a_file, b_file = pb.default_vocabularies()
    a, b = Tokenizer.from_file(a_file), sentencepiece.SentencePieceProcessor(model_file=b_file)
    a.encode_special_tokens = True
    from tokenizers.pre_tokenizers import ByteLevel
    # bytes that stand for themselves, then the others in order
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    letters = {chr(n if n in own else next(rest)): n for n in range(256)}
    assert set(letters) == set(ByteLevel.alphabet())
    a_bytes = {i: bytes(letters[c] for c in t) if set(t) <= letters.keys() else t.encode() for t, i in a.get_vocab().items()}

    def b_bytes(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(text):
        if not text:
            return [], []
        x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        whole = (" " + text).encode()
        if b"".join(a_bytes[t] for t in x) != whole or b"".join(map(b_bytes, y)) != whole:
            return [], []
        return ([(t, len(a_bytes[t])) for t in x], [(t, len(b_bytes(t))) for t in y])
    return encode


def aligned_by_hand(rows):
    encode, counts, docs = tokens_by_hand(), Counter(), []
    for i, text in rows:
        a, b = encode(text)
        ends = [np.cumsum([0] + [n for _, n in x])[1:].tolist() for x in (a, b)]
        groups, links, at = [], [], [0, 0]
        for end in sorted(set(ends[0]) & set(ends[1])):
            to = [int(np.searchsorted(e, end)) + 1 for e in ends]
            groups.append("|".join(",".join(str(t) for t, _ in x[m:n]) for x, m, n in zip((a, b), at, to)))
            links.append((a[to[0] - 1][0], b[to[1] - 1][0]))
            at = to
        counts.update(links)
        docs.append((i, len(a), len(b), links, ";".join(groups)))
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    found = [(i, na, nb, len(ls), len(ls), sum(counts[x] == best[x[1]] for x in ls), sum(counts[x] for x in ls),
              hashlib.sha256(g.encode()).hexdigest() if na else "") for i, na, nb, ls, g in docs]
    pairs = {p: (sum(p in ls for _, _, _, ls, _ in docs), n, n == best[p[1]]) for p, n in counts.items()}
    return found, pairs, [g for *_, g in docs]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


@pytest.mark.parametrize("limits", [{}, {"container_docs": 100}, {"postings": 300}])
def test_pair_bitmaps(spark, limits):
    rng = random.Random(4)
    bits = ["a", "b", "the", " ", "  ", "\n", " \n", "\t", "é", "ñ", "▁", "日本", "<|endoftext|>", "</s>", "'s", "12", "345", "!!", " ",
            " ", "　", "\x00", "\r\n", "😀", ". ", ", "]
    texts = [None, "", " ", "  ", "\n", "a ", " a", "x" * 5000, "the cat. " * 3000, "▁", "a <|endoftext|> b"]
    texts += ["".join(rng.choice(bits) for _ in range(rng.randint(1, 30))) for _ in range(500)]
    rows = [(i if i % 7 else None, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], "doc_id long, text string, a int, low int, container long, n_a long").repartition(3)
    want, pairs, groups = aligned_by_hand(rows)
    found = pb.align(docs, keep_groups=True, **limits)
    out = found.scored()
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]
    assert order(map(tuple, out.drop("groups").collect())) == order(want)
    assert sorted(r["groups"] for r in out.collect()) == sorted(groups)
    assert {(r["a"], r["b"]): (r["documents"], r["count"], r["best"]) for r in found.pairs().collect()} == pairs
    assert pb.align(docs.limit(0)).scored().count() == 0


def test_dense_bitmaps():
    rng = np.random.default_rng(2)
    lists = [np.sort(rng.choice(1 << 16, n, replace=False)).astype(np.uint64) for n in (3, 5000, 1, 4095, 4096, 65536, 2)]
    names, bits = pb._compressed(np.concatenate([np.uint64(i * 3) << np.uint64(16) | x for i, x in enumerate(lists)]))
    assert names.tolist() == [3 * i for i in range(7)] and max(map(len, bits.to_pylist())) == 8192
    for column, part in ((bits, lists), (bits[2:6], lists[2:6])):
        which, row = pb.members(column)
        assert [np.sort(row[which == i]).tolist() for i in range(len(part))] == [x.tolist() for x in part]
