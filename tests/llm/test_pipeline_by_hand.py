"""The corpus pipeline and its classifier against plain Python, whole row sets, on the smallest
tables and rows made to meet every stage's rule."""

import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import regex
import xxhash

from snapflow.llm import line_rules, pairwise_quality, tokens

SF = "/root/testdata/sf0.001"
_SPACES = " \t\n\x0b\x0c\r"


def words_of(text):
    return [w.decode() for w in text.encode().split()]


# ---------------------------------------------------------------- plain versions of the stages

_LETTER = r"[\p{L}\p{M}\p{N}]"
_PHRASES = regex.compile("|".join(
    rf"(?<!{_LETTER}){regex.escape(p)}" + (rf"(?!{_LETTER})" if p[-1].isalnum() else "") for p in line_rules.BOILERPLATE))


def line_stays(line):
    words = words_of(line)
    if not words:
        return True
    n = len(words)
    closed = words[-1][-1] in line_rules.TERMINAL or (n >= 10 and any(w[-1] in ".!?…" for w in words))
    menu = 100 * sum(c in "#*$%&|<>" for c in line) > 30 * n
    shouts = 100 * sum("!!" in w for w in words) > 30 * n
    phrase_words = sum(len(hit.split(" ")) for hit in _PHRASES.findall(line.lower()))
    furniture = phrase_words > 0 and (n < 20 or 100 * phrase_words > 30 * n)
    return closed and not menu and not shouts and not furniture


def rules_stage(text):
    """The cleaned text, None if the document goes."""
    text = text or ""
    words = words_of(text)
    places = {}
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {i + j for at in places.values() if len(at) > 1 for i in at for j in range(8)}
    if len(words) < 20 or 100 * len(covered) > 30 * len(words):
        return None
    left = [ln for ln in text.split("\n") if line_stays(ln)]
    if 100 * sum(len(w) for ln in left for w in words_of(ln)) < 50 * sum(map(len, words)):
        return None
    return "\n".join(left)


def plain_features(text):
    words, lines = words_of(text), [ln.strip(_SPACES) for ln in text.split("\n") if ln.strip(_SPACES)]
    raw, n, m = text.encode(), max(1, len(words)), max(1, len(lines))
    size, letters = max(1, len(raw)), [c for c in text if c in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"]
    pairs = list(zip(words, words[1:]))
    return [
        math.log1p(len(words)), sum(len(w.encode()) for w in words) / n,
        sum(c.isupper() for c in letters) / max(1, len(letters)), sum(c in "0123456789" for c in text) / size,
        sum(b > 127 for b in raw) / size, text.count("!") / n, text.count("|") / n,
        sum(c in "#*$%&<>" for c in text) / n, (text.count(".") + text.count(",")) / n,
        (text.count('"') + text.count("'")) / n, len(set(words)) / n, len(set(pairs)) / max(1, len(words) - 1),
        sum(a == b for a, b in pairs) / n, math.log1p(len(lines)), sum(ln[-1] in ".!?\"'" for ln in lines) / m,
        len(set(lines)) / m, len(words) / m, sum("A" <= w[0] <= "Z" for w in words) / n,
    ]


def plain_score(model, text):
    raw = sum(float(w) for x, cuts, ws in zip(plain_features(text), model.cuts, model.weights.reshape(model.cuts.shape))
              for cut, w in zip(cuts, ws) if x >= cut)
    return 1 / (1 + math.exp(-((raw - model.threshold) / model.scale + math.log(0.3 / 0.7))))


def dedup_stage(docs):
    keys = {i: [ln.strip(_SPACES).encode().lower().decode() for ln in t.split("\n")] for i, t in docs.items()}
    holders = {}
    for i, ks in keys.items():
        for k in ks:
            holders.setdefault(k, set()).add(i)
    return {i: "\n".join(ln for ln, k in zip(t.split("\n"), keys[i])
                         if len(k) < 40 or len(holders[k]) < 5 or max(holders[k]) == i) for i, t in docs.items()}


def fingerprint(text):
    w = words_of(text.encode().lower().decode())
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def copies_stage(docs):
    """The documents of least id of every component of fingerprints at four bits or fewer."""
    ids = sorted(docs)
    fp = {i: fingerprint(docs[i]) for i in ids}
    root = {i: i for i in ids}
    for i in ids:
        for j in ids:
            if j < i and root[i] != root[j] and (fp[i] ^ fp[j]).bit_count() <= 4:
                a, b = sorted((root[i], root[j]))
                root = {k: a if r == b else r for k, r in root.items()}
    return {i: docs[i] for i in ids if root[i] == i}


def pieces_stage(docs):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokens.default_vocabulary())
    want = {}
    for i, text in docs.items():
        ids = np.array(t.encode(text, add_special_tokens=False).ids + [0], "<u4")
        for p, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at:at + 2048]
            want[i, p] = (at, len(part), zlib.crc32(part.tobytes()))
    return want


# ---------------------------------------------------------------- the tests

@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """The smallest documents and, behind them, rows for every stage."""
    docs = pq.read_table(f"{SF}/documents.parquet")
    labels = pq.read_table(f"{SF}/labels.parquet")
    good = set(labels.filter(pa.compute.equal(labels["quality"], 1))["doc_id"].to_pylist())
    prose = [t for i, t in zip(docs["doc_id"].to_pylist(), docs["text"].to_pylist())
             if i in good and t and len(words_of(t)) > 60 and rules_stage(t)]
    rng = random.Random(3)
    shared = "This passage of more than forty characters stands in many of the documents."
    extra = [None, "", " \n\t ", "Too short.", "BUY!! NOW!! CHEAP!! " * 9, "Sign in. Read more. Click here. " * 9]
    extra += [prose[0], prose[0], prose[0].upper(), f"{prose[1]} Tail."]                    # copies and near copies
    extra += [f"{t}\n{rng.choice(['', '  '])}{shared}" for t in prose[2:9]]                 # a line of seven documents
    extra += [f"{t}\nhome | about | contact | help\n\nPlease sign in." for t in prose[9:12]]   # furniture
    extra += ["\n".join(prose[12:40])]                                                      # longer than a sequence
    first = max(docs["doc_id"].to_pylist()) + 1
    rows = docs.select(["doc_id", "text", "lang", "source", "n_chars"]).to_pylist()
    rows += [{"doc_id": first + k, "text": t, "lang": "en", "source": "made", "n_chars": None if t is None else len(t)}
             for k, t in enumerate(extra)]
    at = tmp_path_factory.mktemp("sf")
    pq.write_table(pa.Table.from_pylist(rows, docs.schema), at / "documents.parquet")
    pq.write_table(labels, at / "labels.parquet")
    return str(at), {r["doc_id"]: r["text"] for r in rows}, first


def test_pipeline_equals_plain_python(spark, folder):
    import corpus_pipeline as cp
    sf_dir, texts, first = folder
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(5)
    model = pairwise_quality.train(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))

    def step(stage, want, docs):
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns
        rows = out.collect()
        assert {r["doc_id"]: r["text"] for r in rows} == want and len(rows) == len(want)
        assert all(r["n_chars"] == len(r["text"]) for r in rows)
        return spark.createDataFrame(rows, docs.schema).repartition(3)

    want = {i: kept for i, t in texts.items() if (kept := rules_stage(t)) is not None}
    assert 100 < len(want) < len(texts) and any(want[i] != texts[i] for i in want)
    docs = step(cp.quality_rules, want, docs)

    scores = {i: plain_score(model, t) for i, t in want.items()}
    close = [i for i, s in scores.items() if abs(s - 0.3) < 1e-5]       # single precision decides these
    ours = {r["doc_id"]: r for r in pairwise_quality.scored(docs, model).collect()}
    assert all(ours[i]["score"] == pytest.approx(s, abs=1e-4) for i, s in scores.items()) and len(close) <= 2
    want = {i: t for i, t in want.items() if (ours[i]["predicted"] == 1 if i in close else scores[i] >= 0.3)}
    assert len(want) > 80
    docs = step(cp.quality_classifier, want, docs)

    before, want = want, dedup_stage(want)
    assert sum(want[i] != before[i] for i in want) >= 4
    docs = step(cp.repeated_lines, want, docs)

    before, want = want, copies_stage(want)
    assert len(before) - len(want) >= 3
    docs = step(cp.near_duplicates, want, docs)

    whole = cp.run(spark, sf_dir).collect()
    for rows in (cp.packing(spark, docs, sf_dir).collect(), whole):
        assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == pieces_stage(want)
        full = {}
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert full.get(r["sequence_id"], 0) == r["offset"]
            full[r["sequence_id"]] = r["offset"] + r["length"]
        assert max(full.values()) <= 2048 and len(full) <= -(-sum(full.values()) // 2048) + 2


def test_features_equal_plain_python(folder):
    odd = ["", " \n ", "x", "é É ß 日本 。", "A b A b\n\n\tA b\r\n", "!!|#*$%&<>.,'\" 0123456789", "\x1c a\x0bb\x0cc\x85d"]
    for text in odd + [t for t in folder[1].values() if t]:
        assert pairwise_quality.features(text.encode()) == pytest.approx(plain_features(text), abs=1e-12), text[:60]


def _loss(weights, differences, l2):
    return sum(math.log1p(math.exp(-float(d @ weights))) for d in differences) / len(differences) + l2 / 2 * float(weights @ weights)


def test_fit_minimises_the_pairwise_loss():
    """The loss over all pairs, by its definition: the fit comes near the minimum that plain gradient
    descent over all pairs finds, and no single weight can be moved to lower it by much."""
    rng = np.random.default_rng(2)
    good = np.arange(60) % 2 == 0
    x = rng.normal(size=(60, len(pairwise_quality.FEATURES))) + np.where(good, 0.6, 0.0)[:, None] * (np.arange(18) < 4)
    l2 = 0.01
    model = pairwise_quality.fit(x, good, bins=4, rounds=3000, l2=l2)
    cuts = np.array([[np.quantile(x[:, f], q / 4) for q in (1, 2, 3)] for f in range(x.shape[1])])
    assert np.allclose(model.cuts, cuts)
    f = np.array([[float(row[k] >= c) for k in range(x.shape[1]) for c in cuts[k]] for row in x])
    pairs = np.array([f[i] - f[j] for i in range(60) for j in range(60) if good[i] and not good[j]])
    w = np.zeros(f.shape[1])
    for _ in range(6000):
        slope = l2 * w - (pairs / (1 + np.exp(pairs @ w))[:, None]).mean(axis=0)
        w = w - 0.5 * slope
    least, fitted = _loss(w, pairs, l2), _loss(model.weights.astype(float), pairs, l2)
    assert np.abs(slope).max() < 1e-4 and least <= fitted + 1e-9 and fitted - least < 0.02 * least
    for k in range(0, len(w), 5):
        for by in (-0.3, 0.3):
            moved = model.weights.astype(float)
            moved[k] += by
            assert _loss(moved, pairs, l2) > fitted - 0.02 * least


def test_threshold_is_the_best_score_quantile():
    rng = np.random.default_rng(4)
    good = np.arange(90) % 3 > 0
    x = rng.normal(size=(90, len(pairwise_quality.FEATURES))) + np.where(good, 0.5, 0.0)[:, None]
    model = pairwise_quality.fit(x, good, rounds=60)
    raw = [float(v) for v in model.raw(x)]

    def right(level):
        return (sum(r >= level for r, g in zip(raw, good) if g) / sum(good)
                + sum(r < level for r, g in zip(raw, good) if not g) / sum(~good))

    ordered = sorted(raw)
    levels = []
    for k in range(401):                                   # quantiles by linear interpolation
        place = k / 400 * (len(raw) - 1)
        low = int(place)
        levels.append(ordered[low] + (place - low) * (ordered[min(low + 1, len(raw) - 1)] - ordered[low]))
    # a level that falls on a score may come out a rounding below or above it
    near = [right(level + e) for level in levels for e in (-1e-6, 0.0, 1e-6)]
    assert min(abs(level - model.threshold) for level in levels) < 1e-5
    assert max(right(model.threshold + e) for e in (-1e-6, 0.0, 1e-6)) == max(near)
    assert [bool(s >= 0.3) for s in model.scores(x)] == [r >= model.threshold for r in raw]
