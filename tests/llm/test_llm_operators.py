"""Operators against brute force on small tables with nulls, empty and long texts, copies, repeated
rows and columns whose names clash with the operators' own."""

import hashlib
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from snapflow.llm import (bottom_k, covering_simhash, hilbert, host_words, line_dedup, line_rules,
                          pairwise_quality, residual_packing, suffix_pieces, token_matrix, tokens)

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, shard int, score double, "
          "fp long, v long, u long, line int, h long, bin long, th long")
_SPACES = " \t\n\x0b\x0c\r"


def words_of(text):
    return [w.decode() for w in (text or "").encode().split()]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    vocab = ["".join(rng.choice("abcdefgéñ") for _ in range(rng.randint(1, 8))) for _ in range(300)]

    def prose(n):
        return " ".join(rng.choice(vocab) for _ in range(n)).capitalize() + "."

    shared = prose(20)
    out = [None, "", "   \n\t ", "one", "Don't, 'S <|endoftext|> ¶ x\x00y 日本語。", "a b c d e f g h " * 40]
    out += [prose(rng.randint(3, 90)) for _ in range(30)]
    out += [f"{prose(12)}\n{shared.upper()}  \n{prose(9)}\n{shared}\n" for _ in range(7)]
    base = prose(400)
    out += [base, base, base + " tail.", base.replace(" ", "  ", 3)]
    out += ["MENU | home | about | " * 6, "BUY!! NOW!! CHEAP!! " * 9, "### *** $$$ %%% " * 10, prose(9000)]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", f"s{i % 3}", None if t is None else len(t), 1, 0.5, 7, 8, 9, 1, 2, 3, 4) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + [rows[8], (None, "a text without id " * 8, None, None, None, *rows[0][5:])], SCHEMA).repartition(5)


def rows_of(df, *keys):
    return sorted((r.asDict() for r in df.collect()), key=lambda r: tuple((r[k] is not None, r[k]) for k in keys or ("doc_id",)))


def in_order(docs):
    return [(r["doc_id"], r["text"] or "") for r in rows_of(docs.select("doc_id", "text"), "doc_id")]


def test_line_rules(docs):
    got = rows_of(line_rules.judge(docs))
    for (doc, text), r in zip(in_order(docs), got):
        w = words_of(text)
        win = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
        covered = {i + j for i, x in enumerate(win) if win.count(x) > 1 for j in range(8)} if len(w) < 2000 else set()
        full = [ln for ln in text.split("\n") if words_of(ln)]
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(full) - len(set(full)))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"]) == want, doc
        if len(w) < 2000:
            assert r["n_repeat_words"] == len(covered)
            assert r["base_failed"] == (len(w) < 20 or 100 * len(covered) > 30 * len(w))
        assert not (r["base_failed"] and r["kept"])
    kept = line_rules.keep_clean(docs)
    assert kept.columns == docs.columns
    assert not [r for r in kept.collect() if "MENU" in r["text"] or "!!" in r["text"] or "###" in r["text"]]


def test_line_dedup(docs):
    table = in_order(docs)
    keys = [[ln.strip(_SPACES).encode().lower().decode() for ln in t.split("\n")] for _, t in table]
    seen = {}
    for (doc, _), ks in zip(table, keys):
        for k in set(ks):
            seen.setdefault(k, set()).add(-1 if doc is None else doc)
    got = rows_of(line_dedup.line_report(docs))
    dropped = 0
    for (doc, text), ks, r in zip(table, keys, got):
        keep = [ln for ln, k in zip(text.split("\n"), ks)
                if not (len(k) >= 40 and len(seen[k]) >= 5 and max(seen[k]) != (-1 if doc is None else doc))]
        assert (r["n_lines"], r["kept_text"]) == (len(ks), "\n".join(keep)), doc
        dropped += r["n_dropped"]
    assert dropped == 12                                       # 7 documents, two lines each, one keeps them
    full = line_dedup.repeated_lines(docs, max_bits=1 << 16)   # a crowded filter changes nothing
    assert {(r["doc_id"], tuple(sorted(r["lines"]))) for r in full.collect()} == \
        {(r["doc_id"], tuple(sorted(r["lines"]))) for r in line_dedup.repeated_lines(docs).collect()}
    assert line_dedup.drop_repeated_lines(docs).columns == docs.columns


def test_line_dedup_counts_ids_as_its_sql_does(spark):
    """A line of three rows of one id and two of another is in two documents; of five ids in five."""
    import duckdb
    from snapflow.llm.queries import SQL
    line, other = "a line that is long enough to be counted as one " * 2, "another line that is long enough to be counted " * 2
    rows = [(1, f"{line}\nx{i}") for i in range(3)] + [(2, line), (2, f"y\n{line}")]
    rows += [(10 + i, f"{other}\nz{i}") for i in range(4)] + [(13, other), (None, f"{other}\nw"), (None, other), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = line_dedup.line_report(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    order = lambda rs: sorted(rs, key=lambda r: tuple((x is not None, x) for x in r))
    want = con.execute(f"SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM ({SQL['op1_line_dedup']})").fetchall()
    assert order(map(tuple, got.collect())) == order(want) and sum(r[2] for r in want) == 5


def _simhash(text):
    w = [x.decode() for x in text.encode().lower().split()]
    s = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _components(fps, ids, distance=4):
    group = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= distance and group[i] != group[j]:
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    least = {}
    for g, d in zip(group, ids):
        if d is not None:
            least[g] = min(least.get(g, d), d)
    return [least.get(g) for g in group]


def test_simhash(docs):
    table = in_order(docs)
    fps = [_simhash(t) for _, t in table]
    got = rows_of(covering_simhash.near_duplicates(docs))
    assert [r["fingerprint"] for r in got] == [f"{x:016x}" for x in fps]
    assert [r["component_id"] for r in got] == _components(fps, [d for d, _ in table])


@pytest.mark.parametrize("layout", ["small", "wide"])
def test_links_in_crowded_anchors(spark, layout):
    """Clouds of near fingerprints, cut into tiles of 16: every link is found, in both layouts."""
    rng = random.Random(3)
    fps = set()
    for _ in range(12):
        c = rng.getrandbits(64)
        fps.update(c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for _ in range(25))
    fps = sorted(fps)
    nodes = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    root = {r["u"]: r["v"] for r in covering_simhash.components(covering_simhash.linked(nodes, layout=layout, tile=16)).collect()}
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    assert [root.get(s, s) for s in signed] == _components(fps, signed)


def test_hilbert(docs):
    dims = [hilbert.Dimension("source"), hilbert.Dimension("lang"), hilbert.Dimension("n_chars", numeric=True)]
    got = hilbert.hilbert_shards(docs, dims, shards=6).collect()
    assert len(got) == docs.count()
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r)
    sizes = [len(v) for v in by.values()]
    assert len(by) == 6 and max(sizes) - min(sizes) <= 1
    assert all(sorted(r["slot"] for r in v) == list(range(len(v))) for v in by.values())
    order = sorted(got, key=lambda r: (r["shard"], r["slot"]))
    assert [r["curve_index"] for r in order] == sorted(r["curve_index"] for r in got)
    text = dict(in_order(docs))
    assert all(r["size"] == len(text[r["doc_id"]].encode()) + 8 and r["text_crc32"] == zlib.crc32(text[r["doc_id"]].encode()) for r in got)


def test_curve_index_equals_a_plain_walk(spark):
    """The column expression on random cells against the walk through the tables."""
    rng = random.Random(3)
    cells = [tuple(rng.randrange(32) for _ in range(3)) for _ in range(200)]
    place, after = hilbert.curve_tables(3)

    def index(cell):
        state = at = 0
        for level in reversed(range(5)):
            o = sum((c >> level & 1) << j for j, c in enumerate(cell))
            at, state = at * 8 + place[state * 8 + o], after[state * 8 + o]
        return at

    df = spark.createDataFrame(cells, "a int, b int, c int")
    got = df.select("a", "b", "c", hilbert.hilbert_index([F.col("a"), F.col("b"), F.col("c")], 5).alias("i")).collect()
    assert {(r["a"], r["b"], r["c"]): r["i"] for r in got} == {c: index(c) for c in cells}


def test_curve_steps_are_neighbours():
    import itertools
    for n, bits in ((2, 3), (3, 2), (4, 2)):
        place, after = hilbert.curve_tables(n)

        def index(cell):
            state = at = 0
            for level in reversed(range(bits)):
                o = sum((c >> level & 1) << j for j, c in enumerate(cell))
                at, state = at * (1 << n) + place[state * (1 << n) + o], after[state * (1 << n) + o]
            return at

        path = sorted(itertools.product(range(1 << bits), repeat=n), key=index)
        assert all(sum(abs(a - b) for a, b in zip(p, q)) == 1 for p, q in zip(path, path[1:]))


def test_bottom_k(docs, spark):
    d = docs.filter("doc_id is not null").dropDuplicates(["doc_id"])
    table = in_order(d)
    got = rows_of(bottom_k.edit_likeness(d))

    def shingles(t):
        w = words_of(t)
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())

    def likeness(a, b):
        return len(a & b) / len(a | b) if a | b else 1.0

    for i, ((_, t), r) in enumerate(zip(table, got)):
        nxt = table[(i + 1) % len(table)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(r["near_edited"] - likeness(shingles(t), shingles(edited))) < 0.25
        assert abs(r["near_next"] - likeness(shingles(t), shingles(nxt))) < 0.25
    parts = d.withColumn("sketch", bottom_k.sketch(F.col("text"))).withColumn("g", F.lit(1))
    whole = bottom_k.merged(parts, ["g"]).first()["sketch"]
    every = sorted({h for r in parts.collect() for h in r["sketch"]})
    assert whole == every[:bottom_k.K]


def test_bottom_k_estimates_and_odd_ids(spark):
    """Exact sketches, containment and distinct counts; null and repeated ids: every row has its successor."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(4000)]
    long_text = " ".join(rng.sample(words, 3000))
    rows = [(None, f"no id {i} " * 9) for i in range(40)] + [(5, f"same id {i} " * 9) for i in range(40)] + [(i, long_text if i == 7 else f"text {i} " * i) for i in range(12)]
    docs = spark.createDataFrame(rows + [rows[0]] * 6, "doc_id long, text string").repartition(4)
    got = bottom_k.edit_likeness(docs).collect()
    assert len(got) == len(rows) + 6
    table = sorted(((-2 ** 63 if r["doc_id"] is None else r["doc_id"], r["h"], r["text"]) for r in
                    docs.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()))
    want = []
    for i, (key, _, t) in enumerate(table):
        nxt, half = table[(i + 1) % len(table)][2], len(t) // 2
        want.append((key, len(t), hashlib.sha256((t[:len(t) - half] + nxt[:half]).encode()).hexdigest()))
    assert sorted((-2 ** 63 if r["doc_id"] is None else r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == sorted(want)
    big = next(r for r in got if r["n_chars"] == len(long_text))
    assert abs(big["distinct_shingles"] / 2996 - 1) < 0.3 and abs(big["contained_in_edited"] - 0.5) < 0.2
    pair = spark.createDataFrame([(" ".join(words[:1000]), " ".join(words[:500]))], "a string, b string")
    a, b = bottom_k.sketch(F.col("a")), bottom_k.sketch(F.col("b"))
    r = pair.select(bottom_k.containment(b, a), bottom_k.containment(a, b), bottom_k.distinct_shingles(a), a).first()
    assert r[0] > 0.85 and abs(r[1] - 0.5) < 0.2 and abs(r[2] / 996 - 1) < 0.3 and len(r[3]) == bottom_k.K


def _reference_ids(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokens.default_vocabulary())
    return [np.array(e.ids + [0], "<u4") for e in t.encode_batch(texts, add_special_tokens=False)]


def test_packing(docs):
    d = docs.filter("doc_id is not null").dropDuplicates(["doc_id"])
    table = in_order(d)
    want = {}
    for (doc, _), ids in zip(table, _reference_ids([t for _, t in table])):
        for p, at in enumerate(range(0, len(ids), 2048)):
            want[doc, p] = (at, len(ids[at:at + 2048]), zlib.crc32(ids[at:at + 2048].tobytes()))
    for limits in ({}, {"task_items": 9, "fan_in": 2}):
        got = residual_packing.pack_documents(d, **limits).collect()
        assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in got} == want
        seqs = {}
        for r in sorted(got, key=lambda r: r["offset"]):
            assert seqs.get(r["sequence_id"], 0) == r["offset"]
            seqs[r["sequence_id"]] = r["offset"] + r["length"]
        assert max(seqs.values()) <= 2048 and len(seqs) <= -(-sum(seqs.values()) // 2048) + 2
    seen = {}
    for r in token_matrix.packed_matrix(d, window_tokens=3000).collect():
        ids = np.frombuffer(r["input_ids"], "<u2").astype("<u4")
        assert len(ids) == 2048 and r["position_resets"] == r["cu_seqlens"][:-1] and r["cu_seqlens"][-1] == r["n_tokens"]
        for k, key in enumerate(zip(r["doc_ids"], r["pieces"])):
            seen[key] = zlib.crc32(ids[r["cu_seqlens"][k]:r["cu_seqlens"][k + 1]].tobytes())
    assert seen == {k: v[2] for k, v in want.items()}


def test_matrix_memory_is_bounded(monkeypatch):
    """Copies of a 1,200-token text never pair up in a row: a window is held all the same, not the partition."""
    import pyarrow as pa
    most, packed = [], token_matrix.best_fit_decreasing

    class Fake:
        cache = type("C", (), {"forget": staticmethod(lambda: None)})

        @staticmethod
        def encode_all(texts):
            return [np.arange(1199, dtype="<u4").tobytes() for _ in texts]

    monkeypatch.setattr(token_matrix, "loaded", lambda data: Fake)
    monkeypatch.setattr(token_matrix, "best_fit_decreasing", lambda sizes, cap: most.append(sum(sizes)) or packed(sizes, cap))
    monkeypatch.setattr(token_matrix, "TaskContext", type("T", (), {"get": staticmethod(lambda: type("P", (), {"partitionId": staticmethod(lambda: 0)}))}))
    run = token_matrix._rows(type("V", (), {"value": b""}), 2048, 60_000, 2027, "<u2")
    batch = pa.RecordBatch.from_arrays([pa.array(range(1500)), pa.array(["x"] * 1500)], names=["doc_id", "text"])
    rows = [r for b in run([batch]) for r in b.column("doc_ids").to_pylist()]
    assert sorted(i for r in rows for i in r) == list(range(1500))
    assert max(most) <= 60_000 + 1200 and len(most) <= 1500 * 1200 // 30_000 + 2


def test_room_tree_equals_scan():
    rng = random.Random(1)
    tree, rooms = token_matrix.RoomTree(50), []
    for _ in range(400):
        size = rng.randint(0, 50)
        assert tree.least(size) == min((r for r in rooms if r >= size), default=None)
        if rooms and rng.random() < 0.4:
            tree.add(rooms.pop(rng.randrange(len(rooms))), -1)
        else:
            rooms.append(rng.randint(0, 50))
            tree.add(rooms[-1], 1)


def test_suffix_pieces_equal_the_library(docs, texts):
    import sentencepiece
    data = open(suffix_pieces.default_model(), "rb").read()
    sp, encoder, rng = sentencepiece.SentencePieceProcessor(model_proto=data), suffix_pieces.Encoder(data, 2000), random.Random(2)
    letters = "abcdefghinorstu      \n.,éñßABC▁😀"
    mixed = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 50))) for _ in range(600)]
    mixed += [t or "" for t in texts] + ["  a  b ", "\n", " \n a\n", "a ", " ", "x" * 700]
    for t, ids in zip(mixed, encoder.encode_all([t.encode() for t in mixed])):
        assert np.frombuffer(ids, "<u4").tolist() == sp.encode(t), t
        assert encoder.decode(ids).decode() == sp.decode(sp.encode(t))
    run = "".join(rng.choice("abcdeéñß日本xyzqu😀") for _ in range(30_000))           # one segment, windows of 2,000
    assert np.frombuffer(encoder.encode_all([run.encode()])[0], "<u4").tolist() == sp.encode(run)
    got = rows_of(suffix_pieces.encoded(docs))
    assert all(r["round_trip"] for r in got) and len(got) == docs.count()


def test_pairwise_quality(spark):
    base = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    model = pairwise_quality.train(docs, labels)
    seen = pairwise_quality.scored(docs, model).join(labels, "doc_id").filter("held_out").collect()
    good, bad = ([r["score"] for r in seen if r["quality"] == q] for q in (1, 0))
    assert np.mean([[g > b for b in bad] for g in good]) > 0.97
    assert np.mean([r["predicted"] == r["quality"] for r in seen]) > 0.95
    odd = spark.createDataFrame([(None, None), (1, ""), (1, "x " * 50000)], "doc_id long, text string")
    assert all(0 <= r["score"] <= 1 for r in pairwise_quality.scored(odd, model).collect())
    same = docs.join(labels.filter("quality = 1"), "doc_id").limit(1).select(docs["doc_id"], docs["text"])
    many = docs.select("doc_id", "text").unionByName(same.join(spark.range(500)).drop("id"))
    again = pairwise_quality.train(many, labels)               # a labelled id on 501 rows is one example
    assert np.array_equal(again.weights, model.weights) and again.threshold == model.threshold
    none = pairwise_quality.train(docs, labels.limit(0))
    assert all(r["score"] == pytest.approx(0.3, abs=1e-12) and r["predicted"] == 1 for r in pairwise_quality.scored(odd, none).collect())


RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "com", "/de/")]


def test_host_words(spark):
    urls = ["http://a.example.org/es/1", "https://EXAMPLE.org/en?x", "http://org", "x", None, "", "http://b.com/de/2#t",
            "http://cheappills.net/a", "http://fineharbor.net/a"] * 2
    pages = spark.createDataFrame([(i, u, "<b>cheap pills fine harbor</b>", "x") for i, u in enumerate(urls)],
                                  "page_id long, url string, html string, host string")
    got = {r["page_id"]: r for r in host_words.judge_urls(pages, RULES).collect()}
    assert len(got) == len(urls)
    assert [(got[i]["host"], got[i]["path"], got[i]["rule"]) for i in range(7)] == [
        ("a.example.org", "/es/1", "example.org/es/"), ("example.org", "/en", "org/"), ("org", "", None), ("", "", None),
        ("", "", None), ("", "", None), ("b.com", "/de/2", "com/de/")]
    assert got[0]["verdict"] == "block" and got[1]["verdict"] == "allow" and got[7]["verdict"] == "block"
    edges = [{"i": 0, "len": 5, "n": 9}, {"i": 5, "len": 5, "n": 9}, {"i": 0, "len": 3, "n": 2}]
    assert host_words.best_split("cheappills", edges, 100.0) == ["cheap", "pills"]
    assert host_words.best_split("zz", [], 100.0) == ["z", "z"]


def test_host_words_by_hand(spark):
    """Word counts, Viterbi and naive Bayes of a small table against plain Python, as whole row sets."""
    import math
    import re
    long_word = "rindfleischetikettierungsueberwachung"
    html = f"<b>cheap pills fine harbor</b> {long_word} in the harbor"
    hosts = ["cheappills.net", "fineharbor.net", f"the{long_word}.org", "a.example.org", "qq.com", "fine.com"]
    paths = ["/es/1", "/en/22", "/de/x-y", "/fr/", "", "/fineharbor"]
    urls = [f"http://{h}{p}" for h in hosts for p in paths] + [None, "x"]
    pages = spark.createDataFrame([(i, u, html) for i, u in enumerate(urls * 2)], "page_id long, url string, html string")
    counts = {}
    for u in urls * 2:
        path = re.sub(r"^.*?://[^/]*", "", u) if u and "://" in u else ""
        for w in re.findall(r"[a-z]+", (re.sub(r"<[^>]*>", " ", html) + " " + path).lower()):
            counts[w] = counts.get(w, 0) + 1
    found = host_words.word_counts(pages)
    assert {r["word"]: r["n"] for r in found.collect()} == counts
    total, alone = sum(counts.values()), math.log(0.1 / sum(counts.values()))

    def split(label):
        best = [(0.0, [])]
        for end in range(1, len(label) + 1):
            options = [(best[end - 1][0] + alone, best[end - 1][1] + [label[end - 1]])]
            options += [(best[i][0] + math.log(counts[label[i:end]] / total), best[i][1] + [label[i:end]]) for i in range(end) if label[i:end] in counts]
            best.append(max(options, key=lambda x: x[0]))
        return best[-1][1]

    labels = sorted({x for h in hosts for x in re.findall("[a-z]+", h)})
    got = host_words.split_labels(spark.createDataFrame([(x,) for x in labels], "label string"), found, 12)
    got = {r["label"]: list(r["words"]) for r in got.collect()}
    assert got == {x: split(x) for x in labels} and got[f"the{long_word}"] == ["the", long_word]
    rules = [("allow", "org", "/"), ("block", "com", "/de/"), ("block", "com", "/fr/"), ("allow", "com", "/en/")]
    _, tokens, judged = host_words.prepared(pages, rules)
    by_url = {}
    for r in tokens.collect():
        by_url.setdefault(r["url"], []).append(r["token"])

    def tokens_of(u):
        host, path = re.match(r"http://([^/]*)(.*)", u).groups()
        runs = re.sub(r"\d+", "/#/", path.lower())
        return sorted([f"h:{w}" for x in re.findall("[a-z]+", host) for w in got[x]] + [f"p:{w}" for w in re.findall(r"[a-z#]+", runs)])

    assert {u: sorted(t) for u, t in by_url.items()} == {u: tokens_of(u) for u in urls if u and u != "x"}
    marked = {r["url"]: r["block"] for r in judged.collect()}
    tally = {}
    for u, block in marked.items():
        for t in by_url[u]:
            tally.setdefault(t, [0, 0])[block] += 2                # every url is on two rows
    a, b = (sum(x[i] for x in tally.values()) + len(tally) + 1 for i in (0, 1))
    weights, odds = host_words.token_weights(tokens, judged)
    want = {t: math.log((y + 1) / b) - math.log((x + 1) / a) for t, (x, y) in tally.items()}
    assert {r["token"]: pytest.approx(r["weight"]) for r in weights.collect()} == want
    n = [2 * sum(v == k for v in marked.values()) for k in (False, True)]
    assert odds == pytest.approx(math.log((n[1] + 1) / (n[0] + 1)))
    strength = host_words.seed_weight(tokens, judged)
    for s in host_words.ADVERTISING:
        want[f"h:{s}"] = max(want.get(f"h:{s}", -1e9), strength)
    for r in host_words.judge_urls(pages, rules).collect():
        if r["rule"] is None:
            u = urls[r["page_id"] % len(urls)]
            score = odds + sum(want.get(t, 0.0) for t in by_url.get(u, []))
            assert r["score"] == pytest.approx(score, abs=1e-6) and r["verdict"] == ("block" if score > 0 else "allow"), u


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_host_words_recall(spark, sf):
    from snapflow.llm.queries import URL_RULES
    pages = spark.read.parquet(f"/root/testdata/{sf}/pages.parquet")
    _, tokens, judged = host_words.prepared(pages, URL_RULES)
    blocked, allowed = host_words.held_out_recall(tokens, judged)
    print(f"{sf}: held-out urls judged as by their rule: blocked {blocked:.3f}, allowed {allowed:.3f}, seed weight {host_words.seed_weight(tokens, judged):.2f}")
    # rules that block one path of an otherwise allowed host leave words that both classes share
    assert blocked >= 0.75 and allowed >= 0.95
    out = host_words.judge_urls(pages, URL_RULES).filter("rule is null").collect()
    spam = [r for r in out if any(s in r["host"] for s in ("casino", "cheap", "pills", "porn", "poker", "xxx"))]
    print(sf, len(out), "without rule,", len(spam), "advertise,", sum(r["verdict"] == "block" for r in spam), "of them and",
          sum(r["verdict"] == "block" for r in out) - sum(r["verdict"] == "block" for r in spam), "others blocked")
    assert sum(r["verdict"] == "block" for r in spam) >= 0.9 * len(spam)


def test_empty_tables(docs, spark):
    none = docs.limit(0)
    dims = [hilbert.Dimension("lang"), hilbert.Dimension("n_chars", numeric=True)]
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    for out in (line_rules.judge(none), line_dedup.line_report(none), covering_simhash.near_duplicates(none), bottom_k.edit_likeness(none),
                hilbert.hilbert_shards(none, dims), residual_packing.pack_documents(none), token_matrix.packed_matrix(none),
                suffix_pieces.encoded(none), host_words.judge_urls(pages, RULES)):
        assert out.count() == 0


def test_pipeline(spark):
    import corpus_pipeline as cp
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in cp.STAGES] == ["quality rules", "quality classifier", "line dedup", "SimHash near-dedup", "best-fit packing"]
    clean = cp.quality_rules(spark, docs, sf)
    kept = {r["doc_id"] for r in line_rules.judge(docs).filter("kept").collect()}
    assert {r["doc_id"] for r in clean.collect()} == kept and clean.columns == docs.columns
    lone = cp.near_duplicates(spark, clean, sf)
    found = covering_simhash.near_duplicates(clean).collect()
    assert {r["doc_id"] for r in lone.collect()} == {r["component_id"] for r in found}
    packed = cp.run(spark, sf).collect()
    assert {r["doc_id"] for r in packed} <= kept and packed
    for _, stage in cp.STAGES[:-1]:
        assert stage(spark, docs.limit(0), sf).count() == 0


def test_pipeline_keeps_one_row_of_each_group(spark):
    """Null ids and a repeated id: no group of the brute-force version is without its one row."""
    import corpus_pipeline as cp
    rng = random.Random(11)
    alone = [" ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(60)) for _ in range(12)]
    base = alone[0]
    rows = [(None, t) for t in alone[1:9]] + [(None, alone[1])]    # unrelated texts without id, one of them twice
    rows += [(3, base), (None, base), (7, base.upper())]           # id 7 is a copy of document 3 ...
    rows += [(7, t) for t in alone[9:]] + [(8, alone[9]), (None, None), (9, "")]   # ... and three other texts
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, k int").repartition(4)
    groups = {}
    for i, t in rows:
        groups.setdefault(_simhash(t or ""), []).append((i is None, i or 0, t or ""))
    got = cp.near_duplicates(spark, docs, "")
    assert got.columns == docs.columns
    kept = [((r["doc_id"] is None, r["doc_id"] or 0), r["text"] or "") for r in got.collect()]
    assert sorted((k, _simhash(t)) for k, t in kept) == sorted((min(g)[:2], fp) for fp, g in groups.items())


def test_pipeline_keeps_lines_with_furniture_inside_words(spark):
    import corpus_pipeline as cp
    filler = "and the old bridge over the river was drawn again by the same careful hand during that long winter."
    plain = f"They kept the design in a drawer, wrote a blog in spring, put the catalog in order, {filler}"
    fixed = f"You have to log in before the two machines exchange their keys, {filler}"
    rows = [(0, plain, [plain]), (1, fixed, [fixed]), (2, f"{plain}\nShort words of a blog in spring.\nPlease sign in.\nCopyright (c)2020 by us.",
            [plain, "Short words of a blog in spring."]), (3, "Sign in. Log in. Read more. Click here. " * 6, None),
            (4, f"Read more: {plain}", [f"Read more: {plain}"]), (5, f"Sign in, log in; read more, click here, share this {filler}", None)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in cp.quality_rules(spark, docs, "").collect()}
    assert got == {i: "\n".join(lines) for i, _, lines in rows if lines}


def test_line_drops_meet_texts_without_a_sort(spark):
    """Whole texts pass by the line numbers of their partition; a merge join would sort them."""
    docs = spark.createDataFrame([(i, f"{'a line that five documents hold ' * 2}\nown {i}") for i in range(9)], "doc_id long, text string")
    report = line_dedup.line_report(docs)
    plan = report._jdf.queryExecution().sparkPlan().toString()
    assert "ShuffledHashJoin" in plan.split("Project")[1]
    assert {r["doc_id"]: r["kept_text"] for r in report.collect()} == {
        i: f"own {i}" if i < 8 else docs.where("doc_id = 8").first()["text"] for i in range(9)}
