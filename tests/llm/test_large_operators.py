"""Archives, passages, near copies, mixing, packing and neighbours against brute force."""

import gzip
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from thumbwheel.llm import ann, mixing, neardup, packing, substring, warc
from thumbwheel.session import scratch_path

TEXT = "doc_id long, text string"


def corpus(seed=1, n=150):
    """Texts with exact copies, near copies, shared passages and odd rows."""
    rng = random.Random(seed)
    word = lambda: "w%d" % int(rng.paretovariate(0.7) % 3000)
    passage = [word() for _ in range(60)]
    rows, texts = [], []
    for i in range(n):
        kind = rng.random()
        if kind < 0.3 or not texts:
            words = [word() for _ in range(rng.choice([3, 15, 40, 120, 300]))]
        elif kind < 0.45:
            words = rng.choice(texts).split()
        elif kind < 0.75:
            words = [w if rng.random() > 0.03 else word() for w in rng.choice(texts).split()]
        else:
            at = rng.randrange(20)
            words = [word() for _ in range(30)] + passage[at : at + 35] + [word() for _ in range(9)]
        texts.append(" ".join(words))
        rows.append((rng.randrange(10**6) * 200 + i, rng.choice([" ", "\n", " \t"]).join(words)))
    loop = "a b c d e " * 30
    return rows + [(5, None), (6, ""), (7, " \n"), (8, "one two"), (9, loop), (10, loop.upper()), rows[3], (None, rows[4][1])]


def brute_passages(rows, width=20):
    first = {}
    for doc_id, text in sorted(r for r in set(rows) if r[0] is not None and r[1]):
        words = text.split()
        for s in range(len(words) - width + 1):
            first.setdefault(tuple(words[s : s + width]), (doc_id, s))
    out = []
    for doc_id, text in rows:
        words = (text or "").split()
        gone = set()
        for s in range(len(words) - width + 1):
            if doc_id is not None and first[tuple(words[s : s + width])] != (doc_id, s):
                gone.update(range(s, s + width))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc_id is None, doc_id, len(words), len(gone), kept))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_passages(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame([(*r, "x") for r in rows], TEXT + ", spans string").repartition(5)
    out = substring.remove_repeats(spark, docs, carry=["spans"]).collect()
    got = sorted(((r.doc_id is None, r.doc_id, r.n_words, r.n_removed, r.text) for r in out), key=str)
    assert got == brute_passages(rows) and {r.spans for r in out} == {"x"}
    assert sum(g[3] for g in got) > 1000


def test_passages_of_no_rows_and_of_two_texts_with_one_id(spark):
    assert substring.remove_repeats(spark, spark.createDataFrame([], TEXT)).count() == 0
    texts = [" ".join(f"{p}{i}" for i in range(30)) for p in "ab"]
    docs = spark.createDataFrame([(1, texts[0]), (1, texts[1]), (2, texts[0])], TEXT)
    got = sorted((r.doc_id, r.n_removed) for r in substring.remove_repeats(spark, docs).collect())
    assert got == [(1, 0), (1, 0), (2, 30)]


def test_pieces_cross_batches(spark):
    """The reader of sorted pieces gives the same rows however they are cut into batches."""
    rng = np.random.default_rng(3)
    rows = np.stack([rng.integers(0, 9, 400), rng.integers(0, 3, 400), rng.integers(0, 5, 400), rng.integers(0, 4, 400)])
    rows = rows[:, np.lexsort(rows[::-1])]
    import pyarrow as pa

    def run(size):
        cut = [rows[:, i : i + size] for i in range(0, 400, size)]
        batches = [pa.RecordBatch.from_arrays([*(pa.array(c) for c in b), pa.array(np.ones(b.shape[1], int))],
                                              substring.PIECE_NAMES) for b in cut]
        return sorted(tuple(r.values()) for b in substring._resolve(iter(batches)) for r in b.to_pylist())

    whole = run(400)
    assert all(run(size) == whole for size in (1, 2, 7, 50, 399))
    first = {}
    for a, p, d, s in rows.T.tolist():
        first.setdefault((a, p), (d, s))
    later = sum((d, s) != first[a, p] for a, p, d, s in rows.T.tolist())
    assert sum(r[5] for r in whole) == later
    assert sum(not r[5] for r in whole) == sum(1 for a, _ in first if sum(x == a for x, _ in first) > 1)


def brute_components(rows):
    sets = {}
    for doc_id, text in rows:
        words = (text or "").lower().split()
        n = min(5, len(words))
        sets.setdefault(doc_id, []).append(frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if n else frozenset())
    ids = [i for i in sets if i is not None]
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in ids:
        for j in ids:
            if i < j and any(a and b and 100 * len(a & b) >= 85 * len(a | b) for a in sets[i] for b in sets[j]):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("cfg", [neardup.SketchConfig(), neardup.SketchConfig(block=4), neardup.SketchConfig(block=4, largest_group=3)])
def test_near_copies(spark, cfg):
    rows = corpus(4)
    docs = spark.createDataFrame([(*r, 1) for r in rows], TEXT + ", component_id long").repartition(5)
    out = neardup.near_duplicates(spark, docs, cfg).collect()
    want = brute_components(rows)
    assert len(out) == len(rows)
    for r in out:
        assert r.component_id == want.get(r.doc_id) and r.kept == (r.doc_id == r.component_id)
    assert sum(not r.kept for r in out) > 30
    assert {r.n_shingles for r in out if r.doc_id in (5, 6, 7)} == {0}


def test_near_copies_of_no_rows(spark):
    assert neardup.near_duplicates(spark, spark.createDataFrame([], TEXT)).count() == 0


def test_likelihood_estimates_similarity():
    cfg, rng = neardup.SketchConfig(), np.random.default_rng(0)
    for shared in (0.3, 0.6, 0.85, 0.95):
        n = 4000
        common = rng.integers(0, 1 << 62, int(n * shared)).astype(np.uint64)
        a, b = (np.unique(np.concatenate([common, rng.integers(0, 1 << 62, n - len(common)).astype(np.uint64)])) for _ in range(2))
        truth = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        k = neardup.sketches([a, b, np.union1d(a, b)], cfg)
        assert (np.maximum(k[0], k[1]) == k[2]).all()  # mergeable
        guess = neardup.similarity(k[:1], k[1:2], np.array([len(a)], float), np.array([len(b)], float), cfg)[0]
        assert abs(guess - truth) < 4 * (truth * (1 - truth) / cfg.registers) ** 0.5


def test_archives(spark):
    big = "<p>" + "x" * 200
    rows = [(i, f"http://a.b/{i} ü", big if i % 3 == 0 else f"<p>{i}" + "y" * (i * 7)) for i in range(60)]
    rows += [(100, None, None), (101, "", ""), (102, "u", "short"), (103, "u", "short"), (None, "n", big), rows[5], (-4, "m", big)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")
    cfg = warc.ArchiveConfig(shard_bytes=4000, roll_bytes=700)
    folder, again = scratch_path(spark, "a"), scratch_path(spark, "b")
    manifest = warc.write_archives(spark, pages, folder, cfg).orderBy("name").collect()
    other = warc.write_archives(spark, pages.repartition(7), again, cfg).orderBy("name").collect()
    assert [(m.name, m.sha256) for m in manifest] == [(m.name, m.sha256) for m in other]
    assert len(manifest) > 3 and max(m.roll for m in manifest) > 0 and len({m.shard for m in manifest}) > 2
    raw = open(f"{folder}/{manifest[0].name}", "rb").read()
    assert hashlib.sha256(raw).hexdigest() == manifest[0].sha256 and gzip.decompress(raw).startswith(b"WARC/1.1\r\n")
    back = warc.read_archives(spark, folder).collect()
    assert len(back) == len(rows)
    html = {i: h or "" for i, _, h in rows}
    for r in back:
        payload = html[r.page_id].encode()
        assert (r.payload_bytes, r.payload_digest) == (len(payload), hashlib.sha256(payload).hexdigest())
        again = len(payload) >= 100 and r.page_id is not None and html[r.page_id] == big and r.page_id != -4
        if r.page_id is not None:
            assert (r.record_type, r.refers_to) == (("revisit", -4) if again else ("response", None))
        if r.record_type == "response":
            assert bytes(r.payload) == payload
    empty = scratch_path(spark, "c")
    assert warc.write_archives(spark, pages.limit(0), empty, cfg).count() == 0
    assert warc.read_archives(spark, empty).count() == 0


def test_packing(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    rows = [r for r in corpus(5) if r[0] is not None] + [(11, "It's <|endoftext|> 1234 naïve… Ünïcode " * 400)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], TEXT + ", start long").repartition(4)
    out = packing.pack_documents(spark, docs).toPandas()
    encoder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: [*encoder.encode(t or "", add_special_tokens=False).ids, 1] for i, t in rows}
    for r in out.itertuples():
        piece = ids[r.doc_id][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.asarray(piece, "<u4").tobytes()) and r.doc_tokens == len(ids[r.doc_id])
    assert out.length.sum() == sum(len(ids[i]) for i, _ in rows)
    ordered = out.sort_values(["sequence_id", "offset"])
    assert ((ordered.groupby("sequence_id").length.cumsum() - ordered.length) == ordered.offset).all()
    sizes = ordered.groupby("sequence_id").length.sum()
    assert (sizes.iloc[:-1] == 2048).all() and list(sizes.index) == list(range(len(sizes)))
    assert packing.pack_documents(spark, docs.limit(0)).count() == 0


def test_words_give_the_ids_of_the_whole_text(spark, sf_dir):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, words = Tokenizer.from_file(path), packing.WordTokenizer(path, packing.PackingConfig(cached_words=500))
    assert words.latin
    rng = random.Random(1)
    signs = "aZ'sS09.,!-_<|>#é\u00c9\u00df\u00d7\u00f7\u00ff\u0178\u0130\u03a3\u03c3\u0301\u00aa\u00b2\u00b5\u4e2d\U0001f600\u200d\x1c\x7f\x00\u00a0\u2003\u0085 "
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(40))) for _ in range(3000)]
    texts += [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    for text in texts:
        ids = np.frombuffer(words.ids(text), "<u4").tolist()
        assert ids == encoder.encode(text, add_special_tokens=False).ids, text


def test_hilbert_keys_step_to_neighbours():
    for n, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * n, indexing="ij"), -1).reshape(-1, n)
        keys = packing.hilbert_keys(grid, bits)
        assert sorted(keys) == list(range(len(grid)))
        assert set(np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1)) == {1}


def test_neighbours(spark):
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(3000, 16)).astype(np.float32)
    vectors[1000:2000] = vectors[7]  # a third of all rows alike
    rows = [(i, [float(x) for x in v], i) for i, v in enumerate(vectors)]
    rows += [(4000, None, 0), (None, rows[0][1], 0), (4050, [0.0] * 16, 0), (4100, [float("nan")] + [1.0] * 15, 0),
             (4150, [1.0] * 3, 0), (4200, [None] + [1.0] * 15, 0), rows[50]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank long").repartition(5)
    out = ann.search(spark, df, F.col("vec_id") % 50 == 0, ann.AnnConfig(block=200)).collect()
    unit = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1, keepdims=True)
    hits = 0
    by_query = {}
    for r in sorted(out, key=lambda r: (r.query_id, r.rank)):
        by_query.setdefault(r.query_id, []).append(r)
    assert set(by_query) == set(range(0, 3000, 50))
    for q, found in by_query.items():
        scores = unit @ unit[q]
        scores[q] = -9
        best = np.lexsort((np.arange(3000), -scores.round(12)))[:5]
        hits += len({r.vec_id for r in found} & set(best.tolist()))
        assert [r.rank for r in found] == [1, 2, 3, 4, 5] and q not in {r.vec_id for r in found}
        assert all(abs(r.score - scores[r.vec_id]) < 1e-12 for r in found)
        if 1000 <= q < 2000:
            assert [r.vec_id for r in found] == [i for i in (7, 1000, 1001, 1002, 1003, 1004) if i != q][:5]
    assert hits >= 0.9 * 300


def test_neighbours_of_few_rows(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [2.0, 0.0])], "vec_id long, embedding array<double>")
    out = ann.search(spark, few, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r.vec_id, r.rank) for r in out] == [(2, 1), (1, 2)] and out[0].score == 1.0
    assert ann.search(spark, few.limit(0), F.col("vec_id") == 0).count() == 0


def test_mixing(spark):
    rng = random.Random(3)
    rows = []
    for i in range(900):
        lang = "a" if i % 3 else "b"
        words = [f"{lang}{rng.randrange(40)}" if rng.random() < 0.8 else f"c{rng.randrange(40)}" for _ in range(rng.randrange(5, 60))]
        rows.append((i, " ".join(words), "hot" if i % 3 else f"s{i % 5}"))
    rows += [(2000, None, None), (2001, "", "new"), (None, "a1 a2", "hot"), rows[0]]
    docs = spark.createDataFrame(rows, TEXT + ", source string")
    labelled = spark.createDataFrame([(i, "a" if i % 3 else "b") for i in range(0, 900, 2)], "doc_id long, domain string")
    targets = {"a": 0.4, "b": 0.6}
    out = mixing.mix_documents(spark, docs, labelled, targets).toPandas()
    assert len(out) == len(rows) and (out.rate >= 0).all()
    assert ((out.p_a + out.p_b) - 1).abs().max() < 1e-9
    known = out[out.doc_id < 900]
    assert ((known.p_a > 0.5) == (known.doc_id % 3 > 0)).mean() > 0.98
    mass = [(out.rate * out.n_tokens * out[f"p_{d}"]).sum() for d in targets]
    assert abs(mass[0] / sum(mass) - 0.4) < 0.01
    # The same fit in numpy: projected gradient on the miss of both totals.
    p, t = out[["p_a", "p_b"]].to_numpy(), out.n_tokens.to_numpy()
    wanted = np.array([0.4, 0.6]) * mixing.MixConfig().headroom * max((p * t[:, None]).sum(0) / np.array([0.4, 0.6]))
    assert np.abs(np.array(mass) / wanted - 1).max() < 0.005
    assert (out.copies - out.rate).abs().max() < 1
    shown = mixing.mix_documents(spark, docs, labelled, targets)._jdf.queryExecution().toString()
    assert "Python" not in shown and "Arrow" not in shown
    assert mixing.mix_documents(spark, docs.limit(0), labelled, targets).count() == 0
    equal = mixing.mix_documents(spark, docs, labelled.limit(0), targets).toPandas()
    assert (equal.p_a - 0.5).abs().max() < 1e-9
