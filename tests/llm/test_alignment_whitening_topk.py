"""Alignment, whitening and top-k search against brute force and edge rows."""

import hashlib
import random
from collections import Counter, defaultdict
from math import floor

import numpy as np
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
FOLDER = "/opt/tokenizers"


def clash(df):
    for name in ("id", "v", "x", "n", "kind", "chunk", "pair", "part", "block", "shard", "dim", "component", "rank", "_id", "text2"):
        df = df.withColumn(name, F.lit("x"))
    return df


# --- alignment


def plain_alignment(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    from propensio.llm.alignment import byte_alphabet

    a = Tokenizer.from_file(f"{FOLDER}/byte_bpe_50k.json")
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=f"{FOLDER}/piece_bpe_32k.model")
    alphabet, out, links = byte_alphabet(), [], []
    for _, text in rows:
        found = None
        if text:
            ids_a = a.encode(" " + text, add_special_tokens=False).ids
            ids_b = b.encode(text)
            raw_a = [bytes(alphabet[c] for c in a.id_to_token(i)) for i in ids_a]
            raw_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
            if b"".join(raw_a) == b"".join(raw_b) == b" " + text.encode():
                found = ids_a, ids_b, raw_a, raw_b
        if not found:
            out.append([0, 0, 0, ""])
            links.append([])
            continue
        ids_a, ids_b, raw_a, raw_b = found
        spans = []
        for raws in (raw_a, raw_b):
            at, s = 0, []
            for r in raws:
                s.append((at, at + len(r)))
                at += len(r)
            spans.append(s)
        links.append([(ids_a[i], ids_b[j]) for i, (s, e) in enumerate(spans[0]) for j, (u, v) in enumerate(spans[1]) if s < v and u < e])
        cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, low = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i, (s, e) in zip(ids, span, strict=True) if low <= s and e <= cut) for ids, span in zip((ids_a, ids_b), spans, strict=True)))
            low = cut
        out.append([len(ids_a), len(ids_b), len(cuts), hashlib.sha256(";".join(groups).encode()).hexdigest()])
    count = Counter(p for x in links for p in set(x))
    top = defaultdict(int)
    for (i, _), c in count.items():
        top[i] = max(top[i], c)
    return [(r[0], o[0], o[1], o[2], len(x), sum(count[p] == top[p[0]] for p in x), sum(count[p] for p in x), o[3]) for r, o, x in zip(rows, out, links, strict=True)]


ALIGN = [
    (1, None), (2, ""), (3, "plain words here"), (4, "double  space  and\ttab\nnewline "), (5, " leading"), (6, "<|endoftext|> <s> </s> <0x41> <unk>"),
    (7, "naïve café “quoted” – 東京 🙂 مرحبا"), (8, "wor" * 400), (9, "ｆｕｌｌ ｗｉｄｔｈ"), (10, "low▁line"), (11, "\x00nul\x1f"), (12, "a"), (13, "plain words here"), (13, "plain words here"),
    (None, "null id text"), (2**62 + 1, "   "), (14, "é composed"), (15, "x" * 3000),
]


def test_alignment_equals_a_plain_one(spark):
    from propensio.llm.alignment import aligned_documents

    random.seed(5)
    pool = "the Cat's über 1234 don't — naïve straße <s> \n\n  %% 東 ok_ok http://x.y/z".split(" ")
    rows = ALIGN + [(100 + i, " ".join(random.choices(pool, k=random.randint(1, 40)))) for i in range(60)]
    df = clash(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    got = aligned_documents(df)
    assert [c for c, _ in got.dtypes] == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert {k for _, k in got.dtypes[:-1]} == {"bigint"}
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(plain_alignment(rows), key=repr)


def test_alignment_of_the_documents_and_small_chunks(spark, monkeypatch):
    from propensio.llm import alignment

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text if r.text and len(r.text) < 3000 else None) for r in docs.collect()]
    want = sorted(plain_alignment(rows), key=repr)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for chunk in (alignment.CHUNK, 5000):
        monkeypatch.setattr(alignment, "CHUNK", chunk)
        assert sorted(map(tuple, alignment.aligned_documents(df).collect()), key=repr) == want


def test_alignment_pairs_table(spark):
    from propensio.llm.alignment import alignment_pairs

    df = spark.createDataFrame([(1, "one two"), (2, "one two three"), (3, None)], "doc_id long, text string")
    got = alignment_pairs(df).collect()
    assert max(r.documents for r in got) == 2 and all(r.best for r in got)
    assert len({(r.a_id, r.b_id) for r in got}) == len(got)


def test_alignment_of_long_text_and_empty_table(spark):
    from propensio.llm.alignment import aligned_documents

    text = "some words of no great interest, 42 times over. " * 45_000  # 2.1 MB
    df = spark.createDataFrame([(1, text), (2, "some words")], "doc_id long, text string")
    rows = {r.doc_id: r for r in aligned_documents(df).collect()}
    assert rows[1].n_links == rows[1].n_a + rows[1].n_b - rows[1].n_groups and rows[1].n_a > 400_000 and rows[2].n_best == rows[2].n_links
    assert aligned_documents(df.limit(0)).count() == 0


def test_terminals_converge_to_shared_ends():
    from propensio.llm.alignment import terminals

    rng = np.random.default_rng(1)
    for _ in range(50):
        size = int(rng.integers(1, 200))
        a, b = (np.unique(np.concatenate([rng.integers(1, size + 1, int(rng.integers(1, 60))), [size]])) for _ in range(2))
        pointer, _, _ = terminals(a, b)
        cuts = np.intersect1d(a, b)
        assert np.array_equal(b[pointer[: len(a)] - len(a)], cuts[np.searchsorted(cuts, a)])
        assert np.array_equal(b[pointer[len(a) :] - len(a)], cuts[np.searchsorted(cuts, b)])


# --- whitening


@pytest.mark.parametrize("case", ["random", "repeated", "low_rank", "zero", "identity", "one"])
def test_spectral_components(case):
    from propensio.llm.whitening import spectral_components

    rng = np.random.default_rng(3)
    q, _ = np.linalg.qr(rng.normal(size=(24, 24)))
    e = {
        "random": rng.random(24) * 100, "repeated": np.repeat([5.0, 3.0, 1.0], 8), "low_rank": np.concatenate([[9, 4, 1], np.zeros(21)]), "zero": np.zeros(24),
        "identity": np.ones(24), "one": np.array([2.0]),
    }[case]
    v = (q * e) @ q.T if len(e) > 1 else np.array([[2.0]])
    got, x = spectral_components(v)
    assert np.allclose(got, np.sort(e)[::-1], atol=1e-12 * max(1, e.max()))
    assert np.abs(x.T @ x - np.eye(len(e))).max() < 1e-13
    assert np.abs(v @ x - x * got).max() <= 1e-12 * max(1.0, e.max())


def test_whitening_equals_numpy(spark):
    from propensio.llm.whitening import whiten

    table = clash(spark.read.parquet(f"{SF}/embeddings.parquet"))
    source = {r.vec_id: r.embedding for r in table.collect()}
    odd = [(-1, None), (-2, [1.0] * 63 + [float("nan")]), (-3, [1.0] * 63 + [None]), (-4, [float("inf")] * 64), (-5, [1.0] * 3), (-6, []), (-7, [1e30] + [0.0] * 63)]
    df = table.select("vec_id", "embedding").union(spark.createDataFrame(odd, "vec_id long, embedding array<float>"))
    rows = whiten(df).collect()
    ids = sorted(source)
    x = np.array([[floor(64 * float(c)) + 1_000_000 for c in source[i]] for i in ids])
    n, sums = len(x), x.sum(axis=0)
    d = (n * x - sums) / n
    v = d.T @ d / n
    e, axes = np.linalg.eigh(v)
    e, axes = e[::-1], axes[:, ::-1]
    assert len(rows) == n * 32 and {r.vec_id for r in rows} == set(ids)
    at = {i: k for k, i in enumerate(ids)}
    white = np.empty((n, 32))
    for r in rows:
        white[at[r.vec_id], r.component - 1] = r.whitened
        assert r.n == n and r.deviation == int(((n * x[at[r.vec_id]] - sums) ** 2).sum()) == r.deviation_exact
        assert abs(r.explained - e[r.component - 1] / np.trace(v)) < 1e-10 and r.identity_error < 1e-9
    want = d @ axes[:, :32] / np.sqrt(e[:32])
    assert np.abs(np.abs(white) - np.abs(want)).max() < 1e-7
    assert np.abs(white.T @ white / n - np.eye(32)).max() < 1e-9


def test_whitening_edges(spark):
    from propensio.llm.whitening import whiten

    schema = "vec_id long, embedding array<double>"
    assert whiten(spark.createDataFrame([], schema)).count() == 0
    one = whiten(spark.createDataFrame([(1, [1.0, 2.0])], schema)).collect()
    assert [(r.component, r.whitened, r.explained, r.deviation, r.identity_error) for r in one] == [(1, 0.0, 0.0, 0, 0.0), (2, 0.0, 0.0, 0, 0.0)]
    same = whiten(spark.createDataFrame([(1, [1.0, 5.0]), (1, [1.0, 5.0]), (None, [3.0, 5.0])], schema)).collect()  # a constant dimension
    assert len(same) == 6 and {r.explained for r in same} == {1.0, 0.0} and all(r.identity_error < 1e-12 for r in same)
    big = whiten(spark.createDataFrame([(i, [float(i) * 2.0**50, 1.0 * i * i]) for i in range(50)], schema)).where("component = 1").collect()
    x = [[64 * i * 2**50 + 10**6, 64 * i * i + 10**6] for i in range(50)]
    sums = [sum(c) for c in zip(*x, strict=True)]
    for r in big:
        exact = sum((50 * a - s) ** 2 for a, s in zip(x[r.vec_id], sums, strict=True))
        assert int(r.deviation_exact if r.deviation_exact is not None else exact) == exact and r.deviation is None


# --- top-k


def plain_top(rows, k=20):
    sound = [(i, [floor(64 * float(c)) if abs(c) < 1e300 else int(c) * 64 for c in v]) for i, v in rows if v is not None and all(c is not None and abs(c) < float("inf") for c in v)]
    out = []
    for q, x in sound:
        if q is None or q % 20:
            continue
        scored = [(-max(-(2**63 - 1), min(2**63 - 1, sum(a * b for a, b in zip(x, y, strict=True)))), c is None, c) for c, y in sound if c != q and len(x) == len(y)]
        out += [(q, r, c, -s) for r, (s, _, c) in enumerate(sorted(scored, key=lambda t: (t[0], t[1], t[2] or 0))[:k], 1)]
    return sorted(out, key=repr)


def test_top_k_ties_edges_and_merging(spark, monkeypatch):
    from propensio.llm import topk

    rng = np.random.default_rng(7)
    rows = [(i, (rng.integers(-3, 4, 6) / 64).tolist()) for i in range(400)]  # many ties
    rows += [(1000, None), (1020, [None] * 6), (1040, [float("nan")] * 6), (1060, [1.0, 2.0]), (1061, [2.0, 2.0]), (1080, []), (1081, []), (None, [1.0] * 6), (None, [1.0] * 6)]
    rows += [(1100, [1.0] * 6), (1100, [1.0] * 6), (1101, [0.5] * 6), (1101, [0.5] * 6)]
    df = clash(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    want = plain_top(rows)
    monkeypatch.setattr(topk, "FAN", 2)
    for block, shard, tile in ((16_384, 16_384, 256), (7, 60, 4)):
        monkeypatch.setattr(topk, "BLOCK", block)
        monkeypatch.setattr(topk, "SHARD", shard)
        monkeypatch.setattr(topk, "TILE", tile)
        got = topk.exact_top_k(df.where("vec_id % 20 = 0"), df)
        assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
        assert sorted(map(tuple, got.collect()), key=repr) == want


def test_top_k_of_huge_components_and_empty_tables(spark):
    from propensio.llm.topk import exact_top_k

    rng = np.random.default_rng(9)
    rows = [(i, (rng.normal(size=4) * 10.0 ** rng.integers(0, 12)).tolist()) for i in range(0, 90, 3)] + [(900, [1e308, -1e308, 1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = exact_top_k(df.where("vec_id % 20 = 0"), df)
    assert sorted(map(tuple, got.collect()), key=repr) == plain_top(rows)
    none = df.limit(0)
    assert exact_top_k(none, df).count() == exact_top_k(df, none).count() == exact_top_k(none, none).count() == 0
