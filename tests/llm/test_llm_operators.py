"""Training-data operators against brute force, planted cases and edge rows."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def grams(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


EDGE = [
    (1, None, "en", "a"), (2, "", "en", None), (3, " \n\t", None, "a"), (4, "one two", "en", "a"), (5, "One TWO", "en", "b"),
    (6, "word " * 3000, "en", "b"), (7, "word " * 3000, "en", "b"), (7, "word " * 3000, "en", "b"), (None, "null id text here now", "fr", "a"), (9, "ünï !!! ???", "fr", None),
]


@pytest.fixture(scope="module")
def edge(spark):
    df = spark.createDataFrame(EDGE, "doc_id long, text string, lang string, source string")
    for name in ("id", "size", "n", "key", "score", "label", "component", "rank"):  # clashing names
        df = df.withColumn(name, F.lit("x"))
    return df


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def components(rows, percent):
    sets, low = [grams(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while low[i] != i:
            i = low[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                low[max(a, b)] = min(a, b)
    return {rows[i][0]: rows[find(i)][0] for i in range(len(rows))}, {r[0]: len(s) for r, s in zip(rows, sets, strict=True)}


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_match_brute_force(spark, docs, percent):
    from propensio.llm.near_dup import near_duplicates

    base = sorted((r["doc_id"], r["text"]) for r in docs.collect())[:120]
    rng = np.random.default_rng(1)
    rows = list(base)
    for k in range(60):  # one template with one word changed each: linked through the template only
        w = ("alpha beta gamma delta " * 2 + " ".join(f"w{i}" for i in range(80))).split()
        w[int(rng.integers(5, 80))] = f"new{k}"
        rows.append((10_000 + k, " ".join(w)))
    want, sizes = components(rows, percent)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert {r["doc_id"]: r["n_shingles"] for r in got} == sizes


def test_near_duplicates_edges(spark, edge):
    from propensio.llm.near_dup import keep_one_per_group, near_duplicates

    rows = near_duplicates(edge).collect()
    assert len(rows) == len(EDGE)
    by = {r["doc_id"]: r for r in rows}
    assert [by[i]["n_shingles"] for i in (1, 2, 3, 4)] == [0, 0, 0, 1]
    assert by[5]["component_id"] == 4 and by[7]["component_id"] == 6 and by[None]["kept"] and by[None]["component_id"] is None
    kept = keep_one_per_group(edge)
    assert kept.columns == edge.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "3", "4", "6", "9", "None"]
    assert near_duplicates(edge.limit(0)).count() == 0


def test_registers_and_estimate():
    from propensio.llm.near_dup import BUCKETS, estimate, registers

    rng = np.random.default_rng(0)
    h = rng.integers(0, 2**63, 3000, dtype=np.uint64) * np.uint64(2)
    a, b = registers(h[:2500]), registers(h[500:])
    j = estimate(np.array([(a == b).mean()]), np.array([2500]), np.array([2500]))[0]
    assert len(a) == BUCKETS and abs(j - 2000 / 3000) < 0.15


def test_components_of_a_long_chain(spark):
    from propensio.llm.graph import connected_components

    df = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(df).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}


def test_toxicity_finds_gapped_insults(spark, edge):
    from propensio.llm.toxicity import fit_toxicity

    rng = np.random.default_rng(2)
    clean = ["table", "river", "mountain", "window", "garden", "letter", "summer", "orange", "paper", "market", "forest", "silver"]
    rows = []
    for k in range(400):
        w = list(rng.choice(clean, 12)) + [f"n{rng.integers(1000)}"]
        if k % 4 == 0:
            w[int(rng.integers(12))] = ["grumbold", "flinkert"][k // 4 % 2]
        rows.append((" ".join(w), int(k % 4 == 0)))
    rows.append((None, None))
    model = fit_toxicity(spark.createDataFrame(rows, "text string, toxic int"))
    probe = ["river grumbold paper", "river grum-bold paper", "g r u m b o l d", "a flinxkert here", "table river summer", "", None]
    got = [r["score"] for r in model.score(spark.createDataFrame(list(enumerate(probe)), "doc_id int, text string")).orderBy("doc_id").collect()]
    assert min(got[:4]) >= 0.5 and max(got[4:]) < 0.5
    assert model.score(edge).count() == len(EDGE) and model.filter_clean(edge).columns == edge.columns
    nothing = fit_toxicity(spark.createDataFrame([], "text string, toxic int"))
    assert all(r["score"] < 0.5 for r in nothing.score(edge).collect())


def test_url_rules_and_reputation(spark):
    from propensio.llm.url_filter import judge_urls

    urls = ["http://a.example.com/en/x?q", "https://www.EXAMPLE.com/en/#t", "http://x.net/es/1", "http://x.net/de/1", None, "nothing", "http://bad.org/a", "http://good.org/b", "http://com"]
    urls += ["http://bad.org/p"] * 60 + ["http://good.org/p"] * 60
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("x")).withColumn("bad", F.lit("x"))
    bad = spark.createDataFrame([(i, int(u == "http://bad.org/p")) for i, u in enumerate(urls) if u and u.endswith("/p")] + [(0, None)], "page_id long, bad int")
    got = {r["page_id"]: r for r in judge_urls(pages, bad).collect()}
    assert [(got[i]["rule"], got[i]["verdict"]) for i in range(3)] == [("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block")]
    assert (got[1]["host"], got[1]["path"], got[0]["path"]) == ("www.example.com", "/en/", "/en/x") and (got[4]["host"], got[5]["path"]) == ("", "")
    assert got[6]["verdict"] == "block" and got[7]["verdict"] == "allow" and got[3]["rule"] is None and got[8]["rule"] is None
    assert len(got) == len(urls) and judge_urls(pages.limit(0), bad.limit(0)).count() == 0


def test_sharding_law_and_mixture(spark, docs, edge):
    from propensio.llm.sharding import shard

    rows = shard(docs).join(docs.select("doc_id", "text", "source"), "doc_id").toPandas()
    per = rows.groupby("shard").slot.agg(["count", "max", "nunique"])
    assert per["count"].max() - per["count"].min() <= 1 and (per["max"] + 1 == per["count"]).all() and (per["nunique"] == per["count"]).all()
    spread = rows.groupby(["source", "shard"]).size().unstack(fill_value=0)
    assert (spread.max(axis=1) - spread.min(axis=1)).max() <= 2
    assert (rows.text_crc32 == [zlib.crc32(t.encode()) for t in rows.text]).all() and (rows["size"] == [len(t.encode()) + 1 for t in rows.text]).all()
    out = shard(edge).collect()
    assert len(out) == len(EDGE) and {r["doc_id"]: r["size"] for r in out}[1] == 1 and shard(edge.limit(0)).count() == 0


def test_mixing_hits_targets(spark, edge):
    from propensio.llm.mixing import mix, mixed_documents

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")  # 50 documents a source
    rows = mix(docs).join(docs.select("doc_id", "source", "text"), "doc_id").toPandas()
    assert (rows["size"] == [len(WORD.findall(t)) for t in rows.text]).all() and (rows.taken <= 3 * rows["size"]).all()
    size = rows.groupby("source")["size"].sum().to_dict()
    target, free = {}, sorted(size)
    weight = {s: i % 3 + 1 for i, s in enumerate(free)}
    total = sum(size.values())
    while True:  # caps, then the excess anew
        level = (total - sum(target.values())) / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 3 * size[s]]
        if not over:
            break
        target |= {s: 3 * size[s] for s in over}
        free = [s for s in free if s not in over]
    target |= {s: level * weight[s] for s in free}
    for s, g in rows.groupby("source"):
        assert g.target.iloc[0] == pytest.approx(target[s]) and g.source_size.iloc[0] == size[s]
        assert abs(g.taken.sum() - target[s]) <= 0.02 * target[s]
    again = mix(docs.repartition(5)).toPandas().sort_values("doc_id")
    assert (again.taken.to_numpy() == rows.sort_values("doc_id").taken.to_numpy()).all()
    out = mix(edge).collect()
    assert len(out) == len(EDGE) and all(r["taken"] % max(1, r["size"]) == 0 for r in out) and mix(edge.limit(0)).count() == 0
    assert mixed_documents(edge).columns == edge.columns


def test_embedding_links_match_brute_force(spark):
    from propensio.llm.embedding_dedup import embedding_duplicates

    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 32))
    near = x[:60] + 0.06 * rng.normal(size=(60, 32)) * np.linalg.norm(x[:60], axis=1, keepdims=True) / 2
    x = np.concatenate([x, near, x[:20]])
    label = [int(i) % 2 for i in range(300)] + [int(i) % 2 for i in range(60)] + [int(i) % 2 for i in range(20)]
    rows = [(i, v.tolist(), n) for i, (v, n) in enumerate(zip(x, label, strict=True))]
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = (unit @ unit.T >= 0.93) & (np.array(label)[:, None] == np.array(label)[None, :])
    np.fill_diagonal(linked, False)
    odd = [(900, None, 0), (901, [0.0] * 32, 0), (902, [float("nan")] + [1.0] * 31, 0), (903, [1.0] * 32, None), (904, [None] * 32, 0), (905, [], 1)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int").withColumn("links", F.lit("x"))
    got = {r["vec_id"]: r for r in embedding_duplicates(df).collect()}
    want = linked.sum(1)
    found = sum(got[i]["n_links"] for i in range(len(rows)))
    assert found >= 0.9 * want.sum() > 0 and all(got[i]["n_links"] <= want[i] for i in range(len(rows)))
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i, _, _ in odd) and got[360]["component_id"] == 0
    assert embedding_duplicates(df.limit(0)).count() == 0


def test_language_id_held_out(spark, docs, edge):
    from propensio.llm.langid import identify, learn_dictionaries

    mid = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.expr("crc32(cast(doc_id as string)) % 5 = 0")
    d = learn_dictionaries(mid.where(~held))
    got = identify(mid.where(held), d).join(mid.select("doc_id", "lang"), "doc_id").toPandas()
    assert (got.lang_pred == got.lang).mean() > 0.93 and got.score.between(0, 1).all()
    by = {r["doc_id"]: r for r in identify(edge, d).collect()}
    assert [by[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and by[6]["lang_pred"] != "und"
    assert all(r["lang_pred"] == "und" for r in identify(edge, learn_dictionaries(edge.limit(0))).collect())


def test_kneser_ney_sums_to_one_and_rejects_junk(spark, edge):
    from propensio.llm.quality_lm import ORDER, SYMBOLS, judge, log_table, train

    rows = [(i, f"the small house number {i} stands near the river and the trees are green in the summer of {i * 7}", "en") for i in range(200)]
    p = np.exp(log_table(train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))).astype(np.float64))
    assert np.allclose(p.reshape(SYMBOLS ** (ORDER - 1), SYMBOLS).sum(1), 1, atol=1e-3)
    junk = [(900, "!!|| XQ## ZZ!! " * 9, "en"), (901, None, "en"), (902, "", None)]
    df = spark.createDataFrame(rows + junk, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in judge(df, df.where("doc_id % 2 = 0 and doc_id < 200").select("doc_id")).collect()}
    assert not got[900]["kept"] and got[901]["perplexity"] is None and sum(got[i]["kept"] for i in range(200)) > 150
    assert judge(edge, edge.select("doc_id").limit(0)).where("kept").count() == 0 and judge(edge.limit(0), edge.select("doc_id")).count() == 0


def test_shared_id_with_two_texts_keeps_both(spark):
    from propensio.llm.near_dup import keep_one_per_group

    one, two, copied = (" ".join(f"{k}{i}" for i in range(40)) for k in "abc")
    rows = [(1, one), (1, two), (2, copied), (2, one), (2, one), (3, copied), (4, two), (None, one)]
    got = keep_one_per_group(spark.createDataFrame(rows, "doc_id long, text string"))
    kept = sorted(((r["doc_id"] or 0, r["text"]) for r in got.collect()))
    assert got.columns == ["doc_id", "text"]
    assert [t for d, t in kept if d].count(one) == 1 and {t for d, t in kept if d} == {one, two, copied}
    assert len(kept) == 4 and (0, one) in kept


def test_decontamination_tolerates_substitutions(spark, docs, edge):
    from propensio.llm.decontaminate import contaminated_pairs, decontaminated

    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    texts = {r["item_id"]: r["text"] for r in bench.collect()}
    item = next(i for i, t in sorted(texts.items()) if len(t.split()) >= 30)
    w = texts[item].split()
    w[7] = w[19] = "substituted"
    planted = [(9001, "Some lead text. " + texts[item] + " and an end", "en", "s", 1), (9002, "before " + " ".join(w) + " after", "en", "s", 1), (9003, None, "en", "s", 1), (9004, "short text", None, None, 1)]
    df = spark.createDataFrame(planted, "doc_id long, text string, lang string, source string, item int")
    got = {(r["doc_id"], r["item_id"]) for r in contaminated_pairs(df, bench).collect()}
    assert (9001, item) in got and (9002, item) in got and {d for d, _ in got} == {9001, 9002}
    assert sorted(r["doc_id"] for r in decontaminated(df, bench).collect()) == [9003, 9004]

    def tokens(t):
        return [x for x in re.split(r"[\W_]+", (t or "").lower()) if x]

    runs = {}
    for i, t in texts.items():
        b = tokens(t)
        for k in range(len(b) - 11):
            runs.setdefault(tuple(b[k : k + 12]), set()).add(i)
    want = {(r["doc_id"], i) for r in docs.collect() for k in range(len(tokens(r["text"])) - 11) for i in runs.get(tuple(tokens(r["text"])[k : k + 12]), ())}
    assert want <= {(r["doc_id"], r["item_id"]) for r in contaminated_pairs(docs, bench).collect()}
    assert decontaminated(edge, bench.limit(0)).count() == len(EDGE)


def test_decontamination_masks_cover_every_pattern():
    """However the disagreeing tokens of a stretch lie, a mask fits between them."""
    from itertools import combinations

    from propensio.llm.decontaminate import MASKS

    for length, wrong in ((9, 2), (12, 3), (16, 4), (20, 5)):
        placed = [sum(1 << (o + at) for o in mask) for mask in MASKS for at in range(length - mask[-1])]
        assert all(any(not bad & p for p in placed) for bad in (sum(1 << i for i in c) for c in combinations(range(length), wrong)))


def test_decontamination_is_the_full_comparison(spark):
    from propensio.llm.decontaminate import contaminated_pairs, decontaminated, find_overlaps

    def words(k, n):
        return [f"{k}w{i}" for i in range(n)]

    def changed(tokens, at):
        return ["other" if i in at else w for i, w in enumerate(tokens)]

    items = {1: words("a", 50), 2: words("b", 30), 3: words("c", 9), 4: words("d", 10), 5: words("e", 11), 6: words("f", 8)}
    lead, tail = [f"lead{i}" for i in range(9)], [f"tail{i}" for i in range(9)]
    rng = random.Random(5)
    docs = {
        "middle replaced": changed(items[1], range(20, 35)),
        "each fifth": changed(items[2][:25], range(0, 25, 5)),
        "each fourth": changed(items[2][:24], range(3, 24, 4)),
        "nine": changed(items[3], (2, 6)), "ten": changed(items[4], (0, 5)), "eleven": changed(items[5], (4, 10)),
        "nine spoilt": changed(items[3], (2, 4, 6)), "eight": items[6], "apart": changed(items[2][:16], range(4, 12, 2)),
        "run of eight": items[2][4:12],
        **{f"fifteen {k}": changed(items[2][5:20], rng.sample(range(15), 2)) for k in range(40)},
        **{f"twenty {k}": changed(items[1][7:27], rng.sample(range(20), rng.choice((4, 5, 6, 7, 8)))) for k in range(60)},
    }
    docs = {k: lead + w + tail for k, w in docs.items()}

    def overlaps(d, b):
        least = min(12, len(b))
        for shift in range(1 - len(b), len(d)):
            lo, hi = max(0, shift), min(len(d), shift + len(b))
            sums = [0]
            for i in range(lo, hi):
                sums.append(sums[-1] + (d[i] == b[i - shift]))
            if sums[-1] >= 7 and any(4 * (sums[y] - sums[x]) >= 3 * (y - x) for x in range(hi - lo + 1) for y in range(x + least, hi - lo + 1)):
                return True
        return False

    want = {(k, i) for k, d in docs.items() for i, b in items.items() if len(b) >= 9 and overlaps(d, b)}
    # items of one to eight tokens count where they stand whole
    want |= {(k, i) for k, d in docs.items() for i, b in items.items() if len(b) < 9 and any(d[j : j + len(b)] == b for j in range(len(d) - len(b) + 1))}
    assert ("eight", 6) in want
    assert {("middle replaced", 1), ("each fifth", 2), ("each fourth", 2), ("nine", 3), ("ten", 4), ("eleven", 5), ("apart", 2)} <= want
    assert {(f"fifteen {k}", 2) for k in range(40)} <= want and not {"nine spoilt", "run of eight"} & {k for k, _ in want}
    df = spark.createDataFrame([(k, " ".join(w)) for k, w in docs.items()], "doc_id string, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in contaminated_pairs(df, bench).collect()}
    assert set(got) == want
    assert (got["middle replaced", 1].span, got["middle replaced", 1].matched) == (20, 20)
    assert all(r.matched >= 0.75 * r.span and r.span >= min(9, len(items[r.item_id])) for r in got.values())
    assert {r["doc_id"] for r in decontaminated(df, bench).collect()} == set(docs) - {k for k, _ in want}
    at = find_overlaps(df.where("doc_id = 'middle replaced'"), bench).collect()
    assert [(r["first"], r["item_first"]) for r in at] == [(9, 0)]


def test_license_scan(spark, edge):
    from propensio.llm.licenses import TEMPLATES, scan_licenses

    filler = " ".join(f"w{i}" for i in range(70))
    rows = [(i, f"{filler[: 37 * i]} {t.upper()}. {filler}") for i, t in enumerate(TEMPLATES.values())] + [(99, filler), (98, None)]
    got = {(r["doc_id"], r["license"]) for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {(i, n) for i, n in enumerate(TEMPLATES)} <= got and not {98, 99} & {d for d, _ in got}
    assert scan_licenses(edge).count() == 0


def test_license_families_versions_and_bodies(spark):
    """Notices and versions that are not copied from the data, each reported as itself only."""
    from propensio.llm.license_texts import BODIES, wordings
    from propensio.llm.licenses import scan_licenses

    filler = " ".join(f"w{i}" for i in range(70))
    long = {n: t for n, t in wordings() if len(t) > 5000}
    notices = {
        "MIT": ["Licensed under the MIT License.", "This project is licensed under the MIT license"], "ISC": ["distributed under the ISC License"],
        "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2", "released under GPLv2", "under the terms of the GNU GPL v2"],
        "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3"], "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3"],
        "AGPL-3.0": ["licensed under the GNU Affero General Public License v3.0"], "CC0-1.0": ["Released under CC0 1.0 Universal"], "CC-BY-SA-3.0": ["licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License"],
        "CC-BY-NC-SA-4.0": ["available under CC BY-NC-SA 4.0"], "Apache-1.1": ["Licensed under the Apache License, Version 1.1"], "Unlicense": [dict(BODIES)["Unlicense"]],
        "LGPL-2.1": [long["LGPL-2.1"]], "MPL-1.1": [long["MPL-1.1"]],
    }
    rows = [(i, name, f"{filler} {t} {filler}") for i, (name, t) in enumerate((n, t) for n, ts in notices.items() for t in ts)]
    rows += [(90, None, f"{filler} subject to the general public in terms of the license version {filler}")]
    got = {}
    for r in scan_licenses(spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, text string")).collect():
        got.setdefault(r["doc_id"], set()).add(r["license"])
    assert {i: got.get(i) for i, _, _ in rows} == {i: {name} if name else None for i, name, _ in rows}


def test_pipeline_stages(spark):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, SF).toPandas()
    per = rows.groupby("shard").slot.agg(["count", "nunique"])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "mixing", "sharding"]
    assert len(rows) and (per["count"] == per["nunique"]).all() and per["count"].max() - per["count"].min() <= 1
