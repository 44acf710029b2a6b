"""License scan against full containment, long repeated notices; mixing of repeated rows."""

import random
import time

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def plain_scan(text, templates, least=0.8):
    """Every window of every template, by sets of words; templates share no words, so nothing explains anything."""
    words = text.split()
    out = []
    for name, wording in templates.items():
        t = wording.split()
        own = {tuple(t[i : i + 3]) for i in range(len(t) - 2)}
        window = max(8, 1 << (2 * len(t) - 1).bit_length())
        last = None
        for s in range(0, max(1, len(words) - 2 - (window - 2) + window // 2), window // 2):
            part = words[s : s + window]
            share = len(own & {tuple(part[i : i + 3]) for i in range(len(part) - 2)}) / len(own)
            if share < least:
                continue
            end = min(s + window, len(words))
            if last and s <= last[1]:
                last[1], last[2] = max(last[1], end), max(last[2], share)
            else:
                last = [s, end, share]
                out.append((name, last))
    return sorted((n, m[0], m[1] - m[0], round(m[2], 9)) for n, m in out)


def test_scan_equals_full_containment_on_random_texts(spark):
    from propensio.llm.licenses import scan_licenses

    rnd = random.Random(2)
    templates = {f"L{k}": " ".join(f"w{k}x{i}" for i in range(n)) for k, n in enumerate((5, 9, 30, 90))}
    rows = []
    for i in range(120):
        words = [f"f{rnd.randint(0, 300)}" for _ in range(rnd.randint(3, 400))]
        for _ in range(rnd.randint(0, 4)):
            t = templates[rnd.choice(list(templates))].split()
            t = [w if rnd.random() > rnd.choice((0, 0.03, 0.1)) else "changed" for w in t]
            at = rnd.randint(0, len(words))
            words[at:at] = t
        rows.append((i, " ".join(words)))
    got = {}
    for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"), templates).collect():
        got.setdefault(r["doc_id"], []).append((r["license"], r["first_word"], r["n_words"], round(r["containment"], 9)))
    want = {i: w for i, t in rows if (w := plain_scan(t, templates))}
    assert {i: sorted(m) for i, m in got.items()} == want and len(want) > 60


def test_ten_thousand_repeated_notices_and_long_texts_take_seconds(spark):
    from propensio.llm.licenses import scan_licenses

    notices = ["Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "This work is licensed under the GNU General Public License, version 3."]
    rows = [(1, " ".join(f"{notices[i % 3]} Part {i % 7}." for i in range(10_000))), (2, notices[0] * 1), (3, "plain words of no license " * 100_000), (4, ""), (5, None)]
    start = time.time()
    got = scan_licenses(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    assert time.time() - start < 90
    assert {r["license"] for r in got if r["doc_id"] == 1} >= {"MIT", "Apache-2.0", "GPL-3.0"} and {r["doc_id"] for r in got} == {1, 2}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert scan_licenses(df.limit(0)).count() == 0
    twice = scan_licenses(df.where("doc_id = 2").unionByName(df.where("doc_id = 2"))).collect()
    assert len(twice) == 2 and twice[0] == twice[1]


@pytest.mark.parametrize("copies", [6, 300])
def test_repeated_rows_take_their_own_share(spark, copies):
    from propensio.llm.mixing import mix, mixed_documents

    rows = [(1, "a b c d", "x")] * copies + [(2, "e f g", "x")] * 3 + [(10 + i, "one two three " * (1 + i % 5), "y") for i in range(40)] + [(None, "h i", "x"), (None, "h i", "x"), (7, "a b c d", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    for name in ("_id", "_size", "_copy", "_copies", "id", "size", "row", "picked", "rows"):
        df = df.withColumn(name, F.lit("x"))
    plan = mix(df).collect()
    assert len(plan) == len(rows)
    targets = {r["source_size"]: r["target"] for r in plan}
    taken, longest = {}, 0
    for r in plan:
        taken[r["source_size"]] = taken.get(r["source_size"], 0) + r["taken"]
        longest = max(longest, r["size"])
        assert r["taken"] <= 3 * r["size"] and r["taken"] % max(1, r["size"]) == 0
    assert all(abs(taken[s] - targets[s]) <= longest for s in targets)
    out = mixed_documents(df)
    assert out.columns == df.columns and {r["_copy"] for r in out.collect()} == {"x"}
    from propensio.llm.mixing import word_count

    assert out.agg(F.sum(word_count(F.col("text")))).collect()[0][0] == sum(taken.values())
    again = sorted((r["doc_id"] or 0, r["size"], r["taken"]) for r in mix(df.repartition(7)).collect())
    assert again == sorted((r["doc_id"] or 0, r["size"], r["taken"]) for r in plan)
    assert mixed_documents(df.limit(0)).count() == 0 and mix(df.limit(0)).count() == 0


def test_short_benchmark_items_are_found_whole(spark):
    from propensio.llm.decontaminate import contaminated_pairs, decontaminated

    items = [(1, "seven words make up this short question"), (2, "Yes!"), (3, "two words"), (4, ""), (5, None), (6, "one of exactly eight tokens in this item")]
    docs = [
        (1, "He asked: seven words make up this SHORT question?"), (2, "seven words make up this long question"), (3, "oh yes"), (4, "two plus words"), (5, "these are two words."), (6, None), (7, ""),
        (8, "here is one of exactly eight tokens in this item too"), (9, "yesterday"),
    ]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["matched"], r["span"]) for r in contaminated_pairs(d, b).collect()}
    assert got == {(1, 1, 7, 7), (3, 2, 1, 1), (5, 3, 2, 2), (8, 6, 8, 8)}
    assert {r["doc_id"] for r in decontaminated(d, b).collect()} == {2, 4, 6, 7, 9}
    assert decontaminated(d, b.limit(0)).count() == 9 and decontaminated(d.limit(0), b).count() == 0 and contaminated_pairs(d.limit(0), b).count() == 0


def test_languages_of_short_texts_are_learned(spark):
    from propensio.llm.langid import identify, learn_dictionaries

    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("where is the house", "en"), ("le chat et le chien", "fr"), ("ou est la maison", "fr")] * 20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = learn_dictionaries(df)
    assert set(found) == {"en", "fr"}
    out = {r["doc_id"]: r["lang_pred"] for r in identify(df, found).collect()}
    assert sum(out[i] == lang for i, _, lang in rows) >= 70
    assert identify(df.limit(0), found).count() == 0 and learn_dictionaries(df.limit(0)) == {}


def test_vectors_of_extreme_size_link(spark):
    from propensio.llm.embedding_dedup import embedding_duplicates

    rows = [(1, [1e200, 1e200], 0), (2, [1e200, 1.01e200], 0), (3, [1e-200, 1e-200], 0), (4, [1.0, -1.0], 0), (5, [1e-300, -1.01e-300], 0), (6, [5e-324, 0.0], 0)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (1, 4), 5: (1, 4), 6: (0, 6)}
