"""The quality model knows characters of any script by the characters before them."""

import itertools
from collections import Counter

import numpy as np

from propensio.llm import quality_lm
from propensio.llm.quality_lm import POINTS, SYMBOLS, _alphabet, _character_grams, _character_model, _CharacterTables, _grams, _padded, _points, character_logs, counted, judge, log_table, train


def test_letters_of_any_script_are_known_in_their_contexts(spark):
    known = "река течёт мимо дома и леса"
    mixed = "".join(w[::-1] for w in known.split(" ")) + " ".join(["меро", "тиёч"])  # the same letters in another order
    texts = [known, known[::-1], "漢字仮名交じり文", "字漢名仮り交文じ"]
    rows = [(i, known, "ru") for i in range(40)] + [(100 + i, t, None) for i, t in enumerate([*texts, mixed])] + [(60, "漢字仮名交じり文", "ja")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["perplexity"] for r in judge(df, df.where("doc_id < 61").select("doc_id")).collect()}
    assert 2 * got[100] < min(got[101], got[104]) and 2 * got[102] < got[103]


def test_joined_perplexities_equal_those_of_the_lookup(spark, monkeypatch):
    texts = ["the small house", "річка 漢字 \U0001f600 É", "the the house 24", None, "", "the small house", "ZZ!! unseen ϸ 1907", "a", "\U0010ffff￾"]
    df = spark.createDataFrame([(i % 7, t, "en" if i % 2 else None) for i, t in enumerate(texts)], "doc_id int, text string, lang string")

    def judged():
        rows = judge(df, df.where("text like 't%' or text like 'р%'").select("doc_id")).collect()
        return sorted(((r["doc_id"], r["lang"] or "", r["n_chars"], r["perplexity"] or -1.0, r["kept"]) for r in rows))

    looked_up = judged()
    monkeypatch.setattr(quality_lm, "LOOKUP_GRAMS", 0)
    joined = judged()
    assert len(joined) == len(texts) and [r[:3] + r[4:] for r in joined] == [r[:3] + r[4:] for r in looked_up]
    assert np.allclose([r[3] for r in joined], [r[3] for r in looked_up], rtol=1e-5)


def test_probabilities_after_any_context_sum_to_one(spark):
    df = spark.createDataFrame([("the small house",), ("річка 漢字",), ("Hat, 漢!",)], "text string")
    counts = counted(df)
    tables, logs = _CharacterTables(_character_model(counts)), (log_table(train(df)), character_logs(counts))
    table, every = _alphabet(), np.setdiff1d(np.arange(POINTS, dtype=np.uint32), _points("123456789"))
    for context in ("the", " 漢"):
        head = _points(context)
        runs = np.concatenate([np.full((len(every), 3), POINTS), np.tile(head, (len(every), 1)), every[:, None]], axis=1).astype(np.uint32)
        a, b = tables.parts(runs.ravel())[:, len(head) :: len(head) + 1]
        first = {k: every[np.flatnonzero(table[every] == k)[0]] for k in np.unique(table[every])}
        log = np.array([_grams(np.append(head, first.get(k, first[1])).astype(np.uint32), table)[-1] for k in range(SYMBOLS)])
        floor = np.exp(logs[0][log[table[every]]] + np.where(every == ord("0"), 0.0, logs[1][every]))
        assert 0.99 < (a + b * floor).sum() < 1 + 1e-6  # the class of the padding keeps a little


def test_n_grams_of_characters_are_counted_whole():
    texts = ["abcabcabc", "漢字abc", "a"]
    want = Counter(g for t in texts for g in zip(*(([POINTS] * 3 + [ord(c) for c in t])[k:] for k in range(4))))
    grams = next(_character_grams(_padded([_points(t) for t in texts])))
    got = {((b >> 42), (b >> 21) & 0x1FFFFF, b & 0x1FFFFF, g): n for b, g, n in zip(grams["before"], grams["gram"], grams["n"])}
    assert got == dict(want)
    long = "".join(map(chr, itertools.chain(range(0x100, 0xD000), range(0xE000, 0x20000))))
    assert sum(int(part["n"].sum()) for part in _character_grams(_padded([_points(long)]))) == len(long)
