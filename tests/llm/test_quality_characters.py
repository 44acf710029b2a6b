"""Every character counts by itself in the quality model, also outside the alphabet of its classes."""

import numpy as np

from propensio.llm.quality_lm import POINTS, SYMBOLS, _alphabet, character_logs, counted, judge


def test_characters_of_a_class_are_told_apart(spark):
    known, other = "река течёт мимо дома и леса", "ϸϡϟϙϗϱ ϐϕϖϰϱϲ ϳϡϟ ϸϡϙϗ ϰ ϕϖϱϲ"
    rows = [(i, known, "ru") for i in range(40)] + [(50, other, "ru"), (51, known.replace("река", "леса"), "ru"), (52, "中文中文", "zh"), (53, "한글한글", "zh")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["perplexity"] for r in judge(df, df.where("doc_id < 40 or doc_id = 52").select("doc_id")).collect()}
    assert got[50] > 2 * got[51] and got[53] > got[52]  # each pair has the same classes, or nearly so


def test_character_probabilities_sum_to_one_in_every_class(spark):
    df = spark.createDataFrame([("Ab b 012 345 6789 äö 漢字漢 \U0001f600",), (None,), ("",)], "text string")
    counts = counted(df)
    p = np.exp(character_logs(counts).astype(np.float64))
    assert len(p) == POINTS and np.allclose(np.bincount(_alphabet(), p, SYMBOLS)[1:], 1, atol=1e-3)
    assert p[ord("漢")] > p[ord("字")] > p[ord("中")] > 0
    assert np.allclose(np.bincount(_alphabet(), np.exp(character_logs(counts.limit(0)).astype(np.float64)), SYMBOLS)[1:], 1, atol=1e-3)
