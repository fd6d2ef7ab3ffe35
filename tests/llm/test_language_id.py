"""Language identification in the pipeline: what travels to Python workers, what model and threshold are made of."""
import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from retailq.llm import language_id

MODEL = language_id.LanguageModel({"aa": b"kala suomi talo vesi", "bb": b"strom haupt licht zeit"})
ROWS = [(1, "kala talo vesi suomi kala", "x"), (1, "Strom, Haupt, Licht!", None), (2, None, "y"), (None, "12 ?", "z"), (3, "zeit licht haupt strom zeit licht", "told")]


def test_only_letters_go_to_python_and_each_row_is_judged_once(spark):
    frame = spark.createDataFrame(ROWS, "doc_id long, text string, letters string").repartition(3)
    kept = language_id.keep_identified(frame, MODEL, 0.0)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" not in plan and plan.count("ArrowEvalPython") == 1  # no column of the rows goes there and back
    assert kept.columns == frame.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([ROWS[0], ROWS[1], ROWS[4]], key=str)
    got = language_id.identify(frame, MODEL, ["text", "letters", "doc_id"])
    assert got.columns == ["text", "letters", "doc_id", "lang_pred", "score"] and got.count() == len(ROWS)
    told = {r.text: r.lang_pred for r in got.collect()}
    assert told == {ROWS[0][1]: "aa", ROWS[1][1]: "bb", None: "und", "12 ?": "und", ROWS[4][1]: "bb"}


def _texts(spark):
    rng = np.random.default_rng(9)
    vocab = {"aa": ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(300)], "bb": ["".join(rng.choice(list("defghijkl"), 6)) for _ in range(300)]}
    weight = 1 / np.arange(1, 301)
    rows = [(i, " ".join(rng.choice(vocab[lang], 25, p=weight / weight.sum())), lang) for i, lang in enumerate(["aa", "bb"] * 150)]
    rows += [(1000 + i, " ".join(["copied", *(f"{chr(97 + k)}zz" for k in range(20))]), "aa") for i in range(40)]  # one text, many times
    rows += [(None, "noid words teach too", "bb"), (2000, "12 ?!", "aa"), (2001, None, "aa"), (2002, "untold", None)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)


def test_model_and_margin_come_from_all_rows(spark):
    rows, frame = _texts(spark)
    model, margin = language_id.narrow_margin(frame, 0.02, language_id.Settings(docs_per_language=5, held_out_docs=2))
    told = [(t, lang) for _, t, lang in rows if t and lang and t != "12 ?!"]
    for lang in ("aa", "bb"):  # every word of every text
        assert sorted(model.contents[lang].decode().split()) == sorted({w for t, own in told if own == lang for w in t.split()})
    known = frame.where("lang is not null and text rlike '[a-z]'").selectExpr("lang", "text as letters", "pmod(xxhash64(text), 2) as half").cache()
    halves = [language_id.counted_models(language_id._word_counts(known.where(F.col("half") == h)))[2] for h in (0, 1)]
    margins = []
    for r in known.collect():
        name, score = halves[1 - r.half].predict(r.letters)
        margins += [score] if name == r.lang else []
    assert len(margins) > 300 and 0 <= sorted(margins)[int(0.02 * len(margins))] - margin < 2 ** -36


def test_dictionaries_hold_the_words_of_most_texts(spark):
    rows, frame = _texts(spark)
    counts = language_id._word_counts(frame.where("lang is not null and text is not null").select("lang", F.col("text").alias("letters")))
    model = language_id.counted_models(counts, language_id.Settings(dictionary_bytes=700))[2]
    for lang in ("aa", "bb"):
        n = Counter(w for t in {t for _, t, own in rows if own == lang and t} for w in set(t.split()))
        held = model.contents[lang].decode().split()
        least = min(int(8 * math.log2(n[w]) + 1e-9) for w in held)
        assert len(held) == len(set(held)) and {w for w in n if int(8 * math.log2(n[w]) + 1e-9) > least} <= set(held)
        assert 500 < len(model.contents[lang]) < 900 and "copied" not in held
        assert [n[w] for w in held] == sorted(n[w] for w in held)


def test_lowest_margin_is_counted(spark):
    rng = np.random.default_rng(10)
    values = np.concatenate([rng.random(3000) ** 3, np.full(500, 0.25), [0.0, 1.0, 1.0]])
    frame = spark.createDataFrame([(float(v),) for v in values], "score double")
    for share in (0.0, 0.005, 0.5, 0.7, 0.9999):
        assert 0 <= np.sort(values)[int(share * len(values))] - language_id._lowest(frame, share) < 2 ** -36
    assert language_id._lowest(frame.limit(0), 0.5) == 0.0
