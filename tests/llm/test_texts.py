"""Licenses, language and toxicity against plain versions and held-out rows."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm_helpers import awkward_rows, documents, plain
from shelfcast.llm import langid, licenses, toxicity
from shelfcast.llm.rows import table


def _license_words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def _base(text):
    w = _license_words(text)
    places = []
    for label, phrase in licenses.BASE:
        p = phrase.split(" ")
        places += [(j, label) for j in range(len(w)) if w[j : j + len(p)] == p]
    starts = [j for j, _ in places]
    return len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({b for _, b in places}))


LICENSE_TEXTS = [
    "Licensed under CC BY-NC 4.0.",
    "all RIGHTS reserved; All rights-reserved! all rights all rights reserved",
    "GNU General\nPublic\tLicense general public license",
    "Released under the MIT License. This work is licensed under the GNU General Public License, version 3.",
    "ccby cc-by cc by cc",
    "cc  by",
    "Ünder cc by é",
    "Licensed under the very Apache License, Version 2.0",
    "licensed and apache version and license",
    "Permission is hereby granted, free of charge, to any single person obtaining a copy of this software and its documentation files",
    "cc by " * 3000,
    "-- all rights reserved --",
]


def test_licenses_equal_a_word_by_word_scan(spark):
    rows = [(500 + k, t, None, None) for k, t in enumerate(LICENSE_TEXTS)] + awkward_rows()
    rows += [rows[0], rows[0], (None, LICENSE_TEXTS[1], None, None)]
    found = licenses.scan_licenses(documents(spark, rows)).collect()
    assert plain(r[:6] for r in found) == plain((i, *_base(t)) for i, t, *_ in rows)
    labels = {r.doc_id: r.labels.split(",") for r in found}
    assert labels[500] == ["cc-by", "cc-by-nc-4.0"] and labels[503] == ["gpl", "gpl-3.0", "mit"]
    assert labels[507] == ["apache-2.0"] and labels[508] == [""] and labels[509] == ["mit"]
    score = {r.doc_id: r.score for r in found}
    assert score[500] == 1 and score[508] == 0 and 0.7 <= score[509] < 1 and score[7] == 0


def test_licenses_of_the_table(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    found = licenses.scan_licenses(table(spark, sf_dir, "documents")).collect()
    assert plain(r[:6] for r in found) == plain((r.doc_id, *_base(r.text)) for r in rows)


# ---- language -----------------------------------------------------------------------------------


def _gram_list(text):
    runs = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    counts = Counter()
    for run in runs:
        padded = " " + run + " "
        for n in (1, 2, 3):
            counts.update(g for j in range(len(padded) - n + 1) if (g := padded[j : j + n]) != " ")
    return counts


def _code(gram):
    code = 0
    for c in gram:
        code = code << 21 | (1 if c == " " else ord(c))
    return code


def _top(counts):
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], _code(x[0])))[: langid.PROFILE]]


def test_language_equals_profiles_compared_in_python(spark):
    rows = awkward_rows()
    df = documents(spark, rows)
    profiles = langid.learn_profiles(df)
    by_lang = {}
    for _, text, lang, _ in rows:
        if lang and text is not None:
            by_lang.setdefault(lang, Counter()).update(_gram_list(text))
    want_profiles = {k: _top(v) for k, v in by_lang.items()}
    assert {k: v.tolist() for k, v in profiles.items()} == {k: [_code(g) for g in v] for k, v in want_profiles.items()}
    want = []
    for i, text, *_ in rows:
        grams = _top(_gram_list(text))
        if not grams:
            want.append((i, "und", 0.0))
            continue
        best = min(
            (sum(abs(p.index(g) - k) if g in p else langid.PROFILE for k, g in enumerate(grams)), lang)
            for lang, p in want_profiles.items()
        )
        want.append((i, best[1], 1 - best[0] / (langid.PROFILE * len(grams))))
    found = langid.predict_language(df, profiles)
    assert found.select("row.*").columns == df.columns
    assert plain(found.select("row.doc_id", "lang_pred", "score").collect()) == plain(want)


def test_language_without_profiles_or_rows(spark):
    assert langid.learn_profiles(documents(spark, [])) == {}
    found = langid.predict_language(documents(spark, [(1, "text", None, None)]), {}).collect()
    assert [(r.lang_pred, r.score) for r in found] == [("und", 0.0)]
    assert langid.predict_language(documents(spark, []), {}).count() == 0


def test_language_of_held_out_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    profiles = langid.learn_profiles(docs.filter(langid.learnable()))
    found = langid.predict_language(docs, profiles).filter(langid.held_out("row.doc_id")).select("row.*", "lang_pred").collect()
    assert len(found) > 200 and all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in found)
    assert sum(r.lang == r.lang_pred for r in found) / len(found) > 0.97


# ---- toxicity -----------------------------------------------------------------------------------


def test_toxicity_of_held_out_documents(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.1", n) for n in ("documents", "labels"))
    part = F.crc32(F.col("doc_id").cast("string")) % 4
    chain = toxicity.fit_chain(docs, labels.filter(part != 2), ["quality", "toxic"])
    assert [m.numFeatures for m in chain.models] == [len(chain.words), len(chain.words) + 1]
    scored = toxicity.score_chain(docs, chain, ["quality", "toxic"]).join(labels.filter(part == 2), "doc_id").collect()
    toxic = [r for r in scored if r.toxic]
    clean = [r for r in scored if not r.toxic]
    assert len(toxic) >= 50 and sum(r.p_toxic >= 0.5 for r in toxic) / len(toxic) > 0.75
    assert sum(r.p_toxic >= 0.5 for r in clean) / len(clean) < 0.01


def test_toxicity_of_awkward_tables(spark):
    rng = random.Random(9)
    rows = awkward_rows()
    marks = [(i, rng.randint(0, 1), None if i == 1 else rng.randint(0, 1)) for i, *_ in rows] + [(9999, 1, 1), (2, 1, 0)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int").selectExpr("*", "1 AS text", "2 AS fold")
    found = toxicity.predict_toxicity(documents(spark, rows), labels).collect()
    assert plain((r.doc_id,) for r in found) == plain((i,) for i, *_ in rows)
    assert all(0 <= r.p_toxic <= 1 and 0 <= r.p_quality <= 1 for r in found)
    none = toxicity.predict_toxicity(documents(spark, rows), labels.limit(0)).collect()
    assert len(none) == len(rows) and all(r.p_toxic is None and not r.flagged for r in none)
    one = labels.withColumn("toxic", F.lit(0))
    assert not any(r.flagged for r in toxicity.predict_toxicity(documents(spark, rows), one).collect())
    assert toxicity.predict_toxicity(documents(spark, []), labels.limit(0)).count() == 0


def test_pipeline_drops_texts_without_any_known_n_gram(spark):
    rows = [(k, f"these are plain english words number {k} of a short text", "en", "s") for k in range(40)]
    rows += [(100, "это русский текст", None, "s"), (101, "日本語の文章です", None, "s"), (102, "123", "en", "s"), (103, None, "en", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    left = corpus_pipeline.keep_known_languages(spark, docs, "").collect()
    assert sorted(r.doc_id for r in left) == list(range(40))
