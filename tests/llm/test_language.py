"""Language identification: kernel against sets, fit against the exact formula, accuracy on documents held out."""

import collections
import unicodedata
import zlib

import numpy as np
import pytest

from pyspark.sql import functions as F
from tillstone.llm import language, queries


def grams(text):
    words = "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in text.lower()).split()
    run = " " + " ".join(words) + " " if words else " "
    return {run[i:i + n] for n in (1, 2, 3) for i in range(len(run) - n + 1)} - {" "}


TEXTS = ["", " \n", "a", "Hello, World!", "hello world", "The cat\nsat; on 3 mats", "été ÉTÉ", "日本語 テキスト", "123 !!", "x" * 50, "a b c d", "नमस्ते दुनिया"]


def test_kernel_counts_shared_ngrams():
    rows, letters = language.presence(TEXTS)
    sets = [grams(t) for t in TEXTS]
    # Hashed places may meet; with so few n-grams almost none do.
    assert (np.abs(rows.sum(1) - [len(s) for s in sets]) <= 1).all()
    want = [[len(a & b) / max(1, np.sqrt(len(a) * len(b))) for b in sets] for a in sets]
    assert np.allclose(language.kernel(rows, rows), want, atol=0.02)
    assert letters.tolist() == [any(c.isalpha() for c in t) for t in TEXTS]


def test_a_row_does_not_depend_on_its_neighbours():
    whole = language.presence(TEXTS)[0]
    assert all((language.presence([t])[0][0] == r).all() for t, r in zip(TEXTS, whole))


def test_fit_with_all_texts_as_landmarks_is_kernel_ridge_regression():
    texts = ["the cat sat on the mat", "a dog and the house", "le chat est sur la table", "une maison avec des fleurs", "der hund und die katze", "ein haus mit garten"]
    langs = ["en", "en", "fr", "fr", "de", "de"]
    rows = language.presence(texts)[0]
    model = language.fit_rows(rows, langs, np.arange(6), ridge=0.01)
    gram = language.kernel(rows, rows).astype(float)
    target = np.where(np.array(langs)[:, None] == np.array(["de", "en", "fr"]), 1.0, -1.0)
    exact = gram @ np.linalg.solve(gram + 0.06 * np.eye(6), target)
    assert np.allclose(model.values(rows), exact, atol=1e-3)


def test_odd_texts(spark, odd_docs):
    none = odd_docs.withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in language.identify(none).collect()} == {("und", 0.0)}
    some = odd_docs.withColumn("lang", F.when(F.col("text").contains("same"), "en").when(F.col("text").contains("z"), "zz"))
    got = language.identify(some).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 for r in got)
    texts = {r.doc_id: r.text for r in odd_docs.collect()}
    for r in got:
        blank = not any(c.isalpha() for c in texts[r.doc_id] or "")
        assert (r.lang_pred == "und") == blank and (r.score == 0) == blank
        assert r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 5 == 0)


def test_empty_table(spark):
    assert language.identify(spark.createDataFrame([], "doc_id BIGINT, text STRING, lang STRING")).collect() == []


def test_only_fitted_documents_teach(spark):
    """Languages of held-out documents, and rows without one, teach nothing."""
    words = {"aa": "alpha beta gamma", "bb": "omega sigma kappa", "cc": "uno due tre"}
    rows = [(i, f"{words[lang]} {i % 3}", lang) for i, lang in enumerate(["aa", "bb"] * 40)]
    out = [i for i in range(1000, 1200) if zlib.crc32(str(i).encode()) % 5 == 0]
    rows += [(i, words["cc"], "cc") for i in out] + [(None, words["cc"], "cc"), (5000, words["aa"], None)]
    got = language.identify(spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING")).collect()
    assert {r.lang_pred for r in got} == {"aa", "bb"}
    assert all(r.lang_pred == rows[r.doc_id][2] for r in got if r.doc_id is not None and r.doc_id < 80)


def test_a_language_of_copies_is_learned(spark, monkeypatch):
    monkeypatch.setattr(language, "FIT_TEXTS", 16)
    rows = [(i, "the same copy", "en") for i in range(400)] + [(1000 + i, f"texte numero {i} ici", "fr") for i in range(300)]
    drawn = language.draw(spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING")).collect()
    assert collections.Counter(r.lang for r in drawn) == {"en": 1, "fr": 8}


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01"])
def test_accuracy_on_held_out_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = queries.op13_language(spark, folder).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    right, n = got.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 150 and right >= 0.97 * n
