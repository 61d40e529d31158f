import duckdb
from cases import awkward, clashing, empty, rows_of
from pyspark.sql import functions as F

from sensoria.llm import language

DOCS = "/root/testdata/sf0.01/documents.parquet"


def test_held_out_accuracy_and_contract(spark):
    found = language.op4_language(spark, "/root/testdata/sf0.01").toPandas()
    truth = duckdb.sql(f"SELECT doc_id, lang FROM '{DOCS}'").df().merge(found, on="doc_id")
    held = truth[truth.held_out]
    assert len(found) == len(truth) and 0.2 < truth.held_out.mean() < 0.5
    assert (held.lang == held.lang_pred).mean() > 0.99
    assert found.score.between(0, 1).all()


def test_codewords_are_apart():
    for count in (2, 3, 4, 5, 9, 40):
        codes = language.codewords(count, 15, 7)
        assert len({tuple(row) for row in codes.tolist()}) == count
        assert (abs(codes.sum(axis=0)) < count).all()


def test_awkward_rows(spark):
    model = language.train(spark.read.parquet(DOCS))
    found = language.identify(clashing(awkward(spark)), model)
    rows = [(r.doc_id, r.lang_pred, r.score) for r in found.collect()]
    assert len(rows) == 11
    und = {doc for doc, lang, _ in rows if lang == language.UNKNOWN}
    assert und == {3, 4, 5, 6}
    assert [r for r in rows if r[0] == 2][0] == [r for r in rows if r[0] == 2][1]
    assert language.identify(empty(spark), model).count() == 0
    assert {r[0] for r in rows_of(language.keep_identified(awkward(spark), model))}.isdisjoint(und)


def test_no_training_rows(spark):
    model = language.train(empty(spark))
    assert {r.lang_pred for r in language.identify(awkward(spark), model).collect()} == {language.UNKNOWN}
    one = language.train(awkward(spark).where("lang = 'en'"))
    letters = language.identify(awkward(spark), one).where(F.col("doc_id") == 1).first()
    assert letters.lang_pred == "en"


RUSSIAN = "Съешь же ещё этих мягких французских булок, да выпей чаю, пока погода хорошая и дети играют во дворе. " * 4
GREEK = "Ξεσκεπάζω την ψυχοφθόρα βδελυγμία και γράφω μικρές προτάσεις για τη γλώσσα της πόλης μας σήμερα. " * 4
NOISE = "xqzk jvwq gfhjk kjhzx wqpzx vbnmq zxcvq hjklw qqzzx pwxvk jjqxz kkvwz xzqjk wvqpx zqkjx vwkqz " * 6


def test_mixtures_and_unlearned_languages_are_ambiguous(spark):
    docs = spark.read.parquet(DOCS)
    model = language.train(docs.where(language.remainder(3) != 1))
    held = docs.where(language.remainder(3) == 1).where("n_chars > 1200").orderBy("doc_id").collect()
    by = {lang: [r.text for r in held if r.lang == lang] for lang in ("en", "de", "fr", "es")}
    mixed = []
    for one in by:
        for other in by:
            if one < other:
                for a, b in zip(by[one][:8], by[other][:8]):
                    size = min(len(a), len(b), 4000) // 2
                    mixed.append(a[:size] + "\n" + b[:size])
    rows = [(i, t) for i, t in enumerate(mixed)] + [(1000, RUSSIAN), (1001, GREEK), (1002, NOISE)]
    rows += [(2000 + i, t) for i, t in enumerate(t for lang in by for t in by[lang])]
    found = {r.doc_id: r for r in language.identify(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert all(found[i].ambiguous and found[i].score < 0.6 for i in (1000, 1001, 1002))
    flagged = [found[i].ambiguous for i in range(len(mixed))]
    assert len(mixed) > 30 and sum(flagged) >= 0.9 * len(mixed)
    pure = [found[i].ambiguous for i in found if i >= 2000]
    assert sum(pure) <= 0.01 * len(pure)


def test_every_language_is_learned(spark):
    rows = [(i, f"lang{i % 80:02}", " ".join(f"{chr(97 + i % 80 % 26)}{chr(97 + i % 80 // 26)}w{j}" for j in range(30))) for i in range(1600)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    model = language.train(docs)
    assert len(model.languages) == 80
    found = language.identify(docs, model).collect()
    assert sum(r.lang == r.lang_pred for r in docs.join(spark.createDataFrame(found).select("doc_id", "lang_pred"), "doc_id").collect()) > 1500


def test_decoding_against_plain_sums(spark):
    """The same decision from sums over words, text by text."""
    import numpy as np

    docs = spark.read.parquet(DOCS).where("doc_id < 120")
    model = language.train(spark.read.parquet(DOCS))
    table = language._word_features(model.weights, model.typical, model.settings)
    for r in language.identify(docs, model).collect():
        words = r.text.encode().lower().split()
        if r.lang_pred == language.UNKNOWN:
            continue
        odds = table(words).astype(float).sum(axis=0)[:-1]
        bits = np.tanh(odds / (4 * np.sqrt(len(words))))
        share = model.reliability / model.reliability.sum()
        loss = [sum(np.log1p(np.exp(-2 * bits * code)) * share) for code in model.codes]
        assert model.languages[int(np.argmin(loss))] == r.lang_pred
