"""Held-out accuracy, and what rejects."""

import pytest
from pyspark.sql import functions as F

from tablehandoff.llm import language

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    made = language.learn(docs.where(~held))
    assert list(made)[0] == "en" and set(made) == {"en", "de", "es", "fr"}
    assert all(len(v) <= language.DICTIONARY_BYTES for v in made.values())
    got = language.identify(docs.where(held), made).collect()
    right = sum(r.lang == r.lang_pred for r in got) / len(got)
    assert len(got) > 100 and right > 0.97
    assert sum(r.rejected for r in got) / len(got) < 0.01
    assert all(0 <= r.score <= 1 for r in got)


def test_defined_results(spark, folder):
    teach = spark.createDataFrame(
        [("the cat and the dog " * 30 + str(i), "en") for i in range(20)]
        + [("der Hund und die Katze " * 30 + str(i), "de") for i in range(10)]
        + [(None, "xx"), ("", "xx"), ("12 34", "xx"), ("words", None)], "text string, lang string")
    made = language.learn(teach)
    assert list(made) == ["en", "de"]
    rows = [(1, None, "a", 1.0), (2, "", "a", 1.0), (3, "12 !?", "a", 1.0), (4, "die Katze und der Hund " * 5000, "a", 1.0),
            (5, "The CAT and\nthe dog and the cat", "a", 1.0), (5, "The CAT and\nthe dog and the cat", "a", 1.0), (6, "ab", "a", 1.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string, score double")
    got = language.identify(df, made)
    assert got.columns == ["doc_id", "text", "lang_pred", "score", "rejected"]
    by = {r.doc_id: (r.lang_pred, r.rejected) for r in got.collect()}
    assert by == {1: ("und", True), 2: ("und", True), 3: ("und", True), 4: ("de", False), 5: ("en", False), 6: ("en", False)}
    assert got.count() == len(rows)
    assert {r.doc_id: r.text for r in got.collect()} == {r[0]: r[1] for r in rows}
    assert "text" not in language.identify(df, made, keep_text=False).columns


def test_copies_and_long_texts(spark):
    letter = lambda i: "".join(chr(97 + int(c)) for c in str(i))
    rows = [("der Hund und die Katze", "de")] * 3000 + [(f"ein Text {letter(i)}", "de") for i in range(40)]
    rows += [(f"{letter(i)} " + "long été " * 600, "fr") for i in range(64)] + [(f"short {letter(i)}", "en") for i in range(3)]
    made = language.learn(spark.createDataFrame(rows, "text string, lang string"))
    assert set(made["de"].decode().split("\n")) == {t for t, n in ((t.lower(), n) for t, n in rows) if n == "de"}
    assert len(made["en"].decode().split("\n")) == 3
    starts = {t.split(" ")[0] for t in made["fr"].decode().split("\n")}
    assert starts == {letter(i) for i in range(64)}
    assert language.DICTIONARY_BYTES - 200 < len(made["fr"]) <= language.DICTIONARY_BYTES


def test_nothing_learned_one_language_and_empty(spark):
    df = spark.createDataFrame([(1, "text")], "doc_id long, text string")
    none = spark.createDataFrame([], "text string, lang string")
    assert language.learn(none) == {}
    assert [(r.lang_pred, r.score, r.rejected) for r in language.identify(df, {}).collect()] == [("und", 0.0, True)]
    one = language.identify(df, {"en": b"some text in the one language"}).first()
    assert (one.lang_pred, one.score, one.rejected) == ("en", 1.0, False)
    assert language.identify(df.limit(0), {}).count() == 0


def test_too_many_languages(spark, monkeypatch):
    monkeypatch.setattr(language, "MAX_LANGUAGES", 1)
    with pytest.raises(ValueError):
        language.learn(spark.createDataFrame([("a", "x"), ("b", "y")], "text string, lang string"))


def test_against_every_dictionary_tried_plainly(spark, folder):
    import regex
    import zstandard

    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 120").select("doc_id", "text", "lang")
    extra = spark.createDataFrame([(1000, "Ein Satz auf Deutsch.", "de"), (1001, "x", "en"), (1002, "99 !", None), (1003, "word " * 9000, "en")], docs.schema)
    docs.unionByName(extra).write.parquet(folder + "/docs")
    docs = spark.read.parquet(folder + "/docs")
    learned = language.learn(docs)
    got = {r.doc_id: (r.lang_pred, r.score, r.rejected) for r in language.identify(docs, learned).collect()}
    for doc_id, text, _ in docs.collect():
        plain = regex.sub(r"\P{L}+", " ", text).lower()
        if not regex.search(r"\p{L}", plain):
            assert got[doc_id] == ("und", 0.0, True)
            continue
        data = plain.encode()
        sizes = []
        for name, content in learned.items():
            sample = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            blocks = [data[i : i + language.BLOCK] for i in range(0, len(data), language.BLOCK)]
            sizes.append((sum(len(zstandard.ZstdCompressor(level=language.LEVEL, dict_data=sample).compress(b)) for b in blocks), name))
        first = min(sizes, key=lambda s: s[0])
        second = sorted(s for s, _ in sizes)[1]
        score = (second - first[0]) / second
        assert got[doc_id] == (first[1], score, score < language.MARGIN and first[0] < len(data)), text[:60]
