"""Each stage of the pipeline against brute force, on nulls, copies, long texts and odd columns."""

import random

import pytest

import corpus_pipeline as pipeline
from llm.test_decontaminate import brute as contaminated_by
from llm.test_neardup import brute as class_roots
from llm.test_repeats import brute as cut_by
from tablehandoff.llm import language

# Names that the operators use for their own columns.
CLASHES = ["row", "rest", "score", "rejected", "lang_pred", "n_words", "n_removed", "kept_text", "rank", "ids", "class_id", "item_id", "odd `na.me"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c.replace('`', '``')}` string" for c in CLASHES)
ENGLISH = "the weather was cold and the people of the town went home before it was dark in the evening".split()
GERMAN = "das Wetter war kalt und die Leute aus der Stadt gingen nach Hause bevor es am Abend dunkel wurde".split()


def corpus():
    draw = random.Random(8)

    def text(words, n):
        return " ".join(draw.choice(words) + draw.choice(["", "", "", str(draw.randint(0, 99))]) for _ in range(n))

    made = [(text(ENGLISH, draw.choice([30, 80, 200])), "en") for _ in range(40)]
    made += [(text(GERMAN, draw.choice([30, 80, 200])), "de") for _ in range(30)]
    passage = text(ENGLISH, 60)
    made += [(text(ENGLISH, 40) + " " + passage + " " + text(ENGLISH, 30), "en") for _ in range(4)]
    made += [made[0], made[0], (made[1][0] + " more", "en"), (made[45][0], None)]
    made += [(None, None), ("", "en"), ("12 34 ...", "de"), (" \n\t", None), (text(ENGLISH, 12_000), "en")]
    rows = [(i if i % 11 else None, t, g, None if i % 5 == 0 else "s", None if t is None else len(t)) for i, (t, g) in enumerate(made)]
    rows.append(rows[3])
    return [(*r, *[f"{c}-{i}" for c in CLASHES]) for i, r in enumerate(rows)]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("pipeline"))
    data = corpus()
    spark.createDataFrame(data, SCHEMA).repartition(3).write.parquet(f"{folder}/documents")
    items = [(0, " ".join(data[50][1].split()[5:40])), (1, " ".join(data[7][1].split()[:25])), (2, None), (3, "")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return spark.read.parquet(f"{folder}/documents"), data, items, folder


def run(stage, spark, tables):
    docs, _, _, folder = tables
    out = dict((f.__name__, f) for _, f in pipeline.STAGES)[stage](spark, docs, folder)
    assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    empty = dict((f.__name__, f) for _, f in pipeline.STAGES)[stage](spark, docs.limit(0), folder)
    assert empty.columns == docs.columns and empty.count() == 0
    return sorted(map(tuple, out.collect()), key=lambda r: r[5])


def whole(rows):
    return sorted(rows, key=lambda r: r[5])


def test_identified(spark, tables):
    docs, data, _, _ = tables
    compressors = language._compressors(language.learn(docs))
    def stays(text):
        letters = "".join(c for c in text or "" if c.isalpha())
        return bool(letters) and text is not None

    got = run("identified", spark, tables)
    assert compressors and {r[5] for r in got} <= {r[5] for r in data if stays(r[1])}
    assert all(r in data for r in got)  # every column as it was
    clean = [r for r in data if r[1] and len(r[1].split()) >= 25]
    assert len([r for r in clean if r in got]) == len(clean)


def test_without_near_copies(spark, tables):
    _, data, _, _ = tables
    got = run("without_near_copies", spark, tables)
    assert all(r in data for r in got)
    roots = class_roots([r[1] for r in data])
    at = {r[5]: i for i, r in enumerate(data)}
    assert sorted(roots[at[r[5]]] for r in got) == sorted(set(roots))


def test_without_repeats(spark, tables):
    _, data, _, _ = tables
    want = []
    for r, (_, removed, kept) in zip(data, cut_by([r[1] for r in data], 35)):
        text = kept if removed else r[1]
        want.append((r[0], text, *r[2:4], None if text is None else len(text), *r[5:]))
    assert run("without_repeats", spark, tables) == whole(want)
    assert any(w[1] != r[1] for w, r in zip(want, data))


def test_decontaminated(spark, tables):
    _, data, items, _ = tables
    found = {d for d, *_ in contaminated_by([(i, r[1]) for i, r in enumerate(data)], items)}
    assert len(found) >= 2
    assert run("decontaminated", spark, tables) == whole([r for i, r in enumerate(data) if i not in found])


def test_segmented(spark, tables):
    docs, data, _, folder = tables
    out = pipeline.segmented(spark, docs, folder)
    assert out.columns[:3] == ["doc_id", "lang", "source"]
    rows = out.collect()
    assert all(r.round_trip for r in rows) and {r["rank"] for r in rows} == {1, 2}
    firsts = [r for r in rows if r["rank"] == 1]
    assert len(firsts) == len(data) and sum(r.n_pieces == 0 for r in rows) == 2
    assert pipeline.segmented(spark, docs.select("doc_id", "text"), folder).columns[:2] == ["doc_id", "rank"]
    assert pipeline.segmented(spark, docs.limit(0), folder).count() == 0
