"""Lines that the stages of the pipeline take out, beyond what op6 and op2 do by their SQL."""

import pytest

import corpus_pipeline
from kinetable.llm import quality
from kinetable.llm.common import stored

SCHEMA = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"


def table(spark, texts, source="big"):
    return spark.createDataFrame([(i, t, "en", source, len(t)) for i, t in enumerate(texts)], SCHEMA).repartition(3)


def own(i, n=70):
    return " ".join(f"d{chr(97 + i % 26)}{chr(97 + i // 26)}w{k * 7919 + i}x{k}" for k in range(n))


def stage(name, spark, df):
    out = dict(corpus_pipeline.STAGES)[name](spark, df, "")
    assert out.columns == df.columns
    rows = out.collect()
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    return {r["doc_id"]: r["text"] for r in rows}


def test_frequent_lines_of_a_large_source_go_but_for_one(spark):
    # 12 of 400 texts: 3 percent of the source
    texts = [own(i) + ("\nSign  in to read more of this" if i < 12 else "") for i in range(400)]
    got = stage("quality_rules", spark, table(spark, texts))
    assert len(got) == 400
    assert sum("Sign" in got[i] for i in range(12)) == 1
    assert all(got[i].split("\n")[0] == own(i) for i in range(400))


def test_near_copies_of_a_source_do_not_go_altogether(spark):
    shared = "\n".join(own(900 + k, 20) for k in range(10))
    got = stage("quality_rules", spark, table(spark, [f"{shared}\nend {chr(97 + i)}" for i in range(20)]))
    assert len(got) == 1 and shared in next(iter(got.values()))


def test_removed_lines_are_out_of_the_texts(spark):
    texts = [own(i) + "\nMENU of this  site" for i in range(16)] + [own(16)]
    got = {r["doc_id"]: r["text"] for r in quality.keep_good(table(spark, texts)).collect()}
    assert got == {i: own(i) for i in range(17)}


def test_passages_recur_from_two_documents_on(spark):
    passage, short = own(500, 51), own(501, 50)
    texts = [f"{own(i, 60)}\n{passage}\n{short}" for i in range(2)]
    got = stage("line_dedup", spark, table(spark, texts))
    assert got == {0: texts[0], 1: f"{own(1, 60)}\n{short}"}


@pytest.mark.parametrize("line", ["Read more", "les."])
def test_short_lines_recur(spark, line):
    texts = [f"{own(i, 60)}\n\n{line}\n" for i in range(3)]
    got = stage("line_dedup", spark, table(spark, texts))
    assert got == {0: texts[0], 1: f"{own(1, 60)}\n\n", 2: f"{own(2, 60)}\n\n"}


def test_a_document_left_too_short_goes(spark):
    passage = own(500, 51)
    texts = [f"{own(i, n)}\n{passage}" for i, n in enumerate([60, 60, 40])] + [own(7, 20)]
    got = stage("line_dedup", spark, table(spark, texts))
    # one that was short before and lost nothing is not this stage's business
    assert got == {0: texts[0], 1: own(1, 60), 3: texts[3]}


def test_a_document_that_loses_most_of_its_words_goes(spark):
    passages = [own(500 + k, 60) for k in range(3)]
    texts = ["\n".join([own(1, 60), *passages]), "\n".join([own(2, 100), *passages]), "\n".join([own(3, 190), *passages])]
    assert stage("line_dedup", spark, table(spark, texts)) == {0: texts[0], 2: own(3, 190)}


def test_near_copies_of_several_lines_leave_one(spark):
    """Their common lines go from the later ones, and those with them."""
    lines = [own(300 + k, 55) for k in range(6)]
    near = ["\n".join([*lines[:k], f"{lines[k]} edit{chr(97 + k)}", *lines[k + 1 :]]) for k in range(6)]
    docs = table(spark, [*near, own(1, 80)])
    for name in ("quality_rules", "line_dedup", "simhash_near_dedup"):
        docs = stored(dict(corpus_pipeline.STAGES)[name](spark, docs, ""), name)
    assert sorted(r["doc_id"] for r in docs.collect()) == [0, 6]


def test_repeated_rows_and_very_long_texts_go_through(spark, no_docs):
    long = "\n".join(own(k, 40) for k in range(600)) + "\n" + "x" * 300_000
    rows = [(1, long, "en", "a", len(long)), (1, long, "en", "a", len(long)), (2, long, None, None, None), (None, long, "en", "a", 1), (3, own(900), "en", "a", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name, run in corpus_pipeline.STAGES[:3]:
        docs = stored(run(spark, docs, ""), name)
    assert sorted((r["doc_id"], len(r["text"])) for r in docs.collect()) == [(1, len(long)), (3, len(own(900)))]
