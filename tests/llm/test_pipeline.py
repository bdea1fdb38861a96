"""The pipeline's stages against brute force over the smallest tables."""

import corpus_pipeline
from test_jaccard_join import brute
from threadlens.llm.quality_rules import MEASURES, RULES, measure

FOLDER = "/root/testdata/sf0.001"


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    good = []
    for d in docs:
        values = dict(zip(MEASURES, measure(d.text)))
        if not any(eval(r.fails, {}, values) for r in RULES):  # noqa: S307
            good.append((d.doc_id, d.text))
    first = [i for i, _, lead in brute(good) if i == lead]
    got = {r.doc_id for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert got <= set(first) and len(got) > 0.5 * len(first)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "jaccard_join", "decontamination", "secret_scan", "byte_bpe"]


def test_one_row_of_each_linked_group(spark):
    words = [f"w{i}" for i in range(60)]
    text, near, other = " ".join(words), " ".join([*words[:-1], "x"]), " ".join(reversed(words))
    rows = [(1, text, "a")] * 40 + [(1, near, "a"), (1, other, "b"), (2, near, "b"), (2, text, "c"), (3, other, "c"), (4, "", "d"), (4, "", "d"), (5, " ", "d"), (6, "", "d")]
    rows += [(None, "one of two " * 9, "e")] * 3 + [(None, "quite another text " * 9, "e")] * 2 + [(7, "last text of all " * 9, "f"), (None, "last text of all " * 9, "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    got = [tuple(r) for r in corpus_pipeline.near_duplicates(spark, docs, FOLDER).collect()]
    linked = [r for r in got if r[1] in (text, near)]
    assert len(linked) == 1 and linked[0][0] == 1
    rest = sorted((str(r[0]), r[1], r[2]) for r in got if r[1] not in (text, near))
    assert rest == sorted([
        ("1", other, "b"), ("4", "", "d"), ("5", " ", "d"), ("6", "", "d"), ("None", "one of two " * 9, "e"),
        ("None", "quite another text " * 9, "e"), ("7", "last text of all " * 9, "f")])
