import random

import pytest

import corpus_pipeline
from shopledger.llm import pieces, pii, queries

WORDS = {
    "en": "the of and to in that is was for with as his they at be this from have or by one had not but what all were when we there can".split(),
    "fr": "le la les des une est que dans pour qui sur avec plus par être ce fait aux son sont même aussi leur bien où très été déjà".split(),
}
QUESTION = "Every morning Tom walked 12 km to the old harbour before noon and then rowed 5 km back with Anna and her red boat"
CLASH = ("fingerprint", "slot", "items", "node", "at")


def text(seed, lang="en", size=120):
    rng = random.Random(f"{lang}{seed}")
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", "s", "er"]) for _ in range(size))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Planted cases among clean documents."""
    path = str(tmp_path_factory.mktemp("corpus"))
    rows = [(i, text(i, lang), lang) for i in range(40) for lang in [("en", "fr")[i % 2]]]
    near = text(1000, size=4000).split()
    rows += [(100, text(4), "en"), (101, text(500), "en"), (102, text(500), "en"), (103, " ".join(near), "en")]
    rows += [(104, " ".join(near[:200] + ["changed"] + near[201:]), "en"), (104, " ".join(near[:200] + ["changed"] + near[201:]), "en")]
    rows += [(200, None, "en"), (201, "", "en"), (202, "123 456 !!! ###", None), (203, text(600) + " " + QUESTION + " " + text(601), "en")]
    rows += [(204, text(602) + " " + QUESTION.replace("Tom", "Lisa").replace("12", "31"), "en")]
    rows += [(300, text(700) + " write to a.b@mail.example.org or +1 (555) 010-9999 from 10.1.2.3 with 4111111111111111 thanks", "en")]
    rows += [(301, text(701, size=30_000), "en"), (None, text(702), None)]
    rows = [(d, t, lang, "src", len(t or ""), *CLASH) for d, t, lang in rows]
    names = ["doc_id long", "text string", "lang string", "source string", "n_chars long", *[f"{c} string" for c in CLASH]]
    spark.createDataFrame(rows, ", ".join(names)).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(7, QUESTION)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_each_stage_on_all_that_is_kept(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept, left = docs.columns, [], docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = corpus_pipeline.stored(stage(spark, left, folder))
        assert left.columns == columns
        kept.append(sorted((r.doc_id for r in left.collect()), key=str))
    everything = [r.doc_id for r in docs.collect()]
    clean = [*range(40), 300, 301, None]
    assert kept[0] == sorted([d for d in everything if d not in (200, 201, 202)], key=str)
    assert kept[1] == sorted([*clean, 101, 103, 203, 204], key=str)
    assert kept[2] == kept[3] == sorted([*clean, 101, 103], key=str)
    before = {r.doc_id: r for r in docs.collect()}
    for r in left.collect():
        if r.doc_id == 300:
            assert r.text == text(700) + " write to [EMAIL] or [PHONE] from [IP] with [CARD] thanks" and r.n_chars == len(r.text)
        else:
            assert r == before[r.doc_id]
        assert not pii.find(r.text, pii._anchors())
    rows = corpus_pipeline.STAGES[-1][1](spark, left, folder)
    vocabulary = pieces.load(queries.public_model())
    assert all(r.exact for r in rows.collect())
    back = {r.doc_id: [] for r in left.collect()}
    for r in sorted(pieces.decode(rows, vocabulary).collect(), key=lambda r: r.part):
        back[r.doc_id].append(r.text)
    assert {d: "".join(t) for d, t in back.items()} == {r.doc_id: r.text for r in left.collect()}


def test_run_equals_its_stages(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    assert len({r.doc_id for r in rows}) == 45 and all(r.exact for r in rows)
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").where("false").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
