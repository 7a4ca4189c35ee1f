import pytest

from shopledger.llm import decontamination, oracles, queries
from shopledger_checks.compare import duckdb_rows, spark_rows

DOCS = "doc_id long, text string, item_id string, hash string, tokens int"
ITEMS = "item_id long, text string, hash int"
QUESTION = (
    "Tom walked 12 km to the old harbour before noon and then rowed 5 km back with Anna, who had bought 12 red apples. "
    "How many km did Tom travel in the whole day?"
)
OTHER = (
    "Lisa walked 31 miles to the old harbour before noon and then rowed 8 miles back with Omar, who had bought 31 red apples. "
    "How many miles did Lisa travel in the whole day?"
)


def flagged(spark, docs, items):
    docs = spark.createDataFrame([(d, t, "x", "y", 1) for d, t in docs], DOCS)
    items = spark.createDataFrame([(i, t, 0) for i, t in items], ITEMS)
    return {(r.doc_id, tuple(r["items"])) for r in decontamination.contaminated(docs, items).collect()}


def test_copies_and_re_parameterised_questions(spark):
    inconsistent = OTHER.replace("bought 31", "bought 77").replace("did Lisa travel", "did Omar travel").replace("rowed 8 miles", "rowed 8 hours")
    docs = [
        (1, "Before. " + QUESTION + " And after it much other text."), (2, OTHER), (3, "unrelated words " * 40), (4, None), (5, ""),
        (6, QUESTION.replace(" ", "\n\t  ")), (7, OTHER), (7, OTHER), (None, QUESTION), (8, "Tom walked 12 km to the old market square instead"),
        (11, QUESTION.lower()), (12, "and " + QUESTION.upper()), (13, OTHER.lower().replace("lisa", "tom").replace("omar", "anna")),
        (9, "filler word here " * 6000 + QUESTION + " filler" * 9000),
    ]
    items = [(100, QUESTION), (100, QUESTION), (101, None), (102, ""), (103, "too short"), (None, "another question about the number of ships in port")]
    assert flagged(spark, docs, items) == {(d, (100,)) for d in (1, 2, 6, 7, None, 9, 11, 12, 13)}
    frame = spark.createDataFrame([(1, OTHER, "x", "y", 1), (2, inconsistent, "x", "y", 1)], DOCS)
    bench = spark.createDataFrame([(100, QUESTION, 0)], ITEMS)
    rows = {r.doc_id: r.coverage for r in decontamination.contaminated(frame, bench, 0.0).collect()}
    assert rows[1] == 1.0 and rows[2] < 0.8


def test_clean_keeps_columns_and_rows(spark):
    docs = spark.createDataFrame([(d, t, "x", "y", 1) for d, t in [(1, QUESTION), (2, "fine"), (2, "fine"), (None, None)]], DOCS)
    items = spark.createDataFrame([(100, QUESTION, 0)], ITEMS)
    kept = decontamination.clean(docs, items)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "2", "None"]


@pytest.mark.parametrize("empty", ["docs", "items", "both"])
def test_empty_tables(spark, empty):
    docs = [] if empty != "items" else [(1, QUESTION)]
    items = [] if empty != "docs" else [(1, QUESTION)]
    assert flagged(spark, docs, items) == set()


def test_whole_tables_against_sql(spark, duck):
    con = duck("/root/testdata/sf0.01")
    for name in ("documents", "benchmark"):
        con.execute(f"create or replace view {name} as select * from '/root/testdata/sf0.01/{name}.parquet'")
    frame = queries.op4_decontamination(spark, "/root/testdata/sf0.01")
    want = duckdb_rows(con, oracles.decontamination())
    assert spark_rows(frame) == want and len(want[1]) > 10


def test_planted_variants_against_sql(spark, duck, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).select("doc_id", "text")
    extra = [(1000 + i, t) for i, t in enumerate([QUESTION, OTHER, OTHER.replace("31", "7", 1), "ÄPFEL Äpfel " + QUESTION.upper(), QUESTION[:90]])]
    docs.unionByName(spark.createDataFrame(extra, "doc_id long, text string")).write.parquet(f"{tmp_path}/documents.parquet")
    items = spark.createDataFrame([(1, QUESTION), (2, "Then " + OTHER), (3, "€ 5 und 7 % von $ 12,50 in 3 weeks for Mary and John")], "item_id long, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    import duckdb

    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    got, want = spark_rows(queries.op4_decontamination(spark, str(tmp_path))), duckdb_rows(con, oracles.decontamination())
    assert got == want and len(got[1]) >= 3


def variant(name, number):
    return QUESTION.replace("Tom", name).replace("12", str(number)).replace("km", "miles" if number % 2 else "km").replace("Anna", name + "a")


def test_copies_with_other_values_in_one_document(spark):
    copies = [variant(n, i) for n, i in (("Bert", 31), ("Carl", 44), ("Dora", 57), ("Emil", 68))]
    docs = [(1, " ".join([*copies, QUESTION])), (2, " ".join(copies)), (3, "filler word " * 9000 + " ".join([copies[0], "and some more words", *copies[1:]]))]
    frame = spark.createDataFrame([(d, t, "x", "y", 1) for d, t in docs], DOCS)
    rows = {r.doc_id: (r.coverage, tuple(r["items"])) for r in decontamination.contaminated(frame, spark.createDataFrame([(100, QUESTION, 0)], ITEMS)).collect()}
    assert rows == {d: (1.0, (100,)) for d in (1, 2, 3)}


def test_items_without_windows_are_met_word_by_word(spark):
    items = [
        (1, "What is 15 % of 240 ?"), (2, "Compute 12 + 30 - 7 * 4"), (3, "Is Paris bigger than Rome?"), (4, "Who wrote Hamlet?"),
        (5, "谁写了哈姆雷特"), (6, "Hamlet"), (7, "?!"), (None, "7 8 9 10 11 12 13 14"),
    ]
    docs = [
        (1, "Quiz. what is 15% of 240? Think."), (2, "compute 12 + 30 - 7 * 4"), (3, "He asked: Is Paris bigger than\nRome? No."), (4, "Who wrote Hamlet? Who knows."),
        (5, "请问谁写了哈姆雷特呢"), (6, "Hamlet."), (7, "Hamlet wrote. Who is Paris, 15 % of 241?"), (8, "long words " * 15000 + "7, 8, 9, 10, 11, 12, 13, 14, 15"),
        (9, "is rome bigger than paris; 7 8 9 10 11 12 13 15"), (10, "谁写了哈姆雷"),
    ]
    want = {(1, (1,)), (2, (2,)), (3, (3,)), (4, (4,)), (5, (5,)), (6, (6,))}
    assert flagged(spark, docs, items) == want | {(8, ())}


def test_few_or_scattered_windows_are_no_evidence(spark):
    long = " ".join(f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(120))
    words = long.split()
    pieces = " ".join(" ".join([*words[i : i + 6], "filler words of another text entirely"]) for i in range(0, 120, 10))
    docs = [
        (1, "As we know Lyon is the capital of Gaul, said he."), (2, "Now: what is the capital of France? Paris."), (3, pieces),
        (4, "filler " * 50 + " ".join(words[30:56]) + " filler" * 50), (5, " ".join([*words[30:42], "other", *words[43:60]])),
    ]
    assert flagged(spark, docs, [(1, "What is the capital of France?"), (2, long)]) == {(2, (1,)), (4, (2,)), (5, (2,))}


def test_short_items_with_other_numbers(spark):
    items = [
        (1, "What is 15 % of 240 ?"), (2, "Compute the sum of 12 and 30 ."), (3, "What is the capital of France?"), (4, "Add 7 to 7 and halve it"),
        (5, "Compute 12 + 30"),
    ]
    docs = [
        (1, "So: What is 20 % of 310 ? Well."), (2, "compute the sum of 44 and 51."), (3, "Lyon is the capital of Gaul"), (4, "add 9 to 9 and halve it"),
        (5, "add 9 to 8 and halve it"), (6, "Compute 44 + 51"), (7, "what is 20 of 310"), (8, "WHAT IS 3.5 km OF 9"), (9, "x " * 60000 + "what is 1 € of 2"),
    ]
    assert flagged(spark, docs, items) == {(1, (1,)), (2, (2,)), (4, (4,)), (8, (1,)), (9, (1,))}


def test_blocks_of_long_texts_are_cut_by_code_points(spark, monkeypatch):
    block, overlap = 4096, 512
    monkeypatch.setattr(decontamination, "BLOCK", block)
    texts = {1: "aé😀 b\n" * 4000, 2: "x" * block, 3: "ab " * 700, 4: "y " * 2300 + "z", 5: "漢字。\r\n  " * 3000, 6: "", 7: None}
    frame = spark.createDataFrame(list(texts.items()), "id long, text string")
    got = {(r.id, r.start): r.tokens for r in decontamination._blocks(frame, "id", token="(?s).", overlap=overlap).collect()}
    want = {}
    for key, text in texts.items():
        whole = text and len(text) <= block + overlap
        for i, at in enumerate(range(0, 1 if whole else len(text or ""), block)):
            want[key, i * (block + overlap)] = list(text[at : at + block + overlap])
    assert got == want
