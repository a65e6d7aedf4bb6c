"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator and stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from govpub.llm import chat, decontam, fst_bpe, host_quality, langid, line_align, pii, probminhash, url_rules, warc
from govpub.llm.queries import PII_KEY, QUERIES, VOCABULARY

PATTERN = r"\p{L}+|\P{L}"
PASSAGE = " ".join(f"word{k}" for k in range(60))
LONG = " ".join(f"tok{k % 977}x{k % 31}" for k in range(40_000))
ROWS = [
    (1, PASSAGE + "\n" + PASSAGE.upper(), "en", "a", 10), (1, PASSAGE + "\n" + PASSAGE.upper(), "en", "a", 10),
    (1, "another text under the same id", "en", "a", 3), (None, PASSAGE, "en", None, None), (None, None, None, None, None),
    (2, None, "fr", "a", 0), (3, "", "de", "b", 0), (4, " \n\t\n", None, "b", 4), (5, LONG, "en", "b", len(LONG)),
    (6, LONG + " end", "en", "b", 1), (7, "x" * 200_000, "en", "c", 200_000), (8, "\n" * 5000, "en", "c", 5000),
    (9, "日本語 текст ελληνικά", "en", "c", 9), (10, PASSAGE, "en", "c", 5),
]
CLASHES = ["row", "th", "_text", "keys", "digest", "gone", "class_id", "n_words", "kept", "_row", "host", "label", "key",
           "n_deleted", "token", "runs", "_bad_id", "ids", "is_first", "entities", "verdict", "_th", "_id", "text_no"]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, clash=True, rows=ROWS):
    df = spark.createDataFrame(rows, DOCS)
    return df.withColumns({c: F.lit("clash") for c in CLASHES}) if clash else df


def items(spark, rows=((1, PASSAGE), (2, ""), (3, None), (None, "日本語"))):
    return spark.createDataFrame(list(rows), "item_id long, text string").withColumn("win", F.lit("clash"))


def on_documents(spark, docs):
    return {
        "langid": langid.identified(docs, langid.train(docs), ["doc_id"]),
        "pii": pii.pseudonymised(docs, PII_KEY),
        "probminhash": probminhash.classes(docs),
        "decontam": decontam.contamination(docs, items(spark), ["doc_id"]),
        "line_align": line_align.dedup_lines(docs),
        "bpe": fst_bpe.round_trip(docs, VOCABULARY, PATTERN),
        "host_quality": host_quality.judged(docs, ["doc_id"]),
    }


@pytest.mark.parametrize("clash", [False, True])
def test_every_document_has_a_result(spark, clash):
    for name, df in on_documents(spark, documents(spark, clash)).items():
        assert df.count() == len(ROWS), name


ILL = "CAST(unhex('476F6F64FF20776F726473E282206F66206120746578742E') AS STRING)"  # two ill-formed sequences


def test_ill_formed_texts(spark, tmp_path):
    """Bytes that are no UTF-8 fail no operator and no stage; they are read as U+FFFD."""
    words = " ".join(f"word{k}" for k in range(60))
    docs = spark.range(1, 9).selectExpr("id AS doc_id", f"concat({ILL}, ' {words} ', id) AS text", "'en' AS lang",
                                        f"concat('s', {ILL}) AS source", "10L AS n_chars")
    for name, df in on_documents(spark, docs).items():
        assert df.count() == 8, name
    assert langid.identified(docs, langid.train(docs), ["doc_id"]).where("lang_pred = 'en'").count() == 8
    got = fst_bpe.decoded(fst_bpe.encoded(docs.where("doc_id = 1"), VOCABULARY, PATTERN), VOCABULARY, PATTERN).first()["text"]
    assert got == "Good\ufffd words\ufffd of a text. " + words + " 1"
    items(spark, [(1, "something else")]).write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, str(tmp_path)).count() == (1 if name == "near dedup" else 8), name
    pages = docs.selectExpr("doc_id AS page_id", f"concat('http://h/', {ILL}) AS url", "text AS html")
    assert warc.archived(pages).count() == 8
    labels = docs.selectExpr("doc_id", "1 AS quality", "0 AS toxic")
    assert url_rules.judged(pages, labels).count() == 8
    turns = docs.selectExpr("doc_id AS conv_id", "1L AS turn", f"{ILL} AS role", "text")
    assert chat.rendered(turns).count() == 8


def test_empty_documents(spark):
    for name, df in on_documents(spark, documents(spark, rows=[])).items():
        assert df.count() == 0, name


def test_no_items(spark):
    found = decontam.contamination(documents(spark), items(spark, []), ["doc_id"])
    assert found.where("contaminated OR n_hit > 0 OR n_items > 0").count() == 0


def test_conversations(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, None, None), (None, 0, "user", "a"), (2, 0, None, None)]
    turns = spark.createDataFrame(rows, schema).withColumns({c: F.lit("clash") for c in ("block", "pos", "h", "part", "n")})
    got = [tuple(r) for r in chat.rendered(turns).collect()]  # a turn without a number comes before the others
    assert got == [(1, 0, 2, "<|im_start|>\n<|im_end|>\n<|im_start|>user\na<|im_end|>\n")]  # 2 prefixes 1
    assert chat.rendered(spark.createDataFrame([], schema)).count() == 0


def test_pages(spark):
    schema = "page_id long, url string, html string"
    rows = [(1, "http://A.example.com/x", "p" * 200), (2, None, "p" * 200), (None, "no scheme", "p" * 200), (3, "", None),
            (3, "", None), (4, "http://h/\r\nX: y", "z" * 99), (5, "http://h", "z" * 99), (1, "again", "p" * 200),
            (6, "http://h/ü?q=1#f", "é" * 100_000)]
    pages = spark.createDataFrame(rows, schema).withColumns({c: F.lit("clash") for c in ("digest", "host", "row", "tokens")})
    got = sorted(((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.archived(pages).collect()),
                 key=str)
    assert got == sorted([(1, 200, "response", None), (1, 200, "response", None), (2, 200, "revisit", 1),
                          (None, 200, "revisit", 1), (3, 0, "response", None), (3, 0, "response", None),
                          (4, 99, "response", None), (5, 99, "response", None), (6, 200_000, "response", None)], key=str)
    assert warc.archived(spark.createDataFrame([], schema)).count() == 0
    labels = spark.createDataFrame([(1, None, None), (None, 0, 1), (1, 0, 0)], "doc_id long, quality int, toxic int")
    assert url_rules.judged(pages, labels).count() == len(rows)
    assert url_rules.judged(spark.createDataFrame([], schema), labels).count() == 0
    assert url_rules.judged(pages, labels.where("false")).where("page_id IS NULL").first()["verdict"] == "allow"


def test_stages_keep_columns(spark, tmp_path):
    items(spark).write.parquet(f"{tmp_path}/benchmark.parquet")
    for clash in (False, True):
        docs = documents(spark, clash)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns, name
            assert out.dtypes == docs.dtypes, name
            out.count()
            stage(spark, docs.where("false"), str(tmp_path)).count()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == len(ROWS)


def test_documents_with_only_blank_lines_left_go(spark):
    texts = [PASSAGE, f"\n\t\n{PASSAGE}\n \n\t", f"{PASSAGE}\n\n", f"x\n{PASSAGE}\n", "\n\n", None]
    docs = spark.createDataFrame([(k, t, "en", "a", 1) for k, t in enumerate(texts)], DOCS)
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_dedup(spark, docs, "").collect()}
    assert got == {0: PASSAGE, 3: "x\n", 4: "\n\n", 5: None}  # what was blank or null before stays


def test_pipeline_on_edges(spark, tmp_path):
    items(spark).write.parquet(f"{tmp_path}/benchmark.parquet")
    documents(spark, False).write.parquet(f"{tmp_path}/documents.parquet")
    assert [r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()] == [5]  # only LONG passes all


def test_thirteen_queries():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
