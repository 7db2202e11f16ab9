"""Nulls anywhere, repeated rows, empty tables and clashing extra columns have defined results and never crash."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tapewright.llm.decontamination import find_leaks
from tapewright.llm.line_dedup import dedup_lines
from tapewright.llm.minhash_dedup import near_duplicates
from tapewright.llm.passage_dedup import find_passages, repeated_passages
from tapewright.llm.piece_codec import encode_decode
from tapewright.llm.pseudonyms import pseudonymize_documents
from tapewright.llm.quality_rules import clean_lines
from tapewright.llm.sharding import kd_shards
from tapewright.llm.suffix_dedup import remove_repeats
from tapewright.llm.warc import read_records, write_archives

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ROWWISE = {
    "line_dedup": dedup_lines, "piece_codec": lambda d: encode_decode(d, MODEL), "minhash": near_duplicates, "pseudonyms": lambda d: pseudonymize_documents(d, b"k"),
    "suffix": remove_repeats, "quality": clean_lines, "sharding": lambda d: kd_shards(d, "doc_id", "text", {"bytes": F.octet_length("text")}, n_shards=4),
}
CLASHES = "id long, key string, h long, n long, keep string, start long, shard int, kept string, ids string, n_lines int, component string, size long, node int"


@pytest.mark.parametrize("name", ROWWISE)
def test_nulls_repeats_and_clashing_columns(spark, name):
    long = " ".join(f"word{k}" for k in range(200))
    rows = [(1, "a line of text here\nb"), (1, "a line of text here\nb"), (None, "a line of text here"), (None, None), (2, None), (3, ""), (4, long), (5, long), (6, "  ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    extra = docs.select("*", *[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in CLASHES.split(", ")])
    plain = sorted(map(str, ROWWISE[name](docs).collect()))
    assert len(plain) == len(rows)
    assert sorted(map(str, ROWWISE[name](extra).collect())) == plain
    assert sum(r.doc_id is None for r in ROWWISE[name](docs).select("doc_id").collect()) == 2


@pytest.mark.parametrize("name", ROWWISE)
def test_empty_table(spark, name):
    assert ROWWISE[name](spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_repeated_rows_are_one_document(spark):
    text = "one line that is long enough\n" * 3 + " ".join(f"word{k}" for k in range(100))
    docs = spark.createDataFrame([(7, text), (7, text)], "doc_id long, text string")
    assert {r.n_dropped for r in dedup_lines(docs).collect()} == {0}
    assert {(r.component_id, r.kept) for r in near_duplicates(docs).collect()} == {(7, True)}
    assert {r.n_removed for r in remove_repeats(docs).collect()} == {0}
    assert repeated_passages(docs).collect() == []


def test_report_operators(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    odd = spark.createDataFrame([(None, "x"), (1, None), (2, "")], "doc_id long, text string")
    items = spark.createDataFrame([(1, None), (None, "a b c d e f g")], "item_id long, text string")
    for docs in (none, odd):
        assert repeated_passages(docs).collect() == []
        assert find_leaks(docs, items).collect() == []
        assert find_leaks(docs, items.limit(0)).collect() == []


def test_warc_odd_rows(spark, tmp_path):
    pages = spark.createDataFrame([(None, None, None), (None, "u v\n", "x"), (1, "", "x"), (1, "", "x"), (2, "\r", "y")], "page_id long, url string, html string")
    folder = f"file://{tmp_path}/a"
    got = sorted((str(r.page_id), r.record_type, r.refers_to) for r in read_records(write_archives(pages, folder), folder).collect())
    assert got == [("1", "response", None), ("1", "response", None), ("2", "response", None), ("None", "response", None), ("None", "revisit", 1)]
    empty = f"file://{tmp_path}/b"
    assert read_records(write_archives(pages.limit(0), empty), empty).collect() == []


def test_reports_ignore_clashing_columns(spark):
    """op2, op4 and op7 read their own columns only, whatever the others are called."""
    long = " ".join(f"word{k}" for k in range(120))
    docs = spark.createDataFrame([(1, long), (2, long), (2, long), (-(2**63), long + " x"), (2**63 - 1, long), (None, long)], "doc_id long, text string")
    extra = docs.select("*", *[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in f"{CLASHES}, at long, kind int, picks string, spans string, item_id long, found string".split(", ")])
    plain = {(r.doc_id, r.n_passages, r.n_words) for r in find_passages(docs).collect()}
    assert plain == {(1, 1, 120), (2, 1, 120), (2**63 - 1, 1, 120)}
    assert {(r.doc_id, r.n_passages, r.n_words) for r in find_passages(extra).collect()} == plain
    items = spark.createDataFrame([(7, long[:200])], "item_id long, text string")
    assert sorted(r.doc_id for r in find_leaks(docs, items).collect()) == [-(2**63), 1, 2, 2**63 - 1]
    assert sorted(map(str, find_leaks(extra, items).collect())) == sorted(map(str, find_leaks(docs, items).collect()))


def test_warc_ignores_clashing_columns(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "x" * 9), (2, "u", "x" * 9), (3, None, None)], "page_id long, url string, html string")
    extra = pages.select("*", *[F.lit("z").alias(c) for c in ("id", "size", "digest", "member", "first", "sha", "file", "offset")])
    got = [sorted(map(str, read_records(write_archives(p, f"file://{tmp_path}/{k}"), f"file://{tmp_path}/{k}").collect())) for k, p in enumerate((pages, extra))]
    assert got[0] == got[1] and len(got[0]) == 3


@pytest.mark.parametrize("name, f", corpus_pipeline.STAGES)
def test_stages_on_odd_rows(spark, name, f):
    """Null ids and texts, repeated rows and an empty table; what a stage does with them is in its docstring."""
    good = "\n".join(" ".join(f"w{n}_{k}" for k in range(30)) + "." for n in range(4))
    rows = [(1, good, "en", "s", 9), (1, good, "en", "s", 9), (None, good + "\nanother line of its own.", None, None, None), (2, None, "en", "s", 0), (3, "", None, "s", 0), (4, good.replace("w", "v"), "en", None, 5), (None, None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema)
    got = f(spark, docs, "/root/testdata/sf0.001").collect()
    ids = sorted(str(r.doc_id) for r in got)
    assert ids == {"quality rules": ["1", "1", "4", "None"], "line dedup": ["1", "1", "4", "None"]}.get(name, ["1", "1", "2", "3", "4", "None", "None"])
    assert f(spark, docs.limit(0), "/root/testdata/sf0.001").collect() == []


def test_long_texts(spark):
    """A text of 5 MB beside its copy, and one word of 4.3 MB."""
    long = " ".join(f"word{k}" for k in range(450_000))
    docs = spark.createDataFrame([(1, long), (2, long + " end"), (3, "x" * 4_300_000), (4, "y " * 10)], "doc_id long, text string").repartition(2)
    assert {r.doc_id: r.component_id for r in near_duplicates(docs).collect()} == {1: 1, 2: 1, 3: 3, 4: 4}
    assert {r.doc_id: r.n_words for r in find_passages(docs).collect()} == {2: 450_001}
    got = {r.doc_id: r.n_removed for r in remove_repeats(docs).select("doc_id", "n_removed").collect()}
    assert got == {1: 0, 2: len(long), 3: 4_299_999, 4: 0}


def test_pipeline_stages(spark, docs, tmp_path):
    """Each stage returns the columns of documents, drops what it rejects, and the last one decodes to the same text."""
    source = "/root/testdata/sf0.001"
    out = corpus_pipeline.run(spark, source)
    assert out.filter("NOT round_trip").count() == 0
    stage = docs
    for name, f in corpus_pipeline.STAGES[:-1]:
        done = f(spark, stage, source)
        assert done.columns == docs.columns, name
        path = str(tmp_path / name.replace(" ", "_"))
        done.write.parquet(path)
        stage = spark.read.parquet(path)
        assert stage.count() <= docs.count()
    kept = {r.doc_id for r in clean_lines(docs).filter("kept").collect()}
    assert {r.doc_id for r in stage.collect()} <= kept
