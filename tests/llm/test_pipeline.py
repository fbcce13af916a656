"""The pipeline on planted documents, and the registration of the queries."""

import re
import zlib

import corpus_pipeline
import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from routepulse.llm import personal_data
from routepulse.llm.queries import ORACLES, QUERIES, table, vocabulary

LANGUAGES = {"en": "the of and to in that is was he for it with as his on be at by had not", "de": "der die und in den von zu das mit sich des auf ist im dem nicht ein eine als auch"}


def sentence(lang, seed, n=60):
    words = LANGUAGES[lang].split()
    return " ".join(words[zlib.crc32(f"{lang}{seed}{i}".encode()) % len(words)] for i in range(n))


@pytest.fixture(scope="module")
def planted(tmp_path_factory):
    folder = tmp_path_factory.mktemp("planted")
    clean = {i: (sentence("en" if i % 2 else "de", i), "en" if i % 2 else "de") for i in range(40)}
    item = "seventeen purple elephants walked slowly across seven frozen lakes while singing ancient songs"
    rows = [(i, text, lang, "s", len(text)) for i, (text, lang) in clean.items()]
    rows += [(100, clean[3][0], "en", "s", 1), (101, clean[4][0].upper() + " ende", "de", "s", 1)]  # copies
    rows += [(200, clean[5][0][:50] + " " + item + " " + sentence("en", "x"), "en", "s", 1)]  # contaminated
    rows += [(300, sentence("en", "pii") + " mail me@example.com now", "en", "s", 1)]
    rows += [(400, "1234 !!", "en", "s", 1), (401, None, "en", "s", None), (402, "", None, None, 0)]  # no language
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()]
    pq.write_table(pa.table([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], columns), folder / "documents.parquet")
    pq.write_table(pa.table({"item_id": [1, 2], "text": [item, "no such words anywhere at all here"]}), folder / "benchmark.parquet")
    return folder, rows


def test_planted_documents(spark, planted):
    folder, rows = planted
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, str(folder)).collect()}
    assert sorted(out) == [*range(40), 300]
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(vocabulary("word_bpe_49k.json").decode())
    texts = {r[0]: r[1] for r in rows}
    for i, r in out.items():
        want = re.sub(r"\S+@\S+", "<EMAIL>", texts[i])
        assert (r.text, r.n_chars) == (want, len(want))
        ids = library.encode(want, add_special_tokens=False).ids
        assert (r.n_tokens, r.ids) == (len(ids), " ".join(map(str, ids)))


def test_stages_keep_the_columns(spark, planted):
    folder, _ = planted
    docs = table(spark, str(folder), "documents").withColumns({"matches": F.lit(1), "kept": F.lit("x"), "n_tokens": F.lit(0)})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(folder)).columns == list(corpus_pipeline.COLUMNS), name
        assert stage(spark, docs.where("false"), str(folder)).count() == 0, name
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "personal_data", "tokens"]


def test_one_of_each_group_stays(spark):
    rows = [(1, "a b c d e f g h", "l", "s", 1), (1, "a b c d e f g h", "l", "s", 1), (2, "a b c d e f g h", "l", "s", 1), (3, None, "l", "s", 1), (None, "a b c d e f g h", "l", "s", 1), (4, "", "l", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.near_duplicate(spark, docs, "").collect()
    assert sorted((r.doc_id or 0) for r in kept) == [0, 1, 3, 4]


def test_every_operator_is_registered():
    names = contract.queries()
    for n in range(1, 14):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names and set(QUERIES) <= set(names) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    duck = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    got = QUERIES[name](spark, folder)
    want = duck.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(map(tuple, want.fetchall()))


def test_pii_query_lists_kinds_in_order(spark):
    row = QUERIES["op9_pii"](spark, "/root/testdata/sf0.001").where("n_email + n_ip + n_card + n_phone > 1").first()
    kinds = [s.split(":")[0] for s in row.spans.split(",") if not s.startswith("term")]
    assert kinds == sorted(kinds, key=list(personal_data.KINDS).index)
