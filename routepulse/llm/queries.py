"""The registered queries of this package, each over its whole table, and their SQL."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routepulse.llm import (
    bpe,
    contamination,
    html_extraction,
    language_id,
    lexical_search,
    lm_scoring,
    near_duplicates,
    packing,
    periodic_runs,
    personal_data,
    similar_vectors,
    token_counts,
    url_filter,
)
from routepulse.llm.common import only, prepare

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    """Register a function of (spark, folder) under its name."""

    def add(function):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(prepare(spark), folder)

        QUERIES[function.__name__] = run
        if sql:
            ORACLES[function.__name__] = sql
        return run

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary(name: str) -> bytes:
    """A public tokenizer's file; it is read by the driver and sent to the tasks."""
    import public_tokenizers

    return Path(public_tokenizers.path(name)).read_bytes()


def fold(column: str, folds: int):
    """The fold of a document: crc32 of its id as text, modulo ``folds``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % folds


@query()
def op1_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_extraction.extract_text(table(spark, folder, "pages"))


@query("""
    WITH docs AS (SELECT DISTINCT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    items AS (SELECT DISTINCT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM benchmark),
    sizes AS (SELECT item_id, w, least(len(w), 5) AS k FROM items WHERE item_id IS NOT NULL AND len(w) > 0),
    wanted AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS shingle FROM sizes, unnest(range(1, len(w) - k + 2)) AS t(i)),
    held AS (SELECT DISTINCT doc_id, k, array_to_string(w[i:i + k - 1], ' ') AS shingle FROM docs, (SELECT DISTINCT k FROM sizes), unnest(range(1, len(w) - k + 2)) AS t(i)),
    totals AS (SELECT item_id, count(*) AS n FROM wanted GROUP BY ALL),
    shared AS (SELECT doc_id, item_id, count(*) AS s FROM held JOIN wanted USING (k, shingle) GROUP BY ALL)
    SELECT doc_id, item_id, n AS n_shingles, s AS n_shared FROM shared JOIN totals USING (item_id) WHERE 100 * s >= 80 * n
""")
def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = only(table(spark, folder, "documents"), "doc_id", "text")
    found = contamination.find_items(docs, table(spark, folder, "benchmark"))
    return found.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*")


@query()
def op3_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, folder, "documents"), words=3, percent=85)


@query()
def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    dictionaries = language_id.learn_languages(docs.where(fold("doc_id", 3) != 1))
    found = language_id.identify_languages(only(docs, "doc_id", "text"), dictionaries)
    return found.withColumn("held_out", fold("doc_id", 3) == 1)


@query()
def op5_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return bpe.encode_digests(docs, vocabulary("word_bpe_49k.json").decode())


@query()
def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, folder, "documents"), vocabulary("piece_bpe_32k.model"))


@query()
def op7_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scored = lm_scoring.score_texts(docs, docs.where(fold("doc_id", 5) != 1))
    return scored.withColumn("held_out", fold("doc_id", 5) == 1)


@query("""
    WITH vectors AS (
        SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scores AS (
        SELECT q.vec_id AS query_id, r.vec_id,
            CAST(list_sum(list_transform(range(1, len(r.v) + 1), lambda i: q.v[i] * r.v[i])) AS BIGINT) AS score
        FROM vectors q JOIN vectors r ON q.vec_id <> r.vec_id AND len(q.v) = len(r.v)
        WHERE q.vec_id % 50 = 0),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scores)
    SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 5
""")
def op8_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = only(table(spark, folder, "embeddings"), "vec_id", "embedding").select("vec_id", similar_vectors.quantised(F.col("embedding")).alias("vector"))
    return similar_vectors.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5)


@query()
def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    kinds = tuple(personal_data.KINDS)
    found = personal_data.find_personal_data(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        *(F.size(kind).cast("long").alias(f"n_{kind}") for kind in kinds),
        F.sha2(personal_data.listed(kinds), 256).alias("base_sha256"),
        personal_data.listed((*kinds, "term")).alias("spans"),
    )


#: The rules that the URLs are judged by.
URL_RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]


@query()
def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, folder, "pages"), URL_RULES)


def planted_periods(doc_id, text):
    """The text, with a periodic tail planted in a tenth of the documents, as their ids decide."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def planted(words):
        n = F.size(words)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        tail = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
        return F.when(n > 0, F.array_join(F.concat(F.slice(words, 1, a), F.slice(tail, 1, n - a)), " ")).otherwise("")

    # an array of one element: its words are cut out once, however often they are named
    words = F.array(F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), 0))
    return F.when((h % 10 == 0) & text.isNotNull(), F.get(F.transform(words, planted), 0)).otherwise(text)


@query()
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", planted_periods(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic_runs.find_runs(docs)
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("size"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best.size")).alias("length"),
        F.col("best.period").alias("period"),
        F.floor(1000 * -F.col("best.size") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


#: Free tokens that a sequence of 2048 may have before its pieces are cut to fill others.
PADDING = 16


@query()
def op12_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, folder, "documents"), vocabulary("word_bpe_49k.json").decode(), capacity=2048, end_id=1, padding=PADDING)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("""
    WITH terms AS (
        SELECT r, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
        FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents WHERE doc_id IS NOT NULL) AS d),
    asked AS (
        SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
        FROM benchmark WHERE item_id IS NOT NULL),
    sizes AS (SELECT r, doc_id, count(*) AS n FROM terms GROUP BY ALL),
    corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sizes),
    occurrences AS (SELECT r, term, count(*) AS tf FROM terms GROUP BY ALL),
    holding AS (SELECT term, count(*) AS df FROM occurrences GROUP BY ALL),
    scores AS (
        SELECT item_id, r, doc_id, CAST(sum(CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT)
            * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total)))) AS BIGINT) AS score
        FROM asked JOIN occurrences USING (term) JOIN holding USING (term) JOIN sizes USING (r), corpus
        GROUP BY ALL),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM scores WHERE score > 0)
    SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 50
""")
def op13_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"), 50)
