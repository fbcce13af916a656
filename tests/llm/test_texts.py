"""Token counts, BPE and language identification against the libraries and held-out labels."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from routepulse.llm import bpe, language_id, token_counts
from routepulse.llm.queries import table, vocabulary

SMALL = "/root/testdata/sf0.001"
ODD = [
    None, "", " ", "  ", "a", " a  b ", "\n\t\r", "x▁ ▁▁y", "aaaaaaaaaaaa aaa", "it's I'LL they'Re ''s", "<s></s> <unk> <0x0A>",
    "x<|endoftext|>y <|startoftext|><|endoftext|>", "<|endoftext", "Σας İstanbul ΑΣ ﬀ é ́x 日本語🎉 １２３ 12a3 ß×÷", "a\x1cb\x85c\xa0d　e\x00f",
    "...!!! --- a_b #$%&", "word " * 3000, "z" * 20_000, "é" * 5_000, "12345 67,890.12",
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "clash", 7) for i, t in enumerate(ODD)] + [(3, ODD[3], "again", 7), (None, "no id", None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, key int").repartition(3)


def test_token_counts_equal_the_library(spark, odd):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = token_counts.count_tokens(odd, vocabulary("piece_bpe_32k.model"), limit=100)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    rows = got.collect()
    assert len(rows) == len(ODD) + 2
    for r in rows:
        text = "no id" if r.doc_id is None else ODD[r.doc_id] or ""
        n = len(library.encode(text))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 100), text[:50]


def test_token_counts_of_documents_equal_the_library(spark):
    docs = table(spark, SMALL, "documents")
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in token_counts.count_tokens(docs, vocabulary("piece_bpe_32k.model")).collect():
        assert r.n_tokens == len(library.encode(texts[r.doc_id]))


def test_pieces_across_pretokens_are_refused():
    class Model:
        def get_piece_size(self):
            return 1

        def id_to_piece(self, i):
            return "of▁the"

    pieces = token_counts.Pieces.__new__(token_counts.Pieces)
    real = sentencepiece.SentencePieceProcessor
    try:
        sentencepiece.SentencePieceProcessor = lambda model_proto: Model()
        with pytest.raises(ValueError, match="across"):
            pieces.__init__(b"")
    finally:
        sentencepiece.SentencePieceProcessor = real


def test_bpe_equals_the_library(spark, odd):
    definition = vocabulary("word_bpe_49k.json").decode()
    library = Tokenizer.from_str(definition)
    rows = bpe.encode_documents(odd, definition, keep=("n_tokens_",) if "n_tokens_" in odd.columns else ()).collect()
    assert len(rows) == len(ODD) + 2
    for r in rows:
        text = "no id" if r.doc_id is None else ODD[r.doc_id] or ""
        ids = library.encode(text, add_special_tokens=False).ids
        assert (r.n_tokens, r.ids) == (len(ids), " ".join(map(str, ids))), text[:50]
        assert r.decoded == library.decode(ids, skip_special_tokens=False)


def test_bpe_digests_of_documents(spark):
    docs = table(spark, SMALL, "documents")
    definition = vocabulary("word_bpe_49k.json").decode()
    library = Tokenizer.from_str(definition)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in bpe.encode_digests(docs, definition).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_merging_many_words_is_merging_each():
    encoder = bpe.Encoder(vocabulary("word_bpe_49k.json").decode())
    letters = random.Random(5)
    words = ["".join(letters.choices("aehnrst", k=letters.randint(1, 12))) for _ in range(300)]
    together = encoder.encode([" ".join(words)])[0]
    alone = [bpe.Encoder.encode(encoder, [w])[0] for w in words]
    assert together == (sum(x[0] for x in alone), " ".join(x[1] for x in alone), " ".join(x[2] for x in alone))


@pytest.mark.parametrize("limit", [0, 1 << 19])
def test_remembering_changes_nothing(monkeypatch, limit):
    monkeypatch.setattr(bpe, "REMEMBERED", limit)
    encoder = bpe.Encoder(vocabulary("word_bpe_49k.json").decode())
    texts = ["the cat <|endoftext|>", "sat on", "the mat"]
    assert [encoder.encode([t])[0] for t in texts] == encoder.encode(texts)


def test_language_of_held_out_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    dictionaries = language_id.learn_languages(docs.where(fold != 1))
    assert sorted(dictionaries) == ["de", "en", "es", "fr"]
    assert all(len(d) <= language_id.DICTIONARY_BYTES for d in dictionaries.values())
    found = language_id.identify_languages(docs, dictionaries, keep=("lang",)).where(fold == 1).collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 0.96 * len(found)
    assert all(0 <= r.score <= 1 for r in found)


def test_language_of_odd_texts(spark, odd):
    labelled = spark.createDataFrame(
        [(i, t, g, "x") for i, (t, g) in enumerate([("the cat and the dog", "en"), ("der Hund und die Katze", "de"), (None, "fr"), ("123", "es"), ("x y", None)])],
        "doc_id long, text string, lang string, clash string",
    )
    dictionaries = language_id.learn_languages(labelled)
    assert list(dictionaries) == ["de", "en"]
    rows = language_id.identify_languages(odd, dictionaries).collect()
    assert len(rows) == len(ODD) + 2
    for r in rows:
        text = "no id" if r.doc_id is None else ODD[r.doc_id]
        if not text or not any(c.isalpha() for c in text):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
        else:
            assert r.lang_pred in ("de", "en")
    sure = language_id.identify_languages(labelled, dictionaries).where("doc_id < 2").orderBy("doc_id").collect()
    assert [(r.lang_pred, r.rejected) for r in sure] == [("en", False), ("de", False)]
    # ties go to the first and are rejected; one language is certain; none leaves all undetermined
    tie = language_id.identify_languages(labelled, {"a": b"same words", "b": b"same words"}).where("doc_id = 0").first()
    assert (tie.lang_pred, tie.rejected) == ("a", True)
    one = language_id.identify_languages(labelled, {"en": b"the cat sat"}).where("doc_id = 0").first()
    assert (one.lang_pred, one.score, one.rejected) == ("en", 1.0, False)
    assert {r.lang_pred for r in language_id.identify_languages(labelled, {}).collect()} == {"und"}


def test_empty_tables(spark, odd):
    none = odd.where("false")
    definition, model = vocabulary("word_bpe_49k.json").decode(), vocabulary("piece_bpe_32k.model")
    assert token_counts.count_tokens(none, model).collect() == []
    assert bpe.encode_documents(none, definition).collect() == []
    assert language_id.learn_languages(spark.createDataFrame([], "doc_id long, text string, lang string")) == {}
    assert language_id.identify_languages(none, {"en": b"some text"}).collect() == []
