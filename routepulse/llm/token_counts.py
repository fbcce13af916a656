"""Token counts of a sentencepiece BPE model without materialising token ids.

A pre-token is a run of blanks with the other characters that follow it. No piece
of the model continues past the end of a pre-token (checked when the model is loaded),
so a text has the sum of its pre-tokens' pieces. Each batch of documents finds its
distinct pre-tokens, counts the pieces of those not counted before, and joins the
counts to the per-document pre-token frequencies.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from routepulse.llm.common import gathered, map_batches, only

BLANK = "▁"  # how the model writes a blank
PRETOKEN = re.compile(f"{BLANK}+[^{BLANK}]*")
#: Pre-tokens whose counts a task remembers between batches (memory only).
REMEMBERED = 1 << 19
TOKEN_LIMIT = 4096


def count_tokens(docs: DataFrame, model: bytes, limit: int = TOKEN_LIMIT, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    NULL and empty texts have no bytes and no tokens. Repeated rows are counted each;
    other columns are not read. An empty table gives an empty table.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one vocabulary file

    def work(batches):
        pieces = Pieces(shared.value)
        for part in gathered(batches, text_column):
            texts = pc.fill_null(part.column(text_column), "")
            n = pieces.totals(texts)
            yield {"key": part.column(id_column), "n_bytes": pc.binary_length(texts).cast(pa.int64()), "n_tokens": n, "over_limit": n > limit}

    kind = dict(docs.dtypes)[id_column]
    out = map_batches(only(docs, id_column, text_column), work, f"key {kind}, n_bytes long, n_tokens long, over_limit boolean")
    return out.withColumnRenamed("key", id_column)


class Pieces:
    """Piece counts of pre-tokens, each counted once."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        vocabulary = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        if any(BLANK in piece.lstrip(BLANK) for piece in vocabulary):
            raise ValueError("pieces of this model run across pre-tokens")
        self.known: dict[str, int] = {}

    def counts(self, distinct: list[str]) -> np.ndarray:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = [x for x in distinct if x not in self.known]
        for i in range(0, len(new), 10_000):
            chunk = new[i : i + 10_000]
            # the model itself puts one blank in front
            found = self.model.encode([x.removeprefix(BLANK) for x in chunk], num_threads=1)
            for x, ids in zip(chunk, found, strict=True):
                # the blank alone is an empty text to the model, and one piece here
                self.known[x] = len(ids) if x != BLANK else 1
        return np.fromiter((self.known[x] for x in distinct), np.int64, len(distinct))

    def totals(self, texts: pa.Array) -> np.ndarray:
        """Tokens of every text."""
        marked = pc.replace_substring(texts, " ", BLANK)
        marked = pc.binary_join_element_wise(pc.if_else(pc.equal(texts, ""), "", BLANK), marked, "")
        plain = ~np.asarray(pc.match_substring(marked, BLANK * 2).to_pylist(), bool)
        sizes, words = np.zeros(len(texts), np.int64), []
        # texts without double blanks are split at the blanks, in C
        split = pc.split_pattern(marked, BLANK)
        for i, text in enumerate(marked.to_pylist()) if not plain.all() else ():
            if not plain[i]:
                words.append(PRETOKEN.findall(text))
                sizes[i] = len(words[-1])
        lists = split.filter(pa.array(plain))
        tokens = pc.list_flatten(pc.list_slice(lists, 1))
        sizes[plain] = pc.list_value_length(lists).to_numpy() - 1
        tokens = pc.binary_join_element_wise(BLANK, tokens, "")
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        tokens = pa.concat_arrays([tokens, pa.array([w for ws in words for w in ws], pa.string())])
        coded = tokens.dictionary_encode()
        codes = coded.indices.to_numpy()
        each = self.counts(coded.dictionary.to_pylist())
        # frequencies per document and distinct pre-token, joined to the counts
        docs = np.repeat(order, sizes[order])
        pairs, times = np.unique(docs * max(len(each), 1) + codes, return_counts=True)
        owners, which = pairs // max(len(each), 1), pairs % max(len(each), 1)
        return np.bincount(owners, weights=(times * each[which]).astype(float), minlength=len(texts)).astype(np.int64)
