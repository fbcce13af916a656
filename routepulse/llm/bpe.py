"""Byte-level BPE with word ends: encoding and decoding by a pair occurrence index.

The distinct words of a batch are normalised, cut into pre-tokens and laid out in one
symbol array. An index maps every mergeable pair of neighbours to all its positions in
that array. Active merge ranks are taken in ascending order; a rank is applied at all
positions of its pair, from left to right, and only the lists of the pairs that
appear at the merged places are extended. Words do not interact, so the result is that
of merging each word alone. Pre-tokens that were encoded before are not encoded again.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from routepulse.llm.common import gathered, map_batches, only

#: Pre-tokens whose ids a task remembers between batches (memory only).
REMEMBERED = 1 << 19
#: Bytes of text that are encoded at a time (memory only).
SLICE_BYTES = 1 << 20
#: Blanks that no pre-token contains.
BLANKS = re.compile("[ \t\n\r\x0b\x0c]+")
#: Texts of these letters only are lower-cased and cut here, as the library does it; it does the others, word by word.
SIMPLE = re.compile("[ \t\n\r!-~À-ÖØ-öø-ÿ]*")
CUT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^ \t\n\ra-zß-öø-ÿ0-9]+")
CUT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class Encoder:
    """The vocabulary and merges of a tokenizer file of kind "BPE with word ends"."""

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        content = json.loads(definition)
        model = content["model"]
        if model.get("continuing_subword_prefix") or model.get("byte_fallback") or model.get("ignore_merges"):
            raise ValueError("this kind of BPE is not handled")
        library = Tokenizer.from_str(definition)  # for normalising and cutting words only
        steps = [json.dumps(content[x]) for x in ("normalizer", "pre_tokenizer")]
        self.simple = json.dumps(CUT_PATTERN) in steps[1] and "Lowercase" in steps[0]
        self.normalize, self.cut = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.vocabulary, self.suffix = model["vocab"], model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] or BLANKS.search(t["content"]) for t in content["added_tokens"]):
            raise ValueError("added tokens of this kind are not handled")
        self.names = {i: t for t, i in self.vocabulary.items()} | {i: t for t, i in self.special.items()}
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.ranks: dict[tuple[int, int], int] = {}
        self.merged: list[tuple[int, int, int]] = []
        made: dict[int, int] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            a, b, c = self.vocabulary[left], self.vocabulary[right], self.vocabulary[left + right]
            if made.get(a, -1) >= rank or made.get(b, -1) >= rank:
                raise ValueError("a merge stands before the merge that makes its part")
            made.setdefault(c, rank)
            self.ranks[a, b] = rank
            self.merged.append((a, b, c))
        self.known: dict[str, tuple[int, str, str]] = {}
        # how the vocabulary writes the letters of SIMPLE
        self.letters = {c: self.cut(c)[0][0] for c in map(chr, (*range(33, 127), *range(0xC0, 0x100)))}

    def merge(self, pieces: list[list[int]]) -> list[list[int]]:
        """Apply all merges to many symbol sequences at once."""
        symbols = [s for piece in pieces for s in piece]
        after, before, ranks = [], [], self.ranks
        index: dict[int, list[int]] = {}
        start = 0
        for piece in pieces:
            end = start + len(piece)
            after.extend(range(start + 1, end + 1))
            before.extend(range(start - 1, end - 1))
            if end > start:
                after[-1] = before[start] = -1
            for i in range(start, end - 1):
                rank = ranks.get((symbols[i], symbols[i + 1]))
                if rank is not None:
                    index.setdefault(rank, []).append(i)
            start = end
        active = list(index)
        heapq.heapify(active)
        while active:
            rank = heapq.heappop(active)
            a, b, c = self.merged[rank]
            for i in sorted(index.pop(rank)):
                j = after[i]
                if symbols[i] != a or j < 0 or symbols[j] != b:
                    continue  # taken by an earlier merge
                symbols[i], symbols[j] = c, -1
                after[i] = k = after[j]
                if k >= 0:
                    before[k] = i
                    new = ranks.get((c, symbols[k]))
                    if new is not None:
                        if new not in index:
                            index[new] = []
                            heapq.heappush(active, new)
                        index[new].append(i)
                p = before[i]
                if p >= 0:
                    new = ranks.get((symbols[p], c))
                    if new is not None:
                        if new not in index:
                            index[new] = []
                            heapq.heappush(active, new)
                        index[new].append(p)
        out, start = [], 0
        for piece in pieces:
            end = start + len(piece)
            out.append([s for s in symbols[start:end] if s >= 0])
            start = end
        return out

    def cuts(self, text: str) -> list[str]:
        """Pre-tokens, those of the library preceded by a blank: they are in the vocabulary's letters."""
        if self.simple and SIMPLE.fullmatch(text) and "<" not in text:
            return CUT.findall(text.lower())
        out = []
        for word in BLANKS.split(text):
            for n, part in enumerate(self.split.split(word) if self.split else [word]):
                if n % 2:
                    out.append(part)
                elif part:
                    out.extend([" " + x for x, _ in self.cut(self.normalize(part))])
        return out

    def learn(self, pieces: list[str]) -> None:
        """Encode pre-tokens and remember their tokens."""
        names, vocabulary, suffix = self.names, self.vocabulary, self.suffix
        symbols = []
        for piece in pieces:
            if piece[0] == " ":
                piece = piece[1:]
            elif not piece.isascii():
                piece = "".join(map(self.letters.__getitem__, piece))
            symbols.append([*map(vocabulary.__getitem__, piece[:-1]), vocabulary[piece[-1] + suffix]])
        for piece, ids in zip(pieces, self.merge(symbols), strict=True):
            self.known[piece] = len(ids), " ".join(map(str, ids)), " ".join([names[i] for i in ids])

    def encode(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """Number of tokens, ids joined by blanks, and the decoded text of each text."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        if not self.known:
            self.known = {text: (1, str(i), text) for text, i in self.special.items()}
        known, cut = self.known, [self.cuts(text) for text in texts]
        self.learn(list({x for pieces in cut for x in pieces if x not in known}))
        out = []
        for pieces in cut:
            found = list(map(known.__getitem__, pieces))
            out.append((sum([x[0] for x in found]), " ".join([x[1] for x in found]), " ".join([x[2] for x in found])))
        return out


def encode_documents(docs: DataFrame, definition: str, id_column: str = "doc_id", text_column: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: id, columns named in ``keep``, n_tokens, ids, decoded.

    ``ids`` are the token ids in decimal, joined by blanks; ``decoded`` is the text made
    of them: with no decoder in the tokenizer's definition, its tokens joined by blanks.
    NULL and empty texts have no tokens and an empty decoded text; special strings in a
    text become special tokens. Repeated rows are encoded each, an empty table gives an
    empty table, other columns are not read.
    """
    return _encoded(docs, definition, id_column, text_column, keep, "n_tokens long, ids string, decoded string", lambda n, ids, decoded: {"n_tokens": n, "ids": ids, "decoded": decoded})


def encode_digests(docs: DataFrame, definition: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Like ``encode_documents``, with SHA-256 of ids and decoded text in their place."""

    def digests(n, ids, decoded):
        sha = [[hashlib.sha256(x.encode()).hexdigest() for x in column] for column in (ids, decoded)]
        return {"n_tokens": n, "ids_sha256": sha[0], "decoded_sha256": sha[1]}

    return _encoded(docs, definition, id_column, text_column, (), "n_tokens long, ids_sha256 string, decoded_sha256 string", digests)


def _encoded(docs, definition, id_column, text_column, keep, schema, finish):
    shared = docs.sparkSession.sparkContext.broadcast(definition)  # one tokenizer file

    def work(batches):
        encoder = Encoder(shared.value)
        for part in gathered(batches, text_column, SLICE_BYTES):
            found = encoder.encode(pc.fill_null(part.column(text_column), "").to_pylist())
            columns = finish(*([x[i] for x in found] for i in range(3)))
            yield {f"key{i}": part.column(c) for i, c in enumerate((id_column, *keep))} | columns

    kinds = dict(docs.dtypes)
    keys = ", ".join(f"key{i} {kinds[c]}" for i, c in enumerate((id_column, *keep)))
    out = map_batches(only(docs, *dict.fromkeys((id_column, text_column, *keep))), work, f"{keys}, {schema}")
    return out.withColumnsRenamed({f"key{i}": c for i, c in enumerate((id_column, *keep))})
