"""Language identification by compression with per-language zstandard dictionaries."""

from __future__ import annotations

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from routepulse.llm.common import map_batches, only, slices

#: Labelled rows per language that dictionaries are made of, and bytes of a dictionary.
SAMPLE_ROWS = 400
DICTIONARY_BYTES = 256 << 10
#: Languages that may be told apart: bounds the dictionaries in memory.
MAX_LANGUAGES = 200
#: Bits that the second-best language must cost more, per 1000 bits of the best.
MARGIN = 5
#: Compression level by the text's length in bytes: short texts need the finer search, and can afford it.
LEVELS = ((300, 15), (1500, 9), (None, 3))
UNKNOWN = "und"


#: ASCII letters in lower case, other ASCII characters as blanks.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def plain(text: str) -> bytes:
    """What is compressed: the text in lower case, without ASCII signs and digits."""
    return (" " + text.lower() + " ").encode().translate(_LETTERS)


def learn_languages(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS, dictionary_bytes: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """A raw-content dictionary per language, from a bounded sample of labelled rows.

    ``labelled`` has doc_id, text, lang; NULL languages and texts without a letter teach
    nothing. The sample is the ``sample_rows`` rows per language that come first by a
    hash of doc_id (whole texts, repeated texts once), cut at ``dictionary_bytes`` for
    each language. No row gives no dictionary.
    """
    rows = only(labelled, "doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = rows.select("doc_id", "lang").withColumn("place", F.row_number().over(order)).where(F.col("place") <= sample_rows).drop("place")
    languages = chosen.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect()
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    # at most MAX_LANGUAGES * sample_rows ids; of each text at most a dictionary's bytes are used
    texts = rows.join(F.broadcast(chosen.distinct()), ["doc_id", "lang"]).select("lang", "doc_id", F.substring("text", 1, dictionary_bytes).alias("text"))
    found: dict[str, list[tuple[int, int, str]]] = {}
    for row in texts.select("lang", F.xxhash64("doc_id").alias("h"), "doc_id", "text").distinct().toLocalIterator():
        found.setdefault(row.lang, []).append((row.h, row.doc_id, row.text))
    out = {}
    for lang, sample in sorted(found.items()):
        content = b"".join(dict.fromkeys(plain(text) for *_, text in sorted(sample)))
        if len(content) > 8:
            out[lang] = content[:dictionary_bytes]
    return out


def identify_languages(docs: DataFrame, dictionaries: dict[str, bytes], margin: float = MARGIN, id_column: str = "doc_id", text_column: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: id, ``keep``, lang_pred, score (0 to 1), rejected.

    The whole text is compressed with each dictionary; the smallest result names the
    language (ties: the alphabetically first). ``score`` is
    the share that the best language saves against the second best; with one language it
    is 1. A document is rejected when the second best
    costs less than ``margin`` / 1000 more, or when its text is NULL or has no letter:
    then the language is "und" and the score 0. Only the text is looked at. Repeated rows
    are judged each; an empty table gives an empty table. Without dictionaries every
    document is "und".
    """
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)  # MAX_LANGUAGES dictionaries at most

    def work(batches):
        import regex
        import zstandard as z

        letter = regex.compile(r"\p{L}")
        names = list(shared.value)
        encoders = []
        for content in shared.value.values():
            encoders.append([])
            for _, level in LEVELS:
                dictionary = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
                dictionary.precompute_compress(level=level)
                encoders[-1].append(z.ZstdCompressor(dict_data=dictionary, level=level, write_content_size=False, write_checksum=False, write_dict_id=False))
        for batch in batches:
            for part in slices(batch, text_column):
                texts = part.column(text_column).to_pylist()
                best, score, rejected = [], [], []
                for text in texts:
                    if not text or not names or not letter.search(text):
                        best.append(UNKNOWN)
                        score.append(0.0)
                        rejected.append(True)
                        continue
                    data = plain(text)
                    which = next(i for i, (limit, _) in enumerate(LEVELS) if limit is None or len(data) < limit)
                    sizes = np.array([len(e[which].compress(data)) for e in encoders])
                    first = int(sizes.argmin())
                    others = np.delete(sizes, first)
                    second = int(others.min()) if len(others) else 0
                    best.append(names[first])
                    score.append(1 - sizes[first] / second if second else 1.0)
                    rejected.append(bool(second) and 1000 * (second - sizes[first]) < margin * sizes[first])
                yield {f"key{i}": part.column(c) for i, c in enumerate((id_column, *keep))} | {"lang_pred": best, "score": score, "rejected": rejected}

    kinds = dict(docs.dtypes)
    keys = ", ".join(f"key{i} {kinds[c]}" for i, c in enumerate((id_column, *keep)))
    out = map_batches(only(docs, *dict.fromkeys((id_column, text_column, *keep))), work, f"{keys}, lang_pred string, score double, rejected boolean")
    return out.withColumnsRenamed({f"key{i}": c for i, c in enumerate((id_column, *keep))})
