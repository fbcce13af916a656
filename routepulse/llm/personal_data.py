"""Personal data: patterns, and terms of the corpus that give protected entities away.

Everything here is DataFrame operations. An entity is a value that a pattern finds. A
term (a word of three letters or more) anywhere in a text that holds an entity co-occurs with
it. With D documents, IC(e) = -log2(n(e) / D) is what an entity is worth, and
PMI(t; e) = log2(n(t, e) * D / (n(t) * n(e))) is how much of it a term reveals, all n
counted in documents. Where PMI reaches ``THRESHOLD`` of IC, over at least
``LEAST_TEXTS`` different texts, all the term's occurrences in texts with that entity are spans of
kind "term", to be generalised or removed with the entity itself. As n(t, e) is n(e) at most, a term
in more than n(e) * (D / n(e)) ** (1 - ``THRESHOLD``) documents can't reach it: no such pair is made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routepulse.llm.common import only
from routepulse.session import stage

#: Kinds in order, and their patterns. Possessive runs and "not inside a run, unless a match
#: ended here" find the same matches as the plain patterns in linear time.
_LOCAL = r"A-Za-z0-9._%+-"
KINDS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without this has no match of the kind.
NEEDED = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
_PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

THRESHOLD = 0.8
LEAST_TEXTS = 3
TERM = r"\p{L}{3,}"
#: Stands for the letters of entities, whose words are no terms.
FILLER = "\ua7f7"
_SPANS = "array<struct<start:int,end:int,value:string>>"


def located(text: Column, pattern: str, wanted=None) -> Column:
    """All matches (``wanted(value)`` if given), leftmost and non-overlapping, with code point positions (end exclusive)."""
    # what stands between the matches and the matches themselves, each read once
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("before"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("value"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("found"))

    def step(state, pair):
        here = state["at"] + F.char_length(pair["before"])
        end = here + F.char_length(pair["value"])
        span = F.struct(here.alias("start"), end.alias("end"), pair["value"].alias("value"))
        longer = F.concat(state["found"], F.array(span))
        if wanted:
            longer = F.when(wanted(pair["value"]), longer).otherwise(state["found"])
        return F.when(pair["value"].isNull(), state).otherwise(F.struct(end.alias("at"), longer.alias("found")))

    return F.aggregate(pairs, start, step, lambda state: state["found"])


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    size = F.char_length(digits)

    def step(total, i):
        digit = F.substr(digits, i, F.lit(1)).cast("int")
        twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when((size - i) % 2 == 1, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), size), F.lit(0), step) % 10 == 0


def _holds(kind: str):
    """Whether a match of the kind is kept."""

    def check(span):
        value = span["value"]
        digits = F.regexp_replace(value, "[^0-9]", "")
        if kind == "ip":
            return value.rlike(rf"^(?:{_PART}\.){{3}}{_PART}$")
        if kind == "card":
            return F.when(F.char_length(digits).between(13, 19), luhn(digits)).otherwise(False)
        if kind == "phone":
            return F.char_length(digits).between(9, 15)
        return F.lit(True)

    return check


def _each(kinds, make) -> Column:
    """The spans of all kinds, each changed by ``make(kind)``, in one array."""
    return F.concat(*(F.transform("terms" if kind == "term" else kind, make(kind)) for kind in kinds))


def with_patterns(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """Adds a column per kind (email, ip, card, phone): its spans, in order of their start."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    found = {}
    for kind, pattern in KINDS.items():
        spans = F.filter(located(text, pattern), _holds(kind))
        found[kind] = F.when(text.rlike(NEEDED[kind]), spans).otherwise(F.array().cast(_SPANS))
    return docs.withColumns(found)


def with_entities(found: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc, fingerprint (of the text), text, entities (hashes): the texts that hold any, the letters of entities masked.

    ``found`` comes from ``with_patterns``.
    """
    spans = _each(KINDS, lambda kind: lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), F.xxhash64(F.concat(F.lit(f"{kind}:"), F.lower(s["value"]))).alias("entity")))
    rows = found.where(F.col(id_column).isNotNull()).select(F.col(id_column).alias("doc"), F.col(text_column).alias("text"), spans.alias("spans")).where(F.size("spans") > 0)
    text = F.col("text")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state, span):
        # what an earlier span has masked stays so
        first = F.greatest(span["start"], state["at"])
        masked = F.regexp_replace(F.substr(text, first + 1, F.greatest(span["end"] - first, F.lit(0))), r"\p{L}", FILLER)
        return F.struct(F.greatest(span["end"], state["at"]).alias("at"), F.concat(state["out"], F.substr(text, state["at"] + 1, first - state["at"]), masked).alias("out"))

    masked = F.aggregate(F.array_sort("spans"), start, step, lambda s: F.concat(s["out"], F.substr(text, s["at"] + 1, F.char_length(text))))
    entities = F.array_distinct(F.transform("spans", lambda s: s["entity"]))
    return rows.select("doc", F.xxhash64("text").alias("fingerprint"), masked.alias("text"), entities.alias("entities"))


def disclosing_spans(docs: DataFrame, found: DataFrame, threshold: float = THRESHOLD, least_texts: int = LEAST_TEXTS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc, fingerprint, terms: the spans (array of start, end, value) of terms that give entities away."""
    held = stage(with_entities(found, id_column, text_column), "pii-held")
    key = ["doc", "fingerprint"]
    mentions = held.select(*key, F.explode("entities").alias("entity"))
    # only entities in enough different texts can have a term that is beside them in so many
    entities = mentions.groupBy("entity").agg(F.countDistinct("fingerprint").alias("texts"), F.countDistinct("doc").alias("with_entity")).where(F.col("texts") >= least_texts)
    size = docs.agg(F.count("*").cast("double").alias("size"))
    rarity = F.col("size") / F.col("with_entity")
    entities = entities.join(F.broadcast(size)).select("entity", "with_entity", "size", (F.col("with_entity") * F.pow(rarity, F.lit(1 - threshold)) * (1 + 1e-9)).alias("limit"))  # one row
    entities = stage(entities, "pii-entities")
    most = entities.agg(F.coalesce(F.max("limit"), F.lit(0.0))).first()[0]
    mentions = stage(mentions.join(entities, "entity").distinct(), "pii-mentions")
    # counted before they are joined: a task sends a word once, however many documents hold it
    words = F.explode(F.array_distinct(F.regexp_extract_all(F.lower(text_column), F.lit(TERM), F.lit(0))))
    words = docs.select(words.alias("term")).select(F.xxhash64("term").alias("hash"))
    words = words.groupBy("hash").agg(F.count("*").alias("with_term")).where(F.col("with_term").between(least_texts, most))
    terms = F.explode(F.array_distinct(F.transform(F.regexp_extract_all(F.lower("text"), F.lit(TERM), F.lit(0)), lambda t: F.xxhash64(t))))
    terms = held.join(mentions.select(*key).distinct(), key, "left_semi").select(*key, terms.alias("hash")).join(words, "hash")
    pairs = terms.join(mentions, key).where(F.col("with_term") <= F.col("limit"))
    # counted per pair by document first, so that a frequent pair is summed on the map side
    pairs = pairs.groupBy("entity", "hash", "with_term", "with_entity", "size").agg(F.countDistinct("fingerprint").alias("texts"), F.countDistinct("doc").alias("both"))
    worth = F.log2(rarity)
    revealed = F.log2(F.col("both") * F.col("size") / (F.col("with_term") * F.col("with_entity")))
    flagged = stage(pairs.where((F.col("texts") >= least_texts) & (worth > 0) & (revealed >= threshold * worth)).select("entity", "hash"), "pii-flagged")
    told = mentions.select(*key, "entity").join(flagged, "entity").groupBy(*key).agg(F.collect_set("hash").alias("hashes"))
    spans = located(F.col("text"), TERM, lambda value: F.array_contains("hashes", F.xxhash64(F.lower(value))))
    spans = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lower(s["value"]).alias("value")))
    return held.join(told, key).select(*key, spans.alias("terms")).where(F.size("terms") > 0).dropDuplicates(key)


def find_personal_data(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: tuple[str, ...] = (), **options) -> DataFrame:
    """One row per document: id, ``keep``, and spans per kind: email, ip, card, phone, terms.

    NULL and empty texts have no spans. Repeated rows (and several rows with one id) are
    each found, and count as one document with one id for co-occurrence (in one text); rows with a NULL
    id have pattern spans only. An empty table gives an empty table; other columns are
    not read.
    """
    plain = only(docs, *dict.fromkeys((id_column, text_column, *keep)))
    found = with_patterns(plain, text_column)
    terms = disclosing_spans(plain, found, id_column=id_column, text_column=text_column, **options)
    columns = dict.fromkeys((id_column, *keep))
    kept = found.select(*columns, *KINDS, F.xxhash64(text_column).alias("fingerprint"))
    out = kept.join(terms.withColumnRenamed("doc", id_column), [id_column, "fingerprint"], "left")
    return out.select(*columns, *KINDS, F.coalesce("terms", F.array().cast(_SPANS)).alias("terms"))


def listed(kinds: tuple[str, ...]) -> Column:
    """"kind:start:end" by kind as given, then start, joined by commas."""
    return F.array_join(_each(kinds, lambda kind: lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"])), ",")


def sanitised(text: Column) -> Column:
    """The text with entities generalised to their kind, "<EMAIL>", and disclosing terms to "<TERM>".

    Spans that overlap become one, named by the one that starts first.
    """
    spans = _each((*KINDS, "term"), lambda kind: lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("end"), F.lit(f"<{kind.upper()}>").alias("name")))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state, span):
        end = -span["end"]
        fresh = F.concat(state["out"], F.substr(text, state["at"] + 1, span["start"] - state["at"]), span["name"])
        return F.struct(F.greatest(end, state["at"]).alias("at"), F.when(span["start"] >= state["at"], fresh).otherwise(state["out"]).alias("out"))

    changed = F.aggregate(F.array_sort(spans), start, step, lambda s: F.concat(s["out"], F.substr(text, s["at"] + 1, F.char_length(text))))
    return F.when(F.size(spans) > 0, changed).otherwise(text)
