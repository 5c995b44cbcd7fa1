"""Personal data by patterns, and terms that give it away by their co-occurrence, in built-in functions only.

Patterns find e-mail addresses, IP addresses, card and phone numbers: the protected entities. Every entity is then
treated as in information-theoretic sanitisation. With probabilities taken from how many documents of the whole corpus
hold the entity, hold a term, or hold both, the term discloses ``PMI(term; entity)`` of the entity's information
``IC(entity)``. A term that reaches the threshold is as good as the entity itself, for instance the name that only ever
comes with a certain address, and is generalised in the documents that hold the entity. A term counts as held by
``smoothing`` more documents without the entity, so that few documents prove little.

Terms are runs of letters outside the base spans.

Places are code points. Positions come from cutting the text at the matches. Matches are worked off in blocks of the
square root of their number, so neither the text nor the list of spans is gone through again for every match. Terms are
found by joining the words of a text with the terms that go there, however many these are.

Defined cases: a null or empty text has no span. Equal texts have equal spans; rows that repeat identifier and text are one
document. A match that fails its check is dropped and the search goes on behind it. An empty table gives an empty result. Long texts are scanned whole.
Only the identifier and the text are read, whatever else there is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadtrail.llm.staging import bound, joined_by_size, landed

KINDS = ("email", "ip", "card", "phone", "term")
#: The base patterns, written so that a run of characters is entered at its start only and never walked back.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
TERM = r"\p{L}+"


SPANS = "array<struct<start:int,kind:int,end:int,value:string>>"


def no_spans() -> Column:
    return F.array().cast(SPANS)


def blocks(values: Column, use) -> Column:
    """``use(array of blocks)`` for the values cut into blocks of the square root of their number."""

    def cut(held: Column) -> Column:
        many = F.greatest(F.size(held), F.lit(1))
        size = F.ceil(F.sqrt(many)).cast("int")
        return use(F.transform(F.sequence(F.lit(1), many, size), lambda low: F.slice(held, low, size)))

    return bound(values, cut)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def passes_luhn(value: Column) -> Column:
    places = F.transform(F.split(F.reverse(digits(value)), ""), lambda d, i: F.when(i % 2 == 0, d.try_cast("int")).otherwise(
        F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), d.try_cast("int") + 1)
    ))
    return F.aggregate(places, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def is_ip(value: Column) -> Column:
    return value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")


def is_card(value: Column) -> Column:
    return F.length(digits(value)).between(14, 19) & passes_luhn(value)


def is_phone(value: Column) -> Column:
    return F.length(digits(value)).between(10, 15)


#: kind -> pattern, what a text must hold to be searched, check of a match, form in which an entity is compared
BASE = {
    "email": (EMAIL, "@", lambda m: F.lit(True), F.lower),
    "ip": (IP, ".", is_ip, lambda m: m),
    "card": (CARD, None, is_card, digits),
    "phone": (PHONE, "+", is_phone, digits),
}


def placed(text: Column, pattern: Column, kind: int) -> Column:
    """Every match as (start, kind, end, value): the gaps between matches say where they stand."""

    def walk(pieces: Column) -> Column:
        gaps, values = pieces["gaps"], pieces["values"]

        def step(seen: Column, pair: Column) -> Column:
            first = seen["at"] + F.length(pair["gaps"])
            last = first + F.length(pair["values"])
            span = F.struct(first.alias("start"), F.lit(kind).alias("kind"), last.alias("end"), pair["values"].alias("value"))
            return F.struct(last.alias("at"), F.concat(seen["spans"], F.array(span)).alias("spans"))

        def block(seen: Column, pairs: Column) -> Column:
            start = F.struct(seen["at"].alias("at"), no_spans().alias("spans"))
            done = F.aggregate(pairs, start, step)
            return bound(done, lambda d: F.struct(d["at"].alias("at"), F.concat(seen["blocks"], F.array(d["spans"])).alias("blocks")))

        pairs = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(values)).alias("gaps"), values.alias("values"))
        first = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPANS}>").alias("blocks"))
        return blocks(pairs, lambda cut: F.aggregate(cut, first, block, lambda seen: F.flatten(seen["blocks"])))

    values = F.regexp_extract_all(text, pattern, F.lit(0))
    return bound(
        values,
        lambda v: F.when(F.size(v) == 0, no_spans()).otherwise(
            bound(F.struct(F.split(text, pattern, F.lit(-1)).alias("gaps"), v.alias("values")), walk)
        ),
    )


def rewritten(text: Column, spans: Column, put) -> Column:
    """The text with ``put(span, at)`` for every span, in order of start; what ends before ``at`` is written already."""

    def block(seen: Column, own: Column) -> Column:
        base = seen["at"]
        last = F.greatest(base, F.array_max(F.transform(own, lambda s: s["end"])))

        def inside(piece: Column) -> Column:
            def step(held: Column, span: Column) -> Column:
                gap = F.substring(piece, held["at"] - base + 1, F.greatest(span["start"] - held["at"], F.lit(0)))
                parts = F.concat(held["parts"], F.array(gap, put(span, held["at"])))
                return F.struct(F.greatest(held["at"], span["end"]).alias("at"), parts.alias("parts"))

            start = F.struct(base.alias("at"), F.array().cast("array<string>").alias("parts"))
            return F.aggregate(own, start, step, lambda held: F.array_join(held["parts"], ""))

        done = bound(F.substring(text, base + 1, last - base), inside)
        return F.struct(last.alias("at"), F.concat(seen["parts"], F.array(done)).alias("parts"))

    def end(seen: Column) -> Column:
        return F.concat(F.array_join(seen["parts"], ""), F.substring(text, seen["at"] + 1, F.length(text)))

    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    changed = blocks(spans, lambda cut: F.aggregate(cut, first, block, end))
    return F.when(F.size(spans) > 0, changed).otherwise(text)


def passing(spans: Column, check) -> Column:
    return F.filter(spans, lambda s: check(s["value"]))


def of_kind(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def base_spans(text: Column) -> Column:
    """All base spans, by start, then kind."""
    found = []
    for kind, (pattern, mark, check, _) in BASE.items():
        spans = passing(placed(text, F.lit(pattern), KINDS.index(kind)), check)
        needed = F.contains(text, F.lit(mark)) if mark else text.rlike("[0-9]{4}|[0-9][ -][0-9]")
        found.append(F.when(needed, spans).otherwise(no_spans()))
    return F.array_sort(F.concat(*found))


def entity(span: Column) -> Column:
    """A protected entity in the form in which it is compared: kind and value."""
    value = F.lit(None).cast("string")
    for kind, (_, _, _, form) in BASE.items():
        value = F.when(span["kind"] == KINDS.index(kind), F.concat(F.lit(f"{kind}:"), form(span["value"]))).otherwise(value)
    return value


def terms_of(text: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower))


def blanked(text: Column, spans: Column) -> Column:
    """The text with every span as white space, so that places stay what they are."""
    return rewritten(text, spans, lambda s, at: F.repeat(F.lit(" "), F.greatest(s["end"] - F.greatest(s["start"], at), F.lit(0))))


def entity_mentions(docs: DataFrame) -> DataFrame:
    """One row per document and entity in it."""
    spans = docs.where(F.size("base") > 0).select("doc_id", "text_hash", F.explode("base").alias("span"))
    return spans.select("doc_id", "text_hash", entity(F.col("span")).alias("entity")).distinct()


def disclosing_terms(
    rows: DataFrame, found: DataFrame, mentions: DataFrame, threshold: float, smoothing: float
) -> DataFrame:
    """``entity``, ``term`` with PMI(term; entity) >= threshold * IC(entity), over all documents.

    ``PMI >= threshold * IC`` says n_term + smoothing <= n_both * (total / n_entity) ** (1 - threshold). As n_both is n_entity at
    most, a document's terms that are too frequent for each of its entities go before they are paired with them.
    """
    total = F.lit(float(rows.count()))
    of_entity = mentions.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))
    gain = F.pow(total / F.col("n_entity"), F.lit(1 - threshold))
    of_entity = of_entity.where(F.col("n_entity") < total).withColumn("gain", gain)
    held = landed(mentions.join(of_entity, "entity"), "pii-entities")
    most = held.groupBy("doc_id", "text_hash").agg(F.max(F.col("n_entity") * F.col("gain")).alias("most"))

    def same(a: DataFrame, b: DataFrame) -> Column:
        return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_hash"] == b["text_hash"])

    everywhere = rows.select(F.explode(terms_of(F.col("text"))).alias("term"), F.lit(1).alias("n"))
    # documents that have a term in base spans only do not hold it
    inside = found.where("in_spans IS NOT NULL").select(F.explode("in_spans").alias("term"), F.lit(-1).alias("n"))
    of_term = everywhere.union(inside).groupBy("term").agg(F.sum("n").alias("n_term"))
    texts = found.where("text IS NOT NULL").dropDuplicates(["doc_id", "text_hash"]).select("doc_id", "text_hash", "text")
    own = texts.join(most, same(texts, most)).select(texts["doc_id"], texts["text_hash"], "most", F.explode(terms_of(F.col("text"))).alias("term"))
    own = own.join(of_term, "term").where(F.col("n_term") + smoothing <= F.col("most") * (1 + 1e-9))
    own = landed(own.select("doc_id", "text_hash", "term", "n_term"), "pii-rare-terms")
    pairs = own.join(held, same(own, held)).where(F.col("n_term") + smoothing <= F.col("n_entity") * F.col("gain") * (1 + 1e-9))
    together = pairs.groupBy("entity", "term").agg(
        F.count(F.lit(1)).alias("n_both"), *[F.first(c).alias(c) for c in ("n_term", "n_entity")]
    )
    pmi = F.log(F.col("n_both") * total / (F.col("n_entity") * (F.col("n_term") + smoothing)))
    return together.where(pmi >= threshold * F.log(total / F.col("n_entity"))).select("entity", "term")


def document_spans(docs: DataFrame, id_column: str, text_column: str, threshold: float, smoothing: float) -> DataFrame:
    """``doc_id``, ``text_hash``, base spans and term spans of every row."""
    text = F.coalesce(docs[text_column], F.lit(""))
    rows = docs.select(docs[id_column].cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    scanned = rows.select("*", base_spans(F.col("text")).alias("base"))
    found = landed(
        scanned.withColumn("blank", F.when(F.size("base") > 0, blanked(F.col("text"), F.col("base")))).select(
            "doc_id", "text_hash", "base", F.col("blank").alias("text"),
            F.when(F.size("base") > 0, F.array_except(terms_of(F.col("text")), terms_of(F.col("blank")))).alias("in_spans"),
        ),
        "pii-spans",
    )
    mentions = landed(entity_mentions(found), "pii-mentions")
    texts = found.where("text IS NOT NULL").dropDuplicates(["doc_id", "text_hash"]).select("doc_id", "text_hash", "text")
    disclosing = landed(disclosing_terms(rows, found, mentions, threshold, smoothing), "pii-terms")
    keyed = mentions.join(disclosing, "entity").select("doc_id", "text_hash", "term").distinct()
    keyed = keyed.withColumnsRenamed({"doc_id": "own_id", "text_hash": "own_hash"})
    same = F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_hash") == F.col("text_hash"))
    words = texts.join(keyed.select("own_id", "own_hash").distinct(), same, "left_semi").select(
        "doc_id", "text_hash", F.explode(placed(F.col("text"), F.lit(TERM), KINDS.index("term"))).alias("span")
    )
    words = words.join(keyed, same & (F.lower(F.col("span.value")) == F.col("term")), "left_semi")
    with_terms = words.groupBy(F.col("doc_id").alias("own_id"), F.col("text_hash").alias("own_hash")).agg(
        F.array_sort(F.collect_list("span")).alias("extra")
    )
    with_terms = landed(with_terms, "pii-term-spans")
    return found.select("doc_id", "text_hash", "base").join(with_terms, same, "left").select(
        "doc_id", "text_hash", "base", F.coalesce("extra", no_spans()).alias("extra")
    )


def written(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def personal_data(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: float = 0.8, smoothing: float = 2.0
) -> DataFrame:
    """Per row: identifier, matches per kind, digest of the base spans, all spans, and how many there are, terms and in all."""
    found = document_spans(docs, id_column, text_column, threshold, smoothing)
    counts = [of_kind(F.col("base"), k).alias(f"n_{kind}") for k, kind in enumerate(KINDS[:4])]
    return found.select(
        F.col("doc_id").alias(id_column),
        *counts,
        F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(F.array_sort(F.concat("base", "extra"))).alias("spans"),
        F.size("extra").cast("long").alias("n_terms"),
        (F.size("base") + F.size("extra")).cast("long").alias("n_spans"),
    )


def replaced(text: Column, spans: Column) -> Column:
    """The text with every span generalised to its kind; of spans that overlap the first names the gap."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    return rewritten(text, spans, lambda s, at: F.when(s["start"] >= at, F.get(names, s["kind"])).otherwise(F.lit("")))


def sanitised(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    length_column: str | None = None,
    threshold: float = 0.8,
    smoothing: float = 2.0,
) -> DataFrame:
    """The rows with all their columns, personal data in the text generalised; a length column is brought up to date."""
    found = document_spans(docs, id_column, text_column, threshold, smoothing)
    spans = found.select("doc_id", "text_hash", F.array_sort(F.concat("base", "extra")).alias("spans"))
    spans = landed(spans.where(F.size("spans") > 0).dropDuplicates(["doc_id", "text_hash"]), "pii-all-spans")
    weight = spans.agg(F.coalesce(F.sum(F.size("spans") + 1), F.lit(0))).first()[0]
    spans = spans.select(
        F.col("doc_id").alias("own_id"),
        F.col("text_hash").alias("own_hash"),
        F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))).alias("spans"),
    )
    spans = joined_by_size(spans, weight)
    text = F.coalesce(docs[text_column], F.lit(""))
    columns = docs.columns
    keyed = docs.select(F.struct("*").alias("row"), docs[id_column].cast("long").alias("key_id"), F.xxhash64(text).alias("key_hash"))
    same = F.col("key_id").eqNullSafe(F.col("own_id")) & (F.col("key_hash") == F.col("own_hash"))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    rows = keyed.join(spans, same, "left").select("row", F.coalesce("spans", none).alias("spans"))
    rows = rows.select("row", replaced(F.col("row").getField(text_column), F.col("spans")).alias("clean"))
    new = {text_column: F.col("clean")}
    if length_column:
        new[length_column] = F.length("clean").cast(docs.schema[length_column].dataType)
    return rows.select([new.get(c, F.col("row").getField(c)).alias(c) for c in columns])
