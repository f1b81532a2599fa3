"""Merkle trees of documents, with DataFrame functions only.

A text is cut into paragraphs (at line ends) and those into pieces: a piece ends after white space that follows a mark
or one of a few letters, or after ``PIECE_CHARS`` characters. Where a piece ends depends on the characters next to it
alone, so an edit changes the pieces near it. Paragraphs are put together to sections; a section ends with an empty
paragraph, or one whose key is a multiple of ``SECTION``.

A piece's key is a hash of its characters, a paragraph's one of its pieces' keys in order, a section's one of its
paragraphs' keys, the root a digest of the sections' keys: equal roots are equal texts, and for two texts the
sections and paragraphs that differ are found from the root down. A fingerprint has root, sections and a sketch of the
pieces, from which the likeness of two texts is told.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.session import materialize

PIECE_CHARS = 96
SECTION = 4

# Pieces that a fingerprint names for likeness: those with the smallest keys.
SKETCH = 256

# Letters after which, before white space, a piece ends; with all marks they end about every second word. Fixed values.
LETTERS = "aegnorsAEGNORSàéßñáíóаеоиאהיابنتन"

_PIECE = rf"[^\n]{{0,{PIECE_CHARS - 1}}}?(?:[\p{{P}}\p{{S}}{LETTERS}][ \t]+|[^\n](?=\n|$))|[^\n]{{1,{PIECE_CHARS}}}"


def paragraphs(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _pieces(paragraph: Column) -> Column:
    return F.transform(F.regexp_extract_all(paragraph, F.lit(_PIECE), F.lit(0)), lambda piece: F.xxhash64(piece))


def _paragraph_key(pieces: Column) -> Column:
    return F.xxhash64(F.size(pieces), pieces)


def _spans(keys: Column) -> Column:
    """The sections of a text: key, number of the first paragraph (from 0) and of the last."""
    empty = F.xxhash64(F.lit(0), F.expr("cast(array() as array<bigint>)"))
    place = F.sequence(F.lit(1), F.size(keys))
    last = F.filter(place, lambda i: _ends(F.element_at(keys, i), empty) | (i == F.size(keys)))
    start = F.concat(F.array(F.lit(1)), F.transform(last, lambda i: i + 1))
    ends = F.arrays_zip(F.slice(start, 1, F.size(last)).alias("a"), last.alias("b"))

    def span(s: Column) -> Column:
        key = F.xxhash64(F.slice(keys, s["a"], s["b"] - s["a"] + 1))
        return F.struct(key.alias("key"), (s["a"] - 1).alias("first"), (s["b"] - 1).alias("last"))

    return F.transform(ends, span)


def _ends(key: Column, empty: Column) -> Column:
    return (F.pmod(key, F.lit(SECTION)) == 0) | (key == empty)


def _described(text: Column) -> list[Column]:
    """Length of a text and ``pieces``, its pieces' keys by paragraph; ``levels`` makes the rest of the tree of them."""
    return [F.length(text).cast("long").alias("n_chars"), F.transform(paragraphs(text), _pieces).alias("pieces")]


def levels(docs: DataFrame, pieces: str = "pieces", prefix: str = "") -> DataFrame:
    """Adds ``paragraphs`` (their keys), ``spans`` (sections with their paragraphs), ``sections`` (their keys), ``root``
    and ``sketch`` to rows with ``pieces``."""
    keys = docs.withColumn(f"{prefix}paragraphs", F.transform(pieces, _paragraph_key))
    keys = keys.withColumn(f"{prefix}spans", _spans(F.col(f"{prefix}paragraphs")))
    keys = keys.withColumn(f"{prefix}sections", F.col(f"{prefix}spans.key")).withColumn(f"{prefix}sketch", sketch(F.col(pieces)))
    packed = F.concat_ws(",", F.transform(f"{prefix}sections", lambda k: F.hex(k)))
    return keys.withColumn(f"{prefix}root", F.sha2(packed, 256))


def fingerprint(prefix: str = "") -> Column:
    """Root, section keys and sketch in hexadecimal form."""

    def written(keys: Column, digits: int) -> Column:
        return F.concat_ws(".", F.transform(keys, lambda k: F.lpad(F.hex(k), digits, "0")))

    parts = [F.col(f"{prefix}root"), written(F.col(f"{prefix}sections"), 16), written(F.col(f"{prefix}sketch"), 8)]
    return F.lower(F.concat_ws(":", *parts))


def sketch(pieces: Column) -> Column:
    """The ``SKETCH`` smallest of the distinct pieces of a tree, by 31 bits of their keys. All, if it has no more."""
    short = F.transform(F.flatten(pieces), lambda key: key.bitwiseAND(F.lit(0x7FFFFFFF).cast("long")).cast("int"))
    return F.slice(F.sort_array(F.array_distinct(short)), 1, SKETCH)


def likeness(a: Column, b: Column) -> Column:
    """Common pieces of two trees by all of their pieces, told from the sketches that their fingerprints hold.

    The smallest pieces of both together are a sample of all, and it is known which of them both trees have. With no
    more pieces than a sketch has it is exact; 1 if both have none.
    """

    def share(known: Column) -> Column:
        every, both = known["every"], known["both"]
        # ``both`` is in order, so what counts of it is what is not above the last of ``every``.
        common = F.size(F.filter(both, lambda key: key <= F.element_at(every, -1)))
        return F.when(F.size(every) == 0, 1.0).otherwise(common / F.size(every))

    every = F.slice(F.sort_array(F.array_union(a, b)), 1, SKETCH)
    return _let(F.struct(every.alias("every"), F.array_intersect(a, b).alias("both")), share)


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value made once, though a lambda of ``use`` asks for it again and again."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _dealt(keys: Column) -> Column:
    """Keys in about as many lists as a list has keys."""
    lists = F.greatest(F.ceil(F.sqrt(F.size(keys))).cast("int"), F.lit(1))
    return F.transform(F.sequence(F.lit(0), lists - 1), lambda j: F.filter(keys, lambda k: F.pmod(k, lists) == j))


def _among(dealt: Column, key: Column) -> Column:
    return F.array_contains(F.element_at(dealt, (F.pmod(key, F.size(dealt)) + 1).cast("int")), key)


def differing(a_sections: Column, a_paragraphs: Column, b_spans: Column, b_paragraphs: Column) -> Column:
    """Numbers (from 0) of the paragraphs of ``b`` that ``a`` does not have, found from the sections down.

    Sections that ``a`` has are passed over; of the others the paragraphs are looked at. Keys are dealt to lists, so a
    search goes through about the root of their number.
    """

    def paragraphs_of(known: Column) -> Column:
        other = F.filter(b_spans, lambda s: ~_among(known["sections"], s["key"]))

        def changed(span: Column) -> Column:
            every = F.sequence(span["first"], span["last"])
            return F.filter(every, lambda i: ~_among(known["paragraphs"], F.element_at(b_paragraphs, i + 1)))

        return F.flatten(F.transform(other, changed))

    return _let(F.struct(_dealt(a_sections).alias("sections"), _dealt(a_paragraphs).alias("paragraphs")), paragraphs_of)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, n_chars, pieces, paragraphs, spans, sections, sketch, root, fingerprint`` for every row.

    A null text is the empty one: one paragraph without pieces. Repeated rows and null ids are rows like others.
    Other columns are not looked at.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    return levels(rows.select("*", *_described(F.col("text")))).withColumn("fingerprint", fingerprint())


def next_ids(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``doc_id, next_id``: the next smaller id of each distinct one, and the largest for the smallest.

    Ids are dealt out by range and written once; in a range the next is a window's, and the first id of each range
    comes from the table of the ranges' largest ids, which has one row per partition.
    """
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    spread = ids.repartitionByRange("doc_id").withColumn("part", F.spark_partition_id())
    spread = materialize(spread, "ids")
    inside = F.lead("doc_id").over(Window.partitionBy("part").orderBy(F.desc("doc_id")))
    within = spread.withColumn("next_id", inside)
    tops = spread.groupBy("part").agg(F.max("doc_id").alias("top"))
    # One row per partition: the largest id of the range below, and of all for the lowest range.
    ranges = Window.partitionBy(F.lit(0)).orderBy("part")
    whole = Window.partitionBy(F.lit(0))
    below = tops.select("part", F.coalesce(F.lag("top").over(ranges), F.max("top").over(whole)).alias("below"))
    joined = within.join(below, "part")
    return joined.select("doc_id", F.coalesce("next_id", "below").alias("next_id"))


def with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``fingerprints`` beside those of an edited text: the last third replaced by as much of the next document.

    Adds ``edited_sha256``, ``edited_fingerprint``, ``near_edited`` and ``near_next``. The next document is that of the
    next smaller id (after the smallest, the largest). Rows with a null id have no next document: their edited text
    loses its last third, and ``near_next`` is null. A repeated id stands for its largest text where it is the next.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # A column that is right as it is stays one: a needless alias keeps Spark from seeing that both uses are equal.
    plain = (id_col, "bigint") in docs.dtypes and id_col == "doc_id"
    every = docs.select(F.col("doc_id") if plain else F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    # Dealt by id once, for the rows and for what the next documents give.
    rows = every.where("doc_id is not null").repartition("doc_id")
    follows = next_ids(docs, id_col)
    most = docs.select(F.col(id_col).cast("long").alias("for_id"), F.length(text).alias("n")).groupBy("for_id").agg(F.max("n").alias("most"))
    asked = follows.select(F.col("next_id").alias("doc_id"), F.col("doc_id").alias("for_id")).join(most, "for_id")
    one = rows.groupBy("doc_id").agg(F.max("text").alias("text"))
    given = one.join(asked, "doc_id").select(
        F.col("for_id").alias("doc_id"),
        F.expr("left(text, cast(floor(most / 3) as int))").alias("begin"),
        sketch(F.transform(paragraphs(F.col("text")), _pieces)).alias("next_sketch"),
    )
    alone = every.where("doc_id is null").select("*", F.lit(None).cast("string").alias("begin"), F.lit(None).cast("array<int>").alias("next_sketch"))
    both = levels(rows.join(given, "doc_id", "left").unionByName(alone).select("*", *_described(F.col("text"))))
    both = both.withColumn("fingerprint", fingerprint())
    third = F.floor(F.col("n_chars") / 3).cast("int")
    kept = F.expr("left(text, cast(n_chars - floor(n_chars / 3) as int))")
    added = F.coalesce(F.substring(F.col("begin"), F.lit(1), third), F.lit(""))
    edited = both.withColumn("edited", F.concat(kept, added))
    edited = edited.withColumn("edited_pieces", F.transform(paragraphs(F.col("edited")), _pieces))
    edited = levels(edited, "edited_pieces", "edited_")
    return edited.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        fingerprint("edited_").alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        differing(F.col("sections"), F.col("paragraphs"), F.col("edited_spans"), F.col("edited_paragraphs")).alias("edited_paragraphs"),
    )
