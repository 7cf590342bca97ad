"""Document fingerprints: a homomorphic multiset hash of paragraph pieces, in DataFrame operations only.

A text is cut into paragraphs at line breaks, and a paragraph at sentence ends and after eight words. Each
piece is hashed to a wide vector; a fingerprint is the sum of its pieces' vectors, lane by lane, modulo
powers of two. It does not depend on the order of pieces, and adding or taking away a piece adds or takes
away its vector (``combine``), so an edit needs no second look at the rest of the text.

Vector: 1 counting lane, 4 lanes of 64 hash bits (modulo 2**64, for equality) and 126 lanes of one hash
bit, packed by three in 64-bit numbers (21 bits a lane, modulo 2**21, for likeness). Read as +1 / -1 the
bit lanes are a random projection of the piece counts, so their products estimate shared pieces:
likeness = 2 a.b / (a.a + b.b), cut to 0..1; its standard error is about 0.09.

Nulls, ties and odd rows: a null text is the empty text, which has no pieces and the fingerprint zero; two
empty texts have likeness 1; repeated rows have one place in the order and give equal results; a null
doc_id comes after all others; one row is its own next document; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegrid.llm.layout import attach, digest
from tastegrid.operators.ordering import global_position
from tastegrid.session import settle

#: Up to eight words of one line, ended early behind . ! or ?; the white space goes with the word before.
PIECE = r"(?:\S++(?<![.!?])[^\S\n]++(?=\S)){0,7}+\S++\s*+|\s++"
STRONG, SIGNED, FIELD = 4, 2, 21
_MASK = 1 | (1 << FIELD) | (1 << (2 * FIELD))
#: The top bit of each packed lane, and all bits below these.
_TOPS = _MASK << (FIELD - 1)
_REST = (1 << (3 * FIELD)) - 1 - _TOPS
#: Pieces whose packed lanes cannot run over, so plain addition gives the same sums.
SHORT = (1 << FIELD) - 1
LANES = 1 + STRONG + SIGNED * FIELD


def with_lanes(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``: array<long> of LANES numbers for the text column ``text``."""
    pieces = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(PIECE), F.lit(0))
    df = df.withColumn("_pieces", F.filter(pieces, lambda p: p != ""))
    for k in range(STRONG + SIGNED):
        df = df.withColumn(f"_h{k}", F.transform("_pieces", _hash_by(k)))
    lanes = [F.size("_pieces").cast("long")]
    # sums of 64-bit numbers wrap around: addition modulo 2**64, in two halves that never overflow
    for k in range(STRONG):
        lanes.append(_wrapped_sum(f"_h{k}"))
    for k in range(STRONG, STRONG + SIGNED):
        for j in range(FIELD):
            zero = F.lit(0).cast("long")
            few, many = F.aggregate(f"_h{k}", zero, _add_bits(j)), F.aggregate(f"_h{k}", zero, _add_wrapped_bits(j))
            lanes.append(F.when(F.size("_pieces") <= SHORT, few).otherwise(many))
    return df.withColumn(out, F.array(*lanes)).drop("_pieces", *[f"_h{k}" for k in range(STRONG + SIGNED)])


def _hash_by(seed: int) -> Callable[[Column], Column]:
    return lambda piece: F.xxhash64(F.lit(seed), piece)


def _add_bits(shift: int) -> Callable[[Column, Column], Column]:
    return lambda total, h: total + F.shiftrightunsigned(h, shift).bitwiseAND(F.lit(_MASK))


def _add_wrapped_bits(shift: int) -> Callable[[Column, Column], Column]:
    return lambda total, h: _packed_add(total, F.shiftrightunsigned(h, shift).bitwiseAND(F.lit(_MASK)))


def _packed_add(a: Column, b: Column) -> Column:
    """Each of three packed lanes added modulo 2**21: the top bits are added without a carry."""
    rest, tops = F.lit(_REST), F.lit(_TOPS)
    return (a.bitwiseAND(rest) + b.bitwiseAND(rest)).bitwiseXOR(a.bitwiseXOR(b).bitwiseAND(tops))


def _wrapped_sum(hashes: str) -> Column:
    """The sum of 64-bit numbers modulo 2**64 without overflow errors: low and high halves apart."""
    zero = F.lit(0).cast("long")
    low = F.aggregate(hashes, zero, lambda a, h: a + h.bitwiseAND(F.lit(0xFFFFFFFF)))
    high = F.aggregate(hashes, zero, lambda a, h: a + F.shiftrightunsigned(h, 32))
    return _wrapped_add(F.shiftleft(high, 32), low)


def _wrapped_add(a: Column, b: Column) -> Column:
    half = F.lit(0xFFFFFFFF)
    low = a.bitwiseAND(half) + b.bitwiseAND(half)
    high = F.shiftrightunsigned(a, 32) + F.shiftrightunsigned(b, 32) + F.shiftrightunsigned(low, 32)
    return F.shiftleft(high, 32).bitwiseOR(low.bitwiseAND(half))


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """Lanes of the pieces of ``a`` with those of ``b`` put in (sign 1) or taken out (sign -1)."""
    wide, packed = 1 + STRONG, SIGNED * FIELD
    one = F.lit(1).cast("long")
    put = [F.slice(b, 1, wide), F.slice(b, wide + 1, packed)]
    if sign < 0:
        put[0] = F.transform(put[0], lambda v: _wrapped_add(F.bitwise_not(v), one))
        put[1] = F.transform(put[1], lambda v: _packed_add(F.lit(_REST | _TOPS).bitwiseXOR(v), F.lit(_MASK)))
    return F.concat(F.zip_with(F.slice(a, 1, wide), put[0], _wrapped_add), F.zip_with(F.slice(a, wide + 1, packed), put[1], _packed_add))


def printed(lanes: Column) -> Column:
    """A fingerprint as hexadecimal text."""
    return F.array_join(F.transform(lanes, lambda v: F.lpad(F.hex(v), 16, "0")), "")


def _field(place: int) -> Callable[[Column], Column]:
    return lambda v: F.shiftrightunsigned(v, place * FIELD).bitwiseAND(F.lit((1 << FIELD) - 1))


def _signed(lanes: Column) -> Column:
    """The bit lanes read as +1 / -1 sums: 2 * ones - pieces."""
    packed = F.slice(lanes, 2 + STRONG, SIGNED * FIELD)
    fields = [F.transform(packed, _field(s)) for s in range(3)]
    return F.transform(F.concat(*fields), lambda c: (c * 2 - F.element_at(lanes, 1)).cast("double"))


def _dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def likeness(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """Adds ``out``, 0..1: the estimated share of pieces that two fingerprints have in common."""
    df = df.withColumn("_sa", _signed(F.col(a))).withColumn("_sb", _signed(F.col(b)))
    sizes = _dot("_sa", "_sa") + _dot("_sb", "_sb")
    share = F.when(sizes > 0, 2 * _dot("_sa", "_sb") / sizes).otherwise(F.lit(0.0))
    value = F.when(F.col(a) == F.col(b), 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)))
    return df.withColumn(out, value).drop("_sa", "_sb")


def next_documents(docs: DataFrame) -> DataFrame:
    """Per distinct (doc_id, _digest): n_chars and, from the one before it in descending doc_id, whose next it is.

    Columns doc_id, _digest, n_chars, _for_id, _for_digest, _for_chars. Texts stay out of it.
    """
    rows = docs.groupBy("doc_id", "_digest").agg(F.max(F.length("text")).cast("long").alias("n_chars"))
    rows = rows.withColumn("_none", F.col("doc_id").isNull()).withColumn("_down", F.bitwise_not(F.col("doc_id")))
    placed = settle(global_position(rows, ["_none", "_down", "_digest"], "_at").drop("_none", "_down"))
    n = placed.count()
    before = placed.select(
        ((F.col("_at") + 1) % F.lit(max(n, 1))).alias("_at"),
        F.col("doc_id").alias("_for_id"), F.col("_digest").alias("_for_digest"), F.col("n_chars").alias("_for_chars"),
    )
    return placed.join(before, "_at").drop("_at")


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_text, lanes, edited_lanes, next_lanes for every row.

    The edited text has its last third replaced by as much of the start of the next document. Each text is
    shuffled once, by (doc_id, digest); its successor sends the few characters that are needed and its lanes.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).withColumn("_digest", digest(F.col("text")))
    order = next_documents(rows)
    texts = attach(rows, order, ["doc_id", "_digest"], ["n_chars", "_for_id", "_for_digest", "_for_chars"])
    texts = with_lanes(texts, "text", "lanes")
    sent = texts.select(
        "_for_id", "_for_digest", F.expr("substring(text, 1, cast(_for_chars div 3 as int))").alias("_start"), F.col("lanes").alias("next_lanes")
    ).dropDuplicates(["_for_id", "_for_digest"])
    named = sent.select(F.col("_for_id").alias("doc_id"), F.col("_for_digest").alias("_digest"), "_start", "next_lanes")
    both = attach(texts, named, ["doc_id", "_digest"], ["_start", "next_lanes"])
    kept = F.expr("substring(text, 1, cast(n_chars - n_chars div 3 as int))")
    both = both.withColumn("edited_text", F.concat(kept, F.col("_start")))
    both = with_lanes(both, "edited_text", "edited_lanes")
    return both.select("doc_id", "n_chars", "edited_text", "lanes", "edited_lanes", "next_lanes")


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    made = fingerprint_edits(docs)
    made = likeness(made, "lanes", "edited_lanes", "near_edited")
    made = likeness(made, "lanes", "next_lanes", "near_next")
    return made.select(
        "doc_id",
        "n_chars",
        F.sha2(F.encode("edited_text", "UTF-8"), 256).alias("edited_sha256"),
        printed(F.col("lanes")).alias("fingerprint"),
        printed(F.col("edited_lanes")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )
