"""Homomorphic fingerprints: sums of wide vectors hashed from paragraphs, modulo powers of two.

A paragraph's vector has two parts. ``EXACT`` lanes are pieces of its SHA-512, added modulo
``2**32``: equal multisets of paragraphs have equal sums, others do not but by a collision. ``LIKE`` lanes add
a plus or minus one, by a hash bit, for each of its sentences, modulo ``2**20``: their products
estimate how many sentences two texts share. Sums do not depend on the order, and a
paragraph is put in or taken out by adding or subtracting its vector.

Everything here is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyloom.llm.store import Scratch

#: Lanes of 32 bits of the exact part, and of 20 bits (five hex digits) of the part for likeness.
EXACT = 16
LIKE = 126
_EXACT_HEX, _LIKE_HEX = 8, 5
_LIKE_SPAN = 1 << (4 * _LIKE_HEX)
#: Three lanes are summed in one long, 21 bits apart: a bit of the hash for each, and room for one carry.
_TRIPLE = 1 | 1 << 21 | 1 << 42
_ROOM = (_LIKE_SPAN - 1) * _TRIPLE
#: Bytes of text in a range of places, ranges at least, and at most: their first places, 24 bytes each, go to every task.
#: A range is sorted, so a larger one spills.
RANGE_BYTES = 8 << 20
RANGES = 64
MOST_RANGES = 1 << 16
#: A document's place: null ids first, then by id, then by a hash of the text.
PLACE = ("known", "doc", "key")
#: Where a sentence ends.
SENTENCE = r"(?<=[.!?])\s+|\n+"


def _hex(value: str, digits: int) -> str:
    return f"lpad(lower(hex({value})), {digits}, '0')"


def _lane(text: str, at: int | str, digits: int) -> str:
    return f"CAST(conv(substring({text}, {at}, {digits}), 16, 10) AS BIGINT)"


def _exact(text: str) -> list[str]:
    return [_lane(text, 1 + _EXACT_HEX * i, _EXACT_HEX) for i in range(EXACT)]


def _like(text: str) -> list[str]:
    begin = 1 + _EXACT_HEX * EXACT
    return [_lane(text, begin + _LIKE_HEX * i, _LIKE_HEX) for i in range(LIKE)]


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the fingerprint of column ``text`` as a hex string.

    Null counts as empty, and an empty text has no paragraph.
    """
    own = f"coalesce({text}, '')"
    hashes, sentences = f"__{name}_hashes", f"__{name}_sentences"
    bits = [f"__{name}_bits_{k}" for k in range(LIKE // 63)]
    sums = [f"__{name}_sums_{k}" for k in range(LIKE // 63)]
    df = df.withColumn(
        hashes,
        F.expr(f"transform(IF({own} = '', CAST(array() AS ARRAY<STRING>), split({own}, '\\n')), p -> sha2(p, 512))"),
    ).withColumn(sentences, F.expr(f"filter(split({own}, r'{SENTENCE}'), s -> s <> '')"))
    for k, column in enumerate(bits):
        df = df.withColumn(column, F.expr(f"transform({sentences}, s -> xxhash64(s, {k}))"))
    parts = []
    for i in range(EXACT):
        lane = _lane("h", 1 + _EXACT_HEX * i, _EXACT_HEX)
        parts.append(_hex(f"pmod(aggregate({hashes}, 0L, (a, h) -> a + {lane}), {1 << 32})", _EXACT_HEX))
    for column, total in zip(bits, sums, strict=True):
        ones = [
            f"aggregate({column}, 0L, (a, x) -> (a + (shiftrightunsigned(x, {j}) & {_TRIPLE}L)) & {_ROOM}L)" for j in range(21)
        ]
        df = df.withColumn(total, F.expr(f"array({', '.join(ones)})"))
        for j in range(63):
            lane = f"(shiftright({total}[{j % 21}], {j // 21 * 21}) & {_LIKE_SPAN - 1})"
            parts.append(_hex(f"pmod(2 * {lane} - size({sentences}), {_LIKE_SPAN})", _LIKE_HEX))
    return df.withColumn(name, F.expr(f"concat({', '.join(parts)})")).drop(hashes, sentences, *bits, *sums)


def combined(a: str, b: str, sign: str = "+") -> Column:
    """The fingerprint of two texts' paragraphs together, or (``-``) of the first without the second's.

    ``a`` and ``b`` name columns of fingerprints.
    """
    parts = [
        _hex(f"pmod({x} {sign} {y}, {span})", digits)
        for lanes, span, digits in ((_exact, 1 << 32, _EXACT_HEX), (_like, _LIKE_SPAN, _LIKE_HEX))
        for x, y in zip(lanes(a), lanes(b), strict=True)
    ]
    return F.expr(f"concat({', '.join(parts)})")


def _signed(mark: str) -> str:
    """Lanes of the part for likeness, from minus half the span to half of it."""
    lane = _lane(mark, f"{1 + _EXACT_HEX * EXACT} + {_LIKE_HEX} * i", _LIKE_HEX)
    half = _LIKE_SPAN // 2
    return f"transform(sequence(0, {LIKE - 1}), i -> CAST(pmod({lane} + {half}, {_LIKE_SPAN}) - {half} AS DOUBLE))"


def with_likeness(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """``df`` with about the share of sentences two texts have in common, 0 to 1, from their fingerprints."""
    x, y = f"__{name}_x", f"__{name}_y"
    both = f"aggregate(zip_with({x}, {y}, (p, q) -> p * q), 0D, (s, v) -> s + v)"
    own = f"aggregate(zip_with({x}, {y}, (p, q) -> p * p + q * q), 0D, (s, v) -> s + v)"
    share = f"CASE WHEN {a} = {b} THEN 1D WHEN {own} > 0 THEN greatest(0D, least(1D, 2 * {both} / {own})) ELSE 0D END"
    df = df.withColumn(x, F.expr(_signed(a))).withColumn(y, F.expr(_signed(b)))
    return df.withColumn(name, F.expr(share)).drop(x, y)


def _first_places(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """One row: the first places of ranges of about equally many documents, ascending.

    Spark cuts the ranges; only their number is known on the driver.
    """
    places = scratch.keep(rows.select(*PLACE, F.octet_length("text").alias("size")), "places")
    size = places.agg(F.sum("size")).first()[0] or 0
    n = min(MOST_RANGES, max(RANGES, -(-size // RANGE_BYTES)))
    cut = places.repartitionByRange(n, *PLACE).select(F.spark_partition_id().alias("part"), F.struct(*PLACE).alias("place"))
    firsts = cut.groupBy("part").agg(F.min("place").alias("place")).agg(F.sort_array(F.collect_list("place")).alias("firsts"))
    return scratch.keep(firsts.withColumn("one", F.lit(0).cast("long")), "firsts")


def _range_of(place: str, firsts: str) -> Column:
    """The number of the range a place falls in, by halving."""
    mid = "shiftright(s.low + s.high, 1)"
    step = (
        f"IF(s.high - s.low <= 1, s, IF({firsts}[{mid}] <= {place}, "
        f"named_struct('low', {mid}, 'high', s.high), named_struct('low', s.low, 'high', {mid})))"
    )
    halvings = f"sequence(1, {MOST_RANGES.bit_length()})"
    return F.expr(f"aggregate({halvings}, named_struct('low', 0, 'high', size({firsts})), (s, i) -> {step}, s -> s.low)")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of texts and of their edited texts.

    ``docs`` needs ``doc_id`` (integer) and ``text``; other columns are left out. The edited text is the text
    with its last ``floor(n_chars / 2)`` code points replaced by the first as many, or all, of the next
    document, ascending ``doc_id``; after the last comes the first. Returns ``doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next``, a row per input row.

    Texts are dealt once, by ranges of id and text; the first document of a range is also put at the end of the range
    before it. Defined cases: a null text is empty; a null ``doc_id`` comes before all others; rows that repeat a
    ``doc_id`` follow each other by a hash of the text and the text; a single row is its own next. Rows that repeat id and
    text are in one range. An empty table gives an empty one.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").isNotNull().alias("known"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc"),
        F.xxhash64(text).alias("key"), text.alias("text"),
    )
    firsts = _first_places(rows, Scratch(docs.sparkSession, "fingerprints"))
    # the one row of first places is of bounded size
    marked = with_fingerprint(rows, "text", "mark").withColumn("place", F.struct(*PLACE))
    placed = marked.join(F.broadcast(firsts), F.pmod("key", F.lit(1)) == F.col("one")).withColumn("own", _range_of("place", "firsts"))
    first = F.get("firsts", F.col("own")) == F.col("place")
    count = F.size("firsts")
    placed = placed.select(
        *PLACE, "text", "mark", "own", F.when(first, F.pmod(F.col("own") - 1, count)).alias("before")
    )
    ranges = F.array(F.struct(F.col("own").alias("range"), F.lit(False).alias("guest")))
    with_guest = F.concat(ranges, F.array(F.struct(F.col("before").alias("range"), F.lit(True).alias("guest"))))
    dealt = placed.select(*PLACE, "text", "mark", F.inline(F.when(F.col("before").isNotNull(), with_guest).otherwise(ranges)))
    order = Window.partitionBy("range").orderBy("guest", *PLACE, "text")
    paired = dealt.select(
        "known", "doc", "guest", "text", "mark",
        F.lead("text").over(order).alias("next_text"), F.lead("mark").over(order).alias("next_mark"),
    ).where(~F.col("guest"))
    size = F.char_length("text")
    half = F.floor(size / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), (size - half).cast("int")), F.substring("next_text", F.lit(1), half)
    )
    out = with_fingerprint(paired.withColumn("edited", edited), "edited", "edited_mark")
    out = with_likeness(out, "mark", "edited_mark", "near_edited")
    out = with_likeness(out, "mark", "next_mark", "near_next")
    return out.select(
        F.when(F.col("known"), F.col("doc")).alias("doc_id"),
        size.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        F.col("mark").alias("fingerprint"),
        F.col("edited_mark").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )
