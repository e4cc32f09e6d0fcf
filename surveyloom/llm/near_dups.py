"""Near-duplicate documents: HyperMinHash sketches, bands, estimate, exact check.

A document is its set of distinct word shingles. Its sketch has one register per bucket of
the hash range: the bucket's smallest hash, kept as its number of leading zeros and a few
bits after the leading one. A bucket without a shingle takes the shingle that is least
under the bucket's own permutation, so that equal registers stay as likely as the
sets are alike, for short texts too. Bands of registers that agree make candidates; the
share of equal registers, corrected for accidental agreement, drops those well below the threshold;
the rest is compared on full sets.

Links only have to join what belongs together. So a bucket's members are first compared with the
bucket's first one. In buckets whose members are in different parts after that, every member outside the bucket's largest
part is compared with the likeliest one of another part. Where parts are left that may still touch, the full sets of the members
concerned are brought together in blocks and all pairs are counted there; what leaves a block is a forest of links, never its
pairs. Two members of the largest part are never looked at together, so they are not copied for one another.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.components import connected
from surveyloom.llm.filters import filter_of, may_hold
from surveyloom.llm.store import Scratch
from surveyloom.llm.words import BLANKS, LOWER, U64, as_long, mix, split_words, windows

#: Buckets of a sketch; registers put together in a band, and bands.
BUCKETS = 640
BAND = 6
BANDS = 42
#: A register in a byte: leading zeros up to 15, and bits kept after the leading one.
MANTISSA = 4
#: Standard errors of the estimate below the threshold at which a pair is still compared.
ERRORS = 4.0
#: Band hashes in a pack, and ranges of the hash for each so many documents.
PACK = 1 << 20
RANGE_DOCS = 10_000
RANGES = 64
#: Members on a side of a block of registers, those on a side of a block of full sets, and shingles of such a side together.
BLOCK = 4096
BLOCK_SETS = 512
BLOCK_SHINGLES = 1 << 21
#: Distinct shingles counted at a time in a block.
COLUMNS = 1 << 14

_ODD = mix(np.arange(1, BUCKETS + 1, dtype=U64)) | U64(1)
_SEED = mix(np.arange(1001, BUCKETS + 1001, dtype=U64))


@dataclass(frozen=True)
class NearRule:
    """``shingle`` words make a shingle; sets are linked at ``percent`` of Jaccard or more."""

    shingle: int = 5
    percent: int = 80


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a shorter text is one shingle."""
    for words in split_words(column, BLANKS, LOWER):
        own = words.hashes()
        grams = windows(own, size)
        for i in range(words.high - words.low):
            a, b = words.first[i], words.first[i + 1]
            if b - a >= size:
                yield np.unique(grams[a : b - size + 1])
            elif b > a:
                yield windows(own[a:b], int(b - a))
            else:
                yield own[:0]


def _registers(values: np.ndarray) -> np.ndarray:
    """Leading zeros (up to 15) and the bits after the leading one of 48-bit values."""
    zeros = 48 - np.frexp(values.astype(np.float64))[1]
    tail = (values << (zeros + 1).astype(U64)) & U64((1 << 48) - 1)
    tail >>= U64(48 - MANTISSA)
    return (np.minimum(zeros, 15) << MANTISSA).astype(np.uint8) | tail.astype(np.uint8)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Registers of one set of sorted hashes; sets of one shingle and more."""
    bucket = ((shingles >> U64(32)) * U64(BUCKETS) >> U64(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    low = np.zeros(BUCKETS, dtype=U64)
    low[bucket[first]] = np.minimum.reduceat(mix(shingles), first) >> U64(16)
    empty = np.ones(BUCKETS, dtype=bool)
    empty[bucket[first]] = False
    empty = np.flatnonzero(empty)
    step = max(1, (1 << 18) // len(shingles))
    for at in range(0, len(empty), step):
        part = empty[at : at + step]
        own = (shingles[None, :] ^ _SEED[part][:, None]) * _ODD[part][:, None]
        low[part] = own.min(axis=1) >> U64(16)
    return _registers(low)


def _sign(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, one, two, regs = [], [], [], []
            for own in shingle_sets(batch.column(1), size):
                n.append(len(own))
                one.append(mix(own).sum(dtype=U64))
                two.append(mix(own ^ U64(0x5851F42D4C957F2D)).sum(dtype=U64))
                regs.append(sketch(own).tobytes() if len(own) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n, pa.int64()),
                    pa.array(as_long(np.array(one, dtype=U64))),
                    pa.array(as_long(np.array(two, dtype=U64))),
                    pa.array(regs, pa.binary()),
                ],
                ["doc_id", "n_shingles", "key_1", "key_2", "registers"],
            )

    return run


def _matrix(values: list) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.uint8).reshape(len(values), BUCKETS)


PACKED = "part int, band binary, doc binary"
PACK_NAMES = ["part", "band", "doc"]


def _bands(ranges: int):
    """Packs of band hashes with the first document that has each.

    Documents that share a band within a pack are known at once (part -1), so a band that very
    many documents have is one entry of a pack.
    """
    bounds = (np.arange(1, ranges, dtype=object) * (1 << 64) // ranges).astype(U64)

    def flush(parts) -> Iterator[pa.RecordBatch]:
        bands, docs = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((docs, bands))
        bands, docs = bands[order], docs[order]
        first = np.append(True, bands[1:] != bands[:-1])
        shared = ~first
        shared[:-1] |= ~first[1:]
        one = [x[first] for x in (bands, docs)]
        cuts = np.concatenate([[0], np.searchsorted(one[0], bounds), [len(one[0])]])
        filled = np.flatnonzero(np.diff(cuts))
        rows = [[x[cuts[i] : cuts[i + 1]].tobytes() for i in filled] + [y.tobytes()] for x, y in zip(one, (bands[shared], docs[shared]), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([*filled, -1], pa.int32()), *[pa.array(r, pa.binary()) for r in rows]], PACK_NAMES
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            regs = _matrix(batch.column(1).to_pylist())[:, : BANDS * BAND].astype(U64)
            groups = regs.reshape(-1, BANDS, BAND)
            out = np.broadcast_to(_SEED[:BANDS], groups.shape[:2])
            for k in range(BAND):
                out = mix((out ^ groups[:, :, k]) + U64(0x9E3779B97F4A7C15))
            parts.append((out.ravel(), np.repeat(batch.column(0).to_numpy(), BANDS)))
            size += out.size
            if size >= PACK:
                yield from flush(parts)
                parts, size = [], 0
        if size:
            yield from flush(parts)

    return run


def _shared(rows: pd.DataFrame) -> pd.DataFrame:
    """Documents of bands that several packs have; those known within a pack go on as they are."""
    bands = np.frombuffer(b"".join(rows["band"]), U64)
    docs = np.frombuffer(b"".join(rows["doc"]), np.int64)
    if len(rows) and rows["part"].iloc[0] >= 0:
        order = np.argsort(bands, kind="stable")
        bands, docs = bands[order], docs[order]
        again = np.append(False, bands[1:] == bands[:-1])[: len(bands)]
        again[:-1] |= again[1:]
        bands, docs = bands[again], docs[again]
    return pd.DataFrame({"band": as_long(bands), "doc_id": docs})


def likeness(equal: np.ndarray) -> np.ndarray:
    """Jaccard estimate from the share of equal registers.

    Registers of different values agree by accident when zeros and mantissa do: one third of the
    pairs agree in the zeros, and of these one in ``2**MANTISSA`` in the bits.
    """
    accident = 2.0**-MANTISSA / 3
    return (equal - accident) / (1 - accident)


def hopeful(equal: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    """Pairs whose sizes allow the threshold and whose estimate is within its error of it."""
    low, high = np.minimum(n_a, n_b), np.maximum(n_a, n_b)
    t = percent / 100
    error = ERRORS * np.sqrt(t * (1 - t) / BUCKETS)
    return (100 * low >= percent * high) & (likeness(equal) >= t - error)


def _estimate(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b, n_a, n_b = (batch.column(i).to_numpy() for i in range(4))
            equal = (_matrix(batch.column(4).to_pylist()) == _matrix(batch.column(5).to_pylist())).mean(axis=1)
            keep = hopeful(equal, n_a, n_b, percent)
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], ["a", "b"])

    return run


def _sets(size: int, flags: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(may_hold(flags, batch.column(0).to_numpy())))
            if batch.num_rows:
                sets = [own.tobytes() for own in shingle_sets(batch.column(1), size)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.large_binary())], ["doc_id", "shingles"])

    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                p, q = np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64)
                both = np.sort(np.concatenate([p, q]))
                common = int((both[1:] == both[:-1]).sum())
                good.append(common > 0 and 100 * common >= percent * (len(p) + len(q) - common))
            mask = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    return run


def _written_sets(ids: DataFrame, docs: DataFrame, rule: NearRule, scratch: Scratch, name: str) -> DataFrame:
    """Full sets of the ids, made again from their texts; a few of others may be among them."""
    made = docs.where("doc_id is not null").mapInArrow(
        _sets(rule.shingle, filter_of(ids)), "doc_id long, shingles binary"
    )
    return scratch.keep(made, f"{name}-sets")


def _confirmed(pairs: DataFrame, docs: DataFrame, rule: NearRule, scratch: Scratch, name: str) -> DataFrame:
    """Pairs that hold on full sets."""
    left, right = (pairs.select(F.col(c).alias("doc_id")).distinct() for c in ("a", "b"))
    sets = _written_sets(left.unionByName(right), docs, rule, scratch, name)
    x = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("p"))
    y = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("q"))
    links = pairs.join(y, "b").join(x, "a").select("a", "b", "p", "q").mapInArrow(_confirm(rule.percent), "a long, b long")
    out = scratch.keep(links, f"{name}-links")
    scratch.drop(f"{name}-sets")
    return out


def _blocks(rows: DataFrame, left_of: F.Column, right_of: F.Column) -> DataFrame:
    """Every member of a band to the blocks it belongs to, as ``left``, as ``right`` or both.

    Left are the members outside the band's largest part (``outside``), right are all members. So a member of the largest part
    is copied once for each block of left ones, not for each block of its band.
    """
    rows = rows.withColumns({"left_of": left_of.cast("int"), "right_of": right_of.cast("int")})
    place = F.xxhash64("doc_id")
    rows = rows.withColumns({"i": F.pmod(place, F.col("left_of")).cast("int"), "j": F.pmod(place, F.col("right_of")).cast("int")})
    as_left = F.transform(
        F.sequence(F.lit(0), F.col("right_of") - 1),
        lambda k: F.struct(F.col("i").alias("own"), k.alias("other"), F.lit(True).alias("left"), (k == F.col("j")).alias("right")),
    )
    as_right = F.transform(
        F.filter(F.sequence(F.lit(0), F.col("left_of") - 1), lambda k: ~F.col("outside") | (k != F.col("i"))),
        lambda k: F.struct(k.alias("own"), F.col("j").alias("other"), F.lit(False).alias("left"), F.lit(True).alias("right")),
    )
    rows = rows.withColumn("at", F.explode(F.when(F.col("outside"), F.concat(as_left, as_right)).otherwise(as_right)))
    return rows.select(*[c for c in rows.columns if c not in ("i", "j", "left_of", "right_of", "at")], "at.*")


def equal_registers(many: np.ndarray, one: np.ndarray) -> np.ndarray:
    """How many registers each row has in common with one: eight counters in a word, none of which can pass a byte."""
    words = (many == one).view(np.uint64).sum(axis=1, dtype=np.uint64)
    return words.view(np.uint8).reshape(-1, 8).sum(axis=1, dtype=np.int64)


def _hopeful_pairs(block: pd.DataFrame, percent: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each left member of a block: right members of other parts that the estimate allows, and their equal registers."""
    left, right = block[block["left"]], block[block["right"]]
    parts, sizes = right["part"].to_numpy(), right["n"].to_numpy()
    regs = _matrix(list(right["registers"]))
    for i, (part, n, own) in enumerate(zip(left["part"], left["n"], left["registers"], strict=True)):
        near = 100 * np.minimum(sizes, n) >= percent * np.maximum(sizes, n)
        other = np.flatnonzero(near & (parts != part))
        share = equal_registers(regs[other], np.frombuffer(own, np.uint8)) / BUCKETS
        keep = hopeful(share, n, sizes[other], percent)
        yield i, other[keep], share[keep]


def _met_first(block: pd.DataFrame) -> tuple[list[np.ndarray], Callable]:
    """Marks of the left and right members of a block, and what marks a left one with some of the right ones as far as
    they meet in this bucket: a pair that shares several bands is seen in the first."""
    sides = [block[block["left"]], block[block["right"]]]
    regs = [_matrix(list(x["registers"]))[:, : BANDS * BAND] for x in sides]
    need = [np.zeros(len(x), bool) for x in sides]

    def mark(i: int, other: np.ndarray) -> None:
        equal = regs[1][other] == regs[0][i]
        first = equal.reshape(-1, BANDS, BAND).all(axis=2).argmax(axis=1)
        hashes, this = _SEED[:BANDS], regs[0][i].reshape(BANDS, BAND).astype(U64)
        for k in range(BAND):
            hashes = mix((hashes ^ this[:, k]) + U64(0x9E3779B97F4A7C15))
        here = int(np.flatnonzero(as_long(hashes) == block["band"].iloc[0])[0])
        hit = other[first == here]
        need[0][i] |= len(hit) > 0
        need[1][hit] = True

    return need, mark


def _open_members(block: pd.DataFrame, need: list[np.ndarray]) -> pd.DataFrame:
    sides = [block[block["left"]][need[0]], block[block["right"]][need[1]]]
    return pd.concat(sides)[["band", "doc_id", "part", "n"]].drop_duplicates("doc_id")


NEAR = "band long, doc_id long, a long, b long"
OPEN = "band long, doc_id long, part long, n long"


def _nearest(percent: int):
    """Within a block of a bucket: every left member with the likeliest one of another part (``a, b``), and the
    members that may touch another part at all (``band, doc_id``). Parts only grow together, so no others will."""

    def run(block: pd.DataFrame) -> pd.DataFrame:
        docs = [block["doc_id"][block[side]].to_numpy() for side in ("left", "right")]
        a, b = [], []
        need, mark = _met_first(block)
        for i, other, share in _hopeful_pairs(block, percent):
            if len(other):
                mark(i, other)
                a.append(docs[0][i])
                b.append(docs[1][other[share.argmax()]])
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        pairs = pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).drop_duplicates()
        # whole numbers before either side gets nulls: a float does not hold a band
        found = pd.concat([pairs.astype("Int64"), _open_members(block, need)[["band", "doc_id"]].astype("Int64")])
        return found[["band", "doc_id", "a", "b"]]

    return run


def _still_open(percent: int):
    """Within a block of a bucket: members that may touch another part."""

    def run(block: pd.DataFrame) -> pd.DataFrame:
        need, mark = _met_first(block)
        for i, other, _ in _hopeful_pairs(block, percent):
            if len(other):
                mark(i, other)
        return _open_members(block, need)

    return run


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many values each two sets have in common, in passes over the values both sides have."""
    flat = [np.concatenate([np.zeros(0, U64), *x]) for x in (left, right)]
    owner = [np.repeat(np.arange(len(x)), [len(y) for y in x]) for x in (left, right)]
    values = np.intersect1d(np.unique(flat[0]), np.unique(flat[1]), assume_unique=True)
    out = np.zeros((len(left), len(right)), np.float64)
    for at in range(0, len(values), COLUMNS):
        part = values[at : at + COLUMNS]
        sides = []
        for x, own, n in zip(flat, owner, out.shape, strict=True):
            inside = np.flatnonzero((x >= part[0]) & (x <= part[-1]))
            place = np.minimum(np.searchsorted(part, x[inside]), len(part) - 1)
            hit = part[place] == x[inside]
            side = np.zeros((n, len(part)), np.float32)
            side[own[inside[hit]], place[hit]] = 1
            sides.append(side)
        out += sides[0] @ sides[1].T
    return out.astype(np.int64)


def _forest(percent: int):
    """Within a block of a bucket: links on full sets, no more than it takes to join the parts they join."""

    def run(block: pd.DataFrame) -> pd.DataFrame:
        sides = [block[block["left"]], block[block["right"]]]
        docs, parts = ([x[c].to_numpy() for x in sides] for c in ("doc_id", "part"))
        sets = [[np.frombuffer(b, U64) for b in x["shingles"]] for x in sides]
        size = [np.array([len(x) for x in own], np.int64) for own in sets]
        common = common_counts(*sets)
        good = (common > 0) & (100 * common >= percent * (size[0][:, None] + size[1][None, :] - common))
        now = [p.copy() for p in parts]
        a, b = [], []
        for i in range(len(docs[0])):
            while len(hit := np.flatnonzero(good[i] & (now[1] != now[0][i]))):
                a.append(min(docs[0][i], docs[1][hit[0]]))
                b.append(max(docs[0][i], docs[1][hit[0]]))
                gone, to = now[1][hit[0]], now[0][i]
                for side in now:
                    side[side == gone] = to
        return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    return run


def near_duplicates(docs: DataFrame, rule: NearRule = NearRule()) -> DataFrame:
    """Classes of near-duplicate documents: ``doc_id, n_shingles, component_id, kept``.

    ``docs`` needs ``doc_id`` (integer) and ``text``; other columns are left out. A row per
    input row. Links are exact; candidates are those that agree in a band, which a
    pair at the threshold misses about once in a million. Documents linked through others
    share the smallest ``doc_id`` that can be reached as ``component_id``.

    Defined cases: a text without words, empty or null is linked with nothing; equal
    sets are one class at once; rows that repeat a ``doc_id`` are one document with the links of all its texts;
    a row without ``doc_id`` counts its shingles, but takes no part (``component_id`` null, kept).
    An empty table gives an empty one.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scratch = Scratch(docs.sparkSession, "near-dups")
    signed = scratch.keep(
        docs.mapInArrow(_sign(rule.shingle), "doc_id long, n_shingles long, key_1 long, key_2 long, registers binary"),
        "signed",
    )
    # equal sets first: from here on a class stands for all its copies
    classes = scratch.keep(
        signed.where("n_shingles > 0 and doc_id is not null").groupBy("key_1", "key_2").agg(
            F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("registers").alias("registers")
        ),
        "classes",
    )
    slim = scratch.keep(signed.drop("registers"), "slim")
    scratch.drop("signed")
    part_of = slim.where("n_shingles > 0 and doc_id is not null")
    ranges = max(RANGES, -(-classes.count() // RANGE_DOCS))
    packs = classes.select("doc_id", "registers").mapInArrow(_bands(ranges), PACKED)
    known = -1 - F.pmod(F.xxhash64("doc"), F.lit(ranges))
    packs = packs.withColumn("group", F.when(F.col("part") < 0, known).otherwise(F.col("part")))
    found = packs.groupBy("group").applyInPandas(_shared, "band long, doc_id long").distinct()
    found = scratch.keep(found, "found")
    shared = scratch.keep(
        found.groupBy("band").agg(F.min("doc_id").alias("centre"), F.count("*").alias("size")), "shared"
    )
    members = scratch.keep(found.join(shared, "band"), "members")
    scratch.drop("found", "shared")
    # every member with the first of its bucket
    sized = classes.select("doc_id", "n", "registers")
    stars = members.where("doc_id <> centre").select(F.col("centre").alias("a"), F.col("doc_id").alias("b")).distinct()
    likely = scratch.keep(_likely(stars, sized, rule), "likely")
    links = _confirmed(likely, docs, rule, scratch, "first").unionByName(_same_id(part_of, classes, scratch))
    parts = connected(links, scratch, "parts-1")
    members = scratch.keep(members.where("size > 2").select("band", "doc_id"), "buckets")
    mixed = scratch.keep(_mixed(members, parts), "mixed")
    if not mixed.isEmpty():
        near = scratch.keep(_blocked(mixed, sized).applyInPandas(_nearest(rule.percent), NEAR).distinct(), "near")
        pairs = near.where("a is not null").select("a", "b").distinct()
        links = links.unionByName(_confirmed(pairs, docs, rule, scratch, "second"))
        parts = connected(links, scratch, "parts-2")
        # only members that had somebody to touch are looked at again
        members = near.where("band is not null").select("band", "doc_id").distinct()
        mixed = scratch.keep(_mixed(members, parts), "mixed-2")
    if not mixed.isEmpty():
        left = _blocked(mixed, sized).applyInPandas(_still_open(rule.percent), OPEN).distinct()
        left = scratch.keep(left, "left")
        if not left.isEmpty():
            sets = _written_sets(left.select("doc_id").distinct(), docs, rule, scratch, "third")
            sides = [
                F.greatest(F.ceil(F.col(m) / min(BLOCK, BLOCK_SETS)), F.ceil(F.col(n) / BLOCK_SHINGLES))
                for m, n in (("others", "others_n"), ("size", "size_n"))
            ]
            # sets are joined to members, not to their copies in blocks
            blocks = _blocks(_outside(left).join(sets, "doc_id"), *sides)
            blocks = blocks.select("band", "own", "other", "left", "right", "doc_id", "part", "shingles")
            blocks = blocks.groupBy("band", "own", "other")
            forest = scratch.keep(blocks.applyInPandas(_forest(rule.percent), "a long, b long").distinct(), "forest")
            links = links.unionByName(forest)
            parts = connected(links, scratch, "parts-3")
    scratch.drop("members", "buckets", "likely", "mixed", "near", "mixed-2", "left", "third-sets")
    of_class = classes.select("key_1", "key_2", "doc_id").join(
        parts.select(F.col("node").alias("doc_id"), "part"), "doc_id", "left"
    )
    of_class = scratch.keep(
        of_class.select("key_1", "key_2", F.coalesce("part", "doc_id").alias("part")), "of-class"
    )
    scratch.drop("classes")
    out = slim.join(of_class, ["key_1", "key_2"], "left")
    out = out.withColumn(
        "component_id", F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("part", "doc_id"))
    )
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return out.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def _same_id(signed: DataFrame, classes: DataFrame, scratch: Scratch) -> DataFrame:
    """Links between the classes of different texts under one id."""
    key = F.struct("key_1", "key_2")
    several = signed.groupBy("doc_id").agg(F.min(key).alias("low"), F.max(key).alias("high")).where("low <> high")
    several = scratch.keep(several.select(F.col("doc_id").alias("id")), "several")
    own = signed.select(F.col("doc_id").alias("id"), "key_1", "key_2").join(several, "id").distinct()
    own = own.join(classes.select("key_1", "key_2", "doc_id"), ["key_1", "key_2"]).select("id", "doc_id")
    low = own.groupBy("id").agg(F.min("doc_id").alias("a"))
    return scratch.keep(own.join(low, "id").where("a <> doc_id").select("a", F.col("doc_id").alias("b")), "same-id")


def _outside(rows: DataFrame) -> DataFrame:
    """Members ``band, doc_id, part`` and others of the buckets whose members are in several parts: whether they are ``outside`` the
    largest part, how many members there are and are outside (``size``, ``others``), and the sums of ``n``, if there."""
    sized = "n" in rows.columns
    count = [F.count("*").alias("m"), *([F.sum("n").alias("n")] if sized else [])]
    parts = rows.groupBy("band", "part").agg(*count)
    # the largest part by members, of equal ones the one of the largest name
    main = F.max(F.struct("m", "part", *(["n"] if sized else [])))
    whole = [F.sum("m").alias("size"), *([F.sum("n").alias("size_n")] if sized else [])]
    several = parts.groupBy("band").agg(main.alias("main"), F.count("*").alias("parts"), *whole).where("parts > 1")
    known = ["band", F.col("main.part").alias("main"), "size", (F.col("size") - F.col("main.m")).alias("others")]
    if sized:
        known += ["size_n", (F.col("size_n") - F.col("main.n")).alias("others_n")]
    out = rows.join(several.select(*known), "band").withColumn("outside", F.col("part") != F.col("main"))
    return out.drop("main")


def _mixed(members: DataFrame, parts: DataFrame) -> DataFrame:
    """Members, with their part, of the buckets whose members are in several parts."""
    named = parts.select(F.col("node").alias("doc_id"), "part")
    rows = members.join(named, "doc_id", "left").withColumn("part", F.coalesce("part", "doc_id"))
    return _outside(rows.select("band", "doc_id", "part"))


def _blocked(mixed: DataFrame, sized: DataFrame):
    blocks = _blocks(mixed.join(sized, "doc_id"), F.ceil(F.col("others") / BLOCK), F.ceil(F.col("size") / BLOCK))
    columns = ["band", "own", "other", "left", "right", "doc_id", "part", "n", "registers"]
    return blocks.select(*columns).groupBy("band", "own", "other")


def _likely(pairs: DataFrame, sized: DataFrame, rule: NearRule) -> DataFrame:
    x = sized.select(F.col("doc_id").alias("a"), F.col("n").alias("n_a"), F.col("registers").alias("r_a"))
    y = sized.select(F.col("doc_id").alias("b"), F.col("n").alias("n_b"), F.col("registers").alias("r_b"))
    whole = pairs.join(y, "b").join(x, "a").where(100 * F.least("n_a", "n_b") >= rule.percent * F.greatest("n_a", "n_b"))
    return whole.select("a", "b", "n_a", "n_b", "r_a", "r_b").mapInArrow(_estimate(rule.percent), "a long, b long")
