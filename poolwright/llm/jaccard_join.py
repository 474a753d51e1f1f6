"""Jaccard self-join on word shingles by PartEnum signatures.

Sets whose Jaccard similarity reaches the threshold differ in few elements: at
most (1 - t) / t of the smaller set. Sets are dealt into size bands; a band of
sets with at most k differing elements splits the domain of shingles into n1
parts, each into n2 smaller ones. By the pigeonhole principle similar sets agree
on n2 - 1 smaller parts of one part at least, so each such subset is a signature
and similar sets share one. The larger sets just above a band sign for it too, so
pairs across its edge are found.

Equal sets are one class from the start. Members of a signature are compared with one
leader, not with each other. Where classes under one signature stay apart after that,
pairs of different components under it are compared too, so no link between components is
missed: first by sketches, whose distance is never more than the sets', in blocks of ``MEMBERS``, and
what is left on whole sets. Only links that components need are kept.

Documents without a word are linked with nothing. Ids may repeat or be null; a row
whose component has no id gets a null component. Only aggregates, never members,
reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from poolwright.llm.common import SPACES, column, frugal, in_slices, mixed, shingles, utf8
from poolwright.llm.components import components
from poolwright.session import materialize

#: Smaller parts of a part; signatures leave one of them out.
PARTS = 3
#: Sizes within a band differ by this factor at most.
BAND = 1.4
#: Rows at least that the signatures of a set are packed into for the shuffle; more where there are many partitions.
DEALS = 128
#: Signatures that a task sorts at a time; short texts have more of them for each byte.
SIGNED = 1 << 18
#: Members of a signature that a task holds at a time.
MEMBERS = 2048
#: Open signatures that a member names, its lowest ones: a pair is left to the lowest that both name.
NAMED = 32


class Bands:
    """Size bands and their number of parts for one threshold."""

    def __init__(self, threshold: Fraction) -> None:
        self.threshold = threshold
        self.apart = (1 - threshold) / threshold  # differing elements as a share of the smaller set
        low = int(-(-1 // self.apart)) if self.apart else 1 << 40  # smaller sets have no similar set but equal ones
        self.edges = [low]
        while self.edges[-1] < 1 << 40:
            self.edges.append(max(self.edges[-1] + 1, int(self.edges[-1] * BAND)))
        self.low = np.array(self.edges, np.int64)
        most = [int((edge - 1) * self.apart) for edge in self.edges[1:]]
        self.parts = np.array([(k + 2) // 2 for k in most], np.int64)

    def signing(self, sizes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(set, band) for the band of each set, and again for every band below that holds sizes it may be similar to."""
        band = np.searchsorted(self.low, sizes, "right") - 1
        which = np.flatnonzero(band >= 0)
        out = [(which, band[which])]
        t, below = self.threshold, 1
        while True:
            which = which[band[which] >= below]
            most = self.low[band[which] - below + 1] - 1  # the largest size of that band
            which = which[most * t.denominator >= sizes[which] * t.numerator]
            if not len(which):
                return out
            out.append((which, band[which] - below))
            below += 1


def signatures(sets: list[np.ndarray], bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of all sets, and the index of the set of each."""
    sizes = np.array([len(s) for s in sets], np.int64)
    found, owner = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for which, band in bands.signing(sizes):
        if not len(which):
            continue
        n1 = bands.parts[band]
        small = n1 * PARTS
        base = np.cumsum(small) - small
        values = np.concatenate([sets[i] for i in which])
        of = np.repeat(np.arange(len(which)), sizes[which])
        dealt = (mixed(values ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(11)) % small[of].astype(np.uint64)
        place = base[of] + dealt.astype(np.int64)
        order = np.argsort(place, kind="stable")
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed(values[order] + np.uint64(0x2545F4914F6CDD1D)))])
        ends = np.cumsum(np.bincount(place, minlength=int(small.sum())))
        part = (sums[ends] - sums[np.concatenate([[0], ends[:-1]])]).reshape(-1, PARTS)
        of_part = np.repeat(np.arange(len(which)), n1)
        number = np.arange(len(part)) - np.repeat(np.cumsum(n1) - n1, n1)
        tag = mixed(number.astype(np.uint64) * np.uint64(1009) + band[of_part].astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))
        for out in range(PARTS):
            kept = [k for k in range(PARTS) if k != out]
            value = tag + np.uint64(out + 1)
            for k in kept:
                value = mixed(value + part[:, k])
            found.append(value)
            owner.append(which[of_part])
    return np.concatenate(found), np.concatenate(owner)


def _sets(batch: pa.RecordBatch, size: int) -> list[np.ndarray]:
    return shingles(*utf8(batch.column("text")), size)


def _key(s: np.ndarray, salt: int) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8, key=salt.to_bytes(4, "big")).digest(), "big", signed=True)


def sketch(s: np.ndarray) -> bytes:
    """Parities of how many elements fall into each of two places an element, 64 at least.

    Every element that only one of two sets has changes one parity, so their sketches differ in no
    more places than the sets have different elements.
    """
    places = 1 << max(6, min(16, (2 * len(s) - 1).bit_length()))
    at = (mixed(s ^ np.uint64(0x3C79AC492BA7B653)) & np.uint64(places - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=places).astype(np.uint8) & 1).tobytes()


def folded(sketches: list[bytes]) -> np.ndarray:
    """Sketches as rows of 64-bit words, all of the size of the smallest."""
    size = min(map(len, sketches))
    return np.stack([np.bitwise_xor.reduce(np.frombuffer(x, np.uint64).reshape(-1, size // 8), axis=0) for x in sketches])


def may_link(apart: np.ndarray, a: np.ndarray, b: np.ndarray, t: Fraction) -> np.ndarray:
    """Whether sets of sizes ``a`` and ``b`` that differ in ``apart`` elements or more can be similar enough."""
    n, d = t.numerator, t.denominator
    return (apart * (n + d) <= (a + b) * (d - n)) & (np.minimum(a, b) * d >= np.maximum(a, b) * n)


def describe(docs: DataFrame, size: int) -> tuple[DataFrame, int]:
    """Rows (doc_id, n_shingles, key, sketch): equal sets have one key, and different sets different keys.

    A column ``hash`` of ``docs`` goes along. Keys have 64 bits; two longer digests prove that no key stands for two sets, else
    another salt is taken.
    """
    salt = 0
    along = ["hash"] if "hash" in docs.columns else []
    while True:
        def run(batches: Iterator[pa.RecordBatch], salt: int = salt) -> Iterator[pa.RecordBatch]:
            for batch in in_slices(batches, "text"):
                sets = _sets(batch, size)
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                yield pa.RecordBatch.from_arrays([
                    *[batch.column(c) for c in along], batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_key(s, salt) if len(s) else None for s in sets], pa.int64()),
                    pa.array([int.from_bytes(d[:8], "big", signed=True) for d in digests], pa.int64()),
                    pa.array([int.from_bytes(d[8:], "big", signed=True) for d in digests], pa.int64()),
                    pa.array([sketch(s) if len(s) else None for s in sets], pa.binary()),
                ], [*along, "doc_id", "n_shingles", "key", "d1", "d2", "sketch"])

        found = materialize(docs.mapInArrow(run, "".join(f"{c} long, " for c in along) + "doc_id long, n_shingles long, key long, d1 long, d2 long, sketch binary"), "shingled")
        alike = found.filter("key is not null").groupBy("key").agg(*[f(c).alias(f"{n}{c}") for c in ("d1", "d2") for n, f in (("lo", F.min), ("hi", F.max))])
        if alike.filter("lod1 <> hid1 or lod2 <> hid2").isEmpty():
            return found.drop("d1", "d2"), salt
        salt += 1


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _star(sigs: np.ndarray, keys: np.ndarray, deals: int) -> pa.RecordBatch:
    """Signatures of different sets, with members of one signature tied to the smallest of them.

    Only that one goes on under the signature, so a signature that very many
    sets share leaves a batch once. The others are dealt by their pair. What a set
    has for one of the ``deals`` goes as one row, which is half as large as a row each.
    """
    order = np.lexsort((keys, sigs))
    sigs, keys = sigs[order], keys[order]
    leads = np.concatenate([[True], sigs[1:] != sigs[:-1]])
    leader = keys[np.maximum.accumulate(np.where(leads, np.arange(len(sigs)), 0))]
    leads |= keys == leader  # a set may have a signature twice
    deal = np.where(leads, sigs, mixed(keys.view(np.uint64) ^ mixed(leader.view(np.uint64))))
    deal = ((deal >> np.uint64(16)) % np.uint64(deals)).astype(np.int64)
    leader = np.where(leads, 0, leader)
    order = np.lexsort((deal, leader, leads, keys))
    sigs, keys, leader, leads, deal = (x[order] for x in (sigs, keys, leader, leads, deal))
    same = (keys[1:] == keys[:-1]) & (leads[1:] == leads[:-1]) & (leader[1:] == leader[:-1]) & (deal[1:] == deal[:-1])
    first = np.flatnonzero(np.concatenate([[True], ~same]))
    offsets = pa.array(np.append(first, len(sigs)).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [pa.array(deal[first]), pa.array(keys[first]), pa.array(leader[first], mask=leads[first]), pa.ListArray.from_arrays(offsets, _signed(sigs))],
        ["deal", "key", "lead", "sigs"])


def memberships(docs: DataFrame, size: int, bands: Bands, salt: int) -> DataFrame:
    """Rows (sig, key, lead): members of the signatures that several sets share, without the leaders themselves."""
    deals = max(DEALS, 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    most = SIGNED

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[int] = set()
            found: list[tuple[np.ndarray, np.ndarray]] = []
            held = 0
            for part in in_slices(iter([batch]), "text"):
                sets, keys = [], []
                for s in _sets(part, size):
                    if len(s) >= bands.edges[0] and (key := _key(s, salt)) not in seen:
                        seen.add(key)
                        sets.append(s)
                        keys.append(key)
                sigs, owner = signatures(sets, bands)
                found.append((sigs, np.array(keys, np.int64)[owner]))
                held += len(sigs)
                if held >= most:
                    yield _star(*(np.concatenate(x) for x in zip(*found)), deals)
                    found, held = [], 0
            if held:
                yield _star(*(np.concatenate(x) for x in zip(*found)), deals)

    packed = docs.select("text").mapInArrow(run, "deal long, key long, lead long, sigs array<long>")
    # all of a signature that is not tied yet is in one deal, so the window needs no shuffle of its own; lists grow when
    # they are unpacked, so the parts are many and stay as they are
    signed = packed.repartition(deals, "deal").select("deal", "key", "lead", F.explode("sigs").alias("sig"))
    lowest = F.min(F.when(F.col("lead").isNull(), F.col("key"))).over(Window.partitionBy("deal", "sig"))
    return signed.select("sig", "key", F.coalesce("lead", lowest).alias("lead")).filter("key <> lead")


#: Bits of a filter of keys: 16 a key, no more than 16 MB.
FILTER_BITS = 1 << 27


def key_filter(keys: DataFrame) -> np.ndarray:
    """Bitmap of 2**n bits in which two bits of every key are set; what it does not hold is none of the keys."""
    n = keys.count()
    bits = min(FILTER_BITS, max(1 << 15, 1 << (16 * n).bit_length()))
    place = F.explode(F.array(*[F.pmod(F.shiftright("key", shift), F.lit(bits).cast("long")) + 1 for shift in (0, 27)])).alias("place")
    parts = keys.select(place).groupBy(F.bitmap_bucket_number("place").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    out = np.zeros(bits // 8, np.uint8)
    for r in parts.toLocalIterator():  # at most 4096 rows of 4 kB
        start = (r["part"] - 1) * 4096
        out[start : start + 4096] = np.frombuffer(bytes(r["bits"]), np.uint8)[: len(out) - start]
    return out


def may_hold(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys can be among those that the bitmap was made of."""
    out = np.ones(len(keys), bool)
    for shift in (0, 27):
        place = (keys >> np.int64(shift)) & np.int64(8 * len(bitmap) - 1)
        out &= (bitmap[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
    return out


def involved_sets(docs: DataFrame, keys: DataFrame, size: int, bands: Bands, salt: int) -> DataFrame:
    """Rows (key, items): the sets of the given keys, one row a key.

    A filter of the keys, bounded in size, keeps nearly all other texts from leaving their task; texts are packed on their way.
    """
    wanted = docs.sparkSession.sparkContext.broadcast(key_filter(keys))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for batch in batches:
            seen: set[int] = set()
            for part in in_slices(iter([batch]), "text"):
                found = [_key(s, salt) if len(s) >= bands.edges[0] else None for s in _sets(part, size)]
                held = may_hold(wanted.value, np.array([k or 0 for k in found], np.int64))
                new = [i for i, k in enumerate(found) if k is not None and held[i] and k not in seen and not seen.add(k)]
                texts = [part.column("text")[i].as_buffer() for i in new]
                yield pa.RecordBatch.from_arrays([
                    pa.array([found[i] for i in new], pa.int64()), pa.array([t.size for t in texts], pa.int64()),
                    pa.array([codec.compress(t, asbytes=True) for t in texts], pa.binary())], ["key", "size", "packed"])

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for batch in batches:
            for key, n, packed in zip(*batch.columns):
                text = pa.array([codec.decompress(packed.as_buffer(), n.as_py(), asbytes=True)], pa.binary()).cast(pa.string())
                items = shingles(*utf8(text), size)[0]
                yield pa.RecordBatch.from_arrays([pa.array([key.as_py()], pa.int64()), pa.array([items.tobytes()], pa.binary())], ["key", "items"])

    texts = docs.select("text").mapInArrow(keyed, "key long, size long, packed binary").join(keys, "key", "left_semi")
    return texts.dropDuplicates(["key"]).select("key", "size", "packed").mapInArrow(to_sets, "key long, items binary")


def plausible(pairs: DataFrame, sketches: DataFrame, threshold: Fraction) -> DataFrame:
    """Rows (a, b) of the pairs whose sketches do not rule a link out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart = np.array([int(np.bitwise_count(np.bitwise_xor(*folded([x, y]))).sum()) for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())], np.int64)
            kept = may_link(apart, np.asarray(batch.column("nx")), np.asarray(batch.column("ny")), threshold)
            yield batch.select(["a", "b"]).filter(pa.array(kept))

    joined = pairs.join(sketches.select(F.col("key").alias("a"), F.col("n_shingles").alias("nx"), F.col("sketch").alias("x")), "a").join(
        sketches.select(F.col("key").alias("b"), F.col("n_shingles").alias("ny"), F.col("sketch").alias("y")), "b")
    return joined.select("a", "b", "nx", "ny", "x", "y").mapInArrow(run, "a long, b long")


def similar(pairs: DataFrame, sets: DataFrame, threshold: Fraction) -> DataFrame:
    """Rows (a, b, linked) of candidate pairs, checked on their whole sets."""
    n, d = threshold.numerator, threshold.denominator

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                small, large = (x, y) if len(x) <= len(y) else (y, x)
                if len(small) * d < len(large) * n:
                    linked.append(False)
                    continue
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                both = int((large[at] == small).sum())
                linked.append(both * d >= n * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())], ["a", "b", "linked"])

    joined = pairs.join(sets.select(F.col("key").alias("a"), F.col("items").alias("x")), "a").join(sets.select(F.col("key").alias("b"), F.col("items").alias("y")), "b")
    return joined.select("a", "b", "x", "y").mapInArrow(run, "a long, b long, linked boolean")


def _pairs_apart(sig: int, rows: list[tuple], threshold: Fraction) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of members of one block (or of two, by ``side``) in different components that their sketches leave possible.

    A pair that meets under a lower signature as well, by the signatures that both name, is left to that one.
    """
    keys, roots, sizes = (np.array([r[k] for r in rows], np.int64) for k in range(3))
    side = np.array([r[4] for r in rows])
    named = np.full((len(rows), NAMED), sig, np.int64)
    for i, r in enumerate(rows):
        named[i, : len(r[5])] = r[5]
    words = folded([r[3] for r in rows])
    for i in range(len(rows) - 1):
        others = np.arange(i + 1, len(rows))
        others = others[(roots[others] != roots[i]) & ((side[others] == 0) | (side[others] != side[i]))]
        if len(others):
            apart = np.bitwise_count(words[others] ^ words[i]).sum(1).astype(np.int64)
            others = others[may_link(apart, sizes[others], sizes[i], threshold)]
            others = others[~np.isin(named[others], named[i][named[i] < sig]).any(1)]
            if len(others):
                yield np.maximum(keys[others], keys[i]), np.minimum(keys[others], keys[i])


#: Pairs that leave a block together.
SLICE = 1 << 16


def pairs_of_open(members: DataFrame, threshold: Fraction, sketches: DataFrame | None = None) -> DataFrame:
    """Possible pairs (a, b) of different components under one signature.

    ``members`` has the rows (sig, key, root), ``sketches`` one row (key, n_shingles, sketch) a key; without it
    they stand in ``members``. A signature of many members is
    split into blocks, and every pair of blocks is a group of its own. Similar sets share many signatures;
    each member names its lowest ones, and a pair leaves only under the lowest that both name.
    """
    if sketches is None:
        sketches = members.dropDuplicates(["key"])
    members = members.select("sig", "key", "root")
    nth = F.row_number().over(Window.partitionBy("key").orderBy("sig"))
    named = members.select("key", "sig", nth.alias("nth")).filter(F.col("nth") <= NAMED).groupBy("key").agg(F.collect_list("sig").alias("named"))
    counts = members.groupBy("sig").agg(F.ceil(F.count("*") / MEMBERS).alias("blocks"))
    dealt = members.join(counts, "sig").withColumn("own", F.pmod(F.xxhash64("key"), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    # block pairs (low, high): rows of the low one have side 1, of the high one 2, within one block 0
    dealt = dealt.select(
        "sig", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "key", "root",
        F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).alias("side"))
    # what is wide is one row a key until the members are dealt, and moves with them only once
    dealt = dealt.join(named, "key").join(sketches.select("key", "n_shingles", "sketch"), "key").select(
        "sig", "low", "high", "key", "root", "n_shingles", "sketch", "side", "named")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        at = None

        def done() -> Iterator[pa.RecordBatch]:
            found: list[tuple[np.ndarray, np.ndarray]] = []
            n = 0
            for pair in _pairs_apart(at[0], held, threshold) if held else ():
                found.append(pair)
                n += len(pair[0])
                if n >= SLICE:
                    yield joined(found)
                    found, n = [], 0
            if found:
                yield joined(found)

        def joined(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], ["a", "b"])

        for batch in batches:
            names = ("sig", "low", "high", "key", "root", "n_shingles", "sketch", "side")
            lists = batch.column("named")
            ends, flat = np.asarray(lists.offsets), np.asarray(lists.values)
            for i, (sig, low, high, *row) in enumerate(zip(*(batch.column(c).to_pylist() for c in names))):
                if at != (sig, low, high):
                    yield from done()
                    held, at = [], (sig, low, high)
                held.append((*row, flat[ends[i] : ends[i + 1]].copy()))
        yield from done()

    ordered = dealt.repartition("sig", "low", "high").sortWithinPartitions("sig", "low", "high")
    return ordered.mapInArrow(run, "a long, b long").distinct()


def linked_classes(docs: DataFrame, described: DataFrame, size: int, threshold: Fraction, salt: int) -> tuple[DataFrame, DataFrame]:
    """Components (node, root) of set keys, and the links found between different sets."""
    bands = Bands(threshold)
    sketches = described.filter("key is not null").groupBy("key").agg(F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"))
    shared = materialize(memberships(docs, size, bands, salt), "memberships")
    pairs = shared.select(F.greatest("key", "lead").alias("a"), F.least("key", "lead").alias("b")).distinct()
    links = materialize(checked(docs, plausible(pairs, sketches, threshold), size, bands, salt), "compared").filter("linked")
    groups = materialize(components(links), "groups")

    # a signature is open where a member and its leader are in different components
    of_key, of_lead = (groups.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root")) for c in ("key", "lead"))
    rooted = shared.join(of_key, "key", "left").join(of_lead, "lead", "left")
    still = materialize(rooted.filter(F.coalesce("key_root", "key") != F.coalesce("lead_root", "lead")).select("sig").distinct(), "open")
    left = shared.join(still, "sig", "left_semi")
    members = left.select("sig", "key").union(left.select("sig", F.col("lead").alias("key"))).distinct()
    members = materialize(members.join(groups, members["key"] == groups["node"], "left").select("sig", "key", F.coalesce("root", "key").alias("root")), "members")
    # the two of a pair have been compared with each other
    several = members.groupBy("sig").count().filter("count > 2").select("sig")
    members = materialize(members.join(several, "sig", "left_semi"), "members")
    new = materialize(pairs_of_open(members, threshold, sketches).join(links.select("a", "b"), ["a", "b"], "left_anti"), "candidates")
    if new.isEmpty():
        return groups, links
    more = materialize(checked(docs, new, size, bands, salt), "compared").filter("linked")
    links = links.union(more)
    return materialize(components(links), "groups"), links


def checked(docs: DataFrame, pairs: DataFrame, size: int, bands: Bands, salt: int) -> DataFrame:
    """Rows (a, b, linked) of candidate pairs, compared on their whole sets."""
    pairs = materialize(pairs, "candidates")
    keys = materialize(pairs.select(F.col("a").alias("key")).union(pairs.select(F.col("b").alias("key"))).distinct(), "keys")
    return similar(pairs, materialize(involved_sets(docs, keys, size, bands, salt), "sets"), bands.threshold)


def near_duplicates(docs: DataFrame, size: int = 5, threshold: Fraction = Fraction(8, 10)) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, class_key) of all documents.

    ``component_id`` is the smallest id that can be reached by links; ``class_key``
    is the same for documents with equal sets, null for those without a word.
    """
    rows = docs.select(column(docs, "doc_id", "long").alias("doc_id"), column(docs, "text", "string").alias("text"))
    with frugal(docs.sparkSession):
        described, salt = describe(rows, size)
        groups, _ = linked_classes(rows, described, size, threshold, salt)
    classes = described.filter("key is not null").groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    classes = classes.join(groups, classes["key"] == groups["node"], "left").select("key", "doc_id", F.coalesce("root", "key").alias("root"))
    lowest = classes.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = classes.join(lowest, "root").select("key", "component_id")
    alone = described.filter("key is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.col("key").alias("class_key"))
    rest = described.filter("key is not null").join(named, "key").select("doc_id", "n_shingles", "component_id", F.col("key").alias("class_key"))
    return rest.union(alone)


def join_documents(docs: DataFrame) -> DataFrame:
    """Components under a similarity of 0.9 on three-word shingles."""
    return near_duplicates(docs, 3, Fraction(9, 10)).drop("class_key")


def one_of_each(docs: DataFrame, size: int = 5, threshold: Fraction = Fraction(8, 10)) -> DataFrame:
    """One row of ``docs`` for each component, with all columns: that of the smallest id.

    Of rows with that id one stays, by a hash of its columns. Rows without a word stay.
    """
    text, id_ = column(docs, "text", "string"), column(docs, "doc_id", "long")
    hash_ = F.xxhash64(*[docs[c] for c in docs.columns])
    with frugal(docs.sparkSession):
        described, salt = describe(docs.select(id_.alias("doc_id"), text.alias("text"), hash_.alias("hash")), size)
        groups, _ = linked_classes(docs.select(text.alias("text")), described, size, threshold, salt)
        # the row of a component is chosen by its id and hash alone; whole rows move once, when it is known which
        first = described.filter("key is not null").groupBy("key").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "hash")).alias("one"))
        first = first.join(groups, first["key"] == groups["node"], "left")
        order = F.struct("one.no_id", "one.doc_id", "key", "one.hash")
        chosen = first.groupBy(F.coalesce("root", "key").alias("root")).agg(F.min(order).alias("one")).select(F.col("one.doc_id").alias("jj_id"), F.col("one.hash").alias("jj_hash"))
        repeated = described.filter("key is not null").groupBy(F.col("doc_id").alias("jj_id"), F.col("hash").alias("jj_hash")).count().filter("count > 1")
        repeated = materialize(repeated, "repeated")
        chosen = materialize(chosen, "chosen")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), id_.alias("id"), hash_.alias("hash"), F.coalesce(text, F.lit("")).alias("text"))
    blank = F.btrim("text", F.lit(SPACES.decode())) == ""

    def picked(wanted: DataFrame) -> DataFrame:
        return rows.filter(~blank).drop("text").join(wanted, rows["id"].eqNullSafe(wanted["jj_id"]) & (rows["hash"] == wanted["jj_hash"]), "left_semi")

    same = F.col("c.jj_id").eqNullSafe(F.col("r.jj_id")) & (F.col("c.jj_hash") == F.col("r.jj_hash"))
    once = picked(chosen.alias("c").join(repeated.alias("r"), same, "left_anti"))
    # equal rows (all columns): one of each
    several = picked(chosen.alias("c").join(repeated.alias("r"), same, "left_semi")).dropDuplicates(["id", "hash"])
    return once.select("row.*").union(several.select("row.*")).union(rows.filter(blank).select("row.*"))


#: The same in SQL, from a list of common shingles for each pair; ids must be unique.
DOCUMENTS_SQL = r"""
with recursive texts as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents
), sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, chr(1))]
    else list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || chr(1) || w[i + 1] || chr(1) || w[i + 2])) end as s
  from texts
), sizes as materialized (
  select doc_id, len(s) as n from sets
), flat as materialized (
  select doc_id, unnest(s) as x from sets
), links as materialized (
  select c.a, c.b from (select a.doc_id as a, b.doc_id as b, count(*) as n from flat a join flat b on a.x = b.x and a.doc_id <> b.doc_id group by all) c
  join sizes p on c.a = p.doc_id join sizes q on c.b = q.doc_id where 100 * c.n >= 90 * (p.n + q.n - c.n)
), reach as (
  select doc_id as a, doc_id as b from sizes
  union select r.a, l.b from reach r join links l on r.b = l.a
)
select doc_id, n as n_shingles, min(b) as component_id from sizes join reach on a = doc_id group by doc_id, n
"""
