"""Removal of byte strings that repeat anywhere in the corpus, by suffix arrays of shared places.

A window is a string of ``WINDOW`` bytes. Every window has an anchor: the
leftmost ``GRAM``-byte string in it whose hash is smallest. Equal windows have
equal anchors at equal offsets, so windows only have to be compared with those
under an equal anchor. Anchors that occur once are dropped after one aggregation;
the places around the others (at most 2 * ``WINDOW`` bytes, a *snippet*) go to
the group of their anchor. Snippets that are equal to another one are repeated
throughout. The remaining ones are compared in shards of whole groups:

* left and right contexts of a group become paths in a trie, so a snippet is a
  short string of edges. That keeps the order of its suffixes, and the text to
  sort is dozens of times shorter;
* the suffix array of a shard is built by linear grouping: suffixes are grouped by
  their Lyndon prefixes, groups are processed in descending order over pointers to
  the previous smaller suffix, and each group's order is then emitted in one scan;
* a suffix shares most bytes with one of its neighbours, which tells where windows repeat.

A group of more than ``GROUP`` different snippets is not held by one task. Its windows
are dealt into ranges of ``RANGE`` distances from the anchor; all windows of a range share a
core of bytes, which makes a group of its own, and the bytes that the range needs are few, so equal
ones meet in an aggregation. Ranges that are still in more than ``GROUP`` different surroundings have
their windows counted by hash in an aggregation. Nothing is cut off.

Results depend on the text of a row alone, so rows with equal texts share them;
ids may repeat or be null. A null text is empty. Texts may be of any length; they
are read in blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poolwright.llm.common import BASE, INVERSE, column, frugal, mixed, powers, utf8
from poolwright.session import materialize

WINDOW = 200
GRAM = 32
#: Window starts that are looked at together.
BLOCK = 1 << 18
#: Different snippets of one anchor that a task may hold.
GROUP = 2000
#: Distances from the anchor in a range.
RANGE = 22
#: Symbols of a shard's text.
SHARD = 200_000


# --- anchors -----------------------------------------------------------------


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of every GRAM-byte string, by doubling."""
    h = mixed(data.astype(np.uint64) + np.uint64(0x51ED270B))
    size = 1
    while size < GRAM:
        h = h[:-size] * np.uint64(0xD1342543DE82EF95) + (h[size:] ^ np.uint64(0x9E37 * size))
        h ^= h >> np.uint64(29)
        size *= 2
    return mixed(h)


def _block_anchors(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchor hash, anchor place, first and one past the last start, and snippet hash of the windows of a block."""
    grams = gram_hashes(data)
    low = np.uint64((1 << 20) - 1)  # a block is shorter
    ranked = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)  # ties go to the left
    width = WINDOW - GRAM + 1
    padded = np.concatenate([ranked, np.full(-len(ranked) % width, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(padded, axis=1).ravel()
    starts = len(data) - WINDOW + 1
    place = (np.minimum(ahead[:starts], behind[width - 1 : width - 1 + starts]) & low).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    last = np.concatenate([first[1:], [starts]])
    place = place[first]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data)), out=sums[1:])
    content = (sums[last + WINDOW - 1] - sums[first]) * powers(INVERSE, len(data))[first]
    content = mixed(content + ((place - first) * 1024 + (last - first)).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return grams[place], place, first, last, content


def anchors(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchor hashes, snippet hashes and packed places of a text.

    A packed place holds the first start, the anchor's distance from it (8 bits) and
    the number of starts (8 bits).
    """
    found = []
    for at in range(0, len(data) - WINDOW + 1, BLOCK):
        h, place, first, last, content = _block_anchors(data[at : at + BLOCK + WINDOW - 1])
        found.append((h, content, ((first + at) << 16) | ((place - first) << 8) | (last - first)))
    if not found:
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),)
    return tuple(np.concatenate(x) for x in zip(*found))


# --- suffix array ------------------------------------------------------------


def suffix_array(text: list[int]) -> list[int]:
    """Suffix array of ``text``, whose last symbol is smaller than all others and occurs once.

    First the groups: suffixes that share their Lyndon prefix, in order. The highest
    group that was not yet processed lends its prefix to the previous smaller suffix
    of each member; the suffixes that got more of it move up within their own group.
    Then the order: the suffixes whose next smaller suffix is the one just read
    follow over the same pointers, each to the next place of its group.
    """
    n = len(text)
    order = sorted(range(n), key=text.__getitem__)
    place = [0] * n
    group = [0] * n  # of a suffix: the first place of its group
    tail = [0] * n  # of a group: its last place
    at = 0
    for r, i in enumerate(order):
        place[i] = r
        if text[i] != text[order[at]]:
            at = r
        group[i] = at
        tail[at] = r
    before = [-1] * n  # the previous smaller suffix
    top = n - 1
    while top > 0:
        low = group[order[top]]
        given: dict[int, int] = {}
        for i in sorted(order[low : top + 1]):
            j = i - 1
            while j >= 0 and group[j] >= low:
                j = before[j]
            before[i] = j
            if j >= 0:
                given[j] = given.get(j, 0) + 1
        for times in sorted(set(given.values()), reverse=True):
            moved: dict[int, int] = {}
            for j, k in given.items():
                if k == times:
                    g = group[j]
                    to = tail[g] - moved.get(g, 0)
                    moved[g] = moved.get(g, 0) + 1
                    other, own = order[to], place[j]
                    order[own], place[other] = other, own
                    order[to], place[j] = j, to
            for g, k in moved.items():
                end = tail[g]
                new = end - k + 1
                if new > g:
                    for r in range(new, end + 1):
                        group[order[r]] = new
                    tail[new] = end
                    tail[g] = new - 1
        top = low - 1
    out = [-1] * n
    out[0] = n - 1
    emitted = bytearray(n)
    emitted[n - 1] = 1
    free = list(range(n))
    for r in range(n):
        j = out[r] - 1
        while j >= 0 and not emitted[j]:
            g = group[j]
            out[free[g]] = j
            free[g] += 1
            emitted[j] = 1
            j = before[j]
    return out


# --- groups ------------------------------------------------------------------


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


def trie_paths(strings: list[bytes]) -> list[list[tuple[int, int]]]:
    """For each string its nodes in the trie of all: (depth, number), from the root down.

    A node's number is the rank of the first string below it, so (depth, number) names it.
    """
    order = sorted(range(len(strings)), key=strings.__getitem__)
    n = len(order)
    shared = [0] * (n + 1)
    for r in range(1, n):
        shared[r] = common_prefix(strings[order[r - 1]], strings[order[r]])
    below: list[list[int]] = [[] for _ in range(n)]  # depths at which a string leaves the ones after it
    stack: list[int] = []
    for r in range(n - 1, -1, -1):
        depth = shared[r + 1]
        while stack and stack[-1] > depth:
            stack.pop()
        if depth and (not stack or stack[-1] != depth):
            stack.append(depth)
        below[r] = stack.copy()
    paths: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    open_: list[tuple[int, int]] = []  # depths shared with strings before, and where each began
    for r in range(n):
        while open_ and open_[-1][0] > shared[r]:
            open_.pop()
        whole = len(strings[order[r]])
        depths = sorted({d for d, _ in open_} | set(below[r]) | {whole} - {0})
        path, k = [], 0
        for d in depths:
            while k < len(open_) and open_[k][0] < d:
                k += 1
            path.append((d, open_[k][1] if k < len(open_) else r))
        paths[order[r]] = path
        for d, first in path:
            if not open_ or d > open_[-1][0]:
                open_.append((d, first))
    return paths


def repeated_starts(groups: list[list[tuple[int, bytes]]]) -> list[list[list[tuple[int, int]]]]:
    """For each snippet of each group the ranges of its window starts that repeat in the group.

    A snippet is given by the bytes before its anchor and its bytes. One suffix array serves all groups.
    """
    text: list[int] = []
    width: list[int] = []  # bytes of a symbol right of an anchor's start
    names: dict[tuple, int] = {}
    marks: list[list[tuple[int, list[tuple[int, int]]]]] = []
    for g, group in enumerate(groups):
        lefts = trie_paths([data[:k][::-1] for k, data in group])
        rights = trie_paths([data[k:] for k, data in group])
        own = []
        for left, right in zip(lefts, rights):
            # (symbol's place, nearest and farthest start in it), the anchor itself last
            bands, depth = [], 0
            for d, _ in left:
                bands.append((depth + 1, d))
                depth = d
            own.append((len(text), bands[::-1] + [(0, 0)]))
            for d, first in reversed(left):
                text.append(names.setdefault((g, 0, d, first), len(names) + 2))
                width.append(0)
            text.append(names.setdefault((g,), len(names) + 2))
            width.append(0)
            depth = 0
            for d, first in right:
                text.append(names.setdefault((g, 1, d, first), len(names) + 2))
                width.append(d - depth)
                depth = d
            text.append(1)
            width.append(0)
        marks.append(own)
    text.append(0)
    width.append(0)
    best = shared_bytes(text, width, suffix_array(text))
    out = []
    for own, group in zip(marks, groups):
        found = []
        for (at, bands), (before, data) in zip(own, group):
            starts = len(data) - WINDOW + 1
            ranges: list[tuple[int, int]] = []
            for k, (near, far) in enumerate(bands):
                near = max(near, WINDOW - best[at + k], before - starts + 1)
                if best[at + k] and near <= far:
                    a, b = before - far, before - near + 1
                    if ranges and ranges[-1][1] == a:
                        ranges[-1] = (ranges[-1][0], b)
                    else:
                        ranges.append((a, b))
            found.append(ranges)
        out.append(found)
    return out


def shared_bytes(text: list[int], width: list[int], order: list[int]) -> list[int]:
    """For each suffix the most bytes right of its anchor that it shares with another one, up to its snippet's end."""
    n = len(text)
    rank = [0] * n
    for r, i in enumerate(order):
        rank[i] = r
    total = [0] * (n + 1)
    for i, w in enumerate(width):
        total[i + 1] = total[i] + w
    best = [0] * n
    same = 0
    for i in range(n - 1):
        j = order[rank[i] - 1]
        while text[i + same] == text[j + same] and text[i + same] > 1:
            same += 1
        got = total[i + same] - total[i]
        if got > best[i]:
            best[i] = got
        if got > best[j]:
            best[j] = got
        if same:
            same -= 1
    return best


# --- the job -----------------------------------------------------------------


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _different(batch: pa.RecordBatch) -> tuple[list[int], np.ndarray]:
    """Rows of a batch with different texts, and how many rows have each text."""
    rows: dict[tuple[int, int], int] = {}
    counts: list[int] = []
    first: list[int] = []
    for i, key in enumerate(zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist())):
        n = rows.setdefault(key, len(first))
        if n == len(first):
            first.append(i)
            counts.append(0)
        counts[n] += 1
    return first, np.array(counts, np.int64)


def _anchor_rows(places: bool):
    """Anchors of every different text of a batch; with ``places`` one row each, else one row a hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, bounds = utf8(batch.column("text"))
            rows, counts = _different(batch)
            parts = [anchors(flat[bounds[i] : bounds[i + 1]]) for i in rows]
            if not parts:
                continue
            sizes = [len(p[0]) for p in parts]
            h, content, place = (np.concatenate(x) for x in zip(*parts))
            n = np.repeat(counts, sizes)
            if places:
                k1, k2 = (np.repeat(np.asarray(batch.column(k))[rows], sizes) for k in ("k1", "k2"))
                for a in range(0, len(h), 50_000):
                    s = slice(a, a + 50_000)
                    yield pa.RecordBatch.from_arrays([_signed(h[s]), _signed(content[s]), pa.array(k1[s]), pa.array(k2[s]), pa.array(place[s]), pa.array(n[s])], ["h", "content", "k1", "k2", "place", "n"])
            elif len(h):
                order = np.argsort(h, kind="stable")
                h, content, n = h[order], content[order].view(np.int64), n[order]
                cut = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
                yield pa.RecordBatch.from_arrays([_signed(h[cut]), pa.array(np.add.reduceat(n, cut)), pa.array(np.minimum.reduceat(content, cut)), pa.array(np.maximum.reduceat(content, cut))], ["h", "n", "lo", "hi"])

    return run


def _one_text_a_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            yield batch.take(pa.array(_different(batch)[0]))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Snippets of the wanted places of a text."""
    for batch in batches:
        for i in range(batch.num_rows):
            data = batch.column("text")[i].as_buffer()
            out = [(w["h"], w["content"], w["n"], (w["place"] >> 8) & 255, bytes(data[(a := w["place"] >> 16) : a + (w["place"] & 255) + WINDOW - 1])) for w in batch.column("wanted")[i].as_py()]
            h, content, n, before, cut = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(content, pa.int64()), pa.array(n, pa.int64()), pa.array(before, pa.int64()), pa.array(cut, pa.binary())], ["h", "content", "n", "before", "data"])


def _sorted_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges of repeated starts per snippet, from rows sorted by group; a shard holds whole groups."""
    held: list[tuple] = []
    groups: list[list[tuple]] = []
    size = 0

    def done() -> pa.RecordBatch:
        ranges = repeated_starts([[(r[3], r[4]) for r in g] for g in groups])
        rows = [(*r[:3], [x for ab in found for x in ab]) for g, got in zip(groups, ranges) for r, found in zip(g, got) if found]
        h, part, content, found = zip(*rows) if rows else ((),) * 4
        return pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(part, pa.int64()), pa.array(content, pa.int64()), pa.array(found, pa.list_(pa.int32()))], ["h", "part", "content", "ranges"])

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("h", "part", "content", "before", "data"))):
            if held and held[-1][:2] != row[:2]:
                groups.append(held)
                size += 6 * len(held)
                held = []
                if size > SHARD:
                    yield done()
                    groups, size = [], 0
            held.append(row)
    if held:
        groups.append(held)
    if groups:
        yield done()


def _hashes(data: bytes, starts: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes at each start."""
    up, down = powers(BASE, 4 * WINDOW), powers(INVERSE, 4 * WINDOW)
    raw = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(raw * up[: len(raw)])])
    return mixed((sums[starts + size] - sums[starts]) * down[starts] + np.uint64(size))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Snippets cut into ranges of window distances: (h, part, piece, n, content, first, before, data)."""
    for batch in batches:
        out = []
        for h, content, n, before, data in zip(*(batch.column(c).to_pylist() for c in ("h", "content", "n", "before", "data"))):
            starts = len(data) - WINDOW + 1
            for k in range((before - starts + 1) // RANGE, before // RANGE + 1):
                far, near = min(before, (k + 1) * RANGE - 1), max(before - starts + 1, k * RANGE)
                # every window of the range holds its core
                core = int(_hashes(data, np.array([before - k * RANGE]), WINDOW - RANGE + 1)[0])
                first = before - far
                piece = data[first : before - near + WINDOW]
                own = int(_hashes(piece, np.zeros(1, np.int64), len(piece))[0]) ^ (far << 20) ^ len(piece)
                out.append((h, _wrap(core ^ k), _wrap(own), n, content, first, far, piece))
        kinds = [("h", pa.int64()), ("part", pa.int64()), ("piece", pa.int64()), ("n", pa.int64()), ("content", pa.int64()), ("first", pa.int32()), ("before", pa.int64()), ("data", pa.binary())]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, (_, kind) in enumerate(kinds)], [name for name, _ in kinds])


def _wrap(value: int) -> int:
    """An unsigned 64-bit number as a signed one."""
    return value - (1 << 64) if value >> 63 else value


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of a piece: its start, its distance before the anchor and its hash."""
    for batch in batches:
        for h, part, content, before, data in zip(*(batch.column(c).to_pylist() for c in ("h", "part", "content", "before", "data"))):
            starts = np.arange(len(data) - WINDOW + 1)
            k = len(starts)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(k, x)) for x in (h, part, content)] + [pa.array(starts), pa.array(before - starts), _signed(_hashes(data, starts, WINDOW))], ["h", "part", "content", "start", "d", "window"])


def _ranges(rows: DataFrame) -> DataFrame:
    """Repeated starts (h, part, content, ranges) of different snippets (h, part, content, before, data) of groups (h, part)."""
    rows = rows.select("h", "part", "content", "before", "data")
    large = rows.groupBy("h", "part").count().filter(F.col("count") > GROUP).select("h", "part")
    small = rows.join(large, ["h", "part"], "left_anti").repartition("h", "part").sortWithinPartitions("h", "part", "content")
    by_order = small.select("h", "part", "content", "before", "data").mapInArrow(_sorted_groups, "h long, part long, content long, ranges array<int>")
    windows = rows.join(large, ["h", "part"], "left_semi").select("h", "part", "content", "before", "data").mapInArrow(
        _windows, "h long, part long, content long, start long, d long, window long")
    twice = windows.groupBy("h", "part", "d", "window").count().filter("count > 1").drop("count")
    by_count = windows.join(twice, ["h", "part", "d", "window"]).groupBy("h", "part", "content").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.col("start").cast("int"))), lambda s: F.array(s, s + 1))).alias("ranges"))
    return by_order.union(by_count)


def snippet_ranges(cut: DataFrame) -> DataFrame:
    """Repeated starts (h, content, ranges) of the snippets of all groups; (h, content, n, before, data) are different snippets."""
    large = cut.groupBy("h").count().filter(F.col("count") > GROUP).select("h")
    found = _ranges(cut.join(large, "h", "left_anti").withColumn("part", F.lit(0).cast("long"))).select("h", "content", "ranges")
    parts = cut.join(large, "h", "left_semi").select("h", "content", "n", "before", "data").mapInArrow(
        _parts, "h long, part long, piece long, n long, content long, first int, before long, data binary")
    parts = materialize(parts, "parts")
    pieces = parts.groupBy("h", "part", "piece").agg(F.sum("n").alias("n"), F.first("before").alias("before"), F.first("data").alias("data"))
    pieces = materialize(pieces, "pieces")
    groups = pieces.groupBy("h", "part").agg(F.count("*").alias("k")).filter("k > 1").drop("k")
    once = _ranges(pieces.join(groups, ["h", "part"], "left_semi").withColumnRenamed("piece", "content"))
    once = once.withColumnRenamed("content", "piece")
    several = pieces.filter("n > 1").select("h", "part", "piece", F.array(F.lit(0), (F.octet_length("data") - WINDOW + 1).cast("int")).alias("ranges"))
    known = once.join(several, ["h", "part", "piece"], "left_anti").union(several)
    back = parts.select("h", "part", "piece", "content", "first").join(known, ["h", "part", "piece"])
    back = back.groupBy("h", "content").agg(F.flatten(F.collect_list(F.transform("ranges", lambda x: x + F.col("first")))).alias("ranges"))
    return found.union(back)


def _cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Removed runs of a text from its repeated starts, and the digest of what stays."""
    for batch in batches:
        out = []
        for i in range(batch.num_rows):
            data = batch.column("text")[i].as_buffer()
            data = np.frombuffer(data, np.uint8) if data.size else np.zeros(0, np.uint8)
            change = np.zeros(len(data) + 1, np.int64)
            for one in batch.column("found")[i].as_py():
                first, n = one["place"] >> 16, one["place"] & 255
                ranges = one["ranges"] if one["ranges"] is not None else [0, n]
                for a, b in zip(ranges[::2], ranges[1::2]):
                    change[first + a] += 1
                    change[first + b - 1 + WINDOW] -= 1
            gone = np.cumsum(change[:-1]) > 0
            edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
            kept = data[~gone].tobytes()
            out.append((edges[::2].tolist(), edges[1::2].tolist(), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore")))
        starts, ends, removed, digest, kept = zip(*out) if out else ((),) * 5
        yield pa.RecordBatch.from_arrays([
            batch.column("k1"), batch.column("k2"), pa.array(starts, pa.list_(pa.int64())), pa.array(ends, pa.list_(pa.int64())),
            pa.array(removed, pa.int64()), pa.array(digest, pa.string()), pa.array(kept, pa.string()),
        ], ["k1", "k2", "starts", "ends", "n_removed", "kept_sha256", "kept"])


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with its text made non-null as ``dedup_text`` and a 128-bit key of it as ``dedup_k1``, ``dedup_k2``."""
    docs = docs.withColumn("dedup_text", F.coalesce(column(docs, "text", "string"), F.lit("")))
    return docs.withColumns({"dedup_k1": F.xxhash64("dedup_text"), "dedup_k2": F.xxhash64(F.lit("second"), "dedup_text")})


def repeated_spans(rows: DataFrame, *columns: str) -> DataFrame:
    """Removed runs of the texts that have any: (k1, k2, starts, ends, n_removed, kept_sha256, kept), or some of these columns.

    The digest is that of the kept bytes; in ``kept`` characters that were cut in two are left out. ``rows`` holds (text, k1, k2), null-free. One row a text, however many rows have it.
    """
    with frugal(rows.sparkSession):
        found = _repeated_spans(rows)
        return materialize(found.select("k1", "k2", *(columns or found.columns[2:])), "spans")


def _repeated_spans(rows: DataFrame) -> DataFrame:
    seen = rows.mapInArrow(_anchor_rows(False), "h long, n long, lo long, hi long")
    shared = seen.groupBy("h").agg(F.sum("n").alias("total"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    shared = materialize(shared.filter("total > 1").select("h", (F.col("lo") != F.col("hi")).alias("mixed")), "shared")
    places = rows.mapInArrow(_anchor_rows(True), "h long, content long, k1 long, k2 long, place long, n long")
    # dealt by the whole key behind the join, so that Spark may split a frequent anchor in it
    places = places.join(shared, "h").repartition("h", "content", "k1", "k2", "place")
    places = places.groupBy("h", "content", "mixed", "k1", "k2", "place").agg(F.sum("n").alias("n"))
    places = materialize(places, "places")

    keys = places.select("k1", "k2").distinct()
    texts = rows.mapInArrow(_one_text_a_batch, rows.schema).join(keys, ["k1", "k2"], "left_semi")
    texts = materialize(texts.dropDuplicates(["k1", "k2"]), "texts")

    mixed_places = places.filter("mixed")
    snippets = mixed_places.groupBy("h", "content").agg(F.sum("n").alias("n"), F.min(F.struct("k1", "k2", "place")).alias("one"))
    wanted = snippets.select("one.k1", "one.k2", F.struct("h", "content", "n", "one.place").alias("w")).groupBy("k1", "k2").agg(F.collect_list("w").alias("wanted"))
    cut = texts.join(wanted, ["k1", "k2"]).select("text", "wanted").mapInArrow(_cut, "h long, content long, n long, before long, data binary")
    cut = materialize(cut, "snippets")
    snippets = materialize(snippets.select("h", "content", "n"), "snippet_counts")
    once = snippets.filter("n = 1").select("h", "content")
    ranges = snippet_ranges(cut).join(once, ["h", "content"], "left_semi")

    whole = places.filter("not mixed").select("k1", "k2", "place", F.lit(None).cast("array<int>").alias("ranges"))
    several = snippets.filter("n > 1").select("h", "content", F.lit(None).cast("array<int>").alias("ranges"))
    # written first: Spark splits a frequent snippet in the join only where no aggregation shares its shuffle
    known = materialize(ranges.select("h", "content", "ranges").union(several), "known")
    some = mixed_places.join(known, ["h", "content"]).select("k1", "k2", "place", "ranges")
    found = whole.union(some).groupBy("k1", "k2").agg(F.collect_list(F.struct("place", "ranges")).alias("found"))
    covered = texts.join(found, ["k1", "k2"]).select("k1", "k2", "text", "found")
    return covered.mapInArrow(_cover, "k1 long, k2 long, starts array<long>, ends array<long>, n_removed long, kept_sha256 string, kept string")


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("dedup_text").alias("text"), F.col("dedup_k1").alias("k1"), F.col("dedup_k2").alias("k2"))


def dedup_digests(docs: DataFrame) -> DataFrame:
    """Bytes, removed bytes, removed runs and the digest of the kept bytes of every row."""
    own = keyed(docs.select(column(docs, "doc_id", "long").alias("doc_id"), column(docs, "text", "string").alias("text")))
    spans = repeated_spans(_rows(own), "n_removed", "starts", "kept_sha256").withColumn("n_spans", F.size("starts").cast("long")).drop("starts")
    plain = own.select(
        "doc_id", F.col("dedup_k1").alias("k1"), F.col("dedup_k2").alias("k2"), F.octet_length("dedup_text").cast("long").alias("n_bytes"),
        F.sha2(F.col("dedup_text").cast("binary"), 256).alias("sha"))
    return plain.join(spans, ["k1", "k2"], "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated byte strings taken out of ``text``, and ``n_chars`` counted anew.

    Rows of which nothing but white space is left go; rows that had nothing else before stay. Both columns are
    found in any case, and other columns may have any names.
    """
    own = keyed(docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), column(docs, "text", "string").alias("text")))
    spans = repeated_spans(_rows(own), "kept").select(F.col("k1").alias("dedup_k1"), F.col("k2").alias("dedup_k2"), F.col("kept").alias("dedup_kept"))
    joined = own.join(spans, ["dedup_k1", "dedup_k2"], "left").filter(F.col("dedup_kept").isNull() | F.col("dedup_kept").rlike(r"\S"))
    out = []
    for field in docs.schema.fields:
        value = F.col("row").getField(field.name)
        if field.name.lower() == "text":
            value = F.coalesce(F.col("dedup_kept").cast(field.dataType), value)
        elif field.name.lower() == "n_chars":
            value = F.coalesce(F.when(F.col("dedup_kept").isNotNull(), F.char_length("dedup_kept").cast(field.dataType)), value)
        out.append(value.alias(field.name))
    return joined.select(*out)
