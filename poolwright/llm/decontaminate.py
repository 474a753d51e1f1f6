"""Benchmark passages in documents, by an embedding of edit distance.

Texts are compared as words of letters and digits in lower case with single spaces.
A document holds an item if a part of it is within ``1 - similarity`` edits a
character of the item. Windows of an item's number of words are embedded by a random
walk: it reads a character at each step and moves on or stays by a random bit for
that step and character. Close strings soon walk in step again after an edit, so
edit distance becomes Hamming distance, and sampled steps make the keys of a
locality-sensitive hash. Several walks and several samples of each bring the recall
to its target (``tests/llm`` measures it). Candidates are checked by exact edit
distance against the window and its surroundings.

Only windows are embedded that have at least ``VOTES`` pairs of neighbouring words
where an item has them: two places that edits left whole, apart or in a row.

A character of a script without spaces between words (``APART``) is a word of its own, and
nothing stands between it and the next one. Items of fewer than ``LEAST`` words have too few
words to align a window. With ``whole`` each of them is searched by its pieces: one more than edits are allowed, so
that one stands unchanged; every place of a piece is checked. Where no edit is allowed (up to four characters at 0.8) an item
must stand as whole words. Without ``whole`` such items match exactly, word by word, if they have ``LEAST_BYTES`` bytes. The
benchmark is indexed in blocks of bounded size and each block reads all documents,
so it need not fit a task. Null and empty texts hold nothing; rows with equal
texts or ids are searched alike, each on its own.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poolwright.llm.common import column, in_slices, mixed, utf8, word_bounds, word_hashes

#: Bytes of an item at least where it has fewer than ``LEAST`` words; they cover ten Latin letters or four Chinese characters.
LEAST_BYTES = 10
#: Words of a passage that is searched with edits at least; words in a row, and how many such runs, that align a window.
LEAST, RUN, VOTES = 5, 2, 2
#: Random walks, samples of a walk, steps of a sample.
WALKS, SAMPLES, STEPS = 6, 24, 3
#: Samples that a window and an item must share.
AGREE = 3
#: Steps of a walk for each word; a word and its space take about 13.
PACE = 10
#: Characters of a piece at most that is looked up, and places that are checked at once.
PIECE, HITS = 8, 8192
#: Characters of an item of few words above which its places are checked one by one.
LONG = 96
#: Bytes of benchmark text in one pass.
PASS_BYTES = 8 << 20

#: Bytes of letters, digits and anything that is not ASCII.
WORD = np.zeros(256, bool)
WORD[list(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True
WORD[128:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


#: Code points of scripts without spaces between words: Thai and Lao, Myanmar, Khmer, kana, Chinese characters.
APART = ((0xE00, 0xF00), (0x1000, 0x10A0), (0x1780, 0x1800), (0x3005, 0x3008), (0x3040, 0x3130), (0x31F0, 0x3200), (0x3400, 0xA000), (0xF900, 0xFB00), (0x20000, 0x32400))
#: Code points of punctuation in such texts: no words.
SIGNS = ((0x3000, 0x3005), (0x3008, 0x3020), (0x30FB, 0x30FC), (0xFF01, 0xFF10), (0xFF1A, 0xFF21), (0xFF3B, 0xFF41), (0xFF5B, 0xFF66))


def apart(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and length of the characters of ``APART`` in some texts, and the bytes of ``SIGNS``."""
    begin = np.flatnonzero(flat >= 0xE0)
    size = np.where(flat[begin] >= 0xF0, 4, 3)
    part = [flat[np.minimum(begin + k, len(flat) - 1)].astype(np.int64) & 0x3F for k in range(4)]
    lead = flat[begin].astype(np.int64)
    code = np.where(size == 4, (lead & 7) << 18 | part[1] << 12 | part[2] << 6 | part[3], (lead & 15) << 12 | part[1] << 6 | part[2])
    held = lambda spans: np.any([(code >= a) & (code < b) for a, b in spans], axis=0)
    sign = held(SIGNS)
    own = held(APART) & ~sign
    return begin[own], size[own], (begin[sign][:, None] + np.arange(3)).ravel()


class Words:
    """Words of some texts: hashes, places, and the texts with single spaces."""

    def __init__(self, flat: np.ndarray, bounds: np.ndarray) -> None:
        gap = None
        if len(flat) and flat.max() >= 0xE0:
            begin, size, signs = apart(flat)
            if len(signs):
                flat = flat.copy()
                flat[signs] = 32
            # a character apart begins and ends a word, as a text does
            edges = np.unique(np.concatenate([bounds, begin, begin + size]))
            self.hashes, _ = word_hashes(flat, edges, WORD)
            self.starts, self.ends, _ = word_bounds(flat, edges, WORD)
            self.at = np.searchsorted(self.starts, bounds)
            gap = ~np.isin(self.starts, begin)
        else:
            self.hashes, self.at = word_hashes(flat, bounds, WORD)
            self.starts, self.ends, _ = word_bounds(flat, bounds, WORD)
        self.runs = run_hashes(self.hashes, RUN)
        size = self.ends - self.starts
        #: Bytes between a word and the next one.
        self.gap = np.ones(len(size), np.int64) if gap is None else gap.astype(np.int64)
        self.offset = np.concatenate([[0], np.cumsum(size + self.gap)])
        self.plain = np.full(int(self.offset[-1]), 32, np.uint8)
        held = WORD[flat]
        before = np.cumsum(self.gap) - self.gap
        self.plain[np.arange(int(size.sum())) + np.repeat(before, size)] = LOWER[flat[held]]

    def text(self, first: int, last: int) -> str:
        """Words ``first`` to ``last``, the last one left out."""
        return self.plain[self.offset[first] : self.offset[last] - self.gap[last - 1] if last > first else self.offset[first]].tobytes().decode("utf-8", "replace").lower()


def run_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words."""
    out = np.zeros(max(0, len(hashes) - n + 1), np.uint64)
    for k in range(n):
        out += hashes[k : len(hashes) - n + 1 + k] * np.uint64((0x8CB92BA72F3D8DD7 * (2 * k + 1)) % (1 << 64))
    return mixed(out)


def embed(rows: np.ndarray, walk: int, steps: int) -> np.ndarray:
    """Characters that a random walk reads in each row (0 pads a row)."""
    moves = np.random.default_rng([walk, 77]).integers(0, 2, (steps, 256), np.int8)
    flat, width = rows.ravel(), rows.shape[1]
    base = np.arange(len(rows)) * width
    at = np.zeros(len(rows), np.int64)
    out = np.empty((steps, len(rows)), np.uint8)
    for j in range(steps):
        seen = flat[base + np.minimum(at, width - 1)]
        out[j] = seen
        at += moves[j][seen]
    return out


def keys(words: Words, first: np.ndarray, count: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hash keys (window x sample) of windows of ``count`` words; ``size`` is the item's number of words."""
    begin, end = words.offset[first], words.offset[first + count] - words.gap[first + count - 1]
    width = int((end - begin).max()) + 1
    places = begin[:, None] + np.arange(width)[None, :]
    rows = np.where(places < end[:, None], words.plain[np.minimum(places, len(words.plain) - 1)], 0).astype(np.uint8)
    steps = int(size.max()) * PACE
    out = np.empty((len(first), WALKS * SAMPLES), np.uint64)
    for walk in range(WALKS):
        seen = embed(rows, walk, steps)
        for n in np.unique(size).tolist():
            own = np.flatnonzero(size == n)
            chosen = np.random.default_rng([walk, n, 78]).integers(0, n * PACE, (SAMPLES, STEPS))
            for s in range(SAMPLES):
                key = np.full(len(own), walk * SAMPLES + s + 1, np.uint64)
                for j in chosen[s]:
                    key = (key << np.uint64(8)) | seen[j, own].astype(np.uint64)
                out[own, walk * SAMPLES + s] = mixed(key * np.uint64(1 << 20) + np.uint64(n))
    return out


def edit_distance_within(item: str, text: str, most: int) -> int | None:
    """Fewest edits that turn ``item`` into some part of ``text``, None if more than ``most``."""
    if item in text:
        return 0
    m = len(item)
    masks: dict[str, int] = defaultdict(int)
    for i, c in enumerate(item):
        masks[c] |= 1 << i
    full, high = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best = full, 0, m, m
    for c in text:
        same = masks.get(c, 0)
        down = (((same & plus) + plus) ^ plus) | same | minus
        up_plus = minus | (full & ~(down | plus))
        up_minus = plus & down
        if up_plus & high:
            score += 1
        elif up_minus & high:
            score -= 1
            best = min(best, score)
        up_plus = (up_plus << 1) & full
        up_minus = (up_minus << 1) & full
        plus = up_minus | (full & ~(down | up_plus))
        minus = up_plus & down
        # here the first row is 0 everywhere: a match may begin anywhere
    return best if best <= most else None


def points(text: str) -> np.ndarray:
    """Code points of a text."""
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


def char_hashes(chars: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` code points."""
    out = np.zeros(max(0, len(chars) - n + 1), np.uint64)
    for k in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + chars[k : len(chars) - n + 1 + k]
    return mixed(out)


def fewest_edits(item: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewest edits that turn ``item`` into some part of each row of code points, and one past that part's end; 0 pads a row and equals nothing."""
    # a column of the table of distances at a time, for all rows; the first cell is 0 everywhere: a match may begin anywhere
    column = np.repeat(np.arange(len(item) + 1, dtype=np.int32)[:, None], len(rows), 1)
    best, end = column[-1].copy(), np.zeros(len(rows), np.int64)
    for j in range(rows.shape[1]):
        before = column[0].copy()
        for i in range(1, len(item) + 1):
            new = np.minimum(np.minimum(column[i], column[i - 1]) + 1, before + (rows[:, j] != item[i - 1]))
            before, column[i] = column[i].copy(), new
        better = column[-1] < best
        best[better], end[better] = column[-1][better], j + 1
    return best, end


class Index:
    """Runs of words and hash keys of one block of items."""

    def __init__(self, items: list[tuple[int, str]], similarity: float, whole: bool = False) -> None:
        texts = [t for _, t in items]
        flat, bounds = utf8(pa.array(texts, pa.string()))
        words = Words(flat, bounds)
        sizes = np.diff(words.at)
        kept = np.flatnonzero(sizes >= LEAST)
        self.ids = [items[i][0] for i in kept]
        self.sizes = sizes[kept]
        self.texts = [words.text(words.at[i], words.at[i + 1]) for i in kept]
        self.most = [int((1 - similarity) * len(t) + 1e-9) for t in self.texts]
        hashes, item, offset = [], [], []
        for k, i in enumerate(kept):
            a, b = words.at[i], words.at[i + 1] - RUN + 1
            hashes.append(words.runs[a:b])
            item.append(np.full(b - a, k))
            offset.append(np.arange(b - a))
        none = np.zeros(0, np.int64)
        h = np.concatenate([np.zeros(0, np.uint64), *hashes])
        order = np.argsort(h, kind="stable")
        self.h, self.item, self.offset = h[order], np.concatenate([none, *item])[order], np.concatenate([none, *offset])[order]
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(self.h >> np.uint64(44)).astype(np.int64)] = True
        self.short: dict[int, tuple[np.ndarray, list[list[tuple[int, str]]]]] = {}
        self.pieces: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        self.add_short(words, sizes, [i for i, _ in items], similarity, whole)
        if len(kept):
            key = keys(words, words.at[kept], self.sizes, self.sizes)
            flat_keys = key.ravel()
            order = np.argsort(flat_keys, kind="stable")
            self.keys, self.owner = flat_keys[order], np.repeat(np.arange(len(kept)), key.shape[1])[order]

    def add_short(self, words: Words, sizes: np.ndarray, ids: list[int], similarity: float, whole: bool) -> None:
        """Items of few words: by their number of words and the hash of these, with ``whole`` by pieces if edits are allowed."""
        found: dict[int, dict[int, list[int]]] = {}
        pieces: dict[int, list[tuple[int, int, int]]] = {}
        for i in np.flatnonzero((sizes > 0) & (sizes < LEAST)).tolist():
            a, b = words.at[i], words.at[i + 1]
            text = words.text(a, b)
            if not whole and len(text.encode()) < LEAST_BYTES:
                continue
            k, most = len(self.ids), min(int((1 - similarity) * len(text) + 1e-9), len(text) - 1)
            self.ids.append(ids[i])
            self.texts.append(text)
            self.most.append(most)
            if not whole or not most:
                found.setdefault(b - a, {}).setdefault(int(run_hashes(words.hashes[a:b], b - a)[0]), []).append(k)
                continue
            edges = [len(text) * j // (most + 1) for j in range(most + 2)]
            for begin, end in zip(edges, edges[1:]):
                n = min(end - begin, PIECE)
                pieces.setdefault(n, []).append((int(char_hashes(points(text[begin : begin + n]), n)[0]), k, begin))
        for n, by in found.items():
            order = sorted(by)
            self.short[int(n)] = np.array(order, np.uint64), [by[h] for h in order]
        for n, rows in pieces.items():
            rows.sort()
            self.pieces[n] = np.array([h for h, _, _ in rows], np.uint64), np.array([k for _, k, _ in rows]), np.array([o for _, _, o in rows])

    def find_short(self, words: Words) -> Iterator[tuple[int, int, int, int, int]]:
        """First exact place of each item of few words in each text."""
        for n, (hashes, items) in self.short.items():
            if len(words.hashes) < n:
                continue
            runs = run_hashes(words.hashes, n)
            at = np.minimum(np.searchsorted(hashes, runs), len(hashes) - 1)
            hits = np.flatnonzero(hashes[at] == runs)
            text = np.searchsorted(words.at, hits, "right") - 1
            seen = set()
            for w, t in zip(hits.tolist(), text.tolist()):
                if w + n > words.at[t + 1]:
                    continue
                for k in items[at[w]]:
                    if (t, k) not in seen and words.text(w, w + n) == self.texts[k]:
                        seen.add((t, k))
                        yield t, k, 0, w, w + n

    def find_edited(self, words: Words) -> Iterator[tuple[int, int, int, int, int]]:
        """Best place of each item of few words in each text, with edits."""
        if not self.pieces or not len(words.hashes):
            return
        texts = [words.text(a, b) for a, b in zip(words.at[:-1], words.at[1:])]
        bounds = np.cumsum([0, *(len(t) + 1 for t in texts)])
        chars = points("\n".join(texts) + "\n")  # no word holds the sign between texts
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for n, (hashes, items, offsets) in self.pieces.items():
            held = np.zeros(1 << 16, bool)
            held[(hashes >> np.uint64(48)).astype(np.int64)] = True
            runs = char_hashes(chars, n)
            hits = np.flatnonzero(held[(runs >> np.uint64(48)).astype(np.int64)])
            low, high = (np.searchsorted(hashes, runs[hits], side) for side in ("left", "right"))
            # about HITS places at once, all of one hit at least
            block = (np.cumsum(high - low) - 1) // HITS
            for part in np.split(np.arange(len(hits)), np.flatnonzero(np.diff(block)) + 1):
                times = (high - low)[part]
                of = np.repeat(part, times)
                entry = np.arange(len(of)) - np.repeat(np.cumsum(times) - times, times) + low[of]
                begin, item = hits[of] - offsets[entry], items[entry]
                text = np.searchsorted(bounds, hits[of], "right") - 1
                order = np.argsort(item, kind="stable")
                for own in np.split(order, np.flatnonzero(np.diff(item[order])) + 1):
                    if len(own):
                        self._check(chars, bounds, text[own], begin[own], int(item[own[0]]), best)
        for (t, k), (edits, end) in best.items():
            # words from the one that the place begins in to the one that it ends in; a lower case letter has a place of its own nearly always
            starts = np.concatenate([[0], np.cumsum(words.plain[words.offset[words.at[t]] : words.offset[words.at[t + 1]]] & 0xC0 != 0x80)])
            starts = starts[words.offset[words.at[t] : words.at[t + 1]] - words.offset[words.at[t]]]
            last = max(1, int(np.searchsorted(starts, end - bounds[t], "left")))
            first = max(0, int(np.searchsorted(starts, max(0, end - bounds[t] - len(self.texts[k]) + edits), "right")) - 1)
            yield t, k, edits, int(words.at[t]) + min(first, last - 1), int(words.at[t]) + last

    def _check(self, chars: np.ndarray, bounds: np.ndarray, text: np.ndarray, begin: np.ndarray, k: int, best: dict[tuple[int, int], tuple[int, int]]) -> None:
        """Keep the fewest edits, and where they end, of item ``k`` around some places."""
        most, size = self.most[k], len(self.texts[k])
        seen = np.unique(np.stack([text, begin]), axis=1)
        if size > LONG:
            for t, at in seen.T.tolist():
                lo, hi = max(int(bounds[t]), at - most), min(int(bounds[t + 1]) - 1, at + size + most)
                part = chars[lo:hi].tobytes().decode("utf-32-le")
                found = edit_distance_within(self.texts[k], part, most)
                if found is not None and found < best.get((t, k), (most + 1,))[0]:
                    best[t, k] = found, min(hi, max(lo, at) + size)
            return
        places = (seen[1] - most)[:, None] + np.arange(size + 2 * most)
        inside = (places >= bounds[seen[0]][:, None]) & (places < bounds[seen[0] + 1][:, None] - 1)
        rows = np.where(inside, chars[np.clip(places, 0, len(chars) - 1)], 0)
        edits, end = fewest_edits(points(self.texts[k]), rows)
        for i in np.flatnonzero(edits <= most).tolist():
            t, at = int(seen[0][i]), int(min(places[i, 0] + end[i], bounds[seen[0][i] + 1] - 1))
            if edits[i] < best.get((t, k), (most + 1,))[0]:
                best[t, k] = int(edits[i]), at

    def windows(self, words: Words) -> np.ndarray:
        """Different windows (text, first word, words of the item) that are aligned with an item."""
        hits = np.flatnonzero(self.filter[(words.runs >> np.uint64(44)).astype(np.int64)])
        text = np.searchsorted(words.at, hits, "right") - 1
        same = hits + RUN <= words.at[text + 1]  # the run stays within its text
        hits, text = hits[same], text[same]
        low, high = (np.searchsorted(self.h, words.runs[hits], side) for side in ("left", "right"))
        times = high - low
        of = np.repeat(np.arange(len(hits)), times)
        entry = np.arange(len(of)) - np.repeat(np.cumsum(times) - times, times) + low[of]
        begin = hits[of] - self.offset[entry] - words.at[text[of]]  # may lie before the text
        longest, most = int(self.sizes.max()), int(words.at[-1]) + 2 * int(self.sizes.max()) + 2
        packed, votes = np.unique((text[of] * most + begin + longest) * (longest + 1) + self.sizes[self.item[entry]], return_counts=True)
        packed = packed[votes >= VOTES]
        place, size = packed // (longest + 1), packed % (longest + 1)
        text = place // most
        first = np.maximum(place % most - longest, 0) + words.at[text]
        return np.stack([text, first, size], 1)

    def find(self, words: Words) -> list[tuple[int, int, int, int, int]]:
        """(text, item, edits, first word, one past the last word) of the best place of each item in each text."""
        few = [*self.find_short(words), *self.find_edited(words)]
        if not len(self.h) or len(words.hashes) < RUN:
            return sorted(few)
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        windows = self.windows(words)
        for a in range(0, len(windows), 8192):
            text, first, size = windows[a : a + 8192].T
            count = np.minimum(size, words.at[text + 1] - first)
            key = keys(words, first, count, size).ravel()
            low, high = (np.searchsorted(self.keys, key, side) for side in ("left", "right"))
            hit = np.flatnonzero(high > low)
            times = (high - low)[hit]
            of = np.repeat(hit, times)
            entry = np.arange(len(of)) - np.repeat(np.cumsum(times) - times, times) + low[of]
            pairs, agree = np.unique(of // (WALKS * SAMPLES) * len(self.ids) + self.owner[entry], return_counts=True)
            for w, k in zip(*(x.tolist() for x in divmod(pairs[agree >= AGREE], len(self.ids)))):
                t, f, n = int(text[w]), int(first[w]), int(count[w])
                if best.get((t, k), (1,))[0] == 0:
                    continue
                around = max(2, n // 5 + 1)
                lo, hi = max(words.at[t], f - around), min(words.at[t + 1], f + n + around)
                edits = edit_distance_within(self.texts[k], words.text(lo, hi), self.most[k])
                if edits is not None and edits < best.get((t, k), (1 << 60,))[0]:
                    best[t, k] = (edits, f, f + n)
        return sorted([*few, *((t, k, *found) for (t, k), found in best.items())])


def blocks(benchmark: DataFrame, similarity: float, whole: bool = False) -> Iterator[Index]:
    """Indexes of the benchmark, each of about ``PASS_BYTES`` of text."""
    rows = benchmark.select(column(benchmark, "item_id", "long").alias("item_id"), column(benchmark, "text", "string").alias("text")).filter("text is not null")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // PASS_BYTES))
    for k in range(n):
        part = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield Index(sorted((((-1 if r[0] is None else r[0]), r[1]) for r in part.collect())), similarity, whole)


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, whole: bool = False) -> DataFrame:
    """One row for each document row and item that it holds.

    Columns: doc_id, item_id, edits, similarity, first_byte and last_byte (of the
    window's place in the UTF-8 text, the last one left out). ``whole`` searches items of few words with edits and whatever their length.
    """
    spark = docs.sparkSession
    rows = docs.select(column(docs, "doc_id", "long").alias("doc_id"), column(docs, "text", "string").alias("text"))
    out = None
    for index in blocks(benchmark, similarity, whole):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = shared.value
            for batch in in_slices(batches, "text", 4 << 20):
                flat, bounds = utf8(batch.column("text"))
                words = Words(flat, bounds)
                found = own.find(words)
                if found:
                    t, k, edits, first, last = (list(x) for x in zip(*found))
                    yield pa.RecordBatch.from_arrays([
                        batch.column("doc_id").take(pa.array(t)), pa.array([own.ids[i] for i in k], pa.int64()), pa.array(edits, pa.int64()),
                        pa.array([1 - e / len(own.texts[i]) for e, i in zip(edits, k)], pa.float64()),
                        pa.array(words.starts[first] - bounds[t], pa.int64()), pa.array(words.ends[np.array(last) - 1] - bounds[t], pa.int64()),
                    ], ["doc_id", "item_id", "edits", "similarity", "first_byte", "last_byte"])

        part = rows.mapInArrow(run, "doc_id long, item_id long, edits long, similarity double, first_byte long, last_byte long")
        out = part if out is None else out.union(part)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, whole: bool = False) -> DataFrame:
    """The rows of ``docs`` that hold no item; all columns stay. ``whole`` as in ``contaminated``."""
    spark = docs.sparkSession
    place = next((i for i, c in enumerate(docs.columns) if c.lower() == "text"), None)
    if place is None:
        return docs
    name = docs.columns[place]
    for index in blocks(benchmark, similarity, whole):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = shared.value
            for batch in in_slices(batches, name, 4 << 20):
                held = {t for t, *_ in own.find(Words(*utf8(batch.column(place))))}
                yield batch.filter(pa.array([i not in held for i in range(batch.num_rows)]))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
