"""Fill-in-the-middle transformation of texts, cut by rank in an indexable skip list.

A text is a list of units (code points, words or lines). The skip list has one node a
unit; each link of a lane carries how many units and how many code points it spans. The place of
a cut is found from the top lane down: a link is followed while the units so far do not
exceed the wanted rank, and the code points so far are the place in the text. So a cut
between any two units is reached without a walk over the text, and both widths stay exact
whatever the units' lengths.

Which node stands in which lane follows from its number alone, so equal texts give equal lists on
every executor. A row is settled by itself: null texts are empty, null ids give the digest of an
empty id, repeated rows are alike, and an empty table gives no rows. Other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poolwright.llm.common import column, in_slices, mixed

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: What a unit is: runs of code points that cover a text from left to right; None stands for single code points.
UNITS: dict[str, str | None] = {"point": None, "word": r"\s*\S+\s*?(?=\s|$)|\s+$", "line": r"[^\n]*\n|[^\n]+$"}
#: Of so many nodes of a lane one stands in the lane above.
FAN = 8


@lru_cache(maxsize=2)
def _heights(size: int) -> np.ndarray:
    """Lanes above the lowest in which the nodes 1..size stand."""
    draws = mixed(np.arange(1, size + 1, dtype=np.uint64))
    out = np.zeros(size, np.int8)
    while (draws % np.uint64(FAN) == 0).any():
        up = draws % np.uint64(FAN) == 0
        out += up
        draws = np.where(up, draws // np.uint64(FAN), np.uint64(1))
    return out


@lru_cache(maxsize=64)
def _lane(size: int, height: int) -> np.ndarray:
    """Numbers of the nodes of one lane, the head (0) first."""
    return np.concatenate([[0], np.flatnonzero(_heights(size) >= height) + 1])


def lane_nodes(n: int, height: int) -> np.ndarray:
    """Nodes of a lane of a list of ``n`` units; lists of usual length share one drawing."""
    bits = max(14, n.bit_length())
    drawn = _lane(1 << bits, height) if bits <= 20 else np.concatenate([[0], np.flatnonzero(_heights.__wrapped__(n) >= height) + 1])
    return drawn[: np.searchsorted(drawn, n, "right")]


class SkipList:
    """Units of one text by their number; ``widths`` are their code points."""

    def __init__(self, widths: np.ndarray) -> None:
        self.n = len(widths)
        ends = np.concatenate([[0], np.cumsum(widths, dtype=np.int64)])
        #: per lane, lowest first: units and code points of the link that leaves each node, and the node's place in the lane below
        self.lanes: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        nodes, height = np.arange(self.n + 1), 0
        while True:
            below = nodes if not self.lanes else np.searchsorted(previous, nodes)
            self.lanes.append((np.diff(nodes), np.diff(ends[nodes]), below))
            height += 1
            previous, nodes = nodes, lane_nodes(self.n, height)
            if len(nodes) < 2:
                return

    def place(self, rank: int) -> int:
        """Code points before the unit ``rank``, by accumulated widths from the top lane down."""
        at = units = points = 0
        for height in range(len(self.lanes) - 1, -1, -1):
            by_units, by_points, below = self.lanes[height]
            while at < len(by_units) and units + by_units[at] <= rank:
                units += int(by_units[at])
                points += int(by_points[at])
                at += 1
            at = int(below[at])
        return points


def unit_widths(text: str, unit: str) -> np.ndarray:
    """Code points of every unit; they add up to the text."""
    pattern = UNITS[unit]
    if pattern is None:
        return np.ones(len(text), np.int64)
    starts = [m.start() for m in regex.finditer(pattern, text) if m.end() > m.start()]
    if not starts:
        return np.full(1 if text else 0, len(text), np.int64)
    starts[0] = 0  # what stands between two matches belongs to the unit before it
    return np.diff([*starts, len(text)])


def draws(doc_id: int | None, seed: str) -> tuple[int, int, int, int]:
    """Four numbers of 32 bits that follow from the seed and the id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[4 * k : 4 * k + 4], "big") for k in range(4))


def arrange(text: str, doc_id: int | None, unit: str = "point", seed: str = "1", rate: int = 90, spm_rate: int = 20) -> tuple[int, str, str, int | None, int | None]:
    """Units, form, output, and code points of prefix and middle (None if the text stays as it is)."""
    widths = unit_widths(text, unit)
    n = len(widths)
    one, two, choice, order = draws(doc_id, seed)
    if not text or choice % 100 >= rate or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", text, None, None
    units = SkipList(widths)
    first, second = (units.place(rank) for rank in sorted((one % (n + 1), two % (n + 1))))
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if order % 100 < spm_rate:
        return n, "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}", first, second - first
    return n, "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}", first, second - first


def restore(output: str, form: str) -> str:
    """The text that ``arrange`` was given."""
    if form == "plain":
        return output
    a, b = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    head, _, middle = output.partition(MIDDLE)
    one, _, two = head.removeprefix(a).partition(b)
    prefix, suffix = (one, two) if form == "psm" else (two, one)
    return prefix + middle + suffix


KINDS = {
    "n": pa.int64(), "form": pa.string(), "prefix_chars": pa.int64(), "middle_chars": pa.int64(),
    "output": pa.string(), "output_sha256": pa.string(), "restored_sha256": pa.string(),
}


def transform(docs: DataFrame, text: str = "text", unit: str = "point", seed: str = "1", rate: int = 90, spm_rate: int = 20, full: bool = True) -> DataFrame:
    """One row per row of ``docs``: doc_id, units ``n``, form, code points of prefix and middle, and the output.

    Of 100 texts ``rate`` are cut, of 100 cut ones ``spm_rate`` put the suffix first. A text that is empty or
    holds a mark stays plain. ``full=False`` returns digests of the output and of the text
    restored from it in place of the output, which keeps rows small.
    """
    names = ["n", "form", "prefix_chars", "middle_chars", *(["output"] if full else ["output_sha256", "restored_sha256"])]

    def digest(value: str) -> str:
        return hashlib.sha256(value.encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, "text", 4 << 20):
            out = []
            for doc_id, value in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                n, form, output, prefix, middle = arrange(value or "", doc_id, unit, seed, rate, spm_rate)
                out.append((n, form, prefix, middle, *((output,) if full else (digest(output), digest(restore(output, form))))))
            columns = [pa.array(values, KINDS[name]) for name, values in zip(names, zip(*out))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *names])

    rows = docs.select(column(docs, "doc_id", "long").alias("doc_id"), column(docs, text, "string").alias("text"))
    schema = ", ".join(f"{name} {'string' if KINDS[name] == pa.string() else 'long'}" for name in names)
    return rows.mapInArrow(run, f"doc_id long, {schema}")


def digests(docs: DataFrame) -> DataFrame:
    """Cuts between code points: counts, form and digests of every row."""
    return transform(docs, full=False).select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


def _draw(k: int) -> str:
    return f"CAST('0x' || SUBSTR(digest, {8 * k + 1}, 8) AS BIGINT)"


DOCUMENTS_SQL = f"""
WITH drawn AS (SELECT doc_id, COALESCE(text, '') AS text, LENGTH(COALESCE(text, '')) AS n, SHA256('1:' || COALESCE(CAST(doc_id AS VARCHAR), '')) AS digest FROM documents),
cut AS (SELECT *, LEAST({_draw(0)} % (n + 1), {_draw(1)} % (n + 1)) AS a, GREATEST({_draw(0)} % (n + 1), {_draw(1)} % (n + 1)) AS b,
  CASE WHEN n = 0 OR CONTAINS(text, '{PREFIX}') OR CONTAINS(text, '{SUFFIX}') OR CONTAINS(text, '{MIDDLE}') OR {_draw(2)} % 100 >= 90 THEN 'plain'
       WHEN {_draw(3)} % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (SELECT *, SUBSTRING(text, 1, a) AS prefix, SUBSTRING(text, a + 1, b - a) AS middle, SUBSTRING(text, b + 1) AS suffix FROM cut)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(a AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(b - a AS BIGINT) END AS middle_chars,
  SHA256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '{PREFIX}' || prefix || '{SUFFIX}' || suffix || '{MIDDLE}' || middle
         ELSE '{SUFFIX}' || suffix || '{PREFIX}' || prefix || '{MIDDLE}' || middle END) AS output_sha256, SHA256(text) AS restored_sha256
FROM parts"""
