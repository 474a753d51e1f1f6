"""BPE encoding and decoding by a backtracking encoder.

Merging pair by pair is replaced by a left-to-right walk over one word: an
Aho-Corasick pass finds the longest token at each position, and a token is kept
if the merges could not have joined it with the one before it otherwise. That
test only looks at the two tokens, so it is answered from a table of split
tokens and of merged pairs. A dead end goes back one token and takes the next
shorter one; positions found dead are never tried again, so the walk is linear.

Null and empty texts have no tokens. Texts are encoded whole.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poolwright.llm.common import column, in_slices

END = "</w>"
#: The last symbol of a word carries the word end; it is kept as one symbol by this shift.
SHIFT = 0x10000
#: White space as the tokenizer's regular expressions see it.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


# Letters and digits of Unicode 16, which Python's own tables do not have yet.
UNICODE_16 = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D40, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x113D3), (0x116D0, 0x116E3), (0x11BC0, 0x11BE0), (0x11BF0, 0x11BF9), (0x13460, 0x143FA), (0x16100, 0x16139), (0x16D40, 0x16D79),
    (0x18CFF, 0x18CFF), (0x1CCF0, 0x1CCF9), (0x1E5D0, 0x1E5FA),
)


def later_letters() -> str:
    """Letters and digits of the pattern library that are newer than Unicode 16; to the tokenizer they are signs."""
    every = "".join(map(chr, [*range(0x80, 0xD800), *range(0xE000, 0x110000)]))
    found = (c for c in regex.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(c) == "Cn")
    return "".join(c for c in found if not any(a <= ord(c) <= b for a, b in UNICODE_16))


LATER = later_letters()
#: Neither these letters nor the ones below come before this sign, so most texts need not be searched for them.
RARE = re.compile(f"[{min(LATER)}-\U0010ffff]")
HAS_LATER = re.compile(f"[{LATER}]")
PIECES = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{WHITE}\p{{L}}\p{{N}}]+")
#: The same with later letters as signs; slower.
PIECES_LATER = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}--[{LATER}]]+|[\p{{N}}--[{LATER}]]|[[^{WHITE}\p{{L}}\p{{N}}]||[{LATER}]]+", regex.V1)
# Letters whose lower case is newer than Python's tables.
LOWER = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
LOWER |= {c: c + 0x20 for c in range(0x10D50, 0x10D66)} | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}
#: Words kept with their tokens; beyond it the table starts anew.
WORDS_KEPT = 200_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    kept = set(plain)
    return [chr(b) if b in kept else chr(next(others)) for b in range(256)]


def load(path: str) -> tuple[list[str], list[tuple[str, str]], list[tuple[str, int]]]:
    """Tokens by id, merges in order and special tokens of a tokenizer file."""
    with open(path, encoding="utf-8") as f:
        data = json.load(f)
    model = data["model"]
    special = [(t["content"], t["id"]) for t in data.get("added_tokens", [])]
    tokens = [""] * (1 + max([*model["vocab"].values(), *(i for _, i in special)]))
    for token, i in [*model["vocab"].items(), *special]:
        tokens[i] = token
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    return tokens, merges, special


def _symbols(token: str) -> str:
    """A token as symbols: the word end folded into the symbol before it."""
    if token.endswith(END) and len(token) > len(END):
        token = token.removesuffix(END)
        return token[:-1] + chr(ord(token[-1]) + SHIFT)
    return token


class Encoder:
    """Exact merges of one vocabulary."""

    def __init__(self, tokens: list[str], merges: list[tuple[str, str]], special: list[tuple[str, int]]) -> None:
        names = {i for _, i in special}
        words = {_symbols(t): i for i, t in enumerate(tokens) if t and i not in names}
        self.rank: dict[tuple[int, int], int] = {}
        made: dict[int, int] = {}
        self.split = [(i, i) for i in range(len(tokens))]
        self.order = [-1] * len(tokens)
        for n, (a, b) in enumerate(merges):
            left, right, both = words[a], words[_symbols(b)], words[_symbols(a + b)]
            self.rank.setdefault((left, right), n)
            if both not in made:
                made[both] = n
                self.split[both] = (left, right)
                self.order[both] = n
        self.size = [len(_symbols(t)) for t in tokens]
        self.shorter = [-1] * len(tokens)
        self.matcher = ahocorasick.Automaton()
        for word, i in words.items():
            self.shorter[i] = next((words[word[:n]] for n in range(len(word) - 1, 0, -1) if word[:n] in words), -1)
            self.matcher.add_word(word, (len(word), i))
        self.matcher.make_automaton()
        # Decoding: all tokens in one text, and where each begins and ends.
        joined = [t.encode() for t in tokens]
        self.text = b"".join(joined)
        self.offsets = np.cumsum([0, *map(len, joined)]).tolist()
        self.special = dict(special)
        self.around = re.compile("|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True)))
        self.bytes = byte_symbols()
        self.known: dict[str, tuple[int, bytes, bytes]] = {}
        self.agreed: dict[tuple[int, int], bool] = {}

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging leaves the two tokens side by side.

        The two are taken apart in the reverse order of their merges; they are
        incompatible if at some moment the pieces that touch merge earlier than
        what had still to be merged inside them.
        """
        found = self.agreed.get((left, right))
        if found is None:
            found = self.agreed[left, right] = self._apart(left, right)
        return found

    def _apart(self, left: int, right: int) -> bool:
        order, split, rank = self.order, self.split, self.rank
        before, first = 1 << 60, True  # merges of the touching pieces count if they come before this one
        while True:
            n = rank.get((left, right))
            if n is not None and (n < before or (n == before and first)):
                return False
            if order[left] < 0 and order[right] < 0:
                return True
            if order[left] > order[right]:  # of equal merges the left one comes first, so the right one is undone first
                before, first = order[left], False
                left = split[left][1]
            else:
                before, first = order[right], True
                right = split[right][0]

    def word(self, symbols: str) -> list[int]:
        """Tokens of one word of symbols."""
        n = len(symbols)
        longest = [-1] * n
        most = [0] * n
        for end, (size, token) in self.matcher.iter(symbols):
            start = end - size + 1
            if size > most[start]:
                most[start], longest[start] = size, token
        alive = [True] * (n + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        size, shorter, compatible = self.size, self.shorter, self.compatible
        while at < n:
            while token >= 0 and not (alive[at + size[token]] and (not out or compatible(out[-1], token))):
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at += size[token]
                token = longest[at] if at < n else -1
            else:
                alive[at] = False
                token = out.pop()
                at -= size[token]
        return out

    def piece(self, piece: str) -> tuple[int, bytes, bytes]:
        """Number of tokens, packed ids and decoded text of one piece of a text."""
        table = self.bytes
        symbols = "".join([table[b] for b in piece.encode("utf-8", "replace")])
        return self.packed(self.word(symbols[:-1] + chr(ord(symbols[-1]) + SHIFT)))

    def packed(self, ids: list[int]) -> tuple[int, bytes, bytes]:
        text, offsets = self.text, self.offsets
        decoded = b" ".join([text[offsets[i] : offsets[i + 1]] for i in ids])
        return len(ids), np.array(ids, "<u4").tobytes(), decoded

    def pieces(self, text: str) -> Iterator[str | int]:
        """Pieces of a text in order; special tokens as their ids."""
        at = 0
        parts = []
        for m in self.around.finditer(text) if self.special else ():
            parts += [text[at : m.start()], self.special[m[0]]]
            at = m.end()
        for part in [*parts, text[at:]]:
            if isinstance(part, int):
                yield part
            else:
                # lower case letter by letter: a final sigma is a sigma here
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                pieces = PIECES
                if not part.isascii() and RARE.search(part):
                    part = part.translate(LOWER)
                    pieces = PIECES_LATER if HAS_LATER.search(part) else PIECES
                yield from pieces.findall(part)

    def document(self, text: str) -> tuple[int, bytes, bytes]:
        """Number of tokens, packed ids and decoded text of a whole text."""
        known, found = self.known, []
        for piece in self.pieces(text):
            if isinstance(piece, int):
                found.append(self.packed([piece]))
                continue
            tokens = known.get(piece)
            if tokens is None:
                if len(known) >= WORDS_KEPT:
                    known.clear()
                tokens = self.piece(piece)
                if len(piece) <= 64:
                    known[piece] = tokens
            found.append(tokens)
        if not found:
            return 0, b"", b""
        counts, ids, decoded = zip(*found)
        return sum(counts), b"".join(ids), b" ".join(decoded)

    def ids(self, text: str) -> list[int]:
        return np.frombuffer(self.document(text)[1], "<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        """Tokens as text: a vocabulary without a decoder sets one space between tokens."""
        return self.packed(ids)[2].decode("utf-8")


@lru_cache(maxsize=2)
def _encoder(digest: str, source: _Source) -> Encoder:
    return Encoder(*source.tables.value)


class _Source:
    """Broadcast tables of a vocabulary; equal for equal files."""

    def __init__(self, digest: str, tables: object) -> None:
        self.digest, self.tables = digest, tables

    def __hash__(self) -> int:
        return hash(self.digest)

    def __eq__(self, other: object) -> bool:
        return isinstance(other, _Source) and self.digest == other.digest

    def encoder(self) -> Encoder:
        return _encoder(self.digest, self)


def source(spark, path: str) -> _Source:
    """The vocabulary at ``path`` of the driver; a vocabulary is a few MB."""
    with open(path, "rb") as f:
        digest = hashlib.sha256(f.read()).hexdigest()
    return _Source(digest, spark.sparkContext.broadcast(load(path)))


def encode(docs: DataFrame, path: str, text: str = "text", full: bool = True) -> DataFrame:
    """One row per row of ``docs``: its ``doc_id``, token count, ids and decoded text.

    ``full=False`` returns digests in place of ids and decoded text, which keeps rows small.
    """
    made = source(docs.sparkSession, path)
    kinds = "ids binary, decoded string" if full else "ids_sha256 string, decoded_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = made.encoder()
        for batch in in_slices(batches, "text", 4 << 20):
            n, ids, decoded = zip(*[encoder.document(t or "") for t in batch.column("text").to_pylist()])
            if full:
                rest = [pa.array(ids, pa.binary()), pa.array([d.decode() for d in decoded], pa.string())]
            else:
                rest = [pa.array([hashlib.sha256(x).hexdigest() for x in part], pa.string()) for part in (ids, decoded)]
            names = ["doc_id", "n_tokens", *[k.split()[0] for k in kinds.split(", ")]]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), *rest], names)

    rows = docs.select(column(docs, "doc_id", "long").alias("doc_id"), column(docs, text, "string").alias("text"))
    return rows.mapInArrow(run, f"doc_id long, n_tokens long, {kinds}")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Digest of the tokens and of the decoded text of every row."""
    return encode(docs, path, full=False).select("doc_id", F.col("n_tokens"), "ids_sha256", "decoded_sha256")
