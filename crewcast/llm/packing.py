"""Packing token pieces into sequences by exact complements.

1. Texts are tokenised in Spark tasks; only (document, piece, start, length, checksum) goes on.
2. The number of pieces of each length (at most ``capacity`` numbers, whatever the data) is planned on the
   driver: a gap is filled exactly by one, two or three lengths found by their sum, as often as counts allow;
   what has no exact complement is packed best-fit. A plan line is a pattern of lengths and how often it is used.
3. Pieces are numbered within their length by a sliced window, and a piece's number gives its sequence and offset.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from crewcast.llm.storage import stored

#: Pieces that one slice of a length holds at most on average.
SLICE_ROWS = 50_000
#: A worker forgets its word ids when it knows this many words.
MOST_WORDS = 400_000
#: Latin letters, digits and white space, whose classes do not differ between Unicode versions.
LETTERS, DIGITS, SPACES = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾", "\\t-\\r \\x85\\xa0"
WORD = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{DIGITS}]+| ?[^{SPACES}{LETTERS}{DIGITS}]+"
                  rf"|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")
PLAIN = re.compile(r"[\x00-ɏ]*\Z")
#: Byte-level models spell a byte that is no visible Latin-1 character as the next letter from U+0100 on.
BYTE_LETTERS = dict(zip([*range(0x21), *range(0x7F, 0xA1), 0xAD], range(0x100, 0x144)))


class Ids(dict):
    """Little-endian uint32 ids of a text, by the tokenizer of a file. Words of Latin texts are looked up once.

    The file's tokenizer splits a text into words before it encodes them, so a text's ids are those of its words. A word
    goes to the tokenizer's model at once, its bytes spelled as the model's letters. Texts with other letters, and texts
    that hold one of the tokenizer's added tokens, go to the tokenizer whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        added = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added)) or r"(?!)")
        self.encode = lambda text: array("I", tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        self.model = tokenizer.model

    def __missing__(self, word: str) -> bytes:
        if len(self) >= MOST_WORDS:
            self.clear()
        letters = word.replace(" ", "Ġ") if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(BYTE_LETTERS)
        ids = array("I", [token.id for token in self.model.tokenize(letters)]).tobytes()
        if len(word) < 40:
            self[word] = ids
        return ids

    def of(self, text: str) -> bytes:
        if PLAIN.match(text) and not self.added.search(text):
            return b"".join(map(self.__getitem__, WORD.findall(text)))
        return self.encode(text)


_loaded: dict[str, Ids] = {}


def tokens_of(path: str) -> Ids:
    if path not in _loaded:
        _loaded[path] = Ids(path)
    return _loaded[path]


def cut(count: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``count`` ids; only the first may be shorter than ``capacity``."""
    first = count % capacity
    starts = ([0] if first else []) + list(range(first, count, capacity))
    return [(s, first if first and s == 0 else capacity) for s in starts]


def pieces(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id",
           text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32 and, if asked for, the ids. A null text is empty."""
    end = array("I", [end_id]).tobytes()

    def tokenise(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = tokens_of(path)
        for frame in frames:
            rows = []
            for key, text in zip(frame["id"], frame["text"]):
                data = ids.of(text or "") + end
                for number, (start, length) in enumerate(cut(len(data) // 4, capacity)):
                    part = data[4 * start : 4 * (start + length)]
                    rows.append((key, number, start, length, zlib.crc32(part)) + ((np.frombuffer(part, "<u4").astype("i4"),) if keep_ids else ()))
            names = ["id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
            out = pd.DataFrame(rows, columns=names)
            yield out.assign(id=out["id"].astype(frame["id"].dtype))

    # Keys travel as text, so any type and nulls pass through unchanged.
    kind = docs.schema[id_col].dataType
    schema = "id string, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    rows = docs.select(docs[id_col].cast("string").alias("id"), docs[text_col].alias("text")).mapInPandas(tokenise, schema)
    return rows.withColumn("id", F.col("id").cast(kind))


def plan(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of one sequence, number of such sequences), using every piece once.

    Exact fills with more pieces use up the short lengths that best-fit would need, so the plan is made
    for each (most pieces in a gap, one pass per number of pieces or one for all) and the shortest is kept.
    """
    tries = [_plan(counts, capacity, most, together) for most in (1, 2, 3) for together in (False, True)]
    return min(tries, key=lambda lines: sum(times for _, times in lines))


def _plan(counts: dict[int, int], capacity: int, most: int, together: bool) -> list[tuple[tuple[int, ...], int]]:
    """From the longest length down, its gap is looked up among single lengths, pair sums and triple sums.

    What remains is packed best-fit: the longest piece, then the longest that still fits.
    """
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, count in counts.items():
        left[length] += count
    lines: list[tuple[tuple[int, ...], int]] = []

    def use(*pattern: int) -> None:
        """Take the pattern as often as the counts allow."""
        need = {x: pattern.count(x) for x in pattern}
        times = min(int(left[x]) // n for x, n in need.items())
        if times > 0:
            for x, n in need.items():
                left[x] -= n * times
            lines.append((pattern, times))

    def pairs(total: int, least: int) -> list[int]:
        """The shorter lengths of available pairs with this sum, longest first."""
        short = np.arange(least, total // 2 + 1)
        return short[(left[short] > 0) & (left[total - short] > 0)][::-1].tolist() if len(short) else []

    def fill(length: int, pieces: int) -> None:
        gap = capacity - length
        if gap == 0:
            use(length)
        elif pieces == 1:
            use(length, gap)
        elif pieces == 2:
            for b in pairs(gap, 1):
                use(length, gap - b, b)
        else:
            for c in np.flatnonzero(left[: gap // 3 + 1]).tolist():
                if not left[length]:
                    return
                for b in pairs(gap - c, c):
                    use(length, gap - c - b, b, c)

    steps = range(1, most + 1)
    order = [(n, p) for n in range(capacity, 0, -1) for p in steps] if together else [(n, p) for p in steps for n in range(capacity, 0, -1)]
    for length, pieces in order:
        if left[length]:
            fill(length, pieces)
    while left.any():
        pattern, room, free = [], capacity, left.copy()
        while len(fits := np.flatnonzero(free[: room + 1])):
            pattern.append(int(fits[-1]))
            free[fits[-1]] -= 1
            room -= pattern[-1]
        use(*pattern)
    return lines


class Places:
    """Sequence and offset of the n-th piece of a length, read off the plan."""

    def __init__(self, lines: list[tuple[tuple[int, ...], int]]):
        found: dict[int, list[tuple[int, int, int]]] = {}
        first = 0
        for pattern, times in lines:
            for length, offset in zip(pattern, accumulate((0,) + pattern)):
                found.setdefault(length, []).append((times, first, offset))
            first += times
        self.sequences = first
        self.runs = {}
        for length, runs in found.items():
            times, firsts, offsets = (np.array(x, dtype=np.int64) for x in zip(*runs))
            self.runs[length] = (np.cumsum(times) - times, firsts, offsets)

    def of(self, length: int, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts, firsts, offsets = self.runs[length]
        run = np.searchsorted(starts, number, "right") - 1
        return firsts[run] + number - starts[run], offsets[run]


def pack(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id",
         text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """One row per piece with its sequence_id and offset; sequences are gapless and hold at most ``capacity`` ids.

    A document is its ids and then ``end_id``; only documents longer than ``capacity`` are cut. A null or empty
    text is the end id alone. Rows with one id are packed each for itself. An empty table gives no rows.
    """
    rows = stored(pieces(docs, path, capacity, end_id, id_col, text_col, keep_ids))
    counts = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}  # at most ``capacity`` rows
    places = Places(plan(counts, capacity))

    slices = F.array(*[F.lit(-(-counts.get(n, 0) // SLICE_ROWS) or 1) for n in range(1, capacity + 1)])
    key = F.xxhash64("id", "piece", "ids_crc32")
    rows = rows.withColumn("slice", F.pmod(key, F.element_at(slices, F.col("length").cast("int"))))
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("length", "slice").count().select(
        "length", "slice", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("length", "slice").orderBy("id", "piece", "ids_crc32")
    rows = rows.withColumn("at", F.row_number().over(inside)).join(starts, ["length", "slice"])
    rows = rows.withColumn("number", F.col("first") + F.col("at") - 1).drop("slice", "first", "at")

    names = ["id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids

    def placed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sequence, offset = np.zeros(len(frame), np.int64), np.zeros(len(frame), np.int64)
            lengths, numbers = frame["length"].to_numpy(), frame["number"].to_numpy()
            for length in np.unique(lengths):
                here = lengths == length
                sequence[here], offset[here] = places.of(int(length), numbers[here])
            yield frame[names].assign(sequence_id=sequence, offset=offset)

    kind = docs.schema[id_col].dataType
    schema = "id string, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids + ", sequence_id long, offset long"
    out = rows.withColumn("id", F.col("id").cast("string")).mapInPandas(placed, schema)
    return out.withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id_col)
