"""Near duplicates with SetSketch registers.

1. A text's set of word shingles is sketched: a register holds the minimum of exponentially distributed hash
   values on an exponential scale, cut off at both ends. Registers of two sets merge by taking the maximum.
2. Texts with equal sets form one class; only its smallest document goes on.
3. Groups of registers (bands) give bucket keys. Every member of a bucket is compared with the bucket's smallest
   document; linked documents form components. Pairs inside a component need no comparison, so a bucket of near
   copies costs one comparison each. Members that this leaves outside the component of the smallest document
   are compared with the documents of other components in their buckets, block by block inside the tasks.
4. A pair is estimated from its registers by maximum likelihood, and verified on the full sets if the
   estimate is not far below the threshold.

With 30 bands of 5 registers a pair exactly at 0.8 is missed with probability 7e-6, at 0.85 with 2e-8. The estimate's
standard deviation at 0.8 is 0.033, and pairs are let through from 0.18 below the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from crewcast.llm.components import connected
from crewcast.llm.storage import numbered, partitions, small, stored
from crewcast.llm.texts import STEP, mix, shingle_sets


#: Nodes of one bucket that a task compares with each other.
BLOCK = 512
#: Shingle hashes that are compared at once there.
COLUMNS = 4_096


@dataclass(frozen=True)
class Sketch:
    """Register scale: values a * b^-k for k up to q; ``bands`` groups of ``rows`` registers."""

    bands: int = 30
    rows: int = 5
    base: float = 1.001
    rate: float = 20.0
    limit: int = 65534

    @property
    def size(self) -> int:
        return self.bands * self.rows


def _multipliers(count: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * count + 1, dtype=np.uint64) * STEP).astype(np.uint32) | np.uint32(1)
    return seeds[:count], seeds[count:]


def registers(sets: list[np.ndarray], sketch: Sketch) -> np.ndarray:
    """Registers (one line per set, none of them empty) as uint16."""
    flat = np.concatenate(sets)
    high, low = (flat >> np.uint64(32)).astype(np.uint32), flat.astype(np.uint32)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    least = np.empty((len(sets), sketch.size), np.uint32)
    for i, (a, b) in enumerate(zip(*_multipliers(sketch.size))):
        least[:, i] = np.minimum.reduceat(high * a + low * b, starts)
    values = -np.log1p(-(least + 0.5) / 2.0**32) / sketch.rate
    return np.clip(np.floor(1 - np.log(values) / np.log(sketch.base)), 0, sketch.limit + 1).astype(np.uint16)


def merged(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(first, second)


def band_keys(regs: np.ndarray, sketch: Sketch) -> np.ndarray:
    keys = np.broadcast_to(np.arange(sketch.bands, dtype=np.uint64), (len(regs), sketch.bands)).copy()
    parts = regs.reshape(len(regs), sketch.bands, sketch.rows).astype(np.uint64)
    for i in range(sketch.rows):
        keys = mix(keys * STEP + parts[:, :, i] + np.uint64(1))
    return keys


def estimate(first: np.ndarray, second: np.ndarray, n_first: np.ndarray, n_second: np.ndarray, sketch: Sketch, steps: int = 101) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of pairs from greater, smaller and equal registers and the set sizes."""
    more, less = (first > second).sum(1)[:, None], (first < second).sum(1)[:, None]
    same = sketch.size - more - less
    u = (n_first / (n_first + n_second))[:, None]
    v = 1 - u
    j = np.linspace(0, 1, steps)[None, :] * np.minimum(u / v, v / u)
    p = lambda x: -np.log1p(-x * (sketch.base - 1) / sketch.base) / np.log(sketch.base)
    up, down = np.maximum(p(u - v * j), 1e-300), np.maximum(p(v - u * j), 1e-300)
    likely = more * np.log(up) + less * np.log(down) + same * np.log(np.maximum(1 - up - down, 1e-300))
    return np.take_along_axis(j, likely.argmax(1)[:, None], 1)[:, 0]


def _binary(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def sketches(rows: DataFrame, shingle: int, sketch: Sketch) -> DataFrame:
    """id, n, digest (16 bytes of the whole set), keys, regs for rows (id, text); without words n is 0 and the rest null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, sets in shingle_sets(batch.column(1), shingle):
                counts = np.array([len(s) for s in sets])
                some = np.flatnonzero(counts)
                digest, keys, regs = ([None] * len(sets) for _ in range(3))
                if len(some):
                    lines = registers([sets[i] for i in some], sketch)
                    for i, line, key in zip(some, lines, band_keys(lines, sketch)):
                        digest[i] = np.array([sets[i].sum(), mix(sets[i] ^ STEP).sum()], np.uint64).tobytes()
                        keys[i], regs[i] = key.view(np.int64), line.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, len(sets)), pa.array(counts, pa.int64()), pa.array(digest, pa.binary()),
                     pa.array(keys, pa.list_(pa.int64())), pa.array(regs, pa.binary())], ["id", "n", "digest", "keys", "regs"])

    return rows.mapInArrow(run, "id long, n long, digest binary, keys array<long>, regs binary")


def _likely(pairs: DataFrame, nodes: DataFrame, percent: int, sketch: Sketch, margin: float) -> DataFrame:
    """Pairs whose sizes and registers do not rule the similarity out."""
    side = lambda s: nodes.select(F.col("node").alias(s), F.col("n").alias(f"n_{s}"), F.col("regs").alias(f"regs_{s}"))
    least, most = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    both = pairs.join(side("a"), "a").join(side("b"), "b").filter(100 * least >= percent * most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 2000) for i in range(0, batch.num_rows, 2000)):
                regs = [np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint16).reshape(-1, sketch.size) for c in ("regs_a", "regs_b")]
                sizes = [part.column(c).to_numpy(zero_copy_only=False) for c in ("n_a", "n_b")]
                good = estimate(*regs, *sizes, sketch) >= percent / 100 - margin
                yield part.select(["a", "b"]).filter(pa.array(good))

    return both.select("a", "b", "n_a", "n_b", "regs_a", "regs_b").mapInArrow(run, "a long, b long")


def _sets(rows: DataFrame, ids: DataFrame, shingle: int) -> DataFrame:
    """(id, shingles as bytes) of the documents in ``ids``, stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, found in shingle_sets(batch.column(1), shingle):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, len(found)), pa.array([s.tobytes() for s in found], pa.binary())], ["id", "shingles"])

    return stored(rows.join(small(stored(ids)), "id", "left_semi").select("id", "text").mapInArrow(run, "id long, shingles binary"))


def _verified(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Pairs with 100 * intersection >= percent * union, on the full sets. A pair carries two sets of like size."""
    side = lambda s: full.select(F.col("id").alias(s), F.col("shingles").alias(f"set_{s}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "set_a", "set_b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for first, second in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(first.as_buffer(), np.uint64), np.frombuffer(second.as_buffer(), np.uint64)
                together = np.concatenate([x, y])
                together.sort()
                shared = int((together[1:] == together[:-1]).sum())
                good.append(100 * shared >= percent * (len(together) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return both.mapInArrow(compare, "a long, b long")


def _close(light: np.ndarray, sets: list[np.ndarray], sizes: np.ndarray, parts: np.ndarray, percent: int) -> Iterator[tuple[int, int]]:
    """Pairs (line of ``light``, any line) of different parts whose 32-bit sets may be similar enough.

    Two hashes that fall together can only make a pair look more alike, by at most the lines' own ``spare``.
    """
    spare = sizes - np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    line = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, line = flat[order], line[order]
    first = np.r_[True, flat[1:] != flat[:-1]] if len(flat) else np.zeros(0, bool)
    column = np.cumsum(first) - 1
    shared = np.bincount(column, minlength=1)[column] > 1 if len(flat) else first
    line = line[shared]
    _, column = np.unique(column[shared], return_inverse=True)
    # Shared hashes are taken some at a time, so that no matrix grows with the length of the texts.
    common = np.minimum(spare[light][:, None], spare[None, :]).astype(np.float32)
    for begin in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        part = slice(*np.searchsorted(column, [begin, begin + COLUMNS]))
        seen = np.zeros((len(sets), COLUMNS), np.float32)
        seen[line[part], column[part] - begin] = 1
        common += seen[light] @ seen.T
    union = sizes[light][:, None] + sizes[None, :] - common
    good = (100 * common >= percent * union) & (parts[light][:, None] != parts[None, :])
    for i, j in zip(*np.nonzero(good)):
        yield int(light[i]), int(j)


def _across(apart: DataFrame, members: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of a node in ``apart`` (key, node) with a node of another component in the same bucket of ``members``.

    Buckets are dealt in blocks of BLOCK nodes and compared inside the tasks on 32-bit shingle hashes; only pairs that may
    be linked come out. A bucket of up to BLOCK nodes is one task's group; a larger one has a group for
    each two blocks, so no group grows with the data.
    """

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([np.unique((s >> np.uint64(32)).astype(np.uint32)).tobytes() for s in sets], pa.binary())], ["node", "n", "short"])

    short = full.mapInArrow(narrow, "node long, n long, short binary")
    block = lambda count: F.pmod(F.xxhash64("node"), count).cast("int")
    blocks = lambda rows, name: rows.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).alias(name))
    counts = blocks(apart, "light").join(blocks(members, "all"), "key")
    marked = members.join(apart.withColumn("apart", F.lit(True)), ["key", "node"], "left").join(counts, "key").join(short, "node")
    cells = lambda rows, query, i, j: rows.select("key", "node", "c", "n", "short", F.lit(query).alias("query"), i.alias("i"), j.alias("j"))
    upto = lambda name: F.explode(F.sequence(F.lit(0), F.col(name).cast("int") - 1))
    dealt = cells(marked.filter("apart"), True, block(F.col("light")), upto("all")).unionByName(
        cells(marked, False, upto("light"), block(F.col("all"))))

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["query", "node"], ascending=[False, True])
        pairs = set()
        if not frame["query"].all() and frame["query"].any():
            nodes = frame["node"].to_numpy()
            sets = [np.frombuffer(x, np.uint32) for x in frame["short"]]
            light = np.flatnonzero(frame["query"].to_numpy())
            for x, y in _close(light, sets, frame["n"].to_numpy(), frame["c"].to_numpy(), percent):
                pairs.add((min(nodes[x], nodes[y]), max(nodes[x], nodes[y])))
        return pd.DataFrame(sorted(pairs), columns=["a", "b"], dtype="int64")

    return dealt.groupBy("key", "i", "j").applyInPandas(compare, "a long, b long").distinct()


def label_groups(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
                 sketch: Sketch = Sketch(), margin: float = 0.18) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id, kept.

    Two documents are linked if 100 * intersection >= percent * union of their shingle sets; a component is named
    after its smallest id and keeps that document. Texts without words, and null texts, are linked with nothing. A row
    with a null id is linked with nothing, has a null component and is kept. Rows with one id should hold one
    text; otherwise each is judged by its own. Other columns are not looked at. Ids that are not whole numbers, such as
    texts, are numbered in their order first, and come back as they were.
    """
    if not isinstance(docs.schema[id_col].dataType, T.IntegralType):
        return _by_number(docs, shingle, percent, id_col, text_col, sketch, margin)
    rows = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    seen = stored(sketches(rows, shingle, sketch))
    joined = F.col("digest").isNotNull() & F.col("id").isNotNull()
    classes = seen.filter(joined).groupBy("digest").agg(F.min("id").alias("node"))
    classes = stored(classes)
    nodes = stored(seen.filter(joined).join(classes.withColumnRenamed("node", "id"), ["digest", "id"], "left_semi")
                   .dropDuplicates(["id"]).select(F.col("id").alias("node"), "n", "keys", "regs"))

    placed = nodes.select(F.explode("keys").alias("key"), "node")
    buckets = placed.groupBy("key").agg(F.min("node").alias("a"), F.count("*").alias("members")).filter("members > 1")
    members = stored(placed.join(buckets.select("key", "a"), "key"))
    ends = lambda pairs: pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()

    likely = stored(_likely(members.filter("node > a").select("a", F.col("node").alias("b")).distinct(), nodes, percent, sketch, margin))
    first = stored(_verified(likely, _sets(rows, ends(likely), shingle), percent))
    found = connected(first)
    of = lambda name, out: found.select(F.col("id").alias(name), F.col("component").alias(out))
    placed = members.join(of("node", "c"), "node", "left").join(of("a", "c_a"), "a", "left").select(
        "key", "node", F.coalesce("c", "node").alias("c"), F.coalesce("c_a", "a").alias("main"))
    placed = stored(placed)
    apart = stored(placed.filter("c <> main").select("key", "node"))
    if not apart.isEmpty():
        open_rows = placed.join(apart.select("key").distinct(), "key", "left_semi").select("key", "node", "c")
        full = _sets(rows, open_rows.select(F.col("node").alias("id")).distinct(), shingle)
        more = _verified(stored(_across(apart, open_rows, full, percent)), full, percent)
        found = connected(first.unionByName(stored(more)))

    labels = seen.join(classes, "digest", "left").select("id", "n", F.when(F.col("id").isNotNull(), F.coalesce("node", "id")).alias("node"))
    labels = labels.join(of("node", "component"), "node", "left")
    component = F.coalesce("component", "node")
    return labels.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                         F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def _by_number(docs: DataFrame, shingle: int, percent: int, id_col: str, text_col: str, sketch: Sketch, margin: float) -> DataFrame:
    """:func:`label_groups` of ids of any type that can be sorted, by their places in that order."""
    given = docs.select(docs[id_col].alias("given"), docs[text_col].alias("text"))
    ids = given.filter(F.col("given").isNotNull()).select("given").distinct()
    numbers = numbered(ids.repartitionByRange(partitions(docs.sparkSession), "given").sortWithinPartitions("given"))
    found = label_groups(given.join(numbers, "given", "left").select(F.col("index").alias("id"), "text"), shingle, percent, "id", "text", sketch, margin)
    name = lambda number, out: numbers.select(F.col("index").alias(number), F.col("given").alias(out))
    named = found.join(name("id", "_own"), "id", "left").join(name("component_id", "_component"), "component_id", "left")
    return named.select(F.col("_own").alias(id_col), "n_shingles", F.col("_component").alias("component_id"), "kept")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` whose document stays, columns unchanged; options as in :func:`label_groups`."""
    gone = label_groups(docs, id_col=id_col, **options).filter("NOT kept").select(F.col(id_col).alias("gone_id")).distinct()
    return docs.join(gone, docs[id_col] == gone["gone_id"], "left_anti")
