"""Near-duplicates by Order MinHash.

Shingles of five words are labelled with their occurrence in the document, so repeats count.
Each of ``SKETCHES`` hash functions picks the ``PICKED`` smallest labelled shingles and keeps
them in text order; a document's key for that function is the hash of that sequence. Two
documents share a key only if they share the shingles and their order, which follows edit
similarity. Documents with a key in common are candidates; a banded alignment of their
shingles decides: common shingles in order over all shingles, ``SIMILARITY`` or more.

Few shingles make the sketch miss pairs, so texts up to ``SHORT`` shingles have exact keys beside
it: of their labelled shingles, ordered from rare to frequent, so many of the first that two
similar texts must share one (prefix filtering).

Equal texts (by words, lower-cased) are one node before any key is compared. In a bucket every
node is held against the bucket's most central node, its pivot, not against each other, so a
group of copies costs as many comparisons as it has members. Of nodes that are then still of
different components only those are compared whose differences from the pivot allow it
(``against_base`` says why no similar pair is lost); neither buckets nor partners have a cap.
Classes are the components of the links. Texts never move: nodes travel as digests, and only
nodes with a candidate send their words (4 bytes each) to be aligned.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from ..sources.shared import dropped
from .common import checked, cut, mix64, modest, released, small, word_hashes, written

WORDS, SIMILARITY = 5, 0.8
SKETCHES, PICKED = 32, 8
#: Shingles of a text that also has exact keys: the longest that is similar to a text of 60.
SHORT = 75
#: Functions that are looked at first.
EARLY = 4
#: Shingles that a sketch is made of at a time; longer texts are read block by block.
BLOCK = 1 << 12
ODD = mix64(np.arange(1, SKETCHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingles(words: np.ndarray) -> np.ndarray:
    """Hashes (uint64) of all runs of ``WORDS`` words; a shorter text is one run."""
    if not len(words):
        return np.empty(0, np.uint64)
    w = mix64(words.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    size = min(WORDS, len(w))
    n = len(w) - size + 1
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * np.uint64(0x100000001B3) + w[k : k + n]
    return mix64(out)


def labelled(runs: np.ndarray) -> np.ndarray:
    """``runs`` with the number of earlier equal ones worked in."""
    order = np.argsort(runs, kind="stable")
    s = runs[order]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    at = np.arange(len(s))
    label = np.empty(len(s), np.uint64)
    label[order] = at - np.maximum.accumulate(np.where(new, at, 0))
    return mix64(runs + label * np.uint64(0xD6E8FEB86659FD93))


def sketch(words: np.ndarray) -> np.ndarray:
    """The ``SKETCHES`` keys of a text (uint64); none for a text without a word."""
    runs = shingles(words)
    if not len(runs):
        return np.empty(0, np.uint64)
    marks = labelled(runs)
    chosen = None
    for i in range(0, len(runs), BLOCK):
        at = np.arange(i, min(i + BLOCK, len(runs)))
        at = np.broadcast_to(at, (SKETCHES, len(at))) if chosen is None else np.concatenate([chosen, np.broadcast_to(at, (SKETCHES, len(at)))], 1)
        if at.shape[1] > PICKED:
            values = marks[at] * ODD[:, None]
            chosen = np.take_along_axis(at, np.argpartition(values, PICKED - 1, 1)[:, :PICKED], 1)
        else:
            chosen = at
    chosen = np.sort(chosen, 1)
    key = np.arange(SKETCHES, dtype=np.uint64)
    for k in range(chosen.shape[1]):
        key = mix64(key * np.uint64(0x100000001B3) + runs[chosen[:, k]])
    return key


def short_marks(words: np.ndarray) -> np.ndarray:
    """The labelled shingles (uint64) of a short text; none for a longer one."""
    runs = shingles(words) if len(words) < SHORT + WORDS else np.empty(0, np.uint64)
    return labelled(runs) if len(runs) else runs


def digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b"\0".join(words), digest_size=16).digest()


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Common shingles in order over all shingles, from word hashes; 0 if surely below ``least``.

    The alignment lies in the band around the diagonal that ``least`` leaves: with more than
    ``d`` shingles unmatched no pair can reach it. One machine word step compares 64 and more
    positions (bit-parallel longest common subsequence on whole numbers).
    """
    a, b = shingles(a), shingles(b)
    n, m = len(a), len(b)
    if not n or not m:
        return float(n == m)
    if min(n, m) < least * max(n, m):
        return 0.0
    d = int((n + m) * (1 - least) / (1 + least) + 1e-9)
    short = min(n, m)
    differ = np.flatnonzero(a[:short] != b[:short])
    head = int(differ[0]) if len(differ) else short
    left = short - head
    differ = np.flatnonzero(a[n - left :][::-1] != b[m - left :][::-1])
    tail = int(differ[0]) if len(differ) else left
    x, y = a[head : n - tail], b[head : m - tail]
    if len(x) and len(y):
        p, q = np.unique(x, return_counts=True), np.unique(y, return_counts=True)
        _, i, j = np.intersect1d(p[0], q[0], assume_unique=True, return_indices=True)
        bound = head + tail + int(np.minimum(p[1][i], q[1][j]).sum())
        if bound < least * (n + m - bound):
            return 0.0
    common = head + tail + banded_lcs(x.tolist(), y.tolist(), d)
    return common / (n + m - common)


def banded_lcs(x: list[int], y: list[int], d: int) -> int:
    """Length of the longest common subsequence whose matches lie within ``d`` of the diagonal."""
    if not x or not y:
        return 0
    where: dict[int, int] = {}
    wanted = set(y)
    for i, c in enumerate(x):
        if c in wanted:
            where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(x)) - 1
    band, v = (1 << 2 * d + 1) - 1, full
    for j, c in enumerate(y):
        hits = where.get(c, 0)
        if hits:
            hits &= band << j - d if j >= d else band >> d - j
            u = v & hits
            v = (v + u | v - u) & full
    return len(x) - v.bit_count()


def sketched(rows: DataFrame, text: Column | str, keep: tuple[str, ...], keys: bool = True) -> DataFrame:
    """``keep`` and node (digest of the words), and with ``keys`` n (words), keys and marks (arrays).

    ``text`` is a column, or the name of a field of the struct _row, which ``keep`` then holds: a text goes to Python once.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    inside, field = isinstance(text, str), text if isinstance(text, str) else ""
    plain = rows.select(*keep, *([] if inside else [text.alias("_text")]))
    schema = StructType([f for f in plain.schema.fields if f.name != "_text"])
    kept = to_arrow_schema(schema)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            nodes, n, found, marks = [], [], [], []
            texts = pc.struct_field(b.column("_row"), [b.schema.field("_row").type.get_field_index(field)]) if inside else b.column("_text")
            for x in texts.to_pylist():
                words = (x or "").lower().encode("utf-8", "replace").split()
                nodes.append(digest(words))
                if keys:
                    n.append(len(words))
                    hashed = np.fromiter(map(zlib.crc32, words), np.uint32)
                    found.append(sketch(hashed))
                    marks.append(short_marks(hashed))
            cols, names = [*[b.column(c) for c in kept.names], pa.array(nodes, pa.binary())], [*kept.names, "node"]
            if keys:
                cols, names = [*cols, pa.array(n, pa.int64()), long_lists(found), long_lists(marks)], [*names, "n", "keys", "marks"]
            yield pa.RecordBatch.from_arrays(cols, names)
        pa.default_memory_pool().release_unused()

    out = schema.add("node", "binary")
    return plain.mapInArrow(make, out.add("n", "long").add("keys", ArrayType(LongType())).add("marks", ArrayType(LongType())) if keys else out)


def marked(nodes: DataFrame) -> np.ndarray:
    """A bit for each first three bytes of a digest, set where a row of ``nodes`` has them: 2 MB, whatever the number of rows."""
    prefix = F.conv(F.hex(F.substring("node", 1, 3)), 16, 10).cast("long")
    rows = nodes.groupBy(F.shiftright(prefix, 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(conv(hex(substring(node, 1, 3)), 16, 10) AS INT) & 63)")).alias("bits")).toPandas()
    bits = np.zeros(1 << 18, np.int64)
    bits[rows["at"]] = rows["bits"]
    return bits


def sequences(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """id, words (uint32 hashes as bytes) of the ``wanted`` nodes (id, node), one row each, in the shared folder.

    Most other texts stop at the bit map, before anything is shuffled; the join stops the rest.
    """
    bits = marked(wanted)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            nodes, found = [], []
            for x in b.column("_text").to_pylist():
                node = digest((x or "").lower().encode("utf-8", "replace").split())
                at = int.from_bytes(node[:3], "big")
                if int(bits[at >> 6]) >> (at & 63) & 1:
                    nodes.append(node)
                    found.append(word_hashes(x).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(found, pa.binary())], ["node", "words"])

    made = docs.select("_text").mapInArrow(make, "node binary, words binary")
    # Equal texts meet once; which of their equal rows stays does not matter.
    return written(made.join(wanted, "node").groupBy("id").agg(F.first("words").alias("words")), "sequences")


#: Labelled shingles that a worker remembers at most, 8 bytes each.
REMEMBERED = 1 << 20


class Marks(dict):
    """The labelled shingles of texts met lately, sorted, by node id."""

    held = 0

    def of(self, node: int, words: bytes) -> np.ndarray:
        found = self.get(node)
        if found is None:
            found = np.sort(labelled(shingles(np.frombuffer(words, np.uint32))))
            if self.held > REMEMBERED:
                self.clear()
                self.held = 0
            self[node] = found
            self.held += len(found)
        return found


def lacking(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The values of the sorted array ``a`` that the sorted array ``b`` lacks, sorted."""
    return a if not len(b) else a[b[np.minimum(np.searchsorted(b, a), len(b) - 1)] != a]


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The values that only one of two sorted arrays has, sorted."""
    return np.sort(np.concatenate([lacking(a, b), lacking(b, a)]))


def alike(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> bool:
    """Whether texts with these labelled shingles can be similar, whatever their order."""
    n, m = len(a), len(b)
    common = n - len(lacking(a, b)) if min(n, m) >= least * max(n, m) else 0
    return common >= least * (n + m - common) - 1e-9


def similar(x: bytes, y: bytes) -> bool:
    return similarity(np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)) >= SIMILARITY


def verified(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """a, b, similar of each row (a, b) of ``pairs``."""
    left, right = words.select(F.col("id").alias("a"), F.col("words").alias("_x")), words.select(F.col("id").alias("b"), F.col("words").alias("_y"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = Marks()
        for b in small(batches):
            rows = zip(b.column("a").to_pylist(), b.column("b").to_pylist(), b.column("_x").to_pylist(), b.column("_y").to_pylist())
            made = [alike(marks.of(i, x), marks.of(j, y)) and similar(x, y) for i, j, x, y in rows]
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(made, pa.bool_())], ["a", "b", "similar"])

    return pairs.join(left, "a").join(right, "b").select("a", "b", "_x", "_y").mapInArrow(compare, "a long, b long, similar boolean")


def against_base(own: np.ndarray, center: np.ndarray, fix: np.ndarray, least: float = SIMILARITY) -> tuple[bool, int, int, int, int, np.ndarray]:
    """near, n, apart, as_less, as_more, items: what the labelled shingles (sorted) of a text say beside those of its bucket's base.

    The base is the center, a text of the bucket, but for the shingles ``fix``; it may be any set, only the cost depends on it.
    The items of a text are the E shingles that the base lacks and the M of the base that it lacks; apart is E + M. Let m be
    the size of the base, d that of ``fix``, s the least similarity, f = (1 - s) / (1 + s). Texts x and y are similar only if
    their shingles differ in at most f (n_x + n_y), which is no more than t = (1 - s) n / s for either; and they differ just in
    the items that one of them has. A text is near if it differs from the center in at most f (n + n_c); if x isn't near,
    apart_x > f (n_x + m) - (1 + f) d. So similar texts x and y, of which at most one is near, have common items:

    - the one less apart all but t / 2 of its own, the one more apart all but t;
    - a near one more than (s E + M - d) / (1 + s);
    - at least one, but where the other is apart by (1 + f) d / (1 - f) or less (``central_pairs``).

    as_less and as_more say how many of its first items, in any one order, a text must look at to meet one of them.
    """
    base = differing(center, fix)
    extra, gone = lacking(own, base), lacking(base, own)
    n, apart = len(own), len(extra) + len(gone)
    near = alike(own, center, least)
    whole = Fraction(least).limit_denominator(1000)
    t = (1 - whole) / whole * n
    common = [1, math.ceil((whole * len(extra) + len(gone) - len(fix)) / (1 + whole) + Fraction(1, 10**6)) if near else 1]
    less, more = max(*common, math.ceil(apart - t / 2)), max(*common, math.ceil(apart - t))
    return near, n, apart, max(0, apart - less + 1), max(0, apart - more + 1), np.concatenate([extra, gone])


def beside_pivot(arena: DataFrame, words: DataFrame) -> DataFrame:
    """The rows (p, id, ...) of ``arena`` with the words of both, _x and _y."""
    left, right = words.select(F.col("id").alias("p"), F.col("words").alias("_x")), words.select("id", F.col("words").alias("_y"))
    return arena.join(left, "p").join(right, "id")


def pivot_links(arena: DataFrame, words: DataFrame) -> DataFrame:
    """p, id, linked, differ of each row (p, id) of ``arena``."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = Marks()
        for b in small(batches):
            linked, differ = [], []
            for i, j, x, y in zip(b.column("p").to_pylist(), b.column("id").to_pylist(), b.column("_x").to_pylist(), b.column("_y").to_pylist()):
                u, v = marks.of(i, x), marks.of(j, y)
                linked.append(alike(u, v) and similar(x, y))
                differ.append(differing(u, v) if linked[-1] else u[:0])
            yield pa.RecordBatch.from_arrays([b.column("p"), b.column("id"), pa.array(linked, pa.bool_()), long_lists(differ)], ["p", "id", "linked", "differ"])

    return beside_pivot(arena, words).select("p", "id", "_x", "_y").mapInArrow(compare, "p long, id long, linked boolean, differ array<long>")


def centers(links: DataFrame) -> DataFrame:
    """p, center, fix: for each pivot the text nearest to what most texts similar to it have, and the shingles that the two lack of each other.

    A pivot is a copy with edits of its own, by which all others would differ from it alike.
    """
    near = links.where("linked").select("p", "id", "differ")
    near = near.unionByName(near.select("p").distinct().select("p", F.col("p").alias("id"), F.array().cast("array<long>").alias("differ")))
    n = near.groupBy("p").agg(F.count(F.lit(1)).alias("_n"))
    items = near.select("p", F.explode("differ").alias("item")).groupBy("p", "item").agg(F.count(F.lit(1)).alias("_c"))
    common = items.where("_c > 1").join(checked(n), "p").where("2 * _c > _n").groupBy("p").agg(F.collect_list("item").alias("_f"))
    rest = near.join(checked(cut(common)), "p", "left").withColumn("_f", F.coalesce("_f", F.array().cast("array<long>"))).select("p", "id", F.concat(F.array_except("differ", "_f"), F.array_except("_f", "differ")).alias("fix"))
    best = rest.groupBy("p").agg(F.min(F.struct(F.size("fix").alias("d"), "id", "fix")).alias("_b"))
    return best.select("p", F.col("_b.id").alias("center"), F.col("_b.fix").alias("fix"))


def differences(arena: DataFrame, words: DataFrame) -> DataFrame:
    """p, id, linked (to p), d and what ``against_base`` says, of each row (p, id, fix) of ``arena``; the center is p."""
    numbers = ["d", "n", "apart", "as_less", "as_more"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = Marks()
        for b in small(batches):
            made = []
            for i, j, x, y, fix in zip(b.column("p").to_pylist(), b.column("id").to_pylist(), b.column("_x").to_pylist(), b.column("_y").to_pylist(), b.column("fix")):
                fixed = np.sort(fix.values.to_numpy().view(np.uint64)) if fix.is_valid else np.empty(0, np.uint64)
                near, *counts, items = against_base(marks.of(j, y), marks.of(i, x), fixed)
                made.append((near and similar(x, y), near, len(fixed), *counts, items))
            plain = [pa.array([x[i] for x in made], pa.bool_() if i < 2 else pa.int64()) for i in range(7)]
            yield pa.RecordBatch.from_arrays([b.column("p"), b.column("id"), *plain, long_lists([x[7] for x in made])], ["p", "id", "linked", "near", *numbers, "items"])

    both = beside_pivot(arena, words).select("p", "id", "_x", "_y", "fix")
    return both.mapInArrow(compare, "p long, id long, linked boolean, near boolean, " + ", ".join(f"{c} long" for c in numbers) + ", items array<long>")


def long_lists(found: list[np.ndarray]) -> pa.ListArray:
    """Arrays of 64-bit values as one Arrow column of lists."""
    flat = np.concatenate(found).view(np.int64) if found else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]).astype(np.int32)), pa.array(flat))


def components(links: DataFrame) -> DataFrame:
    """id, root (the smallest id of its component) of every node in ``links`` (a, b).

    Each step takes the smallest root among a node and its neighbours, then the root's own root.
    Minima of a hot node are partial before they are shuffled.
    """
    edges = cut(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct())
    now = cut(edges.groupBy(F.col("a").alias("id")).agg(F.least(F.first("a"), F.min("b")).alias("root")))

    def step(known: DataFrame) -> DataFrame:
        seen = edges.join(known, edges["b"] == known["id"]).groupBy("a").agg(F.min("root").alias("_m"))
        low = known.join(seen, known["id"] == seen["a"]).select("id", F.least("root", "_m").alias("_r"))
        up = known.select(F.col("id").alias("_n2"), F.col("root").alias("_r2"))
        return low.join(up, low["_r"] == up["_n2"]).select("id", F.least("_r", "_r2").alias("root"))

    while True:
        old = now.select(F.col("id").alias("_i"), F.col("root").alias("_old"))
        made = step(step(now))  # two steps a table: half as many tables and looks at them
        now = cut(made.join(old, made["id"] == old["_i"]).select("id", "root", (F.col("root") != F.col("_old")).alias("_moved")), now)
        if now.where("_moved").isEmpty():
            dropped(links.sparkSession, edges._folder)
            return now.drop("_moved")


def centrality(nodes: DataFrame) -> DataFrame:
    """id, score of the nodes that share a key of the early functions: the sizes of their buckets, summed.

    A text that others were made from shares keys with more of them than they do with each other.
    """
    each = nodes.select("id", F.explode(F.slice("keys", 1, EARLY)).alias("key"))
    sizes = each.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return cut(each.join(sizes, "key").groupBy("id").agg(F.sum("n").alias("score")))


def early_entries(nodes: DataFrame, scores: DataFrame) -> DataFrame:
    """key, id, score of the nodes that share a key of the early functions."""
    shared = nodes.join(scores, "id").select("id", "score", F.explode(F.slice("keys", 1, EARLY)).alias("key"))
    return shared.select("key", "id", "score")


def rare_keys(nodes: DataFrame) -> DataFrame:
    """id, more (array) of short texts: exact keys, of which similar texts have one in common.

    The longer of two similar texts shares at least ``SIMILARITY`` of its shingles, so one of the first few in any one
    order. Shingles of a single text are the rarest and come first; they are no keys, as nothing shares them.
    """
    each = nodes.select("id", F.size("marks").alias("size"), F.explode("marks").alias("mark"))
    often = each.groupBy("mark").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    found = each.join(often, "mark").groupBy("id", "size").agg(F.sort_array(F.collect_list(F.struct("often", "mark"))).alias("_m"))
    first = (F.size("_m") - F.ceil(F.col("size") * SIMILARITY - 1e-9) + 1).cast("int").alias("first")
    return found.select("id", "_m", first).where("first > 0").select("id", F.expr("transform(slice(_m, 1, first), x -> x.mark)").alias("more"))


def merged(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """``roots`` (id, root of every node with a link) after further ``links`` (a, b): only roots that the links join are looked at again."""
    if roots is None:
        return components(links)
    ends = links.select(F.col("a").alias("id")).union(links.select("b")).distinct()
    all_ = cut(roots.unionByName(ends.join(roots, "id", "left_anti").select("id", F.col("id").alias("root"))))
    ra, rb = all_.select(F.col("id").alias("a"), F.col("root").alias("_ra")), all_.select(F.col("id").alias("b"), F.col("root").alias("_rb"))
    joined = links.join(ra, "a").join(rb, "b").where("_ra != _rb").select(F.col("_ra").alias("a"), F.col("_rb").alias("b")).distinct()
    moved = components(joined).select(F.col("id").alias("root"), F.col("root").alias("_to"))
    return cut(all_.join(moved, "root", "left").select("id", F.coalesce("_to", "root").alias("root")))


def with_roots(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """``rows`` (id, ...) with root; a node without a link is its own."""
    return rows.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))


def early_pairs(nodes: DataFrame, scores: DataFrame) -> DataFrame:
    """a, b: every node with the most central node of each of its buckets of the early functions."""
    entries = early_entries(nodes, scores)
    ahead = entries.groupBy("key").agg(F.max(F.struct("score", "id")).alias("_a")).select("key", F.col("_a.id").alias("a"))
    return entries.join(ahead, "key").where("id != a").select("a", F.col("id").alias("b")).distinct()


def arenas(nodes: DataFrame, scores: DataFrame, roots: DataFrame) -> DataFrame:
    """p, id: every node of a bucket that holds two components or more, with the bucket's most central node."""
    known = with_roots(nodes.select("id", "keys").join(scores, "id", "left"), roots)
    each = cut(known.select("id", "root", F.coalesce("score", F.lit(0)).alias("score"), F.explode("keys").alias("key")))
    mixed = each.groupBy("key").agg(F.min("root").alias("_x"), F.max("root").alias("_y"), F.max(F.struct("score", "id")).alias("_p")).where("_x < _y").select("key", F.col("_p.id").alias("p"))
    return each.join(mixed, "key").where("id != p").select("p", "id").distinct()


#: Lengths that allow a link, of rows joined to others whose length is _n.
FITS = f"least(n, _n) >= {SIMILARITY} * greatest(n, _n)"


def first_items(found: DataFrame) -> DataFrame:
    """p, id, n, apart, near, item, less: the first items of each text, rare ones first; less is false where only the text's more apart role looks at them.

    Items of a single text are the rarest; they take places, but nothing shares them.
    """
    each = found.select("p", "id", F.explode("items").alias("item"))
    often = each.groupBy("p", "item").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    shared = each.join(often, ["p", "item"]).groupBy("p", "id").agg(F.sort_array(F.collect_list(F.struct("often", "item"))).alias("_i"))
    both = found.select("p", "id", "n", "apart", "near", "as_less", "as_more").join(shared, ["p", "id"]).withColumn("_alone", F.col("apart") - F.size("_i"))
    some = both.where("greatest(as_less, as_more) > _alone").withColumn("_i", F.expr("slice(_i, 1, CAST(greatest(as_less - _alone, as_more - _alone, 0L) AS INT))"))
    placed = some.select("p", "id", "n", "apart", "near", (F.col("as_less") - F.col("_alone")).alias("_l"), F.posexplode("_i").alias("_at", "_one"))
    return placed.select("p", "id", "n", "apart", "near", F.col("_one.item").alias("item"), (F.col("_at") < F.col("_l")).alias("less"))


def contested(items: DataFrame, roots: DataFrame) -> DataFrame:
    """``items`` with root, of the (p, item) that two components or more have, and lead: the greatest node of the most frequent one."""
    each = with_roots(items, roots)
    spans = each.groupBy("p", "item", "root").agg(F.count(F.lit(1)).alias("_c"), F.max("id").alias("_l"))
    tops = spans.groupBy("p", "item").agg(F.max(F.struct("_c", "_l")).alias("_t"), F.count(F.lit(1)).alias("_m")).where("_m > 1").select("p", "item", F.col("_t._l").alias("lead"))
    return each.join(tops, ["p", "item"])


def ordered_pairs(met: DataFrame) -> DataFrame:
    """a < b, once each, from rows _a, id."""
    return met.select(F.least("_a", "id").alias("a"), F.greatest("_a", "id").alias("b")).distinct()


def sharing_an_item(items: DataFrame) -> DataFrame:
    """a, b of different components with an item in common: the one less apart with the one more apart, one at least not near."""
    one = items.where("less").select("p", "item", F.col("id").alias("_a"), F.col("n").alias("_n"), F.col("root").alias("_r"), F.col("apart").alias("_d"), F.col("near").alias("_c"))
    return ordered_pairs(one.join(items, ["p", "item"]).where("root != _r AND _d <= apart AND NOT (near AND _c)").where(FITS))


def near_pairs(found: DataFrame, roots: DataFrame) -> DataFrame:
    """a, b of different components, both near to a center: what is outside of the most frequent component, such as texts in another order."""
    all_ = with_roots(found.where("near").select("p", "id", "n"), roots)
    tops = all_.groupBy("p", "root").agg(F.count(F.lit(1)).alias("_c")).groupBy("p").agg(F.max(F.struct("_c", "root")).alias("_t"), F.count(F.lit(1)).alias("_m")).where("_m > 1")
    pool = all_.join(tops.select("p", F.col("_t.root").alias("_top")), "p")
    one = pool.where("root != _top").select("p", F.col("id").alias("_a"), F.col("n").alias("_n"), F.col("root").alias("_r"))
    return ordered_pairs(one.join(pool, "p").where("root != _r").where(FITS))


def central_pairs(found: DataFrame, roots: DataFrame) -> DataFrame:
    """a, b of different components, the first not near to a center, that may be similar without a difference in common."""
    f = (1 - SIMILARITY) / (1 + SIMILARITY)
    all_ = with_roots(found.where("d > 0").select("p", "id", "n", "near", "apart", "d"), roots)
    one = all_.where("NOT near").select("p", F.col("id").alias("_a"), F.col("n").alias("_n"), F.col("root").alias("_r"), F.col("apart").alias("_d"))
    pool = all_.where(F.col("apart") <= (1 + f) / (1 - f) * F.col("d") + 1e-6)
    return ordered_pairs(one.join(pool, "p").where("root != _r").where(F.col("apart") + F.col("_d") <= f * (F.col("n") + F.col("_n")) + 1e-6).where(FITS))


def classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(rows, nodes). rows: _id, node of each row of ``docs``. nodes: node, id, _first (smallest doc id), class_id, class_size, _stays.

    class_id: the smallest doc id in the class. A text without a word (null, blank) is near to such texts only.

    Few functions come first and join most copies to the most central text of their bucket. Then each node of a bucket
    that still holds two components is held against the bucket's pivot, and what it differs in becomes its keys
    there: nodes of different components are compared only where these say they can be similar (``against_base``).
    """
    plain = modest(docs).select(F.col(doc_id).cast("long").alias("_id"), F.col(text).alias("_text"))
    rows = written(sketched(plain, F.col("_text"), ("_id",)), "sketches")
    nodes = rows.groupBy("node").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_copies"), F.first("keys").alias("keys"), F.first("marks").alias("marks"))
    nodes = written(nodes.withColumn("id", F.monotonically_increasing_id()), "nodes")
    scores = centrality(nodes)

    def words_of_ends(ends: DataFrame, older: DataFrame | None = None) -> DataFrame:
        new = ends.distinct() if older is None else ends.distinct().join(older, "id", "left_anti")
        made = sequences(plain, cut(new.join(nodes.select("id", "node"), "id")))
        return made if older is None else older.unionByName(made)

    pairs = cut(early_pairs(nodes, scores))
    words = words_of_ends(pairs.select(F.col("a").alias("id")).union(pairs.select("b")))
    early = cut(verified(pairs, words))
    roots = components(early.where("similar").select("a", "b"))

    more = rare_keys(nodes)
    keyed = nodes.select("id", "keys").join(more, "id", "left").withColumn("keys", F.concat("keys", F.coalesce("more", F.array().cast("array<long>"))))
    arena = cut(arenas(keyed, scores, roots))
    words = words_of_ends(arena.select("id").union(arena.select("p")), words)
    links = cut(pivot_links(arena, words))
    moved = cut(centers(links))
    fixes = moved.groupBy(F.col("center").alias("p")).agg(F.min(F.struct(F.size("fix").alias("d"), "fix")).alias("_f")).select("p", F.col("_f.fix").alias("fix"))
    members = arena.unionByName(arena.select("p", F.col("p").alias("id")).distinct()).join(moved.select("p", "center"), "p", "left")
    members = members.select(F.coalesce("center", "p").alias("p"), "id").distinct().where("id != p")
    known = early.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).union(links.select(F.least("p", "id"), F.greatest("p", "id")))

    def compared(pairs: DataFrame) -> None:
        nonlocal roots, known
        pairs = cut(pairs.distinct().join(known, ["a", "b"], "left_anti"))
        if not pairs.isEmpty():
            new = cut(verified(pairs, words))
            known = known.union(new.select("a", "b"))
            if not new.where("similar").isEmpty():
                roots = merged(roots, new.where("similar").select("a", "b"))

    found = cut(differences(members.join(fixes, "p", "left"), words))
    near = links.where("linked").select("p", "id").union(found.where("linked").select("p", "id"))
    roots = merged(roots, near.select(F.col("p").alias("a"), F.col("id").alias("b")))
    known = known.union(found.select(F.least("p", "id"), F.greatest("p", "id")))
    items = cut(first_items(found))
    # A second family is joined to one of its own texts before any two of its texts are compared.
    second = contested(items, roots).where("lead != id").select("id", "n", F.col("lead").alias("_a"))
    compared(ordered_pairs(second.join(found.select(F.col("id").alias("_a"), F.col("n").alias("_n")).distinct(), "_a").where(FITS)))
    compared(sharing_an_item(contested(items, roots)).union(near_pairs(found, roots)).union(central_pairs(found, roots)))

    all_ = nodes.select("node", "id", "_first", "_copies").join(roots.withColumnRenamed("id", "_n"), F.col("id") == F.col("_n"), "left").select("node", "id", "_first", "_copies", F.coalesce("root", "id").alias("root"))
    each = all_.groupBy(F.col("root").alias("_r")).agg(F.min("_first").alias("class_id"), F.sum("_copies").alias("class_size"), F.min(F.struct(F.col("_first").isNull().alias("x"), F.col("_first").alias("y"), F.col("id").alias("z"))).alias("_best"))
    each = each.withColumn("_s", F.col("_best.z"))
    released(docs.sparkSession)
    return rows.select("_id", "node"), all_.join(each, F.col("root") == F.col("_r")).select("node", "_first", "class_id", "class_size", (F.col("id") == F.col("_s")).alias("_stays"))


def grouped(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, class_id, class_size, kept of each row. Of a class the row with the smallest id is kept; of rows that repeat it, one.

    An empty table gives an empty result. Rows of null id belong to classes too; they are kept only where no row of the class has an id.
    """
    rows, nodes = classes(docs, text, doc_id)
    turn = F.row_number().over(Window.partitionBy("node", "_id").orderBy("_id"))
    each = rows.withColumn("_turn", turn).join(nodes, "node")
    kept = F.col("_stays") & F.col("_id").eqNullSafe(F.col("class_id")) & (F.col("_turn") == 1)
    return each.select(F.col("_id").alias(doc_id), "class_id", "class_size", kept.alias("kept"))


def deduplicated(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row of ``docs`` of each class, columns unchanged."""
    _, nodes = classes(docs, text, doc_id)
    stays = nodes.where("_stays").select(F.col("node").alias("_w"), F.col("class_id").alias("_c"))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    made = sketched(whole, text, ("_row",), keys=False)
    found = made.join(stays, (F.col("node") == F.col("_w")) & F.col(f"_row.`{doc_id}`").cast("long").eqNullSafe(F.col("_c")), "left_semi")
    one = F.row_number().over(Window.partitionBy("node").orderBy(F.lit(0)))
    return found.withColumn("_turn", one).where("_turn = 1").select("_row.*")
