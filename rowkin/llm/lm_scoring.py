"""Language-model scoring by cross-entropy difference.

A target model (every document labelled good) and a background model (all
documents) over runs of one to ``ORDER`` words, alike in order, smoothing and vocabulary: every
word of the corpus. A document's score is the mean over its tokens of the target loss less
the background loss; small is near to the target. The background is the whole corpus, the document with it.

Counts are exact and grow with the corpus; no task holds more than a bounded part of them, and
none reaches the driver but the totals:

- documents are read once and written as blocks of about ``BLOCK`` tokens (numbers of the words of the block);
- labels meet the ids of the blocks' documents, never their texts; what comes back to a block is a bit a document;
- every block asks for the counts of its distinct runs, dealt by hash to as many shards as keep
  a shard's runs under ``SHARD``; however frequent a run, a block asks for it once;
- a shard adds up the counts of its runs over all blocks and answers each block;
- a block, with its answers, scores its documents.

Runs are known by 64 bits of hash, of which 40 travel besides the shard's number: of
the at most ``SHARD`` runs of a shard, about one in 500,000 meets another one by chance, at any size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PIECE, Pieces, labelled, mix64, modest, small, written

ORDER = 3
#: Weight, in counts, of the estimate from one word less: small ones trust runs that a text has from itself alone.
PRIOR = 50.0
#: Tokens of a block, about: a document is never cut.
BLOCK = 5 << 17
#: Distinct runs of all blocks that a shard is asked for, about.
SHARD = 1 << 19
END = np.uint64(0x9E3779B97F4A7C15)


class Words(Pieces):
    """64-bit hashes (bytes) of the words and the marks in a chunk of lower-cased text."""

    def __missing__(self, chunk: bytes) -> bytes:
        parts = [chunk] if chunk.isalnum() else [x.encode() for x in PIECE.findall(chunk.decode())]
        self.shorten()
        self[chunk] = made = b"".join([xxhash.xxh64_intdigest(x).to_bytes(8, "little") for x in parts])
        return made


_words = Words()


def hashes(text: str | None) -> np.ndarray:
    """The words and the runs of marks of a text, lower-cased, as 64-bit hashes."""
    return np.frombuffer(b"".join(map(_words.__getitem__, (text or "").lower().encode("utf-8", "replace").split())), "<u8")


def packed(values: np.ndarray) -> bytes:
    """Whole numbers, byte by byte, compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True) if len(values) else b""


def unpacked(data: bytes, n: int, kind: str) -> np.ndarray:
    if not n:
        return np.empty(0, kind)
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data, n * size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, n).T).view(kind).reshape(n)


BLOCKS = "ids array<long>, sizes array<int>, words binary, n_words int, codes binary, n_codes int"


def blocks(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """block and ``BLOCKS``: documents in blocks, in the shared folder.

    codes: for each token the number of its word in the block, frequent words first.
    """
    read = modest(docs).select(F.col(doc_id).cast("long").alias("_doc"), F.col(text).alias("_text"))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held, tokens = [], [], 0

        def block() -> pa.RecordBatch:
            words, code, n = np.unique(np.concatenate(held), return_inverse=True, return_counts=True)
            order = np.argsort(-n, kind="stable")
            place = np.empty(len(order), np.uint32)
            place[order] = np.arange(len(order))
            cols = [[ids], [[len(x) for x in held]], [packed(words[order])], [len(words)], [packed(place[code.reshape(-1)])], [tokens]]
            kinds = [pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.int32(), pa.binary(), pa.int32()]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, kinds)], ["ids", "sizes", "words", "n_words", "codes", "n_codes"])

        for b in small(batches):
            for i, x in zip(b.column("_doc").to_pylist(), b.column("_text").to_pylist()):
                ids.append(i)
                held.append(hashes(x))
                tokens += len(held[-1])
                if tokens >= BLOCK:
                    yield block()
                    ids, held, tokens = [], [], 0
        if ids:
            yield block()

    made = read.mapInArrow(gather, BLOCKS).withColumn("block", F.monotonically_increasing_id())
    return written(made, "blocks")


def bits_of(rows: pa.Table) -> pa.Table:
    """block, a bit for each of its documents up to the last good one, and the events of the good ones."""
    place, size = (rows.column(c).to_numpy() for c in ("place", "size"))
    good = np.zeros(place.max() + 1, bool)
    good[place] = True
    events = int((size[size > 0].astype(np.int64) + 1).sum())
    return pa.table({"block": rows.column("block")[:1], "bits": pa.array([np.packbits(good).tobytes()], pa.binary()), "events": pa.array([events], pa.int64())})


def good_of(bits: bytes | None, n: int) -> np.ndarray:
    """Which of the ``n`` documents of a block are good, from its bits; without any, none."""
    known = np.unpackbits(np.frombuffer(bits or b"", np.uint8))[:n].astype(bool)
    return np.concatenate([known, np.zeros(n - len(known), bool)])


def marked(made: DataFrame, labels: DataFrame) -> DataFrame:
    """block, bits, events of the blocks that hold a document labelled good. Only ids and places move."""
    each = made.select("block", F.posexplode(F.arrays_zip("ids", "sizes")).alias("place", "_d")).select("block", "place", F.col("_d.sizes").alias("size"), F.col("_d.ids").alias("_doc"))
    good = each.join(labelled(labels).where("_good").select("_doc"), "_doc").select("block", "place", "size")
    return written(good.groupBy("block").applyInArrow(bits_of, "block long, bits binary, events long"), "marks")


class Block:
    """The runs of a block's documents. A document with a token ends in ``END``, so every run before its end goes on."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray, codes: np.ndarray) -> None:
        self.sizes = sizes
        some = sizes[sizes > 0].astype(np.int64)
        last = np.cumsum(some + 1) - 1
        self.stream = np.insert(words[codes], np.cumsum(some), END) if len(some) else np.empty(0, np.uint64)
        first = last - some
        #: Place in its document of each event of the stream.
        self.place = np.arange(len(self.stream), dtype=np.int32) - np.repeat(first.astype(np.int32), some + 1)
        self.is_end = np.zeros(len(self.stream), bool)
        self.is_end[last] = True
        self.doc = np.repeat(np.flatnonzero(sizes > 0).astype(np.int32), some + 1)

    def runs(self) -> tuple[np.ndarray, list[np.ndarray]]:
        """All distinct runs of the block (64-bit hashes, by order, sorted), and for each order the number of the run that ends at each event (-1: none)."""
        found, at, code = [], [], self.stream
        for k in range(ORDER):
            if k:
                code = mix64(np.concatenate([np.zeros(1, np.uint64), code[:-1]])[: len(self.stream)] * np.uint64(0xD6E8FEB86659FD93) + self.stream)
            here = np.flatnonzero(self.place >= k)
            distinct, inverse = np.unique(mix64(code[here] ^ np.uint64(k)), return_inverse=True)
            index = np.full(len(self.stream), -1, np.int32)
            index[here] = inverse.reshape(-1) + sum(map(len, found))
            del here, inverse
            found.append(distinct)
            at.append(index)
        self.singles = len(found[0])
        return np.concatenate(found), at

    def counted(self, good: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """runs, and how often the block holds each, in all documents and in good ones."""
        runs, at = self.runs()
        all_, ours = np.zeros(len(runs), np.int64), np.zeros(len(runs), np.int64)
        events = good[self.doc]
        for index in at:
            all_ += np.bincount(index[index >= 0], minlength=len(runs))
            ours += np.bincount(index[(index >= 0) & events], minlength=len(runs))
        return runs, all_, ours

    @staticmethod
    def of(row: dict) -> Block:
        return Block(np.array(row["sizes"], np.int64), unpacked(row["words"], row["n_words"], "<u8"), unpacked(row["codes"], row["n_codes"], "<u4"))


def dealt(runs: np.ndarray, singles: int, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the runs by shard, single words first and then by key; their keys in that order; and where each shard begins (``shards`` + 1 numbers).

    The shard is that of the highest bits. A key is 40 bits of the run mixed anew, so that it says more than the shard does.
    """
    shard = (runs >> np.uint64(40)) * np.uint64(shards) >> np.uint64(24)
    key = mix64(runs ^ END) & np.uint64((1 << 40) - 1)
    longer = (np.arange(len(runs)) >= singles).astype(np.uint64)
    order = np.argsort(shard << np.uint64(41) | longer << np.uint64(40) | key, kind="stable")
    return order, key[order], np.concatenate([[0], np.cumsum(np.bincount(shard.astype(np.int64), minlength=shards))])


def steps(keys: np.ndarray, singles: int) -> bytes:
    """Sorted keys, those of single words first, as differences: small ones take few bytes."""
    return packed(np.concatenate([np.diff(x, prepend=np.uint64(0)) for x in (keys[:singles], keys[singles:])]))


def keys_of(data: bytes, n: int, singles: int) -> np.ndarray:
    made = unpacked(data, n, "<u8")
    return np.concatenate([np.cumsum(made[:singles], dtype=np.uint64), np.cumsum(made[singles:], dtype=np.uint64)])


ASKED = "shard int, block long, n int, singles int, keys binary, all_ binary, good binary"
ANSWERED = "block long, shard int, n int, fresh long, all_ binary, good binary"


def asked(made: DataFrame, shards: int) -> DataFrame:
    """``ASKED``: the distinct runs of each block by shard, single words first, with the block's own counts."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, 1):
            for row in b.to_pylist():
                block = Block.of(row)
                runs, all_, good = block.counted(good_of(row["bits"], len(row["sizes"])))
                order, keys, at = dealt(runs, block.singles, shards)
                single = np.concatenate([[0], np.cumsum(order < block.singles)])
                all_, good = all_[order], good[order]
                used = np.flatnonzero(at[1:] > at[:-1])
                spans = [(int(at[k]), int(at[k + 1])) for k in used]
                first = [int(single[j] - single[i]) for i, j in spans]
                cols = [pa.array(used, pa.int32()), pa.array([row["block"]] * len(used), pa.int64()), pa.array([j - i for i, j in spans], pa.int32()), pa.array(first, pa.int32())]
                data = [[steps(keys[i:j], k) for (i, j), k in zip(spans, first)], [packed(all_[i:j]) for i, j in spans], [packed(good[i:j]) for i, j in spans]]
                yield pa.RecordBatch.from_arrays([*cols, *[pa.array(x, pa.binary()) for x in data]], ["shard", "block", "n", "singles", "keys", "all_", "good"])

    return made.select("block", "bits", "sizes", "words", "n_words", "codes", "n_codes").mapInArrow(ask, ASKED)


def answer(rows: pa.Table) -> pa.Table:
    """``ANSWERED``: the sums over all blocks of the counts that each block of a shard asked for. fresh: words that no block of smaller number asked for."""
    rows = rows.sort_by("block").combine_chunks()
    sizes, singles = (rows.column(c).to_numpy() for c in ("n", "singles"))
    held = [keys_of(x, n, k) for x, n, k in zip(rows.column("keys").to_pylist(), sizes, singles)]
    at = np.concatenate([[0], np.cumsum(sizes)])
    _, first, inverse = np.unique(np.concatenate(held), return_index=True, return_inverse=True)
    inverse = inverse.reshape(-1).astype(np.int32)
    del held
    sums = []
    for c in ("all_", "good"):
        each = np.concatenate([unpacked(x, n, "<i8") for x, n in zip(rows.column(c).to_pylist(), sizes)])
        total = np.zeros(len(first), np.int64)
        np.add.at(total, inverse, each)
        del each
        sums.append(total[inverse])
    new = np.concatenate([[0], np.cumsum(np.bincount(first, minlength=at[-1]))])
    fresh = [int(new[i + s] - new[i]) for i, s in zip(at[:-1], singles)]
    spans = list(zip(at[:-1], at[1:]))
    pa.default_memory_pool().release_unused()  # a worker keeps no more between shards than it needs
    return pa.table({
        "block": rows.column("block"),
        "shard": rows.column("shard"),
        "n": pa.array(sizes, pa.int32()),
        "fresh": pa.array(fresh, pa.int64()),
        "all_": pa.array([packed(sums[0][i:j]) for i, j in spans], pa.binary()),
        "good": pa.array([packed(sums[1][i:j]) for i, j in spans], pa.binary()),
    })


def event_losses(at: list[np.ndarray], counts: np.ndarray, events: int, words: int) -> np.ndarray:
    """Minus the logarithm of each event's probability.

    One word: (c(w) + 1) / (events + words + 1), where one word stands for those not met. Given k words v: (c(v w) + PRIOR
    times the estimate given k - 1 words) / (c(v) + PRIOR). Each sums to 1 over the vocabulary.
    """
    p = (counts[at[0]] + 1.0) / (events + words + 1)
    for shorter, index in zip(at, at[1:]):
        here = np.flatnonzero(index >= 0)
        p[here] = (counts[index[here]] + PRIOR * p[here]) / (counts[shorter[here - 1]] + PRIOR)
    return -np.log(p)


SCORES = "doc_id long, n_tokens long, target_loss double, background_loss double, score double"


def scored(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss, score of each row, losses per token in natural logarithms.

    Null text or text without a word or mark: 0 tokens, null losses and score. Whole texts are read. Rows that repeat
    count each on its own. The target model is fitted on every document labelled good. Ids are whole numbers; null ids stay. Without good labels the target model knows no run, and all
    its words are alike. An empty table gives an empty result.
    """
    made = blocks(docs, text, doc_id)
    marks = marked(made, labels)
    total = made.agg(F.sum(F.expr("aggregate(sizes, 0L, (a, s) -> a + IF(s > 0, s + 1L, 0L))")).alias("all_"), F.sum(F.col("n_codes").cast("long")).alias("tokens")).first()
    events = {"all_": total["all_"] or 0, "good": marks.agg(F.sum("events")).first()[0] or 0}
    shards = int(min(1 << 22, -(-(total["tokens"] or 0) * ORDER // (2 * SHARD)) + 1))
    requests = asked(made.join(F.broadcast(marks.select("block", "bits")), "block", "left"), shards)  # a bit a document: 2 MB for 30 GB of texts
    schema = "block long, shard int, n int, fresh long, all_ binary, good binary"
    answers = written(requests.groupBy("shard").applyInArrow(answer, schema), "answers")
    words = answers.agg(F.sum("fresh")).first()[0] or 0

    def score(key: tuple, block: pa.Table, said: pa.Table) -> pa.Table:
        row = block.to_pylist()[0]
        own = Block.of(row)
        runs, at = own.runs()
        order, _, starts = dealt(runs, own.singles, shards)
        n = own.sizes
        means = {}
        for c in ("good", "all_"):
            counts = np.zeros(len(runs), np.int64)
            for k, size, data in zip(said.column("shard").to_pylist(), said.column("n").to_pylist(), said.column(c).to_pylist()):
                counts[order[starts[k] : starts[k + 1]]] = unpacked(data, size, "<i8")
            loss = event_losses(at, counts, events[c], words)
            means[c] = np.bincount(own.doc[~own.is_end], loss[~own.is_end], minlength=len(n)) / np.maximum(n, 1)
        none = n == 0
        pa.default_memory_pool().release_unused()
        return pa.table({
            "doc_id": pa.array(row["ids"], pa.int64()),
            "n_tokens": pa.array(n, pa.int64()),
            "target_loss": pa.array(means["good"], pa.float64(), mask=none),
            "background_loss": pa.array(means["all_"], pa.float64(), mask=none),
            "score": pa.array(means["good"] - means["all_"], pa.float64(), mask=none),
        })

    return made.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, SCORES)
