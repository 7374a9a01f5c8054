"""Mixture-controlled packing into fixed windows by deficit round-robin.

Every source is a queue of documents. Each round fills one window: a queue's deficit grows by its quantum (its
share of a window) and it sends as many whole tokens as its deficit holds; the fraction is carried to the next
window. A window so has within a token of its share of every queue, and a document is cut only where a
window's share of its queue ends. When a queue ends, the others share its part by weight.

The rounds' state needs no walk through them: after m rounds of a phase (a stretch in which the same queues last) queue j has
sent floor(m P_j / D) - floor(m P_(j-1) / D) tokens, P being prefix sums of the quanta. So a piece's window and place
follow from its place in its queue, and that is a prefix sum over blocks: bounded rows of documents and their
tokens, written once. There are no more than ``QUEUES`` queues; sources of smaller shares line up in
one queue together, so the state on the driver is bounded, whatever the number of sources.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import modest, written

WINDOW = 4096
#: A source with a share under 1 / QUEUES has no queue of its own.
QUEUES = 64
#: Parts of a window in which quanta are counted: P stays under 2^28, and so m P under 2^63 up to 2^35 windows.
UNITS = 1 << 16
#: Tokens of a block, about: a document is never cut there.
BLOCK = 1 << 18
#: Chunks of text whose ids a worker keeps at most.
CACHE = 240_000
#: Texts, and new words, that are encoded together.
TOGETHER, WORDS_TOGETHER = 1000, 4096


class Chunks(dict):
    """ids, as little-endian bytes, of chunks of text without ASCII white space.

    Holds for tokenizers that lower the case, drop white space, end each word in a token of
    its own and take runs of letters, single digits and runs of other marks for words. Words
    not met before are encoded together, parted by spaces. Chunks with other characters than
    ASCII and Latin-1 letters, or with an apostrophe, are encoded one by one.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.older: dict[str, bytes] = {}
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends[i] = token.endswith("</w>")

    def encoded(self, chunk: str) -> bytes:
        return np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, self.kind).tobytes()

    def learn(self, new: list[str]) -> None:
        """Adds the chunks ``new``."""
        parts, words = {}, set()
        for chunk in new:
            if chunk.isascii() and chunk.isalpha():
                words.add(chunk)
            elif "<|" not in chunk and PLAIN.fullmatch(chunk):
                parts[chunk] = own = WORD.findall(chunk)
                words.update(own)
            else:
                self[chunk] = self.encoded(chunk)
        words = [x for x in words if x not in self]
        for i in range(0, len(words), WORDS_TOGETHER):
            some = words[i : i + WORDS_TOGETHER]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, self.kind)
            ends = ((np.flatnonzero(self.ends[ids]) + 1) * self.kind.itemsize).tolist()
            if len(ends) != len(some):
                raise ValueError("this tokenizer does not keep words apart")
            data, at = ids.tobytes(), 0
            for word, end in zip(some, ends):
                self[word] = data[at:end]
                at = end
        for chunk, own in parts.items():
            self[chunk] = b"".join([self[x] for x in own])

    def of(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text, as bytes; a null text has none. Each different chunk is looked up once."""
        if not pc.any(pc.match_substring(texts, "<|")).as_py():
            texts = pc.replace_substring_regex(pc.ascii_lower(texts), MARKED, r"\1 \2")
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = split.flatten().dictionary_encode()
        if len(self) > CACHE // 2:  # what is not asked for again within as many chunks is forgotten
            self.older = dict(self)
            self.clear()
        distinct = coded.dictionary.to_pylist()
        new = []
        for x in distinct:
            if x not in self:
                if x in self.older:
                    self[x] = self.older[x]
                else:
                    new.append(x)
        if new:
            self.learn(new)
        found = [self[x] for x in distinct]
        known = np.frombuffer(b"".join(found), self.kind)
        each = np.fromiter(map(len, found), np.int64, len(found)) // self.kind.itemsize
        index = coded.indices.to_numpy()
        n = each[index]
        first = np.concatenate([[0], np.cumsum(n)])
        ids = known[np.repeat((np.cumsum(each) - each)[index] - first[:-1], n) + np.arange(first[-1])] if len(index) else known
        ends = first[split.offsets.to_numpy() - split.offsets[0].as_py()]
        return [ids[i:j].tobytes() for i, j in zip(ends[:-1], ends[1:])]


LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
#: A letter and the mark after it are parts of two words; parted by a space, they need no look-up together.
MARKED = f"([{LETTERS}])([.,!?#$%&*])"
PLAIN = re.compile(f"(?:[{LETTERS}]|[!-&(-~])+")
WORD = re.compile(f"[{LETTERS}]+|[0-9]|[^{LETTERS}0-9]+")


@lru_cache(maxsize=2)
def chunks(path: str) -> Chunks:
    return Chunks(path)


BLOCKS = "docs array<struct<id:bigint,source:string,n:bigint>>, data binary"


def tokenized(docs: DataFrame, path: str, end_id: int, text: str = "text", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """block and ``BLOCKS``: documents in blocks of about ``BLOCK`` tokens, in the shared folder. data: the ids of all, each document's followed by the end id."""
    plain = modest(docs).select(F.col(doc_id).cast("long").alias("_id"), F.col(source).cast("string").alias("_source"), F.col(text).alias("_text"))
    kind = pa.struct([("id", pa.int64()), ("source", pa.string()), ("n", pa.int64())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = chunks(path)
        end, size = np.array([end_id], known.kind).tobytes(), known.kind.itemsize
        rows, held, tokens = [], [], 0

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([rows], pa.list_(kind)), pa.array([b"".join(held)], pa.binary())], ["docs", "data"])

        for b in batches:
            for at in range(0, len(b), TOGETHER):
                part = b.slice(at, TOGETHER)
                for i, s, x in zip(part.column("_id").to_pylist(), part.column("_source").to_pylist(), known.of(part.column("_text"))):
                    held += (x, end)
                    rows.append({"id": i, "source": s, "n": len(x) // size + 1})
                    tokens += rows[-1]["n"]
                    if tokens >= BLOCK:
                        yield block()
                        rows, held, tokens = [], [], 0
        if rows:
            yield block()

    return written(plain.mapInArrow(encode, BLOCKS).withColumn("block", F.monotonically_increasing_id()), "tokens")


@dataclass
class Phase:
    """``rounds`` windows from ``first`` on, before which queue j has sent sent[j] tokens and in which its quantum is (ends[j] - ends[j - 1]) / per."""

    first: int
    rounds: int
    ends: list[int]
    per: int
    sent: list[int]


def allotted(m: int, ends: list[int], per: int) -> list[int]:
    """What each queue has sent after ``m`` rounds; with whole rounds they fill m windows exactly."""
    upto = [m * e // per for e in ends]
    return [b - a for a, b in zip([0, *upto], upto)]


def schedule(tokens: list[int], weights: list[float], window: int = WINDOW) -> list[Phase]:
    """The phases in which queues of so many ``tokens`` fill all windows, shares by ``weights`` among queues that last.

    A queue that lasts has a token of each window at least. The window in which a queue ends takes what it has left, the others fill up.
    """
    sent, at, out = [0] * len(tokens), 0, []
    while any(s < t for s, t in zip(sent, tokens)):
        left = [t - s for s, t in zip(sent, tokens)]
        if sum(left) <= window:
            rounds, ends, per = 1, list(np.cumsum(left, dtype=object)), 1
        else:
            open_ = [j for j, x in enumerate(left) if x]
            total, least = sum(weights[j] for j in open_), -(-UNITS // window)
            units = [max(least, round(UNITS * weights[j] / total)) if x else 0 for j, x in enumerate(left)]
            units[max(open_, key=lambda j: units[j])] += UNITS - sum(units)
            ends, per = [window * int(e) for e in np.cumsum(units)], UNITS
            low, high = 0, 1 << 35
            while low < high:  # the most rounds for which no queue is too short
                m = (low + high + 1) // 2
                low, high = (m, high) if all(a <= x for a, x in zip(allotted(m, ends, per), left)) else (low, m - 1)
            rounds = low
            if not rounds:
                take, want = [0] * len(left), window
                while want:  # what ends gives all it has, until the rest can fill the window by weight
                    rest = [j for j in open_ if take[j] < left[j]]
                    share = sum(weights[j] for j in rest)
                    deal = [min(left[j] - take[j], max(1, int(want * weights[j] / share))) for j in rest]
                    for j, d in zip(rest, deal):
                        d = min(d, want)
                        take[j] += d
                        want -= d
                rounds, ends, per = 1, list(np.cumsum(take, dtype=object)), 1
        out.append(Phase(at, rounds, [int(e) for e in ends], per, sent))
        sent = [s + a for s, a in zip(sent, allotted(rounds, ends, per))]
        at += rounds
    return out


class Queue:
    """Where the tokens of one queue go."""

    def __init__(self, phases: list[Phase], j: int) -> None:
        column = lambda f: np.array([f(p) for p in phases], np.int64)
        self.first, self.sent, self.per = column(lambda p: p.first), column(lambda p: p.sent[j]), column(lambda p: p.per)
        self.low, self.high = column(lambda p: p.ends[j - 1] if j else 0), column(lambda p: p.ends[j])

    def begin(self, phase: np.ndarray, m: np.ndarray) -> np.ndarray:
        """Tokens of the queue before round ``m`` of ``phase``."""
        return self.sent[phase] + m * self.high[phase] // self.per[phase] - m * self.low[phase] // self.per[phase]

    def window(self, at: np.ndarray) -> np.ndarray:
        """The window of each token of the queue, by its place there."""
        phase = np.searchsorted(self.sent, at, "right") - 1
        m = (at - self.sent[phase]) * self.per[phase] // np.maximum(self.high[phase] - self.low[phase], 1)
        for _ in range(3):  # the quotient is right but for a round or two
            m = np.where(self.begin(phase, m) > at, m - 1, m)
            m = np.where(self.begin(phase, m + 1) <= at, m + 1, m)
        return self.first[phase] + m

    def spans(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each window: the queue's first token there, its end, and the offset of the first."""
        phase = np.searchsorted(self.first, windows, "right") - 1
        m = windows - self.first[phase]
        return self.begin(phase, m), self.begin(phase, m + 1), (m + 1) * self.low[phase] // self.per[phase] - m * self.low[phase] // self.per[phase]

    def pieces(self, at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of documents of ``n`` tokens from places ``at`` on: number of the document, start there, length, window, offset of every piece."""
        first = self.window(at)
        each = self.window(at + n - 1) - first + 1
        doc = np.repeat(np.arange(len(at)), each)
        windows = first[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(each) - each, each)
        begin, end, offset = self.spans(windows)
        low, high = np.maximum(begin, at[doc]), np.minimum(end, (at + n)[doc])
        some = high > low
        return tuple(x[some] for x in (doc, low - at[doc], high - low, windows, offset + low - begin))


def queues(totals: DataFrame, shares: dict[str | None, float] | None = None) -> tuple[list[str | None], list[int], list[float]]:
    """Names, tokens and weights of the queues for the sources' ``totals`` (source, tokens); the last, "", is that of all other sources.

    ``shares``: the weights of sources; others get theirs by tokens, as if all had. None: by tokens, so that all queues end together.
    At most ``QUEUES`` rows and a sum reach the driver.
    """
    all_ = int(totals.agg(F.sum("tokens")).first()[0] or 0)
    large = F.col("tokens") * QUEUES >= all_
    named = [k for k in (shares or {})][:QUEUES]
    if named:
        large = F.coalesce(F.col("source").isin([k for k in named if k is not None]), F.lit(None in named))
    rows = sorted(totals.where(large).collect(), key=lambda r: (r["source"] is None, r["source"] or ""))
    names, tokens = [r["source"] for r in rows], [int(r["tokens"]) for r in rows]
    rest = all_ - sum(tokens)
    if not shares:
        return [*names, ""], [*tokens, rest], [float(x) for x in (*tokens, rest)]
    given = sum(shares.values())
    return [*names, ""], [*tokens, rest], [*(float(shares[k]) / given for k in names), rest / max(1, all_)]


def starts(sums: DataFrame) -> DataFrame:
    """block, places: for each queue of a block (block, queue, n) the tokens of the queue in blocks before it.

    Prefix sums in two levels: over the blocks that one task wrote, and over tasks (a row for each and queue).
    """
    part = F.shiftright("block", 33)
    parts = sums.groupBy("queue", part.alias("_p")).agg(F.sum("n").alias("_sum"))
    parts = parts.select("queue", "_p", (F.sum("_sum").over(Window.partitionBy("queue").orderBy("_p")) - F.col("_sum")).alias("_base"))
    inside = F.sum("n").over(Window.partitionBy("queue", "_p").orderBy("block")) - F.col("n")
    each = sums.withColumn("_p", part).withColumn("_in", inside).join(parts, ["queue", "_p"])
    return each.groupBy("block").agg(F.collect_list(F.struct("queue", (F.col("_base") + F.col("_in")).alias("at"))).alias("places"))


PIECES = "doc_id long, source string, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def packed(docs: DataFrame, path: str, end_id: int, text: str = "text", doc_id: str = "doc_id", source: str = "source", shares: dict[str | None, float] | None = None, window: int = WINDOW) -> DataFrame:
    """``PIECES``: doc_id, source, start, length, doc_tokens, sequence_id, offset, ids (bytes, uint32 little-endian) of each piece.

    Null or empty text is the end id alone. Rows that repeat an id are packed each on its own. A null source is a source. Ids are
    whole numbers; null ids stay. Only the last sequence can be short of ``window``. An empty table gives an empty result.
    """
    made = tokenized(docs, path, end_id, text, doc_id, source)
    sums = made.select("block", F.explode("docs").alias("_d")).groupBy("block", F.col("_d.source").alias("source")).agg(F.sum("_d.n").alias("n"))
    sums = written(sums, "sums")
    names, tokens, weights = queues(sums.groupBy("source").agg(F.sum("n").alias("tokens")), shares)
    phases = schedule(tokens, weights, window)
    own = {k: j for j, k in enumerate(names[:-1])}
    number = F.lit(len(own))
    for k, j in own.items():
        number = F.when(F.col("source").eqNullSafe(F.lit(k)), j).otherwise(number)
    where = starts(sums.groupBy("block", number.alias("queue")).agg(F.sum("n").alias("n")))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, lines = chunks(path).kind, [Queue(phases, j) for j in range(len(names))]
        for b in batches:
            for r in range(len(b)):
                rows = b.column("docs")[r].values
                n = rows.field("n").to_numpy()
                line = np.fromiter((own.get(s, len(own)) for s in rows.field("source").to_pylist()), np.int64, len(n))
                first = np.cumsum(n) - n
                found = []
                for p in b.column("places")[r].as_py():
                    mine = np.flatnonzero(line == p["queue"])
                    at = p["at"] + np.cumsum(n[mine]) - n[mine]
                    doc, *rest = lines[p["queue"]].pieces(at, n[mine])
                    found.append((mine[doc], *rest))
                doc, start, length, seq, offset = (np.concatenate(x) for x in zip(*found))
                order = np.lexsort((start, doc))
                doc, start, length, seq, offset = (x[order] for x in (doc, start, length, seq, offset))
                # The pieces of a document, in order, are all its ids; so are those of a block.
                ids = np.frombuffer(b.column("data")[r].as_py(), kind).astype("<u4")
                if len(ids) != n.sum() or (first[doc] + start != np.cumsum(length) - length).any():
                    raise ValueError("pieces do not cover the documents")
                ends = np.concatenate([[0], np.cumsum(length)]) * 4
                data = pa.Array.from_buffers(pa.large_binary(), len(doc), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(ids)])
                at = pa.array(doc)
                cols = [rows.field("id").take(at), rows.field("source").take(at), pa.array(start), pa.array(length), rows.field("n").take(at), pa.array(seq), pa.array(offset), data.cast(pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "source", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    return made.join(where, "block").select("docs", "data", "places").mapInArrow(place, PIECES)
