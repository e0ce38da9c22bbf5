"""Mixture-controlled packing by deficit round-robin (operator 13).

Documents are encoded, and each source is a queue of tokens. Every window (``window`` tokens) is filled from all queues:
a queue's deficit counter grows by its quantum, the share of the window that the target proportions give it; the queues
are served in turn, each as many whole tokens as its counter holds; tokens that rounding leaves open go to the queues with
the largest counters, and what a counter has left, or has been overdrawn by, is carried to the next window. A queue that
has run out leaves its share to the others. Without targets the proportions are those of the table, and all queues last
to the end.

The rounds need no rows: how many tokens each queue gives to each window follows from the totals. So that no task has to
go through all windows, deficits are carried by a tree: the same rounds deal the tokens of each queue to ``FAN`` ranges of
windows, each range deals what it got to ``FAN`` smaller ones, down to single windows (``Schedule``). Any window's
shares are found from the top in a logarithmic number of rounds, in any task, and are whole tokens on every step, so that
nothing is lost at the borders of ranges or partitions. Then every document, at its place in its queue, is cut where the
windows say. Tokens are written once, next to where their text was read, and never shuffled: a document's place is the sum
of its queue's tokens in the partitions before (a table of one row per partition and source) and of those before it in its
own partition.

Queues are told by the driver: at most one for each source that fills a token of every window (``window`` of them), one
for all other sources together, or one for each target (``MOST_TARGETS``).

Defined results: null texts are empty; an empty text is the end id alone; a null source is a source of its own. Ids may
be null or repeated. The last window is the only one that may be short. An empty table gives an empty result; extra
columns are not read. A text is encoded in parts cut at white space; ``known`` words are remembered per worker up to a
bound and encoded again beyond it.
"""

from __future__ import annotations

import os
import re
import sys
import zlib
from array import array
from bisect import bisect_right
from collections import OrderedDict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskflow.llm.bpe import byte_characters
from riskflow.llm.common import materialize, shipped, slices

WINDOW, END, FAN, MOST_TARGETS, MOST_BROADCAST = 4096, 2, 64, 256, 200_000
#: Words remembered by a worker (as many older ones beside them), their greatest length, and the characters encoded at a time.
KNOWN, KNOWN_LENGTH, PART = 250_000, 40, 1 << 20
_ASCII_SPACE = re.compile("[\x20\x09-\x0d]")
_MARKS = re.compile("[\u0300-\U0010ffff]")
_LETTERS = re.compile("[a-zß-öø-ÿ]+")
#: Between a Latin-1 letter and an ASCII sign (an apostrophe may begin a contraction) a pre-token always ends.
_LETTER_THEN_SIGN = r"""([a-zß-öø-ÿ])([!-&(-/:-@\[-`{-~])"""


# -- encoding ------------------------------------------------------------------------------------------------------
class WordEncoder(dict):
    """Ids of whole texts by a lower-casing tokenizer that never joins what white space, or the end of a run of Latin-1
    letters before a sign, parts (its pre-tokens are letters, single digits or other signs). Texts are parted there,
    the different words of about ``PART`` characters are found, each is encoded on its own, once, and their ids are put in
    the words' places. Ids are little-endian bytes, ``width`` of them each; the words seen are the keys."""

    def __init__(self, serialised: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores are Spark's
        self.tokenizer = Tokenizer.from_str(serialised)
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.kind = "HI"[self.width // 4]
        self.special = sorted(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.model, self.to_chars = self.tokenizer.model, dict(enumerate(byte_characters()))
        self.old: dict[str, bytes] = {}  # the words seen before those

    def _ids(self, word: str) -> list[int]:
        if _LETTERS.fullmatch(word):  # one pre-token that the normaliser leaves as it is
            return [t.id for t in self.model.tokenize(word if word.isascii() else word.encode().decode("latin-1").translate(self.to_chars))]
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def __missing__(self, word: str) -> bytes:
        found = self.old.get(word)
        if found is None:
            ids = array(self.kind, self._ids(word))
            if sys.byteorder == "big":
                ids.byteswap()
            found = ids.tobytes()
        if len(word) <= KNOWN_LENGTH:
            if len(self) >= KNOWN:
                self.old = dict(self)
                self.clear()
            self[word] = found
        return found

    def _group(self, group: list[str]):
        """The ids of each part of a text."""
        texts, whole = [], []
        for part in group:
            lower = part.lower()
            special = any(s in lower for s in self.special)  # lower-casing must not make one up, nor a cut part one
            whole.append(special)
            # below the combining marks lower-casing commutes with composition
            texts.append(part if special or _MARKS.search(part) else lower)
        given = pa.array(texts, pa.large_string())
        apart = pc.replace_substring_regex(given, pattern=_LETTER_THEN_SIGN, replacement=r"\1 \2")
        if any(whole):
            apart = pc.if_else(pa.array(whole), given, apart)
        words = pc.ascii_split_whitespace(apart)
        seen = words.flatten().dictionary_encode()
        ids = list(map(self.__getitem__, seen.dictionary.to_numpy(zero_copy_only=False).tolist()))
        ends = np.cumsum([0, *map(len, ids)], dtype=np.int64)
        table = pa.Array.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(ends), pa.py_buffer(b"".join(ids))])
        found = table.take(seen.indices)
        data, at = found.buffers()[2], np.frombuffer(found.buffers()[1], np.int64, len(found) + 1)
        cuts = at[words.offsets.to_numpy()].tolist()
        return [data[i:j].to_pybytes() for i, j in zip(cuts, cuts[1:])]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, about ``PART`` characters at a time."""
        out: list[list[bytes]] = [[] for _ in texts]
        group, owners, size = [], [], 0

        def flush():
            for owner, ids in zip(owners, self._group(group)):
                out[owner].append(ids)

        for i, text in enumerate(texts):
            for part in parts(text):
                group.append(part)
                owners.append(i)
                size += len(part)
                if size >= PART:
                    flush()
                    group, owners, size = [], [], 0
        if group:
            flush()
        return [b"".join(x) for x in out]


def parts(text: str):
    """The text in pieces of about ``PART - 1`` characters that end at white space; a longer word stays whole."""
    at = 0
    while at < len(text):
        space = _ASCII_SPACE.search(text, at + PART // 2)
        end = space.end() if space else len(text)
        yield text[at:end]
        at = end


_encoders: dict[int, WordEncoder] = {}


def _encoder(serialised: str) -> WordEncoder:
    """One for each worker process: a tokenizer takes some tenths of a second to build."""
    key = zlib.crc32(serialised.encode())
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = WordEncoder(serialised)
    return _encoders[key]


def encoded(docs: DataFrame, tokenizer_path: str, end: int = END) -> DataFrame:
    """doc_id, source, part, before, n, ids (little-endian, of ``width`` bytes), width.

    ``before``: tokens that the documents of the same source have in the rows before, in the same partition."""
    with open(tokenizer_path, encoding="utf-8") as f:
        serialised = docs.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary file, a few MB
    schema = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("before", pa.int64()), ("n", pa.int64()),
                        ("width", pa.int32()), ("ids", pa.binary())])

    def run(batches):
        encoder, given = _encoder(serialised.value), {}
        for batch in batches:
            for part in slices(batch, 512):
                doc_id, text, source = (part.column(i).to_pylist() for i in range(3))
                out, last = [], end.to_bytes(encoder.width, "little")
                for d, s, x in zip(doc_id, source, encoder.encode_all([t or "" for t in text])):
                    x += last
                    n = len(x) // encoder.width
                    out.append((d, s, given.get(s, 0), n, encoder.width, x))
                    given[s] = given.get(s, 0) + n
                yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], f.type) for i, f in enumerate(schema)], schema=schema)

    rows = shipped(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("source").cast("string").alias("source"))
    return rows.mapInArrow(run, "doc_id long, source string, before long, n long, width int, ids binary") \
        .withColumn("part", F.spark_partition_id())


# -- the rounds ----------------------------------------------------------------------------------------------------
def deficit_rounds(tokens: np.ndarray, rooms: list[int]) -> np.ndarray:
    """Tokens that each queue gives to each of consecutive rooms, which together take them all: a (rooms, queues) table.

    A queue's quantum is its part of all tokens times the room. Counters are kept in units of one token divided by the
    number of all tokens, so that they are whole numbers.
    """
    whole = int(tokens.sum())
    big = whole * max(rooms, default=0) >= 1 << 61
    tokens = tokens.astype(object if big else np.int64)
    counter, left = tokens * 0, tokens.copy()
    out = np.zeros((len(rooms), len(tokens)), np.int64)
    for i, room in enumerate(rooms):
        counter = counter + tokens * room
        take = np.minimum(np.maximum(counter // whole, 0), left)
        open_ = room - int(take.sum())
        while open_:
            step = 1 if open_ > 0 else -1
            can = np.flatnonzero(((left - take) if step > 0 else take).astype(np.int64) > 0)
            # the largest counters get one more, the smallest give one back; on ties the queues' order decides
            turn = np.argsort((-step * (counter - take * whole))[can], kind="stable")[:abs(open_)]
            take[can[turn]] += step
            open_ -= step * len(turn)
        counter = counter - take * whole
        left = left - take
        out[i] = take.astype(np.int64)
    return out


def _phases(totals: list[int], weights: list[float], window: int) -> list[tuple[int, list[int]]]:
    """(windows, tokens of each queue): runs of windows in which the queues with tokens left stay the same, and between
    them single windows in which one runs out."""
    left, out = [int(t) for t in totals], []
    scale = [round(w * 1_000_000) for w in weights]
    while total := sum(left):
        share = [w if t else 0 for w, t in zip(scale, left)]
        share = share if sum(share) else left  # only queues without weight are left
        whole = sum(share)
        n = min([total // window, *[t * whole // (window * w) for t, w in zip(left, share) if w]])
        for windows in ([n] if n else []) + [0]:
            room = windows * window or min(window, sum(left))
            give = [min(t, room * w // whole) for t, w in zip(left, share)]
            while open_ := room - sum(give):  # rounding, and what queues that run out leave to the others
                can = [i for i, t in enumerate(left) if t > give[i] and share[i]] or [i for i, t in enumerate(left) if t > give[i]]
                each = max(1, open_ // len(can))
                for i in can[:open_]:
                    give[i] += min(each, left[i] - give[i], room - sum(give))
            out.append((max(windows, 1), give))
            left = [t - g for t, g in zip(left, give)]
            if not sum(left):
                break
    return out


class Schedule:
    """Which window, and which place in it, a token of a queue gets."""

    def __init__(self, totals: list[int], weights: list[float] | None = None, window: int = WINDOW):
        self.window = window
        self.phases = _phases(totals, weights or [1.0 * t / max(1, sum(totals)) for t in totals], window) if weights \
            else _even(totals, window)
        self.first = [0]
        self.start = [[0] * len(totals)]
        for windows, give in self.phases:
            self.first.append(self.first[-1] + windows)
            self.start.append([a + b for a, b in zip(self.start[-1], give)])
        self._begin()

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def __setstate__(self, state):
        self.__dict__ |= state
        self._begin()

    def _begin(self):
        queues = len(self.start[0])
        self._starts = [[s[q] for s in self.start] for q in range(queues)]
        self._kept, self._most = OrderedDict(), max(8, (1 << 21) // (FAN * max(1, queues)))

    def _node(self, path: tuple, windows: int, tokens: np.ndarray):
        """Of a range of windows: those of one child, running totals of the queues over the children, places in windows."""
        if path in self._kept:
            self._kept.move_to_end(path)
            return self._kept[path]
        span = 1
        while span * FAN < windows:
            span *= FAN
        size = int(tokens.sum())
        rooms = [min(span * self.window, size - i) for i in range(0, size, span * self.window)]
        dealt = deficit_rounds(tokens, rooms)
        running = np.vstack([np.zeros((1, dealt.shape[1]), np.int64), np.cumsum(dealt, axis=0)])
        places = np.cumsum(dealt, axis=1) - dealt if span == 1 else None
        self._kept[path] = (span, dealt, running, places)
        if len(self._kept) > self._most:
            self._kept.popitem(last=False)
        return self._kept[path]

    def pieces(self, queue: int, at: int, n: int):
        """(window, place in it, length) of the pieces of the queue's tokens at, ..., at + n - 1."""
        end = at + n
        while at < end:
            phase = bisect_right(self._starts[queue], at) - 1
            windows, give = self.phases[phase]
            path, first, start, tokens = (phase,), self.first[phase], self.start[phase][queue], np.array(give, object if sum(give) >= 1 << 61 else np.int64)
            while True:
                span, dealt, running, places = self._node(path, windows, tokens)
                column = running[:, queue]
                child = int(np.searchsorted(column, at - start, side="right")) - 1
                if span == 1:
                    break
                path, first, start = (*path, child), first + child * span, start + int(column[child])
                windows, tokens = min(span, windows - child * span), dealt[child]
            while at < end and child < len(dealt):
                room = int(column[child + 1]) - (at - start)
                if room:
                    length = min(room, end - at)
                    yield first + child, int(places[child, queue]) + at - start - int(column[child]), length
                    at += length
                child += 1


def _even(totals: list[int], window: int) -> list[tuple[int, list[int]]]:
    """One run of windows in which every queue lasts to the end; the last window may be short."""
    return [(-(-sum(totals) // window), [int(t) for t in totals])] if sum(totals) else []


# -- the operator --------------------------------------------------------------------------------------------------
def queues(tokens: DataFrame, targets: dict | None, window: int) -> tuple[DataFrame, list[int], list[float] | None]:
    """(source, queue) of the sources that have a queue of their own, tokens and weights of all queues.

    The last queue is that of all other sources."""
    spark = tokens.sparkSession
    per_source = materialize(tokens.groupBy("source").agg(F.sum("n").alias("n")), "packing-sources")
    total = per_source.agg(F.sum("n")).first()[0] or 0
    if targets is None:
        own = per_source.filter(F.col("n") * window >= F.lit(total))  # at most ``window`` rows
    else:
        if len(targets) > MOST_TARGETS:
            raise ValueError(f"at most {MOST_TARGETS} sources can have a target")
        own = per_source.filter(F.coalesce(F.col("source").isin([s for s in targets if s is not None]), F.lit(False))
                                | (F.col("source").isNull() & F.lit(None in targets)))
    found = sorted(((r["source"], r["n"]) for r in own.collect()), key=lambda x: (x[0] is not None, x[0] or ""))
    table = spark.createDataFrame([(s, i) for i, (s, _) in enumerate(found)], "source string, queue int")
    sizes = [n for _, n in found]
    rest = total - sum(sizes)
    weights = None
    if targets is not None:
        named = [float(targets[s]) for s, _ in found]
        weights = [*named, max(0.0, 1.0 - sum(named))]
    return table, [*sizes, rest], weights


def pack(docs: DataFrame, tokenizer_path: str, targets: dict | None = None, window: int = WINDOW, end: int = END) -> DataFrame:
    """doc_id, source, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids (of the piece): one row per piece.

    ``targets``: the wanted share of tokens of some sources; what is missing to one, and the share of a source without
    rows, goes to all others together."""
    tokens = materialize(encoded(docs, tokenizer_path, end), "packing-tokens")
    table, sizes, weights = queues(tokens, targets, window)
    schedule = Schedule(sizes, weights, window)
    given = (tokens.groupBy("part", "source").agg(F.sum("n").alias("n"))
             .join(F.broadcast(table.withColumnRenamed("source", "_source")), F.col("source").eqNullSafe(F.col("_source")), "left")
             .select("part", "source", "n", F.coalesce("queue", F.lit(len(sizes) - 1)).alias("queue")))
    given = materialize(given, "packing-parts")
    # of a queue: its tokens in the partitions before, and of its other sources in the same partition
    unbounded = (Window.unboundedPreceding, -1)
    earlier = (given.groupBy("queue", "part").agg(F.sum("n").alias("n"))
               .withColumn("earlier", F.coalesce(F.sum("n").over(Window.partitionBy("queue").orderBy("part").rowsBetween(*unbounded)), F.lit(0))).drop("n"))
    beside = F.coalesce(F.sum("n").over(Window.partitionBy("part", "queue").orderBy("source").rowsBetween(*unbounded)), F.lit(0))
    places = materialize(given.withColumn("beside", beside).join(earlier, ["queue", "part"]).select(
        F.col("part").alias("_part"), F.col("source").alias("_source"), "queue", (F.col("earlier") + F.col("beside")).alias("base")), "packing-places")
    if places.count() <= MOST_BROADCAST:
        places = F.broadcast(places)
    rows = tokens.join(places, (F.col("part") == F.col("_part")) & F.col("source").eqNullSafe(F.col("_source")))
    rows = rows.select("doc_id", "source", "queue", (F.col("base") + F.col("before")).alias("at"), "n", "width", "ids")
    schema = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])

    def run(batches):
        for batch in batches:
            for part in slices(batch, 64):
                out = []
                for doc_id, source, queue, at, n, width, ids in zip(*(part.column(i).to_pylist() for i in range(7))):
                    x, start = np.frombuffer(ids, f"<u{width}").astype("<u4").tobytes(), 0
                    for sequence, place, length in schedule.pieces(queue, at, n):
                        own = x[4 * start:4 * (start + length)]
                        out.append((doc_id, source, start, length, zlib.crc32(own), n, sequence, place, own))
                        start += length
                yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], f.type) for i, f in enumerate(schema)], schema=schema)

    return shipped(rows).mapInArrow(run, "doc_id long, source string, start long, length long, ids_crc32 long, doc_tokens long, "
                                    "sequence_id long, offset long, ids binary")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op13(docs: DataFrame) -> DataFrame:
    return pack(docs, default_tokenizer()).drop("ids", "source")
