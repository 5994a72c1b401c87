"""SentencePiece encoding and decoding by a max-plus scan over chunks.

The given model is of the BPE kind: its encoding is not the path of the highest
score but the result of merges. It still is a path problem. No merge crosses the
boundary between two final pieces, so a sequence of pieces is the encoding of a
text exactly if every two neighbours are the encoding of their own two texts
together. A lattice whose edges weigh 0 between such neighbours and minus
infinity between others has one path of weight 0, which is the encoding; sums
along paths and maxima over them find it.

A giant text is cut at fixed places into chunks. The state at a cut is the piece
that ends at it or lies across it. Each chunk by itself yields a matrix of
weights from states at its start to states at its end. Matrices are combined by
the (max, +) product, which is associative; the products to the left and right
of a cut fix its state, and each chunk is then traced back by itself. The chunks of a text are multiplied in spans by as many tasks, the spans'
products in one, and the states at the spans' ends then fix those inside.

Where no piece of the vocabulary can span two characters (before a space, around
a line break) the state does not matter. The parts between are encoded by the
library, the distinct ones of a batch at once, and remembered by the worker.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import accumulate, groupby, islice
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import materialize, shuffle_partitions, text_of

MARK = "▁"
# Characters per chunk; longer texts are giant and are split.
CHUNK_CHARS = 16_384
# Chunks whose matrices one task multiplies.
SPAN_CHUNKS = 64
REMEMBERED = 200_000
REMEMBERED_CHARS = 32
PART = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")
Matrix = dict[tuple[int, int], float]
START = 0


class Pieces:
    """A BPE vocabulary with byte fallback: encoding of parts, chunk matrices, decoding."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.ids, self.score, self.raw, self.byte = {}, {}, [], {}
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
                self.raw.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.raw.append(b"")
            else:
                self.ids[piece], self.score[piece] = i, model.get_score(i)
                self.raw.append(piece.replace(MARK, " ").encode())
        self.model, self.unknown = model, model.unk_id()
        self.longest = max(map(len, self.ids))
        crossing = [p for p in self.ids if re.search(f"[^{MARK}]{MARK}", p) or "\n" in p and p != "\n"]
        if crossing:
            raise ValueError(f"pieces span a word start or line break: {crossing[:5]}")
        self.fits: dict[tuple[str, str], bool] = {}
        self.parts: dict[str, bytes] = {}

    # --- which pieces may follow each other ---

    def merged(self, text: str) -> list[str]:
        """The encoding of a short text by its definition: best merge first, leftmost of equals."""
        score, parts = self.score, list(text)
        values = [score.get(a + b) for a, b in zip(parts, parts[1:], strict=False)]
        while options := [v for v in values if v is not None]:
            k = values.index(max(options))
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del values[k]
            if k < len(values):
                values[k] = score.get(parts[k] + parts[k + 1])
            if k:
                values[k - 1] = score.get(parts[k - 1] + parts[k])
        return parts

    def follows(self, left: str, right: str) -> bool:
        """Whether both stay as they are when encoded together; any start fits an empty left."""
        key = (left, right)
        found = self.fits.get(key)
        if found is None:
            if len(self.fits) > REMEMBERED:
                self.fits.clear()
            want = [left, right] if left else [right]
            found = self.fits[key] = self.merged(left + right) == want
        return found

    def advance(self, text: str, last: dict[int, str], start: int, end: int) -> dict[int, str]:
        """From the pieces that end at the places in ``last``, those that end up to ``end``.

        Each reached place keeps the one piece that ends a valid path there.
        """
        known = self.ids
        for i in range(start + 1, end + 1):
            for size in range(min(self.longest, i - start), 0, -1):
                if i - size in last:
                    piece = text[i - size : i]
                    if (size == 1 or piece in known) and self.follows(last[i - size], piece):
                        last[i] = piece
                        break
        return last

    def path(self, text: str) -> list[str]:
        """The path of weight 0 through a part, by depth first with the longest piece first.

        Some path always exists, so a dead end is left for the next shorter piece.
        """
        known, n, longest = self.ids, len(text), self.longest
        found: list[str] = []
        dead: set[tuple[int, str]] = set()
        at, size = 0, min(longest, n)
        while at < n:
            left = found[-1] if found else ""
            while size:
                piece = text[at : at + size]
                if size > 1 and piece not in known or not self.follows(left, piece):
                    size -= 1
                elif dead and (at + size, piece) in dead:
                    size -= 1
                else:
                    break
            if size:
                found.append(piece)
                at += size
                size = min(longest, n - at)
            else:
                dead.add((at, found.pop()))
                at -= len(left)
                size = len(left) - 1
        return found

    @staticmethod
    def trace(last: dict[int, str], start: int, end: int) -> list[str]:
        out = []
        while end > start:
            out.append(last[end])
            end -= len(out[-1])
        return out[::-1]

    def numbers(self, found: list[str]) -> bytes:
        out = b""
        for piece in found:
            number = self.ids.get(piece)
            if number is not None:
                out += number.to_bytes(4, "little")
            else:
                for b in piece.encode("utf-8", "surrogatepass"):
                    out += self.byte.get(b, self.unknown).to_bytes(4, "little")
        return out

    # --- whole texts ---

    def part(self, text: str) -> bytes:
        """Ids of a part between places that no piece spans."""
        found = self.parts.get(text)
        return self.numbers(self.path(text)) if found is None else found

    def learn(self, parts: set[str]) -> dict[str, bytes]:
        """Ids of distinct parts, from memory or, all others at once, from the library.

        A line break in front keeps the library from putting a space there; nothing
        spans it, so the part's ids are those after that space's and the break's.
        """
        known = self.parts
        if len(known) > REMEMBERED:  # other words may be frequent now
            known.clear()
        new = list(parts.difference(known))
        coded = self.model.encode(["\n" + p.replace(MARK, " ") for p in new], num_threads=1)
        made = {p: np.array(ids[2:], "<u4").tobytes() for p, ids in zip(new, coded, strict=True)}
        found = {p: known[p] for p in parts if p in known} | made
        known.update((p, ids) for p, ids in made.items() if len(p) <= REMEMBERED_CHARS)
        return found

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts; the distinct parts of all of them are encoded once."""
        split = [PART.findall(t) for t in texts]
        found = self.learn(set().union(*split))
        return [b"".join(map(found.__getitem__, parts)) for parts in split]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> str:
        raw = b"".join(map(self.raw.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        text = raw.decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text

    # --- chunks ---

    def states(self, text: str, at: int) -> list[tuple[int, int]]:
        """Pieces that may end at ``at`` or lie across it: (size, characters beyond it)."""
        out = []
        for beyond in range(min(self.longest, len(text) - at + 1)):
            for size in range(beyond + 1, min(self.longest, at + beyond) + 1):
                piece = text[at + beyond - size : at + beyond]
                if piece in self.ids or size == 1:
                    out.append((size, beyond))
        return out

    def _exits(self, text: str, last: dict[int, str], low: int, end: int, final: bool) -> list[int]:
        """States at ``end`` that a piece starting in [low, end) reaches."""
        out = []
        for size, beyond in self.states(text, end):
            begin = end + beyond - size
            if (final and beyond) or begin < low or begin not in last:
                continue
            piece = text[begin : end + beyond]
            if self.follows(last[begin], piece):
                out.append(code(size, beyond))
        return out

    def matrix(self, text: str, begin: int, end: int, final: bool) -> Matrix:
        """Weights from states at ``begin`` to states at ``end``; what is absent is -inf."""
        cuts = [m.start() for m in PART.finditer(text, begin) if begin < m.start() <= end]
        ends = None
        if cuts:
            low = cuts[-1]
            if low == end:
                # Nothing spans the end: all that matters there is a piece that stops at it.
                low = cuts[-2] if len(cuts) > 1 else begin
        out: Matrix = {}
        entries = self.states(text, begin) if begin else [(0, 0)]
        for size, beyond in entries:
            if begin + beyond > end:
                out[code(size, beyond), code(size, beyond - (end - begin))] = 0.0
                continue
            if begin + beyond == end:
                out[code(size, beyond), code(size, 0)] = 0.0
                continue
            first = begin + beyond
            opening = text[first - size : first]
            stop = next((c for c in cuts if c >= first), None)
            upto = end if stop is None else stop
            last = self.advance(text, {first: opening}, first, upto)
            if upto not in last:
                continue
            if stop is None or stop == end:
                exits = self._exits(text, last, first, end, final)
            elif low <= stop and cuts[-1] == end and len(cuts) == 1:
                exits = self._exits(text, last, first, end, final)
            else:
                if ends is None:
                    ends = self._exits(text, self.advance(text, {low: ""}, low, end), low, end, final)
                exits = ends
            for x in exits:
                out[code(size, beyond), x] = 0.0
        return out

    def chunk_ids(self, text: str, begin: int, end: int, entry: int, leave: int) -> bytes:
        """Ids of the pieces that start in a chunk, between its known states."""
        size, beyond = entry // 64, entry % 64
        out_size, out_beyond = leave // 64, leave % 64
        first, stop = begin + beyond, end + out_beyond - out_size
        if first > end or out_size == 0 or stop < first:
            return b""
        opening = text[first - size : first]
        cut = next((m.start() for m in PART.finditer(text, begin) if first <= m.start() and begin < m.start() <= stop), None)
        ids = b""
        if cut is not None:
            if cut > first:
                ids = self.numbers(self.trace(self.advance(text, {first: opening}, first, cut), first, cut))
            inner = [m.group() for m in PART.finditer(text, cut, stop)]
            # The last part may go on beyond the last known piece: it is traced by itself.
            tail = sum(map(len, inner[:-1])) if inner else 0
            found = self.learn(set(inner[:-1]))
            ids += b"".join(map(found.__getitem__, inner[:-1]))
            first, opening = cut + tail, ""
        ids += self.numbers(self.trace(self.advance(text, {first: opening}, first, stop), first, stop))
        return ids + self.numbers([text[stop : end + out_beyond]])


def code(size: int, beyond: int) -> int:
    """A state as a number; pieces are far shorter than 64 characters."""
    return size * 64 + beyond


def compose(left: Matrix, right: Matrix) -> Matrix:
    """The (max, +) product of two matrices."""
    by_entry: dict[int, list[tuple[int, float]]] = {}
    for (a, b), w in right.items():
        by_entry.setdefault(a, []).append((b, w))
    out: Matrix = {}
    for (a, b), w in left.items():
        for c, v in by_entry.get(b, ()):
            out[a, c] = max(out.get((a, c), float("-inf")), w + v)
    return out


def path_states(matrices: list[Matrix], entry: int = START, leave: int | None = None) -> list[int]:
    """The state at each of the cuts of the best path, from the products on both sides.

    The path begins in ``entry`` and ends in ``leave``, or in its best state.
    """
    ahead = list(accumulate(matrices, compose))
    behind = list(accumulate(reversed(matrices), lambda done, m: compose(m, done)))[::-1]
    out = [entry]
    for k, left in enumerate(ahead):
        options = {b: w for (a, b), w in left.items() if a == entry}
        if k + 1 < len(matrices):
            rest: dict[int, float] = {}
            for (a, b), w in behind[k + 1].items():
                if leave is None or b == leave:
                    rest[a] = max(rest.get(a, float("-inf")), w)
            options = {b: w + rest[b] for b, w in options.items() if b in rest}
        elif leave is not None:
            options = {leave: options[leave]}
        out.append(max(sorted(options), key=options.__getitem__))
    return out


_loaded: dict[str, Pieces] = {}


def load(path: str) -> Pieces:
    """The vocabulary, kept by the worker process."""
    if path not in _loaded:
        _loaded.clear()
        _loaded[path] = Pieces(path)
    return _loaded[path]


# --- tables ------------------------------------------------------------------


def _marked(text) -> Column:
    """The text as the model sees it: spaces marked, one in front."""
    body = F.replace(text, F.lit(" "), F.lit(MARK))
    return F.when(text == "", text).otherwise(F.concat(F.lit(MARK), body))


def _encoder(path: str):
    @F.pandas_udf("binary")
    def encoded(texts: pd.Series) -> pd.Series:
        model = load(path)
        return pd.Series(model.encode_all(texts.tolist()), dtype=object)

    return encoded


_CHUNK = "row long, chunk int, begin int, end int, final boolean, window string"


def _windows(chunk_chars: int, around: int):
    """Chunks of texts, each with the characters around it that a piece may reach."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                text = batch.column("marked")[k].as_py()
                row, kept = batch.column("row")[k].as_py(), batch.column("pieces__kept").slice(k, 1)
                for chunk, start in enumerate(range(0, len(text), chunk_chars)):
                    stop = min(start + chunk_chars, len(text))
                    low = max(start - around, 0)
                    columns = [
                        pa.array([row], pa.int64()),
                        pa.array([chunk], pa.int32()),
                        pa.array([start - low], pa.int32()),
                        pa.array([stop - low], pa.int32()),
                        pa.array([stop == len(text)], pa.bool_()),
                        pa.array([text[low : stop + around]], pa.string()),
                        kept if chunk == 0 else pa.nulls(1, kept.type),
                    ]
                    names = [c.split()[0] for c in _CHUNK.split(", ")]
                    yield pa.RecordBatch.from_arrays(columns, [*names, "pieces__kept"])

    return windows


def _matrices(path: str):
    def matrices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load(path)
        for rows in batches:
            made = [
                list(model.matrix(t, b, e, f))
                for t, b, e, f in zip(rows["window"], rows["begin"], rows["end"], rows["final"], strict=True)
            ]
            yield pd.DataFrame(
                {
                    "row": rows["row"],
                    "chunk": rows["chunk"],
                    "span": rows["span"],
                    "entry": [[a for a, _ in m] for m in made],
                    "leave": [[b for _, b in m] for m in made],
                }
            )

    return matrices


def _in_groups(keys: tuple[str, ...], use: Callable[[list[dict]], Iterator[dict]], schema: str):
    """Applies ``use`` to the rows of each group, for partitions sorted by the group's keys.

    Far cheaper per group than a grouped map, of which most texts have only one chunk or two.
    """
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (row for batch in batches for row in batch.to_dict("records"))
        made = (out for _, group in groupby(rows, itemgetter(*keys)) for out in use(list(group)))
        while some := list(islice(made, 1000)):
            yield pd.DataFrame(some, columns=names)

    return run


def _made(rows: list[dict]) -> list[Matrix]:
    return [{(int(a), int(b)): 0.0 for a, b in zip(r["entry"], r["leave"], strict=True)} for r in rows]


def _product(rows: list[dict]) -> Iterator[dict]:
    """The matrix of a span of chunks."""
    whole = reduce(compose, _made(rows))
    entry, leave = [a for a, _ in whole], [b for _, b in whole]
    yield {"row": rows[0]["row"], "span": rows[0]["span"], "entry": entry, "leave": leave}


def _scan(rows: list[dict]) -> Iterator[dict]:
    """States at the ends of one text's spans."""
    found = path_states(_made(rows))
    for row, first, last in zip(rows, found, found[1:], strict=False):
        yield {"row": row["row"], "span": row["span"], "first": first, "last": last}


def _scan_span(rows: list[dict]) -> Iterator[dict]:
    """States of the chunks of one span, between those at its ends."""
    found = path_states(_made(rows), int(rows[0]["first"]), int(rows[0]["last"]))
    for row, entry, leave in zip(rows, found, found[1:], strict=False):
        yield {"row": row["row"], "chunk": row["chunk"], "entry": entry, "leave": leave}


def _dealt(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    tasks = shuffle_partitions(rows.sparkSession)
    return rows.repartition(tasks, *keys).sortWithinPartitions(*keys, order)


def _chunk_encoder(path: str):
    @F.pandas_udf("binary")
    def encoded(window: pd.Series, begin: pd.Series, end: pd.Series, entry: pd.Series, leave: pd.Series) -> pd.Series:
        model = load(path)
        columns = (window, begin.tolist(), end.tolist(), entry.tolist(), leave.tolist())
        return pd.Series([model.chunk_ids(*r) for r in zip(*columns, strict=True)], dtype=object)

    return encoded


def encode(docs: DataFrame, *, model: str, keep: list[str], chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """``keep`` columns and ``ids`` of every row: little-endian 32-bit piece ids.

    Null and empty texts have no ids. Ordinary texts are encoded where they are
    read; giant ones are split and their chunks spread over all tasks. U+2581 in
    a text is read as a space, as the model does.
    """
    marked = docs.select(*keep, _marked(text_of()).alias("marked"))
    if chunk_chars < load(model).longest:
        raise ValueError("a chunk must be as long as the longest piece")
    giant = F.char_length("marked") > chunk_chars
    small = marked.where(~giant).select(*keep, _encoder(model)(F.col("marked")).alias("ids"))

    kept = F.struct(*keep, F.lit(0).alias("pieces__")).alias("pieces__kept")
    giants = marked.where(giant).select(F.monotonically_increasing_id().alias("row"), "marked", kept)
    kept_type = giants.schema["pieces__kept"].dataType.simpleString()
    chunks = giants.mapInArrow(
        _windows(chunk_chars, load(model).longest), f"{_CHUNK}, pieces__kept {kept_type}"
    ).withColumn("span", F.floor(F.col("chunk") / SPAN_CHUNKS).cast("int"))
    # Written once: the ids of the rows must not change between the passes.
    chunks = materialize(chunks.repartition("row", "chunk"), "piece-chunks")
    sides = chunks.select("row", "chunk", "span", "window", "begin", "end", "final").mapInPandas(
        _matrices(model), "row long, chunk int, span int, entry array<int>, leave array<int>"
    )
    # A tree of two levels: products of spans, states at their ends, states inside.
    sides = materialize(sides, "piece-matrices")
    of_span, of_ends = "row long, span int, entry array<int>, leave array<int>", "row long, span int, first int, last int"
    spans = _dealt(sides, ["row", "span"], "chunk").mapInPandas(_in_groups(("row", "span"), _product, of_span), of_span)
    ends = _dealt(spans, ["row"], "span").mapInPandas(_in_groups(("row",), _scan, of_ends), of_ends)
    of_chunks = "row long, chunk int, entry int, leave int"
    states = _dealt(sides.join(ends, ["row", "span"]), ["row", "span"], "chunk")
    states = states.mapInPandas(_in_groups(("row", "span"), _scan_span, of_chunks), of_chunks)
    traced = chunks.drop("span").join(states, ["row", "chunk"]).select(
        "row", "chunk", "pieces__kept",
        _chunk_encoder(model)("window", "begin", "end", "entry", "leave").alias("part"),
    )
    whole = traced.groupBy("row").agg(
        F.max("pieces__kept").alias("pieces__kept"),
        F.sort_array(F.collect_list(F.struct("chunk", F.hex("part").alias("part")))).alias("parts"),
    )
    joined = F.unhex(F.array_join("parts.part", ""))
    large = whole.select(*[F.col("pieces__kept")[c].alias(c) for c in keep], joined.alias("ids"))
    return small.unionByName(large)


def decode(rows: DataFrame, *, model: str) -> DataFrame:
    """Add ``decoded``, the text of ``ids``."""

    @F.pandas_udf("string")
    def decoded(ids: pd.Series) -> pd.Series:
        pieces = load(model)
        return pd.Series([pieces.decode(x) for x in ids], dtype=object)

    return rows.withColumn("decoded", decoded("ids"))


def id_array(ids) -> Column:
    """The binary ids as an array of integers."""

    @F.pandas_udf("array<int>")
    def array(values: pd.Series) -> pd.Series:
        return pd.Series([np.frombuffer(v, "<u4").astype(np.int32) for v in values], dtype=object)

    return array(ids)


def piece_digests(docs: DataFrame, *, model: str, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """Encode and decode every text.

    Returns ``doc_id, n_chars, n_pieces, ids_crc32, decoded_sha256,
    round_trip``, one row per input row; the last tells whether decoding gives
    the text back (with U+2581 as a space). Other columns are ignored.
    """
    text = text_of()
    want = F.sha2(F.replace(text, F.lit(MARK), F.lit(" ")).cast("binary"), 256)
    rows = docs.select("doc_id", text.alias("text"), F.char_length(text).cast("long").alias("n_chars"), want.alias("text_sha256"))
    found = encode(rows, model=model, keep=["doc_id", "n_chars", "text_sha256"], chunk_chars=chunk_chars)
    found = decode(found, model=model)
    decoded = F.sha2(F.col("decoded").cast("binary"), 256)
    found = found.select(
        "doc_id", "n_chars", "text_sha256",
        (F.octet_length("ids") / 4).cast("long").alias("n_pieces"),
        F.crc32("ids").alias("ids_crc32"),
        decoded.alias("decoded_sha256"),
    )
    return found.select(
        "doc_id", "n_chars", "n_pieces", "ids_crc32", "decoded_sha256",
        (F.col("decoded_sha256") == F.col("text_sha256")).alias("round_trip"),
    )
