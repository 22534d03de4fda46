"""Exact merge-type subword encoding by backtracking, and decoding.

The text is cut before each run of word marks, since no piece of such a vocabulary holds a mark after
another character, and at characters without a piece. What is left is encoded piece by piece: an
Aho-Corasick automaton gives the leftmost longest pieces, neighbours are accepted if merging their
joined text again gives just the two, and if not the last piece is replaced by its next shorter
prefix, with a field of flags to remember the positions where no encoding goes on. A sequence in which all
neighbours pass is the encoding that merging the whole text would give.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from loomframe.llm.common import Memo, slices

MARK = "▁"
#: Characters that the automaton is given at a time.
WINDOW = 512
#: Longer chunks are not remembered.
MEMO_CHARS = 256


class PieceModel:
    """Pieces, scores and byte pieces of a model file, and the two directions between text and ids."""

    def __init__(self, model: bytes):
        source = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = range(source.get_piece_size())
        special = {i for i in size if source.is_control(i) or source.is_unknown(i) or source.is_byte(i)}
        self.ids = {source.id_to_piece(i): i for i in size if i not in special}
        self.scores = {piece: source.get_score(i) for piece, i in self.ids.items()}
        self.bytes = {int(source.id_to_piece(i)[3:5], 16): i for i in size if source.is_byte(i)}
        self.unknown = source.unk_id()
        if any(MARK in piece.lstrip(MARK) for piece in self.ids):
            raise ValueError("a piece holds a word mark after another character")
        ties = {}
        for piece, score in self.scores.items():
            if len(piece) > 1:
                ties.setdefault(score, []).append(piece)
        #: Pieces of equal score merge by place, not by rank: text that can hold them is merged directly.
        self.tied = {piece for pieces in ties.values() if len(pieces) > 1 for piece in pieces}
        self.spelled = {piece for piece in self.ids if len(piece) == 1 or self.merge(piece) == [piece]}
        self.automaton = ahocorasick.Automaton()
        for piece in self.spelled:
            self.automaton.add_word(piece, piece)
        self.automaton.make_automaton()
        self.longest = max(map(len, self.spelled))
        best_first = sorted((p for p in self.ids if len(p) > 1), key=lambda p: -self.scores[p])
        self.ranks = {piece: rank for rank, piece in enumerate(best_first)}
        self.line_ends = "\n" not in self.ids  # a line end has no piece: it separates chunks too
        self.known = frozenset(p for p in self.ids if len(p) == 1)
        self.has_tied = re.compile("|".join(map(re.escape, sorted(self.tied)))).search if self.tied else lambda text: None
        self.shorter = Memo(self._shorter, 1 << 20)
        self.halves = Memo(self._halves, 1 << 20)
        self.fits = Memo(self._fits, 1 << 20)
        self.packed = Memo(self._packed, 600_000)
        pieces = [source.id_to_piece(i).replace(MARK, " ").encode() for i in size]
        for value, i in self.bytes.items():
            pieces[i] = bytes([value])
        for i in special - set(self.bytes.values()):
            pieces[i] = " ⁇ ".encode() if i == self.unknown else b""
        self.pieces = pieces

    def merge(self, text: str, stop: int = 1) -> list[str]:
        """Merge neighbours of the best score, leftmost first, until none is a piece or ``stop`` are left."""
        left_over = len(text)
        parts: list[str | None] = list(text)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(left: int) -> None:
            right = after[left]
            if right < len(parts) and (joined := parts[left] + parts[right]) in self.scores:
                heapq.heappush(heap, (-self.scores[joined], left, joined))

        for i in range(len(parts)):
            offer(i)
        while heap and left_over > stop:
            _, left, joined = heapq.heappop(heap)
            right = after[left] if parts[left] is not None else len(parts)
            if right >= len(parts) or parts[left] + parts[right] != joined:
                continue
            parts[left], parts[right] = joined, None
            left_over -= 1
            after[left] = after[right]
            if after[right] < len(parts):
                before[after[right]] = left
            offer(left)
            if before[left] >= 0:
                offer(before[left])
        return [part for part in parts if part is not None]

    def _shorter(self, piece: str) -> str | None:
        """The longest usable piece that is a proper prefix."""
        return next((piece[:n] for n in range(len(piece) - 1, 0, -1) if piece[:n] in self.spelled), None)

    def _halves(self, piece: str) -> tuple[str, str]:
        """The two parts whose merge gives the piece."""
        first, last = self.merge(piece, 2)
        return first, last

    def _fits(self, pair: tuple[str, str]) -> bool:
        """Would merging the joined text keep the border between two pieces?

        The merges on both sides are undone, latest first. If at any point the parts that touch the
        border are a piece together and better than every merge undone so far, merging would have
        crossed the border.
        """
        first, second = pair
        ranks, undone = self.ranks, len(self.ranks)
        while True:
            if ranks.get(first + second, undone) < undone:
                return False
            one, two = ranks.get(first, -1), ranks.get(second, -1)
            if one > two:
                undone, first = one, self.halves[first][1]
            elif two >= 0:
                undone, second = two + 1, self.halves[second][0]  # at equal rank the left place goes first
            else:
                return True

    def backtrack(self, text: str) -> list[str]:
        """Pieces of a text all of whose characters have one.

        The automaton looks at a window at a time, so going back costs a window and not the text before or after.
        """
        find, fits, longest, size = self.automaton.iter_long, self.fits, self.longest, len(text)
        window = max(WINDOW, 4 * longest)
        failed = bytearray(size + 1)  # positions from which no encoding goes on
        taken: list[str] = []
        at, last, sure, matches = 0, "", -1, None
        candidate: str | None = None
        while True:
            if candidate is None:
                if matches is None or at > sure:
                    # leftmost longest pieces; as all characters are pieces, they leave no gap
                    matches = find(text[at : at + window] if size > window else text, 0 if size > window else at)
                    sure = at + window - longest if at + window < size else size  # up to here a match is whole
                candidate = next(matches)[1]
            end = at + len(candidate)
            if not failed[end] and (not last or fits[last, candidate]):
                taken.append(candidate)
                at, last, candidate = end, candidate, None
                if at == size:
                    return taken
                continue
            matches = None
            candidate = self.shorter[candidate]
            while candidate is None:
                failed[at] = 1
                last = taken.pop()
                at -= len(last)
                candidate = self.shorter[last]
                last = taken[-1] if taken else ""

    def pieces_of(self, chunk: str) -> list[int]:
        """Ids of a chunk: a run of marks and what follows up to the next mark."""
        if self.known.issuperset(chunk):
            return self._ids_of(chunk)
        out: list[int] = []
        for part in re.split(f"([{re.escape(''.join(set(chunk) - self.known))}])", chunk):
            if part in self.known or len(part) > 1:
                out.extend(self._ids_of(part))
            elif part:
                out.extend([self.bytes[b] for b in part.encode()] if self.bytes else [self.unknown])
        return out

    def _ids_of(self, text: str) -> list[int]:
        return [self.ids[p] for p in (self.merge(text) if self.has_tied(text) else self.backtrack(text))]

    def _packed(self, chunk: str) -> bytes:
        return np.array(self.pieces_of(chunk), np.int32).tobytes()

    @staticmethod
    def _chunks(line: str) -> list[str]:
        """Cut before each run of marks."""
        first, *words = line.split(MARK)
        if "" in words:  # a longer run, or one at the end
            return re.findall(f"{MARK}+[^{MARK}]*|[^{MARK}]+", line)
        chunks = [MARK + word for word in words]
        return [first, *chunks] if first else chunks

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, np.int32)
        first, *others = text.split("\n") if self.line_ends else [text]
        chunks = self._chunks(MARK + first.replace(" ", MARK))
        for line in others:
            chunks.append("\n")
            if line:
                chunks += self._chunks(line.replace(" ", MARK))
        packed = self.packed
        return np.frombuffer(b"".join([packed[chunk] if len(chunk) <= MEMO_CHARS else self._packed(chunk) for chunk in chunks]), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        pieces = self.pieces
        text = b"".join([pieces[i] for i in ids.tolist()])
        return (text[1:] if text.startswith(b" ") else text).decode(errors="replace")


_MODELS: dict[int, PieceModel] = {}


def model_of(model: bytes) -> PieceModel:
    """One model per worker process."""
    key = hash(model)
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = PieceModel(model)
    return _MODELS[key]


def encode(df: DataFrame, model_path: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """Add the ids of each whole text, and with ``decoded`` also what the ids decode to.

    Columns of the same names are replaced, all others stay. A null or empty text has no ids and
    decodes to an empty text; repeated rows are encoded alike; an empty table gives an empty table.
    The model file is read once, by the driver, and broadcast (half a megabyte).
    """
    with open(model_path, "rb") as file:
        model = df.sparkSession.sparkContext.broadcast(file.read())
    df = df.drop(*[c for c in (ids, decoded) if c and c != text])
    fields = [*df.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))]
    fields += [T.StructField(decoded, T.StringType())] if decoded else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = model_of(model.value)
        for batch in slices(batches, text):
            found = [coder.encode(t) for t in batch.column(text).to_pylist()]
            offsets = np.cumsum([0, *map(len, found)], dtype=np.int32)
            columns = [*batch.columns, pa.ListArray.from_arrays(offsets, np.concatenate(found))]
            if decoded:
                columns.append(pa.array([coder.decode(x) for x in found], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    return df.mapInArrow(run, T.StructType(fields))


def decode(df: DataFrame, model_path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """Add the text of each array of ids (null or empty: empty)."""
    with open(model_path, "rb") as file:
        model = df.sparkSession.sparkContext.broadcast(file.read())
    df = df.drop(text)
    schema = T.StructType([*df.schema.fields, T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = model_of(model.value)
        for batch in batches:
            texts = [coder.decode(np.array(x or [], np.int32)) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], schema.names)

    return df.mapInArrow(run, schema)
