"""SentencePiece models on the tokenizers library.

The model file is parsed here and its parts are rebuilt: normaliser, word marker, merges or unigram scores and byte
fallback. Texts are encoded a batch at a time; each distinct word of a batch is encoded once, by several threads.
"""

from __future__ import annotations

import functools
import heapq
import os
import re
import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilnwork.llm.memory import release
from kilnwork.llm.near_dedup import batches_of
from kilnwork.llm.word_tokens import WordStore, grouped

MARK = "▁"
#: The types of pieces and models, and the field numbers, of the model format.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
_MARK_BYTES = MARK.encode()
#: Bytes of remembered words of a worker.
_REMEMBERED = 32 << 20


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field number and value of each entry of a protobuf message; nested messages are bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield key >> 3, data[at : at + size]
            at += size


@dataclass(frozen=True)
class Pieces:
    """A parsed model."""

    names: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: tuple[int, ...]
    model: int
    charsmap: bytes
    dummy_prefix: bool
    strip_spaces: bool

    @classmethod
    def parse(cls, data: bytes) -> Pieces:
        rows, trainer, normaliser = [], {}, {}
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
                rows.append((piece[1].decode(), score, piece.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normaliser = dict(_fields(value))
        names, scores, kinds = zip(*rows, strict=True)
        model = trainer.get(3, UNIGRAM)
        if model not in (UNIGRAM, BPE) or USER in kinds or not normaliser.get(5, 1):
            raise ValueError("only unigram and BPE models that mark spaces and have no user-defined pieces are supported")
        return cls(names, scores, kinds, model, normaliser.get(2, b""), bool(normaliser.get(3, 1)), bool(normaliser.get(4, 1)))

    @functools.cached_property
    def ids(self) -> dict[str, int]:
        return {n: i for i, n in enumerate(self.names)}

    @functools.cached_property
    def unknown(self) -> int:
        return self.kinds.index(UNKNOWN)

    @functools.cached_property
    def words_apart(self) -> bool:
        """No piece goes on after a word into the next, so that words can be encoded one by one."""
        return not any(MARK in n.lstrip(MARK) for n, k in zip(self.names, self.kinds, strict=True) if k == NORMAL)

    def merges(self) -> list[tuple[str, str]]:
        """Pairs that join to a piece, best piece first."""
        normal = {n: s for n, s, k in zip(self.names, self.scores, self.kinds, strict=True) if k == NORMAL}
        pairs = [(-s, self.ids[n], n[:i], n[i:]) for n, s in normal.items() for i in range(1, len(n)) if n[:i] in normal and n[i:] in normal]
        return [(a, b) for _, _, a, b in sorted(pairs)]

    def tied(self) -> frozenset[str]:
        """Pieces whose score another piece has too: which joins first then depends on the place, not on a rank."""
        seen: dict[float, list[str]] = {}
        for n, s, k in zip(self.names, self.scores, self.kinds, strict=True):
            if k == NORMAL and len(n) > 1:
                seen.setdefault(s, []).append(n)
        return frozenset(n for names in seen.values() if len(names) > 1 for n in names)

    def merge_word(self, word: str) -> list[int]:
        """Joins neighbours by best score, the leftmost first among equals: for words with tied pieces, and for tests."""
        parts: list[str | None] = list(word)
        right = [i + 1 for i in range(len(parts))]
        left = [i - 1 for i in range(len(parts))]
        heap: list[tuple[float, int, int, str]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < len(parts):
                whole = parts[i] + parts[j]
                k = self.ids.get(whole)
                if k is not None and self.kinds[k] == NORMAL:
                    heapq.heappush(heap, (-self.scores[k], i, j, whole))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, whole = heapq.heappop(heap)
            if parts[i] is None or j >= len(parts) or parts[j] is None or right[i] != j or parts[i] + parts[j] != whole:
                continue
            parts[i], parts[j] = whole, None
            right[i] = right[j]
            if right[i] < len(parts):
                left[right[i]] = i
            offer(left[i], i)
            offer(i, right[i])
        out: list[int] = []
        for part in filter(None, parts):
            k = self.ids.get(part)
            out += [k] if k is not None and self.kinds[k] == NORMAL else self._bytes_of(part)
        return out

    def _bytes_of(self, part: str) -> list[int]:
        got = [self.ids.get(f"<0x{b:02X}>") for b in part.encode()]
        return [self.unknown] if None in got else got

    def tokenizer(self):
        """The same model in the tokenizers library, for words whose spaces are marked already."""
        from tokenizers import Tokenizer, models

        fallback = BYTE in self.kinds
        if self.model == BPE:
            vocab = {n: i for n, i in self.ids.items()}
            model = models.BPE(vocab, self.merges(), unk_token=self.names[self.unknown], fuse_unk=True, byte_fallback=fallback)
        else:
            model = models.Unigram(list(zip(self.names, self.scores, strict=True)), self.unknown, fallback)
        return Tokenizer(model)

    def normaliser(self):
        from tokenizers import normalizers

        return normalizers.Precompiled(self.charsmap) if self.charsmap else None


class Codec:
    """Encodes and decodes lists of texts."""

    def __init__(self, pieces: Pieces):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
        self.pieces = pieces
        self._tokenizer = pieces.tokenizer()
        self._normaliser = pieces.normaliser()
        tied = pieces.tied() if pieces.model == BPE else frozenset()
        self._tied = re.compile("|".join(map(re.escape, sorted(tied)))) if tied else None
        # Where words can be told apart by the mark that each first piece begins with, many are encoded as one text.
        self._begins = np.array([n.startswith(MARK) for n in pieces.names])
        self._joins = pieces.model == BPE and pieces.words_apart
        self._store = WordStore(_REMEMBERED)
        self._bytes = [self._piece_bytes(n, k) for n, k in zip(pieces.names, pieces.kinds, strict=True)]

    @staticmethod
    def _piece_bytes(name: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(name[3:5], 16)])
        if kind == CONTROL:
            return b""
        return " \N{DOUBLE QUESTION MARK} ".encode() if kind == UNKNOWN else name.replace(MARK, " ").encode()

    def marked(self, text: str) -> str:
        """The text as the model sees it: normalised, with marks for spaces."""
        if self._normaliser:
            text = self._normaliser.normalize_str(text)
        if self.pieces.strip_spaces:
            text = re.sub(" +", " ", text).strip(" ")
        if text and self.pieces.dummy_prefix:
            text = f" {text}"
        return text.replace(" ", MARK)

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        """Token ids of each text, as 32-bit integers; none for an empty text."""
        coded = [self.marked(t).encode("utf-8", "replace") for t in texts]
        raw = b"".join([*coded, b"\0" * 8])
        bounds = np.cumsum([0, *map(len, coded)])
        first = np.zeros(len(raw) - 7, bool)
        first[bounds] = True
        if self.pieces.words_apart:
            data = np.frombuffer(raw, np.uint8)[: len(raw) - 8]
            mark = np.zeros(len(data) + 3, bool)  # three places further on than the marks are
            mark[3:-2] = (data[:-2] == _MARK_BYTES[0]) & (data[1:-1] == _MARK_BYTES[1]) & (data[2:] == _MARK_BYTES[2])
            first[: len(data)] |= mark[3:] & ~mark[:-3]
        starts = np.flatnonzero(first)
        starts, ends = starts[:-1], starts[1:]
        out, upto = self._store.ids(raw, starts, ends, self._learn)
        cuts = upto[np.searchsorted(starts, bounds)]
        return [out[a:b].astype(np.int32) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def _learn(self, words: list[bytes], place: np.ndarray) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
        plain = [not (self._tied and self._tied.search(w.decode("utf-8", "replace"))) for w in words]
        tied = [i for i, p in enumerate(plain) if not p]
        if tied:
            got = [self.pieces.merge_word(words[i].decode("utf-8", "replace")) for i in tied]
            yield tied, np.array([k for g in got for k in g], "<u4"), np.array([len(g) for g in got], np.int64)
        joins = [p and self._joins and w.startswith(_MARK_BYTES) and not w.startswith(_MARK_BYTES, 3) for w, p in zip(words, plain, strict=True)]
        together, alone = ([i for i, (p, j) in enumerate(zip(plain, joins, strict=True)) if p and j == wanted] for wanted in (True, False))
        yield from grouped(words, together, alone, b"", self._plain, self._word_ends)

    def _word_ends(self, ids: np.ndarray) -> np.ndarray:
        begins = np.flatnonzero(self._begins[ids])
        return np.append(begins[1:], len(ids)) if len(begins) and not begins[0] else begins[:0]

    def _plain(self, words: list[bytes], joined: bool) -> list[np.ndarray]:
        got = self._tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in words], add_special_tokens=False)
        return [np.array(e.ids, "<u4") for e in got]

    def forget(self) -> None:
        """Drop the remembered words: a worker goes on to other tasks, perhaps of other stages."""
        self._store.forget()

    def decode(self, ids: Sequence[int]) -> str:
        """The text of token ids; bytes that are no UTF-8 become replacement characters."""
        table = self._bytes
        text = b"".join([table[i] for i in (ids.tolist() if isinstance(ids, np.ndarray) else ids)]).decode("utf-8", "replace")
        return text[1:] if self.pieces.dummy_prefix and text.startswith(" ") else text


@functools.lru_cache(maxsize=2)
def codec(model: bytes) -> Codec:
    """One codec for each model and worker process."""
    return Codec(Pieces.parse(model))


def read_model(path: str) -> bytes:
    """A model file's bytes, which go to the tasks with the function; models are a few MB at most."""
    with open(path, "rb") as file:
        data = file.read(64 << 20 | 1)
    if len(data) > 64 << 20:
        raise ValueError(f"{path} is too large for a model file")
    return data


def encode(
    docs: DataFrame, model: bytes, text: str = "text", keep: Sequence[str] = ("doc_id",), parity_every: int = 1
) -> DataFrame:
    """``keep`` columns with ``ids``, ``n_tokens``, ``n_bytes``, ``round_trip`` and ``parity``, one row for each of ``docs``.

    ``round_trip``: decoding the ids gives the text. Empty and null texts have no ids and round-trip (null as empty).
    A text with the mark itself decodes to a space there, and one that the model's normaliser changes stays changed;
    both are told by ``round_trip``. ``parity``: whether the sentencepiece library gives the same ids for the whole
    text, checked for every text unless ``parity_every`` asks for one in so many by hash (0: none); null for the others.
    """
    names = [f"k{i}" for i in range(len(keep))]
    body = F.coalesce(F.col(text), F.lit(""))
    compared = F.lit(False) if not parity_every else F.pmod(F.xxhash64(body), F.lit(parity_every)) == 0
    source = docs.select(
        *(F.col(c).alias(n) for c, n in zip(keep, names, strict=True)), body.alias("text"), compared.alias("compared")
    )
    fields = [f"{n} {source.schema[n].dataType.simpleString()}" for n in names]
    fields += ["ids array<int>", "n_tokens int", "n_bytes bigint", "round_trip boolean", "parity boolean"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        release()
        own = codec(model)
        other = sentencepiece.SentencePieceProcessor(model_proto=model)
        for batch in batches:
            release()
            for part in batches_of(batch, 1 << 20):
                texts, compare = part.column("text").to_pylist(), part.column("compared").to_pylist()
                got = own.encode(texts)
                sizes = np.array([len(g) for g in got], np.int32)
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                columns = [
                    *(part.column(n) for n in names),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(got))),
                    pa.array(sizes),
                    pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array([own.decode(g) == t for g, t in zip(got, texts, strict=True)]),
                    pa.array(
                        [other.encode(t) == g.tolist() if c else None for g, t, c in zip(got, texts, compare, strict=True)],
                        pa.bool_(),
                    ),
                ]
                yield pa.RecordBatch.from_arrays(columns, [f.split(" ")[0] for f in fields])
        own.forget()
        release()

    out = source.mapInArrow(run, ", ".join(fields))
    return out.withColumnsRenamed(dict(zip(names, keep, strict=True)))


def decode(encoded: DataFrame, model: bytes, ids: str = "ids", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with ``text``, decoded from the ids; null ids give an empty text."""
    names = [f"k{i}" for i in range(len(keep))]
    source = encoded.select(*(F.col(c).alias(n) for c, n in zip(keep, names, strict=True)), F.coalesce(F.col(ids), F.array().cast("array<int>")).alias("ids"))
    fields = [f"{n} {source.schema[n].dataType.simpleString()}" for n in names] + ["text string"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in batches:
            texts = pa.array([own.decode(i) for i in batch.column("ids").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), texts], [*names, "text"])

    return source.mapInArrow(run, ", ".join(fields)).withColumnsRenamed(dict(zip(names, keep, strict=True)))
