"""Token ids of many texts by a vocabulary whose words are apart from each other.

White space is dropped and no token reaches over it, so that the ids of a text are those of its words in a row. The
words of many texts are cut and told apart in NumPy; each different one is given to the tokenizers library once.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import tokenizers

from kilnwork.llm.shingles import ODD, mix

#: How the vocabulary's file says that words are apart.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_WORD_END = "</w>"
#: Bytes of text cut at a time, and of remembered words.
_AT_A_TIME = 1 << 20
_REMEMBERED = 48 << 20
#: Longer words are told apart by their bytes; shorter ones by a 64-bit hash.
_HASHED = 64
_TOGETHER = 256

_SPACE, _LETTER, _DIGIT, _SIGN, _WHOLE = range(5)


def _kinds() -> np.ndarray:
    """Words are cut into letters, single digits and runs of signs.

    Those with a control character or a bar, which special tokens have, stay whole.
    """
    kinds = np.full(256, _WHOLE, np.uint8)
    for i in range(33, 127):
        kinds[i] = _LETTER if chr(i).isalpha() else _DIGIT if chr(i).isdigit() else _SIGN
    kinds[ord("|")] = _WHOLE
    kinds[[9, 10, 11, 12, 13, 32]] = _SPACE
    return kinds


_KIND = _kinds()
#: First letters of the endings that the vocabulary cuts off after an apostrophe.
_ENDING = np.isin(np.arange(256), [*b"stmdrlvSTMDRLV"])


class WordStore:
    """Ids of the different words seen so far, up to a bound in bytes."""

    def __init__(self, limit: int = _REMEMBERED):
        self._limit = limit
        self.forget()

    def forget(self) -> None:
        """Drop the remembered words: a worker goes on to other tasks."""
        self._slot: dict[int | bytes, int] = {}
        self._pool = [np.zeros(0, "<u4")]
        self._sizes = [np.zeros(0, np.int64)]
        self._held = 0

    def ids(self, raw: bytes, starts: np.ndarray, ends: np.ndarray, learn: Learner) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words ``raw[start:end]`` in a row, and the number of ids up to each word. ``raw`` ends with eight more bytes."""
        keys = _keys(raw, starts, ends - starts)
        different, at, number = np.unique(keys, return_index=True, return_inverse=True)
        names: list[int | bytes] = different.tolist()
        for i in np.flatnonzero((ends - starts)[at] > _HASHED).tolist():
            names[i] = raw[starts[at[i]] : ends[at[i]]]
        if self._held > self._limit:
            self.forget()
        slots = np.array([self._slot.get(name, -1) for name in names], np.int64)
        new = np.flatnonzero(slots < 0)
        if len(new):
            place = at[new]
            words = [raw[a:b] for a, b in zip(starts[place].tolist(), ends[place].tolist(), strict=True)]
            kept = len(self._slot)
            order = []
            for some, ids, sizes in learn(words, place):
                order += some
                self._pool.append(ids)
                self._sizes.append(sizes)
            self._slot.update(zip([names[new[i]] for i in order], range(kept, kept + len(order)), strict=True))
            self._held += sum(120 + len(w) for w in words)
            slots[new[order]] = np.arange(kept, kept + len(order))
        sizes, ids = np.concatenate(self._sizes), np.concatenate(self._pool)
        self._sizes, self._pool = [sizes], [ids]
        before = np.cumsum(sizes) - sizes
        mine = slots[number]
        took = sizes[mine]
        upto = np.cumsum(took)
        out = ids[np.repeat(before[mine] - (upto - took), took) + np.arange(upto[-1] if len(upto) else 0)]
        return out, np.concatenate([[0], upto])


# Learns words, given with their places: numbers of words, their ids in a row, and how many each has.
Learner = Callable[[list[bytes], np.ndarray], Iterator[tuple[list[int], np.ndarray, np.ndarray]]]


def grouped(
    words: list[bytes], together: list[int], alone: list[int], joint: bytes, encode: Callable[[list[bytes], bool], list[np.ndarray]], edges: Callable[[np.ndarray], np.ndarray]
) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """A learner's answer: words that can be told apart in joined texts by the edges of their ids, and words one by one.

    ``encode`` says the ids of texts, of joined ones or of single words; ``edges`` where the ids of each word end. Joined
    words that do not come apart are taken one by one.
    """
    groups = [together[i : i + _TOGETHER] for i in range(0, len(together), _TOGETHER)]
    for group, got in zip(groups, encode([joint.join([words[i] for i in g]) for g in groups], True), strict=True):
        ends = edges(got)
        if len(ends) == len(group):
            yield group, got, np.diff(ends, prepend=0)
        else:
            alone = alone + group
    for at in range(0, len(alone), 1024):
        some = alone[at : at + 1024]
        got = encode([words[i] for i in some], False)
        yield some, np.concatenate(got), np.array([len(g) for g in got], np.int64)


class WordTokens:
    """Encodes texts as the library does, without special tokens around them."""

    def __init__(self, model: str):
        self._tokenizer = tokenizers.Tokenizer.from_str(model)
        form = json.loads(model)
        parts = (form.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        steps = [n.get("type") for n in (form.get("normalizer") or {}).get("normalizers") or []]
        cut = (parts[0].get("pattern") or {}).get("Regex"), parts[0].get("behavior"), parts[0].get("invert")
        self._apart = (
            cut == (_SPLIT, "Removed", True) and form["model"].get("end_of_word_suffix") == _WORD_END and steps == ["NFC", "Replace", "Lowercase"]
        )
        # The same merges without what cutting has done already, for words that are cut.
        marks = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
        steps = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, marks]}
        short = {**form, "normalizer": {"type": "Lowercase"}, "pre_tokenizer": steps, "added_tokens": []} if self._apart else form
        self._short = tokenizers.Tokenizer.from_str(json.dumps(short))
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self._ends[[i for token, i in vocabulary.items() if token.endswith(_WORD_END)]] = True
        self._store = WordStore()

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        """Ids of each text as unsigned 32-bit integers; none for an empty text."""
        if not self._apart:
            return [np.array(e.ids, "<u4") for e in self._tokenizer.encode_batch(list(texts), add_special_tokens=False)]
        parts, owner = [], []
        for i, text in enumerate(texts):
            for part in _slices(text.encode("utf-8", "replace")):
                parts.append(part)
                owner.append(i)
        out: list[list[np.ndarray]] = [[] for _ in texts]
        at = 0
        while at < len(parts):
            end, size = at + 1, len(parts[at])
            while end < len(parts) and size + len(parts[end]) <= _AT_A_TIME:
                size += len(parts[end])
                end += 1
            for i, ids in zip(owner[at:end], self._cut(parts[at:end]), strict=True):
                out[i].append(ids)
            at = end
        return [np.concatenate(p) if len(p) != 1 else p[0] for p in ([*o] or [np.zeros(0, "<u4")] for o in out)]

    def forget(self) -> None:
        self._store.forget()

    def _cut(self, coded: list[bytes]) -> list[np.ndarray]:
        raw = b"\n".join([b"", *coded, b"\0" * 8])
        n = len(raw) - 8
        data = np.frombuffer(raw, np.uint8)[:n]
        kind = _kind_of(data)
        space = kind == _SPACE
        edge = np.flatnonzero(space[:-1] != space[1:]) + 1
        edge = edge if space[-1] else np.append(edge, n)
        begins, stops = edge[::2], edge[1::2]
        wholes = np.flatnonzero(kind == _WHOLE)
        whole = np.searchsorted(wholes, stops) > np.searchsorted(wholes, begins)
        for a, b in zip(begins[whole].tolist(), stops[whole].tolist(), strict=True):
            kind[a:b] = _WHOLE
        first = np.empty(n, bool)
        first[0] = False
        first[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        edges = np.flatnonzero(first)
        real = kind[edges] != _SPACE
        starts, ends = edges[real], np.append(edges[1:], n)[real]
        uncut = kind[starts] == _WHOLE
        out, upto = self._store.ids(raw, starts, ends, functools.partial(self._learn, uncut))
        bounds = np.cumsum([1, *(len(c) + 1 for c in coded)])
        cuts = upto[np.searchsorted(starts, bounds)]
        return [out[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def _learn(self, uncut: np.ndarray, words: list[bytes], place: np.ndarray) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
        whole = uncut[place]
        edges = lambda ids: np.flatnonzero(self._ends[ids]) + 1
        return grouped(words, np.flatnonzero(~whole).tolist(), np.flatnonzero(whole).tolist(), b" ", self._plain, edges)

    def _plain(self, words: list[bytes], joined: bool) -> list[np.ndarray]:
        tokenizer = self._short if joined else self._tokenizer
        got = tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in words], add_special_tokens=False)
        return [np.array(e.ids, "<u4") for e in got]


def _kind_of(data: np.ndarray) -> np.ndarray:
    """Kinds of bytes. Of what is beyond ASCII, the letters of the Latin-1 block are letters and the rest keeps words whole."""
    kind = _KIND[data]
    kind[:-1][(data[:-1] == ord("'")) & _ENDING[data[1:]]] = _WHOLE
    lead = np.flatnonzero(data[:-1] == 0xC3)
    after = data[lead + 1]
    lead = lead[(after != 0x97) & (after != 0xB7)]
    kind[lead] = kind[lead + 1] = _LETTER
    return kind


def _keys(raw: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A hash of each word by eight bytes at a time; of longer words than :data:`_HASHED` a number of their own each."""
    eights = np.ndarray((len(raw) - 7,), "<u8", raw, 0, (1,))
    masks = np.array([(1 << 8 * k) - 1 for k in range(8)] + [2**64 - 1], np.uint64)
    keys = mix((eights[starts] & masks[np.minimum(sizes, 8)]) + ODD)
    for k in range(8, _HASHED, 8):
        more = np.flatnonzero(sizes > k)
        if not len(more):
            break
        keys[more] = mix(keys[more] * ODD + (eights[starts[more] + k] & masks[np.minimum(sizes[more] - k, 8)]))
    long = np.flatnonzero(sizes > _HASHED)
    keys[long] = starts[long]
    return keys


def _slices(data: bytes) -> Iterator[bytes]:
    """A long text in parts, cut at white space; a longer run without any stays whole."""
    at = 0
    while len(data) - at > _AT_A_TIME:
        cut = max(data.rfind(b" ", at, at + _AT_A_TIME), data.rfind(b"\n", at, at + _AT_A_TIME))
        if cut <= at:
            found = [x for x in (data.find(b" ", at + _AT_A_TIME), data.find(b"\n", at + _AT_A_TIME)) if x >= 0]
            if not found:
                break
            cut = min(found)
        yield data[at:cut]
        at = cut
    yield data[at:]


@functools.lru_cache(maxsize=2)
def word_tokens(model: str) -> WordTokens:
    """One for each vocabulary and worker process."""
    return WordTokens(model)
