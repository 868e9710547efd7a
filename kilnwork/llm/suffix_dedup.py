"""Removal of repeated passages by longest previous factors.

A byte goes if a string of 50 bytes that covers it also starts in a document with a smaller id. Suffixes that share an
anchor (the least hashed 24-byte string of a 50-byte window) meet in one task and are sorted there. In suffix order,
the nearest positions before and after with a smaller document are where the longest previous factor lies; if it has
50 bytes, the window is a later copy.

Only anchors that occur in more than one document have their windows compared, so the work between tasks follows the
repeated part of the corpus, not its length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kilnwork.llm.memory import release
from kilnwork.llm.shingles import INVERSE, ODD, mix, powers
from kilnwork.session import materialise

WINDOW, ANCHOR = 50, 24
_SLICE = 1 << 20
_SORTED = 1 << 18
#: Fewer documents than these never make an anchor hot.
HOT_DOCUMENTS = 1000
#: Rows of a document id that is repeated are told apart by this many high bits of their positions.
_ROW = 40


def string_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` bytes from each position."""
    power, base, width = data.astype(np.uint64) + np.uint64(1), int(ODD), 1
    out, done = None, 0
    while True:
        if length & width:
            if out is None:
                out = power
            else:
                n = len(data) - done - width + 1
                out = out[:n] * np.uint64(base) + power[done : done + n]
            done += width
        if done == length:
            return mix(out)
        n = len(power) - width
        power = power[:n] * np.uint64(base) + power[width : width + n]
        base, width = base * base % 2**64, width * 2


class Anchors:
    """Runs of windows of some texts that share their anchor: owner (text), hash, first window and number of windows.

    Windows are given by their first byte in ``data``, which holds the texts one after another.
    """

    def __init__(self, texts: Sequence[bytes]):
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.array([len(t) for t in texts], np.int64)
        self.begins = np.cumsum(sizes) - sizes
        if len(self.data) < WINDOW:
            self.owner = self.first = self.count = np.empty(0, np.int64)
            self.hash = np.empty(0, np.uint64)
            return
        least = string_hashes(self.data, ANCHOR)
        hashes, place = least, np.arange(len(least), dtype=np.int32)
        width, wanted = 1, WINDOW - ANCHOR + 1
        while width < wanted:  # the leftmost least hash of ever wider ranges
            step = min(width, wanted - width)
            left, right = least[:-step], least[step:]
            place = np.where(right < left, place[step:], place[:-step])
            least = np.minimum(left, right)
            width += step
        owner = np.repeat(np.arange(len(sizes)), np.maximum(sizes - WINDOW + 1, 0))
        starts = np.arange(len(owner)) - np.repeat(np.cumsum(np.maximum(sizes - WINDOW + 1, 0)) - np.maximum(sizes - WINDOW + 1, 0), np.maximum(sizes - WINDOW + 1, 0))
        starts = starts + self.begins[owner]
        place = place[starts]
        new = np.ones(len(starts), bool)
        new[1:] = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])
        at = np.flatnonzero(new)
        self.owner, self.first, self.hash = owner[at], starts[at], hashes[place[at]]
        self.count = np.diff(np.append(at, len(starts)))


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... for count[0] values, then the same for the next."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - count, count) + np.repeat(first, count)


def previous_factor_reached(data: np.ndarray, starts: np.ndarray, docs: np.ndarray, length: int = WINDOW) -> np.ndarray:
    """For each suffix of ``data``: does its longest factor in a smaller document have ``length`` bytes or more?

    Suffixes are sorted by their first ``length`` bytes. The longest previous factor of a suffix begins at the nearest
    suffix before or after it, in this order, whose document is smaller; the common prefix with that one is long enough
    if and only if no shorter one lies between.
    """
    out = np.zeros(len(starts), bool)
    if not len(starts):
        return out
    # Suffixes without an equal hash can't be reached and need no sorting.
    hashes = _window_hashes(data, starts, length)
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    twin = np.zeros(len(order), bool)
    twin[1:] |= same
    twin[:-1] |= same
    chosen = order[twin]
    ends = np.flatnonzero(np.append(hashes[chosen][1:] != hashes[chosen][:-1], True)) + 1 if len(chosen) else []
    at = 0
    while at < len(chosen):  # a few at a time, equal ones together
        to = int(ends[min(np.searchsorted(ends, at + _SORTED), len(ends) - 1)])
        out[chosen[at:to]] = _reached(data, starts[chosen[at:to]], docs[chosen[at:to]], length)
        at = to
    return out


def _window_hashes(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    out = np.empty(len(starts), np.uint64)
    for at in range(0, len(starts), _SORTED):
        part = starts[at : at + _SORTED]
        low = part.min()
        out[at : at + _SORTED] = _hashes_at(data[low : part.max() + length], part - low, length)
    return out


def _hashes_at(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Hashes of ``length`` bytes by differences of one running sum, for a few starts among many bytes."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(INVERSE, len(data)), out=sums[1:])
    return mix((sums[starts + length] - sums[starts]) * powers(ODD, len(data))[starts])


def _reached(data: np.ndarray, starts: np.ndarray, docs: np.ndarray, length: int) -> np.ndarray:
    """Sorts suffixes and looks both ways for a smaller document within the common prefix."""
    _, values = np.unique(docs, return_inverse=True)
    # Eight bytes from any position as one number that sorts like them; the last overlaps the one before.
    wide = np.ndarray((len(data) - 7,), ">u8", data, strides=(1,))
    words = [wide[starts + min(k, length - 8)].astype(np.uint64) for k in range(0, length, 8)]
    order = np.lexsort(words[::-1])
    values = values[order]
    apart = np.zeros(len(order), bool)  # common prefix with the suffix before is shorter
    apart[0] = True
    for word in words:
        apart[1:] |= word[order][1:] != word[order][:-1]
    run = np.cumsum(apart)
    span = values.max() + 1
    # Each later run lies wholly below the one before, so a running minimum starts anew in each.
    falling = values - run * span
    before = np.minimum.accumulate(falling) < falling
    rising = values + run * span
    after = np.minimum.accumulate(rising[::-1])[::-1] < rising
    out = np.empty(len(starts), bool)
    out[order] = before | after
    return out


def _pieces_of(by: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The columns' rows for each value of ``by``."""
    if not len(by):
        return
    order = np.argsort(by, kind="stable")
    by = by[order]
    at = np.flatnonzero(np.concatenate([[True], by[1:] != by[:-1]]))
    for a, b in zip(at, [*at[1:], len(by)], strict=True):
        yield int(by[a]), [c[order[a:b]] for c in columns]


def _table(names: Sequence[str], rows: list[list]) -> pa.Table:
    kinds = [pa.int32(), *[pa.binary()] * (len(names) - 1)]
    return pa.table([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], list(names))


def _packed(values: np.ndarray | bytes) -> bytes:
    """The values' bytes, compressed, behind their number."""
    data = values if isinstance(values, bytes) else values.tobytes()
    return len(data).to_bytes(4, "little") + pa.compress(data, "zstd", asbytes=True)


def _unpacked(data: bytes) -> bytes:
    return pa.decompress(data[4:], int.from_bytes(data[:4], "little"), "zstd", asbytes=True)


def _with_packed_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts move between tasks twice; packed they are half as large as what a shuffle makes of them."""
    for batch in batches:
        release()
        packed = pa.array([_packed(t.encode()) for t in batch.column("text").to_pylist()], pa.binary())
        yield batch.set_column(batch.schema.get_field_index("text"), "text", packed)


def _joined(table: pa.Table, name: str, kind: str, packed: bool = False) -> np.ndarray:
    parts = table.column(name).to_pylist()
    if packed:
        parts = [_unpacked(p) for p in parts]
    return np.frombuffer(b"".join(parts), kind)


def _slices(texts: Sequence[bytes], size: int = _SLICE) -> Iterator[tuple[int, int]]:
    """First and last + 1 of runs of texts of about ``size`` bytes."""
    at = held = 0
    for i, t in enumerate(texts):
        if i > at and held + len(t) > size:
            yield at, i
            at, held = i, 0
        held += len(t)
    if at < len(texts):
        yield at, len(texts)


class _Job:
    """The steps' functions, with the number of buckets for anchors and for documents."""

    def __init__(self, buckets: int, groups: int):
        self.buckets, self.groups = buckets, groups

    def split(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bucket and 32 further bits of anchors: enough to find those in two documents; chance equals do no harm."""
        return (hashes % np.uint64(self.buckets)).astype(np.int64), (hashes // np.uint64(self.buckets)).astype(np.uint32)

    def group_of(self, docs: np.ndarray) -> np.ndarray:
        return docs % self.groups

    def anchors(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each document's anchors, by bucket. What a slice knows to be shared goes past the buckets, leaving a witness."""
        for batch in batches:
            release()
            docs_of, texts_of = batch.column("doc").to_numpy(), [t.encode() for t in batch.column("text").to_pylist()]
            for a, b in _slices(texts_of):
                found = Anchors(texts_of[a:b])
                docs = docs_of[a:b][found.owner]
                bucket, bits = self.split(found.hash)
                order = np.lexsort((docs, bits, bucket))
                docs, bucket, bits = docs[order], bucket[order], bits[order]
                key_new = np.ones(len(docs), bool)
                key_new[1:] = (bucket[1:] != bucket[:-1]) | (bits[1:] != bits[:-1])
                new = key_new.copy()
                new[1:] |= docs[1:] != docs[:-1]
                docs, bucket, bits, key_new = docs[new], bucket[new], bits[new], key_new[new]
                n_docs = np.diff(np.append(np.flatnonzero(key_new), len(docs)))
                shared = np.repeat(n_docs > 1, n_docs)
                rows = []
                # Witnesses: the least document of each key, and how many documents it stands for.
                weight = np.repeat(n_docs, n_docs)
                order = np.argsort(docs[key_new], kind="stable")  # equal documents side by side pack well
                sent = (c[key_new][order] for c in (bucket, docs, bits, weight.astype(np.uint32)))
                for to, (d, h, w) in _pieces_of(*sent):
                    rows.append([to, b"", _packed(d), h.tobytes(), _packed(w)])
                codes = self.code(bucket[shared], bits[shared], docs[shared])
                for to, (c,) in _pieces_of(self.group_of(docs[shared]), codes):
                    rows.append([self.buckets + to, c.tobytes(), b"", b"", b""])
                yield from _table(("bucket", "codes", "docs", "bits", "weights"), rows).to_batches()

    def shared(self, hot: int):
        def run(table: pa.Table) -> pa.Table:
            """Codes of the documents' anchors that have two documents or more, by group of documents."""
            bucket = table.column("bucket")[0].as_py()
            names = ("grp", "codes")
            if bucket >= self.buckets:
                return _table(names, [[bucket - self.buckets, b"".join(table.column("codes").to_pylist())]])
            docs, bits, weight = _joined(table, "docs", "<i8", True), _joined(table, "bits", "<u4"), _joined(table, "weights", "<u4", True)
            order = np.lexsort((docs, bits))
            docs, bits, weight = docs[order], bits[order], weight[order].astype(np.int64)
            at = np.flatnonzero(np.concatenate([[True], bits[1:] != bits[:-1]]))
            count = np.diff(np.append(at, len(bits)))
            many = np.repeat(docs[at] != docs[at + count - 1], count)
            total = np.add.reduceat(weight, at)
            of = np.full(len(bits), bucket)
            codes = self.code(of[many], bits[many], docs[many])
            rows = [[to, c.tobytes()] for to, (c,) in _pieces_of(self.group_of(docs[many]), codes)]
            very = bits[at][total >= hot]
            if len(very):
                rows.append([-1, self.code(of[: len(very)], very).tobytes()])
            return _table(names, rows)

        return run

    def windows(self, hot: np.ndarray):
        """``hot``: sorted codes of anchors so frequent that their windows are dealt out one by one."""

        def run(texts: pa.Table, shared: pa.Table) -> pa.Table:
            """The windows of shared anchors by bucket, and by group those that this task finds to be later copies."""
            release()
            docs_of, texts_of, row_of = self.ordered(texts)
            known = np.unique(_joined(shared, "codes", "<u8"))
            parts = []
            for a, b in _slices(texts_of):
                found = Anchors(texts_of[a:b])
                bucket, bits = self.split(found.hash)
                docs = docs_of[a:b][found.owner]
                use = np.isin(self.code(bucket, bits, docs), known)
                first, count = found.first[use], found.count[use]
                owner, bucket, bits = found.owner[use], bucket[use], bits[use]
                length = count + WINDOW - 1
                position = first - found.begins[owner] + (row_of[a:b][owner] << _ROW)
                parts.append((docs[use], bucket, bits, position, count, length, found.data[_ranges(first, length)]))
            if not parts:
                return _table(("bucket", "docs", "starts", "counts", "data"), [])
            docs, bucket, bits, position, count, length, data = (np.concatenate(c) for c in zip(*parts, strict=True))
            begin = np.cumsum(length) - length
            return self.send(docs, bucket, bits, position, count, begin, data, hot)

        return run

    def send(self, docs, bucket, bits, position, count, begin, data, hot) -> pa.Table:
        every = np.repeat(np.arange(len(docs)), count)
        starts = _ranges(begin, count)
        # Only anchors that two of these documents share can have copies here.
        keys, back = np.unique(self.code(bucket, bits), return_inverse=True)
        least, most = np.full(len(keys), np.iinfo(np.int64).max), np.full(len(keys), np.iinfo(np.int64).min)
        np.minimum.at(least, back, docs)
        np.maximum.at(most, back, docs)
        twice = (least < most)[back][every]
        gone = np.zeros(len(starts), bool)
        gone[twice] = previous_factor_reached(data, starts[twice], docs[every][twice])
        where = position[every] + starts - begin[every]
        rows = []
        self.put_removed(rows, docs[every][gone], where[gone])
        left = ~gone
        every, starts, where = every[left], starts[left], where[left]
        single = np.isin(self.code(bucket[every], bits[every]), hot)
        # Windows of hot anchors go by their own hash; the others stay in runs, which share their bytes.
        run_new = np.ones(len(every), bool)
        run_new[1:] = (every[1:] != every[:-1]) | (starts[1:] != starts[:-1] + 1) | single[1:]
        at = np.flatnonzero(run_new)
        size = np.diff(np.append(at, len(every)))
        to = bucket[every[at]]
        alone = single[at]
        if alone.any():
            to[alone] = (_window_hashes(data, starts[at[alone]], WINDOW) % np.uint64(self.buckets)).astype(np.int64)
        for bucket_to, (d, w, n, s) in _pieces_of(to, docs[every[at]], where[at], size, starts[at]):
            content = data[_ranges(s, n + WINDOW - 1)]
            rows.append([bucket_to, _packed(d), _packed(w), n.astype(np.uint8).tobytes(), _packed(content)])
        return _table(("bucket", "docs", "starts", "counts", "data"), rows)

    def put_removed(self, rows: list, docs: np.ndarray, where: np.ndarray) -> None:
        """Windows found to be later copies, as runs, for the group of their document."""
        order = np.lexsort((where, docs))
        docs, where = docs[order], where[order]
        new = np.ones(len(docs), bool)
        new[1:] = (docs[1:] != docs[:-1]) | (where[1:] > where[:-1] + 1)
        at = np.flatnonzero(new)
        last = np.append(at[1:], len(docs)) - 1
        docs, low, size = docs[at], where[at], (where[last] - where[at] + 1 if len(at) else np.empty(0, np.int64))
        for to, (d, w, n) in _pieces_of(self.group_of(docs), docs, low, size):
            rows.append([self.buckets + to, _packed(d), _packed(w), _packed(n), b""])

    def copies(self, table: pa.Table) -> pa.Table:
        """Runs of windows that are later copies, by group of documents."""
        release()
        bucket = table.column("bucket")[0].as_py()
        names = ("grp", "docs", "starts", "sizes")
        if bucket >= self.buckets:
            return _table(names, [[bucket - self.buckets, *row] for row in zip(*(table.column(n).to_pylist() for n in ("docs", "starts", "counts")), strict=True)])
        docs, position = _joined(table, "docs", "<i8", True), _joined(table, "starts", "<i8", True)
        count, data = _joined(table, "counts", "u1").astype(np.int64), _joined(table, "data", "u1", True)
        length = count + WINDOW - 1
        begin = np.cumsum(length) - length
        every, starts = np.repeat(np.arange(len(docs)), count), _ranges(begin, count)
        gone = previous_factor_reached(data, starts, docs[every])
        rows: list[list] = []
        self.put_removed(rows, docs[every][gone], (position[every] + starts - begin[every])[gone])
        return _table(names, [[r[0] - self.buckets, *r[1:4]] for r in rows])

    def remove(self, keep: Sequence[str], schema: pa.Schema):
        def run(texts: pa.Table, copies: pa.Table) -> pa.Table:
            """Every row with its removed spans and what is left."""
            release()
            docs_of, texts_of, row_of, order = self.ordered(texts, True)
            docs, starts, sizes = (_joined(copies, n, "<i8", True) for n in ("docs", "starts", "sizes"))
            at = np.lexsort((starts, docs))
            docs, starts, sizes = docs[at], starts[at], sizes[at]
            spans_of, left_of, removed_of = [], [], []
            missing = texts.column("doc").is_null().to_numpy()[order]
            for doc, text, row, no_key in zip(docs_of, texts_of, row_of, missing, strict=True):
                spans, left, end = [], [], 0
                if not no_key:
                    a, b = np.searchsorted(docs, doc, side="left"), np.searchsorted(docs, doc, side="right")
                    for s, n in zip(starts[a:b].tolist(), sizes[a:b].tolist(), strict=True):
                        if s >> _ROW != row:
                            continue
                        low, high = s & ((1 << _ROW) - 1), (s & ((1 << _ROW) - 1)) + n - 1 + WINDOW
                        if spans and low <= spans[-1]["end"]:
                            spans[-1]["end"] = max(high, spans[-1]["end"])
                        else:
                            spans.append({"start": low, "end": high})
                for span in spans:
                    left.append(text[end : span["start"]])
                    end = span["end"]
                left.append(text[end:])
                spans_of.append(spans)
                left_of.append(b"".join(left))
                removed_of.append(len(text) - len(left_of[-1]))
            source = texts.take(pa.array(order))
            columns = [source.column(c) for c in keep]
            columns += [
                pa.array([len(t) for t in texts_of], pa.int64()),
                pa.array(removed_of, pa.int64()),
                pa.array(spans_of, schema.field("spans").type),
                pa.array([hashlib.sha256(x).hexdigest() for x in left_of]),
                pa.array([x.decode("utf-8", "ignore") for x in left_of], pa.string()),
            ]
            return pa.Table.from_arrays(columns, schema=schema)

        return run

    @staticmethod
    def code(bucket: np.ndarray, bits: np.ndarray, docs: np.ndarray | None = None) -> np.ndarray:
        code = mix(bucket.astype(np.uint64) * ODD + bits.astype(np.uint64))
        return code if docs is None else mix(code ^ docs.view(np.uint64))

    @staticmethod
    def ordered(texts: pa.Table, with_order: bool = False):
        """Documents and texts of a group in a fixed order, with the number of each row among those of its document."""
        docs = texts.column("doc").fill_null(np.iinfo(np.int64).min).to_numpy()
        coded = [_unpacked(t) for t in texts.column("text").to_pylist()]
        order = sorted(range(len(docs)), key=lambda i: (docs[i], coded[i]))
        docs, coded = docs[order], [coded[i] for i in order]
        row = np.zeros(len(docs), np.int64)
        for i in range(1, len(docs)):
            row[i] = row[i - 1] + 1 if docs[i] == docs[i - 1] else 0
        return (docs, coded, row, np.array(order, np.int64)) if with_order else (docs, coded, row)


def remove_repeats(
    docs: DataFrame, text: str = "text", key: str = "doc_id", keep: Sequence[str] = ("doc_id",), part_bytes: int = 2 << 20
) -> DataFrame:
    """``keep`` columns of every row with n_bytes, n_removed, spans (start and end of removed bytes), kept_sha256, kept_text.

    A byte is removed if a 50-byte string that covers it also starts in a row with a smaller key. Strings are judged on
    the input, may overlap and never cross rows. A null text counts as empty. Rows with equal keys don't remove from
    each other. A row with a null key loses nothing and removes nothing. ``kept_text`` leaves out what is no whole
    character after removal; ``kept_sha256`` is of all bytes left. ``part_bytes``: text that a task holds at once.
    """
    spark = docs.sparkSession
    keys = [f"k{i}" for i in range(len(keep))]
    source = docs.select(
        F.col(key).cast("long").alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"),
        *(F.col(c).alias(k) for c, k in zip(keep, keys, strict=True)),
    )
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(tasks, total // part_bytes + 1)
    job = _Job(max(tasks, parts // 2), _prime_from(parts))
    # An anchor is hot from this many documents on; there are about total / 13 anchors, so at most 20,000 hot ones.
    hot_from = max(HOT_DOCUMENTS, total // 13 // 20_000)

    found = source.filter("doc is not null").select("doc", "text")
    found = found.mapInArrow(job.anchors, "bucket int, codes binary, docs binary, bits binary, weights binary")
    shared = found.groupBy("bucket").applyInArrow(job.shared(hot_from), "grp int, codes binary")
    shared = materialise(shared, "shared")
    hot = [np.frombuffer(r["codes"], "<u8") for r in shared.filter("grp = -1").collect()]
    hot = np.unique(np.concatenate(hot)) if hot else np.empty(0, np.uint64)

    numbered = source.withColumn("grp", F.pmod(F.coalesce("doc", F.lit(0)), F.lit(job.groups)).cast("int"))
    packed_schema = T.StructType([T.StructField("text", T.BinaryType()) if f.name == "text" else f for f in numbered.schema])
    grouped = numbered.mapInArrow(_with_packed_text, packed_schema)
    windows = (
        numbered.filter("doc is not null").select("grp", "doc", "text")
        .mapInArrow(_with_packed_text, "grp int, doc bigint, text binary").groupBy("grp")
        .cogroup(shared.filter("grp >= 0").groupBy("grp"))
        .applyInArrow(job.windows(hot), "bucket int, docs binary, starts binary, counts binary, data binary")
    )
    copies = windows.groupBy("bucket").applyInArrow(lambda table: job.copies(table), "grp int, docs binary, starts binary, sizes binary")
    copies = materialise(copies, "copies")
    kinds = {k: source.schema[k].dataType for k in keys}
    added = "n_bytes bigint, n_removed bigint, spans array<struct<start: bigint, end: bigint>>, kept_sha256 string, kept_text string"
    out_schema = T.StructType([T.StructField(k, t) for k, t in kinds.items()] + T.StructType.fromDDL(added).fields)
    done = grouped.groupBy("grp").cogroup(copies.groupBy("grp")).applyInArrow(job.remove(keys, to_arrow_schema(out_schema)), out_schema)
    return done.withColumnsRenamed(dict(zip(keys, keep, strict=True)))


def _prime_from(n: int) -> int:
    """The least prime from ``n`` on: ids dealt out by its remainder fall evenly even where they come in steps."""
    while any(n % d == 0 for d in range(2, int(n**0.5) + 1)):
        n += 1
    return n
