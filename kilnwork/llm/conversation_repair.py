"""Least-cost repair of conversations whose turns are blank, repeated, cut short or out of order.

A conversation's signature has a letter for each row: the role's initial and the row's first fault. Suffixes that
signatures share are one node each of an automaton built from the end: signatures sorted by their reversal meet their
shared suffixes one after the other, and a node's costs to go and best edits, one for each state of the grammar of roles,
are computed when it is first met and dropped when no further signature can share it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilnwork.session import materialise

#: Costs of the edits, and of keeping a truncated row. Equal costs go by the edits' initials.
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1

# Letters of a signature: four role initials (system, user, assistant, any other) for each fault.
_ROLES = "suao"
_WHOLE, _CUT, _BLANK, _AGAIN = "suao", "SUAO", "1234", "5678"
_LETTERS = _WHOLE + _CUT + _BLANK + _AGAIN
# What must go has one letter, whatever its role.
_GONE = "x"
_VISIBLE = r"[^\x20\x09-\x0D]"

# Grammar states: nothing yet, after a system turn, after a user turn, after an assistant turn.
_KEEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
# The state after an inserted or re-roled turn, and that turn's role.
_NEXT = (2, 2, 3, 2)
_ROLE = ("user", "user", "assistant", "user")
_END_COST, _END_AUDIT = (0, 2 * INSERT, INSERT, 0), ("", "II", "I", "")

# Costs to go less the least of them, that least one, and for each state the edits up to the next row and the state there.
_Node = tuple[tuple[int, ...], int, tuple[tuple[str, int], ...]]


class Automaton:
    """The nodes on the path of the last signature, from the end; the next one shares those of the suffix they have in common.

    Signatures must come ordered by their reversal for every node to be made once.
    """

    def __init__(self) -> None:
        self._path = ""
        self._nodes: list[_Node] = []
        self._known: dict[tuple[tuple[int, ...], str], _Node] = {}
        self.made = 0

    def repair(self, form: str) -> tuple[int, str]:
        """Cost and edits of the best repair."""
        path = form[::-1]
        shared = _shared(path, self._path)
        del self._nodes[shared:]
        for letter in path[shared:]:
            costs, total = (self._nodes[-1][:2]) if self._nodes else (_END_COST, 0)
            node = self._known.get((costs, letter))
            if node is None:  # nodes whose costs differ by a constant only have the same edits
                node = self._known[costs, letter] = _step(costs, letter)
            self._nodes.append((node[0], total + node[1], node[2]))
            self.made += 1
        self._path = path
        state, audit = 0, []
        for _, _, edits in reversed(self._nodes):
            some, state = edits[state]
            audit.append(some)
        audit.append(_END_AUDIT[state])
        costs, total = self._nodes[-1][:2] if self._nodes else (_END_COST, 0)
        return total + costs[0], "".join(audit)


def _shared(a: str, b: str) -> int:
    """Length of the common prefix, by halves."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _step(costs: tuple[int, ...], letter: str) -> _Node:
    """The node of a row before one with these costs to go."""
    role, extra = letter.lower(), TRUNCATED if letter in _CUT else 0
    options: list[dict[str, tuple[int, int]]] = []
    for state in range(4):
        found = {"D": (DELETE + costs[state], state)}
        if letter != _GONE:
            if role in _KEEP[state]:
                after = _KEEP[state][role]
                found["K"] = (extra + costs[after], after)
            found["R"] = (REROLE + extra + costs[_NEXT[state]], _NEXT[state])
        options.append(found)
    best = [min(c for c, _ in found.values()) for found in options]
    for _ in range(4):
        best = [min(best[state], INSERT + best[_NEXT[state]]) for state in range(4)]
    edits = []
    for state in range(4):
        some = ""
        while True:
            takes = {edit: after for edit, (cost, after) in options[state].items() if cost == best[state]}
            inserted = INSERT + best[_NEXT[state]] == best[state]
            edit = min([*takes, *(["I"] if inserted else [])])
            some += edit
            if edit != "I":
                edits.append((some, takes[edit]))
                break
            state = _NEXT[state]
    least = min(best)
    return tuple(c - least for c in best), least, tuple(edits)


def _rows(conversations: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """Different rows with the number of each, blankness and the digest that tells texts apart."""
    spaced = [F.coalesce(F.col(c), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text"))]
    rows = conversations.select(F.col(conversation).alias("conv"), F.col(turn).alias("turn"), *spaced)
    return rows.groupBy("conv", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n")).select(
        "*", (~F.col("text").rlike(_VISIBLE)).alias("blank"), F.sha2("text", 256).alias("digest")
    )


def _lettered(rows: DataFrame) -> DataFrame:
    """Rows with the letters of their copies: the first copy's own, and those of repeats."""
    when = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = rows.filter("not blank").groupBy("conv", "role", "digest").agg(F.min(when).alias("first"), F.count(F.lit(1)).alias("turns"))
    first = first.filter("turns > 1").select(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first")
    same = rows["conv"].eqNullSafe(first["c"]) & (rows["role"] == first["r"]) & (rows["digest"] == first["d"])
    joined = rows.join(first, same & ~rows["blank"], "left")
    again = F.col("first").isNotNull() & ~when.eqNullSafe(F.col("first"))
    cut = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    kind = F.lit(4)
    for place, initial in enumerate(_ROLES[:3], 1):
        kind = F.when(F.col("role").startswith(initial), place).otherwise(kind)
    fault = F.when(F.col("blank"), 2).when(again, 3).when(cut, 1).otherwise(0)
    letter = lambda number: F.substr(F.lit(_LETTERS), 4 * number + kind, F.lit(1))
    others = F.when(F.col("blank"), 2).otherwise(3)
    letters = F.concat(letter(fault), F.repeat(letter(others), (F.col("n") - 1).cast("int")))
    return joined.select("conv", "turn", "role", "text", letters.alias("letters"))


def _signatures(rows: DataFrame) -> DataFrame:
    """``conv, signature``: the letters of each conversation's rows in order.

    Rows are sorted over all tasks, so that a long conversation is spread; only its letters meet again.
    """
    kind = rows.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, now, held = TaskContext.get().partitionId(), None, []
        for batch in batches:
            done = []
            for key, letters in zip(batch.column("conv").to_pylist(), batch.column("letters").to_pylist(), strict=True):
                if held and key != now:
                    done.append((now, part, "".join(held)))
                    held = []
                now = key
                held.append(letters)
            if done:
                yield _batch(done, ("conv", "part", "letters"), (batch.schema.field("conv").type, pa.int32(), pa.string()))
            kind_of = batch.schema.field("conv").type
        if held:
            yield _batch([(now, part, "".join(held))], ("conv", "part", "letters"), (kind_of, pa.int32(), pa.string()))

    order = [F.col("conv").asc(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc()]
    parts = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "letters").mapInArrow(run, f"conv {kind}, part int, letters string")
    inside = F.array_sort(F.collect_list(F.struct("part", "letters")))  # at most one of each task
    return parts.groupBy("conv").agg(F.array_join(inside["letters"], "").alias("signature"))


def _batch(rows: list[tuple], names: tuple[str, ...], kinds: tuple[pa.DataType, ...]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], list(names))


def best_repairs(forms: DataFrame) -> DataFrame:
    """``form, cost, audit`` of each different form, by the automaton of their suffixes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton()
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.column("form").slice(at, 1024).to_pylist()
                found = [(form, *automaton.repair(form)) for form in part]
                yield _batch(found, ("form", "cost", "audit"), (pa.string(), pa.int64(), pa.string()))

    back = F.reverse("form")
    return forms.repartitionByRange(back).sortWithinPartitions(back).mapInArrow(run, "form string, cost bigint, audit string")


def _count(signature: Column, letters: str) -> Column:
    return F.length(F.regexp_replace(signature, f"[^{letters}]", "")).cast("long")


def _summaries(conversations: DataFrame, rows: DataFrame, conversation: str) -> DataFrame:
    """One row for each conversation of ``conversations``, also of those without rows."""
    signatures = materialise(_signatures(rows), "signatures")
    form = F.translate("signature", _BLANK + _AGAIN, _GONE * 8)
    signatures = signatures.withColumn("form", form)
    solved = best_repairs(signatures.select("form").distinct()).withColumnRenamed("form", "f")
    roles = F.translate("signature", _LETTERS, _ROLES * 4)
    legal = F.regexp_count(roles, F.lit("s(?=u)|u(?=a)|a(?=u)"))
    turns = rows.groupBy("conv", "turn").agg(F.lit(1).alias("one")).groupBy("conv").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count("turn")).cast("long").alias("gaps")
    )
    known = signatures.join(solved, F.col("form") == F.col("f")).select(
        F.col("conv").alias("c"),
        _count(F.col("signature"), _BLANK).alias("blank"),
        _count(F.col("signature"), _AGAIN).alias("duplicate"),
        _count(F.col("signature"), _CUT).alias("truncated"),
        (F.length("signature") - 1 - legal).cast("long").alias("illegal"),
        "cost",
        "audit",
    )
    every = conversations.select(F.col(conversation).alias("conv")).distinct()
    both = every.join(known, every["conv"].eqNullSafe(known["c"]), "left").drop("c")
    turns = turns.withColumnRenamed("conv", "t")
    both = both.join(turns, both["conv"].eqNullSafe(turns["t"]), "left").drop("t")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return both.select("conv", *(F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in numbers), F.coalesce("audit", F.lit("")).alias("audit"))


_NUMBERS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, object]]:
    """From sorted batches, a conversation's summary and then its repaired turns: ``("summary", row)``, ``("turn", (edit, role, text))``."""
    audit, at, state = "", 0, 0

    def inserted() -> Iterator[tuple[str, object]]:
        nonlocal at, state
        while audit[at : at + 1] == "I":
            yield "turn", ("I", _ROLE[state], "")
            state, at = _NEXT[state], at + 1

    for batch in batches:
        for row in batch.to_pylist():
            if row["audit"] is not None:
                yield from inserted()
                audit, at, state = row["audit"], 0, 0
                yield "summary", row
                continue
            for _ in range(len(row["letters"])):
                yield from inserted()
                edit, at = audit[at], at + 1
                if edit == "D":
                    continue
                role = row["role"] if edit == "K" else _ROLE[state]
                state = _KEEP[state][role[0]] if edit == "K" else _NEXT[state]
                yield "turn", (edit, role, row["text"])
    yield from inserted()


def _streamed(summaries: DataFrame, rows: DataFrame) -> DataFrame:
    """Each conversation's summary and then its rows in order, in one task: hashing a conversation is sequential."""
    none = [F.lit(None).cast("long").alias(n) for n in _NUMBERS]
    first = summaries.select("conv", *_NUMBERS, "audit", F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"), *(F.lit(None).cast("string").alias(n) for n in ("role", "text", "letters")))
    rest = rows.select("conv", *none, F.lit(None).cast("string").alias("audit"), "turn", "role", "text", "letters")
    order = [F.col("conv").asc(), F.col("audit").isNull().asc(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc()]
    return first.unionByName(rest).repartition("conv").sortWithinPartitions(*order).drop("turn")


def _prepared(conversations: DataFrame, conversation: str, turn: str, role: str, text: str) -> tuple[DataFrame, DataFrame]:
    rows = materialise(_rows(conversations, conversation, turn, role, text), "turns")
    lettered = materialise(_lettered(rows), "lettered")
    return lettered, _summaries(conversations, lettered, conversation)


def repair(conversations: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The turns of the repaired conversations: ``conversation, position, edit, role, text``.

    Rows go by turn, null first, then role and text. A null role or text is one space, so that such a text is blank; a null
    conversation is one of its own. Equal rows and texts repeated at later turns are duplicates. An empty table gives no
    rows; other columns are ignored. A conversation's rows pass through one task, one Arrow batch at a time.
    """
    lettered, summaries = _prepared(conversations, conversation, turn, role, text)
    kind = conversations.schema[conversation].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal key_type
            for b in batches:
                key_type = b.schema.field("conv").type
                yield b

        key_type, key, position, out = pa.int64(), None, 0, []
        names = ("conv", "position", "edit", "role", "text")
        kinds = (pa.int64(), pa.string(), pa.string(), pa.string())
        for what, value in _edited(typed()):
            if what == "summary":
                key, position = value["conv"], 0
                continue
            out.append((key, position, *value))
            position += 1
            if len(out) == 1024:
                yield _batch(out, names, (key_type, *kinds))
                out = []
        if out:
            yield _batch(out, names, (key_type, *kinds))

    done = _streamed(summaries, lettered).mapInArrow(run, f"conv {kind}, position bigint, edit string, role string, text string")
    return done.withColumnRenamed("conv", conversation)


def digests(conversations: DataFrame, every: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """For each conversation of ``every``: faults, cost, edits and the SHA-256 of the turns that :func:`repair` gives.

    Columns ``conversation, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``; the hash is of
    ``role:text`` joined by newlines. A conversation without rows has zeros and the hash of nothing.
    """
    rows = materialise(_rows(conversations, conversation, turn, role, text), "turns")
    lettered = materialise(_lettered(rows), "lettered")
    summaries = _summaries(every, lettered, conversation)
    kind = every.schema[conversation].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal key_type
            for b in batches:
                key_type = b.schema.field("conv").type
                yield b

        key_type, summary, hashed, turns, out = pa.int64(), None, hashlib.sha256(), 0, []
        names = ("conv", *_NUMBERS, "audit", "repaired_sha256")

        def finish() -> tuple:
            return (summary["conv"], *(summary[n] for n in _NUMBERS), summary["audit"], hashed.hexdigest())

        for what, value in _edited(typed()):
            if what == "summary":
                if summary is not None:
                    out.append(finish())
                summary, hashed, turns = value, hashlib.sha256(), 0
                if len(out) == 1024:
                    yield _batch(out, names, (key_type, *[pa.int64()] * 6, pa.string(), pa.string()))
                    out = []
                continue
            _, who, said = value
            hashed.update(f"{chr(10) if turns else ''}{who}:{said}".encode("utf-8", "replace"))
            turns += 1
        if summary is not None:
            out.append(finish())
            yield _batch(out, names, (key_type, *[pa.int64()] * 6, pa.string(), pa.string()))

    fields = f"conv {kind}, " + ", ".join(f"{n} bigint" for n in _NUMBERS) + ", audit string, repaired_sha256 string"
    return _streamed(summaries, lettered).mapInArrow(run, fields).withColumnRenamed("conv", conversation)


def damaged(conversations: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Faults put into known rows, to measure repairs: by the CRC-32 of ``conversation:turn`` modulo 20 a row is dropped,
    emptied, stripped of its sentence ends, repeated or given the role user. Nulls count as one space."""
    spaced = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conversation, turn, role, text)}
    fault = F.crc32(F.concat(spaced[conversation], F.lit(":"), spaced[turn]).cast("binary")) % 20
    rows = conversations.select(F.col(conversation), F.col(turn), spaced[role].alias(role), spaced[text].alias(text), fault.alias("_fault")).filter("_fault <> 0")
    said = F.when(F.col("_fault") == 1, "").when(F.col("_fault") == 2, F.regexp_replace(F.col(text), "[.!?]", "")).otherwise(F.col(text))
    who = F.when(F.col("_fault") == 4, "user").otherwise(F.col(role))
    copies = F.explode(F.when(F.col("_fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select(F.col(conversation), F.col(turn), who.alias(role), said.alias(text), copies.alias("_copy")).drop("_copy")
