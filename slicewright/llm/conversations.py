"""Conversation structure repair by dynamic programming over a compressed grammar.

A turn is judged by its first fault: blank (no character but white space),
duplicate (role and text seen earlier in the conversation), truncated (its
last such character is not one of ``.!?``).  The cheapest edits that make the
roles read (system)? (user assistant)+, or nothing, are found over the turns'
symbols (role initial and fault): Keep 0, Rerole 1, Delete 2 (the only edit of
blank and duplicate turns), Insert 5, and 5 more for a truncated turn that
stays.  Among equal costs the audit (the edits' initials) that is least in
ASCII wins.

A symbol is a min-plus matrix over four states (nothing yet, after system,
after user, after assistant); an entry is a cost and an audit, and products
add costs and join audits.  Inserts stand before a turn's own edit, so audits
of the same turns are never prefixes of each other and least stays least under
products.  Re-Pair turns the distinct sequences of a block of conversations
into a grammar; every rule's matrix is computed once, from those of its two
parts, with audits as ropes that share their parts, and used by every
conversation that holds the rule.

Turns are dealt by range over (conversation, turn), so one conversation may
span many tasks: each gives the matrix of its stretch, and a conversation's
few matrices are multiplied afterwards.  Texts stay out of this; they are
dealt once, to be read in order beside the finished audit.

Defined results: a NULL is one space, whatever the column; turns ascend,
NULL first, equal turns by role and text hash; a role other than
those of the three initials is reroled or deleted; a conversation without any
turn has an empty audit; repeated rows are duplicates; an empty table gives no
rows; long texts are streamed; a conversation's audit is one value, a byte a
turn; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import written

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Symbols of conversations that are compressed together.
BLOCK = 1 << 16
_SPACE = " \t\n\x0b\x0c\r"
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_BASE, _PRIME = 1_000_003, (1 << 61) - 1
_LEAF = 48


class Rope:
    """An audit as a tree of shared parts, with a hash by which two audits' first difference is found."""

    __slots__ = ("left", "mark", "right", "size", "text")

    def __init__(self, text: str | None, left: Rope | None = None, right: Rope | None = None):
        self.text, self.left, self.right = text, left, right
        if text is not None:
            self.size, mark = len(text), 0
            for c in text:
                mark = (mark * _BASE + ord(c)) % _PRIME
            self.mark = mark
        else:
            self.size = left.size + right.size
            self.mark = (left.mark * pow(_BASE, right.size, _PRIME) + right.mark) % _PRIME

    def __add__(self, other: Rope) -> Rope:
        if not other.size:
            return self
        if not self.size:
            return other
        if self.size + other.size <= _LEAF:
            return Rope(self.text + other.text)
        return Rope(None, self, other)

    def __lt__(self, other: Rope) -> bool:
        mine, theirs = [self], [other]
        while mine and theirs:
            a, b = mine.pop(), theirs.pop()
            if a is b or (a.size == b.size and a.mark == b.mark):
                continue
            if a.text is not None and b.text is not None:
                n = min(a.size, b.size)
                if a.text[:n] != b.text[:n]:
                    return a.text[:n] < b.text[:n]
                if a.size > n:
                    mine.append(Rope(a.text[n:]))
                elif b.size > n:
                    theirs.append(Rope(b.text[n:]))
            elif b.text is not None or (a.text is None and a.size >= b.size):
                mine += [a.right, a.left]
                theirs.append(b)
            else:
                theirs += [b.right, b.left]
                mine.append(a)
        return not mine and bool(theirs)

    def __str__(self) -> str:
        out, todo = [], [self]
        while todo:
            r = todo.pop()
            if r.text is not None:
                out.append(r.text)
            else:
                todo += [r.right, r.left]
        return "".join(out)


Row = list  # of (cost, Rope) or None, by the state reached
_EMPTY = Rope("")


def times(rows: list[Row], matrix: list[Row]) -> list[Row]:
    """Min-plus product; ties go to the least audit."""
    out = []
    for row in rows:
        new: Row = [None] * 4
        for k, mid in enumerate(row):
            if mid is None:
                continue
            for j, step in enumerate(matrix[k]):
                if step is None:
                    continue
                cost, held = mid[0] + step[0], new[j]
                if held is None or cost < held[0]:
                    new[j] = (cost, mid[1] + step[1])
                elif cost == held[0] and (audit := mid[1] + step[1]) < held[1]:
                    new[j] = (cost, audit)
        out.append(new)
    return out


def identity() -> list[Row]:
    return [[(0, _EMPTY) if i == j else None for j in range(4)] for i in range(4)]


def _matrix(steps: list[tuple[int, int, int, str]]) -> list[Row]:
    out: list[Row] = [[None] * 4 for _ in range(4)]
    for i, j, cost, audit in steps:
        if out[i][j] is None or (cost, audit) < (out[i][j][0], str(out[i][j][1])):
            out[i][j] = (cost, Rope(audit))
    return out


_NEXT_USER = [(i, _USER) for i in (_START, _SYSTEM, _ASSISTANT)]
_INSERTS = _matrix([(i, i, 0, "") for i in range(4)] + [(i, j, INSERT, "I") for i, j in [*_NEXT_USER, (_USER, _ASSISTANT)]]
                   + [(i, _ASSISTANT, 2 * INSERT, "II") for i in (_START, _SYSTEM)])


def symbol_matrix(initial: str, must_go: bool, truncated: bool) -> list[Row]:
    """Inserts before a turn, then an edit of it."""
    steps, more = [(i, i, DELETE, "D") for i in range(4)], TRUNCATED * truncated
    if not must_go:
        steps += [(i, j, REROLE + more, "R") for i, j in [*_NEXT_USER, (_USER, _ASSISTANT)]]
        kept = {"s": [(_START, _SYSTEM)], "u": _NEXT_USER, "a": [(_USER, _ASSISTANT)]}.get(initial, [])
        steps += [(i, j, more, "K") for i, j in kept]
    return times(_INSERTS, _matrix(steps))


#: Symbols: 0 must go; then role initial s, u, a or another, complete or truncated.
_GO = 0
_INITIALS = "sua?"
_SYMBOLS = [symbol_matrix("?", True, False)] + [symbol_matrix(c, False, t) for t in (False, True) for c in _INITIALS]


def symbol(initial: str, must_go: bool, truncated: bool) -> int:
    if must_go:
        return _GO
    return 1 + 4 * truncated + (_INITIALS.index(initial) if initial in ("s", "u", "a") else 3)


def repair_grammar(sequences: list[tuple[int, ...]], first_rule: int) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """Re-Pair: the most frequent adjacent pair becomes a rule until none occurs twice; rules and the shortened sequences.

    Rule k is the symbol ``first_rule`` + k.  Ties go to the least pair.
    """
    signs: list[int | None] = []
    heads = []
    for s in sequences:
        heads.append(len(signs))
        signs.extend(s)
        signs.append(None)  # between sequences
    after, before = list(range(1, len(signs) + 1)), list(range(-1, len(signs) - 1))
    places: dict[tuple[int, int], set[int]] = defaultdict(set)
    for p in range(len(signs) - 1):
        if signs[p] is not None and signs[p + 1] is not None:
            places[signs[p], signs[p + 1]].add(p)
    heap = [(-len(v), k) for k, v in places.items()]
    heapq.heapify(heap)
    rules: list[tuple[int, int]] = []

    def leave(p: int, q: int) -> None:
        if p >= 0 and q < len(signs) and signs[p] is not None and signs[q] is not None:
            places[signs[p], signs[q]].discard(p)

    def enter(p: int, q: int, changed: set) -> None:
        if p >= 0 and q < len(signs) and signs[p] is not None and signs[q] is not None:
            places[signs[p], signs[q]].add(p)
            changed.add((signs[p], signs[q]))

    while heap:
        count, pair = heapq.heappop(heap)
        if -count != len(places[pair]):
            if len(places[pair]) > 1:
                heapq.heappush(heap, (-len(places[pair]), pair))
            continue
        if -count < 2:
            break
        new, changed, used = first_rule + len(rules), set(), 0
        for p in sorted(places.pop(pair)):
            q = after[p]
            if signs[p] != pair[0] or q >= len(signs) or signs[q] != pair[1]:
                continue  # overlapped the pair before it
            used += 1
            r = after[q]
            leave(before[p], p)
            leave(q, r)
            signs[p], signs[q], after[p] = new, None, r
            if r < len(signs):
                before[r] = p
            enter(before[p], p, changed)
            enter(p, r, changed)
        if used:
            rules.append(pair)
        places.pop(pair, None)
        for k in changed:
            if k != pair and len(places[k]) > 1:
                heapq.heappush(heap, (-len(places[k]), k))
    out = []
    for head, s in zip(heads, sequences):
        short, p, end = [], head, head + len(s)
        while p < end:
            short.append(signs[p])
            p = after[p]
        out.append(short)
    return rules, out


def transfer(sequences: list[tuple[int, ...]]) -> dict[tuple[int, ...], list[Row]]:
    """The matrix of each distinct sequence, through one grammar of them all."""
    distinct = sorted(set(sequences))
    rules, short = repair_grammar(distinct, len(_SYMBOLS))
    matrices = list(_SYMBOLS)
    for a, b in rules:  # parts come before the rules that use them
        matrices.append(times(matrices[a], matrices[b]))
    out = {}
    for s, signs in zip(distinct, short):
        m = matrices[signs[0]] if signs else identity()
        for k in signs[1:]:
            m = times(m, matrices[k])
        out[s] = m
    return out


def finish(row: Row) -> tuple[int, str]:
    """Cost and audit of a conversation from the states its turns lead to, with inserts at its end."""
    found = []
    for state, inserts in ((_START, 0), (_ASSISTANT, 0), (_USER, 1), (_SYSTEM, 2)):
        if row[state] is not None:
            found.append((row[state][0] + INSERT * inserts, str(row[state][1]) + "I" * inserts))
    return min(found)


def _text(c: Column | str) -> Column:
    return F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(" "))


def turns(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", copies: Column | None = None) -> DataFrame:
    """Turns in the form the operator works on; ``copies`` says how often a row stands there (0: only its conversation does)."""
    picked = rows.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                         _text(role_col).alias("role"), _text(text_col).alias("text"), (F.lit(1) if copies is None else copies).cast("int").alias("copies"))
    bare = F.rtrim(F.col("text"), F.lit(_SPACE))
    return picked.withColumn("h", F.sha2("text", 256)).withColumn("blank", bare == "").withColumn("cut", ~F.right(bare, F.lit(1)).isin(".", "!", "?"))


_KEYS = ["conv_known", "conv", "turn_known", "turn", "role", "h"]


def _keyed(rows: DataFrame) -> DataFrame:
    """NULL ids and turns as a flag and 0, so that they sort first and equal each other."""
    return (rows.withColumn("conv_known", F.col("conv_id").isNotNull()).withColumn("conv", F.coalesce("conv_id", F.lit(0)).cast("long"))
            .withColumn("turn_known", F.col("turn").isNotNull()).withColumn("turn", F.coalesce("turn", F.lit(0)).cast("long")))


_STRETCH = ("conv_known boolean, conv long, part int, rows long, blank long, duplicate long, truncated long, illegal long, turns long, "
            "first_turn long, last_turn long, first_initial string, last_initial string, costs array<long>, audits array<string>")


class _Stretch:
    """What one task knows of a conversation: counts and symbols."""

    def __init__(self, key: tuple):
        self.key, self.rows, self.faults, self.illegal, self.turns = key, 0, [0, 0, 0], 0, 0
        self.first_turn = self.last_turn = self.first_initial = self.last_initial = None
        self.signs: list[int] = []
        self.done: list[Row] | None = None
        self.last = None

    def add(self, row: tuple) -> None:
        _, _, known, turn, role, h, copies, blank, cut, seen = row
        initial = role[:1]
        for copy in range(copies):
            again = seen or (known, turn, role, h) == self.last
            fault = 0 if blank else 1 if again else 2 if cut else None
            if fault is not None:
                self.faults[fault] += 1
            self.last = (known, turn, role, h)
            self.signs.append(symbol(initial, fault in (0, 1), fault == 2))
            if not self.rows:
                self.first_initial = initial
            elif not legal(self.last_initial, initial):
                self.illegal += 1
            self.last_initial = initial
            self.rows += 1
            if known and turn != self.last_turn:
                self.turns += 1
                self.first_turn = turn if self.first_turn is None else self.first_turn
                self.last_turn = turn

    def out(self, m: list[Row], part: int) -> tuple:
        m = m if self.done is None else times(self.done, m)
        flat = [cell for row in m for cell in row]
        return (*self.key, part, self.rows, *self.faults, self.illegal, self.turns, self.first_turn, self.last_turn, self.first_initial, self.last_initial,
                [-1 if c is None else c[0] for c in flat], ["" if c is None else str(c[1]) for c in flat])


def legal(a: str, b: str) -> bool:
    return a + b in ("su", "ua", "au") and len(a) == 1


def _stretches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyspark import TaskContext

    part, names = TaskContext.get().partitionId(), [f.split()[0] for f in _STRETCH.split(", ")]

    def compressed(held: list[_Stretch], all_done: bool) -> tuple[pd.DataFrame, list[_Stretch]]:
        found = transfer([tuple(s.signs) for s in held])
        rest = [] if all_done else held[-1:]  # its conversation may go on
        out = [s.out(found[tuple(s.signs)], part) for s in held[:len(held) - len(rest)]]
        for s in rest:
            m = found[tuple(s.signs)]
            s.done, s.signs = m if s.done is None else times(s.done, m), []
        frame = pd.DataFrame(out, columns=names)
        for c in ("first_turn", "last_turn"):
            frame[c] = frame[c].astype("Int64")
        return frame, rest

    held: list[_Stretch] = []
    size = 0
    for pdf in batches:
        for row in pdf.itertuples(index=False, name=None):
            if not held or held[-1].key != row[:2]:
                held.append(_Stretch(row[:2]))
            held[-1].add(row)
            size += row[6]
            if size >= BLOCK:
                frame, held = compressed(held, False)
                size = 0
                if len(frame):
                    yield frame
    if held:
        yield compressed(held, True)[0]


def _combined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for known, conv, stretches in pdf.itertuples(index=False, name=None):
            total, row, last = [0] * 6, identity()[:1], None
            for s in sorted(stretches, key=lambda s: s["part"]):
                flat = [None if c < 0 else (int(c), Rope(a)) for c, a in zip(s["costs"], s["audits"])]
                row = times(row, [flat[k:k + 4] for k in range(0, 16, 4)])
                for k, name in enumerate(("rows", "blank", "duplicate", "truncated", "illegal", "turns")):
                    total[k] += s[name]
                if last is not None and s["rows"]:
                    total[4] += not legal(last["last_initial"], s["first_initial"])
                    total[5] -= s["first_turn"] is not None and s["first_turn"] == last["last_turn"]
                if s["rows"]:
                    last = s if s["last_turn"] is not None or last is None else {**s, "last_turn": last["last_turn"]}
            turns_ = [s["first_turn"] for s in stretches if s["first_turn"] is not None], [s["last_turn"] for s in stretches if s["last_turn"] is not None]
            gaps = max(turns_[1]) - min(turns_[0]) + 1 - total[5] if turns_[0] else 0
            cost, audit = finish(row[0])
            out.append((known, conv, gaps, *total[1:5], cost, audit))
        yield pd.DataFrame(out, columns=["conv_known", "conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"])


def plan(rows: DataFrame) -> DataFrame:
    """Faults, cost and audit of each conversation of ``turns``, keyed by (conv_known, conv); written."""
    light = written(_keyed(rows).select(*_KEYS, "copies", "blank", "cut"))
    place = F.struct("turn_known", "turn")
    # role and text seen in several rows of a conversation, and where first: few, and counted before any shuffle
    seen = light.where("copies > 0 and not blank").groupBy("conv_known", "conv", "role", "h").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1")
    marked = light.join(seen.drop("n"), ["conv_known", "conv", "role", "h"], "left").select(
        *_KEYS, "copies", "blank", "cut", F.coalesce(place > F.col("first"), F.lit(False)).alias("seen"))
    dealt = marked.repartitionByRange(*_KEYS).sortWithinPartitions(*_KEYS)
    stretches = dealt.mapInPandas(_stretches, _STRETCH)
    whole = stretches.groupBy("conv_known", "conv").agg(F.collect_list(F.struct(*[f.split()[0] for f in _STRETCH.split(", ")[2:]])).alias("stretches"))
    return written(whole.mapInPandas(_combined, "conv_known boolean, conv long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"))


class _Edited:
    """One conversation's turns, read in order and edited by its audit."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, _START

    def _role(self, kept: str | None) -> str:
        if kept is not None and self.state == _START and kept[:1] == "s":
            self.state = _SYSTEM
            return kept
        self.state = _ASSISTANT if self.state == _USER else _USER
        return kept if kept is not None else "assistant" if self.state == _ASSISTANT else "user"

    def inserts(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield "I", self._role(None), ""

    def turn(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            yield edit, self._role(role if edit == "K" else None), text


def _edited(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[tuple, Iterator[tuple[str, str, str]] | None]]:
    """(conversation, edited turns) in reading order; (conversation, None) where it ends."""
    key, now = None, None
    for pdf in batches:
        for known, conv, audit, role, text, copies in pdf.itertuples(index=False, name=None):
            if (known, conv) != key:
                if now is not None:
                    yield key, now.inserts()
                    yield key, None
                key, now = (known, conv), _Edited(audit)
                continue  # the row of the audit
            for _ in range(copies):
                yield key, now.turn(role, text)
    if now is not None:
        yield key, now.inserts()
        yield key, None


def _beside(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """Each conversation's audit, then its turns in order, within one partition: read once, in a stream."""
    texts = _keyed(rows).select(*_KEYS, F.lit(1).alias("kind"), F.lit(None).cast("string").alias("audit"), "text", "copies").where("copies > 0")
    heads = plans.select("conv_known", "conv", F.lit(False).alias("turn_known"), F.lit(0).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("h"),
                         F.lit(0).alias("kind"), "audit", F.lit(None).cast("string").alias("text"), F.lit(0).alias("copies"))
    dealt = heads.unionByName(texts).repartition("conv_known", "conv")
    return dealt.sortWithinPartitions("conv_known", "conv", "kind", "turn_known", "turn", "role", "h").select("conv_known", "conv", "audit", "role", "text", "copies")


def repaired_turns(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place 0.., edit, role, text."""
    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, key, place, size = [], None, 0, 0
        for (known, conv), turns_ in _edited(batches):
            if (known, conv) != key:
                key, place = (known, conv), 0
            for edit, role, text in turns_ or ():
                out.append((known, conv, place, edit, role, text))
                place, size = place + 1, size + len(text)
            if size > 1 << 22 or len(out) > 50_000:
                yield pd.DataFrame(out, columns=["known", "conv", "place", "edit", "role", "text"])
                out, size = [], 0
        if out:
            yield pd.DataFrame(out, columns=["known", "conv", "place", "edit", "role", "text"])

    out = _beside(rows, plans).mapInPandas(stream, "known boolean, conv long, place long, edit string, role string, text string")
    return out.select(F.when(F.col("known"), F.col("conv")).alias("conv_id"), "place", "edit", "role", "text")


def repaired_digests(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """Hex SHA-256 of each repaired conversation's ``role:text`` lines, taken as its turns pass by."""
    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, digest, first = [], hashlib.sha256(), True
        for (known, conv), turns_ in _edited(batches):
            if turns_ is None:
                out.append((known, conv, digest.hexdigest()))
                digest, first = hashlib.sha256(), True
                if len(out) >= 10_000:
                    yield pd.DataFrame(out, columns=["conv_known", "conv", "repaired_sha256"])
                    out = []
            for _, role, text in turns_ or ():
                digest.update(f"{'' if first else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
                first = False
        if out:
            yield pd.DataFrame(out, columns=["conv_known", "conv", "repaired_sha256"])

    return _beside(rows, plans).mapInPandas(stream, "conv_known boolean, conv long, repaired_sha256 string")


def repair(rows: DataFrame) -> DataFrame:
    """Of ``turns``: conv_id, gaps, fault counts, illegal neighbours, cost, audit and the digest of the repaired conversation."""
    plans = plan(rows)
    met = plans.join(repaired_digests(rows, plans), ["conv_known", "conv"])
    return met.select(F.when(F.col("conv_known"), F.col("conv")).alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


__all__ = ["Rope", "finish", "legal", "plan", "repair", "repair_grammar", "repaired_digests", "repaired_turns", "symbol", "symbol_matrix", "times", "transfer", "turns"]
