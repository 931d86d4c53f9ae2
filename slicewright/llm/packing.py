"""Order-preserving packing of documents into token windows by dynamic programming.

Documents are tokenised, an end id is added to each, and the id stream of a
task's documents (ascending id) is cut into windows of at most ``WINDOW``
tokens.  Cuts may lie at document ends, at sentence ends, and, in runs without
either, at every ``FREE_EVERY`` tokens.  The chosen cuts minimise
padding plus truncation penalties:

    cost(j) = cut(j) + min over i in [j - WINDOW, j) of cost(i) + pad(j - i)

A window of n tokens is padded to ``WINDOW`` unless n is a power of two, so
pad(n) is 0 there and WINDOW - n elsewhere.  The first kind of transition
minimises cost(i) + i over a sliding range, kept in a monotone queue; the
second looks up at most eleven fixed distances.  Both take constant time per
cut, so the work is linear in the text.

Input partitions are packed where they lie: no row is shuffled.  A task solves
blocks of ``BLOCK`` tokens one after the other, so its memory does not grow
with its input, and a block's last window may be short (half a window in a
thousand on average).

Defined results: NULL text is an empty document (its end id alone); repeated
rows are documents of their own; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW, END_ID = 1024, 0
#: Tokens that a cut inside a document costs beside padding: at a sentence end, and elsewhere.
SENTENCE_CUT, FREE_CUT = 2, 8
#: A possible cut at least every so many tokens.
FREE_EVERY = 32
#: Tokens solved together.
BLOCK = 1 << 20

# Fixed value: the pattern by which byte-level tokenizers divide a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Longer runs without white space, or of it alone, take a tokenizer with a heap of merges.
LONG_RUN = 4_000
_WHITE = re.compile(r"\s+")

# White space as the tokenizer's pattern has it.
_SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_BETWEEN = re.compile(rf"(?<=[^{_SPACE}])\x20(?=[^{_SPACE}])")
#: Characters of a long text that are tokenised at a time, cut where a space joins two words.
SLICE = 1 << 20


def slices(text: str, most: int = SLICE) -> Iterator[str]:
    at = 0
    while len(text) - at > most and (m := _BETWEEN.search(text, at + most)):
        yield text[at:m.start()]
        at = m.start()
    yield text[at:]


class Ids:
    """Token ids of texts, as ``tokenizers`` gives them with ``add_special_tokens=False``.

    A byte-level file whose merges make ids in ascending order is the same as
    a table of ranks, which ``tiktoken`` encodes in a fraction of the time;
    any other file, and texts with a run of over ``LONG_RUN`` characters
    without a change between white space and the rest, go to ``tokenizers``.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        size = 1 + max(vocab.values())
        if size > 1 << 16:
            raise ValueError("ids are kept in 16 bits")
        self.ends = np.zeros(size, bool)
        for token, k in vocab.items():
            self.ends[k] = token[-1:] in (".", "!", "?", "Ċ")  # the last is a line break in this vocabulary's letters
        with open(path, encoding="utf-8") as f:
            self.ranked = _ranked(json.load(f))

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        return [np.concatenate([self._one(part) for part in slices(t)]) for t in texts]

    def _one(self, text: str) -> np.ndarray:
        if self.ranked is None or (len(text) > LONG_RUN and _longest_run(text) > LONG_RUN):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2")
        return self.ranked.encode_to_numpy(text, allowed_special="all", disallowed_special=()).astype("<u2")


def _longest_run(text: str) -> int:
    return max(map(len, text.split() + _WHITE.findall(text)))


def _letters() -> dict[str, int]:
    """Byte of each letter of a byte-level vocabulary: printable bytes are their own letters, the others follow from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def _ranked(data: dict):
    """The same tokenizer as a table of ranks; None where the file is not of that kind."""
    import tiktoken

    model, pre = data["model"], data.get("pre_tokenizer") or {}
    special = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
    if (model.get("type", "BPE"), pre.get("type"), pre.get("use_regex", True), pre.get("add_prefix_space", True)) != ("BPE", "ByteLevel", True, False):
        return None
    if data.get("normalizer") or model.get("dropout") or model.get("byte_fallback") or model.get("ignore_merges") or model.get("end_of_word_suffix") or model.get("continuing_subword_prefix"):
        return None
    if any(t.get(k) for t in data.get("added_tokens", []) for k in ("lstrip", "rstrip", "single_word", "normalized")):
        return None
    letters, vocab = _letters(), {t: k for t, k in model["vocab"].items() if t not in special}
    made = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if made != sorted(set(made)) or len(vocab) != 256 + len(made) or (made and made[0] < 256):
        return None
    return tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks={bytes(letters[c] for c in t): k for t, k in vocab.items()}, special_tokens=special)


_IDS: dict[str, Ids] = {}


def ids_of(path: str) -> Ids:
    """The tokenizer of a worker process, kept between its tasks."""
    if path not in _IDS:
        _IDS[path] = Ids(path)
    return _IDS[path]


def cuts(positions: np.ndarray, costs: np.ndarray, window: int = WINDOW) -> list[int]:
    """Chosen cut positions for ascending candidate ``positions`` (the last is the end) with ``costs``.

    Position 0 is the start.  Neighbouring candidates are at most ``window`` apart.
    """
    at = np.concatenate(([0], positions)).astype(np.int64)
    powers = [1 << k for k in range(window.bit_length()) if 1 << k <= window]
    # candidates that lie exactly a power of two before another
    exact: list[list[int]] = [[] for _ in range(len(at))]
    for p in powers:
        i = np.searchsorted(at, at - p)
        hit = (at - p >= 0) & (at[np.minimum(i, len(at) - 1)] == at - p)
        for j, k in zip(np.flatnonzero(hit).tolist(), i[hit].tolist()):
            exact[j].append(k)
    spots, extra = at.tolist(), [0, *costs.tolist()]
    best, came = [0] * len(spots), [0] * len(spots)
    queue, rank = deque([0]), [0] * len(spots)  # candidates by ascending cost(i) + i
    for j in range(1, len(spots)):
        here = spots[j]
        while spots[queue[0]] < here - window:
            queue.popleft()
        i = queue[0]
        least = rank[i] + window - here
        for k in exact[j]:
            if best[k] < least:
                least, i = best[k], k
        least += extra[j]
        best[j], came[j], r = least, i, least + here
        rank[j] = r
        while queue and rank[queue[-1]] >= r:
            queue.pop()
        queue.append(j)
    chosen, j = [], len(spots) - 1
    while j:
        chosen.append(spots[j])
        j = came[j]
    return chosen[::-1]


def candidates(sentence_ends: np.ndarray, document_ends: np.ndarray, total: int, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Possible cuts of a block and what each costs."""
    kind = np.full(total + 1, -1, np.int8)
    kind[sentence_ends] = SENTENCE_CUT
    kind[document_ends] = 0
    kind[total] = 0
    known = np.concatenate(([0], np.flatnonzero(kind >= 0)))
    every = min(FREE_EVERY, window)
    for k in np.flatnonzero(np.diff(known) > every):
        kind[known[k] + every:known[k + 1]:every] = FREE_CUT
    found = np.flatnonzero(kind >= 0)
    found = found[found > 0]
    return found, kind[found]


class Block:
    """Documents, or parts of long ones, that are packed together."""

    def __init__(self, ends: np.ndarray, window: int, first_sequence: int):
        self.ends, self.window, self.sequence = ends, window, first_sequence
        self.parts: list[tuple] = []  # (doc_id, start in the document, ids, document's tokens)
        self.size = 0

    def add(self, doc_id, start: int, ids: np.ndarray, tokens: int) -> None:
        self.parts.append((doc_id, start, ids, tokens))
        self.size += len(ids)

    def solve(self) -> list[tuple]:
        ids = np.concatenate([p[2] for p in self.parts])
        begins = np.cumsum([0, *(len(p[2]) for p in self.parts)])
        finished = np.array([b + len(p[2]) for b, p in zip(begins, self.parts) if p[1] + len(p[2]) == p[3]], np.int64)
        sentence = np.flatnonzero(self.ends[ids]) + 1  # an end id counts as its document's end
        chosen = cuts(*candidates(sentence, finished, len(ids), self.window), self.window)
        edges = np.unique(np.concatenate((begins, [0, *chosen])))
        owner = np.searchsorted(begins, edges[:-1], "right") - 1
        windows = np.concatenate(([0], chosen))
        window_of = np.searchsorted(windows, edges[:-1], "right") - 1
        wide, out = ids.astype("<u4"), []
        for a, b, o, w in zip(edges[:-1].tolist(), edges[1:].tolist(), owner.tolist(), window_of.tolist()):
            doc_id, start, _, tokens = self.parts[o]
            out.append((doc_id, start + a - int(begins[o]), b - a, zlib.crc32(wide[a:b].tobytes()), tokens, self.sequence + w, a - int(windows[w])))
        self.sequence += len(chosen)
        self.parts, self.size = [], 0
        return out


COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """Pieces of every document: where each lies in its document and in which sequence.

    ``tokenizer`` is the path of a byte-level tokenizer file on every executor.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = ids_of(tokenizer)
        task = TaskContext.get()
        todo = Block(ids.ends, window, (task.partitionId() if task else 0) << 40)
        for pdf in batches:
            out: list[tuple] = []
            for k in range(0, len(pdf), 256):
                part = pdf.iloc[k:k + 256]
                for doc_id, found in zip(part["doc_id"], ids(part["text"].tolist())):
                    whole = np.append(found, np.uint16(END_ID))
                    for start in range(0, len(whole), block):
                        todo.add(doc_id, start, whole[start:start + block], len(whole))
                        if todo.size >= block:
                            out += todo.solve()
            if out:
                yield pd.DataFrame(out, columns=COLUMNS)
        if todo.parts:
            yield pd.DataFrame(todo.solve(), columns=COLUMNS)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    ordered = rows.sortWithinPartitions(F.col("doc_id").asc_nulls_first()).withColumn("doc_id", F.col("doc_id").cast("string"))
    pieces = ordered.mapInPandas(run, "doc_id string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    return pieces.withColumn("doc_id", F.col("doc_id").cast("long"))


__all__ = ["COLUMNS", "Ids", "candidates", "cuts", "pack"]
