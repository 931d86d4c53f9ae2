"""Personal data: base patterns, and terms that disclose the protected entities.

Base spans are e-mail addresses, IP addresses, payment card numbers and phone
numbers.  Each distinct value is a protected entity.  A term is a word that
lies in no base span.  Corpus counts (documents that hold the term, documents
that hold the target, documents that hold both) give the pointwise mutual
information; divided by the target's own information it says which share of
that information the term gives away.  Targets are the entities that
``LEAST_TEXTS`` different texts hold, the four kinds, and any entity at all,
which pool the entities that are seen once.  Words in fewer than ``RARE``
documents are counted as their shape (letters, digits or both, and the length),
so that a lone key or code is known by its kind; shapes are no finer than that.

A term discloses when it gives at least ``DISCLOSED`` of a target's
information and when the number of different texts that hold both is no
accident: the Chernoff bound of that many chance meetings, times the number of
pairs of terms and targets, must not exceed ``CHANCE``.  A word that is seen
once beside an entity that is seen once therefore discloses nothing.  Terms
that disclose become spans of kind ``term`` wherever they stand, in any text,
and are generalised (words) or removed (numbers) by ``sanitise``.

One pass over the texts finds base spans, entities and the words beside them,
one counts terms, and one finds the disclosing terms: a bit table of limited
size drops most other words before the join (a full one drops none and changes
no result).  Pairs are counted once per different text, and entities that the
same texts hold are one target, so a text of many mentions takes no square of
its words.

Defined results: NULL text is empty; repeated rows each get their spans; ids
may be NULL or repeat; an empty table gives no rows; very long texts are read
whole, one at a time; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import written

KINDS = ("email", "ip", "card", "phone", "term")
#: The share of a target's information that a term must give, and the chance of any accident.
DISCLOSED, CHANCE = 0.8, 0.05
#: Different texts from which on an entity is a target of its own; documents below which a word counts as its shape.
LEAST_TEXTS, RARE = 3, 5
#: Characters from which on the lengths of words are not told apart.
LONG_WORD = 64
#: Distinct terms that a task counts before it passes the counts on.
COUNTED = 500_000
#: Least and most bits of the table that drops words that disclose nothing, its bits a term, and a term's marks; terms in more than 1/``COMMON`` of the documents meet by broadcast.
TABLE_BITS, MOST_BITS, BITS_A_TERM, MARKS = 1 << 22, 1 << 26, 16, 4
COMMON = 1000

# The patterns of the base kinds.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"\w+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, from each @ outwards: linear in the text, however long its words."""
    end = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            end = m.end()
            yield start, end
            at = max(end, at + 1)
        else:
            at += 1


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """All base spans as (kind, start, end) in code points, by start, then kind as listed."""
    spans = [("email", *s) for s in emails(text)] if "@" in text else []
    if any(map(text.__contains__, "0123456789")):
        spans += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        spans += [("card", *m.span()) for m in _CARD.finditer(text) if 12 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
        spans += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15] if "+" in text else []
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def span_text(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _entity(kind: str, value: str) -> str:
    return f"{kind}:{value.lower() if kind in ('email', 'ip') else _digits(value)}"


def words_outside(text: str, spans: list[tuple[str, int, int]]) -> Iterator[re.Match]:
    """The words of the text that touch no base span."""
    k = furthest = 0
    for m in _WORD.finditer(text):
        while k < len(spans) and spans[k][1] < m.end():
            furthest = max(furthest, spans[k][2])
            k += 1
        if furthest <= m.start():
            yield m


def shape(word: str) -> str:
    """What a rare word counts as."""
    return f"#{'L' if word.isalpha() else 'D' if word.isdecimal() else 'M'}{min(len(word), LONG_WORD)}"


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id and text of every row, with the text's hash; both together are the key of a row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base spans and their digest of every row, its entities, and the distinct words of its text if it has any."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for doc_id, text_hash, text in zip(pdf["doc_id"], pdf["text_hash"], pdf["text"]):
                spans = base_spans(text)
                entities = sorted({_entity(k, text[a:b]) for k, a, b in spans})
                words = sorted({m[0].lower() for m in words_outside(text, spans)}) if spans else []
                sha = hashlib.sha256(span_text(spans).encode()).hexdigest()
                out.append((doc_id, text_hash, sha, [{"kind": k, "start": a, "end": b} for k, a, b in spans], entities, words))
            if out:
                yield pd.DataFrame(out, columns=["doc_id", "text_hash", "base_sha256", "spans", "entities", "words"])

    rows = _texts(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("string"))
    found = rows.mapInPandas(find, "doc_id string, text_hash long, base_sha256 string, spans array<struct<kind:string,start:long,end:long>>, entities array<string>, words array<string>")
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def term_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(term, n_term): documents that hold each word, or a word of each shape, over all rows; counted per task before the shuffle."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for pdf in batches:
            for text in pdf["text"]:
                words = {w.lower() for w in set(_WORD.findall(text))}
                counts.update(words)
                counts.update({shape(w) for w in words})
                if len(counts) > COUNTED:
                    yield pd.DataFrame({"term": list(counts), "n": list(counts.values())})
                    counts.clear()
        if counts:
            yield pd.DataFrame({"term": list(counts), "n": list(counts.values())})

    texts = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return texts.mapInPandas(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n_term"))


def _looked_up(rows: DataFrame, table: DataFrame, key: str, common: Column) -> DataFrame:
    """``rows`` joined to the one row of ``table`` with their key; the few ``common`` keys by broadcast, so that none gathers in a task."""
    often = table.where(common)
    seldom = rows.join(F.broadcast(often.select(key)), key, "left_anti").join(table.where(~common), key)
    return rows.join(F.broadcast(often), key).unionByName(seldom)


def _shape(term: Column) -> Column:
    """``shape`` as a Column."""
    letter = F.when(term.rlike(r"^\p{L}+$"), "L").when(term.rlike(r"^\p{Nd}+$"), "D").otherwise("M")
    return F.concat(F.lit("#"), letter, F.least(F.length(term), F.lit(LONG_WORD)).cast("string"))


def _targets(texts: DataFrame, least_texts: int) -> DataFrame:
    """(text_hash, target, n_target) of the distinct texts with entities: kinds, any entity, and groups of entities that the same texts hold."""
    mentions = texts.select("text_hash", "n", F.explode("entities").alias("entity"))
    of_kind = mentions.select("text_hash", "n", F.explode(F.array(F.lit("any"), F.substring_index("entity", ":", 1))).alias("target")).distinct()
    kinds = of_kind.groupBy("target").agg(F.sum("n").alias("n_target"))
    # who holds an entity, as a number that does not depend on the order
    holders = mentions.groupBy("entity").agg(F.count("*").alias("held"), F.sum("n").alias("n_target"), F.bit_xor("text_hash").alias("of"),
                                             F.bit_xor(F.xxhash64("text_hash", F.lit(1))).alias("of_too")).where(F.col("held") >= least_texts)
    group = F.concat_ws("=", F.hex("of"), F.hex("of_too"), F.col("held").cast("string")).alias("target")
    groups = mentions.select("text_hash", "entity").join(holders, "entity").select("text_hash", group, "n_target").distinct()
    return of_kind.drop("n").join(F.broadcast(kinds), "target").select("text_hash", "target", "n_target").unionByName(groups)  # at most five kinds


def disclosures(found: DataFrame, terms: DataFrame, disclosed: float = DISCLOSED, chance: float = CHANCE, least_texts: int = LEAST_TEXTS, rare: int = RARE) -> DataFrame:
    """(unit, n_unit, share): words and shapes that disclose some target, and the largest share they give."""
    total = max(1, found.count())
    texts = written(found.where(F.size("entities") > 0).groupBy("text_hash").agg(F.count("*").alias("n"), F.any_value("entities").alias("entities"), F.any_value("words").alias("words")))
    targets = written(_targets(texts, least_texts))
    # no unit in more documents than this can give the share of a target
    most = lambda n: F.pow(n, F.lit(disclosed)) * float(total) ** (1 - disclosed)
    bounds = targets.agg(F.max(most(F.col("n_target"))).alias("most"), F.count_distinct("target").alias("targets")).first()
    units = terms.agg(F.count_if((F.col("n_term") >= rare) | F.col("term").startswith("#")).alias("n")).first()["n"]
    allowed = math.log(chance) - math.log(max(1, units)) - math.log(max(1, bounds["targets"]))
    words = texts.select("text_hash", "n", F.explode("words").alias("term"))
    counted = _looked_up(words, terms.where(~F.col("term").startswith("#")), "term", F.col("n_term") > total / COMMON)
    as_word = counted.where(F.col("n_term") >= rare).select("text_hash", "n", F.col("term").alias("unit"), F.col("n_term").alias("n_unit"))
    shapes = terms.where(F.col("term").startswith("#")).select(F.col("term").alias("unit"), F.col("n_term").alias("n_unit"))  # at most 3 * LONG_WORD
    as_shape = counted.where(F.col("n_term") < rare).select("text_hash", "n", _shape(F.col("term")).alias("unit")).distinct().join(F.broadcast(shapes), "unit")
    held = written(as_word.unionByName(as_shape).where(F.col("n_unit") <= (bounds["most"] or 0.0)))
    pairs = held.join(targets, "text_hash").where(F.col("n_unit") <= most(F.col("n_target"))).groupBy("unit", "target").agg(
        F.sum("n").alias("n_pair"), F.count("*").cast("double").alias("texts"), F.any_value("n_unit").alias("n_unit"), F.any_value("n_target").alias("n_target"))
    information = F.log2(total / F.col("n_target"))
    share = F.when(information > 0, F.log2(F.col("n_pair") / F.col("n_unit") * total / F.col("n_target")) / information).otherwise(F.lit(0.0))
    expected = F.col("n_unit") * F.col("n_target") / total
    # of at least so many texts by chance; documents stand for texts in what is expected, which only raises it
    accident = F.when(F.col("texts") > expected, F.col("texts") - expected - F.col("texts") * F.log(F.col("texts") / expected)).otherwise(F.lit(0.0))
    telling = pairs.withColumn("share", share).where((F.col("share") >= disclosed) & (accident <= allowed))
    return telling.groupBy("unit").agg(F.any_value("n_unit").alias("n_unit"), F.max("share").alias("share"))


def disclosing_terms(units: DataFrame, terms: DataFrame, rare: int = RARE) -> DataFrame:
    """(term, n_term, share): the words that disclose by themselves, and the rare ones of a disclosing shape."""
    words = terms.where((F.col("n_term") >= rare) & ~F.col("term").startswith("#"))
    by_word = words.join(units.select(F.col("unit").alias("term"), "share"), "term")
    shapes = F.broadcast(units.where(F.col("unit").startswith("#")).select("unit", "share"))  # at most 3 * LONG_WORD
    seldom = terms.where((F.col("n_term") < rare) & ~F.col("term").startswith("#"))
    by_shape = seldom.withColumn("unit", _shape(F.col("term"))).join(shapes, "unit").drop("unit")
    return by_word.unionByName(by_shape.select(by_word.columns))


def places(docs: DataFrame, told: DataFrame, total: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, term, start, end): every word outside base spans, of any row, that is a term of ``told``."""
    n_bits = TABLE_BITS
    while n_bits < min(MOST_BITS, BITS_A_TERM * told.count()):
        n_bits *= 2
    # a term's marks: the low half of its hash, and steps of the high half from there
    hashed = told.select(F.xxhash64("term").alias("h")).select(F.expr("h & 4294967295").alias("low"), F.shiftrightunsigned("h", 32).alias("high"))
    marks = hashed.select(F.explode(F.array(*((F.col("low") + k * F.col("high")) % n_bits for k in range(MARKS)))).alias("bit"))
    one = F.lit(1).cast("long")
    rows = marks.groupBy(F.expr("cast(bit div 64 as int)").alias("w")).agg(F.bit_or(F.call_function("shiftleft", one, F.expr("cast(bit % 64 as int)"))).alias("bits")).toArrow()  # at most n_bits / 64 numbers
    table = np.zeros(n_bits // 64, np.int64)
    table[rows["w"].to_numpy()] = rows["bits"].to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(table.astype("<i8").tobytes())

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits, digest = shared.value, xxhash.xxh64_intdigest

        def likely(word: str) -> bool:
            h = digest(word.lower().encode("utf-8", "surrogatepass"), 42)  # as Spark's xxhash64
            low, high = h & 0xFFFFFFFF, h >> 32
            for k in range(MARKS):
                bit = (low + k * high) % n_bits
                if not bits[bit >> 3] >> (bit & 7) & 1:
                    return False
            return True

        for pdf in batches:
            out = []
            for doc_id, text_hash, text in zip(pdf["doc_id"], pdf["text_hash"], pdf["text"]):
                if hits := {w for w in set(_WORD.findall(text)) if likely(w)}:
                    out += [(doc_id, text_hash, m[0].lower(), *m.span()) for m in words_outside(text, base_spans(text)) if m[0] in hits]
            if out:
                yield pd.DataFrame(out, columns=["doc_id", "text_hash", "term", "start", "end"])

    texts = _texts(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("string"))
    met = written(texts.mapInPandas(look, "doc_id string, text_hash long, term string, start long, end long"))
    return _looked_up(met, told.select("term", "n_term"), "term", F.col("n_term") > total / COMMON).select(F.col("doc_id").cast("long").alias("doc_id"), "text_hash", "term", "start", "end")


def _ordered(spans: Column) -> Column:
    """Spans by start, then kind as listed, as text."""
    order = F.array(*(F.lit(k) for k in KINDS))
    keyed = F.transform(spans, lambda x: F.struct(x["start"].alias("start"), F.array_position(order, x["kind"]).alias("k"), x["end"].alias("end"), x["kind"].alias("kind")))
    return F.array_join(F.transform(F.array_sort(keyed), lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """Counts of base spans, their digest and all spans (base and disclosing terms) of every row; ``limits`` are those of ``disclosures``."""
    found = scan(docs, id_col, text_col).checkpoint()
    terms = written(term_counts(docs, text_col))
    told = written(disclosing_terms(written(disclosures(found, terms, **limits)), terms, limits.get("rare", RARE)))
    added = (
        places(docs, told, found.count(), id_col, text_col).groupBy("doc_id", "text_hash")
        .agg(F.collect_set(F.struct(F.lit("term").alias("kind"), "start", "end")).alias("terms"))
        .select(F.col("doc_id").alias("of_doc"), F.col("text_hash").alias("of_text"), "terms")
    )
    rows = found.join(added, F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("text_hash") == F.col("of_text")), "left")
    n = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    every = F.concat("spans", F.coalesce("terms", F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")))
    return rows.select("doc_id", "text_hash", *(n(k) for k in KINDS[:4]), "base_sha256", _ordered(every).alias("spans"), F.coalesce(F.size("terms"), F.lit(0)).cast("long").alias("n_term"), F.size(every).cast("long").alias("n_spans"))


def redact(text: str, spans: str) -> str:
    """The text with base spans and numeric terms removed to a mark, and word terms generalised."""
    out, at = [], 0
    for kind, start, end in (s.split(":") for s in spans.split(",") if s):
        start, end = int(start), int(end)
        if start >= at:
            value = text[start:end]
            out += [text[at:start], "[TERM]" if kind == "term" and not value.isdigit() else "" if kind == "term" else f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """(doc_id, text): every row's text with all spans replaced."""
    spans = find(docs, id_col, text_col, **limits).select(F.col("doc_id").alias("of_doc"), F.col("text_hash").alias("of_text"), "spans").distinct()
    rows = _texts(docs, id_col, text_col)
    replaced = F.pandas_udf(lambda t, s: pd.Series([redact(*x) for x in zip(t, s)], dtype=object), "string")
    met = rows.join(spans, F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("text_hash") == F.col("of_text")))
    return met.select("doc_id", replaced("text", "spans").alias("text"))


__all__ = ["CHANCE", "DISCLOSED", "KINDS", "LEAST_TEXTS", "RARE", "base_spans", "disclosing_terms", "disclosures", "find", "luhn", "places", "redact", "sanitise", "scan", "shape", "span_text", "term_counts", "words_outside"]
