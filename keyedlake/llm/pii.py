"""PII: base patterns, and information-theoretic sanitisation of what reveals them.

Base spans are e-mail addresses, IPv4 addresses, card numbers (Luhn) and phone
numbers.  The values found are the *protected entities*.  A term that occurs near
an entity reveals it as far as the corpus says so: with document frequencies over
all documents, N documents, c(t) with the term, c(e) with the entity and c(t, e)
with both in one context window of ``REACH`` words each side of the entity,

    PMI(t; e) = log(N c(t, e) / ((c(t) + PRIOR) c(e))),   IC(e) = log(N / c(e)).

PRIOR smooths the estimate of how surely the term means the entity, so that a term seen once
says less than one that is always seen with it.  A term whose PMI is at least ``DISCLOSURE``
times the entity's information content discloses it.  *Every* occurrence of such a
term, in any document, becomes a span of kind ``term`` (but where a base span covers it);
``sanitise`` removes them, or generalises those with digits to their shape, and
replaces entities by their kind.  Terms are maximal runs of word characters of any length.

Every count covers all documents.  Texts are scanned three times: for base spans and contexts,
for the document counts of terms that occur near entities, and for the places of
disclosing terms.  The latter two scans pass over most words by a table of 2 ** HASH_BITS bits
(8 MB, whatever the data) of the wanted terms' hashes; what it lets through is joined with
the terms themselves.

Defined results
---------------
* null and empty texts have no spans (the digest of base spans is that of '');
* base matches are leftmost and non-overlapping per kind; a match that fails its check
  is dropped without a retry; spans of different kinds may overlap; all places are
  code points, end exclusive;
* repeated rows: a ``doc_id`` is one document in the counts; rows of equal id and text have
  equal spans; a null ``doc_id`` counts as one document more;
* an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, slices, staged

#: Kinds in the order of the digests.
KINDS = ("email", "ip", "card", "phone", "term")
#: Words on each side of an entity that make its context.
REACH = 8
#: Share of an entity's information content that a term may reveal.
DISCLOSURE = 0.85
#: Documents without the entity that a term is taken to have beside those that were seen.
PRIOR = 0.5
#: Bits of the hash table of wanted terms, as a power of two, and of one of its chunks.
HASH_BITS, CHUNK_BITS = 26, 16

_SLICE = 4 << 20
#: Words whose answers a task remembers.
_REMEMBERED = 300_000
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_LOCAL_RUN = re.compile(r"[A-Za-z0-9._%+-]*")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# a digit run can't begin a match inside itself, so a look-behind keeps the scan linear
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"\w+")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > done and _LOCAL.match(text[begin - 1]):
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            done = domain.end()
            yield begin, done
            at = text.find("@", done)
        else:
            at = text.find("@", at + 1)


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, begin, end) of all base matches, by kind as listed, then begin."""
    spans = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p) < 3 or len(p) == 3 and p <= "255" for p in (p.lstrip("0") for p in m.group().split("."))):
            spans.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 13 <= len(digits) <= 19 and _luhn(digits):
            spans.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m.group())) <= 15:
            spans.append(("phone", *m.span()))
    return spans


def _union(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Begins and ends of the runs that the spans cover."""
    begins, ends = [], []
    for a, b in sorted(spans):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            begins.append(a)
            ends.append(b)
    return begins, ends


def _entity(kind: str, value: str) -> str:
    """One name for the ways to write a value."""
    return f"{kind}:{value.lower() if kind == 'email' else value if kind == 'ip' else _digits(value)}"


def _context(text: str, begin: int, end: int) -> list[tuple[str, int, int]]:
    """Terms of the REACH words on each side, read from as little text as holds them."""
    after, at = [], end
    for m in _WORD.finditer(text, end):
        if len(after) == REACH:
            break
        after.append(m.span())
    width = 16 * REACH
    while True:
        at = max(0, begin - width)
        before = [m.span() for m in _WORD.finditer(text, at, begin)]
        if at == 0 or len(before) > REACH:  # the first word may be cut
            break
        width *= 4
    words = before[-REACH:] + after
    return [(text[a:b].lower(), a, b) for a, b in words]


_FOUND = ("doc_id long, text_key long, text string, base array<struct<kind:string,begin:long,end:long>>, "
          "near array<struct<entity:string,term:string>>")
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("begin", pa.int64()), ("end", pa.int64())]))
_NEAR = pa.list_(pa.struct([("entity", pa.string()), ("term", pa.string())]))


def _find(batches, keep_text: bool = False):
    for batch in slices(batches, limit=_SLICE):
        base, near = [], []
        for text in batch.column("text").to_pylist():
            spans = base_spans(text) if text else []
            begins, ends = _union([(a, b) for _, a, b in spans])
            rows = {(_entity(kind, text[a:b]), t) for kind, a, b in spans for t, x, y in _context(text, a, b)
                    if bisect.bisect_right(ends, x) == bisect.bisect_left(begins, y)}
            base.append([{"kind": k, "begin": a, "end": b} for k, a, b in spans])
            near.append([{"entity": e, "term": t} for e, t in sorted(rows)])
        text = batch.column("text") if keep_text else pa.nulls(batch.num_rows, pa.string())
        yield pa.record_batch([batch.column("doc_id"), batch.column("text_key"), text, pa.array(base, _SPANS),
                               pa.array(near, _NEAR)], names=["doc_id", "text_key", "text", "base", "near"])


def _hash_table(terms: DataFrame):
    """A broadcast table of 2 ** HASH_BITS bits: those of the terms' hashes are set."""
    def chunk(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(1 << CHUNK_BITS, bool)
        bits[rows["at"]] = True
        return pd.DataFrame({"chunk": [key[0]], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    at = F.shiftright(F.crc32(F.col("term").cast("binary")), 32 - HASH_BITS)
    chunks = (terms.select(at.alias("h")).distinct()
              .select(F.shiftright("h", CHUNK_BITS).alias("chunk"), F.pmod("h", F.lit(1 << CHUNK_BITS)).alias("at"))
              .groupBy("chunk").applyInPandas(chunk, "chunk long, bits binary").collect())
    size = 1 << (CHUNK_BITS - 3)
    table = bytearray(1 << (HASH_BITS - 3))
    for r in chunks:
        table[r["chunk"] * size:(r["chunk"] + 1) * size] = r["bits"]
    return terms.sparkSession.sparkContext.broadcast(bytes(table))


class _Wanted:
    """The words that the table lets through; answers are remembered, as most words come again."""

    def __init__(self, table: bytes):
        self.table, self.known = table, {}

    def __call__(self, words: set[str]) -> list[str]:
        table, known, out = self.table, self.known, []
        if len(known) > _REMEMBERED:
            known.clear()
        for word in words:
            hit = known.get(word)
            if hit is None:
                h = zlib.crc32(word.encode()) >> (32 - HASH_BITS)
                hit = known[word] = table[h >> 3] >> (h & 7) & 1
            if hit:
                out.append(word)
        return out


def _count_terms(handle):
    """Documents with each term of the table, summed up within the task as far as memory is bounded."""
    def run(batches):
        wanted, counts = _Wanted(handle.value), {}

        def rows():
            return pa.record_batch([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())],
                                   names=["term", "n"])

        for batch in slices(batches, limit=_SLICE):
            for text in batch.column("text").to_pylist():
                for term in wanted(set(_WORD.findall(text.lower()))) if text else ():
                    counts[term] = counts.get(term, 0) + 1
            if len(counts) > 500_000:
                yield rows()
                counts.clear()
        yield rows()
    return run


def _places(text: str, lowered: str, terms: list[str]) -> dict[str, list[dict]]:
    """Spans of each term among the text's words."""
    out: dict[str, list[dict]] = {}
    if len(lowered) != len(text):  # places in one aren't those in the other
        for m in _WORD.finditer(text):
            if (term := m.group().lower()) in terms:
                out.setdefault(term, []).append({"begin": m.start(), "end": m.end()})
        return out
    part_of_word = lambda c: c.isalnum() or c == "_"
    for term in terms:
        at = lowered.find(term)
        while at >= 0:
            end = at + len(term)
            if not (at and part_of_word(lowered[at - 1]) or end < len(lowered) and part_of_word(lowered[end])):
                out.setdefault(term, []).append({"begin": at, "end": end})
            at = lowered.find(term, end)
    return out


_PLACED = "doc_id long, text_key long, term string, spans array<struct<begin:long,end:long>>"


def _place_terms(handle):
    """Where the terms of the table stand: a row a text and term."""
    def run(batches):
        wanted = _Wanted(handle.value)
        for batch in slices(batches, limit=_SLICE):
            out = []
            for doc_id, key, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_key", "text"))):
                lowered = text.lower() if text else ""
                terms = wanted(set(_WORD.findall(lowered))) if text else []
                out += [(doc_id, key, t, at) for t, at in (_places(text, lowered, terms) if terms else {}).items()]
            columns = list(zip(*out)) or [[]] * 4
            types = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)],
                                  names=["doc_id", "text_key", "term", "spans"])
    return run


def disclosing_terms(found: DataFrame, texts: DataFrame) -> DataFrame:
    """(term): those that disclose some entity of ``found``, by counts over ``texts``."""
    near = found.filter(F.size("near") > 0).select("doc_id", F.explode("near").alias("n")).select("doc_id", "n.*")
    pairs = near.distinct().groupBy("entity", "term").agg(F.count(F.lit(1)).alias("c_te"))
    entities = near.select("doc_id", "entity").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("c_e"))
    wanted = staged(pairs.join(entities, "entity"), "pii-pairs")
    counted = (arrow_map(texts.select("text"), _count_terms(_hash_table(wanted.select("term"))), "term string, n long")
               .groupBy("term").agg(F.sum("n").alias("c_t")))
    n_docs = float(found.count())
    information = F.log(F.lit(n_docs) / F.col("c_e"))
    pmi = F.log(F.lit(n_docs) * F.col("c_te") / ((F.col("c_t") + F.lit(PRIOR)) * F.col("c_e")))
    return (wanted.join(counted, "term").filter((information > 0) & (pmi >= DISCLOSURE * information))
            .select("term").distinct())


def find(docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, text (if kept, else null), base (spans of base kinds)
    and terms (spans of terms that disclose an entity)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    found = staged(arrow_map(texts, partial(_find, keep_text=keep_text), _FOUND), "pii-found")
    terms = staged(disclosing_terms(found, texts), "pii-terms")
    places = arrow_map(texts, _place_terms(_hash_table(terms)), _PLACED).join(terms, "term", "left_semi")
    marked = (places.groupBy(F.col("doc_id").alias("d"), F.col("text_key").alias("k"))
              .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("terms")))
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k"))
    own = F.filter("terms", lambda t: ~F.exists("base", lambda s: (s["begin"] < t["end"]) & (t["begin"] < s["end"])))
    return (found.join(marked, same, "left")
            .select("doc_id", "text", "base",
                    F.coalesce(own, F.expr("cast(array() as array<struct<begin:long,end:long>>)")).alias("terms")))


def _replacement(kind: str, value: str) -> str:
    if kind != "term":
        return f"[{kind.upper()}]"
    return re.sub(r"[^\W\d_]", "x", re.sub(r"\d", "0", value)) if re.search(r"\d", value) else "[TERM]"


def _sanitised(batches):
    for batch in batches:
        out = []
        for text, base, terms in zip(*(batch.column(c).to_pylist() for c in ("text", "base", "terms"))):
            spans = [(s["begin"], -s["end"], s["kind"]) for s in base] + \
                    [(s["begin"], -s["end"], "term") for s in terms]
            parts, done = [], 0
            for begin, end, kind in sorted(spans):  # of spans that overlap the first, longest names the run
                if begin >= done:
                    parts += [text[done:begin], _replacement(kind, text[begin:-end])]
                done = max(done, -end)
            out.append("".join([*parts, (text or "")[done:]]))
        yield pa.record_batch([batch.column("doc_id"), pa.array(out, pa.string())], names=["doc_id", "text"])


def sanitise(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id and the text with entities replaced by their kind and
    disclosing terms removed or generalised."""
    return arrow_map(find(docs, keep_text=True), _sanitised, "doc_id long, text string")


def joined(spans: Column) -> Column:
    """``kind:begin:end`` of an array of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"], s["end"])), ",")
