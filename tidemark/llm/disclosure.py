"""Personal data, and the words that give it away, by what the corpus says of them.

Base kinds (addresses of mail, IP addresses, card and phone numbers) are found by their patterns. Each value is a
protected entity. Words within ``NEAR`` words of one of its places stand near it. Of an entity c
and a term t, over all documents and outside the base spans,

    information of c        IC(c)    = -log2(words near c / all words)
    what t says of c        PMI(c,t) =  log2(P(near c | t) / P(near c))
    what t leaves open      IC(c) - PMI(c,t) = -log2(P(near c | t)),  P(near c | t) = t's near c / all t's

A term that leaves at most ``MOST_BITS`` bits open discloses the entity, wherever it stands. Chance and copies are no
evidence: the documents that show the pair must stand for at least ``CONTEXTS`` different contexts. A context is the
smallest word hash of the document beyond the entity's surroundings, which copies and near copies share, and the
number is the effective one (square of the documents over the sum of squares by context), so that a large
group of near copies with a few strays still counts for about one.

A disclosing term is generalised to its class, the terms with the same first ``HEAD`` characters, where the class
leaves more than ``MOST_BITS`` open, and else removed.

Counts are sums over all documents, added up before they are shuffled. Only terms that are candidates or in a
candidate's class are counted: a fixed-size bitmap marks them, and what passes it by chance is counted in vain,
never wrongly. Words in a document that pass the bitmap of disclosing terms are joined with their table, by
term; no table of terms is broadcast.

Null and empty texts have no spans. Rows are judged by themselves: ids may be null or repeat. In an empty
table nothing is found. Other columns of ``documents`` are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Words, checkpointed, numbered, pieces, unnumbered, word_table

KINDS = ("email", "ip", "card", "phone")
#: the kind of a span that the corpus gives
TERM = "term"
#: words on either side of an entity that are near it
NEAR = 32
#: effective number of contexts that make evidence
CONTEXTS = 3.0
#: bits that a disclosing term leaves open at most
MOST_BITS = 1.0
#: characters that the terms of a class share
HEAD = 3
#: bits of a term's hash that number its place in a bitmap
SLOT_BITS = 22
#: different terms that a task counts before it hands them on
HELD = 100_000

_TABLE = word_table()
_LOWER = {c: c + 32 for c in range(65, 91)}
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_NUMBERS = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    twice = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(map(int, digits[::-2])) + sum(twice)) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int, str]]:
    end, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        # the characters before the @, read backwards as far as the last match
        local = _LOCAL.match(text[end:at][::-1]) if domain else None
        if local:
            start, end = at - local.end(), domain.end()
            yield start, end, text[start:end].lower()
        else:
            # no match holds an @ but its own, so the next may begin right behind this one
            end = at + 1
        at = text.find("@", end)


def _ips(text: str) -> Iterator[tuple[int, int, str]]:
    for chain in _NUMBERS.finditer(text):
        parts = chain.group().split(".")
        start = chain.start()
        for k in range(0, len(parts) - 3, 4):
            size = sum(map(len, parts[k:k + 4])) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts[k:k + 4]):
                yield start, start + size, text[start:start + size]
            start += size + 1


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(number of the kind, start, end, entity) of the base matches, by kind and start; the entity is the value in its plain form."""
    out = [(0, *m) for m in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return out
    if "." in text:
        out += [(1, *m) for m in _ips(text)]
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end(), digits))
    for m in _PHONE.finditer(text) if "+" in text else ():
        digits = _digits(m.group())
        if 8 <= len(digits) <= 15:
            out.append((3, m.start(), m.end(), digits))
    return out


def outside_words(text: str, spans: list[tuple[int, int, int, str]]) -> list[tuple[int, int, str]]:
    """(start, end, word) of the words in lower case that touch no span."""
    words = [(m.start(), m.end(), m.group()) for m in _WORD.finditer(text.translate(_LOWER))]
    if not spans:
        return words
    starts, ends = [w[0] for w in words], [w[1] for w in words]
    gone = bytearray(len(words))
    for _, s, e, _ in spans:
        first, last = bisect_right(ends, s), bisect_left(starts, e)
        gone[first:last] = b"\1" * max(0, last - first)
    return [w for w, g in zip(words, gone) if not g]


def _word_hash(word: str | bytes) -> int:
    return xxhash.xxh64_intdigest(word, seed=42)


def near_terms(text: str) -> Iterator[tuple[int, str, int, Counter]]:
    """(kind, entity, context, terms near it) of each entity of a text; a term counts once a place, however many of the entity's are near."""
    spans = base_spans(text)
    if not spans:
        return
    words = outside_words(text, spans)
    starts, hashes = [w[0] for w in words], [_word_hash(w[2]) for w in words]
    smallest = sorted(range(len(words)), key=hashes.__getitem__)
    places: dict[tuple[int, str], list[int]] = {}
    for kind, start, _, entity in spans:
        places.setdefault((kind, entity), []).append(bisect_left(starts, start))
    for (kind, entity), at in places.items():
        near = sorted({i for p in at for i in range(max(0, p - NEAR), min(len(words), p + NEAR))})
        inside = set(near)
        context = next((hashes[i] for i in smallest if i not in inside), min(hashes, default=0))
        yield kind, entity, context >> 1, Counter(words[i][2] for i in near)


def evidence(docs: DataFrame) -> DataFrame:
    """(kind, entity, term, together, docs, contexts): how often a term stands near an entity, in how many documents and effective contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(0).to_pylist():
                for kind, entity, context, terms in near_terms(text or ""):
                    rows += [(KINDS[kind], entity, term, context, n) for term, n in terms.items()]
                if len(rows) > HELD:
                    yield _batch(rows, _EVIDENCE)
                    rows = []
            yield _batch(rows, _EVIDENCE)

    rows = docs.select("text").mapInArrow(run, "kind string, entity string, term string, context long, n long")
    by_context = rows.groupBy("kind", "entity", "term", "context").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("docs"))
    docs_ = F.col("docs").cast("double")
    return by_context.groupBy("kind", "entity", "term").agg(
        F.sum("n").alias("together"), F.sum("docs").alias("docs"), (F.pow(F.sum(docs_), 2) / F.sum(docs_ * docs_)).alias("contexts"))


_EVIDENCE = (("kind", pa.string()), ("entity", pa.string()), ("term", pa.string()), ("context", pa.int64()), ("n", pa.int64()))
_COUNTS = (("term", pa.string()), ("n", pa.int64()))


def _batch(rows: list[tuple], fields: tuple) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, fields)], [n for n, _ in fields])


def bitmap(terms: DataFrame, column: str) -> bytes:
    """Which slots the terms have, a bit each; at most 2**SLOT_BITS / 32 rows reach the driver."""
    slots = terms.select(F.shiftrightunsigned(F.xxhash64(column), 64 - SLOT_BITS).alias("slot"))
    words = slots.select(F.shiftright("slot", 5).alias("at"), F.expr("shiftleft(1L, CAST(slot & 31 AS INT))").alias("bit"))
    out = np.zeros(1 << (SLOT_BITS - 5), np.uint32)
    for row in words.groupBy("at").agg(F.bit_or("bit").alias("bits")).toLocalIterator():
        out[row["at"]] = row["bits"]
    return out.astype("<u4").tobytes()


class Marked:
    """Whether a term or its class has a marked slot; answers for classes are kept."""

    def __init__(self, terms: bytes, classes: bytes | None = None):
        self.terms, self.classes = terms, classes
        self.known: dict[str, bool] = {}

    @staticmethod
    def _has(bits: bytes, value: str) -> bool:
        slot = _word_hash(value) >> (64 - SLOT_BITS)
        return bool(bits[slot >> 3] >> (slot & 7) & 1)

    def __contains__(self, term: str) -> bool:
        if self._has(self.terms, term):
            return True
        if self.classes is None:
            return False
        head = term[:HEAD]
        if head not in self.known:
            if len(self.known) > HELD:
                self.known.clear()
            self.known[head] = self._has(self.classes, head)
        return self.known[head]


def _counted(texts: list[str]) -> Iterator[tuple[list[int], Words, np.ndarray, np.ndarray]]:
    """Runs of texts: their places, their words, and of each different word its first place and number."""
    raw = [t.encode() for t in texts]
    for a, b in pieces(raw):
        words = Words(raw[a:b], _TABLE)
        _, first, times = np.unique(words.hash, return_index=True, return_counts=True)
        yield range(a, b), words, first, times


def term_counts(docs: DataFrame, marked_terms: bytes, marked_classes: bytes) -> DataFrame:
    """(term, n) of the terms that are marked or whose class is; the null term has the number of all words. Words in base spans do not count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked, counts, total = Marked(marked_terms, marked_classes), Counter(), 0
        for batch in batches:
            plain = []
            for text in batch.column(0).to_pylist():
                spans = base_spans(text or "")
                if not spans:
                    plain.append(text or "")
                    continue
                words = outside_words(text, spans)
                total += len(words)
                for w, n in Counter(w[2] for w in words).items():
                    if w in marked:
                        counts[w] += n
            for _, words, first, times in _counted(plain):
                total += len(words.hash)
                for i, n in zip(first.tolist(), times.tolist()):
                    w = words.raw[words.starts[i]:words.ends[i]].decode()
                    if w in marked:
                        counts[w] += n
            if len(counts) > HELD:
                yield _batch(list(counts.items()), _COUNTS)
                counts.clear()
        yield _batch([*counts.items(), (None, total)], _COUNTS)

    return docs.select("text").mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def disclosures(docs: DataFrame) -> DataFrame:
    """The disclosing terms: kind, entity, term, together, n_term, contexts, information, pmi, left_open, class_left_open, action.

    ``information`` is IC(entity), ``pmi`` what the term says of it and ``left_open`` the difference, all in bits.
    """
    pairs = checkpointed(evidence(docs).withColumn("head", F.substring("term", 1, HEAD)))
    candidates = pairs.where(F.col("contexts") >= CONTEXTS)
    counts = checkpointed(term_counts(docs, bitmap(candidates, "term"), bitmap(candidates, "head")))
    all_words = counts.where("term IS NULL").select(F.col("n").alias("all_words"))
    known = counts.where("term IS NOT NULL")
    near = pairs.groupBy("kind", "entity").agg(F.sum("together").alias("near"))

    def left_open(together: str, n: str):
        return F.log2(F.col(n) / F.col(together))

    found = candidates.join(known.select("term", F.col("n").alias("n_term")), "term").withColumn("left_open", left_open("together", "n_term"))
    found = found.where(F.col("left_open") <= MOST_BITS)
    # the entity's words of the term's class, and all words of that class
    heads = pairs.join(found.select("kind", "entity", "head").distinct(), ["kind", "entity", "head"], "left_semi")
    heads = heads.groupBy("kind", "entity", "head").agg(F.sum("together").alias("class_together"))
    classes = known.groupBy(F.substring("term", 1, HEAD).alias("head")).agg(F.sum("n").alias("n_class"))
    found = found.join(heads, ["kind", "entity", "head"]).join(classes, "head").withColumn("class_left_open", left_open("class_together", "n_class"))
    # one row of one number
    found = found.join(near, ["kind", "entity"]).join(F.broadcast(all_words))
    information = F.log2(F.col("all_words") / F.col("near"))
    general = (F.length("term") > HEAD) & (F.col("class_left_open") > MOST_BITS)
    return found.select("kind", "entity", "term", "together", "n_term", "contexts", information.alias("information"), (information - F.col("left_open")).alias("pmi"),
                        "left_open", "class_left_open", F.when(general, "generalise").otherwise("remove").alias("action"))


def replacements(found: DataFrame) -> DataFrame:
    """(term, replacement): its class, or nothing where some entity asks for its removal."""
    removed = F.max((F.col("action") == "remove").cast("int")) == 1
    return found.groupBy("term").agg(F.when(removed, f"[{TERM.upper()}]").otherwise(F.concat(F.substring("term", 1, HEAD), F.lit("*"))).alias("replacement"))


_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("term", pa.string())]))


def _spans(marked_terms: bytes):
    """doc_id, the base spans, and the words that may be disclosing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = Marked(marked_terms)
        none = not any(marked_terms)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            spans = [base_spans(t) for t in texts]
            hits: list[list] = [[] for _ in texts]
            for places, words, first, _ in _counted(texts) if not none else ():
                some = [i for i in first.tolist() if words.raw[words.starts[i]:words.ends[i]].decode() in marked]
                for k in np.unique(words.text[np.isin(words.hash, words.hash[some])]).tolist():
                    own = places[k]
                    hits[own] = [{"kind": TERM, "start": s, "end": e, "term": w} for s, e, w in outside_words(texts[own], spans[own]) if w in marked]
            base = [[{"kind": KINDS[k], "start": s, "end": e, "term": None} for k, s, e, _ in own] for own in spans]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, _SPAN), pa.array(hits, _SPAN)], ["doc_id", "base", "hits"])

    return run


def personal_data(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, ``base`` and ``terms``, spans as (kind, start, end, replacement) in code points; base by kind and start, terms by start."""
    instead = checkpointed(replacements(disclosures(docs)))
    span = "array<struct<kind:string,start:long,end:long,term:string>>"
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_spans(bitmap(instead, "term")), f"doc_id long, base {span}, hits {span}")
    found = checkpointed(found.withColumn("__row", F.monotonically_increasing_id()))
    hits = found.select("__row", F.explode("hits").alias("h")).select("__row", "h.*").join(instead, "term")
    # the words of one document at most
    terms = hits.groupBy("__row").agg(F.array_sort(F.collect_list(F.struct("start", "end", "replacement"))).alias("terms"))
    terms = terms.withColumn("terms", F.transform("terms", lambda t: F.struct(F.lit(TERM).alias("kind"), t["start"], t["end"], t["replacement"])))
    base = F.transform("base", lambda b: F.struct(b["kind"], b["start"], b["end"], F.concat(F.lit("["), F.upper(b["kind"]), F.lit("]")).alias("replacement")))
    rows = found.select("__row", "doc_id", base.alias("base")).join(terms, "__row", "left").drop("__row")
    return rows.withColumn("terms", F.coalesce("terms", F.filter("base", lambda b: F.lit(False))))


def span_digest(found: DataFrame) -> DataFrame:
    """Per row the base matches of each kind, a digest of their spans, and all spans as text."""

    def text(column: str):
        return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[number(k) for k in KINDS], F.sha2(F.encode(text("base"), "UTF-8"), 256).alias("base_sha256"),
                        F.array_join(F.filter(F.array(text("base"), text("terms")), lambda t: t != ""), ",").alias("spans"))


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with base spans and disclosing terms replaced in ``text``; spans that overlap become the first one's replacement."""
    rows = numbered(docs)
    found = personal_data(rows.select(F.col("__n").alias("doc_id"), "text"))
    spans = found.select(F.col("doc_id").alias("__n"), F.array_sort(F.transform(F.concat("base", "terms"), lambda s: F.struct(s["start"], s["end"], s["replacement"]))).alias("__spans"))
    merged = F.aggregate("__spans", F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("done")), _replaced,
                         lambda held: F.concat(held["done"], F.substring(F.col("text"), (held["at"] + 1).cast("int"), F.length("text"))))
    out = rows.join(spans, "__n")
    out = out.withColumn("text", F.when(F.size("__spans") > 0, merged).otherwise(F.col("text")))
    return unnumbered(out.select(*(F.col(f"`{c}`") for c in rows.columns)))


def _replaced(held, span):
    """The text up to the end of a span, with what replaces it, or nothing more where the last span reaches into it."""
    gap = F.substring(F.col("text"), (held["at"] + 1).cast("int"), (span["start"] - held["at"]).cast("int"))
    new = F.concat(held["done"], gap, span["replacement"])
    return F.struct(F.greatest(held["at"], span["end"]).alias("at"), F.when(span["start"] >= held["at"], new).otherwise(held["done"]).alias("done"))
