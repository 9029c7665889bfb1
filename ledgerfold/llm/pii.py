"""Personal data: patterns, and information-theoretic sanitisation of terms around them.

Emails, IP addresses, cards and phone numbers are found by fixed patterns. Each
value found is a protected entity. Terms are judged by how much they disclose, once
with counts over all lines and once with counts over all documents: the pointwise
mutual information PMI(entity; term) = log(units * both / (entity * term)) over the
entity's own information content log(units / entity) is the share of it that the
term gives away. ``both`` is estimated from the other witnesses of each: of n different
lines or texts that hold the two, any one is expected by n - 1, so that ``both`` counts
(n - 1) / n of itself. One witness speaks for every word beside it alike and proves
nothing; two can prove that a rare term goes with an entity; with many, the estimate is
the plain one. Copies of a line or text are one witness. A term that discloses at least
``generalise`` of an entity is generalised, at least ``remove`` removed, wherever it
stands: without the value beside it, it discloses most.

A term is a run of letters and digits of any length, in lower case; in Chinese and
Japanese letters and Korean syllables, which are written without blanks or with
endings, every two neighbours.

Entities that occur in the same units have the same counts with every term, so one of
them stands for all: a directory that repeats with all its entities is one entity for
each of its terms. Pairs are made only for entities with two witnesses, as others
disclose nothing. Terms are counted in the texts with values first, and in all texts
only if they may still disclose enough; they are counted and placed only where a bitmap
of fixed size may hold them, and joins on the term then decide.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.packing import slices
from ledgerfold.sources.workspace import shared_folder, written

# The kinds in their order; those of the base patterns come first.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "generalise", "remove")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DIGITS = re.compile(r"[0-9]+")
IP_REST = re.compile(r"(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
UNSPACED = "\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uac00-\ud7af\uf900-\ufaff\U00020000-\U0003ffff"
WORD = re.compile(rf"[^\W_{UNSPACED}]+")
RUN = re.compile(rf"[{UNSPACED}]+")
# What no term holds, and words of letters whose lower case is one letter everywhere, and digits.
MARKS, PLAIN = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", "^[0-9A-Za-zÀ-ÖØ-öø-ÿ]+$"

GENERALISE, REMOVE = 0.7, 0.9
TERMS_AT_ONCE, PAIRS_AT_ONCE, SLICE_BYTES = 1 << 18, 1 << 16, 1 << 21
# Bits of a bitmap: so many for each term, between these bounds (16 MB at most).
BITS_PER_TERM, LEAST_BITS, MOST_BITS = 64, 1 << 20, 1 << 27

Span = tuple[int, int, int]


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches: around each @, as far left as the local part goes."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            last = found.end()
            out.append((start, last))
        at = text.find("@", max(at + 1, last))
    return out


def addresses(text: str) -> list[tuple[int, int]]:
    """Four numbers joined by dots, each up to 255."""
    out, last = [], 0
    for digits in DIGITS.finditer(text):
        start, end = digits.span()
        if start < last or not text.startswith(".", end):
            continue
        rest = IP_REST.match(text, end)
        if rest:
            last = rest.end()
            parts = [p.lstrip("0") for p in text[start:last].split(".")]
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                out.append((start, last))
    return out


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def cards(text: str) -> list[tuple[int, int]]:
    """12 to 19 digits with single blanks or dashes, the last digit being the check digit."""
    out = []
    for found in CARD.finditer(text):
        digits = found[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and _luhn(digits):
            out.append(found.span())
    return out


def phones(text: str) -> list[tuple[int, int]]:
    """A plus and 9 to 15 digits."""
    return [
        found.span() for found in PHONE.finditer(text)
        if 9 <= sum("0" <= c <= "9" for c in found[0]) <= 15
    ]


def base_spans(text: str) -> list[Span]:
    """(start, kind, end) of all base patterns by start, then kind."""
    spans = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if DIGITS.search(text):
        spans += [(a, 1, b) for a, b in addresses(text)]
        spans += [(a, 2, b) for a, b in cards(text)]
        spans += [(a, 3, b) for a, b in phones(text)]
    return sorted(spans)


def _neighbours(text: str) -> list[tuple[int, int, str]]:
    """(start, end, term) of every two neighbours of the runs without blanks, and of runs of one."""
    out = []
    for run in RUN.finditer(text) if not text.isascii() else ():
        first, last = run.span()
        out += [(a, a + 2, text[a:a + 2]) for a in range(first, last - 1)] or [(first, last, run[0])]
    return out


def terms(text: str) -> list[tuple[int, int, str]]:
    """(start, end, term) of every term."""
    # Found first, as lowering may add marks that are no letters.
    return [(*m.span(), m[0].lower()) for m in WORD.finditer(text)] + _neighbours(text)


def _merged(spans: list[Span]) -> tuple[list[int], list[int]]:
    """Starts and ends of the spans, those that overlap as one."""
    starts, ends = [], []
    for start, _, end in spans:
        if ends and start < ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends


def _outside(text: str, spans: list[Span]) -> list[tuple[int, int, str]]:
    """The terms that touch none of the spans."""
    starts, ends = _merged(spans)
    out = []
    for a, b, term in terms(text):
        before = bisect_left(starts, b) - 1
        if before < 0 or ends[before] <= a:
            out.append((a, b, term))
    return out


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def _lines(text: str, spans: list[Span]) -> list[tuple[int, int]]:
    """Start and end of the line of each span, as far as the line in which the span ends."""
    out = []
    for start, _, end in spans:
        last = text.find("\n", end)
        out.append((text.rfind("\n", 0, start) + 1, len(text) if last < 0 else last))
    return out


SPAN = "struct<start: long, kind: int, end: long>"
_SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
_VALUE = pa.struct([("kind", pa.string()), ("value", pa.string()), ("line", pa.int64())])


def found_in(docs: DataFrame) -> DataFrame:
    """n_lines, twin (a hash of the text), text and values of every row; the text only where it has values."""

    def find(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            values = []
            for text in texts:
                spans = base_spans(text)
                values.append([
                    {"kind": kind, "value": value, "line": line} for kind, value, line in dict.fromkeys(
                        (BASE[kind], text[start:end], _hash(text[first:last]))
                        for (start, kind, end), (first, last) in zip(spans, _lines(text, spans))
                    )
                ])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([t.count("\n") + 1 for t in texts], pa.int64()),
                    pa.array([_hash(t) for t in texts], pa.int64()),
                    pa.array([t if v else None for t, v in zip(texts, values)], pa.string()),
                    pa.array(values, pa.list_(_VALUE)),
                ],
                names=["n_lines", "twin", "text", "values"],
            )

    return docs.select("text").mapInArrow(
        find, "n_lines long, twin long, text string, values array<struct<kind: string, value: string, line: long>>"
    )


PAIRS = "by string, unit long, kind string, value string, term string, n long"


def together(found: DataFrame) -> DataFrame:
    """(by, kind, value, term, support, both): in how many lines and documents an entity and a term occur.

    ``by`` is line or document; ``support`` counts different ones, ``both`` all. The row
    of an entity itself has the empty term. An entity stands for all that occur in the
    same lines, or documents. Those with one witness are left out.
    """
    values = found.select("twin", F.inline("values"))
    by_line = _leaders(values, "line").select("kind", "value", F.col("leader").alias("in_line"))
    by_text = _leaders(values, "twin").select("kind", "value", F.col("leader").alias("in_text"))
    entities = values.select("twin", "kind", "value").distinct().join(
        by_line.join(by_text, ["kind", "value"], "full"), ["kind", "value"]
    ).groupBy("twin").agg(
        F.collect_set("in_text").alias("in_text"),
        F.collect_list(F.when(F.col("in_line").isNotNull(), F.struct("kind", "value", "in_line"))).alias("in_line"),
    )
    texts = found.where("text is not null").groupBy("twin").agg(
        F.first("text").alias("text"), F.count(F.lit(1)).alias("copies")
    ).join(entities, "twin").select("twin", "text", "copies", "in_text", "in_line")

    def pair(batches):
        rows: list[tuple] = []
        for batch in batches:
            for twin, text, copies, in_text, in_line in zip(*[c.to_pylist() for c in batch.columns]):
                leaders = {(e["kind"], e["value"]): tuple(e["in_line"].values()) for e in in_line}
                for row in pairs(twin, text, copies, [tuple(e.values()) for e in in_text], leaders):
                    rows.append(row)
                    if len(rows) >= PAIRS_AT_ONCE:
                        yield of_rows(rows)
                        rows = []
        yield of_rows(rows)

    def pairs(twin, text, copies, in_text, leaders):
        spans = base_spans(text)
        outside = _outside(text, spans)
        ordered = sorted(outside)
        starts = [a for a, _, _ in ordered]
        whole = {term for _, _, term in outside}
        for kind, value in in_text:
            yield "document", twin, kind, value, "", copies
            for term in whole:
                yield "document", twin, kind, value, term, copies
        by_line: dict[tuple[int, int], set] = {}
        for (start, kind, end), place in zip(spans, _lines(text, spans)):
            if leader := leaders.get((BASE[kind], text[start:end])):
                by_line.setdefault(place, set()).add(leader)
        for (first, last), own in by_line.items():
            line = _hash(text[first:last])
            beside = {t for _, _, t in ordered[bisect_left(starts, first):bisect_left(starts, last)]}
            for kind, value in own:
                yield "line", line, kind, value, "", copies
                for term in beside:
                    yield "line", line, kind, value, term, copies

    def of_rows(rows):
        columns = list(zip(*rows)) or [()] * 6
        types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()]
        names = ["by", "unit", "kind", "value", "term", "n"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    per_unit = texts.mapInArrow(pair, PAIRS).groupBy("by", "kind", "value", "term", "unit").agg(F.sum("n").alias("n"))
    return per_unit.groupBy("by", "kind", "value", "term").agg(
        F.count(F.lit(1)).alias("support"), F.sum("n").alias("both")
    ).where("support > 1")


def _leaders(values: DataFrame, unit: str) -> DataFrame:
    """(kind, value, leader) of the entities in two or more units; the leader is the first that is in the same ones."""
    entity = F.struct("kind", "value")
    seen = values.select("kind", "value", unit).distinct().groupBy("kind", "value").agg(
        F.count(F.lit(1)).alias("units"), *[F.bit_xor(F.xxhash64(F.lit(i), unit)).alias(f"units_{i}") for i in (1, 2)]
    ).where("units > 1")
    same = ["units", "units_1", "units_2"]
    return seen.join(seen.groupBy(*same).agg(F.min(entity).alias("leader")), same)


def _bitmap(some: DataFrame):
    """Broadcast bits that are set at the hash of every term of ``some``, a written table."""
    size = BITS_PER_TERM * some.select("term").distinct().count()
    size = min(max(LEAST_BITS, 1 << size.bit_length()), MOST_BITS)
    place = F.crc32(F.encode("term", "utf-8")).bitwiseAND(F.lit(size - 1)) + 1
    pieces = some.groupBy(F.bitmap_bucket_number(place).alias("piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    bits = bytearray(size // 8)
    for row in pieces.toLocalIterator():
        at = (row.piece - 1) * len(row.bits)
        bits[at:at + len(row.bits)] = row.bits
    return some.sparkSession.sparkContext.broadcast(bytes(bits))


class _Wanted:
    """Where the terms whose bit is set stand in texts.

    No term goes over a blank, so texts are split at blanks and each distinct run is searched
    once. One that is a plain word between marks is one term; others are searched by
    ``terms`` and remembered until there are too many. Terms are numbered by their places in
    ``names``, until ``forget``.
    """

    def __init__(self, bits: bytes):
        self.bits = np.frombuffer(bits, np.uint8)
        self.last, self.any = 8 * len(bits) - 1, bool(self.bits.any())
        self.forget()

    def forget(self) -> None:
        self.names: list[str] = []
        self.numbers: dict[str, int] = {}
        self.others: dict[str, list[tuple[int, int, int]]] = {}

    def _numbers(self, found: pa.Array) -> np.ndarray:
        """The number of each term, -1 where its bit is not set."""
        coded = found.dictionary_encode()
        distinct = coded.dictionary
        bit = np.array([crc32(t) for t in distinct.cast(pa.large_binary()).to_pylist()], np.int64) & self.last
        wanted = np.flatnonzero(self.bits[bit >> 3] >> (bit & 7) & 1)
        numbers = np.full(len(distinct), -1, np.int64)
        for i, term in zip(wanted.tolist(), distinct.take(pa.array(wanted)).to_pylist()):
            number = self.numbers.setdefault(term, len(self.names))
            if number == len(self.names):
                self.names.append(term)
            numbers[i] = number
        return numbers[coded.indices.to_numpy(zero_copy_only=False)]

    def _inside(self, runs: pa.Array) -> np.ndarray:
        """Run, number, start and end of the terms of distinct runs, by run."""
        cores = pc.ascii_ltrim(runs, MARKS)
        start = pc.subtract(pc.binary_length(runs), pc.binary_length(cores)).to_numpy(zero_copy_only=False)
        cores = pc.ascii_rtrim(cores, MARKS)
        plain = pc.match_substring_regex(cores, PLAIN).to_numpy(zero_copy_only=False)
        words, start = cores.filter(pa.array(plain)), start[plain]
        end = start + pc.utf8_length(words).to_numpy(zero_copy_only=False)
        one = np.stack([np.flatnonzero(plain), self._numbers(pc.utf8_lower(words)), start, end], axis=1)
        rest, at = runs.filter(pa.array(~plain)).to_pylist(), np.flatnonzero(~plain)
        if len(self.others) > TERMS_AT_ONCE:
            self.others = {}
        new = [run for run in rest if run not in self.others]
        found = [(run, *place) for run in new for place in terms(run)]
        self.others.update((run, []) for run in new)
        numbers = self._numbers(pa.array([term for *_, term in found], pa.large_string())).tolist()
        for (run, a, b, _), number in zip(found, numbers):
            if number >= 0:
                self.others[run].append((number, a, b))
        more = [(i, *place) for i, run in zip(at.tolist(), rest) for place in self.others[run]]
        both = np.concatenate([one[one[:, 1] >= 0], np.array(more, np.int64).reshape(-1, 4)]).astype(np.int64)
        return both[np.argsort(both[:, 0], kind="stable")]

    def places(self, texts: pa.Array) -> tuple[np.ndarray, ...]:
        """term, text, line, start and end of every place: numbers of the term, the text and the line, code points.

        Line numbers are those of no other text. NULL counts as empty.
        """
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        bounds = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))])
        if not self.any or not bounds[-1]:
            return (np.zeros(0, np.int64),) * 5
        offset = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset]
        data = np.frombuffer(texts.buffers()[2], np.uint8)[offset:offset + bounds[-1]]
        blank = (data == 32) | ((data >= 9) & (data <= 13))
        begins = np.concatenate([[True], blank[:-1]])
        begins[bounds[bounds < len(data)]] = True
        at = np.flatnonzero(begins & ~blank)
        runs = pc.ascii_split_whitespace(texts).flatten()
        coded = runs.filter(pc.not_equal(runs, "")).dictionary_encode()
        own, number, first, last = self._inside(coded.dictionary).T
        sizes = np.bincount(own, minlength=len(coded.dictionary))
        run = coded.indices.to_numpy(zero_copy_only=False)
        run, at = run[sizes[run] > 0], at[sizes[run] > 0]
        many = sizes[run]
        place = np.repeat((np.cumsum(sizes) - sizes)[run] - np.cumsum(many) + many, many) + np.arange(many.sum())
        at = np.repeat(at, many)
        text = np.searchsorted(bounds, at, "right") - 1
        points = np.cumsum((data & 0xC0) != 0x80)
        start = points[at] - points[bounds[text]]
        line = np.cumsum(data == 10)[at] + text
        return number[place], text, line, start + first[place], start + last[place]


def term_counts(docs: DataFrame, some: DataFrame) -> DataFrame:
    """(term, lines, documents): in how many of each a term occurs. Summed in each task first.

    Has every term of ``some``, and may have others.
    """
    wanted = _bitmap(some)

    def count(batches):
        known = _Wanted(wanted.value)
        lines = documents = np.zeros(0, np.int64)
        for batch in batches:
            for part in slices(batch, 0, SLICE_BYTES) if known.any else ():
                term, text, line, _, _ = known.places(part.column(0))
                lines = add(lines, line, term, len(known.names))
                documents = add(documents, text, term, len(known.names))
                if len(known.names) >= TERMS_AT_ONCE:
                    yield rows(known.names, lines, documents)
                    known.forget()
                    lines = documents = np.zeros(0, np.int64)
        yield rows(known.names, lines, documents)

    def add(counts, unit, term, n_terms):
        """The counts and in how many of these units each term is."""
        distinct = np.unique(unit * n_terms + term) % max(n_terms, 1)
        more = np.bincount(distinct, minlength=n_terms)
        more[:len(counts)] += counts
        return more

    def rows(names, lines, documents):
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(lines, pa.int64()), pa.array(documents, pa.int64())],
            names=["term", "lines", "documents"],
        )

    counted = docs.select("text").mapInArrow(count, "term string, lines long, documents long")
    return counted.groupBy("term").agg(F.sum("lines").alias("lines"), F.sum("documents").alias("documents"))


def disclosures(
    pairs: DataFrame, counts: DataFrame, n_lines: Column, n_documents: Column,
    generalise: float = GENERALISE, remove: float = REMOVE,
) -> DataFrame:
    """Terms that disclose an entity: by, kind, value, term, share disclosed, level (a kind's number)."""
    entities = pairs.where("term = ''").select("by", "kind", "value", F.col("both").alias("entity"))
    judged = pairs.where("term != ''").join(entities, ["by", "kind", "value"]).join(counts, "term")
    by_line = F.col("by") == "line"
    units = F.when(by_line, n_lines).otherwise(n_documents)
    occurs = F.when(by_line, F.col("lines")).otherwise(F.col("documents"))
    content = F.log(units / F.col("entity"))
    both = F.col("both") * (F.col("support") - 1) / F.col("support")
    pmi = F.log(units * both / (F.col("entity") * occurs))
    share = F.when(content > 0, pmi / content)
    return judged.select("by", "kind", "value", "term", share.alias("share")).where(
        F.col("share") >= generalise
    ).withColumn(
        "level", F.when(F.col("share") >= remove, KINDS.index("remove")).otherwise(KINDS.index("generalise"))
    )


def placed_in(docs: DataFrame, some: DataFrame) -> DataFrame:
    """doc_id, spans and the places of terms of every row; has all places of the terms of ``some``, and may have others."""
    wanted = _bitmap(some)

    def outside(spans, text, start, end):
        """Which places touch none of the spans of their text."""
        merged = [_merged(own) for own in spans]
        owner = np.repeat(np.arange(len(spans)), [len(starts) for starts, _ in merged])
        starts, ends = (np.array([x for own in merged for x in own[i]], np.int64) for i in (0, 1))
        # Texts follow one another, each as wide as the widest.
        wide = 1 + max(ends.max(initial=0), end.max(initial=0))
        ends = np.concatenate([[-1], owner * wide + ends])
        return ends[np.searchsorted(owner * wide + starts, text * wide + end)] <= text * wide + start

    def place(batches):
        known = _Wanted(wanted.value)
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                spans = [base_spans(t or "") for t in part.column(1).to_pylist()]
                if len(known.names) >= TERMS_AT_ONCE:
                    known.forget()
                term, text, _, start, end = known.places(part.column(1))
                free = np.flatnonzero(outside(spans, text, start, end))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), of_spans(spans),
                     of_places(known.names, len(spans), *(x[free] for x in (term, text, start, end)))],
                    names=["doc_id", "spans", "terms"],
                )

    def of_spans(spans):
        flat = [np.array([x[i] for own in spans for x in own], np.int64) for i in range(3)]
        return lists([len(own) for own in spans], pa.StructArray.from_arrays(
            [pa.array(x, kind.type) for x, kind in zip(flat, _SPAN)], fields=list(_SPAN)
        ))

    def of_places(names, n_texts, term, text, start, end):
        """For each text, its terms with their places."""
        order = np.lexsort((start, term, text))
        term, text, start, end = (x[order] for x in (term, text, start, end))
        firsts = np.flatnonzero(np.diff(term, prepend=-1) | np.diff(text, prepend=-1))
        places = pa.StructArray.from_arrays([pa.array(start), pa.array(end)], names=["start", "end"])
        places = lists(np.diff(firsts, append=len(term)), places)
        found = pa.array([names[i] for i in term[firsts]], pa.string())
        return lists(np.bincount(text[firsts], minlength=n_texts), pa.StructArray.from_arrays(
            [found, places], names=["term", "places"]
        ))

    def lists(sizes, values):
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), values)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        place,
        f"doc_id long, spans array<{SPAN}>,"
        " terms array<struct<term: string, places: array<struct<start: long, end: long>>>>",
    )


def flagged_terms(
    docs: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE
) -> DataFrame:
    """The rows of ``disclosures`` for ``docs``, from a written table."""
    folder = shared_folder(docs.sparkSession)
    found = written(found_in(docs), f"{folder}/found")
    pairs = written(together(found), f"{folder}/pairs")
    n_lines, n_documents = found.agg(F.sum("n_lines")).scalar(), found.agg(F.count(F.lit(1))).scalar()
    # A term is at least as often in all texts as in those with values, and the more often the less it
    # discloses: those that disclose too little by that are not counted in all.
    least = term_counts(found.where("text is not null"), pairs.where("term != ''"))
    likely = disclosures(pairs, least, n_lines, n_documents, generalise, remove).select("term").distinct()
    counts = term_counts(docs, written(likely, f"{folder}/likely"))
    return written(disclosures(pairs, counts, n_lines, n_documents, generalise, remove), f"{folder}/flagged")


def personal_data(
    docs: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE
) -> DataFrame:
    """One row per row of ``docs``: doc_id and all spans, by start, then kind.

    ``spans`` is an array of (start, kind, end) in code points, the end exclusive and
    the kind a number of ``KINDS``. NULL texts count as empty and have none. Rows that
    repeat a doc_id are judged each. An empty table gives no rows. Other columns of
    ``docs`` are not read, whatever their names.
    """
    flagged = flagged_terms(docs, generalise, remove).groupBy("term").agg(F.max("level").alias("level"))
    placed = written(placed_in(docs, flagged).withColumn("uid", F.monotonically_increasing_id()))
    more = (
        placed.select("uid", F.inline("terms")).join(flagged, "term")
        .select("uid", "level", F.inline("places"))
        .groupBy("uid")
        .agg(F.collect_list(F.struct("start", F.col("level").alias("kind"), "end")).alias("more"))
    )
    joined = placed.select("uid", "doc_id", "spans").join(more, "uid", "left")
    added = F.coalesce("more", F.array().cast(f"array<{SPAN}>"))
    return joined.select("doc_id", F.array_sort(F.concat("spans", added)).alias("spans"))


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", names[s.kind], s.start, s.end)), ","
    )


def sanitised(text: str | None, spans: list) -> str:
    """The text with its spans replaced: data and generalised terms by their class, removed ones by nothing.

    Of spans that overlap, the one that starts first is replaced as far as the last of them ends.
    """
    text, out, at = text or "", [], 0
    for start, kind, end in spans:
        if start >= at:
            out.append(text[at:start])
            out.append({"generalise": "[term]", "remove": ""}.get(KINDS[kind], f"[{KINDS[kind]}]"))
        at = max(at, end)
    return "".join([*out, text[at:]])


def sanitise(text: Column, spans: Column) -> Column:
    """``sanitised`` for a text column and its spans."""

    def of_batch(texts: pa.Array, spans: pa.Array) -> pa.Array:
        return pa.array(
            (sanitised(t, [(s["start"], s["kind"], s["end"]) for s in x or []])
             for t, x in zip(texts.to_pylist(), spans.to_pylist())),
            pa.string(),
        )

    return F.arrow_udf(of_batch, "string")(text, spans)
