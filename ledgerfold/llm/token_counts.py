"""Token counts that follow edits without encoding whole texts again.

A document's pre-tokens, the pieces that byte-level BPE never joins, are the leaves
of a segment tree; its nodes hold the characters and tokens below them. An edit
finds its leaves by descending over characters, and pre-tokenising starts again a
little before it: whether a pre-token ends depends on at most two characters after
it. It goes on until a boundary after the edit is one of the old boundaries; from
there all leaves stay, as matching only looks ahead. Only the new leaves are
encoded, and the sums above them are updated.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.packing import slices

LEAVES = 64
LOOKAHEAD = 2
KNOWN, SLICE_BYTES = 1 << 18, 1 << 19

Edit = tuple[int, int, str]


class Encoder:
    """Pre-tokens and their token counts, for a vocabulary file of ranks."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.known: dict[str, int] = {}

    def count(self, pre_tokens: Sequence[str]) -> list[int]:
        if len(self.known) > KNOWN:
            self.known = {}
        known, encode = self.known, self.encoding.encode_ordinary
        for new in {x for x in pre_tokens if x not in known}:
            known[new] = len(encode(new))
        return [known[x] for x in pre_tokens]


class CountTree:
    """Segment tree over blocks of up to LEAVES pre-tokens of one text."""

    def __init__(self, widths: Sequence[int], counts: Sequence[int]):
        self._build(list(widths), list(counts))

    @classmethod
    def of(cls, text: str, encoder: Encoder) -> CountTree:
        found = encoder.pattern.findall(text)
        return cls([len(x) for x in found], encoder.count(found))

    def _build(self, widths: list[int], counts: list[int]) -> None:
        blocks = max(1, -(-len(widths) // LEAVES))
        self.first = 1 << (blocks - 1).bit_length()
        self.widths = [widths[i * LEAVES:(i + 1) * LEAVES] for i in range(blocks)]
        self.counts = [counts[i * LEAVES:(i + 1) * LEAVES] for i in range(blocks)]
        self.chars, self.tokens = [0] * (2 * self.first), [0] * (2 * self.first)
        for block in range(blocks):
            self.chars[self.first + block] = sum(self.widths[block])
            self.tokens[self.first + block] = sum(self.counts[block])
        for node in range(self.first - 1, 0, -1):
            self._sum(node)

    def _sum(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    def leaves(self) -> tuple[list[int], list[int]]:
        return [x for block in self.widths for x in block], [x for block in self.counts for x in block]

    def find(self, position: int) -> tuple[int, int, int]:
        """Block and leaf that hold a character, and where the leaf starts; the end for the text's length."""
        if position >= self.chars[1]:
            last = len(self.widths) - 1
            return last, len(self.widths[last]), self.chars[1]
        node, start = 1, 0
        while node < self.first:
            node *= 2
            if position - start >= self.chars[node]:
                start += self.chars[node]
                node += 1
        block, leaf = node - self.first, 0
        while position - start >= self.widths[block][leaf]:
            start += self.widths[block][leaf]
            leaf += 1
        return block, leaf, start

    def edit(self, text: str, edit: Edit, encoder: Encoder) -> tuple[str, int]:
        """Apply an edit to ``text``, whose tree this is: the new text, and how many leaves were encoded."""
        start, end, new = edit
        if not 0 <= start <= end <= len(text):
            raise ValueError(f"edit {start}:{end} is outside the text of {len(text)}")
        text = text[:start] + new + text[end:]
        block, leaf, at = self.find(max(0, start - LOOKAHEAD))
        shift, fixed = len(new) - (end - start), start + len(new)
        old = at  # the old boundary that the cursor (to_block, to_leaf) stands at
        to_block, to_leaf, found, position = block, leaf, [], at
        for match in encoder.pattern.finditer(text, at):
            found.append(match[0])
            position = match.end()
            if position < fixed:
                continue
            while to_block < len(self.widths) and old < position - shift:
                if to_leaf == len(self.widths[to_block]):
                    to_block, to_leaf = to_block + 1, 0
                    continue
                old += self.widths[to_block][to_leaf]
                to_leaf += 1
            if old == position - shift:
                break
        else:
            to_block, to_leaf = len(self.widths), 0
        self._replace(block, leaf, to_block, to_leaf, found, encoder.count(found))
        return text, len(found)

    def _replace(self, block, leaf, to_block, to_leaf, found, counts) -> None:
        """Put new leaves in the place of those from (block, leaf) to (to_block, to_leaf)."""
        for own, new in ((self.widths, [len(x) for x in found]), (self.counts, counts)):
            if block == to_block:
                own[block][leaf:to_leaf] = new
            else:
                own[block][leaf:] = new
                for between in range(block + 1, min(to_block, len(own))):
                    own[between] = []
                if to_block < len(own):
                    own[to_block][:to_leaf] = []
        if len(self.widths[block]) > 4 * LEAVES:
            self._build(*self.leaves())
            return
        for changed in range(block, min(to_block + 1, len(self.widths))):
            node = self.first + changed
            self.chars[node], self.tokens[node] = sum(self.widths[changed]), sum(self.counts[changed])
        low, high = (self.first + block) // 2, (self.first + min(to_block, len(self.widths) - 1)) // 2
        while low:
            for node in range(low, high + 1):
                self._sum(node)
            low, high = low // 2, high // 2


def count_tokens(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``docs`` (doc_id, text) with ``tokens`` and the leaves of each text's tree.

    ``leaf_chars`` and ``leaf_tokens`` are 32-bit integers, little-endian; the sums
    above them are made again where a tree is used. NULL counts as an empty text, which
    has no tokens; a long text is counted whole. Rows that repeat are counted each, a
    missing doc_id stays missing, and an empty table gives no rows. Other columns are
    not read, whatever their names.
    """

    def build(batches):
        encoder = Encoder(ranks, pattern)
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                trees = [CountTree.of(x.as_py() or "", encoder) for x in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *_columns(trees)], names=["doc_id", "text", *TREE]
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        build, "doc_id long, text string, tokens long, leaf_chars binary, leaf_tokens binary"
    )


def apply_edits(counted: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """The counted documents after the edits in their column ``edits``.

    ``edits`` is an array of (start, end, new) in code points; each refers to the text
    that the one before left. A missing or empty array changes nothing; an edit
    outside the text is an error. Columns: those of ``counted`` without ``edits``,
    with the new text, tokens and leaves, and tokens_before, edited (number of edits)
    and encoded (pre-tokens that were encoded again). One row per row, also where rows
    repeat; a NULL text is edited as an empty one. An empty table gives no rows. Other
    columns are not read, whatever their names.
    """

    def edit(batches):
        encoder = Encoder(ranks, pattern)
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                trees, texts, encoded, scripts = [], [], [], []
                for row in part.select(["text", "leaf_chars", "leaf_tokens", "edits"]).to_pylist():
                    tree = CountTree(*(np.frombuffer(row[x], "<i4").tolist() for x in ("leaf_chars", "leaf_tokens")))
                    text, some = row["text"] or "", 0
                    for x in row["edits"] or []:
                        text, more = tree.edit(text, (x["start"], x["end"], x["new"] or ""), encoder)
                        some += more
                    trees.append(tree)
                    texts.append(text)
                    encoded.append(some)
                    scripts.append(len(row["edits"] or []))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(texts, pa.string()), *_columns(trees),
                     part.column("tokens"), pa.array(scripts, pa.int32()), pa.array(encoded, pa.int64())],
                    names=["doc_id", "text", *TREE, "tokens_before", "edited", "encoded"],
                )

    return counted.select("doc_id", "text", "tokens", "leaf_chars", "leaf_tokens", "edits").mapInArrow(
        edit,
        "doc_id long, text string, tokens long, leaf_chars binary, leaf_tokens binary,"
        " tokens_before long, edited int, encoded long",
    )


TREE = ("tokens", "leaf_chars", "leaf_tokens")


def _columns(trees: Sequence[CountTree]) -> list[pa.Array]:
    leaves = [tree.leaves() for tree in trees]
    return [
        pa.array([tree.total for tree in trees], pa.int64()),
        *(pa.array([np.array(x[i], "<i4").tobytes() for x in leaves], pa.binary()) for i in (0, 1)),
    ]


def masking_edits(spans: Iterable[tuple[int, int, int]], kinds: Sequence[str]) -> list[dict]:
    """Edits that put a class in the place of each span, last first, so that places hold."""
    out, before = [], None
    for start, kind, end in sorted(spans, reverse=True):
        if before is None or end <= before:
            out.append({"start": start, "end": end, "new": f"<{kinds[kind]}>"})
            before = start
    return out
