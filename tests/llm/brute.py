"""Plain versions of the corpus operators for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import xxhash
from tokenizers import Tokenizer

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _holds(kind, found):
    digits = re.sub(r"[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def spans(text):
    """(start, kind, end) of the base patterns."""
    return sorted(
        (m.start(), i, m.end())
        for i, (kind, pattern) in enumerate(PATTERNS.items())
        for m in re.finditer(pattern, text or "") if _holds(kind, m[0])
    )


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, max_bits=2):
    """The smallest id reachable from each (id, fingerprint)."""
    root = {i: i for i, _ in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, (i, a) in enumerate(prints):
        for j, b in prints[:n]:
            if (a ^ b).bit_count() <= max_bits:
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return {i: find(i) for i, _ in prints}


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def exact_groups(docs):
    """doc_id -> (keep_id, size, kept, sha) for (doc_id, text)."""
    groups = {}
    for doc_id, text in docs:
        groups.setdefault(plain(text), []).append((-len(text or ""), doc_id))
    return {
        doc_id: (min(g)[1], len(g), min(g)[1] == doc_id, hashlib.sha256(key.encode()).hexdigest())
        for key, g in groups.items() for _, doc_id in g
    }


def pieces(docs, capacity=2048):
    """(doc_id, piece, start, length, crc) for (doc_id, text)."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = []
    for doc_id, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for n, at in enumerate(range(0, len(ids), capacity)):
            own = ids[at:at + capacity]
            out.append((doc_id, n, at, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
    return sorted(out, key=str)


def check_packing(rows, capacity=2048):
    """Sequences are filled from 0 without gaps; returns how many there are."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def lookup_table(shards, size):
    """Turn by turn over full preference lists."""
    lists = []
    for s in shards:
        offset, skip = xxhash.xxh64_intdigest(s, 1) % size, xxhash.xxh64_intdigest(s, 2) % (size - 1) + 1
        lists.append(iter([(offset + j * skip) % size for j in range(size)]))
    owner = {}
    while len(owner) < size:
        for i, prefers in enumerate(lists):
            for slot in prefers:
                if slot not in owner:
                    owner[slot] = i
                    break
            if len(owner) == size:
                break
    return [owner[i] for i in range(size)]


def line_dedup(docs):
    """doc_id -> kept lines for (doc_id, text), ids distinct."""
    seen, gone = set(), {}
    for doc_id, text in sorted(docs):
        own = (text or "").split("\n")
        for i in range(len(own) - 2):
            window = tuple(own[i:i + 3])
            if window in seen:
                gone.setdefault(doc_id, set()).update((i, i + 1, i + 2))
            seen.add(window)
    return {d: [x for i, x in enumerate((t or "").split("\n")) if i not in gone.get(d, ())] for d, t in docs}
