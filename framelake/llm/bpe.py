"""Byte-level BPE: encoding by tree concatenation, and decoding.

A text of more than ``leaf`` bytes is halved until its parts are at most that long, wherever the halves happen to
meet.  The leaves of a whole Arrow batch are encoded together; then neighbours are joined, level by level, by encoding
a window around the join again.  The window grows until it agrees with both sides: its first tokens are the left
side's and its last tokens the right side's, in each case up to a place that the pre-tokenizer must cut (behind a
non-space before white space, or between an ASCII letter and ASCII punctuation).  Nothing before such a place
depends on what follows it, nor the other way round, so the joined sequence is exact.

A stretch without such a place that is longer than ``leaf`` (a very long word) is first cut by the pre-tokenizer; a
pre-token that is still longer is a tree of its own, in which a window agrees if its first token is the left side's at
that place and its last token the right side's.  A token sequence is the BPE encoding of a pre-token exactly if each
neighbouring pair is the encoding of the pair's text; every pair lies within one of three encodings (left, window,
right), so this is exact too.

Leaves are encoded by units between such cuts: the tokenizers library encodes a unit once for each Python worker, and
further ones are found by a 64-bit hash and compared byte by byte; where a hash stands for two units the batch goes to
the library as it is.

Nulls count as empty texts (no tokens).  Rows are independent: repeated rows and ids give equal result rows, an
empty table an empty result, and further input columns are left out.  The result's own names (n_tokens, ids_sha256,
decoded_sha256, ids) win over kept columns of the same name.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from framelake.llm.common import hand_back, small_batches
from framelake.llm.hashing import equal, hashes

#: White space of the byte-level pre-tokenizer's pattern (fixed value: Unicode White_Space).
SPACE = "\t-\r \x85\xa0\N{OGHAM SPACE MARK}\N{EN QUAD}-\N{HAIR SPACE}\N{LINE SEPARATOR}\N{PARAGRAPH SEPARATOR}\N{NARROW NO-BREAK SPACE}\N{MEDIUM MATHEMATICAL SPACE}\N{IDEOGRAPHIC SPACE}"
UNIT = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]")
#: Units kept in a worker's cache, and bytes of text encoded together.
CACHE, TOGETHER_BYTES, TOGETHER = 1_200_000, 4_000_000, 2048
#: Longest text that is cut into units by whole arrays; a longer one is cut by the pattern, a unit at a time.
LONGEST = 16_000_000
#: Tokens on either side of a join that the first window takes.
REACH = 8


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """values[s : s + n] of all ranges, one after the other."""
    total = int(lengths.sum())
    if not total:
        return values[:0]
    jump = np.ones(total, np.int64)
    full = lengths > 0
    s, n = starts[full], lengths[full]
    at = np.cumsum(n[:-1])
    jump[0] = s[0]
    jump[at] = s[1:] - (s[:-1] + n[:-1] - 1)
    return values[np.cumsum(jump)]


#: Of each byte: white space, ASCII letter, ASCII punctuation.
_BYTE = np.arange(256)
_IS_SPACE = np.isin(_BYTE, [9, 10, 11, 12, 13, 32])
_IS_LETTER = np.array([b < 128 and chr(b).isalpha() for b in _BYTE])
_IS_PUNCT = np.array([32 < b < 127 and not chr(b).isalnum() for b in _BYTE])
#: White space beyond ASCII, as UTF-8; a text with one of these goes the plain way.
_WIDE_SPACE = re.compile("|".join(re.escape(c) for c in ["\x85", "\xa0", *"\N{OGHAM SPACE MARK}\N{LINE SEPARATOR}\N{PARAGRAPH SEPARATOR}\N{NARROW NO-BREAK SPACE}\N{MEDIUM MATHEMATICAL SPACE}\N{IDEOGRAPHIC SPACE}", *map(chr, range(0x2000, 0x200B))]).encode())


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The longest common start."""
    n = min(len(a), len(b))
    other = a[:n] != b[:n]
    return a[: int(other.argmax()) if other.any() else n]


class Encoder:
    """The tokenizer of a file, with a cache of units."""

    def __init__(self, path: str, leaf: int = 8192) -> None:
        from tokenizers import Tokenizer, models

        self.leaf = leaf  # bytes; a leaf more or less is a window more or less
        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        spec = json.loads(self.library.to_str())
        pre, model = spec["pre_tokenizer"] or {}, spec["model"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        plain = all(not (x["lstrip"] or x["rstrip"] or x["single_word"] or x["normalized"]) for x in spec["added_tokens"])
        #: Whether units can be encoded one by one; otherwise whole texts go to the library.
        self.by_unit = plain and pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"] and not spec["normalizer"] and model["type"] == "BPE" and not model["dropout"]
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.bytes_of = self._table()
        #: The library's model alone, for units that are one pre-token: Latin letters with a space before them or none.
        self.bare = Tokenizer(models.BPE(vocab=model["vocab"], merges=[tuple(x) if isinstance(x, list) else tuple(x.split(" ")) for x in model["merges"]], cache_capacity=0)) if self.by_unit and not model["unk_token"] and not model["byte_fallback"] and not model["ignore_merges"] else None
        self.flat = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.length = np.array([len(b) for b in self.bytes_of], np.int64)
        self.at = np.cumsum(self.length) - self.length
        first, last = (np.array([b[at] if b else 0 for b in self.bytes_of], np.uint8) for at in (0, -1))
        #: Of each id: whether it starts inside a character, and what its edges are.
        self.inner = (first & 0xC0) == 0x80
        self.from_space, self.from_punct = _IS_SPACE[first], _IS_PUNCT[first]
        self.to_plain, self.to_letter = (last < 128) & ~_IS_SPACE[last], _IS_LETTER[last]
        #: How many joins were made, and how many windows they took.
        self.joins = self.windows = 0
        self._forget()

    def _forget(self) -> None:
        """The cache: sorted hashes of units, with where their bytes lie in text and their ids in known."""
        self.keys = np.zeros(0, np.uint64)
        self.where, self.count, self.at_text, self.n_text = (np.zeros(0, np.int32) for _ in range(4))
        self.known, self.text = np.zeros(0, np.uint32), np.zeros(0, np.uint8)

    def _learn(self, keys: np.ndarray, ids: list[list[int]], raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> None:
        n = np.array([len(x) for x in ids], np.int32)
        place = np.searchsorted(self.keys, keys)  # the new keys are sorted too

        def put(old: np.ndarray, new: np.ndarray) -> np.ndarray:
            return np.insert(old, place, new.astype(old.dtype))

        self.where, self.at_text = put(self.where, len(self.known) + np.cumsum(n) - n), put(self.at_text, len(self.text) + np.cumsum(lengths) - lengths)
        self.keys, self.count, self.n_text = put(self.keys, keys), put(self.count, n), put(self.n_text, lengths)
        self.known = np.concatenate([self.known, np.fromiter(chain.from_iterable(ids), np.uint32, int(n.sum()))])
        self.text = np.concatenate([self.text, gather(raw, starts, lengths)])

    def _table(self) -> list[bytes]:
        """The bytes of each id, by the byte-level alphabet: printable Latin-1 stands for itself, the rest follows from 256 on."""
        own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        other = [b for b in range(256) if b not in own]
        of = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(other)}
        self.alphabet = {b: ord(c) for c, b in of.items()}
        vocab = self.library.get_vocab(with_added_tokens=True)
        out = [b""] * (max(vocab.values()) + 1)
        for t, i in vocab.items():
            out[i] = bytes(of[c] for c in t) if all(c in of for c in t) else t.encode()
        return out

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _units(self, texts: list[str]) -> list[list[int]]:
        if not self.bare:
            return self._library(texts)
        simple = [bool(t) and (w := t[t[0] == " " :]).isalpha() and max(w) < "\u0250" for t in texts]
        easy = iter(self.bare.encode_batch_fast([t.encode().decode("latin-1").translate(self.alphabet) for t, s in zip(texts, simple, strict=True) if s], add_special_tokens=False))
        rest = iter(self._library([t for t, s in zip(texts, simple, strict=True) if not s]))
        return [next(easy).ids if s else next(rest) for s in simple]

    def tree(self, text: str) -> list[int]:
        """The ids of one pre-token of any length."""
        level = [np.asarray(x, np.uint32) for x in self._library([text[i : i + self.leaf] for i in range(0, len(text), self.leaf)])]
        return self._joined(level, pre_token=True).tolist()

    def _joined(self, level: list[np.ndarray], pre_token: bool = False) -> np.ndarray:
        """The ids of a text from those of its leaves."""
        while len(level) > 1:
            level = [self._join(*level[i : i + 2], pre_token) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
        return level[0]

    def _join(self, left: np.ndarray, right: np.ndarray, pre_token: bool) -> np.ndarray:
        if not len(left) or not len(right):
            return left if len(left) else right
        self.joins += 1
        reach = REACH
        while True:
            i, j = max(0, len(left) - reach), min(len(right), reach)
            while i and self.inner[left[i]]:
                i -= 1
            while j < len(right) and self.inner[right[j]]:
                j += 1
            self.windows += 1
            a, b = left[i:], right[:j]
            mid = np.asarray(self._library([b"".join(self.bytes_of[t] for t in chain(a.tolist(), b.tolist())).decode()])[0], np.uint32)
            if pre_token:
                agree = (not i or mid[0] == a[0]) and (j == len(right) or mid[-1] == b[-1])
            else:
                agree = (not i or self._cut_in(a, len(_common(a, mid)), front=True)) and (j == len(right) or self._cut_in(b, len(_common(b[::-1], mid[::-1])), front=False))
            if agree:
                return np.concatenate([left[:i], mid, right[j:]])
            reach *= 2

    def _cut_in(self, ids: np.ndarray, n: int, front: bool) -> bool:
        """Whether the pre-tokenizer must cut at an edge of the first (or last) n tokens, the outermost edge left out."""
        part = ids[: n + 1] if front else ids[max(0, len(ids) - n - 1) :]
        x, y = part[:-1], part[1:]
        return bool(((self.to_plain[x] & self.from_space[y]) | (self.to_letter[x] & self.from_punct[y])).any())

    def _long(self, unit: str) -> list[int]:
        parts = [unit[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(unit)]
        if "".join(parts) != unit:
            return self._library([unit])[0]
        return [t for p in parts for t in (self.tree(p) if len(p) > self.leaf else self._library([p])[0])]

    def _segments(self, text: str) -> list[str]:
        return [x for x in self.split.split(text) if x] if self.split and any(s in text for s in self.special) else [text]

    def _plain(self, text: str) -> np.ndarray:
        """One text with special tokens, wide white space or very long units, without the cache."""
        out = [np.zeros(0, np.uint32)]
        for s in self._segments(text):
            if s in self.special:
                out.append(np.array([self.special[s]], np.uint32))
                continue
            for long, own in groupby(UNIT.findall(s), lambda u: len(u) > self.leaf):
                if long:
                    out += [np.asarray(self._long(u), np.uint32) for u in own]
                else:
                    whole = "".join(own)  # the units around it are cut off by what the pre-tokenizer must cut
                    parts = [whole[i : i + self.leaf] for i in range(0, len(whole), self.leaf)]
                    out.append(self._joined([np.asarray(x, np.uint32) for x in self._library(parts)]))
        return np.concatenate(out)

    def _leaves(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the leaves of the texts start and end (offsets), and the first leaf of each text."""
        n = np.diff(offsets)
        parts = np.ones(len(n), np.int64)
        big = n > self.leaf
        parts[big] = 2 ** np.ceil(np.log2(n[big] / self.leaf)).astype(np.int64)  # by halves
        first = np.append(0, np.cumsum(parts))
        doc = np.repeat(np.arange(len(n)), parts)
        at = offsets[doc] + (np.arange(len(doc)) - first[doc]) * n[doc] // parts[doc]
        todo = np.flatnonzero(big[doc])
        while len(todo):  # on to the start of a character
            todo = todo[(at[todo] < len(raw)) & ((raw[np.minimum(at[todo], len(raw) - 1)] & 0xC0) == 0x80)]
            at[todo] += 1
        return np.append(at, offsets[-1]), first

    def _texts(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts raw[offsets[i] : offsets[i + 1]] in a row, and how many each has."""
        at, first = self._leaves(raw, offsets)
        ids, n = self._batch(raw, at)
        if len(n) == len(offsets) - 1:
            return ids, n
        ends = np.append(0, np.cumsum(n))
        out, counts = [], []
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            own = ids[ends[a] : ends[b]] if b == a + 1 else self._joined([ids[ends[i] : ends[i + 1]] for i in range(a, b)])
            out.append(own)
            counts.append(len(own))
        return np.concatenate(out), np.array(counts, np.int64)

    def _batch(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts that are leaves."""
        n_docs = len(offsets) - 1
        if not len(raw):
            return np.zeros(0, np.uint32), np.zeros(n_docs, np.int64)
        space = _IS_SPACE[raw]
        first, last = np.zeros(len(raw) + 1, bool), np.zeros(len(raw) + 1, bool)
        first[offsets[:-1]] = True
        last[offsets[1:]] = True  # at the byte after a text
        after = np.append(space[1:], True) | last[1:]  # the next byte is white space or belongs to another text
        before = np.append(True, space[:-1])
        cut = first[:-1] | (space & ~before) | (space & ~after) | (~space & before & (np.append(np.uint8(0), raw[:-1]) != 32))
        cut[1:] |= _IS_PUNCT[raw[1:]] & _IS_LETTER[raw[:-1]]
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(raw))
        length = ends - starts
        keys, back = np.unique(hashes(raw, starts, ends, 20), return_inverse=True)
        one = np.empty(len(keys), np.int64)
        one[back] = np.arange(len(starts))  # a place of each distinct unit
        if len(self.keys) > CACHE:
            self._forget()
        new = self._lookup(keys)[1]
        if len(new):
            own = one[new]
            self._learn(keys[new], self._units([raw[starts[i] : ends[i]].tobytes().decode() for i in own]), raw, starts[own], length[own])
        found = self._lookup(keys)[0]
        same = (length == length[one][back]).all() and (length[one] == self.n_text[found]).all()
        if not (same and equal(raw, starts, raw, starts[one][back], length) and equal(raw, starts[one], self.text, self.at_text[found], length[one])):
            self._forget()  # one hash stands for two units
            ids = self._library([raw[a:b].tobytes().decode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)])
            return np.fromiter(chain.from_iterable(ids), np.uint32), np.array([len(x) for x in ids], np.int64)
        found = found[back]
        n = self.count[found].astype(np.int64)
        total = np.append(0, np.cumsum(n))
        edge = total[np.searchsorted(starts, offsets)]
        return gather(self.known, self.where[found].astype(np.int64), n), np.diff(edge)

    def _lookup(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.keys, keys)
        if not len(self.keys):
            return at, np.arange(len(keys))
        return at, np.flatnonzero(self.keys[np.minimum(at, len(self.keys) - 1)] != keys)

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each has."""
        texts = texts.cast(pa.large_string())
        if texts.null_count:
            texts = texts.fill_null("")
        if not self.by_unit:
            ids = self._library(texts.to_pylist())
            return np.fromiter(chain.from_iterable(ids), np.uint32), np.array([len(x) for x in ids], np.int64)
        _, at, data = texts.buffers()
        at = np.frombuffer(at, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
        ids, counts, i = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)], 0
        marks = re.compile(b"|".join([_WIDE_SPACE.pattern, *(re.escape(s.encode()) for s in self.special)]))
        while i < len(texts):
            j = max(i + 1, int(np.searchsorted(at, at[i] + TOGETHER_BYTES)) - 1)
            part, edges = raw[at[i] : at[j]], at[i : j + 1] - at[i]
            plain = np.diff(edges) > LONGEST
            if j > i + 1 or not plain[0]:
                odd = [np.fromiter((m.start() for m in marks.finditer(part)), np.int64), self._long_runs(part)]
                plain[np.minimum(np.searchsorted(edges, np.concatenate(odd), "right") - 1, j - i - 1)] = True
            k = 0
            while k < j - i:  # stretches of plain texts and of others
                m = k + int(np.argmax(np.append(plain[k:] != plain[k], True)))
                if plain[k]:
                    found = [self._plain(part[a:b].tobytes().decode()) for a, b in zip(edges[k:m], edges[k + 1 : m + 1], strict=True)]
                    ids += found
                    counts.append(np.array([len(x) for x in found], np.int64))
                else:
                    x, n = self._texts(part[edges[k] : edges[m]], edges[k : m + 1] - edges[k])
                    ids.append(x)
                    counts.append(n)
                k = m
            i = j
        return np.concatenate(ids), np.concatenate(counts)

    def _long_runs(self, raw: np.ndarray) -> np.ndarray:
        """Where runs of more than leaf bytes without white space, or of white space, start."""
        change = np.flatnonzero(np.diff(_IS_SPACE[raw])) + 1
        starts = np.append(0, change)
        return starts[np.diff(np.append(starts, len(raw))) > self.leaf]

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        ids, n = self.encode_array(pa.array(texts, pa.large_string()))
        return [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] if texts else []

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD, as in the library."""
        return gather(self.flat, self.at[ids], self.length[ids]).tobytes().decode("utf-8", "replace")


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One for each Python worker, which Spark uses for many tasks."""
    return Encoder(path)


def pieces(batches: Iterator[pa.RecordBatch], rows: int = TOGETHER) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def encoded(docs: DataFrame, tokenizer: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text", with_ids: bool = False) -> DataFrame:
    """Columns of keep, n_tokens, ids_sha256, decoded_sha256, and with with_ids the ids as an array."""
    small_batches(docs.sparkSession)
    keep = tuple(c for c in keep if c not in ("n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] * with_ids)))
    kept = docs.select(*keep)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema) + ", n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for b in pieces(batches):
            flat, n = enc.encode_array(b.column(b.num_columns - 1))
            ends = np.append(0, np.cumsum(n))
            own = [flat[i:j] for i, j in zip(ends[:-1], ends[1:], strict=True)]
            cols = [b.column(i) for i in range(b.num_columns - 1)]
            cols += [pa.array(n, pa.int64()), pa.array([hashlib.sha256(x.astype("<u4")).hexdigest() for x in own], pa.string()), pa.array([hashlib.sha256(enc.decode(x).encode()).hexdigest() for x in own], pa.string())]
            names = [*keep, "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                cols.append(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat.astype(np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from tokens(batches)
        hand_back()

    return docs.select(*keep, docs[text].alias("__text")).mapInArrow(run, schema)
