"""Substring dedup by recompression.

A word that is covered by a window of 20 consecutive words is removed if the window's word sequence also starts
earlier (in a document of smaller id, or earlier in the same document).

A recompression turn renames runs of one symbol and then pairs of neighbouring symbols.  A name is a hash of what it
replaces and a pair is replaced or not by a bit of its two names, so one name holds in all documents, and equal
substrings get equal symbols in their interior.  Each symbol carries its witness: the range of words on which its being
there depends.  A symbol whose witness lies within a window is there in every equal window.  A window is stood for by
the smallest name (symbol with witness) among such symbols.

Each Spark round takes one more turn, gathers the names that stand for the windows still open, and counts them over all
documents: a window whose name occurs once in the whole table is unique and closed.  In the first round, a window
without a symbol of its own (a long run of one word, say) stands for itself; in later ones it stays open.  The windows
that stay open to the end share their symbols with others; these are then compared on their words, by two hashes that
are independent of each other from the words' bytes on (64 and 32 bits, so two unlike windows of a table of 10^10 open
windows are taken for equal with a probability of about 1e-9), and the first start of each is found.

Documents are dealt into groups of bounded size by a hash of id and text, so an id on many rows (all null ids, say) is
spread; rows that repeat both are read as one document, and get its result by a join.  A group sends each reducer one packed row of distinct entries (its own repeats are combined before the
shuffle, so a passage in a third of all documents gives one entry for each group) and gets back one bit for each entry,
and with them the note, a bit a window, of what it knew to be open.  Each step puts the group's rows in one order, by id
and text, before it counts windows: a shuffle that is read again hands the rows over in another order.
The number of reducers goes by the size of the table, not by the number of groups; a packed row holds one entry at
least, so rows and bytes of a round are at most in proportion to the words.

Nulls: a null text has no words; a null doc_id is an id of its own, the smallest.  Rows that repeat an id are read as
one document each with the same id: equal starts are not earlier, so exact repeats get equal rows.  An empty table
gives an empty result.  Very long texts are a group of their own.  Input columns named like the result's new columns are
replaced by them; all others are kept, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelake.llm.bpe import _IS_SPACE, gather
from framelake.llm.common import free_prefix, key, small_batches, written
from framelake.llm.hashing import hashes

#: Words of a window; Spark rounds, each of one more turn; bytes of text for each group of documents and each reducer.
WINDOW, ROUNDS, GROUP_BYTES, REDUCER_BYTES = 20, 2, 3_000_000, 12_000_000
#: Stands for a witness that reaches beyond the document.
_FAR = 1 << 40
_NONE = np.uint64(2**64 - 1)
_STEP = 0x9E3779B97F4A7C15
#: Words before and after a symbol's start that its witness may take, after each number of turns.
_BEFORE, _AFTER = (0, 4, 7, 9), (0, 6, 8, 10)
#: Kind of the rows that carry a group's own windows from one step to the next.
_STATE = -1


def _mix(*parts: np.ndarray) -> np.ndarray:
    h = np.uint64(0x243F6A8885A308D3)
    for p in parts:
        h = (h ^ p) * np.uint64(0x9FB21C651E98DF25)
        h = h ^ (h >> np.uint64(32))
    return h


class Words:
    """The words of a group of texts: where they are, their fingerprints, and the document of each."""

    def __init__(self, texts: pa.ChunkedArray | pa.Array) -> None:
        texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
        texts = texts.cast(pa.large_string())
        texts = texts.fill_null("") if texts.null_count else texts
        self.n_docs = len(texts)
        _, at, data = texts.buffers() if len(texts) else (None, None, None)
        at = np.frombuffer(at, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data else np.zeros(0, np.uint8)
        self.raw, at = raw, at - at[0]
        space = _IS_SPACE[raw]
        edge = np.zeros(len(raw) + 1, bool)
        edge[at] = True  # a text starts here or all have ended
        before = np.append(True, space) | edge
        self.starts = np.flatnonzero(~space & before[:-1])
        after = np.append(space, True) | edge
        self.ends = np.flatnonzero(after[1:] & ~space) + 1
        self.doc = np.searchsorted(at, self.starts, "right") - 1
        # words of one document that end at its edge are cut there, as edge is in both
        self.first = np.searchsorted(self.doc, np.arange(self.n_docs))
        self.count = np.diff(np.append(self.first, len(self.starts)))
        self.name = hashes(raw, self.starts, self.ends, 8)
        self.doc_lo, self.doc_hi = self.first[self.doc], (self.first + self.count)[self.doc]
        self.up: np.ndarray | None = None
        own = np.arange(len(self.name))
        self.levels = [(self.name, own, own, own + 1)]

    def sequence_prints(self, starts: np.ndarray, ends: np.ndarray, salt: int, name: np.ndarray | None = None) -> np.ndarray:
        """Fingerprints of word sequences (of a window at most), by prefix sums over the words' names."""
        name = self.name if name is None else name
        n = len(name)
        if self.up is None:
            self.up, self.down = np.full(n + 1, _STEP, np.uint64), np.full(n + 1, pow(_STEP, -1, 2**64), np.uint64)
            self.up[0] = self.down[0] = 1
            np.cumprod(self.up, out=self.up)
            np.cumprod(self.down, out=self.down)
        pre = np.zeros(n + 1, np.uint64)
        np.cumsum(_mix(name, np.uint64(salt)) * self.up[:-1], out=pre[1:])
        return _mix((pre[ends] - pre[starts]) * self.down[starts], (ends - starts).astype(np.uint64))

    def windows(self) -> np.ndarray:
        """The starts of all windows, as indices of words."""
        i = np.arange(len(self.name))
        return i[i + WINDOW <= self.doc_hi]

    def symbols(self, turns: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Name, start, and witness (lo, hi) of each symbol after some turns."""
        while len(self.levels) <= turns:
            self._turn(len(self.levels) - 1)
        return self.levels[turns]

    def _turn(self, turn: int) -> None:
        sym, start, lo, hi = self.levels[-1]
        if not len(sym):
            self.levels.append(self.levels[-1])
            return
        doc = self.doc[start]
        # runs
        same = doc[1:] == doc[:-1]
        new = np.append(True, ~(same & (sym[1:] == sym[:-1])))
        head = np.flatnonzero(new)
        n = np.diff(np.append(head, len(sym)))
        tail = head + n - 1
        left, right = self._beyond(doc, lo, hi, head, tail)
        sym = np.where(n > 1, _mix(sym[head], n.astype(np.uint64), np.uint64(turn * 2 + 1)), sym[head])
        start, doc, lo, hi = start[head], doc[head], left, right
        # pairs
        bit = (_mix(sym, np.uint64(77 + turn)) >> np.uint64(17)) & np.uint64(1) == 1
        same = doc[1:] == doc[:-1]
        pair = np.append(~bit[:-1] & bit[1:] & same, False)
        second = np.append(False, pair[:-1])
        at = np.arange(len(sym))
        left, right = self._beyond(doc, lo, hi, at, at)
        follow = np.minimum(at + 1, len(sym) - 1)
        lo2 = np.where(bit, left, lo)  # a right symbol that stands alone depends on its left neighbour
        hi2 = np.where(pair, hi[follow], np.where(bit, hi, right))  # and a left one on its right neighbour
        sym = np.where(pair, _mix(sym, sym[follow], np.uint64(turn * 2 + 2)), sym)
        keep = ~second
        self.levels.append((sym[keep], start[keep], lo2[keep], hi2[keep]))

    @staticmethod
    def _beyond(doc: np.ndarray, lo: np.ndarray, hi: np.ndarray, head: np.ndarray, tail: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Witnesses widened by the neighbours' on either side; far beyond where a document ends."""
        last = len(doc) - 1
        prev, nxt = np.maximum(head - 1, 0), np.minimum(tail + 1, last)
        left = np.where((head > 0) & (doc[prev] == doc[head]), np.minimum(lo[prev], lo[head]), -_FAR)
        right = np.where((tail < last) & (doc[nxt] == doc[tail]), np.maximum(hi[nxt], hi[tail]), _FAR)
        return left, right

    def names(self, turns: int, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The name that stands for each of the windows w (_NONE: none), and the names once for each place they stem from."""
        n, before, after = len(self.name), _BEFORE[turns], _AFTER[turns]
        sym, start, lo, hi = self.symbols(turns)
        ok = (lo >= start - before) & (hi <= start + after)
        sym, start, lo, hi = sym[ok], start[ok], lo[ok], hi[ok]
        at = np.full(n + WINDOW, _NONE)
        at[start] = _mix(self.sequence_prints(lo, hi, 3), sym, (start - lo).astype(np.uint64)) & ~np.uint64(1)
        # a window from p on holds the witnesses of the symbols that start in p + before ... p + WINDOW - after
        width = WINDOW - after - before + 1
        best, size = at[before:], 1
        while size < width:
            step = min(size, width - size)
            best = np.minimum(best[:-step], best[step:])
            size += step
        own = best[w]
        stands = np.full(n + 1, _NONE)
        stands[w] = own
        used = np.zeros(len(at), bool)
        for back in range(before, before + width):
            used[back : back + n] |= at[back : back + n] == stands[:n]
        used &= at != _NONE
        places = at[used]
        alone = own == _NONE
        if turns == 1 and alone.any():
            own[alone] = self.sequence_prints(w[alone], w[alone] + WINDOW, 3) | np.uint64(1)
            places = np.concatenate([places, own[alone]])
        return own, places

    def still_open(self, w: np.ndarray, turn: int, answers: Answers) -> np.ndarray:
        """Which of the windows w stay open after the answers of a round."""
        own, places = self.names(turn + 1, w)
        keys = np.unique(places)
        shared = keys[answers.bits(turn, keys)]
        if not len(shared):
            return w[own == _NONE]
        at = np.minimum(np.searchsorted(shared, own), len(shared) - 1)
        return w[(own == _NONE) | (shared[at] == own)]


def _by_reducer(keys: np.ndarray, n: int) -> list[tuple[int, np.ndarray]]:
    """Indices of the sorted distinct keys that go to each reducer, in order."""
    r = ((keys >> np.uint64(20)) % np.uint64(n)).astype(np.int64)
    order = np.argsort(r, kind="stable")
    cut = np.searchsorted(r[order], np.arange(n + 1))
    return [(i, order[cut[i] : cut[i + 1]]) for i in range(n) if cut[i] < cut[i + 1]]


class Answers:
    """The flags that n reducers sent back for a group's distinct keys, by round."""

    def __init__(self, t: pa.Table, n: int) -> None:
        self.n = n
        self.rows: dict[int, dict[int, bytes]] = {}
        for kind, r, b in zip(t.column("kind").to_pylist(), t.column("r").to_pylist(), t.column("bits").to_pylist(), strict=True):
            self.rows.setdefault(kind, {})[r] = b

    def state(self, words: Words, turns: int) -> np.ndarray:
        """The group's windows that are open after the answers of some rounds: those that it noted itself, less what came since."""
        w, known = words.windows(), 0
        for done in range(turns, 0, -1):
            if bits := self.rows.get(_STATE - done):
                w, known = w[np.unpackbits(np.frombuffer(bits[0], np.uint8), count=len(w)).astype(bool)], done
                break
        for turn in range(known, turns):
            w = words.still_open(w, turn, self)
        return w

    def bits(self, kind: int, keys: np.ndarray) -> np.ndarray:
        out, rows = np.zeros(len(keys), bool), self.rows.get(kind)
        for r, at in _by_reducer(keys, self.n) if rows else ():
            if r in rows:
                out[at] = np.unpackbits(np.frombuffer(rows[r], np.uint8), count=len(at)).astype(bool)
        return out


_KEYS = "__g int, r int, n int, keys binary, more binary"
_BACK = "__g int, kind int, r int, bits binary"


def _rows(g: int, found: list[tuple[int, bytes, bytes, int]]) -> pa.Table:
    return pa.table({"__g": pa.array([g] * len(found), pa.int32()), "r": pa.array([x[0] for x in found], pa.int32()), "n": pa.array([x[3] for x in found], pa.int32()), "keys": pa.array([x[1] for x in found], pa.binary()), "more": pa.array([x[2] for x in found], pa.binary())})


def _answers(t: pa.Table, kind: int, flags: np.ndarray) -> pa.Table:
    cut = np.append(0, np.cumsum(t.column("n").to_numpy()))
    rows = [(g, r, np.packbits(flags[i:j]).tobytes()) for g, r, i, j in zip(t.column("__g").to_pylist(), t.column("r").to_pylist(), cut[:-1], cut[1:], strict=True) if flags[i:j].any()]
    return pa.table({"__g": pa.array([x[0] for x in rows], pa.int32()), "kind": pa.array([kind] * len(rows), pa.int32()), "r": pa.array([x[1] for x in rows], pa.int32()), "bits": pa.array([x[2] for x in rows], pa.binary())})


def _noted(t: pa.Table) -> tuple[pa.Table, pa.Table]:
    """The rows of entries, and the answers that hand the groups' own notes back."""
    own = np.asarray(t.column("n")) < 0
    notes = t.filter(pa.array(own))
    back = pa.table({"__g": notes.column("__g"), "kind": notes.column("n"), "r": pa.array([0] * notes.num_rows, pa.int32()), "bits": notes.column("more")}, schema=pa.schema([("__g", pa.int32()), ("kind", pa.int32()), ("r", pa.int32()), ("bits", pa.binary())]))
    return t.filter(pa.array(~own)), back


def _in_order(t: pa.Table) -> tuple[np.ndarray, pa.ChunkedArray, np.ndarray]:
    """The ids and texts of a group by id and text, and the rows' places in that order; its group and id are the last columns."""
    slim = pa.table({"__k": t.column(t.num_columns - 1), "text": t.column("text").cast(pa.large_string())})
    order = pc.sort_indices(slim, sort_keys=[("__k", "ascending"), ("text", "ascending")])
    slim = slim.take(order)
    return slim.column("__k").to_numpy(), slim.column("text"), np.argsort(order.to_numpy())


def _group(t: pa.Table) -> int:
    return t.column(t.num_columns - 2)[0].as_py()


def _joined(t: pa.Table, column: str, dtype: str) -> np.ndarray:
    return np.frombuffer(b"".join(t.column(column).to_pylist()), dtype)


class Steps:
    """The functions of the groups and the reducers, for n reducers."""

    def __init__(self, n: int) -> None:
        self.n = n

    def name(self, turn: int, t: pa.Table, answers: pa.Table | None = None) -> pa.Table:
        """A group's names after one more turn, each with a bit that tells whether it stems from several places in the group."""
        if not t.num_rows:
            return _rows(0, [])
        words, g = Words(_in_order(t)[1]), _group(t)
        w = words.windows() if answers is None else Answers(answers, self.n).state(words, turn)
        keys, counts = np.unique(words.names(turn + 1, w)[1], return_counts=True)
        rows = [(r, keys[at].tobytes(), np.packbits(counts[at] > 1).tobytes(), len(at)) for r, at in _by_reducer(keys, self.n)]
        return _rows(g, rows + self.note(g, words, w, turn))

    def note(self, g: int, words: Words, w: np.ndarray, turns: int) -> list[tuple[int, bytes, bytes, int]]:
        """A row for some reducer to hand back: a bit for each window of the group."""
        if not turns:
            return []
        is_open = np.zeros(len(words.name), bool)
        is_open[w] = True
        return [(g % self.n, b"", np.packbits(is_open[words.windows()]).tobytes(), _STATE - turns)]

    def named(self, own: GroupedData, answers: DataFrame, turn: int) -> DataFrame:
        return own.cogroup(answers.groupBy("__g")).applyInArrow(lambda t, bits: self.name(turn, t, bits), _KEYS)

    def counted(self, names: DataFrame, turn: int) -> DataFrame:
        return names.groupBy("r").applyInArrow(lambda t: self.share(turn, t), _BACK)

    def share(self, turn: int, t: pa.Table) -> pa.Table:
        """Which names are shared."""
        t, noted = _noted(t)
        if not t.num_rows:
            return noted
        keys = _joined(t, "keys", "u8")
        several = np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool) for b, n in zip(t.column("more").to_pylist(), t.column("n").to_pylist(), strict=True)])
        distinct, back, counts = np.unique(keys, return_inverse=True, return_counts=True)
        often = counts > 1
        often[back[several]] = True
        return pa.concat_tables([_answers(t, turn, often[back]), noted])

    def candidates(self, ids: np.ndarray, texts: pa.ChunkedArray, answers: Answers) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The group's words; for the open windows: start, document id, position; distinct prints and the windows' places among them."""
        words = Words(texts)
        found = w = answers.state(words, ROUNDS)
        k = ids[words.doc[w]]
        pos = w - words.doc_lo[w]
        one = words.sequence_prints(w, w + WINDOW, 5)
        two = words.sequence_prints(w, w + WINDOW, 6, hashes(words.raw, words.starts, words.ends, 9)) >> np.uint64(32)
        order = np.lexsort((pos, k, two, one))
        w, k, pos, one, two = w[order], k[order], pos[order], one[order], two[order]
        new = np.append(True, (one[1:] != one[:-1]) | (two[1:] != two[:-1])) if len(w) else np.zeros(0, bool)
        return words, w, k, pos, np.flatnonzero(new), np.cumsum(new) - 1, one, two, found

    def compare(self, t: pa.Table, bits: pa.Table) -> pa.Table:
        """A group's distinct windows with the first place of each."""
        if not t.num_rows or not bits.num_rows:
            return _rows(0, [])
        ids, texts, _ = _in_order(t)
        words, _, k, pos, head, _, one, two, w = self.candidates(ids, texts, Answers(bits, self.n))
        packed = np.zeros(len(head), "u8,u4,i8,u4")
        packed["f0"], packed["f1"], packed["f2"], packed["f3"] = one[head], two[head], k[head], pos[head]
        g = _group(t)
        return _rows(g, [(r, packed[at].tobytes(), b"", len(at)) for r, at in _by_reducer(one[head], self.n)] + self.note(g, words, w, ROUNDS))

    def first(self, t: pa.Table) -> pa.Table:
        """Which windows also start earlier in another group."""
        t, noted = _noted(t)
        if not t.num_rows:
            return noted
        x = _joined(t, "keys", "u8,u4,i8,u4")
        order = np.lexsort((x["f3"], x["f2"], x["f1"], x["f0"]))
        y = x[order]
        new = np.append(True, (y["f0"][1:] != y["f0"][:-1]) | (y["f1"][1:] != y["f1"][:-1]))
        head = np.flatnonzero(new)[np.cumsum(new) - 1]
        later = (y["f2"] != y["f2"][head]) | (y["f3"] != y["f3"][head])
        flags = np.zeros(len(x), bool)
        flags[order] = later
        return pa.concat_tables([_answers(t, ROUNDS, flags), noted])

    def remove(self, t: pa.Table, bits: pa.Table, names: tuple[str, str, str]) -> pa.Table:
        """The group's rows with the number of words, of removed ones, and the kept text."""
        out = t.select(t.column_names[:-2])
        if not t.num_rows:
            return out.append_column(names[0], pa.array([], pa.int64())).append_column(names[1], pa.array([], pa.int64())).append_column(names[2], pa.array([], pa.string()))
        answers = Answers(bits, self.n)
        ids, texts, back = _in_order(t)
        words, w, k, pos, head, place, one, _, _ = self.candidates(ids, texts, answers)
        elsewhere = answers.bits(ROUNDS, one[head])
        repeated = elsewhere[place] | (k != k[head][place]) | (pos != pos[head][place]) if len(w) else np.zeros(0, bool)
        cover = np.zeros(len(words.name) + 1, np.int64)
        np.add.at(cover, w[repeated], 1)
        np.add.at(cover, w[repeated] + WINDOW, -1)
        kept = np.cumsum(cover[:-1]) == 0
        kept_n = np.bincount(words.doc[kept], minlength=words.n_docs)
        n = (words.ends - words.starts + 1)[kept]
        flat = gather(np.append(words.raw, np.uint8(32)), words.starts[kept], n)
        if len(n):
            flat[np.cumsum(n) - 1] = 32  # the byte after each word
        size = np.bincount(words.doc[kept], weights=n, minlength=words.n_docs).astype(np.int64)
        hi = np.cumsum(size)
        kept_texts = [flat[i : max(i, j - 1)].tobytes() for i, j in zip((hi - size)[back], hi[back], strict=True)]
        out = out.append_column(names[0], pa.array(words.count[back].astype(np.int64))).append_column(names[1], pa.array((words.count - kept_n)[back].astype(np.int64)))
        return out.append_column(names[2], pa.array(kept_texts, pa.binary()).cast(pa.string()))


def deduped(docs: DataFrame, group_bytes: int = GROUP_BYTES, names: tuple[str, str, str] = ("n_words", "n_removed", "kept")) -> DataFrame:
    """All columns of docs (doc_id, text, ...) with n_words, n_removed, and kept (the words that stay, one space between), or as names says."""
    small_batches(docs.sparkSession)
    docs = docs.drop(*names)
    p = free_prefix(docs)
    # a row for each id and text; where some are repeated, those rows are dealt out by themselves and joined at the end
    each = written(docs.groupBy(key().alias(f"{p}k"), F.xxhash64("text").alias(f"{p}t")).agg(F.count("*").alias("n"), F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")).alias("size")), "distinct-texts")
    total, most = each.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    if most <= 1:
        return _deduped(docs, p, total, group_bytes, names)
    again = each.where("n > 1").select(f"{p}k", f"{p}t")
    keyed = docs.withColumns({f"{p}k": key(), f"{p}t": F.xxhash64("text")})
    copies = keyed.join(again, [f"{p}k", f"{p}t"], "left_semi")
    one = copies.groupBy(f"{p}k", f"{p}t").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"))
    single = keyed.join(again, [f"{p}k", f"{p}t"], "left_anti").withColumns({f"{p}k": F.lit(None).cast("long"), f"{p}t": F.lit(None).cast("long")})
    done = written(_deduped(single.unionByName(one, allowMissingColumns=True), f"{p}_", total, group_bytes, names), "passages")
    found = done.where(f"{p}t is not null").select(f"{p}k", f"{p}t", *names)
    return done.where(f"{p}t is null").select(*docs.columns, *names).unionByName(copies.join(found, [f"{p}k", f"{p}t"]).select(*docs.columns, *names))


def _deduped(docs: DataFrame, p: str, total: int, group_bytes: int, names: tuple[str, str, str]) -> DataFrame:
    n_groups = int(max(24, -(-total // group_bytes)))
    steps = Steps(int(max(24, -(-total // REDUCER_BYTES))))
    dealt = F.pmod(F.xxhash64(key(), "text"), F.lit(n_groups)).cast("int")
    slim = docs.withColumns({f"{p}g": dealt, f"{p}own": key()})
    own = slim.groupBy(f"{p}g")
    answers = steps.counted(own.applyInArrow(lambda t: steps.name(0, t), _KEYS), 0)
    for turn in range(1, ROUNDS):
        answers = answers.unionByName(steps.counted(steps.named(own, answers, turn), turn))
    entries = own.cogroup(answers.groupBy("__g")).applyInArrow(lambda t, bits: steps.compare(t, bits), _KEYS)
    answers = answers.unionByName(entries.groupBy("r").applyInArrow(lambda t: steps.first(t), _BACK))
    schema = T.StructType([*docs.schema, T.StructField(names[0], T.LongType()), T.StructField(names[1], T.LongType()), T.StructField(names[2], T.StringType())])
    return own.cogroup(answers.groupBy("__g")).applyInArrow(lambda t, bits: steps.remove(t, bits, names), schema)
