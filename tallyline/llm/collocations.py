"""Phrases whose words stand together more often than their parts would by chance.

Texts are lower-cased (A-Z), split into pieces at sentence marks and line ends, and pieces into words. A
word is a 64-bit code of its language and spelling; the codes of the texts are stored, with a 0 between pieces
and for words that are not frequent. Frequent phrases are found level by level, as Apriori does, in three
passes each and one that narrows the codes for the next level:

* **candidates**: a double-array trie of the frequent phrases of one word less goes to every task, which
  advances the states of all text positions together, level by level. Where a phrase and the one that
  starts a word later are both frequent, they make a candidate. Candidates are counted by a hash first, in
  buckets that grow in number with the codes and are added up by tasks; a bit for each bucket comes back, and
  those whose bucket stays below the count are passed over in a second pass. A task may keep a few places of
  each to itself, so that the many rare ones need no shuffle; as all tasks together keep fewer than
  ``min_count``, no frequent phrase is lost, and what cannot reach the count with all that was kept is left
  out. What the tasks report travels packed, ``SHARES`` rows at a time, and is added up share by share.
* **counts**: the candidates, again as a trie, go to every task; the accepting states are counted, and the
  counts of those that occur are added up, chunk by chunk, by tasks that write the frequent ones. No counts go
  through the driver.
* **narrowed codes**: places that no two frequent phrases hold, one a word after the other, can't hold a longer
  one. A table of ``SPARSE`` bits for each frequent phrase, by a hash, tells which to leave out; the codes left
  are stored for the next level. What the hash lets through is decided by the next trie.

Tries are cut into parts of at most ``PART`` phrases, each of which makes a pass of its own.

Null texts are empty, a null language is ``und``; other columns are ignored, repeated rows count again,
and an empty table gives an empty result. Texts are read whole, however long.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions.skew import lookup_join
from tallyline.llm.common import stored, whole

PART = 3_000_000  # phrases of a trie (up to 40 bytes each, and about 30 for the trie)
TOGETHER = 100_000  # codes a task handles at once
GATHERED = 1 << 21  # positions a task gathers before it counts them
WORDS = 100_000  # words a task remembers or counts before it passes them on
ROW = 512  # codes of a stored row, up to the next break; Spark hands rows to tasks by their number
BUCKETS = 1 << 22  # of the hashed counts that sort out candidates, at least
SHARED = 64  # codes to a bucket, at most
SPARSE = 16  # bits for each phrase that codes are sorted out by
CHUNK = 1 << 16  # numbers of a row that carries a part of a task's counts, a multiple of 8 and at most 2^16
SHARES = 256  # rows a task's candidates are dealt to, by a hash
FOUND = np.dtype([("first", np.int32), ("last", np.int32), ("n", np.int32)])  # a packed candidate
MIX = np.uint64(0x9E3779B97F4A7C15)
CANDIDATES = 1_000_000  # distinct candidates a task holds before it lowers their counts or reports them
SEED = 42  # of Spark's xxhash64
UPPER, LOWER = bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B))
MARKS = b".,;:!?\n\x0b\x0c\r"
# Bytes as they are read: lower case, a line feed for every mark, blanks for tabs.
READ = bytes.maketrans(UPPER + MARKS + b"\t", LOWER + b"\n" * len(MARKS) + b" ")
Batches = Iterator[pa.RecordBatch]


# --- double-array trie -----------------------------------------------------------------------


class Trie:
    """Phrases (rows of word codes, all of one length) as a double array: the child of a state by a word lies
    at ``base + symbol`` if ``check`` names the base there. A state with many children has a base for every
    two of them or so, chosen by the last bits of the symbol, so that places are found for all bases of a size
    together. Symbols are the words of the phrases, the most frequent ones first, then ``others``."""

    def __init__(self, phrases: np.ndarray, others: np.ndarray | None = None):
        self.words, self.size = phrases.shape[1], len(phrases)
        own = np.unique(np.concatenate([np.unique(phrases[:, k]) for k in range(self.words)]))
        self.codes = codes = own if others is None else np.union1d(own, others)
        rows = np.stack([np.searchsorted(codes, phrases[:, k]).astype(np.int32) for k in range(self.words)])
        times = sum(np.bincount(row, minlength=len(codes)) for row in rows)
        self.symbols = np.empty(len(codes), dtype=np.int32)
        self.symbols[np.argsort(-times, kind="stable")] = np.arange(len(codes), dtype=np.int32)
        # The places of a word among the sorted codes, by its upper bits: codes are hashes and lie evenly.
        bits = len(codes).bit_length() + 1
        self.shift, self.half = 64 - bits, 1 << bits - 1
        self.heads = np.searchsorted((codes >> self.shift) + self.half, np.arange((1 << bits) + 1)).astype(np.int32)
        rows = self.symbols[rows]
        order = np.lexsort(rows[::-1])
        rows = rows[:, order]
        # States are numbered level by level in the order of the rows; those of one word have a table.
        new = np.ones(len(order), dtype=bool)
        new[1:] = rows[0, 1:] != rows[0, :-1]
        heads, state, states = np.flatnonzero(new), np.cumsum(new) - 1, int(new.sum())
        self.roots = np.full(len(codes), -1, dtype=np.int32)
        self.roots[rows[0, heads]] = np.arange(states)
        self.after_roots, parents, symbols = states, [], []
        self.accepting = 0  # the first state of the last level
        for level in range(1, self.words):
            new[1:] |= rows[level, 1:] != rows[level, :-1]
            heads = np.flatnonzero(new)
            parents.append(state[heads].astype(np.int32))
            symbols.append(rows[level, heads])
            self.accepting, state, states = states, states + np.cumsum(new) - 1, states + len(heads)
        self.accepts = order[heads].astype(np.int32)
        if self.words > 1:
            self._place(np.concatenate(parents), np.concatenate(symbols), self.accepting)

    def _place(self, parents: np.ndarray, symbols: np.ndarray, inner: int) -> None:
        """Places for all children, given in the order of their numbers. Sets of children with one base go
        together, the largest sets first, each to places tried at random; single children to what is left."""
        sizes = np.bincount(parents, minlength=inner)
        bases = np.left_shift(1, np.ceil(np.log2(np.maximum(sizes, 2) / 2)).astype(np.int64))
        self.first = np.concatenate([[0], np.cumsum(bases)]).astype(np.int32)
        of = self.first[parents] + (symbols & (bases[parents] - 1).astype(np.int32))
        child = np.argsort(of, kind="stable").astype(np.int32)  # those of a base beside each other
        symbols, many = symbols[child], np.bincount(of, minlength=int(self.first[-1]))
        start = np.cumsum(many) - many
        self.base = np.full(len(many), -1, dtype=np.int32)
        self.check = np.full(2 * len(child) + len(self.codes) + 16, -1, dtype=np.int32)
        self.number = np.full(len(self.check), -1, dtype=np.int32)
        rng = np.random.default_rng(1)
        for size in np.unique(many[many > 1])[::-1]:
            left, tries = np.flatnonzero(many == size), 0
            while len(left):
                edges = start[left][:, None] + np.arange(size)
                near = symbols[edges]
                low = near.min(axis=1)
                near = near - low[:, None]
                at = (rng.random(len(left)) * (len(self.check) - near.max(axis=1))).astype(np.int64)
                slots = at[:, None] + near
                fits = np.flatnonzero((self.check[slots] < 0).all(axis=1))
                self.number[slots[fits]] = fits[:, None]  # of those that meet, the last one
                kept = (self.number[slots[fits]] == fits[:, None]).all(axis=1)
                mine, lost = fits[kept], fits[~kept]
                self.check[slots[mine]] = left[mine][:, None]
                self.number[slots[mine]] = child[edges[mine]]
                self.base[left[mine]] = at[mine] - low[mine]
                left, tries = np.delete(left, mine), tries + 1
                if tries % 50 == 0:
                    more = np.full(len(self.check) // 2, -1, dtype=np.int32)
                    self.check, self.number = np.concatenate([self.check, more]), np.concatenate([self.number, more])
        single = np.flatnonzero(many == 1)
        free = np.flatnonzero(self.check < 0)[: len(single)]
        self.check[free], self.number[free] = single, child[start[single]]
        self.base[single] = free - symbols[start[single]]
        end = int(np.flatnonzero(self.check >= 0)[-1]) + 1
        # Whatever a symbol leads to from a base, before the first place (from the end) or behind the last, is there.
        beyond = np.full(len(self.codes) + 1, -1, dtype=np.int32)
        self.check = np.concatenate([self.check[:end], beyond])
        self.number = self.number[:end]
        self.base[many == 0] = end

    def symbols_of(self, codes: np.ndarray) -> np.ndarray:
        """The symbol of each code, -1 for words the trie does not hold."""
        upper = (codes >> self.shift) + self.half
        found = np.full(len(codes), -1, dtype=np.int32)
        at, end = self.heads[upper], self.heads[upper + 1]
        left = np.flatnonzero(at < end)
        at, end = at[left], end[left]
        while len(left):
            same = self.codes[at] == codes[left]
            found[left[same]] = self.symbols[at[same]]
            at = at + 1
            more = ~same & (at < end)
            left, at, end = left[more], at[more], end[more]
        return found

    def accepted(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions where a phrase starts, and which one."""
        return self.walk(self.symbols_of(codes))

    def walk(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for symbols. All positions advance a level at a time."""
        at = np.flatnonzero(symbols[: max(len(symbols) - self.words + 1, 0)] >= 0)
        state = self.roots[symbols[at]]
        at, state = at[state >= 0], state[state >= 0]
        for level in range(1, self.words):
            symbol = symbols[at + level]
            known = symbol >= 0
            at, state, symbol = at[known], state[known], symbol[known]
            head = self.first[state]
            base = head + (symbol & (self.first[state + 1] - head - 1))
            to = self.base[base] + symbol
            fits = self.check[to] == base
            at, state = at[fits], self.after_roots + self.number[to[fits]]
        return at, self.accepts[state - self.accepting]

    def spelled(self) -> np.ndarray:
        """The code of each symbol."""
        codes = np.empty(len(self.codes), dtype=np.int64)
        codes[self.symbols] = self.codes
        return codes

    def plain(self) -> dict:
        return dict(self.__dict__)

    @staticmethod
    def of(plain: dict) -> Trie:
        trie = Trie.__new__(Trie)
        trie.__dict__.update(plain)
        return trie


# --- tasks -----------------------------------------------------------------------------------


def tokens(text: str) -> list[bytes]:
    """Words of a text, with a line feed between pieces."""
    return [t for t in text.encode().translate(READ).replace(b"\n", b" \n ").split(b" ") if t]


def _word_counts(batches: Batches) -> Batches:
    """``lang, word, n`` of the words of a task's texts, added up as far as memory goes."""
    held: dict[str, Counter] = {}

    def counted() -> Batches:
        for lang, words in held.items():
            words.pop(b"\n", None)
            found = list(words.items())
            for at in range(0, len(found), 50_000):
                part = found[at : at + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(part)), pa.array([w.decode() for w, _ in part]), pa.array([n for _, n in part], pa.int64())],
                    names=["lang", "word", "n"],
                )
        held.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            held.setdefault(lang, Counter()).update(tokens(text.as_py()))
            if sum(map(len, held.values())) > WORDS:
                yield from counted()
    yield from counted()


class Codes(dict):
    """Word -> code, as Spark's xxhash64 of (salt, language, word) gives it."""

    def __init__(self, lang: str, salt: int):
        self.seed = xxhash.xxh64_intdigest(lang.encode(), xxhash.xxh64_intdigest(salt.to_bytes(8, "little"), SEED))

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS:
            self.clear()
        value = self[word] = 0 if word == b"\n" else xxhash.xxh64_intdigest(word, self.seed)
        return value


def rows_of(codes: np.ndarray) -> Batches:
    """Packed codes in rows of about ``ROW`` codes that end with a 0, as the codes do."""
    if len(codes):
        breaks = np.flatnonzero(codes == 0)
        cuts = np.unique(breaks[np.searchsorted(breaks, np.arange(ROW, len(codes), ROW))] + 1)
        parts = [part.tobytes() for part in np.split(codes, cuts) if len(part)]
        yield pa.RecordBatch.from_arrays([pa.array(parts, pa.binary())], names=["codes"])


def narrow(codes: np.ndarray, words: int, bits: np.ndarray) -> np.ndarray:
    """The codes of places that may hold frequent phrases of one word more, with a 0 between what does not stand
    together: those of a phrase of so many words, and the one a word later, that both have their bit."""
    if len(codes) <= words:
        return codes[:0]
    whole = codes != 0
    for k in range(1, words):
        whole[:-k] &= codes[k:] != 0
        whole[-k:] = False
    at = np.flatnonzero(whole)
    starts = np.zeros(len(codes) + 1, dtype=bool)
    starts[at] = is_set(bits, buckets_of(codes, at, words, 8 * len(bits)))
    pairs = starts[:-1] & starts[1:]
    kept = pairs.copy()
    for k in range(1, words + 1):
        kept[k:] |= pairs[:-k]
    codes = np.where(kept, codes, 0)
    kept[1:] |= kept[:-1]  # and the first break after each
    return codes[kept]


def _coder(salt: int, shared) -> Callable[[Batches], Batches]:
    """Packed codes with a 0 after each piece and text; words that are not frequent are breaks, too."""

    def run(batches: Batches) -> Batches:
        known: dict[str, Codes] = {}
        held, size, end = [], 0, np.zeros(1, dtype=np.uint64)

        def rows() -> Batches:
            return rows_of(narrow(np.concatenate(held).view(np.int64), 1, shared.value))

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                codes = known.setdefault(lang, Codes(lang, salt))
                found = tokens(text.as_py())
                held += [np.fromiter(map(codes.__getitem__, found), dtype=np.uint64, count=len(found)), end]
                size += len(found)
                if size >= TOGETHER:
                    yield from rows()
                    held, size = [], 0
        if held:
            yield from rows()

    return run


def _narrow(shared, words: int) -> Callable[[Batches], Batches]:
    """What ``narrow`` leaves of packed codes."""

    def run(batches: Batches) -> Batches:
        for codes in codes_of(batches):
            yield from rows_of(narrow(codes, words, shared.value))

    return run


def codes_of(batches: Batches) -> Iterator[np.ndarray]:
    """The codes of several rows at a time."""
    held, size = [], 0
    for batch in batches:
        for packed in batch.column(0):
            held.append(packed.as_py())
            size += len(held[-1])
            if size >= 8 * TOGETHER:
                yield np.frombuffer(b"".join(held), dtype=np.int64)
                held, size = [], 0
    if held:
        yield np.frombuffer(b"".join(held), dtype=np.int64)


def columns(words: int) -> list[str]:
    return [f"w{k}" for k in range(1, words + 1)]


NOTHING = (np.zeros(0, np.int64), np.zeros(0, np.int64))


def summed(held: tuple[np.ndarray, np.ndarray], keys: list[np.ndarray], counts: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Keys in order and their counts, with ``keys`` added, each once if there are no counts."""
    if not keys:
        return held
    key = np.concatenate(keys)
    if counts is None:
        more = np.unique(key, return_counts=True)
        if not len(held[0]):
            return more
        key, n = more
    else:
        n = np.concatenate(counts).astype(np.int64)
    key, n = np.concatenate([held[0], key]), np.concatenate([held[1], n])
    order = np.argsort(key, kind="stable")
    key = key[order]
    heads = np.flatnonzero(np.concatenate([np.ones(min(len(key), 1), dtype=bool), key[1:] != key[:-1]]))
    return key[heads], np.add.reduceat(n[order], heads) if len(heads) else n


def lowered(held: tuple, by: int) -> tuple:
    """All counts less ``by``; what has none left is forgotten."""
    keys, n = held
    kept = n > by
    return keys[kept], n[kept] - by


def mixed(found: np.ndarray) -> np.ndarray:
    found = found * MIX
    return found ^ found >> np.uint64(29)


def number_for(places: int) -> int:
    """A power of two, ``BUCKETS`` or more."""
    return max(BUCKETS, 1 << max(places - 1, 1).bit_length())


def buckets_of(codes: np.ndarray, at: np.ndarray, words: int, buckets: int) -> np.ndarray:
    """The bucket of the phrase of so many words that starts at each place."""
    found = np.zeros(len(at), dtype=np.uint64)
    for k in range(words):
        found = mixed(found ^ codes[at + k].view(np.uint64))
    return found >> np.uint64(65 - buckets.bit_length())


def bucket_of_keys(keys: np.ndarray, buckets: int) -> np.ndarray:
    return mixed(mixed(keys.view(np.uint64))) >> np.uint64(65 - buckets.bit_length())


def is_set(bits: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Whether each number's bit is set, as ``packbits`` lays them out."""
    return (bits[numbers >> np.uint64(3)] << (numbers & np.uint64(7)).astype(np.uint8) & 128) != 0


def promising(trie: Trie, codes: np.ndarray, whole_trie: bool) -> np.ndarray:
    """Keys (number of the first words, symbol of the last) of the places of phrases one word longer than those
    of the trie whose first and last words but one are frequent."""
    symbols = trie.symbols_of(codes)
    at, phrase = trie.walk(symbols)
    starts = np.full(len(codes) + 1, not whole_trie)  # else the later phrase may be in another part
    starts[at] = True
    inside = at + trie.words < len(codes)
    at, phrase = at[inside], phrase[inside]
    last = symbols[at + trie.words]
    goes_on = (last >= 0) & starts[at + 1]
    return phrase[goes_on].astype(np.int64) << 32 | last[goes_on]


def packed(numbers: np.ndarray, counts: np.ndarray, kind: str) -> Batches:
    """A task's counts of numbers in order: a row for each ``CHUNK`` that has any, with the places in it."""
    if len(numbers):
        chunks = numbers // CHUNK
        heads = np.flatnonzero(np.concatenate([[True], chunks[1:] != chunks[:-1]]))
        ends = np.append(heads[1:], len(numbers))
        where, counts = (numbers % CHUNK).astype("u2"), counts.astype(kind)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(chunks[heads].astype(np.int32)),
                pa.array([where[a:b].tobytes() for a, b in zip(heads, ends)], pa.binary()),
                pa.array([counts[a:b].tobytes() for a, b in zip(heads, ends)], pa.binary()),
            ],
            names=["chunk", "places", "counts"],
        )


PACKED = "chunk int, places binary, counts binary"


def sums_of(batches: Batches, kind: str) -> Iterator[tuple[int, np.ndarray]]:
    """Each chunk and its counts added up. Rows of equal chunks lie beside each other."""
    chunk, total = None, None
    for batch in batches:
        for number, places, counts in zip(*batch.columns):
            if number.as_py() != chunk:
                if chunk is not None:
                    yield chunk, total
                chunk, total = number.as_py(), np.zeros(CHUNK, dtype=np.int64)
            total[np.frombuffer(places.as_py(), dtype="u2")] += np.frombuffer(counts.as_py(), dtype=kind)
    if chunk is not None:
        yield chunk, total


def _full(least: int) -> Callable[[Batches], Batches]:
    """A bit for each bucket of a chunk, set where its counts add up to ``least`` or more."""

    def run(batches: Batches) -> Batches:
        for chunk, total in sums_of(batches, "u1"):
            bits = np.packbits(total >= least)
            if bits.any():
                yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([bits.tobytes()], pa.binary())], names=["chunk", "bits"])

    return run


def _frequent(shared, min_count: int) -> Callable[[Batches], Batches]:
    """``w1 .., f`` of the listed phrases whose counts add up to ``min_count`` or more."""

    def run(batches: Batches) -> Batches:
        phrases = shared.value
        words = phrases.shape[1]
        for chunk, total in sums_of(batches, "i4"):
            often = np.flatnonzero(total >= min_count)
            own = phrases[chunk * CHUNK + often]
            if len(own):
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(own[:, k].copy()) for k in range(words)), pa.array(total[often])], names=[*columns(words), "f"]
                )

    return run


def tallied(numbers: Iterator[np.ndarray], kind: str) -> Batches:
    """How often each number occurs, packed, as far as the ``kind`` counts. As many are gathered as memory goes."""
    held, gathered, most = [], 0, np.iinfo(kind).max

    def counted() -> Batches:
        found, n = np.unique(np.concatenate(held), return_counts=True)
        return packed(found, np.minimum(n, most), kind)

    for found in numbers:
        held.append(found)
        gathered += len(found)
        if gathered >= GATHERED:
            yield from counted()
            held, gathered = [], 0
    if held:
        yield from counted()


def _marks(words: int, buckets: int) -> Callable[[Batches], Batches]:
    """The buckets of phrases (``w1 ..``)."""

    def run(batches: Batches) -> Batches:
        rows = (np.stack([np.array(batch.column(k)) for k in range(words)], axis=1) for batch in batches)
        found = (buckets_of(own.ravel(), words * np.arange(len(own)), words, buckets) for own in rows)
        yield from tallied((numbers.astype(np.int64) for numbers in found), "u1")

    return run


def _hashed_counts(shared, whole_trie: bool, buckets: int) -> Callable[[Batches], Batches]:
    """How many promising places fall into each bucket, each time 255 at most."""

    def run(batches: Batches) -> Batches:
        trie = Trie.of(shared.value)
        found = (bucket_of_keys(promising(trie, codes, whole_trie), buckets) for codes in codes_of(batches))
        yield from tallied((numbers.astype(np.uint32) for numbers in found), "u1")

    return run


def _seek(shared, whole_trie: bool, allowance: int) -> Callable[[Batches], Batches]:
    """Candidates one word longer than the phrases of the trie, packed: number of the first words, symbol of the
    last, the count in the task less what it lowered it by. Places whose bucket is not full are passed over. A
    task that holds too many candidates lowers all their counts by one, up to its allowance in all, and reports
    them when that is used up; the rest of the allowance goes at the end. Share -1 tells what a task with any
    codes may have kept to itself of a phrase."""

    def run(batches: Batches) -> Batches:
        plain, full = (part.value for part in shared)
        trie = Trie.of(plain)

        def row(share: list[int], found: list[np.ndarray]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(share, pa.int32()), pa.array([f.tobytes() for f in found], pa.binary())], names=["share", "found"])

        def report(held: tuple) -> Batches:
            keys, n = held
            found = np.empty(len(keys), dtype=FOUND)
            found["first"], found["last"], found["n"] = keys >> 32, keys & 0xFFFFFFFF, np.minimum(n, np.iinfo(np.int32).max)
            share = (mixed(keys.view(np.uint64)) >> np.uint64(32)) % np.uint64(SHARES)
            order = np.argsort(share, kind="stable")
            found, ends = found[order], np.searchsorted(share[order], np.arange(SHARES + 1))
            some = [k for k in range(SHARES) if ends[k] < ends[k + 1]]
            if some:
                yield row(some, [found[ends[k] : ends[k + 1]] for k in some])

        held, fresh, size, left, any_codes = NOTHING, [], 0, allowance, False
        for codes in codes_of(batches):
            any_codes = True
            keys = promising(trie, codes, whole_trie)
            fresh.append(keys[is_set(full, bucket_of_keys(keys, 8 * len(full)))])
            size += len(fresh[-1])
            if size >= GATHERED:
                held, fresh, size = summed(held, fresh), [], 0
                while left and len(held[0]) > CANDIDATES:
                    held, left = lowered(held, 1), left - 1
                if len(held[0]) > CANDIDATES:
                    yield from report(held)
                    held = NOTHING
        yield from report(lowered(summed(held, fresh), left))
        if any_codes:
            yield row([-1], [np.array([(0, 0, allowance)], dtype=FOUND)])

    return run


def _likely(shared, least: int) -> Callable[[Batches], Batches]:
    """Candidates (``w1 .., excess``) the tasks report ``least`` times or more. Rows of equal shares lie beside
    each other. A row of zeros tells what all tasks may have kept to themselves of a phrase."""

    def run(batches: Batches) -> Batches:
        phrases, spelled = shared.value
        words = phrases.shape[1]
        names = [*columns(words + 1), "excess"]

        def reported(share: int, found: tuple) -> Batches:
            keys, n = found
            if share < 0:
                yield pa.RecordBatch.from_arrays([*[pa.array([0], pa.int64())] * (words + 1), pa.array(n, pa.int64())], names=names)
                return
            often = np.flatnonzero(n >= least)
            for at in range(0, len(often), 50_000):
                part = often[at : at + 50_000]
                own = phrases[keys[part] >> 32]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(own[:, k].copy()) for k in range(words)), pa.array(spelled[keys[part] & 0xFFFFFFFF]), pa.array(n[part], pa.int64())],
                    names=names,
                )

        share, held, keys, counts, size = None, NOTHING, [], [], 0
        rows = ((number.as_py(), np.frombuffer(own.as_py(), dtype=FOUND)) for batch in batches for number, own in zip(batch.column(0), batch.column(1)))
        for number, found in rows:
            if number != share and share is not None:
                yield from reported(share, summed(held, keys, counts))
                held, keys, counts, size = NOTHING, [], [], 0
            share = number
            keys.append(found["first"].astype(np.int64) << 32 | found["last"])
            counts.append(found["n"])
            size += len(found)
            if size >= GATHERED:
                held, keys, counts, size = summed(held, keys, counts), [], [], 0
        if share is not None:
            yield from reported(share, summed(held, keys, counts))

    return run


def _count(shared) -> Callable[[Batches], Batches]:
    """How often the task holds each phrase of the trie."""

    def run(batches: Batches) -> Batches:
        trie = Trie.of(shared.value)
        yield from tallied((trie.accepted(codes)[1] for codes in codes_of(batches)), "i4")

    return run


# --- plan ------------------------------------------------------------------------------------


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), whole("text").alias("text"))


def word_table(docs: DataFrame, min_count: int) -> tuple[DataFrame, DataFrame, int]:
    """Frequent words (``code, lang, word, f``), word occurrences per language (``lang, n``), and the salt of
    the codes. A salt that gives a frequent word and another one the same code is replaced."""
    counts = stored(
        _rows(docs).mapInArrow(_word_counts, "lang string, word string, n long")
        .groupBy("lang", "word").agg(F.sum("n").alias("f"))
    )
    salt = 0
    while True:
        coded = counts.withColumn("code", F.xxhash64(F.lit(salt).cast("long"), "lang", "word"))
        by_code = coded.groupBy("code").agg(
            F.sum("f").alias("f"), F.count("*").alias("words"), F.min(F.struct("lang", "word")).alias("own")
        ).where(F.col("f") >= min_count)
        frequent = stored(by_code.select("code", "own.lang", "own.word", "f", "words"))
        if frequent.where((F.col("words") > 1) | (F.col("code") == 0)).isEmpty():
            return frequent.drop("words"), counts.groupBy("lang").agg(F.sum("f").alias("n")), salt
        salt += 1


def parts_of(phrases: DataFrame, words: int) -> Iterator[tuple[np.ndarray, int]]:
    """``phrases`` (``w1 ..``) in parts of at most ``PART``: their codes, and the number of parts."""
    names = columns(words)
    parts, largest = 1, phrases.count()
    while largest > PART:  # a hash deals evenly, its parts are counted all the same
        parts = 2 * max(parts, -(-largest // PART))
        of = F.pmod(F.xxhash64(*names), F.lit(parts))
        largest = phrases.groupBy(of.alias("part")).count().agg(F.max("count")).first()[0]
    of = F.pmod(F.xxhash64(*names), F.lit(parts))
    for number in range(parts):
        table = phrases.where(of == number).select(*names).toArrow()
        if table.num_rows:
            yield np.stack([np.array(table.column(n)) for n in names], axis=1), parts


def together(reports: DataFrame, by: str) -> DataFrame:
    """The tasks' packed rows, those of equal ``by`` beside each other."""
    return reports.repartition(by).sortWithinPartitions(by)


def full_buckets(hashed: DataFrame, least: int, buckets: int) -> np.ndarray:
    """A bit for each bucket, set where the tasks' packed counts add up to ``least``."""
    full = np.zeros(buckets // 8, dtype=np.uint8)
    for chunk, bits in together(hashed, "chunk").mapInArrow(_full(least), "chunk int, bits binary").collect():
        at = chunk * CHUNK // 8
        own = full[at : at + len(bits)]
        own[:] = np.frombuffer(bits, dtype=np.uint8)[: len(own)]
    return full


def marked(phrases: DataFrame, words: int) -> np.ndarray:
    """A bit for each bucket that one of the phrases (``w1 ..``) falls into."""
    buckets = number_for(SPARSE * phrases.count())
    return full_buckets(phrases.select(*columns(words)).mapInArrow(_marks(words, buckets), PACKED), 1, buckets)


def narrowed(coded: DataFrame, phrases: DataFrame, words: int) -> DataFrame:
    """The codes of places that may hold phrases longer than ``words``, given the frequent ones of that length."""
    bits = coded.sparkSession.sparkContext.broadcast(marked(phrases, words))
    left = stored(coded.mapInArrow(_narrow(bits, words), "codes binary"))
    bits.destroy()
    return left


def candidates(coded: DataFrame, shorter: DataFrame, words: int, min_count: int) -> DataFrame:
    """``w1 ..``: phrases of ``words`` words that may be frequent, given those of one word less."""
    names, context = columns(words), coded.sparkSession.sparkContext
    tasks, rows = coded.groupBy(F.spark_partition_id()).count().agg(F.count("*"), F.sum("count")).first()
    buckets = number_for((rows or 0) * ROW // SHARED)

    def found(allowance: int) -> DataFrame:
        made, others = [], None
        for codes, parts in parts_of(shorter, words - 1):
            if parts > 1 and others is None:  # the last word may stand in phrases of other parts only
                spelled = shorter.select(F.explode(F.array(*columns(words - 1))).alias("code")).distinct()
                others = np.array(spelled.toArrow().column("code"))
            trie = Trie(codes, others)
            listed = context.broadcast((codes, trie.spelled()))
            trie = context.broadcast(trie.plain())
            hashed = coded.mapInArrow(_hashed_counts(trie, parts == 1, buckets), PACKED)
            full = context.broadcast(full_buckets(hashed, min(min_count, 255), buckets))
            each = coded.mapInArrow(_seek((trie, full), parts == 1, allowance), "share int, found binary")
            likely = together(each, "share").mapInArrow(
                _likely(listed, max(min_count - allowance * tasks, 1)), ", ".join(f"{n} long" for n in names) + ", excess long"
            )
            made.append(stored(likely))
            for shared in (trie, full, listed):
                shared.destroy()
        return reduce(DataFrame.unionByName, made)

    # A task without codes, as a scan may have, keeps nothing and is not among them.
    allowance = (min_count - 1) // max(tasks, 1)
    reports = found(allowance)
    none = F.col("w1") == 0
    # what the tasks may have kept to themselves of one phrase, which lies in one part
    kept = reports.where(none).agg(F.max("excess")).first()[0] or 0
    if kept > allowance * tasks:  # more tasks than before: exact counts instead
        reports = found(0)
    return reports.where(~none).select(*names)


def counted(coded: DataFrame, listed: DataFrame, words: int, min_count: int) -> DataFrame | None:
    """``w1 .., f`` of the listed phrases that are frequent; None if there are none."""
    made, context = [], coded.sparkSession.sparkContext
    for codes, _ in parts_of(listed, words):
        trie, phrases = context.broadcast(Trie(codes).plain()), context.broadcast(codes)
        each = coded.mapInArrow(_count(trie), PACKED)
        often = together(each, "chunk").mapInArrow(
            _frequent(phrases, min_count), ", ".join(f"{n} long" for n in columns(words)) + ", f long"
        )
        made.append(stored(often))
        trie.destroy()
        phrases.destroy()
    found = reduce(DataFrame.unionByName, made) if made else None
    return None if found is None or found.isEmpty() else found


def frequent_phrases(docs: DataFrame, min_count: int = 100, longest: int = 5) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Phrases of 1 to ``longest`` words with ``min_count`` places or more (``codes, f``), frequent words
    (``code, lang, word, f``) and words per language (``lang, n``)."""
    words, totals, salt = word_table(docs, min_count)
    levels = [words.select(F.col("code").alias("w1"), "f")]
    if not words.isEmpty():
        bits = docs.sparkSession.sparkContext.broadcast(marked(levels[0], 1))
        coded = stored(_rows(docs).mapInArrow(_coder(salt, bits), "codes binary"))
        bits.destroy()
        for length in range(2, longest + 1):
            listed = candidates(coded, levels[-1], length, min_count)
            level = counted(coded, listed, length, min_count)
            if level is None:
                break
            levels.append(level)
            if length < longest:
                coded = narrowed(coded, level, length)
    phrases = [level.select(F.array(*columns(k)).alias("codes"), "f") for k, level in enumerate(levels, 1)]
    return reduce(DataFrame.unionByName, phrases), words, totals


def score() -> Column:
    """``1000 a n / l r`` rounded down. The products may pass 64 bits, so they are decimals."""

    def number(name: str, digits: int) -> Column:
        return F.col(name).cast(f"decimal({digits},0)")

    over = (F.lit(1000).cast("decimal(4,0)") * number("a", 16) * number("n", 16)).cast("decimal(38,0)")
    return F.call_function("div", over, (number("l", 18) * number("r", 18)).cast("decimal(38,0)"))


def collocations(
    docs: DataFrame, min_count: int = 100, longest: int = 5, top: int = 2000, share: int = 100
) -> DataFrame:
    """The first ``top`` phrases of each language (``docs``: ``lang, text``): ``lang, rank, phrase, a, l, r, n,
    score``.

    ``a`` counts the phrase, ``l`` and ``r`` its parts at the cut with the lowest ``score`` (``1000 a n / l r``
    rounded down, the first such cut), ``n`` all words of the language. Phrases that make ``share`` percent
    or more of their places inside a longer frequent one are left out. Order: score, count, spelling."""
    found, words, totals = frequent_phrases(docs, min_count, longest)
    phrases = found.where(F.size("codes") > 1)
    lookup = found.select(F.col("codes").alias("part"), F.col("f"))
    size = F.size("codes")
    cuts = phrases.select("codes", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.withColumns(
        {"left": F.slice("codes", F.lit(1), F.col("k")), "right": F.slice("codes", F.col("k") + 1, size - F.col("k"))}
    )
    for side, name in (("left", "l"), ("right", "r")):
        cuts = lookup_join(cuts, lookup.select(F.col("part").alias(side), F.col("f").alias(name)), [side], "inner")
    of = words.join(totals, "lang").select(F.col("code").alias("first"), "lang", "n")
    cuts = lookup_join(cuts.withColumn("first", F.col("codes")[0]), of, ["first"], "inner")
    cuts = cuts.withColumn("score", score())
    best = cuts.groupBy("codes", "lang", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    inside = phrases.where(size > 2).select(
        F.col("f").alias("longer"),
        F.explode(
            F.flatten(F.transform(
                F.sequence(F.lit(2), size - 1),
                lambda m: F.transform(F.sequence(F.lit(1), size - m + 1), lambda at: F.slice("codes", at, m)),
            ))
        ).alias("codes"),
    )
    longer = inside.groupBy("codes").agg(F.max("longer").alias("longer"))
    open_ones = lookup_join(best, longer, ["codes"]).where(
        F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a"))
    )
    ranked = open_ones.select("codes", "lang", "a", "n", "cut.score", "cut.l", "cut.r")
    by_score = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    # ties at the end stay until their spelling decides
    ahead = stored(ranked.withColumn("place", F.rank().over(by_score)).where(F.col("place") <= top).drop("place"))
    spelled = (
        ahead.select("codes", F.posexplode("codes").alias("at", "code")).join(words.select("code", "word"), "code")
        .groupBy("codes").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda w: w["word"]), " ").alias("phrase"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    placed = ahead.join(spelled, "codes").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return placed.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
