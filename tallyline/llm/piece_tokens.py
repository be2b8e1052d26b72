"""SentencePiece byte-fallback BPE: encode and decode whole texts exactly as the library does.

Texts are cut where no piece of the vocabulary can cross: between two characters that stand side by side in
no piece, so before runs of the space mark and around line feeds too. Distinct words of a batch are encoded
together by vectorised merge rounds. Words of up to LONG characters lie in one array, a column each: from the
longest down, all words of the present length merge their leftmost pair of the best rank, and words without
a pair left leave the array. Longer words lie flat, one after another: a segmented minimum finds each word's
best pair rank, all words merge their leftmost pairs of that rank at once and merged symbols are compacted
away. There several pairs of one word merge in one round only while none of the new pairs ranks as well as
the merged ones, which keeps the library's order of merges exactly.

Ids of a batch are taken from those of its words, and the texts to be hashed from tables by id: no Python
object is made for a word that stands in a text, only for those that a batch has for the first time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
LONG = 64  # characters; longer words are merged flat and not remembered
CACHED_WORDS = 200_000  # of at most LONG characters each; beyond, the memory starts anew
CHUNK = 1 << 20  # characters whose new words are encoded together
NONE = np.iinfo(np.int64).max
CHARACTERS = 0x110000
BESIDE = 1 << 20  # places of the table of neighbours


@dataclass
class Vocabulary:
    """Pieces by id with their ranks (equal scores have equal ranks); bytes and controls apart."""

    pieces: list[str]
    ranks: np.ndarray
    byte_of: dict[int, int]
    silent: frozenset[int]  # control and unknown ids, which decode to nothing here
    end: int
    keys: np.ndarray | None = None  # left * pieces + right of all pairs that make a piece, sorted
    merged: np.ndarray | None = None  # the pieces they make
    symbol: np.ndarray = field(init=False)
    weight: np.ndarray = field(init=False)
    beside: np.ndarray = field(init=False)
    byte_ids: list[int] = field(init=False)

    def __post_init__(self):
        n = len(self.pieces)
        ids = {p: i for i, p in enumerate(self.pieces) if i not in self.byte_of and i not in self.silent}
        # A character without a piece is a symbol of its own beyond the pieces; no pair holds it.
        self.symbol = np.arange(n, n + CHARACTERS, dtype=np.int32)
        for piece, i in ids.items():
            if len(piece) == 1:
                self.symbol[ord(piece)] = i
        self.byte_ids = [i for _, i in sorted((b, i) for i, b in self.byte_of.items())]
        if self.keys is None:
            pairs = {}
            for piece, i in ids.items():
                for at in range(1, len(piece)):
                    left, right = ids.get(piece[:at]), ids.get(piece[at:])
                    if left is not None and right is not None:
                        pairs[left * n + right] = i
            self.keys = np.array(sorted(pairs), dtype=np.int64)
            self.merged = np.array([pairs[k] for k in self.keys.tolist()], dtype=np.int64)
        # Times LONG, so that a place in the word can be added; the last one, of no piece, is above all.
        self.weight = np.append(self.ranks, n).astype(np.int64) * LONG
        inside = code_points("".join(ids))
        together = np.ones(len(inside), dtype=bool)
        together[np.cumsum([len(p) for p in ids]) - 1] = False
        self.beside = np.zeros(BESIDE, dtype=bool)
        self.beside[place(inside[:-1], inside[1:])[together[:-1]]] = True

    def plain(self) -> dict:
        """The fields it is made from, in types every worker can read."""
        return {name: getattr(self, name) for name in ("pieces", "ranks", "byte_of", "silent", "end", "keys", "merged")}

    def cuts(self, chars: np.ndarray) -> np.ndarray:
        """True before each character that no piece holds together with the one before it. Two pairs of
        characters may share a place of the table; then a cut is left out, which changes no merge."""
        return np.append(True, ~self.beside[place(chars[:-1], chars[1:])])[: len(chars)]

    def merge_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The id of the piece that left and right make, -1 where there is none."""
        n = len(self.pieces)
        known = (left < n) & (right < n)
        if not len(self.keys):
            return np.full(len(left), -1)
        key = np.where(known, left.astype(np.int64, copy=False) * n + right, -1)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.merged[at], -1)

    def rank_of(self, piece: np.ndarray) -> np.ndarray:
        return np.where(piece >= 0, self.ranks[piece], NONE)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)


def place(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Where the table of neighbours has a pair of characters."""
    return (left * np.uint32(4099) + right) & np.uint32(BESIDE - 1)


def read_vocabulary(path: str) -> Vocabulary:
    """Read a model file. Only models the operator reproduces are taken: BPE pieces without text rules."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    if model.encode("A  b ", out_type=str) == model.encode("A b", out_type=str):
        raise ValueError("models that rewrite white space are not supported")
    ids = range(model.get_piece_size())
    scores = np.array([model.get_score(i) for i in ids])
    ranks = np.unique(-scores, return_inverse=True)[1].astype(np.int64)
    pieces = [model.id_to_piece(i) for i in ids]
    return Vocabulary(
        pieces=pieces,
        ranks=ranks,
        byte_of={i: int(pieces[i][3:5], 16) for i in ids if model.is_byte(i)},
        silent=frozenset(i for i in ids if model.is_control(i) or model.is_unknown(i)),
        end=model.eos_id(),
    )


def encode_words(chars: np.ndarray, lengths: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, one after another, and where each word's begin (one more: where they end).
    ``chars`` has their characters one after another, space marks included; no word is empty."""
    symbols = vocabulary.symbol[chars]
    found = [*merge_short(symbols, lengths, vocabulary), *merge_long(symbols, lengths, vocabulary)]
    counts = np.zeros(len(lengths), dtype=np.int64)
    for words, made in found:
        counts[words] = len(made)
    starts = np.append(0, np.cumsum(counts))
    flat = np.empty(starts[-1], dtype=np.int32)
    for words, made in found:
        flat[starts[words] + np.arange(len(made))[:, None]] = made
    unknown = np.flatnonzero(flat >= len(vocabulary.pieces))
    if len(unknown):
        distinct, which = np.unique(flat[unknown], return_inverse=True)
        raw = [chr(c).encode() for c in (distinct - len(vocabulary.pieces)).tolist()]
        width = np.ones(len(flat), dtype=np.int64)
        width[unknown] = np.array([len(r) for r in raw])[which]
        at = np.append(0, np.cumsum(width))
        flat = np.repeat(flat, width)
        for k in range(4):
            held = np.array([vocabulary.byte_ids[r[k]] if k < len(r) else -1 for r in raw])[which]
            flat[at[unknown[held >= 0]] + k] = held[held >= 0]
        starts = at[starts]
    return flat, starts


def merge_short(
    symbols: np.ndarray, lengths: np.ndarray, vocabulary: Vocabulary
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words of up to LONG symbols, finished ones together by their final size: their numbers, and their
    symbols with a column for each."""
    begin = np.cumsum(lengths) - lengths
    order = np.argsort(lengths, kind="stable")
    first = np.searchsorted(lengths[order], np.arange(LONG + 2))
    word = np.empty(0, dtype=np.int64)
    longest = int(lengths[lengths <= LONG].max(initial=0))
    # A column of held has a word's symbols, one of rank the weights of its pairs.
    held, rank = np.empty((longest, 0), dtype=np.int32), np.empty((max(longest - 1, 0), 0), dtype=np.int64)
    for size in range(longest, 0, -1):
        new = order[first[size] : first[size + 1]]
        if len(new):
            fresh = symbols[begin[new] + np.arange(size)[:, None]]
            pairs = vocabulary.weight[vocabulary.merge_of(fresh[:-1], fresh[1:])]
            word = np.concatenate([word, new])
            held, rank = np.concatenate([held, fresh], axis=1), np.concatenate([rank, pairs], axis=1)
        if size == 1:
            yield word, held
            return
        best = (rank + np.arange(size - 1)[:, None]).min(axis=0)
        shut = best >= vocabulary.weight[-1]
        if shut.any():
            yield word[shut], held[:, shut]
            stay = np.flatnonzero(~shut)
            word, best = word[stay], best[stay]
            held, rank = held.take(stay, axis=1), rank.take(stay, axis=1)
        at, column = best % LONG, np.arange(len(word))
        made = vocabulary.merge_of(held[at, column], held[at + 1, column])
        later = np.arange(size - 1)[:, None] > at
        held = np.where(later, held[1:], held[:-1])
        held[at, column] = made
        rank = np.where(later[:-1], rank[1:], rank[:-1])
        left, right = np.flatnonzero(at > 0), np.flatnonzero(at < size - 2)
        rank[at[left] - 1, left] = vocabulary.weight[vocabulary.merge_of(held[at[left] - 1, left], made[left])]
        rank[at[right], right] = vocabulary.weight[vocabulary.merge_of(made[right], held[at[right] + 1, right])]


def merge_long(
    symbols: np.ndarray, lengths: np.ndarray, vocabulary: Vocabulary
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words of more than LONG symbols, each for itself: its number, and its symbols as a column."""
    word = np.repeat(np.arange(len(lengths)), np.where(lengths > LONG, lengths, 0))
    symbols = symbols[np.repeat(lengths > LONG, lengths)].astype(np.int64)
    made, stale = np.full(len(symbols), -1), np.ones(len(symbols), dtype=bool)
    while len(symbols):
        symbols, word, made, stale, (done, words) = merge_round(symbols, word, made, stale, vocabulary)
        if len(words):
            numbers, first = np.unique(words, return_index=True)
            for number, one in zip(numbers, np.split(done, first[1:])):
                yield np.array([number]), one[:, None]


def merge_round(symbols, word, made, stale, vocabulary: Vocabulary):
    """One round over all words: arrays of symbols, their words, what each makes with its right
    neighbour, and where that must be looked up anew. Returns the four for the words still open, then
    symbols and words of the finished ones."""
    same = np.append(word[:-1] == word[1:], False)
    made[stale] = -1
    look = np.flatnonzero(stale & same)
    made[look] = vocabulary.merge_of(symbols[look], symbols[look + 1])
    rank = vocabulary.rank_of(made)
    starts = np.flatnonzero(np.append(True, ~same[:-1]))
    sizes = np.diff(np.append(starts, len(symbols)))
    best = np.repeat(np.minimum.reduceat(rank, starts), sizes)
    shut = best == NONE
    finished = symbols[shut], word[shut]
    if shut.any():
        symbols, word, made, rank, best = (x[~shut] for x in (symbols, word, made, rank, best))
        if not len(symbols):
            return symbols, word, made, made >= 0, finished
    at = np.flatnonzero(rank == best)
    # Leftmost first, without overlap: every other one of each run of neighbours.
    fresh = np.concatenate(([True], np.diff(at) != 1))
    run = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    at = at[(np.arange(len(at)) - run) % 2 == 0]
    new, goal = made[at], rank[at]
    # A new pair that ranks as well as the merged one must come before the word's next merge.
    left = np.where(at > 0, symbols[at - 1], -1)
    beside = np.concatenate(([False], np.diff(at) == 2))
    left[beside] = new[:-1][beside[1:]]
    has_left = (at > 0) & (word[at - 1] == word[at])
    right_at = np.minimum(at + 2, len(symbols) - 1)
    has_right = (at + 2 < len(symbols)) & (word[right_at] == word[at])
    early = np.zeros(len(at), dtype=bool)
    early[has_left] |= vocabulary.rank_of(vocabulary.merge_of(left[has_left], new[has_left])) <= goal[has_left]
    early[has_right] |= (
        vocabulary.rank_of(vocabulary.merge_of(new[has_right], symbols[right_at][has_right])) <= goal[has_right]
    )
    before = np.cumsum(early) - early
    first = np.concatenate(([True], word[at][1:] != word[at][:-1]))
    kept = before == before[np.flatnonzero(first)[np.cumsum(first) - 1]]
    at, new = at[kept], new[kept]
    symbols[at] = new
    stay, stale = np.ones(len(symbols), dtype=bool), np.zeros(len(symbols), dtype=bool)
    stay[at + 1] = False
    stale[at] = stale[np.maximum(at - 1, 0)] = True
    # The left neighbour of a merged symbol may itself have been merged away; then it is the one before.
    stale[np.maximum(at - 2, 0)] = True
    return symbols[stay], word[stay], made[stay], stale[stay], finished


def decode_ids(ids: list[int], vocabulary: Vocabulary, inside: bool = False) -> str:
    """The text of ids. ``inside``: they don't begin a text, so their leading space mark stays."""
    out, raw = [], bytearray()
    for i in ids:
        if i in vocabulary.byte_of:
            raw.append(vocabulary.byte_of[i])
            continue
        if raw:
            out.append(bytes_text(bytes(raw)))
            raw.clear()
        if i not in vocabulary.silent:
            piece = vocabulary.pieces[i]
            if not inside and not out and piece.startswith(SPACE):
                piece = piece[1:]
            inside = inside or i not in vocabulary.silent
            out.append(piece.replace(SPACE, " "))
    if raw:
        out.append(bytes_text(bytes(raw)))
    return "".join(out)


def bytes_text(raw: bytes) -> str:
    """Bytes as UTF-8, each byte that is part of no character as one replacement character."""
    out = []
    while raw:
        try:
            out.append(raw.decode())
            break
        except UnicodeDecodeError as bad:
            out.append(raw[: bad.start].decode() + "�")
            raw = raw[bad.start + 1 :]
    return "".join(out)


class Encoder:
    """Encodes texts with a bounded memory of words: UTF-32 of a word -> its number; ``flat`` has the ids
    of word i from ``starts[i]`` on. Word 0 is the end id, which no word of a text is."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.shown = pa.array([b"%d " % i for i in range(len(vocabulary.pieces))], pa.large_binary())
        spoken = [
            bytes([vocabulary.byte_of[i]]) if i in vocabulary.byte_of
            else b"" if i in vocabulary.silent
            else p.replace(SPACE, " ").encode()
            for i, p in enumerate(vocabulary.pieces)
        ]
        self.spoken = pa.array(spoken, pa.large_binary())
        self.forget()

    def forget(self) -> None:
        self.known, self.flat, self.starts = {}, np.array([self.vocabulary.end], dtype=np.int32), np.array([0, 1])

    def learn(self, keys: list[bytes]) -> None:
        lengths = np.fromiter(map(len, keys), dtype=np.int64, count=len(keys)) // 4
        flat, starts = encode_words(np.frombuffer(b"".join(keys), dtype=np.uint32), lengths, self.vocabulary)
        self.known.update(zip(keys, range(len(self.starts) - 1, len(self.starts) - 1 + len(keys))))
        self.flat = np.concatenate([self.flat, flat])
        self.starts = np.concatenate([self.starts, self.starts[-1] + starts[1:]])

    def numbers(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Numbers of the words of all texts, the end id after each text; where those end ids are; and the
        words that are too long to be remembered, which have the last numbers."""
        chars = code_points("".join([SPACE + text.replace(" ", SPACE) for text in texts if text]))
        cut = self.vocabulary.cuts(chars)
        sizes = np.array([len(text) + 1 if text else 0 for text in texts], dtype=np.int64)
        ends = np.cumsum(sizes)
        cut[(ends - sizes)[sizes > 0]] = True
        begin = np.flatnonzero(cut)
        offsets = np.append(begin, len(chars)) * 4
        words = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(chars)])
        words = words.dictionary_encode()
        keys = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        new = [key for key in keys if key not in self.known]
        long = [key for key in new if len(key) > 4 * LONG]
        self.learn([key for key in new if len(key) <= 4 * LONG])
        if long:
            self.learn(long)
        number = np.fromiter(map(self.known.__getitem__, keys), dtype=np.int64, count=len(keys))
        at = np.searchsorted(begin, ends)
        return np.insert(number[words.indices.to_numpy()], at, 0), at + np.arange(len(texts)), long

    def texts(self, texts: list[str]) -> Iterator[tuple[np.ndarray, memoryview, memoryview]]:
        """Per text: its ids, the ids as text, and the decoded text in UTF-8; end id included."""
        for chunk in chunks(texts):
            if len(self.known) > CACHED_WORDS:
                self.forget()
            number, last, long = self.numbers(chunk)
            size = np.diff(self.starts)[number]
            end = np.cumsum(size)
            ids = self.flat[np.arange(end[-1]) + np.repeat(self.starts[number] - (end - size), size)]
            bounds = np.append(0, end[last])
            shown, spoken = joined(self.shown, ids, bounds), joined(self.spoken, ids, bounds)
            for a, b, listed, text in zip(bounds, bounds[1:], shown, spoken):
                text = text[1:] if text[:1] == b" " else text
                if not is_text(text):
                    text = decode_ids(ids[a:b].tolist(), self.vocabulary).encode()
                yield ids[a:b], listed[:-1], text
            for key in long:
                del self.known[key]
            self.starts = self.starts[: len(self.starts) - len(long)]
            self.flat = self.flat[: self.starts[-1]]


def joined(table: pa.Array, ids: np.ndarray, bounds: np.ndarray) -> list[memoryview]:
    """What the table has for the ids, joined from each bound to the next."""
    taken = table.take(pa.array(ids))
    at = np.frombuffer(taken.buffers()[1], dtype=np.int64)[taken.offset :][bounds].tolist()
    data = memoryview(taken.buffers()[2] or b"")
    return [data[a:b] for a, b in zip(at, at[1:])]


def is_text(raw: memoryview) -> bool:
    """Whether all byte pieces make up whole characters, as those of encoded texts do."""
    try:
        str(raw, "utf-8")
    except UnicodeDecodeError:
        return False
    return True


def chunks(texts: list[str]) -> Iterator[list[str]]:
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= CHUNK:
            yield held
            held, size = [], 0
    if held:
        yield held


def encode(docs: DataFrame, model: str, with_ids: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_tokens, ids_sha256, decoded_sha256`` and, if asked for,
    ``ids array<int>``; an end id and no begin id.

    Null and empty texts give the end id alone and decode to the empty text. Other columns are ignored;
    repeated rows are encoded each; an empty table gives an empty result. Rows stay where they are read:
    nothing is shuffled. ``model`` is a path on the driver; its pieces and their pairs (a few MB) are broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(model).plain())
    kind = docs.schema["doc_id"].dataType.simpleString()
    ids = ", ids array<int>" if with_ids else ""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        _encoder(shared, with_ids), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string{ids}"
    )


def _encoder(shared, with_ids: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(**shared.value))
        for whole in batches:
            for at in range(0, whole.num_rows, 250):
                batch = whole.slice(at, 250)
                counts, ids, texts, raw = [], [], [], []
                for own, listed, decoded in encoder.texts(batch.column(1).to_pylist()):
                    counts.append(len(own))
                    ids.append(hashlib.sha256(listed).hexdigest())
                    texts.append(hashlib.sha256(decoded).hexdigest())
                    if with_ids:
                        raw.append(own)
                columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                    values = pa.array(np.concatenate(raw))
                    columns.append(pa.ListArray.from_arrays(pa.array(offsets), values))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run
