"""SentencePiece encoding and decoding by a Viterbi pass shared between words of a common prefix.

A text becomes marked words: blanks turn into the mark, one mark is put in front, and the text is cut
before each run of marks (no piece holds a mark behind another character). The distinct words of a batch
are sorted, which is their trie in depth-first order: going from one word to the next, the forward scores of
the common prefix stay, and only the rest is scored. So a prefix is scored once for all its words.

A forward score says what the best segmentation of a prefix ends with:
- unigram models: the largest sum of piece scores;
- merge (BPE) models: exactly one segmentation is stable, that of which no two neighbours would merge,
  so the score is reachability, and the last piece before decides what may follow.
Characters outside the vocabulary become their bytes' pieces.

Null text: null pieces. Empty text: no pieces. Repeated rows are each encoded. Decoding gives the text
back unless it holds the mark itself (U+2581), which reads as a blank. Empty table: empty result.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from billflow.llm.arrays import pieces

MARK = "▁"  # fixed value: the blank in vocabulary files
BATCH = 3 << 19  # bytes of text whose words are sorted together
PAIRS = 200_000  # how many decisions on neighbours are kept
KEPT = 200_000  # how many words are kept with their ids from batch to batch; as many that were met before them
SHORT = 32  # characters of a word that is kept


@dataclass
class Vocabulary:
    """Pieces with ids and scores, as read from a model file."""
    pieces: list[str]
    scores: list[float]
    bytes: list[int]  # ids of the pieces of bytes 0 to 255, or nothing
    unknown: int
    unigram: bool
    ids: dict[str, int] = field(default_factory=dict)
    longest: int = 0
    cut_line: bool = False
    _apart: dict = field(default_factory=dict)
    _whole: dict = field(default_factory=dict)
    _words: dict = field(default_factory=dict)  # ids of words as bytes
    _older: dict = field(default_factory=dict)  # those of words met before, until `_words` is full again
    _tails: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        if not self.ids:
            special = {*self.bytes, self.unknown}
            self.ids = {p: i for i, p in enumerate(self.pieces)
                        if p and i not in special and not (p[0] == "<" and p in ("<s>", "</s>"))}
        self.longest = max(map(len, self.ids), default=1)
        self.cut_line = not any("\n" in p for p in self.ids)

    @property
    def tails(self) -> dict[str, int]:
        """All ends of pieces: 0 for what is no piece itself, 1 for a piece, 2 for one known to be whole. What is
        none of them does not end a piece however far it goes back."""
        if not self._tails:
            self._tails = {p[k:]: 0 for p in self.ids for k in range(len(p))}
            self._tails.update(dict.fromkeys(self.ids, 1))
        return self._tails

    def merged(self, text: str) -> list[str]:
        """Pieces by definition: of all neighbours whose union is a piece, join the best, leftmost first."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                joined = self.ids.get(parts[i] + parts[i + 1])
                if joined is not None and (best is None or self.scores[joined] > best):
                    best, at = self.scores[joined], i
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def whole(self, piece: str) -> bool:
        known = self._whole.get(piece)
        if known is None:
            known = self._whole[piece] = self.merged(piece) == [piece]
        return known

    def apart(self, a: str, b: str) -> bool:
        known = self._apart.get((a, b))
        if known is None:
            if len(self._apart) > PAIRS:
                self._apart.clear()
            known = self._apart[a, b] = self.merged(a + b) == [a, b]
        return known

    def id_list(self, piece: str) -> list[int]:
        """The piece's id, or those of its bytes."""
        known = self.ids.get(piece)
        if known is not None:
            return [known]
        return [self.bytes[b] for b in piece.encode()] if self.bytes else [self.unknown]


def read_model(model: bytes, unigram: bool = False) -> Vocabulary:
    """The vocabulary of a model file. `unigram` tells what its scores mean."""
    import sentencepiece
    p = sentencepiece.SentencePieceProcessor(model_proto=model)
    n = p.get_piece_size()
    names = [p.id_to_piece(i) for i in range(n)]
    names = ["" if p.is_control(i) or p.is_unused(i) else x for i, x in enumerate(names)]
    in_bytes = {names[i]: i for i in range(n) if p.is_byte(i)}
    return Vocabulary(names, [p.get_score(i) for i in range(n)],
                      [in_bytes[f"<0x{b:02X}>"] for b in range(256)] if in_bytes else [],
                      p.unk_id(), unigram)


def marked_words(vocabulary: Vocabulary) -> re.Pattern:
    if vocabulary.cut_line:
        return re.compile(f"{MARK}+[^{MARK}\n]*|\n|[^{MARK}\n]+")
    return re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


def encode_words(vocabulary: Vocabulary, words: list[str]) -> dict[str, list[int]]:
    """Ids of each distinct word: depth-first over the sorted words, keeping scores of shared prefixes."""
    ids, longest, scores = vocabulary.ids, vocabulary.longest, vocabulary.scores
    whole, apart, known = vocabulary.whole, vocabulary.apart, vocabulary._apart
    tails, end_of = vocabulary.tails, vocabulary.tails.get
    lowest = min(scores, default=0.0) - 10.0  # an unknown character, as costly as in the library
    out, before = {}, ""
    last: list[str] = [""]  # last[i]: the piece that ends at i in the segmentation of the first i
    total: list[float] = [0.0]
    for word in sorted(words):
        shared, most = 0, min(len(word), len(before))
        while shared < most and word[shared] == before[shared]:
            shared += 1
        del last[shared + 1:]
        if vocabulary.unigram:
            del total[shared + 1:]
            for end in range(shared + 1, len(word) + 1):
                best, piece = total[end - 1] + lowest, word[end - 1]
                for start in range(max(0, end - longest), end):
                    i = ids.get(word[start:end])
                    if i is not None and total[start] + scores[i] > best:
                        best, piece = total[start] + scores[i], word[start:end]
                total.append(best)
                last.append(piece)
        else:
            for end in range(shared + 1, len(word) + 1):
                # back as far as pieces may reach, then the longest that follows what is before it
                start, reached = end - 1, []
                while start:
                    piece = word[start - 1:end]
                    kind = end_of(piece)
                    if kind is None:
                        break
                    start -= 1
                    if kind:
                        reached.append(piece)
                found = None
                for piece in reversed(reached):
                    if tails[piece] == 1:
                        tails[piece] = 2 if whole(piece) else 0
                    if not tails[piece]:
                        continue
                    left = last[end - len(piece)]
                    if not left:
                        found = piece
                        break
                    pair = known.get((left, piece))
                    if pair or pair is None and apart(left, piece):
                        found = piece
                        break
                last.append(found if found is not None else word[end - 1])
        before, end, parts = word, len(word), []
        while end:
            parts.append(last[end])
            end -= len(last[end])
        found_ids: list[int] = []
        for piece in reversed(parts):
            i = ids.get(piece)
            if i is None:
                found_ids += vocabulary.id_list(piece)
            else:
                found_ids.append(i)
        out[word] = found_ids
    return out


def _ids_of(vocabulary: Vocabulary, words: list[str]) -> list[bytes]:
    """Ids of distinct words as 32-bit numbers. Words are kept until so many were met twice over without them."""
    kept, older = vocabulary._words, vocabulary._older
    ids = list(map(kept.get, words))
    again = {w: older[w] for w, x in zip(words, ids) if x is None and w in older}
    fresh = {w: array("i", x).tobytes() for w, x in encode_words(
        vocabulary, [w for w, x in zip(words, ids) if x is None and w not in again]).items()}
    if len(kept) + len(again) + len(fresh) > KEPT:
        vocabulary._older = kept
        kept = vocabulary._words = {}
    kept.update(again)
    kept.update(islice(((w, x) for w, x in fresh.items() if len(w) <= SHORT), KEPT))
    return [x or fresh.get(w) or again[w] for w, x in zip(words, ids)]


def encode_texts(vocabulary: Vocabulary, texts: list[str | None]) -> pa.Array:
    """A list of ids for each text; null for null."""
    find = marked_words(vocabulary).findall
    split = [find(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
    number: defaultdict[str, int] = defaultdict(count().__next__)
    used = np.fromiter(map(number.__getitem__, chain.from_iterable(split)), dtype=np.int64,
                       count=sum(map(len, split)))
    ids = _ids_of(vocabulary, list(number))
    sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
    flat = np.frombuffer(b"".join(ids), dtype=np.int32)
    starts = np.cumsum(sizes) - sizes
    n = sizes[used]
    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[used], n)
    of = np.repeat(np.arange(len(texts)), [len(w) for w in split])
    ends = np.cumsum(np.bincount(of, n, minlength=len(texts)).astype(np.int64))
    offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32),
                       mask=np.array([*[t is None for t in texts], False]))
    return pa.ListArray.from_arrays(offsets, pa.array(flat[place]))


def decode_ids(vocabulary: Vocabulary, ids: list[int] | None) -> str | None:
    """The text of a list of ids."""
    if ids is None:
        return None
    data = b"".join([_piece_bytes(vocabulary)[i] for i in ids])
    return data.decode("utf-8", "replace").removeprefix(" ")


def _piece_bytes(vocabulary: Vocabulary) -> list[bytes]:
    table = vocabulary.__dict__.get("_table")
    if table is None:
        table = [p.replace(MARK, " ").encode() for p in vocabulary.pieces]
        for b, i in enumerate(vocabulary.bytes):
            table[i] = bytes([b])
        table[vocabulary.unknown] = " ⁇ ".encode()
        vocabulary.__dict__["_table"] = table
    return table


def decode_lists(vocabulary: Vocabulary, ids: pa.ListArray) -> pa.Array:
    """The text of each list: the bytes of all pieces put one after another, then cut by list."""
    table = _piece_bytes(vocabulary)
    size = np.fromiter(map(len, table), dtype=np.int64, count=len(table))
    start = np.cumsum(size) - size
    flat = ids.values.to_numpy()
    n = size[flat]
    ends = np.concatenate([[0], np.cumsum(n)])
    place = np.repeat(start[flat] - ends[:-1], n) + np.arange(ends[-1])
    data = np.frombuffer(b"".join(table), dtype=np.uint8)[place].tobytes()
    bounds = ends[ids.offsets.to_numpy()].tolist()
    return pa.array([data[i:j].decode("utf-8", "replace").removeprefix(" ") if valid else None
                     for i, j, valid in zip(bounds, bounds[1:], ids.is_valid().to_pylist())],
                    pa.string())


_at_work: dict[str, Vocabulary] = {}


def _known_here(key: str, vocabulary: Vocabulary) -> Vocabulary:
    """The same vocabulary with the words and decisions that earlier tasks of this process came to know."""
    if key not in _at_work:
        _at_work.clear()
        _at_work[key] = vocabulary
    return _at_work[key]


def encode_decode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, ids, n_pieces and, read back from the ids, the decoded text of each row."""
    key = hashlib.sha256(repr((vocabulary.pieces, vocabulary.scores, vocabulary.bytes, vocabulary.unknown,
                               vocabulary.unigram, vocabulary.ids)).encode()).hexdigest()

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _known_here(key, vocabulary)
        for batch in pieces(batches, size=BATCH):
            ids = encode_texts(known, batch.column("text").to_pylist())
            decoded = decode_lists(known, ids)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), ids, ids.value_lengths().cast(pa.int64()), decoded],
                names=["doc_id", "ids", "n_pieces", "decoded"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        coded, f"doc_id {kind}, ids array<int>, n_pieces long, decoded string")
