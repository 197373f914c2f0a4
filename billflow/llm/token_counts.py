"""Token counts from a byte-pair vocabulary compiled into a finite-state transducer.

The transducer reads characters. Its state says how far the splitting pattern has come and, for the
unfinished piece, which vocabulary entries may still end later: for each such beginning the place in the
vocabulary's trie, the last token before it, and that token count relative to the present one. A transition
carries by how much the count of tokens changes; states and transitions are made when first met.
Within a piece the right token sequence of every prefix is the one whose neighbours never merge.

Texts are read in chunks. Behind the first change from text to space the state no longer depends on what
came before, so the state map of a chunk is its head (applied to the state that enters) and a constant
exit with a constant count. A scan over the chunks of a text composes the maps.

Null text: no tokens. Empty text: no tokens. Repeated rows are each counted. Empty table: empty result.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from billflow.llm.arrays import pieces

CHUNK = 8192  # characters
SCANNED = 64  # chunks whose maps are held at once
WORDS, STATES = 1_000_000, 250_000  # how many paths of words, and states, are kept

# fixed values: white space and the contractions of the vocabulary's splitting pattern
SPACE = "\t-\r \x85\xa0  -     　"
CONTRACTIONS = ("s", "t", "m", "d", "re", "ve", "ll")

_WORD = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
_FIRST_SPACE = re.compile(f"(?<=[^{SPACE}])[{SPACE}]")
_IS_SPACE = re.compile(f"[{SPACE}]")
_IS_LETTER, _IS_NUMBER = regex.compile(r"\p{L}"), regex.compile(r"\p{N}")


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in vocabulary files: itself if it is visible, else the
    next one from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return ({chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)})


class Merges:
    """Vocabulary: tokens 0-255 are bytes, token 256 + i is what merge i makes."""

    def __init__(self, spec: dict) -> None:
        alphabet = byte_alphabet()
        self.text = [bytes([b]) for b in range(256)]
        self.left, self.right = [-1] * 256, [-1] * 256
        self.made: dict[tuple[int, int], int] = {}
        ids = {t: i for i, t in enumerate(self.text)}
        for pair in spec["model"]["merges"]:
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            one, two = (ids[bytes(alphabet[c] for c in x)] for x in (a, b))
            new = len(self.text)
            self.made[one, two] = new
            self.text.append(self.text[one] + self.text[two])
            ids.setdefault(self.text[-1], new)
            self.left.append(one)
            self.right.append(two)
        self.child: dict[int, int] = {}
        self.token_at: dict[int, int] = {}
        nodes = 1
        for token in ids.values():
            at = 0
            for b in self.text[token]:
                key = at << 8 | b
                if key not in self.child:
                    self.child[key] = nodes
                    nodes += 1
                at = self.child[key]
            self.token_at[at] = token
        self.inner = {key >> 8 for key in self.child}  # nodes below which tokens go on
        self._whole: dict[int, bool] = {}
        self._apart: dict[tuple[int, int], bool] = {}

    def encode(self, data: bytes) -> list[int]:
        parts = list(data)
        while len(parts) > 1:
            ranked = [(self.made.get(p, 1 << 30), i) for i, p in enumerate(zip(parts, parts[1:]))]
            rank, _ = min(ranked)
            if rank == 1 << 30:
                break
            out, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and self.made.get((parts[i], parts[i + 1])) == rank:
                    out.append(rank)
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def whole(self, token: int) -> bool:
        """Whether the bytes of the token give the token."""
        known = self._whole.get(token)
        if known is None:
            known = self._whole[token] = self.encode(self.text[token]) == [token]
        return known

    def apart(self, a: int, b: int) -> bool:
        """Whether two neighbours stay apart: undo the later merge of both, again and again; they would have
        joined if the pieces then facing each other merge earlier than what was undone."""
        known = self._apart.get((a, b))
        if known is not None:
            return known
        x, y, limit, known = a, b, 1 << 30, True
        while True:
            joined = self.made.get((x, y))
            if joined is not None and joined < limit:
                known = False
                break
            if x > y and x >= 256:  # equal merges go from left to right: the left one came first
                limit, x = x, self.right[x]
            elif y >= 256:
                limit, y = y + 1, self.left[y]
            else:
                break
        if len(self._apart) > STATES:
            self._apart.clear()
        self._apart[a, b] = known
        return known


class Transducer:
    """Compiled on demand; `run(state, text)` gives the state reached and the tokens counted."""

    START = ("start",)

    def __init__(self, spec: dict) -> None:
        self.merges = Merges(spec)
        special = [t["content"] for t in spec.get("added_tokens", [])]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.memo: dict[str, int] = {}
        self.reset()

    def reset(self) -> None:
        """Forget the states (they are made again when met): memory stays bounded."""
        self.rows: dict[tuple, dict[str, tuple]] = {}
        self.bytes: dict[int, tuple[int, int]] = {}
        self.lives: list[tuple] = [((0, -1, 0),)]
        self.ids: dict[tuple, int] = {self.lives[0]: self.EMPTY}

    # --- inside a piece: bytes ---

    EMPTY = 0

    def _byte(self, live: int, b: int) -> tuple[int, int]:
        key = live << 8 | b
        known = self.bytes.get(key)
        if known is not None:
            return known
        m, moved, token, delta = self.merges, [], -1, 0
        child, token_at, inner = m.child, m.token_at, m.inner
        for node, last, count in self.lives[live]:
            node = child.get(node << 8 | b)
            if node is None:
                continue
            if token < 0:
                found = token_at.get(node)
                if found is not None and m.whole(found) and (last < 0 or m.apart(last, found)):
                    token, delta = found, count + 1
            if node in inner:
                moved.append((node, last, count))
        reached = (*[(n, t, c - delta) for n, t, c in moved], (0, token, 0))
        name = self.ids.get(reached)
        if name is None:
            name = self.ids[reached] = len(self.lives)
            self.lives.append(reached)
        out = self.bytes[key] = (name, delta)
        return out

    def _push(self, live: int, ch: str) -> tuple[int, int]:
        total = 0
        for b in ch.encode():
            live, delta = self._byte(live, b)
            total += delta
        return live, total

    # --- the splitting pattern: characters ---

    def _step(self, state: tuple, ch: str) -> tuple[tuple, int]:
        mode = state[0]
        if mode == "space":
            _, live, extra, last = state
            if _IS_SPACE.match(ch):
                live, delta = self._push(live, ch)
                return ("space", live, delta, ch), extra
            if last == " ":
                live, delta = self._push(self.EMPTY, " ")
                return self._open(live, ch, delta, quote=False)
            live, delta = self._push(self.EMPTY, last)
            state, more = self._open(self.EMPTY, ch, 0, quote=True)
            return state, delta + more
        if _IS_SPACE.match(ch):
            flushed = self.final(state) if mode in ("quote", "quote2") else 0
            live, delta = self._push(self.EMPTY, ch)
            return ("space", live, delta, ch), flushed
        if mode == "quote":
            for ending in CONTRACTIONS:
                if ch == ending:
                    live, delta = self._push(self._push(self.EMPTY, "'")[0], ch)
                    return self.START, 1 + delta
                if len(ending) == 2 and ch == ending[0]:
                    return ("quote2", ch), 0
            live, delta = self._push(self.EMPTY, "'")
            if self._kind(ch) == "other":
                live, more = self._push(live, ch)
                return ("other", live), delta + more
            state, more = self._open(self.EMPTY, ch, 0, quote=False)
            return state, delta + more
        if mode == "quote2":
            if state[1] + ch in CONTRACTIONS:
                live, total = self.EMPTY, 0
                for c in "'" + state[1] + ch:
                    live, delta = self._push(live, c)
                    total += delta
                return self.START, total
            live, delta = self._push(self.EMPTY, state[1])
            state, more = self._step(("letter", live), ch)
            return state, 1 + delta + more
        if mode == self._kind(ch):
            live, delta = self._push(state[1], ch)
            return (mode, live), delta
        return self._open(self.EMPTY, ch, 0, quote=True)

    @staticmethod
    def _kind(ch: str) -> str:
        return ("letter" if _IS_LETTER.match(ch) else "number" if _IS_NUMBER.match(ch)
                else "other")

    def _open(self, live: int, ch: str, count: int, quote: bool) -> tuple[tuple, int]:
        """A piece begins (or goes on behind its one leading blank)."""
        if quote and ch == "'":
            return ("quote",), count
        live, delta = self._push(live, ch)
        return (self._kind(ch), live), count + delta

    def final(self, state: tuple) -> int:
        """Tokens not yet counted when the text ends here."""
        if state[0] == "space":
            return state[2]
        if state[0] == "quote":
            return 1
        if state[0] == "quote2":
            return 1 + self._push(self.EMPTY, state[1])[1]
        return 0

    def run(self, state: tuple, text: str) -> tuple[tuple, int]:
        total, rows = 0, self.rows
        row = rows.setdefault(state, {})
        for ch in text:
            edge = row.get(ch)
            if edge is None:
                state, delta = self._step(state, ch)
                edge = row[ch] = (state, delta, rows.setdefault(state, {}))
            state, delta, row = edge
            total += delta
        return state, total

    def renewed(self, state: tuple) -> tuple:
        """The state, after forgetting all others if they have become many."""
        if len(self.bytes) <= STATES:
            return state
        live = self.lives[state[1]] if state[0] in ("space", "letter", "number", "other") else None
        self.reset()
        if live is None:
            return state
        name = self.ids.setdefault(live, len(self.lives))
        if name == len(self.lives):
            self.lives.append(live)
        return (state[0], name, *state[2:])

    def word(self, text: str) -> int:
        """From one reset to the next: white space, then text."""
        known = self.memo.get(text)
        if known is None:
            if len(self.memo) > WORDS:
                self.memo.clear()
            state, known = self.run(self.START, text)
            known += self.final(state)
            if len(text) <= 64:
                self.memo[text] = known
        return known


@dataclass(frozen=True)
class ChunkMap:
    """What a chunk does to the state that enters. `head` is read from that state; where the chunk has a
    reset, everything behind is constant: `count` tokens, then the state reached by reading `tail`."""
    head: str
    resets: bool
    count: int = 0
    exit: tuple = Transducer.START
    exit_count: int = 0


def chunk_map(machine: Transducer, text: str) -> ChunkMap:
    first = _FIRST_SPACE.search(text)
    if not first:
        return ChunkMap(text, False)
    found = _WORD.findall(text, first.start())
    state, tail_count = machine.run(Transducer.START, found[-1])
    word = machine.word
    return ChunkMap(text[:first.start()], True, sum([word(w) for w in found[:-1]]), state,
                    tail_count)


def scan(machine: Transducer, maps: list[ChunkMap], state: tuple) -> tuple[tuple, int]:
    """Composes the maps from the left: the state behind the last, and the tokens counted on the way."""
    total = 0
    for one in maps:
        state, count = machine.run(state, one.head)
        total += count
        if one.resets:
            total += machine.final(state) + one.count + one.exit_count
            state = one.exit
    return state, total


def count_tokens(machine: Transducer, text: str) -> int:
    if not text:
        return 0
    if machine.special and (marks := machine.special.findall(text)):
        return len(marks) + sum(count_tokens_plain(machine, t)
                                for t in machine.special.split(text))
    return count_tokens_plain(machine, text)


def count_tokens_plain(machine: Transducer, text: str) -> int:
    if len(text) <= CHUNK:
        machine.renewed(Transducer.START)
        word = machine.word
        return sum([word(w) for w in _WORD.findall(text)])
    state, total = Transducer.START, 0
    for low in range(0, len(text), CHUNK * SCANNED):
        state = machine.renewed(state)
        maps = [chunk_map(machine, text[i:i + CHUNK])
                for i in range(low, min(low + CHUNK * SCANNED, len(text)), CHUNK)]
        state, count = scan(machine, maps, state)
        total += count
    return total + machine.final(state)


def with_token_counts(docs: DataFrame, vocabulary: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row. `vocabulary` is the content of the vocabulary file
    (a fixed size, sent along with the task's function)."""
    machine: list[Transducer] = []

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not machine:
            machine.append(Transducer(json.loads(vocabulary)))
        for batch in pieces(batches):
            texts = batch.column("text")
            tokens = pa.array([count_tokens(machine[0], t) for t in texts.to_pylist()], pa.int64())
            size = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), size, tokens, pc.greater(tokens, limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        counted, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
