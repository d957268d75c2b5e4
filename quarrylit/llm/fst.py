"""Token counts from compiled finite-state transducers.

Two deterministic transducers, compiled from a byte-level BPE tokenizer's file:

* The splitter reads character classes and marks where a pre-token begins.  A text is cut
  into chunks of fixed length; for each chunk the map from every entry state to its exit
  state is computed for all chunks in lockstep, the maps are composed by a parallel prefix
  scan, and with the true entry states the marks follow.
* The counter reads the bytes of one pre-token.  Its states are what future tokens can
  depend on: the node of the token trie's longest matching suffix, with the last token and
  the relative count at each place where a longer token could still begin.  A transition
  is annotated with the tokens that it adds to the count (possibly negative: a longer token
  may replace several).  States are made when first reached and kept for the worker's life,
  up to a bound beyond which the table starts anew; results don't depend on that.

Pre-tokens of a slice run in lockstep, once for each distinct one, so a step is a gather.
Long ones are cut into chunks too: the maps of their chunks, from entry states to exit states
and added counts, are composed by the same doubling.

That the last token of a prefix's encoding follows from the pairs of adjacent tokens that
may stand side by side is a known property of BPE (each prefix's encoding ends in the
longest token that is compatible with the encoding of what precedes it).

Defined cases: a null text is empty; an empty text has no tokens; special strings inside a
text are what the tokenizer file says (one token each); rows that repeat and rows without id are
counted each for itself; columns beside the text and id, whatever their names, don't matter; an empty table
has no rows.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import arrowtext as at

#: Fixed: the characters that \s stands for.
SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"

#: Fixed: what the splitter stands for.
PRE_TOKENIZER = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}

# Character classes.  Letters that occur in contractions have classes of their own.
LETTER, NUMBER, SPACE, BLANK, OTHER, QUOTE, ONE, R, E, V, L = range(11)
_LETTERS = (LETTER, ONE, R, E, V, L)
N_CLASSES = 12
END = 11


@lru_cache(1)
def class_table() -> np.ndarray:
    out = np.full(0x110000, OTHER, np.uint8)
    for cp in range(0x110000):
        kind = unicodedata.category(chr(cp))[0]
        if kind == "L":
            out[cp] = LETTER
        elif kind == "N":
            out[cp] = NUMBER
    for c in SPACES:
        out[ord(c)] = BLANK
    for c, k in ((" ", SPACE), ("'", QUOTE), *((c, ONE) for c in "stmd"), ("r", R), ("e", E), ("v", V), ("l", L)):
        out[ord(c)] = k
    return out


def _splitter() -> tuple[np.ndarray, np.ndarray]:
    """next[state, window] and mark[state, window] of the splitter.

    A window is the class of a character and those of the two that follow it, as a number in base
    N_CLASSES.  States say what the pre-token that the last character belongs to is, and so what the next
    character does to it: nothing open, a letter run, a number run, a run of others, a run of white
    space that goes on, a space that leads the next run, and the last one or two letters of a
    contraction still to come.
    """
    NONE, LETTERS, NUMBERS, OTHERS, WHITE, LEAD, TAIL1, TAIL2 = range(8)
    step = np.zeros((8, N_CLASSES**3), np.uint8)
    mark = np.zeros((8, N_CLASSES**3), bool)
    white = (SPACE, BLANK)
    for state in range(8):
        for a in range(N_CLASSES):
            for b in range(N_CLASSES):
                for c in range(N_CLASSES):
                    w = (a * N_CLASSES + b) * N_CLASSES + c
                    if state in (TAIL1, TAIL2):
                        step[state, w], mark[state, w] = (NONE, False) if state == TAIL1 else (TAIL1, False)
                        continue
                    run = LETTERS if a in _LETTERS else NUMBERS if a == NUMBER else WHITE if a in white else OTHERS
                    if run == WHITE:
                        # the last white space before something else stands alone, or leads it if it is a space
                        last = b not in white and b != END
                        if last:
                            step[state, w] = LEAD if a == SPACE else NONE
                            mark[state, w] = True
                        else:
                            step[state, w] = WHITE
                            mark[state, w] = state != WHITE
                    elif run == OTHERS and a == QUOTE and state not in (OTHERS, LEAD) and (b == ONE or (b, c) in ((R, E), (V, E), (L, L))):
                        step[state, w], mark[state, w] = (TAIL1 if b == ONE else TAIL2), True
                    else:
                        step[state, w], mark[state, w] = run, state not in (run, LEAD)
    return step, mark


CHUNK = 32
MARKED = 8


@lru_cache(1)
def splitter() -> tuple[np.ndarray, bytes]:
    """The kind of each window (and of windows at a text's first character, from N_CLASSES**3 on), and the
    byte table that takes kind * 8 + state to the next state, with MARKED added where a pre-token begins.

    Windows that do the same from every state are of one kind, and there are so few kinds that kind and
    state fit a byte: a step of all chunks is then one byte translation."""
    step, mark = _splitter()
    act = step + MARKED * mark.astype(np.uint8)
    begin = np.broadcast_to(act[0] | MARKED, act.shape)  # whatever came before
    columns, kind = np.unique(np.concatenate((act, begin), 1), axis=1, return_inverse=True)
    if columns.shape[1] > 32:
        raise AssertionError("kinds and states don't fit a byte")
    table = np.zeros(256, np.uint8)
    table[: columns.size] = columns.T.reshape(-1)
    return kind.reshape(-1).astype(np.uint8) * 8, table.tobytes()


def chunk_maps(kinds: np.ndarray) -> np.ndarray:
    """kinds[k, chunk]: the window kind (times 8) of each chunk's k-th character.  For each chunk (column) the state that
    each entry state (row) leads to."""
    table = splitter()[1]
    out = np.repeat(np.arange(8, dtype=np.uint8)[:, None], kinds.shape[1], 1)
    for row in kinds:
        out = np.frombuffer((out + row).tobytes().translate(table), np.uint8).reshape(out.shape) & 7
    return out


def scan(maps: np.ndarray) -> np.ndarray:
    """Prefix compositions: column i leads from entry states of the first chunk to exit states of chunk i (doubling)."""
    out, d = maps.copy(), 1
    while d < out.shape[1]:
        later, earlier = out[:, d:], out[:, :-d]
        out = np.concatenate((out[:, :d], later[earlier, np.arange(later.shape[1])]), 1)
        if d >= 8 and (out[:, d:] == out[:1, d:]).all():
            break  # every map is constant already: longer compositions change nothing
        d *= 2
    return out


def split_marks(classes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where pre-tokens begin.  first: the places of texts' first characters, which always begin one."""
    n = len(classes)
    if not n:
        return np.zeros(0, bool)
    kind, table = splitter()
    b, c = (np.concatenate((classes[k:], np.full(k, END, np.uint8)))[:n] for k in (1, 2))
    last = first[1:] - 1
    b[last[last >= 0]] = END
    c[last[last >= 0]] = END
    c[(last - 1)[last >= 1]] = END
    windows = (classes.astype(np.int16) * N_CLASSES + b) * N_CLASSES + c
    windows[first[first < n]] += N_CLASSES**3
    rows = -(-n // CHUNK)
    kinds = np.zeros(rows * CHUNK, np.uint8)
    kinds[:n] = kind[windows]
    kinds = np.ascontiguousarray(kinds.reshape(rows, CHUNK).T)
    state = np.zeros(rows, np.uint8)
    state[1:] = scan(chunk_maps(kinds))[0, :-1]
    marks = np.empty((CHUNK, rows), bool)
    for k, row in enumerate(kinds):
        got = np.frombuffer((state + row).tobytes().translate(table), np.uint8)
        marks[k] = got >= MARKED
        state = got & 7
    return np.ascontiguousarray(marks.T).reshape(-1)[:n]


def byte_symbols() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones for themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Arcs:
    """Transitions by 256 * state + byte, in an open-addressed table that is probed for many at once."""

    def __init__(self, bits: int = 16):
        self.bits, self.n = bits, 0
        self.key = np.full(1 << bits, -1, np.int64)
        self.to, self.delta = np.zeros(1 << bits, np.int32), np.zeros(1 << bits, np.int16)

    def _slot(self, arc: np.ndarray) -> np.ndarray:
        return (arc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, arc: np.ndarray) -> np.ndarray:
        """The slot of each transition, -1 where there is none."""
        slot = self._slot(arc)
        held = self.key[slot]
        rest = np.flatnonzero((held != arc) & (held >= 0))
        while len(rest):
            slot[rest] = (slot[rest] + 1) & (len(self.key) - 1)
            held[rest] = self.key[slot[rest]]
            rest = rest[(held[rest] != arc[rest]) & (held[rest] >= 0)]
        slot[held < 0] = -1
        return slot

    def add(self, arc: np.ndarray, to: np.ndarray, delta: np.ndarray) -> None:
        """Adds transitions, which are distinct and not yet there."""
        if 2 * (self.n + len(arc)) > len(self.key):
            old = self.key >= 0
            arc, to, delta = np.concatenate((self.key[old], arc)), np.concatenate((self.to[old], to)), np.concatenate((self.delta[old], delta))
            self.__init__(max(self.bits + 1, int(4 * len(arc)).bit_length()))
        self.n += len(arc)
        slot, rest = self._slot(arc), np.arange(len(arc))
        while len(rest):
            free = rest[self.key[slot[rest]] < 0]
            self.key[slot[free]] = arc[free]  # of several that want a slot the last one gets it
            got = rest[self.key[slot[rest]] == arc[rest]]
            self.to[slot[got]], self.delta[slot[got]] = to[got], delta[got]
            rest = rest[self.key[slot[rest]] != arc[rest]]
            slot[rest] = (slot[rest] + 1) & (len(self.key) - 1)


class Counter:
    """The counting transducer of a byte-level BPE file."""

    #: States kept at most; beyond that the table starts anew between two slices.
    MOST_STATES = 400_000

    def __init__(self, path: str):
        spec = json.loads(open(path, encoding="utf-8").read())
        model = spec["model"]
        if spec.get("normalizer") or spec.get("pre_tokenizer") != PRE_TOKENIZER or any(model.get(k) for k in ("dropout", "ignore_merges", "byte_fallback", "end_of_word_suffix", "continuing_subword_prefix")):
            raise ValueError("not the byte-level BPE file that the splitter is written for")
        code = byte_symbols()
        raw = lambda s: bytes(code[c] for c in s)
        self.special = [t["content"] for t in spec["added_tokens"]]
        specials = set(self.special)
        self.tokens = {raw(k): v for k, v in model["vocab"].items() if k not in specials}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank, self.born, self.parts = {}, dict.fromkeys(self.tokens.values(), -1), {}
        for i, (a, b) in enumerate(merges):
            pair, made = (self.tokens[raw(a)], self.tokens[raw(b)]), self.tokens[raw(a) + raw(b)]
            if made in self.parts:
                raise ValueError("a token that two merges make")
            self.rank[pair], self.born[made], self.parts[made] = i, i, pair
        # the trie of tokens, each node with the token that it is (-1: none) and its children
        self.children: list[dict[int, int]] = [{}]
        self.token_at = [-1]
        for word, number in self.tokens.items():
            node = 0
            for b in word:
                nxt = self.children[node].get(b)
                if nxt is None:
                    nxt = len(self.children)
                    self.children[node][b] = nxt
                    self.children.append({})
                    self.token_at.append(-1)
                node = nxt
            self.token_at[node] = number
        self.side_by_side: dict[tuple[int, int], bool] = {}
        self.reset()

    def reset(self) -> None:
        # a state: places where a token that is still being read may have begun, longest first, as
        # (trie node, last token before that place or -1, tokens before it minus tokens up to now)
        start = ((0, -1, 0),)
        self.states = {start: 0}
        self.keys = [start]
        self.arcs = Arcs()

    def _may_follow(self, left: int, right: int) -> bool:
        """Whether the two tokens' bytes are encoded as these two tokens.

        Undoes their merges from the last one back: the parts on either side of the seam must at no time
        have had a merge of their own that comes before the one that took them up."""
        key = left, right
        got = self.side_by_side.get(key)
        if got is None:
            limit, got = 1 << 60, True
            while True:
                if self.rank.get((left, right), 1 << 60) < limit:
                    got = False
                    break
                if self.born[left] > self.born[right]:
                    limit = self.born[left]
                    left = self.parts[left][1]
                elif self.born[right] >= 0:
                    limit = self.born[right] + 1  # of equal merges the left one comes first
                    right = self.parts[right][0]
                else:
                    break
            self.side_by_side[key] = got
        return got

    def _compile(self, state: int, byte: int) -> tuple[int, int]:
        """The state that the transition leads to, made if it is new, and the tokens that it adds."""
        live, last, count = [], None, 0
        for node, before, less in self.keys[state]:
            node = self.children[node].get(byte)
            if node is None:
                continue
            token = self.token_at[node]
            if last is None and token >= 0 and (before < 0 or self._may_follow(before, token)):
                last, count = token, less + 1
            if self.children[node]:
                live.append((node, before, less))
        if last is None:
            raise ValueError("a byte that is no token of its own")
        key = (*((node, before, less - count) for node, before, less in live), (0, last, 0))
        to = self.states.get(key)
        if to is None:
            to = self.states[key] = len(self.keys)
            self.keys.append(key)
        return to, count

    #: Spans of more bytes are cut into pieces, which run from states guessed by running over some bytes before them.
    LONG = 1024
    PIECE = 256
    WARM = 48

    def count(self, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The tokens of each span of the bytes."""
        if len(self.keys) > self.MOST_STATES:
            self.reset()
        out = np.zeros(len(start), np.int64)
        short = length <= self.LONG
        out[short] = self._run(data, start[short], length[short], np.zeros(int(short.sum()), np.int32))[0]
        if not short.all():
            out[~short] = self._long(data, start[~short], length[~short])
        return out

    def _run(self, data: np.ndarray, start: np.ndarray, length: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The tokens that spans add from their entry states on, and their exit states; spans run in lockstep."""
        order = np.argsort(-length, kind="stable")
        start, length, state = start[order], length[order], state[order]
        total = np.zeros(len(start), np.int64)
        for k in range(int(length[0]) if len(length) else 0):
            n = int(np.searchsorted(-length, -k, "left"))  # those longer than k
            byte, own = data[start[:n] + k], state[:n]
            arc = own.astype(np.int64) * 256 + byte
            slot = self.arcs.find(arc)
            if (missing := slot < 0).any():
                new = np.unique(arc[missing])
                made = np.array([self._compile(p >> 8, p & 255) for p in new.tolist()], np.int64).reshape(-1, 2)
                self.arcs.add(new, made[:, 0], made[:, 1])
                slot = self.arcs.find(arc)
            total[:n] += self.arcs.delta[slot]
            state[:n] = self.arcs.to[slot]
        back = np.argsort(order)
        return total[back], state[back]

    def _long(self, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Long spans by maps of their pieces: from an entry state to the exit state and the tokens added.

        A piece's map begins with one guessed entry state and grows by the exit states of the piece before,
        until every exit is an entry.  Prefix composition by doubling then sums up from each span's start."""
        per = -(-length // self.PIECE)
        span = np.repeat(np.arange(len(start)), per)
        head = np.cumsum(per) - per
        at_ = start[span] + (np.arange(len(span)) - head[span]) * self.PIECE
        size = np.minimum(self.PIECE, start[span] + length[span] - at_)
        last = np.append(span[1:] != span[:-1], True)
        warm = np.where(np.arange(len(span)) == head[span], 0, self.WARM)
        entry = self._run(data, at_ - warm, warm, np.zeros(len(span), np.int32))[1]
        index: dict[tuple[int, int], int] = {}
        piece, exits, added = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64)
        new, state = np.arange(len(span)), entry
        while len(new):
            index.update(zip(zip(new.tolist(), state.tolist(), strict=True), range(len(piece), len(piece) + len(new)), strict=True))
            count, to = self._run(data, at_[new], size[new], state)
            piece, exits, added = np.concatenate((piece, new)), np.concatenate((exits, to)), np.concatenate((added, count))
            follow = [(p + 1, e) for p, e in zip(piece.tolist(), exits.tolist(), strict=True) if not last[p]]
            more = sorted({x for x in follow if x not in index})
            new, state = np.array([p for p, _ in more], np.int64), np.array([e for _, e in more], np.int32)
        after = np.array([-1 if last[p] else index[p + 1, e] for p, e in zip(piece.tolist(), exits.tolist(), strict=True)])
        while (after >= 0).any():
            added = added + np.where(after >= 0, added[after], 0)
            after = np.where(after >= 0, after[after], -1)
        return added[head]


@lru_cache(2)
def counter(path: str) -> Counter:
    return Counter(path)


#: Pre-tokens that a worker remembers the counts of, by their bytes: only a matter of speed.
MOST = 150_000


@lru_cache(2)
def memo(path: str) -> dict[bytes, int]:
    return {}


def token_counts(texts: at.Texts, path: str) -> np.ndarray:
    """The number of tokens of each text."""
    machine, seen = counter(path), memo(path)
    special = np.zeros(texts.n, np.int64)
    raw = texts.data.tobytes()
    found = [s for s in machine.special if s.encode() in raw]
    if found:
        texts, special = _without_special(texts, found)
    owner_of = texts.owner if found else None
    chars = (texts.data & 0xC0) != 0x80
    at_char = np.flatnonzero(chars)
    code = np.frombuffer(texts.data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    # first characters: the character numbers of texts' first bytes (empty texts share the next one's)
    first = np.unique(np.searchsorted(at_char, texts.offsets[:-1]))
    marks = split_marks(class_table()[code], first)
    start = at_char[marks]
    if not len(start):
        return special
    length = np.diff(np.append(start, len(texts.data)))
    end = start + length
    where, back = at.distinct(texts.data, start, end, at.span_hash(texts.data, start, end))
    raw = texts.data.tobytes()
    pieces = [raw[s:e] for s, e in zip(start[where].tolist(), end[where].tolist(), strict=True)]
    if len(seen) + len(pieces) > MOST:
        seen.clear()
    if new := [i for i, x in enumerate(pieces) if x not in seen]:
        got = machine.count(texts.data, start[where[new]], length[where[new]])
        seen.update(zip((pieces[i] for i in new), got.tolist(), strict=True))
    value = np.fromiter(map(seen.__getitem__, pieces), np.int64, len(pieces))
    sums = np.zeros(len(start) + 1, np.int64)
    np.cumsum(value[back], out=sums[1:])
    bounds = np.searchsorted(start, texts.offsets)
    out = sums[bounds[1:]] - sums[bounds[:-1]]
    if found:
        return special + np.bincount(owner_of, weights=out, minlength=len(special)).astype(np.int64)
    return out


def _without_special(texts: at.Texts, found: list[str]) -> tuple[at.Texts, np.ndarray]:
    """The pieces of the texts between special strings, each with its owner, and how many such strings each text has."""
    import re

    cut = re.compile(b"|".join(re.escape(s.encode()) for s in found))
    pieces, owner, special = [], [], np.zeros(texts.n, np.int64)
    for i in range(texts.n):
        own = cut.split(texts.data[texts.offsets[i] : texts.offsets[i + 1]].tobytes())
        special[i] = len(own) - 1
        pieces += own
        owner += [i] * len(own)
    offsets = np.concatenate(([0], np.cumsum([len(p) for p in pieces]))).astype(np.int64)
    out = at.Texts(np.frombuffer(b"".join(pieces), np.uint8), offsets, np.zeros(len(pieces), bool))
    out.owner = np.array(owner)
    return out, special


def counts(docs: DataFrame, path: str, *, limit: int = 512, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Per document: its id, n_bytes, n_tokens, and over_limit (more tokens than the limit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in at.slices(batch, text):
                n = token_counts(texts, path)
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.diff(texts.offsets)), pa.array(n), pa.array(n > limit)], names=[id_column, "n_bytes", "n_tokens", "over_limit"])

    schema = T.StructType([docs.schema[id_column]]).add("n_bytes", "long").add("n_tokens", "long").add("over_limit", "boolean")
    return docs.select(id_column, text).mapInArrow(run, schema)
