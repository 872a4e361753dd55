"""Byte-level BPE by a tokenization automaton.

The merge list is compiled into a deterministic automaton over tokens whose only path for a byte string spells its BPE
tokenization. Construction starts with one state and an arc for every byte, and applies one gadget for each merge
``(u, v) -> uv`` in order: the state reached by ``u`` is cloned without its ``v`` arc, and wherever a ``u`` arc leaves, a
``uv`` arc is added that ends in a clone of the state reached by ``v``. All arcs of a token end in one state, so a state
is named by its last token. A merge whose arcs are already gone adds nothing (its token is unreachable).

After the last merge the tables are laid out:

- **Arcs.** A gadget's removed arc is inherited by the later clones of its state, and by the later tokens that begin
  with its token. With states numbered in the order of a walk down the clones, and tokens in one down the beginnings
  (latest first), that is a rectangle of states times tokens. A state's row of the arc table holds the ranges of token
  numbers without an arc; all others have one.
- **Labels.** A transition table (state of the matcher, byte) over all labels: it gives the longest label that ends at a
  byte, and each label the next shorter one that ends it.

``encode_words`` reads many words byte by byte: the token that ends each prefix of a word is unique, so the
labels that end there are tried, longest first, until one has an arc from the state reached before it. Nothing is taken back. The
path is read off from the end. ``decode`` emits the labels of the arcs. Ids are those of the vocabulary file; texts are
pre-split by its byte-level pattern, and added tokens found in a text stand for themselves, as the tokenizers library has
it by default.

Null and empty texts have no tokens (count 0, hashes of nothing). Words repeat, so each task keeps the ids of about
``CACHE_WORDS`` words; a word of any length is run through the automaton in time linear in its length.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
import itertools
import json
import sys
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHE_WORDS = 200_000
#: Texts are taken in runs of about this many characters, whose new words are encoded at once.
RUN_CHARS = 1 << 20
#: Words of more bytes are read one at a time.
LONG_WORD = 64
#: Slots of the table of arcs looked up before.
SEEN_BITS = 18
#: Fixed by the vocabulary's format: the pattern of its pre-tokenizer.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_symbols() -> dict[str, int]:
    """The character that stands for each byte: printable Latin-1 ones for themselves, others from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(shown)]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class _Walk:
    """Numbers of the nodes of a forest, parents first and of siblings the latest born first, so that a node and the
    subtrees of its children born at or after some time have consecutive numbers."""

    def __init__(self, nodes: list[int], above: dict[int, int], born: dict[int, int]):
        self.below: dict[int, list[int]] = {}       # children and their times, oldest first
        self.times: dict[int, list[int]] = {}
        for node in nodes:              # in the order of birth
            if node in above:
                self.below.setdefault(above[node], []).append(node)
                self.times.setdefault(above[node], []).append(born[node])
        self.number: dict[int, int] = {}
        self.end: dict[int, int] = {}
        stack = [n for n in nodes if n not in above]
        while stack:
            node = stack.pop()
            if node < 0:
                self.end[~node] = len(self.number)
                continue
            self.number[node] = len(self.number)
            stack.append(~node)
            stack += self.below.get(node, [])

    def range(self, node: int, since: int) -> tuple[int, int]:
        """First and last (excluded) number of the node and its subtrees born at ``since`` or later."""
        older = bisect.bisect_left(self.times.get(node, ()), since)
        return self.number[node], self.number[self.below[node][older - 1]] if older else self.end[node]


class Automaton:
    """Tokenization automaton of a vocabulary (token bytes -> id) and its merges (pairs of token bytes, in order)."""

    def __init__(self, vocab: dict[bytes, int], merges: list[tuple[bytes, bytes]]):
        self.label = {i: b for b, i in vocab.items()}
        self.parent: dict[int, int] = {}        # state -> the state it was cloned from
        self.born: dict[int, int] = {}          # state -> the merge that made it
        self.left: dict[int, int] = {}          # token -> the token whose arcs it follows
        self.lost: dict[int, int] = {}          # (state, token) -> the merge that removed the arc
        self.labels = {bytes([b]): vocab[bytes([b])] for b in range(256)}       # labels of the arcs, oldest first
        for time, (u, v) in enumerate(merges):
            if u in self.labels and v in self.labels:      # of an unreachable token there are no arcs
                self._gadget(time, vocab[u], vocab[v], u + v, vocab[u + v])
        self._lay_out_arcs()
        self._lay_out_labels()
        self.seen = np.full(1 << SEEN_BITS, -1, dtype=np.int64)

    def _gadget(self, time: int, u: int, v: int, text: bytes, token: int) -> None:
        if token in self.born or not self._arc_now(u, v):
            return
        self.lost[u << 32 | v] = time
        self.parent[token], self.left[token], self.born[token] = v, u, time
        self.labels[text] = token

    def _arc_now(self, state: int, token: int) -> bool:
        """Whether the state has an arc for the token while gadgets are being applied.

        The arc is gone if a gadget removed the arc of an ancestor token from an ancestor state before the state was
        cloned and before the token was made. A merge ``(u, u)`` removes first and adds then: ``u`` has no arc ``uu``.
        """
        lost, born = self.lost, self.born
        until = 1 << 40
        while True:
            t, before = token, 1 << 40
            while True:
                at = lost.get(state << 32 | t)
                if at is not None and at < until and at <= before:
                    return False
                if t not in born:
                    break
                before = min(before, born[t])
                t = self.left[t]
            if state not in born:
                return True
            until = min(until, born[state])
            state = self.parent[state]

    def _lay_out_arcs(self) -> None:
        nodes = list(self.labels.values())
        states, tokens = _Walk(nodes, self.parent, self.born), _Walk(nodes, self.left, self.born)
        self.state_no = np.zeros(max(self.label) + 1, dtype=np.int64)
        self.token_no = np.zeros(max(self.label) + 1, dtype=np.int64)
        self.state_no[nodes] = [states.number[t] for t in nodes]
        self.token_no[nodes] = [tokens.number[t] for t in nodes]
        removed = np.array([(*states.range(k >> 32, time + 1), *tokens.range(k & 0xFFFFFFFF, time))
                            for k, time in self.lost.items()], dtype=np.int64).reshape(-1, 4)
        high = removed[:, 1] - removed[:, 0]
        row = np.repeat(removed[:, 0] - np.cumsum(high) + high, high) + np.arange(high.sum())
        # Ranges of a row are nested or apart: sorted by their beginnings, those inside an earlier one go.
        key, end = row << 32 | np.repeat(removed[:, 2], high), row << 32 | np.repeat(removed[:, 3], high)
        order = np.lexsort((-end, key))
        key, end = key[order], end[order]
        outer = np.append(True, end[1:] > np.maximum.accumulate(end)[:-1])[:len(key)]
        self.gap, self.gap_end = key[outer], end[outer]

    def _lay_out_labels(self) -> None:
        """Transition table over the labels' bytes, filled in by depth: a node's row is that of its longest proper suffix
        but for the bytes that go on to its own children."""
        child: dict[int, int] = {}
        above, byte, depth, label = [0], [0], [0], [-1]
        for text, token in self.labels.items():
            node = 0
            for b in text:
                to = child.get(node << 8 | b)
                if to is None:
                    to = child[node << 8 | b] = len(above)
                    above.append(node)
                    byte.append(b)
                    depth.append(depth[node] + 1)
                    label.append(-1)
                node = to
            label[node] = token
        above, byte, depth, self.longest = (np.array(x, dtype=np.int64) for x in (above, byte, depth, label))
        self.size = np.zeros(max(self.label) + 1, dtype=np.int64)
        self.size[list(self.labels.values())] = list(map(len, self.labels))
        self.shorter = np.full(max(self.label) + 1, -1, dtype=np.int64)
        inner = np.unique(above)        # a node without children goes on as its suffix does, and shares its row
        row = np.zeros(len(above), dtype=np.int64)
        row[inner] = np.arange(len(inner))
        leaf = np.ones(len(above), dtype=bool)
        leaf[inner] = False
        table = np.zeros((len(inner), 256), dtype=np.int32)
        suffix = np.zeros(len(above), dtype=np.int64)
        levels = [np.flatnonzero(depth == d) for d in range(int(depth.max()) + 2)]
        for nodes, children in zip(levels, levels[1:]):
            own = nodes[~leaf[nodes]]
            table[row[own]] = table[row[suffix[own]]]
            if nodes[0] != 0:
                suffix[children] = table[row[suffix[above[children]]], byte[children]]
            table[row[above[children]], byte[children]] = children
            ends = leaf[children]
            row[children[ends]] = row[suffix[children[ends]]]
            ends = self.longest[children] >= 0
            self.shorter[self.longest[children[ends]]] = self.longest[suffix[children[ends]]]
            self.longest[children[~ends]] = self.longest[suffix[children[~ends]]]
        self.table, self.row = table.reshape(-1), row << 8

    def has_arcs(self, states: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """Whether each state has an arc for the token beside it."""
        key = self.state_no[states] << 32 | self.token_no[tokens]
        slot = (key * 0x2545F4914F6CDD1D >> 40) & ((1 << SEEN_BITS) - 1)
        known = self.seen[slot]
        arc = (known & 1).astype(bool)
        new = np.flatnonzero(known >> 1 != key)
        if len(new):
            key = key[new]
            at = np.searchsorted(self.gap, key, side="right") - 1
            arc[new] = (at < 0) | (self.gap_end[at] <= key) if len(self.gap) else True
            self.seen[slot[new]] = key << 1 | arc[new]
        return arc

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each pre-split word, packed as unsigned 32-bit integers in native order."""
        if not words:
            return []
        length = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(-length, kind="stable")
        long = int((length > LONG_WORD).sum())
        out: list[bytes] = [b""] * len(words)
        for i in order[:long]:
            out[i] = array("I", self.encode(words[i])).tobytes()
        order = order[long:]
        if not len(order):
            return out
        length = length[order]
        data = np.frombuffer(b"".join([words[i] for i in order]), dtype=np.uint8)
        start = np.cumsum(length) - length
        token = np.zeros(len(data), dtype=np.int64)         # the token that ends at each byte
        node = np.zeros(len(order), dtype=np.int64)
        longer = len(order) - np.searchsorted(length[::-1], np.arange(int(length[0])), side="right")
        for place, n in enumerate(longer):
            at = start[:n] + place
            node = self.table[self.row[node[:n]] | data[at]]
            found = self.longest[node]
            while len(at):
                size = self.size[found]
                ok = size > place
                ok |= self.has_arcs(token[np.where(ok, at, at - size)], found)
                ok |= size > place
                token[at[ok]] = found[ok]
                rest = ~ok
                at, found = at[rest], self.shorter[found[rest]]
        path = np.zeros(len(data), dtype=bool)
        at, low = start + length - 1, start
        while len(at):
            path[at] = True
            at = at - self.size[token[at]]
            inside = at >= low
            at, low = at[inside], low[inside]
        ends = (np.cumsum(path)[start + length - 1] * 4).tolist()
        ids = token[path].astype(np.uint32).tobytes()
        begin = 0
        for i, end in zip(order.tolist(), ends):
            out[i] = ids[begin:end]
            begin = end
        return out

    def encode(self, word: bytes) -> list[int]:
        """Ids of one word, read by the same tables."""
        ending: list[int] = []
        node, known = 0, {}
        for place, byte in enumerate(word):
            node = int(self.table[self.row[node] | byte])
            token = int(self.longest[node])
            while (size := int(self.size[token])) <= place:
                key = (ending[place - size], token)
                ok = known.get(key)
                if ok is None:
                    ok = known[key] = bool(self.has_arcs(np.array(key[:1]), np.array(key[1:]))[0])
                if ok:
                    break
                token = int(self.shorter[token])
            ending.append(token)
        path, at = [], len(word)
        while at:
            path.append(ending[at - 1])
            at -= len(self.label[path[-1]])
        return path[::-1]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.label.__getitem__, ids))


class Encoder:
    """Texts to ids (packed as unsigned 32-bit integers, native order) and back.

    Splitting is the file's own: added tokens, then the byte-level pattern. Between two characters that are no white
    space, a lone space always begins a new word, so texts are cut there first and the pieces' ids are reused.
    """

    def __init__(self, content: str):
        spec = json.loads(content)
        self.content, self.symbols = content, byte_symbols()
        as_bytes = {t: bytes(map(self.symbols.__getitem__, t)) for t in spec["model"]["vocab"]}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.automaton = Automaton({as_bytes[t]: i for t, i in spec["model"]["vocab"].items()},
                                   [(as_bytes[a], as_bytes[b]) for a, b in merges])
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.automaton.label.update({i: t.encode() for t, i in self.added.items()})
        self.split_added = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) \
            if self.added else None
        self.words = regex.compile(PATTERN).findall
        self.long_space = regex.compile(r" \s|\s ").search
        self.unusual = regex.compile("[^\x00-\u0557]").findall
        self.word: dict[str, bytes] = {}        # ids of words, and of pieces at the beginning and after a space
        self.piece: dict[str, bytes] = {}
        self.spaced: dict[str, bytes] = {}

    @functools.cached_property
    def _library_split(self):
        from tokenizers import Tokenizer
        return Tokenizer.from_str(self.content).pre_tokenizer.pre_tokenize_str

    def _plain(self, text: str) -> list[tuple[dict | None, list]]:
        if not text.isascii() and any(unicodedata.category(c) == "Cn" for c in set(self.unusual(text))):
            # characters that this Python does not know may be letters of the library's Unicode version
            return [(self.word, [bytes(map(self.symbols.__getitem__, w)).decode() for w, _ in self._library_split(text)])]
        if self.long_space(text):
            return [(self.word, self.words(text))]
        first, *rest = text.split(" ")
        return [(self.piece, [first]), (self.spaced, rest)]

    def _parts(self, text: str) -> list[tuple[dict | None, list]]:
        """The text as pieces, each with the table that knows their ids; without one, they are ids."""
        if not self.split_added or not any(t in text for t in self.added):
            return self._plain(text)
        out, at = [], 0
        for m in self.split_added.finditer(text):
            out += [*self._plain(text[at:m.start()]), (None, [array("I", [self.added[m.group()]]).tobytes()])]
            at = m.end()
        return out + self._plain(text[at:])

    def _learn(self, parts: list[list[tuple[dict | None, list]]]) -> None:
        """Ids of all pieces not yet known: their words are cut out, and the new ones encoded at once."""
        words: set[str] = set()
        pieces: set[str] = set()
        spaced: set[str] = set()
        new = {id(self.word): words, id(self.piece): pieces, id(self.spaced): spaced}
        for of_text in parts:
            for known, items in of_text:
                if known is not None:
                    new[id(known)].update(items)
        whole: list[tuple[dict, str, str]] = []         # pieces of letters alone are one word
        cut: list[tuple[dict, str, list[str]]] = []
        for known, items, before in ((self.piece, pieces, ""), (self.spaced, spaced, " ")):
            for p in items.difference(known):
                if p.isalpha():
                    whole.append((known, p, before + p))
                else:
                    cut.append((known, p, self.words(before + p)))
                    words.update(cut[-1][2])
        unknown = list(words.difference(self.word))
        ids = self.automaton.encode_words([w.encode() for w in unknown] + [w.encode() for _, _, w in whole])
        self.word.update(zip(unknown, ids))
        for (known, p, _), found in zip(whole, ids[len(unknown):]):
            known[p] = found
        for known, p, ws in cut:
            known[p] = b"".join([self.word[w] for w in ws])

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        if max(map(len, (self.word, self.piece, self.spaced))) > CACHE_WORDS:
            self.forget()
        parts = list(map(self._parts, texts))
        self._learn(parts)
        return [b"".join([x for known, items in of_text for x in (map(known.__getitem__, items) if known is not None else items)])
                for of_text in parts]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def forget(self) -> None:
        """Drop the ids of the pieces seen; the automaton stays."""
        for known in (self.word, self.piece, self.spaced):
            known.clear()

    def decode(self, ids: bytes) -> str:
        return self.automaton.decode(memoryview(ids).cast("I")).decode("utf-8", errors="replace")


@functools.lru_cache(maxsize=2)
def encoder(content: str) -> Encoder:
    """Of the text of a tokenizer file; compiled once per Python worker."""
    return Encoder(content)


def _runs(texts: pa.Array) -> Iterator[list[str]]:
    """The texts (null: empty) in runs of about ``RUN_CHARS`` characters."""
    run, size = [], 0
    for text in texts:
        run.append(text.as_py() or "")
        size += len(run[-1])
        if size >= RUN_CHARS:
            yield run
            run, size = [], 0
    if run:
        yield run


def _little(ids: bytes) -> bytes:
    if sys.byteorder == "big":
        swapped = array("I", ids)
        swapped.byteswap()
        return swapped.tobytes()
    return ids


def encode_texts(documents: DataFrame, path: str, digests_only: bool = False, places: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids array<int>) of each row of ``documents``, in their order.

    ``path``: a byte-level BPE file that the driver can read; its text (a few MB) is broadcast to the workers. The ids are hashed as little-endian unsigned 32-bit
    integers, the decoded text as UTF-8, where they are made; ``digests_only`` leaves out the ids. ``places``: long columns that
    each row keeps, after the others.
    """
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
              ("decoded_sha256", pa.string())] + ([] if digests_only else [("ids", pa.list_(pa.int32()))])
    names = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    names = names + ("" if digests_only else ", ids array<int>") + "".join(f", {c} long" for c in places)
    schema = pa.schema(fields + [(c, pa.int64()) for c in places])

    with open(path, encoding="utf-8") as f:
        vocabulary = documents.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        enc = encoder(vocabulary.value)
        for batch in batches:
            rows, all_ids = [], []
            for ids in itertools.chain.from_iterable(map(enc.encode_all, _runs(batch.column("text")))):
                back = enc.decode(ids).encode("utf-8")
                rows.append((len(ids) // 4, hashlib.sha256(_little(ids)).hexdigest(), hashlib.sha256(back).hexdigest()))
                if not digests_only:
                    all_ids.append(ids)
            columns = [batch.column("doc_id"), *(pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(fields[1:4]))]
            if not digests_only:
                ends = np.cumsum([0, *(len(x) // 4 for x in all_ids)], dtype=np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(all_ids), np.int32))))
            columns += [batch.column(c) for c in places]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)
        enc.forget()        # the worker goes on to other tasks
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *places).mapInArrow(run, names)
