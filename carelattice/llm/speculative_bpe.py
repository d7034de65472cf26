"""Byte-pair encoding of whole texts by speculation and verification, and decoding.

Merging pairs in rank order is what defines an encoding; it is only run where it is needed. Per batch, all distinct words
not met before are encoded together:

1. Propose: the longest token at every byte of all words is found by walking a trie over arrays, and each word is cut
   greedily from the left. The trie holds the tokens whose own encoding is the token itself, as others never appear.
2. Verify: a cut is the encoding of a word if and only if no merge ever joins two neighbouring tokens. For a pair (a, b) that
   is decided on the right edge of a's merge tree and the left edge of b's: both are undone step by step, the later merge
   first, and at each state a merge across the border must not come before the merges that use up its two sides (of equal
   ranks the left place merges first). All distinct pairs are walked at once, as array operations.
3. Correct: words with an incompatible pair, and only these, are merged exactly, all of them at once: each pass finds every word's
   pair of the lowest rank and merges it wherever it stands. Very long words go one by one through a heap, in n log n.

Texts are normalised and split as the vocabulary's file says: NFC, lower case, words by a fixed pattern, special tokens taken
out of the raw text first. Characters outside long-settled Unicode blocks, where libraries of different Unicode versions
differ, send the text to the library's own normaliser and splitter. Nothing is shuffled; what tasks share is the vocabulary.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Words of the vocabulary's splitter; a fixed value of its file.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Blocks without characters added or changed by recent Unicode versions: Latin to Cyrillic, Latin additions and Greek extended,
#: punctuation, kana, CJK, Hangul, common emoji.
SETTLED = (
    "[\\x00-\\u036f\\u0370-\\u0377\\u037a-\\u037f\\u0384-\\u038a\\u038c\\u038e-\\u03a1\\u03a3-\\u03ff\\u0400-\\u0527\\u1e00-\\u1eff\\u2010-\\u2027\\u2030-\\u205e\\u20a0-\\u20ac"
    "\\u2190-\\u21ff\\u3000-\\u3030\\u3041-\\u3096\\u30a1-\\u30fa\\u4e00-\\u9fa5\\uac00-\\ud7a3\\U0001f300-\\U0001f320\\U0001f600-\\U0001f64f]*"
)
END = "</w>"
SLICE = 512
#: Words a task remembers before it starts anew, and the length from which a word is not remembered.
REMEMBERED, LONG = 250_000, 64
NEVER = 1 << 40
#: Bytes of a word from which it is merged by a heap.
HEAP = 512


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where it is printable, else the next free one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, free = [], 256
    for b in range(256):
        out.append(chr(b if b in plain else free))
        free += b not in plain
    return out


@dataclass(frozen=True)
class Bpe:
    """Tables of a vocabulary; small, of a size fixed by the vocabulary, and shared by all tasks.

    Token t is made by merging ``left[t]`` and ``right[t]`` at ``rank[t]`` (-1: a single byte). ``pairs`` are the merges as
    sorted left << 32 | right, ``made`` their tokens. ``edges`` are the trie's sorted node * symbols + symbol, ``nodes`` where
    they lead, ``token`` the token that ends at a node or -1.
    """

    path: str
    specials: dict[str, int]
    start: np.ndarray
    end: np.ndarray
    left: np.ndarray
    right: np.ndarray
    rank: np.ndarray
    pairs: np.ndarray
    made: np.ndarray
    edges: np.ndarray
    nodes: np.ndarray
    token: np.ndarray
    letters: tuple[bytes, ...]

    @classmethod
    def load(cls, path: str) -> Bpe:
        with open(path, encoding="utf-8") as f:
            whole = json.load(f)
        model, kinds = whole["model"], [n["type"] for n in whole["normalizer"]["normalizers"]]
        split, level = whole["pre_tokenizer"]["pretokenizers"]
        unlike = [model["type"] != "BPE", model["end_of_word_suffix"] != END, model["dropout"], model["unk_token"], model["continuing_subword_prefix"], model.get("byte_fallback"), model.get("ignore_merges")]
        unlike += [kinds != ["NFC", "Replace", "Lowercase"], split["pattern"] != {"Regex": WORDS}, level["type"] != "ByteLevel", level["add_prefix_space"], level["use_regex"], whole["decoder"]]
        unlike += [a["normalized"] or a["lstrip"] or a["rstrip"] or a["single_word"] for a in whole["added_tokens"]]
        if any(unlike):
            raise ValueError("expected byte-level BPE with word ends, NFC and lower case")
        vocab, letters = model["vocab"], byte_letters()
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        specials = {a["content"]: a["id"] for a in whole["added_tokens"]}
        n = 1 + max(*vocab.values(), *specials.values())
        left, right, rank = (np.full(n, -1, np.int64) for _ in range(3))
        for k, (a, b) in enumerate(merges):
            t = vocab[a + b]
            if rank[t] >= 0:
                raise ValueError("a token with two merges")
            left[t], right[t], rank[t] = vocab[a], vocab[b], k
            if max(rank[left[t]], rank[right[t]]) >= k:
                raise ValueError("a merge of tokens that are made later")
        made = np.flatnonzero(rank >= 0)
        pairs = left[made] << 32 | right[made]
        order = np.argsort(pairs)
        texts = [b""] * n
        for t, i in (vocab | specials).items():
            texts[i] = t.encode()
        start, end = (np.array([vocab[x + tail] for x in letters], np.int64) for tail in ("", END))
        table = dict(zip(pairs[order].tolist(), made[order].tolist(), strict=True))
        edges, token = _trie([*start.tolist(), *end.tolist(), *made[np.argsort(rank[made])].tolist()], left, right, rank, table, n)
        keys = np.array(sorted(edges), np.int64)
        return cls(path, specials, start, end, left, right, rank, pairs[order], made[order], keys, np.array([edges[k] for k in keys.tolist()], np.int64), token, tuple(texts))

    @property
    def size(self) -> int:
        return len(self.rank)

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair; NEVER where there is none."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.rank[self.made[at]], NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether no merge crosses the border between token a and token b."""
        good = np.ones(len(a), bool)
        todo = np.arange(len(a))
        x, y = a.copy(), b.copy()
        until_x, until_y = np.full(len(a), NEVER), np.full(len(a), NEVER)  # ranks at which x and y are used up
        while len(todo):
            m = self.merged(x, y)
            crossed = (m < NEVER) & (m < until_x) & (m <= until_y)
            good[todo[crossed]] = False
            rx, ry = self.rank[x], self.rank[y]
            go = ~crossed & ((rx >= 0) | (ry >= 0))
            todo, x, y, until_x, until_y, rx, ry = (v[go] for v in (todo, x, y, until_x, until_y, rx, ry))
            undo_x = rx > ry  # the later merge; of one rank the right one, as the left place merged first
            until_x, until_y = np.where(undo_x, rx, until_x), np.where(undo_x, until_y, ry)
            x, y = np.where(undo_x, self.right[x], x), np.where(undo_x, y, self.left[y])
        return good

    def symbols(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Single-byte tokens of non-empty words, and where each word begins (with the end of the last)."""
        begins = np.cumsum([0, *map(len, words)])
        flat = np.frombuffer(b"".join(words), np.uint8)
        out = self.start[flat]
        last = begins[1:] - 1
        out[last] = self.end[flat[last]]
        return out, begins

    def longest(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Longest token that starts at each place, and its number of symbols."""
        best, length = symbols.copy(), np.ones(len(symbols), np.int64)
        place, node, depth = np.arange(len(symbols)), np.zeros(len(symbols), np.int64), 0
        while len(place):
            key = node * self.size + symbols[place + depth]
            at = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
            there = self.edges[at] == key
            place, node = place[there], self.nodes[at[there]]
            depth += 1
            found = self.token[node]
            ends = found >= 0
            best[place[ends]], length[place[ends]] = found[ends], depth
            inside = place + depth < len(symbols)
            place, node = place[inside], node[inside]
        return best, length

    def propose(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Greedy tokens of all words one after the other, and the word each belongs to."""
        symbols, begins = self.symbols(words)
        best, length = self.longest(symbols)
        step = (np.arange(len(symbols)) + length).tolist()
        taken, at, n = [], 0, len(symbols)
        while at < n:  # no token crosses the end of a word: word ends are symbols of their own
            taken.append(at)
            at = step[at]
        taken = np.array(taken, np.int64)
        return best[taken], np.searchsorted(begins, taken, side="right") - 1

    def exact(self, word: bytes) -> list[int]:
        """Tokens of a word by merging the pair of the lowest rank, the leftmost of equals, until none is left."""
        return merge(self.symbols([word])[0].tolist(), self.table)

    def encode_all(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, int]:
        """Tokens of non-empty words one after the other, where each word ends, and how many had to be merged exactly."""
        if not words:
            return np.empty(0, np.int64), np.empty(0, np.int64), 0
        tokens, owner = self.propose(words)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        pair, back = np.unique(tokens[inner] << 32 | tokens[inner + 1], return_inverse=True)
        good = self.compatible(pair >> 32, pair & 0xFFFFFFFF)
        failing = np.unique(owner[inner[~good[back]]])
        fine = ~np.isin(owner, failing)
        parts = [(owner[fine], tokens[fine])]
        long = np.array([len(words[k]) >= HEAP for k in failing.tolist()], bool)
        short = failing[~long]
        own, found = self.merge_all([words[k] for k in short.tolist()])
        parts.append((short[own], found))
        for k in failing[long].tolist():
            found = np.array(self.exact(words[k]), np.int64)
            parts.append((np.full(len(found), k), found))
        owner, tokens = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(owner, kind="stable")
        return tokens[order], np.searchsorted(owner[order], np.arange(len(words)), side="right"), len(failing)

    def encode_words(self, words: list[bytes]) -> tuple[list[np.ndarray], int]:
        """Tokens of each word, and how many words had to be merged exactly."""
        tokens, ends, failing = self.encode_all(words)
        return np.split(tokens, ends[:-1]) if words else [], failing

    def merge_all(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(word, token) of words by exact merging, in order of each word. No merge makes a pair of a lower rank, as parts are made before the whole, so a
        word's best pair may be merged at all its places in one pass, from the left where places overlap."""
        if not words:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        tokens, begins = self.symbols(words)
        owner = np.repeat(np.arange(len(words)), np.diff(begins))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(tokens):
            rank = np.full(len(tokens), NEVER)
            same = np.flatnonzero(owner[1:] == owner[:-1])
            rank[same] = self.merged(tokens[same], tokens[same + 1])
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            best = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(tokens))))
            done.append((owner[best == NEVER], tokens[best == NEVER]))
            hit = np.flatnonzero((rank == best) & (best < NEVER))
            run = np.concatenate([[True], hit[1:] != hit[:-1] + 1]) if len(hit) else np.empty(0, bool)
            at = np.arange(len(hit))
            hit = hit[(at - np.maximum.accumulate(np.where(run, at, 0))) % 2 == 0]  # every other of places that overlap
            tokens[hit] = self.of_rank[rank[hit]]
            keep = best < NEVER
            keep[hit + 1] = False
            tokens, owner = tokens[keep], owner[keep]
        owner, tokens = (np.concatenate(x) for x in zip(*done, strict=True))
        return owner, tokens

    @cached_property
    def table(self) -> dict[int, tuple[int, int]]:
        """The merges as a dictionary."""
        return {p: (r, m) for p, r, m in zip(self.pairs.tolist(), self.rank[self.made].tolist(), self.made.tolist(), strict=True)}

    @cached_property
    def of_rank(self) -> np.ndarray:
        """The token that the merge of each rank makes."""
        return self.made[np.argsort(self.rank[self.made])]


def _trie(order: list[int], left: np.ndarray, right: np.ndarray, rank: np.ndarray, table: dict[int, int], n: int) -> tuple[dict[int, int], np.ndarray]:
    """Trie over the symbols of the tokens in ``order`` (parts first) that encode to themselves."""
    symbols: dict[int, tuple[int, ...]] = {}
    edges, token = {}, [-1]
    ranked = {key: (int(rank[t]), t) for key, t in table.items()}
    for t in order:
        symbols[t] = own = (t,) if rank[t] < 0 else symbols[int(left[t])] + symbols[int(right[t])]
        if merge(list(own), ranked) != [t]:
            continue
        node = 0
        for s in own:
            key = node * n + s
            if key not in edges:
                edges[key] = len(token)
                token.append(-1)
            node = edges[key]
        token[node] = t
    return edges, np.array(token, np.int64)


def merge(tokens: list[int], table: dict[int, tuple[int, int]]) -> list[int]:
    """Exact merging; ``table``: left << 32 | right to (rank, token)."""
    after, before, heap = [*range(1, len(tokens)), -1], [*range(-1, len(tokens) - 1)], []

    def offer(i: int) -> None:
        found = table.get(tokens[i] << 32 | tokens[after[i]])
        if found:
            heapq.heappush(heap, (found[0], i, found[1], tokens[i], tokens[after[i]]))

    for i in range(len(tokens) - 1):
        offer(i)
    while heap:
        _, i, made, a, b = heapq.heappop(heap)
        j = after[i]
        if tokens[i] != a or j < 0 or tokens[j] != b:
            continue  # one of them was merged meanwhile
        tokens[i], tokens[j] = made, -1
        after[i] = k = after[j]
        if k >= 0:
            before[k] = i
            offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [t for t in tokens if t >= 0]


class Splitter:
    """Words of a text, with special tokens as numbers."""

    def __init__(self, bpe: Bpe) -> None:
        self.bpe = bpe
        self.words = regex.compile(WORDS).findall
        self.settled = regex.compile(SETTLED).fullmatch
        self.special = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(bpe.specials, key=len, reverse=True)) + ")") if bpe.specials else None
        self.marks = {s[:2] for s in bpe.specials}
        self.library = None

    def of(self, text: str) -> list[str | int]:
        if self.special is None or not any(m in text for m in self.marks):
            return self.plain(text)
        out: list[str | int] = []
        for k, part in enumerate(self.special.split(text)):
            out += [self.bpe.specials[part]] if k % 2 else self.plain(part)
        return out

    def plain(self, text: str) -> list[str]:
        if text.isascii():
            return self.words(text.lower())
        if self.settled(text):  # lower case letter by letter: no final sigma
            return self.words(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.bpe.path)
            self.bytes_of = {ord(x): b for b, x in enumerate(byte_letters())}
        split = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [w.translate(self.bytes_of).encode("latin-1").decode("utf-8", "surrogateescape") for w, _ in split]


def public_bpe(path: str | None = None) -> Bpe:
    """Tables of the vocabulary at ``path``, or of the installed public one."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    return Bpe.load(str(path))


def _schema(df: DataFrame, names: list[str]) -> str:
    return ", ".join(f"`{c.replace('`', '``')}` {df.schema[c].dataType.simpleString()}" for c in names)


def _unused(names: list[str]) -> str:
    return max([*names, ""], key=len) + "_"


def encode(docs: DataFrame, bpe: Bpe, text: str = "text", ids: str = "token_ids", packed: bool = False, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``ids``: array<int>, or with ``packed`` little-endian unsigned 32-bit integers in a binary.

    Null, empty and blank texts have no ids. A text is encoded whole, whatever its length; rows that repeat stay. ``keep`` names
    the columns that stay (all others do by default); a column named ``ids`` is replaced. An empty table gives no rows.
    """
    names = [c for c in (docs.columns if keep is None else keep) if c != ids]
    plain = docs.select(*[f"`{c}`" for c in names], docs[f"`{text}`"].alias(_unused(names)))
    shared = docs.sparkSession.sparkContext.broadcast(bpe)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = shared.value
        splitter = Splitter(tables)
        known: dict[str | int, bytes] = {}
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                split = [splitter.of(t) if t else [] for t in batch.column(len(names)).to_pylist()]
                if len(known) > REMEMBERED:
                    known.clear()
                known |= {i: np.array([i], "<u4").tobytes() for i in tables.specials.values()}
                new = list({w for words in split for w in words}.difference(known))
                tokens, ends, _ = tables.encode_all([w.encode("utf-8", "surrogateescape") for w in new])
                found, ends = tokens.astype("<u4").tobytes(), (4 * ends).tolist()
                known |= {w: found[begin:end] for w, begin, end in zip(new, [0, *ends], ends, strict=False)}
                blobs = [b"".join(map(known.__getitem__, words)) for words in split]
                for w in new:
                    if len(w) > LONG:
                        del known[w]
                if packed:
                    coded = pa.array(blobs, pa.binary())
                else:
                    ends = np.cumsum([0, *(len(b) // 4 for b in blobs)]).astype(np.int32)
                    coded = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(blobs), "<i4")))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], coded], names=[*names, ids])

    kind = f"`{ids}` " + ("binary" if packed else "array<int>")
    return plain.mapInArrow(run, ", ".join(filter(None, [_schema(docs, names), kind])))


def joined(ids: np.ndarray, ends: np.ndarray, letters: tuple[bytes, ...]) -> list[bytes]:
    """Tokens of each of several id sequences with blanks between, all at once; ids without a token are left out."""
    data = np.frombuffer(b"".join(letters), np.uint8)
    begin = np.cumsum([0, *map(len, letters)])
    fits = (ids >= 0) & (ids < len(letters))
    size = np.where(fits, begin[np.where(fits, ids, 0) + 1] - begin[np.where(fits, ids, 0)], 0)
    fits &= size > 0
    wide = np.where(fits, size + 1, 0)
    stop = np.cumsum(wide)
    origin = np.repeat(begin[np.where(fits, ids, 0)] - (stop - wide), wide)
    at = origin + np.arange(len(origin))
    out = data[np.minimum(at, len(data) - 1)]
    out[stop[fits] - 1] = 32
    edge = np.concatenate([[0], stop])[ends]
    blob = out.tobytes()
    return [blob[a : b - 1] if b > a else b"" for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]


def decode(rows: DataFrame, bpe: Bpe, ids: str = "token_ids", text: str = "decoded", keep: list[str] | None = None) -> DataFrame:
    """``rows`` with ``text``: the tokens of ``ids`` (array<int> or packed) with blanks between, special ones included.

    That is what the library's decode gives for this file, which names no decoder: letters stand for bytes and words keep their
    end mark. Null ids give null; numbers without a token are left out.
    """
    packed = rows.schema[ids].dataType.simpleString() == "binary"
    names = [c for c in (rows.columns if keep is None else keep) if c != text]
    plain = rows.select(*[f"`{c}`" for c in names], rows[f"`{ids}`"].alias(_unused(names)))
    letters = bpe.letters

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                own = batch.column(len(names)).to_pylist() if packed else [None if x.as_py() is None else np.array([-1 if i is None else i for i in x.as_py()], "<i4").tobytes() for x in batch.column(len(names))]
                flat = np.frombuffer(b"".join([x or b"" for x in own]), "<u4" if packed else "<i4").astype(np.int64)
                ends = np.cumsum([0, *(len(x or b"") // 4 for x in own)])
                texts = [None if x is None else t.decode() for x, t in zip(own, joined(flat, ends, letters), strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=[*names, text])

    return plain.mapInArrow(run, ", ".join(filter(None, [_schema(rows, names), f"`{text}` string"])))


def read_text(ids: list[int], bpe: Bpe) -> str:
    """Text that a sequence of ids stands for: bytes of the letters, a blank at each word end (normalised, lower case)."""
    back = {x: bytes([b]) for b, x in enumerate(byte_letters())}
    out = []
    for i in ids:
        token = bpe.letters[i].decode()
        if token in bpe.specials:
            out.append(token.encode())
            continue
        ends = token.endswith(END)
        out += [back[c] for c in (token[: -len(END)] if ends else token)] + [b" "] * ends
    return b"".join(out).decode("utf-8", "replace").rstrip(" ")
