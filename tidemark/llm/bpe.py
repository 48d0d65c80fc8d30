"""Byte-pair encoding with a minimal acyclic transducer of frequent words, and decoding.

The rules come from a tokenizer file of the `tokenizers` library (a word-end BPE: NFC, lower case, a splitting pattern, byte letters).
Encoding a word takes many merges, and few words make up most of a corpus. So:

1. Words are counted over all documents, and the `LEXICON` most frequent ones are merged once, on the driver.
2. They are compiled into a minimal acyclic automaton: equal suffixes share their states. Each edge says how many words sort before
   it, so walking a word adds up to its number, and the number leads to its ids. The automaton is one flat buffer of a bounded size,
   which each task maps into memory from an unnamed file of its own.
3. All documents are encoded in one pass: words in the automaton take their ids from it, unseen words are merged by rank, exactly.
"""

from __future__ import annotations

import heapq
import json
import mmap
import os
import re
import tempfile
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from tidemark.llm import words as W
from tidemark.llm.frames import pick, share, tidied
from tidemark.scratch import materialize

#: Words in the lexicon; it takes some tens of bytes for each.
LEXICON = 1 << 16
#: Longest word of the lexicon, in bytes; longer ones are merged each time.
LONGEST = 64
#: White-space-free pieces whose ids a task keeps at hand; once it has so many, new ones are worked out each time.
PIECES = 1 << 19

_ODD = re.compile("[\x1c-\x1f]")  # white space to Python, none to Unicode
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_SPACES = re.compile(f"[{_SPACE}]+")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself where it prints, else the next free one from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(free)) for b in range(256)]


class Rules:
    """What a tokenizer file says, for files of the kind described above; others are refused."""

    def __init__(self, text: str):
        said = json.loads(text)
        model, parts = said["model"], said["pre_tokenizer"]["pretokenizers"]
        steps = [n["type"] for n in said["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or steps != ["NFC", "Replace", "Lowercase"] or [p["type"] for p in parts] != ["Split", "ByteLevel"] or said["decoder"] or said["post_processor"] or parts[1]["add_prefix_space"] or model["unk_token"] or model["byte_fallback"] or model["ignore_merges"] or model["dropout"]:
            raise ValueError("not a word-end BPE file of the known kind")
        self.suffix = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in said["added_tokens"]}
        named = {i: t for t, i in {**self.vocab, **self.special}.items()}
        self.tokens = [named.get(i) for i in range(max(named) + 1)]
        pairs = (p.split(" ") if isinstance(p, str) else p for p in model["merges"])
        self.merges: dict[int, int] = {}
        for rank, (a, b) in enumerate(pairs):
            self.merges[self.vocab[a] << 20 | self.vocab[b]] = rank << 20 | self.vocab[a + b]
        letters = byte_letters()
        self.inner = [self.vocab.get(x) for x in letters]
        self.last = [self.vocab.get(x + self.suffix) for x in letters]
        self.pattern = parts[0]["pattern"]["Regex"].replace("\\s", _SPACE)
        self.file = text

        # a byte without a letter in the vocabulary is dropped, which only the plain path does
        self.whole = None not in self.inner and None not in self.last

    def codec(self, lexicon: Lexicon | None = None) -> Codec:
        return Codec(self, lexicon)


_NONE = 1 << 62  # above any rank


def merge(symbols: list[int], merges: dict[int, int]) -> list[int]:
    """Join neighbours, always the pair of least rank and of those the leftmost, until none can be joined.

    `merges` leads from a pair, as first << 20 | second, to its rank and result, as rank << 20 | joined.
    """
    if len(symbols) > 64:
        return _merge_long(symbols, merges)
    get = merges.get
    ranks = [get(a << 20 | b, _NONE) for a, b in zip(symbols, symbols[1:], strict=False)]
    while ranks:
        best = min(ranks)
        if best == _NONE:
            break
        i = ranks.index(best)
        joined = symbols[i] = best & 0xFFFFF
        del symbols[i + 1], ranks[i]
        if i:
            ranks[i - 1] = get(symbols[i - 1] << 20 | joined, _NONE)
        if i < len(ranks):
            ranks[i] = get(joined << 20 | symbols[i + 1], _NONE)
    return symbols


def _merge_long(symbols: list[int], merges: dict[int, int]) -> list[int]:
    """The same with a heap and linked neighbours, for words of any length."""
    n = len(symbols)
    after, before = [*range(1, n), -1], [*range(-1, n - 1)]
    heap: list[tuple[int, int, int, int]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j >= 0 and (known := merges.get(symbols[i] << 20 | symbols[j])) is not None:
            heapq.heappush(heap, (known, i, symbols[i], symbols[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        known, i, a, b = heapq.heappop(heap)
        j = after[i] if symbols[i] == a else -1
        if j < 0 or symbols[j] != b:
            continue
        symbols[i], symbols[j] = known & 0xFFFFF, -1
        after[i] = after[j]
        if after[i] >= 0:
            before[after[i]] = i
        if before[i] >= 0:
            offer(before[i])
        offer(i)
    return [s for s in symbols if s >= 0]


class Merger:
    """Merges many words at once: a matrix with a word in each row, one merge in every row that has any at a time."""

    #: Words in a matrix.
    ROWS = 1 << 14

    def __init__(self, rules: Rules):
        keys = np.array(sorted(rules.merges), np.int64)
        self.keys, self.values = np.append(keys, _NONE), np.array([*(rules.merges[k] for k in keys.tolist()), _NONE], np.int64)
        self.inner, self.last = np.array(rules.inner, np.int64), np.array(rules.last, np.int64)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        pairs = a << 20 | b
        at = np.searchsorted(self.keys, pairs)
        return np.where((self.keys[at] == pairs) & (b >= 0), self.values[at], _NONE)

    def merge(self, words: list[bytes]) -> list[list[int]]:
        """The ids of each word, as `merge` gives them."""
        out: list[list[int]] = [[]] * len(words)
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        for begin in range(0, len(order), self.ROWS):
            part = order[begin : begin + self.ROWS]
            for i, ids in zip(part, self._merge([words[i] for i in part]), strict=True):
                out[i] = ids
        return out

    def _merge(self, words: list[bytes]) -> list[list[int]]:
        sizes = np.array([len(w) for w in words])
        places = np.arange(sizes.max())
        symbols = np.full((len(words), len(places) + 1), -1, np.int64)
        data = np.frombuffer(b"".join(words), np.uint8)
        symbols[:, :-1][places < sizes[:, None]] = self.inner[data]
        symbols[np.arange(len(words)), sizes - 1] = self.last[data[np.cumsum(sizes) - 1]]
        ranks = np.full(symbols.shape, _NONE, np.int64)
        ranks[:, :-1] = self.ranks(symbols[:, :-1], symbols[:, 1:])
        rows, done = np.arange(len(words)), np.empty_like(symbols)
        places = np.arange(symbols.shape[1])
        while True:
            at = ranks.argmin(1)
            best = ranks[np.arange(len(rows)), at]
            going = best != _NONE
            done[rows[~going], : symbols.shape[1]] = symbols[~going]
            if not going.any():
                break
            rows, symbols, ranks, at, best = rows[going], symbols[going], ranks[going], at[going], best[going]
            each = np.arange(len(rows))
            # what lies behind the pair moves up by one place
            symbols = np.take_along_axis(symbols, np.minimum(places + (places > at[:, None]), places[-1]), 1)
            ranks = np.take_along_axis(ranks, np.minimum(places + (places >= at[:, None]), places[-1]), 1)
            joined = symbols[each, at] = best & 0xFFFFF
            ranks[each, at] = self.ranks(joined, symbols[each, np.minimum(at + 1, places[-1])])
            left = at > 0
            ranks[each[left], at[left] - 1] = self.ranks(symbols[each[left], at[left] - 1], joined[left])
        counts = (done >= 0).sum(1).tolist()
        return [row[:n] for row, n in zip(done.tolist(), counts, strict=True)]


class Lexicon:
    """A minimal acyclic automaton over byte strings with an id list for each, read from one flat buffer."""

    def __init__(self, buffer):
        view = memoryview(buffer)
        states, edges, words, ids = (int(x) for x in np.frombuffer(view[:32], np.int64))
        at = 32
        parts = []
        for kind, n in (("i", states + 1), ("i", edges), ("i", edges), ("i", words + 1), ("i", ids)):
            parts.append(view[at : at + 4 * n].cast(kind))
            at += 4 * n
        self.first, self.target, self.skip, self.begin, self.ids = parts
        self.final = view[at : at + states]
        self.labels, self.at = buffer, at + states  # bytes and mmap both find a byte in a span
        self.edges: np.ndarray | None = None

    def find(self, word: bytes) -> int:
        """The word's number in byte order, or -1."""
        state, number, start = 0, 0, self.at
        labels, first, target, skip = self.labels, self.first, self.target, self.skip
        for i in range(len(word)):
            edge = labels.find(word[i : i + 1], start + first[state], start + first[state + 1])
            if edge < 0:
                return -1
            edge -= start
            number += skip[edge]
            state = target[edge]
        return number if self.final[state] else -1

    def find_all(self, words: list[bytes]) -> np.ndarray:
        """`find` for many words: all walk one edge at a time."""
        if self.edges is None:
            first = np.frombuffer(self.first, np.int32)
            labels = np.frombuffer(self.labels, np.uint8, len(self.target), self.at)
            self.edges = np.append(np.repeat(np.arange(len(first) - 1, dtype=np.int64), np.diff(first)) << 8 | labels, 1 << 62)
        target, skip = np.frombuffer(self.target, np.int32), np.frombuffer(self.skip, np.int32)
        sizes = np.array([len(w) for w in words], np.int64)
        data = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(sizes) - sizes
        number, states, going = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), np.arange(len(words))
        for i in range(int(sizes.max(initial=0))):
            going = going[sizes[going] > i]
            wanted = states[going] << 8 | data[starts[going] + i]
            at = np.searchsorted(self.edges, wanted)
            found = self.edges[at] == wanted
            number[going[~found]] = -1
            going, at = going[found], at[found]
            number[going] += skip[at]
            states[going] = target[at]
        ended = np.frombuffer(self.final, np.uint8)[states] > 0
        return np.where((number >= 0) & ended, number, -1)

    def get(self, word: bytes) -> list[int] | None:
        number = self.find(word)
        return None if number < 0 else self.ids[self.begin[number] : self.begin[number + 1]].tolist()


def compile_lexicon(entries: dict[bytes, list[int]]) -> bytes:
    """The buffer of a Lexicon. States are made in the order of the sorted words, and a state is replaced by an equal one as soon as no
    later word can change it, so the automaton is minimal at any time but for the last word's path."""
    known: dict[tuple, int] = {}
    edges: list[dict[int, int]] = [{}]
    final: list[bool] = [False]
    path: list[int] = [0]  # states along the last word

    def settle(down_to: int, word: bytes) -> None:
        while len(path) - 1 > down_to:
            state = path.pop()
            key = (final[state], *edges[state].items())
            same = known.setdefault(key, state)
            edges[path[-1]][word[len(path) - 1]] = same

    last, ordered = b"", sorted(entries)
    for word in ordered:
        shared = len(os.path.commonprefix([word, last]))
        settle(shared, last)
        for byte in word[shared:]:
            edges.append({})
            final.append(False)
            edges[path[-1]][byte] = len(edges) - 1
            path.append(len(edges) - 1)
        final[path[-1]] = True
        last = word
    settle(0, last)
    number: dict[int, int] = {}
    order: list[int] = []
    below: dict[int, int] = {}

    def count(state: int) -> int:
        if state not in below:
            below[state] = final[state] + sum(count(t) for t in edges[state].values())
        return below[state]

    number[0] = 0
    order.append(0)
    for state in order:  # grows as it is read
        for t in edges[state].values():
            if t not in number:
                number[t] = len(order)
                order.append(t)
    first, target, skip, labels = [0], [], [], bytearray()
    for state in order:
        ahead = int(final[state])
        for byte, t in edges[state].items():
            labels.append(byte)
            target.append(number[t])
            skip.append(ahead)
            ahead += count(t)
        first.append(len(target))
    ids = [entries[w] for w in ordered]
    begin = np.concatenate([[0], np.cumsum([len(x) for x in ids], dtype=np.int64)])
    flat = list(chain.from_iterable(ids))
    head = np.array([len(order), len(target), len(ordered), len(flat)], np.int64)
    numbers = np.concatenate([np.array(x, np.int32) for x in (first, target, skip, begin, flat)])
    return head.tobytes() + numbers.tobytes() + bytes(final[s] for s in order) + bytes(labels)


def map_lexicon(content: bytes) -> Lexicon:
    """Map the buffer from an unnamed file in the task's own temp folder. Nothing outlives the task and nothing is shared or renamed, so
    it works wherever a task lands and is made anew when an executor is lost."""
    with tempfile.TemporaryFile() as file:
        file.write(content)
        file.flush()
        return Lexicon(mmap.mmap(file.fileno(), len(content), access=mmap.ACCESS_READ))


class _Pieces(dict):
    """Ids of pieces, those seen first; a frequent one is among them."""

    def __init__(self, encode: Callable[[str], list[int]]):
        self.encode, self.waiting = encode, None

    def __missing__(self, piece: str) -> list[int]:
        if self.waiting is not None:
            ids = self[piece] = self.waiting[piece] = []
            return ids
        ids = self.encode(piece)
        if len(self) < PIECES and len(piece) <= LONGEST:
            self[piece] = ids
        return ids


class Codec:
    """Encodes and decodes texts. Nothing of it crosses white space, so texts are taken piece by piece."""

    def __init__(self, rules: Rules, lexicon: Lexicon | None = None):
        self.rules, self.lexicon = rules, lexicon
        self.words_of = regex.compile(rules.pattern).findall
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(rules.special, key=len, reverse=True))) + ")") if rules.special else None
        self.pieces = _Pieces(self.encode_piece)
        self.library = self.merger = None
        self.assigned: set[str] = set()  # characters that this Python's tables know

    def split(self, text: str) -> list[str]:
        return text.split() if not _ODD.search(text) else [p for p in _SPACES.split(text) if p]

    def words(self, piece: str) -> Iterator[bytes | int]:
        """The piece's words as UTF-8, and ids of special tokens between them."""
        for part in self.special.split(piece) if self.special and "<" in piece else (piece,):
            if part in self.rules.special:
                yield self.rules.special[part]
            elif part.isascii():
                for word in self.words_of(part.lower()):
                    yield word.encode()
            elif not self.assigned.issuperset(part) and not self._known(part):
                yield from self._newer(part)
            else:
                part = unicodedata.normalize("NFC", part)
                for word in self.words_of("".join(map(str.lower, part)) if "Σ" in part else part.lower()):
                    yield word.encode()

    def _known(self, part: str) -> bool:
        new = {c for c in part if unicodedata.category(c) != "Cn"}
        self.assigned |= new
        return new.issuperset(part)

    def _newer(self, part: str) -> list[bytes]:
        """Words with characters that this Python's tables do not know yet: their class is asked of the library."""
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_str(self.rules.file)
            self.bytes_of = {x: b for b, x in enumerate(byte_letters())}
        pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(part))
        return [bytes(self.bytes_of[c] for c in word) for word, _ in pieces]

    def encode_word(self, word: bytes) -> list[int]:
        ids = self.lexicon.get(word) if self.lexicon and len(word) <= LONGEST else None
        if ids is None:
            inner = self.rules.inner
            symbols = [*(inner[b] for b in word[:-1]), self.rules.last[word[-1]]]
            ids = merge([s for s in symbols if s is not None], self.rules.merges)
        return ids

    def encode_piece(self, piece: str) -> list[int]:
        if piece.isascii():  # most pieces are a word, or a word and one sign
            if piece.isalpha():
                return self.encode_word(piece.lower().encode())
            if piece[:-1].isalpha() and piece[-1] in ",.;:!?":
                return [*self.encode_word(piece[:-1].lower().encode()), *self.encode_word(piece[-1].encode())]
        out: list[int] = []
        for word in self.words(piece):
            if isinstance(word, int):
                out.append(word)
            else:
                out.extend(self.encode_word(word))
        return out

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """`encode` for many texts: pieces that are not at hand get an empty list each, and when all texts have been cut these are filled, with
        the words looked up and merged together."""
        self.pieces.waiting = waiting = {} if self.rules.whole else None
        found = [list(map(self.pieces.__getitem__, self.split(t))) for t in texts]
        self.pieces.waiting = None
        if waiting:
            self._learn(waiting)
        out = [np.fromiter(chain.from_iterable(lists), np.int32) for lists in found]
        over = len(self.pieces) > PIECES
        for piece in waiting or ():
            if over or len(piece) > LONGEST:
                del self.pieces[piece]
        return out

    def _learn(self, new: dict[str, list[int]]) -> None:
        if self.merger is None:
            self.merger, self.same = Merger(self.rules), list(range(len(self.rules.tokens)))
        parts = [list(self.words(piece)) for piece in new]
        words = list({w for part in parts for w in part if not isinstance(w, int) and len(w) <= LONGEST})
        numbers = self.lexicon.find_all(words) if self.lexicon and words else np.full(len(words), -1)
        known: dict[bytes | int, list[int]] = {}
        same = self.same.__getitem__  # one object per id, however many pieces hold it
        for at in np.flatnonzero(numbers >= 0).tolist():
            number = int(numbers[at])
            known[words[at]] = list(map(same, self.lexicon.ids[self.lexicon.begin[number] : self.lexicon.begin[number + 1]]))
        unseen = [words[i] for i in np.flatnonzero(numbers < 0).tolist()]
        for word, ids in zip(unseen, self.merger.merge(unseen), strict=True):
            known[word] = list(map(same, ids))
        for into, part in zip(new.values(), parts, strict=True):
            for w in part:
                if isinstance(w, int):
                    into.append(w)
                else:
                    into.extend(known[w] if w in known else self.encode_word(w))

    def encode(self, text: str) -> np.ndarray:
        return np.fromiter(chain.from_iterable(map(self.pieces.__getitem__, self.split(text))), np.int32)

    def decode(self, ids: Iterable[int]) -> str:
        """The tokens joined by spaces, which is what the library does for a file without a decoder; unknown ids are left out."""
        tokens = self.rules.tokens
        try:
            return " ".join([tokens[i] for i in ids])
        except (IndexError, TypeError):
            return " ".join([tokens[i] for i in ids if 0 <= i < len(tokens) and tokens[i] is not None])


def word_counts(documents: DataFrame, text: str, rules: Rules) -> DataFrame:
    """word (UTF-8) and n, its number of occurrences in all documents."""
    shared = share(documents.sparkSession, rules)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared().codec()
        pieces: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out: Counter[bytes] = Counter()
            for piece, n in pieces.items():
                for word in codec.words(piece):
                    if isinstance(word, bytes) and len(word) <= LONGEST:
                        out[word] += n
            pieces.clear()
            return pa.RecordBatch.from_arrays([pa.array(out.keys(), pa.binary()), pa.array(out.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            for value in batch.column(0):
                pieces.update(codec.split(value.as_py() or ""))
                if len(pieces) >= PIECES:
                    yield flush()
        yield flush()

    rows = pick(documents, text=text).mapInArrow(tidied(count), "word binary, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(documents: DataFrame, text: str, rules: Rules, size: int = LEXICON) -> bytes:
    """The compiled lexicon of the `size` most frequent words, ties by byte order. Only these words come to the driver.

    Counts fall into some thousand levels; the rows of each level say from which one on words can be among the first, so only
    those are sorted, not `size` words of every partition.
    """
    codec = rules.codec()
    level = F.when(F.col("n") < 4096, F.col("n")).otherwise(F.floor(F.log2("n") * 512 - 2048)).alias("level")
    counted = materialize(word_counts(documents, text, rules).select("word", "n", level), "word-counts")
    least, held = 0, 0
    for row in counted.groupBy("level").count().orderBy(F.desc("level")).collect():
        least, held = row["level"], held + row["count"]
        if held >= size:
            break
    rows = counted.where(F.col("level") >= least).orderBy(F.desc("n"), "word").limit(size).select("word").collect()
    return compile_lexicon({bytes(r["word"]): codec.encode_word(bytes(r["word"])) for r in rows})


def encode(documents: DataFrame, lexicon: bytes, rules: Rules, text: str = "text", decoded: bool = False) -> DataFrame:
    """Every row of documents as doc (a struct of its columns, so no name clashes) with ids, a list of ints, and on demand decoded, the
    text that decoding these ids gives. Null and empty texts have no ids and decode to the empty text."""
    shared = share(documents.sparkSession, (rules, lexicon))
    rows = documents.select(F.struct(*(f"`{c}`" for c in documents.columns)).alias("doc"), F.col(f"`{text}`").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, content = shared()
        codec = own.codec(map_lexicon(content))
        for batch in batches:
            column = batch.column(1)
            for row, end, _, _ in W.slices(column, W.SLICE_BYTES // 2):
                found = codec.encode_all([x or "" for x in column.slice(row, end - row).to_pylist()])
                out = [batch.column(0).slice(row, end - row), W.lists(np.concatenate(found), np.array([len(x) for x in found]))]
                if decoded:
                    out.append(pa.array([codec.decode(x.tolist()) for x in found], pa.string()))
                yield pa.RecordBatch.from_arrays(out, names=["doc", "ids", "decoded"][: len(out)])

    kind = f"doc {rows.schema['doc'].dataType.simpleString()}, ids array<int>" + (", decoded string" if decoded else "")
    return rows.mapInArrow(tidied(work), kind)


def decode(encoded: DataFrame, rules: Rules, ids: str = "ids") -> DataFrame:
    """Every row as doc (a struct of its columns) with decoded; a null list decodes to the empty text."""
    shared = share(encoded.sparkSession, rules)
    rows = encoded.select(F.struct(*(f"`{c}`" for c in encoded.columns)).alias("doc"), F.col(f"`{ids}`").alias("ids"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared().codec()
        for batch in batches:
            texts = [codec.decode(x.as_py() or ()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc", "decoded"])

    return rows.mapInArrow(work, f"doc {rows.schema['doc'].dataType.simpleString()}, decoded string")


def read_rules(path: str) -> Rules:
    """The tokenizer file, read on the driver; its content goes to the tasks."""
    with open(path, encoding="utf-8") as file:
        return Rules(file.read())
