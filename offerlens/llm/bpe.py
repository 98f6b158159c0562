"""Byte-level BPE by depth-first propagation through a trie of distinct words.

Every prefix of a word has one encoding, and its last token is all that longer prefixes need:
``t`` ends the encoding of a prefix if ``t`` is a suffix of it and the encoding of what comes
before ends with a token that may stand next to ``t``, that is, merging the bytes of the two
gives the two back. Exactly one token does. The distinct words of a batch are put in a trie, and
a depth-first walk hands every node's last token down to its children, so that a prefix which
many words share is encoded once. A word's encoding is read off the path, back from its node.

Texts are never cut, and no rows move: each task encodes the texts it reads. What a task keeps
between batches is a table of words and one of token pairs, cleared when they reach a documented
size, which changes no result.

Defined results: a missing or empty text has no tokens and decodes to an empty text; equal texts
have equal encodings, wherever they stand; an empty table gives an empty table; other columns,
whatever their names, stay out unless named in ``keep``. Strings of special tokens in a text are
their special tokens, as in the library. Texts are read as UTF-8 with replacement characters in
place of what is not.
"""

import gc
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import cache, lru_cache
from itertools import chain, groupby
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Vocabulary, merges and special tokens; readable by every executor, never part of this repository.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: Fixed value: how a text is split before merging, with the classes of letters and of numbers.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?{L}+| ?{N}+| ?[^\s{l}{n}]+|\s+(?!\S)|\s+"
#: The letters, numbers and white space up to U+024F, for the standard library's patterns.
EARLY = "\x00-\u024f"
EARLY_LETTERS, EARLY_NUMBERS, EARLY_SPACE = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾", r"\t-\r \x85\xa0"
#: Words, and pairs of tokens, whose encodings or verdicts a task remembers; of words it holds two
#: such tables, the later one with what was met since the earlier one was full.
REMEMBERED = 200_000


class Node:
    """A trie node: the bytes that lead to it, what follows by first byte, and whether a word ends."""

    __slots__ = ("label", "children", "ends")

    def __init__(self, label: bytes, ends: bool):
        self.label, self.children, self.ends = label, {}, ends


def build_trie(words: list[bytes]) -> Node:
    """A trie whose chains of single children are one node each."""
    root = Node(b"", False)
    for word in words:
        node, at = root, 0
        while at < len(word):
            child = node.children.get(word[at])
            if child is None:
                node.children[word[at]] = Node(word[at:], True)
                break
            if word.startswith(child.label, at):
                node, at = child, at + len(child.label)
                continue
            label, shared, most = child.label, 1, len(word) - at
            while shared < most and label[shared] == word[at + shared]:
                shared += 1
            middle = Node(label[:shared], False)
            child.label = label[shared:]
            middle.children[label[shared]] = child
            node.children[word[at]] = middle
            node, at = middle, at + shared
        else:
            node.ends = True
    return root


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in the vocabulary: printable ones for themselves, others from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def _splitters():
    """(pattern for common texts, pattern for texts with recent characters, pattern that finds those).

    Unicode grows, and the two libraries know different versions. Characters that the
    standard library does not know yet are letters or numbers if the tokenizers library
    says so.
    """
    import regex
    from tokenizers import pre_tokenizers

    plain = regex.compile(SPLIT.format(L=r"\p{L}", N=r"\p{N}", l=r"\p{L}", n=r"\p{N}"))
    recent = [chr(c) for c in range(0x110000) if unicodedata.category(chr(c)) == "Cn"]
    recent = regex.findall(r"[\p{L}\p{N}]", "".join(recent))
    library = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)

    def joined(before: str) -> set[str]:
        """Recent characters that the library joins with ``before``."""
        spans = {span[0] for _, span in library.pre_tokenize_str("".join(before + c + "\n" for c in recent))}
        return {c for i, c in enumerate(recent) if 3 * i + 1 not in spans}

    def ranges(chars) -> str:
        codes = enumerate(sorted(map(ord, chars)))
        runs = [[c for _, c in run] for _, run in groupby(codes, lambda x: x[1] - x[0])]
        return "".join(f"\\U{run[0]:08x}-\\U{run[-1]:08x}" for run in runs)

    if not recent:
        return plain, plain, re.compile(r"(?!)")
    letters, numbers = joined("a"), joined("1")
    known = f"[{ranges(recent)}]"

    def kind(name: str, more: set[str]) -> str:
        return rf"(?:(?!{known})\p{{{name}}}" + (f"|[{ranges(more)}])" if more else ")")

    letter, number = kind("L", letters), kind("N", numbers)
    other = rf"(?:(?!{letter}|{number})\S)"
    careful = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?{letter}+| ?{number}+| ?{other}+|\s+(?!\S)|\s+")
    return plain, careful, re.compile(known)


def _read(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


@cache
def spellings(path: str) -> dict[int, bytes]:
    """The bytes of every token, read once per process."""
    whole, letters = _read(path), _byte_letters()
    special = {t["id"]: t["content"].encode() for t in whole["added_tokens"]}
    return {i: bytes(map(letters.__getitem__, t)) for t, i in whole["model"]["vocab"].items()} | special


class Vocabulary:
    """Tokens, merges and the rule for neighbours, with the words that were met lately."""

    def __init__(self, path: str):
        whole = _read(path)
        self.special = {t["content"]: t["id"] for t in whole["added_tokens"]}
        self.bytes_of = spellings(path)
        spelled = {t: i for i, t in self.bytes_of.items() if i not in self.special.values()}
        self.ids = spelled
        vocab = whole["model"]["vocab"]
        self.ranks: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, (left, right) in enumerate(whole["model"]["merges"]):
            a, b = vocab[left], vocab[right]
            self.ranks[a, b] = rank
            self.parts[vocab[left + right]] = (rank, a, b)
        self.length_of = {i: len(t) for i, t in self.bytes_of.items()}
        # What may end a prefix, by the prefix's last four bytes: lengths above four, the longest
        # first, and the tokens of up to four bytes. Other ends have short tokens only.
        long: dict[bytes, set[int]] = {}
        for token in spelled:
            if len(token) >= 4:
                long.setdefault(token[-4:], set()).add(len(token))
        self.ends = {end: (sorted(found - {4}, reverse=True), self._short(end)) for end, found in long.items()}
        self.plain, self.careful, self.recent = _splitters()
        letter, number, space = EARLY_LETTERS, EARLY_NUMBERS, EARLY_SPACE
        self.early = re.compile(
            rf" ?[{letter}]+|'(?:[stmd]|re|ve|ll)| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+"
        )
        self.late = re.compile(f"[^{EARLY}]")
        self.specials = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.neighbours: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}
        self.earlier: dict[str, bytes] = {}
        self.short = lru_cache(1 << 16)(self._short)
        self.right_edge = cache(lambda token: self._edge(token, 2))
        self.left_edge = cache(lambda token: self._edge(token, 1))

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The tokens that stand at one end of ``token`` while it is merged, each with the rank that swallows it."""
        found: list[tuple[int, float]] = [(token, float("inf"))]
        while token in self.parts:
            rank = self.parts[token][0]
            token = self.parts[token][side]
            found.append((token, rank))
        return found

    def may_follow(self, first: int, second: int) -> bool:
        """Whether merging the bytes of both tokens gives the two tokens.

        It does unless some merge across the border comes before the merges that swallow
        its two parts. Of equal merges the left one comes first.
        """
        pair = first << 32 | second
        known = self.neighbours.get(pair)
        if known is None:
            if len(self.neighbours) >= REMEMBERED:
                self.neighbours.clear()
            known = self.neighbours[pair] = not any(
                self.ranks.get((a, b), until_a) < until_a and self.ranks[a, b] <= until_b
                for a, until_a in self.right_edge(first)
                for b, until_b in self.left_edge(second)
            )
        return known

    def _short(self, end: bytes) -> list[tuple[int, int]]:
        """(length, token) of the tokens of up to four bytes that ``end`` ends with, the longest first."""
        ends = ((n, self.ids.get(end[-n:])) for n in range(len(end), 0, -1))
        return [(n, token) for n, token in ends if token is not None]

    def encode_words(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Every word's tokens, as little-endian 32-bit numbers."""
        made: dict[bytes, bytes] = {}
        ids, ends, length_of, neighbours = self.ids.get, self.ends.get, self.length_of, self.neighbours.get
        path, states = b"", array("i", [-1])
        todo = [(build_trie(words), 0)]
        while todo:
            node, depth = todo.pop()
            path = path[:depth] + node.label
            del states[depth + 1 :]
            # The last token of every longer prefix, from those of the shorter ones.
            for end in range(depth + 1, len(path) + 1):
                last = path[max(0, end - 4) : end]
                found = ends(last)
                if found is None:
                    tokens = self.short(last[-3:])
                else:
                    long = ((n, ids(path[end - n : end])) for n in found[0] if n <= end)
                    tokens = chain(long, found[1]) if found[0] else found[1]
                for length, token in tokens:
                    if token is None:
                        continue
                    if length == end:
                        break
                    before = states[end - length]
                    fits = neighbours(before << 32 | token)
                    if fits or fits is None and self.may_follow(before, token):
                        break
                states.append(token)
            if node.ends:
                tokens, end = [], len(path)
                while end:
                    tokens.append(states[end])
                    end -= length_of[states[end]]
                tokens.reverse()
                made[path] = pack(f"<{len(tokens)}I", *tokens)
            if node.children:
                depth = len(path)
                todo += [(child, depth) for child in node.children.values()]
        return made

    def split(self, text: str) -> list[str]:
        """Words of a text, with the strings of special tokens as words of their own."""
        if self.specials is None or not self.specials.search(text):
            return self._words(text)
        found, start = [], 0
        for match in self.specials.finditer(text):
            found += [*self._words(text[start : match.start()]), match[0]]
            start = match.end()
        return found + self._words(text[start:])

    def _words(self, text: str) -> list[str]:
        if not self.late.search(text):
            return self.early.findall(text)  # twice as fast
        return (self.careful if self.recent.search(text) else self.plain).findall(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.words) >= REMEMBERED:
            self.words, self.earlier = {}, self.words
        known, earlier = self.words, self.earlier
        split = [self.split(text) for text in texts]
        unseen = set().union(*split).difference(known)
        known |= {word: earlier[word] for word in unseen if word in earlier}
        known |= {special: pack("<I", i) for special, i in self.special.items()}
        new = {word: word.encode() for word in unseen if word not in known}
        gc.disable()  # nodes form no cycles; looking for some takes a fifth of the time
        made = self.encode_words(list(new.values()))
        gc.enable()
        known |= {word: made[spelled] for word, spelled in new.items()}
        return [b"".join(map(known.__getitem__, words)) for words in split]


@cache
def vocabulary(path: str) -> Vocabulary:
    """Read once per process."""
    return Vocabulary(path)


def spell(tokens: bytes, path: str) -> str:
    """What tokens in little-endian 32-bit numbers decode to."""
    spelled = b"".join(map(spellings(path).__getitem__, np.frombuffer(tokens, dtype="<u4").tolist()))
    return spelled.decode("utf-8", errors="replace")


#: Characters that are encoded together; a longer text is a batch of its own.
TOGETHER = 2_000_000


def _texts(column: pa.Array) -> Iterator[list[str]]:
    """The texts of a column in runs of bounded size."""
    run, size = [], 0
    for value in column.cast(pa.binary()):
        text = (value.as_py() or b"").decode("utf-8", errors="replace")
        run.append(text)
        size += len(text)
        if size >= TOGETHER:
            yield run
            run, size = [], 0
    yield run


def encode(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """The columns ``keep`` and ``tokens``: every text's ids as little-endian 32-bit numbers."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coding = vocabulary(path)
        for batch in batches:
            at = 0
            for run in _texts(batch.column(len(keep))):
                made = pa.array(coding.encode(run), pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.slice(at, len(run)).columns[:-1], made], names=names)
                at += len(run)

    kept = docs.select(*[F.col(c) for c in keep], F.col(text).cast("string").alias("__text"))
    names = [*keep, "tokens"]
    fields = kept.select(*keep, F.lit(b"").alias("tokens")).schema
    return kept.mapInArrow(encoded, fields)


def decode(encoded: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """``encoded`` with ``text``, what its ``tokens`` spell, in place of any column of that name."""
    rest = [c for c in encoded.columns if c != "text"]
    place = rest.index("tokens")

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([spell(x.as_py() or b"", path) for x in batch.column(place)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=names)

    names = [*rest, "text"]
    plain = encoded.select(*rest)
    return plain.mapInArrow(decoded, plain.select("*", F.lit("").alias("text")).schema)
