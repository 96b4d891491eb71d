"""Operator 4: BPE encoding and decoding by a prefix-sharing trie.

In BPE the encoding of a string is fixed by its last token alone: what stands
before that token is the encoding of the string without it. So the trie of
the distinct words needs one value a node, the last token of the node's
prefix, and words that share a prefix share its values. The last token is the
one vocabulary token ending there that stands validly behind the last token
of the prefix it leaves: a pair of tokens is valid if merging its joined
symbols gives back that very pair.

Documents are cut into words at white space; words seen before come from a
bounded table. Words of any length go through the trie. The library normalises
texts with characters whose lower case is not fixed, and no more. Only Spark splits the work: every task reads the vocabulary
file, keeps its own table and handles whole texts, one batch of rows at a time.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
import struct
import sys
import unicodedata
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from driftlens.llm.common import values

#: Entries of a worker's word table; when full, a new one is begun.
TABLE_WORDS = 500_000
#: Texts are taken in groups of about so many characters.
GROUP_CHARS = 1_000_000


@functools.cache
def library(path: str):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


@functools.cache
def _unsure() -> re.Pattern:
    """Characters whose lower case depends on the Unicode version or on what
    stands beside them: the library normalises texts that have one."""
    spans, start = [], None
    for c in range(sys.maxunicode + 2):
        odd = c <= sys.maxunicode and (c == 0x3A3 or unicodedata.category(chr(c)) == "Cn")
        if odd and start is None:
            start = c
        elif not odd and start is not None:
            spans.append(f"\\U{start:08x}-\\U{c - 1:08x}")
            start = None
    return re.compile("[" + "".join(spans) + "]")


_ODD_SPACE = re.compile("[\x1c-\x1f]")


@functools.cache
def _bytes_as_chars() -> list[str]:
    """Byte-level BPE's printable stand-in of each byte: printable bytes stand
    for themselves, the others take code points from 256 on, in order."""
    out, spare = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


class Vocabulary:
    """Merges, ids and split pattern of a word-ending byte-level BPE file."""

    def __init__(self, path: str, merges: bool = True):
        import json

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.path = path
        self.end = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        self.rank: dict[tuple[str, str], int] = {} if not merges else {tuple(m if isinstance(m, list) else m.split(" ")): i for i, m in enumerate(model["merges"])}
        self.tokens = {i: t for t, i in self.ids.items()} | {a["id"]: a["content"] for a in spec["added_tokens"]}
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.at_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")" if self.special else "(?!)")
        self.split = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.chars = _bytes_as_chars()
        self._valid: dict[tuple[str, str], bool] = {}
        self._alone: dict[str, bool] = {}
        self._spines: tuple[dict, dict] = {}, {}
        self._ending: dict[tuple[str, str], list[str]] = {}
        self.made = {a + b: (a, b) for a, b in reversed(self.rank)}  # the first merge that gives it

    def merge(self, symbols: list[str]) -> list[str]:
        """Plain BPE: the lowest merge first, from the left."""
        while len(symbols) > 1:
            best = min(zip(symbols, symbols[1:]), key=lambda p: self.rank.get(p, sys.maxsize))
            if best not in self.rank:
                break
            out, i = [], 0
            while i < len(symbols):
                if i + 1 < len(symbols) and (symbols[i], symbols[i + 1]) == best:
                    out.append(symbols[i] + symbols[i + 1])
                    i += 2
                else:
                    out.append(symbols[i])
                    i += 1
            symbols = out
        return symbols

    def symbols(self, token: str) -> list[str]:
        if self.end and token.endswith(self.end):
            body = token[: -len(self.end)]
            return [*body[:-1], body[-1] + self.end]
        return list(token)

    def alone(self, token: str) -> bool:
        """Is it a token that its own symbols merge to?"""
        known = self._alone.get(token)
        if known is None:
            known = self._alone[token] = token in self.ids and self.merge(self.symbols(token)) == [token]
        return known

    @functools.cached_property
    def heads(self) -> set[str]:
        """All beginnings of tokens, without the word end."""
        bodies = [t.removesuffix(self.end) if self.end else t for t in self.ids]
        return {b[:n] for b in bodies for n in range(len(b) + 1)}

    def ending(self, head: str, suffix: str) -> list[str]:
        """Tokens made of an end of ``head`` and the suffix, longest first."""
        known = self._ending.get((head, suffix))
        if known is None:
            known = [t for n in range(len(head)) if (t := head[n:] + suffix) in self.ids and self.alone(t)]
            self._ending[head, suffix] = known
        return known

    def spine(self, token: str, side: int) -> list[tuple[str, int]]:
        """The parts of token that lie at its right (side 1) or left (0) edge,
        largest first, each with the rank of the merge that ends it."""
        known = self._spines[side].get(token)
        if known is None:
            known, part = [(token, sys.maxsize)], token
            while part in self.made:
                ends, part = self.rank[self.made[part]], self.made[part][side]
                known.append((part, ends))
            self._spines[side][token] = known
        return known

    def valid(self, left: str, right: str) -> bool:
        """Does no merge across the border come before those on either side?
        Equal merges go from the left, so the border goes before the right."""
        known = self._valid.get((left, right))
        if known is None:
            known, rank = True, self.rank
            for b, ends_b in self.spine(right, 0):
                for a, ends_a in self.spine(left, 1):
                    m = rank.get((a, b))
                    if m is not None and m < ends_a and m <= ends_b:
                        known = False
            if len(self._valid) > 1_000_000:
                self._valid.clear()
            self._valid[left, right] = known
        return known


def encode_words(vocab: Vocabulary, distinct: Iterable[str]) -> dict[str, list[int]]:
    """Ids of each word, by one depth-first walk of the words' trie.

    Sorted words are the trie in depth-first order: a word shares with the one
    before it the nodes of their common prefix, whose last tokens stay on the
    stack; only the nodes below are new.
    """
    chars, ids, end, heads = vocab.chars, vocab.ids, vocab.end, vocab.heads
    ending, valid = vocab.ending, vocab.valid
    spelled = sorted(("".join([chars[b] for b in w.encode()]), w) for w in distinct)
    out: dict[str, list[int]] = {}
    path = ""
    last: list[str] = [""]  # last[d]: last token of path[:d]
    head: list[str] = [""]  # head[d]: longest end of path[:d] that begins a token

    def longest_head(word: str, d: int) -> str:
        n = len(head[d - 1]) + 1
        while word[d - n : d] not in heads:
            n -= 1
        return word[d - n : d]

    def last_token(word: str, d: int, begun: str, suffix: str) -> str:
        """Last token of word[:d] (with the word end, if suffix says so)."""
        for t in ending(begun, suffix):
            n = len(t) - len(suffix)
            if n == d or valid(last[d - n], t):
                return t
        raise ValueError(f"the vocabulary has no symbol for {word[d - 1]!r}")

    for word, original in spelled:
        shared = len(os.path.commonprefix((path, word)))
        del last[shared + 1 :], head[shared + 1 :]
        body = word[:-1] if end else word
        for d in range(len(last), len(body) + 1):
            head.append(longest_head(word, d))
            last.append(last_token(word, d, head[d], ""))
        path = word[: len(last) - 1]
        d, tokens = len(word), []
        t = last_token(word, d, longest_head(word, d), end) if end else last[d]
        while True:
            tokens.append(ids[t])
            d -= len(t.removesuffix(end)) if d == len(word) and end else len(t)
            if not d:
                break
            t = last[d]
        out[original] = tokens[::-1]
    return out


class Encoder:
    """Whole texts to (ids as little-endian unsigned 32-bit, tokens joined by
    one space: what the library's decode gives for a file without a decoder)."""

    def __init__(self, path: str, by_trie: bool = True, table_words: int = TABLE_WORDS):
        self.table_words = table_words
        self.vocab = Vocabulary(path, by_trie)
        self.by_trie = by_trie
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.spelled: dict[str, bytes] = {}
        self.older_spelled: dict[str, bytes] = {}

    def text_of(self, ids: list[int]) -> bytes:
        return " ".join([self.vocab.tokens[i] for i in ids]).encode()

    def _learn(self, units: set[str], spell: bool) -> None:
        """Adds the ids of units to the table: runs without white space, or
        special tokens, which follow a space so that no run is taken for one."""
        special = {u for u in units if u[0] == " "}
        for u in special:
            self.words[u] = struct.pack("<I", self.vocab.special[u[1:]])
            if spell:
                self.spelled[u] = u[1:].encode()
        parts = {u: self.vocab.split.findall(u) for u in units - special}
        new = {p for ps in parts.values() for p in ps}
        if self.by_trie:
            found = encode_words(self.vocab, new)
        else:
            model, chars = library(self.vocab.path).model, self.vocab.chars
            found = {p: [t.id for t in model.tokenize("".join([chars[b] for b in p.encode()]))] for p in new}
        for u, ps in parts.items():
            ids = found[ps[0]] if len(ps) == 1 else [i for p in ps for i in found[p]]
            self.words[u] = struct.pack(f"<{len(ids)}I", *ids)
            if spell:
                self.spelled[u] = self.text_of(ids)

    def encode_batch(self, texts: Iterable[str | None], spell: bool) -> Iterator[tuple[bytes, bytes]]:
        """spell: give the decoded text too. Texts are taken in groups, so that
        the units of one group bound the memory."""
        group, size = [], 0
        for text in texts:
            group.append(text or "")
            size += len(group[-1])
            if size > GROUP_CHARS:
                yield from self._encode_group(group, spell)
                group, size = [], 0
        yield from self._encode_group(group, spell)

    def _encode_group(self, texts: list[str], spell: bool) -> Iterator[tuple[bytes, bytes]]:
        cut: list[list[str]] = []
        for text in texts:
            if any(t in text for t in self.vocab.special) or _ODD_SPACE.search(text) or self._is_unsure(text):
                cut.append(self._cut_odd(text))
            else:
                cut.append(unicodedata.normalize("NFC", text).lower().split())
        if len(self.words) > self.table_words:  # only the words that come again are carried over
            self.older, self.words = self.words, {}
            self.older_spelled, self.spelled = self.spelled, {}
        new = set().union(*cut) - self.words.keys()
        for u in new & self.older.keys():
            self.words[u] = self.older[u]
            if spell:
                self.spelled[u] = self.older_spelled[u]
        self._learn(new - self.words.keys(), spell)
        word, spelled = self.words.__getitem__, self.spelled.__getitem__
        for units in cut:
            yield b"".join(map(word, units)), b" ".join(filter(None, map(spelled, units))) if spell else b""

    def _cut_odd(self, text: str) -> list[str]:
        """Units of a text that the library normalises, cut at special tokens."""
        units: list[str] = []
        for at, part in enumerate(self.vocab.at_special.split(text)):
            if at % 2:
                units.append(" " + part)
            elif part:
                units += self.vocab.split.findall(library(self.vocab.path).normalizer.normalize_str(part))
        return units

    @staticmethod
    def _is_unsure(text: str) -> bool:
        try:
            text.encode("latin-1")
            return False
        except UnicodeEncodeError:
            return _unsure().search(text) is not None


@functools.cache
def encoder(path: str, by_trie: bool = True, table_words: int = TABLE_WORDS) -> Encoder:
    """One a Python worker, so that its word table outlives a task. A caller
    asks for decoded texts always or never."""
    return Encoder(path, by_trie, table_words)


SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """Encodes and decodes the whole ``text`` of every row.

    Null text is the empty text: no ids, the empty decoded text. Null
    ``doc_id``, repeated rows and further columns are no matter: one row out
    for each row in, none for an empty table. A word's time grows with its length. with_ids adds ``ids`` (array of int) and ``decoded``.
    """
    schema = SCHEMA + (", ids array<int>, decoded string" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            n, ids_sha, dec_sha, ids, dec = [], [], [], [], []
            for packed, decoded in enc.encode_batch(values(batch, 1), True):
                n.append(len(packed) // 4)
                ids_sha.append(hashlib.sha256(packed).hexdigest())
                dec_sha.append(hashlib.sha256(decoded).hexdigest())
                if with_ids:
                    ids.append(list(struct.unpack(f"<{len(packed) // 4}i", packed)))
                    dec.append(decoded.decode())
            cols = [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(dec_sha, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                cols += [pa.array(ids, pa.list_(pa.int32())), pa.array(dec, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, schema)
