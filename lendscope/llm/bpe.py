"""Byte-pair encoding helpers that run inside Spark tasks.

* :class:`RankMerger` merges many pre-tokens at once on ragged numpy arrays.
* :class:`PieceCounter` counts the tokens of whole texts with it.
* :class:`WordIds` gives the ids of whole texts for a word-level vocabulary
  in which white space is dropped, by the tokenizers library.

Texts repeat most of their words, so each worker keeps what it knows of a
piece in a memo that is emptied at a fixed number of entries.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata

import numpy as np

MEMO_ENTRIES = 250_000


def byte_symbols() -> dict[int, str]:
    """Byte -> printable stand-in of byte-level vocabularies: printable
    Latin-1 stays, every other byte takes the next code point from 256 on."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(keep)]
    return {b: chr(b) for b in keep} | {b: chr(256 + i) for i, b in enumerate(rest)}


class RankMerger:
    """Lowest-rank pair merging of many byte strings in step.

    All sequences lie in one flat array.  Each round looks up the rank of
    every adjacent pair, takes each sequence's lowest, merges all places of
    that pair in its sequence (left to right where they overlap) and drops
    the sequences that have no pair left.
    """

    NONE = np.int64(1) << 40

    def __init__(self, vocab: dict[str, int], merges: list):
        self.size = max(vocab.values()) + 1
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        key = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], dtype=np.int64)
        new = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(key, kind="stable")
        self.key, self.rank, self.new_of_rank = key[order], order.astype(np.int64), new
        of_byte = byte_symbols()
        self.byte_id = np.array([vocab[of_byte[b]] for b in range(256)], dtype=np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        want = left * self.size + right
        at = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
        return np.where(self.key[at] == want, self.rank[at], self.NONE)

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Number of symbols left of each byte string once no pair merges."""
        out = np.array([len(w) for w in words], dtype=np.int64)
        live = np.flatnonzero(out > 1)
        if not len(live):
            return out
        sym = self.byte_id[np.frombuffer(b"".join(words[i] for i in live), dtype=np.uint8)]
        length = out[live]
        while len(live):
            start = np.concatenate(([0], np.cumsum(length)[:-1]))
            rank = np.full(len(sym), self.NONE)
            rank[:-1] = self.ranks(sym[:-1], sym[1:])
            rank[start + length - 1] = self.NONE          # no pair over a sequence's end
            best = np.minimum.reduceat(rank, start)
            hit = (rank == np.repeat(best, length)) & (rank < self.NONE)
            at = np.flatnonzero(hit)
            # overlapping places of one pair ("aaa"): every second of a run of places
            fresh = np.ones(len(at), dtype=bool)
            fresh[1:] = at[1:] != at[:-1] + 1
            first = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - first) % 2 == 0]
            sym[at] = self.new_of_rank[rank[at]]
            stay = np.ones(len(sym), dtype=bool)
            stay[at + 1] = False
            seq = np.repeat(np.arange(len(live)), length)
            length = length - np.bincount(seq[at], minlength=len(live))
            out[live] = length
            more = (best < self.NONE) & (length > 1)
            stay &= more[seq]
            sym, live, length = sym[stay], live[more], length[more]
        return out


class PieceCounter:
    """Token counts of whole texts for a byte-level vocabulary with the usual
    pre-token pattern.  ``special`` strings count as one token each, as the
    library treats them by default."""

    def __init__(self, path: str, pattern: str):
        import regex
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.merger = RankMerger(spec["model"]["vocab"], spec["model"]["merges"])
        self.special = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)
        self.cut = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        self.pre = regex.compile(pattern)
        # A text where every space stands alone between two other characters
        # can be cut at its spaces: no pre-token then crosses such a place.
        self.wide = re.compile(r"\s\s|\A\s|\s\Z")
        self.after: dict[str, int] = {}       # tokens of a piece that follows a space
        self.first: dict[str, int] = {}       # tokens of a piece that starts its text
        self.words: dict[str, int] = {}

    def counts(self, texts: list[str]) -> list[int]:
        if len(self.after) + len(self.first) > MEMO_ENTRIES:
            self.after, self.first, self.words = {}, {}, {}
        plan, after, first = [], set(), set()
        for text in texts:
            extra = 0
            parts = [text]
            if self.cut is not None and any(s in text for s in self.special):
                parts = self.cut.split(text)
                extra = len(parts) - 1
            lists = []
            for part in parts:
                if part and not self.wide.search(part):
                    head, *rest = part.split(" ")
                    lists.append(([head], rest))
                else:
                    lists.append((self.pre.findall(part), []))
                first.update(lists[-1][0])
                after.update(lists[-1][1])
            plan.append((extra, lists))
        self.learn(self.first, "", first)
        self.learn(self.after, " ", after)
        of_first, of_after = self.first.__getitem__, self.after.__getitem__
        return [n + sum(sum(map(of_first, heads)) + sum(map(of_after, rest)) for heads, rest in lists)
                for n, lists in plan]

    def learn(self, memo: dict[str, int], lead: str, pieces: set[str]) -> None:
        new = [p for p in pieces if p not in memo]
        cut = [self.pre.findall(lead + p) for p in new]
        words = list({w for ws in cut for w in ws if w not in self.words})
        self.words.update(zip(words, self.merger.counts([w.encode("utf-8", "surrogatepass") for w in words]).tolist()))
        get = self.words.__getitem__
        memo.update((p, sum(map(get, ws))) for p, ws in zip(new, cut))


class WordIds:
    """Ids of whole texts by the tokenizers library, as little-endian 32-bit
    bytes.

    The vocabulary drops white space and never joins what white space
    separates, so plain texts (no special strings, only characters whose
    normal form and case are settled) are looked up by white-space piece;
    the library encodes each piece once.  Every other text goes to the
    library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        # U+0250 on: combining marks and scripts with contextual case; U+0130
        # lower-cases to two characters; control characters differ as space.
        self.other = re.compile("[^\t\n\x0b\x0c\r\x20-\x7e\xa1-įı-ɏ]")
        # The vocabulary's pre-token pattern, over the characters of plain texts.
        kind = {k: "".join(chr(c) for c in range(0x250) if unicodedata.category(chr(c))[0] == k) for k in "LN"}
        self.pre = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{kind['L']}]+|[{kind['N']}]|[^\\s{kind['L']}{kind['N']}]+")
        self.bytes_as = {b: ord(c) for b, c in byte_symbols().items()}
        self.memo: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def ids(self, text: str) -> bytes:
        if self.other.search(text) or any(s in text for s in self.special):
            return self.whole(text)
        pieces = text.lower().split()
        memo = self.memo
        try:
            return b"".join(map(memo.__getitem__, pieces))
        except KeyError:
            pass
        if len(memo) > MEMO_ENTRIES:
            memo.clear()
            self.words.clear()
        for p in {p for p in pieces if p not in memo}:
            memo[p] = b"".join([self.words.get(w) or self.word(w) for w in self.pre.findall(p)])
        return b"".join(map(memo.__getitem__, pieces))

    def word(self, word: str) -> bytes:
        shown = word.encode().decode("latin-1").translate(self.bytes_as)
        ids = [t.id for t in self.tok.model.tokenize(shown)]
        out = self.words[word] = struct.pack(f"<{len(ids)}I", *ids)
        return out
