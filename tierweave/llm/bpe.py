"""Byte-pair encoding without replaying merges.

A token sequence is what the merges give exactly when every two neighbours are *compatible*:
encoding their concatenation gives back the same two tokens. Compatibility only looks at how
the two tokens were merged themselves, so it is decided once per pair and remembered. Two
things follow:

* ``encode``: take the longest token at each place; if it does not fit its left neighbour try
  its next shorter prefix token, and step back when none fits. Places that turned out to be
  dead ends are never tried again, which keeps the work linear.
* ``prefix_counts``: the encoding of a prefix ends in the one token that is compatible with the
  end of the encoding of what comes before it, so counts of all prefixes come from one pass.

Bytes are spelled as Latin-1 characters, so that one automaton over strings finds all tokens.
Vocabularies with word ends carry ``END`` behind the last byte of a token that closes a word.
"""

from __future__ import annotations

import base64
import json
from dataclasses import dataclass

from tierweave.llm.common import ship

ship(__name__)

#: Behind the last byte of a word in vocabularies with word ends; not a Latin-1 character.
END = "Ā"
#: Pairs remembered per worker before the memory is started afresh.
PAIRS_KEPT = 400_000


@dataclass
class Merges:
    """Tokens in merge order: spelling, vocabulary id and the two parts (-1: unmerged)."""

    spelled: list[str]
    ids: list[int]
    left: list[int]
    right: list[int]
    #: spellings that are tokens although no merge order reaches them
    unreached: dict[str, int]


def merges_of_ranks(data: bytes) -> Merges:
    """Of a rank file: lines of base64 token and rank. A token's parts are what the lower ranks leave."""
    ranks = {}
    for line in data.splitlines():
        if line.strip():
            token, rank = line.split()
            ranks[base64.b64decode(token).decode("latin-1")] = int(rank)
    order = sorted(ranks, key=ranks.get)
    place: dict[str, int] = {}
    out = Merges([], [], [], [], {})
    for token in order:
        parts = list(token)
        limit = ranks[token]
        while len(parts) > 2:
            best, at = limit, -1
            for i in range(len(parts) - 1):
                r = ranks.get(parts[i] + parts[i + 1], limit)
                if r < best:
                    best, at = r, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        if len(parts) > 2 or any(p not in place for p in parts if len(token) > 1):
            out.unreached[token] = ranks[token]
            continue
        place[token] = len(out.spelled)
        out.spelled.append(token)
        out.ids.append(ranks[token])
        out.left.append(place[parts[0]] if len(token) > 1 else -1)
        out.right.append(place[parts[1]] if len(token) > 1 else -1)
    return out


def byte_letters() -> dict[str, str]:
    """Printable letter of the byte-level alphabet -> Latin-1 character of the byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): chr(b) for b in shown} | {chr(256 + i): chr(b) for i, b in enumerate(rest)}


def merges_of_word_file(data: bytes) -> Merges:
    """Of a tokenizer file whose model is BPE with an end-of-word suffix."""
    model = json.loads(data)["model"]
    suffix, letters, vocab = model["end_of_word_suffix"], byte_letters(), model["vocab"]

    def spell(token: str) -> str:
        body, end = (token[: -len(suffix)], END) if token.endswith(suffix) else (token, "")
        return "".join(letters[c] for c in body) + end

    out, place = Merges([], [], [], [], {}), {}
    for letter in letters:
        for token in (letter, letter + suffix):
            place[token] = len(out.spelled)
            out.spelled.append(spell(token))
            out.ids.append(vocab[token])
            out.left.append(-1)
            out.right.append(-1)
    for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
        place[a + b] = len(out.spelled)
        out.spelled.append(spell(a + b))
        out.ids.append(vocab[a + b])
        out.left.append(place[a])
        out.right.append(place[b])
    return out


class PairCoder:
    """Encoder of one vocabulary; its automaton and pair memory live in the worker."""

    def __init__(self, merges: Merges):
        import ahocorasick

        self.merges = merges
        self.merged = {(a, b): t for t, (a, b) in enumerate(zip(merges.left, merges.right, strict=True)) if a >= 0}
        self.length = [len(s) for s in merges.spelled]
        self.automaton = ahocorasick.Automaton()
        place = {}
        for t, s in enumerate(merges.spelled):
            place[s] = t
            self.automaton.add_word(s, (t, len(s)))
        self.automaton.make_automaton()
        self.place = place
        # the longest token that is a proper beginning of each token
        self.shorter = [
            next((place[s[:n]] for n in range(len(s) - 1, 0, -1) if s[:n] in place), -1) for s in merges.spelled
        ]
        self.longest = max(self.length)
        self.pairs: dict[int, bool] = {}

    def fits(self, a: int, b: int) -> bool:
        """Whether the merges leave ``a`` and ``b`` side by side."""
        key = a << 20 | b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIRS_KEPT:
                self.pairs.clear()
            known = self.pairs[key] = self._fits(a, b)
        return known

    def _fits(self, a: int, b: int) -> bool:
        # Undo the later of the two merges step by step. A merge across the border that comes
        # before what has been undone so far would have happened first.
        left, right, merged = self.merges.left, self.merges.right, self.merged
        limit = len(left)
        while True:
            joined = merged.get((a, b))
            if joined is not None and joined < limit:
                return False
            undo_left = a > b
            if (left[a] if undo_left else left[b]) < 0:
                undo_left = not undo_left
                if (left[a] if undo_left else left[b]) < 0:
                    return True
            if undo_left:
                limit, a = a, right[a]
            else:
                # of equal merges the leftmost goes first
                limit, b = b + 1, left[b]

    def encode(self, word: str) -> list[int]:
        """Tokens of one pre-token given as Latin-1 characters."""
        n = len(word)
        longest = [-1] * n
        for end, (token, size) in self.automaton.iter(word):
            longest[end - size + 1] = token
        fits, length, shorter = self.fits, self.length, self.shorter
        live = bytearray(b"\x01") * (n + 1)
        out: list[int] = []
        pos = 0
        token = longest[0] if n else -1
        while pos < n:
            last = out[-1] if out else -1
            while token >= 0 and not (live[pos + length[token]] and (last < 0 or fits(last, token))):
                token = shorter[token]
            if token >= 0:
                out.append(token)
                pos += length[token]
                token = longest[pos] if pos < n else -1
            else:
                live[pos] = 0
                token = out.pop()
                pos -= length[token]
                token = shorter[token]
        return out

    def prefix_counts(self, word: str) -> list[int]:
        """Token counts of ``word[:1], word[:2], ...`` as whole words of a vocabulary with word ends."""
        n = len(word)
        inner: list[list[int]] = [[] for _ in range(n + 1)]
        for end, (token, _) in self.automaton.iter(word):
            inner[end + 1].append(token)
        fits, length, place = self.fits, self.length, self.place
        last, count = [-1] * (n + 1), [0] * (n + 1)
        closed = [0] * n
        for i in range(1, n + 1):
            # one ends the open prefix, one the prefix closed as a word
            for token in inner[i]:
                start = i - length[token]
                if last[i] < 0 and (start == 0 or (last[start] >= 0 and fits(last[start], token))):
                    last[i], count[i] = token, count[start] + 1
                if not closed[i - 1]:
                    shut = place.get(word[start:i] + END, -1)
                    if shut >= 0 and (start == 0 or (last[start] >= 0 and fits(last[start], shut))):
                        closed[i - 1] = count[start] + 1
                if last[i] >= 0 and closed[i - 1]:
                    break
            if not closed[i - 1]:  # closed tokens whose open form is no token
                for size in range(min(i, self.longest), 0, -1):
                    start = i - size
                    shut = place.get(word[start:i] + END, -1)
                    if shut >= 0 and (start == 0 or (last[start] >= 0 and fits(last[start], shut))):
                        closed[i - 1] = count[start] + 1
                        break
        return closed
