"""BPE as a deterministic automaton over tokens.

The automaton accepts a sequence of tokens exactly when BPE would emit it. It starts
with one state and a loop for every byte; then the merges are worked in, one after
the other, as gadgets. Merge (u, v) -> w takes the v-arc out of the state that
u-arcs lead to, and puts a w-arc beside every u-arc; w leads to a state that is a
copy of v's. All arcs of one label thus lead to one state, named by that label, and
the states differ in the arcs that they have.

A table of all arcs would have (number of tokens)**2 entries. The order of the
gadgets gives each entry directly: an arc (x, y) was copied from (x's right part, y)
or (x, y's left part), whichever token came later, and is gone once a merge (x, y)
took it out. ``arc`` follows the copies back to two bytes; entries that were asked
for are kept in a table of bounded size.

Encoding reads a word from the left: of the tokens that fit, the longest that the
state has an arc for; where a path ends early, the next shorter one. Positions known
to lead nowhere are marked, so that each is left only once and the work is linear in
the word's length. There is just one accepted path, so what is found is BPE's result.

Decoding follows the arcs and emits their labels.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import lru_cache

NEVER = 1 << 60
TABLE_SIZE = 1 << 18


def byte_letters() -> dict[str, int]:
    """Letters that stand for bytes in byte-level vocabularies: printable ones for
    themselves, the others from U+0100 on in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(other)}


class BpeAutomaton:
    """``labels``: the bytes of each token id; ``merges``: pairs of ids and their
    result, in order."""

    def __init__(self, labels: Sequence[bytes], merges: Sequence[tuple[int, int, int]]):
        self.labels = list(labels)
        n = len(self.labels)
        self.born = [-1] * n  # index of the gadget that made the token
        self.left, self.right = list(range(n)), list(range(n))
        self.gadget: dict[int, int] = {}  # pair -> index of the gadget that removes it
        self.width = n
        self.arcs: dict[int, bool] = {}
        for i, (u, v, w) in enumerate(merges):
            # A merge whose v-arc is gone already, or whose token exists, adds nothing.
            if not self.arc(u, v, i) or self.born[w] >= 0:
                continue
            self.gadget[u * n + v] = i
            self.born[w], self.left[w], self.right[w] = i, u, v
        self.arcs.clear()
        alive = [i for i in range(n) if self.born[i] >= 0 or len(self.labels[i]) == 1]
        self.ids = {self.labels[i]: i for i in alive}
        longest: dict[bytes, int] = {}
        for label in self.ids:  # how far a word may go on, by its first two bytes
            longest[label[:2]] = max(longest.get(label[:2], 0), len(label))
        self.longest = longest

    def arc(self, x: int, y: int, before: int = NEVER) -> bool:
        """Whether x may be followed by y once the gadgets up to ``before`` are in."""
        born, n = self.born, self.width
        while True:
            gone = self.gadget.get(x * n + y, NEVER)
            if gone < before:
                return False
            a, b = born[x], born[y]
            if a < 0 and b < 0:
                return True
            # The later token's arc is a copy of one that existed when it was made.
            # w = uu leads to u's state as it was before u's own u-arc went.
            if a > b:
                before, x = a, self.right[x]
            elif b > a:
                # Left parts were read after gadget b had removed the arc (u, v).
                before, y = b + 1, self.left[y]
            else:  # the token after itself: the copied row, then the copied column
                before, x, y = a, self.right[x], self.left[y]

    def allows(self, x: int, y: int) -> bool:
        key = x * self.width + y
        known = self.arcs.get(key)
        if known is None:
            if len(self.arcs) >= TABLE_SIZE:
                self.arcs.clear()
            known = self.arcs[key] = self.arc(x, y)
        return known

    def encode_word(self, word: bytes) -> list[int]:
        whole = self.ids.get(word)
        if whole is not None:
            return [whole]
        ids, n, labels = self.ids, len(word), self.labels
        path: list[int] = []
        at, dead = 0, set()
        size = min(self.longest.get(word[:2], 1), n)
        while at < n:
            chosen = -1
            while size:
                token = ids.get(word[at : at + size])
                if token is not None and at + size not in dead:
                    if not path or self.allows(path[-1], token):
                        chosen = token
                        break
                size -= 1
            if chosen >= 0:
                path.append(chosen)
                at += size
                size = min(self.longest.get(word[at : at + 2], 1), n - at)
            else:
                if not path:
                    raise ValueError(f"a byte of {word!r} has no token")
                dead.add(at)
                size = len(labels[path.pop()])
                at -= size
                size -= 1
        return path

    def decode(self, ids: Sequence[int]) -> bytes:
        return b"".join(map(self.labels.__getitem__, ids))


def from_tokenizer_json(path: str) -> tuple[BpeAutomaton, dict[str, int]]:
    """The automaton of a byte-level BPE file, and its added tokens by content."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, split = spec["model"], spec["pre_tokenizer"] or {}
    plain = (
        model["type"] == "BPE"
        and split.get("type") == "ByteLevel"
        and not split.get("add_prefix_space")
        and split.get("use_regex", True)
        and not spec["normalizer"]
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    )
    if not plain:
        raise ValueError(f"{path} is not a plain byte-level BPE")
    letters, vocab = byte_letters(), model["vocab"]
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    for t in spec["added_tokens"]:
        if t["single_word"] or t["lstrip"] or t["rstrip"]:
            raise ValueError(f"added token {t['content']!r} takes in its surroundings")
    labels = [b""] * (max([*vocab.values(), *added.values()]) + 1)
    for token, i in vocab.items():
        labels[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else b""
    for content, i in added.items():
        labels[i] = content.encode()
    pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
    merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
    return BpeAutomaton(labels, merges), added


@lru_cache(2)
def automaton(path: str) -> tuple[BpeAutomaton, dict[str, int]]:
    """Compiled once in each Python worker."""
    return from_tokenizer_json(path)
