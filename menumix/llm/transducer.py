"""Minimal acyclic transducers from sorted terms to their ordinals, as memory-mapped arrays.

A state's arcs are stored as sorted keys (state * 256 + byte) with the arc's output and
target. The outputs along a term's path add up to the number of smaller terms.
"""

from __future__ import annotations

import os
from bisect import bisect_right
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np

from menumix.llm.arrays import save

NAMES = ("keys", "outputs", "targets", "final")


def build(terms: Iterable[bytes]) -> list[np.ndarray]:
    """Arc keys, outputs, targets and final flags; the last state is the root. ``terms`` are sorted and distinct.

    States off the path of the newest term can get no more arcs: they are
    replaced by an equal state where one is registered, which keeps the whole minimal."""
    register: dict[tuple, int] = {}
    path: list[list] = [[False, []]]  # [final, arcs] along the newest term
    last = b""

    def close(depth: int) -> None:
        while len(path) > depth:
            final, arcs = path.pop()
            state = register.setdefault((final, tuple(arcs)), len(register))
            if path:
                path[-1][1].append((last[len(path) - 1], state))

    for term in terms:
        same = len(os.path.commonprefix([last, term]))
        close(same + 1)
        path += [[False, []] for _ in term[same:]]
        path[-1][0] = True
        last = term
    close(1)
    root = tuple(path[0])
    states = [*register, (root[0], tuple(root[1]))]  # the root may equal no other state, for it holds the longest terms
    counts, keys, outputs, targets = [], [], [], []
    for state, (final, arcs) in enumerate(states):
        held = int(final)
        for byte, target in arcs:
            keys.append(state * 256 + byte)
            outputs.append(held)
            targets.append(target)
            held += counts[target]
        counts.append(held)
    return [np.array(keys, np.int64), np.array(outputs, np.int64), np.array(targets, np.int64), np.array([s[0] for s in states], bool)]


class Transducer:
    def __init__(self, arrays: list[np.ndarray], longest: int):
        self.keys, self.outputs, self.targets, self.final = arrays
        self.root, self.longest = len(self.final) - 1, longest

    def ordinals(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Ordinals of the words ``data[start:end]``, -1 for unknown ones: all walk together, byte by byte."""
        out = np.full(len(starts), -1, np.int64)
        who = np.flatnonzero((ends - starts <= self.longest) & (ends > starts))
        if not len(self.keys):
            return out
        at, state, total = starts[who], np.full(len(who), self.root, np.int64), np.zeros(len(who), np.int64)
        while len(who):
            key = state * 256 + data[at]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[arc] == key
            who, at, arc = who[hit], at[hit] + 1, arc[hit]
            state, total = self.targets[arc], total[hit] + self.outputs[arc]
            done = at == ends[who]
            final = done & self.final[state]
            out[who[final]] = total[final]
            who, at, state, total = who[~done], at[~done], state[~done], total[~done]
        return out

    def term(self, ordinal: int) -> bytes:
        """The term of an ordinal: at each state the last arc whose output does not exceed what is left."""
        out, state, left = bytearray(), self.root, ordinal
        while not (self.final[state] and left == 0):
            a, b = np.searchsorted(self.keys, [state * 256, state * 256 + 256])
            arc = a + int(np.searchsorted(self.outputs[a:b], left, side="right")) - 1
            left -= int(self.outputs[arc])
            out.append(int(self.keys[arc]) & 255)
            state = int(self.targets[arc])
        return bytes(out)


@dataclass
class Shard:
    """A contiguous range of one language's terms; ``base`` is the ordinal of its first."""

    name: int
    first: bytes
    base: int
    longest: int


class Vocabulary:
    """The transducers of all languages, opened when first asked for."""

    def __init__(self, folder: str, shards: dict[str, list[Shard]]):
        self.folder, self.shards, self.open = folder, shards, {}
        self.firsts = {lang: [s.first for s in held] for lang, held in shards.items()}

    def _transducer(self, shard: Shard) -> Transducer:
        if shard.name not in self.open:
            arrays = [np.load(os.path.join(self.folder, f"{n}.{shard.name:05d}.npy"), mmap_mode="r") for n in NAMES]
            self.open[shard.name] = Transducer(arrays, shard.longest)
        return self.open[shard.name]

    def ordinals(self, lang: str, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Ordinals within the language, -1 for words that are not kept."""
        out = np.full(len(starts), -1, np.int64)
        if lang not in self.shards:
            return out
        held, firsts = self.shards[lang], self.firsts[lang]
        place = np.zeros(len(starts), np.int64)
        if len(held) > 1:
            place = np.array([bisect_right(firsts, data[a:b].tobytes()) - 1 for a, b in zip(starts, ends)], np.int64)
        order = np.argsort(place, kind="stable")
        cuts = np.searchsorted(place[order], np.arange(len(held) + 1))
        for i, shard in enumerate(held):
            some = order[cuts[i]:cuts[i + 1]]
            if len(some):
                found = self._transducer(shard).ordinals(data, starts[some], ends[some])
                out[some] = np.where(found >= 0, found + shard.base, -1)
        return out

    def term(self, lang: str, ordinal: int) -> str:
        held = self.shards[lang]
        shard = held[bisect_right([s.base for s in held], ordinal) - 1]
        return self._transducer(shard).term(ordinal - shard.base).decode()


def store(folder: str, name: int, terms: list[bytes]) -> int:
    """Write the transducer of sorted terms; the length of the longest."""
    for part, values in zip(NAMES, build(terms)):
        save(folder, part, name, values)
    return max(map(len, terms))
