"""List Viterbi over character lattices of many tokens at once.

A sign of a token may be written as one of some letters or be silent; a state is the last two letters. For every state the ``best`` best
texts are carried along, which are the best ones under the channel and a trigram model of letters, whatever comes next. All tokens go one sign
further in each step, so a step is a few array operations and the work is linear in the signs; no token is too long. A text is carried as its hash, that
of ``words``, where a run of an ASCII letter counts once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from vectorloom.llm.words import _letters, mix, powers

LETTERS = 28  # edge, a-z, any other letter
OTHER = 27
_STATES = LETTERS * LETTERS


@dataclass
class Channel:
    """What a sign may be written as: for codes below 128 the letters (0: none) and the log-probability of each; other codes are themselves."""

    letters: np.ndarray
    cost: np.ndarray


def channel(leet: dict[str, str], sign: float) -> Channel:
    """Letters stand for themselves; a sign for each of its letters with equal shares of ``sign``."""
    letters, cost = np.zeros((129, max(map(len, leet.values()))), np.int64), np.zeros(129)
    for i, c in enumerate(b"abcdefghijklmnopqrstuvwxyz"):
        letters[c, 0] = i + 1
    for c, stands in leet.items():
        letters[ord(c), : len(stands)] = [ord(x) - 96 for x in stands]
        cost[ord(c)] = sign - np.log(len(stands))
    letters[128, 0] = OTHER
    return Channel(letters, cost)


@dataclass
class _Paths:
    who: np.ndarray
    a: np.ndarray
    b: np.ndarray
    score: np.ndarray
    letters: np.ndarray
    text: np.ndarray
    size: np.ndarray

    def take(self, at: np.ndarray) -> "_Paths":
        return _Paths(*[v[at] for v in vars(self).values()])

    @staticmethod
    def join(parts: list["_Paths"]) -> "_Paths":
        return _Paths(*[np.concatenate(v) for v in zip(*[vars(p).values() for p in parts])])


def _leading(group: np.ndarray, text: np.ndarray, score: np.ndarray, best: int) -> np.ndarray:
    """Of each group the ``best`` best texts, each by its best path."""
    order = np.lexsort((-score, text, group))
    g, t = group[order], text[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (g[1:] != g[:-1]) | (t[1:] != t[:-1])
    order = order[new]
    order = order[np.lexsort((text[order], -score[order], group[order]))]
    g = group[order]
    return order[np.arange(len(g)) - np.searchsorted(g, g) < best]


def _other_letters(codes: np.ndarray) -> dict[int, tuple[np.ndarray, int]]:
    """Hash terms of the UTF-8 bytes of each sign beyond ASCII."""
    return {int(c): (_letters(0)[np.frombuffer(chr(c).encode("utf-8", "replace"), np.uint8)]) for c in np.unique(codes[codes >= 128])}


def decode(
    codes: np.ndarray, silent: np.ndarray, again: np.ndarray, repeat: float, start: np.ndarray, size: np.ndarray, ends: np.ndarray,
    model: np.ndarray, signs: Channel, best: int, longest: int | None = None,
) -> tuple[np.ndarray, ...]:
    """Best texts of the sign ranges start:start+size, at each place of ``ends`` inside them: range, number of signs, hash, channel and letter log-probability.

    ``silent`` is the log-probability that a sign stands for nothing (-inf: it cannot), ``again`` marks signs that repeat the one before and so may be
    silent at ``repeat``. Texts of more than ``longest`` bytes are left.
    """
    order = np.argsort(-size, kind="stable")
    start, size = start[order], size[order]
    n = int(np.count_nonzero(size > 0))
    up = powers(int(size.max(initial=0)) * 4 + 1)[0]
    other = _other_letters(codes)
    zero = np.zeros(n)
    paths = _Paths(np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.int64), zero, zero, np.zeros(n, np.uint64), np.zeros(n, np.int64))
    found = []
    for step in range(int(size.max(initial=0))):
        live = int(np.searchsorted(-size, -step, "left"))  # ranges are sorted from long to short
        paths = paths.take(np.flatnonzero(paths.who < live))
        if not len(paths.who):
            break
        place = start[paths.who] + step
        code = codes[place]
        low = np.minimum(code, 128)
        quiet = silent[place]
        if step:
            quiet = np.where(again[place], np.maximum(quiet, repeat), quiet)
        stay = np.flatnonzero(quiet > -np.inf)
        kept = paths.take(stay)
        kept.score = kept.score + quiet[stay]
        parts = [kept]
        for slot in range(signs.letters.shape[1]):
            letter = signs.letters[low, slot]
            at = np.flatnonzero(letter)
            if not len(at):
                break
            p, letter = paths.take(at), letter[at]
            own = model[p.a, p.b, letter]
            text, length = p.text.copy(), p.size.copy()
            plain = (letter != OTHER) & (letter != p.b)
            text[plain] += _letters(0)[letter[plain] + 96] * up[length[plain]]
            length[plain] += 1
            for c in np.unique(code[at][letter == OTHER]).tolist():
                here = np.flatnonzero(code[at] == c)
                for term in other[c]:
                    text[here] += term * up[length[here]]
                    length[here] += 1
            parts.append(_Paths(p.who, p.b, letter, p.score + signs.cost[low[at]] + own, p.letters + own, text, length))
        paths = _Paths.join(parts)
        if longest is not None:
            paths = paths.take(np.flatnonzero(paths.size <= longest))
        many = np.bincount(paths.who, minlength=live) > 4 * best
        if many.any():
            some = many[paths.who]
            at = np.flatnonzero(some)
            led = at[_leading(paths.who[at] * _STATES + paths.a[at] * LETTERS + paths.b[at], paths.text[at], paths.score[at], best)]
            paths = paths.take(np.concatenate([np.flatnonzero(~some), led]))
        at = np.flatnonzero(ends[start[paths.who] + step] & (paths.size > 0))
        if len(at):
            p = paths.take(at)
            edge = model[p.a, p.b, 0]
            led = _leading(p.who, p.text, p.score + edge, best)
            found.append((order[p.who[led]], np.full(len(led), step + 1), mix(p.text[led] + p.size[led].astype(np.uint64)), (p.score - p.letters)[led], (p.letters + edge)[led]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0), np.empty(0)
    return tuple(np.concatenate(x) for x in zip(*found))
