"""A weighted backoff automaton over the words of one block of texts.

States are the empty history, words, and longer n-grams. An arc reads a word, adds
its log-probability and leads to the longest n-gram that the next history ends with.
A state without an arc for the word fails: its failure arc adds the weight of what
its arcs leave over and leads to the history without its first word. The empty
history has an arc for every word.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Texts of more tokens are walked in pieces; each is entered through the words before it.
PIECE = 1024


@dataclass
class Automaton:
    """Arcs sorted by state and word; the arcs of the empty history are one per word."""

    words: int
    history: int
    keys: np.ndarray
    gain: np.ndarray
    target: np.ndarray
    failure: np.ndarray
    loss: np.ndarray
    root_gain: np.ndarray
    root_target: np.ndarray


@dataclass
class Grams:
    """The n-grams of one length: where each ends for the first time in the tokens, its count, what its arcs take.

    ``at`` numbers the n-gram that ends at each token from 1; 0 stands for none.
    """

    at: np.ndarray
    place: np.ndarray
    count: np.ndarray
    taken: np.ndarray


def build(tokens: np.ndarray, base: np.ndarray, levels: list[Grams], discount: float) -> Automaton:
    """The automaton of n-grams of all lengths, from single words on, with absolute discounting.

    A word's number is its token plus 1, so ``levels[0]`` has one n-gram a word; words
    never seen have a count of 0 and are no states.
    """
    words = len(base)
    first = np.cumsum([1] + [len(level.count) for level in levels[:-1]])
    states = int(first[-1])
    failure, loss = np.zeros(states, np.int64), np.zeros(states)

    def state(n: int, place: np.ndarray) -> np.ndarray:
        """The states of the n-grams of a length that end at these tokens; the longest ones are arcs only."""
        number = levels[n].at[place].astype(np.int64)
        return np.where(number > 0, number + (first[n] - 1), 0)

    seen = levels[0].count > 0
    root_target = np.where(seen, np.arange(words) + 1, 0) if states > 1 else np.zeros(words, np.int64)
    keys, gain, target, below = [], [], [], base
    for n, level in enumerate(levels):
        if n:
            history, word = state(n - 1, level.place - 1), tokens[level.place].astype(np.int64)
            left = levels[n - 1]
            own = left.at[level.place - 1] - 1
            count, shorter = left.count[own], below[levels[n - 1].at[level.place] - 1]
            chance = (np.maximum(level.count - discount, 0) + (count - left.taken[own]) * shorter) / count
            keys.append(history * words + word)
            gain.append(np.log10(chance))
            target.append(state(min(n, len(levels) - 2), level.place))
            below = chance
        if n < len(levels) - 1:
            mine = slice(int(first[n]), int(first[n + 1]))
            failure[mine] = state(n - 1, level.place) if n else 0
            with np.errstate(divide="ignore", invalid="ignore"):
                loss[mine] = np.where(level.count > 0, np.log10((level.count - level.taken) / level.count), 0)
    keys = np.concatenate(keys) if keys else np.zeros(0, np.int64)
    order = np.argsort(keys)
    return Automaton(words, len(levels) - 1, keys[order], np.concatenate(gain)[order] if gain else np.zeros(0),
                     np.concatenate(target)[order] if target else np.zeros(0, np.int64), failure, loss,
                     np.log10(base), root_target)


def step(machine: Automaton, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The states after reading one word in each lane, and the log-probabilities of the words."""
    weight, after = np.zeros(len(state)), np.zeros(len(state), np.int64)
    open_ = np.arange(len(state))
    while len(open_):
        here, read = state[open_], word[open_]
        root = here == 0
        done = open_[root]
        weight[done] += machine.root_gain[read[root]]
        after[done] = machine.root_target[read[root]]
        open_, here, read = open_[~root], here[~root], read[~root]
        if not len(open_):
            break
        key = here * machine.words + read
        arc = np.minimum(np.searchsorted(machine.keys, key), max(len(machine.keys) - 1, 0))
        hit = machine.keys[arc] == key if len(machine.keys) else np.zeros(len(key), dtype=bool)
        weight[open_[hit]] += machine.gain[arc[hit]]
        after[open_[hit]] = machine.target[arc[hit]]
        open_, here = open_[~hit], here[~hit]
        weight[open_] += machine.loss[here]
        state = state.copy()
        state[open_] = machine.failure[here]
    return after, weight


def walk(machine: Automaton, tokens: np.ndarray, first: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The log-probability of each text, all texts walked side by side from left to right.

    A piece of a long text is entered in the state that the last words before it lead
    to; that is the state in which the walk of the whole text would arrive.
    """
    pieces = -(-(ends - first) // PIECE)
    text = np.repeat(np.arange(len(first)), pieces)
    begin = first[text] + PIECE * (np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    end = np.minimum(begin + PIECE, ends[text])
    entry = np.maximum(first[text], begin - machine.history)
    order = np.argsort(entry - end, kind="stable")
    entry, begin, end = entry[order], begin[order], end[order]
    state, total = np.zeros(len(order), np.int64), np.zeros(len(order))
    lengths, lanes = end - entry, len(order)
    for at in range(int(lengths[0]) if len(lengths) else 0):
        while lengths[lanes - 1] <= at:
            lanes -= 1
        place = entry[:lanes] + at
        state[:lanes], weight = step(machine, state[:lanes], tokens[place].astype(np.int64))
        total[:lanes] += np.where(place >= begin[:lanes], weight, 0.0)
    return np.bincount(text[order], weights=total, minlength=len(first))
