"""Periodic runs of words, found in the grammars that Re-Pair makes of the texts."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shingles import mix, texts_of

#: Bytes of texts that one grammar is made of; a longer text has one of its own.
PORTION_BYTES = 1_500_000
#: Pairs of a boundary and a period that are tried at once.
TRIALS = 500_000
# A prime below 2**31, so that products fit in 64 bits, and two bases for sums of hashes.
PRIME = (1 << 31) - 1
BASES = (1_103_515_245, 1_664_525_011)

RUN = "struct<start:long,length:long,period:long>"
SCHEMA = f"doc_id long, n_words long, runs array<{RUN}>, strongest {RUN}, collapsed string"


def collapse_runs(
    docs: DataFrame, exponent: int = 4, least_length: int = 6, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, runs, strongest, collapsed.

    The words of a whole text are what white space (blank, x09 to x0D) leaves. A run is a stretch of words with smallest period
    q, that is words q apart are equal, of at least ``least_length`` and ``exponent`` * q words, which no neighbouring
    word extends. ``runs`` holds (start, length, period) by start, then period, counted in words; ``strongest`` the run
    of the greatest length / period (ties: smallest start, then period). In ``collapsed`` each run is cut to its first
    period, and the words that stay are joined by one blank.

    Method. The word ids of a portion of texts are Re-Paired in rounds: of the pairs that occur twice, those that are more
    frequent than the pairs beside them become nonterminals, until no pair occurs twice. What is left at the top is joined
    in a balanced tree. A run lies in some symbol whose halves meet inside it; it is looked for there, once per
    symbol, and translated to wherever the symbol is derived. What is only a part of a run in a larger symbol is contained
    in that one and dropped. A run of at least four periods has two of them on one side of the boundary, so a few
    equal words sift the periods; hashes of stretches then give how far each reaches. Found runs are compared word by word.

    A null or empty text has no words, no runs, a null ``strongest`` and an empty ``collapsed``; a null id stays null. Repeated rows
    each have their row. Other columns are ignored, whatever their names. Memory follows the longest text.
    """
    if exponent < 4:
        raise ValueError("runs of less than four periods are not looked for")
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(partial(_collapse, exponent=exponent, least_length=least_length), SCHEMA)


def _collapse(batches: Iterator[pa.RecordBatch], exponent: int, least_length: int) -> Iterator[pa.RecordBatch]:
    kind = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])
    for batch in batches:
        texts = texts_of(batch.column("text"))
        first = 0
        while first < len(texts):
            last, size = first + 1, len(texts[first])
            while last < len(texts) and size + len(texts[last]) <= PORTION_BYTES:
                size += len(texts[last])
                last += 1
            words = [text.split() for text in texts[first:last]]
            found, kept = runs_of(words, exponent, least_length)
            named = [[{"start": s, "length": n, "period": q} for s, n, q in runs] for runs in found]
            strongest = [min(runs, key=lambda r: (-Fraction(r["length"], r["period"]), r["start"], r["period"]), default=None) for runs in named]
            collapsed = [b" ".join([word for word, stays in zip(w, k) if stays] if runs else w) for w, k, runs in zip(words, kept, named)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(first, last - first),
                    pa.array([len(w) for w in words], pa.int64()),
                    pa.array(named, pa.list_(kind)),
                    pa.array(strongest, kind),
                    pa.array(collapsed, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "n_words", "runs", "strongest", "collapsed"],
            )
            first = last


def runs_of(texts: list[list[bytes]], exponent: int, least_length: int) -> tuple[list[list[tuple[int, int, int]]], list[list[bool]]]:
    """The runs (start, length, period) of each list of words, and for each word whether it stays."""
    ids, known = [], 0
    for words in texts:  # ids differ between texts, so that no pair or run goes from one to another
        index = {word: known + k for k, word in enumerate(dict.fromkeys(words))}
        ids.append(np.fromiter(map(index.__getitem__, words), dtype=np.int64, count=len(words)))
        known += len(index)
    starts = np.concatenate(([0], np.cumsum([len(words) for words in texts])))
    w = np.concatenate([np.empty(0, dtype=np.int64), *ids])
    s, e, q = _runs(w, starts, known, exponent, least_length)
    change = np.zeros(len(w) + 1, dtype=np.int64)
    np.add.at(change, s + q, 1)
    np.add.at(change, e, -1)
    stays = np.cumsum(change)[:-1] == 0
    order = np.lexsort((q, s))
    s, e, q = s[order], e[order], q[order]
    cuts = np.searchsorted(s, starts)
    found = [list(zip((s[a:b] - start).tolist(), (e[a:b] - s[a:b]).tolist(), q[a:b].tolist())) for a, b, start in zip(cuts[:-1], cuts[1:], starts)]
    return found, [stays[a:b].tolist() for a, b in zip(starts[:-1], starts[1:])]


class Grammar(NamedTuple):
    """Nonterminals number from ``terminals`` on, in the order of ``rounds`` (their ends); ``top`` and ``place`` are what is left."""

    terminals: int
    left: np.ndarray
    right: np.ndarray
    first: np.ndarray  # where a nonterminal occurs first
    length: np.ndarray  # of terminals too
    rounds: list[int]
    top: np.ndarray
    place: np.ndarray


def re_pair(w: np.ndarray, terminals: int) -> Grammar:
    """A grammar of the words; in each round many pairs are replaced that do not overlap.

    A pair wins over its neighbours by its count, then by a random number, so that rounds are few. In a stretch of one
    symbol every other pair is taken. Symbols in no pair that occurs twice can never come to be in one and are set aside.
    """
    random = np.random.default_rng(len(w))
    symbol, place, length = w, np.arange(len(w)), np.ones(terminals, dtype=np.int64)
    lefts, rights, firsts, rounds, aside = [], [], [], [terminals], []
    while len(symbol) > 1:
        beside = place[:-1] + length[symbol[:-1]] == place[1:]
        key = np.where(beside, symbol[:-1] * len(length) + symbol[1:], -1 - np.arange(len(symbol) - 1))
        pairs, which, counts = np.unique(key, return_inverse=True, return_counts=True)
        rank = counts[which] * len(pairs) + random.permutation(len(pairs))[which]
        twice = counts[which] > 1
        if not twice.any():
            break
        new_stretch = np.concatenate(([True], rank[1:] != rank[:-1]))
        stretch = np.cumsum(new_stretch) - 1
        begins = np.flatnonzero(new_stretch)
        ranks = np.concatenate(([-1], rank[begins], [-1]))
        wins = (ranks[1:-1] > ranks[:-2]) & (ranks[1:-1] > ranks[2:])
        taken = np.flatnonzero(twice & wins[stretch] & ((np.arange(len(rank)) - begins[stretch]) % 2 == 0))
        _, at, rule = np.unique(which[taken], return_index=True, return_inverse=True)
        left, right = symbol[taken[at]], symbol[taken[at] + 1]
        lefts.append(left)
        rights.append(right)
        firsts.append(place[taken[at]])
        involved = np.concatenate((twice, [False])) | np.concatenate(([False], twice))
        symbol = symbol.copy()
        symbol[taken] = len(length) + rule
        length = np.concatenate((length, length[left] + length[right]))
        rounds.append(len(length))
        gone = np.zeros(len(symbol), dtype=bool)
        gone[taken + 1] = True
        aside.append((symbol[~involved], place[~involved]))
        stay = involved & ~gone
        symbol, place = symbol[stay], place[stay]
    top, place = (np.concatenate([a[i] for a in (*aside, (symbol, place))]) for i in (0, 1))
    order = np.argsort(place)
    none = [np.empty(0, dtype=np.int64)]
    return Grammar(terminals, *(np.concatenate(none + x) for x in (lefts, rights, firsts)), length, rounds, top[order], place[order])


def _runs(w: np.ndarray, starts: np.ndarray, terminals: int, exponent: int, least_length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of the runs of all texts, the places counted over all of them."""
    grammar = re_pair(w, terminals)
    sums = _Sums(w)
    rules = np.arange(len(grammar.left))
    half = grammar.first + grammar.length[grammar.left]
    whole = grammar.first + grammar.length[terminals + rules]
    rule, s, e, q = _crossing(w, sums, grammar.first, half, whole, exponent, least_length)
    found = [_derived(grammar, rule, s - grammar.first[rule], e - grammar.first[rule], q)]
    low, high = grammar.place, grammar.place + grammar.length[grammar.top]
    text = np.searchsorted(starts, low, side="right") - 1
    while len(low):  # the balanced tree: symbols at odd places of their text join those before them
        rank = np.arange(len(low)) - np.searchsorted(text, text)
        odd = np.flatnonzero(rank % 2 == 1)
        if not len(odd):
            break
        found.append(_crossing(w, sums, low[odd - 1], low[odd], high[odd], exponent, least_length)[1:])
        high[odd - 1] = high[odd]
        low, high, text = (np.delete(x, odd) for x in (low, high, text))
    s, e, q = (np.concatenate([x[i] for x in found]) for i in range(3))
    s, e, q = _largest(s, e, q)
    _confirm(w, starts, s, e, q)
    return s, e, q


def _crossing(
    w: np.ndarray, sums: _Sums, low: np.ndarray, half: np.ndarray, high: np.ndarray, exponent: int, least_length: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows (index, start, end, period): stretches inside [low, high) around ``half`` that are long enough for a run."""
    out = [[np.empty(0, dtype=np.int64)] for _ in range(4)]
    most = np.where(high - low >= least_length, (high - low) // exponent, 0)
    for sign, room in ((1, high - half), (-1, half - low)):
        tries = np.minimum(most, room // 2)
        upto = np.cumsum(tries)
        begin = 0
        while begin < len(tries):
            before = upto[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(upto, before + TRIALS, side="right")))
            index = begin + np.repeat(np.arange(end - begin), tries[begin:end])
            q = np.arange(len(index)) - (upto[index] - tries[index] - before) + 1
            # On this side two periods lie in a row: the first words beside the boundary recur after one.
            x = half[index] if sign > 0 else half[index] - 1
            good = w[x] == w[x + sign * q]
            index, q, x = index[good], q[good], x[good]
            good = (q == 1) | (w[x + sign * (q > 1)] == w[x + sign * (q + (q > 1))])
            index, q = index[good], q[good]
            x = half[index] if sign > 0 else half[index] - q
            after = sums.common(x, x + q, high[index] - x - q, 1)
            ahead = sums.common(x, x + q, x - low[index], -1)
            s, e = x - ahead, x + q + after
            good = e - s >= np.maximum(least_length, exponent * q)
            for column, values in zip(out, (index, s, e, q)):
                column.append(values[good])
            begin = end
    return tuple(np.concatenate(column) for column in out)


class _Sums:
    """Sums of the words' hashes times powers of a base, of which any stretch's hash can be had."""

    def __init__(self, w: np.ndarray):
        self.powers, self.sums = [], []
        for base in BASES:
            powers = np.ones(len(w) + 1, dtype=np.int64)
            known = 1
            while known < len(powers):
                more = min(known, len(powers) - known)
                powers[known : known + more] = powers[:more] * (powers[known - 1] * base % PRIME) % PRIME
                known += more
            values = (mix(w.astype(np.uint64) + np.uint64(base)) % np.uint64(PRIME)).astype(np.int64)
            total = np.concatenate(([0], np.cumsum(values * powers[:-1] % PRIME)))
            self.powers.append(powers)
            self.sums.append(total % PRIME)

    def common(self, x: np.ndarray, y: np.ndarray, room: np.ndarray, direction: int) -> np.ndarray:
        """How many words from x and y on (or, backwards, before them) agree, at most ``room``; y is not less than x."""
        low, high = np.zeros_like(room), room.copy()
        while True:
            rows = np.flatnonzero(low < high)
            if not len(rows):
                return low
            middle = (low[rows] + high[rows] + 1) // 2
            a, b = (x[rows], y[rows]) if direction > 0 else (x[rows] - middle, y[rows] - middle)
            same = np.ones(len(rows), dtype=bool)
            for powers, sums in zip(self.powers, self.sums):
                first, second = ((sums[at + middle] - sums[at]) % PRIME for at in (a, b))
                same &= first * powers[b - a] % PRIME == second
            low[rows] = np.where(same, middle, low[rows])
            high[rows] = np.where(same, high[rows], middle - 1)


def _derived(grammar: Grammar, rule: np.ndarray, s: np.ndarray, e: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The stretches (s, e, q), counted from the start of their rule, at every place where the rule is derived.

    Only symbols in which some stretch lies are followed down.
    """
    order = np.argsort(rule, kind="stable")
    rule, s, e, q = rule[order], s[order], e[order], q[order]
    holds = np.zeros(len(grammar.length), dtype=bool)
    holds[grammar.terminals + rule] = True
    for start, end in zip(grammar.rounds[:-1], grammar.rounds[1:]):
        rules = slice(start - grammar.terminals, end - grammar.terminals)
        holds[start:end] |= holds[grammar.left[rules]] | holds[grammar.right[rules]]
    open_symbols, places = grammar.top[holds[grammar.top]], grammar.place[holds[grammar.top]]
    out = [[np.empty(0, dtype=np.int64)] for _ in range(3)]
    for start in grammar.rounds[-2::-1]:
        now = open_symbols >= start
        which, at = open_symbols[now] - grammar.terminals, places[now]
        first, count = np.searchsorted(rule, which), np.searchsorted(rule, which, side="right") - np.searchsorted(rule, which)
        owner = np.repeat(np.arange(len(which)), count)
        row = first[owner] + np.arange(len(owner)) - (np.cumsum(count) - count)[owner]
        for column, values in zip(out, (s[row] + at[owner], e[row] + at[owner], q[row])):
            column.append(values)
        left, right = grammar.left[which], grammar.right[which]
        symbols = np.concatenate((open_symbols[~now], left, right))
        places = np.concatenate((places[~now], at, at + grammar.length[left]))
        open_symbols, places = symbols[holds[symbols]], places[holds[symbols]]
    return tuple(np.concatenate(column) for column in out)


def _largest(s: np.ndarray, e: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Without stretches that lie in another of their period, and of equal stretches the one with the smallest period."""
    order = np.lexsort((-e, s, q))
    s, e, q = s[order], e[order], q[order]
    reach = np.maximum.accumulate(e + q * (1 << 40)) if len(s) else e
    inside = np.concatenate(([False], reach[:-1] >= (e + q * (1 << 40))[1:])) if len(s) else np.empty(0, dtype=bool)
    s, e, q = s[~inside], e[~inside], q[~inside]
    order = np.lexsort((q, e, s))
    s, e, q = s[order], e[order], q[order]
    new = np.concatenate(([True], (s[1:] != s[:-1]) | (e[1:] != e[:-1]))) if len(s) else np.empty(0, dtype=bool)
    return s[new], e[new], q[new]


def _confirm(w: np.ndarray, starts: np.ndarray, s: np.ndarray, e: np.ndarray, q: np.ndarray) -> None:
    """Compares the words of the runs, and those beside them; only unlike stretches of one hash could make a difference."""
    compared = e - s - q
    owner = np.repeat(np.arange(len(s)), compared)
    at = s[owner] + np.arange(len(owner)) - (np.cumsum(compared) - compared)[owner]
    begin = starts[np.searchsorted(starts, s, side="right") - 1]
    end = starts[np.searchsorted(starts, s, side="right")]
    ahead, after = np.flatnonzero(s > begin), np.flatnonzero(e < end)
    if (
        (w[at] != w[at + q[owner]]).any()
        or (w[s[ahead] - 1] == w[s[ahead] - 1 + q[ahead]]).any()
        or (w[e[after]] == w[e[after] - q[after]]).any()
    ):
        raise RuntimeError("two unlike stretches of words have the same hash")
